"""Where this subpackage's queries and their SQL are registered."""

from __future__ import annotations

import tempfile
import zipfile
from collections.abc import Callable
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

import panelkit

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


# Rows that go to a Python worker at once; whole texts are long.
BATCH = "spark.sql.execution.arrow.maxRecordsPerBatch"


def ship(spark: SparkSession) -> None:
    """Send this package to the Python workers, once a session.

    Workers keep what they have built (automata, memos) in its modules, so its
    functions are sent by name. Batches are made smaller where the session has
    Spark's default, as both sides hold a batch in memory.
    """
    context = spark.sparkContext
    if getattr(context, "_panelkit_shipped", False):
        return
    if spark.conf.get(BATCH) == "10000":
        spark.conf.set(BATCH, "2000")
    root = Path(panelkit.__file__).resolve().parent
    archive = Path(tempfile.mkdtemp(prefix="panelkit-")).resolve() / "panelkit.zip"
    with zipfile.ZipFile(archive, "w") as out:
        for path in sorted(root.rglob("*.py")):
            out.write(path, path.relative_to(root.parent))
    context.addPyFile(str(archive))
    context._panelkit_shipped = True


def query(name: str, oracle: str | None = None) -> Callable[[Query], Query]:
    """Register a query, which ships the package first; one without ``oracle`` is tested against brute force in ``tests/llm``."""
    def add(fn: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"{name} is registered twice")
        def run(spark: SparkSession, sf: str) -> DataFrame:
            ship(spark)
            return fn(spark, sf)

        QUERIES[name] = run
        if oracle is not None:
            ORACLES[name] = oracle
        return fn

    return add


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf.rstrip('/')}/{name}.parquet")
