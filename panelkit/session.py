"""Session defaults and the shared folder used to cut lineage."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

# Adaptive execution does the work we would otherwise tune by hand: it merges
# small shuffle partitions, splits skewed join partitions and switches to a
# broadcast join only after it has measured the side it would broadcast.
DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.showConsoleProgress": "false",
    # Recording the Python line of every column expression costs more than planning it.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def build_session(app_name: str = "panelkit", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the defaults above; ``conf`` keys use ``_`` for ``.``."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**DEFAULTS, **{k.replace("_", "."): v for k, v in conf.items()}}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach, as named by ``spark.checkpoint.dir``.

    A local master has only one machine, so a fresh temporary folder is set
    there when the cluster named none. Anywhere else its absence is an error.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if folder:
        return folder
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="panelkit-"))
    return spark.sparkContext.getCheckpointDir()


_SCOPE: ContextVar[str] = ContextVar("panelkit_scratch", default="")


@contextmanager
def scratch(spark: SparkSession) -> Iterator[str]:
    """Frames materialised inside are written under one folder, which is removed at the end.

    Use it around a job that ends with a write: frames that were materialised
    inside can not be read afterwards.
    """
    folder = f"{shared_folder(spark).rstrip('/')}/scratch-{uuid.uuid4().hex}"
    token = _SCOPE.set(folder)
    try:
        yield folder
    finally:
        _SCOPE.reset(token)
        place = spark._jvm.org.apache.hadoop.fs.Path(folder)
        place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def scratch_folder(spark: SparkSession) -> str:
    """The folder of the ``scratch`` block around the call, or else the shared folder."""
    return (_SCOPE.get() or shared_folder(spark)).rstrip("/")


def materialise(df: DataFrame, label: str = "stage") -> DataFrame:
    """Write ``df`` once to the shared folder and read it back.

    Used where one frame feeds several consumers, so that the fact tables
    behind it are scanned and shuffled once. A lost executor costs a re-read,
    not a re-run, and later readers prune columns and know the real size. The
    files stay until the ``scratch`` block around the call ends; without one,
    clean the folder by age.
    """
    spark = df.sparkSession
    path = f"{scratch_folder(spark)}/{label}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
