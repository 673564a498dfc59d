"""Tables kept as Parquet, and CSV exports for readers."""

from __future__ import annotations

import logging
import time
import uuid
from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

log = logging.getLogger(__name__)


def _file_system(spark: SparkSession, path: str):
    """The path as Hadoop has it, and its file system."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place, place.getFileSystem(spark._jsc.hadoopConfiguration())


def write_measured(df: DataFrame, path: str, metrics: Mapping[str, Column] | None = None, mode: str = "overwrite",
                   partition_by: Sequence[str] = ()) -> dict:
    """Replace a Parquet table; returns ``rows`` and the ``metrics``, aggregates that are summed up while rows are written.

    A replaced table is written beside the old one and then takes its place, so a write
    that fails leaves the old table, and a table may be replaced by what is read from it.
    Between the two renames there is no table for a moment; ``publish`` has no such gap.
    """
    seen = Observation()
    observed = df.observe(seen, F.count(F.lit(1)).alias("rows"), *[c.alias(n) for n, c in (metrics or {}).items()])
    spark, replaced = df.sparkSession, mode == "overwrite"
    folder, _, name = path.rstrip("/").rpartition("/")
    mark = uuid.uuid4().hex
    beside = f"{folder}/_{name}.new-{mark}" if replaced else path
    writer = observed.write.mode(mode)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    try:
        writer.parquet(beside)
    except Exception:
        if replaced:
            place, store = _file_system(spark, beside)
            store.delete(place, True)
        raise
    if replaced:
        _take_place(spark, beside, path.rstrip("/"), f"{folder}/_{name}.old-{mark}")
    found = dict(seen.get)
    log.info("wrote %s rows to %s", found["rows"], path)
    return found


def _take_place(spark: SparkSession, new: str, path: str, old: str) -> None:
    """Rename ``new`` to ``path``; what was there goes, or comes back if that fails."""
    (new_place, store), (place, _), (old_place, _) = (_file_system(spark, x) for x in (new, path, old))
    there = store.exists(place)
    if there and not store.rename(place, old_place):
        raise OSError(f"{path} could not be moved aside")
    if not store.rename(new_place, place):
        if there:
            store.rename(old_place, place)
        raise OSError(f"{new} could not be renamed to {path}")
    if there:
        store.delete(old_place, True)


def write_table(df: DataFrame, path: str, mode: str = "overwrite", partition_by: Sequence[str] = ()) -> int:
    """Replace a Parquet table and return the number of rows written, as ``write_measured``."""
    return write_measured(df, path, None, mode, partition_by)["rows"]


def read_table(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether there is a file or folder at a path of any file system Spark reads."""
    place, store = _file_system(spark, path)
    return store.exists(place)


# A published table is a folder with a version per write, and a file that names the current one.
POINTER = "_current"


def publish(df: DataFrame, path: str, keep: int = 2) -> str:
    """Write a new version of a published table and make it the current one; returns its name.

    Readers see the old version until the pointer has been replaced, in one rename, and a
    failing write changes nothing. The last ``keep`` versions stay, for readers that
    hold an earlier one.
    """
    if keep < 1:
        raise ValueError("keep must be at least 1")
    spark, path = df.sparkSession, path.rstrip("/")
    jvm = spark._jvm
    version = f"version-{time.time_ns():020d}-{uuid.uuid4().hex[:8]}"
    try:
        df.write.parquet(f"{path}/{version}")
    except Exception:
        half, store = _file_system(spark, f"{path}/{version}")
        store.delete(half, True)
        raise
    beside, store = _file_system(spark, f"{path}/{POINTER}-{version}")
    stream = store.create(beside, True)
    stream.write(bytearray(version.encode()))
    stream.close()
    options = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 1)
    options[0] = jvm.org.apache.hadoop.fs.Options.Rename.OVERWRITE
    pointer, _ = _file_system(spark, f"{path}/{POINTER}")
    jvm.org.apache.hadoop.fs.FileContext.getFileContext(store.getUri(), spark._jsc.hadoopConfiguration()).rename(
        store.makeQualified(beside), store.makeQualified(pointer), options)
    place, _ = _file_system(spark, path)
    versions = sorted(f.getPath().getName() for f in store.listStatus(place) if f.getPath().getName().startswith("version-"))
    for old in versions[:versions.index(version)][:max(0, versions.index(version) + 1 - keep)]:
        store.delete(jvm.org.apache.hadoop.fs.Path(place, old), True)
    return version


def current_version(spark: SparkSession, path: str) -> str:
    """The name of the current version of a published table."""
    place, store = _file_system(spark, f"{path.rstrip('/')}/{POINTER}")
    stream = store.open(place)
    try:
        return bytes(stream.readAllBytes()).decode()
    finally:
        stream.close()


class Published:
    """Reads one version of a published table until it is ``max_age`` seconds old, then the current one."""

    def __init__(self, spark: SparkSession, path: str, max_age: float = 300.0, clock: Callable[[], float] = time.monotonic) -> None:
        self.spark, self.path, self.max_age, self.clock = spark, path.rstrip("/"), max_age, clock
        self.version, self._looked, self._frame = "", float("-inf"), None

    def read(self) -> DataFrame:
        now = self.clock()
        if self._frame is None or now - self._looked >= self.max_age:
            version = current_version(self.spark, self.path)
            if version != self.version:
                self.version, self._frame = version, self.spark.read.parquet(f"{self.path}/{version}")
            self._looked = now
        return self._frame


def _bucket_sql(keys: Sequence[str], buckets: int) -> str:
    names = ", ".join(f"`{k}`" for k in keys)
    return f"CLUSTERED BY ({names}) SORTED BY ({names}) INTO {buckets} BUCKETS"


def write_bucketed(df: DataFrame, name: str, path: str, keys: Sequence[str], buckets: int) -> DataFrame:
    """Write a table in buckets of equal keys, each one sorted file, and return it.

    Tables with as many buckets on the same keys (or keys of the same types) are joined
    and aggregated on them without a shuffle, whenever they are read. Rows are shuffled once, here; a
    bucket holds all rows of its keys, so keys that hold much of a table are not for this.
    ``name`` is the table's name in the session's catalog, ``path`` a new folder.
    """
    spark = df.sparkSession
    dealt = df.repartition(buckets, *[F.col(f"`{k}`") for k in keys])
    dealt.write.format("parquet").mode("overwrite").option("path", path).bucketBy(buckets, *keys).sortBy(*keys).saveAsTable(name)
    return spark.table(name)


def read_bucketed(spark: SparkSession, name: str, path: str, schema: T.StructType, keys: Sequence[str], buckets: int) -> DataFrame:
    """A table that ``write_bucketed`` wrote in an earlier session, made known to this one's catalog."""
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    place = path.replace("'", "\\'")
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    spark.sql(f"CREATE TABLE {name} ({columns}) USING parquet {_bucket_sql(keys, buckets)} LOCATION '{place}'")
    return spark.table(name)


def export_columns(df: DataFrame, columns: Mapping[str, str]) -> DataFrame:
    """Project to the named columns under their display headers."""
    return df.select(*[F.col(f"`{name}`").alias(header) for name, header in columns.items()])


def export_csv(df: DataFrame, path: str, columns: Mapping[str, str], sort: Sequence[str] = ()) -> None:
    """Write sorted CSV part files with display headers.

    Sorting range-partitions the rows, so the part files in name order hold
    the global order and no single task sees everything.
    """
    out = df.orderBy(*sort) if sort else df
    export_columns(out, columns).write.mode("overwrite").option("header", True).csv(path)
