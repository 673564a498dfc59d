"""Scans of published CSV files and their column names."""

from __future__ import annotations

import csv
import io
import logging
import re
from collections.abc import Callable, Iterator, Mapping, Sequence

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

log = logging.getLogger(__name__)

# What each character of a published header becomes.
HEADER_REPLACEMENTS = {
    "\u00a0": "_", " ": "_", "/": "_", "-": "_",
    "(": "", ")": "", ",": "",
    "%": "pct",
}

# Labels of the rows that hold totals.
TOTAL_LABELS = {
    "gender|sex": ("Both sexes", "Total - gender"),
    "age": ("All ages", "Total, all ages"),
}


def clean_column_name(name: str) -> str:
    """Lower case with separators as underscores; colons and other signs stay."""
    return name.lower().translate(str.maketrans(HEADER_REPLACEMENTS)).strip("_")


def clean_column_names(df: DataFrame) -> DataFrame:
    return df.toDF(*[clean_column_name(c) for c in df.columns])


# A line all of whose quoted fields end on it.
WHOLE_LINE = r'^(?:"[^"]*(?:""[^"]*)*"[^,]*|[^",][^,]*|)(?:,(?:"[^"]*(?:""[^"]*)*"[^,]*|[^",][^,]*|))*+$'


# Bytes of a file's top that are read at once, until its title and header are whole.
TOP_BYTES = 1 << 16


def _top(spark: SparkSession, file: str, whole: Callable[[bytes, bool], list | None]) -> list | None:
    """What ``whole`` makes of a file's first bytes; it gets more until it returns something or the file ends."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    path = jvm.org.apache.hadoop.fs.Path(jvm.java.net.URI(file))
    codec = jvm.org.apache.hadoop.io.compress.CompressionCodecFactory(conf).getCodec(path)
    stream = path.getFileSystem(conf).open(path)
    if codec is not None:
        stream = codec.createInputStream(stream)
    try:
        data = b""
        while True:
            more = bytes(stream.readNBytes(TOP_BYTES))
            data += more
            found = whole(data, len(more) < TOP_BYTES)
            if found is not None or len(more) < TOP_BYTES:
                return found
    finally:
        stream.close()


def _records(text: str) -> list[list[str]]:
    """The records of a text without blank lines; a field may be as long as the text."""
    limit = csv.field_size_limit(max(len(text) + 1, 1 << 17))
    try:
        return [r for r in csv.reader(io.StringIO(text.removeprefix("\ufeff"), newline="")) if r]
    finally:
        csv.field_size_limit(limit)


def _first_line(data: bytes, ended: bool, skip_rows: int, encoding: str) -> list[str] | None:
    """The fields of the header line below ``skip_rows`` title lines, if it is whole."""
    lines = re.split(rb"\r\n|\r|\n", data)
    if len(lines) < skip_rows + 2 and not (ended and len(lines) == skip_rows + 1 and lines[-1]):
        return None
    return next(iter(_records(lines[skip_rows].decode(encoding))), [])


def _first_record(data: bytes, ended: bool, skip_rows: int, encoding: str) -> list[str] | None:
    """As ``_first_line`` for records that may hold line breaks; blank lines are no records."""
    records = _records(data.decode(encoding, "ignore"))
    # The last record of what was read may go on behind it.
    return records[skip_rows] if len(records) > skip_rows + (not ended) else None


def _heads(spark: SparkSession, scan: DataFrame, first: Callable[..., list | None], skip_rows: int, encoding: str,
           path: str | Sequence[str]) -> list[list[str]]:
    """The header of every file of a scan that is not empty, read by the driver from the file's first bytes."""
    heads = []
    for file in sorted(set(scan.inputFiles())):
        size = []

        def whole(data: bytes, ended: bool) -> list | None:
            size.append(len(data))
            return first(data, ended, skip_rows, encoding)

        head = _top(spark, file, whole)
        if head is not None:
            heads.append(head)
        elif size[-1]:
            raise ValueError(f"a file without header line in {path}")
    return heads


def _below_top(rows: DataFrame, skip: int) -> DataFrame:
    """The rows of a scan without the first ``skip`` of every file, by their place.

    A task has the rows of a split in order, and the split at a file's start has the file's
    first rows. So one pass that counts is enough, as Arrow batches that are mostly handed on.
    """
    kept = rows.columns
    marked = rows.select(*[F.col(f"`{c}`") for c in kept], F.xxhash64("_metadata.file_path").alias("_file"),
                         (F.col("_metadata.file_block_start") == 0).alias("_top"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, seen = None, 0
        for batch in batches:
            at, out = 0, batch.select(kept)
            files, tops = batch.column("_file").to_numpy(), batch.column("_top").to_numpy(zero_copy_only=False)
            # Where another split begins.
            edges = [*((files[1:] != files[:-1]) | (tops[1:] != tops[:-1])).nonzero()[0] + 1, len(files)]
            for end in edges:
                if at < end:
                    place = (files[at], tops[at])
                    if place != current:
                        current, seen = place, 0
                    drop = min(max(skip - seen, 0), end - at) if tops[at] else 0
                    seen += int(end - at)
                    if at + drop < end:
                        yield out.slice(at + drop, end - at - drop)
                at = end

    return marked.mapInArrow(run, rows.schema)


def _one_header(headers: Sequence[Sequence[str | None]], path: str | Sequence[str]) -> list[str]:
    """The cleaned names of all files, which must agree."""
    cleaned = {tuple(clean_column_name(n or f"column_{i}") for i, n in enumerate(h)) for h in headers}
    if not cleaned:
        raise ValueError(f"no header line in {path}")
    if len(cleaned) > 1:
        raise ValueError(f"files in {path} have different headers: {sorted(cleaned)}")
    return list(cleaned.pop())


def read_csv_table(
    spark: SparkSession,
    path: str | Sequence[str],
    schema: T.StructType | None = None,
    skip_rows: int = 0,
    encoding: str = "UTF-8",
    null_tokens: Sequence[str] = ("",),
    optional: Sequence[str] = (),
    multi_line: bool = False,
) -> DataFrame:
    """Read header CSV files as text, clean the names, then cast to ``schema``.

    ``schema`` lists the wanted columns by their cleaned names; others are not
    read, except those whose name matches an ``optional`` pattern. Without a
    schema every column is kept as text. Nothing is inferred from the data.

    ``skip_rows`` title lines, blank ones counted, stand above the header of
    every file; title and header are left out by their place in the file, never by
    their content. Files of one folder must have the same cleaned header. The driver reads
    the headers from the files' first bytes; the body is one scan.
    Files are split by lines, in any encoding that holds ASCII as it is; a quoted
    field with a line break is an error then. ``multi_line`` reads such files, one
    task each, and counts records instead of lines. A missing path is logged and gives an
    empty table when the schema is known.
    """
    try:
        if multi_line:
            probe = spark.read.option("encoding", encoding).text(path)
            names = _one_header(_heads(spark, probe, _first_record, skip_rows, encoding, path), path)
            fields = T.StructType([T.StructField(f"_c{i}", T.StringType()) for i in range(len(names))])
            records = spark.read.option("encoding", encoding).option("header", False).option("multiLine", True).option(
                "escape", "\"").option("maxColumns", max(len(names) + 1, 20480)).schema(fields).csv(path)
            rows = _below_top(records, skip_rows + 1)
        else:
            lines = spark.read.text(path)
            names = _one_header(_heads(spark, lines, _first_line, skip_rows, encoding, path), path)
            raw = F.col("value")
            text = raw if encoding.upper() in ("UTF-8", "UTF8") else F.decode(raw.cast("binary"), encoding)
            below = _below_top(lines, skip_rows + 1).select(text.alias("_line")).where("_line <> ''")
            fields = ", ".join(f"_c{i} string" for i in range(len(names)))
            line = F.when(F.regexp_like("_line", F.lit(WHOLE_LINE)), F.col("_line")).otherwise(F.raise_error(
                F.concat(F.lit("a quoted field goes on behind this line; read with multi_line: "), F.col("_line"))))
            rows = below.select(F.from_csv(line, fields, {"escape": "\"", "maxColumns": str(max(len(names) + 1, 20480))}).alias("_r")).select("_r.*")
    except AnalysisException as err:
        if "PATH_NOT_FOUND" not in str(err) or schema is None:
            raise
        log.warning("no file at %s, using an empty table", path)
        return spark.createDataFrame([], schema)

    if schema is None:
        return null_out(rows.toDF(*names), names, null_tokens, nan=False)
    wanted = {}
    for field in schema.fields:
        if clean_column_name(field.name) not in names:
            raise ValueError(f"no column {field.name} in {path}; it has {names}")
        wanted[field.name] = (names.index(clean_column_name(field.name)), field.dataType)
    for pattern in optional:
        found = next((i for i, n in enumerate(names) if re.search(pattern, n)), None)
        if found is not None:
            wanted.setdefault(names[found], (found, T.StringType()))
    texts = rows.select(*[F.col(f"_c{i}").alias(name) for name, (i, _) in wanted.items()])
    texts = null_out(texts, list(wanted), null_tokens, nan=False)
    typed = texts.select(*[F.col(f"`{name}`").try_cast(t).alias(name) for name, (_, t) in wanted.items()])
    return null_out(typed, list(wanted))


def null_out(df: DataFrame, cols: Sequence[str], tokens: Sequence[str] = (), nan: bool = True) -> DataFrame:
    """Replace missing-value tokens in text columns and NaN in float columns by NULL."""
    types = dict(df.dtypes)
    changed = {}
    for name in cols:
        c = F.col(f"`{name}`")
        if nan and types[name] in ("double", "float"):
            changed[name] = F.when(~F.isnan(c), c)
        elif tokens and types[name] == "string":
            changed[name] = F.when(~F.trim(c).isin(*tokens), c)
    return df.withColumns(changed) if changed else df


def filter_total_rows(df: DataFrame, patterns: Mapping[str, Sequence[str]] = TOTAL_LABELS) -> DataFrame:
    """Keep total rows. For each pattern the first column whose name matches is
    tested against the labels; a pattern without such a column tests nothing."""
    for pattern, labels in patterns.items():
        name = first_column_like(df, pattern)
        if name:
            df = df.where(F.trim(F.col(f"`{name}`")).isin(*labels))
    return df


def first_column_like(df: DataFrame, pattern: str) -> str | None:
    """The first column whose name contains the pattern, ignoring case."""
    return next((c for c in df.columns if re.search(pattern, c, re.IGNORECASE)), None)
