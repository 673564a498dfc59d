"""Token sequences as length-delimited binary records with a separate offset index.

A record is framed as in the widespread TFRecord layout, so other readers of that
layout can check and skip it (all numbers little-endian):

    8 bytes   length of the payload
    4 bytes   masked CRC-32C of these 8 bytes
    payload   1 byte width of an id (2 or 4), 1 byte 1 if the key is null, 2 bytes version,
              8 bytes key, the ids
    4 bytes   masked CRC-32C of the payload

Rows are range-partitioned and sorted by key, and every task writes files of its own
through pyarrow's file systems (local, HDFS, S3, GCS). Each attempt names its files
anew, and its rows of the index reach the index table only when Spark commits the
task. So lost executors, repeated and speculative attempts leave files that no index
row names; ``unused_files`` lists them.

The index is a Parquet table with one row per record. Reading takes index rows in
any order, whole or filtered: neighbours in a file are fetched in one range read,
others one by one, so a shuffled epoch is a shuffle of the small index.
"""

from __future__ import annotations

import struct
import uuid
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyarrow import fs as arrow_fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from panelkit.llm import byte_tokens

HEAD, PAYLOAD = struct.Struct("<QI"), struct.Struct("<BBHq")
FRAME = HEAD.size + 4
VERSION = 1
# Bytes of a file before the next one is begun, of a task's share of a read, and of one range read.
FILE_BYTES = 1 << 29
TASK_BYTES = 1 << 26
RANGE_BYTES = 1 << 23
# Files a reading task holds open.
OPEN_FILES = 8

# The reversed polynomial of CRC-32C and the constant of its masking (fixed values).
POLYNOMIAL = 0x82F63B78
MASK_DELTA = 0xA282EAD8
# 16-bit units of a block; all blocks of a batch are summed side by side.
BLOCK = 256

INDEX = T.StructType([
    T.StructField("file_no", T.LongType()), T.StructField("file", T.StringType()), T.StructField("row", T.LongType()),
    T.StructField("key", T.LongType()), T.StructField("offset", T.LongType()), T.StructField("bytes", T.LongType()),
    T.StructField("n_ids", T.LongType()), T.StructField("before", T.LongType())])


@lru_cache(None)
def _tables() -> tuple[np.ndarray, np.ndarray]:
    """The step over one 16-bit unit, and the steps over ``BLOCK`` zero units by each byte of a state."""
    unit = np.arange(1 << 16, dtype=np.uint32)
    for _ in range(16):
        unit = np.where(unit & 1, (unit >> 1) ^ np.uint32(POLYNOMIAL), unit >> 1).astype(np.uint32)
    state = np.uint32(1) << np.arange(32, dtype=np.uint32)
    for _ in range(BLOCK):
        state = unit[state & 0xFFFF] ^ (state >> 16)
    ahead = np.zeros((4, 256), np.uint32)
    for byte in range(4):
        for bit in range(8):
            ahead[byte] ^= np.where(np.arange(256) >> bit & 1, state[8 * byte + bit], 0).astype(np.uint32)
    return unit, ahead


def _sums(rows: np.ndarray) -> np.ndarray:
    """The remainder of every row of 16-bit units, from state 0."""
    unit, _ = _tables()
    state = np.zeros(len(rows), np.uint32)
    for column in np.ascontiguousarray(rows.T):
        state = unit[(state ^ column) & 0xFFFF] ^ (state >> 16)
    return state


def masked_crc32c(data: bytes, sizes: np.ndarray) -> np.ndarray:
    """The masked CRC-32C of consecutive stretches of ``data``, of ``sizes`` bytes, even and at least 4.

    Stretches are cut into blocks with zeros ahead of the first, which leave state 0
    as it is; blocks are summed side by side and joined from the front.
    """
    if not len(sizes):
        return np.zeros(0, np.uint32)
    _, ahead = _tables()
    units = np.asarray(sizes, np.int64) // 2
    blocks = -(-units // BLOCK)
    first = np.concatenate(([0], np.cumsum(blocks)))
    starts = first[1:] * BLOCK - units
    flat = np.zeros(first[-1] * BLOCK, np.uint16)
    flat[np.arange(units.sum()) + np.repeat(starts - (np.cumsum(units) - units), units)] = np.frombuffer(data, "<u2")
    # All ones as the first state are the same as the first four bytes inverted.
    flat[starts] ^= 0xFFFF
    flat[starts + 1] ^= 0xFFFF
    parts = _sums(flat.reshape(-1, BLOCK))
    state = parts[first[:-1]]
    for k in range(1, int(blocks.max())):
        more = np.flatnonzero(blocks > k)
        old = state[more]
        moved = ahead[0][old & 0xFF] ^ ahead[1][old >> 8 & 0xFF] ^ ahead[2][old >> 16 & 0xFF] ^ ahead[3][old >> 24]
        state[more] = moved ^ parts[first[more] + k]
    crc = ~state
    return (crc >> 15 | crc << 17) + np.uint32(MASK_DELTA)


def frame(keys: list[int | None], ids: list[bytes]) -> list[bytes]:
    """One framed record per key and packed little-endian unsigned 32-bit ids."""
    if not keys:
        return []
    every = np.frombuffer(b"".join(ids), "<u4")
    width = 2 if not len(every) or every.max() < 1 << 16 else 4
    every = every.astype(f"<u{width}").tobytes()
    cut, at = [], 0
    for key, x in zip(keys, ids):
        size = len(x) // 4 * width
        cut.append(PAYLOAD.pack(width, key is None, VERSION, key or 0) + every[at:at + size])
        at += size
    sizes = np.array([len(p) for p in cut], np.int64)
    lengths = sizes.astype("<u8").tobytes()
    heads, tails = masked_crc32c(lengths, np.full(len(cut), 8)), masked_crc32c(b"".join(cut), sizes).astype("<u4").tobytes()
    return [HEAD.pack(len(p), head) + p + tails[4 * i:4 * i + 4] for i, (p, head) in enumerate(zip(cut, heads.tolist()))]


def unframe(records: list[bytes], where: Callable[[int], str] = str) -> tuple[list[int | None], list[np.ndarray]]:
    """Keys and ids (unsigned 32-bit) of framed records; a record that is not as it was written is an error."""
    if not records:
        return [], []
    for i, r in enumerate(records):
        if len(r) < FRAME + PAYLOAD.size or len(r) % 2 or HEAD.unpack_from(r)[0] != len(r) - FRAME:
            raise ValueError(f"broken record: length, {where(i)}")
    sizes = np.array([len(r) - FRAME for r in records], np.int64)
    heads = masked_crc32c(sizes.astype("<u8").tobytes(), np.full(len(records), 8))
    tails = masked_crc32c(b"".join([r[HEAD.size:-4] for r in records]), sizes)
    keys, ids = [], []
    for i, (r, head, tail) in enumerate(zip(records, heads.tolist(), tails.tolist())):
        if HEAD.unpack_from(r)[1] != head or int.from_bytes(r[-4:], "little") != tail:
            raise ValueError(f"broken record: checksum, {where(i)}")
        width, null, version, key = PAYLOAD.unpack_from(r, HEAD.size)
        if version != VERSION or width not in (2, 4):
            raise ValueError(f"unknown version, {where(i)}")
        keys.append(None if null else key)
        ids.append(np.frombuffer(r, f"<u{width}", (len(r) - FRAME - PAYLOAD.size) // width, HEAD.size + PAYLOAD.size).astype("<u4"))
    return keys, ids


def store_of(folder: str) -> tuple[arrow_fs.FileSystem, str]:
    """The file system of a folder and the folder's path there."""
    if folder.startswith("file:/") and not folder.startswith("file://"):
        folder = "file://" + folder[5:]
    store, place = arrow_fs.FileSystem.from_uri(folder)
    return store, place.rstrip("/")


class _Writer:
    """The files of one attempt of one task."""

    def __init__(self, folder: str, task: int) -> None:
        self.store, self.place = store_of(folder)
        self.task, self.files, self.out = task, 0, None
        self.attempt = uuid.uuid4().hex

    def add(self, keys: list[int | None], ids: list[bytes]) -> pa.RecordBatch:
        """Write records; their rows of the index."""
        if self.out is None:
            self.name, self.number = f"records-{self.task:06d}-{self.files:04d}-{self.attempt}.bin", self.task << 20 | self.files
            self.out = self.store.open_output_stream(f"{self.place}/{self.name}")
            self.row = self.at = self.before = 0
            self.files += 1
        records = frame(keys, ids)
        self.out.write(b"".join(records))
        n = len(records)
        size, count = np.array([len(r) for r in records], np.int64), np.array([len(x) // 4 for x in ids], np.int64)
        columns = [np.full(n, self.number), pa.array([self.name] * n), np.arange(self.row, self.row + n), pa.array(keys, pa.int64()),
                   self.at + np.cumsum(size) - size, size, count, self.before + np.cumsum(count) - count]
        self.row, self.at, self.before = self.row + n, self.at + int(size.sum()), self.before + int(count.sum())
        if self.at >= FILE_BYTES:
            self.close()
        return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], INDEX.names)

    def close(self) -> None:
        if self.out is not None:
            self.out.close()
            self.out = None


def write_records(df: DataFrame, folder: str, path: str, key: str = "doc_id", text: str = "text", end: int | None = 0) -> DataFrame:
    """Write the ids of every text, with the id ``end`` behind them, in ascending order of ``key``; returns the index.

    Ids are those of the byte-level tokenizer file at ``path`` without added special
    tokens. ``key`` is an integer; null keys come first. Rows with one key follow
    each other by the hash of their text; equal rows are separate records, and a key
    may hold any share of the rows. A null or empty text has no ids but ``end``.
    Other columns are not written, whatever their names. An empty frame gives an
    empty index. ``folder`` is new, and every executor can reach it.
    """
    spark = df.sparkSession
    store, place = store_of(folder)
    store.create_dir(f"{place}/data", recursive=True)
    shared = byte_tokens.share(spark, path)
    last = b"" if end is None else struct.pack("<I", end)
    # Rows of a hot key differ in the last two columns, so ranges cut through it.
    rows = df.select(F.col(f"`{key}`").cast("bigint").alias("key"), F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text")).select(
        "key", "text", F.xxhash64("text").alias("tie"), F.monotonically_increasing_id().alias("row"))
    by = [F.col("key").asc_nulls_first(), F.col("tie"), F.col("row")]
    rows = rows.repartitionByRange(*by).sortWithinPartitions(*by).select("key", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        writer = _Writer(f"{folder.rstrip('/')}/data", TaskContext.get().partitionId())
        for batch in batches:
            if batch.num_rows:
                coder = byte_tokens.coder_of(shared)
                yield writer.add(batch.column("key").to_pylist(), [x + last for x in coder.encode(batch.column("text").to_pylist())])
        writer.close()

    rows.mapInArrow(run, INDEX).write.parquet(f"{folder.rstrip('/')}/index")
    return read_index(spark, folder)


def read_index(spark: SparkSession, folder: str) -> DataFrame:
    """One row per record: its file, place and size there, key, number of ids, and ids before it in its file."""
    return spark.read.schema(INDEX).parquet(f"{folder.rstrip('/')}/index")


def with_start(index: DataFrame, out: str = "start") -> DataFrame:
    """Add the number of ids in all records before each, in the order they were written. One row per file is summed up."""
    files = index.groupBy("file_no").agg(F.sum("n_ids").alias("_n"))
    earlier = Window.orderBy("file_no").rowsBetween(Window.unboundedPreceding, -1)
    files = files.select("file_no", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_earlier"))
    return index.join(files, "file_no").withColumn(out, F.col("_earlier") + F.col("before")).drop("_earlier")


def shuffled(index: DataFrame, seed: int) -> DataFrame:
    """Index rows in an order that ``seed`` decides; pass it to ``read_to`` with ``in_order=True``."""
    by = [F.xxhash64(F.lit(seed), "file", "row"), F.col("file"), F.col("row")]
    return index.repartitionByRange(*by).sortWithinPartitions(*by)


def _in_files(index: DataFrame) -> DataFrame:
    """Index rows so that a task has whole stretches of files."""
    total = index.agg(F.sum("bytes")).first()[0] or 0
    tasks = max(-(-total // TASK_BYTES), min(index.sparkSession.sparkContext.defaultParallelism, 1 + total // RANGE_BYTES))
    stretch = F.floor(F.col("offset") / F.lit(RANGE_BYTES))
    return index.repartition(tasks, "file_no", stretch).sortWithinPartitions("file_no", "offset")


def _ranges(files: list[str], offsets: list[int], sizes: list[int]) -> Iterator[tuple[int, int]]:
    """Runs of rows that lie side by side in a file, of bounded size."""
    first = 0
    for i in range(1, len(files) + 1):
        if (i == len(files) or files[i] != files[first] or offsets[i] != offsets[i - 1] + sizes[i - 1]
                or offsets[i] + sizes[i] - offsets[first] > RANGE_BYTES):
            yield first, i
            first = i


def read_to(index: DataFrame, folder: str, fields: list[T.StructField], derive: Callable[[int | None, np.ndarray], tuple],
            keep: list[str] | None = None, in_order: bool = False) -> DataFrame:
    """One row per index row: its columns ``keep`` (all), and what ``derive`` makes of a record's key and ids.

    Records are fetched by their place in the index and checked; one that differs
    from what was written is an error that names its place. ``in_order`` reads rows
    as they come, otherwise they are dealt out by their place in the files.
    """
    kept = [f for f in index.schema.fields if keep is None or f.name in keep]
    if clash := {f.name for f in kept} & {f.name for f in fields}:
        raise ValueError(f"the index already has columns {sorted(clash)}")
    schema = T.StructType([*kept, *fields])
    rows = index if in_order else _in_files(index)
    needed = [*dict.fromkeys(["file", "offset", "bytes", *(f.name for f in kept)])]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, place = store_of(f"{folder.rstrip('/')}/data")
        kinds = [to_arrow_type(f.dataType) for f in fields]
        held: dict[str, pa.NativeFile] = {}
        for batch in batches:
            files, offsets, sizes = (batch.column(c).to_pylist() for c in ("file", "offset", "bytes"))
            for first, end in _ranges(files, offsets, sizes):
                name = files[first]
                source = held.pop(name, None) or store.open_input_file(f"{place}/{name}")
                held[name] = source
                if len(held) > OPEN_FILES:
                    held.pop(next(iter(held))).close()
                data = source.read_at(offsets[end - 1] + sizes[end - 1] - offsets[first], offsets[first])
                cut = [data[offsets[i] - offsets[first]:offsets[i] - offsets[first] + sizes[i]] for i in range(first, end)]
                keys, ids = unframe(cut, lambda i, at=first, file=name: f"{file} at byte {offsets[at + i]}")
                made = [derive(k, x) for k, x in zip(keys, ids)]
                part = batch.slice(first, end - first)
                yield pa.RecordBatch.from_arrays([*(part.column(f.name) for f in kept),
                                                  *(pa.array([m[i] for m in made], kind) for i, kind in enumerate(kinds))], schema.names)
        for source in held.values():
            source.close()

    return rows.select(*needed).mapInArrow(run, schema)


def read_records(index: DataFrame, folder: str, in_order: bool = False) -> DataFrame:
    """Rows ``key`` and ``ids`` of the records that the index names."""
    fields = [T.StructField("key", T.LongType()), T.StructField("ids", T.ArrayType(T.IntegerType()))]
    return read_to(index, folder, fields, lambda key, ids: (key, ids.astype("<i4")), [], in_order)


def unused_files(index: DataFrame, folder: str) -> list[str]:
    """Files of attempts that were not committed; a name for each file of the folder passes the driver."""
    store, place = store_of(f"{folder.rstrip('/')}/data")
    found = {f.base_name for f in store.get_file_info(arrow_fs.FileSelector(place))}
    return sorted(found - {r.file for r in index.select("file").distinct().toLocalIterator()})
