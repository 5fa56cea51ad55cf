"""Shared helpers: Arrow text batches as numpy byte views, word hashing, unique row keys.

All per-byte work below is vectorised over slices of at most ``SLICE_BYTES`` of text (one
row at least), so the memory of a task does not depend on how many rows an Arrow batch has.
"""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shardloom.session import ensure_checkpoint_dir, materialize, scratch_path, ship_package
from shardloom.session import read_table as _read_table

__all__ = ["byte_slices", "doc_of", "ensure_checkpoint_dir", "free_name", "keep_columns", "materialize", "mix64", "read_table",
           "scratch_path", "ship_package", "small_batches", "spans_of_words", "span_hash", "with_row_key", "window_hash", "SLICE_BYTES"]

SLICE_BYTES = 1 << 20

_STATE: dict = {}


def worker_state(key: str, make):
    """State that a Python worker keeps between tasks (a vocabulary, its caches); one operator's at a time."""
    if key not in _STATE:
        _STATE.clear()
        _POWERS.clear()  # what hashing has left; made again where it is needed
        gc.collect()
        release_memory()
        _STATE[key] = make()
    return _STATE[key]


def no_worker_state() -> None:
    """Let go of what another operator has left in this worker."""
    if _STATE:
        _STATE.clear()
        gc.collect()
        release_memory()


_LIBC = ctypes.CDLL(None)


def release_memory() -> None:
    """Hand freed memory back to the system: workers outlive a stage, and its neighbours need the room."""
    pa.default_memory_pool().release_unused()
    if hasattr(_LIBC, "malloc_trim"):
        _LIBC.malloc_trim(0)


#: Rows of an Arrow batch: texts of a few kB make batches of a few MB in the JVM and in the workers.
BATCH_ROWS = 500


def small_batches(spark: SparkSession) -> None:
    """Bound the Arrow batches of the session, unless a smaller bound is set already."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if int(spark.conf.get(key, "10000")) > BATCH_ROWS:
        spark.conf.set(key, str(BATCH_ROWS))


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    small_batches(spark)
    return _read_table(spark, sf_dir, name)

U64 = np.uint64
_ODD = U64(0x9E3779B97F4A7C15)


def mix64(x: np.ndarray) -> np.ndarray:
    """Bijective finaliser on unsigned 64-bit integers (splitmix64)."""
    x = x.astype(U64, copy=True)
    x ^= x >> U64(30)
    x *= U64(0xBF58476D1CE4E5B9)
    x ^= x >> U64(27)
    x *= U64(0x94D049BB133111EB)
    x ^= x >> U64(31)
    return x


def text_view(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes and the n + 1 row offsets of a string or binary column; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = pc.fill_null(column, b"" if pa.types.is_binary(column.type) or pa.types.is_large_binary(column.type) else "")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    n = len(column)
    if not n:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    offsets = np.frombuffer(column.buffers()[1], np.int64 if wide else np.int32, n + 1,
                            column.offset * (8 if wide else 4)).astype(np.int64)
    body = column.buffers()[2]
    data = np.frombuffer(body, np.uint8) if body is not None and body.size else np.zeros(0, np.uint8)
    return data[offsets[0]:offsets[-1]], offsets - offsets[0]


def byte_slices(batch: pa.RecordBatch, column: str, limit: int = SLICE_BYTES) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Row slices of about ``limit`` text bytes: (slice, bytes, offsets)."""
    data, offsets = text_view(batch.column(batch.schema.get_field_index(column)))
    n, i = len(offsets) - 1, 0
    while i < n:
        j = int(np.searchsorted(offsets, offsets[i] + limit, side="right")) - 1
        j = min(n, max(j, i + 1))
        yield batch.slice(i, j - i), data[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i]
        i = j
    release_memory()


def joined(batches: Iterator[pa.RecordBatch], limit: int) -> Iterator[pa.RecordBatch]:
    """Batches in a row, put together up to about ``limit`` bytes (one batch at least)."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if held and sum(b.nbytes for b in held) + batch.nbytes > limit:
            yield pa.concat_batches(held)
            held = []
        held.append(batch)
    if held:
        yield pa.concat_batches(held)


def tidy(run):
    """``run`` over a task's batches, which hands its freed memory back when it is done: its worker may stay idle beside others."""
    def tidied(batches):
        try:
            yield from run(batches)
        finally:
            release_memory()
    return tidied


def binary_rows(flat: np.ndarray, offsets: np.ndarray) -> pa.Array:
    """A binary column whose row i is the bytes of ``flat[offsets[i]:offsets[i + 1]]``."""
    at = (offsets * flat.itemsize).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(at) - 1, [None, pa.py_buffer(at), pa.py_buffer(np.ascontiguousarray(flat))])


def doc_of(positions: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Row index of every byte position."""
    return np.searchsorted(offsets, positions, side="right") - 1


#: Bytes that separate words: space and 0x09 to 0x0D.
SPACE = np.zeros(256, bool)
SPACE[[0x20, 9, 10, 11, 12, 13]] = True


def spans_of_words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts, ends and rows of the maximal runs of bytes that are not white space, rows kept apart."""
    if not len(data):
        z = np.zeros(0, np.int64)
        return z, z, z
    edge = np.zeros(len(data) + 1, bool)
    edge[offsets] = True
    black = ~SPACE[data]
    before = np.empty(len(data), bool)
    before[0] = False
    before[1:] = black[:-1]
    starts = np.flatnonzero(black & (~before | edge[:-1]))
    after = np.empty(len(data), bool)
    after[-1] = False
    after[:-1] = black[1:]
    ends = np.flatnonzero(black & (~after | edge[1:])) + 1
    return starts, ends, doc_of(starts, offsets)


_POWERS: dict[str, np.ndarray] = {}
_BYTE = mix64(np.arange(1, 257, dtype=np.uint64) * _ODD)
_BASE = 0xD1342543DE82EF95
_UNBASE = pow(_BASE, -1, 1 << 64)


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_POWERS.get("up", ())) < n:
        size = max(n, SLICE_BYTES + (1 << 16))
        for name, base in (("up", _BASE), ("down", _UNBASE)):
            run = np.full(size, base, np.uint64)
            run[0] = 1
            _POWERS[name] = np.cumprod(run, dtype=np.uint64)
    return _POWERS["up"][:n], _POWERS["down"][:n]


def prefix_sums(data: np.ndarray) -> np.ndarray:
    up, _ = _powers(len(data) + 1)
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_BYTE[data] * up[:-1], out=sums[1:])
    return sums


def span_hash(sums: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of the bytes of each span, independent of where the span stands."""
    _, down = _powers(len(sums))
    return mix64((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(np.uint64) * _ODD)


def window_hash(hashes: np.ndarray, rows: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every k consecutive entries of one row, and the index of each window's first entry."""
    n = len(hashes) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    first = np.flatnonzero(rows[:n] == rows[k - 1:])
    mixed = np.zeros(len(first), np.uint64)
    for i in range(k):
        mixed = mixed * U64(_BASE) + hashes[first + i]
    return mix64(mixed), first


def with_row_key(df: DataFrame, name: str = "_uid") -> DataFrame:
    """A written table with a unique long per row: later reads see the same keys, whatever happens to tasks."""
    return materialize(df.withColumn(name, F.monotonically_increasing_id()), "keyed")


def free_name(df: DataFrame, name: str) -> str:
    """``name``, lengthened until no column of ``df`` has it."""
    while name in df.columns:
        name += "_"
    return name


def keep_columns(df: DataFrame, *names: str) -> list:
    """Columns of ``df`` without helpers whose names would clash."""
    return [F.col(f"`{c}`") for c in df.columns if c not in names]


def discard(spark: SparkSession, *tables: DataFrame) -> None:
    """Delete written intermediate tables that later steps no longer read, and let go of the shuffle files behind them."""
    hadoop = spark.sparkContext._jsc.hadoopConfiguration()
    for table in tables:
        for folder in {f.rsplit("/", 1)[0] for f in table.inputFiles()}:
            path = spark._jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(hadoop).delete(path, True)
    collect_garbage(spark)


def collect_garbage(spark: SparkSession) -> None:
    """Let go of the driver's unused objects, and with them of shuffle files and broadcasts that nothing refers to."""
    gc.collect()
    release_memory()
    spark._jvm.System.gc()
