"""Packed token sequences as little-endian uint16 payloads.

Primary form: a Parquet table ``(split, seq_id, payload BINARY)``, one sequence per row, written
by Spark's own committer (any file system; a lost task or a crashed write leaves nothing that a
reader sees) and range-partitioned by (split, seq_id). Ids above 65,535 are rejected.

Interop: headerless uint16 files. They are read by byte ranges of whole sequences (any length of file, several
tasks a file) in name order, as one stream per folder. They are written by Spark's text committer, whose
rows are raw bytes; the line separator is the id 0 (<pad>) after each sequence, so the stream's unit is a
sequence and one pad.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .rawfiles import RANGE_BYTES, byte_ranges, list_raw, open_raw

UINT16_MAX = 65_535
SCHEMA = "split string, seq_id bigint, tokens array<int>"


def _payloads(batches):
    for batch in batches:
        tokens = batch.column("tokens")
        flat, edge = tokens.flatten().to_numpy(), tokens.offsets.to_numpy()
        if len(flat) and (flat.min() < 0 or flat.max() > UINT16_MAX):
            raise ValueError("token id out of uint16 range")
        at = ((edge - edge[0]) * 2).astype(np.int32)
        payload = pa.Array.from_buffers(pa.binary(), len(tokens), [None, pa.py_buffer(at), pa.py_buffer(flat.astype("<u2"))])
        yield pa.RecordBatch.from_arrays([batch.column("split"), batch.column("seq_id"), payload], names=["split", "seq_id", "payload"])


def write_packed(packed: DataFrame, path: str, num_partitions: int | None = None) -> None:
    """(split, seq_id, tokens) -> payload table, sorted; replaces what is there once all is written."""
    n = num_partitions or int(packed.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = packed.select("split", "seq_id", "tokens").mapInArrow(_payloads, "split string, seq_id bigint, payload binary")
    rows.repartitionByRange(n, "split", "seq_id").sortWithinPartitions("split", "seq_id").write.mode("overwrite").parquet(path)


def _tokens(batches):
    for batch in batches:
        payload = batch.column("payload")
        edge = np.frombuffer(payload.buffers()[1], np.int32, len(payload) + 1, payload.offset * 4)
        flat = np.frombuffer(payload.buffers()[2] or b"", "<u2", (edge[-1] - edge[0]) // 2, edge[0]).astype(np.int32)
        tokens = pa.ListArray.from_arrays(pa.array((edge - edge[0]) // 2, pa.int32()), pa.array(flat))
        yield pa.RecordBatch.from_arrays([batch.column("split"), batch.column("seq_id"), tokens], names=["split", "seq_id", "tokens"])


def read_packed(spark: SparkSession, path: str) -> DataFrame:
    """The sequences of a payload table as (split, seq_id, tokens)."""
    return spark.read.schema("split string, seq_id bigint, payload binary").parquet(path).mapInArrow(_tokens, SCHEMA)


def packed_sizes(spark: SparkSession, path: str) -> DataFrame:
    """(split, length in bytes) of a payload table."""
    table = spark.read.schema("split string, seq_id bigint, payload binary").parquet(path)
    return table.groupBy("split").agg(F.sum(F.octet_length("payload")).cast("long").alias("length"))


PAD = "\x00\x00"                   # id 0 as two bytes


def write_headerless(packed: DataFrame, path: str, num_partitions: int | None = None) -> None:
    """(split, seq_id, tokens) -> headerless files in a folder per split, in order; each sequence is followed by one id 0."""
    n = num_partitions or int(packed.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = packed.select("split", "seq_id", "tokens").mapInArrow(_payloads, "split string, seq_id bigint, payload binary")
    (rows.repartitionByRange(n, "split", "seq_id").sortWithinPartitions("split", "seq_id")
     .select("split", F.col("payload").cast("string").alias("value"))
     .write.mode("overwrite").option("lineSep", PAD).partitionBy("split").text(path))


def read_headerless(spark: SparkSession, path: str, seq_len: int, pattern: str = "*.bin", padded: bool = False,
                    range_bytes: int = RANGE_BYTES) -> DataFrame:
    """Sequences of headerless uint16 files as (path, seq_id, tokens); ids run on across the files of a folder in name order.

    ``padded`` files have one more id after each sequence, which is left out. A rest shorter than a unit at the
    end of a file is not a sequence.
    """
    unit = 2 * (seq_len + padded)

    def cut(batches):
        for batch in batches:
            for name, before, start, size in zip(*(batch.column(c).to_pylist() for c in ("path", "before", "start", "size"))):
                with open_raw(name) as f:
                    f.seek(start)
                    content = f.read(size)
                if len(content) != size:
                    raise ValueError(f"{name} has become shorter")
                n = size // unit
                flat = np.frombuffer(content, "<u2").reshape(n, unit // 2)[:, :seq_len].astype(np.int32).ravel()
                tokens = pa.ListArray.from_arrays(pa.array(np.arange(n + 1) * seq_len, pa.int32()), pa.array(flat))
                ids = np.arange(n) + before + start // unit
                yield pa.RecordBatch.from_arrays([pa.array([name] * n, pa.string()), pa.array(ids), tokens], names=["path", "seq_id", "tokens"])

    files = list_raw(spark, path, pattern).withColumn("folder", F.regexp_extract("path", "^(.*)/[^/]*$", 1))
    w = Window.partitionBy("folder").orderBy("path").rowsBetween(Window.unboundedPreceding, -1)      # one row per file of the folder
    units = F.floor(F.col("length") / unit)
    numbered = files.select("path", "length", F.coalesce(F.sum(units).over(w), F.lit(0)).cast("long").alias("before"))
    ranges = byte_ranges(numbered, unit, range_bytes).select("path", "before", "start", "size")
    return ranges.mapInArrow(cut, "path string, seq_id bigint, tokens array<int>")
