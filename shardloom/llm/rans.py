"""Token-ID files coded by a static range asymmetric numeral system (rANS).

Format. A file set holds blocks of whole documents in ascending document order. A block is coded by
itself: its ids are dealt round-robin to ``LANES`` interleaved coder states (id i belongs to lane
i mod LANES), all lanes share one word stream, and all blocks share one frequency table. States
are 64-bit in [2**32, 2**64), renormalised by 32-bit words; frequencies sum to 2**``SCALE_BITS``.
Coding runs from the last id to the first, so decoding runs forwards. Every ``CHECKPOINT`` steps
(of LANES ids) the block keeps a checkpoint: its first step, the place in the word stream and the
lane states, so that parts of a block can be decoded independently and in parallel. A CRC-32 over
the ids guards each checkpoint's part, one over the payload guards the block.

One row per block, in Parquet, written through Spark's committer (any file system, no partial
files after a lost task): ``block`` (ordinal), ``start`` (ids before it in the file set), ``n_ids``,
``docs`` (doc_id and n_tokens of each document, in order), ``payload``, ``payload_crc32``,
``checkpoints``. The frequency table is a table of its own beside the blocks.

Writing: token ids are made once and written; their counts, summed over all documents, give the
shared table; documents are range-partitioned by doc_id and every partition codes its blocks.
Block ordinals and starts come from the partitions' totals, one small row each.

Defined results: a null or empty text has the end id only; null doc_ids come first; rows of equal
doc_id are ordered by their ids; an empty table gives no block.
"""

from __future__ import annotations

import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shardloom.llm import common as C
from shardloom.llm import token_cache

LANES = 4096
SCALE_BITS = 20
CHECKPOINT = 64
BLOCK_IDS = 1 << 20
END_ID = 1
TOKEN_SLICE = 8 << 20  # bytes of text that are tokenized at once
LOW = np.uint64(1 << 32)


@dataclass(frozen=True)
class Table:
    """Quantised frequencies, their running sums, and the id of every slot."""

    frequency: np.ndarray
    start: np.ndarray
    of_slot: np.ndarray


def quantise(counts: np.ndarray, bits: int = SCALE_BITS) -> np.ndarray:
    """Frequencies that sum to 2**bits, at least 1 for every id that occurs."""
    total, seen = int(counts.sum()), counts > 0
    if not total:
        return np.zeros(len(counts), np.int64)
    if seen.sum() > 1 << bits:
        raise ValueError("more ids than slots")
    share = counts * ((1 << bits) / total)
    out = np.where(seen, np.maximum(1, np.floor(share)), 0).astype(np.int64)
    gap = (1 << bits) - int(out.sum())
    if gap > 0:  # to the largest remainders, then to the most frequent id
        order = np.lexsort((np.arange(len(out)), -(share - out)))
        order = order[seen[order]][:gap]
        out[order] += 1
        out[np.argmax(out)] += (1 << bits) - int(out.sum())
    while gap < 0:  # from the ids that can spare most
        order = np.lexsort((np.arange(len(out)), -out))
        order = order[out[order] > 1][:-gap]
        out[order] -= 1
        gap += len(order)
    return out


def table_of(frequency: np.ndarray) -> Table:
    start = np.cumsum(frequency) - frequency
    return Table(frequency.astype(np.uint64), start.astype(np.uint64), np.repeat(np.arange(len(frequency), dtype=np.uint16 if len(frequency) <= 1 << 16 else np.uint32), frequency))


def encode_block(ids: np.ndarray, table: Table, lanes: int = LANES, every: int = CHECKPOINT) -> tuple[bytes, list[dict]]:
    """Payload (little-endian 32-bit words) and checkpoints of one block."""
    steps = -(-len(ids) // lanes)
    state = np.full(lanes, LOW, np.uint64)
    words: list[np.ndarray] = []
    made, marks = 0, []
    shift, roof = np.uint64(SCALE_BITS), np.uint64(64 - SCALE_BITS)
    for step in range(steps - 1, -1, -1):
        part = ids[step * lanes:(step + 1) * lanes]
        n = len(part)
        f, c, x = table.frequency.take(part), table.start.take(part), state[:n]
        full = (x >> roof) >= f
        if full.any():
            out = (x[full] & np.uint64(0xFFFFFFFF)).astype("<u4")
            words.append(out[::-1])  # the stream is read back to front
            made += len(out)
            x[full] >>= np.uint64(32)
        whole = x // f
        state[:n] = (whole << shift) + (x - whole * f) + c
        if step % every == 0:
            crc = zlib.crc32(ids[step * lanes:(step + every) * lanes].astype("<u4").tobytes())
            marks.append((step, made, state.astype("<u8").tobytes(), crc))
    stream = np.concatenate(words)[::-1] if words else np.zeros(0, "<u4")
    return stream.astype("<u4").tobytes(), [{"step": s, "word": made - w, "states": x, "ids_crc32": crc} for s, w, x, crc in reversed(marks)]


def decode_block(payload: bytes, checkpoints: list[dict], n_ids: int, table: Table, lanes: int = LANES, every: int = CHECKPOINT,
                 parts: range | None = None) -> np.ndarray:
    """Ids of a block, or of the parts (by checkpoint number) asked for; raises on a checksum that does not fit."""
    stream = np.frombuffer(payload, "<u4").astype(np.uint64)
    out, mask, shift = [], np.uint64((1 << SCALE_BITS) - 1), np.uint64(SCALE_BITS)
    for number in parts if parts is not None else range(len(checkpoints)):
        mark = checkpoints[number]
        state, at = np.frombuffer(mark["states"], "<u8").astype(np.uint64), mark["word"]
        piece = []
        for step in range(mark["step"], min(mark["step"] + every, -(-n_ids // lanes))):
            x = state[:min(lanes, n_ids - step * lanes)]
            slot = x & mask
            ids = table.of_slot.take(slot.view(np.int64))
            x[:] = table.frequency.take(ids) * (x >> shift) + slot - table.start.take(ids)
            low = np.flatnonzero(x < LOW)
            x[low] = (x[low] << np.uint64(32)) | stream[at:at + len(low)]
            at += len(low)
            piece.append(ids)
        got = np.concatenate(piece)
        if zlib.crc32(got.astype("<u4").tobytes()) != mark["ids_crc32"]:
            raise ValueError(f"ids of checkpoint {number} do not fit their checksum")
        out.append(got)
    return np.concatenate(out) if out else np.zeros(0, table.of_slot.dtype)


# -- tables ----------------------------------------------------------------

COUNTS = -1  # in place of n_tokens, marks a partition's row of id counts
IDS_SCHEMA = "doc_id bigint, n_tokens bigint, ids binary"
BLOCK_SCHEMA = ("partition int, number int, n_ids bigint, docs array<struct<doc_id:bigint,n_tokens:bigint>>, payload binary, payload_crc32 bigint, "
                "checkpoints array<struct<step:int,word:bigint,states:binary,ids_crc32:bigint>>")


def token_ids(docs: DataFrame, path: str, size: int, end_id: int = END_ID) -> DataFrame:
    """(doc_id, n_tokens, ids) of all documents, ids as little-endian unsigned 16-bit with the end id.

    Each partition adds one row of ``COUNTS`` tokens that holds how often it has made each id.
    """
    def run(batches):
        tokens, total = token_cache.encoder(path), np.zeros(size, np.int64)
        for batch in C.joined(batches, TOKEN_SLICE):
            for part, _, _ in C.byte_slices(batch, "text", TOKEN_SLICE):
                ids, offsets = tokens.encode_rows(part.column("text"), end_id)
                total += np.bincount(ids, minlength=size)
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(np.diff(offsets)), C.binary_rows(ids, offsets)], names=["doc_id", "n_tokens", "ids"])
        yield pa.RecordBatch.from_arrays([pa.array([None], pa.int64()), pa.array([COUNTS]), pa.array([total.astype("<i8").tobytes()], pa.binary())],
                                         names=["doc_id", "n_tokens", "ids"])
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(run, IDS_SCHEMA)


def id_counts(ids: DataFrame, size: int) -> np.ndarray:
    """How often each id occurs in all documents: the partitions' counts, summed by id (``size`` sums reach the driver)."""
    def run(batches):
        total = np.zeros(size, np.int64)
        for batch in batches:
            data, _ = C.text_view(batch.column("ids"))
            total += np.frombuffer(data.tobytes(), "<i8").reshape(-1, size).sum(0)
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used, pa.int64()), pa.array(total[used])], names=["id", "n"])
    got = (ids.filter(F.col("n_tokens") == COUNTS).select("ids").mapInArrow(run, "id bigint, n bigint")
           .groupBy("id").agg(F.sum("n").alias("n")).collect())
    counts = np.zeros(size, np.int64)
    for r in got:
        counts[r["id"]] = r["n"]
    return counts


def _blocks(shared, block_ids: int):
    def run(batches):
        table, partition, number = shared.value, TaskContext.get().partitionId(), 0
        docs, held, size = [], [], 0

        def close():
            ids = np.frombuffer(b"".join(held), "<u2")
            payload, marks = encode_block(ids, table)
            return pa.RecordBatch.from_pylist(
                [{"partition": partition, "number": number, "n_ids": len(ids), "docs": list(docs), "payload": payload,
                  "payload_crc32": zlib.crc32(payload), "checkpoints": marks}], schema=_BLOCK_ARROW)

        for batch in batches:
            for doc, n, ids in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "n_tokens", "ids"))):
                docs.append({"doc_id": doc, "n_tokens": n})
                held.append(ids)
                size += n
                if size >= block_ids:
                    yield close()
                    docs, held, size, number = [], [], 0, number + 1
        if docs:
            yield close()
    return run


_BLOCK_ARROW = pa.schema([("partition", pa.int32()), ("number", pa.int32()), ("n_ids", pa.int64()),
                          ("docs", pa.list_(pa.struct([("doc_id", pa.int64()), ("n_tokens", pa.int64())]))), ("payload", pa.binary()),
                          ("payload_crc32", pa.int64()),
                          ("checkpoints", pa.list_(pa.struct([("step", pa.int32()), ("word", pa.int64()), ("states", pa.binary()), ("ids_crc32", pa.int64())])))])


def write_tokens(docs: DataFrame, path: str, folder: str, end_id: int = END_ID, block_ids: int = BLOCK_IDS) -> None:
    """Encode all documents (doc_id, text) into the file set ``folder`` (``blocks``, ``frequency``, ``starts``)."""
    from tokenizers import Tokenizer
    spark = docs.sparkSession
    size = max(Tokenizer.from_file(path).get_vocab_size(with_added_tokens=True), end_id + 1)
    made = C.materialize(token_ids(docs, path, size, end_id), "ids")
    frequency = quantise(id_counts(made, size))
    ids = made.filter(F.col("n_tokens") != COUNTS)
    spark.createDataFrame([(int(i), int(f)) for i, f in enumerate(frequency) if f], "id int, frequency int").coalesce(1).write.mode("overwrite").parquet(f"{folder}/frequency")
    shared = spark.sparkContext.broadcast(table_of(frequency))  # 2**SCALE_BITS slots and the vocabulary
    total = ids.agg(F.sum("n_tokens")).first()[0] or 0
    ranges = max(1, min(100_000, -(-total // (8 * block_ids))))
    ordered = ids.repartitionByRange(ranges, "doc_id").sortWithinPartitions("doc_id", "ids")
    ordered.mapInArrow(_blocks(shared, block_ids), BLOCK_SCHEMA).write.option("compression", "none").mode("overwrite").parquet(f"{folder}/blocks")
    C.discard(spark, made)
    sums = spark.read.parquet(f"{folder}/blocks").groupBy("partition").agg(F.count("*").alias("blocks"), F.sum("n_ids").alias("n")).orderBy("partition").collect()
    before, rows = (0, 0), []
    for r in sums:  # one row per range
        rows.append((r["partition"], before[0], before[1]))
        before = (before[0] + r["blocks"], before[1] + r["n"])
    spark.createDataFrame(rows, "partition int, first_block bigint, first_id bigint").coalesce(1).write.mode("overwrite").parquet(f"{folder}/starts")


def blocks_of(spark: SparkSession, folder: str) -> DataFrame:
    """The blocks of a file set with their ordinal and start."""
    from pyspark.sql import Window
    blocks = spark.read.schema(BLOCK_SCHEMA).parquet(f"{folder}/blocks")
    # Block headers only (no payload), a few per range: the window never sees more than a range's blocks.
    heads = blocks.select("partition", "number", "n_ids")
    earlier = F.coalesce(F.sum("n_ids").over(Window.partitionBy("partition").orderBy("number").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    starts = spark.read.schema("partition int, first_block bigint, first_id bigint").parquet(f"{folder}/starts")
    placed = (heads.withColumn("earlier", earlier).join(starts, "partition")
              .select("partition", "number", (F.col("first_block") + F.col("number")).alias("block"), (F.col("first_id") + F.col("earlier")).alias("start")))
    return blocks.join(placed, ["partition", "number"])


def read_tokens(spark: SparkSession, folder: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids) of a file set, blocks decoded in parallel and checked; ids are little-endian unsigned 32-bit."""
    rows = spark.read.parquet(f"{folder}/frequency").collect()  # at most the vocabulary
    frequency = np.zeros(max((r["id"] for r in rows), default=0) + 1, np.int64)
    for r in rows:
        frequency[r["id"]] = r["frequency"]
    shared = spark.sparkContext.broadcast(table_of(frequency))

    def run(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1).to_pylist()[0]
                if zlib.crc32(row["payload"]) != row["payload_crc32"]:
                    raise ValueError(f"block {row['block']} is damaged")
                ids = decode_block(row["payload"], row["checkpoints"], row["n_ids"], shared.value).astype("<u4").tobytes()
                n = np.array([d["n_tokens"] for d in row["docs"]], np.int64)
                ends = np.cumsum(n)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([d["doc_id"] for d in row["docs"]], pa.int64()), pa.array(row["start"] + ends - n), pa.array(n),
                     pa.array([ids[4 * (e - k):4 * e] for e, k in zip(ends.tolist(), n.tolist())], pa.binary())], names=["doc_id", "start", "n_tokens", "ids"])
    # Blocks are the unit of parallel decoding; the join above only moves headers if it can be broadcast.
    return blocks_of(spark, folder).mapInArrow(run, "doc_id bigint, start bigint, n_tokens bigint, ids binary")
