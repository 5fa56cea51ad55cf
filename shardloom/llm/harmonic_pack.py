"""Harmonic packing of token sequences, independently in every partition.

Harmonic packing sorts lengths into reciprocal-capacity classes: class k holds lengths up to
capacity / k, and each of its bins takes exactly k of them. Documents may be cut freely here, so
they are cut to lengths that fill their class to the brim: a document gives pieces of the full
capacity and, from the rest, one piece of capacity / 2**m for each power of two in it. A bin of
class 2**m is closed by its 2**m-th piece and has no padding. Nothing is exchanged between
partitions; a partition's last open bins are paired upwards from the smallest class, which leaves
at most one short sequence per class, each of a power of two of tokens.

Defined results: a null or empty text has its end id only (one piece of length 1); an empty table
gives no piece; repeated rows are packed each. ``sequence_id`` is unique (partition number and a
count within it), stable as long as the input's partitions are.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shardloom.llm import common as C
from shardloom.llm import token_cache

CAPACITY = 1024
END_ID = 0
# Where packing shares its workers with other stages; results do not depend on either.
TOKEN_SLICE = 2 << 20  # bytes of text that are tokenized at once
CACHE_PARTS = 150_000  # of the token cache
FIELDS = ["doc_id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset"]
SCHEMA = "doc_id bigint, start bigint, length bigint, ids binary, doc_tokens bigint, sequence_id bigint, offset bigint"

Piece = tuple[int | None, int, int, bytes, int]  # doc_id, start, length, ids, doc_tokens


def cut_lengths(n: int, capacity: int = CAPACITY) -> list[int]:
    """Piece lengths of a document of n ids: full ones, then falling powers of two."""
    rest = n % capacity
    return [capacity] * (n // capacity) + [1 << b for b in range(capacity.bit_length() - 2, -1, -1) if rest >> b & 1]


class Bins:
    """Open bins of one partition, by piece length."""

    def __init__(self, capacity: int = CAPACITY):
        if capacity & (capacity - 1):
            raise ValueError("the capacity has to be a power of two")
        self.capacity = capacity
        self.open: dict[int, list[Piece]] = {}

    def add(self, piece: Piece) -> list[Piece] | None:
        """The pieces of the bin that this piece closes, if it does."""
        size = piece[2]
        if size == self.capacity:
            return [piece]
        held = self.open.setdefault(size, [])
        held.append(piece)
        if len(held) * size == self.capacity:
            self.open[size] = []
            return held
        return None

    def rest(self) -> Iterator[list[Piece]]:
        """What is open at the end: pairs move up a class; odd ones out are sequences of their own."""
        size, carried = 1, []
        while size < self.capacity:
            groups = [[p] for p in self.open.get(size, [])] + carried
            carried = [groups[i] + groups[i + 1] for i in range(0, len(groups) - 1, 2)]
            if len(groups) % 2:
                yield groups[-1]
            size *= 2
        yield from carried


def _pack(path: str, capacity: int, end_id: int, cache_parts: int, token_slice: int):
    def pack(batches):
        tokens, bins = token_cache.encoder(path, cache_parts), Bins(capacity)
        partition, made = TaskContext.get().partitionId(), 0
        rows: list[tuple] = []

        def close(pieces: list[Piece]):
            nonlocal made
            offset = 0
            for doc, start, length, ids, total in pieces:
                rows.append((doc, start, length, ids, total, (partition << 32) | made, offset))
                offset += length
            made += 1

        def flush():
            columns = list(zip(*rows)) if rows else [()] * len(FIELDS)
            rows.clear()
            return pa.RecordBatch.from_arrays([pa.array(c, pa.binary() if f == "ids" else pa.int64()) for c, f in zip(columns, FIELDS)], names=FIELDS)

        for batch in C.joined(batches, token_slice):
            for part, _, _ in C.byte_slices(batch, "text", token_slice):
                flat, offsets = tokens.encode_rows(part.column("text"), end_id)
                body, at = flat.astype("<u4").tobytes(), offsets.tolist()
                for doc, first, last in zip(part.column("doc_id").to_pylist(), at, at[1:]):
                    total, start = last - first, 0
                    for length in cut_lengths(total, capacity):
                        byte = 4 * (first + start)
                        full = bins.add((doc, start, length, body[byte:byte + 4 * length], total))
                        start += length
                        if full:
                            close(full)
                if len(rows) > 2000:
                    yield flush()
        for pieces in bins.rest():
            close(pieces)
        if rows:
            yield flush()
    return pack


def pack_documents(docs: DataFrame, path: str, capacity: int = CAPACITY, end_id: int = END_ID, cache_parts: int = CACHE_PARTS,
                   token_slice: int = TOKEN_SLICE) -> DataFrame:
    """Pieces (``FIELDS``) of all documents (doc_id, text); ``ids`` are little-endian unsigned 32-bit."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(_pack(path, capacity, end_id, cache_parts, token_slice), SCHEMA)


def piece_digests(pieces: DataFrame) -> DataFrame:
    """The pieces without their ids, which a checksum stands for."""
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")
