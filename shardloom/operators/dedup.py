"""Exact deduplication on SHA-1 of cleaned text (D1 per shard, D2 global).

Most texts occur once, so the work goes to the others:

1. A hash aggregation over narrow rows (scope, 20-byte hash, one fixed-width position), combined map-side, finds
   the hashes that occur more than once and their first position. This table of repeated hashes is written.
2. A Bloom filter of its keys, ``FILTER_BITS`` bits at most whatever the data, goes to every task. A row that the filter
   does not know is unique: it is kept where it is, it is neither shuffled nor sorted.
3. The other rows (the repeated ones and a few false alarms) are joined with the repeated hashes and kept if theirs is
   not there or their position is the first.

The input has to be a written table (it is read twice).
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import materialize

#: Line numbers and ordinals that one position holds (checked, not assumed).
LINES_PER_DOC = 10**10
DOCS_PER_SOURCE = 10**15


def _wide(c: Column) -> Column:
    return c.cast("decimal(38,0)")


def line_position(ordinal: Column, line_idx: Column, group: Column | None = None) -> Column:
    """(group,) ordinal and line number as one decimal that sorts like them."""
    room = (line_idx < LINES_PER_DOC) & (ordinal < DOCS_PER_SOURCE)
    pos = _wide(ordinal) * F.lit(LINES_PER_DOC) + _wide(line_idx)
    if group is not None:
        pos = _wide(group) * F.lit(LINES_PER_DOC).cast("decimal(38,0)") * F.lit(DOCS_PER_SOURCE) + pos
    return F.when(room, pos.cast("decimal(38,0)")).otherwise(F.raise_error(F.lit("a position does not fit")).cast("decimal(38,0)"))


#: Bound of the filter (8 MB); beyond some ten million repeated hashes it lets more and more rows through to the join.
FILTER_BITS = 1 << 26
_PROBES = 4


def _probes(hashes: np.ndarray, bits: int) -> list[np.ndarray]:
    """The filter's bits of each 64-bit hash: ``bits`` is a power of two, the step is odd."""
    first = hashes.view(np.uint64)
    step = (first >> np.uint64(32)) | np.uint64(1)
    return [((first + np.uint64(i) * step) & np.uint64(bits - 1)).astype(np.int64) for i in range(_PROBES)]


def bloom_filter(hashes: DataFrame, bits: int) -> np.ndarray:
    """Packed bits set by the 64-bit hashes of a one-column table: tasks list the bytes they set, Spark joins them."""
    def run(batches):
        for batch in batches:
            at = np.unique(np.concatenate(_probes(batch.column(0).to_numpy(), bits)))
            place, first = np.unique(at >> 3, return_index=True)
            value = np.bitwise_or.reduceat(np.left_shift(1, at & 7), first) if len(at) else at
            yield pa.RecordBatch.from_arrays([pa.array(place), pa.array(value)], names=["place", "value"])

    packed = hashes.mapInArrow(run, "place bigint, value bigint").groupBy("place").agg(F.bit_or("value").alias("value")).toArrow()
    out = np.zeros(bits >> 3, np.uint8)
    out[packed["place"].to_numpy()] = packed["value"].to_numpy()      # at most FILTER_BITS / 8 rows
    return out


def may_be_in(filter_bits: np.ndarray, spark) -> Column:
    """A function of a 64-bit hash column: False means that the filter has never seen it."""
    shared = spark.sparkContext.broadcast(filter_bits)

    @F.arrow_udf("boolean")
    def test(hashes: pa.Array) -> pa.Array:
        known = np.ones(len(hashes), bool)
        for at in _probes(hashes.to_numpy(zero_copy_only=False), len(shared.value) << 3):
            known &= (shared.value[at >> 3] >> (at & 7).astype(np.uint8) & 1).astype(bool)
        return pa.array(known)

    return test


def repeated_hashes(narrow: DataFrame, scope_cols: list[str]) -> DataFrame:
    """(scope, _key, _first) of the hashes that occur more than once."""
    return (narrow.groupBy(*scope_cols, "_key").agg(F.min("_pos").alias("_first"), F.count(F.lit(1)).alias("_n"))
            .filter("_n > 1").drop("_n"))


def dedup_first(kept: DataFrame, scope_cols: list[str], position: Column, hash_col: str = "sha1") -> DataFrame:
    """Rows of ``kept`` whose ``position`` is the first of their (scope, hash) group; ``position`` is unique."""
    spark = kept.sparkSession
    keyed = kept.withColumn("_key", F.unhex(hash_col)).withColumn("_pos", position)
    repeated = materialize(repeated_hashes(keyed.select(*scope_cols, "_key", "_pos"), scope_cols), "repeated")
    n = repeated.count()
    if not n:
        return kept
    bits = 1 << int(np.clip(np.ceil(np.log2(16 * n)), 10, np.log2(FILTER_BITS)))
    mark = F.xxhash64(*scope_cols, "_key")
    known = may_be_in(bloom_filter(repeated.select(mark.alias("h")), bits), spark)
    marked = keyed.withColumn("_seen", known(mark))
    alone = marked.filter(~F.col("_seen")).select(*kept.columns)
    rest = marked.filter("_seen").join(repeated, [*scope_cols, "_key"], "left")
    return alone.unionByName(rest.filter(F.col("_first").isNull() | (F.col("_first") == F.col("_pos"))).select(*kept.columns))


def dedup_shard(cleaned: DataFrame) -> DataFrame:
    """First occurrence in line order of each cleaned text within its shard."""
    return dedup_first(cleaned.filter("kept"), ["shard_id"], line_position(F.col("doc_ordinal"), F.col("line_idx")))


def dedup_global(cleaned: DataFrame) -> DataFrame:
    """First occurrence in corpus order (shard_id, document, line) across all shards."""
    kept = cleaned.filter("kept")
    spark = cleaned.sparkSession
    prefix = F.concat_ws("__", "source", "split", F.lit(""))
    # The registry bounds the number of (source, split) pairs; their order is that of the shard ids.
    names = sorted(r[0] for r in cleaned.select(prefix.alias("p")).distinct().collect())
    ranks = spark.createDataFrame(list(enumerate(names)) or [(0, "")], "_rank int, _prefix string")
    ranked = kept.withColumn("_prefix", prefix).join(F.broadcast(ranks), "_prefix")
    return dedup_first(ranked, [], line_position(F.col("doc_ordinal"), F.col("line_idx"), F.col("_rank"))).drop("_rank", "_prefix")
