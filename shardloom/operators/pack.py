"""Split assignment, token offsets, sequence packing and training examples.

Input is a token table with one row per line:
``(split, shard_id, doc_id, line_idx, tokens ARRAY<INT>, n_tokens INT)``; lines are
ordered by (shard_id, doc_id, line_idx) inside a split, as the shards are concatenated.

Packing never explodes single tokens: each line is cut into at most
``n_tokens / L + 2`` fragments (one per sequence it touches) and a sequence is
reassembled with ``collect_list`` of at most L tokens, so no group grows with the data.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .ordinal import global_ordinal

SEQ_LEN = 512
UINT16_MAX = 65_535


def shard_tokens(tok: DataFrame) -> DataFrame:
    """Tokens per shard and the running total in (split, shard_id) order.

    The per-shard table has one row per shard, so the running window is small.
    """
    per = tok.groupBy("split", "shard_id").agg(F.sum("n_tokens").cast("long").alias("tokens"))
    w = Window.partitionBy("split").orderBy("shard_id").rowsBetween(Window.unboundedPreceding, 0)
    return per.withColumn("running_tokens", F.sum("tokens").over(w).cast("long"))


def token_offsets(tok: DataFrame) -> DataFrame:
    """K1: position of each line's first token in its split's token stream.

    offset = tokens of earlier shards of the split (small per-shard table, prefix sum)
           + tokens of earlier lines of the shard (window per shard, bounded by shard size).
    """
    per = tok.groupBy("split", "shard_id").agg(F.sum("n_tokens").cast("long").alias("_st"))
    w = Window.partitionBy("split").orderBy("shard_id").rowsBetween(Window.unboundedPreceding, -1)
    # One row per shard; AQE broadcasts it at runtime when its measured size allows.
    shard_off = per.select("split", "shard_id", F.coalesce(F.sum("_st").over(w), F.lit(0)).cast("long").alias("_so"))
    # Join and window share the key (split, shard_id): the token arrays are shuffled once.
    wl = Window.partitionBy("split", "shard_id").orderBy("doc_id", "line_idx").rowsBetween(Window.unboundedPreceding, -1)
    inner = F.coalesce(F.sum("n_tokens").over(wl), F.lit(0)).cast("long")
    return (tok.join(shard_off, ["split", "shard_id"], "inner")
            .withColumn("offset", F.col("_so") + inner).drop("_so"))


def split_totals(tok: DataFrame) -> DataFrame:
    """Tokens per split, from the token table's counts alone."""
    return tok.groupBy("split").agg(F.sum("n_tokens").cast("long").alias("split_tokens"))


#: Sequence numbers that one row stands for until it is dealt out.
NUMBERS_AT_ONCE = 16_384


def sequence_numbers(tok: DataFrame, seq_len: int = SEQ_LEN) -> DataFrame:
    """(split, seq_id) of every packed sequence: floor(tokens / seq_len) per split, no token is touched.

    A split is a row, so its numbers are first cut into blocks, which are dealt to all tasks."""
    n = F.floor(F.col("split_tokens") / seq_len).cast("long")
    numbers = lambda first, last, step: F.explode(F.sequence(first, last, F.lit(step).cast("long")))
    blocks = split_totals(tok).filter(n > 0).select("split", n.alias("_n"), numbers(F.lit(0).cast("long"), n - 1, NUMBERS_AT_ONCE).alias("_first"))
    tasks = int(tok.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    last = F.least(F.col("_first") + NUMBERS_AT_ONCE, F.col("_n")) - 1
    return blocks.repartition(tasks).select("split", numbers(F.col("_first"), last, 1).alias("seq_id"))


def _windows(offsets: DataFrame, seq_len: int, width: int) -> DataFrame:
    """Cut lines into fragments of windows [s*L, s*L + width) and reassemble each window."""
    off, n = F.col("offset"), F.col("n_tokens").cast("long")
    first = F.greatest(F.floor((off - width) / seq_len) + 1, F.lit(0)).cast("long")
    last = F.floor((off + n - 1) / seq_len).cast("long")
    frag = (offsets.filter(n > 0)
            .select("split", "offset", "tokens", "n_tokens",
                    F.explode(F.sequence(first, last)).alias("seq_id")))
    start = F.greatest(F.col("seq_id") * seq_len, F.col("offset"))
    end = F.least(F.col("seq_id") * seq_len + width, F.col("offset") + F.col("n_tokens"))
    frag = frag.filter(end > start).select(
        "split", "seq_id",
        F.struct(start.alias("pos"),
                 F.slice("tokens", (start - F.col("offset") + 1).cast("int"), (end - start).cast("int")).alias("t"))
        .alias("f"))
    seqs = frag.groupBy("split", "seq_id").agg(F.array_sort(F.collect_list("f")).alias("fs"))
    return seqs.select("split", "seq_id", F.flatten(F.transform("fs", lambda x: x["t"])).alias("tokens"))


def pack_sequences(offsets: DataFrame, seq_len: int = SEQ_LEN) -> DataFrame:
    """K2: fixed-length sequences across document and shard boundaries; tail dropped."""
    return _windows(offsets, seq_len, seq_len).filter(F.size("tokens") == seq_len)


def pack_stats(packed: DataFrame, seq_len: int = SEQ_LEN) -> DataFrame:
    """Sequences, tokens and size per split (2 bytes per token)."""
    return packed.groupBy("split").agg(F.count(F.lit(1)).alias("sequences")).select(
        "split", "sequences", (F.col("sequences") * seq_len).cast("long").alias("tokens"),
        (F.col("sequences") * seq_len * 2 / 1e9).alias("size_gb"))


def next_token_pairs(offsets: DataFrame, tok: DataFrame, seq_len: int = SEQ_LEN) -> DataFrame:
    """K4: x = sequence s, y = x shifted by one incl. the first token of sequence s+1.

    ``tok`` is the token table that ``offsets`` was made from (its counts give the split totals).

    Built as windows of L+1 tokens at stride L in the same single shuffle as packing
    (no self-join). Only windows inside the packed region count, so a split yields
    floor(T/L) - 1 examples, like the original loader.
    """
    tot = split_totals(tok)
    win = _windows(offsets, seq_len, seq_len + 1).join(F.broadcast(tot), "split")
    keep = (F.size("tokens") == seq_len + 1) & \
        (F.col("seq_id") < F.floor(F.col("split_tokens") / seq_len) - 1)
    return win.filter(keep).select("split", "seq_id",
                                   F.slice("tokens", 1, seq_len).alias("x"),
                                   F.slice("tokens", 2, seq_len).alias("y"))


# A keyed permutation of 0 .. n - 1 without a sort. A number x < a * b, a = ceil(sqrt n), b = ceil(n / a), is a pair (x div b,
# x mod b); each round adds a keyed mix of one part to the other, modulo a or b, which can be undone, so all rounds
# together permute the a * b pairs. Fewer than a of them are n or more; a number that comes out there goes in
# again until it is below n (cycle walking), which leaves a permutation of 0 .. n - 1.
_ROUNDS = 4
_WALK = 64                    # enough for every n up to 4,096; beyond, a walk of 64 has probability n ** -32


def _mix(x: Column, key: int) -> Column:
    """32 bits of the MD5 of the number and the key; ``x`` is mentioned once, so that rounds can be nested."""
    return F.conv(F.substring(F.md5(F.concat(x.cast("string"), F.lit(f":{key}"))), 1, 8), 16, 10).cast("long")


def round_keys(seed: int, epoch: int) -> list[int]:
    return [(seed * 7919 + epoch * 104729 + i * 1299709 + 12345) % (1 << 31) for i in range(_ROUNDS)]


def permuted(x: Column, n: Column, seed: int, epoch: int) -> Column:
    """Image of ``x`` under the permutation of 0 .. n - 1 that (seed, epoch) names; an error for an x outside."""
    a = F.ceil(F.sqrt(n)).cast("long")
    b = F.ceil(n / a)

    def once(v: Column) -> Column:
        left, right = F.floor(v / b), v % b      # v < 2**53: the quotient's floor is exact
        for i, key in enumerate(round_keys(seed, epoch)):
            if i % 2:
                right = (right + _mix(left, key)) % b
            else:
                left = (left + _mix(right, key)) % a
        return left * b + right

    first = once(x)
    walked = F.aggregate(F.sequence(F.lit(2), F.lit(_WALK)), first, lambda v, _: F.when(v < n, v).otherwise(once(v)))
    return (F.when((x < 0) | (x >= n), F.raise_error(F.lit("sequence ids are not 0 to n - 1")).cast("long"))
            .when(first < n, first).when(walked < n, walked).otherwise(F.raise_error(F.lit("the walk does not end")).cast("long")))


def training_batches(packed: DataFrame, batch_size: int, seed: int = 0, epoch: int = 0, shuffle_splits=("train",),
                     order_key: Column | None = None) -> DataFrame:
    """K5: shuffled train batches (ragged batch dropped), ordered other splits (kept).

    With an ``order_key`` the sequences are sorted by it, and their places come from ``global_ordinal`` (range partitioned,
    never a single task for a whole split). Without one a sequence's place is a keyed permutation of its number, so no row
    is sorted, shuffled or written; sequence ids then run from 0 in each split. Only the count of each split
    (one row per split, broadcast) is made besides.
    """
    shuffled = F.col("split").isin(list(shuffle_splits))
    rows = packed.select("split", "seq_id")
    if order_key is not None:
        keyed = rows.withColumn("_k", F.when(shuffled, order_key.cast("string")).otherwise(F.lit("")))
        rows = global_ordinal(keyed, ["split"], ["_k", "seq_id"], "ordinal").drop("_k")
    counts = rows.groupBy("split").agg(F.count(F.lit(1)).alias("_n"))
    rows = rows.join(F.broadcast(counts), "split")
    if order_key is None:
        rows = rows.withColumn("ordinal", F.when(shuffled, permuted(F.col("seq_id"), F.col("_n"), seed, epoch)).otherwise(F.col("seq_id")))
    rows = rows.withColumn("batch_id", ((F.col("ordinal") - F.col("ordinal") % batch_size) / batch_size).cast("long"))
    full = ((F.col("_n") - F.col("_n") % batch_size) / batch_size).cast("long")
    return rows.filter(~shuffled | (F.col("batch_id") < full)).select("split", "seq_id", "ordinal", "batch_id")


def check_uint16(tok: DataFrame) -> DataFrame:
    """Rows whose ids do not fit the uint16 binary format (must be empty before S9)."""
    return tok.filter(F.exists("tokens", lambda t: (t < 0) | (t > UINT16_MAX)))


def splits_to_pack(splits: DataFrame, existing: DataFrame, seq_len: int = SEQ_LEN) -> DataFrame:
    """Splits whose packed output does not already validate (K3) still need packing.

    ``splits``: (split); ``existing``: (split, length) of packed outputs already on disk.
    """
    from .integrity import validate_bin
    valid, _, _ = validate_bin(F.col("length"), F.col("length").isNotNull(), seq_len)
    ok = existing.filter(valid).select("split")
    return splits.join(ok, "split", "left_anti")
