"""Exact removal of repeated byte strings by bucket-pointer refinement.

Every suffix of every text falls into a bucket named by its first bytes. Buckets are refined by
the names of the buckets at later offsets: the name for ``2q`` bytes is the pair of the names for
``q`` bytes at ``i`` and at ``i + q``, so each round reuses the names the round before gave
(``bucket_names``, from 8 to ``Q`` bytes). Longer names, of whole segments and of ``LENGTH`` bytes, are
rolling fingerprints of the bytes and not refined from bucket names. Names are 64-bit fingerprints of the prefix, not dense ranks: equal prefixes
get equal names in any task, without an exchange between the rounds. Names for ``LENGTH`` bytes
that occur once settle their suffix; names that occur again mark ``LENGTH`` bytes for removal.

Only a sparse set of suffixes goes through the shuffles. Each window of ``LENGTH`` bytes is
represented by the suffix with the smallest mixed name for ``Q`` bytes inside it (leftmost of
equals), which depends on the window's bytes alone; equal windows have equal representatives at
equal offsets. Refinement then runs over buckets of representatives:

1. bucket by the name for ``Q`` bytes: a representative alone in its bucket has no repeated window;
2. refine by the name of its whole segment (all bytes of the windows it represents): a segment
   that occurs again is repeated as a whole;
3. refine the segments left in mixed buckets window by window, on the names for ``LENGTH`` bytes.

Counting is a map-side combined aggregation, so a passage in a third of all documents costs one
row per task; per-document work is joined on a 128-bit key of the text.

Defined results: null and empty texts, and texts shorter than ``LENGTH``, keep all their bytes and
have no span; matches never cross texts; overlapping matches and copies of a row count as repeats
of each other, and nothing is kept of a string that repeats (the input alone decides).
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from shardloom.llm import common as C

LENGTH = 200
Q = 32
_STEP = np.uint64(0x9E3779B97F4A7C15)


def refine(names: np.ndarray, offset: int) -> np.ndarray:
    """Names of buckets refined by the bucket names ``offset`` bytes later."""
    n = len(names) - offset
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = names[:n] * np.uint64(0xD1342543DE82EF95)
    out += names[offset:]
    out ^= out >> np.uint64(29)
    out *= np.uint64(0xBF58476D1CE4E5B9)
    out ^= out >> np.uint64(32)
    return out


def bucket_names(data: np.ndarray, lengths: list[int]) -> dict[int, np.ndarray]:
    """Names of all suffixes for each prefix length asked for (ascending), by recursive refinement from 8 bytes."""
    wide = data.astype(np.uint64)
    names = np.zeros(max(len(data) - 7, 0), np.uint64)
    for i in range(8):
        names |= wide[i:i + len(names)] << np.uint64(8 * i)
    names, known, out = C.mix64(names), 8, {}
    for target in lengths:
        while known < target:
            step = min(known, target - known)
            names = refine(names, step)
            known += step
        out[target] = names
    return out


def representatives(names: np.ndarray, offsets: np.ndarray, length: int = LENGTH, q: int = Q) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Position of each representative suffix, and the first and last window start it stands for."""
    width = length - q + 1  # suffixes a window chooses from
    n = len(names) - width + 1
    first, last = offsets[:-1], offsets[1:] - length
    first, last = first[last >= first], last[last >= first]
    none = np.zeros(0, np.int64)
    if n <= 0 or not len(first):
        return none, none, none
    # Sliding minimum over `width` names, from the running minima of blocks seen from both sides.
    blocks = np.concatenate([names, np.full((-len(names)) % width, np.uint64(2**64 - 1))]).reshape(-1, width)
    ahead = np.minimum.accumulate(blocks, axis=1).ravel()
    behind = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    low = np.minimum(behind[:n], ahead[width - 1:width - 1 + n])
    # Runs of windows of one text with one minimum.
    change = np.ones(n, bool)
    change[1:] = low[1:] != low[:-1]
    change[first] = True
    starts = np.flatnonzero(change)
    text = np.searchsorted(first, starts, side="right") - 1
    keep = (text >= 0) & (starts <= last[np.maximum(text, 0)])
    ends = np.append(starts[1:] - 1, n - 1)
    starts, ends = starts[keep], np.minimum(ends[keep], last[text[keep]])
    # A run goes over to the next place that holds its minimum once the leftmost one has left the window.
    pos, lo, hi = [], [], []
    while len(starts):
        at = _leftmost(names, low[starts], starts)
        pos.append(at)
        lo.append(starts)
        hi.append(np.minimum(ends, at))
        more = ends > at
        starts, ends = at[more] + 1, ends[more]
    return np.concatenate(pos), np.concatenate(lo), np.concatenate(hi)


def _leftmost(order: np.ndarray, value: np.ndarray, start: np.ndarray) -> np.ndarray:
    """First position from ``start`` on that holds ``value``; it lies within the window."""
    out = np.full(len(start), -1, np.int64)
    open_ = np.arange(len(start))
    hop = 0
    while len(open_):
        here = start[open_] + hop
        hit = order[here] == value[open_]
        out[open_[hit]] = here[hit]
        open_ = open_[~hit]
        hop += 1
    return out


def segments(data: np.ndarray, offsets: np.ndarray, length: int = LENGTH, q: int = Q):
    """Representatives of the rows: (row, position, first, last, bucket, segment name), positions within the row."""
    names = bucket_names(data, [q])[q]
    pos, lo, hi = representatives(names, offsets, length, q)
    row = C.doc_of(lo, offsets)
    name = C.span_hash(C.prefix_sums(data), lo, hi + length) + (pos - lo).astype(np.uint64) * _STEP
    base = offsets[row]
    return row, pos - base, lo - base, hi - base, names[pos] if len(pos) else np.zeros(0, np.uint64), C.mix64(name)


KEY = ["k1", "k2"]


def text_key(text: str = "text") -> list:
    """128-bit content key of a text: rows with equal texts share their work and their result."""
    return [F.xxhash64(F.col(text)).alias("k1"), F.xxhash64(F.lit(LENGTH), F.col(text)).alias("k2")]


#: Most segments of one bucket that are compared in one group; larger buckets are cut into several.
GROUP = 4096


def _segments(batches):
    C.no_worker_state()
    for batch in batches:
        for part, data, offsets in C.byte_slices(batch, "text"):
            row, pos, lo, hi, bucket, name = segments(data, offsets)
            place = (lo << 24) | ((hi - lo) << 12) | (pos - lo)
            yield pa.RecordBatch.from_arrays(
                [pa.array(part.column(k).to_numpy()[row]) for k in KEY] +
                [pa.array(place), pa.array(bucket.view(np.int64)), pa.array(name.view(np.int64))], names=[*KEY, "place", "bucket", "segment"])


def unplaced(place: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and last window start of packed places."""
    lo = place >> 24
    return lo, lo + ((place >> 12) & 0xFFF)


def _contexts(batches):
    """The bytes of mixed segments, from the texts that hold them."""
    loosen = zstandard.ZstdDecompressor()
    for batch in batches:
        spans = batch.column("mixed")
        edge, flat = spans.offsets.to_numpy(), spans.flatten()
        place, bucket, block, blocks, whole = (flat.field(i).to_numpy(zero_copy_only=False) for i in range(5))
        lo, hi = unplaced(place)
        edge = edge - edge[0]
        keys = [batch.column(k).to_numpy() for k in KEY]
        cut = []
        for i, body in enumerate(batch.column("body").to_pylist()):
            data = loosen.decompress(body)
            cut += [data[a:b + LENGTH] for a, b in zip(lo[edge[i]:edge[i + 1]].tolist(), hi[edge[i]:edge[i + 1]].tolist())]
        n = np.diff(edge)
        for i in range(0, len(cut), 4096):
            j = slice(i, i + 4096)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.repeat(k, n)[j]) for k in keys] + [pa.array(x[j]) for x in (place, bucket, block, blocks, whole)] + [pa.array(cut[j], pa.binary())],
                names=[*KEY, "place", "bucket", "block", "blocks", "whole", "context"])


def _compare(batches):
    """Round 3 inside groups of (bucket, block), which arrive together: runs of windows whose name occurs again.

    Rows with ``name`` null are results; rows with a name (buckets of several blocks only) are
    windows that have to be compared across blocks.
    """
    held, size, group = [], 0, None
    for batch in batches:
        if not batch.num_rows:
            continue
        bucket, block = batch.column("bucket").to_numpy(), batch.column("block").to_numpy()
        fresh = np.flatnonzero((bucket[1:] != bucket[:-1]) | (block[1:] != block[:-1])) + 1
        end = int(fresh[-1]) if len(fresh) else 0  # where the batch's last group starts
        if size + batch.nbytes >= C.SLICE_BYTES and (end or group != (bucket[0], block[0])):
            done = [*held, batch.slice(0, end)] if end else held
            if done:
                yield from _compare_groups(_joined(done))
            held, size, batch = [], 0, batch.slice(end)
        held.append(batch)
        size += batch.nbytes
        group = bucket[-1], block[-1]
    if held:
        yield from _compare_groups(_joined(held))


def _joined(batches: list[pa.RecordBatch]) -> pa.RecordBatch:
    """One batch of all rows; with 64-bit offsets there is no size at which Arrow makes several of it."""
    table = pa.Table.from_batches(batches)
    at = table.schema.get_field_index("context")
    (one,) = table.set_column(at, "context", table.column(at).cast(pa.large_binary())).combine_chunks().to_batches()
    return one


def _compare_groups(batch):
    data, offsets = C.text_view(batch.column("context"))
    lo, hi = unplaced(batch.column("place").to_numpy())
    size = hi - lo + 1
    of = np.repeat(np.arange(len(size)), size)
    at = np.arange(len(of)) - np.repeat(np.cumsum(size) - size, size)
    start = offsets[of] + at
    names = C.span_hash(C.prefix_sums(data), start, start + LENGTH)
    _, back, count = np.unique(names, return_inverse=True, return_counts=True)
    again = count[back] > 1
    whole = batch.column("whole").to_numpy(zero_copy_only=False)
    keys = [batch.column(k).to_numpy() for k in KEY]
    at = at + lo[of]
    # Runs of repeated windows of segments that are not repeated as a whole.
    hit = again & ~whole[of]
    new = hit.copy()
    new[1:] &= ~(hit[:-1] & (of[1:] == of[:-1]))
    close = hit.copy()
    close[:-1] &= ~(hit[1:] & (of[1:] == of[:-1]))
    first, last = np.flatnonzero(new), np.flatnonzero(close)
    none = pa.nulls(len(first), pa.int64())
    yield pa.RecordBatch.from_arrays([pa.array(k[of[first]]) for k in keys] + [pa.array(at[first]), pa.array(at[last]), none, pa.array(np.zeros(len(first), bool))],
                                     names=[*KEY, "lo", "hi", "name", "open"])
    split = batch.column("blocks").to_numpy() > 1
    if split.any():
        one = np.zeros(len(names), bool)
        one[np.unique(back, return_index=True)[1]] = True
        open_ = ~again & ~whole[of]
        out = np.flatnonzero(split[of] & (open_ | one))
        yield pa.RecordBatch.from_arrays([pa.array(k[of[out]]) for k in keys] + [pa.array(at[out]), pa.array(at[out]), pa.array(names[out].view(np.int64)), pa.array(open_[out])],
                                         names=[*KEY, "lo", "hi", "name", "open"])


def _squeeze(batches):
    tool = zstandard.ZstdCompressor(level=1)
    for batch in batches:
        body = [tool.compress(x.as_buffer()) for x in batch.column("text").cast(pa.binary())]
        yield pa.RecordBatch.from_arrays([batch.column(k) for k in KEY] + [pa.array(body, pa.binary())], names=[*KEY, "body"])


def squeezed(texts: DataFrame) -> DataFrame:
    return texts.select(*KEY, "text").mapInArrow(C.tidy(_squeeze), "k1 bigint, k2 bigint, body binary")


def repeated_windows(texts: DataFrame) -> DataFrame:
    """(k1, k2, found) of the texts (k1, k2, text) with something repeated; found: first and last window starts."""
    marked = marked_segments(texts)
    compared = C.materialize(mixed_contexts(texts, marked).repartition("bucket", "block").sortWithinPartitions("bucket", "block")
                             .mapInArrow(C.tidy(_compare), "k1 bigint, k2 bigint, lo bigint, hi bigint, name bigint, open boolean"), "compared")
    across = compared.filter("name is not null")
    again = across.groupBy("name").agg(F.count("*").alias("n")).filter("n > 1").select("name")
    whole = marked.filter("n > 1").select(*KEY, F.expr("shiftright(place, 24)").alias("lo"),
                                          F.expr("shiftright(place, 24) + (shiftright(place, 12) & 4095)").alias("hi"))
    found = (whole.unionByName(compared.filter("name is null").select(*KEY, "lo", "hi"))
             .unionByName(across.filter("open").join(again, "name", "left_semi").select(*KEY, "lo", "hi")))
    C.discard(texts.sparkSession)
    return found.groupBy(*KEY).agg(F.collect_set(F.struct("lo", "hi")).alias("found"))


def marked_segments(texts: DataFrame) -> DataFrame:
    """Rounds 1 and 2: segments that share a bucket, with ``n`` (rows of the segment), ``one`` (a k1 that has it) and ``kinds`` (of the bucket)."""
    spark = texts.sparkSession
    every = C.materialize(texts.mapInArrow(_segments, "k1 bigint, k2 bigint, place bigint, bucket bigint, segment bigint"), "segments")
    # Round 1: buckets by the name for Q bytes; what is alone in its bucket is settled.
    # (Counts are written before they are joined: a join of plain tables can be split where a bucket is large.)
    full = C.materialize(every.groupBy("bucket").agg(F.count("*").alias("n")).filter("n > 1").select("bucket"), "full")
    parts = C.materialize(every.join(full, "bucket", "left_semi"), "parts")
    C.discard(spark, every, full)
    # Round 2: buckets refined by the name of the whole segment.
    by_segment = C.materialize(parts.groupBy("bucket", "segment").agg(F.count("*").alias("n"), F.min("k1").alias("one")), "by-segment")
    by_bucket = C.materialize(by_segment.groupBy("bucket").agg(F.count("*").alias("kinds")), "by-bucket")
    state = C.materialize(by_segment.join(by_bucket, "bucket").select("bucket", "segment", "n", "one", "kinds"), "state")
    marked = C.materialize(parts.join(state, ["bucket", "segment"]), "marked")
    C.discard(spark, parts, by_segment, by_bucket, state)
    return marked


def mixed_contexts(texts: DataFrame, marked: DataFrame) -> DataFrame:
    """Input of round 3, the windows of mixed buckets: of a repeated segment one place of one text speaks for all.

    So a group of (bucket, block) has about ``GROUP`` rows, however often a text or a passage in it is repeated.
    """
    blocks = F.ceil(F.col("kinds") / GROUP).cast("int")
    mixed = (marked.filter("kinds > 1 and (n = 1 or k1 = one)")
             .groupBy("bucket", "segment", "n", "kinds", *KEY).agg(F.min("place").alias("place"))
             .groupBy(*KEY).agg(F.collect_set(F.struct("place", "bucket", F.pmod("segment", blocks).cast("int").alias("block"),
                                                       blocks.alias("blocks"), (F.col("n") > 1).alias("whole"))).alias("mixed")))
    # Copies of a text have one key: one row of them is enough (the aggregation starts on the map side).
    # A merge join at any size: after a broadcast join one task would hold two Python workers.
    return (squeezed(texts).dropDuplicates(KEY).join(mixed.hint("merge"), KEY)
            .mapInArrow(C.tidy(_contexts), "k1 bigint, k2 bigint, place bigint, bucket bigint, block int, blocks int, whole boolean, context binary"))


def merged(lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
    """Merged [start, end) runs of the bytes that windows starting in [lo, hi] cover; touching runs join."""
    order = np.argsort(lo, kind="stable")
    lo, end = lo[order], np.maximum.accumulate(hi[order] + LENGTH)
    head = np.ones(len(lo), bool)
    head[1:] = lo[1:] > end[:-1]
    at = np.flatnonzero(head)
    return np.stack([lo[at], np.append(end[at[1:] - 1], end[-1])], 1)


def _cut(riders: list[str]):
    def cut(batches):
        loosen = zstandard.ZstdDecompressor()
        for batch in batches:
            edge, flat = batch.column("found").offsets.to_numpy(), batch.column("found").flatten()
            lo, hi = (flat.field(i).to_numpy().astype(np.int64) for i in (0, 1))
            edge = edge - edge[0]
            n_bytes, n_removed, n_spans, left = [], [], [], []
            for i, body in enumerate(batch.column("body").to_pylist()):
                data = loosen.decompress(body)
                a, b = edge[i], edge[i + 1]
                runs = merged(lo[a:b], hi[a:b]) if b > a else np.zeros((0, 2), np.int64)
                kept, done = [], 0
                for start, end in runs.tolist():
                    kept.append(data[done:start])
                    done = end
                left.append(b"".join([*kept, data[done:]]))
                n_bytes.append(len(data))
                n_removed.append(int((runs[:, 1] - runs[:, 0]).sum()))
                n_spans.append(len(runs))
            yield pa.RecordBatch.from_arrays(
                [batch.column(c) for c in riders] + [pa.array(x, pa.int64()) for x in (n_bytes, n_removed, n_spans)] + [pa.array(left, pa.binary())],
                names=[*riders, "n_bytes", "n_removed", "n_spans", "kept_bytes"])
    return cut


RESULT = ["n_bytes", "n_removed", "n_spans", "kept_bytes"]


def cut_repeats(docs: DataFrame, text: str = "text") -> DataFrame:
    """Every row of ``docs``, its text replaced by ``n_bytes``, ``n_removed``, ``n_spans`` and ``kept_bytes``.

    Other columns ride along inside a struct, so their names cannot clash with the work's.
    """
    riders = [c for c in docs.columns if c not in (text, *RESULT)]
    whole = docs.select(F.struct(*[F.col(f"`{c}`") for c in riders]).alias("row"), F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text"))
    texts = whole.select(*text_key(), "text")
    found = repeated_windows(texts)
    shut = whole.select("row", *text_key(), "text").mapInArrow(C.tidy(_squeeze_rows), _schema(whole.schema["row"].dataType, "k1 bigint, k2 bigint, body binary"))
    none = F.array().cast("array<struct<lo:bigint,hi:bigint>>")
    # A merge join, as above: compressing and cutting are two stages.
    ready = shut.join(found.hint("merge"), KEY, "left").select("row", "body", F.coalesce("found", none).alias("found"))
    cut = ready.mapInArrow(C.tidy(_cut(["row"])), _schema(whole.schema["row"].dataType, "n_bytes bigint, n_removed bigint, n_spans bigint, kept_bytes binary"))
    return cut.select(*[F.col(f"row.`{c}`").alias(c) for c in riders], *RESULT)


def _schema(row, rest: str):
    return StructType([StructField("row", row), *StructType.fromDDL(rest).fields])


def _squeeze_rows(batches):
    tool = zstandard.ZstdCompressor(level=1)
    for batch in batches:
        body = [tool.compress(x.as_buffer()) for x in batch.column("text").cast(pa.binary())]
        yield pa.RecordBatch.from_arrays([batch.column("row"), *[batch.column(k) for k in KEY], pa.array(body, pa.binary())], names=["row", *KEY, "body"])


def whole_characters(kept: Column) -> Column:
    """Text of the bytes left, without the pieces of characters that a cut went through."""
    return F.replace(F.make_valid_utf8(kept.cast("string")), F.lit("\ufffd"), F.lit(""))
