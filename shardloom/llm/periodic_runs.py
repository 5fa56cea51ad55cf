"""Periodic runs of words, found with a dictionary of basic factors.

A run is a stretch of consecutive words in which words ``q`` apart are identical for its smallest
period ``q``, of at least ``LEAST_WORDS`` words and ``LEAST_PERIODS`` periods, that neither
neighbouring word extends. The dictionary names every factor (substring) of 1, 2, 4, ... words of
a text: a factor of 2w words is the pair of names at i and i + w, ranked by one sort per length.
Positions whose name occurs once in their text leave the dictionary, so prose is gone after a few
lengths and only repetitive texts are named to the end.

The successor of a position is the next one of the same name. Inside a run of period q every
factor of w >= q words has its successor exactly q further on (its first q words are no power of
a shorter word, so they occur at multiples of q only), as long as q + w words are left. Therefore
at length w = 2**k the successors at distances d, w/2 < d <= w, form arithmetic progressions: a
stretch i..j of consecutive positions with the same d has period d over [i, j + d + w), d is its smallest
period (a smaller one would be a nearer successor), and neither end extends. A run of period d
with 3 d words or more shows up there and at no other length, so each is proposed once, at
its full extent; a run shorter than the thresholds is dropped afterwards.

Words are the maximal runs of bytes other than space and 0x09 to 0x0D, named exactly (by their bytes,
not by hashes). The work on a text is n log n at most, texts are handled in slices of a few MB.

Defined results: a null or blank text has no words, no runs and an empty collapsed text; repeated rows
are judged each by themselves and alike; columns of the input that carry an output's name are replaced.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shardloom.llm import common as C

LEAST_WORDS = 6
LEAST_PERIODS = 4

RUN = "array<struct<start:bigint,length:bigint,period:bigint>>"
FIELDS = ["n_words", "runs", "collapsed"]


def word_names(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """One integer per word, equal for equal bytes only."""
    if not len(starts):
        return np.zeros(0, np.int64)
    at = np.concatenate(([0], np.cumsum(ends - starts)))
    body = pa.py_buffer(np.ascontiguousarray(data[~C.SPACE[data]]))  # words stand in order, so their bytes join up
    wide = at[-1] >= 1 << 31
    words = pa.Array.from_buffers(pa.large_binary() if wide else pa.binary(), len(starts), [None, pa.py_buffer(at.astype(np.int64 if wide else np.int32)), body])
    return words.dictionary_encode().indices.to_numpy().astype(np.int64)


def _ranks(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Order of the keys (ties by place), and the rank and size of every key's group."""
    order = np.argsort(keys, kind="stable")
    head = np.ones(len(keys), bool)
    head[1:] = keys[order][1:] != keys[order][:-1]
    group = np.cumsum(head) - 1
    rank = np.empty(len(keys), np.int64)
    rank[order] = group
    return order, rank, np.bincount(group)[rank] if len(keys) else np.zeros(0, np.int64)


def find_runs(names: np.ndarray, rows: np.ndarray, least_words: int = LEAST_WORDS, least_periods: int = LEAST_PERIODS) -> tuple[np.ndarray, ...]:
    """Runs of the word sequences of several texts: (first place, length, period), by place and period.

    ``names`` holds the words of all texts one after the other, ``rows`` their texts (ascending).
    At least three periods are asked of a run; the dictionary proposes no shorter ones completely.
    """
    if least_periods < 3:
        raise ValueError("runs of less than three periods are not found by successors")
    n = len(names)
    found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    longest = int(np.bincount(rows).max(initial=0)) if n else 0
    at, key, width, named = np.arange(n), rows * (int(names.max(initial=0)) + 1) + names, 1, np.full(n, -1, np.int64)
    while len(at) and (width // 2 + 1) * least_periods <= longest:
        order, rank, size = _ranks(key)
        place = at[order]
        gap = np.zeros(len(at), np.int64)
        gap[order[:-1]] = np.where(rank[order[1:]] == rank[order[:-1]], place[1:] - place[:-1], 0)
        near = np.flatnonzero((gap > width // 2) & (gap <= width))
        if len(near):
            i, d = at[near], gap[near]  # positions ascend, so equal distances side by side are one progression
            first = np.ones(len(near), bool)
            first[1:] = (i[1:] != i[:-1] + 1) | (d[1:] != d[:-1])
            head = np.flatnonzero(first)
            last = np.append(head[1:], len(near)) - 1
            start, period = i[head], d[head]
            length = i[last] - start + period + width
            enough = length >= np.maximum(least_words, least_periods * period)
            found.append((start[enough], length[enough], period[enough]))
        often = size > 1
        named[at] = np.where(often, rank, -1)
        left, right = at[often], at[often] + width
        inside = right < n
        left, right = left[inside], right[inside]
        both = (named[right] >= 0) & (rows[right] == rows[left])
        left, right = left[both], right[both]
        key = named[left] * (int(rank.max(initial=0)) + 1) + named[right]
        named[at] = -1
        at, width = left, 2 * width
    if not found:
        return (np.zeros(0, np.int64),) * 3
    start, length, period = (np.concatenate(x) for x in zip(*found))
    order = np.lexsort((period, start))
    return start[order], length[order], period[order]


def _joined(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, rows: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """The words of each row joined by one space: bytes and n + 1 offsets."""
    size = ends - starts + 1
    at = np.concatenate(([0], np.cumsum(size)))
    index = np.arange(at[-1]) + np.repeat(starts - at[:-1], size)
    out = data[np.minimum(index, max(len(data) - 1, 0))] if len(index) else np.zeros(0, np.uint8)
    out[at[1:] - 1] = 0x20
    final = np.ones(len(rows), bool)
    final[:-1] = rows[1:] != rows[:-1]  # no space after a row's last word
    keep = np.ones(len(out), bool)
    keep[at[1:][final] - 1] = False
    size = np.bincount(rows, weights=ends - starts + 1 - final, minlength=n).astype(np.int64)
    return out[keep], np.concatenate(([0], np.cumsum(size)))


def _strings(flat: np.ndarray, offsets: np.ndarray) -> pa.Array:
    return pa.Array.from_buffers(pa.string(), len(offsets) - 1, [None, pa.py_buffer(offsets.astype(np.int32)), pa.py_buffer(np.ascontiguousarray(flat))])


def _judge(data: np.ndarray, offsets: np.ndarray, least_words: int, least_periods: int) -> pa.StructArray:
    n = len(offsets) - 1
    starts, ends, rows = C.spans_of_words(data, offsets)
    words = np.bincount(rows, minlength=n)
    before = np.concatenate(([0], np.cumsum(words)))
    first, length, period = find_runs(word_names(data, starts, ends), rows, least_words, least_periods)
    step = np.zeros(len(rows) + 1, np.int64)
    np.add.at(step, first + period, 1)
    np.add.at(step, first + length, -1)
    kept = np.cumsum(step)[:-1] == 0
    of = rows[first]
    runs = pa.ListArray.from_arrays(
        pa.array(np.concatenate(([0], np.cumsum(np.bincount(of, minlength=n)))).astype(np.int32)),
        pa.StructArray.from_arrays([pa.array(first - before[of]), pa.array(length), pa.array(period)], names=["start", "length", "period"]))
    text = _strings(*_joined(data, starts[kept], ends[kept], rows[kept], n))
    return pa.StructArray.from_arrays([pa.array(words), runs, text], names=FIELDS)


def periodic_runs(df: DataFrame, text: str = "text", least_words: int = LEAST_WORDS, least_periods: int = LEAST_PERIODS) -> DataFrame:
    """Adds to every row ``n_words``, its ``runs`` (by start, then period; starts are word numbers from 0) and
    ``collapsed``: the words left when every run keeps its first period only, joined by one space."""
    @F.arrow_udf(f"struct<n_words:bigint,runs:{RUN},collapsed:string>")
    def judge(texts: pa.Array) -> pa.Array:
        C.no_worker_state()
        batch = pa.RecordBatch.from_arrays([texts], names=["t"])
        parts = [_judge(data, offsets, least_words, least_periods) for _, data, offsets in C.byte_slices(batch, "t")]
        return pa.concat_arrays(parts) if parts else _judge(np.zeros(0, np.uint8), np.zeros(1, np.int64), least_words, least_periods)

    held = C.free_name(df, "_runs")
    got = df.select(*C.keep_columns(df, *FIELDS), judge.asNondeterministic()(F.col(f"`{text}`")).alias(held))
    return got.select(*C.keep_columns(got, held), *[F.col(held)[f].alias(f) for f in FIELDS])


def longest_run(runs: Column) -> Column:
    """The run of greatest length (ties: smallest start, then period); null if there is none."""
    ranked = F.transform(runs, lambda r: F.struct((-r["length"]).alias("least"), r["start"].alias("start"), r["period"].alias("period")))
    best = F.array_min(ranked)
    return F.struct(best["start"].alias("start"), (-best["least"]).alias("length"), best["period"].alias("period"),
                    F.floor(-best["least"] * 1000 / best["period"]).cast("long").alias("exponent_milli"))


def runs_digest(runs: Column) -> Column:
    """SHA-256 of the lines ``start,length,period``, one per run, in order."""
    lines = F.transform(runs, lambda r: F.concat(F.concat_ws(",", r["start"].cast("string"), r["length"].cast("string"), r["period"].cast("string")), F.lit("\n")))
    return F.sha2(F.array_join(lines, "").cast("binary"), 256)


def with_echoes(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, text) in which every tenth text by crc32 of its key ends in an echo of itself.

    With h the unsigned crc32 of the key in decimal, g = floor(h / 10) and n words: where 10 divides h and n > 0, each word
    from number a = g % n on is the word a + (i - a) % p, p = 1 + floor((n - a) / (3 + g % 8)), and one space stands
    between words. Other texts, and those of a null key, are as they were.
    """
    words = F.regexp_extract_all(F.col("_t"), F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0))
    rows = docs.select(F.col(f"`{key}`").alias("_k"), F.col(f"`{text}`").alias("_t"),
                       F.crc32(F.col(f"`{key}`").cast("string").cast("binary")).alias("_h"))
    chosen = rows.withColumn("_w", F.when(F.col("_h") % 10 == 0, words))
    def div(a: Column, b: Column | int) -> Column:
        return ((a - a % b) / b).cast("long")

    n, g = F.size("_w").cast("long"), div(F.col("_h"), 10)
    parts = chosen.withColumn("_n", n).withColumn("_a", F.when(F.col("_n") > 0, g % F.col("_n")))
    parts = parts.withColumn("_p", 1 + div(F.col("_n") - F.col("_a"), 3 + g % 8))
    head = F.slice("_w", F.lit(1), F.col("_a").cast("int"))
    period = F.slice("_w", (F.col("_a") + 1).cast("int"), F.col("_p").cast("int"))
    left = F.col("_n") - F.col("_a")
    whole = F.flatten(F.array_repeat(period, div(left, F.col("_p")).cast("int")))
    rest = F.slice("_w", (F.col("_a") + 1).cast("int"), (left % F.col("_p")).cast("int"))
    echo = F.array_join(F.concat(head, whole, rest), " ")
    return parts.select(F.col("_k").alias(key), F.when(F.col("_a").isNotNull(), echo).otherwise(F.col("_t")).alias(text))


def run_digests(docs: DataFrame) -> DataFrame:
    """doc_id, n_runs, the longest run, digests of all runs and of the collapsed text, for texts with echoes."""
    best = longest_run(F.col("runs"))
    got = periodic_runs(with_echoes(docs)).withColumn("_b", best)
    return got.select("doc_id", F.size("runs").cast("long").alias("n_runs"), "_b.start", "_b.length", "_b.period", "_b.exponent_milli",
                      runs_digest(F.col("runs")).alias("runs_sha256"), F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"))
