"""Quality scores by random Fourier features of document statistics, ridge regression and isotonic calibration.

Every document is described by ``STATISTICS`` (counts and ratios of its characters, words, lines and
repeats; nothing but its text). Standardised by the means and deviations over all documents, they
are mapped to ``FEATURES`` random Fourier features cos(w x + b), whose inner products approximate
a Gaussian kernel of width ``WIDTH``. Each partition of the labelled rows sums its part of the normal
equations Z'Z and Z'y (``FEATURES`` rows, whatever the rows); the summed equations are solved
once. Isotonic regression on the scores of labelled rows kept out of the fit, binned to
``BINS`` counts, makes the scores probabilities.

Rows whose crc32(doc_id as text) mod 5 is 0 give no label to anything; of the others, remainder 1
calibrates and 2 to 4 fit.

Defined results: a null text is an empty one and has a score like any text; without labelled
rows of both classes every score is the share of label 1 (0.5 without labels); a doc_id that is
labelled twice counts with its smaller label; rows with a null doc_id are scored, not held out.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shardloom.llm import common as C
from shardloom.llm.quality_rules import base_counts

FEATURES = 256
WIDTH = 4.0
RIDGE = 1e-4
BINS = 2000
THRESHOLD = 0.3
SEED = 20

STATISTICS = ["log_bytes", "log_words", "log_lines", "word_length", "upper", "digit", "space", "symbol", "punct", "bang", "pipe", "wide",
              "symbol_words", "upper_words", "mark_words", "long_words", "short_words", "dup_lines", "repeat_words", "distinct_words", "top_word",
              "line_words", "stops", "vowels", "upper_half", "symbol_half"]

_CLASS = {name: np.zeros(256, bool) for name in ("upper", "digit", "space", "symbol", "punct", "bang", "pipe", "wide", "stops", "vowels", "letter")}
for _name, _chars in {"upper": "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "digit": "0123456789", "space": " \n\t\r", "symbol": "#*$%&<>@^_~=+\\/{}[]",
                      "punct": ".,;:'\"()-", "bang": "!?", "pipe": "|", "stops": ".", "vowels": "aeiouAEIOU"}.items():
    _CLASS[_name][[ord(c) for c in _chars]] = True
_CLASS["wide"][128:] = True
_CLASS["letter"][[*range(65, 91), *range(97, 123), *range(0xC3, 0xF5)]] = True


def statistics_of(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Document statistics (rows x ``STATISTICS``)."""
    n = len(offsets) - 1
    base = base_counts(data, offsets)
    starts, ends, rows = C.spans_of_words(data, offsets)
    size = np.diff(offsets)
    words = np.maximum(base["n_words"], 1)
    runs = {name: np.concatenate(([0], np.cumsum(_CLASS[name][data]))) for name in ("upper", "digit", "space", "symbol", "punct", "bang", "pipe", "wide", "stops", "vowels")}
    whole = lambda name: (runs[name][offsets[1:]] - runs[name][offsets[:-1]]) / np.maximum(size, 1)
    per_word = {name: runs[name][ends] - runs[name][starts] for name in ("upper", "symbol", "punct", "bang", "pipe")}
    length = ends - starts
    share = lambda mask: np.bincount(rows, weights=mask, minlength=n) / words
    lines = np.add.reduceat(np.append(data == 10, False), offsets[:-1]) * (size > 0) + 1 if n else np.zeros(0)

    # Distinct words and the share of the most frequent one.
    own = C.mix64(base["hashes"] + rows.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    order = np.argsort(own, kind="stable")
    head = np.ones(len(own), bool)
    head[1:] = own[order][1:] != own[order][:-1]
    at = np.flatnonzero(head)
    often = np.diff(np.append(at, len(own)))
    of = rows[order][at]
    distinct = np.bincount(of, minlength=n)
    top = np.zeros(n)
    np.maximum.at(top, of, often)

    middle = offsets[:-1] + size // 2
    half = lambda name: np.abs((runs[name][middle] - runs[name][offsets[:-1]]) - (runs[name][offsets[1:]] - runs[name][middle])) / np.maximum(size, 1)
    columns = [np.log1p(size), np.log1p(base["n_words"]), np.log1p(lines), base["word_chars"] / words,
               *(np.sqrt(whole(c)) for c in ("upper", "digit", "space", "symbol", "punct", "bang", "pipe", "wide")),
               share(per_word["symbol"] > 0), share(2 * per_word["upper"] > length), share(per_word["bang"] + per_word["pipe"] > 0),
               share(length > 14), share(length < 3), base["n_dup_lines"] / np.maximum(lines, 1), base["n_repeat_words"] / words,
               distinct / words, top / words, np.log1p(words / np.maximum(lines, 1)), np.sqrt(whole("stops")), whole("vowels"),
               np.sqrt(half("upper")), np.sqrt(half("symbol"))]
    return np.stack([np.asarray(c, float) for c in columns], 1) if n else np.zeros((0, len(STATISTICS)))


def document_statistics(docs: DataFrame, text: str = "text") -> DataFrame:
    """(doc_id, stats) of every row."""
    def run(batches):
        for batch in batches:
            for part, data, offsets in C.byte_slices(batch, "text"):
                got = statistics_of(data, offsets)
                flat = pa.array(got.ravel(), pa.float64())
                stats = pa.ListArray.from_arrays(pa.array(np.arange(len(got) + 1) * got.shape[1], pa.int32()), flat)
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), stats], names=["doc_id", "stats"])
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    return rows.mapInArrow(run, "doc_id bigint, stats array<double>")


@dataclass(frozen=True)
class Kernel:
    """Standardisation and random features."""

    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    phase: np.ndarray

    def features(self, stats: np.ndarray) -> np.ndarray:
        x = np.clip((stats - self.mean) / self.scale, -6, 6)
        z = np.cos(x @ self.weights + self.phase) * np.sqrt(2.0 / len(self.phase))
        return np.concatenate([z, np.ones((len(z), 1))], 1)


def _matrix(batch: pa.RecordBatch) -> np.ndarray:
    return batch.column("stats").flatten().to_numpy().reshape(batch.num_rows, len(STATISTICS))


def kernel_of(stats: DataFrame) -> Kernel:
    k = len(STATISTICS)
    got = stats.select([F.col("stats")[i].alias(f"s{i}") for i in range(k)]).agg(
        *[F.avg(f"s{i}") for i in range(k)], *[F.stddev_pop(f"s{i}") for i in range(k)]).first()
    mean = np.array([v or 0.0 for v in got[:k]])
    scale = np.array([v if v and v > 1e-9 else 1.0 for v in got[k:]])
    draw = np.random.default_rng(SEED)
    return Kernel(mean, scale, draw.normal(size=(k, FEATURES)) / WIDTH, draw.uniform(0, 2 * np.pi, FEATURES))


def normal_equations(rows: DataFrame, kernel: Kernel) -> tuple[np.ndarray, np.ndarray]:
    """Z'Z and Z'y of labelled rows (stats, y): one array per feature from each partition, summed by feature."""
    width = FEATURES + 1

    def partial(batches):
        total = np.zeros((width, width + 1))
        for batch in batches:
            z = kernel.features(_matrix(batch))
            total[:, :width] += z.T @ z
            total[:, width] += z.T @ batch.column("y").to_numpy().astype(float)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(width), pa.int32()), pa.array(list(total), pa.list_(pa.float64()))], names=["i", "row"])

    sums = [F.sum(F.col("row")[j]).alias(f"c{j}") for j in range(width + 1)]
    got = rows.mapInArrow(partial, "i int, row array<double>").groupBy("i").agg(F.array(*sums).alias("row")).collect()
    out = np.zeros((width, width + 1))
    for r in got:
        out[r["i"]] = r["row"]
    return out[:, :width], out[:, width]


@dataclass(frozen=True)
class Scorer:
    """Kernel, ridge weights and the calibration's steps; without ``beta`` every score is ``base``."""

    kernel: Kernel
    base: float
    beta: np.ndarray | None = None
    knots: np.ndarray | None = None
    values: np.ndarray | None = None

    def raw(self, stats: np.ndarray) -> np.ndarray:
        return self.kernel.features(stats) @ self.beta

    def score(self, stats: np.ndarray) -> np.ndarray:
        if self.beta is None:
            return np.full(len(stats), self.base)
        return np.interp(self.raw(stats), self.knots, self.values) if self.knots is not None else np.clip(self.raw(stats), 0, 1)


def isotonic(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """Weighted least-squares fit of a non-decreasing function (pool adjacent violators); x ascending."""
    level, mass, count = [], [], []
    for v, w in zip(y, weight):
        level.append(float(v))
        mass.append(float(w))
        count.append(1)
        while len(level) > 1 and level[-2] > level[-1]:
            v1, w1, c1 = level.pop(), mass.pop(), count.pop()
            level[-1] = (level[-1] * mass[-1] + v1 * w1) / (mass[-1] + w1)
            mass[-1] += w1
            count[-1] += c1
    return np.repeat(level, count)


def remainder(key: Column) -> Column:
    return F.pmod(F.crc32(key.cast("string").cast("binary")), F.lit(5))


def fit(stats: DataFrame, labels: DataFrame, target: str = "quality") -> Scorer:
    """Scorer from the labelled rows outside the held-out remainder."""
    kernel = kernel_of(stats)
    known = (labels.filter(F.col("doc_id").isNotNull() & F.col(target).isNotNull() & (remainder(F.col("doc_id")) != 0))
             .groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.min(target).cast("double").alias("y")))
    rows = C.materialize(stats.join(known, "doc_id").withColumn("fold", remainder(F.col("doc_id"))), "labelled")
    n = {(r["fold"] == 1, r["y"]): r["n"] for r in rows.groupBy((F.col("fold") == 1).alias("fold"), "y").agg(F.count("*").alias("n")).collect()}
    total = sum(n.values())
    share = sum(v for (_, y), v in n.items() if y > 0) / total if total else 0.5
    if not (n.get((False, 0.0)) and n.get((False, 1.0))):
        return Scorer(kernel, share)
    gram, target_sums = normal_equations(rows.filter("fold <> 1").select("stats", "y"), kernel)
    fitted = sum(v for (c, _), v in n.items() if not c)
    beta = np.linalg.solve(gram + RIDGE * fitted * np.eye(len(gram)), target_sums)
    raw = Scorer(kernel, share, beta)

    def binned(batches):
        for batch in batches:
            at = np.clip((raw.raw(_matrix(batch)) + 0.5) / 2 * BINS, 0, BINS - 1).astype(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(at), batch.column("y")], names=["bin", "y"])

    held = (rows.filter("fold = 1").select("stats", "y").mapInArrow(binned, "bin bigint, y double")
            .groupBy("bin").agg(F.count("*").alias("n"), F.avg("y").alias("y")).orderBy("bin").collect())  # at most BINS rows
    if len(held) < 2:
        return raw
    at, y, w = (np.array([r[c] for r in held], float) for c in ("bin", "y", "n"))
    edge = 1.0 / (w.sum() + 2)  # no score is certain
    fit_y = np.clip(isotonic(at, y, w), edge, 1 - edge)
    return Scorer(kernel, share, beta, (at + 0.5) / BINS * 2 - 0.5, fit_y)


def score(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, held_out, score, predicted) of every row of ``docs`` (doc_id, text)."""
    stats = C.materialize(document_statistics(docs), "statistics")
    scorer = docs.sparkSession.sparkContext.broadcast(fit(stats, labels))  # FEATURES weights and BINS steps

    def run(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(scorer.value.score(_matrix(batch)), pa.float64())], names=["doc_id", "score"])

    scored = stats.mapInArrow(run, "doc_id bigint, score double")
    return scored.select("doc_id", F.coalesce(remainder(F.col("doc_id")) == 0, F.lit(False)).alias("held_out"), "score",
                         (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
