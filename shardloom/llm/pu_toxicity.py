"""Toxicity by non-negative positive-unlabelled learning.

Only confirmed toxic texts count as labels, the share c of all; every other text, whatever its label, is unlabelled: a
mixture of toxic and clean ones. If the share ``prior`` of all texts is toxic, q = (prior - c) / (1 - c) of the unlabelled
are, and the risk of a classifier z is

    prior * E_toxic[l(z)] + (1 - c) * max(0, E_unlabelled[l(-z)] - q * E_toxic[l(-z)]),   l(z) = 1 / (1 + exp(z)),

the corrected estimate of its risk on labelled data; where the difference falls below zero (the
classifier begins to learn the sample by heart), the step goes back up that part instead.

Of texts that share their rarest-hashed window of ``WINDOW`` words (copies, near copies) one is in each sample, so that
one text copied often does not make its words look like a habit.

Features are words and word beginnings of ``STEMS`` code points, lower-cased (A to Z), as 64-bit hashes,
present or absent, so that one word in a long text weighs as much as in a short one. A grouped aggregation
over the sample counts in how many toxic and in how many unlabelled texts each is found. A feature remains if it is in
``LEAST_TEXTS`` toxic texts and in ``LEAST_SHARE`` of them, texts with it are toxic with probability ``LEAST_POSTERIOR`` or more (prior * share of toxic / share of all texts that have it) and the
difference is beyond chance: a likelihood ratio of 2 log(number of features tested). Their weights are not negative. ``MEMBERS`` numpy
classifiers are trained in tasks of their own, each without one part of the sample; their mean is the model. The
loss is bounded, so that a prior that is somewhat wrong cannot drive the scores of texts without any feature up; as it
is not convex, the fit starts from ``START``, where every feature speaks for toxicity.

Bounds of the fit: ``MAX_TOXIC`` and ``MAX_UNLABELLED`` texts (hash-chosen, whole), ``MAX_CANDIDATES`` features counted
in unlabelled texts (those in most toxic texts), ``MAX_FEATURES`` in the model. All rows are scored.

Rows whose crc32(doc_id as text) mod 3 is 1 take no part in the fit, neither their labels nor their texts. The prior is
the share of label 1 among the labelled rows that are left, or ``PRIOR`` where all of them are toxic.

Defined results: a null text is an empty one and has a score; without toxic rows every score is 0, without
features that tell them apart every score is the prior; a doc_id that is labelled twice is toxic if all its labels are; of
a repeated doc_id one text (that of smallest hash) is in the sample, all are scored; rows with a null doc_id are
scored, not held out and not in the sample.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shardloom.llm import common as C
from shardloom.llm.quality_rules import labelled_sample

THRESHOLD = 0.7
PRIOR = 0.1
MAX_TOXIC = 4000
MAX_UNLABELLED = 8000
MAX_CANDIDATES = 1 << 18
MAX_FEATURES = 4096
STEMS = (3, 4, 5, 6)
LEAST_TEXTS = 3
LEAST_SHARE = 0.005
WINDOW = 5
LEAST_POSTERIOR = 0.5
MEMBERS = 5
START = (2.0, -2.0)  # every weight, the bias
STEPS = 300
RATE = 0.03
RIDGE = 1e-5  # pulls weights back to their start

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_LETTER = np.zeros(256, bool)
_LETTER[[*range(97, 123), *range(128, 256)]] = True


def remainder(key: Column) -> Column:
    return F.pmod(F.crc32(key.cast("string").cast("binary")), F.lit(3))


def term_hashes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash and row of every word and word beginning (with repeats)."""
    data = _LOWER[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[offsets] = True
    letter = _LETTER[data]
    starts = np.flatnonzero(letter & (~np.append(False, letter[:-1]) | edge[:-1])) if len(data) else np.zeros(0, np.int64)
    ends = np.flatnonzero(letter & (~np.append(letter[1:], False) | edge[1:])) + 1 if len(data) else starts
    rows = C.doc_of(starts, offsets)
    sums = C.prefix_sums(data)
    head = (data & 0xC0) != 0x80
    place = np.append(np.flatnonzero(head), len(data))
    before = np.concatenate(([0], np.cumsum(head)))
    keys, of = [C.span_hash(sums, starts, ends)], [rows]
    for k in STEMS:
        longer = before[ends] - before[starts] > k
        first = starts[longer]
        keys.append(C.mix64(C.span_hash(sums, first, place[before[first] + k]) + np.uint64(k)))
        of.append(rows[longer])
    return np.concatenate(keys), np.concatenate(of)


def _once(keys: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each (row, key) once, by row."""
    order = np.lexsort((keys, rows))
    keys, rows = keys[order], rows[order]
    first = np.ones(len(keys), bool)
    first[1:] = (keys[1:] != keys[:-1]) | (rows[1:] != rows[:-1])
    return keys[first], rows[first]


def known_terms(data: np.ndarray, offsets: np.ndarray, terms: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(number of the term, row) of the terms (ascending hashes) that a row holds, each once."""
    keys, rows = term_hashes(data, offsets)
    at = np.minimum(np.searchsorted(terms, keys), max(len(terms) - 1, 0))
    hit = terms[at] == keys if len(terms) else np.zeros(len(keys), bool)
    return _once(at[hit], rows[hit])


def document_frequency(texts: DataFrame, terms: np.ndarray | None = None) -> DataFrame:
    """(term, texts): in how many texts (column _text) each term is found; only of ``terms`` where given."""
    shared = texts.sparkSession.sparkContext.broadcast(terms)

    def run(batches):
        for batch in batches:
            for _, data, offsets in C.byte_slices(batch, "_text"):
                if shared.value is None:
                    keys, _ = _once(*term_hashes(data, offsets))
                else:
                    keys = shared.value[known_terms(data, offsets, shared.value)[0]]
                found, n = np.unique(keys, return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(found.view(np.int64)), pa.array(n)], names=["term", "texts"])

    return texts.select("_text").mapInArrow(run, "term bigint, texts bigint").groupBy("term").agg(F.sum("texts").alias("texts"))


def telling_terms(toxic: DataFrame, unlabelled: DataFrame, n_toxic: int, n_unlabelled: int, prior: Prior) -> np.ndarray:
    """Hashes (ascending) of the features that toxic texts hold more often than unlabelled ones."""
    often = document_frequency(toxic).filter(F.col("texts") >= max(LEAST_TEXTS, LEAST_SHARE * n_toxic)).orderBy(F.desc("texts"), "term").limit(MAX_CANDIDATES).toPandas()
    order = np.argsort(often["term"].to_numpy().view(np.uint64))
    terms, a = often["term"].to_numpy().view(np.uint64)[order], often["texts"].to_numpy().astype(float)[order]
    if not len(terms) or not n_unlabelled:
        return np.zeros(0, np.uint64)
    seen = document_frequency(unlabelled, terms).toPandas()
    b = np.zeros(len(terms))
    b[np.searchsorted(terms, seen["term"].to_numpy().view(np.uint64))] = seen["texts"]
    # Likelihood ratio (G) of two shares against one.
    pooled = (a + b) / (n_toxic + n_unlabelled)
    g = np.zeros(len(terms))
    for hits, n in ((a, n_toxic), (b, n_unlabelled)):
        for count, expected in ((hits, pooled), (n - hits, 1 - pooled)):
            g += 2 * count * np.log(np.maximum(count, 1e-300) / np.maximum(n * expected, 1e-300))
    posterior = prior.toxic * (a / n_toxic) / (prior.confirmed * a / n_toxic + (1 - prior.confirmed) * (b + 1) / n_unlabelled)
    good = np.flatnonzero((posterior >= LEAST_POSTERIOR) & (g >= 2 * np.log(len(terms))))
    return np.sort(terms[good[np.lexsort((terms[good], -g[good]))][:MAX_FEATURES]])


def one_of_copies(texts: DataFrame) -> DataFrame:
    """(_key, _text, toxic) with one row (smallest key) of those in a sample whose smallest window hash is the same."""
    def run(batches):
        for batch in batches:
            for part, data, offsets in C.byte_slices(batch, "_text"):
                starts, ends, rows = C.spans_of_words(data, offsets)
                words = C.span_hash(C.prefix_sums(data), starts, ends)
                low = np.full(len(offsets) - 1, np.iinfo(np.uint64).max, np.uint64)
                for k in (1, WINDOW):  # a text of fewer words goes by its words
                    found, first = C.window_hash(words, rows, k)
                    enough = np.bincount(rows, minlength=len(low))[rows[first]] >= WINDOW
                    use = enough if k == WINDOW else ~enough
                    np.minimum.at(low, rows[first][use], found[use])
                yield pa.RecordBatch.from_arrays([part.column("_key").cast(pa.string()), part.column("_text"), part.column("toxic"), pa.array(low.view(np.int64))],
                                                 names=["_key", "_text", "toxic", "family"])

    families = texts.mapInArrow(run, "_key string, _text string, toxic boolean, family bigint")
    one = families.groupBy("toxic", "family").agg(F.min(F.struct("_key", "_text")).alias("one"))
    return one.select("one._key", "one._text", "toxic")


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(z, -60, 60)))


@dataclass(frozen=True)
class Prior:
    """Share of toxic texts, and of confirmed toxic ones, among all."""

    toxic: float
    confirmed: float

    @property
    def hidden(self) -> float:
        """Share of toxic texts among the unlabelled."""
        return max(self.toxic - self.confirmed, 0.0) / (1 - self.confirmed)


def corrected_steps(toxic: np.ndarray, unlabelled: np.ndarray, prior: Prior) -> tuple[np.ndarray, np.ndarray, float]:
    """Derivatives of the non-negative risk by the margins of both samples, and the difference that may not be negative."""
    p, u = _sigmoid(toxic), _sigmoid(unlabelled)
    rest = float(u.mean() - prior.hidden * p.mean())
    slope, up = p * (1 - p) / len(p), u * (1 - u) / len(u)
    if rest >= 0:
        return -(prior.toxic + (1 - prior.confirmed) * prior.hidden) * slope, (1 - prior.confirmed) * up, rest
    return prior.hidden * slope, -up, rest


def _descend(gradient, size: int) -> np.ndarray:
    """Adam from ``START``; all but the last number (the bias) stay at zero or above."""
    w, m, v = np.full(size, START[0]), np.zeros(size), np.zeros(size)
    w[-1] = START[1]
    for step in range(1, STEPS + 1):
        g = gradient(w)
        m, v = 0.9 * m + 0.1 * g, 0.99 * v + 0.01 * g * g
        w = w - RATE * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.99 ** step)) + 1e-8)
        w[:-1] = np.maximum(w[:-1], 0.0)
    return w


def _flat(terms: pd.Series) -> tuple[np.ndarray, np.ndarray]:
    """Term numbers of several texts, one after the other, and the text of each."""
    parts = [np.frombuffer(x, "<i4") for x in terms]
    return (np.concatenate(parts) if parts else np.zeros(0, np.int32)), np.repeat(np.arange(len(parts)), [len(x) for x in parts])


def fit_member(terms: pd.Series, toxic: np.ndarray, size: int, prior: Prior) -> np.ndarray:
    """Weights of ``size`` terms and the bias, fitted to texts (their terms, whether they are in the toxic sample)."""
    views = [_flat(terms[toxic == flag]) + (int((toxic == flag).sum()),) for flag in (True, False)]

    def gradient(w):
        margins = [np.bincount(row, weights=w[idx], minlength=n) + w[-1] for idx, row, n in views]
        *steps, _ = corrected_steps(*margins, prior)
        g = RIDGE * (w - START[0])
        g[-1] = 0.0
        for (idx, row, _), d in zip(views, steps):
            g += np.bincount(idx, weights=d[row], minlength=size + 1)
            g[-1] += d.sum()
        return g

    return _descend(gradient, size + 1)


@dataclass(frozen=True)
class ToxicityModel:
    """Terms (ascending hashes), their weights, bias; without terms every score is ``base``."""

    base: float
    terms: np.ndarray
    weights: np.ndarray
    bias: float = 0.0

    def score(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        n = len(offsets) - 1
        if not len(self.terms):
            return np.full(n, self.base)
        at, rows = known_terms(data, offsets, self.terms)
        return _sigmoid(np.bincount(rows, weights=self.weights[at], minlength=n) + self.bias)


def samples(docs: DataFrame, labels: DataFrame, target: str = "toxic") -> tuple[DataFrame, DataFrame, Prior | None]:
    """Confirmed toxic and unlabelled texts (_key, _text) outside the held-out rows, and the shares (None: no toxic rows)."""
    open_rows = lambda df: df.filter(F.col("doc_id").isNotNull() & (remainder(F.col("doc_id")) != 1))
    marks = open_rows(labels.filter(F.col(target).isNotNull())).groupBy("doc_id").agg(F.min(target).alias("y"))
    n, ones = marks.agg(F.count("*"), F.sum(F.when(F.col("y") > 0, 1).otherwise(0))).first()
    confirmed = C.materialize(marks.filter("y > 0"), "confirmed")
    toxic = labelled_sample(docs, confirmed, "y", MAX_TOXIC)
    ids = open_rows(docs.select("doc_id")).distinct().join(confirmed, "doc_id", "left_anti")
    most = ids.count()
    share = (ones or 0) / max(most + (ones or 0), 1)
    prior = None if not ones else Prior(ones / n, min(share, ones / n)) if ones < n else Prior(max(PRIOR, share), share)
    if most > 2 * MAX_UNLABELLED:  # hash values are spread evenly: about twice the bound is left, then the smallest
        ids = ids.filter(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 40)) < int((1 << 40) * 2.0 * MAX_UNLABELLED / most))
    unlabelled = labelled_sample(docs, ids.withColumn("y", F.lit(0)), "y", MAX_UNLABELLED)
    return toxic, unlabelled, prior


def fit_toxicity(docs: DataFrame, labels: DataFrame, target: str = "toxic") -> ToxicityModel:
    toxic, unlabelled, prior = samples(docs, labels, target)
    nothing = np.zeros(0, np.uint64)
    if prior is None:
        return ToxicityModel(0.0, nothing, nothing)
    both = toxic.select("_key", "_text", F.lit(True).alias("toxic")).unionByName(unlabelled.select("_key", "_text", F.lit(False).alias("toxic")))
    texts = C.materialize(one_of_copies(both), "pu_sample")
    n = {r["toxic"]: r["n"] for r in texts.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    if not n.get(True):
        return ToxicityModel(0.0, nothing, nothing)
    terms = telling_terms(texts.filter("toxic"), texts.filter("not toxic"), n[True], n.get(False, 0), prior)
    if not len(terms):
        return ToxicityModel(prior.toxic, nothing, nothing)
    shared = texts.sparkSession.sparkContext.broadcast(terms)

    def describe(batches):
        for batch in batches:
            for part, data, offsets in C.byte_slices(batch, "_text"):
                at, rows = known_terms(data, offsets, shared.value)
                cut = np.searchsorted(rows, np.arange(len(offsets)))
                held = [at[i:j].astype("<i4").tobytes() for i, j in zip(cut[:-1], cut[1:])]
                yield pa.RecordBatch.from_arrays([part.column("_key"), part.column("toxic"), pa.array(held, pa.binary())],
                                                 names=["key", "toxic", "terms"])

    # Every member reads the whole sample, at most MAX_TOXIC + MAX_UNLABELLED rows of a few term numbers.
    rows = texts.mapInArrow(describe, "key string, toxic boolean, terms binary").select(
        "*", F.explode(F.sequence(F.lit(0), F.lit(MEMBERS - 1))).alias("member"), F.pmod(F.xxhash64("key"), F.lit(MEMBERS)).alias("part"))
    size = len(terms)

    def train(member: tuple, frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values(["toxic", "key"])
        own = (frame["part"] == member[0]).to_numpy()
        flags = frame["toxic"].to_numpy(dtype=bool)
        if len(set(flags[~own])) < 2:
            own[:] = False
        w = fit_member(frame["terms"][~own], flags[~own], size, prior)
        return pd.DataFrame({"weights": [w]})

    got = rows.groupBy("member").applyInPandas(train, "weights array<double>").collect()  # MEMBERS rows
    w = np.mean([r["weights"] for r in got], axis=0)
    return ToxicityModel(prior.toxic, terms, w[:-1], float(w[-1]))


def score_texts(df: DataFrame, model: ToxicityModel, text: str = "text") -> DataFrame:
    """Adds ``score`` to every row (a column of that name is replaced)."""
    shared = df.sparkSession.sparkContext.broadcast(model)  # MAX_FEATURES terms at most

    @F.arrow_udf("double")
    def judge(texts: pa.Array) -> pa.Array:
        C.no_worker_state()
        batch = pa.RecordBatch.from_arrays([texts], names=["t"])
        parts = [shared.value.score(data, offsets) for _, data, offsets in C.byte_slices(batch, "t")]
        return pa.array(np.concatenate(parts) if parts else np.zeros(0), pa.float64())

    return df.select(*C.keep_columns(df, "score"), judge(F.col(f"`{text}`")).alias("score"))


def toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, held_out, score, predicted) of every row of ``docs`` (doc_id, text)."""
    scored = score_texts(docs.select("doc_id", "text"), fit_toxicity(docs, labels))
    return scored.select("doc_id", F.coalesce(remainder(F.col("doc_id")) == 1, F.lit(False)).alias("held_out"), "score",
                         (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
