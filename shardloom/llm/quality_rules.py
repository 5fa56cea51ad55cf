"""Quality rules: exact counting rules, then a hashed n-gram logistic model against a fixed threshold.

Words are maximal runs of bytes other than space and 0x09 to 0x0D. The counting rules reject
texts under ``MIN_WORDS`` words or with more than ``MAX_REPEAT_PERCENT`` % of the words inside
repeated 5-word windows. What passes them is scored by logistic regression on hashed words and
hashed byte n-grams (relative frequencies), trained on labelled rows and Platt-calibrated on
rows that the fit has not seen; a probability of good quality under ``THRESHOLD`` rejects.

Defined results: a null or blank text has zero counts and fails the base rules; repeated rows
are scored alike; without labelled rows of both classes the model gives 1 to every text (only
the counting rules reject). Columns of the input that carry an output's name are replaced.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shardloom.llm import common as C

MIN_WORDS = 10
MAX_REPEAT_PERCENT = 20
THRESHOLD = 0.2
#: Bound of the fit: labelled rows used at most (those of smallest hash), whole texts.
MAX_TRAIN_ROWS = 4000
WINDOW = 5
BITS = 16  # each of the two feature families has 2**BITS weights
GRAMS = (3, 4)

#: The characters counted as symbols.
SYMBOLS = "#*$%&|<>"
_IS_SYMBOL = np.zeros(256, bool)
_IS_SYMBOL[[ord(c) for c in SYMBOLS]] = True

RESULT = ("struct<n_words:bigint,word_chars:bigint,n_symbols:bigint,n_dup_lines:bigint,n_repeat_words:bigint,"
          "base_failed:boolean,quality_p:double,kept:boolean>")
FIELDS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "quality_p", "kept"]


def _seen_in_row(keys: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each (row, key): how many such entries there are, and whether the entry repeats an earlier one."""
    own = C.mix64(keys + rows.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    order = np.argsort(own, kind="stable")
    ranked = own[order]
    head = np.ones(len(own), bool)
    head[1:] = ranked[1:] != ranked[:-1]
    group = np.cumsum(head) - 1
    count = np.empty(len(own), np.int64)
    count[order] = np.bincount(group, minlength=0)[group] if len(own) else count
    later = np.empty(len(own), bool)
    later[order] = ~head
    return count, later


def base_counts(data: np.ndarray, offsets: np.ndarray) -> dict[str, np.ndarray]:
    """The counting rules of every row, plus the word spans for later use."""
    n = len(offsets) - 1
    starts, ends, rows = C.spans_of_words(data, offsets)
    sums = C.prefix_sums(data)
    hashes = C.span_hash(sums, starts, ends)
    n_words = np.bincount(rows, minlength=n)
    heads = np.concatenate(([0], np.cumsum((data & 0xC0) != 0x80)))
    word_chars = np.bincount(rows, weights=heads[ends] - heads[starts], minlength=n).astype(np.int64)
    symbols = np.concatenate(([0], np.cumsum(_IS_SYMBOL[data])))
    n_symbols = symbols[offsets[1:]] - symbols[offsets[:-1]]

    # Lines: cut after each \n and at row borders; those without a word do not count.
    breaks = np.flatnonzero(data == 10)
    line_start = np.union1d(breaks + 1, offsets[:-1])
    line_start = line_start[line_start < len(data)]
    line_end = np.append(line_start[1:], len(data)) if len(line_start) else line_start
    if len(line_end):
        line_end = line_end - (data[line_end - 1] == 10)
    line_row = C.doc_of(line_start, offsets)
    worded = np.searchsorted(starts, line_end) > np.searchsorted(starts, line_start)
    _, dup = _seen_in_row(C.span_hash(sums, line_start[worded], line_end[worded]), line_row[worded])
    n_dup_lines = np.bincount(line_row[worded][dup], minlength=n)

    windows, first = C.window_hash(hashes, rows, WINDOW)
    count, _ = _seen_in_row(windows, rows[first])
    twice = first[count > 1]
    cover = np.zeros(len(starts) + WINDOW + 1, np.int64)
    np.add.at(cover, twice, 1)
    np.add.at(cover, twice + WINDOW, -1)
    inside = np.cumsum(cover)[:len(starts)] > 0
    n_repeat_words = np.bincount(rows[inside], minlength=n)
    return {"n_words": n_words, "word_chars": word_chars, "n_symbols": n_symbols, "n_dup_lines": n_dup_lines,
            "n_repeat_words": n_repeat_words, "rows": rows, "hashes": hashes,
            "base_failed": (n_words < MIN_WORDS) | (100 * n_repeat_words > MAX_REPEAT_PERCENT * n_words)}


def gram_buckets(data: np.ndarray, k: int) -> np.ndarray:
    """Hash bucket of the k-gram at every byte that has k - 1 followers (row borders are the caller's)."""
    n = len(data) - k + 1
    if n <= 0:
        return np.zeros(0, np.int64)
    word = np.zeros(n, np.uint32)
    for i in range(k):
        word = (word << np.uint32(8)) | data[i:i + n]
    word = word * np.uint32(0x9E3779B1) + np.uint32(k)
    word ^= word >> np.uint32(15)
    word = word * np.uint32(0x85EBCA6B)
    return (word >> np.uint32(32 - BITS)).astype(np.int64)


def _within(offsets: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """First and one-past-last k-gram start of each row."""
    first, last = offsets[:-1], np.maximum(offsets[1:] - k + 1, offsets[:-1])
    return first, last


def hashed_features(data: np.ndarray, offsets: np.ndarray, rows: np.ndarray, hashes: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """Per row: sorted feature indices and relative frequencies (training form)."""
    word_at = np.searchsorted(rows, np.arange(len(offsets)))
    buckets = (hashes >> np.uint64(64 - BITS)).astype(np.int64)
    grams = {k: gram_buckets(data, k) for k in GRAMS}
    out = []
    for i in range(len(offsets) - 1):
        parts = [(0, buckets[word_at[i]:word_at[i + 1]])]
        for k in GRAMS:
            first, last = _within(offsets, k)
            parts.append((1 << BITS, grams[k][first[i]:last[i]]))
        idx, val = [], []
        for base, b in parts:
            if len(b):
                u, c = np.unique(b, return_counts=True)
                idx.append(u + base)
                val.append(c / len(b))
        out.append((np.concatenate(idx), np.concatenate(val)) if idx else (np.zeros(0, np.int64), np.zeros(0)))
    return out


@dataclass(frozen=True)
class QualityModel:
    """Weights of the hashed features and the calibration; ``weights`` is None if there was nothing to learn from."""

    weights: np.ndarray | None
    bias: float = 0.0
    slope: float = 1.0
    shift: float = 0.0

    def margin(self, data: np.ndarray, offsets: np.ndarray, rows: np.ndarray, hashes: np.ndarray) -> np.ndarray:
        n, w = len(offsets) - 1, self.weights
        out = np.full(n, self.bias)
        word_w = w[(hashes >> np.uint64(64 - BITS)).astype(np.int64)]
        words = np.bincount(rows, minlength=n)
        out += np.bincount(rows, weights=word_w, minlength=n) / np.maximum(words, 1)
        for k in GRAMS:
            run = np.concatenate(([0.0], np.cumsum(w[(1 << BITS) + gram_buckets(data, k)], dtype=np.float64)))
            first, last = _within(offsets, k)
            first, last = np.minimum(first, len(run) - 1), np.minimum(last, len(run) - 1)
            out += (run[last] - run[first]) / np.maximum(last - first, 1)
        return out

    def probability(self, *views) -> np.ndarray:
        if self.weights is None:
            return np.ones(len(views[1]) - 1)
        return _sigmoid(self.slope * self.margin(*views) + self.shift)


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(z, -60, 60)))


def labelled_sample(docs: DataFrame, labels: DataFrame, target: str, max_rows: int, key: str = "doc_id", text: str = "text") -> DataFrame:
    """At most ``max_rows`` labelled documents (smallest key hash first), one row per key: (key, text, y)."""
    one = (labels.filter(F.col(key).isNotNull() & F.col(target).isNotNull())
           .groupBy(F.col(key).alias("_key")).agg(F.min(F.col(target)).alias("_y")))
    chosen = one.orderBy(F.xxhash64("_key"), "_key").limit(max_rows)
    rows = (docs.select(F.col(key).alias("_key"), F.col(text).alias("_text"))
            .join(F.broadcast(chosen), "_key"))  # at most max_rows rows
    # A key may be repeated in any number of rows: the text with the smallest hash stands for it.
    low = F.min(F.struct(F.xxhash64("_text").alias("h"), F.col("_text").alias("t"))).alias("low")
    return rows.groupBy("_key", "_y").agg(low).select("_key", F.col("low.t").alias("_text"), "_y")


def _featurise(batches):
    C.no_worker_state()
    for batch in batches:
        for part, data, offsets in C.byte_slices(batch, "_text"):
            base = base_counts(data, offsets)
            pairs = hashed_features(data, offsets, base["rows"], base["hashes"])
            yield pa.RecordBatch.from_arrays(
                [part.column("_key").cast(pa.int64()), part.column("_y").cast(pa.int64()),
                 pa.array([i.astype("<i4").tobytes() for i, _ in pairs], pa.binary()),
                 pa.array([v.astype("<f4").tobytes() for _, v in pairs], pa.binary())], names=["key", "y", "idx", "val"])


def fit_quality(docs: DataFrame, labels: DataFrame, *, target: str = "quality", max_rows: int = MAX_TRAIN_ROWS,
                steps: int = 80, rate: float = 0.5, ridge: float = 1e-6) -> QualityModel:
    """Logistic regression on the labelled sample; every fourth row is kept for the calibration.

    The rows are turned into features by Spark tasks and reach one task, which fits (at most ``max_rows``
    sparse vectors, the documented bound of the fit); the driver receives the weights only.
    """
    sample = labelled_sample(docs, labels, target, max_rows)
    features = sample.mapInArrow(_featurise, "key bigint, y bigint, idx binary, val binary")

    def fit(rows: pa.Table) -> pa.Table:
        model = fit_rows(rows, steps, rate, ridge)
        C.release_memory()
        weights = None if model.weights is None else model.weights.astype("<f4").tobytes()
        return pa.table({"weights": pa.array([weights], pa.binary()), "bias": [model.bias], "slope": [model.slope], "shift": [model.shift]})

    # The group is the sample, which the fit bounds.
    got = features.withColumn("fit", F.lit(0)).groupBy("fit").applyInArrow(fit, "weights binary, bias double, slope double, shift double").first()
    if got is None or got["weights"] is None:
        return QualityModel(None)
    return QualityModel(np.frombuffer(got["weights"], "<f4"), got["bias"], got["slope"], got["shift"])


def fit_rows(got: pa.Table, steps: int, rate: float, ridge: float) -> QualityModel:
    """The fit over rows of (key, y, idx, val)."""
    order = pc.sort_indices(got, [("key", "ascending"), ("y", "ascending")])
    y = got["y"].take(order).to_numpy().astype(float)
    held = np.arange(len(y)) % 4 == 3
    if len(set(y[~held])) < 2 or len(set(y[held])) < 2:
        held[:] = False
    if len(set(y)) < 2:
        return QualityModel(None)
    cols, at = C.text_view(got["idx"].take(order))
    vals, _ = C.text_view(got["val"].take(order))
    del got
    cols, vals, at = cols.view("<i4"), vals.view("<f4"), at // 4

    def chunks(size: int = 256):
        for i in range(0, len(y), size):
            j = min(i + size, len(y))
            span = slice(at[i], at[j])
            yield i, j, np.repeat(np.arange(j - i), np.diff(at[i:j + 1])), cols[span], vals[span]

    def margins(w: np.ndarray, bias: float) -> np.ndarray:
        return np.concatenate([np.bincount(of, weights=v * w[c], minlength=j - i) for i, j, of, c, v in chunks()]) + bias

    t, fit = y, ~held
    share = fit * np.where(t > 0, 0.5 / max(t[fit].sum(), 1), 0.5 / max((1 - t[fit]).sum(), 1))
    w, bias = np.zeros(2 << BITS), 0.0
    m, v, mb, vb = np.zeros_like(w), np.zeros_like(w), 0.0, 0.0
    for step in range(1, steps + 1):
        g, gb = ridge * w, 0.0
        for i, j, of, c, x in chunks():
            p = _sigmoid(np.bincount(of, weights=x * w[c], minlength=j - i) + bias)
            err = (p - t[i:j]) * share[i:j]
            g += np.bincount(c, weights=x * err[of], minlength=len(w))
            gb += err.sum()
        m, v = 0.9 * m + 0.1 * g, 0.99 * v + 0.01 * g * g
        mb, vb = 0.9 * mb + 0.1 * gb, 0.99 * vb + 0.01 * gb * gb
        up, down = 1 - 0.9 ** step, 1 - 0.99 ** step
        w -= rate * (m / up) / (np.sqrt(v / down) + 1e-7)
        bias -= rate * (mb / up) / (np.sqrt(vb / down) + 1e-7)
    check = held if held.any() else fit
    slope, shift = platt(margins(w, bias)[check], y[check])
    return QualityModel(w.astype(np.float32), bias, slope, shift)


def platt(z: np.ndarray, y: np.ndarray, steps: int = 50) -> tuple[float, float]:
    """Slope and shift of the logistic calibration (Newton steps, smoothed targets)."""
    pos, neg = y.sum(), len(y) - y.sum()
    t = np.where(y > 0, (pos + 1) / (pos + 2), 1 / (neg + 2))
    scale = max(float(np.abs(z).max(initial=0.0)), 1e-9)
    x = np.stack([z / scale, np.ones_like(z)], 1)
    beta = np.zeros(2)

    def loss(b):
        s = x @ b
        return float(np.sum(np.logaddexp(0, s) - t * s))

    for _ in range(steps):
        p = _sigmoid(x @ beta)
        grad = x.T @ (p - t)
        move = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + 1e-6 * np.eye(2), grad)
        size, now = 1.0, loss(beta)
        while size > 1e-4 and loss(beta - size * move) > now:
            size /= 2
        beta = beta - size * move
        if np.abs(size * move).max() < 1e-8:
            break
    if beta[0] <= 0:  # the held-out rows do not bear the fit out: fall back to the margin itself
        return 1.0, 0.0
    return float(beta[0] / scale), float(beta[1])


def apply_quality(df: DataFrame, model: QualityModel, text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """Adds the columns of ``FIELDS`` to every row of ``df``."""
    shared = df.sparkSession.sparkContext.broadcast(model)  # 2**17 weights whatever the input

    @F.arrow_udf(RESULT)
    def judge(texts: pa.Array) -> pa.Array:
        C.no_worker_state()
        batch = pa.RecordBatch.from_arrays([texts], names=["t"])
        parts: dict[str, list] = {f: [] for f in FIELDS}
        for _, data, offsets in C.byte_slices(batch, "t"):
            base = base_counts(data, offsets)
            p = shared.value.probability(data, offsets, base["rows"], base["hashes"])
            base |= {"quality_p": p, "kept": ~base["base_failed"] & (p >= threshold)}
            for f in FIELDS:
                parts[f].append(base[f])
        kinds = {"base_failed": bool, "kept": bool, "quality_p": np.float64}
        return pa.StructArray.from_arrays(
            [pa.array(np.concatenate([a.astype(kinds.get(f, np.int64)) for a in parts[f]]) if parts[f] else np.zeros(0, kinds.get(f, np.int64)))
             for f in FIELDS], names=FIELDS)

    held = C.free_name(df, "_q")
    got = df.select(*C.keep_columns(df, *FIELDS), judge.asNondeterministic()(F.col(text)).alias(held))
    return got.select(*C.keep_columns(got, held), *[F.col(held)[f].alias(f) for f in FIELDS])
