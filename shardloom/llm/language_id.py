"""Language identification by Bayesian evidence fusion.

Four kinds of evidence about a row's language are added as log probabilities:

* text: hashed byte trigrams of letters and word borders under one profile per language, plus a
  uniform profile ``und`` for text in no known language (a text without any such trigram is one). The mean log-likelihood counts as at most ``TEXT_GRAMS``
  independent grams, so that overlapping grams do not drown the other evidence;
* declared language (markup attribute, or a column): P(declared | language);
* address suffix (top-level label and two-letter path segment): P(suffix | language);
* host prior P(language | host), smoothed hierarchically: host towards registered domain
  towards all rows, each level with weight ``PARENT`` and without the row's own contribution.

All but the profiles come from one grouped aggregation of the rows' text posteriors over every
row; its table has a row per (host, suffix, declared). The profiles are fitted on a bounded,
hash-chosen sample (``PROFILE_ROWS`` rows in expectation) of each declared language; every
language code that is declared has a profile (codes have two or three letters).

Defined results: a row with neither text nor other evidence gets the smoothed prior of its host
(of all rows, if the host is null); ``kept`` is false where ``und`` wins, where the text has no
trigram at all and nothing was declared, or where the best posterior is under ``MIN_POSTERIOR``.
Without any declared language every row is ``und`` and not kept. Repeated rows count repeatedly.
Columns of the input that carry an output's name are replaced.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shardloom.llm import common as C

BITS = 16
TEXT_GRAMS = 60
PARENT = 8.0
MIN_POSTERIOR = 0.5
PROFILE_ROWS = 1500
#: Tables of hosts, suffixes or declared values up to this many rows are broadcast; larger ones are shuffled.
BROADCAST_ROWS = 100_000
#: Prior mass, in rows, of a declared value (or country suffix) being true.
TRUST = 4.0
UND = "und"
OUTPUT = ["language", "posterior", "text_language", "kept"]

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def fold_case(data: np.ndarray) -> np.ndarray:
    """Lower case for ASCII and the Latin-1 letters (C3 80 to C3 9E in UTF-8)."""
    out = _LOWER[data]
    if len(data) > 1:
        upper = (data[:-1] == 0xC3) & (data[1:] >= 0x80) & (data[1:] <= 0x9E) & (data[1:] != 0x97)
        out[1:][upper] += 32
    return out


#: Bytes that say something about a language: letters (all of UTF-8 beyond ASCII), and what stands between words.
_LETTER = np.zeros(256, bool)
_LETTER[[*range(65, 91), *range(97, 123), *range(128, 256)]] = True
_SPOKEN = _LETTER.copy()
_SPOKEN[[32, 10, 13, 9, 39]] = True
#: Log evidence for ``und`` of a text without any trigram of such bytes.
SPEECHLESS = 20.0


def spoken_trigrams(data: np.ndarray) -> np.ndarray:
    """Which trigrams (by first byte) consist of letters and word borders; numbers, addresses and symbols are in every language."""
    n = len(data) - 2
    if n <= 0:
        return np.zeros(0, bool)
    fit, letter = _SPOKEN[data], _LETTER[data]
    return fit[:n] & fit[1:n + 1] & fit[2:] & (letter[:n] | letter[1:n + 1] | letter[2:])


def trigram_buckets(data: np.ndarray) -> np.ndarray:
    n = len(data) - 2
    if n <= 0:
        return np.zeros(0, np.int64)
    d = fold_case(data).astype(np.uint32)
    gram = (d[:n] << np.uint32(16)) | (d[1:n + 1] << np.uint32(8)) | d[2:]
    gram = gram * np.uint32(0x9E3779B1)
    gram ^= gram >> np.uint32(13)
    gram = gram * np.uint32(0xC2B2AE35)
    return (gram >> np.uint32(32 - BITS)).astype(np.int64)


@dataclass(frozen=True)
class Profiles:
    """Languages (``und`` last) and their log probabilities, one column per language."""

    names: tuple[str, ...]
    table: np.ndarray

    def text_scores(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Weighted text log-likelihood of every row (rows x languages); zeros without a text."""
        first, last = offsets[:-1], np.maximum(offsets[1:] - 2, offsets[:-1])
        spoken = spoken_trigrams(data)
        first, last = np.minimum(first, len(spoken)), np.minimum(last, len(spoken))
        buckets = trigram_buckets(data)[spoken]
        before = np.concatenate(([0], np.cumsum(spoken)))
        first, last = before[first], before[last]
        n = last - first
        out = np.zeros((len(n), len(self.names)))
        for k in range(len(self.names)):
            run = np.concatenate(([0.0], np.cumsum(self.table[:, k][buckets], dtype=np.float64)))
            out[:, k] = run[last] - run[first]
        out = out / np.maximum(n, 1)[:, None] * np.minimum(n, TEXT_GRAMS)[:, None]
        out[(n == 0) & (np.diff(offsets) > 2), -1] = SPEECHLESS
        return out


def _count_grams(batches):
    for batch in batches:
        for part, data, offsets in C.byte_slices(batch, "t"):
            langs = np.array(part.column("d").to_pylist(), object)
            first, last = offsets[:-1], np.maximum(offsets[1:] - 2, offsets[:-1])
            buckets, spoken = trigram_buckets(data), spoken_trigrams(data)
            for name in sorted(set(langs)):
                picked = [buckets[first[i]:last[i]][spoken[first[i]:last[i]]] for i in np.flatnonzero(langs == name)]
                u, c = np.unique(np.concatenate(picked), return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array([name] * len(u), pa.string()), pa.array(u, pa.int64()), pa.array(c, pa.int64())],
                                                 names=["d", "bucket", "n"])


def fit_profiles(evidence: DataFrame, rows: int = PROFILE_ROWS) -> Profiles:
    """Trigram profiles from rows with a declared language; ``evidence`` has ``t``, ``declared`` and ``row_hash``."""
    known = evidence.filter(F.col("declared").isNotNull() & (F.length("t") > 0))
    rates = known.groupBy("declared").agg(F.count("*").alias("n"))
    share = (F.pmod(F.col("row_hash"), F.lit(1 << 20)) / F.lit(float(1 << 20)))
    sample = (known.join(F.broadcast(rates), "declared")  # a row per two- or three-letter code
              .filter(share < F.lit(float(rows)) / F.col("n")).select(F.col("declared").alias("d"), "t"))
    counts = (sample.mapInArrow(_count_grams, "d string, bucket bigint, n bigint")
              .groupBy("d", "bucket").agg(F.sum("n").alias("n"))
              .groupBy("d").agg(F.collect_list(F.struct("bucket", "n")).alias("grams"))  # at most 2**BITS entries
              .select("d", F.col("grams.bucket").alias("bucket"), F.col("grams.n").alias("n")).toArrow().sort_by("d"))
    names = tuple(counts["d"].to_pylist()) + (UND,)
    table = np.full((1 << BITS, len(names)), -BITS * np.log(2.0), np.float32, order="F")
    for k in range(len(names) - 1):
        n = np.zeros(1 << BITS)
        n[counts["bucket"][k].values.to_numpy()] = counts["n"][k].values.to_numpy()
        table[:, k] = np.log((n + 0.25) / (n.sum() + 0.25 * len(n)))
    return Profiles(names, table)


def evidence_of(df: DataFrame, text: Column, declared: Column, host: Column, suffix: Column, carry: list[str] | None = None) -> DataFrame:
    """The evidence of every row of ``df``, normalised, and the columns to carry (all by default) inside a struct ``row``."""
    code = F.lower(F.regexp_extract(F.trim(declared), r"^([A-Za-z]{2,3})(?:[-_].*)?$", 1))
    name = F.nullif(F.lower(F.trim(host)), F.lit(""))
    carry = [c for c in (df.columns if carry is None else carry) if c not in OUTPUT]
    row = F.struct(*[F.col(f"`{c}`") for c in carry]) if carry else F.struct(F.lit(0).alias("none"))
    return df.select(row.alias("row"), F.coalesce(text, F.lit("")).alias("t"), F.nullif(code, F.lit("")).alias("declared_"),
                     name.alias("host_"), F.nullif(F.lower(suffix), F.lit("")).alias("suffix_"),
                     F.xxhash64(*[F.col(f"`{c}`") for c in df.columns]).alias("row_hash"))


def address_parts(url: Column) -> tuple[Column, Column]:
    """Host of an address, and its suffix: top-level label, with the first two-letter path segment."""
    host = F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)", 1))
    label = F.regexp_extract(host, r"\.([a-z]+)$", 1)
    segment = F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]+/([A-Za-z]{2})(?:[/?#]|$)", 1))
    return host, F.concat(label, F.when(segment != "", F.concat(F.lit("/"), segment)).otherwise(F.lit("")))


def markup_language(html: Column) -> Column:
    return F.regexp_extract(html, r"(?i)<html\b[^>]*?\slang\s*=\s*[\"']?([A-Za-z]{2,3}(?:[-_][A-Za-z0-9]+)*)", 1)


def visible_text(html: Column) -> Column:
    """Text of a page for scoring: no scripts, styles, comments or tags."""
    bare = F.regexp_replace(html, r"(?is)<(script|style)\b.*?(?:</\1\s*>|\z)|<!--.*?(?:-->|\z)|<[^>]*>", " ")
    return F.regexp_replace(bare, r"&(?:#\w{1,7}|\w{1,8});", " ")


def _softmax(scores: np.ndarray) -> np.ndarray:
    z = np.exp(scores - scores.max(axis=1, keepdims=True))
    return z / z.sum(axis=1, keepdims=True)


def _rows_of(column: pa.Array, k: int) -> np.ndarray:
    return column.flatten().to_numpy().reshape(len(column), k)


def _lists(rows: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(np.arange(len(rows) + 1) * rows.shape[1], pa.int32()), pa.array(rows.ravel(), pa.float64()))


def _scores_udf(spark, profiles: Profiles):
    """Text scores of each language and the posterior they give alone."""
    shared = spark.sparkContext.broadcast(profiles)  # 2**BITS weights per declared language and for `und`

    @F.arrow_udf("struct<s:array<double>,p:array<double>>")
    def scores(texts: pa.Array) -> pa.Array:
        C.no_worker_state()
        batch = pa.RecordBatch.from_arrays([texts], names=["t"])
        got = [shared.value.text_scores(data, offsets) for _, data, offsets in C.byte_slices(batch, "t")]
        rows = np.concatenate(got) if got else np.zeros((0, len(shared.value.names)))
        return pa.StructArray.from_arrays([_lists(rows), _lists(_softmax(rows) if len(rows) else rows)], names=["s", "p"])

    return scores.asNondeterministic()


def _fusion_udf(names: tuple[str, ...], prior: np.ndarray):
    """The decision of each row from its text scores and its host's, suffix's and declared value's evidence."""
    k = len(names)

    @F.arrow_udf("struct<language:string,posterior:double,text_language:string,kept:boolean>")
    def fuse(scores: pa.Array, own: pa.Array, host: pa.Array, domain: pa.Array, known: pa.Array, declared: pa.Array, suffix: pa.Array,
             length: pa.Array, silent: pa.Array) -> pa.Array:
        s, p, h, m, d, x = (_rows_of(c, k) for c in (scores, own, host, domain, declared, suffix))
        mine = p * known.to_numpy(zero_copy_only=False)[:, None]  # a row is no evidence for itself
        normal = lambda v: v / v.sum(axis=1, keepdims=True)
        parent = normal(np.maximum(m - mine, 0) + PARENT * prior)
        belief = normal(np.maximum(h - mine, 0) + PARENT * parent)
        post = _softmax(s + np.log(belief) + d + x)
        at, best = post.argmax(axis=1), post.max(axis=1)
        n = length.to_numpy()
        word = np.array(names, object)
        kept = (at != k - 1) & (best >= MIN_POSTERIOR) & ~((n < 3) & silent.to_numpy(zero_copy_only=False))
        return pa.StructArray.from_arrays(
            [pa.array(word[at], pa.string()), pa.array(best), pa.array(np.where(n >= 3, word[p.argmax(axis=1)], None), pa.string()), pa.array(kept)],
            names=OUTPUT)

    return fuse.asNondeterministic()


def _domain(host: Column) -> Column:
    return F.regexp_extract(host, r"([^.]+\.[^.]+|[^.]+)$", 1)


def _vector(prefix: str, k: int) -> Column:
    return F.array(*[F.coalesce(F.col(f"{prefix}{i}"), F.lit(0.0)) for i in range(k)])


def _small_or_shuffled(table: DataFrame) -> DataFrame:
    """Broadcast behind a count of the table; beyond the bound an ordinary (skew-split) join."""
    return F.broadcast(table) if table.count() <= BROADCAST_ROWS else table


def identify(evidence: DataFrame) -> DataFrame:
    """Fuse the evidence of ``evidence_of``; returns the carried columns and ``OUTPUT``."""
    spark = evidence.sparkSession
    carried = [f.name for f in evidence.schema["row"].dataType if f.name != "none"]
    plain = evidence.select("t", F.col("declared_").alias("declared"), "row_hash")
    profiles = fit_profiles(plain)
    names, k = profiles.names, len(profiles.names)
    scored = evidence.drop("row_hash").withColumn("_sp", _scores_udf(spark, profiles)(F.col("t")))

    # One grouped aggregation of soft counts; everything below is derived from its table.
    soft = scored.select("host_", "suffix_", "declared_", F.col("_sp.p").alias("_p"))
    table = C.materialize(soft.groupBy("host_", "suffix_", "declared_")
                          .agg(*[F.sum(F.col("_p")[i]).alias(f"c{i}") for i in range(k)]), "evidence")
    total = table.agg(*[F.sum(f"c{i}").alias(f"c{i}") for i in range(k)]).first()
    everywhere = np.array([total[i] or 0.0 for i in range(k)])
    prior = (everywhere + 1.0) / (everywhere + 1.0).sum()

    def rollup(by: Column, prefix: str, key: str) -> DataFrame:
        return (table.withColumn(key, by).filter(F.col(key).isNotNull()).groupBy(key)
                .agg(*[F.sum(f"c{i}").alias(f"{prefix}{i}") for i in range(k)]))

    hosts = rollup(F.col("host_"), "h", "_host").withColumn("_domain", _domain(F.col("_host")))
    domains = hosts.groupBy("_domain").agg(*[F.sum(f"h{i}").alias(f"m{i}") for i in range(k)])
    hosts = hosts.join(domains, "_domain").select("_host", _vector("h", k).alias("_hv"), _vector("m", k).alias("_mv"))

    def likelihood(key: str, prefix: str, trusted) -> DataFrame:
        """log P(value | language) for each value of the evidence, with TRUST rows of prior mass."""
        values = rollup(F.col(key), prefix, f"_{prefix}")
        n = max(table.filter(F.col(key).isNotNull()).select(key).distinct().count(), 1)
        seen = table.filter(F.col(key).isNotNull()).agg(*[F.sum(f"c{i}") for i in range(k)]).first()
        cells = []
        for i, name in enumerate(names):
            base = F.when(trusted(F.col(f"_{prefix}")) == F.lit(name), F.lit(TRUST)).otherwise(F.lit(1.0 / n))
            cells.append(F.log((F.col(f"{prefix}{i}") + base) / F.lit((seen[i] or 0.0) + TRUST + 1.0)))
        return values.select(F.col(f"_{prefix}").alias(key), F.array(*cells).alias(f"_{prefix}v"))

    declared = likelihood("declared_", "d", lambda v: v)
    country = lambda v: F.when(F.instr(v, "/") > 0, F.substring_index(v, "/", -1)).otherwise(v)
    suffixes = likelihood("suffix_", "x", country)

    flat = F.array(*[F.lit(0.0)] * k)
    joined = (scored.join(_small_or_shuffled(hosts.withColumnRenamed("_host", "host_")), "host_", "left")
              .join(_small_or_shuffled(declared), "declared_", "left")
              .join(_small_or_shuffled(suffixes), "suffix_", "left"))
    fuse = _fusion_udf(names, prior)
    decided = joined.withColumn("_d", fuse(F.col("_sp.s"), F.col("_sp.p"), F.coalesce("_hv", flat), F.coalesce("_mv", flat), F.col("_hv").isNotNull(),
                                           F.coalesce("_dv", flat), F.coalesce("_xv", flat), F.length("t"), F.col("declared_").isNull()))
    return decided.select(*[F.col("row")[c].alias(c) for c in carried], *[F.col("_d")[c].alias(c) for c in OUTPUT])


def identify_documents(docs: DataFrame) -> DataFrame:
    """Documents: ``lang`` is the declared language and ``source`` stands for the host."""
    return identify(evidence_of(docs, F.col("text"), F.col("lang"), F.col("source"), F.lit(None).cast("string")))
