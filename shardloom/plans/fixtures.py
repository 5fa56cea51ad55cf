"""Derived inputs built from the given tables with fixed formulas.

The same formulas are written in the DuckDB oracle SQL, so both sides start from the
same rows. All of them are Spark jobs over the whole tables.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import text as T
from ..operators import shards as S
from ..operators.clean import clean_lines
from ..session import materialize, read_table, shared
from ..sources.registry import SourceSpec, registry_caps, registry_policies

FIXTURE_DOCS_PER_SHARD = 5
# Split thresholds used by the oracles: 500 and 1,500 per 10,000.
FIXTURE_TEST_FRAC = 0.05
FIXTURE_VAL_FRAC = 0.10

# The registry's entries for the twenty sources of ``documents``: policy and shard cap by number.
REGISTRY = [SourceSpec(f"src{n}", "documents.parquet", policy=("wikitext", "bookcorpus", "default")[n % 3],
                       max_shards=n % 7 + 1 if n % 2 else None) for n in range(20)]
SOURCES = [s.name for s in REGISTRY]
POLICIES, SHARD_CAPS = registry_policies(REGISTRY), registry_caps(REGISTRY)


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The raw corpus as (source, split, doc_id, text); every document is split 'train'."""
    d = read_table(spark, sf_dir, "documents")
    return d.select("source", F.lit("train").alias("split"), "doc_id", "text")


def sharded_documents(spark: SparkSession, sf_dir: str,
                      docs_per_shard: int = FIXTURE_DOCS_PER_SHARD) -> DataFrame:
    """The documents numbered and sharded; numbered once, whatever reads them."""
    return shared(spark, "sharded", (sf_dir, docs_per_shard), lambda: S.assign_shards(documents(spark, sf_dir), docs_per_shard))


def cleaned_lines(spark: SparkSession, sf_dir: str,
                  docs_per_shard: int = FIXTURE_DOCS_PER_SHARD) -> DataFrame:
    """Sharded documents -> non-blank lines -> policy rule chain + quality gate."""
    lines = S.explode_lines(sharded_documents(spark, sf_dir, docs_per_shard))
    return clean_lines(lines, T.policy_of_registry(F.col("source"), POLICIES))


def kept_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The kept lines as a written table: deduplication reads it twice, and cleans nothing again."""
    def make():
        c = cleaned_lines(spark, sf_dir).filter("kept")
        return materialize(c.select("source", "split", "shard_idx", "shard_id", "doc_ordinal", "doc_id", "line_idx", "cleaned", "sha1", "kept"), "kept")
    return shared(spark, "kept", sf_dir, make)


def shard_table(spark: SparkSession, sf_dir: str,
                docs_per_shard: int = FIXTURE_DOCS_PER_SHARD) -> DataFrame:
    """One row per shard: (source, split, shard_idx, shard_id, n) with n = number in srcN; from counts, no text is read."""
    return (S.shards_of(documents(spark, sf_dir), docs_per_shard)
            .withColumn("n", F.regexp_extract("source", "([0-9]+)$", 1).cast("long")))


def _contents(batches):
    """(shard_id, length, checksum) of shards that come sorted, whose text is never whole in memory; a null text is nothing."""
    now, length, digest, started = None, 0, None, False
    for batch in batches:
        rows = []
        for shard, text in zip(batch.column("shard_id").to_pylist(), batch.column("text").to_pylist()):
            if not started or shard != now:
                if started:
                    rows.append((now, length, digest.hexdigest()))
                now, length, digest, started = shard, 0, hashlib.sha256(), True
            if text is not None:
                digest.update(text + b"\n")
                length += len(text) + 1
        yield _content_rows(rows)
    if started:
        yield _content_rows([(now, length, digest.hexdigest())])


def _content_rows(rows: list[tuple]) -> pa.RecordBatch:
    types = pa.schema([("shard_id", pa.string()), ("length", pa.int64()), ("checksum", pa.string())])
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], f.type) for i, f in enumerate(types)], schema=types)


def shard_contents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(shard_id, length, checksum) that a shard's text file has to have, from its documents.

    A shard's documents are sorted into one task, as they are to be written; they are not gathered in a group, whose
    aggregation would sort and spill the texts again."""
    docs = sharded_documents(spark, sf_dir).select("shard_id", "doc_id", F.col("text").cast("binary").alias("text"))
    rows = docs.repartition("shard_id").sortWithinPartitions("shard_id", "doc_id", "text").select("shard_id", "text")
    return rows.mapInArrow(_contents, "shard_id string, length bigint, checksum string")


def derived_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ledger rows: one stage per source, k = n*10 + shard_idx (see FIXTURES.md); checksums of the shards' contents."""
    return shared(spark, "ledger", sf_dir, lambda: _derived_ledger(spark, sf_dir))


def _derived_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    sh = shard_table(spark, sf_dir).join(shard_contents(spark, sf_dir), "shard_id")
    k = F.col("n") * 10 + F.col("shard_idx")
    r = F.pmod(k, F.lit(10))
    state = (F.when((F.pmod(F.col("n"), F.lit(4)) == 0) | (r < 6), F.lit("done"))
             .when(r == 6, F.lit("verified")).when(r == 7, F.lit("processing"))
             .when(r == 8, F.lit("failed")).otherwise(F.lit("pending")))
    led = sh.select(
        F.col("source").alias("stage"), "shard_id", state.alias("state"),
        F.concat(F.lit("out/"), F.col("shard_id"), F.lit(".bin")).alias("output_path"), "checksum",
        (k * 100).cast("long").alias("token_count"),
        (F.lit(1700000000) + k * 60).cast("double").alias("updated_at"),
        F.when(state == "failed", F.concat(F.lit("error in "), F.col("shard_id")))
         .otherwise(F.lit("")).alias("error"),
        k.alias("k"))
    return materialize(led, "ledger")                       # read several times by each ledger query


LEDGER_NOW = 1700010000.0


def derived_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Output files as found on the file system, as (path, length, file_checksum).

    Shard files are written without those of k%17=0 and with a changed text where k%19=0; what
    comes back is their listing and the checksums of their bytes.
    """
    return shared(spark, "files", sf_dir, lambda: materialize(_derived_files(spark, sf_dir), "files"))


def _derived_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ..operators.integrity import file_checksums
    from ..session import scratch_path
    from ..sources.textshards import write_text_shards
    docs = sharded_documents(spark, sf_dir)
    k = F.regexp_extract("source", "([0-9]+)$", 1).cast("long") * 10 + F.col("shard_idx")
    out = docs.filter(F.pmod(k, F.lit(17)) != 0).withColumn("text", F.when(F.pmod(k, F.lit(19)) == 0, F.concat("text", F.lit("#altered"))).otherwise(F.col("text")))
    path = scratch_path(spark, "outputs")
    write_text_shards(out, path)
    found = file_checksums(spark, path, "*.txt")
    return found.select(F.concat(F.lit("out/"), shard_of_path(F.col("path")), F.lit(".bin")).alias("path"), "length", "file_checksum")


def shard_of_path(path):
    """Shard id of a file under source=/split=/shard_idx= folders; escaped names as written."""
    part = lambda name: F.regexp_extract(path, f"/{name}=([^/]+)/", 1)
    plain = lambda c: F.url_decode(F.url_decode(c))  # noqa: E731  # the path's own escapes, then the folder's
    return T.shard_id_expr(plain(part("source")), plain(part("split")), part("shard_idx").cast("int"))


STAGES = ["download", "clean", "train_tokenizer", "tokenize", "pack"]
EVENT_OF = {"signup": "start", "view": "progress", "click": "progress",
            "purchase": "end", "error": "error"}


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_table(spark, sf_dir, "events").withColumn("ts", F.col("ts").cast("timestamp"))


def stage_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stage events from ``events``: run_id=user_id, stage=event_id%5, event by type."""
    ev = _events(spark, sf_dir)
    stage = F.element_at(F.array(*[F.lit(s) for s in STAGES]), (F.pmod("event_id", F.lit(5)) + 1).cast("int"))
    kind = F.coalesce(*[F.when(F.col("event_type") == k, F.lit(v)) for k, v in EVENT_OF.items()])
    return ev.select(F.col("user_id").alias("run_id"), stage.alias("stage"), kind.alias("event"),
                     "ts", "event_id", "value",
                     F.create_map(F.lit("value"), F.col("value").cast("string")).alias("metrics"))


def train_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Train events: step = 1-based position by (ts, event_id) per run; every 5th is eval.

    Positions come from ``global_ordinal`` (range partitioned), so one run with a large
    share of the events is not numbered in a single task.
    """
    from ..operators.ordinal import global_ordinal
    ev = _events(spark, sf_dir).select(F.col("user_id").alias("run_id"), "ts", "event_id", "value")
    df = global_ordinal(ev, ["run_id"], ["ts", "event_id"], "_ord")
    df = df.withColumn("step", (F.col("_ord") + 1).cast("int")).drop("_ord")
    is_eval = F.pmod(F.col("step"), F.lit(5)) == 0
    return df.select("run_id", "step", "ts", "event_id",
                     F.when(is_eval, F.lit("eval")).otherwise(F.lit("train")).alias("type"),
                     F.when(~is_eval, F.col("value")).alias("loss"),
                     F.when(is_eval, F.col("value")).alias("val_loss"))


def derived_listing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files under each stage's artifact folder: the written files, some placed in protected-looking sub-folders."""
    files = derived_files(spark, sf_dir).select(F.col("path").alias("output_path"), "length")
    led = derived_ledger(spark, sf_dir).join(files, "output_path")
    k = F.col("k")
    sub = (F.when(F.pmod(k, F.lit(7)) == 0, F.lit("logs/")).when(F.pmod(k, F.lit(11)) == 0, F.lit("tokenizer/"))
           .when(F.pmod(k, F.lit(13)) == 0, F.lit("blogs/")).otherwise(F.lit("")))
    path = F.concat(F.lit("data/raw/shards/"), F.col("stage"), F.lit("/"), sub, F.col("shard_id"), F.lit(".txt"))
    return led.select("stage", path.alias("path"), "length")


def artifact_dirs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One artifact folder per stage; stage src4 points into a protected folder."""
    st = derived_ledger(spark, sf_dir).select("stage").distinct()
    d = (F.when(F.col("stage") == "src4", F.lit("data/manifests/src4/"))
         .otherwise(F.concat(F.lit("data/raw/shards/"), F.col("stage"), F.lit("/"))))
    return st.select("stage", d.alias("artifact_dir"))


def ledger_updates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Transition batch: pending -> processing; failed -> verified -> done; processing -> failed."""
    led = derived_ledger(spark, sf_dir)
    r = F.pmod(F.col("k"), F.lit(10))
    ts = F.lit(LEDGER_NOW) + F.col("k")
    base = led.filter(F.col("state").isin("pending", "failed", "processing"))
    proc = base.filter(F.col("state") == "pending").select("stage", "shard_id", F.lit("processing").alias("op"), ts.alias("ts"))
    ver = base.filter(F.col("state") == "failed").select("stage", "shard_id", F.lit("verified").alias("op"), ts.alias("ts"))
    dn = base.filter(F.col("state") == "failed").select("stage", "shard_id", F.lit("done").alias("op"), (ts + 1).alias("ts"))
    fl = base.filter(F.col("state") == "processing").select("stage", "shard_id", F.lit("failed").alias("op"), ts.alias("ts"))
    u = proc.unionByName(ver).unionByName(dn).unionByName(fl)
    del r
    return u.select("stage", "shard_id", "op", F.col("ts").cast("double").alias("ts"),
                    F.when(F.col("op") == "verified", F.concat(F.lit("redo/"), F.col("shard_id"), F.lit(".bin"))).alias("output_path"),
                    F.when(F.col("op") == "verified", T.sha256_hex(F.concat(F.lit("redo/"), F.col("shard_id")))).alias("checksum"),
                    F.when(F.col("op") == "verified", F.lit(7)).cast("long").alias("token_count"),
                    F.when(F.col("op") == "failed", F.lit("timeout")).alias("error"))


def pipeline_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The derived ledger re-labelled onto the five pipeline stages (stage = STAGES[n % 5])."""
    led = derived_ledger(spark, sf_dir)
    n = F.regexp_extract("stage", "([0-9]+)$", 1).cast("long")
    st = F.element_at(F.array(*[F.lit(s) for s in STAGES]), (F.pmod(n, F.lit(5)) + 1).cast("int"))
    return led.withColumn("stage", st)


FIXTURE_SEQ_LEN = 64
FIXTURE_BATCH = 8


def hash_token_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Deduplicated cleaned lines with hash token ids and the fixture split per shard."""
    return shared(spark, "tokenized", sf_dir, lambda: _hash_token_table(spark, sf_dir))


def _hash_token_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ..functions import tokens as TK
    from ..operators.dedup import dedup_shard
    dd = dedup_shard(kept_lines(spark, sf_dir))
    ids = TK.with_template(TK.hash_ids(F.col("cleaned")))
    tok = dd.select(T.split_of_shard(F.col("shard_id"), FIXTURE_TEST_FRAC, FIXTURE_VAL_FRAC).alias("split"),
                    "shard_id", "doc_id", "line_idx", ids.alias("tokens")).withColumn("n_tokens", F.size("tokens"))
    # Stage boundary: the tokenized shards are written once and read by every later step.
    return materialize(tok, "tokenized")


def corpus(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The cleaned, per-shard deduplicated corpus (the tokenizer's training lines)."""
    from ..operators.dedup import dedup_shard

    def make():
        dd = dedup_shard(kept_lines(spark, sf_dir))
        return materialize(dd.select("shard_id", "doc_id", "line_idx", F.col("cleaned").alias("text")), "corpus")
    return shared(spark, "corpus", sf_dir, make)


_MODELS: dict = {}


def trained_model(spark: SparkSession, sf_dir: str, vocab_size: int | None = None):
    """Train once per (application, data, size; in full by default); the model is driver-side and vocabulary-bounded."""
    from ..operators import bpe as B
    vocab_size = vocab_size or B.VOCAB_SIZE
    key = (spark.sparkContext.applicationId, sf_dir, vocab_size)
    if key not in _MODELS:
        freq = materialize(B.pretoken_freq(B.training_corpus(corpus(spark, sf_dir)), "text"))
        _MODELS[key] = B.train_bpe(spark, freq, vocab_size=vocab_size)
    return _MODELS[key]
