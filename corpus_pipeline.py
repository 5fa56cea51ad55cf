"""Corpus pipeline: quality rules, language ID, near-duplicates, repeated passages, packing.

Every stage works on all its predecessor kept; its result is written as Parquet in the shared
folder and read again as the next stage's documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shardloom.llm import common as C
from shardloom.llm import harmonic_pack, language_id, near_dup, quality_rules, suffix_dedup
from shardloom.llm.queries import BYTE_VOCAB
from shardloom.llm.token_cache import tokenizer_file

def prepared(spark: SparkSession) -> None:
    """The shared folder and the package on the workers, for callers that use a stage by itself."""
    C.ensure_checkpoint_dir(spark)
    C.ship_package(spark)
    C.small_batches(spark)


COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the counting rules and the quality model."""
    prepared(spark)
    model = quality_rules.fit_quality(docs, C.read_table(spark, sf_dir, "labels"))
    return quality_rules.apply_quality(docs.select(*COLUMNS), model).filter("kept").select(*COLUMNS)


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a known language; ``lang`` becomes the language found."""
    prepared(spark)
    found = language_id.identify_documents(docs.select(*COLUMNS)).filter("kept")
    return found.withColumn("lang", F.col("language")).select(*COLUMNS)


def near_dup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class: the row that names it (smallest doc_id, then the smallest text hash)."""
    prepared(spark)
    return near_dup.one_of_each(docs.select(*COLUMNS))


def passage_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without byte strings that repeat; a document of which no word is left goes.

    Cuts may fall inside a character; its broken bytes go too.
    """
    prepared(spark)
    cut = suffix_dedup.cut_repeats(docs.select(*COLUMNS))
    left = cut.withColumn("text", suffix_dedup.whole_characters(F.col("kept_bytes"))).filter(F.col("text").rlike(r"[^\x20\x09-\x0D]"))
    return left.withColumn("n_chars", F.length("text").cast("long")).select(*COLUMNS)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of packed sequences with their ids' checksums."""
    prepared(spark)
    return harmonic_pack.piece_digests(harmonic_pack.pack_documents(docs, tokenizer_file(BYTE_VOCAB)))


STAGES = [("quality rules", quality_stage), ("language id", language_stage), ("near duplicates", near_dup_stage),
          ("repeated passages", passage_stage), ("packing", packing_stage)]

#: Learned models, sketches and the tokenizer library are beyond SQL; tests/llm holds the brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = C.read_table(spark, sf_dir, "documents")
    for _, stage in STAGES:
        docs = C.materialize(stage(spark, docs, sf_dir), "pipeline")
        C.collect_garbage(spark)  # a stage's plans and results; the driver's heap shrinks
    return docs
