"""Registered queries of the operators: each runs over its whole table with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shardloom.llm import common as C
from shardloom.llm import (bpe_backtrack, harmonic_pack, html_extract, language_id, near_dup, periodic_runs, pu_toxicity, quality_rules,
                           rans, rff_quality, spelling, suffix_dedup, token_cache, topk)
from shardloom.llm.token_cache import tokenizer_file

WORD_VOCAB, BYTE_VOCAB = "word_bpe_49k.json", "byte_bpe_50k.json"


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return C.read_table(spark, sf_dir, "documents")


def op1_language_id(spark, sf_dir):
    """Pages (address, markup) and documents (source as host, lang as declared) in one run of evidence."""
    pages, docs = C.read_table(spark, sf_dir, "pages"), documents(spark, sf_dir)
    host, suffix = language_id.address_parts(F.col("url"))
    rows = (pages.select(F.lit("pages").alias("table"), F.lit(None).cast("long").alias("doc_id"), "page_id",
                         language_id.visible_text(F.col("html")).alias("text"), language_id.markup_language(F.col("html")).alias("mark"),
                         host.alias("host"), suffix.alias("suffix"))
            .unionByName(docs.select(F.lit("documents").alias("table"), "doc_id", F.lit(None).cast("long").alias("page_id"), "text",
                                     F.col("lang").alias("mark"), F.col("source").alias("host"), F.lit(None).cast("string").alias("suffix"))))
    evidence = language_id.evidence_of(rows, F.col("text"), F.col("mark"), F.col("host"), F.col("suffix"), ["table", "doc_id", "page_id"])
    return language_id.identify(evidence)


def op2_suffix_dedup(spark, sf_dir):
    cut = suffix_dedup.cut_repeats(documents(spark, sf_dir).select("doc_id", "text"))
    return cut.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept_bytes", 256).alias("kept_sha256"))


def op3_topk(spark, sf_dir):
    rows = topk.clean_vectors(C.read_table(spark, sf_dir, "embeddings"))
    return topk.top_k(rows, rows.filter("vec_id % 20 = 0"))


def op4_rans_tokens(spark, sf_dir):
    folder = C.scratch_path(spark, "rans")
    rans.write_tokens(documents(spark, sf_dir), tokenizer_file(WORD_VOCAB), folder)
    return rans.read_tokens(spark, folder).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


def op5_quality_rules(spark, sf_dir):
    docs, labels = documents(spark, sf_dir), C.read_table(spark, sf_dir, "labels")
    model = quality_rules.fit_quality(docs, labels)
    judged = quality_rules.apply_quality(docs.select("doc_id", "text"), model)
    return judged.select("doc_id", *quality_rules.FIELDS)


def op6_bpe_backtrack(spark, sf_dir):
    return bpe_backtrack.round_trip_digests(documents(spark, sf_dir), tokenizer_file(WORD_VOCAB))


def op7_harmonic_pack(spark, sf_dir):
    pieces = harmonic_pack.pack_documents(documents(spark, sf_dir), tokenizer_file(BYTE_VOCAB), cache_parts=2 * token_cache.CACHE_PARTS,
                                          token_slice=8 << 20)
    return harmonic_pack.piece_digests(pieces)


def op8_rff_quality(spark, sf_dir):
    return rff_quality.score(documents(spark, sf_dir).select("doc_id", "text"), C.read_table(spark, sf_dir, "labels"))


def op9_html_extract(spark, sf_dir):
    return html_extract.extract(C.read_table(spark, sf_dir, "pages").select("page_id", "url", "html"))


def op10_near_dup(spark, sf_dir):
    return near_dup.near_duplicates(documents(spark, sf_dir).select("doc_id", "text"))


def op11_spelling(spark, sf_dir):
    runs = spelling.letter_runs(documents(spark, sf_dir), least=spelling.LEAST_LENGTH)
    return spelling.spelling_forms(spelling.vocabulary(spelling.with_slips(runs)))


def op12_periodic_runs(spark, sf_dir):
    return periodic_runs.run_digests(documents(spark, sf_dir))


def op13_toxicity(spark, sf_dir):
    return pu_toxicity.toxicity(documents(spark, sf_dir).select("doc_id", "text"), C.read_table(spark, sf_dir, "labels"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_language_id": op1_language_id,
    "op2_suffix_dedup": op2_suffix_dedup,
    "op3_topk": op3_topk,
    "op4_rans_tokens": op4_rans_tokens,
    "op5_quality_rules": op5_quality_rules,
    "op6_bpe_backtrack": op6_bpe_backtrack,
    "op7_harmonic_pack": op7_harmonic_pack,
    "op8_rff_quality": op8_rff_quality,
    "op9_html_extract": op9_html_extract,
    "op10_near_dup": op10_near_dup,
    "op11_spelling": op11_spelling,
    "op12_periodic_runs": op12_periodic_runs,
    "op13_toxicity": op13_toxicity,
}
