"""Cleaning stage as one narrow projection plus small aggregations."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as T


def clean_lines(lines: DataFrame, policy: Column, text_col: str = "line",
                rules: T.QualityRules = T.QualityRules()) -> DataFrame:
    """Apply the policy's rule chain and the quality gate to every row.

    Adds ``policy``, ``cleaned`` (rule chain output), ``reject_reason`` (NULL when kept),
    ``kept`` and ``sha1`` (of ``cleaned``, only for kept rows). Narrow: no shuffle.
    """
    # Staged columns: each rule runs once per row (they are referenced several times, so
    # the optimizer keeps them as separate projections instead of re-inlining them).
    pol = F.col("policy")
    wiki = pol == "wikitext"
    df = (lines.withColumn("policy", policy)
          .withColumn("_n", T.normalize_text(F.col(text_col)))
          .withColumn("_w", F.when(wiki, T.fix_wiki_artifacts(F.col("_n"))))
          .withColumn("_rule", F.when(wiki & T.is_heading(F.col("_w")), F.lit("heading"))
                      .when(wiki & T.is_symbols_only(F.col("_w")), F.lit("symbols_only"))
                      .when(~wiki & T.is_boilerplate(F.col("_n")), F.lit("boilerplate"))))
    emptied = F.col("_rule").isNotNull()
    cleaned = (F.when(emptied, F.lit(""))
               .when(wiki, F.col("_w"))
               .when(pol == "bookcorpus", T.remove_citations(F.col("_n")))
               .otherwise(F.col("_n")))
    df = df.withColumn("cleaned", cleaned)
    reason = F.coalesce(F.col("_rule"), T.quality_reason(F.col("cleaned"), rules))
    df = df.withColumn("reject_reason", reason).drop("_n", "_w", "_rule")
    kept = F.col("reject_reason").isNull()
    df = df.withColumn("kept", kept).withColumn("sha1", F.when(kept, T.sha1_hex(F.col("cleaned"))))
    # A filter on ``kept`` or ``cleaned`` would be pushed below the projections, and every rule chain in it
    # would run again for each mention. Generated rows keep it above: the rules run once.
    made = ["policy", "cleaned", "reject_reason", "kept", "sha1"]
    return df.select(*[F.col(f"`{c}`") for c in df.columns if c not in made], F.inline(F.array(F.struct(*made))))


def clean_yield(cleaned: DataFrame, with_total: bool = True) -> DataFrame:
    """A1: ``docs_in`` (non-blank rows) and ``docs_out`` (kept, deduplicated per shard).

    Two-level aggregation: (shard, sha1) first, with map-side combine, so a line copied
    millions of times collapses before the shuffle; then per shard.
    """
    per_hash = cleaned.groupBy("shard_id", "sha1").agg(F.count(F.lit(1)).alias("n"))
    agg = [F.sum("n").cast("long").alias("docs_in"), F.count("sha1").alias("docs_out")]
    if with_total:
        return per_hash.rollup("shard_id").agg(*agg)
    return per_hash.groupBy("shard_id").agg(*agg)


def reject_reasons(cleaned: DataFrame) -> DataFrame:
    """A2: histogram of reject reasons per policy ('kept' for passing rows)."""
    return (cleaned.groupBy("policy", F.coalesce("reject_reason", F.lit("kept")).alias("reason"))
            .agg(F.count(F.lit(1)).alias("n")))
