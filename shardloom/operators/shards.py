"""Sharding, line explosion and shard-id helpers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as T
from .ordinal import global_ordinal

DOCS_PER_SHARD = 50_000


def assign_shards(docs: DataFrame, docs_per_shard: int = DOCS_PER_SHARD,
                  order_cols: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """Every ``docs_per_shard`` documents of a (source, split) start a new shard.

    Requires ``source`` and ``split`` columns. The rows themselves are numbered (one range
    shuffle, never a window over a whole source and no join back on a document key), so null
    and repeated document ids keep every row and get a place of their own.
    """
    with_ord = global_ordinal(docs, ["source", "split"], list(order_cols), "doc_ordinal")
    idx = F.floor(F.col("doc_ordinal") / F.lit(docs_per_shard)).cast("int")
    return (with_ord.withColumn("shard_idx", idx)
            .withColumn("shard_id", T.shard_id_expr(F.col("source"), F.col("split"), F.col("shard_idx"))))


def shards_of(docs: DataFrame, docs_per_shard: int = DOCS_PER_SHARD) -> DataFrame:
    """The shards that ``assign_shards`` makes, one row each (source, split, shard_idx, shard_id).

    How many there are follows from the count of a (source, split); only those two columns are read.
    """
    counts = docs.groupBy("source", "split").agg(F.count(F.lit(1)).alias("_n"))
    last = ((F.col("_n") + F.lit(docs_per_shard - 1) - F.pmod(F.col("_n") + F.lit(docs_per_shard - 1), F.lit(docs_per_shard))) / docs_per_shard - 1)
    rows = counts.select("source", "split", F.explode(F.sequence(F.lit(0), last.cast("int"))).alias("shard_idx"))
    return rows.withColumn("shard_id", T.shard_id_expr(F.col("source"), F.col("split"), F.col("shard_idx")))


def cap_shards(sharded: DataFrame, max_shards: Column) -> DataFrame:
    """Keep shards with ``shard_idx < max_shards`` (NULL cap = unlimited)."""
    return sharded.filter(max_shards.isNull() | (F.col("shard_idx") < max_shards))


def explode_lines(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """One row per non-blank line, ``line_idx`` = position of the line in its text.

    Lines are split on CRLF, CR and LF (Python universal newlines); blank lines are
    dropped after numbering so ``line_idx`` stays the true position.
    """
    rest = [c for c in docs.columns if c != text_col]
    return (docs.select(*rest, F.posexplode(T.split_lines(F.col(text_col)))
                        .alias("line_idx", "line"))
            .filter(T.not_blank(F.col("line")))
            .withColumn("line_idx", F.col("line_idx").cast("long")))


def parse_shard_id(df: DataFrame, col: str = "shard_id") -> DataFrame:
    """Source / split / index parsed from ``source__split__NNNNNN``."""
    parts = F.split(F.col(col), "__")
    return df.select("*",
                     T.source_of_shard(F.col(col)).alias("p_source"),
                     parts.getItem(1).alias("p_split"),
                     parts.getItem(2).cast("int").alias("p_index"))


def discover_shards(shards: DataFrame, source: str, split: str) -> DataFrame:
    """Shard ids of one (source, split), sorted (small table)."""
    prefix = f"{source}__{split}__"
    return (shards.select("shard_id").filter(F.col("shard_id").startswith(prefix))
            .distinct().orderBy("shard_id"))


def read_one_shard(sharded_lines: DataFrame, shard_id: str, known_sources: list[str] | None = None) -> DataFrame:
    """Rows of one shard; filters on the partition columns so a partitioned table prunes."""
    parts = shard_id.split("__")
    if len(parts) != 3:
        raise ValueError(f"malformed shard id: {shard_id}")
    source, split, idx = parts[0], parts[1], int(parts[2])
    if known_sources is not None and source not in known_sources:
        raise ValueError(f"Unknown source in shard_id: {source}")
    return sharded_lines.filter((F.col("source") == source) & (F.col("split") == split)
                                & (F.col("shard_idx") == idx))
