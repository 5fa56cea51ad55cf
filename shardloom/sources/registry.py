"""Source registry and multi-source ingest.

A registry is a short driver-side list (one entry per dataset), so its size is known
where it is built; each entry becomes one ``spark.read`` and all are combined with
``unionByName``. Text is stripped and blank texts dropped (F1).
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as T


@dataclass(frozen=True)
class SourceSpec:
    name: str | None                  # literal source name; None = take it from ``source_col``
    path: str | dict[str, str]        # one dataset, or one per split
    splits: tuple[str, ...] = ("train",)
    text_col: str = "text"
    fmt: str = "parquet"
    weight: float = 1.0
    max_shards: int | None = None
    source_col: str | None = None
    split_col: str | None = None      # per-row split column
    id_expr: str | dict[str, str] = "doc_id"    # SQL expression giving a BIGINT document id (per split)
    policy: str | None = None
    options: dict = field(default_factory=dict)

    def __post_init__(self):
        if len(self.splits) > 1 and not self.split_col and not isinstance(self.path, dict):
            raise ValueError(f"{self.name}: several splits need a path each or a split column; one dataset would be all of them")


def read_source(spark: SparkSession, spec: SourceSpec, split: str | None = None) -> DataFrame:
    """S3: scan one dataset by format; a missing text column reads as ''."""
    reader = spark.read.format(spec.fmt)
    for k, v in spec.options.items():
        reader = reader.option(k, v)
    return reader.load(spec.path[split] if isinstance(spec.path, dict) else spec.path)


def scan_text_table(df: DataFrame, text_col: str, keep: list[str]) -> DataFrame:
    """Project the text column (pruned at the scan), drop null/blank, strip."""
    if text_col in df.columns:
        txt = F.col(text_col)
    else:
        txt = F.lit("")
    return (df.select(*keep, txt.alias("text"))
            .filter(T.not_blank(F.col("text")))
            .withColumn("text", T.strip_ws(F.col("text"))))


def ingest(spark: SparkSession, registry: list[SourceSpec]) -> DataFrame:
    """S1 + U1: union of every (source, split) as (source, split, doc_id, text)."""
    parts: list[DataFrame] = []
    for spec in registry:
        for sp in spec.splits if isinstance(spec.path, dict) else (None,):
            raw = read_source(spark, spec, sp)
            src: Column = F.col(spec.source_col) if spec.source_col else F.lit(spec.name)
            split: Column = F.col(spec.split_col) if spec.split_col else F.lit(sp or spec.splits[0])
            key = spec.id_expr[sp] if isinstance(spec.id_expr, dict) else spec.id_expr
            base = raw.select(src.alias("source"), split.alias("split"), F.expr(key).cast("long").alias("doc_id"),
                              (F.col(spec.text_col) if spec.text_col in raw.columns else F.lit("")).alias("text"))
            base = base.filter(T.not_blank(F.col("text"))).withColumn("text", T.strip_ws(F.col("text")))
            parts.append(base.filter(F.col("split").isin(list(spec.splits))) if spec.split_col else base)
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def registry_caps(registry: list[SourceSpec]) -> dict[str, int]:
    """Shard cap of every source that has one."""
    return {s.name: s.max_shards for s in registry if s.name and s.max_shards is not None}


def registry_policies(registry: list[SourceSpec]) -> dict[str, str]:
    """Cleaning policy of every source that names one."""
    return {s.name: s.policy for s in registry if s.name and s.policy}


def ingest_counts(docs: DataFrame, docs_per_shard: int) -> DataFrame:
    """Documents and shards per (source, split), with subtotals and a grand total.

    A (source, split) of n documents fills ceil(n / docs_per_shard) shards, so nothing is numbered or written.
    """
    n = F.count(F.lit(1))
    per = docs.groupBy("source", "split").agg(n.alias("docs"))
    shards = (F.col("docs") + F.pmod(-F.col("docs"), F.lit(docs_per_shard))) / F.lit(docs_per_shard)
    return (per.withColumn("shards", shards.cast("long")).rollup("source", "split")
            .agg(F.sum("docs").cast("long").alias("docs"), F.sum("shards").cast("long").alias("shards")))


def fixture_registry(sf_dir: str) -> list[SourceSpec]:
    """documents (source per row, train); aux with a dataset per split: conversations (train), benchmark (test).

    A turn is a document of its own: its id is (conversation << 20) + turn.
    """
    d = sf_dir.rstrip("/")
    return [
        SourceSpec(name=None, source_col="source", path=f"{d}/documents.parquet", splits=("train",),
                   id_expr="doc_id"),
        SourceSpec(name="aux", path={"train": f"{d}/conversations.parquet", "test": f"{d}/benchmark.parquet"},
                   splits=("train", "test"), id_expr={"train": "shiftleft(conv_id, 20) + turn", "test": "item_id"}),
    ]
