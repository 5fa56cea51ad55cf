"""Ledger files (S11, S12, R7): JSON in, JSON out.

Two layouts are read: the original single-document ledger
``{"meta": {...}, "shards": [{...}, ...]}`` (multi-line JSON, one per stage) and the
row layout written here (one JSON object per shard). Writing uses the row layout, so a
ledger never has to be gathered into one document or one task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import materialize

ENTRY_DDL = ("shard_id string, state string, output_path string, checksum string, "
             "token_count bigint, updated_at double, error string")
DOC_DDL = ("meta map<string,string>, shards array<struct<shard_id:string, state:string, output_path:string, "
           "checksum:string, token_count:bigint, updated_at:double, error:string>>")
ROW_DDL = "stage string, " + ENTRY_DDL
ROW_COLS = ["stage", "shard_id", "state", "output_path", "checksum", "token_count", "updated_at", "error"]


def write_ledger(ledger: DataFrame, path: str) -> None:
    """Overwrite the ledger table as JSON rows, one folder per stage."""
    ledger.select(*ROW_COLS).write.mode("overwrite").partitionBy("stage").json(path)


def read_ledger(spark: SparkSession, path: str) -> DataFrame:
    """Read the row layout written by ``write_ledger``."""
    return spark.read.schema(ENTRY_DDL + ", stage string").json(path).select(*ROW_COLS)


def read_ledger_documents(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """S11 + R7: read original ledger documents; corrupt files go to a quarantine frame.

    Returns (entries with ``stage`` from ``meta.stage`` or the file name, quarantine).
    """
    raw = (spark.read.schema(DOC_DDL + ", _corrupt_record string")
           .option("multiLine", "true").option("mode", "PERMISSIVE")
           .option("columnNameOfCorruptRecord", "_corrupt_record")
           .json(path)
           .withColumn("file", F.col("_metadata.file_path")))
    raw = materialize(raw, "ledgers")
    bad = raw.filter(F.col("_corrupt_record").isNotNull() | F.col("shards").isNull()).select("file", "_corrupt_record")
    good = raw.filter(F.col("_corrupt_record").isNull() & F.col("shards").isNotNull())
    stage = F.coalesce(F.col("meta")["stage"], F.regexp_extract("file", "([^/]+)\\.json$", 1))
    entries = good.select(stage.alias("stage"), F.explode("shards").alias("e")).select("stage", "e.*")
    return entries, bad


def append_jsonl(df: DataFrame, path: str) -> None:
    """Append-only audit records (each batch adds files, never rewrites)."""
    df.write.mode("append").json(path)
