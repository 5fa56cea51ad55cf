"""Incremental, resumable cleaning over arriving shard files.

``readStream`` over lists of the shard folder's files (``stream_arrivals``) with ``trigger(availableNow=True)`` takes every file not yet
recorded in the stream checkpoint, then stops: rerunning skips finished shards (the checkpoint
is the resume state), and a shard is one file, so it is always complete inside one micro-batch.
The stream carries the files' names only, and the driver holds those of one batch; ``foreachBatch`` reads the files of its batch, so that
a shard that cannot be read or cleaned is left out by its name:

* a line for which ``faults`` gives a message fails its shard, without an exception;
* where a batch ends in an exception, its halves are tried by themselves, and so on: a bad shard among n costs
  about 2 log2(n) more jobs, and the others are done.

Each batch writes the cleaned rows and one ledger row per shard (``done`` or ``failed`` with its
message) as the batch's partition of the table and of the ledger; both overwrite
their partition, so a replayed batch leaves the same rows. Every run starts with the shards whose last
state is ``failed`` and tries them again. A shard without any text has a ledger row too.
"""

from __future__ import annotations

import time

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import clean as C
from ..operators import dedup as D
from ..session import materialize
from ..sources import textshards as TS


def clean_batch(lines: DataFrame, policy: Column, faults: Column | None = None) -> tuple[DataFrame, DataFrame]:
    """Kept first lines of the shards of ``lines`` (from ``shard_lines``), and (shard_id, docs_in, docs_out, checksum, error)
    of every shard that has a line. ``faults`` is a message for a line that fails its shard (null: none)."""
    numbered = lines.withColumnRenamed("line_no", "line_idx")
    fault = F.lit(None).cast("string") if faults is None else faults
    cleaned = materialize(C.clean_lines(numbered.withColumn("fault", fault), policy), "cleaned")
    errors = materialize(cleaned.filter("fault is not null").groupBy("shard_id").agg(F.min("fault").alias("error")), "faults")
    good = cleaned.join(errors, "shard_id", "left_anti")
    kept = materialize(D.dedup_first(materialize(good.filter("kept"), "good"), ["shard_id"], F.col("line_idx")), "kept")
    sums = kept.groupBy("shard_id").agg(F.sha2(F.array_join(F.array_sort(F.collect_list("sha1")), ""), 256).alias("checksum"))
    done = C.clean_yield(good, with_total=False).join(sums, "shard_id", "left").withColumn("error", F.lit(""))
    bad = errors.select("shard_id", F.lit(0).cast("long").alias("docs_in"), F.lit(0).cast("long").alias("docs_out"), F.lit("").alias("checksum"), "error")
    return kept, done.unionByName(bad)


def _reason(error: Exception) -> str:
    """The last cause's message, on one line."""
    text = [x.strip() for x in str(error).splitlines() if x.strip()]
    causes = [x.removeprefix("Caused by: ") for x in text if x.startswith("Caused by: ")]
    return (causes[-1] if causes else text[0] if text else type(error).__name__)[:500]


def clean_files(spark: SparkSession, root: str, files: list[tuple[str, str]], policy: Column,
                faults: Column | None = None) -> tuple[list[tuple[DataFrame, DataFrame]], list[tuple[str, str]]]:
    """Results of ``clean_batch`` for (path, shard_id) files, and (shard_id, message) of the files that no job gets through."""
    try:
        return [clean_batch(TS.read_named_shards(spark, root, [p for p, _ in files]), policy, faults)], []
    except Exception as error:  # whatever a shard's content or file makes a task raise
        if len(files) == 1:
            return [], [(files[0][1], _reason(error))]
    half = len(files) // 2
    (a, x), (b, y) = (clean_files(spark, root, part, policy, faults) for part in (files[:half], files[half:]))
    return a + b, x + y


KEPT_SCHEMA = "source string, split string, shard_idx int, shard_id string, line_idx bigint, cleaned string, sha1 string"


def write_files(spark: SparkSession, root: str, files: list[tuple[str, str]], batch_id: int, policy: Column, out_path: str,
                ledger_path: str, faults: Column | None = None) -> None:
    """Cleans (path, shard_id) files and writes rows and ledger of a batch; a second call with the same batch changes nothing."""
    def put(df: DataFrame, path: str) -> None:
        (df.withColumn("batch_id", F.lit(batch_id).cast("long"))
         .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("batch_id").parquet(path))

    parts, broken = clean_files(spark, root, files, policy, faults)
    outcome = spark.createDataFrame(broken, "shard_id string, error string")
    outcome = outcome.select("shard_id", F.lit(0).cast("long").alias("docs_in"), F.lit(0).cast("long").alias("docs_out"), F.lit("").alias("checksum"), "error")
    rows = spark.createDataFrame([], KEPT_SCHEMA)
    for kept, result in parts:
        outcome, rows = outcome.unionByName(result.select(*outcome.columns)), rows.unionByName(kept.select(*rows.columns))
    put(rows, out_path)
    names = spark.createDataFrame(files, "input_path string, shard_id string")
    y = names.join(outcome, "shard_id", "left")
    error = F.coalesce("error", F.lit(""))
    put(y.select(F.lit("clean").alias("stage"), "shard_id", F.when(error == "", "done").otherwise("failed").alias("state"), F.lit(out_path).alias("output_path"),
                 F.coalesce("checksum", F.lit("")).alias("checksum"), F.coalesce("docs_out", F.lit(0)).cast("long").alias("token_count"),
                 F.coalesce("docs_in", F.lit(0)).cast("long").alias("docs_in"), F.coalesce("docs_out", F.lit(0)).cast("long").alias("docs_out"),
                 F.lit(time.time()).alias("updated_at"), error.alias("error"), "input_path"), ledger_path)


def read_ledger(spark: SparkSession, ledger_path: str) -> DataFrame:
    """The ledger's last row of every shard."""
    rows = spark.read.parquet(ledger_path)
    last = F.max_by(F.struct(*rows.columns), F.struct("updated_at", F.abs("batch_id"))).alias("last")
    return rows.groupBy("shard_id").agg(last).select("last.*")


def retry_failed(spark: SparkSession, root: str, out_path: str, ledger_path: str, policy: Column, faults: Column | None = None,
                 max_files: int = TS.FILES_PER_BATCH) -> int:
    """Cleans the shards whose last state is ``failed`` again, ``max_files`` at a time; how many there were.

    A pass is a batch with a negative id in the ledger, below all earlier ones.
    """
    try:
        failed = materialize(read_ledger(spark, ledger_path).filter("state = 'failed'").select("input_path", "shard_id"), "failed")
        low = spark.read.parquet(ledger_path).agg(F.min("batch_id")).first()[0]
    except AnalysisException:                   # no ledger yet
        return 0
    done, last, batch = 0, "", min(low if low is not None else 0, 0)
    while True:
        files = [tuple(r) for r in failed.filter(F.col("shard_id") > last).orderBy("shard_id").limit(max_files).collect()]
        if not files:
            return done
        batch -= 1
        write_files(spark, root, files, batch, policy, out_path, ledger_path, faults)
        done, last = done + len(files), files[-1][1]


def incremental_clean(spark: SparkSession, shards_path: str, out_path: str, ledger_path: str,
                      checkpoint: str, policy: Column, max_files_per_trigger: int = TS.FILES_PER_BATCH, faults: Column | None = None):
    """Try failed shards again, then run until every available shard is cleaned; returns the finished query."""
    retry_failed(spark, shards_path, out_path, ledger_path, policy, faults, max_files_per_trigger)

    def batch_of(batch: DataFrame, batch_id: int) -> None:
        files = [tuple(r) for r in batch.select("path", "shard_id").orderBy("shard_id").collect()]      # at most max_files_per_trigger
        if files:
            write_files(spark, shards_path, files, batch_id, policy, out_path, ledger_path, faults)

    files = TS.stream_arrivals(spark, shards_path, checkpoint, max_files_per_trigger)
    q = files.writeStream.foreachBatch(batch_of).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    q.awaitTermination()
    return q


def streaming_dedup(spark: SparkSession, shards_path: str, out_path: str, checkpoint: str, policy: Column,
                    max_files_per_trigger: int = TS.FILES_PER_BATCH):
    """R2: distinct kept texts per shard over a stream of shard files, without state that grows.

    A shard is one file and so never spans two batches; each batch writes the distinct (shard,
    sha1) of its shards as its own partition.
    """
    def sink(batch: DataFrame, batch_id: int) -> None:
        files = [r[0] for r in batch.select("path").collect()]      # at most max_files_per_trigger
        cleaned = C.clean_lines(TS.read_named_shards(spark, shards_path, files), policy).filter("kept").select("shard_id", "sha1")
        (cleaned.distinct().withColumn("batch_id", F.lit(batch_id).cast("long"))
         .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("batch_id").parquet(out_path))

    files = TS.stream_arrivals(spark, shards_path, checkpoint, max_files_per_trigger)
    q = files.writeStream.foreachBatch(sink).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    q.awaitTermination()
    return q
