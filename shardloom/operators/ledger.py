"""Shard ledger as a table.

Schema: (stage, shard_id, state, output_path, checksum, token_count, updated_at, error).
Transitions are set-based: a batch of updates is collapsed per shard and merged with a
full outer join, instead of rewriting a JSON document per transition.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

STATES = ["pending", "processing", "verified", "done", "failed"]
LEDGER_COLS = ["stage", "shard_id", "state", "output_path", "checksum", "token_count", "updated_at", "error"]
STALE_AFTER_S = 3600.0


def pending(ledger: DataFrame) -> DataFrame:
    """not done (failed included, so it is retried)."""
    return ledger.filter(F.col("state") != "done")


def done(ledger: DataFrame) -> DataFrame:
    return ledger.filter(F.col("state") == "done")


def verified(ledger: DataFrame) -> DataFrame:
    return ledger.filter(F.col("state").isin("verified", "done"))


def reset_stale(ledger: DataFrame, now: float, max_age_s: float = STALE_AFTER_S) -> DataFrame:
    """'processing' entries older than ``max_age_s`` go back to 'pending' at ``now``."""
    stale = (F.col("state") == "processing") & (F.lit(now) - F.col("updated_at") > F.lit(max_age_s))
    cols = [F.when(stale, F.lit("pending")).otherwise(F.col("state")).alias("state") if c == "state"
            else F.when(stale, F.lit(now)).otherwise(F.col("updated_at")).alias("updated_at") if c == "updated_at"
            else F.col(c) for c in ledger.columns]
    return ledger.select(*cols)


def resume_pending(upstream: DataFrame, ledger: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """Upstream shards that this stage's ledger does not mark done."""
    keys = keys or ["stage", "shard_id"]
    return upstream.join(done(ledger).select(*keys), keys, "left_anti")


def register(ledger: DataFrame, shard_ids: DataFrame, now: float) -> DataFrame:
    """Insert (stage, shard_id) pairs not yet present as 'pending'; keep existing rows."""
    new = (shard_ids.select("stage", "shard_id").distinct()
           .join(ledger.select("stage", "shard_id"), ["stage", "shard_id"], "left_anti")
           .select("stage", "shard_id", F.lit("pending").alias("state"), F.lit("").alias("output_path"),
                   F.lit("").alias("checksum"), F.lit(0).cast("long").alias("token_count"),
                   F.lit(now).cast("double").alias("updated_at"), F.lit("").alias("error")))
    return ledger.select(*LEDGER_COLS).unionByName(new)


def merge_meta(old: DataFrame, new: DataFrame) -> DataFrame:
    """J2 meta merge: (stage, meta map) of both, the new value wins where both have a key."""
    old_kept = F.map_filter(F.coalesce("_old", F.create_map().cast("map<string,string>")), lambda k, _: ~F.array_contains(F.map_keys("_new"), k))
    j = (old.select("stage", F.col("meta").alias("_old"))
         .join(new.select("stage", F.col("meta").alias("_new")), "stage", "full_outer")
         .withColumn("_new", F.coalesce("_new", F.create_map().cast("map<string,string>"))))
    return j.select("stage", F.map_concat(old_kept, F.col("_new")).alias("meta"))


def apply_updates(ledger: DataFrame, updates: DataFrame) -> DataFrame:
    """Apply mark_processing / mark_verified / mark_done / mark_failed events.

    ``updates``: (stage, shard_id, op, ts, output_path, checksum, token_count, error).
    Per shard the batch collapses to: last op's state, latest 'verified' payload, latest
    'failed' error, max ts. 'failed' keeps the old path/checksum, 'done' keeps the old
    error (the transitions never clear it). Of updates with one time stamp the later state of
    ``STATES`` wins. An update for a shard that the ledger does not have is an error.
    """
    ver, fail = F.col("op") == "verified", F.col("op") == "failed"
    order = F.struct("ts", F.array_position(F.array(*[F.lit(s) for s in STATES]), F.col("op")))
    per = updates.groupBy("stage", "shard_id").agg(
        F.max_by("op", order).alias("n_state"),
        F.max("ts").alias("n_ts"),
        *[F.max_by(F.when(ver, F.col(c)), F.when(ver, F.struct("ts", F.col(c)))).alias(f"n_{c}") for c in ("output_path", "checksum", "token_count")],
        F.max_by(F.when(fail, F.col("error")), F.when(fail, F.struct("ts", "error"))).alias("n_error"))
    j = ledger.withColumn("_known", F.lit(True)).join(per, ["stage", "shard_id"], "full_outer")
    state = F.when(F.col("_known"), F.coalesce("n_state", "state")).otherwise(
        F.raise_error(F.concat(F.lit("update for an unknown shard: "), F.col("stage"), F.lit("/"), F.col("shard_id"))))
    return j.select(
        "stage", "shard_id", state.alias("state"),
        F.coalesce("n_output_path", "output_path", F.lit("")).alias("output_path"),
        F.coalesce("n_checksum", "checksum", F.lit("")).alias("checksum"),
        F.coalesce("n_token_count", "token_count", F.lit(0)).cast("long").alias("token_count"),
        F.coalesce("n_ts", "updated_at").cast("double").alias("updated_at"),
        F.coalesce("n_error", "error", F.lit("")).alias("error"))


def summary(ledger: DataFrame) -> DataFrame:
    """A3: per stage, count of every state (0 when absent) and the total."""
    aggs = [F.count_if(F.col("state") == s).alias(s) for s in STATES]
    return ledger.groupBy("stage").agg(*aggs, F.count(F.lit(1)).alias("total"))


def complete(ledger: DataFrame) -> DataFrame:
    """A4: a stage is complete when it has entries and all are done."""
    return ledger.groupBy("stage").agg(
        ((F.count(F.lit(1)) > 0) & F.every(F.col("state") == "done")).alias("complete"))


def total_tokens(ledger: DataFrame) -> DataFrame:
    """A5: sum of token_count over done entries (0 when none)."""
    return ledger.groupBy("stage").agg(
        F.coalesce(F.sum(F.when(F.col("state") == "done", F.col("token_count"))), F.lit(0))
        .cast("long").alias("total_tokens"))


def require_complete(ledger: DataFrame, stage: str) -> None:
    """Raise unless the upstream stage is complete; the error names what is open."""
    row = summary(ledger.filter(F.col("stage") == stage)).first()
    if row is None or row["done"] != row["total"]:
        counts = ", ".join(f"{row[s]} {s}" for s in STATES) if row else "no shards"
        raise RuntimeError(f"stage {stage} is not complete ({counts})")


def stage_plan(spark, stage_order: list[str], ledger: DataFrame, start_from: str) -> DataFrame:
    """Stage board (ord, stage, complete) and which stages a run from ``start_from`` executes.

    The stage order is a short driver-side list, so the start position is a literal.
    """
    start = stage_order.index(start_from)
    stages = spark.createDataFrame(list(enumerate(stage_order)), "ord int, stage string")
    comp = complete(ledger)
    board = stages.join(comp, "stage", "left").withColumn("complete", F.coalesce("complete", F.lit(False)))
    return board.withColumn("will_run", (F.col("ord") >= F.lit(start)) & ~F.col("complete"))


def gate_report(ledger: DataFrame, upstream_of: dict[str, str]) -> DataFrame:
    """R4 as a table: for every stage, whether its upstream is complete, and how many of its shards are done."""
    summ = summary(ledger).select(F.col("stage").alias("upstream"), F.col("done").alias("up_done"), F.col("total").alias("up_total"))
    pairs = ledger.sparkSession.createDataFrame(sorted(upstream_of.items()), "stage string, upstream string")
    j = pairs.join(summ, "upstream", "left").withColumns({c: F.coalesce(c, F.lit(0)) for c in ("up_done", "up_total")})
    return j.select("stage", "upstream", ((F.col("up_total") > 0) & (F.col("up_done") == F.col("up_total"))).alias("may_run"), "up_done", "up_total")
