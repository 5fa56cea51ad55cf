"""Run-metric tables and their analytics.

Stage events: (run_id, stage, event, ts, event_id, metrics MAP<STRING,STRING>).
Train events: (run_id, step, ts, event_id, type, loss, val_loss).
Running values (K6-K8) use range-partitioned running aggregates, so one huge run spans many tasks.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize
from .ordinal import running_aggregates


def _micros(c):
    return F.unix_micros(F.col(c).cast("timestamp"))


def append_events(df: DataFrame, path: str) -> None:
    """Metric events are appended as files (parquet), never rewritten."""
    df.write.mode("append").parquet(path)


def serialise_metrics(df: DataFrame, map_col: str = "metrics") -> DataFrame:
    """Metrics map as one JSON string (values kept as their string form)."""
    return df.withColumn("metrics_json", F.to_json(F.col(map_col)))


def sample_steps(train: DataFrame, log_every: int = 100, eval_every: int = 500) -> DataFrame:
    """rows that would be logged (step % log_every = 0) or evaluated (step % eval_every = 0, step <> 0)."""
    log = F.pmod(F.col("step"), F.lit(log_every)) == 0
    ev = (F.pmod(F.col("step"), F.lit(eval_every)) == 0) & (F.col("step") != 0)
    return train.select("run_id", "step", log.alias("logged"), ev.alias("evaluated")).filter("logged OR evaluated")


def throughput(train: DataFrame, seq_len: int, batch_size: int) -> DataFrame:
    """K6: tokens/s = int(seq_len*batch / max(dt, 1e-9)) between consecutive training steps,
    and the cumulative tokens seen, per run in (ts, step) order. Evaluation rows process no
    training tokens; the first step of a run has no interval, so its rate is null. Running values
    come from ``running_aggregates``, so one very long run does not sit in one task."""
    tokens = seq_len * batch_size
    r = running_aggregates(train.filter(F.col("type") == "train").select("run_id", "step", "ts", _micros("ts").alias("_us")), ["run_id"], ["ts", "step"],
                           [("_prev", F.col("_us"), "last", True), ("_n", F.lit(1), "count", False)])
    dt = (F.col("_us") - F.col("_prev")) / 1e6
    tps = F.when(dt.isNotNull(), F.floor(F.lit(float(tokens)) / F.greatest(dt, F.lit(1e-9))).cast("long"))
    return r.select("run_id", "step", tps.alias("tokens_per_sec"), (F.col("_n") * tokens).cast("long").alias("tokens_seen"))


def best_checkpoints(train: DataFrame) -> DataFrame:
    """K7: an eval step is a new best when its val_loss is below every earlier one."""
    ev = train.filter(F.col("type") == "eval").select("run_id", "step", "val_loss")
    ev = running_aggregates(ev, ["run_id"], ["step"], [("_prev", F.col("val_loss"), "min", True)])
    prev = F.col("_prev")
    best = prev.isNull() | (F.col("val_loss") < prev)
    return ev.select("run_id", "step", "val_loss", best.alias("is_best"),
                     F.format_string("checkpoints/best/best_%d.pt", F.col("step")).alias("path"))


def latest_checkpoint(best: DataFrame) -> DataFrame:
    """L4: newest best checkpoint per run."""
    b = best.filter("is_best")
    return b.groupBy("run_id").agg(F.max_by("path", "step").alias("path"), F.max("step").alias("step"))


def stage_elapsed(stage_ev: DataFrame) -> DataFrame:
    """K8: for every 'end' event, time since the latest preceding 'start' of that run and stage."""
    r = running_aggregates(stage_ev.select("run_id", "stage", "event", "event_id", "ts"), ["run_id", "stage"],
                           ["ts", "event_id"],
                           [("_start", F.when(F.col("event") == "start", _micros("ts")), "last", False)])
    df = r.select("run_id", "stage", "event", "event_id", (_micros("ts") - F.col("_start")).alias("elapsed_us"))
    return (df.filter(F.col("event") == "end")
            .select("run_id", "stage", "event_id", "elapsed_us", (F.col("elapsed_us") / 1e6).alias("elapsed_s")))


def stage_outcomes(stage_ev: DataFrame) -> DataFrame:
    """Per run and stage: started, ended, progress count, errors, last error, span."""
    is_ = lambda e: F.col("event") == e
    return stage_ev.groupBy("run_id", "stage").agg(
        F.count_if(is_("start")).alias("starts"),
        F.count_if(is_("end")).alias("ends"),
        F.count_if(is_("progress")).alias("progress"),
        F.count_if(is_("error")).alias("errors"),
        F.max_by(F.when(is_("error"), F.col("metrics")["value"]), F.when(is_("error"), F.col("event_id"))).alias("last_error"),
        ((F.max(F.when(is_("end"), _micros("ts"))) - F.min(F.when(is_("start"), _micros("ts")))) / 1e6).alias("span_s"))


def unigram_nll(train_tokens: DataFrame, vocab_size: int) -> tuple[DataFrame, float]:
    """Add-one unigram model counted on a token table: (id, nll), and the nll of an unseen id."""
    cnt = train_tokens.select(F.explode("tokens").alias("id")).groupBy("id").agg(F.count(F.lit(1)).alias("c"))
    counts = materialize(cnt, "unigram")                     # at most the vocabulary; counted once
    n = float(counts.agg(F.sum("c")).first()[0] or 0)
    unseen = math.log(n + vocab_size)
    return counts.select("id", (-F.log((F.col("c") + 1) / F.lit(n + vocab_size))).alias("nll")), unseen


def perplexity(eval_tokens: DataFrame, model: tuple[DataFrame, float]) -> DataFrame:
    """Token-weighted exp(sum nll / tokens); tokens absent from the model get the unseen nll."""
    per_id = eval_tokens.select(F.explode("tokens").alias("id")).groupBy("id").agg(F.count(F.lit(1)).alias("c"))
    seen, u = model[0], F.lit(model[1])
    # The model has one row per token id: bounded by the vocabulary size.
    j = per_id.join(F.broadcast(seen), "id", "left")
    agg = j.agg(F.sum("c").alias("tokens"), F.sum(F.col("c") * F.coalesce(F.col("nll"), u)).alias("nll_sum"))
    return agg.select("tokens", "nll_sum", F.exp(F.col("nll_sum") / F.col("tokens")).alias("perplexity"))


def batch_mean_loss(examples: DataFrame, model: tuple[DataFrame, float], batch_size: int) -> DataFrame:
    """Mean over batches (seq_id div B, ragged last kept) of the batch's mean token loss."""
    per = (examples.select((F.floor(F.col("seq_id") / batch_size)).alias("batch"), F.explode("y").alias("id"))
           .groupBy("batch", "id").agg(F.count(F.lit(1)).alias("c")))
    seen, u = model[0], F.lit(model[1])
    j = per.join(F.broadcast(seen), "id", "left")           # at most the vocabulary
    b = j.groupBy("batch").agg((F.sum(F.col("c") * F.coalesce(F.col("nll"), u)) / F.sum("c")).alias("loss"))
    return b.agg(F.count(F.lit(1)).alias("batches"), F.avg("loss").alias("mean_loss"))


def topk_softmax(scores: DataFrame, key_col: str, scores_col: str, k: int, temperature: float = 1.0) -> DataFrame:
    """Of each row's score array keep scores >= the k-th largest (ties kept), softmax(score / T) over them.

    Works inside the array: no shuffle. Returns (key, pos, rank, prob); null scores take no part.
    """
    kept = F.filter(F.transform(scores_col, lambda x, i: F.struct(i.alias("pos"), x.cast("double").alias("s"))), lambda e: e["s"].isNotNull())
    best = F.slice(F.reverse(F.array_sort(F.transform("_e", lambda e: e["s"]))), 1, k)
    df = scores.select(key_col, kept.alias("_e")).withColumn("_top", best).filter(F.size("_top") > 0)
    df = df.withColumn("_e", F.filter("_e", lambda e: e["s"] >= F.element_at("_top", -1)))
    z = lambda s: F.exp((s - F.element_at("_top", 1)) / temperature)
    df = df.withColumn("_sum", F.aggregate("_e", F.lit(0.0), lambda a, e: a + z(e["s"])))
    rank = lambda e: F.size(F.filter("_e", lambda o: o["s"] > e["s"])) + 1
    out = df.select(key_col, F.explode(F.transform("_e", lambda e: F.struct(e["pos"].alias("pos"), rank(e).alias("rank"),
                                                                             (z(e["s"]) / F.col("_sum")).alias("prob")))).alias("r"))
    return out.select(key_col, "r.*")
