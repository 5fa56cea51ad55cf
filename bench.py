"""Benchmark: the pipeline's headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS].

Prints one JSON line: {"metric", "value" (total seconds), "unit", "queries": {name: sec}, "sf", ...}.
Every query is forced in full with the ``noop`` sink (no rows pulled to the driver).
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
BPE_SIZES = [int(n) for n in os.environ.get("BENCH_BPE_VOCAB", "1000,4000,32000").split(",")]      # the last one is the timed item

HEADLINE = [
    "shard_documents", "clean_yield", "dedup_global", "reject_reasons", "ingest_counts",
    "pretoken_freq", "token_offsets", "pack_sequences", "next_token_pairs", "training_batches",
    "verify_outputs", "cleanup_report", "throughput", "stage_elapsed", "topk_softmax",
]


def main() -> None:
    from pyspark.sql import functions as F

    from shardloom.operators import bpe as B
    from shardloom.operators import pack as P
    from shardloom.operators import tokenize as TZ
    from shardloom.plans import fixtures as X
    from shardloom.plans.queries import REGISTRY
    from shardloom.session import build_session, drop_written, materialize

    spark = build_session(master=f"local[{CPUS}]", shuffle_partitions=int(CPUS) * 2, app="shardloom-bench")
    times: dict[str, float] = {}

    def run(name, fn):
        t0 = time.time()
        df = fn()
        df.write.format("noop").mode("overwrite").save()
        drop_written(spark)
        times[name] = round(time.time() - t0, 3)

    for name in HEADLINE:
        run(name, lambda n=name: REGISTRY[n](spark, SF_DIR))

    # Tokenizer path at full size: train, encode, pack. Smaller vocabularies are timed beside the total.
    t0 = time.time()
    corpus = X.corpus(spark, SF_DIR)
    freq = materialize(B.pretoken_freq(corpus, "text"))
    counted = time.time() - t0
    bpe = {}
    for size in BPE_SIZES:
        t0 = time.time()
        model = B.train_bpe(spark, freq, vocab_size=size)
        bpe[str(size)] = {"sec": round(time.time() - t0, 3), "merges": len(model.merges), "rounds": model.rounds}
    times["bpe_train"] = round(counted + bpe[str(BPE_SIZES[-1])]["sec"], 3)
    key = ["shard_id", "doc_id", "line_idx"]
    t0 = time.time()
    tok = materialize(TZ.tokenize_lines(spark, corpus, model, key, "text"))
    times["tokenize_documents"] = round(time.time() - t0, 3)
    n_tokens = tok.agg(F.sum("n_tokens")).first()[0]

    def bpe_pack():
        from shardloom.functions import text as T
        t = tok.withColumn("split", T.split_of_shard(F.col("shard_id"), X.FIXTURE_TEST_FRAC, X.FIXTURE_VAL_FRAC))
        return P.pack_sequences(P.token_offsets(t), 512)

    run("pack_bpe_tokens", bpe_pack)

    n_docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").count()
    sf = re.search(r"sf([0-9.]+)", SF_DIR)
    total = round(sum(times.values()), 3)
    out = {
        "metric": "pipeline_total_sec", "value": total, "unit": "sec", "queries": times,
        "sf": float(sf.group(1)) if sf else SF_DIR,
        "docs": n_docs, "docs_per_sec_clean": round(n_docs / max(times["clean_yield"], 1e-9), 1),
        "bpe_vocab": BPE_SIZES[-1], "bpe_merges": len(model.merges), "bpe_rounds": model.rounds, "bpe_by_size": bpe,
        "merges_per_sec": round(len(model.merges) / max(times["bpe_train"], 1e-9), 2),
        "tokens": int(n_tokens or 0),
        "tokens_per_sec_tokenize": round((n_tokens or 0) / max(times["tokenize_documents"], 1e-9), 1),
        "cpus": int(CPUS),
    }
    print(json.dumps(out))
    spark.stop()


if __name__ == "__main__":
    main()
