"""Exact deduplication by repeated hashes: results, and which rows the plan moves."""
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from shardloom.operators import dedup as D
from shardloom.plans import fixtures as X
from shardloom.session import materialize
from tests.conftest import SF_SMALL


def executed(df):
    plan = df._jdf.queryExecution().executedPlan()
    return plan.initialPlan() if plan.nodeName() == "AdaptiveSparkPlan" else plan


def nodes(plan, name):
    found = [plan] if plan.nodeName() == name else []
    children = plan.children()
    for i in range(children.size()):
        found += nodes(children.apply(i), name)
    return found


def test_unique_rows_are_not_moved(spark):
    kept = X.kept_lines(spark, SF_SMALL)
    plan = executed(D.dedup_shard(kept))
    alone, rest = (nodes(plan, "Union")[0].children().apply(i) for i in (0, 1))
    assert "Exchange" not in alone.toString() and "Sort" not in alone.toString()
    assert nodes(rest, "SortMergeJoin") or nodes(rest, "BroadcastHashJoin")


def test_the_aggregation_reads_narrow_rows_by_hash(spark):
    keyed = X.kept_lines(spark, SF_SMALL).withColumn("_key", F.unhex("sha1")).withColumn("_pos", D.line_position(F.col("doc_ordinal"), F.col("line_idx")))
    plan = D.repeated_hashes(keyed.select("shard_id", "_key", "_pos"), ["shard_id"])._jdf.queryExecution().executedPlan().toString()
    assert "HashAggregate" in plan and "SortAggregate" not in plan and "ObjectHashAggregate" not in plan
    assert "cleaned" not in plan


@pytest.mark.parametrize("bits", [1 << 10, 1 << 26])
def test_first_rows_equal_brute_force(spark, monkeypatch, bits):
    """A filter that is far too small lets rows through to the join and changes nothing; one text holds a third of the rows."""
    monkeypatch.setattr(D, "FILTER_BITS", bits)
    rng = random.Random(3)
    rows = [(f"s{rng.randrange(4)}", i, f"{'0' * 39}{rng.randrange(6)}" if i % 3 == 0 else f"{rng.randrange(2500):040x}") for i in range(3000)]
    rng.shuffle(rows)
    df = materialize(spark.createDataFrame(rows, "scope string, pos long, sha1 string").repartition(5), "rows")
    for scope in (["scope"], []):
        first = {}
        for s, p, h in rows:
            key = (s if scope else "", h)
            first[key] = min(first.get(key, p), p)
        got = sorted(r["pos"] for r in D.dedup_first(df, scope, F.col("pos")).collect())
        assert got == sorted(first.values())
    assert D.dedup_first(df.limit(0), [], F.col("pos")).count() == 0


def test_the_filter_knows_what_went_in(spark):
    hashes = spark.range(2000).select(F.xxhash64("id").alias("h"))
    known = D.may_be_in(D.bloom_filter(hashes, 1 << 16), spark)
    assert hashes.filter(known(F.col("h"))).count() == 2000
    others = spark.range(10_000, 20_000).select(F.xxhash64("id").alias("h"))
    assert others.filter(known(F.col("h"))).count() < 300
    assert not D.bloom_filter(hashes.limit(0), 1 << 10).any() and isinstance(D.bloom_filter(hashes, 1 << 10), np.ndarray)
