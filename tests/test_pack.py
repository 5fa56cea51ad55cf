"""Packing invariants on hash token ids (independent of BPE)."""
import pytest
from pyspark.sql import functions as F

from shardloom.operators import pack as P
from shardloom.plans import fixtures as X
from shardloom.session import materialize
from tests.conftest import SF_SMALL

L = 16


def _stream(tok):
    rows = tok.orderBy("split", "shard_id", "doc_id", "line_idx").collect()
    out = {}
    for r in rows:
        out.setdefault(r["split"], []).extend(r["tokens"])
    return out


def test_packing_invariants(spark):
    tok = X.hash_token_table(spark, SF_SMALL)
    off = P.token_offsets(tok)
    stream = _stream(tok)
    packed = P.pack_sequences(off, L).collect()
    by_split = {}
    for r in packed:
        by_split.setdefault(r["split"], {})[r["seq_id"]] = list(r["tokens"])
    for split, toks in stream.items():
        seqs = by_split.get(split, {})
        n = len(toks) // L
        assert sorted(seqs) == list(range(n))
        flat = [t for i in range(n) for t in seqs[i]]
        assert flat == toks[: n * L]            # a prefix of the token stream, tail dropped
    ex = P.next_token_pairs(off, tok, L).collect()
    per = {}
    for r in ex:
        x, y = list(r["x"]), list(r["y"])
        assert y[:-1] == x[1:]
        toks = stream[r["split"]]
        s = r["seq_id"]
        assert x == toks[s * L:(s + 1) * L] and y[-1] == toks[(s + 1) * L]
        per[r["split"]] = per.get(r["split"], 0) + 1
    for split, toks in stream.items():
        assert per.get(split, 0) == max(len(toks) // L - 1, 0)


def test_training_batches_full_and_shuffled(spark):
    tok = X.hash_token_table(spark, SF_SMALL)
    packed = P.sequence_numbers(tok, L)
    assert sorted(tuple(r) for r in packed.collect()) == sorted(
        (r["split"], r["seq_id"]) for r in P.pack_sequences(P.token_offsets(tok), L).collect())
    b = P.training_batches(packed, 4, seed=1).filter(F.col("split") == "train")
    sizes = [r["n"] for r in b.groupBy("batch_id").agg(F.count(F.lit(1)).alias("n")).collect()]
    assert sizes and all(s == 4 for s in sizes)
    order = [r["seq_id"] for r in b.orderBy("ordinal").collect()]
    assert order != sorted(order)               # shuffled
    b2 = P.training_batches(packed, 4, seed=2).filter(F.col("split") == "train")
    assert [r["seq_id"] for r in b2.orderBy("ordinal").collect()] != order


def test_the_order_is_a_permutation_without_a_shuffle(spark):
    for n in (1, 2, 3, 5, 65, 4097):
        rows = spark.range(n).select(F.lit("train").alias("split"), F.col("id").alias("seq_id"))
        got = [r["ordinal"] for r in P.training_batches(rows, 1, seed=3, epoch=n).orderBy("seq_id").collect()]
        assert sorted(got) == list(range(n))
        if n > 60:
            assert len({b - a for a, b in zip(got, got[1:])}) > n // 4      # no stride
    packed = materialize(rows, "packed")
    plan = P.training_batches(packed, 8)._jdf.queryExecution().executedPlan().toString()
    assert "rangepartitioning" not in plan and "Sort" not in plan.replace("SortMerge", "")
    assert plan.count("hashpartitioning") == 1                              # of the counts, one row per split
    gap = spark.createDataFrame([("train", 0), ("train", 2)], "split string, seq_id long")
    with pytest.raises(Exception, match="sequence ids"):
        P.training_batches(gap, 1).collect()


def test_the_query_sorts_its_batches_by_a_hash(spark):
    """The order of the query is the sorted one of its SQL, whatever the ids are (a keyed permutation would need 0 to n - 1)."""
    import hashlib
    from shardloom.plans.queries import REGISTRY
    got = [(r["seq_id"], r["ordinal"]) for r in REGISTRY["training_batches"](spark, SF_SMALL).filter("split = 'train'").collect()]
    ids = [r["seq_id"] for r in P.sequence_numbers(X.hash_token_table(spark, SF_SMALL), X.FIXTURE_SEQ_LEN).filter("split = 'train'").collect()]
    order = sorted(ids, key=lambda i: hashlib.md5(f"7:0:{i}".encode()).hexdigest())
    assert sorted(got, key=lambda x: x[1]) == [(i, k) for k, i in enumerate(order[:len(order) // 8 * 8])]
    gap = spark.createDataFrame([("train", 5), ("train", 2), ("test", 9), ("test", 4)], "split string, seq_id long")
    rows = P.training_batches(gap, 1, order_key=F.lpad(F.col("seq_id").cast("string"), 3, "0")).collect()
    assert sorted((r["split"], r["seq_id"], r["ordinal"]) for r in rows) == [("test", 4, 0), ("test", 9, 1), ("train", 2, 0), ("train", 5, 1)]


def test_uint16_guard(spark):
    df = spark.createDataFrame([(0, [1, 2]), (1, [70000])], "seq_id long, tokens array<int>")
    assert [r["seq_id"] for r in P.check_uint16(df).collect()] == [1]


def test_splits_to_pack(spark):
    splits = spark.createDataFrame([("train",), ("validation",), ("test",)], "split string")
    existing = spark.createDataFrame([("train", 2 * 600), ("validation", 20)], "split string, length long")
    assert sorted(r["split"] for r in P.splits_to_pack(splits, existing, 512).collect()) == ["test", "validation"]


def test_sequence_numbers_are_dealt_to_many_tasks(spark):
    """one task made (and hashed) all numbers of a split, from one array."""
    n = 40 * P.NUMBERS_AT_ONCE + 5
    tok = spark.createDataFrame([("train", n * L + 3), ("test", L - 1), (None, 2 * L)], "split string, n_tokens long")
    seqs = P.sequence_numbers(tok, L)
    got = seqs.groupBy("split").agg(F.count("*"), F.countDistinct("seq_id"), F.min("seq_id"), F.max("seq_id")).collect()
    assert sorted([tuple(r) for r in got], key=str) == sorted([("train", n, n, 0, n - 1), (None, 2, 2, 0, 1)], key=str)
    per_task = [r["count"] for r in seqs.groupBy(F.spark_partition_id()).count().collect()]
    assert len(per_task) > 1 and max(per_task) < n


def test_numbered_rows_are_not_shuffled_again(spark):
    """The offsets of the ranges are counted and go to the rows."""
    from shardloom.operators.ordinal import global_ordinal
    rows = spark.createDataFrame([("a", 3, "x"), ("a", 1, "y"), (None, 7, "z"), (None, 7, "z"), ("b", None, None)], "g string, o int, t string")
    out = global_ordinal(rows, ["g"], ["o"], "n")
    assert "SortMergeJoin" not in out._jdf.queryExecution().executedPlan().toString()
    assert sorted(((r["g"], r["o"], r["n"]) for r in out.collect()), key=str) == sorted([("a", 1, 0), ("a", 3, 1), (None, 7, 0), (None, 7, 1), ("b", None, 0)], key=str)


def test_hash_ids_equal_the_formula_and_run_in_arrow(spark):
    """every word was hashed and converted by itself in interpreted expressions."""
    import hashlib
    from shardloom.functions import tokens as TK
    texts = ["a b  a ", "", " ", None, "caf\u00e9 \U0001f600 a", "b"]
    rows = spark.createDataFrame(list(enumerate(texts)), "i int, t string").coalesce(1).select("i", TK.hash_ids(F.col("t")).alias("ids"))
    assert "ArrowEvalPython" in rows._jdf.queryExecution().executedPlan().toString()
    def plain(t):
        return None if t is None else [int(hashlib.md5(w.encode()).hexdigest()[:7], 16) % 32000 for w in t.split(" ") if w]
    assert {r["i"]: r["ids"] for r in rows.collect()} == {i: plain(t) for i, t in enumerate(texts)}
