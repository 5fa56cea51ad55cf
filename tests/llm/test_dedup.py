import hashlib
import random
import re

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from shardloom.llm import near_dup, suffix_dedup
from tests.llm import brute

SCHEMA = "doc_id bigint, text string, k1 string, row int"


def prose(rng, n, words=4000):
    return " ".join(f"w{rng.randrange(words)}" for _ in range(n))


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(5)
    passage, other = prose(rng, 70), prose(rng, 60)
    base = prose(rng, 300)
    words = base.split(" ")
    near = []
    for k in (3, 9, 20, 60):
        w = list(words)
        for i in rng.sample(range(len(w)), k):
            w[i] = f"x{i}"
        near.append(" ".join(w))
    out = [None, "", "  \n ", "one", "one", "one two three four", "a b c d e", "a b  c\nd e", base, base, *near,
           prose(rng, 40) + " " + passage + " " + prose(rng, 30), passage, prose(rng, 10) + "\n" + passage + other, other + passage,
           "ha " * 3000, "ha " * 2999, "ha ha " * 40, "é" * 150, "xé" + "é" * 150, prose(rng, 5000), "ab" * 99 + "c", "ab" * 99 + "d"]
    return out


def test_suffix_dedup_equals_brute_force(spark, texts):
    rows = [(i if i % 7 else None, t, f"c{i}", i) for i, t in enumerate(texts)]
    got = suffix_dedup.cut_repeats(spark.createDataFrame(rows, SCHEMA)).collect()
    assert len(got) == len(rows)
    assert set(got[0].asDict()) == {"doc_id", "k1", "row", "n_bytes", "n_removed", "n_spans", "kept_bytes"}
    for r in got:
        n, runs, left = expected(texts)[r["row"]]
        assert (r["n_bytes"], r["n_removed"], r["n_spans"]) == (n, sum(b - a for a, b in runs), len(runs)), r["row"]
        assert hashlib.sha256(r["kept_bytes"]).digest() == hashlib.sha256(left).digest()
        assert r["k1"] == f"c{r['row']}"


_HELD = {}


def expected(texts):
    if "runs" not in _HELD:
        _HELD["runs"] = brute.repeated_runs(texts)
    return _HELD["runs"]


def test_suffix_dedup_of_empty_table(spark):
    assert suffix_dedup.cut_repeats(spark.createDataFrame([], "doc_id bigint, text string")).count() == 0


def test_suffix_dedup_large_buckets_are_compared_in_blocks(spark, texts, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "GROUP", 2)
    rng = random.Random(1)
    passage = prose(rng, 60)
    many = [prose(rng, rng.randrange(20)) + " " + passage + " " + prose(rng, rng.randrange(20)) for _ in range(30)]
    got = suffix_dedup.cut_repeats(spark.createDataFrame([(i, t) for i, t in enumerate(many)], "doc_id bigint, text string")).collect()
    expected = brute.repeated_runs(many)
    assert {r["doc_id"]: (r["n_removed"], r["n_spans"]) for r in got} == {i: (sum(b - a for a, b in x[1]), len(x[1])) for i, x in enumerate(expected)}


def test_one_place_speaks_for_a_repeated_segment(spark):
    """Copies of a text and periods inside one do not make the groups of round 3 larger."""
    rng = random.Random(3)
    body = prose(rng, 300)
    many = [body] * 40 + [body[:700] + f" x{k} " + body[700:] for k in range(5)] + ["ha " * 3000, "ha " * 500 + "hm " + "ha " * 500]
    texts = spark.createDataFrame([(t,) for t in many], "text string").select(*suffix_dedup.text_key(), "text")
    contexts = suffix_dedup.mixed_contexts(texts, suffix_dedup.marked_segments(texts)).collect()
    assert contexts and len({(r["bucket"], bytes(r["context"])) for r in contexts}) == len(contexts)
    got = suffix_dedup.cut_repeats(spark.createDataFrame(list(enumerate(many)), "doc_id bigint, text string")).collect()
    expected = brute.repeated_runs(many)
    assert {r["doc_id"]: (r["n_removed"], r["n_spans"]) for r in got} == {i: (sum(b - a for a, b in x[1]), len(x[1])) for i, x in enumerate(expected)}


def test_groups_are_compared_whole_however_they_are_batched(monkeypatch):
    rng = random.Random(4)
    rows = []
    for bucket in range(12):
        passage = prose(rng, 60).encode()
        rows += [(k, k, 100 << 12, bucket, 0, 1, False, (passage if k else prose(rng, 60).encode())[:300]) for k in range(1 + bucket % 4)]
    names = ["k1", "k2", "place", "bucket", "block", "blocks", "whole", "context"]
    table = pa.Table.from_pylist([dict(zip(names, r)) for r in rows])
    read = lambda size: sorted(tuple(x.values()) for b in suffix_dedup._compare(iter(table.to_batches(size))) for x in b.to_pylist())
    whole = read(10**6)
    assert whole
    monkeypatch.setattr(suffix_dedup.C, "SLICE_BYTES", 1)
    for size in (1, 2, 3, 5, 100):
        assert read(size) == whole


def test_whole_characters(spark):
    cut = spark.createDataFrame([(bytearray("aé".encode()[:2]),), (bytearray("éa".encode()[1:]),), (bytearray("éa".encode()),)], "b binary")
    assert [r[0] for r in cut.select(suffix_dedup.whole_characters(F.col("b"))).collect()] == ["a", "a", "éa"]


def test_near_duplicate_classes_equal_brute_force(spark, texts):
    ids = [100 + i for i in range(len(texts))]
    got = near_dup.near_duplicates(spark.createDataFrame(list(zip(ids, texts)), "doc_id bigint, text string")).collect()
    first = brute.near_classes(texts)
    assert {r["doc_id"]: r["class_id"] for r in got} == {ids[i]: ids[f] for i, f in enumerate(first)}
    assert {r["doc_id"]: r["class_size"] for r in got} == {ids[i]: first.count(f) for i, f in enumerate(first)}


def test_near_duplicates_null_and_repeated_ids(spark):
    rows = [(None, "a b c d e f"), (None, "a b c d e f"), (7, "a b c d e f"), (7, "q r s t u v"), (None, None)]
    got = near_dup.near_duplicates(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()
    assert sorted((str(r[0]), str(r[1]), r[2]) for r in got) == [("7", "7", 1), ("7", "7", 3), ("None", "7", 3), ("None", "7", 3), ("None", "None", 1)]
    kept = near_dup.one_of_each(spark.createDataFrame([(*r, "x", "y") for r in rows], "doc_id bigint, text string, _row string, comp string")).collect()
    assert set(kept[0].asDict()) == {"doc_id", "text", "_row", "comp"}
    assert sorted((str(r[0]), str(r[1])) for r in kept) == [("7", "a b c d e f"), ("7", "q r s t u v"), ("None", "None")]


def test_near_duplicates_of_empty_table(spark):
    assert near_dup.near_duplicates(spark.createDataFrame([], "doc_id bigint, text string")).count() == 0


def test_chains_across_a_bucket_are_linked(spark):
    """Neighbours in a chain of edits are similar, its ends are not: all are one class."""
    rng = random.Random(9)
    words = prose(rng, 200).split(" ")
    chain = [" ".join(words)]
    for step in range(12):
        words = list(words)
        words[step * 15], words[step * 15 + 7] = f"y{step}", f"z{step}"
        chain.append(" ".join(words))
    got = near_dup.near_duplicates(spark.createDataFrame(list(enumerate(chain)), "doc_id bigint, text string")).collect()
    assert {r["class_id"] for r in got} == {0}
    assert len(set(brute.near_classes(chain))) == 1


def test_probminhash_estimates_probability_jaccard():
    import numpy as np
    rng = np.random.default_rng(2)
    a, b = {}, {}
    for h in rng.integers(1, 2**62, 300):
        a[int(h)] = float(rng.uniform(0.5, 4))
        if rng.random() < 0.8:
            b[int(h)] = a[int(h)] * float(rng.uniform(0.8, 1.2))
    pick = lambda x: (np.array(list(x), np.uint64), np.array(list(x.values())))
    (ha, wa), (hb, wb) = pick(a), pick(b)
    got = near_dup.probminhash(np.repeat([0, 1], [len(ha), len(hb)]), np.concatenate([ha, hb]), np.concatenate([wa, wb]), 2, registers=4096)
    exact = sum(1 / sum(max(a.get(j, 0) / a[i], b.get(j, 0) / b[i]) for j in a.keys() | b.keys()) for i in a.keys() & b.keys())
    assert abs((got[0] == got[1]).mean() - exact) < 0.03


def test_near_duplicates_where_one_text_repeats_what_the_other_lacks(spark):
    """Links are decided by the plain Jaccard, so candidates must not depend on how often a shingle is repeated."""
    rng = random.Random(11)
    out = []
    for k in range(24):
        words = [f"p{k}q{i}" for i in range(200)]
        more = [f"n{k}m{i}" for i in range(30 if k % 2 else 45)]
        out += [" ".join(words), " ".join(words + more * (1000 if k % 2 else 100))]
    out += [prose(rng, 200) for _ in range(4)]
    got = near_dup.near_duplicates(spark.createDataFrame(list(enumerate(out)), "doc_id bigint, text string")).collect()
    assert {r["doc_id"]: r["class_id"] for r in got} == dict(enumerate(brute.near_classes(out)))
    assert {r["class_size"] for r in got if r["doc_id"] < 48} == {2}


def test_registers_that_decide_on_a_pair_agree_with_the_plain_jaccard():
    words = [f"p{i}" for i in range(200)]
    both = [" ".join(words), " ".join(words + [f"n{i}" for i in range(30)] * 1000)]
    data = pa.RecordBatch.from_pydict({"doc_id": [0, 1], "same": [b"a", b"b"], "text": both})
    (got,) = near_dup._sketch([data])
    plain = [np.frombuffer(x, "<u4") for x in got.column("signature").to_pylist()]
    assert (plain[0] == plain[1]).sum() >= near_dup.AGREEING
    assert got.column("weighted").is_null().to_pylist() == [True, False]
    heavy = np.frombuffer(got.column("weighted").to_pylist()[1], "<u4")
    keys, rows = near_dup.bucket_rows(got.column("signature").to_pylist(), got.column("weighted").to_pylist())
    assert len(set(zip(keys.tolist(), rows.tolist()))) == len(keys) > 2 * near_dup.BANDS
    # Both sketches are banded, the weighted one as it is.
    assert set(near_dup.band_keys(heavy[None, :])[0].tolist()) <= set(keys[rows == 1].tolist())


def test_compressing_and_cutting_are_two_stages(spark):
    """Two Python steps in one stage are two workers a task; small tables are no exception."""
    rng = random.Random(8)
    passage = prose(rng, 80)
    rows = [(i, prose(rng, 40) + passage + prose(rng, 40)) for i in range(6)]
    cut = suffix_dedup.cut_repeats(spark.createDataFrame(rows, "doc_id bigint, text string"))
    plan = cut._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"SortMergeJoin \[k1#\d+L, k2#\d+L\], \[[^\]]*\], LeftOuter", plan)  # the texts and what was found in them
    assert all(r["n_spans"] == 1 and r["n_removed"] >= len(passage) for r in cut.collect())
