import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from shardloom.llm import quality_rules as Q
from shardloom.llm import rff_quality as R
from tests.llm import brute


def sample(rng, good):
    w = ["".join(rng.choice("abcdehinorst") for _ in range(rng.randint(2, 8))) for _ in range(rng.randint(12, 80))]
    return " ".join(w) + "." if good else " ".join(x.upper() + rng.choice(["!!", "$$$", " |"]) for x in w)


@pytest.fixture(scope="module")
def tables(spark):
    rng = random.Random(4)
    docs = [(i, sample(rng, i % 4 != 0), "x") for i in range(400)]
    docs += [(1000, None, "x"), (1001, "", "x"), (1002, "same line here\nsame line here\n\n \nsame line here", "x"), (None, docs[1][1], "x"), (1, docs[1][1], "x")]
    labels = [(i, int(i % 4 != 0), 0) for i in range(0, 400, 2)] + [(i, int(i % 4 != 0), 0) for i in range(1, 300, 5)] + [(None, 1, 0), (5, None, 0)]
    return (spark.createDataFrame(docs, "doc_id bigint, text string, _q string").withColumn("kept", F.col("_q")), spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int"))


def test_counts_equal_brute_force(spark):
    rng = random.Random(8)
    bits = ["a", "bb", "é", "日本", "#", "<x>", " ", "  ", "\n", "\n\n", "\t", "\r\n", "\xa0", "a b c d e", "\x0b"]
    texts = [None, "", "\n", "x", *("".join(rng.choice(bits) + rng.choice(["", " "]) for _ in range(rng.randint(0, 60))) for _ in range(300))]
    got = Q.apply_quality(spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id bigint, text string").coalesce(1), Q.QualityModel(None)).collect()
    for r in got:
        expected = brute.quality_counts(texts[r["doc_id"]])
        assert {k: r[k] for k in expected} == expected, repr(texts[r["doc_id"]])
        assert r["kept"] == (not expected["base_failed"])


def test_quality_rules_learn_and_replace_clashing_columns(spark, tables):
    docs, labels = tables
    got = Q.apply_quality(docs, Q.fit_quality(docs, labels))
    assert sorted(got.columns) == sorted(["doc_id", "text", "_q", *Q.FIELDS])
    rows = got.collect()
    assert len(rows) == 405
    plain = [r for r in rows if r["doc_id"] is not None and r["doc_id"] < 400 and not r["base_failed"]]
    assert sum(r["kept"] == (r["doc_id"] % 4 != 0) for r in plain) / len(plain) > 0.98
    assert not any(r["kept"] for r in rows if r["text"] in (None, ""))
    twice = [r["quality_p"] for r in rows if r["text"] == rows[1]["text"]]
    assert len(twice) == 3 and len(set(twice)) == 1


def test_quality_rules_without_labels_or_rows(spark, tables):
    docs, labels = tables
    model = Q.fit_quality(docs, labels.filter("quality = 1"))
    assert model.weights is None
    assert Q.apply_quality(docs.limit(0), model).count() == 0


def test_held_out_accuracy_and_folds(spark, tables):
    docs, labels = tables
    got = {r["doc_id"]: r for r in R.score(docs, labels).collect() if r["doc_id"] is not None}
    import zlib
    for i, r in got.items():
        assert r["held_out"] == (zlib.crc32(str(i).encode()) % 5 == 0)
        assert 0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.3)
    out = [r for i, r in got.items() if r["held_out"] and i < 400]
    assert sum(r["predicted"] == int(r["doc_id"] % 4 != 0) for r in out) / len(out) > 0.95


def test_held_out_labels_are_not_used(spark, tables):
    docs, labels = tables
    flipped = labels.selectExpr("doc_id", "case when pmod(crc32(cast(cast(doc_id as string) as binary)), 5) = 0 then 1 - quality else quality end as quality", "toxic")
    a, b = ({(r["doc_id"], r["score"]) for r in R.score(docs, x).collect()} for x in (labels, flipped))
    assert a == b


def test_scores_without_labels(spark, tables):
    docs, labels = tables
    assert {r["score"] for r in R.score(docs, labels.limit(0)).collect()} == {0.5}
    assert R.score(docs.limit(0), labels).count() == 0


def test_isotonic_is_monotone_and_least_squares():
    got = R.isotonic(np.arange(5), np.array([0.0, 1, 0, 1, 0.5]), np.ones(5))
    assert np.allclose(got, [0, 0.5, 0.5, 0.75, 0.75])


def test_random_features_approximate_the_kernel():
    draw = np.random.default_rng(0)
    k = R.Kernel(np.zeros(3), np.ones(3), draw.normal(size=(3, 20000)) / R.WIDTH, draw.uniform(0, 2 * np.pi, 20000))
    x = draw.normal(size=(6, 3))
    z = k.features(x)[:, :-1]
    exact = np.exp(-((x[:, None] - x[None]) ** 2).sum(-1) / (2 * R.WIDTH**2))
    assert np.abs(z @ z.T - exact).max() < 0.03


def test_a_repeated_key_is_one_row_of_the_fit(spark):
    docs = [(1, f"text {i}") for i in range(50)] + [(2, None), (2, None), (3, "c"), (None, "d")]
    labels = spark.createDataFrame([(1, 1), (2, 0), (3, 1), (4, 0)], "doc_id bigint, quality int")
    got = Q.labelled_sample(spark.createDataFrame(docs, "doc_id bigint, text string"), labels, "quality", 100).collect()
    assert sorted((r["_key"], r["_y"]) for r in got) == [(1, 1), (2, 0), (3, 1)]
    again = Q.labelled_sample(spark.createDataFrame(docs[::-1], "doc_id bigint, text string"), labels, "quality", 100).collect()
    assert sorted(map(str, again)) == sorted(map(str, got))
