import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from shardloom.llm import pu_toxicity as T

BAD = ["grobble", "snarkus", "vílwort"]


def text(rng, toxic):
    w = ["".join(rng.choice("abcdehinorst") for _ in range(rng.randint(2, 8))) for _ in range(rng.randint(20, 80))]
    for _ in range(rng.randint(1, 4) if toxic else 0):
        w.insert(rng.randrange(len(w)), rng.choice([str.upper, str.title, str])(rng.choice(BAD)) + rng.choice(["", "!", "s", "ly,"]))
    return " ".join(w)


def fold(key):
    return zlib.crc32(str(key).encode()) % 3


@pytest.fixture(scope="module")
def tables(spark):
    rng = random.Random(4)
    docs = [(i, text(rng, i % 8 == 0)) for i in range(1600)]
    docs += [(2000, None), (2001, ""), (None, docs[8][1]), (8, docs[8][1]), (2002, "word " * 300_000 + "grobble snarkus")]
    docs += [(3000 + i, docs[1][1]) for i in range(400)]  # copies
    labels = [(i, int(i % 8 == 0)) for i in range(0, 1600, 2)] + [(i, 0) for i in range(1, 300, 5)] + [(None, 1), (5, None), (3000, 0)]
    return spark.createDataFrame(docs, "doc_id bigint, text string").withColumn("score", F.lit("clash")), spark.createDataFrame(labels, "doc_id bigint, toxic int")


@pytest.fixture(scope="module")
def scored(tables):
    return T.toxicity(*tables).collect()


def test_held_out_recall_and_clean_texts(tables, scored):
    assert len(scored) == tables[0].count()
    for r in scored:
        assert r["held_out"] == (r["doc_id"] is not None and fold(r["doc_id"]) == 1)
        assert 0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.7)
    out = [r for r in scored if r["held_out"] and r["doc_id"] < 1600]
    assert sum(r["predicted"] for r in out if r["doc_id"] % 8 == 0) > 0.95 * sum(r["doc_id"] % 8 == 0 for r in out)
    assert sum(r["predicted"] for r in out if r["doc_id"] % 8) < 0.01 * len(out)
    by = {r["doc_id"]: r for r in scored}
    assert by[2000]["score"] == by[2001]["score"] < 0.7 and by[2002]["predicted"] == 1  # the end of a long text counts
    assert len({r["score"] for r in scored if r["doc_id"] == 8 or r["doc_id"] is None}) == 1


def test_neither_held_out_labels_nor_zeros_matter(spark, tables, scored):
    docs, labels = tables
    key = "pmod(crc32(cast(cast(doc_id as string) as binary)), 3) = 1"
    flipped = labels.selectExpr("doc_id", f"case when {key} then 1 - toxic else toxic end as toxic")
    assert {(r["doc_id"], r["score"]) for r in T.toxicity(docs, flipped).collect()} == {(r["doc_id"], r["score"]) for r in scored}
    only = T.toxicity(docs, labels.filter("toxic = 1")).filter("held_out and doc_id < 1600").collect()  # the prior is the parameter
    assert sum(r["predicted"] == (r["doc_id"] % 8 == 0) for r in only) > 0.97 * len(only)


def test_without_labels_features_or_rows(spark, tables):
    docs, labels = tables
    assert {r["score"] for r in T.toxicity(docs.limit(50), labels.limit(0)).collect()} == {0.0}
    same = spark.createDataFrame([(i, "the same text in every row") for i in range(40)], "doc_id bigint, text string")
    marks = spark.createDataFrame([(i, i % 2) for i in range(40)], "doc_id bigint, toxic int")
    share = [i % 2 for i in range(40) if fold(i) != 1]
    assert {r["score"] for r in T.toxicity(same, marks).collect()} == {sum(share) / len(share)}
    assert T.toxicity(docs.limit(0), labels).count() == 0


def test_gradient_is_that_of_the_corrected_risk():
    draw = np.random.default_rng(1)
    prior = T.Prior(0.3, 0.1)
    soft = lambda z: (1 / (1 + np.exp(-z))).mean()
    for shift in (0.0, -9.0):  # where the difference is positive, and where it is not
        p, u = draw.normal(size=7) + shift + 9 * (shift < 0) * 2, draw.normal(size=11) + shift
        *steps, rest = T.corrected_steps(p, u, prior)
        assert np.isclose(rest, soft(u) - prior.hidden * soft(p))
        assert (rest < 0) == (shift < 0)

        def risk(p, u):
            inner = soft(u) - prior.hidden * soft(p)
            return prior.toxic * soft(-p) + (1 - prior.confirmed) * inner if rest >= 0 else -inner

        for step, which in zip(steps, (0, 1)):
            for i in range(len(step)):
                moved = [p.copy(), u.copy()]
                moved[which][i] += 1e-6
                assert np.isclose((risk(*moved) - risk(p, u)) / 1e-6, step[i], atol=1e-4)
    assert np.isclose(prior.hidden, 0.2 / 0.9)


def stems(word):
    return {("word", word)} | {(k, word[:k]) for k in T.STEMS if len(word) > k}


def test_document_frequency_equals_brute_force(spark):
    rng = random.Random(3)
    bits = ["a", "B", "é", "É", "日本", " ", "-", "\n", "abcd", "Zz", "1"]
    texts = ["", None, *("".join(rng.choice(bits) for _ in range(rng.randint(0, 40))) for _ in range(120))]
    lower = str.maketrans({chr(i): chr(i + 32) for i in range(65, 91)})
    expected = Counter()
    for t in texts:
        expected.update(set().union(*(stems(w) for w in re.findall(r"[a-z\u0080-\U0010ffff]+", (t or "").translate(lower))), set()))
    df = spark.createDataFrame([(t,) for t in texts], "_text string").repartition(3)
    got = sorted(r["texts"] for r in T.document_frequency(df).collect())
    assert got == sorted(expected.values())
    some = np.sort(np.array([r["term"] for r in T.document_frequency(df).filter("texts > 5").collect()], np.int64).view(np.uint64))
    again = sorted(r["texts"] for r in T.document_frequency(df, some).collect())
    assert again == [n for n in got if n > 5]


def test_one_text_of_copies_is_in_the_sample(spark):
    rng = random.Random(5)
    long = text(rng, False)
    rows = [(f"{i:03}", long, True) for i in range(50)] + [("x", long, False), ("y", text(rng, False), True), ("z", None, False), ("zz", "", False), ("s", "one two", True)]
    got = T.one_of_copies(spark.createDataFrame(rows, "_key string, _text string, toxic boolean")).collect()
    assert sorted((r["_key"], r["toxic"]) for r in got) == [("000", True), ("s", True), ("x", False), ("y", True), ("z", False)]
