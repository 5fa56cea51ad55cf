import hashlib
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from shardloom.llm import periodic_runs as P
from tests.llm.brute import WORD


def plain_runs(w, least=6, periods=4):
    found = {}
    for q in range(1, len(w) // periods + 1):
        i = 0
        while i + q < len(w):
            j = i
            while j + q < len(w) and w[j] == w[j + q]:
                j += 1
            if j - i + q >= max(least, periods * q):
                found.setdefault((i, j - i + q), q)
            i = max(j, i + 1)
    return sorted((s, n, q) for (s, n), q in found.items())


def plain_collapse(w, runs):
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    return " ".join(x for i, x in enumerate(w) if i not in gone)


def echoed(key, text):
    h = zlib.crc32(str(key).encode())
    w = WORD.findall(text or "")
    if key is None or h % 10 or not w:
        return text
    g, n = h // 10, len(w)
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return " ".join(w[i] if i < a else w[a + (i - a) % p] for i in range(n))


def word_lists(rng, many):
    for _ in range(many):
        k, w = rng.randint(1, 4), []
        for _ in range(rng.randint(0, 6)):
            block = [rng.choice(["a", "b", "é", "日本", "x" * 70][:k + 1]) for _ in range(rng.randint(1, 9))]
            w += (block * rng.randint(1, 9))[:rng.randint(1, 80)]
        yield w


def test_runs_equal_brute_force_over_several_texts_at_once():
    rng = random.Random(3)
    for _ in range(400):
        texts = list(word_lists(rng, rng.randint(1, 5)))
        ids = {}
        names = np.array([ids.setdefault(x, len(ids)) for w in texts for x in w], np.int64)
        rows = np.repeat(np.arange(len(texts)), [len(w) for w in texts])
        at = np.concatenate(([0], np.cumsum([len(w) for w in texts])))
        got = [[] for _ in texts]
        for s, n, q in zip(*P.find_runs(names, rows)):
            got[rows[s]].append((s - at[rows[s]], n, q))
        assert got == [plain_runs(w) for w in texts]


def test_powers_of_two_lengths_and_borders():
    for q in (1, 2, 3, 4, 5, 7, 8, 9, 16, 17):
        for n in (4 * q - 1, 4 * q, 4 * q + 1, 9 * q):
            w = list(range(1000, 1000 + 3)) + [i % q for i in range(n)] + [2000, 2001]
            got = list(zip(*P.find_runs(np.array(w), np.zeros(len(w), np.int64))))
            assert got == ([(3, n, q)] if n >= max(6, 4 * q) else [])
    with pytest.raises(ValueError):
        P.find_runs(np.zeros(9, np.int64), np.zeros(9, np.int64), least_periods=2)


def test_rows_texts_and_clashing_columns(spark):
    rng = random.Random(5)
    texts = [None, "", " \n\t", "one", "a a a a a", "a a a a a a", "a\x0ba\x0ca\ra\na  a", "é " * 9, "a\xa0a " * 8,
             *(rng.choice([" ", "\n", "  "]).join(w) for w in word_lists(rng, 150))]
    texts += [texts[5]] * 40  # repeated rows
    rows = [(i, t, "kept") for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, runs string").withColumn("_runs", F.lit(1))
    got = P.periodic_runs(df)
    assert sorted(got.columns) == ["_runs", "collapsed", "doc_id", "n_words", "runs", "text"]
    seen = got.collect()
    assert len(seen) == len(texts)
    for r in seen:
        w = WORD.findall(r["text"] or "")
        runs = plain_runs(w)
        assert r["n_words"] == len(w) and [tuple(x) for x in r["runs"]] == runs
        assert r["collapsed"] == plain_collapse(w, runs)
    assert P.periodic_runs(df.limit(0)).count() == 0


def test_a_text_longer_than_a_slice(spark):
    rng = random.Random(6)
    head = [str(rng.randint(0, 10**6)) for _ in range(150_000)]
    w = head + ["x", "y", "z"] * 50_000 + head[:7] * 4 + ["end"]
    r = P.periodic_runs(spark.createDataFrame([(1, " ".join(w)), (2, "b " * 10)], "doc_id bigint, text string")).filter("doc_id = 1").first()
    assert len(r["text"]) > 1 << 20
    assert [tuple(x) for x in r["runs"]] == [(150_000, 150_000, 3), (300_000, 28, 7)]
    assert r["collapsed"] == " ".join(head + ["x", "y", "z"] + head[:7] + ["end"])


def test_digests_equal_brute_force(spark):
    rng = random.Random(7)
    rows = [(i, " ".join(rng.choice("abcdefgh") * rng.randint(1, 3) for _ in range(rng.randint(0, 90)))) for i in range(300)]
    rows += [(None, "a b " * 6), (300, None), (301, ""), (5, rows[5][1]), (-7, "q w e r " * 9)]
    got = P.run_digests(spark.createDataFrame(rows, "doc_id bigint, text string").withColumn("_w", F.lit("clash"))).collect()
    expected = []
    for key, text in rows:
        w = WORD.findall(echoed(key, text) or "")
        runs = plain_runs(w)
        best = min(runs, key=lambda x: (-x[1], x[0], x[2]), default=None)
        tail = (*best, 1000 * best[1] // best[2]) if best else (None,) * 4
        lines = "".join(f"{s},{n},{q}\n" for s, n, q in runs)
        expected.append((key, len(runs), *tail, hashlib.sha256(lines.encode()).hexdigest(), hashlib.sha256(plain_collapse(w, runs).encode()).hexdigest()))
    assert sorted(map(repr, map(tuple, got))) == sorted(map(repr, expected))
    assert sum(e[1] > 0 for e in expected) > 10
