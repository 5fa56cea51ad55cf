import random
import re
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from shardloom.llm import spelling as S

RUN = re.compile("[A-Za-zÀ-ÿ]+")
LOWER = str.maketrans(S.UPPER, S.LOWER)


def near(a, b):
    if abs(len(a) - len(b)) > 1 or a == b:
        return False
    a, b = sorted((a, b), key=len)
    i = 0
    while i < len(a) and a[i] == b[i]:
        i += 1
    return a[i + (len(a) == len(b)):] == b[i + 1:]


def plain_vocabulary(docs):
    n = Counter()
    for key, text in docs:
        for run in RUN.findall(text or ""):
            run = run.translate(LOWER)
            h = zlib.crc32(f"{'' if key is None else key}:{run}".encode())
            if h % 31 == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            n[run] += 1
    return {w: c for w, c in n.items() if len(w) >= 7 and c >= 2}


def plain_forms(n):
    by_length = {}
    for w in n:
        by_length.setdefault(len(w), []).append(w)
    form, count = {}, {}
    for w in n:
        found = [u for k in (-1, 0, 1) for u in by_length.get(len(w) + k, []) if near(w, u)]
        count[w] = len(found)
        best = min(found, key=lambda u: (-n[u], u), default=None)
        form[w] = best if best and n[best] >= 10 * n[w] else None
    out = []
    for w in n:
        root = w
        while form[root]:
            root = form[root]
        out.append((w, form[w], root, n[w], count[w], n[form[w]] if form[w] else None))
    return sorted(out, key=repr)


def edited(rng, w, alphabet):
    i = rng.randrange(len(w) + 1)
    return rng.choice([w[:i] + rng.choice(alphabet) + w[i:], w[:i] + w[i + 1:], w[:i] + rng.choice(alphabet) + w[i + 1:]])


def families(rng, alphabet, sizes, many):
    words = set()
    for _ in range(many):
        w = "".join(rng.choice(alphabet) for _ in range(rng.choice(sizes)))
        words.add(w)
        for _ in range(rng.randint(0, 6)):
            words.add(edited(rng, w, alphabet))
            w = edited(rng, w, alphabet) if rng.random() < 0.3 else w
    return sorted(w for w in words if len(w) >= 7)


@pytest.mark.parametrize("alphabet, sizes, many, walk", [("ab", range(7, 12), 60, S.WALK), ("aéÿÀz", [*range(7, 13), 15], 120, S.WALK),
                                                         ("aébcdefghi", [8, 9, 10, 11, 12, 13, 300], 60, 10)])
def test_pairs_equal_brute_force(spark, alphabet, sizes, many, walk):
    words = families(random.Random(9), alphabet, list(sizes), many)
    df = spark.createDataFrame([(i, w, 1) for i, w in enumerate(words)], "id bigint, word string, n bigint").repartition(3)
    got = [(r["word"], r["near_word"]) for r in S.near_pairs(df, walk).collect()]
    expected = [(a, b) for a in words for b in words if near(a, b)]
    assert sorted(got) == sorted(expected)  # each pair once in each direction
    assert len(expected) > 20


def test_forms_equal_brute_force(spark):
    rng = random.Random(2)
    base = families(rng, "abcdeé", [7, 8, 9], 30) + ["Straßenbahn", "tausendfach"]
    docs = [(i, " ".join(w for w in base for _ in range(rng.choice([0, 0, 1, 1, 2, 30])))) for i in range(30)]
    docs += [(100, "Zebrafish zebrafish " * 500 + "zebrafich zebrafich"), (101, "zebraflsh " * 30 + "zebraflshs " * 3), (None, "zebrafish " * 3), (103, None), (107, f"{'x' * 60} {'x' * 61} " * 2),
             (104, ""), (5, "short words no"), (5, docs[5][1]), (106, "ZEBRAFÌSH2zebrafÌsh")]
    df = spark.createDataFrame(docs, "doc_id bigint, text string").withColumn("word", F.lit("clash")).withColumn("_k", F.lit(0))
    words = S.vocabulary(S.with_slips(S.letter_runs(df, least=S.LEAST_LENGTH)))
    expected = plain_vocabulary(docs)
    assert {r["word"]: r["n"] for r in words.collect()} == expected
    got = sorted(map(tuple, S.spelling_forms(words).collect()), key=repr)
    assert got == plain_forms(expected)
    assert any(f for _, f, *_ in got) and any(f and f != r for _, f, r, *_ in got)  # chains of two links as well


def test_a_prefix_that_a_third_of_the_words_share(spark):
    rng = random.Random(4)
    words = {"common" + "".join(rng.choice("abc") for _ in range(rng.randint(1, 6))) for _ in range(150)} | set(families(rng, "mnopq", [7, 8], 60))
    df = spark.createDataFrame([(i, w, 1) for i, w in enumerate(sorted(words))], "id bigint, word string, n bigint")
    assert sorted((r["word"], r["near_word"]) for r in S.near_pairs(df).collect()) == sorted((a, b) for a in words for b in words if near(a, b))


def test_empty_tables(spark):
    empty = spark.createDataFrame([], "doc_id bigint, text string")
    assert S.spelling_forms(S.vocabulary(S.with_slips(S.letter_runs(empty)))).collect() == []
    alone = spark.createDataFrame([(1, "lonesome lonesome")], "doc_id bigint, text string")
    assert [tuple(r) for r in S.spelling_forms(S.vocabulary(S.letter_runs(alone))).collect()] == [("lonesome", None, "lonesome", 2, 0, None)]
