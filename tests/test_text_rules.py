"""The cleaning rules on edge inputs, each with the result written out."""

import hashlib

import pytest
from pyspark.sql import functions as F

from shardloom.functions import pretok as PT
from shardloom.functions import text as T
from shardloom.operators.clean import clean_lines

NORMALIZED = [("  12 comments here", "12 comments here"), ("a\u001cb  c\t d", "a b c d"), ("line one\r\nline two", "line one line two"),
              ("   ", ""), ("", ""), ("x​y", "x​y"), (None, None)]
WIKI = [("12 @-@ 3 @,@ 4", "12 - 3 , 4"), ("1 @.@ 5", "1 . 5"), ("@-", "@-")]
MARKUP_EMPTIES = ["= Title =", "=", "==", "=== A ===", "***---___", "___", "​"]
MARKUP_KEEPS = ["a = b", "= a", "***a***", "²²"]
BOILERPLATE = ["Copyright 2020 x", "copyright ٢٠٢٠ y", "12 comments here", "1 likes", "1like", "ſubscribe now", "Log In here",
               "sign up", "Privacy Policy applies", "cookie policy", "All Rights Reserved.", "read more of this", "See also: x", "Advertisement", "This page is"]
NOT_BOILERPLATE = ["my privacy policy", "copyright 20", "comments 12", "subscribed", "reading more", "this article says", "log on"]
UNCITED = [("see [12] ok [Citation needed] done", "see  ok  done"), ("[a1] [] [1a]", "[a1] [] [1a]"), ("x[CITATIONS here]y[3]", "xy"), ("[12", "[12")]
REASONS = [("x" * 100, "ok"), ("x" * 99, "too_short"), ("a" * 80000, "ok"), ("a" * 80001, "too_long"), ("1" * 15 + "a" * 85, "ok"),
           ("1" * 16 + "a" * 84, "high_digit"), ("²" * 20 + "a" * 80, "high_digit"), ("é" * 61 + "!" * 39, "low_alpha"),
           ("é" * 62 + "!" * 38, "ok"), ("a " * 50, "ok"), ("中" * 100, "ok")]


def apply(spark, values, expr):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, t string")
    return [r["o"] for r in df.select("i", expr(F.col("t")).alias("o")).orderBy("i").collect()]


@pytest.mark.parametrize("rule,cases", [(T.normalize_text, NORMALIZED), (T.fix_wiki_artifacts, WIKI), (T.remove_citations, UNCITED),
                                        (lambda c: F.coalesce(T.quality_reason(c), F.lit("ok")), REASONS)])
def test_rule_tables(spark, rule, cases):
    assert apply(spark, [a for a, _ in cases], rule) == [b for _, b in cases]


def test_emptying_rules(spark):
    assert apply(spark, MARKUP_EMPTIES + MARKUP_KEEPS, T.remove_wiki_markup) == [""] * len(MARKUP_EMPTIES) + MARKUP_KEEPS
    assert apply(spark, BOILERPLATE + NOT_BOILERPLATE, T.remove_boilerplate) == [""] * len(BOILERPLATE) + NOT_BOILERPLATE


def test_ratios(spark):
    texts = ["", "ab 1", "1²٣a", "!!"]
    assert apply(spark, texts, T.alpha_ratio) == [0.0, 0.75, 0.25, 0.0]
    assert apply(spark, texts, T.digit_ratio) == [0.0, 0.25, 0.75, 0.0]


def test_chains_by_policy(spark):
    """The chain that the cleaning stage runs, for each policy."""
    long = "word " * 30
    rows = [("wikitext", "== " + long + "==", "", "heading"), ("wikitext", "*-* " * 30, "", "symbols_only"),
            ("wikitext", "a @-@ b " + long, "a - b " + long.strip(), None), ("wikitext", "read more " + long, "read more " + long.strip(), None),
            ("bookcorpus", "read more " + long, "", "boilerplate"), ("bookcorpus", "a[1] " + long, "a " + long.strip(), None),
            ("default", "a[1] " + long, "a[1] " + long.strip(), None), ("default", "a @-@ b " + long, "a @-@ b " + long.strip(), None),
            ("default", "short", "short", "too_short"), (None, "See also " + long, "", "boilerplate")]
    df = spark.createDataFrame([(i, p, t) for i, (p, t, _, _) in enumerate(rows)], "i int, p string, line string")
    got = clean_lines(df, F.coalesce("p", F.lit("default"))).orderBy("i").collect()
    assert [(r["cleaned"], r["reject_reason"]) for r in got] == [(c, why) for _, _, c, why in rows]
    assert [r["sha1"] for r in got] == [hashlib.sha1(c.encode()).hexdigest() if why is None else None for _, _, c, why in rows]


def test_policy_and_cap_come_from_the_registry(spark):
    assert apply(spark, ["a", "b", "c", None], lambda c: T.policy_of_registry(c, {"a": "wikitext", "b": "bookcorpus"})) == ["wikitext", "bookcorpus", "default", "default"]
    assert apply(spark, ["a", "b"], lambda c: T.registry_value(c, {"a": 3})) == [3, None]


def test_not_blank_and_sha1(spark):
    assert apply(spark, ["", "  \t", "​", "x", None], T.not_blank) == [False, False, True, True, False]
    assert apply(spark, ["é"], T.sha1_hex) == [hashlib.sha1("é".encode()).hexdigest()]


def test_split_bucket_matches_python(spark):
    ids = [f"src{i}__train__{j:06d}" for i in range(5) for j in range(40)]
    assert apply(spark, ids, T.sha256_mod) == [int(hashlib.sha256(s.encode()).hexdigest(), 16) % 10000 for s in ids]


def test_nfkc_keeps_every_row(spark):
    cases = [("ﬁn", "fin"), ("Ａ１", "A1"), ("é", "é"), ("²", "2"), ("Å", "Å"), ("plain", "plain"), ("", ""), (None, None)]
    df = spark.createDataFrame([(i, a) for i, (a, _) in enumerate(cases)], "i int, t string")
    got = {r["i"]: r["t"] for r in PT.nfkc_frame(df, "t").collect()}
    assert got == {i: b for i, (_, b) in enumerate(cases)}


def test_rules_over_every_kind_of_character(spark):
    """The Latin-1 forms of the rules agree with the definitions over Python's str."""
    import sys
    marks = [chr(i) for i in range(1, 256)] + [chr(i) for i in range(256, sys.maxunicode + 1) if chr(i).isspace() or chr(i).isdigit()][:400] + list("\u0142\u4e2d\u20ac\U0001f600")
    texts = [f"a{x}{x} b @-@ [1] {y}" for x in marks for y in ("", "\u4e2d")] + ["", " ", "  a  ", "a b", "\r\n", "a\tb", "x@,@y@.@z", "[12] [Citation needed] z[", "[[3]]"]
    got = spark.createDataFrame(list(enumerate(texts)), "i int, t string").select(
        "i", T.normalize_text(F.col("t")).alias("n"), T.alpha_count(F.col("t")).alias("a"), T.digit_count(F.col("t")).alias("d"),
        T.fix_wiki_artifacts(F.col("t")).alias("w"), T.remove_citations(F.col("t")).alias("c"), T.split_lines(F.col("t")).alias("s")).collect()
    import re
    for r in got:
        t = texts[r["i"]]
        assert r["n"] == " ".join(t.split()), ascii(t)
        assert r["a"] == sum(x.isalpha() or x.isspace() for x in t) and r["d"] == sum(x.isdigit() for x in t), ascii(t)
        assert r["w"] == t.replace("@-@", "-").replace("@,@", ",").replace("@.@", ".")
        assert r["c"] == re.sub(r"(?i)\[[^\]]*citation[^\]]*\]", "", re.sub(r"\[[0-9]+\]", "", t)) and r["s"] == re.split("\r\n|\r|\n", t)
