import math
import random

from pyspark.sql import functions as F

from shardloom.llm import html_extract as H
from shardloom.llm import language_id as L
from shardloom.llm import topk
from tests.llm import brute


def test_top_k_equals_brute_force(spark, monkeypatch):
    monkeypatch.setattr(topk, "TILE", 16)
    monkeypatch.setattr(topk, "FAN", 3)
    rng = random.Random(1)
    rows = [(i, [round(rng.uniform(-1, 1), 1) for _ in range(4)]) for i in range(300)]  # coarse values: many ties
    bad = [(1000, None), (1001, [1.0, None, 0.0, 0.0]), (1002, [1.0, float("nan"), 0.0, 0.0]), (1003, [1.0, float("inf"), 0.0, 0.0]), (1004, [1.0]), (1020, [])]
    table = spark.createDataFrame(rows + bad, "vec_id bigint, embedding array<double>")
    clean = topk.clean_vectors(table)
    got = topk.top_k(clean, clean.filter("vec_id % 20 = 0"), 20).collect()
    vectors = {i: [math.floor(64 * x) for x in v] for i, v in rows}
    for q in range(0, 300, 20):
        mine = sorted((r["rank"], r["vec_id"], r["score"]) for r in got if r["query_id"] == q)
        assert mine == [(n + 1, i, s) for n, (i, s) in enumerate(brute.best_of(vectors, q, 20))]


def test_top_k_small_and_large_values(spark):
    rows = [(0, [2.0**40, 1.0]), (20, [2.0**40, -1.0]), (0, [1.0, 1.0]), (None, [1.0, 1.0])]
    clean = topk.clean_vectors(spark.createDataFrame(rows, "vec_id bigint, embedding array<double>").coalesce(1))
    try:
        topk.top_k(clean, clean.filter("vec_id % 20 = 0")).collect()
        raise AssertionError("a score beyond 64 bits has to be an error")
    except Exception as e:  # noqa: BLE001
        assert "64 bits" in str(e)
    small = topk.clean_vectors(spark.createDataFrame(rows[2:] + [(20, [2.0, 0.0])], "vec_id bigint, embedding array<double>"))
    got = sorted((r["query_id"], r["rank"], str(r["vec_id"]), r["score"]) for r in topk.top_k(small, small.filter("vec_id % 20 = 0")).collect())
    assert got == [(0, 1, "20", 8192), (0, 2, "None", 8192), (20, 1, "0", 8192), (20, 2, "None", 8192)]
    none = topk.clean_vectors(spark.createDataFrame([], "vec_id bigint, embedding array<double>"))
    assert topk.top_k(none, none).count() == 0


PAGE = """<!DOCTYPE html><html><head><title>t &amp; t</title><script>var x = "</p><article>";</script></head><body><nav><ul><li><a href=/a>Menu</a></li></ul></nav>
<div class="cookie-notice">We use <b>cookies</b></div><!-- <p>no</p> --><article><header><h1>Head&nbsp;&#233; &lt;1&gt;</h1></header><p>One <b>bold</b>
 text<br>next</p><p>Two<aside>side</aside> more</p><form><p>send</p></form><div id="comments"><p>me too</p></div><style>p{}</style></article><footer>&copy; x</footer></body></html>"""


def test_blocks_and_zones():
    assert [t for z, t in H.blocks_of(PAGE) if z == "article"] == ["Head é <1>", "One bold text next", "Two", "more"]
    assert H.main_text(H.blocks_of("a < b &am"), []) == "a < b &am"
    nested = "<main><p>intro</p><article><p>text</p></article><section class=comments><article><p>me</p></article></section></main><nav><p>x</p><article><p>open nav</p></article>"
    assert H.main_text(H.blocks_of(nested), []) == "text\n\nopen nav"
    assert H.main_text(H.blocks_of("<main><p>a</p><aside>b</aside><p>c</p></main><p>d</p>"), []) == "a\n\nc"
    assert H.blocks_of("") == [] and H.blocks_of("<p>a</p") == [("side", "a")]


def test_repeated_runs_of_a_host_go(spark):
    rng = random.Random(2)
    own = lambda n: " ".join(f"w{rng.randrange(10**6)}" for _ in range(n))
    frame = "<div>all about our lovely site and its many friends</div>"
    bodies = [own(30) for _ in range(6)]
    pages = [(i, f"http://h.example/{i}", f"<body>{frame}<p>{b}</p><div>top of the page again and again please</div></body>") for i, b in enumerate(bodies)]
    pages += [(10, "http://other.example/", f"<body>{frame}<p>{bodies[0]}</p></body>"), (11, None, None), (12, "http://h.example/0", pages[0][2]),
              (13, "http://h.example/x", PAGE), (14, "http://h.example/y", "")]
    table = spark.createDataFrame(pages, "page_id bigint, url string, html string")
    got = {r["page_id"]: r for r in H.extract(table).collect()}
    assert len(got) == len(pages)
    for i, b in enumerate(bodies):
        assert got[i]["text"] == b and got[i]["n_chars"] == len(b)
    assert got[10]["text"] == "all about our lovely site and its many friends\n\n" + bodies[0]  # another host
    assert got[11]["text"] == "" and got[12]["text"] == bodies[0] and got[14]["n_chars"] == 0
    assert got[13]["text"] == "Head é <1>\n\nOne bold text next\n\nTwo\n\nmore"
    assert H.extract(table.limit(0)).count() == 0


def test_host_search_decides_inside_articles(spark):
    rng = random.Random(4)
    own = lambda n: " ".join(f"w{rng.randrange(10**6)}" for _ in range(n))
    frame = "read all about the many friends of this house and write to us today with your own story of it"
    quoted, bodies = own(12), [[own(60), own(50)] for _ in range(8)]
    page = lambda title, paragraphs, ad: f"<div class=ad>{ad}</div><article><h1>{title}</h1>" + "".join(f"<p>{p}</p>" for p in paragraphs) + "</article>"
    rows = [(i, "http://h.example/a", page(f"t{i}", [frame, *b], quoted)) for i, b in enumerate(bodies)]
    rows.append((20, "http://h.example/b", page("t20", [quoted, bodies[0][0]], own(9))))  # shared with two pages' texts and all adverts: kept
    rows += [(30 + i, "http://few.example/", page("t", [frame, b[0]], "")) for i, b in enumerate(bodies[:3])]  # too few pages to tell
    rows += [(40 + i, "http://near.example/", page(f"t{i}", bodies[7], "")) for i in range(6)]  # near copies: kept whole
    rows += [(50 + i, "http://copies.example/", page("t", [frame, bodies[1][0]], own(5))) for i in range(6)]  # one body with other adverts
    got = {r["page_id"]: r["text"].split("\n\n") for r in H.extract(spark.createDataFrame(rows, "page_id bigint, url string, html string")).collect()}
    assert len(got) == len(rows)
    for i, b in enumerate(bodies):
        assert got[i] == [f"t{i}", *b]
    assert got[20] == ["t20", quoted, bodies[0][0]]
    for i in range(3):
        assert got[30 + i] == ["t", frame, bodies[i][0]]
    for i in range(6):
        assert got[40 + i] == [f"t{i}", *bodies[7]] and got[50 + i] == ["t", frame, bodies[1][0]]


WORDS = {"en": "the and that with from this have were which their".split(), "de": "und der die das nicht mit eine wird auch über".split(),
         "fr": "les des une est dans pour que sur avec être".split()}


def test_language_evidence_is_fused(spark):
    rng = random.Random(3)
    say = lambda lang, n: " ".join(rng.choice(WORDS[lang]) for _ in range(n))
    rows = [(i, say(lang, 40), lang, f"{lang}.example") for i, lang in enumerate(["en", "de", "fr"] * 40)]
    rows += [(900, say("de", 40), "en", "de.example"),  # wrong declaration: the text wins
             (901, "", None, "fr.example"),  # no text, nothing declared: not kept
             (902, "zz", "fr", "fr.example"), (903, None, "de", None), (904, "## $$ %% ^^ ## $$ ## ;;;; [[[[ ]]]]", None, None), (905, None, None, None),
             (1, say("en", 40), "en", "en.example")]
    docs = spark.createDataFrame([(*r, "clash", "x", 1.0) for r in rows], "doc_id bigint, text string, lang string, source string, kept string, t string, _s double")
    got = {}
    for r in L.identify_documents(docs).collect():
        got.setdefault(r["doc_id"], r)
    assert len(got) == 126 and set(got[0].asDict()) == {"doc_id", "text", "lang", "source", "t", "_s", *L.OUTPUT}
    for i, (_, _, lang, _) in enumerate(rows[:120]):
        assert got[i]["language"] == lang and got[i]["kept"]
    assert got[900]["language"] == "de" and got[900]["kept"]
    assert not got[901]["kept"] and got[902]["language"] == "fr" and got[903]["language"] == "de" and not got[905]["kept"]
    assert got[904]["language"] == "und" and not got[904]["kept"]
    assert L.identify_documents(docs.limit(0)).count() == 0
    assert {r["language"] for r in L.identify_documents(docs.withColumn("lang", F.lit(None).cast("string"))).collect()} == {"und"}


def test_every_declared_language_has_a_profile(spark):
    rng = random.Random(6)
    codes = [a + b for a in "abcdefgh" for b in "vwxyz"]
    words = {c: ["".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(6)) for _ in range(12)] for c in codes}
    rows = [(i, " ".join(rng.choices(words[c], k=40)), c, f"{c}.example") for i, c in enumerate(codes * 6)]
    got = L.identify_documents(spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string")).collect()
    assert len(codes) == 40 and len(got) == len(rows)
    assert all(r["language"] == r["text_language"] == r["lang"] and r["kept"] for r in got)


def test_address_and_markup_evidence(spark):
    pages = [("https://user@www.News.example.de:8080/fr/x?q", "<html class=a lang='de-AT'>"), ("http://a.com", "<HTML LANG=en>"), (None, None), ("nonsense", "<p lang=fr>")]
    frame = spark.createDataFrame(pages, "url string, html string")
    host, suffix = L.address_parts(F.col("url"))
    got = [tuple(r) for r in frame.select(host, suffix, L.markup_language(F.col("html"))).collect()]
    assert got == [("www.news.example.de", "de/fr", "de-AT"), ("a.com", "com", "en"), (None, None, None), ("", "", "")]


def test_visible_text(spark):
    frame = spark.createDataFrame([("<p>a<script>b</script>c</p><!-- d -->e &amp; <style>f",)], "h string")
    assert frame.select(L.visible_text(F.col("h"))).first()[0].split() == ["a", "c", "e"]
