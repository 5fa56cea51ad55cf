"""Main text of web pages: markup zones plus a host-wide search for repeated token runs.

1. Parsing. A tolerant reader cuts a page into blocks (text between block-level tags, references
   decoded, white space folded) and gives each a zone: ``article`` inside <article>, ``main`` inside
   <main> or role=main only; ``chrome`` inside elements that markup names as menu, header, footer, sidebar, notice,
   advert, form or comments (element, role or a class/id word of ``CHROME_WORDS``), or that are
   hidden; else ``side``. Scripts, styles and the head give no block.
2. Host suffix array. Of each page the stream of words outside article and main (block borders are tokens)
   is searched against the streams of the same host: suffixes are sorted by their first ``RUN``
   tokens (name = host and tokens), and suffixes whose neighbours come from another page with
   a different stream mark their ``RUN`` tokens as repeated. Overlapping marks make up the maximal
   repeated runs of ``RUN`` or more tokens. Sorting and counting is a map-side combined
   aggregation on the names, so a host may hold any share of the pages; copies of a page count once.
   The blocks inside article and main are searched as well. Each is cut into pieces at places that its words decide
   (a suffix whose head's name is divisible by ``PIECE``; so equal runs are cut alike and every token lies in one
   piece), and a piece is framing if at least ``WIDE`` different bodies of the host, and half of them all, hold it.
   Sentences that some articles share, or that an advert quotes, are no framing; copies of a body count once.
3. Decision. Repeated runs and chrome go. If a page has article blocks they are the text, else its
   main blocks if it has any, less the blocks of which at least half the tokens lie in framing pieces (if these hold more than
   half of the body's tokens it is a near copy of other pages, and kept whole); otherwise the ``side`` blocks are, less those of
   which at least half the tokens lie in repeated runs (a block that is mostly unique is kept whole).

Defined results: a null or empty page has an empty text; a null url is a host of its own name (all
such pages together); repeated rows have equal results; every row of the table has one result.
"""

from __future__ import annotations

import html as entities
import re

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shardloom.llm import common as C
from shardloom.llm.language_id import address_parts

RUN = 6
#: Mean tokens of a piece of a body block, and the fewest bodies of a host that make a piece framing.
PIECE, WIDE = 24, 4
BODY = ("article", "main")

#: Elements whose content is never text of the page.
RAW = {"script", "style", "noscript", "template", "iframe", "svg", "canvas", "object", "math", "title", "head", "select", "textarea", "option"}
CHROME_TAGS = {"nav", "footer", "aside", "form", "button", "dialog", "menu", "fieldset", "header"}
CHROME_ROLES = {"navigation", "banner", "contentinfo", "complementary", "search", "form", "alert", "alertdialog", "dialog", "menu", "menubar", "toolbar"}
CHROME_WORDS = {"ad", "ads", "advert", "adverts", "advertisement", "advertising", "sponsor", "sponsored", "promo", "promotion", "banner", "cookie", "cookies",
                "consent", "gdpr", "notice", "notices", "notification", "alert", "popup", "modal", "overlay", "newsletter", "subscribe", "subscription",
                "signup", "login", "sidebar", "sidenav", "menu", "nav", "navbar", "navigation", "breadcrumb", "breadcrumbs", "pagination", "pager",
                "share", "sharing", "social", "related", "recommended", "comment", "comments", "commentlist", "disqus", "reply", "replies", "respond",
                "footer", "header", "masthead", "toolbar", "widget", "copyright", "disclaimer", "skip", "search"}
MAIN_TAGS = {"article", "main"}
INLINE = {"a", "abbr", "acronym", "b", "bdi", "bdo", "big", "cite", "code", "data", "del", "dfn", "em", "font", "i", "img", "ins", "kbd", "label", "mark",
          "q", "s", "samp", "small", "span", "strike", "strong", "sub", "sup", "time", "tt", "u", "var", "wbr", "input"}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}

_MARK = re.compile(r"<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)((?:[^<>\"']|\"[^\"]*\"|'[^']*')*)(/?)>|<[!?/][^>]*(?:>|\Z)|<[a-zA-Z][^<>]*\Z", re.S)
_ATTRIBUTE = re.compile(r"([a-zA-Z_:][-a-zA-Z0-9_:.]*)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
_SPACES = re.compile(r"\s+")


def _attributes(raw: str) -> dict[str, str]:
    return {m[1].lower(): m[2] or m[3] or m[4] or "" for m in _ATTRIBUTE.finditer(raw)} if raw.strip() else {}


def _is_chrome(tag: str, attributes: dict[str, str], in_main: bool) -> bool:
    if tag in CHROME_TAGS and not (tag == "header" and in_main):  # an article's own header holds its title
        return True
    if not attributes:
        return False
    if attributes.get("role", "").lower() in CHROME_ROLES or "hidden" in attributes or attributes.get("aria-hidden") == "true":
        return True
    if "display:none" in attributes.get("style", "").replace(" ", "").lower():
        return True
    if tag in ("html", "body", *MAIN_TAGS):
        return False
    words = re.split(r"[^a-z]+", (attributes.get("class", "") + " " + attributes.get("id", "")).lower())
    return any(w in CHROME_WORDS for w in words)


def blocks_of(page: str) -> list[tuple[str, str]]:
    """(zone, text) of a page's blocks, in page order."""
    out: list[tuple[str, str]] = []
    held: list[str] = []
    chrome: list[tuple[str, int]] = []  # open chrome element and how many of its name are open inside
    main: list[str] = []
    at, size = 0, len(page)

    def close():
        text = _SPACES.sub(" ", entities.unescape("".join(held))).strip()
        held.clear()
        if text:
            out.append(("chrome" if chrome else "article" if "article" in main else "main" if main else "side", text))

    while at < size:
        mark = _MARK.search(page, at)
        held.append(page[at:mark.start() if mark else size])
        if not mark:
            break
        at = mark.end()
        tag = mark[2].lower() if mark[2] else ""
        if not tag:
            continue
        if not mark[1] and tag in RAW:
            close()
            end = re.compile(rf"</{tag}\b[^>]*(?:>|\Z)", re.I).search(page, at)
            if tag == "head" and not end:  # without its end tag the body starts at <body>
                end = re.compile(r"(?=<body\b)", re.I).search(page, at)
            at = end.end() if end else size
            continue
        if tag == "br":
            held.append(" ")
            continue
        if mark[1]:
            if tag not in INLINE or (chrome and chrome[-1][0] == tag):
                close()
            if chrome and chrome[-1][0] == tag:
                name, depth = chrome.pop()
                if depth > 1:
                    chrome.append((name, depth - 1))
            elif main and main[-1] == tag and not chrome:
                main.pop()
            continue
        attributes = _attributes(mark[3])
        if tag not in INLINE:
            close()
        if mark[4] or tag in VOID:
            continue
        if chrome:
            if tag in MAIN_TAGS and not main and chrome[-1][0] not in ("aside", "div", "section", "ul", "ol"):
                chrome.clear()  # a menu or header that was never closed ends where the text begins
            elif chrome[-1][0] == tag:
                chrome[-1] = (tag, chrome[-1][1] + 1)
                continue
        if not chrome and _is_chrome(tag, attributes, bool(main)):
            close()
            chrome.append((tag, 1))
        elif not chrome and (tag in MAIN_TAGS or attributes.get("role", "").lower() == "main"):
            main.append(tag)
    close()
    return out


def side_stream(blocks: list[tuple[str, str]]) -> tuple[list[str], list[int]]:
    """Tokens outside article and main (a border token before each block) and the block of each."""
    tokens, of = [], []
    for i, (zone, text) in enumerate(blocks):
        if zone not in BODY:
            words = ["\n", *text.split(" ")]
            tokens += words
            of += [i] * len(words)
    return tokens, of


def body_stream(blocks: list[tuple[str, str]]) -> tuple[list[str], list[int]]:
    """Tokens of the page's text zone (article, else main; a border token before each block) and the block of each."""
    tokens, of = [], []
    body = next((b for b in BODY if any(zone == b for zone, _ in blocks)), None)
    for i, (zone, text) in enumerate(blocks):
        if zone == body:
            words = ["\n", *text.split(" ")]
            tokens += words
            of += [i] * len(words)
    return tokens, of


def _hashes(strings: list[str]) -> np.ndarray:
    coded = [t.encode() for t in strings]
    offsets = np.concatenate(([0], np.cumsum([len(t) for t in coded]))).astype(np.int64)
    return C.span_hash(C.prefix_sums(np.frombuffer(b"".join(coded), np.uint8)), offsets[:-1], offsets[1:])


def _streams(streams: list[list[str]]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Hash and page of each token, first token of each page, and the stream hash of each page."""
    sizes = np.array([len(s) for s in streams], np.int64)
    word = _hashes([t for s in streams for t in s])
    page = np.repeat(np.arange(len(streams)), sizes)
    start = np.cumsum(sizes) - sizes
    rolled = C.mix64(word + C.mix64((np.arange(len(word)) - start[page] + 1).astype(np.uint64)))
    whole = np.zeros(len(streams), np.uint64)
    np.add.at(whole, page, rolled)
    return word, page, start, C.mix64(whole)


def _stream_names(streams: list[list[str]], hosts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Names of all RUN-token suffix heads: (page, token position, name), and the stream hash of each page."""
    word, page, start, whole = _streams(streams)
    names, first = C.window_hash(word, page, RUN)
    return page[first], first - start[page[first]], C.mix64(names + _hashes(hosts)[page[first]]), whole


def piece_starts(word: np.ndarray, block: np.ndarray) -> np.ndarray:
    """First token of each piece: the first of its block, or one where a head of RUN tokens of the block has a name divisible by PIECE."""
    cut = np.ones(len(block), bool)
    cut[1:] = block[1:] != block[:-1]
    names, first = C.window_hash(word, block, RUN)
    cut[first[names % np.uint64(PIECE) == 0]] = True
    return np.flatnonzero(cut)


def _piece_names(streams: list[tuple[list[str], list[int]]], hosts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Names of all pieces of the bodies: (page, token position, name), the stream hash and the host's hash of each page."""
    word, page, start, whole = _streams([tokens for tokens, _ in streams])
    block = (page << 32) + np.array([i for _, of in streams for i in of], np.int64)
    first = piece_starts(word, block)
    # A piece is named by its tokens, at least RUN of its block.
    border = np.flatnonzero(np.append(block[1:] != block[:-1], True)) + 1 if len(block) else np.zeros(0, np.int64)
    last = border[np.searchsorted(border, first, side="right")]
    end = np.maximum(np.append(first[1:], len(word)), np.minimum(first + RUN, last))
    name = C.span_hash(C.prefix_sums(word.view(np.uint8)), 8 * first, 8 * end)
    host = _hashes(hosts)
    return page[first], first - start[page[first]], C.mix64(name + host[page[first]]), whole, host


KEY = ["k1", "k2"]


def _names(batches):
    for batch in batches:
        for part, _, _ in C.byte_slices(batch, "html"):
            blocks, hosts = [blocks_of(h) for h in part.column("html").to_pylist()], part.column("host").to_pylist()
            keys = [part.column(k).to_numpy() for k in KEY]
            page, at, name, whole = _stream_names([side_stream(b)[0] for b in blocks], hosts)
            yield _name_rows(keys, page, at, name, whole, pa.nulls(len(page), pa.int64()))
            page, at, name, whole, host = _piece_names([body_stream(b) for b in blocks], hosts)
            yield _name_rows(keys, page, -1 - at, name, whole, pa.array(host.view(np.int64)[page]))


def _name_rows(keys, page, at, name, whole, host) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(k[page]) for k in keys] + [pa.array(at.astype(np.int32)), pa.array(name.view(np.int64)), pa.array(whole.view(np.int64)[page]), host],
        names=[*KEY, "at", "name", "stream", "host"])


def body_text(blocks: list[tuple[str, str]], framing: list[int]) -> str:
    """The text of a page with a body, given the positions of framing pieces in its body stream."""
    tokens, of = body_stream(blocks)
    kept = {*of}
    if framing:
        block = np.array(of, np.int64)
        first = piece_starts(_hashes(tokens), block)
        size = np.diff(np.append(first, len(of)))
        covered = np.repeat(np.isin(first, framing), size)
        if 2 * covered.sum() <= len(of):
            hit, whole = np.bincount(block, weights=covered), np.bincount(block)
            kept = {i for i in kept if 2 * hit[i] < whole[i]}
    return "\n\n".join(text for i, (_, text) in enumerate(blocks) if i in kept)


def main_text(blocks: list[tuple[str, str]], repeated: list[int]) -> str:
    """The text of a page, given the positions of repeated suffix heads in its side stream and (as -1 - position) of framing pieces in its body."""
    if any(zone in BODY for zone, _ in blocks):
        return body_text(blocks, [-1 - at for at in repeated if at < 0])
    _, of = side_stream(blocks)
    covered = np.zeros(len(of) + RUN, np.int64)
    for at in repeated:
        covered[at:at + RUN] = 1
    of = np.array(of, np.int64)
    hit = np.bincount(of, weights=covered[:len(of)], minlength=len(blocks))
    size = np.bincount(of, minlength=len(blocks))
    return "\n\n".join(text for i, (zone, text) in enumerate(blocks) if zone == "side" and 2 * hit[i] < size[i])


def _shut(batches):
    tool = zstandard.ZstdCompressor(level=3)
    for batch in batches:
        body = [tool.compress(x.as_buffer()) for x in batch.column("html").cast(pa.binary())]
        yield pa.RecordBatch.from_arrays([batch.column(c) for c in ("page_id", "url", *KEY)] + [pa.array(body, pa.binary())], names=["page_id", "url", *KEY, "body"])


def _texts(batches):
    loosen = zstandard.ZstdDecompressor()
    for batch in batches:
        texts = []
        for body, repeated in zip(batch.column("body").to_pylist(), batch.column("repeated").to_pylist()):
            texts.append(main_text(blocks_of(loosen.decompress(body).decode()), repeated))
        yield pa.RecordBatch.from_arrays([batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                                         names=["page_id", "url", "text", "n_chars"])


def framing_pieces(pieces: DataFrame) -> DataFrame:
    """The pieces that at least ``WIDE`` bodies of their host, and half of its different bodies, hold."""
    total = pieces.select("host", "stream").distinct().groupBy("host").agg(F.count("*").alias("bodies")).filter(F.col("bodies") >= WIDE)
    # A piece on one body only, as most are, is settled without counting.
    shared = pieces.groupBy("name").agg(F.min("stream").alias("lo"), F.max("stream").alias("hi")).filter("lo <> hi").select("name")
    held = C.materialize(pieces.join(shared, "name", "left_semi"), "shared-pieces")
    count = held.select("host", "name", "stream").distinct().groupBy("host", "name").agg(F.count("*").alias("n")).filter(F.col("n") >= WIDE)
    return held.join(count.join(total, "host").filter("2 * n >= bodies").select("name"), "name", "left_semi")


def extract(pages: DataFrame) -> DataFrame:
    """(page_id, url, text, n_chars) of every row of ``pages`` (page_id, url, html)."""
    host, _ = address_parts(F.coalesce("url", F.lit("")))
    rows = pages.select("page_id", "url", F.coalesce("html", F.lit("")).alias("html"), host.alias("host"))
    rows = rows.select("*", F.xxhash64("host", "html").alias("k1"), F.xxhash64(F.lit(RUN), F.col("host"), F.col("html")).alias("k2"))
    names = C.materialize(rows.select(*KEY, "host", "html").mapInArrow(_names, "k1 bigint, k2 bigint, at int, name bigint, stream bigint, host bigint"), "names")
    # Neighbours in the sorted order come from different streams if the smallest and the largest stream differ.
    side = names.filter("host is null")
    again = side.groupBy("name").agg(F.min("stream").alias("lo"), F.max("stream").alias("hi")).filter("lo <> hi").select("name")
    repeated = C.materialize(side.join(again, "name", "left_semi").unionByName(framing_pieces(names.filter("host is not null")).select(*names.columns))
                             .groupBy(*KEY).agg(F.sort_array(F.collect_set("at")).alias("repeated")), "repeated")
    C.discard(rows.sparkSession, names)  # its shuffles go before the pages are shuffled
    shut = rows.select("page_id", "url", *KEY, "html").mapInArrow(_shut, "page_id bigint, url string, k1 bigint, k2 bigint, body binary")
    # Positions grow with the pages: their join is the same at any size, no broadcast of a table that happens to be small.
    ready = shut.join(repeated.hint("merge"), KEY, "left").select("page_id", "url", "body", F.coalesce("repeated", F.array().cast("array<int>")).alias("repeated"))
    return ready.mapInArrow(_texts, "page_id bigint, url string, text string, n_chars bigint")
