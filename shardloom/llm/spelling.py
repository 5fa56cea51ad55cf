"""Spelling variants of a vocabulary: words one edit apart, by walking a trie level by level as joins.

Two words are near if one code point inserted, deleted or replaced turns one into the other. The
trie of the vocabulary is a table of edges, one row per (node, letter), written once and
partitioned by depth. States (word, node, rest of the word, edits) meet the edges of their node in one equi-join a
level: a state without an edit follows its own letter, or replaces it by a later one, or drops
it; a state with an edit follows its letter only. A one-edit state that ends where a word ends
gives a pair of neighbours.

What keeps the frontier small:

* An edit in the second half of a word is looked for in the trie of words, one in the first half
  in the trie of reversed words, so that states start at half the word's length, where the trie is thin.
* An edge carries the set of letters that follow it; a state goes on only if its next letter is one of
  them. Below a node with one word left the rest is compared at once, by its hash.
* A pair is met once: replacing goes to larger letters only, an insertion is the other word's
  deletion, and of equal letters side by side the last is dropped.

Nodes are named by the 64-bit hash of their prefix; names that coincide merge two nodes, which costs work but
loses no pair, and every pair is compared letter by letter at the end. Words of more than
``WALK`` code points (few, but they may be as long as a text) would make the walk as deep as they are long.
They go another exact way: the hashes of a word with each letter left out, computed from prefix sums
in time linear in its length, are joined with each other and with whole words.

A popular node holds many states but at most one edge per letter; the join is a shuffle of two
written tables, which adaptive execution splits where a node is hot. Nothing is capped.

Defined results: null texts have no words, a null key counts as an empty one where words lose a letter; repeated rows count
each; an empty vocabulary gives an empty table; the input's other columns are not read.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shardloom.llm import common as C

LEAST_LENGTH = 7
LEAST_COUNT = 2
FORM_FACTOR = 10
#: Longest word of the walk: it has at most so many levels.
WALK = 48

#: The letters of a run, and those that are lower-cased.
LETTERS = "[A-Za-zÀ-ÿ]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def letter_runs(docs: DataFrame, key: str = "doc_id", text: str = "text", least: int = 1) -> DataFrame:
    """(_k, run): maximal runs of letters of at least ``least`` code points, A to Z lower-cased, one row each."""
    runs = F.regexp_extract_all(F.col(f"`{text}`"), F.lit(LETTERS), F.lit(0))
    rows = docs.select(F.col(f"`{key}`").cast("string").alias("_k"), F.explode(runs).alias("_r")).filter(F.length("_r") >= least)
    return rows.select("_k", F.translate("_r", UPPER, LOWER).alias("run"))


def with_slips(runs: DataFrame, every: int = 31) -> DataFrame:
    """(run): where ``every`` divides h, the unsigned crc32 of ``key:run``, the run has lost its code point h % length."""
    h = F.crc32(F.concat(F.coalesce(F.col("_k"), F.lit("")), F.lit(":"), F.col("run")).cast("binary"))
    at = (h % F.length("run")).cast("int")
    cut = F.concat(F.substring(F.col("run"), F.lit(1), at), F.substring(F.col("run"), at + 2, F.length("run")))
    return runs.select(F.when(h % every == 0, cut).otherwise(F.col("run")).alias("run"))


def vocabulary(runs: DataFrame, least_length: int = LEAST_LENGTH, least_count: int = LEAST_COUNT) -> DataFrame:
    """(id, word, n): distinct runs with their counts, written, so that ids stay."""
    counted = runs.filter(F.length("run") >= least_length).groupBy(F.col("run").alias("word")).agg(F.count("*").alias("n"))
    return C.with_row_key(counted.filter(F.col("n") >= least_count), "id")


def _letter(text: Column, at: int) -> Column:
    """Code point number ``at`` (from 1) of a text; 0 beyond its end."""
    return F.ascii(F.substring(text, at, 1))


def _node(back: Column, prefix: Column) -> Column:
    return F.xxhash64(back, prefix)


def _bits(letter: Column, low: int, high: int) -> Column:
    """One bit of a long for a letter from ``low`` to ``high`` (at most 64 of them), else 0."""
    return F.when(letter.between(low, high), F.call_function("shiftleft", F.lit(1).cast("long"), (letter - low).cast("int"))).otherwise(F.lit(0).cast("long"))


def _follows(letter: Column) -> Column:
    """Whether the joined edge has a word in which ``letter`` comes next."""
    return (F.col("small").bitwiseAND(_bits(letter, 97, 122)) != 0) | (F.col("wide").bitwiseAND(_bits(letter, 0xC0, 0xFF)) != 0)


def directed(words: DataFrame) -> DataFrame:
    """(id, s, size, back, start): each word forwards and backwards, with the depth from which its edits are looked for."""
    size = F.length("word")
    half = F.floor(size / 2).cast("int")
    both = [words.select("id", F.col("word").alias("s"), size.alias("size"), F.lit(False).alias("back"), half.alias("start")),
            words.select("id", F.reverse("word").alias("s"), size.alias("size"), F.lit(True).alias("back"), (size - half).alias("start"))]
    return both[0].unionByName(both[1])


def edge_table(words: DataFrame, first: int) -> str:
    """Folder of the trie's edges from depth ``first`` on, partitioned by the depth of their node.

    (node, letter, child): how many words are ``below``, one of them (``one``) and the hash of what it has after the
    child (``rest``), the letters that come next (``small``, ``wide``: bits), the word that ends there (``ended``).
    """
    rows = directed(words).select("*", F.explode(F.sequence(F.lit(first), F.col("size") - 1)).alias("depth"))
    after = F.substring(F.col("s"), F.col("depth") + 2, F.col("size"))
    steps = rows.select("depth", _node(F.col("back"), F.substring(F.col("s"), F.lit(1), F.col("depth"))).alias("node"),
                        F.ascii(F.substring(F.col("s"), F.col("depth") + 1, F.lit(1))).alias("letter"),
                        _node(F.col("back"), F.substring(F.col("s"), F.lit(1), F.col("depth") + 1)).alias("child"),
                        "id", F.xxhash64(after).alias("hash"), F.ascii(after).alias("next"),
                        F.when(F.col("size") == F.col("depth") + 1, F.col("id")).alias("end"))
    edges = steps.groupBy("depth", "node", "letter", "child").agg(
        F.count("*").alias("below"), F.min("id").alias("one"), F.min("hash").alias("rest"),
        F.bit_or(_bits(F.col("next"), 97, 122)).alias("small"), F.bit_or(_bits(F.col("next"), 0xC0, 0xFF)).alias("wide"),
        F.max("end").alias("ended"))
    folder = C.scratch_path(words.sparkSession, "edges")
    edges.write.partitionBy("depth").parquet(folder)
    return folder


STATE = ["id", "back", "node", "tail", "edits"]


def entering(words: DataFrame, depth: int) -> DataFrame:
    """States of the words whose edits are looked for from ``depth`` on; ``tail`` starts with the letter before the node's end."""
    rows = directed(words).filter(F.col("start") == depth)
    return rows.select("id", "back", _node(F.col("back"), F.substring(F.col("s"), F.lit(1), F.col("start"))).alias("node"),
                       F.substring(F.col("s"), F.col("start"), F.col("size")).alias("tail"), F.lit(0).alias("edits"))


def advance(states: DataFrame, edges: DataFrame) -> DataFrame:
    """One level: (STATE columns of the next level, found), where a row with ``found`` is a pair and no state."""
    left = F.length("tail") - 1
    before, now, then, later = (_letter(F.col("tail"), i) for i in (1, 2, 3, 4))
    met = states.select(*STATE, left.alias("left"), before.alias("before"), now.alias("now"), then.alias("then"), later.alias("later"))
    met = met.join(edges, "node")
    own, fresh = F.col("letter") == F.col("now"), F.col("edits") == 0
    droppable = fresh & F.when(F.col("back"), F.col("now") != F.col("before")).otherwise(F.col("now") != F.col("then"))
    met = met.filter(own | (fresh & (F.col("letter") > F.col("now"))) | (droppable & (F.col("letter") == F.col("then"))))

    def outcome(ok: Column, used: int, following: Column, edits: Column) -> Column:
        """The edge is taken and ``used`` letters of the rest are done: a pair, a state, or nothing (null)."""
        rest_left = F.col("left") - used
        rest = F.substring(F.col("tail"), F.lit(used + 2), F.col("left"))
        found = (F.when(edits == 0, F.lit(None))
                 .when(rest_left == 0, F.col("ended"))
                 .when((F.col("below") == 1) & (F.xxhash64(rest) == F.col("rest")), F.col("one")))
        goes_on = (rest_left > 0) & (F.col("below") > 1) & _follows(following)
        state = F.struct(F.col("id"), F.col("back"), F.col("child").alias("node"), F.substring(F.col("tail"), F.lit(used + 1), F.col("left") + 1).alias("tail"),
                         edits.cast("int").alias("edits"), found.cast("long").alias("found"))
        return F.when(ok & (found.isNotNull() | goes_on), state)

    walked = outcome(own | (F.col("letter") > F.col("now")) & fresh, 1, F.col("then"), F.when(own, F.col("edits")).otherwise(F.lit(1)))
    dropped = outcome(droppable & (F.col("letter") == F.col("then")) & (F.col("left") >= 2), 2, F.col("later"), F.lit(1))
    # The last letter is dropped at the step before it, where the edge tells whether a word ends there.
    last_goes = fresh & own & (F.col("left") == 2) & F.col("ended").isNotNull() & (~F.col("back") | (F.col("then") != F.col("now")))
    last = F.when(last_goes, F.struct(F.col("id"), F.col("back"), F.col("child").alias("node"), F.lit("").alias("tail"), F.lit(1).alias("edits"), F.col("ended").alias("found")))
    return met.select(F.inline(F.array(walked, dropped, last))).filter(F.col("id").isNotNull())


def walked_pairs(words: DataFrame, walk: int = WALK) -> list[DataFrame]:
    """Written tables of candidate pairs (id, found) of words of at most ``walk`` code points, one per level."""
    spark = words.sparkSession
    short = words.filter(F.length("word") <= walk).select("id", "word")
    sizes = [r["size"] for r in short.select(F.length("word").alias("size")).distinct().collect()]  # at most ``walk`` numbers
    if not sizes:
        return []
    starts = {s // 2 for s in sizes} | {s - s // 2 for s in sizes}
    folder = edge_table(short, min(starts))
    edges, states, pairs = spark.read.parquet(folder), None, []
    for depth in range(min(starts), max(sizes)):
        parts = [x for x in (states, entering(short, depth) if depth in starts else None) if x is not None]
        if not parts:
            continue
        level = edges.filter(F.col("depth") == depth).drop("depth")
        table = C.materialize(advance(reduce(DataFrame.unionByName, parts), level), "frontier")
        pairs.append(table.filter("found is not null").select("id", "found"))
        states = table.filter("found is null").select(*STATE)
        states = None if states.isEmpty() else states
    return pairs


def _left_out(batches, walk: int):
    """Hashes of whole words, of words with a letter left out, and of words with a letter masked (tag 0, 1, 2)."""
    for batch in batches:
        ids = batch.column("id").to_numpy()
        for word_id, word in zip(ids, batch.column("word")):
            data = np.frombuffer(word.as_buffer(), np.uint8)
            sums = C.prefix_sums(data)
            _, down = C._powers(len(sums))
            heads = np.flatnonzero((data & 0xC0) != 0x80)
            tails = np.append(heads[1:], len(data))
            keys, tags = [C.span_hash(sums, np.array([0]), np.array([len(data)]))], [np.zeros(1, np.int32)]
            if len(heads) > walk:
                wide = (tails - heads).astype(np.uint64)
                joined = sums[heads] + (sums[-1] - sums[tails]) * down[tails - heads]
                out = C.mix64(joined + (np.uint64(len(data)) - wide) * C._ODD)
                last = np.append(C.span_hash(sums, heads[1:], tails[1:]) != C.span_hash(sums, heads[:-1], tails[:-1]), True)
                place = np.arange(len(heads), dtype=np.uint64)
                masked = C.mix64(joined ^ C.mix64(place * C._ODD + np.uint64(len(heads))))
                keys, tags = [*keys, out[last], masked], [*tags, np.full(last.sum(), 1, np.int32), np.full(len(heads), 2, np.int32)]
            for i in range(len(keys)):
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(keys[i]), word_id)), pa.array(tags[i]), pa.array(keys[i].view(np.int64))],
                                                 names=["id", "tag", "key"])
    C.release_memory()


def long_pairs(words: DataFrame, walk: int = WALK) -> list[DataFrame]:
    """Candidate pairs (id, found) with a word of more than ``walk`` code points."""
    long = words.filter(F.length("word") >= walk).select("id", "word")
    if long.isEmpty():
        return []
    keys = C.materialize(long.mapInArrow(lambda batches: _left_out(batches, walk), "id bigint, tag int, key bigint"), "left_out")
    out, whole, masked = (keys.filter(F.col("tag") == t).drop("tag") for t in (1, 0, 2))
    other = masked.withColumnRenamed("id", "found")
    return [out.join(whole.withColumnRenamed("id", "found"), "key").select("id", "found"),
            masked.join(other, "key").filter("id < found").select("id", "found")]  # a mask's words differ in one letter


def near_pairs(words: DataFrame, walk: int = WALK) -> DataFrame:
    """(id, word, n, near_word, near_n): every pair of near words of (id, word, n), in both directions."""
    found = [*walked_pairs(words, walk), *long_pairs(words, walk)]
    if not found:
        found = [words.select("id", F.col("id").alias("found")).limit(0)]
    pairs = reduce(DataFrame.unionByName, found)
    one = words.select("id", "word", "n")
    other = words.select(F.col("id").alias("found"), F.col("word").alias("near_word"), F.col("n").alias("near_n"))
    rows = pairs.join(one, "id").join(other, "found")
    right = C.materialize(rows.filter(F.levenshtein("word", "near_word", 1) == 1), "near")
    turned = right.select(F.col("found").alias("id"), F.col("near_word").alias("word"), F.col("near_n").alias("n"),
                          F.col("word").alias("near_word"), F.col("n").alias("near_n"))
    return right.select(*turned.columns).unionByName(turned)


def roots(links: DataFrame) -> DataFrame:
    """(word, root) of (word, form): the end of each chain of forms, by doubling pointers.

    Every form is ``FORM_FACTOR`` times as frequent as its word, so a chain has at most one link per digit of a count.
    """
    reach = C.materialize(links.select("word", F.col("form").alias("root")), "roots")
    while True:
        ahead = reach.select(F.col("word").alias("root"), F.col("root").alias("further"))
        step = reach.join(ahead, "root", "left").select("word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved"))
        table = C.materialize(step, "roots")
        reach = table.select("word", "root")
        if table.filter("moved").isEmpty():
            return reach


def spelling_forms(words: DataFrame, factor: int = FORM_FACTOR) -> DataFrame:
    """(word, form, root, n, n_near, form_n) of a vocabulary (id, word, n)."""
    best = F.min(F.struct((-F.col("near_n")).alias("less"), F.col("near_word").alias("word"))).alias("best")
    near = near_pairs(words).groupBy("id").agg(F.count("*").alias("n_near"), best)
    holds = -F.col("best.less") >= factor * F.col("n")
    rows = words.select("id", "word", "n").join(near, "id", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(holds, F.col("best.word")).alias("form"), F.when(holds, -F.col("best.less")).alias("form_n"))
    table = C.materialize(rows, "forms")
    ends = roots(table.filter("form is not null"))
    return table.join(ends, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
