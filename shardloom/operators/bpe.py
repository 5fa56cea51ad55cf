"""Byte-level BPE vocabulary learning and encoding as Spark jobs.

The corpus is reduced once to the pre-token frequency table (T1, vocabulary-bounded,
map-side combined). Training works on that table of distinct words, thousands of merges a round:

1. Spark counts the adjacent symbol pairs of all words, weighted by word frequency, and the
   ``WINDOW`` best pairs (count desc, left id asc, right id asc) become the round's hot pairs.
2. Spark cuts every word into its hot segments, the longest stretches in which each adjacent
   pair is hot, and adds up the frequencies of equal segments.
3. The driver merges within these segments, best pair first, until the best pair ranks
   after the last hot one. The segments are a bounded table (``SEGMENT_SYMBOLS``); if there are more, the
   round takes fewer hot pairs.
4. Spark applies the round's merges to all words.

A round gives exactly the merges that one merge at a time over all words gives. Counts of
old pairs only fall, and a pair (y, x) with the new symbol x = ab stands where (y, a) stood: it is no more
frequent and its ids are larger, so it ranks after (y, a); likewise on the right. By induction every
pair that ranks before the last hot one at any time stands where hot pairs stood, so all its occurrences are inside
hot segments and the driver's count of it is the count over all words. This holds for ties and for pairs
(a, a). The exception is a merge whose text is an older token's: it makes more of an old symbol,
so it ends its round.

The merge list lives on the driver; it is bounded by the vocabulary size.
"""

from __future__ import annotations

import heapq
import json
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as Ty

from ..functions import pretok as PT
from ..functions.tokens import SPECIAL_TOKENS, UNK_ID
from ..session import drop_tables, materialize

PAIR_BASE = 1 << 20           # pair key = left * PAIR_BASE + right (ids < 2^20)
VOCAB_SIZE = 32_000
MIN_FREQUENCY = 2
WINDOW = 16_384               # hot pairs of a round (a window, not a cap: the next round
                              # takes the best of the updated counts)
WORD_BYTES = 4 << 20          # of words that a task works on at once
SEGMENT_SYMBOLS = 1_500_000   # symbols of distinct hot segments that a round brings to the driver


# ----------------------------------------------------------------------------- T1 / T2

def training_corpus(lines: DataFrame) -> DataFrame:
    """The lines a vocabulary is learned from; an empty corpus is an error, found before anything is counted."""
    if lines.isEmpty():
        raise ValueError("the corpus is empty: there is nothing to learn a vocabulary from")
    return lines


def _joined(batches, limit: int):
    """Batches in a row, put together up to about ``limit`` bytes: Arrow batches may be as short as the session says."""
    held, size = [], 0
    for batch in batches:
        if held and size + batch.nbytes > limit:
            yield pa.concat_batches(held)
            held, size = [], 0
        held.append(batch)
        size += batch.nbytes
    if held:
        yield pa.concat_batches(held)


def pretoken_freq(lines: DataFrame, text_col: str = "text", with_newline: bool = True,
                  normalize: bool = True) -> DataFrame:
    """(pretoken, freq) over the corpus. Each line is one training line; with
    ``with_newline`` the line keeps its trailing newline, as when training from a file."""
    df = lines.select(F.col(text_col).alias("_t"))
    if normalize:
        df = PT.nfkc_frame(df, "_t")
    t = F.concat(F.col("_t"), F.lit("\n")) if with_newline else F.col("_t")
    return (df.select(F.explode(PT.pretokens(t)).alias("pretoken"))
            .groupBy("pretoken").agg(F.count(F.lit(1)).alias("freq")))


def _byte_values(batches):
    for batch in batches:
        body = b"".join(batch.column(0).drop_null().to_pylist())
        yield pa.RecordBatch.from_arrays([pa.array(np.unique(np.frombuffer(body, np.uint8)).astype(np.int32))], names=["byte"])


def alphabet(freq: DataFrame) -> DataFrame:
    """Bytes seen in the corpus, ordered by byte-level char code point; ids after specials."""
    b = freq.select(F.encode("pretoken", "UTF-8")).mapInArrow(_byte_values, "byte int").distinct()
    b = b.withColumn("char_code", PT.byte_char_code_expr(F.col("byte")))
    # At most 256 rows: a single-partition window is fine here.
    w = Window.orderBy("char_code")
    return b.withColumn("id", (F.row_number().over(w) - 1 + len(SPECIAL_TOKENS)).cast("int"))


def _map_literal(d: dict) -> F.Column:
    return F.create_map(*[F.lit(x) for kv in sorted(d.items()) for x in kv])


def initial_words(freq: DataFrame, byte_ids: dict[int, int]) -> DataFrame:
    """Distinct words as arrays of alphabet ids (bytes unseen in training -> <unk>)."""
    m = _map_literal(byte_ids)
    syms = F.transform(PT.utf8_bytes(F.col("pretoken")), lambda b: F.coalesce(m[b], F.lit(UNK_ID)))
    return freq.select(syms.alias("symbols"), F.col("freq").cast("long").alias("freq"))


# Training state: a word is a binary of 32-bit symbol ids, so that tasks read a batch of words as
# one flat numpy array with offsets.

_SYMBOL = np.dtype("<i4")


def _flat_words(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Symbols of all words of a binary column, and the n + 1 offsets of the words."""
    if not len(column):
        return np.zeros(0, _SYMBOL), np.zeros(1, np.int64)
    at = np.frombuffer(column.buffers()[1], np.int32, len(column) + 1, column.offset * 4).astype(np.int64)
    body = column.buffers()[2]
    flat = np.frombuffer(body, np.uint8)[at[0]:at[-1]].view(_SYMBOL) if body is not None else np.zeros(0, _SYMBOL)
    return flat, (at - at[0]) // _SYMBOL.itemsize


def _binary_words(flat: np.ndarray, offsets: np.ndarray) -> pa.Array:
    at = pa.py_buffer((offsets * _SYMBOL.itemsize).astype(np.int32))
    return pa.Array.from_buffers(pa.binary(), len(offsets) - 1, [None, at, pa.py_buffer(np.ascontiguousarray(flat, _SYMBOL))])


def _pair_keys(flat: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pair key of every symbol and its follower, -1 at the end of a word; the word of every symbol."""
    word = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
    keys = np.full(len(flat), -1, np.int64)
    inside = word[1:] == word[:-1]
    keys[:-1][inside] = (flat[:-1].astype(np.int64) * PAIR_BASE + flat[1:])[inside]
    return keys, word


def _find(keys: np.ndarray, table: np.ndarray) -> np.ndarray:
    """Place of each key in the ascending ``table``, -1 where it is not there."""
    if not len(table):
        return np.full(len(keys), -1, np.int64)
    at = np.minimum(np.searchsorted(table, keys), len(table) - 1)
    return np.where(table[at] == keys, at, -1)


def symbol_words(freq: DataFrame, byte_ids: dict[int, int]) -> DataFrame:
    """(w BINARY, freq) of the distinct words of two symbols or more (bytes unseen in training -> <unk>)."""
    ids = np.full(256, UNK_ID, _SYMBOL)
    ids[list(byte_ids)] = list(byte_ids.values())

    def run(batches):
        for batch in batches:
            text = batch.column("pretoken")
            at = np.frombuffer(text.buffers()[1], np.int32, len(text) + 1, text.offset * 4).astype(np.int64) if len(text) else np.zeros(1, np.int64)
            body = np.frombuffer(text.buffers()[2], np.uint8)[at[0]:at[-1]] if at[-1] > at[0] else np.zeros(0, np.uint8)
            words = _binary_words(ids[body], at - at[0])
            yield pa.RecordBatch.from_arrays([words, batch.column("freq")], names=["w", "freq"])

    rows = freq.select("pretoken", F.col("freq").cast("long").alias("freq")).filter(F.octet_length("pretoken") >= 2)
    return rows.mapInArrow(run, "w binary, freq bigint")


def symbol_pair_counts(words: DataFrame) -> DataFrame:
    """T3 on the training state: (pair, count), added up by some MB of words before they are shuffled."""
    def run(batches):
        for batch in _joined(batches, WORD_BYTES):
            keys, word = _pair_keys(*_flat_words(batch.column("w")))
            there = np.flatnonzero(keys >= 0)
            there = there[np.argsort(keys[there])]
            keys, weight = keys[there], batch.column("freq").to_numpy()[word[there]]
            first = np.flatnonzero(np.append(True, keys[1:] != keys[:-1])) if len(keys) else keys
            count = np.add.reduceat(weight, first) if len(keys) else keys
            yield pa.RecordBatch.from_arrays([pa.array(keys[first]), pa.array(count)], names=["pair", "count"])

    return words.mapInArrow(run, "pair bigint, count bigint").groupBy("pair").agg(F.sum("count").alias("count"))


def hot_segments(words: DataFrame, hot: list[int]) -> DataFrame:
    """(segment BINARY, freq): the longest stretches of words whose adjacent pairs are all in ``hot``."""
    shared = words.sparkSession.sparkContext.broadcast(np.sort(np.array(hot, np.int64)))      # at most WINDOW pairs

    def run(batches):
        for batch in _joined(batches, WORD_BYTES):
            flat, offsets = _flat_words(batch.column("w"))
            keys, word = _pair_keys(flat, offsets)
            is_hot = np.append(_find(keys, shared.value) >= 0, False)
            before = np.append(False, is_hot[:-1])
            first, last = np.flatnonzero(is_hot & ~before), np.flatnonzero(before & ~is_hot)      # of a stretch: its symbols are first..last
            size = last - first + 1
            at = np.concatenate(([0], np.cumsum(size)))
            index = np.arange(at[-1]) + np.repeat(first - at[:-1], size)
            freq = batch.column("freq").to_numpy()[word[first]]
            yield pa.RecordBatch.from_arrays([_binary_words(flat[index], at), pa.array(freq)], names=["segment", "freq"])

    return words.mapInArrow(run, "segment binary, freq bigint").groupBy("segment").agg(F.sum("freq").alias("freq"))


def merge_symbols(flat: np.ndarray, offsets: np.ndarray, merges: list[tuple[int, int, int]]) -> tuple[np.ndarray, np.ndarray]:
    """The merges, one after the other, in every word; ids that come out are new (or the list has one merge).

    A word is done when it holds no pair of the list; until then each pass merges its earliest one.
    """
    keys = np.array([a * PAIR_BASE + b for a, b, _ in merges], np.int64)
    order = np.argsort(keys)
    table, made, never = keys[order], np.array([c for *_, c in merges], _SYMBOL), len(merges)
    sizes, ids = np.diff(offsets), np.arange(len(offsets) - 1)
    flat, ids, sizes = np.array(flat), ids[sizes > 0], sizes[sizes > 0]
    done: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    while len(ids):
        at = np.concatenate(([0], np.cumsum(sizes)))
        pairs, word = _pair_keys(flat, at)
        place = _find(pairs, table)
        rank = np.where(place >= 0, order[place], never)
        best = np.minimum.reduceat(rank, at[:-1])
        over = best == never
        if over.any():
            symbols = over[word]
            done.append((ids[over], sizes[over], flat[symbols]))
            flat, rank, word, best = flat[~symbols], rank[~symbols], (np.cumsum(~over) - 1)[word[~symbols]], best[~over]
            ids, sizes = ids[~over], sizes[~over]
            if not len(ids):
                break
        spot = np.flatnonzero(rank == best[word])
        run = np.cumsum(np.append(True, np.diff(spot) > 1)) - 1                    # a run of spots is a pair (a, a): every other one
        spot = spot[(spot - spot[np.searchsorted(run, np.arange(run[-1] + 1))][run]) % 2 == 0]
        flat[spot] = made[rank[spot]]
        keep = np.ones(len(flat), bool)
        keep[spot + 1] = False
        sizes = sizes - np.bincount(word[spot], minlength=len(ids))
        flat = flat[keep]
    length = np.zeros(len(offsets) - 1, np.int64)
    for ids, sizes, _ in done:
        length[ids] = sizes
    at = np.concatenate(([0], np.cumsum(length)))
    out = np.zeros(at[-1], _SYMBOL)
    for ids, sizes, symbols in done:
        out[np.arange(len(symbols)) + np.repeat(at[ids] - np.cumsum(sizes) + sizes, sizes)] = symbols
    return out, at


def merged_words(words: DataFrame, merges: list[tuple[int, int, int]], reused: bool) -> DataFrame:
    """The words after a round's merges, without those of one symbol; a last merge that ``reused`` an id goes by itself."""
    steps = [merges[:-1], merges[-1:]] if reused and len(merges) > 1 else [merges]
    shared = words.sparkSession.sparkContext.broadcast(steps)                      # vocabulary-bounded

    def run(batches):
        for batch in _joined(batches, WORD_BYTES):
            flat, offsets = _flat_words(batch.column("w"))
            for step in shared.value:
                flat, offsets = merge_symbols(flat, offsets, step)
            out = pa.RecordBatch.from_arrays([_binary_words(flat, offsets), batch.column("freq")], names=["w", "freq"])
            yield out.filter(pa.array(np.diff(offsets) >= 2))

    return words.mapInArrow(run, "w binary, freq bigint")


# ----------------------------------------------------------------------------- T3 / T4

def pair_counts(words: DataFrame, min_frequency: int = MIN_FREQUENCY) -> DataFrame:
    """Sum of word frequency over adjacent symbol pairs (overlaps counted)."""
    s = F.col("symbols")
    n = F.size(s)
    # arrays_zip + explode stays out of lambda evaluation (faster than zip_with).
    z = F.arrays_zip(F.slice(s, 1, n - 1).alias("a"), F.slice(s, 2, n - 1).alias("b"))
    pairs = words.filter(n >= 2).select(F.explode(z).alias("z"), "freq")
    pc = (pairs.select((F.col("z.a").cast("long") * PAIR_BASE + F.col("z.b").cast("long")).alias("pair"), "freq")
          .groupBy("pair").agg(F.sum("freq").alias("count")))
    return pc.filter(F.col("count") >= min_frequency)


def with_pair_ids(pc: DataFrame) -> DataFrame:
    return pc.select(F.floor(F.col("pair") / PAIR_BASE).cast("int").alias("left_id"),
                     F.pmod(F.col("pair"), F.lit(PAIR_BASE)).cast("int").alias("right_id"), "count", "pair")


def top_pairs(pc: DataFrame, k: int) -> DataFrame:
    """T4: the k best pairs by (count desc, left asc, right asc) - a distributed top-k."""
    return pc.orderBy(F.col("count").desc(), F.col("pair").asc()).limit(k)


# ----------------------------------------------------------------------------- T5

@dataclass
class BpeModel:
    byte_ids: dict[int, int]                     # byte value -> id
    vocab: dict[int, bytes]                      # id -> token bytes (specials: their text)
    merges: list[tuple[int, int, int]] = field(default_factory=list)   # (left, right, new) by rank
    rounds: int = 0

    @property
    def size(self) -> int:
        return len(self.vocab)

    def merges_frame(self, spark: SparkSession) -> DataFrame:
        rows = [(i, a, b, c) for i, (a, b, c) in enumerate(self.merges)]
        return spark.createDataFrame(rows, "rank int, left_id int, right_id int, new_id int")

    def vocab_frame(self, spark: SparkSession) -> DataFrame:
        rows = [(i, b.hex().upper(), i < len(SPECIAL_TOKENS)) for i, b in sorted(self.vocab.items())]
        return spark.createDataFrame(rows, "id int, token_hex string, special boolean")

    def config(self, min_frequency: int) -> dict:
        # The keys of the tokenizer's configuration file.
        return {"vocab_size": self.size, "model": "BPE", "pre_tokenizer": "ByteLevel", "normalizer": "NFKC",
                "min_frequency": min_frequency, "special_tokens": SPECIAL_TOKENS}


def merge_segments(segments: list[tuple[list[int], int]], last: tuple[int, int, int], vocab: dict[int, bytes], known: dict[bytes, int],
                   vocab_size: int, min_frequency: int) -> tuple[list[tuple[int, int, int]], bool]:
    """Merges of (symbols, frequency) segments, best pair first, while it ranks up to ``last`` (-count, left, right).

    New tokens go into ``vocab`` and ``known``. Ends early where the vocabulary is full or a merge reuses
    an older token's id (the second result says so).
    """
    counts: dict[tuple[int, int], int] = {}
    where: dict[tuple[int, int], set[int]] = {}
    for i, (symbols, freq) in enumerate(segments):
        for pair in zip(symbols, symbols[1:]):
            counts[pair] = counts.get(pair, 0) + freq
            where.setdefault(pair, set()).add(i)
    heap = [(-n, *pair) for pair, n in counts.items()]
    heapq.heapify(heap)
    merges: list[tuple[int, int, int]] = []
    while heap and len(vocab) < vocab_size:
        entry = heapq.heappop(heap)
        pair, now = entry[1:], counts.get(entry[1:], 0)
        if now != -entry[0]:                       # the count has fallen since
            if now > 0:
                heapq.heappush(heap, (-now, *pair))
            continue
        if entry > last or now < min_frequency:
            break
        text = vocab[pair[0]] + vocab[pair[1]]
        reused = text in known
        new = known[text] if reused else len(vocab)
        vocab[new] = text
        known[text] = new
        merges.append((*pair, new))
        if reused:
            return merges, True
        fresh = set()
        for i in where.pop(pair):
            symbols, freq = segments[i]
            out, j = [], 0
            while j < len(symbols):
                if j + 1 < len(symbols) and symbols[j] == pair[0] and symbols[j + 1] == pair[1]:
                    out.append(new)
                    j += 2
                else:
                    out.append(symbols[j])
                    j += 1
            for old in zip(symbols, symbols[1:]):
                counts[old] -= freq
            for made in zip(out, out[1:]):
                counts[made] = counts.get(made, 0) + freq
                if new in made:
                    fresh.add(made)
                    where.setdefault(made, set()).add(i)
            segments[i] = (out, freq)
        del counts[pair]
        for made in fresh:
            heapq.heappush(heap, (-counts[made], *made))
    return merges, False


def train_bpe(spark: SparkSession, freq: DataFrame, vocab_size: int = VOCAB_SIZE, min_frequency: int = MIN_FREQUENCY,
              window: int = WINDOW, segment_symbols: int = SEGMENT_SYMBOLS, progress=None) -> BpeModel:
    """T5: learn merges until the vocabulary reaches ``vocab_size`` or no pair is frequent (see the module's text).

    ``freq`` should be materialised (it is read once for the alphabet and once for the words). The words after a round are a
    written table, so that lost executors repeat one round at most.
    ``progress(round, merges_so_far, vocab_size)`` is called after every round.
    """
    alpha = alphabet(freq).select("byte", "id").collect()            # <= 256 rows
    if not alpha:
        raise ValueError("the corpus is empty: there is nothing to learn a vocabulary from")
    byte_ids = {r["byte"]: r["id"] for r in alpha}
    vocab: dict[int, bytes] = {i: t.encode() for i, t in enumerate(SPECIAL_TOKENS)}
    for b, i in byte_ids.items():
        vocab[i] = bytes([b])
    known = {v: k for k, v in vocab.items() if k >= len(SPECIAL_TOKENS)}
    model = BpeModel(byte_ids, vocab)
    words = materialize(symbol_words(freq, byte_ids), "words")
    width = window
    while len(vocab) < vocab_size:
        counts = symbol_pair_counts(words).filter(F.col("count") >= min_frequency)
        hot = [(-r["count"], *divmod(r["pair"], PAIR_BASE)) for r in top_pairs(counts, width).collect()]      # at most ``window`` rows
        if not hot:
            break
        while True:
            segments = materialize(hot_segments(words, [a * PAIR_BASE + b for _, a, b in hot]), "segments")
            size = segments.agg(F.sum(F.octet_length("segment"))).first()[0] // _SYMBOL.itemsize
            if size <= segment_symbols or len(hot) == 1:
                break
            drop_tables(spark, segments)
            hot = hot[:max(1, min(len(hot) // 2, int(len(hot) * segment_symbols / size)))]
        rows = [(np.frombuffer(r["segment"], _SYMBOL).tolist(), r["freq"]) for r in segments.collect()]
        merges, reused = merge_segments(rows, hot[-1], vocab, known, vocab_size, min_frequency)
        model.merges += merges
        after = materialize(merged_words(words, merges, reused), "words")
        drop_tables(spark, words, segments)
        words = after
        width = min(window, 2 * len(hot))
        model.rounds += 1
        if progress is not None:
            progress(model.rounds, len(model.merges), len(vocab))
    drop_tables(spark, words)
    return model


# ----------------------------------------------------------------------------- T6 / encode

def encode_word(ids: list[int], ranks: dict[tuple[int, int], tuple[int, int]]) -> list[int]:
    """Apply merges by rank: the lowest-rank adjacent pair first, leftmost of equals.

    Symbols form a linked list and candidate pairs a heap, so a run of n symbols without a space
    costs n log n. A heap entry is stale if its pair is not what stands at its place any more.
    """
    n = len(ids)
    ids = list(ids)
    after, before = list(range(1, n + 1)), list(range(-1, n - 1))
    heap = [(ranks[p][0], i, p) for i, p in enumerate(zip(ids, ids[1:])) if p in ranks]
    heapq.heapify(heap)
    gone = [False] * n
    while heap:
        _, i, pair = heapq.heappop(heap)
        j = after[i] if i < n and not gone[i] else n
        if j >= n or (ids[i], ids[j]) != pair:
            continue
        ids[i] = ranks[pair][1]
        gone[j] = True
        after[i] = after[j]
        if after[j] < n:
            before[after[j]] = i
        for a, b in ((before[i], i), (i, after[i])):
            if a >= 0 and b < n and (ids[a], ids[b]) in ranks:
                heapq.heappush(heap, (ranks[ids[a], ids[b]][0], a, (ids[a], ids[b])))
    return [x for x, dead in zip(ids, gone) if not dead]


_WORKER_CACHE: dict = {}
CACHE_ENTRIES = 200_000         # per Python worker (memory bound, not a data cap)
CACHE_LENGTH = 64               # longer pre-tokens are encoded each time


class PretokenCache:
    """Ids of pre-tokens as 32-bit bytes; of at most ``entries`` the ones in use stay."""

    def __init__(self, ranks: dict[tuple[int, int], tuple[int, int]], byte_ids: dict[int, int], entries: int = CACHE_ENTRIES):
        self.ranks, self.byte_ids, self.half = ranks, byte_ids, entries // 2
        self.recent: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    def _learn(self, pretoken: str) -> bytes:
        ids = self.older.get(pretoken)
        if ids is None:
            get = self.byte_ids.get
            ids = np.array(encode_word([get(b, UNK_ID) for b in pretoken.encode("utf-8")], self.ranks), _SYMBOL).tobytes()
        if len(pretoken) <= CACHE_LENGTH:
            if len(self.recent) >= self.half:
                self.older, self.recent = self.recent, {}
            self.recent[pretoken] = ids
        return ids

    def line(self, pretokens) -> np.ndarray:
        known = self.recent.get
        out = []
        for p in pretokens:
            ids = known(p)
            if ids is None:
                ids = self._learn(p)
                known = self.recent.get
            out.append(ids)
        return np.frombuffer(b"".join(out), _SYMBOL)


def line_encoder_udf(spark: SparkSession, model: BpeModel):
    """Arrow UDF: array of a line's pre-tokens -> the line's ids, with a per-worker cache.

    Narrow (no shuffle): frequent pre-tokens are cache hits, so a hot word is no skew.
    The merge table is broadcast once (vocabulary-bounded).
    """
    import uuid
    ranks = {(a, b): (k, c) for k, (a, b, c) in enumerate(model.merges)}
    bc = spark.sparkContext.broadcast((ranks, model.byte_ids))
    key = uuid.uuid4().hex            # one cache per model per worker

    @F.pandas_udf(Ty.ArrayType(Ty.IntegerType()))
    def encode_lines(s: pd.Series) -> pd.Series:
        if key not in _WORKER_CACHE:              # one model at a time: older caches go
            _WORKER_CACHE.clear()
            _WORKER_CACHE[key] = PretokenCache(*bc.value)
        line = _WORKER_CACHE[key].line
        return pd.Series([line(pretokens) for pretokens in s], dtype=object)

    return encode_lines


def encode_distinct(spark: SparkSession, pretoken_table: DataFrame, model: BpeModel) -> DataFrame:
    """Ids for each distinct pre-token."""
    enc = line_encoder_udf(spark, model)
    return pretoken_table.select("pretoken").distinct().select("pretoken", enc(F.array("pretoken")).alias("ids"))


def save_artifacts(spark: SparkSession, model: BpeModel, path: str, min_frequency: int = MIN_FREQUENCY) -> None:
    """Vocab, merges and a one-row config table."""
    model.vocab_frame(spark).write.mode("overwrite").parquet(f"{path}/vocab")
    model.merges_frame(spark).write.mode("overwrite").parquet(f"{path}/merges")
    spark.createDataFrame([(json.dumps(model.config(min_frequency)),)], "config string") \
        .write.mode("overwrite").json(f"{path}/config")


def load_artifacts(spark: SparkSession, path: str) -> BpeModel:
    """Read a saved model back (both tables are vocabulary-bounded)."""
    vocab = {r["id"]: bytes.fromhex(r["token_hex"]) for r in spark.read.parquet(f"{path}/vocab").collect()}
    merges = [(r["left_id"], r["right_id"], r["new_id"])
              for r in spark.read.parquet(f"{path}/merges").orderBy("rank").collect()]
    byte_ids = {v[0]: k for k, v in vocab.items() if k >= len(SPECIAL_TOKENS) and len(v) == 1}
    return BpeModel(byte_ids, vocab, merges)
