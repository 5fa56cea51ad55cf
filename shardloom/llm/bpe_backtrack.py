"""Exact BPE encoding by longest matches and backtracking, and decoding by an offset table.

A segmentation into tokens is the one that merging would give if and only if each token encodes to
itself and each adjacent pair is compatible (merging the pair's text gives the pair back). So no
merge is carried out on the text:

* an Aho-Corasick automaton over all self-encoding tokens gives the longest match at every place;
* each token is checked against the one before in a pair table (filled as pairs turn up); if they
  are not compatible the next shorter token that starts here is tried (the longest that is a prefix of the
  one refused, known for every token), and without one the token before is given up in turn. A place that was reached once and given up is not tried again, so the
  work stays linear in the text.

Two tokens stay apart if no token on the right edge of the first is ever merged with one on the
left edge of the second before both have been absorbed into their parents; ranks decide the order.

Decoding looks every id up in one byte table through its offset. The tokenizer file's normalizer
and pre-tokenizer decide what is a word; words of printable ASCII and Latin-1 go through an equal
pattern here, all others through the library's own two steps.

Defined results: null is an empty text; an empty text has no ids and decodes to an empty text;
special tokens' strings in a text give their ids, as in the library.
"""

from __future__ import annotations

import hashlib
import json
import os
from array import array

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")

import ahocorasick  # noqa: E402
import numpy as np  # noqa: E402
import pyarrow as pa  # noqa: E402
import pyarrow.compute as pc  # noqa: E402
import regex  # noqa: E402
from pyspark.sql import DataFrame  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from shardloom.llm import common as C  # noqa: E402
from shardloom.llm.token_cache import assemble  # noqa: E402

#: Entries kept per worker; tables are emptied beyond that, results do not change.
WORDS, PARTS, PAIRS = 250_000, 300_000, 500_000
END = "\0"  # marks the end of a word inside token forms; no byte maps to it
NEVER = 1 << 62


def byte_letters() -> list[str]:
    """The letter that byte-level vocabularies write for each byte: itself if it prints, else the next one from 256 on."""
    prints = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    out, extra = [], 256
    for b in range(256):
        out.append(chr(b if b in prints else extra))
        extra += b not in prints
    return out


class Merges:
    """Tokens of a vocabulary file by form, with the merge that makes each."""

    def __init__(self, vocab: dict[str, int], merges: list, suffix: str):
        self.rank: dict[tuple[int, int], tuple[int, int]] = {}  # pair -> (rank, merged id)
        self.made: dict[int, tuple[int, int, int]] = {}  # id -> (rank, left, right)
        form: dict[int, str] = {}
        for letter in byte_letters():
            form[vocab[letter]] = letter
            if suffix:
                form[vocab[letter + suffix]] = letter + END
        for rank, pair in enumerate(merges):
            a, b = pair if isinstance(pair, (list, tuple)) else pair.split(" ")
            left, right, out = vocab[a], vocab[b], vocab[a + b]
            self.rank[left, right] = (rank, out)
            if out not in self.made:
                self.made[out] = (rank, left, right)
                form[out] = form[left] + form[right]
        self.form = form
        self.ids = {f: t for t, f in form.items()}
        self.ends = bool(suffix)

    def symbols(self, word: str) -> list[int]:
        if self.ends and word.endswith(END):
            return [self.ids[c] for c in word[:-2]] + [self.ids[word[-2:]]]
        return [self.ids[c] for c in word]

    def merge(self, word: str) -> list[int]:
        """Plain merging, lowest rank first and leftmost of equals (for tables and tests)."""
        out = self.symbols(word)
        while len(out) > 1:
            best = min(((self.rank[p][0], i) for i, p in enumerate(zip(out, out[1:])) if p in self.rank), default=None)
            if best is None:
                break
            i = best[1]
            out[i:i + 2] = [self.rank[out[i], out[i + 1]][1]]
        return out

    def edge(self, token: int, right: bool) -> list[tuple[int, int]]:
        """Tokens on one edge of a token, smallest first, each with the rank at which its parent absorbs it."""
        chain, above = [], NEVER
        while True:
            chain.append((token, above))
            if token not in self.made:
                return chain[::-1]
            above, left, last = self.made[token]
            token = last if right else left

    def apart(self, first: int, second: int) -> bool:
        """Whether ``first`` and ``second`` side by side stay two tokens."""
        ours, theirs = self.edge(first, True), self.edge(second, False)
        i = j = 0
        while True:
            (a, up_a), (b, up_b) = ours[i], theirs[j]
            cross = self.rank.get((a, b), (NEVER, 0))[0]
            if cross < up_a and cross <= up_b:
                return False
            if up_a == up_b == NEVER:
                return True
            # Of equal ranks the one further left is merged first: the absorption of a.
            if up_a <= up_b:
                i += 1
            else:
                j += 1


class Backtracker:
    """Encoder and decoder of one tokenizer file."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        self.library = Tokenizer.from_file(path)
        model = spec["model"]
        suffix = model.get("end_of_word_suffix") or ""
        self.table = Merges(model["vocab"], model["merges"], suffix)
        self.automaton = ahocorasick.Automaton()
        self.usable: dict[str, int] = {}
        for token, form in self.table.form.items():
            if len(self.table.symbols(form)) == 1 or self.table.merge(form) == [token]:
                self.usable[form] = token
                self.automaton.add_word(form, token)
        self.automaton.make_automaton()
        #: Tokens that a word may end with: all, or those with the end mark.
        self.last = {t for f, t in self.usable.items() if not self.table.ends or f.endswith(END)}
        self.size = {t: len(f) for f, t in self.usable.items()}
        #: Longest usable token that opens each place of the trie, and the longest one that is a proper prefix of each token.
        self.opens: dict[str, int | None] = {"": None}
        for form in sorted(self.usable):
            for n in range(1, len(form) + 1):
                head = form[:n]
                if head not in self.opens:
                    self.opens[head] = self.usable.get(head, self.opens[head[:-1]])
        self.shorter = {t: self.opens[f[:-1]] for f, t in self.usable.items()}
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.special_pattern = regex.compile("(" + "|".join(map(regex.escape, self.special)) + ")") if self.special else None
        letters = byte_letters()
        self.to_letters = {b: letters[b] for b in range(256)}
        # Equal to the file's normalizer (lower case) and split pattern on printable ASCII and Latin-1.
        self.simple = regex.compile(r"[\x21-\x7e\xa1-\xac\xae-\xff]*")
        self.words_of = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+")
        self.word_cache: dict[str, bytes] = {}
        self.part_cache: dict[str, bytes] = {}
        self.pair_cache: dict[tuple[int, int], bool] = {}
        size = 1 + max([*model["vocab"].values(), *self.special.values()])
        strings = [b""] * size
        for text, token in [*model["vocab"].items(), *self.special.items()]:
            strings[token] = text.encode() + b" "
        self.bytes = np.frombuffer(b"".join(strings), np.uint8)
        self.length = np.array([len(s) for s in strings], np.int64)
        self.offset = np.cumsum(self.length) - self.length

    # -- encoding ---------------------------------------------------------

    def _fits(self, first: int, second: int) -> bool:
        key = (first, second)
        known = self.pair_cache.get(key)
        if known is None:
            if len(self.pair_cache) >= PAIRS:
                self.pair_cache.clear()
            known = self.pair_cache[key] = self.table.apart(first, second)
        return known

    def word(self, word: str) -> list[int]:
        """Ids of one word in byte letters (with its end mark)."""
        path = [t for _, t in self.automaton.iter_long(word)]
        known = self.pair_cache.get
        for i, pair in enumerate(zip(path, path[1:]), 1):
            fits = known(pair)
            if fits is None:
                fits = self._fits(*pair)
            if not fits:
                return self._backtrack(word, path[:i], self.shorter[path[i]])
        if not path or path[-1] not in self.last:
            return self._backtrack(word, path, None)
        return path

    def _backtrack(self, word: str, path: list[int], token: int | None) -> list[int]:
        """Ids of a word of which ``path`` is the start by longest matches and ``token`` the next one to try."""
        size, shorter, opens, reach = self.size, self.shorter, self.opens, self.automaton.longest_prefix
        known, end = self.pair_cache.get, len(word)
        given_up = bytearray(end + 1)
        start = sum([size[t] for t in path])
        while start < end:
            before = path[-1] if path else None
            while token is not None:
                if not given_up[start + size[token]]:
                    if before is None:
                        break
                    fits = known((before, token))
                    if fits is None:
                        fits = self._fits(before, token)
                    if fits:
                        break
                token = shorter[token]
            if token is None:
                given_up[start] = 1
                token = path.pop()
                start -= size[token]
                token = shorter[token]
            else:
                path.append(token)
                start += size[token]
                if start < end:
                    tail = word[start:]
                    token = opens[tail[:reach(tail)]]
        return path

    def _words(self, part: str) -> list[str]:
        plain = part.isascii() and part.isprintable()
        if plain or self.simple.fullmatch(part):
            part = part.lower()
            if plain and part[:-1].isalpha():  # most parts: a word, or a word and a punctuation mark
                if part[-1].isalpha():
                    return [part]
                if part[-1] in ".,;:!?":
                    return [part[:-1], part[-1]]
            return self.words_of.findall(part)
        normal = self.library.normalizer.normalize_str(part) if self.library.normalizer else part
        return [bytes(_LETTER_BYTES[c] for c in w).decode("utf-8", "surrogateescape") for w, _ in self.library.pre_tokenizer.pre_tokenize_str(normal)]

    def _word_ids(self, w: str) -> bytes:
        raw = w if w.isascii() and w.isprintable() else w.encode("utf-8", "surrogateescape").decode("latin-1").translate(self.to_letters)
        if len(self.word_cache) >= WORDS:
            self.word_cache.clear()
        ids = self.word_cache[w] = array("I", self.word(raw + END if self.table.ends else raw)).tobytes()
        return ids

    def part(self, part: str) -> bytes:
        """Ids of a text without plain spaces, little-endian unsigned 32-bit."""
        known = self.word_cache.get
        if self.special and "<|" in part:
            pieces = self.special_pattern.split(part)
            return b"".join(np.array([self.special[x]], "<u4").tobytes() if x in self.special else
                            b"".join([known(w) or self._word_ids(w) for w in self._words(x)]) for x in pieces)
        return b"".join([known(w) or self._word_ids(w) for w in self._words(part)])

    def lookup(self, parts: list[str]) -> list[bytes]:
        """Ids of distinct parts."""
        if len(self.part_cache) > PARTS:
            self.part_cache = {}
        cache, encode = self.part_cache, self.part
        for p in parts:
            if p not in cache:
                cache[p] = encode(p)
        return [cache[p] for p in parts]

    def encode_column(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts in a row and the texts' offsets; white space parts words in these tokenizers, so parts are independent."""
        return assemble(pc.replace_substring(pc.fill_null(texts, ""), "\n", " "), self.lookup, 4)

    # -- decoding ---------------------------------------------------------

    def decode_column(self, ids: np.ndarray, offsets: np.ndarray) -> tuple[bytes, list[int], list[int]]:
        """UTF-8 bytes of texts (tokens' strings, one space between them): all bytes, and where each text starts and ends."""
        size = self.length[ids]
        ends = np.concatenate(([0], np.cumsum(size)))
        place = np.repeat(self.offset[ids] - ends[:-1], size)
        place += np.arange(len(place))
        edge = ends[offsets]
        return self.bytes[place].tobytes(), edge[:-1].tolist(), np.maximum(edge[1:] - 1, edge[:-1]).tolist()

    def decode(self, ids: bytes) -> bytes:
        """UTF-8 text of one text's ids."""
        at = np.frombuffer(ids, "<u4")
        body, start, end = self.decode_column(at, np.array([0, len(at)]))
        return body[start[0]:end[0]]

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of every text, little-endian unsigned 32-bit."""
        ids, offsets = self.encode_column(pa.array(texts, pa.string()))
        return [ids[a:b].tobytes() for a, b in zip(offsets, offsets[1:])]


_LETTER_BYTES = {c: b for b, c in enumerate(byte_letters())}
def backtracker(path: str) -> Backtracker:
    return C.worker_state(f"bpe:{path}", lambda: Backtracker(path))


def _rows(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))


def encode_documents(docs: DataFrame, path: str) -> DataFrame:
    """(doc_id, ids): ids as little-endian unsigned 32-bit bytes."""
    def run(batches):
        tool = backtracker(path)
        for batch in batches:
            for part, _, _ in C.byte_slices(batch, "text"):
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), C.binary_rows(*tool.encode_column(part.column("text")))], names=["doc_id", "ids"])
    return _rows(docs).mapInArrow(run, "doc_id bigint, ids binary")


def decode_documents(encoded: DataFrame, path: str) -> DataFrame:
    """(doc_id, text) of (doc_id, ids)."""
    def run(batches):
        tool = backtracker(path)
        for batch in batches:
            text = [tool.decode(x or b"").decode() for x in batch.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(text, pa.string())], names=["doc_id", "text"])
    return encoded.select("doc_id", "ids").mapInArrow(run, "doc_id bigint, text string")


def round_trip_digests(docs: DataFrame, path: str) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256): encoding and decoding in one pass, digests instead of the long columns."""
    def run(batches):
        tool = backtracker(path)
        for batch in batches:
            for part, _, _ in C.byte_slices(batch, "text"):
                ids, offsets = tool.encode_column(part.column("text"))
                text, start, end = tool.decode_column(ids, offsets)
                text, body, at = memoryview(text), memoryview(ids.tobytes()), (4 * offsets).tolist()
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array(np.diff(offsets)), pa.array([hashlib.sha256(body[a:b]).hexdigest() for a, b in zip(at, at[1:])]),
                     pa.array([hashlib.sha256(text[a:b]).hexdigest() for a, b in zip(start, end)])], names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])
    return _rows(docs).mapInArrow(run, "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string")
