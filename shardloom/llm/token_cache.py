"""Library tokenization of whole texts with a cache of space-separated parts.

A text is cut at single spaces and line feeds, and each distinct part is encoded once per worker by
the ``tokenizers`` library; the text's ids are the parts' ids in order. That equals encoding the text
at once as long as no pre-token of the tokenizer can span the cut:

* tokenizers that drop white space before the merges never join parts;
* byte-level tokenizers put a space in front of the word that follows, so the parts after the first
  are encoded with their space, and a line feed opens a part. Only runs of several white-space
  characters could be split differently; texts that have any go to the library whole.

Punctuation after a word of letters is a pre-token of its own in these tokenizers, so the cache holds the
word only. Splitting, finding the distinct parts and words and putting ids together are column operations
(Arrow, numpy).
"""

from __future__ import annotations

import json
import os
import string
import sys
from array import array
from collections.abc import Callable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from shardloom.llm import common as C

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")

#: Words and other parts kept per worker and half of the cache (about 180 bytes each); results do not depend on it.
CACHE_PARTS = 400_000

#: Marks the first part of a text, which has no space before it.
FIRST = "\x01"
HEADS = (FIRST, "\n")  # what may open a part that has no space before it
#: Texts that a byte-level tokenizer gets whole: runs of white space, white space other than space and
#: line feed (fixed values), the mark itself, and what may open a special token (which ends a text's run).
WHOLE = ("  | \n|\n |\n\n\n|\n\n\\z|\x01|<\\||[\t\x0b\x0c\r\x1c-\x1f\u0085\u00a0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]")
LATIN_END = "\xff"  # beyond Latin-1, lower case can add marks that join the punctuation
#: Letters of which words consist that are parted from the punctuation after them.
LETTERS = "".join(c for c in map(chr, range(256)) if c.isalpha())

if sys.byteorder != "little":
    raise ImportError("ids are kept as little-endian bytes")


def tokenizer_file(name: str) -> str:
    """Path of a public vocabulary file on this machine (the package is installed on every worker)."""
    import public_tokenizers
    return public_tokenizers.path(name)


#: Words of letters that go to the library as one text.
WORDS_AT_ONCE = 500
SPACE_LETTER, LINE_LETTER = "\u0120", "\u010a"  # what byte-level vocabularies write for a space and a line feed


def assemble(texts: pa.Array, lookup: Callable[[list[str]], list[bytes]], width: int) -> tuple[np.ndarray, np.ndarray]:
    """Ids (``width`` bytes each) of all texts in a row and the texts' offsets; ``lookup`` knows the distinct parts."""
    return assemble_columns(texts, lambda parts: listed(parts, lookup), width)


def listed(parts: pa.Array, lookup: Callable[[list[str]], list[bytes]]) -> pa.Array:
    """The column of what ``lookup`` gives for a column of strings."""
    return pa.array(lookup(parts.to_numpy(zero_copy_only=False).tolist()), pa.binary())


def assemble_columns(texts: pa.Array, lookup: Callable[[pa.Array], pa.Array], width: int) -> tuple[np.ndarray, np.ndarray]:
    """``assemble`` with a ``lookup`` from a column of distinct parts to the column of their ids."""
    parts = pc.split_pattern(texts, " ")
    coded = pc.dictionary_encode(parts.flatten())
    # Taking binary values puts the parts' ids one after the other in one buffer.
    taken = lookup(coded.dictionary).take(coded.indices)
    data, offsets = C.text_view(taken)
    return data.view(f"<u{width}"), offsets[parts.offsets.to_numpy() - parts.offsets[0].as_py()] // width


class PartEncoder:
    """Ids of texts as little-endian unsigned 16-bit bytes (vocabularies of up to 65,536 ids)."""

    def __init__(self, path: str, parts: int | None = None):
        from tokenizers import Tokenizer
        self.library = Tokenizer.from_file(path)
        self.library.no_truncation()
        self.library.no_padding()
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        pre, vocab, suffix = spec["pre_tokenizer"], spec["model"]["vocab"], spec["model"].get("end_of_word_suffix") or ""
        steps = pre.get("pretokenizers", [pre])
        self.keeps_space = steps[0]["type"] == "ByteLevel"
        if self.library.get_vocab_size(with_added_tokens=True) > 1 << 16:
            raise ValueError("ids over 16 bits")
        self.lowers = any(n["type"] == "Lowercase" for n in (spec["normalizer"] or {}).get("normalizers", []))
        opens = {" ": SPACE_LETTER, "\n": LINE_LETTER}
        #: By what is put before a word: the ids that open it (byte-level vocabularies) or close it.
        self.marked = {o: np.zeros(1 << 16, bool) for o in (opens if self.keeps_space else [""])}
        for o, marked in self.marked.items():
            marked[[i for t, i in vocab.items() if (t.startswith(opens[o]) if self.keeps_space else t.endswith(suffix))]] = True
        self.space = " " if self.keeps_space else ""
        self.parts = parts
        self.known: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        self.word_letters = LETTERS + (FIRST + "\n" if self.keeps_space else "")

    def _library(self, texts: list[str]) -> list[bytes]:
        return [array("H", e.ids).tobytes() for e in self.library.encode_batch_fast(texts, add_special_tokens=False)]

    def _library_words(self, words: list[str], opener: str) -> list[bytes]:
        """Ids of words of letters only, each with ``opener`` before it, many in one text: a token's mark shows where a word ends (or starts)."""
        runs = [words[i:i + WORDS_AT_ONCE] for i in range(0, len(words), WORDS_AT_ONCE)]
        out: list[bytes] = []
        for run, e in zip(runs, self.library.encode_batch_fast([opener + (opener or " ").join(r) for r in runs], add_special_tokens=False)):
            ids = np.array(e.ids, "<u2")
            marks = np.flatnonzero(self.marked[opener][ids])
            cuts = np.append(marks, len(ids)) if self.keeps_space else np.append(0, marks + 1)
            if len(cuts) != len(run) + 1:
                raise AssertionError("a word without its mark")
            body, at = ids.tobytes(), (2 * cuts).tolist()
            out += [body[a:b] for a, b in zip(at, at[1:])]
        return out

    def _learn(self, parts: list[str]) -> list[bytes]:
        """Ids of parts that are not known."""
        plain, lines, others = [], [], []
        for i, p in enumerate(parts):
            head = self.keeps_space and p[:1] in HEADS
            word = p[1:] if head else p
            if word.isalpha() and (word.isascii() or max(word) <= LATIN_END):
                (lines if head else plain).append(i)
            else:
                others.append(i)
        out = [b""] * len(parts)
        for i, ids in zip(plain, self._library_words([parts[i] for i in plain], self.space)):
            out[i] = ids
        for i, ids in zip(lines, self._library_words([parts[i][1:] for i in lines], "\n")):
            out[i] = ids[2:] if parts[i][0] == FIRST else ids
        texts = [parts[i] if not self.keeps_space or parts[i][:1] == "\n" else parts[i][1:] if parts[i][:1] == FIRST else " " + parts[i] for i in others]
        for i, ids in zip(others, self._library(texts)):
            out[i] = ids
        return out

    def lookup(self, parts: list[str]) -> list[bytes]:
        """Ids of distinct words and other parts, from the cache or the library."""
        if len(self.known) > (self.parts or CACHE_PARTS):  # what is still in use moves over from the older half
            self.older, self.known = self.known, {}
        got = list(map(self.known.get, parts))
        open_ = [i for i, ids in enumerate(got) if ids is None]
        missing = [parts[i] for i in open_]
        moved = list(map(self.older.get, missing))
        new = [i for i, ids in enumerate(moved) if ids is None]
        for i, ids in zip(new, self._learn([missing[i] for i in new])):
            moved[i] = ids
        self.known.update(zip(missing, moved))
        for i, ids in zip(open_, moved):
            got[i] = ids
        return got

    def part_ids(self, parts: pa.Array) -> pa.Array:
        """Ids of distinct parts: a word's from the cache, with those of the punctuation after it, if there is any."""
        words, tails, size = pc.utf8_rtrim(parts, string.punctuation), pc.utf8_ltrim(parts, self.word_letters), pc.binary_length
        parted = pc.and_(pc.equal(pc.add(size(words), size(tails)), size(parts)), pc.greater(size(words), 0))
        words = pc.dictionary_encode(pc.if_else(parted, words, parts))
        tails = pc.dictionary_encode(pc.if_else(parted, tails, ""))
        return pc.binary_join_element_wise(listed(words.dictionary, self.lookup).take(words.indices),
                                           listed(tails.dictionary, self._library).take(tails.indices), b"")

    def encode_column(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids (unsigned 16-bit) of all texts in a row and the texts' offsets; callers pass slices of a few MB."""
        texts = pc.fill_null(texts, "")
        if not self.keeps_space:
            if self.lowers:  # letters of ASCII first: fewer distinct parts, same result (but for special tokens)
                texts = pc.if_else(pc.match_substring(texts, "<|"), texts, pc.ascii_lower(texts))
            return assemble_columns(pc.replace_substring(texts, "\n", " "), self.part_ids, 2)
        whole = pc.match_substring_regex(texts, WHOLE)
        marked = pc.binary_join_element_wise(FIRST, pc.replace_substring(pc.if_else(whole, "", texts), "\n", " \n"), "")
        ids, offsets = assemble_columns(marked, self.part_ids, 2)
        rows = np.flatnonzero(whole.to_numpy(zero_copy_only=False))
        if len(rows):
            own = self._library(texts.take(pa.array(rows)).to_pylist())
            split = [ids[a:b] for a, b in zip(offsets, offsets[1:])]
            for i, x in zip(rows, own):
                split[i] = np.frombuffer(x, "<u2")
            ids, offsets = np.concatenate(split), np.concatenate(([0], np.cumsum([len(x) for x in split])))
        return ids, offsets

    def encode_rows(self, texts: pa.Array, end_id: int) -> tuple[np.ndarray, np.ndarray]:
        """``encode_column`` with an end id after each text."""
        ids, offsets = self.encode_column(texts)
        return np.insert(ids, offsets[1:], end_id), offsets + np.arange(len(offsets))

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of every text as bytes."""
        ids, offsets = self.encode_column(pa.array(texts, pa.string()))
        return [ids[a:b].tobytes() for a, b in zip(offsets, offsets[1:])]


def encoder(path: str, parts: int | None = None) -> PartEncoder:
    """The worker's encoder for a vocabulary file."""
    return C.worker_state(f"parts:{path}", lambda: PartEncoder(path, parts))
