import random
import zlib

import numpy as np
import pytest

from shardloom.llm import bpe_backtrack, harmonic_pack, rans, token_cache
from shardloom.llm.queries import BYTE_VOCAB, WORD_VOCAB
from shardloom.llm.token_cache import tokenizer_file

BITS = ["a", "b", "The", "thn", " ", " ", "  ", "\n", " \n", ".", ",", "!", "'s", "'t", "1", "23", "é", "Σ", "İ", "\t", "\r\n", "\xa0", "　", "́",
        "<|endoftext|>", "<|startoftext|>", "...", "##", "\x1c", "\x85", "😀", "ﬁ", "中", "\x00", "</w>", "it's", "aaaaaaa"]


def texts(n, seed=3):
    rng = random.Random(seed)
    return ["", "x", " ", *("".join(rng.choice(BITS) for _ in range(rng.randint(0, 30))) for _ in range(n)),
            *("".join(rng.choice("abeinorst") for _ in range(rng.randint(1, 40))) for _ in range(n))]


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer
    out = {}
    for name in (WORD_VOCAB, BYTE_VOCAB):
        out[name] = Tokenizer.from_file(tokenizer_file(name))
        out[name].no_truncation()
        out[name].no_padding()
    return out


@pytest.mark.parametrize("name", [WORD_VOCAB, BYTE_VOCAB])
def test_part_cache_equals_library(library, name, monkeypatch):
    monkeypatch.setattr(token_cache, "CACHE_PARTS", 50)
    own, some = token_cache.PartEncoder(tokenizer_file(name)), texts(3000)
    got = [x for i in range(0, len(some), 100) for x in own.encode(some[i:i + 100])]
    assert [np.frombuffer(x, "<u2").tolist() for x in got] == [e.ids for e in library[name].encode_batch(some, add_special_tokens=False)]


@pytest.mark.parametrize("name", [WORD_VOCAB, BYTE_VOCAB])
def test_cache_holds_words_without_their_punctuation(library, name):
    own, tails = token_cache.PartEncoder(tokenizer_file(name)), ["", ".", ",", "***", "?!", "'", ").", "_", "\"]", "%%%", "<"]
    for word in ("merged", "größe", "élan"):
        some = [f"a {word}{t}" for t in tails] + [f"{word}{t} b\n{word}{t}" for t in tails]
        assert [np.frombuffer(x, "<u2").tolist() for x in own.encode(some)] == [e.ids for e in library[name].encode_batch(some, add_special_tokens=False)]
        assert len([p for p in own.known if word in p]) <= 3          # after a space, opening a line, opening a text


def test_odd_parts_equal_library(library):
    rng = random.Random(8)
    bits = ["ab", "É", "µ", "ß", "×", "÷", "ª", "Ω", "中", "\u0301", "1", "²", "'", "s", ".", "-", "_", "“", "…", "€", "\n", " ", "\x01", "\x00"]
    some = ["".join(rng.choice(bits) for _ in range(rng.randint(1, 9))) for _ in range(20000)]
    for name in (WORD_VOCAB, BYTE_VOCAB):
        got = token_cache.PartEncoder(tokenizer_file(name)).encode(some)
        assert [np.frombuffer(x, "<u2").tolist() for x in got] == [e.ids for e in library[name].encode_batch(some, add_special_tokens=False)]


def test_backtracking_equals_library(library, monkeypatch):
    for limit in ("WORDS", "PARTS", "PAIRS"):
        monkeypatch.setattr(bpe_backtrack, limit, 200)
    own, some = bpe_backtrack.Backtracker(tokenizer_file(WORD_VOCAB)), texts(4000, 6)
    got = [x for i in range(0, len(some), 100) for x in own.encode(some[i:i + 100])]
    for text, ids, e in zip(some, got, library[WORD_VOCAB].encode_batch(some, add_special_tokens=False)):
        assert np.frombuffer(ids, "<u4").tolist() == e.ids, repr(text)
        assert own.decode(ids).decode() == library[WORD_VOCAB].decode(e.ids, skip_special_tokens=False)


def test_refused_tokens_have_their_next_shorter_one():
    own = bpe_backtrack.Backtracker(tokenizer_file(WORD_VOCAB))
    for form, token in list(own.usable.items())[::97]:
        heads = [own.usable[form[:n]] for n in range(len(form) - 1, 0, -1) if form[:n] in own.usable]
        assert own.shorter[token] == (heads[0] if heads else None)
        assert own.opens[form] == token and own.opens[form[:-1]] == own.shorter[token]


def test_backtracking_equals_plain_merging():
    """A vocabulary in which longest matches are often wrong."""
    letters = bpe_backtrack.byte_letters()
    rng = random.Random(0)
    for _ in range(30):
        vocab = {c: i for i, c in enumerate(letters)}
        merges, made = [], list("abc")
        while len(merges) < 25:
            a, b = rng.choice(made), rng.choice(made)
            if a + b not in vocab:
                vocab[a + b] = len(vocab)
                merges.append([a, b])
                made.append(a + b)
        table = bpe_backtrack.Merges(vocab, merges, "")
        for _ in range(60):
            word = "".join(rng.choice("abc") for _ in range(rng.randint(1, 14)))
            out = table.merge(word)
            assert all(table.apart(x, y) for x, y in zip(out, out[1:])), (merges, word)


def test_rans_round_trip_checkpoints_and_damage():
    rng = np.random.default_rng(1)
    for n in (1, 7, rans.LANES, rans.LANES + 1, rans.LANES * (2 * rans.CHECKPOINT) + 5):
        ids = (rng.zipf(1.4, n) % 40000).astype("<u2")
        table = rans.table_of(rans.quantise(np.bincount(ids, minlength=49409)))
        payload, marks = rans.encode_block(ids, table)
        assert (rans.decode_block(payload, marks, n, table) == ids).all()
    part = rans.decode_block(payload, marks, n, table, parts=range(1, 2))
    assert (part == ids[rans.LANES * rans.CHECKPOINT:2 * rans.LANES * rans.CHECKPOINT]).all()
    bad = bytearray(payload)
    bad[5] ^= 1
    with pytest.raises((ValueError, IndexError)):
        rans.decode_block(bytes(bad), marks, n, table)


def test_quantised_frequencies_sum_and_keep_rare_ids():
    for counts in ([1], [10**9, 1, 1, 0, 3], list(range(3000)), [1] * 50000):
        f = rans.quantise(np.array(counts))
        assert f.sum() == 1 << rans.SCALE_BITS and ((f > 0) == (np.array(counts) > 0)).all()


def rows_for(spark):
    some = [(i * 3 if i % 5 else None, t) for i, t in enumerate(texts(40, 2))] + [(9, None), (9, None), (9, "abc " * 3000)]
    return some, spark.createDataFrame(some, "doc_id bigint, text string").repartition(3)


def test_token_files(spark, library):
    some, docs = rows_for(spark)
    folder = rans.C.scratch_path(spark, "rans")
    rans.write_tokens(docs, tokenizer_file(WORD_VOCAB), folder, block_ids=100)
    got = sorted(rans.read_tokens(spark, folder).collect(), key=lambda r: r["start"])
    assert len(got) == len(some)
    assert [r["doc_id"] for r in got] == sorted((d for d, _ in some), key=lambda d: (d is not None, d or 0))
    at, seen = 0, []
    for r in got:
        assert r["start"] == at and r["n_tokens"] == len(r["ids"]) // 4
        at += r["n_tokens"]
        seen.append((str(r["doc_id"]), np.frombuffer(r["ids"], "<u4").tolist()))
    expected = [(str(d), library[WORD_VOCAB].encode(t or "", add_special_tokens=False).ids + [1]) for d, t in some]
    assert sorted(seen) == sorted(expected)
    assert spark.read.parquet(f"{folder}/blocks").count() > 3


def test_token_files_of_empty_table(spark):
    folder = rans.C.scratch_path(spark, "rans")
    rans.write_tokens(spark.createDataFrame([], "doc_id bigint, text string"), tokenizer_file(WORD_VOCAB), folder)
    assert rans.read_tokens(spark, folder).count() == 0


def test_packing(spark, library):
    some, docs = rows_for(spark)
    got = harmonic_pack.pack_documents(docs, tokenizer_file(BYTE_VOCAB)).collect()
    sequences = {}
    for r in got:
        assert len(r["ids"]) == 4 * r["length"]
        sequences.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    sizes = []
    for pieces in sequences.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        sizes.append(at)
    assert all(s <= 1024 and s & (s - 1) == 0 for s in sizes)
    assert sum(s < 1024 for s in sizes) <= 10 * 3
    # Every id once: documents put together again are the library's ids and the end id.
    whole = {}
    for r in sorted(got, key=lambda r: r["start"]):
        whole.setdefault((str(r["doc_id"]), r["doc_tokens"]), []).append(r)
    expected = {}
    for d, t in some:
        ids = library[BYTE_VOCAB].encode(t or "", add_special_tokens=False).ids + [0]
        expected.setdefault((str(d), len(ids)), []).append(ids)
    assert {k: sum(r["length"] for r in v) for k, v in whole.items()} == {k: sum(map(len, v)) for k, v in expected.items()}
    long = [r for r in got if r["doc_tokens"] > 2000]
    joined = b"".join(r["ids"] for r in sorted(long, key=lambda r: r["start"]))
    assert np.frombuffer(joined, "<u4").tolist() == next(v[0] for k, v in expected.items() if k[1] > 2000)
    digest = harmonic_pack.piece_digests(spark.createDataFrame(got)).collect()
    assert [r["ids_crc32"] for r in digest] == [zlib.crc32(r["ids"]) for r in got]


def test_packing_tokenizes_batches_together(monkeypatch):
    batches = [harmonic_pack.pa.RecordBatch.from_pydict({"doc_id": [i, i + 1], "text": [f"one two {i}", "three"]}) for i in range(0, 40, 2)]
    calls, encode = [], token_cache.PartEncoder.encode_rows
    monkeypatch.setattr(token_cache.PartEncoder, "encode_rows", lambda self, texts, end: calls.append(len(texts)) or encode(self, texts, end))
    monkeypatch.setattr(harmonic_pack.TaskContext, "get", lambda: type("Task", (), {"partitionId": lambda self: 0})())
    packed = [[x.to_pylist() for x in harmonic_pack._pack(tokenizer_file(BYTE_VOCAB), 1024, 0, 1000, size)(iter(batches))] for size in (1 << 20, 1)]
    assert calls[0] == 40 and len(calls) == 1 + 40
    assert sum(packed[0], []) == sum(packed[1], [])


def test_encode_and_decode_documents(spark, library):
    some, docs = rows_for(spark)
    path = tokenizer_file(WORD_VOCAB)
    encoded = bpe_backtrack.encode_documents(docs, path)
    texts_back = sorted((str(r[0]), r[1]) for r in bpe_backtrack.decode_documents(encoded, path).collect())
    lib = library[WORD_VOCAB]
    assert texts_back == sorted((str(d), lib.decode(lib.encode(t or "", add_special_tokens=False).ids, skip_special_tokens=False)) for d, t in some)
