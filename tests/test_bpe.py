"""BPE training/encoding against the ``tokenizers`` library on the same corpus."""
import json
import os
import random
import tempfile
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from shardloom.functions import pretok as PT
from shardloom.operators import bpe as B
from shardloom.operators import tokenize as TZ
from shardloom.plans import fixtures as X
from shardloom.session import materialize
from tests.conftest import SF_SMALL

def _library(lines, vocab):
    from tokenizers import Tokenizer
    from tokenizers.models import BPE
    from tokenizers.normalizers import NFKC
    from tokenizers.pre_tokenizers import ByteLevel
    from tokenizers.processors import TemplateProcessing
    from tokenizers.trainers import BpeTrainer
    d = tempfile.mkdtemp(prefix="bpe-test-", dir="/tmp")
    p = os.path.join(d, "corpus.txt")
    with open(p, "w", encoding="utf-8") as f:
        for ln in lines:
            f.write(ln + "\n")
    tok = Tokenizer(BPE(unk_token="<unk>"))
    tok.normalizer = NFKC()
    tok.pre_tokenizer = ByteLevel(add_prefix_space=True)
    tok.train([p], BpeTrainer(vocab_size=vocab, min_frequency=2, show_progress=False,
                              special_tokens=["<pad>", "<bos>", "<eos>", "<unk>"]))
    tok.post_processor = TemplateProcessing(single="<bos> $A <eos>",
                                            special_tokens=[("<bos>", 1), ("<eos>", 2)])
    return tok


@pytest.mark.parametrize("size, window, symbols", [(4000, 1500, 6000), (B.VOCAB_SIZE, B.WINDOW, B.SEGMENT_SYMBOLS)])
def test_train_and_encode_match_library(spark, size, window, symbols):
    corpus = X.corpus(spark, SF_SMALL)
    lines = [r["text"] for r in corpus.orderBy("shard_id", "doc_id", "line_idx").collect()]
    freq = materialize(B.pretoken_freq(corpus, "text"))
    model = B.train_bpe(spark, freq, vocab_size=size, window=window, segment_symbols=symbols)
    lib = _library(lines, size)
    j = json.loads(lib.to_str())
    names = {i: (v.decode() if i < 4 else "".join(PT.byte_char(b) for b in v)) for i, v in model.vocab.items()}
    assert {s: i for i, s in names.items()} == j["model"]["vocab"]
    lib_merges = [m if isinstance(m, list) else m.split(" ") for m in j["model"]["merges"]]
    assert [[names[a], names[b]] for a, b, _ in model.merges] == lib_merges
    # corpus encoding (with <bos>/<eos>) equals the library's
    tok = TZ.tokenize_lines(spark, corpus, model, ["shard_id", "doc_id", "line_idx"], "text")
    got = {(r["shard_id"], r["doc_id"], r["line_idx"]): list(r["tokens"]) for r in tok.collect()}
    rows = corpus.orderBy("shard_id", "doc_id", "line_idx").collect()
    for r, ln in zip(rows, lines):
        assert got[(r["shard_id"], r["doc_id"], r["line_idx"])] == lib.encode(ln).ids
    # decoding restores the text behind the added prefix space
    dec = TZ.decode(spark, tok, model, ["shard_id", "doc_id", "line_idx"]).join(corpus, ["shard_id", "doc_id", "line_idx"])
    bad = dec.filter(F.col("decoded") != F.concat(F.lit(" "), F.col("text"))).count()
    assert bad == 0


def test_unseen_byte_is_unk(spark):
    model = B.BpeModel({ord("a"): 4, ord("b"): 5}, {0: b"<pad>", 1: b"<bos>", 2: b"<eos>", 3: b"<unk>", 4: b"a", 5: b"b",
                                                     6: b"ab"}, [(4, 5, 6)])
    df = spark.createDataFrame([(0, "abz")], "k int, text string")
    tok = TZ.tokenize_lines(spark, df, model, ["k"], "text", template=False).collect()[0]
    # " abz": space unseen -> unk, "ab" merged, "z" unseen -> unk
    assert list(tok["tokens"]) == [3, 6, 3]


def plain_training(words, first_id, vocab, least):
    """One merge at a time over (symbols, frequency) words."""
    vocab = dict(vocab)
    words, merges = [(list(w), n) for w, n in words], []
    while True:
        counts = Counter()
        for w, n in words:
            for pair in zip(w, w[1:]):
                counts[pair] += n
        best = min(((-n, *p) for p, n in counts.items() if n >= least), default=None)
        if best is None:
            return merges
        pair, known = best[1:], {v: k for k, v in vocab.items()}
        text = vocab[pair[0]] + vocab[pair[1]]
        new = known.get(text, first_id + len(vocab))
        vocab[new] = text
        merges.append((*pair, new))
        for w, _ in words:
            j = 0
            while j + 1 < len(w):
                if (w[j], w[j + 1]) == pair:
                    w[j:j + 2] = [new]
                j += 1


def random_words(rng, letters, many, longest):
    return list({tuple(rng.randrange(letters) for _ in range(rng.randint(2, longest))): rng.randint(1, 4) for _ in range(many)}.items())


def test_training_equals_one_merge_at_a_time(spark):
    """Ties, runs of one letter and tokens that two ways lead to, with windows that hold only a few pairs."""
    rng = random.Random(1)
    for letters, many, longest, window, symbols in ((2, 12, 9, 3, 40), (3, 30, 12, 5, 60), (5, 60, 8, 8, 50)):
        words = random_words(rng, letters, many, longest)
        rows = [("".join(chr(97 + i) for i in w), n) for w, n in words]
        used = sorted({c for w, _ in words for c in w})
        ids = {c: i + 4 for i, c in enumerate(used)}
        vocab = {i: f"<{i}>".encode() for i in range(4)} | {ids[c]: bytes([97 + c]) for c in used}
        expected = plain_training([([ids[c] for c in w], n) for w, n in words], 0, vocab, 2)
        freq = spark.createDataFrame(rows, "pretoken string, freq long").repartition(2)
        model = B.train_bpe(spark, freq, vocab_size=10_000, window=window, segment_symbols=symbols)
        assert model.merges == expected and model.rounds > 1


def test_merges_stop_after_the_last_hot_pair_and_at_reuse():
    vocab, known = {4: b"a", 5: b"b", 6: b"c"}, {b"a": 4, b"b": 5, b"c": 6}
    got = B.merge_segments([([4, 5], 9), ([5, 6], 3)], (-9, 4, 5), dict(vocab), dict(known), 99, 2)
    assert got == ([(4, 5, 3)], False)
    vocab[7], known[b"ab"] = b"ab", 7
    assert B.merge_segments([([4, 5], 9), ([5, 6], 3)], (-3, 5, 6), dict(vocab), dict(known), 99, 2) == ([(4, 5, 7)], True)
    assert B.merge_segments([([4, 5], 1)], (-1, 4, 5), dict(vocab), dict(known), 99, 2) == ([], False)
    assert B.merge_segments([([4, 5], 9)], (-9, 4, 5), dict(vocab), dict(known), len(vocab), 2) == ([], False)


def test_merge_symbols_equals_one_merge_after_the_other():
    rng = random.Random(2)
    for _ in range(200):
        words = [[rng.randrange(4) for _ in range(rng.randint(0, 14))] for _ in range(rng.randint(0, 9))]
        merges, ids = [], list(range(4))
        for new in range(10, 10 + rng.randint(1, 8)):
            pair = (rng.choice(ids), rng.choice(ids))
            if pair not in [m[:2] for m in merges]:
                merges.append((*pair, new))
                ids.append(new)
        offsets = np.concatenate(([0], np.cumsum([len(w) for w in words]))).astype(np.int64)
        flat, at = B.merge_symbols(np.array([x for w in words for x in w], np.int32), offsets, merges)
        for a, b, new in merges:
            for w in words:
                j = 0
                while j + 1 < len(w):
                    if (w[j], w[j + 1]) == (a, b):
                        w[j:j + 2] = [new]
                    j += 1
        assert [flat[i:j].tolist() for i, j in zip(at[:-1], at[1:])] == words


def test_an_empty_corpus_is_an_error(spark):
    with pytest.raises(ValueError):
        B.train_bpe(spark, spark.createDataFrame([], "pretoken string, freq long"))
    with pytest.raises(ValueError):
        B.training_corpus(spark.createDataFrame([], "text string"))


def test_artifacts_roundtrip(spark):
    from shardloom.session import scratch_path
    model = B.BpeModel({ord("a"): 4, ord("b"): 5}, {0: b"<pad>", 1: b"<bos>", 2: b"<eos>", 3: b"<unk>", 4: b"a",
                                                     5: b"b", 6: b"ab"}, [(4, 5, 6)])
    path = scratch_path(spark, "tok-artifacts")
    B.save_artifacts(spark, model, path)
    back = B.load_artifacts(spark, path)
    assert back.vocab == model.vocab and back.merges == model.merges and back.byte_ids == model.byte_ids
    cfg = json.loads(spark.read.json(f"{path}/config").first()["config"])
    assert cfg["vocab_size"] == 7 and cfg["special_tokens"] == ["<pad>", "<bos>", "<eos>", "<unk>"]


def test_decode_keeps_every_line(spark):
    model = B.BpeModel({}, {0: b"<pad>", 1: b"<bos>", 2: b"<eos>", 3: b"<unk>", 4: b" a", 5: "\u00e9".encode()[:1], 6: "\u00e9".encode()[1:]})
    rows = [(0, [1, 2]), (1, []), (2, None), (3, [1, 4, 5, 6, 2]), (4, [5]), (5, [3, 4, 99])]
    tok = spark.createDataFrame(rows, "i int, tokens array<int>")
    got = {r["i"]: r["decoded"] for r in TZ.decode(spark, tok, model, ["i"]).collect()}
    assert got == {0: "", 1: "", 2: None, 3: " a\u00e9", 4: "\ufffd", 5: " a"}


def test_encode_word_of_a_long_run_is_fast_and_exact():
    import random
    import time
    rng, ids, ranks = random.Random(0), [0, 1, 2], {}
    for r in range(40):
        pair = (rng.choice(ids), rng.choice(ids))
        if pair not in ranks:
            ranks[pair] = (r, 100 + r)
            ids.append(100 + r)

    def plain(word):
        word = list(word)
        while True:
            best = min(((ranks[p][0], i) for i, p in enumerate(zip(word, word[1:])) if p in ranks), default=None)
            if best is None:
                return word
            i = best[1]
            word[i:i + 2] = [ranks[word[i], word[i + 1]][1]]

    for _ in range(300):
        word = [rng.randrange(3) for _ in range(rng.randint(0, 30))]
        assert B.encode_word(word, ranks) == plain(word)
    t = time.time()
    B.encode_word([rng.randrange(3) for _ in range(80000)], ranks)
    assert time.time() - t < 5


def test_pretoken_cache_is_bounded_and_compact():
    ranks, ids = {(4 + 97, 4 + 98): (0, 300)}, {i: i + 4 for i in range(256)}
    cache = B.PretokenCache(ranks, ids, entries=10)
    words = [f"ab{i % 40}" for i in range(200)] + ["ab" * 100] * 2
    got = cache.line(words).tolist()
    assert got == [x for w in words for x in B.encode_word([ids[b] for b in w.encode()], ranks)]
    assert len(cache.recent) + len(cache.older) <= 10 and "ab" * 100 not in cache.recent
    assert all(isinstance(v, bytes) for v in cache.recent.values()) and cache.line([]).tolist() == []


def test_alphabet_and_pair_counts_read_words_by_batches(spark):
    """F16: bytes were exploded one by one in interpreted expressions; pairs were added up by Arrow batch, as short as the session says."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    spark.conf.set(key, "2")
    try:
        freq = spark.createDataFrame([(" ab", 3), ("ab", 2), ("\u00e9", 1), (None, 4), (" b", 5), ("bab", 1)], "pretoken string, freq long").coalesce(1)
        alpha = B.alphabet(freq)
        assert "MapInArrow" in alpha._jdf.queryExecution().executedPlan().toString()
        ids = {r["byte"]: r["id"] for r in alpha.collect()}
        assert ids == {b: 4 + i for i, b in enumerate(sorted(b" ab\xc3\xa9", key=PT.byte_char_code))}
        words = materialize(B.symbol_words(freq, ids))
        want = Counter()
        for r in freq.filter("pretoken is not null").collect():
            w = [ids[b] for b in r["pretoken"].encode()]
            for pair in zip(w, w[1:]):
                want[pair[0] * B.PAIR_BASE + pair[1]] += r["freq"]
        assert {r["pair"]: r["count"] for r in B.symbol_pair_counts(words).collect()} == dict(want)
        assert [b.num_rows for b in B._joined(iter(pa_batches(5)), 1 << 20)] == [5]
    finally:
        spark.conf.set(key, before)


def pa_batches(n):
    import pyarrow as pa
    return [pa.RecordBatch.from_pydict({"w": [b"12345678"]}) for _ in range(n)]


def test_short_merge_stats_cover_every_line(spark):
    """the statistics were those of the first 50,000 lines of the corpus."""
    from shardloom.plans.queries import REGISTRY
    path = tempfile.mkdtemp(prefix="bpe-test-", dir="/tmp")
    per_doc, docs = 250, 204
    line = F.concat(F.lit("every line of the corpus is counted, also those behind the limit of the sample, and this one has a number: "), (F.col("id") * per_doc + F.col("n")).cast("string"))
    rows = spark.range(docs).withColumn("n", F.explode(F.sequence(F.lit(0), F.lit(per_doc - 1)))).withColumn("line", line)
    text = rows.groupBy("id").agg(F.concat_ws("\n", F.collect_list("line")).alias("text"))
    text.select(F.col("id").alias("doc_id"), "text", F.lit("src2").alias("source")).write.parquet(f"{path}/documents.parquet")
    got = REGISTRY["tokenizer_stats_short_merges"](spark, path).first()
    lines = X.corpus(spark, path).agg(F.count("*"), F.sum(F.length("text"))).first()
    assert (got["documents"], got["total_chars"]) == tuple(lines) and got["documents"] == per_doc * docs > TZ.EVAL_SAMPLES
