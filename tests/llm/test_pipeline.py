"""The pipeline against a brute-force run of its last three stages on the rows the learned stages keep."""

import re

import corpus_pipeline as P
from shardloom.llm import harmonic_pack
from shardloom.llm.oracles import ORACLE
from shardloom.llm.queries import QUERIES
from shardloom.llm.token_cache import encoder, tokenizer_file
from tests.llm import brute

SF = "/root/testdata/sf0.001"


def test_stages_follow_each_other(spark):
    docs = P.C.read_table(spark, SF, "documents")
    kept = [docs]
    for _, stage in P.STAGES[:-1]:
        kept.append(P.C.materialize(stage(spark, kept[-1], SF), "test"))
        assert kept[-1].columns == docs.columns
    rows = [sorted((tuple(r) for r in k.collect())) for k in kept]
    assert len(rows[0]) > len(rows[1]) >= len(rows[2]) > len(rows[3]) >= len(rows[4]) > 0
    failed = {r[0] for r in rows[0] if brute.quality_counts(r[1])["base_failed"]}
    assert not failed & {r[0] for r in rows[1]}

    before = rows[2]
    first = brute.near_classes([r[1] for r in before])
    assert [r[0] for r in rows[3]] == [before[i][0] for i in sorted(set(first))]

    left = {}
    for r, (_, _, data) in zip(rows[3], brute.repeated_runs([r[1] for r in rows[3]])):
        text = data.decode("utf-8", "ignore")
        if re.search(r"[^\x20\x09-\x0D]", text):
            left[r[0]] = text
    assert {r[0]: r[1] for r in rows[4]} == left and all(r[4] == len(r[1]) for r in rows[4])

    packed = P.STAGES[-1][1](spark, kept[-1], SF).collect()
    ids = dict(zip(left, encoder(tokenizer_file("byte_bpe_50k.json")).encode(list(left.values()))))
    assert {r["doc_id"]: r["doc_tokens"] for r in packed} == {d: len(x) // 2 + 1 for d, x in ids.items()}
    for d, x in ids.items():
        assert sorted(r["length"] for r in packed if r["doc_id"] == d) == sorted(harmonic_pack.cut_lengths(len(x) // 2 + 1))


def test_run_and_stages_of_empty_input(spark):
    docs = P.C.read_table(spark, SF, "documents").limit(0)
    for _, stage in P.STAGES:
        docs = P.C.materialize(stage(spark, docs, SF), "test")
        assert docs.count() == 0
    assert P.run(spark, SF).columns == ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]


def test_every_operator_is_registered():
    assert sorted(int(re.match(r"op(\d+)_", q)[1]) for q in QUERIES) == list(range(1, 14))
    assert set(ORACLE) <= set(QUERIES)
