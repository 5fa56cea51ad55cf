import json
import os
import tempfile

import pytest
from pyspark.sql import functions as F

from shardloom.operators import integrity as I
from shardloom.operators import ledger as L
from shardloom.sources import ledger_io

COLS = "stage string, shard_id string, state string, output_path string, checksum string, token_count long, updated_at double, error string"


def _ledger(spark, rows):
    return spark.createDataFrame(rows, COLS)


def test_transitions(spark):
    led = _ledger(spark, [("clean", "a", "pending", "", "", 0, 1.0, ""),
                          ("clean", "b", "processing", "p", "c", 5, 1.0, "old"),
                          ("clean", "c", "done", "p", "c", 5, 1.0, "")])
    upd = spark.createDataFrame([
        ("clean", "a", "processing", 10.0, None, None, None, None),
        ("clean", "a", "verified", 11.0, "out/a", "h", 7, None),
        ("clean", "a", "done", 12.0, None, None, None, None),
        ("clean", "b", "failed", 10.0, None, None, None, "boom"),
    ], "stage string, shard_id string, op string, ts double, output_path string, checksum string, token_count long, error string")
    out = {r["shard_id"]: r for r in L.apply_updates(led, upd).collect()}
    assert out["a"]["state"] == "done" and out["a"]["output_path"] == "out/a" and out["a"]["token_count"] == 7
    assert out["b"]["state"] == "failed" and out["b"]["error"] == "boom" and out["b"]["output_path"] == "p"
    assert out["c"]["state"] == "done" and out["c"]["updated_at"] == 1.0


def test_register_idempotent_and_gate(spark):
    led = _ledger(spark, [("clean", "a", "done", "", "", 3, 1.0, "")])
    ids = spark.createDataFrame([("clean", "a"), ("clean", "b")], "stage string, shard_id string")
    once = L.register(led, ids, 5.0)
    twice = L.register(once, ids, 6.0)
    assert sorted(tuple(r) for r in once.collect()) == sorted(tuple(r) for r in twice.collect())
    with pytest.raises(RuntimeError, match="1 pending, 0 processing, 0 verified, 1 done"):
        L.require_complete(once, "clean")
    L.require_complete(led, "clean")
    with pytest.raises(RuntimeError):
        L.require_complete(led, "pack")


def test_reset_stale(spark):
    led = _ledger(spark, [("s", "a", "processing", "", "", 0, 0.0, ""), ("s", "b", "processing", "", "", 0, 9000.0, "")])
    out = {r["shard_id"]: r for r in L.reset_stale(led, 10000.0).collect()}
    assert out["a"]["state"] == "pending" and out["a"]["updated_at"] == 10000.0
    assert out["b"]["state"] == "processing"


def test_ledger_documents_and_quarantine(spark):
    d = tempfile.mkdtemp(prefix="ledger-test-", dir="/tmp")
    doc = {"meta": {"stage": "clean"}, "shards": [
        {"shard_id": "x__train__000000", "state": "done", "output_path": "o", "checksum": "c",
         "token_count": 3, "updated_at": 1.5, "error": ""}]}
    with open(os.path.join(d, "clean.json"), "w") as f:
        json.dump(doc, f, indent=2)
    with open(os.path.join(d, "tokenize.json"), "w") as f:
        f.write("{ not json")
    entries, bad = ledger_io.read_ledger_documents(spark, d)
    rows = entries.collect()
    assert len(rows) == 1 and rows[0]["stage"] == "clean" and rows[0]["token_count"] == 3
    assert bad.count() == 1


def test_protected_paths(spark):
    df = spark.createDataFrame([("data/raw/x.txt",), ("blogs/a.txt",), ("tokenizer/t.json",)], "path string")
    keep = [r["path"] for r in df.filter(~I.is_protected(F.col("path"))).collect()]
    assert keep == ["data/raw/x.txt"]


def test_gate_and_cleanup_without_verified_entries(spark):
    led = _ledger(spark, [("download", "a", "done", "out/a.bin", "", 5, 1.0, ""),
                          ("clean", "b", "pending", "", "", 0, 1.0, "")])
    gate = {r["stage"]: r for r in L.gate_report(led, {"clean": "download", "pack": "clean"}).collect()}
    assert gate["clean"]["may_run"] and (gate["clean"]["up_done"], gate["clean"]["up_total"]) == (1, 1)
    assert not gate["pack"]["may_run"] and (gate["pack"]["up_done"], gate["pack"]["up_total"]) == (0, 1)
    # a complete stage whose only entry has no recorded checksum but a too-short .bin fails verification
    files = spark.createDataFrame([("out/a.bin", 100, "x")], "path string, length long, file_checksum string")
    listing = spark.createDataFrame([("download", "data/raw/x.txt", 7)], "stage string, path string, length long")
    dirs = spark.createDataFrame([("download", "data/raw/"), ("clean", "data/clean/")], "stage string, artifact_dir string")
    rep = {r["stage"]: r for r in I.cleanup_report(led, files, listing, dirs).collect()}
    assert rep["download"]["skipped"] and rep["download"]["error"] == "bad_bin:too_short a"
    assert rep["clean"]["skipped"] and rep["clean"]["error"] == "incomplete"
    empty = _ledger(spark, [("s", "a", "done", "p", "", 1, 1.0, "")]).filter("state = 'none'")
    rep2 = I.cleanup_report(empty, files, listing, spark.createDataFrame([("s", "d/")], "stage string, artifact_dir string"))
    assert rep2.first()["error"] == "incomplete"


def test_updates_for_unknown_shards_are_errors_and_ties_are_ordered(spark):
    led = _ledger(spark, [("s", "a", "pending", "", "", 0, 1.0, "")])
    kind = "stage string, shard_id string, op string, ts double, output_path string, checksum string, token_count long, error string"
    tie = spark.createDataFrame([("s", "a", "done", 5.0, None, None, None, None), ("s", "a", "verified", 5.0, "o", "c", 1, None)], kind)
    assert L.apply_updates(led, tie).first()["state"] == "done"
    stray = spark.createDataFrame([("s", "b", "done", 5.0, None, None, None, None)], kind)
    with pytest.raises(Exception, match="unknown shard"):
        L.apply_updates(led, stray).collect()


def test_meta_merge_keeps_old_keys_and_prefers_new_values(spark):
    kind = "stage string, meta map<string,string>"
    old = spark.createDataFrame([("s", {"a": "1", "b": "2"}), ("t", {"x": "1"})], kind)
    new = spark.createDataFrame([("s", {"b": "3", "c": "4"}), ("u", {"y": "2"})], kind)
    got = {r["stage"]: r["meta"] for r in L.merge_meta(old, new).collect()}
    assert got == {"s": {"a": "1", "b": "3", "c": "4"}, "t": {"x": "1"}, "u": {"y": "2"}}


def test_storage_labels_are_folders(spark):
    files = spark.createDataFrame([("file:/r/source=a/split=train/f", 1), ("file:/r/source=ab/split=train/f", 2), ("file:/r/source=b/x-source=a/f", 4)], "path string, length long")
    got = {r["label"]: (r["bytes"], r["files"]) for r in I.storage_summary(files, "file:/r", [("all", ""), ("a", "source=a"), ("train", "*/split=train")]).collect()}
    assert got == {"all": (7, 3), "a": (1, 1), "train": (3, 2)}
