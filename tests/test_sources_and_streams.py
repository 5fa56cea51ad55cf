import os
import tempfile

import numpy as np
import pytest
from pyspark.sql import functions as F

from shardloom.functions import text as T
from shardloom.operators import clean as C
from shardloom.operators import shards as S
from shardloom.operators.ordinal import global_ordinal, running_aggregates
from shardloom.plans import fixtures as X
from shardloom.session import scratch_path
from shardloom.sources import textshards as TS
from shardloom.sources import tokenbin
from shardloom.sources.registry import SourceSpec, ingest
from tests.conftest import SF_SMALL


def test_payload_tables_round_trip_and_ignore_unfinished_writes(spark):
    rows = [("train" if i % 3 else "test", i, [int(x) for x in np.random.RandomState(i).randint(0, 65536, 8)]) for i in range(50)]
    path = scratch_path(spark, "payload")
    frame = spark.createDataFrame(rows, "split string, seq_id long, tokens array<int>")
    tokenbin.write_packed(frame, path, 3)
    folder = path.replace("file:", "")
    os.makedirs(f"{folder}/_temporary/0")  # what a writer that died leaves
    with open(f"{folder}/_temporary/0/part-00000.parquet", "wb") as f:
        f.write(b"half a file")
    got = {(r["split"], r["seq_id"]): list(r["tokens"]) for r in tokenbin.read_packed(spark, path).collect()}
    assert got == {(s, i): t for s, i, t in rows}
    assert {r["split"]: r["length"] for r in tokenbin.packed_sizes(spark, path).collect()} == {"train": 33 * 16, "test": 17 * 16}
    with pytest.raises(Exception, match="uint16"):
        tokenbin.write_packed(spark.createDataFrame([("train", 0, [70000])], "split string, seq_id long, tokens array<int>"), scratch_path(spark, "payload"))


def test_headerless_files_are_one_stream(spark):
    d = tempfile.mkdtemp(prefix="tokenbin-test-", dir="/tmp")
    a, b = np.arange(21, dtype="<u2"), np.arange(60000, 60016, dtype="<u2")
    a.tofile(os.path.join(d, "a.bin"))
    b.tofile(os.path.join(d, "b.bin"))
    got = sorted((r["seq_id"], list(r["tokens"])) for r in tokenbin.read_headerless(spark, d, 8).collect())
    assert got == [(0, list(range(8))), (1, list(range(8, 16))), (2, list(range(60000, 60008))), (3, list(range(60008, 60016)))]


def test_global_ordinal_equals_row_number(spark):
    df = spark.range(0, 5000).select((F.col("id") % 3).alias("g"), (F.col("id") * 7919 % 5003).alias("o"))
    a = global_ordinal(df.repartition(7), ["g"], ["o"], "ord").collect()
    got = {(r["g"], r["o"]): r["ord"] for r in a}
    for g in range(3):
        keys = sorted(o for (gg, o) in got if gg == g)
        assert [got[(g, o)] for o in keys] == list(range(len(keys)))


def test_ordinals_keep_null_and_repeated_keys(spark):
    rows = [("a", 1, "x"), ("a", 1, "x"), ("a", None, "y"), (None, 1, "z"), (None, None, "z"), ("a", 2, "w")] * 3
    docs = spark.createDataFrame([(s, "train", d, t) for s, d, t in rows], "source string, split string, doc_id long, text string")
    got = S.assign_shards(docs, 4).collect()
    assert sorted(str(r["doc_ordinal"]) for r in got if r["source"] == "a") == sorted(map(str, range(12)))
    assert sorted(r["doc_ordinal"] for r in got if r["source"] is None) == list(range(6))
    assert sorted((str(r["source"]), str(r["doc_id"]), r["text"]) for r in got) == sorted((str(s), str(d), t) for s, d, t in rows)
    runs = spark.createDataFrame([(None, i, i) for i in range(5)] + [(1, i, i) for i in range(5)], "g int, o int, v int")
    run = running_aggregates(runs, ["g"], ["o"], [("n", F.col("v"), "count", False)])
    assert sorted((str(r["g"]), r["n"]) for r in run.collect()) == sorted((g, n) for g in ("None", "1") for n in range(1, 6))


def test_ingest_missing_column_and_splits(spark):
    p, q = scratch_path(spark, "ingest-src"), scratch_path(spark, "ingest-src")
    spark.createDataFrame([(1, "  hi  "), (2, "   ")], "id long, body string").write.parquet(p)
    spark.createDataFrame([(7, "test row", "test"), (8, "train row", "train"), (9, "other", "dev")], "id long, body string, part string").write.parquet(q)
    reg = [SourceSpec(name="a", path={"train": p, "test": q}, splits=("train", "test"), text_col="body", id_expr={"train": "id", "test": "id + 100"}),
           SourceSpec(name="b", path=p, text_col="missing", id_expr="id"),
           SourceSpec(name="c", path=q, splits=("train", "test"), split_col="part", text_col="body", id_expr="id")]
    rows = sorted(tuple(r) for r in ingest(spark, reg).collect())
    assert rows == [("a", "test", 107, "test row"), ("a", "test", 108, "train row"), ("a", "test", 109, "other"), ("a", "train", 1, "hi"),
                    ("c", "test", 7, "test row"), ("c", "train", 8, "train row")]
    with pytest.raises(ValueError, match="several splits"):
        SourceSpec(name="a", path=p, splits=("train", "test"))


@pytest.mark.parametrize("fmt", ["json", "csv"])
def test_ingest_other_formats(spark, fmt):
    p = scratch_path(spark, "ingest-src")
    spark.createDataFrame([(1, "one"), (2, "two")], "id long, text string").write.format(fmt).option("header", True).save(p)
    spec = SourceSpec(name="a", path=p, fmt=fmt, id_expr="cast(id as bigint)", options={"header": "true"} if fmt == "csv" else {})
    assert sorted(r["text"] for r in ingest(spark, [spec]).collect()) == ["one", "two"]


def test_shard_names_and_numbers_over_several_blocks(spark):
    """Special characters in names come back as written; one file spans several tasks."""
    docs = [("a b:c%", "train", 0, i, f"line {i} " + "x" * 40 + "\n\nsecond") for i in range(200)] + [("plain", "train", 1, 0, "one\r\ntwo\rthree")]
    path = scratch_path(spark, "names")
    TS.write_text_shards(spark.createDataFrame(docs, "source string, split string, shard_idx int, doc_id long, text string"), path)
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "2k")
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    try:
        lines = TS.shard_files(spark.read, path)
        assert lines.rdd.getNumPartitions() > 3
        got = {(r["source"], r["line_no"]): r["line"] for r in TS.read_text_shards(spark, path).collect()}
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
        spark.conf.unset("spark.sql.files.openCostInBytes")
    expected = {("plain", i): t for i, t in enumerate(("one", "two", "three"))}
    for i in range(200):
        expected["a b:c%", 3 * i] = f"line {i} " + "x" * 40
        expected["a b:c%", 3 * i + 2] = "second"
    assert got == expected


def test_late_events_are_counted(spark):
    from shardloom.streaming import events as EV
    path, out, ck = (scratch_path(spark, n) for n in ("ev", "ev-out", "ev-ck"))
    rows = [(i, f"2024-01-{1 + i % 28:02d} 0{i % 10}:00:00", "view") for i in range(1000)]
    ev = spark.createDataFrame(rows, "event_id long, ts string, event_type string").withColumn("ts", F.to_timestamp("ts"))
    for part in (2, 1, 0):  # newest first
        ev.filter((F.dayofmonth("ts") > 9 * part) & (F.dayofmonth("ts") <= (9 * part + 9 if part < 2 else 31))).coalesce(1).write.mode("append").parquet(path)
    EV.run_stage_event_windows(spark, path, ev.schema, out, ck)
    assert EV.total_windows(spark.read.parquet(out)).agg(F.sum("n")).first()[0] == 1000


def shard_names(spark, path):
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.txt").load(path)
    return sorted(tuple(r) for r in files.select("path", T.shard_id_expr(F.col("source"), F.col("split"), F.col("shard_idx"))).collect())


def test_a_bad_shard_fails_alone_and_is_tried_again(spark):
    """One shard makes its task raise, one has a line with a fault; the others are done, and the next run does those two only."""
    from shardloom.streaming.incremental import incremental_clean, read_ledger
    shards, out, led, ck = (scratch_path(spark, n) for n in ("bad-shards", "o", "l", "c"))
    good = "This is a sentence that is long enough to pass the quality gate, with letters and spaces only, number {}."
    texts = [(f"src{i}", "train", 0, i, (good.format(i) + "\n") * 2) for i in range(9)]
    texts[4] = ("src4", "train", 0, 4, good.format(4) + "\nfaulty line")
    TS.write_text_shards(spark.createDataFrame(texts, "source string, split string, shard_idx int, doc_id long, text string"), shards)
    poisoned = F.when(F.col("source") == "src7", F.raise_error(F.lit("poisoned shard")).cast("string")).otherwise("default")
    fault = F.when(F.col("line").startswith("faulty"), F.lit("a faulty line"))
    incremental_clean(spark, shards, out, led, ck, poisoned, max_files_per_trigger=5, faults=fault)
    state = {r["shard_id"]: (r["state"], r["docs_out"], r["error"]) for r in read_ledger(spark, led).collect()}
    assert len(state) == 9 and {s for s, r in state.items() if r[0] == "failed"} == {"src4__train__000000", "src7__train__000000"}
    assert state["src4__train__000000"][1:] == (0, "a faulty line") and "poisoned shard" in state["src7__train__000000"][2]
    assert all(r == ("done", 1, "") for r in state.values() if r[0] == "done")
    assert {r["source"] for r in spark.read.parquet(out).collect()} == {f"src{i}" for i in range(9)} - {"src4", "src7"}
    before = spark.read.parquet(led).count()
    incremental_clean(spark, shards, out, led, ck, F.lit("default"), max_files_per_trigger=5)
    rows = spark.read.parquet(led)
    assert rows.count() == before + 2 and {r["state"] for r in read_ledger(spark, led).collect()} == {"done"}
    assert spark.read.parquet(out).count() == 9
    incremental_clean(spark, shards, out, led, ck, F.lit("default"))
    assert spark.read.parquet(led).count() == before + 2


def test_broken_bytes_become_replacement_characters(spark):
    path = scratch_path(spark, "bytes")
    raw = [b"bad \xff\xfe byte", b"cut \xe2\x82", b"\xf0\x9f\x98\x80 fine", b"\xc0\xaf over"]
    rows = spark.createDataFrame([("a", "train", 0, i, x) for i, x in enumerate(raw)], "source string, split string, shard_idx int, doc_id long, b binary")
    TS.write_text_shards(rows.withColumn("text", F.col("b").cast("string")), path)
    got = [r["line"] for r in TS.read_text_shards(spark, path).orderBy("line_no").collect()]
    assert got == [x.decode("utf-8", errors="replace") for x in raw]


def test_headerless_files_are_read_by_several_tasks(spark):
    from shardloom.sources import rawfiles, tokenbin
    rows = [("train" if i % 3 else "test", i // 3 if i % 3 == 0 else i - i // 3 - 1, [(i * 7 + k) % 65536 for k in range(8)]) for i in range(400)]
    packed = spark.createDataFrame(rows, "split string, seq_id long, tokens array<int>")
    path = scratch_path(spark, "headerless")
    tokenbin.write_headerless(packed, path, 3)
    back = tokenbin.read_headerless(spark, path, 8, "*.txt", padded=True, range_bytes=200)
    got = sorted((r["path"].split("split=")[1].split("/")[0], r["seq_id"], list(r["tokens"])) for r in back.collect())
    assert got == sorted(rows)
    files = rawfiles.list_raw(spark, path, "*.txt")
    ranges = rawfiles.byte_ranges(files, 18, 200)
    assert ranges.count() > 2 * files.count() and {r["size"] % 18 for r in ranges.collect()} == {0}
    assert ranges.select(F.spark_partition_id()).distinct().count() > 1


def test_checksums_of_files_read_in_chunks(spark):
    import hashlib
    import os
    import tempfile

    from shardloom.operators.integrity import file_checksums
    d = tempfile.mkdtemp(prefix="sums-", dir="/tmp")
    data = {"a b%20.bin": os.urandom(100_000), "small.bin": b"xyz"}
    for name, content in data.items():
        with open(os.path.join(d, name), "wb") as f:
            f.write(content)
    for limit in (1 << 30, 1000, 0):
        got = {os.path.basename(r["path"]): (r["length"], r["file_checksum"]) for r in file_checksums(spark, d, "*.bin", streamed=limit).collect()}
        assert got == {n: (len(c), hashlib.sha256(c).hexdigest()) for n, c in data.items()}


def test_shards_follow_from_counts(spark):
    docs = spark.createDataFrame([("a", "train", i) for i in range(10)] + [("a", "test", 0), ("b", "train", 1), ("b", "train", None)], "source string, split string, doc_id long")
    for size in (1, 3, 5, 50):
        numbered = {tuple(r) for r in S.assign_shards(docs, size).select("source", "split", "shard_idx", "shard_id").collect()}
        assert sorted(map(tuple, S.shards_of(docs, size).collect())) == sorted(numbered)


def test_text_shards_and_incremental_clean(spark):
    from shardloom.streaming.incremental import incremental_clean, write_files
    shards = scratch_path(spark, "t-shards")
    TS.write_text_shards(X.sharded_documents(spark, SF_SMALL), shards)
    lines = TS.read_text_shards(spark, shards)
    assert lines.count() == X.cleaned_lines(spark, SF_SMALL).count()
    out, led, ck = (scratch_path(spark, n) for n in ("o", "l", "c"))
    policy = T.policy_of_registry(F.col("source"), X.POLICIES)
    incremental_clean(spark, shards, out, led, ck, policy, max_files_per_trigger=7)
    batch = {r["shard_id"]: (r["docs_in"], r["docs_out"])
             for r in C.clean_yield(X.cleaned_lines(spark, SF_SMALL), with_total=False).collect()}
    stream = {r["shard_id"]: (r["docs_in"], r["docs_out"]) for r in spark.read.parquet(led).collect()}
    assert stream == batch
    n_batches = spark.read.parquet(led).select("batch_id").distinct().count()
    assert n_batches > 1
    # a batch that is replayed leaves one ledger row per shard, and a shard of blank lines has one too
    one = scratch_path(spark, "t-shards")
    TS.write_text_shards(spark.createDataFrame([("src0", "train", 0, 1, " \n "), ("src0", "train", 1, 2, "a text")],
                                               "source string, split string, shard_idx int, doc_id long, text string"), one)
    o2, l2 = scratch_path(spark, "o"), scratch_path(spark, "l")
    for _ in range(2):
        write_files(spark, one, shard_names(spark, one), 0, policy, o2, l2)
    assert sorted((r["shard_id"], r["docs_in"]) for r in spark.read.parquet(l2).collect()) == [("src0__train__000000", 0), ("src0__train__000001", 1)]
    # rerun: the checkpoint says every file is done, nothing is processed again
    incremental_clean(spark, shards, out, led, ck, policy)
    assert spark.read.parquet(led).count() == len(batch)


def test_running_aggregates_hot_group(spark):
    from pyspark.sql import Window
    # one group holds most rows; spread over many range partitions
    df = spark.range(0, 3000).select(F.when(F.col("id") % 10 < 8, F.lit(0)).otherwise(F.col("id") % 3).alias("g"),
                                     F.col("id").alias("o"),
                                     F.when(F.col("id") % 7 == 0, F.col("id") * 31 % 101).alias("v"))
    got = running_aggregates(df, ["g"], ["o"], [("mn", F.col("v"), "min", True), ("ls", F.col("v"), "last", False),
                                                ("ct", F.col("v"), "count", False)], num_partitions=16)
    w_ex = Window.partitionBy("g").orderBy("o").rowsBetween(Window.unboundedPreceding, -1)
    w_in = Window.partitionBy("g").orderBy("o").rowsBetween(Window.unboundedPreceding, 0)
    ref = df.select("g", "o", F.min("v").over(w_ex).alias("mn"), F.last("v", ignorenulls=True).over(w_in).alias("ls"),
                    F.count("v").over(w_in).alias("ct"))
    a = sorted(tuple(r) for r in got.select("g", "o", "mn", "ls", "ct").collect())
    b = sorted(tuple(r) for r in ref.collect())
    assert a == b


def test_many_shards_in_a_batch_and_few_listing_tasks(spark):
    """More shards than folders that Spark lists by itself: they are read and cleaned in one batch, and listed by few tasks."""
    from shardloom.streaming.incremental import incremental_clean, streaming_dedup
    shards, out, led, ck, dd, ck2 = (scratch_path(spark, n) for n in ("many", "o", "l", "c", "d", "c2"))
    text = "This is a sentence that is long enough to pass the quality gate, with letters and spaces only, number {}."
    docs = [("src0", "train", i, i, (text.format(i) + "\n") * 2) for i in range(150)]
    TS.write_text_shards(spark.createDataFrame(docs, "source string, split string, shard_idx int, doc_id long, text string"), shards)
    tracker, conf = spark.sparkContext.statusTracker(), "spark.sql.sources.parallelPartitionDiscovery.parallelism"
    before = spark.conf.get(conf)
    spark.sparkContext.setJobGroup("listing", "listing")
    try:
        assert TS.read_text_shards(spark, shards).count() == 300
        tasks = [tracker.getStageInfo(s).numTasks for j in tracker.getJobIdsForGroup("listing") for s in tracker.getJobInfo(j).stageIds if tracker.getStageInfo(s)]
    finally:
        spark.sparkContext._jsc.clearJobGroup()
    assert max(tasks) < 150 and spark.conf.get(conf) == before
    incremental_clean(spark, shards, out, led, ck, F.lit("default"))
    rows = spark.read.parquet(led).collect()
    assert len(rows) == 150 and {r["batch_id"] for r in rows} == {0} and {(r["docs_in"], r["docs_out"]) for r in rows} == {(2, 1)}
    assert spark.read.parquet(out).count() == 150
    streaming_dedup(spark, shards, dd, ck2, F.lit("default"))
    assert {(r["batch_id"], r["shard_id"]) for r in spark.read.parquet(dd).collect()} == {(0, f"src0__train__{i:06d}") for i in range(150)}


def test_shard_files_hold_the_rows_as_spark_writes_them(spark):
    """Folders, null names, null texts and bytes as Spark's own writer has them; a second write replaces the first."""
    rows = spark.createDataFrame([("a b:c%/[x]=?*'#", "t\u00e9", 3, 2, "two\nlines"), ("a b:c%/[x]=?*'#", "t\u00e9", 3, 1, None), ("", None, 0, 1, "x"), (None, "s", None, None, "")],
                                 "source string, split string, shard_idx int, doc_id long, text string")
    ours, theirs = scratch_path(spark, "ours"), scratch_path(spark, "theirs")
    TS.write_text_shards(rows.withColumn("text", F.lit("old")), ours)
    TS.write_text_shards(rows, ours)
    (rows.repartition("source", "split", "shard_idx").sortWithinPartitions("source", "split", "shard_idx", "doc_id")
     .select(F.col("text").alias("value"), "source", "split", "shard_idx").write.partitionBy("source", "split", "shard_idx").text(theirs))

    def found(path):
        root = path.replace("file:", "")
        return sorted((os.path.relpath(d, root), open(os.path.join(d, f), "rb").read()) for d, _, names in os.walk(root) for f in names if f.endswith(".txt"))

    assert found(ours) == found(theirs) and len(found(ours)) == 3


def test_contents_of_shards_without_a_group(spark):
    import hashlib
    path = scratch_path(spark, "shard-docs")
    docs = [(7, "b\n"), (3, "a"), (3, "A"), (9, None), (1, "\u00e9"), (None, "z")]
    spark.createDataFrame([(i, t, "src1") for i, t in docs], "doc_id long, text string, source string").write.parquet(path + "/documents.parquet")
    first, rest = "z\n\u00e9\nA\na\nb\n\n".encode(), b""
    got = {r["shard_id"]: (r["length"], r["checksum"]) for r in X.shard_contents(spark, path).collect()}
    assert got == {f"src1__train__{i:06d}": (len(b), hashlib.sha256(b).hexdigest()) for i, b in enumerate((first, rest))}


SHARD_ROWS = "source string, split string, shard_idx int, doc_id long, text string"


def files_on_the_driver(spark):
    """How many files Spark's listings have handed to the driver so far."""
    return spark._jvm.org.apache.spark.metrics.source.HiveCatalogMetrics.METRIC_FILES_DISCOVERED().getCount()


def many_shards(spark, n):
    path = scratch_path(spark, "many-shards")
    text = "This is a sentence that is long enough to pass the quality gate, with letters and spaces only, number {}."
    TS.write_text_shards(spark.createDataFrame([("src0", "train", i, i, text.format(i)) for i in range(n)], SHARD_ROWS), path)
    return path


def test_shards_are_read_without_their_names_on_the_driver(spark):
    """the driver listed every shard file, and planned a scan of each."""
    path = many_shards(spark, 1000)
    before = files_on_the_driver(spark)
    assert TS.read_text_shards(spark, path).count() == 1000
    assert files_on_the_driver(spark) - before < 500


def test_ranges_hold_each_line_once():
    import io
    rng = np.random.RandomState(5)
    for _ in range(300):
        data = b"".join([b"\r", b"\n", b"\r\n", b"x", b"yy", b"\xef\xbb\xbf"][i] for i in rng.randint(0, 6, rng.randint(0, 30)))
        size = int(rng.randint(1, 9))
        got = [x for at in range(0, len(data), size) for x in TS._range_lines(io.BytesIO(data), at, min(size, len(data) - at))]
        assert got == data.removeprefix(b"\xef\xbb\xbf").splitlines(), (data, size)


def test_shards_in_ranges_are_those_of_sparks_reader(spark, monkeypatch):
    """Files of several ranges are numbered through; names, ends of lines, blank lines, bad bytes and a byte order mark as Spark's reader has them."""
    raw = [b"\xef\xbb\xbfone\r\n\r\ntwo\rthree " + b"x" * 300 + b"\n\n \xff\xfe", b"", b"\xf0\x9f\x98\x80" * 40 + b"\r\r\n\n", b"last", b"\xef\xbb\xbf"]
    names = [("a b:c%/[x]=?*'#", "té", 3), ("", None, 0), ("plain+", "train", 1)]
    rows = [(*k, i, x) for k in names for i, x in enumerate(raw)]
    path = scratch_path(spark, "ranges")
    TS.write_text_shards(spark.createDataFrame(rows, "source string, split string, shard_idx int, doc_id long, text binary"), path)
    folder = path.replace("file:", "") + "/source=plain+/split=train/shard_idx=1"
    for name, text in (("empty.txt", b""), (".hidden.txt", b"no"), ("_part.txt", b"no"), ("other.bin", b"no")):
        with open(f"{folder}/{name}", "wb") as f:
            f.write(text)
    theirs = TS.shard_files(spark.read, path).filter(T.not_blank(F.col("line"))).select("source", "split", "shard_idx", "shard_id", "line")
    want = sorted(map(repr, theirs.collect()))
    numbered = sorted((r["shard_id"], r["line_no"], r["line"]) for r in TS.read_text_shards(spark, path).collect())
    for size in (7, 64, 1 << 20):
        monkeypatch.setattr(TS, "LINE_RANGE", size)
        got = TS.read_text_shards(spark, path)
        assert sorted(map(repr, got.drop("line_no").collect())) == want
        assert sorted((r["shard_id"], r["line_no"], r["line"]) for r in got.collect()) == numbered
    text = b"".join(x + b"\n" for x in raw).removeprefix(b"\xef\xbb\xbf").splitlines()
    whole = [(i, x.decode("utf-8", "replace")) for i, x in enumerate(text) if x.strip()]
    assert [x[1:] for x in numbered if x[0] == "plain+__train__000001"] == whole


def test_a_stream_of_lists_keeps_no_names_on_the_driver(spark):
    """a stream of shard files lists them all on the driver at every batch; a stream of lists does not."""
    from shardloom.streaming.incremental import streaming_dedup
    path, dd, ck = many_shards(spark, 1000), scratch_path(spark, "d"), scratch_path(spark, "c")
    before = files_on_the_driver(spark)
    streaming_dedup(spark, path, dd, ck, F.lit("default"), max_files_per_trigger=600)
    assert files_on_the_driver(spark) - before < 500
    rows = spark.read.parquet(dd).groupBy("batch_id").count().collect()
    assert {r["batch_id"]: r["count"] for r in rows} == {0: 600, 1: 400}


def test_incremental_cleaning_keeps_no_names_on_the_driver(spark):
    """as F3; failed shards are tried again and late ones follow, each in a batch of its own."""
    from shardloom.streaming.incremental import incremental_clean, read_ledger
    path = many_shards(spark, 1000)
    out, led, ck2 = (scratch_path(spark, n) for n in ("o", "l", "c2"))
    before = files_on_the_driver(spark)
    fault = F.when(F.col("shard_idx") % 100 == 0, "a fault")
    incremental_clean(spark, path, out, led, ck2, F.lit("default"), max_files_per_trigger=600, faults=fault)
    assert files_on_the_driver(spark) - before < 800
    assert sorted(r["shard_id"] for r in read_ledger(spark, led).filter("state = 'failed'").collect()) == [f"src0__train__{i:06d}" for i in range(0, 1000, 100)]
    more = spark.createDataFrame([("src1", "train", 0, 1, "This is a sentence that is long enough to pass the quality gate, with letters and spaces only, and it is late.")], SHARD_ROWS)
    TS.write_text_shards(more, f"{path}/later")
    incremental_clean(spark, path, out, led, ck2, F.lit("default"))
    last = spark.read.parquet(led).groupBy("batch_id").count().collect()
    assert {r["batch_id"]: r["count"] for r in last} == {0: 600, 1: 400, -1: 10, 2: 1}
    assert {r["state"] for r in read_ledger(spark, led).collect()} == {"done"} and spark.read.parquet(out).count() == 1001


def test_a_checkpoint_of_a_stream_of_files_goes_on(spark):
    """Shards that a stream of the files themselves has had are not done again."""
    from shardloom.streaming.incremental import streaming_dedup
    path, out, ck = (scratch_path(spark, n) for n in ("old-shards", "o", "c"))
    text = "This is a sentence that is long enough to pass the quality gate, with letters and spaces only, number one."
    rows = lambda names: spark.createDataFrame([(s, "train", 0, 1, text) for s in names], SHARD_ROWS)
    TS.write_text_shards(rows(["a b%", "plain+", "é"]), path)
    old = spark.readStream.schema(TS.SHARD_SCHEMA).format("text").option("pathGlobFilter", "*.txt").load(path)
    old.writeStream.foreachBatch(lambda batch, _: None).option("checkpointLocation", ck).trigger(availableNow=True).start().awaitTermination()
    TS.write_text_shards(rows(["new"]), f"{path}/later")
    streaming_dedup(spark, path, out, ck, F.lit("default"))
    assert [(r["batch_id"], r["shard_id"]) for r in spark.read.parquet(out).collect()] == [(1, "new__train__000000")]
