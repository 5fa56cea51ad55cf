"""Line-oriented text shards.

Write: one text file per shard under ``source=/split=/shard_idx=`` folders; a shard's documents go
to one task (hash partitioned by shard, sorted by document), so its file holds them in order. The task
itself writes the file under another name and renames it when it is whole: a file of shards is small and there are
very many, and Spark's writer creates, commits and moves each by itself (the moves one after the other on the
driver). A repeated task writes the same names again; ``_SUCCESS`` is written when all tasks are through.

Read: line rows (CRLF, CR and LF end a line). Files are listed by tasks and read by byte ranges in tasks: Spark's
own scan of files keeps each file's status, folder and place on the driver, and shard files are very many. Source, split and
index come from the folder, so special characters in names come back as
written. Bytes that are not UTF-8 come back as U+FFFD, as a decoder that replaces errors gives them. A line's number is its place in its range plus the lines of the file's earlier ranges.
"""

from __future__ import annotations

import re

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import text as T
from ..operators.ordinal import global_ordinal
from ..session import delete_tables, materialize, whole_path
from .rawfiles import MOST_TASKS, below, list_tree, raw_folder, sizes_of

SHARD_SCHEMA = "value string, source string, split string, shard_idx int"


#: Characters that Spark escapes in the folder names of partitions, besides control characters.
_ESCAPED = set("\"#%'*/:=?\\{[]^\x7f")


def folder_of(source: str | None, split: str | None, shard_idx: int | None) -> str:
    """The shard's folder as Spark's partition discovery reads it."""
    def part(name, value):
        text = "" if value is None else str(value)
        plain = "".join(f"%{ord(c):02X}" if c in _ESCAPED or "\x00" < c < " " else c for c in text)
        return f"{name}={plain or '__HIVE_DEFAULT_PARTITION__'}"

    return "/".join(part(n, v) for n, v in (("source", source), ("split", split), ("shard_idx", shard_idx)))


SHARD_NAME = "shard.txt"


def _shard_writer(root: str):
    """Writes the files of shards that come sorted, one open at a time; a row (files) per task."""
    def run(batches):
        system, base = raw_folder(root)
        now = out = at = None
        n = 0

        def close():
            out.close()
            system.move(f"{at}/.{SHARD_NAME}.part", f"{at}/{SHARD_NAME}")

        for batch in batches:
            keys = list(zip(*(batch.column(c).to_pylist() for c in ("source", "split", "shard_idx"))))
            text = batch.column("text").to_pylist()
            starts = [i for i in range(len(keys)) if i == 0 or keys[i] != keys[i - 1]]
            for first, end in zip(starts, [*starts[1:], len(keys)]):
                if out is None or keys[first] != now:
                    if out is not None:
                        close()
                    now, at, n = keys[first], f"{base}/{folder_of(*keys[first])}", n + 1
                    system.create_dir(at, recursive=True)
                    out = system.open_output_stream(f"{at}/.{SHARD_NAME}.part")
                for value in text[first:end]:
                    out.write((value or b"") + b"\n")
        if out is not None:
            close()
        yield pa.RecordBatch.from_arrays([pa.array([n], pa.int64())], names=["files"])

    return run


def write_text_shards(sharded_docs: DataFrame, path: str) -> None:
    """(source, split, shard_idx, doc_id, text) -> text files, one per shard; a null text is an empty line."""
    spark = sharded_docs.sparkSession
    root = whole_path(spark, path)
    delete_tables(spark, [root])
    (sharded_docs.select("source", "split", "shard_idx", "doc_id", F.col("text").cast("binary").alias("text"))
     .repartition("source", "split", "shard_idx")
     .sortWithinPartitions("source", "split", "shard_idx", "doc_id")
     .select("source", "split", "shard_idx", "text")
     .mapInArrow(_shard_writer(root), "files bigint").agg(F.sum("files")).collect())
    system, base = raw_folder(root)
    system.create_dir(base, recursive=True)
    system.open_output_stream(f"{base}/_SUCCESS").close()


def shard_files(reader, path: str | list[str]) -> DataFrame:
    """All lines (blank ones too) of shard files, with the file and block each comes from, by Spark's own scan: the driver holds some KB a file."""
    lines = reader.schema(SHARD_SCHEMA).format("text").option("pathGlobFilter", "*.txt").load(path)
    return lines.select("source", "split", "shard_idx", T.shard_id_expr(F.col("source"), F.col("split"), F.col("shard_idx")).alias("shard_id"),
                        F.make_valid_utf8("value").alias("line"), F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"))


def shard_of_folder(path: str) -> tuple[str | None, str | None, int | None]:
    """(source, split, shard_idx) of a file in a folder that ``folder_of`` names."""
    parts = dict(x.split("=", 1) for x in path.split("/")[:-1] if "=" in x)

    def value(name):
        text = parts.get(name, "__HIVE_DEFAULT_PARTITION__")
        return None if text == "__HIVE_DEFAULT_PARTITION__" else re.sub("%([0-9A-Fa-f]{2})", lambda m: chr(int(m[1], 16)), text)

    idx = value("shard_idx")
    return value("source"), value("split"), None if idx is None else int(idx)


#: Bytes of a range of a file; bytes of files that a task reads, where opening one counts as ``OPEN_BYTES``; bytes of lines that it hands on at once.
LINE_RANGE, TASK_BYTES, OPEN_BYTES, _HANDED = 8 << 20, 32 << 20, 16 << 10, 4 << 20
_TAIL = 64 << 10


def _range_lines(file, start: int, size: int) -> list[bytes]:
    """The lines that begin in a range, without their ends; a byte order mark at the file's start is none of the text."""
    back = 1 if start else 0
    file.seek(start - back)
    data = file.read(size + back)
    if back:                                    # the line that runs into the range belongs to an earlier one
        if data[:1] == b"\n" or (data[:1] == b"\r" and data[1:2] != b"\n"):
            data = data[1:]
        elif data[:2] == b"\r\n":
            data = data[2:]
        else:
            end = re.search(b"\r\n|\r|\n", data)
            data = data[end.end():] if end else b""
    if data and data[-1:] not in (b"\n", b"\r"):      # the last line goes on behind the range
        rest = [data]
        while more := file.read(_TAIL):
            end = re.search(b"[\r\n]", more)
            rest.append(more[:end.start()] + b"\n" if end else more)
            if end:
                break
        data = b"".join(rest)
    if not start and data[:3] == b"\xef\xbb\xbf":
        data = data[3:]
    return data.splitlines()


def _range_counter(root: str):
    """(path, start, n) of ranges (path, start, size): how many lines begin there."""
    def run(batches):
        system, base = raw_folder(root)
        for batch in batches:
            n = []
            for path, start, size in zip(*(batch.column(c).to_pylist() for c in ("path", "start", "size"))):
                with system.open_input_file(below(path, root, base)) as file:
                    n.append(len(_range_lines(file, start, size)))
            yield pa.RecordBatch.from_arrays([batch.column("path"), batch.column("start"), pa.array(n, pa.int64())], names=["path", "start", "n"])

    return run


_LINES = pa.schema([("source", pa.string()), ("split", pa.string()), ("shard_idx", pa.int32()), ("line_no", pa.int64()), ("line", pa.binary())])


def _range_reader(root: str):
    """The lines of ranges (path, start, size, before), numbered from ``before``."""
    def run(batches):
        system, base = raw_folder(root)
        rows, held = [], 0

        def table():
            columns = zip(*rows) if rows else [[]] * len(_LINES)
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, _LINES)], schema=_LINES)

        for batch in batches:
            for path, start, size, before in zip(*(batch.column(c).to_pylist() for c in ("path", "start", "size", "before"))):
                at = below(path, root, base)
                key = shard_of_folder(at[len(base):])
                with system.open_input_file(at) as file:
                    lines = _range_lines(file, start, size)
                for n, line in enumerate(lines, before):
                    rows.append((*key, n, line))
                    held += len(line) + 100
                    if held > _HANDED:
                        yield table()
                        rows, held = [], 0
        yield table()

    return run


def shard_lines(files: DataFrame, root: str) -> DataFrame:
    """Non-blank lines of shard files (path, length) under ``root`` with ``line_no``, the place in the file (blank lines count).

    ``files`` is a written table. A file is read in ranges of ``LINE_RANGE`` bytes; only where one has several are
    their lines counted first. Lines are not shuffled.
    """
    spark = files.sparkSession
    n, length, longest = files.agg(F.count("*"), F.coalesce(F.sum("length"), F.lit(0)), F.coalesce(F.max("length"), F.lit(0))).first()
    step = LINE_RANGE
    ranges = (files.filter("length > 0").withColumn("start", F.explode(F.sequence(F.lit(0).cast("long"), F.col("length") - 1, F.lit(step).cast("long"))))
              .select("path", "start", F.least(F.lit(step).cast("long"), F.col("length") - F.col("start")).alias("size"), (F.col("length") > step).alias("cut")))

    def dealt(rows: DataFrame) -> DataFrame:
        least = min(n + length // step, spark.sparkContext.defaultParallelism)
        return rows.repartition(int(min(max(least, (length + n * OPEN_BYTES) // TASK_BYTES, 1), MOST_TASKS)), "path", "start")

    if longest > step:
        counts = materialize(dealt(ranges.filter("cut")).mapInArrow(_range_counter(root), "path string, start bigint, n bigint"), "counts")
        w = Window.partitionBy("path").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
        before = counts.select("path", "start", F.coalesce(F.sum("n").over(w), F.lit(0)).alias("before"))
        ranges = ranges.join(before, ["path", "start"], "left").withColumn("before", F.coalesce("before", F.lit(0)))
    else:
        ranges = ranges.withColumn("before", F.lit(0).cast("long"))
    schema = "source string, split string, shard_idx int, line_no bigint, line binary"
    lines = dealt(ranges).select("path", "start", "size", "before").mapInArrow(_range_reader(root), schema)
    return (lines.withColumn("line", F.make_valid_utf8(F.col("line").cast("string"))).filter(T.not_blank(F.col("line")))
            .select("source", "split", "shard_idx", T.shard_id_expr(F.col("source"), F.col("split"), F.col("shard_idx")).alias("shard_id"), "line_no", "line"))


def read_text_shards(spark: SparkSession, path: str) -> DataFrame:
    """Non-blank lines with (shard_id, line_no)."""
    root = whole_path(spark, path)
    return shard_lines(list_tree(spark, root, ".txt"), root)


def read_named_shards(spark: SparkSession, path: str, files: list[str]) -> DataFrame:
    """S5 of the shard files of these names under the folder, a bounded number of them."""
    root = whole_path(spark, path)
    names = spark.createDataFrame([(f,) for f in files], "path string")
    return shard_lines(materialize(sizes_of(names, root), "sizes"), root)


#: Files of a micro-batch, whose names the driver holds. A batch costs some twenty jobs whatever is in it, and shard files are
#: small: with a few files a batch the jobs, not the shards, would make up the time.
FILES_PER_BATCH = 32_768

ARRIVAL_SCHEMA = "path string, shard_id string, arrival bigint"


def _shard_names(root: str):
    """(path, source, split, shard_idx) of files (path) under ``root``."""
    def run(batches):
        for batch in batches:
            paths = batch.column("path").to_pylist()
            keys = [shard_of_folder(p[len(root):]) for p in paths]
            yield pa.RecordBatch.from_arrays([pa.array(paths, pa.string()), *(pa.array([k[i] for k in keys], t) for i, t in enumerate((pa.string(), pa.string(), pa.int32())))],
                                             names=["path", "source", "split", "shard_idx"])

    return run


def _planned(spark: SparkSession, checkpoint: str) -> DataFrame | None:
    """Names (path) that the lists of a checkpoint have; in one of before there were lists, those in the stream's own log."""
    try:
        names = spark.read.schema(ARRIVAL_SCHEMA).parquet(f"{checkpoint}/arrivals").select("path")
    except AnalysisException:                   # no list yet
        names = None
    try:
        log = spark.read.text(f"{checkpoint}/sources/0").select(F.get_json_object("value", "$.path").alias("path")).filter("path like '%.txt'")
    except AnalysisException:                   # no stream yet
        return names
    plain = F.regexp_replace(F.url_decode(F.replace("path", F.lit("+"), F.lit("%2B"))), "^file:/+", "file:/")
    log = log.select(plain.alias("path"))
    return log if names is None else names.unionByName(log)


def stream_arrivals(spark: SparkSession, path: str, checkpoint: str, max_files: int = FILES_PER_BATCH) -> DataFrame:
    """(path, shard_id) of every shard file that the checkpoint's stream has not had, ``max_files`` a micro-batch; the files themselves are not read.

    The names are listed by tasks and written in the checkpoint as lists of ``max_files`` names; the stream is one of lists, so
    that its source, which holds all names of its files on the driver, holds one for each batch. A list that is written is
    a batch to come whatever happens to the run.
    """
    root = whole_path(spark, path)
    names = list_tree(spark, root, ".txt").select("path").mapInArrow(_shard_names(root), "path string, source string, split string, shard_idx int")
    new = names.select("path", T.shard_id_expr(F.col("source"), F.col("split"), F.col("shard_idx")).alias("shard_id"))
    planned = _planned(spark, checkpoint)
    if planned is not None:
        new = new.join(planned, "path", "left_anti")
    lists = global_ordinal(new, [], ["shard_id", "path"], "_at").withColumn("arrival", F.floor(F.col("_at") / max_files))
    lists.drop("_at").repartition("arrival").write.mode("append").partitionBy("arrival").parquet(f"{checkpoint}/arrivals")
    return spark.readStream.schema(ARRIVAL_SCHEMA).option("maxFilesPerTrigger", 1).parquet(f"{checkpoint}/arrivals").select("path", "shard_id")
