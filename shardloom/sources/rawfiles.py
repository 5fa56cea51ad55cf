"""Raw files by byte ranges: listed by Spark, read inside tasks, never whole in memory.

``binaryFile`` gives names and lengths of files (its content column, which a file of
2 GB or more does not fit in, is not touched), but the driver then holds some KB for each; ``list_tree`` lists any
number of files, as a table that tasks write. Ranges of a file are rows of a DataFrame, dealt over the tasks.
"""

from __future__ import annotations

import hashlib
from urllib.parse import quote

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import LISTING_TASKS, listing, materialize, whole_path

RANGE_BYTES = 32 << 20
CHUNK_BYTES = 8 << 20
MOST_TASKS = 10_000


def raw_folder(path: str) -> tuple[fs.FileSystem, str]:
    """The file system of a path with its scheme, and the path there (``file:`` paths are local or mounted ones)."""
    scheme, _, rest = path.partition(":")
    if scheme == "file":
        return fs.LocalFileSystem(), "/" + rest.strip("/")
    system, name = fs.FileSystem.from_uri(quote(path, safe="/:@"))
    return system, name.rstrip("/")


def open_raw(path: str) -> pa.NativeFile:
    """A file by the name that Spark gives it; ``file:`` names are local (or mounted) paths, others go by their scheme."""
    scheme, _, rest = path.partition(":")
    if scheme == "file" or not rest:
        return fs.LocalFileSystem().open_input_file("/" + rest.lstrip("/") if rest else path)
    system, name = fs.FileSystem.from_uri(quote(path, safe="/:@"))
    return system.open_input_file(name)


def list_raw(spark: SparkSession, path: str, pattern: str) -> DataFrame:
    """(path, length) of the files under a folder."""
    with listing(spark):
        files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", pattern).load(path)
    return files.select("path", "length")


#: Folders that a task lists, and rows of a listing that it hands on at once.
FOLDERS_PER_TASK = 1_000
_LISTED = 10_000


def _children(root: str, suffix: str):
    """What is in folders given by their names below ``root``: (name, length), the length of a folder is null."""
    def run(batches):
        system, base = raw_folder(root)
        for batch in batches:
            for folder in batch.column("name").to_pylist():
                found = []
                for info in system.get_file_info(fs.FileSelector(f"{base}{folder}")):
                    name = info.base_name
                    if name.startswith(".") or (name.startswith("_") and "=" not in name):      # what Spark's listings leave out
                        continue
                    if info.type == fs.FileType.Directory:
                        found.append((f"{folder}/{name}", None))
                    elif name.endswith(suffix):
                        found.append((f"{folder}/{name}", info.size))
                for i in range(0, len(found), _LISTED):
                    names, lengths = zip(*found[i:i + _LISTED])
                    yield pa.RecordBatch.from_arrays([pa.array(names, pa.string()), pa.array(lengths, pa.int64())], names=["name", "length"])

    return run


def list_tree(spark: SparkSession, root: str, suffix: str) -> DataFrame:
    """(path, length) of the files under ``root``, which has its scheme, whose names end so: a written table.

    Folders are listed level by level, each level by many tasks; the driver holds no name. Names that begin with
    a point or an underscore are left out, as in Spark's listings, and files without bytes are, as in its file scans.
    """
    folders, levels, n = spark.createDataFrame([("",)], "name string"), [], 1
    while n:
        tasks = min(n, max(LISTING_TASKS, n // FOLDERS_PER_TASK), MOST_TASKS)
        found = materialize(folders.repartition(tasks, "name").mapInArrow(_children(root, suffix), "name string, length bigint"), "listing")
        levels.append(found.filter("length > 0"))
        folders = found.filter("length is null").select("name")
        n = folders.count()
    files = levels[0]
    for level in levels[1:]:
        files = files.unionByName(level)
    return files.select(F.concat(F.lit(root), "name").alias("path"), "length")


def sizes_of(names: DataFrame, root: str) -> DataFrame:
    """(path, length) of the files of ``names`` (path) under ``root``, looked up by tasks; a file that is not there is an error."""
    def run(batches):
        system, base = raw_folder(root)
        for batch in batches:
            paths = batch.column("path").to_pylist()
            infos = system.get_file_info([below(p, root, base) for p in paths])
            for info in infos:
                if info.type != fs.FileType.File:
                    raise FileNotFoundError(f"no such file: {info.path}")
            yield pa.RecordBatch.from_arrays([pa.array(paths, pa.string()), pa.array([i.size for i in infos], pa.int64())], names=["path", "length"])

    return names.select("path").mapInArrow(run, "path string, length bigint")


def below(path: str, root: str, base: str) -> str:
    """A path under ``root`` as the file system of ``raw_folder`` names it."""
    if not path.startswith(f"{root}/"):
        raise ValueError(f"{path} is not under {root}")
    return base + path[len(root):]


def byte_ranges(files: DataFrame, unit: int, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """The files of (path, length, ...) cut into (path, start, size, ...), starts and sizes in whole ``unit`` bytes.

    A rest shorter than a unit at a file's end is in no range. Each range is a task, up to ``MOST_TASKS``.
    """
    step = max(range_bytes // unit, 1) * unit
    whole = F.col("length") - F.col("length") % unit
    cut = files.filter(whole > 0).withColumn("start", F.explode(F.sequence(F.lit(0).cast("long"), whole - 1, F.lit(step).cast("long"))))
    rows = cut.withColumn("size", F.least(F.lit(step).cast("long"), whole - F.col("start"))).drop("length")
    return dealt(rows, "path", "start")


def dealt(rows: DataFrame, *by: str) -> DataFrame:
    """Small rows that stand for much work, one a task: their number is counted, as adaptive execution would put them together by size."""
    return rows.repartition(min(max(rows.count(), 1), MOST_TASKS), *by)


def sha256_of(files: DataFrame) -> DataFrame:
    """(path, length, file_checksum) of (path, length): each file is read once, ``CHUNK_BYTES`` at a time."""
    def run(batches):
        for batch in batches:
            sums = []
            for path in batch.column("path").to_pylist():
                digest = hashlib.sha256()
                with open_raw(path) as f:
                    while chunk := f.read(CHUNK_BYTES):
                        digest.update(chunk)
                sums.append(digest.hexdigest())
            yield pa.RecordBatch.from_arrays([batch.column("path"), batch.column("length"), pa.array(sums, pa.string())], names=["path", "length", "file_checksum"])

    return files.select("path", "length").mapInArrow(run, "path string, length bigint, file_checksum string")
