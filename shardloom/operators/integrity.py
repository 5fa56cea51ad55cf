"""Output verification and cleanup eligibility.

Files are described by a listing table (path, length[, file_checksum]); the listing of a
real folder comes from the ``binaryFile`` source with the content column pruned, so
only metadata is read. Deletion itself is not performed: the result is a report.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import listing
from ..sources.rawfiles import dealt, sha256_of
from . import ledger as L

# Paths that are never deletable (substring match, as in the original).
PROTECTED_PATTERNS = [
    "checkpoints/",
    "tokenizer/",
    "logs/",
    "data/manifests/",
    "data/tokenized/train_packed.bin",
    "data/tokenized/validation_packed.bin",
    "data/tokenized/test_packed.bin",
]
SEQ_LEN = 512
DTYPE_BYTES = 2


def list_files(spark: SparkSession, root: str, glob: str | None = None) -> DataFrame:
    """S17 listing: (path, length, modificationTime) of every file under ``root``."""
    r = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    if glob:
        r = r.option("pathGlobFilter", glob)
    with listing(spark):
        files = r.load(root)
    return files.select("path", "length", "modificationTime")


#: Files of this size or more are read in chunks; smaller ones are rows of ``binaryFile``.
STREAMED_BYTES = 64 << 20


def file_checksums(spark: SparkSession, root: str, glob: str | None = None, streamed: int = STREAMED_BYTES) -> DataFrame:
    """SHA-256 of each file's bytes, whatever its size: a large file is never whole in memory.

    A file without bytes has no row: Spark's file scans leave it out.
    """
    r = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    if glob:
        r = r.option("pathGlobFilter", glob)
    with listing(spark):
        files = r.load(root)
    small = files.filter(F.col("length") < streamed).select("path", "length", F.sha2(F.col("content"), 256).alias("file_checksum"))
    large = files.select("path", "length").filter(F.col("length") >= streamed)
    return small.unionByName(sha256_of(dealt(large, "path")))


def validate_bin(length: Column, exists: Column, seq_len: int = SEQ_LEN, dtype_bytes: int = DTYPE_BYTES):
    """K3: (valid, num_tokens, problem) of a packed binary; the first test that fails names the problem."""
    n_tok = F.floor(length / dtype_bytes).cast("long")
    problem = (F.when(~exists, F.lit("missing"))
               .when(length == 0, F.lit("empty"))
               .when(F.pmod(length, F.lit(dtype_bytes)) != 0, F.lit("odd_size"))
               .when(n_tok < seq_len + 1, F.lit("too_short"))
               .otherwise(F.lit("")))
    valid = problem == ""
    return valid, F.when(valid, n_tok).otherwise(F.lit(0).cast("long")), problem


def validate_files(files: DataFrame, seq_len: int = SEQ_LEN) -> DataFrame:
    """K3 over a listing that may hold missing files (``length`` NULL)."""
    valid, n, problem = validate_bin(F.col("length"), F.col("length").isNotNull(), seq_len)
    return files.select("path", valid.alias("valid"), n.alias("num_tokens"), problem.alias("problem"))


def verify_outputs(ledger: DataFrame, files: DataFrame, seq_len: int = SEQ_LEN) -> DataFrame:
    """Every verified/done entry against the files: missing, checksum, structure, ok.

    ``files``: (path, length, file_checksum). An empty recorded checksum skips the compare.
    """
    ent = L.verified(ledger)
    j = ent.join(files.withColumnRenamed("path", "output_path"), "output_path", "left")
    exists = F.col("length").isNotNull()
    valid, _, problem = validate_bin(F.col("length"), exists, seq_len)
    mismatch = (F.col("checksum") != "") & (F.col("file_checksum") != F.col("checksum"))
    is_bin = F.col("output_path").endswith(".bin")
    verdict = (F.when(~exists, F.lit("missing"))
               .when(mismatch, F.lit("checksum_mismatch"))
               .when(is_bin & ~valid, F.concat(F.lit("bad_bin:"), problem))
               .otherwise(F.lit("ok")))
    return j.select("stage", "shard_id", "output_path", verdict.alias("verdict"))


def is_protected(path: Column, patterns: list[str] = PROTECTED_PATTERNS) -> Column:
    """substring of any protected pattern (so 'blogs/' matches 'logs/')."""
    pats = F.array(*[F.lit(p) for p in patterns])
    return F.exists(pats, lambda p: F.contains(path, p))


def dir_is_protected(path: Column, patterns: list[str] = PROTECTED_PATTERNS) -> Column:
    """The stricter directory guard: the pattern without its trailing slash."""
    pats = F.array(*[F.lit(p.rstrip("/")) for p in patterns])
    return F.exists(pats, lambda p: F.contains(path, p))


def deletable(listing: DataFrame, patterns: list[str] = PROTECTED_PATTERNS) -> DataFrame:
    return listing.filter(~is_protected(F.col("path"), patterns))


def cleanup_bytes(listing: DataFrame, group_cols: list[str] | None = None) -> DataFrame:
    """Bytes and files that a cleanup would delete."""
    g = deletable(listing).groupBy(*(group_cols or []))
    return g.agg(F.coalesce(F.sum("length"), F.lit(0)).cast("long").alias("deleted_bytes"),
                 F.count(F.lit(1)).alias("deleted_files"))


def cleanup_report(ledger: DataFrame, files: DataFrame, listing: DataFrame,
                   artifact_dirs: DataFrame, seq_len: int = SEQ_LEN) -> DataFrame:
    """R6 (always a dry run): per stage, skipped / error / files / bytes.

    Gates in order: downstream complete (A4), every verified entry passes J4 (first
    failure by shard id reported), the artifact folder is not protected; then the
    deletable files of the folder. ``artifact_dirs``: (stage, artifact_dir);
    ``listing``: (stage, path, length) = files under each stage's folder.
    """
    summ = L.summary(ledger).select("stage", (F.col("done") == F.col("total")).alias("complete"))
    ver = verify_outputs(ledger, files, seq_len)
    bad = ver.filter(F.col("verdict") != "ok").groupBy("stage").agg(F.min(F.struct("shard_id", "verdict")).alias("bad"))
    n_ver = L.verified(ledger).groupBy("stage").agg(F.count(F.lit(1)).alias("n_verified"))
    per_stage = (deletable(listing).groupBy("stage")
                 .agg(F.sum("length").cast("long").alias("bytes"), F.count(F.lit(1)).alias("files")))
    r = (artifact_dirs.join(summ, "stage", "left").join(bad, "stage", "left")
         .join(n_ver, "stage", "left").join(per_stage, "stage", "left"))
    err = (F.when(~F.coalesce("complete", F.lit(False)), F.lit("incomplete"))
           .when(F.coalesce("n_verified", F.lit(0)) == 0, F.lit("nothing_verified"))
           .when(F.col("bad").isNotNull(), F.concat_ws(" ", "bad.verdict", "bad.shard_id"))
           .when(dir_is_protected(F.col("artifact_dir")), F.lit("protected"))
           .otherwise(F.lit("")))
    go = err == ""
    return r.select("stage", "artifact_dir", (~go).alias("skipped"), err.alias("error"),
                    F.when(go, F.coalesce("files", F.lit(0))).otherwise(F.lit(0)).cast("long").alias("deleted_files"),
                    F.when(go, F.coalesce("bytes", F.lit(0))).otherwise(F.lit(0)).cast("long").alias("deleted_bytes"),
                    F.lit(True).alias("dry_run"))


def storage_summary(listing: DataFrame, root: str, labels: list[tuple[str, str]]) -> DataFrame:
    """Bytes per labelled folder, folders given relative to ``root`` (``*`` = any one level).

    Labels nest, so a file counts for every folder it lies in; the label list is a literal array,
    matched per row without a join.
    """
    base = F.regexp_replace("path", "^[^:/]+:/*", "/")
    rest = F.substring(base, F.length(F.lit("/" + root.split(":", 1)[-1].strip("/") + "/")) + 1, 1 << 30)
    arr = F.array(*[F.struct(F.lit(lab).alias("label"), F.lit("^" + "/".join("[^/]+" if p == "*" else re.escape(p) for p in pre.strip("/").split("/") if p) + ("/" if pre else ""))
                             .alias("folder")) for lab, pre in labels])
    hits = listing.select("length", rest.alias("rest")).select("length", F.explode(F.filter(arr, lambda x: F.regexp_like("rest", x["folder"]))).alias("hit"))
    return hits.groupBy(F.col("hit.label").alias("label")).agg(
        F.sum("length").cast("long").alias("bytes"), F.count(F.lit(1)).alias("files"))
