"""Session helpers: building a session, the checkpoint folder, written stage tables."""

from __future__ import annotations

import os
import tempfile
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def build_session(master: str | None = None, app: str = "shardloom",
                  shuffle_partitions: int | None = None, extra: dict | None = None) -> SparkSession:
    """Session with AQE on, UI off and UTC time; used by tests, bench and examples."""
    master = master or os.environ.get("SHARDLOOM_MASTER", "local[8]")
    b = (SparkSession.builder.master(master).appName(app)
         .config("spark.ui.enabled", "false")
         .config("spark.ui.showConsoleProgress", "false")
         .config("spark.sql.adaptive.enabled", "true")
         .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
         .config("spark.sql.adaptive.skewJoin.enabled", "true")
         .config("spark.sql.session.timeZone", "UTC")
         .config("spark.sql.execution.arrow.pyspark.enabled", "true")
         .config("spark.driver.memory", os.environ.get("SHARDLOOM_DRIVER_MEM", "16g")))
    if shuffle_partitions:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in (extra or {}).items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    ship_package(spark)
    return spark


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Make ``shardloom`` importable in Python workers (Arrow UDFs pickle by reference).

    The package is zipped once per SparkContext and added with ``addPyFile``, which
    distributes it to every executor, as a cluster deployment would.
    """
    sc = spark.sparkContext
    key = sc.applicationId
    if key in _SHIPPED:
        return
    import shutil
    pkg_dir = os.path.dirname(os.path.abspath(__file__))
    out = tempfile.mkdtemp(prefix="shardloom-pkg-", dir="/tmp")
    archive = shutil.make_archive(os.path.join(out, "shardloom"), "zip",
                                  root_dir=os.path.dirname(pkg_dir), base_dir="shardloom")
    sc.addPyFile(archive)
    _SHIPPED.add(key)


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by the cluster.

    The folder comes from ``spark.checkpoint.dir``. Only a local-mode session (tests,
    bench) without one gets a fresh scratch folder; a cluster session without it is an
    error, because a machine-local folder would not survive executor loss.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf = spark.conf.get("spark.checkpoint.dir", None)
    if conf:
        sc.setCheckpointDir(conf)
        return sc.getCheckpointDir()
    if not sc.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
    sc.setCheckpointDir(tempfile.mkdtemp(prefix="shardloom-ckpt-", dir="/tmp"))
    return sc.getCheckpointDir()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared checkpoint folder for intermediate tables."""
    import uuid
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/tables/{name}-{uuid.uuid4().hex[:12]}"


def whole_path(spark: SparkSession, path: str) -> str:
    """The path with its scheme, as Spark would resolve it."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).makeQualified(at).toString()


#: Spark lists many folders in a job of up to 10,000 tasks, one folder each; a folder takes far less time than a task.
LISTING_TASKS = 64


@contextmanager
def listing(spark: SparkSession):
    """File listings in this block (and of streams started in it) take ``LISTING_TASKS`` tasks at most, each for many folders."""
    conf, name = spark.conf, "spark.sql.sources.parallelPartitionDiscovery.parallelism"
    before = conf.get(name)
    conf.set(name, str(LISTING_TASKS))
    try:
        yield
    finally:
        conf.set(name, before)


_WRITTEN: dict[str, list[str]] = {}


def delete_tables(spark: SparkSession, paths: list[str]) -> None:
    """Remove written tables through the file system they are on."""
    hadoop = spark.sparkContext._jsc.hadoopConfiguration()
    for p in paths:
        path = spark._jvm.org.apache.hadoop.fs.Path(p)
        path.getFileSystem(hadoop).delete(path, True)


def drop_written(spark: SparkSession) -> None:
    """Remove every table that ``materialize`` has written in this application (its results must have been used)."""
    app = spark.sparkContext.applicationId
    delete_tables(spark, _WRITTEN.pop(app, []))
    for key in [k for k in _SHARED if k[0] == app]:
        del _SHARED[key]


_SHARED: dict[tuple, DataFrame] = {}


def shared(spark: SparkSession, name: str, key, make) -> DataFrame:
    """What ``make`` gives, made once per application and key (until ``drop_written``): a table that several steps read."""
    at = (spark.sparkContext.applicationId, name, key)
    if at not in _SHARED:
        _SHARED[at] = make()
    return _SHARED[at]


def drop_tables(spark: SparkSession, *tables: DataFrame) -> None:
    """Remove tables of ``materialize`` that nothing reads any more."""
    written = _WRITTEN.get(spark.sparkContext.applicationId, [])
    for table in tables:
        files = table.inputFiles()
        gone = [p for p in written if any(p.rsplit("/", 1)[-1] in f.split("/") for f in files)]
        delete_tables(spark, gone)
        for p in gone:
            written.remove(p)


def materialize(df: DataFrame, name: str = "stage") -> DataFrame:
    """Cut lineage with a written table in the shared checkpoint folder.

    One job writes parquet and the result reads it back: unlike an eager RDD checkpoint
    it computes the plan once, survives executor loss, and later reads get column
    pruning and filter pushdown. Tables stay until ``drop_written``, since lazy results read them.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.mode("overwrite").parquet(path)
    _WRITTEN.setdefault(df.sparkSession.sparkContext.applicationId, []).append(path)
    return df.sparkSession.read.parquet(path)


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
