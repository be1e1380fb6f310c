"""Session helpers: a tuned local session for tests/bench, and shared-folder
lookup for checkpoints and sink output.

On a cluster the session is created by the caller (spark-submit); we only
read ``spark.checkpoint.dir`` from it. A private folder is made only when the
session runs in local mode and nothing is configured (tests, bench).
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def local_session(cpus: int | str = "*", shuffle_partitions: int = 8, app: str = "tagloom") -> SparkSession:
    builder = SparkSession.builder.master(f"local[{cpus}]").appName(app)
    for k, v in DEFAULT_CONF.items():
        builder = builder.config(k, v)
    builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    builder = builder.config("spark.driver.memory", os.environ.get("TAGLOOM_DRIVER_MEMORY", "16g"))
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def _is_local(spark: SparkSession) -> bool:
    try:
        return spark.sparkContext.master.startswith("local")
    except Exception:  # Spark Connect has no SparkContext
        return False


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder of this session.

    Uses ``spark.checkpoint.dir`` when the cluster names one; falls back to a
    fresh private folder only in local mode, where "shared" means this host.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if not conf:
        if not _is_local(spark):
            raise RuntimeError("spark.checkpoint.dir is not set; point it at a shared folder")
        conf = tempfile.mkdtemp(prefix="tagloom-ckpt-")
    sc.setCheckpointDir(conf)
    return sc.getCheckpointDir()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique output path beside the checkpoint folder (shared storage)."""
    base = checkpoint_dir(spark).rstrip("/")
    return f"{base}/tagloom-out/{uuid.uuid4().hex}/{name}"


def gathered(df):
    """``df`` in at most two partitions a core, without a shuffle: for jobs whose every task gives a result of fixed size (a gradient),
    so that what comes together grows with the cluster and not with the rows."""
    return df.coalesce(max(1, 2 * df.sparkSession.sparkContext.defaultParallelism))


_STORED: dict[int, list[str]] = {}


def stored(df, name: str):
    """``df`` written beneath the checkpoint folder and read back: a lost executor costs no recomputation of what
    went before, and row numbers made before the write stay as they are."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    _STORED.setdefault(id(spark), []).append(path)
    return spark.read.schema(df.schema).parquet(path)


def release_stored(spark: SparkSession) -> int:
    """Delete the tables that :func:`stored` made in this session; call it once the results built on them are written."""
    paths = _STORED.pop(id(spark), [])
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    for p in paths:
        path = jvm.org.apache.hadoop.fs.Path(p)
        path.getFileSystem(conf).delete(path, True)
    return len(paths)


#: Rows of a batch that Spark hands to a Python worker, where texts are among them (Spark's own default is 10,000).
BATCH_ROWS = 1_000


def text_batches(spark: SparkSession) -> None:
    """Lower the session's Arrow batches to ``BATCH_ROWS`` rows: a batch of whole texts is held several times over, in the JVM and in
    the worker, so its size counts against both. A lower setting of the caller's stays."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    now = int(spark.conf.get(name, "10000"))
    if now <= 0 or now > BATCH_ROWS:
        spark.conf.set(name, str(BATCH_ROWS))


def table_path(sf_dir: str, name: str) -> str:
    return f"{sf_dir.rstrip('/')}/{name}.parquet"


#: Tables up to this size (as Spark estimates it) may be dealt anew to all cores.
SPREAD_BYTES = 256 << 20


def spread(df):
    """Deal the rows of a small table over the cores when it scans as fewer partitions.

    A small table stored as one row group scans as one partition, so all per-row text work would run on
    one core. Only tables of at most ``SPREAD_BYTES`` are dealt anew, whatever the cluster's size;
    larger ones are never shuffled for it.
    """
    target = df.sparkSession.sparkContext.defaultParallelism
    size = int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())
    if size <= SPREAD_BYTES and df.rdd.getNumPartitions() < target:
        return df.repartition(target)
    return df


def read_parquet_table(spark: SparkSession, sf_dir: str, name: str):
    return spread(spark.read.parquet(table_path(sf_dir, name)))
