"""Session and checkpoint helpers."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyarrow import fs as pafs
from pyspark import SparkConf
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def get_spark(master: str | None = None, app: str = "reviewlab",
              shuffle_partitions: int | None = None) -> SparkSession:
    """Return a session tuned for the operators in this package.

    What the caller, spark-submit or spark-defaults has set stays; only unset
    values are filled in.  Without any master it is a local session of
    ``$BENCH_CPUS`` threads with as many shuffle partitions.
    """
    conf = SparkConf()
    cpus = os.environ.get("BENCH_CPUS", "8")
    b = SparkSession.builder.appName(app)
    master = master or os.environ.get("SPARK_MASTER")
    local = (master or conf.get("spark.master", "local")).startswith("local")
    wanted = {"spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false", "spark.sql.adaptive.enabled": "true",
              "spark.sql.adaptive.coalescePartitions.enabled": "true", "spark.sql.adaptive.skewJoin.enabled": "true",
              "spark.sql.session.timeZone": "UTC", "spark.sql.execution.arrow.pyspark.enabled": "true"}
    if local:
        wanted |= {"spark.master": f"local[{cpus}]", "spark.sql.shuffle.partitions": cpus,
                   "spark.driver.memory": os.environ.get("SPARK_DRIVER_MEMORY", "16g")}
    for key, value in wanted.items():
        if not conf.contains(key):
            b = b.config(key, value)
    if master:
        b = b.master(master)
    if shuffle_partitions:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Make reliable checkpoints work and return their folder.

    The folder comes from ``spark.checkpoint.dir`` in the session.  Only when
    that is unset *and* the master is local (tests, benchmarks) do we pick a
    fresh folder ourselves; on a cluster an unset folder is an error, because
    a machine-local path would not survive executor loss.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf_dir = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir")
    if not conf_dir:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a shared folder (HDFS/S3/ABFS)")
        conf_dir = tempfile.mkdtemp(prefix="reviewlab-ckpt-", dir="/tmp")
        spark.conf.set("spark.checkpoint.dir", conf_dir)
    sc.setCheckpointDir(conf_dir)
    return sc.getCheckpointDir() or conf_dir


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint (never ``localCheckpoint``): survives executor loss."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder name (URI) under the shared folder; created by whoever writes first."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def stash(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet in the shared folder and read it back.

    Cuts the lineage like a reliable checkpoint, but columnar and compressed, and the
    optimizer sees the real size: a checkpoint keeps the estimate of the plan before
    it, which a loop of joins multiplies each round until planning itself fails.
    """
    path = scratch_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


#: Rows of a small table (ids or names, tens of bytes each) up to which it is broadcast.
FEW_ROWS = 500_000


def few(rows: DataFrame, limit: int = FEW_ROWS) -> DataFrame:
    """A written table, broadcast while its counted rows are within ``limit``, so that the large side of a join
    stays where it is; beyond it, as it is."""
    return F.broadcast(rows) if rows.count() <= limit else rows


def file_system(uri: str) -> tuple[pafs.FileSystem, str]:
    """The pyarrow file system of a URI and the path in it (``file:/x`` is taken as ``file:///x``)."""
    if uri.startswith("file:/") and not uri.startswith("file://"):
        uri = "file://" + uri[len("file:"):]
    if "://" not in uri:
        return pafs.LocalFileSystem(), uri
    return pafs.FileSystem.from_uri(uri)


def ensure_parallelism(df: DataFrame, min_partitions: int | None = None, keys=None) -> DataFrame:
    """Spread a scan that arrives in fewer partitions than the cluster has
    cores (a single-row-group file, for instance) before CPU-heavy work.

    Large inputs already arrive in many splits, so on a cluster this adds no
    shuffle; it only matters for small, unsplittable files.
    """
    spark = df.sparkSession
    want = min_partitions or spark.sparkContext.defaultParallelism
    if df.rdd.getNumPartitions() < want:
        # hashing on a key is deterministic under task retries without the
        # sort a round-robin repartition needs
        return df.repartition(want, *keys) if keys else df.repartition(want)
    return df
