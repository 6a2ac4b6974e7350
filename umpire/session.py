"""Session construction and the shared working folder.

On a cluster the session is handed to us already configured; ``shared_dir``
then reads ``spark.checkpoint.dir`` from it.  Only a local/test session with
that setting unset gets a scratch folder of our own.
"""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import SparkSession

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def local_session(cores: int = 8, shuffle_partitions: int | None = None,
                  app: str = "umpire") -> SparkSession:
    """A local session tuned like the cluster one (AQE, UTC, Arrow)."""
    parts = shuffle_partitions or cores
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(parts))
        .config("spark.default.parallelism", str(parts))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", "16g")
        .config("spark.ui.enabled", "false")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .config("spark.sql.streaming.stateStore.providerClass",
                "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The cluster's shared checkpoint folder, registered with the context.

    Read from ``spark.checkpoint.dir``.  Only a local session may go without:
    it gets a scratch folder of its own.  On a cluster a folder that only the
    driver sees would lose data, so an unset folder is an error there.
    """
    context = spark.sparkContext
    base = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not base:
        if not re.match(r"local(\[|$)", context.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        base = tempfile.mkdtemp(prefix="umpire-ckpt-")
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(base)
    return base


def shared_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder under the cluster's shared checkpoint location.

    The location comes from ``spark.checkpoint.dir``; only when that is unset
    (local runs and tests) a scratch folder is created and registered.
    """
    base = ensure_checkpoint_dir(spark)
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex[:12]}"


def table(spark: SparkSession, sf_dir: str, name: str):
    """One of the given parquet tables."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def input_stamp(spark: SparkSession, sf_dir: str, *names: str) -> tuple:
    """Files, lengths and times of given tables: what a step result was made from."""
    jvm, out = spark.sparkContext._jvm, []
    for name in names:
        path = jvm.org.apache.hadoop.fs.Path(f"{sf_dir.rstrip('/')}/{name}.parquet")
        found = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        if found.exists(path):
            out += [(f.getPath().toString(), f.getLen(), f.getModificationTime()) for f in found.listStatus(path)]
    return (spark.sparkContext.applicationId, sf_dir, *sorted(out))
