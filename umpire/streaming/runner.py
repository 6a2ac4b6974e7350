"""Stream sources over the given tables, and runs that stop when all is read.

A stream reads one table's parquet file through a one-file glob (the file
source needs a directory or a pattern).  Results are written to parquet
under the cluster's shared checkpoint folder, with the query checkpoint next
to them.

A run under a ``folder`` of its own is a named query: the next run under that
folder goes on from the stored offsets and state, reads only what is new and adds
to the same sink.  Watermarks move with the data, so the last windows of a run stay
open; they close in a later run, or when a tick is read (``ticking``, ``tick``).
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from umpire.session import ensure_checkpoint_dir, shared_dir

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
MAX_FILES = 1000


def table_stream(spark: SparkSession, sf_dir: str, name: str, max_files: int | None = MAX_FILES) -> DataFrame:
    """Streaming read of one given table (schema taken from the data), ``max_files`` files
    a micro-batch.

    A table stored as a folder of parquet files is streamed as that folder;
    a single file is streamed through a one-file glob."""
    full = f"{sf_dir.rstrip('/')}/{name}.parquet"
    path = full if _is_dir(spark, full) else f"{sf_dir.rstrip('/')}/{name[:-1]}[{name[-1]}].parquet"
    schema = spark.read.parquet(full).schema
    reader = spark.readStream.schema(schema)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    df = reader.parquet(path)
    # Watermarks need TIMESTAMP; wall-clock (NTZ) columns are read in the session time zone.
    return df.select(*[F.col(f.name).cast("timestamp").alias(f.name)
                       if isinstance(f.dataType, T.TimestampNTZType) else F.col(f.name)
                       for f in df.schema.fields])


def named_folder(spark: SparkSession, name: str) -> str:
    """The folder of a named query: the same at every start of the same name."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/streams/{name}"


def run_available_now(df: DataFrame, name: str, mode: str = "append",
                      foreach: Callable[[DataFrame, int, str], None] | None = None,
                      state_partitions: int | None = None, folder: str | None = None,
                      reader: Callable[[SparkSession, str], DataFrame] | None = None) -> DataFrame:
    """Process everything available, then stop; return the sink as a table.

    With ``folder`` the run goes on where the last one under it ended; without, it
    starts anew in a fresh folder.  ``foreach(batch_df, epoch_id, path)`` replaces the
    parquet sink when a micro-batch needs custom writing (it must be idempotent per
    epoch), and ``reader(spark, path)`` reads what it wrote.  A new stateful query fixes its state partitions at start from the
    shuffle-partition setting; they default to the cluster's parallelism
    (capped by that setting) and are kept in the checkpoint afterwards.  The session's
    settings are as before once the query has started.
    """
    spark = df.sparkSession
    base = folder or shared_dir(spark, name)
    data = f"{base}/data"
    shuffle = int(spark.conf.get("spark.sql.shuffle.partitions"))
    parts = state_partitions or min(shuffle, spark.sparkContext.defaultParallelism)
    w = (df.writeStream.option("checkpointLocation", f"{base}/_checkpoint")
         .outputMode(mode).trigger(availableNow=True))
    with _settings(spark, {"spark.sql.shuffle.partitions": str(parts), "spark.sql.streaming.stateStore.providerClass": ROCKSDB}):
        q = (w.foreachBatch(lambda b, e: foreach(b, e, data)) if foreach is not None
             else w.format("parquet")).start(*([] if foreach is not None else [data]))
    q.awaitTermination()
    if foreach is not None:
        if not _exists(spark, data):
            return spark.createDataFrame([], df.schema)
        return reader(spark, data) if reader else spark.read.parquet(data)
    return spark.read.schema(df.schema).parquet(data)


# ------------------------------------------------------------------ ticks
TICKS = T.StructType([T.StructField("at", T.TimestampType())])


def ticking(stream: DataFrame, folder: str, ts: str = "ts", key: str | None = None) -> DataFrame:
    """The stream, and the ticks of a folder: rows with a time alone and ``tick`` true.

    Where the stream is joined by a string ``key``, ticks need one too: the join drops rows
    without a key before they move the watermark.  A tick moves the watermark as data would; drop it by :func:`after_watermark`."""
    spark = stream.sparkSession
    path = f"{folder}/ticks"
    if not _exists(spark, path):
        spark.createDataFrame([], TICKS).write.parquet(path)
    ticks = spark.readStream.schema(TICKS).parquet(path).select(
        F.col("at").alias(ts), F.lit(True).alias("tick"), *([F.lit("tick").alias(key)] if key else []))
    return stream.withColumn("tick", F.lit(False)).unionByName(ticks, allowMissingColumns=True)


def tick(spark: SparkSession, folder: str, at: dt.datetime) -> None:
    """Add a tick; the next run under the folder reads it."""
    spark.createDataFrame([(at,)], TICKS).coalesce(1).write.mode("append").parquet(f"{folder}/ticks")


def after_watermark(stream: DataFrame, condition: Column, ts: str) -> DataFrame:
    """Filter the rows of a watermarked stream, so that all of them still move the watermark.

    A plain filter would be pushed below the watermark; one that reads the event time is not."""
    time = F.coalesce(F.unix_micros(F.col(ts)), F.lit(0))
    return stream.where(F.when(condition, time) >= F.lit(-(1 << 62)))


def run_to_end(stream_of: Callable[[str], DataFrame], name: str, spark: SparkSession, end: dt.datetime | None, **options) -> DataFrame:
    """Two runs of one named query: all data, then a tick at ``end`` that closes what is
    still open.  ``stream_of(folder)`` builds the query; the second run starts from the
    first one's checkpoint, as after a restart.  No ``end`` (no data) means one run."""
    folder = options.pop("folder", None) or shared_dir(spark, name)
    out = run_available_now(stream_of(folder), name, folder=folder, **options)
    if end is None:
        return out
    tick(spark, folder, end)
    return run_available_now(stream_of(folder), name, folder=folder, **options)


@contextmanager
def _settings(spark: SparkSession, values: dict[str, str]):
    """Session settings for a while: a query takes over those of its start."""
    before = {k: spark.conf.get(k, None) for k in values}
    for k, v in values.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def _is_dir(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return fs.exists(p) and fs.getFileStatus(p).isDirectory()


def _exists(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)
