"""Streaming monitors: arrival trigger (T2), hourly monitoring windows (T3),
late truth joined to captures (T4), stream scoring with capture (T5)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from umpire.functions.events import classify_arrivals
from umpire.functions.scoring import prediction_record
from umpire.operators.metrics import _ratio
from umpire.streaming.runner import after_watermark


def arrivals_stream(events: DataFrame) -> DataFrame:
    """New-object trigger: classify each arrival as it lands (stateless)."""
    from umpire.sources.testdata import arrivals_from
    return classify_arrivals(arrivals_from(events))


def windowed_monitor(scored: DataFrame, window: str = "1 hour", lateness: str = "1 hour",
                     threshold: float = 0.1) -> DataFrame:
    """Tumbling-window model quality (confusion counts, precision, recall)
    and score statistics of scored requests; a window is emitted once the
    watermark (max event time - lateness) passes its end.  Rows marked ``tick``
    move the watermark and count nowhere; a window of ticks alone is not given."""
    real = ~F.col("tick") if "tick" in scored.columns else F.lit(True)
    yy, pp = F.col("truth") == 1, F.col("score") > F.lit(threshold)

    def cnt(c):
        return F.sum(F.when(c & real, 1).otherwise(0)).cast("long")

    agg = (scored.withWatermark("ts", lateness)
           .groupBy(F.window("ts", window).alias("w"))
           .agg(cnt(F.lit(True)).alias("n"), F.avg("score").alias("mean_score"),
                F.min("score").alias("min_score"), F.max("score").alias("max_score"),
                F.stddev_pop("score").alias("std_score"),
                cnt(yy & pp).alias("tp"), cnt(~yy & pp).alias("fp"), cnt(yy & ~pp).alias("fn")))
    tp, fp, fn = F.col("tp"), F.col("fp"), F.col("fn")
    return agg.where("n > 0").select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"),
                      "n", "mean_score", "min_score", "max_score", "std_score", "tp", "fp", "fn",
                      _ratio(tp, tp + fp).alias("precision"), _ratio(tp, tp + fn).alias("recall"))


def late_truth_join(captures: DataFrame, truth: DataFrame, bound: str = "3 hours",
                    lateness: str = "3 hours", how: str = "inner") -> DataFrame:
    """Stream-stream join of captures with truth arriving within ``bound`` after the
    capture; watermarks on both sides bound the state.

    With ``how="left_outer"`` a capture whose truth has not come is given too, with
    nulls, once the watermarks pass its bound."""
    c = _without_ticks(captures.withWatermark("ts", lateness), "ts")
    t = _without_ticks(truth.withWatermark("truth_ts", lateness), "truth_ts")
    cond = (F.col("inference_id") == F.col("eventId")) & (F.col("truth_ts") >= F.col("ts")) & \
           (F.col("truth_ts") <= F.col("ts") + F.expr(f"INTERVAL {bound}"))
    return c.join(t, F.expr("inference_id = eventId") & cond, how)


def _without_ticks(stream: DataFrame, ts: str) -> DataFrame:
    return after_watermark(stream, ~F.col("tick"), ts).drop("tick") if "tick" in stream.columns else stream


def score_requests(stream: DataFrame, threshold_col: str = "score") -> DataFrame:
    """Stateless scoring of a request stream: input columns plus the
    prediction record (class probabilities ``[1 - p, p]``)."""
    probs = F.array(1.0 - F.col(threshold_col), F.col(threshold_col))
    return stream.select("event_id", "value", *prediction_record(probs))


def capture_writer(path_cols: list[str] | None = None):
    """foreachBatch sink that appends each micro-batch (input and output
    together) under the capture folder; re-running an epoch overwrites the
    same epoch folder, so a retried batch is not duplicated."""
    def write(batch: DataFrame, epoch: int, path: str) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/epoch={epoch}")
    return write


def scoring_writer(respond: Callable[[DataFrame], DataFrame]):
    """foreachBatch sink of a request stream: ``respond`` answers a micro-batch's rows (with
    a loaded model), and requests and answers are captured together.

    An epoch's rows are written first and then named in the manifest, so a reader of
    :func:`read_captures` sees whole epochs only, and a retried epoch replaces its own."""
    def write(batch: DataFrame, epoch: int, path: str) -> None:
        spark = batch.sparkSession
        answered = respond(batch)
        answered.write.mode("overwrite").parquet(f"{path}/rows/epoch={epoch}")
        n = spark.read.parquet(f"{path}/rows/epoch={epoch}").count()
        spark.createDataFrame([(epoch, n)], "epoch long, rows long").coalesce(1).write.mode("overwrite").parquet(f"{path}/manifest/epoch_{epoch}")
    return write


def read_captures(spark: SparkSession, path: str) -> DataFrame:
    """The captured rows of all epochs that the manifest names; an epoch whose rows are not
    those that it was committed with is an error."""
    manifest = spark.read.parquet(f"{path}/manifest/*")
    rows = spark.read.parquet(f"{path}/rows")
    held = rows.groupBy("epoch").agg(F.count(F.lit(1)).alias("held"))
    wrong = manifest.join(held, "epoch", "left").where("rows <> coalesce(held, 0)")
    if not wrong.isEmpty():
        raise ValueError("captured rows differ from the manifest")
    return rows.join(F.broadcast(manifest.select("epoch")), "epoch", "left_semi")


def object_arrivals(spark: SparkSession, landing: str, max_files: int = 1000) -> DataFrame:
    """Arrivals of a landing folder: one row per new ``data/<batch id>/<name>.csv`` (event_id,
    ts, bucket, key, batch_id), by the file's path and time.  Contents are not read."""
    files = (spark.readStream.format("binaryFile").schema("path string, modificationTime timestamp, length long, content binary").option("maxFilesPerTrigger", max_files)
             .load(f"{landing.rstrip('/')}/data/*/*.csv").select("path", "modificationTime"))
    key = F.regexp_extract("path", r"(data/[^/]+/[^/]+)$", 1)
    return files.select(F.xxhash64("path").alias("event_id"), F.col("modificationTime").alias("ts"), F.lit(landing).alias("bucket"),
                        key.alias("key"), F.regexp_extract(key, r"^data/([^/]+)/", 1).alias("batch_id"))
