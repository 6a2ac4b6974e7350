"""Writers and response renderers: split files, baselines, ground-truth
records, CSV/JSON/JSON Lines responses, matrix text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def write_splits(df: DataFrame, path: str, label: str, features: list[str],
                 split: str = "split") -> None:
    """One CSV folder per split value, label first, with a header."""
    (df.select(split, label, *features).write.mode("overwrite")
       .partitionBy(split).option("header", True).csv(path))


def write_baseline(df: DataFrame, path: str, header: bool) -> None:
    """Baseline CSV (S7): header for train, none for test."""
    df.write.mode("overwrite").option("header", header).csv(path)


def ground_truth_events(df: DataFrame, id_col: str, label_col: str, ts_col: str) -> DataFrame:
    """Ground-truth JSON Lines records and their hour folder ``YYYY/MM/DD/HH``."""
    rec = F.struct(
        F.struct(F.col(label_col).alias("data"), F.lit("CSV").alias("encoding")).alias("groundTruthData"),
        F.struct(F.col(id_col).cast("string").alias("eventId")).alias("eventMetadata"),
        F.lit("0").alias("eventVersion"))
    return df.select(F.col(id_col), F.date_format(F.col(ts_col), "yyyy/MM/dd/HH").alias("folder"),
                     F.to_json(rec).alias("record"))


def write_ground_truth(records: DataFrame, path: str) -> None:
    """Write records as text under their hour folders."""
    (records.select("folder", "record").write.mode("append").partitionBy("folder").text(path))


def csv_response(df: DataFrame, with_truth: bool) -> Column:
    """One CSV response line: 3 fields, or 5 with truth first."""
    fields = (["ground_truth", "numerical_ground_truth_label"] if with_truth else []) + [
        "predicted_label", "predicted_numerical_label"]
    return F.concat_ws(",", *[F.col(c).cast("string") for c in [*fields, "win_probability"]])


def pair_csv() -> Column:
    """The post-processing stage's CSV line: label and confidence."""
    return F.concat_ws(",", "predicted_label", F.col("win_probability").cast("string"))


def _item(with_truth: bool, numeric: bool = True) -> Column:
    fields = [F.col("predicted_label").alias("prediction"), F.col("win_probability").alias("confidence")]
    if numeric:
        fields.append(F.col("predicted_numerical_label").alias("numerical_label"))
    if with_truth:
        fields.append(F.col("ground_truth").alias("ground_truth"))
    return F.struct(*fields)


def jsonlines_response(with_truth: bool) -> Column:
    """One JSON object per prediction."""
    return F.to_json(_item(with_truth))


def json_response(df: DataFrame, request: str, order: str, with_truth: bool,
                  unwrap_single: bool = False) -> DataFrame:
    """JSON array of prediction objects per request (S11).  ``unwrap_single`` is
    the post-processing stage's form (S13): the objects hold prediction and
    confidence only, and a one-element array becomes the object itself.

    A request's predictions are gathered in one row; requests are bounded
    payloads, so the group size is bounded by the request, not by the data.
    """
    items = (df.groupBy(request)
             .agg(F.sort_array(F.collect_list(F.struct(F.col(order).alias("_o"),
                                                       _item(with_truth, numeric=not unwrap_single).alias("_i")))).alias("_s")))
    arr = F.transform(F.col("_s"), lambda s: s["_i"])
    body = F.to_json(arr)
    if unwrap_single:
        body = F.when(F.size(arr) == 1, F.to_json(F.element_at(arr, 1))).otherwise(body)
    return items.select(request, F.size(arr).alias("n"), body.alias("body"))


def matrix_csv(cols: list[str]) -> Column:
    """Text row of a numeric matrix (S16); a missing value is an error."""
    vals = [F.when(F.col(c).isNull(), F.raise_error(
        F.lit("matrix row has a missing value"))).otherwise(F.col(c).cast("string"))
            for c in cols]
    return F.concat_ws(",", *vals)
