"""Joins of the monitoring path: captured predictions with late truth,
unmatched rows, input/output pairing, production versus shadow, row
alignment.  All are equi-joins on unique request ids, so no key is hot."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from umpire.operators.prepare import ROW_ID, with_row_id


def match_truth(preds: DataFrame, truth: DataFrame, pred_id: str, truth_id: str) -> DataFrame:
    """Predictions that have a ground-truth record (inner join on the id)."""
    return preds.join(truth, preds[pred_id] == truth[truth_id], "inner")


def unmatched(preds: DataFrame, truth: DataFrame, pred_id: str, truth_id: str) -> tuple[DataFrame, DataFrame]:
    """(captures still without truth, truths whose capture is unknown)."""
    no_truth = preds.join(truth, preds[pred_id] == truth[truth_id], "left_anti")
    orphans = truth.join(preds, truth[truth_id] == preds[pred_id], "left_anti")
    return no_truth, orphans


def join_input_output(df: DataFrame, inputs: list[str], outputs: list[str]) -> DataFrame:
    """Model input next to its output: both are columns of one frame (no shuffle)."""
    return df.select(*inputs, *outputs)


def pair_variants(prod: DataFrame, shadow: DataFrame, id_col: str,
                  cols: list[str]) -> DataFrame:
    """Production and shadow results of the same request side by side."""
    p = prod.select(id_col, *[F.col(c).alias(f"prod_{c}") for c in cols])
    s = shadow.select(id_col, *[F.col(c).alias(f"shadow_{c}") for c in cols])
    return p.join(s, id_col, "inner")


def align_rows(a: DataFrame, b: DataFrame, key: str | None = None) -> DataFrame:
    """Align two frames row by row: on ``key`` when given, else by read
    position (distributed dense row index on both sides)."""
    if key is None:
        a, b, key = with_row_id(a), with_row_id(b), ROW_ID
    return a.join(b, key, "inner")
