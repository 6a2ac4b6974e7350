"""The training plan: prepared splits -> boosted trees with early stopping ->
evaluation, kept per session so several reports reuse one fit."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.feature import StringIndexerModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from umpire.operators.boosting import BoostedTrees
from umpire.plans import model as MD
from umpire.plans.prepared import fitted
from umpire.schemas import LABEL
from umpire.session import input_stamp
from umpire.sources.testdata import DOC_FEATURES

# The registered queries fit at the trainer's defaults.
QUERY_PARAMS = MD.TreeParams()


@dataclass
class Trained:
    rows: DataFrame
    train: DataFrame
    valid: DataFrame
    test: DataFrame
    medians: dict
    target: StringIndexerModel
    model: BoostedTrees
    losses: list
    kept: int


_CACHE: dict = {}


def trained(spark: SparkSession, sf_dir: str, params: MD.TreeParams = QUERY_PARAMS,
            patience: int = 25) -> Trained:
    key = (input_stamp(spark, sf_dir, "documents", "labels"), params, patience)
    if key not in _CACHE:
        rows, medians, classes = fitted(spark, sf_dir)
        target = MD.target_stage(classes, LABEL)
        coded = target.transform(rows).cache()
        train = coded.where(F.col("split") == "train")
        valid = coded.where(F.col("split") == "validation")
        test = coded.where(F.col("split") == "test")
        model, losses, kept = MD.fit_with_early_stopping(train, valid, DOC_FEATURES, medians, params, patience)
        _CACHE[key] = Trained(coded, train, valid, test, medians, target, model, losses, kept)
    return _CACHE[key]
