"""Fitted artifacts saved and loaded together (S15): the feature pipeline
(values for missing fields, trees) and the label coding, under one folder."""

from __future__ import annotations

from pyspark.ml.feature import StringIndexerModel
from pyspark.sql import SparkSession

from umpire.operators.boosting import BoostedTrees


def save_artifacts(path: str, features: BoostedTrees, target: StringIndexerModel) -> None:
    features.save(SparkSession.active(), f"{path.rstrip('/')}/features")
    target.write().overwrite().save(f"{path.rstrip('/')}/target")


def load_artifacts(path: str) -> tuple[BoostedTrees, StringIndexerModel]:
    base = path.rstrip("/")
    return BoostedTrees.load(SparkSession.active(), f"{base}/features"), StringIndexerModel.load(f"{base}/target")


def classes_of(target: StringIndexerModel) -> list[str]:
    """The fitted label order."""
    return list(target.labels)
