"""The preparation plan: labelled rows -> split -> impute -> encode -> rule
score.  Shared by the catalog queries and by the training plan."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from umpire.operators import prepare as P
from umpire.schemas import LABEL
from umpire.session import ensure_checkpoint_dir, input_stamp
from umpire.sources.testdata import DOC_FEATURES, labelled_documents

SEED = 42
FRACTIONS = (0.7, 0.15, 0.15)
IMPUTED = ["n_chars", "n_words", "n_sentences", "n_lines"]


# Step results kept per application and state of the input files, like a pipeline's step
# cache: the split rows live in checkpoint files, the fitted values are a few numbers.
_SPLITS: dict = {}
_FITTED: dict = {}


def split_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = input_stamp(spark, sf_dir, "documents", "labels")
    if key not in _SPLITS:
        ensure_checkpoint_dir(spark)
        _SPLITS[key] = P.stratified_split(labelled_documents(spark, sf_dir), LABEL, "doc_id", FRACTIONS, SEED).checkpoint()
    return _SPLITS[key]


def fitted(spark: SparkSession, sf_dir: str):
    """(split rows, medians fitted on train, label classes fitted on train)."""
    key = input_stamp(spark, sf_dir, "documents", "labels")
    if key not in _FITTED:
        rows = split_rows(spark, sf_dir)
        train = rows.where(F.col("split") == "train")
        _FITTED[key] = (rows, P.fit_medians(train, IMPUTED), P.fit_ordinal(train, LABEL))
    return _FITTED[key]


def prepared(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Imputed features plus the coded label ``y`` and the split."""
    rows, medians, classes = fitted(spark, sf_dir)
    out = P.impute(rows, medians)
    return P.encode(out, LABEL, classes, name="y")


def rule_score(df: DataFrame) -> DataFrame:
    """A fixed scoring rule used where no fitted model is wanted:
    ``p = 1 / (1 + exp(-(n_words - 200) / 100))``, label = ``p > 0.5``."""
    p = 1.0 / (1.0 + F.exp(-(F.col("n_words") - 200.0) / 100.0))
    return df.withColumn("p", p).withColumn("yhat", (F.col("p") > 0.5).cast("int"))


FEATURES = DOC_FEATURES
