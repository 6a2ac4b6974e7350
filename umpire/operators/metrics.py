"""Classification metrics, the quality gate, ROC/PR curves and AUC.

Every metric is one aggregate of conditional sums (map-side combined), so its
cost is a single pass whatever the data size.  Curves aggregate per distinct
score first and then take distributed running sums over the scores.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from umpire.operators.ordered import running_sums


def _ratio(num: Column, den: Column) -> Column:
    """num / den, 0 when the denominator is 0 (sklearn's zero_division=0)."""
    return F.when(den == 0, F.lit(0.0)).otherwise(num.cast("double") / den.cast("double"))


def confusion(df: DataFrame, y: str, yhat: str, by: list[str] | tuple = ()) -> DataFrame:
    """tp, fp, fn, tn counts of 0/1 columns (optionally per group)."""
    yy, pp = F.col(y) == 1, F.col(yhat) == 1
    cnt = lambda c: F.sum(F.when(c, 1).otherwise(0)).cast("long")
    aggs = [cnt(yy & pp).alias("tp"), cnt(~yy & pp).alias("fp"),
            cnt(yy & ~pp).alias("fn"), cnt(~yy & ~pp).alias("tn")]
    return df.groupBy(*by).agg(*aggs)


def with_rates(cm: DataFrame) -> DataFrame:
    """Precision, recall and F1 of the positive class from counts."""
    tp, fp, fn = F.col("tp"), F.col("fp"), F.col("fn")
    return cm.select(
        "*",
        _ratio(tp, tp + fp).alias("precision"),
        _ratio(tp, tp + fn).alias("recall"),
        _ratio(2 * tp, 2 * tp + fp + fn).alias("f1"))


def binary_metrics(df: DataFrame, y: str, yhat: str, by: list[str] | tuple = ()) -> DataFrame:
    """Counts plus precision, recall, F1 (0 on empty denominators)."""
    return with_rates(confusion(df, y, yhat, by))


def report_json(metrics: DataFrame) -> DataFrame:
    """Evaluation report ``{"metrics": {"f1": {"value": ..}, "precision": .., "recall": ..}}``."""
    m = F.struct(
        F.struct(F.col("f1").alias("value")).alias("f1"),
        F.struct(F.col("precision").alias("value")).alias("precision"),
        F.struct(F.col("recall").alias("value")).alias("recall"))
    return metrics.select(F.to_json(F.struct(m.alias("metrics"))).alias("report"))


def report_value(reports: DataFrame, path: str = "$.metrics.f1.value", col: str = "report",
                 name: str = "value") -> DataFrame:
    """Read one number out of a JSON report."""
    return reports.select("*", F.get_json_object(F.col(col), path).cast("double").alias(name))


def gate(reports: DataFrame, threshold: float = 0.6, path: str = "$.metrics.f1.value",
         col: str = "report") -> DataFrame:
    """Quality gate: pass when the metric is >= threshold, else a failure message."""
    v = F.get_json_object(F.col(col), path).cast("double")
    passed = F.coalesce(v >= F.lit(threshold), F.lit(False))
    msg = F.when(passed, F.lit("passed")).otherwise(F.lit(
        f"Execution failed because the model's f1 result was lower than {threshold}"))
    return reports.select(v.alias("metric"), F.lit(float(threshold)).alias("threshold"),
                          passed.alias("passed"), msg.alias("message"))


def model_quality(df: DataFrame, y: str, p: str, threshold: float = 0.55,
                  by: list[str] | tuple = ()) -> DataFrame:
    """Binary model-quality statistics at a probability threshold (p > t)."""
    lab = df.withColumn("_yhat", (F.col(p) > F.lit(threshold)).cast("int"))
    cm = confusion(lab, y, "_yhat", by)
    tp, fp, fn, tn = (F.col(c) for c in ("tp", "fp", "fn", "tn"))
    n = tp + fp + fn + tn
    prec, rec = _ratio(tp, tp + fp), _ratio(tp, tp + fn)

    def fbeta(b: float) -> Column:
        b2 = b * b
        return _ratio((1 + b2) * tp, (1 + b2) * tp + b2 * fn + fp)

    return cm.select(
        *by, "tp", "fp", "fn", "tn",
        _ratio(tp + tn, n).alias("accuracy"),
        prec.alias("precision"), rec.alias("recall"),
        rec.alias("true_positive_rate"),
        _ratio(fp, fp + tn).alias("false_positive_rate"),
        _ratio(tn, tn + fp).alias("true_negative_rate"),
        _ratio(fn, fn + tp).alias("false_negative_rate"),
        fbeta(0.5).alias("f0_5"), fbeta(1.0).alias("f1"), fbeta(2.0).alias("f2"))


def _score_groups(df: DataFrame, y: str, p: str) -> DataFrame:
    return (df.groupBy(F.col(p).alias("score"))
            .agg(F.sum(F.when(F.col(y) == 1, 1).otherwise(0)).cast("long").alias("pos"),
                 F.sum(F.when(F.col(y) == 1, 0).otherwise(1)).cast("long").alias("neg")))


def roc_points(df: DataFrame, y: str, p: str) -> DataFrame:
    """One ROC/PR point per distinct score t (predict positive when p >= t)."""
    g = _score_groups(df, y, p).withColumn("_desc", -F.col("score"))
    cum = running_sums(g, ["_desc"], {"tp": F.col("pos"), "fp": F.col("neg")}, totals=True)
    tp, fp = F.col("tp"), F.col("fp")
    return cum.select(
        F.col("score").alias("threshold"), "tp", "fp",
        _ratio(tp, F.col("tp_total")).alias("tpr"),
        _ratio(fp, F.col("fp_total")).alias("fpr"),
        _ratio(tp, tp + fp).alias("precision"))


def auc(df: DataFrame, y: str, p: str) -> DataFrame:
    """ROC AUC by the rank-sum statistic with mid-ranks for tied scores."""
    g = _score_groups(df, y, p).withColumn("_m", F.col("pos") + F.col("neg"))
    cum = running_sums(g, ["score"], {"_c": F.col("_m")})
    mid = F.col("_c") - (F.col("_m") - 1) / 2.0
    s = cum.agg(F.sum(F.col("pos") * mid).alias("rs"),
                F.sum("pos").cast("double").alias("P"),
                F.sum("neg").cast("double").alias("N"))
    val = F.when((F.col("P") == 0) | (F.col("N") == 0), F.lit(None).cast("double")).otherwise(
        (F.col("rs") - F.col("P") * (F.col("P") + 1) / 2) / (F.col("P") * F.col("N")))
    return s.select(val.alias("auc"), F.col("P").cast("long").alias("positives"),
                    F.col("N").cast("long").alias("negatives"))
