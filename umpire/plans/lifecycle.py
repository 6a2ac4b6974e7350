"""The training lifecycle composed from the operators, writing every stage's
output under one folder of the shared location:

split files -> baselines -> fitted artifacts -> evaluation report -> gate ->
(when passed) test predictions, model-quality baseline, data-quality
statistics and constraints.

Each stage is a Spark job over the previous stage's DataFrame; only small
summaries (medians, classes, losses, the gate row) reach the driver.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from umpire.operators import metrics as M
from umpire.operators import prepare as P
from umpire.operators import quality as Q
from umpire.plans import model as MD
from umpire.plans.prepared import IMPUTED, split_rows
from umpire.schemas import LABEL
from umpire.session import shared_dir
from umpire.sources import artifacts as AR
from umpire.sources import sinks as SK
from umpire.sources.testdata import DOC_FEATURES


WRONG_WIDTH = "a line has neither the fields of a request nor one more"


@dataclass
class TrainingRun:
    folder: str
    passed: bool
    message: str
    f1: float
    rounds_kept: int


def run_training(spark: SparkSession, sf_dir: str, params: MD.TreeParams = MD.TreeParams(),
                 f1_threshold: float = 0.6, patience: int = 25, folder: str | None = None) -> TrainingRun:
    out = folder or shared_dir(spark, "training")
    rows = split_rows(spark, sf_dir)
    raw = rows.drop("source", "lang")
    features = raw.drop("doc_id")  # an id is no feature
    SK.write_baseline(P.baseline(features.where(F.col("split") == "train").drop("split"), LABEL, keep_label=False),
                      f"{out}/train-baseline", header=True)
    SK.write_baseline(P.baseline(features.where(F.col("split") == "test").drop("split"), LABEL, keep_label=True),
                      f"{out}/test-baseline", header=False)

    train = rows.where(F.col("split") == "train")
    medians = P.fit_medians(train, IMPUTED)
    classes = P.fit_ordinal(train, LABEL)
    SK.write_splits(P.encode(P.impute(raw, medians), LABEL, classes), f"{out}/splits", LABEL, DOC_FEATURES)
    target = MD.target_stage(classes, LABEL)
    coded = target.transform(rows)
    model, _, kept = MD.fit_with_early_stopping(
        coded.where(F.col("split") == "train"), coded.where(F.col("split") == "validation"),
        DOC_FEATURES, medians, params, patience)
    AR.save_artifacts(f"{out}/model", model, target)

    test = MD.score(model, coded.where(F.col("split") == "test"))
    report = M.report_json(M.binary_metrics(test, "y", "yhat"))
    report.coalesce(1).write.mode("overwrite").text(f"{out}/evaluation")
    verdict = M.gate(report, f1_threshold).first()
    if verdict["passed"]:
        preds = test.select("doc_id", F.col("y").cast("int").alias("truth"), "yhat", "p")
        preds.write.mode("overwrite").parquet(f"{out}/test-predictions")
        M.model_quality(preds, "truth", "p", threshold=0.55).write.mode("overwrite").parquet(
            f"{out}/model-quality-baseline")
        stats = Q.profile(train.select(*DOC_FEATURES), DOC_FEATURES, exact_distinct=False)
        stats.write.mode("overwrite").parquet(f"{out}/data-quality-statistics")
        Q.suggest_constraints(stats).write.mode("overwrite").parquet(f"{out}/data-quality-constraints")
    return TrainingRun(out, bool(verdict["passed"]), verdict["message"], float(verdict["metric"]), kept)


def load_report(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.text(f"{folder}/evaluation").withColumnRenamed("value", "report")


# ------------------------------------------------------------------ request scoring
def score_requests(spark: SparkSession, lines: DataFrame, line_col: str, folder: str,
                   fmt: str = "text/csv", keep: list[str] | tuple = (),
                   request: str | None = None) -> DataFrame:
    """Score CSV request lines with saved artifacts and render the response.

    Lines carry the features in order, optionally preceded by the truth
    label.  ``fmt`` is ``text/csv`` (one line per prediction),
    ``application/jsonlines`` (one object per prediction) or
    ``application/json`` (one array per ``request``).

    A request fails as a whole: where a line has a wrong number of fields, the lines
    of its ``request`` (without one, that line alone) get no answer but ``error``.
    """
    from umpire.functions.scoring import prediction_record
    from umpire.sources.payloads import parse_csv_lines

    model, target = AR.load_artifacts(f"{folder}/model")
    parsed = parse_csv_lines(lines, line_col, DOC_FEATURES, label="ground_truth", keep=list(keep), reject="_rejected")
    if request is not None:
        marks = parsed.groupBy(request).agg(F.max("_rejected").alias("_failed"))
        parsed = parsed.join(marks, request).drop("_rejected").withColumnRenamed("_failed", "_rejected")
    scored = MD.score(model, parsed)
    has_truth = F.col("ground_truth").isNotNull()
    rec = scored.select(*keep, *prediction_record(F.col("probs"), F.col("ground_truth"), AR.classes_of(target)),
                        has_truth.alias("_has_truth"), "_rejected")
    error = F.when(F.col("_rejected"), F.lit(WRONG_WIDTH)).alias("error")
    if fmt in ("text/csv", "application/jsonlines"):
        one = {"text/csv": lambda truth: SK.csv_response(rec, truth), "application/jsonlines": SK.jsonlines_response}[fmt]
        body = F.when(F.col("_has_truth"), one(True)).otherwise(one(False))
        return rec.select(*keep, F.when(~F.col("_rejected"), body).alias("body"), error)
    if fmt == "application/json":
        if request is None:
            raise ValueError("application/json responses need a request column")
        bodies = SK.json_response(rec.where(~F.col("_rejected")), request, keep[-1] if keep else request, with_truth=True)
        failed = rec.where("_rejected").select(request, error).distinct()
        return bodies.withColumn("error", F.lit(None).cast("string")).unionByName(failed, allowMissingColumns=True)
    raise ValueError(f"no response in the form {fmt}")


# ------------------------------------------------------------------ hourly monitoring
def run_monitoring(spark: SparkSession, captures: DataFrame, truth: DataFrame, current: DataFrame,
                   folder: str, metrics: list[str] = ("accuracy", "precision", "recall", "f1"),
                   threshold: float = 0.55) -> dict[str, DataFrame]:
    """One monitoring run against the baselines of a training run:

    * model quality: captures joined with late truth (``inference_id`` =
      ``eventId``), metrics compared with the model-quality baseline;
    * data quality: the current feature window profiled and checked against
      the stored constraints, plus KS drift versus the training rows.
    """
    from umpire.operators.joins import match_truth

    labelled = match_truth(captures, truth, "inference_id", "eventId")
    cur_mq = M.model_quality(labelled, "truth", "p", threshold)
    base_mq = spark.read.parquet(f"{folder}/model-quality-baseline")
    model_checks = Q.quality_violations(cur_mq, base_mq, list(metrics))
    constraints = spark.read.parquet(f"{folder}/data-quality-constraints")
    data_checks = Q.violations(Q.profile(current, DOC_FEATURES), constraints)
    base_rows = spark.read.option("header", True).csv(f"{folder}/train-baseline").select(
        *[F.col(c).cast("double").alias(c) for c in DOC_FEATURES])
    drift = Q.drift(base_rows, current.select(*DOC_FEATURES), DOC_FEATURES)
    return {"model_quality": model_checks, "data_quality": data_checks, "drift": drift}


# ------------------------------------------------------------------ ingest of an arrival folder
def ingest_folder(spark: SparkSession, folder: str, labels: tuple[str, ...] = (LABEL,)) -> DataFrame:
    """Rows of an arrival folder: all its CSV files side by side, by row position.

    Files go by name (headers give the column names, a later file's repeated name
    gets its file's name in front).  Unequal lengths give nulls; a folder without CSV
    files is an error.  Columns other than ``labels`` become doubles."""
    from umpire.operators.prepare import ROW_ID, with_row_id, zip_columns
    from umpire.sources.payloads import csv_files, read_csv_dir

    read_csv_dir(spark, folder)  # the folder must hold CSV files
    out, seen = None, set()
    for path in csv_files(spark, folder):
        part = spark.read.option("header", True).csv(path)
        stem = path.rsplit("/", 1)[-1].removesuffix(".csv")
        part = part.toDF(*[f"{stem}.{c}".replace(".", "_") if c in seen else c for c in part.columns])
        seen |= set(part.columns)
        part = with_row_id(part)
        out = part if out is None else zip_columns(out, part, key=ROW_ID)
    casts = [F.col(c) if c in (ROW_ID, *labels) else F.expr(f"try_cast(`{c}` AS DOUBLE)").alias(c) for c in out.columns]
    return out.select(*casts)
