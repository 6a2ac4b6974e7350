
from umpire.plans import model as MD
from umpire.plans.lifecycle import load_report, run_training
from umpire.operators.metrics import report_value

from conftest import SF_CHECK


def test_training_lifecycle_writes_every_stage(spark, tmp_path):
    run = run_training(spark, SF_CHECK, MD.TreeParams(rounds=6, max_depth=3), folder=str(tmp_path / "run"))
    base = tmp_path / "run"
    for part in ("splits/split=train", "splits/split=validation", "splits/split=test",
                 "train-baseline", "test-baseline", "model/features", "model/target", "evaluation"):
        assert (base / part).exists(), part
    f1 = report_value(load_report(spark, str(base))).first()["value"]
    assert abs(f1 - run.f1) < 1e-12 and 1 <= run.rounds_kept <= 6
    if run.passed:
        assert (base / "model-quality-baseline").exists() and (base / "data-quality-constraints").exists()
    else:
        assert run.message.startswith("Execution failed")
    header = open(next(p for p in (base / "train-baseline").iterdir() if p.name.endswith(".csv"))).readline()
    assert "result_match" not in header and header.startswith("n_chars") and "doc_id" not in header


def test_scoring_and_monitoring_against_a_training_run(spark, tmp_path):
    from pyspark.sql import functions as F

    from umpire.plans.lifecycle import run_monitoring, score_requests
    from umpire.plans.prepared import split_rows
    from umpire.sources.testdata import DOC_FEATURES

    folder = str(tmp_path / "run")
    run = run_training(spark, SF_CHECK, MD.TreeParams(rounds=5, max_depth=3), f1_threshold=0.0, folder=folder)
    assert run.passed
    rows = split_rows(spark, SF_CHECK).where(F.col("split") == "test")
    lines = rows.select("doc_id", F.concat_ws(",", *[F.coalesce(F.col(c).cast("string"), F.lit(""))
                                                     for c in DOC_FEATURES]).alias("line"))
    csv = score_requests(spark, lines, "line", folder, "text/csv", keep=["doc_id"])
    bodies = [r.body for r in csv.collect()]
    assert len(bodies) == rows.count() and all(len(b.split(",")) == 3 for b in bodies)
    preds = spark.read.parquet(f"{folder}/test-predictions")
    caps = preds.select(F.col("doc_id").cast("string").alias("inference_id"), "p")
    truth = preds.select(F.col("doc_id").cast("string").alias("eventId"), "truth")
    out = run_monitoring(spark, caps, truth, rows.select(*DOC_FEATURES), folder)
    mq = {r.metric: r for r in out["model_quality"].collect()}
    assert set(mq) == {"accuracy", "precision", "recall", "f1"}
    assert all(abs(r.current - r.baseline) < 1e-12 for r in mq.values())
    assert out["drift"].count() == len(DOC_FEATURES)


def test_ingest_folder_zips_feature_and_label_files_by_position(spark, tmp_path):
    from pyspark.sql import functions as F

    from umpire.operators.prepare import stratified_split
    from umpire.plans.lifecycle import ingest_folder
    from umpire.sources.testdata import labelled_documents

    rows = labelled_documents(spark, SF_CHECK).orderBy("doc_id").toPandas()
    folder = tmp_path / "data" / "batch-7"
    folder.mkdir(parents=True)
    rows[["doc_id", "n_chars", "n_words"]].to_csv(folder / "df.csv", index=False)
    rows[["result_match"]].to_csv(folder / "y.csv", index=False)
    got = ingest_folder(spark, str(folder))
    assert got.count() == len(rows)
    back = {int(r.doc_id): r.result_match for r in got.select("doc_id", "result_match").collect()}
    assert back == dict(zip(rows.doc_id, rows.result_match))
    split = stratified_split(got.withColumn("doc_id", F.col("doc_id").cast("long")), "result_match", "doc_id")
    assert {r.split for r in split.select("split").distinct().collect()} == {"train", "validation", "test"}
