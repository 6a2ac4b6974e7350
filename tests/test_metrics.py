import json

from umpire.operators import metrics as M


def _df(spark, pairs):
    return spark.createDataFrame(pairs, "y int, yhat int")


def test_precision_recall_f1(spark):
    m = M.binary_metrics(_df(spark, [(1, 1), (1, 0), (0, 1), (0, 0), (1, 1)]), "y", "yhat").first()
    assert (m.tp, m.fp, m.fn, m.tn) == (2, 1, 1, 1)
    assert abs(m.precision - 2 / 3) < 1e-12 and abs(m.recall - 2 / 3) < 1e-12
    assert abs(m.f1 - 2 / 3) < 1e-12


def test_zero_denominators_give_zero(spark):
    m = M.binary_metrics(_df(spark, [(0, 0), (0, 0)]), "y", "yhat").first()
    assert (m.precision, m.recall, m.f1) == (0.0, 0.0, 0.0)


def test_report_and_gate(spark):
    rep = M.report_json(M.binary_metrics(_df(spark, [(1, 1), (0, 0)]), "y", "yhat"))
    body = json.loads(rep.first().report)
    assert body["metrics"]["f1"]["value"] == 1.0 and "precision" in body["metrics"]
    g = M.gate(rep, 0.6).first()
    assert g.passed and g.metric == 1.0
    bad = M.gate(M.report_json(M.binary_metrics(_df(spark, [(1, 0), (0, 1)]), "y", "yhat")), 0.6).first()
    assert not bad.passed
    assert bad.message == "Execution failed because the model's f1 result was lower than 0.6"


def test_auc_with_ties(spark):
    df = spark.createDataFrame([(1, 0.9), (0, 0.9), (1, 0.5), (0, 0.1)], "y int, p double")
    assert abs(M.auc(df, "y", "p").first().auc - 0.625) < 1e-12


def test_roc_points(spark):
    df = spark.createDataFrame([(1, 0.9), (0, 0.8), (1, 0.7)], "y int, p double")
    pts = {r.threshold: (r.tpr, r.fpr) for r in M.roc_points(df, "y", "p").collect()}
    assert pts[0.9] == (0.5, 0.0) and pts[0.8] == (0.5, 1.0) and pts[0.7] == (1.0, 1.0)


def test_model_quality_threshold(spark):
    df = spark.createDataFrame([(1, 0.56), (1, 0.55), (0, 0.2)], "y int, p double")
    m = M.model_quality(df, "y", "p", 0.55).first()
    assert (m.tp, m.fn, m.tn) == (1, 1, 1)
