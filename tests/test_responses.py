import json

from pyspark.sql import functions as F

from umpire.functions import scoring as S
from umpire.sources import sinks as SK


def _records(spark, with_truth):
    df = spark.createDataFrame([(1, 1, [0.3, 0.7], "home_win"), (1, 2, [0.9, 0.1], "home_not_win")],
                               "req long, line int, probs array<double>, truth string")
    truth = F.col("truth") if with_truth else None
    return df.select("req", "line", *S.prediction_record(F.col("probs"), truth))


def test_record_fields_and_types(spark):
    rec = _records(spark, True)
    types = dict(rec.dtypes)
    assert types["predicted_numerical_label"] == "int" and types["win_probability"] == "double"
    row = rec.where("line = 1").first()
    assert (row.predicted_label, row.predicted_numerical_label, row.win_probability) == ("home_win", 1, 0.7)
    assert (row.ground_truth, row.numerical_ground_truth_label) == ("home_win", 1)


def test_csv_response_widths(spark):
    rec = _records(spark, True)
    five = rec.select(SK.csv_response(rec, True).alias("c")).orderBy("c").first().c
    three = _records(spark, False)
    three = three.select(SK.csv_response(three, False).alias("c")).orderBy("c").first().c
    assert len(five.split(",")) == 5 and len(three.split(",")) == 3


def test_json_and_jsonlines(spark):
    rec = _records(spark, True)
    body = SK.json_response(rec, "req", "line", with_truth=True).first().body
    items = json.loads(body)
    assert [i["prediction"] for i in items] == ["home_win", "home_not_win"]
    assert set(items[0]) == {"prediction", "confidence", "numerical_label", "ground_truth"}
    lines = [json.loads(r.j) for r in rec.select(SK.jsonlines_response(False).alias("j")).collect()]
    assert all(set(x) == {"prediction", "confidence", "numerical_label"} for x in lines)
    assert all(isinstance(x["numerical_label"], int) and isinstance(x["confidence"], float) for x in lines)
