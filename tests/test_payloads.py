import pytest
from pyspark.sql import functions as F

from umpire.functions import scoring as S
from umpire.schemas import FEATURE_COLUMNS
from umpire.sources import payloads as PL
from umpire.sources import sinks as SK

ROW = [float(i) + 0.5 for i in range(50)]


def _lines(spark, lines):
    return spark.createDataFrame([(i, l) for i, l in enumerate(lines)], "rid long, line string")


def test_fifty_positional_names_without_target(spark):
    line = ", ".join(str(v) for v in ROW)
    out = PL.parse_csv_lines(_lines(spark, [line]), "line", FEATURE_COLUMNS, keep=["rid"]).first()
    assert len(out) == 51
    assert out["player_rating_home_player_1"] == 0.5 and out["attacking_strength_diff"] == 49.5


def test_target_first_is_kept_aside(spark):
    line = "home_win," + ",".join(str(v) for v in ROW)
    out = PL.parse_csv_lines(_lines(spark, [line]), "line", FEATURE_COLUMNS, label="ground_truth").first()
    assert out["ground_truth"] == "home_win"
    assert out["player_rating_home_player_1"] == 0.5


def test_coerce_and_strict_reject(spark):
    good = ",".join(str(v) for v in ROW)
    bad = "RUTI," + ",".join(str(v) for v in ROW[1:])
    df = spark.createDataFrame([(1, good), (1, bad), (2, good)], "req long, line string")
    named = S.name_fields(df, "line", FEATURE_COLUMNS, keep=["req"])
    coerced = S.to_numeric(named, FEATURE_COLUMNS, mode="coerce")
    assert coerced.where(F.col("player_rating_home_player_1").isNull()).count() == 1
    strict = S.to_numeric(named, FEATURE_COLUMNS, mode="strict", request="req")
    rej = {r["req"]: r["rejected"] for r in strict.select("req", "rejected").distinct().collect()}
    assert rej == {1: True, 2: False}


def test_json_records_and_malformed_payload(spark):
    from pyspark.sql import types as T
    schema = T.StructType([T.StructField("a", T.DoubleType()),
                           T.StructField("m", T.StructType([T.StructField("k", T.IntegerType())]))])
    df = spark.createDataFrame([(1, '[{"a": 1.5, "m": {"k": 3}}, {"a": 2.0}]')], "id long, body string")
    rows = PL.parse_json_records(df, "body", schema, keep=["id"]).collect()
    assert [(r["a"], r["m.k"]) for r in rows] == [(1.5, 3), (2.0, None)]
    bad = spark.createDataFrame([(1, "invalid payload")], "id long, body string")
    with pytest.raises(Exception):
        PL.parse_json_records(bad, "body", schema, mode="strict").collect()


def test_predictions_input_and_threshold(spark):
    df = spark.createDataFrame([(1, '{"predictions": [0.8213, 0.21321, 0.4321]}')], "id long, body string")
    p = PL.parse_predictions(df, "body", "application/json", keep=["id"])
    labels = [r["l"] for r in p.orderBy("position").select(S.threshold_label(F.col("prediction")).alias("l")).collect()]
    assert labels == ["home_win", "home_not_win", "home_not_win"]
    missing = spark.createDataFrame([(1, '{"other": [1]}')], "id long, body string")
    with pytest.raises(Exception):
        PL.parse_predictions(missing, "body", "application/json").collect()
    csv = spark.createDataFrame([(1, "0.6\n0.3\n")], "id long, body string")
    assert [r["prediction"] for r in PL.parse_predictions(csv, "body", "text/csv").collect()] == [0.6, 0.3]


def test_matrix_csv_exact_text_and_missing_is_error(spark):
    df = spark.createDataFrame([(1.0, 2.5, 0.25)], "a double, b double, c double")
    assert df.select(SK.matrix_csv(["a", "b", "c"]).alias("t")).first().t == "1.0,2.5,0.25"
    bad = spark.createDataFrame([(1.0, None, 0.25)], "a double, b double, c double")
    with pytest.raises(Exception):
        bad.select(SK.matrix_csv(["a", "b", "c"])).collect()


def test_argmax_ties_go_to_first_class(spark):
    df = spark.createDataFrame([([0.5, 0.5],), ([0.2, 0.8],)], "probs array<double>")
    got = [r[0] for r in df.select(S.argmax_label(F.col("probs"))).collect()]
    assert got == ["home_not_win", "home_win"]


def test_single_prediction_is_unwrapped(spark):
    df = spark.createDataFrame([(1, 1, [0.2, 0.8]), (2, 1, [0.9, 0.1]), (2, 2, [0.3, 0.7])],
                               "req long, line int, probs array<double>")
    rec = df.select("req", "line", *S.prediction_record(F.col("probs")))
    out = {r["req"]: r["body"] for r in SK.json_response(rec, "req", "line", False, unwrap_single=True).collect()}
    assert out[1] == '{"prediction":"home_win","confidence":0.8}'
    assert out[2].startswith("[") and out[2].count("confidence") == 2


def test_record_map_keys_are_zero_padded(spark):
    df = spark.createDataFrame([("a,b,c",)], "line string")
    m = df.select(S.record_map(F.col("line")).alias("m")).first().m
    assert m == {"00": "a", "01": "b", "02": "c"}


def test_read_csv_dir_requires_files(spark, tmp_path):
    with pytest.raises(ValueError):
        PL.read_csv_dir(spark, str(tmp_path))
    (tmp_path / "x.csv").write_text("a,b\n1,2\n")
    assert PL.read_csv_dir(spark, str(tmp_path)).count() == 1


def test_write_splits_label_first_with_header(spark, tmp_path):
    df = spark.createDataFrame([("train", 1.0, 2.0), ("test", 0.0, 3.0)], "split string, result_match double, f double")
    SK.write_splits(df, str(tmp_path / "out"), "result_match", ["f"])
    back = spark.read.option("header", True).csv(str(tmp_path / "out" / "split=train"))
    assert back.columns == ["result_match", "f"]


def test_line_widths_quotes_and_missing_values(spark):
    lines = ["1,2,3", "1,,3", " 1, NaN, 3", "1,2", "1,2,3,4", "1,2,3,4,5", '"1,5",2,3', 'home_win, 1, "2", 3', "", None]
    named = S.name_fields(_lines(spark, lines), "line", ["a", "b", "c"], label="truth", keep=["rid"], reject="bad_width")
    rows = S.to_numeric(named, ["a", "b", "c"], mode="strict", reject="bad_width").orderBy("rid").collect()
    got = [(r["truth"], r["a"], r["b"], r["c"], r["bad_width"], r["bad_values"]) for r in rows]
    none = (None, None, None, None, True, 1)
    assert got == [(None, 1, 2, 3, False, 0), (None, 1, None, 3, False, 0), (None, 1, None, 3, False, 0), none,
                   ("1", 2, 3, 4, False, 0), none, (None, None, 2, 3, False, 1), ("home_win", 1, 2, 3, False, 0), none, none]


def test_many_fields_are_cast_in_one_expression(spark):
    names = [f"n{i}" for i in range(50)]
    lines = spark.createDataFrame([(1, ",".join(map(str, range(50)))), (2, '"1,5",NaN,, x,"7",' + ",".join("9" * 45)), (3, "a," + ",".join("3" * 50)), (4, "1,2"), (5, None)], "k int, line string")
    out = PL.parse_csv_lines(lines, "line", names, keep=["k"], reject="bad")
    assert out._jdf.queryExecution().optimizedPlan().toString().lower().count("cast(") < 5
    got = {r["k"]: r for r in out.collect()}
    assert [got[1][n] for n in names] == [float(i) for i in range(50)]
    assert [got[2][n] for n in names] == [None, None, None, None, 7.0] + [9.0] * 45
    assert [got[3][n] for n in names] == [3.0] * 50 and [got[k]["bad"] for k in (1, 2, 3, 4, 5)] == [False, False, False, True, True]
    assert all(got[k][n] is None for k in (4, 5) for n in names)
