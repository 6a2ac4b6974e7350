import datetime as dt
import json
import random

import pytest
from pyspark.sql import functions as F

from umpire.operators import quality as Q
from umpire.operators import statistics as ST

COLS = ["a", "b", "c"]


def frame(spark, n=4000, shift=0.0):
    rng = random.Random(n)
    rows = [(dt.datetime(2024, 1, 1) + dt.timedelta(minutes=rng.randrange(600)), rng.gauss(5 + shift, 2) if i % 9 else None,
             rng.randrange(40), rng.choice(["x", "y", None, "é"])) for i in range(n)]
    return spark.createDataFrame(rows, "ts timestamp, a double, b long, c string")


def test_merged_states_equal_one_pass(spark):
    df = frame(spark)
    hourly = ST.column_state(df, COLS, "ts")
    assert hourly.select("window").distinct().count() == 10
    got = {r["column"]: r for r in ST.profile_of(ST.merge_state(hourly)).collect()}
    for want in Q.profile(df, COLS).collect():
        r = got[want["column"]]
        for c in ("inferred_type", "num_rows", "num_missing", "completeness", "min", "max"):
            assert r[c] == want[c]
        for c in ("mean", "sum", "std_dev"):
            assert r[c] == (want[c] if want[c] is None else pytest.approx(want[c], rel=1e-9))
        assert abs(r["distinct"] - want["distinct"]) <= 0.03 * want["distinct"]
    # merging in steps is merging at once
    daily = ST.merge_state(ST.merge_state(hourly, ("window",)))
    assert {r["column"]: round(r["mean"] or 0, 9) for r in daily.collect()} == {c: round(r["mean"] or 0, 9) for c, r in got.items()}


def test_quantiles_and_drift_keep_their_bounds(spark):
    base, current = frame(spark), frame(spark, 3000, 0.5)
    states = [ST.merge_state(ST.column_state(d, COLS, "ts")) for d in (base, current)]
    values = sorted(r["a"] for r in base.where("a is not null").collect())
    for r in ST.quantiles(states[0], [0.1, 0.5, 0.9]).where("column = 'a'").collect():
        rank = sum(v <= r["value"] for v in values) / len(values)
        assert abs(rank - r["quantile"]) <= 2 * ST.rank_error() + 1 / len(values)
    exact = {r["column"]: r["ks_distance"] for r in Q.drift(base, current, ["a", "b"]).collect()}
    got = {r["column"]: r["ks_distance"] for r in ST.sketch_drift(*states).collect()}
    assert set(got) == {"a", "b"} and all(abs(got[c] - exact[c]) <= ST.drift_error() for c in got) and got["a"] > 0.05


def test_columns_without_values(spark):
    none = spark.createDataFrame([(None, None), (None, "x")], "a double, c string")
    state = ST.merge_state(ST.column_state(none, ["a", "c"]))
    got = {r["column"]: r for r in ST.profile_of(state).collect()}
    assert got["a"]["num_missing"] == 2 and got["a"]["mean"] is None and got["c"]["num_missing"] == 1 and got["c"]["distinct"] == 1
    assert ST.sketch_drift(state, state).count() == 0
    assert ST.column_state(none.where("false"), ["a", "c"]).count() == 0


def test_documents_come_back_and_check_like_the_tables(spark):
    base = frame(spark)
    current = frame(spark, 500).select("ts", (F.col("a") - 100).alias("a"), F.col("b").cast("string").alias("b"), F.lit(None).cast("string").alias("c"))
    stats = Q.profile(base, COLS)
    document = ST.statistics_document(stats)
    text = json.loads(document.first()["document"])
    assert [f["name"] for f in text["features"]] == COLS and text["dataset"] == {"item_count": 4000} and "numerical_statistics" not in text["features"][2]
    back = ST.read_statistics(document).drop("position")
    assert sorted(map(str, back.select(*stats.columns).collect())) == sorted(map(str, stats.collect()))
    limits = Q.suggest_constraints(stats)
    read = ST.read_constraints(ST.constraints_document(limits))
    assert sorted(map(str, read.collect())) == sorted(map(str, limits.collect()))
    now = Q.profile(current, COLS)
    found = sorted(map(tuple, Q.violations(now, read).collect()))
    assert found == sorted(map(tuple, Q.violations(now, limits).collect())) and len(found) >= 3
    with pytest.raises(Exception, match="no features"):
        ST.read_statistics(spark.createDataFrame([("nonsense",)], "document string")).collect()
