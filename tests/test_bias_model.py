import math

import pytest
from pyspark.sql import functions as F

from umpire.operators import bias as B
from umpire.operators import boosting as BT
from umpire.plans import model as MD


def test_pretraining_bias_hand_computed(spark):
    # facet d: 4 rows, 1 positive; a: 6 rows, 4 positives
    rows = [(True, 1, "g"), (True, 0, "g"), (True, 0, "g"), (True, 0, "h"),
            (False, 1, "g"), (False, 1, "g"), (False, 1, "h"), (False, 1, "h"), (False, 0, "h"), (False, 0, "h")]
    df = spark.createDataFrame(rows, "f boolean, y int, grp string")
    m = {r.metric: r.value for r in B.pretraining_bias(df, F.col("f"), "y", "grp").collect()}
    qa, qd = 4 / 6, 1 / 4
    assert abs(m["CI"] - (6 - 4) / 10) < 1e-12
    assert abs(m["DPL"] - (qa - qd)) < 1e-12
    kl = qa * math.log(qa / qd) + (1 - qa) * math.log((1 - qa) / (1 - qd))
    assert abs(m["KL"] - kl) < 1e-12
    assert abs(m["TVD"] - abs(qa - qd)) < 1e-12


def test_posttraining_disparate_impact(spark):
    rows = [(True, 1, 1, "g"), (True, 0, 0, "g"), (False, 1, 1, "g"), (False, 0, 1, "g")]
    df = spark.createDataFrame(rows, "f boolean, y int, yhat int, grp string")
    m = {r.metric: r.value for r in B.posttraining_bias(df, F.col("f"), "y", "yhat", "grp").collect()}
    assert abs(m["DI"] - 0.5) < 1e-12 and abs(m["DPPL"] - 0.5) < 1e-12


def test_best_prefix_patience():
    losses = [5, 4, 3, 3.5, 3.6, 3.7, 2.9]
    assert MD.best_prefix(losses, patience=3) == 3
    assert MD.best_prefix(losses, patience=10) == 7


def test_importance_type_must_be_known(spark):
    with pytest.raises(ValueError):
        MD.tree_importance(spark.range(1), ["a"], kind="bogus")


def test_search_space_is_seeded():
    a, b = MD.sample_params(3), MD.sample_params(3)
    assert a == b and all(0.05 <= c["eta"] <= 0.3 and 5 <= c["max_depth"] <= 15 for c in a)


def test_flip_test_by_hand(spark):
    from umpire.operators.bias import flip_test
    rows = [("p", True, 0), ("p", True, 1), ("p", False, 1), ("p", False, 1), ("p", False, 0),  # neighbours mostly 1: one flip up
            ("q", True, 1), ("q", True, 1), ("q", False, 0),                                    # mostly 0: two flips down
            ("r", True, 0), ("r", False, 0), ("r", False, 1),                                   # a tie
            ("s", True, 1), (None, True, 1), (None, False, 0)]                                  # alone; null is a cell
    got = flip_test(spark.createDataFrame(rows, "cell string, d boolean, yhat int"), F.col("d"), "yhat", ["cell"]).first()
    assert (got["metric"], got["members"], got["compared"]) == ("FT", 7, 6)
    assert got["value"] == pytest.approx((1 - 2 - 1) / 7)


def test_prefix_choice_equals_the_loop(spark):
    import random
    from umpire.plans.model import best_prefix, prefix_choice
    rng = random.Random(3)
    series = [[rng.choice([1.0, 0.9, 0.8, rng.random()]) for _ in range(rng.randint(1, 40))] for _ in range(30)]
    rows = [(s, i + 1, v) for s, losses in enumerate(series) for i, v in enumerate(losses)]
    got = prefix_choice(spark.createDataFrame(rows, "s long, r long, loss double"), "s", "r", "loss", patience=5)
    assert {r["s"]: r["kept"] for r in got.collect()} == {s: best_prefix(v, 5) for s, v in enumerate(series)}


def test_early_stopping_keeps_the_trees_of_the_full_fit(spark):
    rows = [(i, float(i % 7), float((i * 37) % 11), float((i * i) % 5 > 1)) for i in range(200)]
    frame = spark.createDataFrame(rows, "id long, a double, b double, y double")
    train, valid = frame.where("id % 3 > 0"), frame.where("id % 3 = 0")
    params = MD.TreeParams(rounds=24, max_depth=2, reg_alpha=0.0, reg_lambda=0.1, eta=0.5)
    model, losses, kept = MD.fit_with_early_stopping(train, valid, ["a", "b"], {"a": 0.0, "b": 0.0}, params, 2, id_col="id")
    whole, want = BT.fit(train, valid, ["a", "b"], {"a": 0.0, "b": 0.0}, params, id_col="id")
    assert kept == MD.best_prefix(want, 2) == len(model.trees) < len(want)
    assert losses == want[:len(losses)] and len(losses) == min(24, kept + 2)
    assert model.node_rows() == whole.first(kept).node_rows()


def test_registered_search_fits_whole_trials(spark, monkeypatch):
    from dataclasses import replace
    from types import SimpleNamespace

    from umpire.plans import catalog as C
    from umpire.sources.testdata import DOC_FEATURES

    rows = spark.range(40).selectExpr("id AS doc_id", "CAST(id % 2 AS DOUBLE) AS y",
                                      *[f"CAST(id * {i + 3} % 7 AS DOUBLE) AS `{c}`" for i, c in enumerate(DOC_FEATURES)])
    seen = []

    def small(train, valid, features, medians, params, patience, y="y", id_col="doc_id"):
        seen.append((params, patience))
        return BT.fit(train, None, features, medians, replace(params, rounds=1, max_depth=2), y, id_col)[0], [0.5], 1

    monkeypatch.setattr(MD, "fit_with_early_stopping", small)
    monkeypatch.setattr(C, "_TRIALS", {})
    monkeypatch.setattr(C, "trained", lambda *a: SimpleNamespace(train=rows, valid=rows, medians=dict.fromkeys(DOC_FEATURES, 0.0)))
    trials = sorted(C.m5_search(spark, "nowhere").collect())
    assert [r["max_depth"] for r in trials[:2]] == [c["max_depth"] for c in MD.sample_params(5, MD.RANGES, 42)[:2]]
    assert all(5 <= r["max_depth"] <= 15 for r in trials) and len(trials) == 5
    assert sorted(p.reg_lambda for p, _ in seen) == pytest.approx(sorted(r["lambda"] for r in trials), abs=1e-5)
    assert [(p.rounds, patience) for p, patience in seen] == [(120, 25)] * 5
    assert all(r["in_range"] and r["as_proposed"] for r in C.m5_search_check(spark, "nowhere").collect())
