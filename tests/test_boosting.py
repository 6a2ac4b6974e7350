"""The trainer against a plain one, its terms, exact Shapley values, and the search."""

import itertools
import math
from dataclasses import replace

import numpy as np
import pytest
from pyspark.sql import functions as F

from umpire.operators import boosting as BT
from umpire.operators.boosting import TreeParams
from umpire.operators.explain import base_margin, tree_shapley
from umpire.plans import model as MD

PLAIN = TreeParams(rounds=3, max_depth=3, subsample=1.0, colsample=1.0, reg_lambda=1.0, reg_alpha=0.1, min_child_weight=0.5, scale_pos_weight=1.5)


def data(spark, n=240, seed=1):
    rng = np.random.default_rng(seed)
    rows = []
    for i in range(n):
        a, b, c = float(rng.integers(0, 30)), float(rng.normal()), float(rng.integers(0, 2))
        y = float(a + 8 * b + 5 * c * (b > 0) + rng.normal() * 4 > 16)
        rows.append((i, None if i % 17 == 0 else a, math.nan if i % 23 == 0 else b, c, y))
    return rows, spark.createDataFrame(rows, "doc_id long, a double, b double, c double, y double")


FEATURES, FILL = ["a", "b", "c"], {"a": 11.0, "b": None, "c": 0.0}


def matrix(rows):
    return np.array([[11.0 if r[1] is None else r[1], r[2], r[3]] for r in rows]), np.array([r[4] for r in rows])


def plain_trees(x, y, params):
    """Greedy second-order trees over all distinct values, row by row."""
    margin, trees = np.zeros(len(x)), []

    def pull(g):
        return math.copysign(max(abs(g) - params.reg_alpha, 0.0), g)

    def score(g, h):
        return pull(g) ** 2 / (h + params.reg_lambda)

    def node(rows, depth):
        g_all, h_all = g[rows].sum(), h[rows].sum()
        best = (1e-6, None)
        if depth:
            for j in range(x.shape[1]):
                for t in sorted(set(x[:, j][~np.isnan(x[:, j])])):
                    left = rows[x[rows, j] <= t]
                    gl, hl = g[left].sum(), h[left].sum()
                    if 0 < len(left) < len(rows) and min(hl, h_all - hl) >= params.min_child_weight:
                        gain = 0.5 * (score(gl, hl) + score(g_all - gl, h_all - hl) - score(g_all, h_all))
                        if gain > best[0] + 1e-7:
                            best = (gain, (j, t))
        if best[1] is None:
            return {"value": -params.eta * pull(g_all) / (h_all + params.reg_lambda)}
        j, t = best[1]
        goes = x[rows, j] <= t
        return {"j": j, "t": t, "gain": best[0], "l": node(rows[goes], depth - 1), "r": node(rows[~goes], depth - 1)}

    def value(tree, row):
        while "value" not in tree:
            tree = tree["l"] if row[tree["j"]] <= tree["t"] else tree["r"]
        return tree["value"]

    for _ in range(params.rounds):
        p = 1 / (1 + np.exp(-margin))
        w = np.where(y == 1, params.scale_pos_weight, 1.0)
        g, h = w * (p - y), w * p * (1 - p)
        trees.append(node(np.arange(len(x)), params.max_depth))
        margin = margin + np.array([value(trees[-1], r) for r in x])
    return trees, margin


def same(tree, n, plain):
    if "value" in plain:
        return tree.feature[n] == -1 and tree.value[n] == pytest.approx(plain["value"], abs=1e-6)
    return (tree.feature[n] == plain["j"] and tree.threshold[n] == plain["t"] and tree.gain[n] == pytest.approx(plain["gain"], abs=1e-5)
            and same(tree, tree.left[n], plain["l"]) and same(tree, tree.right[n], plain["r"]))


@pytest.mark.parametrize("local_rows", [100_000, 60, 0])
def test_trees_equal_the_plain_trainer(spark, local_rows):
    rows, frame = data(spark)
    model, losses = BT.fit(frame.repartition(5), None, FEATURES, FILL, replace(PLAIN, local_rows=local_rows))
    plain, margin = plain_trees(*matrix(rows), PLAIN)
    assert losses == [] and all(same(t, 0, p) for t, p in zip(model.trees, plain)) and len(model.trees) == 3
    got = {r["doc_id"]: r["margin"] for r in BT.margins(model, frame).collect()}
    assert [got[i] for i in range(len(rows))] == pytest.approx(list(margin), abs=1e-6)
    walked = {r["doc_id"]: r["margin"] for r in BT.relational_margins(model.nodes(spark), frame, model, "doc_id", 3).collect()}
    assert walked == pytest.approx(got, abs=1e-12)


def test_the_same_trees_in_any_layout(spark):
    _, frame = data(spark)
    params = TreeParams(rounds=12, max_depth=3, min_child_weight=0.1, reg_alpha=0.01, reg_lambda=1.0, subsample=0.7, colsample=0.7)
    valid = frame.where("doc_id % 4 = 0")
    runs = [BT.fit(f, valid, FEATURES, FILL, p) for f, p in (
        (frame, params), (frame.orderBy("a").repartition(7), replace(params, local_rows=0)), (frame.coalesce(1), replace(params, local_rows=50)))]
    first = runs[0][0].node_rows()
    assert all(m.node_rows() == first and losses == runs[0][1] for m, losses in runs[1:])
    used = {r[0]: set() for r in first}
    for r in first:
        used[r[0]].add(r[2])
    assert all(u - {-1} <= set(BT.columns_of(t, 3, params).tolist()) for t, u in used.items())
    roots = [t.rows[0] for t in runs[0][0].trees]
    assert len(set(roots)) > 3 and all(0.5 * 240 < n < 0.9 * 240 for n in roots)


def test_every_term_takes_effect(spark):
    _, frame = data(spark)
    base = BT.fit(frame, None, FEATURES, FILL, PLAIN)[0].node_rows()
    for change in ({"reg_lambda": 20.0}, {"reg_alpha": 6.0}, {"min_child_weight": 12.0}, {"scale_pos_weight": 0.5}, {"eta": 0.3}, {"max_depth": 2}):
        assert BT.fit(frame, None, FEATURES, FILL, replace(PLAIN, **change))[0].node_rows() != base, change
    heavy = BT.fit(frame, None, FEATURES, FILL, replace(PLAIN, min_child_weight=12.0))[0]
    assert all(t.cover[n] >= 12 - 1e-6 for t in heavy.trees for n in range(len(t.feature)) if n)
    assert all(len(t.feature) == 1 and t.value[0] == 0 for t in BT.fit(frame, None, FEATURES, FILL, replace(PLAIN, reg_alpha=1e6))[0].trees)
    with pytest.raises(ValueError):
        TreeParams(reg_lambda=-1)


def test_cut_points_are_quantiles_of_all_rows(spark):
    rows = spark.range(1000).select((F.col("id") % 500).cast("double").alias("a"), F.lit(1.0).alias("b"), F.lit(None).cast("double").alias("c"))
    a, b, c = BT.cut_points(rows, FEATURES, 10)
    assert list(a) == [49, 99, 149, 199, 249, 299, 349, 399, 449, 499] and list(b) == [1.0] and len(c) == 0


def test_no_rows_and_one_class(spark):
    _, frame = data(spark)
    none = BT.fit(frame.where("false"), frame.where("false"), FEATURES, FILL, replace(PLAIN, rounds=2))
    assert [len(t.feature) for t in none[0].trees] == [1, 1] and none[1] == []
    ones = BT.fit(frame.where("y = 1"), frame, FEATURES, FILL, replace(PLAIN, rounds=2))[0]
    assert all(t.value[0] > 0 for t in ones.trees)


def test_saved_trees_come_back(spark, tmp_path):
    _, frame = data(spark)
    model, _ = BT.fit(frame, None, FEATURES, FILL, PLAIN)
    model.save(spark, str(tmp_path / "m"))
    back = BT.BoostedTrees.load(spark, str(tmp_path / "m"))
    assert back.features == FEATURES and back.fill == FILL and back.node_rows() == model.node_rows()
    a, b = (sorted(BT.margins(m, frame).select("doc_id", "margin").collect()) for m in (model, back))
    assert a == b


def coalition_value(tree, n, x, held):
    """The tree's mean where features outside ``held`` follow both branches by cover."""
    if tree.feature[n] < 0:
        return tree.value[n]
    j = tree.feature[n]
    left, right = (coalition_value(tree, c[n], x, held) for c in (tree.left, tree.right))
    if j in held:
        return left if x[j] <= tree.threshold[n] else right
    return (tree.cover[tree.left[n]] * left + tree.cover[tree.right[n]] * right) / tree.cover[n]


@pytest.mark.parametrize("wide", [False, True])
def test_shapley_values_equal_brute_coalitions(spark, wide, monkeypatch):
    k = 8
    rng = np.random.default_rng(4)
    x = rng.integers(0, 6, (150, k)).astype(float)
    y = ((x[:, 0] + x[:, 1] * (x[:, 2] > 2) + x[:, 5] > 7) ^ (x[:, 7] > 4)).astype(float)
    x[::13, 3] = math.nan
    names = [f"f{i}" for i in range(k)]
    frame = spark.createDataFrame([(i, *map(float, r), float(v)) for i, (r, v) in enumerate(zip(x, y))],
                                  "doc_id long, " + ", ".join(f"{n} double" for n in names) + ", y double")
    model, _ = BT.fit(frame, None, names, {}, replace(PLAIN, rounds=2, max_depth=6, min_child_weight=0.05))
    if wide:  # the way of long paths, without tables of patterns
        from umpire.operators import explain as X
        monkeypatch.setattr(X._Path, "add", lambda self, v, phi: phi.__setitem__((slice(None), self.features), phi[:, self.features] + self.credit(self.taken(v).astype(float))))
    some = frame.where("doc_id < 14")
    got = {}
    for r in tree_shapley(model, some, "doc_id").collect():
        got.setdefault(r["doc_id"], {})[r["j"]] = r["phi"]
        assert r["base"] == base_margin(model) and r["feature"] == names[r["j"]]
    raw = {r["doc_id"]: r["margin"] for r in BT.margins(model, some).collect()}
    for i in range(14):
        def value(held):
            return sum(coalition_value(t, 0, x[i], held) for t in model.trees)
        assert base_margin(model) == pytest.approx(value(set()))
        for j in range(k):
            others = [o for o in range(k) if o != j]
            want = sum(math.factorial(s) * math.factorial(k - 1 - s) / math.factorial(k) * (value({*c, j}) - value(set(c)))
                       for s in range(k) for c in itertools.combinations(others, s))
            assert got[i][j] == pytest.approx(want, abs=1e-9)
        assert sum(got[i].values()) + base_margin(model) == pytest.approx(raw[i], abs=1e-9)


def test_proposals_follow_the_trials():
    drawn = MD.sample_params(6)
    def metric(c):
        return -abs(math.log(c["eta"] / 0.1)) - 0.1 * abs(c["max_depth"] - 8)
    trials = [(c, metric(c)) for c in drawn]
    a = MD.propose(trials, 2)
    assert a == MD.propose(trials[::-1], 2) and len(a) == 2 and a[0] != a[1]
    assert all(lo <= c[n] <= hi for c in a for n, lo, hi, _ in MD.RANGES)
    assert MD.propose(trials[:5], 2) != a and MD.propose(trials, 2, seed=7) != a
    assert MD.propose(trials + [(drawn[0], math.nan)], 2) == a
    assert MD.propose([], 2) == MD.sample_params(2)
    # given a score to climb, proposals are better than random draws
    found, random = list(trials), [metric(c) for c in MD.sample_params(200, seed=9)]
    while len(found) < 26:
        found += [(c, metric(c)) for c in MD.propose(found, 2)]
    late = sorted(m for _, m in found[-10:])
    assert sum(late) / 10 > sum(random) / 200 + 0.2 and late[-1] > sorted(random)[-20]


def test_surrogate_goes_through_its_trials():
    x = np.random.default_rng(1).random((6, 3))
    y = np.sin(3 * x[:, 0])
    mean, spread = MD._surrogate(x, (y - y.mean()) / y.std(), x)
    assert mean == pytest.approx((y - y.mean()) / y.std(), abs=0.05) and spread.max() < 0.1


def test_proposals_from_a_trial_table(spark):
    drawn = MD.sample_params(4)
    rows = [(i, *[float(c[r[0]]) for r in MD.RANGES], 0.6 + 0.05 * i) for i, c in enumerate(drawn)]
    table = spark.createDataFrame(rows, "trial int, " + ", ".join(f"`{r[0]}` double" for r in MD.RANGES) + ", auc double")
    assert MD.propose_from(table) == MD.propose([(dict(zip([r[0] for r in MD.RANGES], r[1:-1])), r[-1]) for r in rows])


def test_small_nodes_of_all_levels_take_one_pass(spark, monkeypatch):
    passes, finish = [], BT._finish_small
    monkeypatch.setattr(BT, "_finish_small", lambda state, rows, places, used: passes.append((state.round, {p.bit_length() for p in places})) or finish(state, rows, places, used))
    _, frame = data(spark)
    model, _ = BT.fit(frame.repartition(5), None, FEATURES, FILL, replace(PLAIN, max_depth=5, local_rows=40))
    assert [r for r, _ in passes] == [0, 1, 2] and any(len(levels) > 1 for _, levels in passes)
    whole, _ = BT.fit(frame, None, FEATURES, FILL, replace(PLAIN, max_depth=5))
    assert model.node_rows() == whole.node_rows()


def test_state_is_blocks_dealt_over_the_cores(spark):
    frame = spark.range(25_000).select(F.col("id").alias("h"), F.lit(1.0).alias("y"), (F.col("id") % 5 == 0).alias("valid"), F.col("id").cast("double").alias("x0"))
    blocks, n = BT._binned(frame.coalesce(1), ["a"], [np.array([10.0, 20.0])])
    assert n == 20_000 and blocks.agg(F.sum("rows"), F.max("rows")).first() == (25_000, 10_000)
    assert blocks.rdd.getNumPartitions() == min(3, spark.sparkContext.defaultParallelism)


def test_a_level_is_summed_by_the_driver_or_a_shuffle_alike(spark, monkeypatch):
    _, frame = data(spark)
    params = replace(PLAIN, max_depth=5, local_rows=20, colsample=0.7)
    here, _ = BT.fit(frame.repartition(5), None, FEATURES, FILL, params)
    monkeypatch.setattr(BT, "SUMMED", 0)
    there, _ = BT.fit(frame.repartition(5), None, FEATURES, FILL, params)
    assert here.node_rows() == there.node_rows() and len(here.node_rows()) > 9


def test_passes_of_a_round_read_its_kept_gradients(spark, monkeypatch):
    read, split, finish = [], BT._split_big, BT._finish_small
    monkeypatch.setattr(BT, "_split_big", lambda state, rows, places, used: read.append(rows.columns) or split(state, rows, places, used))
    monkeypatch.setattr(BT, "_finish_small", lambda state, rows, places, used: read.append(rows.columns) or finish(state, rows, places, used))
    _, frame = data(spark)
    params = replace(PLAIN, max_depth=5, local_rows=20, subsample=0.8)
    cached = spark.sparkContext._jsc.getPersistentRDDs().size()
    kept, _ = BT.fit(frame.repartition(5), None, FEATURES, FILL, params)
    assert len(read) > 6 and all(c == ["bins", "g", "h"] for c in read)
    assert spark.sparkContext._jsc.getPersistentRDDs().size() <= cached
    monkeypatch.setattr(BT, "KEPT_ROWS", 10 ** 9)
    state, _ = BT.fit(frame.repartition(5), None, FEATURES, FILL, params)
    assert "margin" in read[-1] and kept.node_rows() == state.node_rows()


@pytest.mark.parametrize("kind", ["<u2", "<f8"])
def test_walks_end_where_single_steps_do(kind):
    x = np.array([[0, 5], [3, 5], [4, 0], [9, 9]]).astype(kind)
    if kind == "<f8":
        x[1, 0] = np.nan
    feature, by, left, right = np.array([0, 1, -1, -1, -1]), np.array([3, 4, 0, 0, 0]), np.array([1, 3, 0, 0, 0]), np.array([2, 4, 0, 0, 0])
    def end(row, n=0):
        while feature[n] >= 0:
            n = left[n] if row[feature[n]] <= by[n] else right[n]
        return n
    assert BT._walk(x, feature, by, left, right).tolist() == [end(row) for row in x]
    assert BT._walk(x[:0], feature, by, left, right).tolist() == [] and BT._walk(x[:, :0], feature[2:3], by[:1], left[2:3], right[2:3]).tolist() == [0] * 4
