import pytest

from umpire.operators import prepare as P
from umpire.sources.testdata import DOC_FEATURES


def test_median_averages_middle_values(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (4.0,), (9.0,), (None,)], "x double")
    assert P.fit_medians(df, ["x"]) == {"x": 3.0}


def test_median_odd_count_and_impute(spark):
    df = spark.createDataFrame([(5.0, 1), (None, 2), (1.0, 3), (3.0, 4)], "x double, id int")
    med = P.fit_medians(df, ["x"])
    assert med == {"x": 3.0}
    out = {r["id"]: r["x"] for r in P.impute(df, med).collect()}
    assert out[2] == 3.0 and out[1] == 5.0


def test_stratified_split_keeps_ratios(spark):
    rows = [(i, "home_win" if i % 4 else "home_not_win") for i in range(400)]
    df = spark.createDataFrame(rows, "id long, result_match string")
    out = P.stratified_split(df, "result_match", "id").groupBy("result_match", "split").count().collect()
    got = {(r[0], r[1]): r[2] for r in out}
    assert got[("home_win", "train")] == 210 and got[("home_win", "validation")] == 45
    assert got[("home_not_win", "train")] == 70 and got[("home_not_win", "test")] == 15


def test_split_is_seeded_and_stable(spark):
    df = spark.createDataFrame([(i, "a") for i in range(50)], "id long, result_match string")
    a = {r["id"]: r["split"] for r in P.stratified_split(df, "result_match", "id").collect()}
    b = {r["id"]: r["split"] for r in P.stratified_split(df, "result_match", "id").collect()}
    assert a == b


def test_split_places_equal_the_order_of_hashes(spark):
    """Against sorting each class, with a null class, an empty cut and repeated ids."""
    import hashlib
    sizes = {"a": 701, "b": 3, None: 40, "d": 1}
    rows = [(i * 10 + k, g) for k, (g, n) in enumerate(sizes.items()) for i in range(n)]
    df = spark.createDataFrame(rows, "id long, label string").repartition(5)
    got = {r["id"]: r["split"] for r in P.stratified_split(df, "label", "id").collect()}
    want = {}
    for g, n in sizes.items():
        order = sorted((i for i, h in rows if h == g), key=lambda i: hashlib.md5(f"42|{i}".encode()).hexdigest())
        for at, i in enumerate(order):
            want[i] = "train" if at < (n * 140 + 100) // 200 else "validation" if at < (n * 170 + 100) // 200 else "test"
    assert got == want
    twice = P.stratified_split(df.union(df), "label", "id").groupBy("id").agg({"split": "min"}).count()
    assert twice == len(rows)
    plan = P.stratified_split(df, "label", "id")._jdf.queryExecution().toString()
    assert "rangepartitioning" not in plan
    assert P.stratified_split(df.where("false"), "label", "id").count() == 0


def test_many_classes_are_ranked(spark, monkeypatch):
    rows = [(i, f"c{i % 7}") for i in range(300)]
    df = spark.createDataFrame(rows, "id long, label string")
    cut = {r["id"]: r["split"] for r in P.stratified_split(df, "label", "id").collect()}
    monkeypatch.setattr(P, "MOST_CUT", 3)
    assert {r["id"]: r["split"] for r in P.stratified_split(df, "label", "id").collect()} == cut


def test_keys_at_ranks_refine_buckets(spark):
    import hashlib
    from umpire.operators.selection import keys_at_ranks
    keys = [hashlib.md5(str(i).encode()).hexdigest() for i in range(900)] + ["ab" * 16] * 400 + ["ab" * 15 + "ff"] * 7
    df = spark.createDataFrame([("g", k) for k in keys] + [("g", None), ("h", "0" * 32)], "grp string, key string")
    for small in (20_000, 5, 1):
        got = keys_at_ranks(df, "grp", "key", lambda n: [0, 1, n // 2, n - 1, n], small=small)
        order = sorted(keys)
        n = len(order)
        assert got == {"g": ["", order[0], order[n // 2 - 1], order[n - 2], order[n - 1]], "h": ["", "0" * 32, "", "", "0" * 32]}


def test_too_many_classes_are_an_error(spark, monkeypatch):
    monkeypatch.setattr(P, "MOST_CLASSES", 3)
    with pytest.raises(ValueError):
        P.fit_ordinal(spark.createDataFrame([(str(i),) for i in range(4)], "c string"), "c")


def test_encode_sorted_classes_and_unknown_fails(spark):
    train = spark.createDataFrame([("home_win",), ("home_not_win",)], "result_match string")
    classes = P.fit_ordinal(train, "result_match")
    assert classes == ["home_not_win", "home_win"]
    codes = [r["result_match"] for r in P.encode(train, "result_match", classes).collect()]
    assert sorted(codes) == [0.0, 1.0]
    bad = spark.createDataFrame([("draw",)], "result_match string")
    with pytest.raises(Exception):
        P.encode(bad, "result_match", classes).collect()


def test_zip_by_position_gives_nulls_for_unequal_lengths(spark):
    a = spark.createDataFrame([(1,), (2,), (3,)], "x int")
    b = spark.createDataFrame([("p",), ("q",)], "y string")
    out = sorted((r["row_id"], r["x"], r["y"]) for r in P.zip_columns(a, b).collect())
    assert out == [(0, 1, "p"), (1, 2, "q"), (2, 3, None)]


def test_baselines(spark):
    df = spark.createDataFrame([(1.0, "home_win"), (None, "home_win"), (2.0, "home_not_win")],
                               "x double, result_match string")
    train = P.baseline(df, "result_match", keep_label=False)
    test = P.baseline(df, "result_match", keep_label=True)
    assert train.columns == ["x"] and train.count() == 2
    assert test.columns == ["result_match", "x"]


def test_shuffle_rank_is_a_permutation(spark):
    df = spark.range(200).withColumnRenamed("id", "doc_id")
    pos = sorted(r["position"] for r in P.shuffle_rank(df, "doc_id").collect())
    assert pos == list(range(1, 201))


def test_approximate_medians_are_observed_values(spark):
    df = spark.createDataFrame([(float(i),) for i in range(1, 102)], "x double")
    assert P.fit_medians(df, ["x"], exact=False) == {"x": 51.0}
    assert P.fit_medians(df, ["x"]) == {"x": 51.0}


@pytest.mark.parametrize("name,columns", [("s7_test_baseline", ["result_match", "doc_id", *DOC_FEATURES]),
                                          ("s7_train_baseline", ["doc_id", *DOC_FEATURES])])
def test_baseline_queries_keep_the_id(spark, tmp_path, name, columns):
    from umpire.plans.catalog import REGISTRY
    docs = [(i, "s", "en", f"some words. of {i}", 12 + i) for i in range(1, 41)]
    spark.createDataFrame(docs, "doc_id long, source string, lang string, text string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(d[0], d[0] % 2) for d in docs], "doc_id long, quality int").write.parquet(f"{tmp_path}/labels.parquet")
    out = REGISTRY[name](spark, str(tmp_path))
    rows = out.collect()
    assert out.columns == columns and rows
    assert len({r["doc_id"] for r in rows}) == len(rows) and all(0 < r["doc_id"] <= 40 for r in rows)
