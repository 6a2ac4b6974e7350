import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from umpire.operators.ordered import row_rank, running_sums, with_position


def test_running_sums_match_pandas_with_hot_group(spark):
    rng = np.random.default_rng(7)
    n = 5000
    pdf = pd.DataFrame({"g": rng.choice(["hot", "b", None], n, p=[0.8, 0.15, 0.05]),
                        "k": rng.permutation(n), "v": rng.random(n)})
    out = running_sums(spark.createDataFrame(pdf), ["k"], {"cs": F.col("v"), "rk": F.lit(1)},
                       by=["g"], partitions=6, totals=True).toPandas()
    pdf["g2"] = pdf.g.fillna("~")
    exp = pdf.sort_values(["g2", "k"]).copy()
    exp["cs"] = exp.groupby("g2").v.cumsum()
    exp["rk"] = exp.groupby("g2").cumcount() + 1
    got = out.assign(g2=out.g.fillna("~")).merge(exp, on=["g2", "k"], suffixes=("", "_e"))
    assert len(got) == n
    assert np.allclose(got.cs, got.cs_e)
    assert (got.rk == got.rk_e).all()
    assert (got.groupby("g2").rk_total.first() == exp.groupby("g2").size()).all()


def test_hot_group_spreads_over_partitions(spark):
    df = spark.range(4000).select(F.lit("hot").alias("g"), F.col("id").alias("k"))
    out = row_rank(df, ["k"], by=["g"], partitions=8)
    assert sorted(r["rank"] for r in out.collect()) == list(range(1, 4001))


def test_row_rank_without_groups(spark):
    df = spark.range(1000).select((999 - F.col("id")).alias("k"))
    ranks = {r["k"]: r["rank"] for r in row_rank(df, ["k"]).collect()}
    assert all(ranks[k] == k + 1 for k in range(1000))


from hypothesis import given, settings
from hypothesis import strategies as st


@settings(max_examples=8, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["a", "b"]), st.integers(-5, 5)), min_size=1, max_size=60))
def test_running_sums_property(spark, rows):
    data = [(g, i, v) for i, (g, v) in enumerate(rows)]
    df = spark.createDataFrame(data, "g string, k long, v long")
    got = {r["k"]: r["s"] for r in running_sums(df, ["k"], {"s": F.col("v")}, by=["g"], partitions=3).collect()}
    acc = {}
    for g, k, v in data:
        acc[g] = acc.get(g, 0) + v
        assert got[k] == acc[g]


def test_one_hot_group_is_spread_evenly(spark):
    from umpire.operators.ordered import _checkpointed_ranges
    df = spark.range(20000).select(F.lit("hot").alias("g"), (F.col("id") * 7919 % 20000).alias("k"))
    parted = _checkpointed_ranges(df, ["g"], ["k"], 8)
    sizes = [r["n"] for r in parted.groupBy(F.spark_partition_id().alias("p")).agg(F.count("*").alias("n")).collect()]
    assert len(sizes) == 8 and max(sizes) < 2 * (20000 / 8)


def test_top_two_per_group_with_a_hot_group(spark):
    from umpire.operators.registry import top_k_per_group
    rows = [("hot", i, i, f"p{i}") for i in range(3000)] + [("cold", 1, 1, "c1")]
    df = spark.createDataFrame(rows, "g string, ts long, tb long, arn string")
    out = {r["g"]: (r["top1"], r["top2"]) for r in top_k_per_group(df, "g", "ts", "tb", "arn", k=2).collect()}
    assert out == {"hot": ("p2999", "p2998"), "cold": ("c1", None)}


def test_running_sums_carry_across_arrow_batches(spark):
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "50")
    try:
        df = spark.range(3000).select((F.col("id") % 3).alias("g"), F.col("id").alias("k"),
                                      F.lit(1).alias("v"))
        flat = {r["k"]: r["c"] for r in running_sums(df, ["k"], {"c": F.col("v")}, partitions=2).collect()}
        assert all(flat[k] == k + 1 for k in range(3000))
        grouped = {r["k"]: r["c"] for r in running_sums(df, ["k"], {"c": F.col("v")}, by=["g"],
                                                        partitions=2).collect()}
        assert all(grouped[k] == k // 3 + 1 for k in range(3000))
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_positions_follow_file_names_over_unequal_files(spark, tmp_path):
    from umpire.operators.joins import align_rows
    for folder, cuts in (("x", (0, 10, 1010, 1500)), ("y", (0, 900, 905, 1500))):
        (tmp_path / folder).mkdir()
        for part, (lo, hi) in enumerate(zip(cuts, cuts[1:])):
            body = "\n".join(str(i) for i in range(lo, hi))
            (tmp_path / folder / f"part{part}.csv").write_text(f"{folder}\n{body}\n")
    x, y = (spark.read.option("header", True).schema(f"{c} long").csv(str(tmp_path / c)) for c in "xy")
    rows = align_rows(x, y)
    assert rows.count() == 1500 and rows.filter("x <> y or x <> row_id").count() == 0


def test_positions_of_rows_dealt_anew_are_an_error(spark, tmp_path):
    path = str(tmp_path / "rows")
    spark.range(1000).repartition(3).write.parquet(path)
    with pytest.raises(ValueError):
        with_position(spark.read.parquet(path).repartition(4))
