"""Mergeable column statistics (A9-A12): baseline state by the hour, merged without the
rows, and the JSON documents of statistics and constraints.

The state of a column over some rows is one small row: counts, sum, mean and squared
deviations, least and greatest value, and two binary sketches, of distinct values
(HyperLogLog) and of quantiles (KLL).  States of any sets of rows merge by combining
aggregates, so a monitoring run adds its hour to the baseline's state and never reads
old rows again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from umpire.operators.quality import _long_form
from umpire.session import ensure_checkpoint_dir

DISTINCT_BITS = 14
QUANTILE_K = 4096
POINTS = 256
KEY = ["column", "inferred_type"]


def rank_error(k: int = QUANTILE_K) -> float:
    """Error of a rank read from one quantile sketch, which 99 of 100 sketches keep."""
    return 2.296 / k ** 0.9021


def drift_error(k: int = QUANTILE_K, points: int = POINTS) -> float:
    """Error of :func:`sketch_drift`: the ranks of both sketches at a point and between
    neighbouring points, and the share of a sketch between them."""
    return 4 * rank_error(k) + 1 / points


def column_state(df: DataFrame, cols: list[str], ts: str | None = None, window: str = "hour") -> DataFrame:
    """One row of state per column, or per column and ``window`` of ``ts``: one combining
    aggregate over the unpivoted rows.  No rows have no state."""
    by = []
    if ts:
        df, by = df.select(F.date_trunc(window, F.col(ts)).alias("window"), *cols), ["window"]
    long = _long_form(df, cols, tuple(by))
    return long.groupBy(*by, *KEY).agg(
        F.count(F.lit(1)).alias("num_rows"), F.count("str").alias("num_present"), F.count("num").alias("num_values"),
        F.sum("num").alias("sum"), F.avg("num").alias("mean"), (F.var_pop("num") * F.count("num")).alias("deviations"),
        F.min("num").alias("min"), F.max("num").alias("max"),
        F.hll_sketch_agg("str", F.lit(DISTINCT_BITS)).alias("distinct_sketch"),
        F.kll_sketch_agg_double(F.when(~F.isnan("num"), F.col("num")), F.lit(QUANTILE_K)).alias("quantile_sketch"))


def merge_state(states: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    """The states of a column (and of ``by``, such as a day) as one, by a combining aggregate.

    Squared deviations about the common mean are those about each state's own, and each
    state's distance from the common mean."""
    by = [*by, *KEY]
    total = states.groupBy(*by).agg(F.sum("sum").alias("_sum"), F.sum("num_values").alias("_n"))
    means = total.select(*by, (F.col("_sum") / F.nullif(F.col("_n"), F.lit(0))).alias("_mean"))
    away = F.col("deviations") + F.col("num_values") * (F.col("mean") - F.col("_mean")) * (F.col("mean") - F.col("_mean"))
    return states.join(means, by).groupBy(*by).agg(
        F.sum("num_rows").alias("num_rows"), F.sum("num_present").alias("num_present"), F.sum("num_values").alias("num_values"),
        F.sum("sum").alias("sum"), F.max("_mean").alias("mean"), F.sum(away).alias("deviations"),
        F.min("min").alias("min"), F.max("max").alias("max"),
        F.hll_union_agg("distinct_sketch").alias("distinct_sketch"), F.kll_merge_agg_double("quantile_sketch").alias("quantile_sketch"))


def profile_of(state: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    """The columns of ``quality.profile`` from states; ``distinct`` is an estimate."""
    return state.select(
        *by, *KEY, "num_rows", (F.col("num_rows") - F.col("num_present")).alias("num_missing"),
        (F.col("num_present") / F.col("num_rows")).alias("completeness"), "mean", "sum",
        F.sqrt(F.col("deviations") / F.col("num_values")).alias("std_dev"), "min", "max",
        F.hll_sketch_estimate("distinct_sketch").alias("distinct"))


def quantiles(state: DataFrame, at: list[float]) -> DataFrame:
    """(column, quantile, value) of numeric columns, from their states."""
    some = state.where(F.kll_sketch_get_n_double("quantile_sketch") > 0)
    ranks = F.array(*[F.lit(float(q)) for q in at])
    pairs = F.arrays_zip(ranks.alias("quantile"), F.kll_sketch_get_quantile_double("quantile_sketch", ranks).alias("value"))
    return some.select("column", F.explode(pairs).alias("p")).select("column", "p.quantile", "p.value")


def sketch_drift(base: DataFrame, current: DataFrame, points: int = POINTS) -> DataFrame:
    """Kolmogorov-Smirnov distance per numeric column from merged states: the greatest gap of
    both sketches' ranks at the quantiles of either.  It is within :func:`drift_error` of
    the exact distance; a column without values on a side is left out.  The driver holds
    the quantiles, twice ``points`` numbers a column."""
    ranks = F.array(*[F.lit((i + 1) / points) for i in range(points)])

    def side(state, name):
        some = state.where(F.kll_sketch_get_n_double("quantile_sketch") > 0)
        return some.select("column", F.col("quantile_sketch").alias(name), F.kll_sketch_get_n_double("quantile_sketch").alias(f"n_{name}"),
                           F.kll_sketch_get_quantile_double("quantile_sketch", ranks).alias(f"q_{name}"))

    ensure_checkpoint_dir(base.sparkSession)
    both = side(base, "base").join(side(current, "current"), "column").checkpoint()
    out = both.select("column", F.lit(0.0).alias("ks_distance"), "n_base", "n_current").limit(0)
    for r in both.select("column", F.array_sort(F.array_distinct(F.concat("q_base", "q_current"))).alias("at")).collect():
        at = F.array(*[F.lit(x) for x in r["at"]])  # the sketches are asked for ranks of constants
        read = both.where(F.col("column") == r["column"]).select("column", "n_base", "n_current", F.arrays_zip(
            F.kll_sketch_get_rank_double("base", at).alias("b"), F.kll_sketch_get_rank_double("current", at).alias("c")).alias("r"))
        gap = F.array_max(F.transform("r", lambda v: F.abs(v["b"] - v["c"])))
        out = out.unionByName(read.select("column", gap.alias("ks_distance"), "n_base", "n_current"))
    return out


# ------------------------------------------------------------------ documents
FEATURE = T.StructType([
    T.StructField("name", T.StringType()), T.StructField("inferred_type", T.StringType()), T.StructField("num_rows", T.LongType()),
    T.StructField("num_missing", T.LongType()), T.StructField("completeness", T.DoubleType()),
    T.StructField("numerical_statistics", T.StructType([T.StructField(c, T.DoubleType()) for c in ("mean", "sum", "std_dev", "min", "max")])),
    T.StructField("distinct_count", T.LongType())])
STATISTICS = T.StructType([T.StructField("version", T.IntegerType()), T.StructField("dataset", T.StructType([T.StructField("item_count", T.LongType())])),
                           T.StructField("features", T.ArrayType(FEATURE))])
LIMIT = T.StructType([T.StructField("name", T.StringType()), T.StructField("inferred_type", T.StringType()), T.StructField("completeness", T.DoubleType()),
                      T.StructField("num_constraints", T.StructType([T.StructField("is_non_negative", T.BooleanType())]))])
CONSTRAINTS = T.StructType([T.StructField("version", T.IntegerType()), T.StructField("features", T.ArrayType(LIMIT))])


def statistics_document(profile: DataFrame) -> DataFrame:
    """One row, one JSON text: the profile's columns, by name, under ``features``.

    A row per column of the data is gathered, as the document itself holds them."""
    feature = F.struct(
        F.col("column").alias("name"), "inferred_type", "num_rows", "num_missing", "completeness",
        F.when(F.col("inferred_type") != "String", F.struct("mean", "sum", "std_dev", "min", "max")).alias("numerical_statistics"),
        F.col("distinct").alias("distinct_count"))
    return profile.agg(F.array_sort(F.collect_list(feature)).alias("features"), F.max("num_rows").alias("n")).select(
        F.to_json(F.struct(F.lit(0).alias("version"), F.struct(F.coalesce("n", F.lit(0)).alias("item_count")).alias("dataset"), "features")).alias("document"))


def constraints_document(constraints: DataFrame) -> DataFrame:
    """One row, one JSON text: the suggested constraints, by name, under ``features``."""
    limit = F.struct(F.col("column").alias("name"), "inferred_type", F.col("completeness_threshold").alias("completeness"),
                     F.struct(F.col("non_negative").alias("is_non_negative")).alias("num_constraints"))
    return constraints.agg(F.array_sort(F.collect_list(limit)).alias("features")).select(
        F.to_json(F.struct(F.lit(0).alias("version"), "features")).alias("document"))


def _features(documents: DataFrame, col: str, schema: T.StructType) -> DataFrame:
    """The features of JSON documents; a text that is none is an error."""
    doc = F.from_json(F.col(col), schema)
    some = F.coalesce(doc["features"], F.raise_error(F.lit("the document has no features")).cast(schema["features"].dataType))
    return documents.select(F.posexplode(some).alias("position", "f")).select("position", "f.*")


def read_statistics(documents: DataFrame, col: str = "document") -> DataFrame:
    """The profile that a statistics document holds, and each column's position in it."""
    return _features(documents, col, STATISTICS).select(
        "position", F.col("name").alias("column"), "inferred_type", "num_rows", "num_missing", "completeness",
        "numerical_statistics.*", F.col("distinct_count").alias("distinct"))


def read_constraints(documents: DataFrame, col: str = "document") -> DataFrame:
    """The constraints that a document holds, for ``quality.violations``."""
    return _features(documents, col, CONSTRAINTS).select(
        F.col("name").alias("column"), "inferred_type", F.col("completeness").alias("completeness_threshold"),
        F.col("num_constraints.is_non_negative").alias("non_negative"))
