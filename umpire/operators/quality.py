"""Data- and model-quality monitoring: column statistics, suggested
constraints, constraint violations, distribution drift and model-quality
checks against a baseline.

Statistics are one combining aggregate over an unpivoted (column, value)
table, so adding columns adds rows, not passes.  Drift uses distributed
running sums per column, never a column-wide window in one task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from umpire.operators.ordered import running_sums


def _type_name(dt: T.DataType) -> str:
    if isinstance(dt, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)):
        return "Integral"
    if isinstance(dt, (T.FloatType, T.DoubleType, T.DecimalType)):
        return "Fractional"
    return "String"


def _long_form(df: DataFrame, cols: list[str], keep: tuple[str, ...] = ()) -> DataFrame:
    """(*keep, column, type, num, str) rows: one per input row and column."""
    kinds = {f.name: _type_name(f.dataType) for f in df.schema.fields}
    parts = []
    for c in cols:
        num = f"CAST(`{c}` AS DOUBLE)" if kinds[c] != "String" else "CAST(NULL AS DOUBLE)"
        parts.append(f"'{c}', '{kinds[c]}', {num}, CAST(`{c}` AS STRING)")
    return df.selectExpr(*keep, f"stack({len(cols)}, {', '.join(parts)}) AS (column, inferred_type, num, str)")


def profile(df: DataFrame, cols: list[str] | None = None, exact_distinct: bool = True) -> DataFrame:
    """Per-column statistics: type, count, missing, completeness, mean, sum,
    population std, min, max and distinct count.

    ``exact_distinct=False`` counts distinct values with a HyperLogLog sketch
    (``approx_count_distinct``), which keeps the whole profile one combining
    aggregate on very large inputs."""
    cols = cols or df.columns
    long = _long_form(df, cols)
    distinct = F.countDistinct("str") if exact_distinct else F.approx_count_distinct("str")
    return (long.groupBy("column", "inferred_type").agg(
        F.count(F.lit(1)).alias("num_rows"),
        F.sum(F.col("str").isNull().cast("long")).alias("num_missing"),
        (F.count("str") / F.count(F.lit(1))).alias("completeness"),
        F.avg("num").alias("mean"), F.sum("num").alias("sum"),
        F.stddev_pop("num").alias("std_dev"), F.min("num").alias("min"), F.max("num").alias("max"),
        distinct.alias("distinct")))


def histogram(df: DataFrame, cols: list[str], buckets: int = 10) -> DataFrame:
    """Equal-width histogram between each numeric column's min and max.

    The per-column bounds table has one row per column (bounded) and is
    broadcast to the unpivoted rows."""
    long = _long_form(df, cols).where(F.col("num").isNotNull())
    bounds = long.groupBy("column").agg(F.min("num").alias("lo"), F.max("num").alias("hi"))
    width = (F.col("hi") - F.col("lo")) / buckets
    b = F.when(F.col("hi") == F.col("lo"), F.lit(0)).otherwise(
        F.least(F.floor((F.col("num") - F.col("lo")) / width), F.lit(buckets - 1))).cast("int")
    counted = (long.join(F.broadcast(bounds), "column")
               .groupBy("column", b.alias("bucket"), "lo", "hi").agg(F.count(F.lit(1)).alias("count")))
    return counted.select(
        "column", "bucket",
        (F.col("lo") + (F.col("hi") - F.col("lo")) * F.col("bucket") / buckets).alias("lower"),
        (F.col("lo") + (F.col("hi") - F.col("lo")) * (F.col("bucket") + 1) / buckets).alias("upper"),
        "count")


def suggest_constraints(stats: DataFrame) -> DataFrame:
    """Constraints from a baseline profile: type, completeness, non-negativity."""
    return stats.select(
        "column", "inferred_type", F.col("completeness").alias("completeness_threshold"),
        F.when(F.col("inferred_type") == "String", F.lit(None).cast("boolean"))
         .otherwise(F.col("min") >= 0).alias("non_negative"))


def violations(current: DataFrame, constraints: DataFrame) -> DataFrame:
    """Checks of a current profile against constraints, one row per violation."""
    j = current.alias("c").join(constraints.alias("k"), "column")
    checks = F.array(
        F.when(F.col("c.inferred_type") != F.col("k.inferred_type"), F.struct(
            F.lit("data_type_check").alias("check"),
            F.concat(F.lit("Expected type "), F.col("k.inferred_type"), F.lit(", found "),
                     F.col("c.inferred_type")).alias("description"))),
        F.when(F.col("c.completeness") < F.col("k.completeness_threshold"), F.struct(
            F.lit("completeness_check").alias("check"),
            F.concat(F.lit("Completeness "), F.format_string("%.6f", F.col("c.completeness")),
                     F.lit(" is below "), F.format_string("%.6f", F.col("k.completeness_threshold")))
            .alias("description"))),
        F.when(F.col("k.non_negative") & (F.col("c.min") < 0), F.struct(
            F.lit("non_negative_check").alias("check"),
            F.concat(F.lit("Minimum "), F.format_string("%.6f", F.col("c.min")),
                     F.lit(" is negative")).alias("description"))))
    return (j.select("column", F.explode(F.filter(checks, lambda x: x.isNotNull())).alias("v"))
            .select("column", "v.check", "v.description"))


def drift(base: DataFrame, current: DataFrame, cols: list[str]) -> DataFrame:
    """Two-sample Kolmogorov-Smirnov distance per numeric column.

    Values of both sides are counted per (column, value) (combining), then
    running sums per column over the values give both empirical CDFs."""
    def counts(df: DataFrame, side: str) -> DataFrame:
        long = _long_form(df, cols).where(F.col("num").isNotNull())
        return long.groupBy("column", "num").agg(F.count(F.lit(1)).alias(side))

    both = (counts(base, "n_base").join(counts(current, "n_cur"), ["column", "num"], "full_outer")
            .fillna(0, ["n_base", "n_cur"]))
    cum = running_sums(both, ["num"], {"c_base": F.col("n_base"), "c_cur": F.col("n_cur")},
                       by=["column"], totals=True)
    gap = F.abs(F.col("c_base") / F.col("c_base_total") - F.col("c_cur") / F.col("c_cur_total"))
    return cum.groupBy("column").agg(F.max(gap).alias("ks_distance"),
                                     F.max("c_base_total").alias("n_base"),
                                     F.max("c_cur_total").alias("n_current"))


def quality_violations(current: DataFrame, baseline: DataFrame, metrics: list[str],
                       tolerance: float = 0.0) -> DataFrame:
    """Model-quality check: a metric below its baseline value (minus the
    tolerance) is a violation.  Both inputs are one-row metric frames."""
    def longm(df: DataFrame, name: str) -> DataFrame:
        pairs = ", ".join(f"'{m}', CAST(`{m}` AS DOUBLE)" for m in metrics)
        return df.selectExpr(f"stack({len(metrics)}, {pairs}) AS (metric, {name})")

    j = longm(baseline, "baseline").join(longm(current, "current"), "metric")
    return j.select("metric", "baseline", "current",
                    (F.col("current") < F.col("baseline") - F.lit(tolerance)).alias("violated"))
