"""Seeded sampling and outlier picks."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from umpire.functions.hashing import residue, seeded_int
from umpire.operators.ordered import with_position


def capture_sample(df: DataFrame, id_col: str, pct: int) -> DataFrame:
    """Keep ``pct`` percent of requests, chosen by a hash of the id (the same
    rows on every retry)."""
    return df.where(residue(id_col, 100) < F.lit(pct))


def sample_with_replacement(df: DataFrame, n: int = 100, seed: int = 42) -> DataFrame:
    """``min(n, rows)`` seeded draws with replacement.

    Rows are addressed by their read position (no shuffle, see
    ``with_position``); draw ``j`` picks position ``md5-hash(j) mod rows``.
    The draws table has at most ``n`` rows, so it is broadcast.
    """
    spark = df.sparkSession
    ranked = with_position(df, "_pos")
    total = ranked.count()
    if total == 0:
        return df.limit(0).withColumn("draw", F.lit(0).cast("long"))
    k = min(n, total)
    draws = spark.range(k).select(F.col("id").alias("draw"),
                                  F.pmod(seeded_int("id", seed), F.lit(total)).alias("_pos"))
    return ranked.join(F.broadcast(draws), "_pos").drop("_pos")


def zscore_outliers(df: DataFrame, value: str, id_col: str, n: int = 3) -> DataFrame:
    """The ``n`` lowest and ``n`` highest rows by z-score (population std) of
    ``value``.  Mean and std are one aggregate (two scalars); the extremes are
    two top-k scans, never a global sort."""
    stats = df.agg(F.avg(value).alias("m"), F.stddev_pop(value).alias("s")).first()
    mean, std = stats["m"], stats["s"]
    z = (F.col(value) - F.lit(mean)) / F.lit(std if std else float("nan"))
    low = df.orderBy(F.col(value).asc(), F.col(id_col).asc()).limit(n).withColumn("side", F.lit("low"))
    high = df.orderBy(F.col(value).desc(), F.col(id_col).asc()).limit(n).withColumn("side", F.lit("high"))
    return low.unionByName(high).withColumn("z", z)


def row_sum(array_col: str, base_last: bool = False):
    """Sum of a numeric array column as double (sequential fold); with
    ``base_last`` the last element is a base value and left out."""
    values = F.col(array_col)
    if base_last:
        values = F.slice(values, F.lit(1), F.greatest(F.size(values) - 1, F.lit(0)))
    return F.aggregate(values, F.lit(0.0), lambda acc, x: acc + x.cast("double"))
