"""Model-registry decisions: newest approved packages (shadow = newest,
production = second newest), newest package per group, the deployment
decision for an approval event, and the shadow-versus-production report.

Top-k per group is a ``row_number`` window with a rank filter, which Spark plans
as a group limit on both sides of the exchange.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from umpire.operators.metrics import _ratio


def _order_key(ts: str, tiebreak: str, payload: str) -> Column:
    return F.struct(F.col(ts).alias("ts"), F.col(tiebreak).alias("tb"), F.col(payload).alias("v"))


def top_k_per_group(df: DataFrame, group: str, ts: str, tiebreak: str, payload: str,
                    k: int = 2) -> DataFrame:
    """``group, top1, ..., topk`` payloads ordered newest first (null when a
    group has fewer than k rows).  ``row_number() <= k`` is planned as a group
    limit before the exchange: one scan, one exchange, at most k rows per group
    and task."""
    newest = Window.partitionBy(group).orderBy(F.col("_k").desc())
    top = (df.select(group, _order_key(ts, tiebreak, payload).alias("_k"))
           .withColumn("_rank", F.row_number().over(newest)).where(F.col("_rank") <= k))
    return top.groupBy(group).agg(*[
        F.max(F.when(F.col("_rank") == i, F.col("_k")))["v"].alias(f"top{i}") for i in range(1, k + 1)])


def latest_approved(registry: DataFrame, group: str = "group", ts: str = "created_at",
                    tiebreak: str = "package_id", arn: str = "arn", status: str = "status") -> DataFrame:
    """Per group: shadow = newest approved package, production = the one
    before it (null when only one is approved)."""
    approved = registry.where(F.col(status) == "Approved")
    top = top_k_per_group(approved, group, ts, tiebreak, arn, k=2)
    return top.select(group, F.col("top2").alias("production"), F.col("top1").alias("shadow"))


def latest(df: DataFrame, key: str, ts: str, tiebreak: str, cols: list[str]) -> DataFrame:
    """Newest row per key (``max_by`` on a (ts, tiebreak) struct)."""
    order = F.struct(F.col(ts), F.col(tiebreak))
    return df.groupBy(key).agg(
        F.max(F.col(ts)).alias(f"latest_{ts}"),
        *[F.max_by(F.col(c), order).alias(c) for c in cols])


def deploy_decision(events: DataFrame, registry: DataFrame, group: str = "group") -> DataFrame:
    """Decision per approval event: skip unless Approved; otherwise deploy the
    group's production and shadow packages.  An event without a detail counts as
    Approved; a detail without a status is never deployed."""
    status = F.when(F.col("detail").isNull(), F.lit("Approved")).otherwise(F.col("detail.ModelApprovalStatus"))
    ev = events.select("event_id", group, status.alias("approval_status"))
    pairs = latest_approved(registry, group=group)
    j = ev.join(pairs, group, "left")
    approved = F.coalesce(F.col("approval_status") == "Approved", F.lit(False))
    return j.select(
        "event_id", group, "approval_status",
        F.when(approved, "deploy").otherwise("skip").alias("action"),
        F.when(approved, F.col("production")).alias("production"),
        F.when(approved, F.col("shadow")).alias("shadow"),
        F.when(approved, "Endpoint deployed successfully").otherwise("Skipping deployment.").alias("message"))


def compare_variants(pairs: DataFrame, y: str, prod: str, shadow: str) -> DataFrame:
    """Agreement and per-variant F1 of paired 0/1 predictions in one pass;
    promote the shadow when its F1 is higher."""
    yy = F.col(y) == 1

    def cnt(c: Column) -> Column:
        return F.sum(F.when(c, 1).otherwise(0))

    agg = pairs.agg(
        F.count(F.lit(1)).alias("n"),
        F.avg((F.col(prod) == F.col(shadow)).cast("double")).alias("agreement"),
        *[x for v in (prod, shadow) for x in (
            cnt(yy & (F.col(v) == 1)).alias(f"tp_{v}"),
            cnt(~yy & (F.col(v) == 1)).alias(f"fp_{v}"),
            cnt(yy & (F.col(v) != 1)).alias(f"fn_{v}"))])

    def f1(v: str) -> Column:
        tp, fp, fn = F.col(f"tp_{v}"), F.col(f"fp_{v}"), F.col(f"fn_{v}")
        return _ratio(2 * tp, 2 * tp + fp + fn)

    return agg.select("n", "agreement", f1(prod).alias("production_f1"), f1(shadow).alias("shadow_f1"),
                      (f1(shadow) > f1(prod)).alias("promote_shadow"))
