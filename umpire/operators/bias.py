"""Pre- and post-training bias metrics of a binary facet.

Formulas follow the published definitions (Hardt et al., KDD 2021, and the
public documentation of those metrics); signs are our reading of them:
``d`` is the facet selected by the facet rule, ``a`` the rest, ``q`` a
positive rate, ``'`` marks predicted labels.

Every metric comes from one combining aggregate of conditional counts
(the conditional-disparity metrics add one group-by on the group column),
so the cost is one or two passes whatever the data size.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def facet(col: Column | str, threshold: float) -> Column:
    """Facet membership by a numeric threshold (value > threshold)."""
    c = F.col(col) if isinstance(col, str) else col
    return c > F.lit(threshold)


def _div(a: Column, b: Column) -> Column:
    return F.when(b == 0, F.lit(None).cast("double")).otherwise(a.cast("double") / b.cast("double"))


def _cnt(c: Column) -> Column:
    return F.sum(F.when(c, 1).otherwise(0)).cast("long")


def _long(df: DataFrame, names: list[str]) -> DataFrame:
    pairs = ", ".join(f"'{n}', CAST(`{n}` AS DOUBLE)" for n in names)
    return df.selectExpr(f"stack({len(names)}, {pairs}) AS (metric, value)")


def _cdd(df: DataFrame, d: Column, pos: Column, group: str) -> DataFrame:
    """Conditional demographic disparity: sum_i n_i * DD_i / n with
    DD_i = n_d0_i / n0_i - n_d1_i / n1_i (of an outcome that a group lacks the share is 0)."""
    g = df.groupBy(group).agg(
        F.count(F.lit(1)).alias("n_i"),
        _cnt(~pos).alias("n0"), _cnt(pos).alias("n1"),
        _cnt(d & ~pos).alias("nd0"), _cnt(d & pos).alias("nd1"))
    dd = (F.coalesce(_div(F.col("nd0"), F.col("n0")), F.lit(0.0))
          - F.coalesce(_div(F.col("nd1"), F.col("n1")), F.lit(0.0)))
    return g.agg((F.sum(F.col("n_i") * dd) / F.sum("n_i")).alias("cdd"))


def pretraining_bias(df: DataFrame, d: Column, y: str, group: str) -> DataFrame:
    """CI, DPL, KL, JS, LP, TVD, KS and CDDL as (metric, value) rows."""
    pos = F.col(y) == 1
    c = df.agg(_cnt(~d).alias("na"), _cnt(d).alias("nd"),
               _cnt(~d & pos).alias("na1"), _cnt(d & pos).alias("nd1"))
    na, nd = F.col("na"), F.col("nd")
    qa, qd = _div(F.col("na1"), na), _div(F.col("nd1"), nd)

    def kl(p1: Column, p0: Column, r1: Column, r0: Column) -> Column:
        def term(p: Column, r: Column) -> Column:
            return F.when(p == 0, F.lit(0.0)).when(r == 0, F.lit(None).cast("double")).otherwise(p * F.log(p / r))
        return term(p1, r1) + term(p0, r0)

    m1, m0 = (qa + qd) / 2, ((1 - qa) + (1 - qd)) / 2
    out = c.select(
        _div(na - nd, na + nd).alias("CI"),
        (qa - qd).alias("DPL"),
        kl(qa, 1 - qa, qd, 1 - qd).alias("KL"),
        (0.5 * (kl(qa, 1 - qa, m1, m0) + kl(qd, 1 - qd, m1, m0))).alias("JS"),
        F.sqrt(F.pow(qa - qd, 2) + F.pow((1 - qa) - (1 - qd), 2)).alias("LP"),
        (0.5 * (F.abs(qa - qd) + F.abs((1 - qa) - (1 - qd)))).alias("TVD"),
        F.greatest(F.abs(qa - qd), F.abs((1 - qa) - (1 - qd))).alias("KS"))
    names = ["CI", "DPL", "KL", "JS", "LP", "TVD", "KS"]
    cdd = _cdd(df, d, pos, group).select(F.col("cdd").alias("value")).withColumn("metric", F.lit("CDDL"))
    return _long(out, names).unionByName(cdd.select("metric", "value"))


def posttraining_bias(df: DataFrame, d: Column, y: str, yhat: str, group: str) -> DataFrame:
    """DPPL, DI, DCA, DCR, RD, DAR, DRR, AD, SD, TE, GE and CDDPL as
    (metric, value) rows."""
    pos, pred = F.col(y) == 1, F.col(yhat) == 1
    aggs = []
    for tag, f in (("a", ~d), ("d", d)):
        aggs += [_cnt(f).alias(f"n_{tag}"), _cnt(f & pos).alias(f"n1_{tag}"), _cnt(f & pred).alias(f"p1_{tag}"),
                 _cnt(f & pos & pred).alias(f"tp_{tag}"), _cnt(f & ~pos & pred).alias(f"fp_{tag}"),
                 _cnt(f & pos & ~pred).alias(f"fn_{tag}"), _cnt(f & ~pos & ~pred).alias(f"tn_{tag}")]
    b = F.col(yhat).cast("double") - F.col(y).cast("double") + 1.0
    aggs += [F.count(F.lit(1)).alias("n"), F.sum(b).alias("sb"), F.sum(b * b).alias("sbb")]
    c = df.agg(*aggs)
    col = F.col

    def per(tag: str) -> dict[str, Column]:
        n, n1, p1 = col(f"n_{tag}"), col(f"n1_{tag}"), col(f"p1_{tag}")
        tp, fp, fn, tn = (col(f"{k}_{tag}") for k in ("tp", "fp", "fn", "tn"))
        return {"q": _div(p1, n), "ca": _div(n1, p1), "cr": _div(n - n1, n - p1),
                "rec": _div(tp, tp + fn), "prec": _div(tp, tp + fp), "npv": _div(tn, tn + fn),
                "acc": _div(tp + tn, n), "tnr": _div(tn, tn + fp), "te": _div(fn, fp)}

    a, dd = per("a"), per("d")
    mu = col("sb") / col("n")
    out = c.select(
        (a["q"] - dd["q"]).alias("DPPL"),
        _div(dd["q"], a["q"]).alias("DI"),
        (a["ca"] - dd["ca"]).alias("DCA"),
        (dd["cr"] - a["cr"]).alias("DCR"),
        (a["rec"] - dd["rec"]).alias("RD"),
        (a["prec"] - dd["prec"]).alias("DAR"),
        (dd["npv"] - a["npv"]).alias("DRR"),
        (a["acc"] - dd["acc"]).alias("AD"),
        (dd["tnr"] - a["tnr"]).alias("SD"),
        (dd["te"] - a["te"]).alias("TE"),
        ((col("sbb") / (mu * mu) - col("n")) / (2.0 * col("n"))).alias("GE"))
    names = ["DPPL", "DI", "DCA", "DCR", "RD", "DAR", "DRR", "AD", "SD", "TE", "GE"]
    cdd = _cdd(df, d, pred, group).select(F.col("cdd").alias("value")).withColumn("metric", F.lit("CDDPL"))
    return _long(out, names).unionByName(cdd.select("metric", "value"))


def flip_test(df: DataFrame, d: Column, yhat: str, cells: list[str]) -> DataFrame:
    """Flip test: members of ``d`` predicted 0 whose neighbours in the other facet
    are mostly predicted 1, less those predicted 1 with neighbours mostly 0, over
    all members.  Neighbours are the rows of the same cell (equal ``cells``, such
    as binned features); a tie or a cell without the other facet counts for
    neither.  One combining aggregate per cell: no pairs, and no hot cell."""
    pred = F.col(yhat) == 1
    per_cell = df.groupBy(*cells).agg(_cnt(d & pred).alias("d1"), _cnt(d & ~pred).alias("d0"),
                                      _cnt(~d & pred).alias("a1"), _cnt(~d & ~pred).alias("a0"))
    members = F.col("d0") + F.col("d1")
    flips = F.when(F.col("a1") > F.col("a0"), F.col("d0")).when(F.col("a0") > F.col("a1"), -F.col("d1")).otherwise(0)
    return per_cell.agg(F.sum(flips).alias("flips"), F.sum(members).alias("members"),
                        F.sum(F.when(F.col("a0") + F.col("a1") > 0, members).otherwise(0)).alias("compared")).select(
        F.lit("FT").alias("metric"), _div(F.col("flips"), F.col("members")).alias("value"), "members", "compared")
