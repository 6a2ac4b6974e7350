"""Explanation tables: exact Shapley values of tree ensembles, global importance
from per-row Shapley values, training-metric series, per-row explanations with a
logit link."""

from __future__ import annotations

from math import factorial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from umpire.operators.boosting import BoostedTrees, Tree, filled


def shap_long(df: DataFrame, id_col: str, matrix: str, names: list[str] | None = None) -> DataFrame:
    """(row, feature, phi) rows from a Shapley matrix whose last entry is the
    base value; ``base`` is carried on every row."""
    base = F.element_at(F.col(matrix), -1).cast("double")
    phis = F.slice(F.col(matrix), 1, F.size(F.col(matrix)) - 1)
    ex = df.select(id_col, base.alias("base"), F.posexplode(phis).alias("j", "phi"))
    feat = F.concat(F.lit("f"), F.col("j").cast("string"))
    if names:
        arr = F.array(*[F.lit(n) for n in names])
        feat = F.coalesce(F.element_at(arr, F.col("j") + 1), feat)
    return ex.select(id_col, "j", feat.alias("feature"), F.col("phi").cast("double").alias("phi"), "base")


def global_importance(long: DataFrame) -> DataFrame:
    """Mean absolute Shapley value per feature (combining aggregate)."""
    return long.groupBy("j", "feature").agg(F.avg(F.abs("phi")).alias("mean_abs_shap"))


def metric_series(tensors: DataFrame, collection: str = "metrics",
                  names: list[str] | None = None) -> DataFrame:
    """Training metrics by step, one column per metric (pivot with explicit
    values when given, so no extra pass to find them)."""
    t = tensors.where(F.col("collection") == collection)
    g = t.groupBy("step")
    g = g.pivot("name", names) if names else g.pivot("name")
    return g.agg(F.avg("value"))


def explain_rows(df: DataFrame, id_col: str, matrix: str) -> DataFrame:
    """Per row: base value, sum of contributions, margin and its logit-link
    probability ``1 / (1 + exp(-margin))``."""
    base = F.element_at(F.col(matrix), -1).cast("double")
    phis = F.slice(F.col(matrix), 1, F.size(F.col(matrix)) - 1)
    total = F.aggregate(phis, F.lit(0.0), lambda acc, x: acc + x.cast("double"))
    out = df.select(id_col, base.alias("base"), total.alias("phi_sum"))
    margin = F.col("base") + F.col("phi_sum")
    return out.select(id_col, "base", "phi_sum", margin.alias("margin"),
                      (1.0 / (1.0 + F.exp(-margin))).alias("probability"))


# ------------------------------------------------------------------ trees
class _Path:
    """The way to a leaf: for each feature on it, the interval (low, high] that its
    splits leave and the share of cover that follows them."""

    def __init__(self, value: float, steps: dict[int, tuple[float, float, float]]):
        self.value = value
        self.features = np.array(list(steps), dtype=np.int64)
        self.low, self.high, self.share = (np.array([v[i] for v in steps.values()]) for i in range(3))
        self.table: np.ndarray | None = None

    def taken(self, x: np.ndarray) -> np.ndarray:
        """Whether each row's own value follows the path, per feature; a missing value
        goes right at every split."""
        v = x[:, self.features]
        return np.where(np.isnan(v), self.high == np.inf, (v > self.low) & (v <= self.high))

    def credit(self, taken: np.ndarray) -> np.ndarray:
        """Shapley values of the leaf's game for rows of a pattern: a coalition reaches
        the leaf by the features it holds where the row follows, else by their share.

        For each feature the products over the others are a polynomial in the size of
        the coalition, whose coefficients the Shapley weights sum."""
        m = len(self.features)
        weight = np.array([factorial(s) * factorial(m - 1 - s) / factorial(m) for s in range(m)])
        out = np.empty(taken.shape)
        for j in range(m):
            sizes = np.zeros(taken.shape)
            sizes[:, 0] = 1.0
            for i in range(m):
                if i != j:
                    grown = sizes * self.share[i]
                    grown[:, 1:] += sizes[:, :-1] * taken[:, i:i + 1]
                    sizes = grown
            out[:, j] = (taken[:, j] - self.share[j]) * (sizes @ weight) * self.value
        return out

    def add(self, x: np.ndarray, phi: np.ndarray) -> None:
        m, taken = len(self.features), self.taken(x)
        if m <= 10:  # all patterns once
            if self.table is None:
                self.table = self.credit((np.arange(1 << m)[:, None] >> np.arange(m) & 1).astype(float))
            phi[:, self.features] += self.table[taken @ (1 << np.arange(m))]
        else:
            phi[:, self.features] += self.credit(taken.astype(float))


def _paths(tree: Tree) -> list[_Path]:
    out, stack = [], [(0, {})]
    while stack:
        n, steps = stack.pop()
        if tree.feature[n] < 0:
            out.append(_Path(float(tree.value[n]), steps))
            continue
        j, t = int(tree.feature[n]), float(tree.threshold[n])
        low, high, share = steps.get(j, (-np.inf, np.inf, 1.0))
        for child, bounds in ((tree.left[n], (low, min(high, t))), (tree.right[n], (max(low, t), high))):
            part = float(tree.cover[child] / tree.cover[n]) if tree.cover[n] > 0 else 0.0
            stack.append((int(child), {**steps, j: (*bounds, share * part)}))
    return out


def base_margin(model: BoostedTrees) -> float:
    """The trees' mean by cover: what no feature accounts for."""
    return sum(p.value * float(np.prod(p.share)) for t in model.trees for p in _paths(t))


def tree_shapley(model: BoostedTrees, df: DataFrame, id_col: str) -> DataFrame:
    """Exact Shapley values of every row's margin: (id, j, feature, phi, base) rows.

    The value of a coalition is the trees' mean where the features outside it follow
    both branches in proportion to cover.  ``base`` and a row's values sum to its
    margin.  Work is rows x leaves x features; nothing is shuffled."""
    base, names = base_margin(model), model.features
    columns = [f"x{j}" for j in range(len(names))]
    rows = df.select(F.col(id_col).alias("id"), *[c.alias(x) for c, x in zip(filled(df, names, model.fill), columns)])
    kind = df.schema[id_col].dataType.simpleString()

    def run(batches):
        paths = [p for t in model.trees for p in _paths(t) if len(p.features)]
        for batch in batches:
            x = np.column_stack([batch.column(1 + j).to_numpy(zero_copy_only=False).astype(float) for j in range(len(names))])
            phi = np.zeros(x.shape)
            for p in paths:
                p.add(x, phi)
            n, k = x.shape
            ids = batch.column(0).take(pa.array(np.repeat(np.arange(n), k)))
            yield pa.RecordBatch.from_arrays([ids, pa.array(np.tile(np.arange(k, dtype=np.int32), n)), pa.array(phi.ravel())], ["id", "j", "phi"])

    long = rows.mapInArrow(run, f"id {kind}, j int, phi double")
    return long.select(F.col("id").alias(id_col), "j", F.element_at(F.array(*[F.lit(c) for c in names]), F.col("j") + 1).alias("feature"),
                       "phi", F.lit(base).alias("base"))
