"""Second-order boosted trees for a binary label (M1): logistic loss, histograms of
gradients and hessians, L1 and L2 terms, least child weight, a sample of rows and
of columns per tree.

* **Cuts.** Each feature gets at most ``bins`` cut points at exact quantiles of its
  distinct values (one ordered pass over their counts).  Rows keep the bin of every
  feature; a split ``x <= cut`` is one on bins.
* **Blocks.** The training state is a row per ``BLOCK`` training rows, a column of each as
  bytes, dealt evenly over the cores; a pass reads arrays and no single rows.
* **Rounds.** Where a tree takes several passes, the sampled rows with their gradients are
  kept for them, so the trees before are applied once a round.
* **Levels.** An open node with many rows is split by tables of (bin) sums per node and
  feature: a partial table per task, summed by node and feature, the best split of each.
  The driver adds up the tables of a level if all tasks' have at most ``SUMMED`` cells.
  A node of at most ``local_rows`` rows waits until no larger one is open; then all of
  these go in one pass with their rows to a task each, which grows the rest of the
  subtree by the same rule.  Of two children only the smaller one's sums are taken there,
  the other's are the difference.
* **Same trees everywhere.** Gradients are whole numbers of 2^-28, so sums do not
  hang on the order or the partitioning of rows (up to 10^10 rows); rows are sampled
  by a hash of their id and the tree's number.

The driver holds cut points, trees and one loss per round.
"""

from __future__ import annotations

import functools
import json
from dataclasses import dataclass, field, replace

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from umpire.operators.ordered import running_sums
from umpire.session import ensure_checkpoint_dir

UNIT = float(1 << 28)
LEAST_GAIN = 1e-6
CELLS = 1 << 22  # of a task's dense table
SUMMED = 1 << 20  # cells of all tasks' tables of a level that the driver adds up; more go through a shuffle
BLOCK = 10_000  # training rows in a row of the state, at most
KEPT_ROWS = 4  # times ``local_rows``: of more rows a round's gradients are kept for its passes
KEPT_TREES = 10  # trees applied anew in each pass before margins are written
NODE = "tree int, node int, feature int, threshold double, left int, right int, value double, gain double, cover double, rows long"


@dataclass(frozen=True)
class TreeParams:
    """Trainer settings.  Fixed values: the defaults are the reference's."""
    rounds: int = 120
    eta: float = 0.10552574516231328
    max_depth: int = 9
    subsample: float = 0.8953781772368965
    colsample: float = 0.8448004658642061
    reg_lambda: float = 9.082892225273682
    reg_alpha: float = 5.065713059538013
    min_child_weight: float = 0.49876571387552704
    scale_pos_weight: float = 2.0
    bins: int = 256
    seed: int = 42
    local_rows: int = 100_000

    def __post_init__(self):
        if not (0 < self.subsample <= 1 and 0 < self.colsample <= 1 and 1 <= self.max_depth <= 24 and 2 <= self.bins <= 4096):
            raise ValueError("sampling rates lie in (0, 1], depth in 1 to 24, bins in 2 to 4096")
        if min(self.reg_lambda, self.reg_alpha, self.min_child_weight) < 0 or self.eta <= 0 or self.scale_pos_weight <= 0:
            raise ValueError("regularisation is not negative; rates and weights are positive")


@dataclass
class Tree:
    """One tree: parallel arrays by node; ``feature`` is -1 at a leaf."""
    feature: np.ndarray
    threshold: np.ndarray
    cut: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray
    gain: np.ndarray
    cover: np.ndarray
    rows: np.ndarray

    def leaves(self, x: np.ndarray, by: np.ndarray) -> np.ndarray:
        """The node where each row ends; ``by`` is ``threshold`` for values, ``cut`` for bins."""
        return _walk(x, self.feature, by, self.left, self.right)


def _walk(x: np.ndarray, feature: np.ndarray, by: np.ndarray, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """The node where each row ends; a missing value goes right, a leaf is its own child."""
    node, inner = np.arange(len(feature)), feature >= 0
    j, child = np.maximum(feature, 0), np.where(inner, [right, left], node).T.ravel()
    by = by.astype(x.dtype) if x.dtype.kind == "u" else by
    at, flat, start = np.zeros(len(x), dtype=np.int64), np.ascontiguousarray(x).ravel(), np.arange(len(x)) * x.shape[1]
    take = functools.partial(np.take, mode="clip")  # spares a check of each index
    while take(inner, at).any():
        less = take(flat, start + take(j, at)) <= take(by, at)
        at = take(child, 2 * at + less)
    return at


@dataclass
class BoostedTrees:
    """Fitted trees with their features' names and the values put for missing ones."""
    features: list[str]
    fill: dict[str, float | None]
    trees: list[Tree] = field(default_factory=list)

    def first(self, k: int) -> "BoostedTrees":
        return replace(self, trees=self.trees[:k])

    def margin(self, x: np.ndarray) -> np.ndarray:
        """Sum of leaf values, rows of doubles."""
        out = np.zeros(len(x))
        for t in self.trees:
            out += t.value[t.leaves(x, t.threshold)]
        return out

    def node_rows(self) -> list[tuple]:
        return [(i, n, int(t.feature[n]), float(t.threshold[n]), int(t.left[n]), int(t.right[n]), float(t.value[n]), float(t.gain[n]),
                 float(t.cover[n]), int(t.rows[n])) for i, t in enumerate(self.trees) for n in range(len(t.feature))]

    def nodes(self, spark: SparkSession) -> DataFrame:
        """The node table: a row per node of every tree."""
        return spark.createDataFrame(self.node_rows(), NODE)

    def save(self, spark: SparkSession, path: str) -> None:
        base = path.rstrip("/")
        self.nodes(spark).coalesce(1).write.mode("overwrite").parquet(f"{base}/nodes")
        meta = json.dumps({"features": self.features, "fill": self.fill, "trees": len(self.trees)})
        spark.createDataFrame([(meta,)], "value string").coalesce(1).write.mode("overwrite").text(f"{base}/meta")

    @staticmethod
    def load(spark: SparkSession, path: str) -> "BoostedTrees":
        base = path.rstrip("/")
        meta = json.loads(spark.read.text(f"{base}/meta").first()["value"])
        rows = spark.read.parquet(f"{base}/nodes").toPandas().sort_values(["tree", "node"])
        trees = []
        for i in range(meta["trees"]):
            part = {c: v.to_numpy() for c, v in rows[rows["tree"] == i].items()}
            trees.append(Tree(cut=np.zeros(len(part["node"]), dtype=np.int64), **{c: part[c] for c in (
                "feature", "threshold", "left", "right", "value", "gain", "cover", "rows")}))
        return BoostedTrees(meta["features"], meta["fill"], trees)


# ------------------------------------------------------------------ the rule of a split
def _pull(g, params: TreeParams):
    """A gradient sum less its L1 term."""
    return np.sign(g) * np.maximum(np.abs(g) - params.reg_alpha, 0.0)


def leaf_value(g: int, h: int, params: TreeParams) -> float:
    """The step that a leaf of these sums takes."""
    if h <= 0:
        return 0.0
    return float(-params.eta * _pull(g / UNIT, params) / (h / UNIT + params.reg_lambda))


def best_split(g: np.ndarray, h: np.ndarray, n: np.ndarray, params: TreeParams):
    """(feature, bin, gain, (g, h, n) of the left child) of the best split of a node whose
    sums are (features, bins) tables, or None.  Ties go to the first feature and bin."""
    gl, hl, nl = np.cumsum(g, axis=1), np.cumsum(h, axis=1), np.cumsum(n, axis=1)
    g_all, h_all, n_all = gl[:, -1:], hl[:, -1:], nl[:, -1:]

    def score(a, b):
        pulled = _pull(a / UNIT, params)
        return pulled * pulled / np.maximum(b / UNIT + params.reg_lambda, 1e-12)

    gain = 0.5 * (score(gl, hl) + score(g_all - gl, h_all - hl) - score(g_all, h_all))
    fit = ((nl > 0) & (nl < n_all) & (hl / UNIT >= params.min_child_weight) & ((h_all - hl) / UNIT >= params.min_child_weight))
    gain = np.where(fit, gain, -np.inf)
    at = int(np.argmax(gain))
    j, b = divmod(at, g.shape[1])
    if not gain[j, b] > LEAST_GAIN:
        return None
    return j, b, float(gain[j, b]), (int(gl[j, b]), int(hl[j, b]), int(nl[j, b]))


def _tables(node: np.ndarray, bins: np.ndarray, g: np.ndarray, h: np.ndarray, used: np.ndarray, width: int, nodes: int):
    """(nodes, features, bins) sums of g, h and counts of a batch of rows."""
    out = [np.empty((nodes, len(used), width), dtype=np.int64) for _ in range(3)]
    # sums of a batch stay below 2^53, so doubles hold them exactly
    weights, first = (g.astype(float), h.astype(float), None), node * width
    for j, f in enumerate(used):
        key = first + bins[:, f]
        for table, w in zip(out, weights):
            table[:, j, :] = np.bincount(key, weights=w, minlength=nodes * width).reshape(nodes, width)
    return out


def grow(bins: np.ndarray, g: np.ndarray, h: np.ndarray, used: np.ndarray, width: int, depth: int, params: TreeParams) -> list[tuple]:
    """A subtree of at most ``depth`` levels over rows in memory, as heap rows
    (place, feature, bin, gain, g, h, n) with the root at place 1; feature -1 is a leaf."""
    def tables(rows):
        return [t[0] for t in _tables(np.zeros(len(rows), dtype=np.int64), bins[rows], g[rows], h[rows], used, width, 1)]

    out, stack = [], [(1, np.arange(len(g)), depth, None)]
    while stack:
        place, rows, left, sums = stack.pop()
        split = None
        if left > 0 and len(rows) > 1:
            sums = tables(rows) if sums is None else sums
            split = best_split(*sums, params)
        if split is None:
            out.append((place, -1, 0, 0.0, int(g[rows].sum()), int(h[rows].sum()), len(rows)))
            continue
        j, b, gain, _ = split
        out.append((place, int(used[j]), b, gain, *(int(t[0].sum()) for t in sums)))
        goes_left = bins[rows, used[j]] <= b
        less, more = rows[goes_left], rows[~goes_left]
        of_less = of_more = None
        if left > 1:
            few = tables(less if len(less) <= len(more) else more)
            rest = [a - c for a, c in zip(sums, few)]
            of_less, of_more = (few, rest) if len(less) <= len(more) else (rest, few)
        stack += [(2 * place, less, left - 1, of_less), (2 * place + 1, more, left - 1, of_more)]
    return out


# ------------------------------------------------------------------ cuts and bins
def cut_points(rows: DataFrame, features: list[str], bins: int) -> list[np.ndarray]:
    """Ascending cut points per feature: all distinct values where these are at most
    ``bins``, else those at which the share of rows up to them passes a multiple of
    1/bins.  Missing values take no part."""
    long = (rows.select(F.explode(F.array(*[F.struct(F.lit(j).alias("j"), F.col(c).cast("double").alias("x")) for j, c in enumerate(features)])).alias("v"))
            .select("v.*").where("x is not null and not isnan(x)").groupBy("j", "x").agg(F.count(F.lit(1)).alias("n")))
    summed = running_sums(long, ["x"], {"upto": F.col("n"), "place": F.lit(1)}, by=["j"], totals=True)
    step = lambda c: F.floor(c * bins / F.col("upto_total"))
    kept = summed.where((F.col("place_total") <= bins) | (step(F.col("upto")) > step(F.col("upto") - F.col("n")))).select("j", "x").collect()
    out: list[list[float]] = [[] for _ in features]
    for r in kept:
        out[r["j"]].append(r["x"])
    return [np.array(sorted(c)) for c in out]


def filled(df: DataFrame, features: list[str], fill: dict[str, float | None]):
    """The features as doubles, null and NaN by their fitted value where there is one."""
    def one(c):
        x = F.col(c).cast("double")
        x = F.when(~F.isnan(x), x)
        return F.coalesce(x, F.lit(float(fill[c]))) if fill.get(c) is not None else x
    return [one(c) for c in features]


def _matrix(batch: pa.RecordBatch, names: list[str]) -> np.ndarray:
    columns = [batch.column(batch.schema.get_field_index(c)).to_numpy(zero_copy_only=False).astype(float) for c in names]
    return np.column_stack(columns) if columns else np.zeros((batch.num_rows, 0))


BLOCKS = "rows int, learning int, h binary, y binary, valid binary, bins binary, margin binary"


def _binned(rows: DataFrame, features: list[str], cuts: list[np.ndarray]) -> tuple[DataFrame, int]:
    """(blocks of the training state of every row: h, y, valid, bins, margin; number of
    training rows), written once and dealt evenly."""
    names = [f"x{j}" for j in range(len(features))]

    def run(batches):
        for batch in batches:
            for lo in range(0, batch.num_rows, BLOCK):
                part = batch.slice(lo, BLOCK)
                x = _matrix(part, names)
                bins = np.empty(x.shape, dtype="<u2")
                for j, c in enumerate(cuts):
                    bins[:, j] = np.where(np.isnan(x[:, j]), len(c), np.searchsorted(c, x[:, j]))
                h, y, valid = (part.column(i).to_numpy(zero_copy_only=False) for i in range(3))
                yield _block(h.astype("<i8"), y.astype("<f8"), valid.astype("u1"), bins, np.zeros(len(x)))

    blocks = rows.mapInArrow(run, BLOCKS).checkpoint()
    n, learning = blocks.agg(*[F.coalesce(F.sum(c), F.lit(0)) for c in ("rows", "learning")]).first()
    tasks = max(1, min(rows.sparkSession.sparkContext.defaultParallelism, -(-n // BLOCK)))
    return blocks.repartition(tasks).checkpoint(), learning


def _block(h, y, valid, bins, margin) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([n], pa.int32()) for n in (len(h), int((valid == 0).sum()))]
                                      + [pa.array([c.tobytes()], pa.binary()) for c in (h, y, valid, bins, margin)],
                                      ["rows", "learning", "h", "y", "valid", "bins", "margin"])


class _State:
    """What a task needs of the trees so far: those since margins were written, and the
    open tree as heap arrays (feature, bin); an open place has feature -2."""

    def __init__(self, width: int, features: int, params: TreeParams):
        self.width, self.features, self.params = width, features, params
        self.done: list[Tree] = []
        self.places: dict[int, tuple[int, int]] = {}
        self.round = 0
        self.kept = False  # whether passes read rows of the round (``_round_rows``) or the training state

    def blocks(self, batches, apply: bool = True):
        """(h, y, valid, bins, margin) of each block."""
        for batch in batches:
            for i in range(batch.num_rows):
                h, y, valid, bins, margin = (np.frombuffer(batch.column(c)[i].as_buffer(), dtype=kind) for c, kind in
                                             zip(range(2, 7), ("<i8", "<f8", "u1", "<u2", "<f8")))
                bins, margin = bins.reshape(len(y), self.features), margin.copy()
                for t in self.done if apply else ():
                    margin += t.value[t.leaves(bins, t.cut)]
                yield h, y, valid.astype(bool), bins, margin

    def sampled(self, h: np.ndarray) -> np.ndarray:
        """Rows of this round's sample."""
        if self.params.subsample >= 1:
            return np.ones(len(h), dtype=bool)
        with np.errstate(over="ignore"):
            x = h.view(np.uint64) + np.uint64(((self.params.seed << 20) + self.round + 1) * 0x9E3779B97F4A7C15 & (1 << 64) - 1)
            x ^= x >> np.uint64(30)
            x *= np.uint64(0xBF58476D1CE4E5B9)
            x ^= x >> np.uint64(27)
            x *= np.uint64(0x94D049BB133111EB)
            x ^= x >> np.uint64(31)
        return (x >> np.uint64(11)) < np.uint64(self.params.subsample * 2 ** 53)

    def gradients(self, batches):
        """(bins, g, h) of the sampled training rows of each block."""
        for h_id, y, valid, bins, margin in self.blocks(batches):
            use = ~valid & self.sampled(h_id)
            y, bins, margin = y[use], bins[use], margin[use]
            p = 1.0 / (1.0 + np.exp(-margin))
            weight = np.where(y == 1, self.params.scale_pos_weight, 1.0)
            g = np.round(weight * (p - y) * UNIT).astype(np.int64)
            h = np.round(weight * np.maximum(p * (1 - p), 1e-16) * UNIT).astype(np.int64)
            yield bins, g, h

    def round_rows(self, batches):
        """The same, from blocks that hold them if these are kept."""
        if not self.kept:
            yield from self.gradients(batches)
            return
        for batch in batches:
            for i in range(batch.num_rows):
                bins, g, h = (np.frombuffer(batch.column(c)[i].as_buffer(), dtype=kind) for c, kind in enumerate(("<u2", "<i8", "<i8")))
                yield bins.reshape(len(g), self.features), g, h

    def at_open(self, batches, wanted: np.ndarray):
        """Per block with some: (index into ``wanted`` places, bins, g, h) of sampled
        training rows there."""
        places = np.array(sorted({1, *self.places, *(c for p in self.places for c in (2 * p, 2 * p + 1))}))
        feature, cut = (np.array([self.places.get(p, (-2, 0))[i] for p in places.tolist()], dtype=np.int64) for i in range(2))
        left, right = (np.minimum(np.searchsorted(places, 2 * places + i), len(places) - 1) for i in range(2))
        of = np.minimum(np.searchsorted(wanted, places), len(wanted) - 1)
        of = np.where((wanted[of] == places) & (feature < 0), of, -1)
        for bins, g, h in self.round_rows(batches):
            k = of[_walk(bins, feature, cut, left, right)]
            here = k >= 0
            if here.any():
                yield (k, bins, g, h) if here.all() else (k[here], bins[here], g[here], h[here])


def _round_rows(state: _State, rows: DataFrame) -> DataFrame:
    """Blocks of the round's sampled training rows with their gradients, for several passes;
    kept until the tree is grown, made anew from ``rows`` where they are lost."""
    def run(batches):
        for block in state.gradients(batches):
            yield pa.RecordBatch.from_arrays([pa.array([c.tobytes()], pa.binary()) for c in block], ["bins", "g", "h"])

    return rows.mapInArrow(run, "bins binary, g binary, h binary").persist()


def _split_big(state: _State, rows: DataFrame, places: list[int], used: np.ndarray) -> dict[int, tuple]:
    """Best split of each place, by histograms over all rows: place -> (split, sums)."""
    wanted, width, params = np.array(sorted(places)), state.width, state.params
    step = max(1, CELLS // (len(used) * width))  # places in one dense table

    def tables(batches):
        total: dict[int, list] = {}
        for at, bins, g, h in state.at_open(batches, wanted):
            for lo in range(0, len(wanted), step):
                part = (at >= lo) & (at < lo + step)
                if part.any():
                    found = _tables(at[part] - lo, bins[part], g[part], h[part], used, width, min(step, len(wanted) - lo))
                    if len(wanted) <= step:
                        total[lo] = [a + b for a, b in zip(total[lo], found)] if lo in total else found
                    else:  # too wide to hold: a block's tables go out by themselves
                        yield from rows_of(lo, found)
        for lo, found in total.items():
            yield from rows_of(lo, found)

    def rows_of(lo, found):
        node = np.flatnonzero(found[2][:, 0].any(axis=1))
        for some in np.array_split(node, max(1, -(-len(node) * len(used) * width // (1 << 20)))):
            body = np.stack([t[some] for t in found], axis=2).reshape(-1, 3 * width)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.repeat(wanted[lo + some], len(used))), pa.array(np.tile(np.arange(len(used), dtype=np.int32), len(some))),
                 pa.array([r.tobytes() for r in body], pa.binary())], ["place", "j", "sums"])

    found = rows.mapInArrow(tables, "place long, j int, sums binary")
    if rows.sparkSession.sparkContext.defaultParallelism * len(wanted) * len(used) * width <= SUMMED:
        total = {p: np.zeros((len(used), 3, width), dtype=np.int64) for p in places}
        for place, j, part in found.collect():
            total[place][j] += np.frombuffer(part, dtype=np.int64).reshape(3, width)
        best = {}
        for place, sums in total.items():
            g, h, n = sums.transpose(1, 0, 2)
            j, b, gain, left = best_split(g, h, n, params) or (-1, 0, 0.0, (0, 0, 0))
            best[place] = (int(used[j]) if j >= 0 else -1, b, gain, *(int(x[0].sum()) for x in (g, h, n)), *left)
        return best

    def choose(table: pa.Table) -> pa.Table:
        sums = np.zeros((3, 1, width), dtype=np.int64)
        for part in table.column("sums"):
            sums += np.frombuffer(part.as_buffer(), dtype=np.int64).reshape(3, 1, width)
        found = best_split(*sums, params)
        _, b, gain, left = found if found else (-1, 0, 0.0, (0, 0, 0))
        values = [table.column("place")[0].as_py(), table.column("j")[0].as_py() if found else -1, b, gain, *(int(x) for x in sums.sum(axis=(1, 2))), *left]
        return pa.table({n: [v] for n, v in zip(names, values)}, schema=pa.schema([(n, pa.float64() if n == "gain" else pa.int64()) for n in names]))

    names = ("place", "j", "bin", "gain", "g", "h", "n", "gl", "hl", "nl")
    chosen = found.groupBy("place", "j").applyInArrow(choose, ", ".join(f"{n} {'double' if n == 'gain' else 'long'}" for n in names))
    best: dict[int, tuple] = {}
    for place, j, b, gain, *sums in chosen.collect():  # of equal gains the first feature's
        if place not in best or (j >= 0 and (best[place][0] < 0 or (-gain, j) < (-best[place][2], best[place][0]))):
            best[place] = (j, b, gain, *sums)
    return {place: (int(used[j]) if j >= 0 else -1, *rest) for place, (j, *rest) in best.items()}


def _finish_small(state: _State, rows: DataFrame, places: list[int], used: np.ndarray) -> list[tuple]:
    """The subtrees of places with few rows, each grown by one task."""
    wanted, width, params, features = np.array(sorted(places)), state.width, state.params, state.features

    def pick(batches):
        for at, bins, g, h in state.at_open(batches, wanted):
            order = np.argsort(at, kind="stable")
            new = np.flatnonzero(np.r_[True, np.diff(at[order]) > 0])
            parts = np.split(order, new[1:])
            yield pa.RecordBatch.from_arrays(
                [pa.array(wanted[at[order[new]]]), *[pa.array([c[part].tobytes() for part in parts], pa.binary()) for c in (g, h, bins)]],
                ["place", "g", "h", "bins"])

    def subtree(table: pa.Table) -> pa.Table:
        place = int(table.column("place")[0].as_py())
        g, h, bins = (np.frombuffer(b"".join(table.column(c).to_pylist()), dtype=kind) for c, kind in (("g", "<i8"), ("h", "<i8"), ("bins", "<u2")))
        depth = params.max_depth - (place.bit_length() - 1)
        out = grow(bins.reshape(len(g), features), g, h, used, width, depth, params)
        names = ("place", "feature", "bin", "gain", "g", "h", "n")
        columns = list(zip(*out))
        level = [p.bit_length() - 1 for p in columns[0]]
        columns[0] = [(place << d) + p - (1 << d) for p, d in zip(columns[0], level)]
        return pa.table(dict(zip(names, columns)), schema=pa.schema([(n, pa.float64() if n == "gain" else pa.int64()) for n in names]))

    picked = rows.mapInArrow(pick, "place long, g binary, h binary, bins binary")
    grown = picked.groupBy("place").applyInArrow(subtree, "place long, feature long, bin long, gain double, g long, h long, n long")
    return [tuple(r) for r in grown.collect()]


def _grow_tree(state: _State, rows: DataFrame, used: np.ndarray, cuts: list[np.ndarray], n: int) -> Tree:
    params, done, open_, small = state.params, {}, {1: n}, []
    state.places = {}
    state.kept = False
    if n > KEPT_ROWS * params.local_rows:
        rows, state.kept = _round_rows(state, rows), True
    while open_:
        small += [p for p, k in open_.items() if k <= params.local_rows]
        big = [p for p, k in open_.items() if k > params.local_rows]
        open_ = {}
        if big:
            for place, (feature, b, gain, g, h, n_, gl, hl, nl) in _split_big(state, rows, big, used).items():
                done[place] = (feature, b, gain, g, h, n_)
                if feature >= 0:
                    state.places[place] = (feature, b)
                    if place.bit_length() - 1 < params.max_depth - 1:
                        open_.update({2 * place: nl, 2 * place + 1: n_ - nl})
                    else:
                        done[2 * place] = (-1, 0, 0.0, gl, hl, nl)
                        done[2 * place + 1] = (-1, 0, 0.0, g - gl, h - hl, n_ - nl)
    if small:
        for place, feature, b, gain, *sums in _finish_small(state, rows, small, used):
            done[place] = (feature, b, gain, *sums)
    if state.kept:
        rows.unpersist()
    if not done:
        done[1] = (-1, 0, 0.0, 0, 0, 0)
    order = sorted(done)
    number = {p: i for i, p in enumerate(order)}
    feature = np.array([done[p][0] for p in order], dtype=np.int64)
    inner = feature >= 0
    return Tree(
        feature=feature, cut=np.array([done[p][1] for p in order], dtype=np.int64),
        threshold=np.array([cuts[done[p][0]][done[p][1]] if done[p][0] >= 0 else 0.0 for p in order]),
        left=np.array([number.get(2 * p, 0) if i else 0 for p, i in zip(order, inner)], dtype=np.int64),
        right=np.array([number.get(2 * p + 1, 0) if i else 0 for p, i in zip(order, inner)], dtype=np.int64),
        value=np.array([0.0 if i else leaf_value(done[p][3], done[p][4], params) for p, i in zip(order, inner)]),
        gain=np.array([done[p][2] for p in order]), cover=np.array([done[p][4] / UNIT for p in order]),
        rows=np.array([done[p][5] for p in order], dtype=np.int64))


def _losses(state: _State, rows: DataFrame) -> list[float]:
    """Mean logistic loss of the validation rows after each tree since margins were written,
    from whole numbers of 2^-28; none without such rows."""
    trees = state.done

    def run(batches):
        total, n = np.zeros(len(trees), dtype=np.int64), 0
        for _, y, valid, bins, margin in state.blocks(batches, apply=False):
            y, bins, margin = y[valid], bins[valid], margin[valid]
            n += len(y)
            for i, t in enumerate(trees):
                margin = margin + t.value[t.leaves(bins, t.cut)]
                total[i] += np.round(np.logaddexp(0.0, np.where(y == 1, -margin, margin)) * UNIT).astype(np.int64).sum()
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(trees))), pa.array(total), pa.array([n] * len(trees), pa.int64())], ["i", "loss", "n"])

    found = rows.mapInArrow(run, "i long, loss long, n long").groupBy("i").agg(F.sum("loss").alias("loss"), F.sum("n").alias("n")).collect()
    return [r["loss"] / UNIT / r["n"] for r in sorted(found) if r["n"]]


def _written(state: _State, rows: DataFrame) -> DataFrame:
    """The rows with their margins up to date, written once."""
    def run(batches):
        for h, y, valid, bins, margin in state.blocks(batches):
            yield _block(h, y, valid.astype("u1"), bins, margin)

    out = rows.mapInArrow(run, rows.schema).checkpoint()
    state.done = []
    return out


def columns_of(round_: int, features: int, params: TreeParams) -> np.ndarray:
    """The features that a round's tree may split on, ascending."""
    k = max(1, int(features * params.colsample))
    order = np.random.default_rng([params.seed, round_]).permutation(features)
    return np.sort(order[:k])


def fit(train: DataFrame, valid: DataFrame | None, features: list[str], fill: dict[str, float | None],
        params: TreeParams = TreeParams(), y: str = "y", id_col: str = "doc_id", patience: int | None = None) -> tuple[BoostedTrees, list[float]]:
    """(all fitted trees, validation loss after each round).

    ``y`` is 0 or 1.  Losses are taken every ``KEPT_TREES`` rounds; with ``patience`` fitting
    ends there once so many rounds have passed since the least loss.  Rows of one id are sampled together.  No training rows give trees
    of a single leaf of value 0."""
    ensure_checkpoint_dir(train.sparkSession)
    def part(df, is_valid):
        return df.select(F.xxhash64(F.col(id_col)).alias("h"), F.col(y).cast("double").alias("y"), F.lit(is_valid).alias("valid"),
                         *[c.alias(f"x{j}") for j, c in enumerate(filled(df, features, fill))])
    learning = part(train, False)
    cuts = cut_points(learning, [f"x{j}" for j in range(len(features))], params.bins)
    width = max((len(c) for c in cuts), default=0) + 1
    rows, n = _binned(learning if valid is None else learning.unionByName(part(valid, True)), features, cuts)
    state, model, losses = _State(width, len(features), params), BoostedTrees(list(features), dict(fill)), []
    for r in range(params.rounds):
        state.round = r
        tree = _grow_tree(state, rows, columns_of(r, len(features), params), cuts, n)
        model.trees.append(tree)
        state.done.append(tree)
        if len(state.done) == KEPT_TREES or r == params.rounds - 1:
            if valid is not None:
                losses += _losses(state, rows)
                if patience is not None and losses and len(losses) - 1 - losses.index(min(losses)) >= patience:
                    break
            rows = _written(state, rows)
    return model, losses


def margins(model: BoostedTrees, df: DataFrame, name: str = "margin") -> DataFrame:
    """The columns of ``df`` and the trees' sum for each row."""
    width = len(model.features)

    @F.pandas_udf("double")
    def total(x: pd.Series) -> pd.Series:
        return pd.Series(model.margin(np.array(x.tolist(), dtype=float).reshape(len(x), width)))

    missing = F.lit(float("nan"))
    return df.withColumn(name, total(F.array(*[F.coalesce(c, missing) for c in filled(df, model.features, model.fill)])))


def relational_margins(nodes: DataFrame, df: DataFrame, model: BoostedTrees, id_col: str, depth: int) -> DataFrame:
    """(id, margin) by joins with the node table: each row walks every tree a level a join.

    A check on ``margins`` that shares nothing with it but the table."""
    x = df.select(F.col(id_col), F.array(*filled(df, model.features, model.fill)).alias("x"))
    nodes = F.broadcast(nodes)  # trees times 2^(depth + 1) rows at most
    trees = F.explode(F.sequence(F.lit(0), F.lit(len(model.trees) - 1)))
    at = x.withColumn("tree", trees).join(nodes.where("node = 0"), "tree")  # a row per tree
    for _ in range(depth):
        inner = F.col("feature") >= 0
        step = F.when(inner & (F.get("x", F.col("feature")) <= F.col("threshold")), F.col("left")).when(inner, F.col("right")).otherwise(F.col("node"))
        at = at.select(id_col, "x", F.col("tree").alias("t"), step.alias("n"))
        at = at.join(nodes, (F.col("t") == F.col("tree")) & (F.col("n") == F.col("node"))).drop("t", "n")
    return at.groupBy(id_col).agg(F.sum("value").alias("margin"))
