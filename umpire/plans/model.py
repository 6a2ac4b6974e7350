"""Training with early stopping, scoring, search, importance and Shapley values of
boosted trees, and the label coding (M1-M8).

The trainer is ``operators.boosting``: second-order trees with L1/L2 terms, least
child weight and a sample of rows and columns per tree.  Scores are not expected to
equal another library's: cuts, samples and ties are this trainer's own.
"""

from __future__ import annotations

import math
from concurrent.futures import ThreadPoolExecutor

import numpy as np
from pyspark.ml.feature import StringIndexerModel
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from umpire.functions.hashing import seeded_int, seeded_key
from umpire.operators import boosting as BT
from umpire.operators.boosting import BoostedTrees, TreeParams
from umpire.operators.metrics import auc, binary_metrics
from umpire.operators.ordered import with_position


def target_stage(classes: list[str], label: str, out: str = "y") -> StringIndexerModel:
    """Ordinal label coding in the fitted (alphabetical) order; unknown -> error."""
    return StringIndexerModel.from_labels(classes, inputCol=label, outputCol=out, handleInvalid="error")


def best_prefix(losses: list[float], patience: int = 25) -> int:
    """Rounds kept by early stopping: training stops once ``patience`` rounds
    pass without a new best validation loss; the best round is kept."""
    best, best_i = math.inf, 0
    for i, v in enumerate(losses):
        if v < best:
            best, best_i = v, i
        elif i - best_i >= patience:
            break
    return best_i + 1


def prefix_choice(losses: DataFrame, series: str, round_col: str, loss: str, patience: int = 25) -> DataFrame:
    """:func:`best_prefix` for a table of loss series (rounds from 1): rounds seen,
    rounds kept and whether patience ran out.  A series is as long as its fit has
    rounds, so a window over one is small."""
    so_far = Window.partitionBy(series).orderBy(round_col)
    best = losses.select(series, round_col, F.min(F.struct(loss, round_col)).over(so_far)[round_col].alias("best"))
    over = F.col(round_col) - F.col("best") >= patience
    return best.groupBy(series).agg(
        F.max(round_col).alias("rounds"),
        F.coalesce(F.min_by("best", F.when(over, F.col(round_col))), F.max_by("best", round_col)).alias("kept"),
        F.max(over).alias("stopped"))


def fit_with_early_stopping(train: DataFrame, valid: DataFrame, features: list[str],
                            medians: dict[str, float], params: TreeParams = TreeParams(),
                            patience: int = 25, y: str = "y", id_col: str = "doc_id") -> tuple[BoostedTrees, list[float], int]:
    """Boosted trees kept up to the best validation round (see :func:`best_prefix`),
    the losses up to the stop, and the number of rounds kept."""
    model, losses = BT.fit(train, valid, features, medians, params, y, id_col, patience)
    k = best_prefix(losses, patience) if losses else len(model.trees)
    return model.first(k), losses[:k + patience], k


def score(model: BoostedTrees, df: DataFrame, threshold: float = 0.5) -> DataFrame:
    """Class probabilities, P(positive) and the thresholded label."""
    p = 1.0 / (1.0 + F.exp(-F.col("margin")))
    out = BT.margins(model, df.drop("margin"), "margin").withColumn("p", p)
    return (out.withColumn("probs", F.array(1.0 - F.col("p"), F.col("p")))
            .withColumn("yhat", (F.col("p") > F.lit(threshold)).cast("int")).drop("margin"))


def validation_f1(model: BoostedTrees, valid: DataFrame, y: str = "y", threshold: float = 0.5) -> DataFrame:
    return binary_metrics(score(model, valid, threshold), y, "yhat")


# ------------------------------------------------------------------ search
# The search ranges (name, low, high, scale) of the reference.
RANGES = [
    ("eta", 0.05, 0.3, "log"),
    ("max_depth", 5, 15, "int"),
    ("subsample", 0.7, 1.0, "linear"),
    ("colsample", 0.7, 1.0, "log"),
    ("lambda", 5.0, 12.0, "log"),
    ("alpha", 1.0, 10.0, "log"),
    ("min_child_weight", 0.4, 1.0, "linear"),
    ("scale_pos_weight", 0.8, 2.2, "linear"),
]


def _from_unit(u, scale: str, lo: float, hi: float):
    if scale == "log":
        return math.exp(math.log(lo) + u * (math.log(hi) - math.log(lo)))
    return int(lo + math.floor(u * (hi - lo + 1))) if scale == "int" else lo + u * (hi - lo)


def _to_unit(v: float, scale: str, lo: float, hi: float) -> float:
    if scale == "log":
        return (math.log(v) - math.log(lo)) / (math.log(hi) - math.log(lo))
    return (v - lo + 0.5) / (hi - lo + 1) if scale == "int" else (v - lo) / (hi - lo)


def sample_params(n: int, ranges=RANGES, seed: int = 42) -> list[dict]:
    """``n`` seeded random configurations (log-uniform on log ranges)."""
    import random
    rnd = random.Random(seed)
    return [{name: _from_unit(rnd.random(), scale, lo, hi) for name, lo, hi, scale in ranges} for _ in range(n)]


def _surrogate(x: np.ndarray, y: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Mean and deviation at ``at`` of a Gaussian process through (x, y): squared-exponential
    kernel, of the length (from a grid) under which the trials are likeliest."""
    def kernel(a, b, length):
        return np.exp(-((a[:, None, :] - b[None, :, :]) ** 2).sum(axis=2) / (2 * length ** 2 * a.shape[1]))

    best = None
    for length in (0.1, 0.2, 0.4, 0.8, 1.6):
        root = np.linalg.cholesky(kernel(x, x, length) + 1e-4 * np.eye(len(x)))
        weight = np.linalg.solve(root.T, np.linalg.solve(root, y))
        likely = -0.5 * y @ weight - np.log(np.diag(root)).sum()
        if best is None or likely > best[0]:
            best = (likely, length, root, weight)
    _, length, root, weight = best
    cross = kernel(at, x, length)
    spread = 1.0 - (np.linalg.solve(root, cross.T) ** 2).sum(axis=0)
    return cross @ weight, np.sqrt(np.maximum(spread, 1e-12))


def propose(trials: list[tuple[dict, float]], k: int = 2, ranges=RANGES, seed: int = 42, candidates: int = 2048) -> list[dict]:
    """The next ``k`` configurations to try after ``trials`` (configuration, metric to be
    greatest): seeded candidates of greatest expected improvement under a Gaussian
    process.  Each proposal counts as a trial of the best metric so far for the next.
    The same trials in any order give the same proposals; trials without a finite
    metric take no part, and without any the proposals are random."""
    seen = sorted((tuple(_to_unit(c[name], scale, lo, hi) for name, lo, hi, scale in ranges), m) for c, m in trials if math.isfinite(m))
    if not seen:
        return sample_params(k, ranges, seed + len(trials))
    x, y = np.array([s[0] for s in seen]), np.array([s[1] for s in seen])
    y = (y - y.mean()) / (y.std() or 1.0)
    pool = np.random.default_rng([seed, len(seen)]).random((candidates, len(ranges)))
    out = []
    for _ in range(k):
        mean, spread = _surrogate(x, y, pool)
        z = (mean - y.max()) / spread
        normal = 0.5 * (1.0 + np.array([math.erf(v / math.sqrt(2.0)) for v in z]))
        gain = (mean - y.max()) * normal + spread * np.exp(-0.5 * z * z) / math.sqrt(2.0 * math.pi)
        pick = int(np.argmax(gain))
        out.append({name: _from_unit(float(u), scale, lo, hi) for u, (name, lo, hi, scale) in zip(pool[pick], ranges)})
        x, y = np.vstack([x, pool[pick]]), np.append(y, y.max())
        pool = np.delete(pool, pick, axis=0)
    return out


def propose_from(trials: DataFrame, k: int = 2, ranges=RANGES, seed: int = 42, metric: str = "auc") -> list[dict]:
    """:func:`propose` from a trial table (a row per fit, so a small one)."""
    rows = trials.select(*[r[0] for r in ranges], metric).collect()
    return propose([({r[0]: row[r[0]] for r in ranges}, row[metric] if row[metric] is not None else math.nan) for row in rows], k, ranges, seed)


def trial_params(cfg: dict, rounds: int, seed: int) -> TreeParams:
    """The trainer's settings of a configuration; all eight ranges take effect."""
    return TreeParams(rounds=rounds, eta=cfg["eta"], max_depth=int(cfg["max_depth"]), subsample=min(cfg["subsample"], 1.0),
                      colsample=min(cfg["colsample"], 1.0), reg_lambda=cfg["lambda"], reg_alpha=cfg["alpha"],
                      min_child_weight=cfg["min_child_weight"], scale_pos_weight=cfg["scale_pos_weight"], seed=seed)


def search(spark: SparkSession, train: DataFrame, valid: DataFrame, features: list[str],
           medians: dict[str, float], n: int = 5, parallel: int = 2, rounds: int = 120,
           ranges=RANGES, seed: int = 42, patience: int = 25, strategy: str = "Bayesian", id_col: str = "doc_id") -> DataFrame:
    """The trial table of a search for the greatest validation AUC.

    ``parallel`` fits run at once (each is itself a distributed job), with early stopping.
    The first ones are drawn at random; under "Bayesian" the following come from
    :func:`propose` on the trials so far, under "Random" all are drawn."""
    if strategy not in ("Bayesian", "Random"):
        raise ValueError(f"no search strategy {strategy!r}")

    def run(i, cfg):
        m, _, _ = fit_with_early_stopping(train, valid, features, medians, trial_params(cfg, rounds, seed + i), patience, id_col=id_col)
        found = auc(score(m, valid), "y", "p").first()["auc"]
        return cfg, math.nan if found is None else float(found)

    drawn, trials = sample_params(n, ranges, seed), []
    with ThreadPoolExecutor(max_workers=parallel) as pool:
        while len(trials) < n:
            k = min(parallel, n - len(trials))
            first = not trials or strategy == "Random"
            configs = drawn[len(trials):len(trials) + k] if first else propose(trials, k, ranges, seed)
            trials += list(pool.map(run, range(len(trials), len(trials) + k), configs))
    schema = "trial int, " + ", ".join(f"`{r[0]}` double" for r in ranges) + ", auc double"
    return spark.createDataFrame([(i, *[float(cfg[r[0]]) for r in ranges], a) for i, (cfg, a) in enumerate(trials)], schema)


def best_trial(trials: DataFrame, metric: str = "auc") -> DataFrame:
    """The trial with the highest metric (ties: lowest trial number)."""
    cols = [c for c in trials.columns if c != metric]
    order = F.struct(F.col(metric), -F.col("trial"))
    return trials.agg(F.max(F.col(metric)).alias(metric),
                      *[F.max_by(F.col(c), order).alias(c) for c in cols])


# ------------------------------------------------------------------ importance
# The kinds of split importance.
IMPORTANCE_TYPES = ["weight", "gain", "cover", "total_gain", "total_cover"]


def tree_importance(nodes: DataFrame, features: list[str], kind: str = "weight") -> DataFrame:
    """Split importance from a node table: ``weight`` (number of splits), ``gain`` and
    ``cover`` (means over splits), ``total_gain`` and ``total_cover`` (sums).  Leaves
    (feature -1) are skipped."""
    if kind not in IMPORTANCE_TYPES:
        raise ValueError(f"unknown importance {kind!r}; one of {', '.join(IMPORTANCE_TYPES)}")
    agg = {"weight": F.count(F.lit(1)).cast("double"), "gain": F.avg("gain"), "cover": F.avg("cover"),
           "total_gain": F.sum("gain"), "total_cover": F.sum("cover")}[kind]
    names = F.array(*[F.lit(f) for f in features])
    return (nodes.where("feature >= 0").groupBy(F.col("feature").alias("j")).agg(agg.alias("importance"))
            .select("j", F.element_at(names, F.col("j") + 1).alias("feature"),
                    F.lit(kind).alias("importance_type"), "importance"))


# ------------------------------------------------------------------ Shapley values
def shapley(model: BoostedTrees, rows: DataFrame, background: DataFrame, id_col: str,
            features: list[str], samples: int = 5, seed: int = 42) -> DataFrame:
    """Permutation-sampling Shapley values (Strumbelj and Kononenko).

    For every (row, sample) a seeded permutation of the features and a seeded
    background row are drawn; for every feature j two instances are built
    (features before j in the permutation from the row, the rest from the
    background, with j from the row or from the background) and scored in
    bulk.  phi_j is the mean difference of P(positive).  Work is
    rows x samples x features x 2 model evaluations, all distributed.
    The background is addressed by read position and joined on the drawn
    index, so no side is broadcast unchecked.
    """
    nf = len(features)
    bg_n = background.count()
    bg = with_position(background.select(*features), "_bpos").select(
        "_bpos", *[F.col(c).cast("double").alias(f"_z_{c}") for c in features])
    xs = rows.select(id_col, F.array(*[F.col(c).cast("double") for c in features]).alias("_x"))
    draws = xs.select(id_col, "_x", F.explode(F.sequence(F.lit(0), F.lit(samples - 1))).alias("_s"))
    sid = F.concat_ws("|", F.col(id_col).cast("string"), F.col("_s").cast("string"))
    draws = draws.withColumn("_bpos", F.pmod(seeded_int(sid, seed), F.lit(bg_n)))
    # permutation position of each feature: rank of a seeded hash among the features
    keyed = F.array_sort(F.array(*[F.struct(seeded_key(F.concat_ws("|", sid, F.lit(str(k))), seed).alias("h"),
                                            F.lit(k).alias("k")) for k in range(nf)]))
    draws = draws.withColumn("_perm", F.transform(keyed, lambda s: s["k"]))
    joined = draws.join(bg, "_bpos").withColumn("_z", F.array(*[F.col(f"_z_{c}") for c in features]))
    per_j = joined.select(id_col, "_s", "_x", "_z", "_perm",
                          F.explode(F.sequence(F.lit(0), F.lit(nf - 1))).alias("_j"))
    pos_j = F.array_position(F.col("_perm"), F.col("_j"))

    def build(include_j: bool):
        def pick(k):
            pos_k = F.array_position(F.col("_perm"), F.lit(k))
            from_x = (pos_k < pos_j) | ((F.lit(k) == F.col("_j")) if include_j else F.lit(False))
            return F.when(from_x, F.col("_x")[k]).otherwise(F.col("_z")[k])
        return F.array(*[pick(k) for k in range(nf)])

    inst = per_j.select(id_col, "_s", "_j", build(True).alias("_with"), build(False).alias("_without"))
    both = inst.select(id_col, "_s", "_j", F.explode(F.array(
        F.struct(F.lit(1.0).alias("sign"), F.col("_with").alias("v")),
        F.struct(F.lit(-1.0).alias("sign"), F.col("_without").alias("v")))).alias("e"))
    flat = both.select(id_col, "_s", "_j", "e.sign",
                       *[F.col("e.v")[k].alias(f"{c}") for k, c in enumerate(features)])
    scored = score(model, flat)
    contrib = scored.groupBy(id_col, "_j").agg((F.sum(F.col("sign") * F.col("p")) / samples).alias("phi"))
    names = F.array(*[F.lit(c) for c in features])
    base = score(model, background).agg(F.avg("p").alias("base"))
    base_value = base.first()["base"]
    return contrib.select(id_col, F.col("_j").alias("j"), F.element_at(names, F.col("_j") + 1).alias("feature"),
                          "phi", F.lit(base_value).alias("base"))
