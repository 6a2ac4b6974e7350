"""Data preparation: zip by key or position, seeded shuffle, stratified split,
median imputation, ordinal label coding, baselines."""

from __future__ import annotations

from fractions import Fraction

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from umpire.functions.hashing import seeded_key
from umpire.operators.ordered import row_rank, running_sums, with_position
from umpire.operators.selection import keys_at_ranks

ROW_ID = "row_id"
MOST_CUT = 100
MOST_CLASSES = 10_000


def with_row_id(df: DataFrame, name: str = ROW_ID) -> DataFrame:
    """Contiguous 0-based position of each row in read order (no shuffle;
    see ``ordered.with_position``)."""
    return with_position(df, name)


def zip_columns(left: DataFrame, right: DataFrame, key: str | None = None) -> DataFrame:
    """Column-wise concatenation, outer on the key so unequal sides give nulls.

    With ``key=None`` both sides are aligned by read position (``row_id``).
    """
    if key is None:
        left, right, key = with_row_id(left), with_row_id(right), ROW_ID
    return left.join(right, key, "full_outer")


def union_parts(*dfs: DataFrame) -> DataFrame:
    """Row-wise union of part files with the same columns."""
    out = dfs[0]
    for d in dfs[1:]:
        out = out.unionByName(d)
    return out


def shuffle_rank(df: DataFrame, id_col: str, seed: int = 42, name: str = "position") -> DataFrame:
    """Seeded full shuffle expressed as a 1-based position (no global sort)."""
    keyed = df.withColumn("_shuffle_key", seeded_key(id_col, seed))
    return row_rank(keyed, ["_shuffle_key", id_col], name=name).drop("_shuffle_key")


def _cut(n, frac: float):
    """round-half-up(n * frac) in exact integer arithmetic, of a column or a number."""
    q = Fraction(str(frac)).limit_denominator(10 ** 6)
    if isinstance(n, int):
        return (n * q.numerator * 2 + q.denominator) // (2 * q.denominator)
    return F.floor((n * q.numerator * 2 + q.denominator) / (2 * q.denominator)).cast("long")


def stratified_split(df: DataFrame, label: str, id_col: str,
                     fractions: tuple[float, float, float] = (0.7, 0.15, 0.15),
                     seed: int = 42, name: str = "split") -> DataFrame:
    """Stratified train/validation/test split keeping each class's ratio.

    Within each class rows are ordered by ``md5('<seed>|<id>')``; the first
    ``round(n*f_train)`` go to train, up to ``round(n*(f_train+f_val))`` to
    validation, the rest to test.  The two hashes at these places are found by
    counting buckets of hashes (``selection.keys_at_ranks``) and every row is compared
    with its class's, so no row is moved; rows of one id go together.  A label of
    more than ``MOST_CUT`` classes is ranked instead.
    """
    bounds = (fractions[0], fractions[0] + fractions[1])
    keyed = df.withColumn("_split_key", F.coalesce(seeded_key(id_col, seed), F.lit("0" * 32)))
    if len(df.select(label).distinct().limit(MOST_CUT + 1).collect()) > MOST_CUT:
        ranked = row_rank(keyed, ["_split_key", id_col], by=[label], name="_rk", totals=True)
        first, second = (F.col("_rk") <= _cut(F.col("_rk_total"), b) for b in bounds)
    else:
        cuts = keys_at_ranks(keyed, label, "_split_key", lambda n: [_cut(n, b) for b in bounds])
        ranked, first, second = keyed, F.lit(False), F.lit(False)
        for value, (train, valid) in cuts.items():
            own = F.col(label).eqNullSafe(F.lit(value))
            first = first | (own & (F.col("_split_key") <= train))
            second = second | (own & (F.col("_split_key") <= valid))
    return (ranked.withColumn(name, F.when(first, "train").when(second, "validation").otherwise("test"))
            .drop("_split_key", "_rk", "_rk_total"))


def _long_form(df: DataFrame, cols: list[str]) -> DataFrame:
    pairs = ", ".join(f"'{c}', CAST(`{c}` AS DOUBLE)" for c in cols)
    return df.selectExpr(f"stack({len(cols)}, {pairs}) AS (column, value)")


def median_table(train: DataFrame, cols: list[str]) -> DataFrame:
    """Exact medians (mean of the two middle values) of ``cols``, one row each.

    Values are first counted per (column, value) with map-side combining, then
    ranked by a distributed running count per column; the middle positions are
    looked up in that table.  Memory never holds a whole column.
    """
    counts = (_long_form(train, cols).where(F.col("value").isNotNull() & ~F.isnan("value"))
              .groupBy("column", "value").agg(F.count(F.lit(1)).alias("cnt")))
    cum = running_sums(counts, ["value"], {"cum": F.col("cnt")}, by=["column"], totals=True)
    n = F.col("cum_total")
    lo = F.floor((n + 1) / 2)
    hi = F.floor(n / 2) + 1
    first = F.col("cum") - F.col("cnt") + 1
    hits = cum.select(
        "column",
        F.when((first <= lo) & (lo <= F.col("cum")), F.col("value")).alias("lo_v"),
        F.when((first <= hi) & (hi <= F.col("cum")), F.col("value")).alias("hi_v"))
    return (hits.groupBy("column")
            .agg(((F.max("lo_v") + F.max("hi_v")) / 2).alias("median")))


def fit_medians(train: DataFrame, cols: list[str], exact: bool = True,
                accuracy: int = 10000) -> dict[str, float]:
    """Fitted medians as a small dict (one value per column).

    ``exact=False`` uses one ``percentile_approx`` aggregate (a mergeable
    sketch per column, rank error about 1/accuracy) instead of the
    distributed exact selection; it returns an observed value, not the mean
    of the two middle ones."""
    if not exact:
        row = train.agg(*[F.percentile_approx(F.when(~F.isnan(F.col(c).cast("double")), F.col(c).cast("double")), 0.5, accuracy).alias(c)
                          for c in cols]).first()
        return {c: row[c] for c in cols}
    found = {r["column"]: r["median"] for r in median_table(train, cols).collect()}
    return {c: found.get(c) for c in cols}


def impute(df: DataFrame, medians: dict[str, float]) -> DataFrame:
    """Fill nulls (and NaN) with the fitted medians; all features become double."""
    out = []
    for c in df.columns:
        if c in medians and medians[c] is not None:
            v = F.col(c).cast("double")
            out.append(F.when(v.isNull() | F.isnan(v), F.lit(float(medians[c])))
                       .otherwise(v).alias(c))
        else:
            out.append(F.col(c))
    return df.select(*out)


def fit_ordinal(train: DataFrame, col: str) -> list[str]:
    """Sorted categories of the label (one small aggregate); more than ``MOST_CLASSES`` are
    no label, and an error."""
    found = train.select(col).where(F.col(col).isNotNull()).distinct().limit(MOST_CLASSES + 1).collect()
    if len(found) > MOST_CLASSES:
        raise ValueError(f"{col} has more than {MOST_CLASSES} values")
    return sorted(r[0] for r in found)


def encode(df: DataFrame, col: str, classes: list[str], name: str | None = None) -> DataFrame:
    """Ordinal code of ``col`` as double; an unseen category is an error."""
    idx = F.array_position(F.array(*[F.lit(c) for c in classes]), F.col(col))
    code = (F.when(F.col(col).isNull(), F.lit(None).cast("double"))
            .when(idx == 0, F.raise_error(F.concat(F.lit("Found unknown category: "), F.col(col))))
            .otherwise((idx - 1).cast("double")))
    return df.withColumn(name or col, code)


def decode(df: DataFrame, col: str, classes: list[str], name: str | None = None) -> DataFrame:
    """Inverse of :func:`encode`."""
    arr = F.array(*[F.lit(c) for c in classes])
    return df.withColumn(name or col, F.element_at(arr, F.col(col).cast("int") + 1))


def baseline(df: DataFrame, label: str, keep_label: bool) -> DataFrame:
    """Monitoring baseline: rows with any null dropped; the train baseline
    drops the label (written with a header), the test one keeps it first."""
    clean = df.dropna(how="any")
    if keep_label:
        return clean.select(label, *[c for c in clean.columns if c != label])
    return clean.drop(label)
