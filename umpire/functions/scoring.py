"""Scalar column functions of the scoring path: naming, coercion, label
mapping, arg-max, thresholds, record maps and payload rendering.

All are built-in expressions (codegen'd, no Python rows).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from umpire.functions.hashing import residue
from umpire.schemas import CLASSES, NEGATIVE, POSITIVE


# ------------------------------------------------------------------ F1-F5
def _bound(df: DataFrame, col: str, n: int, label: str | None, keep: list[str] | tuple, sep: str, reject: str | None) -> DataFrame:
    """``keep``, the truth and the mark where asked for, ``_parts`` (the fields of each line
    as an array of strings) and ``_from``: the place of the first of ``n`` fields, null for a
    line of any other width.

    Lines without quotes and control characters are split; the others go through the
    CSV parser.  The array is made once a row, whatever number of fields is read."""
    line = F.col(col)
    unquoted = F.regexp_replace(line, '"(?:[^"]|"")*"', "")
    parsed = F.from_csv(line, ", ".join(f"f{i} string" for i in range(n + 1)),
                        {"sep": sep, "ignoreLeadingWhiteSpace": "true", "escape": '"', "maxCharsPerColumn": "-1"})
    plain, cut = ~line.rlike(r'["\x00-\x1F]'), "\\Q" + sep + "\\E"
    parts = F.when(plain, F.split(F.ltrim(line), cut + "\\x20*")).otherwise(F.array(*[parsed[f"f{i}"] for i in range(n + 1)]))
    parts = F.when(line.isNotNull(), parts)
    quoted_width = F.when(~plain, F.size(F.split(unquoted, cut)))
    rows = df.select(*keep, parts.alias("_parts"), quoted_width.alias("_quoted"))
    width = F.coalesce("_quoted", F.size("_parts"))
    rows = rows.withColumn("_from", F.when(width == n, 0).when(width == n + 1, 1))
    out = [F.col(k) for k in keep]
    if label:
        out.append(F.when(F.col("_from") == 1, F.nullif(F.get("_parts", F.lit(0)), F.lit(""))).alias(label))
    if reject:
        out.append(F.col("_from").isNull().alias(reject))
    return rows.select(*out, "_parts", "_from")


def name_fields(df: DataFrame, col: str, names: list[str], label: str | None = None,
                keep: list[str] | tuple = (), sep: str = ",", reject: str | None = None, numeric: bool = False) -> DataFrame:
    """Headerless CSV lines, their fields bound to ``names`` by position.

    Leading spaces of a field are skipped, quoted fields may hold the separator,
    and an empty field is null.  A line with ``len(names)+1`` fields carries the
    truth first: it is kept aside as ``label`` (F2) and the remaining fields are
    named.  A line of any other width is bound to nothing: all its fields are
    null, and ``reject`` names a column that marks it.  Values stay strings (see
    ``to_numeric``), or with ``numeric`` become doubles, null where they are none.
    """
    rows = _bound(df, col, len(names), label, keep, sep, reject)

    def number(value):
        x = value.try_cast("double")
        return F.when(~F.isnan(x), x)

    if numeric:  # all fields in one expression: a cast per column makes a method too long for the JVM to compile
        rows = rows.withColumn("_parts", F.transform("_parts", number))
    value = [F.get("_parts", F.col("_from") + i) for i in range(len(names))]
    return rows.select(*[c for c in rows.columns if c not in ("_parts", "_from")],
                       *[(v if numeric else F.nullif(v, F.lit(""))).alias(name) for v, name in zip(value, names)])


def to_numeric(df: DataFrame, cols: list[str], mode: str = "coerce",
               request: str | None = None, reject: str | None = None) -> DataFrame:
    """Numeric coercion of ``cols``; NaN is a missing value, so null.

    ``coerce``: a bad value becomes null (``try_cast``).
    ``strict``: additionally counts ``bad_values`` per row, a line marked by the
    column ``reject`` being one more; with ``request`` given, ``rejected`` marks
    every row of a request that has any bad value.
    """
    cast = {c: F.expr(f"try_cast(`{c}` AS DOUBLE)") for c in cols}
    bad = sum(((F.col(c).isNotNull() & cast[c].isNull()).cast("int") for c in cols),
              F.col(reject).cast("int") if reject else F.lit(0))
    out = df.select(*[F.when(~F.isnan(cast[c]), cast[c]).alias(c) if c in cast else F.col(c) for c in df.columns],
                    *([] if mode == "coerce" else [bad.alias("bad_values")]))
    if mode == "strict" and request:
        marks = out.groupBy(request).agg(F.max(F.col("bad_values") > 0).alias("rejected"))
        out = out.join(marks, request, "left")
    return out


def numeric_columns(df: DataFrame) -> list[str]:
    """Names of numeric and boolean columns (the feature selector)."""
    return [f.name for f in df.schema.fields
            if isinstance(f.dataType, (T.NumericType, T.BooleanType))]


# ------------------------------------------------------------------ F6-F9
def map_values(col: Column, mapping: dict) -> Column:
    """Dictionary lookup as a literal map (bounded: the dictionary is fixed)."""
    kv = []
    for k, v in mapping.items():
        kv += [F.lit(k), F.lit(v)]
    return F.element_at(F.create_map(*kv), col)


def argmax_label(probs: Column, classes: list[str] = CLASSES) -> Column:
    """Class of the largest probability; ties go to the first class."""
    idx = F.array_position(probs, F.array_max(probs))
    return F.element_at(F.array(*[F.lit(c) for c in classes]), idx.cast("int"))


def numeric_flag(label: Column, positive: str = POSITIVE) -> Column:
    return F.when(label == positive, 1).otherwise(0)


def threshold_label(p: Column, t: float = 0.5, classes: list[str] = CLASSES) -> Column:
    """Positive class when ``p > t`` (strict)."""
    return F.when(p > F.lit(t), F.lit(classes[1])).otherwise(F.lit(classes[0]))


def prediction_record(probs: Column, truth: Column | None = None,
                      classes: list[str] = CLASSES) -> list[Column]:
    """The five prediction fields (three without truth)."""
    label = argmax_label(probs, classes)
    out = []
    if truth is not None:
        out += [truth.alias("ground_truth"),
                numeric_flag(truth, classes[1]).alias("numerical_ground_truth_label")]
    out += [label.alias("predicted_label"),
            numeric_flag(label, classes[1]).alias("predicted_numerical_label"),
            F.element_at(probs, 2).cast("double").alias("win_probability")]
    return out


# ------------------------------------------------------------------ F10-F13
def record_map(line: Column, sep: str = ",") -> Column:
    """``{"00": v0, "01": v1, ...}`` from a CSV record."""
    parts = F.split(line, sep)
    keys = F.transform(F.sequence(F.lit(0), F.size(parts) - 1),
                       lambda i: F.lpad(i.cast("string"), 2, "0"))
    return F.map_from_arrays(keys, parts)


def last_columns(df: DataFrame, n: int) -> DataFrame:
    """Keep the last ``n`` columns (``$[-n:]``)."""
    return df.select(*df.columns[-n:])


def feature_tag(name: Column) -> Column:
    """Last path part of a series name (``.../f12`` -> ``f12``)."""
    return F.element_at(F.split(name, "/"), -1)


def name_features(df: DataFrame, col: str, names: list[str], out: str = "feature") -> DataFrame:
    """Replace ``f<i>`` tags by the i-th feature name; unmatched names are kept.

    The lookup table has one row per feature name (fixed size), joined with
    a broadcast hint.
    """
    spark = df.sparkSession
    lookup = spark.createDataFrame([(f"f{i}", n) for i, n in enumerate(names)],
                                   "_tag string, _fname string")
    tagged = df.withColumn("_tag", feature_tag(F.col(col)))
    joined = tagged.join(F.broadcast(lookup), "_tag", "left")
    return joined.withColumn(out, F.coalesce(F.col("_fname"), F.col(col))).drop("_tag", "_fname")


def filter_series(df: DataFrame, col: str, regex: str = ".*", limit: int = 35) -> DataFrame:
    """Rows of the first ``limit`` series (by name) whose name matches ``regex``
    at its start.  The distinct names go through a top-k, not a global sort."""
    anchored = regex if regex.startswith("^") else f"^(?:{regex})"
    names = (df.select(col).where(F.col(col).rlike(anchored)).distinct()
             .orderBy(col).limit(limit))
    return df.join(F.broadcast(names), col, "left_semi")


# ------------------------------------------------------------------ F17-F18
def csv_payload(cols: list[str], sep: str = ",") -> Column:
    """Render feature columns as one CSV request line."""
    return F.concat_ws(sep, *[F.col(c).cast("string") for c in cols])


def synthetic_label(id_col: str, labels: list[str] = (POSITIVE, NEGATIVE), seed: int = 42) -> Column:
    """Stand-in truth chosen deterministically from the id (md5-based)."""
    arr = F.array(*[F.lit(x) for x in labels])
    return F.element_at(arr, (residue(id_col, len(labels), seed) + 1).cast("int"))
