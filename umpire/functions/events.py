"""Event rules: arrival-key classification, event-pattern matching and
training-log metric extraction."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The outcome messages of an arrival, in rule order.
MSG_SKIPPED = "Object is not in the 'data/' folder or not a CSV file."
MSG_NO_BATCH = "batch-id metadata is missing"
MSG_UNKNOWN_TYPE = "File type not recognized"
MSG_WAITING = "{t}.csv uploaded, waiting for the other file."
MSG_TRIGGERED = "Both files uploaded, pipeline triggered and DynamoDB entry cleaned."

# The four training-log metrics and their patterns.
LOG_PATTERNS = {
    "validation:logloss": r".*\[[0-9]+\].*#011validation_0-logloss:([-+]?[0-9]*\.?[0-9]+(?:[eE][-+]?[0-9]+)?).*",
    "validation:auc": r".*\[[0-9]+\].*#011validation_0-auc:([-+]?[0-9]*\.?[0-9]+(?:[eE][-+]?[0-9]+)?).*",
    "train:logloss": r".*\[[0-9]+\].*#011train-logloss:([-+]?[0-9]*\.?[0-9]+(?:[eE][-+]?[0-9]+)?).*",
    "train:auc": r".*\[[0-9]+\].*#011train-auc:([-+]?[0-9]*\.?[0-9]+(?:[eE][-+]?[0-9]+)?).*",
}


def log_patterns(train: str = "train", valid: str = "validation_0") -> dict[str, str]:
    """The metric patterns for the given evaluation-set names (a trainer may
    name its sets differently from the fixed patterns)."""
    return {name: pat.replace("#011validation_0-", f"#011{valid}-").replace("#011train-", f"#011{train}-")
            for name, pat in LOG_PATTERNS.items()}


def classify_arrivals(df: DataFrame, key: str = "key", batch: str = "batch_id") -> DataFrame:
    """Apply the arrival rules in order: prefix ``data/`` and suffix ``.csv``,
    batch id present, file type by substring (``df.csv`` before ``y.csv``)."""
    k = F.col(key)
    folder = F.concat(F.regexp_extract(k, r"^(.*)/[^/]*$", 1), F.lit("/"))
    ftype = (F.when(F.instr(k, "df.csv") > 0, F.lit("df"))
             .when(F.instr(k, "y.csv") > 0, F.lit("y")))
    ok_path = k.startswith("data/") & k.endswith(".csv")
    has_batch = F.col(batch).isNotNull() & (F.col(batch) != "")
    status = (F.when(~ok_path, "skipped").when(~has_batch, "missing_batch_id")
              .when(ftype.isNull(), "unrecognized").otherwise("accepted"))
    message = (F.when(~ok_path, MSG_SKIPPED).when(~has_batch, MSG_NO_BATCH)
               .when(ftype.isNull(), MSG_UNKNOWN_TYPE))
    return df.select("*", status.alias("status"),
                     F.when(ok_path & has_batch, ftype).alias("file_type"),
                     folder.alias("folder"), message.alias("message"))


def match_events(df: DataFrame, rule: dict) -> DataFrame:
    """Keep events matching a pattern.

    ``rule`` maps a (dotted) field to a list of allowed values, where a value
    may be ``{"prefix": "..."}``; nested dicts are walked as struct paths.
    """
    return df.where(_rule_condition(rule, ""))


def _rule_condition(rule: dict, path: str) -> Column:
    cond = F.lit(True)
    for field, allowed in rule.items():
        p = f"{path}.{field}" if path else field
        if isinstance(allowed, dict):
            cond = cond & _rule_condition(allowed, p)
            continue
        c = F.col("`" + p + "`") if "-" in p and "." not in p else F.col(p)
        one = F.lit(False)
        for a in allowed:
            if isinstance(a, dict) and "prefix" in a:
                one = one | c.startswith(a["prefix"])
            else:
                one = one | (c == F.lit(a))
        cond = cond & F.coalesce(one, F.lit(False))
    return cond


def extract_log_metrics(lines: DataFrame, col: str = "value", patterns: dict | None = None,
                        keep: list[str] | tuple = ()) -> DataFrame:
    """One row per (line, metric) whose pattern matches, value as double."""
    patterns = patterns or log_patterns()
    # One regex evaluation per (line, pattern): the captured number is never
    # empty on a match, so an empty capture means no match.
    structs = [F.struct(F.lit(name).alias("metric"),
                        F.regexp_extract(F.col(col), pat, 1).alias("raw"))
               for name, pat in patterns.items()]
    ex = lines.select(*keep, F.explode(F.array(*structs)).alias("m"))
    return (ex.where(F.col("m.raw") != "")
            .select(*keep, F.col("m.metric").alias("metric"),
                    F.expr("try_cast(m.raw AS DOUBLE)").alias("metric_value")))
