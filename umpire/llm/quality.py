"""Quality rules: a decision list learned from labelled text statistics.

``statistics`` measures every whole text in one vectorised pass.  ``fit``
learns an ordered list of threshold conjunctions by sequential covering: a
rule is grown condition by condition on two thirds of the labelled rows (FOIL
gain), pruned from its end on the held-out third, kept if precise there, and
the rows it covers leave the data before the next rule.  ``verdict`` renders
the list as one ordered Spark conditional expression, so scoring all rows is
plain column arithmetic.

Only the fit sees a bounded sample: ``max_rows`` labelled rows with the
smallest hash of their id.  Statistics and verdicts cover every document.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from umpire.llm import text as X

STATS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
         "n_lines", "n_upper", "n_letters", "n_digits", "n_marks")
WINDOW = 8


def _table(chars: str) -> np.ndarray:
    out = np.zeros(256, dtype=bool)
    out[[ord(c) for c in chars]] = True
    return out


_SYMBOL = _table("#*$%&|<>")
_MARK = _table("!?")
_UPPER, _LETTER, _DIGIT = np.zeros((3, 256), dtype=bool)
_UPPER[65:91] = _LETTER[65:91] = _LETTER[97:123] = _DIGIT[48:58] = True
_LEAD = (np.arange(256) & 0xC0) != 0x80  # bytes that begin a code point


def _counts(flags: np.ndarray, off: np.ndarray) -> np.ndarray:
    sums = np.zeros(len(flags) + 1, dtype=np.int64)
    np.cumsum(flags, out=sums[1:])
    return sums[off[1:]] - sums[off[:-1]]


def _repeated(key: np.ndarray) -> np.ndarray:
    """Which keys occur more than once."""
    order = np.argsort(key)
    s = key[order]
    same = np.zeros(len(s) + 1, dtype=bool)
    same[1:-1] = s[1:] == s[:-1]
    out = np.zeros(len(s), dtype=bool)
    out[order] = same[1:] | same[:-1]
    return out


def _measure(data: np.ndarray, off: np.ndarray, hasher: X.SpanHasher) -> dict[str, np.ndarray]:
    texts = len(off) - 1
    salt = X.random_words(5, texts)
    starts, ends = X.word_spans(data, off)
    cut = X.per_text(starts, off)
    out = {"n_words": np.diff(cut), "word_chars": _counts(~X.IS_SPACE[data] & _LEAD[data], off),
           "n_symbols": _counts(_SYMBOL[data], off), "n_upper": _counts(_UPPER[data], off),
           "n_letters": _counts(_LETTER[data], off), "n_digits": _counts(_DIGIT[data], off),
           "n_marks": _counts(_MARK[data], off)}

    breaks = np.flatnonzero(data == 10)
    line_s = np.sort(np.concatenate([off[:-1], breaks + 1]))
    line_e = np.sort(np.concatenate([off[1:], breaks]))
    owner = np.repeat(np.arange(texts), np.diff(np.searchsorted(breaks, off)) + 1)
    out["n_lines"] = np.bincount(owner, minlength=texts)
    wordy = np.searchsorted(starts, line_e) > np.searchsorted(starts, line_s)
    with np.errstate(over="ignore"):
        key = X.mix(hasher.spans(data, line_s, line_e) + salt[owner])[wordy]
    first = np.zeros(len(key), dtype=bool)
    first[np.unique(key, return_index=True)[1]] = True
    out["n_dup_lines"] = np.bincount(owner[wordy][~first], minlength=texts)

    words = hasher.spans(data, starts, ends)
    of = np.repeat(np.arange(texts), out["n_words"])
    runs = X.runs_of(words, WINDOW)
    at = np.flatnonzero(of[:len(runs)] == of[WINDOW - 1:]) if len(runs) else np.zeros(0, dtype=np.int64)
    with np.errstate(over="ignore"):
        hit = at[_repeated(X.mix(runs[at] + salt[of[at]]))]
    cover = np.zeros(len(words) + 1, dtype=np.int64)
    cover[hit] += 1
    cover[hit + WINDOW] -= 1
    out["n_repeat_words"] = np.bincount(of[np.cumsum(cover)[:-1] > 0], minlength=texts)
    return out


def statistics(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
               keep: tuple[str, ...] = ()) -> DataFrame:
    """(doc_id, *keep, statistics as long): one row per input row, in one pass.

    A null text counts as empty.  Extra columns are dropped unless in ``keep``.
    """
    rows = docs.select(F.col(text_col).cast("string").alias("_text"), F.col(id_col), *keep)
    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields[1:]]
                       + [f"{s} long" for s in STATS])

    def run(batches):
        hasher = X.SpanHasher(17)
        for batch in batches:
            parts = [_measure(data, off, hasher) for _, _, data, off in X.groups(batch.column(0))]
            stats = [pa.array(np.concatenate([p[s] for p in parts] or [np.zeros(0)]).astype(np.int64)) for s in STATS]
            yield pa.RecordBatch.from_arrays([*batch.columns[1:], *stats], names=[*batch.schema.names[1:], *STATS])

    return rows.mapInArrow(run, schema)


def features() -> dict[str, Column]:
    """The rates that rules may test, as expressions over the statistics."""
    words = F.greatest(F.col("n_words"), F.lit(1)).cast("double")
    lines = F.greatest(F.col("n_lines"), F.lit(1)).cast("double")
    letters = F.greatest(F.col("n_letters"), F.lit(1)).cast("double")
    return {"words": F.col("n_words").cast("double"), "word_length": F.col("word_chars") / words,
            "symbols_per_word": F.col("n_symbols") / words, "dup_line_share": F.col("n_dup_lines") / lines,
            "repeat_share": F.col("n_repeat_words") / words, "words_per_line": F.col("n_words") / lines,
            "upper_share": F.col("n_upper") / letters, "digits_per_word": F.col("n_digits") / words,
            "marks_per_word": F.col("n_marks") / words}


@dataclass(frozen=True)
class Rule:
    """All of ``conditions`` (feature, "<=" or ">", threshold) mean low quality."""
    conditions: tuple[tuple[str, str, float], ...]

    def holds(self, x: dict[str, np.ndarray]) -> np.ndarray:
        out = np.ones(len(next(iter(x.values()))), dtype=bool)
        for name, op, at in self.conditions:
            out &= x[name] <= at if op == "<=" else x[name] > at
        return out

    def expression(self) -> Column:
        out = F.lit(True)
        for name, op, at in self.conditions:
            value = features()[name]
            out = out & ((value <= F.lit(at)) if op == "<=" else (value > F.lit(at)))
        return out


def _grow(x: dict[str, np.ndarray], bad: np.ndarray, cuts: dict[str, np.ndarray], longest: int) -> Rule:
    conditions: list[tuple[str, str, float]] = []
    live = np.ones(len(bad), dtype=bool)
    while len(conditions) < longest and live.any() and not bad[live].all():
        p0, n0 = bad[live].sum(), (~bad[live]).sum()
        if p0 == 0:
            break
        best = (1e-9, None)
        for name in sorted(x):
            for at in cuts[name]:
                under = x[name][live] <= at
                for op, side in (("<=", under), (">", ~under)):
                    p = int((side & bad[live]).sum())
                    n = int(side.sum()) - p
                    if p:
                        gain = p * (np.log2(p / (p + n)) - np.log2(p0 / (p0 + n0)))
                        if gain > best[0]:
                            best = (gain, (name, op, float(at)))
        if best[1] is None:
            break
        conditions.append(best[1])
        live = Rule(tuple(conditions)).holds(x)
    return Rule(tuple(conditions))


def _prune(rule: Rule, x: dict[str, np.ndarray], bad: np.ndarray) -> tuple[Rule, float, int]:
    best = (rule, 0.0, 0, -1.0)
    for k in range(len(rule.conditions), 0, -1):
        cut = Rule(rule.conditions[:k])
        hit = cut.holds(x)
        p, n = int(bad[hit].sum()), int((~bad[hit]).sum())
        if p + n and (p - n) / (p + n) >= best[3]:
            best = (cut, p / (p + n), p, (p - n) / (p + n))
    return best[:3]


def sequential_cover(x: dict[str, np.ndarray], bad: np.ndarray, longest: int = 4, most: int = 16,
                     precision: float = 0.9, support: int = 2, cuts: int = 32) -> list[Rule]:
    """Ordered rules for the bad rows; empty where nothing can be learned."""
    rules: list[Rule] = []
    held = np.arange(len(bad)) % 3 == 2
    left = np.ones(len(bad), dtype=bool)
    points = {k: np.unique(np.quantile(v, np.linspace(0, 1, cuts + 1))) if len(v) else np.zeros(0) for k, v in x.items()}
    while len(rules) < most:
        grow, prune = left & ~held, left & held
        if not bad[grow].any() or bad[grow].all():
            break
        inside = {k: v[grow] for k, v in x.items()}
        # thresholds also from the bad rows themselves: they may be few
        local = {k: np.unique(np.concatenate([points[k], np.quantile(v[bad[grow]], np.linspace(0, 1, cuts + 1))]))
                 for k, v in inside.items()}
        rule = _grow(inside, bad[grow], local, longest)
        if not rule.conditions:
            break
        rule, share, found = _prune(rule, {k: v[prune] for k, v in x.items()}, bad[prune])
        if share < precision or found < support:
            break
        rules.append(rule)
        left &= ~rule.holds(x)
    return rules


def labelled(rows: DataFrame, labels: DataFrame, id_col: str, label_col: str, max_rows: int) -> DataFrame:
    """(id, _label) of labels 0 and 1, an id labelled twice by its lowest: all of them, or
    where ``rows`` hold many more than ``max_rows``, those under a bound of the id's hash
    that surely includes the ``max_rows`` rows of smallest hash."""
    known = (labels.filter(F.col(label_col).isin(0, 1) & F.col(id_col).isNotNull())
             .groupBy(F.col(id_col)).agg(F.min(label_col).alias("_label")))
    held = rows.select(id_col).join(known, id_col).count()
    if held > 2 * max_rows:
        few = known.filter(F.xxhash64(id_col) <= int((1 << 64) * 1.2 * max_rows / held) - (1 << 63))
        if rows.select(id_col).join(few, id_col).count() >= max_rows:
            return few
    return known


def fit(stats: DataFrame, labels: DataFrame, id_col: str = "doc_id", label_col: str = "quality",
        max_rows: int = 20_000, **options) -> list[Rule]:
    """Learn the list from rows with label 0 (bad) or 1.

    Rows without a label or id take no part; an id labelled twice counts by its
    lowest label.  The ``max_rows`` rows of smallest id hash are used, in hash
    order, so a refit agrees.  Only rows near that bound are sorted.
    """
    known = labelled(stats, labels, id_col, label_col, max_rows)
    rows = (stats.join(known, id_col).select(F.xxhash64(F.col(id_col)).alias("_h"), F.col(id_col).alias("_id"),
                                             (F.col("_label") == 0).alias("_bad"),
                                             *[c.alias(n) for n, c in features().items()])
            .orderBy("_h", "_id", *features()).limit(max_rows).toPandas())
    x = {n: rows[n].to_numpy(dtype=float) for n in features()}
    return sequential_cover(x, rows["_bad"].to_numpy(dtype=bool), **options)


def verdict(rules: list[Rule]) -> Column:
    """True for rows to keep: the first rule that holds decides, else keep."""
    out = F.lit(True)
    for rule in reversed(rules):
        out = F.when(rule.expression(), F.lit(False)).otherwise(out)
    return out


def base_failed() -> Column:
    return (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))


def quality_rules(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  keep: tuple[str, ...] = (), **options) -> DataFrame:
    """Statistics of every row, ``base_failed`` and ``kept``.

    Without ``keep`` the statistics are written once to the checkpoint folder, and the
    fit and the verdict read them there.  With it the fit first measures the rows that
    it may use, so the texts of the others are read once.
    """
    stats = statistics(docs, id_col, text_col, keep)
    if not keep:
        stats = stats.checkpoint()
        rules = fit(stats, labels, id_col, **options)
    else:
        bound = options.get("max_rows", 20_000)
        known = labelled(docs, labels, id_col, options.get("label_col", "quality"), bound).checkpoint()
        known = F.broadcast(known) if known.count() <= 4 * bound else known
        sample = docs.join(known.select(id_col), id_col, "left_semi")
        rules = fit(statistics(sample, id_col, text_col).checkpoint(), labels, id_col, **options)
    return (stats.withColumn("base_failed", base_failed())
            .withColumn("kept", ~F.col("base_failed") & verdict(rules)))
