import re
from collections import Counter

import numpy as np
import pytest

from umpire.llm import quality as Q

WORD = re.compile(r"[^\x20\x09-\x0d]+")
TEXTS = [None, "", "  \n\t ", "one", "a b c d e f g h " * 3, "é ü#ß |x|\n\né ü#ß |x|\n x\n x", "x " * 5000 + "\n" + "tail",
         "no\x00sep\x1cword here", "a b c d e f g h\ni\na b c d e f g h\n", "w" * 300_000 + " " + "y" * 600_000, "ends \n"]


def brute(text):
    text = text or ""
    words = WORD.findall(text)
    lines = [x for x in text.split("\n") if WORD.search(x)]
    runs = Counter(tuple(words[i:i + 8]) for i in range(len(words) - 7))
    covered = {j for i in range(len(words) - 7) if runs[tuple(words[i:i + 8])] > 1 for j in range(i, i + 8)}
    return (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(covered))


def test_statistics_match_brute_force(spark):
    docs = spark.createDataFrame([(i, t, "extra") for i, t in enumerate(TEXTS)], "doc_id long, text string, n_words string")
    got = {r["doc_id"]: tuple(r[c] for c in Q.STATS[:5]) for r in Q.statistics(docs).collect()}
    assert got == {i: brute(t) for i, t in enumerate(TEXTS)}


def test_statistics_of_the_small_table(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    got = {r["doc_id"]: tuple(r[c] for c in Q.STATS[:5]) for r in Q.statistics(docs).collect()}
    assert got == {r["doc_id"]: brute(r["text"]) for r in docs.collect()}


def test_covering_finds_planted_rules():
    rng = np.random.default_rng(1)
    x = {"a": rng.random(3000), "b": rng.random(3000), "c": rng.random(3000)}
    bad = (x["a"] > 0.8) & (x["b"] <= 0.5) | (x["c"] > 0.95)
    rules = Q.sequential_cover(x, bad, cuts=40)
    said = np.zeros(3000, dtype=bool)
    for r in rules:
        said |= r.holds(x)
    assert (said == bad).mean() > 0.97


@pytest.mark.parametrize("bad", [np.zeros(30, bool), np.ones(30, bool), np.zeros(0, bool)])
def test_nothing_to_learn(bad):
    assert Q.sequential_cover({"a": np.arange(len(bad), dtype=float)}, bad) == []


def test_verdict_agrees_with_the_rules_and_held_out_labels(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    learn, rest = labels.filter("doc_id % 2 = 0"), labels.filter("doc_id % 2 = 1")
    stats = Q.statistics(docs).cache()
    rules = Q.fit(stats, learn)
    rows = (stats.select("doc_id", *[c.alias(n) for n, c in Q.features().items()], Q.verdict(rules).alias("kept"))
            .toPandas())
    said = np.zeros(len(rows), dtype=bool)
    x = {n: rows[n].to_numpy() for n in Q.features()}
    for r in rules:
        said |= r.holds(x)
    assert (said == ~rows["kept"].to_numpy()).all()
    both = rows.merge(rest.toPandas(), on="doc_id")
    good, bad = both[both.quality == 1], both[both.quality == 0]
    assert good.kept.mean() > 0.97 and bad.kept.mean() < 0.5
    stats.unpersist()


def test_empty_tables_and_missing_labels(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    labels = spark.createDataFrame([], "doc_id long, quality int")
    assert Q.quality_rules(docs, labels).count() == 0
    one = spark.createDataFrame([(None, "a b c " * 30), (1, None)], "doc_id long, text string")
    got = {r["doc_id"]: (r["base_failed"], r["kept"]) for r in Q.quality_rules(one, labels).collect()}
    assert got == {None: (True, False), 1: (True, False)}
