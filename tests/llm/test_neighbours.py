import numpy as np
from pyspark.sql import functions as F

from umpire.llm.neighbours import footrules, inverted_files, nearest


def brute(rows, k):
    ok = [(i, np.array(v, dtype=float)) for i, v in rows if i is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v)]
    out = {}
    for q, v in ok:
        if q % 50 == 0:
            found = sorted((-(v @ w) / np.sqrt((v @ v) * (w @ w)), i) for i, w in ok if i != q and len(w) == len(v))
            out[q] = [(i, -s) for s, i in found[:k]]
    return out


def run(spark, rows, **more):
    frame = spark.createDataFrame([(i, v, "clash") for i, v in rows], "vec_id long, embedding array<float>, size string")
    got = {}
    for r in nearest(frame, F.col("vec_id") % 50 == 0, **more).orderBy("query_id", "rank").collect():
        got.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    return got


def test_footrule_by_hand():
    a, b = [2, 0, 5], [0, 2, 1]
    files = inverted_files(np.array([b, a, [1, 3, 4]]), 6, 3)
    assert list(footrules(np.array(a), files, 3)) == [1 + 1 + 1 + 1, 0, 12]


def test_odd_rows_and_ties(spark):
    rng = np.random.default_rng(0)
    one = [1.0, 2.0, 3.0]
    rows = [(0, one), (3, one), (2, one), (1, [2.0, 4.0, 6.0]), (50, [0.0, 0.0, 0.0]), (100, None), (150, [1.0, None, 2.0]),
            (200, [float("nan"), 1.0, 1.0]), (250, [float("inf"), 1.0, 1.0]), (300, []), (None, one), (350, [1.0, 0.0]),
            (351, [0.0, 1.0])] + [(i, [float(x) for x in rng.normal(size=3)]) for i in range(400, 460)]
    got = run(spark, rows)
    want = brute(rows, 5)
    assert set(got) == set(want)
    for q, found in want.items():
        assert [r for r, _, _ in got[q]] == list(range(1, len(found) + 1))
        assert np.allclose([s for _, _, s in got[q]], [s for _, s in found])
    assert [i for _, i, _ in got[0]][:3] == [1, 2, 3] and got[350][0][1] == 351


def test_recall_and_exact_scores(spark):
    rows = [(r["vec_id"], r["embedding"]) for r in spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet").collect()]
    got, want = run(spark, rows), brute(rows, 5)
    hits = [len({i for _, i, _ in got[q]} & {i for i, _ in want[q]}) for q in want]
    assert np.mean(hits) / 5 >= 0.9
    vecs = {i: np.array(v, dtype=float) for i, v in rows}
    for q, found in got.items():
        for _, i, s in found:
            v, w = vecs[q], vecs[i]
            assert abs(s - v @ w / np.sqrt((v @ v) * (w @ w))) < 1e-12


def test_recall_over_small_blocks_with_a_hot_vector(spark):
    rng = np.random.default_rng(4)
    rows = [(i, [float(x) for x in rng.normal(size=16)]) for i in range(2000)]
    rows = [(i, rows[7][1] if i % 3 == 1 else v) for i, v in rows]
    got, want = run(spark, rows, block=500, pivots=64, places=32, least=16), brute(rows, 5)
    assert np.mean([len({i for _, i, _ in got[q]} & {i for i, _ in want[q]}) for q in want]) / 5 >= 0.9


def test_empty(spark):
    assert run(spark, [(50, None)]) == {}
