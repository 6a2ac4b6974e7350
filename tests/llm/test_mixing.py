from pyspark.sql import functions as F

from umpire.llm.mixing import systematic_mix


def targets(sizes, weights, share, limit):
    """Iterative resharing until none is above its limit."""
    names = sorted((s for s in sizes if s is not None)) + ([None] if None in sizes else [])
    w = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    left, free, out = share * sum(sizes.values()), set(names), {}
    while free:
        total = sum(w[s] for s in free)
        over = {s for s in free if left * w[s] / total > limit * sizes[s]}
        if not over:
            return out | {s: left * w[s] / total for s in free}
        for s in over:
            out[s] = limit * sizes[s]
        left -= sum(out[s] for s in over)
        free -= over
    return out


def test_targets_copies_and_reruns(spark):
    rows = [(i, "w " * (i % 37), ["a", "a", "a", "b", "c", None, "é", "Z"][i % 8]) for i in range(4000)]
    rows += [(None, "x y", "a"), (5, None, "a"), (7000, "", "only empty"), (7001, None, "only empty"), rows[9]]
    docs = spark.createDataFrame([(*r, "clash") for r in rows], "doc_id long, text string, source string, size string")
    got = systematic_mix(docs).collect()
    assert len(got) == len(rows)
    sizes, taken = {}, {}
    for r in got:
        sizes[r["source"]] = sizes.get(r["source"], 0) + r["size"]
        taken[r["source"]] = taken.get(r["source"], 0) + r["size"] * r["copies"]
        assert 0 <= r["copies"] <= 2
    want = targets(sizes, (3, 1, 2), 1.5, 2)
    for r in got:
        assert r["source_size"] == sizes[r["source"]] and abs(r["target"] - want[r["source"]]) < 1e-6 * (1 + r["target"])
    assert all(abs(taken[s] - want[s]) <= 2 * 37 for s in sizes)
    key = lambda rs: sorted((tuple(r) for r in rs), key=repr)
    assert key(got) == key(systematic_mix(docs.repartition(7)).collect())


def test_kept_columns_and_empty_table(spark):
    docs = spark.createDataFrame([(1, "a b", "s", "keep me")], "doc_id long, text string, source string, place string")
    row = systematic_mix(docs, keep=("text", "place")).first()
    assert (row["text"], row["place"], row["target"]) == ("a b", "keep me", 3.0)
    assert systematic_mix(docs.limit(0)).agg(F.count("*")).first()[0] == 0
