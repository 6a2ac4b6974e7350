import random
import re

from umpire.llm.graph import components
from umpire.llm.minhash import near_duplicates

LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingles(text, k):
    w = re.findall(r"[^\x20\x09-\x0d]+", (text or "").translate(LOW))
    return {tuple(w[j:j + k]) for j in range(max(1, len(w) - k + 1))} if w else set()


def roots(ids, links):
    parent = {i: i for i in ids}

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x
    for a, b in links:
        x, y = find(a), find(b)
        parent[max(x, y)] = min(x, y)
    return {i: find(i) for i in ids}


def check(spark, rows, k, num, partitions=5, **more):
    docs = spark.createDataFrame([(i, t, "clash", 1) for i, t in rows], "doc_id long, text string, n string, a int")
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"], r["kept"])
           for r in near_duplicates(docs.repartition(partitions), k=k, num=num, den=100, **more).collect()}
    sets = {i: shingles(t, k) for i, t in rows}
    ids = sorted(sets)
    links = [(a, b) for n, a in enumerate(ids) for b in ids[:n] if sets[a] and sets[b]
             and 100 * len(sets[a] & sets[b]) >= num * len(sets[a] | sets[b])]
    root = roots(ids, links)
    assert got == {i: (len(sets[i]), root[i], root[i] == i) for i in ids}


def test_against_brute_force(spark):
    rng = random.Random(7)
    vocabulary = [f"w{i}" for i in range(400)] + ["É", "ß"]
    rows, n = [(0, None), (1, ""), (2, " \n"), (3, "one"), (4, "ONE"), (5, "one two"), (6, "two one")], 7
    for _ in range(25):
        base = [rng.choice(vocabulary) for _ in range(rng.randint(30, 250))]
        for _ in range(rng.randint(1, 9)):
            own = list(base)
            for _ in range(rng.randint(0, 6)):
                own[rng.randrange(len(own))] = rng.choice(vocabulary).upper()
            rows.append((n, rng.choice([" ", "\n", "\t "]).join(own)))
            n += 1
    check(spark, rows, 3, 85)
    check(spark, rows, 5, 80)


def test_one_large_group_of_near_copies(spark):
    rng = random.Random(8)
    base = [f"w{i}" for i in range(120)]
    rows = []
    for i in range(400):
        own = list(base)
        for _ in range(rng.randint(0, 5)):
            own[rng.randrange(120)] = f"x{i}-{rng.randrange(99)}"
        rows.append((i, " ".join(own)))
    check(spark, rows, 3, 85, partitions=9)


def test_empty_and_ids(spark):
    assert near_duplicates(spark.createDataFrame([], "doc_id long, text string")).count() == 0
    docs = spark.createDataFrame([(None, "a b c d e f"), (3, "a b c d e f"), (3, "a b c d e f"), (2, "a b c d e f")], "doc_id long, text string")
    got = sorted(map(tuple, near_duplicates(docs).collect()), key=repr)
    assert got == sorted([(None, 2, None, True), (3, 2, 2, False), (3, 2, 2, False), (2, 2, 2, True)], key=repr)


def test_components_of_random_graphs(spark):
    rng = random.Random(2)
    for nodes, edges in ((60, 40), (200, 180), (50, 0)):
        links = [(rng.randrange(nodes), rng.randrange(nodes)) for _ in range(edges)] + ([(i, i + 1) for i in range(300, 360)] if edges else [])
        links = [x for x in links if x[0] != x[1]]
        got = {r["node"]: r["root"] for r in components(spark.createDataFrame(links, "a long, b long"), "a", "b").collect()}
        want = roots({x for e in links for x in e}, links)
        assert got == want


def test_trees_hold_the_miss_rate_at_any_similarity():
    from umpire.llm import minhash
    for share, trees in ((0.85, 16), (0.8, 23)):
        assert minhash.trees_for(share, 4) == trees and (1 - share ** 4) ** trees <= 7.5e-6
    assert minhash.trees_for(1.0, 4) == minhash.trees_for(0.99, 4) == 16
