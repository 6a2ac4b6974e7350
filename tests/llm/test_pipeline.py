from collections import Counter

import corpus_pipeline as P
from umpire.llm import quality
from umpire.llm.lines import dedup_lines

SF = "/root/testdata/sf0.001"


def test_stages_on_the_small_table(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns = docs.columns
    frames = []
    for name, stage in P.STAGES:
        stage(spark, docs, SF).write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        frames.append(docs)
        assert name == P.STAGES[-1][0] or docs.columns == columns
    before = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    good, deduped, single, mixed, pieces = frames

    stats = quality.quality_rules(spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet"))
    keep = {r["doc_id"] for r in stats.filter("kept").collect()}
    assert {r["doc_id"]: r["text"] for r in good.collect()} == {i: before[i] for i in keep}

    want = {r["doc_id"]: r["text"] for r in dedup_lines(good).collect() if r["n_removed"] == 0 or r["text"].strip()}
    rows = deduped.collect()
    assert {r["doc_id"]: r["text"] for r in rows} == want
    assert all(r["n_chars"] == len(r["text"]) for r in rows if r["text"] != before[r["doc_id"]])

    def shingles(t):
        w = t.translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")).split()
        return {tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))} if w else set()
    sets = {i: shingles(t) for i, t in want.items()}
    parent = {i: i for i in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x
    ids = sorted(sets)
    for n, a in enumerate(ids):
        for b in ids[:n]:
            if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                x, y = find(a), find(b)
                parent[max(x, y)] = min(x, y)
    assert {r["doc_id"]: r["text"] for r in single.collect()} == {i: t for i, t in want.items() if find(i) == i}

    copies = Counter(r["doc_id"] for r in mixed.collect())
    assert set(copies) <= {r["doc_id"] for r in single.collect()} and max(copies.values()) <= 2
    per_doc = Counter()
    for r in pieces.collect():
        per_doc[r["doc_id"]] += r["length"] / r["doc_tokens"]
    assert {i: round(n, 6) for i, n in per_doc.items()} == {i: float(n) for i, n in copies.items()}


def test_odd_rows_pass_every_stage(spark, tmp_path):
    body = " ".join(f"word{i}" for i in range(60))
    rows = [(1, body, "en", "a", 9, "x"), (1, body, "en", "a", 9, "x"), (None, body + " end", "en", None, None, None), (2, None, None, None, None, "y"),
            (3, "", "en", "a", 0, "x"), (4, body + "\n" + body + " other", "en", "a", 1, "n")]
    schema = "doc_id long, text string, lang string, source string, n_chars long, kept string"
    for name, data in (("some", rows), ("none", [])):
        docs = spark.createDataFrame(data, schema)
        for k, (_, stage) in enumerate(P.STAGES):
            stage(spark, docs, SF).write.parquet(str(tmp_path / f"{name}{k}"))
            docs = spark.read.parquet(str(tmp_path / f"{name}{k}"))
        assert (docs.count() > 0) == bool(data)


def test_clashing_names_pass_every_stage(spark, tmp_path):
    """Extra columns named like anything that a stage computes come out as they went in."""
    names = ["n_words", "kept", "n_removed", "n_lines", "_gone", "_doc", "_mark", "copies", "size", "target", "place", "carried", "copy", "mark",
             "h", "line", "component_id", "n_shingles", "tree", "_node", "base_failed", "word_chars", "_label", "_id", "rank", "start", "fresh"]
    body = " ".join(f"word{i}" for i in range(60))
    rows = [(1, body, "en", "a", 9), (2, body + " more", "en", "a", 9), (3, " ".join(f"other{i}" for i in range(80)), "en", "b", 9), (3, "short", "en", "b", 5)]
    schema = "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"{n} string" for n in names)
    plain = docs = spark.createDataFrame([(*r, *[f"{r[0]}{n}" for n in names]) for r in rows], schema)
    plain = plain.drop(*names)
    for k, (name, stage) in enumerate(P.STAGES):
        stage(spark, docs, SF).write.parquet(str(tmp_path / f"odd{k}"))
        stage(spark, plain, SF).write.parquet(str(tmp_path / f"plain{k}"))
        docs, plain = spark.read.parquet(str(tmp_path / f"odd{k}")), spark.read.parquet(str(tmp_path / f"plain{k}"))
        if name != P.STAGES[-1][0]:
            assert docs.columns == [f.split()[0] for f in schema.split(", ")]
            assert [(name, r["doc_id"], n, r[n]) for r in docs.collect() for n in names if r[n] != f"{r['doc_id']}{n}"] == []
            assert sorted(map(tuple, docs.select(*plain.columns).collect())) == sorted(map(tuple, plain.collect())) != []
    ids = docs.select("doc_id", "length").collect()
    assert ids and sorted(ids) == sorted(plain.select("doc_id", "length").collect())


def test_repeated_ids_are_judged_text_by_text(spark):
    words = {x: [f"{x}{i}" for i in range(200)] for x in "abc"}
    copy, near, own, other = (" ".join(words["a"]), " ".join(words["a"][:-2] + ["new"]), " ".join(words["b"]), " ".join(words["c"]))
    rows = [(1, copy), (5, copy), (5, own), (6, near), (6, other), (7, other), (7, other), (None, own), (None, None), (8, None), (8, near)]
    docs = spark.createDataFrame([(i, t, "x") for i, t in rows], "doc_id long, text string, source string")
    got = sorted((tuple(r) for r in P.near_copies(spark, docs, SF).collect()), key=repr)
    want = [(1, copy), (5, own), (6, other), (8, None), (None, own), (None, None)]
    assert got == sorted(((i, t, "x") for i, t in want), key=repr)
