import hashlib
import random

from umpire.llm.lines import dedup_lines


def brute(rows, min_words):
    """Every repeated run, pair by pair."""
    docs = {}
    for i, t in rows:
        if t is not None:
            docs.setdefault((i, t), t.split("\n"))
    order = sorted(docs, key=lambda k: (k[0] is not None, k[0] or 0))
    at = [(k, i) for k in order for i in range(len(docs[k]))]
    gone = set()
    for y, (kb, b) in enumerate(at):
        for ka, a in at[:y]:
            n = w = 0
            while a + n < len(docs[ka]) and b + n < len(docs[kb]) and docs[ka][a + n] == docs[kb][b + n]:
                w += len(docs[kb][b + n].split())
                n += 1
            if n and w >= min_words:
                gone |= {(kb, b + j) for j in range(n)}
    return {k: "\n".join(x for i, x in enumerate(docs[k]) if (k, i) not in gone) for k in order}


def test_against_brute_force(spark):
    rng = random.Random(3)
    pool = ["a", "b c", "", "d e f", "g h i j k", "x"]
    for trial in range(3):
        rows = [(i, "\n".join(rng.choice(pool) for _ in range(rng.randint(0, 14)))) for i in range(30)]
        rows += [(None, rows[3][1]), (None, None), (40, None), (41, ""), rows[5], (42, rows[5][1] + "\nnew " * 4)]
        frame = spark.createDataFrame([(i, t, "clash", 5) for i, t in rows], "doc_id long, text string, line string, words int")
        want = brute(rows, 6)
        got = dedup_lines(frame, min_words=6)
        assert got.columns == ["doc_id", "text", "line", "words", "n_lines", "n_removed"]
        result = sorted(((r["doc_id"], r["text"]) for r in got.collect()), key=repr)
        assert result == sorted(((i, None if t is None else want[(i, t)]) for i, t in rows), key=repr)


def test_long_copies_keep_the_first(spark):
    body = "\n".join(f"line {i} of a long text" for i in range(1500))
    frame = spark.createDataFrame([(2, "own start\n" + body), (1, body + "\nown end"), (3, body)], "doc_id long, text string")
    got = {r["doc_id"]: (r["text"], r["n_removed"]) for r in dedup_lines(frame).collect()}
    assert got == {1: (body + "\nown end", 0), 2: ("own start", 1500), 3: ("", 1500)}


def test_very_common_lines_are_dealt(spark, monkeypatch):
    from umpire.llm import lines as L
    rows = [(i, "\n".join(["the most common line of all"] * (i % 7) + [f"own {i % 20} line", "", "x y z"])) for i in range(300)]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    want = sorted(map(tuple, dedup_lines(frame, min_words=6).collect()))
    monkeypatch.setattr(L, "max", lambda *a: 5, raising=False)  # any line of more than five copies counts as common
    assert sorted(map(tuple, dedup_lines(frame, min_words=6).collect())) == want


def test_long_texts_take_time_in_proportion(spark):
    import time
    took = []
    for n in (16_000, 64_000):
        body = "\n".join(f"line {i} of a long text" for i in range(n))
        frame = spark.createDataFrame([(1, body), (2, body)], "doc_id long, text string")
        start = time.perf_counter()
        got = {r["doc_id"]: r["n_removed"] for r in dedup_lines(frame).collect()}
        took.append(time.perf_counter() - start)
        assert got == {1: 0, 2: n}
    assert took[1] < 8 * took[0], took


def test_empty_table(spark):
    assert dedup_lines(spark.createDataFrame([], "doc_id long, text string")).count() == 0
