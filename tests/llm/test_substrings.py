import random
from collections import Counter

import numpy as np
import pytest

from umpire.llm.substrings import column_order, dedup_substrings, window_minima


def brute(texts, length):
    count = Counter(t[i:i + length] for t in texts for i in range(len(t) - length + 1))
    out = []
    for t in texts:
        gone = np.zeros(len(t) + 1, dtype=bool)
        for i in range(len(t) - length + 1):
            if count[t[i:i + length]] > 1:
                gone[i:i + length] = True
        edges = np.diff(np.r_[0, gone.astype(int), 0])
        out.append(([(int(a), int(b)) for a, b in zip(np.flatnonzero(edges == 1), np.flatnonzero(edges == -1))],
                    bytes(np.frombuffer(t, np.uint8)[~gone[:-1]])))
    return out


def check(spark, rows, length, **more):
    frame = spark.createDataFrame([(i, t, "clash", b"x") for i, t in rows], "doc_id long, text string, doc string, body binary")
    got = sorted(((r["doc_id"], r["n_bytes"], r["n_removed"], r["n_spans"], [(s["start"], s["end"]) for s in r["spans"]], bytes(r["kept"]))
                  for r in dedup_substrings(frame.repartition(3), length=length, **more).collect()), key=repr)
    texts = [(t or "").encode() for _, t in rows]
    want = sorted(((i, len(t), len(t) - len(k), len(s), s, k) for (i, _), t, (s, k) in zip(rows, texts, brute(texts, length))), key=repr)
    assert got == want


def corpus(seed, length):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choices("abcdeé ", k=rng.randint(2, 9)))
    text = lambda n: " ".join(word() for _ in range(n))
    passages = [text(length // 4) for _ in range(4)]
    rows = [(0, None), (1, ""), (2, "short"), (3, "z" * (length + 30)), (4, "ab" * length), (None, text(length))]
    for i in range(5, 40):
        bits = [text(rng.randint(0, length // 2))]
        for _ in range(rng.randint(0, 3)):
            p = rng.choice(passages)
            a = rng.randint(0, len(p) // 3)
            bits += [p[a:a + rng.randint(length // 2, len(p))], text(rng.randint(0, 20))]
        rows.append((i, "".join(bits)))
    near = list(rows[10][1])
    near[len(near) // 2] = "#"
    rows += [(41, "".join(near)), (42, rows[20][1]), (42, rows[21][1]), rows[7], (None, rows[8][1])]
    return rows


@pytest.mark.parametrize("length,more", [(65, {}), (100, {"most": 8}), (100, {"hot": 3}), (100, {"crowd": 1}), (400, {}),
                                         (100, {"hot": 3, "crowd": 1})])
def test_against_brute_force(spark, length, more):
    check(spark, corpus(length, length), length, **more)


def test_calm_grams_meet_when_the_table_of_hot_ones_is_small(spark):
    rng = random.Random(3)
    text = lambda n: "".join(rng.choices("abcdefgh ", k=n))
    often, twice = [text(300) for _ in range(8)], [text(300) for _ in range(12)]
    bits = 6 * often + 2 * twice
    rng.shuffle(bits)
    # the first lies between the table's estimated size and its true one, so that the join is
    # rewritten while it runs; the second keeps a small table's tasks apart
    settings = {"spark.sql.autoBroadcastJoinThreshold": "8k", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        check(spark, [(i, text(rng.randint(50, 150)) + b + text(50)) for i, b in enumerate(bits)], 100, hot=4)
    finally:
        for k in settings:
            spark.conf.unset(k)


def test_column_order_by_hand():
    rng = np.random.default_rng(0)
    rows = rng.integers(0, 3, size=(60, 9)).astype(np.uint16)
    hit = column_order(rows, range(0, 5), 4)
    for c in range(5):
        seen = Counter(tuple(r[c:c + 4]) for r in rows.tolist() if 0 not in r[c:c + 4])
        assert list(hit[:, c]) == [0 not in r[c:c + 4] and seen[tuple(r[c:c + 4])] > 1 for r in rows.tolist()]


def test_window_minima():
    x = np.random.default_rng(1).integers(0, 99, 50).astype(np.uint64)
    for w in (1, 7, 49, 50):
        assert list(window_minima(x, w)) == [x[i:i + w].min() for i in range(51 - w)]
    assert len(window_minima(x, 51)) == 0


def test_empty_and_wrong_length(spark):
    frame = spark.createDataFrame([], "doc_id long, text string")
    assert dedup_substrings(frame).count() == 0
    with pytest.raises(ValueError):
        dedup_substrings(frame, length=64)
