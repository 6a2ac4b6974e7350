import random
import re
import zlib
from collections import Counter

from umpire.llm import spelling
from umpire.llm.spelling import near_words, spelling_variants


def near(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return len(a) + 1 == len(b) and any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def brute_words(rows):
    n = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 199 == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            n[run] += len(run) >= 6
    return {w: c for w, c in n.items() if c >= 5}


def brute(rows):
    n = brute_words(rows)
    links = {w: [v for v in n if near(w, v)] for w in n}
    form = {}
    for w, other in links.items():
        best = min(other, key=lambda v: (-n[v], v), default=None)
        form[w] = best if best is not None and n[best] >= 5 * n[w] else None
    out = []
    for w in n:
        root = w
        while form[root] is not None:
            root = form[root]
        out.append((w, form[w], root, n[w], len(links[w]), n[form[w]] if form[w] else None))
    return sorted(out, key=repr)


def corpus(rng, n):
    base = ["".join(rng.choice("abÉé÷") for _ in range(rng.randint(5, 9))) for _ in range(25)]
    words = list(base)
    for w in base:
        for _ in range(4):
            at = rng.randrange(len(w) + 1)
            words += [w[:at] + rng.choice("abcé") + w[at:], w[:at] + w[at + 1:], w[:at] + "A" + w[at + 1:]]
    weights = [rng.choice([1, 3, 40, 300]) for _ in words]
    return [(i * 13, rng.choice([" ", ", ", "\n"]).join(rng.choices(words, weights, k=rng.randint(0, 150)))) for i in range(n)]


def test_against_brute_force(spark):
    rng = random.Random(4)
    rows = corpus(rng, 120) + [(None, "Zebraword " * 7), (5, None), (6, ""), (13, "zebrawordx " * 40), (14, "zebrawordxy " * 240)]
    rows += rows[:3]
    frame = spark.createDataFrame([(i, t, "clash", 2) for i, t in rows], "doc_id long, text string, word string, n int").repartition(4)
    want = brute(rows)
    assert sum(r[1] is not None for r in want) > 10 and any(r[1] != r[2] for r in want if r[1])
    for crowd in (200, 4, 0):
        got = spelling_variants(frame, crowd=crowd)
        assert got.columns == ["word", "form", "root", "n", "n_near", "form_n"]
        assert sorted((tuple(r) for r in got.collect()), key=repr) == want


def test_crowded_grams_pair_once(spark):
    words = [f"{a}{b}crowdedword{c}{d}" for a in "abcé" for b in "xy" for c in "pqr" for d in "stu"]
    words += [w + "z" for w in words[:20]] + [w[:5] + w[6:] for w in words[:9]]
    frame = spark.createDataFrame([(w, 1) for w in words], "word string, n long")
    want = sorted((a, b) for i, a in enumerate(words) for b in words[i + 1:] if near(a, b))
    for crowd in (1000, 5):
        got = [tuple(sorted((r["a"], r["b"]))) for r in near_words(frame, crowd=crowd).collect()]
        assert sorted(got) == sorted(tuple(sorted(p)) for p in want)


def test_a_very_long_run_and_slices(spark, monkeypatch):
    monkeypatch.setattr(spelling, "SLICE", 50)
    text = "shortword " * 30 + "x" * 1000 + " shortword" * 30
    assert dict(Counter(dict()) + sum((Counter({r: c}) for r, c in spelling.runs_of(text, 6)), Counter())) == {"shortword": 60, "x" * 1000: 1}


def test_empty_table(spark):
    assert spelling_variants(spark.createDataFrame([], "doc_id long, text string")).count() == 0
