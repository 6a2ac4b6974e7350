import base64
import hashlib
import math
import random
from collections import Counter

import numpy as np
import pytest

from umpire.llm import fingerprints as fp
from umpire.llm.text import mix

SHAPE = fp.Shape()


def level(window):
    """Entropy level of one window, from its byte counts."""
    total = sum(round(c * math.log2(c) * (1 << 20)) for c in Counter(window).values())
    return 1000 - 1000 * total // round(len(window) * math.log2(len(window)) * (1 << 20))


def ranks(texts):
    held = Counter(level(t[i:i + SHAPE.window]) for t in texts for i in range(len(t) - SHAPE.window + 1))
    order = sorted(range(1001), key=lambda v: (v < SHAPE.weak, held[v], -v))
    return {v: i for i, v in enumerate(order)}


def brute_features(data, rank):
    """Distinct selected windows in order, neighbourhood by neighbourhood."""
    w, span = SHAPE.window, SHAPE.span
    windows = [data[i:i + w] for i in range(len(data) - w + 1)] or ([data] if data else [])
    own = [rank[level(x)] if len(x) == w else 0 for x in windows]
    votes = Counter()
    for lo in range(-span + 1, len(windows)) if windows else ():
        at = range(max(lo, 0), min(lo + span, len(windows)))
        votes[min(at, key=lambda i: (own[i], i))] += 1
    return list(dict.fromkeys(x for i, x in enumerate(windows) if votes[i] >= SHAPE.least))


def window_hash(x):
    body = np.frombuffer(x.ljust(SHAPE.window, b"\0"), dtype="<u8")
    out = np.array([len(x)], dtype=np.uint64)
    with np.errstate(over="ignore"):
        for word in body:
            out = mix(out * np.uint64(0x9E3779B97F4A7C15) + word)
    return int(out[0])


def brute(data, rank):
    """The fingerprint string, bit by bit."""
    found, parts = brute_features(data, rank), []
    for lo in range(0, len(found), SHAPE.per):
        part = found[lo:lo + SHAPE.per]
        bits = bytearray(fp.BITS // 8)
        for x in part:
            for k in range(5):
                at = window_hash(x) >> (11 * k) & 2047
                bits[at // 8] |= 128 >> at % 8
        parts.append(f"{len(part)}:{base64.b64encode(bytes(bits)).decode()}")
    return ";".join(parts)


def texts_of(rng, n):
    words = ["".join(rng.choice("abcdefghijklmnopé ü") for _ in range(rng.randint(1, 9))) for _ in range(200)]
    return [" ".join(rng.choice(words) for _ in range(rng.choice([0, 1, 3, 30, 200]))) for _ in range(n)]


def edited(own, follows):
    half = len(own) // 2
    return own[:len(own) - half] + follows[:half]


@pytest.mark.parametrize("ranges", [1, 3, 40])
def test_against_brute_force(spark, ranges):
    rng = random.Random(ranges)
    texts = texts_of(rng, 40) + ["a" * 100, "日本語", "x", "", None]
    rows = [(i * 7 - 20, t, "clash", 3) for i, t in enumerate(texts)]
    rng.shuffle(rows)
    frame = spark.createDataFrame(rows, "doc_id long, text string, r string, fingerprint int").repartition(5)
    got = {r["doc_id"]: r for r in fp.edit_likeness(frame, ranges=ranges).collect()}
    assert len(got) == len(rows)
    rank = ranks([(t or "").encode() for t in texts])
    order = sorted(rows, reverse=True)
    for at, (doc_id, text, _, _) in enumerate(order):
        own, follows = text or "", order[(at + 1) % len(order)][1] or ""
        r, new = got[doc_id], edited(own, follows)
        assert r["n_chars"] == len(own)
        assert r["edited_sha256"] == hashlib.sha256(new.encode()).hexdigest()
        assert r["fingerprint"] == brute(own.encode(), rank)
        assert r["edited_fingerprint"] == brute(new.encode(), rank)
        marks = [fp.parse(x) for x in (r["fingerprint"], r["edited_fingerprint"], brute(follows.encode(), rank))]
        assert r["near_edited"] == SHAPE.likeness(marks[0], marks[1])
        assert r["near_next"] == SHAPE.likeness(marks[0], marks[2])


def test_edits_are_nearer_than_strangers(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = fp.edit_likeness(docs).collect()
    assert len(rows) == docs.count()
    long = [r for r in rows if r["n_chars"] >= 300]
    assert sum(r["near_edited"] > 0.2 for r in long) > 0.97 * len(long)
    assert sum(r["near_edited"] >= r["near_next"] for r in rows) > 0.97 * len(rows)
    assert sum(r["near_next"] < 0.2 for r in rows) > 0.95 * len(rows)
    by_text = dict(fp.fingerprints(docs).collect())
    assert all(by_text[r["doc_id"]] == r["fingerprint"] for r in rows)


def test_likeness_is_blockwise_and_symmetric():
    rng = np.random.default_rng(1)
    def chain(n):
        return fp.Digest(rng.integers(0, 256, (n, 256), dtype=np.uint8) & rng.integers(0, 256, (n, 256), dtype=np.uint8), np.full(n, 160))
    a, b = chain(2500), chain(2600)
    b.bits[1500:2000] = a.bits[300:800]
    assert 0.15 < SHAPE.likeness(a, b) == SHAPE.likeness(b, a) < 0.4
    assert SHAPE.likeness(a, a) == 1.0
    none = fp.parse("")
    assert SHAPE.likeness(none, none) == 1.0 and SHAPE.likeness(a, none) == 0.0


def test_a_long_text_by_slices(spark, monkeypatch):
    import pyarrow as pa
    rng = random.Random(5)
    data = " ".join(texts_of(rng, 40)).encode() * 2
    rank = np.argsort(np.random.default_rng(2).permutation(1001))
    whole = [str(d) for d in SHAPE.digests(pa.array([data, b"", data[:50]]), rank)]
    monkeypatch.setattr(fp, "SLICE", 997)
    assert [str(d) for d in SHAPE.digests(pa.array([data, b"", data[:50]]), rank)] == whole


def test_repeated_and_null_ids_and_one_row(spark):
    rows = [(1, "one two three four five six"), (1, "seven eight nine ten eleven"), (1, "one two three four five six"), (None, "null id text here"), (None, None)]
    got = fp.edit_likeness(spark.createDataFrame(rows, "doc_id long, text string"), ranges=3).collect()
    assert len(got) == 5 and sum(r["doc_id"] is None for r in got) == 2
    one = fp.edit_likeness(spark.createDataFrame([(4, "abcd")], "doc_id long, text string")).first()
    assert one["edited_sha256"] == hashlib.sha256(b"abab").hexdigest() and one["near_next"] == 1.0


def test_empty_table(spark):
    assert fp.edit_likeness(spark.createDataFrame([], "doc_id long, text string")).count() == 0
    assert fp.fingerprints(spark.createDataFrame([], "doc_id long, text string")).count() == 0
