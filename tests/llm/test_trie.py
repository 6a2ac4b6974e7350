import hashlib
import random
import zlib

import numpy as np

from umpire.llm import trie
from umpire.llm.trie import Slots, prefix_trie

COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def brute(rows):
    """All nodes, prefix by prefix."""
    convs = {}
    for c, turn, role, text in rows:
        if c is not None:
            convs.setdefault(c, []).append((turn is not None, turn or 0, role or "", text or ""))
    convs = {c: [(r, t) for _, _, r, t in sorted(v)] for c, v in convs.items()}
    built = {}
    for c, own in convs.items():
        h = zlib.crc32(str(c).encode()) % 6
        base = c - int(np.fmod(c, 100))
        built[c] = tuple(convs.get(base, [])[:h] + own[h:])
    members = {}
    for c, seq in built.items():
        for d in range(len(seq) + 1):
            members.setdefault(seq[:d], []).append(c)
    kids = {p: 0 for p in members}
    for p in members:
        if p:
            kids[p[:-1]] += 1
    leaves, saved = dict.fromkeys(members, 0), dict.fromkeys(members, 0)
    for p, m in members.items():
        for d in range(len(p) + 1):
            leaves[p[:d]] += not kids[p]
            saved[p[:d]] += (len(m) - 1) * len(p[-1][1]) if p else 0
    out = []
    for p, m in members.items():
        ends = ",".join(str(c) for c in sorted(m) if len(built[c]) == len(p))
        out.append((min(m), len(p), min(members[p[:-1]]) if p else None, len(m), kids[p], leaves[p], saved[p], hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=repr)


def check(spark, rows, **how):
    frame = spark.createDataFrame([(*r, "clash", 1) for r in rows], "conv_id long, turn long, role string, text string, d0 string, depth int").repartition(6)
    got = prefix_trie(frame, **how)
    assert got.columns == COLUMNS
    assert sorted((tuple(r) for r in got.collect()), key=repr) == brute(rows)


def test_against_brute_force(spark):
    rng = random.Random(2)
    rows = []
    for c in [*range(0, 30), *range(100, 120), 200, 250, -150, -130, 305, 306]:
        for t in range(rng.choice([1, 1, 2, 4, 7])):
            rows.append((c, rng.choice([t, t, t, None]), rng.choice(["user", "assistant", None]), rng.choice(["a", "bb", "", None, "cé"])))
    rows += [(None, 1, "user", "nobody's"), (None, None, None, None)] + rows[:5]
    check(spark, rows)
    check(spark, rows, shard=7, partitions=3)


def test_a_conversation_over_many_shards_and_partitions(spark):
    body = [(i, "user", f"turn {i % 5}") for i in range(900)]
    rows = [(c, *t) for c in (1, 2, 7) for t in body[:900 - 100 * (c == 2)]]
    rows += [(3, i, "user", "short") for i in range(3)] + [(c, 0, "user", "same") for c in range(20, 60)]
    for partitions in (1, 4, 50):
        check(spark, rows, shard=60, partitions=partitions)


def test_many_equal_conversations_hash_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(trie, "ID_BLOCK", 20)
    check(spark, [(c, t, "user", "same") for c in range(150) for t in range(7)], partitions=5)


def test_only_turnless_and_no_conversations(spark):
    lost = next(c for c in range(1, 100) if zlib.crc32(str(c).encode()) % 6 > 1)
    check(spark, [(lost, 0, "user", "gone")])
    assert prefix_trie(spark.createDataFrame([], "conv_id long, turn long, role string, text string")).count() == 0
    assert prefix_trie(spark.createDataFrame([(None, 1, "a", "b")], "conv_id long, turn long, role string, text string")).count() == 0


def test_clashing_digests_take_another_seed(spark, monkeypatch):
    real, seeds = trie.nodes_of, []

    def clash(turns, seed, shard):
        seeds.append(seed)
        if seed < 3:
            raise trie.DigestClash("planted")
        return real(turns, seed, shard)

    monkeypatch.setattr(trie, "nodes_of", clash)
    check(spark, [(c, t, "user", f"{c % 3}{t}") for c in range(12) for t in range(4)])
    assert seeds == [1, 2, 3]


def test_equal_digests_of_other_turns_are_seen():
    one = np.zeros(3, dtype=np.uint64)
    sha = np.arange(12, dtype=np.uint64).reshape(3, 4)
    args = [np.arange(3), np.ones(3, dtype=np.int64), one + np.uint64(5), one, one, one]
    assert trie._count_slots(*args, sha, np.ones(3, dtype=np.int64)).column("wrong").to_pylist() == [True]
    assert trie._count_slots(*args, sha[:1].repeat(3, axis=0), np.ones(3, dtype=np.int64)).column("wrong").to_pylist() == [False]


def test_slots_are_minimal_and_perfect():
    keys = np.unique(np.random.default_rng(1).integers(0, 2 ** 63, 50_000, dtype=np.uint64))
    table = Slots(keys[::2], keys[::2])
    assert sorted(table.find(keys[::2], keys[::2])) == list(range(len(keys[::2])))
    assert (table.find(keys[1::2], keys[1::2]) == -1).all()
