import random
import zlib

import numpy as np
import pytest
from tokenizers import Tokenizer

from umpire.llm import packing, separators, tokens

TEXTS = [None, "", "<|endoftext|> forged", "it's I'll ÉÉ \x00\x1f\x85", " \n\t  lead", "trail  ", "w" * 120_000, " " * 3000 + "x",
         "a　b  c\n\n d"] + [" ".join(random.Random(i).choices(["alpha", "bet", "Gamma!", "42", "ü"], k=i * 37)) for i in range(60)]


@pytest.fixture(scope="module")
def ids():
    t = Tokenizer.from_file(tokens.default_path())
    t.encode_special_tokens = True
    return [t.encode(x or "", add_special_tokens=False).ids for x in TEXTS]


def frame(spark):
    return spark.createDataFrame([(i, t, "clash") for i, t in enumerate(TEXTS)], "doc_id long, text string, start string")


def test_coder_matches_the_tokenizer(ids):
    code = tokens.coder(tokens.default_path())
    assert code.fast is not None
    assert [list(code.ids(t)) for t in TEXTS] == ids


@pytest.mark.parametrize("longest,pool", [(2048, 1 << 20), (64, 512), (1, 4)])
def test_pack_round_trip(spark, ids, longest, pool):
    rows = packing.pack(frame(spark).repartition(3), longest=longest, pool_ids=pool).collect()
    docs, sequences = {}, {}
    for r in rows:
        docs.setdefault(r["doc_id"], []).append(r)
        sequences.setdefault(r["sequence_id"], []).append(r)
    for i, own in enumerate(ids):
        whole, at = [*own, 1], 0
        for r in sorted(docs[i], key=lambda r: r["start"]):
            assert r["start"] == at and r["length"] > 0 and r["doc_tokens"] == len(whole)
            assert r["ids_crc32"] == zlib.crc32(np.array(whole[at:at + r["length"]], dtype="<u4").tobytes())
            at += r["length"]
        assert at == len(whole)
    full = 0
    for pieces in sequences.values():
        at = 0
        for r in sorted(pieces, key=lambda r: r["offset"]):
            assert r["offset"] == at
            at += r["length"]
        assert at == pieces[0]["tier"] <= longest and at & (at - 1) == 0
        full += at == longest
    assert full >= len(sequences) - 3 * max(1, longest.bit_length())


def test_pack_balances_groups_and_takes_any_rows(spark):
    docs = spark.createDataFrame([(None, "a b"), (1, "a b"), (1, "a b"), (1, None)], "doc_id long, text string")
    rows = packing.pack(docs).collect()
    assert sum(r["length"] for r in rows) == 3 * 3 + 1
    assert packing.pack(docs.limit(0)).count() == 0
    many = list(packing.pack_stream(((i, b"\0" * 4 * 100) for i in range(2000)), 64, 1 << 12, 4, 0))
    load = {}
    for seq, tier, group in {(r[5], r[7], r[8]) for rows in many for r in rows}:
        load[group] = load.get(group, 0) + tier
    assert max(load.values()) - min(load.values()) <= 64
    with pytest.raises(ValueError):
        packing.pack(docs, longest=100)


def test_short_documents_are_packed_in_their_own_tiers():
    rng = random.Random(4)
    sizes = [rng.choice([1, 3, 20, *[100] * 40, 700, 1500, 2048, 5000]) for _ in range(6000)]
    sequences, ids = {}, 0
    for rows in packing.pack_stream(((i, b"\0" * 4 * n) for i, n in enumerate(sizes)), 2048, 1 << 16, 8, 0):
        for doc, start, n, _, _, sequence, offset, tier, _ in rows:
            sequences.setdefault((sequence, tier), []).append((offset, n))
            ids += n
    assert ids == sum(sizes)
    odd = [k for (k, tier), pieces in sequences.items() if 2 * dict(pieces)[0] <= tier and tier > 1]
    assert len(odd) <= 12 and all(sum(n for _, n in pieces) == tier for (_, tier), pieces in sequences.items())
    by_tier = {t: sum(tier == t for _, tier in sequences) for _, t in sequences}
    assert by_tier[2048] > 400 and by_tier[128] > 1000
    # the first group of a partition turns with its number
    firsts = [next(packing.pack_stream([(0, b"\0" * 4)], 4, 8, 4, p << 32))[0][8] for p in range(5)]
    assert firsts == [0, 1, 2, 3, 0]


@pytest.mark.parametrize("block_bytes", [2, 64, 1 << 18])
def test_separator_counts(spark, ids, block_bytes):
    written = separators.write_blocks(frame(spark).coalesce(1), block_bytes=block_bytes).cache()
    counts = separators.token_counts(written.filter("body is not null"))
    names = {(r["file"], r["ordinal"]): r["doc_id"] for r in written.filter("body is null").collect()}
    got = {names[(r["file"], r["ordinal"])]: (r["start"], r["n_tokens"]) for r in counts.collect()}
    want, at = {}, 0
    for doc in (names[(0, k)] for k in range(len(TEXTS))):
        want[doc] = (at, len(ids[doc]))
        at += len(ids[doc]) + 1
    assert got == want
    written.unpersist()


def test_plain_files_open_ends_and_gaps(spark, tmp_path):
    streams = {"a": [5, 9, 6, 7, 9, 9, 8], "b": [9], "c": [], "d": [1, 2, 3]}
    for name, ids in streams.items():
        (tmp_path / f"{name}.bin").write_bytes(np.array(ids, dtype="<u2").tobytes())
    for block_bytes in (2, 4, 100):
        blocks = separators.file_blocks(spark, str(tmp_path), block_bytes)
        names = {r["file"]: r["name"][-5] for r in blocks.select("file", "name").distinct().collect()}
        got = {}
        for r in separators.token_counts(blocks, eod=9).orderBy("ordinal").collect():
            got.setdefault(names[r["file"]], []).append((r["ordinal"], r["start"], r["n_tokens"]))
        assert got == {"a": [(0, 0, 1), (1, 2, 2), (2, 5, 0), (3, 6, 1)], "b": [(0, 0, 0)], "d": [(0, 0, 3)]}
    empty = spark.createDataFrame([(1, 0, None), (1, 1, b"")], "file long, block long, body binary")
    assert separators.token_counts(empty).count() == 0
