"""Packing: documents into sequences of a few power-of-two lengths.

Documents are routed to context-size tiers.  Every full ``longest`` ids of a
document are a sequence of their own in the top tier; the remainder belongs to
the tier of the next power of two.  Every tier has a pool and windows of its own
length, the long ones packed first: a window is opened by the largest piece of
its tier, and its gap, less than half of it, is filled with the largest pieces of
the shorter tiers that fit; the last gap is filled exactly by cutting a piece of
the shortest tier, whose rest goes to the tier of its length.  What is left at
the end of a partition and fills no window is cut into sequences whose lengths
are powers of two, so no sequence needs padding.  Sequences are dealt to step
groups so that the groups of a partition differ by one full window at most; the
group that comes first turns with the partition's number.

Every task packs its own partition of the input in one pass: nothing is
shuffled, and memory holds the pools of remainders (``pool_ids`` ids in all).
Sequence ids are the partition's number and a counter.
"""

from __future__ import annotations

import bisect
import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from umpire.llm import tokens

SCHEMA = ("doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, "
          "offset long, tier long, step_group long")
EOD = 1


class _Pool:
    """Remainders by tier, each in order of length: (length, number, doc, start,
    ids, doc length).  Tier t holds lengths from 2 ** t / 2, exclusive, to 2 ** t."""

    def __init__(self, longest: int):
        self.tiers: list[list[tuple]] = [[] for _ in range(longest.bit_length())]
        self.total, self.number = 0, 0

    def add(self, doc, start, ids, doc_tokens):
        n = len(ids) // 4
        self.number += 1
        bisect.insort(self.tiers[(n - 1).bit_length()], (n, self.number, doc, start, ids, doc_tokens), key=lambda x: x[:2])
        self.total += n

    def take(self, tier: int, i: int) -> tuple:
        item = self.tiers[tier].pop(i)
        self.total -= item[0]
        return item

    def fitting(self, gap: int) -> tuple[int, int] | None:
        """Tier and index of the largest item that fits the gap."""
        for t in range((gap - 1).bit_length(), -1, -1):
            if (i := bisect.bisect_right(self.tiers[t], gap, key=lambda x: x[0])) > 0:
                return t, i - 1
        return None

    def shortest(self) -> tuple[int, int]:
        return next(t for t, items in enumerate(self.tiers) if items), 0


def _window(pool: _Pool, size: int) -> list[tuple]:
    """Pieces (doc, start, ids, doc length) that fill ``size`` ids exactly."""
    pieces, gap = [], size
    while gap:
        if at := pool.fitting(gap):
            n, _, doc, start, ids, total = pool.take(*at)
        else:  # nothing fits: cut the shortest
            _, _, doc, start, ids, total = pool.take(*pool.shortest())
            n = gap
            pool.add(doc, start + n, ids[4 * n:], total)
            ids = ids[:4 * n]
        pieces.append((doc, start, ids, total))
        gap -= n
    return pieces


def pack_stream(documents, longest: int, pool_ids: int, groups: int, first_id: int):
    """Rows of pieces, list by list, for an iterable of (doc, id bytes)."""
    pool, load, sequence, turn = _Pool(longest), [0] * groups, first_id, first_id >> 32

    def close(pieces, size):
        nonlocal sequence
        group = min(range(groups), key=load.__getitem__)
        load[group] += size
        at, rows = 0, []
        for doc, start, ids, total in pieces:
            n = len(ids) // 4
            rows.append((doc, start, n, zlib.crc32(ids), total, sequence, at, size, (group + turn) % groups))
            at += n
        sequence += 1
        return rows

    def windows(least):
        """Windows of every tier, long ones first, while the pools hold ``least`` ids."""
        rows = []
        for t in range(len(pool.tiers) - 1, -1, -1):
            while pool.tiers[t] and pool.total >= max(least, 1 << t):
                rows += close(_window(pool, 1 << t), 1 << t)
        return rows

    for doc, ids in documents:
        total = len(ids) // 4
        cut = total - total % longest
        rows = []
        for start in range(0, cut, longest):
            rows += close([(doc, start, ids[4 * start:4 * (start + longest)], total)], longest)
        if cut < total:
            pool.add(doc, cut, ids[4 * cut:], total)
        if pool.total >= pool_ids:
            rows += windows(pool_ids // 2)
        if rows:
            yield rows
    rows, size = windows(0), longest
    while pool.total:
        while size > pool.total:
            size //= 2
        rows += close(_window(pool, size), size)
    if rows:
        yield rows


def pack(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", longest: int = 2048,
         tokenizer: str | None = None, eod: int = EOD, pool_ids: int = 1 << 20, groups: int = 8) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens,
    sequence_id, offset, tier (the sequence's length) and step_group.

    A document is its text's ids and ``eod``; a null or empty text is ``eod``
    alone.  Every id lies in exactly one piece, offsets in a sequence are
    gapless from 0, and every sequence is exactly ``longest`` or a lesser power
    of two long.  ``longest`` must be a power of two.  Rows with a null or a
    repeated id are packed like any other.  Extra columns are ignored.
    """
    if longest & (longest - 1):
        raise ValueError("longest must be a power of two")
    path = tokenizer or tokens.default_path()
    end = np.array([eod], dtype="<u4").tobytes()

    def run(batches):
        code = tokens.coder(path)

        def documents():
            for batch in batches:
                for lo in range(0, batch.num_rows, 256):
                    part = batch.slice(lo, 256)
                    for doc, text in zip(part.column(0).to_pylist(), part.column(1).to_pylist()):
                        yield doc, code.ids(text).tobytes() + end

        first = TaskContext.get().partitionId() << 32
        names = [c.split()[0] for c in SCHEMA.split(", ")]
        buffer: list[tuple] = []
        for rows in pack_stream(documents(), longest, pool_ids, groups, first):
            buffer += rows
            if len(buffer) >= 8192:
                yield _batch(buffer, names)
                buffer = []
        if buffer:
            yield _batch(buffer, names)

    return docs.select(F.col(id_col).cast("long"), F.col(text_col).cast("string")).mapInArrow(run, SCHEMA)


def _batch(rows, names):
    return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows)], names=names)
