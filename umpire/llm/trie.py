"""The prefix trie of rebuilt conversations as tables of slots.

* A prefix has a 128-bit digest: the sum, over its turns, of two 64-bit words mixed
  from the turn's SHA-256 and its depth.  Sums run along range partitions of
  (conversation, place), so one conversation may span many tasks.
* A shard (a block of whole conversations within a task) enumerates its distinct
  digests and gives each a slot by a minimal perfect hash; the digest kept in a slot
  verifies every lookup.  Rows are scattered into flat arrays by slot.  Shards' slots
  of one digest are merged by a combining aggregate, which also verifies that a digest
  stands for one parent, turn and depth; otherwise all is done again with another seed.
* A node is owned by its least conversation.  What a node adds to its subtree's sums
  (its saved code points; 1 for a childless node) is scattered at its owner's row alone,
  and each shard adds slots to their parents' slots, deepest first.  Every conversation
  adds to each of its prefixes once, so the shards' sums again merge by digest.
* A conversation longer than a shard is one path: its pieces carry running sums from
  piece to piece and, by one row per partition, from partition to partition.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from umpire.llm.text import U64, binary, mix, random_words
from umpire.operators.ordered import row_rank
from umpire.session import ensure_checkpoint_dir

SHARD = 1 << 19
HOT_PARENTS = 50_000
ID_BLOCK = 1 << 20
_MASK = (1 << 64) - 1


class Slots:
    """A minimal perfect hash of distinct 64-bit keys, level by level: a key that is
    alone at its place of a level is settled there, the others go on; a key's slot is
    the number of settled places before its own."""

    def __init__(self, keys: np.ndarray, check: np.ndarray):
        self.levels, left, base = [], keys, 0
        while len(left):
            size = 2 * len(left) + 1
            at = self._place(left, len(self.levels), size)
            alone = np.bincount(at, minlength=size) == 1
            self.levels.append((alone, base + np.cumsum(alone) - 1))
            base += int(alone.sum())
            left = left[~alone[at]]
        self.key, self.check = np.zeros(len(keys), dtype=U64), np.zeros(len(keys), dtype=U64)
        slot = self._slot(keys)
        self.key[slot], self.check[slot] = keys, check

    @staticmethod
    def _place(keys: np.ndarray, level: int, size: int) -> np.ndarray:
        return (mix(keys + random_words(7919 + level, 1)[0]) % U64(size)).astype(np.int64)

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        out = np.full(len(keys), -1, dtype=np.int64)
        open_ = np.arange(len(keys))
        for level, (alone, rank) in enumerate(self.levels):
            at = self._place(keys[open_], level, len(alone))
            out[open_[alone[at]]] = rank[at[alone[at]]]
            open_ = open_[~alone[at]]
        return out

    def find(self, keys: np.ndarray, check: np.ndarray) -> np.ndarray:
        """Slot of each digest, -1 where the table does not hold it."""
        slot = self._slot(keys)
        if len(self.key) == 0:
            return slot
        held = (slot >= 0) & (self.key[slot] == keys) & (self.check[slot] == check)
        return np.where(held, slot, -1)


def rebuilt(rows: DataFrame, conv_col: str, turn_col: str, role_col: str, text_col: str) -> tuple[DataFrame, DataFrame]:
    """Turns of the rebuilt conversations (conv_id, ord, sha, n), and per conversation
    (conv_id, turns).  Texts stay at the scan; only their hash and length go on."""
    role = F.coalesce(F.col(role_col).cast("string"), F.lit(""))
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    turns = rows.select(
        F.col(conv_col).cast("long").alias("conv_id"), F.col(turn_col).alias("turn"), role.alias("role"), F.substring(text, 1, 32).alias("opening"),
        F.unhex(F.sha2(F.concat(F.length(role).cast("string"), F.lit(":"), role, text).cast("binary"), 256)).alias("sha"),
        F.length(text).cast("long").alias("n")).filter("conv_id is not null")
    placed = row_rank(turns, ["turn", "role", "opening", "sha"], by=["conv_id"], name="place")
    taken = F.crc32(F.col("conv_id").cast("string").cast("binary")) % 6
    convs = placed.groupBy("conv_id").agg(F.count(F.lit(1)).alias("size")).withColumn("h", taken)
    first = (placed.filter("conv_id % 100 = 0 and place <= 5").groupBy(F.col("conv_id").alias("donor"))
             .agg(F.sort_array(F.collect_list(F.struct("place", "sha", "n"))).alias("first")))
    joined = convs.withColumn("donor", F.expr("conv_id - conv_id % 100")).join(first, "donor", "left")
    lead = F.expr("slice(coalesce(first, array()), 1, int(h))")
    convs = joined.select("conv_id", lead.alias("lead"), (F.size(lead) + F.greatest(F.col("size") - F.col("h"), F.lit(0))).cast("long").alias("turns")).checkpoint()
    own = placed.filter(F.col("place") > taken).select("conv_id", (F.col("place") + 5).alias("ord"), "sha", "n")
    given = convs.select("conv_id", F.explode("lead").alias("t")).select("conv_id", F.col("t.place").alias("ord"), "t.sha", "t.n")
    return own.unionByName(given), convs.select("conv_id", "turns")


def _ints(batch: pa.RecordBatch, name: str) -> np.ndarray:
    return batch.column(batch.schema.get_field_index(name)).to_numpy(zero_copy_only=False).astype(np.int64, copy=False)


def _walk(conv: np.ndarray, words: np.ndarray, seed: int, state):
    """Depth and digest of each turn of a sorted run of turns, after ``state``
    (conversation, depth, digest words) of the turn before; and the state after it."""
    n = len(conv)
    new = np.ones(n, dtype=bool)
    new[1:] = conv[1:] != conv[:-1]
    going = state is not None and conv[0] == state[0]
    head = np.maximum.accumulate(np.where(new, np.arange(n), 0))
    depth = np.arange(n) - head + 1
    if going:
        depth[head == 0] += state[1]
    digest = []
    with np.errstate(over="ignore"):
        for k, (a, b) in enumerate(((0, 1), (2, 3))):
            value = mix(words[:, a] + mix(words[:, b] + mix(depth.astype(U64) + random_words(seed * 2 + k, 1)[0])))
            total = np.cumsum(value, dtype=U64)
            total -= (total - value)[head]
            if going:
                total[head == 0] += U64(state[2 + k])
            digest.append(total)
    return depth, digest[0], digest[1], (int(conv[-1]), int(depth[-1]), int(digest[0][-1]), int(digest[1][-1]))


def _words(batch: pa.RecordBatch) -> np.ndarray:
    data, off = binary(batch.column(batch.schema.get_field_index("sha")))
    return data[off[0]:off[-1]].reshape(-1, 32).view("<u8").astype(U64)


def _starts(turns: DataFrame, seed: int) -> tuple[dict, dict]:
    """The state before each partition's first turn, and the conversation that the next
    partition goes on with.  Two passes: lengths give depths, depths give digests."""
    starts: dict = {}
    goes_on: dict = {}
    for pass_ in ("depth", "digest"):
        def ends(batches, starts=starts):
            pid = TaskContext.get().partitionId()
            state, first = starts.get(pid), None
            for batch in batches:
                if batch.num_rows:
                    conv = _ints(batch, "conv_id")
                    first = int(conv[0]) if first is None else first
                    state = _walk(conv, _words(batch), seed, state)[3]
            if first is not None:
                d0, d1 = np.array(state[2:], dtype=U64).view(np.int64).tolist()
                yield pa.RecordBatch.from_pydict({"pid": [pid], "first": [first], "last": [state[0]], "depth": [state[1]], "d0": [d0], "d1": [d1]})

        found = sorted(turns.mapInArrow(ends, "pid long, first long, last long, depth long, d0 long, d1 long").collect())
        after, held = {}, None  # held: the state at the end of the partition before
        for at, r in enumerate(found):
            own = [r["last"], r["depth"], r["d0"] & _MASK, r["d1"] & _MASK]
            if held is not None and held[0] == r["first"]:
                after[r["pid"]] = tuple(held)
                goes_on[found[at - 1]["pid"]] = r["first"]
                if r["first"] == r["last"] and pass_ == "depth":  # its length so far was not known to the task
                    own[1] += held[1]
                elif r["first"] == r["last"]:
                    own[2:] = [(held[2] + own[2]) & _MASK, (held[3] + own[3]) & _MASK]
            held = own
        starts = after if pass_ == "digest" else {pid: (s[0], s[1], 0, 0) for pid, s in after.items()}
    return starts, goes_on


def _as_long(a: np.ndarray) -> pa.Array:
    return pa.array(a.view(np.int64) if a.dtype == U64 else a, pa.int64())


def _binary32(words: np.ndarray) -> pa.Array:
    ends = np.arange(len(words) + 1, dtype=np.int32) * 32
    return pa.BinaryArray.from_buffers(pa.binary(), len(words), [None, pa.py_buffer(ends), pa.py_buffer(np.ascontiguousarray(words))])


def _count_slots(conv, depth, d0, d1, p0, p1, sha, n) -> pa.RecordBatch:
    """One row per distinct digest of a shard: how many conversations hold it, the least
    of them, its parent, turn and depth, and whether all rows agreed on these."""
    keys, at = np.unique(d0, return_index=True)
    table = Slots(keys, d1[at])
    slot = table.find(d0, d1)
    some = np.zeros(len(keys), dtype=np.int64)
    some[table.find(keys, d1[at])] = at  # a row of each slot
    bad = slot < 0  # two digests that share their first word
    slot = np.where(bad, 0, slot)
    ref = some[slot]
    bad |= (p0 != p0[ref]) | (p1 != p1[ref]) | (depth != depth[ref]) | (sha != sha[ref]).any(axis=1)
    count = np.bincount(slot, minlength=len(keys))
    least = np.full(len(keys), np.iinfo(np.int64).max)
    np.minimum.at(least, slot, conv)
    wrong = np.zeros(len(keys), dtype=bool)
    np.logical_or.at(wrong, slot, bad)
    return pa.RecordBatch.from_arrays(
        [_as_long(table.key), _as_long(table.check), _as_long(p0[some]), _as_long(p1[some]), _binary32(sha[some]),
         _as_long(depth[some]), _as_long(n[some]), _as_long(count), _as_long(least), pa.array(wrong)],
        ["d0", "d1", "p0", "p1", "sha", "depth", "n", "n_convs", "conv_id", "wrong"])


_NODE = "d0 long, d1 long, p0 long, p1 long, sha binary, depth long, n long, n_convs long, conv_id long, wrong boolean"


def _digested(turns: DataFrame, seed: int) -> DataFrame:
    """(conv_id, depth, d0, d1, last) of every turn; ``last`` ends its conversation."""
    starts, goes_on = _starts(turns, seed)

    def run(batches):
        pid = TaskContext.get().partitionId()
        state, held = starts.get(pid), None
        for batch in batches:
            if batch.num_rows == 0:
                continue
            conv = _ints(batch, "conv_id")
            before = state
            depth, d0, d1, state = _walk(conv, _words(batch), seed, state)
            if held is not None:
                yield _turn_rows(*held, bool(held[0][-1] != conv[0]))
            held = (conv, depth, d0, d1, batch, before)
        if held is not None:
            yield _turn_rows(*held, bool(held[0][-1] != goes_on.get(pid)))

    return turns.mapInArrow(run, "conv_id long, depth long, d0 long, d1 long, p0 long, p1 long, sha binary, n long, last boolean")


def _turn_rows(conv, depth, d0, d1, batch, before, ended) -> pa.RecordBatch:
    last = np.ones(len(conv), dtype=bool)
    last[:-1] = conv[1:] != conv[:-1]
    last[-1] = ended
    p0, p1 = np.zeros(len(conv), dtype=U64), np.zeros(len(conv), dtype=U64)
    inside = depth > 1
    p0[1:], p1[1:] = np.where(inside[1:], d0[:-1], U64(0)), np.where(inside[1:], d1[:-1], U64(0))
    if inside[0]:
        p0[0], p1[0] = U64(before[2]), U64(before[3])
    return pa.RecordBatch.from_arrays(
        [_as_long(conv), _as_long(depth), _as_long(d0), _as_long(d1), _as_long(p0), _as_long(p1),
         batch.column(batch.schema.get_field_index("sha")), _as_long(_ints(batch, "n")), pa.array(last)],
        ["conv_id", "depth", "d0", "d1", "p0", "p1", "sha", "n", "last"])


def _shards(batches, size: int):
    """Blocks of about ``size`` rows that hold whole conversations or a piece of one.

    Yields (block, piece): ``piece`` is true where the block's one conversation may go on
    in another block or partition.  The first and last conversation of a partition are
    pieces, since they may come from or go on elsewhere."""
    held: list[pa.RecordBatch] = []
    rows, first = 0, True

    def cut(last: bool):
        nonlocal held, rows, first
        block = pa.Table.from_batches(held).combine_chunks()
        conv = block.column("conv_id").to_numpy()
        lo, hi = 0, len(conv)
        tail = int(np.searchsorted(conv, conv[-1]))
        if first:
            lo = int(np.searchsorted(conv, conv[0], side="right"))
            yield block.slice(0, lo), True
            first = tail == 0 and not last  # the first conversation goes on
        if tail < lo:
            held, rows = [], 0
            return
        if tail > lo:
            yield block.slice(lo, tail - lo), False
        if last or hi - tail >= size:
            yield block.slice(tail, hi - tail), True
            first = not last
            held, rows = [], 0
        else:
            held, rows = block.slice(tail, hi - tail).to_batches(), hi - tail

    for batch in batches:
        if batch.num_rows:
            held.append(batch)
            rows += batch.num_rows
            if rows >= size:
                yield from cut(False)
    if rows:
        yield from cut(True)


def nodes_of(turns: DataFrame, seed: int, shard: int = SHARD) -> tuple[DataFrame, DataFrame]:
    """(digested turns, nodes by digest).  An error if two prefixes share a digest."""
    digested = _digested(turns, seed).checkpoint()

    def run(batches):
        held, rows = [], 0
        for batch in batches:
            held.append(batch)
            rows += batch.num_rows
            if rows >= shard:
                yield count(held)
                held, rows = [], 0
        if rows:
            yield count(held)

    def count(held):
        block = pa.Table.from_batches(held).combine_chunks().to_batches()[0]
        conv, depth, n = (_ints(block, c) for c in ("conv_id", "depth", "n"))
        d0, d1, p0, p1 = (_ints(block, c).view(U64) for c in ("d0", "d1", "p0", "p1"))
        return _count_slots(conv, depth, d0, d1, p0, p1, _words(block), n)

    same = F.struct("d1", "p0", "p1", "sha", "depth", "n")  # the first word names a node, all else must agree
    merged = (digested.select("conv_id", "depth", "d0", "d1", "p0", "p1", "sha", "n").mapInArrow(run, _NODE)
              .groupBy("d0").agg(F.min(same).alias("one"), F.max(same).alias("other"), F.sum("n_convs").alias("n_convs"),
                                       F.min("conv_id").alias("conv_id"), F.max("wrong").alias("wrong")))
    nodes = merged.select("d0", "one.d1", "one.p0", "one.p1", "one.depth", "one.n", "n_convs", "conv_id",
                          (F.col("wrong") | (F.col("one") != F.col("other"))).alias("wrong")).checkpoint()
    if not nodes.filter("wrong").isEmpty():
        raise DigestClash(f"two prefixes share a digest under seed {seed}")
    children = nodes.groupBy(F.col("p0").alias("d0"), F.col("p1").alias("d1")).agg(F.count(F.lit(1)).alias("n_children"))
    nodes = nodes.drop("wrong").join(children, ["d0", "d1"], "left").fillna(0, ["n_children"]).checkpoint()
    return digested, nodes


class DigestClash(Exception):
    pass


def _path_sums(block: pa.Table, state):
    """Sums along a piece of one conversation, deepest turn first, after ``state``
    (conversation, leaves, saved)."""
    conv = block.column("conv_id").to_numpy()
    leaves, saved = np.cumsum(block.column("leaf").to_numpy()), np.cumsum(block.column("saved").to_numpy())
    if state is not None and state[0] == conv[0]:
        leaves, saved = leaves + state[1], saved + state[2]
    return leaves, saved, (int(conv[0]), int(leaves[-1]), int(saved[-1]))


def _tree_sums(block: pa.Table):
    """Sums of a shard of whole conversations: (row of each slot, leaves, saved)."""
    depth = block.column("depth").to_numpy()
    d0, d1, p0, p1 = (block.column(c).to_numpy().view(U64) for c in ("d0", "d1", "p0", "p1"))
    keys, at = np.unique(d0, return_index=True)
    table = Slots(keys, d1[at])
    slot = table.find(d0, d1)
    some = np.zeros(len(keys), dtype=np.int64)
    some[slot] = np.arange(len(slot))
    leaves, saved = np.zeros(len(keys), dtype=np.int64), np.zeros(len(keys), dtype=np.int64)
    np.add.at(leaves, slot, block.column("leaf").to_numpy())
    np.add.at(saved, slot, block.column("saved").to_numpy())
    parent = table.find(p0[some], p1[some])
    level = depth[some]
    order = np.argsort(-level, kind="stable")
    cuts = np.flatnonzero(np.diff(level[order])) + 1
    for part in np.split(order, cuts):  # from the deepest level up
        part = part[parent[part] >= 0]
        np.add.at(leaves, parent[part], leaves[part])
        np.add.at(saved, parent[part], saved[part])
    return some, leaves, saved


def subtree_sums(digested: DataFrame, nodes: DataFrame, shard: int = SHARD) -> DataFrame:
    """(d0, d1, n_leaves, saved) of every node that several conversations share."""
    rows = digested.select("conv_id", "depth", "d0", "d1", "p0", "p1", F.lit(0).cast("long").alias("leaf"), F.lit(0).cast("long").alias("saved"), F.lit(0).alias("kind"))
    owned = nodes.select("conv_id", "depth", "d0", "d1", "p0", "p1", (F.col("n_children") == 0).cast("long").alias("leaf"),
                         ((F.col("n_convs") - 1) * F.col("n")).alias("saved"), F.when(F.col("n_convs") == 1, 2).otherwise(1).alias("kind"))
    ranged = (rows.unionByName(owned).withColumn("up", -F.col("depth")).repartitionByRange("conv_id", "up")
              .sortWithinPartitions("conv_id", "up", F.col("kind").desc()).drop("up").checkpoint())

    def pieces(batches):
        state, firsts = None, {}
        pid = TaskContext.get().partitionId()
        for block, piece in _shards(batches, shard):
            if piece:
                conv = int(block.column("conv_id")[0].as_py())
                was = firsts.get(conv, (0, 0))
                firsts[conv] = (was[0] + int(block.column("leaf").to_numpy().sum()), was[1] + int(block.column("saved").to_numpy().sum()))
                if len(firsts) > 2:  # a middle conversation that outgrew a shard
                    firsts.pop(list(firsts)[1])
        for at, (conv, (leaf, saved)) in enumerate(firsts.items()):
            yield pa.RecordBatch.from_arrays([pa.array([pid]), pa.array([at]), pa.array([conv]), pa.array([leaf]), pa.array([saved])],
                                             ["pid", "at", "conv_id", "leaf", "saved"])

    carried, held = {}, None
    for r in sorted(ranged.mapInArrow(pieces, "pid long, at long, conv_id long, leaf long, saved long").collect()):
        if held is not None and held[0] == r["conv_id"]:
            carried[r["pid"]] = tuple(held)
            held = [r["conv_id"], held[1] + r["leaf"], held[2] + r["saved"]]
        else:
            held = [r["conv_id"], r["leaf"], r["saved"]]

    def run(batches):
        state = carried.get(TaskContext.get().partitionId())
        for block, piece in _shards(batches, shard):
            if piece:
                leaves, saved, state = _path_sums(block, state)
                some = np.arange(block.num_rows)
                # a turn's row is the last of its place: it follows the node's own row
                some = some[block.column("kind").to_numpy() == 0]
                leaves, saved = leaves[some], saved[some]
            else:
                some, leaves, saved = _tree_sums(block)
            d0, d1 = (block.column(c).to_numpy() for c in ("d0", "d1"))
            alone = np.unique(d0[block.column("kind").to_numpy() == 2])
            shared = ~np.isin(d0[some], alone)
            some, leaves, saved = some[shared], leaves[shared], saved[shared]
            yield pa.RecordBatch.from_arrays([_as_long(d0[some]), _as_long(d1[some]), _as_long(leaves), _as_long(saved)], ["d0", "d1", "n_leaves", "saved"])

    return ranged.mapInArrow(run, "d0 long, d1 long, n_leaves long, saved long").groupBy("d0", "d1").agg(
        F.sum("n_leaves").alias("n_leaves"), F.sum("saved").alias("saved"))


def end_hashes(ends: DataFrame) -> DataFrame:
    """(d0, d1, ends_sha256) of (d0, d1, conv_id): SHA-256 of the ids in numeric order,
    joined by commas.  Range partitions write the ids as blocks of text; one digest's
    blocks, of a million bytes each, then stream through one hash in order."""
    ranged = ends.repartitionByRange("d0", "d1", "conv_id").sortWithinPartitions("d0", "d1", "conv_id")

    def blocks(batches):
        out, size = [], 0  # rows [d0, d1, first id, ids]; a row of another partition may go on with its ids
        for batch in batches:
            for d0, d1, conv in zip(*(c.to_pylist() for c in batch.columns)):
                if not out or out[-1][:2] != [d0, d1] or size >= ID_BLOCK:
                    if len(out) >= 4096 or size >= ID_BLOCK:
                        yield block_rows(out)
                        out = []
                    out.append([d0, d1, conv, []])
                    size = 0
                out[-1][3].append(str(conv))
                size += len(out[-1][3][-1]) + 1
        if out:
            yield block_rows(out)

    def block_rows(out):
        d0, d1, first, ids = zip(*out)
        return pa.RecordBatch.from_arrays([pa.array(d0, pa.int64()), pa.array(d1, pa.int64()), pa.array(first, pa.int64()),
                                           pa.array([",".join(i).encode() for i in ids], pa.binary())], ["d0", "d1", "first", "ids"])

    dealt = (ranged.mapInArrow(blocks, "d0 long, d1 long, first long, ids binary")
             .repartition("d0", "d1").sortWithinPartitions("d0", "d1", "first"))

    def hashes(batches):
        key, state = None, None
        for batch in batches:
            out = []
            for d0, d1, ids in zip(*(batch.column(i).to_pylist() for i in (0, 1, 3))):
                if (d0, d1) != key:
                    if key is not None:
                        out.append((*key, state.hexdigest()))
                    key, state = (d0, d1), hashlib.sha256(ids)
                else:
                    state.update(b"," + ids)
            if out:
                yield _hash_rows(out)
        if key is not None:
            yield _hash_rows([(*key, state.hexdigest())])

    return dealt.mapInArrow(hashes, "d0 long, d1 long, ends_sha256 string")


def _hash_rows(out) -> pa.RecordBatch:
    a, b, c = zip(*out)
    return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64()), pa.array(c, pa.string())], ["d0", "d1", "ends_sha256"])


def prefix_trie(conversations: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
                text_col: str = "text", shard: int = SHARD, partitions: int | None = None) -> DataFrame:
    """One row per node: (conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves,
    saved_tokens, ends_sha256).

    Turns of one place are ordered by role, the text's first 32 code points and a hash.
    A null conversation id belongs to no conversation; those rows take no part.  No
    conversations give no nodes.  Other columns are dropped, whatever their names."""
    spark = conversations.sparkSession
    ensure_checkpoint_dir(spark)
    turns, convs = rebuilt(conversations, conv_col, turn_col, role_col, text_col)
    turns = turns.repartitionByRange(*([partitions] if partitions else []), "conv_id", "ord").sortWithinPartitions("conv_id", "ord").checkpoint()
    for seed in range(1, 9):
        try:
            digested, nodes = nodes_of(turns, seed, shard)
            break
        except DigestClash:
            continue
    else:
        raise DigestClash("prefixes share digests under eight seeds")
    key = ["d0", "d1"]
    ends = digested.filter("last").select(*key, "conv_id")
    empty = convs.filter("turns = 0").select(F.lit(0).cast("long").alias("d0"), F.lit(0).cast("long").alias("d1"), "conv_id")
    hashes = end_hashes(ends.unionByName(empty)).checkpoint()
    none = hashlib.sha256(b"").hexdigest()
    whole = nodes.join(subtree_sums(digested, nodes, shard), key, "left").join(hashes, key, "left").select(
        *key, "p0", "p1", "conv_id", "depth", "n_convs", "n_children", F.coalesce("n_leaves", F.lit(1)).cast("long").alias("n_leaves"),
        F.coalesce("saved", F.lit(0)).cast("long").alias("saved_tokens"), F.coalesce("ends_sha256", F.lit(none)).alias("ends_sha256")).checkpoint()

    least = convs.agg(F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("n_convs")).first()
    sums = whole.filter("depth = 1").agg(F.count(F.lit(1)), F.sum("n_leaves"), F.sum("saved_tokens")).first()
    idle = hashes.filter("d0 = 0 and d1 = 0").first()
    out = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    root = spark.createDataFrame(
        [(least["conv_id"], 0, None, least["n_convs"], sums[0], sums[1] or 1, sums[2] or 0, idle["ends_sha256"] if idle else none)]
        if least["n_convs"] else [], ", ".join(f"{c} {'string' if c == 'ends_sha256' else 'long'}" for c in out))

    below = whole.filter("depth > 1").drop(*key)
    first = whole.filter("depth = 1").withColumn("parent_conv_id", F.lit(least["conv_id"]).cast("long"))
    named = whole.select(F.col("d0").alias("p0"), F.col("d1").alias("p1"), F.col("conv_id").alias("parent_conv_id"), "n_children")
    # at most HOT_PARENTS nodes can have more than this share of all nodes as children
    share = max(1000, whole.count() // HOT_PARENTS)
    hot = F.broadcast(named.filter(F.col("n_children") > share).drop("n_children"))
    found = (below.join(hot, ["p0", "p1"]).select(*out)
             .unionByName(below.join(hot.select("p0", "p1"), ["p0", "p1"], "left_anti").join(named.drop("n_children"), ["p0", "p1"]).select(*out)))
    return root.unionByName(first.select(*out)).unionByName(found)
