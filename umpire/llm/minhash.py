"""Near-duplicate classes by an LSH forest of MinHash signatures.

1. Every text becomes its set of distinct word shingles (64-bit hashes) and a
   MinHash signature, one pass over whole texts.  Texts with equal sets are one
   class (size and two set hashes); one representative stands for it, so copies
   are never paired.
2. The signature is cut into ``trees`` sequences of ``depth`` hashes.  All
   sequences of a tree are sorted (range partitions, so a hot region spreads
   over tasks).  A walk down each sorted order pairs a text with its nearest
   neighbours whose longest common prefix is at least ``least`` hashes.  Since
   the order is by prefix, a crowded region offers its neighbours of the
   deepest common prefix first and a sparse one those of the least depth: the
   depth adapts by region.  Neighbours across a partition's edge meet in a
   second, small pass over ``window`` rows from both sides of each edge.
3. Candidates are confirmed on full shingle sets in three rounds: twice each
   text's best candidate (by total common prefix) that lies in another component
   so far, then all that still cross two components.  Every candidate is thus
   confirmed, refuted, or already inside one component, and hot groups cost a few
   checks per text.  In the last round the pairs of crowded regions are left to
   step 4, which covers them.
4. A region with more rows than the window is crowded.  Where its texts still
   lie in several components, all pairs across them are checked in blocks, so
   the window loses nothing (``complete_regions``).

Nothing of the corpus reaches the driver but counts.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from umpire.llm import text as X
from umpire.llm.graph import components, counted, sized
from umpire.session import ensure_checkpoint_dir

U64 = np.uint64


def shingle_set(words: np.ndarray, k: int) -> np.ndarray:
    """Sorted distinct shingle hashes of one text's word hashes."""
    if len(words) == 0:
        return words
    if len(words) < k:
        return X.runs_of(words, len(words))
    return np.unique(X.runs_of(words, k))


def _sets(column: pa.Array, k: int, hasher: X.SpanHasher):
    """Shingle sets of a batch, text by text."""
    for _, _, data, off in X.groups(column):
        starts, ends = X.word_spans(data, off)
        words = hasher.spans(data, starts, ends)
        cut = X.per_text(starts, off)
        for i in range(len(off) - 1):
            yield shingle_set(words[cut[i]:cut[i + 1]], k)


def _signature(s: np.ndarray, a: np.ndarray, b: np.ndarray) -> bytes:
    low = np.full(len(a), ~U64(0), dtype=U64)
    for i in range(0, len(s), 256):
        low = np.minimum(low, (s[i:i + 256, None] * a + b).min(axis=0))
    return (low >> U64(32)).astype(">u4").tobytes()


def features(docs: DataFrame, id_col: str, text_col: str, k: int, hashes: int) -> DataFrame:
    """(doc_id, n, f1, f2, sig): set size, two hashes of the set, signature."""
    def run(batches):
        hasher = X.SpanHasher(11, fold=True)
        rnd = X.random_words(29, 2 * hashes)
        a, b = rnd[:hashes] | U64(1), rnd[hashes:]
        for batch in batches:
            n, f1, f2, sig = [], [], [], []
            with np.errstate(over="ignore"):
                for s in _sets(batch.column(1), k, hasher):
                    n.append(len(s))
                    f1.append(s.sum(dtype=U64).astype(np.int64))
                    f2.append(X.mix(s ^ U64(0xA5A5A5A5A5A5A5A5)).sum(dtype=U64).astype(np.int64))
                    sig.append(_signature(s, a, b) if len(s) else None)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n, pa.int64()), pa.array(f1, pa.int64()), pa.array(f2, pa.int64()),
                 pa.array(sig, pa.binary())], names=["doc_id", "n", "f1", "f2", "sig"])

    return (docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
            .mapInArrow(run, "doc_id long, n long, f1 long, f2 long, sig binary"))


def _neighbours(tree, key, ids, size, window, least, num, den, fresh):
    """Pairs within ``window`` rows of a sorted order, with common prefix at
    least ``least`` and set sizes that allow the similarity; a pair needs its
    later row at or after index ``fresh``.  Also one row of every region that
    holds rows further apart than the window."""
    out, full = [], np.zeros(0, np.int64)
    for j in range(1, window + 2):
        if len(ids) <= j:
            break
        lo = max(fresh - j, 0)
        same = (tree[lo + j:] == tree[lo:-j]) & (key[lo + j:, :least] == key[lo:-j, :least]).all(axis=1)
        hit = np.flatnonzero(same) + lo
        if len(hit) == 0:
            break
        if j > window:
            full = hit[np.r_[True, (tree[hit[1:]] != tree[hit[:-1]]) | (key[hit[1:], :least] != key[hit[:-1], :least]).any(axis=1)]]
            break
        small, large = np.minimum(size[hit], size[hit + j]), np.maximum(size[hit], size[hit + j])
        hit = hit[(small * den >= large * num) & (ids[hit] != ids[hit + j])]
        eq = key[hit] == key[hit + j]
        lcp = np.where(eq.all(axis=1), key.shape[1], np.argmin(eq, axis=1))
        out.append((np.minimum(ids[hit], ids[hit + j]), np.maximum(ids[hit], ids[hit + j]), lcp, hit))
    none = [(np.zeros(0, np.int64),) * 4]
    return (*(np.concatenate(x) for x in zip(*(out or none))), full)


def _unpack(batch, depth):
    tree = batch.column(0).to_numpy(zero_copy_only=False)
    data, off = X.binary(batch.column(1))
    key = data[off[0]:off[-1]].view(">u4").reshape(-1, depth)
    return tree, key, batch.column(2).to_numpy(zero_copy_only=False), batch.column(3).to_numpy(zero_copy_only=False)


def tree_rows(feats: DataFrame, trees: int, depth: int) -> DataFrame:
    """(tree, key, doc_id, n): each text's sequence in every tree."""
    width = 4 * depth
    return (feats.select(F.explode(F.sequence(F.lit(0), F.lit(trees - 1))).alias("tree"), "doc_id", "n", "sig")
            .select("tree", F.substring("sig", F.col("tree") * width + 1, F.lit(width)).alias("key"), "doc_id", "n"))


def candidates(rows: DataFrame, depth: int, least: int, window: int, num: int, den: int) -> tuple[DataFrame, DataFrame]:
    """(a, b, score, crowded) with a < b: neighbours in the sorted orders of the
    trees; the score is the total common prefix over the trees that offer the
    pair, and it is crowded if one of its regions is.
    And (tree, prefix): the regions that hold rows further apart than ``window``."""
    order = ["tree", "key", "doc_id"]
    sorted_rows = rows.repartitionByRange(*order).sortWithinPartitions(*order)

    def walk(batches):
        pid = TaskContext.get().partitionId()
        tail, head, row = None, [], 0

        def emit(kind, a, b, score, tree, key, n):
            return pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(a), kind, np.int32)), pa.array(a), pa.array(b), pa.array(score.astype(np.int64)),
                 pa.array(np.full(len(a), pid, np.int32)), tree, key, n],
                names=["kind", "a", "b", "score", "pid", "tree", "key", "n"])

        def edge(kind, batch, first):
            m = batch.num_rows
            return emit(kind, batch.column(2).to_numpy(zero_copy_only=False).astype(np.int64), np.zeros(m, np.int64),
                        np.arange(first, first + m), batch.column(0).cast(pa.int32()), batch.column(1), batch.column(3))

        for batch in batches:
            if batch.num_rows == 0:
                continue
            seen = tail.num_rows if tail is not None else 0
            both = batch if tail is None else pa.Table.from_batches([tail, batch]).combine_chunks().to_batches()[0]
            a, b, score, at, full = _neighbours(*_unpack(both, depth), window, least, num, den, seen)
            if len(full):
                yield edge(3, both.take(pa.array(full)), 0)
            if len(a):
                of = both.take(pa.array(at))
                yield emit(0, a, b, score, of.column(0).cast(pa.int32()), of.column(1), of.column(3))
            if row <= window:
                yield edge(1, batch.slice(0, window + 1 - row), row)
            row += batch.num_rows
            tail = both.slice(max(0, both.num_rows - window - 1))
        if tail is not None:
            yield edge(2, tail, row - tail.num_rows)

    found = sorted_rows.mapInArrow(
        walk, "kind int, a long, b long, score long, pid int, tree int, key binary, n long").checkpoint()
    edges = sized(found.filter("kind in (1, 2)"))
    following = (edges.select("pid").distinct()
                 .select("pid", F.lead("pid").over(Window.orderBy("pid")).alias("next")).filter("next is not null"))
    meeting = (edges.filter("kind = 2").join(following, "pid").withColumn("edge", F.col("next"))
               .unionByName(edges.filter("kind = 1").withColumn("edge", F.col("pid")), allowMissingColumns=True)
               .select(F.col("tree"), F.col("key"), F.col("a").alias("doc_id"), "n", "kind", "score", "edge"))

    def across(table: pa.Table) -> pa.Table:
        order_by = [("kind", "descending"), ("score", "ascending")]
        table = table.sort_by(order_by).combine_chunks()
        batch = table.select(["tree", "key", "doc_id", "n"]).to_batches()[0]
        fresh = int((table.column("kind").to_numpy() == 2).sum())
        a, b, score, at, full = _neighbours(*_unpack(batch, depth), window, least, num, den, fresh)
        rows, none = batch.take(pa.array(np.r_[at, full])), np.full(len(full), -1)
        return pa.table({
            "kind": pa.array(np.r_[np.zeros(len(a)), np.full(len(full), 3)].astype(np.int32)),
            "a": pa.array(np.r_[a, none].astype(np.int64)), "b": pa.array(np.r_[b, none].astype(np.int64)),
            "score": pa.array(np.r_[score, none].astype(np.int64)),
            "tree": rows.column(0).cast(pa.int32()), "key": rows.column(1).cast(pa.binary())})

    stitched = meeting.groupBy("edge").applyInArrow(
        across, "kind int, a long, b long, score long, tree int, key binary")
    stitched = sized(stitched)
    every = (found.filter("kind in (0, 3)").select(*stitched.columns).unionByName(stitched)
             .withColumn("prefix", F.substring("key", 1, 4 * least)))
    regions = sized(every.filter("kind = 3").select("tree", "prefix").distinct())
    pairs = (every.filter("kind = 0").join(counted(regions).withColumn("crowd", F.lit(True)), ["tree", "prefix"], "left")
             .groupBy("a", "b").agg(F.sum("score").alias("score"),
                                    F.max(F.coalesce("crowd", F.lit(False))).alias("crowded")))
    return pairs, regions


def complete_regions(members: DataFrame, comp: DataFrame, sets: DataFrame, num: int, den: int,
                     block: int = 200_000, few: bool = False) -> DataFrame:
    """(a, b): links inside crowded regions that no window offered.

    In a region (tree, prefix) whose texts lie in several components so far,
    every text outside the region's largest component meets all others of other
    components, on full sets.  Members and outsiders are dealt into blocks of
    about ``block`` shingles, and a pair of blocks is one task's group, so no
    region has to fit a task, and an outsider's surest link to each component
    is all that is listed.  Blocks hold 32-bit hashes, which can only add
    links; the caller confirms on full sets.  With ``few`` regions (counted) their
    tables are broadcast, so that the rows of a large one stay where they are.
    """
    region = ["tree", "prefix"]
    small = F.broadcast if few else (lambda t: t)
    inside = (members.join(comp.select(F.col("node").alias("doc_id"), "root"), "doc_id", "left")
              .select(*region, "doc_id", "n", F.coalesce("root", "doc_id").alias("comp")))
    parts = inside.groupBy(*region, "comp").agg(F.count(F.lit(1)).alias("texts"), F.sum("n").alias("words"))
    mixed = (parts.groupBy(*region).agg(F.max(F.struct("texts", "comp")).alias("main"), F.count(F.lit(1)).alias("parts"),
                                        F.sum("words").alias("words"))
             .filter("parts > 1").select(*region, F.col("main.comp").alias("main"), "words"))
    outside = (parts.join(small(mixed.select(*region, "main")), region).filter("comp != main")
               .groupBy(*region).agg(F.sum("words").alias("others")))
    mixed = (mixed.join(outside, region)
             .select(*region, "main", F.ceil(F.col("words") / block).cast("int").alias("nm"),
                     F.ceil(F.col("others") / block).cast("int").alias("no")))
    rows = inside.join(small(mixed), region).withColumn("deal", F.pmod(F.xxhash64("doc_id"), F.lit(1 << 40)))
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    as_member = rows.select(*region, "doc_id", "comp", F.lit(False).alias("out"), (F.col("deal") % F.col("nm")).cast("int").alias("mb"),
                            every("no").alias("ob"))
    as_other = (rows.filter("comp != main")
                .select(*region, "doc_id", "comp", F.lit(True).alias("out"), every("nm").alias("mb"),
                        (F.col("deal") % F.col("no")).cast("int").alias("ob"))
                .select(*as_member.columns))
    dealt = as_member.unionByName(as_other).join(sets.select("doc_id", "brief"), "doc_id")

    def check(table: pa.Table) -> pa.Table:
        ids, comps = table.column("doc_id").to_numpy(), table.column("comp").to_numpy()
        out = table.column("out").to_numpy(zero_copy_only=False).astype(bool)
        data, off = X.binary(table.column("brief"))
        values, cut = data[off[0]:off[-1]].view(np.uint32), (off - off[0]) // 4
        size = np.diff(cut)
        mine, others = np.flatnonzero(~out), np.flatnonzero(out)
        owner = np.repeat(np.arange(len(ids)), size)
        member = ~out[owner]
        pool, who = values[member], owner[member]
        order = np.argsort(pool, kind="stable")
        pool, who = pool[order], who[order]
        found = []
        for o in others:
            s = values[cut[o]:cut[o + 1]]
            lo, hi = np.searchsorted(pool, s), np.searchsorted(pool, s, side="right")
            n = hi - lo
            at = np.repeat(lo - (np.cumsum(n) - n), n) + np.arange(n.sum())
            shared = np.bincount(who[at], minlength=len(ids))[mine]
            over = den * shared - num * (size[mine] + size[o] - shared)
            linked = np.flatnonzero((over >= 0) & (comps[mine] != comps[o]))
            linked = linked[np.argsort(-over[linked], kind="stable")]
            linked = linked[np.unique(comps[mine[linked]], return_index=True)[1]]  # the surest of each component
            found.append((np.full(len(linked), ids[o]), ids[mine[linked]], comps[mine[linked]], over[linked]))
        none = [(np.zeros(0, np.int64),) * 4]
        return pa.table({k: np.concatenate(x).astype(np.int64) for k, x in zip(("a", "b", "to", "over"), zip(*(found or none)))})

    return (dealt.groupBy(*region, "mb", "ob").applyInArrow(check, "a long, b long, to long, over long")
            .groupBy("a", "to").agg(F.max(F.struct("over", "b"))["b"].alias("b")).select("a", "b"))


def _confirm(pairs: DataFrame, sets: DataFrame, num: int, den: int) -> DataFrame:
    """The pairs whose full sets reach the similarity."""
    left = sets.select(F.col("doc_id").alias("a"), F.col("items").alias("x"))
    right = sets.select(F.col("doc_id").alias("b"), F.col("items").alias("y"))

    def run(batches):
        for batch in batches:
            keep = []
            for x, y in zip(batch.column(2), batch.column(3)):
                s, t = (np.frombuffer(v.as_buffer(), dtype=U64) for v in (x, y))
                both = np.concatenate([s, t])
                both.sort()
                shared = int((both[1:] == both[:-1]).sum())
                keep.append(den * shared >= num * (len(both) - shared))
            yield batch.select([0, 1]).filter(pa.array(keep, pa.bool_()))

    return (pairs.select("a", "b").join(left, "a").select("a", "b", "x").join(right, "b")
            .select("a", "b", "x", "y").mapInArrow(run, "a long, b long").distinct())


def _crossing(pairs: DataFrame, comp: DataFrame) -> DataFrame:
    """The pairs whose texts are not in one component yet."""
    ca, cb = (comp.select(F.col("node").alias(x), F.col("root").alias(f"c{x}")) for x in "ab")
    return sized(pairs.join(ca, "a", "left").join(cb, "b", "left")
                 .filter(F.coalesce("ca", "a") != F.coalesce("cb", "b")).select(*pairs.columns))


def _nodes(docs, id_col, text_col, nodes, k):
    """(doc_id, items, brief): shingle sets of the texts that have a candidate,
    with 64-bit and with 32-bit hashes."""
    def run(batches):
        hasher = X.SpanHasher(11, fold=True)
        for batch in batches:
            f1, f2, items, brief = [], [], [], []
            with np.errstate(over="ignore"):
                for s in _sets(batch.column(1), k, hasher):
                    f1.append(s.sum(dtype=U64).astype(np.int64))
                    f2.append(X.mix(s ^ U64(0xA5A5A5A5A5A5A5A5)).sum(dtype=U64).astype(np.int64))
                    items.append(s.tobytes())
                    brief.append((s >> U64(32)).astype(np.uint32).tobytes())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(f1, pa.int64()), pa.array(f2, pa.int64()), pa.array(items, pa.binary()),
                 pa.array(brief, pa.binary())], names=["doc_id", "f1", "f2", "items", "brief"])

    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return (texts.join(nodes, "doc_id", "left_semi").select("doc_id", "text")
            .mapInArrow(run, "doc_id long, f1 long, f2 long, items binary, brief binary")
            .dropDuplicates(["doc_id", "f1", "f2"]).select("doc_id", "items", "brief"))


def trees_for(similarity: float, least: int, miss: float = 7.5e-6) -> int:
    """Trees with which a pair at this similarity shares no prefix of ``least``
    hashes in any tree with probability ``miss`` at most; 16 at the least."""
    share = similarity ** least
    return max(16, math.ceil(math.log(miss) / math.log1p(-share))) if 0 < share < 1 else 16


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = 5,
                    num: int = 80, den: int = 100, trees: int | None = None, depth: int = 8, least: int = 4,
                    window: int = 4) -> DataFrame:
    """One row per document: (doc_id, n_shingles, component_id, kept).

    Two documents are linked when ``den * |A & B| >= num * |A | B|`` on sets of
    distinct ``k``-word shingles (A-Z lower-cased).  ``component_id`` is the
    smallest id reachable over links.  A null or wordless text has an empty set
    and no links.  A row without an id is its own: null component, kept.  Rows
    that repeat an id each give a row.  Extra columns are ignored.  ``trees``
    is as many as :func:`trees_for` gives unless set: 16 at 0.85, 23 at 0.80.
    """
    trees = trees or trees_for(num / den, least)
    ensure_checkpoint_dir(docs.sparkSession)
    feats = features(docs, id_col, text_col, k, trees * depth).checkpoint()
    keyed = feats.filter("n > 0 and doc_id is not null")
    classes = keyed.groupBy("n", "f1", "f2").agg(F.min("doc_id").alias("rep"))
    reps = (keyed.join(classes.withColumnRenamed("rep", "doc_id"), ["n", "f1", "f2", "doc_id"], "left_semi")
            .dropDuplicates(["doc_id", "n", "f1", "f2"]))
    rows = tree_rows(reps, trees, depth)
    pairs, regions = candidates(rows, depth, least, window, num, den)
    pairs = sized(pairs)
    members = sized(rows.withColumn("prefix", F.substring("key", 1, 4 * least)).join(counted(regions), ["tree", "prefix"], "left_semi")
                    .select("tree", "prefix", "doc_id", "n"))
    ids = pairs.select(F.explode(F.array("a", "b")).alias("doc_id")).unionByName(members.select("doc_id")).distinct()
    sets = sized(_nodes(docs, id_col, text_col, ids, k), 10_000)

    comp = docs.sparkSession.createDataFrame([], "node long, root long").coalesce(1)
    for _ in range(2):
        left = _crossing(pairs, comp)
        ends = (left.select(F.col("a").alias("node"), "score", "a", "b")
                .unionByName(left.select(F.col("b").alias("node"), "score", "a", "b")))
        chosen = (ends.groupBy("node").agg(F.max(F.struct("score", (-F.col("a")).alias("a"), (-F.col("b")).alias("b"))).alias("best"))
                  .select((-F.col("best.a")).alias("a"), (-F.col("best.b")).alias("b")).distinct())
        links = _confirm(sized(chosen), sets, num, den)
        comp = components(links.unionByName(comp.select(F.col("root").alias("a"), F.col("node").alias("b"))), "a", "b")
    links = _confirm(sized(_crossing(pairs.filter("not crowded"), comp).select("a", "b")), sets, num, den)
    links = links.unionByName(_confirm(sized(complete_regions(members, comp, sets, num, den, few=regions.count() <= 100_000)), sets, num, den))
    links = sized(links)
    if not links.isEmpty():
        comp = components(links.unionByName(comp.select(F.col("root").alias("a"), F.col("node").alias("b"))), "a", "b")

    comp = comp.select(F.col("node").alias("rep"), "root")
    rep_of = (keyed.select("doc_id", "n", "f1", "f2").join(classes, ["n", "f1", "f2"]).select("doc_id", "n", "rep")
              .join(comp, "rep", "left").select("doc_id", "n", F.coalesce("root", "rep").alias("component_id")))
    alone = feats.filter("n = 0 or doc_id is null").select("doc_id", "n", F.col("doc_id").alias("component_id"))
    return rep_of.unionByName(alone).select(
        "doc_id", F.col("n").alias("n_shingles"), "component_id",
        F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)).alias("kept"))
