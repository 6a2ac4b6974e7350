"""Approximate nearest neighbours by a permutation index.

A vector is represented by its ``places`` nearest pivots, nearest first.  The
index is cut into blocks of rows; in a block every pivot has an inverted file:
the place it takes in each row's list (``places`` where the list lacks it; a
byte per row, since a good part of the lists hold any one pivot).  A query
reads the files of its own pivots only and adds up the footrule distance

    sum over pivots |place in the query's list - place in the row's list|,

takes the nearest ``share`` of the block by footrule, and reranks those by the
exact cosine in double precision.  Queries come in blocks as well, and a pair
of blocks is one task's group, so the work spreads evenly whatever the data:
a value that a third of all vectors share loads no key.

The pivots are a bounded sample: the ``pivots`` rows of smallest id hash, per
vector length.  Every row is indexed.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from umpire.session import ensure_checkpoint_dir

LENGTHS = 64  # vector lengths that get pivots; rows of rarer lengths are compared without


def valid_vectors(rows: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """(vec_id, size, vec): rows with an id and a finite, non-zero vector, as doubles."""
    vec = F.col(vec_col).cast("array<double>")
    bad = F.exists(vec, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return (rows.filter(F.col(id_col).isNotNull() & vec.isNotNull() & (F.size(vec) > 0))
            .filter(~bad & F.exists(vec, lambda x: x != 0))
            .select(F.col(id_col).cast("long").alias("vec_id"), F.size(vec).alias("size"), vec.alias("vec")))


def choose_pivots(vectors: DataFrame, pivots: int) -> dict[int, np.ndarray]:
    """Distinct unit pivots per vector length, out of four times as many rows, at most ``pivots`` for each of ``LENGTHS`` lengths."""
    common = vectors.groupBy("size").count().orderBy(F.desc("count"), "size").limit(LENGTHS).select("size")
    order = Window.partitionBy("size").orderBy(F.xxhash64("vec_id"), "vec_id")
    rows = (vectors.join(F.broadcast(common), "size").withColumn("rank", F.row_number().over(order))
            .filter(F.col("rank") <= 4 * pivots).orderBy("size", "rank").select("size", "vec").collect())
    out: dict[int, dict] = {}
    for r in rows:  # equal vectors give one pivot
        out.setdefault(r["size"], {})[tuple(r["vec"])] = None
    return {k: _unit(np.array(list(v)[:pivots])) for k, v in out.items()}


def _unit(x: np.ndarray) -> np.ndarray:
    x = x / np.abs(x).max(axis=1, keepdims=True)  # no overflow in the norm
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def _lists(x: np.ndarray, pivots: np.ndarray | None, places: int) -> np.ndarray:
    """Each row's nearest pivots in order (ties to the lower pivot)."""
    if pivots is None:
        return np.zeros((len(x), 0), dtype=np.int16)
    near = np.argsort(-np.round(_unit(x) @ pivots.T, 12), axis=1, kind="stable")
    return near[:, :places].astype(np.int16)


def _blocks(rows: DataFrame, counts: DataFrame, per_block: int, pivots: dict[int, np.ndarray], places: int) -> DataFrame:
    """(size, block, blocks, ids, vecs, lists): rows packed into blocks."""
    dealt = (rows.join(F.broadcast(counts), "size")
             .withColumn("blocks", F.ceil(F.col("count") / per_block).cast("int"))
             .withColumn("block", F.pmod(F.xxhash64(F.lit(3), "vec_id"), F.col("blocks")).cast("int")))

    def packed(table: pa.Table) -> pa.Table:
        table = table.sort_by("vec_id").combine_chunks()
        size = table.column("size")[0].as_py()
        x = table.column("vec").chunk(0).values.to_numpy(zero_copy_only=False).astype(float).reshape(-1, size) \
            if table.num_rows else np.zeros((0, size))
        lists = _lists(x, pivots.get(size), places)
        return pa.table({"size": pa.array([size], pa.int32()), "block": table.column("block")[:1],
                         "blocks": table.column("blocks")[:1],
                         "ids": pa.array([table.column("vec_id").to_numpy().astype("<i8").tobytes()], pa.binary()),
                         "vecs": pa.array([x.astype("<f8").tobytes()], pa.binary()),
                         "lists": pa.array([lists.astype("<i2").tobytes()], pa.binary())})

    return (dealt.select("size", "block", "blocks", "vec_id", "vec").groupBy("size", "block")
            .applyInArrow(packed, "size int, block int, blocks int, ids binary, vecs binary, lists binary"))


def _read(row: dict, size: int, places: int):
    ids = np.frombuffer(row["ids"], dtype="<i8")
    vecs = np.frombuffer(row["vecs"], dtype="<f8").reshape(-1, size)
    lists = np.frombuffer(row["lists"], dtype="<i2").reshape(len(ids), -1)
    return ids, vecs, lists


def inverted_files(lists: np.ndarray, pivots: int, places: int) -> np.ndarray:
    """[pivot, row]: the pivot's place in the row's list, ``places`` if not in it."""
    out = np.full((pivots, len(lists)), places, dtype=np.uint8)
    rows = np.arange(len(lists))
    for place in range(lists.shape[1]):
        out[lists[:, place], rows] = place
    return out


def footrules(own: np.ndarray, files: np.ndarray, places: int) -> np.ndarray:
    """Footrule distance of one query's list to every row of the files."""
    at = np.arange(len(own), dtype=np.uint8)[:, None]
    shared = len(own) * places - np.maximum(files[own], at).sum(axis=0, dtype=np.int64)
    return len(own) * (len(own) + 1) - 2 * shared


def _search(q: dict, x: dict, size: int, pivots: int, places: int, share: float, least: int, k: int):
    """Per query row the best ``k`` of a block.  Of equal vectors only the ``k + 1``
    smallest ids can be among them, so copies are ranked once."""
    qids, qvecs, qlists = _read(q, size, places)
    ids, vecs, lists = _read(x, size, places)
    _, first, of = np.unique(vecs.copy().view(f"V{8 * size}").ravel(), return_index=True, return_inverse=True)
    by_copy = np.argsort(of, kind="stable")  # ids ascend in a block
    starts = np.searchsorted(of[by_copy], np.arange(len(first) + 1))
    files = inverted_files(lists[first], pivots, places) if lists.shape[1] else None
    budget = min(len(first), max(least, int(np.ceil(share * len(first)))))
    top = np.abs(vecs).max(axis=1)
    norms = np.sqrt(((vecs / top[:, None]) ** 2).sum(axis=1))
    for n, (qid, qv) in enumerate(zip(qids, qvecs)):
        if files is not None and budget < len(first):
            rank = footrules(qlists[n], files, places) * len(first) + np.arange(len(first))
            kept = np.argpartition(rank, budget - 1)[:budget]
        else:
            kept = np.arange(len(first))
        copies = np.minimum(starts[kept + 1] - starts[kept], k + 1)
        near = by_copy[np.repeat(starts[kept] - (np.cumsum(copies) - copies), copies) + np.arange(copies.sum())]
        near = near[ids[near] != qid]
        qtop = np.abs(qv).max()
        qs = qv / qtop
        score = ((vecs[near] / top[near, None]) * qs).sum(axis=1) / (norms[near] * np.sqrt((qs * qs).sum()))
        best = np.lexsort((ids[near], -score))[:k]
        for i in best:
            yield n, int(qid), int(ids[near[i]]), float(score[i])


def nearest(rows: DataFrame, is_query: Column, id_col: str = "vec_id", vec_col: str = "embedding", k: int = 5,
            pivots: int = 256, places: int = 96, share: float = 0.3, least: int = 256,
            block: int = 4096) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` best found for every query row.

    Nearness is the largest cosine, ties to the smaller id; ``is_query`` is a
    condition on ``vec_id``.  Candidates are all rows but those with the
    query's own id.  Rows without an id, and vectors that are null, empty, zero
    or hold null or non-finite components take no part.  Vectors meet those of
    the same length only.  A row that repeats an id is a row of its own; such
    queries each give their list.  ``share`` of every block is reranked, at
    least ``least`` rows.  Extra columns are ignored.
    """
    spark = rows.sparkSession
    ensure_checkpoint_dir(spark)
    vectors = valid_vectors(rows, id_col, vec_col)
    chosen = choose_pivots(vectors, pivots)
    width = {s: min(places, len(p)) for s, p in chosen.items()}
    queries = vectors.filter(is_query)
    index = _blocks(vectors, vectors.groupBy("size").count(), block, chosen, places)
    asked = _blocks(queries, queries.groupBy("size").count(), block, chosen, places)
    asked = asked.withColumnsRenamed({"block": "qblock", "blocks": "qblocks"}).checkpoint()
    index = index.checkpoint()
    key = ["size", "qblock", "block"]
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    left = (asked.join(F.broadcast(index.groupBy("size").agg(F.max("blocks").alias("blocks"))), "size")
            .withColumn("block", every("blocks")).select(*key, "ids", "vecs", "lists"))
    right = (index.join(F.broadcast(asked.groupBy("size").agg(F.max("qblocks").alias("qblocks"))), "size")
             .withColumn("qblock", every("qblocks")).select(*key, "ids", "vecs", "lists"))
    counts = {s: len(p) for s, p in chosen.items()}

    def meet(q: pa.Table, x: pa.Table) -> pa.Table:
        found = []
        if q.num_rows and x.num_rows:
            a, b = q.to_pylist()[0], x.to_pylist()[0]
            size = a["size"]
            found = [(size, a["qblock"], *r) for r in
                     _search(a, b, size, counts.get(size, 0), width.get(size, 0), share, least, k)]
        columns = list(zip(*found)) or [()] * 6
        kinds = (pa.int32(), pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.float64())
        return pa.table({n: pa.array(c, t) for n, c, t in
                         zip(("size", "qblock", "qrow", "query_id", "vec_id", "score"), columns, kinds)})

    met = (left.groupBy(*key).cogroup(right.groupBy(*key))
           .applyInArrow(meet, "size int, qblock int, qrow int, query_id long, vec_id long, score double"))
    order = Window.partitionBy("size", "qblock", "qrow").orderBy(F.desc("score"), "vec_id")
    return (met.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))
