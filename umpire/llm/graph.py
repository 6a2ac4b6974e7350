"""Connected components of an edge table, by alternating star contractions.

A large star links every greater neighbour of a node to the node's least
neighbour; a small star does so for the lesser neighbours.  Both are one
combining ``min`` per node and one join, so a hub's edges spread over tasks
(the aggregate combines before its shuffle, the join can be split).  The
number of rounds is logarithmic; each is cut with a reliable checkpoint.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def sized(rows: DataFrame, per_partition: int = 100_000) -> DataFrame:
    """The rows, written to the checkpoint folder, in as few partitions as their
    count needs, so that small tables do not fan out into many small files."""
    rows = rows.checkpoint()
    return rows.coalesce(max(1, -(-rows.count() // per_partition)))


def counted(rows: DataFrame, most: int = 100_000) -> DataFrame:
    """The rows, marked for broadcasting if they are counted to be few; a join by a hot key
    then moves nothing.  ``rows`` should be written already (``sized``, ``checkpoint``)."""
    return F.broadcast(rows) if rows.count() <= most else rows


def _large_star(edges: DataFrame, parts: int) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    return (both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
            .coalesce(parts))


def _small_star(edges: DataFrame) -> DataFrame:
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    kept = edges.join(least, "u")
    return (kept.filter("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
            .unionByName(least.select("u", F.col("m").alias("v"))).filter("u != v"))


def components(links: DataFrame, a: str, b: str, per_partition: int = 100_000) -> DataFrame:
    """(node, root): the least id reachable, for every node with an edge; the
    root itself included.  No links give no rows."""
    edges = links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).filter("u != v").distinct().checkpoint()
    seen, rows = None, edges.count()
    while True:
        parts = max(1, -(-rows // per_partition))
        edges = (_small_star(_large_star(edges.coalesce(parts), parts)).coalesce(parts).distinct().checkpoint())
        state = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == seen:
            break
        seen, rows = state, state[0]
    edges = edges.coalesce(parts)
    return (edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
            .unionByName(edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()))
