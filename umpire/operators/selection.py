"""Keys at given ranks of a group, by counting buckets instead of sorting rows.

A pass counts rows by the leading digits of their key (a combining aggregate of at most
16^``DIGITS`` buckets a group); only the bucket that holds a wanted rank is counted again
by its next digits, until it is small enough to read.  Rows are never exchanged: n rows a
group take about log(n / ``SMALL``) / log(16^``DIGITS``) + 1 passes over the keys, each of
which shuffles bucket counts alone.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

DIGITS = 3
SMALL = 20_000


def keys_at_ranks(rows: DataFrame, group: str, key: str, ranks: Callable[[int], list[int]], width: int = 32,
                  small: int = SMALL) -> dict:
    """{group: [key, ...]}: the keys at the 1-based ranks that ``ranks`` gives for a group
    of n rows, in order of the key, a lower-case hex string of ``width`` digits.

    A rank of 0 gives the empty string, which is before all keys.  Null is a group; rows
    with a null key take no part.  The driver holds bucket counts: as many as 16^``DIGITS``
    for each group and wanted rank."""
    rows = rows.select(F.col(group).alias("g"), F.col(key).alias("k")).where("k is not null")
    wanted: dict = {}  # (group, rank) -> key
    sizes: dict = {}
    open_ = {(): [None]}  # (group, prefix) -> [(rank in group, rank in bucket)]; the first pass takes all
    length = 0
    while open_:
        before, length = length, min(length + DIGITS, width)
        found = _inside(rows, open_).groupBy("g", F.substring("k", 1, length).alias("p")).agg(F.count(F.lit(1)).alias("n")).collect()
        by_group: dict = {}
        for r in found:
            by_group.setdefault((r["g"], r["p"][:before]), []).append((r["p"], r["n"]))
        if not sizes:
            sizes = {g: sum(n for _, n in v) for (g, _), v in by_group.items()}
            open_ = {(g, ""): [(rank, rank) for rank in set(ranks(n)) if rank > 0] for g, n in sizes.items()}
        ready, next_ = {}, {}
        for at, places in open_.items():
            for rank, left in places:
                for prefix, n in sorted(by_group[at]):
                    if left <= n:
                        (ready if n <= small or length == width else next_).setdefault((at[0], prefix), []).append((rank, left))
                        break
                    left -= n
        if ready:
            last = {}
            for r in _inside(rows, ready).groupBy("g", "k").agg(F.count(F.lit(1)).alias("n")).collect():
                last.setdefault(r["g"], []).append((r["k"], r["n"]))
            for (g, prefix), places in ready.items():
                own = sorted(x for x in last[g] if x[0].startswith(prefix))
                for rank, left in places:
                    for k, n in own:
                        if left <= n:
                            wanted[(g, rank)] = k
                            break
                        left -= n
        open_ = next_
    return {g: [wanted[(g, rank)] if rank > 0 else "" for rank in ranks(n)] for g, n in sizes.items()}


def _inside(rows: DataFrame, buckets: dict) -> DataFrame:
    """The rows of some (group, prefix) buckets."""
    if () in buckets:
        return rows
    some = F.lit(False)
    for g, prefix in buckets:
        some = some | (F.col("g").eqNullSafe(F.lit(g)) & F.col("k").startswith(prefix))
    return rows.where(some)
