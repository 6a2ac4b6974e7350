"""Mix sources to target weights by systematic sampling.

Each source gets a target number of words.  Every document of a source is
expected ``target / source size`` times; the expectations are prefix-summed
along the source's documents in order of size, one seeded offset per source is
added, and a document is taken once per integer boundary its interval crosses.
In size order the taken words stay within about one document of the target.

Plain DataFrame operations throughout.  The order inside a source comes from
range partitions, so a source with a third of all rows spreads over tasks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from umpire.operators.ordered import row_rank
from umpire.session import ensure_checkpoint_dir

WORD = r"[^\x20\x09-\x0D]+"


def word_count(text: Column) -> Column:
    """Words of a text; null has none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame, weights: tuple[float, ...], share: float, limit: float) -> DataFrame:
    """(source, source_size, target) from one row per source (source, source_size).

    Sources in code point order, null last, take the weights in turn and share
    ``share`` of all words; a target stops at ``limit`` times its source and
    the excess is reshared by weight.  The fixed point of that is one water
    level: ``least(limit * size, level * weight)``; the level is found on the
    sources in order of the level at which each fills up.  The two windows see
    one row per source.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    turn = F.pmod(F.row_number().over(by_name) - 1, F.lit(len(weights)))
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), turn + 1)
    rows = (sizes.withColumn("weight", weight).withColumn("full", F.lit(float(limit)) * F.col("source_size"))
            .withColumn("fills_at", F.col("full") / F.col("weight")))
    order = Window.orderBy("fills_at", F.col("source").asc_nulls_last())
    whole, before = Window.partitionBy(), order.rowsBetween(Window.unboundedPreceding, -1)
    level = ((F.lit(float(share)) * F.sum("source_size").over(whole) - F.coalesce(F.sum("full").over(before), F.lit(0.0)))
             / (F.sum("weight").over(whole) - F.coalesce(F.sum("weight").over(before), F.lit(0.0))))
    rows = rows.withColumn("at", level).withColumn("turn", F.row_number().over(order))
    found = F.min(F.when(F.col("at") <= F.col("fills_at"), F.struct("turn", "at"))).over(whole)["at"]
    return rows.withColumn("level", found).select(
        "source", "source_size", F.coalesce(F.least(F.col("full"), F.col("level") * F.col("weight")), F.col("full")).alias("target"))


def offset(source: Column, seed: int) -> Column:
    """The source's offset in [0, 1): 52 bits of a seeded md5."""
    name = F.concat(F.lit(f"{seed}|"), F.coalesce(F.concat(F.lit("s"), source), F.lit("null")))
    return F.conv(F.substring(F.md5(name), 1, 13), 16, 10).cast("double") / F.lit(float(2 ** 52))


def systematic_mix(docs: DataFrame, keep: tuple[str, ...] = (), id_col: str = "doc_id", text_col: str = "text",
                   source_col: str = "source", weights: tuple[float, ...] = (3, 1, 2), share: float = 1.5,
                   limit: float = 2.0, seed: int = 42) -> DataFrame:
    """(doc_id, source, size, source_size, target, copies, *keep), a row per document.

    ``copies`` is 0, 1 or 2 with the default limit of 2.  Ties in size are
    ordered by id.  A null text has size 0; a source of size 0 has target 0 and
    no copies.  Columns outside ``keep`` are dropped; their names may clash.
    """
    ensure_checkpoint_dir(docs.sparkSession)
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(source_col).alias("source"),
                       word_count(F.col(text_col)).alias("size"),
                       F.struct(*keep).alias("kept") if keep else F.lit(None).cast("int").alias("kept"))
    if not keep:
        rows = rows.checkpoint()  # the ranges are sampled and dealt from here, not from the texts
    ranked = row_rank(rows, ["size", "doc_id"], by=["source"], name="place")
    sizes = ranked.groupBy("source").agg(F.sum("size").alias("source_size"))
    targets = source_targets(sizes, weights, share, limit)
    joined = ranked.join(targets.withColumnRenamed("source", "_source"), F.col("source").eqNullSafe(F.col("_source")))
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    start = offset(F.col("source"), seed)
    crossed = F.floor(rate * F.col("place") + start) - F.floor(rate * (F.col("place") - 1) + start)
    return joined.select("doc_id", "source", "size", "source_size", "target",
                         F.least(crossed, F.lit(int(limit))).cast("long").alias("copies"),
                         *[F.col(f"kept.{c}").alias(c) for c in keep])
