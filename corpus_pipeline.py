"""The corpus pipeline: five stages, each written as Parquet and reread.

Every stage takes (spark, docs, sf_dir) and works on all rows its predecessor
kept.  All but the last return the columns of ``documents``; extra columns of
the input are carried along.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from umpire.llm.lines import dedup_lines
from umpire.llm.minhash import near_duplicates
from umpire.llm.mixing import systematic_mix
from umpire.llm.packing import pack
from umpire.llm.quality import quality_rules
from umpire.operators.ordered import row_rank
from umpire.session import ensure_checkpoint_dir, shared_dir, table


def _apart(docs: DataFrame, *own: str) -> DataFrame:
    """The columns that a stage works on, all others in one struct, so that none of
    them can clash with a name that the stage computes."""
    rest = [c for c in docs.columns if c not in own]
    return docs.select(*[c for c in own if c in docs.columns], *([F.struct(*rest).alias("carried")] if rest else []))


def _together(rows: DataFrame, docs: DataFrame, **changed: Column) -> DataFrame:
    """The columns of ``docs`` again, those ``changed`` anew."""
    own = {"doc_id", "text", "source"}.intersection(rows.columns)  # no stage computes any of these names anew
    return rows.select(*[changed.get(c, F.col(c) if c in own else F.col("carried").getField(c)).alias(c) for c in docs.columns])


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that fail the base tests or match a learned rule go."""
    apart = _apart(docs, "doc_id", "text")
    rest = tuple(c for c in apart.columns if c != "doc_id")
    kept = quality_rules(apart, table(spark, sf_dir, "labels"), keep=rest).filter("kept")
    return _together(kept.select(*apart.columns), docs)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Later copies of repeated line runs go, and documents left without a word.

    ``n_chars`` follows the text."""
    apart = _apart(docs, "doc_id", "text")
    out = dedup_lines(apart).filter((F.col("n_removed") == 0) | F.col("text").rlike(r"[^\x20\x09-\x0D]"))
    if "n_chars" not in docs.columns:
        return _together(out.select(*apart.columns), docs)
    size = F.when(F.col("n_removed") > 0, F.length("text")).otherwise(F.col("carried.n_chars"))
    return _together(out, docs, n_chars=size.cast(docs.schema["n_chars"].dataType))


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays: that of least id, once.

    A document is an id and a text.  Where an id repeats with other texts, documents
    are numbered in order of id and text hash, so that each is judged by itself."""
    ensure_checkpoint_dir(spark)
    apart = _apart(docs, "doc_id", "text")
    keyed = apart.withColumn("_mark", F.xxhash64("text"))
    named = keyed.filter("doc_id is not null")
    if named.groupBy("doc_id").agg((F.min("_mark") != F.max("_mark")).alias("differ")).filter("differ").isEmpty():
        marks = near_duplicates(apart).filter(~F.col("kept")).select("doc_id").distinct()
        first = apart.join(marks, "doc_id", "left_anti")
    else:
        names = row_rank(named.select("doc_id", "_mark").distinct(), ["doc_id", "_mark"], name="_node").checkpoint()
        texts = named.select("doc_id", "_mark", "text").dropDuplicates(["doc_id", "_mark"]).join(names, ["doc_id", "_mark"])
        copies = near_duplicates(texts, id_col="_node").filter(~F.col("kept")).select(F.col("doc_id").alias("_node")).distinct()
        first = keyed.join(names.join(copies, "_node", "left_semi"), ["doc_id", "_mark"], "left_anti").select(*apart.columns)
    once = first.filter("doc_id is not null").dropDuplicates(["doc_id", "text"])
    return _together(once.unionByName(first.filter("doc_id is null")), docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources at their target weights: a document appears as often as drawn."""
    apart = _apart(docs, "doc_id", "text", "source")
    rest = tuple(c for c in apart.columns if c not in ("doc_id", "source"))
    out = systematic_mix(apart, keep=rest).filter("copies > 0")
    out = out.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))))
    return _together(out.select(*apart.columns), docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token sequences; one row per piece."""
    return pack(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality_rules", quality), ("line_dedup", lines), ("near_dedup", near_copies), ("source_mix", mix), ("packing", packed)]

#: The learned rules, the near copies and the token ids have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each is written to the shared folder."""
    folder = shared_dir(spark, "corpus")
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
    return docs
