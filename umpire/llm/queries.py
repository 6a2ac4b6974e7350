"""The registered queries of the training-data operators, over whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from umpire.session import ensure_checkpoint_dir, table


def op1_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    from umpire.llm.minhash import near_duplicates
    return near_duplicates(table(spark, sf_dir, "documents"), k=3, num=85, den=100)


def op2_licences(spark: SparkSession, sf_dir: str) -> DataFrame:
    from umpire.llm.licences import scan_licences, url_path
    return scan_licences(table(spark, sf_dir, "pages"), url_path(F.col("url")))


def op3_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    from umpire.llm.substrings import dedup_substrings
    out = dedup_substrings(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def op4_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    from umpire.llm.neighbours import nearest
    return nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    from umpire.llm.quality import quality_rules
    return quality_rules(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op6_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    from umpire.llm.pii import digest, personal_data
    return digest(personal_data(table(spark, sf_dir, "documents")))


def op7_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents' flat token files, then their token counts by separators."""
    from umpire.llm.separators import token_counts, write_blocks
    ensure_checkpoint_dir(spark)
    written = write_blocks(table(spark, sf_dir, "documents")).checkpoint()
    counts = token_counts(written.filter("body is not null").select("file", "block", "body"))
    names = written.filter("body is null").select("file", "ordinal", "doc_id")
    return names.join(counts, ["file", "ordinal"]).select("doc_id", "start", "n_tokens")


def op8_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    from umpire.llm.lines import dedup_lines
    out = dedup_lines(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_lines", "n_removed", F.md5("text").alias("kept_md5"))


def op9_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    from umpire.llm.packing import pack
    return pack(table(spark, sf_dir, "documents"))


def op10_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    from umpire.llm.mixing import systematic_mix
    out = systematic_mix(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"))


def op11_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    from umpire.llm.fingerprints import edit_likeness
    return edit_likeness(table(spark, sf_dir, "documents"))


def op12_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    from umpire.llm.trie import prefix_trie
    return prefix_trie(table(spark, sf_dir, "conversations"))


def op13_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    from umpire.llm.spelling import spelling_variants
    return spelling_variants(table(spark, sf_dir, "documents"))


QUERIES = {name: fn for name, fn in list(globals().items()) if name.startswith("op")}
