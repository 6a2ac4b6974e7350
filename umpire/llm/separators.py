"""Token counts of the documents in flat, unindexed token files.

A flat token file is a run of fixed-width little-endian ids; documents follow
each other, each ended by the end-of-document id, without an index.  The file
is cut into blocks that know nothing of documents.  Every block is searched on
its own, vectorised; a block reports where its separators are.  A prefix scan
over one small summary row per block (how many separators come before it, where
the last of them is) then stitches the documents that cross block edges.

``write_blocks`` makes such files from texts, as Parquet rows of one block
each, so that all executors can read them; ``file_blocks`` reads plain binary
files.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyarrow import fs as pa_fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from umpire.llm import tokens
from umpire.session import ensure_checkpoint_dir

BLOCK = "file long, block long, body binary"
SPAN = 4096  # blocks


def write_blocks(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", tokenizer: str | None = None,
                 eod: int = 50256, width: int = 2, block_bytes: int = 1 << 18) -> DataFrame:
    """(file, block, body, ordinal, doc_id): a flat token file per partition.

    Rows with a body are the file's blocks.  The others are not part of it:
    they record that the ``ordinal``-th document of the file is ``doc_id``.
    A null text has no ids before its separator.  An id too great for ``width`` bytes
    is an error.
    """
    path = tokenizer or tokens.default_path()

    def run(batches):
        code = tokens.coder(path)
        file, block, pending, count = TaskContext.get().partitionId(), 0, bytearray(), 0
        kinds = (pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int64())
        names = ["file", "block", "body", "ordinal", "doc_id"]

        def rows(*columns):
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=names)

        for batch in batches:
            for lo in range(0, batch.num_rows, 256):
                part = batch.slice(lo, 256)
                ids = part.column(0).to_pylist()
                for text in part.column(1).to_pylist():
                    own = np.append(code.ids(text), eod)
                    if int(own.max()) >> (8 * width):
                        raise ValueError(f"id {own.max()} does not fit {width} bytes")
                    pending += own.astype(f"<u{width}").tobytes()
                full = len(pending) // block_bytes
                bodies = [bytes(pending[i * block_bytes:(i + 1) * block_bytes]) for i in range(full)]
                del pending[:full * block_bytes]
                if full:
                    yield rows([file] * full, range(block, block + full), bodies, [None] * full, [None] * full)
                    block += full
                m = len(ids)
                yield rows([file] * m, [None] * m, [None] * m, range(count, count + m), ids)
                count += m
        if pending:
            yield rows([file], [block], [bytes(pending)], [None], [None])

    return (docs.select(F.col(id_col).cast("long"), F.col(text_col).cast("string"))
            .mapInArrow(run, BLOCK + ", ordinal long, doc_id long"))


def file_blocks(spark: SparkSession, path: str, block_bytes: int = 1 << 18) -> DataFrame:
    """Blocks (file, block, body, name) of plain binary token files; ``file`` is a hash of
    the path.

    Files are listed with their lengths alone; a row per block is dealt over the cluster,
    and each task reads its blocks' byte ranges from the shared path.  A file of any
    length is read by many tasks."""
    files = spark.read.format("binaryFile").load(path).select(F.xxhash64("path").alias("file"), F.col("path").alias("name"), "length")
    last = F.greatest(F.ceil(F.col("length") / block_bytes), F.lit(1)) - 1
    places = files.select("file", "name", "length", F.explode(F.sequence(F.lit(0).cast("long"), last)).alias("block"))

    def read(batches):
        name, opened = None, None
        for batch in batches:
            for lo in range(0, batch.num_rows, 64):
                part = batch.slice(lo, 64)
                bodies = []
                for path, length, block in zip(*(part.column(i).to_pylist() for i in (1, 2, 3))):
                    if path != name:
                        system, inner = pa_fs.FileSystem.from_uri(path)
                        name, opened = path, system.open_input_file(inner)
                    bodies.append(opened.read_at(min(block_bytes, length - block * block_bytes), block * block_bytes))
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(3), pa.array(bodies, pa.binary()), part.column(1)], ["file", "block", "body", "name"])

    dealt = places.repartition("file", F.floor(F.col("block") / 64)).sortWithinPartitions("file", "block")
    return dealt.select("file", "name", "length", "block").mapInArrow(read, BLOCK + ", name string")


def token_counts(blocks: DataFrame, eod: int = 50256, width: int = 2) -> DataFrame:
    """(file, ordinal, start, n_tokens): every document's place in its file.

    ``start`` counts ids before the document; ``n_tokens`` leaves its separator
    out.  Ids after the last separator of a file are a document too, unless
    there are none.  A file without ids has no documents.  ``body`` must hold
    whole ids; blocks may be of any size and come in any order, numbered by
    ``block``.  A null or empty body is an empty block.
    """
    def run(batches):
        for batch in batches:
            size, at = [], []
            for body in batch.column(2):
                ids = np.frombuffer(body.as_buffer() if body.is_valid else b"", dtype=f"<u{width}")
                size.append(len(ids))
                at.append(np.flatnonzero(ids == eod))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(size, pa.int64()), pa.array([len(x) for x in at], pa.int64()),
                 pa.array([x[-1] if len(x) else None for x in at], pa.int64()), pa.array(at, pa.list_(pa.int64()))],
                names=["file", "block", "size", "hits", "last", "at"])

    found = blocks.select("file", "block", "body").mapInArrow(
        run, "file long, block long, size long, hits long, last long, at array<long>")
    ensure_checkpoint_dir(found.sparkSession)
    found = found.checkpoint()  # scanned once; the prefix scan reads one small row per block
    # two levels: spans of blocks within a file, then the blocks of a span
    one = found.select("file", "block", "size", "hits", "last", F.floor(F.col("block") / SPAN).alias("span"))
    inside = Window.partitionBy("file", "span").orderBy("block")
    local = (one.withColumn("before", F.coalesce(F.sum("size").over(inside.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
             .withColumn("end", F.col("before") + F.col("last")))
    spans = local.groupBy("file", "span").agg(F.sum("size").alias("s_size"), F.sum("hits").alias("s_hits"), F.max("end").alias("s_end"), F.max("block").alias("s_last"))
    along = Window.partitionBy("file").orderBy("span")
    earlier = along.rowsBetween(Window.unboundedPreceding, -1)
    spans = (spans.withColumn("s_base", F.coalesce(F.sum("s_size").over(earlier), F.lit(0)))
             .withColumn("s_rank", F.coalesce(F.sum("s_hits").over(earlier), F.lit(0)))
             .withColumn("s_open", F.max(F.col("s_base") + F.col("s_end")).over(earlier) + 1)
             .withColumn("s_final", F.lead("span").over(along).isNull())
             .select("file", "span", "s_base", "s_rank", "s_open", "s_last", "s_final"))
    upto = inside.rowsBetween(Window.unboundedPreceding, -1)
    summary = (local.withColumn("rank", F.coalesce(F.sum("hits").over(upto), F.lit(0)))
               .withColumn("open", F.max("end").over(upto)).join(spans, ["file", "span"])
               .select("file", "block", (F.col("s_base") + F.col("before")).alias("base"), (F.col("s_rank") + F.col("rank")).alias("rank"),
                       (F.col("s_base") + F.col("end")).alias("end"),
                       F.coalesce(F.col("s_base") + F.col("open") + 1, F.col("s_open"), F.lit(0)).alias("open"),
                       (F.col("s_final") & (F.col("block") == F.col("s_last"))).alias("final")))
    placed = found.select("file", "block", "size", "at").join(summary, ["file", "block"])
    ends = F.transform("at", lambda x: x + F.col("base"))
    tail = F.when(F.col("final") & (F.col("base") + F.col("size") > F.coalesce(F.col("end") + 1, F.col("open"))),
                  F.array(F.col("base") + F.col("size"))).otherwise(F.array().cast("array<bigint>"))
    return (placed.withColumn("ends", F.concat(ends, tail))
            .select("file", "rank", "open", "ends", F.posexplode("ends").alias("i", "stop"))
            .withColumn("start", F.when(F.col("i") == 0, F.col("open")).otherwise(F.get("ends", F.col("i") - 1) + 1))
            .select("file", (F.col("rank") + F.col("i")).alias("ordinal"), "start", (F.col("stop") - F.col("start")).alias("n_tokens")))
