"""Exact running sums and ranks without a single-task window.

``Window.partitionBy(g).orderBy(k)`` puts a whole group into one task, and a
window without ``partitionBy`` puts the whole table there.  Here the rows are
range-partitioned on ``(by, order)`` instead, so a hot group is spread over
many partitions:

1. ``repartitionByRange(n, *by, *order)`` then ``sortWithinPartitions``.
2. Per partition, an Arrow-batched pass sums within each group (carrying the
   sum across batches).  This is the only Python step; it is linear and
   streams batches.
3. Per (partition, group) totals are a JVM aggregate over the same exchange.
   That table has at most ``partitions + groups`` rows; a cumulative window
   over it (partitioned by group, at most ``partitions`` rows per group) gives
   each segment the sum of everything before it.
4. The offsets are joined back on (partition, group).  AQE broadcasts them
   when the runtime size allows it, and shuffles otherwise.

Range bounds are sampled anew by every execution of an exchange, so steps 2
and 3 must not each run their own.  The sorted, range-partitioned rows are
therefore written once with a reliable ``checkpoint()`` into the cluster's
checkpoint folder: both steps read the same files, the partition index is the
file's index, and a lost executor costs a re-read, not a re-shuffle.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark import TaskContext
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from umpire.session import ensure_checkpoint_dir

_PID = "_rs_pid"
BROADCAST_ROWS = 100_000


def _same_key(a: tuple, b: tuple) -> bool:
    for x, y in zip(a, b):
        x_na = x is None or (isinstance(x, float) and math.isnan(x))
        y_na = y is None or (isinstance(y, float) and math.isnan(y))
        if x_na or y_na:
            if not (x_na and y_na):
                return False
        elif x != y:
            return False
    return True


def _local_cumsum(by: list[str], vin: list[str], vout: list[str], keep: list[str]):
    def run(batches):
        pid = TaskContext.get().partitionId()
        last_key = None
        carry = None
        for pdf in batches:
            if pdf.empty:
                continue
            if by:
                keys = pdf[by]
                prev = keys.shift(1)
                same = ((keys == prev) | (keys.isna() & prev.isna())).all(axis=1)
                first = tuple(keys.iloc[0].tolist())
                cont = last_key is not None and _same_key(first, last_key)
                new = ~same
                new.iloc[0] = not cont
                gid = new.cumsum().to_numpy()
                last_key = tuple(keys.iloc[-1].tolist())
            else:
                cont = last_key is not None
                gid = np.zeros(len(pdf), dtype=np.int64)
                last_key = ()
            sums = pdf[vin].groupby(gid).cumsum()
            if cont:
                head = gid == 0
                sums.loc[head, :] = sums.loc[head, :].to_numpy() + carry
            carry = sums.iloc[-1].to_numpy()
            out = pdf[keep].copy()
            for i, name in enumerate(vout):
                out[name] = sums.iloc[:, i].to_numpy()
            out[_PID] = pid
            yield out
    return run


def running_sums(df: DataFrame, order: list[str], values: dict[str, Column],
                 by: list[str] | tuple = (), partitions: int | None = None,
                 totals: bool = False) -> DataFrame:
    """Add inclusive running sums of ``values`` over ``order`` within ``by``.

    ``order`` must be unique within a group (append an id to break ties).
    With ``totals`` each output column ``x`` also gets ``x_total``, the sum of
    the whole group.  Null values count as zero.
    """
    n = partitions
    by = list(by)
    keep = list(df.columns)
    vin = [f"_rs_in_{k}" for k in values]
    vout = list(values)
    base = df.select("*", *[F.coalesce(c, F.lit(0)).alias(name)
                            for name, c in zip(vin, values.values())])
    kinds = {f.name: f.dataType for f in base.schema.fields}
    out_types = [T.LongType() if isinstance(kinds[v], (T.IntegerType, T.LongType,
                                                       T.ShortType, T.ByteType))
                 else T.DoubleType() for v in vin]
    base = base.select(*keep, *[F.col(v).cast(t) for v, t in zip(vin, out_types)])

    parted = _checkpointed_ranges(base, by, order, n)
    schema = T.StructType(
        [base.schema[c] for c in keep + vin]
        + [T.StructField(o, t, False) for o, t in zip(vout, out_types)]
        + [T.StructField(_PID, T.IntegerType(), False)])
    local = (parted
             .mapInPandas(_local_cumsum(by, vin, vout, keep + vin), schema=schema))

    seg = (parted.groupBy(F.spark_partition_id().alias(_PID), *by)
           .agg(*[F.sum(v).alias(f"_rs_seg_{o}") for v, o in zip(vin, vout)]))
    before = Window.partitionBy(*by).orderBy(_PID).rowsBetween(Window.unboundedPreceding, -1)
    cols = [F.col(_PID)] + [F.col(b).alias(f"_rs_by_{i}") for i, b in enumerate(by)]
    cols += [F.coalesce(F.sum(f"_rs_seg_{o}").over(before), F.lit(0)).cast(t).alias(f"_rs_off_{o}")
             for o, t in zip(vout, out_types)]
    if totals:
        whole = Window.partitionBy(*by)
        cols += [F.sum(f"_rs_seg_{o}").over(whole).cast(t).alias(f"_rs_tot_{o}")
                 for o, t in zip(vout, out_types)]
    offsets = seg.select(*cols)

    cond = local[_PID] == offsets[_PID]
    for i, b in enumerate(by):
        cond = cond & local[b].eqNullSafe(offsets[f"_rs_by_{i}"])
    joined = local.join(_sized(offsets), cond, "inner")
    out = [local[c] for c in keep]
    out += [(local[o] + offsets[f"_rs_off_{o}"]).alias(o) for o in vout]
    if totals:
        out += [offsets[f"_rs_tot_{o}"].alias(f"{o}_total") for o in vout]
    return joined.select(*out)


def _checkpointed_ranges(df: DataFrame, by: list[str], order: list[str], n: int | None) -> DataFrame:
    """Range-partition, sort within partitions and write once.

    Without an explicit ``n`` the exchange uses the session's shuffle
    partitions and AQE may merge adjacent small ranges (order is kept); the
    partition index is read from the written files afterwards, so merging
    cannot make two readers disagree."""
    ensure_checkpoint_dir(df.sparkSession)
    parted = df.repartitionByRange(n, *by, *order) if n else df.repartitionByRange(*by, *order)
    return parted.sortWithinPartitions(*by, *order).checkpoint(eager=True)


def _sized(offsets: DataFrame) -> DataFrame:
    """Broadcast the offsets when their counted rows allow it (they number
    partitions + groups); beyond that they are joined by a shuffle."""
    return F.broadcast(offsets) if offsets.count() <= BROADCAST_ROWS else offsets


def row_rank(df: DataFrame, order: list[str], by: list[str] | tuple = (),
             name: str = "rank", partitions: int | None = None,
             totals: bool = False) -> DataFrame:
    """1-based position of each row in ``order`` within ``by`` (ties must be
    broken by the caller so the order is total).

    Counting needs no Python: after the checkpoint the partitions and their
    row order are fixed files, so ``monotonically_increasing_id`` read from
    them is a deterministic in-partition offset, and the rank is that offset
    minus the group's first id in the partition plus the group's count in
    earlier partitions.
    """
    n = partitions
    by = list(by)
    keep = list(df.columns)
    parted = _checkpointed_ranges(df, by, order, n)
    tagged = parted.select("*", F.spark_partition_id().alias(_PID),
                           F.monotonically_increasing_id().alias("_rs_mid"))
    seg = tagged.groupBy(_PID, *by).agg(F.count(F.lit(1)).alias("_rs_cnt"),
                                        F.min("_rs_mid").alias("_rs_first"))
    before = Window.partitionBy(*by).orderBy(_PID).rowsBetween(Window.unboundedPreceding, -1)
    cols = [F.col(_PID), F.col("_rs_first")] + [F.col(b).alias(f"_rs_by_{i}") for i, b in enumerate(by)]
    cols.append(F.coalesce(F.sum("_rs_cnt").over(before), F.lit(0)).alias("_rs_off"))
    if totals:
        cols.append(F.sum("_rs_cnt").over(Window.partitionBy(*by)).alias("_rs_tot"))
    offsets = seg.select(*cols)
    cond = tagged[_PID] == offsets[_PID]
    for i, b in enumerate(by):
        cond = cond & tagged[b].eqNullSafe(offsets[f"_rs_by_{i}"])
    joined = tagged.join(_sized(offsets), cond, "inner")
    out = [tagged[c] for c in keep]
    out.append((tagged["_rs_mid"] - offsets["_rs_first"] + 1 + offsets["_rs_off"]).cast("long").alias(name))
    if totals:
        out.append(offsets["_rs_tot"].cast("long").alias(f"{name}_total"))
    return joined.select(*out)


def _file_places(df: DataFrame) -> list[Column]:
    """File and block of each row, where the frame is a scan of files."""
    try:
        places = [F.col("_metadata.file_path").alias("_rs_path"), F.col("_metadata.file_block_start").alias("_rs_block")]
        return places if df.select(*places) else []
    except AnalysisException:
        return []


def with_position(df: DataFrame, name: str = "position") -> DataFrame:
    """0-based position of each row, without a shuffle.

    Rows read from files are numbered by file name, then by place in the file,
    whatever order Spark reads the files in.  Frames that come from no file are
    numbered by their partitions.  A scan whose rows were dealt anew has no such
    order and is an error; rank it by a key instead (``row_rank``).

    The frame is materialised once with a reliable ``checkpoint()`` (fixed
    files, fixed order); a row's position is the offset of its block (a
    cumulative count over one row per block) plus its offset inside it
    (``monotonically_increasing_id`` read from the fixed files).
    """
    ensure_checkpoint_dir(df.sparkSession)
    keep = list(df.columns)
    places = _file_places(df)
    order = ["_rs_path", "_rs_block"] if places else []
    fixed = df.select("*", *places).checkpoint(eager=True)
    tagged = fixed.select("*", F.spark_partition_id().alias(_PID),
                          F.monotonically_increasing_id().alias("_rs_mid"))
    seg = tagged.groupBy(*order, _PID).agg(F.count(F.lit(1)).alias("_rs_cnt"), F.min("_rs_mid").alias("_rs_first"),
                                           F.max("_rs_mid").alias("_rs_last"))
    blocks = seg.groupBy(*order).agg(F.count(F.lit(1)).alias("n"), F.max(F.expr("_rs_last - _rs_first + 1 <> _rs_cnt")).alias("gaps"))
    if places and not blocks.filter("n > 1 or gaps").isEmpty():
        raise ValueError("rows of a file were dealt anew, so they have no position; rank them by a key")
    before = Window.orderBy(*order, _PID).rowsBetween(Window.unboundedPreceding, -1)
    offsets = seg.select(F.col(_PID).alias("_rs_p"), *[F.col(c).alias(f"{c}_p") for c in order], "_rs_first",
                         F.coalesce(F.sum("_rs_cnt").over(before), F.lit(0)).alias("_rs_off"))
    cond = tagged[_PID] == offsets["_rs_p"]
    for c in order:
        cond = cond & (tagged[c] == offsets[f"{c}_p"])
    joined = tagged.join(_sized(offsets), cond, "inner")
    pos = (F.col("_rs_mid") - F.col("_rs_first") + F.col("_rs_off")).cast("long")
    return joined.select(*[tagged[c] for c in keep], pos.alias(name))
