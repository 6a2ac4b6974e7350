"""Line dedup: later copies of repeated line runs are deleted.

Every document is a sequence of line ids (hashes of whole lines).  Suffixes of
these sequences are named by prefix doubling: the name of the 2d lines from a
place is the hash of the names of the d lines from it and of the d lines d
places on.  Two suffixes share a name of depth d exactly if they share their
first d lines, so the suffixes with one name are an interval of the suffix
array with longest common prefix d or more; only membership in intervals is
needed, not their order, so names replace ranks and no global sort is made.
A run of any length is named by two overlapping names of a power of two.

Only lines that occur again can lie in a repeated run.  They fall into
stretches of neighbouring lines per document; a stretch is one row whose arrays
hold the doubled names.  From every start the candidate runs end between the
first end that reaches ``min_words`` and the one before the next start's, at
most two per line in total; any longer repeated run is a union of those.  The
interval of each candidate then shows its first copy by a combining minimum.

Plain DataFrame operations throughout.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from umpire.llm.mixing import WORD
from umpire.session import ensure_checkpoint_dir

KEY = ["doc", "mark"]
HOT = 50_000
SALTS = 64


def _lines(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(doc, mark, line, h, h2, words): one row per line of non-null texts."""
    text = F.col(text_col)
    # what is exploded stands in a projection of its own: its row is copied for every line
    return (docs.select(F.col(id_col).cast("long").alias("doc"), F.xxhash64(text).alias("mark"), F.split(text, "\n", -1).alias("lines"))
            .select("doc", "mark", F.posexplode("lines").alias("line", "body"))
            .select("doc", "mark", "line", F.xxhash64("body").alias("h"), F.xxhash64(F.lit(7), F.col("body")).alias("h2"),
                    F.regexp_count("body", F.lit(WORD)).cast("long").alias("words")))


def stretches(lines: DataFrame, min_words: int) -> DataFrame:
    """Stretches of neighbouring lines that all occur again somewhere.

    (doc, mark, items): items are structs (line, h, h2, words, stop, last) in
    line order; ``stop`` is the index of the first end that reaches
    ``min_words`` from here (null: none) and ``last`` the last end to try.
    A row that repeats a whole row counts once.
    """
    lines = lines.dropDuplicates([*KEY, "line"])
    often = lines.groupBy("h", "h2").agg(F.count(F.lit(1)).alias("times")).filter("times > 1").checkpoint()
    # the copies of a very common line are dealt over SALTS parts; at most HOT lines can be so common
    bound = max(1000, (often.agg(F.sum("times")).first()[0] or 0) // HOT)
    often = often.withColumn("parts", F.when(F.col("times") > bound, F.lit(SALTS)).otherwise(F.lit(1)))
    common = F.broadcast(often.filter("parts > 1").select("h", "h2", F.col("parts").alias("deal")))
    dealt = (lines.join(common, ["h", "h2"], "left")
             .withColumn("part", F.when(F.col("deal").isNotNull(), F.pmod(F.xxhash64("doc", "line"), F.col("deal"))).otherwise(F.lit(0)).cast("int")))
    posted = often.select("h", "h2", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"))
    live = dealt.join(posted, ["h", "h2", "part"], "left_semi").drop("deal", "part")
    by_doc = Window.partitionBy(*KEY).orderBy("line")
    live = live.withColumn("stretch", F.col("line") - F.row_number().over(by_doc))
    inside = Window.partitionBy(*KEY, "stretch")
    order = inside.orderBy("line")
    upto = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    live = (live.withColumn("at", F.row_number().over(order) - 1)
            .withColumn("sum", F.sum("words").over(upto)).withColumn("before", F.col("sum") - F.col("words"))
            .withColumn("end", F.count(F.lit(1)).over(inside) - 1))
    reach = inside.orderBy("before").rangeBetween(Window.currentRow, min_words - 1)
    live = live.withColumn("stop", F.when(F.max("sum").over(reach) - F.col("before") >= min_words, F.max("at").over(reach)))
    later = F.lead("stop").over(order)
    live = live.withColumn("last", F.when(later.isNull(), F.col("end")).otherwise(F.greatest("stop", later - 1)))
    return (live.groupBy(*KEY, "stretch")
            .agg(F.array_sort(F.collect_list(F.struct("line", "h", "h2", "words", "stop", "last"))).alias("items"))
            .filter(F.exists("items", lambda i: i["stop"].isNotNull())).select(*KEY, "items"))


def _double(names, step):
    """Names of twice the depth: null where fewer lines are left."""
    return F.transform(names, lambda n, i: F.when(
        i + step < F.size(names), F.struct(F.xxhash64(n["x"], F.get(names, i + step)["x"]).alias("x"),
                                           F.xxhash64(F.lit(7), n["y"], F.get(names, i + step)["y"]).alias("y"))))


def repeated_runs(lines: DataFrame, min_words: int) -> DataFrame:
    """(doc, mark, first, last): candidate runs, by line number, that equal a
    run that starts earlier (by id, nulls first, then line)."""
    rows = stretches(lines, min_words).checkpoint()
    longest = rows.select(F.max(F.array_max(F.transform(
        "items", lambda v, i: F.when(v["stop"].isNotNull(), v["last"] - i + 1)))).alias("n")).first()["n"]
    if longest is None:
        return rows.select(*KEY, F.lit(0).alias("first"), F.lit(0).alias("last")).limit(0)
    rows = rows.withColumn("names0", F.transform("items", lambda v: F.struct(v["h"].alias("x"), v["h2"].alias("y"))))
    levels = [F.col("names0")]
    while 2 ** len(levels) <= longest:
        j = len(levels)
        rows = rows.withColumn(f"names{j}", _double(levels[-1], 2 ** (j - 1)))
        levels.append(F.col(f"names{j}"))

    def named(at, to):
        """The run from index ``at`` to ``to``: its size and two overlapping names."""
        size, name = to - at + 1, F.lit(None)
        for j, names in enumerate(levels):
            head, tail = F.get(names, at), F.get(names, to - (2 ** j - 1))
            here = F.struct(size.alias("n"), head["x"].alias("a"), head["y"].alias("b"), tail["x"].alias("c"), tail["y"].alias("d"))
            name = F.when(size >= 2 ** j, here) if j == 0 else F.when(size >= 2 ** j, here).otherwise(name)
        return F.struct(at.alias("at"), to.alias("to"), name.alias("name"))

    # all candidates of a stretch as one array, so that no row carries names or items along
    candidates = F.flatten(F.transform("items", lambda v, i: F.when(v["stop"].isNotNull(), F.transform(
        F.sequence(v["stop"].cast("int"), v["last"].cast("int")), lambda to: named(i, to))).otherwise(F.array())))
    runs = (rows.select(*KEY, F.col("items")[0]["line"].alias("from"), candidates.alias("runs"))
            .select(*KEY, "from", F.explode_outer("runs").alias("run")).filter("run is not null")  # outer: no filter on the names is inferred
            .select(*KEY, (F.col("from") + F.col("run.at")).alias("first"), (F.col("from") + F.col("run.to")).alias("last"), "run.name.*"))
    place = F.struct("doc", "mark", "first")
    intervals = (runs.groupBy("n", "a", "b", "c", "d").agg(F.min(place).alias("origin"), F.count(F.lit(1)).alias("times"))
                 .filter("times > 1"))
    return (runs.join(intervals, ["n", "a", "b", "c", "d"])
            .filter(~place.eqNullSafe(F.col("origin"))).select(*KEY, "first", "last"))


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_words: int = 50) -> DataFrame:
    """All columns, the text without later copies of repeated line runs, and
    ``n_lines`` and ``n_removed``.

    A run is one or more whole neighbouring lines with ``min_words`` words or
    more.  It is deleted where an equal run starts earlier, in order of id
    (nulls first) and line; the earlier one may be in the same text and may
    overlap it.  What is repeated is judged on the input.  Blank lines belong
    to runs.  A null text stays null with 0 lines; an empty one has one blank
    line.  Rows that repeat id and text are one document and end alike.
    """
    ensure_checkpoint_dir(docs.sparkSession)
    runs = repeated_runs(_lines(docs, id_col, text_col), min_words)
    gone = (runs.select(*KEY, F.explode(F.sequence("first", "last")).alias("line")).distinct()
            .groupBy(*KEY).agg(F.collect_set("line").alias("_gone"))
            .withColumnsRenamed({"doc": "_doc", "mark": "_mark"}))
    body = F.split(F.col(text_col), "\n", -1)
    stay = F.array_except(F.sequence(F.lit(0), F.size(body) - 1), F.col("_gone").cast("array<int>"))  # in order
    kept = F.transform(stay, lambda i: F.get(body, i))
    joined = docs.join(gone, F.col(id_col).cast("long").eqNullSafe(F.col("_doc"))
                       & (F.xxhash64(F.col(text_col)) == F.col("_mark")), "left")
    text = F.when(F.col("_gone").isNull(), F.col(text_col)).otherwise(F.array_join(kept, "\n"))
    return joined.select(
        *[text.alias(c) if c == text_col else docs[c] for c in docs.columns],
        F.coalesce(F.size(body), F.lit(0)).cast("long").alias("n_lines"),
        F.coalesce(F.size("_gone"), F.lit(0)).cast("long").alias("n_removed"))
