"""Stand-ins for the pipeline's inputs, derived from the given tables.

Each builder only reads the given parquet tables and derives columns with
built-in expressions, so its size grows with the tables.  The SQL oracle in
``umpire.plans.oracle`` derives the same columns with the same rules.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from umpire.functions.hashing import residue
from umpire.schemas import LABEL, NEGATIVE, POSITIVE
from umpire.session import table

# Numeric features of a labelled document, in order.
DOC_FEATURES = ["n_chars", "n_words", "n_sentences", "n_lines",
                "lang_en", "lang_fr", "lang_de", "lang_es"]
LANGS = ["en", "fr", "de", "es"]
NULL_EVERY = 7


def _count_of(text: str, ch: str) -> F.Column:
    return F.length(text) - F.length(F.replace(F.col(text), F.lit(ch), F.lit("")))


def document_features(docs: DataFrame, keep: list[str] | tuple = ()) -> DataFrame:
    """Numeric features of ``documents``; ``n_words`` is null for a seeded
    seventh of the rows so that imputation has work."""
    words = (_count_of("text", " ") + 1).cast("double")
    return docs.select(
        "doc_id", "source", "lang", *keep,
        F.col("n_chars").cast("double").alias("n_chars"),
        F.when(residue("doc_id", NULL_EVERY) == 0, F.lit(None).cast("double"))
         .otherwise(words).alias("n_words"),
        _count_of("text", ".").cast("double").alias("n_sentences"),
        (_count_of("text", "\n") + 1).cast("double").alias("n_lines"),
        *[(F.col("lang") == lg).cast("double").alias(f"lang_{lg}") for lg in LANGS],
    )


def label_of(quality: F.Column) -> F.Column:
    return (F.when(quality == 1, F.lit(POSITIVE))
             .when(quality.isNotNull(), F.lit(NEGATIVE)))


def labelled_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Feature rows with their label (documents joined to labels by key).

    The join comes first, so only labelled texts are processed."""
    return labelled_from(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def labelled_from(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Labelled feature rows of a documents frame (batch or stream)."""
    labels = labels.select("doc_id", label_of(F.col("quality")).alias(LABEL))
    return document_features(docs.join(labels, "doc_id", "inner"), keep=[LABEL])


def scored_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as scored requests: ``score`` = value / 500, truth = purchase."""
    return scored_from(table(spark, sf_dir, "events"))


def scored_from(ev: DataFrame) -> DataFrame:
    """Scored requests from an events frame (batch or stream)."""
    return ev.select(
        "event_id", "ts", "user_id", "event_type",
        (F.col("value") / F.lit(500.0)).alias("score"),
        (F.col("event_type") == "purchase").cast("int").alias("truth"),
    )


def registry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Model-package registry stand-in from ``orders``."""
    o = table(spark, sf_dir, "orders")
    return o.select(
        F.col("o_custkey").alias("group"),
        F.concat(F.lit("pkg-"), F.col("o_orderkey").cast("string")).alias("arn"),
        F.when(F.col("o_orderstatus") == "F", "Approved")
         .when(F.col("o_orderstatus") == "P", "PendingManualApproval")
         .otherwise("Rejected").alias("status"),
        F.col("o_orderdate").alias("created_at"),
        F.col("o_orderkey").alias("package_id"),
    )


def loss_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Validation losses per training run: a user's events in order are the rounds."""
    rounds = Window.partitionBy("user_id").orderBy("event_id")
    return table(spark, sf_dir, "events").select(
        F.col("user_id").alias("series"), F.row_number().over(rounds).cast("long").alias("round"), F.col("value").alias("loss"))


# Numeric request fields rendered from lineitem, in payload order.
REQUEST_FIELDS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_suppkey"]


def request_lines(spark: SparkSession, sf_dir: str, with_label: bool, junk_every: int = 0) -> DataFrame:
    """Headerless CSV request lines (``", "`` separated) from lineitem.

    With ``with_label`` the truth label is the first field
    (``l_returnflag = 'R'`` -> positive).  With ``junk_every`` (above 6) one line in
    as many is of each malformed kind: a word, an empty field, NaN, a short and a
    long line, a quoted number and a quoted comma.
    """
    li = table(spark, sf_dir, "lineitem")
    rid = F.col("l_orderkey") * 10 + F.col("l_linenumber")
    vals = [F.col(c).cast("string") for c in REQUEST_FIELDS]
    if junk_every:
        kind = residue(rid, junk_every)
        vals[3] = (F.when(kind == 0, F.lit("RUTI")).when(kind == 1, F.lit("")).when(kind == 2, F.lit("NaN"))
                   .when(kind == 5, F.concat(F.lit('"'), vals[3], F.lit('"'))).when(kind == 6, F.lit('"1,5"'))
                   .otherwise(vals[3]))
    if with_label:
        vals = [F.when(F.col("l_returnflag") == "R", POSITIVE).otherwise(NEGATIVE)] + vals
    line = F.concat_ws(", ", *vals)
    if junk_every:
        line = (F.when(kind == 3, F.concat_ws(", ", *vals[:-1]))
                .when(kind == 4, F.concat_ws(", ", *vals, F.lit("9"), F.lit("9"))).otherwise(line))
    return li.select("l_orderkey", "l_linenumber", line.alias("line"))


def scored_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items as predictions of a request (the order): class
    probabilities ``[1 - p, p]`` with ``p = l_discount * 10``; truth by flag."""
    li = table(spark, sf_dir, "lineitem")
    p = F.round(F.col("l_discount") * 10.0, 6)
    return li.select(
        F.col("l_orderkey").alias("request_id"), F.col("l_linenumber").alias("line"),
        F.array(F.round(1.0 - p, 6), p).alias("probs"),
        F.when(F.col("l_returnflag") == "R", POSITIVE).otherwise(NEGATIVE).alias("truth_label"))


def arrivals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Object-arrival events derived from ``events``: the key depends on the
    event type (feature file, label file, other csv, other folder, non-csv);
    every tenth event (seeded) lacks its batch id."""
    return arrivals_from(table(spark, sf_dir, "events"))


def arrivals_from(ev: DataFrame) -> DataFrame:
    """Arrival events from an events frame (batch or stream)."""
    u = F.col("user_id").cast("string")
    key = (F.when(F.col("event_type") == "purchase", F.concat(F.lit("data/"), u, F.lit("/df.csv")))
           .when(F.col("event_type") == "click", F.concat(F.lit("data/"), u, F.lit("/y.csv")))
           .when(F.col("event_type") == "view", F.concat(F.lit("data/"), u, F.lit("/notes.csv")))
           .when(F.col("event_type") == "signup", F.concat(F.lit("raw/"), u, F.lit("/df.csv")))
           .otherwise(F.concat(F.lit("data/"), u, F.lit("/df.json"))))
    batch = F.when(residue("event_id", 10) == 0, F.lit(None).cast("string")).otherwise(u)
    return ev.select("event_id", "ts", F.lit("landing").alias("bucket"), key.alias("key"),
                     batch.alias("batch_id"))


def bus_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Event-bus records (source, detail-type, nested detail) from ``events``."""
    ev = table(spark, sf_dir, "events")
    is_obj = F.col("event_type").isin("purchase", "click", "view")
    source = F.when(is_obj, "object.store").otherwise("model.registry")
    dtype = F.when(is_obj, "Object Created").otherwise("Model Package State Change")
    prefix = F.when(F.col("event_type") == "view", "tmp/").otherwise("data/")
    status = F.when(F.col("event_type") == "signup", "Approved").otherwise("Rejected")
    detail = F.struct(
        F.struct(F.lit("landing").alias("name")).alias("bucket"),
        F.struct(F.concat(prefix, F.col("user_id").cast("string"), F.lit("/df.csv")).alias("key")).alias("object"),
        F.concat(F.lit("group-"), (F.col("user_id") % 3).cast("string")).alias("ModelPackageGroupName"),
        status.alias("ModelApprovalStatus"))
    return ev.select("event_id", "ts", source.alias("source"), dtype.alias("detail-type"),
                     detail.alias("detail"))


def log_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Training-log lines rendered from ``events``; the set names depend on
    the event type so some lines match no pattern."""
    ev = table(spark, sf_dir, "events")
    valid = F.when(F.col("event_type") == "view", "eval").otherwise("validation_0")
    line = F.format_string("[%d]#011train-logloss:%.5f#011%s-auc:%.5f#011train-auc:%.5f",
                           F.col("event_id"), F.col("value") / 100.0, valid,
                           F.col("value") / 500.0, F.col("value") / 490.02)
    return ev.select(F.col("event_id").alias("line_id"), line.alias("value"))


def tensors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Training tensors ``(collection, name, step, value)`` from ``events``:
    step = day of month, series by event type and user."""
    ev = table(spark, sf_dir, "events")
    fidx = (F.col("user_id") % 60).cast("string")
    coll = (F.when(F.col("event_type") == "purchase", "metrics")
            .when(F.col("event_type") == "click", "feature_importance")
            .otherwise("average_shap"))
    name = (F.when(F.col("event_type") == "purchase",
                   F.concat(F.lit("train-"), F.when(F.col("user_id") % 2 == 0, "auc").otherwise("logloss")))
            .when(F.col("event_type") == "click", F.concat(F.lit("feature_importance/gain/f"), fidx))
            .otherwise(F.concat(F.lit("average_shap/f"), fidx)))
    return ev.select(coll.alias("collection"), name.alias("name"),
                     F.dayofmonth("ts").cast("long").alias("step"), F.col("value"), "event_id")


CUTOVER = "2024-01-16"
CAPTURE_COLUMNS = ["value", "k", "user_id", "event_type"]


def capture(spark: SparkSession, sf_dir: str, window: str) -> DataFrame:
    """Captured requests from ``events``: the baseline window is before the
    cutover; the current window (from the cutover on) stands for a drifted
    feed: ``value`` shifted by -25 and ``k`` missing for a seeded fifth."""
    ev = table(spark, sf_dir, "events")
    k = F.get_json_object("props", "$.k").cast("int")
    if window == "baseline":
        return ev.where(F.col("ts") < F.lit(CUTOVER).cast("timestamp")).select(
            "event_id", "ts", "value", k.alias("k"), "user_id", "event_type")
    return ev.where(F.col("ts") >= F.lit(CUTOVER).cast("timestamp")).select(
        "event_id", "ts", (F.col("value") - 25.0).alias("value"),
        F.when(residue("event_id", 5) == 0, F.lit(None).cast("int")).otherwise(k).alias("k"),
        "user_id", "event_type")


def ground_truth(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Late truth records, one per event: a seeded tenth carry an id no
    capture has (orphans), so those captures stay unlabelled."""
    return ground_truth_from(table(spark, sf_dir, "events"))


def ground_truth_from(ev: DataFrame) -> DataFrame:
    """Late truth records from an events frame (batch or stream)."""
    eid = F.when(residue("event_id", 10) == 0, F.col("event_id") + F.lit(10 ** 12)).otherwise(F.col("event_id"))
    label = F.when(F.col("event_type") == "purchase", POSITIVE).otherwise(NEGATIVE)
    return ev.select(eid.cast("string").alias("eventId"), label.alias("label"),
                     (F.col("ts") + F.expr("INTERVAL 2 HOURS")).alias("truth_ts"))


def approval_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Approval events from ``events`` (signup and error rows): the group is
    ``user_id + 1``; error rows carry no detail (treated as approved); a
    seeded third of the others are rejected."""
    ev = table(spark, sf_dir, "events").where(F.col("event_type").isin("signup", "error"))
    status = F.when(residue("event_id", 3) == 0, "Rejected").otherwise("Approved")
    detail = F.when(F.col("event_type") == "error", F.lit(None)).otherwise(
        F.struct(status.alias("ModelApprovalStatus")))
    return ev.select("event_id", "ts", (F.col("user_id") + 1).alias("group"), detail.alias("detail"))



def run_outputs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Step outputs of a run (an order): one per line item, named by the
    return flag, with a folder-style URI."""
    li = table(spark, sf_dir, "lineitem")
    name = (F.when(F.col("l_returnflag") == "R", "train").when(F.col("l_returnflag") == "A", "validation")
            .otherwise("test"))
    uri = F.concat(F.lit("runs/"), F.col("l_orderkey").cast("string"), F.lit("/"), name, F.lit("/"),
                   F.col("l_linenumber").cast("string"), F.lit(".csv"))
    return li.select(F.col("l_orderkey").alias("package_id"), F.col("l_linenumber").alias("step"),
                     name.alias("output_name"), uri.alias("uri"))
