"""Registered queries: one per operator of the inventory.

Each entry takes ``(spark, sf_dir)`` and returns a DataFrame over the whole
given tables.  Floating results are rounded to 6 places so they compare
exactly with the SQL oracle (``umpire.plans.oracle``).
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from umpire.functions import events as EV
from umpire.functions import scoring as S
from umpire.functions.hashing import residue
from umpire.operators import bias as B
from umpire.operators import boosting as BT
from umpire.operators import explain as X
from umpire.operators import joins as J
from umpire.operators import metrics as M
from umpire.operators import nearest as NN
from umpire.operators import prepare as P
from umpire.operators import quality as Q
from umpire.operators import registry as R
from umpire.operators import sampling as W
from umpire.operators import statistics as ST
from umpire.plans import lifecycle as LC
from umpire.plans import model as MD
from umpire.plans.prepared import IMPUTED, fitted, prepared, rule_score, split_rows
from umpire.plans.training import trained
from umpire.schemas import FEATURE_COLUMNS, LABEL
from umpire.session import input_stamp, shared_dir, table
from umpire.sources import artifacts as AR
from umpire.sources import payloads as PL
from umpire.sources import sinks as SK
from umpire.sources import testdata as TD
from umpire.sources.testdata import DOC_FEATURES, scored_events
from umpire.streaming import monitor as SM
from umpire.streaming import rendezvous as RV
from umpire.streaming.runner import run_available_now, run_to_end, table_stream, ticking

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}


def register(name: str):
    def deco(fn: Query) -> Query:
        REGISTRY[name] = fn
        return fn
    return deco


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    """Round every double column (engines may differ in the last bits)."""
    return df.select(*[F.round(F.col(f.name), digits).alias(f.name)
                       if isinstance(f.dataType, (T.DoubleType, T.FloatType)) else F.col(f.name)
                       for f in df.schema.fields])


# ---------------------------------------------------------------- sources
@register("s2_zip_columns")
def s2_zip_columns(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "lang", "n_chars")
    labels = table(spark, sf, "labels")
    return P.zip_columns(docs, labels, key="doc_id")


@register("s3_union_parts")
def s3_union_parts(spark, sf):
    li = table(spark, sf, "lineitem")
    first = li.where(F.col("l_linenumber") <= 3)
    rest = li.where(F.col("l_linenumber") > 3)
    u = P.union_parts(first, rest)
    return rounded(u.groupBy("l_returnflag", "l_linestatus").agg(
        F.count(F.lit(1)).alias("rows"), F.sum("l_quantity").alias("sum_qty")))


# ---------------------------------------------------------------- preparation
@register("w1_shuffle_rank")
def w1_shuffle_rank(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id")
    return P.shuffle_rank(docs, "doc_id", seed=42)


@register("w2_stratified_split")
def w2_stratified_split(spark, sf):
    return split_rows(spark, sf).select("doc_id", LABEL, "split")


@register("a1_fit_medians")
def a1_fit_medians(spark, sf):
    train = split_rows(spark, sf).where(F.col("split") == "train")
    return rounded(P.median_table(train, IMPUTED))


@register("a1_impute")
def a1_impute(spark, sf):
    rows, medians, _ = fitted(spark, sf)
    return rounded(P.impute(rows, medians).select("doc_id", "split", *IMPUTED))


@register("a2_encode_label")
def a2_encode_label(spark, sf):
    rows, _, classes = fitted(spark, sf)
    return P.encode(rows, LABEL, classes, name="y").select("doc_id", LABEL, "y")


@register("a3_decode_label")
def a3_decode_label(spark, sf):
    df = prepared(spark, sf)
    return P.decode(df, "y", ["home_not_win", "home_win"], name="decoded").select("doc_id", "y", "decoded")


@register("s7_test_baseline")
def s7_test_baseline(spark, sf):
    rows = split_rows(spark, sf).where(F.col("split") == "test").drop("split", "source", "lang")
    return P.baseline(rows, LABEL, keep_label=True)


@register("s7_train_baseline")
def s7_train_baseline(spark, sf):
    rows = split_rows(spark, sf).where(F.col("split") == "train").drop("split", "source", "lang")
    return P.baseline(rows, LABEL, keep_label=False)


# ---------------------------------------------------------------- metrics and gate
def _test_metrics(spark, sf) -> DataFrame:
    test = rule_score(prepared(spark, sf)).where(F.col("split") == "test")
    return M.binary_metrics(test, "y", "yhat")


@register("a4_binary_metrics")
def a4_binary_metrics(spark, sf):
    return rounded(_test_metrics(spark, sf))


@register("s8_report_json")
def s8_report_json(spark, sf):
    return M.report_json(rounded(_test_metrics(spark, sf)))


@register("a6_report_value")
def a6_report_value(spark, sf):
    rep = M.report_json(rounded(_test_metrics(spark, sf)))
    return M.report_value(rep, "$.metrics.precision.value", name="precision").select("precision")


@register("a5_quality_gate")
def a5_quality_gate(spark, sf):
    return M.gate(M.report_json(rounded(_test_metrics(spark, sf))), threshold=0.6)


@register("a7_model_quality")
def a7_model_quality(spark, sf):
    return rounded(M.model_quality(scored_events(spark, sf), "truth", "score", threshold=0.55))


@register("a8_roc_points")
def a8_roc_points(spark, sf):
    return rounded(M.roc_points(scored_events(spark, sf), "truth", "score"))


@register("a8_auc")
def a8_auc(spark, sf):
    return rounded(M.auc(scored_events(spark, sf), "truth", "score"))


# ---------------------------------------------------------------- request parsing

KEYS = ["l_orderkey", "l_linenumber"]


@register("s4_csv_lines")
def s4_csv_lines(spark, sf):
    lines = TD.request_lines(spark, sf, with_label=False)
    return PL.parse_csv_lines(lines, "line", TD.REQUEST_FIELDS, keep=KEYS, reject="rejected")


@register("f2_split_truth")
def f2_split_truth(spark, sf):
    lines = TD.request_lines(spark, sf, with_label=True)
    return PL.parse_csv_lines(lines, "line", TD.REQUEST_FIELDS, label="ground_truth", keep=KEYS, reject="rejected")


@register("f3_coerce_numeric")
def f3_coerce_numeric(spark, sf):
    lines = TD.request_lines(spark, sf, with_label=False, junk_every=50)
    return PL.parse_csv_lines(lines, "line", TD.REQUEST_FIELDS, keep=KEYS, reject="rejected")


@register("f4_strict_reject")
def f4_strict_reject(spark, sf):
    lines = TD.request_lines(spark, sf, with_label=False, junk_every=50)
    named = S.name_fields(lines, "line", TD.REQUEST_FIELDS, keep=KEYS, reject="bad_width")
    checked = S.to_numeric(named, TD.REQUEST_FIELDS, mode="strict", reject="bad_width")
    bad = F.col("bad_values") > 0
    return checked.groupBy("l_orderkey").agg(
        F.count(F.lit(1)).alias("lines"), F.sum(bad.cast("long")).alias("bad_lines"), F.max(bad).alias("rejected"))


@register("f5_numeric_columns")
def f5_numeric_columns(spark, sf):
    li = table(spark, sf, "lineitem")
    return li.select(*S.numeric_columns(li))


# ---------------------------------------------------------------- labels and responses
def _predictions(spark, sf) -> DataFrame:
    sl = TD.scored_lines(spark, sf)
    return sl.select("request_id", "line", *S.prediction_record(F.col("probs"), F.col("truth_label")))


@register("f6_map_values")
def f6_map_values(spark, sf):
    df = prepared(spark, sf)
    return df.select("doc_id", "y", S.map_values(F.col("y"), {1.0: "home_win", 0.0: "home_not_win"})
                     .alias("label"))


@register("f7_argmax_label")
def f7_argmax_label(spark, sf):
    return _predictions(spark, sf)


@register("f8_numeric_flags")
def f8_numeric_flags(spark, sf):
    return _predictions(spark, sf).select("request_id", "line", "numerical_ground_truth_label",
                                          "predicted_numerical_label")


def _prediction_inputs(spark, sf) -> DataFrame:
    sl = TD.scored_lines(spark, sf)
    body = F.concat(F.lit('{"predictions": ['), F.col("probs")[1].cast("string"), F.lit(", "),
                    F.col("probs")[0].cast("string"), F.lit("]}"))
    return sl.select("request_id", "line", body.alias("body"))


@register("s14_parse_predictions")
def s14_parse_predictions(spark, sf):
    return PL.parse_predictions(_prediction_inputs(spark, sf), "body", "application/json",
                                keep=["request_id", "line"])


@register("f9_threshold_label")
def f9_threshold_label(spark, sf):
    preds = PL.parse_predictions(_prediction_inputs(spark, sf), "body", "application/json",
                                 keep=["request_id", "line"])
    return preds.select("request_id", "line", "position",
                        S.threshold_label(F.col("prediction"), 0.5).alias("label"),
                        F.col("prediction").alias("confidence"))


@register("s10_csv_response")
def s10_csv_response(spark, sf):
    p = _predictions(spark, sf)
    return p.select("request_id", "line", SK.csv_response(p, with_truth=True).alias("csv5"),
                    SK.csv_response(p, with_truth=False).alias("csv3"))


@register("s11_json_response")
def s11_json_response(spark, sf):
    return SK.json_response(_predictions(spark, sf), "request_id", "line", with_truth=True)


@register("s12_jsonlines_response")
def s12_jsonlines_response(spark, sf):
    p = _predictions(spark, sf)
    return p.select("request_id", "line", SK.jsonlines_response(with_truth=False).alias("body"))


@register("s13_unwrap_single")
def s13_unwrap_single(spark, sf):
    return SK.json_response(_predictions(spark, sf), "request_id", "line", with_truth=False,
                            unwrap_single=True)


@register("s13_pair_csv")
def s13_pair_csv(spark, sf):
    return _predictions(spark, sf).select("request_id", "line", SK.pair_csv().alias("body"))


@register("s16_matrix_csv")
def s16_matrix_csv(spark, sf):
    parsed = s4_csv_lines(spark, sf)
    return parsed.select(*KEYS, SK.matrix_csv(TD.REQUEST_FIELDS).alias("row"))


# ---------------------------------------------------------------- records
@register("f10_record_map")
def f10_record_map(spark, sf):
    lines = TD.request_lines(spark, sf, with_label=False)
    return lines.select(*KEYS, F.explode(S.record_map(F.col("line"))).alias("key", "value"))


@register("f11_last_columns")
def f11_last_columns(spark, sf):
    ev = TD.scored_events(spark, sf)
    truth = F.when(F.col("truth") == 1, "home_win").otherwise("home_not_win")
    joined = ev.select("event_id", "user_id", "score",
                       *S.prediction_record(F.array(1.0 - F.col("score"), F.col("score")), truth))
    return rounded(S.last_columns(joined, 4))


@register("f12_name_features")
def f12_name_features(spark, sf):
    return TD.tensors(spark, sf).select("event_id", "name").transform(
        lambda d: S.name_features(d, "name", FEATURE_COLUMNS))


@register("f13_filter_series")
def f13_filter_series(spark, sf):
    return S.filter_series(TD.tensors(spark, sf), "name", r"average_shap/.*", limit=35).select(
        "event_id", "name", "step")


@register("f17_csv_payload")
def f17_csv_payload(spark, sf):
    df = prepared(spark, sf)
    return df.select(F.col("doc_id").cast("string").alias("inference_id"),
                     S.csv_payload(IMPUTED).alias("payload"))


@register("f18_synthetic_label")
def f18_synthetic_label(spark, sf):
    ev = table(spark, sf, "events")
    return ev.select("event_id", S.synthetic_label("event_id").alias("label"))


@register("s9_ground_truth_records")
def s9_ground_truth_records(spark, sf):
    ev = table(spark, sf, "events").select("event_id", "ts", S.synthetic_label("event_id").alias("label"))
    return SK.ground_truth_events(ev, "event_id", "label", "ts")


# ---------------------------------------------------------------- event rules
@register("f14_classify_arrivals")
def f14_classify_arrivals(spark, sf):
    return EV.classify_arrivals(TD.arrivals(spark, sf)).select(
        "event_id", "status", "file_type", "folder", "message")


ARRIVAL_RULE = {"source": ["object.store"], "detail-type": ["Object Created"],
                "detail": {"bucket": {"name": ["landing"]}, "object": {"key": [{"prefix": "data/"}]}}}


@register("f15_match_events")
def f15_match_events(spark, sf):
    return EV.match_events(TD.bus_events(spark, sf), ARRIVAL_RULE).select(
        "event_id", F.col("detail.object.key").alias("key"))


@register("f16_log_metrics")
def f16_log_metrics(spark, sf):
    return rounded(EV.extract_log_metrics(TD.log_lines(spark, sf), keep=["line_id"]))


# ---------------------------------------------------------------- joins


def _captures(spark, sf) -> DataFrame:
    ev = TD.scored_events(spark, sf)
    return ev.select(F.col("event_id").cast("string").alias("inference_id"), "score",
                     (F.col("score") > 0.1).cast("int").alias("yhat"))


@register("j1_match_truth")
def j1_match_truth(spark, sf):
    m = J.match_truth(_captures(spark, sf), TD.ground_truth(spark, sf), "inference_id", "eventId")
    return rounded(m.select("inference_id", "score", "yhat", "label"))


@register("j2_unlabelled_captures")
def j2_unlabelled_captures(spark, sf):
    no_truth, _ = J.unmatched(_captures(spark, sf), TD.ground_truth(spark, sf), "inference_id", "eventId")
    return no_truth.select("inference_id")


@register("j2_orphan_truths")
def j2_orphan_truths(spark, sf):
    _, orphans = J.unmatched(_captures(spark, sf), TD.ground_truth(spark, sf), "inference_id", "eventId")
    return orphans.select("eventId", "label")


@register("j3_join_input_output")
def j3_join_input_output(spark, sf):
    p = TD.scored_lines(spark, sf).select(
        "request_id", "line", F.col("probs")[1].alias("p"),
        *S.prediction_record(F.col("probs")))
    return J.join_input_output(p, ["request_id", "line", "p"],
                               ["predicted_label", "predicted_numerical_label"])


def _variants(spark, sf) -> DataFrame:
    ev = TD.scored_events(spark, sf)
    prod = ev.select("event_id", "truth", (F.col("score") > 0.1).cast("int").alias("yhat"))
    shadow = ev.select("event_id", (F.col("score") * 1.1 + 0.01 > 0.1).cast("int").alias("yhat"))
    pairs = J.pair_variants(prod, shadow, "event_id", ["yhat"])
    return pairs.join(prod.select("event_id", "truth"), "event_id")


@register("j4_pair_variants")
def j4_pair_variants(spark, sf):
    return _variants(spark, sf).select("event_id", "prod_yhat", "shadow_yhat")


@register("a14_compare_variants")
def a14_compare_variants(spark, sf):
    return rounded(R.compare_variants(_variants(spark, sf), "truth", "prod_yhat", "shadow_yhat"))


@register("j5_align_rows")
def j5_align_rows(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "lang")
    emb = table(spark, sf, "embeddings").select("vec_id", "label")
    return J.align_rows(docs, emb).select("row_id", "doc_id", "lang", "vec_id", "label")


# ---------------------------------------------------------------- registry
@register("w3_latest_approved")
def w3_latest_approved(spark, sf):
    return R.latest_approved(TD.registry(spark, sf))


@register("w4_latest_package")
def w4_latest_package(spark, sf):
    reg = TD.registry(spark, sf)
    return R.latest(reg, "group", "created_at", "package_id", ["arn", "status"]).select(
        "group", F.date_format("latest_created_at", "yyyy-MM-dd").alias("latest_created"), "arn", "status")


@register("t6_deploy_decision")
def t6_deploy_decision(spark, sf):
    return R.deploy_decision(TD.approval_events(spark, sf), TD.registry(spark, sf))


# ---------------------------------------------------------------- sampling
@register("w5_sample_with_replacement")
def w5_sample_with_replacement(spark, sf):
    emb = table(spark, sf, "embeddings").select("vec_id", "label")
    return W.sample_with_replacement(emb, n=100, seed=42).select("draw", "vec_id", "label")


@register("w6_zscore_outliers")
def w6_zscore_outliers(spark, sf):
    emb = table(spark, sf, "embeddings").select("vec_id", W.row_sum("embedding", base_last=True).alias("row_sum"))
    return rounded(W.zscore_outliers(emb, "row_sum", "vec_id", n=3))


@register("w7_capture_sample")
def w7_capture_sample(spark, sf):
    return W.capture_sample(TD.scored_events(spark, sf), "event_id", 30).select("event_id")


# ---------------------------------------------------------------- data and model quality
@register("a9_profile")
def a9_profile(spark, sf):
    return rounded(Q.profile(TD.capture(spark, sf, "baseline"), TD.CAPTURE_COLUMNS))


@register("a9_histogram")
def a9_histogram(spark, sf):
    return rounded(Q.histogram(TD.capture(spark, sf, "baseline"), ["value", "k", "user_id"]))


def _state(spark, sf, window: str) -> DataFrame:
    """Hourly states of a capture window, written, read back and merged."""
    path = shared_dir(spark, f"a9_{window}_state")
    ST.column_state(TD.capture(spark, sf, window), TD.CAPTURE_COLUMNS, ts="ts").write.parquet(path)
    return ST.merge_state(spark.read.parquet(path))


@register("a9_merged_profile")
def a9_merged_profile(spark, sf):
    """The baseline profile from hourly states; distinct counts within three parts in a hundred."""
    exact = Q.profile(TD.capture(spark, sf, "baseline"), TD.CAPTURE_COLUMNS).select("column", F.col("distinct").alias("want"))
    merged = ST.profile_of(_state(spark, sf, "baseline")).join(exact, "column")
    close = F.abs(F.col("distinct") - F.col("want")) <= 0.03 * F.col("want")
    return rounded(merged.withColumn("distinct_close", close).drop("distinct", "want"))


def _document(spark, document: DataFrame, name: str) -> DataFrame:
    path = shared_dir(spark, name)
    document.coalesce(1).write.text(path)
    return spark.read.text(path, wholetext=True)


@register("a9_statistics_document")
def a9_statistics_document(spark, sf):
    """The statistics document written as JSON text and read again."""
    stats = Q.profile(TD.capture(spark, sf, "baseline"), TD.CAPTURE_COLUMNS)
    return rounded(ST.read_statistics(_document(spark, ST.statistics_document(stats), "a9_statistics"), "value"))


@register("a10_constraints_document")
def a10_constraints_document(spark, sf):
    """The constraints document written as JSON text and read again."""
    limits = Q.suggest_constraints(Q.profile(TD.capture(spark, sf, "baseline"), TD.CAPTURE_COLUMNS))
    return rounded(ST.read_constraints(_document(spark, ST.constraints_document(limits), "a10_constraints"), "value"))


@register("a12_sketch_drift")
def a12_sketch_drift(spark, sf):
    """Exact drift, and whether the drift of merged hourly states is within its bound of it."""
    cols = ["value", "k", "user_id"]
    exact = Q.drift(TD.capture(spark, sf, "baseline"), TD.capture(spark, sf, "current"), cols)
    near = ST.sketch_drift(_state(spark, sf, "baseline"), _state(spark, sf, "current")).select(
        "column", F.col("ks_distance").alias("near"), F.col("n_base").alias("b"), F.col("n_current").alias("c"))
    within = (F.abs(F.col("near") - F.col("ks_distance")) <= ST.drift_error()) & (F.col("b") == F.col("n_base")) & (F.col("c") == F.col("n_current"))
    return rounded(exact.join(near, "column").select("column", "ks_distance", "n_base", "n_current", within.alias("within_bound")))


@register("a10_suggest_constraints")
def a10_suggest_constraints(spark, sf):
    stats = Q.profile(TD.capture(spark, sf, "baseline"), TD.CAPTURE_COLUMNS)
    return rounded(Q.suggest_constraints(stats))


@register("a11_violations")
def a11_violations(spark, sf):
    cons = Q.suggest_constraints(Q.profile(TD.capture(spark, sf, "baseline"), TD.CAPTURE_COLUMNS))
    cur = Q.profile(TD.capture(spark, sf, "current"), TD.CAPTURE_COLUMNS)
    return Q.violations(cur, cons)


@register("a12_drift")
def a12_drift(spark, sf):
    return rounded(Q.drift(TD.capture(spark, sf, "baseline"), TD.capture(spark, sf, "current"),
                           ["value", "k", "user_id"]))


def _window_metrics(spark, sf, window: str) -> DataFrame:
    ev = TD.scored_events(spark, sf)
    cut = F.lit(TD.CUTOVER).cast("timestamp")
    ev = ev.where(F.col("ts") < cut) if window == "baseline" else ev.where(F.col("ts") >= cut)
    return M.model_quality(ev, "truth", "score", threshold=0.1)


@register("a13_model_quality_check")
def a13_model_quality_check(spark, sf):
    metrics = ["accuracy", "precision", "recall", "f1"]
    return rounded(Q.quality_violations(_window_metrics(spark, sf, "current"),
                                        _window_metrics(spark, sf, "baseline"), metrics))


# ---------------------------------------------------------------- bias

FACET_THRESHOLD = 1000.0


def _bias_rows(spark, sf) -> DataFrame:
    df = prepared(spark, sf)
    p = 1.0 / (1.0 + F.exp(-(F.col("n_words") - 200.0) / 100.0))
    return df.select("doc_id", "source", "n_chars", "y",
                     B.facet("n_chars", FACET_THRESHOLD).alias("facet"),
                     (p > 0.65).cast("int").alias("yhat"))


@register("a20_facet")
def a20_facet(spark, sf):
    return _bias_rows(spark, sf).select("doc_id", "facet")


@register("a17_pretraining_bias")
def a17_pretraining_bias(spark, sf):
    return rounded(B.pretraining_bias(_bias_rows(spark, sf), F.col("facet"), "y", "source"))


@register("a18_posttraining_bias")
def a18_posttraining_bias(spark, sf):
    return rounded(B.posttraining_bias(_bias_rows(spark, sf), F.col("facet"), "y", "yhat", "source"))


@register("a19_flip_test")
def a19_flip_test(spark, sf):
    df = prepared(spark, sf)
    p = 1.0 / (1.0 + F.exp(-(F.col("n_words") - 200.0) / 100.0))
    rows = df.select(B.facet("n_chars", FACET_THRESHOLD).alias("facet"), (p > 0.65).cast("int").alias("yhat"),
                     F.floor(F.col("n_sentences") / 5).alias("sentences"), F.floor(F.col("n_lines") / 5).alias("lines"))
    return rounded(B.flip_test(rows, F.col("facet"), "yhat", ["sentences", "lines"]))


NEAR_FEATURES = ["n_words", "n_sentences", "n_lines"]


def _near_rows(spark, sf) -> DataFrame:
    p = 1.0 / (1.0 + F.exp(-(F.col("n_words") - 200.0) / 100.0))
    return prepared(spark, sf).select("doc_id", *NEAR_FEATURES, B.facet("n_chars", FACET_THRESHOLD).alias("facet"), (p > 0.65).cast("int").alias("yhat"))


@register("a19_nearest_flip_test")
def a19_nearest_flip_test(spark, sf):
    """The flip test by the five nearest rows of the other facet, found exactly."""
    return rounded(NN.nearest_flip_test(_near_rows(spark, sf), F.col("facet"), "yhat", NEAR_FEATURES, "doc_id"))


@register("a19_hashed_neighbours")
def a19_hashed_neighbours(spark, sf):
    """How many of the nearest rows the hashed way finds: the members, and whether at least nine in ten."""
    rows = _near_rows(spark, sf)
    found, exact = (NN.nearest_points(rows, F.col("facet"), "yhat", NEAR_FEATURES, "doc_id", method=m).checkpoint() for m in ("hashed", "exact"))
    share = NN.recall(found, exact).first()["recall"]
    return found.agg(F.countDistinct("id").alias("members")).select("members", F.lit(share is None or share >= 0.9).alias("recall_reached"))


# ---------------------------------------------------------------- explanations
def _shap(spark, sf) -> DataFrame:
    return table(spark, sf, "embeddings").select("vec_id", "embedding")


@register("a15_global_importance")
def a15_global_importance(spark, sf):
    return rounded(X.global_importance(X.shap_long(_shap(spark, sf), "vec_id", "embedding")))


@register("a16_metric_series")
def a16_metric_series(spark, sf):
    return rounded(X.metric_series(TD.tensors(spark, sf), "metrics", ["train-auc", "train-logloss"]))


@register("m9_explain_rows")
def m9_explain_rows(spark, sf):
    return rounded(X.explain_rows(_shap(spark, sf), "vec_id", "embedding"))


# ---------------------------------------------------------------- streaming


@register("t1_rendezvous_batch")
def t1_rendezvous_batch(spark, sf):
    return RV.rendezvous_batch(EV.classify_arrivals(TD.arrivals(spark, sf)))


def _after(spark, sf, hours: int):
    """A time by which all that ``hours`` hold open is over; none without events."""
    last = table(spark, sf, "events").agg(F.max("ts").cast("timestamp").alias("ts")).first()["ts"]
    return None if last is None else last + dt.timedelta(hours=hours, seconds=1)


@register("t1_rendezvous_stream")
def t1_rendezvous_stream(spark, sf):
    """All arrivals, then, restarted from its checkpoint, the tick that answers the last hour's."""
    def query(folder):
        return RV.rendezvous_stream(SM.arrivals_stream(ticking(table_stream(spark, sf, "events"), folder)))
    return run_to_end(query, "t1_rendezvous", spark, _after(spark, sf, 1))


@register("t2_arrivals_stream")
def t2_arrivals_stream(spark, sf):
    arr = SM.arrivals_stream(table_stream(spark, sf, "events"))
    out = run_available_now(arr.select("event_id", "status", "file_type", "folder", "message"), "t2_arrivals")
    return out


@register("t3_windowed_monitor")
def t3_windowed_monitor(spark, sf):
    """All windows: the last ones close in a second run, by a tick."""
    def query(folder):
        scored = ticking(TD.scored_from(table_stream(spark, sf, "events")), folder)
        return SM.windowed_monitor(scored, "1 hour", "1 hour", threshold=0.1)
    out = run_to_end(query, "t3_monitor", spark, _after(spark, sf, 2))
    return rounded(out.select(F.date_format("window_start", "yyyy-MM-dd HH:mm:ss").alias("window_start"),
                              "n", "mean_score", "min_score", "max_score", "std_score",
                              "tp", "fp", "fn", "precision", "recall"))


def _stream_captures(ev: DataFrame) -> DataFrame:
    return TD.scored_from(ev).select(F.col("event_id").cast("string").alias("inference_id"), "ts", "score",
                                     (F.col("score") > 0.1).cast("int").alias("yhat"))


@register("t4_late_truth_join")
def t4_late_truth_join(spark, sf):
    caps = _stream_captures(table_stream(spark, sf, "events"))
    truth = TD.ground_truth_from(table_stream(spark, sf, "events"))
    out = run_available_now(SM.late_truth_join(caps, truth, "3 hours", "3 hours")
                            .select("inference_id", "score", "yhat", "label"), "t4_late_truth")
    return rounded(out)


@register("t4_all_captures")
def t4_all_captures(spark, sf):
    """Every capture with its late truth, or null once the watermarks give it up."""
    def query(folder):
        caps = ticking(_stream_captures(table_stream(spark, sf, "events")), folder, key="inference_id")
        truth = ticking(TD.ground_truth_from(table_stream(spark, sf, "events")), folder, "truth_ts", key="eventId")
        return SM.late_truth_join(caps, truth, "3 hours", "3 hours", "left_outer").select("inference_id", "score", "yhat", "label")
    return rounded(run_to_end(query, "t4_all_captures", spark, _after(spark, sf, 9)))


@register("t5_score_stream")
def t5_score_stream(spark, sf):
    scored = SM.score_requests(table_stream(spark, sf, "events").withColumn("score", F.col("value") / 500.0))
    out = run_available_now(scored, "t5_capture", foreach=SM.capture_writer())
    return rounded(out.drop("epoch"))


# ---------------------------------------------------------------- model operators


@register("m1_fit_trees")
def m1_fit_trees(spark, sf):
    """A row per tree of the fitted ensemble."""
    t = trained(spark, sf)
    return rounded(t.model.nodes(spark).groupBy("tree").agg(
        F.count(F.lit(1)).alias("num_nodes"), F.sum("gain").alias("total_gain"), F.max(F.when(F.col("node") == 0, F.col("cover"))).alias("cover")))


SMALL_TREE = MD.TreeParams(rounds=1, max_depth=2, subsample=1.0, colsample=1.0)


@register("m1_small_tree")
def m1_small_tree(spark, sf):
    """The first tree at depth 2 over all training rows: splits, gains and leaf values."""
    rows, medians, classes = fitted(spark, sf)
    train = MD.target_stage(classes, LABEL).transform(rows.where(F.col("split") == "train"))
    model, _ = BT.fit(train, None, DOC_FEATURES, medians, SMALL_TREE)
    names = F.array(*[F.lit(f) for f in DOC_FEATURES])
    return rounded(model.nodes(spark).select(
        F.col("node").cast("long").alias("node"), F.when(F.col("feature") >= 0, F.element_at(names, F.greatest("feature", F.lit(0)) + 1)).alias("feature"),
        F.when(F.col("feature") >= 0, F.col("threshold")).alias("threshold"), "gain", "value", "cover", F.col("rows").alias("n")))


@register("m1_nodes_check")
def m1_nodes_check(spark, sf):
    """Identities of the fitted trees, a row per kept tree: a split's cover and rows are its
    children's, its gain and both shares meet the trainer's bounds."""
    t = trained(spark, sf)
    nodes = t.model.nodes(spark)
    inner = nodes.where("feature >= 0")
    child = nodes.select("tree", F.col("node").alias("child"), F.col("cover").alias("c"), F.col("rows").alias("n"))
    both = inner.select("tree", "node", "gain", "cover", "rows", F.explode(F.array("left", "right")).alias("child")).join(child, ["tree", "child"])
    sums = both.groupBy("tree", "node", "gain", "cover", "rows").agg(F.sum("c").alias("c"), F.sum("n").alias("n"), F.min("c").alias("least"))
    ok = (F.abs(F.col("c") - F.col("cover")) < 1e-6) & (F.col("n") == F.col("rows")) & (F.col("gain") > 0) & (F.col("least") >= MD.TreeParams().min_child_weight - 1e-6)
    checked = sums.groupBy("tree").agg(F.min(ok).alias("splits_hold"))
    return nodes.select("tree").distinct().join(checked, "tree", "left").agg(F.min(F.coalesce("splits_hold", F.lit(True))).alias("splits_hold"),
                                                                            (F.count(F.lit(1)) == t.kept).alias("all_kept"))


@register("m2_best_prefix")
def m2_best_prefix(spark, sf):
    t = trained(spark, sf)
    rows = [(i + 1, float(v), i + 1 <= t.kept) for i, v in enumerate(t.losses)]
    return rounded(spark.createDataFrame(rows, "round int, validation_loss double, kept boolean"))


@register("m2_prefix_choice")
def m2_prefix_choice(spark, sf):
    return MD.prefix_choice(TD.loss_series(spark, sf), "series", "round", "loss", patience=25)


@register("m3_score")
def m3_score(spark, sf):
    t = trained(spark, sf)
    return rounded(MD.score(t.model, t.test).select("doc_id", "y", "p", "yhat"))


@register("m3_score_check")
def m3_score_check(spark, sf):
    """Each test row's probability against a walk through the node table by joins."""
    t = trained(spark, sf)
    walked = BT.relational_margins(t.model.nodes(spark), t.test, t.model, "doc_id", MD.TreeParams().max_depth)
    p = 1.0 / (1.0 + F.exp(-F.col("margin")))
    return (MD.score(t.model, t.test).join(walked, "doc_id")
            .select("doc_id", "y", (F.abs(F.col("p") - p) < 1e-9).alias("same_p"), ((p > 0.5).cast("int") == F.col("yhat")).alias("same_label")))


@register("m4_validation_f1")
def m4_validation_f1(spark, sf):
    t = trained(spark, sf)
    return rounded(MD.validation_f1(t.model, t.valid))


@register("m4_f1_check")
def m4_f1_check(spark, sf):
    """Validation F1 against its definition over the walked labels, and the class totals."""
    t = trained(spark, sf)
    walked = BT.relational_margins(t.model.nodes(spark), t.valid, t.model, "doc_id", MD.TreeParams().max_depth)
    hit, pos = F.col("margin") > 0, F.col("y") == 1
    sums = t.valid.join(walked, "doc_id").agg(
        F.sum((hit & pos).cast("long")).alias("tp"), F.sum((hit & ~pos).cast("long")).alias("fp"), F.sum((~hit & pos).cast("long")).alias("fn"),
        F.count(F.lit(1)).alias("rows"), F.sum(pos.cast("long")).alias("positives")).first()
    tp, fp, fn = sums["tp"], sums["fp"], sums["fn"]
    want = 2 * tp / (2 * tp + fp + fn) if tp else 0.0
    return MD.validation_f1(t.model, t.valid).select(
        (F.abs(F.col("f1") - want) < 1e-9).alias("same_f1"), F.lit(sums["rows"]).cast("long").alias("rows"), F.lit(sums["positives"]).cast("long").alias("positives"))


_TRIALS: dict = {}


def _trials(spark, sf):
    """The search's trial table, kept per session like the trained model
    (the search is seeded, so a second run would give the same rows)."""
    key = input_stamp(spark, sf, "documents", "labels")
    if key not in _TRIALS:
        t = trained(spark, sf)
        _TRIALS[key] = MD.search(spark, t.train, t.valid, DOC_FEATURES, t.medians, n=5, parallel=2).cache()
    return _TRIALS[key]


@register("m5_search")
def m5_search(spark, sf):
    return rounded(_trials(spark, sf))


@register("m5_search_check")
def m5_search_check(spark, sf):
    """A row per trial: its settings lie in their ranges, and from the third on they are
    those that the trials before propose."""
    rows = sorted(_trials(spark, sf).collect())
    names = [r[0] for r in MD.RANGES]
    done = [({n: r[n] for n in names}, r["auc"]) for r in rows]
    want = MD.sample_params(5)[:2] + MD.propose(done[:2], 2) + MD.propose(done[:4], 1)
    out = [(i, all(lo <= r[n] <= hi for n, lo, hi, _ in MD.RANGES), all(abs(r[n] - w[n]) < 1e-9 for n in names))
           for i, (r, w) in enumerate(zip(rows, want))]
    return spark.createDataFrame(out, "trial long, in_range boolean, as_proposed boolean")


@register("m6_best_trial")
def m6_best_trial(spark, sf):
    return rounded(MD.best_trial(_trials(spark, sf)))


@register("m6_best_of_runs")
def m6_best_of_runs(spark, sf):
    """The best of the runs that ``events`` stand for, one trial per user."""
    trials = table(spark, sf, "events").groupBy(F.col("user_id").alias("trial")).agg(
        F.max("value").alias("auc"), F.min("value").alias("eta"))
    return MD.best_trial(trials)


@register("m7_tree_importance")
def m7_tree_importance(spark, sf):
    t = trained(spark, sf)
    path = shared_dir(spark, "m7_trees")
    t.model.save(spark, path)
    nodes = spark.read.parquet(f"{path}/nodes")
    parts = [MD.tree_importance(nodes, DOC_FEATURES, k) for k in MD.IMPORTANCE_TYPES]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return rounded(out)


@register("m7_importance_check")
def m7_importance_check(spark, sf):
    """The kinds agree with each other and with the trees, a row per kind."""
    t = trained(spark, sf)
    wide = m7_tree_importance(spark, sf).groupBy("j").pivot("importance_type", MD.IMPORTANCE_TYPES).agg(F.first("importance"))
    splits, gains, covers = (float(sum(f(tree) for tree in t.model.trees)) for f in (
        lambda x: (x.feature >= 0).sum(), lambda x: x.gain.sum(), lambda x: x.cover[x.feature >= 0].sum()))
    means = F.abs(F.col("gain") * F.col("weight") - F.col("total_gain")) < 1e-3
    sums = wide.agg(F.sum("weight").alias("weight"), F.sum("total_gain").alias("total_gain"), F.sum("total_cover").alias("total_cover"), F.min(means).alias("gain")).first()
    return spark.createDataFrame([("weight", sums["weight"] == splits), ("gain", bool(sums["gain"])), ("total_gain", abs(sums["total_gain"] - gains) < 1e-3),
                                  ("total_cover", abs(sums["total_cover"] - covers) < 1e-3)], "importance_type string, holds boolean")


@register("m8_shapley")
def m8_shapley(spark, sf):
    """Exact Shapley values of every training row."""
    t = trained(spark, sf)
    return rounded(X.tree_shapley(t.model, t.train, "doc_id"))


@register("m8_shapley_check")
def m8_shapley_check(spark, sf):
    """Per training row: its values and the base sum to its raw score."""
    t = trained(spark, sf)
    sums = X.tree_shapley(t.model, t.train, "doc_id").groupBy("doc_id").agg(
        (F.sum("phi") + F.max("base")).alias("total"), F.count(F.lit(1)).alias("n_features"))
    raw = BT.margins(t.model, t.train).select("doc_id", "margin")
    return sums.join(raw, "doc_id").select("doc_id", "n_features", (F.abs(F.col("total") - F.col("margin")) < 1e-9).alias("adds_up"))


@register("m8_sampled_shapley")
def m8_sampled_shapley(spark, sf):
    """Permutation-sampled values of P(positive) for the test rows."""
    t = trained(spark, sf)
    return rounded(MD.shapley(t.model, t.test, t.train.select(*DOC_FEATURES), "doc_id", DOC_FEATURES,
                              samples=5, seed=42))


@register("s15_artifacts_roundtrip")
def s15_artifacts_roundtrip(spark, sf):
    """Saved and loaded artifacts give every test row the same score and code."""
    t = trained(spark, sf)
    path = shared_dir(spark, "s15_artifacts")
    AR.save_artifacts(path, t.model, t.target)
    model, target = AR.load_artifacts(path)
    before = MD.score(t.model, t.test).select("doc_id", F.col("p").alias("p_fitted"))
    after = MD.score(model, target.transform(t.test.drop("y"))).select("doc_id", "y", F.col("p").alias("p_loaded"))
    return before.join(after, "doc_id").select("doc_id", "y", (F.col("p_fitted") == F.col("p_loaded")).alias("same"))


def _payload(rows: DataFrame) -> DataFrame:
    """A request line per labelled document, truth first; by a hash of the id one in twenty
    is short, one long, and one has a quoted field."""
    kind = residue("doc_id", 20)
    values = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in DOC_FEATURES]
    quoted = F.when(kind == 2, F.concat(F.lit('"'), values[0], F.lit('"'))).otherwise(values[0])
    line = F.concat_ws(",", F.col(LABEL), quoted, *values[1:])
    return rows.select("doc_id", F.when(kind == 0, F.concat_ws(",", *values[:-1])).when(kind == 1, F.concat_ws(",", line, F.lit("9")))
                         .otherwise(line).alias("line"))


@register("m10_scoring_path")
def m10_scoring_path(spark, sf):
    """Request lines -> parse -> coerce -> impute -> score -> label -> CSV response, or an
    error where the line is no request."""
    t = trained(spark, sf)
    path = shared_dir(spark, "m10_artifacts")
    AR.save_artifacts(f"{path}/model", t.model, t.target)
    return LC.score_requests(spark, _payload(t.rows), "line", path, "text/csv", keep=["doc_id"])


@register("m10_response_check")
def m10_response_check(spark, sf):
    """Per document: whether it got an error, the truth in its response, and whether label,
    number and probability of the response are those of its row's score."""
    t = trained(spark, sf)
    part = F.split("body", ",")
    scored = MD.score(t.model, t.rows).select("doc_id", "p")
    label = F.when(F.col("p") > 0.5, AR.classes_of(t.target)[1]).otherwise(AR.classes_of(t.target)[0])
    agrees = (part[2] == label) & (part[3] == (F.col("p") > 0.5).cast("int").cast("string")) & (F.abs(part[4].cast("double") - F.col("p")) < 1e-9)
    return m10_scoring_path(spark, sf).join(scored, "doc_id").select(
        "doc_id", F.col("error").isNotNull().alias("failed"), part[0].alias("truth"), agrees.alias("agrees"))


@register("t5_model_stream")
def t5_model_stream(spark, sf):
    """Request lines of streamed documents, answered by saved artifacts a micro-batch at a
    time and captured with them; only epochs of the manifest count."""
    t = trained(spark, sf)
    path, sink = shared_dir(spark, "t5_artifacts"), shared_dir(spark, "t5_model")
    AR.save_artifacts(f"{path}/model", t.model, t.target)
    lines = _payload(TD.labelled_from(table_stream(spark, sf, "documents"), table(spark, sf, "labels")))
    respond = SM.scoring_writer(lambda batch: LC.score_requests(spark, batch, "line", path, "text/csv", keep=["doc_id", "line"]))
    return run_available_now(lines, "t5_model", foreach=respond, folder=sink, reader=SM.read_captures).drop("epoch")


@register("t5_model_stream_check")
def t5_model_stream_check(spark, sf):
    """Per document: whether the captured answer is that of the batch path."""
    batch = m10_scoring_path(spark, sf).select("doc_id", F.struct("body", "error").alias("want"))
    stream = t5_model_stream(spark, sf).select("doc_id", F.struct("body", "error").alias("got"))
    return stream.join(batch, "doc_id", "full_outer").select("doc_id", F.coalesce(F.col("got").eqNullSafe(F.col("want")), F.lit(False)).alias("same"))


# ---------------------------------------------------------------- positional names and JSON records
@register("f1_positional_names")
def f1_positional_names(spark, sf):
    """50-field request lines (the five lineitem values repeated) bound to
    the 50 feature names by position."""
    li = table(spark, sf, "lineitem")
    vals = [F.col(TD.REQUEST_FIELDS[i % 5]).cast("string") for i in range(len(FEATURE_COLUMNS))]
    lines = li.select(*KEYS, F.concat_ws(",", *vals).alias("line"))
    return PL.parse_csv_lines(lines, "line", FEATURE_COLUMNS, keep=KEYS, reject="rejected")


EVENT_RECORD = T.StructType([T.StructField("meta", T.StructType([T.StructField("k", T.IntegerType())])),
                             T.StructField("event_type", T.StringType())])


@register("s5_json_records")
def s5_json_records(spark, sf):
    """A JSON array per event (its properties nested under ``meta``) flattened
    to ``meta.k`` and ``event_type``."""
    ev = table(spark, sf, "events")
    body = F.concat(F.lit('[{"meta": '), F.col("props"), F.lit(', "event_type": "'), F.col("event_type"),
                    F.lit('"}]'))
    return PL.parse_json_records(ev.select("event_id", body.alias("body")), "body", EVENT_RECORD,
                                 keep=["event_id"], sep="_")


# ---------------------------------------------------------------- split files (S6) and CSV folders

def _split_schema() -> T.StructType:
    return T.StructType([T.StructField(c, T.DoubleType()) for c in [LABEL, *DOC_FEATURES]])


def _written_splits(spark, sf) -> str:
    path = shared_dir(spark, "s6_splits")
    rows, medians, classes = fitted(spark, sf)
    SK.write_splits(P.encode(P.impute(rows, medians), LABEL, classes), path, LABEL, DOC_FEATURES)
    return path


@register("s6_write_splits")
def s6_write_splits(spark, sf):
    """Write the transformed split rows (imputed features, coded label) as CSV
    folders (label first, header) and read every folder back with its split taken
    from the folder name."""
    path = _written_splits(spark, sf)
    schema = _split_schema().add("split", T.StringType())
    return spark.read.option("header", True).schema(schema).csv(path)


@register("s1_read_csv_dir")
def s1_read_csv_dir(spark, sf):
    """Read every CSV file of the written train folder (an empty folder is an error)."""
    path = _written_splits(spark, sf)
    return PL.read_csv_dir(spark, f"{path}/split=train", schema=_split_schema())



@register("f2_split_truth_json")
def f2_split_truth_json(spark, sf):
    """JSON payloads whose objects may carry the truth field: it is moved
    aside and the remaining fields are the features."""
    ev = table(spark, sf, "events")
    truth = F.when(F.col("event_type") == "purchase", F.lit(', "result_match": "home_win"')).when(
        F.col("event_type") == "click", F.lit(', "result_match": "home_not_win"')).otherwise(F.lit(""))
    body = F.concat(F.lit('[{"value": '), F.col("value").cast("string"), F.lit(', "k": '),
                    F.get_json_object("props", "$.k"), truth, F.lit("}]"))
    schema = T.StructType([T.StructField("value", T.DoubleType()), T.StructField("k", T.IntegerType()),
                           T.StructField(LABEL, T.StringType())])
    return PL.parse_json_records(ev.select("event_id", body.alias("body")), "body", schema,
                                 keep=["event_id"], label=LABEL)


@register("w4_step_outputs")
def w4_step_outputs(spark, sf):
    """Outputs named ``train`` of each group's latest run (orders as runs,
    their line items as step outputs)."""
    latest = R.latest(TD.registry(spark, sf), "group", "created_at", "package_id", ["package_id"])
    outputs = TD.run_outputs(spark, sf)
    return (latest.join(outputs, "package_id").where(F.col("output_name") == "train")
            .select("group", "package_id", "step", "uri"))
