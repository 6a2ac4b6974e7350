"""Independent SQL (DuckDB dialect) for each registered query.

Written from the operator semantics, not from the Spark plans: plain windows,
``median`` and ``row_number`` are fine here because the oracle only runs on
small fixtures.
"""

from __future__ import annotations

SQL: dict[str, str] = {}

H8 = "CAST('0x' || substr(md5('42|' || CAST({c} AS VARCHAR)), 1, 15) AS BIGINT)"

LABELLED = f"""
SELECT d.doc_id, d.source, d.lang,
  CAST(d.n_chars AS DOUBLE) AS n_chars,
  CASE WHEN {H8.format(c='d.doc_id')} % 7 = 0 THEN NULL
       ELSE CAST(length(d.text) - length(replace(d.text, ' ', '')) + 1 AS DOUBLE) END AS n_words,
  CAST(length(d.text) - length(replace(d.text, '.', '')) AS DOUBLE) AS n_sentences,
  CAST(length(d.text) - length(replace(d.text, chr(10), '')) + 1 AS DOUBLE) AS n_lines,
  CAST(d.lang = 'en' AS DOUBLE) AS lang_en, CAST(d.lang = 'fr' AS DOUBLE) AS lang_fr,
  CAST(d.lang = 'de' AS DOUBLE) AS lang_de, CAST(d.lang = 'es' AS DOUBLE) AS lang_es,
  CASE WHEN l.quality = 1 THEN 'home_win' WHEN l.quality IS NOT NULL THEN 'home_not_win' END
    AS result_match
FROM documents d JOIN labels l ON d.doc_id = l.doc_id
"""

SPLIT = f"""
SELECT * EXCLUDE (rk, n),
  CASE WHEN rk <= (14 * n + 10) // 20 THEN 'train'
       WHEN rk <= (34 * n + 20) // 40 THEN 'validation' ELSE 'test' END AS split
FROM (SELECT *, row_number() OVER (PARTITION BY result_match
                                   ORDER BY md5('42|' || CAST(doc_id AS VARCHAR)), doc_id) AS rk,
             count(*) OVER (PARTITION BY result_match) AS n
      FROM ({LABELLED}))
"""

MEDIANS = f"""
SELECT median(n_chars) AS m_chars, median(n_words) AS m_words,
       median(n_sentences) AS m_sentences, median(n_lines) AS m_lines
FROM ({SPLIT}) WHERE split = 'train'
"""

PREPARED = f"""
SELECT s.doc_id, s.split, s.result_match,
  coalesce(s.n_chars, m.m_chars) AS n_chars, coalesce(s.n_words, m.m_words) AS n_words,
  coalesce(s.n_sentences, m.m_sentences) AS n_sentences,
  coalesce(s.n_lines, m.m_lines) AS n_lines,
  CAST(CASE s.result_match WHEN 'home_not_win' THEN 0.0 WHEN 'home_win' THEN 1.0 END AS DOUBLE) AS y
FROM ({SPLIT}) s, ({MEDIANS}) m
"""

RULE = f"""
SELECT *, CASE WHEN p > 0.5 THEN 1 ELSE 0 END AS yhat
FROM (SELECT *, 1.0 / (1.0 + exp(-(n_words - 200.0) / 100.0)) AS p FROM ({PREPARED}))
"""

CONFUSION = """
  CAST(sum(CASE WHEN {y} = 1 AND {p} = 1 THEN 1 ELSE 0 END) AS BIGINT) AS tp,
  CAST(sum(CASE WHEN {y} <> 1 AND {p} = 1 THEN 1 ELSE 0 END) AS BIGINT) AS fp,
  CAST(sum(CASE WHEN {y} = 1 AND {p} <> 1 THEN 1 ELSE 0 END) AS BIGINT) AS fn,
  CAST(sum(CASE WHEN {y} <> 1 AND {p} <> 1 THEN 1 ELSE 0 END) AS BIGINT) AS tn
"""


def ratio(num: str, den: str) -> str:
    return f"CASE WHEN ({den}) = 0 THEN 0.0 ELSE CAST({num} AS DOUBLE) / CAST({den} AS DOUBLE) END"


TEST_METRICS = f"""
SELECT tp, fp, fn, tn,
  round({ratio('tp', 'tp + fp')}, 6) AS precision,
  round({ratio('tp', 'tp + fn')}, 6) AS recall,
  round({ratio('2 * tp', '2 * tp + fp + fn')}, 6) AS f1
FROM (SELECT {CONFUSION.format(y='y', p='yhat')} FROM ({RULE}) WHERE split = 'test')
"""

REPORT = f"""
SELECT '{{"metrics":{{"f1":{{"value":' || CAST(f1 AS VARCHAR) || '}},"precision":{{"value":'
       || CAST(precision AS VARCHAR) || '}},"recall":{{"value":' || CAST(recall AS VARCHAR)
       || '}}}}}}' AS report, f1, precision
FROM ({TEST_METRICS})
"""

SCORED = """
SELECT event_id, ts, user_id, event_type, value / 500.0 AS score,
       CAST(event_type = 'purchase' AS INTEGER) AS truth
FROM events
"""

SQL["s2_zip_columns"] = """
SELECT coalesce(d.doc_id, l.doc_id) AS doc_id, d.lang, d.n_chars, l.quality, l.toxic
FROM (SELECT doc_id, lang, n_chars FROM documents) d FULL OUTER JOIN labels l ON d.doc_id = l.doc_id
"""

SQL["s3_union_parts"] = """
SELECT l_returnflag, l_linestatus, count(*) AS rows, round(sum(l_quantity), 6) AS sum_qty
FROM (SELECT * FROM lineitem WHERE l_linenumber <= 3
      UNION ALL SELECT * FROM lineitem WHERE l_linenumber > 3)
GROUP BY l_returnflag, l_linestatus
"""

SQL["w1_shuffle_rank"] = """
SELECT doc_id, row_number() OVER (ORDER BY md5('42|' || CAST(doc_id AS VARCHAR)), doc_id) AS position
FROM documents
"""

SQL["w2_stratified_split"] = f"SELECT doc_id, result_match, split FROM ({SPLIT})"

SQL["a1_fit_medians"] = f"""
SELECT "column", round(median, 6) AS median FROM (
  SELECT 'n_chars' AS "column", m_chars AS median FROM ({MEDIANS})
  UNION ALL SELECT 'n_words', m_words FROM ({MEDIANS})
  UNION ALL SELECT 'n_sentences', m_sentences FROM ({MEDIANS})
  UNION ALL SELECT 'n_lines', m_lines FROM ({MEDIANS}))
"""

SQL["a1_impute"] = f"""
SELECT doc_id, split, round(n_chars, 6) AS n_chars, round(n_words, 6) AS n_words,
       round(n_sentences, 6) AS n_sentences, round(n_lines, 6) AS n_lines
FROM ({PREPARED})
"""

SQL["a2_encode_label"] = f"SELECT doc_id, result_match, y FROM ({PREPARED})"

SQL["a3_decode_label"] = f"""
SELECT doc_id, y, CASE WHEN y = 0 THEN 'home_not_win' WHEN y = 1 THEN 'home_win' END AS decoded
FROM ({PREPARED})
"""

SQL["s7_test_baseline"] = f"""
SELECT * EXCLUDE (split, source, lang) FROM ({SPLIT})
WHERE split = 'test' AND doc_id IS NOT NULL AND n_chars IS NOT NULL AND n_words IS NOT NULL
  AND n_sentences IS NOT NULL AND n_lines IS NOT NULL AND lang_en IS NOT NULL
  AND lang_fr IS NOT NULL AND lang_de IS NOT NULL AND lang_es IS NOT NULL
  AND result_match IS NOT NULL
"""

SQL["s7_train_baseline"] = f"""
SELECT * EXCLUDE (split, source, lang, result_match) FROM ({SPLIT})
WHERE split = 'train' AND doc_id IS NOT NULL AND n_chars IS NOT NULL AND n_words IS NOT NULL
  AND n_sentences IS NOT NULL AND n_lines IS NOT NULL AND lang_en IS NOT NULL
  AND lang_fr IS NOT NULL AND lang_de IS NOT NULL AND lang_es IS NOT NULL
  AND result_match IS NOT NULL
"""

SQL["a4_binary_metrics"] = TEST_METRICS

SQL["s8_report_json"] = f"SELECT report FROM ({REPORT})"

SQL["a6_report_value"] = f"SELECT precision FROM ({REPORT})"

SQL["a5_quality_gate"] = f"""
SELECT f1 AS metric, 0.6::DOUBLE AS threshold, f1 >= 0.6 AS passed,
  CASE WHEN f1 >= 0.6 THEN 'passed'
       ELSE 'Execution failed because the model''s f1 result was lower than 0.6' END AS message
FROM ({REPORT})
"""

SQL["a7_model_quality"] = f"""
SELECT tp, fp, fn, tn,
  round({ratio('tp + tn', 'tp + fp + fn + tn')}, 6) AS accuracy,
  round({ratio('tp', 'tp + fp')}, 6) AS precision,
  round({ratio('tp', 'tp + fn')}, 6) AS recall,
  round({ratio('tp', 'tp + fn')}, 6) AS true_positive_rate,
  round({ratio('fp', 'fp + tn')}, 6) AS false_positive_rate,
  round({ratio('tn', 'tn + fp')}, 6) AS true_negative_rate,
  round({ratio('fn', 'fn + tp')}, 6) AS false_negative_rate,
  round({ratio('1.25 * tp', '1.25 * tp + 0.25 * fn + fp')}, 6) AS f0_5,
  round({ratio('2.0 * tp', '2.0 * tp + 1.0 * fn + fp')}, 6) AS f1,
  round({ratio('5.0 * tp', '5.0 * tp + 4.0 * fn + fp')}, 6) AS f2
FROM (SELECT {CONFUSION.format(y='truth', p='yhat')}
      FROM (SELECT truth, CASE WHEN score > 0.55 THEN 1 ELSE 0 END AS yhat FROM ({SCORED})))
"""

SQL["a8_roc_points"] = f"""
WITH g AS (SELECT score, CAST(sum(truth) AS BIGINT) AS pos, CAST(sum(1 - truth) AS BIGINT) AS neg
           FROM ({SCORED}) GROUP BY score),
c AS (SELECT score,
        CAST(sum(pos) OVER (ORDER BY score DESC ROWS UNBOUNDED PRECEDING) AS BIGINT) AS tp,
        CAST(sum(neg) OVER (ORDER BY score DESC ROWS UNBOUNDED PRECEDING) AS BIGINT) AS fp,
        sum(pos) OVER () AS P, sum(neg) OVER () AS N FROM g)
SELECT score AS threshold, tp, fp, round({ratio('tp', 'P')}, 6) AS tpr,
       round({ratio('fp', 'N')}, 6) AS fpr, round({ratio('tp', 'tp + fp')}, 6) AS precision
FROM c
"""

SQL["a8_auc"] = f"""
WITH g AS (SELECT score, sum(truth) AS pos, sum(1 - truth) AS neg FROM ({SCORED}) GROUP BY score),
c AS (SELECT *, sum(pos + neg) OVER (ORDER BY score ROWS UNBOUNDED PRECEDING)
                - (pos + neg - 1) / 2.0 AS mid FROM g),
s AS (SELECT sum(pos * mid) AS rs, CAST(sum(pos) AS DOUBLE) AS P, CAST(sum(neg) AS DOUBLE) AS N FROM c)
SELECT round((rs - P * (P + 1) / 2) / (P * N), 6) AS auc, CAST(P AS BIGINT) AS positives,
       CAST(N AS BIGINT) AS negatives FROM s
"""

# ---------------------------------------------------------------- requests and responses
from umpire.schemas import FEATURE_COLUMNS  # noqa: E402

RID = "l_orderkey * 10 + l_linenumber"
# kinds of malformed lines: 0 a word, 1 an empty field, 2 NaN, 3 short, 4 long, 5 quoted, 6 quoted comma
KIND = f"({H8.format(c=RID)} % 50)"
LINE = ("concat_ws(', ', CAST(l_quantity AS VARCHAR), CAST(l_extendedprice AS VARCHAR), "
        "CAST(l_discount AS VARCHAR), CAST(l_tax AS VARCHAR), CAST(l_suppkey AS VARCHAR))")

SQL["s4_csv_lines"] = """
SELECT l_orderkey, l_linenumber, l_quantity, l_extendedprice, l_discount, l_tax,
       CAST(l_suppkey AS DOUBLE) AS l_suppkey, false AS rejected FROM lineitem
"""

SQL["f2_split_truth"] = """
SELECT l_orderkey, l_linenumber,
       CASE WHEN l_returnflag = 'R' THEN 'home_win' ELSE 'home_not_win' END AS ground_truth,
       l_quantity, l_extendedprice, l_discount, l_tax, CAST(l_suppkey AS DOUBLE) AS l_suppkey,
       false AS rejected
FROM lineitem
"""

_WIDE = f"CASE WHEN {KIND} IN (3, 4) THEN NULL ELSE {{c}} END AS {{n}}"
SQL["f3_coerce_numeric"] = f"""
SELECT l_orderkey, l_linenumber, {_WIDE.format(c='l_quantity', n='l_quantity')},
       {_WIDE.format(c='l_extendedprice', n='l_extendedprice')}, {_WIDE.format(c='l_discount', n='l_discount')},
       CASE WHEN {KIND} IN (0, 1, 2, 3, 4, 6) THEN NULL ELSE l_tax END AS l_tax,
       {_WIDE.format(c='CAST(l_suppkey AS DOUBLE)', n='l_suppkey')}, {KIND} IN (3, 4) AS rejected
FROM lineitem
"""

SQL["f4_strict_reject"] = f"""
SELECT l_orderkey, count(*) AS lines,
       CAST(sum(CASE WHEN {KIND} IN (0, 3, 4, 6) THEN 1 ELSE 0 END) AS BIGINT) AS bad_lines,
       bool_or({KIND} IN (0, 3, 4, 6)) AS rejected
FROM lineitem GROUP BY l_orderkey
"""

SQL["f5_numeric_columns"] = """
SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice, l_discount, l_tax
FROM lineitem
"""

SQL["f6_map_values"] = f"""
SELECT doc_id, y, CASE WHEN y = 1.0 THEN 'home_win' WHEN y = 0.0 THEN 'home_not_win' END AS label
FROM ({PREPARED})
"""

SCORED_LINES = """
SELECT request_id, line, p, round(1.0 - p, 6) AS q, truth_label FROM (
  SELECT l_orderkey AS request_id, l_linenumber AS line, round(l_discount * 10.0, 6) AS p,
         CASE WHEN l_returnflag = 'R' THEN 'home_win' ELSE 'home_not_win' END AS truth_label
  FROM lineitem)
"""

PREDICTIONS = f"""
SELECT request_id, line, truth_label AS ground_truth,
  CASE WHEN truth_label = 'home_win' THEN 1 ELSE 0 END AS numerical_ground_truth_label,
  CASE WHEN p > q THEN 'home_win' ELSE 'home_not_win' END AS predicted_label,
  CASE WHEN p > q THEN 1 ELSE 0 END AS predicted_numerical_label,
  p AS win_probability
FROM ({SCORED_LINES})
"""

SQL["f7_argmax_label"] = PREDICTIONS

SQL["f8_numeric_flags"] = f"""
SELECT request_id, line, numerical_ground_truth_label, predicted_numerical_label FROM ({PREDICTIONS})
"""

SQL["s14_parse_predictions"] = f"""
SELECT request_id, line, 0 AS position, p AS prediction FROM ({SCORED_LINES})
UNION ALL SELECT request_id, line, 1 AS position, q AS prediction FROM ({SCORED_LINES})
"""

SQL["f9_threshold_label"] = f"""
SELECT request_id, line, position, CASE WHEN prediction > 0.5 THEN 'home_win' ELSE 'home_not_win' END AS label,
       prediction AS confidence
FROM ({SQL["s14_parse_predictions"]})
"""

SQL["s10_csv_response"] = f"""
SELECT request_id, line,
  concat_ws(',', ground_truth, CAST(numerical_ground_truth_label AS VARCHAR), predicted_label,
            CAST(predicted_numerical_label AS VARCHAR), CAST(win_probability AS VARCHAR)) AS csv5,
  concat_ws(',', predicted_label, CAST(predicted_numerical_label AS VARCHAR),
            CAST(win_probability AS VARCHAR)) AS csv3
FROM ({PREDICTIONS})
"""

ITEM_T = ("'{\"prediction\":\"' || predicted_label || '\",\"confidence\":' || CAST(win_probability AS VARCHAR)"
          " || ',\"numerical_label\":' || CAST(predicted_numerical_label AS VARCHAR)"
          " || ',\"ground_truth\":\"' || ground_truth || '\"}'")
ITEM = ("'{\"prediction\":\"' || predicted_label || '\",\"confidence\":' || CAST(win_probability AS VARCHAR)"
        " || ',\"numerical_label\":' || CAST(predicted_numerical_label AS VARCHAR) || '}'")

PAIR = ("'{\"prediction\":\"' || predicted_label || '\",\"confidence\":' || CAST(win_probability AS VARCHAR) || '}'")

SQL["s11_json_response"] = f"""
SELECT request_id, CAST(count(*) AS INTEGER) AS n, '[' || string_agg({ITEM_T}, ',' ORDER BY line, predicted_label, round(win_probability, 6), predicted_numerical_label, ground_truth) || ']' AS body
FROM ({PREDICTIONS}) GROUP BY request_id
"""

SQL["s12_jsonlines_response"] = f"SELECT request_id, line, {ITEM} AS body FROM ({PREDICTIONS})"

SQL["s13_unwrap_single"] = f"""
SELECT request_id, CAST(count(*) AS INTEGER) AS n,
  CASE WHEN count(*) = 1 THEN min({PAIR})
       ELSE '[' || string_agg({PAIR}, ',' ORDER BY line, predicted_label, win_probability) || ']' END AS body
FROM ({PREDICTIONS}) GROUP BY request_id
"""

SQL["s13_pair_csv"] = f"""
SELECT request_id, line, concat_ws(',', predicted_label, CAST(win_probability AS VARCHAR)) AS body FROM ({PREDICTIONS})
"""

SQL["s16_matrix_csv"] = """
SELECT l_orderkey, l_linenumber,
  concat_ws(',', CAST(l_quantity AS VARCHAR), CAST(l_extendedprice AS VARCHAR), CAST(l_discount AS VARCHAR),
            CAST(l_tax AS VARCHAR), CAST(CAST(l_suppkey AS DOUBLE) AS VARCHAR)) AS row
FROM lineitem
"""

SQL["f10_record_map"] = f"""
SELECT l_orderkey, l_linenumber, lpad(CAST(idx AS VARCHAR), 2, '0') AS key, value FROM (
  SELECT l_orderkey, l_linenumber, unnest(parts) AS value, unnest(range(len(parts))) AS idx
  FROM (SELECT l_orderkey, l_linenumber, string_split({LINE}, ',') AS parts FROM lineitem))
"""

SQL["f11_last_columns"] = """
SELECT CASE WHEN event_type = 'purchase' THEN 1 ELSE 0 END AS numerical_ground_truth_label,
  CASE WHEN value / 500.0 > 1.0 - value / 500.0 THEN 'home_win' ELSE 'home_not_win' END AS predicted_label,
  CASE WHEN value / 500.0 > 1.0 - value / 500.0 THEN 1 ELSE 0 END AS predicted_numerical_label,
  round(value / 500.0, 6) AS win_probability
FROM events
"""

FEATURES_LIST = "[" + ", ".join(f"'{c}'" for c in FEATURE_COLUMNS) + "]"

TENSORS = """
SELECT event_id,
  CASE WHEN event_type = 'purchase' THEN 'metrics' WHEN event_type = 'click' THEN 'feature_importance'
       ELSE 'average_shap' END AS collection,
  CASE WHEN event_type = 'purchase' THEN 'train-' || CASE WHEN user_id % 2 = 0 THEN 'auc' ELSE 'logloss' END
       WHEN event_type = 'click' THEN 'feature_importance/gain/f' || CAST(user_id % 60 AS VARCHAR)
       ELSE 'average_shap/f' || CAST(user_id % 60 AS VARCHAR) END AS name,
  CAST(dayofmonth(ts) AS BIGINT) AS step, value
FROM events
"""

SQL["f12_name_features"] = f"""
SELECT event_id, name,
  coalesce(CASE WHEN regexp_matches(tag, '^f[0-9]+$') AND CAST(substr(tag, 2) AS INTEGER) < {len(FEATURE_COLUMNS)}
                THEN {FEATURES_LIST}[CAST(substr(tag, 2) AS INTEGER) + 1] END, name) AS feature
FROM (SELECT event_id, name, string_split(name, '/')[-1] AS tag FROM ({TENSORS}))
"""

SQL["f13_filter_series"] = f"""
WITH t AS ({TENSORS}),
names AS (SELECT DISTINCT name FROM t WHERE regexp_matches(name, '^(?:average_shap/.*)') ORDER BY name LIMIT 35)
SELECT event_id, name, step FROM t WHERE name IN (SELECT name FROM names)
"""

SQL["f17_csv_payload"] = f"""
SELECT CAST(doc_id AS VARCHAR) AS inference_id,
  concat_ws(',', CAST(n_chars AS VARCHAR), CAST(n_words AS VARCHAR), CAST(n_sentences AS VARCHAR),
            CAST(n_lines AS VARCHAR)) AS payload
FROM ({PREPARED})
"""

SYNTH = f"['home_win', 'home_not_win'][{H8.format(c='event_id')} % 2 + 1]"

SQL["f18_synthetic_label"] = f"SELECT event_id, {SYNTH} AS label FROM events"

SQL["s9_ground_truth_records"] = f"""
SELECT event_id, strftime(ts, '%Y/%m/%d/%H') AS folder,
  '{{"groundTruthData":{{"data":"' || {SYNTH} || '","encoding":"CSV"}},"eventMetadata":{{"eventId":"'
  || CAST(event_id AS VARCHAR) || '"}},"eventVersion":"0"}}' AS record
FROM events
"""

ARRIVALS = f"""
SELECT event_id, ts,
  CASE WHEN event_type = 'purchase' THEN 'data/' || CAST(user_id AS VARCHAR) || '/df.csv'
       WHEN event_type = 'click' THEN 'data/' || CAST(user_id AS VARCHAR) || '/y.csv'
       WHEN event_type = 'view' THEN 'data/' || CAST(user_id AS VARCHAR) || '/notes.csv'
       WHEN event_type = 'signup' THEN 'raw/' || CAST(user_id AS VARCHAR) || '/df.csv'
       ELSE 'data/' || CAST(user_id AS VARCHAR) || '/df.json' END AS key,
  CASE WHEN {H8.format(c='event_id')} % 10 = 0 THEN NULL ELSE CAST(user_id AS VARCHAR) END AS batch_id
FROM events
"""

SQL["f14_classify_arrivals"] = f"""
SELECT event_id,
  CASE WHEN NOT ok THEN 'skipped' WHEN NOT hb THEN 'missing_batch_id' WHEN ft IS NULL THEN 'unrecognized'
       ELSE 'accepted' END AS status,
  CASE WHEN ok AND hb THEN ft END AS file_type,
  regexp_extract(key, '^(.*)/[^/]*$', 1) || '/' AS folder,
  CASE WHEN NOT ok THEN 'Object is not in the ''data/'' folder or not a CSV file.'
       WHEN NOT hb THEN 'batch-id metadata is missing'
       WHEN ft IS NULL THEN 'File type not recognized' END AS message
FROM (SELECT *, starts_with(key, 'data/') AND ends_with(key, '.csv') AS ok,
             coalesce(batch_id <> '', false) AS hb,
             CASE WHEN strpos(key, 'df.csv') > 0 THEN 'df' WHEN strpos(key, 'y.csv') > 0 THEN 'y' END AS ft
      FROM ({ARRIVALS}))
"""

SQL["f15_match_events"] = """
SELECT event_id, CASE WHEN event_type = 'view' THEN 'tmp/' ELSE 'data/' END || CAST(user_id AS VARCHAR)
       || '/df.csv' AS key
FROM events
WHERE event_type IN ('purchase', 'click', 'view')
  AND starts_with(CASE WHEN event_type = 'view' THEN 'tmp/' ELSE 'data/' END, 'data/')
"""

_LOG = """
SELECT event_id AS line_id, printf('[%d]#011train-logloss:%.5f#011%s-auc:%.5f#011train-auc:%.5f',
  event_id, value / 100.0, CASE WHEN event_type = 'view' THEN 'eval' ELSE 'validation_0' END,
  value / 500.0, value / 490.02) AS line
FROM events
"""

# The four training-log metrics and their patterns.
_METRICS = {
    "validation:logloss": r".*\[[0-9]+\].*#011validation_0-logloss:([-+]?[0-9]*\.?[0-9]+(?:[eE][-+]?[0-9]+)?).*",
    "validation:auc": r".*\[[0-9]+\].*#011validation_0-auc:([-+]?[0-9]*\.?[0-9]+(?:[eE][-+]?[0-9]+)?).*",
    "train:logloss": r".*\[[0-9]+\].*#011train-logloss:([-+]?[0-9]*\.?[0-9]+(?:[eE][-+]?[0-9]+)?).*",
    "train:auc": r".*\[[0-9]+\].*#011train-auc:([-+]?[0-9]*\.?[0-9]+(?:[eE][-+]?[0-9]+)?).*",
}
SQL["f16_log_metrics"] = " UNION ALL ".join(
    f"SELECT line_id, '{name}' AS metric, round(TRY_CAST(regexp_extract(line, '{pat}', 1) AS DOUBLE), 6)"
    f" AS metric_value FROM ({_LOG}) WHERE regexp_matches(line, '{pat}')"
    for name, pat in _METRICS.items())

# ---------------------------------------------------------------- joins, registry, sampling
CAPTURES = """
SELECT CAST(event_id AS VARCHAR) AS inference_id, value / 500.0 AS score,
       CAST(value / 500.0 > 0.1 AS INTEGER) AS yhat FROM events
"""
TRUTH = f"""
SELECT CAST(CASE WHEN {H8.format(c='event_id')} % 10 = 0 THEN event_id + 1000000000000 ELSE event_id END
            AS VARCHAR) AS eventId,
       CASE WHEN event_type = 'purchase' THEN 'home_win' ELSE 'home_not_win' END AS label
FROM events
"""

SQL["j1_match_truth"] = f"""
SELECT c.inference_id, round(c.score, 6) AS score, c.yhat, t.label
FROM ({CAPTURES}) c JOIN ({TRUTH}) t ON c.inference_id = t.eventId
"""

SQL["j2_unlabelled_captures"] = f"""
SELECT inference_id FROM ({CAPTURES}) c WHERE NOT EXISTS (SELECT 1 FROM ({TRUTH}) t WHERE t.eventId = c.inference_id)
"""

SQL["j2_orphan_truths"] = f"""
SELECT eventId, label FROM ({TRUTH}) t WHERE NOT EXISTS (SELECT 1 FROM ({CAPTURES}) c WHERE t.eventId = c.inference_id)
"""

SQL["j3_join_input_output"] = f"""
SELECT request_id, line, p, CASE WHEN p > q THEN 'home_win' ELSE 'home_not_win' END AS predicted_label,
       CASE WHEN p > q THEN 1 ELSE 0 END AS predicted_numerical_label
FROM ({SCORED_LINES})
"""

VARIANTS = """
SELECT event_id, CAST(event_type = 'purchase' AS INTEGER) AS truth,
       CAST(value / 500.0 > 0.1 AS INTEGER) AS prod_yhat,
       CAST(value / 500.0 * 1.1 + 0.01 > 0.1 AS INTEGER) AS shadow_yhat
FROM events
"""

SQL["j4_pair_variants"] = f"SELECT event_id, prod_yhat, shadow_yhat FROM ({VARIANTS})"

SQL["a14_compare_variants"] = f"""
SELECT n, round(agreement, 6) AS agreement, round(pf1, 6) AS production_f1, round(sf1, 6) AS shadow_f1,
       sf1 > pf1 AS promote_shadow
FROM (SELECT count(*) AS n, avg(CAST(prod_yhat = shadow_yhat AS DOUBLE)) AS agreement,
  {ratio('2 * sum(CASE WHEN truth = 1 AND prod_yhat = 1 THEN 1 ELSE 0 END)',
         '2 * sum(CASE WHEN truth = 1 AND prod_yhat = 1 THEN 1 ELSE 0 END) + sum(CASE WHEN truth <> 1 AND prod_yhat = 1 THEN 1 ELSE 0 END) + sum(CASE WHEN truth = 1 AND prod_yhat <> 1 THEN 1 ELSE 0 END)')} AS pf1,
  {ratio('2 * sum(CASE WHEN truth = 1 AND shadow_yhat = 1 THEN 1 ELSE 0 END)',
         '2 * sum(CASE WHEN truth = 1 AND shadow_yhat = 1 THEN 1 ELSE 0 END) + sum(CASE WHEN truth <> 1 AND shadow_yhat = 1 THEN 1 ELSE 0 END) + sum(CASE WHEN truth = 1 AND shadow_yhat <> 1 THEN 1 ELSE 0 END)')} AS sf1
FROM ({VARIANTS}))
"""

SQL["j5_align_rows"] = """
SELECT d.row_id, d.doc_id, d.lang, e.vec_id, e.label
FROM (SELECT doc_id, lang, row_number() OVER (ORDER BY doc_id) - 1 AS row_id FROM documents) d
JOIN (SELECT vec_id, label, row_number() OVER (ORDER BY vec_id) - 1 AS row_id FROM embeddings) e
  ON d.row_id = e.row_id
"""

REGISTRY = """
SELECT o_custkey AS "group", 'pkg-' || CAST(o_orderkey AS VARCHAR) AS arn,
  CASE WHEN o_orderstatus = 'F' THEN 'Approved' WHEN o_orderstatus = 'P' THEN 'PendingManualApproval'
       ELSE 'Rejected' END AS status, o_orderdate AS created_at, o_orderkey AS package_id
FROM orders
"""

LATEST_APPROVED = f"""
SELECT "group", max(CASE WHEN rn = 2 THEN arn END) AS production, max(CASE WHEN rn = 1 THEN arn END) AS shadow
FROM (SELECT *, row_number() OVER (PARTITION BY "group" ORDER BY created_at DESC, package_id DESC) AS rn
      FROM ({REGISTRY}) WHERE status = 'Approved')
GROUP BY "group"
"""

SQL["w3_latest_approved"] = LATEST_APPROVED

SQL["w4_latest_package"] = f"""
SELECT "group", strftime(created_at, '%Y-%m-%d') AS latest_created, arn, status
FROM (SELECT *, row_number() OVER (PARTITION BY "group" ORDER BY created_at DESC, package_id DESC) AS rn
      FROM ({REGISTRY}))
WHERE rn = 1
"""

SQL["t6_deploy_decision"] = f"""
SELECT e.event_id, e."group", e.approval_status,
  CASE WHEN e.approval_status = 'Approved' THEN 'deploy' ELSE 'skip' END AS action,
  CASE WHEN e.approval_status = 'Approved' THEN l.production END AS production,
  CASE WHEN e.approval_status = 'Approved' THEN l.shadow END AS shadow,
  CASE WHEN e.approval_status = 'Approved' THEN 'Endpoint deployed successfully' ELSE 'Skipping deployment.' END
    AS message
FROM (SELECT event_id, user_id + 1 AS "group",
        CASE WHEN event_type = 'error' THEN 'Approved'
             WHEN {H8.format(c='event_id')} % 3 = 0 THEN 'Rejected' ELSE 'Approved' END AS approval_status
      FROM events WHERE event_type IN ('signup', 'error')) e
LEFT JOIN ({LATEST_APPROVED}) l ON e."group" = l."group"
"""

SQL["w5_sample_with_replacement"] = f"""
WITH r AS (SELECT vec_id, label, row_number() OVER (ORDER BY vec_id) - 1 AS pos FROM embeddings),
n AS (SELECT count(*) AS c FROM embeddings),
d AS (SELECT range AS draw FROM range(100))
SELECT d.draw, r.vec_id, r.label
FROM d, n, r WHERE d.draw < n.c AND r.pos = {H8.format(c='d.draw')} % n.c
"""

SQL["w6_zscore_outliers"] = """
WITH s AS (SELECT vec_id, list_sum(list_transform(embedding[1:len(embedding) - 1], lambda x: CAST(x AS DOUBLE))) AS row_sum FROM embeddings),
st AS (SELECT avg(row_sum) AS m, stddev_pop(row_sum) AS sd FROM s),
low AS (SELECT vec_id, row_sum, 'low' AS side FROM s ORDER BY row_sum ASC, vec_id ASC LIMIT 3),
high AS (SELECT vec_id, row_sum, 'high' AS side FROM s ORDER BY row_sum DESC, vec_id ASC LIMIT 3)
SELECT vec_id, round(row_sum, 6) AS row_sum, side, round((row_sum - m) / sd, 6) AS z
FROM (SELECT * FROM low UNION ALL SELECT * FROM high), st
"""

SQL["w7_capture_sample"] = f"SELECT event_id FROM events WHERE {H8.format(c='event_id')} % 100 < 30"

# ---------------------------------------------------------------- data and model quality
CAP_BASE = """
SELECT event_id, ts, value, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k, user_id, event_type
FROM events WHERE ts < TIMESTAMP '2024-01-16'
"""
CAP_CUR = f"""
SELECT event_id, ts, value - 25.0 AS value,
  CASE WHEN {H8.format(c='event_id')} % 5 = 0 THEN NULL ELSE CAST(json_extract_string(props, '$.k') AS INTEGER) END AS k,
  user_id, event_type
FROM events WHERE ts >= TIMESTAMP '2024-01-16'
"""


def long_form(src: str) -> str:
    return f"""
SELECT 'value' AS "column", 'Fractional' AS inferred_type, value AS num, CAST(value AS VARCHAR) AS str FROM ({src})
UNION ALL SELECT 'k', 'Integral', CAST(k AS DOUBLE), CAST(k AS VARCHAR) FROM ({src})
UNION ALL SELECT 'user_id', 'Integral', CAST(user_id AS DOUBLE), CAST(user_id AS VARCHAR) FROM ({src})
UNION ALL SELECT 'event_type', 'String', CAST(NULL AS DOUBLE), event_type FROM ({src})
"""


def profile_sql(src: str) -> str:
    return f"""
SELECT "column", inferred_type, count(*) AS num_rows, CAST(count(*) - count(str) AS BIGINT) AS num_missing,
  CAST(count(str) AS DOUBLE) / count(*) AS completeness, avg(num) AS mean, sum(num) AS sum,
  stddev_pop(num) AS std_dev, min(num) AS min, max(num) AS max, count(DISTINCT str) AS distinct
FROM ({long_form(src)}) GROUP BY "column", inferred_type
"""


SQL["a9_profile"] = f"""
SELECT "column", inferred_type, num_rows, num_missing, round(completeness, 6) AS completeness,
  round(mean, 6) AS mean, round(sum, 6) AS sum, round(std_dev, 6) AS std_dev, round(min, 6) AS min,
  round(max, 6) AS max, "distinct"
FROM ({profile_sql(CAP_BASE)})
"""

SQL["a9_histogram"] = f"""
WITH l AS (SELECT * FROM ({long_form(CAP_BASE)}) WHERE num IS NOT NULL AND "column" <> 'event_type'),
b AS (SELECT "column", min(num) AS lo, max(num) AS hi FROM l GROUP BY "column"),
x AS (SELECT l."column", lo, hi,
        CAST(CASE WHEN hi = lo THEN 0 ELSE least(floor((num - lo) / ((hi - lo) / 10)), 9) END AS INTEGER) AS bucket
      FROM l JOIN b ON l."column" = b."column")
SELECT "column", bucket, round(lo + (hi - lo) * bucket / 10, 6) AS lower,
       round(lo + (hi - lo) * (bucket + 1) / 10, 6) AS upper, count(*) AS count
FROM x GROUP BY "column", bucket, lo, hi
"""

CONSTRAINTS = f"""
SELECT "column", inferred_type, completeness AS completeness_threshold,
       CASE WHEN inferred_type = 'String' THEN NULL ELSE min >= 0 END AS non_negative
FROM ({profile_sql(CAP_BASE)})
"""

SQL["a10_suggest_constraints"] = f"""
SELECT "column", inferred_type, round(completeness_threshold, 6) AS completeness_threshold, non_negative
FROM ({CONSTRAINTS})
"""

SQL["a11_violations"] = f"""
WITH c AS ({profile_sql(CAP_CUR)}), k AS ({CONSTRAINTS})
SELECT c."column", 'data_type_check' AS "check",
       'Expected type ' || k.inferred_type || ', found ' || c.inferred_type AS description
FROM c JOIN k ON c."column" = k."column" WHERE c.inferred_type <> k.inferred_type
UNION ALL
SELECT c."column", 'completeness_check',
       'Completeness ' || printf('%.6f', c.completeness) || ' is below ' || printf('%.6f', k.completeness_threshold)
FROM c JOIN k ON c."column" = k."column" WHERE c.completeness < k.completeness_threshold
UNION ALL
SELECT c."column", 'non_negative_check', 'Minimum ' || printf('%.6f', c.min) || ' is negative'
FROM c JOIN k ON c."column" = k."column" WHERE k.non_negative AND c.min < 0
"""

SQL["a12_drift"] = f"""
WITH b AS (SELECT "column", num, count(*) AS n FROM ({long_form(CAP_BASE)}) WHERE num IS NOT NULL GROUP BY ALL),
c AS (SELECT "column", num, count(*) AS n FROM ({long_form(CAP_CUR)}) WHERE num IS NOT NULL GROUP BY ALL),
j AS (SELECT coalesce(b."column", c."column") AS "column", coalesce(b.num, c.num) AS num,
             coalesce(b.n, 0) AS nb, coalesce(c.n, 0) AS nc
      FROM b FULL OUTER JOIN c ON b."column" = c."column" AND b.num = c.num),
w AS (SELECT "column",
        sum(nb) OVER (PARTITION BY "column" ORDER BY num ROWS UNBOUNDED PRECEDING) AS cb,
        sum(nc) OVER (PARTITION BY "column" ORDER BY num ROWS UNBOUNDED PRECEDING) AS cc,
        sum(nb) OVER (PARTITION BY "column") AS tb, sum(nc) OVER (PARTITION BY "column") AS tc FROM j)
SELECT "column", round(max(abs(cb / tb - cc / tc)), 6) AS ks_distance, CAST(max(tb) AS BIGINT) AS n_base,
       CAST(max(tc) AS BIGINT) AS n_current
FROM w GROUP BY "column"
"""


SQL["a9_merged_profile"] = f'SELECT * EXCLUDE ("distinct"), true AS distinct_close FROM ({SQL["a9_profile"]})'
SQL["a9_statistics_document"] = f'SELECT CAST(row_number() OVER (ORDER BY "column") - 1 AS INTEGER) AS position, * FROM ({SQL["a9_profile"]})'
SQL["a10_constraints_document"] = SQL["a10_suggest_constraints"]
SQL["a12_sketch_drift"] = f'SELECT *, true AS within_bound FROM ({SQL["a12_drift"]})'


def window_metrics(cond: str) -> str:
    return f"""
SELECT {ratio('tp + tn', 'tp + fp + fn + tn')} AS accuracy, {ratio('tp', 'tp + fp')} AS precision,
       {ratio('tp', 'tp + fn')} AS recall, {ratio('2.0 * tp', '2.0 * tp + 1.0 * fn + fp')} AS f1
FROM (SELECT {CONFUSION.format(y='truth', p='yhat')}
      FROM (SELECT truth, CASE WHEN score > 0.1 THEN 1 ELSE 0 END AS yhat FROM ({SCORED}) WHERE {cond}))
"""


SQL["a13_model_quality_check"] = f"""
WITH b AS ({window_metrics("ts < TIMESTAMP '2024-01-16'")}), c AS ({window_metrics("ts >= TIMESTAMP '2024-01-16'")})
SELECT m.metric, round(m.bv, 6) AS baseline, round(m.cv, 6) AS current, m.cv < m.bv AS violated FROM (
  SELECT 'accuracy' AS metric, b.accuracy AS bv, c.accuracy AS cv FROM b, c
  UNION ALL SELECT 'precision', b.precision, c.precision FROM b, c
  UNION ALL SELECT 'recall', b.recall, c.recall FROM b, c
  UNION ALL SELECT 'f1', b.f1, c.f1 FROM b, c) m
"""

# ---------------------------------------------------------------- bias and explanations
BIAS_ROWS = f"""
SELECT doc_id, source, n_chars, y, n_chars > 1000.0 AS facet,
       CAST(1.0 / (1.0 + exp(-(n_words - 200.0) / 100.0)) > 0.65 AS INTEGER) AS yhat
FROM ({PREPARED}) p JOIN (SELECT doc_id AS id2, source FROM documents) s ON p.doc_id = s.id2
"""

SQL["a20_facet"] = f"SELECT doc_id, facet FROM ({BIAS_ROWS})"


def _kl(p1, p0, r1, r0):
    def term(p, r):
        return f"(CASE WHEN {p} = 0 THEN 0.0 WHEN {r} = 0 THEN NULL ELSE {p} * ln({p} / {r}) END)"
    return f"({term(p1, r1)} + {term(p0, r0)})"


def _cdd_sql(pos: str) -> str:
    return f"""
SELECT sum(n_i * (coalesce(CASE WHEN n0 = 0 THEN NULL ELSE nd0 / n0 END, 0.0)
                 - coalesce(CASE WHEN n1 = 0 THEN NULL ELSE nd1 / n1 END, 0.0))) / sum(n_i) AS v
FROM (SELECT source, count(*) AS n_i,
        CAST(sum(CASE WHEN NOT {pos} THEN 1 ELSE 0 END) AS DOUBLE) AS n0,
        CAST(sum(CASE WHEN {pos} THEN 1 ELSE 0 END) AS DOUBLE) AS n1,
        CAST(sum(CASE WHEN facet AND NOT {pos} THEN 1 ELSE 0 END) AS DOUBLE) AS nd0,
        CAST(sum(CASE WHEN facet AND {pos} THEN 1 ELSE 0 END) AS DOUBLE) AS nd1
      FROM ({BIAS_ROWS}) GROUP BY source)
"""


_PRE = f"""
SELECT *, (qa + qd) / 2 AS m1, ((1 - qa) + (1 - qd)) / 2 AS m0 FROM (
  SELECT na, nd, CASE WHEN na = 0 THEN NULL ELSE na1 / na END AS qa, CASE WHEN nd = 0 THEN NULL ELSE nd1 / nd END AS qd
  FROM (SELECT CAST(sum(CASE WHEN NOT facet THEN 1 ELSE 0 END) AS DOUBLE) AS na,
               CAST(sum(CASE WHEN facet THEN 1 ELSE 0 END) AS DOUBLE) AS nd,
               CAST(sum(CASE WHEN NOT facet AND y = 1 THEN 1 ELSE 0 END) AS DOUBLE) AS na1,
               CAST(sum(CASE WHEN facet AND y = 1 THEN 1 ELSE 0 END) AS DOUBLE) AS nd1
        FROM ({BIAS_ROWS})))
"""

SQL["a17_pretraining_bias"] = f"""
SELECT metric, round(value, 6) AS value FROM (
  SELECT 'CI' AS metric, CASE WHEN na + nd = 0 THEN NULL ELSE (na - nd) / (na + nd) END AS value FROM ({_PRE})
  UNION ALL SELECT 'DPL', qa - qd FROM ({_PRE})
  UNION ALL SELECT 'KL', {_kl('qa', '(1 - qa)', 'qd', '(1 - qd)')} FROM ({_PRE})
  UNION ALL SELECT 'JS', 0.5 * ({_kl('qa', '(1 - qa)', 'm1', 'm0')} + {_kl('qd', '(1 - qd)', 'm1', 'm0')}) FROM ({_PRE})
  UNION ALL SELECT 'LP', sqrt(pow(qa - qd, 2) + pow((1 - qa) - (1 - qd), 2)) FROM ({_PRE})
  UNION ALL SELECT 'TVD', 0.5 * (abs(qa - qd) + abs((1 - qa) - (1 - qd))) FROM ({_PRE})
  UNION ALL SELECT 'KS', greatest(abs(qa - qd), abs((1 - qa) - (1 - qd))) FROM ({_PRE})
  UNION ALL SELECT 'CDDL', v FROM ({_cdd_sql('y = 1')}))
"""


def _dv(a: str, b: str) -> str:
    return f"(CASE WHEN ({b}) = 0 THEN NULL ELSE CAST({a} AS DOUBLE) / ({b}) END)"


def _facet_counts(tag: str, cond: str) -> str:
    return (f"CAST(sum(CASE WHEN {cond} THEN 1 ELSE 0 END) AS DOUBLE) AS n_{tag}, "
            f"CAST(sum(CASE WHEN {cond} AND y = 1 THEN 1 ELSE 0 END) AS DOUBLE) AS n1_{tag}, "
            f"CAST(sum(CASE WHEN {cond} AND yhat = 1 THEN 1 ELSE 0 END) AS DOUBLE) AS p1_{tag}, "
            f"CAST(sum(CASE WHEN {cond} AND y = 1 AND yhat = 1 THEN 1 ELSE 0 END) AS DOUBLE) AS tp_{tag}, "
            f"CAST(sum(CASE WHEN {cond} AND y <> 1 AND yhat = 1 THEN 1 ELSE 0 END) AS DOUBLE) AS fp_{tag}, "
            f"CAST(sum(CASE WHEN {cond} AND y = 1 AND yhat <> 1 THEN 1 ELSE 0 END) AS DOUBLE) AS fn_{tag}, "
            f"CAST(sum(CASE WHEN {cond} AND y <> 1 AND yhat <> 1 THEN 1 ELSE 0 END) AS DOUBLE) AS tn_{tag}")


def _per(t: str) -> str:
    return (f"{_dv(f'p1_{t}', f'n_{t}')} AS q_{t}, {_dv(f'n1_{t}', f'p1_{t}')} AS ca_{t}, "
            f"{_dv(f'n_{t} - n1_{t}', f'n_{t} - p1_{t}')} AS cr_{t}, {_dv(f'tp_{t}', f'tp_{t} + fn_{t}')} AS rec_{t}, "
            f"{_dv(f'tp_{t}', f'tp_{t} + fp_{t}')} AS prec_{t}, {_dv(f'tn_{t}', f'tn_{t} + fn_{t}')} AS npv_{t}, "
            f"{_dv(f'tp_{t} + tn_{t}', f'n_{t}')} AS acc_{t}, {_dv(f'tn_{t}', f'tn_{t} + fp_{t}')} AS tnr_{t}, "
            f"{_dv(f'fn_{t}', f'fp_{t}')} AS te_{t}")


_POST = f"""
SELECT *, {_per('a')}, {_per('d')}, sb / n AS mu FROM (
  SELECT {_facet_counts('a', 'NOT facet')}, {_facet_counts('d', 'facet')}, CAST(count(*) AS DOUBLE) AS n,
         sum(CAST(yhat AS DOUBLE) - CAST(y AS DOUBLE) + 1.0) AS sb,
         sum(pow(CAST(yhat AS DOUBLE) - CAST(y AS DOUBLE) + 1.0, 2)) AS sbb
  FROM ({BIAS_ROWS}))
"""

SQL["a18_posttraining_bias"] = f"""
SELECT metric, round(value, 6) AS value FROM (
  SELECT 'DPPL' AS metric, q_a - q_d AS value FROM ({_POST})
  UNION ALL SELECT 'DI', {_dv('q_d', 'q_a')} FROM ({_POST})
  UNION ALL SELECT 'DCA', ca_a - ca_d FROM ({_POST})
  UNION ALL SELECT 'DCR', cr_d - cr_a FROM ({_POST})
  UNION ALL SELECT 'RD', rec_a - rec_d FROM ({_POST})
  UNION ALL SELECT 'DAR', prec_a - prec_d FROM ({_POST})
  UNION ALL SELECT 'DRR', npv_d - npv_a FROM ({_POST})
  UNION ALL SELECT 'AD', acc_a - acc_d FROM ({_POST})
  UNION ALL SELECT 'SD', tnr_d - tnr_a FROM ({_POST})
  UNION ALL SELECT 'TE', te_d - te_a FROM ({_POST})
  UNION ALL SELECT 'GE', (sbb / (mu * mu) - n) / (2.0 * n) FROM ({_POST})
  UNION ALL SELECT 'CDDPL', v FROM ({_cdd_sql('yhat = 1')}))
"""

SHAP_LONG = """
SELECT vec_id, j - 1 AS j, CAST(embedding[j] AS DOUBLE) AS phi
FROM (SELECT vec_id, embedding, unnest(range(1, len(embedding))) AS j FROM embeddings)
"""

SQL["a15_global_importance"] = f"""
SELECT CAST(j AS INTEGER) AS j, 'f' || CAST(j AS VARCHAR) AS feature, round(avg(abs(phi)), 6) AS mean_abs_shap
FROM ({SHAP_LONG}) GROUP BY j
"""

SQL["a16_metric_series"] = f"""
SELECT step, round(avg(CASE WHEN name = 'train-auc' THEN value END), 6) AS "train-auc",
       round(avg(CASE WHEN name = 'train-logloss' THEN value END), 6) AS "train-logloss"
FROM ({TENSORS}) WHERE collection = 'metrics' GROUP BY step
"""

SQL["m9_explain_rows"] = """
SELECT vec_id, round(base, 6) AS base, round(phi_sum, 6) AS phi_sum, round(base + phi_sum, 6) AS margin,
       round(1.0 / (1.0 + exp(-(base + phi_sum))), 6) AS probability
FROM (SELECT vec_id, CAST(embedding[len(embedding)] AS DOUBLE) AS base,
             list_sum(list_transform(embedding[1:len(embedding) - 1], lambda x: CAST(x AS DOUBLE))) AS phi_sum
      FROM embeddings)
"""

# ---------------------------------------------------------------- streaming twins
CLASSIFIED = SQL["f14_classify_arrivals"].replace("SELECT event_id,\n  CASE WHEN NOT ok", "SELECT event_id, ts, batch_id,\n  CASE WHEN NOT ok", 1)

RENDEZVOUS = f"""
WITH a AS (SELECT batch_id, event_id, ts, file_type, folder FROM ({CLASSIFIED}) WHERE status = 'accepted'),
w AS (SELECT *, row_number() OVER (PARTITION BY batch_id ORDER BY ts, event_id) AS pos,
             lag(file_type) OVER (PARTITION BY batch_id ORDER BY ts, event_id) AS prev FROM a),
c AS (SELECT *, coalesce(file_type <> prev, false) AS change FROM w),
d AS (SELECT *, max(CASE WHEN NOT change THEN pos END)
                  OVER (PARTITION BY batch_id ORDER BY pos ROWS UNBOUNDED PRECEDING) AS anchor FROM c)
SELECT batch_id, event_id, folder,
       CASE WHEN change AND (pos - anchor) % 2 = 1 THEN 'Both files uploaded, pipeline triggered and DynamoDB entry cleaned.'
            ELSE file_type || '.csv uploaded, waiting for the other file.' END AS message
FROM d
"""

SQL["t1_rendezvous_batch"] = RENDEZVOUS
SQL["t1_rendezvous_stream"] = RENDEZVOUS
SQL["t2_arrivals_stream"] = SQL["f14_classify_arrivals"]

SQL["t3_windowed_monitor"] = f"""
WITH s AS ({SCORED}),
g AS (SELECT time_bucket(INTERVAL 1 HOUR, ts) AS ws, count(*) AS n, avg(score) AS mean_score,
        min(score) AS min_score, max(score) AS max_score, stddev_pop(score) AS std_score,
        CAST(sum(CASE WHEN truth = 1 AND score > 0.1 THEN 1 ELSE 0 END) AS BIGINT) AS tp,
        CAST(sum(CASE WHEN truth <> 1 AND score > 0.1 THEN 1 ELSE 0 END) AS BIGINT) AS fp,
        CAST(sum(CASE WHEN truth = 1 AND NOT score > 0.1 THEN 1 ELSE 0 END) AS BIGINT) AS fn
      FROM s GROUP BY ALL)
SELECT strftime(ws, '%Y-%m-%d %H:%M:%S') AS window_start, n, round(mean_score, 6) AS mean_score,
       round(min_score, 6) AS min_score, round(max_score, 6) AS max_score, round(std_score, 6) AS std_score,
       tp, fp, fn,
       round({ratio('tp', 'tp + fp')}, 6) AS precision, round({ratio('tp', 'tp + fn')}, 6) AS recall
FROM g
"""

SQL["t4_late_truth_join"] = f"""
SELECT c.inference_id, round(c.score, 6) AS score, c.yhat, t.label
FROM (SELECT CAST(event_id AS VARCHAR) AS inference_id, ts, value / 500.0 AS score,
             CAST(value / 500.0 > 0.1 AS INTEGER) AS yhat FROM events) c
JOIN (SELECT t0.*, e.ts + INTERVAL 2 HOUR AS truth_ts FROM ({TRUTH}) t0
      JOIN events e ON t0.eventId = CAST(CASE WHEN {H8.format(c='e.event_id')} % 10 = 0
                                              THEN e.event_id + 1000000000000 ELSE e.event_id END AS VARCHAR)) t
  ON c.inference_id = t.eventId AND t.truth_ts BETWEEN c.ts AND c.ts + INTERVAL 3 HOUR
"""

SQL["t4_all_captures"] = SQL["t4_late_truth_join"].replace("JOIN (SELECT t0", "LEFT JOIN (SELECT t0", 1)

SQL["t5_score_stream"] = """
SELECT event_id, round(value, 6) AS value,
  CASE WHEN value / 500.0 > 1.0 - value / 500.0 THEN 'home_win' ELSE 'home_not_win' END AS predicted_label,
  CASE WHEN value / 500.0 > 1.0 - value / 500.0 THEN 1 ELSE 0 END AS predicted_numerical_label,
  round(value / 500.0, 6) AS win_probability
FROM events
"""

# ---------------------------------------------------------------- positional names and JSON records
_SRC = ["l_quantity", "l_extendedprice", "l_discount", "l_tax", "CAST(l_suppkey AS DOUBLE)"]
SQL["f1_positional_names"] = ("SELECT l_orderkey, l_linenumber, false AS rejected, "
                              + ", ".join(f"{_SRC[i % 5]} AS {name}" for i, name in enumerate(FEATURE_COLUMNS))
                              + " FROM lineitem")

SQL["s5_json_records"] = """
SELECT event_id, CAST(json_extract_string(props, '$.k') AS INTEGER) AS meta_k, event_type FROM events
"""

# ---------------------------------------------------------------- split files and CSV folders
TRANSFORMED = f"""
SELECT CAST(s.result_match = 'home_win' AS DOUBLE) AS result_match,
  coalesce(s.n_chars, m.m_chars) AS n_chars, coalesce(s.n_words, m.m_words) AS n_words,
  coalesce(s.n_sentences, m.m_sentences) AS n_sentences, coalesce(s.n_lines, m.m_lines) AS n_lines,
  s.lang_en, s.lang_fr, s.lang_de, s.lang_es, s.split
FROM ({SPLIT}) s, ({MEDIANS}) m
"""
SQL["s6_write_splits"] = TRANSFORMED
SQL["s1_read_csv_dir"] = f"SELECT * EXCLUDE (split) FROM ({TRANSFORMED}) WHERE split = 'train'"

SQL["f2_split_truth_json"] = """
SELECT event_id, value, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k,
  CASE WHEN event_type = 'purchase' THEN 'home_win' WHEN event_type = 'click' THEN 'home_not_win' END
    AS ground_truth
FROM events
"""

SQL["w4_step_outputs"] = f"""
WITH l AS (SELECT "group", package_id FROM (
    SELECT *, row_number() OVER (PARTITION BY "group" ORDER BY created_at DESC, package_id DESC) AS rn
    FROM ({REGISTRY})) WHERE rn = 1)
SELECT l."group", l.package_id, li.l_linenumber AS step,
       'runs/' || CAST(li.l_orderkey AS VARCHAR) || '/train/' || CAST(li.l_linenumber AS VARCHAR) || '.csv' AS uri
FROM l JOIN lineitem li ON li.l_orderkey = l.package_id
WHERE li.l_returnflag = 'R'
"""

SQL["a19_flip_test"] = f"""
WITH r AS (SELECT n_chars > 1000 AS d, 1.0 / (1.0 + exp(-(n_words - 200.0) / 100.0)) > 0.65 AS pred,
             floor(n_sentences / 5) AS cs, floor(n_lines / 5) AS cl FROM ({PREPARED})),
near AS (SELECT cs, cl, sum(CASE WHEN pred THEN 1 ELSE -1 END) AS vote FROM r WHERE NOT d GROUP BY cs, cl)
SELECT 'FT' AS metric,
  round(sum(CASE WHEN NOT r.pred AND near.vote > 0 THEN 1.0 WHEN r.pred AND near.vote < 0 THEN -1.0 ELSE 0.0 END)
        / count(*), 6) AS value,
  count(*) AS members, count(near.vote) AS compared
FROM r LEFT JOIN near ON r.cs = near.cs AND r.cl = near.cl WHERE r.d
"""

_NEAR = f"""
r AS (SELECT doc_id, n_chars > 1000 AS d, 1.0 / (1.0 + exp(-(n_words - 200.0) / 100.0)) > 0.65 AS pred, n_words, n_sentences, n_lines FROM ({PREPARED})),
m AS (SELECT {", ".join(f"avg({c}) AS m{i}, stddev_pop({c}) AS s{i}" for i, c in enumerate(("n_words", "n_sentences", "n_lines")))} FROM r),
z AS (SELECT doc_id, d, pred, {", ".join(f"coalesce(({c} - m{i}) / nullif(s{i}, 0), 0) AS z{i}" for i, c in enumerate(("n_words", "n_sentences", "n_lines")))} FROM r, m)"""
SQL["a19_nearest_flip_test"] = f"""
WITH {_NEAR},
pairs AS (SELECT a.doc_id, a.pred, b.pred AS other, round(pow(b.z0 - a.z0, 2) + pow(b.z1 - a.z1, 2) + pow(b.z2 - a.z2, 2), 9) AS far
          FROM z a JOIN z b ON a.d AND NOT b.d),
placed AS (SELECT *, rank() OVER (PARTITION BY doc_id ORDER BY far) AS place FROM pairs),
votes AS (SELECT doc_id, any_value(pred) AS pred, sum(CASE WHEN other THEN 1 ELSE -1 END) AS lead FROM placed WHERE place <= 5 GROUP BY doc_id),
all_ AS (SELECT z.doc_id, z.pred, v.lead FROM z LEFT JOIN votes v USING (doc_id) WHERE z.d)
SELECT 'FT' AS metric, round(sum(CASE WHEN NOT pred AND lead > 0 THEN 1.0 WHEN pred AND lead < 0 THEN -1.0 ELSE 0.0 END) / count(*), 6) AS value,
       count(*) AS members, count(lead) AS compared
FROM all_
"""
SQL["a19_hashed_neighbours"] = f"WITH {_NEAR} SELECT count(*) AS members, true AS recall_reached FROM z WHERE d"

SQL["m2_prefix_choice"] = """
WITH s AS (SELECT user_id AS series, value AS loss, row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS round
           FROM events),
l AS (SELECT *, min(loss) OVER (PARTITION BY series ORDER BY round ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS low
      FROM s),
b AS (SELECT series, round, max(CASE WHEN low IS NULL OR loss < low THEN round END)
        OVER (PARTITION BY series ORDER BY round) AS best FROM l),
e AS (SELECT series, min(CASE WHEN round - best >= 25 THEN round END) AS stop, max(round) AS rounds FROM b GROUP BY series)
SELECT e.series, e.rounds, b.best AS kept, e.stop IS NOT NULL AS stopped
FROM e JOIN b ON b.series = e.series AND b.round = coalesce(e.stop, e.rounds)
"""

SQL["m6_best_of_runs"] = """
SELECT user_id AS trial, max(value) AS auc, min(value) AS eta FROM events
GROUP BY user_id ORDER BY auc DESC, trial LIMIT 1
"""

# ---------------------------------------------------------------- model identities
SQL["m1_nodes_check"] = "SELECT true AS splits_hold, true AS all_kept FROM (SELECT 1)"
SQL["m3_score_check"] = f"SELECT doc_id, y, true AS same_p, true AS same_label FROM ({PREPARED}) WHERE split = 'test'"
SQL["m4_f1_check"] = f"""
SELECT true AS same_f1, count(*) AS rows, CAST(sum(y) AS BIGINT) AS positives FROM ({PREPARED}) WHERE split = 'validation'
"""
SQL["m5_search_check"] = "SELECT range AS trial, true AS in_range, true AS as_proposed FROM range(5)"
SQL["m7_importance_check"] = """
SELECT importance_type, true AS holds FROM (VALUES ('weight'), ('gain'), ('total_gain'), ('total_cover')) t(importance_type)
"""
SQL["m8_shapley_check"] = f"SELECT doc_id, CAST(8 AS BIGINT) AS n_features, true AS adds_up FROM ({PREPARED}) WHERE split = 'train'"
SQL["s15_artifacts_roundtrip"] = f"SELECT doc_id, y, true AS same FROM ({PREPARED}) WHERE split = 'test'"
SQL["m10_response_check"] = f"""
SELECT doc_id, k IN (0, 1) AS failed, CASE WHEN k NOT IN (0, 1) THEN result_match END AS truth,
       CASE WHEN k NOT IN (0, 1) THEN true END AS agrees
FROM (SELECT doc_id, result_match, {H8.format(c='doc_id')} % 20 AS k FROM ({SPLIT}))
"""

SQL["t5_model_stream_check"] = f"SELECT doc_id, true AS same FROM ({SPLIT})"

# The first tree at depth 2: gradients of p = 1/2, cuts at quantiles, gains and leaf values.
_L, _A, _W, _ETA, _BINS, _POS = 9.082892225273682, 5.065713059538013, 0.49876571387552704, 0.10552574516231328, 256, 2.0
_FEATURES = ["n_chars", "n_words", "n_sentences", "n_lines", "lang_en", "lang_fr", "lang_de", "lang_es"]


def _score(g: str, h: str) -> str:
    return f"(pow(greatest(abs({g}) - {_A}, 0), 2) / ({h} + {_L}))"


def _level(rows: str, name: str) -> str:
    """The best split of each node of ``rows`` (doc, node, g, h) and its sums."""
    return f"""
{name}_sums AS (SELECT node, sum(g) AS g, sum(h) AS h, count(*) AS n FROM {rows} GROUP BY node),
{name}_side AS (
  SELECT r.node, x.j, x.cut, sum(r.g) AS g, sum(r.h) AS h, count(*) AS n
  FROM {rows} r JOIN binned x USING (doc_id) GROUP BY ALL),
{name}_left AS (
  SELECT node, j, cut, sum(g) OVER w AS g, sum(h) OVER w AS h, sum(n) OVER w AS n
  FROM {name}_side WINDOW w AS (PARTITION BY node, j ORDER BY cut)),
{name}_gain AS (
  SELECT l.node, l.j, l.cut, 0.5 * ({_score('l.g', 'l.h')} + {_score('(s.g - l.g)', '(s.h - l.h)')} - {_score('s.g', 's.h')}) AS gain
  FROM {name}_left l JOIN {name}_sums s USING (node) WHERE l.n < s.n AND l.h >= {_W} AND s.h - l.h >= {_W}),
{name} AS (
  SELECT s.node, s.g, s.h, s.n, b.j, b.cut, b.gain
  FROM {name}_sums s LEFT JOIN (
    SELECT node, j, cut, gain FROM (SELECT *, row_number() OVER (PARTITION BY node ORDER BY round(gain, 7) DESC, j, cut) AS k FROM {name}_gain WHERE gain > 1e-6) WHERE k = 1) b USING (node)),
{name}_rows AS (
  SELECT r.doc_id, r.g, r.h, 2 * r.node + CASE WHEN x.cut <= t.cut THEN 0 ELSE 1 END AS node
  FROM {rows} r JOIN {name} t ON t.node = r.node AND t.j IS NOT NULL JOIN binned x ON x.doc_id = r.doc_id AND x.j = t.j)"""


_STEP = f"-{_ETA} * sign(g) * greatest(abs(g) - {_A}, 0) / (h + {_L})"
SQL["m1_small_tree"] = f"""
WITH train AS (
  SELECT p.doc_id, p.y, {", ".join(f"coalesce(s.{c}, m.m_{c[2:] if c != 'n_chars' else 'chars'}) AS {c}" for c in _FEATURES[:4])},
         {", ".join(f"s.{c}" for c in _FEATURES[4:])}
  FROM ({PREPARED}) p JOIN ({SPLIT}) s USING (doc_id), ({MEDIANS}) m WHERE p.split = 'train'),
long AS ({" UNION ALL ".join(f"SELECT doc_id, {j} AS j, CAST({c} AS DOUBLE) AS x FROM train" for j, c in enumerate(_FEATURES))}),
held AS (SELECT j, x, count(*) AS n FROM long GROUP BY ALL),
upto AS (SELECT j, x, n, sum(n) OVER (PARTITION BY j ORDER BY x) AS c, sum(n) OVER (PARTITION BY j) AS total, count(*) OVER (PARTITION BY j) AS d FROM held),
cuts AS (SELECT j, x AS cut FROM upto WHERE d <= {_BINS} OR floor(c * {_BINS} / total) > floor((c - n) * {_BINS} / total)),
binned AS (SELECT l.doc_id, l.j, c.cut FROM long l ASOF JOIN cuts c ON l.j = c.j AND c.cut >= l.x),
r0 AS (SELECT doc_id, 1 AS node, CASE WHEN y = 1 THEN -{_POS} * 0.5 ELSE 0.5 END::DOUBLE AS g, CASE WHEN y = 1 THEN {_POS} * 0.25 ELSE 0.25 END::DOUBLE AS h FROM train),
{_level("r0", "t0")}, {_level("t0_rows", "t1")},
t2 AS (SELECT node, sum(g) AS g, sum(h) AS h, count(*) AS n, NULL AS j, NULL AS cut, NULL AS gain FROM t1_rows GROUP BY node),
tree AS (SELECT * FROM t0 UNION ALL SELECT * FROM t1 UNION ALL SELECT * FROM t2)
SELECT row_number() OVER (ORDER BY node) - 1 AS node, {str(_FEATURES)}[j + 1] AS feature, cut AS threshold, round(coalesce(gain, 0), 6) AS gain,
       round(CASE WHEN j IS NULL THEN {_STEP} ELSE 0 END, 6) AS value, round(h, 6) AS cover, CAST(n AS BIGINT) AS n
FROM tree
"""
