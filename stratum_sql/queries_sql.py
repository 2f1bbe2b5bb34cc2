"""DuckDB oracle SQL, one per deterministic query of ``stratum.plans.catalog``.

Written independently of the Spark plans: plain ``row_number`` where the Spark
side uses key boundaries, rank-based AUC where it uses bucketed running sums,
``median()`` where it uses histogram selection, ``count(DISTINCT)`` where it
compares min and max.
"""

import math
from html.entities import name2codepoint

from stratum_sql.fixtures_sql import HTML_PAGES
from stratum_sql.fixtures_sql import with_fixtures as W

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()

SQL: dict[str, str] = {}

# ----------------------------------------------------------------- sources

SQL["scan_full"] = "SELECT doc_id, text, lang FROM documents"

SQL["scan_range"] = """
SELECT event_id, ts, value FROM (
  SELECT event_id, ts, value, row_number() OVER (ORDER BY event_id) AS rn FROM events)
WHERE rn > 2000 AND rn <= 7000
"""

SQL["scan_project"] = W("SELECT event_id, value, k FROM sensors", "sensors")

SQL["scan_tail"] = """
SELECT event_id, value FROM (
  SELECT event_id, value, row_number() OVER (ORDER BY event_id) AS rn FROM events)
WHERE rn > 7000
"""

SQL["scan_prefix"] = "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_orderkey LIMIT 2500"

SQL["table_profile"] = "\nUNION ALL\n".join(
    f"SELECT '{t}' AS table_name, count(*) AS n_rows, "
    f"(SELECT CAST(count(*) AS INTEGER) FROM information_schema.columns WHERE table_name = '{t}') AS n_cols, "
    "(SELECT string_agg(column_name || ':' || regexp_replace(replace(replace(lower(data_type), 'varchar', 'string'), 'integer', 'int'), "
    "'^(.*)\\[\\]$', 'array<\\1>'), ', ' ORDER BY ordinal_position) "
    f"FROM information_schema.columns WHERE table_name = '{t}') AS columns "
    f"FROM {t}"
    for t in TABLES
)

# ----------------------------------------------------------------- cleaning

SQL["lower_columns"] = W('SELECT doc_id, "Text" AS text, "Label" AS label FROM news_raw', "news_raw")

_LBL = "lower(regexp_replace(\"Label\", '^\\s+|\\s+$', '', 'g'))"
SQL["label_normalize"] = W(
    f"SELECT doc_id, CASE WHEN {_LBL} IN ('true', '1') THEN 1 WHEN {_LBL} IN ('false', '0') THEN 0 END AS label "
    "FROM news_raw",
    "news_raw",
)

SQL["label_from_rating"] = W(
    """SELECT "uniqueID", rating, CASE WHEN rating >= 7 THEN 1 ELSE 0 END AS sentiment
       FROM reviews WHERE rating >= 7 OR rating <= 4""",
    "reviews",
)

SQL["label_binarize"] = W(
    """SELECT txn_id, CAST(coalesce(CASE WHEN isnan(TRY_CAST(isFlaggedFraud AS DOUBLE)) THEN NULL
                                         ELSE TRY_CAST(isFlaggedFraud AS DOUBLE) END, 0) > 0 AS INTEGER) AS flagged
       FROM transactions""",
    "transactions",
)

SQL["to_numeric"] = W(
    """SELECT loan_id, CASE WHEN isnan(TRY_CAST(rental30 AS DOUBLE)) THEN NULL
                           ELSE TRY_CAST(rental30 AS DOUBLE) END AS rental30 FROM loans""",
    "loans",
)

SQL["align_schema"] = W(
    "SELECT label, aon, rental30, CAST(NULL AS DOUBLE) AS fr_ma_rech30, pcircle FROM loans", "loans"
)

SQL["drop_identifiers"] = W(
    """SELECT txn_id, step, "type", amount, oldbalanceOrg, newbalanceOrig, oldbalanceDest, newbalanceDest,
              isFlaggedFraud FROM transactions""",
    "transactions",
)

SQL["select_numeric"] = W('SELECT value, k, hour, const_one, "TTF leak", fault_occurred FROM sensors', "sensors")

SQL["candidate_features"] = W(
    'SELECT event_id, "time", stage, runnum, value, k, hour, const_one, "TTF leak" FROM sensors', "sensors"
)

SQL["prune_constant"] = W(
    "\nUNION ALL\n".join(
        f"SELECT '{c}' AS feature, CAST(count(DISTINCT \"{c}\") > 1 AS INTEGER) AS varying FROM sensors"
        for c in ["value", "k", "hour", "const_one", "TTF leak"]
    ),
    "sensors",
)

SQL["time_to_epoch"] = W(
    """SELECT event_id, CAST(floor(epoch("time")) AS DOUBLE) AS epoch,
              CAST(floor(epoch(TRY_CAST(time_text AS TIMESTAMP))) AS DOUBLE) AS epoch_text
       FROM sensors""",
    "sensors",
)

_PDATE = "coalesce(try_strptime(pdate, '%d-%m-%Y'), try_strptime(pdate, '%m/%d/%Y'), try_strptime(pdate, '%Y-%m-%d'))"
SQL["parse_date_multi"] = W(f"SELECT loan_id, pdate, CAST({_PDATE} AS DATE) AS pdate_parsed FROM loans", "loans")

SQL["calendar_parts"] = W(
    f"""SELECT loan_id, year(d) AS pdate_year, month(d) AS pdate_month, isodow(d) - 1 AS pdate_dayofweek
        FROM (SELECT loan_id, CAST({_PDATE} AS DATE) AS d FROM loans)""",
    "loans",
)

SQL["day_of_year"] = W(
    """SELECT loan_id,
              dayofyear(try_strptime(printf('2000-%02d-%02d', m, d), '%Y-%m-%d')) AS last_rech_dayofyear
       FROM (SELECT loan_id,
                    CASE WHEN last_rech_date_ma = floor(last_rech_date_ma) THEN CAST(last_rech_date_ma AS INTEGER) END AS m,
                    CASE WHEN last_rech_date_da = floor(last_rech_date_da) THEN CAST(last_rech_date_da AS INTEGER) END AS d
             FROM loans)""",
    "loans",
)

_RATIOS = [
    ("payback_rate30", "payback30", "cnt_loans30"),
    ("payback_rate90", "payback90", "cnt_loans90"),
    ("avg_loan_amt30", "amnt_loans30", "cnt_loans30"),
    ("avg_loan_amt90", "amnt_loans90", "cnt_loans90"),
    ("avg_rech_amt30", "sumamnt_ma_rech30", "cnt_ma_rech30"),
    ("avg_rech_amt90", "sumamnt_ma_rech90", "cnt_ma_rech90"),
]
SQL["safe_ratio"] = W(
    "SELECT loan_id, "
    + ", ".join(f"round(CASE WHEN {b} IS NULL OR {b} = 0 THEN NULL ELSE {a} / {b} END, 6) AS {n}" for n, a, b in _RATIOS)
    + " FROM loans",
    "loans",
)

SQL["cast_category"] = W("SELECT event_id, CAST(stage AS VARCHAR) AS stage FROM sensors", "sensors")

SQL["inf_to_null"] = W(
    """SELECT txn_id,
              CASE WHEN abs(amount) = CAST('inf' AS DOUBLE) THEN NULL ELSE amount END AS amount,
              CASE WHEN abs(oldbalanceDest) = CAST('inf' AS DOUBLE) THEN NULL ELSE oldbalanceDest END AS oldbalanceDest
       FROM transactions""",
    "transactions",
)

SQL["fill_defaults"] = W(
    """SELECT txn_id, coalesce("type", 'TRANSFER') AS "type", coalesce(amount, 0.0) AS amount,
              CAST(0.0 AS DOUBLE) AS step FROM transactions""",
    "transactions",
)

SQL["decode_label"] = W(
    """SELECT event_id,
              CASE label WHEN 1 THEN 'Fraud' WHEN 0 THEN 'Non-fraud' END AS label_name,
              CASE prediction WHEN 1 THEN 'Fraud' WHEN 0 THEN 'Non-fraud' END AS prediction_name
       FROM scored""",
    "scored",
)

SQL["class_confidence"] = W(
    "SELECT event_id, round(CASE WHEN prediction = 1 THEN probability ELSE 1 - probability END, 6) AS confidence "
    "FROM scored",
    "scored",
)

SQL["parse_json_rows"] = """
SELECT event_id,
       CASE WHEN event_id % 50 = 0 THEN NULL ELSE TRY_CAST(json_extract_string(props, '$.k') AS BIGINT) END AS k,
       CASE WHEN event_id % 50 = 0 THEN 'not a JSON object' END AS error
FROM events
"""

SQL["round_probability"] = "SELECT event_id, round(value / 7, 6) AS p6 FROM events"

# ------------------------------------------------------------------ filters

SQL["drop_nulls"] = W('SELECT doc_id FROM news_raw WHERE "Text" IS NOT NULL AND "Label" IS NOT NULL', "news_raw")

SQL["filter_in_set"] = W("SELECT doc_id, text, label FROM news_clean", "news_clean")

_NOINF = "CASE WHEN abs({c}) = CAST('inf' AS DOUBLE) THEN NULL ELSE {c} END"
_TXN_CLEAN = f"""
SELECT txn_id, step, "type", {_NOINF.format(c='amount')} AS amount,
       {_NOINF.format(c='oldbalanceOrg')} AS oldbalanceOrg, {_NOINF.format(c='newbalanceOrig')} AS newbalanceOrig,
       {_NOINF.format(c='oldbalanceDest')} AS oldbalanceDest, {_NOINF.format(c='newbalanceDest')} AS newbalanceDest,
       isFlaggedFraud, isFraud
FROM transactions
"""

SQL["complete_case"] = W(
    f"""SELECT * FROM ({_TXN_CLEAN}) t
        WHERE step IS NOT NULL AND "type" IS NOT NULL AND amount IS NOT NULL AND oldbalanceOrg IS NOT NULL
          AND newbalanceOrig IS NOT NULL AND oldbalanceDest IS NOT NULL AND newbalanceDest IS NOT NULL
          AND isFlaggedFraud IS NOT NULL""",
    "transactions",
)

_FLAG = "coalesce(CAST(trunc(TRY_CAST({c} AS DOUBLE)) AS INTEGER), 0)"
SQL["filter_status"] = W(
    f"SELECT txn_id, amount, isFlaggedFraud FROM ({_TXN_CLEAN}) t WHERE {_FLAG.format(c='isFlaggedFraud')} = 1",
    "transactions",
)

SQL["filter_prediction"] = W("SELECT event_id, probability FROM scored WHERE prediction = 1", "scored")

SQL["filter_blank_text"] = W(
    """SELECT doc_id, CASE WHEN "Text" IS NULL OR NOT regexp_matches("Text", '\\S') THEN 'empty text' END AS error
       FROM news_raw""",
    "news_raw",
)

SQL["threshold"] = W("SELECT event_id, CAST(probability >= 0.3 AS INTEGER) AS prediction FROM scored", "scored")

# --------------------------------------------------------------- aggregates

SQL["status_summary"] = W(
    f"""SELECT total, non_fraud, fraud,
              round(CASE WHEN fraud + non_fraud = 0 THEN 0 ELSE fraud / (fraud + non_fraud) END, 6) AS fraud_rate,
              flagged, round(CASE WHEN total = 0 THEN 0 ELSE flagged / total END, 6) AS flagged_rate
       FROM (SELECT count(*) AS total,
                    count(*) FILTER (WHERE {_FLAG.format(c='isFraud')} = 0) AS non_fraud,
                    count(*) FILTER (WHERE {_FLAG.format(c='isFraud')} = 1) AS fraud,
                    count(*) FILTER (WHERE {_FLAG.format(c='isFlaggedFraud')} = 1) AS flagged
             FROM transactions)""",
    "transactions",
)

_SENS = ["value", "k", "hour", "const_one", "TTF leak"]
SQL["profile_numeric"] = W(
    "\nUNION ALL\n".join(
        f"""SELECT '{c}' AS feature, round(min("{c}"), 6) AS min, round(max("{c}"), 6) AS max,
                   round(median("{c}"), 6) AS median FROM sensors"""
        for c in _SENS
    ),
    "sensors",
)

_LOAN_NUM = [
    "aon", "daily_decr30", "rental30", "rental90", "cnt_loans30", "amnt_loans30", "maxamnt_loans30",
    "minamnt_loans90", "payback30", "sumamnt_ma_rech90",
]
SQL["median_fit"] = W(
    "WITH ln AS (SELECT * REPLACE (CASE WHEN isnan(TRY_CAST(rental30 AS DOUBLE)) THEN NULL "
    "ELSE TRY_CAST(rental30 AS DOUBLE) END AS rental30) FROM loans)\n"
    + "\nUNION ALL\n".join(
        f"SELECT '{c}' AS feature, round(CAST(median({c}) AS DOUBLE), 6) AS median FROM ln" for c in _LOAN_NUM
    ),
    "loans",
)

SQL["median_impute"] = W(
    """SELECT event_id, coalesce(value, (SELECT median(value) FROM sensors)) AS value,
              coalesce(k, (SELECT median(k) FROM sensors)) AS k FROM sensors""",
    "sensors",
)

SQL["mode_impute"] = W(
    """WITH m AS (SELECT loan_id, CASE WHEN loan_id % 11 = 0 THEN NULL ELSE pcircle END AS pcircle FROM loans),
            top AS (SELECT pcircle FROM m WHERE pcircle IS NOT NULL GROUP BY pcircle
                    ORDER BY count(*) DESC, pcircle LIMIT 1)
       SELECT loan_id, coalesce(m.pcircle, (SELECT pcircle FROM top)) AS pcircle FROM m""",
    "loans",
)

SQL["scale_standard"] = W(
    "SELECT event_id, "
    + ", ".join(
        f"""round(("{c}" - avg("{c}") OVER ()) / coalesce(nullif(stddev_pop("{c}") OVER (), 0), 1), 6) AS "{c}\""""
        for c in _SENS
    )
    + " FROM sensors",
    "sensors",
)

SQL["scale_nomean"] = W(
    "SELECT event_id, "
    + ", ".join(f"""round("{c}" / coalesce(nullif(stddev_pop("{c}") OVER (), 0), 1), 6) AS "{c}\"""" for c in _SENS)
    + " FROM sensors",
    "sensors",
)

_TYPES = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]
SQL["one_hot"] = W(
    "SELECT txn_id, "
    + ", ".join(f"CAST(coalesce(\"type\" = '{v}', false) AS INTEGER) AS \"type_{v}\"" for v in _TYPES)
    + " FROM transactions",
    "transactions",
)

SQL["class_weights"] = W(
    """SELECT fault_occurred, n,
              round(CASE WHEN k >= 2 THEN total / (k * n) ELSE 1.0 END, 6) AS weight
       FROM (SELECT fault_occurred, count(*) AS n, sum(count(*)) OVER () AS total, count(*) OVER () AS k
             FROM sensors WHERE fault_occurred IS NOT NULL GROUP BY fault_occurred)""",
    "sensors",
)

SQL["class_presence"] = W(
    """SELECT n_classes, CAST(n_classes >= 2 AS INTEGER) AS can_train
       FROM (SELECT count(DISTINCT fault_occurred) AS n_classes FROM sensors)""",
    "sensors",
)

_CM = """SELECT count(*) FILTER (WHERE label = 0 AND prediction = 0) AS tn,
                count(*) FILTER (WHERE label = 0 AND prediction = 1) AS fp,
                count(*) FILTER (WHERE label = 1 AND prediction = 0) AS fn,
                count(*) FILTER (WHERE label = 1 AND prediction = 1) AS tp FROM {src}"""


def _metrics(cm: str) -> str:
    return f"""SELECT tn, fp, fn, tp,
       round(CASE WHEN tn + fp + fn + tp = 0 THEN 0 ELSE (tp + tn) / (tn + fp + fn + tp) END, 6) AS accuracy,
       round(CASE WHEN tp + fp = 0 THEN 0 ELSE tp / (tp + fp) END, 6) AS precision,
       round(CASE WHEN tp + fn = 0 THEN 0 ELSE tp / (tp + fn) END, 6) AS recall,
       round(CASE WHEN 2 * tp + fp + fn = 0 THEN 0 ELSE 2 * tp / (2 * tp + fp + fn) END, 6) AS f1
FROM ({cm})"""


SQL["confusion_matrix"] = W(_CM.format(src="scored"), "scored")
SQL["binary_metrics"] = W(_metrics(_CM.format(src="scored")), "scored")

SQL["classification_report"] = W(
    f"""WITH cm AS ({_CM.format(src='scored')}),
    c AS (SELECT *, CASE WHEN tn + fn = 0 THEN 0 ELSE tn / (tn + fn) END AS p0,
                    CASE WHEN tn + fp = 0 THEN 0 ELSE tn / (tn + fp) END AS r0,
                    CASE WHEN tp + fp = 0 THEN 0 ELSE tp / (tp + fp) END AS p1,
                    CASE WHEN tp + fn = 0 THEN 0 ELSE tp / (tp + fn) END AS r1,
                    CAST(tn + fp AS DOUBLE) AS s0, CAST(tp + fn AS DOUBLE) AS s1 FROM cm),
    f AS (SELECT *, CASE WHEN p0 + r0 = 0 THEN 0 ELSE 2 * p0 * r0 / (p0 + r0) END AS f0,
                    CASE WHEN p1 + r1 = 0 THEN 0 ELSE 2 * p1 * r1 / (p1 + r1) END AS f1_,
                    CASE WHEN s0 + s1 = 0 THEN 0 ELSE (tp + tn) / (s0 + s1) END AS acc FROM c)
    SELECT class, round(precision, 6) AS precision, round(recall, 6) AS recall, round(f1, 6) AS f1, support FROM (
      SELECT '0' AS class, p0 AS precision, r0 AS recall, f0 AS f1, s0 AS support FROM f
      UNION ALL SELECT '1', p1, r1, f1_, s1 FROM f
      UNION ALL SELECT 'accuracy', acc, acc, acc, s0 + s1 FROM f
      UNION ALL SELECT 'macro avg', (p0 + p1) / 2, (r0 + r1) / 2, (f0 + f1_) / 2, s0 + s1 FROM f
      UNION ALL SELECT 'weighted avg', (p0 * s0 + p1 * s1) / (s0 + s1), (r0 * s0 + r1 * s1) / (s0 + s1),
                       (f0 * s0 + f1_ * s1) / (s0 + s1), s0 + s1 FROM f)""",
    "scored",
)

# Mann-Whitney: AUC = (sum of average ranks of positives - P(P+1)/2) / (P N)
_AUC = """SELECT CASE WHEN P > 0 AND N > 0 THEN (R - P * (P + 1) / 2.0) / (P * N) END AS roc_auc
FROM (SELECT sum(CASE WHEN label = 1 THEN rk END) AS R,
             CAST(count(*) FILTER (WHERE label = 1) AS DOUBLE) AS P,
             CAST(count(*) FILTER (WHERE label <> 1) AS DOUBLE) AS N
      FROM (SELECT label,
                   rank() OVER (ORDER BY probability) + (count(*) OVER (PARTITION BY probability) - 1) / 2.0 AS rk
            FROM {src} WHERE probability IS NOT NULL AND label IS NOT NULL))"""
SQL["roc_auc"] = W(f"SELECT round(roc_auc, 6) AS roc_auc FROM ({_AUC.format(src='scored')})", "scored")

SQL["eval_partial_final"] = W(
    f"""WITH ev AS (SELECT label, probability, CAST(probability >= 0.5 AS INTEGER) AS prediction
                   FROM (SELECT *, row_number() OVER (ORDER BY event_id) AS rn FROM scored)
                   WHERE rn > floor((SELECT count(*) FROM scored) * 0.5)
                     AND rn <= floor((SELECT count(*) FROM scored) * 0.5) + floor((SELECT count(*) FROM scored) * 0.2)),
        m AS ({_metrics(_CM.format(src='ev'))}),
        a AS ({_AUC.format(src='ev')})
    SELECT m.*, round(a.roc_auc, 6) AS roc_auc FROM m, a""",
    "scored",
)

# ------------------------------------------------------------------- splits

SQL["split_range"] = """
SELECT event_id, CASE WHEN rn <= 5000 THEN 'train' WHEN rn <= 7000 THEN 'eval' ELSE 'live' END AS split
FROM (SELECT event_id, row_number() OVER (ORDER BY event_id) AS rn FROM events)
"""

SQL["split_shuffle"] = W(
    """SELECT doc_id, CASE WHEN rn > n - floor(n * 0.2) THEN 'test' ELSE 'train' END AS split
       FROM (SELECT doc_id, count(*) OVER () AS n,
                    row_number() OVER (ORDER BY substr(md5('42:' || CAST(doc_id AS VARCHAR)), 1, 13), doc_id) AS rn
             FROM news_clean)""",
    "news_clean",
)

SQL["split_stratified"] = W(
    """SELECT txn_id, isFraud, CASE WHEN rn <= ceil(0.2 * n) THEN 'test' ELSE 'train' END AS split
       FROM (SELECT txn_id, isFraud, count(*) OVER (PARTITION BY isFraud) AS n,
                    row_number() OVER (PARTITION BY isFraud
                                       ORDER BY substr(md5('42:' || CAST(txn_id AS VARCHAR)), 1, 13), txn_id) AS rn
             FROM transactions)""",
    "transactions",
)

SQL["sample_negatives"] = W(
    """SELECT event_id, fault_occurred FROM sensors WHERE fault_occurred = 1
       UNION ALL
       SELECT * FROM (SELECT event_id, fault_occurred FROM sensors WHERE fault_occurred <> 1
                      ORDER BY substr(md5('42:' || CAST(event_id AS VARCHAR)), 1, 13), event_id LIMIT 1000)""",
    "sensors",
)

SQL["row_at"] = "SELECT event_id, value FROM events ORDER BY event_id LIMIT 1 OFFSET 1234"

# ------------------------------------------------------------ sorts / top-k

SQL["page"] = W(
    f"""WITH f AS (SELECT txn_id, amount FROM ({_TXN_CLEAN}) t WHERE {_FLAG.format(c='isFraud')} = 0)
        SELECT txn_id, amount, (SELECT count(*) FROM f) AS total_rows FROM f ORDER BY txn_id LIMIT 50 OFFSET 1950""",
    "transactions",
)

SQL["indexed_page"] = "SELECT event_id, value, (SELECT count(*) FROM events) AS total_rows FROM events ORDER BY event_id LIMIT 50 OFFSET 1950"
SQL["indexed_range"] = "SELECT event_id, ts, value FROM events ORDER BY event_id LIMIT 4000 OFFSET 700"
SQL["indexed_row_at"] = "SELECT event_id, value FROM events ORDER BY event_id LIMIT 1 OFFSET 777"
SQL["indexed_split"] = """
SELECT event_id, CASE WHEN rn <= 5000 THEN 'train' WHEN rn <= 7000 THEN 'eval' ELSE 'live' END AS split
FROM (SELECT event_id, row_number() OVER (ORDER BY event_id) AS rn FROM events)
"""

SQL["preview"] = W("SELECT event_id, value, k FROM sensors ORDER BY event_id LIMIT 200", "sensors")

SQL["feature_ranking"] = W(
    """WITH imp AS (
         SELECT 'value' AS feature, abs(corr(value, fault_occurred)) AS importance FROM sensors
         UNION ALL SELECT 'k', abs(corr(k, fault_occurred)) FROM sensors
         UNION ALL SELECT 'hour', abs(corr(hour, fault_occurred)) FROM sensors
         UNION ALL SELECT 'TTF leak', abs(corr("TTF leak", fault_occurred)) FROM sensors)
       SELECT CAST(row_number() OVER (ORDER BY importance DESC, feature) AS INTEGER) AS rank, feature,
              round(importance, 6) AS importance,
              round(importance / max(importance) OVER (), 6) AS ratio
       FROM imp ORDER BY importance DESC, feature LIMIT 40""",
    "sensors",
)

SQL["union_all"] = W(
    f"""SELECT txn_id, isFraud, isFlaggedFraud FROM transactions WHERE isFraud = 1
        UNION ALL
        SELECT txn_id, isFraud, isFlaggedFraud FROM transactions WHERE {_FLAG.format(c='isFlaggedFraud')} = 1""",
    "transactions",
)

# --------------------------------------------------------------------- text

_TOK = r"regexp_extract_all(lower({c}), '[\p{{L}}\p{{N}}_]+')"
_TOK2 = r"regexp_extract_all(lower({c}), '[\p{{L}}\p{{N}}_]{{2,}}')"
_TERMS = (
    "list_concat(toks, list_transform(range(1, len(toks)), lambda i: toks[i] || ' ' || toks[i + 1]))"
)

SQL["tokenize"] = W(
    f"""SELECT doc_id, CAST(len(t) AS INTEGER) AS n_tokens, array_to_string(t, ' ') AS tokens
        FROM (SELECT doc_id, {_TOK.format(c='text')} AS t FROM news_clean)""",
    "news_clean",
)

SQL["ngrams"] = W(
    f"""SELECT "uniqueID", CAST(len(terms) AS INTEGER) AS n_terms, array_to_string(terms, '|') AS terms
        FROM (SELECT "uniqueID", {_TERMS} AS terms
              FROM (SELECT "uniqueID", {_TOK2.format(c='review')} AS toks FROM reviews))""",
    "reviews",
)

SQL["token_counts"] = W(
    f"""SELECT token, count(*) FILTER (WHERE label = 0) AS c0, count(*) FILTER (WHERE label = 1) AS c1
        FROM (SELECT label, unnest({_TOK.format(c='text')}) AS token FROM news_clean)
        GROUP BY token""",
    "news_clean",
)

_DOC_TERMS = f"""
  SELECT "uniqueID", token, count(*) AS tf
  FROM (SELECT "uniqueID", unnest({_TERMS}) AS token
        FROM (SELECT "uniqueID", {_TOK2.format(c='review')} AS toks FROM reviews))
  GROUP BY "uniqueID", token"""

SQL["doc_frequency"] = W(
    f"SELECT token, count(*) AS df, sum(tf) AS cf FROM ({_DOC_TERMS}) GROUP BY token", "reviews"
)
SQL["doc_frequency"] = SQL["doc_frequency"].replace("sum(tf) AS cf", "CAST(sum(tf) AS BIGINT) AS cf")

SQL["top_terms"] = W(
    f"""SELECT token, count(*) AS df, CAST(sum(tf) AS BIGINT) AS cf FROM ({_DOC_TERMS})
        GROUP BY token ORDER BY cf DESC, token LIMIT 50000""",
    "reviews",
)

SQL["tfidf"] = W(
    f"""WITH tf AS ({_DOC_TERMS}),
         vocab AS (SELECT token, ln((1 + (SELECT count(*) FROM reviews)) / (1.0 + count(*))) + 1 AS idf
                   FROM tf GROUP BY token ORDER BY sum(tf) DESC, token LIMIT 50000),
         w AS (SELECT "uniqueID", token, tf * idf AS w FROM tf JOIN vocab USING (token))
    SELECT "uniqueID", token, round(w / sqrt(sum(w * w) OVER (PARTITION BY "uniqueID")), 6) AS weight FROM w""",
    "reviews",
)

_NEWS_SPLIT = """
  SELECT doc_id, text, label, CASE WHEN rn > n - floor(n * 0.2) THEN 'test' ELSE 'train' END AS split
  FROM (SELECT *, count(*) OVER () AS n,
               row_number() OVER (ORDER BY substr(md5('42:' || CAST(doc_id AS VARCHAR)), 1, 13), doc_id) AS rn
        FROM news_clean)"""

_NB = f"""
  sp AS ({_NEWS_SPLIT}),
  train AS (SELECT * FROM sp WHERE split = 'train'),
  test AS (SELECT * FROM sp WHERE split = 'test'),
  terms AS (SELECT token, count(*) FILTER (WHERE label = 0) AS c0, count(*) FILTER (WHERE label = 1) AS c1
            FROM (SELECT label, unnest({_TOK.format(c='text')}) AS token FROM train) GROUP BY token),
  vocab AS (SELECT count(*) AS V, sum(c0) AS t0, sum(c1) AS t1 FROM terms),
  cls AS (SELECT label, count(*) AS n_docs FROM train GROUP BY label),
  pri AS (SELECT label, n_docs, (n_docs + 1.0) / (sum(n_docs) OVER () + count(*) OVER ()) AS prior FROM cls),
  tf AS (SELECT doc_id, token, count(*) AS tf
         FROM (SELECT doc_id, unnest({_TOK.format(c='text')}) AS token FROM test) GROUP BY doc_id, token),
  per AS (SELECT tf.doc_id, sum(tf.tf * ln(coalesce(t.c0, 0) + 1)) AS s0, sum(tf.tf * ln(coalesce(t.c1, 0) + 1)) AS s1,
                 sum(tf.tf) AS n_tok
          FROM tf LEFT JOIN terms t USING (token) GROUP BY tf.doc_id),
  sc AS (SELECT test.doc_id, test.label,
                ln((SELECT prior FROM pri WHERE label = 0)) + coalesce(per.s0, 0)
                  - coalesce(per.n_tok, 0) * ln((SELECT t0 + V FROM vocab)) AS score0,
                ln((SELECT prior FROM pri WHERE label = 1)) + coalesce(per.s1, 0)
                  - coalesce(per.n_tok, 0) * ln((SELECT t1 + V FROM vocab)) AS score1
         FROM test LEFT JOIN per USING (doc_id))"""

SQL["nb_fit"] = W(
    f"""WITH {_NB}
    SELECT CAST(p.label AS INTEGER) AS label, p.n_docs,
           CAST(CASE WHEN p.label = 0 THEN v.t0 ELSE v.t1 END AS BIGINT) AS total_words,
           round(p.prior, 6) AS prior, v.V AS vocab_size
    FROM pri p, vocab v""",
    "news_clean",
)

SQL["nb_score"] = W(
    f"""WITH {_NB}
    SELECT doc_id, round(score0, 6) AS score0, round(score1, 6) AS score1,
           CAST(score1 > score0 AS INTEGER) AS prediction, round(1 / (1 + exp(score0 - score1)), 6) AS probability
    FROM sc""",
    "news_clean",
)

SQL["nb_eval"] = W(
    f"""WITH {_NB},
    pr AS (SELECT label, CAST(score1 > score0 AS INTEGER) AS prediction FROM sc)
    {_metrics(_CM.format(src='pr'))}""",
    "news_clean",
)

# ------------------------------------------------------- described extras

SQL["recommend_topk"] = W(
    """SELECT "condition", CAST(rank AS INTEGER) AS rank, "drugName", round(score, 6) AS score,
              round(positive_rate, 6) AS positive_rate, n_reviews
       FROM (SELECT *, row_number() OVER (PARTITION BY "condition" ORDER BY score DESC, "drugName") AS rank
             FROM (SELECT "condition", "drugName",
                          sum(rating * (1 + coalesce("usefulCount", 0))) / sum(1 + coalesce("usefulCount", 0)) AS score,
                          avg(CASE WHEN rating >= 7 THEN 1.0 ELSE 0.0 END) AS positive_rate,
                          count(*) AS n_reviews
                   FROM reviews WHERE rating IS NOT NULL GROUP BY "condition", "drugName"))
       WHERE rank <= 3""",
    "reviews",
)

SQL["dedup_text"] = (
    "SELECT min(doc_id) AS doc_id FROM documents "
    r"GROUP BY trim(regexp_replace(lower(text), '\s+', ' ', 'g'))"
)

SQL["threshold_sweep"] = W(
    "\nUNION ALL\n".join(
        f"""SELECT CAST({t} AS DOUBLE) AS threshold, tn, fp, fn, tp,
       round(CASE WHEN tn + fp + fn + tp = 0 THEN 0 ELSE (tp + tn) / (tn + fp + fn + tp) END, 6) AS accuracy,
       round(CASE WHEN tp + fp = 0 THEN 0 ELSE tp / (tp + fp) END, 6) AS precision,
       round(CASE WHEN tp + fn = 0 THEN 0 ELSE tp / (tp + fn) END, 6) AS recall,
       round(CASE WHEN 2 * tp + fp + fn = 0 THEN 0 ELSE 2 * tp / (2 * tp + fp + fn) END, 6) AS f1
FROM (SELECT count(*) FILTER (WHERE label <> 1 AND probability < {t}) AS tn,
             count(*) FILTER (WHERE label <> 1 AND probability >= {t}) AS fp,
             count(*) FILTER (WHERE label = 1 AND probability < {t}) AS fn,
             count(*) FILTER (WHERE label = 1 AND probability >= {t}) AS tp
      FROM scored WHERE probability IS NOT NULL AND label IS NOT NULL)"""
        for t in [i / 10 for i in range(1, 10)]
    ),
    "scored",
)

SQL["drift_monitor"] = W(
    "WITH sp AS (SELECT *, CASE WHEN row_number() OVER (ORDER BY event_id) <= 5000 THEN 'train' ELSE 'live' END AS split "
    "FROM sensors)\n"
    + "\nUNION ALL\n".join(
        f"""SELECT '{c}' AS feature,
       round(avg("{c}") FILTER (WHERE split = 'train'), 6) AS mean_base,
       round(avg("{c}") FILTER (WHERE split = 'live'), 6) AS mean_other,
       round(avg("{c}") FILTER (WHERE split = 'live') - avg("{c}") FILTER (WHERE split = 'train'), 6) AS mean_shift,
       round(median("{c}") FILTER (WHERE split = 'train'), 6) AS median_base,
       round(median("{c}") FILTER (WHERE split = 'live'), 6) AS median_other,
       round(median("{c}") FILTER (WHERE split = 'live') - median("{c}") FILTER (WHERE split = 'train'), 6)
         AS median_shift
FROM sp"""
        for c in _SENS
    ),
    "sensors",
)

_LATE = """CASE event_id % 41 WHEN 0 THEN 'inf'::DOUBLE WHEN 1 THEN '-inf'::DOUBLE WHEN 2 THEN NULL ELSE value END"""
SQL["drift_distances"] = W(
    "WITH sp AS (SELECT *, CASE WHEN row_number() OVER (ORDER BY event_id) <= 5000 THEN 'train' ELSE 'live' END AS split FROM sensors),\n  long AS ("
    + " UNION ALL ".join(f"""SELECT '{c}' AS feature, split, CAST({_LATE if c == "value" else f'"{c}"'} AS DOUBLE) AS v FROM sp""" for c in _SENS)
    + """),
  counts AS (SELECT feature, """
    + ", ".join(
        f"count(*) FILTER (WHERE split = '{split}' AND {cond}) AS {name}_{side}"
        for side, split in (("base", "train"), ("other", "live"))
        for name, cond in (("n", "isfinite(v)"), ("null", "v IS NULL"), ("inf", "isinf(v)"))
    )
    + """ FROM long GROUP BY feature),
  vals AS (SELECT DISTINCT feature, v FROM long WHERE isfinite(v)),
  f AS (SELECT feature, v, (SELECT count(*) FROM long l WHERE l.feature = vals.feature AND split = 'train' AND l.v < vals.v AND isfinite(l.v)) AS below,
               (SELECT count(*) FROM long l WHERE l.feature = vals.feature AND split = 'train' AND l.v <= vals.v AND isfinite(l.v)) / n_base AS fb,
               (SELECT count(*) FROM long l WHERE l.feature = vals.feature AND split = 'live' AND l.v <= vals.v AND isfinite(l.v)) / n_other AS fo,
               lead(v) OVER (PARTITION BY feature ORDER BY v) - v AS gap
        FROM vals JOIN counts USING (feature) WHERE n_base > 0 AND n_other > 0),
  far AS (SELECT feature, max(abs(fb - fo)) AS ks, sum(abs(fb - fo) * coalesce(gap, 0)) AS wasserstein FROM f GROUP BY feature),
  cells AS (SELECT feature, least(9, floor(below * 10 / n_base)) AS cell,
                   greatest(count(*) FILTER (WHERE split = 'train') / max(n_base), 0.0001) AS pb,
                   greatest(count(*) FILTER (WHERE split = 'live') / max(n_other), 0.0001) AS po
            FROM long JOIN f USING (feature, v) JOIN counts USING (feature) GROUP BY ALL),
  stable AS (SELECT feature, sum((po - pb) * ln(po / pb)) AS psi FROM cells GROUP BY feature)
  SELECT counts.*, round(ks, 6) AS ks, round(wasserstein, 6) AS wasserstein, round(psi, 6) AS psi
  FROM counts LEFT JOIN far USING (feature) LEFT JOIN stable USING (feature)""",
    "sensors",
)

# pieces between references and references by turns; a reference is looked up or turned into its character
_REF = r"&(?:#[0-9]{1,7}|#[xX][0-9a-fA-F]{1,6}|[A-Za-z][A-Za-z0-9]{1,7});"
_NAMES = "MAP {" + ", ".join(f"'{n}': chr({c})" for n, c in {**name2codepoint, "apos": 39}.items()) + "}"
_POINT = "CASE WHEN lower(ref[3:3]) = 'x' THEN CAST('0x' || ref[4:-2] AS BIGINT) ELSE CAST(ref[3:-2] AS BIGINT) END"
SQL["html_unescape"] = f"""
WITH dirty AS ({HTML_PAGES}),
  found AS (SELECT page_id, html, regexp_extract_all(html, '{_REF}') AS refs, regexp_split_to_array(html, '{_REF}') AS plain FROM dirty),
  each AS (SELECT page_id, i, plain[i] AS before, CASE WHEN i <= len(refs) THEN refs[i] END AS ref
           FROM (SELECT page_id, plain, refs, unnest(range(1, len(plain) + 1)) AS i FROM found)),
  valued AS (SELECT page_id, i, before, ref, CASE WHEN ref LIKE '&#%' THEN {_POINT} END AS point, {_NAMES} AS names FROM each)
SELECT page_id, string_agg(before || CASE WHEN ref IS NULL THEN ''
         WHEN point IS NULL THEN coalesce(element_at(names, ref[2:-2])[1], ref)
         WHEN point > 0 AND point < 1114112 AND point NOT BETWEEN 55296 AND 57343 THEN chr(CAST(point AS INTEGER)) ELSE ref END, '' ORDER BY i) AS html
FROM valued GROUP BY page_id"""

# ------------------------------------------------------ models (deterministic)

_LIN = "(-1.5 + coalesce(value, 0) * 0.012 + coalesce(k, 0) * -0.021 + coalesce(hour, 0) * 0.047)"
_LIN_SCORED = f"""SELECT event_id, "time", value, k, hour, fault_occurred, {_LIN} AS decision,
       1 / (1 + exp(-{_LIN})) AS probability,
       CAST(1 / (1 + exp(-{_LIN})) >= 0.5 AS INTEGER) AS prediction FROM sensors"""

_RATES = """round(CASE WHEN tn + fp + fn + tp = 0 THEN 0 ELSE (tp + tn) / (tn + fp + fn + tp) END, 6) AS accuracy,
       round(CASE WHEN tp + fp = 0 THEN 0 ELSE tp / (tp + fp) END, 6) AS precision,
       round(CASE WHEN tp + fn = 0 THEN 0 ELSE tp / (tp + fn) END, 6) AS recall,
       round(CASE WHEN 2 * tp + fp + fn = 0 THEN 0 ELSE 2 * tp / (2 * tp + fp + fn) END, 6) AS f1"""
# every distinct score against all rows, by windows over the sorted scores
_CURVE = f"""
  sc AS (SELECT decision AS s, fault_occurred AS y FROM ({_LIN_SCORED}) WHERE decision IS NOT NULL AND fault_occurred IS NOT NULL),
  per AS (SELECT s, count(*) FILTER (WHERE y = 1) AS pos, count(*) FILTER (WHERE y <> 1) AS neg FROM sc GROUP BY s),
  curve AS (SELECT s AS threshold, CAST(coalesce(sum(neg) OVER lower, 0) AS BIGINT) AS tn, CAST(sum(neg) OVER upper AS BIGINT) AS fp,
                   CAST(coalesce(sum(pos) OVER lower, 0) AS BIGINT) AS fn, CAST(sum(pos) OVER upper AS BIGINT) AS tp
            FROM per WINDOW lower AS (ORDER BY s ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING),
                           upper AS (ORDER BY s ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))"""
SQL["score_curve"] = W(f"WITH {_CURVE} SELECT round(threshold, 6) AS threshold, tn, fp, fn, tp FROM curve", "sensors")

SQL["threshold_by_cost"] = W(
    f"""WITH {_CURVE},
    every AS (SELECT * FROM curve UNION ALL
              SELECT NULL, count(*) FILTER (WHERE y <> 1), 0, count(*) FILTER (WHERE y = 1), 0 FROM sc HAVING count(*) > 0),
    priced AS (SELECT every.*, fp_cost, fn_cost, fp * fp_cost + fn * fn_cost AS cost
               FROM every, (VALUES (1.0::DOUBLE, 1.0::DOUBLE), (1.0, 8.0), (1.0, 40.0), (0.0, 1.0)) AS c(fp_cost, fn_cost))
    SELECT fp_cost, fn_cost, round(threshold, 6) AS threshold, tn, fp, fn, tp, round(cost, 6) AS cost, {_RATES}
    FROM priced QUALIFY row_number() OVER (PARTITION BY fp_cost, fn_cost ORDER BY cost, threshold DESC NULLS FIRST) = 1""",
    "sensors",
)

SQL["threshold_by_recall"] = W(
    f"""WITH {_CURVE}
    SELECT target, round(threshold, 6) AS threshold, tn, fp, fn, tp, {_RATES}
    FROM (SELECT * FROM curve, (VALUES (0.25::DOUBLE), (0.5), (0.9), (1.0)) AS c(target) WHERE tp + fn > 0 AND tp >= target * (tp + fn))
    QUALIFY row_number() OVER (PARTITION BY target ORDER BY threshold DESC) = 1""",
    "sensors",
)

SQL["score_linear"] = W(
    f"""SELECT event_id, round(decision, 6) AS decision, round(probability, 6) AS probability, prediction
        FROM ({_LIN_SCORED})""",
    "sensors",
)

_LOAN_NUM = [
    "aon", "daily_decr30", "rental30", "rental90", "last_rech_date_ma", "last_rech_date_da",
    "cnt_loans30", "cnt_loans90", "payback30", "payback90", "cnt_ma_rech30", "cnt_ma_rech90",
    "amnt_loans30", "amnt_loans90", "sumamnt_ma_rech30", "sumamnt_ma_rech90",
    "maxamnt_loans30", "maxamnt_loans90", "minamnt_loans30", "minamnt_loans90",
]
_NUM = "CASE WHEN isnan(TRY_CAST({c} AS DOUBLE)) THEN NULL ELSE TRY_CAST({c} AS DOUBLE) END"
_ENG_COLS = (
    [f"{_NUM.format(c=c)} AS {c}" for c in _LOAN_NUM]
    + [
        "CAST(pcircle AS VARCHAR) AS pcircle",
        f"CAST(year(CAST({_PDATE} AS DATE)) AS DOUBLE) AS pdate_year",
        f"CAST(month(CAST({_PDATE} AS DATE)) AS DOUBLE) AS pdate_month",
        f"CAST(isodow(CAST({_PDATE} AS DATE)) - 1 AS DOUBLE) AS pdate_dayofweek",
        """CAST(dayofyear(try_strptime(printf('2000-%02d-%02d',
              CASE WHEN last_rech_date_ma = floor(last_rech_date_ma) THEN CAST(last_rech_date_ma AS INTEGER) END,
              CASE WHEN last_rech_date_da = floor(last_rech_date_da) THEN CAST(last_rech_date_da AS INTEGER) END),
              '%Y-%m-%d')) AS DOUBLE) AS last_rech_dayofyear""",
    ]
    + [f"CASE WHEN {b} IS NULL OR {b} = 0 THEN NULL ELSE {a} / {b} END AS {n}" for n, a, b in _RATIOS]
)
_ENG_NAMES = _LOAN_NUM + ["pdate_year", "pdate_month", "pdate_dayofweek", "last_rech_dayofyear"] + [n for n, _, _ in _RATIOS]
_ENG = "SELECT loan_id, " + ",\n       ".join(_ENG_COLS) + " FROM loans"

SQL["engineer_features"] = W(
    "SELECT loan_id, pcircle, " + ", ".join(f"round({c}, 6) AS {c}" for c in _ENG_NAMES) + f" FROM ({_ENG})",
    "loans",
)

_LOAN_SEGMENTS = ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"]
SQL["loan_pipeline"] = W(
    f"""WITH eng AS (SELECT e.*, s.label, s.split FROM ({_ENG}) e JOIN (
            SELECT loan_id, label,
                   CASE WHEN rn <= floor(n * 0.6) THEN 'train' WHEN rn <= floor(n * 0.6) + floor(n * 0.2) THEN 'eval'
                        ELSE 'live' END AS split
            FROM (SELECT loan_id, label, row_number() OVER (ORDER BY loan_id) AS rn, count(*) OVER () AS n FROM loans)
          ) s USING (loan_id)),
    med AS (SELECT {", ".join(f"median({c}) FILTER (WHERE split = 'train') AS m_{c}" for c in _ENG_NAMES)} FROM eng),
    filled AS (SELECT eng.loan_id, eng.label, eng.split, eng.pcircle,
                      {", ".join(f"coalesce({c}, m_{c}) AS {c}" for c in _ENG_NAMES)} FROM eng, med),
    sd AS (SELECT {", ".join(f"coalesce(nullif(stddev_pop({c}) FILTER (WHERE split = 'train'), 0), 1) AS s_{c}"
                             for c in _ENG_NAMES)} FROM filled),
    mode AS (SELECT pcircle FROM eng WHERE split = 'train' AND pcircle IS NOT NULL GROUP BY pcircle
             ORDER BY count(*) DESC, pcircle LIMIT 1)
    SELECT loan_id, label, split,
           {", ".join(f"round({c} / s_{c}, 6) AS {c}" for c in _ENG_NAMES)},
           {", ".join(f"CAST(coalesce(filled.pcircle, (SELECT pcircle FROM mode)) = '{v}' AS INTEGER) AS pcircle_{v}"
                      for v in _LOAN_SEGMENTS)}
    FROM filled, sd""",
    "loans",
)

# --------------------------------------------------------------------- sinks

SQL["sink_predictions"] = W(
    f"SELECT event_id, value, k, hour, round(probability, 6) AS probability, prediction FROM ({_LIN_SCORED})",
    "sensors",
)

SQL["sink_predictions_slim"] = W(
    f'SELECT "time", prediction AS predicted_fault, round(probability, 6) AS probability FROM ({_LIN_SCORED})',
    "sensors",
)

SQL["export_filtered"] = W(
    f"""SELECT txn_id, "type", amount, oldbalanceDest, nameOrig, isFlaggedFraud
        FROM ({_TXN_CLEAN.replace('isFlaggedFraud, isFraud', 'isFlaggedFraud, isFraud, nameOrig')}) t
        WHERE {_FLAG.format(c='isFraud')} = 1""",
    "transactions",
)

SQL["sink_metadata"] = """
SELECT 'loans' AS table_name, 'label' AS target, count(*) AS row_count,
       CAST(floor(count(*) * 0.6) AS BIGINT) AS train_rows, CAST(floor(count(*) * 0.2) AS BIGINT) AS eval_rows,
       CAST(floor(count(*) * 0.6) + floor(count(*) * 0.2) AS BIGINT) AS live_offset, CAST(42 AS BIGINT) AS seed
FROM customer
"""

SQL["sink_run_log"] = W(
    f"""WITH {_NB},
    pr AS (SELECT label, CAST(score1 > score0 AS INTEGER) AS prediction FROM sc),
    m AS ({_metrics(_CM.format(src='pr'))})
    SELECT 1 AS run_id, accuracy, tn, fp, fn, tp FROM m
    UNION ALL SELECT 2, accuracy, tn, fp, fn, tp FROM m""",
    "news_clean",
)

SQL["sink_nb_model"] = W(f"WITH {_NB} SELECT token, c0, c1 FROM terms", "news_clean")

SQL["nb_score_saved"] = SQL["nb_score"]

SQL["table_sample"] = "SELECT event_id, ts, value FROM events ORDER BY event_id LIMIT 5"

SQL["rows_to_json"] = W(
    f"SELECT txn_id, \"type\", {_NOINF.format(c='amount')} AS amount, {_NOINF.format(c='oldbalanceDest')} AS oldbalanceDest FROM transactions",
    "transactions",
)

SQL["sink_profile"] = SQL["profile_numeric"]

# ----------------------------------------------------------------- streaming

SQL["stream_score"] = SQL["score_linear"]
SQL["stream_eval"] = SQL["confusion_matrix"]

SQL["scan_csv"] = """
SELECT d.doc_id AS id, CASE WHEN l.quality = 1 THEN 'REAL' ELSE 'FAKE' END AS label,
       split_part(d.text, chr(10), 1) AS title, d.text, d.lang AS topic,
       '/' || d.source || '/' || CAST(d.doc_id AS VARCHAR) AS source_url
FROM documents d JOIN labels l ON d.doc_id = l.doc_id
"""

# ------------------------------------------------------ growing and saved state

SQL["one_hot_sparse"] = W(
    """WITH known AS (SELECT * FROM transactions WHERE txn_id % 13 <> 0),
    t AS (SELECT "type" AS v, row_number() OVER (ORDER BY "type") - 1 AS i FROM (SELECT DISTINCT "type" FROM known WHERE "type" IS NOT NULL)),
    d AS (SELECT "nameDest" AS v, row_number() OVER (ORDER BY "nameDest") - 1 AS i FROM (SELECT DISTINCT "nameDest" FROM known WHERE "nameDest" IS NOT NULL))
    SELECT txn_id, t.i AS type_index, d.i AS "nameDest_index" FROM transactions x LEFT JOIN t ON t.v = x."type" LEFT JOIN d ON d.v = x."nameDest\"""",
    "transactions",
)

SQL["feature_ranking_nb"] = W(
    f"""WITH {_NB},
    imp AS (SELECT token AS feature, round(abs(ln((c1 + 1.0) / (t1 + V)) - ln((c0 + 1.0) / (t0 + V))), 9) AS importance FROM terms, vocab)
    SELECT CAST(row_number() OVER (ORDER BY importance DESC, feature) AS INTEGER) AS rank, feature, round(importance, 6) AS importance,
           round(importance / max(importance) OVER (), 6) AS ratio
    FROM imp ORDER BY importance DESC, feature LIMIT 40""",
    "news_clean",
)

_IN_FORCE = f"""
  held AS (SELECT * FROM news_clean WHERE doc_id % 5 <> 0),
  terms AS (SELECT token, count(*) FILTER (WHERE label = 0) AS c0, count(*) FILTER (WHERE label = 1) AS c1
            FROM (SELECT label, unnest({_TOK.format(c='text')}) AS token FROM held) GROUP BY token)"""
SQL["nb_update"] = W(f"WITH {_IN_FORCE} SELECT token, c0, c1 FROM terms", "news_clean")
SQL["nb_update_classes"] = W(
    f"""WITH {_IN_FORCE},
    v AS (SELECT count(*) AS vocab_size, sum(c0) AS t0, sum(c1) AS t1 FROM terms),
    c AS (SELECT label, count(*) AS n_docs FROM held GROUP BY label)
    SELECT CAST(label AS INTEGER) AS label, n_docs, CAST(CASE label WHEN 0 THEN t0 ELSE t1 END AS BIGINT) AS total_words,
           round((n_docs + 1.0) / (sum(n_docs) OVER () + count(*) OVER ()), 6) AS prior, vocab_size FROM c, v""",
    "news_clean",
)

SQL["dedup_incremental"] = SQL["dedup_text"]

SQL["recommend_shrunk"] = W(
    """WITH r AS (SELECT "condition", "drugName", CAST(rating AS DOUBLE) AS x FROM reviews WHERE rating IS NOT NULL),
    e AS (SELECT "condition", "drugName", count(*) AS n, avg(x) AS m, coalesce(var_pop(x), 0) * count(*) AS ss FROM r GROUP BY ALL),
    g AS (SELECT "condition", avg(x) AS mu FROM r GROUP BY ALL),
    p AS (SELECT e."condition", mu, sum(n) AS total, count(*) AS k, sum(n * n) AS n2,
                 CASE WHEN sum(n) > count(*) THEN sum(ss) / (sum(n) - count(*)) ELSE 0 END AS within,
                 sum(n * (m - mu) * (m - mu)) AS spread
          FROM e JOIN g ON g."condition" IS NOT DISTINCT FROM e."condition" GROUP BY e."condition", mu),
    b AS (SELECT *, CASE WHEN total - n2 / total > 0 THEN greatest(0, spread - (k - 1) * within) / (total - n2 / total) ELSE 0 END AS between_ FROM p),
    s AS (SELECT e."condition", e."drugName", n AS n_reviews, m AS mean_rating, mu AS group_mean,
                 CASE WHEN n * between_ + within > 0 THEN (n * between_ * m + within * mu) / (n * between_ + within) ELSE mu END AS score
          FROM e JOIN b ON b."condition" IS NOT DISTINCT FROM e."condition")
    SELECT "condition", CAST(rank AS INTEGER) AS rank, "drugName", n_reviews, round(mean_rating, 6) AS mean_rating, round(group_mean, 6) AS group_mean,
           round(score, 6) AS score
    FROM (SELECT *, row_number() OVER (PARTITION BY "condition" ORDER BY round(score, 9) DESC, "drugName") AS rank FROM s) WHERE rank <= 3""",
    "reviews",
)

_CELLS = range(10)
SQL["stream_windows"] = f"""
WITH e AS (SELECT event_id, ts, event_type IN ('error', 'click') AS y, floor(value / 5) / 100 AS p, date_trunc('day', ts) AS day,
                  date_diff('day', TIMESTAMP '2024-01-01', date_trunc('day', ts)) AS n FROM events),
  a AS (SELECT *, least(5, greatest(0, n // 5)) AS own FROM e),
  r AS (SELECT * FROM a WHERE NOT (event_id % 13 = 0 AND n - own * 5 = 0 AND own < 4) AND y IS NOT NULL AND p IS NOT NULL),
  w AS (SELECT day AS window_start, count(*) FILTER (NOT y AND p < 0.5) AS tn, count(*) FILTER (NOT y AND p >= 0.5) AS fp,
               count(*) FILTER (y AND p < 0.5) AS fn, count(*) FILTER (y AND p >= 0.5) AS tp,
               {", ".join(f"count(*) FILTER (NOT y AND least(9, greatest(0, floor(p * 10))) = {i}) AS n{i}, count(*) FILTER (y AND least(9, greatest(0, floor(p * 10))) = {i}) AS p{i}" for i in _CELLS)}
        FROM r GROUP BY day)
SELECT window_start, tn, fp, fn, tp, {" || ' ' || ".join(f"n{i}" for i in _CELLS)} AS neg, {" || ' ' || ".join(f"p{i}" for i in _CELLS)} AS pos, {_RATES},
       round(CASE WHEN (tp + fn) * (tn + fp) > 0 THEN ({" + ".join(f"p{i} * ({' + '.join([f'n{j}' for j in range(i)] + [f'n{i} / 2.0'])})" for i in _CELLS)}) / ((tp + fn) * (tn + fp)) END, 6) AS auc
FROM w WHERE window_start + INTERVAL 1 DAY <= (SELECT max(ts) FROM events) - INTERVAL 3 DAY
"""

# one CTE a step: the gradient over a range at the weights of the step before
_ON = ("value", "k", "hour")
_STEPS = [(t, r) for t, r in enumerate([0, 1, 2, 3, 4] * 2)]
_online = "x AS (SELECT event_id % 5 AS r, fault_occurred AS y, " + ", ".join(
    f"({c} - avg({c}) OVER ()) / coalesce(nullif(stddev_pop({c}) OVER (), 0), 1) AS {c}" for c in _ON
) + " FROM sensors),\n  s0 AS (SELECT 0::DOUBLE AS b, " + ", ".join(f"0::DOUBLE AS w_{c}" for c in _ON) + ", 0 AS n0, 0 AS n1)"
for _t, _r in _STEPS:
    _z = " + ".join(["b", *(f"w_{c} * {c}" for c in _ON)])
    _pace = f"(1.0::DOUBLE / (1 + 0.05::DOUBLE * {_t}))"
    _online += f""",
  c{_t} AS (SELECT s{_t}.*, s{_t}.n0 + (SELECT count(*) FILTER (WHERE y = 0) FROM h WHERE r = {_r}) AS m0,
                   s{_t}.n1 + (SELECT count(*) FILTER (WHERE y = 1) FROM h WHERE r = {_r}) AS m1 FROM s{_t}),
  g{_t} AS (SELECT sum(cw) AS cw, sum(off) AS gb, {", ".join(f"sum(off * {c}) AS g_{c}" for c in _ON)}
            FROM (SELECT *, cw * (1 / (1 + exp(-({_z}))) - y) AS off
                  FROM (SELECT h.*, c.*, CASE WHEN m0 = 0 OR m1 = 0 THEN 1 WHEN y = 1 THEN (m0 + m1) / (2.0::DOUBLE * m1) ELSE (m0 + m1) / (2.0::DOUBLE * m0) END AS cw
                        FROM h, c{_t} AS c WHERE r = {_r}))),
  s{_t + 1} AS (SELECT b - {_pace} * gb / cw AS b, {", ".join(f"w_{c} - {_pace} * (g_{c} / cw + 0.0001::DOUBLE * w_{c}) AS w_{c}" for c in _ON)}, m0 AS n0, m1 AS n1 FROM c{_t}, g{_t})"""
_online = _online.replace(",\n  s0 AS", ",\n  h AS (SELECT * FROM x WHERE y IN (0, 1) AND " + " AND ".join(f"{c} IS NOT NULL" for c in _ON) + "),\n  s0 AS", 1)
_last = f"s{len(_STEPS)}"
SQL["logreg_online"] = W(
    f"WITH {_online}\n"
    + " UNION ALL ".join(f"SELECT '{name}' AS term, round({col}, 6) AS weight, CAST({len(_STEPS)} AS BIGINT) AS step FROM {_last}" for name, col in (("intercept", "b"), *((c, f"w_{c}") for c in _ON))),
    "sensors",
)

# draws by the Poisson(1) distribution function at 52 bits of a hash
_POISSON = " ".join(
    f"WHEN u < floor(exp(-1) * ({' + '.join(f'1.0::DOUBLE / {math.factorial(i)}' for i in range(k + 1))}) * 4503599627370496) THEN {k}" for k in range(12)
)
SQL["forest_weights"] = W(
    f"""WITH h AS (SELECT tree, event_id, fault_occurred AS y, CAST('0x' || substr(md5('42:' || tree || ':' || event_id), 1, 13) AS BIGINT) AS u
               FROM sensors, (VALUES (0), (1), (2)) AS t(tree) WHERE fault_occurred IN (0, 1)),
    d AS (SELECT tree, event_id, y, CASE {_POISSON} ELSE 12 END AS draws FROM h),
    n AS (SELECT tree, y, sum(draws) AS drawn FROM d GROUP BY ALL)
    SELECT d.tree, event_id, draws, round(draws * (SELECT sum(drawn) FROM n AS a WHERE a.tree = d.tree) / (2.0::DOUBLE * n.drawn), 6) AS weight
    FROM d JOIN n ON n.tree = d.tree AND n.y = d.y WHERE draws > 0""",
    "sensors",
)

_JZ = "(-0.5::DOUBLE + coalesce(amount, 0) * 1e-5::DOUBLE + coalesce(oldbalanceOrg, 0) * -2e-6::DOUBLE + CASE \"type\" WHEN '1-URGENT' THEN 0.7::DOUBLE WHEN 'TRANSFER' THEN -0.4::DOUBLE ELSE 0 END)"
SQL["score_json"] = W(
    f"""WITH b AS (SELECT txn_id, txn_id % 17 = 0 OR txn_id % 19 = 0 OR (txn_id % 31 <> 0 AND (txn_id % 37 = 0 OR txn_id % 41 = 0)) AS broken,
                      CASE WHEN txn_id % 31 = 0 THEN '2-HIGH' ELSE coalesce("type", 'TRANSFER') END AS "type",
                      CASE WHEN txn_id % 31 <> 0 THEN {_NOINF.format(c='amount')} END AS amount,
                      CASE WHEN txn_id % 31 <> 0 THEN oldbalanceOrg END AS oldbalanceOrg FROM transactions),
    s AS (SELECT txn_id, broken, 1 / (1 + exp(-{_JZ})) AS p FROM b)
    SELECT txn_id, CASE WHEN NOT broken THEN CAST(p >= 0.5 AS INTEGER) END AS prediction, CASE WHEN NOT broken THEN round(p, 6) END AS probability,
           CASE WHEN broken THEN 'not a JSON object' END AS error FROM s""",
    "transactions",
)
