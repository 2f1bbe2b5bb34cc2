"""The fixture adapters of ``stratum.sources.fixtures`` written in DuckDB SQL.

Each constant is the body of a CTE over the driver's pre-registered views.
"""

SENSORS = """
SELECT event_id,
       ts AS "time",
       CASE WHEN event_id % 31 = 0 THEN 'bad time' ELSE strftime(ts, '%Y-%m-%d %H:%M:%S') END AS time_text,
       CAST(user_id % 3 AS INTEGER) AS stage,
       user_id AS runnum,
       CASE WHEN event_id % 17 = 0 THEN NULL ELSE value END AS value,
       TRY_CAST(json_extract_string(props, '$.k') AS DOUBLE) AS k,
       CAST(hour(ts) AS DOUBLE) AS hour,
       CAST(1.0 AS DOUBLE) AS const_one,
       CAST(floor(value / 10) AS DOUBLE) AS "TTF leak",
       CAST(event_type = 'error' AND value > 100 AS INTEGER) AS fault_occurred
FROM events
"""

TRANSACTIONS = """
SELECT o_orderkey AS txn_id,
       CAST(o_orderkey % 744 AS INTEGER) AS step,
       o_orderpriority AS "type",
       CASE WHEN o_orderkey % 23 = 0 THEN NULL
            WHEN o_orderkey % 101 = 0 THEN CAST('inf' AS DOUBLE)
            ELSE o_totalprice END AS amount,
       o_totalprice * 2 AS oldbalanceOrg,
       o_totalprice AS newbalanceOrig,
       CASE WHEN o_orderkey % 211 = 0 THEN CAST('-inf' AS DOUBLE)
            ELSE CAST(o_custkey * 10 AS DOUBLE) END AS oldbalanceDest,
       CAST(o_custkey * 10 AS DOUBLE) + o_totalprice AS newbalanceDest,
       'C' || CAST(o_custkey AS VARCHAR) AS nameOrig,
       'M' || CAST(o_orderkey AS VARCHAR) AS nameDest,
       CAST(o_orderstatus = 'P' AND o_totalprice > 400000 AS INTEGER) AS isFraud,
       CASE WHEN o_orderkey % 29 = 0 THEN NULL
            WHEN o_totalprice > 450000 THEN CASE WHEN o_orderkey % 2 = 0 THEN '1.0' ELSE '1' END
            ELSE '0' END AS isFlaggedFraud
FROM orders
"""

LOANS = """
SELECT c.c_custkey AS loan_id,
       'N' || CAST(c.c_custkey AS VARCHAR) AS msisdn,
       CAST(c.c_acctbal > 0 AS INTEGER) AS label,
       CAST(date_diff('day', CAST(a.first_order AS DATE), DATE '2001-08-01') AS DOUBLE) AS aon,
       round(coalesce(a.amnt_loans30, 0.0) / 30, 6) AS daily_decr30,
       CASE c.c_custkey % 7 WHEN 1 THEN 'abc' WHEN 2 THEN ' 12 ' WHEN 3 THEN '' WHEN 4 THEN 'NaN'
            ELSE CAST(c.c_acctbal AS VARCHAR) END AS rental30,
       c.c_acctbal AS rental90,
       CASE WHEN c.c_custkey % 13 = 0 THEN 2.0 ELSE CAST(month(a.last_order) AS DOUBLE) END AS last_rech_date_ma,
       CASE WHEN c.c_custkey % 13 = 0 THEN CAST(30 + c.c_custkey % 2 AS DOUBLE)
            ELSE CAST(day(a.last_order) AS DOUBLE) END AS last_rech_date_da,
       coalesce(a.cnt_loans30, 0.0) AS cnt_loans30,
       coalesce(a.cnt_loans90, 0.0) AS cnt_loans90,
       coalesce(a.payback30, 0.0) AS payback30,
       coalesce(a.payback90, 0.0) AS payback90,
       coalesce(a.cnt_ma_rech30, 0.0) AS cnt_ma_rech30,
       coalesce(a.cnt_ma_rech90, 0.0) AS cnt_ma_rech90,
       coalesce(a.amnt_loans30, 0.0) AS amnt_loans30,
       coalesce(a.amnt_loans90, 0.0) AS amnt_loans90,
       coalesce(a.sumamnt_ma_rech30, 0.0) AS sumamnt_ma_rech30,
       coalesce(a.sumamnt_ma_rech90, 0.0) AS sumamnt_ma_rech90,
       a.maxamnt_loans30, a.maxamnt_loans90, a.minamnt_loans30, a.minamnt_loans90,
       c.c_mktsegment AS pcircle,
       CASE WHEN c.c_custkey % 2 = 0 THEN strftime(a.last_order, '%d-%m-%Y')
            ELSE strftime(a.last_order, '%m/%d/%Y') END AS pdate
FROM customer c
LEFT JOIN (
  SELECT o_custkey,
         CAST(count(*) FILTER (WHERE days_ago < 30) AS DOUBLE) AS cnt_loans30,
         sum(o_totalprice) FILTER (WHERE days_ago < 30) AS amnt_loans30,
         max(o_totalprice) FILTER (WHERE days_ago < 30) AS maxamnt_loans30,
         min(o_totalprice) FILTER (WHERE days_ago < 30) AS minamnt_loans30,
         CAST(count(*) FILTER (WHERE days_ago < 30 AND o_orderstatus = 'F') AS DOUBLE) AS payback30,
         CAST(count(*) FILTER (WHERE days_ago < 90) AS DOUBLE) AS cnt_loans90,
         sum(o_totalprice) FILTER (WHERE days_ago < 90) AS amnt_loans90,
         max(o_totalprice) FILTER (WHERE days_ago < 90) AS maxamnt_loans90,
         min(o_totalprice) FILTER (WHERE days_ago < 90) AS minamnt_loans90,
         CAST(count(*) FILTER (WHERE days_ago < 90 AND o_orderstatus = 'F') AS DOUBLE) AS payback90,
         CAST(count(*) FILTER (WHERE days_ago < 365) AS DOUBLE) AS cnt_ma_rech30,
         sum(o_totalprice) FILTER (WHERE days_ago < 365) AS sumamnt_ma_rech30,
         CAST(count(*) FILTER (WHERE days_ago < 730) AS DOUBLE) AS cnt_ma_rech90,
         sum(o_totalprice) FILTER (WHERE days_ago < 730) AS sumamnt_ma_rech90,
         min(o_orderdate) AS first_order,
         max(o_orderdate) AS last_order
  FROM (SELECT *, date_diff('day', CAST(o_orderdate AS DATE), DATE '2001-08-01') AS days_ago FROM orders) o
  GROUP BY o_custkey
) a ON c.c_custkey = a.o_custkey
"""

NEWS_RAW = """
SELECT d.doc_id AS "Unnamed: 0",
       d.doc_id,
       CASE WHEN d.doc_id % 19 = 0 THEN NULL ELSE d.text END AS "Text",
       CASE WHEN d.doc_id % 8 IN (0, 1) THEN CASE WHEN l.quality = 1 THEN 'True' ELSE 'false' END
            WHEN d.doc_id % 8 = 2 THEN CASE WHEN l.quality = 1 THEN ' TRUE ' ELSE chr(9) || 'False' || chr(10) END
            WHEN d.doc_id % 8 IN (3, 4) THEN CAST(l.quality AS VARCHAR)
            WHEN d.doc_id % 8 = 5 THEN CAST(l.quality AS VARCHAR) || '.0'
            WHEN d.doc_id % 8 = 6 THEN 'maybe'
       END AS "Label"
FROM documents d JOIN labels l ON d.doc_id = l.doc_id
"""

REVIEWS = """
SELECT doc_id AS "uniqueID", source AS "drugName", lang AS "condition", text AS review,
       CAST(1 + doc_id % 10 AS INTEGER) AS rating,
       CAST(n_chars % 50 AS INTEGER) AS "usefulCount"
FROM documents
"""

SCORED = """
SELECT event_id,
       CAST(event_type IN ('error', 'click') AS INTEGER) AS label,
       floor(value / 5) / 100 AS probability,
       CAST(floor(value / 5) / 100 >= 0.5 AS INTEGER) AS prediction
FROM events
"""

# The cleaned news table (lower_columns, label_normalize, drop_nulls, filter_in_set).
NEWS_CLEAN = """
SELECT doc_id, "Text" AS text,
       CASE WHEN lower(regexp_replace("Label", '^\\s+|\\s+$', '', 'g')) IN ('true', '1') THEN 1
            WHEN lower(regexp_replace("Label", '^\\s+|\\s+$', '', 'g')) IN ('false', '0') THEN 0 END AS label
FROM news_raw
WHERE "Text" IS NOT NULL
  AND lower(regexp_replace("Label", '^\\s+|\\s+$', '', 'g')) IN ('true', '1', 'false', '0')
"""

ALL = {
    "sensors": SENSORS,
    "transactions": TRANSACTIONS,
    "loans": LOANS,
    "news_raw": NEWS_RAW,
    "news_clean": NEWS_CLEAN,
    "reviews": REVIEWS,
    "scored": SCORED,
}


# pages with references that decode to parts of other references, and with broken ones
HTML_PAGES = """SELECT page_id, CASE page_id % 5
  WHEN 0 THEN html || ' &#38;lt; &#38;#39; &#39; &amp;amp; &amp;#60;'
  WHEN 1 THEN '&eacute;&Eacute;&nosuch;&amp &#0; &#xD800; &#x110000; &#1114111; &#X41;' || html
  WHEN 2 THEN html || '&#x1F600;&hearts;&euro;&;&#;&#x;' ELSE html END AS html FROM pages"""


def with_fixtures(sql: str, *names: str) -> str:
    """Prefix ``sql`` with the CTEs it names (dependencies first)."""
    order = ["sensors", "transactions", "loans", "news_raw", "news_clean", "reviews", "scored"]
    need = set(names)
    if "news_clean" in need:
        need.add("news_raw")
    ctes = [f"{n} AS ({ALL[n]})" for n in order if n in need]
    if not ctes:
        return sql
    body = sql.lstrip()
    if body[:5].upper() == "WITH ":
        return "WITH " + ",\n".join(ctes) + ",\n" + body[5:]
    return "WITH " + ",\n".join(ctes) + "\n" + body
