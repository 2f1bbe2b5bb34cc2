"""Adapters that give the driver's tables the shape of the reference's inputs.

Each adapter is a pure projection (plus one customer-level aggregate for loans)
over a driver table, so its cost grows with the table.  Dirt (nulls, NaN text,
infinities, bad dates, messy labels) is injected deterministically by key
modulus so that every cleaning operator has something to do.  The same
definitions are written in DuckDB SQL in ``stratum_sql/fixtures_sql.py``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stratum.sources.tables import load_table

INF = float("inf")

# Fixed cutoff of the loan adapter (last order date of the driver's data).
LOAN_CUTOFF = "2001-08-01"


def _mod(c: str, m: int) -> Column:
    return F.col(c) % F.lit(m)


def sensors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sensor readings (fault detection input) from ``events``.

    key ``event_id``; admin columns ``time``, ``stage``, ``runnum``; sensors
    ``value`` (null where key % 17 = 0), ``k`` (from the JSON props), ``hour``,
    the constant ``const_one`` and ``TTF leak`` (a name with a space);
    ``time_text`` is the time as text with unparseable entries; label
    ``fault_occurred``.
    """
    return sensors_from(load_table(spark, sf_dir, "events"))


def sensors_from(ev: DataFrame) -> DataFrame:
    """The sensor adapter over any ``events``-shaped frame (batch or streaming)."""
    return ev.select(
        F.col("event_id"),
        F.col("ts").alias("time"),
        F.when(_mod("event_id", 31) == 0, F.lit("bad time"))
        .otherwise(F.date_format("ts", "yyyy-MM-dd HH:mm:ss"))
        .alias("time_text"),
        (F.col("user_id") % 3).cast("int").alias("stage"),
        F.col("user_id").alias("runnum"),
        F.when(_mod("event_id", 17) == 0, F.lit(None).cast("double")).otherwise(F.col("value")).alias("value"),
        F.get_json_object("props", "$.k").try_cast("double").alias("k"),
        F.hour("ts").cast("double").alias("hour"),
        F.lit(1.0).alias("const_one"),
        F.floor(F.col("value") / 10).cast("double").alias("TTF leak"),
        ((F.col("event_type") == "error") & (F.col("value") > 100)).cast("int").alias("fault_occurred"),
    )


SENSOR_FEATURES = ["value", "k", "hour", "const_one", "TTF leak"]


def transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Transactions (fraud input) from ``orders``.

    ``amount`` is null where key % 23 = 0 and +inf where key % 101 = 0;
    ``oldbalanceDest`` is -inf where key % 211 = 0; ``isFlaggedFraud`` is text
    ('1', '1.0', '0' or null) so the status filter has to coerce it.
    """
    o = load_table(spark, sf_dir, "orders")
    key = "o_orderkey"
    return o.select(
        F.col(key).alias("txn_id"),
        (F.col(key) % 744).cast("int").alias("step"),
        F.col("o_orderpriority").alias("type"),
        F.when(_mod(key, 23) == 0, F.lit(None).cast("double"))
        .when(_mod(key, 101) == 0, F.lit(INF))
        .otherwise(F.col("o_totalprice"))
        .alias("amount"),
        (F.col("o_totalprice") * 2).alias("oldbalanceOrg"),
        F.col("o_totalprice").alias("newbalanceOrig"),
        F.when(_mod(key, 211) == 0, F.lit(-INF))
        .otherwise((F.col("o_custkey") * 10).cast("double"))
        .alias("oldbalanceDest"),
        ((F.col("o_custkey") * 10).cast("double") + F.col("o_totalprice")).alias("newbalanceDest"),
        F.concat(F.lit("C"), F.col("o_custkey").cast("string")).alias("nameOrig"),
        F.concat(F.lit("M"), F.col(key).cast("string")).alias("nameDest"),
        ((F.col("o_orderstatus") == "P") & (F.col("o_totalprice") > 400000)).cast("int").alias("isFraud"),
        F.when(_mod(key, 29) == 0, F.lit(None).cast("string"))
        .when(F.col("o_totalprice") > 450000, F.when(_mod(key, 2) == 0, F.lit("1.0")).otherwise(F.lit("1")))
        .otherwise(F.lit("0"))
        .alias("isFlaggedFraud"),
    )


TXN_NUMERIC = ["amount", "oldbalanceOrg", "newbalanceOrig", "oldbalanceDest", "newbalanceDest"]


def loans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Telecom micro-loans from ``customer`` and the customer's ``orders``.

    Trailing-window counts, sums, max and min of order prices (all algebraic,
    so a customer holding a third of the orders still aggregates map-side) before a fixed
    cutoff; ``rental30`` is dirty text; month/day of the last order are invalid
    where key % 13 = 0; ``pdate`` is written ``dd-MM-yyyy`` (even key) or
    ``MM/dd/yyyy`` (odd key).  One aggregate per customer (partial aggregation
    before the shuffle), then a join on the customer key.
    """
    o = load_table(spark, sf_dir, "orders")
    c = load_table(spark, sf_dir, "customer")
    days = F.datediff(F.lit(LOAN_CUTOFF).cast("date"), F.col("o_orderdate").cast("date"))
    price = F.col("o_totalprice")

    def within(n: int, v: Column) -> Column:
        return F.when(days < n, v)

    per_cust = (
        o.select("o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", days.alias("days_ago"))
        .groupBy("o_custkey")
        .agg(
            *[
                agg
                for n in (30, 90)
                for agg in (
                    F.count(within(n, F.lit(1))).cast("double").alias(f"cnt_loans{n}"),
                    F.coalesce(F.sum(within(n, price)), F.lit(0.0)).alias(f"amnt_loans{n}"),
                    F.max(within(n, price)).alias(f"maxamnt_loans{n}"),
                    F.min(within(n, price)).alias(f"minamnt_loans{n}"),
                    F.count(within(n, F.when(F.col("o_orderstatus") == "F", F.lit(1)))).cast("double").alias(f"payback{n}"),
                )
            ],
            F.count(within(365, F.lit(1))).cast("double").alias("cnt_ma_rech30"),
            F.coalesce(F.sum(within(365, price)), F.lit(0.0)).alias("sumamnt_ma_rech30"),
            F.count(within(730, F.lit(1))).cast("double").alias("cnt_ma_rech90"),
            F.coalesce(F.sum(within(730, price)), F.lit(0.0)).alias("sumamnt_ma_rech90"),
            F.min("o_orderdate").alias("first_order"),
            F.max("o_orderdate").alias("last_order"),
        )
    )
    j = c.join(per_cust, c.c_custkey == per_cust.o_custkey, "left")
    key = "c_custkey"
    zero = F.lit(0.0)
    cnt_cols = ["cnt_loans30", "cnt_loans90", "payback30", "payback90", "cnt_ma_rech30", "cnt_ma_rech90"]
    sum_cols = ["amnt_loans30", "amnt_loans90", "sumamnt_ma_rech30", "sumamnt_ma_rech90"]
    return j.select(
        F.col(key).alias("loan_id"),
        F.concat(F.lit("N"), F.col(key).cast("string")).alias("msisdn"),
        (F.col("c_acctbal") > 0).cast("int").alias("label"),
        F.datediff(F.lit(LOAN_CUTOFF).cast("date"), F.col("first_order").cast("date")).cast("double").alias("aon"),
        F.round(F.coalesce(F.col("amnt_loans30"), zero) / 30, 6).alias("daily_decr30"),
        F.when(_mod(key, 7) == 1, F.lit("abc"))
        .when(_mod(key, 7) == 2, F.lit(" 12 "))
        .when(_mod(key, 7) == 3, F.lit(""))
        .when(_mod(key, 7) == 4, F.lit("NaN"))
        .otherwise(F.col("c_acctbal").cast("string"))
        .alias("rental30"),
        F.col("c_acctbal").alias("rental90"),
        F.when(_mod(key, 13) == 0, F.lit(2.0)).otherwise(F.month("last_order").cast("double")).alias("last_rech_date_ma"),
        F.when(_mod(key, 13) == 0, (F.lit(30) + _mod(key, 2)).cast("double"))
        .otherwise(F.dayofmonth("last_order").cast("double"))
        .alias("last_rech_date_da"),
        *[F.coalesce(F.col(x), zero).alias(x) for x in cnt_cols],
        *[F.coalesce(F.col(x), zero).alias(x) for x in sum_cols],
        F.col("maxamnt_loans30"),
        F.col("maxamnt_loans90"),
        F.col("minamnt_loans30"),
        F.col("minamnt_loans90"),
        F.col("c_mktsegment").alias("pcircle"),
        F.when(_mod(key, 2) == 0, F.date_format("last_order", "dd-MM-yyyy"))
        .otherwise(F.date_format("last_order", "MM/dd/yyyy"))
        .alias("pdate"),
    )


def news_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """News articles from ``documents`` joined to ``labels``.

    Columns as the reference's table has them (mixed case, an index column):
    ``Unnamed: 0``, ``doc_id``, ``Text`` (null where doc_id % 19 = 0) and
    ``Label`` written as 'True', 'false', ' TRUE ', '\\tFalse\\n', '1', '0',
    '1.0', '0.0', 'maybe' or null by doc_id % 8.
    """
    d = load_table(spark, sf_dir, "documents").select("doc_id", "text")
    lab = load_table(spark, sf_dir, "labels").select("doc_id", "quality")
    j = d.join(lab, "doc_id")
    m = F.col("doc_id") % 8
    q1 = F.col("quality") == 1
    qs = F.col("quality").cast("string")
    label = (
        F.when(m.isin(0, 1), F.when(q1, F.lit("True")).otherwise(F.lit("false")))
        .when(m == 2, F.when(q1, F.lit(" TRUE ")).otherwise(F.lit("\tFalse\n")))
        .when(m.isin(3, 4), qs)
        .when(m == 5, F.concat(qs, F.lit(".0")))
        .when(m == 6, F.lit("maybe"))
    )
    return j.select(
        F.col("doc_id").alias("Unnamed: 0"),
        F.col("doc_id"),
        F.when(F.col("doc_id") % 19 == 0, F.lit(None).cast("string")).otherwise(F.col("text")).alias("Text"),
        label.alias("Label"),
    )


def reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Medicine reviews from ``documents``: rating 1 + doc_id % 10, drug = source, condition = lang."""
    d = load_table(spark, sf_dir, "documents")
    return d.select(
        F.col("doc_id").alias("uniqueID"),
        F.col("source").alias("drugName"),
        F.col("lang").alias("condition"),
        F.col("text").alias("review"),
        (F.lit(1) + F.col("doc_id") % 10).cast("int").alias("rating"),
        (F.col("n_chars") % 50).cast("int").alias("usefulCount"),
    )


def scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scored rows for the metric operators, from ``events``.

    ``probability = floor(value / 5) / 100`` has many ties (tie-aware AUC).
    """
    return scored_from(load_table(spark, sf_dir, "events"))


def scored_from(ev: DataFrame) -> DataFrame:
    """The scored-rows adapter over any ``events``-shaped frame (batch or streaming)."""
    p = F.floor(F.col("value") / 5) / 100
    return ev.select(
        F.col("event_id"),
        F.col("event_type").isin("error", "click").cast("int").alias("label"),
        p.alias("probability"),
        (p >= 0.5).cast("int").alias("prediction"),
    )


def html_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``pages`` with references that decode to parts of other references, and with broken ones."""
    html, turn = F.col("html"), F.col("page_id") % 5
    dirty = F.when(turn == 0, F.concat(html, F.lit(" &#38;lt; &#38;#39; &#39; &amp;amp; &amp;#60;")))
    dirty = dirty.when(turn == 1, F.concat(F.lit("&eacute;&Eacute;&nosuch;&amp &#0; &#xD800; &#x110000; &#1114111; &#X41;"), html))
    dirty = dirty.when(turn == 2, F.concat(html, F.lit("&#x1F600;&hearts;&euro;&;&#;&#x;"))).otherwise(html)
    return load_table(spark, sf_dir, "pages").select("page_id", dirty.alias("html"))


# Fixed shape of the arriving events: so many arrivals of so many days, from this date on.
ARRIVALS, ARRIVAL_DAYS, ARRIVAL_START = 6, 5, "2024-01-01"


def arriving_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scored events with the ``arrival`` that brings them.

    Every eleventh of an arrival's last two days comes with the next one, every seventh of its last day
    comes twice, and every thirteenth of its first day comes two arrivals later, when its window is closed.
    """
    ev = load_table(spark, sf_dir, "events")
    micros = F.unix_micros(F.col("ts").cast("timestamp")) - F.unix_micros(F.lit(ARRIVAL_START).cast("timestamp"))
    day = F.floor(micros / F.lit(86_400_000_000))
    own = F.least(F.lit(ARRIVALS - 1), F.greatest(F.lit(0), F.floor(day / ARRIVAL_DAYS))).cast("int")
    at = day - own * ARRIVAL_DAYS
    late = (F.col("event_id") % 11 == 0) & (at >= ARRIVAL_DAYS - 2) & (own < ARRIVALS - 1)
    lost = (F.col("event_id") % 13 == 0) & (at == 0) & (own < ARRIVALS - 2)
    twice = (F.col("event_id") % 7 == 0) & (at >= ARRIVAL_DAYS - 1) & (own < ARRIVALS - 1)
    first = own + F.when(lost, 2).when(late, 1).otherwise(0)
    comes = F.when(twice, F.array(first, own + 1)).otherwise(F.array(first))
    p = F.floor(F.col("value") / 5) / 100
    return ev.select(F.col("ts").cast("timestamp").alias("ts"), "event_id", F.col("event_type").isin("error", "click").cast("int").alias("label"), p.alias("probability"), F.explode(comes).alias("arrival"))


def json_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``txn_id, body``: transactions as JSON records, some of them lists, truncated, or with a field missing or of another type."""
    t = transactions(spark, sf_dir)
    finite = lambda c: F.when(F.abs(c) == INF, None).otherwise(F.col(c)).alias(c)
    whole = F.to_json(F.struct("type", finite("amount"), "oldbalanceOrg"))
    key = F.col("txn_id")
    body = F.when(key % 17 == 0, F.concat(F.lit("["), whole, F.lit("]"))).when(key % 19 == 0, F.substring(whole, 1, 12))
    body = body.when(key % 31 == 0, F.lit('{"type": "2-HIGH", "newbalanceOrig": 1.5}')).when(key % 37 == 0, F.lit("")).when(key % 41 == 0, F.lit(None)).otherwise(whole)
    return t.select("txn_id", body.alias("body"))
