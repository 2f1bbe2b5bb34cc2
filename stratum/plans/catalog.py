"""Named queries over the driver's tables: one per operator of the inventory.

Each entry is ``f(spark, sf_dir) -> DataFrame`` and reads whole tables (through
the fixture adapters).  Deterministic entries have a DuckDB twin in
``stratum_sql/queries_sql.py``; trained-model entries are checked by row count and
by their own tests.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stratum.functions import clean as C
from stratum.functions import dates as D
from stratum.functions import text as X
from stratum.operators import bootstrap as B
from stratum.operators import evaluate as E
from stratum.operators import fitstate as S
from stratum.operators import models as M
from stratum.operators import nb_state as NS
from stratum.operators import online_logistic as OL
from stratum.operators import split as P
from stratum.operators import text_models as TM
from stratum.plans import loan as loan_plan
from stratum.session import scratch_path
from stratum.sources import fixtures as fx
from stratum.sources import rank_index
from stratum.sources import sinks as K
from stratum.sources.digest_index import DigestIndex
from stratum.sources.tables import load_table, table_profile, table_sample
from stratum.streaming import score as ST

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def register(name: str):
    def deco(fn: Query) -> Query:
        QUERIES[name] = fn
        return fn

    return deco


R6 = 6  # results compared across engines are rounded to 6 places


def r6(c):
    return F.round(c, R6)


# ----------------------------------------------------------------- 2.1 sources


@register("scan_full")
def q_scan_full(spark, sf):
    df = load_table(spark, sf, "documents")
    want = ["doc_id", "text", "lang", "not_there"]
    return df.select(*[c for c in want if c in df.columns])


@register("scan_range")
def q_scan_range(spark, sf):
    return P.scan_range(load_table(spark, sf, "events"), "event_id", 2000, 5000).select("event_id", "ts", "value")


@register("scan_project")
def q_scan_project(spark, sf):
    return fx.sensors(spark, sf).select("event_id", "value", "k")


@register("scan_tail")
def q_scan_tail(spark, sf):
    return P.scan_tail(load_table(spark, sf, "events"), "event_id", 7000).select("event_id", "value")


@register("scan_prefix")
def q_scan_prefix(spark, sf):
    return P.scan_prefix(load_table(spark, sf, "orders"), "o_orderkey", 2500).select("o_orderkey", "o_totalprice")


@register("table_profile")
def q_table_profile(spark, sf):
    p = table_profile(spark, sf)
    return p.withColumn("columns", F.replace("columns", F.lit("timestamp_ntz"), F.lit("timestamp")))


@register("table_sample")
def q_table_sample(spark, sf):
    return table_sample(load_table(spark, sf, "events"), "event_id", 5).select("event_id", "ts", "value")


# ------------------------------------------------------ 2.3 cleaning and scalar


@register("lower_columns")
def q_lower_columns(spark, sf):
    return C.lower_columns(fx.news_raw(spark, sf))


@register("label_normalize")
def q_label_normalize(spark, sf):
    raw = fx.news_raw(spark, sf)
    return raw.select("doc_id", C.label_normalize(F.col("Label")).alias("label"))


@register("label_from_rating")
def q_label_from_rating(spark, sf):
    r = fx.reviews(spark, sf).select("uniqueID", "rating", C.label_from_rating(F.col("rating")).alias("sentiment"))
    return r.where(F.col("sentiment") != -1)


@register("label_binarize")
def q_label_binarize(spark, sf):
    t = fx.transactions(spark, sf)
    return t.select("txn_id", C.label_binarize(F.col("isFlaggedFraud")).alias("flagged"))


@register("to_numeric")
def q_to_numeric(spark, sf):
    return fx.loans(spark, sf).select("loan_id", C.to_numeric(F.col("rental30")).alias("rental30"))


LOAN_ALIGN = T.StructType(
    [
        T.StructField("label", T.IntegerType()),
        T.StructField("aon", T.DoubleType()),
        T.StructField("rental30", T.StringType()),
        T.StructField("fr_ma_rech30", T.DoubleType()),
        T.StructField("pcircle", T.StringType()),
    ]
)


@register("align_schema")
def q_align_schema(spark, sf):
    return C.align_schema(fx.loans(spark, sf), LOAN_ALIGN)


@register("drop_identifiers")
def q_drop_identifiers(spark, sf):
    return C.drop_identifiers(fx.transactions(spark, sf), target="isFraud")


@register("select_numeric")
def q_select_numeric(spark, sf):
    s = fx.sensors(spark, sf)
    cols = C.candidate_features(s, "fault_occurred", admin=(*C.ADMIN_COLUMNS, "event_id"))
    return s.select(*[C.q(c) for c in cols], "fault_occurred")


@register("candidate_features")
def q_candidate_features(spark, sf):
    s = fx.sensors(spark, sf)
    cols = C.candidate_features(s, "fault_occurred", numeric_only=True, include_admin=True)
    return s.select(*[C.q(c) for c in cols])


@register("prune_constant")
def q_prune_constant(spark, sf):
    return S.prune_constant(fx.sensors(spark, sf), fx.SENSOR_FEATURES)


@register("time_to_epoch")
def q_time_to_epoch(spark, sf):
    s = fx.sensors(spark, sf)
    return s.select(
        "event_id",
        D.time_to_epoch(F.col("time")).alias("epoch"),
        D.time_to_epoch(F.col("time_text"), is_text=True).alias("epoch_text"),
    )


@register("parse_date_multi")
def q_parse_date_multi(spark, sf):
    return fx.loans(spark, sf).select("loan_id", "pdate", D.parse_date_multi(F.col("pdate")).alias("pdate_parsed"))


@register("calendar_parts")
def q_calendar_parts(spark, sf):
    ln = fx.loans(spark, sf)
    return ln.select("loan_id", *D.calendar_parts(D.parse_date_multi(F.col("pdate")), "pdate"))


@register("day_of_year")
def q_day_of_year(spark, sf):
    ln = fx.loans(spark, sf)
    return ln.select(
        "loan_id", D.day_of_year(F.col("last_rech_date_ma"), F.col("last_rech_date_da")).alias("last_rech_dayofyear")
    )


LOAN_RATIOS = loan_plan.RATIOS


@register("safe_ratio")
def q_safe_ratio(spark, sf):
    ln = fx.loans(spark, sf)
    return ln.select("loan_id", *[r6(C.safe_ratio(F.col(a), F.col(b))).alias(n) for n, a, b in LOAN_RATIOS])


@register("cast_category")
def q_cast_category(spark, sf):
    s = fx.sensors(spark, sf)
    return s.select("event_id", F.col("stage").cast("string").alias("stage"))


@register("inf_to_null")
def q_inf_to_null(spark, sf):
    t = C.replace_inf(fx.transactions(spark, sf))
    return t.select("txn_id", "amount", "oldbalanceDest")


@register("fill_defaults")
def q_fill_defaults(spark, sf):
    t = fx.transactions(spark, sf).select("txn_id", "type", "amount")
    return C.fill_defaults(t, {"type": "TRANSFER", "amount": 0.0, "step": 0.0})


@register("decode_label")
def q_decode_label(spark, sf):
    s = fx.scored(spark, sf)
    return s.select(
        "event_id",
        C.decode_label(F.col("label"), C.CLASS_NAMES["fraud"]).alias("label_name"),
        C.decode_label(F.col("prediction"), C.CLASS_NAMES["fraud"]).alias("prediction_name"),
    )


@register("class_confidence")
def q_class_confidence(spark, sf):
    s = fx.scored(spark, sf)
    return s.select("event_id", r6(C.class_confidence(F.col("prediction"), F.col("probability"))).alias("confidence"))


@register("rows_to_json")
def q_rows_to_json(spark, sf):
    rows = fx.transactions(spark, sf).select("txn_id", "type", "amount", "oldbalanceDest")
    back = F.from_json("json", rows.schema)  # read back, so that both engines' number texts may differ
    return C.rows_to_json(rows).select(back.alias("r")).select("r.*")


def _props_with_junk(spark, sf):
    ev = load_table(spark, sf, "events")
    junk = F.when(F.col("event_id") % 50 == 0, F.concat(F.lit("["), F.col("props"), F.lit("]"))).otherwise(F.col("props"))
    return ev.select("event_id", junk.alias("props"))


@register("parse_json_rows")
def q_parse_json_rows(spark, sf):
    schema = T.StructType([T.StructField("k", T.LongType())])
    return C.parse_json_rows(_props_with_junk(spark, sf), "props", schema, keep=["event_id"])


@register("round_probability")
def q_round_probability(spark, sf):
    ev = load_table(spark, sf, "events")
    return ev.select("event_id", C.round_probability(F.col("value") / 7).alias("p6"))


# ------------------------------------------------------------------ 2.4 filters


@register("drop_nulls")
def q_drop_nulls(spark, sf):
    n = C.lower_columns(fx.news_raw(spark, sf))
    return C.drop_nulls(n, ["text", "label"]).select("doc_id")


@register("filter_in_set")
def q_filter_in_set(spark, sf):
    from stratum.plans.news import clean_news

    return clean_news(fx.news_raw(spark, sf))


TXN_FEATURES = ["step", "type", *fx.TXN_NUMERIC, "isFlaggedFraud"]


@register("complete_case")
def q_complete_case(spark, sf):
    t = C.replace_inf(fx.transactions(spark, sf))
    return C.complete_case(t, exclude=["isFraud", "nameOrig", "nameDest"]).select("txn_id", *TXN_FEATURES, "isFraud")


@register("filter_status")
def q_filter_status(spark, sf):
    t = C.replace_inf(fx.transactions(spark, sf))
    return C.filter_status(t, "flagged").select("txn_id", "amount", "isFlaggedFraud")


@register("filter_prediction")
def q_filter_prediction(spark, sf):
    return fx.scored(spark, sf).where(F.col("prediction") == 1).select("event_id", "probability")


@register("filter_blank_text")
def q_filter_blank_text(spark, sf):
    n = C.lower_columns(fx.news_raw(spark, sf)).select("doc_id", "text")
    good, bad = C.filter_blank_text(n, "text")
    return good.select("doc_id", F.lit(None).cast("string").alias("error")).unionByName(bad.select("doc_id", "error"))


@register("threshold")
def q_threshold(spark, sf):
    return fx.scored(spark, sf).select("event_id", C.threshold(F.col("probability"), 0.3).alias("prediction"))


# ------------------------------------------------------------- 2.6 aggregates


@register("status_summary")
def q_status_summary(spark, sf):
    out = E.status_summary(fx.transactions(spark, sf))
    return out.select("total", "non_fraud", "fraud", r6(F.col("fraud_rate")).alias("fraud_rate"), "flagged",
                      r6(F.col("flagged_rate")).alias("flagged_rate"))


@register("profile_numeric")
def q_profile_numeric(spark, sf):
    p = S.profile_numeric(fx.sensors(spark, sf), fx.SENSOR_FEATURES)
    return p.select("feature", r6(F.col("min")).alias("min"), r6(F.col("max")).alias("max"),
                    r6(F.col("median")).alias("median"))


LOAN_NUMERIC = [
    "aon", "daily_decr30", "rental30", "rental90", "cnt_loans30", "amnt_loans30", "maxamnt_loans30",
    "minamnt_loans90", "payback30", "sumamnt_ma_rech90",
]


def _loans_numeric(spark, sf):
    ln = fx.loans(spark, sf)
    return C.coerce_numeric(ln, ["rental30"])


@register("median_fit")
def q_median_fit(spark, sf):
    m = S.fit_median(_loans_numeric(spark, sf), LOAN_NUMERIC)
    return m.select("feature", r6(F.col("median")).alias("median"))


@register("median_impute")
def q_median_impute(spark, sf):
    s = fx.sensors(spark, sf).select("event_id", *[C.q(c) for c in fx.SENSOR_FEATURES])
    med = S.fit_median(s, fx.SENSOR_FEATURES)
    return S.median_impute(s, fx.SENSOR_FEATURES, med).select("event_id", "value", "k")


def _loans_with_missing_segment(spark, sf):
    ln = fx.loans(spark, sf)
    return ln.select("loan_id", F.when(F.col("loan_id") % 11 == 0, F.lit(None)).otherwise(F.col("pcircle")).alias("pcircle"))


@register("mode_impute")
def q_mode_impute(spark, sf):
    return S.mode_impute(_loans_with_missing_segment(spark, sf), ["pcircle"])


@register("scale_standard")
def q_scale_standard(spark, sf):
    s = fx.sensors(spark, sf).select("event_id", *[C.q(c) for c in fx.SENSOR_FEATURES])
    out = S.apply_scale(s, S.fit_scale(s, fx.SENSOR_FEATURES), with_mean=True)
    return out.select("event_id", *[r6(C.q(c)).alias(c) for c in fx.SENSOR_FEATURES])


@register("scale_nomean")
def q_scale_nomean(spark, sf):
    s = fx.sensors(spark, sf).select("event_id", *[C.q(c) for c in fx.SENSOR_FEATURES])
    out = S.apply_scale(s, S.fit_scale(s, fx.SENSOR_FEATURES), with_mean=False)
    return out.select("event_id", *[r6(C.q(c)).alias(c) for c in fx.SENSOR_FEATURES])


@register("one_hot")
def q_one_hot(spark, sf):
    t = fx.transactions(spark, sf).select("txn_id", "type")
    return S.apply_one_hot(t, "type", S.fit_categories(t, "type"))


@register("one_hot_sparse")
def q_one_hot_sparse(spark, sf):
    t = fx.transactions(spark, sf).select("txn_id", "type", "nameDest")  # as many recipients as rows
    known = S.fit_dictionary(t.where(F.col("txn_id") % 13 != 0), ["type", "nameDest"])
    return S.index_categories(t, ["type", "nameDest"], known).select("txn_id", "type_index", "nameDest_index")


@register("class_weights")
def q_class_weights(spark, sf):
    w = S.fit_class_weights(fx.sensors(spark, sf), "fault_occurred")
    return w.select(F.col("label").alias("fault_occurred"), "n", r6(F.col("weight")).alias("weight"))


@register("class_presence")
def q_class_presence(spark, sf):
    return S.class_presence(fx.sensors(spark, sf), "fault_occurred")


@register("confusion_matrix")
def q_confusion_matrix(spark, sf):
    return E.confusion_matrix(fx.scored(spark, sf))


def _r6_all(df: DataFrame) -> DataFrame:
    return df.select(*[r6(F.col(f.name)).alias(f.name) if isinstance(f.dataType, T.DoubleType) else F.col(f.name)
                       for f in df.schema.fields])


@register("binary_metrics")
def q_binary_metrics(spark, sf):
    return _r6_all(E.binary_metrics(fx.scored(spark, sf)))


@register("classification_report")
def q_classification_report(spark, sf):
    return _r6_all(E.classification_report(E.confusion_matrix(fx.scored(spark, sf))))


@register("roc_auc")
def q_roc_auc(spark, sf):
    return _r6_all(E.roc_auc(fx.scored(spark, sf)))


@register("eval_partial_final")
def q_eval_partial_final(spark, sf):
    s = P.split_fraction(fx.scored(spark, sf), "event_id", 0.5, 0.2)
    ev = s.where(F.col("split") == "eval")
    return _r6_all(E.evaluate_scores(ev, "label", "probability", 0.5))


# -------------------------------------------------------------- 2.8 splits


@register("split_range")
def q_split_range(spark, sf):
    return P.split_range(load_table(spark, sf, "events"), "event_id", 5000, 2000).select("event_id", "split")


@register("split_shuffle")
def q_split_shuffle(spark, sf):
    from stratum.plans.news import news_split

    return news_split(spark, sf).select("doc_id", "split")


@register("split_stratified")
def q_split_stratified(spark, sf):
    t = fx.transactions(spark, sf).select("txn_id", "isFraud")
    return P.split_stratified(t, "txn_id", "isFraud", 0.2, 42)


@register("sample_negatives")
def q_sample_negatives(spark, sf):
    s = fx.sensors(spark, sf).select("event_id", "fault_occurred")
    return P.sample_negatives(s, "event_id", "fault_occurred", 1000, 42)


@register("row_at")
def q_row_at(spark, sf):
    return P.row_at(load_table(spark, sf, "events"), "event_id", 1234).select("event_id", "value")


# ------------------------------------------------------- 2.9 sorts / top-k


@register("page")
def q_page(spark, sf):
    t = C.filter_status(C.replace_inf(fx.transactions(spark, sf)), "nonfraud").select("txn_id", "amount")
    rows, total = P.page(t, "txn_id", page_no=40, size=50)
    return rows.withColumn("total_rows", F.lit(total).cast("bigint"))


def _indexed_events(spark, sf, rows_per_file=512):
    """An index of ``events``: every third key arrives later, and then the keys above all others."""
    ev = load_table(spark, sf, "events").select("event_id", "value", "ts")
    late = F.col("event_id") % 3 == 1
    first = rank_index.build(ev.where(~late & (F.col("event_id") % 7 != 0)), "event_id", scratch_path(spark, "events-index"), rows_per_file)
    return first.append(ev.where(~late & (F.col("event_id") % 7 == 0)), rows_per_file).append(ev.where(late), rows_per_file)


@register("indexed_page")
def q_indexed_page(spark, sf):
    rows, total = _indexed_events(spark, sf).page(page_no=40, size=50)
    return rows.select("event_id", "value").withColumn("total_rows", F.lit(total).cast("bigint"))


@register("indexed_range")
def q_indexed_range(spark, sf):
    return _indexed_events(spark, sf).scan_range(700, 4000).select("event_id", "ts", "value")


@register("indexed_row_at")
def q_indexed_row_at(spark, sf):
    return _indexed_events(spark, sf).row_at(777).select("event_id", "value")


@register("indexed_split")
def q_indexed_split(spark, sf):
    return _indexed_events(spark, sf).split_range(5000, 2000).select("event_id", "split")


@register("preview")
def q_preview(spark, sf):
    return P.preview(fx.sensors(spark, sf).select("event_id", "value", "k"), "event_id", 500)


@register("feature_ranking")
def q_feature_ranking(spark, sf):
    from stratum.operators.models import rank_features

    s = fx.sensors(spark, sf)
    feats = ["value", "k", "hour", "TTF leak"]
    imp = s.agg(*[F.abs(F.corr(C.q(c), F.col("fault_occurred").cast("double"))).alias(c) for c in feats])
    imp_long = imp.select(F.inline(F.array(*[F.struct(F.lit(c).alias("feature"), C.q(c).alias("importance"))
                                             for c in feats])))
    ranked = rank_features(imp_long, top_k=40)
    return ranked.select("rank", "feature", r6(F.col("importance")).alias("importance"), r6(F.col("ratio")).alias("ratio"))


@register("feature_ranking_nb")
def q_feature_ranking_nb(spark, sf):
    """The tokens on which a fitted Naive Bayes model leans most: the coefficients of its decision."""
    from stratum.operators.models import rank_features
    from stratum.plans.news import news_split

    m = TM.nb_fit(news_split(spark, sf).where(F.col("split") == "train"), "text", "label")
    ranked = rank_features(TM.nb_coefficients(m), top_k=40)
    return ranked.select("rank", "feature", r6(F.col("importance")).alias("importance"), r6(F.col("ratio")).alias("ratio"))


# --------------------------------------------------------------- 2.10 sets


@register("union_all")
def q_union_all(spark, sf):
    t = fx.transactions(spark, sf).select("txn_id", "isFraud", "isFlaggedFraud")
    fraud = t.where(F.col("isFraud") == 1)
    flagged = C.filter_status(t, "flagged")
    return fraud.unionByName(flagged)


# ---------------------------------------------------------------- 2.11 text



def _news(spark, sf):
    from stratum.plans.news import clean_news

    return clean_news(fx.news_raw(spark, sf))


@register("tokenize")
def q_tokenize(spark, sf):
    toks = X.tokenize(F.col("text"))
    return _news(spark, sf).select("doc_id", F.size(toks).alias("n_tokens"), F.concat_ws(" ", toks).alias("tokens"))


@register("ngrams")
def q_ngrams(spark, sf):
    toks = fx.reviews(spark, sf).select("uniqueID", X.tokenize(F.col("review"), X.WORD2).alias("toks"))
    terms = X.ngrams(F.col("toks"), 2)
    return toks.select("uniqueID", F.size(terms).alias("n_terms"), F.concat_ws("|", terms).alias("terms"))


@register("token_counts")
def q_token_counts(spark, sf):
    return TM.token_counts(_news(spark, sf), "text", "label")


@register("doc_frequency")
def q_doc_frequency(spark, sf):
    return TM.doc_frequency(fx.reviews(spark, sf), "uniqueID", "review")


@register("top_terms")
def q_top_terms(spark, sf):
    return TM.top_terms(TM.doc_frequency(fx.reviews(spark, sf), "uniqueID", "review"), 50_000)


@register("tfidf")
def q_tfidf(spark, sf):
    w = TM.tfidf(fx.reviews(spark, sf), "uniqueID", "review", max_features=50_000)
    return w.select("uniqueID", "token", r6(F.col("weight")).alias("weight"))


@register("nb_fit")
def q_nb_fit(spark, sf):
    from stratum.plans.news import news_split

    train = news_split(spark, sf).where(F.col("split") == "train")
    m = TM.nb_fit(train, "text", "label")
    return m.classes.select(
        "label", "n_docs", "total_words", r6(F.col("prior")).alias("prior"), F.lit(m.vocab_size).cast("bigint").alias("vocab_size")
    )


@register("nb_score")
def q_nb_score(spark, sf):
    from stratum.plans.news import news_fit_score

    _, scored = news_fit_score(spark, sf)
    return scored.select(
        "doc_id", r6(F.col("score0")).alias("score0"), r6(F.col("score1")).alias("score1"), "prediction",
        r6(F.col("probability")).alias("probability"),
    )


@register("nb_eval")
def q_nb_eval(spark, sf):
    from stratum.plans.news import news_eval

    return _r6_all(news_eval(spark, sf))


# ------------------------------------------------------ 2.15 described extras


@register("recommend_topk")
def q_recommend_topk(spark, sf):
    from stratum.operators.recommend import recommend_topk

    out = recommend_topk(fx.reviews(spark, sf), "condition", "drugName", "rating", "usefulCount", k=3)
    return out.select("condition", "rank", "drugName", r6(F.col("score")).alias("score"),
                      r6(F.col("positive_rate")).alias("positive_rate"), "n_reviews")


@register("dedup_text")
def q_dedup_text(spark, sf):
    return TM.dedup_text(load_table(spark, sf, "documents"), "doc_id", "text").select("doc_id")


@register("threshold_sweep")
def q_threshold_sweep(spark, sf):
    grid = [i / 10 for i in range(1, 10)]
    return _r6_all(E.threshold_sweep(fx.scored(spark, sf), "label", "probability", grid))


@register("score_curve")
def q_score_curve(spark, sf):
    curve = E.score_curve(_linear_scored(spark, sf), "fault_occurred", "decision")
    return _r6_all(curve.select("threshold", "tn", "fp", "fn", "tp"))


@register("threshold_by_cost")
def q_threshold_by_cost(spark, sf):
    curve = E.score_curve(_linear_scored(spark, sf), "fault_occurred", "decision")
    return _r6_all(E.threshold_by_cost(curve, [(1, 1), (1, 8), (1, 40), (0, 1)]))


@register("threshold_by_recall")
def q_threshold_by_recall(spark, sf):
    curve = E.score_curve(_linear_scored(spark, sf), "fault_occurred", "decision")
    return _r6_all(E.threshold_by_recall(curve, [0.25, 0.5, 0.9, 1.0]))


@register("drift_distances")
def q_drift_distances(spark, sf):
    s = P.split_range(fx.sensors(spark, sf), "event_id", 5000, 0)
    late = F.col("event_id") % 41
    s = s.withColumn("value", F.when(late == 0, float("inf")).when(late == 1, float("-inf")).when(late == 2, float("nan")).otherwise(F.col("value")))
    return _r6_all(S.drift_distances(s, fx.SENSOR_FEATURES, "split", "train", "live"))


@register("drift_monitor")
def q_drift_monitor(spark, sf):
    s = P.split_range(fx.sensors(spark, sf), "event_id", 5000, 0)
    return _r6_all(S.drift_monitor(s, fx.SENSOR_FEATURES, "split", "train", "live"))


@register("html_unescape")
def q_html_unescape(spark, sf):
    return fx.html_pages(spark, sf).select("page_id", X.html_unescape(F.col("html")).alias("html"))


# ------------------------------------------------------ 2.12 models / scoring


# Fixed coefficient table of the deterministic scorer (decision-score path).
LINEAR_COEFS = {"value": 0.012, "k": -0.021, "hour": 0.047}
LINEAR_INTERCEPT = -1.5


def _linear_scored(spark, sf):
    s = fx.sensors(spark, sf)
    sc = M.score_linear(s, LINEAR_COEFS, LINEAR_INTERCEPT, keep=["event_id", "time", "value", "k", "hour", "fault_occurred"])
    return sc.withColumn("prediction", C.threshold(F.col("probability"), 0.5))


@register("score_linear")
def q_score_linear(spark, sf):
    sc = _linear_scored(spark, sf)
    return sc.select("event_id", r6(F.col("decision")).alias("decision"), r6(F.col("probability")).alias("probability"),
                     "prediction")


@register("engineer_features")
def q_engineer_features(spark, sf):
    from stratum.plans.loan import engineer_features

    return _r6_all(engineer_features(fx.loans(spark, sf)))


@register("loan_pipeline")
def q_loan_pipeline(spark, sf):
    from stratum.plans.loan import loan_split, prepare

    return _r6_all(prepare(loan_split(spark, sf)).frame)


@register("logreg_sgd")
def q_logreg_sgd(spark, sf):
    from stratum.plans.loan import loan_eval

    return loan_eval(spark, sf)


@register("forest_weights")
def q_forest_weights(spark, sf):
    """The rows of three trees' samples with their weights, balanced in each sample by itself."""
    s = fx.sensors(spark, sf).select("event_id", "fault_occurred")
    out = None
    for t in range(3):
        one = B.sample_weights(s, "event_id", "fault_occurred", t).select(F.lit(t).alias("tree"), "event_id", "draws", r6(F.col("weight")).alias("weight"))
        out = one if out is None else out.unionByName(one)
    return out


@register("logreg_online")
def q_logreg_online(spark, sf):
    """Weights after two passes over five ranges; the second run takes up the state of the first."""
    feats = ["value", "k", "hour"]
    s = fx.sensors(spark, sf)
    scaled = S.apply_scale(s.select("event_id", "fault_occurred", *feats), S.fit_scale(s, feats))
    ranged = scaled.withColumn("r", (F.col("event_id") % 5).cast("int"))
    path = scratch_path(spark, "online")
    OL.fit(spark, path, ranged, "r", [0, 1, 2], "fault_occurred", feats)
    state = OL.fit(spark, path, ranged, "r", [0, 1, 2, 3, 4], "fault_occurred", feats, epochs=2)
    rows = [("intercept", state.intercept, state.step), *((f, w, state.step) for f, w in zip(state.features, state.weights))]
    return spark.createDataFrame(rows, "term string, weight double, step long").withColumn("weight", r6(F.col("weight")))


@register("score_json")
def q_score_json(spark, sf):
    from stratum.plans.fraud import score_json_linear

    out = score_json_linear(fx.json_records(spark, sf), "body", {"amount": 1e-5, "oldbalanceOrg": -2e-6}, {"1-URGENT": 0.7, "TRANSFER": -0.4}, -0.5, keep=["txn_id"])
    return out.withColumn("probability", r6(F.col("probability")))


@register("score_batch")
def q_score_batch(spark, sf):
    from stratum.plans.loan import loan_score_live

    return loan_score_live(spark, sf)


@register("logreg_partial")
def q_logreg_partial(spark, sf):
    from stratum.plans.fault import fault_eval

    return fault_eval(spark, sf, "logistic")


@register("random_forest")
def q_random_forest(spark, sf):
    from stratum.plans.fault import fault_eval

    return fault_eval(spark, sf, "forest")


@register("logreg_balanced")
def q_logreg_balanced(spark, sf):
    from stratum.plans.maintenance import maintenance_eval

    return maintenance_eval(spark, sf, n_negatives=200_000)


@register("logreg_text")
def q_logreg_text(spark, sf):
    from stratum.plans.drug import drug_report

    return drug_report(spark, sf)


@register("gbt")
def q_gbt(spark, sf):
    from stratum.plans.fraud import fraud_eval

    return fraud_eval(spark, sf)


@register("fraud_pipeline")
def q_fraud_pipeline(spark, sf):
    from stratum.plans.fraud import fraud_scored

    return fraud_scored(spark, sf)


# ----------------------------------------------------------------- 2.2 sinks

PRED_SCHEMA = T.StructType([
    T.StructField("event_id", T.LongType()),
    T.StructField("value", T.DoubleType()),
    T.StructField("k", T.DoubleType()),
    T.StructField("hour", T.DoubleType()),
    T.StructField("decision", T.DoubleType()),
    T.StructField("probability", T.DoubleType()),
    T.StructField("prediction", T.IntegerType()),
])


@register("sink_predictions")
def q_sink_predictions(spark, sf):
    sc = _linear_scored(spark, sf).drop("time")
    path = K.write_predictions(sc, scratch_path(spark, "predictions"), target="fault_occurred")
    back = K.read_csv(spark, path, PRED_SCHEMA, one_line=True)
    return back.select("event_id", "value", "k", "hour", r6(F.col("probability")).alias("probability"), "prediction")


@register("sink_predictions_slim")
def q_sink_predictions_slim(spark, sf):
    back = spark.read.parquet(K.write_slim(_linear_scored(spark, sf), scratch_path(spark, "slim")))
    return back.select("time", "predicted_fault", r6(F.col("probability")).alias("probability"))


TXN_SCHEMA = T.StructType([
    T.StructField("txn_id", T.LongType()),
    T.StructField("type", T.StringType()),
    T.StructField("amount", T.DoubleType()),
    T.StructField("oldbalanceDest", T.DoubleType()),
    T.StructField("nameOrig", T.StringType()),
    T.StructField("isFlaggedFraud", T.StringType()),
])


@register("export_filtered")
def q_export_filtered(spark, sf):
    t = C.filter_status(C.replace_inf(fx.transactions(spark, sf)), "fraud").select(*TXN_SCHEMA.fieldNames())
    path = K.export_filtered(t, scratch_path(spark, "export"), "fraud", one_line=True)
    return K.read_csv(spark, path, TXN_SCHEMA, one_line=True)


@register("sink_metadata")
def q_sink_metadata(spark, sf):
    from stratum.plans.loan import loan_split

    sp = loan_split(spark, sf)
    counts = sp.groupBy("split").count().collect()  # three rows
    c = {r["split"]: r["count"] for r in counts}
    train, held = c.get("train", 0), c.get("eval", 0)
    record = {"table_name": "loans", "target": "label", "row_count": sum(c.values()), "train_rows": train, "eval_rows": held, "live_offset": train + held, "seed": 42}
    path = K.write_metadata(spark, scratch_path(spark, "metadata"), record, {"train_share": train / max(1, sum(c.values()))})
    back = spark.read.json(path).withColumn("live_offset", F.lit(K.read_live_offset(spark, path)).cast("long"))
    return back.select("table_name", "target", "row_count", "train_rows", "eval_rows", "live_offset", "seed")


@register("sink_run_log")
def q_sink_run_log(spark, sf):
    from stratum.plans.news import news_eval

    path = scratch_path(spark, "runlog")
    m = news_eval(spark, sf).select("accuracy", "tn", "fp", "fn", "tp")
    for run in (1, 2):
        K.append_run_log(m, path, run, sample_text="sample", sample_prediction=1)
    back = spark.read.parquet(path)
    return back.select("run_id", r6(F.col("accuracy")).alias("accuracy"), "tn", "fp", "fn", "tp")


@register("sink_nb_model")
def q_sink_nb_model(spark, sf):
    from stratum.plans.news import news_split

    train = news_split(spark, sf).where(F.col("split") == "train")
    m = TM.nb_fit(train, "text", "label")
    return TM.load_nb(spark, TM.save_nb(m, scratch_path(spark, "nb"))).terms


@register("nb_score_saved")
def q_nb_score_saved(spark, sf):
    from stratum.plans.news import news_split

    split = news_split(spark, sf)
    path = TM.save_nb(TM.nb_fit(split.where(F.col("split") == "train"), "text", "label"), scratch_path(spark, "nb"))
    sc = TM.nb_score(TM.load_nb(spark, path), split.where(F.col("split") == "test"), "doc_id", "text")
    return sc.select("doc_id", r6(F.col("score0")).alias("score0"), r6(F.col("score1")).alias("score1"), "prediction", r6(F.col("probability")).alias("probability"))


def _nb_state(spark, sf):
    """A state that took documents in three batches, one of them twice, and gave every fifth document up."""
    path, docs = scratch_path(spark, "nb-state"), _news(spark, sf)
    for i in (2, 0, 0, 1):
        NS.update(spark, path, f"part {i}", add=docs.where(F.col("doc_id") % 3 == i))
    NS.update(spark, path, "forgotten", forget=docs.where(F.col("doc_id") % 5 == 0))
    return NS.model(spark, path)


@register("nb_update")
def q_nb_update(spark, sf):
    return _nb_state(spark, sf).terms


@register("nb_update_classes")
def q_nb_update_classes(spark, sf):
    m = _nb_state(spark, sf)
    return m.classes.select("label", "n_docs", "total_words", r6(F.col("prior")).alias("prior"), F.lit(m.vocab_size).cast("bigint").alias("vocab_size"))


@register("dedup_incremental")
def q_dedup_incremental(spark, sf):
    docs = load_table(spark, sf, "documents")
    index = DigestIndex(spark, scratch_path(spark, "digests"), docs.schema["doc_id"].dataType)
    for i in (2, 0, 0, 1):
        index.add(f"b{i}", docs.where(F.col("doc_id") % 3 == i), "doc_id", "text")
    return index.survivors().select(F.col("key").alias("doc_id"))


@register("recommend_shrunk")
def q_recommend_shrunk(spark, sf):
    from stratum.operators.recommend import recommend_shrunk

    out = recommend_shrunk(fx.reviews(spark, sf), "condition", "drugName", "rating", k=3)
    return _r6_all(out.select("condition", "rank", "drugName", "n_reviews", "mean_rating", "group_mean", "score"))


@register("sink_profile")
def q_sink_profile(spark, sf):
    p = S.profile_numeric(fx.sensors(spark, sf), fx.SENSOR_FEATURES)
    path = K.write_json(p.withColumn("generated_at", F.current_timestamp()), scratch_path(spark, "profile"))
    back = spark.read.schema("feature string, min double, max double, median double, generated_at timestamp").json(path)
    return back.select("feature", r6(F.col("min")).alias("min"), r6(F.col("max")).alias("max"),
                       r6(F.col("median")).alias("median"))


@register("sink_model")
def q_sink_model(spark, sf):
    from pyspark.ml import PipelineModel

    from stratum.plans.fault import KEY, TARGET, fault_data, fit_fault_model

    data = fault_data(spark, sf)
    model = fit_fault_model(data, "logistic")
    path = scratch_path(spark, "model")
    model.write().overwrite().save(path)
    loaded = PipelineModel.load(path)
    return M.score(loaded, data.frame.where(F.col("split") == "eval"), keep=[KEY, TARGET])


@register("sink_report")
def q_sink_report(spark, sf):
    from stratum.plans.fault import fault_report

    return fault_report(spark, sf, "forest")


# ------------------------------------------------------------ 2.13 streaming



def _events_stream(spark, sf):
    schema = load_table(spark, sf, "events").schema
    return ST.file_stream(spark, sf, schema, glob="events.parquet")


@register("stream_score")
def q_stream_score(spark, sf):
    out, ckpt = ST.scratch(spark, "stream-score")

    def transform(ev):
        sc = M.score_linear(fx.sensors_from(ev), LINEAR_COEFS, LINEAR_INTERCEPT, keep=["event_id"])
        return sc.withColumn("prediction", C.threshold(F.col("probability"), 0.5))

    ST.run_to_end(ST.stream_score(_events_stream(spark, sf), transform, out, ckpt))
    back = spark.read.parquet(out)
    return back.select("event_id", r6(F.col("decision")).alias("decision"), r6(F.col("probability")).alias("probability"),
                       "prediction")


@register("stream_eval")
def q_stream_eval(spark, sf):
    out, ckpt = ST.scratch(spark, "stream-eval")
    ST.run_to_end(ST.stream_eval(fx.scored_from(_events_stream(spark, sf)), out, ckpt))
    return ST.confusion_from_counts(ST.running_counts(spark, out))


@register("stream_windows")
def q_stream_windows(spark, sf):
    """Six arrivals of five days each, the stream restarted after each; some rows come late, some twice, some too late."""
    folder = scratch_path(spark, "arrivals")
    out, ckpt = ST.scratch(spark, "stream-windows")
    ev = fx.arriving_events(spark, sf)
    schema = ev.drop("arrival").schema
    for i in range(fx.ARRIVALS):
        ev.where(F.col("arrival") == i).drop("arrival").write.mode("append").parquet(folder)
        ST.run_to_end(ST.stream_windows(ST.file_stream(spark, folder, schema), out, ckpt, "ts", "event_id"))
    closed = spark.read.parquet(out)
    m = _r6_all(ST.window_metrics(closed))
    joined = [F.array_join(F.col(c).cast("array<string>"), " ").alias(c) for c in ("neg", "pos")]
    return m.select("window_start", "tn", "fp", "fn", "tp", *joined, "accuracy", "precision", "recall", "f1", "auc")


# The sample corpus layout (header id,label,title,text,topic,source_url).
NEWS_CSV_SCHEMA = T.StructType([
    T.StructField("id", T.LongType()),
    T.StructField("label", T.StringType()),
    T.StructField("title", T.StringType()),
    T.StructField("text", T.StringType()),
    T.StructField("topic", T.StringType()),
    T.StructField("source_url", T.StringType()),
])


@register("scan_csv")
def q_scan_csv(spark, sf):
    d = load_table(spark, sf, "documents").join(load_table(spark, sf, "labels"), "doc_id")
    corpus = d.select(
        F.col("doc_id").alias("id"),
        F.when(F.col("quality") == 1, F.lit("REAL")).otherwise(F.lit("FAKE")).alias("label"),
        F.substring_index(F.col("text"), "\n", 1).alias("title"),
        F.col("text"),
        F.col("lang").alias("topic"),
        F.concat(F.lit("/"), F.col("source"), F.lit("/"), F.col("doc_id").cast("string")).alias("source_url"),
    )
    path = K.write_csv(corpus, scratch_path(spark, "corpus"))
    return K.read_csv(spark, path, NEWS_CSV_SCHEMA)
