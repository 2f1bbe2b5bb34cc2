"""Transaction fraud: inf -> NULL, complete cases, stratified split, impute + one-hot, boosted trees."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stratum.functions import clean as C
from stratum.operators import evaluate as E
from stratum.operators import fitstate as S
from stratum.operators import models as M
from stratum.operators.split import hash_order, split_stratified
from stratum.session import cut_lineage
from stratum.sources import fixtures

KEY = "txn_id"
TARGET = "isFraud"
NUMERIC = list(fixtures.TXN_NUMERIC)
CATEGORY = "type"


def fraud_frame(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = C.replace_inf(fixtures.transactions(spark, sf_dir))
    t = C.complete_case(t, exclude=[TARGET, "nameOrig", "nameDest"])
    t = cut_lineage(t.withColumn(TARGET, C.flag_int(F.col(TARGET))))  # read by the split and every fit
    return split_stratified(t, KEY, TARGET, 0.2, 42)


def fit_fraud_model(df: DataFrame, with_prep: bool = False, early_stopping: bool = True, holdout: float = 0.1):
    """Boosted trees on the train part; returns ``(model, features, prepared df[, prep function])``.

    ``early_stopping`` keeps a seeded share ``holdout`` of the train part for validation, at every size."""
    train = df.where(F.col("split") == "train")
    med = S.state_dict(S.fit_median(train, NUMERIC), "feature", "median")
    cats, mode = S.fit_category_state(train, CATEGORY)

    def prep(x: DataFrame) -> DataFrame:
        x = S.apply_fill(x, med).withColumn(CATEGORY, F.coalesce(F.col(CATEGORY), F.lit(mode)))
        return S.apply_one_hot(x, CATEGORY, cats)

    feats = NUMERIC + [f"{CATEGORY}_{c}" for c in cats]
    tr = S.apply_class_weights(prep(train), TARGET, S.fit_class_weights(train, TARGET))
    if early_stopping:
        tr = tr.withColumn("is_val", F.pmod(hash_order(KEY, 7), F.lit(10_000)) < int(holdout * 10_000))
    model = M.fit([M.assembler(feats), M.boosted(TARGET, "weight", "is_val" if early_stopping else None)], tr)
    if with_prep:
        return model, feats, prep(df), prep
    return model, feats, prep(df)


def fraud_scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = fraud_frame(spark, sf_dir)
    model, _, prepared = fit_fraud_model(df)
    return M.score(model, prepared.where(F.col("split") == "test"), keep=[KEY, TARGET], threshold=0.5)


def fraud_eval(spark: SparkSession, sf_dir: str) -> DataFrame:
    return E.evaluate_scores(fraud_scored(spark, sf_dir), TARGET, "probability", 0.5)


# Defaults for absent fields of a JSON prediction request.
JSON_DEFAULTS = {"type": "TRANSFER", **{c: 0.0 for c in NUMERIC}}


JSON_SCHEMA = T.StructType([T.StructField(CATEGORY, T.StringType())] + [T.StructField(c, T.DoubleType()) for c in NUMERIC])


def score_records(records: DataFrame, json_col: str, scorer: Callable[[DataFrame, list[str]], DataFrame], keep=()) -> DataFrame:
    """Score JSON feature records (one object per row): ``keep``, ``prediction``, ``probability``, ``error``.

    Parsed with a fixed schema; absent fields and those of another type take their defaults; ``scorer`` gives
    ``keep``, prediction and probability of the rows.  A record that is not an object has no score but its error's text.
    """
    keep = list(keep)
    parsed = C.parse_json_rows(records, json_col, JSON_SCHEMA, keep=keep)
    good = C.fill_defaults(parsed.where(F.col("error").isNull()).drop("error"), JSON_DEFAULTS)
    scored = scorer(good, keep).select(*keep, F.col("prediction").cast("int").alias("prediction"), "probability", F.lit(None).cast("string").alias("error"))
    bad = parsed.where(F.col("error").isNotNull()).select(*keep, F.lit(None).cast("int").alias("prediction"), F.lit(None).cast("double").alias("probability"), "error")
    return scored.unionByName(bad)


def score_json_records(records: DataFrame, json_col: str, model: PipelineModel, prep, keep=()) -> DataFrame:
    """``score_records`` by a fitted model after its preparation, with the 0.5 threshold."""
    return score_records(records, json_col, lambda rows, kept: M.score(model, prep(rows), keep=kept, threshold=0.5), keep)


def score_json_linear(records: DataFrame, json_col: str, coefficients: Mapping[str, float], by_type: Mapping[str, float], intercept: float, keep=()) -> DataFrame:
    """``score_records`` by a fixed coefficient table: one weight a numeric field, one a transaction type."""

    def scorer(rows: DataFrame, kept: list[str]) -> DataFrame:
        of_type = F.lit(0.0)
        for name, w in by_type.items():
            of_type = F.when(F.col(CATEGORY) == name, F.lit(float(w))).otherwise(of_type)
        scored = M.score_linear(rows.withColumn("_type", of_type), {**coefficients, "_type": 1.0}, intercept, keep=kept)
        return scored.withColumn("prediction", C.threshold(F.col("probability"), 0.5))

    return score_records(records, json_col, scorer, keep)
