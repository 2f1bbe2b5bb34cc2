"""Sensor maintenance: stratified split, all positives + sampled negatives to train on, impute + standardise, balanced LR."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratum.functions import clean as C
from stratum.operators import evaluate as E
from stratum.operators import fitstate as S
from stratum.operators import models as M
from stratum.operators.split import sample_negatives, split_stratified
from stratum.session import cut_lineage
from stratum.sources import fixtures

KEY = "event_id"
TARGET = "fault_occurred"


def maintenance_eval(spark: SparkSession, sf_dir: str, n_negatives: int = 200_000, C_: float = 1.0) -> DataFrame:
    s = fixtures.sensors(spark, sf_dir)
    feats = C.candidate_features(s, TARGET, admin=(*C.ADMIN_COLUMNS, KEY))
    s = C.drop_nulls(s.select(KEY, *[C.q(c) for c in feats], TARGET), [TARGET])
    sp = cut_lineage(split_stratified(s, KEY, TARGET, 0.2, 42), "maintenance")  # every test row is scored
    train = sample_negatives(sp.where(F.col("split") == "train"), KEY, TARGET, n_negatives, 42)
    train = cut_lineage(train, "maintenance-train")
    med = S.state_dict(S.fit_median(train, feats), "feature", "median")
    scales = S.fit_scale(S.apply_fill(train, med), feats)
    ready = lambda x: S.apply_scale(S.apply_fill(x, med), scales, with_mean=True)
    weights = S.fit_class_weights(train, TARGET)
    tr = S.apply_class_weights(ready(train), TARGET, weights)
    total_w = tr.agg(F.sum("weight")).first()[0] or 1.0
    model = M.fit([M.assembler(feats), M.logistic(TARGET, "weight", reg=1.0 / (C_ * total_w), max_iter=2000, tol=1e-6)], tr)
    te = M.score(model, ready(sp.where(F.col("split") == "test")), keep=[KEY, TARGET])
    return E.evaluate_scores(te, TARGET, "probability", 0.5)
