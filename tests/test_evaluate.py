"""Metric operators: golden arithmetic from published confusion counts, brute-force AUC."""

import itertools
import random

import pytest
from pyspark.sql import functions as F

from stratum.operators import evaluate as E


def _cm(spark, tn, fp, fn, tp):
    return spark.createDataFrame([(tn, fp, fn, tp)], "tn long, fp long, fn long, tp long")


def test_binary_metrics_loan_golden(spark):
    m = E.metrics_from_counts(_cm(spark, 1991, 553, 4813, 12643)).first()
    assert round(m["accuracy"], 4) == 0.7317
    assert m["precision"] == pytest.approx(0.9580933616, abs=1e-9)
    assert m["recall"] == pytest.approx(0.7242781852, abs=1e-9)
    assert m["f1"] == pytest.approx(0.8249380138, abs=1e-9)


def test_classification_report_loan_golden(spark):
    rep = {r["class"]: r for r in E.classification_report(_cm(spark, 1991, 553, 4813, 12643)).collect()}
    assert round(rep["macro avg"]["f1"], 4) == 0.6255
    assert round(rep["weighted avg"]["f1"], 4) == 0.7742
    assert rep["0"]["support"] == 2544 and rep["1"]["support"] == 17456
    assert rep["accuracy"]["support"] == 20000


def test_news_accuracy_golden(spark):
    assert round(E.metrics_from_counts(_cm(spark, 7493, 1193, 607, 6424)).first()["accuracy"], 4) == 0.8855


def test_zero_denominators(spark):
    m = E.metrics_from_counts(_cm(spark, 0, 0, 0, 0)).first()
    assert (m["accuracy"], m["precision"], m["recall"], m["f1"]) == (0.0, 0.0, 0.0, 0.0)


def _auc_pairs(rows):
    pos = [s for y, s in rows if y == 1]
    neg = [s for y, s in rows if y == 0]
    tot = sum(1.0 if p > n else 0.5 if p == n else 0.0 for p, n in itertools.product(pos, neg))
    return tot / (len(pos) * len(neg))


def test_roc_auc_matches_all_pairs_with_ties(spark):
    rnd = random.Random(3)
    rows = [(rnd.randint(0, 1), rnd.randint(0, 40) / 40) for _ in range(600)]
    df = spark.createDataFrame(rows, "label int, probability double")
    assert E.roc_auc(df).first()["roc_auc"] == pytest.approx(_auc_pairs(rows), abs=1e-12)
    ev = E.evaluate_scores(df, "label", "probability", 0.5).first()
    assert ev["roc_auc"] == pytest.approx(_auc_pairs(rows), abs=1e-12)
    assert ev["tp"] == sum(1 for y, s in rows if y == 1 and s >= 0.5)


def test_roc_auc_one_class_is_null(spark):
    df = spark.createDataFrame([(1, 0.2), (1, 0.9)], "label int, probability double")
    assert E.roc_auc(df).first()["roc_auc"] is None


def test_threshold_sweep_matches_counts(spark):
    rows = [(i % 2, (i % 10) / 10) for i in range(100)]
    df = spark.createDataFrame(rows, "label int, probability double")
    out = {r["threshold"]: r for r in E.threshold_sweep(df, "label", "probability", [0.3, 0.7]).collect()}
    for t in (0.3, 0.7):
        assert out[t]["tp"] == sum(1 for y, s in rows if y == 1 and s >= t)
        assert out[t]["fp"] == sum(1 for y, s in rows if y == 0 and s >= t)


def test_status_summary_missing_columns(spark):
    df = spark.range(4).withColumn("isFraud", F.lit("1"))
    r = E.status_summary(df).first()
    assert (r["fraud"], r["non_fraud"], r["flagged"], r["fraud_rate"], r["flagged_rate"]) == (4, 0, 0, 1.0, 0.0)


def _scored(spark, n=500, seed=4):
    rnd = random.Random(seed)
    rows = [(rnd.choice([0, 1, 1, None]), rnd.choice([None, float("inf"), -1.5, *(rnd.randint(0, 60) / 7 for _ in range(20))])) for _ in range(n)]
    return rows, spark.createDataFrame(rows, "label int, probability double").repartition(5)


def _at(rows, t):
    known = [(y, s) for y, s in rows if y is not None and s is not None]
    hit = lambda s: t is not None and s >= t
    return tuple(sum(y == a and hit(s) == b for y, s in known) for a, b in ((0, False), (0, True), (1, False), (1, True)))


def test_score_curve_equals_counting_at_every_threshold(spark):
    rows, df = _scored(spark)
    curve = {r["threshold"]: (r["tn"], r["fp"], r["fn"], r["tp"]) for r in E.score_curve(df).collect()}
    assert curve == {t: _at(rows, t) for t in {s for y, s in rows if y is not None and s is not None}}


def test_thresholds_by_cost_and_recall(spark):
    rows, df = _scored(spark)
    curve = E.score_curve(df)
    every = [None, *sorted({s for y, s in rows if y is not None and s is not None}, reverse=True)]
    for r in E.threshold_by_cost(curve, [(1, 1), (3, 1), (50, 0.5), (0, 1), (1, 0), (0, 0)]).collect():
        price = lambda t: _at(rows, t)[1] * r["fp_cost"] + _at(rows, t)[2] * r["fn_cost"]  # noqa: E731, B023
        best = min(map(price, every))
        assert r["cost"] == pytest.approx(best) and r["threshold"] == next(t for t in every if price(t) == best)
        assert (r["tn"], r["fp"], r["fn"], r["tp"]) == _at(rows, r["threshold"])
    found = {r["target"]: r for r in E.threshold_by_recall(curve, [0.01, 0.5, 1.0]).collect()}
    for target, r in found.items():
        reach = [t for t in every[1:] if _at(rows, t)[3] >= target * (_at(rows, t)[3] + _at(rows, t)[2])]
        assert r["threshold"] == max(reach)
    assert len(found) == 3


def test_thresholds_without_rows_or_positives(spark):
    empty = E.score_curve(spark.createDataFrame([(1, None), (None, 0.5)], "label int, probability double"))
    assert empty.collect() == [] and E.threshold_by_cost(empty, [(1, 1)]).collect() == [] and E.threshold_by_recall(empty, [0.5]).collect() == []
    negative = E.score_curve(spark.createDataFrame([(0, 0.1), (0, 0.9)], "label int, probability double"))
    assert E.threshold_by_recall(negative, [0.5]).collect() == []
    assert E.threshold_by_cost(negative, [(1, 1)]).first()["threshold"] is None


def test_prefix_scan_over_groups_nulls_and_any_type(spark):
    from stratum.operators.prefix_scan import running_totals

    rnd = random.Random(9)
    for kind, value in (("string", lambda i: f"k{i:04d}"), ("double", lambda i: i / 3), ("long", lambda i: i)):
        rows = [(g, value(i), rnd.randint(-5, 5), 1) for g in ("a", "b", None) for i in rnd.sample(range(400), 120)]
        df = spark.createDataFrame(rows, f"g string, v {kind}, x long, y long").repartition(6)
        got = {(r["g"], r["v"]): (r["x_below"], r["x_total"], r["y_below"], r["y_total"], r["v_next"]) for r in running_totals(df, "v", ["x", "y"], ["g"]).collect()}
        for g in ("a", "b", None):
            own = sorted((v, x) for h, v, x, _ in rows if h == g)
            for i, (v, _) in enumerate(own):
                assert got[g, v] == (sum(x for _, x in own[:i]), sum(x for _, x in own), i, len(own), own[i + 1][0] if i + 1 < len(own) else None)


@pytest.mark.parametrize("make", [E.roc_auc, E.score_curve, lambda df: E.evaluate_scores(df, "label", "probability")])
def test_no_nested_loop_and_no_single_task_over_scores(spark, make):
    _, df = _scored(spark)
    plan = make(df)._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan
    assert "Window [sum(neg" not in plan.split("SinglePartition")[0] or "_range" in plan
