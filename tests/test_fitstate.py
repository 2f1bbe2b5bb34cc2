"""Fitted state: medians, modes, scaling, one-hot, class weights."""

import statistics

import pytest
from pyspark.sql import functions as F

from stratum.operators import fitstate as S


def test_median_exact_even_odd_and_all_null(spark):
    rows = [(float(i), float(i % 4) if i % 5 else None, None) for i in range(1, 12)]
    df = spark.createDataFrame(rows, "a double, b double, c double")
    med = S.state_dict(S.fit_median(df, ["a", "b", "c"], local_limit=3, pivots=2), "feature", "median")
    assert med["a"] == statistics.median([r[0] for r in rows])
    assert med["b"] == statistics.median([r[1] for r in rows if r[1] is not None])
    assert med["c"] is None


def test_median_impute_uses_batch_median_for_unknown(spark):
    df = spark.createDataFrame([(1.0, None), (None, 4.0), (3.0, 2.0)], "a double, b double")
    fitted = spark.createDataFrame([("a", 10.0)], "feature string, median double")
    out = S.median_impute(df, ["a", "b"], fitted).collect()
    assert [r["a"] for r in out] == [1.0, 10.0, 3.0]
    assert [r["b"] for r in out] == [3.0, 4.0, 2.0]


def test_mode_ties_smallest(spark):
    df = spark.createDataFrame([("b",), ("a",), ("b",), ("a",), (None,), ("c",)], "x string")
    assert S.state_dict(S.fit_mode(df, ["x"]), "feature", "mode") == {"x": "a"}
    assert [r[0] for r in S.mode_impute(df, ["x"]).collect()][4] == "a"


def test_scale_population_std_and_constant(spark):
    df = spark.createDataFrame([(1.0, 5.0), (3.0, 5.0)], "a double, k double")
    sc = S.fit_scale(df, ["a", "k"])
    out = S.apply_scale(df, sc).collect()
    assert [r["a"] for r in out] == [-1.0, 1.0]
    assert [r["k"] for r in out] == [0.0, 0.0]


def test_one_hot_sorted_unknown_zero(spark):
    train = spark.createDataFrame([("y",), ("x",)], "c string")
    cats = S.fit_categories(train, "c")
    assert cats == ["x", "y"]
    out = S.apply_one_hot(spark.createDataFrame([("x",), ("z",), (None,)], "c string"), "c", cats).collect()
    assert [tuple(r) for r in out] == [(1, 0), (0, 0), (0, 0)]


def test_class_weights_balanced_and_single_class(spark):
    df = spark.createDataFrame([(0,)] * 3 + [(1,)], "y int")
    w = S.state_dict(S.fit_class_weights(df, "y"), "label", "weight")
    assert w == {0: pytest.approx(4 / 6), 1: pytest.approx(2.0)}
    one = spark.createDataFrame([(1,)] * 3, "y int")
    assert S.state_dict(S.fit_class_weights(one, "y"), "label", "weight") == {1: 1.0}
    assert S.class_presence(one, "y").first()["can_train"] == 0


def test_prune_constant_and_profile(spark):
    df = spark.createDataFrame([(1.0, 2.0, None), (1.0, 3.0, None)], "a double, b double, c double")
    assert {r["feature"]: r["varying"] for r in S.prune_constant(df, ["a", "b", "c"]).collect()} == {"a": 0, "b": 1, "c": 0}
    p = {r["feature"]: r for r in S.profile_numeric(df.withColumn("b", F.col("b")), ["b"]).collect()}
    assert (p["b"]["min"], p["b"]["max"], p["b"]["median"]) == (2.0, 3.0, 2.5)


def test_median_approx_close(spark):
    df = spark.range(1, 1001).select(F.col("id").cast("double").alias("a"))
    med = S.state_dict(S.fit_median(df, ["a"], approx=True), "feature", "median")["a"]
    assert abs(med - 500.5) <= 1.0


def test_category_state_matches_separate_fits(spark):
    df = spark.createDataFrame([("b",), ("a",), ("b",), ("a",), (None,), ("c",)], "x string")
    cats, mode = S.fit_category_state(df, "x")
    assert cats == S.fit_categories(df, "x") == ["a", "b", "c"]
    assert mode == S.state_dict(S.fit_mode(df, ["x"]), "feature", "mode")["x"] == "a"
