"""Exact order statistics and the range operators built on them, against brute force."""

import math
import random

import pytest
from pyspark.sql import functions as F

from stratum.operators.ordering import rank_filter, select_ranks
from stratum.operators.split import page, sample_negatives, split_range, split_shuffle, split_stratified


@pytest.fixture(scope="module")
def values(spark):
    rnd = random.Random(7)
    rows = [(i, rnd.choice([None, float(rnd.randint(0, 50)), rnd.random() * 1000]), i % 3) for i in range(3000)]
    return spark.createDataFrame(rows, "k long, v double, g int"), rows


@pytest.mark.parametrize("local_limit,pivots", [(200_000, 1024), (50, 4), (7, 2)])
def test_select_ranks_matches_sorting(values, local_limit, pivots):
    df, rows = values
    vals = sorted(v for _, v, _ in rows if v is not None)
    ranks = [0, 1, 17, len(vals) // 2, len(vals) - 1, len(vals), len(vals) + 5]
    res = select_ranks(df, "v", ranks, local_limit=local_limit, pivots=pivots)
    assert res.counts[0] == len(vals)
    for r in ranks:
        got = res.get(r)
        if r >= len(vals):
            assert got is None
        else:
            assert got[0] == vals[r]


def test_select_ranks_grouped_with_tiebreak(values):
    df, rows = values
    res = select_ranks(df, "v", lambda g, n: [0, n // 3, n - 1], group="g", tiebreak="k", local_limit=10, pivots=3)
    for g in range(3):
        ordered = sorted((v, k) for k, v, gg in rows if gg == g and v is not None)
        n = len(ordered)
        assert res.counts[g] == n
        for r in (0, n // 3, n - 1):
            assert res.get(r, g) == ordered[r]


def test_rank_filter_is_a_range(spark):
    df = spark.range(1000).withColumn("id", (F.col("id") * 7919) % 1000)
    out = sorted(r["id"] for r in rank_filter(df, "id", 100, 250, local_limit=30, pivots=4).collect())
    assert out == list(range(100, 250))


def test_split_range_disjoint_and_covering(spark):
    df = spark.range(500).withColumnRenamed("id", "key")
    s = {r["key"]: r["split"] for r in split_range(df, "key", 300, 100, local_limit=40, pivots=8).collect()}
    assert len(s) == 500
    assert all(s[k] == ("train" if k < 300 else "eval" if k < 400 else "live") for k in s)


def test_split_range_clamps(spark):
    df = spark.range(10).withColumnRenamed("id", "key")
    s = [r["split"] for r in split_range(df, "key", 50, 20).collect()]
    assert s == ["train"] * 10


def test_split_shuffle_same_for_any_partitioning(spark):
    df = spark.range(400).withColumnRenamed("id", "key")
    a = {r["key"]: r["split"] for r in split_shuffle(df, "key", 0.2, 42).collect()}
    b = {r["key"]: r["split"] for r in split_shuffle(df.repartition(1), "key", 0.2, 42, local_limit=20, pivots=5).collect()}
    assert a == b
    assert sum(v == "test" for v in a.values()) == 80


def test_split_shuffle_no_test_rows_trains_all(spark):
    df = spark.range(3).withColumnRenamed("id", "key")
    assert {r["split"] for r in split_shuffle(df, "key", 0.2).collect()} == {"train"}


def test_split_stratified_exact_per_class(spark):
    df = spark.range(1000).select(F.col("id").alias("key"), (F.col("id") % 10 == 0).cast("int").alias("y"))
    out = split_stratified(df, "key", "y", 0.2, 42, local_limit=30, pivots=4)
    counts = {(r["y"], r["split"]): r["count"] for r in out.groupBy("y", "split").count().collect()}
    assert counts == {(1, "test"): 20, (1, "train"): 80, (0, "test"): 180, (0, "train"): 720}


def test_sample_negatives_keeps_all_positives(spark):
    df = spark.range(1000).select(F.col("id").alias("key"), (F.col("id") % 50 == 0).cast("int").alias("y"))
    out = sample_negatives(df, "key", "y", 100, 42)
    assert out.where("y = 1").count() == 20 and out.where("y = 0").count() == 100


def test_page_deep_page_and_total(spark):
    df = spark.range(1000).withColumnRenamed("id", "key")
    rows, total = page(df, "key", 7, 30, local_limit=50, pivots=4)
    assert total == 1000
    assert [r["key"] for r in rows.collect()] == list(range(180, 210))
    rows, _ = page(df, "key", 0, 30)
    assert [r["key"] for r in rows.collect()] == list(range(30))


def test_select_ranks_heavy_tailed_values(spark):
    rnd = random.Random(11)
    vals = [math.exp(rnd.gauss(0, 10)) * (1 if i % 7 else -1) for i in range(2000)]
    df = spark.createDataFrame([(v,) for v in vals], "v double")
    ordered = sorted(vals)
    ranks = [0, 999, 1000, 1999, 1500]
    res = select_ranks(df, "v", ranks, local_limit=20, pivots=4)
    for r in ranks:
        assert res.get(r)[0] == ordered[r]


def test_select_ranks_on_timestamps(spark):
    import datetime

    base = datetime.datetime(2024, 1, 1)
    rows = [(i, base + datetime.timedelta(seconds=(i * 7919) % 5000)) for i in range(1500)]
    df = spark.createDataFrame(rows, "k long, ts timestamp_ntz")
    ordered = sorted((t, k) for k, t in rows)
    res = select_ranks(df, "ts", [0, 700, 1499], tiebreak="k", local_limit=40, pivots=8)
    for r in (0, 700, 1499):
        assert res.get(r) == ordered[r]
    window = rank_filter(df, "ts", 100, 160, tiebreak="k", local_limit=40, pivots=8)
    assert sorted((r["ts"], r["k"]) for r in window.collect()) == ordered[100:160]


def test_page_without_size_returns_everything(spark):
    df = spark.range(37).withColumnRenamed("id", "key")
    rows, total = page(df, "key", 3, None)
    assert total == 37 and rows.count() == 37
    rows, total = page(df, "key", 99, 10)
    assert total == 37 and rows.count() == 0


def test_select_ranks_on_strings(spark):
    rnd = random.Random(5)
    alphabet = "abcdeéz_1"
    words = ["".join(rnd.choice(alphabet) for _ in range(rnd.randint(1, 9))) for _ in range(2500)]
    words += ["prefix_shared_" + str(i) for i in range(300)]  # same 6-byte prefix: ranked by the window
    df = spark.createDataFrame([(w,) for w in words], "w string")
    ordered = sorted(words)  # code-point order = UTF-8 byte order
    ranks = [0, 100, 1399, 2600, len(words) - 1]
    res = select_ranks(df, "w", ranks, local_limit=30, pivots=8)
    for r in ranks:
        assert res.get(r)[0] == ordered[r]


def test_split_stratified_many_labels_uses_the_join_path(spark):
    df = spark.range(2000).select(F.col("id").alias("key"), (F.col("id") % 100).cast("int").alias("y"))
    out = split_stratified(df, "key", "y", 0.25, 42, local_limit=5, pivots=4)
    counts = {(r["y"], r["split"]): r["count"] for r in out.groupBy("y", "split").count().collect()}
    assert all(counts[(y, "test")] == 5 and counts[(y, "train")] == 15 for y in range(100))
    assert out.columns == ["key", "y", "split"]


@pytest.mark.parametrize("extra", [[], [float("inf"), float("-inf")], [1e300, -1e300, 5e-324]])
def test_infinities_and_outliers_cost_no_further_rounds(spark, extra):
    values = [float(i % 1999) for i in range(5000)] + extra
    df = spark.createDataFrame([(v,) for v in values], "v double")
    group = f"ranks-{len(extra)}-{extra[:1]}"
    spark.sparkContext.setJobGroup(group, group)
    try:
        res = select_ranks(df, "v", [0, 2500, len(values) - 1], local_limit=100)
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert [res.get(r)[0] for r in (0, 2500, len(values) - 1)] == [sorted(values)[r] for r in (0, 2500, len(values) - 1)]
    assert len(spark.sparkContext.statusTracker().getJobIdsForGroup(group)) <= 14


def test_strings_with_a_shared_prefix_narrow(spark):
    values = [f"https://example.org/a/very/long/prefix/doc-{i:06d}" for i in range(5000)]
    df = spark.createDataFrame([(v,) for v in values], "v string").repartition(4)
    ranks = [0, 17, 2500, 4999]
    res = select_ranks(df, "v", ranks, local_limit=100)
    assert [res.get(r)[0] for r in ranks] == [values[r] for r in ranks]


def test_many_ranks_share_one_histogram(spark):
    df = spark.range(20_000).selectExpr("cast(pmod(xxhash64(id), 15000) AS long) AS v")
    values = sorted(r["v"] for r in df.collect())
    ranks = [20 * i for i in range(999)]
    res = select_ranks(df, "v", ranks, local_limit=500)
    assert [res.get(r)[0] for r in ranks] == [values[r] for r in ranks]


def test_inner_jobs_have_no_nested_loop(spark, monkeypatch):
    """Every job that a selection runs by itself, not only the plan that it returns."""
    from pyspark.sql.classic.dataframe import DataFrame

    from stratum.operators.evaluate import evaluate_scores, roc_auc
    from stratum.operators.split import page, split_range, split_shuffle

    plans, collect = [], DataFrame.collect

    def seen(self):
        plans.append(self._jdf.queryExecution().executedPlan().toString())
        return collect(self)

    monkeypatch.setattr(DataFrame, "collect", seen)
    df = spark.range(5000).select("id", (F.col("id") * 37 % 1000 / 10).alias("probability"), (F.col("id") % 2).cast("int").alias("label"), F.concat(F.lit("k"), F.col("id").cast("string")).alias("name"))
    for order in ("id", "name", "probability"):
        select_ranks(df, order, [0, 7, 2500, 4999], tiebreak="id", local_limit=50, pivots=8)
    select_ranks(df, "id", [3, 900], group="label", local_limit=50, pivots=8)
    page(df, "id", 30, 10, local_limit=50)[0].collect()
    split_range(df, "id", 1000, 500, local_limit=50).collect()
    split_shuffle(df, "id", 0.3, local_limit=50).collect()
    roc_auc(df).collect()
    evaluate_scores(df, "label", "probability").collect()
    assert len(plans) > 25
    assert not [p for p in plans if "NestedLoop" in p or "Cartesian" in p]
