"""Balanced bootstraps: weight tables by hand, the Poisson law, a forest on a rare class."""

import hashlib
import math
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from stratum.operators import bootstrap as B
from stratum.operators import evaluate as E


def _draws(key, tree, seed=42):
    u = int(hashlib.md5(f"{seed}:{tree}:{key}".encode()).hexdigest()[:13], 16)
    total, k = 0.0, 0
    while True:
        total += 1 / math.factorial(k)
        if u < int(math.exp(-1) * total * 2**52) or k == 12:
            return k
        k += 1


def test_weights_equal_a_table_by_hand(spark):
    rows = [(i, [0, 0, 0, 1, None][i % 5]) for i in range(300)]
    df = spark.createDataFrame(rows, "id long, y int").repartition(4)
    for tree in (0, 7):
        want = {i: (_draws(i, tree), y) for i, y in rows if y is not None and _draws(i, tree)}
        n = Counter()
        for d, y in want.values():
            n[y] += d
        got = {r["id"]: (r["draws"], r["weight"]) for r in B.sample_weights(df, "id", "y", tree).collect()}
        assert got.keys() == want.keys()
        for i, (d, y) in want.items():
            assert got[i] == (d, pytest.approx(d * (n[0] + n[1]) / (2 * n[y])))
        assert sum(w for i, (_, w) in got.items() if want[i][1] == 1) == pytest.approx(sum(w for i, (_, w) in got.items() if want[i][1] == 0))


def test_draws_follow_the_poisson_law(spark):
    got = spark.range(40_000).select(B.draws("id", 3).alias("d")).groupBy("d").count().collect()
    for r in got:
        if r["d"] < 4:
            assert r["count"] / 40_000 == pytest.approx(math.exp(-1) / math.factorial(r["d"]), rel=0.08)


def test_one_class_and_empty_samples(spark):
    ones = B.sample_weights(spark.range(50).select("id", F.lit(1).alias("y")), "id", "y", 0).collect()
    assert ones and all(r["weight"] == r["draws"] for r in ones)
    assert B.sample_weights(spark.range(0).select("id", F.lit(1).alias("y")), "id", "y", 0).collect() == []


def test_a_balanced_forest_finds_a_rare_class(spark):
    rnd = random.Random(3)
    rows = [(i, rnd.gauss(0, 1), rnd.gauss(0, 1)) for i in range(1500)]
    df = spark.createDataFrame([(i, a, b, int(a + b > 2.6)) for i, a, b in rows] + [(9999, None, 1.0, 1)], "id long, a double, b double, y int")
    forest = B.fit_balanced_forest(df, "id", "y", ["a", "b"], trees=5, max_depth=5)
    scored = forest.score(df.dropna())
    assert scored.columns == ["id", "a", "b", "y", "probability", "prediction"]
    assert E.roc_auc(scored, "y", "probability").first()[0] > 0.97
    assert E.binary_metrics(scored, "y").first()["recall"] > 0.9
