"""Resumable fitting: halves equal the whole, killed steps, and the quality of the full fit."""

import random

import pytest
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from stratum.operators import evaluate as E
from stratum.operators import models as M
from stratum.operators import online_logistic as O
from stratum.session import scratch_path

X = ["a", "b"]


@pytest.fixture(scope="module")
def rows(spark):
    rnd = random.Random(1)
    data = []
    for i in range(1200):
        a, b = rnd.gauss(0, 1), rnd.gauss(0, 1)
        data.append((i, a, b, int(a - 0.5 * b + rnd.gauss(0, 1) > 1), i * 4 // 1200))
    return spark.createDataFrame([*data, (9998, None, 1.0, 1, 0), (9999, 1.0, 1.0, None, 0)], "id long, a double, b double, y int, r int").cache()


def _same(s, t):
    assert (s.taken, s.step, s.n0, s.n1) == (t.taken, t.step, t.n0, t.n1)
    assert [*s.weights, s.intercept] == pytest.approx([*t.weights, t.intercept], abs=1e-12)


def test_two_runs_over_halves_equal_one_run(spark, rows):
    one = O.fit(spark, scratch_path(spark, "ol"), rows, "r", [0, 1, 2, 3], "y", X, epochs=2)
    path = scratch_path(spark, "ol")
    O.fit(spark, path, rows, "r", [0, 1], "y", X)
    O.fit(spark, path, rows, "r", [0, 1, 2, 3], "y", X)  # the first two were taken
    _same(O.fit(spark, path, rows, "r", [0, 1, 2, 3], "y", X, epochs=2), one)
    _same(O.load(spark, path), one)
    assert one.step == 8 and one.n0 + one.n1 == 2400


def test_a_killed_step_is_taken_again(spark, rows):
    path = scratch_path(spark, "ol")
    O.fit(spark, path, rows, "r", [0, 1], "y", X)
    spark.range(1).write.parquet(f"{path}/v3")
    place = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/v3/_SUCCESS")
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, False)  # as a killed job leaves it
    assert O.load(spark, path).taken == ["0/0", "0/1"]
    _same(O.fit(spark, path, rows, "r", [0, 1, 2], "y", X), O.fit(spark, scratch_path(spark, "ol"), rows, "r", [0, 1, 2], "y", X))


def test_quality_is_that_of_the_full_fit(spark, rows):
    state = O.fit(spark, scratch_path(spark, "ol"), rows, "r", [0, 1, 2, 3], "y", X, epochs=6, rate=2.0)
    known = rows.where("y IS NOT NULL AND a IS NOT NULL")
    mine = E.roc_auc(O.score(state, known), "y", "probability").first()[0]
    vectors = VectorAssembler(inputCols=X, outputCol="features").transform(known)
    full = M.vector_to_array(F.col("probability"))[1]
    scored = LogisticRegression(labelCol="y").fit(vectors).transform(vectors).select("y", full.alias("p"))
    assert mine > E.roc_auc(scored, "y", "p").first()[0] - 0.01 and mine > 0.8


def test_empty_ranges_one_class_and_other_features(spark, rows):
    path = scratch_path(spark, "ol")
    s = O.take(spark, path, "none", rows.where("id < 0"), "y", X)
    assert s.step == 0 and s.weights == [0.0, 0.0] and s.taken == ["none"]
    s = O.take(spark, path, "positives", rows.where("y = 1"), "y", X)
    assert s.step == 1 and s.n0 == 0 and s.intercept > 0
    with pytest.raises(ValueError):
        O.load(spark, path, ["a"])
    with pytest.raises(ValueError):
        O.load(spark, scratch_path(spark, "nothing"))
