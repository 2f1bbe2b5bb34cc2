"""Forests whose trees balance their own bootstrap: weights as data, one tree a sample.

A bootstrap of n rows draws each row Poisson(1) times as n grows; here the number of draws is that
distribution's value at a seeded hash of (tree, key), so a sample depends neither on partitioning nor
on a lost executor.  Each class of a tree's sample gets the weight ``drawn / (2 * drawn of the class)``, so
every tree sees balanced classes however rare one is in its own sample; with global weights rare classes are
balanced on average only.  A class that a sample lacks leaves the others at weight 1.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.ml.classification import DecisionTreeClassifier
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratum.operators.models import FEATURES, assembler
from stratum.operators.split import hash_order

#: Upper ends of the hash ranges of 0, 1, 2, … draws: the Poisson(1) distribution function in 52 bits.
DRAWS = tuple(int(math.exp(-1) * sum(1 / math.factorial(i) for i in range(k + 1)) * 2**52) for k in range(12))


def draws(key: str, tree: int, seed: int = 42) -> Column:
    """How often a row is drawn into a tree's sample."""
    h = hash_order(key, f"{seed}:{tree}")
    out = F.lit(len(DRAWS))
    for k in reversed(range(len(DRAWS))):
        out = F.when(h < F.lit(DRAWS[k]), F.lit(k)).otherwise(out)
    return out


def sample_weights(df: DataFrame, key: str, label: str, tree: int, seed: int = 42) -> DataFrame:
    """The rows of a tree's sample with ``draws`` and ``weight``; rows without a 0/1 label are left out.

    One aggregate of two sums; the weights are literals, so no row is shuffled."""
    rows = df.where(F.col(label).isin(0, 1)).withColumn("draws", draws(key, tree, seed)).where("draws > 0")
    n0, n1 = rows.agg(F.coalesce(F.sum(F.when(F.col(label) == 0, F.col("draws"))), F.lit(0)), F.coalesce(F.sum(F.when(F.col(label) == 1, F.col("draws"))), F.lit(0))).first()
    both = n0 > 0 and n1 > 0
    of = F.when(F.col(label) == 1, F.lit((n0 + n1) / (2 * n1) if both else 1.0)).otherwise(F.lit((n0 + n1) / (2 * n0) if both else 1.0))
    return rows.withColumn("weight", F.col("draws") * of)


@dataclass
class BalancedForest:
    """Trees fitted one after another; ``score`` averages their probabilities."""

    features: list[str]
    trees: list

    def score(self, df: DataFrame) -> DataFrame:
        """``df`` with ``probability`` (mean over the trees) and ``prediction`` (above one half)."""
        out = assembler(self.features).transform(df)
        for i, tree in enumerate(self.trees):
            got = tree.copy({tree.probabilityCol: f"_p{i}", tree.rawPredictionCol: f"_r{i}", tree.predictionCol: f"_d{i}"}).transform(out)
            out = got.withColumn(f"_p{i}", vector_to_array(f"_p{i}")[1]).drop(f"_r{i}", f"_d{i}")
        ps = [F.col(f"_p{i}") for i in range(len(self.trees))]
        mean = sum(ps[1:], ps[0]) / len(ps)
        return out.withColumn("probability", mean).withColumn("prediction", (mean > 0.5).cast("int")).drop(FEATURES, *(f"_p{i}" for i in range(len(ps))))


def fit_balanced_forest(df: DataFrame, key: str, label: str, features: list[str], trees: int = 200, max_depth: int = 30, seed: int = 42) -> BalancedForest:
    """Fit ``trees`` trees, each on its own balanced bootstrap of the rows without NULL features.

    A tree is a distributed job (binned splits, one pass a level); the assembled frame is kept in memory and on disk meanwhile."""
    held = assembler(features).transform(df.dropna(subset=features)).select(key, F.col(label).cast("double").alias(label), FEATURES).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        fitted = []
        for t in range(trees):
            grown = DecisionTreeClassifier(featuresCol=FEATURES, labelCol=label, weightCol="weight", maxDepth=max_depth, seed=seed + t)
            fitted.append(grown.fit(sample_weights(held, key, label, t, seed)))
        return BalancedForest(list(features), fitted)
    finally:
        held.unpersist()
