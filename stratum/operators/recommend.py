"""Ranking items within a group from their reviews."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def recommend_topk(
    df: DataFrame, group: str, item: str, rating: str, useful: str, k: int = 5, positive_at: int = 7
) -> DataFrame:
    """Top-k items per group by usefulness-weighted mean rating.

    ``score = sum(rating * (1 + useful)) / sum(1 + useful)``; ties by item name.
    One aggregate per (group, item) with partial aggregation, then a window
    over the aggregated rows of each group (one row per item, not per review).
    """
    w1 = F.lit(1) + F.coalesce(F.col(useful), F.lit(0))
    agg = df.where(F.col(rating).isNotNull()).groupBy(group, item).agg(
        (F.sum(F.col(rating) * w1) / F.sum(w1)).cast("double").alias("score"),
        F.avg((F.col(rating) >= positive_at).cast("double")).alias("positive_rate"),
        F.count(F.lit(1)).alias("n_reviews"),
    )
    w = Window.partitionBy(group).orderBy(F.col("score").desc(), F.col(item))
    return agg.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)


def recommend_shrunk(df: DataFrame, group: str, item: str, rating: str, k: int = 5) -> DataFrame:
    """Top-k items per group by mean rating shrunk towards the group's, so that few reviews prove little.

    An empirical-Bayes prior of each group by moments: ``within`` is the pooled variance of ratings inside items,
    ``between`` the variance of items' true means (never below 0), and an item of n reviews has

        score = (n * between * mean + within * group mean) / (n * between + within)

    (the group mean where both variances are 0).  Scores that agree to nine digits are ties, by item name; rows without a rating are left out.  One
    combined aggregate of (n, sum, sum of squares) per (group, item); all else runs on those rows.
    """
    x = F.col(rating).cast("double")
    each = df.where(F.col(rating).isNotNull()).groupBy(group, item).agg(F.count(F.lit(1)).alias("n"), F.sum(x).alias("sum"), F.sum(x * x).alias("squares"))
    prior = each.groupBy(F.col(group).alias("_group")).agg(
        F.count(F.lit(1)).alias("items"),
        F.sum("n").cast("double").alias("total"),
        F.sum("sum").alias("all"),
        F.sum(F.col("squares") - F.col("sum") * F.col("sum") / F.col("n")).alias("inside"),
        F.sum(F.col("sum") * F.col("sum") / F.col("n")).alias("spread"),
        F.sum(F.col("n") * F.col("n")).cast("double").alias("n2"),
    )
    mean = F.col("all") / F.col("total")
    within = F.coalesce(F.try_divide(F.greatest("inside", F.lit(0.0)), F.col("total") - F.col("items")), F.lit(0.0))
    apart = F.col("spread") - F.col("total") * mean * mean - (F.col("items") - 1) * F.col("within")
    between = F.coalesce(F.try_divide(F.greatest(apart, F.lit(0.0)), F.col("total") - F.col("n2") / F.col("total")), F.lit(0.0))
    prior = prior.withColumn("within", within).withColumn("between", between).withColumn("group_mean", mean)
    joined = each.join(prior.select("_group", "within", "between", "group_mean"), F.col(group).eqNullSafe(F.col("_group")))
    top = F.col("between") * F.col("sum") + F.col("within") * F.col("group_mean")
    score = F.coalesce(F.try_divide(top, F.col("n") * F.col("between") + F.col("within")), F.col("group_mean"))
    out = joined.select(group, item, F.col("n").alias("n_reviews"), (F.col("sum") / F.col("n")).alias("mean_rating"), "group_mean", score.alias("score"))
    w = Window.partitionBy(group).orderBy(F.round("score", 9).desc(), F.col(item))
    return out.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)
