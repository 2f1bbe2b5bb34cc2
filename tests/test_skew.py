"""One key holding a third of all rows: results stay whole and exact on every skew path."""

from pyspark.sql import functions as F

from stratum.operators import fitstate as S
from stratum.operators import joins
from stratum.operators import text_models as TM
from stratum.operators.recommend import recommend_topk
from stratum.operators.split import split_stratified


def _skewed(spark, n=3000):
    # key 'hot' on every third row, the rest spread over many keys
    return spark.range(n).select(
        F.col("id").alias("row"),
        F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.concat(F.lit("k"), (F.col("id") % 500).cast("string"))).alias("key"),
    )


def test_token_counts_with_a_hot_token(spark):
    docs = spark.range(600).select(
        F.col("id").alias("doc_id"),
        F.concat(F.lit("the the the word"), (F.col("id") % 7).cast("string")).alias("text"),
        (F.col("id") % 2).cast("int").alias("label"),
    )
    counts = {r["token"]: (r["c0"], r["c1"]) for r in TM.token_counts(docs, "text", "label").collect()}
    assert counts["the"] == (900, 900)


def test_dedup_with_one_text_copied_a_third_of_the_time(spark):
    docs = spark.range(900).select(
        F.col("id").alias("doc_id"),
        F.when(F.col("id") % 3 == 0, F.lit("Same  TEXT")).otherwise(F.concat(F.lit("t"), F.col("id").cast("string"))).alias("text"),
    )
    kept = TM.dedup_text(docs, "doc_id", "text")
    assert kept.count() == 601 and kept.where("doc_id = 0").count() == 1


def test_mode_and_topk_with_a_dominant_group(spark):
    df = _skewed(spark)
    assert S.state_dict(S.fit_mode(df, ["key"]), "feature", "mode") == {"key": "hot"}
    rev = df.select(
        F.when(F.col("key") == "hot", F.lit("c0")).otherwise(F.lit("c1")).alias("condition"),
        F.col("key").alias("drug"), (F.col("row") % 10 + 1).cast("int").alias("rating"), F.lit(0).alias("useful"),
    )
    top = recommend_topk(rev, "condition", "drug", "rating", "useful", k=3)
    assert top.where("condition = 'c0'").count() == 1 and top.where("condition = 'c1'").count() == 3


def test_stratified_split_with_a_third_in_one_class(spark):
    df = _skewed(spark).withColumn("y", (F.col("key") == "hot").cast("int"))
    out = split_stratified(df, "row", "y", 0.2, 42, local_limit=50, pivots=4)
    c = {(r["y"], r["split"]): r["count"] for r in out.groupBy("y", "split").count().collect()}
    assert c == {(1, "test"): 200, (1, "train"): 800, (0, "test"): 400, (0, "train"): 1600}


def test_uniformly_salted_join_without_weights(spark):
    facts = _skewed(spark)
    lookup = facts.groupBy("key").agg(F.count(F.lit(1)).alias("w"))
    plain = sorted(tuple(r) for r in facts.join(lookup, "key").select("key", "row", "w").collect())
    salted = joins.lookup_join(facts, lookup, "key", salt_col="row", salts=16)
    assert sorted(tuple(r) for r in salted.select("key", "row", "w").collect()) == plain
