"""News text classification: clean -> seeded split -> Naive Bayes -> metrics.

Shuffles: the token count (fit), the (doc, token) count and the per-document
sum (score), plus the tiny metric aggregate.  The term table is joined by
broadcast when a count proves it small, else by a salted shuffle join.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratum.functions.clean import drop_nulls, filter_in_set, label_normalize, lower_columns
from stratum.operators.evaluate import binary_metrics
from stratum.operators.split import split_shuffle
from stratum.operators.text_models import NBModel, nb_fit, nb_score
from stratum.session import cut_lineage
from stratum.sources import fixtures


def clean_news(raw: DataFrame) -> DataFrame:
    """Lower-case names, drop the index column, normalise labels, drop incomplete rows."""
    df = lower_columns(raw)
    df = df.withColumn("label", label_normalize(F.col("label")))
    df = drop_nulls(df, ["text", "label"])
    df = filter_in_set(df, "label", [0, 1])
    return df.select("doc_id", "text", "label")


def news_split(spark: SparkSession, sf_dir: str, test_size: float = 0.2, seed: int = 42) -> DataFrame:
    # the cleaned corpus feeds the split boundaries, the fit and the scoring: materialise it once
    clean = cut_lineage(clean_news(fixtures.news_raw(spark, sf_dir)))
    return split_shuffle(clean, "doc_id", test_size, seed)


def news_fit_score(
    spark: SparkSession, sf_dir: str, test_size: float = 0.2, seed: int = 42
) -> tuple[NBModel, DataFrame]:
    """Fit on the train part, score the test part; returns the model and scored test rows."""
    split = news_split(spark, sf_dir, test_size, seed)
    train = split.where(F.col("split") == "train")
    test = split.where(F.col("split") == "test")
    model = nb_fit(train, "text", "label")
    scored = nb_score(model, test, "doc_id", "text", keep=("label",))
    return model, scored


def news_eval(spark: SparkSession, sf_dir: str, test_size: float = 0.2, seed: int = 42) -> DataFrame:
    """Accuracy, precision, recall, F1 and confusion counts of NB on the held-out documents."""
    _, scored = news_fit_score(spark, sf_dir, test_size, seed)
    return binary_metrics(scored, "label", "prediction")
