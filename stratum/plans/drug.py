"""Review sentiment: rating -> label, stratified split, TF-IDF (1-2-grams, top terms) -> logistic model.

The vocabulary is the ``max_features`` most frequent terms from the term-only
document-frequency aggregate; ``CountVectorizerModel`` (built from it) counts
terms in the JVM, an element-wise product applies the smoothed IDF
``ln((1+n)/(1+df)) + 1`` of the reference, and ``Normalizer`` the L2 norm: the
same weights as the oracle-checked ``tfidf`` operator.
"""

from __future__ import annotations

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import CountVectorizerModel, ElementwiseProduct, Normalizer
from pyspark.ml.linalg import DenseVector
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratum.functions import clean as C
from stratum.functions import text as X
from stratum.operators import evaluate as E
from stratum.operators import models as M
from stratum.operators import text_models as TM
from stratum.operators.split import split_stratified
from stratum.sources import fixtures

KEY = "uniqueID"
TARGET = "sentiment"


def review_frame(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = fixtures.reviews(spark, sf_dir)
    r = C.drop_nulls(r, ["review"]).withColumn(TARGET, C.label_from_rating(F.col("rating"))).where(F.col(TARGET) != -1)
    r = r.select(KEY, TARGET, "review")
    chars = r.agg(F.coalesce(F.sum(F.length("review")), F.lit(0))).first()[0]
    sp = M.spread(split_stratified(r, KEY, TARGET, 0.2, 42), chars, M.TASK_CHARS)  # a text's terms take more room than the text
    toks = sp.select(KEY, TARGET, X.tokenize(F.col("review"), X.WORD2).alias("toks"), "split")
    return toks.select(KEY, TARGET, X.ngrams(F.col("toks"), 2).alias("terms"), "split")


def fit_text_model(train: DataFrame, max_features: int = 50_000, C_: float = 1.0) -> PipelineModel:
    """Vocabulary and smoothed IDF from one term-only aggregate, then an L2-normalised TF-IDF logistic model.

    The vocabulary (at most ``max_features`` terms with their document
    counts) is the only thing collected; ``CountVectorizerModel`` is built
    from it, so there is no separate vectoriser or IDF fitting pass.  Terms
    are made anew in each of the few passes, never cached: a batch of Spark's
    columnar cache holds 10,000 rows however long they are.  What the
    iterations read is cached by the estimator, in blocks of bounded size.
    """
    n = train.count()
    top = TM.top_terms(TM.term_frequencies(train, "terms"), max_features)
    vocab = top.select("token", TM.smooth_idf(n).alias("idf")).collect()  # <= max_features rows
    cv = CountVectorizerModel.from_vocabulary([r["token"] for r in vocab], inputCol="terms", outputCol="tf")
    ep = ElementwiseProduct(scalingVec=DenseVector([r["idf"] for r in vocab]), inputCol="tf", outputCol="tfidf")
    norm = Normalizer(inputCol="tfidf", outputCol=M.FEATURES, p=2.0)
    lr = M.logistic(TARGET, None, reg=1.0 / (C_ * max(n, 1)), max_iter=1000, tol=1e-4)
    return Pipeline(stages=[cv, ep, norm, lr]).fit(train)


def drug_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    sp = review_frame(spark, sf_dir)
    model = fit_text_model(sp.where(F.col("split") == "train"))
    te = M.score(model, sp.where(F.col("split") == "test"), keep=[KEY, TARGET])
    return E.classification_report(E.confusion_matrix(te, TARGET, "prediction"))
