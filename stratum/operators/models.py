"""Model fitting and scoring on ``pyspark.ml``, plus fixed-coefficient scoring.

Estimators run distributed (gradient sums via tree aggregation, distributed
tree induction); the training frame is persisted around the iterative fit and
released after.  Parameter mapping from the reference's scikit-learn models:

* SGD logistic, L2 alpha      -> ``LogisticRegression(regParam=alpha, elasticNetParam=0)``
* lbfgs logistic, C           -> ``regParam = 1 / (C * sum of sample weights)``
* balanced class weights      -> a ``weight`` column (``fitstate.fit_class_weights``)
* random forest               -> ``RandomForestClassifier`` (unlimited depth is not available:
  30 levels, Spark's limit, by default; growth ends earlier where nodes are pure)
* histogram gradient boosting -> ``GBTClassifier(maxDepth=6, stepSize=0.1, maxIter=100, maxBins=255)``
  with a validation column for early stopping where the caller gives one
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark import StorageLevel
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier, LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stratum.functions.clean import q

FEATURES = "features"

#: Rows of a training frame, and characters of its texts, that one task holds; more are dealt out anew.
TASK_ROWS = 500_000
TASK_CHARS = 32 << 20
#: The same for boosted trees, whose tasks read the cached predictions of several iterations for each row.
BOOSTED_ROWS = 100_000
#: Rows of a forest's training frame from which another task takes part, up to the session's parallelism: each row is walked
#: through every tree at every level, while a task's statistics (which grow with tasks) are small beside it.
FOREST_ROWS = 10_000


def assembler(cols: Iterable[str], out: str = FEATURES) -> VectorAssembler:
    return VectorAssembler(inputCols=list(cols), outputCol=out, handleInvalid="keep")


def logistic(label: str, weight: str | None = None, reg: float = 1e-4, max_iter: int = 2000, tol: float = 1e-3):
    lr = LogisticRegression(
        featuresCol=FEATURES,
        labelCol=label,
        regParam=reg,
        elasticNetParam=0.0,
        maxIter=max_iter,
        tol=tol,
        standardization=False,
    )
    if weight:
        lr.setWeightCol(weight)
    return lr


def forest(label: str, weight: str | None = None, trees: int = 200, depth: int = 30, seed: int = 42):
    # More nodes per pass over the data, and node ids cached (checkpointed to the shared
    # folder every 10 levels) instead of re-walking every tree for each row.
    rf = RandomForestClassifier(
        featuresCol=FEATURES, labelCol=label, numTrees=trees, maxDepth=depth, seed=seed, maxBins=64,
        maxMemoryInMB=1024, cacheNodeIds=True, checkpointInterval=10,
    )
    if weight:
        rf.setWeightCol(weight)
    return rf


def boosted(label: str, weight: str | None = None, validation: str | None = None, seed: int = 42, max_iter: int = 100):
    gbt = GBTClassifier(
        featuresCol=FEATURES, labelCol=label, maxDepth=6, stepSize=0.1, maxIter=max_iter, maxBins=255, seed=seed
    )
    if weight:
        gbt.setWeightCol(weight)
    if validation:
        gbt.setValidationIndicatorCol(validation)
    return gbt


def spread(df: DataFrame, total: int, per_task: int) -> DataFrame:
    """``df`` dealt out round robin to tasks of about ``per_task`` of a ``total`` (rows, characters); as it is where one task holds all."""
    parts = -(-total // per_task)
    return df.repartition(max(parts, df.sparkSession.sparkContext.defaultParallelism)) if parts > 1 else df


def fit(stages: list, train: DataFrame) -> PipelineModel:
    """Fit a pipeline with the training frame persisted (memory, spilling to disk) for the iterations.

    Files that the frame was read from may be few and large: it is spread, so that a task's share does not grow with them."""
    total = train.count()
    if any(isinstance(s, RandomForestClassifier) for s in stages):
        tasks = max(-(-total // TASK_ROWS), min(train.sparkSession.sparkContext.defaultParallelism, -(-total // FOREST_ROWS)))
        train = train.repartition(tasks) if tasks > 1 else train
    else:
        train = spread(train, total, BOOSTED_ROWS if any(isinstance(s, GBTClassifier) for s in stages) else TASK_ROWS)
    train = train.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        return Pipeline(stages=stages).fit(train)
    finally:
        train.unpersist()


def prob1(col: str = "probability") -> Column:
    """Probability of class 1 from the model's probability vector."""
    return vector_to_array(F.col(col)).getItem(1)


def score(model: PipelineModel, df: DataFrame, keep: Iterable[str] = (), threshold: float | None = None) -> DataFrame:
    """``keep`` columns + ``prediction`` (int) + ``probability`` of class 1.

    With ``threshold`` the prediction is ``probability >= threshold`` (the
    loan/fraud rule); otherwise the model's own class.  Models without class
    probabilities fall back to the sigmoid of the decision margin, then to the
    hard label.
    """
    out = model.transform(df)
    if "probability" in out.columns:
        p = prob1()
    elif "rawPrediction" in out.columns:  # decision score only: its sigmoid
        raw = vector_to_array(F.col("rawPrediction"))
        p = F.lit(1.0) / (F.lit(1.0) + F.exp(-(F.element_at(raw, -1) - F.element_at(raw, 1))))
    else:  # hard label only
        p = F.col("prediction").cast("double")
    pred = (p >= F.lit(threshold)).cast("int") if threshold is not None else F.col("prediction").cast("int")
    return out.select(*[q(c) for c in keep], pred.alias("prediction"), p.alias("probability"))


def coefficient_table(model: PipelineModel, features: list[str], spark) -> tuple[DataFrame, float]:
    """``(feature, coefficient)`` of the pipeline's logistic model, and its intercept."""
    lr = model.stages[-1]
    coefs = lr.coefficients.toArray().tolist()
    return spark.createDataFrame(list(zip(features, coefs)), "feature string, coefficient double"), float(lr.intercept)


def importance_table(model: PipelineModel, features: list[str], spark) -> DataFrame:
    """``(feature, importance)``: tree importances, or |coefficient| for a linear model."""
    m = model.stages[-1]
    if hasattr(m, "featureImportances"):
        vals = m.featureImportances.toArray().tolist()
    else:
        vals = [abs(v) for v in m.coefficients.toArray().tolist()]
    return spark.createDataFrame(list(zip(features, [float(v) for v in vals])), "feature string, importance double")


def score_linear(df: DataFrame, coefficients: Mapping[str, float], intercept: float, keep: Iterable[str] = ()) -> DataFrame:
    """``probability = 1 / (1 + exp(-(b + sum w_i x_i)))`` from a fixed coefficient table (NULL x counts 0)."""
    z = F.lit(float(intercept))
    for c, w in coefficients.items():
        z = z + F.coalesce(q(c).cast("double"), F.lit(0.0)) * F.lit(float(w))
    p = F.lit(1.0) / (F.lit(1.0) + F.exp(-z))
    return df.select(*[q(c) for c in keep], z.alias("decision"), p.alias("probability"))


def rank_features(importances: DataFrame, top_k: int = 40) -> DataFrame:
    """Top-k ``(feature, importance)`` by importance (ties by feature name), with rank and
    the ratio to the largest importance.  One row per feature in the input: a bounded table.
    """
    top = importances.orderBy(F.col("importance").desc(), F.col("feature")).limit(top_k)
    w = Window.orderBy(F.col("importance").desc(), F.col("feature"))  # over <= top_k rows
    mx = F.max("importance").over(Window.partitionBy())  # the largest one is in the top-k
    return top.select(
        F.row_number().over(w).alias("rank"),
        "feature",
        "importance",
        F.coalesce(F.try_divide(F.col("importance"), mx), F.lit(0.0)).alias("ratio"),
    )
