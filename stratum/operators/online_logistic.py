"""Logistic regression over ranges that arrive one after another, resumable between any two.

The reference fits chunk by chunk.  Here a chunk is a range of the table (a DataFrame of any size): one
aggregate gives the range's class counts, a second the gradient at the present weights, and one step is
taken.  The optimiser's state (weights, intercept, step number, class counts so far, names of the steps
taken) is a version in the shared folder, written after every range.  A run that is killed takes up
the last complete version; a step that is in the state already is passed over.  So running half of the ranges in one
job and the rest in another gives the same model as one job.

Loss: log loss weighted by classes as balanced by the counts seen so far, plus ``l2 / 2`` times the
squared weights.  The step size of step t is ``rate / (1 + decay * t)``.  Features should be scaled
(``fitstate.apply_scale``) and free of NULLs; rows with a NULL feature or label are left out.  A range
without rows takes no step, but counts as taken; a step before both classes were seen uses weight 1.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stratum.functions.clean import q
from stratum.sources.versions import complete

_SCHEMA = "features array<string>, weights array<double>, intercept double, step long, n0 long, n1 long, taken array<string>"


@dataclass
class State:
    features: list[str]
    weights: list[float]
    intercept: float = 0.0
    step: int = 0
    n0: int = 0
    n1: int = 0
    taken: list[str] = field(default_factory=list)


def load(spark: SparkSession, path: str, features: list[str] | None = None) -> State:
    """The last complete state below ``path``; zeros for ``features`` if there is none."""
    done = complete(spark, path)
    if not done:
        if features is None:
            raise ValueError(f"{path} holds no state")
        return State(list(features), [0.0] * len(features))
    row = spark.read.schema(_SCHEMA).parquet(f"{path}/v{done[-1]}").first()
    if features is not None and row["features"] != list(features):
        raise ValueError(f"the state has other features: {row['features']}")
    return State(**row.asDict())


def margin(state: State) -> Column:
    """The decision value of a row: intercept plus weighted features."""
    out = F.lit(state.intercept)
    for name, w in zip(state.features, state.weights):
        out = out + q(name).cast("double") * F.lit(w)
    return out


def take(spark: SparkSession, path: str, name: str, rows: DataFrame, label: str, features: list[str], rate: float = 1.0, decay: float = 0.05, l2: float = 1e-4) -> State:
    """One step over a range, under a name that makes it count once; writes and returns the new state."""
    state = load(spark, path, features)
    if name in state.taken:
        return state
    y = F.col(label)
    held = rows.where(y.isin(0, 1)).dropna(subset=list(features))
    counts = held.agg(F.count_if(y == 0).alias("n0"), F.count_if(y == 1).alias("n1")).first()
    n0, n1 = state.n0 + counts["n0"], state.n1 + counts["n1"]
    new = State(state.features, state.weights, state.intercept, state.step, n0, n1, [*state.taken, name])
    if counts["n0"] + counts["n1"]:
        both = n0 > 0 and n1 > 0
        w0, w1 = ((n0 + n1) / (2 * n0), (n0 + n1) / (2 * n1)) if both else (1.0, 1.0)
        w = F.when(y == 1, F.lit(w1)).otherwise(F.lit(w0))
        off = w * (F.lit(1.0) / (F.lit(1.0) + F.exp(-margin(state))) - y)
        sums = held.agg(F.sum(w).alias("w"), F.sum(off).alias("b"), *(F.sum(off * q(f).cast("double")).alias(f"g{i}") for i, f in enumerate(features))).first()
        pace = rate / (1 + decay * state.step)
        new.weights = [x - pace * (sums[f"g{i}"] / sums["w"] + l2 * x) for i, x in enumerate(state.weights)]
        new.intercept = state.intercept - pace * sums["b"] / sums["w"]
        new.step = state.step + 1
    row = (new.features, new.weights, new.intercept, new.step, new.n0, new.n1, new.taken)
    spark.createDataFrame([row], _SCHEMA).write.mode("overwrite").parquet(f"{path}/v{len(new.taken)}")
    return new


def fit(spark: SparkSession, path: str, df: DataFrame, range_col: str, ranges: list[int], label: str, features: list[str], epochs: int = 1, **steps) -> State:
    """All steps over ``ranges`` (values of ``range_col``), ``epochs`` times over; steps that were taken are not taken again."""
    state = load(spark, path, features)
    for epoch in range(epochs):
        for r in ranges:
            state = take(spark, path, f"{epoch}/{r}", df.where(F.col(range_col) == r), label, features, **steps)
    return state


def score(state: State, df: DataFrame) -> DataFrame:
    """``df`` with ``decision`` and ``probability``."""
    return df.withColumn("decision", margin(state)).withColumn("probability", F.lit(1.0) / (F.lit(1.0) + F.exp(-F.col("decision"))))
