"""Naive Bayes counts that take in arriving documents and give up forgotten ones.

A state is a folder of versions.  A version holds the count tables that ``nb_fit`` computes (``terms``: token, c0, c1;
``docs``: label, n_docs) and the names of the batches that are in it.  ``update`` adds the counts of one
batch and takes those of another out: one aggregate over the old table and the batch's signed
counts, so the corpus itself is never read again.  Tokens whose counts fall to zero leave the
vocabulary, therefore vocabulary size, totals and priors equal those of a fit on the documents that
are in force.  A batch that is applied already is passed over, so a job that is run again after a failure
changes nothing; a version counts only when its last table is committed.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratum.operators.text_models import NBModel, token_counts
from stratum.sources.versions import complete

_TERMS = "token string, c0 long, c1 long"
_DOCS = "label int, n_docs long"


def _read(spark: SparkSession, path: str, version: int, table: str, schema: str) -> DataFrame:
    if version == 0:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(f"{path}/v{version}/{table}")


def _signed(df: DataFrame | None, sign: int, text: str, label: str) -> tuple[DataFrame, DataFrame] | None:
    if df is None:
        return None
    known = df.where(F.col(label).isin(0, 1))
    terms = token_counts(known, text, label).select("token", (F.col("c0") * sign).alias("c0"), (F.col("c1") * sign).alias("c1"))
    docs = known.groupBy(F.col(label).cast("int").alias("label")).agg((F.count(F.lit(1)) * sign).alias("n_docs"))
    return terms, docs


def update(spark: SparkSession, path: str, batch: str, add: DataFrame | None = None, forget: DataFrame | None = None, text: str = "text", label: str = "label") -> int:
    """Apply one named batch to the state at ``path`` (an empty state if there is none); returns the version in force.

    Forgetting documents that were never added is an error, and leaves the state as it was."""
    done = complete(spark, path, "batches")
    version = done[-1] if done else 0
    batches = _read(spark, path, version, "batches", "batch string")
    if not batches.where(F.col("batch") == batch).isEmpty():
        return version
    terms, docs = _read(spark, path, version, "terms", _TERMS), _read(spark, path, version, "docs", _DOCS)
    for part in (_signed(add, 1, text, label), _signed(forget, -1, text, label)):
        if part:
            terms, docs = terms.unionByName(part[0]), docs.unionByName(part[1])
    new = f"{path}/v{version + 1}"
    terms = terms.groupBy("token").agg(F.sum("c0").alias("c0"), F.sum("c1").alias("c1")).where("c0 <> 0 OR c1 <> 0")
    docs = docs.groupBy("label").agg(F.sum("n_docs").alias("n_docs")).where("n_docs <> 0")
    terms.write.mode("overwrite").parquet(f"{new}/terms")
    docs.write.mode("overwrite").parquet(f"{new}/docs")
    written = _read(spark, path, version + 1, "terms", _TERMS), _read(spark, path, version + 1, "docs", _DOCS)
    if not written[0].where("c0 < 0 OR c1 < 0").isEmpty() or not written[1].where("n_docs < 0").isEmpty():
        raise ValueError(f"batch {batch!r} forgets documents that the state does not hold")
    batches.unionByName(spark.createDataFrame([(batch,)], "batch string")).write.mode("overwrite").parquet(f"{new}/batches")
    return version + 1


def model(spark: SparkSession, path: str, version: int | None = None) -> NBModel:
    """The model of a state's version (the last complete one), as ``nb_fit`` gives it."""
    done = complete(spark, path, "batches")
    if not done or version is not None and version not in done:
        raise ValueError(f"{path} holds no such version")
    version = done[-1] if version is None else version
    terms = _read(spark, path, version, "terms", _TERMS)
    totals = terms.agg(F.count(F.lit(1)).alias("v"), F.coalesce(F.sum("c0"), F.lit(0)).alias("t0"), F.coalesce(F.sum("c1"), F.lit(0)).alias("t1")).first()
    docs = _read(spark, path, version, "docs", _DOCS).collect()  # at most two classes
    n, k, words = sum(r["n_docs"] for r in docs), len(docs), {0: totals["t0"], 1: totals["t1"]}
    rows = []
    for r in docs:
        c = r["label"]
        prior = (r["n_docs"] + 1) / (n + k)
        rows.append((c, r["n_docs"], words[c], prior, math.log(prior), math.log(words[c] + totals["v"]) if words[c] + totals["v"] else 0.0))
    classes = spark.createDataFrame(rows, "label int, n_docs long, total_words long, prior double, log_prior double, log_denom double")
    return NBModel(terms=terms, classes=classes, vocab_size=totals["v"])
