"""Structured Streaming: score arriving rows, keep running confusion counts.

The reference polls a table in offset chunks; here new Parquet files are a
file-stream source, the transform is the very same Column functions as the
batch path, and progress lives in a checkpoint under the shared folder, so a
restarted query resumes exactly where it stopped.  ``trigger(availableNow=True)``
processes everything present and stops (batch-like runs); a long-running
deployment uses a processing-time trigger instead.

Scoring is stateless (no watermark needed).  Evaluation is a streaming aggregation by
(label, prediction) in complete mode: four counters in the state store, checkpointed with the
offsets, and every micro-batch replaces the published totals.  Evaluation by event-time window
(``stream_windows``) closes each window once, by the watermark.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stratum.session import scratch_path


def file_stream(spark: SparkSession, folder: str, schema: T.StructType, glob: str | None = None,
                files_per_trigger: int | None = None) -> DataFrame:
    """Parquet files arriving in ``folder`` (optionally only names matching ``glob``)."""
    r = spark.readStream.schema(schema)
    if glob:
        r = r.option("pathGlobFilter", glob)
    if files_per_trigger:
        r = r.option("maxFilesPerTrigger", files_per_trigger)
    return r.parquet(folder)


def stream_score(
    source: DataFrame,
    transform: Callable[[DataFrame], DataFrame],
    out_path: str,
    checkpoint: str,
    available_now: bool = True,
):
    """Append ``transform(source)`` to Parquet at ``out_path``; returns the started query."""
    w = transform(source).writeStream.format("parquet").option("checkpointLocation", checkpoint).outputMode("append")
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="30 seconds")
    return w.start(out_path)


def stream_eval(
    source: DataFrame,
    out_path: str,
    checkpoint: str,
    label: str = "label",
    pred: str = "prediction",
    available_now: bool = True,
):
    """Running totals per (label, prediction) in the state store; each epoch replaces the table at ``out_path``."""
    counts = source.groupBy(F.col(label).alias("label"), F.col(pred).alias("prediction")).count()

    def publish(totals: DataFrame, _epoch: int) -> None:
        totals.coalesce(1).write.mode("overwrite").parquet(out_path)  # at most one row per cell

    w = counts.writeStream.option("checkpointLocation", checkpoint).outputMode("complete").foreachBatch(publish)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="30 seconds")
    return w.start()


def stream_windows(
    source: DataFrame,
    out_path: str,
    checkpoint: str,
    event_time: str,
    key: str,
    label: str = "label",
    score: str = "probability",
    window: str = "1 day",
    delay: str = "3 days",
    threshold: float = 0.5,
    bins: int = 10,
    available_now: bool = True,
):
    """Metrics per event-time window, each written once when the watermark closes it.

    Replayed rows (same ``key`` within the watermark) count once, rows later than ``delay`` are dropped.  A
    window's row has its confusion counts at ``threshold`` and histograms of the positives' and negatives' scores over ``bins``
    equal cells of [0, 1], from which ``window_metrics`` takes rates and an AUC.  State: one row per open
    window, and one per key for as long as the delay; both are dropped as the watermark passes.
    """
    y, p = F.col(label), F.col(score)
    cell = F.least(F.lit(bins - 1), F.greatest(F.lit(0), F.floor(p * bins))).cast("int")
    hist = lambda c, name: F.array(*(F.count_if((y == c) & (cell == i)) for i in range(bins))).alias(name)
    hit = p >= threshold
    rows = source.withWatermark(event_time, delay).dropDuplicatesWithinWatermark([key]).where(y.isNotNull() & p.isNotNull())
    per = rows.groupBy(F.window(event_time, window).alias("w")).agg(
        F.count_if((y == 0) & ~hit).alias("tn"),
        F.count_if((y == 0) & hit).alias("fp"),
        F.count_if((y == 1) & ~hit).alias("fn"),
        F.count_if((y == 1) & hit).alias("tp"),
        hist(0, "neg"),
        hist(1, "pos"),
    )
    out = per.select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), "tn", "fp", "fn", "tp", "neg", "pos")
    w = out.writeStream.format("parquet").option("checkpointLocation", checkpoint).outputMode("append")
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="30 seconds")
    return w.start(out_path)


def window_metrics(closed: DataFrame) -> DataFrame:
    """Accuracy, precision, recall, F1 and the histogram's AUC (ties inside a cell count half; NULL without both classes) per closed window."""
    from stratum.operators.evaluate import metrics_from_counts

    n = F.size("neg")
    below = F.transform(F.sequence(F.lit(1), n), lambda i: F.aggregate(F.slice("neg", 1, i - 1), F.lit(0).cast("long"), lambda a, x: a + x))
    wins = F.aggregate(
        F.zip_with("pos", F.zip_with(below, "neg", lambda b, x: b + x / 2.0), lambda a, b: a * b), F.lit(0.0), lambda a, x: a + x
    )
    pairs = (F.col("tp") + F.col("fn")).cast("double") * (F.col("tn") + F.col("fp"))
    return metrics_from_counts(closed.withColumn("auc", F.try_divide(wins, pairs)))


def running_counts(spark: SparkSession, out_path: str) -> DataFrame:
    """The totals published last: ``(label, prediction, count)``; empty before the first epoch."""
    from pyspark.errors import AnalysisException

    schema = "label int, prediction int, count long"
    try:
        totals = spark.read.schema(schema).parquet(out_path)
        totals.limit(0).collect()  # fails here when nothing was published yet
    except AnalysisException:
        totals = spark.createDataFrame([], schema)
    return totals


def confusion_from_counts(counts: DataFrame) -> DataFrame:
    """``(label, prediction, count)`` rows to one ``tn, fp, fn, tp`` row (absent cells 0)."""

    def cell(y: int, p: int):
        return F.coalesce(F.sum(F.when((F.col("label") == y) & (F.col("prediction") == p), F.col("count"))), F.lit(0))

    return counts.agg(
        cell(0, 0).cast("bigint").alias("tn"),
        cell(0, 1).cast("bigint").alias("fp"),
        cell(1, 0).cast("bigint").alias("fn"),
        cell(1, 1).cast("bigint").alias("tp"),
    )


def run_to_end(query) -> None:
    query.awaitTermination()
    if query.exception() is not None:
        raise RuntimeError(str(query.exception()))


def scratch(spark: SparkSession, name: str) -> tuple[str, str]:
    """Fresh output and checkpoint paths under the shared checkpoint folder."""
    base = scratch_path(spark, name)
    return f"{base}/out", f"{base}/checkpoint"
