"""Sinks: scored rows, exports, run metadata and logs, fitted state, reports.

Every sink writes with Spark's writers (one file per task, no single-file
funnel through the driver) into a folder; readers take an explicit schema.
Paths under the session's shared checkpoint folder are made with
:func:`stratum.session.scratch_path` when the caller gives none.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stratum.functions.clean import q

# CSV options used for both writing and reading, so text round-trips exactly
# (quotes doubled, whitespace kept).
CSV_OPTIONS = {
    "header": "true",
    "escape": '"',
    "quote": '"',
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
    "nullValue": "\\N",  # so an empty text, written as two quotes, is told from NULL
    "emptyValue": "",
}
WRITE_OPTIONS = {**CSV_OPTIONS, "emptyValue": '""'}


def _options(base: dict, schema: T.StructType, one_line: bool) -> dict:
    """``multiLine`` only where a text may hold a line break: without it files are split and read by many tasks."""
    text = any(isinstance(f.dataType, (T.StringType, T.BinaryType)) for f in schema.fields)
    return {**base, "multiLine": str(text and not one_line).lower()}


def write_csv(df: DataFrame, path: str, mode: str = "overwrite", one_line: bool = False) -> str:
    """Write ``df`` as a CSV folder.  ``one_line`` promises rows of one line: a text with a line break stops the job."""
    if one_line:
        broken = lambda c: F.raise_error(F.lit(f"a line break in column {c}, which was to be written on one line")).cast("string")
        df = df.select(*(F.when(q(f.name).rlike("[\\r\\n]"), broken(f.name)).otherwise(q(f.name)).alias(f.name) if isinstance(f.dataType, T.StringType) else q(f.name) for f in df.schema.fields))
    df.write.mode(mode).options(**_options(WRITE_OPTIONS, df.schema, one_line)).csv(path)
    return path


def read_csv(spark: SparkSession, path: str, schema: T.StructType, one_line: bool = False) -> DataFrame:
    """Read what ``write_csv`` wrote; files of numbers alone, or of ``one_line`` rows, are split among tasks."""
    return spark.read.options(**_options(CSV_OPTIONS, schema, one_line)).schema(schema).csv(path)


def write_predictions(scored: DataFrame, path: str, target: str | None = None) -> str:
    """Input columns minus the target, plus ``prediction`` and ``probability``, as CSV with a header.

    Refuses an empty result (the reference stops when nothing was scored).
    """
    out = scored.drop(target) if target and target in scored.columns else scored
    if out.isEmpty():
        raise ValueError("no rows to write")
    return write_csv(out, path, one_line=True)


def write_slim(scored: DataFrame, path: str) -> str:
    """``time, predicted_fault, probability`` of scored rows, as Parquet."""
    slim = scored.select("time", scored["prediction"].alias("predicted_fault"), "probability")
    slim.write.mode("overwrite").parquet(path)
    return path


def export_filtered(df: DataFrame, folder: str, status: str, one_line: bool = False) -> str:
    """Write filtered rows as ``<folder>/<status>_transactions.csv`` (a CSV folder); ``one_line`` as in ``write_csv``."""
    return write_csv(df, f"{folder.rstrip('/')}/{status}_transactions.csv", one_line=one_line)


def write_json(df: DataFrame, path: str, mode: str = "overwrite") -> str:
    df.write.mode(mode).json(path)
    return path


def append_parquet(df: DataFrame, path: str) -> str:
    df.write.mode("append").parquet(path)
    return path


def write_metadata(spark: SparkSession, path: str, record: dict, metrics: dict | None = None) -> str:
    """One-row run metadata (UTC time, table, target, counts, offsets, seed, metrics) as JSON.

    Typed explicitly: text fields as strings, integers as longs, metrics as
    doubles (a metric may be NULL, e.g. AUC with one class).
    """
    import datetime as _dt

    fields, values = [], []
    for k, v in record.items():
        t = T.LongType() if isinstance(v, int) and not isinstance(v, bool) else (
            T.DoubleType() if isinstance(v, float) else T.StringType())
        fields.append(T.StructField(k, t))
        values.append(v if t != T.StringType() or v is None else str(v))
    fields.append(T.StructField("created_at", T.StringType()))
    values.append(_dt.datetime.now(_dt.timezone.utc).isoformat())
    for k, v in (metrics or {}).items():
        fields.append(T.StructField(f"metric_{k}", T.DoubleType()))
        values.append(None if v is None else float(v))
    df = spark.createDataFrame([tuple(values)], T.StructType(fields))
    return write_json(df, path)


def read_live_offset(spark: SparkSession, path: str, default: int = 0) -> int:
    """The live offset a scoring job starts from, read back from saved metadata."""
    rows = spark.read.json(path).select("live_offset").limit(1).collect()
    return int(rows[0]["live_offset"]) if rows and rows[0]["live_offset"] is not None else default


def append_run_log(metrics: DataFrame, path: str, run_id: int, sample_text: str | None = None,
                   sample_prediction: int | None = None) -> str:
    """Append one row per run: run id, UTC time, the metrics row, an optional sample prediction."""
    row = metrics.select(
        F.lit(run_id).alias("run_id"),
        F.current_timestamp().alias("run_at"),
        "*",
        F.lit(sample_text).cast("string").alias("sample_text"),
        F.lit(sample_prediction).cast("int").alias("sample_prediction"),
    )
    return append_parquet(row, path)
