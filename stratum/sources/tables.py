"""Table loading and catalog-level helpers."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratum.session import configure

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def load_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One parquet table of the driver's data set."""
    configure(spark)
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def table_profile(spark: SparkSession, sf_dir: str, names=TABLES) -> DataFrame:
    """One row per table: ``(table_name, n_rows, n_cols, columns)``.

    Row counts come from one aggregate per table; Parquet footers answer them
    without reading column data.  Column names and types come from the schema.
    """
    parts = []
    for name in names:
        df = load_table(spark, sf_dir, name)
        cols = ", ".join(f"{f.name}:{f.dataType.simpleString()}" for f in df.schema.fields)
        parts.append(
            df.agg(F.count(F.lit(1)).alias("n_rows")).select(
                F.lit(name).alias("table_name"),
                F.col("n_rows"),
                F.lit(len(df.columns)).cast("int").alias("n_cols"),
                F.lit(cols).alias("columns"),
            )
        )
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def table_sample(df: DataFrame, order_col: str, n: int = 5) -> DataFrame:
    """The first ``n`` rows in key order (the profile's sample rows)."""
    return df.orderBy(order_col).limit(n)
