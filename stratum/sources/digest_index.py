"""Deduplication of arriving batches against everything that came before.

The index holds (digest of the normalised text, smallest key, batch), spread over folders by the digest's
first two hex digits.  A batch contributes one row per digest that is new or whose smallest key falls; its folder is
replaced as a whole when the batch is run again, so retries change nothing.  The survivor of a text is
the smallest key over all batches, in whatever order they come: ``survivors`` equals ``dedup_text`` over the union.

Only digests and keys move.  The lookup joins a batch's digests with the index on (prefix, digest), so folders of
prefixes that a batch does not hold are not read, and Spark's run-time Bloom filter keeps index rows without a partner from
being shuffled.  Copies combine before the shuffle.  Equal SHA-256 values are equal texts here.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stratum.operators.text_models import normalized_text
from stratum.session import cut_lineage
from stratum.sources.versions import children


def _schema(key_type: T.DataType) -> T.StructType:
    return T.StructType([T.StructField("digest", T.StringType()), T.StructField("key", key_type), T.StructField("batch", T.StringType()), T.StructField("prefix", T.StringType())])  # the last two are folders


class DigestIndex:
    """An index at ``path``; ``key_type`` is the type of the documents' key."""

    def __init__(self, spark: SparkSession, path: str, key_type: T.DataType):
        self.spark, self.path, self.schema = spark, path, _schema(key_type)

    def _rows(self, without: str | None = None) -> DataFrame:
        """(digest, key, prefix) of all complete batches, less one."""
        done = [n for n in children(self.spark, self.path) if n.startswith("batch=") and "_SUCCESS" in children(self.spark, f"{self.path}/{n}")]
        done = [n for n in done if n != f"batch={without}"]
        if not done:
            return self.spark.createDataFrame([], self.schema).drop("batch")
        read = self.spark.read.schema(self.schema).option("basePath", self.path)
        return read.parquet(*(f"{self.path}/{n}" for n in done)).drop("batch")

    def add(self, batch: str, df: DataFrame, key: str, text: str) -> DataFrame:
        """Index a batch; (key, kept, replaced) of its distinct texts' smallest keys.

        ``kept``: no earlier batch has the text under a smaller key; ``replaced``: the key that stood for
        it until now, if this one is smaller.  Null texts are one text of their own."""
        digest = F.coalesce(F.sha2(normalized_text(F.col(text)), 256), F.lit(""))
        new = df.select(digest.alias("digest"), F.col(key).alias("key")).where("key IS NOT NULL").groupBy("digest").agg(F.min("key").alias("key"))
        new = new.withColumn("prefix", F.when(F.col("digest") == "", "none").otherwise(F.substring("digest", 1, 2)))
        held = self._rows(without=batch).groupBy("prefix", "digest").agg(F.min("key").alias("before"))
        both = cut_lineage(new.join(held, ["prefix", "digest"], "left"), "arrivals")
        first = F.col("before").isNull() | (F.col("key") < F.col("before"))
        rows = both.where(first).select("digest", "key", "prefix")
        rows.write.mode("overwrite").partitionBy("prefix").parquet(f"{self.path}/batch={batch}")
        return both.select("key", first.alias("kept"), F.when(first, F.col("before")).alias("replaced"))

    def survivors(self) -> DataFrame:
        """(key) of one document per distinct text of all batches: the smallest."""
        return self._rows().groupBy("digest").agg(F.min("key").alias("key")).select("key")
