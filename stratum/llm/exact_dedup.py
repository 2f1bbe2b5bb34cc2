"""Exact deduplication: 128-bit content hash groups, smallest id kept, bytes compared inside groups.

1. Texts are normalised (runs of ASCII white space become one space) and grouped by their 128-bit
   hash together with their bytes, so texts that merely collide fall into classes of their own.
   Copies combine before the shuffle: a hot group sends one row from each task.
2. Rows go back to their class by the hash alone, without their texts.  Only where one hash has
   several classes (a collision) do those rows carry their bytes to the join.

Null counts as the empty text; so all null and empty texts are one group.  A null id never wins over
another id; rows that agree in id and normalised text are repeats, and exactly one of them is kept.
Other columns are not read, whatever their names.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratum.session import cut_lineage

from .common import free_names, text_of, two_columns

WHITE = r"[\x20\x09-\x0D]+"


def normalised(text: Column) -> Column:
    """The form in which texts are compared."""
    return F.regexp_replace(text, WHITE, " ")


def content_hash(text: Column) -> Column:
    """128 bits of a text."""
    return F.unhex(F.md5(text))


def _texts(docs: DataFrame, hash_of: Callable[[Column], Column]) -> DataFrame:
    return docs.withColumn("body", normalised(F.col("text"))).withColumn("h", hash_of(F.col("body"))).drop("text")


def _classes(texts: DataFrame) -> DataFrame:
    """(h, body, keep_id, group_size): one row per distinct text; grouping compares the bytes."""
    return texts.groupBy("h", "body").agg(F.min("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size"))


def _copies(docs: DataFrame, hash_of: Callable[[Column], Column] = content_hash) -> DataFrame:
    """(h, doc_id, keep_id, group_size, text_sha256, copies): repeats of one id and text in one row."""
    texts = _texts(docs, hash_of)
    found = cut_lineage(_classes(texts).select("h", "keep_id", "group_size", F.sha2("body", 256).alias("text_sha256")), "text-classes")
    clash = found.groupBy("h").agg(F.count(F.lit(1)).alias("texts")).where("texts > 1").select("h")
    rows = texts.groupBy("h", "doc_id").agg(F.count(F.lit(1)).alias("copies"))
    out = ["h", "doc_id", "keep_id", "group_size", "text_sha256", "copies"]
    if clash.isEmpty():
        return rows.join(found, "h").select(*out)
    single = rows.join(found, "h").join(clash, "h", "left_anti").select(*out)
    texts = texts.join(clash, "h", "left_semi")  # these go by their bytes
    groups = _classes(texts).withColumn("text_sha256", F.sha2("body", 256))
    rows = texts.groupBy("h", "doc_id", "body").agg(F.count(F.lit(1)).alias("copies"))
    return single.unionByName(rows.join(groups, ["h", "body"]).select(*out))


def exact_dedup(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", hash_of: Callable[[Column], Column] = content_hash) -> DataFrame:
    """One row per input row: doc_id, keep_id, group_size, kept, text_sha256."""
    each = _copies(two_columns(df, id_col, text_col), hash_of).withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"))))
    kept = (F.col("copy") == 1) & F.col("doc_id").eqNullSafe(F.col("keep_id"))
    return each.select("doc_id", "keep_id", "group_size", kept.alias("kept"), "text_sha256")


def without_copies(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``df`` that stay, with all their columns; of rows that repeat id and text, any one."""
    docs = two_columns(df, id_col, text_col)
    own, sha, of, copies = free_names(df, "_text_sha", "_sha", "_id", "_copies")
    kept = _copies(docs).where(F.col("doc_id").eqNullSafe(F.col("keep_id"))).select(F.col("doc_id").alias(of), F.col("text_sha256").alias(sha), F.col("copies").alias(copies))
    kept = cut_lineage(kept, "kept-texts")
    rows = df.withColumn(own, F.sha2(normalised(text_of(text_col)), 256))
    stay = rows.join(kept, (rows[own] == kept[sha]) & rows[id_col].eqNullSafe(kept[of]))
    if kept.where(F.col(copies) > 1).isEmpty():
        return stay.select(*(rows[c] for c in df.columns))
    return stay.dropDuplicates([own, of]).select(*df.columns)
