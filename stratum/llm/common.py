"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rows and characters after which a Python stage hands a batch back to the JVM.
BATCH_ROWS = 2_000
BATCH_CHARS = 4_000_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One input table as a DataFrame."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_of(column: str | Column) -> Column:
    """A text column with null taken as the empty text."""
    c = F.col(column) if isinstance(column, str) else column
    return F.coalesce(c.cast("string"), F.lit(""))


def free_names(df: DataFrame, *wanted: str) -> tuple[str, ...]:
    """The wanted column names, each lengthened until ``df`` has no column of that name."""
    held, out = {c.lower() for c in df.columns}, []
    for name in wanted:
        while name.lower() in held:
            name += "_"
        out.append(name)
    return tuple(out)


def two_columns(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, text) alone: other columns, whatever their names, cannot clash with an operator's own."""
    return df.select(F.col(id_col).alias("doc_id"), text_of(text_col).alias("text"))


def slices(batch: pa.RecordBatch, text: str | int) -> Iterator[pa.RecordBatch]:
    """A batch in parts of bounded size, measured by its column ``text``."""
    n, at = batch.num_rows, 0
    sizes = np.asarray(pc.fill_null(pc.binary_length(batch.column(text)), 0))
    total = np.concatenate([[0], np.cumsum(sizes, dtype=np.int64)])
    while at < n:
        to = int(np.searchsorted(total, total[at] + BATCH_CHARS, side="right")) - 1
        to = min(max(to, at + 1), at + BATCH_ROWS, n)
        yield batch.slice(at, to - at)
        at = to


def batches(rows: Iterator[pa.RecordBatch], *columns: str) -> Iterator[tuple[list, ...]]:
    """Column lists of bounded size from Arrow batches; the last column is the text that is measured."""
    for batch in rows:
        for part in slices(batch, columns[-1]):
            yield tuple(part.column(c).to_pylist() for c in columns)


def int_lists(values: np.ndarray, lengths: list[int] | np.ndarray) -> pa.Array:
    """Arrow lists of int32 from the concatenated values and each list's length."""
    offsets = np.concatenate([[0], np.cumsum(lengths, dtype=np.int64)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values.astype(np.int32, copy=False)))
