"""Range scans, splits, sampling and paging in explicit key order.

The reference relies on SQLite insertion order (``ORDER BY rowid``).  Here
every operator takes an explicit unique ``key``; row positions are turned into
key boundaries with :func:`stratum.operators.ordering.select_ranks`, and rows
are then kept with range predicates.  No global sort, no single-partition
window, no ``monotonically_increasing_id``.

Seeded shuffles order rows by ``(h, key)`` where ``h`` is the first 13 hex
digits (52 bits, exact in a double) of ``md5('<seed>:<key>')``: the order is
independent of partitioning and of executor loss.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratum.operators.ordering import BROADCAST_RANGES, before, rank_filter, select_ranks

HASH_COL = "_h"


def hash_order(key: str, seed: int | str = 42) -> Column:
    """52-bit seeded hash of ``key`` (deterministic pseudo-random order)."""
    digest = F.md5(F.concat(F.lit(f"{seed}:"), F.col(key).cast("string")))
    return F.conv(F.substring(digest, 1, 13), 16, 10).cast("bigint")


# ------------------------------------------------------------------ range scans


def scan_range(df: DataFrame, key: str, offset: int = 0, limit: int | None = None, **kw) -> DataFrame:
    """Rows ``[offset, offset + limit)`` in key order; ``limit=None`` -> to the end."""
    stop = None if limit is None else offset + limit
    return rank_filter(df, key, max(0, offset), stop, **kw)


def scan_tail(df: DataFrame, key: str, offset: int, max_rows: int | None = None, **kw) -> DataFrame:
    """Everything from ``offset`` to the end; ``max_rows`` is an exact cap (no chunk overshoot)."""
    return scan_range(df, key, offset, max_rows, **kw)


def scan_prefix(df: DataFrame, key: str, n: int = 200_000, **kw) -> DataFrame:
    """The first ``n`` rows in key order (a deterministic bounded sample)."""
    return scan_range(df, key, 0, n, **kw)


def row_at(df: DataFrame, key: str, i: int, **kw) -> DataFrame:
    """The i-th row in key order; empty when ``i`` is out of range."""
    return scan_range(df, key, i, 1, **kw)


def preview(df: DataFrame, key: str, n: int = 20, lo: int = 1, hi: int = 200) -> DataFrame:
    """First n rows in key order, n clamped to [lo, hi] (a bounded top-n)."""
    n = max(lo, min(hi, int(n)))
    return df.orderBy(key).limit(n)


def page(df: DataFrame, key: str, page_no: int = 1, size: int | None = 50, **kw) -> tuple[DataFrame, int]:
    """Page ``page_no`` (1-based; < 1 acts as 1) of ``size`` rows in key order, and the total row count.

    ``size`` missing or <= 0 returns all rows.  The page start is a key
    boundary, so deep pages cost the same as the first one.
    """
    page_no = max(1, int(page_no or 1))
    if not size or size <= 0:
        return df, df.count()
    start = (page_no - 1) * size
    res = select_ranks(df, key, [start], **kw)
    total = res.counts.get(0, 0)
    b = res.get(start)
    if b is None:
        return df.where(F.lit(False)), total
    return df.where(~before(key, b)).orderBy(key).limit(size), total


# ----------------------------------------------------------------------- splits


def split_range(df: DataFrame, key: str, train_n: int, eval_n: int, min_train: int = 0, **kw) -> DataFrame:
    """First ``train_n`` rows 'train', next ``eval_n`` 'eval', the rest 'live' (clamped to the row count).

    Adds a ``split`` column.  With ``min_train`` > 0 at least that many rows train.
    """

    def cuts(_g, n):
        t = min(max(train_n, min_train), n)
        e = min(eval_n, max(n - t, 0))
        return [t, t + e]

    return _split_at(df, key, cuts, **kw)


def split_fraction(df: DataFrame, key: str, train_frac: float, eval_frac: float, min_train: int = 0, **kw) -> DataFrame:
    """As :func:`split_range` with ``int(n * frac)`` rows; ``n`` comes from the same selection pass."""

    def cuts(_g, n):
        t = min(max(int(n * train_frac), min_train), n)
        e = min(int(n * eval_frac), max(n - t, 0))
        return [t, t + e]

    return _split_at(df, key, cuts, **kw)


def _split_at(df: DataFrame, key: str, cuts, **kw) -> DataFrame:
    res = select_ranks(df, key, cuts, **kw)
    n = res.counts.get(0, 0)
    t, te = cuts(0, n)
    b1, b2 = res.get(t), res.get(te)
    split = F.when(F.col(key).isNull(), F.lit(None))
    split = split.when(before(key, b1), F.lit("train")) if b1 else split.when(F.lit(True), F.lit("train"))
    split = split.when(before(key, b2), F.lit("eval")) if b2 else split.when(F.lit(True), F.lit("eval"))
    return df.withColumn("split", split.otherwise(F.lit("live")))


def split_shuffle(df: DataFrame, key: str, test_size: float = 0.2, seed: int = 42, **kw) -> DataFrame:
    """Seeded shuffle; the last ``int(n * test_size)`` rows are 'test', the others 'train'.

    With ``int(n * test_size) == 0`` every row trains (the reference would train on nothing).
    """
    h = df.withColumn(HASH_COL, hash_order(key, seed))
    res = select_ranks(h, HASH_COL, lambda _g, n: [n - int(n * test_size)], tiebreak=key, **kw)
    n = res.counts.get(0, 0)
    b = res.get(n - int(n * test_size))
    is_test = ~before(HASH_COL, b, key) if b else F.lit(False)
    return h.withColumn("split", F.when(is_test, F.lit("test")).otherwise(F.lit("train"))).drop(HASH_COL)


def split_stratified(df: DataFrame, key: str, label: str, test_size: float = 0.2, seed: int = 42, **kw) -> DataFrame:
    """Exact per-class split: within each label the first ``ceil(test_size * n_label)`` rows
    in seeded hash order are 'test'.  One boundary per label (few), no per-label window.
    """
    h = df.withColumn(HASH_COL, hash_order(key, seed))
    res = select_ranks(h, HASH_COL, lambda _g, n: [math.ceil(test_size * n)], group=label, tiebreak=key, **kw)
    bounds = {g: res.get(math.ceil(test_size * n), g) for g, n in res.counts.items()}
    return _by_boundaries(h, key, label, bounds)


def _by_boundaries(h: DataFrame, key: str, label: str, bounds: dict) -> DataFrame:
    """Rows against one boundary row per label."""
    spark = h.sparkSession
    ltype = h.schema[label].dataType
    ktype = h.schema[key].dataType
    from pyspark.sql import types as T

    schema = T.StructType(
        [T.StructField("_lbl", ltype), T.StructField("_bh", T.LongType()), T.StructField("_bk", ktype),
         T.StructField("_all", T.BooleanType())]
    )
    rows = [(g, b[0] if b else None, b[1] if b else None, b is None) for g, b in bounds.items()]
    bt = spark.createDataFrame(rows, schema)
    # broadcast, or all rows of a label would be read by one task from here on
    j = h.join(F.broadcast(bt) if len(rows) <= BROADCAST_RANGES else bt, F.col(label) == F.col("_lbl"), "left")
    in_test = F.col("_all") | (F.col(HASH_COL) < F.col("_bh")) | (
        (F.col(HASH_COL) == F.col("_bh")) & (F.col(key) < F.col("_bk"))
    )
    split = F.when(F.col(label).isNull(), F.lit(None)).when(in_test, F.lit("test")).otherwise(F.lit("train"))
    return j.withColumn("split", split).drop(HASH_COL, "_lbl", "_bh", "_bk", "_all")


def sample_negatives(
    df: DataFrame, key: str, label: str, n_negatives: int = 200_000, seed: int = 42, **kw
) -> DataFrame:
    """All positive rows UNION ALL ``n_negatives`` negatives chosen in seeded hash order."""
    pos = df.where(F.col(label) == 1)
    neg = df.where(F.col(label) != 1).withColumn(HASH_COL, hash_order(key, seed))
    res = select_ranks(neg, HASH_COL, [n_negatives], tiebreak=key, **kw)
    b = res.get(n_negatives)
    chosen = neg.where(before(HASH_COL, b, key)) if b else neg
    return pos.unionByName(chosen.drop(HASH_COL))
