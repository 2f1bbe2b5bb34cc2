"""Exact order statistics on distributed data, without a global sort.

``row_number() over (order by k)`` moves every row into one task.  Everything
that needs "the row at position i in key order" (range splits, paging, the
i-th live row, seeded shuffles, stratified splits, exact medians) instead asks
:func:`select_ranks` for the boundary value, then keeps rows with a plain range
predicate that pushes down to the Parquet scan.

``select_ranks`` narrows each requested rank by rank, not by value width: per
candidate range one ``percentile_approx`` aggregate (for strings a bounded sample)
gives pivots that are values of the data, and one aggregate counts the rows at
and between them.  All ranks of a range are looked up in that one histogram; the
cells that hold them are the next ranges.  A round shrinks a range about
``PIVOTS``-fold whatever the distribution (infinities, outliers, shared string
prefixes), and at least by its pivots.  Once at most ``local_limit`` rows are
left in a range, a window over those rows picks the exact one.  A value that
fills a cell alone resolves at once; with a tie-break column the tie-break is
ranked recursively.  The driver holds the pivots' counts: ranges x pivots.
"""

from __future__ import annotations

import functools
from collections.abc import Callable, Iterable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

LOCAL_LIMIT = 200_000
PIVOTS = 128
SAMPLE_PER_PIVOT = 40  # rows sampled for each pivot of a string range
BROADCAST_RANGES = 10_000  # ranges up to which their table is broadcast


@dataclass
class RankResult:
    """``values[(group, rank)] = (order_value, tiebreak_value)`` or ``None`` past the end."""

    values: dict = field(default_factory=dict)
    counts: dict = field(default_factory=dict)
    mins: dict = field(default_factory=dict)
    maxs: dict = field(default_factory=dict)
    sums: dict = field(default_factory=dict)  # as DOUBLE, from the same first aggregate

    def get(self, rank: int, group=0):
        return self.values.get((group, rank))


@dataclass
class _Target:
    tid: int
    g: object
    rank: int  # requested rank (the result key)
    r: int  # remaining offset inside [lo, hi]
    n: int
    lo: object
    hi: object

    @property
    def range(self) -> tuple:
        return self.g, self.lo, self.hi


def _numeric(df: DataFrame, c: str):
    """A column as DOUBLE for sums; NULL for text."""
    t = df.schema[c].dataType
    if isinstance(t, (T.TimestampType, T.TimestampNTZType)):
        return F.unix_micros(F.col(c).cast("timestamp")).cast("double")
    if isinstance(t, T.DateType):
        return F.unix_date(F.col(c)).cast("double")
    if isinstance(t, (T.StringType, T.BinaryType)):
        return F.lit(None).cast("double")
    return F.col(c).cast("double")


def _is_float(df: DataFrame, c: str) -> bool:
    return isinstance(df.schema[c].dataType, (T.DoubleType, T.FloatType))


def select_ranks(
    df: DataFrame,
    order: str,
    ranks: Iterable[int] | Callable[[object, int], Iterable[int]],
    group: str | None = None,
    tiebreak: str | None = None,
    local_limit: int = LOCAL_LIMIT,
    pivots: int = PIVOTS,
) -> RankResult:
    """Exact values at 0-based ``ranks`` of column ``order`` (numeric, date, timestamp or string; nulls and NaN skipped).

    ``ranks`` is a list applied to every group, or ``f(group_value, n_rows) -> ranks``.
    Order is ``(order, tiebreak)`` ascending.  Returns values and per-group row counts.
    """
    cols = [F.col(order).alias("_v"), (F.col(group) if group else F.lit(0)).alias("_g")]
    if tiebreak:
        cols.append(F.col(tiebreak).alias("_t"))
    base = df.select(*cols)
    keep = F.col("_v").isNotNull()
    if group:
        keep = keep & F.col("_g").isNotNull()
    if _is_float(base, "_v"):
        keep = keep & ~F.isnan("_v")
    base = base.where(keep)
    stats = base.groupBy("_g").agg(
        F.count(F.lit(1)).alias("n"),
        F.min("_v").alias("mn"),
        F.max("_v").alias("mx"),
        F.sum(_numeric(base, "_v")).alias("sm"),
    )
    rows = stats.collect()  # one row per group
    result = RankResult(
        counts={r["_g"]: r["n"] for r in rows},
        mins={r["_g"]: r["mn"] for r in rows},
        maxs={r["_g"]: r["mx"] for r in rows},
        sums={r["_g"]: r["sm"] for r in rows},
    )

    targets: list[_Target] = []
    for row in rows:
        g, n = row["_g"], row["n"]
        want = ranks(g, n) if callable(ranks) else ranks
        for r in want:
            r = int(r)
            if r < 0 or r >= n:
                result.values[(g, r)] = None
            else:
                targets.append(_Target(len(targets), g, r, r, n, row["mn"], row["mx"]))
    spark = df.sparkSession
    textual = isinstance(base.schema["_v"].dataType, (T.StringType, T.BinaryType))

    def candidates(ranges: list[tuple], extra: list | None = None) -> DataFrame:
        """Rows of each range ``(group, lo, hi)``, by its position ``rid``; ``extra`` is a list per range (column ``at``).

        Ungrouped ranges are plain predicates (one per range, few); those of groups are looked up by group."""
        vtype = base.schema["_v"].dataType
        if group is None:
            inside = [(F.col("_v") >= F.lit(lo)) & (F.col("_v") <= F.lit(hi)) for _, lo, hi in ranges]
            held = F.filter(F.array(*(F.when(c, F.lit(i)) for i, c in enumerate(inside))), lambda x: x.isNotNull())
            out = base.where(functools.reduce(Column.__or__, inside)).withColumn("rid", F.explode(held) if len(ranges) > 1 else F.lit(0))
            if extra:
                lists = [F.array(*(F.lit(x) for x in at)).cast(T.ArrayType(vtype)) for at in extra]
                out = out.withColumn("at", F.element_at(F.array(*lists), F.col("rid") + 1) if len(lists) > 1 else lists[0])
            return out
        schema = T.StructType(
            [
                T.StructField("rid", T.IntegerType()),
                T.StructField("rg", base.schema["_g"].dataType),
                T.StructField("lo", vtype),
                T.StructField("hi", vtype),
                T.StructField("at", T.ArrayType(vtype)),
            ]
        )
        table = spark.createDataFrame([(i, *k, extra[i] if extra else None) for i, k in enumerate(ranges)], schema)
        cond = (F.col("_g") == F.col("rg")) & (F.col("_v") >= F.col("lo")) & (F.col("_v") <= F.col("hi"))
        return base.join(F.broadcast(table) if len(ranges) <= BROADCAST_RANGES else table, cond)

    def choose_pivots(ranges: list[tuple], sizes: list[int]) -> list[list]:
        """Sorted distinct values of each range at about even ranks, its smallest among them."""
        cand = candidates(ranges)
        found: list[set] = [{k[1]} for k in ranges]
        if textual:
            share = min(1.0, pivots * SAMPLE_PER_PIVOT * len(ranges) / max(1, sum(sizes)))
            sample: list[list] = [[] for _ in ranges]
            for r in cand.select("rid", "_v").sample(share, seed=7).collect():
                sample[r["rid"]].append(r["_v"])
            for i, values in enumerate(sample):
                values.sort(key=lambda v: v.encode("utf-8") if isinstance(v, str) else v)
                found[i].update(values[:: max(1, len(values) // pivots)])
        else:
            grid = [i / (pivots + 1) for i in range(1, pivots + 1)]
            for r in cand.groupBy("rid").agg(F.percentile_approx("_v", grid, 10_000).alias("p")).collect():
                found[r["rid"]].update(r["p"])
        return [sorted(x, key=lambda v: v.encode("utf-8") if isinstance(v, str) else v) for x in found]

    while True:
        pending = [t for t in targets if t.n > local_limit and t.lo != t.hi]
        if not pending:
            break
        ranges = list(dict.fromkeys(t.range for t in pending))
        sizes = {t.range: t.n for t in pending}
        at = choose_pivots(ranges, [sizes[k] for k in ranges])
        # even cells lie between pivots, odd ones hold a pivot's value
        below = F.size(F.filter("at", lambda p: p < F.col("_v")))
        cell = below * 2 + F.when(F.array_contains("at", F.col("_v")), 1).otherwise(0)
        hist = candidates(ranges, at).groupBy("rid", cell.alias("cell"))
        cells: dict[tuple, list] = {k: [] for k in ranges}
        for h in hist.agg(F.count(F.lit(1)).alias("n"), F.min("_v").alias("mn"), F.max("_v").alias("mx")).collect():
            cells[ranges[h["rid"]]].append(h)
        for found in cells.values():
            found.sort(key=lambda h: h["cell"])
        for t in pending:
            seen = 0
            for h in cells[t.range]:
                if seen + h["n"] > t.r:
                    t.r -= seen
                    t.n, t.lo, t.hi = h["n"], h["mn"], h["mx"]
                    break
                seen += h["n"]

    # Resolve: one value left, or few enough rows to rank with a window.
    if tiebreak:
        tied = [t for t in targets if t.lo == t.hi and t.n > local_limit]
        ranked = [t for t in targets if t not in tied]
    else:
        tied = []
        ranked = [t for t in targets if t.lo != t.hi]
        for t in targets:
            if t.lo == t.hi:
                result.values[(t.g, t.rank)] = (t.lo, None)
    for t in tied:
        # more than local_limit rows share one order value: rank them by the tie-break column
        sub = df.where((F.col(group) == F.lit(t.g)) if group else F.lit(True)).where(F.col(order) == F.lit(t.lo))
        inner = select_ranks(sub, tiebreak, [t.r], local_limit=local_limit, pivots=pivots)
        hit = inner.get(t.r)
        result.values[(t.g, t.rank)] = (t.lo, hit[0] if hit else None)
    if ranked:
        ranges = list(dict.fromkeys(t.range for t in ranked))
        place = {k: i for i, k in enumerate(ranges)}
        picks = sorted({(place[t.range], t.r + 1) for t in ranked})
        w = Window.partitionBy("rid").orderBy(*(["_v", "_t"] if tiebreak else ["_v"]))
        wanted = spark.createDataFrame(picks, "rid int, pick long")
        picked = (
            candidates(ranges)
            .select("rid", "_v", *(["_t"] if tiebreak else []), F.row_number().over(w).alias("_rn"))
            .join(F.broadcast(wanted) if len(picks) <= BROADCAST_RANGES else wanted, "rid")
            .where(F.col("_rn") == F.col("pick"))
            .select("rid", "pick", "_v", *(["_t"] if tiebreak else []))
            .collect()
        )
        got = {(p["rid"], p["pick"]): (p["_v"], p["_t"] if tiebreak else None) for p in picked}
        for t in ranked:
            result.values[(t.g, t.rank)] = got[place[t.range], t.r + 1]
    return result


def before(order: str, boundary, tiebreak: str | None = None) -> Column:
    """Rows strictly before ``boundary = (value, tiebreak_value)`` in ``(order, tiebreak)`` order."""
    v, t = boundary
    lt = F.col(order) < F.lit(v)
    if tiebreak is None or t is None:
        return lt
    return lt | ((F.col(order) == F.lit(v)) & (F.col(tiebreak) < F.lit(t)))


def rank_filter(df: DataFrame, order: str, start: int, stop: int | None, tiebreak: str | None = None, **kw) -> DataFrame:
    """Rows at positions ``[start, stop)`` of ``(order, tiebreak)`` order; ``stop=None`` = to the end.

    Two boundary lookups, then a range predicate (pushed to the scan when
    ``order`` is a stored column).  Rows with a null order value are excluded.
    """
    ranks = [r for r in (start, stop) if r is not None]
    res = select_ranks(df, order, ranks, tiebreak=tiebreak, **kw)
    n = res.counts.get(0, 0)
    cond = F.col(order).isNotNull()
    if start > 0:
        lo = res.get(start)
        if lo is None:
            return df.where(F.lit(False))
        cond = cond & ~before(order, lo, tiebreak)
    if stop is not None and stop < n:
        hi = res.get(stop)
        cond = cond & before(order, hi, tiebreak)
    return df.where(cond)
