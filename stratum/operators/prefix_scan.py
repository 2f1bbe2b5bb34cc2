"""Exact running totals over an ordered table: a two-level prefix scan.

A window ``order by`` without a partition key puts every row into one task.  Here rows are range
partitioned on (group, order), the ranges' totals are summed up (one row a range and group), and a
window runs inside each range only, starting from its range's offset.  Any order type that Spark sorts
will do; the number of ranges is the session's shuffle partitions, so a range grows with the cluster's
setting and not with the data.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stratum.session import cut_lineage


def running_totals(df: DataFrame, order: str, totals: list[str], group: list[str] | None = None) -> DataFrame:
    """``df`` with, per column c of ``totals``, ``<c>_below`` and ``<c>_total``, and with ``<order>_next``.

    ``<c>_below`` sums c over the rows of the group with a smaller ``order`` value, ``<c>_total`` over
    all of the group, ``<order>_next`` is the next larger value (NULL for the last).  ``order`` must be
    unique within a group (collapse equal values first); its NULLs come first, NaN last.  The ranges are
    a written table: a task that is run again finds the same ranges.
    """
    group = group or []
    keys = ["_range", *group]
    ranged = df.repartitionByRange(*group, order).withColumn("_range", F.spark_partition_id())
    ranged = cut_lineage(ranged, "ranges")
    per = ranged.groupBy(*keys).agg(F.min(order).alias("_first"), *(F.sum(c).alias(f"_{c}") for c in totals))  # one row a range and group
    along, whole = Window.partitionBy(*group).orderBy("_range"), Window.partitionBy(*group)
    per = per.select(
        *keys,
        F.lead("_first").over(along).alias("_after"),
        *((F.sum(f"_{c}").over(along) - F.col(f"_{c}")).alias(f"_{c}_before") for c in totals),
        *(F.sum(f"_{c}").over(whole).alias(f"{c}_total") for c in totals),
    )
    within = Window.partitionBy(*keys).orderBy(order)
    before = within.rowsBetween(Window.unboundedPreceding, -1)
    if group:
        # the groups' totals are looked up by range, which also holds for a null group
        match = F.col("_range") == F.col("_r")
        for g in group:
            match = match & F.col(g).eqNullSafe(F.col(f"_g_{g}"))
        per = per.withColumnsRenamed({"_range": "_r", **{g: f"_g_{g}" for g in group}})
        joined = ranged.join(per, match).drop("_r", *(f"_g_{g}" for g in group))
    else:
        joined = ranged.join(per, "_range")
    out = joined.withColumn(f"{order}_next", F.coalesce(F.lead(order).over(within), F.col("_after")))
    for c in totals:
        out = out.withColumn(f"{c}_below", F.col(f"_{c}_before") + F.coalesce(F.sum(c).over(before), F.lit(0)))
    return out.drop("_range", "_after", *(f"_{c}_before" for c in totals))
