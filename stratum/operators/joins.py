"""Joins of a large fact side to a lookup table (term tables, fitted state).

Spark decides by bytes whether the lookup side is broadcast (``autoBroadcastJoinThreshold``,
again at run time under AQE); otherwise it is a shuffle join whose hot partitions AQE's
skew-join rule splits, also for keys that the lookup does not hold.  ``salts`` > 1 spreads
every key over that many lookup replicas by hand, for sessions without AQE.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def lookup_join(
    facts: DataFrame,
    lookup: DataFrame,
    on: str | list[str],
    how: str = "inner",
    salt_col: str | None = None,
    salts: int = 1,
) -> DataFrame:
    """``facts JOIN lookup USING (on)`` where ``lookup`` has one row per key."""
    keys = [on] if isinstance(on, str) else list(on)
    if salts <= 1:
        return facts.join(lookup, keys, how)
    row = [salt_col] if salt_col else facts.columns
    f = facts.withColumn("_salt", F.pmod(F.xxhash64(*row), F.lit(salts)).cast("int"))
    lk = lookup.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return f.join(lk, [*keys, "_salt"], how).drop("_salt")
