"""Fitted state as data: medians, modes, scales, categories, class weights, profiles.

``fit_*`` returns a small DataFrame (one row per feature or class); ``apply_*``
joins/inlines it.  State has a size bound by construction (one row per column
or per class) or is checked before it is inlined (category lists).

Exact medians use :func:`stratum.operators.ordering.select_ranks` on the
unpivoted ``(feature, value)`` rows: a few histogram aggregates instead of a
percentile buffer holding every distinct value in one task.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratum.functions.clean import nan_to_null, q
from stratum.operators.joins import lookup_join
from stratum.operators.ordering import select_ranks
from stratum.operators.prefix_scan import running_totals

MAX_CATEGORIES = 10_000


def long_form(df: DataFrame, cols: Iterable[str]) -> DataFrame:
    """``(feature, value DOUBLE)`` rows, NULL and NaN dropped (an unpivot, no shuffle)."""
    cols = list(cols)
    arr = F.array(*[F.struct(F.lit(c).alias("feature"), nan_to_null(q(c).cast("double")).alias("value")) for c in cols])
    return df.select(F.inline(arr)).where(F.col("value").isNotNull())


def _column_stats(df: DataFrame, cols: list[str], **kw) -> dict:
    """Per column ``(n, min, max, mean, median)`` over non-NULL, non-NaN values, from one selection."""
    lf = long_form(df, cols)
    res = select_ranks(lf, "value", lambda _g, n: sorted({(n - 1) // 2, n // 2}), group="feature", **kw)
    out = {}
    for c in cols:
        n = res.counts.get(c, 0)
        if n == 0:
            out[c] = (0, None, None, None, None)
            continue
        lo, hi = res.get((n - 1) // 2, c), res.get(n // 2, c)
        med = (float(lo[0]) + float(hi[0])) / 2.0
        out[c] = (n, res.mins[c], res.maxs[c], res.sums[c] / n, med)
    return out


def fit_median(df: DataFrame, cols: Iterable[str], approx: bool = False, **kw) -> DataFrame:
    """Exact median per column (mean of the two middle values for an even count); NULL when all NULL.

    Returns ``(feature, median)`` for every requested column.  ``approx=True``
    uses one ``percentile_approx`` aggregate (accuracy 10,000) instead.
    """
    cols = list(cols)
    if approx:
        wide = df.agg(*[F.percentile_approx(nan_to_null(q(c).cast("double")), 0.5, 10_000).alias(c) for c in cols])
        arr = F.array(*[F.struct(F.lit(c).alias("feature"), q(c).cast("double").alias("median")) for c in cols])
        return wide.select(F.inline(arr))
    st = _column_stats(df, cols, **kw)
    return df.sparkSession.createDataFrame([(c, st[c][4]) for c in cols], "feature string, median double")


def state_dict(state: DataFrame, key: str, value: str) -> dict:
    """Collect a fitted-state table (one row per feature/class: bounded) into a dict."""
    return {r[key]: r[value] for r in state.collect()}


def apply_fill(df: DataFrame, fills: dict) -> DataFrame:
    """Replace NULL (and NaN) by the fitted value per column; columns without a value are kept as is."""
    out = []
    for c in df.columns:
        if c in fills and fills[c] is not None:
            out.append(F.coalesce(nan_to_null(q(c)) if _is_floating(df, c) else q(c), F.lit(fills[c])).alias(c))
        else:
            out.append(q(c))
    return df.select(*out)


def _is_floating(df: DataFrame, c: str) -> bool:
    return df.schema[c].dataType.typeName() in ("double", "float")


def median_impute(df: DataFrame, cols: Iterable[str], medians: DataFrame | None = None, **kw) -> DataFrame:
    """Fill NULLs with the fitted medians; columns the state lacks use the batch's own median."""
    cols = list(cols)
    fitted = state_dict(medians, "feature", "median") if medians is not None else {}
    missing = [c for c in cols if c not in fitted]
    if missing:
        fitted.update(state_dict(fit_median(df, missing, **kw), "feature", "median"))
    return apply_fill(df, {c: fitted.get(c) for c in cols})


def fit_mode(df: DataFrame, cols: Iterable[str]) -> DataFrame:
    """Most frequent non-NULL value per column, smallest value on ties: ``(feature, mode)`` as text.

    Count per (feature, value) (partial aggregation), then the minimum of
    ``(-count, value)`` per feature: both steps are algebraic, so a hot value
    never gathers in one task.
    """
    cols = list(cols)
    arr = F.array(*[F.struct(F.lit(c).alias("feature"), q(c).cast("string").alias("value")) for c in cols])
    counts = df.select(F.inline(arr)).where(F.col("value").isNotNull()).groupBy("feature", "value").count()
    best = counts.groupBy("feature").agg(F.min(F.struct((-F.col("count")).alias("nc"), F.col("value"))).alias("b"))
    return best.select("feature", F.col("b.value").alias("mode"))


def mode_impute(df: DataFrame, cols: Iterable[str], modes: DataFrame | None = None) -> DataFrame:
    cols = list(cols)
    fitted = state_dict(modes if modes is not None else fit_mode(df, cols), "feature", "mode")
    out = []
    for c in df.columns:
        if c in cols and fitted.get(c) is not None:
            out.append(F.coalesce(q(c), F.lit(fitted[c]).cast(df.schema[c].dataType)).alias(c))
        else:
            out.append(q(c))
    return df.select(*out)


def fit_scale(df: DataFrame, cols: Iterable[str]) -> DataFrame:
    """``(feature, mean, std)`` with population std; a zero std is stored as 1 (scikit-learn's rule)."""
    cols = list(cols)
    aggs = []
    for c in cols:
        v = nan_to_null(q(c).cast("double"))
        aggs += [F.avg(v).alias(f"m_{c}"), F.stddev_pop(v).alias(f"s_{c}")]
    wide = df.agg(*aggs)
    arr = F.array(
        *[
            F.struct(
                F.lit(c).alias("feature"),
                F.col(f"`m_{c}`").alias("mean"),
                F.coalesce(F.when(F.col(f"`s_{c}`") != 0, F.col(f"`s_{c}`")), F.lit(1.0)).alias("std"),
            )
            for c in cols
        ]
    )
    return wide.select(F.inline(arr))


def apply_scale(df: DataFrame, scales: DataFrame, with_mean: bool = True) -> DataFrame:
    st = {r["feature"]: (r["mean"], r["std"]) for r in scales.collect()}  # one row per feature
    out = []
    for c in df.columns:
        if c in st:
            m, s = st[c]
            x = q(c).cast("double")
            out.append((((x - F.lit(m)) if with_mean else x) / F.lit(s)).alias(c))
        else:
            out.append(q(c))
    return df.select(*out)


def fit_categories(df: DataFrame, col: str, max_categories: int = MAX_CATEGORIES) -> list:
    """Sorted distinct non-NULL categories of ``col`` (count checked before collecting)."""
    d = df.select(q(col).cast("string").alias("v")).where(F.col("v").isNotNull()).distinct()
    vals = [r["v"] for r in d.limit(max_categories + 1).collect()]
    if len(vals) > max_categories:
        raise ValueError(f"{col}: more than {max_categories} categories")
    return sorted(vals)


def fit_category_state(df: DataFrame, col: str, max_categories: int = MAX_CATEGORIES) -> tuple[list, str | None]:
    """Sorted categories and the mode (most frequent, smallest on ties) from one value-count aggregate."""
    counts = df.select(q(col).cast("string").alias("v")).where(F.col("v").isNotNull()).groupBy("v").count()
    rows = counts.limit(max_categories + 1).collect()  # one row per category, checked
    if len(rows) > max_categories:
        raise ValueError(f"{col}: more than {max_categories} categories")
    mode = min(rows, key=lambda r: (-r["count"], r["v"]))["v"] if rows else None
    return sorted(r["v"] for r in rows), mode


def apply_one_hot(df: DataFrame, col: str, categories: list, drop_source: bool = True) -> DataFrame:
    """0/1 column ``<col>_<category>`` per fitted category; unknown or NULL -> all zeros."""
    v = q(col).cast("string")
    ind = [F.when(v == F.lit(c), F.lit(1)).otherwise(F.lit(0)).alias(f"{col}_{c}") for c in categories]
    keep = [q(c) for c in df.columns if not (drop_source and c == col)]
    return df.select(*keep, *ind)


def fit_class_weights(df: DataFrame, label: str) -> DataFrame:
    """Balanced class weights ``n / (k * n_c)`` as ``(label, n, weight)``; 1.0 each if one class only."""
    counts = df.where(q(label).isNotNull()).groupBy(q(label).alias("label")).agg(F.count(F.lit(1)).alias("n"))
    whole = counts.agg(F.count(F.lit(1)).alias("k"), F.sum("n").alias("total")).first()  # two numbers
    weight = F.lit(whole["total"] or 0).cast("double") / (F.lit(whole["k"]) * F.col("n")) if whole["k"] >= 2 else F.lit(1.0)
    return counts.select("label", "n", weight.alias("weight"))


def apply_class_weights(df: DataFrame, label: str, weights: DataFrame, out: str = "weight") -> DataFrame:
    """Attach each row's class weight (a join with one row per class; Spark broadcasts it by size)."""
    w = weights.select(F.col("label").alias("_lbl"), F.col("weight").alias(out))
    return df.join(w, q(label) == F.col("_lbl"), "left").drop("_lbl")


def class_presence(df: DataFrame, label: str) -> DataFrame:
    """``n_classes`` and whether training is possible (at least two classes)."""
    return df.agg(F.count_distinct(q(label)).alias("n_classes")).select(
        "n_classes", (F.col("n_classes") >= 2).cast("int").alias("can_train")
    )


def profile_numeric(df: DataFrame, cols: Iterable[str], **kw) -> DataFrame:
    """Per feature: min, max and exact median over non-NULL, non-NaN values.

    Min and max come from the selection's own first aggregate: no extra pass.
    """
    cols = list(cols)
    st = _column_stats(df, cols, **kw)
    rows = [(c, st[c][1], st[c][2], st[c][4]) for c in cols]
    return df.sparkSession.createDataFrame(rows, "feature string, min double, max double, median double")


def prune_constant(df: DataFrame, cols: Iterable[str]) -> DataFrame:
    """``(feature, varying)``: 0 when a column has at most one distinct non-NULL value.

    One aggregate of min and max per column (cheaper than counting distinct values).
    """
    cols = list(cols)
    aggs = []
    for c in cols:
        v = nan_to_null(q(c)) if _is_floating(df, c) else q(c)
        aggs += [F.min(v).alias(f"lo_{c}"), F.max(v).alias(f"hi_{c}")]
    wide = df.agg(*aggs)
    arr = F.array(
        *[
            F.struct(
                F.lit(c).alias("feature"),
                (~F.col(f"`lo_{c}`").eqNullSafe(F.col(f"`hi_{c}`"))).cast("int").alias("varying"),
            )
            for c in cols
        ]
    )
    return wide.select(F.inline(arr))


def drift_monitor(df: DataFrame, cols: Iterable[str], split_col: str, base: str, other: str, **kw) -> DataFrame:
    """Per feature: mean and exact median in two splits and their differences (``other - base``).

    Means come from the selection's first aggregate (sum / count): one pass for both.
    """
    cols = list(cols)
    lf = (
        df.where(F.col(split_col).isin(base, other))
        .select(F.col(split_col).alias("split"), F.inline(F.array(*[
            F.struct(F.lit(c).alias("feature"), nan_to_null(q(c).cast("double")).alias("value")) for c in cols])))
        .where(F.col("value").isNotNull())
        .withColumn("grp", F.concat_ws("|", "split", "feature"))
    )
    res = select_ranks(lf, "value", lambda _g, n: sorted({(n - 1) // 2, n // 2}), group="grp", **kw)

    def stats(split: str, c: str):
        g = f"{split}|{c}"
        n = res.counts.get(g, 0)
        if n == 0:
            return None, None
        lo, hi = res.get((n - 1) // 2, g), res.get(n // 2, g)
        return res.sums[g] / n, (float(lo[0]) + float(hi[0])) / 2.0

    rows = []
    for c in cols:
        mb, db = stats(base, c)
        mo, do = stats(other, c)
        diff = (lambda a, b: None if a is None or b is None else b - a)
        rows.append((c, mb, mo, diff(mb, mo), db, do, diff(db, do)))
    return df.sparkSession.createDataFrame(
        rows,
        "feature string, mean_base double, mean_other double, mean_shift double, "
        "median_base double, median_other double, median_shift double",
    )


def drift_distances(df: DataFrame, cols: Iterable[str], split_col: str, base: str, other: str, cells: int = 10, least_share: float = 1e-4) -> DataFrame:
    """Per feature how far the distribution in split ``other`` is from the one in ``base``.

    ``n_*`` finite values, ``null_*`` missing ones (NaN too), ``inf_*`` infinite ones, per split; over the finite values

    * ``ks``: the largest difference of the two distribution functions (Kolmogorov-Smirnov),
    * ``wasserstein``: the area between them, in the feature's unit,
    * ``psi``: population stability over ``cells`` quantile cells of the base split.  A value's cell is its
      base rank (rows strictly below) times ``cells`` over the base size, rounded down, so ties stay together; shares count as ``least_share`` at least.

    The distances are NULL where a split has no finite value.  One merged ranking of both splits: values
    collapse to (feature, value, base count, other count), then one prefix scan per feature, without a sort in one task.
    """
    cols = list(cols)
    inf = F.lit(float("inf"))
    side = F.col("split") == base
    long = df.where(F.col(split_col).isin(base, other)).select(
        F.col(split_col).alias("split"),
        F.inline(F.array(*[F.struct(F.lit(c).alias("feature"), nan_to_null(q(c).cast("double")).alias("value")) for c in cols])),
    )
    finite = F.abs("value") < inf
    counts = long.groupBy("feature").agg(
        *(
            F.count_if(cond & at).alias(f"{name}_{split}")
            for split, at in (("base", side), ("other", ~side))
            for name, cond in (("n", F.coalesce(finite, F.lit(False))), ("null", F.col("value").isNull()), ("inf", F.coalesce(F.abs("value") == inf, F.lit(False))))
        )
    )
    per = long.where(finite).groupBy("feature", (F.col("value") + 0.0).alias("value")).agg(F.count_if(side).alias("b"), F.count_if(~side).alias("o"))
    ranked = running_totals(per, "value", ["b", "o"], ["feature"]).where("b_total > 0 AND o_total > 0")
    apart = F.abs((F.col("b_below") + F.col("b")) / F.col("b_total") - (F.col("o_below") + F.col("o")) / F.col("o_total"))
    cell = F.least(F.lit(cells - 1), F.floor(F.col("b_below") * cells / F.col("b_total"))).cast("int")
    by_cell = ranked.groupBy("feature", cell.alias("cell")).agg(
        F.max(apart).alias("ks"),
        F.sum(apart * F.coalesce(F.col("value_next") - F.col("value"), F.lit(0.0))).alias("area"),
        F.greatest(F.sum("b") / F.max("b_total"), F.lit(least_share)).alias("pb"),
        F.greatest(F.sum("o") / F.max("o_total"), F.lit(least_share)).alias("po"),
    )  # at most ``cells`` rows a feature; cells without a value have no row
    far = by_cell.groupBy("feature").agg(
        F.max("ks").alias("ks"), F.sum("area").alias("wasserstein"), F.sum((F.col("po") - F.col("pb")) * F.log(F.col("po") / F.col("pb"))).alias("psi")
    )
    return counts.join(far, "feature", "left")


# ------------------------------------------------- categories without a limit


def fit_dictionary(df: DataFrame, cols: Iterable[str]) -> DataFrame:
    """``(feature, value, index, size)``: every non-NULL category's dense index in sorted order, and how many there are.

    The dictionary is data: values are counted, range partitioned and numbered by a prefix scan, however many
    there are; nothing of it passes through the driver.
    """
    arr = F.array(*[F.struct(F.lit(c).alias("feature"), q(c).cast("string").alias("value")) for c in cols])
    values = df.select(F.inline(arr)).where(F.col("value").isNotNull()).groupBy("feature", "value").agg(F.lit(1).cast("long").alias("one"))
    numbered = running_totals(values, "value", ["one"], ["feature"])
    return numbered.select("feature", "value", F.col("one_below").alias("index"), F.col("one_total").alias("size"))


def index_categories(df: DataFrame, cols: Iterable[str], dictionary: DataFrame) -> DataFrame:
    """``df`` with ``<col>_index`` per column; unknown and NULL categories have NULL.

    A lookup join per column: Spark broadcasts a short dictionary and shuffles a long one, whose hot values AQE splits."""
    for c in cols:
        known = dictionary.where(F.col("feature") == c).select(F.col("value").alias("_value"), F.col("index").alias(f"{c}_index"))
        df = lookup_join(df.withColumn("_value", q(c).cast("string")), known, "_value", how="left").drop("_value")
    return df


def one_hot_sparse(df: DataFrame, cols: Iterable[str], dictionary: DataFrame, out: str = "features") -> DataFrame:
    """``df`` with a sparse 0/1 vector of all columns' categories (blocks in the order of ``cols``); unknown ones are all zeros.

    The vector's entries are indices, so 100,000 categories cost a row no more than ten.  Only the sizes (one row a
    feature) reach the driver."""
    from pyspark.ml.feature import OneHotEncoder, VectorAssembler

    cols = list(cols)
    sizes = {r["feature"]: r["size"] for r in dictionary.groupBy("feature").agg(F.max("size").alias("size")).collect()}
    held = index_categories(df, cols, dictionary)
    spark, parts = df.sparkSession, []
    for c in cols:
        n = sizes.get(c, 0)
        if not n:
            continue
        # an encoder is its size alone: fitted on one row that holds the slot of the unknown
        top = spark.createDataFrame([(float(n),)], "x double")
        encoder = OneHotEncoder(inputCol="x", outputCol="y", dropLast=True).fit(top)
        encoder = encoder.copy({encoder.inputCol: f"_{c}_at", encoder.outputCol: f"_{c}_hot"})
        held = encoder.transform(held.withColumn(f"_{c}_at", F.coalesce(F.col(f"`{c}_index`"), F.lit(n)).cast("double")))
        parts.append(f"_{c}_hot")
    drop = [x for c in cols for x in (f"{c}_index", f"_{c}_at", f"_{c}_hot")]
    return VectorAssembler(inputCols=parts, outputCol=out).transform(held).drop(*drop)
