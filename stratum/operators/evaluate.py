"""Evaluation: confusion counts, binary metrics, class report, exact ROC AUC.

Counts are one aggregate of four ``count_if`` (algebraic: partial aggregation
on every task, a single tiny final merge), so evaluating in chunks and
concatenating, as the reference does, is just this aggregate.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratum.operators.prefix_scan import running_totals


def _div0(a: Column, b: Column) -> Column:
    """a / b as DOUBLE, 0 when b is 0."""
    return F.coalesce(F.try_divide(a.cast("double"), b.cast("double")), F.lit(0.0))


def confusion_matrix(df: DataFrame, label: str = "label", pred: str = "prediction") -> DataFrame:
    """One row ``tn, fp, fn, tp`` (always 2x2 with labels fixed to 0/1)."""
    y, p = F.col(label), F.col(pred)
    return df.agg(
        F.count_if((y == 0) & (p == 0)).alias("tn"),
        F.count_if((y == 0) & (p == 1)).alias("fp"),
        F.count_if((y == 1) & (p == 0)).alias("fn"),
        F.count_if((y == 1) & (p == 1)).alias("tp"),
    )


def metrics_from_counts(cm: DataFrame) -> DataFrame:
    """Accuracy, precision, recall, F1 of class 1 from ``tn, fp, fn, tp``; zero denominators -> 0."""
    tn, fp, fn, tp = (F.col(c) for c in ("tn", "fp", "fn", "tp"))
    prec = _div0(tp, tp + fp)
    rec = _div0(tp, tp + fn)
    return cm.select(
        "*",
        _div0(tp + tn, tn + fp + fn + tp).alias("accuracy"),
        prec.alias("precision"),
        rec.alias("recall"),
        _div0(2 * prec * rec, prec + rec).alias("f1"),
    )


def binary_metrics(df: DataFrame, label: str = "label", pred: str = "prediction") -> DataFrame:
    return metrics_from_counts(confusion_matrix(df, label, pred))


def classification_report(cm: DataFrame) -> DataFrame:
    """Rows ``class, precision, recall, f1, support`` for '0', '1', 'accuracy', 'macro avg', 'weighted avg'.

    The 'accuracy' row carries accuracy in precision/recall/f1 and the total support.
    """
    tn, fp, fn, tp = (F.col(c) for c in ("tn", "fp", "fn", "tp"))
    p1, r1 = _div0(tp, tp + fp), _div0(tp, tp + fn)
    p0, r0 = _div0(tn, tn + fn), _div0(tn, tn + fp)
    f1_1, f1_0 = _div0(2 * p1 * r1, p1 + r1), _div0(2 * p0 * r0, p0 + r0)
    s1, s0 = (tp + fn).cast("double"), (tn + fp).cast("double")
    n = s0 + s1
    acc = _div0(tp + tn, n)

    def row(name, p, r, f, s):
        return F.struct(F.lit(name).alias("class"), p.alias("precision"), r.alias("recall"), f.alias("f1"), s.alias("support"))

    rows = F.array(
        row("0", p0, r0, f1_0, s0),
        row("1", p1, r1, f1_1, s1),
        row("accuracy", acc, acc, acc, n),
        row("macro avg", (p0 + p1) / 2, (r0 + r1) / 2, (f1_0 + f1_1) / 2, n),
        row(
            "weighted avg",
            _div0(p0 * s0 + p1 * s1, n),
            _div0(r0 * s0 + r1 * s1, n),
            _div0(f1_0 * s0 + f1_1 * s1, n),
            n,
        ),
    )
    return cm.select(F.inline(rows))


def _ranked(df: DataFrame, label: str, score: str) -> DataFrame:
    """``s, pos, neg`` per distinct score with what lies below it and in all: ``pos_below``, ``neg_total`` and so on."""
    y = F.col(label)
    per = (
        df.where(F.col(score).isNotNull() & y.isNotNull())
        .groupBy(F.col(score).cast("double").alias("s"))
        .agg(F.count_if(y == 1).alias("pos"), F.count_if(y != 1).alias("neg"))
    )
    return running_totals(per, "s", ["pos", "neg"])


def _auc_expr() -> Column:
    return F.when(
        (F.col("P") > 0) & (F.col("N") > 0), F.col("num") / (F.col("P").cast("double") * F.col("N"))
    ).alias("roc_auc")


def roc_auc(df: DataFrame, label: str = "label", score: str = "probability") -> DataFrame:
    """Exact, tie-aware area under the ROC curve; NULL when a class is absent.

    ``AUC = sum_s pos(s) * (neg(< s) + neg(s) / 2) / (P * N)`` over distinct scores.
    """
    ranked = _ranked(df, label, score)
    agg = ranked.agg(
        F.sum(F.col("pos") * (F.col("neg_below").cast("double") + F.col("neg") / 2.0)).alias("num"),
        F.sum("pos").alias("P"),
        F.sum("neg").alias("N"),
    )
    return agg.select(_auc_expr())


def evaluate_scores(df: DataFrame, label: str, score: str, threshold: float = 0.5) -> DataFrame:
    """One row: confusion counts at ``score >= threshold``, accuracy/precision/recall/F1 and ROC AUC.

    Everything comes from the collapsed ``(score, pos, neg)`` rows, so chunked
    evaluation and concatenation reduce to this one aggregate.
    """
    ranked = _ranked(df, label, score)
    hit = F.col("s") >= F.lit(threshold)
    agg = ranked.agg(
        F.sum(F.col("pos") * (F.col("neg_below").cast("double") + F.col("neg") / 2.0)).alias("num"),
        F.sum("pos").alias("P"),
        F.sum("neg").alias("N"),
        F.coalesce(F.sum(F.when(~hit, F.col("neg"))), F.lit(0)).alias("tn"),
        F.coalesce(F.sum(F.when(hit, F.col("neg"))), F.lit(0)).alias("fp"),
        F.coalesce(F.sum(F.when(~hit, F.col("pos"))), F.lit(0)).alias("fn"),
        F.coalesce(F.sum(F.when(hit, F.col("pos"))), F.lit(0)).alias("tp"),
    )
    return metrics_from_counts(agg.select("tn", "fp", "fn", "tp", _auc_expr()))


def score_curve(df: DataFrame, label: str = "label", score: str = "probability") -> DataFrame:
    """The whole ROC and precision-recall curve: per distinct score ``threshold, tn, fp, fn, tp`` and the metrics
    of predicting 1 for ``score >= threshold``.  Rows without a score or a label are left out; NaN is the largest score."""
    ranked = _ranked(df, label, score)
    return metrics_from_counts(
        ranked.select(
            F.col("s").alias("threshold"),
            F.col("neg_below").alias("tn"),
            (F.col("neg_total") - F.col("neg_below")).alias("fp"),
            F.col("pos_below").alias("fn"),
            (F.col("pos_total") - F.col("pos_below")).alias("tp"),
        )
    )


def threshold_by_cost(curve: DataFrame, costs: list[tuple[float, float]]) -> DataFrame:
    """The cheapest threshold of a ``score_curve`` for each (cost of a false positive, cost of a false negative).

    Exact over all distinct scores.  Predicting nothing is a candidate too, with a NULL threshold; of equally
    cheap ones it wins, then the highest threshold.  One aggregate over the curve, no sort.  An empty curve
    gives no rows.
    """
    counts = ["threshold", "tn", "fp", "fn", "tp"]
    # nothing predicted: what the lowest threshold calls positive becomes negative
    none = curve.agg(F.max(F.col("tn") + F.col("fp")).alias("n"), F.max(F.col("fn") + F.col("tp")).alias("p")).where("n IS NOT NULL")
    none = none.select(F.lit(None).cast("double").alias("threshold"), F.col("n").alias("tn"), F.lit(0).cast("long").alias("fp"), F.col("p").alias("fn"), F.lit(0).cast("long").alias("tp"))
    every = curve.select(*counts).unionByName(none)

    def best(fp_cost: float, fn_cost: float) -> Column:
        cost = F.col("fp") * F.lit(float(fp_cost)) + F.col("fn") * F.lit(float(fn_cost))
        order = F.struct(-cost, F.col("threshold").isNull(), "threshold")
        return F.max_by(F.struct(F.lit(float(fp_cost)).alias("fp_cost"), F.lit(float(fn_cost)).alias("fn_cost"), *counts, cost.alias("cost")), order)

    wide = every.agg(F.count(F.lit(1)).alias("_n"), *(best(*c).alias(f"_{i}") for i, c in enumerate(costs))).where("_n > 0")
    return metrics_from_counts(wide.select(F.inline(F.array(*(F.col(f"_{i}") for i in range(len(costs)))))))


def threshold_by_recall(curve: DataFrame, recalls: list[float]) -> DataFrame:
    """The highest threshold of a ``score_curve`` that reaches each recall; a recall that none reaches has no row.

    A recall is reached when ``tp >= recall * (tp + fn)`` and there are positives.
    """
    counts = ["threshold", "tn", "fp", "fn", "tp"]

    def best(recall: float) -> Column:
        found = (F.col("tp") + F.col("fn") > 0) & (F.col("tp") >= F.lit(float(recall)) * (F.col("tp") + F.col("fn")))
        return F.max_by(F.struct(F.lit(float(recall)).alias("target"), *counts), F.when(found, F.struct("threshold")))

    wide = curve.agg(*(best(r).alias(f"_{i}") for i, r in enumerate(recalls)))
    rows = wide.select(F.explode(F.array(*(F.col(f"_{i}") for i in range(len(recalls))))).alias("r")).where("r IS NOT NULL")
    return metrics_from_counts(rows.select("r.*"))


def status_summary(df: DataFrame, fraud: str = "isFraud", flagged: str = "isFlaggedFraud") -> DataFrame:
    """Non-fraud / fraud counts, fraud rate among labelled rows, flagged count and rate over all rows.

    Missing columns count as zeros.
    """
    from stratum.functions.clean import flag_int, q

    f = flag_int(q(fraud)) if fraud in df.columns else F.lit(0)
    g = flag_int(q(flagged)) if flagged in df.columns else F.lit(0)
    has_f = fraud in df.columns
    agg = df.agg(
        F.count(F.lit(1)).alias("total"),
        (F.count_if(f == 0) if has_f else F.lit(0).cast("bigint")).alias("non_fraud"),
        F.count_if(f == 1).alias("fraud"),
        F.count_if(g == 1).alias("flagged"),
    )
    return agg.select(
        "total",
        "non_fraud",
        "fraud",
        _div0(F.col("fraud"), F.col("fraud") + F.col("non_fraud")).alias("fraud_rate"),
        "flagged",
        _div0(F.col("flagged"), F.col("total")).alias("flagged_rate"),
    )


def threshold_sweep(df: DataFrame, label: str, score: str, thresholds: list[float]) -> DataFrame:
    """Confusion counts and metrics at each threshold of a fixed grid.

    One pass: for every grid value the aggregate counts positives and
    negatives scoring at or above it (partial aggregation per task); the
    single result row is then unpivoted to one row per threshold.
    """
    y = F.col(label)
    s_ = F.col(score)
    grid = sorted({float(t) for t in thresholds})
    aggs = [F.count_if(y == 1).alias("P"), F.count_if(y != 1).alias("N")]
    for i, t in enumerate(grid):
        aggs.append(F.count_if((y == 1) & (s_ >= F.lit(t))).alias(f"tp{i}"))
        aggs.append(F.count_if((y != 1) & (s_ >= F.lit(t))).alias(f"fp{i}"))
    wide = df.where(s_.isNotNull() & y.isNotNull()).agg(*aggs)
    rows = F.array(
        *[
            F.struct(
                F.lit(t).alias("threshold"),
                (F.col("N") - F.col(f"fp{i}")).alias("tn"),
                F.col(f"fp{i}").alias("fp"),
                (F.col("P") - F.col(f"tp{i}")).alias("fn"),
                F.col(f"tp{i}").alias("tp"),
            )
            for i, t in enumerate(grid)
        ]
    )
    long = wide.select(F.inline(rows))
    return metrics_from_counts(long)
