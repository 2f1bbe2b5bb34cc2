"""Loan repayment: engineer features -> range split -> fitted preparation -> weighted logistic model.

The preparation (median impute + scale without centring for numbers, mode
impute + sorted one-hot for the category) is fitted on the train range only
and applied to every row as plain Column expressions; its state is a handful
of literals.  Splits are key boundaries, so train/eval/live are range filters.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratum.functions import clean as C
from stratum.functions import dates as D
from stratum.operators import evaluate as E
from stratum.operators import fitstate as S
from stratum.operators import models as M
from stratum.operators.split import split_fraction
from stratum.session import cut_lineage
from stratum.sources import fixtures

KEY = "loan_id"
TARGET = "label"
CATEGORY = "pcircle"
# The derived ratio features, (name, numerator, denominator).
RATIOS = (
    ("payback_rate30", "payback30", "cnt_loans30"),
    ("payback_rate90", "payback90", "cnt_loans90"),
    ("avg_loan_amt30", "amnt_loans30", "cnt_loans30"),
    ("avg_loan_amt90", "amnt_loans90", "cnt_loans90"),
    ("avg_rech_amt30", "sumamnt_ma_rech30", "cnt_ma_rech30"),
    ("avg_rech_amt90", "sumamnt_ma_rech90", "cnt_ma_rech90"),
)


def engineer_features(df: DataFrame, key: str = KEY, target: str = TARGET, passthrough: tuple = ()) -> DataFrame:
    """Drop target and identifier, coerce numbers, parse the date, add calendar parts, day of year, ratios.

    One projection.  Dates are parsed before numeric coercion (the reference
    coerced first and lost them).  ``passthrough`` columns (e.g. the split and
    the target) are carried unchanged at the end.
    """
    base = C.drop_identifiers(df, target=target, ids=["msisdn"])
    cols = [c for c in base.columns if c not in (key, CATEGORY, "pdate", *passthrough)]
    out = [C.q(key)] + [C.to_numeric(C.q(c)).alias(c) for c in cols]
    if CATEGORY in base.columns:
        out.append(C.q(CATEGORY).cast("string").alias(CATEGORY))
    if "pdate" in base.columns:
        d = D.parse_date_multi(C.q("pdate"))
        out += [e.cast("double").alias(n) for n, e in D.calendar_part_exprs(d, "pdate")]
    if {"last_rech_date_ma", "last_rech_date_da"} <= set(base.columns):
        out.append(D.day_of_year(C.q("last_rech_date_ma"), C.q("last_rech_date_da")).cast("double").alias("last_rech_dayofyear"))
    for name, a, b in RATIOS:
        if {a, b} <= set(base.columns):
            out.append(C.safe_ratio(C.q(a), C.q(b)).alias(name))
    out += [C.q(c) for c in passthrough]
    return df.select(*out)


@dataclass
class Prepared:
    frame: DataFrame  # key, split, numeric features (imputed, scaled), one-hot columns, target
    numeric: list[str]
    onehot: list[str]


@dataclass
class LoanState:
    """Fitted preparation state: one value per feature plus the category list (all of it data)."""

    numeric: list[str]
    medians: dict
    stds: dict
    mode: str | None
    categories: list[str]

    def to_frame(self, spark: SparkSession) -> DataFrame:
        rows = [("numeric", c, self.medians.get(c), self.stds.get(c), None) for c in self.numeric]
        rows.append(("mode", CATEGORY, None, None, self.mode))
        rows += [("category", CATEGORY, None, None, v) for v in self.categories]
        return spark.createDataFrame(
            [(i, *r) for i, r in enumerate(rows)],
            "pos int, kind string, feature string, median double, std double, text string",
        )

    @staticmethod
    def from_frame(df: DataFrame) -> "LoanState":
        rows = sorted(df.collect(), key=lambda r: r["pos"])  # one row per feature or category
        num = [r for r in rows if r["kind"] == "numeric"]
        mode = next((r["text"] for r in rows if r["kind"] == "mode"), None)
        cats = [r["text"] for r in rows if r["kind"] == "category"]
        return LoanState(
            [r["feature"] for r in num], {r["feature"]: r["median"] for r in num},
            {r["feature"]: r["std"] for r in num}, mode, cats,
        )


def loan_split(spark: SparkSession, sf_dir: str, train_frac: float = 0.6, eval_frac: float = 0.2) -> DataFrame:
    # the adapter aggregates all orders; materialise it once for the split and the fits
    raw = cut_lineage(fixtures.loans(spark, sf_dir))
    return split_fraction(raw, KEY, train_frac, eval_frac, min_train=1)


def fit_state(split_df: DataFrame) -> LoanState:
    """Medians, population std of the imputed values, mode and sorted categories, from the train range."""
    eng = engineer_features(split_df, passthrough=("split", TARGET))
    numeric = [c for c in eng.columns if c not in (KEY, "split", TARGET, CATEGORY)]
    train = eng.where(F.col("split") == "train")
    med = S.state_dict(S.fit_median(train, numeric), "feature", "median")
    filled = S.apply_fill(train, {c: med.get(c) for c in numeric})
    stds = S.state_dict(S.fit_scale(filled, numeric), "feature", "std")
    cats, mode = S.fit_category_state(train, CATEGORY)
    return LoanState(numeric, med, stds, mode, cats)


def apply_state(df: DataFrame, state: LoanState, passthrough: tuple = ("split", TARGET)) -> Prepared:
    """Engineer, align to the fitted feature list, impute, scale (no centring), impute and one-hot the category."""
    keep = tuple(c for c in passthrough if c in df.columns)
    eng = engineer_features(df, passthrough=keep)
    have = set(eng.columns)
    eng = eng.select(
        *[C.q(c) for c in eng.columns if c not in state.numeric],
        *[(C.q(c) if c in have else F.lit(None).cast("double").alias(c)) for c in state.numeric],
    )
    filled = S.apply_fill(eng, {c: state.medians.get(c) for c in state.numeric})
    scaled = filled.select(
        *[
            ((C.q(c) / F.lit(state.stds.get(c) or 1.0)).alias(c) if c in state.numeric else C.q(c))
            for c in filled.columns
        ]
    )
    cat = scaled.withColumn(CATEGORY, F.coalesce(C.q(CATEGORY), F.lit(state.mode)))
    out = S.apply_one_hot(cat, CATEGORY, state.categories)
    return Prepared(out, state.numeric, [f"{CATEGORY}_{c}" for c in state.categories])


def prepare(split_df: DataFrame) -> Prepared:
    """Fit imputation, scaling and one-hot on the train range; apply to all rows."""
    return apply_state(split_df, fit_state(split_df))


def fit_loan_model(prep: Prepared, reg: float = 1e-4) -> PipelineModel:
    """Balanced, L2-regularised logistic regression on the train range."""
    train = prep.frame.where(F.col("split") == "train")
    weights = S.fit_class_weights(train, TARGET)
    train = S.apply_class_weights(train, TARGET, weights)
    feats = prep.numeric + prep.onehot
    return M.fit([M.assembler(feats), M.logistic(TARGET, "weight", reg=reg, max_iter=2000, tol=1e-3)], train)


def loan_eval(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Metrics of the fitted model on the eval range (threshold 0.5 on P(eligible))."""
    prep = prepare(loan_split(spark, sf_dir))
    model = fit_loan_model(prep)
    ev = M.score(model, prep.frame.where(F.col("split") == "eval"), keep=[KEY, TARGET], threshold=0.5)
    return E.evaluate_scores(ev, TARGET, "probability", 0.5)


def loan_score_live(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Score the live range: key, prediction, probability."""
    prep = prepare(loan_split(spark, sf_dir))
    model = fit_loan_model(prep)
    return M.score(model, prep.frame.where(F.col("split") == "live"), keep=[KEY], threshold=0.5)


# --------------------------------------------------------- train job / score job


def train_and_save(spark: SparkSession, sf_dir: str, out_dir: str) -> dict:
    """Job 1: fit on the train range, evaluate on the eval range, save model, state and metadata."""
    from stratum.sources import sinks as K

    sp = loan_split(spark, sf_dir)
    state = fit_state(sp)
    prep = apply_state(sp, state)
    model = fit_loan_model(prep)
    ev = M.score(model, prep.frame.where(F.col("split") == "eval"), keep=[KEY, TARGET], threshold=0.5)
    metrics = E.evaluate_scores(ev, TARGET, "probability", 0.5).first().asDict()
    counts = {r["split"]: r["count"] for r in sp.groupBy("split").count().collect()}  # three rows
    base = out_dir.rstrip("/")
    model.write().overwrite().save(f"{base}/model")
    state.to_frame(spark).write.mode("overwrite").parquet(f"{base}/state")
    record = {
        "table_name": "loans", "target": TARGET, "row_count": sum(counts.values()),
        "train_rows": counts.get("train", 0), "eval_rows": counts.get("eval", 0),
        "live_offset": counts.get("train", 0) + counts.get("eval", 0), "seed": 42,
    }
    K.write_metadata(spark, f"{base}/metadata", record, metrics)
    return {**record, **metrics}


def score_saved(spark: SparkSession, sf_dir: str, out_dir: str, max_rows: int | None = None) -> DataFrame:
    """Job 2: rows from the saved live offset (exactly ``max_rows`` at most), scored and written as CSV."""
    from stratum.operators.split import scan_tail
    from stratum.sources import sinks as K

    base = out_dir.rstrip("/")
    offset = K.read_live_offset(spark, f"{base}/metadata")
    state = LoanState.from_frame(spark.read.parquet(f"{base}/state"))
    model = PipelineModel.load(f"{base}/model")
    live = scan_tail(fixtures.loans(spark, sf_dir), KEY, offset, max_rows)
    prep = apply_state(live, state, passthrough=())
    scored = M.score(model, prep.frame, keep=[KEY], threshold=0.5)
    path = K.write_predictions(scored, f"{base}/predictions")
    return spark.read.schema("loan_id long, prediction int, probability double").options(**K.CSV_OPTIONS).csv(path)
