"""Cleaning and coercion: Column expressions and one-projection DataFrame operators.

All of these compile to a single ``Project``/``Filter`` inside whole-stage
codegen; nothing leaves the JVM.  Dirty input never throws under ANSI mode
(``try_cast``/``try_divide`` everywhere).
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stratum.functions.text import has_text

INF = float("inf")

# Fixed values of the reference's data contracts.
# Columns that are administrative, never model features (fault detection).
ADMIN_COLUMNS = ("time", "stage", "Lot", "runnum", "recipe", "recipe_step")
# Identifier columns dropped before modelling.
IDENTIFIER_COLUMNS = ("msisdn", "nameOrig", "nameDest")
# Label text accepted by the news cleaner: true/1 -> 1, false/0 -> 0, anything else -> null.
LABEL_TEXT_MAP = {"true": 1, "1": 1, "false": 0, "0": 0}
# Display names of the two classes per application.
CLASS_NAMES = {
    "sentiment": ("negative", "positive"),
    "loan": ("Not eligible", "Eligible"),
    "news": ("Fake", "Factual"),
    "fraud": ("Non-fraud", "Fraud"),
}


def q(name: str) -> Column:
    """A column by exact name (names may hold spaces, dots or mixed case)."""
    return F.col(f"`{name}`")


# Python's white space (Java's ``\\s`` is ASCII only), for a character class.
SPACE = r"[\s\p{Z}\x1c-\x1f\x85]"


def strip(c: Column) -> Column:
    """Python ``str.strip()``: remove leading and trailing Unicode whitespace."""
    return F.regexp_replace(c, rf"^{SPACE}+|{SPACE}+$", "")


def nan_to_null(c: Column) -> Column:
    return F.when(F.isnan(c), F.lit(None)).otherwise(c)


# What counts as a number in text (Spark's cast also takes Java suffixes and hex).
NUMBER_TEXT = rf"(?i)^{SPACE}*[+-]?(\d+\.?\d*(e[+-]?\d+)?|\.\d+(e[+-]?\d+)?|inf|infinity){SPACE}*$"


def to_numeric(c: Column) -> Column:
    """Text or number to DOUBLE; anything unparseable, NaN or empty becomes NULL."""
    text = c.cast("string")
    number = nan_to_null(c.try_cast("double"))
    return F.when(F.typeof(c) != "string", number).when(text.rlike(NUMBER_TEXT), nan_to_null(strip(text).try_cast("double")))


def inf_to_null(c: Column) -> Column:
    """+-inf to NULL (equality test: Spark orders NaN above +inf)."""
    return F.when(F.abs(c) == F.lit(INF), F.lit(None)).otherwise(c)


def label_normalize(c: Column, mapping: Mapping[str, int] = LABEL_TEXT_MAP) -> Column:
    """Strip, lower-case, map through ``mapping``; unmapped text becomes NULL."""
    t = F.lower(strip(c.cast("string")))
    out = None
    for k, v in mapping.items():
        out = (F.when(t == F.lit(k), F.lit(v)) if out is None else out.when(t == F.lit(k), F.lit(v)))
    return out.cast("int")


def label_from_rating(c: Column, pos_at: int = 7, neg_at: int = 4) -> Column:
    """Rating to sentiment: >= pos_at -> 1, <= neg_at -> 0, neutral -> -1 (to be dropped)."""
    return F.when(c >= pos_at, F.lit(1)).when(c <= neg_at, F.lit(0)).otherwise(F.lit(-1)).cast("int")


def label_binarize(c: Column) -> Column:
    """Coerce to a number, NULL -> 0, then ``> 0`` -> 1 else 0."""
    return (F.coalesce(to_numeric(c), F.lit(0.0)) > 0).cast("int")


def flag_int(c: Column) -> Column:
    """A flag coerced to int: number first, then truncated; unparseable or NULL -> 0."""
    return F.coalesce(to_numeric(c).try_cast("bigint").try_cast("int"), F.lit(0))


def decode_label(c: Column, names: tuple[str, str]) -> Column:
    """1 / 0 to the application's class names."""
    return F.when(c == 1, F.lit(names[1])).when(c == 0, F.lit(names[0]))


def class_confidence(pred: Column, prob1: Column) -> Column:
    """Probability of the predicted class (not of class 1)."""
    return F.when(pred == 1, prob1).otherwise(F.lit(1.0) - prob1)


def safe_ratio(num: Column, den: Column) -> Column:
    """``num / den``; NULL when the denominator is NULL or 0."""
    return F.try_divide(to_numeric(num), to_numeric(den))


def threshold(prob: Column, t: float = 0.5) -> Column:
    return (prob >= F.lit(t)).cast("int")


def round_probability(c: Column, places: int = 6) -> Column:
    return F.round(c, places)


# ---------------------------------------------------------------- DataFrame ops


def lower_columns(df: DataFrame, drop_index: str = "unnamed: 0") -> DataFrame:
    """Lower-case all column names and drop the pandas index column."""
    out = df.toDF(*[c.lower() for c in df.columns])
    return out.drop(drop_index) if drop_index in out.columns else out


def drop_identifiers(df: DataFrame, target: str | None = None, ids: Iterable[str] = IDENTIFIER_COLUMNS) -> DataFrame:
    drop = [c for c in [*(ids or []), *([target] if target else [])] if c in df.columns]
    return df.drop(*drop)


def align_schema(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Add missing columns as typed NULL, drop extras, restore the fitted order.

    Present columns are coerced to the fitted type with ``try_cast`` (dirty
    values become NULL instead of failing the job under ANSI mode).
    """
    have = set(df.columns)
    return df.select(
        *[
            (q(f.name).try_cast(f.dataType) if f.name in have else F.lit(None).cast(f.dataType)).alias(f.name)
            for f in schema.fields
        ]
    )


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)]


def candidate_features(
    df: DataFrame,
    target: str,
    numeric_only: bool = True,
    include_admin: bool = False,
    admin: Iterable[str] = ADMIN_COLUMNS,
) -> list[str]:
    """Feature columns: numeric (unless ``numeric_only=False``), minus the target and admin columns.

    ``time`` is kept when admin columns are included, numeric or not.
    """
    admin = set(admin)
    out = []
    for f in df.schema.fields:
        if f.name == target:
            continue
        if f.name in admin and not include_admin:
            continue
        numeric = isinstance(f.dataType, T.NumericType)
        if numeric_only and not numeric and not (include_admin and f.name == "time"):
            continue
        out.append(f.name)
    return out


def select_numeric(df: DataFrame, target: str) -> DataFrame:
    """Project to the numeric non-admin feature columns plus the target."""
    cols = candidate_features(df, target)
    return df.select(*[q(c) for c in cols], q(target))


def coerce_numeric(df: DataFrame, cols: Iterable[str]) -> DataFrame:
    """``to_numeric`` over the named columns, others untouched, order kept."""
    cols = set(cols)
    return df.select(*[(to_numeric(q(c)).alias(c) if c in cols else q(c)) for c in df.columns])


def replace_inf(df: DataFrame, cols: Iterable[str] | None = None) -> DataFrame:
    """``inf_to_null`` over floating columns (all of them by default)."""
    floats = {f.name for f in df.schema.fields if isinstance(f.dataType, (T.DoubleType, T.FloatType))}
    cols = floats if cols is None else set(cols) & floats
    return df.select(*[(inf_to_null(q(c)).alias(c) if c in cols else q(c)) for c in df.columns])


def fill_defaults(df: DataFrame, defaults: Mapping[str, object], schema: T.StructType | None = None) -> DataFrame:
    """Absent fields take a default: a missing column is added, a NULL value replaced."""
    out = df
    for name, value in defaults.items():
        if name in out.columns:
            out = out.withColumn(name, F.coalesce(q(name), F.lit(value)))
        else:
            out = out.withColumn(name, F.lit(value))
    return out


def drop_nulls(df: DataFrame, cols: Iterable[str]) -> DataFrame:
    return df.dropna(subset=list(cols))


def filter_in_set(df: DataFrame, col: str, values: Iterable) -> DataFrame:
    return df.where(q(col).isin(*list(values)))


def complete_case(df: DataFrame, exclude: Iterable[str] = ()) -> DataFrame:
    """Rows without NULL (after inf -> NULL) in any column but the excluded ones."""
    ex = set(exclude)
    return df.dropna(how="any", subset=[c for c in df.columns if c not in ex])


# The status filter's accepted values and the flag each one tests.
STATUS_FLAGS = {"fraud": ("isFraud", 1), "nonfraud": ("isFraud", 0), "flagged": ("isFlaggedFraud", 1)}


def filter_status(df: DataFrame, status: str) -> DataFrame:
    """``all`` / ``fraud`` / ``nonfraud`` / ``flagged``; unknown status or missing column -> all rows."""
    spec = STATUS_FLAGS.get((status or "all").lower())
    if spec is None or spec[0] not in df.columns:
        return df
    col, v = spec
    return df.where(flag_int(q(col)) == F.lit(v))


def filter_blank_text(df: DataFrame, col: str) -> tuple[DataFrame, DataFrame]:
    """Split into rows with some non-whitespace text (to score) and the rest (with an ``error``)."""
    ok = has_text(q(col))
    good = df.where(ok)
    bad = df.where(~ok | q(col).isNull()).withColumn("error", F.lit("empty text"))
    return good, bad


def rows_to_json(df: DataFrame, col: str = "json") -> DataFrame:
    """Each row as one JSON record; NaN and +-inf written as null."""
    fixed = []
    for f in df.schema.fields:
        c = q(f.name)
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            c = inf_to_null(nan_to_null(c))
        fixed.append(c.alias(f.name))
    return df.select(F.to_json(F.struct(*fixed), {"ignoreNullFields": "false"}).alias(col))


def parse_json_rows(df: DataFrame, col: str, schema: T.StructType, keep: Iterable[str] = ()) -> DataFrame:
    """JSON text to typed columns; a record that is not one whole JSON object gets an ``error``."""
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt"}
    held = T.StructType([*schema.fields, T.StructField("_corrupt", T.StringType())])
    parsed = F.from_json(q(col), held, options)
    whole = F.regexp_like(F.coalesce(q(col), F.lit("")), F.lit(r"(?s)^\s*\{.*\}\s*$"))
    # the parser stops at the end of the first value: text after it makes the whole invalid as an array
    alone = F.from_json(F.concat(F.lit("["), q(col), F.lit("]")), T.ArrayType(held), options)
    is_obj = whole & F.coalesce(F.size(alone) == 1, F.lit(False)) & parsed.getField("_corrupt").isNull()
    out = df.select(*[q(k) for k in keep], F.when(is_obj, parsed).alias("_rec"), F.coalesce(is_obj, F.lit(False)).alias("_ok"))
    return out.select(
        *[q(k) for k in keep],
        *[F.col("_rec").getField(f.name).alias(f.name) for f in schema.fields],
        F.when(~F.col("_ok"), F.lit("not a JSON object")).alias("error"),
    )
