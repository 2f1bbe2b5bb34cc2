"""Scalar cleaning and date features on edge cases."""

import datetime

from pyspark.sql import functions as F

from stratum.functions import clean as C
from stratum.functions import dates as D
from stratum.functions import text as X


def test_label_normalize(spark):
    vals = [" TRUE ", "\tfalse\n", "1", "0", "1.0", "maybe", None, "True"]
    df = spark.createDataFrame([(v,) for v in vals], "x string")
    got = [r[0] for r in df.select(C.label_normalize(F.col("x"))).collect()]
    assert got == [1, 0, 1, 0, None, None, None, 1]


def test_to_numeric_and_inf(spark):
    df = spark.createDataFrame([("abc",), (" 12 ",), ("",), ("NaN",), ("3.5",), ("inf",)], "x string")
    got = [r[0] for r in df.select(C.inf_to_null(C.to_numeric(F.col("x")))).collect()]
    assert got == [None, 12.0, None, None, 3.5, None]


def test_label_binarize_and_flag(spark):
    df = spark.createDataFrame([("0.9",), ("1.0",), (None,), ("x",), ("-2",)], "x string")
    assert [r[0] for r in df.select(C.label_binarize(F.col("x"))).collect()] == [1, 1, 0, 0, 0]
    assert [r[0] for r in df.select(C.flag_int(F.col("x"))).collect()] == [0, 1, 0, 0, -2]


def test_safe_ratio(spark):
    df = spark.createDataFrame([(1.0, 0.0), (1.0, None), (3.0, 2.0)], "a double, b double")
    assert [r[0] for r in df.select(C.safe_ratio(F.col("a"), F.col("b"))).collect()] == [None, None, 1.5]


def test_day_of_year_invalid(spark):
    df = spark.createDataFrame([(2.0, 30.0), (0.0, 5.0), (3.0, 1.0), (1.5, 2.0), (12.0, 31.0)], "m double, d double")
    got = [r[0] for r in df.select(D.day_of_year(F.col("m"), F.col("d"))).collect()]
    assert got == [None, None, 61, None, 366]


def test_dates_and_weekday(spark):
    df = spark.createDataFrame([("01-02-2024",), ("02/01/2024",), ("bad",)], "x string")
    d = D.parse_date_multi(F.col("x"))
    rows = df.select(d.alias("d"), *D.calendar_parts(d, "p")).collect()
    assert rows[0]["d"] == datetime.date(2024, 2, 1) == rows[1]["d"]
    assert rows[0]["p_dayofweek"] == 3  # Thursday, Monday = 0
    assert rows[2]["d"] is None


def test_align_schema_and_identifiers(spark):
    from pyspark.sql import types as T

    df = spark.createDataFrame([(1, "a", 2.0)], "label int, msisdn string, x double")
    schema = T.StructType([T.StructField("x", T.DoubleType()), T.StructField("y", T.StringType())])
    out = C.align_schema(df, schema)
    assert out.columns == ["x", "y"] and out.first()["y"] is None
    assert C.drop_identifiers(df, "label").columns == ["x"]


def test_tokenize_unicode_and_ngrams(spark):
    df = spark.createDataFrame([("Café au-lait, x_1 ÉTÉ!",), (None,), ("a",)], "t string")
    toks = df.select(X.tokenize(F.col("t")).alias("k"))
    assert toks.first()["k"] == ["café", "au", "lait", "x_1", "été"]
    grams = toks.select(X.ngrams(F.col("k"), 2).alias("g")).collect()
    assert grams[0]["g"][-1] == "x_1 été" and len(grams[0]["g"]) == 9
    assert grams[1]["g"] == [] and grams[2]["g"] == ["a"]


def test_filter_status_unknown_is_all(spark):
    df = spark.createDataFrame([("1",), ("0",), (None,)], "isFraud string")
    assert C.filter_status(df, "whatever").count() == 3
    assert C.filter_status(df, "fraud").count() == 1
    assert C.filter_status(df, "nonfraud").count() == 2


def test_rows_to_json_nan_inf(spark):
    df = spark.createDataFrame([(float("nan"), float("inf"), 1.0)], "a double, b double, c double")
    assert df.transform(C.rows_to_json).first()[0] == '{"a":null,"b":null,"c":1.0}'


def test_table_profile_and_sample(spark):
    from stratum.sources.tables import load_table, table_profile, table_sample
    from tests.conftest import SF_SMALL

    prof = {r["table_name"]: r for r in table_profile(spark, SF_SMALL, ["region", "nation"]).collect()}
    assert prof["region"]["n_rows"] == 5 and prof["region"]["n_cols"] == 2
    assert "r_regionkey:int" in prof["region"]["columns"]
    sample = table_sample(load_table(spark, SF_SMALL, "nation"), "n_nationkey")
    assert [r["n_nationkey"] for r in sample.collect()] == [0, 1, 2, 3, 4]


def test_align_schema_coerces_dirty_values(spark):
    from pyspark.sql import types as T

    df = spark.createDataFrame([("12",), ("abc",)], "x string")
    schema = T.StructType([T.StructField("x", T.DoubleType())])
    assert [r[0] for r in C.align_schema(df, schema).collect()] == [12.0, None]


def test_sinks_export_name_and_empty_refusal(spark, tmp_path):
    import pytest as _pytest

    from stratum.sources import sinks as K

    df = spark.createDataFrame([(1, 'a,b "q"\nline2 ')], "id long, text string")
    path = K.export_filtered(df, str(tmp_path), "fraud")
    assert path.endswith("/fraud_transactions.csv")
    back = K.read_csv(spark, path, df.schema).collect()
    assert back[0]["text"] == 'a,b "q"\nline2 '
    with _pytest.raises(ValueError):
        K.write_predictions(df.where("id < 0"), str(tmp_path / "empty"))


def test_candidate_feature_toggles(spark):
    import datetime

    df = spark.createDataFrame(
        [(datetime.datetime(2024, 1, 1), 1, "x", 2.0, 0)], "time timestamp, stage int, note string, v double, y int"
    )
    assert C.candidate_features(df, "y") == ["v"]
    assert C.candidate_features(df, "y", include_admin=True) == ["time", "stage", "v"]
    assert C.candidate_features(df, "y", numeric_only=False) == ["note", "v"]
    assert C.candidate_features(df, "y", numeric_only=False, include_admin=True) == ["time", "stage", "note", "v"]
    assert C.select_numeric(df, "y").columns == ["v", "y"]


def test_html_unescape_decodes_ampersand_last(spark):
    df = spark.createDataFrame([("It&#039;s &lt;b&gt; &quot;ok&quot; &amp;quot;",)], "t string")
    assert df.select(X.html_unescape(F.col("t"))).first()[0] == 'It\'s <b> "ok" &quot;'


NBSP = chr(0xA0)


def test_dirty_values_have_defined_results(spark):
    from pyspark.sql import functions as F

    df = spark.createDataFrame(
        [("12d",), ("1f",), ("0x1p3",), (" 12 ",), ("1e12",), ("inf",), ("-.5",), ("nan",), ("",), (None,), (f"{NBSP}7{NBSP}",)], "t string"
    )
    got = [r[0] for r in df.select(C.to_numeric(F.col("t"))).collect()]
    assert got == [None, None, None, 12.0, 1e12, float("inf"), -0.5, None, None, None, 7.0]
    assert [r[0] for r in df.select(C.flag_int(F.col("t"))).collect()] == [0, 0, 0, 12, 0, 0, 0, 0, 0, 0, 7]


def test_unicode_white_space_is_stripped(spark):
    from pyspark.sql import functions as F
    from stratum.functions.text import has_text

    df = spark.createDataFrame([(f"{NBSP}True{NBSP}",), (NBSP,), (" \t",), (f"{NBSP}x",)], "t string")
    assert [r[0] for r in df.select(C.label_normalize(F.col("t"))).collect()][0] == 1
    assert [r[0] for r in df.select(has_text(F.col("t"))).collect()] == [True, False, False, True]


def test_day_of_year_of_an_impossible_month(spark):
    from pyspark.sql import functions as F
    from stratum.functions.dates import day_of_year

    df = spark.createDataFrame([(1e12, 1.0), (2.0, 29.0), (2.5, 1.0), (float("inf"), 1.0)], "m double, d double")
    assert [r[0] for r in df.select(day_of_year(F.col("m"), F.col("d"))).collect()] == [None, 60, None, None]


def test_malformed_json_is_an_error(spark):
    from pyspark.sql import types as T

    texts = ['{"k": 5}', ' {"k": 5} ', '{"k": 1', "{bad", '{"k":5} trailing', '{"k":5}{"k":6}', '{"k":5}, {"k":6}', "[1]", "", None, "{}"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    rows = C.parse_json_rows(df, "t", T.StructType([T.StructField("k", T.IntegerType())]), keep=["i"]).orderBy("i").collect()
    assert [r["k"] for r in rows] == [5, 5, None, None, None, None, None, None, None, None, None]
    assert [r["error"] is None for r in rows] == [True, True, False, False, False, False, False, False, False, False, True]


def test_csv_round_trip_tells_empty_from_null(spark, tmp_path):
    from pyspark.sql import types as T
    from stratum.sources.sinks import read_csv, write_csv

    schema = T.StructType([T.StructField("i", T.IntegerType()), T.StructField("t", T.StringType())])
    rows = [(0, ""), (1, None), (2, '""'), (3, "a\nb"), (4, ' "q" , '), (5, "\\"), (6, "x")]
    write_csv(spark.createDataFrame(rows, schema), str(tmp_path / "c"))
    assert sorted(tuple(r) for r in read_csv(spark, str(tmp_path / "c"), schema).collect()) == rows


def test_nan_does_not_make_a_column_vary(spark):
    from stratum.operators.fitstate import prune_constant

    df = spark.createDataFrame([(1.0, 1.0), (float("nan"), 2.0), (1.0, None)], "a double, b double")
    assert {r["feature"]: r["varying"] for r in prune_constant(df, ["a", "b"]).collect()} == {"a": 0, "b": 1}
