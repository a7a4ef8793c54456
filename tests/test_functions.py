import datetime
from decimal import Decimal

import duckdb
from pyspark.sql import functions as F
from pyspark.sql import types as T

from medalith.functions import names, text, values
from medalith.functions.keys import surrogate_key, with_audit, with_ingestion_ts


def column(spark, rows, expression, kind="string"):
    df = spark.createDataFrame([(i, r) for i, r in enumerate(rows)], f"i int, c {kind}")
    return [r.v for r in df.select("i", expression(F.col("c")).alias("v")).orderBy("i").collect()]


def test_normalized_names_do_not_collide(spark):
    df = spark.createDataFrame([(1, 2, 3)], ["Code UIC", "code_uic", "geo.shape"])
    assert names.normalize_names(df).columns == ["code_uic", "code_uic_2", "geo_shape"]
    assert names.strip_name_quotes(df.toDF('"a"', "b", "c")).columns == ["a", "b", "c"]
    assert names.underscore_spaces(df).columns[0] == "Code_UIC"
    assert dict(names.cast_to_text(df, ["Code UIC", "nowhere"]).dtypes)["Code UIC"] == "string"


def test_area_names(spark):
    rows = ["Lille (partie française)", "Lille (Partie Française)", "Hesdin-la-Forêt", "CUGAND-x", "Cœur", ""]
    cleaned = column(spark, rows, lambda c: text.pole_label(text.without_french_part(c)))
    assert cleaned == ["Lille", "Lille", "Hesdin", "Cugand", "Coeur", ""]
    assert column(spark, ["L'Haÿ-les-Roses", "A-B C", "œu"], text.name_key) == ["LHALESROSES", "ABC", "OEU"]
    assert column(spark, [" saint-denis "], text.city_key) == ["SAINT DENIS"]
    assert column(spark, ["a--b"], lambda c: text.city_key(c, squeeze=True)) == ["A B"]


def test_commune_codes(spark):
    codes = ["1001", "01001", "2A004", "97101", "98818", "13201", "69381", "75120", None, "97500"]
    padded = column(spark, codes, lambda c: text.fold_arrondissement(text.padded_commune_code(c)))
    assert padded == ["01001", "01001", "2A004", "97101", "98818", "13055", "69123", "75056", None, "97500"]
    assert column(spark, codes[1:5], text.department_code) == ["01", "2A", "971", "988"]
    assert column(spark, codes[1:], text.region_code) == ["84", "94", "01", None, "93", "84", "11", None, None]
    assert column(spark, ["x", "", "nan", None], text.is_filled) == [True, False, False, False]


def test_regions_cover_each_department_once():
    listed = [d for departments in values.DEPARTMENTS_BY_REGION.values() for d in departments]
    assert len(listed) == len(set(listed)) == 97


def test_decimal_commas(spark):
    rows = ["12,5", "1,005", "0", "-1", "", None, "x"]
    assert column(spark, rows, text.comma_decimal) == [
        Decimal("12.50"), Decimal("1.01"), Decimal("0.00"), Decimal("-1.00"), None, None, None,
    ]
    assert column(spark, rows, text.comma_double)[:2] == [12.5, 1.005]


def test_numbers_and_booleans(spark):
    assert column(spark, ["3.7", "3.5", "2.5", "-2.5", "x", None], text.rounded_int) == [4, 4, 3, -3, None, None]
    said = column(spark, ["O", "N", "true", "True", None], lambda c: text.is_true_text(c, values.STATION_TRUE_TEXTS))
    assert said == [True, False, True, False, False]
    native = column(spark, [True, False, None], lambda c: text.is_true_text(c, ("true",)), "boolean")
    assert native == [True, False, False]
    assert column(spark, ["Agent (K2503)", "Agent", "Agent (abc)", None], text.rome_code) == ["K2503", "", "", None]
    assert column(spark, ["123 456 789 00012", "123", None], text.digit_count) == [14, 3, None]


def test_double_text_is_the_one_of_the_other_engine(spark):
    numbers = [
        0.0005, 12345678.5, 91.0, -181.0, 0.0, 48.8566, 2.35, 1e-5, -1.25e-7, 123456789012345.0, 1e15, 1e16, 2.5e20,
        0.0001, -0.00012345678901234567, 100.0, 1 / 3, 7.0e6, 1e7,
    ]
    con = duckdb.connect()
    expected = [con.execute("SELECT CAST(CAST(? AS DOUBLE) AS VARCHAR)", [n]).fetchall()[0][0] for n in numbers]
    assert column(spark, numbers, text.plain_double_text, "double") == expected


def test_stamps_with_an_offset_are_moved_to_utc(spark):
    rows = ["2024-05-20T15:12:31.5Z", "2024-05-20T15:12:31+02:00", "2024-05-20T15:12:31", "2024-05-20", "x", None]
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        found = column(spark, rows, lambda c: text.utc_timestamp(c, T.StringType()).cast("string"))
        assert found == ["2024-05-20 15:12:31.5", "2024-05-20 13:12:31", "2024-05-20 15:12:31", "2024-05-20 00:00:00", None, None]
        zoned = column(spark, rows[:2], lambda c: text.utc_timestamp(c.cast("timestamp"), T.TimestampType()).cast("string"))
        assert zoned == found[:2]
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_keys_skip_nulls(spark):
    df = spark.createDataFrame([("a", None, "b"), (None, None, "ab")], "x string, y string, z string")
    keys = [r.k for r in df.select(surrogate_key(F.col("x"), F.col("y"), F.col("z")).alias("k")).collect()]
    assert keys[0] == keys[1]
    assert df.select(surrogate_key(F.col("y")).alias("k")).first().k is None


def test_audit_and_file_timestamps(spark):
    df = spark.createDataFrame([("rents_20240131_235959.csv",), ("rents_20241399_000000.csv",), ("x.csv",)], "f string")
    rows = with_ingestion_ts(df, F.col("f")).collect()
    assert rows[0].ingestion_timestamp == datetime.datetime(2024, 1, 31, 23, 59, 59)
    assert all(abs((r.ingestion_timestamp - datetime.datetime.now(datetime.UTC).replace(tzinfo=None)).total_seconds()) < 600
               for r in rows[1:])
    audited = with_audit(df, "job")
    assert audited.columns[1:] == list(values.AUDIT_COLUMNS)
    assert dict(audited.dtypes)["job_insert_date_utc"] == "timestamp_ntz"
