from datetime import date, datetime

import pytest
from conftest import column
from pyspark.sql import functions as F

from airgrain.functions import scalars as C
from airgrain.functions.sub_index import band_table, sub_index, with_aqi
from airgrain.operators.joins import band_join
from airgrain.schemas import BANDS, POLLUTANTS


def one(spark, value, kind, expr):
    return spark.createDataFrame([(value,)], f"x {kind}").select(expr(F.col("x")).alias("y")).first()["y"]


@pytest.mark.parametrize(
    ("text", "number"),
    [("3.5", 3.5), ("x", None), ("", None), (None, None), (" 7 ", 7.0), ("1e2", 100.0), ("1d", None), ("nan", None), ("-.5", -0.5)],
)
def test_to_number(spark, text, number):
    assert one(spark, text, "string", C.to_number) == number


@pytest.mark.parametrize(
    ("text", "day"), [("2025-01-02", date(2025, 1, 2)), ("bad", None), ("", None), (None, None), ("2025-01-02 10:00:00", date(2025, 1, 2))]
)
def test_parse_date(spark, text, day):
    assert one(spark, text, "string", C.parse_date) == day


def test_parse_date_formats(spark):
    assert one(spark, "02/01/2025", "string", lambda c: C.parse_date(c, ["dd/MM/yyyy"])) == date(2025, 1, 2)


def test_parse_date_strict_fails(spark):
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        one(spark, "bad", "string", C.parse_date_strict)


@pytest.mark.parametrize(("items", "text"), [(None, None), ([], None), (["rain"], "rain"), (["rain", "snow"], "rain,snow")])
def test_comma_list(spark, items, text):
    assert one(spark, items, "array<string>", C.comma_list) == text


@pytest.mark.parametrize(("month", "flags"), [(1, (0, 1)), (6, (1, 0)), (9, (0, 0)), (None, (0, 0)), (12, (0, 1)), (8, (1, 0))])
def test_season_flags(spark, month, flags):
    assert (one(spark, month, "int", C.is_summer), one(spark, month, "int", C.is_winter)) == flags


def test_row_max_and_sum(spark):
    df = spark.createDataFrame([(1.0, None, 2.0), (None, None, None), (10.0, None, 40.0)], "a double, b double, c double")
    rows = df.select(C.row_sum("abc").alias("s"), C.row_max("abc").alias("m")).collect()
    assert [(r["s"], r["m"]) for r in rows] == [(3.0, 2.0), (0.0, None), (50.0, 40.0)]


def test_nan_to_null(spark):
    df = spark.createDataFrame([(float("nan"), 1), (2.0, None)], "a double, b int")
    assert [tuple(r) for r in C.nan_to_null(df).collect()] == [(None, 1), (2.0, None)]


def test_time_texts(spark):
    df = spark.createDataFrame([(datetime(2025, 3, 4, 1, 30),)], "t timestamp")
    row = df.select(
        C.datetime_text(F.col("t")), C.score_time_text(F.col("t")), C.utc_date(F.col("t"), "Asia/Kolkata"),
        C.local_date(F.col("t"), "Asia/Kolkata"), C.date_text(F.col("t")),
    ).first()
    assert tuple(row) == ("2025-03-04 01:30:00", "4/3/2025, 01:30", date(2025, 3, 3), date(2025, 3, 4), "2025-03-04")


@pytest.mark.parametrize(("x", "text"), [(12.0, "12"), (100.0, "100"), (0.5, "0.5"), (1e7, "10000000"), (12.34, "12.34"), (None, None)])
def test_shown_text(spark, x, text):
    df = spark.createDataFrame([(x,)], "x double")
    assert df.select(C.shown_text("x", df.schema["x"].dataType)).first()[0] == text


@pytest.mark.parametrize(
    ("x", "plain", "scaled"),
    [(0, 0, 0), (15, 15, 25), (30, 30, 50), (30.5, None, None), (31, 31, 51), (60, 60, 100), (500, 500, 500), (501, None, None), (None, None, None)],
)
def test_sub_index(spark, x, plain, scaled):
    x = None if x is None else float(x)
    assert one(spark, x, "double", lambda c: sub_index("x", BANDS["pm25"])) == plain
    assert one(spark, x, "double", lambda c: sub_index("x", BANDS["pm25"], scale=True)) == scaled


def test_shared_bound_takes_the_first_band(spark):
    assert one(spark, 748.0, "double", lambda c: sub_index("x", BANDS["o3"], scale=True)) == 400.0
    df = spark.createDataFrame([("s", "o3", 748.0), ("s", "o3", 208.5)], "series_id string, pollutant string, value double")
    got = column(band_join(df, band_table(spark), "value", ["series_id"]), "band_no", "value")
    assert got == [None, 5]


def test_index_overwrites_the_reported_one(spark):
    df = spark.createDataFrame(
        [(10.0, None, 40.0, None, None, None, 999.0), (None,) * 6 + (5.0,)],
        ", ".join(f"{p} double" for p in POLLUTANTS) + ", AQI double",
    )
    assert [r["AQI"] for r in with_aqi(df).collect()] == [40.0, None]


def test_local_date_in_any_session_zone(spark):
    import datetime

    from pyspark.sql import functions as F

    from airgrain.functions.scalars import local_date

    before = spark.conf.get("spark.sql.session.timeZone")
    try:
        for zone in ("UTC", "America/New_York"):
            spark.conf.set("spark.sql.session.timeZone", zone)
            rows = spark.sql("SELECT timestamp_seconds(s) AS t FROM VALUES (1735758000), (null) v(s)")  # 19:00 UTC
            got = [r[0] for r in rows.select(local_date(F.col("t"), "Asia/Kolkata")).collect()]
            assert got == [datetime.date(2025, 1, 2), None]
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
