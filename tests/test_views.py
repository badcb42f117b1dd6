from datetime import date, datetime, timedelta

import pytest
from conftest import column
from pyspark.sql import functions as F

from airgrain.operators import columns as P
from airgrain.plans import model as M
from airgrain.plans import views as Q
from airgrain.plans.cleaning import clean_pollutant, clean_weather
from airgrain.plans.features import training_frame
from airgrain.plans.refresh import daily_job, publish_forecast
from airgrain.schemas import CLEANED_TABLE, FEATURES, TARGETS
from airgrain.sources.store import Store, publish
from airgrain.streaming.hourly import daily_means, drop_repeats, run_to_parquet, run_updates

D1 = date(2025, 1, 1)


def test_column_names(spark):
    df = spark.createDataFrame([(1, 2)], "` a ` int, AQI int")
    assert P.trim_columns(df).columns == ["a", "AQI"]
    assert P.lower_columns(df).columns == ["a", "aqi"]
    with pytest.raises(ValueError, match="collide"):
        P.lower_columns(spark.createDataFrame([(1, 2)], "` aqi` int, AQI int"))


def test_select_features(spark):
    df = spark.createDataFrame([("s", 1, 2)], "series_id string, b int, a int")
    assert P.select_features(df, ["a", "b", "c"], strict=False).columns == ["series_id", "a", "b"]
    with pytest.raises(ValueError, match="missing"):
        P.select_features(df, ["a", "c"])


def test_drop_all_null_columns(spark):
    df = spark.createDataFrame([(1, None, None), (None, None, 2.0)], "a int, b string, c double")
    assert P.drop_all_null_columns(df).columns == ["a", "c"]


def test_split_columns(spark):
    df = spark.createDataFrame([], "a int, b string, c double, d date")
    assert P.split_columns(df) == (["a", "c"], ["b", "d"])


def test_date_range(series):
    df = series([1.0, 2.0, 3.0])
    assert column(P.date_range(df, "date", "2025-01-02", "2025-01-02"), "v") == [2]
    assert column(P.date_range(df, "date", None, date(2025, 1, 2)), "v") == [1, 2]
    assert column(P.date_range(df, "date"), "v") == [1, 2, 3]
    assert column(P.in_window(df, as_of="2025-01-03"), "v") == [3]
    assert column(P.in_window(df, "2025-01-02", "2025-01-03"), "v") == [2, 3]


def test_range_on_text_timestamps_includes_the_last_day(spark):
    df = spark.createDataFrame([("2025-01-01T23:00:00",), ("2025-01-02T01:00:00",)], "timestamp string")
    assert P.date_range(df, "timestamp", None, "2025-01-01").count() == 1


def test_search(spark):
    df = spark.createDataFrame([("Rain", 1.0), (None, 12.5), (None, None)], "t string, x double")
    assert P.search(df, "RAI").count() == 1
    assert P.search(df, "2.5").count() == 1
    assert P.search(df, ".0").count() == 0
    assert P.search(df, "").count() == 2
    assert P.search(df, "", "t").count() == 1
    with pytest.raises(ValueError, match="no column"):
        P.search(df, "a", "zz")


def test_browse_rows(spark):
    df = spark.createDataFrame(
        [("s", "2025-01-02T05:00:00", D1, 1.23456, 2.0), ("s", None, D1, 3.0, None)],
        "series_id string, timestamp string, eval_date date, MAE double, r2 double",
    )
    rows = Q.browse_rows(df, "model_evaluation")
    assert rows.columns == ["series_id", "date", "mae", "r2"]
    assert sorted(map(tuple, rows.collect())) == [("s", "2025-01-02", 1.235, 2.0), ("s", "N/A", 3.0, None)]
    assert Q.browse_rows(df, "model_evaluation", named=True).columns == ["series_id", "Date", "Mean Absolute Error", "R² Score"]


def test_latest_score(spark):
    df = spark.createDataFrame(
        [("s", "2025-01-02T05:07:00", 0.12345, 0.5), ("s", "2025-01-01T05:00:00", 9.0, 0.1)],
        "series_id string, timestamp string, mape double, mae double",
    ).withColumns({"r2": F.lit(1.0), "rmse": F.lit(2.0)})
    card = Q.evaluation_card(df).first()
    assert (card["created_at"], card["mape"], card["mae"]) == ("2/1/2025, 05:07", 12.345, 0.5)


def test_clean_pollutant(spark):
    rows = [("s", "2025-01-01", "10", "1"), ("s", "2025-01-02", "x", None), ("s", "2025-01-03", "30", "1")]
    df = spark.createDataFrame(rows, "series_id string, date string, ` pm25` string, co string")
    df = df.withColumns({c: F.lit(None).cast("double") for c in ("pm10", "o3", "no2", "so2")})
    got = clean_pollutant(df)
    assert column(got, "pm25") == [10, 20, 30]
    assert column(got, "AQI") == [10, 20, 30]
    assert column(got, "date") == [D1, date(2025, 1, 2), date(2025, 1, 3)]


def test_clean_weather(spark):
    rows = [
        ("s", "2025-01-03", 2, 30.0, None, "a"), ("s", "2025-01-01", 0, None, None, "b"),
        ("s", "2025-01-02", 1, 20.0, "rain", "c"), ("s", "2025-01-02", 9, 99.0, "no", "d"), ("s", "bad", 5, 1.0, "x", "e"),
    ]
    df = spark.createDataFrame(rows, "series_id string, date string, seq int, temp double, icon string, datetime string")
    got = clean_weather(df, tie=["seq"])
    assert column(got, "temp") == [20, 20, 30]
    assert column(got, "icon") == ["rain", "rain", None]
    assert "datetime" not in got.columns


def cleaned(spark, n, names=("s",)):
    rows = [
        (name, D1 + timedelta(days=i), *[float((i * k + j) % 40 + 1) for k in range(1, 20)])
        for j, name in enumerate(names)
        for i in range(n)
    ]
    return spark.createDataFrame(rows, CLEANED_TABLE)


@pytest.mark.parametrize(("n", "left"), [(13, 0), (14, 0), (15, 1), (30, 16)])
def test_training_rows(spark, n, left):
    frame = training_frame(cleaned(spark, n))
    assert len(FEATURES) == 34
    assert frame.count() == left


def test_targets_skip_rows_with_a_gap(spark):
    df = cleaned(spark, 30).withColumn("dew", F.when(F.dayofmonth("date") != 20, F.col("dew")))
    frame = training_frame(df)
    assert frame.count() == 15
    row = frame.where("date = '2025-01-19'").first()
    aqi = column(df, "AQI")
    assert [row[t] for t in TARGETS] == aqi[20:27]


def test_check_horizon(spark):
    rows = [("s", D1, float(i)) for i in range(6)]
    df = spark.createDataFrame(rows, "series_id string, forecast_date date, predicted_aqi double")
    with pytest.raises(ValueError, match="expected 7"):
        M.check_horizon(df)
    assert M.check_horizon(df, 6) is df


def test_model_round_trip(spark, tmp_path):
    store = Store(spark, str(tmp_path / "store"))
    publish({"cleaned_data": cleaned(spark, 60, ("a", "b"))}, store, "0001")
    scores = daily_job(store, datetime(2025, 3, 5, 6), "0002", maxIter=2)
    assert sorted(column(scores, "series_id", "series_id")) == ["a", "b"]
    assert scores.first()["timestamp"] == "2025-03-05T06:00:00"
    model = M.load_or_train(spark, store, "2025-03-05T06:00:00")
    first = sorted(map(tuple, publish_forecast(store, model, date(2025, 3, 5), "0003").collect()))
    assert [r[2] for r in first[:7]] == [date(2025, 3, 5) + timedelta(days=i) for i in range(1, 8)]
    assert {r[4:] for r in first} == {("XGBoost_V1", "a"), ("XGBoost_V1", "b")}
    recent = publish_forecast(store, model, date(2025, 3, 5), "0004", lookback_days=30)
    assert sorted(map(tuple, recent.collect())) == first
    chart = Q.latest_forecast(recent).collect()
    assert len(chart) == 14


def test_streamed_days_equal_the_batch(spark, tmp_path):
    rows = [("s", datetime(2025, 1, d, h), float(d * h)) for d in range(1, 8) for h in range(24)]
    df = spark.createDataFrame(rows, "series_id string, obs_ts timestamp, value double")
    df.union(df.limit(50)).repartition(3).write.parquet(str(tmp_path / "in"))
    arriving = spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    means = daily_means(drop_repeats(arriving, delay="30 days"), ["value"])
    run_updates(means, str(tmp_path / "out"), str(tmp_path / "cp")).awaitTermination()
    out = spark.read.parquet(str(tmp_path / "out"))
    newest = out.groupBy("date").agg(F.max_by("value", "batch_id").alias("v"), F.max_by("n", "batch_id").alias("n"))
    want = [(date(2025, 1, d), 11.5 * d, 24) for d in range(1, 8)]
    assert sorted(map(tuple, newest.collect())) == want
    closed = daily_means(drop_repeats(arriving, delay="1 hour"), ["value"])
    run_to_parquet(closed, str(tmp_path / "closed"), str(tmp_path / "cp2")).awaitTermination()
    done = spark.read.parquet(str(tmp_path / "closed"))
    # One batch of all files may come before the watermark moves: days 1 to 6 end an hour or more before the newest row.
    assert sorted(column(done, "date")) == [w[0] for w in want[:6]]
