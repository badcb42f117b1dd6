"""Registered queries: each reads whole driver tables and returns one DataFrame."""

from __future__ import annotations

from datetime import date
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from airgrain.checks import views as V
from airgrain.functions.scalars import (
    date_text,
    datetime_text,
    is_summer,
    is_winter,
    nan_to_null,
    parse_date,
    round_floats,
    row_sum,
    score_time_text,
    to_number,
    utc_date,
)
from airgrain.functions.sub_index import band_table, with_aqi
from airgrain.operators import series as S
from airgrain.operators.aggregates import daily_aggregate, latest_date, refresh_average
from airgrain.operators.columns import (
    date_range,
    drop_all_null_columns,
    lower_columns,
    select_features,
    trim_columns,
)
from airgrain.operators.joins import band_join, binned_band_join, build_raw, latest_by
from airgrain.operators.merge import concat, last_write_wins, upsert
from airgrain.operators.metrics import regression_metrics
from airgrain.plans import model as M
from airgrain.plans import views as Q
from airgrain.plans.cleaning import clean_pollutant, clean_weather
from airgrain.plans.features import engineer_features, training_frame
from airgrain.plans.register import compact_registered, known_series
from airgrain.plans.refresh import bootstrap, publish_forecast, refresh_daily
from airgrain.schemas import (
    CLEANED,
    ENGINEERED_FEATURES,
    EVALUATION,
    FEATURES,
    HORIZON,
    POLLUTANT,
    POLLUTANTS,
    SUB_INDEXES,
    TARGETS,
    WEATHER,
    WEATHER_COLUMNS,
    WEATHER_DOCUMENT,
    WEATHER_NUMERIC,
)
from airgrain.session import scratch_path, shuffles_released
from airgrain.sources.documents import read_pollutant, read_weather
from airgrain.sources.files import to_records, write_csv
from airgrain.sources.store import Store, compact, current, publish
from airgrain.streaming.hourly import daily_means, drop_repeats, run_refresh, run_updates

AS_OF = date(2002, 1, 1)
RUN_TS = "2002-01-01T06:30:00"
ID = ("series_id", "date")
HOURLY = ("series_id", "date", "seq")
BACKFILLED = ("dew", "windgust", "snowdepth", "conditions", "preciptype")

Spark = SparkSession


def _out(df: DataFrame, decimals: int = 4) -> DataFrame:
    return round_floats(nan_to_null(df), decimals)


# ---- index, scalars -------------------------------------------------------------------------

def aqi_daily(spark: Spark, d: str) -> DataFrame:
    """Daily index per series with its seven-row sum."""
    aqi = V.pollutant_daily(spark, d).select(*ID, "AQI")
    return _out(S.rolling_sum(aqi, "AQI", 7, name="aqi_cum_sum_7"))


def sub_index_scaled(spark: Spark, d: str) -> DataFrame:
    means = daily_aggregate(V.pollutant_obs(spark, d).drop("flag"), order=V.ARRIVAL)
    return _out(with_aqi(means, scale=True).select(*ID, *SUB_INDEXES, "AQI"))


def _long_pollutants(spark: Spark, d: str) -> DataFrame:
    means = daily_aggregate(V.pollutant_obs(spark, d).drop("flag"), order=V.ARRIVAL)
    return means.unpivot(list(ID), list(POLLUTANTS), "pollutant", "value")


def band_join_counts(spark: Spark, d: str) -> DataFrame:
    banded = band_join(_long_pollutants(spark, d), band_table(spark), "value", ID)
    return banded.groupBy("pollutant", "band_no").agg(F.count(F.lit(1)).alias("n"))


def binned_bands(spark: Spark, d: str) -> DataFrame:
    """Ozone observations against two bands of each line item, most of them narrow, some a hundred wide."""
    width = "CASE WHEN l_orderkey % 997 = 0 THEN 100D ELSE (l_orderkey % 8) / 64D END"
    bands = V.table(spark, d, "lineitem").selectExpr(
        "explode(array('o3', 'no2')) AS pollutant", "(l_orderkey * 8 + l_linenumber) * 100000 + l_suppkey AS band_no",
        "floor(l_extendedprice * 7) % 67200 / 64D AS lo", f"{width} AS width", "l_quantity AS index_lo", "l_quantity + 1 AS index_hi",
    ).selectExpr("pollutant", "band_no", "lo", "lo + width AS hi", "index_lo", "index_hi")
    values = V.pollutant_obs(spark, d).selectExpr(*ID, *V.ARRIVAL, "stack(2, 'o3', o3, 'no2', no2) AS (pollutant, value)")
    return _out(binned_band_join(values, bands, "value").drop("index_lo", "index_hi"))


def coerce_numeric_date(spark: Spark, d: str) -> DataFrame:
    k = F.get_json_object("props", "$.k")
    e = F.col("seq")
    text = F.when(e % 5 == 0, F.concat(F.lit("x"), k)).when(e % 7 == 0, F.lit(""))
    day = F.when(e % 4 == 0, F.lit("bad")).otherwise(F.col("date").cast("string"))
    rows = V.hourly_obs(spark, d).select(
        "seq",
        text.when(e % 2 == 0, F.concat(F.lit(" "), k, F.lit(".5 "))).otherwise(k).alias(" k "),
        day.alias("day_in"),
        F.when(e % 6 == 0, F.lit(float("nan"))).otherwise(F.col("value")).alias("Value"),
    )
    rows = nan_to_null(lower_columns(trim_columns(rows)))
    return _out(rows.select(
        "seq",
        to_number(F.col("k")).alias("k"),
        parse_date(F.col("day_in")).alias("day"),
        date_text(parse_date(F.col("day_in"))).alias("day_text"),
        "value",
    ))


def month_flags(spark: Spark, d: str) -> DataFrame:
    month = F.month("date")
    return V.weather_obs(spark, d).select(*ID).distinct().select(
        *ID, month.alias("month"), is_summer(month).alias("is_summer"), is_winter(month).alias("is_winter")
    )


def timestamp_formats(spark: Spark, d: str) -> DataFrame:
    ts = F.col("obs_ts")
    return V.hourly_obs(spark, d).select(
        "seq",
        date_text(ts).alias("day_text"),
        datetime_text(ts).alias("time_text"),
        utc_date(ts, "Asia/Kolkata").alias("utc_day"),
        score_time_text(ts).alias("shown"),
    )


def interactions_rowsum(spark: Spark, d: str) -> DataFrame:
    return _out(V.pollutant_daily(spark, d).select(
        *ID,
        row_sum(POLLUTANTS).alias("total_pollution"),
        (F.col("pm25") * F.col("co")).alias("pm25_co"),
        (F.col("pm25") * F.col("no2")).alias("pm25_no2"),
        (F.col("pm25") * F.col("so2")).alias("pm25_so2"),
    ))


# ---- aggregation ----------------------------------------------------------------------------

def daily_mean_first(spark: Spark, d: str) -> DataFrame:
    return _out(V.weather_daily(spark, d))


def first_per_date(spark: Spark, d: str) -> DataFrame:
    return S.first_per_key(V.weather_obs(spark, d), ID, "seq")


def latest_dates(spark: Spark, d: str) -> DataFrame:
    """The newest day of both kinds of observation."""
    return latest_date(V.pollutant_obs(spark, d)).select(
        F.lit("pollutant").alias("kind"), "date"
    ).union(latest_date(V.weather_obs(spark, d)).select(F.lit("weather"), "date"))


def refresh_average_recency(spark: Spark, d: str) -> DataFrame:
    return _out(refresh_average(
        V.hourly_obs(spark, d), ["value"], ID, ["obs_ts", "seq"], text=["note"],
        segment=S.time_segment("obs_ts", 3600),
    ))


def _noon(spark: Spark, d: str, later: bool) -> DataFrame:
    hour = F.hour("obs_ts")
    return V.hourly_obs(spark, d).where(hour >= 12 if later else hour < 12)


def refresh_average_stored(spark: Spark, d: str) -> DataFrame:
    """Morning observations as the stored daily row, those from noon on as refreshes."""
    stored = refresh_average(_noon(spark, d, False), ["value"], ID, "seq", text=["note"], mode="true_mean")
    return _out(refresh_average(
        _noon(spark, d, True), ["value"], ID, ["obs_ts", "seq"], stored, ["note"],
        segment=S.time_segment("obs_ts", 3600),
    ))


def refresh_average_together(spark: Spark, d: str) -> DataFrame:
    stored = refresh_average(_noon(spark, d, False), ["value"], ID, "seq", mode="true_mean")
    return _out(refresh_average(
        _noon(spark, d, True), ["value"], ID, "seq", stored, batch="together"
    ))


def refresh_average_true(spark: Spark, d: str) -> DataFrame:
    return _out(refresh_average(V.hourly_obs(spark, d), ["value"], ID, "seq", mode="true_mean"))


# ---- series, one window partition per series (daily rows) ----------------------------------

def interpolate_linear(spark: Spark, d: str) -> DataFrame:
    means = daily_aggregate(V.pollutant_obs(spark, d).drop("flag"), order=V.ARRIVAL)
    return _out(S.interpolate_linear(means, POLLUTANTS))


def backfill(spark: Spark, d: str) -> DataFrame:
    return _out(S.backfill(V.weather_daily(spark, d).select(*ID, *BACKFILLED), BACKFILLED))


def _aqi(spark: Spark, d: str) -> DataFrame:
    return V.pollutant_daily(spark, d).select(*ID, "AQI")


def lags_7(spark: Spark, d: str) -> DataFrame:
    return _out(S.drop_incomplete(S.add_lags(_aqi(spark, d), "AQI", 7)))


def targets_7(spark: Spark, d: str) -> DataFrame:
    return _out(S.drop_tail(S.add_targets(S.drop_incomplete(_aqi(spark, d)), "AQI", 7), 7))


def rolling_7(spark: Spark, d: str) -> DataFrame:
    pm25 = V.pollutant_daily(spark, d).select(*ID, "pm25")
    return _out(S.rolling_sum(pm25, "pm25", 7, name="pm25_cumulative_sum_7"))


def chrono_split(spark: Spark, d: str) -> DataFrame:
    return _out(S.chronological_split(_aqi(spark, d)))


def last_row(spark: Spark, d: str) -> DataFrame:
    return _out(S.last_row(V.pollutant_daily(spark, d)))


# ---- series cut into runs (observations; a series holds a fifth of all rows) ----------------

def _timed(spark: Spark, d: str, *more: str) -> DataFrame:
    return V.hourly_obs(spark, d).select("series_id", "obs_ts", "seq", "value", *more)


def _segmented(df: DataFrame, operator, *args) -> DataFrame:
    """Runs cut by the data, of a thousand rows at most."""
    runs = S.even_runs(df, order=["obs_ts", "seq"], rows=1000)
    done = operator(runs, *args, ts=["obs_ts", "seq"], segment=F.col(S.RUN))
    return _out(done.drop("obs_ts", S.RUN))


def lags_segmented(spark: Spark, d: str) -> DataFrame:
    """Runs of a calendar day each."""
    lags = S.add_lags(_timed(spark, d), "value", 7, ts=["obs_ts", "seq"], segment=S.time_segment("obs_ts", 86_400))
    return _out(lags.drop("obs_ts"))


def lags_even_runs(spark: Spark, d: str) -> DataFrame:
    return _segmented(_timed(spark, d), S.add_lags, "value", 7)


def targets_segmented(spark: Spark, d: str) -> DataFrame:
    return _segmented(_timed(spark, d), S.add_targets, "value", 7)


def rolling_segmented(spark: Spark, d: str) -> DataFrame:
    return _segmented(_timed(spark, d), S.rolling_sum, "value", 7)


def interpolate_segmented(spark: Spark, d: str) -> DataFrame:
    return _segmented(_timed(spark, d), S.interpolate_linear, ["value"])


def backfill_segmented(spark: Spark, d: str) -> DataFrame:
    return _segmented(_timed(spark, d, "note"), S.backfill, ["value", "note"])


def split_segmented(spark: Spark, d: str) -> DataFrame:
    return _segmented(_timed(spark, d), S.chronological_split, 0.2)


# ---- joins, cleaning, features --------------------------------------------------------------

def raw_join(spark: Spark, d: str) -> DataFrame:
    return _out(build_raw(V.weather_daily(spark, d), V.pollutant_daily(spark, d), order=("date",)))


def cleaned_features(spark: Spark, d: str) -> DataFrame:
    return _out(select_features(V.raw_daily(spark, d), strict=True))


def clean_pollutant_rows(spark: Spark, d: str) -> DataFrame:
    """All observations in arrival order; a day is cut further by ranges of the order key."""
    obs = V.pollutant_obs(spark, d).drop("flag")
    text = obs.withColumns({"pm25": F.coalesce(F.col("pm25").cast("string"), F.lit("-"))})
    done = clean_pollutant(
        text.withColumnRenamed("pm10", " pm10"), order=["date", *V.ARRIVAL],
        segment=S.id_segment("date", "seq", 1 << 20),
    )
    return _out(done)


def clean_weather_rows(spark: Spark, d: str) -> DataFrame:
    obs = V.weather_obs(spark, d).drop("status")
    return _out(clean_weather(obs, tie=["seq"]).drop("seq"))


def engineer_features_rows(spark: Spark, d: str) -> DataFrame:
    return _out(engineer_features(V.cleaned_daily(spark, d)).select(*ID, *ENGINEERED_FEATURES))


def training_rows(spark: Spark, d: str) -> DataFrame:
    frame = training_frame(V.cleaned_daily(spark, d))
    return _out(frame.select(*ID, *FEATURES, *TARGETS, "split"))


# ---- scores, forecasts, upserts -------------------------------------------------------------

def metrics_persistence(spark: Spark, d: str) -> DataFrame:
    """Today's index as the prediction of each of the next seven rows."""
    rows = S.drop_incomplete(S.add_targets(S.drop_incomplete(_aqi(spark, d)), "AQI", HORIZON))
    long = M.to_long(rows, [*ID, "AQI"], y=TARGETS)
    return _out(regression_metrics(long, "y", "AQI", "horizon", ["series_id"]))


def evaluation_rows(spark: Spark, d: str) -> DataFrame:
    rows = S.drop_incomplete(S.add_targets(S.drop_incomplete(_aqi(spark, d)), "AQI", HORIZON))
    guesses = rows.withColumns({p: F.col("AQI") for p in M.PREDICTIONS})
    return M.evaluate(guesses, RUN_TS)


def forecast_long(spark: Spark, d: str) -> DataFrame:
    """The seven lags of the last complete row stand in for predictions."""
    lagged = S.drop_incomplete(S.add_lags(_aqi(spark, d), "AQI", HORIZON))
    lags = [f"lag_{i}_AQI" for i in range(1, HORIZON + 1)]
    return M.check_horizon(M.forecast_rows(S.last_row(lagged), AS_OF, predictions=lags))


def _forecasts(spark: Spark, d: str, pending: bool) -> DataFrame:
    """Orders as forecasts; pending ones are the later write."""
    obs = V.weather_obs(spark, d).where((F.col("status") == "P") == F.lit(pending))
    made = obs.groupBy(
        "series_id",
        F.col("date").alias("forecast_date"),
        F.date_add("date", (F.col("seq") % 7 + 1).cast("int")).alias("predicted_date"),
    ).agg(F.max("temp").alias("predicted_aqi"))
    name = "late" if pending else "early"
    return made.withColumns({"model_name": F.lit(name), "location": F.col("series_id")})


def _upserted_forecasts(spark: Spark, d: str) -> DataFrame:
    keys = ["series_id", "forecast_date", "predicted_date"]
    return upsert(_forecasts(spark, d, False), _forecasts(spark, d, True), keys)


def upsert_forecast(spark: Spark, d: str) -> DataFrame:
    return _out(_upserted_forecasts(spark, d))


def _evaluations(spark: Spark, d: str, pending: bool) -> DataFrame:
    obs = V.weather_obs(spark, d).where((F.col("status") == "P") == F.lit(pending))
    scored = obs.groupBy("series_id", F.col("date").alias("eval_date")).agg(
        F.avg("temp").alias("mae"), F.max("humidity").alias("r2"),
        F.min("humidity").alias("rmse"), (F.max("dew") / 64).alias("mape"),
    )
    hour = "T18:05:00" if pending else "T06:05:00"
    stamp = F.concat(date_text(F.col("eval_date")), F.lit(hour))
    return scored.withColumn("timestamp", stamp).select(*EVALUATION.names)


def _upserted_evaluations(spark: Spark, d: str) -> DataFrame:
    keys = ["series_id", "eval_date"]
    return upsert(_evaluations(spark, d, False), _evaluations(spark, d, True), keys)


def upsert_eval(spark: Spark, d: str) -> DataFrame:
    return _out(_upserted_evaluations(spark, d))


def upsert_by_date(spark: Spark, d: str) -> DataFrame:
    """Two overlapping date ranges of daily rows; days of the later range are replaced."""
    obs = V.weather_obs(spark, d)
    old = date_range(obs, "date", None, "1999-12-31").groupBy(*ID).agg(F.avg("temp").alias("temp"))
    new = date_range(obs, "date", "1998-01-01").groupBy(*ID).agg(F.max("temp").alias("temp"))
    return _out(upsert(old, new, ID))


def concat_last_wins(spark: Spark, d: str) -> DataFrame:
    """Stored and new rows by name, missing columns null, the later row per day kept."""
    obs = V.weather_obs(spark, d)
    old = obs.where("status <> 'P'").groupBy(*ID).agg(F.max("temp").alias("temp"))
    new = obs.where("status = 'P'").groupBy(*ID).agg(F.max("humidity").alias("humidity"))
    return last_write_wins(concat(old, new), ID, "_order")


def latest_forecast(spark: Spark, d: str) -> DataFrame:
    return _out(Q.latest_forecast(_upserted_forecasts(spark, d)))


def latest_forecast_per_series(spark: Spark, d: str) -> DataFrame:
    return _out(Q.latest_forecast(_upserted_forecasts(spark, d), ["series_id"]))


def forecast_chart(spark: Spark, d: str) -> DataFrame:
    return _out(Q.forecast_chart(_upserted_forecasts(spark, d)))


def _stamped(evaluations: DataFrame) -> DataFrame:
    """The minute is the series, so that times differ."""
    minute = F.lpad("series_id", 2, "0")
    return evaluations.withColumn("timestamp", F.concat(F.substring("timestamp", 1, 14), minute, F.lit(":00")))


def _one_per_day(spark: Spark, d: str) -> DataFrame:
    return _stamped(_upserted_evaluations(spark, d))


def latest_evaluation(spark: Spark, d: str) -> DataFrame:
    return _out(Q.latest_evaluation(_one_per_day(spark, d)))


def evaluation_card(spark: Spark, d: str) -> DataFrame:
    return Q.evaluation_card(_one_per_day(spark, d))


# ---- table browser --------------------------------------------------------------------------

def browse_range(spark: Spark, d: str) -> DataFrame:
    rows = V.cleaned_daily(spark, d)
    return Q.browse_rows(rows, "cleaned_data", "1996-03-01", "1999-10-31")


def browse_forecast(spark: Spark, d: str) -> DataFrame:
    return Q.browse_rows(_upserted_forecasts(spark, d), "aqi_forecast", "1997-01-01", None)


def browse_evaluation(spark: Spark, d: str) -> DataFrame:
    return Q.browse_rows(_upserted_evaluations(spark, d), "model_evaluation", None, "1999-06-30")


def browse_search_all(spark: Spark, d: str) -> DataFrame:
    return Q.browse_rows(V.weather_daily(spark, d), "weather_data", query="1-U")


def browse_search_column(spark: Spark, d: str) -> DataFrame:
    return Q.browse_rows(V.weather_daily(spark, d), "weather_data", query="", column="conditions")


def browse_search_number(spark: Spark, d: str) -> DataFrame:
    return Q.browse_rows(V.weather_daily(spark, d), "weather_data", query="12.5")


def browse_named(spark: Spark, d: str) -> DataFrame:
    rows = V.pollutant_daily(spark, d)
    return Q.browse_rows(rows, "pollutant_data", "1998-01-01", "1998-12-31", named=True)


def current_conditions(spark: Spark, d: str) -> DataFrame:
    return _out(Q.current_conditions(
        V.weather_daily(spark, d), V.pollutant_daily(spark, d), "1995-01-01", "2001-06-30"
    ))


def drop_null_columns(spark: Spark, d: str) -> DataFrame:
    return _out(drop_all_null_columns(V.weather_daily(spark, d)))


# ---- sources, sinks, jobs -------------------------------------------------------------------

def _store(spark: Spark, root: str) -> Store:
    """A store by years: each run here writes the whole history at once."""
    return Store(spark, root, "yyyy")


JSON_TIME = {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"}


def _weather_documents(rows: DataFrame) -> DataFrame:
    """Flat fetches as nested documents: one day each, lists for the list columns. Rain-free days
    get an empty list and every tenth document has no address."""

    def field(c: str):
        if c == "preciptype":
            return F.coalesce(F.split(c, ","), F.array().cast("array<string>")).alias(c)
        return (F.array(F.col(c)) if c == "stations" else F.col(c)).alias(c)

    day = F.struct(
        date_text(F.col("date")).alias("datetime"),
        *[field(c) for c in WEATHER_COLUMNS if c != "name"],
    )
    address = F.when(F.col("humidity") % 10 != 0, F.col("name"))
    return rows.select(
        "series_id", "fetched_at", address.alias("resolvedAddress"), F.array(day).alias("days")
    )


def _pollutant_documents(rows: DataFrame) -> DataFrame:
    """Flat fetches as nested documents; a null concentration is left out."""
    parts = F.struct(*[F.struct(F.col(p).alias("v")).alias(p) for p in POLLUTANTS])
    data = F.struct(F.col("pm25").alias("aqi"), parts.alias("iaqi")).alias("data")
    return rows.select("series_id", "fetched_at", data)


def _land(df: DataFrame, path: str) -> None:
    """Packed to an eighth; a task cannot share a packed file with others, so files are kept short."""
    packed = {"compression": "gzip", "maxRecordsPerFile": 250_000}
    with shuffles_released(df.sparkSession):
        df.write.mode("append").options(**JSON_TIME, **packed).json(path)


def json_weather(spark: Spark, d: str) -> DataFrame:
    path = scratch_path(spark, "weather")
    _land(_weather_documents(V.weather_fetches(spark, d)), path)
    return _out(read_weather(spark, path).drop("fetched_at"))


def json_pollutant(spark: Spark, d: str) -> DataFrame:
    path = scratch_path(spark, "pollutant")
    _land(_pollutant_documents(V.pollutant_fetches(spark, d)), path)
    return _out(read_pollutant(spark, path, time_zone="UTC").drop("fetched_at"))


DAILY_TABLES = ("weather_data", "pollutant_data", "raw_data", "cleaned_data")


def _together(tables: dict[str, DataFrame]) -> DataFrame:
    """Tables under each other by column name, with the table's name."""
    named = [df.withColumn("stored_in", F.lit(name)) for name, df in tables.items()]
    return _out(reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), named))


def _bootstrapped(spark: Spark, d: str) -> tuple[Store, str]:
    """Daily rows as CSV, loaded into a store and into Parquet files."""
    root = scratch_path(spark, "csv")
    write_csv(V.weather_daily(spark, d).withColumnRenamed("temp", " temp "), f"{root}/weather")
    write_csv(V.pollutant_daily(spark, d), f"{root}/pollutant")
    store = _store(spark, f"{root}/store")
    targets = {
        "main": {"kind": "store", "store": store},
        "copy": {"kind": "parquet", "path": f"{root}/copy", "names": {"cleaned_data": "CleanedData"}},
        "off": {"kind": "csv", "path": f"{root}/off", "enabled": False},
    }
    bootstrap(spark, f"{root}/weather", f"{root}/pollutant", targets, "0001")
    return store, f"{root}/copy"


def csv_bootstrap(spark: Spark, d: str) -> DataFrame:
    """The cleaned table of a store that was loaded from CSV."""
    return _out(current(_bootstrapped(spark, d)[0], "cleaned_data"))


def bootstrap_targets(spark: Spark, d: str) -> DataFrame:
    """All four tables of both targets that were loaded from CSV."""
    store, copy = _bootstrapped(spark, d)
    main = _together({t: current(store, t) for t in DAILY_TABLES})
    names = {t: "CleanedData" if t == "cleaned_data" else t for t in DAILY_TABLES}
    other = _together({t: spark.read.parquet(f"{copy}/{name}") for t, name in names.items()})
    return main.withColumn("target", F.lit("main")).unionByName(other.withColumn("target", F.lit("copy")))


def records_json(spark: Spark, d: str) -> DataFrame:
    rows = V.weather_daily(spark, d).select(*ID, "conditions", "icon", "preciptype")
    return to_records(rows.withColumn("date", date_text(F.col("date"))))


def _fetch_runs(spark: Spark, d: str):
    """All fetches in two runs, the second on the same days as the first."""
    weather, pollutant = V.weather_fetches(spark, d), V.pollutant_fetches(spark, d)
    for first in (True, False):
        yield (
            weather.where((F.col("status") == "F") == F.lit(first)).drop("status"),
            pollutant.where((F.col("flag") == "A") == F.lit(first)).drop("flag"),
        )


def _refreshed(spark: Spark, d: str) -> Store:
    """Two refresh runs and a compaction."""
    store = _store(spark, scratch_path(spark, "store"))
    for number, (weather, pollutant) in enumerate(_fetch_runs(spark, d), 1):
        refresh_daily(weather, pollutant, store, f"{number:04d}")
    compact(store, "cleaned_data", "0003")
    return store


def refresh_runs(spark: Spark, d: str) -> DataFrame:
    """The cleaned table after two refresh runs."""
    return _out(current(_refreshed(spark, d), "cleaned_data"))


def refresh_tables(spark: Spark, d: str) -> DataFrame:
    """All four tables after two refresh runs."""
    store = _refreshed(spark, d)
    return _together({t: current(store, t) for t in DAILY_TABLES})


def stream_refresh(spark: Spark, d: str) -> DataFrame:
    """The same two runs, landed as documents one after the other and streamed into a store."""
    root = scratch_path(spark, "stream")
    store = _store(spark, f"{root}/store")
    for weather, pollutant in _fetch_runs(spark, d):
        _land(_weather_documents(weather), f"{root}/landing/weather")
        _land(_pollutant_documents(pollutant), f"{root}/landing/pollutant")
        query = run_refresh(spark, f"{root}/landing", store, f"{root}/checkpoint", time_zone="UTC")
        query.awaitTermination()
    return _out(current(store, "cleaned_data"))


def stream_daily(spark: Spark, d: str) -> DataFrame:
    """Events streamed into daily means; the last update of each day counts."""
    root = scratch_path(spark, "daily")
    events = V.table(spark, d, "events")
    arriving = spark.readStream.schema(events.schema).option("pathGlobFilter", "events.parquet").parquet(d)
    obs = V.hourly_from_events(arriving).withColumn("obs_ts", F.col("obs_ts").cast("timestamp"))
    query = run_updates(
        daily_means(drop_repeats(obs.drop("date")), ["value"]), f"{root}/days", f"{root}/checkpoint"
    )
    query.awaitTermination()
    days = spark.read.parquet(f"{root}/days")
    return _out(last_write_wins(days, ID, "batch_id").drop("batch_id"))


def store_current(spark: Spark, d: str) -> DataFrame:
    """Three runs of forecasts with a compaction between; a date range read back."""
    store = _store(spark, scratch_path(spark, "forecasts"))
    publish({"aqi_forecast": _forecasts(spark, d, False)}, store, "0001")
    compact(store, "aqi_forecast", "0002")
    publish({"aqi_forecast": _forecasts(spark, d, True)}, store, "0003")
    return _out(Q.browse(store, "aqi_forecast", "1996-01-15", "1999-12-31"))


def _stored(spark: Spark, table: str, early: DataFrame, late: DataFrame) -> Store:
    """A store by months with two runs, each over the whole history."""
    store = Store(spark, scratch_path(spark, "monthly"))
    publish({table: early}, store, "0001")
    publish({table: late}, store, "0002")
    return store


def newest_forecast(spark: Spark, d: str) -> DataFrame:
    """The newest forecast of a store, of which one month is read."""
    return _out(Q.newest_forecast(_stored(spark, "aqi_forecast", _forecasts(spark, d, False), _forecasts(spark, d, True))))


def newest_evaluation(spark: Spark, d: str) -> DataFrame:
    """The newest score of a store, of which one month is read."""
    early, late = (_stamped(_evaluations(spark, d, pending)) for pending in (False, True))
    return _out(Q.newest_evaluation(_stored(spark, "model_evaluation", early, late)))


def series_register(spark: Spark, d: str) -> DataFrame:
    """The series of a store after two runs, a compaction and a third run."""
    store = Store(spark, scratch_path(spark, "registered"), "yyyy")
    rows = V.cleaned_daily(spark, d).persist()
    part = F.year("date")
    publish({"cleaned_data": rows.where(part < 1995)}, store, "0001")
    publish({"cleaned_data": rows.where(part == 1995)}, store, "0002")
    compact_registered(store, "cleaned_data", "0003")
    publish({"cleaned_data": rows.where((part > 1995) & (F.col("series_id").cast("int") % 3 > 0))}, store, "0004")
    rows.unpersist()
    return known_series(store)


def gbt_forecast(spark: Spark, d: str) -> DataFrame:
    """Train on all series, save and load the model, forecast seven days for each. Few trees."""
    store = _store(spark, scratch_path(spark, "model"))
    publish({"cleaned_data": V.cleaned_daily(spark, d)}, store, "0001")
    model = M.load_or_train(spark, store, RUN_TS, maxIter=3)
    return M.check_horizon(M.forecast(current(store, "cleaned_data"), model, AS_OF))


# One stump on one flag predicts the training mean of the flag's group, which SQL can state.
GROUP_MEANS = {
    "features": ["is_summer"], "maxIter": 1, "maxDepth": 1, "subsamplingRate": 1.0, "featureSubsetStrategy": "all",
}


def _group_mean_store(spark: Spark, d: str) -> tuple[Store, M.PipelineModel]:
    store = _store(spark, scratch_path(spark, "model"))
    publish({"cleaned_data": V.cleaned_daily(spark, d)}, store, "0001")
    return store, M.load_or_train(spark, store, RUN_TS, **GROUP_MEANS)


def model_group_forecast(spark: Spark, d: str) -> DataFrame:
    """Automatic training, the model saved and loaded, and the published forecast."""
    store, model = _group_mean_store(spark, d)
    return publish_forecast(store, model, AS_OF, "0002")


def model_group_scores(spark: Spark, d: str) -> DataFrame:
    """The scores that automatic training leaves in the store."""
    store, _ = _group_mean_store(spark, d)
    return _out(current(store, "model_evaluation"))


def gbt_scores(spark: Spark, d: str) -> DataFrame:
    """Scores of a freshly trained model of full size on the last fifth of each series."""
    _, scores = M.train(V.cleaned_daily(spark, d), RUN_TS)
    return scores


QUERIES = {
    f.__name__: f
    for f in (
        aqi_daily, sub_index_scaled, band_join_counts, binned_bands, coerce_numeric_date, month_flags,
        timestamp_formats, interactions_rowsum, daily_mean_first, first_per_date, latest_dates,
        refresh_average_recency, refresh_average_stored, refresh_average_together,
        refresh_average_true, interpolate_linear, backfill, lags_7, targets_7, rolling_7,
        chrono_split, last_row, lags_segmented, lags_even_runs, targets_segmented, rolling_segmented,
        interpolate_segmented, backfill_segmented, split_segmented, raw_join, cleaned_features,
        clean_pollutant_rows, clean_weather_rows, engineer_features_rows, training_rows,
        metrics_persistence, evaluation_rows, forecast_long, upsert_forecast, upsert_eval,
        upsert_by_date, concat_last_wins, latest_forecast, latest_forecast_per_series,
        forecast_chart, latest_evaluation, evaluation_card, browse_range, browse_forecast,
        browse_evaluation, browse_search_all, browse_search_column, browse_search_number,
        browse_named, current_conditions, drop_null_columns, json_weather, json_pollutant,
        csv_bootstrap, bootstrap_targets, records_json, refresh_runs, refresh_tables, stream_refresh, stream_daily, store_current,
        newest_forecast, newest_evaluation, series_register,
        gbt_forecast, gbt_scores, model_group_forecast, model_group_scores,
    )
}
