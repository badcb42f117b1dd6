"""Read queries over the stored tables; each is one lazy plan."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from airgrain.functions.scalars import nan_to_null, percent, round_floats, score_time_text
from airgrain.operators.columns import (
    canonical_order,
    date_column,
    date_range,
    display_names,
    in_window,
    lower_columns,
    normalize_date_column,
    search,
)
from airgrain.operators.joins import latest_by
from airgrain.operators.series import last_row
from airgrain.schemas import DAY, KEYS, PARTITION_COLUMN
from airgrain.sources.store import Store, current, newest_period

# The fields of the current-conditions view, by group.
WEATHER_CARD = (
    "name", "date", "conditions",
    "temp", "feelslike", "tempmax", "tempmin",
    "windspeed", "windgust", "winddir",
    "precip", "precipprob", "snow", "snowdepth", "cloudcover", "visibility", "severerisk", "humidity",
    "dew", "sealevelpressure", "uvindex", "solarenergy", "solarradiation", "sunrise", "sunset", "moonphase",
)
POLLUTANT_CARD = ("pm25", "pm10", "o3", "no2", "so2", "co", "AQI")


def latest_evaluation(evaluations: DataFrame) -> DataFrame:
    """The newest score row of all; empty if there is none."""
    newest = evaluations.orderBy(F.col("timestamp").desc_nulls_last()).limit(1)
    return nan_to_null(lower_columns(newest))


def evaluation_card(evaluations: DataFrame) -> DataFrame:
    """The newest score as shown: three decimals, MAPE in percent, readable time."""
    newest = latest_evaluation(evaluations)
    return newest.select(
        score_time_text(F.col("timestamp").try_cast("timestamp")).alias("created_at"),
        *[F.round(m, 3).alias(m) for m in ("mae", "r2", "rmse")],
        percent(F.col("mape")).alias("mape"),
    )


def latest_forecast(
    forecasts: DataFrame, keys: Sequence[str] = (), ordered: bool = True
) -> DataFrame:
    """Rows of the newest forecast date, by predicted date. With ``keys``: the newest of each."""
    rows = nan_to_null(latest_by(forecasts, "forecast_date", keys))
    return rows.orderBy("predicted_date", *KEYS) if ordered else rows


def newest_forecast(store: Store, ordered: bool = True) -> DataFrame:
    """``latest_forecast`` of the stored table; reads the newest period of forecast dates only."""
    return latest_forecast(newest_period(store, "aqi_forecast"), ordered=ordered)


def newest_evaluation(store: Store) -> DataFrame:
    """``latest_evaluation`` of the stored table; reads the newest period of score dates only, since a
    score's date is that of its time. Scores without a date are not seen."""
    return latest_evaluation(newest_period(store, "model_evaluation"))


def forecast_chart(forecasts: DataFrame) -> DataFrame:
    """Points of the chart with their whole-number labels."""
    return latest_forecast(forecasts).select(
        *KEYS, "predicted_date", "predicted_aqi", F.round("predicted_aqi", 0).alias("label")
    )


def browse_rows(
    df: DataFrame,
    table: str,
    start=None,
    end=None,
    query: str | None = None,
    column: str | None = None,
    ordered: bool = True,
    named: bool = False,
) -> DataFrame:
    """The table browser: range, column order, sort, display rounding and search.

    The range and the projection reach the scan. ``query=None`` means no search.
    """
    day = date_column(table)
    rows = canonical_order(lower_columns(date_range(df, day, start, end)))
    if ordered:
        rows = rows.orderBy(F.col(day).asc_nulls_last(), *KEYS)
    rows = round_floats(normalize_date_column(nan_to_null(rows), table), 3)
    if query is not None:
        rows = search(rows, query, column)
    return display_names(rows) if named else rows


def browse(store: Store, table: str, start=None, end=None, query=None, column=None, **kwargs):
    """``browse_rows`` on a stored table; only allowed tables can be read."""
    day = date_column(table)
    bounds = (start, end) if PARTITION_COLUMN[table] == day else (None, None)
    return browse_rows(current(store, table, *bounds), table, start, end, query, column, **kwargs)


def current_conditions(
    weather: DataFrame, pollutant: DataFrame, from_date=None, as_of=None, keys=KEYS, ts: str = DAY
) -> DataFrame:
    """The newest weather row of each series with the newest pollutant row beside it."""
    if from_date is not None or as_of is not None:
        weather, pollutant = (in_window(d, from_date, as_of, ts) for d in (weather, pollutant))
    now = last_row(weather.select(*keys, *WEATHER_CARD), keys, ts)
    air = last_row(pollutant.select(*keys, ts, *POLLUTANT_CARD), keys, ts).drop(ts)
    return nan_to_null(now.join(air, list(keys), "left"))
