"""Engineered features and the training frame."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from airgrain.functions.scalars import row_sum
from airgrain.functions.text import quoted, with_expressions
from airgrain.operators.series import (
    add_lags,
    add_targets,
    chronological_split,
    drop_incomplete,
    rolling_sum,
)
from airgrain.schemas import DAY, FEATURES, HORIZON, KEYS, NUM_LAGS, POLLUTANTS, ROLLING, TARGETS


def engineer_features(
    df: DataFrame, keys: Sequence[str] = KEYS, ts: str = DAY, segment: Column | None = None
) -> DataFrame:
    """The ten derived columns: totals, seven-row sums, season flags and products."""
    df = rolling_sum(df, "AQI", ROLLING, keys, ts, "aqi_cum_sum_7", segment)
    df = rolling_sum(df, "pm25", ROLLING, keys, ts, "pm25_cumulative_sum_7", segment)
    day = quoted(ts)
    df = df.withColumn("total_pollution", row_sum(POLLUTANTS))
    return with_expressions(df, {
        "month": f"month({day})",
        "is_summer": f"CASE WHEN month({day}) IN (6, 7, 8) THEN 1 ELSE 0 END",
        "is_winter": f"CASE WHEN month({day}) IN (12, 1, 2) THEN 1 ELSE 0 END",
        "pm25_co_interaction": "pm25 * co",
        "temp_humidity_interaction": "temp * humidity",
        "pm25_no2_interaction": "pm25 * no2",
        "pm25_so2_interaction": "pm25 * so2",
    })


def feature_rows(
    cleaned: DataFrame, keys: Sequence[str] = KEYS, ts: str = DAY, segment: Column | None = None
) -> DataFrame:
    """Complete feature rows: features and lags by row position, then rows with a gap dropped.

    All windows share one partitioning and order, so the series is shuffled and sorted once.
    """
    featured = engineer_features(cleaned.drop("precip"), keys, ts, segment)
    lagged = add_lags(featured, "AQI", NUM_LAGS, keys, ts, segment)
    return drop_incomplete(lagged.select(*keys, ts, "AQI", *FEATURES))


def training_frame(
    cleaned: DataFrame,
    keys: Sequence[str] = KEYS,
    ts: str = DAY,
    test_fraction: float = 0.2,
    segment: Column | None = None,
) -> DataFrame:
    """34 features, 7 targets and ``split``. Targets are taken from the surviving rows only, so
    day i is the i-th complete row after this one; rows without all seven are dropped."""
    rows = add_targets(feature_rows(cleaned, keys, ts, segment), "AQI", HORIZON, keys, ts, segment)
    complete = rows.where(F.col(TARGETS[-1]).isNotNull())
    return chronological_split(complete, test_fraction, keys, ts, segment)
