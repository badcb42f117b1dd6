"""Cleaning of pollutant and weather rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from airgrain.functions.scalars import nan_to_null, parse_date, to_number
from airgrain.functions.sub_index import with_aqi
from airgrain.operators.columns import split_columns, trim_columns
from airgrain.operators.series import Order, backfill, first_per_key, interpolate_linear
from airgrain.schemas import DAY, KEYS, POLLUTANTS
from airgrain.session import compiled_apart


def type_pollutant(df: DataFrame, ts: str = DAY) -> DataFrame:
    """Trimmed names, numeric concentrations, a real date; bad text becomes null."""
    df = trim_columns(df)
    types = dict(df.dtypes)
    typed = {p: to_number(F.col(p)) for p in POLLUTANTS if types[p] == "string"}
    if types[ts] != "date":
        typed[ts] = parse_date(F.col(ts))
    return nan_to_null(df.withColumns(typed) if typed else df)


def clean_pollutant(
    df: DataFrame,
    keys: Sequence[str] = KEYS,
    ts: str = DAY,
    order: Order | None = None,
    scale: bool = False,
    segment: Column | None = None,
) -> DataFrame:
    """Typed, interpolated along the series, then sub-indices and the daily index.

    ``order`` defaults to the date. Several rows per day make a series as long as its
    observations: give the arrival order and a ``segment`` (see ``operators.series``).
    """
    typed = type_pollutant(df, ts)
    filled = interpolate_linear(typed, POLLUTANTS, keys, order or ts, segment)
    return compiled_apart(with_aqi(compiled_apart(filled), scale))


def clean_weather(
    df: DataFrame, keys: Sequence[str] = KEYS, ts: str = DAY, tie: Sequence[str] = ()
) -> DataFrame:
    """One row per date (the first in ``tie`` order), numbers interpolated, all gaps at the start
    filled backwards. Rows are unique per day afterwards, so a series is bounded by the calendar."""
    df = trim_columns(df)
    if dict(df.dtypes)[ts] != "date":
        df = df.withColumn(ts, parse_date(F.col(ts)))
    df = nan_to_null(df.drop("datetime")).where(F.col(ts).isNotNull())
    once = first_per_key(df, [*keys, ts], list(tie) or [ts])
    numeric, other = split_columns(once.drop(*keys, ts, *tie))
    filled = interpolate_linear(once, numeric, keys, ts, backward=True)
    return backfill(filled, other, keys, ts)
