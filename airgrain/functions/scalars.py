"""Column functions: text coercion, missing values, dates, rounding."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from airgrain.functions.text import quoted, with_expressions

NUMBER = r"^\s*[+-]?((\d+\.?\d*|\.\d+)([eE][+-]?\d+)?|(?i:inf(inity)?))\s*$"


def to_number(col: Column) -> Column:
    """Text to double; anything that is not a number becomes null."""
    text = col.cast("string")
    return F.when(text.rlike(NUMBER), F.trim(text).try_cast("double"))


def parse_date(col: Column, formats: Sequence[str] = ()) -> Column:
    """Text or timestamp to date; bad text becomes null. Extra formats are tried in order."""
    tried = [F.to_date(F.try_to_timestamp(F.trim(col), F.lit(f))) for f in formats]
    return F.coalesce(F.trim(col.cast("string")).try_cast("date"), *tried)


def parse_date_strict(col: Column) -> Column:
    """Text to date; bad text fails the job (ANSI mode)."""
    return F.to_date(col)


def date_text(col: Column) -> Column:
    return F.date_format(col, "yyyy-MM-dd")


def datetime_text(col: Column) -> Column:
    return F.date_format(col, "yyyy-MM-dd HH:mm:ss")


def score_time_text(col: Column) -> Column:
    """Day/month/year, hour:minute on a 24-hour clock."""
    return F.date_format(col, "d/M/yyyy, HH:mm")


def comma_list(col: Column) -> Column:
    """Array of text to one comma-separated text; empty or missing becomes null."""
    return F.nullif(F.array_join(col, ","), F.lit(""))


def _floating(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, (T.DoubleType, T.FloatType))]


def nan_to_null(df: DataFrame) -> DataFrame:
    """NaN and null are one thing here; only floating columns can hold NaN."""
    return _each(df, _floating(df), "nullif({}, double('NaN'))")


def _each(df: DataFrame, names: Iterable[str], template: str) -> DataFrame:
    changed = {n: template.format(quoted(n)) for n in names}
    return with_expressions(df, changed) if changed else df


def utc_date(col: Column, time_zone: str = "UTC") -> Column:
    """Calendar date in UTC of a local timestamp."""
    return F.to_date(F.to_utc_timestamp(col, time_zone))


def local_date(col: Column, time_zone: str) -> Column:
    """Calendar date in a time zone of an instant, whatever the session's zone."""
    seconds = F.unix_micros(col).cast("decimal(20,0)") / F.lit(1_000_000).cast("decimal(7,0)")
    utc = F.expr("timestamp_ntz'1970-01-01 00:00:00'") + F.make_dt_interval(secs=seconds)
    return F.to_date(F.convert_timezone(F.lit("UTC"), F.lit(time_zone), utc))


def is_summer(month: Column) -> Column:
    return F.coalesce(month.isin(6, 7, 8), F.lit(False)).cast("int")


def is_winter(month: Column) -> Column:
    return F.coalesce(month.isin(12, 1, 2), F.lit(False)).cast("int")


def percent(col: Column, decimals: int = 3) -> Column:
    return F.round(col * 100, decimals)


def row_sum(cols: Iterable[str]) -> Column:
    """Sum over columns of one row; null counts as 0, so all-null gives 0."""
    return F.expr(" + ".join(["0.0D", *[f"coalesce({quoted(c)}, 0.0D)" for c in cols]]))


def row_max(cols: Iterable[str]) -> Column:
    """Largest of several columns of one row, nulls skipped; all-null gives null."""
    return F.expr(f"greatest({', '.join(quoted(c) for c in cols)})")


def round_floats(df: DataFrame, decimals: int) -> DataFrame:
    return _each(df, _floating(df), f"round({{}}, {decimals})")


def shown_text(name: str, dtype: T.DataType, decimals: int = 3) -> Column:
    """A value as the browser prints it: whole numbers without a fraction, no exponent."""
    col = F.col(f"`{name}`")
    if isinstance(dtype, (T.DoubleType, T.FloatType)):
        fixed = col.try_cast(f"decimal(38,{decimals})").cast("string")
        return F.regexp_replace(fixed, r"\.?0+$", "")
    return col.cast("string")
