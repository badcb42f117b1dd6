"""Projections, renames and row predicates."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from airgrain.functions.scalars import date_text, shown_text, utc_date
from airgrain.functions.text import quoted
from airgrain.schemas import (
    BROWSE_ORDER,
    CLEANED,
    DATE_COLUMN,
    DISPLAY_NAMES,
    KEYS,
    TABLES,
)


def trim_columns(df: DataFrame) -> DataFrame:
    return _renamed(df, [c.strip() for c in df.columns])


def lower_columns(df: DataFrame) -> DataFrame:
    """Trim and lower-case all column names."""
    return _renamed(df, [c.strip().lower() for c in df.columns])


def _renamed(df: DataFrame, names: list[str]) -> DataFrame:
    if len(set(names)) != len(names):
        raise ValueError(f"column names collide: {sorted(names)}")
    return df if names == df.columns else df.toDF(*names)


def select_features(
    df: DataFrame, names: Sequence[str] = CLEANED, keys: Sequence[str] = KEYS, strict: bool = True
) -> DataFrame:
    """Project a fixed list. Strict: a missing column is an error; else it is left out."""
    missing = [c for c in names if c not in df.columns]
    if strict and missing:
        raise ValueError(f"missing columns: {missing}")
    return df.select(*keys, *[c for c in names if c in df.columns and c not in keys])


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Fixed columns in fixed order; a column missing at the source is a typed null."""
    return df.selectExpr(*[
        f"CAST({quoted(f.name) if f.name in df.columns else 'NULL'} AS {f.dataType.simpleString()})"
        f" AS {quoted(f.name)}"
        for f in schema.fields
    ])


def canonical_order(df: DataFrame, keys: Sequence[str] = KEYS) -> DataFrame:
    """The browser's column order after the keys; columns not listed are dropped."""
    listed = [c for c in BROWSE_ORDER if c in df.columns and c not in keys]
    return df.select(*[k for k in keys if k in df.columns], *listed)


def drop_all_null_columns(df: DataFrame) -> DataFrame:
    """Drop columns that are null in every row. One aggregation pass returning a single row."""
    counts = df.agg(*[F.count(F.col(f"`{c}`")).alias(c) for c in df.columns]).first()
    return df.select(*[F.col(f"`{c}`") for c in df.columns if counts[c] > 0])


def split_columns(df: DataFrame) -> tuple[list[str], list[str]]:
    """Names of numeric and of non-numeric columns."""
    numeric = [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)]
    return numeric, [c for c in df.columns if c not in numeric]


def date_column(table: str) -> str:
    if table not in TABLES:
        raise ValueError(f"table {table!r} may not be read; allowed: {sorted(TABLES)}")
    return DATE_COLUMN[table]


def date_range(df: DataFrame, col: str, start=None, end=None) -> DataFrame:
    """Inclusive range with optional bounds, as typed literals that reach the scan.

    A text column holds ISO timestamps and is compared by its calendar date.
    """
    is_text = isinstance(df.schema[col].dataType, T.StringType)
    value = F.col(col).try_cast("timestamp").cast("date") if is_text else F.col(col)
    if start is not None:
        df = df.where(value >= F.lit(start).cast("date"))
    if end is not None:
        df = df.where(value <= F.lit(end).cast("date"))
    return df


def in_window(df: DataFrame, from_date=None, as_of=None, col: str = "date") -> DataFrame:
    """Rows from ``from_date`` (by default the ``as_of`` day alone) up to ``as_of``."""
    return date_range(df, col, as_of if from_date is None else from_date, as_of)


def search(df: DataFrame, query: str, column: str | None = None) -> DataFrame:
    """Case-insensitive substring search in one column or in any column.

    A null never matches, not even the empty query.
    """
    fields = [f for f in df.schema.fields if column is None or f.name == column]
    if not fields:
        raise ValueError(f"no column {column!r}")
    wanted = query.lower()
    hits: list[Column] = [
        F.coalesce(F.lower(shown_text(f.name, f.dataType)).contains(wanted), F.lit(False))
        for f in fields
    ]
    return df.where(reduce(Column.__or__, hits))


def normalize_date_column(df: DataFrame, table: str, keys: Sequence[str] = KEYS) -> DataFrame:
    """The table's date column as text ``date``, first after the keys; null becomes 'N/A'."""
    source = date_column(table)
    is_text = isinstance(df.schema[source].dataType, T.StringType)
    day = utc_date(F.col(source).try_cast("timestamp")) if is_text else F.col(source)
    shown = F.coalesce(date_text(day), F.lit("N/A")).alias("date")
    lead = [k for k in keys if k in df.columns]
    return df.select(*lead, shown, *[c for c in df.columns if c not in (source, "date", *lead)])


def display_names(df: DataFrame) -> DataFrame:
    return df.withColumnsRenamed({c: n for c, n in DISPLAY_NAMES.items() if c in df.columns})
