"""CSV and JDBC scans and sinks, JSON records."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from airgrain.functions.scalars import nan_to_null, parse_date, to_number
from airgrain.operators.columns import trim_columns


def read_csv_table(
    spark: SparkSession, path: str, schema: T.StructType, date_formats: tuple[str, ...] = ()
) -> DataFrame:
    """CSV with a header, typed by ``schema``: columns are matched by trimmed name, a missing one
    is null, bad numbers and dates become null. All columns are read as text, so no pass over the
    data is spent on guessing types."""
    raw = trim_columns(spark.read.option("header", True).option("inferSchema", False).csv(path))

    def typed(field: T.StructField) -> Column:
        if field.name not in raw.columns:
            return F.lit(None).cast(field.dataType).alias(field.name)
        col = F.col(f"`{field.name}`")
        if isinstance(field.dataType, T.DateType):
            return parse_date(col, date_formats).alias(field.name)
        if isinstance(field.dataType, T.DoubleType):
            return to_number(col).alias(field.name)
        return col.try_cast(field.dataType).alias(field.name)

    return nan_to_null(raw.select(*[typed(f) for f in schema.fields]))


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    df.write.mode(mode).option("header", True).csv(path)


def jdbc_options(
    url: str,
    table: str,
    column: str | None = None,
    lower=None,
    upper=None,
    partitions: int = 16,
    properties: Mapping[str, str] | None = None,
) -> dict[str, str]:
    """Options of a JDBC scan; with ``column`` the table is read in parallel ranges of it."""
    options = {"url": url, "dbtable": table, **(properties or {})}
    if column is not None:
        options |= {
            "partitionColumn": column,
            "lowerBound": str(lower),
            "upperBound": str(upper),
            "numPartitions": str(partitions),
        }
    return options


def read_jdbc(spark: SparkSession, **kwargs) -> DataFrame:
    """Filters and projections on the result are pushed into the database by Spark."""
    return nan_to_null(spark.read.format("jdbc").options(**jdbc_options(**kwargs)).load())


def write_jdbc(df: DataFrame, url: str, table: str, mode: str = "append", properties=None) -> None:
    """Append or replace; a keyed upsert needs the Parquet store."""
    df.write.format("jdbc").options(**jdbc_options(url, table, properties=properties)).mode(mode).save()


def to_records(df: DataFrame, name: str = "record") -> DataFrame:
    """One JSON text per row, nulls written out, NaN as null."""
    return nan_to_null(df).select(
        F.to_json(F.struct("*"), {"ignoreNullFields": "false"}).alias(name)
    )


def write_records(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    nan_to_null(df).write.mode(mode).option("ignoreNullFields", False).json(path)
