"""Landed weather and pollutant documents, as batch or as stream."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructType

from airgrain.functions.scalars import local_date, nan_to_null, parse_date
from airgrain.schemas import (
    POLLUTANT_DOCUMENT,
    POLLUTANTS,
    SUB_INDEXES,
    TIME_ZONE,
    WEATHER_COLUMNS,
    WEATHER_DOCUMENT,
    WEATHER_LISTS,
)


CORRUPT = "_corrupt"
JSON_OPTIONS = {"columnNameOfCorruptRecord": CORRUPT}


def with_corrupt(schema: StructType) -> StructType:
    """The document schema with a place for text that is no such document."""
    return StructType(list(schema.fields)).add(CORRUPT, StringType())


def readable(documents: DataFrame) -> DataFrame:
    """The documents without their corrupt text; a text of which no field could be read raises.

    A field of the wrong type alone becomes null, as a missing one does. ``series_id`` does not
    count as read, since a folder name may have filled it. The check is part of every other field,
    as a filter would run after those that Spark derives from the later plan.
    """
    fields = [c for c in documents.columns if c not in (CORRUPT, "series_id")]
    lost = F.col(CORRUPT).isNotNull()
    for name in fields:
        lost = lost & F.col(name).isNull()
    failure = F.raise_error(F.concat(F.lit("unreadable document: "), F.substring(CORRUPT, 1, 200)))
    return documents.withColumns(
        {name: F.when(lost, failure).otherwise(F.col(name)) for name in fields}
    ).drop(CORRUPT)


def weather_rows(documents: DataFrame) -> DataFrame:
    """One row per element of ``days``; no ``days`` gives no row. The address repeats on each."""
    days = documents.selectExpr(
        "series_id", "fetched_at", "coalesce(resolvedAddress, 'Unknown') AS name", "explode(days) AS day"
    )

    def value(c: str) -> str:
        if c == "name":
            return c
        field = f"day.{c}"
        return f"nullif(array_join({field}, ','), '') AS {c}" if c in WEATHER_LISTS else field

    dated = parse_date(F.col("day.datetime")).alias("date")
    rows = days.select("series_id", "fetched_at", "name", "day", dated)
    return nan_to_null(
        rows.selectExpr("series_id", "fetched_at", "date", *[value(c) for c in WEATHER_COLUMNS])
    )


def pollutant_rows(documents: DataFrame, as_of=None, time_zone: str = TIME_ZONE) -> DataFrame:
    """One row per document, dated by its fetch in the site's time zone, or by ``as_of``.

    The reported index lands in ``AQI``; the sub-indices are computed later.
    """
    day = local_date(F.col("fetched_at"), time_zone)
    if as_of is not None:
        day = F.coalesce(day, F.lit(as_of).cast("date"))
    return nan_to_null(documents.withColumn("date", day).selectExpr(
        "series_id",
        "fetched_at",
        "date",
        *[f"data.iaqi.{p}.v AS {p}" for p in POLLUTANTS],
        *[f"CAST(NULL AS double) AS {c}" for c in SUB_INDEXES],
        "data.aqi AS AQI",
    ))


def read_weather(spark: SparkSession, path: str, multi_line: bool = False) -> DataFrame:
    """Weather documents, one per line (or one per file with ``multi_line``)."""
    return weather_rows(_read(spark, WEATHER_DOCUMENT, path, multi_line))


def read_pollutant(
    spark: SparkSession, path: str, as_of=None, time_zone: str = TIME_ZONE, multi_line: bool = False
) -> DataFrame:
    return pollutant_rows(_read(spark, POLLUTANT_DOCUMENT, path, multi_line), as_of, time_zone)


def _read(spark: SparkSession, schema: StructType, path: str, multi_line: bool) -> DataFrame:
    reader = spark.read.schema(with_corrupt(schema)).options(**JSON_OPTIONS)
    return readable(reader.option("multiLine", multi_line).json(path))
