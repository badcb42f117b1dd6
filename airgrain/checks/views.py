"""The driver tables seen as air-quality series.

Values are whole numbers or quarters, so that means and sums are the same in any order of addition.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from airgrain.functions.sub_index import with_aqi
from airgrain.operators.aggregates import daily_aggregate
from airgrain.operators.columns import select_features
from airgrain.operators.joins import build_raw
from airgrain.schemas import WEATHER_COLUMNS, WEATHER_TEXT

ARRIVAL = ("seq", "line", "part", "supp")
MICROS_PER_DAY = 86_400_000_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def pollutant_obs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items as pollutant observations of the supplier's nation, dated by shipping."""
    joined = table(spark, sf_dir, "lineitem").join(
        table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey"),
        F.expr("l_suppkey = s_suppkey"),
    )
    values = {
        "pm25": "l_quantity * 6",
        "pm10": "l_quantity * 10",
        "o3": "CAST(floor(l_extendedprice / 25) / 4 AS double)",
        "no2": "round(l_discount * 100) * 50",
        "so2": "round(l_tax * 100) * 200",
        "co": "CASE WHEN l_linenumber <> 5 THEN l_quantity * 0.75D END",
    }
    heard = "NOT (l_returnflag = 'R' AND l_linenumber % 2 = 0)"
    return joined.selectExpr(
        "CAST(s_nationkey AS string) AS series_id",
        "CAST(l_shipdate AS date) AS date",
        "l_orderkey AS seq",
        "l_linenumber AS line",
        "l_partkey AS part",
        "l_suppkey AS supp",
        "l_returnflag AS flag",
        *[f"CASE WHEN {heard} THEN {value} END AS {name}" for name, value in values.items()],
    )


def weather_obs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as weather observations of the customer's nation, dated by ordering."""
    joined = table(spark, sf_dir, "orders").join(
        table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey"),
        F.expr("o_custkey = c_custkey"),
    )
    base = joined.selectExpr(
        "CAST(c_nationkey AS string) AS series_id", "CAST(o_orderdate AS date) AS date",
        "o_orderkey AS k", "CAST(floor(o_totalprice / 2500) / 4 AS double) AS t",
        "o_orderstatus AS status", "o_orderpriority AS priority",
    )
    minute = "lpad(CAST(k % 60 AS string), 2, '0')"
    values = {
        "name": "concat('NATION_', series_id)",
        "tempmax": "t + k % 7", "tempmin": "t - k % 5", "temp": "t",
        "feelslikemax": "t + k % 7 + 1", "feelslikemin": "t - k % 5 - 1", "feelslike": "t + k % 3",
        "dew": "CASE WHEN k % 3 <> 0 THEN k % 31 END", "humidity": "k % 100",
        "precip": "k % 13", "precipprob": "k % 101", "precipcover": "k % 51",
        "preciptype": "CASE k % 4 WHEN 1 THEN 'rain' WHEN 2 THEN 'snow' WHEN 3 THEN 'rain,snow' END",
        "snow": "k % 2", "snowdepth": "CASE WHEN k % 2 <> 0 THEN k % 9 END",
        "windgust": "CASE WHEN k % 4 <> 1 THEN k % 80 END", "windspeed": "k % 40",
        "winddir": "k % 360", "sealevelpressure": "k % 60 + 980", "cloudcover": "k % 97",
        "visibility": "k % 25", "solarradiation": "k % 301", "solarenergy": "k % 29",
        "uvindex": "k % 11", "severerisk": "NULL",
        "sunrise": f"concat('06:', {minute}, ':00')", "sunset": f"concat('18:', {minute}, ':00')",
        "moonphase": "k % 8", "conditions": "CASE WHEN k % 5 <> 0 THEN status END",
        "description": "priority", "icon": "CASE WHEN k % 2 = 0 THEN 'clear-day' ELSE 'cloudy' END",
        "stations": "concat('S', CAST(k % 17 AS string))",
    }
    return base.selectExpr(
        "series_id", "date", "k AS seq", "status",
        *[
            f"CAST({values[c]} AS {'string' if c in WEATHER_TEXT else 'double'}) AS {c}"
            for c in WEATHER_COLUMNS
        ],
    )


def hourly_obs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as timed observations: five series, each holding a fifth of all rows."""
    return hourly_from_events(table(spark, sf_dir, "events"))


def hourly_from_events(events: DataFrame) -> DataFrame:
    e = F.col("event_id")
    return events.select(
        F.col("event_type").alias("series_id"),
        F.col("ts").cast("date").alias("date"),
        F.col("ts").alias("obs_ts"),
        e.alias("seq"),
        F.expr("CAST(CASE WHEN event_id % 4 <> 0 THEN floor(value * 4) / 4 END AS double) AS value"),
        F.when(e % 3 == 0, F.concat(F.lit("u"), F.col("user_id").cast("string"))).alias("note"),
        "props",
    )


def pollutant_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily means; the index is computed from them."""
    return with_aqi(daily_aggregate(pollutant_obs(spark, sf_dir).drop("flag"), order=ARRIVAL))


def weather_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    return daily_aggregate(weather_obs(spark, sf_dir).drop("status"), order="seq")


def raw_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both daily tables joined; the means are unique per day already."""
    return build_raw(weather_daily(spark, sf_dir), pollutant_daily(spark, sf_dir), dedup=False)


def cleaned_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    return select_features(raw_daily(spark, sf_dir))


def fetched(day: Column, micros: Column) -> Column:
    """A UTC moment inside the day."""
    offset = F.expr("INTERVAL '0.000001' SECOND") * (micros % MICROS_PER_DAY)
    return day.cast("timestamp") + offset


def weather_fetches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Weather observations as single fetches with a time."""
    rows = weather_obs(spark, sf_dir)
    return rows.withColumn("fetched_at", fetched(F.col("date"), F.col("seq"))).drop("seq")


def pollutant_fetches(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = pollutant_obs(spark, sf_dir)
    micros = (F.col("seq") * 8 + F.col("line")) * 2000 + F.col("part") % 2000
    return rows.withColumn("fetched_at", fetched(F.col("date"), micros)).drop(*ARRIVAL)
