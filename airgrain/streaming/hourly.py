"""Streaming forms: hourly observations to daily rows, and the refresh job per micro-batch."""

from __future__ import annotations

from collections.abc import Sequence
from zlib import crc32

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from airgrain.plans.refresh import refresh_daily
from airgrain.schemas import (
    DAY,
    KEYS,
    POLLUTANT_DOCUMENT,
    TIME_ZONE,
    WEATHER_DOCUMENT,
)
from airgrain.sources.documents import JSON_OPTIONS, pollutant_rows, readable, weather_rows, with_corrupt
from airgrain.sources.store import Store, make_folder


def drop_repeats(
    observations: DataFrame,
    ts: str = "obs_ts",
    keys: Sequence[str] = KEYS,
    delay: str = "2 days",
) -> DataFrame:
    """One row per series and time; the state is dropped once the watermark has passed."""
    return observations.withWatermark(ts, delay).dropDuplicatesWithinWatermark([*keys, ts])


def daily_means(
    observations: DataFrame, values: Sequence[str], ts: str = "obs_ts", keys: Sequence[str] = KEYS
) -> DataFrame:
    """Daily tumbling means; needs a watermark on the input. Partial sums form in the map tasks."""
    day = F.window(ts, "1 day")
    means = observations.groupBy(*keys, day).agg(
        F.count(F.lit(1)).alias("n"), *[F.avg(v).alias(v) for v in values]
    )
    return means.select(*keys, F.to_date("window.start").alias(DAY), "n", *values)


def run_to_parquet(df: DataFrame, path: str, checkpoint: str, available_now: bool = True) -> StreamingQuery:
    """Append mode: days appear once the watermark has closed them."""
    writer = df.writeStream.outputMode("append").format("parquet")
    writer = writer.option("path", path).option("checkpointLocation", checkpoint)
    if available_now:
        writer = writer.trigger(availableNow=True)
    return writer.start()


def rows_behind_watermark(query: StreamingQuery) -> int:
    """Rows that the query's batches left out because they came later than the watermark allows."""
    states = [state for progress in query.recentProgress for state in progress["stateOperators"]]
    return sum(state["numRowsDroppedByWatermark"] for state in states)


def run_closed_days(
    observations: DataFrame,
    values: Sequence[str],
    path: str,
    checkpoint: str,
    ts: str = "obs_ts",
    keys: Sequence[str] = KEYS,
    ident: Sequence[str] = (),
    delay: str = "2 days",
) -> StreamingQuery:
    """Daily means that never change once written: a day appears when the watermark, ``delay`` behind the newest time
    of the batches before, has passed its end. Repeats (equal in keys, time and ``ident``) count once, rows at or behind
    the watermark are left out, and the state of closed days and old rows is evicted."""
    once = drop_repeats(observations, ts, (*keys, *ident), delay)
    return run_to_parquet(daily_means(once, values, ts, keys), path, checkpoint)


def write_updates(batch: DataFrame, batch_id: int, path: str) -> None:
    """Changed days of one micro-batch in a folder of their own; a replay overwrites it."""
    batch.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id:012d}")


def run_updates(df: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Update mode: each micro-batch writes the days it changed; the newest batch of a day counts."""
    return (
        df.writeStream.outputMode("update")
        .trigger(availableNow=True)
        .option("checkpointLocation", checkpoint)
        .foreachBatch(lambda rows, batch_id: write_updates(rows, batch_id, path))
        .start()
    )


def folder_series(path: Column) -> Column:
    """The ``series_id=...`` folder of a file path as Spark reports it: URI-encoded, and escaped by the writer."""
    found = F.nullif(F.regexp_extract(path, "/series_id=([^/]*)/", 1), F.lit(""))
    for _ in range(2):
        found = F.url_decode(F.replace(found, F.lit("+"), F.lit("%2B")))
    return F.nullif(found, F.lit("__HIVE_DEFAULT_PARTITION__"))


def run_refresh(
    spark: SparkSession,
    landing: str,
    store: Store,
    checkpoint: str,
    files_per_batch: int | None = None,
    time_zone: str = TIME_ZONE,
    run_prefix: str = "stream",
    multi_line: bool = False,
) -> StreamingQuery:
    """The refresh job on documents as they land in ``<landing>/weather`` and ``/pollutant``.

    A document is a line, or with ``multi_line`` a file. Each kind has its own source, both in one
    stream, so that one micro-batch sees one set of files of each (``files_per_batch`` counts per
    kind). A document without ``series_id`` takes that of its ``series_id=...`` folder. Text that is
    no document stops the stream with an error. The run id comes from the checkpoint's path and the
    batch id; a committed run is skipped, so a replay changes nothing.
    """

    def landed(kind: str) -> DataFrame:
        make_folder(spark, f"{landing}/{kind}")
        reader = spark.readStream.option("recursiveFileLookup", True)
        if files_per_batch:
            reader = reader.option("maxFilesPerTrigger", files_per_batch)
        folder = folder_series(F.col("_metadata.file_path")).alias("_series")
        texts = reader.text(f"{landing}/{kind}", wholetext=multi_line)
        return texts.select(F.lit(kind).alias("_kind"), "value", folder)

    def parsed(batch: DataFrame, kind: str, schema: StructType) -> DataFrame:
        mine = batch.where((F.col("_kind") == kind) & (F.trim("value") != ""))
        document = F.from_json("value", with_corrupt(schema), JSON_OPTIONS).alias("d")
        rows = mine.select(document, "_series")
        names = [F.col(f"d.{c}") for c in with_corrupt(schema).names if c != "series_id"]
        return readable(rows.select(F.coalesce("d.series_id", "_series").alias("series_id"), *names))

    stream = f"{run_prefix}-{crc32(checkpoint.rstrip('/').encode()):08x}"

    def merge(batch: DataFrame, batch_id: int) -> None:
        refresh_daily(
            weather_rows(parsed(batch, "weather", WEATHER_DOCUMENT)),
            pollutant_rows(parsed(batch, "pollutant", POLLUTANT_DOCUMENT), None, time_zone),
            store,
            f"{stream}-{batch_id:012d}",
        )

    return (
        landed("weather").unionByName(landed("pollutant")).writeStream.trigger(availableNow=True)
        .option("checkpointLocation", checkpoint)
        .foreachBatch(merge)
        .start()
    )
