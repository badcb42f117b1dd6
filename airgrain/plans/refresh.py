"""Jobs: hourly refresh, daily retrain, bootstrap from CSV."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from airgrain.functions.sub_index import with_aqi
from airgrain.operators.aggregates import refresh_summary, refreshed
from airgrain.operators.columns import select_features
from airgrain.operators.joins import build_raw
from airgrain.operators.series import SEG, time_segment
from airgrain.plans.cleaning import clean_weather
from airgrain.plans.model import check_horizon, first_day, forecast, load_or_train, save_model, train
from airgrain.plans.register import compact_registered, known_series
from airgrain.schemas import (
    DAY,
    KEYS,
    POLLUTANT,
    POLLUTANTS,
    SUB_INDEXES,
    TABLES,
    WEATHER,
    WEATHER_NUMERIC,
    WEATHER_TEXT,
)
from airgrain.session import shuffles_released
from airgrain.sources.files import read_csv_table
from airgrain.sources.store import Store, current, publish, remove_folder, write_targets

DAILY = (*KEYS, DAY)
FETCH = "fetched_at"
SCORED = (*POLLUTANTS, *SUB_INDEXES, "AQI")


def batch_summaries(
    weather: DataFrame, pollutant: DataFrame, batch: str = "sequential", segment_seconds: int = 3600
) -> tuple[DataFrame, DataFrame]:
    """What the refresh average needs of a batch: for each kind one row per series and day.

    ``weather`` and ``pollutant`` are rows of ``sources.documents``: typed, with ``fetched_at``. Each fetch is cleaned on
    its own, as it would be if it came alone; a pollutant fetch is a single row, which
    interpolation leaves as it is, so that step needs no window here.

    The rows of each kind are shuffled once, up to the sums of the runs: all windows on weather rows are by series and
    run at least, and the sub-indices are computed behind the shuffle.
    """
    runs = time_segment(FETCH, segment_seconds)
    fetches = weather.withColumn(SEG, runs).repartition(*KEYS, SEG)
    cleaned = clean_weather(fetches, [*KEYS, SEG, FETCH], DAY)
    air = pollutant.where(F.col(DAY).isNotNull()).select(*DAILY, FETCH, *POLLUTANTS).withColumn(SEG, runs)
    if batch == "sequential":
        air = air.repartition(*DAILY, SEG)

    def summary(rows, numeric, text):
        return refresh_summary(rows, numeric, DAILY, FETCH, text, batch, F.col(SEG))

    return summary(cleaned, WEATHER_NUMERIC, WEATHER_TEXT), summary(with_aqi(air), SCORED, ())


def merged_days(
    weather: DataFrame,
    pollutant: DataFrame,
    stored_weather: DataFrame | None = None,
    stored_pollutant: DataFrame | None = None,
    batch: str = "sequential",
) -> tuple[DataFrame, DataFrame]:
    """Both averaged tables from the two ``batch_summaries``, for the days in the batch. Of the stored rows those of
    days in either summary take part, so a day with news of one kind is joined anew too."""
    days = weather.select(*DAILY).union(pollutant.select(*DAILY)).distinct()

    def refresh(summary, stored, numeric, text):
        if stored is not None:
            stored = stored.join(days, list(DAILY), "left_semi")
        return refreshed(summary, numeric, DAILY, stored, text, batch)

    return (
        refresh(weather, stored_weather, WEATHER_NUMERIC, WEATHER_TEXT),
        refresh(pollutant, stored_pollutant, SCORED, ()),
    )


def daily_tables(weather: DataFrame, pollutant: DataFrame) -> dict[str, DataFrame]:
    """All four tables from the two averaged ones."""
    raw = build_raw(weather, pollutant)
    return {
        "weather_data": weather,
        "pollutant_data": pollutant,
        "raw_data": raw,
        "cleaned_data": select_features(raw, strict=False),
    }


def refreshed_tables(
    weather: DataFrame,
    pollutant: DataFrame,
    stored_weather: DataFrame | None = None,
    stored_pollutant: DataFrame | None = None,
    batch: str = "sequential",
    segment_seconds: int = 3600,
) -> dict[str, DataFrame]:
    """The daily rows of all four tables for the days in the batch."""
    summaries = batch_summaries(weather, pollutant, batch, segment_seconds)
    return daily_tables(*merged_days(*summaries, stored_weather, stored_pollutant, batch))


def refresh_daily(
    weather: DataFrame,
    pollutant: DataFrame,
    store: Store,
    run_id: str,
    batch: str = "sequential",
) -> bool:
    """Merge one batch of fetched rows into the four daily tables, all or none.

    Only the store's periods that the batch has days in are read. The batch is read once, one kind after the other, and
    may be larger than all memory: what is kept of it is a row per series and day, in the store's folder until the run
    ends, and its shuffle files go as soon as a kind is summed up. The two averaged tables are persisted, since each is
    read several times.
    """
    if store.is_committed(run_id):
        return False
    folder = store.path("_batches", run_id)
    try:
        with shuffles_released(weather.sparkSession):
            kinds = zip(("weather", "pollutant"), batch_summaries(weather, pollutant, batch), strict=True)
            return _merge_batch(*[_kept(df, f"{folder}/{kind}") for kind, df in kinds], store, run_id, batch)
    finally:
        remove_folder(store.spark, folder)


def _kept(df: DataFrame, path: str) -> DataFrame:
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _merge_batch(
    weather: DataFrame, pollutant: DataFrame, store: Store, run_id: str, batch: str
) -> bool:
    days = weather.select(DAY).union(pollutant.select(DAY)).where(F.col(DAY).isNotNull())
    # at most one line per calendar month (or year) comes to the driver
    found = days.select(F.date_format(DAY, store.period).alias("period")).distinct().collect()
    if not found:
        return False
    periods = sorted(r["period"] for r in found)
    daily_weather, daily_pollutant = (
        df.persist(StorageLevel.MEMORY_AND_DISK)
        for df in merged_days(
            weather,
            pollutant,
            current(store, "weather_data", periods=periods),
            current(store, "pollutant_data", periods=periods),
            batch,
        )
    )
    try:
        return publish(daily_tables(daily_weather, daily_pollutant), store, run_id)
    finally:
        daily_weather.unpersist()
        daily_pollutant.unpersist()


def publish_forecast(store: Store, model, as_of, run_id: str, lookback_days=None) -> DataFrame:
    """Forecast all series from the cleaned table and upsert the rows.

    A series with no complete row to forecast from, in the lookback if there is one, is an error.
    The lookback reaches the scan of the features; the names of all series come from their register.
    """
    start = None if lookback_days is None else first_day(as_of, lookback_days)
    rows = forecast(current(store, "cleaned_data", start), model, as_of, lookback_days=lookback_days)
    rows = rows.persist(StorageLevel.MEMORY_AND_DISK)
    series = known_series(store).select(*KEYS)
    try:
        publish({"aqi_forecast": check_horizon(rows, series=series)}, store, run_id)
    finally:
        rows.unpersist()
    return current(store, "aqi_forecast")


def hourly_job(
    spark: SparkSession, weather, pollutant, store: Store, as_of, run_id: str, run_ts,
    lookback_days: int | None = None, **settings
) -> DataFrame:
    """Refresh the tables, then forecast. Without a model one is trained and its scores are upserted.
    An error stops the job."""
    refresh_daily(weather, pollutant, store, run_id)
    model = load_or_train(spark, store, run_ts, **settings)
    return publish_forecast(store, model, as_of, f"{run_id}-forecast", lookback_days)


def daily_job(
    store: Store, run_ts, run_id: str, path: str | None = None, compact_after: int = 24, **settings
) -> DataFrame:
    """Retrain, save the model and upsert its scores; then compact tables of over ``compact_after`` runs.

    The scores are committed after the model is saved, and a committed run is not trained again, so
    scores and model always belong together.
    """
    if not store.is_committed(run_id):
        model, scores = train(current(store, "cleaned_data"), run_ts, **settings)
        save_model(model, path or store.path("model"))
        publish({"model_evaluation": scores}, store, run_id)
    for table in TABLES:
        if len(store.runs(table)) > compact_after:
            compact_registered(store, table, f"{run_id}-base")
    return current(store, "model_evaluation")


def bootstrap_tables(weather: DataFrame, pollutant: DataFrame) -> dict[str, DataFrame]:
    """The four tables from two daily files: joined without dedup, index taken from the file."""
    raw = build_raw(weather, pollutant, dedup=False)
    return {
        "weather_data": weather,
        "pollutant_data": pollutant,
        "raw_data": raw,
        "cleaned_data": select_features(raw, strict=True),
    }


def bootstrap(
    spark: SparkSession,
    weather_csv: str,
    pollutant_csv: str,
    targets: Mapping[str, Mapping],
    run_id: str,
) -> dict[str, DataFrame]:
    """Load both CSV files and replace the four tables in every target."""
    tables = bootstrap_tables(
        read_csv_table(spark, weather_csv, WEATHER), read_csv_table(spark, pollutant_csv, POLLUTANT)
    )
    write_targets(tables, targets, run_id)
    return tables
