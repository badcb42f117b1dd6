"""Register of the series of a stored table: who has been seen, and from which day to which.

A side table with a folder per committed run::

    <root>/_series/<table>/run_id=<run>/part-*.parquet

A committed run never changes, so neither does its entry. A run without one (a loaded file, a store
older than the register) is read once, two columns of it. The register can be deleted at any time.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from airgrain.schemas import DAY, KEYS, TABLES
from airgrain.sources.store import Store, compact, path_exists, runs_of

FOLDER = "_series"
SCHEMA = "series_id string, first_day date, last_day date"


def _entry(store: Store, table: str, run: str) -> str:
    return store.path(FOLDER, table, f"run_id={run}")


def series_of(rows: DataFrame) -> DataFrame:
    """One row a series with its first and last day; days combine in the map tasks. Rows without a
    date count for their series; a series of only such rows has no days."""
    return rows.groupBy(*KEYS).agg(F.min(DAY).alias("first_day"), F.max(DAY).alias("last_day"))


def register_run(store: Store, table: str, run: str, series: DataFrame) -> None:
    """Write the entry of a committed run; written again it stays the same."""
    series.select("series_id", "first_day", "last_day").write.mode("overwrite").parquet(_entry(store, table, run))


def unregistered(store: Store, table: str) -> list[str]:
    """Runs of the table whose entry is missing or was not finished."""
    return [r for r, _ in store.runs(table) if not path_exists(store.spark, f"{_entry(store, table, r)}/_SUCCESS")]


def known_series(store: Store, table: str = "cleaned_data") -> DataFrame:
    """``series_id, first_day, last_day`` of every series of the table as of the last commit."""
    for run in unregistered(store, table):
        register_run(store, table, run, series_of(runs_of(store, table, [run])))
    return _merged(store, table, [r for r, _ in store.runs(table)])


def _merged(store: Store, table: str, runs: Sequence[str]) -> DataFrame:
    if not runs:
        return store.spark.createDataFrame([], SCHEMA)
    entries = store.spark.read.schema(SCHEMA).parquet(*[_entry(store, table, r) for r in runs])
    return entries.groupBy(*KEYS).agg(F.min("first_day").alias("first_day"), F.max("last_day").alias("last_day"))


def compact_registered(store: Store, table: str, run_id: str) -> None:
    """``compact``; the new base has the series and days of the runs it is made of, so their entries
    are merged and the base is not read for its own."""
    has_series = "series_id" in TABLES[table].names and DAY in TABLES[table].names
    known = known_series(store, table) if has_series else None
    compact(store, table, run_id)
    if known is not None:
        register_run(store, table, run_id, known)
