"""Joins: daily tables, value bands, latest rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from airgrain.functions.text import listed, quoted
from airgrain.operators.series import first_per_key
from airgrain.schemas import DAY, KEYS


def build_raw(
    weather: DataFrame,
    pollutant: DataFrame,
    keys: Sequence[str] = (*KEYS, DAY),
    dedup: bool = True,
    order: Sequence[str] = (),
) -> DataFrame:
    """Inner join of both daily tables. With ``dedup`` one row per key is kept, the first in
    ``order``; two daily tables give one anyway. Rows without a date are left out."""
    day = keys[-1]
    weather, pollutant = (d.where(F.col(day).isNotNull()) for d in (weather, pollutant))
    joined = weather.join(pollutant, list(keys), "inner")
    if not dedup:
        return joined
    return first_per_key(joined, keys, order) if order else joined.dropDuplicates(list(keys))


def band_join(
    df: DataFrame, bands: DataFrame, value: str, row_id: Sequence[str], name: str = "pollutant"
) -> DataFrame:
    """Long rows ``(…, name, value)`` with the first band holding the value, or nulls.

    Spark broadcasts ``bands`` if it is as small as the fixed table of 36 rows. A value on a bound
    shared by two bands matches both; the aggregate keeps the lower band.
    """
    b = bands.withColumnsRenamed({name: "_band_name"})
    inside = (F.col(name) == F.col("_band_name")) & F.col(value).between(F.col("lo"), F.col("hi"))
    band = F.struct("band_no", "lo", "hi", "index_lo", "index_hi")
    first = F.min(F.when(F.col("band_no").isNotNull(), band)).alias("_band")
    matched = df.join(b, inside, "left").groupBy(*row_id, name, value).agg(first)
    return matched.select(*row_id, name, value, "_band.*")


def binned_band_join(
    df: DataFrame, bands: DataFrame, value: str, name: str = "pollutant"
) -> DataFrame:
    """``band_join`` for a table of bands of any size: every row of ``df`` with the lowest ``band_no``
    whose ``lo`` to ``hi`` holds its value, or nulls.

    A band lies in bins at least as wide as itself, a power of two, so it stands in one or two of
    them; a value looks into its one bin of each width. Both meet by an equi-join, and bands that do
    not overlap give a value a bounded number of candidates, whatever widths occur. Each different
    value is looked up once, however many rows have it. Bands without end share one bin of their
    name. Null and NaN values, and null names, have no band; a band with a null or NaN bound, or with
    ``lo`` above ``hi``, holds nothing. Repeated rows stay.
    """
    fields = ("band_no", "lo", "hi", "index_lo", "index_hi")
    span = "CAST(hi AS double) - CAST(lo AS double)"
    # One width more than needed, since the difference may be rounded down.
    level = (
        f"CASE WHEN {span} = double('Infinity') THEN {OPEN} WHEN {span} = 0 THEN {POINT}"
        f" ELSE CAST(ceil(log2({span})) AS int) + 1 END"
    )
    known = bands.where(f"{quoted(name)} IS NOT NULL AND lo <= hi AND NOT isnan(hi)")
    known = known.selectExpr(
        f"{quoted(name)} AS _name", f"{level} AS _level", f"struct({listed(fields)}) AS _band")
    placed = known.selectExpr(
        "_name", "_level", "_band",
        f"explode(array_distinct(array({_bin('_band.lo')}, {_bin('_band.hi')}))) AS _bin")

    # Widths by name: no more of them than a double has exponents.
    levels = known.groupBy("_name").agg(F.collect_set("_level").alias("_levels"))
    looked_up = df.selectExpr(f"{quoted(name)} AS _name", f"CAST({quoted(value)} AS double) AS _value")
    looked_up = looked_up.where("_value IS NOT NULL AND NOT isnan(_value)").distinct()
    probes = looked_up.join(levels, "_name").selectExpr("_name", "_value", "explode(_levels) AS _level")
    probes = probes.selectExpr("*", f"{_bin('_value')} AS _bin")
    met = probes.join(placed, ["_name", "_level", "_bin"])
    met = met.where("_value BETWEEN CAST(_band.lo AS double) AND CAST(_band.hi AS double)")
    first = met.groupBy("_name", "_value").agg(F.min("_band").alias("_band"))

    same = (F.col(name) == F.col("_name")) & (F.col(value).cast("double") == F.col("_value"))
    return df.join(first, same, "left").select(*df.columns, "_band.*")


# Widths outside the exponents of doubles: bands without end, and bands of a single value.
OPEN, POINT = 9999, -9999


def _bin(value: str) -> str:
    """The bin of a value at ``_level``. Dividing by a power of two is exact, so bins keep the order
    of values; numbers beyond a long meet in the last bin."""
    return (
        f"CASE _level WHEN {OPEN} THEN 0L WHEN {POINT} THEN xxhash64(CAST({value} AS double) + 0D)"
        f" ELSE CAST(floor(CAST({value} AS double) / pow(2D, _level)) AS bigint) END"
    )


def latest_by(df: DataFrame, col: str, keys: Sequence[str] = KEYS) -> DataFrame:
    """Rows whose ``col`` equals the maximum of their key."""
    newest = df.groupBy(*keys).agg(F.max(col).alias(col)) if keys else df.agg(F.max(col).alias(col))
    return df.join(newest, [*keys, col], "left_semi").select(*df.columns)
