"""Pollutant sub-indices and the daily air-quality index."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from airgrain.functions.scalars import row_max
from airgrain.functions.text import quoted, with_expressions
from airgrain.schemas import BANDS, INDEX_RANGES, POLLUTANTS


def sub_index(col: str, bands: Sequence[tuple], scale: bool = False) -> Column:
    """The concentration itself if it lies in a band, else null.

    ``scale=True`` gives the linear index of the band instead. The first band wins where two
    bands share a bound; values between bands or above the last one have no index.
    """
    return F.expr(_sub_index(col, bands, scale))


def _sub_index(col: str, bands: Sequence[tuple], scale: bool) -> str:
    x = quoted(col)
    inside = [f"{x} BETWEEN {float(low)}D AND {float(high)}D" for low, high in bands]
    if not scale:
        # one test for all bands keeps the generated code small
        return f"CASE WHEN {' OR '.join(inside)} THEN {x} END"
    steps = [
        f"WHEN {test} THEN {(last - first) / (high - low)!r}D * ({x} - {float(low)}D) + {float(first)}D"
        for test, (low, high), (first, last) in zip(inside, bands, INDEX_RANGES, strict=True)
    ]
    return f"CASE {' '.join(steps)} END"


def with_aqi(df: DataFrame, scale: bool = False) -> DataFrame:
    """Add the six sub-indices and their row maximum; a reported ``AQI`` is overwritten."""
    scored = with_expressions(
        df, {f"AQI_{p}": _sub_index(p, BANDS[p], scale) for p in POLLUTANTS}
    )
    return scored.withColumn("AQI", row_max([f"AQI_{p}" for p in POLLUTANTS]))


def band_table(spark: SparkSession) -> DataFrame:
    """The 36 bands as rows ``(pollutant, band_no, lo, hi, index_lo, index_hi)``."""
    rows = [
        (p, i + 1, float(lo), float(hi), float(INDEX_RANGES[i][0]), float(INDEX_RANGES[i][1]))
        for p, bands in BANDS.items()
        for i, (lo, hi) in enumerate(bands)
    ]
    return spark.createDataFrame(
        rows,
        "pollutant string, band_no int, lo double, hi double, index_lo double, index_hi double",
    )
