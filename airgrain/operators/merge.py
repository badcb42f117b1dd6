"""Union by name and keyed upserts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def concat(stored: DataFrame, new: DataFrame) -> DataFrame:
    """Both row sets, columns matched by name, missing ones null. ``_order`` is 0 for stored rows
    and 1 for new ones."""
    return stored.withColumn("_order", F.lit(0)).unionByName(
        new.withColumn("_order", F.lit(1)), allowMissingColumns=True
    )


def upsert(target: DataFrame, new: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of ``new`` replace rows of ``target`` with the same key. Keys are unique in ``new``.

    Only the keys of ``new`` meet the target (anti-join), so a small batch is broadcast by size
    and a large target is not shuffled.
    """
    kept = target.join(new.select(*keys), list(keys), "left_anti")
    return kept.unionByName(new, allowMissingColumns=True)


def last_write_wins(df: DataFrame, keys: Sequence[str], version: str | Sequence[str]) -> DataFrame:
    """The row with the highest version per key. Map tasks already keep one row per key."""
    version = [version] if isinstance(version, str) else list(version)
    newest = Window.partitionBy(*keys).orderBy(*[F.col(c).desc() for c in version])
    return df.withColumn("_rn", F.row_number().over(newest)).where("_rn = 1").drop("_rn")
