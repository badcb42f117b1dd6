"""Helpers shared by the operators: tables, scratch tables, let-binding, gapless numbering."""

from __future__ import annotations

import sys
import types
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from airgrain.session import scratch_path

# Whitespace of the contracts, as a character class body.
SPACE = r"\x20\x09-\x0D"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def saved(df: DataFrame, name: str) -> DataFrame:
    """Write to the shared scratch folder and read back: cuts lineage and survives lost executors."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def worker_state() -> dict:
    """A dictionary that lives as long as the Python worker, which Spark uses for one task after another. For what any task could compute again."""
    return sys.modules.setdefault("airgrain_worker_state", types.ModuleType("airgrain_worker_state")).__dict__


def discard(df: DataFrame) -> None:
    """Delete the scratch files of a table of ``saved`` that nothing reads any more."""
    spark = df.sparkSession
    for file in {f.rpartition("/")[0] for f in df.inputFiles()}:
        path = spark._jvm.org.apache.hadoop.fs.Path(file)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def free(columns: list[str], *names: str) -> list[str]:
    """``names``, each with as many underscores after it as it takes to be none of ``columns`` (whose case does not count)."""
    taken, out = {c.lower() for c in columns}, []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Evaluate ``value`` once and hand it to ``body``, also where ``body`` uses it inside a lambda."""
    return F.element_at(F.transform(F.array(value), body), 1)


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z only. Pure ASCII text takes the fast built-in."""
    return F.when(F.length(text) == F.octet_length(text), F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))


def crc_mod(column: Column, n: int) -> Column:
    """crc32 of the value as text, modulo ``n``; null counts as empty text."""
    return F.crc32(F.coalesce(column.cast("string"), F.lit("")).cast("binary")) % n


def same(left: DataFrame, right: DataFrame, keys: list[str]) -> Column:
    """Null-safe equality on ``keys``."""
    condition = F.lit(True)
    for key in keys:
        condition &= left[key].eqNullSafe(right[key])
    return condition


def left_join(left: DataFrame, right: DataFrame, keys: list[str], how: str = "left") -> DataFrame:
    """Join on null-safe keys and keep the left copies of them."""
    renamed = right.select(*[F.col(c).alias(f"_r_{c}") if c in keys else F.col(c) for c in right.columns])
    condition = F.lit(True)
    for key in keys:
        condition &= F.col(key).eqNullSafe(F.col(f"_r_{key}"))
    return left.join(renamed, condition, how).drop(*[f"_r_{k}" for k in keys])


def numbered(df: DataFrame, by: list[str], order: str, name: str, per_part: int = 4096) -> DataFrame:
    """Gapless 0-based numbers within ``by`` along the hash column ``order`` (a bigint).

    The hash range is cut into parts of about ``per_part`` rows: rows are ranked inside a part, the parts'
    counts are summed along the parts, so no group meets in one task however large it is. Rows of equal hash
    must be interchangeable; they are numbered in any order.
    """
    df = saved(df, name)
    rows = df.groupBy(*by).agg(F.count(F.lit(1)).alias("_n"))
    total = rows.agg(F.max("_n")).first()[0] or 0
    bits = max(0, int(total // per_part).bit_length())
    part = F.shiftrightunsigned(order, 64 - bits) if bits else F.lit(0).cast("long")
    parts = df.withColumn("_part", part)
    counts = parts.groupBy(*by, "_part").agg(F.count(F.lit(1)).alias("_c"))
    before = F.sum("_c").over(W.partitionBy(*by).orderBy("_part").rowsBetween(W.unboundedPreceding, -1))
    offsets = counts.withColumn("_before", F.coalesce(before, F.lit(0))).drop("_c")
    ranked = parts.withColumn("_in", F.row_number().over(W.partitionBy(*by, "_part").orderBy(order)) - 1)
    out = left_join(ranked, offsets, [*by, "_part"], "inner")
    return out.withColumn(name, F.col("_before") + F.col("_in")).drop("_part", "_in", "_before")


def ranked(df: DataFrame, order: list, name: str, per_part: int = 1 << 18) -> DataFrame:
    """Gapless 1-based numbers along ``order`` over the whole table, in the column ``name``.

    Rows are dealt to sorted ranges; a range's rows are ranked inside it and the counts of the ranges before it are added. Rows that
    are equal in ``order`` are numbered in any order and may lie in several ranges, so no key is too hot.
    """
    part, salt, place, count = free(df.columns, "_part", "_salt", "_in", "_c")
    rows = saved(df.withColumn(salt, F.monotonically_increasing_id()), name)
    ranges = rows.count() // per_part + 1
    placed = saved(rows.repartitionByRange(ranges, *order, salt).withColumn(part, F.spark_partition_id()), name)
    counts = placed.groupBy(part).agg(F.count(F.lit(1)).alias(count))
    before = F.sum(count).over(W.orderBy(part).rowsBetween(W.unboundedPreceding, -1))  # one row per range
    offsets = counts.select(part, F.coalesce(before, F.lit(0)).alias(count))
    inside = placed.withColumn(place, F.row_number().over(W.partitionBy(part).orderBy(*order, salt)))
    return inside.join(offsets, part).withColumn(name, F.col(count) + F.col(place)).drop(part, salt, place, count)
