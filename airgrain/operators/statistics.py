"""Correlation, tied ranks, exact quantiles of many groups and outlier treatment.

All of them combine partial results: a series with most of the rows never meets in one task.
"""

from __future__ import annotations

import sys
from collections.abc import Sequence
from functools import reduce

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import Window as W

from airgrain.functions.text import listed, quoted
from airgrain.schemas import KEYS
from airgrain.session import written

# Task functions travel with the job, so executors need numpy and pandas but not this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# ---- correlation ----------------------------------------------------------------------------

STATE = ("n", "mean_a", "mean_b", "c_aa", "c_bb", "c_ab")
KEPT = 256  # states a task holds before it sends them on


def _moments(x: np.ndarray) -> np.ndarray:
    """For all pairs of columns of ``x`` (rows x columns, NaN where null) over the rows where both are known: count,
    the two means and the three centred sums (6 x columns x columns)."""
    known = ~np.isnan(x)
    shift = np.where(known.any(0), np.nansum(x, 0) / np.maximum(known.sum(0), 1), 0.0)
    # Centred by the column's mean first, so the sums of a pair differ little from centred ones.
    v, m = np.where(known, x - shift, 0.0), known.astype(np.float64)
    n = m.T @ m
    a = v.T @ m  # sum of the first where the second is known too
    safe = np.maximum(n, 1)
    aa, ab = (v * v).T @ m, v.T @ v
    c_aa = np.maximum(aa - a * a / safe, 0.0)
    return np.stack([n, a / safe + shift[:, None], (a / safe).T + shift[None, :], c_aa, c_aa.T, ab - a * a.T / safe])


def _merged(one: np.ndarray, other: np.ndarray) -> np.ndarray:
    """The state of both sets of rows."""
    n = one[0] + other[0]
    safe = np.maximum(n, 1)
    da, db = other[1] - one[1], other[2] - one[2]
    part, weight = other[0] / safe, one[0] * other[0] / safe
    return np.stack([
        n, one[1] + da * part, one[2] + db * part, one[3] + other[3] + da * da * weight,
        one[4] + other[4] + db * db * weight, one[5] + other[5] + da * db * weight])


def comoments(df: DataFrame, columns: Sequence[str], keys: Sequence[str] = KEYS) -> DataFrame:
    """Partial states of every pair of ``columns`` per key, from one pass: keys, ``a``, ``b`` and ``STATE``.

    A task merges the rows it sees; several states of a key are added by ``combined``.
    """
    m = len(columns)
    first, second = np.triu_indices(m, 1)
    fields = [df.schema[k] for k in keys]
    names = list(columns)

    def rows(states: dict) -> pd.DataFrame:
        out = []
        for key, state in states.items():
            pairs = pd.DataFrame({c: state[i][first, second] for i, c in enumerate(STATE)})
            for k, v in zip(reversed(keys), reversed(key), strict=True):
                pairs.insert(0, k, v)
            pairs.insert(len(keys), "a", [names[i] for i in first])
            pairs.insert(len(keys) + 1, "b", [names[i] for i in second])
            out.append(pairs[pairs["n"] > 0])
        return pd.concat(out)

    def run(batches):
        states: dict = {}
        for pdf in batches:
            groups = pdf.groupby(list(keys), dropna=False, sort=False) if keys else [((), pdf)]
            for key, some in groups:
                key = tuple(None if pd.isna(k) else k for k in key)
                state = _moments(some[names].to_numpy(np.float64))
                states[key] = _merged(states[key], state) if key in states else state
            if len(states) > KEPT:
                yield rows(states)
                states = {}
        if states:
            yield rows(states)

    pair = [T.StructField("a", T.StringType()), T.StructField("b", T.StringType())]
    schema = T.StructType([*fields, *pair, *[T.StructField(c, T.DoubleType()) for c in STATE]])
    doubles = [F.col(quoted(c)).cast("double").alias(c) for c in columns]
    return df.select(*keys, *doubles).mapInPandas(run, schema)


def combined(states: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One state per key and pair: the total mean first, then the sums centred on it. Both are sums in the map tasks."""
    group = [*keys, "a", "b"]
    total = states.groupBy(*group).agg(
        F.sum("n").alias("_n"), *[(F.sum(F.col("n") * F.col(f"mean_{x}")) / F.sum("n")).alias(f"_m_{x}") for x in "ab"])
    same = reduce(lambda c, k: c & F.col(k).eqNullSafe(F.col(f"_k_{k}")), group, F.lit(True))
    joined = states.join(total.withColumnsRenamed({k: f"_k_{k}" for k in group}), same)
    da, db = (F.col(f"mean_{x}") - F.col(f"_m_{x}") for x in "ab")
    moved = {"c_aa": da * da, "c_bb": db * db, "c_ab": da * db}
    sums = [F.sum(F.col(c) + F.col("n") * d).alias(c) for c, d in moved.items()]
    return joined.groupBy(*group).agg(
        F.sum("n").cast("long").alias("n"), *[F.sum(F.col("n") * F.col(f"mean_{x}")).alias(f"_s_{x}") for x in "ab"], *sums
    ).select(*group, "n", *[(F.col(f"_s_{x}") / F.col("n")).alias(f"mean_{x}") for x in "ab"], "c_aa", "c_bb", "c_ab")


def correlation(df: DataFrame, columns: Sequence[str], keys: Sequence[str] = KEYS, pooled: bool = True) -> DataFrame:
    """Pearson's r of every pair of columns per key and, with null keys, over all rows: keys, a, b, n, r.

    A pair counts the rows where both are known. ``r`` is null where a column of the pair does not vary.
    """
    states = written(comoments(df, columns, keys), "comoments")
    out = combined(states, keys)
    if pooled and keys:
        whole = combined(states.drop(*keys), [])
        out = out.unionByName(whole.withColumns({k: F.lit(None).cast(df.schema[k].dataType) for k in keys}))
    # What rounding leaves of a constant column is some 1e-32 of its square.
    varies = [F.col(f"c_{x}{x}") > F.col("n") * F.col(f"mean_{x}") * F.col(f"mean_{x}") * 1e-28 for x in "ab"]
    r = F.greatest(F.lit(-1.0), F.least(F.lit(1.0), F.col("c_ab") / F.sqrt("c_aa") / F.sqrt("c_bb")))
    return out.select(*keys, "a", "b", "n", F.when(varies[0] & varies[1], r).alias("r"))


# ---- ranks ----------------------------------------------------------------------------------

RANGE_ROWS = 1 << 18


def running_counts(counts: DataFrame, by: Sequence[str], value: str, n: str, name: str = "_before") -> DataFrame:
    """Add the sum of ``n`` over all smaller values of the same ``by``, without a task per ``by``.

    Values are dealt to sorted ranges; sums inside a range and the totals of the ranges before it are added.
    """
    rows = written(counts, "counts")
    ranges = rows.count() // RANGE_ROWS + 1
    placed = written(rows.repartitionByRange(ranges, *by, value).withColumn("_range", F.spark_partition_id()), "ranges")
    totals = placed.groupBy(*by, "_range").agg(F.sum(n).alias("_total"))  # one row per range and ``by``
    upto = W.partitionBy(*by).orderBy("_range").rowsBetween(W.unboundedPreceding, -1)
    offsets = totals.select(*by, "_range", F.coalesce(F.sum("_total").over(upto), F.lit(0)).alias("_offset"))
    inside = W.partitionBy(*by, "_range").orderBy(value).rowsBetween(W.unboundedPreceding, -1)
    summed = placed.withColumn("_inside", F.coalesce(F.sum(n).over(inside), F.lit(0)))
    joined = summed.join(offsets, [*by, "_range"])
    return joined.withColumn(name, F.col("_offset") + F.col("_inside")).drop("_offset", "_inside", "_range")


def tied_ranks(df: DataFrame, columns: Sequence[str], row_id: Sequence[str]) -> DataFrame:
    """``row_id`` and, for each of ``columns``, the rank of its value among all rows (equal ones share the mean of their
    places). Rows with a null among the columns take no part. ``row_id`` is unique and known."""
    complete = df.select(*row_id, *[F.col(quoted(c)).cast("double").alias(c) for c in columns]).dropna(subset=list(columns))
    long = written(complete.unpivot(list(row_id), list(columns), "_column", "_value"), "long")
    counts = long.groupBy("_column", "_value").agg(F.count(F.lit(1)).alias("_n"))
    ranks = running_counts(counts, ["_column"], "_value", "_n")
    ranks = ranks.select("_column", "_value", (F.col("_before") + (F.col("_n") + 1) / 2).alias("_rank"))
    # A frequent value is a skewed key of the larger side, which Spark splits.
    ranked = long.join(ranks, ["_column", "_value"])
    by_column = [F.max(F.when(F.col("_column") == c, F.col("_rank"))).alias(c) for c in columns]
    return ranked.groupBy(*row_id).agg(*by_column)


def rank_correlation(df: DataFrame, columns: Sequence[str], row_id: Sequence[str]) -> DataFrame:
    """Spearman's rho of every pair over the rows where all columns are known: a, b, n, r."""
    return correlation(tied_ranks(df, columns, row_id), columns, keys=(), pooled=False)


# ---- quantiles and outliers -----------------------------------------------------------------

BUCKETS, SMALL = 256, 4096


def _interval(value: Column, low: Column, high: Column) -> Column:
    """The bucket of a value between its interval's ends; never decreases along the values, and the ends differ."""
    # Halves keep the width of an interval finite.
    share = (value / 2 - low / 2) / (high / 2 - low / 2)
    return F.when(high > low, F.least(F.floor(share * BUCKETS), F.lit(BUCKETS - 1))).otherwise(0).cast("int")


def order_statistics(long: DataFrame, by: Sequence[str], value: str, places: DataFrame) -> DataFrame:
    """The values at given places of many sorted groups at once: ``by``, ``place``, ``value``.

    ``long`` has ``by`` and ``value`` (a known double), ``places`` ``by`` and ``place`` (from 0). No group is sorted:
    each round counts the values of every open interval in ``BUCKETS`` parts and keeps the parts that hold a place, with their
    least and largest value as the new ends. An interval is done when these are equal or few values are left. A round
    at least separates the two ends, and as a rule divides an interval by 256.
    """
    by = list(by)
    ends = long.groupBy(*by).agg(F.min(value).alias("low"), F.max(value).alias("high"), F.count(F.lit(1)).alias("count"))
    opened = places.select(*by, "place").distinct().join(ends, by).withColumn("below", F.lit(0).cast("long"))
    opened = written(opened.where((F.col("place") >= 0) & (F.col("place") < F.col("count"))), "intervals")
    done = None
    while True:
        equal = opened.where("low = high").select(*by, "place", F.col("low").alias("value"))
        done = equal if done is None else done.unionByName(equal)
        few = opened.where(f"low < high and count <= {SMALL}")
        inside = few.select(*by, "low", "high").distinct()
        between = F.col(value).between(F.col("low"), F.col("high"))
        sorted_values = F.sort_array(F.collect_list(value)).alias("values")
        picked = long.join(inside, by).where(between).groupBy(*by, "low", "high").agg(sorted_values)
        at = F.element_at("values", (F.col("place") - F.col("below") + 1).cast("int"))
        done = done.unionByName(few.join(picked, [*by, "low", "high"]).select(*by, "place", at.alias("value")))
        wide = opened.where(f"low < high and count > {SMALL}")
        if wide.isEmpty():
            return done
        intervals = wide.select(*by, "low", "high", "below").distinct()
        bucket = _interval(F.col(value), F.col("low"), F.col("high")).alias("bucket")
        parts = long.join(intervals, by).where(between).groupBy(*by, "low", "high", "below", bucket).agg(
            F.count(F.lit(1)).alias("_n"), F.min(value).alias("_low"), F.max(value).alias("_high"))
        upto = W.partitionBy(*by, "low", "high").orderBy("bucket").rowsBetween(W.unboundedPreceding, -1)
        parts = parts.withColumn("_below", F.col("below") + F.coalesce(F.sum("_n").over(upto), F.lit(0)))
        held = (F.col("place") >= F.col("_below")) & (F.col("place") < F.col("_below") + F.col("_n"))
        found = wide.select(*by, "place", "low", "high").join(parts.drop("below"), [*by, "low", "high"]).where(held)
        opened = written(found.select(*by, "place", F.col("_low").alias("low"), F.col("_high").alias("high"),
                                      F.col("_n").alias("count"), F.col("_below").alias("below")), "intervals")


def exact_quantiles(
    df: DataFrame, columns: Sequence[str], quantiles: Sequence[float] = (0.25, 0.5, 0.75), keys: Sequence[str] = KEYS
) -> DataFrame:
    """keys, ``column``, ``n`` and an array ``q`` of the quantiles, between two values in proportion (place q (n - 1))."""
    doubles = [F.col(quoted(c)).cast("double").alias(c) for c in columns]
    long = df.select(*keys, *doubles).unpivot(list(keys), list(columns), "column", "_value")
    long = written(long.where(F.col("_value").isNotNull() & ~F.isnan("_value")), "values")
    by = [*keys, "column"]
    long = long.dropna(subset=list(keys)) if keys else long
    sizes = written(long.groupBy(*by).agg(F.count(F.lit(1)).alias("n")), "sizes")
    asked = F.array(*[F.struct(F.lit(i).alias("i"), (F.lit(float(q)) * (F.col("n") - 1)).alias("at")) for i, q in enumerate(quantiles)])
    wanted = sizes.select(*by, "n", F.explode(asked).alias("x")).select(*by, "n", "x.*")
    wanted = wanted.withColumns({"_a": F.floor("at"), "_b": F.ceil("at")})
    values = written(order_statistics(long, by, "_value", wanted.select(*by, F.explode(F.array("_a", "_b")).alias("place"))), "order")
    for side in "ab":
        of_side = values.withColumnsRenamed({"place": f"_{side}", "value": f"_v{side}"})
        wanted = wanted.join(of_side, [*by, f"_{side}"])
    between = F.col("_va") + (F.col("_vb") - F.col("_va")) * (F.col("at") - F.col("_a"))
    listing = F.transform(F.array_sort(F.collect_list(F.struct("i", between.alias("v")))), lambda x: x["v"])
    return wanted.groupBy(*by, "n").agg(listing.alias("q"))


def outlier_bounds(df: DataFrame, columns: Sequence[str], keys: Sequence[str] = KEYS, factor: float = 1.5) -> DataFrame:
    """keys, column, n, q1, q3 and the fences ``factor`` quartile distances outside them."""
    found = exact_quantiles(df, columns, (0.25, 0.75), keys)
    q1, q3 = F.col("q")[0], F.col("q")[1]
    away = F.lit(float(factor)) * (q3 - q1)
    return found.select(*keys, "column", "n", q1.alias("q1"), q3.alias("q3"), (q1 - away).alias("low"), (q3 + away).alias("high"))


def treat_outliers(df: DataFrame, bounds: DataFrame, how: str = "clip", keys: Sequence[str] = KEYS) -> DataFrame:
    """``df`` with the values beyond their bounds moved to the bound (``clip``) or set null (``null``).

    Columns and keys without bounds stay as they are, nulls stay null. ``bounds``: keys, column, low, high.
    """
    if how not in ("clip", "null"):
        raise ValueError(f"how: {how}")
    names = [r[0] for r in bounds.select("column").distinct().orderBy("column").collect()]  # a row per column
    wide = bounds.groupBy(*keys).agg(*[
        F.max(F.when(F.col("column") == c, F.struct("low", "high"))).alias(f"_bound_{c}") for c in names])
    if keys:
        joined = df.join(wide, list(keys), "left")
    else:
        fences = {r["column"]: r for r in bounds.collect()}  # a row per column
        end = lambda c, x: F.lit(None if fences[c][x] is None else float(fences[c][x])).cast("double").alias(x)
        joined = df.withColumns({f"_bound_{c}": F.struct(end(c, "low"), end(c, "high")) for c in names})

    def treated(c: str) -> str:
        v, bound = f"CAST({quoted(c)} AS double)", quoted(f"_bound_{c}")
        inside = f"least(greatest({v}, {bound}.low), {bound}.high)" if how == "clip" else f"CASE WHEN {v} BETWEEN {bound}.low AND {bound}.high THEN {v} END"
        return f"CASE WHEN {v} IS NULL OR {bound} IS NULL THEN {v} ELSE {inside} END AS {quoted(c)}"

    return joined.selectExpr(*[treated(c) if c in names else listed([c]) for c in df.columns])
