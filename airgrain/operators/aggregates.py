"""Daily aggregation and the refresh average."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from airgrain.functions.text import (
    BEFORE,
    UP_TO,
    aggregates,
    listed,
    over,
    quoted,
    with_expressions,
)
from airgrain.operators.columns import split_columns
from airgrain.operators.series import SEG, Order
from airgrain.schemas import DAY, KEYS


def first_known(col: str, order: Sequence[str]) -> str:
    """First non-null value in order; an aggregate that combines before the shuffle."""
    rank = f"struct({listed(order)})" if len(order) > 1 else quoted(order[0])
    return f"min_by({quoted(col)}, CASE WHEN {quoted(col)} IS NOT NULL THEN {rank} END)"


def daily_aggregate(
    df: DataFrame, keys: Sequence[str] = KEYS, ts: str = DAY, order: Order = "seq"
) -> DataFrame:
    """One row per key and day: mean of numeric columns, first known value of the others.

    One aggregation for both kinds of columns, with partial sums in the map tasks, so a day that
    holds most of the observations is reduced before the shuffle. Rows without a date form no group.
    """
    order = [order] if isinstance(order, str) else list(order)
    group = [*keys, ts]
    numeric, other = split_columns(df)
    skip = {*group, *order}
    values = {c: f"avg({quoted(c)})" for c in numeric if c not in skip}
    values |= {c: first_known(c, order) for c in other if c not in skip}
    return (
        df.where(F.col(ts).isNotNull())
        .groupBy(*group)
        .agg(*aggregates({c: values[c] for c in df.columns if c in values}))
    )


def latest_date(df: DataFrame, ts: str = DAY) -> DataFrame:
    return df.agg(F.max(ts).alias(ts))


def refresh_average(
    new: DataFrame,
    values: Sequence[str],
    keys: Sequence[str] = (*KEYS, DAY),
    order: Order = "seq",
    stored: DataFrame | None = None,
    text: Sequence[str] = (),
    mode: str = "recency",
    batch: str = "sequential",
    segment: Column | None = None,
) -> DataFrame:
    """The value of a day after it was refreshed with one observation after the other.

    Each refresh averages the stored value with the new one, so after x1..xn the value is
    ``x1/2^(n-1) + x2/2^(n-1) + x3/2^(n-2) + .. + xn/2``. This weighted sum needs no loop.
    Nulls do not count as observations; ``stored`` (one row per key) comes before all of ``new``.

    ``batch='together'``: all new rows of a key weigh the same, ``(s + sum(x)) / (1 + k)``.
    ``mode='true_mean'``: plain mean of the new rows. Both are sums and combine before the shuffle.
    ``segment``: a column that never decreases along ``order``; runs of rows with the same segment
    are summed apart, then their few sums are weighted and added, so a hot day uses many tasks.
    ``text`` columns keep their first known value.
    """
    if mode == "true_mean":
        order = [order] if isinstance(order, str) else list(order)
        means = {c: f"avg({quoted(c)})" for c in values}
        return new.withColumn("_origin", F.lit(1)).groupBy(*keys).agg(*aggregates(means | _firsts(text, order)))
    summary = refresh_summary(new, values, keys, order, text, batch, segment)
    return refreshed(summary, values, keys, stored, text, batch)


def _firsts(text: Sequence[str], order: Sequence[str] = ()) -> dict[str, str]:
    return {c: first_known(c, ["_origin", *order]) for c in text}


def refresh_summary(
    new: DataFrame,
    values: Sequence[str],
    keys: Sequence[str] = (*KEYS, DAY),
    order: Order = "seq",
    text: Sequence[str] = (),
    batch: str = "sequential",
    segment: Column | None = None,
) -> DataFrame:
    """What ``refreshed`` needs of new observations, one row per key: of each value the number of known ones, their
    (weighted) sum and, unless all weigh the same, the first one; of ``text`` the first known."""
    order = [order] if isinstance(order, str) else list(order)
    rows = new.select(*keys, *order, *values, *text, (F.lit(0) if segment is None else segment).alias(SEG))
    if batch == "together":
        sums = {f"_n_{c}": f"count({quoted(c)})" for c in values} | {f"_s_{c}": f"sum({quoted(c)})" for c in values}
        return rows.withColumn("_origin", F.lit(1)).groupBy(*keys).agg(*aggregates(sums | _firsts(text, order)))

    run = [*keys, SEG]
    backwards = over(run, order, reverse=True)
    to_end = over(run, order, reverse=True, frame=UP_TO)
    # per run: known values, their sum weighted from the run's end, and the run's first value,
    # which is the one with the most known values from it to the end
    counts = {f"_k_{c}": f"count({quoted(c)}) {to_end}" for c in values}
    if text:
        counts["_rn"] = f"row_number() {backwards}"
    per_run = {f"_n_{c}": f"count({quoted(c)})" for c in values}
    per_run |= {f"_s_{c}": f"sum({quoted(c)} * pow(0.5D, {quoted('_k_' + c)}))" for c in values}
    per_run |= {f"_f_{c}": _at_largest(c, f"_k_{c}") for c in values}
    per_run |= {c: _at_largest(c, "_rn") for c in text}
    runs = with_expressions(rows, counts).groupBy(*run).agg(*aggregates(per_run))
    return _in_a_row(runs, values, keys, SEG, text)


def _in_a_row(
    parts: DataFrame, values: Sequence[str], keys: Sequence[str], place: str, text: Sequence[str]
) -> DataFrame:
    """Summaries that follow each other along ``place``, as one summary per key."""
    later = over(keys, [place], reverse=True, frame=BEFORE)
    after = {f"_a_{c}": f"coalesce(sum({quoted('_n_' + c)}) {later}, 0)" for c in values}
    placed = with_expressions(parts, {"_run": f"row_number() {over(keys, [place], reverse=True)}"} | after)
    total = {f"_n_{c}": f"sum({quoted('_n_' + c)})" for c in values}
    total |= {f"_s_{c}": f"sum({quoted('_s_' + c)} * pow(0.5D, {quoted('_a_' + c)}))" for c in values}
    total |= {f"_f_{c}": _at_largest("_f_" + c, "_run") for c in values}
    total |= {c: _at_largest(c, "_run") for c in text}
    return placed.groupBy(*keys).agg(*aggregates(total))


def refreshed(
    summary: DataFrame,
    values: Sequence[str],
    keys: Sequence[str] = (*KEYS, DAY),
    stored: DataFrame | None = None,
    text: Sequence[str] = (),
    batch: str = "sequential",
) -> DataFrame:
    """The refresh average of stored values with the new ones of a ``refresh_summary``."""
    together = batch == "together"
    if stored is not None:
        known = {f"_n_{c}": f"CAST({quoted(c)} IS NOT NULL AS bigint)" for c in values}
        known |= {f"_s_{c}": quoted(c) if together else f"{quoted(c)} * 0.5D" for c in values}
        known |= {} if together else {f"_f_{c}": quoted(c) for c in values}
        kept = stored.selectExpr(*map(quoted, keys), *[f"{e} AS {quoted(c)}" for c, e in known.items()],
                                 *map(quoted, text), "0 AS _origin")
        parts = summary.withColumn("_origin", F.lit(1)).unionByName(kept)
        if together:
            sums = {c: f"sum({quoted(c)})" for c in known}
            summary = parts.groupBy(*keys).agg(*aggregates(sums | _firsts(text)))
        else:
            summary = _in_a_row(parts, values, keys, "_origin", text)

    def value(c: str) -> str:
        n, total, first = (quoted(f"_{x}_{c}") for x in "nsf")
        # x1 weighs as much as x2, so it is added once more with the weight it already has
        return f"{total} / nullif({n}, 0)" if together else f"{total} + {first} * pow(0.5D, {n})"

    return summary.selectExpr(*map(quoted, keys), *[f"{value(c)} AS {quoted(c)}" for c in values], *map(quoted, text))


def _at_largest(col: str, rank: str) -> str:
    """The known value with the largest rank."""
    return f"max_by({quoted(col)}, CASE WHEN {quoted(col)} IS NOT NULL THEN {quoted(rank)} END)"
