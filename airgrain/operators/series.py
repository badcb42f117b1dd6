"""Row-position operators on ordered series: lags, leads, rolling sums, fills, splits.

Two exact forms of each:

* Without ``segment`` a series is one window partition. That is right for daily tables, which hold
  at most one row per series and calendar day (366 a year), so a partition is bounded by the
  calendar however many observations were averaged into it.
* With ``segment`` a series of any length is cut into runs of consecutive rows, and one task sees
  one run. ``segment`` is a column that never decreases along the order (see ``even_runs``, which
  cuts by the data, ``time_segment`` and ``id_segment``). Each run is summarised in a few values, the summaries are combined along the
  series, and the result is joined back to the run's rows. Only summaries meet in one task.
  Keys and segment must not be null.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

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
from airgrain.schemas import DAY, KEYS
from airgrain.session import compiled_apart, written

SEG = "_segment"
Order = str | Sequence[str]


def time_segment(col: str, seconds: int) -> Column:
    """Runs of a fixed time span; for dates and for timestamps without time zone too."""
    return F.expr(f"floor(unix_micros(CAST({quoted(col)} AS timestamp)) / {seconds * 1_000_000})")


def id_segment(day: str, ident: str, width: int) -> Column:
    """Runs inside one day by ranges of an increasing id, for days too large for one task."""
    return F.expr(f"struct({quoted(day)} AS day, floor({quoted(ident)} / {width}) AS part)")


RUN = "_run"
RUN_ROWS = 500_000


def even_runs(df: DataFrame, keys=KEYS, order: Order = DAY, rows: int = RUN_ROWS) -> DataFrame:
    """The rows with a column ``_run``, to be given as ``segment=F.col(RUN)``: runs of at most ``rows``
    consecutive rows, whatever their rate in time.

    Spark sorts the rows into ranges of (keys, order), which it takes from a sample of them, and each
    range is cut after every ``rows`` rows. Rows equal in all order columns may fall into two runs, in
    any order. The result is written once, so that all readers see the same cuts, also after an
    executor was lost. Raises if the rows have a column ``_run``.
    """
    if RUN in df.columns:
        raise ValueError(f"the rows have a column {RUN!r} already")
    sorted_by = [F.col(quoted(c)) for c in (*keys, *_names(order))]
    ranges = -(-max(df.count(), 1) // rows)
    ranged = df.repartitionByRange(ranges, *sorted_by).sortWithinPartitions(*sorted_by)
    # The id counts rows in its lower 33 bits and ranges above them.
    placed = ranged.withColumn(RUN, F.monotonically_increasing_id())
    low = (1 << 33) - 1
    return written(placed.withColumn(RUN, F.expr(f"({RUN} - ({RUN} & {low})) + ({RUN} & {low}) div {rows}")), "runs")


def _names(order: Order) -> list[str]:
    return [order] if isinstance(order, str) else list(order)


def _join_summary(rows: DataFrame, summary: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Plain equi-join: the rows already lie partitioned and sorted by (keys, segment)."""
    return rows.join(summary, [*keys, SEG], "left")


def shift(
    df: DataFrame,
    shifts: Mapping[str, tuple[str, int]],
    keys: Sequence[str] = KEYS,
    order: Order = DAY,
    forward: bool = False,
    segment: Column | None = None,
) -> DataFrame:
    """Add ``{new: (column, k)}``: the value k rows earlier, or k rows later if ``forward``."""
    order = _names(order)
    if segment is None:
        step, window = "lead" if forward else "lag", over(keys, order)
        return with_expressions(
            df, {n: f"{step}({quoted(c)}, {k}) {window}" for n, (c, k) in shifts.items()}
        )

    depth = max(k for _, k in shifts.values())
    columns = sorted({c for c, _ in shifts.values()})
    cut = df.withColumn(SEG, segment)
    run = [*keys, SEG]

    # the ``depth`` rows of each run nearest to the next one, farthest first
    edge = (
        cut.select(*dict.fromkeys([*run, *order, *columns]))
        .selectExpr("*", f"row_number() {over(run, order, not forward)} AS _rn")
        .where(f"_rn <= {depth}")
        .groupBy(*run)
        .agg(F.expr(f"sort_array(collect_list(struct(-_rn AS _o, {listed(columns)}))) AS _edge"))
    )
    along = over(keys, [SEG], forward, f"{depth} PRECEDING AND 1 PRECEDING")
    carry = edge.selectExpr(*map(quoted, run), f"flatten(collect_list(_edge) {along}) AS _carry")

    local = over(run, order, forward)
    inside = {n: f"lag({quoted(c)}, {k}) {local}" for n, (c, k) in shifts.items()}
    numbered = with_expressions(cut, {"_rn": f"row_number() {local}"} | inside)
    joined = _join_summary(numbered, carry, keys)
    carried = {
        n: f"CASE WHEN _rn > {k} THEN {quoted(n)}"
        f" ELSE get(_carry, size(_carry) + _rn - {k + 1}).{quoted(c)} END"
        for n, (c, k) in shifts.items()
    }
    return with_expressions(joined, carried).select(*dict.fromkeys([*df.columns, *shifts]))


def add_lags(df, col, n, keys=KEYS, ts: Order = DAY, segment=None) -> DataFrame:
    """``lag_1_<col>`` .. ``lag_n_<col>`` by row position."""
    return shift(df, {f"lag_{i}_{col}": (col, i) for i in range(1, n + 1)}, keys, ts, False, segment)


def add_targets(df, col, horizon, keys=KEYS, ts: Order = DAY, segment=None) -> DataFrame:
    """``<col>_day_1`` .. ``<col>_day_horizon``: the next rows' values."""
    leads = {f"{col}_day_{i}": (col, i) for i in range(1, horizon + 1)}
    return shift(df, leads, keys, ts, True, segment)


def rolling_sum(
    df: DataFrame, col: str, n: int, keys=KEYS, ts: Order = DAY, name=None, segment=None
) -> DataFrame:
    """Sum over n rows ending at the current one; null unless all n values are there."""
    name = name or f"{col}_sum_{n}"
    v = quoted(col)
    if segment is None:
        last_n = over(keys, _names(ts), frame=f"{n - 1} PRECEDING AND CURRENT ROW")
        return with_expressions(
            df, {name: f"CASE WHEN count({v}) {last_n} = {n} THEN sum({v}) {last_n} END"}
        )
    earlier = {f"_l{i}": (col, i) for i in range(1, n)}
    shifted = shift(df, earlier, keys, ts, False, segment)
    total = " + ".join([f"_l{i}" for i in range(n - 1, 0, -1)] + [v])
    return with_expressions(shifted, {name: total}).drop(*earlier)


def add_position(
    df: DataFrame, keys=KEYS, ts: Order = DAY, segment=None, pos="_pos", size="_size"
) -> DataFrame:
    """Row number in the series (from 1) and the number of its rows."""
    order = _names(ts)
    if segment is None:
        return with_expressions(
            df, {pos: f"row_number() {over(keys, order)}", size: f"count(1) {over(keys)}"}
        )
    cut = df.withColumn(SEG, segment)
    run = [*keys, SEG]
    offset = f"coalesce(sum(_n) {over(keys, [SEG], frame=BEFORE)}, 0)"
    runs = with_expressions(
        cut.groupBy(*run).agg(F.expr("count(1) AS _n")),
        {"_offset": offset, size: f"sum(_n) {over(keys)}"},
    )
    numbered = with_expressions(cut, {"_rn": f"row_number() {over(run, order)}"})
    joined = with_expressions(_join_summary(numbered, runs, keys), {pos: "_offset + _rn"})
    return joined.select(*df.columns, pos, size)


def _near(side: str, c: str) -> tuple[str, str]:
    return f"_{side}_value_{c}", f"_{side}_at_{c}"


def _neighbours(df, cols, keys, ts, segment, sides) -> DataFrame:
    """Add ``_pos`` and per column and side the nearest known value and its position.

    Side 'next' looks from the row itself on, 'prev' up to the row itself. Plain columns instead
    of structs keep the window buffers flat.
    """

    order = _names(ts)

    def at(c: str) -> str:
        return f"CASE WHEN {quoted(c)} IS NOT NULL THEN _pos END"

    def found(rows: DataFrame, group) -> DataFrame:
        # 'prev' has the order that gave ``_pos``, so it comes first and needs no sort of its own
        for side in sorted(sides, reverse=True):
            window = over(group, order, side == "next", UP_TO)
            result = {}
            for c in cols:
                value, position = _near(side, c)
                result[value] = f"last({quoted(c)}, true) {window}"
                result[position] = f"last({at(c)}, true) {window}"
            rows = with_expressions(rows, result)
        return rows

    if segment is None:
        return found(with_expressions(df, {"_pos": f"row_number() {over(keys, order)}"}), keys)

    cut = df.withColumn(SEG, segment)
    run = [*keys, SEG]
    local = with_expressions(cut, {"_pos": f"row_number() {over(run, order)}"})

    # per run: its length, its first known value (for earlier runs), its last (for later ones)
    pick = {"next": ("min_by", "min"), "prev": ("max_by", "max")}
    summary = {"_n": "count(1)"}
    for side in sides:
        by, extreme = pick[side]
        for c in cols:
            value, position = _near(side, c)
            summary |= {value: f"{by}({quoted(c)}, {at(c)})", position: f"{extreme}({at(c)})"}
    runs = local.groupBy(*run).agg(*aggregates(summary))
    offset = f"coalesce(sum(_n) {over(keys, [SEG], frame=BEFORE)}, 0)"
    runs = with_expressions(runs, {"_offset": offset})
    carry = {}
    for side in sides:
        window = over(keys, [SEG], side == "next", BEFORE)
        for c in cols:
            value, position = map(quoted, _near(side, c))
            carry["_run" + value.strip("`")] = f"last({value}, true) {window}"
            carry["_run" + position.strip("`")] = f"last({position} + _offset, true) {window}"
    # The join needs keys that are not null. As results of a window they are not filtered before the
    # shuffle, so that rows and runs share one.
    same = {k: f"first({quoted(k)}) {over(keys, [SEG], frame=UP_TO)}" for k in keys}
    carried = with_expressions(runs, carry | same).select(*map(quoted, run), "_offset", *map(quoted, carry))

    joined = compiled_apart(_join_summary(found(local, run), carried, keys))
    result = {"_pos": "_pos + _offset"}
    for side in sides:
        for c in cols:
            value, position = _near(side, c)
            result[value] = f"coalesce({quoted(value)}, {quoted('_run' + value)})"
            moved = f"{quoted(position)} + _offset"
            result[position] = f"coalesce({moved}, {quoted('_run' + position)})"
    return with_expressions(joined, result).drop(SEG, "_offset", *carry)


def _drop_neighbours(df: DataFrame, cols: Sequence[str], sides: Sequence[str]) -> DataFrame:
    return df.drop("_pos", *[name for side in sides for c in cols for name in _near(side, c)])


def interpolate_linear(
    df: DataFrame, cols: Sequence[str], keys=KEYS, ts: Order = DAY, segment=None, backward=False
) -> DataFrame:
    """Fill nulls on the straight line between neighbours, by row position.

    Trailing nulls take the last value; leading nulls stay, or take the first value if
    ``backward``.
    """
    if not cols:
        return df
    sides = ("next", "prev")

    def line(c: str) -> str:
        later, later_at = map(quoted, _near("next", c))
        earlier, earlier_at = map(quoted, _near("prev", c))
        between = f"{earlier} + ({later} - {earlier}) * (_pos - {earlier_at}) / ({later_at} - {earlier_at})"
        rest = f"{earlier}, {later}" if backward else earlier
        return f"CASE WHEN {quoted(c)} IS NOT NULL THEN {quoted(c)} ELSE coalesce({between}, {rest}) END"

    near = _neighbours(df, cols, keys, ts, segment, sides)
    return _drop_neighbours(with_expressions(near, {c: line(c) for c in cols}), cols, sides)


def backfill(
    df: DataFrame, cols: Sequence[str], keys=KEYS, ts: Order = DAY, segment=None
) -> DataFrame:
    """Nulls take the next non-null value, in columns of any type."""
    if not cols:
        return df
    near = _neighbours(df, cols, keys, ts, segment, ("next",))
    filled = with_expressions(near, {c: quoted(_near("next", c)[0]) for c in cols})
    return _drop_neighbours(filled, cols, ("next",))


def drop_incomplete(df: DataFrame) -> DataFrame:
    """Drop rows with a null in any column."""
    return df.dropna("any")


def drop_tail(df: DataFrame, n: int, keys=KEYS, ts: Order = DAY, segment=None) -> DataFrame:
    """Drop the last n rows of each series."""
    placed = add_position(df, keys, ts, segment)
    return placed.where(f"_pos <= _size - {n}").drop("_pos", "_size")


def chronological_split(
    df: DataFrame, test_fraction: float = 0.2, keys=KEYS, ts: Order = DAY, segment=None
) -> DataFrame:
    """Add ``split``: the last ``ceil(test_fraction * n)`` rows of a series are 'test'."""
    placed = add_position(df, keys, ts, segment)
    is_test = f"_pos > _size - ceil({float(test_fraction)!r}D * _size)"
    split = f"CASE WHEN {is_test} THEN 'test' ELSE 'train' END"
    return with_expressions(placed, {"split": split}).drop("_pos", "_size")


def first_per_key(df: DataFrame, keys: Sequence[str], order: Order) -> DataFrame:
    """One row per key, the first in ``order``. Map tasks already keep one row per key."""
    return _ranked_first(df, over(keys, _names(order)))


def last_row(df: DataFrame, keys=KEYS, ts: Order = DAY) -> DataFrame:
    """The last row of each series."""
    return _ranked_first(df, over(keys, _names(ts), reverse=True))


def _ranked_first(df: DataFrame, window: str) -> DataFrame:
    return with_expressions(df, {"_rn": f"row_number() {window}"}).where("_rn = 1").drop("_rn")
