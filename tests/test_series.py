from datetime import date, datetime, timedelta

import pandas as pd
import pytest
from conftest import column
from pyspark.sql import functions as F

from airgrain.operators import series as S



@pytest.fixture(params=["plain", "segmented"])
def segment(request, spark):
    return None if request.param == "plain" else S.time_segment("date", 3 * 86_400)


GAPS = [None, 1.0, None, None, 4.0, None, None, None, None, None, 7.0, 2.0, None]


def test_interpolation(series, segment):
    got = column(S.interpolate_linear(series([None, 1.0, None, None, 4.0, None]), ["v"], segment=segment), "v")
    assert got == [None, 1, 2, 3, 4, 4]
    both = S.interpolate_linear(series([None, 1.0, None, 3.0]), ["v"], segment=segment, backward=True)
    assert column(both, "v") == [1, 1, 2, 3]


def test_interpolation_goes_by_position_not_by_time(series, segment):
    got = S.interpolate_linear(series([0.0, None, 10.0], days=[1, 2, 100]), ["v"], segment=segment)
    assert column(got, "v") == [0, 5, 10]


def test_interpolation_and_backfill_agree_with_pandas(series, segment):
    frame = pd.Series(GAPS, dtype="float64")
    got = column(S.interpolate_linear(series(GAPS), ["v"], segment=segment), "v")
    assert pd.Series(got, dtype="float64").equals(frame.interpolate(method="linear"))
    got = column(S.backfill(series(GAPS), ["v"], segment=segment), "v")
    assert pd.Series(got, dtype="float64").equals(frame.bfill())


def test_backfill_of_text(series, segment):
    got = S.backfill(series([None, "a", None, None, None, "b", None], kind="string"), ["v"], segment=segment)
    assert column(got, "v") == ["a", "a", "b", "b", "b", "b", None]


def test_rolling_sum(series, segment):
    df = S.rolling_sum(series([1.0, 2.0, None, 4.0, 5.0, 6.0, 7.0]), "v", 3, segment=segment)
    assert column(df, "v_sum_3") == [None, None, None, None, None, 15, 18]
    frame = pd.Series(GAPS, dtype="float64").fillna(3.0)
    got = column(S.rolling_sum(series(frame.tolist()), "v", 7, segment=segment), "v_sum_7")
    assert pd.Series(got, dtype="float64").equals(frame.rolling(7).sum())


def test_lags_and_targets(series, segment):
    values = [float(i) for i in range(20)]
    days = [1, 2, 3, 10, 11, 30, 31, 60, 61, 62, 63, 64, 65, 66, 90, 120, 121, 150, 151, 152]
    lagged = S.add_lags(series(values, days), "v", 7, segment=segment)
    ahead = S.add_targets(series(values, days), "v", 7, segment=segment)
    frame = pd.Series(values)
    for i in range(1, 8):
        assert pd.Series(column(lagged, f"lag_{i}_v"), dtype="float64").equals(frame.shift(i))
        assert pd.Series(column(ahead, f"v_day_{i}"), dtype="float64").equals(frame.shift(-i))


@pytest.mark.parametrize(("n", "tests"), [(1, 1), (5, 1), (6, 2), (10, 2), (11, 3)])
def test_chronological_split(series, segment, n, tests):
    got = column(S.chronological_split(series([1.0] * n), segment=segment), "split")
    assert got == ["train"] * (n - tests) + ["test"] * tests


@pytest.mark.parametrize("n", [3, 7, 8, 12])
def test_drop_tail(series, segment, n):
    assert len(column(S.drop_tail(series([1.0] * n), 7, segment=segment), "v")) == max(0, n - 7)


def test_series_do_not_mix(series):
    df = series([1.0, None, 3.0], name="a").union(series([None, 8.0, None], name="b"))
    got = S.interpolate_linear(df, ["v"], segment=S.time_segment("date", 3 * 86_400))
    assert column(got, "v", "series_id", "date") == [1, 2, 3, None, 8, 8]


def test_hot_series_cut_by_day_and_id(spark):
    """Many rows on few days: runs of ids inside a day give the same as one window."""
    rows = [
        (name, date(2025, 1, 1) + timedelta(days=i // 400), i, None if i % 7 in (2, 3) else float(i * i % 101))
        for name, count in (("hot", 1500), ("cold", 40))
        for i in range(count)
    ]
    df = spark.createDataFrame(rows, "series_id string, date date, seq long, v double")
    order = ["date", "seq"]
    cut = S.id_segment("date", "seq", 16)
    for operator, args in (
        (S.interpolate_linear, (["v"],)), (S.backfill, (["v"],)), (S.add_lags, ("v", 7)),
        (S.add_targets, ("v", 7)), (S.chronological_split, (0.2,)), (S.add_position, ()),
    ):
        plain = operator(df, *args, ts=order).collect()
        runs = operator(df, *args, ts=order, segment=cut).collect()
        assert sorted(map(tuple, plain), key=repr) == sorted(map(tuple, runs), key=repr)


def test_even_runs_spread_a_series_of_one_hour(spark):
    """No run is larger than asked for, runs follow the order, and operators on them agree with one window."""
    hour = datetime(2025, 1, 1, 5)
    rows = [("hot", hour, i, float(i) if i % 3 else None) for i in range(700)]
    rows += [("s%d" % (i % 9), hour + timedelta(days=i), i, float(i)) for i in range(60)]
    rows += [("same", hour, 1, 1.0)] * 120
    df = spark.createDataFrame(rows, "series_id string, at timestamp, seq long, v double").repartition(6)
    order = ["at", "seq"]
    runs = S.even_runs(df, order=order, rows=50)
    sizes = [(r["count"], r.series_id) for r in runs.groupBy("series_id", S.RUN).count().collect()]
    assert max(n for n, _ in sizes) <= 50 and sum(n for n, _ in sizes) == len(rows)
    assert sum(k == "hot" for _, k in sizes) >= 14 and sum(k == "same" for _, k in sizes) >= 3
    steps = runs.selectExpr(f"{S.RUN} < lag({S.RUN}) OVER (PARTITION BY series_id ORDER BY at, seq, {S.RUN}) AS back")
    assert steps.where("back").count() == 0
    unique = df.where("series_id <> 'same'")
    runs = S.even_runs(unique, order=order, rows=50)
    by_run = S.add_lags(S.interpolate_linear(runs, ["v"], ts=order, segment=F.col(S.RUN)), "v", 60, ts=order, segment=F.col(S.RUN))
    plain = S.add_lags(S.interpolate_linear(unique, ["v"], ts=order), "v", 60, ts=order)
    assert sorted(by_run.drop(S.RUN).collect(), key=str) == sorted(plain.collect(), key=str)
    assert S.even_runs(df.where("false"), order=order).count() == 0
    with pytest.raises(ValueError):
        S.even_runs(runs, order=order)


def test_first_and_last(spark):
    rows = [("s", date(2025, 1, 1), 2, "b"), ("s", date(2025, 1, 1), 1, "a"), ("s", date(2025, 1, 3), 3, "c")]
    df = spark.createDataFrame(rows, "series_id string, date date, seq int, v string")
    assert column(S.first_per_key(df, ["series_id", "date"], "seq"), "v") == ["a", "c"]
    assert column(S.last_row(df), "v") == ["c"]


def test_time_segment_of_timestamps(spark):
    times = [datetime(2025, 1, 1, h, m) for h in (0, 1) for m in (0, 59)]
    df = spark.createDataFrame([(t,) for t in times], "t timestamp").withColumn("s", S.time_segment("t", 3600))
    first, *rest = column(df, "s", "t")
    assert [x - first for x in rest] == [0, 1, 1]


def test_rows_and_summaries_of_runs_share_one_shuffle(spark):
    rows = [(str(i % 3), i, float(i) if i % 4 == 0 else None) for i in range(90)]
    df = spark.createDataFrame(rows, "series_id string, day long, v double")
    adaptive = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        cut = S.interpolate_linear(df, ["v"], ["series_id"], "day", segment=F.expr("floor(day / 20)"))
        plan = cut._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", adaptive)
    assert "ReusedExchange" in plan
    whole = S.interpolate_linear(df, ["v"], ["series_id"], "day")
    assert whole._jdf.queryExecution().optimizedPlan().toString().count("Window [") == 3
    assert sorted(cut.collect(), key=str) == sorted(whole.collect(), key=str)
