"""Correlation, ranks, quantiles, outliers and streams that close days, against pandas and plain rules."""

from datetime import datetime, timedelta

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from airgrain.operators import statistics as S
from airgrain.streaming.hourly import daily_means, drop_repeats, rows_behind_watermark, run_closed_days, run_to_parquet

COLUMNS = ["x", "y", "z", "flat"]


@pytest.fixture(scope="module")
def frame():
    rng = np.random.default_rng(3)
    n = 900
    x = rng.normal(1e6, 2, n)
    data = {"series_id": np.where(np.arange(n) % 3 == 0, "hot", "s" + pd.Series(np.arange(n) % 40).astype(str)), "x": x, "y": -x + rng.normal(0, 2, n), "z": rng.integers(0, 5, n).astype(float), "flat": 7.0}
    pdf = pd.DataFrame(data)
    pdf.loc[rng.choice(n, 200, replace=False), "y"] = np.nan
    pdf.loc[rng.choice(n, 50, replace=False), "z"] = np.nan
    pdf["row"] = np.arange(n)
    return pdf


def frame_of(spark, pdf, parts=7):
    schema = "series_id string, x double, y double, z double, flat double, row long"
    rows = [tuple(None if isinstance(v, float) and np.isnan(v) else v for v in r) for r in pdf[["series_id", *COLUMNS, "row"]].itertuples(index=False, name=None)]
    return spark.createDataFrame([(a, b, c, d, e, int(f)) for a, b, c, d, e, f in rows], schema).repartition(parts)


def same(a, b):
    return (a is None and (b is None or np.isnan(b))) or a == pytest.approx(b, abs=1e-8)


def test_correlation_per_series_and_pooled(spark, frame, monkeypatch):
    monkeypatch.setattr(S, "KEPT", 5)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "50")
    got = {(r.series_id, r.a, r.b): r for r in S.correlation(frame_of(spark, frame), COLUMNS).collect()}
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "10000")
    groups = [*frame.groupby("series_id"), (None, frame)]
    for key, some in groups:
        for i, a in enumerate(COLUMNS):
            for b in COLUMNS[i + 1:]:
                both = some[[a, b]].dropna()
                r = got.get((key, a, b))
                if len(both) == 0:
                    assert r is None
                    continue
                assert r.n == len(both)
                want = both.corr().iloc[0, 1] if both[a].nunique() > 1 and both[b].nunique() > 1 else None
                assert same(r.r, np.nan if want is None else want), (key, a, b)
    assert S.correlation(frame_of(spark, frame).where("false"), COLUMNS).count() == 0


def test_correlation_of_null_keys_and_all_null_columns(spark):
    rows = [(None, 1.0, None), (None, 2.0, None), ("s", 1.0, 1.0), ("s", 2.0, 3.0)]
    got = S.correlation(spark.createDataFrame(rows, "series_id string, a double, b double"), ["a", "b"])
    assert {(r.series_id, r.n, round(r.r, 9)) for r in got.collect()} == {("s", 2, 1.0), (None, 2, 1.0)}


def test_rank_correlation_with_ties(spark, frame, monkeypatch):
    monkeypatch.setattr(S, "RANGE_ROWS", 100)
    got = {(r.a, r.b): r.r for r in S.rank_correlation(frame_of(spark, frame), ["x", "y", "z"], ["row"]).collect()}
    complete = frame[["x", "y", "z"]].dropna()
    ranks = complete.rank()
    for (a, b), r in got.items():
        assert r == pytest.approx(ranks[a].corr(ranks[b]), abs=1e-9)
    own = S.tied_ranks(frame_of(spark, frame), ["x", "y", "z"], ["row"]).toPandas().set_index("row").sort_index()
    assert np.allclose(own[["x", "y", "z"]].to_numpy(), ranks.sort_index().to_numpy()) and len(got) == 3


@pytest.mark.parametrize("buckets, small", [(256, 4096), (3, 4), (2, 0)])
def test_exact_quantiles_of_many_groups(spark, monkeypatch, buckets, small):
    """Also where a group holds most rows, one value most of a group, and values lie far apart."""
    monkeypatch.setattr(S, "BUCKETS", buckets)
    monkeypatch.setattr(S, "SMALL", small)
    rng = np.random.default_rng(1)
    values = {"hot": rng.normal(0, 1, 800).round(2), "same": np.full(60, 3.5), "far": np.array([-1.7e308, -1.0, 0.0, 1e-300, 2.0, 1.7e308]), "one": np.array([4.0]), "ties": np.repeat([1.0, 2.0], [200, 3])}
    rows = [(k, float(v)) for k, x in values.items() for v in x] + [("hot", None), ("none", None), (None, 1.0), ("hot", float("nan"))]
    df = spark.createDataFrame(rows, "series_id string, v double").repartition(5)
    asked = (0.0, 0.1, 0.25, 0.5, 0.9, 1.0)
    got = {r.series_id: (r.n, r.q) for r in S.exact_quantiles(df, ["v"], asked).collect()}
    assert set(got) == set(values)
    for k, x in values.items():
        assert got[k][0] == len(x)
        if k != "far":  # the step between two values there is beyond a double
            assert got[k][1] == pytest.approx(np.quantile(x, asked).tolist(), rel=1e-12, abs=1e-12)
    assert got["far"][1][0] == -1.7e308 and got["far"][1][-1] == 1.7e308


def test_outliers_are_clipped_or_nulled(spark):
    rows = [("a", float(i), i) for i in range(11)] + [("a", 1000.0, 11), ("a", None, 12), ("b", 5.0, 13), ("c", None, 14), (None, 3.0, 15)]
    df = spark.createDataFrame(rows, "series_id string, v double, row long")
    bounds = S.outlier_bounds(df, ["v"])
    first = bounds.where("series_id = 'a'").first()
    assert (first.n, first.q1, first.q3, first.low, first.high) == (12, 2.75, 8.25, -5.5, 16.5)
    clipped = {r.row: r.v for r in S.treat_outliers(df, bounds).collect()}
    assert clipped[11] == 16.5 and clipped[12] is None and clipped[13] == 5.0 and clipped[14] is None and clipped[15] == 3.0 and clipped[3] == 3.0
    nulled = S.treat_outliers(df, bounds, "null")
    assert nulled.columns == df.columns and {r.row for r in nulled.where("v is null").collect()} == {11, 12, 14}
    pooled = S.treat_outliers(df, S.outlier_bounds(df, ["v"], keys=()), keys=())
    assert pooled.where("row = 11").first().v < 1000
    with pytest.raises(ValueError):
        S.treat_outliers(df, bounds, "drop")


# --- streams


def observations(spark, folder):
    schema = "series_id string, obs_ts timestamp, value double, seq long"
    return spark.readStream.schema(schema).parquet(folder)


def landed(spark, folder, rows):
    spark.createDataFrame(rows, "series_id string, obs_ts timestamp, value double, seq long").coalesce(1).write.mode("append").parquet(folder)


def test_days_close_and_late_rows_are_left_out(spark, tmp_path):
    """Days appear once the watermark has passed them and never change; a late row counts where its day is still open."""
    at = lambda day, hour: datetime(2025, 1, day, hour)
    land, out, cp = (str(tmp_path / x) for x in ("land", "out", "cp"))
    batches = [
        [("s", at(d, h), float(h), d * 100 + h) for d in (1, 2) for h in range(0, 24, 6)],
        [("s", at(4, 12), 1.0, 412), ("s", at(2, 12), 12.0, 212), ("s", at(2, 13), 50.0, 213)],  # a repeat, and a row in time (mark: 1 Jan 18:00)
        [("s", at(2, 23), 99.0, 223), ("s", at(3, 13), 7.0, 313), ("s", at(8, 0), 1.0, 800)],  # behind (mark: 3 Jan 12:00) and in time
        [("s", at(3, 14), 99.0, 314), ("s", at(4, 13), 99.0, 413)],  # both behind (mark: 7 Jan 0:00)
    ]
    closed, behind = [], 0
    for rows in batches:
        landed(spark, land, rows)
        query = run_closed_days(observations(spark, land), ["value"], out, cp, ident=["seq"], delay="1 day")
        query.awaitTermination()
        behind += rows_behind_watermark(query)
        closed.append(sorted((r.date.day, r.n, r.value) for r in spark.read.parquet(out).collect()))
    first, second = (1, 4, 9.0), (2, 5, (0 + 6 + 12 + 18 + 50) / 5)
    assert closed == [[], [first, second], [first, second, (3, 1, 7.0), (4, 1, 1.0)], [first, second, (3, 1, 7.0), (4, 1, 1.0)]]
    assert behind == 3


def test_state_is_evicted(spark, tmp_path):
    land, out, cp = (str(tmp_path / x) for x in ("land", "out", "cp"))
    start = datetime(2025, 1, 1)
    for day in range(6):
        landed(spark, land, [("s", start + timedelta(days=day, minutes=m), 1.0, day * 100 + m) for m in range(50)])
        means = daily_means(drop_repeats(observations(spark, land), keys=("series_id", "seq"), delay="1 day"), ["value"])
        query = run_to_parquet(means, out, cp)
        query.awaitTermination()
    rows = {s["operatorName"]: s["numRowsTotal"] for s in query.recentProgress[-1]["stateOperators"]}
    assert rows["dedupeWithinWatermark"] <= 150 and rows["stateStoreSave"] <= 3
    assert spark.read.parquet(out).agg(F.sum("n")).first()[0] == 50 * 4
