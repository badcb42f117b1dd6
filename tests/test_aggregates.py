import math
import random
from datetime import date

import pytest
from conftest import column
from pyspark.sql import functions as F

from airgrain.operators.aggregates import daily_aggregate, refresh_average
from airgrain.operators.joins import binned_band_join, build_raw, latest_by
from airgrain.operators.merge import concat, upsert
from airgrain.operators.metrics import regression_metrics
from airgrain.plans.model import to_long

DAY = date(2025, 1, 1)
KEYS = ["series_id", "date"]


def observations(spark, values, kind="double"):
    rows = [("s", DAY, i, v) for i, v in enumerate(values)]
    return spark.createDataFrame(rows, f"series_id string, date date, seq int, v {kind}")


def folded(values):
    """One refresh after the other."""
    value = None
    for x in values:
        if x is not None:
            value = x if value is None else (value + x) / 2
    return value


@pytest.mark.parametrize("values", [[10, 20, 30], [10], [None, 4, None, 8], [None, None], [3, 5, 7, 11, 13, 17, 19]])
@pytest.mark.parametrize("width", [1, 2, 100])
def test_refresh_average_equals_the_fold(spark, values, width):
    values = [None if v is None else float(v) for v in values]
    segment = F.floor(F.col("seq") / width)
    got = refresh_average(observations(spark, values), ["v"], KEYS, "seq", segment=segment).first()["v"]
    assert got == folded(values)


@pytest.mark.parametrize(
    ("stored", "new", "sequential", "together"),
    [(10.0, [None], 10.0, 10.0), (None, [20.0], 20.0, 20.0), (10.0, [20.0, 30.0], 22.5, 20.0), (8.0, [], 8.0, 8.0)],
)
def test_refresh_average_on_a_stored_value(spark, stored, new, sequential, together):
    kept = spark.createDataFrame([("s", DAY, stored)], "series_id string, date date, v double")
    rows = observations(spark, new)
    assert refresh_average(rows, ["v"], KEYS, "seq", kept).first()["v"] == sequential
    assert refresh_average(rows, ["v"], KEYS, "seq", kept, batch="together").first()["v"] == together


def test_refresh_keeps_the_first_known_text(spark):
    df = observations(spark, [1.0, 2.0, 3.0]).withColumn("t", F.when(F.col("seq") > 0, F.col("seq").cast("string")))
    kept = spark.createDataFrame([("s", DAY, 1.0, None)], "series_id string, date date, v double, t string")
    assert refresh_average(df, ["v"], KEYS, "seq", kept, ["t"], segment=F.col("seq")).first()["t"] == "1"
    kept = kept.withColumn("t", F.lit("old"))
    assert refresh_average(df, ["v"], KEYS, "seq", kept, ["t"]).first()["t"] == "old"


def test_daily_aggregate(spark):
    rows = [("s", DAY, 0, None, None), ("s", DAY, 2, 4.0, "y"), ("s", DAY, 1, 2.0, "z"), ("s", None, 3, 9.0, "q")]
    df = spark.createDataFrame(rows, "series_id string, date date, seq int, v double, t string")
    assert [tuple(r) for r in daily_aggregate(df).collect()] == [("s", DAY, 3.0, "z")]


def scores(spark, rows):
    df = spark.createDataFrame(rows, "horizon int, y double, p double")
    return regression_metrics(df, "y", "p").first()


def test_r2_of_a_constant_target(spark):
    assert scores(spark, [(1, 5.0, 5.0), (1, 5.0, 5.0)])["r2"] == 1
    assert scores(spark, [(1, 5.0, 5.0), (1, 5.0, 6.0)])["r2"] == 0


def test_rmse_is_the_root_of_the_mean(spark):
    got = scores(spark, [(1, 1.0, 2.0), (2, 1.0, 4.0)])
    assert math.isclose(got["rmse"], math.sqrt(5))
    assert got["mae"] == 2


def test_mape_of_zero_is_finite(spark):
    assert math.isclose(scores(spark, [(1, 0.0, 1.0)])["mape"], 1 / 2.220446049250313e-16)


def test_to_long(spark):
    df = spark.createDataFrame([("s", 1.0, 2.0, 3.0, 4.0)], "k string, a double, b double, c double, d double")
    got = to_long(df, ["k"], y=["a", "b"], p=["c", "d"]).collect()
    assert [tuple(r) for r in got] == [("s", 1, 1.0, 3.0), ("s", 2, 2.0, 4.0)]


def test_upsert_twice_changes_nothing(spark):
    old = spark.createDataFrame([("s", 1, "a"), ("s", 2, "b")], "k string, n int, v string")
    new = spark.createDataFrame([("s", 2, "c"), ("s", 3, "d")], "k string, n int, v string")
    once = upsert(old, new, ["k", "n"])
    assert column(once, "v", "n") == ["a", "c", "d"]
    assert column(upsert(once, new, ["k", "n"]), "v", "n") == ["a", "c", "d"]


def test_concat_by_name(spark):
    old = spark.createDataFrame([(1, "a")], "n int, v string")
    new = spark.createDataFrame([("b", 2.0)], "v string, w double")
    assert [tuple(r) for r in concat(old, new).orderBy("_order").collect()] == [(1, "a", 0, None), (None, "b", 1, 2.0)]


def test_build_raw(spark):
    weather = spark.createDataFrame([("s", DAY, 1), ("s", DAY, 2), ("s", None, 3)], "series_id string, date date, t int")
    air = spark.createDataFrame([("s", DAY, 5), ("s", None, 6)], "series_id string, date date, p int")
    assert column(build_raw(weather, air, dedup=False), "t", "t") == [1, 2]
    assert column(build_raw(weather, air, order=["t"]), "t") == [1]


BANDS = "pollutant string, band_no long, lo double, hi double, index_lo double, index_hi double"
INF = float("inf")


def test_binned_bands_equal_all_pairs(spark):
    """Bands of all widths, from a point to no end, overlapping, of negative and of huge values."""
    rng = random.Random(5)
    bands = [("p", i, lo, lo + rng.choice([0.0, 1e-9, 0.5, 1.0, 3.0, 64.0, 1e6]), 0.0, 1.0) for i, lo in enumerate(rng.choice([-40.5, -1.0, 0.0, 0.25, 2.0, 7.0, 63.0, 64.0, 1e9, 1e300]) for _ in range(60))]
    bands += [("q", 100, -INF, -5.0, 0.0, 1.0), ("q", 101, 5.0, INF, 0.0, 1.0), ("q", 102, 4.0, 3.0, 0.0, 1.0), ("q", 103, -1e300, 1e300, 0.0, 1.0), (None, 104, 0.0, 9.0, 0.0, 1.0)]
    bands += [("r", 105, float("nan"), 9.0, 0.0, 1.0), ("r", 106, 0.0, float("nan"), 0.0, 1.0), ("r", 107, None, 9.0, 0.0, 1.0), ("r", 108, 0.0, 0.0, 0.0, 1.0), ("p", 109, 2.0, 2.0 + 2**-50, 0.0, 1.0)]
    edges = {x for b in bands for x in b[2:4] if x is not None and x == x and abs(x) != INF}
    values = [*edges, *(math.nextafter(x, side) for x in edges for side in (-INF, INF)), -0.0, INF, -INF, float("nan"), None]
    rows = [(n, v, i) for n in ("p", "q", "r", "none", None) for i, v in enumerate([*values, 2.0, 2.0])]
    df = spark.createDataFrame(rows, "pollutant string, value double, i long").repartition(3)

    def wanted(name, v):
        fits = [b[1] for b in bands if name is not None and b[0] == name and v is not None and b[2] is not None and b[2] <= v <= b[3]]
        return min(fits, default=None)

    got = binned_band_join(df, spark.createDataFrame(bands, BANDS), "value")
    assert got.columns == ["pollutant", "value", "i", "band_no", "lo", "hi", "index_lo", "index_hi"]
    shown = sorted(((r.pollutant or "", r.i, r.band_no) for r in got.collect()), key=str)
    assert shown == sorted(((n or "", i, wanted(n, v)) for n, v, i in rows), key=str)
    assert binned_band_join(df, spark.createDataFrame([], BANDS), "value").where("band_no IS NULL").count() == len(rows)
    assert binned_band_join(df.where("false"), spark.createDataFrame(bands, BANDS), "value").count() == 0


def test_binned_bands_meet_by_an_equi_join(spark):
    """Neighbouring bands: no nested loop, and few candidates for a value however many bands there are."""
    bands = spark.range(20_000).selectExpr(
        "concat('p', id % 2) AS pollutant", "id AS band_no", "CAST(id AS double) AS lo", "id + 0.5D AS hi", "0D AS index_lo", "1D AS index_hi")
    df = spark.range(4_000).selectExpr("concat('p', id % 2) AS pollutant", "id * 5 + 0.25D AS value")
    got = binned_band_join(df, bands, "value")
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "CartesianProduct" not in plan
    assert got.where("band_no = floor(value)").count() == 4_000


def test_latest_by(spark):
    df = spark.createDataFrame([("a", 1), ("a", 2), ("b", 1)], "series_id string, d int")
    assert sorted(map(tuple, latest_by(df, "d").collect())) == [("a", 2), ("b", 1)]
    assert sorted(map(tuple, latest_by(df, "d", ()).collect())) == [("a", 2)]
