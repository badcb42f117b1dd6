"""Folds against plain positions; halving runs what it should, once."""

from datetime import date, timedelta

import pytest
from pyspark.ml.feature import VectorAssembler

from airgrain.plans import model
from airgrain.plans import validation as V
from airgrain.schemas import FEATURES, TARGETS


def positions(spark, sizes):
    rows = [(name, date(2025, 1, 1) + timedelta(days=2 * i), i) for name, n in sizes.items() for i in range(n)]
    return spark.createDataFrame(rows, "series_id string, date date, at int").repartition(3)


@pytest.mark.parametrize("folds, gap", [(4, 7), (1, 0), (3, 2)])
def test_folds_follow_positions(spark, folds, gap):
    sizes = {"a": 100, "b": 23, "c": 3, "d": 1}
    got = V.rolling_folds(positions(spark, sizes), folds, gap).collect()
    assert len(got) == sum(sizes.values())
    for r in got:
        n, p = sizes[r.series_id], r["at"]
        start = [k * n // (folds + 1) for k in range(folds + 2)]
        test = [k for k in range(1, folds + 1) if start[k] <= p < start[k + 1]]
        assert r.test_fold == (test[0] if test else None)
        assert r.train_folds == [k for k in range(1, folds + 1) if p < start[k] - gap]
    assert V.rolling_folds(positions(spark, {"a": 2}).where("false"), folds, gap).count() == 0


def test_rungs():
    assert V.rungs(3, 3) == [(3, [1]), (2, [2, 3])]
    assert V.rungs(8, 4) == [(8, [1]), (4, [2, 3]), (2, [4])]
    assert V.rungs(1, 4) == [(1, [1, 2, 3, 4])] and V.rungs(2, 4) == [(2, [1]), (1, [2, 3, 4])]
    assert all(sorted(f for _, own in V.rungs(n, k) for f in own) == list(range(1, k + 1)) for n in range(1, 20) for k in range(1, 9))


def frame(spark, n=60, names=("a", "b")):
    rows = [(s, date(2025, 1, 1) + timedelta(days=i), *[float(i % 5)] * len(FEATURES), *[float(i % 5 + k) for k in range(len(TARGETS))]) for s in names for i in range(n)]
    columns = ", ".join(f"`{c}` double" for c in (*FEATURES, *TARGETS))
    return spark.createDataFrame(rows, f"series_id string, date date, {columns}")


def test_grid_search_keeps_the_better_half_and_goes_on(spark, monkeypatch):
    ran = []

    def scored(kept, fold, keys, ts, by=(), **settings):
        ran.append((settings["x"], fold))
        return spark.createDataFrame([(1.0, 0.5, settings["x"] + fold / 10, 0.1)], "mae double, r2 double, rmse double, mape double")

    monkeypatch.setattr(V, "fold_scores", scored)
    grid = [{"x": 3.0}, {"x": 1.0}, {"x": 2.0}, {"x": 1.0}]
    scores = V.grid_search(frame(spark), grid, folds=4)
    got = sorted((r.candidate, r.fold, r.rung) for r in scores.collect())
    assert got == [(0, 1, 1), (1, 1, 1), (1, 2, 2), (1, 3, 2), (1, 4, 3), (2, 1, 1), (3, 1, 1), (3, 2, 2), (3, 3, 2)]
    assert len(ran) == 9 and V.best_candidate(scores) == 1
    ran.clear()
    again = V.grid_search(frame(spark), grid, folds=4, known=scores.where("fold < 3"))
    assert sorted((r.candidate, r.fold, r.rung) for r in again.collect()) == got and len(ran) == 3


def test_cross_validation_learns_from_the_rows_before(spark):
    """A tree on a feature that tells the target: no error where all its values were seen; a fold without training rows has no scores."""
    settings = {"maxIter": 1, "maxDepth": 4, "subsamplingRate": 1.0, "featureSubsetStrategy": "all"}
    got = {(r.series_id, r.fold): r for r in V.cross_validate(frame(spark), folds=2, gap=7, **settings).collect()}
    assert set(got) == {(s, k) for s in "ab" for k in (1, 2)} and all(r.rmse < 1e-9 and r.r2 > 0.999 for r in got.values())
    assert V.cross_validate(frame(spark, 8), folds=2, gap=7, **settings).count() == 0


def test_fit_tasks_follow_rows(spark, monkeypatch):
    seen = []

    class Learner:
        def __init__(self, **settings):
            pass

        def fit(self, rows):
            seen.append(rows.rdd.getNumPartitions())
            return VectorAssembler(inputCols=["x"], outputCol="p")

    monkeypatch.setattr(model, "GBTRegressor", Learner)
    rows = spark.createDataFrame([("s", i, float(i), float(i)) for i in range(20)], "series_id string, date int, x double, y double")
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "60")
    try:
        model.fit_horizons(rows, ["x"], ["y"])
        model.fit_horizons(rows, ["x"], ["y"], partitions=3)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert seen == [8, 3]
    assert [model.fit_partitions(n, 200) for n in (0, 160_000, 160_001, 10**9)] == [8, 8, 9, 200]
    assert model.fit_partitions(10**6, 4) == 4
