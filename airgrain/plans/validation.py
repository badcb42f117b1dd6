"""Rolling-origin cross-validation and grid search by successive halving."""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence
from multiprocessing.pool import ThreadPool

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from airgrain.functions.text import with_expressions
from airgrain.operators.merge import upsert
from airgrain.operators.metrics import regression_metrics
from airgrain.operators.series import add_position
from airgrain.plans.model import PREDICTIONS, fit_horizons, predict, to_long
from airgrain.schemas import DAY, HORIZON, KEYS, TARGETS
from airgrain.session import written

FOLDS = 4
SCORES = ("mae", "r2", "rmse", "mape")


def rolling_folds(
    df: DataFrame, folds: int = FOLDS, gap: int = HORIZON, keys: Sequence[str] = KEYS, ts: str = DAY, segment=None
) -> DataFrame:
    """Add ``test_fold`` and ``train_folds``: each row once, with the folds it serves.

    A series of n rows is cut into ``folds + 1`` blocks at floor(k n / (folds + 1)). Block k (from 1) tests fold k, whose model sees
    the rows before the block except the last ``gap``, since their targets reach into it. Rows of block 0 test nothing.
    """
    placed = add_position(df, keys, ts, segment, "_pos", "_size")
    start = f"CAST(floor(k * _size / {folds + 1}) AS bigint)"
    numbers = f"sequence(1, {folds})"
    return with_expressions(placed, {
        "test_fold": f"nullif(size(filter({numbers}, k -> _pos > {start})), 0)",
        "train_folds": f"filter({numbers}, k -> _pos <= {start} - {gap})",
    }).drop("_pos", "_size")


def fold_scores(frame: DataFrame, fold: int, keys: Sequence[str] = KEYS, ts: str = DAY, by: Sequence[str] | None = None, **settings) -> DataFrame | None:
    """Scores of the fold's model on its test rows, per ``by`` (default ``keys``); None if no row trains it."""
    train = frame.where(F.array_contains("train_folds", fold))
    if train.isEmpty():
        return None
    model = fit_horizons(train, keys=keys, ts=ts, **settings)
    tested = predict(model, frame.where(F.col("test_fold") == fold))
    group = list(keys if by is None else by)
    long = to_long(tested, [*dict.fromkeys([*keys, ts, *group])], y=TARGETS, p=PREDICTIONS)
    return regression_metrics(long, "y", "p", "horizon", group).withColumn("fold", F.lit(fold)).select(*group, "fold", *SCORES)


def cross_validate(
    frame: DataFrame, folds: int = FOLDS, keys: Sequence[str] = KEYS, ts: str = DAY, gap: int = HORIZON, parallelism: int = 2, **settings
) -> DataFrame:
    """keys, fold and the scores of each fold's model. ``frame`` has features and targets; it is kept once for all folds, which run as concurrent jobs."""
    kept = rolling_folds(frame, folds, gap, keys, ts).persist(StorageLevel.MEMORY_AND_DISK)
    schema = ", ".join([*(f"`{k}` {kept.schema[k].dataType.simpleString()}" for k in keys), "fold int", *(f"{s} double" for s in SCORES)])

    def run(fold: int) -> DataFrame | None:
        found = fold_scores(kept, fold, keys, ts, **settings)
        return None if found is None else written(found, "fold-scores")

    try:
        with ThreadPool(parallelism) as pool:
            scores = [s for s in pool.map(run, range(1, folds + 1)) if s is not None]
    finally:
        kept.unpersist()
    out = frame.sparkSession.createDataFrame([], schema)
    for s in scores:
        out = out.unionByName(s)
    return out


def rungs(candidates: int, folds: int) -> list[tuple[int, list[int]]]:
    """Successive halving: (candidates that run, the folds they run), each rung with half as many candidates on twice as many folds."""
    out, at, size = [], 1, 1
    while at <= folds:
        last = candidates == 1
        own = list(range(at, folds + 1 if last else min(folds, at + size - 1) + 1))
        out.append((candidates, own))
        at, size, candidates = own[-1] + 1, 2 * size, max(1, -(-candidates // 2))
    return out


def grid_search(
    frame: DataFrame,
    candidates: Sequence[Mapping],
    folds: int = FOLDS,
    keys: Sequence[str] = KEYS,
    ts: str = DAY,
    gap: int = HORIZON,
    known: DataFrame | None = None,
    parallelism: int = 2,
) -> DataFrame:
    """candidate, fold, rung, mae, r2, rmse, mape and ``settings`` of every fit that ran, over all rows of the fold.

    Candidates are settings of ``fit_horizons``. Each rung keeps the half with the least mean RMSE over its folds so far (ties: the
    earlier one). Fits of a rung run as concurrent jobs over one kept frame; their scores are upserted by (candidate, fold), so a
    search begun anew with ``known`` scores of this layout runs only what is missing.
    """
    spark = frame.sparkSession
    kept = rolling_folds(frame, folds, gap, keys, ts).persist(StorageLevel.MEMORY_AND_DISK)
    layout = "candidate int, fold int, rung int, mae double, r2 double, rmse double, mape double, settings string"
    scores = spark.createDataFrame([], layout) if known is None else known.select(*[c.split()[0] for c in layout.split(", ")])
    alive = list(range(len(candidates)))

    def run(task: tuple[int, int, int]):
        rung, candidate, fold = task
        found = fold_scores(kept, fold, keys, ts, by=(), **candidates[candidate])
        row = None if found is None else found.first()  # one row of scores
        settings = json.dumps(dict(candidates[candidate]), sort_keys=True)
        return None if row is None else (candidate, fold, rung, *(row[s] for s in SCORES), settings)

    try:
        for rung, (size, own) in enumerate(rungs(len(candidates), folds), 1):
            have = {(r["candidate"], r["fold"]): r["rmse"] for r in scores.select("candidate", "fold", "rmse").collect()}  # a row per fit
            means = {c: [have[c, f] for f in range(1, folds + 1) if (c, f) in have and f < own[0]] for c in alive}
            alive = sorted(alive, key=lambda c: (sum(means[c]) / len(means[c]) if means[c] else float("inf"), c))[:size]
            tasks = [(rung, c, f) for c in sorted(alive) for f in own if (c, f) not in have]
            with ThreadPool(parallelism) as pool:
                rows = [r for r in pool.map(run, tasks) if r is not None]
            if rows:
                scores = written(upsert(scores, spark.createDataFrame(rows, layout), ("candidate", "fold")), "grid-scores")
    finally:
        kept.unpersist()
    return scores


def best_candidate(scores: DataFrame) -> int:
    """The candidate with the most folds, then the least mean RMSE, then the least number."""
    ranked = scores.groupBy("candidate").agg(F.count(F.lit(1)).alias("n"), F.avg("rmse").alias("rmse"))
    return ranked.orderBy(F.col("n").desc(), "rmse", "candidate").first()["candidate"]
