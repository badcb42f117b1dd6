"""Seven-day forecasting with boosted trees."""

from __future__ import annotations

import re
from collections.abc import Sequence
from datetime import date, datetime, timedelta
from multiprocessing.pool import ThreadPool

from pyspark import StorageLevel
from pyspark.ml import PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import GBTRegressor
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from airgrain.functions.text import quoted
from airgrain.operators.columns import conform
from airgrain.operators.metrics import regression_metrics
from airgrain.operators.series import last_row
from airgrain.plans.features import feature_rows, training_frame
from airgrain.schemas import (
    DAY,
    EVALUATION,
    FEATURES,
    FORECAST,
    HORIZON,
    KEYS,
    MODEL_NAME,
    TARGETS,
)
from airgrain.session import use_checkpoints
from airgrain.sources.store import Store, load_table, path_exists, publish

PREDICTIONS = tuple(f"predicted_{i}" for i in range(1, HORIZON + 1))

# The boosting settings.
GBT_SETTINGS = {
    "maxIter": 200,
    "maxDepth": 3,
    "stepSize": 0.035,
    "subsamplingRate": 0.7,
    "featureSubsetStrategy": "0.9",
    "minInstancesPerNode": 1,
    "minInfoGain": 0.0,
    "seed": 42,
}


# A level of a tree is a job of its own, thousands in all, so its tasks must be few and well filled.
FIT_ROWS = 20_000
FIT_PARTITIONS = 8


def fit_partitions(rows: int, most: int) -> int:
    """Partitions of ``rows`` training rows: ``FIT_PARTITIONS``, more where they would hold over ``FIT_ROWS``, up to ``most``."""
    return min(most, max(FIT_PARTITIONS, -(-rows // FIT_ROWS)))


def fit_horizons(
    train: DataFrame,
    features: Sequence[str] = FEATURES,
    targets: Sequence[str] = TARGETS,
    keys: Sequence[str] = KEYS,
    ts: str = DAY,
    partitions: int | None = None,
    parallelism: int = HORIZON,
    **settings,
) -> PipelineModel:
    """One regressor per horizon on rows of all series; the result predicts all horizons at once.

    Rows are dealt by a hash of their keys and sorted first, so that the row sampling can be repeated
    with the same number of partitions.
    """
    spark = train.sparkSession
    use_checkpoints(spark)
    assembler = VectorAssembler(inputCols=list(features), outputCol="features")
    count = partitions or fit_partitions(train.count(), int(spark.conf.get("spark.sql.shuffle.partitions")))
    rows = (
        assembler.transform(train.repartition(count, *keys, ts).sortWithinPartitions(*keys, ts))
        .select("features", *targets)
        .persist(StorageLevel.MEMORY_AND_DISK)
    )
    options = {**GBT_SETTINGS, "checkpointInterval": 10, **settings}

    def fit(i: int):
        learner = GBTRegressor(
            featuresCol="features", labelCol=targets[i], predictionCol=PREDICTIONS[i], **options
        )
        return learner.fit(rows)

    try:
        rows.count()
        with ThreadPool(parallelism) as pool:  # the fits share the cluster as concurrent jobs
            models = pool.map(fit, range(len(targets)))
    finally:
        rows.unpersist()
    return PipelineModel(stages=[assembler, *models])


def predict(model: PipelineModel, rows: DataFrame) -> DataFrame:
    """One column ``predicted_i`` per horizon."""
    return model.transform(rows).drop("features")


def to_long(
    df: DataFrame, keep: Sequence[str], **outputs: Sequence[str]
) -> DataFrame:
    """Wide to long: one row per horizon (from 1). ``outputs`` maps a new column to its wide
    columns in horizon order."""
    size = len(next(iter(outputs.values())))
    steps = ", ".join(
        "struct({} AS horizon, {})".format(
            i + 1, ", ".join(f"{quoted(cols[i])} AS {quoted(n)}" for n, cols in outputs.items())
        )
        for i in range(size)
    )
    return df.selectExpr(*map(quoted, keep), f"inline(array({steps}))")


def evaluate(
    predicted: DataFrame, run_ts: datetime | str, keys: Sequence[str] = KEYS, ts: str = DAY
) -> DataFrame:
    """One score row per series from test rows with targets and predictions, rounded to 4."""
    long = to_long(predicted, [*keys, ts], y=TARGETS, p=PREDICTIONS)
    return score_rows(regression_metrics(long, "y", "p", "horizon", keys), run_ts)


def score_rows(metrics: DataFrame, run_ts: datetime | str) -> DataFrame:
    """Metrics as rows of ``model_evaluation``."""
    when = run_ts if isinstance(run_ts, datetime) else datetime.fromisoformat(run_ts)
    scored = metrics.withColumns({
        "timestamp": F.lit(when.isoformat()),
        "eval_date": F.lit(when.date()),
        **{m: F.round(m, 4) for m in ("mae", "r2", "rmse", "mape")},
    })
    return conform(scored, EVALUATION)


def forecast_rows(
    predicted: DataFrame,
    as_of,
    keys: Sequence[str] = KEYS,
    predictions: Sequence[str] = PREDICTIONS,
    model_name: str = MODEL_NAME,
    location: Column | None = None,
) -> DataFrame:
    """One row per series as seven dated rows, counted from ``as_of`` and rounded to 2."""
    long = to_long(predicted, keys, predicted_aqi=predictions)
    day = F.lit(as_of).cast("date")
    dated = long.withColumns({
        "forecast_date": day,
        "predicted_date": F.date_add(day, F.col("horizon")),
        "predicted_aqi": F.round("predicted_aqi", 2),
        "model_name": F.lit(model_name),
        "location": F.col(keys[0]) if location is None else location,
    })
    return conform(dated, FORECAST)


def check_horizon(
    forecast: DataFrame,
    expected: int = HORIZON,
    keys: Sequence[str] = (*KEYS, "forecast_date"),
    series: DataFrame | None = None,
) -> DataFrame:
    """The forecast, if every series has exactly the expected number of predictions. ``series`` lists
    those that must be there at all."""
    if series is not None:
        absent = series.join(forecast.select(*series.columns), series.columns, "left_anti").first()
        if absent is not None:
            raise ValueError(f"no forecast for {absent.asDict()}")
    known = F.count(F.when(F.col("predicted_aqi").isNotNull(), 1))
    wrong = forecast.groupBy(*keys).agg(known.alias("n")).where(F.col("n") != expected).first()
    if wrong is not None:
        raise ValueError(f"expected {expected} predictions, got {wrong['n']}: {wrong.asDict()}")
    return forecast


def recent(df: DataFrame, as_of, lookback_days: int | None, ts: str = DAY) -> DataFrame:
    """Optionally only the last days, which reaches the scan. The lookback must span the seven lags
    and the incomplete rows between them; by default the whole history is used."""
    if lookback_days is None:
        return df
    return df.where(F.col(ts) >= F.lit(first_day(as_of, lookback_days)).cast("date"))


def first_day(as_of, lookback_days: int) -> date:
    """The first of the last ``lookback_days`` days up to ``as_of``."""
    day = as_of if isinstance(as_of, date) else date.fromisoformat(str(as_of)[:10])
    return day - timedelta(days=lookback_days - 1)


def forecast(
    cleaned: DataFrame,
    model: PipelineModel,
    as_of,
    keys: Sequence[str] = KEYS,
    ts: str = DAY,
    lookback_days: int | None = None,
) -> DataFrame:
    """Seven days for all series in one job, from the last complete row of each."""
    latest = last_row(feature_rows(recent(cleaned, as_of, lookback_days, ts), keys, ts), keys, ts)
    return forecast_rows(predict(model, latest), as_of, keys)


def train(
    cleaned: DataFrame, run_ts, keys: Sequence[str] = KEYS, ts: str = DAY, **settings
) -> tuple[PipelineModel, DataFrame]:
    """Fit on the train rows and score the test rows: the model and its score rows, one per series,
    which are computed here and kept."""
    frame = training_frame(cleaned, keys, ts).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        model = fit_horizons(frame.where("split = 'train'"), keys=keys, ts=ts, **settings)
        scores = evaluate(predict(model, frame.where("split = 'test'")), run_ts, keys, ts)
        scores = scores.persist(StorageLevel.MEMORY_AND_DISK)
        scores.count()
    finally:
        frame.unpersist()
    return model, scores


VERSIONS = "_versions"


def model_version(spark: SparkSession, path: str) -> int:
    """The newest complete version of the model at ``path``; 0 if there is none."""
    if not path_exists(spark, f"{path}/{VERSIONS}"):
        return 0
    return spark.read.schema("version long").json(f"{path}/{VERSIONS}").agg(F.max("version")).first()[0] or 0


def save_model(model: PipelineModel, path: str) -> None:
    """Becomes the model at ``path`` once all of it is written; until then the earlier one stays."""
    spark = SparkSession.active()
    version = model_version(spark, path) + 1
    model.write().overwrite().save(f"{path}/version={version}")
    line = spark.createDataFrame([(version,)], "version long")
    line.coalesce(1).write.mode("append").json(f"{path}/{VERSIONS}")


def load_model(path: str) -> PipelineModel:
    version = model_version(SparkSession.active(), path)
    if not version:
        raise ValueError(f"no model at {path}")
    return PipelineModel.load(f"{path}/version={version}")


def load_or_train(
    spark: SparkSession, store: Store, run_ts, path: str | None = None, **settings
) -> PipelineModel:
    """The stored model; if there is none, one is trained on ``cleaned_data`` and saved, and its
    scores are upserted."""
    path = path or store.path("model")
    if not model_version(spark, path):
        model, scores = train(load_table(spark, store, "cleaned_data"), run_ts, **settings)
        publish({"model_evaluation": scores}, store, f"train-{re.sub(r'[^0-9A-Za-z]+', '-', str(run_ts))}")
        save_model(model, path)
    return load_model(path)
