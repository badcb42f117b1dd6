"""Registered queries of the studies: streams that close days, correlation, outliers, validation; and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from airgrain.checks import oracle as O
from airgrain.checks import views as V
from airgrain.functions.scalars import nan_to_null, round_floats
from airgrain.operators.merge import last_write_wins
from airgrain.plans.features import training_frame
from airgrain.plans.validation import cross_validate, grid_search, rolling_folds
from airgrain.operators.statistics import correlation, outlier_bounds, rank_correlation, treat_outliers
from airgrain.schemas import POLLUTANTS
from airgrain.session import scratch_path
from airgrain.streaming.hourly import daily_means, drop_repeats, run_closed_days, run_updates

ID = ("series_id", "date")
Spark = SparkSession


def _out(df: DataFrame, decimals: int = 4) -> DataFrame:
    return round_floats(nan_to_null(df), decimals)


# ---- streams --------------------------------------------------------------------------------

PERIODS, DELAY_DAYS = 4, 2
LANDINGS = PERIODS + 3  # the latest rows come two landings late, their repeats one later


def landings(spark: Spark, d: str) -> DataFrame:
    """Events with the landing they come in: four periods one after the other, some rows one or two landings late,
    some once more in the next landing, some twice in one."""
    events = V.table(spark, d, "events")
    micros = "unix_micros(CAST(ts AS timestamp))"
    low, high = events.selectExpr(f"min({micros})", f"max({micros})").first()
    late = "CASE WHEN event_id % 11 = 0 THEN 2 WHEN event_id % 17 = 0 THEN 1 ELSE 0 END"
    period = f"CAST(({micros} - {low or 0}) * {PERIODS} div {(high or 0) - (low or 0) + 1} + {late} AS int)"
    again = "CASE WHEN event_id % 7 = 0 THEN array(1) ELSE array() END"
    twice = "CASE WHEN event_id % 13 = 0 THEN array(0) ELSE array() END"
    shifts = f"explode(concat(array(0), {again}, {twice})) AS _shift"
    return events.selectExpr("*", f"{period} AS _period", shifts).selectExpr(*events.columns, "_period + _shift AS landing")


def _stream_landings(spark: Spark, d: str, start) -> str:
    """Lands the events one landing after the other; ``start(observations, root)`` takes what is there and ends."""
    root = scratch_path(spark, "landings")
    schema = V.table(spark, d, "events").schema
    rows = landings(spark, d)
    for i in range(LANDINGS):
        rows.where(F.col("landing") == i).drop("landing").write.mode("append").parquet(f"{root}/landing")
        arriving = spark.readStream.schema(schema).parquet(f"{root}/landing")
        obs = V.hourly_from_events(arriving).withColumn("obs_ts", F.col("obs_ts").cast("timestamp")).drop("date")
        start(obs, root).awaitTermination()
    return root


def stream_closed_days(spark: Spark, d: str) -> DataFrame:
    """Append mode: the days that the watermark has closed, repeats once, late rows left out."""
    def start(obs, root):
        return run_closed_days(obs, ["value"], f"{root}/days", f"{root}/checkpoint", ident=["seq"], delay=f"{DELAY_DAYS} days")

    return _out(spark.read.parquet(f"{_stream_landings(spark, d, start)}/days"))


def stream_changed_days(spark: Spark, d: str) -> DataFrame:
    """Update mode: each batch writes the days it changes; the newest state of all days, open ones too."""
    def start(obs, root):
        once = drop_repeats(obs, keys=("series_id", "seq"), delay=f"{DELAY_DAYS} days")
        return run_updates(daily_means(once, ["value"]), f"{root}/days", f"{root}/checkpoint")

    days = spark.read.parquet(f"{_stream_landings(spark, d, start)}/days")
    return _out(last_write_wins(days, ID, "batch_id").drop("batch_id"))


_LANDED = f"""e AS (SELECT *, epoch_us(ts) AS us FROM events),
span AS (SELECT min(us) AS low, max(us) AS high FROM e),
first_landing AS (
  SELECT e.*, (us - low) * {PERIODS} // (high - low + 1) + CASE WHEN event_id % 11 = 0 THEN 2 WHEN event_id % 17 = 0 THEN 1 ELSE 0 END AS landing
  FROM e, span),
landed AS (
  SELECT * FROM first_landing UNION ALL SELECT * REPLACE (landing + 1 AS landing) FROM first_landing WHERE event_id % 7 = 0
  UNION ALL SELECT * FROM first_landing WHERE event_id % 13 = 0),
newest AS (SELECT landing, max(us) AS us FROM landed GROUP BY landing),
mark AS (SELECT landing, max(us) OVER (ORDER BY landing ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) // 1000 * 1000 - {DELAY_DAYS * 86_400_000_000} AS mark FROM newest),
taken AS (SELECT DISTINCT event_id, event_type, ts, value FROM landed JOIN mark USING (landing) WHERE mark IS NULL OR us > mark),
days AS (
  SELECT event_type AS series_id, CAST(ts AS DATE) AS date, count(*) AS n,
         round(avg(CASE WHEN event_id % 4 <> 0 THEN floor(value * 4) / 4 END), 4) AS value
  FROM taken GROUP BY event_type, CAST(ts AS DATE))"""


# ---- correlation and outliers ---------------------------------------------------------------

STUDIED = ("pm25", "pm10", "o3", "no2", "so2", "co", "temp", "humidity", "windspeed", "AQI")


def correlation_matrix(spark: Spark, d: str) -> DataFrame:
    """All pairs of pollutants, index and weather, per series and over all of them."""
    return _out(correlation(V.raw_daily(spark, d), STUDIED))


def correlation_observed(spark: Spark, d: str) -> DataFrame:
    """The pollutants as observed, with their nulls: a pair counts the rows where both are known."""
    return _out(correlation(V.pollutant_obs(spark, d), POLLUTANTS))


def rank_correlation_matrix(spark: Spark, d: str) -> DataFrame:
    return _out(rank_correlation(V.raw_daily(spark, d), STUDIED, ID))


def _pairs(columns):
    return [(a, b) for i, a in enumerate(columns) for b in columns[i + 1:]]


def _correlations(source: str, columns, series: bool = True) -> str:
    """Of each pair the rows where both are known; nothing where there is none."""
    long = " UNION ALL ".join(f"SELECT series_id, '{a}' AS a, '{b}' AS b, {a}::DOUBLE AS x, {b}::DOUBLE AS y FROM {source} WHERE {a} IS NOT NULL AND {b} IS NOT NULL" for a, b in _pairs(columns))
    r = "count(*) AS n, round(CASE WHEN min(x) < max(x) AND min(y) < max(y) THEN corr(x, y) END, 4) + 0::DOUBLE AS r"  # no negative zero
    whole = f"SELECT {'NULL AS series_id, ' if series else ''}a, b, {r} FROM pair GROUP BY a, b"
    return f"pair AS ({long})\n" + (f"SELECT series_id, a, b, {r} FROM pair GROUP BY series_id, a, b UNION ALL {whole}" if series else whole)


_COMPLETE = " AND ".join(f"{c} IS NOT NULL" for c in STUDIED)
_RANKS = ", ".join(f"rank() OVER (ORDER BY {c}) + (count(*) OVER (PARTITION BY {c}) - 1) / 2.0 AS {c}" for c in STUDIED)


def outlier_limits(spark: Spark, d: str) -> DataFrame:
    """Quartiles and fences of each pollutant and series, over all observations."""
    return _out(outlier_bounds(V.pollutant_obs(spark, d), POLLUTANTS))


def _treated(spark: Spark, d: str, how: str) -> DataFrame:
    obs = V.pollutant_obs(spark, d).drop("flag")
    return _out(treat_outliers(obs, outlier_bounds(obs, POLLUTANTS, factor=0.5), how))


def outliers_clipped(spark: Spark, d: str) -> DataFrame:
    """Every observation, values moved to fences half a quartile distance outside the quartiles."""
    return _treated(spark, d, "clip")


def outliers_nulled(spark: Spark, d: str) -> DataFrame:
    """The same, with values beyond the fences unknown."""
    return _treated(spark, d, "null")


def _quartiles(factor: float) -> str:
    each = " UNION ALL ".join(
        f"SELECT series_id, '{p}' AS \"column\", count({p}) AS n, quantile_cont({p}::DOUBLE, 0.25) AS q1, quantile_cont({p}::DOUBLE, 0.75) AS q3 FROM p_obs GROUP BY series_id HAVING count({p}) > 0"
        for p in POLLUTANTS)
    return f"{O.POLLUTANT_OBS},\nquartile AS ({each}),\nfence AS (SELECT *, q1 - {factor} * (q3 - q1) AS low, q3 + {factor} * (q3 - q1) AS high FROM quartile)"


def _treated_sql(how: str) -> str:
    shown = {"clip": "least(greatest({0}, f_{0}.low), f_{0}.high)", "null": "CASE WHEN {0} BETWEEN f_{0}.low AND f_{0}.high THEN {0} END"}[how]
    columns = ", ".join(f"round(CASE WHEN {p} IS NOT NULL THEN {shown.format(p)} END, 4) AS {p}" for p in POLLUTANTS)
    joins = " ".join(f"LEFT JOIN fence f_{p} ON f_{p}.series_id = o.series_id AND f_{p}.\"column\" = '{p}'" for p in POLLUTANTS)
    return f"WITH {_quartiles(0.5)}\nSELECT o.series_id, o.date, seq, line, part, supp, {columns} FROM p_obs o {joins}"


# ---- validation -----------------------------------------------------------------------------

VALIDATION_FOLDS = 3
STUMP = {"maxIter": 1, "maxDepth": 1, "subsamplingRate": 1.0, "featureSubsetStrategy": "all"}
# Settings whose models SQL can state: the mean of a flag's group, and the mean of all rows.
CANDIDATES = (
    {**STUMP, "features": ["is_summer"]}, {**STUMP, "features": ["is_winter"]}, {**STUMP, "features": ["is_summer"], "minInfoGain": 1e12})


def cv_folds(spark: Spark, d: str) -> DataFrame:
    """The fold that each training row tests and the folds it trains."""
    rows = rolling_folds(training_frame(V.cleaned_daily(spark, d)), VALIDATION_FOLDS)
    return rows.select(*ID, "test_fold", F.array_join("train_folds", ",").alias("train_folds"))


def cv_scores(spark: Spark, d: str) -> DataFrame:
    """Scores of one stump per fold and series."""
    return _out(cross_validate(training_frame(V.cleaned_daily(spark, d)), VALIDATION_FOLDS, **CANDIDATES[0]))


def grid_scores(spark: Spark, d: str) -> DataFrame:
    """Three candidates on the first fold, the better two on the others."""
    return _out(grid_search(training_frame(V.cleaned_daily(spark, d)), CANDIDATES, VALIDATION_FOLDS).drop("settings"))


_FOLDS = O.GROUP_MEANS.split("f5 AS (")[0] + f"""numbered AS (SELECT *, row_number() OVER w AS pos FROM f4 {O.W_SERIES}),
blocks AS (SELECT *, k, k * n // {VALIDATION_FOLDS + 1} AS start, (k + 1) * n // {VALIDATION_FOLDS + 1} AS stop FROM numbered, range(1, {VALIDATION_FOLDS + 1}) t(k)),
folds AS (
  SELECT series_id, date, max(CASE WHEN pos > start AND pos <= stop THEN k END) AS test_fold,
         coalesce(string_agg(CASE WHEN pos <= start - 7 THEN k END, ',' ORDER BY k), '') AS train_folds FROM blocks GROUP BY series_id, date)"""
_LONG = f"""{_FOLDS},
days AS ({" UNION ALL ".join(f"SELECT series_id, date, is_summer, is_winter, pos, start, stop, k AS fold, {i} AS horizon, AQI_day_{i} AS y FROM blocks" for i in range(1, 8))}),
groups AS (SELECT *, CASE candidate WHEN 0 THEN is_summer WHEN 1 THEN is_winter ELSE 0 END AS flag FROM days, range({len(CANDIDATES)}) t(candidate)),
means AS (SELECT candidate, fold, horizon, flag, avg(y) AS p FROM groups WHERE pos <= start - 7 GROUP BY ALL),
tested AS (SELECT * FROM groups JOIN means USING (candidate, fold, horizon, flag) WHERE pos > start AND pos <= stop)"""


def _scores_sql(by: str) -> str:
    return f"""scored AS (
  SELECT {by}, horizon, avg(abs(y - p)) AS mae, avg((y - p) * (y - p)) AS mse, var_pop(y) AS v, avg(abs(y - p) / greatest(abs(y), 2.220446049250313e-16)) AS mape
  FROM tested GROUP BY {by}, horizon),
scores AS (
  SELECT {by}, avg(mae) AS mae, avg(CASE WHEN v > 0 THEN 1 - mse / v WHEN mse = 0 THEN 1 ELSE 0 END) AS r2, sqrt(avg(mse)) AS rmse, avg(mape) AS mape
  FROM scored GROUP BY {by})"""


_SHOWN = "round(mae, 4) AS mae, round(r2, 4) AS r2, round(rmse, 4) AS rmse, round(mape, 4) AS mape"

QUERIES = {
    f.__name__: f
    for f in (
        stream_closed_days, stream_changed_days, correlation_matrix, correlation_observed, rank_correlation_matrix,
        outlier_limits, outliers_clipped, outliers_nulled, cv_folds, cv_scores, grid_scores,
    )
}

ORACLE = {
    "stream_closed_days": f"""WITH {_LANDED}
SELECT * FROM days WHERE epoch_us(CAST(date + 1 AS TIMESTAMP)) <= (SELECT max(us) // 1000 * 1000 - {DELAY_DAYS * 86_400_000_000} FROM landed)""",
    "stream_changed_days": f"WITH {_LANDED}\nSELECT * FROM days",
    "correlation_matrix": f"WITH {O.RAW},\n{_correlations('raw', STUDIED)}",
    "correlation_observed": f"WITH {O.POLLUTANT_OBS},\n{_correlations('p_obs', POLLUTANTS)}",
    "rank_correlation_matrix": f"WITH {O.RAW},\nranked AS (SELECT series_id, {_RANKS} FROM raw WHERE {_COMPLETE}),\n{_correlations('ranked', STUDIED, False)}",
    "outlier_limits": f"""WITH {_quartiles(1.5)}
SELECT series_id, "column", n, round(q1, 4) AS q1, round(q3, 4) AS q3, round(low, 4) AS low, round(high, 4) AS high FROM fence""",
    "outliers_clipped": _treated_sql("clip"),
    "outliers_nulled": _treated_sql("null"),
    "cv_folds": f"WITH {_FOLDS}\nSELECT series_id, date, CAST(test_fold AS INTEGER) AS test_fold, train_folds FROM folds",
    "cv_scores": f"WITH {_LONG},\n{_scores_sql('candidate, series_id, fold')}\nSELECT series_id, CAST(fold AS INTEGER) AS fold, {_SHOWN} FROM scores WHERE candidate = 0",
    "grid_scores": f"""WITH {_LONG},
{_scores_sql('candidate, fold')},
first_rung AS (SELECT candidate, row_number() OVER (ORDER BY rmse, candidate) AS place FROM scores WHERE fold = 1)
SELECT CAST(candidate AS INTEGER) AS candidate, CAST(fold AS INTEGER) AS fold, CASE WHEN fold = 1 THEN 1 ELSE 2 END AS rung, {_SHOWN}
FROM scores JOIN first_rung USING (candidate) WHERE fold = 1 OR place <= 2""",
}
