"""The registered queries in DuckDB SQL, written against the driver tables."""

from __future__ import annotations

from airgrain.schemas import (
    BANDS,
    BASE_FEATURES,
    CLEANED,
    DISPLAY_NAMES,
    ENGINEERED_FEATURES,
    INDEX_RANGES,
    MODEL_NAME,
    POLLUTANTS,
    SUB_INDEXES,
    WEATHER_COLUMNS,
    WEATHER_NUMERIC,
    WEATHER_TEXT,
)

POLLUTANT_OBS = """p_obs AS (
  SELECT CAST(s_nationkey AS VARCHAR) AS series_id, CAST(l_shipdate AS DATE) AS date,
         l_orderkey AS seq, l_linenumber AS line, l_partkey AS part, l_suppkey AS supp, l_returnflag AS flag,
         CASE WHEN NOT silent THEN l_quantity * 6 END AS pm25,
         CASE WHEN NOT silent THEN l_quantity * 10 END AS pm10,
         CASE WHEN NOT silent THEN floor(l_extendedprice / 25) / 4 END AS o3,
         CASE WHEN NOT silent THEN round(l_discount * 100) * 50 END AS no2,
         CASE WHEN NOT silent THEN round(l_tax * 100) * 200 END AS so2,
         CASE WHEN NOT silent AND l_linenumber <> 5 THEN l_quantity * 0.75::DOUBLE END AS co
  FROM (SELECT *, l_returnflag = 'R' AND l_linenumber % 2 = 0 AS silent FROM lineitem)
  JOIN supplier ON l_suppkey = s_suppkey)"""

WEATHER_OBS = """w_base AS (
  SELECT CAST(c_nationkey AS VARCHAR) AS series_id, CAST(o_orderdate AS DATE) AS date, o_orderkey AS k,
         floor(o_totalprice / 2500) / 4 AS t, o_orderstatus, o_orderpriority
  FROM orders JOIN customer ON o_custkey = c_custkey),
w_obs AS (
  SELECT series_id, date, k AS seq, o_orderstatus AS status, 'NATION_' || series_id AS name,
         t + k % 7 AS tempmax, t - k % 5 AS tempmin, t AS temp, t + k % 7 + 1 AS feelslikemax,
         t - k % 5 - 1 AS feelslikemin, t + k % 3 AS feelslike,
         CASE WHEN k % 3 <> 0 THEN (k % 31)::DOUBLE END AS dew, (k % 100)::DOUBLE AS humidity,
         (k % 13)::DOUBLE AS precip, (k % 101)::DOUBLE AS precipprob, (k % 51)::DOUBLE AS precipcover,
         CASE k % 4 WHEN 1 THEN 'rain' WHEN 2 THEN 'snow' WHEN 3 THEN 'rain,snow' END AS preciptype,
         (k % 2)::DOUBLE AS snow, CASE WHEN k % 2 <> 0 THEN (k % 9)::DOUBLE END AS snowdepth,
         CASE WHEN k % 4 <> 1 THEN (k % 80)::DOUBLE END AS windgust, (k % 40)::DOUBLE AS windspeed,
         (k % 360)::DOUBLE AS winddir, (k % 60 + 980)::DOUBLE AS sealevelpressure,
         (k % 97)::DOUBLE AS cloudcover, (k % 25)::DOUBLE AS visibility,
         (k % 301)::DOUBLE AS solarradiation, (k % 29)::DOUBLE AS solarenergy, (k % 11)::DOUBLE AS uvindex,
         NULL::DOUBLE AS severerisk, '06:' || lpad((k % 60)::VARCHAR, 2, '0') || ':00' AS sunrise,
         '18:' || lpad((k % 60)::VARCHAR, 2, '0') || ':00' AS sunset, (k % 8)::DOUBLE AS moonphase,
         CASE WHEN k % 5 <> 0 THEN o_orderstatus END AS conditions, o_orderpriority AS description,
         CASE WHEN k % 2 = 0 THEN 'clear-day' ELSE 'cloudy' END AS icon, 'S' || (k % 17)::VARCHAR AS stations
  FROM w_base)"""

HOURLY_OBS = """h_obs AS (
  SELECT event_type AS series_id, CAST(ts AS DATE) AS date, ts AS obs_ts, event_id AS seq,
         CASE WHEN event_id % 4 <> 0 THEN floor(value * 4) / 4 END AS value,
         CASE WHEN event_id % 3 = 0 THEN 'u' || user_id::VARCHAR END AS note, props
  FROM events)"""


def _list(parts) -> str:
    return ", ".join(parts)


def _band_case(p: str, scale: bool = False) -> str:
    whens = []
    for (lo, hi), (ilo, ihi) in zip(BANDS[p], INDEX_RANGES, strict=True):
        value = p
        if scale:
            value = f"({ihi}::DOUBLE - {ilo}) / ({hi}::DOUBLE - {lo}::DOUBLE) * ({p} - {lo}::DOUBLE) + {ilo}"
        whens.append(f"WHEN {p} BETWEEN {lo}::DOUBLE AND {hi}::DOUBLE THEN {value}")
    return f"CASE {' '.join(whens)} END AS AQI_{p}"


def _with_aqi(source: str, scale: bool = False) -> str:
    cases = _list(_band_case(p, scale) for p in POLLUTANTS)
    return (
        f"SELECT *, greatest({_list(SUB_INDEXES)}) AS AQI FROM (SELECT *, {cases} FROM {source})"
    )


P_MEANS = (
    f"{POLLUTANT_OBS},\np_means AS (SELECT series_id, date, "
    f"{_list(f'avg({p}) AS {p}' for p in POLLUTANTS)} FROM p_obs GROUP BY series_id, date)"
)
P_DAILY = f"{P_MEANS},\np_daily AS ({_with_aqi('p_means')})"
_W_MEANS = _list(
    f"avg({c}) AS {c}" if c in WEATHER_NUMERIC
    else f"arg_min({c}, seq) FILTER (WHERE {c} IS NOT NULL) AS {c}"
    for c in WEATHER_COLUMNS
)
W_DAILY = f"{WEATHER_OBS},\nw_daily AS (SELECT series_id, date, {_W_MEANS} FROM w_obs GROUP BY series_id, date)"
RAW = f"{P_DAILY},\n{W_DAILY},\nraw AS (SELECT * FROM w_daily JOIN p_daily USING (series_id, date))"
CLEAN = f"{RAW},\nclean AS (SELECT series_id, {_list(CLEANED)} FROM raw)"

POLLUTANT_VALUES = (*POLLUTANTS, *SUB_INDEXES, "AQI")


def _r(cols, digits: int = 4) -> str:
    return _list(f"round({c}, {digits}) AS {c}" for c in cols)


def _weather_out(digits: int = 4) -> str:
    return _list(f"round({c}, {digits}) AS {c}" if c in WEATHER_NUMERIC else c for c in WEATHER_COLUMNS)


def _interpolated(source: str, cols, order: str, backward: bool = False) -> str:
    """Row-position interpolation of several columns as a query on ``source``."""
    near, line = [], []
    for c in cols:
        known = f"CASE WHEN {c} IS NOT NULL THEN rn END"
        for name, value in (("v", c), ("r", known)):
            near.append(f"last_value({value} IGNORE NULLS) OVER back AS _p{name}_{c}")
            near.append(f"first_value({value} IGNORE NULLS) OVER ahead AS _n{name}_{c}")
        between = f"_pv_{c} + (_nv_{c} - _pv_{c}) * (rn - _pr_{c}) / (_nr_{c} - _pr_{c})"
        rest = f", _nv_{c}" if backward else ""
        line.append(f"CASE WHEN {c} IS NOT NULL THEN {c} ELSE coalesce({between}, _pv_{c}{rest}) END AS {c}")
    return f"""SELECT * REPLACE ({_list(line)}) FROM (
      SELECT *, {_list(near)} FROM (SELECT *, row_number() OVER (PARTITION BY series_id ORDER BY {order}) AS rn FROM {source})
      WINDOW back AS (PARTITION BY series_id ORDER BY rn ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
             ahead AS (PARTITION BY series_id ORDER BY rn ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))"""


def _shifts(col: str, n: int, fn: str, pattern: str, window: str) -> str:
    return _list(f"{fn}({col}, {i}) OVER {window} AS {pattern.format(i)}" for i in range(1, n + 1))


W_SERIES = "WINDOW w AS (PARTITION BY series_id ORDER BY date)"
W_TIMED = "WINDOW w AS (PARTITION BY series_id ORDER BY obs_ts, seq)"
LAGS = [f"lag_{i}_AQI" for i in range(1, 8)]
DAYS = [f"AQI_day_{i}" for i in range(1, 8)]

FEATURE_ROWS = f"""{CLEAN},
f1 AS (
  SELECT *, {_list(f"coalesce({p}, 0)" for p in POLLUTANTS).replace(", 0), ", ", 0) + ")} AS total_pollution,
         CASE WHEN count(AQI) OVER w7 = 7 THEN sum(AQI) OVER w7 END AS aqi_cum_sum_7,
         CAST(month(date) AS INTEGER) AS month,
         CAST(month(date) IN (6, 7, 8) AS INTEGER) AS is_summer,
         CAST(month(date) IN (12, 1, 2) AS INTEGER) AS is_winter,
         pm25 * co AS pm25_co_interaction, temp * humidity AS temp_humidity_interaction,
         CASE WHEN count(pm25) OVER w7 = 7 THEN sum(pm25) OVER w7 END AS pm25_cumulative_sum_7,
         pm25 * no2 AS pm25_no2_interaction, pm25 * so2 AS pm25_so2_interaction,
         {_shifts("AQI", 7, "lag", "lag_{}_AQI", "w")}
  FROM clean
  WINDOW w AS (PARTITION BY series_id ORDER BY date),
         w7 AS (PARTITION BY series_id ORDER BY date ROWS BETWEEN 6 PRECEDING AND CURRENT ROW))"""
FEATURE_COLUMNS = [*BASE_FEATURES, *ENGINEERED_FEATURES, *LAGS]
INTEGER_FEATURES = ("month", "is_summer", "is_winter")

SCORES = """per AS (
  SELECT series_id, horizon, avg(abs(y - p)) AS mae, avg((y - p) * (y - p)) AS mse, var_pop(y) AS v,
         avg(abs(y - p) / greatest(abs(y), 2.220446049250313e-16)) AS mape
  FROM long GROUP BY series_id, horizon),
scores AS (
  SELECT series_id, avg(mae) AS mae,
         avg(CASE WHEN v > 0 THEN 1 - mse / v WHEN mse = 0 THEN 1 ELSE 0 END) AS r2,
         sqrt(avg(mse)) AS rmse, avg(mape) AS mape
  FROM per GROUP BY series_id)"""


NEXT_ROWS = f"""{P_DAILY},
known AS (SELECT series_id, date, AQI FROM p_daily WHERE AQI IS NOT NULL),
ahead AS (SELECT *, {_shifts("AQI", 7, "lead", "AQI_day_{}", "w")} FROM known {W_SERIES}),
long AS ({" UNION ALL ".join(f"SELECT series_id, {i} AS horizon, AQI_day_{i} AS y, AQI AS p FROM ahead WHERE AQI_day_7 IS NOT NULL" for i in range(1, 8))}),
{SCORES}"""



def _fold(source: str, keys: str, order: str, cols, text=()) -> str:
    """Refresh average of each column over its known values in order."""
    ranked = _list(
        f"count({c}) OVER f AS _i_{c}, count({c}) OVER (PARTITION BY {keys}) AS _n_{c}" for c in cols
    )
    sums = _list(
        f"sum({c} * pow(0.5, _n_{c} - greatest(_i_{c}, 2) + 1)) AS {c}"
        for c in cols
    )
    firsts = "".join(f", arg_min({c}, _rn) FILTER (WHERE {c} IS NOT NULL) AS {c}" for c in text)
    return f"""SELECT {keys}, {sums}{firsts} FROM (
      SELECT *, row_number() OVER (PARTITION BY {keys} ORDER BY {order}) AS _rn, {ranked} FROM {source}
      WINDOW f AS (PARTITION BY {keys} ORDER BY {order} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))
      GROUP BY {keys}"""


def _forecasts(name: str, condition: str, label: str) -> str:
    return f"""{name} AS (
  SELECT series_id, date AS forecast_date, date + CAST(seq % 7 + 1 AS INTEGER) AS predicted_date,
         max(temp) AS predicted_aqi, '{label}' AS model_name, series_id AS location
  FROM w_obs WHERE {condition} GROUP BY series_id, date, date + CAST(seq % 7 + 1 AS INTEGER))"""


FORECASTS = f"""{WEATHER_OBS},
{_forecasts("early", "status <> 'P'", "early")},
{_forecasts("late", "status = 'P'", "late")},
both_f AS (SELECT *, 0 AS o FROM early UNION ALL SELECT *, 1 AS o FROM late),
forecasts AS (
  SELECT * EXCLUDE (o) FROM both_f
  QUALIFY row_number() OVER (PARTITION BY series_id, forecast_date, predicted_date ORDER BY o DESC) = 1)"""


def _evaluations(name: str, condition: str, hour: str) -> str:
    return f"""{name} AS (
  SELECT series_id, strftime(date, '%Y-%m-%d') || '{hour}' AS "timestamp", date AS eval_date,
         avg(temp) AS mae, max(humidity) AS r2, min(humidity) AS rmse, max(dew) / 64 AS mape
  FROM w_obs WHERE {condition} GROUP BY series_id, date)"""


EVALUATIONS = f"""{WEATHER_OBS},
{_evaluations("early", "status <> 'P'", "T06:05:00")},
{_evaluations("late", "status = 'P'", "T18:05:00")},
both_e AS (SELECT *, 0 AS o FROM early UNION ALL SELECT *, 1 AS o FROM late),
evaluations AS (
  SELECT * EXCLUDE (o) FROM both_e
  QUALIFY row_number() OVER (PARTITION BY series_id, eval_date ORDER BY o DESC) = 1),
stamped AS (
  SELECT * REPLACE (substr("timestamp", 1, 14) || lpad(series_id, 2, '0') || ':00' AS "timestamp") FROM evaluations)"""

FORECAST_OUT = "series_id, forecast_date, predicted_date, round(predicted_aqi, {}) AS predicted_aqi, model_name, location"


def _shown(col: str) -> str:
    return f"regexp_replace(CAST(CAST({col} AS DECIMAL(38, 3)) AS VARCHAR), '\\.?0+$', '')"


_FETCH_ORDER_P = "(seq * 8 + line) * 2000 + part % 2000"
REFRESHED = f"""{POLLUTANT_OBS},
{WEATHER_OBS},
p_scored AS (
  SELECT *, CASE WHEN flag = 'A' THEN 1 ELSE 2 END AS run, {_FETCH_ORDER_P} AS moment
  FROM ({_with_aqi("p_obs")})),
w_runs AS (SELECT *, CASE WHEN status = 'F' THEN 1 ELSE 2 END AS run FROM w_obs),
p_fold AS ({_fold("p_scored", "series_id, date", "run, moment", [*POLLUTANTS, "AQI"])}),
w_fold AS ({_fold("w_runs", "series_id, date", "run, seq", [c for c in CLEANED if c in WEATHER_NUMERIC])})
SELECT series_id, date, {_r([c for c in CLEANED if c != "date"])}
FROM w_fold JOIN p_fold USING (series_id, date)"""


REFRESHED_ALL = f"""{POLLUTANT_OBS},
{WEATHER_OBS},
p_scored AS (
  SELECT *, CASE WHEN flag = 'A' THEN 1 ELSE 2 END AS run, {_FETCH_ORDER_P} AS moment
  FROM ({_with_aqi("p_obs")})),
w_runs AS (SELECT *, CASE WHEN status = 'F' THEN 1 ELSE 2 END AS run FROM w_obs),
p_daily AS ({_fold("p_scored", "series_id, date", "run, moment", POLLUTANT_VALUES)}),
w_daily AS ({_fold("w_runs", "series_id, date", "run, seq", WEATHER_NUMERIC, WEATHER_TEXT)}),
raw AS (SELECT * FROM w_daily JOIN p_daily USING (series_id, date)),
clean AS (SELECT series_id, {_list(CLEANED)} FROM raw)"""


def _together(*more: str) -> str:
    """The four daily tables under each other by column name."""
    tables = {"weather_data": "w_daily", "pollutant_data": "p_daily", "raw_data": "raw", "cleaned_data": "clean"}
    rows = " UNION ALL BY NAME ".join(f"SELECT '{name}' AS stored_in, * FROM {source}" for name, source in tables.items())
    shown = ["stored_in", "series_id", "date", *more, _weather_out(), _r(POLLUTANT_VALUES)]
    return f"SELECT {_list(shown)} FROM ({rows})"


W_COLUMNS = ["series_id", "date", *WEATHER_COLUMNS]
W_SHOWN = f"""shown AS (SELECT series_id, strftime(date, '%Y-%m-%d') AS date, {_list(
    f"round({c}, 3) AS {c}" if c in WEATHER_NUMERIC else c for c in WEATHER_COLUMNS)} FROM w_daily)"""
W_TEXT = f"""concat_ws('|', {_list(_shown(c) if c in WEATHER_NUMERIC else c for c in W_COLUMNS)})"""

GROUP_MEANS = f"""{FEATURE_ROWS},
f2 AS (SELECT * FROM f1 WHERE {" AND ".join(f"{c} IS NOT NULL" for c in ["AQI", *FEATURE_COLUMNS])}),
f3 AS (SELECT *, {_shifts("AQI", 7, "lead", "AQI_day_{}", "w")} FROM f2 {W_SERIES}),
f4 AS (SELECT *, count(*) OVER (PARTITION BY series_id) AS n FROM f3 WHERE AQI_day_7 IS NOT NULL),
f5 AS (SELECT *, CASE WHEN row_number() OVER w > n - (n + 4) // 5 THEN 'test' ELSE 'train' END AS split
       FROM f4 {W_SERIES}),
days AS ({" UNION ALL ".join(f"SELECT series_id, is_summer, split, {i} AS horizon, AQI_day_{i} AS y FROM f5" for i in range(1, 8))}),
means AS (SELECT is_summer, horizon, avg(y) AS p FROM days WHERE split = 'train' GROUP BY is_summer, horizon)"""


ORACLE = {
    "aqi_daily": f"""WITH {P_DAILY}
SELECT series_id, date, round(AQI, 4) AS AQI,
       round(CASE WHEN count(AQI) OVER w = 7 THEN sum(AQI) OVER w END, 4) AS aqi_cum_sum_7
FROM p_daily
WINDOW w AS (PARTITION BY series_id ORDER BY date ROWS BETWEEN 6 PRECEDING AND CURRENT ROW)""",

    "sub_index_scaled": f"""WITH {P_MEANS}
SELECT series_id, date, {_r([*SUB_INDEXES, "AQI"])} FROM ({_with_aqi("p_means", scale=True)})""",

    "band_join_counts": f"""WITH {P_MEANS},
bands(pollutant, band_no, lo, hi) AS (VALUES {_list(
    f"('{p}', {i}, {lo}::DOUBLE, {hi}::DOUBLE)"
    for p in POLLUTANTS for i, (lo, hi) in enumerate(BANDS[p], 1))}),
long AS (SELECT * FROM p_means UNPIVOT INCLUDE NULLS (value FOR pollutant IN ({_list(POLLUTANTS)}))),
banded AS (
  SELECT l.series_id, l.date, l.pollutant, min(b.band_no) AS band_no
  FROM long l LEFT JOIN bands b ON l.pollutant = b.pollutant AND l.value BETWEEN b.lo AND b.hi
  GROUP BY ALL)
SELECT pollutant, band_no, count(*) AS n FROM banded GROUP BY pollutant, band_no""",

    "binned_bands": f"""WITH {POLLUTANT_OBS},
bands AS (
  SELECT pollutant, (l_orderkey * 8 + l_linenumber) * 100000 + l_suppkey AS band_no, floor(l_extendedprice * 7) % 67200 / 64 AS lo,
         lo + CASE WHEN l_orderkey % 997 = 0 THEN 100.0::DOUBLE ELSE (l_orderkey % 8) / 64.0::DOUBLE END AS hi
  FROM lineitem, (VALUES ('o3'), ('no2')) t(pollutant)),
long AS (SELECT * FROM (SELECT series_id, date, seq, line, part, supp, o3, no2 FROM p_obs)
         UNPIVOT INCLUDE NULLS (value FOR pollutant IN (o3, no2))),
looked_up AS (
  SELECT pollutant, value, min({{'band_no': band_no, 'lo': lo, 'hi': hi}}) AS band
  FROM (SELECT DISTINCT pollutant, value FROM long) v JOIN bands b USING (pollutant)
  WHERE value BETWEEN lo AND hi GROUP BY pollutant, value)
SELECT series_id, date, seq, line, part, supp, pollutant, round(value, 4) AS value, band.band_no AS band_no,
       round(band.lo, 4) AS lo, round(band.hi, 4) AS hi
FROM long LEFT JOIN looked_up USING (pollutant, value)""",

    "coerce_numeric_date": f"""WITH {HOURLY_OBS},
k AS (SELECT *, regexp_extract(props, '"k": *([0-9]+)', 1) AS kt FROM h_obs),
typed AS (
  SELECT seq,
         TRY_CAST(CASE WHEN seq % 5 = 0 THEN 'x' || kt WHEN seq % 7 = 0 THEN ''
                       WHEN seq % 2 = 0 THEN kt || '.5' ELSE kt END AS DOUBLE) AS k,
         TRY_CAST(CASE WHEN seq % 4 = 0 THEN 'bad' ELSE CAST(date AS VARCHAR) END AS DATE) AS day,
         CASE WHEN seq % 6 <> 0 THEN value END AS value
  FROM k)
SELECT seq, round(k, 4) AS k, day, strftime(day, '%Y-%m-%d') AS day_text, round(value, 4) AS value FROM typed""",

    "month_flags": f"""WITH {WEATHER_OBS}
SELECT DISTINCT series_id, date, CAST(month(date) AS INTEGER) AS month,
       CASE WHEN month(date) IN (6, 7, 8) THEN 1 ELSE 0 END AS is_summer,
       CASE WHEN month(date) IN (12, 1, 2) THEN 1 ELSE 0 END AS is_winter
FROM w_obs""",

    "timestamp_formats": f"""WITH {HOURLY_OBS}
SELECT seq, strftime(obs_ts, '%Y-%m-%d') AS day_text, strftime(obs_ts, '%Y-%m-%d %H:%M:%S') AS time_text,
       CAST(obs_ts - INTERVAL 330 MINUTE AS DATE) AS utc_day,
       strftime(obs_ts, '%-d/%-m/%Y, %H:%M') AS shown
FROM h_obs""",

    "interactions_rowsum": f"""WITH {P_DAILY}
SELECT series_id, date,
       round({" + ".join(f"coalesce({p}, 0)" for p in POLLUTANTS)}, 4) AS total_pollution,
       round(pm25 * co, 4) AS pm25_co, round(pm25 * no2, 4) AS pm25_no2, round(pm25 * so2, 4) AS pm25_so2
FROM p_daily""",

    "daily_mean_first": f"WITH {W_DAILY}\nSELECT series_id, date, {_weather_out()} FROM w_daily",

    "first_per_date": f"""WITH {WEATHER_OBS}
SELECT * FROM w_obs QUALIFY row_number() OVER (PARTITION BY series_id, date ORDER BY seq) = 1""",

    "latest_dates": f"""WITH {POLLUTANT_OBS}, {WEATHER_OBS}
SELECT 'pollutant' AS kind, max(date) AS date FROM p_obs
UNION ALL SELECT 'weather', max(date) FROM w_obs""",

    "refresh_average_recency": f"""WITH {HOURLY_OBS}
SELECT series_id, date, round(value, 4) AS value, note
FROM ({_fold("h_obs", "series_id, date", "obs_ts, seq", ["value"], ["note"])})""",

    "refresh_average_stored": f"""WITH {HOURLY_OBS},
stored AS (
  SELECT series_id, date, avg(value) AS value, arg_min(note, seq) FILTER (WHERE note IS NOT NULL) AS note
  FROM h_obs WHERE hour(obs_ts) < 12 GROUP BY series_id, date),
rows AS (
  SELECT series_id, date, 0 AS o, NULL::TIMESTAMP AS obs_ts, 0 AS seq, value, note FROM stored
  WHERE (series_id, date) IN (SELECT (series_id, date) FROM h_obs)
  UNION ALL SELECT series_id, date, 1, obs_ts, seq, value, note FROM h_obs WHERE hour(obs_ts) >= 12)
SELECT series_id, date, round(value, 4) AS value, note
FROM ({_fold("rows", "series_id, date", "o, obs_ts, seq", ["value"], ["note"])})""",

    "refresh_average_together": f"""WITH {HOURLY_OBS},
rows AS (
  SELECT series_id, date, avg(value) AS value FROM h_obs WHERE hour(obs_ts) < 12 GROUP BY series_id, date
  UNION ALL SELECT series_id, date, value FROM h_obs WHERE hour(obs_ts) >= 12)
SELECT series_id, date, round(avg(value), 4) AS value FROM rows GROUP BY series_id, date""",

    "refresh_average_true": f"""WITH {HOURLY_OBS}
SELECT series_id, date, round(avg(value), 4) AS value FROM h_obs GROUP BY series_id, date""",

    "interpolate_linear": f"""WITH {P_MEANS}
SELECT series_id, date, {_r(POLLUTANTS)} FROM ({_interpolated("p_means", POLLUTANTS, "date")})""",

    "backfill": f"""WITH {W_DAILY}
SELECT series_id, date, {_list(
    (f"round(first_value({c} IGNORE NULLS) OVER w, 4)" if c in WEATHER_NUMERIC
     else f"first_value({c} IGNORE NULLS) OVER w") + f" AS {c}"
    for c in ("dew", "windgust", "snowdepth", "conditions", "preciptype"))}
FROM w_daily
WINDOW w AS (PARTITION BY series_id ORDER BY date ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)""",

    "lags_7": f"""WITH {P_DAILY},
lagged AS (SELECT series_id, date, AQI, {_shifts("AQI", 7, "lag", "lag_{}_AQI", "w")} FROM p_daily {W_SERIES})
SELECT series_id, date, {_r(["AQI", *LAGS])} FROM lagged
WHERE {" AND ".join(f"{c} IS NOT NULL" for c in ["AQI", *LAGS])}""",

    "targets_7": f"""WITH {P_DAILY},
ahead AS (
  SELECT series_id, date, AQI, {_shifts("AQI", 7, "lead", "AQI_day_{}", "w")}
  FROM p_daily WHERE AQI IS NOT NULL {W_SERIES})
SELECT series_id, date, {_r(["AQI", *DAYS])} FROM ahead WHERE AQI_day_7 IS NOT NULL""",

    "rolling_7": f"""WITH {P_DAILY}
SELECT series_id, date, round(pm25, 4) AS pm25,
       round(CASE WHEN count(pm25) OVER w = 7 THEN sum(pm25) OVER w END, 4) AS pm25_cumulative_sum_7
FROM p_daily
WINDOW w AS (PARTITION BY series_id ORDER BY date ROWS BETWEEN 6 PRECEDING AND CURRENT ROW)""",

    "chrono_split": f"""WITH {P_DAILY}
SELECT series_id, date, round(AQI, 4) AS AQI,
       CASE WHEN row_number() OVER w > n - (n + 4) // 5 THEN 'test' ELSE 'train' END AS split
FROM (SELECT *, count(*) OVER (PARTITION BY series_id) AS n FROM p_daily) {W_SERIES}""",

    "last_row": f"""WITH {P_DAILY}
SELECT series_id, date, {_r(POLLUTANT_VALUES)} FROM p_daily
QUALIFY row_number() OVER (PARTITION BY series_id ORDER BY date DESC) = 1""",

    "lags_segmented": f"""WITH {HOURLY_OBS}
SELECT series_id, seq, round(value, 4) AS value,
       {_list(f"round(lag(value, {i}) OVER w, 4) AS lag_{i}_value" for i in range(1, 8))} FROM h_obs {W_TIMED}""",

    "lags_even_runs": f"""WITH {HOURLY_OBS}
SELECT series_id, seq, round(value, 4) AS value,
       {_list(f"round(lag(value, {i}) OVER w, 4) AS lag_{i}_value" for i in range(1, 8))} FROM h_obs {W_TIMED}""",

    "targets_segmented": f"""WITH {HOURLY_OBS}
SELECT series_id, seq, round(value, 4) AS value,
       {_list(f"round(lead(value, {i}) OVER w, 4) AS value_day_{i}" for i in range(1, 8))} FROM h_obs {W_TIMED}""",

    "rolling_segmented": f"""WITH {HOURLY_OBS}
SELECT series_id, seq, round(value, 4) AS value,
       round(CASE WHEN count(value) OVER w = 7 THEN sum(value) OVER w END, 4) AS value_sum_7
FROM h_obs
WINDOW w AS (PARTITION BY series_id ORDER BY obs_ts, seq ROWS BETWEEN 6 PRECEDING AND CURRENT ROW)""",

    "interpolate_segmented": f"""WITH {HOURLY_OBS}
SELECT series_id, seq, round(value, 4) AS value FROM ({_interpolated("h_obs", ["value"], "obs_ts, seq")})""",

    "backfill_segmented": f"""WITH {HOURLY_OBS}
SELECT series_id, seq, round(first_value(value IGNORE NULLS) OVER w, 4) AS value,
       first_value(note IGNORE NULLS) OVER w AS note
FROM h_obs
WINDOW w AS (PARTITION BY series_id ORDER BY obs_ts, seq ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)""",

    "split_segmented": f"""WITH {HOURLY_OBS}
SELECT series_id, seq, round(value, 4) AS value,
       CASE WHEN row_number() OVER w > n - (n + 4) // 5 THEN 'test' ELSE 'train' END AS split
FROM (SELECT *, count(*) OVER (PARTITION BY series_id) AS n FROM h_obs) {W_TIMED}""",

    "raw_join": f"WITH {RAW}\nSELECT series_id, date, {_weather_out()}, {_r(POLLUTANT_VALUES)} FROM raw",

    "cleaned_features": f"""WITH {CLEAN}
SELECT series_id, date, {_r([c for c in CLEANED if c != "date"])} FROM clean""",

    "clean_pollutant_rows": f"""WITH {POLLUTANT_OBS},
filled AS ({_interpolated("p_obs", POLLUTANTS, "date, seq, line, part, supp")})
SELECT series_id, date, seq, line, part, supp, {_r(POLLUTANT_VALUES)} FROM ({_with_aqi("filled")})""",

    "clean_weather_rows": f"""WITH {WEATHER_OBS},
once AS (SELECT * FROM w_obs QUALIFY row_number() OVER (PARTITION BY series_id, date ORDER BY seq) = 1),
filled AS ({_interpolated("once", WEATHER_NUMERIC, "date", backward=True)})
SELECT series_id, date, {_list(
    f"round({c}, 4) AS {c}" if c in WEATHER_NUMERIC
    else f"first_value({c} IGNORE NULLS) OVER w AS {c}"
    for c in WEATHER_COLUMNS)}
FROM filled
WINDOW w AS (PARTITION BY series_id ORDER BY date ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)""",

    "engineer_features_rows": f"""WITH {FEATURE_ROWS}
SELECT series_id, date, {_list(
    c if c in INTEGER_FEATURES else f"round({c}, 4) AS {c}" for c in ENGINEERED_FEATURES)} FROM f1""",

    "model_group_forecast": f"""WITH {GROUP_MEANS},
latest AS (SELECT series_id, is_summer FROM f2 QUALIFY row_number() OVER (PARTITION BY series_id ORDER BY date DESC) = 1)
SELECT series_id, DATE '2002-01-01' AS forecast_date, DATE '2002-01-01' + horizon AS predicted_date,
       round(p, 2) AS predicted_aqi, '{MODEL_NAME}' AS model_name, series_id AS location
FROM latest JOIN means USING (is_summer)""",

    "model_group_scores": f"""WITH {GROUP_MEANS},
long AS (SELECT series_id, horizon, y, p FROM days JOIN means USING (is_summer, horizon) WHERE split = 'test'),
{SCORES}
SELECT series_id, '2002-01-01T06:30:00' AS "timestamp", DATE '2002-01-01' AS eval_date,
       {_r(["mae", "r2", "rmse", "mape"])} FROM scores""",

    "training_rows": f"""WITH {FEATURE_ROWS},
f2 AS (SELECT * FROM f1 WHERE {" AND ".join(f"{c} IS NOT NULL" for c in ["AQI", *FEATURE_COLUMNS])}),
f3 AS (SELECT *, {_shifts("AQI", 7, "lead", "AQI_day_{}", "w")} FROM f2 {W_SERIES}),
f4 AS (SELECT *, count(*) OVER (PARTITION BY series_id) AS n FROM f3 WHERE AQI_day_7 IS NOT NULL)
SELECT series_id, date, {_list(
    c if c in INTEGER_FEATURES else f"round({c}, 4) AS {c}" for c in [*FEATURE_COLUMNS, *DAYS])},
       CASE WHEN row_number() OVER w > n - (n + 4) // 5 THEN 'test' ELSE 'train' END AS split
FROM f4 {W_SERIES}""",

    "metrics_persistence": f"""WITH {NEXT_ROWS}
SELECT series_id, {_r(["mae", "r2", "rmse", "mape"])} FROM scores""",

    "evaluation_rows": f"""WITH {NEXT_ROWS}
SELECT series_id, '2002-01-01T06:30:00' AS "timestamp", DATE '2002-01-01' AS eval_date,
       {_r(["mae", "r2", "rmse", "mape"])} FROM scores""",

    "forecast_long": f"""WITH {P_DAILY},
lagged AS (SELECT series_id, date, AQI, {_shifts("AQI", 7, "lag", "lag_{}_AQI", "w")} FROM p_daily {W_SERIES}),
newest AS (
  SELECT * FROM lagged WHERE {" AND ".join(f"{c} IS NOT NULL" for c in ["AQI", *LAGS])}
  QUALIFY row_number() OVER (PARTITION BY series_id ORDER BY date DESC) = 1)
{" UNION ALL ".join(
    f'''SELECT series_id, DATE '2002-01-01' AS forecast_date, DATE '2002-01-01' + {i} AS predicted_date,
round(lag_{i}_AQI, 2) AS predicted_aqi, 'XGBoost_V1' AS model_name, series_id AS location FROM newest'''
    for i in range(1, 8))}""",

    "upsert_forecast": f"WITH {FORECASTS}\nSELECT {FORECAST_OUT.format(4)} FROM forecasts",

    "upsert_eval": f"""WITH {EVALUATIONS}
SELECT series_id, "timestamp", eval_date, {_r(["mae", "r2", "rmse", "mape"])} FROM evaluations""",

    "upsert_by_date": f"""WITH {WEATHER_OBS},
old AS (SELECT series_id, date, avg(temp) AS temp FROM w_obs WHERE date <= DATE '1999-12-31' GROUP BY series_id, date),
new AS (SELECT series_id, date, max(temp) AS temp FROM w_obs WHERE date >= DATE '1998-01-01' GROUP BY series_id, date)
SELECT series_id, date, round(coalesce(new.temp, old.temp), 4) AS temp
FROM old FULL JOIN new USING (series_id, date)""",

    "concat_last_wins": f"""WITH {WEATHER_OBS},
old AS (SELECT series_id, date, max(temp) AS temp FROM w_obs WHERE status <> 'P' GROUP BY series_id, date),
new AS (SELECT series_id, date, max(humidity) AS humidity FROM w_obs WHERE status = 'P' GROUP BY series_id, date)
SELECT series_id, date, CASE WHEN new.humidity IS NULL THEN old.temp END AS temp, new.humidity AS humidity,
       CASE WHEN new.humidity IS NULL THEN 0 ELSE 1 END AS _order
FROM old FULL JOIN new USING (series_id, date)""",

    "latest_forecast": f"""WITH {FORECASTS}
SELECT {FORECAST_OUT.format(4)} FROM forecasts
WHERE forecast_date = (SELECT max(forecast_date) FROM forecasts)""",

    "latest_forecast_per_series": f"""WITH {FORECASTS}
SELECT {FORECAST_OUT.format(4)} FROM forecasts
QUALIFY forecast_date = max(forecast_date) OVER (PARTITION BY series_id)""",

    "forecast_chart": f"""WITH {FORECASTS}
SELECT series_id, predicted_date, round(predicted_aqi, 4) AS predicted_aqi, round(predicted_aqi, 0) AS label
FROM forecasts WHERE forecast_date = (SELECT max(forecast_date) FROM forecasts)""",

    "latest_evaluation": f"""WITH {EVALUATIONS}
SELECT series_id, "timestamp", eval_date, {_r(["mae", "r2", "rmse", "mape"])}
FROM stamped ORDER BY "timestamp" DESC LIMIT 1""",

    "newest_forecast": f"""WITH {FORECASTS}
SELECT {FORECAST_OUT.format(4)} FROM forecasts
WHERE forecast_date = (SELECT max(forecast_date) FROM forecasts)""",

    "newest_evaluation": f"""WITH {EVALUATIONS}
SELECT series_id, "timestamp", eval_date, {_r(["mae", "r2", "rmse", "mape"])}
FROM stamped ORDER BY "timestamp" DESC LIMIT 1""",

    "series_register": f"""WITH {CLEAN}
SELECT series_id, min(date) AS first_day, max(date) AS last_day FROM clean
WHERE year(date) <= 1995 OR CAST(series_id AS INTEGER) % 3 > 0 GROUP BY series_id""",

    "evaluation_card": f"""WITH {EVALUATIONS}
SELECT strftime(CAST("timestamp" AS TIMESTAMP), '%-d/%-m/%Y, %H:%M') AS created_at,
       {_r(["mae", "r2", "rmse"], 3)}, round(mape * 100, 3) AS mape
FROM (SELECT * FROM stamped ORDER BY "timestamp" DESC LIMIT 1)""",

    "browse_range": f"""WITH {CLEAN}
SELECT series_id, strftime(date, '%Y-%m-%d') AS date, {_r([c.lower() for c in CLEANED if c != "date"], 3)}
FROM clean WHERE date BETWEEN DATE '1996-03-01' AND DATE '1999-10-31'""",

    "browse_forecast": f"""WITH {FORECASTS}
SELECT series_id, strftime(forecast_date, '%Y-%m-%d') AS date, predicted_date,
       round(predicted_aqi, 3) AS predicted_aqi, model_name, location
FROM forecasts WHERE forecast_date >= DATE '1997-01-01'""",

    "browse_evaluation": f"""WITH {EVALUATIONS}
SELECT series_id, substr("timestamp", 1, 10) AS date, {_r(["mae", "rmse", "mape", "r2"], 3)}
FROM evaluations WHERE eval_date <= DATE '1999-06-30'""",

    "browse_search_all": f"""WITH {W_DAILY},
{W_SHOWN}
SELECT * FROM shown WHERE contains(lower({W_TEXT}), '1-u')""",

    "browse_search_column": f"""WITH {W_DAILY},
{W_SHOWN}
SELECT * FROM shown WHERE conditions IS NOT NULL""",

    "browse_search_number": f"""WITH {W_DAILY},
{W_SHOWN}
SELECT * FROM shown WHERE contains(lower({W_TEXT}), '12.5')""",

    "browse_named": f"""WITH {P_DAILY}
SELECT series_id, strftime(date, '%Y-%m-%d') AS "{DISPLAY_NAMES['date']}",
       {_list(f'round({c}, 3) AS "{DISPLAY_NAMES.get(c.lower(), c.lower())}"' for c in [*POLLUTANTS, *SUB_INDEXES, "AQI"])}
FROM p_daily WHERE date BETWEEN DATE '1998-01-01' AND DATE '1998-12-31'""",

    "current_conditions": f"""WITH {P_DAILY},
{W_DAILY},
now AS (
  SELECT * FROM w_daily WHERE date BETWEEN DATE '1995-01-01' AND DATE '2001-06-30'
  QUALIFY row_number() OVER (PARTITION BY series_id ORDER BY date DESC) = 1),
air AS (
  SELECT series_id, {_list([*POLLUTANTS, "AQI"])} FROM p_daily
  WHERE date BETWEEN DATE '1995-01-01' AND DATE '2001-06-30'
  QUALIFY row_number() OVER (PARTITION BY series_id ORDER BY date DESC) = 1)
SELECT series_id, date, name, conditions, sunrise, sunset, {_r([
    "temp", "feelslike", "tempmax", "tempmin", "windspeed", "windgust", "winddir", "precip", "precipprob",
    "snow", "snowdepth", "cloudcover", "visibility", "severerisk", "humidity", "dew", "sealevelpressure",
    "uvindex", "solarenergy", "solarradiation", "moonphase", *POLLUTANTS, "AQI"])}
FROM now LEFT JOIN air USING (series_id)""",

    "drop_null_columns": f"""WITH {W_DAILY}
SELECT series_id, date, {_list(
    f"round({c}, 4) AS {c}" if c in WEATHER_NUMERIC else c for c in WEATHER_COLUMNS if c != "severerisk")}
FROM w_daily""",

    "json_weather": f"""WITH {WEATHER_OBS}
SELECT series_id, date, {_list(
    "CASE WHEN humidity % 10 <> 0 THEN name ELSE 'Unknown' END AS name" if c == "name"
    else f"round({c}, 4) AS {c}" if c in WEATHER_NUMERIC else c for c in WEATHER_COLUMNS)}
FROM w_obs""",

    "json_pollutant": f"""WITH {POLLUTANT_OBS}
SELECT series_id, date, {_r(POLLUTANTS)}, {_list(f"NULL::DOUBLE AS {c}" for c in SUB_INDEXES)}, round(pm25, 4) AS AQI
FROM p_obs""",

    "csv_bootstrap": f"""WITH {CLEAN}
SELECT series_id, date, {_r([c for c in CLEANED if c != "date"])} FROM clean""",

    "bootstrap_targets": f"WITH {CLEAN}\n{_together('target')}, (VALUES ('main'), ('copy')) t(target)",
    "refresh_tables": f"WITH {REFRESHED_ALL}\n{_together()}",

    "records_json": f"""WITH {W_DAILY},
q AS (SELECT series_id, date, coalesce('"' || conditions || '"', 'null') AS c,
             coalesce('"' || preciptype || '"', 'null') AS p, icon FROM w_daily)
SELECT '{{"series_id":"' || series_id || '","date":"' || strftime(date, '%Y-%m-%d') || '","conditions":' || c
       || ',"icon":"' || icon || '","preciptype":' || p || '}}' AS record
FROM q""",

    "refresh_runs": f"WITH {REFRESHED}",
    "stream_refresh": f"WITH {REFRESHED}",

    "stream_daily": f"""WITH {HOURLY_OBS}
SELECT series_id, date, count(*) AS n, round(avg(value), 4) AS value FROM h_obs GROUP BY series_id, date""",

    "store_current": f"""WITH {FORECASTS}
SELECT series_id, strftime(forecast_date, '%Y-%m-%d') AS date, predicted_date,
       round(predicted_aqi, 3) AS predicted_aqi, model_name, location
FROM forecasts WHERE forecast_date BETWEEN DATE '1996-01-15' AND DATE '1999-12-31'""",
}
