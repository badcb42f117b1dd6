import json
from datetime import date, datetime, timedelta
from pathlib import Path

import pytest
from conftest import column

from airgrain.checks.queries import JSON_TIME, _land
from airgrain.operators.columns import conform
from airgrain.plans import refresh, register, views as Q
from airgrain.plans.model import load_or_train, model_version
from airgrain.plans.register import compact_registered, known_series
from airgrain.plans.refresh import bootstrap, daily_job, hourly_job, publish_forecast, refresh_daily, refreshed_tables
from airgrain.schemas import CLEANED, EVALUATION, FORECAST, POLLUTANT_DOCUMENT, RAW, TABLES, WEATHER, WEATHER_DOCUMENT
from airgrain.session import CLEANUP
from airgrain.sources.documents import pollutant_rows, read_pollutant, read_weather, weather_rows
from airgrain.sources.files import jdbc_options, read_csv_table, to_records, write_records
from airgrain.sources.store import Store, append_rows, compact, current, load_table, publish, replace_table, write_targets
from airgrain.streaming.hourly import run_refresh

D1, D2 = date(2025, 1, 1), date(2025, 1, 2)


@pytest.fixture
def store(spark, tmp_path):
    return Store(spark, str(tmp_path / "store"))


def forecasts(spark, *rows):
    return conform(spark.createDataFrame(list(rows), "series_id string, forecast_date date, predicted_date date, predicted_aqi double"), FORECAST)


def test_empty_store(store):
    assert current(store, "aqi_forecast").isEmpty()
    assert Q.latest_forecast(current(store, "aqi_forecast")).isEmpty()
    assert Q.latest_evaluation(current(store, "model_evaluation")).isEmpty()


def test_later_run_wins_and_ranges_prune(spark, store):
    publish({"aqi_forecast": forecasts(spark, ("s", D1, D2, 1.0), ("t", D1, D2, 5.0))}, store, "0001")
    publish({"aqi_forecast": forecasts(spark, ("s", D1, D2, 2.0), ("s", D2, D2, 3.0))}, store, "0002")
    assert column(current(store, "aqi_forecast"), "predicted_aqi", "predicted_aqi") == [2, 3, 5]
    assert [r["predicted_aqi"] for r in current(store, "aqi_forecast", D2, D2).collect()] == [3]
    compact(store, "aqi_forecast", "0003")
    assert len(store.runs("aqi_forecast")) == 1
    publish({"aqi_forecast": forecasts(spark, ("t", D1, D2, 9.0))}, store, "0004")
    assert column(current(store, "aqi_forecast"), "predicted_aqi", "predicted_aqi") == [2, 3, 9]
    assert column(load_table(spark, store, "aqi_forecast"), "predicted_aqi", "predicted_aqi") == [2, 3, 9]
    replace_table(forecasts(spark, ("u", D1, D2, 7.0)), store, "aqi_forecast", "0005")
    assert column(current(store, "aqi_forecast"), "series_id", "series_id") == ["u"]


def test_a_run_without_commit_is_invisible(spark, store):
    publish({"aqi_forecast": forecasts(spark, ("s", D1, D2, 1.0))}, store, "0001")
    append_rows(forecasts(spark, ("s", D1, D2, 2.0)), store, "aqi_forecast", "0002")
    assert [r["predicted_aqi"] for r in current(store, "aqi_forecast").collect()] == [1]


def test_a_failing_table_hides_the_whole_run(spark, store):
    good = forecasts(spark, ("s", D1, D2, 1.0))
    bad = good.selectExpr("series_id", "cast('x' as date) as forecast_date", "predicted_date")
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        publish({"aqi_forecast": good, "model_evaluation": bad.selectExpr("series_id", "forecast_date as eval_date")}, store, "0001")
    assert current(store, "aqi_forecast").isEmpty()


def test_a_committed_run_is_skipped(spark, store):
    rows = forecasts(spark, ("s", D1, D2, 1.0))
    assert publish({"aqi_forecast": rows}, store, "0001")
    assert not publish({"aqi_forecast": rows}, store, "0001")


def test_commit_order_counts_not_the_run_ids(spark, store):
    for value, run in enumerate(("stream-000000000000", "2026-01-01T06", "0001")):
        publish({"aqi_forecast": forecasts(spark, ("s", D1, D2, float(value)))}, store, run)
    assert column(current(store, "aqi_forecast"), "predicted_aqi", "predicted_aqi") == [2]
    compact(store, "aqi_forecast", "0000-base")
    assert store.runs("aqi_forecast") == [("0000-base", "base")]
    publish({"aqi_forecast": forecasts(spark, ("s", D1, D2, 9.0))}, store, "000")
    assert column(current(store, "aqi_forecast"), "predicted_aqi", "predicted_aqi") == [9]


def test_repeated_keys_in_a_run_do_not_depend_on_other_runs(spark, store):
    twice = forecasts(spark, ("s", D1, D2, 1.0), ("s", D1, D2, 3.0), ("s", D1, D2, 2.0))
    publish({"aqi_forecast": twice}, store, "0001")
    (kept,) = column(current(store, "aqi_forecast"), "predicted_aqi", "predicted_aqi")
    publish({"aqi_forecast": forecasts(spark, ("t", D1, D2, 0.0))}, store, "0002")
    assert column(current(store, "aqi_forecast"), "predicted_aqi", "predicted_aqi") == [0, kept]


def test_a_committed_id_is_not_written_again(spark, store):
    rows = forecasts(spark, ("s", D1, D2, 1.0))
    publish({"aqi_forecast": rows}, store, "0001")
    for again in (
        lambda: compact(store, "aqi_forecast", "0001"),
        lambda: replace_table(rows, store, "aqi_forecast", "0001"),
        lambda: write_targets({"aqi_forecast": rows}, {"a": {"kind": "store", "store": store}}, "0001"),
        lambda: publish({"model_evaluation": rows}, store, "0001"),
    ):
        with pytest.raises(ValueError, match="committed already"):
            again()
    assert current(store, "aqi_forecast").count() == 1


def test_single_periods_are_read(spark, store):
    later = date(2025, 3, 1)
    publish({"aqi_forecast": forecasts(spark, ("s", D1, D2, 1.0), ("s", later, later, 2.0))}, store, "0001")
    assert column(current(store, "aqi_forecast", periods=["2025-03"]), "predicted_aqi", "predicted_aqi") == [2]


def test_the_newest_period_alone_is_read(spark, store):
    """A hundred months in two runs and a compaction; of the newest one all rows, of the others no file."""
    months = [date(2017 + m // 12, m % 12 + 1, 1) for m in range(100)]
    rows = [("s%d" % k, day, day + timedelta(days=k), float(k)) for day in months for k in range(2)]
    assert store.periods("aqi_forecast") == [] and Q.newest_forecast(store).isEmpty() and Q.newest_evaluation(store).isEmpty()
    publish({"aqi_forecast": forecasts(spark, *rows)}, store, "0001")
    compact(store, "aqi_forecast", "0002")
    newest = months[-1]
    publish({"aqi_forecast": forecasts(spark, ("s0", newest, newest, 9.0), ("s9", None, newest, 1.0), ("s1", months[3], months[3], 4.0))}, store, "0003")
    assert store.periods("aqi_forecast")[:2] == ["2025-04", "2025-03"] and len(store.periods("aqi_forecast")) == 100
    got = Q.newest_forecast(store)
    assert [(r.series_id, r.forecast_date, r.predicted_aqi) for r in got.collect()] == [("s0", newest, 9.0), ("s1", newest, 1.0)]
    assert [*map(tuple, got.collect())] == [*map(tuple, Q.latest_forecast(current(store, "aqi_forecast")).collect())]
    # the names of periods are folders, so a filter on them leaves the files of all others unread
    plan = current(store, "aqi_forecast", periods=["2025-04"])._jdf.queryExecution().executedPlan().toString()
    scans = [line for line in plan.splitlines() if "FileScan parquet" in line]
    assert scans and all("PartitionFilters: [isnotnull(_period" in s and "= 2025-04" in s for s in scans)


def test_a_table_without_dates_has_no_newest_row(spark, store):
    publish({"aqi_forecast": forecasts(spark, ("s9", None, D2, 1.0))}, store, "0001")
    assert store.periods("aqi_forecast") == [] and Q.newest_forecast(store).isEmpty()


def cleaned(spark, *rows):
    return conform(spark.createDataFrame(list(rows), "series_id string, date date, pm25 double"), TABLES["cleaned_data"])


def registered(store):
    return sorted(map(tuple, known_series(store).collect()))


def test_register_follows_the_runs(spark, store, monkeypatch):
    """Each run is read once for its entry; a compaction merges the entries, a replaced table starts anew."""
    reads = []
    whole = register.runs_of
    monkeypatch.setattr(register, "runs_of", lambda s, t, runs: reads.extend(runs) or whole(s, t, runs))
    assert registered(store) == []
    d3 = date(2025, 3, 1)
    publish({"cleaned_data": cleaned(spark, ("a", D2, 1.0), ("b", D1, 1.0))}, store, "0001")
    publish({"cleaned_data": cleaned(spark, ("a", D1, 1.0), ("c", d3, 1.0), ("n", None, 1.0))}, store, "0002")
    both = [("a", D1, D2), ("b", D1, D1), ("c", d3, d3), ("n", None, None)]
    assert registered(store) == both and reads == ["0001", "0002"]
    assert registered(store) == both and reads == ["0001", "0002"]
    compact_registered(store, "cleaned_data", "0003")
    assert registered(store) == both and reads == ["0001", "0002"]
    publish({"cleaned_data": cleaned(spark, ("a", d3, 1.0)).where("false")}, store, "0004")
    publish({"cleaned_data": cleaned(spark, ("a", d3, 2.0))}, store, "0005")
    assert registered(store) == [("a", D1, d3), *both[1:]] and reads == ["0001", "0002", "0004", "0005"]
    replace_table(cleaned(spark, ("z", D1, 1.0)), store, "cleaned_data", "0006")
    assert registered(store) == [("z", D1, D1)]


def test_an_entry_that_was_not_finished_is_written_again(spark, store, tmp_path):
    publish({"cleaned_data": cleaned(spark, ("a", D1, 1.0))}, store, "0001")
    half = tmp_path / "store" / "_series" / "cleaned_data" / "run_id=0001"
    half.mkdir(parents=True)
    assert register.unregistered(store, "cleaned_data") == ["0001"] and registered(store) == [("a", D1, D1)]
    assert register.unregistered(store, "cleaned_data") == []


def test_unknown_table(store):
    with pytest.raises(ValueError, match="may not be read"):
        Q.browse(store, "passwords")


def day(name, **values):
    return {"datetime": name, **values}


def weather_document(spark, *docs):
    return spark.createDataFrame([{"series_id": "s", "fetched_at": datetime(2025, 1, 1, 1), **d} for d in docs], WEATHER_DOCUMENT)


def test_weather_documents(spark, tmp_path):
    docs = weather_document(
        spark,
        {"resolvedAddress": "Here", "days": [day("2025-01-01", temp=1.0, preciptype=["rain", "snow"]), day("2025-01-02", preciptype=[])]},
        {"days": [day("bad", stations=["A"])]},
        {"resolvedAddress": "No days"},
        {"resolvedAddress": "Empty", "days": []},
    )
    docs.write.json(str(tmp_path / "w"))
    rows = read_weather(spark, str(tmp_path / "w")).orderBy("name", "date").collect()
    assert [(r["name"], r["date"], r["temp"], r["preciptype"], r["stations"]) for r in rows] == [
        ("Here", D1, 1.0, "rain,snow", None), ("Here", D2, None, None, None), ("Unknown", None, None, None, "A"),
    ]
    assert [c for c in rows[0].asDict() if c != "fetched_at"] == WEATHER.names


def test_pollutant_documents(spark, tmp_path):
    lines = [
        '{"series_id":"s","fetched_at":"2025-01-01T20:00:00Z","data":{"aqi":9,"iaqi":{"pm25":{"v":1.5},"co":{"v":2}}}}',
        '{"series_id":"s","data":{"aqi":9}}',
        '{"series_id":"s"}',
    ]
    (tmp_path / "p").mkdir()
    (tmp_path / "p" / "a.json").write_text("\n".join(lines))
    rows = read_pollutant(spark, str(tmp_path / "p"), as_of=D1).collect()
    # 20:00 UTC is the next morning at the site
    assert [(r["date"], r["pm25"], r["co"], r["o3"], r["AQI"], r["AQI_co"]) for r in rows] == [
        (D2, 1.5, 2.0, None, 9.0, None), (D1, None, None, None, 9.0, None), (D1, None, None, None, None, None),
    ]


def fetch(spark, hour, temp, pm25, d="2025-01-01"):
    at = datetime.fromisoformat(d).replace(hour=hour)
    weather = spark.createDataFrame(
        [{"series_id": "s", "fetched_at": at, "resolvedAddress": f"h{hour}", "days": [day(d, temp=temp, conditions=f"c{hour}")]}],
        WEATHER_DOCUMENT,
    )
    air = spark.createDataFrame(
        [{"series_id": "s", "fetched_at": at, "data": {"aqi": 1.0, "iaqi": {"pm25": {"v": pm25}}}}], POLLUTANT_DOCUMENT
    )
    return weather, air


def test_refresh_run_by_run(spark, store):
    for hour, temp, pm25 in ((1, 10.0, 20.0), (2, 20.0, 40.0), (3, 30.0, None)):
        weather, air = fetch(spark, hour, temp, pm25)
        assert refresh_daily(weather_rows(weather), pollutant_rows(air, None, "UTC"), store, f"{hour:04d}")
    weather, air = fetch(spark, 3, 30.0, None)
    assert not refresh_daily(weather_rows(weather), pollutant_rows(air, None, "UTC"), store, "0003")
    (clean,) = current(store, "cleaned_data").collect()
    assert (clean["temp"], clean["pm25"], clean["AQI"]) == (22.5, 30.0, 30.0)
    (raw,) = current(store, "raw_data").collect()
    assert (raw["name"], raw["conditions"], raw["AQI_pm25"], raw["o3"]) == ("h1", "c1", 30.0, None)
    assert raw.asDict().keys() == set(RAW.names)
    # a pollutant fetch alone joins the stored weather of its day
    _, air = fetch(spark, 4, None, 50.0)
    refresh_daily(weather_rows(spark.createDataFrame([], WEATHER_DOCUMENT)), pollutant_rows(air, None, "UTC"), store, "0004")
    (clean,) = current(store, "cleaned_data").collect()
    assert (clean["temp"], clean["pm25"]) == (22.5, 40.0)


def test_streamed_refresh_equals_the_runs(spark, store, tmp_path):
    landing = tmp_path / "landing"
    for hour, temp, pm25 in ((1, 10.0, 20.0), (2, 20.0, 40.0), (3, 30.0, None)):
        weather, air = fetch(spark, hour, temp, pm25)
        weather.write.mode("append").json(str(landing / "weather"))
        air.write.mode("append").json(str(landing / "pollutant"))
        if hour != 2:  # the second and third fetch arrive in one batch
            run_refresh(spark, str(landing), store, str(tmp_path / "cp"), time_zone="UTC").awaitTermination()
    (clean,) = current(store, "cleaned_data").collect()
    assert (clean["temp"], clean["pm25"], clean["AQI"]) == (22.5, 30.0, 30.0)
    assert len(store.runs("cleaned_data")) == 2


def test_fetches_of_several_days_are_averaged_day_by_day(spark, store):
    """Each fetch fills its own gaps; the days of an hour's fetches are then folded in the order of fetching."""
    days = ("2025-01-01", "2025-01-02", "2025-01-03")
    fetches = [(datetime(2025, 1, 1, 5, 10), (None, 8.0, None)), (datetime(2025, 1, 1, 5, 20), (10.0, None, 30.0)), (datetime(2025, 1, 2, 7), (4.0, 12.0, None))]
    docs = [{"fetched_at": at, "days": [day(d, temp=t) for d, t in zip(days, temps, strict=True)]} for at, temps in fetches]
    air = spark.createDataFrame([], POLLUTANT_DOCUMENT)
    for run, some in (("0001", docs[:2]), ("0002", docs[2:])):
        refresh_daily(weather_rows(weather_document(spark, *some)), pollutant_rows(air, None, "UTC"), store, run)
    assert column(current(store, "weather_data"), "temp") == [((8 + 10) / 2 + 4) / 2, ((8 + 20) / 2 + 12) / 2, ((8 + 30) / 2 + 12) / 2]


@pytest.mark.parametrize("table", ["weather_data", "pollutant_data"])
def test_rows_of_a_batch_are_shuffled_once(spark, table):
    weather, air = fetch(spark, 1, 10.0, 20.0)
    tables = refreshed_tables(weather_rows(weather), pollutant_rows(air, None, "UTC"))
    plan = tables[table]._jdf.queryExecution().executedPlan().toString()
    # one shuffle of the rows, one of the runs' sums
    assert plan.count("Exchange hashpartitioning") == 2
    # what is computed from the rows does not travel with them
    moved = [line for line in plan.split("\n") if "Exchange hashpartitioning" in line][-1]
    assert "_segment" in moved and "AQI_pm25" not in plan[plan.rindex("Exchange hashpartitioning"):]


def disk_files(spark, prefix):
    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return {f.getName() for f in (files.apply(i) for i in range(files.size())) if f.getName().startswith(prefix)}


def test_a_batch_leaves_no_rows_on_disk(spark, store, monkeypatch):
    weather, air = fetch(spark, 1, 10.0, 20.0)
    seen = []

    def merge(weather, pollutant, *args):
        seen.append((disk_files(spark, "shuffle_") - before, [f.name for f in Path(store.path("_batches", "0001")).iterdir()]))
        return merged(weather, pollutant, *args)

    merged = refresh._merge_batch
    monkeypatch.setattr(refresh, "_merge_batch", merge)
    setting = spark.conf.get(CLEANUP, None)
    before = disk_files(spark, "shuffle_")
    assert refresh_daily(weather_rows(weather), pollutant_rows(air, None, "UTC"), store, "0001")
    (files, kept), = seen
    assert not files and sorted(kept) == ["pollutant", "weather"]
    assert not store.exists("_batches", "0001") and spark.conf.get(CLEANUP, None) == setting


def test_landed_documents_are_packed(spark, tmp_path):
    weather, _ = fetch(spark, 1, 10.0, 20.0)
    documents = weather.crossJoin(spark.range(2000)).drop("id").coalesce(1)
    _land(documents, str(tmp_path / "packed"))
    documents.write.options(**JSON_TIME).json(str(tmp_path / "plain"))
    size = {kind: sum(f.stat().st_size for f in (tmp_path / kind).glob("part-*")) for kind in ("packed", "plain")}
    assert size["packed"] * 4 < size["plain"]
    packed, plain = (read_weather(spark, str(tmp_path / kind)) for kind in ("packed", "plain"))
    assert packed.count() == 2000 and packed.exceptAll(plain).isEmpty()


AIR = {"fetched_at": "2025-01-01T01:00:00Z", "data": {"aqi": 1.0, "iaqi": {"pm25": {"v": 20.0}}}}
SKY = {"fetched_at": "2025-01-01T01:00:00Z", "days": [{"datetime": "2025-01-01", "temp": 10.0}]}


def land(landing, folder, document, indent=None):
    (landing / folder).mkdir(parents=True, exist_ok=True)
    (landing / folder / "a.json").write_text(json.dumps(document, indent=indent) + "\n\n")


@pytest.mark.parametrize("indent", [None, 2])
@pytest.mark.parametrize("name", ["landing", "landing zone + é%20"])
def test_streamed_documents_in_series_folders(spark, store, tmp_path, name, indent):
    landing = tmp_path / name
    land(landing, "weather/series_id=a b", SKY, indent)
    land(landing, "pollutant/series_id=a b", AIR, indent)
    land(landing, "pollutant/series_id=x", {**AIR, "series_id": "own"}, indent)
    run_refresh(spark, str(landing), store, str(tmp_path / "cp"), time_zone="UTC", multi_line=indent is not None).awaitTermination()
    (clean,) = current(store, "cleaned_data").collect()
    assert (clean["series_id"], clean["temp"], clean["pm25"]) == ("a b", 10.0, 20.0)
    assert column(current(store, "pollutant_data"), "series_id", "series_id") == ["a b", "own"]


def test_streams_of_other_checkpoints_do_not_share_run_ids(spark, store, tmp_path):
    for n, name in enumerate(("one", "two")):
        land(tmp_path / name, "weather", {**SKY, "series_id": name})
        land(tmp_path / name, "pollutant", {**AIR, "series_id": name})
        run_refresh(spark, str(tmp_path / name), store, str(tmp_path / f"cp-{name}"), time_zone="UTC").awaitTermination()
    assert column(current(store, "cleaned_data"), "series_id", "series_id") == ["one", "two"]


def test_unreadable_documents_raise(spark, store, tmp_path):
    land(tmp_path / "l", "weather/series_id=s", SKY, 2)  # several lines read one by one
    with pytest.raises(Exception, match="unreadable document"):
        run_refresh(spark, str(tmp_path / "l"), store, str(tmp_path / "cp")).awaitTermination()
    assert not store.exists("_commits")
    with pytest.raises(Exception, match="unreadable document"):
        read_weather(spark, str(tmp_path / "l" / "weather")).collect()
    (row,) = read_weather(spark, str(tmp_path / "l" / "weather"), multi_line=True).collect()
    assert (row["series_id"], row["temp"]) == ("s", 10.0)


def test_a_field_of_the_wrong_type_is_null(spark, tmp_path):
    land(tmp_path, "p", {**AIR, "series_id": "s", "data": {"aqi": "-", "iaqi": {"pm25": {"v": 20.0}}}})
    (row,) = read_pollutant(spark, str(tmp_path / "p"), time_zone="UTC").collect()
    assert (row["series_id"], row["date"], row["AQI"]) == ("s", D1, None)


FEW = {"maxIter": 1, "maxDepth": 1, "partitions": 1}


def history(spark, days=40, series=("s",)):
    rows = [
        {"series_id": s, "date": D1 + timedelta(days=i), **{c: float(i % 7 + 1) for c in CLEANED if c not in ("series_id", "date")}}
        for s in series for i in range(days)
    ]
    return conform(spark.createDataFrame(rows), TABLES["cleaned_data"])


def test_hourly_job_trains_scores_and_forecasts(spark, store):
    publish({"cleaned_data": history(spark)}, store, "0001")
    weather, air = fetch(spark, 1, 5.0, 20.0, "2025-02-10")
    args = (weather_rows(weather), pollutant_rows(air, None, "UTC"), store, date(2025, 2, 10))
    rows = hourly_job(spark, *args, "2025-02-10T01", "2025-02-10T01:00:00", lookback_days=30, **FEW)
    assert rows.count() == 7
    assert current(store, "model_evaluation").count() == 1
    # a repeated daily run neither trains again nor replaces the model
    for _ in range(2):
        daily_job(store, "2025-02-11T00:00:00", "2025-02-11", compact_after=1, **FEW)
        assert model_version(spark, store.path("model")) == 2
    assert [kind for _, kind in store.runs("cleaned_data")] == ["base"]
    assert current(store, "model_evaluation").count() == 2


def test_a_series_without_forecast_is_an_error(spark, store):
    publish({"cleaned_data": history(spark).unionByName(history(spark, 3, ("short",)))}, store, "0001")
    model = load_or_train(spark, store, "2025-02-10T01:00:00", **FEW)
    with pytest.raises(ValueError, match="no forecast for .*short"):
        publish_forecast(store, model, date(2025, 2, 10), "0002")


def test_csv(spark, tmp_path):
    (tmp_path / "w.csv").write_text('series_id,date, temp ,humidity,name\ns,2025-01-01,1.5,x,A\ns,bad,2,3,B\ns,2025-01-01,4,5,\n')
    rows = read_csv_table(spark, str(tmp_path / "w.csv"), WEATHER).collect()
    assert [(r["date"], r["temp"], r["humidity"], r["name"], r["dew"]) for r in rows] == [
        (D1, 1.5, None, "A", None), (None, 2.0, 3.0, "B", None), (D1, 4.0, 5.0, None, None),
    ]


def test_bootstrap_multiplies_duplicate_days(spark, store, tmp_path):
    (tmp_path / "w.csv").write_text("series_id,date,temp\ns,2025-01-01,1\ns,2025-01-01,2\ns,bad,3\ns,2025-01-03,4\n")
    (tmp_path / "p.csv").write_text("series_id,date,pm25,AQI\ns,2025-01-01,7,77\ns,bad,8,88\n")
    targets = {
        "a": {"kind": "store", "store": store},
        "b": {"kind": "csv", "path": str(tmp_path / "out"), "names": {"raw_data": "RawData"}},
        "c": {"kind": "parquet", "path": str(tmp_path / "off"), "enabled": False},
    }
    bootstrap(spark, str(tmp_path / "w.csv"), str(tmp_path / "p.csv"), targets, "0001")
    rows = current(store, "cleaned_data").orderBy("temp").collect()
    assert [(r["temp"], r["pm25"], r["AQI"]) for r in rows] == [(1, 7, 77), (2, 7, 77)]
    assert set(CLEANED) < set(rows[0].asDict())
    assert current(store, "weather_data").count() == 4
    assert read_csv_table(spark, str(tmp_path / "out" / "RawData"), RAW).count() == 2
    assert not (tmp_path / "off").exists()


def test_records_keep_nulls(spark, tmp_path):
    df = spark.createDataFrame([(1, None, float("nan"))], "a int, b string, c double")
    assert to_records(df).first()[0] == '{"a":1,"b":null,"c":null}'
    write_records(df, str(tmp_path / "r"))
    assert spark.read.text(str(tmp_path / "r")).first()[0] == '{"a":1,"b":null,"c":null}'


def test_jdbc_options():
    got = jdbc_options("jdbc:x", "t", "date", D1, D2, 4, {"user": "u"})
    assert got == {
        "url": "jdbc:x", "dbtable": "t", "user": "u", "partitionColumn": "date",
        "lowerBound": "2025-01-01", "upperBound": "2025-01-02", "numPartitions": "4",
    }


def test_evaluation_names():
    assert EVALUATION.names == ["series_id", "timestamp", "eval_date", "mae", "r2", "rmse", "mape"]
