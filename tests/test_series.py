import json
from datetime import datetime, timedelta

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from gridtide.operators import timeseries as TS
from gridtide.operators import weather as W
from gridtide.plans import tables as T
from gridtide.sources import feeds, landing

SERIES = "region_id string, timestamp timestamp, demand_mw double, temperature_f double"
START = datetime(2024, 1, 1)


def brute(rows, seconds):
    out = []
    for region, at, *_ in rows:
        if at is None:
            frame = [v for r, t, v, _ in rows if r == region and t is None]
        else:
            low = at.replace(microsecond=0) - timedelta(seconds=seconds)
            high = at.replace(microsecond=0) + timedelta(seconds=1)
            frame = [v for r, t, v, _ in rows if r == region and t is not None and low <= t < high]
        frame = [v for v in frame if v is not None]
        out.append(sum(frame) / len(frame) if frame else None)
    return out


def skewed_rows(n=700):
    """Most rows in one region, a third of them at one instant, with gaps and NULLs."""
    rng = np.random.default_rng(3)
    rows = []
    for i in range(n):
        region = "hot" if i % 4 else ["a", "b", None][i % 3]
        at = START + timedelta(seconds=int(rng.integers(0, 60 * 86400)))
        if i % 3 == 0:
            at = START + timedelta(days=20, seconds=5, microseconds=i)
        if i % 29 == 0:
            at = None
        value = None if i % 11 == 0 else round(float(rng.uniform(1, 99)), 3)
        rows.append((region, at, value, 1.0))
    return rows


def test_trailing_averages_match_brute_force(spark):
    rows = skewed_rows()
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "id int, " + SERIES)
    spans = {"d7": 7 * 86400, "d30": 30 * 86400}
    got = TS.trailing_averages(df, "region_id", "timestamp", "demand_mw", spans).orderBy("id").collect()
    assert [r["id"] for r in got] == list(range(len(rows)))
    for name, seconds in spans.items():
        assert [r[name] for r in got] == pytest.approx(brute(rows, seconds), abs=1e-9)


def test_week_of_hours_has_169_readings(spark):
    rows = [("r", START + timedelta(hours=h), float(h), None) for h in range(400)]
    out = TS.demand_timeseries(spark.createDataFrame(rows, SERIES)).orderBy("timestamp").collect()
    assert out[399]["demand_7d_avg_mw"] == pytest.approx(np.mean(range(231, 400)))
    assert out[399]["demand_anomaly_mw"] == pytest.approx(399 - np.mean(range(400)))
    assert out[0]["demand_30d_avg_mw"] == 0.0


def test_rolling_deviation_is_strict(spark):
    rows = [("r", START, 100.0, None), ("r", START + timedelta(hours=1), 100.0, None),
            ("r", START + timedelta(hours=300), 90.0, None), ("r", START + timedelta(hours=301), 160.0, None)]
    got = TS.rolling_deviation(spark.createDataFrame(rows, SERIES)).collect()
    assert [(r["demand_mw"], r["severity"]) for r in got] == [(160.0, "HIGH")]


@pytest.mark.parametrize("depth", [1, 2])
def test_previous_values_match_pandas(spark, depth):
    rng = np.random.default_rng(5)
    rows = [(i, "hot" if i % 3 else str(i % 5), START + timedelta(minutes=int(rng.integers(0, 9000))),
             float(rng.integers(0, 50))) for i in range(500)]
    df = spark.createDataFrame(rows, "id int, k string, t timestamp, v double")
    got = TS.with_previous(df, "k", "t", {f"p{d}": ("v", d) for d in range(1, depth + 1)}, ("id",))
    got = got.toPandas().sort_values("id").reset_index(drop=True)
    want = pd.DataFrame(rows, columns=["id", "k", "t", "v"]).sort_values(["k", "t", "id"])
    for d in range(1, depth + 1):
        want[f"p{d}"] = want.groupby("k")["v"].shift(d)
        expected = want.sort_values("id")[f"p{d}"].to_numpy()
        np.testing.assert_array_equal(got[f"p{d}"].astype(float).to_numpy(), expected)


@pytest.mark.parametrize("buckets", [(3600, 1), (3600, 60), (60, 60)])
def test_previous_values_in_a_hot_hour(spark, buckets):
    rng = np.random.default_rng(6)
    # nine of ten rows in one hour of one key, some without a time
    rows = [(i, "k", START + timedelta(seconds=float(rng.uniform(0, 3600))), float(i)) for i in range(900)]
    rows += [(i, "k", START + timedelta(hours=int(rng.integers(-9, 9))), float(i)) for i in range(900, 995)]
    rows += [(i, "k", None, float(i)) for i in range(995, 1000)]
    df = spark.createDataFrame(rows, "id int, k string, t timestamp, v double")
    got = TS.with_previous(df, "k", "t", {"p1": ("v", 1), "p3": ("v", 3)}, ("id",), buckets)
    got = got.toPandas().sort_values("id")
    want = pd.DataFrame(rows, columns=["id", "k", "t", "v"]).sort_values(["t", "id"], na_position="first")
    for d in (1, 3):
        np.testing.assert_array_equal(got[f"p{d}"], want["v"].shift(d).loc[got["id"]].to_numpy())


def test_windows_over_raw_rows_see_one_second(spark):
    df = spark.createDataFrame([(1, "k", START, 1.0)], "id int, k string, t timestamp, v double")
    plan = TS.change_rate(df, "k", "t", "v", ("id",))._jdf.queryExecution().optimizedPlan().toString()
    lines = [line for line in plan.splitlines() if "Window [" in line]
    # windows over raw rows go by second (the tails are read by both levels); those of an
    # hour and of a key see tails only
    by_second = sum("_b#" in line.rsplit("], [", 2)[-2] for line in lines)
    assert (by_second, len(lines)) == (3, 6)


def test_change_and_acceleration(spark):
    rows = [("n", START + timedelta(minutes=m), v) for m, v in ((0, 1.0), (30, 4.0), (90, 10.0), (200, 9.0))]
    df = spark.createDataFrame(rows, "k string, t timestamp, v double")
    change = TS.change_rate(df, "k", "t", "v").orderBy("t").collect()
    assert [r["change"] for r in change] == [None, 3.0, 6.0, -1.0]
    assert change[1]["change_per_hour"] == pytest.approx(6.0)
    fast = TS.acceleration(df, "k", "t", "v").orderBy("t").collect()
    assert [r["acceleration"] for r in fast] == [None, None, 3.0, -7.0]


def test_no_window_orders_a_whole_region_of_readings(spark):
    df = spark.createDataFrame(skewed_rows(20), SERIES)
    plan = TS.demand_timeseries(df)._jdf.queryExecution().optimizedPlan().toString()
    # the only window over a region alone runs on bucket totals
    lines = [line for line in plan.splitlines() if "Window [" in line]
    assert len(lines) == 2 and sum("_b#" in line for line in lines) == 2


def test_long_form(spark):
    df = spark.createDataFrame([("r", START, 1.0, 2.0, None)],
                               "region_id string, timestamp timestamp, demand_mw double, "
                               "temperature_f double, price_per_mwh double")
    got = {r["property"]: r["value"] for r in TS.long_form(df).collect()}
    assert got == {"demand_mw": 1.0, "temperature_f": 2.0, "price_per_mwh": None}


# ---- weather ----------------------------------------------------------------------
def readings(spark, rows):
    return spark.createDataFrame(rows, "region_id string, timestamp timestamp, demand_mw double, "
                                 "temperature_f double, cooling_degree_days double")


def test_weather_join(spark):
    from gridtide.operators import enrich
    energy = readings(spark, [("a", START, 1.0, None, None), ("a", START, 2.0, 50.0, None),
                              ("b", START, 3.0, None, None)])
    rows = [("a", START.date(), 70.0, 5.0, 0.0), ("a", START.date(), 72.0, 7.0, 0.0)]
    weather = spark.createDataFrame(rows, "region_id string, date date, avg_temp_f double, "
                                    "cooling_degree_days double, heating_degree_days double")
    out = enrich.join_weather(energy, weather)
    assert out.columns == energy.columns
    got = sorted((r["demand_mw"], r["temperature_f"], r["cooling_degree_days"]) for r in out.where("region_id='a'").collect())
    # two weather rows for the day give two readings each; present values win
    assert got == [(1.0, 70.0, 5.0), (1.0, 72.0, 7.0), (2.0, 50.0, 5.0), (2.0, 50.0, 7.0)]
    assert out.where("region_id='b'").first()["temperature_f"] is None
    assert enrich.join_weather(energy, None) is energy
    assert enrich.join_weather(energy, weather.drop("heating_degree_days")) is energy


def test_degree_days_restart_with_the_season(spark):
    rows = [("s", f"2023-12-{30 + i}", c, 1.0) for i, c in enumerate((10.0, 12.0))]
    rows += [("s", "2024-01-01", 3.0, 1.5), ("s", "2024-01-02", 3.0, 1.5)]
    df = spark.createDataFrame(rows, "station string, date string, CDSD double, HDSD double")
    got = W.daily_degree_days(df).orderBy("date").collect()
    assert [r["cooling_degree_days"] for r in got] == [10.0, 2.0, 3.0, 0.0]
    assert [r["heating_degree_days"] for r in got] == [1.0, 0.0, 0.5, 0.0]


def test_pivot_and_regions(spark):
    rows = [("GHCND:USW00094846", "2024-01-01", m, v) for m, v in
            (("TAVG", "70"), ("TMAX", "80"), ("TMIN", "bad"), ("CDSD", "5"))]
    wide = W.pivot_measures(spark.createDataFrame(rows, "station string, date string, datatype string, value string"))
    row = wide.first()
    assert (row["TAVG"], row["TMAX"], row["TMIN"], row["HDSD"]) == (70.0, 80.0, None, None)
    got = {r["region_id"]: r["avg_temp_f"] for r in W.region_weather(W.daily_degree_days(wide)).collect()}
    assert got == {"pjm": 70.0, "miso": 70.0}


def test_residual_matches_least_squares(spark):
    rng = np.random.default_rng(1)
    days = [START + timedelta(days=i) for i in range(40)]
    cdd, hdd = rng.uniform(0, 20, 40), rng.uniform(0, 30, 40)
    y = 100 + 3 * cdd + 2 * hdd + rng.normal(0, 1, 40)
    rows = [("two", d, float(v), None, None) for d, v in zip(days, y)]
    rows += [("one", d, float(10 + 2 * c), None, None) for d, c in zip(days, cdd)]
    rows += [("flat", d, float(i), None, None) for i, d in enumerate(days)]
    weather = [("two", d.date(), 0.0, float(c), float(h)) for d, c, h in zip(days, cdd, hdd)]
    weather += [("one", d.date(), 0.0, float(c), 4.0) for d, c in zip(days, cdd)]
    weather += [("flat", d.date(), 0.0, 1.0, 1.0) for d in days]
    w = spark.createDataFrame(weather, "region_id string, date date, avg_temp_f double, "
                              "cooling_degree_days double, heating_degree_days double")
    out = W.weather_residual(readings(spark, rows), w).orderBy("timestamp").toPandas()
    design = np.column_stack([np.ones(40), cdd, hdd])
    fit = design @ np.linalg.lstsq(design, y, rcond=None)[0]
    np.testing.assert_allclose(out[out.region_id == "two"].residual_mw, y - fit, atol=1e-8)
    np.testing.assert_allclose(out[out.region_id == "one"].residual_mw, 0, atol=1e-8)
    np.testing.assert_allclose(out[out.region_id == "flat"].expected_mw, 19.5)


def test_pivot_shuffles_once(spark, capsys):
    schema = "station string, date string, datatype string, value string"
    rows = [("a", "2024-01-01", m, v) for m, v in
            (("TAVG", "70"), ("TAVG", "71.5"), ("TMAX", None), ("TMIN", "NaN"), ("TMIN", "3"), ("CDSD", "x"))]
    rows += [("a", "2024-01-02", "SNOW", "1"), ("b", "2024-01-01", None, "2"), (None, None, "HDSD", "4")]
    records = spark.createDataFrame(rows, schema)
    wide = W.pivot_measures(records)
    wide.explain()
    assert capsys.readouterr().out.count("Exchange hashpartitioning") == 1
    assert wide.columns == ["station", "date", "TAVG", "TMAX", "TMIN", "CDSD", "HDSD"]
    got = {(r["station"], str(r["date"])): tuple(map(str, r[2:])) for r in wide.collect()}
    none = ("None",) * 5
    assert got == {
        ("a", "2024-01-01"): ("71.5", "None", "nan", "None", "None"),
        ("a", "2024-01-02"): none,
        ("b", "2024-01-01"): none,
        (None, "None"): ("None", "None", "None", "None", "4.0"),
    }


def test_climate_pages_shuffle_days_only(spark, tmp_path, capsys):
    rows = [(k % 3 if k % 7 else None, float(k % 11), START + timedelta(days=k // 2)) for k in range(150)]
    rows += [(1, None, START), (2, 5.0, None)]
    schema = "l_suppkey long, l_quantity double, l_shipdate timestamp"
    spark.createDataFrame(rows, schema).write.parquet(str(tmp_path / "lineitem.parquet"))
    pages = T.climate_pages(spark, str(tmp_path))
    pages.explain()
    # days of a station, then its years; their pages need none of their own
    assert capsys.readouterr().out.count("Exchange hashpartitioning") == 2
    long = T.station_records(spark, str(tmp_path)).withColumn("value", F.col("value").cast("string"))
    plain = T.result_pages(long, F.col("station"), F.substring("date", 1, 7))

    def content(found):
        return sorted(sorted(map(str, json.loads(r["body"])["results"])) for r in found.collect())

    assert content(pages) == content(plain) and pages.count() > 6


def test_landed_pages_are_compressed(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(landing, "PAGES_PER_FILE", 4)
    record = {"station": "S", "date": "2024-01-01", "datatype": "TAVG", "value": "1.0"}
    bodies = [json.dumps({"results": [record | {"value": f"{p}.{i}"} for i in range(100)]}) for p in range(10)]
    pages = spark.createDataFrame([(b,) for b in bodies], "body string").coalesce(1)
    path = tmp_path / "pages"
    landing.land_pages(pages, str(path))
    files = list(path.glob("part-*"))
    assert len(files) == 3
    assert sum(f.stat().st_size for f in files) * 5 < sum(map(len, bodies))
    got = landing.read_feed(spark, str(path), feeds.CLIMATE, lines=True)
    assert sorted(r["value"] for r in got.collect()) == sorted(f"{p}.{i}" for p in range(10) for i in range(100))
