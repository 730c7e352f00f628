import numpy as np
import pytest
from pyspark.sql import functions as F

from gridtide.operators import quality, spatial


def km(lat1, lon1, lat2, lon2):
    a, b, c, d = map(np.radians, (lat1, lon1, lat2, lon2))
    h = np.sin((c - a) / 2) ** 2 + np.cos(a) * np.cos(c) * np.sin((d - b) / 2) ** 2
    return 2 * 6371.0 * np.arctan2(np.sqrt(h), np.sqrt(1 - h))


def check(spark, sites, stations):
    s = spark.createDataFrame([(i, *map(float, p)) for i, p in enumerate(sites)], "site_id int, lat double, lon double")
    t = spark.createDataFrame([(i, *map(float, p)) for i, p in enumerate(stations)], "station_id int, lat double, lon double")
    got = {r["site_id"]: r for r in spatial.nearest_station(s, t).collect()}
    assert len(got) == len(sites)
    st = np.array(stations, dtype=float)
    for i, (lat, lon) in enumerate(sites):
        all_km = np.round(km(lat, lon, st[:, 0], st[:, 1]), 6)
        assert got[i]["distance_km"] == pytest.approx(all_km.min(), abs=2e-6)
        assert all_km[got[i]["station_id"]] == pytest.approx(all_km.min(), abs=2e-6)


def test_nearest_station_matches_all_pairs(spark):
    rng = np.random.default_rng(7)
    # a third of the stations crowd into one small cell, some at one place
    crowd = np.column_stack([40 + rng.uniform(0, 0.003, 60), -75 + rng.uniform(0, 0.003, 60)])
    crowd[:20] = crowd[0]
    wide = np.column_stack([rng.uniform(-80, 80, 120), rng.uniform(-180, 180, 120)])
    stations = np.vstack([crowd, wide])
    sites = np.vstack([
        np.column_stack([40 + rng.uniform(0, 0.004, 20), -75 + rng.uniform(0, 0.004, 20)]),
        np.column_stack([rng.uniform(-89, 89, 60), rng.uniform(-180, 180, 60)]),
        [[0, 179.99], [0, -179.99], [89.9, 0], [-89.9, 10]],
    ])
    check(spark, sites, stations)


def test_nearest_station_across_the_date_line_and_far_away(spark):
    check(spark, [(0, 179.9), (10, -179.9), (-60, 0)], [(0, -179.8), (0, 170), (70, 20)])


def test_ties_take_the_smallest_station(spark):
    s = spark.createDataFrame([(1, 10.0, 10.0)], "site_id int, lat double, lon double")
    t = spark.createDataFrame([(9, 10.0, 11.0), (3, 10.0, 9.0), (4, 10.0, 9.0)], "station_id int, lat double, lon double")
    assert spatial.nearest_station(s, t).first()["station_id"] == 3


def test_nearest_station_plan_has_no_nested_loop(spark):
    s = spark.range(10).selectExpr("id AS site_id", "double(id) AS lat", "double(id) AS lon")
    plan = spatial.nearest_station(s, s.withColumnRenamed("site_id", "station_id"))
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in text and "Cartesian" not in text


def test_stations_near(spark):
    t = spark.range(200).selectExpr("id AS station_id", "40 + id * 0.01 AS lat", "-75.0D AS lon")
    t = t.withColumn("lat", F.col("lat").cast("double"))
    got = [r["station_id"] for r in spatial.stations_near(t, 40.0, -75.0, 50).collect()]
    assert got == list(range(25))
    assert spatial.stations_near(t, 40.0, -75.0, 11.2).count() == 11


def test_region_of_point(spark):
    ring = [(0.0, 0.0), (4.0, 0.0), (4.0, 4.0), (2.0, 1.0), (0.0, 4.0), (0.0, 0.0)]
    regions = spark.createDataFrame([("m", ring)], "region_id string, ring array<struct<lon:double,lat:double>>")
    points = [(1, 0.5, 2.0), (2, 3.0, 2.0), (3, 3.0, 0.5), (4, 3.0, 3.5), (5, 5.0, 5.0), (6, -0.5, 1.0)]
    df = spark.createDataFrame([(i, float(a), float(b)) for i, a, b in points], "point_id int, lat double, lon double")
    got = sorted(r["point_id"] for r in spatial.region_of_point(df, regions).collect())
    assert got == [1, 3, 4]


def ray_says_inside(lat, lon, ring):
    odd = False
    for (x1, y1), (x2, y2) in zip(ring, ring[1:]):
        if (y1 > lat) != (y2 > lat) and lon < x1 + (lat - y1) * ((x2 - x1) / (y2 - y1)):
            odd = not odd
    return odd


@pytest.mark.parametrize("cell", [1.0, 0.7, 25.0])
def test_cells_agree_with_a_ray_on_any_ring(spark, cell):
    rng = np.random.default_rng(11)
    rings = {}
    for i in range(12):
        turn = np.sort(rng.uniform(0, 2 * np.pi, 3 + 5 * i))
        far = rng.uniform(0.2, 6.0, len(turn))
        x, y = rng.uniform(-3, 3, 2)
        corners = [(float(x + r * np.cos(t)), float(y + r * np.sin(t))) for t, r in zip(turn, far)]
        rings[f"star{i}"] = corners + corners[:1]
    # level and upright edges on cell borders, a comb, a sliver, a ring within one cell
    rings["box"] = [(0.0, 0.0), (3.0, 0.0), (3.0, 2.0), (0.0, 2.0), (0.0, 0.0)]
    rings["steps"] = [(0.0, 0.0), (3.0, 0.0), (3.0, 1.0), (2.0, 1.0), (2.0, 2.5), (1.0, 2.5), (1.0, 3.0), (0.0, 3.0), (0.0, 0.0)]
    comb = [(float(i), 4.0 if i % 2 else 0.5) for i in range(-5, 6)]
    rings["comb"] = comb + [(5.0, -1.0), (-5.0, -1.0), comb[0]]
    rings["sliver"] = [(-4.0, -4.0), (4.0, 3.999), (4.0, 4.0), (-4.0, -4.0)]
    rings["small"] = [(0.2, 0.2), (0.4, 0.2), (0.4, 0.2), (0.3, 0.45), (0.2, 0.2)]
    places = [(float(a), float(b)) for a, b in rng.uniform(-7, 7, (1500, 2))]
    places += [(float(a), float(b)) for a in range(-6, 7) for b in range(-6, 7)]
    places += [(b, a) for ring in rings.values() for a, b in ring[:9]]
    places += [(round(a * 2) / 2, b) for a, b in places[:300]] + [(a, round(b)) for a, b in places[:300]]
    regions = spark.createDataFrame(list(rings.items()), "region_id string, ring array<struct<lon:double,lat:double>>")
    points = spark.createDataFrame([(i, float(a), float(b)) for i, (a, b) in enumerate(places)],
                                   "point_id int, lat double, lon double")
    got = {tuple(r) for r in spatial.region_of_point(points, regions, cell).collect()}
    want = {(i, name) for i, (a, b) in enumerate(places) for name, ring in rings.items() if ray_says_inside(a, b, ring)}
    assert got == want


def test_cells_hold_no_whole_ring(spark):
    from gridtide.operators import ringindex
    turn = np.linspace(0, 2 * np.pi, 4001)
    ring = [(float(10 * np.cos(t)), float(10 * np.sin(t))) for t in turn[:-1]]
    regions = spark.createDataFrame([("disc", ring + ring[:1]), ("none", [])],
                                    "region_id string, ring array<struct<lon:double,lat:double>>")
    index = ringindex.ring_index(regions).collect()
    assert max(len(r["edges"]) for r in index) < 250
    whole = [r for r in index if not r["edges"]]
    assert len(whole) > 200 and all(r["corner_inside"] for r in whole)
    plan = spatial.region_of_point(spark.range(3).selectExpr("id AS point_id", "double(id) AS lat", "double(id) AS lon"), regions)
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in text and "Cartesian" not in text


# ---- objects ------------------------------------------------------------------------
def test_object_findings(spark):
    rows = [("a", 1.0), ("a", 2.0), (None, 3.0), ("b", 4.0), (None, 1.0)]
    df = spark.createDataFrame(rows, "reading_id string, demand_mw string".replace("demand_mw string", "demand_mw double"))
    df = df.withColumns({"region_id": F.lit(1), "extra": F.lit(1)})
    got = {(r["finding"], r["column"]): r["n"] for r in quality.object_issues(df, "energy-reading").collect()}
    assert got[("null_key", "reading_id")] == 2
    assert got[("duplicate_key", "reading_id")] == 2
    assert got[("extra_column", "extra")] == 1
    assert got[("type_mismatch", "region_id")] == 1
    assert ("missing_column", "temperature_f") in got and ("missing_column", "demand_mw") not in got


def test_links_and_flags(spark):
    sites = spark.createDataFrame([("x", "r"), ("y", "gone"), ("z", None)], "dc_id string, region_id string")
    regions = spark.createDataFrame([("r", "Region R"), ("q", "Region Q")], "region_id string, region_name string")
    lost = quality.orphans(sites, regions, "data-center-in-region").collect()
    assert [(r["source_key"], r["missing_target"]) for r in lost] == [("y", "gone")]
    titles = {r["source_key"]: r["target_title"] for r in quality.navigate(sites, regions, "data-center-in-region").collect()}
    assert titles == {"x": "Region R", "y": None, "z": None}
    found = spark.createDataFrame([("r", 1), ("r", 2)], "region_id string, timestamp int")
    flags = spark.createDataFrame([("r", 2, "look")], "region_id string, timestamp int, notes string")
    got = {r["timestamp"]: (r["flagged"], r["notes"]) for r in quality.flag_anomalies(found, flags).collect()}
    assert got == {1: (False, None), 2: (True, "look")}


def test_sites_off_the_globe_stay(spark):
    sites = spark.createDataFrame(
        [(1, 10.0, 20.0), (2, None, 5.0), (3, 95.0, 0.0), (4, 0.0, float("nan"))], "site_id long, lat double, lon double")
    stations = spark.createDataFrame([("a", 10.0, 21.0), ("b", 400.0, 0.0), ("c", None, None)], "station_id string, lat double, lon double")
    got = {r["site_id"]: r["station_id"] for r in spatial.nearest_station(sites, stations).collect()}
    assert got == {1: "a", 2: None, 3: None, 4: None}
