from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from gridtide.operators import control, correlate, enrich, events, forecast, kpi
from gridtide.sources import schemas

def as_of():
    return F.lit(date(2024, 1, 1))
SITE = (
    "dc_id string, name string, region_id string, capacity_mw double, ai_focused boolean, "
    "gpu_count bigint, operational_date date, construction_status string"
)


def sites(spark, *rows):
    base = dict(capacity_mw=10.0, ai_focused=False, gpu_count=None, construction_status="operational",
                region_id="r", operational_date=date(2022, 6, 15))
    full = [{**base, "name": r["dc_id"].upper(), **r} for r in rows]
    names = [c.split()[0] for c in SITE.split(", ")]
    return spark.createDataFrame([tuple(r[n] for n in names) for r in full], SITE)


@pytest.fixture
def energy(spark):
    """One reading a month from 2015 to 2024: 100 before June 2022, 130 from then on."""
    rows = [("r", datetime(y, m, 10), 100.0 if (y, m) < (2022, 6) else 130.0)
            for y in range(2015, 2025) for m in range(1, 13)]
    return spark.createDataFrame(rows, "region_id string, timestamp timestamp, demand_mw double")


def test_months_of_the_periods(spark, energy):
    got = {r["dc_id"]: r for r in events.site_events(energy, sites(
        spark,
        dict(dc_id="first", operational_date=date(2022, 6, 1)),
        dict(dc_id="mid"),
        dict(dc_id="last", operational_date=date(2022, 5, 31)),
        dict(dc_id="young", operational_date=date(2023, 11, 1)),
        dict(dc_id="planned", construction_status="planned"),
        dict(dc_id="expanding", construction_status="expanding"),
        dict(dc_id="nowhere", region_id="unknown"),
        dict(dc_id="undated", operational_date=None),
        dict(dc_id="regionless", region_id=None),
    ), as_of()).collect()}
    assert set(got) == {"first", "mid", "last"}
    # opening on the first: 36 + 13 months, capped; otherwise 35 + 12 of 48
    assert got["first"]["data_completeness"] == 1.0
    assert got["mid"]["data_completeness"] == pytest.approx(47 / 48)
    assert got["mid"]["pre_period_avg_demand_mw"] == 100.0
    assert got["mid"]["post_period_avg_demand_mw"] == 130.0
    assert got["mid"]["delta_demand_pct"] == pytest.approx(30.0)
    assert got["mid"]["event_id"] == "corr_mid_r_2024-01-01"
    assert got["mid"]["confidence_score"] == pytest.approx(
        round(0.3 + 0.2 * 35 / 36 + 0.2 + 0.3 * 1.0, 3))
    assert (str(got["last"]["pre_period_start"]), str(got["last"]["pre_period_end"])) == (
        "2019-05-31", "2022-04-30")
    out = events.site_events(energy, sites(spark, dict(dc_id="x")), as_of())
    assert [(f.name, f.dataType) for f in out.schema] == [(f.name, f.dataType) for f in schemas.EVENT]


def test_short_post_period_and_window(spark, energy):
    df = sites(spark, dict(dc_id="new", operational_date=date(2023, 9, 15)), dict(dc_id="old"))
    one = events.site_events(energy, df, as_of(), window=18, dc_id="old").collect()
    assert [r["dc_id"] for r in one] == ["old"]
    assert (one[0]["analysis_window_months"], str(one[0]["post_period_end"])) == (18, "2023-12-15")
    new = events.site_events(energy, df, as_of()).where("dc_id = 'new'").first()
    assert str(new["post_period_end"]) == "2024-01-01"
    # October to January against 36 + 3 months
    assert new["data_completeness"] == 1.0


def test_missing_sides_and_zero_baseline(spark):
    rows = [("zero", datetime(2022, 1, 5), 0.0), ("zero", datetime(2022, 9, 5), 5.0),
            ("nopre", datetime(2022, 9, 5), 5.0), ("nopost", datetime(2022, 1, 5), 5.0),
            ("null", datetime(2022, 1, 5), None), ("null", datetime(2022, 9, 5), 5.0)]
    energy = spark.createDataFrame(rows, "region_id string, timestamp timestamp, demand_mw double")
    df = sites(spark, *[dict(dc_id=r, region_id=r, capacity_mw=c) for r, c in
                        [("zero", None), ("nopre", 1.0), ("nopost", 1.0), ("null", 1.0)]])
    got = events.site_events(energy, df, as_of()).collect()
    assert [r["dc_id"] for r in got] == ["zero"]
    assert got[0]["delta_demand_mw"] == 5.0 and got[0]["delta_demand_pct"] is None


def test_many_sites_of_one_region_share_their_periods(spark, energy):
    many = spark.range(5000).select(
        F.concat(F.lit("s"), "id").alias("dc_id"), F.lit("n").alias("name"), F.lit("r").alias("region_id"),
        F.lit(10.0).alias("capacity_mw"), F.lit(True).alias("ai_focused"),
        F.lit(None).cast("bigint").alias("gpu_count"),
        F.date_add(F.lit(date(2021, 1, 1)), (F.col("id") % 200).cast("int")).alias("operational_date"),
        F.lit("operational").alias("construction_status"))
    bounded = events.period_bounds(events.online_sites(many, as_of()), as_of())
    stats = events.period_stats(bounded, events.monthly_energy(energy))
    assert stats.count() <= 14
    assert events.site_events(energy, many, as_of()).count() == 5000


def test_capacity_timeline(spark):
    df = sites(
        spark,
        dict(dc_id="a", operational_date=date(2020, 1, 5), ai_focused=True, gpu_count=5),
        dict(dc_id="b", operational_date=date(2020, 1, 25), ai_focused=None),
        dict(dc_id="c", operational_date=date(2020, 4, 1), capacity_mw=2.5),
        dict(dc_id="d", operational_date=date(2020, 4, 1), capacity_mw=None),
        dict(dc_id="e", operational_date=date(2020, 4, 1), construction_status="expanding"),
    )
    timeline = enrich.capacity_timeline(df)
    got = [tuple(r)[2:] for r in timeline.orderBy("date").collect()]
    assert got == [(20.0, 10.0, 2, 5, "B"), (22.5, 10.0, 3, 5, "C")]
    assert [(f.name, f.dataType) for f in timeline.schema] == [(f.name, f.dataType) for f in schemas.TIMELINE]


def test_kpi(spark):
    monthly = spark.createDataFrame(
        [("a", datetime(2024, 1, 1), 120.0), ("b", datetime(2024, 1, 1), 50.0), ("c", datetime(2024, 1, 1), 0.0),
         ("gone", datetime(2023, 12, 1), 9.0), ("a", datetime(2023, 12, 1), 1.0)],
        "region_id string, month timestamp, avg_demand_mw double")
    event = spark.createDataFrame(
        [("a", 100.0, 5.0, 0.5), ("b", 0.0, 7.0, 0.4), ("b", 0.0, 9.0, 0.6)],
        "region_id string, pre_period_avg_demand_mw double, delta_demand_pct double, confidence_score double")
    timeline = spark.createDataFrame(
        [("a", 10.0, 4.0, 1, 7), ("a", 30.0, 4.0, 2, 9), ("c", 1.0, 1.0, 1, 1)],
        "region_id string, cumulative_capacity_mw double, cumulative_ai_capacity_mw double, "
        "cumulative_dc_count bigint, cumulative_gpu_count bigint")
    out = kpi.kpi_summary(monthly, timeline, event, F.lit(datetime(2024, 2, 1)))
    got = {r["region_id"]: r for r in out.collect()}
    assert set(got) == {"a", "b", "c"}
    assert got["a"]["energy_delta_pct"] == pytest.approx(20.0)
    assert got["a"]["dc_load_pct_of_demand"] == pytest.approx(25.0)
    assert (got["a"]["total_dc_count"], got["a"]["total_gpu_count"]) == (2, 9)
    # a baseline of zero falls back to the mean of the events
    assert got["b"]["energy_delta_pct"] == pytest.approx(8.0)
    assert got["b"]["avg_confidence"] == pytest.approx(0.5) and got["b"]["dc_events_count"] == 2
    assert got["c"]["dc_load_pct_of_demand"] is None and got["c"]["energy_delta_pct"] is None
    assert [r["region_id"] for r in kpi.top_regions(out, 2).collect()] == ["a", "b"]
    dimension = spark.createDataFrame(
        [("a", "A", "VA", 5, 1.0), ("z", "Z", "TX", 6, 1.0)],
        "region_id string, region_name string, states_covered string, population bigint, area_sq_miles double")
    objects = {r["region_id"]: r for r in kpi.region_objects(out, dimension).collect()}
    assert objects["a"]["dc_count"] == 2 and objects["z"]["current_demand_mw"] is None


def test_correlations(spark):
    months = [datetime(2020, m, 1) for m in range(1, 10)]
    rows = [("six", m, float(i * i)) for i, m in enumerate(months[:6])]
    rows += [("five", m, 1.0 * i) for i, m in enumerate(months[:5])]
    rows += [("flat", m, 7.0) for m in months[:6]]
    rows += [("gap", m, None if i == 2 else 2.0 * i) for i, m in enumerate(months[:6])]
    monthly = spark.createDataFrame(rows, "region_id string, month timestamp, avg_demand_mw double")
    timeline = spark.createDataFrame(
        [(r, m, 10.0 + i, None if i % 2 else 1.0 * i) for r in ("six", "five", "flat", "gap", "none")
         for i, m in enumerate(months)],
        "region_id string, date timestamp, cumulative_capacity_mw double, cumulative_ai_capacity_mw double")
    got = {r["region_id"]: r for r in correlate.regional_correlations(monthly, timeline, as_of()).collect()}
    assert set(got) == {"six", "flat", "gap"}
    import pandas as pd
    want = pd.Series([0, 1, 4, 9, 16, 25.0]).corr(pd.Series([10, 11, 12, 13, 14, 15.0]))
    assert got["six"]["pearson_total_dc"] == pytest.approx(want)
    assert got["flat"]["pearson_total_dc"] is None and got["flat"]["data_points"] == 6
    assert got["gap"]["pearson_total_dc"] == pytest.approx(1.0) and got["gap"]["data_points"] == 6
    assert got["six"]["pearson_ai_dc"] == pytest.approx(
        pd.Series([0, 4, 16.0]).corr(pd.Series([0, 2, 4.0])))
    ranks = {r["region_id"]: r for r in correlate.rank_correlations(monthly, timeline).collect()}
    assert ranks["six"]["spearman_total_dc"] == pytest.approx(1.0)
    assert ranks["six"]["significant"] is True
    assert ranks["flat"]["p_value"] is None


def test_correlations_match_a_grouped_pandas_function(spark):
    import numpy as np
    import pandas as pd
    rng = np.random.default_rng(6)
    months = [datetime(2020 + i // 12, i % 12 + 1, 1) for i in range(24)]
    monthly = spark.createDataFrame(
        [(f"r{g}", m, float(rng.normal())) for g in range(5) for m in months[: 4 + 4 * g]],
        "region_id string, month timestamp, avg_demand_mw double")
    timeline = spark.createDataFrame(
        [(f"r{g}", m, float(i * g), float(i % 3)) for g in range(5) for i, m in enumerate(months)],
        "region_id string, date timestamp, cumulative_capacity_mw double, cumulative_ai_capacity_mw double")

    def per_region(pdf):
        if len(pdf) < 6:
            return pd.DataFrame()
        d = pdf["avg_demand_mw"]
        total, ai = d.corr(pdf["cumulative_capacity_mw"]), d.corr(pdf["cumulative_ai_capacity_mw"])
        return pd.DataFrame({"region_id": [pdf["region_id"].iloc[0]], "total": [total], "ai": [ai]})

    pairs = correlate.demand_and_capacity(monthly, timeline)
    want = {r["region_id"]: r for r in pairs.groupBy("region_id").applyInPandas(
        per_region, "region_id string, total double, ai double").collect()}
    got = {r["region_id"]: r for r in correlate.regional_correlations(monthly, timeline, as_of()).collect()}
    assert set(got) == set(want) == {"r1", "r2", "r3", "r4"}
    for region, row in want.items():
        assert got[region]["pearson_total_dc"] == pytest.approx(row["total"])
        assert got[region]["pearson_ai_dc"] == pytest.approx(row["ai"])


def test_average_ranks_match_pandas(spark):
    import pandas as pd
    values = [3.0, 1.0, 3.0, 2.0, 3.0, 1.0]
    df = spark.createDataFrame([("g", v) for v in values], "g string, v double")
    got = sorted(r[0] for r in df.select(correlate.average_rank("v", "g")).collect())
    assert got == sorted(pd.Series(values).rank())


@pytest.mark.parametrize("limit", [0, 30, 60, 100])
def test_control_regions_match_all_pairs(spark, limit):
    import random
    random.seed(4 + limit)
    people = [(f"r{i}", random.choice([0, 7, 10, random.randint(90, 260), random.randint(1, 9000)]), random.randint(0, 5))
              for i in range(300)]
    busy = {f"r{i}" for i in range(0, 300, 2)}
    profiles = spark.createDataFrame(people + [("x", None, 1), ("y", 5, None)],
                                     "region_id string, population bigint, climate_zone int")
    sites = spark.createDataFrame([(r,) for r in busy] * 2 + [("elsewhere",)], "region_id string")
    found = control.match_control_regions(profiles, sites, limit)
    got = {r["region_id"]: (r["control_region_id"], r["population"], r["control_population"]) for r in found.collect()}
    want = {}
    for r, p, z in people:
        if r in busy:
            options = [(abs(p - q), s, q) for s, q, y in people
                       if s not in busy and abs(z - y) <= 1 and abs(p - q) <= p * limit / 100]
            if options:
                want[r] = (min(options)[1], p, min(options)[2])
    assert got == want and found.count() == len(want)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan
    assert not busy & {v[0] for v in got.values()}


def test_forecast(spark):
    regions = spark.createDataFrame(
        [("pjm", 50000.0, 2000.0), ("dark", 0.0, 10.0)],
        "region_id string, current_demand_mw double, planned_dc_capacity_mw double")
    out = forecast.predict(regions, 3)
    got = [tuple(r)[1:] for r in out.where("region_id = 'pjm'").orderBy("year_ahead").collect()]
    assert got == [(1, 51000.0, 666.7, 51666.7, 3.33), (2, 52020.0, 1333.3, 53353.3, 6.71),
                   (3, 53060.4, 2000.0, 55060.4, 10.12)]
    assert {r["demand_increase_pct"] for r in out.where("region_id = 'dark'").collect()} == {None}
    assert forecast.predict(regions, 0).count() == 0


def test_forecast_fit(spark):
    event = spark.createDataFrame(
        [("a", "x", 10.0, 0.5), ("a", "y", 20.0, 0.9), ("a", "z", 99.0, 0.49), ("b", "w", 1.0, None)],
        "region_id string, dc_id string, delta_demand_mw double, confidence_score double")
    registry = spark.createDataFrame([("x", 5.0), ("y", 0.0)], "dc_id string, capacity_mw double")
    got = forecast.fit_impact(event, registry).collect()
    assert [(r["region_id"], r["avg_delta_mw"], r["event_count"], r["mw_per_site_mw"]) for r in got] == [
        ("a", 15.0, 2, 2.0)]
    regions = spark.createDataFrame([("a", 100.0, 30.0), ("n", 100.0, 30.0)],
                                    "region_id string, current_demand_mw double, planned_dc_capacity_mw double")
    factors = {r["region_id"]: r["impact_factor"] for r in forecast.predict(
        regions, 1, impact=forecast.fit_impact(event)).collect()}
    assert factors == {"a": 15.0, "n": 1.3}
