from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from gridtide.functions import exact, geo
from gridtide.functions import lookups as L
from gridtide.functions import scalar as S


def s(text):
    return F.lit(text).cast("string")


@pytest.mark.parametrize(
    "text, number, whole",
    [("12.5", 12.5, None), (" 7 ", 7.0, 7), ("abc", None, None), ("", None, None),
     ("1e3", 1000.0, None), ("12d", None, None), ("-4", -4.0, -4), (None, None, None),
     ("96000.0", 96000.0, 96000), ("1.0E7", 1e7, 10000000), ("12.7", 12.7, None), ("9.9e30", 9.9e30, None)],
)
def test_parse_numbers(one, text, number, whole):
    assert one(S.to_double(s(text))) == number
    assert one(S.to_bigint(s(text))) == whole
    assert one(S.to_double(s(text), 1.3)) == (1.3 if number is None else number)
    assert one(S.to_bigint(s(text), 5)) == (5 if whole is None else whole)


@pytest.mark.parametrize(
    "status, expected",
    [("operational", "operational"), ("Online", "operational"), ("active", "operational"),
     ("under construction", "under_construction"), (" Building\t", "under_construction"),
     ("Planned", "planned"), ("Announced", "planned"), ("expansion", "expanding"),
     ("weird_status", "unknown"), ("", "unknown"), (None, "unknown")],
)
def test_status(one, status, expected):
    assert one(S.site_status(s(status))) == expected


@pytest.mark.parametrize(
    "gpus, accelerators, owner, name, expected",
    [(None, None, "OpenAI", None, True), (None, None, "xAI", None, True),
     (None, None, "Google", None, True), (None, None, "Random Corp", None, False),
     ("5000", None, None, None, True), (None, "100", None, None, True),
     ("0", None, None, None, False), ("many", None, None, None, True),
     (None, None, "Metals Inc", None, True), (None, None, None, "Maine Campus", True),
     (None, None, None, "Stone Hall", False)],
)
def test_ai_site(one, gpus, accelerators, owner, name, expected):
    assert one(S.is_ai_site(s(gpus), s(accelerators), s(owner), s(name))) is expected


def test_lookups(one):
    assert [one(S.state_of_fips(s(f))) for f in ("51", "48", "06", "99")] == ["VA", "TX", "CA", None]
    assert len(L.FIPS_STATE) == 51
    assert "PJM" in L.MARKET_AUTHORITIES["nova"]
    assert "ERCO" in L.MARKET_AUTHORITIES["dfw"]
    assert "CISO" in L.MARKET_AUTHORITIES["sjc"]
    assert (L.BASELINE_MONTHS, L.ANOMALY_PCT) == (36, 10.0)
    assert 0 < L.SIGNIFICANCE_LEVEL < 1
    for code, state in L.TOP_STATE_FIPS.items():
        assert L.FIPS_STATE[state] == code


def test_units():
    assert L.MWH_TO_TWH == 1 / 1_000_000
    assert L.GWH_TO_TWH == 1 / 1000
    assert L.MW_TO_ANNUAL_MWH == pytest.approx(7446)


def test_distance(one):
    lit = [F.lit(x) for x in (39.0438, -77.4874, 38.9072, -77.0369)]
    assert one(geo.distance_km(*lit)) == pytest.approx(41.80057, abs=1e-5)
    assert one(geo.distance_km(lit[0], lit[1], lit[0], lit[1])) == 0


def test_bounding_box(one):
    box = one(geo.bounding_box(F.lit(0.0), F.lit(10.0), F.lit(111.0)))
    assert (box["lat_min"], box["lat_max"]) == (-1.0, 1.0)
    assert (box["lon_min"], box["lon_max"]) == (9.0, 11.0)
    pole = one(geo.bounding_box(F.lit(90.0), F.lit(0.0), F.lit(1.11)))
    assert pole["lon_max"] == pytest.approx(1.0)


def test_calendar_months(one):
    d = lambda *a: F.lit(date(*a))
    assert one(S.calendar_months(d(2023, 1, 1), d(2024, 1, 1))) == 12
    assert one(S.calendar_months(d(2023, 1, 1), d(2024, 6, 15))) == 17
    assert one(S.calendar_months(d(2023, 1, 31), d(2023, 2, 1))) == 1


@pytest.mark.parametrize(
    "period, authority, expected",
    [("2024-01-15T14", "PJM", datetime(2024, 1, 15, 19)),
     ("2024-07-15T14", "PJM", datetime(2024, 7, 15, 18)),
     ("2024-07-15T14", "SRP", datetime(2024, 7, 15, 21)),
     ("2024-01-15T14", "nowhere", datetime(2024, 1, 15, 19)),
     ("2024-11-03T01", "PJM", datetime(2024, 11, 3, 6)),
     ("2024-03-10T02", "PJM", datetime(2024, 3, 10, 7)),
     ("yesterday", "PJM", None)],
)
def test_period_to_utc(one, period, authority, expected):
    assert one(S.hour_to_utc(s(period), s(authority)).cast("timestamp_ntz")) == expected


@pytest.mark.parametrize(
    "pre, post, completeness, capacity, demand, score",
    [(36, 12, 0.95, 500.0, 10000.0, 0.85), (3, 2, 0.3, 10.0, 50000.0, 0.163),
     (0, 0, 0.0, 0.0, 0.0, 0.03), (36, 12, 1.0, None, 100.0, 0.73),
     (36, 12, 1.0, 0.0, 100.0, 0.7), (100, 100, 5.0, 1e9, 1.0, 1.0)],
)
def test_confidence(one, pre, post, completeness, capacity, demand, score):
    args = [F.lit(pre), F.lit(post), F.lit(completeness), F.lit(capacity).cast("double"), F.lit(demand)]
    assert one(S.confidence_score(*args)) == pytest.approx(score)


@pytest.mark.parametrize(
    "deviation, severity, kind",
    [(25.0, "MEDIUM", "DEMAND_SPIKE"), (25.1, "HIGH", "DEMAND_SPIKE"), (15.0, "LOW", "DEMAND_SPIKE"),
     (-15.1, "MEDIUM", "DEMAND_DROP"), (-30.0, "HIGH", "DEMAND_DROP")],
)
def test_severity(one, deviation, severity, kind):
    assert one(S.severity(F.lit(deviation))) == severity
    assert one(S.anomaly_kind(F.lit(deviation))) == kind


def test_guards(one):
    none = F.lit(None).cast("double")
    assert one(S.pct_change(F.lit(12.0), F.lit(10.0))) == pytest.approx(20)
    assert one(S.pct_change(F.lit(12.0), F.lit(0.0))) is None
    assert one(S.pct_change(F.lit(12.0), none)) is None
    assert one(S.above(none, 200)) is False
    assert one(S.above(F.lit(200.0), 200)) is False


@pytest.mark.parametrize(
    "t, v, p",
    [(12.7062, 1, 0.05), (4.30265, 2, 0.05), (3.18245, 3, 0.05), (2.22814, 10, 0.05),
     (2.20099, 11, 0.05), (0.0, 7, 1.0), (-2.0, 60, 0.0500), (3.4602, 60, 0.001)],
)
def test_t_tail(one, t, v, p):
    assert one(S.two_sided_p(F.lit(t), F.lit(v))) == pytest.approx(p, abs=2e-5 if v != 60 else 1e-3)


@pytest.mark.parametrize(
    "values, mean",
    [([1e23, 10.0], 5e22), ([4e-7, 4e-7], 4e-7), ([1.5, None, 2.5], 2.0), ([None], None),
     ([0.1] * 10, 0.1), ([float("inf"), 1.0], float("inf"))],
)
def test_averages_leave_nothing_out(spark, values, mean):
    df = spark.createDataFrame([(v,) for v in values], "v double")
    got = df.agg(exact.exact_avg(F.col("v")).alias("a")).first()["a"]
    assert got == (mean if mean is None else pytest.approx(mean, rel=1e-15))


def test_sums_do_not_depend_on_order(spark):
    values = [1 / 3 * 10**k for k in range(-9, 12)] * 20
    got = {spark.createDataFrame([(v,) for v in order], "v double").agg(exact.exact_sum(F.col("v"))).first()[0]
           for order in (values, values[::-1], sorted(values))}
    assert len(got) == 1


def test_running_sums_refuse_what_they_cannot_hold(spark):
    from pyspark.sql import Window
    df = spark.createDataFrame([(1, 1.0), (2, float("nan")), (3, 2.0)], "i int, v double")
    over = Window.orderBy("i")
    assert [r[0] for r in df.select(exact.running_sum(F.col("v"), over)).collect()] == [1.0, 1.0, 3.0]
    with pytest.raises(Exception, match="out of range"):
        df.withColumn("v", F.lit(1e23)).select(exact.running_sum(F.col("v"), over)).collect()
