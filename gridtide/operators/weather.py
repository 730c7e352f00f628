"""Daily weather: pivot, degree days, station mapping and weather-adjusted demand."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import lookups as L
from ..functions import scalar as S
from ..functions.exact import exact_avg

BASE_TEMPERATURE_F = 65.0


def pivot_measures(records: DataFrame) -> DataFrame:
    """Long station records to one row per station and day, a column per measure.

    Naming the measures spares the extra pass that would look for them.  Each is an aggregate
    under a condition, so the records of a day that lie together become one row before they are
    shuffled; a pivot would shuffle them by measure first.
    """
    value = S.to_double(F.col("value"))
    measures = [F.max(F.when(F.col("datatype") == m, value)).alias(m) for m in L.WEATHER_MEASURES]
    return records.groupBy("station", F.to_date("date").alias("date")).agg(*measures)


def daily_degree_days(daily: DataFrame) -> DataFrame:
    """Degree days per day from season-to-date sums; a fall of the sum starts a season.

    A window sees the days of one station.
    """
    by_day = Window.partitionBy("station").orderBy("date")

    def per_day(column: str):
        value, before = F.col(column), F.lag(column).over(by_day)
        return F.when(before.isNull() | (value < before), value).otherwise(value - before)

    return daily.withColumns(
        {"cooling_degree_days": per_day("CDSD"), "heating_degree_days": per_day("HDSD")}
    )


def degree_days_of(temperature):
    """Cooling and heating degree days of a mean temperature."""
    zero = F.lit(0.0)
    return (
        F.greatest(zero, temperature - BASE_TEMPERATURE_F),
        F.greatest(zero, BASE_TEMPERATURE_F - temperature),
    )


def region_weather(daily: DataFrame) -> DataFrame:
    """Daily regional weather: stations to markets to authorities, averaged per day."""
    regions: dict[str, set[str]] = {}
    for market, stations in L.MARKET_STATIONS.items():
        for station in stations:
            regions.setdefault(station, set()).update(L.MARKET_AUTHORITIES[market])
    pairs = [
        x
        for station, codes in regions.items()
        for x in (F.lit(station), F.array(*[F.lit(c.lower()) for c in sorted(codes)]))
    ]
    served = F.try_element_at(F.create_map(*pairs), F.col("station"))
    return (
        daily.withColumn("region_id", F.explode(served))
        .groupBy("region_id", "date")
        .agg(
            exact_avg(F.col("TAVG")).alias("avg_temp_f"),
            exact_avg(F.col("cooling_degree_days")).alias("cooling_degree_days"),
            exact_avg(F.col("heating_degree_days")).alias("heating_degree_days"),
        )
    )


def weather_residual(energy: DataFrame, weather: DataFrame) -> DataFrame:
    """Demand less the part explained by degree days, by least squares per region.

    Degree days are those of a day, so readings are averaged per region and day first and the
    fit weighs these days by their readings.  When the regressors carry no or the same
    information, the fit falls back to cooling degree days alone, then heating alone, then the
    mean.  Readings without weather, or of a region without a fit, stay with NULL expected and
    residual demand.
    """
    y, c, h = F.col("demand_mw"), F.col("cdd"), F.col("hdd")
    readings = energy.select("region_id", "timestamp", "demand_mw", F.to_date("timestamp").alias("_day"))
    days = weather.select(
        "region_id",
        F.col("date").alias("_day"),
        F.col("cooling_degree_days").alias("cdd"),
        F.col("heating_degree_days").alias("hdd"),
    )
    measured = readings.where(y.isNotNull()).groupBy("region_id", "_day").agg(
        F.count("*").alias("n"), F.avg(y).alias("y")
    )
    complete = measured.join(days.where(c.isNotNull() & h.isNotNull()), ["region_id", "_day"])

    def mean(value):
        return F.sum(F.col("n") * value) / F.sum("n")

    means = complete.groupBy("region_id").agg(
        mean(F.col("y")).alias("my"), mean(c).alias("mc"), mean(h).alias("mh")
    )
    dy, dc, dh = F.col("y") - F.col("my"), c - F.col("mc"), h - F.col("mh")
    moments = (
        complete.join(means, "region_id")
        .groupBy("region_id", "my", "mc", "mh")
        .agg(
            mean(dc * dc).alias("vc"), mean(dh * dh).alias("vh"), mean(dc * dh).alias("vch"),
            mean(dc * dy).alias("vcy"), mean(dh * dy).alias("vhy"),
        )
    )
    # what rounding of a mean leaves of a constant is no variance
    vc, vh = (
        F.when(F.col(v) > F.col(m) * F.col(m) * 1e-24, F.col(v)).otherwise(0.0)
        for v, m in (("vc", "mc"), ("vh", "mh"))
    )
    vch, vcy, vhy = (F.col(n) for n in ("vch", "vcy", "vhy"))
    det = vc * vh - vch * vch
    both = det > vc * vh * 1e-9
    zero = F.lit(0.0)
    fit = moments.select(
        "region_id",
        F.when(both, (vcy * vh - vhy * vch) / det).when(vc > 0, vcy / vc).otherwise(zero).alias("b1"),
        F.when(both, (vhy * vc - vcy * vch) / det)
        .when(vc > 0, zero)
        .when(vh > 0, vhy / vh)
        .otherwise(zero)
        .alias("b2"),
        "my", "mc", "mh",
    )
    expected = F.col("my") + F.col("b1") * (c - F.col("mc")) + F.col("b2") * (h - F.col("mh"))
    explained = days.join(fit, "region_id").select("region_id", "_day", expected.alias("expected_mw"))
    return readings.join(explained, ["region_id", "_day"], "left").select(
        "region_id",
        "timestamp",
        "demand_mw",
        "expected_mw",
        (y - F.col("expected_mw")).alias("residual_mw"),
    )
