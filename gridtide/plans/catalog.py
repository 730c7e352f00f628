"""Registered queries: operators applied to the whole given tables."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType

from ..functions import geo
from ..functions import lookups as L
from ..functions import scalar as S
from ..operators import (
    control, correlate, enrich, events, forecast, ingest, kpi, quality, spatial, timeseries, weather,
)
from ..session import pin_utc, scratch_dir
from ..sources import feeds, landing
from ..streaming import cooldown, live, run, sideinput, stateful, supervise
from . import tables as T
from . import updates
from .batch import Inputs, run_batch, stored_monthly, write_batch

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
STREAM_START = datetime(2024, 1, 10)


def query(fn: Query) -> Query:
    """Register a query under its function name; dates leave as ISO text."""

    def call(spark: SparkSession, sf: str) -> DataFrame:
        df = fn(pin_utc(spark), sf)
        days = {f.name: F.col(f.name).cast("string") for f in df.schema if f.dataType == DateType()}
        return df.withColumns(days) if days else df

    QUERIES[fn.__name__] = call
    return fn


def _doubles(df: DataFrame, *names: str) -> DataFrame:
    return df.withColumns({n: S.to_double(F.col(f"`{n}`")) for n in names})


# ---- sources --------------------------------------------------------------------
def _grid(pages: DataFrame, feed: feeds.Feed) -> DataFrame:
    return feeds.records(feeds.parse_pages(pages, feed), feed)


@query
def scan_demand(spark, sf):
    found = feeds.demand(
        _grid(T.demand_pages(spark, sf), feeds.DEMAND),
        ["PURCHASE", "VIEW"], "2024-01-05T00", "2024-01-25T23",
    )
    return _doubles(found, "value").select("period", "respondent", "type", "value")


@query
def scan_demand_subregions(spark, sf):
    found = feeds.demand(
        _grid(T.demand_pages(spark, sf), feeds.DEMAND),
        ["PURCHASE", "VIEW"], subregions=["Z1", "Z4"],
    )
    return _doubles(found, "value").select("period", "parent", "subba", "value")


@query
def scan_generation_by_fuel(spark, sf):
    found = feeds.fuel_generation(
        _grid(T.fuel_pages(spark, sf), feeds.FUEL_GENERATION), ["CLICK", "ERROR"],
        start="2024-01-08T00",
    )
    return _doubles(found, "value").select("period", "respondent", "fueltype", "value")


@query
def scan_retail_sales(spark, sf):
    found = feeds.retail(
        _grid(T.retail_pages(spark, sf), feeds.RETAIL),
        ["NATION_1", "NATION_2", "NATION_7"], L.RETAIL_SECTORS, "1996-01", "2000-12",
    )
    numbers = ("sales", "revenue", "price", "customers")
    return _doubles(found, *numbers).select("period", "stateid", "sectorid", *numbers)


@query
def scan_facility_fuel(spark, sf):
    found = feeds.facility_fuel(
        _grid(T.facility_pages(spark, sf), feeds.FACILITY_FUEL), ["VA", "TX"], "1997-01"
    )
    return _doubles(found, "generation", "total-consumption").select(
        "period", "plantCode", "state", "fuel2002", "generation",
        F.col("total-consumption").alias("total_consumption"),
    )


@query
def latest_demand(spark, sf):
    found = feeds.latest_demand(
        _grid(T.demand_pages(spark, sf), feeds.DEMAND),
        F.lit(datetime(2024, 1, 30, 12)), ["SIGNUP", "ERROR", "CLICK"], 24,
    )
    return _doubles(found, "value").select("period", "respondent", "value")


@query
def page_demand(spark, sf):
    records = _grid(T.demand_pages(spark, sf), feeds.DEMAND).select("period", "respondent", "value")
    return _doubles(feeds.demand_page(records, "respondent", "value", offset=100, length=50), "value")


@query
def page_completeness(spark, sf):
    pages = feeds.parse_pages(T.requested_pages(spark, sf), feeds.DEMAND)
    return feeds.page_completeness(pages, "respondent")


def _market(pages: DataFrame, feed: feeds.Feed) -> DataFrame:
    return feeds.records(feeds.parse_pages(pages, feed), feed)


@query
def scan_lmp(spark, sf):
    nodes = [str(n) for n in range(1, 40)]
    found = feeds.market_range(
        _market(T.lmp_pages(spark, sf), feeds.LMP), feeds.LMP,
        "2024-01-03 00:00:00", "2024-01-28 00:00:00", nodes,
    )
    numbers = ("total_lmp_rt", "congestion_price_rt", "system_energy_price_rt")
    return _doubles(found, *numbers).select("datetime_beginning_ept", "pnode_id", *numbers)


@query
def scan_metered_load(spark, sf):
    found = feeds.market_range(
        _market(T.load_pages(spark, sf), feeds.METERED_LOAD), feeds.METERED_LOAD,
        "2024-01-03 00:00:00", "2024-01-20 00:00:00",
    )
    return _doubles(found, "mw")


@query
def scan_load_forecast(spark, sf):
    found = feeds.load_forecast(
        _market(T.forecast_pages(spark, sf), feeds.LOAD_FORECAST), F.lit(STREAM_START), 7
    )
    return _doubles(found, "forecast_load_mw")


@query
def scan_generation_mix(spark, sf):
    found = feeds.market_range(
        _market(T.load_pages(spark, sf), feeds.GENERATION_MIX), feeds.GENERATION_MIX,
        "2024-01-05 00:00:00", "2024-01-12 00:00:00",
    )
    return _doubles(found, "mw")


@query
def instantaneous_load(spark, sf):
    found = feeds.instant_load(_market(T.load_pages(spark, sf), feeds.INSTANT_LOAD))
    return _doubles(found, "instantaneous_load")


@query
def linked_pages(spark, sf):
    pages = feeds.parse_pages(T.load_pages(spark, sf), feeds.METERED_LOAD)
    kept = feeds.linked_pages(pages, "request", "page_no")
    return _doubles(kept.select("request", "page_no", F.inline("items")), "mw")


@query
def followed_pages(spark, sf):
    pages = feeds.parse_pages(T.chained_pages(spark, sf), feeds.METERED_LOAD)
    kept = feeds.followed_pages(pages, "request", "address", F.col("page_no") == 0)
    return _doubles(kept.select("request", "page_no", "position", F.inline("items")), "mw")


@query
def weather_pivot(spark, sf):
    return weather.pivot_measures(T.station_records(spark, sf))


def _landed(pages: DataFrame, feed: feeds.Feed) -> DataFrame:
    """Records of pages that were written to the shared folder, one page a line."""
    folder = scratch_dir(pages.sparkSession, "pages")
    landing.land_pages(pages, folder)
    return landing.read_feed(pages.sparkSession, folder, feed, lines=True)


@query
def landed_climate(spark, sf):
    return weather.pivot_measures(_landed(T.climate_pages(spark, sf), feeds.CLIMATE))


@query
def landed_stations(spark, sf):
    found = _landed(T.station_pages(spark, sf), feeds.STATIONS).select(
        F.col("id").cast("bigint").alias("station_id"),
        F.col("latitude").alias("lat"),
        F.col("longitude").alias("lon"),
    )
    return spatial.stations_near(found, 39.0438, -77.4874, 500)


@query
def stations_in_bbox(spark, sf):
    return spatial.stations_near(T.station_places(spark, sf), 39.0438, -77.4874, 500)


@query
def historical_baseline(spark, sf):
    moved = T.readings(spark, sf).withColumn(
        "timestamp", F.timestamp_add("YEAR", F.lit(19), F.col("timestamp"))
    )
    return kpi.baseline_comparison(landing.read_national_baseline(spark), moved)


def _landed_demand(spark, sf) -> DataFrame:
    return T.events(spark, sf).select(
        S.format_hour(F.col("ts")).alias("period"),
        F.upper("event_type").alias("respondent"),
        F.col("event_type").alias("respondent-name"),
        F.lit("D").alias("type"),
        F.lit("Demand").alias("type-name"),
        F.when(F.col("event_id") % 13 == 0, "n/a").otherwise(F.col("value").cast("string")).alias("value"),
        F.lit("megawatthours").alias("value-units"),
        F.col("ts").alias("landed_at"),
    )


def _ingested(records: DataFrame) -> DataFrame:
    now = F.lit(datetime(2024, 1, 30, 12))
    return ingest.ingest_demand(records, F.col("landed_at"), now, ["CLICK", "VIEW", "ERROR"])


@query
def ingest_demand(spark, sf):
    return _ingested(_landed_demand(spark, sf))


@query
def ingest_landed_days(spark, sf):
    folder = scratch_dir(spark, "landing")
    landing.land_by_day(_landed_demand(spark, sf), folder)
    return _ingested(landing.read_dataset(spark, folder))


@query
def ingest_retail(spark, sf):
    return ingest.ingest_retail(T.retail_records(spark, sf), F.col("landed_at"), start="1996-01")


@query
def ingest_data_centers(spark, sf):
    return ingest.ingest_registry(T.registry_records(spark, sf))


def _hourly_demand(source: DataFrame) -> DataFrame:
    records = source.select(
        S.format_hour(F.col("ts")).alias("period"),
        F.upper("event_type").alias("respondent"),
        F.lit("D").alias("type"),
        F.lit("Demand").alias("type_name"),
        F.lit(None).cast("string").alias("respondent_name"),
        F.col("value").alias("value"),
        F.lit("MWh").alias("value_units"),
        F.col("ts").alias("landed_at"),
    )
    return ingest.ingest_demand(records, F.col("landed_at"))


@query
def incremental_append(spark, sf):
    source = T.events(spark, sf)
    batch = _hourly_demand(source.where(F.col("ts") >= datetime(2024, 1, 10)))
    existing = _hourly_demand(source.where(F.col("ts") < datetime(2024, 1, 15)))
    return landing.new_rows(batch, existing, ["period", "respondent", "type"], "period").select(
        "period", "respondent", "type", "value", "ingestion_timestamp"
    )


# ---- projections ----------------------------------------------------------------
@query
def safe_cast(spark, sf):
    text = F.when(F.col("c_custkey") % 8 == 7, F.col("c_acctbal").cast("string")).otherwise(
        T.pick(T.NUMBER_TEXTS, F.col("c_custkey"))
    )
    return T.table(spark, sf, "customer").withColumn("t", text).select(
        "c_custkey",
        S.to_double(F.col("t")).alias("as_double"),
        S.to_double(F.col("t"), 1.3).alias("as_double_or_default"),
        S.to_bigint(F.col("t")).alias("as_bigint"),
        S.to_bigint(F.col("t"), 0).alias("as_bigint_or_default"),
    )


@query
def normalize_registry(spark, sf):
    return ingest.normalize_registry(T.registry_records(spark, sf))


@query
def classify_ai(spark, sf):
    raw = T.registry_records(spark, sf)
    return raw.select(
        "name", "owner", "gpu_count", "accelerator_count",
        S.is_ai_site(
            F.col("gpu_count"), F.col("accelerator_count"), F.col("owner"), F.col("name")
        ).alias("ai_focused"),
    )


@query
def normalize_status(spark, sf):
    status = F.when(F.col("c_custkey") % 11 != 0, T.pick(T.STATUSES, F.col("c_custkey")))
    return T.table(spark, sf, "customer").select("c_custkey", S.site_status(status).alias("status"))


@query
def normalize_readings(spark, sf):
    typed = ingest.type_demand(T.demand_records(spark, sf), F.col("landed_at"))
    return enrich.normalize_readings(typed)


@query
def period_to_utc(spark, sf):
    return T.demand_records(spark, sf).select(
        "period", "respondent",
        S.hour_to_utc(F.col("period"), F.col("respondent")).alias("utc"),
    )


@query
def calendar_months(spark, sf):
    return T.table(spark, sf, "orders").select(
        "o_orderkey", S.calendar_months(F.col("o_orderdate"), T.as_of()).alias("months")
    )


@query
def haversine(spark, sf):
    away = geo.distance_km(F.lit(39.0438), F.lit(-77.4874), F.col("lat"), F.col("lon"))
    return T.station_places(spark, sf).select("station_id", F.round(away, 6).alias("distance_km"))


@query
def bbox(spark, sf):
    box = geo.bounding_box(F.col("lat"), F.col("lon"), F.lit(50.0))
    edges = ("lat_min", "lon_min", "lat_max", "lon_max")
    return T.station_places(spark, sf).withColumn("b", box).select(
        "station_id", *[F.round(F.col("b")[e], 9).alias(e) for e in edges]
    )


@query
def fips_to_state(spark, sf):
    fips = F.lpad((F.col("c_custkey") % 60).cast("string"), 2, "0")
    return T.table(spark, sf, "customer").select(
        "c_custkey", fips.alias("fips"), S.state_of_fips(fips).alias("state")
    )


@query
def point_in_region(spark, sf):
    points = T.station_places(spark, sf).withColumnRenamed("station_id", "point_id")
    return spatial.region_of_point(points, T.region_rings(spark, sf))


@query
def unit_conversions(spark, sf):
    value = F.col("value")
    return T.events(spark, sf).select(
        "event_id",
        S.convert(value, L.MWH_TO_GWH).alias("gwh"),
        S.convert(value, L.MWH_TO_TWH).alias("twh"),
        S.convert(value, L.GWH_TO_TWH).alias("twh_from_gwh"),
        S.convert(value, L.KWH_TO_MWH).alias("mwh_from_kwh"),
        S.convert(value, L.MW_TO_GW).alias("gw"),
        S.convert(value, L.MW_TO_ANNUAL_MWH).alias("annual_mwh"),
    )


@query
def confidence_score(spark, sf):
    k = F.col("c_custkey")
    pre, post = k % 40, k % 14
    completeness = F.least(F.lit(1.0), (pre + post) / F.lit(48.0))
    capacity = F.when(k % 9 != 0, F.abs("c_acctbal") / 100 * F.when(k % 8 == 0, 0).otherwise(1))
    demand = F.when(k % 7 == 0, 0.0).otherwise((k % 50 + 1) * 20.0)
    return T.table(spark, sf, "customer").select(
        "c_custkey", S.confidence_score(pre, post, completeness, capacity, demand).alias("score")
    )


@query
def period_bounds(spark, sf):
    return events.period_bounds(events.online_sites(T.sites(spark, sf), T.as_of()), T.as_of()).select(
        "dc_id", "months_since_op", "pre_period_start", "pre_period_end", "post_period_start",
        "post_period_end", *events.PERIOD_MONTHS,
    )


@query
def severity_buckets(spark, sf):
    # whole numbers from -40 to 40, so the edges 10, 15 and 25 occur
    deviation = (F.col("event_id") % 81 - 40).cast("double")
    return T.events(spark, sf).select("event_id", deviation.alias("deviation_pct")).select(
        "*",
        S.severity(F.col("deviation_pct")).alias("severity"),
        S.anomaly_kind(F.col("deviation_pct")).alias("anomaly_type"),
        (F.abs("deviation_pct") > L.ANOMALY_PCT).alias("is_anomaly"),
    )


@query
def lmp_alerts(spark, sf):
    prices = live.live_pricing(T.price_records(T.events(spark, sf)), T.now())
    return prices.where("congestion_alert OR price_spike_alert").groupBy("pnode_id").agg(
        F.count_if("congestion_alert").alias("congestion_alerts"),
        F.count_if("price_spike_alert").alias("price_spike_alerts"),
        F.max("total_lmp").alias("max_lmp"),
    )


@query
def latency_seconds(spark, sf):
    return T.events(spark, sf).select(
        "event_id", S.latency_seconds(T.now(), F.col("ts")).alias("latency_seconds")
    )


@query
def source_mix(spark, sf):
    generation = T.fuel_generation(spark, sf).withColumn("year", F.year("timestamp"))
    mixed = quality.fuel_mix(generation, ["region_id", "year"])
    return mixed.select(
        "region_id", "year",
        F.explode(quality.read_fuel_mix(F.col("source_mix"))).alias("fueltype", "share"),
    )


@query
def target_regions(spark, sf):
    records = T.live_records(T.events(spark, sf))
    return live.target_regions(records, ("PURCHASE", "SIGNUP")).groupBy("respondent").agg(
        F.count("*").alias("n"), F.max("period").alias("last_period")
    )


@query
def row_size_guard(spark, sf):
    marked = live.split_oversized(T.live_records(T.events(spark, sf)), 65)
    return marked.groupBy("respondent", "accepted").agg(
        F.count("*").alias("n"), F.max("row_bytes").cast("bigint").alias("largest")
    )


def _guarded(spark, sf, accepted: bool) -> DataFrame:
    folder, records = scratch_dir(spark, "guarded"), T.live_records(T.stream_events(spark, sf))
    run.start_guarded(records, f"{folder}/rows", f"{folder}/checkpoint", 65).awaitTermination()
    return run.guarded(spark, f"{folder}/rows", records.schema, accepted)


@query
def accepted_rows(spark, sf):
    return _guarded(spark, sf, True)


@query
def rejected_rows(spark, sf):
    return _guarded(spark, sf, False)


# ---- joins ----------------------------------------------------------------------
@query
def enrich_regions(spark, sf):
    return enrich.enrich_regions(T.sites(spark, sf).drop("region_id")).select(
        "dc_id", "state", "balancing_authority", "region_id"
    )


@query
def weather_join(spark, sf):
    return enrich.join_weather(T.detailed_readings(spark, sf), T.weather(spark, sf))


def _bucketed(spark, df: DataFrame, keys: list[str]) -> DataFrame:
    path = scratch_dir(spark, "bucketed")
    name = path.rsplit("/", 1)[-1].replace("-", "_")
    return landing.save_bucketed(df, name, keys, 16, path)


@query
def stored_weather_join(spark, sf):
    """The weather join of readings and weather that were stored by region and day."""
    readings = T.detailed_readings(spark, sf).withColumn("day", F.to_date("timestamp"))
    stored = _bucketed(spark, readings, ["region_id", "day"])
    daily = _bucketed(spark, T.weather(spark, sf), ["region_id", "date"])
    return enrich.join_weather(stored, daily).drop("day")


@query
def stored_correlations(spark, sf):
    """The correlations of monthly demand and capacity that were stored by region and month."""
    monthly = _bucketed(spark, _monthly(spark, sf), ["region_id", "month"])
    timeline = _bucketed(spark, _timeline(spark, sf).withColumn("date", F.col("date").cast("timestamp")), ["region_id", "date"])
    return _rounded(correlate.regional_correlations(monthly, timeline, T.as_of()))


@query
def weather_join_fallback(spark, sf):
    partial = T.weather(spark, sf).drop("avg_temp_f")
    return enrich.join_weather(T.detailed_readings(spark, sf), partial)


def _events(spark, sf, **options) -> DataFrame:
    return events.site_events(T.readings(spark, sf), T.sites(spark, sf), T.as_of(), **options)


@query
def did_events(spark, sf):
    return _events(spark, sf)


@query
def did_events_one(spark, sf):
    return _events(spark, sf, window=18, dc_id="epoch_supplier#000000003")


def _monthly(spark, sf) -> DataFrame:
    return events.monthly_energy(T.readings(spark, sf))


def _timeline(spark, sf) -> DataFrame:
    return enrich.capacity_timeline(T.sites(spark, sf))


@query
def regional_correlations(spark, sf):
    return _rounded(correlate.regional_correlations(_monthly(spark, sf), _timeline(spark, sf), T.as_of()))


def _rounded(found: DataFrame) -> DataFrame:
    return found.withColumns(
        {c: F.round(c, 6) for c in ("pearson_total_dc", "pearson_ai_dc")}
    ).withColumn("data_points", F.col("data_points").cast("bigint"))


def _kpi(spark, sf) -> DataFrame:
    return kpi.kpi_summary(
        _monthly(spark, sf), _timeline(spark, sf), _events(spark, sf), T.now()
    )


@query
def kpi_summary(spark, sf):
    return _kpi(spark, sf)


@query
def nearest_station(spark, sf):
    return spatial.nearest_station(T.site_places(spark, sf), T.station_places(spark, sf))


@query
def market_ba(spark, sf):
    typed = ingest.type_demand(T.demand_records(spark, sf), F.col("landed_at"))
    served = typed.where(F.col("respondent").isin(ingest.authorities_of_markets()))
    counted = served.groupBy("respondent").agg(
        F.count("*").alias("readings"), F.max("period").alias("last_period")
    )
    return ingest.by_market(counted, "respondent")


@query
def region_weather(spark, sf):
    return weather.region_weather(weather.daily_degree_days(T.market_stations(spark, sf)))


def _controls(spark, sf) -> DataFrame:
    return control.match_control_regions(T.district_profiles(spark, sf), T.district_sites(spark, sf))


@query
def control_region(spark, sf):
    return _controls(spark, sf)


@query
def link_orphans(spark, sf):
    found = run_batch(batch_inputs(spark, sf), T.as_of(), T.now())
    return quality.link_orphans(
        found["data_centers"], found["events"], found["energy"], T.served_regions(spark, sf)
    )


@query
def link_navigate(spark, sf):
    return quality.navigate(_events(spark, sf), T.sites(spark, sf), "correlation-for-dc")


# ---- aggregations ---------------------------------------------------------------
@query
def monthly_energy(spark, sf):
    return _monthly(spark, sf)


@query
def capacity_timeline(spark, sf):
    return _timeline(spark, sf)


@query
def dedup_latest(spark, sf):
    source = T.events(spark, sf).select(
        F.date_trunc("hour", "ts").alias("hour"), "event_type", "user_id", "ts", "value"
    )
    return ingest.keep_latest(source, ["hour", "event_type"], "ts", "value", "user_id")


@query
def forecast_fit(spark, sf):
    return forecast.fit_impact(_events(spark, sf), T.sites(spark, sf))


def _rank_correlations(spark, sf) -> DataFrame:
    return correlate.rank_correlations(_monthly(spark, sf), _timeline(spark, sf))


@query
def spearman(spark, sf):
    return _rank_correlations(spark, sf).select(
        "region_id", F.round("spearman_total_dc", 6).alias("spearman_total_dc"), "data_points"
    )


@query
def corr_significance(spark, sf):
    rounded = [
        F.round(c, 6).alias(c) for c in ("pearson_total_dc", "t_statistic", "p_value")
    ]
    return _rank_correlations(spark, sf).select("region_id", *rounded, "significant")


@query
def events_with_correlation(spark, sf):
    filled = events.events_with_correlation(_events(spark, sf), _rank_correlations(spark, sf))
    rounded = ("pearson_correlation", "spearman_correlation", "p_value")
    return filled.select("event_id", "region_id", *[F.round(c, 6).alias(c) for c in rounded])


@query
def adjusted_delta(spark, sf):
    return control.adjusted_changes(
        T.district_readings(spark, sf), T.district_sites(spark, sf), _controls(spark, sf), T.as_of()
    )


@query
def weather_residual(spark, sf):
    found = weather.weather_residual(T.readings(spark, sf), T.weather(spark, sf))
    return found.withColumns({c: F.round(c, 4) for c in ("expected_mw", "residual_mw")})


@query
def degree_days(spark, sf):
    daily = weather.daily_degree_days(T.supplier_stations(spark, sf))
    return daily.select(
        "station", "date",
        F.round("cooling_degree_days", 6).alias("cooling_degree_days"),
        F.round("heating_degree_days", 6).alias("heating_degree_days"),
    )


@query
def kpi_cost_impact(spark, sf):
    sales = ingest.ingest_retail(
        T.retail_records(spark, sf), F.col("landed_at"), sectors=None, start=None
    )
    return kpi.cost_impact(T.readings(spark, sf), T.sites(spark, sf), sales, T.as_of())


@query
def kpi_per_capita(spark, sf):
    people = T.region_profiles(spark, sf).select("region_id", "population")
    return kpi.per_capita_increase(_events(spark, sf), people)


@query
def kpi_carbon_delta(spark, sf):
    return kpi.carbon_delta(
        T.fuel_generation(spark, sf), T.EMISSION, T.sites(spark, sf), T.as_of()
    )


@query
def kpi_renewable_ratio(spark, sf):
    return kpi.renewable_ratio(T.sites(spark, sf))


@query
def region_object(spark, sf):
    return kpi.region_objects(_kpi(spark, sf), T.region_profiles(spark, sf))


@query
def top_regions(spark, sf):
    return kpi.top_regions(_kpi(spark, sf), 5).select("region_id", "energy_delta_pct")


# ---- series ---------------------------------------------------------------------
@query
def demand_timeseries(spark, sf):
    return timeseries.demand_timeseries(T.hourly(spark, sf))


@query
def demand_change(spark, sf):
    series = T.hourly(spark, sf).select("region_id", "timestamp", "demand_mw")
    return timeseries.change_rate(series, "region_id", "timestamp", "demand_mw", ("demand_mw",))


@query
def price_acceleration(spark, sf):
    prices = T.events(spark, sf).select(
        "event_id", F.col("user_id").cast("string").alias("pnode_id"),
        F.col("ts").alias("timestamp"), (F.col("value") * 5).alias("total_lmp"),
    )
    return timeseries.acceleration(prices, "pnode_id", "timestamp", "total_lmp", ("event_id",))


@query
def rolling_deviation(spark, sf):
    return timeseries.rolling_deviation(T.hourly(spark, sf))


@query
def timeseries_long(spark, sf):
    return timeseries.long_form(T.detailed_readings(spark, sf), ("reading_id", "region_id", "timestamp"))


# ---- live data ------------------------------------------------------------------
def _stream_live(spark, sf) -> DataFrame:
    return live.live_demand(T.live_records(T.stream_events(spark, sf)), T.now())


@query
def live_demand(spark, sf):
    return run.drain(_stream_live(spark, sf), "live-demand")


def _seasonal(spark, sf) -> DataFrame:
    return live.month_of_year_baseline(events.monthly_energy(T.hourly(spark, sf)))


@query
def demand_anomalies(spark, sf):
    # stored once: a micro-batch reads twelve rows per region and not the history
    stored = scratch_dir(spark, "baseline")
    landing.write_dataset(_seasonal(spark, sf), stored)
    found = live.demand_anomalies(_stream_live(spark, sf), landing.read_dataset(spark, stored))
    return run.drain(found, "demand-anomalies")


@query
def versioned_anomalies(spark, sf):
    """Anomalies of a stream whose baseline is raised by a tenth on its way."""
    folder, seasonal = scratch_dir(spark, "versions"), _seasonal(spark, sf)
    side = sideinput.SideInput(spark, f"{folder}/baseline")
    raised = seasonal.withColumn("baseline_demand_mw", F.col("baseline_demand_mw") * 1.1)
    source = T.events(spark, sf)
    moments = [datetime(2024, 1, 1), datetime(2024, 1, 2)]
    for moment, table, later in zip(moments, (seasonal, raised), (False, True)):
        side.publish(table, moment)
        part = source.where(F.col("ts") >= STREAM_START) if later else source.where(F.col("ts") < STREAM_START)
        part.write.mode("append").parquet(f"{folder}/landed")
        landed = spark.readStream.schema(source.schema).parquet(f"{folder}/landed")
        readings = live.live_demand(T.live_records(landed), T.now())
        query = sideinput.start_with(readings, side, live.demand_anomalies, f"{folder}/out", clock=lambda m=moment: m)
        query.awaitTermination()
    wanted = live.demand_anomalies(live.live_demand(T.live_records(source), T.now()), seasonal).schema
    return sideinput.results(spark, f"{folder}/out", wanted)


@query
def demand_anomalies_batch(spark, sf):
    readings = live.live_demand(T.live_records(T.events(spark, sf)), T.now())
    return live.demand_anomalies(readings, _seasonal(spark, sf))


@query
def live_pricing(spark, sf):
    prices = live.live_pricing(T.price_records(T.stream_events(spark, sf)), T.now())
    return run.drain(prices, "live-pricing")


@query
def stream_dedup(spark, sf):
    keys = live.deduplicate(_stream_live(spark, sf), salts=4).select("reading_id", "region_id", "timestamp")
    return run.drain(keys, "stream-dedup")


@query
def stream_price_dedup(spark, sf):
    prices = live.live_pricing(T.price_records(T.stream_events(spark, sf)), T.now())
    keys = live.deduplicate_prices(prices, salts=4).select("pnode_id", "timestamp")
    return run.drain(keys, "stream-price-dedup")


def _stream_readings(spark, sf) -> DataFrame:
    return T.stream_events(spark, sf).select(
        F.col("event_type").alias("region_id"),
        F.col("ts").alias("timestamp"),
        F.col("value").alias("demand_mw"),
    )


@query
def stream_hourly(spark, sf):
    return run.drain(live.windowed_average(_stream_readings(spark, sf)), "stream-hourly")


@query
def stream_sliding(spark, sf):
    windows = live.windowed_average(_stream_readings(spark, sf), "7 days", "1 day")
    return run.drain(windows, "stream-sliding")


@query
def stream_change(spark, sf):
    return run.drain(stateful.demand_change(_stream_live(spark, sf)), "stream-change")


@query
def feed_health(spark, sf):
    """Counts and latency of the demand feed, as its supervised stream observed them."""
    folder, started = scratch_dir(spark, "feed-health"), []
    monitor, rows = supervise.Monitor(), supervise.watched(_stream_live(spark, sf))

    def start():
        started.append(run.start_available(rows, f"{folder}/rows", f"{folder}/checkpoint"))
        return started[-1]

    spark.streams.addListener(monitor)
    try:
        supervise.supervise(start, supervise.DEMAND)
        health = monitor.settled(started[-1])
    finally:
        spark.streams.removeListener(monitor)
    stored = spark.read.schema(rows.schema).parquet(f"{folder}/rows").agg(F.count("*").alias("stored_rows"))
    return stored.select(
        F.lit(health.rows).alias("observed_rows"), "stored_rows",
        F.lit(health.late_rows).alias("late_rows"),
        F.lit(health.max_latency_s).cast("double").alias("max_latency_s"),
    )


@query
def alert_cooldown(spark, sf):
    return run.drain(stateful.alert_cooldown(_stream_readings(spark, sf)), "alert-cooldown")


@query
def alert_cooldown_batch(spark, sf):
    return cooldown.alert_cooldown_history(T.hourly(spark, sf))


# ---- forecast and objects -------------------------------------------------------
def _forecast_regions(spark, sf) -> DataFrame:
    current = kpi.current_demand(_monthly(spark, sf)).withColumnRenamed(
        "current_avg_demand_mw", "current_demand_mw"
    )
    planned = forecast.planned_capacity(T.sites(spark, sf))
    return current.join(planned, "region_id", "left").fillna(0.0, ["planned_dc_capacity_mw"])


@query
def forecast_predict(spark, sf):
    return forecast.predict(_forecast_regions(spark, sf), 5)


@query
def forecast_impact(spark, sf):
    return forecast.predict(
        _forecast_regions(spark, sf), 3, impact=forecast.fit_impact(_events(spark, sf))
    )


@query
def object_key_checks(spark, sf):
    readings = enrich.normalize_readings(
        ingest.type_demand(T.demand_records(spark, sf), F.col("landed_at"))
    )
    checks = [
        quality.object_issues(readings, "energy-reading"),
        quality.object_issues(T.sites(spark, sf), "data-center"),
        quality.object_issues(_events(spark, sf), "correlation-event"),
        quality.object_issues(region_object(spark, sf), "energy-region"),
    ]
    out = checks[0]
    for more in checks[1:]:
        out = out.unionByName(more)
    return out


@query
def flagged_anomalies(spark, sf):
    readings = live.live_demand(T.live_records(T.events(spark, sf)), T.now())
    found = live.demand_anomalies(readings, _seasonal(spark, sf)).drop("processing_timestamp")
    # one flag per region and day, on its noon reading
    flags = (
        T.hourly(spark, sf)
        .select("region_id", F.date_trunc("day", "timestamp").alias("day"))
        .distinct()
        .select(
            "region_id",
            F.timestamp_add("HOUR", F.lit(12), F.col("day")).alias("timestamp"),
            F.concat(F.lit("check "), "region_id").alias("notes"),
        )
    )
    return quality.flag_anomalies(found, flags)


# ---- the whole batch job --------------------------------------------------------
def batch_inputs(spark, sf) -> Inputs:
    daily = weather.daily_degree_days(T.market_stations(spark, sf))
    return Inputs(
        demand=T.demand_records(spark, sf),
        registry=T.registry_records(spark, sf),
        weather=weather.region_weather(daily),
        demand_ingested_at=F.col("landed_at"),
    )


@query
def batch_events(spark, sf):
    return run_batch(batch_inputs(spark, sf), T.as_of(), T.now())["events"]


@query
def batch_kpi(spark, sf):
    return run_batch(batch_inputs(spark, sf), T.as_of(), T.now())["kpi_summary"]


@query
def batch_forecasts(spark, sf):
    return run_batch(batch_inputs(spark, sf), T.as_of(), T.now())["demand_forecasts"]


# ---- late records ---------------------------------------------------------------
def _late(records: DataFrame) -> Column:
    """Batch 0, most records, or one of two later ones, whatever their period."""
    chance = F.pmod(F.xxhash64("period", "respondent", "value"), F.lit(40))
    return F.when(chance == 7, 1).when((chance == 11) & (F.col("period") > "1998"), 2).otherwise(0)


def _updated(spark, sf) -> str:
    """Folder of batch tables that were written without the late records and then updated."""
    folder, inputs = scratch_dir(spark, "updated"), batch_inputs(spark, sf)
    records = inputs.demand.withColumn("_late", _late(inputs.demand))
    for number in range(3):
        part = replace(inputs, demand=records.where(F.col("_late") == number).drop("_late"))
        write = updates.update_batch if number else write_batch
        write(spark, part, T.as_of(), T.now(), folder)
    return folder


@query
def updated_monthly(spark, sf):
    return stored_monthly(spark, _updated(spark, sf))


@query
def updated_kpi(spark, sf):
    return landing.read_dataset(spark, f"{_updated(spark, sf)}/kpi_summary")


@query
def merged_monthly(spark, sf):
    folder, readings = scratch_dir(spark, "increments"), T.readings(spark, sf)
    year = F.year("timestamp") % 3
    for number in (0, 1, 2, 1):
        updates.add_increment(readings.where(year == number), folder, f"b{number}")
    return updates.stored_monthly(spark, folder)
