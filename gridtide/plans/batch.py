"""The whole batch job: landed records to events, forecasts and summary figures."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import lookups as L
from ..operators import correlate, enrich, events, forecast, ingest, kpi, timeseries
from ..session import cut
from ..sources import landing


@dataclass
class Inputs:
    """Landed records; ``weather`` is daily and regional."""

    demand: DataFrame
    registry: DataFrame
    weather: DataFrame | None = None
    demand_ingested_at: Column | None = None


def run_batch(
    inputs: Inputs, as_of: Column, snapshot: Column, years: int = 3
) -> dict[str, DataFrame]:
    """All batch tables by name, in dependency order and still lazy.

    Write them with ``write_batch``, or read one of them alone: unused branches cost nothing.
    """
    ingested = inputs.demand_ingested_at
    if ingested is None:
        ingested = F.lit(None).cast("timestamp")
    demand = ingest.ingest_demand(inputs.demand, ingested)
    sites = enrich.enrich_regions(ingest.ingest_registry(inputs.registry))
    energy = enrich.join_weather(enrich.normalize_readings(demand), inputs.weather)
    timeline = enrich.capacity_timeline(sites)
    monthly = events.monthly_energy(energy)
    site_events = events.site_events(energy, sites, as_of, monthly=monthly)
    summary = kpi.kpi_summary(monthly, timeline, site_events, snapshot)
    planned = forecast.planned_capacity(sites)
    regions = summary.select(
        "region_id", F.col("current_avg_demand_mw").alias("current_demand_mw")
    ).join(planned, "region_id", "left").fillna(0.0, ["planned_dc_capacity_mw"])
    return {
        "demand": demand,
        "data_centers": sites,
        "energy": energy,
        "energy_monthly": monthly,
        "capacity_timeline": timeline,
        "events": site_events,
        "regional_correlations": correlate.regional_correlations(monthly, timeline, as_of),
        "kpi_summary": summary,
        "demand_timeseries": timeseries.demand_timeseries(energy),
        "demand_forecasts": forecast.predict(
            regions, years, L.GROWTH_RATE, forecast.fit_impact(site_events)
        ),
    }


MONTH_OF = {"energy": "timestamp", "demand_timeseries": "timestamp"}


def write_batch(spark, inputs: Inputs, as_of: Column, snapshot: Column, folder: str) -> None:
    """Run the batch job layer by layer; later tables read what earlier ones wrote.

    Writing the readings and sites once cuts their lineage: an executor lost later does not
    bring back ingestion and weather join.  Readings are read twice more: for the monthly
    figures that all later tables use, and for the trailing averages.
    """
    first = run_batch(inputs, as_of, snapshot)
    for name in ("data_centers", "energy"):
        landing.write_dataset(first[name], f"{folder}/{name}", MONTH_OF.get(name))
    energy = landing.read_dataset(spark, f"{folder}/energy").drop("month_part")
    sites = landing.read_dataset(spark, f"{folder}/data_centers")
    landing.write_dataset(enrich.capacity_timeline(sites), f"{folder}/capacity_timeline")
    landing.write_dataset(events.monthly_energy(energy), f"{folder}/energy_monthly", "month")
    write_events(spark, folder, sites, as_of)
    landing.write_dataset(
        timeseries.demand_timeseries(energy), f"{folder}/demand_timeseries", "timestamp"
    )
    write_summaries(spark, folder, as_of, snapshot)


def stored_monthly(spark, folder: str) -> DataFrame:
    return landing.read_dataset(spark, f"{folder}/energy_monthly").drop("month_part")


def write_events(spark, folder: str, sites: DataFrame, as_of: Column, kept: DataFrame | None = None) -> None:
    """Events of some sites from the stored monthly demand, beside those that are kept."""
    found = events.site_events(None, sites, as_of, monthly=stored_monthly(spark, folder))
    if kept is not None:
        # the table is read and written: one row a site, written aside first
        found = cut(found.unionByName(kept))
    landing.write_dataset(found, f"{folder}/events")


def write_summaries(spark, folder: str, as_of: Column, snapshot: Column, years: int = 3) -> None:
    """The tables that follow from stored monthly demand, capacity and events."""
    sites = landing.read_dataset(spark, f"{folder}/data_centers")
    timeline = landing.read_dataset(spark, f"{folder}/capacity_timeline")
    monthly, found = stored_monthly(spark, folder), landing.read_dataset(spark, f"{folder}/events")
    landing.write_dataset(kpi.kpi_summary(monthly, timeline, found, snapshot), f"{folder}/kpi_summary")
    landing.write_dataset(
        correlate.regional_correlations(monthly, timeline, as_of), f"{folder}/regional_correlations"
    )
    regions = (
        landing.read_dataset(spark, f"{folder}/kpi_summary")
        .select("region_id", F.col("current_avg_demand_mw").alias("current_demand_mw"))
        .join(forecast.planned_capacity(sites), "region_id", "left")
        .fillna(0.0, ["planned_dc_capacity_mw"])
    )
    landing.write_dataset(
        forecast.predict(regions, years, impact=forecast.fit_impact(found)), f"{folder}/demand_forecasts"
    )
