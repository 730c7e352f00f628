"""Demand forecast per region."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import lookups as L
from ..functions.exact import exact_avg


def fit_impact(events: DataFrame, sites: DataFrame | None = None) -> DataFrame:
    """Average demand change per region over events of sufficient confidence.

    With ``sites`` the change per MW of site capacity is added as ``mw_per_site_mw``.
    """
    sure = events.where(F.col("confidence_score") >= L.MIN_CONFIDENCE)
    figures = [
        exact_avg(F.col("delta_demand_mw"), 9).alias("avg_delta_mw"),
        F.count("*").alias("event_count"),
    ]
    if sites is not None:
        sure = sure.join(sites.select("dc_id", "capacity_mw"), "dc_id", "left")
        ratio = F.when(F.col("capacity_mw") != 0, F.col("delta_demand_mw") / F.col("capacity_mw"))
        figures.append(exact_avg(ratio, 9).alias("mw_per_site_mw"))
    return sure.groupBy("region_id").agg(*figures)


def planned_capacity(sites: DataFrame) -> DataFrame:
    return (
        sites.where(F.col("construction_status").isin("planned", "under_construction"))
        .groupBy("region_id")
        .agg(
            F.sum(F.col("capacity_mw").try_cast("decimal(28,6)"))
            .cast("double")
            .alias("planned_dc_capacity_mw")
        )
    )


def predict(
    regions: DataFrame,
    years: int = 3,
    growth: float = L.GROWTH_RATE,
    impact: DataFrame | None = None,
) -> DataFrame:
    """Yearly demand of each region with planned capacity arriving in equal parts.

    ``regions`` has region_id, current_demand_mw and planned_dc_capacity_mw.  With
    ``impact`` (from ``fit_impact``) the factor of the region and the planned capacity
    weighted by it are added; regions without one use the default factor.
    """
    if years < 1:
        steps = F.array().cast("array<int>")
    else:
        steps = F.sequence(F.lit(1), F.lit(years))
    year, current = F.col("year_ahead"), F.col("current_demand_mw")
    baseline = current * F.pow(F.lit(1 + growth), year)
    added = F.col("planned_dc_capacity_mw") * F.least(F.lit(1.0), year / F.lit(float(max(years, 1))))
    total = baseline + added
    extra = []
    if impact is not None:
        regions = regions.join(
            impact.select("region_id", F.col("avg_delta_mw").alias("_factor")), "region_id", "left"
        )
        factor = F.coalesce("_factor", F.lit(L.DEFAULT_IMPACT_FACTOR))
        extra = [
            F.round(factor, 4).alias("impact_factor"),
            F.round(F.try_divide(added * factor, current), 4).alias("impact_weighted"),
        ]
    return regions.withColumn("year_ahead", F.explode(steps)).select(
        "region_id",
        "year_ahead",
        F.round(baseline, 1).alias("baseline_demand_mw"),
        F.round(added, 1).alias("dc_additional_demand_mw"),
        F.round(total, 1).alias("total_projected_demand_mw"),
        F.round(F.try_divide(total - current, current) * 100, 2).alias("demand_increase_pct"),
        *extra,
    )
