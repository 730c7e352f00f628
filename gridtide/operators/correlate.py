"""Regional correlation of demand with site capacity."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import lookups as L
from ..functions import scalar as S


def demand_and_capacity(monthly: DataFrame, timeline: DataFrame) -> DataFrame:
    """Months in which a site came online, with demand and cumulative capacity."""
    capacity = timeline.select(
        "region_id",
        F.col("date").alias("month"),
        "cumulative_capacity_mw",
        "cumulative_ai_capacity_mw",
    )
    return monthly.select("region_id", "month", "avg_demand_mw").join(
        capacity, ["region_id", "month"]
    )


def regional_correlations(monthly: DataFrame, timeline: DataFrame, as_of: Column) -> DataFrame:
    """Pearson coefficients of regions with at least six joined months."""
    demand = F.col("avg_demand_mw")
    return (
        demand_and_capacity(monthly, timeline)
        .groupBy("region_id")
        .agg(
            S.pearson(demand, F.col("cumulative_capacity_mw")).alias("pearson_total_dc"),
            S.pearson(demand, F.col("cumulative_ai_capacity_mw")).alias("pearson_ai_dc"),
            F.count("*").cast("int").alias("data_points"),
        )
        .where(F.col("data_points") >= L.MIN_CORRELATION_MONTHS)
        .withColumn("analysis_date", as_of)
    )


def average_rank(value: str, *group: str) -> Column:
    """Rank with ties at their mean position."""
    ordered = Window.partitionBy(*group).orderBy(value)
    tied = Window.partitionBy(*group, value)
    return F.rank().over(ordered) + (F.count("*").over(tied) - 1) / 2.0


def rank_correlations(monthly: DataFrame, timeline: DataFrame) -> DataFrame:
    """Spearman coefficient, Pearson coefficient and its significance per region.

    A window sees the months of one region, so its size is bounded by the calendar.
    """
    pairs = demand_and_capacity(monthly, timeline).where(
        F.col("avg_demand_mw").isNotNull() & F.col("cumulative_capacity_mw").isNotNull()
    )
    ranked = pairs.withColumns(
        {
            "_rx": average_rank("avg_demand_mw", "region_id"),
            "_ry": average_rank("cumulative_capacity_mw", "region_id"),
        }
    )
    per_region = (
        ranked.groupBy("region_id")
        .agg(
            S.pearson(F.col("avg_demand_mw"), F.col("cumulative_capacity_mw")).alias(
                "pearson_total_dc"
            ),
            S.pearson(F.col("_rx"), F.col("_ry")).alias("spearman_total_dc"),
            F.count("*").alias("data_points"),
        )
        .where(F.col("data_points") >= L.MIN_CORRELATION_MONTHS)
    )
    r, n = F.col("pearson_total_dc"), F.col("data_points")
    t = S.t_statistic(r, n)
    p = F.when(F.abs(r) >= 1, 0.0).otherwise(S.two_sided_p(t, n - 2))
    return per_region.withColumns({"t_statistic": t, "p_value": p}).withColumn(
        "significant", F.col("p_value") < L.SIGNIFICANCE_LEVEL
    )
