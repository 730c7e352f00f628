"""Before/after analysis of demand around the opening of each site.

Every site has a period of baseline months before it opened and a period of months after.
Sites of one region that opened in the same month share those periods, so the averages are
computed once per distinct set of periods and handed back to the sites.  A popular region
therefore costs no more than a quiet one: the join with monthly demand sees (region, month)
keys only, and at most 49 months for each set of periods.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import lookups as L
from ..functions import scalar as S
from ..functions.exact import exact_avg

METHOD = "difference_in_differences_v1"
PERIOD_MONTHS = ["pre_from", "pre_to", "post_from", "post_to"]


def monthly_energy(energy: DataFrame) -> DataFrame:
    """Average demand and number of readings per region and month."""
    return energy.groupBy("region_id", S.month_start(F.col("timestamp")).alias("month")).agg(
        exact_avg(F.col("demand_mw")).alias("avg_demand_mw"),
        F.count("*").alias("reading_count"),
    )


def online_sites(sites: DataFrame, as_of: Column) -> DataFrame:
    """Operational sites with a date and region that have been open long enough."""
    months = F.months_between(as_of, F.col("operational_date")).cast("int")
    return sites.where(
        (F.col("construction_status") == "operational")
        & F.col("operational_date").isNotNull()
        & F.col("region_id").isNotNull()
        & (months >= L.MIN_POST_MONTHS)
    ).select(
        "dc_id",
        F.col("name").alias("dc_name"),
        "region_id",
        "operational_date",
        "capacity_mw",
        months.alias("months_since_op"),
    )


def period_bounds(
    online: DataFrame, as_of: Column, window: int = L.ANALYSIS_WINDOW_MONTHS
) -> DataFrame:
    """Add the period dates of each site and the whole months inside them.

    A month belongs to a period when its first day does, so the month of the opening
    belongs to neither period unless the site opened on the first of it.
    """
    opened = F.col("operational_date")
    return online.withColumns(
        {
            "pre_period_start": F.add_months(opened, -L.BASELINE_MONTHS),
            "pre_period_end": F.add_months(opened, -1),
            "post_period_start": opened,
            "post_period_end": F.least(F.add_months(opened, window), as_of),
        }
    ).withColumns(
        {
            "pre_from": S.first_month_from(F.col("pre_period_start")),
            "pre_to": F.trunc("pre_period_end", "MM"),
            "post_from": S.first_month_from(F.col("post_period_start")),
            "post_to": F.trunc("post_period_end", "MM"),
        }
    )


def period_stats(
    periods: DataFrame, monthly: DataFrame, value: str = "avg_demand_mw"
) -> DataFrame:
    """Average of a monthly value and number of months before and after, per period set.

    ``periods`` needs region_id and the four month columns; sets without a month on
    either side are left out.
    """
    keys = ["region_id", *PERIOD_MONTHS]
    months = F.sequence(
        "pre_from", F.greatest("pre_to", "post_to"), F.expr("INTERVAL 1 MONTH")
    )
    wanted = periods.select(*keys).distinct().withColumn("month", F.explode(months))
    values = monthly.select("region_id", F.to_date("month").alias("month"), F.col(value).alias("_v"))
    before = F.col("month") <= F.col("pre_to")
    after = F.col("month").between(F.col("post_from"), F.col("post_to"))
    return (
        wanted.join(values, ["region_id", "month"])
        .groupBy(*keys)
        .agg(
            exact_avg(F.when(before, F.col("_v")), 9).alias("pre_avg"),
            F.count_if(before).alias("pre_months"),
            exact_avg(F.when(after, F.col("_v")), 9).alias("post_avg"),
            F.count_if(after).alias("post_months"),
        )
        .where((F.col("pre_months") > 0) & (F.col("post_months") > 0))
    )


def site_changes(bounded: DataFrame, monthly: DataFrame) -> DataFrame:
    """Sites with their before/after averages and the change between them."""
    keys = ["region_id", *PERIOD_MONTHS]
    delta = F.col("post_avg") - F.col("pre_avg")
    return (
        bounded.join(period_stats(bounded, monthly), keys)
        .where(F.col("pre_avg").isNotNull() & F.col("post_avg").isNotNull())
        .withColumns(
            {
                "delta_demand_mw": delta,
                "delta_demand_pct": F.when(F.col("pre_avg") != 0, delta / F.col("pre_avg") * 100),
            }
        )
    )


def site_events(
    energy: DataFrame | None,
    sites: DataFrame,
    as_of: Column,
    window: int = L.ANALYSIS_WINDOW_MONTHS,
    dc_id: str | None = None,
    monthly: DataFrame | None = None,
) -> DataFrame:
    """One event per site: periods, averages, change, completeness and confidence.

    ``dc_id`` restricts the analysis to one site; the filter reaches the site scan.  Where
    ``monthly`` demand is known already, readings are not needed.
    """
    if monthly is None:
        monthly = monthly_energy(energy)
    if dc_id is not None:
        sites = sites.where(F.col("dc_id") == dc_id)
    bounded = period_bounds(online_sites(sites, as_of), as_of, window)
    changes = site_changes(bounded, monthly).withColumn(
        "data_completeness",
        S.data_completeness(
            F.col("pre_months"), F.col("post_months"), F.col("months_since_op"), window
        ),
    )
    score = S.confidence_score(
        F.col("pre_months"),
        F.col("post_months"),
        F.col("data_completeness"),
        F.col("capacity_mw"),
        F.col("pre_avg"),
        window,
    )
    return changes.select(
        F.concat_ws("_", F.lit("corr"), "dc_id", "region_id", as_of.cast("string")).alias(
            "event_id"
        ),
        "dc_id",
        "dc_name",
        "region_id",
        as_of.alias("analysis_date"),
        "pre_period_start",
        "pre_period_end",
        "post_period_start",
        "post_period_end",
        F.col("pre_avg").alias("pre_period_avg_demand_mw"),
        F.col("post_avg").alias("post_period_avg_demand_mw"),
        "delta_demand_mw",
        "delta_demand_pct",
        F.lit(None).cast("double").alias("pearson_correlation"),
        F.lit(None).cast("double").alias("spearman_correlation"),
        F.lit(None).cast("double").alias("p_value"),
        score.alias("confidence_score"),
        F.lit(None).cast("string").alias("control_region_id"),
        F.lit(None).cast("double").alias("control_delta_pct"),
        F.lit(None).cast("double").alias("adjusted_delta_pct"),
        F.lit(window).alias("analysis_window_months"),
        "data_completeness",
        F.lit(METHOD).alias("methodology"),
    )


def events_with_correlation(events: DataFrame, correlations: DataFrame) -> DataFrame:
    """Fill the correlation columns of events from the regional correlations."""
    found = correlations.select(
        "region_id",
        F.col("pearson_total_dc").alias("_r"),
        F.col("spearman_total_dc").alias("_rho"),
        F.col("p_value").alias("_p"),
    )
    filled = {
        "pearson_correlation": F.col("_r"),
        "spearman_correlation": F.col("_rho"),
        "p_value": F.col("_p"),
    }
    return events.join(found, "region_id", "left").select(
        *[filled.get(c, F.col(c)).alias(c) for c in events.columns]
    )
