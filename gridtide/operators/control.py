"""Control regions: a similar region without sites, and the change adjusted by it."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import lookups as L
from . import events as E


def without_sites(profiles: DataFrame, sites: DataFrame) -> DataFrame:
    """Regions in which no site stands, whatever its state."""
    return profiles.join(sites.select("region_id").distinct(), "region_id", "left_anti")


def match_control_regions(
    profiles: DataFrame,
    sites: DataFrame,
    max_population_pct: float = L.MAX_POPULATION_DIFF_PCT,
    max_zone_gap: int = L.MAX_CLIMATE_ZONE_DIFF,
) -> DataFrame:
    """For each region with a site the region without one that is nearest in population.

    ``profiles`` has region_id, population and climate_zone; ``sites`` has region_id.  Only
    climate zones at most ``max_zone_gap`` apart are compared.

    Populations are laid out in logarithmic bands as wide as the limit, so the nearest
    candidate below or above stands in the region's own band or is the last or first one of
    a neighbouring band.  A task orders the different populations of one zone and band; no
    pairs of regions are formed, and of equal populations one row is ordered.
    """
    known = profiles.where(F.col("population").isNotNull() & F.col("climate_zone").isNotNull())
    active = known.join(sites.select("region_id").distinct(), "region_id", "left_semi")
    zone, share = F.col("climate_zone"), max_population_pct / 100
    # a limit of all inhabitants or more has no lower end, so all populations are one band
    width = -math.log1p(-share) if share < 1 else math.inf
    # a little wider than the limit, so that rounding leaves no candidate two bands away
    width = max(width, math.log1p(share), 1e-9) * (1 + 1e-9)
    band = F.when(F.col("population") > 0, F.floor(F.log("population") / F.lit(width))).otherwise(-(1 << 40))

    # the first by name stands for candidates of equal population
    candidates = (
        without_sites(known, sites)
        .withColumn("_zone", F.explode(F.sequence(zone - max_zone_gap, zone + max_zone_gap)))
        .groupBy("_zone", "population")
        .agg(F.min("region_id").alias("_name"))
        .withColumn("_band", band)
    )
    asked = active.select(zone.alias("_zone"), "population", band.alias("_band")).distinct()
    option = F.struct(F.col("population").alias("p"), F.col("_name").alias("r"))
    edges = candidates.groupBy("_zone", "_band").agg(F.min(option).alias("_first"), F.max(option).alias("_final"))

    both = asked.withColumn("_own", F.lit(None).cast("struct<p:bigint,r:string>")).withColumn("_asks", F.lit(1)).unionByName(
        candidates.select(
            "_zone", F.col("population"), "_band",
            F.struct(F.col("population").cast("bigint").alias("p"), F.col("_name").alias("r")).alias("_own"),
            F.lit(0).alias("_asks"),
        )
    )
    # candidates stand before the regions that ask, so one of equal population counts as below
    by_population = Window.partitionBy("_zone", "_band").orderBy("population", "_asks")
    below = by_population.rowsBetween(Window.unboundedPreceding, -1)
    above = by_population.rowsBetween(1, Window.unboundedFollowing)
    near = both.select(
        "_zone", "_band", "population", "_asks",
        F.last("_own", ignorenulls=True).over(below).alias("_lo"),
        F.first("_own", ignorenulls=True).over(above).alias("_hi"),
    ).where("_asks = 1")

    def neighbour(step: int, column: str, name: str) -> DataFrame:
        return edges.select("_zone", (F.col("_band") - step).alias("_band"), F.col(column).alias(name))

    near = near.join(neighbour(-1, "_final", "_under"), ["_zone", "_band"], "left").join(
        neighbour(1, "_first", "_over"), ["_zone", "_band"], "left"
    )

    def away(side: Column) -> Column:
        gap = F.abs(side["p"] - F.col("population"))
        return F.when(side.isNotNull(), F.struct(gap.alias("gap"), side["r"].alias("r"), side["p"].alias("p")))

    best = F.least(*[away(F.col(c)) for c in ("_lo", "_hi", "_under", "_over")])
    chosen = near.withColumn("_best", best).where(F.col("_best.gap") <= F.col("population") * share).select(
        F.col("_zone").alias("climate_zone"), "population",
        F.col("_best.r").alias("control_region_id"), F.col("_best.p").alias("control_population"),
    )
    return active.join(chosen, ["climate_zone", "population"]).select(
        "region_id", "control_region_id", "population", "control_population"
    )


def adjusted_changes(
    energy: DataFrame, sites: DataFrame, controls: DataFrame, as_of: Column
) -> DataFrame:
    """Change of each site less the change of its control region over the same periods."""
    monthly = E.monthly_energy(energy)
    bounded = E.period_bounds(E.online_sites(sites, as_of), as_of)
    own = E.site_changes(bounded, monthly).join(
        controls.select("region_id", "control_region_id"), "region_id"
    )
    keys = ["region_id", *E.PERIOD_MONTHS]
    moved = own.select(F.col("control_region_id").alias("region_id"), *E.PERIOD_MONTHS)
    control = E.period_stats(moved, monthly).select(
        F.col("region_id").alias("control_region_id"),
        *keys[1:],
        F.when(
            F.col("pre_avg") != 0, (F.col("post_avg") - F.col("pre_avg")) / F.col("pre_avg") * 100
        ).alias("control_delta_pct"),
    )
    return own.join(control, ["control_region_id", *keys[1:]]).select(
        "dc_id",
        "region_id",
        "control_region_id",
        "delta_demand_pct",
        "control_delta_pct",
        (F.col("delta_demand_pct") - F.col("control_delta_pct")).alias("adjusted_delta_pct"),
    )
