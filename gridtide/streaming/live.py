"""Stateless and windowed transformations of live records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import lookups as L
from ..functions import scalar as S
from ..functions.exact import exact_avg


def live_demand(records: DataFrame, now: Column | None = None) -> DataFrame:
    """Parsed demand records with a positive value, their id and their latency."""
    now = F.current_timestamp() if now is None else now
    at, region = S.parse_hour(F.col("period")), F.lower("respondent")
    return (
        records.withColumn("demand_mw", S.to_double(F.col("value")))
        .where(F.col("demand_mw") > 0)
        .select(
            S.stamp_id("live", region, at).alias("reading_id"),
            region.alias("region_id"),
            F.col("respondent").alias("balancing_authority"),
            at.alias("timestamp"),
            "demand_mw",
            now.alias("processing_timestamp"),
            S.latency_seconds(now, at).alias("latency_seconds"),
        )
    )


def target_regions(records: DataFrame, authorities=L.TARGET_REGIONS) -> DataFrame:
    return records.where(F.col("respondent").isin(*authorities))


def month_of_year_baseline(monthly: DataFrame) -> DataFrame:
    """Average of the monthly averages per region and month of the year."""
    return monthly.groupBy("region_id", F.month("month").alias("month_of_year")).agg(
        exact_avg(F.col("avg_demand_mw"), 9).alias("baseline_demand_mw")
    )


def demand_anomalies(live: DataFrame, baseline: DataFrame) -> DataFrame:
    """Readings more than the threshold away from the baseline of their month.

    ``baseline`` is that of ``month_of_year_baseline``, twelve rows per region; whether it is
    broadcast is left to Spark's size check.  Every micro-batch reads it again, so a stream
    should be given a stored one, written again when a month is complete.
    """
    baseline = baseline.withColumnRenamed("region_id", "_region")
    matched = live.join(
        baseline,
        (F.col("region_id") == F.col("_region"))
        & (F.month("timestamp") == F.col("month_of_year")),
        "left",
    )
    deviation = S.pct_change(F.col("demand_mw"), F.col("baseline_demand_mw"))
    return (
        matched.withColumn("deviation_pct", deviation)
        .where(F.abs("deviation_pct") > L.ANOMALY_PCT)
        .select(
            "region_id",
            "timestamp",
            "demand_mw",
            "baseline_demand_mw",
            "deviation_pct",
            S.severity(F.col("deviation_pct")).alias("severity"),
            S.anomaly_kind(F.col("deviation_pct")).alias("anomaly_type"),
            "processing_timestamp",
        )
    )


def live_pricing(records: DataFrame, now: Column | None = None) -> DataFrame:
    """Parsed prices with congestion and spike alerts; a missing price raises none."""
    now = F.current_timestamp() if now is None else now
    total, congestion = S.to_double(F.col("total_lmp_rt")), S.to_double(F.col("congestion_price_rt"))
    return records.select(
        F.try_to_timestamp("datetime_beginning_ept").alias("timestamp"),
        "pnode_id",
        "pnode_name",
        total.alias("total_lmp"),
        congestion.alias("congestion_lmp"),
        S.to_double(F.col("system_energy_price_rt")).alias("energy_lmp"),
        S.to_double(F.col("marginal_loss_price_rt")).alias("loss_lmp"),
        S.above(F.abs(congestion), L.CONGESTION_ALERT).alias("congestion_alert"),
        S.above(total, L.PRICE_SPIKE_ALERT).alias("price_spike_alert"),
        now.alias("processing_timestamp"),
    )


def deduplicate(
    live: DataFrame,
    keys: tuple[str, ...] = ("region_id", "timestamp"),
    delay: str = L.DEMAND_WATERMARK,
    salts: int = 1,
) -> DataFrame:
    """One arrival per key; keys are remembered until the watermark has passed them.

    With ``salts`` above 1, copies of a key are first reduced in that many groups, which
    spreads a reading that was sent very many times over as many tasks.
    """
    marked = live.withWatermark("timestamp", delay)
    if salts > 1:
        salt = F.pmod(F.spark_partition_id(), F.lit(salts))
        marked = (
            marked.withColumn("_salt", salt)
            .dropDuplicatesWithinWatermark([*keys, "_salt"])
            .drop("_salt")
        )
    return marked.dropDuplicatesWithinWatermark(list(keys))


def deduplicate_prices(prices: DataFrame, salts: int = 1) -> DataFrame:
    """One arrival per pricing node and time, within the watermark of the price feed."""
    return deduplicate(prices, ("pnode_id", "timestamp"), L.PRICE_WATERMARK, salts)


def windowed_average(
    live: DataFrame,
    length: str = "1 hour",
    slide: str | None = None,
    delay: str = L.DEMAND_WATERMARK,
) -> DataFrame:
    """Average demand per region over tumbling or sliding windows."""
    span = F.window("timestamp", length, slide) if slide else F.window("timestamp", length)
    return (
        live.withWatermark("timestamp", delay)
        .groupBy(span.alias("w"), "region_id")
        .agg(exact_avg(F.col("demand_mw")).alias("avg_demand_mw"), F.count("*").alias("readings"))
        .select(
            "region_id",
            F.col("w.start").alias("window_start"),
            F.col("w.end").alias("window_end"),
            "avg_demand_mw",
            "readings",
        )
    )


def split_oversized(records: DataFrame, max_bytes: int = L.MAX_ROW_BYTES) -> DataFrame:
    """Mark rows over the size limit, to be routed to a reject output."""
    size = S.row_bytes(*records.columns)
    return records.withColumn("row_bytes", size).withColumn("accepted", size <= max_bytes)
