"""Late records: what changes, and only that, is computed and written again.

``update_batch`` carries the changed months and regions from ingestion through monthly demand,
trailing averages, events and summary figures.  ``add_increment`` keeps monthly figures as sums
that merge, so that a month is known without reading its readings again.
"""

from __future__ import annotations

from datetime import date, datetime, timedelta

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import scalar as S
from ..functions.exact import DIGITS
from ..operators import events, timeseries
from ..session import cut
from ..sources import landing
from .batch import Inputs, run_batch, write_events, write_summaries

#: A trailing average reaches this far back, so a change reaches as far ahead.
REACH = timedelta(days=timeseries.LONGEST_DAYS)
NO_MONTH = None


# ---- what a batch changes -------------------------------------------------------
def newest(readings: DataFrame) -> DataFrame:
    """The newest version of each reading, with the rows that weather gives to it."""
    order = [F.col("ingestion_timestamp").desc_nulls_last(), F.col("demand_mw").desc_nulls_last()]
    ranked = readings.withColumn("_rank", F.rank().over(Window.partitionBy("reading_id").orderBy(*order)))
    return ranked.where("_rank = 1").drop("_rank").distinct()


def months_of(rows: DataFrame, column: str = "timestamp") -> list[str | None]:
    """Names of the month folders of some rows; there are few, however many rows."""
    found = rows.select(F.date_format(column, "yyyy-MM").alias("m")).distinct().collect()
    return sorted((r["m"] for r in found), key=lambda m: m or "")


def reached(months: list[str | None], back: bool = False) -> list[str | None]:
    """The months and those that a trailing average ties to them, after or before."""
    found: set[str | None] = set()
    for month in months:
        found.add(month)
        if month is not None:
            first = datetime.strptime(month, "%Y-%m")
            after = (first.replace(day=28) + timedelta(days=4)).replace(day=1)
            # the last moment of the month is before the next one's first
            span = [first - REACH, first] if back else [first, after + REACH - timedelta.resolution]
            at = span[0].replace(day=1)
            while at <= span[1]:
                found.add(at.strftime("%Y-%m"))
                at = (at.replace(day=28) + timedelta(days=4)).replace(day=1)
    return sorted(found, key=lambda m: m or "")


def in_months(df: DataFrame, months: list[str | None]) -> DataFrame:
    """Rows in some month folders; the others are not read."""
    named = F.col("month_part").isin([m for m in months if m is not None])
    return df.where(named | F.col("month_part").isNull() if NO_MONTH in months else named)


def replace_months(df: DataFrame, path: str, month_of: str) -> None:
    """Write month folders anew, and leave all others as they are."""
    balanced = df.withColumn("month_part", F.date_format(month_of, "yyyy-MM")).hint("rebalance", F.col("month_part"))
    writer = balanced.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy("month_part").parquet(path)


def stored_months(spark: SparkSession, path: str, months: list[str | None]) -> DataFrame:
    return in_months(landing.read_dataset(spark, path), months)


def update_batch(
    spark: SparkSession, inputs: Inputs, as_of: Column, snapshot: Column, folder: str
) -> dict[str, list[str | None]]:
    """Bring late demand records into the tables of ``write_batch``; the months written, by table.

    Readings replace older versions of themselves.  Months whose readings change are written
    again, with their monthly figures; trailing averages also in the months that 30 days reach;
    events of the regions that change, and of all if the day of analysis does.  Summary tables
    follow from stored monthly figures and events, and read no readings.  Sites stay as stored.
    A batch that brings nothing new writes nothing.
    """
    fresh = cut(run_batch(inputs, as_of, snapshot)["energy"])
    months = months_of(fresh)
    energy_path = f"{folder}/energy"
    stored = stored_months(spark, energy_path, months).select(*fresh.columns)
    merged = cut(newest(stored.unionByName(fresh)))
    changed = cut(merged.exceptAll(stored).select("region_id", "timestamp").distinct())
    months = months_of(changed)
    if not months:
        return {}
    month = F.date_format("timestamp", "yyyy-MM")
    replace_months(merged.withColumn("month_part", month).transform(in_months, months), energy_path, "timestamp")

    energy = stored_months(spark, energy_path, months).drop("month_part")
    replace_months(events.monthly_energy(energy), f"{folder}/energy_monthly", "month")

    ahead = reached(months)
    before = stored_months(spark, energy_path, reached(ahead, back=True)).drop("month_part")
    series = timeseries.demand_timeseries(before).withColumn("month_part", month)
    replace_months(in_months(series, ahead).drop("month_part"), f"{folder}/demand_timeseries", "timestamp")

    known = landing.read_dataset(spark, f"{folder}/events")
    today = spark.range(1).select(as_of.cast("date").alias("d")).first()["d"]
    if known.where(F.col("analysis_date") != F.lit(today)).isEmpty():
        regions = changed.select("region_id").distinct()
        kept = known.join(regions, "region_id", "left_anti").select(*known.columns)
        sites = landing.read_dataset(spark, f"{folder}/data_centers").join(regions, "region_id", "left_semi")
    else:
        kept, sites = None, landing.read_dataset(spark, f"{folder}/data_centers")
    write_events(spark, folder, sites, as_of, kept)
    write_summaries(spark, folder, as_of, snapshot)
    return {"energy": months, "energy_monthly": months, "demand_timeseries": ahead}


# ---- monthly figures that merge -------------------------------------------------
def monthly_parts(energy: DataFrame) -> DataFrame:
    """Per region and month what averages, counts and extremes can be merged from.

    What a decimal holds of a value is summed exactly, the rest beside it.
    """
    value = F.col("demand_mw")
    number = value.try_cast(f"decimal({DIGITS},6)")
    rest = value.cast("double") - F.coalesce(number.cast("double"), F.lit(0.0))
    return energy.groupBy("region_id", S.month_start(F.col("timestamp")).alias("month")).agg(
        F.sum(number).alias("whole"), F.sum(rest).alias("rest"), F.count(value).alias("values"),
        F.count("*").alias("readings"), F.min(value).alias("least"), F.max(value).alias("most"),
    )


def merged_parts(parts: DataFrame) -> DataFrame:
    return parts.groupBy("region_id", "month").agg(
        F.sum("whole").cast("decimal(38,6)").alias("whole"), F.sum("rest").alias("rest"),
        F.sum("values").alias("values"), F.sum("readings").alias("readings"),
        F.min("least").alias("least"), F.max("most").alias("most"),
    )


def monthly_of_parts(parts: DataFrame) -> DataFrame:
    """The columns of ``monthly_energy``, and the extremes, from parts of any number of batches."""
    total = F.coalesce(F.col("whole").cast("double"), F.lit(0.0)) + F.col("rest")
    return merged_parts(parts).select(
        "region_id", "month",
        (total / F.nullif(F.col("values"), F.lit(0)).cast("double")).alias("avg_demand_mw"),
        F.col("readings").alias("reading_count"),
        F.col("least").alias("min_demand_mw"), F.col("most").alias("max_demand_mw"),
    )


def add_increment(energy: DataFrame, path: str, batch: str) -> None:
    """Store the parts of a batch of new readings; the same batch again replaces itself."""
    parts = monthly_parts(energy).withColumn("batch", F.lit(batch))
    writer = parts.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy("batch").parquet(path)


def stored_monthly(spark: SparkSession, path: str) -> DataFrame:
    """Monthly figures of all batches so far: a row a region, month and batch is read."""
    return monthly_of_parts(landing.read_dataset(spark, path))


def compact(spark: SparkSession, path: str, target: str) -> None:
    """All batches as one, in a new folder; exact, so figures stay the same."""
    whole = merged_parts(landing.read_dataset(spark, path)).withColumn("batch", F.lit(f"to {date.today()}"))
    whole.write.mode("overwrite").partitionBy("batch").parquet(target)
