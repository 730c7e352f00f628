"""Object types: schema and key checks, links between objects, and flags."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.schemas import LINK_TYPES, OBJECT_TYPES


def schema_issues(df: DataFrame, object_type: str) -> list[tuple[str, str]]:
    """Missing and extra columns and type mismatches, from metadata alone."""
    wanted = {f.name: f.dataType.simpleString() for f in OBJECT_TYPES[object_type]["schema"]}
    have = {f.name: f.dataType.simpleString() for f in df.schema}
    return (
        [("missing_column", c) for c in wanted if c not in have]
        + [("extra_column", c) for c in have if c not in wanted]
        + [("type_mismatch", c) for c in wanted if c in have and have[c] != wanted[c]]
    )


def object_issues(df: DataFrame, object_type: str) -> DataFrame:
    """One row per finding: schema findings, NULL keys and duplicate keys.

    ``n`` is 1 for schema findings and the number of rows for key findings.  Keys are
    counted with partial aggregation; only keys found more than once are summed up.
    """
    key = OBJECT_TYPES[object_type]["key"]
    counted = df.groupBy(F.col(key).alias("_k")).agg(F.count("*").alias("_n"))
    totals = counted.agg(
        F.coalesce(F.sum(F.when(F.col("_k").isNull(), F.col("_n"))), F.lit(0)).alias("null_key"),
        F.coalesce(
            F.sum(F.when(F.col("_k").isNotNull() & (F.col("_n") > 1), F.col("_n"))), F.lit(0)
        ).alias("duplicate_key"),
    )
    schema_rows = [
        F.struct(F.lit(kind).alias("finding"), F.lit(col).alias("column"), F.lit(1).cast("bigint").alias("n"))
        for kind, col in schema_issues(df, object_type)
    ]
    key_rows = [
        F.struct(F.lit(kind).alias("finding"), F.lit(key).alias("column"), F.col(kind).alias("n"))
        for kind in ("null_key", "duplicate_key")
    ]
    return (
        totals.select(F.explode(F.array(*schema_rows, *key_rows)).alias("_r"))
        .select(F.lit(object_type).alias("object_type"), "_r.*")
        .where("n > 0")
    )


def orphans(source: DataFrame, target: DataFrame, link: str) -> DataFrame:
    """Source objects whose link value names no target object."""
    source_type, target_type, prop = LINK_TYPES[link]
    key = OBJECT_TYPES[source_type]["key"]
    return (
        source.where(F.col(prop).isNotNull())
        .join(target.select(prop).distinct(), prop, "left_anti")
        .select(
            F.lit(link).alias("link_type"),
            F.col(key).alias("source_key"),
            F.col(prop).alias("missing_target"),
        )
    )


def link_orphans(
    sites: DataFrame, events: DataFrame, readings: DataFrame, regions: DataFrame
) -> DataFrame:
    """Orphans of all four links; ``sites`` and ``regions`` are the whole object tables."""
    return (
        orphans(sites, regions, "data-center-in-region")
        .unionByName(orphans(events, sites, "correlation-for-dc"))
        .unionByName(orphans(events, regions, "correlation-in-region"))
        .unionByName(orphans(readings, regions, "reading-for-region"))
    )


def navigate(source: DataFrame, target: DataFrame, link: str) -> DataFrame:
    """Source objects with the title of the object they link to, NULL when absent."""
    source_type, target_type, prop = LINK_TYPES[link]
    key = OBJECT_TYPES[source_type]["key"]
    title = OBJECT_TYPES[target_type]["title"]
    ends = target.select(F.col(prop).alias("_p"), F.col(title).alias("target_title"))
    return source.join(ends, F.col(prop) == F.col("_p"), "left").select(
        F.lit(link).alias("link_type"),
        F.col(key).alias("source_key"),
        F.col(prop).alias("target_key"),
        "target_title",
    )


def flag_anomalies(anomalies: DataFrame, flags: DataFrame) -> DataFrame:
    """Anomalies with the notes of the flags raised for their region and time."""
    noted = flags.select("region_id", "timestamp", "notes")
    return anomalies.join(noted, ["region_id", "timestamp"], "left").withColumn(
        "flagged", F.col("notes").isNotNull()
    )


def fuel_mix(generation: DataFrame, by: list[str]) -> DataFrame:
    """JSON text of each fuel's share, keys in alphabetical order.

    Generation is summed per fuel first, so the list of a group has one entry per fuel.
    """
    from ..functions.exact import exact_sum

    per_fuel = generation.groupBy(*by, "fueltype").agg(exact_sum(F.col("value")).alias("_v"))
    entry = F.struct(F.col("fueltype").alias("key"), F.col("_v").alias("value"))
    mixed = per_fuel.groupBy(*by).agg(
        F.array_sort(F.collect_list(entry)).alias("_fuels"), exact_sum(F.col("_v")).alias("_all")
    )
    share = F.transform(
        "_fuels",
        lambda e: F.struct(e["key"], F.round(F.try_divide(e["value"], F.col("_all")), 4)),
    )
    return mixed.select(*by, F.to_json(F.map_from_entries(share)).alias("source_mix"))


def read_fuel_mix(source_mix):
    """Fuel shares of a mix column as map<string,double>."""
    return F.from_json(source_mix, "map<string,double>")
