"""First layer: typed, deduplicated tables from landed records."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import lookups as L
from ..functions import scalar as S
from ..sources import feeds, schemas

# Registry fields as landed; every alternate spelling of a field is a column.
REGISTRY_RAW = (
    "id string, name string, owner string, company string, operator string, latitude string, "
    "lat string, longitude string, lon string, lng string, county_fips string, state string, "
    "power_capacity_mw string, capacity_mw string, it_load_mw string, pue string, "
    "gpu_count string, accelerator_count string, gpu_type string, accelerator_type string, "
    "operational_date string, online_date string, construction_start string, "
    "groundbreaking string, status string, water_usage string, renewable_pct string, "
    "last_updated string"
)


def keep_latest(df: DataFrame, keys: list[str], newest: str, *ties: str) -> DataFrame:
    """One row per key: the newest, ties resolved by further columns.

    The filter on row_number lets Spark cut each key to one row per task before the
    shuffle, so a key with very many copies stays small on the wire.
    """
    order = [F.col(newest).desc_nulls_last(), *[F.col(t).desc_nulls_last() for t in ties]]
    ranked = df.withColumn("_rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
    return ranked.where("_rank = 1").drop("_rank")


def _either(df: DataFrame, *names: str) -> Column:
    present = [F.col(f"`{n}`") for n in names if n in df.columns]
    return F.coalesce(*present) if present else F.lit(None).cast("string")


def _typed(df: DataFrame, schema) -> DataFrame:
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema])


def type_demand(records: DataFrame, ingested_at: Column) -> DataFrame:
    """Demand records in their table schema; a value that is no number becomes NULL."""
    named = records.select(
        "period",
        "respondent",
        _either(records, "respondent_name", "respondent-name").alias("respondent_name"),
        "type",
        _either(records, "type_name", "type-name").alias("type_name"),
        S.to_double(F.col("value")).alias("value"),
        _either(records, "value_units", "value-units").alias("value_units"),
        ingested_at.alias("ingestion_timestamp"),
    )
    return _typed(named, schemas.DEMAND_FEED)


def ingest_demand(
    records: DataFrame,
    ingested_at: Column,
    now: Column | None = None,
    authorities=None,
    overlap_hours: int = L.INGEST_OVERLAP_HOURS,
) -> DataFrame:
    """Hourly demand of the overlap window, one row per period, respondent and type."""
    if now is not None:
        oldest = S.format_hour(now - F.make_dt_interval(F.lit(0), F.lit(overlap_hours)))
        records = feeds.demand(records, authorities, oldest, S.format_hour(now))
    else:
        records = feeds.demand(records, authorities)
    typed = type_demand(records, ingested_at)
    return keep_latest(typed, ["period", "respondent", "type"], "ingestion_timestamp", "value")


def ingest_retail(
    records: DataFrame,
    ingested_at: Column,
    states=None,
    sectors=L.RETAIL_SECTORS,
    start: str | None = L.RETAIL_START,
) -> DataFrame:
    """Monthly retail sales, one row per period, state and sector."""
    chosen = feeds.retail(records, states, sectors, start)
    measures = [S.to_double(F.col(m)).alias(m) for m in ("sales", "revenue", "price", "customers")]
    named = chosen.select(
        "period", "stateid", "stateDescription", "sectorid", "sectorName",
        *measures,
        _either(chosen, "sales_units", "sales-units").alias("sales_units"),
        ingested_at.alias("ingestion_timestamp"),
    )
    typed = _typed(named, schemas.RETAIL_FEED)
    return keep_latest(typed, ["period", "stateid", "sectorid"], "ingestion_timestamp", "price")


def _first(*names: str, default: str | None = None) -> Column:
    columns = [F.col(n) for n in names]
    return F.coalesce(*columns, F.lit(default)) if default is not None else F.coalesce(*columns)


def normalize_registry(raw: DataFrame) -> DataFrame:
    """Registry records in the site schema.

    Alternate spellings are tried in turn.  A JSON reader cannot tell an absent field from
    a NULL one, so an explicit NULL also moves on to the next spelling.
    """
    slug = F.lower(F.replace(
        F.concat(F.lit("epoch_"), _first("id", "name", default="unknown")), F.lit(" "), F.lit("_")
    ))
    return raw.select(
        slug.alias("dc_id"),
        _first("name", default="Unknown").alias("name"),
        _first("owner", "company", default="Unknown").alias("owner"),
        _first("operator", "owner", default="Unknown").alias("operator"),
        S.to_double(_first("latitude", "lat")).alias("latitude"),
        S.to_double(_first("longitude", "lon", "lng")).alias("longitude"),
        "county_fips",
        _first("state", default="").alias("state"),
        S.to_double(_first("power_capacity_mw", "capacity_mw")).alias("capacity_mw"),
        S.to_double(F.col("it_load_mw")).alias("it_load_mw"),
        S.to_double(F.col("pue"), L.DEFAULT_PUE).alias("pue"),
        S.is_ai_site(
            F.col("gpu_count"), F.col("accelerator_count"), F.col("owner"), F.col("name")
        ).alias("ai_focused"),
        S.to_bigint(_first("gpu_count", "accelerator_count")).alias("gpu_count"),
        _first("gpu_type", "accelerator_type", default="").alias("gpu_type"),
        _first("operational_date", "online_date").try_cast("date").alias("operational_date"),
        _first("construction_start", "groundbreaking").try_cast("date").alias(
            "construction_start_date"
        ),
        S.site_status(F.col("status")).alias("construction_status"),
        S.to_bigint(F.col("water_usage")).alias("water_usage_gallons_annual"),
        S.to_double(F.col("renewable_pct")).alias("renewable_pct"),
        F.lit("epoch_ai").alias("data_source"),
        F.col("last_updated").try_cast("timestamp").alias("last_updated"),
    )


def ingest_registry(raw: DataFrame) -> DataFrame:
    """Normalized sites, the most recent record of each."""
    sites = normalize_registry(raw)
    ties = [f.name for f in schemas.REGISTRY if f.name not in ("dc_id", "last_updated")]
    return keep_latest(sites, ["dc_id"], "last_updated", *ties)


def authorities_of_markets() -> list[str]:
    """Distinct balancing authorities of the configured markets."""
    return sorted(reduce(set.union, (set(a) for a in L.MARKET_AUTHORITIES.values()), set()))


def by_market(df: DataFrame, authority: str = "balancing_authority") -> DataFrame:
    """Each row once per market its authority serves; other rows are left out."""
    markets: dict[str, list[str]] = {}
    for market, served in L.MARKET_AUTHORITIES.items():
        for code in served:
            markets.setdefault(code, []).append(market)
    pairs = [x for code, names in markets.items()
             for x in (F.lit(code), F.array(*[F.lit(n) for n in names]))]
    served_by = F.try_element_at(F.create_map(*pairs), F.col(authority))
    return df.withColumn("market", F.explode(served_by))
