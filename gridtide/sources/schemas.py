"""Schemas of every table (hand-written, nothing is inferred).

Column names and types are fixed values of the data model.
"""

from __future__ import annotations

from pyspark.sql import types as T

_TYPES = {
    "string": T.StringType(),
    "double": T.DoubleType(),
    "int": T.IntegerType(),
    "bigint": T.LongType(),
    "boolean": T.BooleanType(),
    "date": T.DateType(),
    "timestamp": T.TimestampType(),
}


def table_schema(text: str) -> T.StructType:
    """Schema from ``name type [not null]`` items; works before a session exists."""
    fields = []
    for item in text.split(","):
        name, kind, *rest = item.split()
        fields.append(T.StructField(name, _TYPES[kind], not rest))
    return T.StructType(fields)


DEMAND_FEED = table_schema(
    "period string, respondent string, respondent_name string, type string, type_name string, "
    "value double, value_units string, ingestion_timestamp timestamp"
)
REGISTRY = table_schema(
    "dc_id string not null, name string, owner string, operator string, latitude double, "
    "longitude double, county_fips string, state string, capacity_mw double, it_load_mw double, "
    "pue double, ai_focused boolean, gpu_count bigint, gpu_type string, operational_date date, "
    "construction_start_date date, construction_status string, "
    "water_usage_gallons_annual bigint, renewable_pct double, data_source string, "
    "last_updated timestamp"
)
RETAIL_FEED = table_schema(
    "period string, stateid string, stateDescription string, sectorid string, sectorName string, "
    "sales double, revenue double, price double, customers double, sales_units string, "
    "ingestion_timestamp timestamp"
)
NATIONAL_BASELINE = table_schema(
    "year int not null, dc_type string, consumption_twh double, pct_of_national double, "
    "is_projected boolean, source string"
)
READING = table_schema(
    "reading_id string, region_id string, balancing_authority string, timestamp timestamp, "
    "demand_mw double, generation_mw double, temperature_f double, cooling_degree_days double, "
    "price_per_mwh double, source_mix string, carbon_intensity_gco2_kwh double, "
    "data_source string, ingestion_timestamp timestamp"
)
WEATHER = table_schema(
    "region_id string, date date, avg_temp_f double, cooling_degree_days double, "
    "heating_degree_days double"
)
TIMELINE = table_schema(
    "region_id string, date timestamp, cumulative_capacity_mw double, "
    "cumulative_ai_capacity_mw double, cumulative_dc_count bigint, cumulative_gpu_count bigint, "
    "latest_dc_added string"
)
EVENT = table_schema(
    "event_id string not null, dc_id string, dc_name string, region_id string, "
    "analysis_date date, pre_period_start date, pre_period_end date, post_period_start date, "
    "post_period_end date, pre_period_avg_demand_mw double, post_period_avg_demand_mw double, "
    "delta_demand_mw double, delta_demand_pct double, pearson_correlation double, "
    "spearman_correlation double, p_value double, confidence_score double, "
    "control_region_id string, control_delta_pct double, adjusted_delta_pct double, "
    "analysis_window_months int, data_completeness double, methodology string"
)
LIVE_DEMAND_FEED = table_schema("period string, respondent string, value string")
LIVE_PRICE_FEED = table_schema(
    "datetime_beginning_ept string, pnode_id string, pnode_name string, total_lmp_rt string, "
    "congestion_price_rt string, system_energy_price_rt string, marginal_loss_price_rt string"
)

# Object types: schema, key, title; the reading also names its time-series values.
OBJECT_TYPES = {
    "energy-region": {
        "schema": table_schema(
            "region_id string, region_name string, states_covered string, population bigint, "
            "area_sq_miles double, baseline_demand_mw double, current_demand_mw double, "
            "demand_delta_pct double, total_dc_capacity_mw double, dc_count int"
        ),
        "key": "region_id",
        "title": "region_name",
    },
    "data-center": {
        "schema": table_schema(
            "dc_id string, name string, owner string, operator string, latitude double, "
            "longitude double, state string, county_fips string, capacity_mw double, "
            "it_load_mw double, pue double, ai_focused boolean, gpu_count bigint, "
            "gpu_type string, operational_date date, construction_status string, "
            "renewable_pct double, region_id string"
        ),
        "key": "dc_id",
        "title": "name",
    },
    "energy-reading": {
        "schema": table_schema(
            "reading_id string, region_id string, timestamp timestamp, demand_mw double, "
            "temperature_f double, price_per_mwh double, carbon_intensity_gco2_kwh double"
        ),
        "key": "reading_id",
        "title": "reading_id",
        "time": "timestamp",
        "values": ["demand_mw", "temperature_f", "price_per_mwh"],
    },
    "correlation-event": {
        "schema": table_schema(
            "event_id string, dc_id string, dc_name string, region_id string, "
            "analysis_date date, pre_period_avg_demand_mw double, "
            "post_period_avg_demand_mw double, delta_demand_mw double, delta_demand_pct double, "
            "pearson_correlation double, confidence_score double, adjusted_delta_pct double, "
            "methodology string"
        ),
        "key": "event_id",
        "title": "event_id",
    },
}

# Links: name -> (source type, target type, shared property); all many-to-one.
LINK_TYPES = {
    "data-center-in-region": ("data-center", "energy-region", "region_id"),
    "reading-for-region": ("energy-reading", "energy-region", "region_id"),
    "correlation-for-dc": ("correlation-event", "data-center", "dc_id"),
    "correlation-in-region": ("correlation-event", "energy-region", "region_id"),
}
