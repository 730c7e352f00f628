"""Domain tables derived by Spark from the star-schema test tables.

Orders act as demand readings, suppliers as sites, line items as weather and retail
records, events as live records.  ``oracle.py`` states the same derivations in SQL.
"""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType, TimestampNTZType, TimestampType

from ..functions import lookups as L
from ..functions import scalar as S
from ..functions.exact import exact_avg, exact_sum, running_sum
from ..operators import weather as W

AS_OF = date(2001, 9, 1)
NOW = datetime(2024, 2, 1)

AUTHORITIES = (
    "PJM", "ERCO", "CISO", "SOCO", "BPAT", "MISO", "NEVP", "SRP", "PSCO", "TVA", "PACE", "SCEG",
)
STATES = (
    "VA", "TX", "CA", "GA", "OR", "IL", "NV", "AZ", "CO", "TN", "UT", "SC", "NY", "MD", "WA",
)
OWNERS = ("OpenAI", "Random Corp", "xAI", "Acme Hosting", "Google Cloud", "Metals Inc")
STATUSES = (
    "Operational", " online ", "Under Construction", "Announced", "expansion", "weird", "active",
)
NUMBER_TEXTS = ("12.5", " 7 ", "abc", "", "1e3", "12d", "-4", "96000.0", "1.0E7", "12.7")
FUELS = ("COL", "NG", "NUC", "SUN", "WND")
SECTOR_OF_SEGMENT = {
    "HOUSEHOLD": "RES", "BUILDING": "COM", "MACHINERY": "IND", "AUTOMOBILE": "TRA",
    "FURNITURE": "ALL",
}
FUEL_OF_PRIORITY = {
    "1-URGENT": "COL", "2-HIGH": "NG", "3-MEDIUM": "NUC", "4-NOT SPECIFIED": "SUN", "5-LOW": "WND",
}
# Emission factors in g/kWh are a parameter of the carbon operators.
EMISSION = {"COL": 1000.0, "NG": 440.0, "NUC": 0.0, "SUN": 0.0, "WND": 0.0}


def as_of() -> Column:
    return F.lit(AS_OF)


def now() -> Column:
    return F.lit(NOW)


_SCHEMAS: dict[str, StructType] = {}


def given_schema(spark: SparkSession, sf: str, name: str) -> StructType:
    """Schema of a given table with its zone-less timestamps taken as UTC.

    Read from the file once per path and process.  Declaring the type at the scan, rather
    than casting behind it, lets filters on time reach the Parquet reader.
    """
    path = f"{sf}/{name}.parquet"
    if path not in _SCHEMAS:
        utc = {TimestampNTZType(): TimestampType()}
        _SCHEMAS[path] = StructType(
            [
                StructField(f.name, utc.get(f.dataType, f.dataType), f.nullable)
                for f in spark.read.parquet(path).schema
            ]
        )
    return _SCHEMAS[path]


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.schema(given_schema(spark, sf, name)).parquet(f"{sf}/{name}.parquet")


def pick(values: tuple[str, ...], number: Column) -> Column:
    return F.get(F.array(*[F.lit(v) for v in values]), (number % len(values)).cast("int"))


def lat(key: Column, step: int) -> Column:
    return F.lit(25.0) + (key * step % 2400) / 100.0


def lon(key: Column, step: int) -> Column:
    return F.lit(-124.0) + (key * step % 5700) / 100.0


# ---- batch tables ---------------------------------------------------------------
def orders_by_nation(spark, sf) -> DataFrame:
    orders, customer, nation = (table(spark, sf, n) for n in ("orders", "customer", "nation"))
    return orders.join(customer, F.col("o_custkey") == F.col("c_custkey")).join(
        nation, F.col("c_nationkey") == F.col("n_nationkey")
    )


def readings(spark, sf) -> DataFrame:
    return orders_by_nation(spark, sf).select(
        F.lower("n_name").alias("region_id"),
        F.col("o_orderdate").alias("timestamp"),
        (F.col("o_totalprice") / 1000).alias("demand_mw"),
    )


def detailed_readings(spark, sf) -> DataFrame:
    """Readings with a temperature on every tenth of them, as one source delivers it."""
    return orders_by_nation(spark, sf).select(
        F.concat(F.lit("r"), F.col("o_orderkey")).alias("reading_id"),
        F.lower("n_name").alias("region_id"),
        F.col("o_orderdate").alias("timestamp"),
        (F.col("o_totalprice") / 1000).alias("demand_mw"),
        F.when(F.col("o_orderkey") % 10 == 0, 70.0).alias("temperature_f"),
        F.lit(None).cast("double").alias("cooling_degree_days"),
        (F.col("o_totalprice") / 5000).alias("price_per_mwh"),
    )


def demand_records(spark, sf) -> DataFrame:
    """Hourly demand records as landed, coded by balancing authority."""
    hour = F.timestamp_add("HOUR", (F.col("o_orderkey") % 24).cast("int"), F.col("o_orderdate"))
    return orders_by_nation(spark, sf).select(
        S.format_hour(hour).alias("period"),
        pick(AUTHORITIES, F.col("n_nationkey")).alias("respondent"),
        F.col("n_name").alias("respondent-name"),
        F.lit("D").alias("type"),
        F.lit("Demand").alias("type-name"),
        (F.col("o_totalprice") / 1000).cast("string").alias("value"),
        F.lit("megawatthours").alias("value-units"),
        F.col("o_orderdate").alias("landed_at"),
    )


def sites(spark, sf) -> DataFrame:
    supplier, nation = table(spark, sf, "supplier"), table(spark, sf, "nation")
    key = F.col("s_suppkey")
    return supplier.join(nation, F.col("s_nationkey") == F.col("n_nationkey")).select(
        F.concat(F.lit("epoch_"), F.lower(F.replace("s_name", F.lit(" "), F.lit("_")))).alias("dc_id"),
        F.col("s_name").alias("name"),
        F.lower("n_name").alias("region_id"),
        pick(STATES, F.col("s_nationkey")).alias("state"),
        (F.abs("s_acctbal") / 100).alias("capacity_mw"),
        (key % 3 == 0).alias("ai_focused"),
        F.when(key % 4 != 0, key * 100).alias("gpu_count"),
        F.date_add(F.lit(date(1998, 1, 1)), (key * 37 % 1300).cast("int")).alias("operational_date"),
        F.when(key % 5 == 4, "planned").otherwise("operational").alias("construction_status"),
        (key % 101).cast("double").alias("renewable_pct"),
    )


def registry_records(spark, sf) -> DataFrame:
    """Registry records as landed, each site twice, spelling and quality varying."""
    k = F.col("s_suppkey")
    opened = F.date_add(F.lit(date(1998, 1, 1)), (k * 37 % 1300).cast("int")).cast("string")
    text = lambda c: c.cast("string")
    none = F.lit(None).cast("string")
    return table(spark, sf, "supplier").withColumn(
        "copy", F.explode(F.array(F.lit(0), F.lit(1)))
    ).select(
        F.when(k % 7 != 0, F.concat(F.lit("Site "), text(k))).alias("id"),
        F.col("s_name").alias("name"),
        F.when(k % 6 != 5, pick(OWNERS, k)).alias("owner"),
        F.lit("Holding").alias("company"),
        none.alias("operator"),
        F.when(k % 2 == 0, text(lat(k, 37))).alias("latitude"),
        text(lat(k, 37)).alias("lat"),
        none.alias("longitude"),
        F.when(k % 3 == 0, text(lon(k, 53))).alias("lon"),
        text(lon(k, 53)).alias("lng"),
        none.alias("county_fips"),
        pick(STATES, F.col("s_nationkey")).alias("state"),
        F.when(k % 9 == 8, "n/a").when(k % 9 != 7, text(F.abs("s_acctbal") / 100)).alias(
            "power_capacity_mw"
        ),
        text(F.col("copy") + 20).alias("capacity_mw"),
        none.alias("it_load_mw"),
        F.when(k % 4 == 1, "1.2").alias("pue"),
        F.when(k % 4 == 2, text(k * 100)).alias("gpu_count"),
        F.when(k % 8 == 3, text(k)).alias("accelerator_count"),
        none.alias("gpu_type"),
        F.when(k % 4 == 2, "H100").alias("accelerator_type"),
        F.when(k % 11 == 0, "soon").when(k % 2 == 0, opened).alias("operational_date"),
        opened.alias("online_date"),
        none.alias("construction_start"),
        F.lit("1997-06-01").alias("groundbreaking"),
        pick(STATUSES, k).alias("status"),
        F.when(k % 5 == 0, "12.7").otherwise(text(k * 10)).alias("water_usage"),
        text(k % 101).alias("renewable_pct"),
        F.date_format(
            F.date_add(F.lit(date(2001, 1, 1)), F.col("copy") * (k % 3).cast("int")),
            "yyyy-MM-dd HH:mm:ss",
        ).alias("last_updated"),
    )


def _lineitem_by_supplier(spark, sf) -> DataFrame:
    """Line items with the region of their supplier.

    Suppliers are a small share of line items; Spark broadcasts them while they fit its
    size limit and shuffles both sides beyond it.
    """
    lineitem = table(spark, sf, "lineitem").select("l_suppkey", "l_quantity", "l_shipdate")
    place = table(spark, sf, "supplier").join(
        table(spark, sf, "nation"), F.col("s_nationkey") == F.col("n_nationkey")
    )
    return lineitem.join(
        place.select("s_suppkey", F.lower("n_name").alias("region_id")),
        F.col("l_suppkey") == F.col("s_suppkey"),
    )


def weather(spark, sf) -> DataFrame:
    daily = _lineitem_by_supplier(spark, sf).groupBy(
        "region_id", F.to_date("l_shipdate").alias("date")
    ).agg((exact_avg(F.col("l_quantity")) + 40).alias("avg_temp_f"))
    cooling, heating = W.degree_days_of(F.col("avg_temp_f"))
    return daily.withColumns({"cooling_degree_days": cooling, "heating_degree_days": heating})


def _daily_station(spark, sf, station: Column) -> DataFrame:
    quantity = F.col("l_quantity")
    daily = table(spark, sf, "lineitem").groupBy(
        station.alias("station"), F.to_date("l_shipdate").alias("date")
    ).agg(
        (exact_avg(quantity) + 40).alias("TAVG"),
        (F.max(quantity) + 40).alias("TMAX"),
        (F.min(quantity) + 40).alias("TMIN"),
    )
    cooling, heating = W.degree_days_of(F.col("TAVG"))
    season = (
        Window.partitionBy("station", "year")
        .orderBy("date")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    return daily.withColumn("year", F.year("date")).withColumns(
        {"CDSD": running_sum(cooling, season), "HDSD": running_sum(heating, season)}
    )


def _supplier_days(spark, sf) -> DataFrame:
    return _daily_station(spark, sf, F.concat(F.lit("S"), F.col("l_suppkey")))


def supplier_stations(spark, sf) -> DataFrame:
    return _supplier_days(spark, sf).drop("year")


def market_stations(spark, sf) -> DataFrame:
    names = tuple(s for stations in L.MARKET_STATIONS.values() for s in stations)
    return _daily_station(spark, sf, pick(names, F.col("l_suppkey"))).drop("year")


def station_records(spark, sf) -> DataFrame:
    """Station data in the long form of the feed."""
    wide = supplier_stations(spark, sf).withColumn("date", F.col("date").cast("string"))
    return wide.unpivot(["station", "date"], list(L.WEATHER_MEASURES), "datatype", "value")


def retail_records(spark, sf) -> DataFrame:
    """Monthly retail records per state and sector, three editions of each."""
    sold = (
        table(spark, sf, "lineitem")
        .select("l_orderkey", "l_quantity", "l_extendedprice", "l_returnflag")
        .join(
            orders_by_nation(spark, sf).select(
                "o_orderkey", "o_orderdate", "n_name", "c_mktsegment"
            ),
            F.col("l_orderkey") == F.col("o_orderkey"),
        )
    )
    sector = L.lookup(SECTOR_OF_SEGMENT, F.col("c_mktsegment"))
    edition = F.ascii("l_returnflag")
    return (
        sold.groupBy(
            F.date_format("o_orderdate", "yyyy-MM").alias("period"),
            F.col("n_name").alias("stateid"),
            sector.alias("sectorid"),
            edition.alias("edition"),
        )
        .agg(
            exact_sum(F.col("l_quantity")).alias("sales"),
            exact_sum(F.col("l_extendedprice")).alias("revenue"),
            F.count("*").cast("double").alias("customers"),
        )
        .select(
            "period",
            "stateid",
            F.col("stateid").alias("stateDescription"),
            "sectorid",
            F.col("sectorid").alias("sectorName"),
            "sales",
            "revenue",
            (F.col("revenue") / F.col("sales")).alias("price"),
            "customers",
            F.lit("MWh").alias("sales-units"),
            F.timestamp_add("DAY", F.col("edition"), F.try_to_timestamp("period", F.lit("yyyy-MM")))
            .alias("landed_at"),
        )
    )


def fuel_generation(spark, sf) -> DataFrame:
    return orders_by_nation(spark, sf).select(
        F.lower("n_name").alias("region_id"),
        F.col("o_orderdate").alias("timestamp"),
        L.lookup(FUEL_OF_PRIORITY, F.col("o_orderpriority")).alias("fueltype"),
        (F.col("o_totalprice") / 1000).alias("value"),
    )


def regions(spark, sf) -> DataFrame:
    """Every region, also one without inhabitants, sites or readings."""
    return table(spark, sf, "nation").select(F.lower("n_name").alias("region_id"))


def served_regions(spark, sf) -> DataFrame:
    """Every region whose authority has sent a demand record."""
    return demand_records(spark, sf).select(F.lower("respondent").alias("region_id")).distinct()


def region_profiles(spark, sf) -> DataFrame:
    """Inhabitants (customers) and a climate zone per region."""
    customer, nation = table(spark, sf, "customer"), table(spark, sf, "nation")
    people = customer.groupBy("c_nationkey").agg(F.count("*").alias("population"))
    return people.join(nation, F.col("c_nationkey") == F.col("n_nationkey")).select(
        F.lower("n_name").alias("region_id"),
        F.col("n_name").alias("region_name"),
        F.col("n_name").alias("states_covered"),
        "population",
        (F.col("n_nationkey") * 100.0).alias("area_sq_miles"),
        (F.col("n_nationkey") % 4).cast("int").alias("climate_zone"),
    )


#: Market segments of customers near which sites are built; the others have none.
SITE_SEGMENTS = ("BUILDING", "HOUSEHOLD", "MACHINERY")


def district(nation: Column, segment: Column) -> Column:
    return F.concat(F.lower(nation), F.lit("/"), F.lower(segment))


def district_readings(spark, sf) -> DataFrame:
    """Readings by the district, a nation's market segment, that the demand comes from."""
    return orders_by_nation(spark, sf).select(
        district(F.col("n_name"), F.col("c_mktsegment")).alias("region_id"),
        F.col("o_orderdate").alias("timestamp"),
        (F.col("o_totalprice") / 1000).alias("demand_mw"),
    )


def district_sites(spark, sf) -> DataFrame:
    """The sites by district."""
    number = F.regexp_extract("name", r"(\d+)$", 1).cast("bigint")
    return sites(spark, sf).withColumn(
        "region_id", district(F.col("region_id"), pick(SITE_SEGMENTS, number))
    )


def district_profiles(spark, sf) -> DataFrame:
    """Inhabitants (customers) and a climate zone per district."""
    customer, nation = table(spark, sf, "customer"), table(spark, sf, "nation")
    people = customer.groupBy("c_nationkey", "c_mktsegment").agg(F.count("*").alias("population"))
    return people.join(nation, F.col("c_nationkey") == F.col("n_nationkey")).select(
        district(F.col("n_name"), F.col("c_mktsegment")).alias("region_id"),
        "population",
        (F.col("n_nationkey") % 4).cast("int").alias("climate_zone"),
    )


# ---- places ---------------------------------------------------------------------
def site_places(spark, sf) -> DataFrame:
    k = F.col("s_suppkey")
    return table(spark, sf, "supplier").select(
        k.alias("site_id"), lat(k, 37).alias("lat"), lon(k, 53).alias("lon")
    )


def station_places(spark, sf) -> DataFrame:
    k = F.col("c_custkey")
    return table(spark, sf, "customer").select(
        k.alias("station_id"), lat(k, 17).alias("lat"), lon(k, 29).alias("lon")
    )


def region_rings(spark, sf) -> DataFrame:
    """A five-cornered area per nation, laid out on a five by five grid."""
    k = F.col("n_nationkey")
    x, y = F.lit(-124.0) + (k % 5) * 11.0, F.lit(25.0) + F.floor(k / 5) * 4.8
    corners = [(0.0, 0.0), (10.0, 0.0), (10.0, 4.0), (5.0, 4.7), (0.0, 4.0), (0.0, 0.0)]
    ring = F.array(*[
        F.struct((x + dx).alias("lon"), (y + dy).alias("lat")) for dx, dy in corners
    ])
    return table(spark, sf, "nation").select(F.lower("n_name").alias("region_id"), ring.alias("ring"))


# ---- live tables ----------------------------------------------------------------
def events(spark, sf) -> DataFrame:
    return table(spark, sf, "events").select("event_id", "ts", "user_id", "event_type", "value")


def live_records(source: DataFrame) -> DataFrame:
    return source.select(
        S.format_hour(F.col("ts")).alias("period"),
        F.upper("event_type").alias("respondent"),
        F.col("value").cast("string").alias("value"),
    )


def price_records(source: DataFrame, *more: Column) -> DataFrame:
    value = F.col("value")
    return source.select(
        *more,
        F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("datetime_beginning_ept"),
        F.col("user_id").cast("string").alias("pnode_id"),
        F.concat(F.lit("node_"), F.col("user_id")).alias("pnode_name"),
        F.when(F.col("event_id") % 50 != 0, (value * 5).cast("string")).alias("total_lmp_rt"),
        (value - 50).cast("string").alias("congestion_price_rt"),
        (value * 4).cast("string").alias("system_energy_price_rt"),
        F.when(F.col("event_id") % 40 == 0, "bad").otherwise((value / 10).cast("string")).alias(
            "marginal_loss_price_rt"
        ),
    )


def hourly(spark, sf) -> DataFrame:
    """Events as demand readings of five regions."""
    return events(spark, sf).select(
        F.col("event_type").alias("region_id"),
        F.col("ts").alias("timestamp"),
        F.col("value").alias("demand_mw"),
        F.when(F.col("user_id") % 2 == 0, F.col("user_id") + 0.5).alias("temperature_f"),
    )


def stream_events(spark, sf) -> DataFrame:
    """The events table as a file stream."""
    return (
        spark.readStream.schema(given_schema(spark, sf, "events"))
        .option("pathGlobFilter", "events.parquet")
        .parquet(sf)
    )


# ---- landed pages ---------------------------------------------------------------
def grid_pages(records: DataFrame, page: Column, *keep: str) -> DataFrame:
    """Grid API pages as JSON text; a page number bounds the records of one page."""
    fields = [c for c in records.columns if not c.startswith("_")]
    data = F.collect_list(F.struct(*fields)).alias("data")
    total = F.max("_total").alias("total")
    return (
        records.groupBy(page.alias("page_no"), *keep)
        .agg(data, total)
        .select(
            *keep, "page_no",
            F.to_json(F.struct(F.struct("data", "total").alias("response"))).alias("body"),
        )
    )


def result_pages(records: DataFrame, *page: Column) -> DataFrame:
    """Climate API pages as JSON text."""
    results = F.collect_list(F.struct(*records.columns)).alias("results")
    pages = records.groupBy(*[p.alias(f"_page{i}") for i, p in enumerate(page)]).agg(results)
    return pages.select(F.to_json(F.struct("results")).alias("body"))


def climate_pages(spark, sf) -> DataFrame:
    """Pages of one station and month each.

    Days are gathered whole and make their records, one for each measure, in the page.  The rows
    of a station and year already lie together, so their pages need no shuffle.
    """
    days = _supplier_days(spark, sf).withColumn("date", F.col("date").cast("string"))
    day = F.struct("station", "date", *L.WEATHER_MEASURES)
    pages = days.groupBy("station", "year", F.substring("date", 1, 7)).agg(F.collect_list(day).alias("days"))
    records = F.flatten(F.transform("days", _day_records))
    return pages.select(F.to_json(F.struct(records.alias("results"))).alias("body"))


def _day_records(day: Column) -> Column:
    """Records of a day as the feed has them."""
    named = [day[n].alias(n) for n in ("station", "date")]
    return F.array(
        *[
            F.struct(*named, F.lit(m).alias("datatype"), day[m].cast("string").alias("value"))
            for m in L.WEATHER_MEASURES
        ]
    )


def station_pages(spark, sf) -> DataFrame:
    stations = station_places(spark, sf).select(
        F.col("station_id").cast("string").alias("id"),
        F.concat(F.lit("station "), F.col("station_id")).alias("name"),
        F.col("lat").alias("latitude"),
        F.col("lon").alias("longitude"),
    )
    return result_pages(stations, F.floor(F.col("id").cast("bigint") / 500))


def event_page() -> Column:
    return F.floor(F.col("_id") / 500)


def demand_pages(spark, sf) -> DataFrame:
    records = events(spark, sf).select(
        F.col("event_id").alias("_id"),
        F.lit(None).cast("bigint").alias("_total"),
        S.format_hour(F.col("ts")).alias("period"),
        F.upper("event_type").alias("respondent"),
        F.col("event_type").alias("respondent-name"),
        F.lit("D").alias("type"),
        F.lit("Demand").alias("type-name"),
        F.upper("event_type").alias("parent"),
        F.concat(F.lit("Z"), F.col("user_id") % 10).alias("subba"),
        F.col("value").cast("string").alias("value"),
    )
    return grid_pages(records, event_page())


def requested_pages(spark, sf) -> DataFrame:
    """Demand pages with the total of their request; the last page of one request is lost."""
    source = events(spark, sf)
    totals = source.groupBy("event_type").agg(F.count("*").alias("_total"))
    records = source.join(totals, "event_type").select(
        F.col("event_id").alias("_id"),
        "_total",
        F.col("event_type").alias("respondent"),
        S.format_hour(F.col("ts")).alias("period"),
        F.col("value").cast("string").alias("value"),
    )
    kept = records.where(~((F.col("respondent") == "view") & (F.col("_id") < 500)))
    return grid_pages(kept, event_page(), "respondent")


def fuel_pages(spark, sf) -> DataFrame:
    records = events(spark, sf).select(
        F.col("event_id").alias("_id"),
        F.lit(None).cast("bigint").alias("_total"),
        S.format_hour(F.col("ts")).alias("period"),
        F.upper("event_type").alias("respondent"),
        pick(FUELS, F.col("user_id")).alias("fueltype"),
        F.col("value").cast("string").alias("value"),
    )
    return grid_pages(records, event_page())


def retail_pages(spark, sf) -> DataFrame:
    """One page per month and state: at most five sectors in three editions."""
    records = retail_records(spark, sf).select(
        F.lit(None).cast("bigint").alias("_total"),
        F.struct("period", "stateid").alias("_page"),
        "period", "stateid", "sectorid",
        *[F.col(c).cast("string").alias(c) for c in ("sales", "revenue", "price", "customers")],
    )
    return grid_pages(records, F.col("_page"))


def facility_pages(spark, sf) -> DataFrame:
    """Plant data: one page per plant and year, three fuels a month."""
    records = (
        table(spark, sf, "lineitem")
        .groupBy(
            "l_suppkey",
            F.date_format("l_shipdate", "yyyy-MM").alias("period"),
            F.col("l_returnflag").alias("fuel2002"),
        )
        .agg(
            exact_sum(F.col("l_quantity")).alias("generation"),
            exact_sum(F.col("l_extendedprice")).alias("total-consumption"),
        )
        .select(
            F.lit(None).cast("bigint").alias("_total"),
            F.struct("l_suppkey", F.substring("period", 1, 4)).alias("_page"),
            "period",
            F.col("l_suppkey").cast("string").alias("plantCode"),
            pick(STATES, F.col("l_suppkey")).alias("state"),
            "fuel2002",
            F.col("generation").cast("string").alias("generation"),
            F.col("total-consumption").cast("string").alias("total-consumption"),
        )
    )
    return grid_pages(records, F.col("_page"))


def market_pages(records: DataFrame) -> DataFrame:
    """Market API pages as JSON text, each naming the next one in a link.

    Request 3 has no link on its second page, so its chain ends there.
    """
    fields = [c for c in records.columns if not c.startswith("_")]
    paged = records.withColumns(
        {
            "request": F.floor(F.col("_id") / 5000),
            "page_no": (F.floor(F.col("_id") / 250) % 20).cast("int"),
        }
    )
    rel = F.when((F.col("request") == 3) & (F.col("page_no") == 1), "self").otherwise("next")
    link = F.struct(rel.alias("rel"), F.concat(F.lit("p"), F.col("page_no") + 1).alias("href"))
    return (
        paged.groupBy("request", "page_no")
        .agg(F.collect_list(F.struct(*fields)).alias("items"))
        .select(
            "request",
            "page_no",
            F.to_json(F.struct("items", F.array(link).alias("links"))).alias("body"),
        )
    )


def page_address(request: Column, page_no: Column) -> Column:
    """An address that says nothing about the order of pages."""
    return F.concat(F.lit("a"), (page_no * 7 + request * 3) % 23)


def chained_pages(spark, sf) -> DataFrame:
    """Load pages under addresses, each naming the next one's.

    The second page of request 0 names the fourth one before the third, and the last page of
    request 1 names the sixth one, so its chain is a cycle behind a stem.
    """
    request, page_no = F.col("request"), F.col("page_no")
    link = lambda n: F.struct(F.lit("next").alias("rel"), page_address(request, n).alias("href"))
    links = (
        F.when((request == 0) & (page_no == 1), F.array(link(F.lit(3)), link(F.lit(2))))
        .when((request == 1) & (page_no == 19), F.array(link(F.lit(5))))
        .otherwise(F.array(link(page_no + 1)))
    )
    item = "items array<struct<datetime_beginning_ept:string,zone:string,area:string,fuel_type:string,mw:string,instantaneous_load:string>>"
    parsed = F.from_json("body", item)
    return load_pages(spark, sf).select(
        "request", "page_no", page_address(request, page_no).alias("address"),
        F.to_json(F.struct(parsed["items"].alias("items"), links.alias("links"))).alias("body"),
    )


def lmp_pages(spark, sf) -> DataFrame:
    source = events(spark, sf)
    return market_pages(price_records(source, F.col("event_id").alias("_id")))


def _market_records(spark, sf, *columns: Column) -> DataFrame:
    return events(spark, sf).select(
        F.col("event_id").alias("_id"),
        F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("datetime_beginning_ept"),
        *columns,
    )


def load_pages(spark, sf) -> DataFrame:
    return market_pages(
        _market_records(
            spark, sf,
            F.upper("event_type").alias("zone"),
            F.upper("event_type").alias("area"),
            pick(FUELS, F.col("user_id")).alias("fuel_type"),
            F.col("value").cast("string").alias("mw"),
            F.col("value").cast("string").alias("instantaneous_load"),
        )
    )


def forecast_pages(spark, sf) -> DataFrame:
    return market_pages(
        _market_records(
            spark, sf,
            F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("forecast_datetime_beginning_ept"),
            F.upper("event_type").alias("forecast_area"),
            F.col("value").cast("string").alias("forecast_load_mw"),
        )
    )
