"""Landed API pages: envelopes, record extraction and feed filters.

A collector outside Spark stores each API response as one JSON document.  A feed names
the envelope of that document and the array with the records.  All pages of a request are
read in one job, whatever their number; paging limits of the service play no part in it.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import lookups as L
from ..functions import scalar as S
from ..session import cut


@dataclass(frozen=True)
class Feed:
    """Field list of one record, envelope around it, and the column that orders it."""

    record: str
    envelope: str
    path: str
    order: str

    @property
    def schema(self) -> str:
        return self.envelope.format(record=self.record)


_GRID = "response struct<data: array<struct<{record}>>, total: bigint>"
_MARKET = "items array<struct<{record}>>, links array<struct<rel: string, href: string>>"
_CLIMATE = "results array<struct<{record}>>"


def _grid(record: str) -> Feed:
    return Feed(record, _GRID, "response.data", "period")


def _market(record: str, order: str = "datetime_beginning_ept") -> Feed:
    return Feed(record, _MARKET, "items", order)


# Field names are fixed values of the published feeds; numbers arrive as text or number.
DEMAND = _grid(
    "period: string, respondent: string, `respondent-name`: string, type: string, "
    "`type-name`: string, parent: string, subba: string, value: string, `value-units`: string"
)
FUEL_GENERATION = _grid(
    "period: string, respondent: string, fueltype: string, value: string"
)
RETAIL = _grid(
    "period: string, stateid: string, stateDescription: string, sectorid: string, "
    "sectorName: string, sales: string, revenue: string, price: string, customers: string, "
    "`sales-units`: string"
)
FACILITY_FUEL = _grid(
    "period: string, plantCode: string, state: string, fuel2002: string, generation: string, "
    "`total-consumption`: string"
)
LMP = _market(
    "datetime_beginning_ept: string, pnode_id: string, pnode_name: string, "
    "total_lmp_rt: string, congestion_price_rt: string, system_energy_price_rt: string, "
    "marginal_loss_price_rt: string"
)
METERED_LOAD = _market("datetime_beginning_ept: string, zone: string, mw: string")
LOAD_FORECAST = _market(
    "forecast_datetime_beginning_ept: string, forecast_area: string, forecast_load_mw: string",
    "forecast_datetime_beginning_ept",
)
GENERATION_MIX = _market("datetime_beginning_ept: string, fuel_type: string, mw: string")
INSTANT_LOAD = _market("datetime_beginning_ept: string, area: string, instantaneous_load: string")
CLIMATE = Feed(
    "station: string, date: string, datatype: string, value: string", _CLIMATE, "results", "date"
)
STATIONS = Feed(
    "id: string, name: string, latitude: double, longitude: double", _CLIMATE, "results", "id"
)


#: Folder column of records landed by day.
DAY_PART = "day_part"


# ---- pages to records -----------------------------------------------------------
def parse_pages(pages: DataFrame, feed: Feed, body: str = "body") -> DataFrame:
    """Typed envelope columns from a JSON text column; other columns are kept."""
    rest = [c for c in pages.columns if c != body]
    return pages.select(*rest, F.from_json(body, feed.schema).alias("_e")).select(*rest, "_e.*")


def records(envelopes: DataFrame, feed: Feed) -> DataFrame:
    """One row per record of every page."""
    return envelopes.select(F.inline(feed.path))


def page_completeness(envelopes: DataFrame, request: str) -> DataFrame:
    """Rows received against the announced total, per request."""
    got = F.sum(F.size("response.data"))
    total = F.max("response.total")
    return envelopes.groupBy(request).agg(
        F.count("*").alias("pages"),
        got.alias("received"),
        total.alias("announced"),
        (got >= total).alias("complete"),
    )


def linked_pages(
    envelopes: DataFrame, request: str, page_no: str, max_pages: int | None = None
) -> DataFrame:
    """Pages a client following ``next`` links would read; ``max_pages`` per request if given.

    A chain ends at the first page that has no items or names no next page.
    """
    has_next = F.exists(F.coalesce("links", F.array()), lambda link: link["rel"] == "next")
    ends = (F.coalesce(F.size("items"), F.lit(0)) <= 0) | ~F.coalesce(has_next, F.lit(False))
    if max_pages is not None:
        envelopes = envelopes.where(F.col(page_no) < max_pages)
    # one row a request; pages are not gathered
    last = envelopes.groupBy(request).agg(F.min(F.when(ends, F.col(page_no))).alias("_last"))
    last = last.withColumnRenamed(request, "_request")
    # pages without a request are one chain, as in the grouping
    kept = envelopes.join(last, F.col(request).eqNullSafe(F.col("_request")))
    kept = kept.where(F.col("_last").isNull() | (F.col(page_no) <= F.col("_last")))
    return kept.select(*envelopes.columns)


def followed_pages(
    envelopes: DataFrame, request: str, address: str, first: Column, max_pages: int | None = None
) -> DataFrame:
    """Pages that following links reaches from the ``first`` one, with their ``position`` from 0.

    A page names the next one by the ``href`` of its first link with ``rel`` next, whatever
    the pages are numbered.  Pages are reached by pointer doubling: a round doubles the length
    of every page's jump, so a chain of n pages takes about log2(n) joins of addresses; bodies
    are joined once.

    * a chain ends at a page without items or without a next link, which is its last page, and
      where no page has the address;
    * a cycle ends where it would come back; a page keeps its first position;
    * of several pages of one address in a request, all are read, and the smallest next
      address among them is followed; a request without a first page has none.
    """
    onward = F.filter(F.coalesce("links", F.array()), lambda link: link["rel"] == "next")
    href = F.when(F.coalesce(F.size("items"), F.lit(0)) > 0, F.get(onward, F.lit(0))["href"])
    place = F.col(address).cast("string")
    # null requests are one request, as in a grouping
    group = F.struct(F.col(request).alias("of"))
    pages = envelopes.select(group.alias("g"), place.alias("a"), href.alias("to"), first.alias("first"))
    nodes = pages.where(F.col("a").isNotNull()).groupBy("g", "a").agg(F.min("to").alias("to"), F.max("first").alias("first"))
    nodes = cut(nodes)
    jumps = nodes.where(F.col("to").isNotNull()).select("g", "a", "to")
    known = nodes.select("g", F.col("a").alias("to"))
    jumps = cut(jumps.join(known, ["g", "to"], "left_semi").select("g", "a", "to"))
    reached = cut(nodes.where("first").select("g", "a", F.lit(0).cast("long").alias("position")))
    length, count = 1, reached.count()
    while max_pages is None or length < max_pages:
        on = reached.join(jumps, ["g", "a"]).select("g", F.col("to").alias("a"), (F.col("position") + length).alias("position"))
        reached = cut(reached.unionByName(on).groupBy("g", "a").agg(F.min("position").alias("position")))
        now = reached.count()
        if now == count:
            break
        after = jumps.select("g", F.col("a").alias("to"), F.col("to").alias("then"))
        jumps = cut(jumps.join(after, ["g", "to"]).select("g", "a", F.col("then").alias("to")))
        length, count = 2 * length, now
    if max_pages is not None:
        reached = reached.where(F.col("position") < max_pages)
    same = (group == F.col("g")) & (place == F.col("a"))
    found = envelopes.join(reached, same)
    return found.select(*envelopes.columns, "position")


# ---- feed filters ---------------------------------------------------------------
def only(df: DataFrame, column: str, values: Iterable[str] | None) -> DataFrame:
    """Rows whose column is one of ``values``; all rows when none are named."""
    return df.where(F.col(column).isin(*values)) if values else df


def between(df: DataFrame, column: str, start=None, end=None) -> DataFrame:
    """Rows from ``start`` to ``end``, both inclusive and optional."""
    if start is not None:
        df = df.where(F.col(column) >= start)
    return df if end is None else df.where(F.col(column) <= end)


def page(
    df: DataFrame,
    sort: str,
    *ties: str,
    descending: bool = True,
    offset: int = 0,
    length: int | None = None,
) -> DataFrame:
    """Rows in the order of a request; ``offset`` and ``length`` cut one page of them."""
    out = df.orderBy(F.col(sort).desc() if descending else F.col(sort), *ties)
    if offset:
        out = out.offset(offset)
    return out if length is None else out.limit(length)


def on_days(df: DataFrame, start=None, end=None) -> DataFrame:
    """Day folders that can hold hours from ``start`` to ``end``, of records landed by day.

    Records whose folder names no day are always read.
    """
    if DAY_PART not in df.columns:
        return df

    def day(hour):
        return F.substring(hour if isinstance(hour, Column) else F.lit(hour), 1, 10).try_cast("date")

    if start is not None:
        df = df.where(F.coalesce(F.col(DAY_PART) >= day(start), F.lit(True)))
    if end is not None:
        df = df.where(F.coalesce(F.col(DAY_PART) <= day(end), F.lit(True)))
    return df.drop(DAY_PART)


def demand(df: DataFrame, authorities=None, start=None, end=None, subregions=None) -> DataFrame:
    """Hourly demand of some authorities, or of sub-regions below them."""
    df = on_days(df, start, end)
    if subregions:
        df = only(only(df, "parent", authorities), "subba", subregions)
    else:
        df = only(df, "respondent", authorities)
    return between(df, "period", start, end)


def fuel_generation(df: DataFrame, authorities=None, start=None, end=None) -> DataFrame:
    return between(only(df, "respondent", authorities), "period", start, end)


def retail(df: DataFrame, states=None, sectors=None, start=None, end=None) -> DataFrame:
    return between(only(only(df, "stateid", states), "sectorid", sectors), "period", start, end)


def facility_fuel(df: DataFrame, states=None, start=None, end=None) -> DataFrame:
    return between(only(df, "state", states), "period", start, end)


def latest_demand(df: DataFrame, as_of: Column, authorities=None, hours_back: int = 24):
    """Demand of the last hours, newest first."""
    oldest = S.format_hour(as_of - F.make_dt_interval(F.lit(0), F.lit(hours_back)))
    recent = demand(df, authorities, oldest, S.format_hour(as_of))
    return page(recent, "period", "respondent")


def demand_page(df: DataFrame, *ties: str, offset: int = 0, length: int = L.PAGE_ROWS):
    """One page, newest first, of the length asked for; by default that of the service."""
    return page(df, "period", *ties, offset=offset, length=length)


def market_range(
    df: DataFrame, feed: Feed, start=None, end=None, nodes=None, rows: int | None = None
) -> DataFrame:
    """Market feed in a time range, optionally of some pricing nodes, newest first.

    ``rows`` cuts the range only where it is given.
    """
    df = only(between(df, feed.order, start, end), "pnode_id", nodes)
    ties = [c for c in df.columns if c != feed.order]
    return page(df, feed.order, *ties, length=rows)


def load_forecast(df: DataFrame, as_of: Column, days_ahead: int = 7) -> DataFrame:
    """Forecast rows from ``as_of`` up to some days ahead."""
    at = F.try_to_timestamp(F.col(LOAD_FORECAST.order))
    last = as_of + F.make_dt_interval(F.lit(days_ahead))
    return df.where((at >= as_of) & (at <= last))


def instant_load(df: DataFrame, rows: int = 100) -> DataFrame:
    return market_range(df, INSTANT_LOAD, rows=rows)
