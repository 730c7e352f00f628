"""SQL counterparts of the registered queries, for an independent engine.

Each statement derives its domain tables from the given tables again, in SQL, and states
the result in the plainest way: whole-table windows, pairwise distances, recursion.
"""

from __future__ import annotations

import re

from ..functions import lookups as L
from . import tables as T

AS_OF = f"DATE '{T.AS_OF}'"
NOW = f"TIMESTAMP '{T.NOW}'"


def _list(values) -> str:
    return "[" + ", ".join(f"'{v}'" for v in values) + "]"


def _in(values) -> str:
    return "(" + ", ".join(f"'{v}'" for v in values) + ")"


def _pick(values, number: str) -> str:
    return f"{_list(values)}[CAST({number} AS BIGINT) % {len(values)} + 1]"


def _case(table: dict[str, str], key: str) -> str:
    whens = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in table.items())
    return f"CASE {key} {whens} END"


def _sum(value: str, scale: int = 6, over: str = "") -> str:
    part = f"TRY_CAST({value} AS DECIMAL(28,{scale}))"
    rest = f"{value} - coalesce(CAST({part} AS DOUBLE), 0)"
    return f"(coalesce(CAST(sum({part}) {over} AS DOUBLE), 0) + sum({rest}) {over})"


def _avg(value: str, scale: int = 6) -> str:
    return f"{_sum(value, scale)} / CAST(nullif(count({value}), 0) AS DOUBLE)"


def _hour(ts: str) -> str:
    return f"strftime({ts}, '%Y-%m-%dT%H')"


def _second(ts: str) -> str:
    return f"strftime({ts}, '%Y-%m-%d %H:%M:%S')"


def _parse_hour(period: str) -> str:
    return f"try_strptime({period}, '%Y-%m-%dT%H')"


def _km(lat1, lon1, lat2, lon2) -> str:
    chord = (
        f"(pow(sin(radians({lat2} - {lat1}) / 2), 2) + cos(radians({lat1})) * "
        f"cos(radians({lat2})) * pow(sin(radians({lon2} - {lon1}) / 2), 2))"
    )
    return f"2 * 6371.0 * atan2(sqrt({chord}), sqrt(1 - {chord}))"


def _severity(d: str) -> str:
    return f"CASE WHEN abs({d}) > 25 THEN 'HIGH' WHEN abs({d}) > 15 THEN 'MEDIUM' ELSE 'LOW' END"


def _kind(d: str) -> str:
    return f"CASE WHEN {d} > 0 THEN 'DEMAND_SPIKE' ELSE 'DEMAND_DROP' END"


def _pearson(x: str, y: str) -> str:
    a, b = f"CASE WHEN {y} IS NOT NULL THEN {x} END", f"CASE WHEN {x} IS NOT NULL THEN {y} END"
    return f"covar_pop({a}, {b}) / nullif(stddev_pop({a}) * stddev_pop({b}), 0)"


def _score(pre, post, completeness, capacity, demand, window=12) -> str:
    return (
        f"round(least(1.0::DOUBLE, greatest(0.0::DOUBLE, "
        f"0.3::DOUBLE * least(1.0::DOUBLE, ({completeness}) / 0.8::DOUBLE) "
        f"+ 0.2::DOUBLE * least(1.0::DOUBLE, ({pre})::DOUBLE / 36.0::DOUBLE) "
        f"+ 0.2::DOUBLE * least(1.0::DOUBLE, ({post})::DOUBLE / {window}.0::DOUBLE) "
        f"+ 0.3::DOUBLE * CASE WHEN ({demand}) > 0 AND ({capacity}) IS NOT NULL "
        f"THEN least(1.0::DOUBLE, ({capacity}) / ({demand}) / 0.1::DOUBLE) "
        f"ELSE 0.1::DOUBLE END)), 3)"
    )


def _number(t: str) -> str:
    pattern = "[+-]?([0-9]+([.][0-9]*)?|[.][0-9]+)([eE][+-]?[0-9]+)?"
    return f"CASE WHEN regexp_full_match(trim({t}), '{pattern}') THEN CAST(trim({t}) AS DOUBLE) END"


def _whole(t: str) -> str:
    number = f"TRY_CAST(trim({t}) AS DOUBLE)"
    return (
        f"CASE WHEN regexp_full_match(trim({t}), '[+-]?[0-9]+') THEN CAST(trim({t}) AS BIGINT) "
        f"WHEN regexp_full_match(trim({t}), '[+-]?[0-9]+[.][0-9]*([eE][+-]?[0-9]+)?') "
        f"AND {number} = floor({number}) AND abs({number}) < 9007199254740992 "
        f"THEN CAST({number} AS BIGINT) END"
    )


def _status(s: str) -> str:
    return f"coalesce({_case(L.STATUS_SYNONYMS, f'lower(trim({s}))')}, 'unknown')"


def _contains(text: str, parts) -> str:
    return "(" + " OR ".join(f"contains(lower(coalesce({text}, '')), '{p}')" for p in parts) + ")"


def _anomalies(baseline: str) -> str:
    return f"""
        SELECT region_id, "timestamp", demand_mw, baseline_demand_mw, deviation_pct,
               {_severity('deviation_pct')} AS severity, {_kind('deviation_pct')} AS anomaly_type,
               processing_timestamp
        FROM (SELECT *, CASE WHEN baseline_demand_mw > 0
                             THEN (demand_mw - baseline_demand_mw) / baseline_demand_mw * 100 END
                            AS deviation_pct
              FROM (SELECT l.*, {baseline} AS baseline_demand_mw FROM live l LEFT JOIN seasonal s
                    ON l.region_id = s.region_id AND month("timestamp") = month_of_year))
        WHERE abs(deviation_pct) > 10"""


_ADDED = "CAST(DATE '1998-01-01' + CAST(s_suppkey * 37 % 1300 AS INTEGER) AS DATE)"
_STATIONS = [s for names in L.MARKET_STATIONS.values() for s in names]
_STATION_REGIONS = sorted({
    (station, code.lower())
    for market, names in L.MARKET_STATIONS.items()
    for station in names
    for code in L.MARKET_AUTHORITIES[market]
})
_STATION_ROWS = ", ".join(f"('{s}', '{r}')" for s, r in _STATION_REGIONS)
_MARKET_ROWS = ", ".join(
    f"('{m}', '{c}')" for m, codes in L.MARKET_AUTHORITIES.items() for c in codes
)


def _degree(t: str) -> str:
    return (
        f"greatest(0.0::DOUBLE, {t} - 65) AS cooling_degree_days, "
        f"greatest(0.0::DOUBLE, 65 - {t}) AS heating_degree_days"
    )


def _daily_station(station: str) -> str:
    season = "OVER (PARTITION BY station, year(date) ORDER BY date ROWS UNBOUNDED PRECEDING)"
    return f"""
        SELECT station, date, TAVG, TMAX, TMIN,
               CAST(sum(CAST(cooling_degree_days AS DECIMAL(28,6))) {season} AS DOUBLE) AS CDSD,
               CAST(sum(CAST(heating_degree_days AS DECIMAL(28,6))) {season} AS DOUBLE) AS HDSD
        FROM (SELECT *, {_degree('TAVG')} FROM (
            SELECT {station} AS station, CAST(l_shipdate AS DATE) AS date,
                   {_avg('l_quantity')} + 40 AS TAVG, max(l_quantity) + 40 AS TMAX,
                   min(l_quantity) + 40 AS TMIN
            FROM lineitem GROUP BY 1, 2))"""


def _unseason(column: str) -> str:
    before = f"lag({column}) OVER (PARTITION BY station ORDER BY date)"
    return (
        f"CASE WHEN {before} IS NULL OR {column} < {before} THEN {column} "
        f"ELSE {column} - {before} END"
    )


# ---- domain tables --------------------------------------------------------------
CTES: dict[str, str] = {
    "by_nation": """
        SELECT * FROM orders JOIN customer ON o_custkey = c_custkey
        JOIN nation ON c_nationkey = n_nationkey""",
    "readings": """
        SELECT lower(n_name) AS region_id, o_orderdate AS "timestamp",
               o_totalprice / 1000 AS demand_mw FROM by_nation""",
    "detailed": """
        SELECT 'r' || o_orderkey AS reading_id, lower(n_name) AS region_id,
               o_orderdate AS "timestamp", o_totalprice / 1000 AS demand_mw,
               CASE WHEN o_orderkey % 10 = 0 THEN 70.0::DOUBLE END AS temperature_f,
               CAST(NULL AS DOUBLE) AS cooling_degree_days,
               o_totalprice / 5000 AS price_per_mwh
        FROM by_nation""",
    "demand_records": f"""
        SELECT {_hour('o_orderdate + to_hours(CAST(o_orderkey % 24 AS INTEGER))')} AS period,
               {_pick(T.AUTHORITIES, 'n_nationkey')} AS respondent, n_name, 'D' AS type,
               o_totalprice / 1000 AS value, o_orderdate AS landed_at
        FROM by_nation""",
    "sites": f"""
        SELECT 'epoch_' || lower(replace(s_name, ' ', '_')) AS dc_id, s_name AS name,
               lower(n_name) AS region_id, {_pick(T.STATES, 's_nationkey')} AS state,
               abs(s_acctbal) / 100 AS capacity_mw, s_suppkey % 3 = 0 AS ai_focused,
               CASE WHEN s_suppkey % 4 <> 0 THEN s_suppkey * 100 END AS gpu_count,
               {_ADDED} AS operational_date,
               CASE WHEN s_suppkey % 5 = 4 THEN 'planned' ELSE 'operational' END
                   AS construction_status,
               CAST(s_suppkey % 101 AS DOUBLE) AS renewable_pct
        FROM supplier JOIN nation ON s_nationkey = n_nationkey""",
    "registry": f"""
        SELECT CASE WHEN s_suppkey % 7 <> 0 THEN 'Site ' || s_suppkey END AS id, s_name AS name,
               CASE WHEN s_suppkey % 6 <> 5 THEN {_pick(T.OWNERS, 's_suppkey')} END AS owner,
               'Holding' AS company,
               25.0::DOUBLE + (s_suppkey * 37 % 2400) / 100.0::DOUBLE AS lat,
               -124.0::DOUBLE + (s_suppkey * 53 % 5700) / 100.0::DOUBLE AS lon,
               {_pick(T.STATES, 's_nationkey')} AS state,
               CASE WHEN s_suppkey % 9 = 8 THEN NULL
                    WHEN s_suppkey % 9 <> 7 THEN abs(s_acctbal) / 100
                    ELSE copy + 20 END AS capacity_mw,
               CASE WHEN s_suppkey % 4 = 1 THEN 1.2::DOUBLE ELSE 1.3::DOUBLE END AS pue,
               CASE WHEN s_suppkey % 4 = 2 THEN s_suppkey * 100 END AS gpu_count,
               CASE WHEN s_suppkey % 8 = 3 THEN s_suppkey END AS accelerator_count,
               CASE WHEN s_suppkey % 4 = 2 THEN 'H100' ELSE '' END AS gpu_type,
               CASE WHEN s_suppkey % 11 = 0 THEN NULL ELSE {_ADDED} END AS operational_date,
               {_pick(T.STATUSES, 's_suppkey')} AS status,
               CASE WHEN s_suppkey % 5 <> 0 THEN s_suppkey * 10 END AS water,
               CAST(s_suppkey % 101 AS DOUBLE) AS renewable_pct,
               CAST(DATE '2001-01-01' + CAST(copy * (s_suppkey % 3) AS INTEGER) AS TIMESTAMP)
                   AS last_updated
        FROM supplier, (VALUES (0), (1)) AS c(copy)""",
    "registry_sites": f"""
        SELECT lower(replace('epoch_' || coalesce(id, name, 'unknown'), ' ', '_')) AS dc_id, name,
               coalesce(owner, company) AS owner, coalesce(owner, 'Unknown') AS operator,
               lat AS latitude, lon AS longitude, CAST(NULL AS VARCHAR) AS county_fips, state,
               CAST(capacity_mw AS DOUBLE) AS capacity_mw, CAST(NULL AS DOUBLE) AS it_load_mw, pue,
               (coalesce(gpu_count, 0) <> 0 OR coalesce(accelerator_count, 0) <> 0
                OR {_contains('owner', L.AI_OWNERS)} OR {_contains('name', L.AI_NAME_PARTS)})
                   AS ai_focused,
               coalesce(gpu_count, accelerator_count) AS gpu_count, gpu_type,
               operational_date, DATE '1997-06-01' AS construction_start_date,
               {_status('status')} AS construction_status,
               water AS water_usage_gallons_annual, renewable_pct, 'epoch_ai' AS data_source,
               last_updated
        FROM registry""",
    "registry_latest": """
        SELECT * EXCLUDE (rn) FROM (
            SELECT *, row_number() OVER (PARTITION BY dc_id
                ORDER BY last_updated DESC NULLS LAST, capacity_mw DESC NULLS LAST) AS rn
            FROM registry_sites) WHERE rn = 1""",
    "weather": f"""
        SELECT *, {_degree('avg_temp_f')} FROM (
            SELECT lower(n_name) AS region_id, CAST(l_shipdate AS DATE) AS date,
                   {_avg('l_quantity')} + 40 AS avg_temp_f
            FROM lineitem JOIN supplier ON l_suppkey = s_suppkey
            JOIN nation ON s_nationkey = n_nationkey GROUP BY 1, 2)""",
    "supplier_stations": _daily_station("'S' || l_suppkey"),
    "market_stations": _daily_station(_pick(_STATIONS, "l_suppkey")),
    "market_daily": f"""
        SELECT *, {_unseason('CDSD')} AS cooling_degree_days,
               {_unseason('HDSD')} AS heating_degree_days FROM market_stations""",
    "market_weather": f"""
        SELECT region_id, date, {_avg('TAVG')} AS avg_temp_f,
               {_avg('cooling_degree_days')} AS cooling_degree_days,
               {_avg('heating_degree_days')} AS heating_degree_days
        FROM market_daily JOIN (VALUES {_STATION_ROWS}) AS m(station_id, region_id)
          ON station = station_id GROUP BY 1, 2""",
    "retail": f"""
        SELECT *, revenue / sales AS price,
               CAST(strptime(period, '%Y-%m') AS TIMESTAMP) + to_days(CAST(edition AS INTEGER))
                   AS landed_at
        FROM (SELECT strftime(o_orderdate, '%Y-%m') AS period, n_name AS stateid,
                     {_case(T.SECTOR_OF_SEGMENT, 'c_mktsegment')} AS sectorid,
                     ascii(l_returnflag) AS edition, {_sum('l_quantity')} AS sales,
                     {_sum('l_extendedprice')} AS revenue, CAST(count(*) AS DOUBLE) AS customers
              FROM lineitem JOIN by_nation ON l_orderkey = o_orderkey GROUP BY 1, 2, 3, 4)""",
    "retail_latest": """
        SELECT * EXCLUDE (rn) FROM (
            SELECT *, row_number() OVER (PARTITION BY period, stateid, sectorid
                ORDER BY landed_at DESC, price DESC) AS rn FROM retail) WHERE rn = 1""",
    "generation": f"""
        SELECT lower(n_name) AS region_id, o_orderdate AS "timestamp",
               {_case(T.FUEL_OF_PRIORITY, 'o_orderpriority')} AS fueltype,
               o_totalprice / 1000 AS value FROM by_nation""",
    "profiles": """
        SELECT lower(n_name) AS region_id, n_name AS region_name, n_name AS states_covered,
               count(*) AS population, n_nationkey * 100.0::DOUBLE AS area_sq_miles,
               n_nationkey % 4 AS climate_zone
        FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY n_name, n_nationkey""",
    "stations": """
        SELECT c_custkey AS station_id, 25.0::DOUBLE + (c_custkey * 17 % 2400) / 100.0::DOUBLE AS lat,
               -124.0::DOUBLE + (c_custkey * 29 % 5700) / 100.0::DOUBLE AS lon FROM customer""",
    "places": """
        SELECT s_suppkey AS site_id, 25.0::DOUBLE + (s_suppkey * 37 % 2400) / 100.0::DOUBLE AS lat,
               -124.0::DOUBLE + (s_suppkey * 53 % 5700) / 100.0::DOUBLE AS lon FROM supplier""",
    "hourly": """
        SELECT event_type AS region_id, ts AS "timestamp", value AS demand_mw,
               CASE WHEN user_id % 2 = 0 THEN user_id + 0.5::DOUBLE END AS temperature_f
        FROM events""",
    "live": f"""
        SELECT 'live_' || event_type || '_' || strftime(ts, '%Y%m%d%H') AS reading_id,
               event_type AS region_id, upper(event_type) AS balancing_authority,
               date_trunc('hour', ts) AS "timestamp", value AS demand_mw,
               {NOW} AS processing_timestamp,
               CAST(epoch({NOW}) - epoch(date_trunc('hour', ts)) AS BIGINT) AS latency_seconds
        FROM events WHERE value > 0""",
    "prices": f"""
        SELECT event_id, date_trunc('second', ts) AS "timestamp",
               CAST(user_id AS VARCHAR) AS pnode_id, 'node_' || user_id AS pnode_name,
               CASE WHEN event_id % 50 <> 0 THEN value * 5 END AS total_lmp,
               value - 50 AS congestion_lmp, value * 4 AS energy_lmp,
               CASE WHEN event_id % 40 <> 0 THEN value / 10 END AS loss_lmp,
               abs(value - 50) > 50 AS congestion_alert,
               coalesce(CASE WHEN event_id % 50 <> 0 THEN value * 5 END > 200, false)
                   AS price_spike_alert,
               {NOW} AS processing_timestamp
        FROM events""",
    "seasonal": f"""
        SELECT region_id, month(m) AS month_of_year, {_avg('avg_mw', 9)} AS baseline_demand_mw
        FROM (SELECT region_id, date_trunc('month', "timestamp") AS m, {_avg('demand_mw')} AS avg_mw
              FROM hourly GROUP BY 1, 2) GROUP BY 1, 2""",
    "anomalies": _anomalies("baseline_demand_mw"),
    "versioned": _anomalies(
        "baseline_demand_mw * CASE WHEN \"timestamp\" >= TIMESTAMP '2024-01-10' THEN 1.1::DOUBLE ELSE 1 END"),
}


# ---- analyses over a choice of tables ---------------------------------------------
def _monthly(energy: str) -> str:
    return f"""
        SELECT region_id, CAST(date_trunc('month', "timestamp") AS TIMESTAMP) AS month,
               {_avg('demand_mw')} AS avg_demand_mw, count(*) AS reading_count
        FROM {energy} GROUP BY 1, 2"""


def _bounds(sites: str, window: int = 12) -> str:
    return f"""
        SELECT *, CAST(operational_date - to_months(36) AS DATE) AS pre_period_start,
               CAST(operational_date - to_months(1) AS DATE) AS pre_period_end,
               operational_date AS post_period_start,
               least(CAST(operational_date + to_months({window}) AS DATE), {AS_OF})
                   AS post_period_end
        FROM (SELECT *, datesub('month', operational_date, {AS_OF}) AS months_since_op
              FROM {sites}
              WHERE construction_status = 'operational' AND operational_date IS NOT NULL
                AND region_id IS NOT NULL)
        WHERE months_since_op >= 3"""


def _stats(bounds: str, monthly: str, value: str, region: str = "b.region_id") -> str:
    """Per site: averages and months before and after, by joining every month."""
    pre = "m.month BETWEEN pre_period_start AND pre_period_end"
    post = "m.month BETWEEN post_period_start AND post_period_end"
    return f"""
        SELECT dc_id, {_avg(f'CASE WHEN {pre} THEN {value} END', 9)} AS pre_avg,
               count(CASE WHEN {pre} THEN 1 END) AS pre_months,
               {_avg(f'CASE WHEN {post} THEN {value} END', 9)} AS post_avg,
               count(CASE WHEN {post} THEN 1 END) AS post_months
        FROM {bounds} b JOIN {monthly} m ON {region} = m.region_id
        GROUP BY dc_id
        HAVING count(CASE WHEN {pre} THEN 1 END) > 0 AND count(CASE WHEN {post} THEN 1 END) > 0"""


def _events(bounds: str, stats: str, window: int = 12) -> str:
    completeness = (
        f"least(1.0::DOUBLE, CAST(pre_months + post_months AS DOUBLE) / "
        f"greatest(1, 36 + least({window}, months_since_op)))"
    )
    return f"""
        SELECT 'corr_' || dc_id || '_' || region_id || '_' || {AS_OF} AS event_id, dc_id,
               name AS dc_name, region_id, CAST({AS_OF} AS VARCHAR) AS analysis_date,
               CAST(pre_period_start AS VARCHAR) AS pre_period_start,
               CAST(pre_period_end AS VARCHAR) AS pre_period_end,
               CAST(post_period_start AS VARCHAR) AS post_period_start,
               CAST(post_period_end AS VARCHAR) AS post_period_end,
               pre_avg AS pre_period_avg_demand_mw, post_avg AS post_period_avg_demand_mw,
               post_avg - pre_avg AS delta_demand_mw,
               CASE WHEN pre_avg <> 0 THEN (post_avg - pre_avg) / pre_avg * 100 END
                   AS delta_demand_pct,
               CAST(NULL AS DOUBLE) AS pearson_correlation,
               CAST(NULL AS DOUBLE) AS spearman_correlation, CAST(NULL AS DOUBLE) AS p_value,
               {_score('pre_months', 'post_months', completeness, 'capacity_mw', 'pre_avg', window)}
                   AS confidence_score,
               CAST(NULL AS VARCHAR) AS control_region_id,
               CAST(NULL AS DOUBLE) AS control_delta_pct, CAST(NULL AS DOUBLE) AS adjusted_delta_pct,
               {window} AS analysis_window_months, {completeness} AS data_completeness,
               'difference_in_differences_v1' AS methodology
        FROM {bounds} JOIN {stats} USING (dc_id)
        WHERE pre_avg IS NOT NULL AND post_avg IS NOT NULL"""


def _timeline(sites: str) -> str:
    so_far = "OVER (PARTITION BY region_id ORDER BY date ROWS UNBOUNDED PRECEDING)"
    return f"""
        SELECT region_id, date, CAST(sum(mw) {so_far} AS DOUBLE) AS cumulative_capacity_mw,
               CAST(sum(ai_mw) {so_far} AS DOUBLE) AS cumulative_ai_capacity_mw,
               CAST(sum(n) {so_far} AS BIGINT) AS cumulative_dc_count,
               CAST(sum(gpus) {so_far} AS BIGINT) AS cumulative_gpu_count, latest_dc_added
        FROM (SELECT region_id, CAST(date_trunc('month', operational_date) AS TIMESTAMP) AS date,
                     sum(CAST(capacity_mw AS DECIMAL(28,6))) AS mw,
                     sum(CAST(CASE WHEN ai_focused THEN capacity_mw ELSE 0 END AS DECIMAL(28,6)))
                         AS ai_mw,
                     count(*) AS n, sum(coalesce(gpu_count, 0)) AS gpus, max(name) AS latest_dc_added
              FROM {sites}
              WHERE construction_status = 'operational' AND operational_date IS NOT NULL
                AND capacity_mw IS NOT NULL
              GROUP BY 1, 2)"""


def _current(energy: str) -> str:
    return f"""
        SELECT region_id, {_avg('demand_mw')} AS current_avg_demand_mw FROM {energy}
        WHERE date_trunc('month', "timestamp")
              = (SELECT date_trunc('month', max("timestamp")) FROM {energy})
        GROUP BY 1"""


def _kpi(current: str, events: str, timeline: str) -> str:
    return f"""
        SELECT region_id, current_avg_demand_mw, baseline_avg_demand_mw,
               CASE WHEN baseline_avg_demand_mw > 0
                    THEN (current_avg_demand_mw - baseline_avg_demand_mw)
                         / baseline_avg_demand_mw * 100
                    ELSE avg_delta_pct END AS energy_delta_pct,
               total_dc_capacity_mw, total_ai_dc_capacity_mw, total_dc_count, total_gpu_count,
               CASE WHEN current_avg_demand_mw > 0
                    THEN total_dc_capacity_mw / current_avg_demand_mw * 100 END
                   AS dc_load_pct_of_demand,
               avg_confidence, dc_events_count, {NOW} AS snapshot_timestamp
        FROM {current}
        LEFT JOIN (SELECT region_id, {_avg('pre_period_avg_demand_mw', 9)} AS baseline_avg_demand_mw,
                          {_avg('delta_demand_pct', 9)} AS avg_delta_pct,
                          {_avg('confidence_score')} AS avg_confidence, count(*) AS dc_events_count
                   FROM {events} GROUP BY 1) USING (region_id)
        LEFT JOIN (SELECT region_id, max(cumulative_capacity_mw) AS total_dc_capacity_mw,
                          max(cumulative_ai_capacity_mw) AS total_ai_dc_capacity_mw,
                          max(cumulative_dc_count) AS total_dc_count,
                          max(cumulative_gpu_count) AS total_gpu_count
                   FROM {timeline} GROUP BY 1) USING (region_id)"""


def _forecast(regions: str, years: int, impact: str | None = None) -> str:
    base = "current_demand_mw * pow(1.02::DOUBLE, y)"
    added = f"planned_dc_capacity_mw * least(1.0::DOUBLE, y::DOUBLE / {years}.0::DOUBLE)"
    extra, join = "", ""
    if impact:
        factor = "coalesce(avg_delta_mw, 1.3::DOUBLE)"
        extra = (
            f", round({factor}, 4) AS impact_factor, round(({added}) * {factor} / "
            f"nullif(current_demand_mw, 0), 4) + 0.0 AS impact_weighted"
        )
        join = f"LEFT JOIN {impact} USING (region_id)"
    return f"""
        SELECT region_id, y AS year_ahead, round({base}, 1) AS baseline_demand_mw,
               round({added}, 1) AS dc_additional_demand_mw,
               round({base} + {added}, 1) AS total_projected_demand_mw,
               round(({base} + {added} - current_demand_mw) / nullif(current_demand_mw, 0) * 100, 2)
                   AS demand_increase_pct {extra}
        FROM {regions} {join}, (SELECT CAST(range AS INTEGER) AS y FROM range(1, {years + 1}))"""


def _regions(current: str, sites: str) -> str:
    return f"""
        SELECT region_id, current_avg_demand_mw AS current_demand_mw,
               coalesce(planned, 0.0::DOUBLE) AS planned_dc_capacity_mw
        FROM {current} LEFT JOIN (
            SELECT region_id, {_sum('capacity_mw')} AS planned FROM {sites}
            WHERE construction_status IN ('planned', 'under_construction') GROUP BY 1)
        USING (region_id)"""


def _impact(events: str, sites: str | None = None) -> str:
    more = join = ""
    if sites:
        ratio = "CASE WHEN capacity_mw <> 0 THEN delta_demand_mw / capacity_mw END"
        more, join = f", {_avg(ratio, 9)} AS mw_per_site_mw", f"LEFT JOIN {sites} USING (dc_id)"
        return f"""
        SELECT e.region_id, {_avg('delta_demand_mw', 9)} AS avg_delta_mw, count(*) AS event_count
               {more} FROM {events} e {join} WHERE confidence_score >= 0.5 GROUP BY 1"""
    return f"""
        SELECT region_id, {_avg('delta_demand_mw', 9)} AS avg_delta_mw, count(*) AS event_count
        FROM {events} WHERE confidence_score >= 0.5 GROUP BY 1"""


def _trailing(seconds: int, name: str) -> str:
    over = (
        "OVER (PARTITION BY region_id ORDER BY CAST(floor(epoch(\"timestamp\")) AS BIGINT) "
        f"RANGE BETWEEN {seconds} PRECEDING AND CURRENT ROW)"
    )
    return (
        f"CAST(sum(CAST(demand_mw AS DECIMAL(28,6))) {over} AS DOUBLE) "
        f"/ CAST(nullif(count(demand_mw) {over}, 0) AS DOUBLE) AS {name}"
    )


CTES |= {
    "monthly": _monthly("readings"),
    "bounds": _bounds("sites"),
    "stats": _stats("bounds", "monthly", "m.avg_demand_mw"),
    "site_events": _events("bounds", "stats"),
    "wide_bounds": _bounds("sites", 18),
    "wide_stats": _stats("wide_bounds", "monthly", "m.avg_demand_mw"),
    "timeline": _timeline("sites"),
    "current_demand": _current("readings"),
    "kpi": _kpi("current_demand", "site_events", "timeline"),
    "regions": _regions("current_demand", "sites"),
    "impact": _impact("site_events"),
    "pairs": """
        SELECT m.region_id, m.month, avg_demand_mw AS d, cumulative_capacity_mw AS c,
               cumulative_ai_capacity_mw AS a
        FROM monthly m JOIN timeline t ON m.region_id = t.region_id AND m.month = t.date""",
    "ranked": """
        SELECT *, rank() OVER (PARTITION BY region_id ORDER BY d)
                  + (count(*) OVER (PARTITION BY region_id, d) - 1) / 2.0::DOUBLE AS rd,
               rank() OVER (PARTITION BY region_id ORDER BY c)
                  + (count(*) OVER (PARTITION BY region_id, c) - 1) / 2.0::DOUBLE AS rc
        FROM pairs WHERE d IS NOT NULL AND c IS NOT NULL""",
    "rank_corr": f"""
        SELECT region_id, {_pearson('d', 'c')} AS r, {_pearson('rd', 'rc')} AS rho, count(*) AS n
        FROM ranked GROUP BY 1 HAVING count(*) >= 6""",
    "t_stat": "SELECT *, r * sqrt(n - 2) / nullif(sqrt(1 - r * r), 0) AS t, n - 2 AS v FROM rank_corr",
    # tail of Student's t: midpoint rule over the angle, 20,000 strips
    "tail": """
        SELECT region_id, r, rho, n, t,
               CASE WHEN abs(r) >= 1 THEN 0.0 ELSE (
                 SELECT 1 - sum(pow(cos(th * (range + 0.5) / 20000), v - 1))
                        / sum(pow(cos(pi() / 2 * (range + 0.5) / 20000), v - 1)) * th / (pi() / 2)
                 FROM range(20000)) END AS p
        FROM (SELECT *, atan(abs(t) / sqrt(v)) AS th FROM t_stat)""",
    "district_readings": """
        SELECT lower(n_name) || '/' || lower(c_mktsegment) AS region_id, o_orderdate AS "timestamp",
               o_totalprice / 1000 AS demand_mw FROM by_nation""",
    "district_sites": f"""
        SELECT s.* REPLACE (region_id || '/' || lower({_pick(T.SITE_SEGMENTS, "regexp_extract(name, '[0-9]+$')")})
                            AS region_id) FROM sites s""",
    "district_profiles": """
        SELECT lower(n_name) || '/' || lower(c_mktsegment) AS region_id,
               count(*) AS population, CAST(n_nationkey % 4 AS INTEGER) AS climate_zone
        FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY n_name, c_mktsegment, n_nationkey""",
    "district_monthly": _monthly("district_readings"),
    "district_bounds": _bounds("district_sites"),
    "district_stats": _stats("district_bounds", "district_monthly", "m.avg_demand_mw"),
    "controls": """
        SELECT region_id, control_region_id, population, control_population FROM (
            SELECT a.region_id, c.region_id AS control_region_id, a.population,
                   c.population AS control_population,
                   row_number() OVER (PARTITION BY a.region_id
                       ORDER BY abs(a.population - c.population), c.region_id) AS rn
            FROM district_profiles a
            JOIN district_profiles c ON abs(a.climate_zone - c.climate_zone) <= 1
            WHERE a.region_id IN (SELECT region_id FROM district_sites)
              AND c.region_id NOT IN (SELECT region_id FROM district_sites)
              AND abs(a.population - c.population) <= a.population * 0.3)
        WHERE rn = 1""",
    "control_bounds": "SELECT b.*, control_region_id FROM district_bounds b JOIN controls USING (region_id)",
    "control_stats": _stats("control_bounds", "district_monthly", "m.avg_demand_mw", "b.control_region_id"),
    "retail_monthly": f"""
        SELECT lower(stateid) AS region_id, CAST(strptime(period, '%Y-%m') AS TIMESTAMP) AS month,
               {_avg('price')} AS avg_price FROM retail_latest GROUP BY 1, 2""",
    "price_stats": _stats("bounds", "retail_monthly", "m.avg_price"),
    "carbon_monthly": f"""
        SELECT region_id, CAST(date_trunc('month', "timestamp") AS TIMESTAMP) AS month,
               {_sum('value * factor')} / nullif({_sum('value')}, 0) AS intensity
        FROM generation JOIN (VALUES {', '.join(f"('{k}', {v}::DOUBLE)" for k, v in T.EMISSION.items())})
          AS f(fueltype, factor) USING (fueltype) GROUP BY 1, 2""",
    "carbon_stats": _stats("bounds", "carbon_monthly", "m.intensity"),
    # the whole batch job
    "landed_demand": """
        SELECT * EXCLUDE (rn) FROM (
            SELECT *, row_number() OVER (PARTITION BY period, respondent, type
                ORDER BY landed_at DESC, value DESC) AS rn FROM demand_records) WHERE rn = 1""",
    "batch_energy": f"""
        SELECT lower(respondent) AS region_id, {_parse_hour('period')} AS "timestamp",
               value AS demand_mw FROM landed_demand""",
    "batch_energy_keys": """
        SELECT 'eia_' || lower(respondent) || '_' || replace(replace(period, '-', ''), 'T', '')
                   AS reading_id, lower(respondent) AS region_id FROM landed_demand""",
    "served_regions": "SELECT DISTINCT lower(respondent) AS region_id FROM demand_records",
    "batch_sites": f"""
        SELECT *, lower(coalesce({_case(L.STATE_AUTHORITY, 'state')}, 'unknown')) AS region_id
        FROM registry_latest""",
    "batch_monthly": _monthly("batch_energy"),
    "batch_bounds": _bounds("batch_sites"),
    "batch_stats": _stats("batch_bounds", "batch_monthly", "m.avg_demand_mw"),
    "batch_site_events": _events("batch_bounds", "batch_stats"),
    "batch_timeline": _timeline("batch_sites"),
    "batch_current": _current("batch_energy"),
    "batch_summary": _kpi("batch_current", "batch_site_events", "batch_timeline"),
    "batch_regions": _regions("batch_current", "batch_sites"),
    "batch_impact": _impact("batch_site_events"),
}

_ORPHAN = "SELECT '{link}' AS link_type, {key} AS source_key, {prop} AS missing_target FROM {source} " \
    "WHERE {prop} IS NOT NULL AND {prop} NOT IN (SELECT {prop} FROM {target})"


def _live_pages(where: str, columns: str) -> str:
    return f"""
        SELECT {columns} FROM (
            SELECT event_id, {_hour('ts')} AS period, upper(event_type) AS respondent,
                   upper(event_type) AS parent, 'Z' || (user_id % 10) AS subba, 'D' AS type,
                   {_pick(T.FUELS, 'user_id')} AS fueltype, value FROM events)
        WHERE {where}"""


def _guard(side: str) -> str:
    size = "" if side == "<=" else ", bytes AS row_bytes"
    return f"""
        SELECT period, respondent, value{size} FROM (
            SELECT *, CAST(strlen(to_json(struct_pack(period, respondent, value))) AS INTEGER) AS bytes
            FROM (SELECT {_hour('ts')} AS period, upper(event_type) AS respondent,
                         CAST(value AS VARCHAR) AS value FROM events))
        WHERE bytes {side} 65"""


_MARKET_AT = _second("ts") + " AS datetime_beginning_ept"

QUERIES: dict[str, str] = {
    "scan_demand": _live_pages(
        "respondent IN ('PURCHASE', 'VIEW') AND period BETWEEN '2024-01-05T00' AND '2024-01-25T23'",
        "period, respondent, type, value"),
    "scan_demand_subregions": _live_pages(
        "parent IN ('PURCHASE', 'VIEW') AND subba IN ('Z1', 'Z4')", "period, parent, subba, value"),
    "scan_generation_by_fuel": _live_pages(
        "respondent IN ('CLICK', 'ERROR') AND period >= '2024-01-08T00'",
        "period, respondent, fueltype, value"),
    "scan_retail_sales": f"""
        SELECT period, stateid, sectorid, sales, revenue, price, customers FROM retail
        WHERE stateid IN ('NATION_1', 'NATION_2', 'NATION_7') AND sectorid IN {_in(L.RETAIL_SECTORS)}
          AND period BETWEEN '1996-01' AND '2000-12'""",
    "scan_facility_fuel": f"""
        SELECT strftime(l_shipdate, '%Y-%m') AS period, CAST(l_suppkey AS VARCHAR) AS "plantCode",
               {_pick(T.STATES, 'l_suppkey')} AS state, l_returnflag AS fuel2002,
               {_sum('l_quantity')} AS generation, {_sum('l_extendedprice')} AS total_consumption
        FROM lineitem
        WHERE {_pick(T.STATES, 'l_suppkey')} IN ('VA', 'TX')
          AND strftime(l_shipdate, '%Y-%m') >= '1997-01' GROUP BY 1, 2, 3, 4""",
    "latest_demand": _live_pages(
        "respondent IN ('SIGNUP', 'ERROR', 'CLICK') "
        "AND period BETWEEN '2024-01-29T12' AND '2024-01-30T12'", "period, respondent, value"),
    "page_demand": f"""
        SELECT period, respondent, value FROM (
            SELECT {_hour('ts')} AS period, upper(event_type) AS respondent, value,
                   CAST(value AS VARCHAR) AS text FROM events)
        ORDER BY period DESC, respondent, text LIMIT 50 OFFSET 100""",
    "page_completeness": """
        SELECT event_type AS respondent, count(DISTINCT CASE WHEN kept THEN event_id // 500 END) AS pages,
               count(*) FILTER (kept) AS received, count(*) AS announced,
               count(*) FILTER (kept) >= count(*) AS complete
        FROM (SELECT *, NOT (event_type = 'view' AND event_id < 500) AS kept FROM events) GROUP BY 1""",
    "scan_lmp": f"""
        SELECT {_second('"timestamp"')} AS datetime_beginning_ept, pnode_id, total_lmp AS total_lmp_rt,
               congestion_lmp AS congestion_price_rt, energy_lmp AS system_energy_price_rt
        FROM prices WHERE CAST(pnode_id AS BIGINT) BETWEEN 1 AND 39
          AND "timestamp" BETWEEN TIMESTAMP '2024-01-03' AND TIMESTAMP '2024-01-28'
        ORDER BY 1 DESC, pnode_id, pnode_name, CAST(total_lmp AS VARCHAR) NULLS FIRST""",
    "scan_metered_load": f"""
        SELECT {_MARKET_AT}, upper(event_type) AS zone, value AS mw FROM events
        WHERE date_trunc('second', ts) BETWEEN TIMESTAMP '2024-01-03' AND TIMESTAMP '2024-01-20'
        ORDER BY 1 DESC, zone, CAST(value AS VARCHAR)""",
    "scan_load_forecast": f"""
        SELECT {_second('ts')} AS forecast_datetime_beginning_ept,
               upper(event_type) AS forecast_area, value AS forecast_load_mw FROM events
        WHERE date_trunc('second', ts) BETWEEN TIMESTAMP '2024-01-10' AND TIMESTAMP '2024-01-17'""",
    "scan_generation_mix": f"""
        SELECT {_MARKET_AT}, {_pick(T.FUELS, 'user_id')} AS fuel_type, value AS mw FROM events
        WHERE date_trunc('second', ts) BETWEEN TIMESTAMP '2024-01-05' AND TIMESTAMP '2024-01-12'
        ORDER BY 1 DESC, fuel_type, CAST(value AS VARCHAR)""",
    "instantaneous_load": f"""
        SELECT {_MARKET_AT}, upper(event_type) AS area, value AS instantaneous_load FROM events
        ORDER BY 1 DESC, area, CAST(value AS VARCHAR) LIMIT 100""",
    "linked_pages": f"""
        SELECT event_id // 5000 AS request, CAST(event_id // 250 % 20 AS INTEGER) AS page_no,
               {_MARKET_AT}, upper(event_type) AS zone, value AS mw FROM events
        WHERE NOT (event_id // 5000 = 3 AND event_id // 250 % 20 > 1)""",
    "weather_pivot": """
        SELECT station, CAST(date AS VARCHAR) AS date, TAVG, TMAX, TMIN, CDSD, HDSD
        FROM supplier_stations""",
    "stations_in_bbox": f"""
        SELECT station_id, lat, lon, round({_km('39.0438::DOUBLE', '-77.4874::DOUBLE', 'lat', 'lon')}, 6)
               AS distance_km
        FROM stations
        WHERE lat BETWEEN 39.0438 - 500 / 111.0 AND 39.0438 + 500 / 111.0
          AND lon BETWEEN -77.4874 - 500 / (111.0 * cos(radians(39.0438)))
                      AND -77.4874 + 500 / (111.0 * cos(radians(39.0438)))
        ORDER BY distance_km, station_id LIMIT 25""",
    "historical_baseline": f"""
        SELECT year, dc_type, consumption_twh, pct_of_national, is_projected, source, observed_twh
        FROM (VALUES {', '.join(
            f"({y}, '{k}', {a}::DOUBLE, {b}::DOUBLE, {str(p).lower()}, '{s}')"
            for y, k, a, b, p, s in L.NATIONAL_BASELINE)})
          AS b(year, dc_type, consumption_twh, pct_of_national, is_projected, source)
        LEFT JOIN (SELECT year("timestamp") + 19 AS year, {_sum('demand_mw')} * 0.000001::DOUBLE
                          AS observed_twh FROM readings GROUP BY 1) USING (year)""",
    "ingest_demand": f"""
        SELECT period, respondent, respondent_name, 'D' AS type, 'Demand' AS type_name, value,
               'megawatthours' AS value_units, ts AS ingestion_timestamp
        FROM (SELECT {_hour('ts')} AS period, upper(event_type) AS respondent,
                     event_type AS respondent_name, ts,
                     CASE WHEN event_id % 13 <> 0 THEN value END AS value,
                     row_number() OVER (PARTITION BY {_hour('ts')}, event_type
                         ORDER BY ts DESC, CASE WHEN event_id % 13 <> 0 THEN value END DESC NULLS LAST)
                         AS rn
              FROM events WHERE event_type IN ('click', 'view', 'error')
                AND {_hour('ts')} BETWEEN '2024-01-28T12' AND '2024-01-30T12')
        WHERE rn = 1""",
    "ingest_retail": f"""
        SELECT period, stateid, stateid AS "stateDescription", sectorid, sectorid AS "sectorName",
               sales, revenue, price, customers, 'MWh' AS sales_units,
               landed_at AS ingestion_timestamp
        FROM retail_latest WHERE sectorid IN {_in(L.RETAIL_SECTORS)} AND period >= '1996-01'""",
    "ingest_data_centers": """
        SELECT * REPLACE (CAST(operational_date AS VARCHAR) AS operational_date,
                          CAST(construction_start_date AS VARCHAR) AS construction_start_date)
        FROM registry_latest""",
    "incremental_append": f"""
        SELECT period, respondent, 'D' AS type, value, ts AS ingestion_timestamp
        FROM (SELECT {_hour('ts')} AS period, upper(event_type) AS respondent, ts, value,
                     row_number() OVER (PARTITION BY {_hour('ts')}, event_type
                                        ORDER BY ts DESC, value DESC) AS rn
              FROM events WHERE ts >= TIMESTAMP '2024-01-10')
        WHERE rn = 1 AND (period, respondent) NOT IN (
            SELECT ({_hour('ts')}, upper(event_type)) FROM events WHERE ts < TIMESTAMP '2024-01-15')""",
    "safe_cast": f"""
        SELECT c_custkey, {_number('t')} AS as_double,
               coalesce({_number('t')}, 1.3::DOUBLE) AS as_double_or_default,
               {_whole('t')} AS as_bigint, coalesce({_whole('t')}, 0) AS as_bigint_or_default
        FROM (SELECT c_custkey, CASE WHEN c_custkey % 8 = 7 THEN CAST(c_acctbal AS VARCHAR)
                                     ELSE {_pick(T.NUMBER_TEXTS, 'c_custkey')} END AS t
              FROM customer)""",
    "normalize_registry": """
        SELECT * REPLACE (CAST(operational_date AS VARCHAR) AS operational_date,
                          CAST(construction_start_date AS VARCHAR) AS construction_start_date)
        FROM registry_sites""",
    "classify_ai": f"""
        SELECT name, owner, CAST(gpu_count AS VARCHAR) AS gpu_count,
               CAST(accelerator_count AS VARCHAR) AS accelerator_count,
               (coalesce(gpu_count, 0) <> 0 OR coalesce(accelerator_count, 0) <> 0
                OR {_contains('owner', L.AI_OWNERS)} OR {_contains('name', L.AI_NAME_PARTS)})
                   AS ai_focused
        FROM registry""",
    "normalize_status": f"""
        SELECT c_custkey, {_status('s')} AS status
        FROM (SELECT c_custkey, CASE WHEN c_custkey % 11 <> 0
                                     THEN {_pick(T.STATUSES, 'c_custkey')} END AS s FROM customer)""",
    "normalize_readings": f"""
        SELECT 'eia_' || lower(respondent) || '_'
                 || strftime({_parse_hour('period')}, '%Y%m%d%H') AS reading_id,
               lower(respondent) AS region_id, respondent AS balancing_authority,
               {_parse_hour('period')} AS "timestamp", value AS demand_mw,
               CAST(NULL AS DOUBLE) AS generation_mw, CAST(NULL AS DOUBLE) AS temperature_f,
               CAST(NULL AS DOUBLE) AS cooling_degree_days, CAST(NULL AS DOUBLE) AS price_per_mwh,
               CAST(NULL AS VARCHAR) AS source_mix,
               CAST(NULL AS DOUBLE) AS carbon_intensity_gco2_kwh, 'eia_rto' AS data_source,
               landed_at AS ingestion_timestamp
        FROM demand_records""",
    "period_to_utc": f"""
        SELECT period, respondent,
               ({_parse_hour('period')} AT TIME ZONE
                coalesce({_case(L.AUTHORITY_ZONE, 'respondent')}, 'US/Eastern'))
               AT TIME ZONE 'UTC' AS utc
        FROM demand_records""",
    "calendar_months": f"""
        SELECT o_orderkey, CAST((year({AS_OF}) - year(o_orderdate)) * 12 + month({AS_OF})
               - month(o_orderdate) AS INTEGER) AS months FROM orders""",
    "haversine": f"""
        SELECT station_id, round({_km('39.0438::DOUBLE', '-77.4874::DOUBLE', 'lat', 'lon')}, 6)
               AS distance_km FROM stations""",
    "bbox": """
        SELECT station_id, round(lat - dlat, 9) AS lat_min, round(lon - dlon, 9) AS lon_min,
               round(lat + dlat, 9) AS lat_max, round(lon + dlon, 9) AS lon_max
        FROM (SELECT *, 50 / 111.0::DOUBLE AS dlat,
                     50 / (111.0::DOUBLE * greatest(0.01::DOUBLE, cos(radians(lat)))) AS dlon
              FROM stations)""",
    "fips_to_state": f"""
        SELECT c_custkey, fips, {_case(L.FIPS_STATE, 'fips')} AS state
        FROM (SELECT c_custkey, lpad(CAST(c_custkey % 60 AS VARCHAR), 2, '0') AS fips FROM customer)""",
    # a point is inside when a ray to the east crosses an odd number of edges
    "point_in_region": """
        SELECT station_id AS point_id, lower(n_name) AS region_id
        FROM stations, (SELECT n_name, -124.0::DOUBLE + (n_nationkey % 5) * 11.0::DOUBLE AS x,
                               25.0::DOUBLE + (n_nationkey // 5) * 4.8::DOUBLE AS y FROM nation),
             (VALUES (0, 0, 10, 0), (10, 0, 10, 4), (10, 4, 5, 4.7), (5, 4.7, 0, 4), (0, 4, 0, 0))
                 AS e(x1, y1, x2, y2)
        GROUP BY 1, 2
        HAVING count(*) FILTER (
            (y + y1::DOUBLE > lat) <> (y + y2::DOUBLE > lat)
            AND lon < (x + x1::DOUBLE) + (lat - (y + y1::DOUBLE))
                * (((x + x2::DOUBLE) - (x + x1::DOUBLE))
                   / nullif((y + y2::DOUBLE) - (y + y1::DOUBLE), 0))) % 2 = 1""",
    "unit_conversions": """
        SELECT event_id, value * 0.001::DOUBLE AS gwh, value * 0.000001::DOUBLE AS twh,
               value * 0.001::DOUBLE AS twh_from_gwh, value * 0.001::DOUBLE AS mwh_from_kwh,
               value * 0.001::DOUBLE AS gw, value * 7446.0::DOUBLE AS annual_mwh FROM events""",
    "confidence_score": f"""
        SELECT c_custkey, {_score('pre', 'post', 'completeness', 'capacity', 'demand')} AS score
        FROM (SELECT c_custkey, c_custkey % 40 AS pre, c_custkey % 14 AS post,
                     least(1.0::DOUBLE, (c_custkey % 40 + c_custkey % 14) / 48.0::DOUBLE)
                         AS completeness,
                     CASE WHEN c_custkey % 9 <> 0 THEN abs(c_acctbal) / 100
                          * CASE WHEN c_custkey % 8 = 0 THEN 0 ELSE 1 END END AS capacity,
                     CASE WHEN c_custkey % 7 = 0 THEN 0.0::DOUBLE
                          ELSE (c_custkey % 50 + 1) * 20.0::DOUBLE END AS demand FROM customer)""",
    "period_bounds": """
        SELECT dc_id, CAST(months_since_op AS INTEGER) AS months_since_op,
               CAST(pre_period_start AS VARCHAR) AS pre_period_start,
               CAST(pre_period_end AS VARCHAR) AS pre_period_end,
               CAST(post_period_start AS VARCHAR) AS post_period_start,
               CAST(post_period_end AS VARCHAR) AS post_period_end,
               CAST(CAST(CASE WHEN day(pre_period_start) = 1 THEN pre_period_start
                    ELSE date_trunc('month', pre_period_start) + to_months(1) END AS DATE) AS VARCHAR)
                   AS pre_from,
               CAST(CAST(date_trunc('month', pre_period_end) AS DATE) AS VARCHAR) AS pre_to,
               CAST(CAST(CASE WHEN day(operational_date) = 1 THEN operational_date
                    ELSE date_trunc('month', operational_date) + to_months(1) END AS DATE) AS VARCHAR)
                   AS post_from,
               CAST(CAST(date_trunc('month', post_period_end) AS DATE) AS VARCHAR) AS post_to
        FROM bounds""",
    "severity_buckets": f"""
        SELECT event_id, d AS deviation_pct, {_severity('d')} AS severity, {_kind('d')} AS anomaly_type,
               abs(d) > 10 AS is_anomaly
        FROM (SELECT event_id, CAST(event_id % 81 - 40 AS DOUBLE) AS d FROM events)""",
    "lmp_alerts": """
        SELECT pnode_id, count(*) FILTER (congestion_alert) AS congestion_alerts,
               count(*) FILTER (price_spike_alert) AS price_spike_alerts, max(total_lmp) AS max_lmp
        FROM prices WHERE congestion_alert OR price_spike_alert GROUP BY 1""",
    "latency_seconds": f"""
        SELECT event_id, CAST(epoch({NOW}) - floor(epoch(ts)) AS BIGINT) AS latency_seconds
        FROM events""",
    "source_mix": f"""
        SELECT region_id, year, fueltype,
               round(v / {_sum('v', over='OVER (PARTITION BY region_id, year)')}, 4) AS share
        FROM (SELECT region_id, CAST(year("timestamp") AS INTEGER) AS year, fueltype,
                     {_sum('value')} AS v FROM generation GROUP BY 1, 2, 3)""",
    "target_regions": f"""
        SELECT upper(event_type) AS respondent, count(*) AS n, max({_hour('ts')}) AS last_period
        FROM events WHERE event_type IN ('purchase', 'signup') GROUP BY 1""",
    "row_size_guard": f"""
        SELECT respondent, bytes <= 65 AS accepted, count(*) AS n, max(bytes) AS largest
        FROM (SELECT upper(event_type) AS respondent, CAST(strlen(to_json(struct_pack(
                  period := {_hour('ts')}, respondent := upper(event_type),
                  value := CAST(value AS VARCHAR)))) AS BIGINT) AS bytes FROM events)
        GROUP BY 1, 2""",
    "accepted_rows": _guard("<="),
    "rejected_rows": _guard(">"),
    "enrich_regions": f"""
        SELECT dc_id, state, ba AS balancing_authority, lower(coalesce(ba, 'unknown')) AS region_id
        FROM (SELECT *, {_case(L.STATE_AUTHORITY, 'state')} AS ba FROM sites)""",
    "weather_join": """
        SELECT d.* REPLACE (coalesce(d.temperature_f, w.avg_temp_f) AS temperature_f,
                            coalesce(d.cooling_degree_days, w.cooling_degree_days)
                                AS cooling_degree_days)
        FROM detailed d LEFT JOIN weather w
          ON d.region_id = w.region_id AND CAST(d."timestamp" AS DATE) = w.date""",
    "weather_join_fallback": "SELECT * FROM detailed",
    "did_events": "SELECT * FROM site_events",
    "did_events_one": _events("wide_bounds", "wide_stats", 18)
    + " AND dc_id = 'epoch_supplier#000000003'",
    "regional_correlations": f"""
        SELECT region_id, round({_pearson('d', 'c')}, 6) AS pearson_total_dc,
               round({_pearson('d', 'a')}, 6) AS pearson_ai_dc, count(*) AS data_points,
               CAST({AS_OF} AS VARCHAR) AS analysis_date
        FROM pairs GROUP BY 1 HAVING count(*) >= 6""",
    "kpi_summary": "SELECT * FROM kpi",
    "nearest_station": f"""
        SELECT site_id, station_id, km AS distance_km FROM (
            SELECT site_id, station_id, km, row_number() OVER (
                       PARTITION BY site_id ORDER BY km, station_id) AS rn
            FROM (SELECT site_id, station_id,
                         round({_km('p.lat', 'p.lon', 's.lat', 's.lon')}, 6) AS km
                  FROM places p, stations s))
        WHERE rn = 1""",
    "market_ba": f"""
        SELECT respondent, count(*) AS readings, max(period) AS last_period, market
        FROM demand_records JOIN (VALUES {_MARKET_ROWS}) AS m(market, respondent) USING (respondent)
        GROUP BY respondent, market""",
    "region_weather": """
        SELECT * REPLACE (CAST(date AS VARCHAR) AS date) FROM market_weather""",
    "control_region": "SELECT * FROM controls",
    "link_orphans": " UNION ALL ".join([
        _ORPHAN.format(link="data-center-in-region", key="dc_id", prop="region_id",
                       source="batch_sites", target="served_regions"),
        _ORPHAN.format(link="correlation-for-dc", key="event_id", prop="dc_id",
                       source="batch_site_events", target="batch_sites"),
        _ORPHAN.format(link="correlation-in-region", key="event_id", prop="region_id",
                       source="batch_site_events", target="served_regions"),
        _ORPHAN.format(link="reading-for-region", key="reading_id", prop="region_id",
                       source="batch_energy_keys", target="served_regions"),
    ]),
    "link_navigate": """
        SELECT 'correlation-for-dc' AS link_type, event_id AS source_key, dc_id AS target_key,
               name AS target_title FROM site_events LEFT JOIN (SELECT dc_id, name FROM sites)
               USING (dc_id)""",
    "monthly_energy": "SELECT * FROM monthly",
    "capacity_timeline": "SELECT * FROM timeline",
    "dedup_latest": """
        SELECT hour, event_type, user_id, ts, value FROM (
            SELECT date_trunc('hour', ts) AS hour, *, row_number() OVER (
                PARTITION BY date_trunc('hour', ts), event_type
                ORDER BY ts DESC, value DESC, user_id DESC) AS rn FROM events) WHERE rn = 1""",
    "forecast_fit": _impact("site_events", "(SELECT dc_id, capacity_mw FROM sites)"),
    "spearman": "SELECT region_id, round(rho, 6) AS spearman_total_dc, n AS data_points FROM rank_corr",
    "corr_significance": """
        SELECT region_id, round(r, 6) AS pearson_total_dc, round(t, 6) AS t_statistic,
               round(p, 6) AS p_value, p < 0.05 AS significant FROM tail""",
    "events_with_correlation": """
        SELECT event_id, e.region_id, round(r, 6) AS pearson_correlation,
               round(rho, 6) AS spearman_correlation, round(p, 6) AS p_value
        FROM site_events e LEFT JOIN tail t ON e.region_id = t.region_id""",
    "adjusted_delta": """
        SELECT dc_id, region_id, control_region_id, own AS delta_demand_pct,
               control AS control_delta_pct, own - control AS adjusted_delta_pct
        FROM (SELECT dc_id, b.region_id, control_region_id,
                     CASE WHEN s.pre_avg <> 0 THEN (s.post_avg - s.pre_avg) / s.pre_avg * 100 END AS own,
                     CASE WHEN c.pre_avg <> 0 THEN (c.post_avg - c.pre_avg) / c.pre_avg * 100 END
                         AS control
              FROM control_bounds b JOIN district_stats s USING (dc_id) JOIN control_stats c USING (dc_id)
              WHERE s.pre_avg IS NOT NULL AND s.post_avg IS NOT NULL)""",
    "weather_residual": """
        SELECT region_id, "timestamp", demand_mw, round(e, 4) AS expected_mw,
               round(demand_mw - e, 4) + 0.0 AS residual_mw
        FROM (SELECT j.*, my + b1 * (c - mc) + b2 * (h - mh) AS e FROM j LEFT JOIN (
                SELECT *, CASE WHEN det > vc * vh * 1e-9 THEN (vcy * vh - vhy * vch) / det
                               WHEN vc > 0 THEN vcy / vc ELSE 0 END AS b1,
                       CASE WHEN det > vc * vh * 1e-9 THEN (vhy * vc - vcy * vch) / det
                            WHEN vc > 0 THEN 0 WHEN vh > 0 THEN vhy / vh ELSE 0 END AS b2
                FROM (SELECT *, vc * vh - vch * vch AS det FROM (
                        SELECT region_id, avg(demand_mw) AS my, avg(c) AS mc, avg(h) AS mh,
                               var_pop(c) AS vc, var_pop(h) AS vh, covar_pop(c, h) AS vch,
                               covar_pop(c, demand_mw) AS vcy, covar_pop(h, demand_mw) AS vhy
                        FROM j WHERE demand_mw IS NOT NULL AND c IS NOT NULL AND h IS NOT NULL
                        GROUP BY 1))) USING (region_id))""",
    "degree_days": f"""
        SELECT station, CAST(date AS VARCHAR) AS date,
               round({_unseason('CDSD')}, 6) AS cooling_degree_days,
               round({_unseason('HDSD')}, 6) AS heating_degree_days FROM supplier_stations""",
    "kpi_cost_impact": """
        SELECT dc_id, region_id, p.pre_avg AS pre_avg_price, p.post_avg AS post_avg_price,
               p.post_avg - p.pre_avg AS price_delta,
               CASE WHEN p.pre_avg > 0 THEN (p.post_avg - p.pre_avg) / p.pre_avg * 100 END
                   AS price_delta_pct,
               (s.post_avg - s.pre_avg) * p.post_avg * 10 AS added_cost_per_hour
        FROM bounds JOIN stats s USING (dc_id) JOIN price_stats p USING (dc_id)""",
    "kpi_per_capita": f"""
        SELECT region_id, population, avg_delta_mw,
               avg_delta_mw * 1000000 / population AS delta_watts_per_capita
        FROM (SELECT region_id, {_avg('delta_demand_mw', 9)} AS avg_delta_mw
              FROM site_events GROUP BY 1) JOIN profiles USING (region_id)""",
    "kpi_carbon_delta": """
        SELECT dc_id, region_id, pre_avg AS pre_intensity, post_avg AS post_intensity,
               post_avg - pre_avg AS intensity_delta
        FROM bounds JOIN carbon_stats USING (dc_id)""",
    "kpi_renewable_ratio": f"""
        SELECT region_id, {_sum('mw')} AS capacity_mw,
               {_sum('mw * renewable_pct')} / nullif({_sum('mw')}, 0) AS renewable_pct
        FROM (SELECT region_id, capacity_mw AS mw, renewable_pct FROM sites
              WHERE construction_status = 'operational') GROUP BY 1""",
    "region_object": """
        SELECT region_id, region_name, states_covered, population, area_sq_miles,
               baseline_avg_demand_mw AS baseline_demand_mw,
               current_avg_demand_mw AS current_demand_mw, energy_delta_pct AS demand_delta_pct,
               total_dc_capacity_mw, CAST(total_dc_count AS INTEGER) AS dc_count
        FROM profiles LEFT JOIN kpi USING (region_id)""",
    "top_regions": """
        SELECT region_id, energy_delta_pct FROM kpi
        ORDER BY energy_delta_pct DESC NULLS LAST, region_id LIMIT 5""",
    "demand_timeseries": f"""
        SELECT *, demand_mw - demand_30d_avg_mw AS demand_anomaly_mw FROM (
            SELECT region_id, "timestamp", demand_mw, temperature_f,
                   {_trailing(7 * 86400, 'demand_7d_avg_mw')},
                   {_trailing(30 * 86400, 'demand_30d_avg_mw')} FROM hourly)""",
    "demand_change": """
        SELECT region_id, "timestamp", demand_mw, demand_mw - p AS change,
               (demand_mw - p) / nullif(CAST(epoch_us("timestamp") - epoch_us(pt) AS DOUBLE)
                                        / 3600000000, 0) AS change_per_hour
        FROM (SELECT region_id, "timestamp", demand_mw, lag(demand_mw) OVER w AS p,
                     lag("timestamp") OVER w AS pt FROM hourly
              WINDOW w AS (PARTITION BY region_id ORDER BY "timestamp", demand_mw))""",
    "price_acceleration": """
        SELECT event_id, pnode_id, "timestamp", total_lmp, change,
               change - lag(change) OVER (PARTITION BY pnode_id ORDER BY "timestamp", event_id)
                   AS acceleration
        FROM (SELECT event_id, CAST(user_id AS VARCHAR) AS pnode_id, ts AS "timestamp",
                     value * 5 AS total_lmp, value * 5 - lag(value * 5) OVER (
                         PARTITION BY user_id ORDER BY ts, event_id) AS change FROM events)""",
    "rolling_deviation": f"""
        SELECT region_id, "timestamp", demand_mw, rolling_avg_mw, d AS deviation_pct,
               {_severity('d')} AS severity
        FROM (SELECT *, CASE WHEN rolling_avg_mw > 0
                             THEN (demand_mw - rolling_avg_mw) / rolling_avg_mw * 100 END AS d
              FROM (SELECT region_id, "timestamp", demand_mw,
                           {_trailing(168 * 3600, 'rolling_avg_mw')} FROM hourly))
        WHERE abs(d) > 10""",
    "timeseries_long": " UNION ALL ".join(
        f"SELECT reading_id, region_id, \"timestamp\", '{c}' AS property, {c} AS value FROM detailed"
        for c in ("demand_mw", "temperature_f", "price_per_mwh")),
    "live_demand": "SELECT * FROM live",
    "feed_health": f"""
        SELECT count(*) AS observed_rows, count(*) AS stored_rows,
               count(*) FILTER (latency_seconds > {L.LATENCY_TARGET_S}) AS late_rows,
               CAST(max(latency_seconds) AS DOUBLE) AS max_latency_s FROM live""",
    "demand_anomalies": "SELECT * FROM anomalies",
    "demand_anomalies_batch": "SELECT * FROM anomalies",
    "versioned_anomalies": "SELECT * FROM versioned",
    "live_pricing": "SELECT * EXCLUDE (event_id) FROM prices",
    "stream_price_dedup": """SELECT DISTINCT pnode_id, "timestamp" FROM prices""",
    "stream_dedup": """SELECT DISTINCT reading_id, region_id, "timestamp" FROM live""",
    # windows are complete once the newest reading is 15 minutes past their end
    "stream_hourly": f"""
        SELECT region_id, window_start, window_start + INTERVAL 1 HOUR AS window_end,
               avg_demand_mw, readings
        FROM (SELECT event_type AS region_id, date_trunc('hour', ts) AS window_start,
                     {_avg('value')} AS avg_demand_mw, count(*) AS readings FROM events GROUP BY 1, 2)
        WHERE window_start + INTERVAL 1 HOUR
              <= (SELECT max(ts) - INTERVAL 15 MINUTE FROM events)""",
    "stream_sliding": f"""
        SELECT region_id, window_start, window_start + INTERVAL 7 DAY AS window_end,
               avg_demand_mw, readings
        FROM (SELECT event_type AS region_id, date_trunc('day', ts) - to_days(CAST(range AS INTEGER))
                         AS window_start,
                     {_avg('value')} AS avg_demand_mw, count(*) AS readings
              FROM events, range(7) GROUP BY 1, 2)
        WHERE window_start + INTERVAL 7 DAY
              <= (SELECT max(ts) - INTERVAL 15 MINUTE FROM events)""",
    # a cut at the newest times leaves the values before it as they are
    "stream_change": """
        SELECT region_id, "timestamp", demand_mw, previous_mw, change_mw,
               change_mw - lag(change_mw) OVER (PARTITION BY region_id ORDER BY "timestamp")
                   AS acceleration_mw
        FROM (SELECT region_id, "timestamp", demand_mw, lag(demand_mw) OVER w AS previous_mw,
                     demand_mw - lag(demand_mw) OVER w AS change_mw
              FROM (SELECT region_id, "timestamp", min(demand_mw) AS demand_mw FROM live GROUP BY 1, 2)
              WINDOW w AS (PARTITION BY region_id ORDER BY "timestamp"))
        -- what the watermark has passed
        WHERE "timestamp" <= (SELECT max("timestamp") - INTERVAL 15 MINUTE FROM live)""",
    "forecast_predict": _forecast("regions", 5),
    "forecast_impact": _forecast("regions", 3, "impact"),
    "flagged_anomalies": """
        SELECT a.* EXCLUDE (processing_timestamp), notes, notes IS NOT NULL AS flagged
        FROM anomalies a LEFT JOIN (
            SELECT DISTINCT event_type AS region_id,
                   date_trunc('day', ts) + INTERVAL 12 HOUR AS "timestamp",
                   'check ' || event_type AS notes FROM events)
        USING (region_id, "timestamp")""",
    "batch_events": "SELECT * FROM batch_site_events",
    "batch_kpi": "SELECT * FROM batch_summary",
    "batch_forecasts": _forecast("batch_regions", 3, "batch_impact"),
    "updated_monthly": "SELECT * FROM batch_monthly",
    "updated_kpi": "SELECT * FROM batch_summary",
    "merged_monthly": """
        SELECT m.*, min_demand_mw, max_demand_mw FROM monthly m JOIN (
            SELECT region_id, CAST(date_trunc('month', "timestamp") AS TIMESTAMP) AS month,
                   min(demand_mw) AS min_demand_mw, max(demand_mw) AS max_demand_mw
            FROM readings GROUP BY 1, 2) USING (region_id, month)""",
}

CTES["j"] = """
        SELECT r.region_id, "timestamp", demand_mw, cooling_degree_days AS c,
               heating_degree_days AS h
        FROM readings r LEFT JOIN weather w
          ON r.region_id = w.region_id AND CAST("timestamp" AS DATE) = w.date"""

# alerts: each one is followed by the first anomaly at least an hour later
_COOLDOWN = """
    WITH RECURSIVE slots AS MATERIALIZED (
        SELECT DISTINCT event_type AS region_id, ts AS m FROM events),
    fired AS (
        SELECT region_id, min(m) AS alert_time FROM slots GROUP BY 1
        UNION ALL
        SELECT f.region_id, (SELECT min(m) FROM slots s WHERE s.region_id = f.region_id
                             AND s.m >= f.alert_time + INTERVAL 60 MINUTE) AS alert_time
        FROM fired f WHERE f.alert_time IS NOT NULL)
    SELECT region_id, alert_time FROM fired WHERE alert_time IS NOT NULL"""

_FOLLOWED = f"""
    WITH RECURSIVE pages AS (
        SELECT DISTINCT event_id // 5000 AS request, event_id // 250 % 20 AS page_no FROM events),
    onward AS (
        SELECT request, page_no, CASE WHEN request = 0 AND page_no = 1 THEN 3
                                      WHEN request = 1 AND page_no = 19 THEN 5
                                      ELSE page_no + 1 END AS following FROM pages),
    walk AS (
        SELECT request, page_no, 0 AS position, [page_no] AS seen FROM pages WHERE page_no = 0
        UNION ALL
        SELECT w.request, p.page_no, position + 1, list_append(seen, p.page_no)
        FROM walk w JOIN onward o ON o.request = w.request AND o.page_no = w.page_no
        JOIN pages p ON p.request = w.request AND p.page_no = o.following
        WHERE NOT list_contains(seen, p.page_no))
    SELECT w.request, CAST(w.page_no AS INTEGER) AS page_no, CAST(position AS BIGINT) AS position,
           {_MARKET_AT}, upper(event_type) AS zone, value AS mw
    FROM events JOIN walk w ON w.request = event_id // 5000 AND w.page_no = event_id // 250 % 20"""


def _used(sql: str) -> list[str]:
    """Names of the domain tables a statement needs, those it builds on first."""
    found: list[str] = []

    def visit(text: str) -> None:
        for name in CTES:
            if name not in found and re.search(rf"(?:FROM|JOIN|,)\s+{name}\b", text):
                visit(CTES[name])
                if name not in found:
                    found.append(name)

    visit(sql)
    return found


def statement(sql: str) -> str:
    names = _used(sql)
    if not names:
        return sql
    return "WITH " + ",\n".join(f"{n} AS ({CTES[n]})" for n in names) + "\n" + sql


def _object_checks() -> str:
    from ..sources.schemas import OBJECT_TYPES

    have = {
        "energy-reading": (
            "batch_readings", "reading_id string, region_id string, balancing_authority string, "
            "timestamp timestamp, demand_mw double, generation_mw double, temperature_f double, "
            "cooling_degree_days double, price_per_mwh double, source_mix string, "
            "carbon_intensity_gco2_kwh double, data_source string, ingestion_timestamp timestamp"),
        "data-center": (
            "sites", "dc_id string, name string, region_id string, state string, "
            "capacity_mw double, ai_focused boolean, gpu_count bigint, operational_date date, "
            "construction_status string, renewable_pct double"),
        "correlation-event": ("site_events", None),
        "energy-region": ("profiles", None),
    }
    wanted = {t: {f.name: f.dataType.simpleString() for f in o["schema"]} for t, o in OBJECT_TYPES.items()}
    event_columns = (
        "event_id dc_id dc_name region_id analysis_date pre_period_start pre_period_end "
        "post_period_start post_period_end pre_period_avg_demand_mw post_period_avg_demand_mw "
        "delta_demand_mw delta_demand_pct pearson_correlation spearman_correlation p_value "
        "confidence_score control_region_id control_delta_pct adjusted_delta_pct "
        "analysis_window_months data_completeness methodology").split()
    parts = []
    for kind, (source, columns) in have.items():
        want = wanted[kind]
        if columns:
            got = dict(c.split() for c in columns.split(", "))
        elif kind == "correlation-event":
            got = {c: want.get(c, "?") for c in event_columns}
        else:
            got = dict(want)
        rows = [("missing_column", c) for c in want if c not in got]
        rows += [("extra_column", c) for c in got if c not in want]
        rows += [("type_mismatch", c) for c in want if c in got and got[c] != want[c]]
        parts += [
            f"SELECT '{kind}' AS object_type, '{f}' AS finding, '{c}' AS \"column\", 1 AS n"
            for f, c in rows
        ]
        key = OBJECT_TYPES[kind]["key"]
        parts.append(
            f"SELECT '{kind}', 'duplicate_key', '{key}', CAST(sum(n) AS BIGINT) FROM "
            f"(SELECT count(*) AS n FROM {source} WHERE {key} IS NOT NULL GROUP BY {key} "
            f"HAVING count(*) > 1) HAVING sum(n) > 0"
        )
        parts.append(
            f"SELECT '{kind}', 'null_key', '{key}', count(*) FROM {source} "
            f"WHERE {key} IS NULL HAVING count(*) > 0"
        )
    return "SELECT object_type, finding, \"column\", CAST(n AS BIGINT) AS n FROM (" + \
        " UNION ALL ".join(parts) + ")"


CTES["batch_readings"] = """
        SELECT 'eia_' || lower(respondent) || '_' || replace(replace(period, '-', ''), 'T', '')
                   AS reading_id FROM demand_records"""


def statements() -> dict[str, str]:
    """One statement per registered query."""
    out = {name: statement(sql) for name, sql in QUERIES.items()}
    out["object_key_checks"] = statement(_object_checks())
    out["followed_pages"] = _FOLLOWED
    out["alert_cooldown"] = out["alert_cooldown_batch"] = _COOLDOWN
    # the same records by way of stored tables or landed files
    landed = {"stored_weather_join": "weather_join", "stored_correlations": "regional_correlations",
              "ingest_landed_days": "ingest_demand", "landed_climate": "weather_pivot",
              "landed_stations": "stations_in_bbox"}
    out |= {name: out[same] for name, same in landed.items()}
    return out
