"""Every registered query against its SQL counterpart, and the shape of its plan."""

import os
import sys
from datetime import date
from pathlib import Path

import duckdb
import numpy as np
import pandas as pd
import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

import __spark_entry__ as entry_module  # noqa: E402
from gridtide.plans import catalog, oracle  # noqa: E402

FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()
QUERIES, SQL = catalog.QUERIES, oracle.statements()
STREAMS = {
    "live_demand", "demand_anomalies", "live_pricing", "stream_dedup", "stream_price_dedup", "stream_hourly",
    "stream_sliding", "stream_change", "alert_cooldown", "accepted_rows", "rejected_rows", "feed_health",
    "versioned_anomalies",
}
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{FOLDER}/{name}.parquet'")
    return con


def plain(value):
    if pd.isna(value):
        return ""
    if isinstance(value, (bool, np.bool_, str)):
        return str(value)
    if isinstance(value, date):
        return value.isoformat()
    return repr(float(value))


def rows(frame):
    frame = frame[sorted(frame.columns)].astype(object)
    return sorted(tuple(map(plain, r)) for r in frame.itertuples(index=False, name=None))


def test_every_query_has_sql():
    assert set(QUERIES) == set(SQL)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_equals_sql(spark, duck, name):
    got, want = QUERIES[name](spark, FOLDER).toPandas(), duck.execute(SQL[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert rows(got) == rows(want)


@pytest.mark.parametrize("name", sorted(set(QUERIES) - STREAMS))
def test_plan_pairs_nothing_blindly(spark, name):
    plan = QUERIES[name](spark, FOLDER)._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan
    assert "BroadcastNestedLoopJoin" not in plan
    assert "BatchEvalPython" not in plan


def test_columns_and_filters_reach_the_scan(spark):
    plan = QUERIES["scan_demand"](spark, FOLDER)._jdf.queryExecution().executedPlan().toString()
    assert "props" not in plan
    plan = QUERIES["incremental_append"](spark, FOLDER)._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(ts," in plan and "LessThan(ts," in plan


@pytest.mark.parametrize("name, joins", [("stored_weather_join", 1), ("stored_correlations", 1)])
def test_stored_readings_are_joined_without_an_exchange(spark, name, joins):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = QUERIES[name](spark, FOLDER)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert plan.count("SortMergeJoin") == joins
    below = plan[plan.index("SortMergeJoin"):]
    assert "Exchange" not in below and below.count("Bucketed: true") == 2


def test_landed_days_are_pruned(spark):
    plan = QUERIES["ingest_landed_days"](spark, FOLDER)._jdf.queryExecution().executedPlan().toString()
    filters = [line for line in plan.splitlines() if "PartitionFilters" in line]
    assert filters and all("day_part" in line.split("PartitionFilters")[1] for line in filters)


def test_only_real_orphans_are_reported(spark):
    from pyspark.sql import functions as F

    batch = catalog.run_batch(catalog.batch_inputs(spark, FOLDER), catalog.T.as_of(), catalog.T.now())
    sites, readings, changes = (batch[n] for n in ("data_centers", "energy", "events"))
    served = catalog.T.served_regions(spark, FOLDER)
    known = sites.join(served, "region_id", "left_semi")
    assert catalog.quality.link_orphans(known, changes, readings, served).count() == 0
    small = known.where("capacity_mw <= 50").limit(1).withColumns(
        {"dc_id": F.lit("small"), "capacity_mw": F.lit(None).cast("double")}
    )
    lost = small.withColumns({"dc_id": F.lit("lost"), "region_id": F.lit("unknown")})
    planted = changes.limit(1).withColumns({"event_id": F.lit("e1"), "dc_id": F.lit("small")})
    astray = planted.withColumns({"event_id": F.lit("e2"), "dc_id": F.lit("none"), "region_id": F.lit("mu")})
    reading = readings.limit(1).withColumns({"reading_id": F.lit("r"), "region_id": F.lit("mu")})
    found = catalog.quality.link_orphans(
        known.unionByName(small).unionByName(lost), changes.unionByName(planted).unionByName(astray),
        readings.unionByName(reading), served,
    )
    assert sorted(map(tuple, found.collect())) == [
        ("correlation-for-dc", "e2", "none"),
        ("correlation-in-region", "e2", "mu"),
        ("data-center-in-region", "lost", "unknown"),
        ("reading-for-region", "r", "mu"),
    ]


def test_flagship(spark):
    if os.path.isdir("/root/testdata/sf0.001"):
        assert entry_module.entry(spark).count() == 8


def test_batch_tables_on_disk_equal_the_lazy_ones(spark, tmp_path):
    from gridtide.plans import batch, catalog
    from gridtide.plans import tables as T

    inputs = catalog.batch_inputs(spark, FOLDER)
    batch.write_batch(spark, inputs, T.as_of(), T.now(), str(tmp_path))
    lazy = batch.run_batch(inputs, T.as_of(), T.now())
    for name in ("events", "kpi_summary", "demand_forecasts", "capacity_timeline"):
        stored = spark.read.parquet(str(tmp_path / name)).toPandas()
        assert rows(stored) == rows(lazy[name].toPandas()), name


def test_late_records_change_their_months_only(spark, tmp_path):
    from dataclasses import replace

    from pyspark.sql import functions as F

    from gridtide.plans import batch, catalog, updates
    from gridtide.plans import tables as T

    inputs = catalog.batch_inputs(spark, FOLDER)
    late = (F.substring("period", 1, 7) == "1996-05") & (F.col("respondent") == "PJM")
    whole, folder = str(tmp_path / "whole"), str(tmp_path / "parts")
    batch.write_batch(spark, inputs, T.as_of(), T.now(), whole)
    batch.write_batch(spark, replace(inputs, demand=inputs.demand.where(~late)), T.as_of(), T.now(), folder)

    def files():
        return {p: p.stat().st_mtime_ns for p in Path(folder).rglob("*.parquet")}

    before = files()
    more = replace(inputs, demand=inputs.demand.where(late))
    written = updates.update_batch(spark, more, T.as_of(), T.now(), folder)
    assert written == {"energy": ["1996-05"], "energy_monthly": ["1996-05"],
                       "demand_timeseries": ["1996-05", "1996-06"]}
    after = files()
    touched = {p.parent.name for p in before.keys() ^ after.keys() if "month_part" in p.parent.name}
    assert touched == {"month_part=1996-05", "month_part=1996-06"}
    for name in ("energy", "energy_monthly", "demand_timeseries", "events", "kpi_summary",
                 "regional_correlations", "demand_forecasts"):
        got, want = (spark.read.parquet(f"{f}/{name}").toPandas() for f in (folder, whole))
        assert sorted(got.columns) == sorted(want.columns)
        assert rows(got) == rows(want), name
    # the same records again, or none, change nothing
    stamps = files()
    assert updates.update_batch(spark, more, T.as_of(), T.now(), folder) == {}
    none = replace(inputs, demand=inputs.demand.limit(0))
    assert updates.update_batch(spark, none, T.as_of(), T.now(), folder) == {}
    assert files() == stamps
    # another day of analysis makes all events anew
    day = F.lit(date(2001, 10, 1))
    again = replace(inputs, demand=inputs.demand.where(late).withColumns(
        {"value": F.lit("5.5"), "landed_at": F.lit(date(2002, 1, 1)).cast("timestamp")}))
    updates.update_batch(spark, again, day, T.now(), folder)
    assert {r[0] for r in spark.read.parquet(f"{folder}/events").select("analysis_date").distinct().collect()} == {date(2001, 10, 1)}


def test_months_that_averages_reach():
    from gridtide.plans import updates
    assert updates.reached(["2023-01"]) == ["2023-01", "2023-02", "2023-03"]
    assert updates.reached(["2024-01", None]) == [None, "2024-01", "2024-02", "2024-03"]
    assert updates.reached(["2023-12"]) == ["2023-12", "2024-01"]
    assert updates.reached(["2023-03"], back=True) == ["2023-01", "2023-02", "2023-03"]


def test_monthly_parts_merge_exactly(spark, tmp_path):
    from pyspark.sql import functions as F

    from gridtide.operators import events
    from gridtide.plans import updates

    values = [0.1, 0.2, 1e13 + 0.1, -1e13, None, 1e-9, 3.3, 7.0, 5e30]
    data = [(f"r{i % 3}" if i % 7 else None, f"2024-0{1 + i % 4}-03 04:00:00", values[i % 9], i) for i in range(300)]
    energy = spark.createDataFrame(data, "region_id string, at string, demand_mw double, i int").withColumn(
        "timestamp", F.to_timestamp("at"))
    path = str(tmp_path / "parts")
    for number in (0, 1, 2, 0):
        updates.add_increment(energy.where(F.col("i") % 3 == number), path, str(number))
    want = events.monthly_energy(energy).toPandas()
    updates.compact(spark, path, str(tmp_path / "one"))
    for folder in (path, str(tmp_path / "one")):
        got = updates.stored_monthly(spark, folder).toPandas()
        assert rows(got.drop(columns=["min_demand_mw", "max_demand_mw"])) == rows(want)
        assert got["max_demand_mw"].max() == 5e30
