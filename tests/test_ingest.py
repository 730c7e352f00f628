import json
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from gridtide.operators import enrich, ingest, quality
from gridtide.sources import feeds, landing, schemas

def now():
    return F.lit(datetime(2024, 1, 2))


def registry(spark, *rows):
    names = [c.split()[0] for c in ingest.REGISTRY_RAW.split(", ")]
    data = [tuple(row.get(n) for n in names) for row in rows]
    return spark.createDataFrame(data, ingest.REGISTRY_RAW)


def test_registry_record(spark):
    raw = registry(spark, dict(
        id="test-dc-1", name="Test AI Data Center", owner="OpenAI", lat="39.0438", lon="-77.4874",
        state="VA", power_capacity_mw="100.0", gpu_count="10000", status="operational"))
    row = ingest.normalize_registry(raw).first()
    assert row["dc_id"] == "epoch_test-dc-1"
    assert (row["name"], row["owner"]) == ("Test AI Data Center", "OpenAI")
    assert (row["latitude"], row["longitude"]) == (39.0438, -77.4874)
    assert (row["capacity_mw"], row["gpu_count"], row["pue"]) == (100.0, 10000, 1.3)
    assert row["ai_focused"] is True
    assert row["construction_status"] == "operational"
    assert row["data_source"] == "epoch_ai"
    assert [f.name for f in ingest.normalize_registry(raw).schema] == [f.name for f in schemas.REGISTRY]
    types = {f.name: f.dataType for f in ingest.normalize_registry(raw).schema}
    assert all(types[f.name] == f.dataType for f in schemas.REGISTRY)


def test_registry_defaults_and_alternates(spark):
    raw = registry(spark, dict(company="Acme", operational_date="someday"), dict(
        name="Big Hall", company="Acme", lng="5", capacity_mw="x", accelerator_count="12.7",
        online_date="2020-02-03", groundbreaking="2019-01-01"))
    blank, hall = ingest.normalize_registry(raw).collect()
    assert (blank["dc_id"], blank["name"], blank["state"]) == ("epoch_unknown", "Unknown", "")
    assert (blank["owner"], blank["operator"]) == ("Acme", "Unknown")
    assert blank["operational_date"] is None
    assert hall["dc_id"] == "epoch_big_hall"
    assert (hall["longitude"], hall["capacity_mw"], hall["gpu_count"]) == (5.0, None, None)
    assert hall["ai_focused"] is True
    assert str(hall["operational_date"]) == "2020-02-03"
    assert str(hall["construction_start_date"]) == "2019-01-01"


def test_registry_keeps_most_recent(spark):
    raw = registry(
        spark,
        dict(id="a", last_updated="2024-01-01", state="VA"),
        dict(id="a", last_updated="2024-03-01", state="TX"),
        dict(id="a", state="CA"),
        dict(id="b", state="GA"),
    )
    got = {r["dc_id"]: r["state"] for r in ingest.ingest_registry(raw).collect()}
    assert got == {"epoch_a": "TX", "epoch_b": "GA"}


def test_latest_record_of_a_key_with_many_copies(spark):
    copies = spark.range(20000).select(
        F.when(F.col("id") % 3 == 0, F.col("id")).otherwise(0).alias("k"),
        (F.col("id") % 977).alias("at"), F.col("id").alias("v"))
    got = ingest.keep_latest(copies, ["k"], "at", "v")
    assert got.count() == copies.select("k").distinct().count()
    top = copies.where("k = 0").orderBy(F.desc("at"), F.desc("v")).first()
    assert got.where("k = 0").first() == top
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan


def page(rows, total):
    return json.dumps({"response": {"data": rows, "total": total}})


def test_landed_pages(spark, tmp_path):
    rows = [
        {"period": "2024-01-01T05", "respondent": "PJM", "type": "D", "value": "12.5",
         "respondent-name": "PJM Grid", "value-units": "megawatthours"},
        {"period": "2024-01-01T06", "respondent": "ERCO", "type": "D", "value": 7},
        {"period": "2023-01-01T06", "respondent": "PJM", "type": "D", "value": "1"},
    ]
    (tmp_path / "a.json").write_text(json.dumps({"response": {"data": rows, "total": 4}}, indent=1))
    (tmp_path / "b.json").write_text(page([{**rows[0], "value": "n/a", "period": "bad"}], "4"))
    records = landing.read_feed(spark, str(tmp_path), feeds.DEMAND)
    assert records.count() == 4
    done = feeds.page_completeness(
        landing.read_pages(spark, str(tmp_path), feeds.DEMAND).withColumn("r", F.lit(1)), "r").first()
    assert (done["pages"], done["received"], done["announced"], done["complete"]) == (2, 4, 4, True)

    demand = ingest.ingest_demand(records, now(), now(), ["PJM", "ERCO"])
    got = {(r["respondent"], r["period"]): r for r in demand.collect()}
    assert set(got) == {("PJM", "2024-01-01T05"), ("ERCO", "2024-01-01T06")}
    first = got["PJM", "2024-01-01T05"]
    assert (first["value"], first["respondent_name"], first["value_units"]) == (
        12.5, "PJM Grid", "megawatthours")
    assert demand.schema.simpleString() == schemas.DEMAND_FEED.simpleString()

    reading = enrich.normalize_readings(demand.where("respondent = 'PJM'")).first()
    assert reading["reading_id"] == "eia_pjm_2024010105"
    assert (reading["region_id"], reading["balancing_authority"]) == ("pjm", "PJM")
    assert reading["generation_mw"] is None and reading["data_source"] == "eia_rto"
    types = [(f.name, f.dataType) for f in enrich.normalize_readings(demand).schema]
    assert types == [(f.name, f.dataType) for f in schemas.READING]


def test_empty_feed_is_typed(spark, tmp_path):
    (tmp_path / "empty").mkdir()
    (tmp_path / "empty" / "x.json").write_text(page([], 0))
    records = landing.read_feed(spark, str(tmp_path / "empty"), feeds.DEMAND, lines=True)
    demand = ingest.ingest_demand(records, now())
    assert demand.count() == 0 and demand.dtypes == landing.empty(spark, schemas.DEMAND_FEED).dtypes
    assert landing.empty(spark, schemas.REGISTRY).schema == schemas.REGISTRY


def test_market_pages_end_with_their_chain(spark):
    def body(n, items, following):
        links = [{"rel": "next", "href": "x"}] if following else [{"rel": "self", "href": "x"}]
        return json.dumps({"items": [{"zone": f"{n}-{i}"} for i in range(items)], "links": links})

    pages = [(1, 0, body(0, 2, True)), (1, 1, body(1, 1, False)), (1, 2, body(2, 5, True)),
             (2, 0, body(0, 1, True)), (2, 1, body(1, 0, True)), (2, 2, body(2, 1, True)),
             *[(3, n, body(n, 1, True)) for n in range(14)]]
    df = spark.createDataFrame(pages, "request int, page_no int, body string")
    kept = feeds.linked_pages(feeds.parse_pages(df, feeds.METERED_LOAD), "request", "page_no")
    items = feeds.records(kept, feeds.METERED_LOAD)
    assert items.count() == 3 + 1 + 14
    kept = feeds.linked_pages(feeds.parse_pages(df, feeds.METERED_LOAD), "request", "page_no", 10)
    assert feeds.records(kept, feeds.METERED_LOAD).count() == 3 + 1 + 10


def test_pages_without_request_are_one_chain(spark):
    def body(following):
        return json.dumps({"items": [{"zone": "z"}], "links": [{"rel": "next"}] if following else []})

    pages = [(None, 0, body(True)), (None, 1, body(False)), (None, 2, body(True)), (1, 0, body(True))]
    df = spark.createDataFrame(pages, "request int, page_no int, body string")
    kept = feeds.linked_pages(feeds.parse_pages(df, feeds.METERED_LOAD), "request", "page_no")
    got = sorted((r["request"] or 0, r["page_no"]) for r in kept.collect())
    assert got == [(0, 0), (0, 1), (1, 0)]


def test_links_are_followed_whatever_the_numbering(spark):
    import random

    def body(items, *hrefs):
        links = [{"rel": "self", "href": "me"}] + [{"rel": "next", "href": h} for h in hrefs]
        return json.dumps({"items": [{"zone": "z"}] * items, "links": links})

    def page(request, address, body, first=False):
        return (request, address, first, body)

    names = [f"n{i}" for i in range(100)]
    random.Random(3).shuffle(names)
    pages = [page(1, names[i], body(1, *names[i + 1 : i + 2]), i == 0) for i in range(100)]
    # a cycle behind a stem, a fork, an empty page, a missing target, no request, a page twice
    pages += [page(2, "a", body(1, "b"), True), page(2, "b", body(1, "c")), page(2, "c", body(1, "b")), page(2, "d", body(1, "a"))]
    pages += [page(3, "a", body(1, "c", "b"), True), page(3, "b", body(1)), page(3, "c", body(0, "b"))]
    pages += [page(4, "a", body(1, "x"), True), page(None, "a", body(1, "b"), True), page(None, "b", body(1)), page(None, "c", body(1))]
    pages += [page(5, "a", body(1, "c"), True), page(5, "a", body(1, "b"), True), page(5, "b", body(1)), page(5, "c", body(1))]
    pages += [page(6, "a", body(1, "a"), True), page(7, "b", body(1, "a")), page(8, None, body(1, "a"), True)]
    random.Random(4).shuffle(pages)
    df = spark.createDataFrame(pages, "request int, address string, first boolean, body string")
    parsed = feeds.parse_pages(df, feeds.METERED_LOAD)
    found = feeds.followed_pages(parsed, "request", "address", F.col("first"))
    assert found.columns == [*parsed.columns, "position"]
    got = sorted(((r["request"] or 0), r["position"], r["address"]) for r in found.collect())
    want = [(1, i, name) for i, name in enumerate(names)]
    want += [(2, 0, "a"), (2, 1, "b"), (2, 2, "c"), (3, 0, "a"), (3, 1, "c"), (4, 0, "a"), (0, 0, "a"), (0, 1, "b")]
    want += [(5, 0, "a"), (5, 0, "a"), (5, 1, "b"), (6, 0, "a")]
    assert got == sorted(want)
    few = feeds.followed_pages(parsed.where("request = 1"), "request", "address", F.col("first"), 10)
    assert sorted(r["address"] for r in few.collect()) == sorted(names[:10])
    assert feeds.followed_pages(parsed.limit(0), "request", "address", F.col("first")).count() == 0


def test_retail_and_baseline(spark, tmp_path):
    rows = [("2014-02", "VA", "RES", "1.5", "2", "x", None, 1), ("2014-02", "VA", "RES", "2.5", "2", "9", None, 2),
            ("2013-12", "VA", "RES", "1", "1", "1", "1", 1), ("2014-02", "VA", "TRA", "1", "1", "1", "1", 1)]
    raw = spark.createDataFrame(
        rows, "period string, stateid string, sectorid string, sales string, revenue string, "
        "price string, customers string, at int"
    ).withColumns({"stateDescription": F.lit("Virginia"), "sectorName": F.lit("residential")})
    got = ingest.ingest_retail(raw, F.timestamp_add("DAY", F.col("at"), now()), ["VA"]).collect()
    assert [(r["period"], r["sectorid"], r["sales"], r["price"]) for r in got] == [("2014-02", "RES", 2.5, 9.0)]

    fixed = landing.read_national_baseline(spark)
    assert fixed.count() == 11 and fixed.where("year = 2023").first()["consumption_twh"] == 176.0
    path = tmp_path / "b.csv"
    path.write_text("year,dc_type,consumption_twh,pct_of_national,is_projected,source\n2028,all,325,6.7,true,x\n")
    assert landing.read_national_baseline(spark, str(path)).first()["is_projected"] is True


def test_overlapping_batches_append_once(spark, tmp_path):
    keys = ["period", "respondent"]
    frame = lambda rows: spark.createDataFrame(rows, "period string, respondent string, value double")
    landing.write_dataset(frame([("2024-01-01T00", "A", 1.0), ("2024-01-02T00", "A", 2.0)]), str(tmp_path / "d"))
    batch = frame([("2024-01-02T00", "A", 9.0), ("2024-01-03T00", "A", 3.0), ("2024-01-02T00", "B", 4.0)])
    landing.append_new(batch, str(tmp_path / "d"), keys, since="period")
    landing.append_new(batch, str(tmp_path / "d"), keys)
    got = sorted(tuple(r) for r in landing.read_dataset(spark, str(tmp_path / "d")).collect())
    assert got == [("2024-01-01T00", "A", 1.0), ("2024-01-02T00", "A", 2.0), ("2024-01-02T00", "B", 4.0),
                   ("2024-01-03T00", "A", 3.0)]


def test_increments_into_month_folders(spark, tmp_path):
    def frame(*rows):
        return spark.createDataFrame(rows, "id int, at string, value int").withColumn("at", F.col("at").cast("timestamp"))

    path = str(tmp_path / "months")
    landing.write_dataset(frame((1, "2024-01-05", 1), (2, "2024-02-05", 2)), path, "at")
    batch = frame((2, "2024-02-05", 9), (3, "2024-02-06", 3), (3, "2024-02-06", 4), (4, "2024-03-01", 5))
    for _ in range(2):
        landing.append_new(batch, path, ["id", "at"], since="at", month_of="at", newest="value")
    got = sorted((r["id"], r["value"], r["month_part"]) for r in landing.read_dataset(spark, path).collect())
    assert got == [(1, 1, "2024-01"), (2, 2, "2024-02"), (3, 4, "2024-02"), (4, 5, "2024-03")]
    with pytest.raises(ValueError):
        landing.append_new(batch, path, ["id", "at"])


def test_month_folders_keep_all_rows(spark, tmp_path):
    df = spark.range(1000).select(
        "id", F.timestamp_add("DAY", (F.col("id") % 70).cast("int"), now()).alias("timestamp"))
    landing.write_dataset(df, str(tmp_path / "m"), "timestamp")
    assert landing.read_dataset(spark, str(tmp_path / "m")).select("id").distinct().count() == 1000
    assert (tmp_path / "m" / "month_part=2024-02").exists()


def test_regions_and_markets(spark):
    sites = spark.createDataFrame([("VA",), ("TX",), ("NY",), (None,)], "state string")
    got = {r["state"]: (r["balancing_authority"], r["region_id"]) for r in enrich.enrich_regions(sites).collect()}
    assert got == {"VA": ("PJM", "pjm"), "TX": ("ERCO", "erco"), "NY": (None, "unknown"), None: (None, "unknown")}
    assert ingest.authorities_of_markets() == sorted(
        ["PJM", "ERCO", "SRP", "AZPS", "MISO", "SOCO", "CISO", "BPAT", "NEVP"])
    codes = spark.createDataFrame([("PJM",), ("MISO",), ("XX",)], "balancing_authority string")
    markets = sorted(r["market"] for r in ingest.by_market(codes).where("balancing_authority = 'PJM'").collect())
    assert markets == ["chi", "coh", "nova", "phl"]


def test_fuel_mix(spark):
    rows = [("a", "NG", 30.0), ("a", "NUC", 10.0), ("a", "NG", 40.0), ("b", "SUN", 0.0)]
    df = spark.createDataFrame(rows, "region_id string, fueltype string, value double")
    got = {r["region_id"]: r["source_mix"] for r in quality.fuel_mix(df, ["region_id"]).collect()}
    assert json.loads(got["a"]) == {"NG": 0.875, "NUC": 0.125}


def test_feed_pages_and_filters(spark):
    rows = [(f"2024-01-0{d}T00", r, str(d)) for d in range(1, 8) for r in ("A", "B")]
    df = spark.createDataFrame(rows, "period string, respondent string, value string")
    cut = feeds.demand_page(df, "respondent", offset=3, length=2).collect()
    assert [(r["period"], r["respondent"]) for r in cut] == [("2024-01-06T00", "B"), ("2024-01-05T00", "A")]
    assert feeds.page(df, "period", "respondent", descending=False, length=1).first()["value"] == "1"
    assert feeds.demand(df, []).count() == 14
    assert feeds.demand(df, ["A"], "2024-01-03T00").count() == 5
    late = feeds.latest_demand(df, F.lit(datetime(2024, 1, 7)), ["B"], 48).collect()
    assert [r["value"] for r in late] == ["7", "6", "5"]
    lmp = df.select(F.col("period").alias("datetime_beginning_ept"), F.col("respondent").alias("pnode_id"))
    assert feeds.market_range(lmp, feeds.LMP, "2024-01-06", nodes=["A"]).count() == 2
    assert feeds.market_range(lmp, feeds.LMP, nodes=[], rows=3).count() == 3
