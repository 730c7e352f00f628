import json
import os
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from gridtide.session import scratch_dir
from gridtide.sources import landing, schemas
from gridtide.streaming import cooldown, live, run, sideinput, stateful, supervise

START = datetime(2024, 1, 1)


def now():
    return F.lit(datetime(2024, 2, 1))


def put(folder, name, rows):
    folder.mkdir(exist_ok=True)
    path = folder / name
    path.write_text("".join(json.dumps(r) + "\n" for r in rows))
    # the file source takes files in the order of their modification times
    age = 1_700_000_000 + 60 * int(path.stem)
    os.utime(path, (age, age))


def record(hour, region, value):
    at = START + timedelta(hours=hour)
    return {"period": at.strftime("%Y-%m-%dT%H"), "respondent": region, "value": str(value)}


def stream(spark, folder, per_batch=1):
    return landing.stream_files(spark, str(folder), schemas.LIVE_DEMAND_FEED, "json", per_batch)


def test_live_demand_parses_and_filters(spark):
    rows = [("2024-01-01T05", "PJM", "10.5"), ("2024-01-01T05", "PJM", "x"), ("2024-01-01T05", "PJM", "-1"),
            ("2024-01-01T05", "PJM", "0"), ("2024-01-01T05", "PJM", None), ("bad", "PJM", "3")]
    df = spark.createDataFrame(rows, schemas.LIVE_DEMAND_FEED)
    got = live.live_demand(df, now()).orderBy("demand_mw").collect()
    assert [r["demand_mw"] for r in got] == [3.0, 10.5]
    assert (got[0]["timestamp"], got[0]["reading_id"], got[0]["latency_seconds"]) == (None, "live_pjm", None)
    assert got[1]["reading_id"] == "live_pjm_2024010105"
    assert got[1]["latency_seconds"] == (31 * 24 - 5) * 3600


def test_anomaly_thresholds_and_baseline(spark):
    monthly = spark.createDataFrame(
        [("r", datetime(2022, 1, 1), 80.0), ("r", datetime(2023, 1, 1), 120.0), ("zero", datetime(2023, 1, 1), 0.0)],
        "region_id string, month timestamp, avg_demand_mw double")
    values = [110.0, 110.1, 115.0, 115.1, 125.0, 125.1, 90.0, 89.0]
    rows = [("r", START, v) for v in values] + [("zero", START, 5.0), ("none", START, 5.0)]
    df = spark.createDataFrame(rows, "region_id string, timestamp timestamp, demand_mw double")
    out = live.demand_anomalies(df.withColumn("processing_timestamp", now()), live.month_of_year_baseline(monthly))
    got = {r["demand_mw"]: (r["severity"], r["anomaly_type"]) for r in out.collect()}
    assert got == {110.1: ("LOW", "DEMAND_SPIKE"), 115.0: ("LOW", "DEMAND_SPIKE"),
                   115.1: ("MEDIUM", "DEMAND_SPIKE"), 125.0: ("MEDIUM", "DEMAND_SPIKE"),
                   125.1: ("HIGH", "DEMAND_SPIKE"), 89.0: ("LOW", "DEMAND_DROP")}


def test_pricing_alerts_are_never_null(spark):
    rows = [("2024-01-01 00:05:00", "1", "n", "200", "50", "1", "x"), ("2024-01-01T00:10:00", "1", "n", "200.1", "-50.1", "1", "2"),
            ("never", "1", "n", None, None, None, None)]
    got = live.live_pricing(spark.createDataFrame(rows, schemas.LIVE_PRICE_FEED), now()).collect()
    assert [(r["price_spike_alert"], r["congestion_alert"]) for r in got] == [(False, False), (True, True), (False, False)]
    assert got[0]["loss_lmp"] is None and got[2]["timestamp"] is None


def test_stream_equals_batch_over_several_files(spark, tmp_path):
    src = tmp_path / "in"
    for f in range(3):
        put(src, f"{f}.json", [record(f * 4 + i, "PJM", 10 + i) for i in range(4)])
    rows = run.drain(live.live_demand(stream(spark, src), now()), "t")
    batch = live.live_demand(spark.read.schema(schemas.LIVE_DEMAND_FEED).json(str(src)), now())
    assert sorted(map(str, rows.collect())) == sorted(map(str, batch.collect()))


@pytest.mark.parametrize("salts", [1, 3])
def test_duplicates_within_and_across_batches(spark, tmp_path, salts):
    src = tmp_path / "in"
    put(src, "0.json", [record(0, "A", 1), record(0, "A", 2), record(0, "B", 3)])
    put(src, "1.json", [record(0, "A", 9), record(1, "A", 4)])
    keys = live.deduplicate(live.live_demand(stream(spark, src), now()), salts=salts)
    got = run.drain(keys, "t").select("reading_id").collect()
    assert sorted(r[0] for r in got) == ["live_a_2024010100", "live_a_2024010101", "live_b_2024010100"]


def test_windows_close_after_the_watermark(spark, tmp_path):
    src = tmp_path / "in"
    put(src, "0.json", [record(0, "A", 10), record(0, "A", 20)])
    put(src, "1.json", [record(3, "A", 30)])
    put(src, "2.json", [record(5, "A", 1)])
    put(src, "3.json", [record(0, "A", 99), record(5, "A", 3)])
    hourly = live.windowed_average(live.live_demand(stream(spark, src), now()))
    got = {r["window_start"].hour: (r["avg_demand_mw"], r["readings"]) for r in run.drain(hourly, "t").collect()}
    # the late 99 comes after its window closed
    assert got == {0: (15.0, 2), 3: (30.0, 1)}


def test_change_remembers_between_runs(spark, tmp_path):
    src, folder = tmp_path / "in", scratch_dir(spark, "t")
    put(src, "0.json", [record(0, "A", 10), record(1, "A", 16), record(1, "A", 14), record(0, "B", 5)])
    change = lambda: run.drain(stateful.demand_change(live.live_demand(stream(spark, src), now())), "t", folder)
    # hour 1 waits for the watermark
    assert sorted((r["region_id"], r["timestamp"].hour) for r in change().collect()) == [("a", 0), ("b", 0)]
    # a late copy of a known hour, then new hours; the second run restarts from the checkpoint
    put(src, "1.json", [record(0, "A", 1), record(3, "A", 20), record(2, "A", 15), record(4, "A", 0.5)])
    rows = sorted((r["region_id"], r["timestamp"].hour, r["previous_mw"], r["change_mw"], r["acceleration_mw"])
                  for r in change().where("region_id = 'a'").collect())
    assert rows == [("a", 0, None, None, None), ("a", 1, 10.0, 4.0, None), ("a", 2, 14.0, 1.0, -3.0), ("a", 3, 15.0, 5.0, 4.0)]


def test_change_does_not_depend_on_batches(spark, tmp_path):
    import random
    draw = random.Random(5)
    rows = [{"region_id": r, "timestamp": (START + timedelta(minutes=m, microseconds=draw.randrange(10**6))).isoformat(),
             "demand_mw": float(draw.randrange(1000))} for m in range(0, 180, 2) for r in ("a", "b")]
    # out of order by less than the delay
    rows.sort(key=lambda r: datetime.fromisoformat(r["timestamp"]) + timedelta(minutes=draw.randrange(14)))
    found = []
    for files in (1, 3, 7):
        src = tmp_path / str(files)
        for f in range(files):
            put(src, f"{f}.json", rows[len(rows) * f // files : len(rows) * (f + 1) // files])
        raw = spark.readStream.schema("region_id string, timestamp timestamp, demand_mw double")
        got = run.drain(stateful.demand_change(raw.option("maxFilesPerTrigger", 1).json(str(src))), "t").collect()
        found.append(sorted(map(str, got)))
    assert found[0] == found[1] == found[2]
    newest = max(r["timestamp"] for r in rows)
    passed = [r for r in rows if datetime.fromisoformat(r["timestamp"]) <= datetime.fromisoformat(newest) - timedelta(minutes=15)]
    assert len(found[0]) == len(passed)


def anomalies(spark, folder):
    raw = spark.readStream.schema("region_id string, timestamp timestamp").option("maxFilesPerTrigger", 1)
    return raw.json(str(folder))


def test_cooldown_between_alerts(spark, tmp_path):
    at = lambda m: (START + timedelta(minutes=m)).isoformat()
    batches = [[0, 10, 59, 60], [61, 119], [121, 121], [300]]
    src = tmp_path / "in"
    for i, minutes in enumerate(batches):
        put(src, f"{i}.json", [{"region_id": "r", "timestamp": at(m)} for m in minutes])
    fired = run.drain(stateful.alert_cooldown(anomalies(spark, src)), "t")
    minute = F.floor((F.unix_timestamp("alert_time") - F.unix_timestamp(F.lit(START))) / 60)
    stream_minutes = sorted(r[0] for r in fired.select(minute).collect())
    stored = spark.read.schema("region_id string, timestamp timestamp").json(str(src))
    batch_minutes = sorted(r[0] for r in cooldown.alert_cooldown_history(stored).select(minute).collect())
    assert stream_minutes == batch_minutes == [0, 60, 121, 300]


def test_cooldown_matches_a_plain_loop(spark):
    import numpy as np
    micros = np.sort(np.random.default_rng(2).integers(0, 20000 * 60_000_000, 800))
    df = spark.createDataFrame([("r", START + timedelta(microseconds=int(m))) for m in micros],
                               "region_id string, timestamp timestamp")
    want, last = [], None
    for m in micros:
        if last is None or m - last >= 60 * 60_000_000:
            want.append(int(m))
            last = m
    got = sorted((r["alert_time"] - START) // timedelta(microseconds=1)
                 for r in cooldown.alert_cooldown_history(df.union(df)).collect())
    assert got == want


@pytest.mark.parametrize("seed", range(12))
def test_days_compose_to_a_walk_over_all_instants(seed):
    import numpy as np
    import pandas as pd
    rng = np.random.default_rng(seed)
    day, pause = 100, int(rng.integers(1, 101))
    x = np.unique(rng.integers(-700, 3000, int(rng.choice([5, 40, 400, 3000]))))
    if seed % 3 == 0:
        x = x[(x % 500) > 130]  # whole days without any
    want, last = [], None
    for m in x.tolist():
        if last is None or m - last >= pause:
            want.append(m)
            last = m
    days = pd.DataFrame(
        [(d, *cooldown.day_steps(x[x // day == d], d * day, pause)) for d in np.unique(x // day).tolist()],
        columns=["day", "upper", "last"])
    ends = {d: max([w for w in want if w // day == d], default=cooldown.FREE) for d in days.day}
    for cut in range(1, len(days) + 1):
        _, final, upper, value = cooldown.composed(days.head(cut), pause)
        got = cooldown.evaluate(upper, value, np.array([cooldown.FREE + pause]))[0]
        assert got == ends[final]


def test_cooldown_spreads_a_region_over_its_days(spark):
    import numpy as np
    micros = np.random.default_rng(5).integers(-40 * 86_400_000_000, 90 * 86_400_000_000, 9000)
    regions = ["hot", "hot", "hot", "a", "b"]
    rows = [(regions[i % 5], START + timedelta(microseconds=int(m))) for i, m in enumerate(micros)]
    df = spark.createDataFrame([*rows, *rows, ("a", None), (None, START)], "region_id string, timestamp timestamp")
    want = set()
    for region in set(regions):
        last = None
        for at in sorted({t for r, t in rows if r == region}):
            if last is None or at - last >= timedelta(minutes=60):
                want.add((region, at))
                last = at
    found = cooldown.alert_cooldown_history(df)
    assert {tuple(r) for r in found.collect()} == want and found.count() == len(want)
    assert cooldown.alert_cooldown_history(df.limit(0)).count() == 0
    plan = found._jdf.queryExecution().executedPlan().toString()
    last = plan[plan.index("FlatMapGroups"):]
    assert "hashpartitioning(region_id" in last and "day" in last.split("hashpartitioning(region_id")[1][:20]
    with pytest.raises(ValueError):
        cooldown.alert_cooldown_history(df, minutes=25 * 60)


def test_repeated_batch_changes_neither_output(spark, tmp_path):
    schema = schemas.LIVE_DEMAND_FEED
    df = spark.createDataFrame([("a", "b", "1"), ("a" * 100, "b", "1"), (None, "b", None)], schema)
    folder = str(tmp_path / "split")
    for number in (0, 1, 0, 1):
        run.write_split(df, number, folder, 100)
    kept, rejected = run.guarded(spark, folder, df.schema), run.guarded(spark, folder, df.schema, False)
    assert kept.columns == df.columns and kept.count() == 4
    assert [r["row_bytes"] > 100 for r in rejected.collect()] == [True, True]


def test_failed_batch_is_run_again(spark, tmp_path):
    src = tmp_path / "in"
    for i in range(3):
        put(src, f"{i}.json", [record(i, "A", 1), record(i, "B" * 100, 2)])
    calls, waits = [], []

    def fragile(batch, number, folder, limit):
        run.write_split(batch, number, folder, limit)
        calls.append(number)
        if number == 1 and calls.count(1) < 3:
            raise RuntimeError("lost the connection")

    def outputs(name, write):
        folder = str(tmp_path / name)
        records = stream(spark, src)

        def start():
            return run.start_guarded(records, folder, folder + "-cp", 120, write=write)

        again = supervise.supervise(start, supervise.DEMAND, waits.append)
        parts = [run.guarded(spark, folder, records.schema, side).collect() for side in (True, False)]
        return again, [sorted(map(str, part)) for part in parts]

    plain = outputs("plain", run.write_split)
    shaken = outputs("shaken", fragile)
    assert plain[0] == 0 and shaken[0] == 2 and plain[1] == shaken[1] and len(plain[1][0]) == 3
    assert waits == [1.0, 2.0] or waits == [1.0, 1.0]
    assert calls.count(1) == 3 and calls.count(0) == 1
    policy = supervise.FeedPolicy("x", 300, 30, restarts=1)
    assert policy.trigger == "30 seconds" and [policy.wait_s(n) for n in (1, 2, 20)] == [1, 2, 300]

    def always(batch, number, folder, limit):
        raise RuntimeError("gone")

    with pytest.raises(Exception, match="gone"):
        supervise.supervise(
            lambda: run.start_guarded(stream(spark, src), str(tmp_path / "x"), str(tmp_path / "x-cp"), write=always),
            policy, waits.append)


def test_health_is_observed_over_restarts(spark, tmp_path):
    src, out, checkpoint = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "cp")
    monitor = supervise.Monitor()
    spark.streams.addListener(monitor)
    try:
        for i in range(2):
            put(src, f"{i}.json", [record(i, "A", 1), record(i, "A", 2)])
            rows = supervise.watched(live.live_demand(stream(spark, src), now()))
            query = run.start_available(rows, out, checkpoint)
            query.awaitTermination()
            health = monitor.settled(query)
        assert health.rows == 4 and health.batches >= 2 and not health.failures
        # a micro-batch is through well within the target of the live feed
        assert 0 < health.max_batch_s < supervise.L.LATENCY_TARGET_S
    finally:
        spark.streams.removeListener(monitor)


def test_baseline_changes_under_a_running_stream(spark, tmp_path):
    src, folder = tmp_path / "in", str(tmp_path / "out")
    side = sideinput.SideInput(spark, str(tmp_path / "side"))
    state = {"now": START, "fail": False}

    def table(value):
        return spark.createDataFrame([("r", value)], "region_id string, baseline double")

    def combine(batch, baseline):
        if state["fail"]:
            raise RuntimeError("half way")
        return batch.join(baseline, "region_id").select("region_id", "timestamp", "baseline")

    def go():
        query = sideinput.start_with(anomalies(spark, src), side, combine, folder, clock=lambda: state["now"])
        query.awaitTermination()

    def put_one(i):
        put(src, f"{i}.json", [{"region_id": "r", "timestamp": (START + timedelta(hours=i)).isoformat()}])

    def got():
        schema = "region_id string, timestamp timestamp, baseline double"
        rows = sideinput.results(
            spark, folder, schemas.table_schema("region_id string, timestamp timestamp, baseline double")).collect()
        return sorted((int((r["timestamp"] - START).total_seconds() // 3600), r["baseline"]) for r in rows)

    put_one(0)
    with pytest.raises(Exception, match="no version"):
        go()
    assert got() == []
    assert side.publish(table(1.0), START) == 1
    go()
    # one that is valid later does not count yet
    assert side.publish(table(2.0), START + timedelta(days=1)) == 2
    put_one(1)
    go()
    state["now"] += timedelta(days=2)
    put_one(2)
    state["fail"] = True
    with pytest.raises(Exception, match="half way"):
        go()
    # the micro-batch that failed is repeated with the version it had read
    assert side.publish(table(3.0), START + timedelta(days=1, hours=1)) == 3
    state["fail"] = False
    go()
    put_one(3)
    go()
    assert got() == [(0, 1.0), (1, 1.0), (2, 2.0), (3, 3.0)]


def test_scratch_folder_follows_the_session(spark):
    shared = spark.conf.get("spark.checkpoint.dir")
    assert scratch_dir(spark, "x").startswith(shared)
    assert scratch_dir(spark, "x") != scratch_dir(spark, "x")


def test_size_guard_marks_rows(spark):
    df = spark.createDataFrame([("a", "b", "1"), ("a" * 100, "b", "1")], schemas.LIVE_DEMAND_FEED)
    assert [r["accepted"] for r in live.split_oversized(df, 100).orderBy("row_bytes").collect()] == [True, False]
    assert live.target_regions(df, ("b",)).count() == 2


def test_running_stream_writes_and_restarts(spark, tmp_path):
    src, out, checkpoint = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "cp")

    def once():
        query = run.start(live.live_demand(stream(spark, src), now()), out, checkpoint, "1 second")
        query.processAllAvailable()
        query.stop()
        return spark.read.parquet(out).count()

    put(src, "0.json", [record(0, "A", 1), record(1, "A", 2)])
    assert once() == 2
    put(src, "1.json", [record(2, "A", 3)])
    assert once() == 3
