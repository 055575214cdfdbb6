"""Streams whose answers depend on state: alarms with a bound, delta-maintained marts, panes."""
import datetime as dt
import os
import re

from pyspark.sql import functions as F

from millrace.streaming import alarm_stream, deltas, ingest, vibration

from library_help import rows

T0 = dt.datetime(2024, 3, 1, 8)


def minutes(n):
    return T0 + dt.timedelta(minutes=n)


def test_alarm_comes_out_once_its_bound_has_passed(spark):
    base = ingest.fresh_dir(spark, "alarm_bound")
    alarm_kind, ack_kind = "alarm_id string, alarm_ts timestamp", "alarm_id string, op string, change_ts timestamp"
    drops = [
        ([("on time", T0), ("late ack", T0), ("never", T0), ("deleted only", T0), ("twice", T0), ("edge", T0)],
         [("on time", "UPSERT", minutes(5)), ("deleted only", "DELETE", minutes(5)), ("twice", "UPSERT", minutes(1)), ("twice", "UPSERT", minutes(2)),
          ("edge", "UPSERT", minutes(30))]),
        ([("after", minutes(40))], [("late ack", "UPSERT", minutes(31)), ("after", "UPSERT", minutes(39))]),
        ([("beat", minutes(10_000))], [("beat", "UPSERT", minutes(10_000))]),
    ]
    seen = []
    for k, sides in enumerate(drops):
        streams = []
        for name, side, kind in zip(("alarms", "acks"), sides, (alarm_kind, ack_kind)):
            folder = os.path.join(base, name)
            df = spark.createDataFrame(side, kind)
            df.write.parquet(os.path.join(folder, f"drop_{k}"))
            streams.append(spark.readStream.schema(df.schema).option("recursiveFileLookup", "true").parquet(folder))
        out = alarm_stream.unacknowledged_in_time(*streams)
        ingest.run_once(ingest.to_parquet(out, os.path.join(base, "out"), os.path.join(base, "chk")))
        seen.append(sorted(r["alarm_id"] for r in spark.read.schema(alarm_kind).parquet(os.path.join(base, "out")).collect()))
    assert seen == [[], [], ["after", "deleted only", "late ack", "never"]]   # an ack before its alarm is none


RUN = "run_id string, line_id int, run_status string, start_ts timestamp, end_ts timestamp, start_ts_local timestamp, total_units long, good_units long, _sign int"


def run(run_id, day, units, good, sign=1, status="COMPLETED"):
    start = dt.datetime(2024, 1, 1, 9) + dt.timedelta(days=day)
    return (run_id, 1, status, start, start + dt.timedelta(minutes=100), start, units, good, sign)


def _log(spark, name):
    base = ingest.fresh_dir(spark, name)
    capacity = spark.createDataFrame([(1, 600)], "line_id int, nameplate_bpm int")
    return deltas.OeeLog(os.path.join(base, "log"), os.path.join(base, "mart"), capacity)


def test_corrections_replays_and_withdrawn_runs(spark):
    log = _log(spark, "deltas")
    log.add(spark.createDataFrame([(1, dt.date(2024, 1, 1), 100)], "line_id int, production_date date, unplanned_downtime_min long"), "downtime")
    batches = [[run("a", 0, 6000, 3000), run("b", 40, 60000, 60000), run("x", 1, 9, 9, status="ABORTED")],
               [run("c", 0, 54000, 51000)],
               [run("a", 0, 6000, 3000, -1), run("a", 0, 30000, 30000), run("b", 40, 60000, 60000, -1)]]
    for k, batch in enumerate(batches):
        for _ in range(2):   # a replay changes nothing
            log(spark.createDataFrame(batch, RUN), k)
    mart = spark.read.parquet(log.mart_path)
    # 200 minutes run, 100 down; 84,000 of 120,000 units, 81,000 good; February's only run was taken back
    got = rows(mart.filter("_period = DATE '2024-01-01'"), "production_date", "availability", "performance", "quality")
    assert got == [(dt.date(2024, 1, 1), 0.6667, 0.7, 0.9643)]
    assert log.touched(spark, "runs-1") == [dt.date(2024, 1, 1)]


def test_refresh_reads_only_the_recorded_periods(spark):
    log = _log(spark, "deltas_plan")
    for k, day in enumerate((0, 40, 80)):
        log(spark.createDataFrame([run(str(k), day, 6000, 3000)], RUN), k)
    spark.conf.set("spark.sql.maxMetadataStringLength", "2000")
    try:
        df = log.sums(spark, log.touched(spark, "runs-1"))
        plan = df._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.maxMetadataStringLength")
    assert re.search(r"PartitionFilters: \[[^\]]*_period#\d+ = 2024-02-01", plan), plan
    assert [r["production_date"] for r in df.collect()] == [dt.date(2024, 2, 10)]


def test_windows_from_panes_equal_windows_from_messages(spark):
    msgs = [("s", T0 + dt.timedelta(milliseconds=777 * i), float(i * i % 97)) for i in range(300)] + [("t", T0, 4.0)]
    df = spark.createDataFrame(msgs, "sensor_id string, event_ts timestamp, m2 double")
    direct = (df.groupBy("sensor_id", F.window("event_ts", vibration.WINDOW, vibration.SLIDE).alias("w"))
              .agg(F.count("*").alias("n"), F.max("m2").alias("max_m2")).select("sensor_id", F.col("w.start").alias("window_start"), "n", "max_m2"))
    got = vibration.window_stats(df)
    assert rows(got, "sensor_id", "window_start", "n", "max_m2") == rows(direct)
    plan = vibration.pane_sums(df)._jdf.queryExecution().executedPlan().toString()
    assert "Expand" not in plan   # a message is not copied into several windows


def test_streamed_windows_keep_panes_in_blocks(spark, tmp_path):
    """Each pane costs the state its own row and one or two blocks, not six windows; the windows are those of the table."""
    fields = "sensor_id string, timestamp string, x_accel double, y_accel double, z_accel double, temperature double"
    # dense and sparse sensors, windows over block and minute ends, a null sensor, null and infinite values
    msgs = [("a", 7 * i, float(i % 13)) for i in range(120)] + [("b", 613 * i, 2.5) for i in range(40)] + \
           [(None, 119, 1.0), (None, 120, None), ("c", 0, None), ("c", 49, float("inf")), ("c", 110, 3.0), ("c", 170, 3.0)]
    stamp = lambda s: (T0 + dt.timedelta(seconds=s)).strftime("%Y-%m-%dT%H:%M:%S.%fZ")
    landing, out, check = (str(tmp_path / x) for x in ("landing", "out", "check"))
    drops = [[(s, stamp(t), x, 1.0, 0.0, 20.0) for s, t, x in msgs], [(vibration.HEARTBEAT, stamp(100_000), 0.0, 0.0, 0.0, 0.0)]]
    written = 0
    for k, drop in enumerate(drops):
        ingest.land_text(spark.createDataFrame(drop, fields).select(F.to_json(F.struct("*")).alias("value")), f"{landing}/drop_{k}")
        stream = spark.readStream.schema("value STRING").option("recursiveFileLookup", "true").text(landing)
        query = ingest.run_once(ingest.to_parquet(vibration.window_stats(vibration.parse_messages(stream), watermark="1 minute"), out, check))
        written += sum(op["numRowsUpdated"] for p in query.recentProgress for op in p["stateOperators"])
    parsed = vibration.parse_messages(spark.read.text(f"{landing}/drop_0"))
    want = vibration.window_stats(parsed)
    got = spark.read.parquet(out)
    assert list(map(str, rows(got))) == list(map(str, rows(want))) and got.dtypes == want.dtypes
    assert written <= 3 * vibration.pane_sums(parsed).count() + 1


def test_events_are_dealt_to_files_by_their_number(spark, monkeypatch):
    monkeypatch.setattr(vibration, "EVENTS_A_FILE", 10)
    events = spark.range(95).selectExpr("cast(null as long) as event_id", "timestamp_millis(id) as ts", "id as user_id").coalesce(1)
    sizes = [len(p) for p in vibration.spread_events(events).rdd.glom().collect()]
    assert len(sizes) == 10 and sum(sizes) == 95 and max(sizes) < 40
    assert vibration.spread_events(events.limit(0)).count() == 0
