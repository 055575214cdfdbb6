import os
import time

from pyspark.sql import functions as F

from millrace.plans import silver
from millrace.streaming import ingest
from millrace.streaming.silver_stream import ReadingsBatchWriter, dedupe_stream, silver_stream

from library_help import rows

COLS = ["timestamp", "equipment_id", "sensor_tag", "value", "quality", "status", "line_id"]


def _land_drops(spark, base, drops):
    for i, d in enumerate(drops):
        ingest.land_csv(spark.createDataFrame(d, ", ".join(f"{c} STRING" for c in COLS)).coalesce(1),
                        os.path.join(base, f"drop_{i}"))
        time.sleep(1.1)   # distinct modification times → drops processed in order


DROPS = [
    [("2024-01-02T10:00:00Z", "EQ-101", "t", "1.0", "192", "GOOD", "1"),
     ("2024-01-02T10:00:00Z", "EQ-101", "t", "1.0", "192", "GOOD", "1"),      # duplicate within a batch
     ("2024-01-02T11:00:00Z", "EQ-101", "t", "2.0", "192", "GOOD", "1")],
    [("2024-01-02T11:00:00Z", "EQ-101", "t", "2.0", "192", "GOOD", "1"),      # duplicate across batches
     ("2024-01-03T12:00:00Z", "EQ-101", "t", "3.0", "192", "GOOD", "1")],
    [("2024-01-02T09:00:00Z", "EQ-101", "t", "0.5", "192", "GOOD", "1"),      # behind the eviction watermark only
     ("not-a-time", "EQ-101", "t", "0.5", "192", "GOOD", "1")],
    # Spark filters late rows against the *previous* batch's watermark
    # (2024-01-03 06:00 from here on): this one is dropped by the stream
    [("2024-01-02T08:00:00Z", "EQ-101", "t", "0.25", "192", "GOOD", "1")],
]


def test_watermark_dedupe_drops_late_rows(spark, refs):
    base = ingest.fresh_dir(spark, "test_dedupe")
    _land_drops(spark, os.path.join(base, "landing"), DROPS)
    stream = ingest.bronze_stream(spark, os.path.join(base, "landing"), COLS, "csv", max_files_per_trigger=1)
    q = ingest.run_once(ingest.to_parquet(dedupe_stream(stream, refs), os.path.join(base, "out"),
                                          os.path.join(base, "_chk")))
    got = rows(spark.read.parquet(os.path.join(base, "out")), "reading_ts", "value")
    assert [v for _, v in got] == [0.5, 1.0, 2.0, 3.0]
    dropped = sum(op.get("numRowsDroppedByWatermark", 0)
                  for p in q.recentProgress for op in p.get("stateOperators", []))
    assert dropped == 1


def test_foreach_batch_keeps_late_rows_and_is_idempotent(spark, refs):
    base = ingest.fresh_dir(spark, "test_fb")
    _land_drops(spark, os.path.join(base, "landing"), DROPS)
    writer = ReadingsBatchWriter(refs, os.path.join(base, "silver"), os.path.join(base, "quarantine"),
                                 late_path=os.path.join(base, "late"))
    stream = ingest.bronze_stream(spark, os.path.join(base, "landing"), COLS, "csv", max_files_per_trigger=1)
    ingest.run_once(silver_stream(stream, writer, os.path.join(base, "_chk")))
    late = (spark.read.parquet(os.path.join(base, "late", "dates"))
            .groupBy("reading_date").agg(F.sum("late_rows").alias("n")))
    # one row behind the 6 h high-water mark in each of the last two batches,
    # both on plant-local 2024-01-02
    assert [(str(r["reading_date"]), r["n"]) for r in late.collect()] == [("2024-01-02", 2)]
    s = spark.read.parquet(os.path.join(base, "silver"))
    assert sorted(r["value"] for r in s.collect()) == [0.25, 0.5, 1.0, 2.0, 3.0]   # late rows merged, not lost
    q = spark.read.parquet(os.path.join(base, "quarantine"))
    assert [r["quarantine_reason"] for r in q.collect()] == ["UNPARSEABLE_TIMESTAMP"]
    # replaying a batch changes nothing
    last = spark.read.parquet(os.path.join(base, "late", "hwm")).agg(F.max("_batch_id")).first()[0]
    replay = silver.with_ingest_metadata(spark.createDataFrame(DROPS[3], ", ".join(f"{c} STRING" for c in COLS)), "replay")
    writer(replay, last)
    assert spark.read.parquet(os.path.join(base, "silver")).count() == 5


def test_best_row_wins_across_batches(spark, refs):
    base = ingest.fresh_dir(spark, "test_best")
    w = ReadingsBatchWriter(refs, os.path.join(base, "silver"), os.path.join(base, "quarantine"))
    schema = ", ".join(f"{c} STRING" for c in COLS)
    for n, quality in enumerate(["0", "192", "64"]):
        row = ("2024-01-02T10:00:00Z", "EQ-101", "t", f"{n}.0", quality, "GOOD", "1")
        w(silver.with_ingest_metadata(spark.createDataFrame([row], schema), "t"), n)
    assert rows(spark.read.parquet(os.path.join(base, "silver")), "opc_quality_code", "value") == [(192, 1.0)]


def test_late_rows_go_to_quarantine_in_three_batches(spark, refs):
    from millrace.plans.catalog import _readings_drops, _stream_drops
    from millrace.plans.plant import Plant
    from millrace.streaming.silver_stream import DedupeBatchWriter
    from library_help import SF_SMALL
    p = Plant(spark, SF_SMALL)
    base = ingest.fresh_dir(spark, "test_late")
    w = DedupeBatchWriter(p.refs, os.path.join(base, "silver"), os.path.join(base, "quarantine"), os.path.join(base, "marks"), p.zone)
    done = _stream_drops(p, base, w)
    assert sum(1 for q in done for b in q.recentProgress if b["numInputRows"] > 0) == 3
    quarantine = spark.read.parquet(os.path.join(base, "quarantine"))
    assert quarantine.where("quarantine_reason = 'LATE_ARRIVAL'").count() > 0
    accepted = spark.read.parquet(os.path.join(base, "silver"))
    assert accepted.count() == accepted.select(*silver.READING_KEY).distinct().count()
    assert accepted.count() + quarantine.count() <= sum(d.count() for d in _readings_drops(p))


def test_rescued_data_keeps_bad_lines(spark):
    base = ingest.fresh_dir(spark, "test_rescue")
    lines = spark.createDataFrame([("2024-01-02T10:00:00Z,EQ-101,t,1.0,192,GOOD,1",),
                                   ("2024-01-02T10:00:00Z,EQ-101,t,1.0,192,GOOD,1,EXTRA",),
                                   ("2024-01-02T10:00:00Z,EQ-101,t,1.0,192,GOOD",)], "value STRING")
    ingest.land_text(lines.coalesce(1), os.path.join(base, "landing"))
    b = ingest.bronze_batch(spark, os.path.join(base, "landing"), COLS, "csv", {"header": "false"})
    got = sorted((r[ingest.RESCUE_COL] or "") for r in b.collect())
    assert got[0] == "" and got[1].endswith("GOOD") and got[2].endswith(",EXTRA")


def test_csv_drops_land_compressed_and_read_back_whole(spark):
    base = ingest.fresh_dir(spark, "test_gzip")
    made = spark.range(2000).select(*[F.concat(F.lit(f"{c} "), F.col("id")).alias(c) for c in COLS])
    ingest.land_csv(made.coalesce(1), os.path.join(base, "landing", "drop_0"))
    files = spark.read.format("binaryFile").load(os.path.join(base, "landing", "drop_0")).select("path", "length").collect()
    assert [f.path for f in files if not f.path.endswith(".csv.gz")] == []
    assert sum(f.length for f in files) * 4 < made.select(F.sum(F.length(F.concat_ws(",", *COLS)))).first()[0]
    stream = ingest.bronze_stream(spark, os.path.join(base, "landing"), COLS, "csv")
    ingest.run_once(ingest.to_parquet(stream, os.path.join(base, "bronze"), os.path.join(base, "_chk")))
    assert rows(spark.read.parquet(os.path.join(base, "bronze")), *COLS) == rows(made, *COLS)


def test_json_arrays_roundtrip(spark):
    base = ingest.fresh_dir(spark, "test_json")
    df = spark.createDataFrame([(f"EQ-{i}", f"n{i}", None if i % 2 else '{"a": 1}') for i in range(25)],
                               "equipment_id STRING, name STRING, specs STRING")
    ingest.land_json_arrays(df, os.path.join(base, "landing"), rows_per_file=10)
    files = [f for _, _, fs in os.walk(os.path.join(base, "landing")) for f in fs if f.endswith(".txt")]
    assert len(files) == 3
    back = ingest.bronze_batch(spark, os.path.join(base, "landing"), ["equipment_id", "name", "specs"],
                               "json", {"multiLine": "true"})
    got = back.select("equipment_id", "specs", ingest.RESCUE_COL).collect()
    assert len(got) == 25 and all(r[ingest.RESCUE_COL] is None for r in got)
    assert sum(r["specs"] is not None for r in got) == 13


def test_scd2_stream_writer_reopens_and_is_idempotent(spark):
    import datetime as dt
    from millrace.operators.scd import scd2
    from millrace.streaming.scd_stream import Scd2BatchWriter, read_dimension
    base = ingest.fresh_dir(spark, "test_scd_stream")
    sch = "equipment_key STRING, change_ts TIMESTAMP, change_seq INT, cls STRING"
    d = dt.datetime
    b0 = spark.createDataFrame([("k", d(2024, 1, 1), 1, "A"), ("k", d(2024, 3, 1), 3, "C")], sch)
    b1 = spark.createDataFrame([("k", d(2024, 2, 1), 2, "B"), ("j", d(2024, 1, 1), 1, "A")], sch)  # late change
    w = Scd2BatchWriter(os.path.join(base, "h"), os.path.join(base, "d"), ["equipment_key"],
                        "change_ts", "change_seq", ["cls"], buckets=4)
    w(b0, 0)
    w(b1, 1)
    w(b1, 1)   # replay
    got = rows(read_dimension(spark, os.path.join(base, "d")), "equipment_key", "cls", "valid_from", "valid_to")
    want = rows(scd2(b0.unionByName(b1), ["equipment_key"], "change_ts", "change_seq", ["cls"]),
                "equipment_key", "cls", "valid_from", "valid_to")
    assert got == want and len(got) == 4


def test_table_writer_fails_before_any_write(spark, refs):
    import pytest
    from millrace.operators.expect import ExpectationFailed
    from millrace.streaming.silver_stream import TableBatchWriter
    base = ingest.fresh_dir(spark, "test_fail")
    cols = ["run_id", "line_id", "status", "start_time", "end_time", "volume_unit", "actual_volume",
            "target_volume", "total_units", "good_units", "scrap_units", "efficiency_pct"]
    bad = silver.with_ingest_metadata(spark.createDataFrame(
        [("1", "Line 9", "COMPLETED", "2024-01-02T08:00:00", "", "L", "1", "1", "2", "1", "1", "")],
        ", ".join(f"{c} STRING" for c in cols)), "t")
    w = TableBatchWriter(lambda b: silver.silver_runs(b, refs), silver.RUNS_RULES, "production_runs",
                         os.path.join(base, "silver"), os.path.join(base, "metrics"))
    with pytest.raises(ExpectationFailed):
        w(bad, 0)
    assert not os.path.exists(os.path.join(base, "silver")) and not os.path.exists(os.path.join(base, "metrics"))


def test_counts_come_from_the_write_and_a_replay_counts_once(spark):
    from millrace.operators.expect import Expectation
    from millrace.streaming.silver_stream import TableBatchWriter
    base = ingest.fresh_dir(spark, "test_counts")
    rules = [Expectation("a_known", "a IS NOT NULL", "drop"), Expectation("a_small", "a < 10")]
    silver_path, metrics = os.path.join(base, "silver"), os.path.join(base, "metrics")
    w = TableBatchWriter(lambda b: b, rules, "t", silver_path, metrics)
    first = spark.createDataFrame([(1,), (None,), (20,)], "a INT")
    w(first, 0)
    w(first, 0)                                                       # replayed
    w(first.where("a > 5"), 1)
    w(first.limit(0), 2)                                              # an empty batch
    assert rows(spark.read.parquet(metrics), "batch_id", "rule", "violations", "total_rows") == [
        (0, "a_known", 1, 3), (0, "a_small", 2, 3), (1, "a_known", 0, 1), (1, "a_small", 1, 1),
        (2, "a_known", 0, 0), (2, "a_small", 0, 0)]
    assert rows(spark.read.parquet(silver_path), "a") == [(1,), (20,), (20,)]


def test_stream_rerun_on_same_checkpoint_adds_nothing(spark, refs):
    base = ingest.fresh_dir(spark, "test_rerun")
    _land_drops(spark, os.path.join(base, "landing"), DROPS[:2])
    for _ in range(2):
        stream = ingest.bronze_stream(spark, os.path.join(base, "landing"), COLS, "csv")
        ingest.run_once(ingest.to_parquet(stream, os.path.join(base, "bronze"), os.path.join(base, "_chk")))
    assert spark.read.parquet(os.path.join(base, "bronze")).count() == 5


def test_backfill_and_refresh_by_period(spark):
    import datetime as dt
    from millrace.streaming import refresh
    base = ingest.fresh_dir(spark, "test_backfill")
    days = spark.createDataFrame([(dt.date(2024, m, d), m * 100 + d) for m in (1, 2, 3) for d in (1, 15)],
                                 "production_date DATE, v INT")
    build = lambda lo, hi: days.filter((F.col("production_date") >= lo) & (F.col("production_date") < hi))
    refresh.backfill(build, os.path.join(base, "m"), "production_date",
                     [("2024-01-01", "2024-02-01"), ("2024-02-01", "2024-04-01")])
    got = refresh.read_mart(spark, os.path.join(base, "m"))
    assert sorted(r["v"] for r in got.collect()) == [101, 115, 201, 215, 301, 315]
    # a late correction for February rewrites February only
    fix = days.filter(F.month("production_date") == 2).withColumn("v", F.col("v") + 1000)
    refresh.refresh_dates(fix, fix.select("production_date"), os.path.join(base, "m"), "production_date")
    got = refresh.read_mart(spark, os.path.join(base, "m"))
    assert sorted(r["v"] for r in got.collect()) == [101, 115, 301, 315, 1201, 1215]
