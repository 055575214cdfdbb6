import datetime as dt
import random

from pyspark.sql import Window
from pyspark.sql import functions as F

from millrace.operators import intervals, scd
from millrace.operators.sequence import segmented_lag

from library_help import rows


def T(s):
    return dt.datetime.fromisoformat(s)


def test_scd2_versions(spark):
    ch = spark.createDataFrame([
        ("k", T("2024-01-01"), 1, "A"),
        ("k", T("2024-01-05"), 2, "A"),      # no change
        ("k", T("2024-01-05"), 2, "A"),      # re-ingest of the same change
        ("k", T("2024-02-03"), 4, "B"),      # out of order in the feed
        ("k", T("2024-02-01"), 3, "C"),      # two changes in one batch
        ("j", T("2024-01-01"), 1, None),
        ("j", T("2024-03-01"), 2, "X"),
    ], "equipment_key STRING, change_ts TIMESTAMP, change_seq INT, cls STRING")
    v = scd.scd2(ch, ["equipment_key"], "change_ts", "change_seq", ["cls"])
    got = rows(v, "equipment_key", "cls", "valid_from", "valid_to", "is_current")
    assert len(got) == 5 and set(got) == {
        ("j", None, T("2024-01-01"), T("2024-03-01"), False),
        ("j", "X", T("2024-03-01"), None, True),
        ("k", "A", T("2024-01-01"), T("2024-02-01"), False),
        ("k", "B", T("2024-02-03"), None, True),
        ("k", "C", T("2024-02-01"), T("2024-02-03"), False),
    }
    facts = spark.createDataFrame([("k", T("2024-01-31 23:00")), ("k", T("2024-02-01")), ("k", T("2025-06-01")),
                                   ("k", T("2023-01-01")), ("z", T("2024-01-01"))], "equipment_key STRING, ts TIMESTAMP")
    a = scd.asof_join(facts, v, ["equipment_key"], "ts", ["cls"])
    assert set(rows(a, "equipment_key", "ts", "cls")) == {
        ("k", T("2023-01-01"), None), ("k", T("2024-01-31 23:00"), "A"), ("k", T("2024-02-01"), "C"),
        ("k", T("2025-06-01"), "B"), ("z", T("2024-01-01"), None)}


def _versions(spark, data):
    return spark.createDataFrame(data, "k STRING, valid_from TIMESTAMP, valid_to TIMESTAMP, cls STRING")


def test_asof_join_equals_brute_force(spark):
    rnd = random.Random(11)
    base = dt.datetime(2024, 1, 1)
    versions, facts = [], []
    for key in ["hot", "a", "b"]:
        at = base + dt.timedelta(hours=rnd.randint(0, 500))
        for n in range(25):
            end = at + dt.timedelta(hours=rnd.choice([0, 1, 30, 900, 2500]))    # zero-length and long versions
            versions.append((key, at, None if n == 24 and key != "b" else end, f"{key}{n}"))
            at = end + dt.timedelta(hours=rnd.choice([0, 0, 40]))               # gaps
    versions += [(None, base, None, "no key"), ("c", None, base, "no start")]
    starts = [v[1] for v in versions if v[1]]
    for i in range(600):
        ts = rnd.choice(starts) if i % 5 == 0 else base + dt.timedelta(hours=rnd.randint(-200, 24 * 1200))
        facts.append((i, rnd.choice(["hot", "hot", "hot", "a", "b", "c", "never", None]), None if i % 29 == 0 else ts))
    facts += facts[:20]                                                         # repeated rows stay repeated
    got = scd.asof_join(spark.createDataFrame(facts, "id INT, k STRING, ts TIMESTAMP"), _versions(spark, versions),
                        ["k"], "ts", ["cls"])
    want = []
    for i, k, ts in facts:
        hits = [v for v in versions if k and ts and v[0] == k and v[1] and v[1] <= ts and (v[2] is None or ts < v[2])]
        assert len(hits) <= 1
        want.append((i, k, ts, hits[0][3] if hits else None, hits[0][1] if hits else None))
    assert rows(got) == sorted(want, key=lambda t: tuple((x is None, str(x)) for x in t))


def test_asof_join_of_empty_tables_and_its_plan(spark, capsys):
    facts = spark.createDataFrame([(1, "k", T("2024-05-01"))], "id INT, k STRING, ts TIMESTAMP")
    none = _versions(spark, [])
    assert rows(scd.asof_join(facts, none, ["k"], "ts", ["cls"])) == [(1, "k", T("2024-05-01"), None, None)]
    assert rows(scd.asof_join(facts.limit(0), none, ["k"], "ts", ["cls"])) == []
    scd.asof_join(facts, _versions(spark, [("k", T("2024-01-01"), None, "A")]), ["k"], "ts", ["cls"]).explain()
    plan = capsys.readouterr().out
    assert "Generate" not in plan and "NestedLoop" not in plan


def test_latest_by_key_honours_deletes(spark):
    ch = spark.createDataFrame([("a", 1, "UPSERT", "x"), ("a", 2, "UPSERT", "y"), ("b", 1, "UPSERT", "x"),
                                ("b", 2, "DELETE", "x")], "alarm_id STRING, change_seq INT, op STRING, v STRING")
    assert rows(scd.latest_by_key(ch, ["alarm_id"], "change_seq"), "alarm_id", "v") == [("a", "y")]


def test_segmented_lag_equals_plain_lag(spark):
    rnd = random.Random(7)
    data = []
    for i in range(400):
        key = rnd.choice(["a", "a", "a", "b", "c"])   # one hot key
        ts = dt.datetime(2024, 1, 1) + dt.timedelta(hours=rnd.randint(0, 24 * 200))
        data.append((key, ts, f"id{i:04d}", rnd.randint(0, 5)))
    df = spark.createDataFrame(data, "k STRING, ts TIMESTAMP, id STRING, v INT")
    seg = segmented_lag(df, ["k"], ["ts", "id"], ["v", "id"], F.trunc("ts", "MM"))
    w = Window.partitionBy("k").orderBy("ts", "id")
    plain = df.withColumn("prev_v", F.lag("v").over(w)).withColumn("prev_id", F.lag("id").over(w))
    assert rows(seg, "id", "prev_v", "prev_id") == rows(plain, "id", "prev_v", "prev_id")


def test_overlap_pairs_matches_brute_force(spark):
    rnd = random.Random(3)
    data = []
    for i in range(120):
        s = dt.datetime(2024, 1, 1) + dt.timedelta(minutes=rnd.randint(0, 3000))
        data.append((rnd.randint(1, 2), f"r{i:03d}", s, s + dt.timedelta(minutes=rnd.randint(0, 400))))
    data.append((1, "touch_a", T("2024-02-01 10:00"), T("2024-02-01 11:00")))
    data.append((1, "touch_b", T("2024-02-01 11:00"), T("2024-02-01 12:00")))   # touching: no overlap
    df = spark.createDataFrame(data, "line_id INT, run_id STRING, start_ts TIMESTAMP, end_ts TIMESTAMP")
    got = rows(intervals.overlap_pairs(df, "line_id", "run_id", "start_ts", "end_ts"), "run_id_a", "run_id_b")
    brute = sorted((a[1], b[1]) for a in data for b in data
                   if a[0] == b[0] and a[1] < b[1] and a[2] < b[3] and b[2] < a[3])
    assert got == brute


def test_merge_and_cover_no_double_subtraction(spark):
    dts = spark.createDataFrame([
        (1, T("2024-01-01 10:00"), T("2024-01-01 11:00")),
        (1, T("2024-01-01 10:30"), T("2024-01-01 11:30")),   # overlaps the first
        (1, T("2024-01-01 10:40"), T("2024-01-01 10:50")),   # nested
        (1, T("2024-01-01 23:30"), T("2024-01-02 00:30")),   # crosses midnight
        (1, T("2024-01-01 12:00"), T("2024-01-01 12:00")),   # empty
    ], "line_id INT, start_ts TIMESTAMP, end_ts TIMESTAMP")
    isl = intervals.merge_intervals(dts, "line_id")
    gaps = spark.createDataFrame([(1, "g1", T("2024-01-01 09:00"), T("2024-01-01 12:00")),
                                  (1, "g2", T("2024-01-01 23:00"), T("2024-01-02 01:00")),
                                  (1, "g3", T("2024-01-01 11:30"), T("2024-01-01 11:30"))],
                                 "line_id INT, gid STRING, gs TIMESTAMP, ge TIMESTAMP")
    cov = {r["gid"]: r["covered_minutes"] for r in
           intervals.covered_minutes(gaps, isl, "line_id", ["gid"], "gs", "ge").collect()}
    assert cov == {"g1": 90, "g2": 60, "g3": 0}


def test_point_in_intervals_match_count(spark):
    iv = spark.createDataFrame([(1, "a", T("2024-01-01 08:00"), T("2024-01-01 10:00")),
                                (1, "b", T("2024-01-01 09:00"), T("2024-01-01 12:00")),
                                (1, "open", T("2024-01-01 07:00"), None)],
                               "line_id INT, run_id STRING, start_ts TIMESTAMP, end_ts TIMESTAMP")
    pts = spark.createDataFrame([("p1", 1, T("2024-01-01 08:30")), ("p2", 1, T("2024-01-01 09:30")),
                                 ("p3", 1, T("2024-01-01 10:00")), ("p4", 1, T("2024-01-01 13:00"))],
                                "check_id STRING, line_id INT, check_ts TIMESTAMP")
    got = rows(intervals.point_in_intervals(pts, iv, "line_id", "check_ts", "run_id", "start_ts", "end_ts"),
               "check_id", "match_count", "matched_run_id")
    assert set(got) == {("p1", 1, "a"), ("p2", 2, None), ("p3", 1, "b"), ("p4", 0, None)}


def test_equal_points_are_counted_each(spark):
    iv = spark.createDataFrame([(1, "a", T("2024-01-01 08:00"), T("2024-01-02 10:00"), "S"), (1, "empty", T("2024-01-01 08:10"), T("2024-01-01 08:10"), "S")],
                               "line_id INT, run_id STRING, start_ts TIMESTAMP, end_ts TIMESTAMP, sku STRING")
    pts = spark.createDataFrame([("p", 1, T("2024-01-02 09:59"))] * 2 + [("q", 1, None), ("r", None, T("2024-01-01 09:00")), ("s", 2, T("2024-01-01 09:00"))],
                                "check_id STRING, line_id INT, check_ts TIMESTAMP")
    got = intervals.point_in_intervals(pts, iv, "line_id", "check_ts", "run_id", "start_ts", "end_ts", iv_carry=["sku"])
    assert rows(got, "check_id", "match_count", "matched_run_id", "sku") == [
        ("p", 1, "a", "S"), ("p", 1, "a", "S"), ("q", 0, None, None), ("r", 0, None, None), ("s", 0, None, None)]


def test_repeated_interval_ids_return_each_point_once(spark):
    iv = spark.createDataFrame([(1, "a", T("2024-01-01 08:00"), T("2024-01-01 09:00"), "S"), (1, "a", T("2024-01-01 10:00"), T("2024-01-01 11:00"), "U"),
                                (1, "b", T("2024-01-01 12:00"), T("2024-01-01 13:00"), "V"), (1, "b", T("2024-01-01 12:00"), T("2024-01-01 13:00"), "V")],
                               "line_id INT, run_id STRING, start_ts TIMESTAMP, end_ts TIMESTAMP, sku STRING")
    pts = spark.createDataFrame([("p", 1, T("2024-01-01 08:30")), ("q", 1, T("2024-01-01 10:30")), ("r", 1, T("2024-01-01 12:30"))],
                                "check_id STRING, line_id INT, check_ts TIMESTAMP")
    got = intervals.point_in_intervals(pts, iv, "line_id", "check_ts", "run_id", "start_ts", "end_ts", iv_carry=["sku"])
    assert rows(got, "check_id", "match_count", "matched_run_id", "sku") == [
        ("p", 1, "a", "S"), ("q", 1, "a", "U"), ("r", 2, None, None)]


def test_open_intervals_reach_over_buckets_and_months(spark):
    rnd = random.Random(5)
    at = lambda: dt.datetime(2023, 11, 1) + dt.timedelta(minutes=rnd.randint(0, 60 * 24 * 200))
    iv = [(rnd.choice([1, 2]), f"r{i}", s, s + dt.timedelta(minutes=rnd.choice([5, 90, 3000, 100_000]))) for i in range(12) for s in [at()]]
    iv += [(3, "long", dt.datetime(2020, 1, 31, 23, 59), dt.datetime(2024, 3, 1)), (None, "lost", dt.datetime(2023, 1, 1), dt.datetime(2025, 1, 1)), (3, "back", at(), dt.datetime(2000, 1, 1))]
    pts = [(f"p{i}", rnd.choice([1, 2, 3]), at()) for i in range(300)] + [("n", None, at()), ("t", 1, None), ("e", 3, dt.datetime(2024, 3, 1)), ("s", 3, dt.datetime(2020, 1, 31, 23, 59))]
    got = intervals.point_in_intervals(spark.createDataFrame(pts, "check_id STRING, line_id INT, check_ts TIMESTAMP"),
                                       spark.createDataFrame(iv, "line_id INT, run_id STRING, start_ts TIMESTAMP, end_ts TIMESTAMP"),
                                       "line_id", "check_ts", "run_id", "start_ts", "end_ts")
    def truth(key, t):
        held = [i[1] for i in iv if None not in (key, t) and i[0] == key and i[2] <= t < i[3]]
        return len(held), held[0] if len(held) == 1 else None
    assert {(r.check_id, r.match_count, r.matched_run_id) for r in got.collect()} == {(p[0], *truth(p[1], p[2])) for p in pts}


def test_points_are_read_once_and_never_filtered(spark, tmp_path):
    T2 = "line_id INT, run_id STRING, start_ts TIMESTAMP, end_ts TIMESTAMP"
    spark.createDataFrame([("p", 1, T("2024-01-01 08:30"))], "check_id STRING, line_id INT, check_ts TIMESTAMP").write.parquet(str(tmp_path / "points"))
    points = spark.read.parquet(str(tmp_path / "points"))
    iv = spark.createDataFrame([(1, "a", T("2024-01-01 08:00"), T("2024-01-01 10:00"))], T2)
    out = intervals.point_in_intervals(points, iv, "line_id", "check_ts", "run_id", "start_ts", "end_ts")
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan parquet") == 1 and "isnotnull(check_ts" not in plan


def test_segmented_lead_equals_plain_lead(spark):
    from millrace.operators.sequence import segmented_lead
    rnd = random.Random(11)
    data = [(rnd.choice(["a", "a", "b"]), dt.datetime(2024, 1, 1) + dt.timedelta(hours=rnd.randint(0, 24 * 150)),
             f"id{i:04d}") for i in range(300)]
    df = spark.createDataFrame(data, "k STRING, ts TIMESTAMP, id STRING")
    seg = segmented_lead(df, ["k"], ["ts", "id"], ["id"], F.trunc("ts", "MM"))
    plain = df.withColumn("next_id", F.lead("id").over(Window.partitionBy("k").orderBy("ts", "id")))
    assert rows(seg, "id", "next_id") == rows(plain, "id", "next_id")
