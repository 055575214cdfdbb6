import datetime as dt

from pyspark.sql import functions as F

from millrace.plans import gold

from library_help import rows

RUN_COLS = "run_id STRING, line_id INT, product_sku STRING, start_ts TIMESTAMP, end_ts TIMESTAMP, start_ts_local TIMESTAMP, run_status STRING, total_units BIGINT, good_units BIGINT, scrap_units BIGINT"
WO_COLS = "work_order_id STRING, equipment_key STRING, planning_category STRING, created_ts TIMESTAMP, created_ts_local TIMESTAMP, downtime_minutes INT, work_order_status STRING, priority STRING, technician STRING, completed_ts_local TIMESTAMP"


def T(s):
    return dt.datetime.fromisoformat(s)


def _runs(spark, data):
    return spark.createDataFrame(data, RUN_COLS)


def _wos(spark, data):
    return spark.createDataFrame(data, WO_COLS)


def test_oee_cases(spark, refs):
    runs = _runs(spark, [
        # day with downtime
        ("r1", 1, "A", T("2024-01-02 14:00"), T("2024-01-02 15:40"), T("2024-01-02 08:00"), "COMPLETED", 60000, 57000, 3000),
        # day without downtime
        ("r2", 2, "A", T("2024-01-03 14:00"), T("2024-01-03 15:00"), T("2024-01-03 08:00"), "COMPLETED", 48000, 48000, 0),
        # zero minutes and no downtime → NULL ratios, no error
        ("r3", 3, "A", T("2024-01-04 14:00"), T("2024-01-04 14:00"), T("2024-01-04 08:00"), "COMPLETED", 0, 0, 0),
        # run over midnight counts wholly on its start day
        ("r4", 1, "B", T("2024-01-06 05:00"), T("2024-01-06 07:00"), T("2024-01-05 23:00"), "COMPLETED", 72000, 72000, 0),
        # line without a nameplate rate disappears
        ("r5", 4, "A", T("2024-01-02 14:00"), T("2024-01-02 15:00"), T("2024-01-02 08:00"), "COMPLETED", 10, 10, 0),
        ("r6", 1, "A", T("2024-01-02 16:00"), None, T("2024-01-02 10:00"), "RUNNING", 5, 5, 0),
    ])
    wos = _wos(spark, [
        ("w1", "EQP-101", "UNPLANNED", T("2024-01-02 15:00"), T("2024-01-02 09:00"), 20, "COMPLETED", "High", "T-1", None),
        ("w2", "EQP-101", "PLANNED", T("2024-01-02 15:00"), T("2024-01-02 09:00"), 99, "COMPLETED", "High", "T-1", None),
        # downtime on a day without a run: absent
        ("w3", "EQP-201", "UNPLANNED", T("2024-01-09 15:00"), T("2024-01-09 09:00"), 30, "OPEN", "Low", "T-2", None),
    ])
    out = {(r["line_id"], r["production_date"]): r for r in
           gold.oee_daily(runs, wos, refs.equipment_xref, refs.line_capacity).collect()}
    assert set(out) == {(1, dt.date(2024, 1, 2)), (2, dt.date(2024, 1, 3)), (3, dt.date(2024, 1, 4)),
                        (1, dt.date(2024, 1, 5))}
    d1 = out[(1, dt.date(2024, 1, 2))]
    assert d1["availability"] == round(100 / 120, 4)
    assert d1["performance"] == 1.0 and d1["quality"] == 0.95
    assert d1["oee"] == round((100 / 120) * 1.0 * 0.95, 4)
    assert out[(2, dt.date(2024, 1, 3))]["availability"] == 1.0
    z = out[(3, dt.date(2024, 1, 4))]
    assert z["availability"] is None and z["performance"] is None and z["oee"] is None


def test_reliability_one_stop_has_null_mtbf(spark, refs):
    wos = _wos(spark, [
        ("w1", "EQP-101", "UNPLANNED", T("2024-01-02 15:00"), T("2024-01-02 09:00"), 20, "COMPLETED", "High", "T", None),
        ("w2", "EQP-101", "UNPLANNED", T("2024-01-04 15:00"), T("2024-01-04 09:00"), 40, "OPEN", "High", "T", None),
        ("w3", "EQP-101", "UNPLANNED", T("2024-02-01 05:00"), T("2024-01-31 23:00"), 10, "OPEN", "High", "T", None),
        ("w4", "EQP-102", "UNPLANNED", T("2024-01-02 15:00"), T("2024-01-02 09:00"), 15, "OPEN", "High", "T", None),
    ])
    out = {(r["equipment_key"], r["stop_month"]): r for r in gold.equipment_reliability(wos, refs.equipment_xref).collect()}
    jan = out[("EQP-101", dt.date(2024, 1, 1))]
    # local month decides the bucket: w3 is 2024-01-31 local although February in UTC
    assert jan["unplanned_stop_count"] == 3
    assert jan["mttr_minutes"] == round(70 / 3, 1)
    assert out[("EQP-102", dt.date(2024, 1, 1))]["mtbf_hours"] is None


def test_changeover_cases(spark):
    runs = _runs(spark, [
        ("a", 1, "X", T("2024-01-01 08:00"), T("2024-01-01 09:00"), None, "COMPLETED", 1, 1, 0),   # first run
        ("b", 1, "X", T("2024-01-01 09:30"), T("2024-01-01 10:00"), None, "COMPLETED", 1, 1, 0),   # same sku
        ("c", 1, "Y", T("2024-01-01 10:00"), T("2024-01-01 11:00"), None, "COMPLETED", 1, 1, 0),   # touching: 0 min
        ("d", 1, "Z", T("2024-01-01 10:30"), T("2024-01-01 12:00"), None, "COMPLETED", 1, 1, 0),   # overlap: dropped
        ("e", 1, "X", T("2024-02-01 08:00"), T("2024-02-01 09:00"), None, "COMPLETED", 1, 1, 0),   # across a month bucket
        ("f", 2, "X", T("2024-01-01 08:00"), T("2024-01-01 09:00"), None, "COMPLETED", 1, 1, 0),
        ("g", 2, "Y", T("2024-01-01 08:00"), T("2024-01-01 09:30"), None, "COMPLETED", 1, 1, 0),   # equal start, tie by run id
    ])
    got = rows(gold.changeover_time(runs), "line_id", "from_product_sku", "to_product_sku", "changeover_minutes")
    # 2024-01-01 12:00 → 2024-02-01 08:00 = 30 d 20 h
    assert got == [(1, "X", "Y", 0), (1, "Z", "X", 44400)]


def test_first_pass_yield_cases(spark):
    cols = "check_id STRING, batch_id STRING, check_type STRING, parameter STRING, check_ts TIMESTAMP, check_ts_local TIMESTAMP, line_id INT, check_result STRING"
    checks = spark.createDataFrame([
        ("c1", "B1", "final", "p", T("2024-01-01 10:00"), T("2024-01-01 04:00"), 1, "FAIL"),
        ("c2", "B1", "final", "p", T("2024-01-01 11:00"), T("2024-01-01 05:00"), 1, "PASS"),      # recheck passes: still a fail
        ("c3", "B2", "final", "p", T("2024-01-01 10:00"), T("2024-01-01 04:00"), 1, "MARGINAL"),  # not PASS
        ("c5", "B3", "final", "p", T("2024-01-01 10:00"), T("2024-01-01 04:00"), 1, "FAIL"),      # tie: c4 first
        ("c4", "B3", "final", "p", T("2024-01-01 10:00"), T("2024-01-01 04:00"), 1, "PASS"),
    ], cols)
    r = gold.first_pass_yield(checks).first()
    assert (r["first_checks_total"], r["first_checks_passed"], r["first_pass_yield"]) == (3, 1, 0.3333)


def test_critical_work_orders_week_is_monday(spark):
    wos = _wos(spark, [
        ("w1", "EQP-101", "UNPLANNED", None, None, 10, "COMPLETED", "Critical", "T-1", T("2026-02-22 12:00")),  # Sunday
        ("w2", "EQP-101", "UNPLANNED", None, None, 21, "COMPLETED", "Critical", "T-1", T("2026-02-16 00:30")),  # Monday
        ("w3", "EQP-101", "UNPLANNED", None, None, 99, "OPEN", "Critical", "T-1", None),
    ])
    r = gold.critical_work_orders(wos).collect()
    assert len(r) == 1 and r[0]["resolved_week"] == dt.date(2026, 2, 16)
    assert r[0]["critical_work_orders_resolved"] == 2 and r[0]["avg_downtime_minutes"] == 15.5
