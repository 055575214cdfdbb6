import datetime as dt

from millrace.plans import ask

from library_help import rows


def test_oee_for_explicit_and_last_tuesday(spark):
    oee = spark.createDataFrame([
        (1, dt.date(2026, 3, 10), 0.9), (2, dt.date(2026, 3, 10), 0.8),
        (2, dt.date(2026, 3, 17), 0.7), (2, dt.date(2026, 3, 17), None)][:3],
        "line_id INT, production_date DATE, oee DOUBLE")
    assert rows(ask.oee_for(oee, [2], on="2026-03-17"), "oee") == [(0.7,)]
    # newest date 2026-03-17 → "today" is Wednesday 03-18 → last Tuesday of the previous cycle = 03-10
    assert rows(ask.oee_for(oee), "line_id", "oee") == [(1, 0.9), (2, 0.8)]


def test_unplanned_stops_threshold(spark):
    rel = spark.createDataFrame([("EQP-101", 3), ("EQP-102", 4)], "equipment_key STRING, unplanned_stop_count BIGINT")
    assert rows(ask.unplanned_stops_over(rel, 3), "equipment_key") == [("EQP-102",)]


def test_top_technician_keeps_ties(spark):
    c = spark.createDataFrame([("T-1", dt.date(2026, 2, 16), 2), ("T-2", dt.date(2026, 2, 16), 2),
                               ("T-3", dt.date(2026, 2, 16), 1), ("T-3", dt.date(2026, 2, 23), 1)],
                              "technician STRING, resolved_week DATE, critical_work_orders_resolved BIGINT")
    assert rows(ask.top_technicians(c, 1), "technician", "resolved_week") == [
        ("T-1", dt.date(2026, 2, 16)), ("T-2", dt.date(2026, 2, 16)), ("T-3", dt.date(2026, 2, 23))]
