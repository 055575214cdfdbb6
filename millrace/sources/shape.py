"""Driver tables → the dirty raw extracts the pipeline ingests.

The reference pipeline reads six messy exports (historian readings,
production runs, maintenance work orders, LIMS checks, alarms, an equipment
registry) plus a change feed.  We make those extracts from the driver's
tables with deterministic, integer-only formulas so that every query's work
grows with the data.  The output of each function is an all-STRING frame, as
bronze would hold it.  The SQL oracles compute the *truth* (e.g. the
timestamp before it was rendered as text) from the same driver columns;
they never re-run these formulas' parsers.

All shaping is narrow (one scan, no shuffle): replays are produced with an
``explode`` instead of a second scan + union.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace import PLANT_TZ


def _s(c: Column) -> Column:
    return c.cast("string")


def _hours(ts: Column, hours: Column) -> Column:
    return ts + F.make_dt_interval(hours=hours.cast("int"))


def _minutes(ts: Column, minutes: Column) -> Column:
    return ts + F.make_dt_interval(mins=minutes.cast("int"))


def line_spelling(line: Column, selector: Column) -> Column:
    """Line number spelled four ways: ``l``, ``Ll``, ``Line l``, ``Line-l``."""
    sel = F.pmod(selector, F.lit(4))
    l = _s(line)
    return (F.when(sel == 0, l)
            .when(sel == 1, F.concat(F.lit("L"), l))
            .when(sel == 2, F.concat(F.lit("Line "), l))
            .otherwise(F.concat(F.lit("Line-"), l)))


def equipment_alias(user_id: Column) -> Column:
    """SCADA-style equipment alias from a user id (three naming styles + one unknown)."""
    k = F.pmod(user_id, F.lit(12))
    return (F.when(k < 4, F.concat(F.lit("EQ-"), _s(k + 101)))
            .when(k < 8, F.concat(F.lit("EQUIP_"), _s(k + 197)))
            .when(k < 11, _s(k + 293))
            .otherwise(F.lit("EQ-999")))


def asset_number(suppkey: Column) -> Column:
    """SAP asset number ``A-nnn`` by position: 101–104, 201–204, 301–303."""
    k = F.pmod(suppkey, F.lit(11))
    n = F.when(k < 4, k + 101).when(k < 8, k + 197).otherwise(k + 293)
    return F.concat(F.lit("A-"), _s(n))


def raw_readings(events: DataFrame, zone: str = PLANT_TZ, keep_id: bool = False) -> DataFrame:
    """R: historian readings (``sensor_readings`` extract) from ``events``.
    ``keep_id`` keeps the source ``event_id`` as ``_event_id``."""
    eid, ts = F.col("event_id"), F.col("ts")
    local = F.from_utc_timestamp(ts, zone)
    mod4 = F.pmod(eid, F.lit(4))
    raw_ts = (F.when(F.pmod(eid, F.lit(97)) == 0, F.lit("not-a-time"))
              .when(mod4 == 0, _s(F.unix_millis(ts)))
              .when(mod4 == 1, F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss'Z'"))
              .when(mod4 == 2, F.date_format(local, "yyyy-MM-dd HH:mm:ss"))
              .otherwise(F.date_format(local, "MM/dd/yyyy HH:mm")))
    is_error = F.col("event_type") == "error"
    value = (F.when(F.pmod(eid, F.lit(53)) == 0, F.lit("-999.99"))
             .when(F.pmod(eid, F.lit(41)) == 0, F.lit(""))
             .when(is_error & (F.pmod(eid, F.lit(37)) == 0),
                   F.concat(F.lit("-"), _s(F.col("value"))))
             .otherwise(_s(F.col("value"))))
    q = F.pmod(eid, F.lit(10))
    copies = F.when(F.pmod(eid, F.lit(50)) == 0, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return (events
            .select(eid, ts, "user_id", "event_type", "value", F.explode(copies).alias("_copy"))
            .select(
                raw_ts.alias("timestamp"),
                equipment_alias(F.col("user_id")).alias("equipment_id"),
                F.when(is_error, F.lit("line_VIB_error")).otherwise(F.col("event_type")).alias("sensor_tag"),
                value.alias("value"),
                F.when(q == 0, "0").when(q == 1, "64").otherwise("192").alias("quality"),
                F.when(q == 0, "BAD").when(q == 1, "SUSPECT").otherwise("GOOD").alias("status"),
                line_spelling(F.pmod(F.col("user_id"), F.lit(3)) + 1, eid).alias("line_id"),
                *([eid.alias("_event_id")] if keep_id else []),
            ))


def raw_readings_with_id(events: DataFrame, zone: str = PLANT_TZ) -> DataFrame:
    return raw_readings(events, zone, keep_id=True)


def raw_runs(orders: DataFrame, zone: str = PLANT_TZ) -> DataFrame:
    """N: production runs from ``orders``."""
    k = F.col("o_orderkey")
    start_local = _hours(F.col("o_orderdate"), F.pmod(k, F.lit(21)) + 3)
    minutes = F.pmod(k * 7, F.lit(600)) + 30
    end_utc = _minutes(F.to_utc_timestamp(start_local, zone), minutes)
    status = (F.when(F.col("o_orderstatus") == "F", "COMPLETED")
              .when(F.col("o_orderstatus") == "O", "RUNNING")
              .when(F.col("o_orderstatus") == "P", "SCHEDULED")
              .otherwise("ON_HOLD"))
    total = F.floor(F.col("o_totalprice")).cast("bigint")
    scrap = F.expr("CAST(floor(o_totalprice) AS BIGINT) * pmod(o_orderkey, 7) div 200")
    unit_sel = F.pmod(k, F.lit(4))
    unit = (F.when(unit_sel == 0, "liters").when(unit_sel == 1, "L")
            .when(unit_sel == 2, "gal").otherwise("gallons"))
    gallons = unit_sel >= 2
    base = total * F.lit(0.355) / F.lit(1000)
    base = F.when(gallons, base / F.lit(3.785)).otherwise(base)
    actual = F.when(F.pmod(k, F.lit(11)) == 0, base * F.lit(1.2)).otherwise(base)
    completed = F.col("o_orderstatus") == "F"
    return orders.select(
        _s(k).alias("run_id"),
        _s(F.pmod(F.col("o_custkey"), F.lit(3)) + 1).alias("line_id"),
        F.concat(F.lit("SKU-"), _s(F.pmod(k, F.lit(5)))).alias("product_sku"),
        F.concat(F.lit("Drink "), _s(F.pmod(k, F.lit(5))), F.lit(" 355ml")).alias("product_name"),
        F.date_format(start_local, "yyyy-MM-dd'T'HH:mm:ss").alias("start_time"),
        F.when(completed, F.date_format(end_utc, "yyyy-MM-dd'T'HH:mm:ss'Z'")).otherwise(F.lit("")).alias("end_time"),
        status.alias("status"),
        _s(base).alias("target_volume"),
        _s(actual).alias("actual_volume"),
        unit.alias("volume_unit"),
        _s(total).alias("total_units"),
        _s(total - scrap).alias("good_units"),
        _s(scrap).alias("scrap_units"),
        _s(F.pmod(k, F.lit(20)) + 80).alias("efficiency_pct"),
        F.concat(F.lit("OP-"), _s(F.pmod(k, F.lit(8)))).alias("operator_id"),
    )


# Work-order vocabularies of the maintenance extract.
WO_TYPES = ["Preventive", "PM", "Corrective", "Breakdown"]
WO_OPEN_STATES = ["OPEN", "IN_PROGRESS", "CANCELLED"]
PRIORITY_BY_FLAG = {"R": "Critical", "A": "High", "N": "Low"}


def _pick(values: list[str], selector: Column) -> Column:
    expr = None
    for i, v in enumerate(values):
        expr = (F.when(selector == i, F.lit(v)) if expr is None else expr.when(selector == i, F.lit(v)))
    return expr


def raw_work_orders(lineitem: DataFrame, zone: str = PLANT_TZ) -> DataFrame:
    """M: maintenance work orders from ``lineitem``.

    (l_orderkey, l_linenumber) is not unique in the driver table, so the
    work-order id is a label, not a key.
    """
    created_local = _hours(F.col("l_shipdate"), F.pmod(F.col("l_orderkey"), F.lit(21)) + 3)
    slash = F.pmod(F.col("l_partkey"), F.lit(3)) == 0
    done = F.col("l_linestatus") == "F"
    completed_utc = _hours(F.to_utc_timestamp(created_local, zone), F.col("l_quantity"))
    flag = F.col("l_returnflag")
    priority = None
    for f_, p in PRIORITY_BY_FLAG.items():
        priority = F.when(flag == f_, p) if priority is None else priority.when(flag == f_, p)
    wo_type = _pick(WO_TYPES, F.pmod(F.col("l_linenumber"), F.lit(4)))
    return lineitem.select(
        F.concat(F.lit("WO-"), _s(F.col("l_orderkey")), F.lit("-"), _s(F.col("l_linenumber"))).alias("work_order_id"),
        asset_number(F.col("l_suppkey")).alias("asset_number"),
        F.concat(wo_type, F.lit(" service, part "), _s(F.col("l_partkey"))).alias("description"),
        F.when(done, F.lit("COMPLETED"))
         .otherwise(_pick(WO_OPEN_STATES, F.pmod(F.col("l_linenumber"), F.lit(3)))).alias("status"),
        priority.otherwise(F.lit("Medium")).alias("priority"),
        wo_type.alias("type"),
        F.when(slash, F.date_format(created_local, "MM/dd/yyyy HH:mm"))
         .otherwise(F.date_format(created_local, "yyyy-MM-dd HH:mm:ss")).alias("created_date"),
        F.when(done, F.date_format(completed_utc, "yyyy-MM-dd'T'HH:mm:ss'Z'")).otherwise(F.lit("")).alias("completed_date"),
        _s((F.col("l_quantity") * 5).cast("int")).alias("downtime_minutes"),
        F.concat(F.lit("T-"), _s(F.pmod(F.col("l_suppkey"), F.lit(6)))).alias("technician"),
        F.concat(F.lit("P-"), _s(F.col("l_partkey"))).alias("parts_used"),
    )


# LIMS check vocabularies.
CHECK_TYPES = ["incoming", "in_process", "final"]
SPEC_LOWER, SPEC_UPPER, MARGIN = 5, 45, 2


def raw_checks(lineitem: DataFrame, part: DataFrame) -> DataFrame:
    """C: LIMS quality checks from ``lineitem ⋈ part``.

    ``check_id`` is built so that its text order equals the tie-break order
    (l_suppkey, l_linenumber, l_extendedprice, l_tax, l_discount) within a batch.
    The part side is only (p_partkey, p_type); it is joined on its key (the
    planner broadcasts it while it is small, shuffles otherwise).
    """
    li = lineitem.select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity",
                         "l_extendedprice", "l_tax", "l_discount", "l_shipdate")
    p = part.select(F.col("p_partkey").alias("l_partkey"), "p_type")
    q = F.col("l_quantity")
    local = _minutes(_hours(F.col("l_shipdate"), F.col("l_linenumber") + 3),
                     F.pmod(F.col("l_partkey"), F.lit(60)))
    in_spec = (q >= SPEC_LOWER) & (q <= SPEC_UPPER)
    near = (q >= SPEC_LOWER - MARGIN) & (q <= SPEC_UPPER + MARGIN)
    def pad(c: Column, width: int) -> Column:
        return F.lpad(c.cast("string"), width, "0")
    check_id = F.concat_ws("-", F.lit("QC"), pad(F.col("l_orderkey"), 10), pad(F.col("l_suppkey"), 8),
                           pad(F.col("l_linenumber"), 2),
                           pad(F.round(F.col("l_extendedprice") * 100).cast("bigint"), 12),
                           pad(F.round(F.col("l_tax") * 100).cast("int"), 3),
                           pad(F.round(F.col("l_discount") * 100).cast("int"), 3))
    return li.join(p, "l_partkey").select(
        check_id.alias("check_id"),
        F.concat(F.lit("B-"), _s(F.col("l_orderkey"))).alias("batch_id"),
        line_spelling(F.pmod(F.col("l_suppkey"), F.lit(3)) + 1, F.col("l_partkey")).alias("line_id"),
        _pick(CHECK_TYPES, F.pmod(F.col("l_linenumber"), F.lit(3))).alias("check_type"),
        F.col("p_type").alias("parameter"),
        _s(q).alias("value"),
        F.lit(str(SPEC_LOWER)).alias("lower_spec"),
        F.lit(str(SPEC_UPPER)).alias("upper_spec"),
        F.lit("units").alias("unit"),
        F.when(in_spec, "PASS").when(near, "MARGINAL").otherwise("FAIL").alias("result"),
        F.concat(F.lit("QA-"), _s(F.pmod(F.col("l_partkey"), F.lit(5)))).alias("checked_by"),
        F.date_format(local, "yyyy-MM-dd'T'HH:mm:ss").alias("check_timestamp"),
    )


# Alarm severities (numeric and text) and lifecycle states.
SEVERITY_RAW = ["1", "2", "3", "4", "CRITICAL", "HIGH", "MEDIUM", "LOW"]
ALARM_STATES = ["ACKNOWLEDGED", "CLEARED", "ACTIVE", "SHELVED"]


def _alarm_frame(events: DataFrame) -> DataFrame:
    return events.select("event_id", "ts", "user_id", "event_type").filter(F.col("event_type") == "error")


def raw_alarms(events: DataFrame, zone: str = PLANT_TZ) -> DataFrame:
    """A: alarm events from the ``error`` rows of ``events``."""
    eid, ts = F.col("event_id"), F.col("ts")
    state = F.pmod(eid, F.lit(4))
    acked = state < 2
    ack_ts = _minutes(ts, F.pmod(eid, F.lit(90)))
    fmt = "yyyy-MM-dd HH:mm:ss"
    return _alarm_frame(events).select(
        F.concat(F.lit("AL-"), _s(eid)).alias("alarm_id"),
        F.date_format(F.from_utc_timestamp(ts, zone), fmt).alias("timestamp"),
        equipment_alias(F.col("user_id")).alias("equipment_id"),
        F.lit("VIB_HIGH").alias("alarm_tag"),
        F.lit("Vibration above limit").alias("description"),
        _pick(SEVERITY_RAW, F.pmod(eid, F.lit(8))).alias("severity"),
        _pick(ALARM_STATES, state).alias("status"),
        F.when(acked, F.date_format(F.from_utc_timestamp(ack_ts, zone), fmt)).otherwise(F.lit("")).alias("acknowledged_at"),
        F.when(acked, F.concat(F.lit("OP-"), _s(F.pmod(F.col("user_id"), F.lit(6))))).otherwise(F.lit("")).alias("acknowledged_by"),
        F.when(state == 2, F.lit("")).otherwise(_s(F.pmod(eid, F.lit(600)))).alias("duration_seconds"),
        F.concat(F.lit("L"), _s(F.pmod(F.col("user_id"), F.lit(3)) + 1)).alias("line_id"),
    )


def raw_acknowledgments(events: DataFrame) -> DataFrame:
    """K: acknowledgment change feed — two change rows per acknowledged alarm,
    and every fifth acknowledged alarm has its acknowledgment deleted later."""
    eid, ts = F.col("event_id"), F.col("ts")
    acked = _alarm_frame(events).filter(F.pmod(eid, F.lit(4)) < 2)
    first = _minutes(ts, F.pmod(eid, F.lit(90)))
    seqs = F.when(F.pmod(eid, F.lit(5)) == 0, F.array(*[F.lit(i) for i in (1, 2, 3)])) \
            .otherwise(F.array(F.lit(1), F.lit(2)))
    return (acked.select(eid, ts, "user_id", F.explode(seqs).alias("change_seq"))
            .select(
                F.concat(F.lit("AL-"), _s(eid)).alias("alarm_id"),
                F.col("change_seq"),
                F.when(F.col("change_seq") == 3, "DELETE").otherwise("UPSERT").alias("op"),
                F.concat(F.lit("OP-"), _s(F.pmod(F.col("user_id") + F.col("change_seq") - 1, F.lit(6)))).alias("acknowledged_by"),
                _minutes(first, (F.col("change_seq") - 1) * 5).alias("change_ts"),
                F.concat(F.lit("note "), _s(F.col("change_seq"))).alias("note"),
            ))


# Equipment types (two casings each) and registry vocabularies.
EQUIPMENT_TYPES = ["Filling Machine", "Capping Machine", "Labeler", "Pasteurizer", "Conveyor",
                   "Case Packer", "Palletizer", "Rinser", "CIP Unit", "Depalletizer"]
REGISTRY_STATES = ["RUNNING", "RUNNING", "RUNNING", "STOPPED", "MAINTENANCE", "DECOMMISSIONED"]
CRITICALITY_RAW = ["A", "B", "c"]
REGISTRY_EPOCH = "2000-01-01"


def registry_install_date(suppkey: Column) -> Column:
    """True install date of a registry item (the oracle uses the same rule)."""
    return F.date_add(F.lit(REGISTRY_EPOCH).cast("date"), F.pmod(suppkey * 37, F.lit(7000)).cast("int"))


def raw_registry(supplier: DataFrame, export: int = 0) -> DataFrame:
    """E: equipment registry (JSON export) from ``supplier``.  In the second
    export a quarter of the machines has moved to the next state, in the third
    a fifth of them (once more)."""
    s = F.col("s_suppkey")
    moved = sum((F.pmod(s, F.lit(n)) == 0).cast("int") for k, n in ((1, 4), (2, 5)) if export >= k)
    n = _s(s + 1000)
    style = F.pmod(s, F.lit(3))
    eq_id = (F.when(style == 0, F.concat(F.lit("EQ-"), n))
             .when(style == 1, F.concat(F.lit("EQUIP_"), n)).otherwise(n))
    inst = registry_install_date(s)
    fmt_sel = F.pmod(s, F.lit(4))
    install = (F.when(fmt_sel == 0, F.date_format(inst, "yyyy-MM-dd"))
               .when(fmt_sel == 1, F.upper(F.date_format(inst, "dd-MMM-yyyy")))
               .when(fmt_sel == 2, F.date_format(inst, "yyyy/MM/dd"))
               .otherwise(F.date_format(inst, "dd/MM/yyyy")))
    last = F.date_add(inst, F.pmod(s * 11, F.lit(900)).cast("int") + 30)
    last_raw = F.when(F.pmod(s, F.lit(2)) == 0, F.date_format(last, "yyyy-MM-dd")) \
                .otherwise(F.date_format(last, "dd-MMM-yyyy"))
    t = _pick(EQUIPMENT_TYPES, F.pmod(s, F.lit(10)))
    typ = F.when(F.pmod(s, F.lit(7)) == 0, F.upper(t)).when(F.pmod(s, F.lit(7)) == 1, F.lower(t)).otherwise(t)
    line = F.pmod(s, F.lit(3)) + 1
    specs = (F.when(style == 0, F.format_string('{"speed_bpm": %d, "power_kw": %d}',
                                                F.pmod(s * 13, F.lit(900)) + 100, F.pmod(s, F.lit(40)) + 5))
             .when(style == 1, F.concat(F.lit("see manual rev "), _s(F.pmod(s, F.lit(9)))))
             .otherwise(F.lit(None).cast("string")))
    return supplier.select(
        eq_id.alias("equipment_id"),
        F.concat(t, F.lit(" "), n).alias("name"),
        F.concat(F.lit("Maker "), _s(F.pmod(F.col("s_nationkey"), F.lit(5)))).alias("manufacturer"),
        F.concat(F.lit("M-"), _s(F.pmod(s, F.lit(17)))).alias("model"),
        F.when(F.pmod(s, F.lit(2)) == 0, F.concat(F.lit("Line "), _s(line), F.lit(" / Bay "), _s(F.pmod(s, F.lit(9)))))
         .otherwise(F.concat(F.lit("L"), _s(line), F.lit("-B"), _s(F.pmod(s, F.lit(9))))).alias("location"),
        typ.alias("type"),
        F.when(F.pmod(s, F.lit(2)) == 0, F.concat(F.lit("Line "), _s(line))).otherwise(_s(line)).alias("line"),
        _pick(REGISTRY_STATES, F.pmod(s + moved, F.lit(6))).alias("status"),
        _pick(CRITICALITY_RAW, F.pmod(s, F.lit(3))).alias("criticality"),
        install.alias("install_date"),
        last_raw.alias("last_maintenance"),
        specs.alias("specs"),
    )


def raw_equipment_changes(orders: DataFrame) -> DataFrame:
    """V: attribute change feed — key o_custkey % 200, ordered by
    (o_orderdate, o_orderkey), tracked attribute o_orderpriority."""
    return orders.select(
        F.concat(F.lit("EQP-"), _s(F.pmod(F.col("o_custkey"), F.lit(200)) + 1000)).alias("equipment_key"),
        F.col("o_orderdate").alias("change_ts"),
        F.col("o_orderkey").alias("change_seq"),
        F.col("o_orderpriority").alias("maintenance_class"),
    )
