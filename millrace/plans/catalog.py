"""Registry of the named queries exposed through ``__spark_entry__``.

Each query is ``(spark, sf_dir) -> DataFrame`` over the driver's tables.  At
the edge, timestamps are returned as ``timestamp_ntz`` (UTC wall clock) so
results compare by value with any SQL engine, independent of client zones.
"""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType, TimestampType

from millrace.functions.parse import parse_multi_ts, ts_format_class
from millrace.operators import expect, quality
from millrace.operators.conform import resolve
from millrace.operators import scd
from millrace.plans import analysis, ask, gold, silver
from millrace.plans.plant import Plant

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def edge(df: DataFrame) -> DataFrame:
    casts = {f.name: F.col(f.name).cast("timestamp_ntz")
             for f in df.schema.fields if isinstance(f.dataType, TimestampType)}
    return df.withColumns(casts) if casts else df


def query(name: str):
    def deco(fn: Callable[[Plant], DataFrame]):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return edge(fn(Plant(spark, sf_dir)))
        run.__name__ = name
        run.__doc__ = fn.__doc__
        QUERIES[name] = run
        return fn
    return deco


# ------------------------------------------------------------------ gold marts
@query("gold_oee_daily")
def _gold_oee_daily(p: Plant) -> DataFrame:
    """OEE per line and plant-local day."""
    return p.oee_daily()


@query("gold_reliability")
def _gold_reliability(p: Plant) -> DataFrame:
    """MTBF and MTTR per equipment and plant-local month (unplanned orders)."""
    return p.equipment_reliability()


@query("gold_scrap_rate")
def _gold_scrap_rate(p: Plant) -> DataFrame:
    """Scrap units over total units per line and plant-local day."""
    return p.scrap_rate_daily()


@query("gold_changeover")
def _gold_changeover(p: Plant) -> DataFrame:
    """Minutes between consecutive completed runs of a line where the SKU changes."""
    return p.changeover_time()


@query("gold_first_pass_yield")
def _gold_first_pass_yield(p: Plant) -> DataFrame:
    """Share of (batch, type, parameter) combinations passing on their first check."""
    return p.first_pass_yield()


@query("gold_critical_work_orders")
def _gold_critical_work_orders(p: Plant) -> DataFrame:
    """Critical work orders resolved per technician and plant-local week."""
    return p.critical_work_orders()


# ------------------------------------------------------------------ silver tables
@query("silver_readings")
def _silver_readings(p: Plant) -> DataFrame:
    """Accepted readings, deduplicated (quality, then ingest time)."""
    return p.silver_readings().drop("_ingest_ts", "_source_file")


@query("quarantine_readings")
def _quarantine_readings(p: Plant) -> DataFrame:
    """Readings failing a hard rule, with their raw text and a reason code."""
    return p.quarantine_readings().select("timestamp", "equipment_id", "sensor_tag", "quality", "status",
                                          "line_id", "reading_ts", "equipment_key", "quarantine_reason")


@query("quarantine_balance")
def _quarantine_balance(p: Plant) -> DataFrame:
    """Accepted + quarantined + duplicates = input, counted in one row."""
    tagged = silver.readings_tagged(p.bronze_readings(), p.refs, p.zone)
    return quality.quarantine_balance(tagged, p.silver_readings())


@query("dedupe_readings")
def _dedupe_readings(p: Plant) -> DataFrame:
    """Keys left after ``dropDuplicates`` on (reading_ts, equipment_key, sensor_tag)."""
    return p.silver_readings(dedupe="first").select(*silver.READING_KEY)


@query("dedupe_best")
def _dedupe_best(p: Plant) -> DataFrame:
    """Keys that had copies: the winner (highest quality, then value) and the copy count."""
    tagged = silver.readings_tagged(p.bronze_readings(), p.refs, p.zone)
    acc = tagged.filter(F.col("quarantine_reason").isNull()).select(
        *silver.READING_KEY, F.col("quality").try_cast("int").alias("opc_quality_code"), "value", "line_id")
    return (acc.groupBy(*silver.READING_KEY)
            .agg(F.count(F.lit(1)).alias("copies"),
                 F.max(F.struct("opc_quality_code", "value", "line_id")).alias("w"))
            .filter(F.col("copies") > 1)
            .select(*silver.READING_KEY, "copies",
                    F.col("w.opc_quality_code").alias("opc_quality_code"),
                    F.col("w.value").alias("value"), F.col("w.line_id").alias("line_id")))


@query("sentinel_scrub")
def _sentinel_scrub(p: Plant) -> DataFrame:
    """Per tag: sentinel, negative-vibration, empty and scrubbed-NULL raw values."""
    return quality.sentinel_profile(p.bronze_readings())


@query("quality_gate")
def _quality_gate(p: Plant) -> DataFrame:
    """Per line, equipment, tag and day: all vs good-quality readings and their mean."""
    return quality.quality_gate(p.silver_readings())


@query("tag_range_rules")
def _tag_range_rules(p: Plant) -> DataFrame:
    """Per tag: readings outside the physical range of a broadcast rules table."""
    rules = p.spark.createDataFrame(quality.TAG_RANGE_RULES, "sensor_tag STRING, min_value DOUBLE, max_value DOUBLE")
    return quality.tag_range_check(p.silver_readings(), rules)


@query("parse_multi_ts")
def _parse_multi_ts(p: Plant) -> DataFrame:
    """Per source column and encoding: rows, parsed rows, min/max instant."""
    def prof(df, source, col):
        return df.select(F.lit(source).alias("source_column"), ts_format_class(col).alias("ts_format"),
                         parse_multi_ts(col, p.zone).alias("ts"))
    u = (prof(p.bronze_readings(), "sensor_readings.timestamp", "timestamp")
         .unionByName(prof(p.bronze_runs(), "production_runs.start_time", "start_time"))
         .unionByName(prof(p.bronze_runs(), "production_runs.end_time", "end_time"))
         .unionByName(prof(p.bronze_work_orders(), "maintenance_logs.created_date", "created_date"))
         .unionByName(prof(p.bronze_work_orders(), "maintenance_logs.completed_date", "completed_date")))
    return (u.groupBy("source_column", "ts_format")
            .agg(F.count(F.lit(1)).alias("raw_rows"), F.count("ts").alias("parsed_rows"),
                 F.min("ts").alias("min_ts"), F.max("ts").alias("max_ts")))


@query("silver_runs")
def _silver_runs(p: Plant) -> DataFrame:
    """Production runs: UTC + local times, litres, typed units, conformed line."""
    return p.silver_runs().drop("_ingest_ts", "_source_file")


@query("silver_work_orders")
def _silver_work_orders(p: Plant) -> DataFrame:
    """Work orders conformed via the SAP asset crosswalk and type crosswalk."""
    return p.silver_work_orders()


@query("silver_alarms")
def _silver_alarms(p: Plant) -> DataFrame:
    """Alarms with normalised severity, conformed equipment and line."""
    return p.silver_alarms()


@query("silver_quality")
def _silver_quality(p: Plant) -> DataFrame:
    """Quality checks with conformed line, UTC + local times and in-spec flag."""
    return p.silver_quality().drop("_ingest_ts", "_source_file")


def _reports(p: Plant, policy: str | None = None) -> DataFrame:
    """Expectation reports of the tables that have a rule of ``policy`` (of all, if None)."""
    from millrace.operators.profile import union_all
    tables = {
        "sensor_readings": (lambda: silver.readings_tagged(p.bronze_readings(), p.refs, p.zone), silver.READINGS_RULES),
        "production_runs": (p.silver_runs, silver.RUNS_RULES),
        "maintenance_work_orders": (lambda: silver.work_orders_conformed(p.bronze_work_orders(), p.refs, p.zone), silver.WORK_ORDER_RULES),
        "alarms": (lambda: resolve(p.bronze_alarms(), p.refs, severity="severity"), silver.ALARM_RULES),
        "quality_checks": (p.silver_quality, silver.CHECK_RULES),
    }
    return union_all([expect.report(build(), rules, table) for table, (build, rules) in tables.items()
                      if policy is None or any(r.policy == policy for r in rules)])


@query("expectation_report")
def _expectation_report(p: Plant) -> DataFrame:
    """One row per (table, rule): policy, violations, rows evaluated."""
    return _reports(p)


@query("expectation_fail")
def _expectation_fail(p: Plant) -> DataFrame:
    """The abort-policy rules and whether an update would abort."""
    return _reports(p, "fail").filter(F.col("policy") == "fail") \
        .select("table_name", "rule", "violations", "would_abort")


# ------------------------------------------------------------------ SCD / change feeds
def _change_versions(p: Plant) -> DataFrame:
    return scd.scd2(p.equipment_changes(), ["equipment_key"], "change_ts", "change_seq",
                    ["maintenance_class"])


@query("scd2_dim")
def _scd2_dim(p: Plant) -> DataFrame:
    """Type-2 versions of the tracked attribute per equipment key."""
    return _change_versions(p)


# every cleaned column is tracked; the queries return those that SQL states plainly
REGISTRY_TRACKED = ["equipment_id", "name", "manufacturer", "model", "location", "equipment_type", "line_id",
                    "equipment_operational_status", "criticality", "install_date", "install_date_ambiguous",
                    "last_maintenance_date", "specs", "specs_raw"]
REGISTRY_VERSION = ["equipment_key", "equipment_id", "equipment_type", "line_id", "equipment_operational_status",
                    "criticality", "install_date", "last_maintenance_date", "valid_from", "valid_to", "version_seq", "is_current"]


@query("scd2_registry")
def _scd2_registry(p: Plant) -> DataFrame:
    """Type-2 versions of the equipment registry over all its cleaned columns."""
    from millrace.operators.profile import union_all
    return scd.scd2(union_all(p.registry_exports()), ["equipment_key"], "exported_ts", "export_no",
                    REGISTRY_TRACKED).select(*REGISTRY_VERSION)


@query("scd2_asof_join")
def _scd2_asof_join(p: Plant) -> DataFrame:
    """Facts (line items as maintenance events) joined to the version valid at their time."""
    li = p.table("lineitem", ["l_orderkey", "l_linenumber", "l_suppkey", "l_shipdate"])
    facts = li.select("l_orderkey", "l_linenumber",
                      F.concat(F.lit("EQP-"), (F.pmod("l_suppkey", F.lit(200)) + 1000).cast("string")).alias("equipment_key"),
                      (F.col("l_shipdate") + F.expr("INTERVAL 12 HOURS")).alias("fact_ts"))
    return scd.asof_join(facts, _change_versions(p), ["equipment_key"], "fact_ts", ["maintenance_class"])


@query("apply_changes")
def _apply_changes(p: Plant) -> DataFrame:
    """Current acknowledgment per alarm from the change feed (deletes honoured)."""
    return analysis.current_acknowledgments(p.acknowledgments())


@query("unacked_alarms")
def _unacked_alarms(p: Plant) -> DataFrame:
    """Alarms without a current acknowledgment in the change feed."""
    return analysis.unacknowledged_alarms(p.silver_alarms(), p.acknowledgments())


# ------------------------------------------------------------------ intervals
@query("overlap_adjacent")
def _overlap_adjacent(p: Plant) -> DataFrame:
    """Completed runs starting before the previous run of their line ended."""
    return analysis.overlap_adjacent(p.silver_runs())


@query("overlap_pairs")
def _overlap_pairs(p: Plant) -> DataFrame:
    """All pairs of completed runs on one line whose windows overlap."""
    return analysis.run_overlap_pairs(p.silver_runs())


@query("changeover_net")
def _changeover_net(p: Plant) -> DataFrame:
    """Changeover gaps minus merged unplanned downtime overlapping them."""
    return analysis.changeover_net(p.silver_runs(), p.silver_work_orders(), p.refs.equipment_xref)


@query("batch_to_run")
def _batch_to_run(p: Plant) -> DataFrame:
    """Each quality check matched to the run window holding it (with match count)."""
    return analysis.batch_to_run(p.silver_quality(), p.silver_runs())


# ------------------------------------------------------------------ designed marts
@query("reliability_alltime")
def _reliability_alltime(p: Plant) -> DataFrame:
    """All-time unplanned stops per equipment (sum over months)."""
    return gold.reliability_all_time(p.equipment_reliability())


@query("alarm_summary")
def _alarm_summary(p: Plant) -> DataFrame:
    """Alarms per line, local day and severity: counts, unacknowledged, durations."""
    return analysis.alarm_summary(p.silver_alarms(), p.zone)


@query("tag_completeness")
def _tag_completeness(p: Plant) -> DataFrame:
    """Per line and hour: tags reporting vs tags the line has."""
    return analysis.tag_completeness(p.silver_readings())


@query("ingest_lag")
def _ingest_lag(p: Plant) -> DataFrame:
    """Per source: newest event time and minutes behind the newest overall."""
    return analysis.ingest_lag({
        "sensor_readings": p.silver_readings().select("reading_ts"),
        "production_runs": p.silver_runs().select("end_ts"),
        "maintenance_work_orders": p.silver_work_orders().select("created_ts"),
        "quality_checks": p.silver_quality().select("check_ts"),
        "alarms": p.silver_alarms().select("alarm_ts"),
    })


@query("kpi_scorecard")
def _kpi_scorecard(p: Plant) -> DataFrame:
    """Per KPI: rows evaluated, rows meeting the plant target and their share."""
    rel = p.equipment_reliability()
    return analysis.kpi_scorecard({
        "oee": p.oee_daily(), "scrap_rate": p.scrap_rate_daily(), "mtbf_hours": rel,
        "mttr_minutes": rel, "first_pass_yield": p.first_pass_yield(),
        "changeover_minutes": p.changeover_time()})


@query("line_scope")
def _line_scope(p: Plant) -> DataFrame:
    """OEE rows visible to each manager group (row-level line scope)."""
    a = p.spark.createDataFrame(analysis.LINE_ASSIGNMENTS, "manager_group STRING, line_id INT")
    return analysis.line_scope(p.oee_daily(), a).select("manager_group", "line_id", "production_date", "oee")


# ------------------------------------------------------------------ pinned questions
@query("q_line_oee")
def _q_line_oee(p: Plant) -> DataFrame:
    """'What was the OEE for each line last Tuesday?' (the data's own today)."""
    return ask.oee_for(p.oee_daily())


@query("q_unplanned_stops")
def _q_unplanned_stops(p: Plant) -> DataFrame:
    """Equipment-months with more than three unplanned stops."""
    return ask.unplanned_stops_over(p.equipment_reliability(), 3)


@query("q_param_scrap_corr")
def _q_param_scrap_corr(p: Plant) -> DataFrame:
    """Per line: correlation of each parameter's daily mean with scrap rate, ranked."""
    return ask.param_scrap_correlation(p.silver_quality(), p.scrap_rate_daily())


@query("param_scrap_corr_quarters")
def _param_scrap_corr_quarters(p: Plant) -> DataFrame:
    """Per line, parameter and quarter: correlation of check values with scrap rate, merged from stored daily co-moments."""
    from millrace.functions.parse import round_half_up
    from millrace.operators import moments
    from millrace.streaming import ingest
    path = ingest.fresh_dir(p.spark, "check_moments")
    analysis.store_check_moments(p.silver_quality(), p.scrap_rate_daily(), path)
    daily = analysis.check_moments(p.spark, path).withColumn(
        "quarter_start", F.trunc("production_date", "QUARTER"))
    merged = moments.merge(daily, ["line_id", "parameter", "quarter_start"])
    return merged.select("line_id", "parameter", "quarter_start", F.col("n").alias("checks"),
                         round_half_up(moments.correlation(), 6).alias("corr"))


@query("q_fill_weight_trend")
def _q_fill_weight_trend(p: Plant) -> DataFrame:
    """Daily and 7-day moving mean check value per SKU and parameter."""
    matched = analysis.batch_to_run(p.silver_quality(), p.silver_runs(),
                                    carry=["parameter", "value", "check_ts_local"], run_carry=["product_sku"])
    return ask.fill_weight_trend(matched)


@query("q_fill_weight_matches")
def _q_fill_weight_matches(p: Plant) -> DataFrame:
    """How many checks the fill-weight trend rests on: per parameter, those
    with exactly one run, with several, and with none."""
    matched = analysis.batch_to_run(p.silver_quality(), p.silver_runs(), carry=["parameter"])
    n = F.col("match_count")
    return matched.groupBy("parameter").agg(
        F.count(F.lit(1)).alias("checks"), F.count_if(n == 1).alias("matched_checks"),
        F.count_if(n > 1).alias("ambiguous_checks"), F.count_if(n == 0).alias("unmatched_checks"))


@query("q_top_technician")
def _q_top_technician(p: Plant) -> DataFrame:
    """Technician(s) with the most critical orders resolved each week (ties kept)."""
    return ask.top_technicians(p.critical_work_orders(), 1)


# ------------------------------------------------------------------ registry
@query("registry_clean")
def _registry_clean(p: Plant) -> DataFrame:
    """Equipment registry with conformed key, casing, parsed dates and renamed status."""
    return p.registry_clean().select(
        "equipment_id", "equipment_key", "equipment_type", "line_id", "equipment_operational_status",
        "criticality", "install_date", "install_date_ambiguous", "last_maintenance_date")


@query("specs_variant")
def _specs_variant(p: Plant) -> DataFrame:
    """Polymorphic specs: JSON → VARIANT fields, else the text kept aside."""
    r = p.registry_clean()
    return r.select("equipment_key",
                    F.when(F.col("specs").isNotNull(), "JSON").when(F.col("specs_raw").isNotNull(), "TEXT")
                     .otherwise("NULL").alias("specs_kind"),
                    F.variant_get("specs", "$.speed_bpm", "int").alias("speed_bpm"),
                    F.variant_get("specs", "$.power_kw", "int").alias("power_kw"),
                    F.to_json("specs").alias("specs_json"), "specs_raw")


@query("parse_multi_date")
def _parse_multi_date(p: Plant) -> DataFrame:
    """Registry install dates per layout: rows, parsed, ambiguous, min/max."""
    from millrace.functions.parse import date_ambiguous, date_format_class, parse_multi_date
    b = p.bronze_registry()
    return (b.select(date_format_class("install_date").alias("date_format"),
                     parse_multi_date("install_date").alias("d"), date_ambiguous("install_date").alias("amb"))
            .groupBy("date_format")
            .agg(F.count(F.lit(1)).alias("raw_rows"), F.count("d").alias("parsed_rows"),
                 F.count_if("amb").cast("bigint").alias("ambiguous_rows"),
                 F.min("d").alias("min_date"), F.max("d").alias("max_date")))


@query("suffix_key")
def _suffix_key(p: Plant) -> DataFrame:
    """Registry ids mapped to conformed keys by their numeric suffix."""
    return p.registry_clean().select("equipment_id", "equipment_key")


# ------------------------------------------------------------------ runs checks
@query("volume_normalize")
def _volume_normalize(p: Plant) -> DataFrame:
    """Per volume unit spelling: litre factor and runs."""
    b = p.bronze_runs()
    return (b.groupBy("volume_unit")
            .agg(F.count(F.lit(1)).alias("runs"),
                 F.count(F.col("actual_volume").try_cast("double")).alias("runs_with_volume"))
            .withColumn("unit_factor", silver.unit_factor()))


@query("sku_size")
def _sku_size(p: Plant) -> DataFrame:
    """Per SKU: unit size in ml parsed from the product name."""
    from millrace.functions.parse import sku_size_ml
    return (p.silver_runs().groupBy("product_sku", "product_name")
            .agg(F.count(F.lit(1)).alias("runs"))
            .withColumn("unit_size_ml", sku_size_ml("product_name")))


@query("volume_validate")
def _volume_validate(p: Plant) -> DataFrame:
    """Completed runs: litres expected from units × size vs reported litres;
    deviation over 5 % → QUARANTINE."""
    from millrace.functions.parse import round_half_up, sku_size_ml
    r = p.silver_runs().filter((F.col("run_status") == "COMPLETED") & F.col("actual_volume_l").isNotNull())
    expected = (F.col("total_units") * sku_size_ml("product_name")).cast("double") / F.lit(1000.0)
    dev = F.abs(F.col("actual_volume_l") / F.nullif(F.col("expected_volume_l"), F.lit(0.0)) - F.lit(1.0))
    return (r.select("run_id", "actual_volume_l", expected.alias("expected_volume_l"))
            .select("run_id", "actual_volume_l", "expected_volume_l",
                    round_half_up(dev, 6).alias("deviation"),
                    F.when(dev > 0.05, "QUARANTINE").otherwise("OK").alias("volume_status")))


@query("check_unit_math")
def _check_unit_math(p: Plant) -> DataFrame:
    """good + scrap = total on completed runs, with a blank-or-null guard on the raw text."""
    b = p.bronze_runs().filter(F.col("status") == "COMPLETED")
    present = F.lit(True)
    for c in ("total_units", "good_units", "scrap_units"):
        present = present & F.col(c).isNotNull() & (F.col(c) != "")
    ok = (F.col("good_units").try_cast("bigint") + F.col("scrap_units").try_cast("bigint")
          == F.col("total_units").try_cast("bigint"))
    return b.agg(F.count(F.lit(1)).alias("completed_runs"),
                 F.count_if(present).cast("bigint").alias("checked_runs"),
                 F.count_if(present & ~F.coalesce(ok, F.lit(False))).cast("bigint").alias("violations"))


@query("ts_local")
def _ts_local(p: Plant) -> DataFrame:
    """Run start as UTC instant and plant-local wall clock."""
    return p.silver_runs().select("run_id", "start_ts", "start_ts_local")


# ------------------------------------------------------------------ conformance
@query("equipment_conform")
def _equipment_conform(p: Plant) -> DataFrame:
    """Raw equipment aliases and the conformed key they resolve to."""
    t = silver.readings_tagged(p.bronze_readings(), p.refs, p.zone)
    return t.groupBy("equipment_id", "equipment_key").agg(F.count(F.lit(1)).alias("rows"))


@query("line_conform")
def _line_conform(p: Plant) -> DataFrame:
    """Raw line spellings per source and the line id they resolve to."""
    def per(df, label):
        c = resolve(df.select(F.col("line_id").alias("raw_line"), "line_id"), p.refs, line="line_id")
        return c.groupBy("raw_line", "line_id").agg(F.count(F.lit(1)).alias("rows")) \
                .select(F.lit(label).alias("source"), "raw_line", "line_id", "rows")
    return (per(p.bronze_readings(), "sensor_readings")
            .unionByName(per(p.bronze_checks(), "quality_checks"))
            .unionByName(per(p.bronze_alarms(), "alarms_events")))


@query("join_coverage")
def _join_coverage(p: Plant) -> DataFrame:
    """Naive join on raw ids finds nothing; the crosswalk resolves every asset."""
    wo = p.bronze_work_orders().select("asset_number")
    rd_ids = p.bronze_readings().select(F.col("equipment_id")).distinct()
    naive = wo.join(rd_ids, wo["asset_number"] == rd_ids["equipment_id"]).agg(F.count(F.lit(1)).alias("naive_matches"))
    wc = silver.work_orders_conformed(p.bronze_work_orders(), p.refs, p.zone)
    cov = wc.agg(F.countDistinct("asset_number").alias("distinct_assets"),
                 F.countDistinct(F.when(F.col("equipment_key").isNotNull(), F.col("asset_number"))).alias("assets_resolved"))
    rt = silver.readings_tagged(p.bronze_readings(), p.refs, p.zone)
    rcov = rt.agg(F.countDistinct("equipment_id").alias("distinct_reading_ids"),
                  F.countDistinct(F.when(F.col("equipment_key").isNotNull(), F.col("equipment_id"))).alias("reading_ids_resolved"))
    return naive.crossJoin(cov).crossJoin(rcov)  # three one-row aggregates


@query("orphan_check")
def _orphan_check(p: Plant) -> DataFrame:
    """Fact ids without a crosswalk match (left anti join), counted."""
    from millrace.operators import profile
    x = p.refs.equipment_xref
    return (profile.orphans(p.bronze_readings(), "equipment_id", x, "source_equipment_id", "sensor_readings")
            .unionByName(profile.orphans(p.bronze_work_orders(), "asset_number", x, "sap_asset_number", "maintenance_logs"))
            .unionByName(profile.orphans(p.bronze_alarms(), "equipment_id", x, "source_equipment_id", "alarms_events")))


@query("check_qc_consistency")
def _check_qc_consistency(p: Plant) -> DataFrame:
    """Per line: checks whose PASS result disagrees with the spec limits."""
    q = p.silver_quality()
    is_pass = F.upper(F.col("check_result")) == "PASS"
    return (q.groupBy("line_id")
            .agg(F.count(F.lit(1)).alias("checks"),
                 F.count_if(is_pass & F.col("in_spec")).cast("bigint").alias("pass_in_spec"),
                 F.count_if(~is_pass & ~F.col("in_spec")).cast("bigint").alias("not_pass_out_of_spec"),
                 F.count_if(~is_pass.eqNullSafe(F.col("in_spec"))).cast("bigint").alias("contradictions")))


@query("check_invariants")
def _check_invariants(p: Plant) -> DataFrame:
    """Completed orders have a completion time; cleared alarms were acknowledged."""
    wo = p.silver_work_orders().filter(F.col("work_order_status") == "COMPLETED")
    al = p.silver_alarms().filter(F.col("alarm_state") == "CLEARED")
    return (wo.agg(F.count(F.lit(1)).alias("rows_checked"),
                   F.count_if(F.col("completed_ts").isNull()).cast("bigint").alias("violations"))
              .select(F.lit("completed_orders_have_completed_date").alias("rule"), "rows_checked", "violations")
            .unionByName(al.agg(F.count(F.lit(1)).alias("rows_checked"),
                                F.count_if(F.col("acknowledged_ts").isNull()).cast("bigint").alias("violations"))
              .select(F.lit("cleared_alarms_acknowledged").alias("rule"), "rows_checked", "violations")))


@query("status_contract")
def _status_contract(p: Plant) -> DataFrame:
    """One row per silver table: rows and the number of ambiguous
    ``status``/``result`` columns left (must be 0)."""
    from millrace.operators import profile
    tables = {"sensor_readings": p.silver_readings(), "production_runs": p.silver_runs(),
              "maintenance_work_orders": p.silver_work_orders(), "alarms": p.silver_alarms(),
              "quality_checks": p.silver_quality()}
    return profile.union_all([
        df.agg(F.count(F.lit(1)).alias("rows")).select(
            F.lit(n).alias("table_name"), "rows", F.lit(silver.no_status_columns(df)).cast("bigint").alias("ambiguous_columns"))
        for n, df in tables.items()])


# ------------------------------------------------------------------ profiling
def _raw_frames(p: Plant) -> dict[str, DataFrame]:
    return {"sensor_readings": p.bronze_readings(), "production_runs": p.bronze_runs(),
            "maintenance_logs": p.bronze_work_orders(), "quality_checks": p.bronze_checks(),
            "alarms_events": p.bronze_alarms(), "equipment_registry": p.bronze_registry()}


@query("table_counts")
def _table_counts(p: Plant) -> DataFrame:
    """Rows per raw extract and each extract's share of all rows."""
    from millrace.operators import profile
    return profile.table_counts(_raw_frames(p))


@query("value_counts")
def _value_counts(p: Plant) -> DataFrame:
    """Value frequencies of the coded columns of the raw extracts."""
    from millrace.operators import profile
    runs, wo, al, rd = p.bronze_runs(), p.bronze_work_orders(), p.bronze_alarms(), p.bronze_readings()
    return profile.value_counts([
        ("production_runs.status", runs, "status"), ("production_runs.volume_unit", runs, "volume_unit"),
        ("maintenance_logs.type", wo, "type"), ("maintenance_logs.priority", wo, "priority"),
        ("maintenance_logs.status", wo, "status"), ("alarms_events.severity", al, "severity"),
        ("alarms_events.status", al, "status"), ("sensor_readings.quality", rd, "quality")])


@query("format_profile")
def _format_profile(p: Plant) -> DataFrame:
    """Rows per format class of timestamps, dates and id schemes."""
    from millrace.functions.parse import date_format_class
    from millrace.operators import profile
    rd, wo, reg = p.bronze_readings(), p.bronze_work_orders(), p.bronze_registry()
    return profile.format_profile([
        ("sensor_readings.timestamp", rd, ts_format_class("timestamp")),
        ("sensor_readings.equipment_id", rd, profile.id_scheme("equipment_id")),
        ("maintenance_logs.created_date", wo, ts_format_class("created_date")),
        ("equipment_registry.install_date", reg, date_format_class("install_date")),
        ("equipment_registry.equipment_id", reg, profile.id_scheme("equipment_id"))])


@query("id_scheme_examples")
def _id_scheme_examples(p: Plant) -> DataFrame:
    """Every equipment id of the readings with its scheme and number of rows."""
    from millrace.operators import profile
    return profile.scheme_examples(p.bronze_readings(), "equipment_id")


@query("distinct_domain")
def _distinct_domain(p: Plant) -> DataFrame:
    """Distinct values of key columns of the raw extracts."""
    from millrace.operators import profile
    rd, wo, qc = p.bronze_readings(), p.bronze_work_orders(), p.bronze_checks()
    return profile.distinct_domain([
        ("sensor_readings.equipment_id", rd, "equipment_id"), ("sensor_readings.sensor_tag", rd, "sensor_tag"),
        ("maintenance_logs.asset_number", wo, "asset_number"), ("maintenance_logs.technician", wo, "technician"),
        ("quality_checks.batch_id", qc, "batch_id"), ("quality_checks.parameter", qc, "parameter")])


@query("dup_keys")
def _dup_keys(p: Plant) -> DataFrame:
    """Raw readings whose natural key occurs more than once."""
    from millrace.operators import profile
    return profile.duplicate_keys(p.bronze_readings(), ["timestamp", "equipment_id", "sensor_tag"])


@query("preview_limit")
def _preview_limit(p: Plant) -> DataFrame:
    """First 20 quarantined readings in a total order (a preview is the feature)."""
    q = _quarantine_readings(p)
    return q.orderBy(*[F.col(c).asc_nulls_first() for c in q.columns]).limit(20)


# ------------------------------------------------------------------ streaming
READING_COLUMNS = ["timestamp", "equipment_id", "sensor_tag", "value", "quality", "status", "line_id"]


def _readings_drops(p: Plant) -> list[DataFrame]:
    """Readings extract in three drops: thirds of the time range, with one row in 61 arriving a drop late."""
    from millrace.plans.plant import EVENT_COLS
    from millrace.sources import shape
    ev = p.table("events", EVENT_COLS)
    second = F.unix_seconds("ts")
    lo, hi = ev.agg(F.min(second), F.max(second)).first()
    third = F.floor((second - F.lit(lo or 0)) * 3 / F.lit((hi or 0) - (lo or 0) + 1)).cast("int")
    drop = F.least(F.lit(2), third + F.when(F.pmod("event_id", F.lit(61)) == 0, 1).otherwise(0))
    return [shape.raw_readings(ev.filter(drop == k), p.zone) for k in range(3)]


def _land_readings(p: Plant, folder: str) -> str:
    from millrace.streaming import ingest
    for k, d in enumerate(_readings_drops(p)):
        ingest.land_csv(d, os.path.join(folder, f"drop_{k}"))
    return folder


def _stream_drops(p: Plant, base: str, writer) -> list:
    """Land one drop after another and let the stream catch up after each: a
    micro-batch is a drop, whatever the number of its files."""
    from millrace.streaming import ingest
    from millrace.streaming.silver_stream import silver_stream
    landing = os.path.join(base, "landing")
    done = []
    for k, d in enumerate(_readings_drops(p)):
        ingest.land_csv(d, os.path.join(landing, f"drop_{k}"))
        stream = ingest.bronze_stream(p.spark, landing, READING_COLUMNS, "csv")
        done.append(ingest.run_once(silver_stream(stream, writer, os.path.join(base, "_chk"))))
    return done


@query("bronze_ingest")
def _bronze_ingest(p: Plant) -> DataFrame:
    """Land each extract as CSV files, ingest every folder with an
    all-STRING ``availableNow`` stream into bronze parquet, count what landed."""
    from millrace.streaming import ingest
    spark = p.spark
    base = ingest.fresh_dir(spark, "bronze_ingest")
    extracts = {"sensor_readings": None, "production_runs": p.bronze_runs(),
                "maintenance_logs": p.bronze_work_orders(), "quality_checks": p.bronze_checks(),
                "alarms_events": p.bronze_alarms()}
    out = []
    for name, df in extracts.items():
        landing = os.path.join(base, "landing", name)
        if df is None:
            _land_readings(p, landing)
            cols = READING_COLUMNS
        else:
            raw = df.drop("_ingest_ts", "_source_file")
            cols = raw.columns
            ingest.land_csv(raw, landing)
        stream = ingest.bronze_stream(spark, landing, cols, "csv")
        target = os.path.join(base, "bronze", name)
        ingest.run_once(ingest.to_parquet(stream, target, os.path.join(base, "_chk", name)))
        b = spark.read.parquet(target)
        out.append(b.agg(F.count(F.lit(1)).alias("rows"),
                         F.count(ingest.RESCUE_COL).alias("rescued_rows"))
                    .select(F.lit(name).alias("table_name"), "rows", "rescued_rows"))
    from millrace.operators.profile import union_all
    return union_all(out)


REGISTRY_COLUMNS = ["equipment_id", "name", "manufacturer", "model", "location", "type", "line",
                    "status", "criticality", "install_date", "last_maintenance", "specs"]


@query("bronze_json_ingest")
def _bronze_json_ingest(p: Plant) -> DataFrame:
    """Registry exported as pretty-printed JSON arrays, ingested as a multi-line JSON stream."""
    from millrace.streaming import ingest
    spark = p.spark
    base = ingest.fresh_dir(spark, "bronze_json")
    raw = p.bronze_registry().drop("_ingest_ts", "_source_file")
    ingest.land_json_arrays(raw, os.path.join(base, "landing"), rows_per_file=2_000)
    stream = ingest.bronze_stream(spark, os.path.join(base, "landing"), REGISTRY_COLUMNS, "json",
                                  {"multiLine": "true"})
    ingest.run_once(ingest.to_parquet(stream, os.path.join(base, "bronze"), os.path.join(base, "_chk")))
    return spark.read.parquet(os.path.join(base, "bronze")).select(
        "equipment_id", "name", "type", "line", "status", "criticality", "install_date", "last_maintenance", "specs")


@query("bronze_rescue")
def _bronze_rescue(p: Plant) -> DataFrame:
    """Readings lines with a field too many or too few land whole in ``_rescued_data``."""
    from millrace.plans.plant import EVENT_COLS
    from millrace.sources import shape
    from millrace.streaming import ingest
    spark = p.spark
    base = ingest.fresh_dir(spark, "bronze_rescue")
    ev = p.table("events", EVENT_COLS)
    # the shaped frame plus the event id that decides the malformation
    shaped = shape.raw_readings_with_id(ev, p.zone)
    cols = [F.coalesce(F.col(c), F.lit("")) for c in READING_COLUMNS]
    eid = F.col("_event_id")
    line = (F.when(F.pmod(eid, F.lit(89)) == 0, F.concat_ws(",", *cols, F.lit("EXTRA")))
            .when(F.pmod(eid, F.lit(83)) == 0, F.concat_ws(",", *cols[:-1]))
            .otherwise(F.concat_ws(",", *cols)))
    landing = os.path.join(base, "landing")
    ingest.land_text(shaped.select(line.alias("value")), landing)
    stream = ingest.bronze_stream(spark, landing, READING_COLUMNS, "csv", {"header": "false"})
    ingest.run_once(ingest.to_parquet(stream, os.path.join(base, "bronze"), os.path.join(base, "_chk")))
    b = spark.read.parquet(os.path.join(base, "bronze"))
    return b.agg(F.count(F.lit(1)).alias("rows"),
                 F.count(ingest.RESCUE_COL).alias("rescued_rows"),
                 F.count_if(F.col(ingest.RESCUE_COL).endswith(",EXTRA")).cast("bigint").alias("too_many_fields"))


@query("bronze_json_batch")
def _bronze_json_batch(p: Plant) -> DataFrame:
    """Registry exported as pretty-printed JSON arrays, read as a batch: every column STRING."""
    from millrace.streaming import ingest
    landing = ingest.fresh_dir(p.spark, "bronze_json_batch")
    ingest.land_json_arrays(p.bronze_registry().drop("_ingest_ts", "_source_file"), landing, rows_per_file=2_000)
    return ingest.bronze_batch(p.spark, landing, REGISTRY_COLUMNS, "json", {"multiLine": "true"}).select(
        "equipment_id", "name", "type", "line", "status", "criticality", "install_date", "last_maintenance", "specs")


def _stream_lines(p: Plant, kind: str, lines: DataFrame, read) -> DataFrame:
    """Land ``lines``, stream them as text through ``read`` into parquet, and return what was stored."""
    from millrace.streaming import ingest
    base = ingest.fresh_dir(p.spark, kind)
    ingest.land_text(lines, os.path.join(base, "landing"))
    stream = p.spark.readStream.option("recursiveFileLookup", "true").text(os.path.join(base, "landing"))
    ingest.run_once(ingest.to_parquet(read(stream), os.path.join(base, "bronze"), os.path.join(base, "_chk")))
    return p.spark.read.parquet(os.path.join(base, "bronze"))


@query("bronze_rescue_json")
def _bronze_rescue_json(p: Plant) -> DataFrame:
    """Machine records streamed as JSON lines: unknown fields, values of the wrong kind and
    records cut off are rescued by field name."""
    from millrace.sources import rescue
    s = F.col("s_suppkey")
    text = s.cast("string")
    speed = (F.when(F.pmod(s, F.lit(5)) == 1, F.lit('"n/a"'))
             .when(F.pmod(s, F.lit(5)) == 2, F.concat(F.pmod(s, F.lit(900)).cast("string"), F.lit(".5")))
             .otherwise(F.pmod(s, F.lit(900)).cast("string")))
    fields = F.concat_ws(", ", F.concat(F.lit('"equipment_id": "EQ-'), text, F.lit('"')),
                         F.concat(F.lit('"rated_bpm": '), speed),
                         F.when(F.pmod(s, F.lit(7)) == 0, F.concat(F.lit('"vendor_note": "rev '), text, F.lit('"'))),
                         F.when(F.pmod(s, F.lit(9)) == 0, F.concat(F.lit('"geo": {"hall": '), F.pmod(s, F.lit(3)).cast("string"), F.lit("}"))))
    lines = p.table("supplier", ["s_suppkey"]).select(
        F.concat(F.lit("{"), fields, F.when(F.pmod(s, F.lit(13)) == 0, F.lit("")).otherwise(F.lit("}"))).alias("value"))
    schema = StructType().add("equipment_id", "string").add("rated_bpm", "integer")
    return (_stream_lines(p, "rescue_json", lines, lambda df: rescue.json_fields(df, "value", schema))
            .withColumnRenamed(rescue.RESCUED, "rescued"))


@query("bronze_rescue_csv")
def _bronze_rescue_csv(p: Plant) -> DataFrame:
    """Readings streamed as CSV lines with a typed value: rows by the names of their rescued fields."""
    from millrace.plans.plant import EVENT_COLS
    from millrace.sources import rescue, shape
    shaped = shape.raw_readings_with_id(p.table("events", EVENT_COLS), p.zone)
    eid = F.col("_event_id")
    value = F.when(F.pmod(eid, F.lit(71)) == 0, F.lit("over range")).otherwise(F.col("value"))
    cols = [F.coalesce(value if c == "value" else F.col(c), F.lit("")) for c in READING_COLUMNS]
    line = (F.when(F.pmod(eid, F.lit(89)) == 0, F.concat_ws(",", *cols, F.lit("EXTRA")))
            .when(F.pmod(eid, F.lit(83)) == 0, F.concat_ws(",", *cols[:-1]))
            .otherwise(F.concat_ws(",", *cols)))
    schema = StructType()
    for c in READING_COLUMNS:
        schema = schema.add(c, "double" if c == "value" else "string")
    stored = _stream_lines(p, "rescue_csv", shaped.select(line.alias("value")), lambda df: rescue.csv_fields(df, "value", schema))
    names = F.array_join(F.array_sort(F.json_object_keys(rescue.RESCUED)), ";")
    return stored.groupBy(names.alias("rescued_fields")).agg(
        F.count(F.lit(1)).alias("rows"), F.count("value").alias("values_read"), F.count("sensor_tag").alias("tags_read"))


def _stream_silver(p: Plant):
    from millrace.streaming import ingest
    from millrace.streaming.silver_stream import ReadingsBatchWriter
    base = ingest.fresh_dir(p.spark, "silver_stream")
    _stream_drops(p, base, ReadingsBatchWriter(
        p.refs, os.path.join(base, "silver"), os.path.join(base, "quarantine"), p.zone,
        metrics_path=os.path.join(base, "metrics"), late_path=os.path.join(base, "late")))
    return base


@query("stream_silver_readings")
def _stream_silver_readings(p: Plant) -> DataFrame:
    """Readings streamed in three drops through one foreachBatch with two sinks;
    the best row of each key wins across drops."""
    base = _stream_silver(p)
    return (p.spark.read.parquet(os.path.join(base, "silver"))
            .select("reading_ts", "reading_ts_local", "equipment_key", "sensor_tag", "value",
                    "opc_quality_code", "reading_quality_status", "is_good_quality", "line_id"))


def _stream_dedupe_sinks(p: Plant) -> tuple[DataFrame, DataFrame]:
    from millrace.streaming import ingest
    from millrace.streaming.silver_stream import DedupeBatchWriter
    base = ingest.fresh_dir(p.spark, "stream_dedupe")
    silver_path, quarantine_path = os.path.join(base, "silver"), os.path.join(base, "quarantine")
    _stream_drops(p, base, DedupeBatchWriter(p.refs, silver_path, quarantine_path, os.path.join(base, "marks"), p.zone))
    return p.spark.read.parquet(silver_path), p.spark.read.parquet(quarantine_path)


@query("stream_dedupe")
def _stream_dedupe(p: Plant) -> DataFrame:
    """Keys accepted within the 6 h watermark, each once, from a stream of three drops."""
    return _stream_dedupe_sinks(p)[0].select(*silver.READING_KEY)


@query("stream_balance")
def _stream_balance(p: Plant) -> DataFrame:
    """Accepted + quarantined + late + duplicates = input of the deduplicating stream, in one row."""
    accepted, rejected = _stream_dedupe_sinks(p)
    drops = _readings_drops(p)
    counted = [d.agg(F.count(F.lit(1)).alias("input_rows")) for d in drops]
    late = F.col("quarantine_reason") == "LATE_ARRIVAL"
    from millrace.operators.profile import union_all
    total = union_all(counted).agg(F.sum("input_rows").cast("bigint").alias("input_rows"))
    kept = accepted.agg(F.count(F.lit(1)).alias("accepted_rows"))
    out = rejected.agg(F.count_if(~late).cast("bigint").alias("quarantined_rows"), F.count_if(late).cast("bigint").alias("late_rows"))
    duplicates = F.col("input_rows") - F.col("accepted_rows") - F.col("quarantined_rows") - F.col("late_rows")
    return (total.crossJoin(kept).crossJoin(out)   # three one-row aggregates
            .withColumn("duplicate_rows", duplicates).withColumn("balanced", duplicates >= 0))


def _watermark_dedupe(p: Plant) -> tuple[str, str, str]:
    """Landing, output and checkpoint folders of the watermarked stream after three drops."""
    from millrace.streaming import ingest
    from millrace.streaming.silver_stream import dedupe_stream
    base = ingest.fresh_dir(p.spark, "watermark_dedupe")
    landing, out, chk = (os.path.join(base, d) for d in ("landing", "out", "_chk"))
    for k, d in enumerate(_readings_drops(p)):
        ingest.land_csv(d, os.path.join(landing, f"drop_{k}"))
        stream = ingest.bronze_stream(p.spark, landing, READING_COLUMNS, "csv")
        ingest.run_once(ingest.to_parquet(dedupe_stream(stream, p.refs, p.zone), out, chk))
    return landing, out, chk


@query("stream_watermark_dedupe")
def _stream_watermark_dedupe(p: Plant) -> DataFrame:
    """Keys that Spark's own stateful dedupe under a 6 h watermark lets through, from three drops."""
    return p.spark.read.parquet(_watermark_dedupe(p)[1]).select(*silver.READING_KEY)


@query("stream_watermark_balance")
def _stream_watermark_balance(p: Plant) -> DataFrame:
    """What became of every row of the watermarked stream, in one row: rejected by a rule, passed, a copy of what
    passed, or behind the watermark (Spark drops these without a trace, so input is compared with output); and the
    keys that the operator still holds, read back from its state."""
    from millrace.streaming import ingest
    spark = p.spark
    landing, out, chk = _watermark_dedupe(p)
    tagged = silver.readings_tagged(ingest.bronze_batch(spark, landing, READING_COLUMNS, "csv"), p.refs, p.zone)
    passed = spark.read.parquet(out).select(*silver.READING_KEY)
    fate = (tagged.select(*silver.READING_KEY, F.col("quarantine_reason").isNotNull().alias("rejected"))
            .join(passed.withColumn("passed", F.lit(True)), silver.READING_KEY, "left"))
    rows = fate.agg(F.count(F.lit(1)).alias("input_rows"), F.count_if("rejected").cast("bigint").alias("quarantined_rows"),
                    F.count_if(~F.col("rejected") & F.col("passed").isNull()).cast("bigint").alias("late_rows"))
    kept = passed.agg(F.count(F.lit(1)).alias("accepted_rows"))
    held = spark.read.format("statestore").load(chk).agg(F.count(F.lit(1)).alias("state_keys"))
    duplicates = F.col("input_rows") - F.col("quarantined_rows") - F.col("late_rows") - F.col("accepted_rows")
    return rows.crossJoin(kept).crossJoin(held).withColumn("duplicate_rows", duplicates)   # three one-row aggregates


@query("stream_unacked_alarms")
def _stream_unacked_alarms(p: Plant) -> DataFrame:
    """Alarms and acknowledgments as two streams; an alarm comes out once 30 minutes have passed without one.
    A heartbeat in either stream moves the watermark past all alarms; its own stays open."""
    from millrace.streaming import alarm_stream, ingest
    spark = p.spark
    base = ingest.fresh_dir(spark, "unacked_alarms")
    columns = ["alarm_id", "alarm_ts", "equipment_key", "severity_norm", "alarm_state", "line_id"]
    alarms, changes = p.silver_alarms().select(*columns), p.acknowledgments().select("alarm_id", "op", "change_ts")
    lo, hi = alarms.agg(F.min("alarm_ts"), F.max("alarm_ts")).first()
    middle = F.lit(lo) + (F.lit(hi) - F.lit(lo)) / 2 if lo else F.current_timestamp()
    ahead = (F.lit(hi) if hi else F.current_timestamp()) + F.expr("INTERVAL 30 DAY")
    beat = spark.range(1).select(F.lit("HEARTBEAT").alias("alarm_id"), F.lit("UPSERT").alias("op"), ahead.alias("change_ts"), ahead.alias("alarm_ts"))
    drops = [(alarms.filter(F.col("alarm_ts") < middle), changes.filter(F.col("change_ts") < middle)),
             (alarms.filter(F.col("alarm_ts") >= middle), changes.filter(F.col("change_ts") >= middle)),
             (beat.select(*[F.col(c) if c in beat.columns else F.lit(None).cast(alarms.schema[c].dataType).alias(c) for c in columns]),
              beat.select("alarm_id", "op", "change_ts"))]
    out = os.path.join(base, "out")
    for k, sides in enumerate(drops):
        streams = []
        for name, side in zip(("alarms", "changes"), sides):
            folder = os.path.join(base, "landing", name)
            side.write.parquet(os.path.join(folder, f"drop_{k}"))
            streams.append(spark.readStream.schema(side.schema).option("recursiveFileLookup", "true").parquet(folder))
        open_ = alarm_stream.unacknowledged_in_time(*streams)
        ingest.run_once(ingest.to_parquet(open_, out, os.path.join(base, "_chk")))
    return spark.read.parquet(out)


@query("vibration_windows")
def _vibration_windows(p: Plant) -> DataFrame:
    """JSON vibration messages as a stream; sliding 1-minute windows every 10 s.
    A heartbeat after the last message moves the watermark past every window,
    so all of them are emitted; the heartbeat's own stays open."""
    from millrace.streaming import ingest, vibration
    spark = p.spark
    base = ingest.fresh_dir(spark, "vibration")
    landing, out = os.path.join(base, "landing"), os.path.join(base, "out")
    events = p.table("events", ["event_id", "ts", "user_id"])
    spread = vibration.spread_events(events)
    for k, messages in enumerate([vibration.messages_from_events(spread), vibration.heartbeat(events)]):
        ingest.land_text(messages, os.path.join(landing, f"drop_{k}"))
        stream = spark.readStream.schema("value STRING").option("recursiveFileLookup", "true").text(landing)
        stats = vibration.window_stats(vibration.parse_messages(stream), watermark="1 minute")
        ingest.run_once(ingest.to_parquet(stats, out, os.path.join(base, "_chk")))
    return spark.read.parquet(out)


@query("vibration_batch")
def _vibration_batch(p: Plant) -> DataFrame:
    """Sliding 1-minute vibration statistics every 10 s per sensor (batch twin)."""
    from millrace.streaming import vibration
    msgs = vibration.messages_from_events(p.table("events", ["event_id", "ts", "user_id"]))
    return vibration.window_stats(vibration.parse_messages(msgs))


@query("gold_refresh_late")
def _gold_refresh_late(p: Plant) -> DataFrame:
    """OEE kept up to date from a stream of run changes: most runs, one in 50 of them with wrong units; then
    the late runs; then the corrections, each as the old row taken back and the new one.  Every batch adds
    signed sums and refreshes the periods it touched; the result equals a full recompute."""
    from millrace.plans import gold
    from millrace.streaming import deltas, ingest
    spark = p.spark
    base = ingest.fresh_dir(spark, "refresh")
    log = deltas.OeeLog(os.path.join(base, "log"), os.path.join(base, "oee_daily"), p.refs.line_capacity)
    log.add(gold.unplanned_downtime_by_line_day(p.silver_work_orders(), p.refs.equipment_xref), "downtime")
    runs = p.silver_runs().select("run_id", "line_id", "run_status", "start_ts", "end_ts", "start_ts_local", "total_units", "good_units")
    number = F.col("run_id").cast("bigint")
    is_late, is_wrong = F.pmod(number, F.lit(10)) == 0, F.pmod(number, F.lit(50)) == 7
    wrong = runs.filter(is_wrong).withColumn("total_units", F.col("total_units") + 70).withColumn("good_units", F.lit(3).cast(runs.schema["good_units"].dataType))
    plus, minus = F.lit(1).alias(deltas.SIGN), F.lit(-1).alias(deltas.SIGN)
    first = runs.filter(~is_late & ~is_wrong).unionByName(wrong).select("*", plus)
    corrected = wrong.select("*", minus).unionByName(runs.filter(is_wrong).select("*", plus))
    landing = os.path.join(base, "landing")
    for k, drop in enumerate([first, runs.filter(is_late).select("*", plus), corrected]):
        drop.write.parquet(os.path.join(landing, f"drop_{k}"))
        stream = spark.readStream.schema(drop.schema).option("recursiveFileLookup", "true").parquet(landing)
        ingest.run_once(stream.writeStream.foreachBatch(log).option("checkpointLocation", os.path.join(base, "_chk")).trigger(availableNow=True).start())
    from millrace.streaming import refresh
    return refresh.read_mart(spark, log.mart_path)


@query("bronze_all_string")
def _bronze_all_string(p: Plant) -> DataFrame:
    """Maintenance extract landed as CSV and read back with no inference: every column STRING."""
    from millrace.streaming import ingest
    base = ingest.fresh_dir(p.spark, "bronze_batch")
    raw = p.bronze_work_orders().drop("_ingest_ts", "_source_file")
    ingest.land_csv(raw, base)
    return ingest.bronze_batch(p.spark, base, raw.columns, "csv").drop("_ingest_ts", "_source_file", ingest.RESCUE_COL)


# ------------------------------------------------------------------ seeds
@query("seed_load")
def _seed_load(p: Plant) -> DataFrame:
    """Load the crosswalk seeds (declared schema, column checks, key check,
    overwrite), then check every code the extracts carry against the loaded
    tables: per seed, rows loaded, duplicate keys, fact rows checked and
    resolved."""
    from millrace.operators.profile import union_all
    from millrace.sources import seeds
    from millrace.streaming import ingest
    spark = p.spark
    base = ingest.fresh_dir(spark, "seeds")
    seeds.write_seed_files(spark, os.path.join(base, "csv"))
    loaded = seeds.load_seeds(spark, os.path.join(base, "csv"), os.path.join(base, "ref"))
    refs = seeds.read_refs(spark, os.path.join(base, "ref"))
    dups = union_all([seeds.duplicate_keys(refs.table(t), seeds.SEED_KEYS[t]).agg(F.count(F.lit(1)).alias("duplicate_keys"))
                      .select(F.lit(t).alias("table_name"), "duplicate_keys") for t in seeds.SEED_ROWS])
    rd, wo, al, qc, rn = (p.bronze_readings(), p.bronze_work_orders(), p.bronze_alarms(),
                          p.bronze_checks(), p.bronze_runs())
    facts = {
        "equipment_xref": [(rd, "equipment_id", "source_equipment_id"), (al, "equipment_id", "source_equipment_id"),
                           (wo, "asset_number", "sap_asset_number")],
        "line_xref": [(rd, "line_id", "source_line_value"), (al, "line_id", "source_line_value"),
                      (qc, "line_id", "source_line_value"), (rn, "line_id", "source_line_value")],
        "alarm_severity_xref": [(al, "severity", "source_severity")],
        "wo_type_xref": [(wo, "type", "source_type")],
    }
    parts = []
    for table, uses in facts.items():
        for df, col, seed_col in uses:
            keys = F.broadcast(refs.table(table).select(F.col(seed_col).alias("_seed_key")).distinct())
            j = df.select(F.col(col).alias("_code")).join(keys, F.col("_code") == F.col("_seed_key"), "left")
            parts.append(j.agg(F.count(F.lit(1)).alias("n"), F.count("_seed_key").alias("hit"))
                          .select(F.lit(table).alias("table_name"), "n", "hit"))
    cov = (union_all(parts).groupBy("table_name")
           .agg(F.sum("n").cast("bigint").alias("fact_rows_checked"),
                F.sum("hit").cast("bigint").alias("fact_rows_resolved")))
    return loaded.join(dups, "table_name").join(cov, "table_name")


def _stream_versions(p: Plant, kind: str, drops: list[DataFrame], key: str, ts: str, seq: str, tracked: list[str]) -> DataFrame:
    """Change rows land drop by drop and go through ``foreachBatch`` into a type-2 dimension; a drop is a micro-batch."""
    from millrace.streaming import ingest
    from millrace.streaming.scd_stream import Scd2BatchWriter, read_dimension
    spark = p.spark
    base = ingest.fresh_dir(spark, kind)
    landing = os.path.join(base, "landing")
    writer = Scd2BatchWriter(os.path.join(base, "history"), os.path.join(base, "dim"), [key], ts, seq, tracked)
    for k, drop in enumerate(drops):
        drop.write.mode("overwrite").parquet(os.path.join(landing, f"drop_{k}"))
        stream = spark.readStream.schema(drop.schema).option("recursiveFileLookup", "true").parquet(landing)
        ingest.run_once(stream.writeStream.foreachBatch(writer).option("checkpointLocation", os.path.join(base, "_chk"))
                        .trigger(availableNow=True).start())
    return read_dimension(spark, os.path.join(base, "dim"))


@query("stream_scd2")
def _stream_scd2(p: Plant) -> DataFrame:
    """Equipment change feed streamed in three out-of-order drops (each spans the
    whole history) into the SCD2 dimension; equals the batch versions."""
    changes = p.equipment_changes()
    drops = [changes.filter(F.pmod(F.col("change_seq"), F.lit(3)) == (2 - k)) for k in range(3)]
    return _stream_versions(p, "scd_stream", drops, "equipment_key", "change_ts", "change_seq", ["maintenance_class"])


@query("stream_scd2_registry")
def _stream_scd2_registry(p: Plant) -> DataFrame:
    """Registry exports streamed as they come into the SCD2 dimension; equals the batch versions."""
    out = _stream_versions(p, "scd_registry", p.registry_exports(), "equipment_key", "exported_ts", "export_no", REGISTRY_TRACKED)
    return out.select(*REGISTRY_VERSION)


@query("seed_key_check")
def _seed_key_check(p: Plant) -> DataFrame:
    """Primary-key check of each crosswalk, and its consequence on the facts:
    a left join through the crosswalk must not multiply fact rows."""
    from millrace.operators.profile import union_all
    from millrace.sources import seeds
    uses = {
        "equipment_xref": [(p.bronze_readings(), "equipment_id", "source_equipment_id"),
                           (p.bronze_work_orders(), "asset_number", "sap_asset_number")],
        "line_xref": [(p.bronze_readings(), "line_id", "source_line_value"),
                      (p.bronze_checks(), "line_id", "source_line_value")],
        "alarm_severity_xref": [(p.bronze_alarms(), "severity", "source_severity")],
        "wo_type_xref": [(p.bronze_work_orders(), "type", "source_type")],
    }
    parts = []
    for table, facts in uses.items():
        x = p.refs.table(table)
        key = seeds.SEED_KEYS[table]
        dup = seeds.duplicate_keys(x, key).agg(F.count(F.lit(1)).alias("duplicate_keys"))
        n = x.agg(F.count(F.lit(1)).alias("seed_rows"))
        flows = []
        for df, col, seed_col in facts:
            codes = df.select(F.col(col).alias("_code"))
            joined = codes.join(F.broadcast(x.select(F.col(seed_col).alias("_k"))), F.col("_code") == F.col("_k"), "left")
            flows.append(codes.agg(F.count(F.lit(1)).alias("i")).crossJoin(joined.agg(F.count(F.lit(1)).alias("o"))))
        io = union_all(flows).agg(F.sum("i").cast("bigint").alias("fact_rows_in"),
                                  F.sum("o").cast("bigint").alias("fact_rows_out"))
        parts.append(n.crossJoin(dup).crossJoin(io).select(   # three one-row aggregates
            F.lit(table).alias("table_name"), F.lit("; ".join(",".join(k) for k in key)).alias("key_columns"), "seed_rows",
            "duplicate_keys", "fact_rows_in", "fact_rows_out",
            (F.col("fact_rows_out") > F.col("fact_rows_in")).alias("multiplies_facts")))
    return union_all(parts)


@query("stream_expectation_metrics")
def _stream_expectation_metrics(p: Plant) -> DataFrame:
    """Expectation counts recorded per micro-batch by the readings stream,
    summed over batches (equals the batch expectation report)."""
    base = _stream_silver(p)
    m = p.spark.read.parquet(os.path.join(base, "metrics"))
    return (m.groupBy("table_name", "rule", "policy")
             .agg(F.sum("violations").cast("bigint").alias("violations"),
                  F.sum("total_rows").cast("bigint").alias("total_rows")))


def _stream_table(p: Plant, raw: DataFrame, build, rules, table: str, columns: list[str] | None = None) -> DataFrame:
    """An extract landed as CSV and streamed through the generic silver sink."""
    from millrace.streaming import ingest
    from millrace.streaming.silver_stream import TableBatchWriter
    spark = p.spark
    base = ingest.fresh_dir(spark, f"stream_{table}")
    raw = raw.drop("_ingest_ts", "_source_file")
    ingest.land_csv(raw, os.path.join(base, "landing"))
    stream = ingest.bronze_stream(spark, os.path.join(base, "landing"), raw.columns, "csv")
    writer = TableBatchWriter(lambda batch: build(batch, p.refs, p.zone), rules, table,
                              os.path.join(base, "silver"), os.path.join(base, "metrics"))
    ingest.run_once(stream.writeStream.foreachBatch(writer).option("checkpointLocation", os.path.join(base, "_chk"))
                    .trigger(availableNow=True).start())
    out = spark.read.parquet(os.path.join(base, "silver"))
    return out.select(*columns) if columns else out.drop("_ingest_ts", "_source_file", "_batch_id", ingest.RESCUE_COL)


@query("stream_silver_runs")
def _stream_silver_runs(p: Plant) -> DataFrame:
    """Production runs as a stream (fail rules checked inside foreachBatch before any write)."""
    return _stream_table(p, p.bronze_runs(), silver.silver_runs, silver.RUNS_RULES, "production_runs")


@query("stream_silver_work_orders")
def _stream_silver_work_orders(p: Plant) -> DataFrame:
    """Maintenance work orders as a stream; orders of unknown assets are dropped and counted."""
    return _stream_table(p, p.bronze_work_orders(), silver.work_orders_conformed, silver.WORK_ORDER_RULES, "maintenance_logs",
                         silver.SILVER_WORK_ORDER_COLUMNS)


@query("stream_silver_alarms")
def _stream_silver_alarms(p: Plant) -> DataFrame:
    """Alarms as a stream; alarms of unknown severity are dropped and counted."""
    return _stream_table(p, p.bronze_alarms(), silver.alarms_conformed, silver.ALARM_RULES, "alarms_events",
                         silver.SILVER_ALARM_COLUMNS)


@query("stream_silver_quality")
def _stream_silver_quality(p: Plant) -> DataFrame:
    """Quality checks as a stream (an unknown line stops it before any write)."""
    return _stream_table(p, p.bronze_checks(), silver.silver_quality, silver.CHECK_RULES, "quality_checks")
