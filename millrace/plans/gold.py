"""Gold KPI marts: pure functions of silver frames, full recompute.

Every mart is a hash aggregate (partial + final, one shuffle on its grain)
optionally joined to bounded reference tables (broadcast).  Ratios are
computed from integer sums and divided once; ``round_half_up`` makes the
rounding engine-independent.  Divisions are guarded (ANSI mode throws on /0).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.functions.parse import round_half_up
from millrace.operators.sequence import first_by_group, segmented_lag

COMPLETED = "COMPLETED"
UNPLANNED = "UNPLANNED"


def runtime_by_line_day(runs: DataFrame) -> DataFrame:
    return (runs.filter(F.col("run_status") == COMPLETED)
            .groupBy("line_id", F.to_date("start_ts_local").alias("production_date"))
            .agg(F.sum(F.expr("timestampdiff(MINUTE, start_ts, end_ts)")).cast("bigint").alias("run_minutes"),
                 F.sum("total_units").cast("bigint").alias("total_units"),
                 F.sum("good_units").cast("bigint").alias("good_units")))


def unplanned_downtime_by_line_day(work_orders: DataFrame, equipment_xref: DataFrame) -> DataFrame:
    x = equipment_xref.select("equipment_key", "line_id")
    return (work_orders.filter(F.col("planning_category") == UNPLANNED)
            .join(F.broadcast(x), "equipment_key")
            .groupBy("line_id", F.to_date("created_ts_local").alias("production_date"))
            .agg(F.sum("downtime_minutes").cast("bigint").alias("unplanned_downtime_min")))


def oee_factors(sums: DataFrame, *extra: str) -> DataFrame:
    """OEE and its factors from the sums of a line's day, its unplanned downtime and its nameplate rate."""
    run = F.col("run_minutes").cast("double")
    avail = run / F.nullif(run + F.coalesce(F.col("unplanned_downtime_min"), F.lit(0)).cast("double"), F.lit(0.0))
    perf = F.col("total_units").cast("double") / F.nullif(run * F.col("nameplate_bpm"), F.lit(0.0))
    qual = F.col("good_units").cast("double") / F.nullif(F.col("total_units").cast("double"), F.lit(0.0))
    return sums.select(
        *extra, "line_id", "production_date",
        round_half_up(avail, 4).alias("availability"),
        round_half_up(perf, 4).alias("performance"),
        round_half_up(qual, 4).alias("quality"),
        round_half_up(avail * perf * qual, 4).alias("oee"))


def oee_daily(runs: DataFrame, work_orders: DataFrame, equipment_xref: DataFrame,
              line_capacity: DataFrame) -> DataFrame:
    """OEE per line and plant-local production day.

    availability = run / (run + unplanned downtime); performance = units /
    (run minutes × nameplate bpm); quality = good / total; OEE is rounded
    once from the unrounded factors.  Days with downtime but no completed
    run are absent (left join from runtime); lines without a nameplate rate
    drop out (inner join to capacity).
    """
    r = runtime_by_line_day(runs)
    d = unplanned_downtime_by_line_day(work_orders, equipment_xref)
    j = (r.join(d, ["line_id", "production_date"], "left")
          .join(F.broadcast(line_capacity), "line_id"))
    return oee_factors(j)


def equipment_reliability(work_orders: DataFrame, equipment_xref: DataFrame,
                          statuses: list[str] | None = None) -> DataFrame:
    """MTBF (hours between unplanned stops) and MTTR (minutes) per equipment
    and plant-local month.  One stop → NULL MTBF.  ``statuses`` optionally
    restricts the work-order states counted (default: all, as the source)."""
    wo = work_orders.filter(F.col("planning_category") == UNPLANNED)
    if statuses:
        wo = wo.filter(F.col("work_order_status").isin(statuses))
    x = equipment_xref.select("equipment_key", "equipment_name", "line_id")
    n = F.count(F.lit(1))
    return (wo.join(F.broadcast(x), "equipment_key")
            .groupBy("equipment_key", "equipment_name", "line_id",
                     F.trunc("created_ts_local", "MM").alias("stop_month"))
            .agg(n.alias("unplanned_stop_count"),
                 round_half_up(F.timestamp_diff("HOUR", F.min("created_ts"), F.max("created_ts")).cast("double")
                               / F.nullif((n - 1).cast("double"), F.lit(0.0)), 1).alias("mtbf_hours"),
                 round_half_up(F.avg("downtime_minutes"), 1).alias("mttr_minutes")))


def reliability_all_time(reliability: DataFrame) -> DataFrame:
    """All-time unplanned stop count per equipment (sum over months)."""
    return (reliability.groupBy("equipment_key", "equipment_name", "line_id")
            .agg(F.sum("unplanned_stop_count").cast("bigint").alias("unplanned_stop_count_all_time"),
                 F.count(F.lit(1)).alias("months_with_stops")))


def scrap_rate_daily(runs: DataFrame) -> DataFrame:
    return (runs.filter(F.col("run_status") == COMPLETED)
            .groupBy("line_id", F.to_date("start_ts_local").alias("production_date"))
            .agg(F.sum("scrap_units").cast("bigint").alias("scrap_units"),
                 F.sum("total_units").cast("bigint").alias("total_units"))
            .withColumn("scrap_rate", round_half_up(
                F.col("scrap_units").cast("double") / F.nullif(F.col("total_units").cast("double"), F.lit(0.0)), 4)))


def completed_runs_with_previous(runs: DataFrame) -> DataFrame:
    """Completed runs with the previous completed run on the same line
    (ordered by start, run id as tie-break), via month-bucketed windows."""
    done = runs.filter(F.col("run_status") == COMPLETED) \
               .select("run_id", "line_id", "product_sku", "start_ts", "end_ts")
    return segmented_lag(done, ["line_id"], ["start_ts", "run_id"], ["product_sku", "end_ts"],
                         bucket=F.trunc("start_ts", "MM"))


def changeover_time(runs: DataFrame) -> DataFrame:
    """One row per SKU change between consecutive completed runs of a line;
    overlapping-run artefacts (start before the previous end) are dropped."""
    p = completed_runs_with_previous(runs)
    return (p.filter(F.col("prev_product_sku").isNotNull()
                     & (F.col("product_sku") != F.col("prev_product_sku"))
                     & (F.col("start_ts") >= F.col("prev_end_ts")))
            .select("line_id",
                    F.col("prev_product_sku").alias("from_product_sku"),
                    F.col("product_sku").alias("to_product_sku"),
                    F.col("prev_end_ts").alias("changeover_start_ts"),
                    F.col("start_ts").alias("changeover_end_ts"),
                    F.timestamp_diff("MINUTE", F.col("prev_end_ts"), F.col("start_ts")).cast("bigint")
                     .alias("changeover_minutes")))


def first_checks(checks: DataFrame) -> DataFrame:
    """Earliest check per (batch, check type, parameter), check_id as tie-break."""
    return first_by_group(checks, ["batch_id", "check_type", "parameter"], ["check_ts", "check_id"],
                          ["line_id", "check_ts_local", "check_result"])


def first_pass_yield(checks: DataFrame) -> DataFrame:
    """Share of (batch, type, parameter) combinations passing on their first check."""
    passed = F.sum(F.when(F.col("check_result") == "PASS", 1).otherwise(0)).cast("bigint")
    return (first_checks(checks)
            .groupBy("line_id", F.to_date("check_ts_local").alias("check_date"))
            .agg(F.count(F.lit(1)).alias("first_checks_total"), passed.alias("first_checks_passed"))
            .withColumn("first_pass_yield", round_half_up(
                F.col("first_checks_passed").cast("double") / F.nullif(F.col("first_checks_total").cast("double"), F.lit(0.0)), 4)))


def critical_work_orders(work_orders: DataFrame) -> DataFrame:
    """Critical work orders resolved per technician per plant-local week (Monday)."""
    return (work_orders.filter((F.col("priority") == "Critical") & (F.col("work_order_status") == COMPLETED))
            .groupBy("technician", F.date_trunc("week", "completed_ts_local").cast("date").alias("resolved_week"))
            .agg(F.count(F.lit(1)).alias("critical_work_orders_resolved"),
                 round_half_up(F.avg("downtime_minutes"), 1).alias("avg_downtime_minutes")))
