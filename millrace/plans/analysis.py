"""Analyses the reference designed on top of the marts (interval logic,
alarms, completeness, freshness, scorecard, row-level line scope)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.functions.parse import round_half_up
from millrace.operators.intervals import (covered_minutes, merge_intervals, overlap_pairs,
                                          point_in_intervals)
from millrace.operators import moments
from millrace.operators.scd import latest_by_key
from millrace.plans.gold import COMPLETED, UNPLANNED, completed_runs_with_previous
from millrace.streaming import refresh


def _completed(runs: DataFrame) -> DataFrame:
    """Completed runs.  A run without a parsed end stays in the ordered chain
    (as in the changeover mart) and simply yields no hour buckets in the
    interval joins (``explode`` of a NULL array emits nothing) — no filter on
    the parsed column, which the optimizer would push down to the scan and
    evaluate a second time there."""
    return runs.filter(F.col("run_status") == COMPLETED) \
               .select("run_id", "line_id", "product_sku", "start_ts", "end_ts")


def overlap_adjacent(runs: DataFrame) -> DataFrame:
    """Completed runs starting before the previous completed run of the line ended."""
    done = _completed(runs)
    from millrace.operators.sequence import segmented_lag
    p = segmented_lag(done, ["line_id"], ["start_ts", "run_id"], ["run_id", "end_ts"],
                      bucket=F.trunc("start_ts", "MM"))
    return (p.filter(F.col("start_ts") < F.col("prev_end_ts"))
            .select("line_id", "run_id", "prev_run_id", "start_ts", "prev_end_ts",
                    F.timestamp_diff("MINUTE", F.col("start_ts"), F.col("prev_end_ts")).cast("bigint").alias("overlap_minutes")))


def run_overlap_pairs(runs: DataFrame) -> DataFrame:
    """Every pair of completed runs on one line whose windows overlap."""
    pairs = overlap_pairs(_completed(runs), "line_id", "run_id", "start_ts", "end_ts", "hour")
    return pairs.withColumn("overlap_minutes",
                            F.timestamp_diff("MINUTE", F.col("overlap_start"), F.col("overlap_end")).cast("bigint"))


def unplanned_downtime_intervals(work_orders: DataFrame, equipment_xref: DataFrame) -> DataFrame:
    x = equipment_xref.select("equipment_key", "line_id")
    return (work_orders.filter((F.col("planning_category") == UNPLANNED) & (F.col("downtime_minutes") > 0))
            .join(F.broadcast(x), "equipment_key")
            .select("line_id", F.col("created_ts").alias("start_ts"),
                    (F.col("created_ts") + F.make_dt_interval(mins=F.col("downtime_minutes"))).alias("end_ts")))


def changeover_net(runs: DataFrame, work_orders: DataFrame, equipment_xref: DataFrame) -> DataFrame:
    """Changeover gaps minus the unplanned downtime overlapping them;
    overlapping downtimes are merged first so no minute is subtracted twice."""
    p = completed_runs_with_previous(runs)
    co = (p.filter(F.col("prev_product_sku").isNotNull()
                   & (F.col("product_sku") != F.col("prev_product_sku"))
                   & (F.col("start_ts") >= F.col("prev_end_ts")))
           .select("line_id", "run_id",
                   F.col("prev_product_sku").alias("from_product_sku"),
                   F.col("product_sku").alias("to_product_sku"),
                   F.col("prev_end_ts").alias("changeover_start_ts"),
                   F.col("start_ts").alias("changeover_end_ts"),
                   F.timestamp_diff("MINUTE", F.col("prev_end_ts"), F.col("start_ts")).cast("bigint").alias("changeover_minutes")))
    islands = merge_intervals(unplanned_downtime_intervals(work_orders, equipment_xref), "line_id")
    out = covered_minutes(co, islands, "line_id", ["line_id", "run_id"],
                          "changeover_start_ts", "changeover_end_ts")
    return (out.withColumnRenamed("covered_minutes", "downtime_overlap_minutes")
               .withColumn("net_changeover_minutes", F.col("changeover_minutes") - F.col("downtime_overlap_minutes")))


def batch_to_run(checks: DataFrame, runs: DataFrame, carry: list[str] | None = None,
                 run_carry: list[str] | None = None) -> DataFrame:
    """Each quality check → the completed run of its line whose window holds
    its time; ``match_count`` shows ambiguity (0, 1 or several runs).
    ``carry`` lists extra check columns to keep, ``run_carry`` columns of the
    matched run (NULL unless the match is unique)."""
    pts = checks.select("check_id", "batch_id", "line_id", "check_ts", *(carry or []))
    return point_in_intervals(pts, _completed(runs), "line_id", "check_ts", "run_id",
                              "start_ts", "end_ts", "hour", iv_carry=run_carry)


def alarm_summary(alarms: DataFrame, zone: str) -> DataFrame:
    """Per line, plant-local day and severity: alarms, unacknowledged, total
    duration and mean acknowledgment delay."""
    delay = F.timestamp_diff("SECOND", F.col("alarm_ts"), F.col("acknowledged_ts"))
    return (alarms.groupBy("line_id", F.to_date(F.from_utc_timestamp("alarm_ts", zone)).alias("alarm_date"),
                           "severity_norm", "severity_rank")
            .agg(F.count(F.lit(1)).alias("alarms"),
                 F.count_if(F.col("acknowledged_ts").isNull()).cast("bigint").alias("unacknowledged"),
                 F.sum("duration_seconds").cast("bigint").alias("total_duration_seconds"),
                 round_half_up(F.sum(delay).cast("double") / F.nullif(F.count(delay).cast("double"), F.lit(0.0)), 1)
                  .alias("avg_ack_delay_seconds")))


def current_acknowledgments(acks: DataFrame) -> DataFrame:
    return latest_by_key(acks, ["alarm_id"], "change_seq")


def unacknowledged_alarms(alarms: DataFrame, acks: DataFrame) -> DataFrame:
    """Alarms without a current acknowledgment (never acked, or the ack was deleted)."""
    cur = current_acknowledgments(acks).select("alarm_id")
    return alarms.join(cur, "alarm_id", "left_anti").select(
        "alarm_id", "alarm_ts", "equipment_key", "severity_norm", "alarm_state", "line_id")


def tag_completeness(readings: DataFrame) -> DataFrame:
    """Per line and hour: tags reporting vs tags the line is known to have.

    Every line has a row for every hour between the first and the last reading
    of the plant, so an hour in which a line is silent shows as 0.  Copies of
    a reading don't matter to distinct tags: no dedupe is needed.
    """
    hour = F.date_trunc("hour", "reading_ts")
    reporting = readings.groupBy("line_id", hour.alias("hour_start")).agg(F.collect_set("sensor_tag").alias("tags"))
    expected = reporting.groupBy("line_id").agg(F.size(F.array_distinct(F.flatten(F.collect_set("tags")))).cast("bigint").alias("tags_expected"))
    span = reporting.agg(F.min("hour_start").alias("first"), F.max("hour_start").alias("last"))
    hours = expected.crossJoin(span).withColumn(   # one row with the plant's span
        "hour_start", F.explode(F.sequence("first", "last", F.expr("INTERVAL 1 HOUR")))).drop("first", "last")
    filled = hours.join(reporting, ["line_id", "hour_start"], "left").withColumn(
        "tags_reporting", F.when(F.col("tags").isNull(), 0).otherwise(F.size("tags")).cast("bigint"))
    return filled.select("line_id", "hour_start", "tags_reporting", "tags_expected", round_half_up(
        F.col("tags_reporting").cast("double") / F.col("tags_expected").cast("double"), 4).alias("completeness"))


def ingest_lag(latest: dict[str, DataFrame], as_of=None) -> DataFrame:
    """Per source: newest event time and lag in minutes behind ``as_of``
    (default: the newest event over all sources)."""
    parts = [df.agg(F.max(df.columns[0]).alias("max_event_ts")).select(F.lit(name).alias("source"), "max_event_ts")
             for name, df in latest.items()]
    u = parts[0]
    for p in parts[1:]:
        u = u.unionByName(p)
    ref = (u.agg(F.max("max_event_ts").alias("as_of_ts")) if as_of is None
           else u.sparkSession.range(1).select(F.lit(as_of).cast("timestamp").alias("as_of_ts")))
    return (u.crossJoin(F.broadcast(ref))  # ref is one row
            .withColumn("lag_minutes", F.timestamp_diff("MINUTE", F.col("max_event_ts"), F.col("as_of_ts")).cast("bigint")))


# KPI targets from the plant context (kpi, comparison, target).
KPI_TARGETS = [
    ("oee", ">", 0.85),
    ("scrap_rate", "<", 0.02),
    ("mtbf_hours", ">", 72.0),
    ("mttr_minutes", "<", 45.0),
    ("first_pass_yield", ">", 0.98),
    ("changeover_minutes", "<", 30.0),
]


def kpi_scorecard(marts: dict[str, DataFrame]) -> DataFrame:
    """Per KPI: rows with a value, rows meeting the target and their share.
    KPIs read from the same mart frame are counted in one aggregate pass."""
    by_frame: dict[int, tuple[DataFrame, list]] = {}
    for kpi, op, target in KPI_TARGETS:
        by_frame.setdefault(id(marts[kpi]), (marts[kpi], []))[1].append((kpi, op, target))
    parts = []
    for df, kpis in by_frame.values():
        aggs = []
        for kpi, op, target in kpis:
            v = F.col(kpi).cast("double")
            meets = v > F.lit(target) if op == ">" else v < F.lit(target)
            aggs += [F.count(v).alias(f"{kpi}__n"), F.count_if(meets).cast("bigint").alias(f"{kpi}__m")]
        rows = F.array(*[F.struct(F.lit(k).alias("kpi"), F.lit(o).alias("comparison"),
                                  F.lit(t).alias("target"), F.col(f"{k}__n").alias("rows_evaluated"),
                                  F.col(f"{k}__m").alias("rows_meeting")) for k, o, t in kpis])
        parts.append(df.agg(*aggs).select(F.inline(rows)))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.withColumn("share_meeting", round_half_up(
        F.col("rows_meeting").cast("double") / F.nullif(F.col("rows_evaluated").cast("double"), F.lit(0.0)), 4))


# Fixed values (ours): manager groups and the lines they may see; the
# plant-wide group is assigned every line.
LINE_ASSIGNMENTS = [("line1_managers", 1), ("line2_managers", 2), ("line3_managers", 3),
                    ("plant_managers", 1), ("plant_managers", 2), ("plant_managers", 3)]


def line_scope(mart: DataFrame, assignments: DataFrame, group: str | None = None) -> DataFrame:
    """Row-level scope: the rows of ``mart`` each manager group may see
    (one group, or every group when ``group`` is None).  The assignment table
    is bounded by groups × lines and broadcast."""
    a = assignments if group is None else assignments.filter(F.col("manager_group") == group)
    return mart.join(F.broadcast(a), "line_id")


def store_check_moments(checks: DataFrame, scrap_daily: DataFrame, path: str) -> None:
    """Co-moments of check values and their line-day's scrap rate, one row for
    each (line, parameter, day), stored by month."""
    dated = checks.select("line_id", "parameter", "value", F.to_date("check_ts_local").alias("production_date"))
    pairs = dated.join(scrap_daily.select("line_id", "production_date", "scrap_rate"), ["line_id", "production_date"])
    daily = moments.co_moments(pairs, ["line_id", "parameter", "production_date"], "value", "scrap_rate")
    refresh.write_mart(daily, path, "production_date")


def check_moments(spark, path: str, lo: str | None = None, hi: str | None = None) -> DataFrame:
    """Stored daily co-moments from ``lo`` to ``hi``; only the months of that range are read."""
    daily = spark.read.parquet(path)
    for bound, inside in [(lo, lambda c, b: c >= b), (hi, lambda c, b: c <= b)]:
        if bound is not None:
            day = F.lit(bound).cast("date")
            daily = daily.filter(inside(F.col(refresh.PERIOD_COL), F.trunc(day, "MM")) & inside(F.col("production_date"), day))
    return daily.drop(refresh.PERIOD_COL)


def check_scrap_corr(spark, path: str, lo: str | None = None, hi: str | None = None) -> DataFrame:
    """Correlation of check values with scrap rate per line and parameter, from stored co-moments of ``lo`` to ``hi``."""
    merged = moments.merge(check_moments(spark, path, lo, hi), ["line_id", "parameter"])
    return merged.select("line_id", "parameter", F.col("n").alias("checks"), moments.correlation().alias("corr"))
