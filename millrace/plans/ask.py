"""The plant's pinned business questions as parameterised DataFrame functions."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from millrace.functions.parse import previous_weekday, round_half_up

TUESDAY = 3  # Spark dayofweek numbering, Sunday = 1


def oee_for(oee_daily: DataFrame, lines: list[int] | None = None, on=None,
            weekday: int = TUESDAY) -> DataFrame:
    """OEE of the given lines on a day.  ``on`` defaults to "last <weekday>"
    (previous-cycle rule) relative to the day after the newest production
    date in the mart — the data's own "today"."""
    df = oee_daily if lines is None else oee_daily.filter(F.col("line_id").isin(lines))
    if on is not None:
        day = F.lit(on).cast("date")
        return df.filter(F.col("production_date") == day)
    ref = oee_daily.agg(F.date_add(F.max("production_date"), 1).alias("_today"))
    target = ref.select(previous_weekday(F.col("_today"), weekday).alias("production_date"))
    return df.join(F.broadcast(target), "production_date")  # one-row target


def unplanned_stops_over(reliability: DataFrame, n: int = 3) -> DataFrame:
    """Equipment-months with more than ``n`` unplanned stops."""
    return reliability.filter(F.col("unplanned_stop_count") > n)


def param_scrap_correlation(checks: DataFrame, scrap_daily: DataFrame) -> DataFrame:
    """Correlation of each quality parameter's daily mean with the line-day
    scrap rate, per line, ranked by |corr| (1 = strongest)."""
    daily = (checks.groupBy("line_id", F.to_date("check_ts_local").alias("production_date"), "parameter")
             .agg(F.avg("value").alias("param_mean")))
    j = daily.join(scrap_daily.select("line_id", "production_date", "scrap_rate"),
                   ["line_id", "production_date"])
    c = (j.groupBy("line_id", "parameter")
          .agg(F.count(F.lit(1)).alias("days"),
               round_half_up(F.corr("param_mean", "scrap_rate"), 6).alias("corr")))
    w = Window.partitionBy("line_id").orderBy(F.abs(F.col("corr")).desc_nulls_last(), F.col("parameter"))
    return c.withColumn("corr_rank", F.row_number().over(w))  # ≤ parameters per line


def fill_weight_trend(matched_checks: DataFrame, window_days: int = 7) -> DataFrame:
    """Daily mean check value per SKU and parameter, over checks matched to
    exactly one run (``product_sku`` carried from the matched run), with a
    trailing ``window_days`` moving mean (integer sums over the frame,
    divided once)."""
    m = matched_checks.filter(F.col("match_count") == 1)
    day = (m.groupBy("product_sku", "parameter", F.to_date("check_ts_local").alias("check_date"))
            .agg(F.count(F.lit(1)).alias("checks"),
                 F.sum(F.round(F.col("value") * 100).cast("bigint")).alias("_cents")))
    w = (Window.partitionBy("product_sku", "parameter").orderBy(F.unix_date("check_date"))
         .rangeBetween(-(window_days - 1), 0))
    return (day.withColumn("mean_value", round_half_up(F.col("_cents").cast("double") / (F.col("checks") * 100).cast("double"), 4))
               .withColumn("moving_mean_value", round_half_up(
                   F.sum("_cents").over(w).cast("double") / (F.sum("checks").over(w) * 100).cast("double"), 4))
               .drop("_cents"))


def top_technicians(critical: DataFrame, k: int = 1) -> DataFrame:
    """Technicians with the most critical orders resolved per week (ties kept)."""
    w = Window.partitionBy("resolved_week").orderBy(F.col("critical_work_orders_resolved").desc())
    return critical.withColumn("rank", F.rank().over(w)).filter(F.col("rank") <= k)
