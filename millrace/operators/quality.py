"""Data-quality checks and profiles that return small DataFrames.

All of them are single aggregate passes (partial aggregation per task);
nothing is collected to the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.plans import silver


def _cnt(cond) -> "F.Column":
    return F.count_if(F.coalesce(cond, F.lit(False))).cast("bigint")


def quarantine_balance(tagged: DataFrame, deduped: DataFrame) -> DataFrame:
    """Invariant: accepted + quarantined + duplicates removed = input rows.

    ``tagged`` is the bronze-with-reasons frame, ``deduped`` the silver table
    built from it; the result is one row with the four counts and the check.
    """
    t = tagged.agg(F.count(F.lit(1)).alias("input_rows"),
                   _cnt(F.col("quarantine_reason").isNotNull()).alias("quarantined_rows"),
                   _cnt(F.col("quarantine_reason").isNull()).alias("_accepted_before_dedupe"))
    d = deduped.agg(F.count(F.lit(1)).alias("accepted_rows"))
    return (t.crossJoin(d)  # 1 row × 1 row
            .select("input_rows", "accepted_rows", "quarantined_rows",
                    (F.col("_accepted_before_dedupe") - F.col("accepted_rows")).alias("duplicate_rows"))
            .withColumn("balanced", F.col("input_rows") == F.col("accepted_rows") + F.col("quarantined_rows") + F.col("duplicate_rows")))


def sentinel_profile(bronze: DataFrame) -> DataFrame:
    """Per tag: how many raw values are sentinels, negative vibration,
    empty, non-numeric, and how many the scrub turns into NULL."""
    v = F.col("value").try_cast("double")
    vib = F.col("sensor_tag").rlike("(?i)vib")
    empty = F.col("value").isNull() | (F.trim(F.col("value")) == "")
    return (bronze.groupBy("sensor_tag")
            .agg(F.count(F.lit(1)).alias("raw_rows"),
                 _cnt(v <= -999.0).alias("sentinel_rows"),
                 _cnt(vib & (v < 0) & (v > -999.0)).alias("negative_vibration_rows"),
                 _cnt(empty).alias("empty_rows"),
                 _cnt(~empty & v.isNull()).alias("non_numeric_rows"),
                 _cnt(silver.scrub_value().isNull()).alias("scrubbed_null_rows")))


def quality_gate(readings: DataFrame) -> DataFrame:
    """Only good-quality readings (OPC 192) reach the aggregate: per line,
    equipment, tag and plant-local day, all vs good readings and the average
    good value (summed as integer cents, divided once)."""
    good = F.col("is_good_quality") & F.col("value").isNotNull()
    cents = F.when(good, F.round(F.col("value") * 100).cast("bigint"))
    agg = (readings.groupBy("line_id", "equipment_key", "sensor_tag",
                            F.to_date("reading_ts_local").alias("reading_date"))
           .agg(F.count(F.lit(1)).alias("readings"),
                _cnt(F.col("is_good_quality")).alias("good_readings"),
                _cnt(good).alias("good_values"),
                F.sum(cents).cast("bigint").alias("good_value_cents")))
    avg = F.col("good_value_cents").cast("double") / F.nullif((F.col("good_values") * 100).cast("double"), F.lit(0.0))
    from millrace.functions.parse import round_half_up
    return agg.withColumn("avg_good_value", round_half_up(avg, 4)).drop("good_value_cents")


# Fixed values (ours): plausible physical range per sensor tag.
TAG_RANGE_RULES = [
    ("view", 0.0, 400.0),
    ("click", 0.0, 400.0),
    ("signup", 0.0, 400.0),
    ("purchase", 0.0, 400.0),
    ("line_VIB_error", 0.0, 250.0),
]


def tag_range_check(readings: DataFrame, rules: DataFrame) -> DataFrame:
    """Per-tag physical range rules (broadcast rules table): rows in/out of range."""
    r = F.broadcast(rules.withColumnRenamed("sensor_tag", "_rule_tag"))
    j = readings.join(r, readings["sensor_tag"] == r["_rule_tag"], "left")
    has_rule = F.col("_rule_tag").isNotNull()
    out = has_rule & F.col("value").isNotNull() & ~F.col("value").between(F.col("min_value"), F.col("max_value"))
    return (j.groupBy("sensor_tag")
            .agg(F.count(F.lit(1)).alias("readings"),
                 _cnt(has_rule).alias("with_rule"),
                 _cnt(out).alias("out_of_range")))
