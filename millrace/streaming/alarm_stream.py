"""Alarms that nobody acknowledged in time, as a stream–stream left outer join.

Both sides carry a watermark and the join a time bound, so Spark can tell when
no acknowledgment may follow: an alarm is held until the watermark has passed
its bound and is then emitted once, or forgotten once acknowledged.  State is
bounded by the alarms of (bound + delay).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: How long an alarm may wait, and how late rows of either side may come.
BOUND, DELAY = "30 minutes", "1 hour"


def unacknowledged_in_time(alarms: DataFrame, changes: DataFrame, bound: str = BOUND, delay: str = DELAY) -> DataFrame:
    """``alarms`` (alarm_id, alarm_ts, ...) without an UPSERT in ``changes`` (alarm_id, op, change_ts) within ``bound``."""
    waiting = alarms.withWatermark("alarm_ts", delay)
    acks = (changes.filter(F.col("op") == "UPSERT").select(F.col("alarm_id").alias("_ack_id"), F.col("change_ts").alias("_ack_ts"))
            .withWatermark("_ack_ts", delay))
    in_time = ((F.col("alarm_id") == F.col("_ack_id")) & (F.col("_ack_ts") >= F.col("alarm_ts"))
               & (F.col("_ack_ts") <= F.col("alarm_ts") + F.expr(f"INTERVAL {bound}")))
    return waiting.join(acks, in_time, "left_outer").filter(F.col("_ack_id").isNull()).drop("_ack_id", "_ack_ts")
