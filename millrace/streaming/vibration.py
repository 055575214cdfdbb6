"""Vibration stream: JSON messages → magnitude → sliding-window statistics.

The message layout is (sensor_id, timestamp, x_accel, y_accel, z_accel,
temperature).  Statistics are computed from integer-friendly sums
(n, Σm², Σ(m²)²) so batch and stream, and any SQL engine, agree exactly; the
alert rule (ours — the source names the signal, not the rule) is
``max > mean + k·sd`` on the squared magnitude.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType, StructField, StructType

from millrace.functions.parse import round_half_up

MESSAGE_SCHEMA = StructType([
    StructField("sensor_id", StringType()),
    StructField("timestamp", StringType()),
    StructField("x_accel", DoubleType()),
    StructField("y_accel", DoubleType()),
    StructField("z_accel", DoubleType()),
    StructField("temperature", DoubleType()),
])
WINDOW, SLIDE, ALERT_K = "1 minute", "10 seconds", 3.0
#: Windows that start in the same block are merged together; a block spans its panes up to the end of its last window.
BLOCK, BLOCK_SPAN = "120 seconds", "170 seconds"
_WINDOW_US, _SLIDE_US, _BLOCK_US = 60_000_000, 10_000_000, 120_000_000


#: Messages of one burst (four a second), and the sensor name of heartbeats.
BURST, HEARTBEAT = 12, "HEARTBEAT"
#: Events whose bursts are landed as one file (about 40 MB).
EVENTS_A_FILE = 25_000


def spread_events(events: DataFrame) -> DataFrame:
    """Deal events to tasks by their number: as messages they take some hundred times the bytes that scans are split by."""
    return events.repartition(max(1, -(-events.count() // EVENTS_A_FILE)), *events.columns)


def messages_from_events(events: DataFrame) -> DataFrame:
    """Shape vibration messages (JSON text in ``value``) from ``events``: a
    burst for each, which in one event out of five ends with a shock."""
    eid, k = F.col("event_id"), F.col("_k")
    shock = (k == BURST - 1) & (F.pmod(eid, F.lit(5)) == 0)
    at = F.timestamp_millis(F.unix_millis("ts") + k * 250)
    body = F.struct(
        F.concat(F.lit("VIB-"), F.pmod(F.col("user_id"), F.lit(100)).cast("string")).alias("sensor_id"),
        F.date_format(at, "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'").alias("timestamp"),
        F.when(shock, F.lit(60.0)).otherwise((F.pmod(eid, F.lit(17)) - 8).cast("double")).alias("x_accel"),
        (F.pmod(eid, F.lit(13)) - 6).cast("double").alias("y_accel"),
        (F.pmod(eid, F.lit(11)) - 5).cast("double").alias("z_accel"),
        (F.pmod(eid, F.lit(30)) + 20).cast("double").alias("temperature"))
    return events.withColumn("_k", F.explode(F.sequence(F.lit(0), F.lit(BURST - 1)))).select(F.to_json(body).alias("value"))


def heartbeat(events: DataFrame) -> DataFrame:
    """One message an hour after the last: tells a stream that no earlier ones will come."""
    body = F.struct(F.lit(HEARTBEAT).alias("sensor_id"),
                    F.date_format(F.max("ts") + F.expr("INTERVAL 1 HOUR"), "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'").alias("timestamp"),
                    *(F.lit(0.0).alias(c) for c in ("x_accel", "y_accel", "z_accel", "temperature")))
    return events.agg(F.to_json(body).alias("value"))


def parse_messages(df: DataFrame, value_col: str = "value") -> DataFrame:
    """``from_json`` over any frame (Kafka, socket or files) with a text value."""
    m = F.from_json(F.col(value_col).cast("string"), MESSAGE_SCHEMA).alias("m")
    return (df.select(m).select("m.*")
            .withColumn("event_ts", F.try_to_timestamp(F.col("timestamp")))
            .withColumn("m2", F.col("x_accel") * F.col("x_accel") + F.col("y_accel") * F.col("y_accel")
                        + F.col("z_accel") * F.col("z_accel")))


def pane_sums(msgs: DataFrame, watermark: str | None = None) -> DataFrame:
    """n, maximum and sums of each sensor's messages in panes of one slide: what windows are merged from."""
    df = msgs.withWatermark("event_ts", watermark) if watermark else msgs
    return (df.groupBy("sensor_id", F.window("event_ts", SLIDE).alias("pane"))
            .agg(F.count(F.lit(1)).alias("n"), F.max("m2").alias("max_m2"),
                 F.sum("m2").alias("s1"), F.sum(F.col("m2") * F.col("m2")).alias("s2")))


def pane_blocks(panes: DataFrame) -> DataFrame:
    """The panes of each sensor that the windows starting in one block are merged from.  A pane goes to one block or two
    (those of the first 50 seconds also end windows of the block before), not to each of its six windows."""
    pane = F.struct(F.unix_micros(F.col("pane.start")).alias("at"), "n", "max_m2", "s1", "s2")
    return (panes.groupBy("sensor_id", F.window(F.window_time("pane"), BLOCK_SPAN, BLOCK).alias("block"))
            .agg(F.collect_list(pane).alias("panes")))


def block_windows(blocks: DataFrame) -> DataFrame:
    """Start, end, n, maximum and sums of every window of a block that holds a pane; nulls are skipped, as ``sum`` does."""
    first = F.unix_micros(F.col("block.start"))
    starts = F.array_distinct(F.flatten(F.transform("panes", lambda p: F.sequence(
        F.greatest(p["at"] - F.lit(_WINDOW_US - _SLIDE_US), first),
        F.least(p["at"], first + F.lit(_BLOCK_US - _SLIDE_US)), F.lit(_SLIDE_US).cast("long")))))
    none = F.lit(None).cast("double")

    def plus(a: Column, b: Column) -> Column:
        return F.coalesce(a + b, a, b)

    def window(start: Column) -> Column:
        return F.aggregate(
            F.filter("panes", lambda p: (p["at"] >= start) & (p["at"] < start + F.lit(_WINDOW_US))),
            F.struct(F.lit(0).cast("long").alias("n"), none.alias("max_m2"), none.alias("s1"), none.alias("s2")),
            lambda a, p: F.struct((a["n"] + p["n"]).alias("n"), F.greatest(a["max_m2"], p["max_m2"]).alias("max_m2"),
                                  plus(a["s1"], p["s1"]).alias("s1"), plus(a["s2"], p["s2"]).alias("s2")),
            lambda a: F.struct(F.timestamp_micros(start).alias("window_start"), F.timestamp_micros(start + F.lit(_WINDOW_US)).alias("window_end"),
                               a["n"].alias("n"), a["max_m2"].alias("max_m2"), a["s1"].alias("s1"), a["s2"].alias("s2")))

    return blocks.select("sensor_id", F.inline(F.transform(starts, window)))


def window_stats(msgs: DataFrame, k: float = ALERT_K, watermark: str | None = None) -> DataFrame:
    """Statistics of sliding windows, merged from panes: a message meets one aggregate, only panes go on to windows.

    On a table a pane is copied into the windows it is part of.  On a stream every such copy would be a row written to
    and removed from the state, so panes are gathered in blocks instead: two chained aggregations under one watermark,
    whose state is the open panes and blocks.  A block's windows come out together, once the watermark has passed the last.
    """
    panes = pane_sums(msgs, watermark)
    if watermark:
        g = block_windows(pane_blocks(panes))
    else:
        g = (panes.groupBy("sensor_id", F.window(F.window_time("pane"), WINDOW, SLIDE).alias("w"))
             .agg(F.sum("n").alias("n"), F.max("max_m2").alias("max_m2"), F.sum("s1").alias("s1"), F.sum("s2").alias("s2"))
             .withColumns({"window_start": F.col("w.start"), "window_end": F.col("w.end")}))
    n = F.col("n").cast("double")
    mean = F.col("s1") / n
    var = F.greatest((F.col("s2") - (F.col("s1") * F.col("s1")) / n) / F.nullif(n - F.lit(1.0), F.lit(0.0)), F.lit(0.0))
    sd = F.sqrt(var)
    return g.select("sensor_id", "window_start", "window_end", "n", "max_m2", round_half_up(mean, 6).alias("mean_m2"), round_half_up(sd, 6).alias("sd_m2"),
                    F.coalesce(F.col("max_m2") > mean + F.lit(k) * sd, F.lit(False)).alias("alert"))
