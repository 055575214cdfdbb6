"""Silver readings as a stream.

Three forms:

* ``dedupe_stream`` — the source pipeline's operator: event-time watermark
  (6 h) and ``dropDuplicates`` on (reading_ts, equipment_key, sensor_tag), with
  state bounded by the watermark.  Spark drops rows behind the watermark, so
  it fits sources whose rows arrive in order of time.
* ``DedupeBatchWriter`` — the same rule with nothing lost: a ``foreachBatch``
  that compares each row with the high-water mark of the earlier batches.
  Rows more than 6 h behind it go to the quarantine as ``LATE_ARRIVAL``; the
  others are accepted once for each key.
* ``ReadingsBatchWriter`` — one ``foreachBatch`` with two sinks: the quarantine
  (with reason codes) and silver.  A late row is merged, and its date reported
  for recompute.  The days that a batch touches are rewritten with the best row
  of each key out of the stored and the new ones, so the result is that of the
  batch pipeline whatever the order and size of the micro-batches, and a
  replayed batch changes nothing.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace import PLANT_TZ
from millrace.operators import expect, layout
from millrace.plans import silver
from millrace.session import path_exists
from millrace.sources.seeds import Refs

# Fixed value: event-time watermark sized for historian store-and-forward.
WATERMARK = "6 hours"
DATE_PART = "_reading_date"   # UTC date of reading_ts, the silver sink's partition column
CLUSTERED = ["sensor_tag", "equipment_key"]   # interleaved order of the rows of a file, then their time
CLUSTER_KEY = "_cluster"


def dedupe_stream(bronze_stream: DataFrame, refs: Refs, zone: str = PLANT_TZ,
                  watermark: str = WATERMARK) -> DataFrame:
    tagged = silver.readings_tagged(bronze_stream, refs, zone)
    accepted = tagged.filter(F.col("quarantine_reason").isNull())
    return (accepted.withWatermark("reading_ts", watermark)
            .dropDuplicates(silver.READING_KEY)
            .select(*silver.READING_KEY, "value", F.col("quality").try_cast("int").alias("opc_quality_code"),
                    "line_id", "_ingest_ts", "_source_file"))


# Fixed value: reason code of rows that arrive behind the watermark.
LATE_ARRIVAL = "LATE_ARRIVAL"


def high_water_mark(spark: SparkSession, path: str, batch_id: int):
    """Largest event time of the batches before ``batch_id`` (one stored row for each), or None."""
    if not path_exists(spark, path):
        return None
    return spark.read.parquet(path).filter(F.col("_batch_id") < batch_id).agg(F.max("hwm")).first()[0]


def store_high_water_mark(accepted: DataFrame, path: str, batch_id: int) -> None:
    (accepted.agg(F.max("reading_ts").alias("hwm")).write.mode("overwrite")
             .parquet(os.path.join(path, f"_batch_id={batch_id}")))


def is_late(mark, lateness: str) -> F.Column:
    if mark is None:
        return F.lit(False)
    return F.col("reading_ts") < F.lit(mark) - F.expr(f"INTERVAL {lateness}")


def merge_days(new: DataFrame, path: str) -> None:
    """Rewrite the days of ``new`` in the readings at ``path`` with the best row of each key, stored or new.

    Only the folders of those days are read and replaced; a replay finds its
    own rows there and changes nothing.
    """
    spark = new.sparkSession
    new = new.withColumn(DATE_PART, F.to_date("reading_ts"))
    if path_exists(spark, path):
        days = new.select(DATE_PART).distinct()
        stored = spark.read.schema(new.schema).parquet(path).join(days, DATE_PART, "left_semi")
        new = new.unionByName(stored)
    best = layout.cluster_key(silver.dedupe_best(new), CLUSTERED, CLUSTER_KEY)
    # a day's rows go to few files, and a large day to several tasks; each file is in clustered order,
    # so a filter on a tag or an equipment skips most row groups
    (best.hint("rebalance", DATE_PART)
         .sortWithinPartitions(DATE_PART, CLUSTER_KEY, *CLUSTERED, "reading_ts").drop(CLUSTER_KEY)
         .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy(DATE_PART).parquet(path))


class DedupeBatchWriter:
    """``foreachBatch`` callable: each key once within the watermark, rows behind it to the quarantine."""

    def __init__(self, refs: Refs, silver_path: str, quarantine_path: str, marks_path: str,
                 zone: str = PLANT_TZ, lateness: str = WATERMARK):
        self.refs, self.zone, self.lateness = refs, zone, lateness
        self.silver_path, self.quarantine_path, self.marks_path = silver_path, quarantine_path, marks_path

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        mark = high_water_mark(spark, self.marks_path, batch_id)
        tagged = silver.readings_tagged(batch, self.refs, self.zone).persist()
        try:
            accepted = tagged.filter(F.col("quarantine_reason").isNull())
            store_high_water_mark(accepted, self.marks_path, batch_id)
            reason = F.coalesce("quarantine_reason", F.when(is_late(mark, self.lateness), F.lit(LATE_ARRIVAL)))
            (tagged.withColumn("quarantine_reason", reason).filter(F.col("quarantine_reason").isNotNull())
                   .select("timestamp", "equipment_id", "sensor_tag", "reading_ts", "equipment_key", "quarantine_reason")
                   .write.mode("overwrite").parquet(os.path.join(self.quarantine_path, f"_batch_id={batch_id}")))
            on_time = accepted.filter(~is_late(mark, self.lateness))
            merge_days(silver._reading_projection(on_time, self.zone), self.silver_path)
        finally:
            tagged.unpersist()


class ReadingsBatchWriter:
    """``foreachBatch`` callable writing silver + quarantine for each micro-batch."""

    def __init__(self, refs: Refs, silver_path: str, quarantine_path: str, zone: str = PLANT_TZ,
                 metrics_path: str | None = None, late_path: str | None = None,
                 lateness: str = WATERMARK):
        self.refs = refs
        self.silver_path = silver_path
        self.quarantine_path = quarantine_path
        self.zone = zone
        self.metrics_path = metrics_path
        self.late_path = late_path
        self.lateness = lateness

    def _record_late(self, spark, accepted: DataFrame, batch_id: int) -> None:
        """Dates of rows arriving more than ``lateness`` behind the high-water
        mark of earlier batches: the marts to recompute for them (see
        ``streaming.refresh``)."""
        marks = os.path.join(self.late_path, "hwm")
        mark = high_water_mark(spark, marks, batch_id)
        store_high_water_mark(accepted, marks, batch_id)
        (accepted.filter(is_late(mark, self.lateness))
             .groupBy(F.to_date(F.from_utc_timestamp("reading_ts", self.zone)).alias("reading_date"))
             .agg(F.count(F.lit(1)).alias("late_rows"))
             .write.mode("overwrite").parquet(os.path.join(self.late_path, "dates", f"_batch_id={batch_id}")))

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        tagged = silver.readings_tagged(batch, self.refs, self.zone).persist()
        try:
            # the quarantine write sees every row and counts the rules on its way
            watched, counts = expect.observe(tagged, silver.READINGS_RULES, "sensor_readings")
            (watched.filter(F.col("quarantine_reason").isNotNull())
                   .select("timestamp", "equipment_id", "sensor_tag", F.col("raw_value").alias("value"),
                           "quality", "status", F.col("raw_line_id").alias("line_id"), "_ingest_ts",
                           "_source_file", "reading_ts", "equipment_key", "quarantine_reason")
                   .write.mode("overwrite").parquet(os.path.join(self.quarantine_path, f"_batch_id={batch_id}")))
            if self.metrics_path:
                write_metrics(spark, counts, silver.READINGS_RULES, "sensor_readings", self.metrics_path, batch_id)
            accepted = tagged.filter(F.col("quarantine_reason").isNull())
            if self.late_path:
                self._record_late(spark, accepted, batch_id)
            merge_days(silver._reading_projection(accepted, self.zone), self.silver_path)
        finally:
            tagged.unpersist()


def silver_stream(bronze_stream: DataFrame, writer: ReadingsBatchWriter, checkpoint: str,
                  available_now: bool = True, processing_time: str = "1 minute"):
    w = bronze_stream.writeStream.foreachBatch(writer).option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime=processing_time)
    return w.start()


def write_metrics(spark: SparkSession, counts, rules, table: str, metrics_path: str, batch_id: int) -> None:
    """Expectation counts of a batch (the pipeline's event log) from the counters of its write, one
    folder per batch id.  A replayed batch overwrites its own counts, so nothing is counted twice."""
    (expect.observed_report(spark, counts, rules, table).withColumn("batch_id", F.lit(batch_id).cast("bigint"))
        .write.mode("overwrite").parquet(os.path.join(metrics_path, f"_batch_id={batch_id}")))


class TableBatchWriter:
    """Generic silver sink for ``foreachBatch``: build the silver frame from
    the micro-batch, abort *before any write* if a ``fail`` rule is violated,
    drop ``drop``-rule violators and write the batch to its own folder
    (idempotent on replay).  The write itself counts the violations; only a
    table with ``fail`` rules takes a pass before it."""

    def __init__(self, build, rules, table: str, path: str, metrics_path: str):
        self.build, self.rules, self.table = build, rules, table
        self.path, self.metrics_path = path, metrics_path

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        df = self.build(batch)
        twice = any(r.policy == "fail" for r in self.rules)
        if twice:
            df = df.persist()
        try:
            expect.enforce(df, self.rules, self.table)
            watched, counts = expect.observe(df, self.rules, self.table)
            (expect.apply(watched, self.rules).write.mode("overwrite")
                   .parquet(os.path.join(self.path, f"_batch_id={batch_id}")))
            write_metrics(batch.sparkSession, counts, self.rules, self.table, self.metrics_path, batch_id)
        finally:
            if twice:
                df.unpersist()
