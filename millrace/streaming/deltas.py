"""A mart kept up to date by signed sums.

OEE needs additive measures a (line, day) only.  Every micro-batch of run
changes adds its own sums to a log, one folder a batch: a new run counts +1
times its measures, a correction -1 times the old row and +1 times the new one.
Nothing is read or replaced, so a replayed batch overwrites its own folder and
changes nothing, and a failure loses nothing.

The batch also records the dates it touched.  ``refresh`` takes the periods
from that record and sums the log for these alone; facts are not read again.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.plans import gold
from millrace.streaming.refresh import PERIOD_COL

#: Additive measures of the log; ``run_rows`` tells whether a day has completed runs left.
MEASURES = ["run_rows", "run_minutes", "total_units", "good_units", "unplanned_downtime_min"]
SIGN, UNIT = "_sign", "MM"


def run_sums(changes: DataFrame) -> DataFrame:
    """Signed sums of completed runs by line and day; ``changes`` are silver runs with a column ``_sign`` of 1 or -1."""
    def total(what) -> F.Column:
        return F.sum(F.col(SIGN) * what).cast("bigint")

    return (changes.filter(F.col("run_status") == gold.COMPLETED)
            .groupBy("line_id", F.to_date("start_ts_local").alias("production_date"))
            .agg(F.sum(SIGN).cast("bigint").alias("run_rows"),
                 total(F.expr("timestampdiff(MINUTE, start_ts, end_ts)")).alias("run_minutes"),
                 total(F.coalesce("total_units", F.lit(0))).alias("total_units"), total(F.coalesce("good_units", F.lit(0))).alias("good_units")))


def _log_rows(sums: DataFrame) -> DataFrame:
    zero = F.lit(0).cast("bigint")
    return sums.select("line_id", "production_date", *[F.col(m) if m in sums.columns else zero.alias(m) for m in MEASURES],
                       F.trunc("production_date", UNIT).alias(PERIOD_COL))


class OeeLog:
    """The log of sums below ``path``, and the mart made from it at ``mart_path``."""

    def __init__(self, path: str, mart_path: str, line_capacity: DataFrame):
        self.path, self.mart_path, self.line_capacity = path, mart_path, line_capacity

    def add(self, sums: DataFrame, batch: str) -> None:
        """Write a batch's sums and the dates they touch, each to the batch's own folder."""
        rows = _log_rows(sums)
        (rows.hint("rebalance", PERIOD_COL).write.mode("overwrite").partitionBy(PERIOD_COL)
             .parquet(os.path.join(self.path, "sums", f"_batch={batch}")))
        (rows.select("production_date").distinct().coalesce(1).write.mode("overwrite")
             .parquet(os.path.join(self.path, "dates", f"_batch={batch}")))

    def touched(self, spark: SparkSession, batch: str) -> list:
        """Periods of the dates that a batch recorded; there are twelve a year."""
        dates = spark.read.parquet(os.path.join(self.path, "dates", f"_batch={batch}"))
        return [r[0] for r in dates.select(F.trunc("production_date", UNIT).alias("p")).distinct().orderBy("p").collect()]

    def sums(self, spark: SparkSession, periods: list) -> DataFrame:
        """The measures of some periods, all batches added up; other partitions are not read."""
        log = spark.read.parquet(os.path.join(self.path, "sums")).filter(F.col(PERIOD_COL).isin(periods))
        return log.groupBy(PERIOD_COL, "line_id", "production_date").agg(*[F.sum(m).cast("bigint").alias(m) for m in MEASURES])

    def refresh(self, spark: SparkSession, batch: str) -> None:
        """Rewrite the mart's periods that a batch touched; days without completed runs have no row."""
        periods = self.touched(spark, batch)
        if not periods:
            return
        rows = self.sums(spark, periods).filter(F.col("run_rows") > 0).join(F.broadcast(self.line_capacity), "line_id")
        (gold.oee_factors(rows, PERIOD_COL).hint("rebalance", PERIOD_COL)
             .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(PERIOD_COL).parquet(self.mart_path))

    def __call__(self, changes: DataFrame, batch_id: int) -> None:
        """``foreachBatch``: log a micro-batch of signed run changes, then refresh what it touched."""
        self.add(run_sums(changes), f"runs-{batch_id}")
        self.refresh(changes.sparkSession, f"runs-{batch_id}")
