"""One plant = the driver's tables shaped into raw extracts, plus the
bronze → silver → gold builders over them.

Nothing here materialises data: every property returns a lazy DataFrame,
so a query only scans the driver columns its plan needs (column pruning
reaches the parquet reader) and Catalyst sees the whole plan at once.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace import PLANT_TZ
from millrace.plans import gold, silver
from millrace.session import prepare
from millrace.sources import shape
from millrace.sources.seeds import Refs
from millrace.sources.tables import read_table

EVENT_COLS = ["event_id", "ts", "user_id", "event_type", "value"]
ORDER_COLS = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate"]
LINEITEM_WO_COLS = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity",
                    "l_returnflag", "l_linestatus", "l_shipdate"]
LINEITEM_QC_COLS = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity",
                    "l_extendedprice", "l_tax", "l_discount", "l_shipdate"]


class Plant:
    def __init__(self, spark: SparkSession, sf_dir: str, zone: str = PLANT_TZ,
                 refs: Refs | None = None):
        self.spark = prepare(spark)
        self.sf_dir = sf_dir
        self.zone = zone
        self.refs = refs or Refs(spark)

    # ---------------------------------------------------------------- inputs
    def table(self, name: str, columns: list[str] | None = None) -> DataFrame:
        return read_table(self.spark, self.sf_dir, name, columns)

    def _label(self, table: str, extract: str) -> str:
        return f"{os.path.join(self.sf_dir, table)}.parquet#{extract}"

    # ---------------------------------------------------------------- bronze
    def bronze_readings(self) -> DataFrame:
        raw = shape.raw_readings(self.table("events", EVENT_COLS), self.zone)
        return silver.with_ingest_metadata(raw, self._label("events", "sensor_readings"))

    def bronze_runs(self) -> DataFrame:
        raw = shape.raw_runs(self.table("orders", ORDER_COLS), self.zone)
        return silver.with_ingest_metadata(raw, self._label("orders", "production_runs"))

    def bronze_work_orders(self) -> DataFrame:
        raw = shape.raw_work_orders(self.table("lineitem", LINEITEM_WO_COLS), self.zone)
        return silver.with_ingest_metadata(raw, self._label("lineitem", "maintenance_logs"))

    def bronze_checks(self) -> DataFrame:
        raw = shape.raw_checks(self.table("lineitem", LINEITEM_QC_COLS),
                               self.table("part", ["p_partkey", "p_type"]))
        return silver.with_ingest_metadata(raw, self._label("lineitem", "quality_checks"))

    def bronze_alarms(self) -> DataFrame:
        raw = shape.raw_alarms(self.table("events", ["event_id", "ts", "user_id", "event_type"]), self.zone)
        return silver.with_ingest_metadata(raw, self._label("events", "alarms_events"))

    def acknowledgments(self) -> DataFrame:
        return shape.raw_acknowledgments(self.table("events", ["event_id", "ts", "user_id", "event_type"]))

    def bronze_registry(self) -> DataFrame:
        raw = shape.raw_registry(self.table("supplier", ["s_suppkey", "s_nationkey"]))
        return silver.with_ingest_metadata(raw, self._label("supplier", "equipment_registry"))

    def registry_exports(self) -> list[DataFrame]:
        """Three cleaned registry exports, 90 days apart, each a full copy; VARIANT specs as canonical JSON text."""
        supplier = self.table("supplier", ["s_suppkey", "s_nationkey"])
        out = []
        for k in range(3):
            raw = silver.with_ingest_metadata(shape.raw_registry(supplier, k), f"registry_{k}")
            clean = silver.registry_clean(raw, self.refs).drop("_ingest_ts", "_source_file")
            out.append(clean.withColumn("specs", F.to_json("specs"))
                       .withColumn("exported_ts", F.lit("2024-01-01").cast("timestamp") + F.expr(f"INTERVAL {90 * k} DAYS"))
                       .withColumn("export_no", F.lit(k)))
        return out

    def equipment_changes(self) -> DataFrame:
        return shape.raw_equipment_changes(
            self.table("orders", ["o_orderkey", "o_custkey", "o_orderdate", "o_orderpriority"]))

    # ---------------------------------------------------------------- silver
    def silver_readings(self, dedupe: str = "best") -> DataFrame:
        return silver.silver_readings(self.bronze_readings(), self.refs, self.zone, dedupe)

    def quarantine_readings(self) -> DataFrame:
        return silver.quarantine_readings(self.bronze_readings(), self.refs, self.zone)

    def silver_runs(self) -> DataFrame:
        return silver.silver_runs(self.bronze_runs(), self.refs, self.zone)

    def silver_work_orders(self) -> DataFrame:
        return silver.silver_work_orders(self.bronze_work_orders(), self.refs, self.zone)

    def silver_alarms(self) -> DataFrame:
        return silver.silver_alarms(self.bronze_alarms(), self.refs, self.zone)

    def silver_quality(self) -> DataFrame:
        return silver.silver_quality(self.bronze_checks(), self.refs, self.zone)

    # ---------------------------------------------------------------- gold
    def oee_daily(self) -> DataFrame:
        return gold.oee_daily(self.silver_runs(), self.silver_work_orders(),
                              self.refs.equipment_xref, self.refs.line_capacity)

    def equipment_reliability(self) -> DataFrame:
        return gold.equipment_reliability(self.silver_work_orders(), self.refs.equipment_xref)

    def scrap_rate_daily(self) -> DataFrame:
        return gold.scrap_rate_daily(self.silver_runs())

    def changeover_time(self) -> DataFrame:
        return gold.changeover_time(self.silver_runs())

    def first_pass_yield(self) -> DataFrame:
        return gold.first_pass_yield(self.silver_quality())

    def critical_work_orders(self) -> DataFrame:
        return gold.critical_work_orders(self.silver_work_orders())

    def registry_clean(self) -> DataFrame:
        return silver.registry_clean(self.bronze_registry(), self.refs)
