"""Reference (crosswalk) tables: declared schemas, fixed seed rows and a loader.

Seeds are small, Git-owned tables.  They are read with their *declared*
schema (never inferred per file: ``source_line_value`` and
``source_severity`` hold digits and text), checked for key uniqueness before
anything joins through them (a duplicate key would multiply facts), and
written with a full overwrite.
"""

from __future__ import annotations

import functools
import logging

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (BooleanType, IntegerType, StringType, StructField,
                               StructType)

from millrace.session import path_exists

log = logging.getLogger(__name__)

SEED_SCHEMAS: dict[str, StructType] = {
    "equipment_xref": StructType([
        StructField("equipment_key", StringType(), False),
        StructField("source_equipment_id", StringType(), False),
        StructField("sap_asset_number", StringType(), True),
        StructField("equipment_name", StringType(), True),
        StructField("equipment_type", StringType(), True),
        StructField("line_id", IntegerType(), True),
        StructField("criticality", StringType(), True),
        StructField("is_active", BooleanType(), True),
    ]),
    "line_xref": StructType([
        StructField("source_line_value", StringType(), False),
        StructField("line_id", IntegerType(), False),
    ]),
    "alarm_severity_xref": StructType([
        StructField("source_severity", StringType(), False),
        StructField("severity_norm", StringType(), False),
        StructField("severity_rank", IntegerType(), False),
    ]),
    "wo_type_xref": StructType([
        StructField("source_type", StringType(), False),
        StructField("type_norm", StringType(), False),
        StructField("planning_category", StringType(), False),
    ]),
    "product_sku": StructType([
        StructField("product_sku", StringType(), False),
        StructField("product_name", StringType(), True),
        StructField("category", StringType(), True),
        StructField("unit_size_ml", IntegerType(), True),
    ]),
    "line_manager_assignment": StructType([
        StructField("manager_group", StringType(), False),
        StructField("line_id", IntegerType(), False),
    ]),
}

#: Sets of columns that must each identify a row: the key, and whatever facts are joined on.
SEED_KEYS: dict[str, list[list[str]]] = {
    "equipment_xref": [["equipment_key"], ["source_equipment_id"], ["sap_asset_number"]],
    "line_xref": [["source_line_value"]],
    "alarm_severity_xref": [["source_severity"]],
    "wo_type_xref": [["source_type"]],
    "product_sku": [["product_sku"]],
    "line_manager_assignment": [["manager_group", "line_id"]],
}
#: Crosswalks are broadcast; the loader refuses one with more rows.
MOST_SEED_ROWS = 100_000

# Equipment crosswalk rows (key, SCADA id, SAP asset, name, type,
# line, criticality, active), replaced and inactive machines included.
EQUIPMENT_XREF_ROWS = [
    ("EQP-101", "EQ-101", "A-101", "Line 1 Filler", "Filling Machine", 1, "A", True),
    ("EQP-102", "EQ-102", "A-102", "Line 1 Capper", "Capping Machine", 1, "A", True),
    ("EQP-103", "EQ-103", "A-103", "Line 1 Labeler", "Labeler", 1, "B", True),
    ("EQP-104", "EQ-104", "A-104", "Line 1 Pasteurizer", "Pasteurizer", 1, "A", True),
    ("EQP-105", "EQ-105", "A-105", "Line 1 Conveyor System", "Conveyor", 1, "B", True),
    ("EQP-106", "EQ-106", "A-106", "Line 1 Case Packer", "Case Packer", 1, "B", True),
    ("EQP-107", "EQ-107", "A-107", "Line 1 Palletizer", "Palletizer", 1, "C", True),
    ("EQP-108", "EQ-108", "A-108", "Line 1 Rinser", "Rinser", 1, "B", True),
    ("EQP-109", "EQ-109", "A-109", "CIP Skid 1", "CIP Unit", 1, "A", True),
    ("EQP-201", "EQUIP_201", "A-201", "Line 2 Filler", "Filling Machine", 2, "A", True),
    ("EQP-202", "EQUIP_202", "A-202", "Line 2 Capper", "Capping Machine", 2, "A", True),
    ("EQP-203", "EQUIP_203", "A-203", "Line 2 Labeler", "Labeler", 2, "B", True),
    ("EQP-204", "EQUIP_204", "A-204", "Line 2 Conveyor System", "Conveyor", 2, "B", True),
    ("EQP-205", "EQUIP_205", "A-205", "Line 2 Case Packer", "Case Packer", 2, "B", True),
    ("EQP-206", "EQUIP_206", "A-206", "Line 2 Palletizer", "Palletizer", 2, "C", True),
    ("EQP-207", "EQUIP_207", "A-207", "Line 2 Rinser", "Rinser", 2, "B", True),
    ("EQP-208", "EQUIP_208", "A-208", "CIP Skid 2", "CIP Unit", 2, "A", True),
    ("EQP-301", "301", "A-301", "Line 3 Filler", "Filling Machine", 3, "A", True),
    ("EQP-302", "302", "A-302", "Line 3 Capper", "Capping Machine", 3, "A", True),
    ("EQP-303", "303", "A-303", "Line 3 Labeler", "Labeler", 3, "B", True),
    ("EQP-304", "304", "A-304", "Line 3 Pasteurizer", "Pasteurizer", 3, "A", True),
    ("EQP-305", "305", "A-305", "Line 3 Conveyor System", "Conveyor", 3, "B", True),
    ("EQP-306", "306", "A-306", "Line 3 Case Packer", "Case Packer", 3, "B", True),
    ("EQP-307", "307", "A-307", "Line 3 Palletizer", "Palletizer", 3, "B", True),
    ("EQP-308", "308", "A-308", "Line 3 Rinser", "Rinser", 3, "B", True),
    ("EQP-309", "309", "A-309", "CIP Skid 3", "CIP Unit", 3, "A", True),
    ("EQP-110", "EQ-110", "A-110", "Depalletizer 1", "Depalletizer", 1, "B", False),
    ("EQP-111", "EQ-111", "A-111", "Depalletizer 1 (New)", "Depalletizer", 1, "B", True),
    ("EQP-209", "EQUIP_209", "A-209", "Depalletizer 2", "Depalletizer", 2, "B", True),
    ("EQP-310", "310", "A-310", "Depalletizer 3", "Depalletizer", 3, "B", True),
]

# Every observed line encoding → line id.
LINE_XREF_ROWS = [
    ("1", 1), ("2", 2), ("3", 3),
    ("L1", 1), ("L2", 2), ("L3", 3),
    ("Line 1", 1), ("Line 2", 2), ("Line 3", 3),
    ("Line-1", 1), ("Line-2", 2), ("Line-3", 3),
]

# Alarm severity (numeric and text scale) → normalised name, rank.
ALARM_SEVERITY_XREF_ROWS = [
    ("1", "CRITICAL", 1), ("2", "HIGH", 2), ("3", "MEDIUM", 3), ("4", "LOW", 4),
    ("CRITICAL", "CRITICAL", 1), ("HIGH", "HIGH", 2), ("MEDIUM", "MEDIUM", 3), ("LOW", "LOW", 4),
]

# Work-order type → normalised type, planning category.
WO_TYPE_XREF_ROWS = [
    ("Preventive", "PREVENTIVE", "PLANNED"),
    ("PM", "PREVENTIVE", "PLANNED"),
    ("Corrective", "CORRECTIVE", "UNPLANNED"),
    ("Breakdown", "BREAKDOWN", "UNPLANNED"),
]

# Nameplate bottles-per-minute per line (plant context).
LINE_CAPACITY_ROWS = [(1, 600), (2, 800), (3, 500)]

SEED_ROWS = {
    "equipment_xref": EQUIPMENT_XREF_ROWS,
    "line_xref": LINE_XREF_ROWS,
    "alarm_severity_xref": ALARM_SEVERITY_XREF_ROWS,
    "wo_type_xref": WO_TYPE_XREF_ROWS,
}


class Refs:
    """The crosswalks a pipeline run joins through, built once per session.

    They are tiny, bounded by the plant's asset list, so every join through
    them is a broadcast hash join (no shuffle of the facts).
    """

    def __init__(self, spark: SparkSession, tables: dict[str, DataFrame] | None = None):
        self.spark = spark
        self._tables = dict(tables or {})

    def table(self, name: str) -> DataFrame:
        if name not in self._tables:
            if name == "line_capacity":
                self._tables[name] = self.spark.createDataFrame(
                    LINE_CAPACITY_ROWS, "line_id INT, nameplate_bpm INT")
            else:
                self._tables[name] = self.spark.createDataFrame(
                    SEED_ROWS.get(name, []), SEED_SCHEMAS[name])
        return self._tables[name]

    equipment_xref = property(lambda self: self.table("equipment_xref"))
    line_xref = property(lambda self: self.table("line_xref"))
    alarm_severity_xref = property(lambda self: self.table("alarm_severity_xref"))
    wo_type_xref = property(lambda self: self.table("wo_type_xref"))
    line_capacity = property(lambda self: self.table("line_capacity"))


# --------------------------------------------------------------------------
# Seed files: write, discover, load with checks
# --------------------------------------------------------------------------

def write_seed_files(spark: SparkSession, folder: str, rows: dict[str, list[tuple]] | None = None) -> None:
    """Write each seed as CSV with a header to ``folder/<table>.csv``, on whatever file system that is."""
    for name, data in (rows or SEED_ROWS).items():
        df = spark.createDataFrame(data, SEED_SCHEMAS[name])
        df.coalesce(1).write.mode("overwrite").option("header", True).csv(f"{folder.rstrip('/')}/{name}.csv")


class SeedError(RuntimeError):
    pass


def conform_to_schema(df: DataFrame, target: StructType, table: str) -> DataFrame:
    """``df`` with the columns and types of ``target``; a column too few is an error, one too many is left out."""
    absent = [c for c in target.fieldNames() if c not in df.columns]
    if absent:
        raise SeedError(f"{table}: missing columns {absent}")
    unused = [c for c in df.columns if c not in target.fieldNames()]
    if unused:
        log.warning("%s: dropping extra columns %s", table, unused)
    return df.select(*(F.col(f.name).cast(f.dataType) for f in target))


def duplicate_keys(df: DataFrame, key_sets: list[list[str]]) -> DataFrame:
    """(key_columns, key, n) of every key, of any of the sets, that is NULL or occurs more than once — must be empty."""
    found = None
    for keys in key_sets:
        null = functools.reduce(lambda a, b: a | b, (F.col(k).isNull() for k in keys))
        one = (df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).filter((F.col("n") > 1) | null)
               .select(F.lit(",".join(keys)).alias("key_columns"), F.concat_ws(",", *keys).alias("key"), "n"))
        found = one if found is None else found.union(one)
    return found


def seed_files(spark: SparkSession, folder: str) -> dict[str, str]:
    """Table name → path of every ``<table>.csv`` (a file, or a folder of files) in ``folder``."""
    if not path_exists(spark, folder):
        return {}
    paths = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(folder).select("path")
    names = paths.select(F.regexp_extract("path", r"/([^/]+)\.csv(?:/[^/]*)?$", 1).alias("name")).where("name != ''").distinct()
    return {r["name"]: f"{folder.rstrip('/')}/{r['name']}.csv" for r in names.collect()}


def load_seeds(spark: SparkSession, seed_folder: str, target_folder: str) -> DataFrame:
    """Load every seed file with its declared schema, refuse duplicate keys,
    overwrite ``target_folder/<table>`` and return one row per table:
    (table_name, rows_loaded, status).  A folder without seeds, a seed without
    a declared table, or any seed that fails, is an error (raised after the
    others are loaded)."""
    files = seed_files(spark, seed_folder)
    if not files:
        raise SeedError(f"no seed files in {seed_folder}")
    results, failed = [], []
    for table, path in sorted(files.items()):
        try:
            if table not in SEED_SCHEMAS:
                raise SeedError(f"{table}: no such reference table")
            raw = spark.read.option("header", True).csv(path)   # without inference: all columns are strings
            typed = conform_to_schema(raw, SEED_SCHEMAS[table], table)
            wrong = duplicate_keys(typed, SEED_KEYS[table]).limit(1).collect()
            if wrong:
                raise SeedError(f"{table}: duplicate or NULL {wrong[0]['key_columns']}: {wrong[0]['key']!r}")
            rows = typed.count()
            if rows > MOST_SEED_ROWS:
                raise SeedError(f"{table}: {rows} rows, more than a crosswalk may have ({MOST_SEED_ROWS})")
            typed.write.mode("overwrite").parquet(f"{target_folder.rstrip('/')}/{table}")
            results.append((table, rows, "LOADED"))
        except (SeedError, PySparkException) as exc:   # collected, and raised after the loop
            log.error("seed %s failed: %s", table, exc)
            failed.append(f"{table} ({exc})")
    if failed:
        raise SeedError(f"seeds failed to load: {'; '.join(failed)}")
    return spark.createDataFrame(results, "table_name STRING, rows_loaded BIGINT, status STRING")


def read_refs(spark: SparkSession, target_folder: str) -> Refs:
    """The crosswalks loaded to ``target_folder``; each that a pipeline joins through must be there."""
    tables = {}
    for name, schema in SEED_SCHEMAS.items():
        path = f"{target_folder.rstrip('/')}/{name}"
        if path_exists(spark, path):
            tables[name] = spark.read.schema(schema).parquet(path)
        elif name in SEED_ROWS:
            raise SeedError(f"{name} is not loaded in {target_folder}")
    return Refs(spark, tables)
