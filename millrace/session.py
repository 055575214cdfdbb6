"""Spark session settings the library relies on.

The library assumes a UTC session clock (every ``to_utc_timestamp`` /
``from_utc_timestamp`` pair is only right there) and ANSI mode (bad casts go
through ``try_*`` functions explicitly).  ``prepare`` is idempotent and is
called by every public entry point, so a session built elsewhere (e.g. by a
driver) is brought to the same settings.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.errors import AnalysisException
from pyspark.sql import SparkSession

_REQUIRED = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # timestamp_ntz columns in the driver's parquet are read as wall clock UTC
    "spark.sql.parquet.inferTimestampNTZ.enabled": "true",
    # Our plans derive many columns through long alias chains (raw text →
    # parsed instant → local date).  Inferred IS NOT NULL constraints on join
    # keys get pushed down through those aliases and re-evaluate the whole
    # parse expression in an extra Filter per row (measured 4x on the OEE
    # mart).  Joins drop NULL keys anyway, so nothing is lost by turning the
    # inference off.
    "spark.sql.constraintPropagation.enabled": "false",
    # streaming dedupe state is watermark-bounded but large (6 h × ~2,000
    # readings/s ≈ 43 M keys): keep it in RocksDB, off the JVM heap
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    # counting the rows of a store takes a read before every write and removal
    "spark.sql.streaming.stateStore.rocksdb.trackTotalNumberOfRows": "false",
}


def prepare(spark: SparkSession) -> SparkSession:
    """Bring a session to the settings the library needs (idempotent)."""
    for key, value in _REQUIRED.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    checkpoint_dir(spark)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """Shared folder for checkpoints and materialised intermediates.

    This is ``spark.checkpoint.dir`` as the session has it: a file system that
    driver and executors share.  Only a session that runs in one process
    (master ``local``, as in tests) gets a scratch folder where the setting is
    absent; on a cluster a missing setting is an error, since a folder of the
    driver's machine would be another one on every executor.
    """
    current = spark.conf.get("spark.checkpoint.dir", None)
    if not current:
        master = spark.conf.get("spark.master", "")
        if not (master == "local" or master.startswith("local[")):
            raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
        current = tempfile.mkdtemp(prefix="millrace-ckpt-")
        spark.conf.set("spark.checkpoint.dir", current)
    return current


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether Spark finds a folder with files at ``path``, on whatever file system it is."""
    try:
        spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    except AnalysisException as error:
        if "PATH_NOT_FOUND" in str(error.getCondition() or error):
            return False
        raise
    return True


def scratch_path(spark: SparkSession, *parts: str) -> str:
    """A sub-folder of the shared checkpoint folder (never machine-local on a cluster)."""
    base = checkpoint_dir(spark)
    return os.path.join(base, *parts)


def build(master: str | None = None, shuffle_partitions: int | None = None,
          app: str = "millrace", extra: dict | None = None) -> SparkSession:
    """Build (or reuse) a session with the library settings."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    builder = builder.config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false")
    builder = builder.config("spark.driver.memory", os.environ.get("MILLRACE_DRIVER_MEMORY", "8g"))
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for key, value in {**_REQUIRED, **(extra or {})}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return prepare(spark)
