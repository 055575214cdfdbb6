"""Readers for the driver's parquet tables.

Each reader selects only the columns it is asked for, so Catalyst prunes the
parquet scan (``ReadSchema`` holds just those columns) and pushes any later
filter into the scan.  ``timestamp_ntz`` columns are cast to ``timestamp``
(wall clock taken as UTC) so the rest of the library works on instants.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import TimestampNTZType

from millrace.session import prepare


def table_path(sf_dir: str, name: str) -> str:
    return os.path.join(sf_dir, f"{name}.parquet")


def read_table(spark: SparkSession, sf_dir: str, name: str, columns: list[str] | None = None,
               spread: int | None = None) -> DataFrame:
    """Column-pruned scan of a driver table.

    The plan does not depend on the table's size or on the number of cores.  A
    caller whose files cannot be split may ask for the rows to be dealt out
    over ``spread`` partitions.
    """
    prepare(spark)
    df = spark.read.parquet(table_path(sf_dir, name))
    if columns:
        df = df.select(*columns)
    if spread:
        df = df.repartition(spread)
    casts = {f.name: F.col(f.name).cast("timestamp")
             for f in df.schema.fields if isinstance(f.dataType, TimestampNTZType)}
    return df.withColumns(casts) if casts else df
