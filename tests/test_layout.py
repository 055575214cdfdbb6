import datetime as dt
import glob
import os

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from millrace.operators import layout
from millrace.plans import silver
from millrace.streaming import ingest, silver_stream

from library_help import rows


def test_interleaved_bits(spark):
    df = spark.range(16).select((F.col("id") / 4).cast("int").alias("a"), (F.col("id") % 4).alias("b"))
    got = {(r["a"], r["b"]): r["z"] for r in df.withColumn("z", layout.interleaved([F.col("a"), F.col("b")], 2)).collect()}
    for (a, b), z in got.items():
        assert z == (a >> 1 & 1) << 3 | (b >> 1 & 1) << 2 | (a & 1) << 1 | (b & 1)
    with pytest.raises(ValueError):
        layout.interleaved([F.lit(0)] * 11, 6)


def test_positions_keep_the_order_and_rows_stay(spark):
    df = spark.createDataFrame([(f"t{n:04d}" if n % 50 else None, n % 7) for n in range(700)] * 2, "tag STRING, v INT")
    p = [r["_position"] for r in layout.positions(df, "tag", 4).orderBy("tag").collect()]
    assert p == sorted(p) and len(set(p)) > 8
    keyed = layout.cluster_key(df, ["tag", "v"], bits=4)
    assert rows(keyed.drop("_cluster")) == rows(df) and keyed.filter("_cluster IS NULL").count() == 0
    assert layout.cluster_key(df.limit(0), ["tag"]).count() == 0


def _met(path, column, value):
    """Row groups whose range of ``column`` holds ``value``, and all of them."""
    met = total = 0
    for f in glob.glob(os.path.join(path, "**", "*.parquet"), recursive=True):
        meta = pq.ParquetFile(f).metadata
        where = [meta.schema.column(i).name for i in range(meta.num_columns)].index(column)
        for g in range(meta.num_row_groups):
            stats = meta.row_group(g).column(where).statistics
            total, met = total + 1, met + (stats.min <= value <= stats.max)
    return met, total


def test_a_filter_on_one_tag_or_equipment_meets_few_row_groups(spark):
    path = ingest.fresh_dir(spark, "test_layout")
    at = F.timestamp_seconds(F.lit(1704067200) + F.col("id") % 86400)     # one day, tags and equipment mixed
    n = 64 * 64 * 20
    new = spark.range(n).select(
        at.alias("reading_ts"), F.format_string("tag_%02d", F.pmod(F.xxhash64("id", F.lit(1)), F.lit(64))).alias("sensor_tag"),
        F.format_string("EQP-%02d", F.pmod(F.xxhash64("id", F.lit(2)), F.lit(64))).alias("equipment_key"),
        F.col("id").cast("double").alias("value"), F.lit(192).alias("opc_quality_code"))
    hadoop = spark._jsc.hadoopConfiguration()
    hadoop.set("parquet.block.row.count.limit", "400")
    try:
        silver_stream.merge_days(new, path)
    finally:
        hadoop.unset("parquet.block.row.count.limit")
    stored = spark.read.parquet(path)
    assert stored.count() == new.select(*silver.READING_KEY).distinct().count()
    assert stored.columns[:5] == new.columns
    for column, value in [("sensor_tag", "tag_17"), ("sensor_tag", "tag_63"), ("equipment_key", "EQP-40")]:
        met, total = _met(path, column, value)
        print(column, value, met, total)
        assert total > 100 and met < (0.1 if column == "sensor_tag" else 0.25) * total
