"""Landing files and the bronze streams that ingest them.

Bronze is byte-faithful: every column is read as STRING (no inference), a
line that does not fit the schema is kept whole in ``_rescued_data`` rather
than rejected, and each row carries its load time and source file.  Streams
run with ``availableNow`` (one catch-up batch per trigger, the "not
continuous" mode) or a processing-time trigger (always-on mode).
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StringType, StructField, StructType

from millrace.session import scratch_path

RESCUE_COL = "_rescued_data"


def fresh_dir(spark: SparkSession, kind: str) -> str:
    """A new folder under the shared checkpoint folder (never reused)."""
    return scratch_path(spark, kind, uuid.uuid4().hex)


def all_string_schema(columns: list[str], rescue: bool = True) -> StructType:
    fields = [StructField(c, StringType(), True) for c in columns]
    if rescue:
        fields.append(StructField(RESCUE_COL, StringType(), True))
    return StructType(fields)


def land_csv(df: DataFrame, folder: str, header: bool = True) -> str:
    """Write one drop of an extract as gzipped CSV files into ``folder``; a task that writes makes one file."""
    df.write.mode("overwrite").option("header", header).option("compression", "gzip").csv(folder)
    return folder


def land_json_arrays(df: DataFrame, folder: str, rows_per_file: int = 50_000) -> str:
    """Write an extract as pretty JSON *array* files (one array per file), the
    export layout of the registry.  Rows are hashed into ``ceil(n/rows_per_file)``
    groups; each group becomes one array written by one task, so a file's
    size is bounded by ``rows_per_file`` whatever the table size."""
    n = df.count()
    groups = max(1, -(-n // rows_per_file))
    body = F.to_json(F.struct(*df.columns))
    g = df.select(F.pmod(F.xxhash64(*df.columns), F.lit(groups)).alias("_g"), body.alias("_j"))
    arrays = (g.groupBy("_g")
               .agg(F.concat(F.lit("[\n  "), F.array_join(F.sort_array(F.collect_list("_j")), ",\n  "),
                             F.lit("\n]")).alias("value")))
    arrays.repartition("_g").write.mode("overwrite").partitionBy("_g").text(folder)
    return folder


def land_text(lines: DataFrame, folder: str) -> str:
    lines.write.mode("overwrite").text(folder)
    return folder


def bronze_stream(spark: SparkSession, folder: str, columns: list[str], fmt: str = "csv",
                  options: dict | None = None, rescue: bool = True,
                  max_files_per_trigger: int | None = None) -> DataFrame:
    """Streaming all-STRING reader over a landing folder (recursive), with
    rescued data and ingest metadata."""
    reader = (spark.readStream.format(fmt)
              .schema(all_string_schema(columns, rescue))
              .option("recursiveFileLookup", "true")
              .option("mode", "PERMISSIVE"))
    if rescue:
        reader = reader.option("columnNameOfCorruptRecord", RESCUE_COL)
    if fmt == "csv":
        reader = reader.option("header", "true")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    for k, v in (options or {}).items():
        reader = reader.option(k, v)
    return (reader.load(folder)
            .withColumn("_ingest_ts", F.current_timestamp())
            .withColumn("_source_file", F.col("_metadata.file_path")))


def bronze_batch(spark: SparkSession, folder: str, columns: list[str], fmt: str = "csv",
                 options: dict | None = None, rescue: bool = True) -> DataFrame:
    """Batch twin of ``bronze_stream`` (profiling reads)."""
    reader = (spark.read.format(fmt).schema(all_string_schema(columns, rescue))
              .option("recursiveFileLookup", "true").option("mode", "PERMISSIVE"))
    if rescue:
        reader = reader.option("columnNameOfCorruptRecord", RESCUE_COL)
    if fmt == "csv":
        reader = reader.option("header", "true")
    for k, v in (options or {}).items():
        reader = reader.option(k, v)
    return (reader.load(folder)
            .withColumn("_ingest_ts", F.current_timestamp())
            .withColumn("_source_file", F.col("_metadata.file_path")))


def run_once(query: StreamingQuery, timeout_s: float | None = None) -> StreamingQuery:
    """Wait until an ``availableNow`` query has drained its input; errors are raised.

    There is no time limit unless the caller sets one.
    """
    finished = query.awaitTermination() if timeout_s is None else query.awaitTermination(timeout_s)
    if finished is False:
        query.stop()
        raise TimeoutError(f"stream {query.name or query.id} did not finish in {timeout_s}s")
    if query.exception() is not None:
        raise RuntimeError(str(query.exception()))
    return query


def to_parquet(df: DataFrame, path: str, checkpoint: str, available_now: bool = True,
               processing_time: str | None = None, name: str | None = None,
               partition_by: list[str] | None = None) -> StreamingQuery:
    """Append a stream to parquet with a checkpoint (exactly-once per file)."""
    w = df.writeStream.format("parquet").option("checkpointLocation", checkpoint).outputMode("append")
    if partition_by:
        w = w.partitionBy(*partition_by)
    if name:
        w = w.queryName(name)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime=processing_time or "1 minute")
    return w.start(path)
