"""millrace — plant analytics (bronze → silver → gold) on PySpark.

Everything is DataFrame / Spark SQL / Structured Streaming code; there are
no Python UDFs.  Sub-packages:

* ``sources``   – driver-table readers, raw-extract shaping, bronze ingest, seeds
* ``functions`` – column-level helpers (timestamp/date parsers, rounding, keys)
* ``operators`` – reusable DataFrame operators (conformance joins, expectations,
                  SCD2, interval joins, segmented lag, profiling)
* ``plans``     – the silver tables, gold marts, business questions and the
                  query registry used by ``__spark_entry__``
* ``streaming`` – Structured Streaming jobs (ingest, silver stream, dedupe,
                  vibration windows, late-data refresh)
"""

# Fixed value: the plant's time zone (naked and US-format source times are local to it).
PLANT_TZ = "America/Chicago"
