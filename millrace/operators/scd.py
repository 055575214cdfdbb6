"""Slowly changing dimensions and change feeds.

* ``scd2``          – type-2 versions from an ordered change feed
* ``asof_join``     – attach to each fact the version valid at its time
* ``latest_by_key`` – type-1 twin: latest state per key, deletes honoured

None of them puts a whole key in one task: the ordered steps run over
(key, time bucket) windows with a carried boundary row (``segmented_lag``),
the as-of join carries the last version over (key, bucket), and the latest state is a ``max_by`` aggregate that is
combined map-side.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from millrace.operators.sequence import segmented_lag, segmented_lead


def scd2(changes: DataFrame, keys: list[str], ts_col: str, seq_col: str, tracked: list[str],
         bucket_unit: str = "month") -> DataFrame:
    """Versions of ``tracked`` per key: a new version starts when any tracked
    value differs (NULL-safe) from the previous change; ``valid_to`` is the
    next version's start (NULL for the current one).  Re-delivering the same
    change (same tracked values) does not open a version."""
    bucket = F.date_trunc(bucket_unit, F.col(ts_col))
    base = changes.select(*keys, ts_col, seq_col, *tracked).withColumn("_has", F.lit(True))
    lagged = segmented_lag(base, keys, [ts_col, seq_col], ["_has", *tracked], bucket)
    same = F.lit(True)
    for c in tracked:
        same = same & F.col(c).eqNullSafe(F.col(f"prev_{c}"))
    starts = lagged.filter(F.col("prev__has").isNull() | ~same) \
                   .select(*keys, ts_col, seq_col, *tracked)
    versions = segmented_lead(starts, keys, [ts_col, seq_col], [ts_col], bucket)
    return versions.select(*keys, *tracked,
                           F.col(ts_col).alias("valid_from"),
                           F.col(f"next_{ts_col}").alias("valid_to"),
                           F.col(seq_col).alias("version_seq"),
                           F.col(f"next_{ts_col}").isNull().alias("is_current"))


def asof_join(facts: DataFrame, versions: DataFrame, keys: list[str], fact_ts: str,
              columns: list[str], unit: str = "month") -> DataFrame:
    """Left join each fact to the version with valid_from <= ts < valid_to
    (open end = current).

    Facts and versions form one ordered sweep over (key, time bucket): every
    row takes the last version seen before it.  A fact that has none in its
    bucket takes the last one of an earlier bucket, from a table of one row
    for each (key, bucket) that holds facts.  No version is repeated for the
    buckets it covers, and facts are shuffled once.  ``unit`` should be small
    enough for one key's facts of one bucket to fit a task.

    Versions of a key should not overlap; where they do, the latest start
    decides.  Gaps between versions are kept (a fact there has none).  Facts
    without a key or a time have no version; they are spread by their content,
    so that many of them do not meet in one task.
    """
    at = F.col("_at")
    lost = F.col("_at").isNull()
    for k in keys:
        lost = lost | F.col(k).isNull()
    spread = [c for c, t in facts.dtypes if not t.startswith(("map", "variant", "struct", "array"))]
    # never the start of a bucket, so it meets no row of the table of carried versions
    apart = F.timestamp_micros(F.pmod(F.xxhash64(*[F.col(f"_fact.{c}") for c in spread]), F.lit(4096)) + 1)
    fact = facts.select(*keys, F.col(fact_ts).alias("_at"), F.struct(*facts.columns).alias("_fact"))
    fact = fact.withColumn("_bucket", F.when(lost, apart).otherwise(F.date_trunc(unit, at)))
    known = versions.select(
        *keys, F.col("valid_from").alias("_at"), F.date_trunc(unit, F.col("valid_from")).alias("_bucket"),
        F.struct("valid_from", "valid_to", *columns).alias("_version")).filter(~lost)

    sweep = known.unionByName(fact, allowMissingColumns=True)
    # at the same time a version precedes the facts, and of several versions the one open longest comes last
    order = [at, F.col("_version").isNull(), F.col("_version.valid_to").asc_nulls_last()]
    seen = Window.partitionBy(*keys, "_bucket").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    placed = (sweep.withColumn("_seen", F.last("_version", ignorenulls=True).over(seen))
              .filter(F.col("_fact").isNotNull()).select(*keys, "_bucket", "_at", "_fact", "_seen"))

    end = F.col("_version.valid_to")
    tails = known.groupBy(*keys, "_bucket").agg(
        F.max_by("_version", F.struct(at, end.isNull(), end)).alias("_tail"))
    asked = facts.select(*keys, F.col(fact_ts).alias("_at")).filter(~lost).select(
        *keys, F.date_trunc(unit, at).alias("_bucket")).distinct()
    # a bucket's own tail sorts behind its question, which so finds earlier buckets only
    before = (Window.partitionBy(*keys).orderBy("_bucket", F.col("_tail").isNotNull())
              .rowsBetween(Window.unboundedPreceding, 0))
    carried = (asked.unionByName(tails, allowMissingColumns=True)
               .withColumn("_carried", F.last("_tail", ignorenulls=True).over(before))
               .filter(F.col("_tail").isNull()).select(*keys, "_bucket", "_carried"))

    found = placed.join(carried, [*keys, "_bucket"], "left").withColumn("_v", F.coalesce("_seen", "_carried"))
    open_at = F.col("_v.valid_to").isNull() | (at < F.col("_v.valid_to"))
    return found.select(*[F.col(f"_fact.{c}").alias(c) for c in facts.columns],
                        *[F.when(open_at, F.col(f"_v.{c}")).alias(c) for c in columns],
                        F.when(open_at, F.col("_v.valid_from")).alias("version_valid_from"))


def latest_by_key(changes: DataFrame, keys: list[str], seq_col: str, op_col: str = "op",
                  delete_value: str = "DELETE") -> DataFrame:
    """Latest change per key (``max_by`` on the sequence); keys whose latest
    change is a delete are removed."""
    payload = [c for c in changes.columns if c not in keys]
    last = changes.groupBy(*keys).agg(
        F.max_by(F.struct(*payload), F.col(seq_col)).alias("_last"))
    out = last.select(*keys, *[F.col(f"_last.{c}").alias(c) for c in payload])
    return out.filter(F.col(op_col) != delete_value)
