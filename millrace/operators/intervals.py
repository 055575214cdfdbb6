"""Interval operators without a range-join strategy in the engine.

Spark has no interval-join operator; a plain join on the equality key with a
range condition enumerates all pairs within a key (a line holds a third of
all runs).  Here each interval is spread over the fixed-width time buckets
it touches (hours for runs, days for downtime), the join is an equi join on
(key, bucket) plus the exact predicate, and a pair is kept only in one
bucket (the one holding ``greatest(a.start, b.start)``), so no distinct is
needed and the per-task work is bounded by the intervals active in a bucket.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def buckets(start: Column, end: Column, unit: str = "hour") -> Column:
    """Array of bucket starts covering [start, end] (end inclusive)."""
    step = F.expr(f"INTERVAL 1 {unit.upper()}")
    return F.sequence(F.date_trunc(unit, start), F.date_trunc(unit, F.greatest(start, end)), step)


def overlap_pairs(iv: DataFrame, key: str, id_col: str, start: str, end: str,
                  unit: str = "hour") -> DataFrame:
    """All pairs (a, b), a.id < b.id, on the same key whose [start, end)
    intervals overlap."""
    def side(p: str) -> DataFrame:
        return iv.select(F.col(key).alias(f"{p}key"), F.col(id_col).alias(f"{p}id"),
                         F.col(start).alias(f"{p}s"), F.col(end).alias(f"{p}e"),
                         F.explode(buckets(F.col(start), F.col(end), unit)).alias(f"{p}b"))
    a, b = side("a_"), side("b_")
    j = a.join(b, (F.col("a_key") == F.col("b_key")) & (F.col("a_b") == F.col("b_b"))
               & (F.col("a_id") < F.col("b_id"))
               & (F.col("a_s") < F.col("b_e")) & (F.col("b_s") < F.col("a_e"))
               & (F.col("a_b") == F.date_trunc(unit, F.greatest("a_s", "b_s"))))
    return j.select(F.col("a_key").alias(key), F.col("a_id").alias(f"{id_col}_a"),
                    F.col("b_id").alias(f"{id_col}_b"),
                    F.greatest("a_s", "b_s").alias("overlap_start"),
                    F.least("a_e", "b_e").alias("overlap_end"))


def point_in_intervals(points: DataFrame, iv: DataFrame, key: str, point_ts: str,
                       iv_id: str, start: str, end: str, unit: str = "hour",
                       iv_carry: list[str] | None = None) -> DataFrame:
    """For each row of ``points``: how many intervals of its key contain it
    (start ≤ ts < end) and, when exactly one, which (plus ``iv_carry``
    columns of that interval).

    A sweep instead of pairs: starts and ends are events of +1 and -1, and a
    point's count is the running sum up to it.  The exclusive or, over the same
    events, of a hash of (id, start, end) is the hash of the one interval that is
    open where the count is 1; equal intervals are open together, so a point never
    meets one of them.  There are as many rows out as points, whatever ids repeat.
    Sums run within (key, time bucket) and continue from what earlier buckets
    leave open, so the work is linear in points plus intervals, however many
    overlap, and equal points are counted each on their own.

    Points are read once, and nothing filters them: what makes their time is
    often long to compute, and a filter on it would compute it again.  Those
    without a key or time are spread by their content over buckets of their own,
    where nothing opens.
    """
    carry = iv_carry or []
    own = F.xxhash64(iv_id, start, end)    # an id may stand for several intervals of a key
    none = F.lit(None).cast(points.select(F.struct(*points.columns).alias("p")).schema["p"].dataType)

    def known(*values: Column) -> Column:
        return F.explode(F.when(F.col(end) > F.col(start), F.array(*values)))    # no row unless start < end

    events = (iv.select(F.col(key).alias("_k"), own.alias("_h"),
                        known(F.struct(F.col(start).alias("t"), F.lit(1).cast("bigint").alias("n")),
                              F.struct(F.col(end).alias("t"), F.lit(-1).cast("bigint").alias("n"))).alias("_e"))
              .select("_k", F.col("_e.t").alias("_t"), F.lit(0).alias("_order"), F.lit(0).alias("_apart"),
                      F.col("_e.n").alias("_n"), "_h", none.alias("_p")))
    untimed = F.col(point_ts).isNull() | F.col(key).isNull()
    spread = [c for c, t in points.dtypes if not t.startswith(("map", "variant", "struct", "array"))]
    found = points.select(
        F.col(key).alias("_k"), F.col(point_ts).alias("_t"), F.lit(1).alias("_order"),
        F.when(untimed, 1 + F.pmod(F.xxhash64(*spread), F.lit(UNTIMED_BUCKETS)).cast("int")).otherwise(F.lit(0)).alias("_apart"),
        F.lit(0).cast("bigint").alias("_n"), F.lit(0).cast("bigint").alias("_h"), F.struct(*points.columns).alias("_p"))
    sweep = events.union(found).withColumn("_b", F.date_trunc(unit, "_t"))
    upto = (Window.partitionBy("_k", "_b", "_apart").orderBy("_t", "_order")
            .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    near, far = _open_at_start(events, unit)
    open_n, open_h = (F.when(F.col("_apart") == 0, F.coalesce(f"_near_{c}", f"_far_{c}")) for c in "nh")
    zero = F.lit(0).cast("bigint")
    counted = (sweep.withColumn("_n", F.sum("_n").over(upto)).withColumn("_h", F.bit_xor("_h").over(upto)).filter("_order = 1")
               .withColumn("_m", F.date_trunc(COARSE, "_b"))
               .join(near, ["_k", "_b"], "left").join(far, ["_k", "_m"], "left")
               .select("_k", "_t", "_apart", "_p.*", (F.col("_n") + F.coalesce(open_n, zero)).alias("match_count"),
                       F.col("_h").bitwiseXOR(F.coalesce(open_h, zero)).alias("_sum")))
    # points without a single interval look for none: a value of their own spreads them over the tasks of the join
    counted = counted.withColumn("_single", F.col("match_count") == 1).withColumn(
        "_one", F.when(F.col("_single"), F.col("_sum")).otherwise(F.xxhash64("_t", "_apart")))
    names = (iv.select(F.col(key).alias("_ik"), own.alias("_ih"), F.col(iv_id).alias(f"matched_{iv_id}"),
                       *[F.col(c).alias(f"_ivc_{c}") for c in carry], known(F.lit(0)).alias("_known")).drop("_known"))
    named = counted.join(names, (F.col("_k") == F.col("_ik")) & (F.col("_one") == F.col("_ih")) & F.col("_single"), "left")
    return named.select(*points.columns, "match_count", f"matched_{iv_id}", *[F.col(f"_ivc_{c}").alias(c) for c in carry])


#: Buckets of points that have no key or time, and the unit in which ``_open_at_start`` steps over long gaps.
UNTIMED_BUCKETS, COARSE = 256, "month"


def _open_at_start(events: DataFrame, unit: str) -> tuple[DataFrame, DataFrame]:
    """What the events (_k, _t, _n, _h) leave open as a time bucket begins, as two tables to look up.

    ``near`` (_k, _b, _near_n, _near_h) has the later buckets of every month with
    events, ``far`` (_k, _m, _far_n, _far_h) the months: what is open as a month
    begins holds for its buckets up to the first with events, or for all of them.
    Both are sized by the calendar that the intervals span, not by their number.
    """
    step, month = F.expr(f"INTERVAL 1 {unit.upper()}"), F.expr(f"INTERVAL 1 {COARSE.upper()}")
    each = Window.partitionBy("_k").orderBy("_b")
    upto = each.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    state = (events.groupBy("_k", F.date_trunc(unit, "_t").alias("_b")).agg(F.sum("_n").alias("_n"), F.bit_xor("_h").alias("_h"))
             .select("_k", "_b", F.sum("_n").over(upto).alias("_n"), F.bit_xor("_h").over(upto).alias("_h"),
                     F.date_trunc(COARSE, "_b").alias("_m"), F.lead("_b").over(each).alias("_next")))

    def steps(first: Column, last: Column, by: Column) -> Column:
        return F.explode(F.when(first <= last, F.sequence(first, last, by)))

    near = state.select("_k", F.col("_n").alias("_near_n"), F.col("_h").alias("_near_h"),
                        steps(F.col("_b") + step, F.least(F.col("_next"), F.col("_m") + month - step), step).alias("_b"))
    far = state.select("_k", F.col("_n").alias("_far_n"), F.col("_h").alias("_far_h"),
                       steps(F.col("_m") + month, F.date_trunc(COARSE, "_next"), month).alias("_m"))
    return near, far


def day_pieces(df: DataFrame, start: str, end: str) -> DataFrame:
    """Split [start, end) into pieces clipped at day boundaries (``_day``).

    Empty or inverted intervals yield no piece.  The guard lives inside the
    generator (an empty array) rather than in a Filter: a filter on derived
    columns would be pushed below the projections that compute them and
    re-evaluate those expressions per row at the scan.
    """
    s, e = F.col(start), F.col(end)
    days = F.when(e > s, F.sequence(F.to_date(s), F.to_date(e - F.expr("INTERVAL 1 MICROSECOND")),
                                    F.expr("INTERVAL 1 DAY")))
    out = df.withColumn("_day", F.explode(days))
    day_start = F.col("_day").cast("timestamp")
    return (out.withColumn(start, F.greatest(s, day_start))
               .withColumn(end, F.least(e, day_start + F.expr("INTERVAL 1 DAY"))))


def merge_intervals(df: DataFrame, key: str, start: str = "start_ts", end: str = "end_ts") -> DataFrame:
    """Union of [start, end) intervals per key as disjoint islands
    (gaps-and-islands), computed per (key, day) so no window spans a key's
    whole history.  Islands crossing midnight come out as one piece per day;
    the covered time is the same."""
    p = day_pieces(df.select(key, start, end), start, end)
    w = Window.partitionBy(key, "_day").orderBy(start, end)
    prev_max = F.max(end).over(w.rowsBetween(Window.unboundedPreceding, -1))
    p = p.withColumn("_new", F.when(prev_max.isNull() | (F.col(start) > prev_max), 1).otherwise(0))
    p = p.withColumn("_island", F.sum("_new").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    return (p.groupBy(key, "_day", "_island")
             .agg(F.min(start).alias(start), F.max(end).alias(end))
             .select(key, "_day", start, end))


def covered_minutes(gaps: DataFrame, islands: DataFrame, key: str, id_cols: list[str],
                    g_start: str, g_end: str, i_start: str = "start_ts",
                    i_end: str = "end_ts") -> DataFrame:
    """Minutes of each gap [g_start, g_end] (identified by ``id_cols``)
    covered by disjoint islands of its key: gaps are split by day, joined to
    the islands on (key, day) with the overlap predicate, and the overlaps
    are summed per gap (interval ends are whole minutes here)."""
    gp = day_pieces(gaps.select(*id_cols, F.col(key).alias("_gk"), F.col(g_start).alias("_gs"),
                                F.col(g_end).alias("_ge")), "_gs", "_ge")
    isl = islands.select(F.col(key).alias("_ik"), F.col("_day").alias("_iday"),
                         F.col(i_start).alias("_is"), F.col(i_end).alias("_ie"))
    j = gp.join(isl, (gp["_gk"] == isl["_ik"]) & (gp["_day"] == isl["_iday"])
                & (isl["_is"] < gp["_ge"]) & (gp["_gs"] < isl["_ie"]))
    ov = j.groupBy(*id_cols).agg(F.sum(F.timestamp_diff("MINUTE", F.greatest("_gs", "_is"),
                                                        F.least("_ge", "_ie"))).cast("bigint").alias("covered_minutes"))
    return gaps.join(ov, id_cols, "left").withColumn(
        "covered_minutes", F.coalesce(F.col("covered_minutes"), F.lit(0).cast("bigint")))
