"""Mixing sources to target weights by capped water-filling (native).

``target_table`` clamps sources at a maximum number of epochs and shares the
excess among the rest by weight until no target is above its cap.  In the order
of cap/weight the clamped sources are a prefix, so the fixed point is found
with running sums over the table of sources instead of a driver loop.

``mix`` samples every source to its target: ``floor(target / size)`` whole
repetitions of all its documents, and one further repetition of the documents
that come first in a seeded hash order until the rest of the target is
reached; the document where it is reached is taken in part (its first words).
The place of the cut is found from sums over hash buckets and then over the
rows of one bucket of each source, so no source is ever sorted as a whole.

Defined cases: a null or empty text has size 0 and gets repetitions that add no
words; a null source is a source of its own, last in order; equal rows have the
same hash and, at the cut, share what is left evenly; an empty table gives an
empty result; other columns, whatever their names, are carried unchanged.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm.common import WORD, bounded_broadcast, materialize, set_aside, text_or_empty

#: The order hash has 60 bits; its leading 14 are the bucket.
HASH_DIGITS, BUCKET_SHIFT = 15, 46


def word_count(column: str = "text") -> Column:
    return F.regexp_count(text_or_empty(column), F.lit(WORD)).cast("long")


def hash_order(size: Column, seed: int) -> Column:
    """A seeded 60-bit hash of the row: the leading digits of an MD5."""
    digest = F.md5(F.concat_ws("|", F.lit(seed), "doc_id", "source", size))
    return F.conv(F.substring(digest, 1, HASH_DIGITS), 16, 10).cast("long")


def target_table(sizes: DataFrame, weights: tuple[int, ...] = (5, 2, 1), epochs: int = 3) -> DataFrame:
    """(source, source_size) -> the same with target, the words the mix should take.

    Sources by code point, null last, get ``weights`` in turn and share the sum
    of all sizes; no target exceeds ``epochs`` times its source's size.  The
    running sums go over one row for each source.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    turn = F.pmod(F.row_number().over(by_name) - 1, F.lit(len(weights)))
    weight = F.element_at(F.array(*map(F.lit, weights)), (turn + 1).cast("int")).cast("double")
    ranked = sizes.select("source", "source_size", weight.alias("weight"),
                          (F.col("source_size") * epochs).cast("double").alias("cap"))
    by_level = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last())
    before = by_level.rowsBetween(Window.unboundedPreceding, -1)
    onward = by_level.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    everywhere = Window.partitionBy(F.lit(0)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    filled = (ranked
              .withColumn("left", F.sum("source_size").over(everywhere)
                          - F.coalesce(F.sum("cap").over(before), F.lit(0.0)))
              .withColumn("level", F.col("left") / F.sum("weight").over(onward))
              .withColumn("clamped", F.col("cap") <= F.col("weight") * F.col("level"))
              .withColumn("place", F.row_number().over(by_level)))
    # the level of the first source, in this order, that is not clamped
    level = F.min(F.when(~F.col("clamped"), F.struct("place", "level"))).over(everywhere)
    return (filled.withColumn("at", level["level"])
            .select("source", "source_size",
                    F.when(F.col("at").isNull(), F.col("cap"))
                    .otherwise(F.least(F.col("cap"), F.col("weight") * F.col("at"))).alias("target")))


def mix_plan(meta: DataFrame, weights: tuple[int, ...] = (5, 2, 1), epochs: int = 3) -> DataFrame:
    """One row for each source from ``meta`` (source, size, h): target, whole, and where the last repetition ends.

    ``cut`` is the hash of the documents at the end and ``cut_words`` what each
    of them adds; documents with a smaller hash are taken whole once more.
    """
    sizes = meta.groupBy("source").agg(F.sum("size").alias("source_size"))
    share = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    targets = (target_table(sizes, weights, epochs)
               .withColumn("whole", F.floor(share))
               .withColumn("rest", F.floor(F.col("target") - F.col("whole") * F.col("source_size"))))
    targets = materialize(targets, "mix-targets")

    bucket = F.shiftright("h", BUCKET_SHIFT)
    by_bucket = Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    ends = (meta.where("size > 0").groupBy("source", bucket.alias("bucket")).agg(F.sum("size").alias("words"))
            .withColumn("before", F.coalesce(F.sum("words").over(by_bucket), F.lit(0)))
            .alias("b").join(targets.alias("t"), F.col("b.source").eqNullSafe(F.col("t.source")))
            .where("before < rest and rest <= before + words")
            .select("t.source", "bucket", "before", "rest"))
    by_hash = Window.partitionBy("source").orderBy("h").rowsBetween(Window.unboundedPreceding, -1)
    cuts = (meta.where("size > 0").withColumn("bucket", bucket).alias("m")
            .join(ends.alias("e"), F.col("m.source").eqNullSafe(F.col("e.source"))
                  & (F.col("m.bucket") == F.col("e.bucket")))
            .groupBy("m.source", "m.h", "e.before", "e.rest")
            .agg(F.sum("size").alias("words"), F.count("*").alias("copies"))
            .withColumn("at", F.col("before") + F.coalesce(F.sum("words").over(by_hash), F.lit(0)))
            .where("at < rest and rest <= at + words")
            .select("source", F.col("h").alias("cut"), F.floor((F.col("rest") - F.col("at")) / F.col("copies")).alias("cut_words")))
    return (targets.alias("t").join(cuts.alias("c"), F.col("t.source").eqNullSafe(F.col("c.source")), "left")
            .select("t.source", "source_size", "target", "whole", "cut", "cut_words"))


def mix(docs: DataFrame, weights: tuple[int, ...] = (5, 2, 1), epochs: int = 3, seed: int = 17,
        size: str | None = None) -> DataFrame:
    """``docs`` (doc_id, source, text or a ``size`` column, ...) with what the mix takes of each row.

    Adds mix_size, mix_source_size, mix_target, mix_whole (repetitions of the
    whole document) and mix_words (further words, fewer than a whole
    repetition).  ``docs`` is read twice, once for the sums.
    """
    words = F.col(size) if size else word_count()
    sized = docs.withColumn("mix_size", words).withColumn("mix_h", hash_order(F.col("mix_size"), seed))
    meta = sized.select("source", F.col("mix_size").alias("size"), F.col("mix_h").alias("h"))
    plan = bounded_broadcast(materialize(mix_plan(meta, weights, epochs), "mix-plan"))
    plan = plan.select(F.col("source").alias("mix_source"), F.col("source_size").alias("mix_source_size"),
                       F.col("target").alias("mix_target"), F.col("whole").alias("mix_base"), "cut", "cut_words")
    further = F.coalesce(F.col("mix_h") < F.col("cut"), F.lit(False))
    at_cut = F.coalesce(F.col("mix_h") == F.col("cut"), F.lit(False))
    full = at_cut & (F.col("cut_words") >= F.col("mix_size"))
    return (sized.join(plan, F.col("source").eqNullSafe(F.col("mix_source")))
            .withColumn("mix_whole", F.col("mix_base") + (further | full).cast("long"))
            .withColumn("mix_words", F.when(at_cut & ~full, F.col("cut_words")).otherwise(F.lit(0)))
            .drop("mix_source", "mix_base", "mix_h", "cut", "cut_words"))


def mixed_documents(docs: DataFrame, weights: tuple[int, ...] = (5, 2, 1), epochs: int = 3, seed: int = 17) -> DataFrame:
    """The mixed corpus: each row of ``docs`` as often as the mix takes it.

    The one document of a source that the mix takes in part stays whole here if
    at least half of it is taken.  Documents without words count as words
    taken nowhere and come as often as their source's whole repetitions.
    """
    narrow, restore = set_aside(docs, "doc_id", "source", "text")
    mixed = mix(narrow, weights, epochs, seed)
    times = F.col("mix_whole") + F.when((F.col("mix_words") > 0) & (F.col("mix_words") * 2 >= F.col("mix_size")), 1).otherwise(0)
    return restore(mixed.where(times > 0).withColumn("mix_copy", F.explode(F.sequence(F.lit(1), times.cast("int")))))


ORACLE = """
WITH d AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS size FROM documents),
h AS (
  SELECT *, ('0x' || substr(md5(concat_ws('|', 17, doc_id, source, size)), 1, 15))::BIGINT AS h FROM d),
s AS (
  SELECT source, sum(size)::BIGINT AS source_size,
         CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 WHEN 0 THEN 5.0::DOUBLE WHEN 1 THEN 2 ELSE 1 END AS w
  FROM d GROUP BY source),
l AS (
  SELECT *, (sum(source_size) OVER () - coalesce(sum(3 * source_size) OVER (ORDER BY 3 * source_size / w, source NULLS LAST
             ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
            / sum(w) OVER (ORDER BY 3 * source_size / w, source NULLS LAST
             ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level,
         row_number() OVER (ORDER BY 3 * source_size / w, source NULLS LAST) AS place FROM s),
t AS (
  SELECT source, source_size, least(3.0::DOUBLE * source_size, coalesce(w * (SELECT arg_min(level, place) FROM l
           WHERE 3 * source_size > w * level), 3.0::DOUBLE * source_size)) AS target FROM l),
p AS (
  SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size)::BIGINT ELSE 0 END AS whole FROM t),
r AS (
  SELECT h.*, source_size, target, whole, floor(target - whole * source_size)::BIGINT AS rest,
         coalesce(sum(size) OVER (PARTITION BY h.source ORDER BY h.h
           RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), 0) AS upto,
         sum(size) OVER (PARTITION BY h.source, h.h) AS words,
         count(*) FILTER (size > 0) OVER (PARTITION BY h.source, h.h) AS copies
  FROM h JOIN p ON h.source IS NOT DISTINCT FROM p.source)
SELECT doc_id, size::BIGINT AS size, source_size, target,
       (whole * size + CASE WHEN size = 0 THEN 0 WHEN upto <= rest THEN size
          ELSE greatest(0, floor((rest - (upto - words)) / copies)) END)::BIGINT AS taken
FROM r
"""


def op2_mix(spark, sf_dir: str) -> DataFrame:
    """Words of every document that the mix of all sources takes."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    meta = materialize(docs.select("doc_id", "source", word_count().alias("size")), "mix-sizes")
    return mix(meta, size="size").select(
        "doc_id", "size", F.col("mix_source_size").alias("source_size"), F.col("mix_target").alias("target"),
        (F.col("mix_whole") * F.col("size") + F.col("mix_words")).cast("long").alias("taken"))
