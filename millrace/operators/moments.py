"""Mergeable co-moments: correlations over any range of periods from stored rows.

``co_moments`` reduces pairs (x, y) to one row a group: the count, both means
and the centred sums ``m2x``, ``m2y`` and ``cxy``.  Rows of several groups merge
into those of their union, so a table of one row for each (line, parameter, day)
answers the correlation over any range of days without reading the pairs again.
The sums are centred on their own means, not plain sums of squares, which would
cancel where the spread is small beside the mean.

Pairs with a NULL or NaN side take no part.  A group without pairs has no row;
an empty table gives an empty one.  The correlation of fewer than two pairs, or
of a side without spread, is NULL.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MOMENTS = ["n", "mean_x", "mean_y", "m2x", "m2y", "cxy"]


def co_moments(pairs: DataFrame, groups: list[str], x: str, y: str) -> DataFrame:
    """One row a group, from one aggregate that is combined before its shuffle."""
    kept = pairs.select(*groups, F.col(x).cast("double").alias("_x"), F.col(y).cast("double").alias("_y"))
    kept = kept.filter(F.col("_x").isNotNull() & F.col("_y").isNotNull() & ~F.isnan("_x") & ~F.isnan("_y"))
    n = F.count(F.lit(1))
    return kept.groupBy(*groups).agg(
        n.cast("bigint").alias("n"), F.avg("_x").alias("mean_x"), F.avg("_y").alias("mean_y"),
        (F.var_pop("_x") * n).alias("m2x"), (F.var_pop("_y") * n).alias("m2y"),
        (F.covar_pop("_x", "_y") * n).alias("cxy"))


def merge(moments: DataFrame, groups: list[str]) -> DataFrame:
    """Rows of ``co_moments`` merged by ``groups`` (a part of their groups, or none).

    The common means come from a first aggregate; a second one moves each row's
    centred sums to them.  Both are combined before their shuffle, so a group may
    hold most of the rows.  A NULL group value is a value of its own.
    """
    n = F.col("n").cast("double")
    totals = moments.groupBy(*groups).agg(
        (F.sum(n * F.col("mean_x")) / F.sum(n)).alias("_to_x"),
        (F.sum(n * F.col("mean_y")) / F.sum(n)).alias("_to_y")).filter(F.col("_to_x").isNotNull())
    totals = totals.withColumnsRenamed({g: f"_g_{g}" for g in groups})
    same = F.lit(True)
    for g in groups:
        same = same & F.col(g).eqNullSafe(F.col(f"_g_{g}"))
    dx, dy = F.col("mean_x") - F.col("_to_x"), F.col("mean_y") - F.col("_to_y")
    # without groups totals is a single row (an aggregate without keys)
    met = moments.join(totals, same) if groups else moments.join(F.broadcast(totals))
    return met.groupBy(*groups, "_to_x", "_to_y").agg(
        F.sum("n").cast("bigint").alias("n"), F.sum(F.col("m2x") + n * dx * dx).alias("m2x"),
        F.sum(F.col("m2y") + n * dy * dy).alias("m2y"), F.sum(F.col("cxy") + n * dx * dy).alias("cxy"),
    ).select(*groups, "n", F.col("_to_x").alias("mean_x"), F.col("_to_y").alias("mean_y"), "m2x", "m2y", "cxy")


def correlation():
    """Pearson correlation of a row of moments (a column)."""
    spread = F.sqrt(F.col("m2x")) * F.sqrt(F.col("m2y"))
    return F.when((F.col("n") > 1) & (spread > 0), F.col("cxy") / spread)
