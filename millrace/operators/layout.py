"""Clustered layout: rows in an interleaved order of several columns.

Parquet keeps the smallest and largest value of each column in a row group, and
a scan skips the groups that a filter cannot meet.  Sorting by one column serves
filters on that column alone; an interleaved order (bits of the columns'
positions taken in turn) keeps the ranges of all of them narrow.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BITS = 6   # positions of a column: 2 ** BITS


def positions(df: DataFrame, column: str, bits: int = BITS) -> DataFrame:
    """(column, position) of its distinct values: the number of the range, of
    2 ** ``bits`` ranges in their order, that Spark's range partitioning puts a
    value in.  The values of one range are about as many as those of another,
    whatever the type and the number of values."""
    values = df.select(column).filter(F.col(column).isNotNull()).distinct()
    return values.repartitionByRange(2 ** bits, column).select(column, F.spark_partition_id().alias("_position"))


def interleaved(parts: list[Column], bits: int = BITS) -> Column:
    """The bits of ``parts`` (0 up to 2 ** ``bits``) taken in turn, highest first; the first part leads."""
    if bits * len(parts) > 62:
        raise ValueError(f"{len(parts)} columns of {bits} bits do not fit a long")
    z = F.lit(0).cast("bigint")
    for bit in range(bits):
        for turn, part in enumerate(reversed(parts)):
            one = F.shiftright(part.cast("bigint"), bit).bitwiseAND(F.lit(1).cast("bigint"))
            z = z.bitwiseOR(F.shiftleft(one, bit * len(parts) + turn))
    return z


def cluster_key(df: DataFrame, columns: list[str], key: str = "_cluster", bits: int = BITS) -> DataFrame:
    """``df`` with the interleaved order of ``columns`` as ``key``; no row is lost or repeated.

    A NULL stands before all values.  The position tables hold one row for each
    distinct value and carry no hint: Spark broadcasts them while they are small.
    The positions change no value, so a recomputed task may place a row anew
    without harm.
    """
    out, parts = df, []
    for n, c in enumerate(columns):
        value, place = f"_value_{n}", f"_position_{n}"
        table = positions(df, c, bits).withColumnsRenamed({c: value, "_position": place})
        out = out.join(table, F.col(c) == F.col(value), "left").drop(value)
        parts.append(F.coalesce(F.col(place), F.lit(0)))
    keyed = out.withColumn(key, interleaved(parts, bits))
    return keyed.drop(*[f"_position_{n}" for n in range(len(columns))])
