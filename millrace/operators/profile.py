"""Profiling: counts, domains, format classes, duplicates, coverage.

Each profile is one aggregate over the frames it is given (no driver loops
over rows, no per-finding rescans beyond one pass per source).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.functions.parse import round_half_up


def union_all(frames: list[DataFrame]) -> DataFrame:
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


def table_counts(frames: dict[str, DataFrame]) -> DataFrame:
    """Rows per table and each table's share of all rows."""
    counts = union_all([df.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(n).alias("table_name"), "rows")
                        for n, df in frames.items()])
    total = counts.agg(F.sum("rows").alias("_total"))
    return (counts.crossJoin(F.broadcast(total))  # one-row total
            .select("table_name", "rows",
                    round_half_up(F.col("rows").cast("double") / F.col("_total").cast("double"), 6).alias("share")))


def _frequencies(columns: list[tuple[str, DataFrame, Column]], name: str) -> DataFrame:
    """Rows by (label, value) of (label, frame, expression) triples, all of a frame in one scan of it."""
    by_frame: dict[int, tuple[DataFrame, list[Column]]] = {}
    for label, df, value in columns:
        pair = F.struct(F.lit(label).alias("source_column"), value.cast("string").alias(name))
        by_frame.setdefault(id(df), (df, []))[1].append(pair)
    pairs = union_all([df.select(F.inline(F.array(*named))) for df, named in by_frame.values()])
    return pairs.groupBy("source_column", name).agg(F.count(F.lit(1)).alias("rows"))


def value_counts(columns: list[tuple[str, DataFrame, str]]) -> DataFrame:
    """Frequency of each value of the given (label, frame, column) triples; columns of the same frame share a scan."""
    return _frequencies([(label, df, F.col(c)) for label, df, c in columns], "value")


def id_scheme(c) -> Column:
    c = F.col(c) if isinstance(c, str) else c
    return (F.when(c.rlike(r"^EQ-\d+$"), F.lit("EQ-nnn"))
            .when(c.rlike(r"^EQUIP_\d+$"), F.lit("EQUIP_nnn"))
            .when(c.rlike(r"^\d+$"), F.lit("nnn"))
            .when(c.rlike(r"^A-\d+$"), F.lit("A-nnn"))
            .otherwise(F.lit("OTHER")))


def format_profile(columns: list[tuple[str, DataFrame, Column]]) -> DataFrame:
    """Rows per format class for (label, frame, class-expression) triples; one scan a frame."""
    return _frequencies(columns, "format")


def scheme_examples(df: DataFrame, col: str) -> DataFrame:
    """Every distinct id with its scheme and how many rows carry it."""
    return (df.groupBy(F.col(col).alias("id")).agg(F.count(F.lit(1)).alias("rows"))
            .select(id_scheme("id").alias("id_scheme"), "id", "rows"))


def distinct_domain(columns: list[tuple[str, DataFrame, str]]) -> DataFrame:
    """Exact distinct values of (label, frame, column) triples; one scan a frame, 0 where it is empty."""
    by_frame: dict[int, tuple[DataFrame, list[tuple[str, str]]]] = {}
    for label, df, c in columns:
        by_frame.setdefault(id(df), (df, []))[1].append((label, c))
    return union_all([
        df.agg(*[F.count_distinct(c).alias(f"_{i}") for i, (_, c) in enumerate(named)])
          .select(F.inline(F.array(*[F.struct(F.lit(label).alias("source_column"), F.col(f"_{i}").alias("distinct_values"))
                                     for i, (label, _) in enumerate(named)])))
        for df, named in by_frame.values()])


def duplicate_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """Natural keys occurring more than once, with their copy count."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("copies")).filter(F.col("copies") > 1)


def orphans(facts: DataFrame, fact_col: str, dim: DataFrame, dim_col: str, label: str) -> DataFrame:
    """Fact ids without a match in the dimension (``left_anti``), counted."""
    anti = facts.join(dim.select(F.col(dim_col).alias("_d")), facts[fact_col] == F.col("_d"), "left_anti")
    return (anti.groupBy(F.col(fact_col).alias("source_id")).agg(F.count(F.lit(1)).alias("rows"))
            .select(F.lit(label).alias("source"), "source_id", "rows"))
