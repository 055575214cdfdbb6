"""Named data-quality expectations with a policy, counted per update.

An expectation is a SQL predicate plus a policy:

* ``warn``  – keep the row, count the violation
* ``drop``  – remove the row, count it
* ``fail``  – abort the update before anything is written

A predicate that evaluates to NULL is a violation.  Counting is one
aggregate pass (``count_if`` per rule, partial aggregation on every task), or
an ``Observation`` of a micro-batch's own write; no rows go to the driver.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

POLICIES = ("warn", "drop", "fail")


@dataclass(frozen=True)
class Expectation:
    name: str
    predicate: str
    policy: str = "warn"

    def __post_init__(self):
        if self.policy not in POLICIES:
            raise ValueError(f"unknown policy {self.policy!r}")

    def holds(self) -> Column:
        return F.coalesce(F.expr(self.predicate), F.lit(False))

    def violated(self) -> Column:
        return ~self.holds()


class ExpectationFailed(RuntimeError):
    def __init__(self, table: str, failures: dict[str, int]):
        super().__init__(f"{table}: expectation(s) failed {failures}")
        self.table = table
        self.failures = failures


def apply(df: DataFrame, rules: list[Expectation]) -> DataFrame:
    """Drop the rows violating any ``drop`` rule (``warn`` / ``fail`` rules do
    not filter; enforce ``fail`` rules with ``enforce`` before writing)."""
    drops = [r.holds() for r in rules if r.policy == "drop"]
    if not drops:
        return df
    cond = drops[0]
    for c in drops[1:]:
        cond = cond & c
    return df.filter(cond)


def _rule_rows(counted: DataFrame, total: Column, violations: list[Column], rules: list[Expectation],
               table: str) -> DataFrame:
    """One row per rule out of the one row of ``counted``."""
    rows = F.array(*[
        F.struct(F.lit(r.name).alias("rule"), F.lit(r.policy).alias("policy"),
                 v.cast("bigint").alias("violations"))
        for r, v in zip(rules, violations)])
    return (counted.select(total.cast("bigint").alias("total_rows"), F.inline(rows))
            .select(F.lit(table).alias("table_name"), "rule", "policy", "violations", "total_rows",
                    ((F.col("policy") == "fail") & (F.col("violations") > 0)).alias("would_abort")))


def report(df: DataFrame, rules: list[Expectation], table: str) -> DataFrame:
    """One row per rule: (table_name, rule, policy, violations, total_rows,
    would_abort) — computed in one aggregate pass over ``df``."""
    counted = df.agg(F.count(F.lit(1)).alias("_total"),
                     *[F.count_if(r.violated()).alias(f"_v{i}") for i, r in enumerate(rules)])
    return _rule_rows(counted, F.col("_total"), [F.col(f"_v{i}") for i in range(len(rules))], rules, table)


def enforce(df: DataFrame, rules: list[Expectation], table: str) -> None:
    """Raise ``ExpectationFailed`` if any ``fail`` rule is violated (an action:
    call it before the write, or inside ``foreachBatch``)."""
    fails = [r for r in rules if r.policy == "fail"]
    if not fails:
        return
    row = df.agg(*[F.count_if(r.violated()).alias(r.name) for r in fails]).first()
    bad = {r.name: row[r.name] for r in fails if row[r.name]}
    if bad:
        raise ExpectationFailed(table, bad)


def observe(df: DataFrame, rules: list[Expectation], name: str) -> tuple[DataFrame, Observation]:
    """Attach violation counters to ``df`` as an Observation: the write of the
    returned frame counts while it runs, without a pass of its own.

    The write must not shuffle behind the counters: a task of its last stage
    counts once, however often it is tried, but one of an earlier stage may be
    counted again when it is repeated after a lost executor.
    """
    obs = Observation(name)
    metrics = [F.count(F.lit(1)).alias("rows")]
    metrics += [F.count_if(r.violated()).alias(r.name) for r in rules]
    return df.observe(obs, *metrics), obs


def observed_report(spark, obs: Observation, rules: list[Expectation], table: str) -> DataFrame:
    """``report`` from the counters of a write that has ended."""
    counts = obs.get
    return _rule_rows(spark.range(1), F.lit(counts["rows"]), [F.lit(counts[r.name]) for r in rules], rules, table)


def reason(pairs: list[tuple[str, Column]]) -> Column:
    """First matching reason code from ordered (reason, violated) pairs, else NULL."""
    out = None
    for code, bad in pairs:
        out = F.when(bad, F.lit(code)) if out is None else out.when(bad, F.lit(code))
    return out
