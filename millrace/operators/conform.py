"""Conformance: resolve source encodings through the crosswalks.

``LOOKUPS`` is the table of what can be looked up: which crosswalk, by which of
its columns, and what comes back under which name.  ``resolve`` applies any of
them to a frame, batch or stream.

Crosswalks are broadcast, so facts are never shuffled for them.  Their size is
bounded: the seed loader refuses one with more than ``MOST_SEED_ROWS`` rows, and
it checks that every column looked up here identifies a row, so a lookup never
multiplies facts.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.sources.seeds import Refs


class Lookup(NamedTuple):
    crosswalk: str
    by: str
    gives: tuple[str, ...]


LOOKUPS = {
    "line": Lookup("line_xref", "source_line_value", ("line_id",)),
    "equipment": Lookup("equipment_xref", "source_equipment_id", ("equipment_key",)),
    "asset": Lookup("equipment_xref", "sap_asset_number", ("equipment_key",)),
    "order_type": Lookup("wo_type_xref", "source_type", ("type_norm", "planning_category")),
    "severity": Lookup("alarm_severity_xref", "source_severity", ("severity_norm", "severity_rank")),
}


def resolve(df: DataFrame, refs: Refs, **sources: str) -> DataFrame:
    """``df`` with the results of lookups, given as name=source column; NULL where a code is unknown.

    A result replaces a column of ``df`` that has its name, as the conformed
    line does with the raw one.
    """
    for name, source in sources.items():
        lookup = LOOKUPS[name]
        entries = refs.table(lookup.crosswalk).select(
            F.col(lookup.by).alias("_code"), *(F.col(c).alias(f"_found_{c}") for c in lookup.gives))
        kept = [c for c in df.columns if c not in lookup.gives]
        df = (df.join(F.broadcast(entries), df[source] == F.col("_code"), "left")
              .select(*(df[c] for c in kept), *(F.col(f"_found_{c}").alias(c) for c in lookup.gives)))
    return df
