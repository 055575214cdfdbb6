"""Column-level parsers and helpers (all built-in functions, codegen-friendly).

Every function returns a ``Column``; nothing here runs Python per row.
"""

from __future__ import annotations

from collections.abc import Callable
from typing import NamedTuple

from pyspark.sql import Column
from pyspark.sql import functions as F

from millrace import PLANT_TZ

# Patterns of the timestamp encodings in the source extracts, and the US layout.
EPOCH_MS = r"^\d{13}$"
ISO_UTC = r"^\d{4}-\d{2}-\d{2}T.*Z$"
ISO_NAKED = r"^\d{4}-\d{2}-\d{2}[T ]"
US_SLASH = r"^\d{2}/\d{2}/\d{4}"
US_SLASH_FORMAT = "MM/dd/yyyy HH:mm"


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


class TsEncoding(NamedTuple):
    """One way a source writes a time: its name, the texts it claims, and their instant (NULL if unreadable)."""
    name: str
    pattern: str
    instant: Callable[[Column, str], Column]


def _wall_clock(text: Column, zone: str, *layout: str) -> Column:
    return F.to_utc_timestamp(F.try_to_timestamp(text, *map(F.lit, layout)), zone)


#: In order: the first encoding whose pattern matches claims a text.
TS_ENCODINGS = (
    TsEncoding("EPOCH_MS", EPOCH_MS, lambda text, zone: F.timestamp_millis(text.try_cast("long"))),
    TsEncoding("ISO_UTC", ISO_UTC, lambda text, zone: F.try_to_timestamp(text)),
    TsEncoding("ISO_NAKED", ISO_NAKED, lambda text, zone: _wall_clock(F.translate(text, "T", " "), zone)),
    TsEncoding("US_SLASH", US_SLASH, lambda text, zone: _wall_clock(text, zone, US_SLASH_FORMAT)),
)


def _by_encoding(text: Column, result: Callable[[TsEncoding], Column]) -> Column:
    chain = F    # F.when opens the chain, Column.when continues it
    for encoding in TS_ENCODINGS:
        chain = chain.when(text.rlike(encoding.pattern), result(encoding))
    return chain


def parse_multi_ts(c, zone: str = PLANT_TZ) -> Column:
    """Raw text → UTC instant by the first of ``TS_ENCODINGS`` that claims it.

    Times without a zone are wall clocks of ``zone``.  What no encoding claims,
    or the one that does can't read, is NULL and never an exception, so bad
    rows reach the quarantine instead of failing a batch.  A value with a
    numeric offset (``+00:00``) counts as a time without zone, as in the source
    pipeline.
    """
    text = _col(c)
    return _by_encoding(text, lambda e: e.instant(text, zone))


def ts_format_class(c) -> Column:
    """Name of the encoding that claims a text (profiling); EMPTY or UNKNOWN if none does."""
    text = _col(c)
    claimed = _by_encoding(text, lambda e: F.lit(e.name)).otherwise(F.lit("UNKNOWN"))
    return F.when(F.coalesce(F.trim(text), F.lit("")) == "", F.lit("EMPTY")).otherwise(claimed)


def to_local(c, zone: str = PLANT_TZ) -> Column:
    """UTC instant → plant-local wall clock (as a timestamp)."""
    return F.from_utc_timestamp(_col(c), zone)


# Date layouts accepted by the registry date parser.
DATE_ISO = r"^\d{4}-\d{2}-\d{2}$"
DATE_DMY_NAME = r"^\d{1,2}-[A-Za-z]{3}-\d{4}$"
DATE_YMD_SLASH = r"^\d{4}/\d{2}/\d{2}$"
DATE_NN_SLASH = r"^\d{2}/\d{2}/\d{4}$"


def date_format_class(c) -> Column:
    c = _col(c)
    return (F.when(c.isNull() | (F.trim(c) == ""), F.lit("EMPTY"))
            .when(c.rlike(DATE_ISO), F.lit("yyyy-MM-dd"))
            .when(c.rlike(DATE_DMY_NAME), F.lit("dd-MMM-yyyy"))
            .when(c.rlike(DATE_YMD_SLASH), F.lit("yyyy/MM/dd"))
            .when(c.rlike(DATE_NN_SLASH), F.lit("nn/nn/yyyy"))
            .otherwise(F.lit("UNKNOWN")))


def _nn_parts(c: Column):
    first = F.substring(c, 1, 2).try_cast("int")
    second = F.substring(c, 4, 2).try_cast("int")
    return first, second


def date_ambiguous(c) -> Column:
    """True for ``nn/nn/yyyy`` values where both numbers are ≤ 12."""
    c = _col(c)
    first, second = _nn_parts(c)
    return F.coalesce(c.rlike(DATE_NN_SLASH) & (first <= 12) & (second <= 12), F.lit(False))


def parse_multi_date(c) -> Column:
    """Raw text → DATE over four layouts.

    ``nn/nn/yyyy`` is read day-first when the first number is > 12,
    month-first when the second is > 12, and is NULL (ambiguous, see
    ``date_ambiguous``) when both are ≤ 12.  Impossible dates are NULL.
    """
    c = _col(c)
    first, second = _nn_parts(c)
    return (
        F.when(c.rlike(DATE_ISO), F.try_to_date(c, "yyyy-MM-dd"))
        .when(c.rlike(DATE_DMY_NAME),
              F.try_to_date(F.initcap(F.lower(c)), "d-MMM-yyyy"))
        .when(c.rlike(DATE_YMD_SLASH), F.try_to_date(c, "yyyy/MM/dd"))
        .when(c.rlike(DATE_NN_SLASH) & (first > 12), F.try_to_date(c, "dd/MM/yyyy"))
        .when(c.rlike(DATE_NN_SLASH) & (second > 12), F.try_to_date(c, "MM/dd/yyyy"))
    )


def round_half_up(c, n: int) -> Column:
    """``ROUND(x, n)`` that gives the same double in Spark and in SQL oracles.

    Rounding a double directly is not bit-identical across engines for rare
    values; rounding its DECIMAL(28,12) image half-up is.
    """
    return F.round(_col(c).cast("decimal(28,12)"), n).cast("double")


def round_half_up_sql(expr: str, n: int) -> str:
    """The SQL text of ``round_half_up`` (used by the oracles)."""
    return f"CAST(ROUND(CAST({expr} AS DECIMAL(28,12)), {n}) AS DOUBLE)"


def suffix_key(c, prefix: str = "EQP-", digits: str = r"(\d+)$") -> Column:
    """Conformed key from the numeric suffix of an alias: ``EQ-101`` → ``EQP-101``."""
    d = F.regexp_extract(_col(c), digits, 1)
    return F.when(d != "", F.concat(F.lit(prefix), d))


def sku_size_ml(name) -> Column:
    """Unit size in ml parsed from a product name (``Drink 3 355ml`` → 355)."""
    d = F.regexp_extract(_col(name), r"(?i)(\d+)\s*ml\b", 1)
    return F.when(d != "", d.try_cast("int"))


def previous_weekday(ref_date, dow: int) -> Column:
    """The ``dow`` (Spark numbering, Sunday = 1) of the *previous* cycle.

    Mirrors the pinned "last Tuesday" expression: on Wednesday 2026-03-18 with
    dow = 3 it returns 2026-03-10 (not 03-17), i.e. it first steps back to the
    start of the previous 7-day cycle.
    """
    d = _col(ref_date)
    back = F.pmod(F.dayofweek(d) - F.lit(dow), F.lit(7)) + F.lit(7)
    return F.date_sub(d, back.cast("int"))
