import datetime as dt

import pytest
from pyspark.sql import functions as F

from millrace.functions.parse import (date_ambiguous, parse_multi_date, parse_multi_ts,
                                      previous_weekday, round_half_up, sku_size_ml, suffix_key)


def _ts(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "raw STRING")
    out = df.select("raw", parse_multi_ts("raw").cast("timestamp_ntz").alias("ts")).collect()
    return {r["raw"]: r["ts"] for r in out}


def test_four_encodings_parse_to_utc(spark):
    got = _ts(spark, ["1704067207179", "2024-01-01T00:00:07Z", "2023-12-31 18:00:07",
                      "2023-12-31T18:00:07", "12/31/2023 18:00"])
    assert got["1704067207179"] == dt.datetime(2024, 1, 1, 0, 0, 7, 179000)
    assert got["2024-01-01T00:00:07Z"] == dt.datetime(2024, 1, 1, 0, 0, 7)
    # naked and US forms are plant-local (Chicago, UTC-6 in winter)
    assert got["2023-12-31 18:00:07"] == dt.datetime(2024, 1, 1, 0, 0, 7)
    assert got["2023-12-31T18:00:07"] == dt.datetime(2024, 1, 1, 0, 0, 7)
    assert got["12/31/2023 18:00"] == dt.datetime(2024, 1, 1, 0, 0)


def test_bad_values_are_null_not_errors(spark):
    got = _ts(spark, ["170406720717", "17040672071790", "99/99/2026 10:00", "not-a-time", "", None])
    assert all(v is None for v in got.values())


def test_numeric_offset_is_treated_as_local_time(spark):
    # pinned source behaviour: "+00:00" matches the naked-local rule and is shifted
    got = _ts(spark, ["2024-01-01T00:00:00+00:00"])
    assert got["2024-01-01T00:00:00+00:00"] is None or got["2024-01-01T00:00:00+00:00"] == dt.datetime(2024, 1, 1, 6, 0)


def test_spring_gap_hour(spark):
    # 02:30 local does not exist on 2026-03-08; it resolves to 08:30 UTC
    got = _ts(spark, ["2026-03-08 02:30:00"])
    assert got["2026-03-08 02:30:00"] == dt.datetime(2026, 3, 8, 8, 30)


@pytest.mark.parametrize("raw,expected,amb", [
    ("2003-01-05", dt.date(2003, 1, 5), False),
    ("05-JAN-2003", dt.date(2003, 1, 5), False),
    ("2003/01/05", dt.date(2003, 1, 5), False),
    ("25/01/2003", dt.date(2003, 1, 25), False),   # day > 12 → day first
    ("01/25/2003", dt.date(2003, 1, 25), False),   # second > 12 → month first
    ("05/01/2003", None, True),                    # both ≤ 12 → ambiguous
    ("31/02/2003", None, False),                   # impossible date
])
def test_parse_multi_date(spark, raw, expected, amb):
    r = spark.createDataFrame([(raw,)], "d STRING").select(
        parse_multi_date("d").alias("p"), date_ambiguous("d").alias("a")).first()
    assert r["p"] == expected
    assert r["a"] is amb


def test_round_half_up_and_helpers(spark):
    r = spark.range(1).select(
        round_half_up(F.lit(0.12345), 4).alias("r1"), round_half_up(F.lit(2.5), 0).alias("r2"),
        suffix_key(F.lit("EQUIP_201")).alias("k1"), suffix_key(F.lit("x")).alias("k2"),
        sku_size_ml(F.lit("Drink 3 355ml")).alias("ml"),
        previous_weekday(F.lit("2026-03-18").cast("date"), 3).alias("tue")).first()
    assert r["r1"] == 0.1235 and r["r2"] == 3.0
    assert r["k1"] == "EQP-201" and r["k2"] is None
    assert r["ml"] == 355
    assert r["tue"] == dt.date(2026, 3, 10)
