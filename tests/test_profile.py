from pyspark.sql import functions as F

from millrace.operators import profile, quality

from library_help import rows


def test_scheme_examples_hold_every_id(spark):
    ids = spark.createDataFrame([(f"EQ-{n}",) for n in (105, 101, 103, 101, 104, 102, 106)] +
                                [("EQUIP_201",), ("301",), ("A-1",)], "equipment_id STRING")
    got = profile.scheme_examples(ids, "equipment_id")
    assert got.count() == 9 and got.where("id = 'EQ-101'").first()["rows"] == 2
    assert got.select("id_scheme").distinct().count() >= 3


def test_orphans_and_table_counts(spark, refs):
    facts = spark.createDataFrame([("EQ-101",), ("EQ-999",), ("EQ-999",)], "equipment_id STRING")
    assert rows(profile.orphans(facts, "equipment_id", refs.equipment_xref, "source_equipment_id", "r"),
                "source", "source_id", "rows") == [("r", "EQ-999", 2)]
    tc = {r["table_name"]: (r["rows"], r["share"]) for r in
          profile.table_counts({"a": spark.range(1), "b": spark.range(2)}).collect()}
    assert tc == {"a": (1, 0.333333), "b": (2, 0.666667)}


def test_quality_gate_keeps_only_good_codes(spark):
    import datetime as dt
    r = spark.createDataFrame([
        (1, "EQP-101", "t", dt.datetime(2024, 1, 2, 12), 10.0, True),
        (1, "EQP-101", "t", dt.datetime(2024, 1, 2, 13), 20.0, True),
        (1, "EQP-101", "t", dt.datetime(2024, 1, 2, 14), 999.0, False),   # SUSPECT/BAD: excluded
        (1, "EQP-101", "t", dt.datetime(2024, 1, 2, 15), None, True),      # good code, no value
    ], "line_id INT, equipment_key STRING, sensor_tag STRING, reading_ts_local TIMESTAMP, value DOUBLE, is_good_quality BOOLEAN")
    g = quality.quality_gate(r).first()
    assert (g["readings"], g["good_readings"], g["good_values"], g["avg_good_value"]) == (4, 3, 2, 15.0)


def test_duplicate_keys_and_value_counts(spark):
    df = spark.createDataFrame([("a", 1), ("a", 1), ("b", 2)], "k STRING, v INT")
    assert rows(profile.duplicate_keys(df, ["k", "v"]), "k", "copies") == [("a", 2)]
    vc = profile.value_counts([("t.k", df, "k")])
    assert rows(vc, "value", "rows") == [("a", 2), ("b", 1)]


def test_columns_of_a_frame_share_a_scan(spark, tmp_path):
    spark.createDataFrame([("a", 1), ("a", None), (None, 2)], "k STRING, v INT").write.parquet(str(tmp_path / "t"))
    df = spark.read.parquet(str(tmp_path / "t"))
    columns = [("t.k", df, "k"), ("t.v", df, "v")]
    counts = profile.value_counts(columns)
    assert {tuple(r) for r in counts.collect()} == {("t.k", "a", 2), ("t.k", None, 1), ("t.v", "1", 1),
                                                    ("t.v", "2", 1), ("t.v", None, 1)}
    domain = profile.distinct_domain(columns)
    assert rows(domain, "source_column", "distinct_values") == [("t.k", 1), ("t.v", 2)]
    assert rows(profile.distinct_domain([("e.k", df.filter("v > 9"), "k")]), "source_column", "distinct_values") == [("e.k", 0)]
    for frame in (counts, domain):
        assert frame._jdf.queryExecution().optimizedPlan().toString().count("Relation [") == 1


def test_vibration_window_stats(spark):
    import datetime as dt
    import math
    from millrace.streaming import vibration
    msgs = spark.createDataFrame([
        ("S1", dt.datetime(2024, 1, 1, 0, 0, 5), 1.0), ("S1", dt.datetime(2024, 1, 1, 0, 0, 15), 3.0),
    ], "sensor_id STRING, event_ts TIMESTAMP, m2 DOUBLE")
    w = {r["window_start"]: r for r in vibration.window_stats(msgs).collect()}
    both = w[dt.datetime(2024, 1, 1, 0, 0, 0)]          # the window holding both messages
    assert (both["n"], both["max_m2"], both["mean_m2"]) == (2, 3.0, 2.0)
    assert both["sd_m2"] == round(math.sqrt(2.0), 6) and both["alert"] is False
    assert len(w) == 7                                   # 6 windows per message, 5 shared
