import pytest
from pyspark.sql import functions as F

from millrace.operators import expect
from millrace.operators.expect import Expectation, ExpectationFailed
from millrace.plans import silver
from millrace.sources import seeds

from library_help import rows

READING_COLS = "timestamp STRING, equipment_id STRING, sensor_tag STRING, value STRING, quality STRING, status STRING, line_id STRING"


def _bronze(spark, data):
    return silver.with_ingest_metadata(spark.createDataFrame(data, READING_COLS), "test")


def test_sentinel_scrub(spark):
    df = spark.createDataFrame([
        ("-999", "temp"), ("-999.99", "temp"), ("-998.99", "temp"), ("-1.5", "line_VIB_x"),
        ("-1.5", "temp"), ("", "temp"), ("abc", "temp"), ("3.25", "VIB")], "value STRING, sensor_tag STRING")
    got = [r[0] for r in df.select(silver.scrub_value()).collect()]
    assert got == [None, None, -998.99, None, -1.5, None, None, 3.25]


def test_readings_quarantine_and_balance(spark, refs):
    from millrace.operators import quality
    b = _bronze(spark, [
        ("2024-01-01T00:00:00Z", "EQ-101", "t", "1.0", "192", "GOOD", "L1"),
        ("2024-01-01T00:00:00Z", "EQ-101", "t", "2.0", "64", "SUSPECT", "L1"),   # duplicate key, lower quality
        ("not-a-time", "EQ-101", "t", "1.0", "192", "GOOD", "1"),
        ("2024-01-01T00:00:00Z", "EQ-999", "t", "1.0", "192", "GOOD", "Line 2"),
        ("not-a-time", "EQ-999", "t", "1.0", "192", "GOOD", "Line-3"),
    ])
    s = silver.silver_readings(b, refs)
    assert rows(s, "equipment_key", "value", "opc_quality_code", "line_id") == [("EQP-101", 1.0, 192, 1)]
    q = silver.quarantine_readings(b, refs)
    assert sorted(r[0] for r in q.select("quarantine_reason").collect()) == [
        "UNKNOWN_EQUIPMENT_ID", "UNPARSEABLE_TIMESTAMP", "UNPARSEABLE_TIMESTAMP"]
    bal = quality.quarantine_balance(silver.readings_tagged(b, refs), s).first()
    assert (bal["input_rows"], bal["accepted_rows"], bal["quarantined_rows"], bal["duplicate_rows"]) == (5, 1, 3, 1)
    assert bal["balanced"]


def test_volume_normalize(spark, refs):
    cols = "run_id STRING, line_id STRING, status STRING, start_time STRING, end_time STRING, volume_unit STRING, actual_volume STRING, target_volume STRING, total_units STRING, good_units STRING, scrap_units STRING, efficiency_pct STRING"
    b = spark.createDataFrame([
        ("1", "1", "COMPLETED", "2024-01-02T08:00:00", "2024-01-02T15:00:00Z", "liters", "1.5", "1.5", "10", "9", "1", "90"),
        ("2", "2", "COMPLETED", "2024-01-02T08:00:00", "", "gal", "1", "", "10", "9", "1", ""),
        ("3", "3", "COMPLETED", "2024-01-02T08:00:00", "", "gallons", "2", "", "", "", "", ""),
        ("4", "L1", "RUNNING", "2024-01-02T08:00:00", "", "barrels", "2", None, "", "", "", ""),
    ], cols)
    r = {x["run_id"]: x for x in silver.silver_runs(b, refs).collect()}
    assert r["1"]["actual_volume_l"] == 1500.0
    assert r["2"]["actual_volume_l"] == pytest.approx(3785.0)
    assert r["3"]["actual_volume_l"] == pytest.approx(7570.0)
    assert r["4"]["actual_volume_l"] == 2000.0 and r["4"]["target_volume_l"] is None
    assert r["1"]["line_id"] == 1 and r["4"]["line_id"] == 1
    assert r["3"]["total_units"] is None


def test_crosswalk_hit_miss_null(spark, refs):
    from millrace.operators.conform import resolve
    df = spark.createDataFrame([("EQ-101",), ("EQ-999",), (None,)], "equipment_id STRING")
    got = rows(resolve(df, refs, equipment="equipment_id"), "equipment_id", "equipment_key")
    assert got == [("EQ-101", "EQP-101"), ("EQ-999", None), (None, None)]


def test_duplicate_seed_key_is_refused(spark, tmp_path):
    folder = tmp_path / "seeds"
    seeds.write_seed_files(spark, f"file://{folder}", {"line_xref": [("1", 1), ("1", 2)]})
    with pytest.raises(seeds.SeedError):
        seeds.load_seeds(spark, str(folder), str(tmp_path / "ref"))


def test_seed_load_roundtrip(spark, tmp_path):
    folder = tmp_path / "seeds"
    seeds.write_seed_files(spark, f"file://{folder}")
    target = f"file://{tmp_path}/ref"
    out = {r["table_name"]: (r["rows_loaded"], r["status"]) for r in
           seeds.load_seeds(spark, f"file://{folder}", target).collect()}
    assert out["equipment_xref"] == (30, "LOADED")
    assert out["line_xref"] == (12, "LOADED")
    r = seeds.read_refs(spark, target)
    assert r.line_xref.schema["line_id"].dataType.simpleString() == "int"
    assert r.equipment_xref.where("not is_active").count() == 1
    (folder / "unknown_table.csv").write_text("a\n1\n")
    with pytest.raises(seeds.SeedError, match="no such reference table"):
        seeds.load_seeds(spark, f"file://{folder}", target)


def test_loaded_seeds_are_what_is_read(spark, tmp_path):
    """A loaded table is used as it is, on any file system; a missing one is an error, never the built-in rows."""
    folder, target = f"file://{tmp_path}/one", f"file://{tmp_path}/ref"
    seeds.write_seed_files(spark, folder, {**seeds.SEED_ROWS, "line_xref": [("X", 7)]})
    seeds.load_seeds(spark, folder, target)
    assert rows(seeds.read_refs(spark, target).line_xref, "source_line_value", "line_id") == [("X", 7)]
    with pytest.raises(seeds.SeedError, match="not loaded"):
        seeds.read_refs(spark, f"file://{tmp_path}/nowhere")
    with pytest.raises(seeds.SeedError, match="no seed files"):
        seeds.load_seeds(spark, f"file://{tmp_path}/nowhere", target)


def test_every_join_column_is_checked(spark, tmp_path):
    two = [list(r) for r in seeds.EQUIPMENT_XREF_ROWS[:2]]
    two[1][2] = two[0][2]
    seeds.write_seed_files(spark, f"file://{tmp_path}/s", {"equipment_xref": [tuple(r) for r in two]})
    with pytest.raises(seeds.SeedError, match="sap_asset_number"):
        seeds.load_seeds(spark, f"file://{tmp_path}/s", f"file://{tmp_path}/r")


def test_seed_schema_check(spark):
    df = spark.createDataFrame([("1", "1", "x")], "source_line_value STRING, line_id STRING, extra STRING")
    out = seeds.conform_to_schema(df, seeds.SEED_SCHEMAS["line_xref"], "line_xref")
    assert out.columns == ["source_line_value", "line_id"]
    with pytest.raises(seeds.SeedError):
        seeds.conform_to_schema(df.drop("line_id"), seeds.SEED_SCHEMAS["line_xref"], "line_xref")


def test_expectations_null_is_violation_and_fail_raises(spark):
    df = spark.createDataFrame([(1, None), (2, 3), (None, 1)], "a INT, b INT")
    rules = [Expectation("a_pos", "a > 0", "drop"), Expectation("b_small", "b < 2", "warn"),
             Expectation("a_present", "a IS NOT NULL", "fail")]
    rep = {r["rule"]: r["violations"] for r in expect.report(df, rules, "t").collect()}
    assert rep == {"a_pos": 1, "b_small": 2, "a_present": 1}
    assert expect.apply(df, rules).count() == 2
    with pytest.raises(ExpectationFailed):
        expect.enforce(df, rules, "t")


def test_registry_clean(spark, refs):
    cols = "equipment_id STRING, name STRING, manufacturer STRING, model STRING, location STRING, type STRING, line STRING, status STRING, criticality STRING, install_date STRING, last_maintenance STRING, specs STRING"
    b = spark.createDataFrame([
        ("EQ-1005", "n", "m", "x", "loc", "CIP UNIT", "Line 2", "RUNNING", "c", "05/01/2003", "05-Jan-2004", '{"speed_bpm": 5}'),
        ("1006", "n", "m", "x", "loc", "capping machine", "3", "STOPPED", "a", "25/01/2003", "2004-01-05", "free text"),
    ], cols)
    r = {x["equipment_key"]: x for x in silver.registry_clean(b, refs).collect()}
    assert r["EQP-1005"]["criticality"] == "C" and r["EQP-1005"]["line_id"] == 2
    assert r["EQP-1005"]["install_date"] is None and r["EQP-1005"]["install_date_ambiguous"]
    assert r["EQP-1006"]["equipment_type"] == "Capping Machine"
    assert r["EQP-1006"]["specs"] is None and r["EQP-1006"]["specs_raw"] == "free text"
    assert "status" not in silver.registry_clean(b, refs).columns


def test_observe_counts_violations(spark):
    df = spark.createDataFrame([(1,), (None,), (3,)], "a INT")
    observed, obs = expect.observe(df, [Expectation("a_present", "a IS NOT NULL", "warn")], "t")
    observed.collect()
    assert obs.get == {"rows": 3, "a_present": 1}
