import json

from pyspark.sql.types import DateType, DoubleType, IntegerType, StringType, StructType

from millrace.sources import rescue

SCHEMA = StructType().add("name", StringType()).add("speed", IntegerType()).add("power", DoubleType()).add("since", DateType())


def read(reader, spark, bodies):
    df = spark.createDataFrame(list(enumerate(bodies)), "id INT, body STRING")
    out = reader(df, "body", SCHEMA, ["id"]).orderBy("id").collect()
    return [((r["name"], r["speed"], r["power"], str(r["since"])), json.loads(r["_rescued_data"]) if r["_rescued_data"] else None)
            for r in out]


def test_json_fields_that_do_not_fit_are_rescued_by_name(spark):
    got = read(rescue.json_fields, spark, [
        '{"name": "a", "speed": 7, "power": 1.5, "since": "2024-01-02"}',
        '{"name": "b", "speed": "fast", "extra": {"x": [1, 2]}}',
        '{"name": "c", "speed": 7.5, "power": null, "note": null}',
        '{"name": {"first": "d"}, "speed": "12", "since": "soon"}',
        '{"name": "cut", "speed": 1',
        '[1, 2]', '{"name": "x", "name": "y"}', '', None, '{}'])
    assert got[0] == (("a", 7, 1.5, "2024-01-02"), None)
    assert got[1] == (("b", None, None, "None"), {"speed": "fast", "extra": {"x": [1, 2]}})
    assert got[2] == (("c", None, None, "None"), {"speed": 7.5, "note": None})
    assert got[3] == (('{"first":"d"}', 12, None, "None"), {"since": "soon"})
    for at, text in ((4, '{"name": "cut", "speed": 1'), (5, "[1, 2]"), (6, '{"name": "x", "name": "y"}'), (7, "")):
        assert got[at] == ((None, None, None, "None"), {"_record": text})
    assert got[8] == got[9] == ((None, None, None, "None"), None)


def test_csv_fields_that_do_not_fit_are_rescued_by_name(spark):
    got = read(rescue.csv_fields, spark, [
        "a,7,1.5,2024-01-02",
        'b,7.5,high,2024-01-02,more,"x, y"',
        '"c, d",3',
        "e,,,",
        "f,1,2,2024-01-02,",
        None])
    assert got[0] == (("a", 7, 1.5, "2024-01-02"), None)
    assert got[1] == (("b", None, None, "2024-01-02"), {"speed": "7.5", "power": "high", "_c4": "more", "_c5": '"x, y"'})
    assert got[2] == (("c, d", 3, None, "None"), {"_fields": "2"})
    assert got[3] == (("e", None, None, "None"), None)
    assert got[4] == (("f", 1, 2.0, "2024-01-02"), {"_c4": ""})
    assert got[5] == ((None, None, None, "None"), None)


def test_very_long_records_are_read_whole(spark):
    note = "x" * 200_000
    (_, held), = read(rescue.json_fields, spark, [json.dumps({"name": "a", "note": note})])
    assert held == {"note": note}
    (_, held), = read(rescue.csv_fields, spark, ["a,1,2,2024-01-02," + ",".join(["y"] * 5_000) + f',"{note}"'])
    assert len(held) == 5_001 and held["_c5004"] == f'"{note}"'
