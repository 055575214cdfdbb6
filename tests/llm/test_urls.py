import duckdb
from pyspark.sql import functions as F

from millrace.llm import urls
from millrace.llm.queries import ORACLES, QUERIES

from llm_help import SF


def test_query_matches_sql(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW pages AS SELECT * FROM read_parquet('{SF}/pages.parquet')")
    expected = con.execute(ORACLES["op6_url_filter"]).fetchall()
    assert sorted(map(str, map(tuple, QUERIES["op6_url_filter"](spark, SF).collect()))) == sorted(map(str, expected))


def test_entries_count_only_while_active(spark):
    events = spark.createDataFrame([
        ("domain", "example.org", True, 10), ("host", "good.example.org", False, 20), ("path", "bad.com/a/b", True, 5), ("path", "bad.com/a/b", False, 200),
        ("host", "bad.com", True, 100), ("host", "bad.com", False, 100), (None, "x", True, 1), ("host", None, True, 1)],
        "scope string, pattern string, blocked boolean, day int")
    captures = spark.createDataFrame([
        (1, "http://www.EXAMPLE.org/x", 9), (2, "http://www.example.org/x", 10), (3, "https://u:p@good.example.org:80/", 19), (4, "http://good.example.org", 25),
        (5, "http://bad.com/a/b/c?q#f", 6), (6, "http://bad.com/a/bc", 6), (7, "http://bad.com/a/b", 300), (8, "http://bad.com/", 300),
        (9, None, 5), (10, "not a url", 5), (11, "http://bad.com/", None), (11, "http://bad.com/", None)],
        "page_id long, url string, day int").withColumn("entry", F.lit("clash")).withColumn("span", F.lit(1))
    got = urls.filter_urls(captures, events)
    assert got.columns[:5] == captures.columns
    blocked = sorted(r["page_id"] for r in got.collect() if r["url_blocked"])
    assert blocked == [2, 3, 5, 8] and got.count() == 12
    assert urls.filter_urls(captures, events.limit(0)).where("url_blocked").count() == 0
    assert urls.filter_urls(captures.limit(0), events).count() == 0
