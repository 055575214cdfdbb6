import random

from pyspark.sql import functions as F

from millrace.operators import moments

from library_help import rows

LO, HI = "1996-02-10", "1996-03-20"


def test_merged_moments_equal_corr_of_the_pairs(spark):
    rnd = random.Random(5)
    data = []
    for i in range(3000):
        x = 1e8 + rnd.gauss(0, 1)                       # a spread that plain sums of squares would lose
        line = rnd.choice([1, 1, 1, 2, None])           # a hot line, and rows without one
        data.append((line, i % 40, x, 0.3 * (x - 1e8) + rnd.gauss(0, 1)))
    data += [(1, 3, None, 1.0), (1, 3, 1.0, None), (2, 3, float("nan"), 1.0)]
    pairs = spark.createDataFrame(data, "line INT, day INT, x DOUBLE, y DOUBLE")
    daily = moments.co_moments(pairs, ["line", "day"], "x", "y")
    assert daily.agg(F.sum("n")).first()[0] == 3000
    good = pairs.where("x IS NOT NULL AND y IS NOT NULL AND NOT isnan(x)")
    for lo, hi in [(0, 39), (7, 19), (4, 4)]:
        got = {r["line"]: r for r in moments.merge(daily.where(F.col("day").between(lo, hi)), ["line"])
               .withColumn("r", moments.correlation()).collect()}
        want = good.where(F.col("day").between(lo, hi)).groupBy("line").agg(
            F.count("*").alias("n"), F.corr("x", "y").alias("r")).collect()
        assert len(got) == len(want)
        for w in want:
            assert got[w["line"]]["n"] == w["n"] and abs(got[w["line"]]["r"] - w["r"]) < 1e-6
    whole = moments.merge(daily, []).withColumn("r", moments.correlation()).first()
    assert whole["n"] == 3000 and abs(whole["r"] - good.select(F.corr("x", "y")).first()[0]) < 1e-6
    # merging in two steps is merging at once
    twice = moments.merge(moments.merge(daily, ["line"]), []).first()
    assert abs(twice["cxy"] - whole["cxy"]) < 1e-4


def test_no_correlation_without_spread(spark):
    pairs = spark.createDataFrame([("one", 1.0, 2.0), ("flat", 1.0, 2.0), ("flat", 1.0, 3.0)], "g STRING, x DOUBLE, y DOUBLE")
    m = moments.co_moments(pairs, ["g"], "x", "y")
    assert rows(m.select("g", moments.correlation().alias("r"))) == [("flat", None), ("one", None)]
    assert rows(moments.merge(moments.co_moments(pairs.limit(0), ["g"], "x", "y"), ["g"])) == []
    assert rows(moments.merge(moments.co_moments(pairs.limit(0), ["g"], "x", "y"), [])) == []


def test_a_range_reads_only_its_months(spark):
    from library_help import SF_SMALL
    from millrace.plans import analysis
    from millrace.plans.plant import Plant
    from millrace.streaming import ingest
    p = Plant(spark, SF_SMALL)
    path = ingest.fresh_dir(spark, "test_moments")
    analysis.store_check_moments(p.silver_quality(), p.scrap_rate_daily(), path)
    one = analysis.check_scrap_corr(spark, path, LO, HI)
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert "_period" in plan.split("PartitionFilters: ")[1].split("]")[0]
    scrap = p.scrap_rate_daily()
    checks = p.silver_quality().withColumn("production_date", F.to_date("check_ts_local")).drop("scrap_rate")
    j = checks.join(scrap, ["line_id", "production_date"]).where(F.col("production_date").between(LO, HI))
    want = j.where("value IS NOT NULL AND scrap_rate IS NOT NULL").groupBy("line_id", "parameter").agg(F.count("*"), F.round(F.corr("value", "scrap_rate"), 6))
    assert want.count() > 0
    assert rows(one.select("line_id", "parameter", "checks", F.round("corr", 6))) == rows(want)
