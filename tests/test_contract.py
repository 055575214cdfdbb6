"""Driver contract, oracle agreement on the smallest scale factor, and plan checks."""

import decimal
import math
import os

import duckdb
import pytest

import __spark_entry__ as E

from library_help import SF_SMALL

STREAMING = {"bronze_ingest", "bronze_json_ingest", "bronze_rescue", "stream_silver_readings", "stream_scd2", "seed_load",
             "stream_silver_runs", "stream_expectation_metrics",
             "stream_dedupe", "vibration_windows", "gold_refresh_late", "bronze_all_string"}
TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events"]


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns == ["line_id", "production_date", "availability", "performance", "quality", "oee"]
    assert df.count() > 0


def test_every_query_has_an_oracle():
    from millrace.plans.catalog import QUERIES
    from millrace.plans.oracles import ORACLES
    assert set(QUERIES) == set(ORACLES)
    assert set(E.oracle_sql()) <= set(E.queries()) and set(QUERIES) <= set(E.queries())


def test_entry_works_without_the_optional_parts(tmp_path):
    """The rest imports and registers its queries where millrace.llm and corpus_pipeline are not installed."""
    import shutil
    import subprocess
    import sys
    root = os.path.dirname(os.path.abspath(E.__file__))
    shutil.copytree(os.path.join(root, "millrace"), tmp_path / "millrace", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(os.path.join(root, "__spark_entry__.py"), tmp_path)
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    said = subprocess.run([sys.executable, "-c", "import __spark_entry__ as e; print(*sorted(e.queries()))"], cwd=tmp_path,
                          env=env, capture_output=True, text=True, check=True).stdout.split()
    assert "gold_oee_daily" in said and "pipeline" not in said and not any(q.startswith("op1") for q in said)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{os.path.join(SF_SMALL, t + '.parquet')}')")
    return con


def _norm(v):
    if isinstance(v, decimal.Decimal):
        return float(v)
    if isinstance(v, float) and math.isnan(v):
        return "NaN"
    return v


def _key(row):
    return tuple((x is None, str(type(x)), x if x is not None else 0) for x in row)


# One representative key per module; ``tools/check_oracles.py`` runs every key.
REPRESENTATIVE = ["gold_oee_daily", "gold_reliability", "gold_changeover", "gold_first_pass_yield",
                  "gold_critical_work_orders", "silver_readings", "quarantine_balance", "parse_multi_ts",
                  "expectation_report", "scd2_dim", "scd2_asof_join", "unacked_alarms", "changeover_net",
                  "batch_to_run", "overlap_pairs", "kpi_scorecard", "q_param_scrap_corr",
                  "q_fill_weight_trend", "registry_clean", "specs_variant", "id_scheme_examples",
                  "vibration_batch", "tag_completeness"]


@pytest.mark.parametrize("name", REPRESENTATIVE)
def test_query_matches_oracle(spark, duck, name):
    df = E.queries()[name](spark, SF_SMALL)
    cols = df.columns
    got = [tuple(_norm(x) for x in r) for r in df.collect()]
    cur = duck.execute(E.oracle_sql()[name])
    ocols = [d[0] for d in cur.description]
    exp = [tuple(_norm(x) for x in r) for r in cur.fetchall()]
    assert sorted(cols) == sorted(ocols)
    idx = [ocols.index(c) for c in cols]
    assert sorted(got, key=_key) == sorted((tuple(r[i] for i in idx) for r in exp), key=_key)


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_plans_stay_in_the_jvm(spark):
    for name in ["gold_oee_daily", "silver_readings", "changeover_net", "scd2_asof_join", "q_fill_weight_trend"]:
        p = _plan(E.queries()[name](spark, SF_SMALL))
        assert "PythonUDF" not in p and "BatchEvalPython" not in p and "ArrowEvalPython" not in p, name


def test_oee_plan_broadcasts_crosswalks_and_prunes_columns(spark):
    df = E.queries()["gold_oee_daily"](spark, SF_SMALL)
    text = df._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in text
    scans = [l for l in text.split("\n") if "FileScan parquet" in l]
    assert scans and not any("o_orderpriority" in l or "l_extendedprice" in l for l in scans)


def test_first_pass_yield_uses_partial_group_limit(spark):
    df = E.queries()["gold_first_pass_yield"](spark, SF_SMALL)
    df.collect()
    text = df._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in text and "Partial" in text
