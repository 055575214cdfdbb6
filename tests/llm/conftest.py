import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from llm_help import DOC_SCHEMA, SF  # noqa: E402

from millrace.llm.common import importable_on_workers  # noqa: E402


@pytest.fixture(autouse=True)
def _workers(spark):
    importable_on_workers(lambda s: None)(spark)


@pytest.fixture(scope="session")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Nulls in every column, empty and long texts, ties and repeated rows, and columns with names the operators use."""
    passage = " ".join(f"w{i}" for i in range(60))
    rows = [(1, passage, "en", "a", 5), (2, passage, "en", "a", 5), (2, passage, "en", "a", 5), (3, None, None, None, None),
            (None, "", "en", "b", 0), (None, passage + " end", "en", None, 9), (4, "x", "en", "b", 1), (5, " \t\n", "en", "c", 3),
            (6, 'token = "24be64439e3e49cf46b2d7c90f3602a3d0b907ff" ' + "long text " * 30_000, "en", "c", 7),
            (7, "été ßtraße 日本 🎉 " * 30, "fr", "d", 8), (7, "another text of the same id", "fr", "d", 8)]
    plain = spark.createDataFrame(rows, DOC_SCHEMA)
    clash = {c: f"'{c}'" for c in ("spans", "size", "key", "near_key", "toxic_score", "mix_size", "set_aside", "row_no", "kind", "hub", "label")}
    return plain.selectExpr("*", *(f"{v} AS {c}" for c, v in clash.items()))
