"""The driver's contract."""

from __future__ import annotations

import subprocess
import sys
from pathlib import Path

import pytest

import __spark_entry__ as entry

ROOT = Path(__file__).resolve().parents[1]


def test_each_sql_has_its_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert len(entry.queries()) >= 150


def test_flagship(spark):
    if not Path("/root/testdata/sf0.001").exists():
        pytest.skip("needs the test tables")
    rows = entry.entry(spark)
    assert rows.columns == ["o_orderkey", "o_orderpriority", "o_orderstatus", "o_totalprice"]
    assert all(r["count"] <= 20 for r in rows.groupBy("o_orderpriority", "o_orderstatus").count().collect())


def test_engine_imports_without_the_training_operators():
    code = "import sys; sys.modules['tessaria.llm'] = None\ntry:\n import __spark_entry__\nexcept ModuleNotFoundError as e:\n print(e.name)\nelse:\n print(any(n.startswith('op') for n in __spark_entry__.queries()))"
    done = subprocess.run([sys.executable, "-c", code], cwd=ROOT, capture_output=True, text=True)
    assert done.stdout.strip() == "False", done.stderr[-500:]
