"""The driver contract: entry point, registered queries and their oracles."""

import os
import subprocess
import sys

import __spark_entry__ as E
from lapsewise import registry

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert "lapse_rate_pct" in df.columns and "name" not in df.columns


def test_every_query_has_an_oracle():
    q, o = E.queries(), E.oracle_sql()
    assert set(o) <= set(q)
    assert len(registry.QUERIES) >= 37
    # queries of optional parts without an oracle have tests of their own
    assert set(registry.QUERIES) - set(o) == set()


def test_queries_match_oracles_at_smallest_scale():
    """Runs every query against DuckDB at sf0.001 (a separate Spark process)."""
    res = subprocess.run(
        [sys.executable, os.path.join(ROOT, "tools", "check_oracles.py"), "/root/testdata/sf0.001", *registry.QUERIES],
        capture_output=True, text=True, timeout=1800, cwd=ROOT,
    )
    lines = [ln for ln in res.stdout.splitlines() if ln.startswith(("OK", "FAIL", "ROWS"))]
    failed = [ln for ln in lines if ln.startswith("FAIL")]
    assert not failed, "\n".join(failed)
    assert len(lines) == len(registry.QUERIES)
