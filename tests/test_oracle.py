"""Every registered query against its SQL, and the driver contract."""

from __future__ import annotations

import importlib.util
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))
import __spark_entry__ as entry  # noqa: E402

spec = importlib.util.spec_from_file_location("check_queries", ROOT / "tools" / "check_queries.py")
check = importlib.util.module_from_spec(spec)
spec.loader.exec_module(check)


@pytest.fixture(scope="module")
def db(sf_dir):
    return check.connect(sf_dir)


@pytest.mark.parametrize("name", list(entry.oracle_sql()))
def test_query_equals_sql(spark, sf_dir, db, name):
    verdict, _ = check.compare(spark, db, name, sf_dir)
    assert verdict == "ok"


@pytest.mark.parametrize("name", [name for name in entry.queries() if name not in entry.oracle_sql()])
def test_query_without_sql_gives_rows(spark, sf_dir, name):
    """SQL cannot say these; their results are compared with plain Python where they are defined."""
    frame = entry.queries()[name](spark, sf_dir)
    assert frame.columns == list(dict.fromkeys(frame.columns)) and frame.count() > 0


def test_entry(spark):
    assert entry.entry(spark).columns == ["uid", "portal_type", "score"]


def test_every_sql_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())
