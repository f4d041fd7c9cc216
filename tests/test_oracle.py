"""Every registered query equals its DuckDB oracle (rows, names, exact values)."""

import os
import sys

import pytest

from conftest import ROOT, SF_SMALL

sys.path.insert(0, os.path.join(ROOT, "tools"))

import __spark_entry__ as E  # noqa: E402
import oracle_check  # noqa: E402

from sitewatch.plans import catalog  # noqa: E402

NAMES = sorted(catalog.queries())


@pytest.fixture(scope="module")
def con():
    return oracle_check.duck_connect(SF_SMALL)


def test_every_query_has_oracle():
    missing = sorted(set(NAMES) - set(E.oracle_sql()))
    assert missing == []


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, con, name):
    status, detail = oracle_check.compare_one(spark, con, SF_SMALL, name)
    assert status == "OK", detail
    assert "type differences" not in detail, detail


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns[:3] == ["report_id", "site_id", "ts"]
    assert df.count() >= 0
