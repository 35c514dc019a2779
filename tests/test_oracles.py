"""Registered queries against their SQL oracles at the smallest scale factor."""

from __future__ import annotations

import os
import sys

import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

import __spark_entry__ as entry  # noqa: E402
from check_oracles import compare, connect  # noqa: E402

from strataflow.catalog.queries import QUERIES  # noqa: E402

SF_DIR = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables here")


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_oracle(spark, con, name):
    outcome = compare(spark, con, name, SF_DIR, entry.oracle_sql().get(name))
    assert outcome.startswith("ok"), outcome


def test_entry_has_rows(spark):
    assert entry.entry(spark).count() > 0
