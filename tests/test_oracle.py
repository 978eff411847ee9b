"""Every registered query against its DuckDB oracle, on the smallest driver tables.

The full-size check is ``python -m tests.oracle /root/testdata/sf0.01``.
"""

from __future__ import annotations

import os

import pytest

import __spark_entry__ as entry
from tests.conftest import SF_SMALL
from tests.oracle import compare, duck

pytestmark = pytest.mark.skipif(not os.path.exists(SF_SMALL), reason="driver tables missing")


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_query_matches_oracle(spark, con, name):
    result = compare(spark, con, name, entry.queries()[name], entry.oracle_sql()[name], SF_SMALL)
    assert result["columns_match"], result
    assert result["types_match"], result
    assert result["spark_rows"] == result["oracle_rows"], result
    assert result["values_match"], result
