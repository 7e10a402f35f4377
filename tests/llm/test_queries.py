"""The queries that SQL can express, against their DuckDB SQL."""

from __future__ import annotations

import __spark_entry__ as entry
import pytest
from brute import SF
from oracle_compare import compare, duck

ORACLES = {k: v for k, v in entry.oracle_sql().items() if k.startswith("op")}


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_oracle(spark, name):
    res = compare(entry.queries()[name](spark, SF), ORACLES[name], duck(SF))
    assert res["ok"], res
