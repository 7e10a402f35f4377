"""Every registered query against its DuckDB oracle on the smallest fixture tables."""

from __future__ import annotations

import pytest

import __spark_entry__ as entry
from conftest import SF_SMALL
from oracle_compare import compare, duck

from fleetlens.plans import catalog

QUERIES = {k: v for k, v in entry.queries().items() if k in catalog.all_queries()}
ORACLES = {k: v for k, v in entry.oracle_sql().items() if k in QUERIES}


def test_every_query_has_an_oracle_unless_declared_rows_only():
    from fleetlens.plans.catalog import ROWS_ONLY

    assert set(ORACLES) == set(QUERIES) - ROWS_ONLY


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_oracle(spark, con, name):
    res = compare(QUERIES[name](spark, SF_SMALL), ORACLES[name], con)
    assert res["ok"], res


def test_entry_runs(spark):
    df = entry.entry(spark)
    assert df.columns == ["pu_borough", "do_borough", "trips", "avg_total"]
    assert df.count() > 0


def test_layout_partition_rows_counts_every_row_once(spark):
    from fleetlens.plans import catalog

    rows = QUERIES["layout_partition_rows"](spark, SF_SMALL).collect()
    assert [r.partition for r in rows] == list(range(catalog.LAYOUT_PARTITIONS))
    assert sum(r.rows for r in rows) == catalog.trips(spark, SF_SMALL).count()
    # a day is a key of its own: no partition stands out
    assert max(r.rows for r in rows) < 3 * sum(r.rows for r in rows) / len(rows)
