"""Plan-shape guards: what must (not) appear in the physical plans at any scale."""

from __future__ import annotations

import re

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from conftest import SF_SMALL
from fleetlens.operators import windows
from fleetlens.plans import catalog
from fleetlens.plans.inspect import exchanges, plan_text

QUERIES = {k: v for k, v in entry.queries().items() if k in catalog.all_queries()}
# Single-partition exchanges allowed per key: each carries one partial row per input
# partition (a global count / aggregate) or the per-partition offset table (<= partitions rows).
SINGLE_OK = {
    "scan_count": 1, "clean_reconcile": 1, "pickup_zone_distinct": 1, "layout_skew": 2,
    "quality_report": 1, "daily_rolling": 1, "daily_rolling_dist": 1, "running_total": 1,
    "running_total_dist": 1,
}


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_registered_plans_stay_in_the_jvm_and_never_funnel_rows(spark, name):
    text = plan_text(QUERIES[name](spark, SF_SMALL), "simple")
    assert not re.search(r"BatchEvalPython|ArrowEvalPython|FlatMapGroupsInPandas", text)
    assert text.count("Exchange SinglePartition") <= SINGLE_OK.get(name, 0)
    # a window without PARTITION BY may only run over the per-partition offset table
    for line in text.splitlines():
        if re.search(r"\bWindow \[", line) and not re.search(r"\], \[[^\]]+\]", line):
            assert re.search(r"_rows#|_sum#|_part#", line), line


def test_range_index_splits_a_hot_order_value(spark):
    # 40 % of the rows share the leading order value; the tie-break spreads them
    rows = [(0 if i % 5 < 2 else i, i) for i in range(5000)]
    df = spark.createDataFrame(rows, "k int, tie int")
    indexed = windows.range_indexed(df, [F.asc("k"), F.asc("tie")], partitions=8)
    sizes = [r["count"] for r in indexed.groupBy("_part").count().collect()]
    assert max(sizes) < 0.25 * sum(sizes)


@pytest.mark.parametrize("name", ["clean_trips", "borough_flows", "route_rollup", "top_zones_per_borough"])
def test_trip_keys_agree_without_broadcasts(spark, name):
    rows = lambda: sorted(map(str, QUERIES[name](spark, SF_SMALL).collect()))
    want = rows()
    saved = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert rows() == want
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", saved)


def test_no_probe_and_no_forced_exchange_in_clean_trips(spark):
    text = plan_text(QUERIES["clean_trips"](spark, SF_SMALL), "simple")
    assert "GlobalLimit" not in text and "REPARTITION" not in text
