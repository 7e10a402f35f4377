from __future__ import annotations

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from fleetlens.operators import clean, layout, quality


def _trips(raw):
    return clean.clean_trips(raw.drop("label"))


def test_fail_on_raises_and_session_survives(spark, raw_trips):
    t = _trips(raw_trips)
    checked = quality.fail_on(t, F.col("fare_amount") > 900, "fare looks wrong")
    with pytest.raises(PySparkException) as err:
        checked.select("fare_amount", "check").distinct().collect()
    assert "fare looks wrong" in str(err.value)
    # a check pruned from the output never runs
    assert checked.select("fare_amount").count() == t.count()
    # the session is usable afterwards
    assert spark.range(3).count() == 3


def test_report_counts_equal_quarantine(raw_trips):
    raw = clean.enriched_trips(raw_trips.drop("label"))
    rules = quality.trip_rules(900)
    report = {r.rule: r.bad_rows for r in quality.quality_report(raw, rules).collect()}
    quarantined = quality.quality_quarantine(raw, rules)
    for name in rules:
        assert report[name] == quarantined.filter(F.array_contains(F.split("violations", ","), name)).count()
    assert report["fare_over_limit"] == 1
    assert report["missing_payment"] == 1
    good, bad = quality.quality_split(raw, rules)
    assert good.count() + bad.count() == raw.count()


def test_rows_per_partition_lists_empty_partitions(spark):
    df = spark.createDataFrame([("a",)] * 10 + [("b",)] * 2, "k string").repartition(8, "k")
    rows = layout.rows_per_partition(df).collect()
    assert len(rows) == 8
    assert sorted(r.rows for r in rows if r.rows) == [2, 10]
    assert sum(1 for r in rows if r.rows == 0) == 6


def test_key_skew_report(spark):
    df = spark.createDataFrame([("card",)] * 8 + [("cash",)] * 2 + [(None,)] * 2 + [("x",)], "k string")
    r = layout.key_skew(df, "k").first()
    assert (r.keys, r.rows, r.max_rows) == (4, 13, 8)
    assert r.median_rows == 2.0 and r.max_to_median == 4.0
    assert abs(r.max_share - 8 / 13) < 1e-12


def test_hash_layout_sorts_within_partitions(raw_trips):
    t = _trips(raw_trips)
    out = layout.hash_layout(t, 4, "payment_method", ["pickup_ts", "trip_distance"])
    assert out.rdd.getNumPartitions() == 4
    for part in out.select("pickup_ts", "trip_distance").rdd.glom().collect():
        keys = [(r.pickup_ts, r.trip_distance) for r in part]
        assert keys == sorted(keys)


def test_failing_check_fails_the_job_and_the_session_goes_on(spark, raw_trips):
    t = _trips(raw_trips)
    with pytest.raises(PySparkException):
        quality.fail_on(t, F.col("fare_amount") > 900, "fare above 900").select("check").distinct().collect()
    assert t.count() == 11


def test_a_hash_layout_keeps_a_key_in_one_partition(spark):
    df = spark.range(5000).selectExpr("cast(id % 37 as string) as k", "if(id % 11 = 0, null, cast(id % 13 as int)) as n")
    for key, values in (("k", 37), ("n", 14)):
        laid = layout.hash_layout(df, 16, key)
        rows = layout.rows_per_partition(laid, 16).collect()
        assert [r.partition for r in rows] == list(range(16)) and sum(r.rows for r in rows) == 5000
        held = layout.partitions_per_key(laid, key).collect()
        assert len(held) == values and {r.partitions for r in held} == {1} and sum(r.rows for r in held) == 5000
    spread = layout.partitions_per_key(df.repartition(16), "k").collect()
    assert min(r.partitions for r in spread) > 1
