from __future__ import annotations

import random

from pyspark.sql import functions as F

from fleetlens.operators import windows
from fleetlens.plans.inspect import plan_text


def _rows(df, *cols):
    return sorted(tuple(r[c] for c in cols) for r in df.collect())


def test_rank_keeps_ties_beyond_n(spark):
    df = spark.createDataFrame(
        [("A", "z1", 10), ("A", "z2", 9), ("A", "z3", 9), ("A", "z4", 9), ("A", "z5", 1), ("B", "y1", 5)],
        "g string, z string, count bigint",
    )
    out = windows.top_n_per_group(df, "g", "count", 3)
    assert _rows(out, "g", "z", "rank") == [
        ("A", "z1", 1), ("A", "z2", 2), ("A", "z3", 2), ("A", "z4", 2), ("B", "y1", 1)
    ]
    assert "WindowGroupLimit" in plan_text(out, "simple")


def _series(spark, n, seed=7, dup_keys=False):
    rnd = random.Random(seed)
    rows = [(i // 3 if dup_keys else i, i, rnd.randint(0, 1000)) for i in range(n)]
    return spark.createDataFrame(rows, "k bigint, tie bigint, v bigint")


def test_running_total_dist_equals_single_window(spark):
    df = _series(spark, 500, dup_keys=True)
    order = [F.desc("k"), F.asc("tie")]
    plain = windows.running_total_single(df, order, "v")
    dist = windows.running_total(df, order, "v", partitions=7)
    assert _rows(dist, "k", "tie", "v", "running_total") == _rows(plain, "k", "tie", "v", "running_total")


def test_running_total_dist_with_more_partitions_than_rows(spark):
    df = _series(spark, 5)
    order = [F.asc("k")]
    dist = windows.running_total(df, order, "v", partitions=16)  # most range partitions empty
    plain = windows.running_total_single(df, order, "v")
    assert _rows(dist, "k", "running_total") == _rows(plain, "k", "running_total")


def test_rolling_mean_dist_equals_single_window_across_block_halos(spark):
    df = _series(spark, 200)
    order = ["k"]
    plain = windows.rolling_mean_single(df, order, "v", "avg7", 7, 2)
    for block in (7, 10, 64, None):
        dist = windows.rolling_mean(df, order, "v", "avg7", 7, 2, partitions=5, block_rows=block)
        assert _rows(dist, "k", "avg7") == _rows(plain, "k", "avg7"), block


def test_rolling_first_rows_are_partial_frames(spark):
    df = spark.createDataFrame([(i, float(i)) for i in range(1, 10)], "k int, v double")
    out = {r.k: r.avg for r in windows.rolling_mean(df, ["k"], "v", "avg", 7, 3, partitions=3).collect()}
    assert out[1] == 1.0 and out[2] == 1.5 and out[7] == 4.0 and out[9] == 6.0


def test_distributed_forms_have_no_single_task_row_window(spark):
    df = _series(spark, 100)
    for out in (
        windows.running_total(df, [F.asc("k")], "v", partitions=4),
        windows.rolling_mean(df, ["k"], "v", "a", 7, 0, partitions=4),
    ):
        text = plan_text(out, "simple")
        # the per-row window is partitioned (by range partition or row block); the only
        # SinglePartition exchange carries the per-partition totals (at most 4 rows)
        assert "Exchange hashpartitioning(_part" in text or "Exchange hashpartitioning(_block" in text
        assert text.count("Exchange SinglePartition") <= 1


def test_distributed_windows_on_empty_and_single_row_inputs(spark):
    empty = spark.createDataFrame([], "k int, v bigint")
    assert windows.running_total(empty, [F.asc("k")], "v").count() == 0
    assert windows.rolling_mean(empty, ["k"], "v", "m", 7, 0).count() == 0
    one = spark.createDataFrame([(1, 5)], "k int, v bigint")
    assert [r.running_total for r in windows.running_total(one, [F.asc("k")], "v").collect()] == [5]
    assert [r.m for r in windows.rolling_mean(one, ["k"], "v", "m", 7, 1).collect()] == [5.0]
