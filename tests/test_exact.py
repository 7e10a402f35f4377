"""Sums of doubles: the same bits in any row order, and means rounded as a person reads them."""

from __future__ import annotations

import math
import random
from decimal import ROUND_HALF_UP, Decimal

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from fleetlens import functions as fx
from fleetlens.operators import aggregates, joins, routes


def total_and_mean(spark, values, parts, digits=2, kind="double"):
    df = spark.createDataFrame([(v,) for v in values], f"x {kind}").repartition(parts)
    sums = df.agg(fx.partial_sum(df, "x").alias("s"), F.count("x").alias("n"))
    return sums.select(fx.sum_of(sums, "s"), fx.mean_of(sums, "s", "n", digits)).first()


def text_sum(values):
    return sum((Decimal(repr(v)) for v in values if v is not None), Decimal(0))


def test_any_order_and_partitioning_gives_the_same_bits(spark):
    rng = random.Random(7)
    values = [rng.uniform(-1, 1) * 10 ** rng.randint(-12, 15) for _ in range(4000)] + [0.1] * 1000 + [1e-20, -3e-30]
    seen = set()
    for parts in (1, 3, 16):
        rng.shuffle(values)
        seen.add(tuple(total_and_mean(spark, values, parts)))
    assert len(seen) == 1
    total, mean = seen.pop()
    assert math.isclose(total, float(text_sum(values)), rel_tol=1e-15)
    want = (text_sum(values) / len(values)).quantize(Decimal("0.01"), ROUND_HALF_UP)
    assert mean == float(want)


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.floats(-1e17, 1e17, allow_nan=False) | st.none(), max_size=30))
def test_sums_equal_the_sum_of_the_decimal_texts(spark, values):
    values = [v if v is None or v == 0 or abs(v) > 1e-18 else 0.0 for v in values]
    total, _ = total_and_mean(spark, values, 3)
    given_values = [v for v in values if v is not None]
    if not given_values:
        assert total is None
    else:
        assert math.isclose(total, float(text_sum(given_values)), rel_tol=1e-15, abs_tol=1e-34)


@pytest.mark.parametrize(
    "values, mean",
    [
        ([1.005], 1.01),
        ([-1.005], -1.01),
        ([1.0, 1.0, 1.015], 1.01),  # 1.005 exactly, though no double is
        ([1.005] * 6, 1.01),
        ([1e17], 1e17),
        ([9e18, -9e18, 1.0], 0.33),
        ([None, None], None),
        ([], None),
        ([5e-324], 0.0),
    ],
)
def test_means_round_half_away_from_zero(spark, values, mean):
    assert total_and_mean(spark, values, 2)[1] == mean


def test_values_that_are_no_decimals(spark):
    assert math.isnan(total_and_mean(spark, [1.0, math.nan], 2)[0])
    assert total_and_mean(spark, [1.0, math.inf], 2) == (math.inf, math.inf)
    assert math.isnan(total_and_mean(spark, [math.inf, -math.inf], 2)[0])
    assert total_and_mean(spark, [1e300, 1.0], 2)[0] == 1e300
    assert total_and_mean(spark, [9e17] * 500, 4)[0] == 4.5e20  # beyond 19 digits before the point


def test_integer_float_and_decimal_columns(spark):
    assert total_and_mean(spark, [1, 2, 2], 2, kind="bigint") == (5.0, 1.67)
    assert total_and_mean(spark, [Decimal("1.005")], 1, kind="decimal(10,3)") == (1.005, 1.01)
    assert total_and_mean(spark, [0.1, 0.2], 2, kind="float") == (0.3, 0.15)


def test_merged_partial_sums_equal_one_sum(spark):
    rng = random.Random(3)
    df = spark.createDataFrame([(i % 7, rng.uniform(0, 1e6)) for i in range(2000)], "k int, x double")
    once = df.agg(fx.partial_sum(df, "x").alias("s"))
    per_key = df.groupBy("k").agg(fx.partial_sum(df, "x").alias("s"))
    twice = per_key.agg(fx.merged_sum(per_key, "s").alias("s"))
    assert once.select(fx.sum_of(once, "s")).first() == twice.select(fx.sum_of(twice, "s")).first()


def test_reports_do_not_depend_on_row_order(spark, zones):
    import datetime as dt

    rng = random.Random(11)
    schema = (
        "vendor_id int, pickup_date date, pu_location_id int, do_location_id int, payment_method string, "
        "trip_distance double, fare_amount double, total_amount double"
    )
    rows = [
        (i % 2, dt.date(2024, 1, 1 + i % 3), i % 4, i % 3, "card", rng.uniform(0, 30), rng.uniform(1, 99), rng.uniform(1, 99))
        for i in range(600)
    ]
    answers = []
    for parts in (1, 7):
        rng.shuffle(rows)
        trips = spark.createDataFrame(rows, schema).repartition(parts)
        reports = [
            aggregates.daily_totals(trips),
            aggregates.avg_fare_by_vendor(trips),
            joins.borough_flows(trips, zones),
            routes.route_daily(trips),
            routes.route_rollup(trips, zones),
        ]
        answers.append([sorted(map(tuple, r.collect())) for r in reports])
    assert answers[0] == answers[1]
