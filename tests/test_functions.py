from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from fleetlens import functions as fx


def one(spark, expr, schema="x int", row=(1,)):
    return spark.createDataFrame([row], schema).select(expr.alias("v")).first().v


def test_gmt_text_and_epoch_millis_to_timestamps(spark):
    t = one(spark, fx.gmt_to_timestamp(F.lit("2026-09-21T22:36:47.323GMT")))
    assert t.replace(tzinfo=None) == dt.datetime(2026, 9, 21, 22, 36, 47, 323000)
    m = one(spark, fx.millis_to_timestamp(F.lit(1_700_000_000_123)))
    assert m.replace(tzinfo=None) == dt.datetime(2023, 11, 14, 22, 13, 20, 123000)


def test_seconds_between_keeps_milliseconds(spark):
    assert one(spark, fx.seconds_between_ms(F.lit(1_000), F.lit(2_250))) == 1.25


def test_labels_and_fallbacks(spark):
    assert one(spark, fx.stage_label(F.lit(7))) == "Stage 7"
    schema = "d string, n string"
    assert one(spark, fx.text_or_fallback("d", "n"), schema, (None, "name")) == "name"
    assert one(spark, fx.text_or_fallback("d", "n"), schema, ("", "name")) == "name"  # '' falls back too
    assert one(spark, fx.text_or_fallback("d", "n", 5), schema, ("description", "name")) == "descr"


def test_route_key_keeps_missing_ids_apart(spark):
    schema = "pu int, do int"
    assert one(spark, fx.route_key("pu", "do"), schema, (3, 5)) == "3->5"
    assert one(spark, fx.route_key("pu", "do"), schema, (None, 5)) == "None->5"
    assert one(spark, F.concat_ws("->", "pu", "do"), schema, (None, 5)) == "5"  # why concat_ws is not used


def test_half_up_rounding(spark):
    assert one(spark, fx.half_up(F.lit(2.5), 0)) == 3.0
    assert one(spark, fx.half_up(F.lit(0.125), 2)) == 0.13
    assert one(spark, fx.half_up(F.lit(1.004), 2)) == 1.0
    assert one(spark, fx.half_up(F.lit(-1.25), 1)) == -1.3


def test_duration_truncates_subseconds_on_both_ends(spark):
    schema = "a timestamp_ntz, b timestamp_ntz"
    row = (dt.datetime(2024, 1, 1, 0, 0, 0, 100000), dt.datetime(2024, 1, 1, 0, 1, 0, 900000))
    assert one(spark, fx.duration("a", "b", 60), schema, row) == 1.0


def test_payment_labels_and_buckets(spark):
    df = spark.createDataFrame([(c,) for c in [1, 2, 3, 4, 5, 0, None]], "c int")
    labels = [r.v for r in df.select(fx.payment_method("c").alias("v")).collect()]
    assert labels == ["card", "cash", "no charge", "dispute", "other", "other", "other"]
    d = spark.createDataFrame([(x,) for x in [0.5, 1.0, 4.99, 5.0]], "d double")
    assert [r.v for r in d.select(fx.distance_bucket("d").alias("v")).collect()] == ["short", "medium", "medium", "long"]
