from __future__ import annotations

from pyspark.sql import functions as F

from conftest import KEPT
from fleetlens.operators import clean
from fleetlens.plans.inspect import plan_text
from fleetlens.sources import trips as trip_io


def test_clean_keeps_exactly_the_valid_rows(raw_trips):
    got = [r.label for r in clean.clean_trips(raw_trips, carry=("label",)).select("label").collect()]
    assert sorted(got) == sorted(KEPT)  # both equal duplicates stay: cleaning does not dedupe


def test_pickup_upper_end_is_inclusive_and_makes_an_april_month(raw_trips):
    out = clean.clean_trips(raw_trips)
    months = {r.pickup_month for r in out.select("pickup_month").distinct().collect()}
    assert "2024-04" in months
    assert out.filter(F.col("pickup_ts") > F.lit("2024-04-01 00:00:00").cast("timestamp_ntz")).count() == 0


def test_subsecond_parts_are_truncated_before_the_difference(raw_trips, spark):
    std = clean.with_duration(clean.standardize(raw_trips, ("label",)))
    by = {r.label: r.trip_minutes for r in std.select("label", "trip_minutes").collect()}
    assert by["sixty_point_three_s"] == 1.0  # 60.3 s -> 60 whole seconds -> 1.0 min -> dropped (open bound)
    assert by["subsecond_trunc"] == 2.0  # .9 -> .1 two minutes later is 119.2 s, counted as 120 s


def test_derived_columns(raw_trips):
    out = {(r.pickup_date.isoformat(), r.payment_type): r for r in clean.clean_trips(raw_trips).collect()}
    card = out[("2024-01-05", 1)]
    assert card.trip_minutes == 30.0
    assert card.avg_mph == 10.0  # 5 miles in 30 minutes, from the rounded duration
    assert card.tip_pct == 20.0
    assert card.payment_method == "card"
    assert card.day_of_week == "Fri"
    assert card.pickup_hour == 8
    cash = out[("2024-01-05", 2)]
    assert cash.tip_pct is None and cash.payment_method == "cash"
    methods = {r.payment_type: r.payment_method for r in out.values()}
    assert methods[None] == "other" and methods[0] == "other"
    assert methods[3] == "no charge" and methods[4] == "dispute"


def test_reconcile_is_one_pass_and_adds_up(raw_trips):
    r = clean.clean_reconcile(raw_trips).first()
    assert r.rows_in == len(raw_trips.collect())
    assert r.rows_kept == len(KEPT)
    assert r.rows_dropped == r.rows_in - r.rows_kept


def test_partitioned_write_read_and_month_pruning(spark, raw_trips, scratch):
    path = f"{scratch}/trips_clean"
    clean.write_clean(clean.clean_trips(raw_trips.drop("label")), path)
    back = trip_io.read_clean_trips(spark, path)
    assert dict(back.dtypes)["pickup_month"] == "string"
    assert back.count() == len(KEPT)
    one = back.filter(F.col("pickup_month") == "2024-03")
    assert "PartitionFilters: [isnotnull(pickup_month" in plan_text(one, "simple")
    assert one.count() == 4


def test_source_filter_reaches_the_parquet_scan(spark, raw_trips, scratch):
    path = f"{scratch}/raw"
    raw_trips.drop("label").write.parquet(path)
    out = clean.clean_trips(trip_io.read_raw_trips(spark, path + "/*.parquet")).select("pickup_date")
    text = plan_text(out, "formatted")
    assert "GreaterThanOrEqual(tpep_pickup_datetime,2024-01-01T00:00)" in text
    assert "LessThanOrEqual(tpep_pickup_datetime,2024-04-01T00:00)" in text
    assert "GreaterThan(fare_amount,0.0)" in text
    # only the columns the filter and the projection need are read
    read = [ln for ln in text.splitlines() if "ReadSchema" in ln][0]
    assert "VendorID" not in read and "tip_amount" not in read


def test_trip_jobs_end_to_end_on_taxi_shaped_files(spark, raw_trips, zones, scratch):
    from conftest import KEPT
    from fleetlens.plans import trip_reports

    raw = raw_trips.drop("label")
    raw.write.parquet(f"{scratch}/yellow_tripdata_2024-01.parquet")
    raw.write.parquet(f"{scratch}/yellow_tripdata_2024-02.parquet")
    rec = trip_reports.ingest(spark, f"{scratch}/yellow_tripdata_2024-*.parquet", f"{scratch}/clean").first()
    assert (rec.rows_in, rec.rows_kept) == (2 * raw.count(), 2 * len(KEPT))
    out = trip_reports.reports(spark, f"{scratch}/clean", zones)
    assert sum(r.trips for r in out["daily_totals"].collect()) == 2 * len(KEPT)
    assert out["payment_mix"].columns[1:] == ["card", "cash", "no charge", "dispute", "other"]
    for name, df in out.items():
        df.write.format("noop").mode("overwrite").save()  # every report runs
