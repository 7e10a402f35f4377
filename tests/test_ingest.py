"""Ingest: files of differing footers, counts taken from the write, additive reports from one scan."""

from __future__ import annotations

import glob
import json
import subprocess
import sys
import textwrap

import pytest
from pyspark.sql import functions as F

from conftest import KEPT, ROOT
from fleetlens.operators import aggregates, clean, joins, quality
from fleetlens.plans import trip_reports
from fleetlens.sources import trips as trip_io


def write(df, path):
    df.coalesce(1).write.parquet(path)


def test_files_of_int_long_and_double_ids_are_one_table(spark, raw_trips, scratch):
    raw = raw_trips.drop("label")
    ids = ["VendorID", "PULocationID", "DOLocationID"]
    for month, kind in enumerate(["int", "bigint", "double"], 1):
        write(raw.withColumns({c: F.col(c).cast(kind) for c in ids}), f"{scratch}/yellow_2024-0{month}.parquet")
    # a fourth file: a column in another case, one missing, one more
    write(
        raw.withColumnRenamed("tip_amount", "Tip_Amount").drop("passenger_count").withColumn("airport_fee", F.lit(1.25)),
        f"{scratch}/yellow_2024-04.parquet",
    )
    got = trip_io.read_raw_trips(spark, f"{scratch}/yellow_*.parquet")
    types = dict(got.dtypes)
    assert [types[c] for c in ids] == ["bigint"] * 3 and types["airport_fee"] == "double"
    n = raw.count()
    assert got.count() == 4 * n
    assert got.where("airport_fee is not null").count() == n
    rows = got.groupBy(*raw.columns).count()
    want = raw.withColumns({c: F.col(c).cast("bigint") for c in ids})
    without = want.withColumn("passenger_count", F.lit(None).cast("double"))
    all_rows = want.unionAll(want).unionAll(want).unionAll(without).groupBy(*raw.columns).count()
    assert rows.exceptAll(all_rows).isEmpty() and all_rows.exceptAll(rows).isEmpty()
    assert clean.clean_trips(got).count() == 4 * len(KEPT)


def test_agreeing_files_are_one_scan_with_pushed_filters(spark, raw_trips, scratch):
    from fleetlens.plans.inspect import plan_text

    for month in (1, 2):
        write(raw_trips.drop("label"), f"{scratch}/y{month}.parquet")
    text = plan_text(clean.clean_trips(trip_io.read_raw_trips(spark, f"{scratch}/y*.parquet")), "formatted")
    assert text.count("Scan parquet") <= 2 and "Union" not in text  # named in the tree and in its details
    assert "GreaterThan(fare_amount,0.0)" in text


@pytest.mark.parametrize("value, kind", [("seven", "string"), (7.5, "double")])
def test_an_impossible_cast_names_its_file(spark, raw_trips, scratch, value, kind):
    raw = raw_trips.drop("label")
    write(raw, f"{scratch}/a.parquet")
    write(raw.withColumn("PULocationID", F.lit(value).cast(kind)), f"{scratch}/b.parquet")
    with pytest.raises(Exception, match=r"PULocationID.*b\.parquet"):
        trip_io.read_raw_trips(spark, f"{scratch}/*.parquet").collect()


def test_mixed_types_of_an_unnamed_column_are_refused(spark, scratch):
    write(spark.range(3).withColumn("x", F.lit("a")), f"{scratch}/a.parquet")
    write(spark.range(3).withColumn("x", F.lit(1.5)), f"{scratch}/b.parquet")
    with pytest.raises(ValueError, match="column x"):
        trip_io.read_raw_trips(spark, f"{scratch}/*.parquet")
    both = trip_io.read_raw_trips(spark, f"{scratch}/*.parquet", {"x": "string"})
    assert sorted(r.x for r in both.collect()) == ["1.5"] * 3 + ["a"] * 3


def test_ingest_counts_come_from_the_write(spark, raw_trips, scratch):
    raw = raw_trips.drop("label")
    raw.write.parquet(f"{scratch}/yellow_1.parquet")
    bad = quality.trip_rules(900)
    got = trip_reports.ingest(spark, f"{scratch}/yellow_*.parquet", f"{scratch}/clean", bad=bad).first()
    assert got == clean.clean_reconcile(raw, bad=bad).first()
    assert trip_io.read_clean_trips(spark, f"{scratch}/clean").count() == got.rows_kept


def test_empty_input_counts_nothing(spark, raw_trips, scratch):
    write(raw_trips.drop("label").limit(0), f"{scratch}/y.parquet")
    got = trip_reports.ingest(spark, f"{scratch}/y.parquet", f"{scratch}/clean").first()
    assert tuple(got) == (0, 0, 0)


def test_counts_taken_twice_are_noticed():
    assert clean.counted_once({"parts": 8, "parts_seen": 8})
    assert not clean.counted_once({"parts": 8, "parts_seen": 9})


def test_one_scan_and_right_counts_after_a_retried_task(raw_trips, spark, scratch):
    """In an application of its own: tasks fail once, its event log shows one scan of the raw files."""
    raw_trips.drop("label").repartition(4).write.parquet(f"{scratch}/y.parquet")
    script = f"""
        import sys
        sys.path.insert(0, {ROOT!r})
        from pyspark import TaskContext
        from pyspark.sql import SparkSession, functions as F
        from fleetlens.operators import clean
        from fleetlens.plans import trip_reports
        from fleetlens.sources import trips as trip_io

        spark = (SparkSession.builder.master("local[2,3]").config("spark.ui.enabled", "false")
                 .config("spark.sql.session.timeZone", "UTC").config("spark.checkpoint.dir", "{scratch}/ck")
                 .config("spark.eventLog.enabled", "true").config("spark.eventLog.dir", "file://{scratch}/log")
                 .config("spark.eventLog.rolling.enabled", "false").config("spark.eventLog.compress", "false")
                 .getOrCreate())
        read = trip_io.read_raw_trips

        def flaky(batches):
            yield from batches
            if TaskContext.get().attemptNumber() == 0:
                raise RuntimeError("lost once")

        def failing(spark, glob):
            df = read(spark, glob)
            return df.mapInArrow(flaky, df.schema)

        trip_io.read_raw_trips = failing
        print("COUNTS", *trip_reports.ingest(spark, "{scratch}/y.parquet", "{scratch}/out").first())
        spark.stop()
    """
    import os

    os.makedirs(f"{scratch}/log")
    done = subprocess.run([sys.executable, "-c", textwrap.dedent(script)], capture_output=True, text=True, timeout=300)
    line = [ln for ln in done.stdout.splitlines() if ln.startswith("COUNTS")]
    assert line, done.stderr[-2000:]
    n = raw_trips.count()
    assert line[0] == f"COUNTS {n} {len(KEPT)} {n - len(KEPT)}"
    events = [json.loads(ln) for ln in open(glob.glob(f"{scratch}/log/*")[0])]
    assert any(e.get("Task Info", {}).get("Failed") for e in events)
    read = sum(
        e["Task Metrics"]["Input Metrics"]["Records Read"]
        for e in events
        if e["Event"] == "SparkListenerTaskEnd" and not e["Task Info"]["Failed"] and e.get("Task Metrics")
    )
    assert read <= n  # the rows were read by one scan


def test_additive_reports_equal_their_own_queries(spark, raw_trips, zones):
    trips = clean.clean_trips(raw_trips.drop("label"))
    trips = trips.unionAll(trips.withColumns({"vendor_id": F.lit(None).cast("int"), "pu_location_id": F.lit(None).cast("int")}))
    cube = trip_reports.report_cube(trips, threshold=10)
    got = trip_reports.split_cube(cube, zones)
    want = {
        "daily_totals": aggregates.daily_totals(trips),
        "payment_mix": aggregates.payment_mix(trips),
        "avg_fare_by_vendor": aggregates.avg_fare_by_vendor(trips),
        "zone_counts": joins.zone_counts(trips, zones),
        "distance_bucket": aggregates.distance_buckets(trips),
        "long_trips_by_month": aggregates.long_trips_by_month(trips, threshold=10),
    }
    assert set(got) == set(want) == set(trip_reports.CUBE_SETS)
    for name, df in want.items():
        assert got[name].dtypes == df.dtypes, name
        assert sorted(map(str, got[name].collect())) == sorted(map(str, df.collect())), name
