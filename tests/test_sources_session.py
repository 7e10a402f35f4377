from __future__ import annotations

import os

from pyspark.sql import functions as F

from fleetlens.session import cached, ensure_checkpoint_dir, job_label
from fleetlens.sources import trips as trip_io


def test_glob_scan_reads_every_matching_file(spark, raw_trips, scratch):
    base = raw_trips.drop("label")
    for month in ("2024-01", "2024-02", "2024-03"):
        base.write.parquet(os.path.join(scratch, f"yellow_tripdata_{month}.parquet"))
    base.write.parquet(os.path.join(scratch, "other_2024-01.parquet"))
    got = trip_io.read_raw_trips(spark, os.path.join(scratch, "yellow_tripdata_2024-*.parquet"))
    assert got.count() == 3 * base.count()


def test_zones_csv_with_declared_schema(spark, scratch):
    path = os.path.join(scratch, "zones.csv")
    with open(path, "w") as f:
        f.write("LocationID,Borough,Zone,service_zone\n1,EWR,Newark Airport,EWR\n2,Queens,Jamaica Bay,Boro Zone\n")
    z = trip_io.read_zones(spark, path)
    assert z.dtypes[0] == ("LocationID", "int")
    assert [r.Zone for r in z.orderBy("LocationID").collect()] == ["Newark Airport", "Jamaica Bay"]


def test_overwrite_sink_replaces(spark, scratch):
    path = os.path.join(scratch, "out")
    trip_io.write_parquet(spark.range(5), path)
    trip_io.write_parquet(spark.range(2), path)
    assert spark.read.parquet(path).count() == 2


def test_static_partition_overwrite_drops_vanished_months(spark, scratch):
    path = os.path.join(scratch, "parts")
    df = spark.createDataFrame([("2024-01", 1), ("2024-02", 2)], "pickup_month string, v int")
    trip_io.write_partitioned(df, path)
    trip_io.write_partitioned(df.filter(F.col("pickup_month") == "2024-02"), path)
    assert sorted(d for d in os.listdir(path) if d.startswith("pickup_month=")) == ["pickup_month=2024-02"]


def test_job_label_sets_and_resets(spark):
    sc = spark.sparkContext
    before = sc.getLocalProperty("spark.job.description")
    with job_label(spark, "daily totals"):
        assert sc.getLocalProperty("spark.job.description") == "daily totals"
    assert sc.getLocalProperty("spark.job.description") == before


def test_cached_releases_storage(spark):
    df = spark.range(100).withColumn("x", F.col("id") * 2)
    with cached(df) as c:
        assert c.count() == 100
        assert c.storageLevel.useMemory
    assert not df.storageLevel.useMemory


def test_checkpoint_dir_comes_from_the_session(spark):
    d = ensure_checkpoint_dir(spark)
    assert d and d == spark.sparkContext.getCheckpointDir()


def test_scale_conf_sizes_partitions_to_the_input():
    from fleetlens.session import scale_conf

    big = scale_conf(100 * 2**40, 8000)
    assert big["spark.sql.shuffle.partitions"] == str(100 * 2**40 // (256 * 2**20))
    small = scale_conf(10 * 2**20, 8)
    assert small["spark.sql.shuffle.partitions"] == "16"
    assert small["spark.sql.files.maxPartitionBytes"] == str(256 * 2**20)
