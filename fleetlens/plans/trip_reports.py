"""The trip jobs end to end on taxi-shaped files: ingest once, then every report.

``ingest`` reads raw trip files by glob, writes the cleaned table partitioned
by month and returns the reconciliation counts, taken as the table is written;
``reports`` builds every trip report over the cleaned table and a zone lookup.
Each report is a lazy DataFrame; write or show the ones you need.  The additive
ones (daily, payment, vendor, zone, bucket, long trips) come from one scan and
one shuffle: :func:`report_cube` counts and sums by all their keys at once, and
its few rows are written once and split.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetlens import functions as fx
from fleetlens.operators import aggregates as agg
from fleetlens.operators import clean, joins, layout, quality, routes, windows
from fleetlens.sources import trips as trip_io
from fleetlens.sources.staging import fingerprint, staged


def ingest(
    spark: SparkSession,
    raw_glob: str,
    out_path: str,
    rules: clean.CleanRules = clean.TAXI_RULES,
    bad: dict[str, Column] | None = None,
) -> DataFrame:
    """Raw files → cleaned, month-partitioned table at ``out_path``; returns rows in / kept / dropped (/ bad per rule).

    The counts come from the write, so the files are scanned once.  Only where
    :func:`fleetlens.operators.clean.counts_of` has none are the files counted anew.
    """
    bad = bad or {}
    raw = trip_io.read_raw_trips(spark, raw_glob)
    table, observation = clean.observed_clean(raw, rules, bad)
    clean.write_clean(table, out_path)
    counts = clean.counts_of(observation)
    if counts is None:
        return clean.clean_reconcile(raw, rules, bad)
    names = ["rows_in", "rows_kept", "rows_dropped", *(f"bad_{name}" for name in bad)]
    return spark.createDataFrame([tuple(counts[n] for n in names)], ", ".join(f"{n} bigint" for n in names))


# The keys of each additive report.
CUBE_SETS: dict[str, list[str]] = {
    "daily_totals": ["pickup_date"],
    "payment_mix": ["pickup_month", "payment_method"],
    "avg_fare_by_vendor": ["vendor_id"],
    "zone_counts": ["pu_location_id"],
    "distance_bucket": ["bucket"],
    "long_trips_by_month": ["pickup_month"],
}


def report_cube(trips: DataFrame, duration_col: str = "trip_minutes", threshold: float = 60) -> DataFrame:
    """Counts and exact sums for every key set of ``CUBE_SETS`` from one scan and one shuffle.

    ``report`` names the key set of a row; keys of other sets are NULL.  Rows are
    multiplied by the number of sets only in front of the map-side partial sums.
    """
    wide = trips.withColumn("bucket", fx.distance_bucket("trip_distance"))
    keys = sorted({k for ks in CUBE_SETS.values() for k in ks})
    sets = list(CUBE_SETS.values())
    # a set's grouping id has a one for every key that is not in it
    ids = {name: sum(1 << (len(keys) - 1 - i) for i, k in enumerate(keys) if k not in ks) for name, ks in CUBE_SETS.items()}
    grouped = wide.groupingSets([[F.col(k) for k in ks] for ks in sets], *keys).agg(
        F.grouping_id().alias("gid"),
        F.count(F.lit(1)).alias("trips"),
        F.count_if(F.col(duration_col) > threshold).alias("long_trips"),
        fx.partial_sum(trips, "total_amount").alias("revenue"),
        fx.partial_sum(trips, "trip_distance").alias("miles"),
        F.count("trip_distance").alias("measured"),
        fx.partial_sum(trips, "fare_amount").alias("fare"),
        F.count("fare_amount").alias("fares"),
    )
    report = F.coalesce(*(F.when(F.col("gid") == gid, F.lit(name)) for name, gid in ids.items()))
    return grouped.withColumn("report", report).drop("gid")


def split_cube(cube: DataFrame, zones: DataFrame) -> dict[str, DataFrame]:
    """The additive reports, from the rows of :func:`report_cube`; each equals its own operator's result."""
    part = {name: cube.where(F.col("report") == name) for name in CUBE_SETS}
    zoned = joins.with_zones(part["zone_counts"], zones, ("pu",))
    return {
        "daily_totals": part["daily_totals"].select(
            "pickup_date",
            "trips",
            fx.mean_of(cube, "revenue", F.lit(1), 0).alias("revenue"),
            fx.mean_of(cube, "miles", "measured", 2).alias("avg_miles"),
        ).orderBy("pickup_date"),
        "payment_mix": part["payment_mix"]
        .groupBy("pickup_month")
        .pivot("payment_method", fx.PAYMENT_ORDER)
        .agg(F.sum("trips"))
        .orderBy("pickup_month"),
        "avg_fare_by_vendor": part["avg_fare_by_vendor"].select(
            "vendor_id", fx.mean_of(cube, "fare", "fares", 2).alias("avg_fare")
        ),
        "zone_counts": zoned.groupBy("pu_borough", "pu_zone").agg(F.sum("trips").alias("count")),
        "distance_bucket": part["distance_bucket"].select("bucket", F.col("trips").alias("count")),
        "long_trips_by_month": part["long_trips_by_month"]
        .where("long_trips > 0")
        .select("pickup_month", F.col("long_trips").alias("count"))
        .orderBy("pickup_month"),
    }


def reports(
    spark: SparkSession,
    clean_path: str,
    zones: DataFrame,
    rules: clean.CleanRules = clean.TAXI_RULES,
    max_fare: float = 900,
) -> dict[str, DataFrame]:
    """Every trip report over the cleaned table at ``clean_path`` and a zone lookup."""
    trips = trip_io.read_clean_trips(spark, clean_path)
    key = f"cube:{clean_path}:{rules.duration_col}:{fingerprint(spark, clean_path)}"
    cube = staged(spark, key, lambda: report_cube(trips, rules.duration_col))
    additive = split_cube(cube, zones)
    daily = additive["daily_totals"].select("pickup_date", F.col("trips").alias("count"))
    borough_daily = routes.route_rollup(trips, zones).select("pu_borough", "pickup_date", "trips")
    rules_q = quality.trip_rules(max_fare)
    return additive | {
        "hourly_stats": agg.hourly_stats(trips, duration_col=rules.duration_col),
        "pickup_zone_topk": agg.top_keys(trips, "pu_location_id", 5),
        "pickup_zone_distinct": agg.distinct_key_count(trips, "pu_location_id", "zones"),
        "borough_flows": joins.borough_flows(trips, zones, "auto"),
        "borough_flows_merge": joins.borough_flows(trips, zones, "merge"),
        "top_zones_per_borough": windows.top_n_per_group(
            additive["zone_counts"], "pu_borough", "count", 3
        ).orderBy("pu_borough", "rank", "pu_zone"),
        "daily_rolling": windows.rolling_mean(daily, ["pickup_date"], "count", "trips_7d_avg", 7, 0),
        "layout_skew": layout.layout_skew(trips, ["payment_method", "pickup_date"]),
        "route_daily": routes.route_daily(trips),
        "route_rollup": routes.route_rollup(trips, zones),
        "running_total": windows.running_total(
            borough_daily, [F.desc("trips"), F.asc("pu_borough"), F.asc("pickup_date")], "trips"
        ),
        "quality_report": quality.quality_report(trips, rules_q),
        "quality_quarantine": quality.quality_quarantine(trips, rules_q),
    }
