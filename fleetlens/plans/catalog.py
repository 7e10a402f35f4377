"""Named queries over the driver's tables: each is (spark, sf_dir) -> DataFrame.

Each entry wires a fixture view from :mod:`fleetlens.sources.fixtures` into
the library's operators.  The matching DuckDB SQL lives in
:mod:`fleetlens.plans.oracle`; column names and types agree between the two.

Trip queries run over the *whole* trip view (every lineitem), standardised
and enriched but not cleaned, so their work grows with the tables; the
cleaning filter has its own keys (``clean_trips``, ``clean_reconcile``).
Like the reference's ingest job, the joined and enriched view is written
once per application and every report reads it.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetlens import functions as fx
from fleetlens.operators import aggregates as agg
from fleetlens.operators import clean, joins, layout, quality, routes, runmetrics, windows
from fleetlens.plans import trip_reports
from fleetlens.session import ensure_checkpoint_dir
from fleetlens.sources import fixtures as fix
from fleetlens.sources.staging import fingerprint, staged
from fleetlens.sources.trips import read_clean_trips

RULES = clean.FIXTURE_RULES
# Fixture fares are order-line prices (up to ~100k), so the "looks wrong" fare is higher.
FIXTURE_MAX_FARE = 100_000
SKEW_KEYS = ["payment_method", "pickup_date"]
LAYOUT_PARTITIONS = 16
# Keys without a SQL oracle (the driver checks their row counts only).
ROWS_ONLY: set[str] = {"layout_partition_rows"}


def _staged_from(
    spark: SparkSession, sf_dir: str, label: str, tables: str, build: Callable[[], DataFrame], write: bool = True
) -> DataFrame:
    """``build()`` staged under a key that changes with the files of the named tables."""
    root = sf_dir.rstrip("/")
    files = fingerprint(spark, *(f"{root}/{t}.parquet" for t in tables.split()))
    return staged(spark, f"{label}:{root}:{files}", build, write)


def trips(spark: SparkSession, sf_dir: str, write: bool = True) -> DataFrame:
    """The enriched trip view, staged once per application (see :mod:`fleetlens.sources.staging`)."""
    tables = "lineitem orders customer supplier"
    view = lambda: clean.enriched_trips(fix.trips_raw(spark, sf_dir), RULES)
    return _staged_from(spark, sf_dir, "trips", tables, view, write)


def trips_once(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The trip view for a report that reads a few of its columns once: if no query has
    staged it, the joins themselves, of which Spark then computes these columns alone."""
    return trips(spark, sf_dir, write=False)


def zones(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fix.zones_raw(spark, sf_dir)


def event_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``events`` in the columns of the hourly report: weekday/hour of ``ts``, value as speed,
    purchase value as the card-only tip, value as duration."""
    ev = fix.table(spark, sf_dir, "events")
    value = F.col("value").cast("decimal(12,2)")
    return ev.select(
        F.date_format("ts", "E").alias("day_of_week"),
        F.hour("ts").alias("pickup_hour"),
        value.alias("avg_mph"),
        F.when(F.col("event_type") == "purchase", value).alias("tip_pct"),
        F.col("value").alias("trip_minutes"),
    )


def clean_table(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, dict[str, int] | None]:
    """The cleaned trips written by month and read back, and the counts observed by that write."""
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/clean-{uuid.uuid4().hex}"
    rules = quality.trip_rules(FIXTURE_MAX_FARE)
    table, observation = clean.observed_clean(fix.trips_raw(spark, sf_dir), RULES, rules)
    clean.write_clean(table, path)
    return read_clean_trips(spark, path), clean.counts_of(observation)


def ingest_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows in, kept and dropped and bad rows per rule, as the write of the cleaned table saw them."""
    rules = quality.trip_rules(FIXTURE_MAX_FARE)
    _, counts = clean_table(spark, sf_dir)
    if counts is None:
        return clean.clean_reconcile(fix.trips_raw(spark, sf_dir), RULES, rules)
    names = ["rows_in", "rows_kept", "rows_dropped", *(f"bad_{r}" for r in rules)]
    return spark.createDataFrame([tuple(counts[n] for n in names)], ", ".join(f"{n} bigint" for n in names))


def clean_table_months(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per month folder of the written cleaned table: rows, revenue and the folder's days."""
    table, _ = clean_table(spark, sf_dir)
    months = table.groupBy("pickup_month").agg(
        F.count(F.lit(1)).alias("trips"),
        fx.partial_sum(table, "total_amount").alias("revenue"),
        F.min("pickup_date").alias("first_day"),
        F.max("pickup_date").alias("last_day"),
    )
    revenue = fx.mean_of(months, "revenue", F.lit(1), 2).alias("revenue")
    return months.select("pickup_month", "trips", revenue, "first_day", "last_day")


def trip_report_cube(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every additive trip report from one scan, in one table."""
    cube = trip_reports.report_cube(trips(spark, sf_dir), RULES.duration_col, 60)
    keys = sorted({k for ks in trip_reports.CUBE_SETS.values() for k in ks})
    return cube.select(
        "report",
        *keys,
        "trips",
        "long_trips",
        fx.mean_of(cube, "revenue", F.lit(1), 0).alias("revenue"),
        fx.mean_of(cube, "miles", "measured", 2).alias("avg_miles"),
        fx.mean_of(cube, "fare", "fares", 2).alias("avg_fare"),
    )


def daily_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trips(spark, sf_dir).groupBy("pickup_date").count()


def borough_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    return routes.route_rollup(trips(spark, sf_dir), zones(spark, sf_dir)).select("pu_borough", "pickup_date", "trips")


def running_order() -> list:
    """Most trips first; borough and date break ties so the order is total."""
    return [F.desc("trips"), F.asc("pu_borough"), F.asc("pickup_date")]


def trip_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    q: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
    q["scan_count"] = lambda s, d: agg.scan_count(fix.trips_raw(s, d))
    q["clean_trips"] = lambda s, d: clean.clean_trips(fix.trips_raw(s, d), RULES)
    q["clean_reconcile"] = lambda s, d: clean.clean_reconcile(fix.trips_raw(s, d), RULES)
    q["daily_totals"] = lambda s, d: agg.daily_totals(trips(s, d))
    q["hourly_stats"] = lambda s, d: agg.hourly_stats(event_trips(s, d))
    q["ingest_counts"] = ingest_counts
    q["clean_table_months"] = clean_table_months
    q["trip_report_cube"] = trip_report_cube
    q["payment_mix"] = lambda s, d: agg.payment_mix(trips(s, d))
    q["avg_fare_by_vendor"] = lambda s, d: agg.avg_fare_by_vendor(trips(s, d))
    q["long_trips_by_month"] = lambda s, d: agg.long_trips_by_month(trips(s, d), RULES.duration_col, 60)
    q["distance_bucket"] = lambda s, d: agg.distance_buckets(trips(s, d))
    q["distinct_trips"] = lambda s, d: agg.distinct_trips(trips(s, d))
    q["pickup_zone_topk"] = lambda s, d: agg.top_keys(trips(s, d), "pu_location_id", 5)
    q["pickup_zone_distinct"] = lambda s, d: agg.distinct_key_count(trips(s, d), "pu_location_id", "zones")
    q["zone_counts"] = lambda s, d: joins.zone_counts(trips_once(s, d), zones(s, d))
    q["borough_flows"] = lambda s, d: joins.borough_flows(trips_once(s, d), zones(s, d), "auto")
    q["borough_flows_merge"] = lambda s, d: joins.borough_flows(trips_once(s, d), zones(s, d), "merge")
    q["borough_flows_top10"] = lambda s, d: joins.borough_flows(trips_once(s, d), zones(s, d)).limit(10)
    q["top_zones_per_borough"] = lambda s, d: windows.top_n_per_group(
        joins.zone_counts(trips_once(s, d), zones(s, d)), "pu_borough", "count", 3
    ).orderBy("pu_borough", "rank", "pu_zone")
    # The reference writes these two as windows without PARTITION BY (one task for all rows).
    # Both keys run the distributed forms; the plain forms are kept as test oracles only.
    q["daily_rolling"] = lambda s, d: windows.rolling_mean(
        daily_counts(s, d), ["pickup_date"], "count", "trips_7d_avg", 7, 0
    )
    q["daily_rolling_dist"] = lambda s, d: windows.rolling_mean(
        daily_counts(s, d), ["pickup_date"], "count", "trips_7d_avg", 7, 0
    )
    q["running_total"] = lambda s, d: windows.running_total(borough_daily(s, d), running_order(), "trips")
    q["running_total_dist"] = lambda s, d: windows.running_total(borough_daily(s, d), running_order(), "trips")
    q["route_daily"] = lambda s, d: routes.route_daily(trips(s, d))
    q["route_rollup"] = lambda s, d: routes.route_rollup(trips(s, d), zones(s, d))
    q["layout_skew"] = lambda s, d: layout.layout_skew(trips(s, d), SKEW_KEYS)
    q["layout_partition_rows"] = lambda s, d: layout.rows_per_partition(
        layout.hash_layout(trips(s, d), LAYOUT_PARTITIONS, "pickup_date"), LAYOUT_PARTITIONS
    )
    q["layout_key_partitions"] = lambda s, d: layout.partitions_per_key(
        layout.hash_layout(trips(s, d), LAYOUT_PARTITIONS, "pickup_date"), "pickup_date"
    )
    q["quality_report"] = lambda s, d: quality.quality_report(trips(s, d), quality.trip_rules(FIXTURE_MAX_FARE))
    q["quality_quarantine"] = lambda s, d: quality.quality_quarantine(
        trips(s, d), quality.trip_rules(FIXTURE_MAX_FARE)
    )
    return q


COMPARE_BASELINE = "click"


def event_run(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """apps / jobs / stages / tasks over ``events``; the task table is staged once per application
    (as a parsed event log would be), the per-stage and per-app tables are derived from it."""
    tasks = _staged_from(spark, sf_dir, "event_tasks", "events", lambda: fix.event_tasks(spark, sf_dir))
    return fix.event_run_tables(spark, sf_dir, tasks)


def order_run(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """apps / jobs / job_stages / stages over ``orders`` and ``lineitem``; the per-order lineitem
    aggregate is staged once per application."""
    lines = _staged_from(spark, sf_dir, "order_lines", "lineitem", lambda: fix.order_lines(spark, sf_dir))
    return fix.order_run_tables(spark, sf_dir, lines)


def _event_summary(spark: SparkSession, sf_dir: str, digits: int | None = 1, ordered: bool = True) -> DataFrame:
    t = event_run(spark, sf_dir)
    return runmetrics.app_summary(t["apps"], t["jobs"], t["stages"], digits, ordered)


def run_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    def skew(s, d):
        t = event_run(s, d)
        return runmetrics.stage_skew(t["stages"], t["tasks"], t["apps"])

    def timeline(s, d):
        t = event_run(s, d)
        return runmetrics.stage_timeline(t["apps"], t["stages"])

    def detail(s, d):
        t = event_run(s, d)
        return runmetrics.app_detail(runmetrics.app_summary(t["apps"], t["jobs"], t["stages"], 1), t["apps"])

    def jobs_table(s, d):
        t = order_run(s, d)
        return runmetrics.jobs_table(t["jobs"], t["job_stages"], t["stages"])

    def skipped(s, d):
        t = order_run(s, d)
        return runmetrics.skipped_stages(t["job_stages"], t["stages"], t["jobs"])

    def order_summary(s, d):
        t = order_run(s, d)
        return runmetrics.app_summary(t["apps"], t["jobs"], t["stages"], 1)

    return {
        "run_stage_states": lambda s, d: runmetrics.stage_states(order_run(s, d)["stages"]),
        "run_order_summary": order_summary,
        "run_app_summary": lambda s, d: _event_summary(s, d, 1),
        "run_app_detail": detail,
        "run_stage_skew": skew,
        "run_stage_timeline": timeline,
        "run_jobs_table": jobs_table,
        "run_skipped_stages": skipped,
        "run_compare_long": lambda s, d: runmetrics.compare_long(_event_summary(s, d, None, ordered=False)),
        "run_compare_ratio": lambda s, d: runmetrics.compare_ratio(
            _event_summary(s, d, None, ordered=False), COMPARE_BASELINE
        ),
    }


def all_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {**trip_queries(), **run_queries()}
