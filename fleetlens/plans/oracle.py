"""DuckDB SQL for each named query in :mod:`fleetlens.plans.catalog`.

Written independently of the Spark code, from the query definitions, against
the driver's tables registered as views.  Conventions that make the two
engines agree bit for bit:

* rounded means are computed in whole millionths with integer division, half away from
  zero, as :mod:`fleetlens.functions.exact` does in decimals; single doubles are rounded
  as the decimal number their text shows;
* DuckDB's ``hour`` is BIGINT and ``sum(bigint)`` HUGEINT: cast back;
* every LIMIT and running total has a total order.
"""

from __future__ import annotations


def ratio_sql(total: str, count: str, digits: int) -> str:
    """``total`` (whole millionths) / ``count`` to ``digits`` decimals, in integers."""
    unit = f"({count}) * 1000000"
    units = f"((ABS({total}) * {2 * 10**digits} + {unit}) // (2 * {unit}))"
    return f"CAST(SIGN({total}) * {units} / {10**digits}.0 AS DOUBLE)"


def millionths_sql(col: str) -> str:
    """Sum of a column of at most six decimals, in whole millionths."""
    return f"SUM(CAST(({col}) * 1000000 AS HUGEINT))"


def mean_sql(col: str, digits: int) -> str:
    return ratio_sql(millionths_sql(col), f"COUNT({col})", digits)


def half_up_sql(expr: str, digits: int) -> str:
    return f"CAST(ROUND(CAST(CAST(CAST({expr} AS DOUBLE) AS VARCHAR) AS DECIMAL(38,18)), {digits}) AS DOUBLE)"


TRIPS_RAW = """
trips_raw AS (
  SELECT CAST(l.l_suppkey % 2 AS INTEGER) AS VendorID,
         o.o_orderdate AS tpep_pickup_datetime,
         l.l_shipdate AS tpep_dropoff_datetime,
         CAST(l.l_linenumber AS DOUBLE) AS passenger_count,
         l.l_quantity AS trip_distance,
         c.c_nationkey AS PULocationID,
         s.s_nationkey AS DOLocationID,
         CAST(CASE WHEN l.l_returnflag = 'R' THEN 1
                   WHEN l.l_returnflag = 'A' THEN 2
                   WHEN o.o_orderstatus = 'F' THEN 3
                   WHEN o.o_orderstatus = 'O' THEN 0 END AS BIGINT) AS payment_type,
         CAST(l.l_extendedprice AS DECIMAL(12,2)) AS fare_amount,
         CAST(CAST(l.l_extendedprice AS DECIMAL(12,2)) * CAST(l.l_discount AS DECIMAL(4,2)) AS DECIMAL(16,4))
             AS tip_amount,
         CAST(CAST(l.l_extendedprice AS DECIMAL(12,2)) * (1 - CAST(l.l_discount AS DECIMAL(4,2)))
              * (1 + CAST(l.l_tax AS DECIMAL(4,2))) AS DECIMAL(18,6)) AS total_amount
  FROM lineitem l
  JOIN orders o ON l.l_orderkey = o.o_orderkey
  JOIN customer c ON o.o_custkey = c.c_custkey
  JOIN supplier s ON l.l_suppkey = s.s_suppkey
),
std AS (
  SELECT VendorID AS vendor_id,
         tpep_pickup_datetime AS pickup_ts,
         tpep_dropoff_datetime AS dropoff_ts,
         CAST(passenger_count AS INTEGER) AS passenger_count,
         trip_distance,
         PULocationID AS pu_location_id,
         DOLocationID AS do_location_id,
         CAST(payment_type AS INTEGER) AS payment_type,
         fare_amount, tip_amount, total_amount,
         ROUND((FLOOR(epoch(tpep_dropoff_datetime)) - FLOOR(epoch(tpep_pickup_datetime))) / 86400, 2) AS trip_days
  FROM trips_raw
),
enrich AS (
  SELECT *,
         CAST(pickup_ts AS DATE) AS pickup_date,
         strftime(pickup_ts, '%Y-%m') AS pickup_month,
         CAST(hour(pickup_ts) AS INTEGER) AS pickup_hour,
         strftime(pickup_ts, '%a') AS day_of_week,
         ROUND(trip_distance / NULLIF(trip_days / (CAST(3600 AS DOUBLE) / CAST(86400 AS DOUBLE)), 0), 2) AS avg_mph,
         CAST(CASE WHEN payment_type = 1 THEN ROUND(tip_amount / NULLIF(fare_amount, 0) * 100, 1) END AS DOUBLE) AS tip_pct,
         CASE WHEN payment_type = 1 THEN 'card'
              WHEN payment_type = 2 THEN 'cash'
              WHEN payment_type = 3 THEN 'no charge'
              WHEN payment_type = 4 THEN 'dispute'
              ELSE 'other' END AS payment_method
  FROM std
),
trips AS (SELECT * FROM enrich),
zones AS (
  SELECT n.n_nationkey AS LocationID, r.r_name AS Borough, n.n_name AS Zone
  FROM nation n JOIN region r ON n.n_regionkey = r.r_regionkey
)"""

CLEAN_WHERE = """pickup_ts BETWEEN TIMESTAMP '1995-01-01 00:00:00' AND TIMESTAMP '2000-01-01 00:00:00'
  AND trip_days > 1 AND trip_days < 180
  AND trip_distance > 0 AND trip_distance < 100
  AND fare_amount > 0 AND total_amount > 0"""

CLEAN_COLUMNS = """vendor_id, pickup_ts, dropoff_ts, passenger_count, trip_distance, pu_location_id,
  do_location_id, payment_type, fare_amount, tip_amount, total_amount, trip_days, pickup_date,
  pickup_month, pickup_hour, day_of_week, avg_mph, tip_pct, payment_method"""

W = "WITH " + TRIPS_RAW

ROUTE_STATS = f"""
route_rows AS (
  SELECT DISTINCT CAST(pu_location_id AS VARCHAR) || '->' || CAST(do_location_id AS VARCHAR) AS route,
         pu_location_id, do_location_id, pickup_date, payment_method, trip_distance
  FROM trips
),
route_stats AS (
  SELECT route, pu_location_id, pickup_date, COUNT(*) AS trips,
         {millionths_sql('trip_distance')} AS distance_sum, {mean_sql('trip_distance', 2)} AS avg_miles
  FROM route_rows GROUP BY route, pu_location_id, pickup_date
),
route_rollup AS (
  SELECT z.Borough AS pu_borough, r.pickup_date, CAST(SUM(r.trips) AS BIGINT) AS trips,
         {mean_sql('CAST(r.avg_miles AS DECIMAL(18,2))', 2)} AS avg_miles,
         {ratio_sql('SUM(r.distance_sum)', 'SUM(r.trips)', 2)} AS avg_miles_weighted
  FROM route_stats r JOIN zones z ON r.pu_location_id = z.LocationID
  GROUP BY z.Borough, r.pickup_date
)"""

FLOWS = f"""
flows AS (
  SELECT pz.Borough AS pu_borough, dz.Borough AS do_borough, COUNT(*) AS trips,
         {mean_sql('t.total_amount', 2)} AS avg_total
  FROM trips t
  JOIN zones pz ON t.pu_location_id = pz.LocationID
  JOIN zones dz ON t.do_location_id = dz.LocationID
  GROUP BY pz.Borough, dz.Borough
)"""

ZONE_COUNTS = """
zone_counts AS (
  SELECT z.Borough AS pu_borough, z.Zone AS pu_zone, COUNT(*) AS count
  FROM trips t JOIN zones z ON t.pu_location_id = z.LocationID
  GROUP BY z.Borough, z.Zone
)"""


def _rules_sql(max_fare: int) -> list[tuple[str, str]]:
    return [
        ("fare_over_limit", f"fare_amount > {max_fare}"),
        ("non_positive_fare", "fare_amount <= 0"),
        ("non_positive_total", "total_amount <= 0"),
        ("non_positive_distance", "trip_distance <= 0"),
        ("dropoff_before_pickup", "dropoff_ts < pickup_ts"),
        ("missing_payment", "payment_type IS NULL"),
    ]


def _skew_sql(key: str) -> str:
    return f"""SELECT '{key}' AS key_name, COUNT(*) AS keys, CAST(SUM(n) AS BIGINT) AS rows,
       MAX(n) AS max_rows, CAST(MEDIAN(n) AS DOUBLE) AS median_rows,
       MAX(n) / CAST(SUM(n) AS DOUBLE) AS max_share, MAX(n) / CAST(MEDIAN(n) AS DOUBLE) AS max_to_median
FROM (SELECT {key}, COUNT(*) AS n FROM trips GROUP BY {key})"""


def trip_oracles() -> dict[str, str]:
    from fleetlens.plans.catalog import FIXTURE_MAX_FARE

    o: dict[str, str] = {}
    o["scan_count"] = W + "\nSELECT COUNT(*) AS rows FROM trips_raw"
    o["clean_trips"] = W + f"\nSELECT {CLEAN_COLUMNS} FROM trips WHERE {CLEAN_WHERE}"
    o["clean_reconcile"] = W + f"""
SELECT COUNT(*) AS rows_in, COUNT(*) FILTER (WHERE {CLEAN_WHERE}) AS rows_kept,
       COUNT(*) - COUNT(*) FILTER (WHERE {CLEAN_WHERE}) AS rows_dropped
FROM trips"""
    bad = ",\n       ".join(
        f"COUNT(*) FILTER (WHERE {pred}) AS bad_{name}" for name, pred in _rules_sql(FIXTURE_MAX_FARE)
    )
    o["ingest_counts"] = o["clean_reconcile"].replace("\nFROM trips", f",\n       {bad}\nFROM trips")
    o["clean_table_months"] = W + f"""
SELECT pickup_month, COUNT(*) AS trips, {ratio_sql(millionths_sql('total_amount'), '1', 2)} AS revenue,
       MIN(pickup_date) AS first_day, MAX(pickup_date) AS last_day
FROM trips WHERE {CLEAN_WHERE} GROUP BY pickup_month"""
    keys = ["bucket", "payment_method", "pickup_date", "pickup_month", "pu_location_id", "vendor_id"]
    o["trip_report_cube"] = W + """,
wide AS (
  SELECT *, CASE WHEN trip_distance < 1 THEN 'short' WHEN trip_distance < 5 THEN 'medium' ELSE 'long' END AS bucket FROM trips
)
""" + "\nUNION ALL\n".join(
        f"""SELECT '{report}' AS report, {', '.join(k if k in by else f"(SELECT {k} FROM wide WHERE FALSE) AS {k}" for k in keys)},
       COUNT(*) AS trips, COUNT(*) FILTER (WHERE trip_days > 60) AS long_trips,
       {ratio_sql(millionths_sql('total_amount'), '1', 0)} AS revenue,
       {mean_sql('trip_distance', 2)} AS avg_miles, {mean_sql('fare_amount', 2)} AS avg_fare
FROM wide GROUP BY {', '.join(by)}"""
        for report, by in [
            ("daily_totals", ["pickup_date"]),
            ("payment_mix", ["pickup_month", "payment_method"]),
            ("avg_fare_by_vendor", ["vendor_id"]),
            ("zone_counts", ["pu_location_id"]),
            ("distance_bucket", ["bucket"]),
            ("long_trips_by_month", ["pickup_month"]),
        ]
    )
    o["daily_totals"] = W + f"""
SELECT pickup_date, COUNT(*) AS trips, CAST(ROUND(SUM(total_amount), 0) AS DOUBLE) AS revenue,
       {mean_sql('trip_distance', 2)} AS avg_miles
FROM trips GROUP BY pickup_date ORDER BY pickup_date"""
    o["hourly_stats"] = f"""
WITH ev AS (
  SELECT strftime(ts, '%a') AS day_of_week, CAST(hour(ts) AS INTEGER) AS pickup_hour,
         CAST(value AS DECIMAL(12,2)) AS avg_mph,
         CASE WHEN event_type = 'purchase' THEN CAST(value AS DECIMAL(12,2)) END AS tip_pct,
         value AS trip_minutes
  FROM events
)
SELECT day_of_week, pickup_hour, COUNT(*) AS trips,
       {mean_sql('avg_mph', 1)} AS avg_mph, {mean_sql('tip_pct', 1)} AS avg_tip_pct,
       quantile_disc(trip_minutes, 0.5) AS median_minutes
FROM ev GROUP BY day_of_week, pickup_hour ORDER BY day_of_week, pickup_hour"""
    pivots = ", ".join(
        f"NULLIF(COUNT(*) FILTER (WHERE payment_method = '{m}'), 0) AS \"{m}\""
        for m in ["card", "cash", "no charge", "dispute", "other"]
    )
    o["payment_mix"] = W + f"\nSELECT pickup_month, {pivots} FROM trips GROUP BY pickup_month ORDER BY pickup_month"
    o["avg_fare_by_vendor"] = W + f"\nSELECT vendor_id, {mean_sql('fare_amount', 2)} AS avg_fare FROM trips GROUP BY vendor_id"
    o["long_trips_by_month"] = W + """
SELECT pickup_month, COUNT(*) AS count FROM trips WHERE trip_days > 60 GROUP BY pickup_month ORDER BY pickup_month"""
    o["distance_bucket"] = W + """
SELECT CASE WHEN trip_distance < 1 THEN 'short' WHEN trip_distance < 5 THEN 'medium' ELSE 'long' END AS bucket,
       COUNT(*) AS count
FROM trips GROUP BY 1"""
    o["distinct_trips"] = W + """
SELECT DISTINCT CAST(pu_location_id AS VARCHAR) || '->' || CAST(do_location_id AS VARCHAR) AS route,
       pu_location_id, do_location_id, pickup_date, payment_method, trip_distance
FROM trips"""
    o["pickup_zone_topk"] = W + """
SELECT pu_location_id, COUNT(*) AS count FROM trips GROUP BY pu_location_id
ORDER BY count DESC, pu_location_id ASC NULLS FIRST LIMIT 5"""
    o["pickup_zone_distinct"] = W + """
SELECT COUNT(*) AS zones FROM (SELECT pu_location_id FROM trips GROUP BY pu_location_id)"""
    o["zone_counts"] = W + "," + ZONE_COUNTS + "\nSELECT * FROM zone_counts"
    flows = W + "," + FLOWS + "\nSELECT * FROM flows ORDER BY trips DESC, pu_borough, do_borough"
    o["borough_flows"] = flows
    o["borough_flows_merge"] = flows
    o["borough_flows_top10"] = flows + " LIMIT 10"
    o["top_zones_per_borough"] = W + "," + ZONE_COUNTS + """
SELECT * FROM (
  SELECT pu_borough, pu_zone, count, CAST(RANK() OVER (PARTITION BY pu_borough ORDER BY count DESC) AS INTEGER) AS rank
  FROM zone_counts
) WHERE rank <= 3 ORDER BY pu_borough, rank, pu_zone"""
    rolling = W + """
SELECT pickup_date, count,
       ROUND(AVG(count) OVER (ORDER BY pickup_date ROWS BETWEEN 6 PRECEDING AND CURRENT ROW), 0) AS trips_7d_avg
FROM (SELECT pickup_date, COUNT(*) AS count FROM trips GROUP BY pickup_date)"""
    o["daily_rolling"] = rolling
    o["daily_rolling_dist"] = rolling
    running = W + "," + ROUTE_STATS + """
SELECT pu_borough, pickup_date, trips,
       CAST(SUM(trips) OVER (ORDER BY trips DESC, pu_borough, pickup_date
                             ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS running_total
FROM route_rollup"""
    o["running_total"] = running
    o["running_total_dist"] = running
    o["route_daily"] = W + "," + ROUTE_STATS + "\nSELECT route, pickup_date, trips, avg_miles FROM route_stats"
    o["route_rollup"] = W + "," + ROUTE_STATS + "\nSELECT * FROM route_rollup"
    o["layout_skew"] = W + "\n" + "\nUNION ALL\n".join(_skew_sql(k) for k in ["payment_method", "pickup_date"])
    o["layout_key_partitions"] = W + """
SELECT pickup_date, COUNT(*) AS rows, CAST(1 AS BIGINT) AS partitions FROM trips GROUP BY pickup_date"""
    rules = _rules_sql(FIXTURE_MAX_FARE)
    o["quality_report"] = W + "\n" + "\nUNION ALL\n".join(
        f"SELECT '{name}' AS rule, COUNT(*) FILTER (WHERE {pred}) AS bad_rows, COUNT(*) AS rows FROM trips"
        for name, pred in rules
    )
    tags = ", ".join(f"CASE WHEN {pred} THEN '{name}' END" for name, pred in rules)
    o["quality_quarantine"] = W + f"""
SELECT * FROM (SELECT *, concat_ws(',', {tags}) AS violations FROM trips) WHERE violations <> ''"""
    return o


EVENT_RUN = """WITH tasks AS (
  SELECT event_type AS app_id, user_id AS stage_id, 0 AS stage_attempt, event_id AS task_id,
         CAST(ROUND(value * 1000) AS BIGINT) AS run_ms, TRUE AS successful,
         CAST(FLOOR(CAST(ROUND(value * 1000) AS BIGINT) / 100) AS BIGINT) AS gc_ms,
         CAST(json_extract_string(props, '$.k') AS BIGINT) * 1000000 AS input_bytes,
         CAST(json_extract_string(props, '$.k') AS BIGINT) * 1000 AS shuffle_read_bytes,
         CAST(ROUND(value * 1000) AS BIGINT) * 1000 AS shuffle_write_bytes,
         epoch_us(ts) // 1000 AS ts_ms
  FROM events
),
stages AS (
  SELECT app_id, stage_id, stage_attempt, 'user ' || CAST(stage_id AS VARCHAR) AS name,
         CAST(NULL AS VARCHAR) AS description, COUNT(*) AS num_tasks,
         MIN(ts_ms) AS submission_ms, MAX(ts_ms) AS completion_ms, 'COMPLETE' AS status,
         CAST(SUM(input_bytes) AS BIGINT) AS input_bytes,
         CAST(SUM(shuffle_read_bytes) AS BIGINT) AS shuffle_read_bytes,
         CAST(SUM(shuffle_write_bytes) AS BIGINT) AS shuffle_write_bytes,
         CAST(SUM(gc_ms) AS BIGINT) AS gc_ms
  FROM tasks GROUP BY app_id, stage_id, stage_attempt
),
jobs AS (
  SELECT app_id, stage_id AS job_id, CASE WHEN app_id = 'error' THEN 'FAILED' ELSE 'SUCCEEDED' END AS status
  FROM stages
),
apps AS (
  SELECT app_id, app_id AS app_name, MIN(ts_ms) AS start_ms, MAX(ts_ms) AS end_ms,
         'events' AS spark_version, 'events' AS "user"
  FROM tasks GROUP BY app_id
),
summary_raw AS (
  SELECT a.app_name AS app, a.app_id,
         (a.end_ms - a.start_ms) / CAST(1000 AS DOUBLE) AS duration_s,
         COALESCE(j.jobs, 0) AS jobs, COALESCE(j.failed_jobs, 0) AS failed_jobs,
         COALESCE(s.stages, 0) AS stages, CAST(COALESCE(s.tasks, 0) AS BIGINT) AS tasks,
         COALESCE(s.input_bytes, 0) / CAST(1e6 AS DOUBLE) AS input_MB,
         COALESCE(s.shuffle_write_bytes, 0) / CAST(1e6 AS DOUBLE) AS shuffle_write_MB,
         COALESCE(s.gc_ms, 0) / CAST(1000 AS DOUBLE) AS gc_s
  FROM apps a
  LEFT JOIN (SELECT app_id, COUNT(*) AS jobs, COUNT(*) FILTER (WHERE status = 'FAILED') AS failed_jobs
             FROM jobs GROUP BY app_id) j ON a.app_id = j.app_id
  LEFT JOIN (SELECT app_id, COUNT(*) AS stages, SUM(num_tasks) AS tasks, SUM(input_bytes) AS input_bytes,
                    SUM(shuffle_write_bytes) AS shuffle_write_bytes, SUM(gc_ms) AS gc_ms
             FROM stages WHERE status <> 'SKIPPED' GROUP BY app_id) s ON a.app_id = s.app_id
),
summary AS (
  SELECT app, app_id, {dur} AS duration_s, jobs, failed_jobs, stages, tasks,
         {inp} AS input_MB, {sw} AS shuffle_write_MB, {gc} AS gc_s
  FROM summary_raw
)""".format(
    dur=half_up_sql("duration_s", 1),
    inp=half_up_sql("input_MB", 1),
    sw=half_up_sql("shuffle_write_MB", 1),
    gc=half_up_sql("gc_s", 1),
)

ORDER_RUN = """WITH lines AS (
  SELECT l_orderkey, COUNT(*) AS num_tasks, MAX(l_shipdate) AS last_ship FROM lineitem GROUP BY l_orderkey
),
jobs AS (
  SELECT 'orders' AS app_id, o.o_orderkey AS job_id, epoch_ms(o.o_orderdate) AS submission_ms,
         epoch_ms(l.last_ship) AS completion_ms,
         CASE WHEN o.o_orderstatus = 'F' THEN 'SUCCEEDED' WHEN o.o_orderstatus = 'P' THEN 'FAILED'
              ELSE 'RUNNING' END AS status,
         o.o_orderpriority AS description, 'order ' || CAST(o.o_orderkey AS VARCHAR) AS name,
         COALESCE(l.num_tasks, 0) AS num_tasks
  FROM orders o LEFT JOIN lines l ON o.o_orderkey = l.l_orderkey
),
skipped AS (
  SELECT 'orders' AS app_id, o.o_orderkey AS job_id, o.o_orderkey AS stage_id
  FROM orders o
  WHERE o.o_orderstatus <> 'O' AND NOT EXISTS (SELECT 1 FROM lineitem l WHERE l.l_orderkey = o.o_orderkey)
)"""


def run_oracles() -> dict[str, str]:
    from fleetlens.plans.catalog import COMPARE_BASELINE

    o: dict[str, str] = {}
    o["run_app_summary"] = EVENT_RUN + "\nSELECT * FROM summary"
    o["run_app_detail"] = EVENT_RUN + """
SELECT s.*, a.spark_version, a."user", make_timestamp(a.start_ms * 1000) AS start_time
FROM summary s JOIN apps a ON s.app_id = a.app_id"""
    o["run_stage_skew"] = EVENT_RUN + """,
ranked AS (
  SELECT app_id, stage_id, stage_attempt, run_ms,
         ROW_NUMBER() OVER (PARTITION BY app_id, stage_id, stage_attempt ORDER BY run_ms) - 1 AS idx,
         COUNT(*) OVER (PARTITION BY app_id, stage_id, stage_attempt) AS n
  FROM tasks WHERE successful
),
q AS (
  SELECT app_id, stage_id, stage_attempt,
         MAX(CASE WHEN idx = LEAST(FLOOR(n * 0.5), n - 1) THEN run_ms END) AS median_ms,
         MAX(run_ms) AS max_ms
  FROM ranked GROUP BY app_id, stage_id, stage_attempt
)
SELECT s.app_id, a.app_name AS app, s.stage_id, s.stage_attempt, s.num_tasks AS tasks,
       q.median_ms / CAST(1000 AS DOUBLE) AS median_task_s, q.max_ms / CAST(1000 AS DOUBLE) AS max_task_s,
       LEFT(COALESCE(NULLIF(s.description, ''), s.name), 60) AS description
FROM stages s
JOIN q ON s.app_id = q.app_id AND s.stage_id = q.stage_id AND s.stage_attempt = q.stage_attempt
LEFT JOIN apps a ON s.app_id = a.app_id
WHERE s.status = 'COMPLETE' AND s.num_tasks >= 4
  AND q.max_ms >= 1000 AND q.max_ms > 5 * GREATEST(q.median_ms, 1)"""
    o["run_stage_timeline"] = EVENT_RUN + """
SELECT s.app_id, s.stage_id, s.stage_attempt, 'Stage ' || CAST(s.stage_id AS VARCHAR) AS stage,
       UPPER(LEFT(s.status, 1)) || LOWER(SUBSTR(s.status, 2)) AS status,
       COALESCE(s.description, s.name) AS label,
       (s.submission_ms - a.start_ms) / CAST(1000 AS DOUBLE) AS start_s,
       (s.completion_ms - a.start_ms) / CAST(1000 AS DOUBLE) AS end_s,
       s.num_tasks,
       (s.shuffle_write_bytes + s.shuffle_read_bytes) / CAST(1e6 AS DOUBLE) AS shuffle_MB,
       (s.completion_ms - a.start_ms) / CAST(1000 AS DOUBLE) - (s.submission_ms - a.start_ms) / CAST(1000 AS DOUBLE)
           AS duration_s
FROM stages s JOIN apps a ON s.app_id = a.app_id
WHERE s.status <> 'SKIPPED' AND s.submission_ms IS NOT NULL AND s.completion_ms IS NOT NULL"""
    o["run_jobs_table"] = ORDER_RUN + """
SELECT j.app_id, j.job_id, j.description,
       CASE WHEN j.status = 'SUCCEEDED' THEN '✅ Succeeded' WHEN j.status = 'FAILED' THEN '❌ Failed'
            ELSE j.status END AS status,
       (j.completion_ms - j.submission_ms) / CAST(1000 AS DOUBLE) AS duration_s,
       j.num_tasks, COALESCE(k.n, 0) AS skipped_stages, j.name
FROM jobs j LEFT JOIN (SELECT app_id, job_id, COUNT(*) AS n FROM skipped GROUP BY app_id, job_id) k
  ON j.app_id = k.app_id AND j.job_id = k.job_id"""
    states = ORDER_RUN + """,
states AS (
  SELECT j.app_id, j.num_tasks,
         CASE WHEN EXISTS (SELECT 1 FROM lines l WHERE l.l_orderkey = j.job_id) THEN 'COMPLETE'
              WHEN j.status = 'RUNNING' THEN 'PENDING' ELSE 'SKIPPED' END AS status
  FROM jobs j
)"""
    o["run_stage_states"] = states + """
SELECT app_id, status, COUNT(*) AS stages, CAST(SUM(num_tasks) AS BIGINT) AS tasks FROM states GROUP BY app_id, status"""
    o["run_order_summary"] = states + f"""
SELECT j.app_id AS app, j.app_id,
       {half_up_sql('(MAX(j.completion_ms) - MIN(j.submission_ms)) / CAST(1000 AS DOUBLE)', 1)} AS duration_s,
       COUNT(*) AS jobs, COUNT(*) FILTER (WHERE j.status = 'FAILED') AS failed_jobs,
       (SELECT COUNT(*) FROM states WHERE status <> 'SKIPPED') AS stages,
       (SELECT CAST(SUM(num_tasks) AS BIGINT) FROM states WHERE status <> 'SKIPPED') AS tasks,
       CAST(0 AS DOUBLE) AS input_MB, CAST(0 AS DOUBLE) AS shuffle_write_MB, CAST(0 AS DOUBLE) AS gc_s
FROM jobs j GROUP BY j.app_id"""
    o["run_skipped_stages"] = ORDER_RUN + "\nSELECT app_id, job_id, stage_id FROM skipped"
    metrics = ["duration_s", "tasks", "stages", "jobs", "input_MB", "shuffle_write_MB", "gc_s"]
    o["run_compare_long"] = EVENT_RUN + "\n" + "\nUNION ALL\n".join(
        f"SELECT app_id, app, '{m}' AS metric, CAST({m} AS DOUBLE) AS value FROM summary_raw" for m in metrics
    )
    ratios = {"duration_s": "duration_ratio", "stages": "stages_ratio", "tasks": "tasks_ratio",
              "input_MB": "input_ratio", "shuffle_write_MB": "shuffle_ratio"}
    cols = ", ".join(
        f"CAST(s.{m} AS DOUBLE) / NULLIF(CAST(b.{m} AS DOUBLE), 0) AS {r}" for m, r in ratios.items()
    )
    o["run_compare_ratio"] = EVENT_RUN + f"""
SELECT s.app_id, s.app, '{COMPARE_BASELINE}' AS baseline, {cols}
FROM summary_raw s, (SELECT * FROM summary_raw WHERE app_id = '{COMPARE_BASELINE}') b"""
    return o


def all_oracles() -> dict[str, str]:
    return {**trip_oracles(), **run_oracles()}
