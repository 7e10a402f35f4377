"""Trip-shaped and zone-shaped views over the star-schema test tables.

The operators are written for raw taxi trips and a zone lookup.  These views
map the driver's tables onto exactly those shapes, so every operator runs
unchanged on them:

``trips_raw``  = lineitem ⋈ orders ⋈ customer ⋈ supplier, with raw taxi column names
``zones_raw``  = nation ⋈ region as (LocationID, Borough, Zone)
``event_run_tables`` = events as apps, jobs, stages and tasks (stand-in for event logs)
``order_run_tables`` = orders as jobs, lineitem as the stages they ran

Money columns are exact decimals built from the two-decimal inputs, so sums
and means do not depend on the order in which partitions are combined.
How joins travel is left to Spark's byte statistics and adaptive execution.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetlens.operators.runmetrics import STAGE_KEY, TASK_TOTALS, task_total_aggs

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One driver table, read as Parquet."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def payment_code(returnflag: str = "l_returnflag", orderstatus: str = "o_orderstatus") -> F.Column:
    """R → 1, A → 2, otherwise by order status: F → 3, O → 0, P → NULL."""
    rf, st = F.col(returnflag), F.col(orderstatus)
    return (
        F.when(rf == "R", 1)
        .when(rf == "A", 2)
        .when(st == "F", 3)
        .when(st == "O", 0)
        .cast("bigint")
    )


def trips_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw-taxi-shaped trips over the star schema (one row per lineitem)."""
    li = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice",
        "l_discount", "l_tax", "l_returnflag", "l_shipdate",
    )
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate")
    customer = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    supplier = table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    # Orders meet customers first (an order-sized join), so when no side is small enough
    # to broadcast the lineitem-sized rows are shuffled twice (order key, supplier key)
    # instead of three times.
    order_nation = orders.join(customer, F.col("o_custkey") == F.col("c_custkey"))
    joined = li.join(order_nation, F.col("l_orderkey") == F.col("o_orderkey")).join(
        supplier, F.col("l_suppkey") == F.col("s_suppkey")
    )
    # Exact money in decimals; discount and tax are below 10.
    fare = F.col("l_extendedprice").cast("decimal(12,2)")
    discount = F.col("l_discount").cast("decimal(3,2)")
    keep = (F.lit(1) - discount).cast("decimal(3,2)")
    tax_up = (F.lit(1) + F.col("l_tax").cast("decimal(3,2)")).cast("decimal(3,2)")
    return joined.select(
        (F.col("l_suppkey") % 2).cast("int").alias("VendorID"),
        F.col("o_orderdate").alias("tpep_pickup_datetime"),
        F.col("l_shipdate").alias("tpep_dropoff_datetime"),
        F.col("l_linenumber").cast("double").alias("passenger_count"),
        F.col("l_quantity").alias("trip_distance"),
        F.col("c_nationkey").alias("PULocationID"),
        F.col("s_nationkey").alias("DOLocationID"),
        payment_code().alias("payment_type"),
        fare.cast("decimal(12,2)").alias("fare_amount"),
        (fare * discount).cast("decimal(16,4)").alias("tip_amount"),
        (fare * keep * tax_up).cast("decimal(18,6)").alias("total_amount"),
    )


def zones_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Zone lookup (LocationID, Borough, Zone): nations as zones, regions as boroughs."""
    nation = table(spark, sf_dir, "nation")
    region = table(spark, sf_dir, "region")
    return nation.join(region, F.col("n_regionkey") == F.col("r_regionkey")).select(
        F.col("n_nationkey").alias("LocationID"),
        F.col("r_name").alias("Borough"),
        F.col("n_name").alias("Zone"),
    )


def event_tasks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``events`` as a task table: app = event_type, stage = user_id, task = event_id.

    Run time is ``value`` seconds in ms; per-task byte counts come from the
    ``k`` field of ``props`` (input k MB, shuffle read k KB) and from the run
    time (shuffle write 1 KB per ms); GC is 1 ms per 100 ms of run time.
    Columns match :func:`fleetlens.sources.eventlog.EventLog.tasks`.
    """
    ev = table(spark, sf_dir, "events")
    run_ms = F.round(F.col("value") * 1000).cast("bigint")
    k = F.get_json_object("props", "$.k").cast("bigint")
    return ev.select(
        F.col("event_type").alias("app_id"),
        F.col("user_id").alias("stage_id"),
        F.lit(0).alias("stage_attempt"),
        F.col("event_id").alias("task_id"),
        run_ms.alias("run_ms"),
        F.lit(True).alias("successful"),
        F.floor(run_ms / 100).alias("gc_ms"),
        (k * 1_000_000).alias("input_bytes"),
        (k * 1000).alias("shuffle_read_bytes"),
        (run_ms * 1000).alias("shuffle_write_bytes"),
        F.unix_millis(F.col("ts").cast("timestamp")).alias("ts_ms"),
    )


def event_run_tables(spark: SparkSession, sf_dir: str, tasks: DataFrame | None = None) -> dict[str, DataFrame]:
    """apps / jobs / stages / tasks over ``events`` (``tasks`` may be passed in, e.g. staged).

    A stage is (event_type, user_id), submitted at its first event and
    completed at its last; each stage is one job, FAILED when the app is
    ``error``; an app spans its first to last event.
    """
    tasks = tasks if tasks is not None else event_tasks(spark, sf_dir)
    info = tasks.groupBy(*STAGE_KEY).agg(
        F.count("*").alias("num_tasks"),
        F.min("ts_ms").alias("submission_ms"),
        F.max("ts_ms").alias("completion_ms"),
        *task_total_aggs(),
    )
    stages = info.select(
        *STAGE_KEY,
        F.concat(F.lit("user "), F.col("stage_id").cast("string")).alias("name"),
        F.lit(None).cast("string").alias("description"),
        "num_tasks",
        "submission_ms",
        "completion_ms",
        F.lit("COMPLETE").alias("status"),
        "input_bytes",
        "shuffle_read_bytes",
        "shuffle_write_bytes",
        "gc_ms",
    )
    jobs = stages.select(
        "app_id",
        F.col("stage_id").alias("job_id"),
        "submission_ms",
        "completion_ms",
        F.when(F.col("app_id") == "error", "FAILED").otherwise("SUCCEEDED").alias("status"),
        "description",
        "name",
        "num_tasks",
    )
    apps = tasks.groupBy("app_id").agg(
        F.lit(None).cast("string").alias("attempt_id"),
        F.col("app_id").alias("app_name"),
        F.min("ts_ms").alias("start_ms"),
        F.max("ts_ms").alias("end_ms"),
        F.lit("events").alias("spark_version"),
        F.lit("events").alias("user"),
    )
    return {"apps": apps, "jobs": jobs, "stages": stages, "tasks": tasks}


ORDERS_APP = "orders"


def order_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per order key: number of lineitems and the last ship date."""
    return table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(
        F.count("*").alias("num_tasks"),
        F.max("l_shipdate").alias("last_ship"),
    )


def order_run_tables(spark: SparkSession, sf_dir: str, lines: DataFrame | None = None) -> dict[str, DataFrame]:
    """apps / jobs / job_stages / stages over ``orders`` and ``lineitem``.

    Every order is a job that lists one stage (id = order key); the stage ran
    when the order has lineitems (one task per line, done at the last ship
    date).  The stage of an order without lineitems is SKIPPED, or PENDING while
    the order is open.  Job
    status comes from the order status: F succeeded, P failed, O still running.
    """
    lines = lines if lines is not None else order_lines(spark, sf_dir)
    orders = table(spark, sf_dir, "orders")
    app = F.lit(ORDERS_APP).alias("app_id")
    nothing = F.lit(0).cast("bigint")
    totals = [nothing.alias(c) for c in TASK_TOTALS]
    ran = lines.select(
        app,
        F.col("l_orderkey").alias("stage_id"),
        F.lit(0).alias("stage_attempt"),
        F.col("num_tasks"),
        F.unix_millis(F.col("last_ship").cast("timestamp")).alias("completion_ms"),
        F.lit("COMPLETE").alias("status"),
        *totals,
    )
    waiting = orders.join(lines, F.col("o_orderkey") == F.col("l_orderkey"), "left_anti").select(
        app,
        F.col("o_orderkey").alias("stage_id"),
        F.lit(0).alias("stage_attempt"),
        nothing.alias("num_tasks"),
        F.lit(None).cast("bigint").alias("completion_ms"),
        F.when(F.col("o_orderstatus").isin("F", "P"), "SKIPPED").otherwise("PENDING").alias("status"),
        *totals,
    )
    stages = ran.unionByName(waiting)
    jobs = orders.join(lines, F.col("o_orderkey") == F.col("l_orderkey"), "left").select(
        app,
        F.col("o_orderkey").alias("job_id"),
        F.unix_millis(F.col("o_orderdate").cast("timestamp")).alias("submission_ms"),
        F.unix_millis(F.col("last_ship").cast("timestamp")).alias("completion_ms"),
        F.when(F.col("o_orderstatus") == "F", "SUCCEEDED")
        .when(F.col("o_orderstatus") == "P", "FAILED")
        .otherwise("RUNNING")
        .alias("status"),
        F.col("o_orderpriority").alias("description"),
        F.concat(F.lit("order "), F.col("o_orderkey").cast("string")).alias("name"),
        F.coalesce("num_tasks", F.lit(0).cast("bigint")).alias("num_tasks"),
    )
    job_stages = orders.select(app, F.col("o_orderkey").alias("job_id"), F.col("o_orderkey").alias("stage_id"))
    apps = jobs.groupBy("app_id").agg(
        F.lit(None).cast("string").alias("attempt_id"),
        F.max("app_id").alias("app_name"),
        F.min("submission_ms").alias("start_ms"),
        F.max("completion_ms").alias("end_ms"),
    )
    return {"apps": apps, "jobs": jobs, "job_stages": job_stages, "stages": stages}
