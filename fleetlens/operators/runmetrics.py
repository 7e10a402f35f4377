"""Run-metrics analytics over tables of applications, jobs, stages and tasks.

Input tables (built by :mod:`fleetlens.sources.eventlog` from event logs, or
by the fixture adapters) and their columns:

* ``apps``: app_id, attempt_id, app_name, start_ms, end_ms, spark_version, user
* ``jobs``: app_id, job_id, submission_ms, completion_ms, status, description, name, num_tasks
* ``job_stages``: app_id, job_id, stage_id (stages a job lists, run or not)
* ``stages``: app_id, stage_id, stage_attempt, name, description, num_tasks,
  submission_ms, completion_ms, status, input_bytes, shuffle_read_bytes,
  shuffle_write_bytes, gc_ms (one row per stage attempt that was submitted)
* ``tasks``: app_id, stage_id, stage_attempt, task_id, run_ms, successful, ...

Every summary pre-aggregates each child table by its key before joining
(jobs and stages per app separately), so joins never fan out, and an app
without jobs or stages still gets a row with zeros.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fleetlens import functions as fx

STAGE_KEY = ["app_id", "stage_id", "stage_attempt"]


# --- exact per-group quantile --------------------------------------------------------------

def _log_bucket(v: Column) -> Column:
    """Monotone bucket of a number: 16 buckets per power of two, mirrored for negatives."""
    mag = F.floor(F.log2(F.abs(v) + 1) * 16)
    return F.when(v < 0, -mag - 1).otherwise(mag)


def group_quantile(
    df: DataFrame, keys: list[str], value: str, q: float, out: str, count_col: str | None = None,
    max_col: str | None = None, weight: str | None = None,
) -> DataFrame:
    """Per group of ``keys``: the value at 0-based index ``min(floor(q·n), n-1)`` of the sorted values.

    That is the index rule of the monitoring API's task summaries (the upper
    median for even n at q = 0.5).  Exact, and no task ever holds a whole
    group: values are first counted per distinct value (map-side combine), the
    counts are folded into at most ~2,000 log-scale buckets per group to find
    the bucket holding the wanted index, and only that bucket's distinct
    values are ordered.  ``count_col`` / ``max_col`` also return the group's
    size and largest value, which fall out of the bucket pass for free.
    ``weight`` names a column that says how many values a row stands for (a
    histogram).  NULL values are left out; NULL keys are keys like any other.
    """
    size = F.count("*") if weight is None else F.sum(weight)
    hist = df.where(F.col(value).isNotNull()).groupBy(*keys, value).agg(size.alias("_c")).withColumn("_b", _log_bucket(F.col(value)))
    buckets = hist.groupBy(*keys, "_b").agg(F.sum("_c").alias("_bc"), F.max(value).alias("_bmax"))
    group = Window.partitionBy(*keys)
    before = group.orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    picked = (
        buckets.withColumns(
            {
                "_n": F.sum("_bc").over(group),
                "_max": F.max("_bmax").over(group),
                "_before": F.coalesce(F.sum("_bc").over(before), F.lit(0)),
            }
        )
        .withColumn("_k", F.least(F.floor(F.col("_n") * q), F.col("_n") - 1))
        .filter((F.col("_before") <= F.col("_k")) & (F.col("_k") < F.col("_before") + F.col("_bc")))
        .select(
            *(F.col(k).alias(f"_key{i}") for i, k in enumerate(keys)), F.col("_b").alias("_pb"),
            (F.col("_k") - F.col("_before")).alias("_r"), "_n", "_max",
        )
    )
    same = F.col("_b") == F.col("_pb")
    for i, k in enumerate(keys):  # a NULL key joins with NULL
        same &= F.col(k).eqNullSafe(F.col(f"_key{i}"))
    in_bucket = hist.join(picked, same)
    before_v = Window.partitionBy(*keys).orderBy(value).rowsBetween(Window.unboundedPreceding, -1)
    extra = ([F.col("_n").alias(count_col)] if count_col else []) + ([F.col("_max").alias(max_col)] if max_col else [])
    return (
        in_bucket.withColumn("_vb", F.coalesce(F.sum("_c").over(before_v), F.lit(0)))
        .filter((F.col("_vb") <= F.col("_r")) & (F.col("_r") < F.col("_vb") + F.col("_c")))
        .select(*keys, F.col(value).alias(out), *extra)
    )


# --- per-stage and per-app tables -----------------------------------------------------------

# Stages that a job lists but never submitted: their job still runs, or ended without them.
NOT_SUBMITTED = ["PENDING", "SKIPPED"]
TASK_TOTALS = ["input_bytes", "shuffle_read_bytes", "shuffle_write_bytes", "gc_ms"]


def task_total_aggs() -> list[Column]:
    """Aggregates summing the task metrics a stage reports."""
    return [F.sum(c).alias(c) for c in TASK_TOTALS]


def stage_task_totals(tasks: DataFrame) -> DataFrame:
    """Summed task metrics per stage attempt (what a stage reports for its tasks)."""
    return tasks.groupBy(*STAGE_KEY).agg(*task_total_aggs())


def attempt_order() -> list[Column]:
    """What orders the attempts of an application: start (unknown first), attempt number, attempt id as text."""
    return [F.col("start_ms"), F.expr("try_cast(attempt_id as bigint)").alias("_number"), F.col("attempt_id")]


def latest_attempts(apps: DataFrame) -> DataFrame:
    """One row per app: its attempt with the latest start (ties: the larger attempt id)."""
    cols = [c for c in apps.columns if c != "app_id"]
    latest = F.max_by(F.struct(*cols), F.struct(*attempt_order())).alias("a")
    return apps.groupBy("app_id").agg(latest).select("app_id", "a.*")


def app_summary(
    apps: DataFrame, jobs: DataFrame, stages: DataFrame, digits: int | None = None, ordered: bool = True
) -> DataFrame:
    """Per app: wall time, jobs (failed), stages, tasks, MB read, MB shuffle-written, GC seconds.

    Skipped stages did no work and are left out.  With ``digits`` the
    non-count metrics are rounded half up to that many decimals.  ``ordered``
    lists apps by name (as the report does); turn it off when the summary
    only feeds another operator, to spare the sort.
    """
    job_counts = jobs.groupBy("app_id").agg(
        F.count("*").alias("jobs"), F.count_if(F.col("status") == "FAILED").alias("failed_jobs")
    )
    stage_sums = (
        stages.filter(F.col("status") != "SKIPPED")
        .groupBy("app_id")
        .agg(
            F.count("*").alias("stages"),
            F.sum("num_tasks").alias("tasks"),
            F.sum("input_bytes").alias("_in"),
            F.sum("shuffle_write_bytes").alias("_sw"),
            F.sum("gc_ms").alias("_gc"),
        )
    )
    zero = F.lit(0).cast("bigint")
    out = (
        latest_attempts(apps)
        .join(job_counts, "app_id", "left")
        .join(stage_sums, "app_id", "left")
        .select(
            F.col("app_name").alias("app"),
            "app_id",
            ((F.col("end_ms") - F.col("start_ms")) / 1000.0).alias("duration_s"),
            F.coalesce("jobs", zero).alias("jobs"),
            F.coalesce("failed_jobs", zero).alias("failed_jobs"),
            F.coalesce("stages", zero).alias("stages"),
            F.coalesce("tasks", zero).cast("bigint").alias("tasks"),
            (F.coalesce("_in", zero) / 1e6).alias("input_MB"),
            (F.coalesce("_sw", zero) / 1e6).alias("shuffle_write_MB"),
            (F.coalesce("_gc", zero) / 1000.0).alias("gc_s"),
        )
    )
    if digits is not None:
        # counts stay whole numbers; every other compared metric is rounded
        rounded = [m for m in fx.COMPARE_METRICS if m not in fx.COUNT_METRICS]
        out = out.withColumns({m: fx.half_up(m, digits) for m in rounded})
    return out.orderBy("app", "app_id") if ordered else out


def app_detail(summary: DataFrame, apps: DataFrame, app_id: str | None = None) -> DataFrame:
    """Headline numbers per app (or of one app): summary plus version, user and start time."""
    attrs = latest_attempts(apps).select(
        "app_id",
        "spark_version",
        "user",
        F.timestamp_millis("start_ms").cast("timestamp_ntz").alias("start_time"),
    )
    out = summary.join(attrs, "app_id")
    out = out.filter(F.col("app_id") == app_id) if app_id is not None else out
    return out.orderBy("app", "app_id")


def stage_skew(
    stages: DataFrame,
    tasks: DataFrame,
    apps: DataFrame | None = None,
    ratio: float = fx.SKEW_RATIO,
    min_max_ms: int = fx.SKEW_MIN_MAX_MS,
    min_tasks: int = fx.SKEW_MIN_TASKS,
    app_id: str | None = None,
    weight: str | None = None,
) -> DataFrame:
    """Completed stages whose slowest successful task ran ``ratio``× the median or more.

    A stage qualifies when it is COMPLETE, has at least ``min_tasks`` tasks,
    its slowest task took at least ``min_max_ms`` and more than
    ``ratio · max(median, 1)``.  Over all apps unless ``app_id`` is given; an
    empty result means no skewed stage.  ``weight`` names a column of ``tasks``
    that says how many tasks a row stands for.
    """
    eligible = stages.filter((F.col("status") == "COMPLETE") & (F.col("num_tasks") >= min_tasks))
    if app_id is not None:
        eligible = eligible.filter(F.col("app_id") == app_id)
        tasks = tasks.filter(F.col("app_id") == app_id)
    # few stages reach the floor: one partial maximum names them before any value is counted
    slow = eligible.join(
        tasks.filter(F.col("successful")).groupBy(*STAGE_KEY).agg(F.max("run_ms").alias("_max")).where(F.col("_max") >= min_max_ms),
        STAGE_KEY,
    ).select(*STAGE_KEY)
    ok = tasks.filter(F.col("successful")).join(slow, STAGE_KEY, "left_semi")
    quantiles = group_quantile(ok, STAGE_KEY, "run_ms", 0.5, "median_ms", max_col="max_ms", weight=weight)
    flagged = (
        eligible.join(quantiles, STAGE_KEY)
        .filter(
            (F.col("max_ms") >= min_max_ms)
            & (F.col("max_ms") > F.lit(ratio) * F.greatest(F.col("median_ms"), F.lit(1)))
        )
    )
    if apps is not None:
        names = latest_attempts(apps).select("app_id", F.col("app_name").alias("app"))
        flagged = flagged.join(names, "app_id", "left")
    else:
        flagged = flagged.withColumn("app", F.col("app_id"))
    return flagged.select(
        "app_id",
        "app",
        "stage_id",
        "stage_attempt",
        F.col("num_tasks").alias("tasks"),
        (F.col("median_ms") / 1000.0).alias("median_task_s"),
        (F.col("max_ms") / 1000.0).alias("max_task_s"),
        fx.text_or_fallback("description", "name", 60).alias("description"),
    ).orderBy("app", "app_id", "stage_id", "stage_attempt")


def stage_timeline(apps: DataFrame, stages: DataFrame, app_id: str | None = None) -> DataFrame:
    """Each run stage with start/end seconds from its app's start, duration, label and shuffle MB."""
    starts = latest_attempts(apps).select("app_id", F.col("start_ms").alias("_app_start"))
    run = stages.filter(F.col("status") != "SKIPPED").dropna(subset=["submission_ms", "completion_ms"])
    if app_id is not None:
        run = run.filter(F.col("app_id") == app_id)
    return (
        run.join(starts, "app_id")
        .select(
            "app_id",
            "stage_id",
            "stage_attempt",
            fx.stage_label("stage_id").alias("stage"),
            F.initcap("status").alias("status"),
            F.coalesce("description", "name").alias("label"),
            fx.seconds_between_ms("_app_start", "submission_ms").alias("start_s"),
            fx.seconds_between_ms("_app_start", "completion_ms").alias("end_s"),
            "num_tasks",
            ((F.col("shuffle_write_bytes") + F.col("shuffle_read_bytes")) / 1e6).alias("shuffle_MB"),
        )
        .withColumn("duration_s", F.col("end_s") - F.col("start_s"))
        .orderBy("app_id", "stage_id", "stage_attempt")
    )


def skipped_stages(job_stages: DataFrame, stages: DataFrame, jobs: DataFrame | None = None) -> DataFrame:
    """(app_id, job_id, stage_id) of stages a job listed but that were never submitted.

    With ``jobs``, only jobs that have ended count: a running job's stages may
    still be submitted.
    """
    if jobs is not None:
        ended = jobs.where("status <> 'RUNNING'").select("app_id", "job_id")
        job_stages = job_stages.join(ended, ["app_id", "job_id"], "left_semi")
    submitted = stages.where(~F.col("status").isin(NOT_SUBMITTED)).select("app_id", "stage_id").distinct()
    return job_stages.select("app_id", "job_id", "stage_id").join(submitted, ["app_id", "stage_id"], "left_anti")


def stage_states(stages: DataFrame) -> DataFrame:
    """Stages and their tasks per application and status."""
    return stages.groupBy("app_id", "status").agg(F.count("*").alias("stages"), F.sum("num_tasks").alias("tasks"))


def job_status_label(status: str | Column) -> Column:
    """Display label for a job status; unknown statuses pass through."""
    status = F.col(status) if isinstance(status, str) else status
    expr = None
    for raw, label in fx.JOB_STATUS_LABELS.items():
        expr = F.when(status == raw, label) if expr is None else expr.when(status == raw, label)
    return expr.otherwise(status)


def jobs_table(jobs: DataFrame, job_stages: DataFrame, stages: DataFrame) -> DataFrame:
    """Per job: id, description, display status, duration (s), tasks, skipped stages, call site."""
    skipped = skipped_stages(job_stages, stages, jobs).groupBy("app_id", "job_id").agg(F.count("*").alias("_skipped"))
    return jobs.join(skipped, ["app_id", "job_id"], "left").select(
        "app_id",
        "job_id",
        "description",
        job_status_label("status").alias("status"),
        fx.seconds_between_ms("submission_ms", "completion_ms").alias("duration_s"),
        "num_tasks",
        F.coalesce("_skipped", F.lit(0).cast("bigint")).alias("skipped_stages"),
        "name",
    ).orderBy("app_id", "job_id")


def compare_long(summary: DataFrame, metrics: list[str] | None = None) -> DataFrame:
    """Summary metrics unpivoted to (app_id, app, metric, value) for side-by-side comparison."""
    metrics = metrics or fx.COMPARE_METRICS
    wide = summary.select("app_id", "app", *[F.col(m).cast("double").alias(m) for m in metrics])
    return wide.unpivot(["app_id", "app"], metrics, "metric", "value")


RATIO_METRICS = {
    "duration_s": "duration_ratio",
    "stages": "stages_ratio",
    "tasks": "tasks_ratio",
    "input_MB": "input_ratio",
    "shuffle_write_MB": "shuffle_ratio",
}


def compare_ratio(summary: DataFrame, baseline_app_id: str) -> DataFrame:
    """Each app's metrics divided by the baseline app's (NULL where the baseline is 0 or missing).

    The baseline is one aggregated row, joined on its app id.
    """
    base = (
        summary.filter(F.col("app_id") == baseline_app_id)
        .groupBy(F.col("app_id").alias("baseline"))
        .agg(*(F.max(F.col(m).cast("double")).alias(f"_{m}") for m in RATIO_METRICS))
    )
    cols = [F.try_divide(F.col(m).cast("double"), F.col(f"_{m}")).alias(r) for m, r in RATIO_METRICS.items()]
    named = summary.withColumn("baseline", F.lit(baseline_app_id))
    return named.join(base, "baseline", "left").select("app_id", "app", "baseline", *cols)

