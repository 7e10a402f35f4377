"""Spark event logs as tables: apps, jobs, job_stages, stages and tasks.

Event logs are JSON lines, one listener event per line, written by every
application with ``spark.eventLog.enabled``.  Both layouts are read: a
single file per app (``<app-id>[.zstd|.lz4|...][.inprogress]``) and the
rolling directory ``eventlog_v2_<app-id>/events_<n>_<app-id>[.zstd]``.
Compressed files are decompressed by the text source (one task per file;
uncompressed logs split).

Only the event kinds used here are parsed: lines are first filtered on their
leading ``{"Event":"<kind>"`` text (Spark writes the Event field first), then
parsed once with an explicit schema, so the bulk of a log (task starts, SQL
plan updates, block updates) never reaches the JSON parser.

A log is the file or rolling directory of one attempt of an application.  Its
name comes from the path, because only the first file of a rolled log holds the
ApplicationStart event; the application and attempt come from that event, so
the logs ``app_1`` and ``app_2`` of one application are two attempts of it.
``apps()`` lists all attempts; jobs, stages and tasks are those of the attempt
that started last (ties: the larger attempt id).  A log without its
ApplicationStart event counts as an application of the log's name.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fleetlens.operators.runmetrics import STAGE_KEY, TASK_TOTALS, attempt_order, stage_task_totals
from fleetlens.sources.staging import fingerprint, staged

PREFIX = "SparkListener"
KINDS = [
    "LogStart", "ApplicationStart", "ApplicationEnd", "JobStart", "JobEnd",
    "StageSubmitted", "StageCompleted", "TaskEnd",
]

_L, _I, _S = T.LongType(), T.IntegerType(), T.StringType()


_STAGE_INFO = T.StructType(
    [
        T.StructField("Stage ID", _I),
        T.StructField("Stage Attempt ID", _I),
        T.StructField("Stage Name", _S),
        T.StructField("Number of Tasks", _I),
        T.StructField("Submission Time", _L),
        T.StructField("Completion Time", _L),
        T.StructField("Failure Reason", _S),
    ]
)

# Union of the fields read from all kinds; a field absent from a line parses as NULL.
EVENT_SCHEMA = T.StructType(
    [
        T.StructField("Event", _S),
        T.StructField("Spark Version", _S),
        T.StructField("App Name", _S),
        T.StructField("App ID", _S),
        T.StructField("App Attempt ID", _S),
        T.StructField("Timestamp", _L),
        T.StructField("User", _S),
        T.StructField("Job ID", _I),
        T.StructField("Submission Time", _L),
        T.StructField("Completion Time", _L),
        T.StructField("Stage IDs", T.ArrayType(_I)),
        T.StructField("Stage Infos", T.ArrayType(_STAGE_INFO)),
        T.StructField("Job Result", T.StructType([T.StructField("Result", _S)])),
        T.StructField("Properties", T.MapType(_S, _S)),
        T.StructField("Stage Info", _STAGE_INFO),
        T.StructField("Stage ID", _I),
        T.StructField("Stage Attempt ID", _I),
        T.StructField("Task End Reason", T.StructType([T.StructField("Reason", _S)])),
        T.StructField(
            "Task Info",
            T.StructType(
                [
                    T.StructField("Task ID", _L),
                    T.StructField("Attempt", _I),
                    T.StructField("Launch Time", _L),
                    T.StructField("Finish Time", _L),
                    T.StructField("Failed", T.BooleanType()),
                    T.StructField("Killed", T.BooleanType()),
                ]
            ),
        ),
        T.StructField(
            "Task Metrics",
            T.StructType(
                [
                    T.StructField("Executor Run Time", _L),
                    T.StructField("JVM GC Time", _L),
                    T.StructField("Input Metrics", T.StructType([T.StructField("Bytes Read", _L)])),
                    T.StructField(
                        "Shuffle Read Metrics",
                        T.StructType([T.StructField("Remote Bytes Read", _L), T.StructField("Local Bytes Read", _L)]),
                    ),
                    T.StructField(
                        "Shuffle Write Metrics", T.StructType([T.StructField("Shuffle Bytes Written", _L)])
                    ),
                ]
            ),
        ),
    ]
)

UNREAD = r"\.(lz4|lzf|snappy)(\.inprogress)?$"
_COMPRESSION = r"(\.(zstd|zst|lz4|lzf|snappy|gz))?"


def log_name(path: Column) -> Column:
    """Name of the log a file belongs to: the rolling directory's suffix, else the file name without extensions."""
    rolled = F.regexp_extract(path, r"eventlog_v2_([^/]+)/events_[^/]*$", 1)
    single = F.regexp_extract(path, r"([^/]+?)" + _COMPRESSION + r"(\.inprogress)?$", 1)
    return F.when(rolled != "", rolled).otherwise(single)


def is_wanted(value: Column) -> Column:
    """Whether a line is an event of a kind the tables need, however it is spaced."""
    return value.rlike(rf'^\s*\{{\s*"Event"\s*:\s*"{PREFIX.replace(".", "[.]")}({"|".join(KINDS)})"')


def refuse_unread(path: Column) -> Column:
    """True, or an error naming a log compressed with a codec the text reader cannot open."""
    message = F.concat(F.lit("event log with an unsupported codec: "), path)
    return F.when(path.rlike(UNREAD), F.raise_error(message).cast("boolean")).otherwise(F.lit(True))


def _e(name: str) -> Column:
    return F.col("e").getField(name)


def parse(lines: DataFrame) -> DataFrame:
    """(log, e) of the (log, value) lines that are events of a wanted kind."""
    return lines.filter(is_wanted(F.col("value"))).select("log", F.from_json("value", EVENT_SCHEMA).alias("e"))


class EventLog:
    """Tables over the event logs under ``path`` (a directory searched recursively, or a glob)."""

    def __init__(
        self, spark: SparkSession, path: str | list[str], lines: DataFrame | None = None,
        events: DataFrame | None = None,
    ):
        self.spark = spark
        self.paths = [path] if isinstance(path, str) else list(path)
        if events is None:
            if lines is None:
                path_col = F.col("_metadata.file_path")
                lines = (
                    spark.read.option("recursiveFileLookup", "true")
                    .text(self.paths)
                    .where(refuse_unread(path_col))
                    .select(log_name(path_col).alias("log"), "value")
                )
            events = parse(lines)
        self.events = events

    @classmethod
    def from_lines(cls, spark: SparkSession, lines: DataFrame) -> EventLog:
        """Build from a DataFrame of (log, value) lines."""
        return cls(spark, [], lines=lines)

    @classmethod
    def from_events(cls, spark: SparkSession, events: DataFrame) -> EventLog:
        """Build from a DataFrame of parsed events (log, e), as :func:`parse` gives."""
        return cls(spark, [], events=events)

    def staged(self) -> EventLog:
        """The same log with its parsed events written once as Parquet (checkpoint dir).

        Without staging every table re-reads and re-parses the text; staged,
        the JSON is parsed once and each table reads only the nested columns
        it needs from the columnar copy.  The copy is that of the files as
        they are now: new or longer logs are staged anew.
        """
        state = fingerprint(self.spark, *self.paths) if self.paths else uuid.uuid4().hex
        key = f"eventlog:{self.paths!r}:{state}"
        return EventLog(self.spark, self.paths, events=staged(self.spark, key, lambda: self.events))

    def headers(self) -> DataFrame:
        """One row per log that has its ApplicationStart event: log, app_id, attempt_id, start_ms."""
        first = F.min_by(
            F.struct(_e("App ID").alias("id"), _e("App Attempt ID").alias("attempt_id"), _e("Timestamp").alias("start_ms")),
            F.struct(_e("Timestamp"), _e("App Attempt ID")),
        )
        starts = self.events.filter(_e("Event") == f"{PREFIX}ApplicationStart")
        return (
            starts.groupBy("log").agg(first.alias("a"))
            .select("log", F.coalesce("a.id", "log").alias("app_id"), "a.attempt_id", "a.start_ms")
        )

    def latest_logs(self) -> DataFrame:
        """(log, app_id, latest): every log with a header, and whether it is its application's latest attempt."""
        heads = self.headers()
        latest = heads.groupBy("app_id").agg(F.max_by("log", F.struct(*attempt_order(), "log")).alias("last"))
        return heads.join(latest, "app_id").select("log", "app_id", (F.col("log") == F.col("last")).alias("latest"))

    def _kind(self, *kinds: str, every_attempt: bool = False) -> DataFrame:
        """(app_id, log, e) of these kinds, from each application's latest attempt unless all are asked for."""
        events = self.events.filter(_e("Event").isin([PREFIX + k for k in kinds])).join(self.latest_logs(), "log", "left")
        if not every_attempt:
            events = events.filter(F.coalesce("latest", F.lit(True)))
        return events.select(F.coalesce("app_id", "log").alias("app_id"), "log", "e")

    def apps(self) -> DataFrame:
        """One row per app attempt: ids, name, start/end (ms), Spark version and user."""
        fields = [_e("App Name").alias("app_name"), _e("User").alias("user")]
        start = self.headers().join(
            self._kind("ApplicationStart", every_attempt=True).groupBy("log").agg(F.first(F.struct(*fields)).alias("a")), "log"
        )
        end = self._kind("ApplicationEnd", every_attempt=True).groupBy("log").agg(F.max(_e("Timestamp")).alias("end_ms"))
        version = self._kind("LogStart", every_attempt=True).groupBy("log").agg(F.max(_e("Spark Version")).alias("spark_version"))
        return start.join(end, "log", "left").join(version, "log", "left").select(
            "app_id", "attempt_id", "a.app_name", "start_ms", "end_ms", "spark_version", "a.user"
        )

    def jobs(self) -> DataFrame:
        """One row per job: times (ms), status SUCCEEDED / FAILED / RUNNING, description, call site, tasks."""
        start = self._kind("JobStart").select(
            "app_id",
            _e("Job ID").cast("bigint").alias("job_id"),
            _e("Submission Time").alias("submission_ms"),
            _e("Properties").getItem("spark.job.description").alias("description"),
            # A job is named after the call site of its last stage.
            F.array_max(
                F.transform(_e("Stage Infos"), lambda s: F.struct(s["Stage ID"].alias("id"), s["Stage Name"].alias("n")))
            ).getField("n").alias("name"),
            F.aggregate(
                _e("Stage Infos"), F.lit(0).cast("bigint"), lambda acc, s: acc + s["Number of Tasks"]
            ).alias("num_tasks"),
        )
        end = self._kind("JobEnd").select(
            "app_id",
            _e("Job ID").cast("bigint").alias("job_id"),
            _e("Completion Time").alias("completion_ms"),
            _e("Job Result").getField("Result").alias("_result"),
        )
        status = (
            F.when(F.col("_result").isNull(), "RUNNING")
            .when(F.col("_result") == "JobSucceeded", "SUCCEEDED")
            .otherwise("FAILED")
        )
        return start.join(end, ["app_id", "job_id"], "left").select(
            "app_id", "job_id", "submission_ms", "completion_ms", status.alias("status"),
            "description", "name", "num_tasks",
        )

    def job_stages(self) -> DataFrame:
        """(app_id, job_id, stage_id) for every stage a job lists, whether it ran or not."""
        return self._kind("JobStart").select(
            "app_id",
            _e("Job ID").cast("bigint").alias("job_id"),
            F.explode(F.transform(_e("Stage IDs"), lambda x: x.cast("bigint"))).alias("stage_id"),
        )

    def tasks(self, every_attempt: bool = False) -> DataFrame:
        """One row per finished task attempt with its run time and byte / GC metrics.

        ``every_attempt`` gives the tasks of all logs, by log instead of app_id.
        """
        m = _e("Task Metrics")
        info = _e("Task Info")
        if every_attempt:
            ended = self.events.filter(_e("Event") == f"{PREFIX}TaskEnd")
        else:
            ended = self._kind("TaskEnd")
        return ended.select(
            "log" if every_attempt else "app_id",
            _e("Stage ID").cast("bigint").alias("stage_id"),
            _e("Stage Attempt ID").alias("stage_attempt"),
            info.getField("Task ID").alias("task_id"),
            m.getField("Executor Run Time").alias("run_ms"),
            (_e("Task End Reason").getField("Reason") == "Success").alias("successful"),
            m.getField("JVM GC Time").alias("gc_ms"),
            F.coalesce(m.getField("Input Metrics").getField("Bytes Read"), F.lit(0)).alias("input_bytes"),
            (
                F.coalesce(m.getField("Shuffle Read Metrics").getField("Remote Bytes Read"), F.lit(0))
                + F.coalesce(m.getField("Shuffle Read Metrics").getField("Local Bytes Read"), F.lit(0))
            ).alias("shuffle_read_bytes"),
            F.coalesce(m.getField("Shuffle Write Metrics").getField("Shuffle Bytes Written"), F.lit(0)).alias(
                "shuffle_write_bytes"
            ),
            info.getField("Launch Time").alias("launch_ms"),
            info.getField("Finish Time").alias("finish_ms"),
        )

    def stages(self, tasks: DataFrame | None = None) -> DataFrame:
        """One row per submitted stage attempt, and one per stage that a job listed but never submitted.

        An attempt's status is COMPLETE, FAILED (a failure reason was logged) or
        ACTIVE (no completion event yet) and its metrics are its tasks' sums.  A
        stage never submitted has no times and no metrics: SKIPPED when the last
        event of the jobs that list it is a job's end, PENDING while it is a start.
        """
        def info(kind: str) -> DataFrame:
            s = _e("Stage Info")
            return self._kind(kind).select(
                "app_id",
                s.getField("Stage ID").cast("bigint").alias("stage_id"),
                s.getField("Stage Attempt ID").alias("stage_attempt"),
                s.getField("Stage Name").alias("name"),
                s.getField("Number of Tasks").cast("bigint").alias("num_tasks"),
                s.getField("Submission Time").alias("submission_ms"),
                s.getField("Completion Time").alias("completion_ms"),
                s.getField("Failure Reason").alias("failure"),
                _e("Properties").getItem("spark.job.description").alias("description"),
            )

        sub, done = info("StageSubmitted"), info("StageCompleted")
        done = done.select(
            *STAGE_KEY,
            F.col("submission_ms").alias("_sub2"),
            F.col("completion_ms").alias("_done"),
            F.col("failure").alias("_failure"),
            F.lit(True).alias("_completed"),
        )
        totals = stage_task_totals(tasks if tasks is not None else self.tasks())
        status = (
            F.when(F.col("_completed").isNull(), "ACTIVE")
            .when(F.col("_failure").isNotNull(), "FAILED")
            .otherwise("COMPLETE")
        )
        zero = F.lit(0).cast("bigint")
        ran = (
            sub.join(done, STAGE_KEY, "left")
            .join(totals, STAGE_KEY, "left")
            .select(
                *STAGE_KEY,
                "name",
                "description",
                "num_tasks",
                F.coalesce("_sub2", "submission_ms").alias("submission_ms"),
                F.col("_done").alias("completion_ms"),
                status.alias("status"),
                *[F.coalesce(c, zero).alias(c) for c in TASK_TOTALS],
            )
        )
        waiting = self._listed_stages().join(sub.select("app_id", "stage_id"), ["app_id", "stage_id"], "left_anti")
        no_time = F.lit(None).cast("bigint")
        waiting = waiting.withColumns({"submission_ms": no_time, "completion_ms": no_time} | dict.fromkeys(TASK_TOTALS, zero))
        return ran.unionByName(waiting)

    def _listed_stages(self) -> DataFrame:
        """Every stage some job lists: its state if it is never submitted, with name, description and tasks as last listed."""
        ends = _e("Event") == f"{PREFIX}JobEnd"
        jobs = (
            self._kind("JobStart", "JobEnd")
            .groupBy("app_id", _e("Job ID").alias("job_id"))
            .agg(
                F.max(_e("Submission Time")).alias("started"),
                F.max(F.when(ends, _e("Completion Time"))).alias("ended"),
                F.max(_e("Properties").getItem("spark.job.description")).alias("description"),
                F.first(_e("Stage Infos"), ignorenulls=True).alias("infos"),
                F.first(_e("Stage IDs"), ignorenulls=True).alias("stages"),
            )
        )
        listed = jobs.withColumn("stage", F.explode("stages"))
        info = F.get(F.filter("infos", lambda s: s["Stage ID"] == F.col("stage")), F.lit(0))
        last = F.struct(F.coalesce("ended", "started").alias("at"), F.col("ended").isNotNull(), "job_id")
        state = F.struct(
            F.coalesce(info["Stage Attempt ID"], F.lit(0)).alias("stage_attempt"),
            info["Stage Name"].alias("name"),
            "description",
            F.coalesce(info["Number of Tasks"].cast("bigint"), F.lit(0).cast("bigint")).alias("num_tasks"),
            F.when(F.col("ended").isNull(), "PENDING").otherwise("SKIPPED").alias("status"),
        )
        by_stage = listed.groupBy("app_id", F.col("stage").cast("bigint").alias("stage_id"))
        folded = by_stage.agg(F.max_by(state, last).alias("s"))
        return folded.select("app_id", "stage_id", "s.*")

    def tables(self) -> dict[str, DataFrame]:
        tasks = self.tasks()
        return {
            "apps": self.apps(),
            "jobs": self.jobs(),
            "job_stages": self.job_stages(),
            "stages": self.stages(tasks),
            "tasks": tasks,
        }


def dump_tables(tables: dict[str, DataFrame], out_dir: str) -> None:
    """Write each table as JSON under ``out_dir/<table>/app_id=<id>/`` (raw per-app dump)."""
    for name, df in tables.items():
        # rebalance: files per app follow the app's size (a huge app is split over many tasks)
        df.hint("rebalance", "app_id").write.mode("overwrite").partitionBy("app_id").json(
            f"{out_dir.rstrip('/')}/{name}"
        )
