"""Incremental refresh of per-app summaries and skewed stages as event logs arrive or grow.

Two sources of lines:

* ``growing=False``: a file stream over a folder of *closed* logs (a file is
  read once, when first listed; ``*.inprogress`` files are skipped);
* ``growing=True``: :mod:`fleetlens.sources.growing`, which follows logs while
  applications write them.

A micro-batch reads its own lines and the state, never old lines.  The state is
mergeable, so it does not matter which lines came in which batch:

* ``heads``: one row per log (application, attempt, start);
* ``events``: parsed application, job and stage events, a few per stage;
* ``tasks``: per log, stage attempt, success and run time the number of tasks
  and their summed metrics: an exact histogram, from which the median and the
  maximum of a stage follow, however its tasks were spread over files.

A batch writes its part of the state as ``deltas/<epoch>`` (a replayed epoch
overwrites itself), finds the applications it touched, and recomputes their
rows from the state's buckets that hold their logs.  Every ``compact_every``
epochs snapshot and deltas are merged into ``snapshots/<epoch>``: equal keys are
added up, older parts are dropped, so folders listed per batch are bounded.  A
snapshot counts from the moment it is complete; deltas up to its epoch are
ignored from then on.

Results are ``<out>/summary`` and ``<out>/skew``, partitioned by app_id and
overwritten for the touched applications only.  An application shows when its
ApplicationStart event has been read.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.column import Column
from pyspark.sql.streaming import StreamingQuery

from fleetlens.operators import runmetrics
from fleetlens.operators.runmetrics import TASK_TOTALS
from fleetlens.session import cached
from fleetlens.sources.eventlog import EVENT_SCHEMA, PREFIX, EventLog, log_name, parse, refuse_unread

MAX_FILES = 1000
BUCKETS = 16
COMPACT_EVERY = 50
TASK_KEY = ["log", "stage_id", "stage_attempt", "successful", "run_ms"]

def _schema(**columns: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in columns.items()])


_L, _S, _I = T.LongType(), T.StringType(), T.IntegerType()
STATE = {
    "heads": _schema(log=_S, app_id=_S, attempt_id=_S, start_ms=_L, bucket=_I),
    "events": _schema(log=_S, e=EVENT_SCHEMA, bucket=_I),
    "tasks": _schema(
        log=_S, stage_id=_L, stage_attempt=_I, successful=T.BooleanType(), run_ms=_L, n=_L,
        **dict.fromkeys(TASK_TOTALS, _L), bucket=_I,
    ),
}


def bucket_of(log: str) -> Column:
    return F.pmod(F.xxhash64(log), F.lit(BUCKETS)).cast("int")


class RunState:
    """The mergeable state under ``root``: complete snapshots, and deltas since the last one."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root
        hadoop = spark._jvm.org.apache.hadoop.fs
        self._path = hadoop.Path
        self._fs = hadoop.Path(root).getFileSystem(spark._jsc.hadoopConfiguration())

    def _epochs(self, kind: str) -> list[int]:
        """Epochs that have a complete set of tables."""
        folder = self._path(f"{self.root}/{kind}")
        if not self._fs.exists(folder):
            return []
        names = [s.getPath().getName() for s in self._fs.listStatus(folder)]
        done = (n for n in names if n.isdigit() and self._fs.exists(self._path(f"{self.root}/{kind}/{n}/_COMPLETE")))
        return sorted(map(int, done))

    def _parts(self) -> list[str]:
        last = max(self._epochs("snapshots"), default=-1)
        parts = [f"snapshots/{last}"] if last >= 0 else []
        return parts + [f"deltas/{e}" for e in self._epochs("deltas") if e > last]

    def read(self, name: str) -> DataFrame:
        frames = [self.spark.read.schema(STATE[name]).parquet(f"{self.root}/{p}/{name}") for p in self._parts()]
        return reduce(DataFrame.unionByName, frames) if frames else self.spark.createDataFrame([], STATE[name])

    def _write(self, part: str, tables: dict[str, DataFrame]) -> None:
        marker = self._path(f"{self.root}/{part}/_COMPLETE")
        if self._fs.exists(marker):
            self._fs.delete(marker, False)
        for name, df in tables.items():
            columns = [f.name for f in STATE[name]]
            out = df.withColumn("bucket", bucket_of("log")).select(*columns).hint("rebalance", "bucket")
            out.write.mode("overwrite").partitionBy("bucket").parquet(f"{self.root}/{part}/{name}")
        self._fs.create(marker).close()

    def add(self, epoch: int, events: DataFrame) -> None:
        """The parsed events (log, e) of an epoch as its delta; nothing if a snapshot holds that epoch already."""
        if epoch <= max(self._epochs("snapshots"), default=-1):
            return
        log = EventLog.from_events(self.spark, events)
        done = log.tasks(every_attempt=True)
        sums = [F.sum(c).alias(c) for c in TASK_TOTALS]
        self._write(
            f"deltas/{epoch}",
            {
                "heads": log.headers(),
                "events": events.where(F.col("e.Event") != f"{PREFIX}TaskEnd"),
                "tasks": done.groupBy(*TASK_KEY).agg(F.count("*").alias("n"), *sums),
            },
        )

    def compact(self) -> None:
        """One snapshot of all that is there; what it replaces is removed after it is complete."""
        deltas, before = self._epochs("deltas"), self._epochs("snapshots")
        epoch = max(deltas + before)
        if epoch in before:
            return
        sums = [F.sum(c).alias(c) for c in ["n", *TASK_TOTALS]]
        tables = {
            "heads": self.read("heads"),
            "events": self.read("events"),
            "tasks": self.read("tasks").groupBy(*TASK_KEY).agg(*sums),
        }
        self._write(f"snapshots/{epoch}", tables)
        for kind, epochs in (("deltas", deltas), ("snapshots", before)):
            for old in epochs:
                self._fs.delete(self._path(f"{self.root}/{kind}/{old}"), True)

    def since_snapshot(self) -> int:
        return sum(p.startswith("deltas/") for p in self._parts())

    def tables(self, logs: list[str]) -> dict[str, DataFrame]:
        """apps, jobs, job_stages, stages, and tasks as a histogram (column n), of the applications these logs belong to."""
        heads = self.read("heads").select("log", "app_id")
        apps = heads.where(F.col("log").isin(logs)).select("app_id").distinct()
        # the touched applications' attempts: a few rows per touched log
        of_apps = heads.join(apps, "app_id", "left_semi").select("log", bucket_of("log").alias("bucket")).distinct().collect()
        names, buckets = [r["log"] for r in of_apps], sorted({r["bucket"] for r in of_apps})
        wanted = F.col("bucket").isin(buckets) & F.col("log").isin(names)
        log = EventLog.from_events(self.spark, self.read("events").where(wanted).select("log", "e"))
        latest = log.latest_logs().where("latest").select("log", "app_id")
        tasks = self.read("tasks").where(wanted).join(latest, "log").drop("log", "bucket")
        tasks = tasks.groupBy("app_id", *TASK_KEY[1:]).agg(*(F.sum(c).alias(c) for c in ["n", *TASK_TOTALS]))
        return {"apps": log.apps(), "jobs": log.jobs(), "job_stages": log.job_stages(), "stages": log.stages(tasks), "tasks": tasks}


class RunMetricsRefresh:
    """Keeps ``<out>/summary`` and ``<out>/skew`` up to date from logs landing or growing in ``logs``."""

    def __init__(
        self, spark: SparkSession, logs: str, out_dir: str, digits: int | None = 1, growing: bool = False,
        compact_every: int = COMPACT_EVERY,
    ):
        self.spark = spark
        self.logs = logs
        self.out = out_dir.rstrip("/")
        self.digits = digits
        self.growing = growing
        self.compact_every = compact_every
        self.state = RunState(spark, f"{self.out}/state")

    def stream(self) -> DataFrame:
        """(log, value) lines."""
        if self.growing:
            from fleetlens.sources.growing import GrowingLogs

            self.spark.dataSource.register(GrowingLogs)
            return self.spark.readStream.format(GrowingLogs.name()).load(self.logs)
        path = F.col("_metadata.file_path")
        return (
            self.spark.readStream.format("text")
            .option("maxFilesPerTrigger", MAX_FILES)
            .load(self.logs)
            .filter(~path.endswith(".inprogress"))
            .filter(refuse_unread(path))
            .select(log_name(path).alias("log"), "value")
        )

    def process_batch(self, batch: DataFrame, epoch_id: int) -> None:
        with cached(parse(batch)) as events:
            # one log per new file or grown file at most
            touched = [r["log"] for r in events.select("log").distinct().collect()]
            if not touched:
                return
            self.state.add(epoch_id, events)
        t = self.state.tables(touched)
        with cached(t["tasks"]) as tasks, cached(t["stages"]) as stages, cached(t["apps"]) as apps:
            summary = runmetrics.app_summary(apps, t["jobs"], stages, self.digits)
            skew = runmetrics.stage_skew(stages, tasks, apps, weight="n")
            # an app without a skewed stage gets a row without one, which replaces what it had before
            skew = apps.select("app_id").distinct().join(skew, "app_id", "left")
            for name, df in (("summary", summary), ("skew", skew)):
                (
                    df.write.mode("overwrite")
                    .option("partitionOverwriteMode", "dynamic")
                    .partitionBy("app_id")
                    .parquet(f"{self.out}/{name}")
                )
        if self.state.since_snapshot() >= self.compact_every:
            self.state.compact()

    def start(self, checkpoint: str, available_now: bool = False, interval: str = "5 seconds") -> StreamingQuery:
        writer = self.stream().writeStream.foreachBatch(self.process_batch).option("checkpointLocation", checkpoint)
        writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime=interval)
        return writer.start()

    def _result(self, name: str) -> DataFrame:
        # app ids are text, also where all of them look like numbers
        df = self.spark.read.option("basePath", f"{self.out}/{name}").parquet(f"{self.out}/{name}")
        return df.withColumn("app_id", F.col("app_id").cast("string"))

    def summary(self) -> DataFrame:
        return self._result("summary")

    def skew(self) -> DataFrame:
        return self._result("skew").where("stage_id is not null")
