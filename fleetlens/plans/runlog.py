"""One call from an event-log directory to every run-metrics report.

Covers what a user of the reference runs against a history server: the
side-by-side summary of all apps (non-count metrics to one decimal), the
combined list of skewed stages, and per-app detail tables (headline numbers,
stage timeline, jobs, skipped stages, metric comparison), optionally with a
raw per-app dump of the parsed tables.  Everything is a Spark DataFrame over
the log files; nothing goes through a server or the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from fleetlens.operators import runmetrics as rm
from fleetlens.sources.eventlog import EventLog, dump_tables


def analyze(
    spark: SparkSession,
    log_dir: str,
    dump_dir: str | None = None,
    stage_once: bool = True,
    baseline_app_id: str | None = None,
) -> dict[str, DataFrame]:
    """Reports over every app logged under ``log_dir``.

    ``stage_once`` parses the logs once into Parquet (checkpoint dir) before
    building the reports; ``dump_dir`` also writes the parsed tables as JSON,
    one folder per app; ``baseline_app_id`` adds run-vs-run ratios.
    """
    log = EventLog(spark, log_dir)
    if stage_once:
        log = log.staged()
    t = log.tables()
    if dump_dir:
        dump_tables(t, dump_dir)
    summary = rm.app_summary(t["apps"], t["jobs"], t["stages"], digits=1)
    raw_summary = rm.app_summary(t["apps"], t["jobs"], t["stages"], ordered=False)
    out = {
        "summary": summary,
        "skew": rm.stage_skew(t["stages"], t["tasks"], t["apps"]),
        "detail": rm.app_detail(summary, t["apps"]),
        "timeline": rm.stage_timeline(t["apps"], t["stages"]),
        "jobs": rm.jobs_table(t["jobs"], t["job_stages"], t["stages"]),
        "skipped": rm.skipped_stages(t["job_stages"], t["stages"], t["jobs"]),
        "compare": rm.compare_long(raw_summary),
    }
    if baseline_app_id is not None:
        out["ratios"] = rm.compare_ratio(raw_summary, baseline_app_id)
    return out
