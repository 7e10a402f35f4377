from __future__ import annotations

import datetime as dt
import json
import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    s = (
        SparkSession.builder.master("local[*]")
        .appName("fleetlens tests")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    s.sparkContext.setLogLevel("ERROR")
    from fleetlens.session import ensure_checkpoint_dir

    ensure_checkpoint_dir(s)
    yield s
    s.stop()


@pytest.fixture()
def scratch():
    """A fresh scratch directory per test (never reused, never removed by us)."""
    return tempfile.mkdtemp(prefix="fleetlens-test-")


def T(s: str) -> dt.datetime:
    return dt.datetime.fromisoformat(s)


RAW_COLUMNS = [
    "VendorID", "tpep_pickup_datetime", "tpep_dropoff_datetime", "passenger_count", "trip_distance",
    "PULocationID", "DOLocationID", "payment_type", "fare_amount", "tip_amount", "total_amount",
]

# (label, row) — the junk list of the reference's cleaning step plus edge cases.
RAW_TRIPS = [
    ("ok_card", (1, T("2024-01-05 08:00:00"), T("2024-01-05 08:30:00"), 1.0, 5.0, 1, 2, 1, 20.0, 4.0, 26.0)),
    ("ok_cash", (2, T("2024-01-05 09:00:00"), T("2024-01-05 09:12:00"), 2.0, 2.0, 1, 3, 2, 10.0, 0.0, 12.0)),
    ("year_2002", (1, T("2002-12-31 23:00:00"), T("2002-12-31 23:20:00"), 1.0, 3.0, 1, 2, 1, 12.0, 2.0, 15.0)),
    ("year_2009", (1, T("2009-01-01 00:10:00"), T("2009-01-01 00:30:00"), 1.0, 3.0, 1, 2, 1, 12.0, 2.0, 15.0)),
    ("negative_fare", (1, T("2024-02-01 10:00:00"), T("2024-02-01 10:20:00"), 1.0, 3.0, 1, 2, 2, -12.0, 0.0, -12.0)),
    ("zero_miles", (1, T("2024-02-01 11:00:00"), T("2024-02-01 11:20:00"), 1.0, 0.0, 1, 2, 2, 12.0, 0.0, 13.0)),
    ("upper_end", (2, T("2024-04-01 00:00:00"), T("2024-04-01 00:30:00"), 1.0, 4.0, 2, 1, 1, 18.0, 3.0, 23.0)),
    ("after_end", (2, T("2024-04-01 00:00:01"), T("2024-04-01 00:30:00"), 1.0, 4.0, 2, 1, 1, 18.0, 3.0, 23.0)),
    ("null_payment", (1, T("2024-03-01 12:00:00"), T("2024-03-01 12:45:00"), None, 7.0, 3, 1, None, 25.0, 0.0, 28.0)),
    ("zero_payment", (1, T("2024-03-01 13:00:00"), T("2024-03-01 13:45:00"), 1.0, 7.0, 3, 1, 0, 25.0, 0.0, 28.0)),
    ("dispute", (1, T("2024-03-02 13:00:00"), T("2024-03-02 13:15:00"), 1.0, 2.5, 3, 1, 4, 11.0, 0.0, 12.0)),
    ("no_charge", (1, T("2024-03-02 14:00:00"), T("2024-03-02 14:15:00"), 1.0, 0.5, 3, 1, 3, 8.0, 0.0, 9.0)),
    ("sixty_point_three_s", (1, T("2024-01-10 10:00:00.100"), T("2024-01-10 10:01:00.400"), 1.0, 0.3, 1, 1, 2, 3.0, 0.0, 4.0)),
    ("subsecond_trunc", (1, T("2024-01-10 10:00:00.900"), T("2024-01-10 10:02:00.100"), 1.0, 0.6, 1, 1, 2, 5.0, 0.0, 6.0)),
    ("too_long", (1, T("2024-01-11 10:00:00"), T("2024-01-11 13:00:00"), 1.0, 30.0, 1, 1, 1, 90.0, 10.0, 100.0)),
    ("dup_a", (2, T("2024-01-12 07:00:00"), T("2024-01-12 07:20:00"), 1.0, 3.0, 2, 3, 1, 14.0, 2.0, 17.0)),
    ("dup_b", (2, T("2024-01-12 07:00:00"), T("2024-01-12 07:20:00"), 1.0, 3.0, 2, 3, 1, 14.0, 2.0, 17.0)),
    ("far", (1, T("2024-01-13 07:00:00"), T("2024-01-13 08:00:00"), 1.0, 120.0, 2, 3, 1, 300.0, 0.0, 310.0)),
    ("big_fare", (1, T("2024-01-14 07:00:00"), T("2024-01-14 08:00:00"), 1.0, 60.0, 2, 9, 1, 950.0, 50.0, 1010.0)),
]

KEPT = {"ok_card", "ok_cash", "upper_end", "null_payment", "zero_payment", "dispute", "no_charge",
        "subsecond_trunc", "dup_a", "dup_b", "big_fare"}


@pytest.fixture()
def raw_trips(spark):
    from pyspark.sql import types as T_

    schema = T_.StructType(
        [
            T_.StructField("VendorID", T_.IntegerType()),
            T_.StructField("tpep_pickup_datetime", T_.TimestampNTZType()),
            T_.StructField("tpep_dropoff_datetime", T_.TimestampNTZType()),
            T_.StructField("passenger_count", T_.DoubleType()),
            T_.StructField("trip_distance", T_.DoubleType()),
            T_.StructField("PULocationID", T_.IntegerType()),
            T_.StructField("DOLocationID", T_.IntegerType()),
            T_.StructField("payment_type", T_.LongType()),
            T_.StructField("fare_amount", T_.DoubleType()),
            T_.StructField("tip_amount", T_.DoubleType()),
            T_.StructField("total_amount", T_.DoubleType()),
            T_.StructField("label", T_.StringType()),
        ]
    )
    return spark.createDataFrame([(*row, label) for label, row in RAW_TRIPS], schema)


ZONES = [
    (1, "Manhattan", "Midtown"), (2, "Manhattan", "Harlem"), (3, "Manhattan", "SoHo"),
    (4, "Queens", "Astoria"), (5, "Queens", "Flushing"), (6, "Queens", "Jamaica"),
    (7, "Brooklyn", "Bushwick"), (8, "Brooklyn", "DUMBO"), (9, "Brooklyn", "Red Hook"),
]


@pytest.fixture()
def zones(spark):
    return spark.createDataFrame(ZONES, "LocationID int, Borough string, Zone string")


# --- hand-written event log ----------------------------------------------------------------

def _task(stage, attempt, task_id, run_ms, reason="Success", gc=1, read=0, write=0, inp=0):
    return {
        "Event": "SparkListenerTaskEnd", "Stage ID": stage, "Stage Attempt ID": attempt,
        "Task Type": "ResultTask", "Task End Reason": {"Reason": reason},
        "Task Info": {"Task ID": task_id, "Attempt": 0, "Launch Time": 1000, "Finish Time": 1000 + run_ms,
                      "Failed": reason != "Success", "Killed": False},
        "Task Metrics": {"Executor Run Time": run_ms, "JVM GC Time": gc,
                         "Input Metrics": {"Bytes Read": inp},
                         "Shuffle Read Metrics": {"Remote Bytes Read": read, "Local Bytes Read": read},
                         "Shuffle Write Metrics": {"Shuffle Bytes Written": write}},
    }


def _stage_info(stage, n, name, sub=None, done=None, failure=None):
    info = {"Stage ID": stage, "Stage Attempt ID": 0, "Stage Name": name, "Number of Tasks": n}
    if sub is not None:
        info["Submission Time"] = sub
    if done is not None:
        info["Completion Time"] = done
    if failure is not None:
        info["Failure Reason"] = failure
    return info


def event_log_lines() -> dict[str, list[dict]]:
    """Three apps: a good one, one with failures / skew / a skipped stage, one with no jobs."""
    good = [
        {"Event": "SparkListenerLogStart", "Spark Version": "4.1.2"},
        {"Event": "SparkListenerApplicationStart", "App Name": "good", "App ID": "app-good", "Timestamp": 1_000, "User": "ann"},
        {"Event": "SparkListenerJobStart", "Job ID": 0, "Submission Time": 2_000,
         "Stage Infos": [_stage_info(0, 4, "count at a.py:1")], "Stage IDs": [0],
         "Properties": {"spark.job.description": "count rows"}},
        {"Event": "SparkListenerStageSubmitted", "Stage Info": _stage_info(0, 4, "count at a.py:1", sub=2_100),
         "Properties": {"spark.job.description": "count rows"}},
        *[_task(0, 0, i, 100 + i, write=1_000_000, inp=2_000_000) for i in range(4)],
        {"Event": "SparkListenerStageCompleted", "Stage Info": _stage_info(0, 4, "count at a.py:1", 2_100, 3_100)},
        {"Event": "SparkListenerJobEnd", "Job ID": 0, "Completion Time": 3_200, "Job Result": {"Result": "JobSucceeded"}},
        {"Event": "SparkListenerApplicationEnd", "Timestamp": 11_000},
    ]
    bad = [
        {"Event": "SparkListenerLogStart", "Spark Version": "4.1.2"},
        {"Event": "SparkListenerApplicationStart", "App Name": "bad", "App ID": "app-bad", "Timestamp": 50_000, "User": "bob"},
        # job 0: stages 1 (skewed, n=16), 2 (skipped), 3 (3 tasks, large ratio)
        {"Event": "SparkListenerJobStart", "Job ID": 0, "Submission Time": 51_000,
         "Stage Infos": [_stage_info(1, 16, "map at b.py:3"), _stage_info(2, 8, "map at b.py:2"),
                         _stage_info(3, 3, "collect at b.py:4")],
         "Stage IDs": [1, 2, 3], "Properties": {"spark.job.description": ""}},
        {"Event": "SparkListenerStageSubmitted", "Stage Info": _stage_info(1, 16, "map at b.py:3", sub=51_100),
         "Properties": {"spark.job.description": ""}},
        *[_task(1, 0, 100 + i, 10, read=500_000) for i in range(15)],
        _task(1, 0, 115, 27_065, read=500_000),
        {"Event": "SparkListenerStageCompleted", "Stage Info": _stage_info(1, 16, "map at b.py:3", 51_100, 80_000)},
        {"Event": "SparkListenerStageSubmitted", "Stage Info": _stage_info(3, 3, "collect at b.py:4", sub=80_100)},
        _task(3, 0, 200, 10), _task(3, 0, 201, 10), _task(3, 0, 202, 5_000),
        {"Event": "SparkListenerStageCompleted", "Stage Info": _stage_info(3, 3, "collect at b.py:4", 80_100, 86_000)},
        {"Event": "SparkListenerJobEnd", "Job ID": 0, "Completion Time": 86_100, "Job Result": {"Result": "JobSucceeded"}},
        # job 1: stage 4 max 999 ms (too short), stage 5 max exactly 5x median (not >), stage 6 fails
        {"Event": "SparkListenerJobStart", "Job ID": 1, "Submission Time": 90_000,
         "Stage Infos": [_stage_info(4, 4, "a"), _stage_info(5, 4, "b"), _stage_info(6, 4, "c")],
         "Stage IDs": [4, 5, 6], "Properties": {"spark.job.description": "checks"}},
        {"Event": "SparkListenerStageSubmitted", "Stage Info": _stage_info(4, 4, "a", sub=90_100),
         "Properties": {"spark.job.description": "checks"}},
        _task(4, 0, 300, 1), _task(4, 0, 301, 1), _task(4, 0, 302, 1), _task(4, 0, 303, 999),
        {"Event": "SparkListenerStageCompleted", "Stage Info": _stage_info(4, 4, "a", 90_100, 91_200)},
        {"Event": "SparkListenerStageSubmitted", "Stage Info": _stage_info(5, 4, "b", sub=91_300),
         "Properties": {"spark.job.description": "checks"}},
        _task(5, 0, 400, 100), _task(5, 0, 401, 200), _task(5, 0, 402, 300), _task(5, 0, 403, 1500),
        {"Event": "SparkListenerStageCompleted", "Stage Info": _stage_info(5, 4, "b", 91_300, 93_000)},
        {"Event": "SparkListenerStageSubmitted", "Stage Info": _stage_info(6, 4, "c", sub=93_100),
         "Properties": {"spark.job.description": "checks"}},
        _task(6, 0, 500, 10), _task(6, 0, 501, 10), _task(6, 0, 502, 10),
        _task(6, 0, 503, 9_000, reason="ExceptionFailure"),
        {"Event": "SparkListenerStageCompleted",
         "Stage Info": _stage_info(6, 4, "c", 93_100, 99_000, failure="Job aborted")},
        {"Event": "SparkListenerJobEnd", "Job ID": 1, "Completion Time": 99_500,
         "Job Result": {"Result": "JobFailed", "Exception": {"Message": "boom"}}},
        {"Event": "SparkListenerApplicationEnd", "Timestamp": 100_000},
    ]
    idle = [
        {"Event": "SparkListenerLogStart", "Spark Version": "4.1.2"},
        {"Event": "SparkListenerApplicationStart", "App Name": "idle", "App ID": "app-idle", "Timestamp": 5_000, "User": "cy"},
        {"Event": "SparkListenerApplicationEnd", "Timestamp": 6_500},
    ]
    return {"app-good": good, "app-bad": bad, "app-idle": idle}


def write_event_logs(root: str, apps: dict[str, list[dict]] | None = None) -> str:
    """Write the hand log: app-good as a rolled directory (2 files), the others as single files."""
    apps = apps or event_log_lines()
    for app_id, events in apps.items():
        lines = [json.dumps(e, separators=(",", ":")) for e in events]
        if app_id == "app-good":
            d = os.path.join(root, f"eventlog_v2_{app_id}")
            os.makedirs(d, exist_ok=True)
            half = len(lines) // 2
            for n, chunk in ((1, lines[:half]), (2, lines[half:])):
                with open(os.path.join(d, f"events_{n}_{app_id}"), "w") as f:
                    f.write("\n".join(chunk) + "\n")
            open(os.path.join(d, f"appstatus_{app_id}"), "w").close()
        else:
            with open(os.path.join(root, app_id), "w") as f:
                f.write("\n".join(lines) + "\n")
    return root
