from __future__ import annotations

import os
import random
import subprocess
import sys
import tempfile

import pytest
from pyspark.sql import functions as F

from conftest import ROOT, write_event_logs
from fleetlens.operators import runmetrics as rm
from fleetlens.sources.eventlog import EventLog, log_name, dump_tables
from fleetlens.streaming.refresh import RunMetricsRefresh


@pytest.fixture()
def hand_log(spark, scratch):
    root = write_event_logs(os.path.join(scratch, "logs"))
    return EventLog(spark, root).tables()


def test_log_name(spark):
    paths = [
        "file:/x/eventlog_v2_local-17/events_2_local-17.zstd",
        "file:/x/app-2024-0001.lz4.inprogress",
        "file:/x/local-99",
    ]
    got = [r.a for r in spark.createDataFrame([(p,) for p in paths], "p string")
           .select(log_name(F.col("p")).alias("a")).collect()]
    assert got == ["local-17", "app-2024-0001", "local-99"]


def test_tables_from_hand_log(hand_log):
    t = hand_log
    assert sorted(r.app_id for r in t["apps"].collect()) == ["app-bad", "app-good", "app-idle"]
    status = {(r.app_id, r.job_id): r.status for r in t["jobs"].collect()}
    assert status == {("app-good", 0): "SUCCEEDED", ("app-bad", 0): "SUCCEEDED", ("app-bad", 1): "FAILED"}
    stages = {(r.app_id, r.stage_id): r.status for r in t["stages"].collect()}
    assert stages[("app-bad", 6)] == "FAILED" and stages[("app-bad", 1)] == "COMPLETE"
    assert ("app-bad", 2) not in stages  # listed, never submitted
    # the rolled log's two files are one app
    assert t["tasks"].filter(F.col("app_id") == "app-good").count() == 4


def test_app_summary_zero_fills_and_excludes_nothing_run(hand_log):
    t = hand_log
    rows = {r.app: r for r in rm.app_summary(t["apps"], t["jobs"], t["stages"]).collect()}
    idle = rows["idle"]
    assert (idle.jobs, idle.failed_jobs, idle.stages, idle.tasks, idle.input_MB) == (0, 0, 0, 0, 0.0)
    assert idle.duration_s == 1.5
    good = rows["good"]
    assert (good.jobs, good.stages, good.tasks) == (1, 1, 4)
    assert good.input_MB == 8.0 and good.shuffle_write_MB == 4.0 and good.duration_s == 10.0
    bad = rows["bad"]
    assert (bad.jobs, bad.failed_jobs, bad.stages, bad.tasks) == (2, 1, 5, 31)


def test_skew_thresholds(hand_log):
    t = hand_log
    out = rm.stage_skew(t["stages"], t["tasks"], t["apps"]).collect()
    assert [(r.app, r.stage_id) for r in out] == [("bad", 1)]
    r = out[0]
    assert r.tasks == 16 and r.median_task_s == 0.01 and r.max_task_s == 27.065
    assert r.description == "map at b.py:3"  # empty description falls back to the name
    # one app only, and the empty case is an empty frame
    assert rm.stage_skew(t["stages"], t["tasks"], t["apps"], app_id="app-good").count() == 0
    # lowering the floor to 999 ms flags stage 4; a ratio just under 5 flags stage 5 (exactly 5x)
    low = rm.stage_skew(t["stages"], t["tasks"], t["apps"], min_max_ms=999)
    assert {r.stage_id for r in low.collect()} == {1, 4}
    loose = rm.stage_skew(t["stages"], t["tasks"], t["apps"], ratio=4.99)
    assert {r.stage_id for r in loose.collect()} == {1, 5}


def test_jobs_table_and_skipped_stages(hand_log):
    t = hand_log
    skipped = rm.skipped_stages(t["job_stages"], t["stages"]).collect()
    assert [(r.app_id, r.job_id, r.stage_id) for r in skipped] == [("app-bad", 0, 2)]
    rows = {(r.app_id, r.job_id): r for r in rm.jobs_table(t["jobs"], t["job_stages"], t["stages"]).collect()}
    j = rows[("app-bad", 0)]
    assert j.status == "✅ Succeeded" and j.skipped_stages == 1 and j.num_tasks == 27
    assert j.duration_s == 35.1 and j.name == "collect at b.py:4"
    assert rows[("app-bad", 1)].status == "❌ Failed"


def test_stage_timeline(hand_log):
    t = hand_log
    rows = {(r.app_id, r.stage_id): r for r in rm.stage_timeline(t["apps"], t["stages"]).collect()}
    s = rows[("app-good", 0)]
    assert (s.stage, s.status, s.label, s.start_s, s.end_s) == ("Stage 0", "Complete", "count rows", 1.1, 2.1)
    assert s.duration_s == pytest.approx(1.0)
    assert rows[("app-bad", 6)].status == "Failed"
    assert len([k for k in rows if k[0] == "app-bad"]) == 5  # stage 2 was skipped


def test_compare_long_and_ratio(hand_log):
    t = hand_log
    summary = rm.app_summary(t["apps"], t["jobs"], t["stages"])
    long = rm.compare_long(summary)
    assert long.count() == 3 * 7
    ratio = {r.app_id: r for r in rm.compare_ratio(summary, "app-good").collect()}
    assert ratio["app-good"].tasks_ratio == 1.0
    assert ratio["app-bad"].tasks_ratio == 31 / 4
    assert ratio["app-idle"].input_ratio == 0.0


def test_group_quantile_matches_brute_force(spark):
    rnd = random.Random(3)
    rows = []
    for g in range(40):
        n = rnd.choice([1, 2, 3, 4, 5, 16, 101])
        hot = rnd.random() < 0.3
        for _ in range(n):
            v = rnd.choice([7, 7, 7, 1000]) if hot else rnd.randint(-50, 10**7)
            rows.append((g % 7, g, v))
    df = spark.createDataFrame(rows, "a int, g int, v bigint")
    for q in (0.0, 0.25, 0.5, 0.9, 1.0):
        got = {(r.a, r.g): r.x for r in rm.group_quantile(df, ["a", "g"], "v", q, "x").collect()}
        want = {}
        groups: dict = {}
        for a, g, v in rows:
            groups.setdefault((a, g), []).append(v)
        for k, vs in groups.items():
            vs.sort()
            want[k] = vs[min(int(q * len(vs)), len(vs) - 1)]
        assert got == want, q


def test_dump_tables_partitions_by_app(spark, hand_log, scratch):
    out = os.path.join(scratch, "dump")
    dump_tables({"jobs": hand_log["jobs"]}, out)
    assert sorted(d for d in os.listdir(f"{out}/jobs") if d.startswith("app_id=")) == [
        "app_id=app-bad", "app_id=app-good"
    ]
    assert spark.read.json(f"{out}/jobs").count() == 3


LIVE_APP = r"""
import sys, time
from pyspark.sql import SparkSession
log_dir, compress = sys.argv[1], sys.argv[2]
s = (SparkSession.builder.master("local[4]").appName("live skew")
     .config("spark.ui.enabled", "false").config("spark.eventLog.enabled", "true")
     .config("spark.eventLog.dir", log_dir).config("spark.eventLog.compress", compress)
     .getOrCreate())
s.sparkContext.setJobDescription("slow partition")
def slow(it):
    from pyspark import TaskContext
    if TaskContext.get().partitionId() == 0:
        time.sleep(3.0)
    for pdf in it:
        yield pdf
s.range(0, 1600, 1, 16).mapInPandas(slow, "id long").count()
s.stop()
"""


@pytest.mark.parametrize("compress", ["true", "false"])
def test_live_log_finds_injected_skew(spark, compress):
    log_dir = tempfile.mkdtemp(prefix="fleetlens-live-")
    subprocess.run([sys.executable, "-c", LIVE_APP, log_dir, compress], check=True, timeout=300,
                   cwd=ROOT, capture_output=True)
    t = EventLog(spark, log_dir).tables()
    assert t["apps"].first().app_name == "live skew"
    skew = rm.stage_skew(t["stages"], t["tasks"], t["apps"]).collect()
    assert len(skew) == 1
    assert skew[0].tasks == 16 and skew[0].max_task_s >= 3.0
    assert skew[0].description == "slow partition"


def test_incremental_refresh_equals_batch(spark, scratch):
    from conftest import event_log_lines

    apps = event_log_lines()
    landing = os.path.join(scratch, "landing")
    os.makedirs(landing)
    out, ckpt = os.path.join(scratch, "out"), os.path.join(scratch, "ckpt")
    refresh = RunMetricsRefresh(spark, landing + "/*", out)
    write_event_logs(landing, {"app-bad": apps["app-bad"], "app-idle": apps["app-idle"]})
    refresh.start(ckpt, available_now=True).awaitTermination(120)
    first = {r.app_id: r for r in refresh.summary().collect()}
    assert set(first) == {"app-bad", "app-idle"}
    # a second app lands; untouched apps keep their rows, and the result equals a batch run
    write_event_logs(landing, {"app-good": apps["app-good"]})
    refresh2 = RunMetricsRefresh(spark, landing + "/*", out)
    refresh2.start(ckpt, available_now=True).awaitTermination(120)
    batch_t = EventLog(spark, landing).tables()
    batch = rm.app_summary(batch_t["apps"], batch_t["jobs"], batch_t["stages"], 1)
    cols = batch.columns
    assert sorted(refresh2.summary().select(*cols).collect()) == sorted(batch.collect())
    assert [(r.app_id, r.stage_id) for r in refresh2.skew().collect()] == [("app-bad", 1)]


def test_staged_event_log_gives_the_same_tables(spark, scratch):
    root = write_event_logs(os.path.join(scratch, "logs"))
    raw = EventLog(spark, root)
    staged = raw.staged()
    for name, df in raw.tables().items():
        other = staged.tables()[name]
        assert sorted(map(tuple, df.collect())) == sorted(map(tuple, other.select(*df.columns).collect())), name
    from fleetlens.plans.inspect import plan_text

    text = plan_text(staged.tasks(), "simple")
    assert "FileScan parquet" in text and "FileScan text" not in text


def test_analyze_a_log_directory_end_to_end(spark, scratch):
    from fleetlens.plans.runlog import analyze

    root = write_event_logs(os.path.join(scratch, "logs"))
    out = analyze(spark, root, dump_dir=os.path.join(scratch, "dump"), baseline_app_id="app-good")
    assert [r.app for r in out["summary"].collect()] == ["bad", "good", "idle"]  # listed by name
    assert [(r.app, r.stage_id) for r in out["skew"].collect()] == [("bad", 1)]
    assert out["skipped"].count() == 1 and out["jobs"].count() == 3
    assert out["compare"].count() == 21 and out["ratios"].count() == 3
    assert os.path.isdir(os.path.join(scratch, "dump", "tasks"))


def test_quantile_and_skew_on_empty_tasks(spark):
    empty = spark.createDataFrame([], "app_id string, stage_id bigint, stage_attempt int, run_ms bigint, successful boolean")
    assert rm.group_quantile(empty, ["app_id", "stage_id", "stage_attempt"], "run_ms", 0.5, "m").count() == 0
    stages = spark.createDataFrame(
        [("a", 1, 0, "COMPLETE", 8, "n", None)],
        "app_id string, stage_id bigint, stage_attempt int, status string, num_tasks bigint, name string, description string",
    )
    assert rm.stage_skew(stages, empty).count() == 0


def test_log_with_only_an_app_start(spark, scratch):
    import json

    root = os.path.join(scratch, "logs")
    os.makedirs(root)
    with open(os.path.join(root, "local-1"), "w") as f:
        f.write(json.dumps({"Event": "SparkListenerApplicationStart", "App Name": "x", "App ID": "local-1",
                            "Timestamp": 1, "User": "u"}, separators=(",", ":")) + "\n")
    t = EventLog(spark, root).tables()
    summary = rm.app_summary(t["apps"], t["jobs"], t["stages"]).collect()
    assert len(summary) == 1 and summary[0].jobs == 0 and summary[0].duration_s is None  # still running
