"""Attempts by log content, fresh staging, mergeable refresh state and growing logs."""

from __future__ import annotations

import json
import os
import random

import pytest
from pyspark.sql import functions as F

from conftest import event_log_lines, write_event_logs
from fleetlens.operators import runmetrics as rm
from fleetlens.plans.runlog import analyze
from fleetlens.sources import growing
from fleetlens.sources.eventlog import EventLog
from fleetlens.streaming.refresh import RunMetricsRefresh


def text(events):
    return "".join(json.dumps(e, separators=(",", ":")) + "\n" for e in events)


def attempt(events, attempt_id, shift, app_id=None):
    """The events of a log as another attempt that starts ``shift`` ms later."""
    out = []
    for e in events:
        e = dict(e)
        if e["Event"].endswith("ApplicationStart"):
            e |= {"App Attempt ID": attempt_id, "Timestamp": e["Timestamp"] + shift} | ({"App ID": app_id} if app_id else {})
        if e["Event"].endswith("ApplicationEnd"):
            e["Timestamp"] += shift
        out.append(e)
    return out


def put(root, name, content):
    os.makedirs(os.path.dirname(os.path.join(root, name)), exist_ok=True)
    with open(os.path.join(root, name), "w") as f:
        f.write(content)


def test_attempts_of_one_application_fold(spark, scratch):
    """Attempts 2 and 10 in single files, attempt 1 rolled: one application, the latest start's jobs and tasks."""
    apps = event_log_lines()
    good, bad = apps["app-good"], apps["app-bad"]
    put(scratch, "logs/x_2", text(attempt(bad, "2", 0, "x")))
    put(scratch, "logs/x_10", text(attempt(good, "10", 900_000, "x")))
    first = attempt(bad, "1", -40_000, "x")
    put(scratch, "logs/eventlog_v2_x_1/events_1_x_1", text(first[:9]))
    put(scratch, "logs/eventlog_v2_x_1/events_2_x_1", text(first[9:]))
    put(scratch, "logs/app-idle", text(apps["app-idle"]))
    t = EventLog(spark, f"{scratch}/logs").tables()
    assert sorted((r.app_id, r.attempt_id) for r in t["apps"].collect()) == [
        ("app-idle", None), ("x", "1"), ("x", "10"), ("x", "2"),
    ]
    rows = {r.app_id: r for r in rm.app_summary(t["apps"], t["jobs"], t["stages"]).collect()}
    assert set(rows) == {"app-idle", "x"}
    assert (rows["x"].app, rows["x"].jobs, rows["x"].tasks) == ("good", 1, 4)
    assert t["tasks"].groupBy("app_id").count().collect()[0]["count"] == 4
    assert rm.stage_skew(t["stages"], t["tasks"], t["apps"]).isEmpty()


@pytest.mark.parametrize("starts, latest", [((5, 5), "10"), ((None, 7), "9"), ((7, None), "10"), ((None, None), "10")])
def test_latest_attempt_with_ties_and_unknown_starts(spark, starts, latest):
    rows = [("a", "10", "x", starts[0], 1, "v", "u"), ("a", "9", "x", starts[1], 1, "v", "u")]
    apps = spark.createDataFrame(
        rows, "app_id string, attempt_id string, app_name string, start_ms long, end_ms long, spark_version string, user string"
    )
    got = rm.latest_attempts(apps).collect()
    assert [(r.app_id, r.attempt_id, r.app_name) for r in got] == [("a", latest, "x")]


def test_log_without_its_start_is_an_application_of_its_name(spark, scratch):
    put(scratch, "logs/late", text(event_log_lines()["app-good"][2:]))
    t = EventLog(spark, f"{scratch}/logs").tables()
    assert t["apps"].isEmpty() and {r.app_id for r in t["jobs"].collect()} == {"late"}


def test_analyze_sees_logs_that_came_later(spark, scratch):
    apps = event_log_lines()
    write_event_logs(f"{scratch}", {"app-bad": apps["app-bad"]})
    assert analyze(spark, scratch)["summary"].count() == 1
    write_event_logs(f"{scratch}", {"app-idle": apps["app-idle"]})
    assert analyze(spark, scratch)["summary"].count() == 2
    put(scratch, "app-idle", text(attempt(apps["app-idle"], None, 5)))  # rewritten
    assert {r.app_id for r in analyze(spark, scratch)["summary"].collect()} == {"app-bad", "app-idle"}


def test_staged_lines_are_not_mixed_up(spark):
    apps = event_log_lines()
    logs = {
        name: EventLog.from_lines(spark, spark.createDataFrame([(name, line) for line in text(apps[name]).splitlines()], "log string, value string"))
        for name in ("app-good", "app-bad")
    }
    staged = {name: log.staged().tables()["apps"].first().app_id for name, log in logs.items()}
    assert staged == {"app-good": "app-good", "app-bad": "app-bad"}


def test_stages_that_never_ran_are_rows(spark, scratch):
    put(scratch, "app-bad", text(event_log_lines()["app-bad"]))
    t = EventLog(spark, scratch).staged().tables()
    (skipped,) = t["stages"].where("status in ('SKIPPED', 'PENDING')").collect()
    assert (skipped.stage_id, skipped.status, skipped.submission_ms, skipped.input_bytes) == (2, "SKIPPED", None, 0)
    ran = t["stages"].where("status <> 'SKIPPED'")
    both = [rm.app_summary(t["apps"], t["jobs"], s).collect() for s in (t["stages"], ran)]
    assert both[0] == both[1]  # a skipped stage counts nowhere
    states = {r.status: r.stages for r in rm.stage_states(t["stages"]).collect()}
    assert states["SKIPPED"] == 1 and sum(states.values()) == ran.count() + 1


def test_the_last_event_of_its_jobs_decides_a_stage_that_never_ran(spark, scratch):
    def job(job_id, start, stages, end=None):
        infos = [{"Stage ID": s, "Stage Attempt ID": 0, "Stage Name": f"stage {s}", "Number of Tasks": 2 + s} for s in stages]
        yield {"Event": "SparkListenerJobStart", "Job ID": job_id, "Submission Time": start, "Stage IDs": stages, "Stage Infos": infos}
        if end is not None:
            yield {"Event": "SparkListenerJobEnd", "Job ID": job_id, "Completion Time": end, "Job Result": {"Result": "JobSucceeded"}}

    lines = [
        {"Event": "SparkListenerApplicationStart", "App Name": "a", "App ID": "a", "Timestamp": 1, "User": "u"},
        *job(0, 10, [0, 1, 2], 20),
        *job(1, 30, [1, 3]),
        *job(2, 15, [2, 4], 40),
        *job(3, 50, [5], 50),
    ]
    put(scratch, "a", text(lines))
    t = EventLog(spark, scratch).staged().tables()
    got = {r.stage_id: (r.status, r.name, r.num_tasks) for r in t["stages"].collect()}
    pending = {1, 3}  # listed by a job that still runs
    assert got == {s: ("PENDING" if s in pending else "SKIPPED", f"stage {s}", 2 + s) for s in range(6)}


def test_running_jobs_have_no_skipped_stages(spark, scratch):
    running = [e for e in event_log_lines()["app-bad"] if e["Event"].removeprefix("SparkListener") not in ("JobEnd", "StageCompleted")]
    put(scratch, "app-bad", text([e for e in running if not (e["Event"].endswith("StageSubmitted") and e["Stage Info"]["Stage ID"] > 3)]))
    out = analyze(spark, scratch)
    assert out["skipped"].isEmpty() and {r.skipped_stages for r in out["jobs"].collect()} == {0}


def test_quantile_of_null_keys_and_histograms(spark):
    values = [(None, 1, 5), (None, 1, 9), (None, 1, 7), ("a", None, 3), ("a", None, 4), (None, None, 8), ("b", 2, None)]
    df = spark.createDataFrame(values, "k string, g int, v long")
    got = {(r.k, r.g): (r.x, r.n) for r in rm.group_quantile(df, ["k", "g"], "v", 0.5, "x", "n").collect()}
    assert got == {(None, 1): (7, 3), ("a", None): (4, 2), (None, None): (8, 1)}
    rnd = random.Random(1)
    rows = [(rnd.randint(0, 3), rnd.randint(0, 10**6), rnd.randint(1, 5)) for _ in range(300)]
    weighted = spark.createDataFrame(rows, "g int, v long, n long")
    spread = weighted.withColumn("one", F.explode(F.sequence(F.lit(1), "n")))
    a = rm.group_quantile(weighted, ["g"], "v", 0.5, "x", "n", "mx", weight="n").collect()
    b = rm.group_quantile(spread, ["g"], "v", 0.5, "x", "n", "mx").collect()
    assert sorted(a) == sorted(b)



def batch_result(spark, root):
    t = EventLog(spark, root).tables()
    summary = rm.app_summary(t["apps"], t["jobs"], t["stages"], 1)
    return sorted(map(tuple, summary.collect()), key=str), sorted(map(tuple, rm.stage_skew(t["stages"], t["tasks"], t["apps"]).collect()), key=str)


def ordered(refresh, spark, root):
    """The refreshed results with their columns in the order a batch run has."""
    t = EventLog(spark, root).tables()
    summary = rm.app_summary(t["apps"], t["jobs"], t["stages"], 1).columns
    skew = rm.stage_skew(t["stages"], t["tasks"], t["apps"]).columns
    return (
        sorted(map(tuple, refresh.summary().select(*summary).collect()), key=str),
        sorted(map(tuple, refresh.skew().select(*skew).collect()), key=str),
    )


def test_state_is_equal_to_batch_in_any_order_with_compaction_and_replay(spark, scratch):
    """Logs cut in pieces, dealt over epochs in a random order; epochs replayed before and after compaction."""
    apps = event_log_lines()
    logs = {
        "app-bad_1": attempt(apps["app-bad"], "1", 0), "app-bad_2": attempt(apps["app-bad"], "2", 500_000),
        "app-good": apps["app-good"], "app-idle": apps["app-idle"],
    }
    rnd = random.Random(5)
    pieces = []
    for name, events in logs.items():
        put(scratch, f"logs/{name}", text(events))
        cuts = sorted({0, len(events), *(rnd.randrange(len(events)) for _ in range(3))})
        pieces += [[(name, line) for line in text(events[a:b]).splitlines()] for a, b in zip(cuts, cuts[1:], strict=False)]
    rnd.shuffle(pieces)
    epochs = [sum(pieces[i::4], []) for i in range(4)]
    refresh = RunMetricsRefresh(spark, f"{scratch}/logs", f"{scratch}/out", compact_every=3)
    frames = [spark.createDataFrame(rows, "log string, value string").repartition(2) for rows in epochs]
    refresh.process_batch(frames[0], 0)
    refresh.process_batch(frames[0], 0)  # replayed
    refresh.process_batch(frames[1], 1)
    assert refresh.state._epochs("snapshots") == []
    refresh.process_batch(frames[2], 2)
    assert refresh.state._epochs("snapshots") == [2] and refresh.state._epochs("deltas") == []
    refresh.process_batch(frames[2], 2)  # replayed after it went into the snapshot
    refresh.process_batch(frames[3], 3)
    assert refresh.state._epochs("deltas") == [3]
    assert ordered(refresh, spark, f"{scratch}/logs") == batch_result(spark, f"{scratch}/logs")
    assert {r.app_id: r.tasks for r in refresh.summary().collect()} == {"app-bad": 31, "app-good": 4, "app-idle": 0}
    refresh.state.compact()
    tasks = refresh.state.read("tasks")
    assert tasks.agg(F.sum("n")).first()[0] == 31 * 2 + 4  # each attempt once, failed tasks too
    assert tasks.count() == tasks.select("log", "stage_id", "stage_attempt", "successful", "run_ms").distinct().count()


def test_a_batch_reads_no_old_lines(spark, scratch):
    """Only the delta and the state's folders are in the plans of a batch's results."""
    apps = event_log_lines()
    write_event_logs(f"{scratch}", {"app-bad": apps["app-bad"]})
    refresh = RunMetricsRefresh(spark, scratch, f"{scratch}/out")
    lines = spark.createDataFrame([("app-bad", line) for line in text(apps["app-bad"]).splitlines()], "log string, value string")
    refresh.process_batch(lines, 0)
    files = {f.split("/out/")[1].split("/")[0] for t in refresh.state.tables(["app-bad"]).values() for f in t.inputFiles()}
    assert files == {"state"}


# --- growing logs ---------------------------------------------------------------------------


def lines_of(reader, start, end):
    rows = [b for p in reader.partitions(start, end) for b in reader.read(p)]
    return [(log, value) for b in rows for log, value in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True)]


@pytest.mark.parametrize("split", [1, 7, 64, 1 << 20])
def test_reader_gives_every_whole_line_once(scratch, split):
    rnd = random.Random(split)
    content = [f"{i}:" + "é" * rnd.randint(0, 40) for i in range(60)] + ["", "x" * 300]
    whole = "".join(f"{line}\n" for line in content).encode()
    reader, offset, seen = growing.GrowingLogReader(scratch, split), {}, []
    os.makedirs(f"{scratch}/eventlog_v2_b")
    path = f"{scratch}/eventlog_v2_b/events_1_b"
    for stop in [0, 1, 200, 201, 777, len(whole) - 1, len(whole)]:
        with open(path + ".inprogress", "wb") as f:
            f.write(whole[:stop])
        end = reader.latestOffset()
        seen += lines_of(reader, offset, end)
        offset = end
    assert seen == [("b", line) for line in content]
    os.rename(path + ".inprogress", path)
    assert reader.latestOffset() == offset and lines_of(reader, offset, offset) == []
    with open(path, "ab") as f:
        f.write(b"more\n")
    assert lines_of(reader, offset, reader.latestOffset()) == [("b", "more")]


def test_reader_refuses_compressed_logs(scratch):
    put(scratch, "app.zstd.inprogress", "x\n")
    with pytest.raises(ValueError, match="compressed"):
        growing.GrowingLogReader(scratch).latestOffset()


def test_refresh_of_growing_logs_across_a_restart(spark, scratch):
    apps = event_log_lines()
    logs, out, checkpoint = (f"{scratch}/{d}" for d in ("logs", "out", "checkpoint"))
    bad, idle = text(apps["app-bad"]), text(apps["app-idle"])
    put(logs, "app-bad.inprogress", bad[:2000])  # ends inside a line

    def run():
        refresh = RunMetricsRefresh(spark, logs, out, growing=True)
        query = refresh.start(checkpoint, interval="0 seconds")
        return refresh, query

    refresh, query = run()
    query.processAllAvailable()
    assert {r.app_id: r.duration_s for r in refresh.summary().collect()} == {"app-bad": None}
    put(logs, "app-bad.inprogress", bad[:6000])
    put(logs, "app-idle", idle)
    query.processAllAvailable()
    query.stop()
    os.rename(f"{logs}/app-bad.inprogress", f"{logs}/app-bad")
    put(logs, "app-bad", bad)
    write_event_logs(logs, {"app-good": apps["app-good"]})
    refresh, query = run()
    query.processAllAvailable()
    query.stop()
    assert ordered(refresh, spark, logs) == batch_result(spark, logs)
    assert refresh.state.read("tasks").agg(F.sum("n")).first()[0] == 31 + 4
