from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from assayworks.operators import eventlog as E
from assayworks.operators import status as S
from tests.shapes import CHECKS, JOB_LOG, NOON, RUNS, TASKS, values

HOUR = timedelta(hours=1)


def runs(spark, *rows):
    """(job_run_id, started_at, recorded_at)"""
    return spark.createDataFrame([(i, done, "c", "s", "dev", None, start, "url") for i, start, done in rows], RUNS)


def outcome(spark, tasks, warnings=(), started=NOON, recorded=NOON + HOUR):
    log = spark.createDataFrame([("x", "p", "c", kind, status, "m", at) for kind, status, at in warnings], CHECKS)
    found = S.run_outcomes(
        runs(spark, ("1", started, recorded)), spark.createDataFrame([("1", *t) for t in tasks], TASKS), log)
    assert found.count() == 1
    return found.first()


OK = [(0, "run_a", "SUCCESS", None), (1, "run_b", "SUCCESS", None)]


@pytest.mark.parametrize("tasks, status, key, message", [
    (OK, "SUCCESS", None, None),
    ([(1, "b", "FAILED", "late"), (0, "a", "SUCCESS", None)], "FAILED", "b", "late"),
    ([(1, "b", "TIMEDOUT", "two"), (0, "a", "CANCELED", "one")], "FAILED", "a", "one"),
    ([(0, "finalize_ops_status", "FAILED", "own")], "SUCCESS", None, None),
    ([(0, "a", "FAILED", None)], "FAILED", "a", None),
    ([(0, "a", "FAILED", "y" * 600)], "FAILED", "a", "y" * 500),
    ([(0, "a", "SKIPPED", None), (1, "b", None, None)], "SUCCESS", None, None),
    ([], "UNKNOWN", None, None),
])
def test_outcomes(spark, tasks, status, key, message):
    row = outcome(spark, tasks)
    assert (row.overall_status, row.failed_task_key, row.failure_message) == (status, key, message)
    assert (row.git_sha, row.duration_seconds, row.completed_at) == ("unknown", 3600, NOON + HOUR)
    assert tuple(row.asDict()) == S.JOB_LOG_COLUMNS


@pytest.mark.parametrize("kind, status, at, expected", [
    ("direct", "WARN", NOON, "WARNING"),
    ("direct", "WARN", NOON + HOUR, "WARNING"),
    ("direct", "WARN", NOON - timedelta(seconds=1), "SUCCESS"),
    ("direct", "WARN", NOON + HOUR + timedelta(seconds=1), "SUCCESS"),
    ("expectation", "WARN", NOON, "SUCCESS"),
    ("direct", "FAIL", NOON, "SUCCESS"),
])
def test_direct_warnings_during_the_run_lift_success(spark, kind, status, at, expected):
    assert outcome(spark, OK, [(kind, status, at)]).overall_status == expected


def test_warnings_do_not_lift_other_outcomes(spark):
    assert outcome(spark, [(0, "a", "FAILED", "m")], [("direct", "WARN", NOON)]).overall_status == "FAILED"
    assert outcome(spark, [], [("direct", "WARN", NOON)]).overall_status == "UNKNOWN"
    assert outcome(spark, OK, [("direct", "WARN", NOON)], started=None).overall_status == "SUCCESS"


def job_log(spark, rows):
    """(id, recorded, status, started, completed, seconds)"""
    return spark.createDataFrame(
        [(i, rec, "c", "s", "dev", "g", st, None, None, start, done, sec, "u") for i, rec, st, start, done, sec in rows], JOB_LOG)


@pytest.mark.parametrize("status, completed, shown", [
    ("FAILED", NOON, "FAILED"), ("WARNING", NOON - 99 * HOUR, "WARNING"), ("SUCCESS", NOON, "HEALTHY"),
    ("SUCCESS", NOON - 48 * HOUR, "HEALTHY"), ("SUCCESS", NOON - 48 * HOUR - timedelta(seconds=1), "STALE"),
    ("SUCCESS", None, "HEALTHY"), ("UNKNOWN", NOON, "UNKNOWN"), (None, NOON, "UNKNOWN"), ("other", NOON, "UNKNOWN"),
])
def test_board_status(spark, status, completed, shown):
    log = job_log(spark, [("1", NOON, status, NOON, completed, 1), ("0", NOON - HOUR, "FAILED", NOON, NOON, 1)])
    row = S.current_status(log, NOON).first()
    assert (row.job_run_id, row.dashboard_status, row.view_refreshed_at) == ("1", shown, NOON)


def test_current_status_by_group_and_on_ties(spark):
    log = job_log(spark, [("1", NOON, "SUCCESS", NOON, NOON, 1), ("2", NOON, "FAILED", NOON, NOON, 1)])
    both = log.unionByName(log.selectExpr("*").drop("schema_name").selectExpr("*", "'other' AS schema_name"))
    assert values(S.current_status(log, NOON), "job_run_id") == ["2"]
    found = S.current_status(both, NOON, by=["schema_name"])
    assert sorted((r.schema_name, r.job_run_id) for r in found.collect()) == [("other", "2"), ("s", "2")]
    assert S.current_status(log.filter("false"), NOON).count() == 0
    assert "WindowGroupLimit" in found._jdf.queryExecution().executedPlan().toString()


def test_reliability_and_last_success(spark):
    log = job_log(spark, [
        ("1", NOON, "SUCCESS", datetime(2026, 5, 12), NOON - HOUR, 5), ("2", NOON, "FAILED", NOON, NOON, 7),
        ("3", NOON, "SUCCESS", datetime(2026, 5, 11, 23, 59, 59), NOON - 2 * HOUR, 9),
        ("4", NOON, "WARNING", NOON, NOON, 1)])
    assert values(S.reliability(log, NOON), "reliability") == ["1 / 3 runs succeeded"]
    assert values(S.reliability(log.filter("false"), NOON), "reliability") == ["0 / 0 runs succeeded"]
    assert values(S.last_success(log), "last_success_at") == [NOON - HOUR]
    assert S.last_success(log.filter("overall_status = 'FAILED'")).count() == 0
    assert {r.completed_at: r.duration_seconds for r in S.duration_series(log).collect()}[NOON] == 8
    assert values(S.row_total(log), "count") == [4]


def test_latest_run_modes(spark):
    log = spark.createDataFrame([
        ("9", "p", "old", "direct", "PASS", "m", NOON), ("10", "p", "new", "direct", "PASS", "m", NOON + HOUR),
        ("10", "p", "hint", "expectation", "PASS", "m", NOON + HOUR)], CHECKS)
    assert values(S.latest_run_checks(log), "check_name") == ["new"]
    assert values(S.latest_run_checks(log, "lexicographic"), "check_name") == ["old"]
    assert values(S.all_direct_checks(log), "check_name") == ["new", "old"]
    with pytest.raises(ValueError):
        S.latest_run_checks(log, "first")


# --- event log ---

EVENTS = ("pipeline_name string, timestamp timestamp, event_type string, "
          "origin struct<update_id:string, flow_name:string>, details string")


def started(pipeline, update, at):
    details = '{"create_update":{}}' if update is None else f'{{"create_update":{{"update_id":"{update}"}}}}'
    return (pipeline, at, "create_update", (update, None), details)


def progress(pipeline, update, flow, expectations):
    return (pipeline, NOON, "flow_progress", (update, flow),
            f'{{"flow_progress":{{"data_quality":{{"expectations":{expectations}}}}}}}')


def rows(spark, events, **options):
    found = E.expectation_checks(spark.createDataFrame(events, EVENTS), "r", NOON, **options)
    return sorted((r.pipeline_name, r.check_name, r.status, r.message) for r in found.collect())


@pytest.mark.parametrize("pipelines", [None, ["a"]])
def test_only_the_latest_update_counts(spark, pipelines):
    assert rows(spark, [
        started("a", "u1", NOON), started("a", "u2", NOON + HOUR),
        progress("a", "u1", "f", '[{"name":"r","passed_records":100,"failed_records":1}]'),
        progress("a", "u2", "f", '[{"name":"r","passed_records":3,"failed_records":0}]'),
        progress("a", "u2", "f", '[{"name":"r","passed_records":4,"failed_records":0},{"name":"s","passed_records":1,"failed_records":2}]'),
    ], pipelines=pipelines) == [
        ("a", "r", "PASS", "flow=f passed=7 failed=0"), ("a", "s", "WARN", "flow=f passed=1 failed=2")]


def test_odd_details(spark):
    assert rows(spark, [
        started("a", "u", NOON),
        progress("a", "u", "f", '[{"name":"gap","passed_records":3}]'),
        progress("a", "u", None, '[{"name":"noflow","passed_records":3,"failed_records":0}]'),
        progress("a", "u", "f", "[]"),
        ("a", NOON, "flow_progress", ("u", "f"), '{"flow_progress":{"data_quality":{"expectations":[{'),
        ("a", NOON, "flow_progress", ("u", "f"), '{"flow_progress":{}}'),
        ("a", NOON, "flow_progress", ("u", "f"), None),
    ]) == [("a", "gap", "WARN", "flow=f passed=3 failed=None"), ("a", "noflow", "PASS", "flow=None passed=3 failed=0")]


def test_pipelines_without_update_warn(spark):
    silent = ("event_log_enrichment", "WARN", E.NO_UPDATE_MESSAGE)
    events = [progress("a", "u", "f", '[{"name":"r","passed_records":1,"failed_records":0}]'),
              started("b", "u1", NOON), started("b", None, NOON + HOUR), started("c", "u", NOON)]
    assert rows(spark, events) == [("a", *silent), ("b", *silent)]
    assert rows(spark, events, pipelines=["a", "d"]) == [("a", *silent), ("d", *silent)]


def test_the_log_is_scanned_once_and_not_joined(spark, folder):
    spark.createDataFrame([started("a", "u", NOON)], EVENTS).write.parquet(f"{folder}/log")
    found = E.expectation_checks(spark.read.parquet(f"{folder}/log"), "r", NOON)
    plan = found._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[-1]
    assert plan.count("FileScan") == 1 and "Join" not in plan and found.count() == 0


def test_an_update_of_many_flows_and_events_of_other_kinds(spark):
    """Sums of all updates, of which the newest by start time counts, whatever the order of its events."""
    told = '{"flow_progress":{"data_quality":{"expectations":[{"name":"%s","passed_records":%d,"failed_records":%d}]}}}'
    rows = [started("a", "u1", NOON), started("a", "u2", NOON + HOUR), started("a", "u1", NOON - HOUR)]
    rows += [("a", NOON, E.PROGRESS, (u, f), told % (n, p, q)) for u, f, n, p, q in (
        ("u2", "f", "r", 1, 2), ("u2", "f", "r", 10, 20), ("u2", "g", "r", 5, 0), ("u1", "f", "r", 999, 999), ("u2", None, "r", 3, 0))]
    rows += [("b", NOON, E.PROGRESS, ("u9", "f"), told % ("r", 1, 1)), ("c", NOON, "other", (None, None), None),
             (None, NOON, E.STARTED, (None, None), '{"create_update":{"update_id":"x"}}')]
    events = spark.createDataFrame(rows, EVENTS)
    assert sorted(map(tuple, E.expectation_totals(events).collect()), key=str) == sorted([
        ("a", "f", "r", 11, 22), ("a", "g", "r", 5, 0), ("a", None, "r", 3, 0)], key=str)
    silent = [r.pipeline_name for r in E.expectation_checks(events, "r", NOON).collect() if r.check_name == E.NO_UPDATE_CHECK]
    assert sorted(map(str, silent)) == ["None", "b", "c"]
    named = E.expectation_checks(events, "r", NOON, ["a", "b", "z"]).collect()
    assert sorted((r.pipeline_name, r.status) for r in named) == [("a", "PASS"), ("a", "PASS"), ("a", "WARN"), ("b", "WARN"), ("z", "WARN")]


def by_day(spark, folder, rows, kind, time):
    df = spark.createDataFrame(rows, kind)
    df.withColumn("log_day", F.col(time).cast("date")).write.partitionBy("log_day").parquet(f"{folder}/log")
    return spark.read.parquet(f"{folder}/log")


def test_readers_of_the_newest_read_only_its_days(spark, folder):
    rows = [(f"r{d:02}", "p", f"c{k}", "direct", "PASS", "m", NOON + timedelta(days=d, minutes=k)) for d in range(30) for k in range(3)]
    rows.append(("r29", "p", "early", "direct", "PASS", "m", NOON + timedelta(days=28)))
    log = by_day(spark, folder, rows, CHECKS, "checked_at")
    found = S.latest_run_checks(log, day="log_day")
    assert sorted(r.check_name for r in found.collect()) == ["c0", "c1", "c2", "early"]
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(log_day" in plan
    scans = [m for m in files_read(found)]
    assert max(scans) == len(log.inputFiles()) and min(scans) <= 8  # all files' partition values, then those of two days
    assert sorted(map(str, found.collect())) == sorted(map(str, S.latest_run_checks(log).collect()))


def files_read(df):
    """Numbers of files that the scans of an executed query read."""
    def nodes(plan):
        yield plan
        name = plan.getClass().getSimpleName()
        inner = [plan.executedPlan()] if name == "AdaptiveSparkPlanExec" else [plan.plan()] if name.endswith("QueryStageExec") else []
        inner += [plan.children().apply(i) for i in range(plan.children().size())]
        inner += [plan.subqueries().apply(i) for i in range(plan.subqueries().size())]
        for one in inner:
            yield from nodes(one)

    execution = df._jdf.queryExecution()
    execution.executedPlan().executeCollect()
    return [n.metrics().apply("numFiles").value() for n in nodes(execution.executedPlan()) if "FileSourceScan" in n.getClass().getSimpleName()]


def test_one_task_takes_no_whole_history(spark):
    """Runs are put in order without a window over everything."""
    warn = spark.createDataFrame([("x", "p", "c", "direct", "WARN", "m", NOON)], CHECKS)
    tasks = spark.createDataFrame([("1", 0, "a", "SUCCESS", None)], TASKS)
    for slices in (None, ("second", "hour")):
        found = S.run_outcomes(runs(spark, ("1", NOON, NOON + HOUR)), tasks, warn, slices=slices)
        assert "SinglePartition" not in found._jdf.queryExecution().executedPlan().toString()
        assert found.first().overall_status == "WARNING"


def test_slices_do_not_change_outcomes(spark):
    import random
    rng = random.Random(5)
    at = lambda: NOON + timedelta(seconds=rng.randrange(0, 400_000))
    some = [(str(i), start, start + timedelta(seconds=rng.randrange(0, 9000))) for i in range(150) for start in [at()]]
    warns = [("x", "p", "c", rng.choice(["direct", "expectation"]), rng.choice(["WARN", "PASS"]), "m", at()) for _ in range(60)]
    tasks = spark.createDataFrame([(str(i), 0, "a", "SUCCESS", None) for i in range(150)], TASKS)
    log = spark.createDataFrame(warns, CHECKS)
    hot = [w[6] for w in warns if w[3:5] == ("direct", "WARN")]
    expected = {i: "WARNING" if any(a <= t <= b for t in hot) else "SUCCESS" for i, a, b in some}
    for slices in (None, ("second", "hour"), ("minute", "month")):
        found = S.run_outcomes(runs(spark, *some), tasks, log, slices=slices)
        assert {r.job_run_id: r.overall_status for r in found.collect()} == expected
