import datetime as dt

from conftest import rows
from runlens.plans import reports as R

DAY = 86_400_000
RUNS = ("job_run_id long, job_id long, job_start_time long, job_run_duration long, "
        "job_setup_duration long, job_execution_duration long, job_cleanup_duration long, "
        "job_state__life_cycle_state string, job_state__result_state string")
JOBS = ("job_id long, is_job_deleted string, job__tags__Team string, job__tags__Type string, "
        "job__tags__Owner string, job__tags__Domain string, job__tags__Priority string, job__tags__Project string, "
        "run_as_user_name string, job__git_source__git_url string, job__schedule__quartz_cron_expression string, "
        "job__email_notifications__on_failure array<string>")


def jobs(spark):
    return spark.createDataFrame([
        (1, "no", "data", "prod", "o1", "fin", "P1", "x", "sp-1", "g", "c", ["a@x"]),
        (2, "no", "data", "prod", "o2", "fin", "P1", "x", "u@x.com", None, "c", []),
        (3, None, "web", None, "o3", "gtm", "P2", None, "sp-2", "g", None, None),
        (4, "yes", "web", "dev", "o4", "gtm", "P2", "y", "sp-3", "g", "c", ["b@x"]),
    ], JOBS)


def runs(spark):
    f = "FAILED"
    return spark.createDataFrame([
        (1, 1, 1 * DAY, 100, None, None, None, "TERMINATED", f),
        (2, 1, 2 * DAY, 100, None, None, None, "TERMINATED", f),
        (3, 2, 2 * DAY, 100, None, None, None, "TERMINATED", f),
        (4, 3, 2 * DAY, 300, None, None, None, "TERMINATED", "SUCCESS"),
        (5, 3, 3 * DAY, 0, 100, 200, 300, "TERMINATED", f),         # duration from parts: 600
        (6, 3, 4 * DAY, 2000, None, None, None, "RUNNING", None),
        (7, 4, 4 * DAY, 10, None, None, None, "RUNNING", None),     # no finished runs
        (8, 1, 40 * DAY, 100, None, None, None, "TERMINATED", f),   # outside the report window
    ], RUNS)


def test_inventory(spark):
    out = R.inventory(jobs(spark))
    assert rows(out) == [("data", "fin", "P1", "x", 2, 2), ("web", "gtm", "P2", None, 1, 1)]


def test_top_failed_jobs(spark):
    out = R.top_failed_jobs(runs(spark), jobs(spark), 0, 10 * DAY, k=1)
    got = rows(out, "dimension", "value", "job_id", "failures", "rnk")
    assert ("Team", "data", 1, 2, 1) in got and ("Team", "data", 2, 1, 2) not in got
    assert ("Team", "web", 3, 1, 1) in got
    assert all(r[1] is not None for r in got)
    tied = R.top_failed_jobs(runs(spark), jobs(spark), 2 * DAY, 3 * DAY, k=1)
    assert rows(tied.where("dimension = 'Team' and value = 'data'"), "job_id", "rnk") == [(1, 1), (2, 1)]


def test_failure_trend(spark):
    out = R.failure_trend(runs(spark), ntz=True)
    got = {r["day"]: (r["runs"], r["failures"], r["failure_rate"]) for r in out.collect()}
    assert got[dt.date(1970, 1, 3)] == (3, 2, 2 / 3)


def test_recurring_errors(spark):
    details = spark.createDataFrame([
        ("boom", 1, dt.datetime(2024, 1, 1)), ("boom", 2, dt.datetime(2024, 1, 3)),
        ("boom", 1, dt.datetime(2024, 1, 2)), ("rare", 1, dt.datetime(2024, 1, 1)), (None, 1, None)],
        "task_error string, job_id long, task_start_time timestamp_ntz")
    out = R.recurring_errors(details, min_count=2)
    assert rows(out) == [("boom", 3, 2, dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 3))]


def test_long_running(spark):
    out = R.long_running(runs(spark), now=5 * DAY, days=30)
    got = {r["job_run_id"]: r for r in out.collect()}
    assert set(got) == {6, 7}
    # job 3 average of finished runs (300, 600) = 450; elapsed now - start = 1 day
    assert got[6]["avg_duration_ms"] == 450 and got[6]["is_long"] is True
    assert got[7]["avg_duration_ms"] is None and got[7]["is_long"] is False
    d = {r["job_run_id"]: r["is_long"] for r in
         R.long_running(runs(spark), now=5 * DAY, elapsed="duration").collect()}
    assert d == {6: True, 7: False}


def test_latest_status(spark):
    out = R.latest_status(runs(spark))
    assert rows(out, "job_id", "job_run_id", "life_cycle_state") == [
        (1, 8, "TERMINATED"), (2, 3, "TERMINATED"), (3, 6, "RUNNING"), (4, 7, "RUNNING")]


def test_standards(spark):
    out = R.standards_flags(jobs(spark))
    assert rows(out) == [(1, True, True, True, True), (2, False, False, False, False),
                         (3, False, True, False, False), (4, True, True, True, True)]
    s = R.standards_summary(jobs(spark)).collect()[0]
    assert (s["jobs"], s["meets_standards"], s["has_failure_alert"]) == (4, 2, 2)


def test_sanity_counts(spark):
    tasks = spark.createDataFrame([(1, 1), (2, 99)], "task_run_id long, task_job_run_id long")
    out = R.sanity_counts(spark, jobs(spark), runs(spark), tasks).collect()[0]
    assert (out["jobs"], out["runs"], out["tasks"]) == (4, 8, 2)
    assert out["jobs_missing_team_or_type"] == 1
    assert out["tasks_without_run"] == 1 and out["runs_without_tasks"] == 7
