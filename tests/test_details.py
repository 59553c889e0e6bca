import datetime as dt

from pyspark.sql import functions as F

from conftest import rows
from runlens import schemas
from runlens.plans import details as DT

TASKS = ("task_run_id long, task_job_run_id long, task_start_time long, task_end_time long, "
         "task_setup_duration long, task_execution_duration long, task_cleanup_duration long")
RUNS = ("job_run_id long, job_id long, job_start_time long, job_end_time long, job_run_duration long, "
        "job_setup_duration long, job_execution_duration long, job_cleanup_duration long")
JOBS = "job_id long, job__name string, created_time long, is_job_deleted string, job__tags__Team string"


def frames(spark):
    tasks = spark.createDataFrame([
        (1, 10, 0, 5000, 1000, 2500, 499),        # start 0 -> NULL
        (2, 10, 1000, 2000, 1000, 2000, None),    # NULL cleanup -> NULL elapsed
        (3, 20, 1000, 2000, 1, 2, 3),             # run of a job not in the job table
        (4, 99, 1000, 2000, 1, 2, 3),             # task of an unknown run
    ], TASKS)
    runs = spark.createDataFrame([
        (10, 1, 86_400_000, 0, 0, 1000, 2000, 999),        # run_duration 0 -> parts
        (20, 2, 1000, 2000, 5000, 1, 1, 1),
        (30, 1, 1000, 2000, None, 100, 200, None),         # no tasks; NULL duration + NULL part
    ], RUNS)
    jobs = spark.createDataFrame([(1, "j1", 0, "yes", "data")], JOBS)   # deleted jobs stay
    return tasks, runs, jobs


def test_run_details_columns_and_values(spark):
    out = DT.run_details(*frames(spark))
    assert len(out.columns) == 72
    assert out.columns[:5] == ["task_run_id", "job_run_id", "job_id", "job__name", "job_run_page_url"]
    assert out.columns[-6:] == [f"job__tags__{k}" for k in DT.VIEW_TAG_KEYS]
    r = {x["task_run_id"]: x for x in out.collect()}
    assert set(r) == {1, 2}
    assert r[1]["task_start_time"] is None
    assert r[1]["created_time"] is None and r[1]["job_end_time"] is None
    assert r[1]["job_start_time"] == dt.datetime(1970, 1, 2)
    assert r[1]["task_elapsed_time_sec"] == 3 and r[1]["task_cleanup_duration_sec"] == 0
    assert r[1]["job_elapsed_time_sec"] == 3          # (1000 + 2000 + 999) // 1000
    assert r[2]["task_elapsed_time_sec"] is None
    assert r[2]["job__tags__Team"] == "data"


def test_run_details_ntz_is_zone_free(spark):
    out = DT.run_details(*frames(spark), ntz=True)
    assert dict(out.dtypes)["job_start_time"] == "timestamp_ntz"
    assert rows(out, "task_run_id", "job_start_time")[0] == (1, dt.datetime(1970, 1, 2))


def test_scalar_view(spark):
    out = DT.scalar_view(DT.run_details(*frames(spark)))
    assert all(t in ("string", "bigint", "timestamp", "timestamp_ntz") for _, t in out.dtypes)


def test_catalog_view_over_bucketed_tables(spark):
    """The view is seen by another session, has 72 columns and the rows of
    ``run_details``; its fact tables are joined without a shuffle."""
    import uuid

    from runlens.operators import incremental as I
    from runlens.plans import load as LD
    from runlens.sources import tables as TB

    db = f"v{uuid.uuid4().hex[:10]}"
    tasks = spark.range(40).selectExpr("id as task_run_id", "id % 12 as task_job_run_id", "id * 1500 as task_execution_duration",
                                       "0L as task_setup_duration", "0L as task_cleanup_duration", "0L as task_start_time")
    runs = spark.range(10).selectExpr("id as job_run_id", "id % 3 as job_id", "id * 86400000 as job_start_time", "0L as job_run_duration",
                                      "2500L as job_setup_duration", "1L as job_execution_duration", "id as job_cleanup_duration")
    jobs = spark.range(2).selectExpr("id as job_id", "concat('job', id) as job__name", "'data' as job__tags__Team")
    frames = {"task_run_details": I.conform_tasks(tasks), "job_run_details": I.conform_runs(runs),
              "job_details": I.conform(jobs, schemas.job_schema())}
    names = [TB.save_table(df, f"{db}.{n}", bucket_by=(4, LD.BUCKETS[n]) if n in LD.BUCKETS else None) for n, df in frames.items()]
    view = DT.create_catalog_view(spark, f"{db}.run_details", *names)
    DT.create_catalog_view(spark, view, *names)                       # again: replaced
    other = spark.newSession()
    other.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    seen = other.table(view)
    assert len(seen.columns) == 72
    want = DT.run_details(tasks, runs, jobs)
    assert seen.columns == want.columns
    assert rows(DT.scalar_view(seen)) == rows(DT.scalar_view(want)) and seen.count() > 0
    plan = other.sql(f"explain {DT.view_sql(*names)}").first()[0]
    shuffles = [line for line in plan.splitlines() if "Exchange" in line]
    assert shuffles and all("job_id" in line and "run_id" not in line for line in shuffles), plan


def test_latest_status_ties_and_missing_starts(spark):
    from runlens.plans import reports as R

    runs = spark.createDataFrame(
        [(1, 1, 5, "TERMINATED", "SUCCESS"), (2, 1, 5, "RUNNING", None), (3, 1, 4, "PENDING", None),
         (4, 2, None, "PENDING", None), (5, 2, None, "RUNNING", None), (6, None, 1, "RUNNING", None)],
        "job_run_id long, job_id long, job_start_time long, job_state__life_cycle_state string, job_state__result_state string")
    out = R.latest_status(runs)
    assert rows(out, "job_id", "job_run_id", "life_cycle_state") == [(1, 2, "RUNNING"), (2, 5, "RUNNING"), (None, 6, "RUNNING")]
    assert "SortAggregate" not in out._jdf.queryExecution().toString()


def _shuffled_by(df):
    plan = df._jdf.queryExecution().executedPlan().toString()
    return [line for line in plan.splitlines() if "Exchange hashpartitioning(" in line]


def test_many_jobs_meet_runs_before_tasks(spark):
    """Runs and tasks that come twice, ids that are null: the same rows; joined
    task runs are not shuffled on the job id."""
    tasks, runs, jobs = frames(spark)
    tasks = tasks.unionByName(tasks).unionByName(tasks.selectExpr("100 + task_run_id as task_run_id", "cast(null as long) as task_job_run_id",
                                                                  *tasks.columns[2:]))
    runs = (runs.unionByName(runs).unionByName(runs.withColumn("job_id", F.lit(2).cast("long")))
            .unionByName(runs.withColumn("job_id", F.lit(None).cast("long"))).unionByName(runs.withColumn("job_run_id", F.lit(None).cast("long"))))
    jobs = jobs.unionByName(jobs.withColumn("job_id", F.lit(2).cast("long"))).unionByName(jobs.withColumn("job__name", F.lit("again")))
    jobs = jobs.unionByName(jobs.withColumn("job_id", F.lit(None).cast("long")))
    want, got = DT.run_details(tasks, runs, jobs, ntz=True), DT.run_details(tasks, runs, jobs, ntz=True, many_jobs=True)
    assert got.columns == want.columns
    assert rows(DT.scalar_view(got)) == rows(DT.scalar_view(want)) and got.count() > 12
    kept = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        wide = [x for x in _shuffled_by(DT.run_details(tasks, runs, jobs, many_jobs=True)) if "hashpartitioning(job_id" in x]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", kept)
    assert not wide


def test_view_over_many_jobs_broadcasts_none(spark, monkeypatch):
    """A job table's files may be far smaller than its rows."""
    import uuid

    from runlens.operators import incremental as I
    from runlens.sources import tables as TB

    monkeypatch.setattr(DT, "FEW_JOBS", 1, raising=False)
    db = f"v{uuid.uuid4().hex[:10]}"
    tasks, runs, jobs = frames(spark)
    jobs = jobs.unionByName(jobs.withColumn("job_id", F.lit(2).cast("long")))
    full = {"task_run_details": I.conform_tasks(tasks), "job_run_details": I.conform_runs(runs),
            "job_details": I.conform(jobs, schemas.job_schema())}
    names = [TB.save_table(df, f"{db}.{n}") for n, df in full.items()]
    seen = spark.table(DT.create_catalog_view(spark, f"{db}.run_details", *names))
    plan = seen._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin [job_id" in plan, plan
    assert rows(DT.scalar_view(seen)) == rows(DT.scalar_view(DT.run_details(tasks, runs, jobs)))
