"""The run-detail table: task runs joined to their run and job, with times
as timestamps and durations in whole seconds."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from runlens import schemas
from runlens.functions import millis_to_ts, ms_to_sec, total, zero_to_null
from runlens.operators.incremental import conform
from runlens.plans.load import FEW_JOBS

# The passthrough columns of the run-detail view, in order.
PASSTHROUGH = (
    "task_attempt_number", "task_cluster_instance", "task_git_source", "task_job_run_id",
    "task_notebook_task", "task_run_if", "task_key", "task_existing_cluster_id",
    "task_depends_on", "task_libraries", "task_description",
    "task_state__life_cycle_state", "task_state__user_cancelled_or_timedout",
    "task_state__result_state", "task_state__state_message",
    "task_notebook_output", "task_error", "task_error_trace", "task_sql_task",
    "task_original_attempt_run_id",
    "job_creator_user_name", "job_job_clusters", "job_number_in_job", "job_original_attempt_run_id",
    "job_run_name", "job_run_type", "job_schedule", "job_tasks", "job_trigger",
    "job_overriding_parameters", "job_state__life_cycle_state", "job_state__user_cancelled_or_timedout",
    "job_state__result_state", "job_state__state_message", "job_job_parameters",
    "creator_user_name", "run_as_user_name",
    "job__email_notifications__on_failure", "job__email_notifications__on_success",
    "job__schedule__pause_status", "job__schedule__quartz_cron_expression", "job__schedule__timezone_id",
    "job__timeout_seconds", "job__git_source__git_branch", "job__git_source__git_provider",
    "job__git_source__git_url", "Job_link",
)
# The tag columns of the view, in order.
VIEW_TAG_KEYS = ("Team", "Type", "Owner", "Project", "Domain", "Priority")

TIME_COLUMNS = ("task_start_time", "task_end_time", "job_start_time", "job_end_time", "created_time")
SECOND_COLUMNS = (
    "task_cleanup_duration", "task_execution_duration", "task_setup_duration",
    "job_cleanup_duration", "job_execution_duration", "job_run_duration", "job_setup_duration",
)


def job_elapsed_ms():
    """Run duration; when it is NULL or 0, setup + execution + cleanup."""
    run = F.col("job_run_duration")
    parts = total(["job_setup_duration", "job_execution_duration", "job_cleanup_duration"])
    return F.when(F.coalesce(run, F.lit(0)) == 0, parts).otherwise(run)


def task_elapsed_ms():
    return total(["task_setup_duration", "task_execution_duration", "task_cleanup_duration"])


def detail_columns(tag_keys: Sequence[str] = VIEW_TAG_KEYS, ntz: bool = False) -> list:
    cols = [F.col("task_run_id"), F.col("job_run_id"), F.col("job_id"), F.col("job__name"),
            F.col("job_run_page_url")]
    cols += [millis_to_ts(zero_to_null(c), ntz).alias(c) for c in TIME_COLUMNS]
    cols += [ms_to_sec(job_elapsed_ms()).alias("job_elapsed_time_sec"),
             ms_to_sec(task_elapsed_ms()).alias("task_elapsed_time_sec")]
    cols += [ms_to_sec(c).alias(f"{c}_sec") for c in SECOND_COLUMNS]
    cols += [F.col(c) for c in PASSTHROUGH]
    cols += [F.col(schemas.tag_column(k)) for k in tag_keys]
    return cols


def has_many(jobs: DataFrame) -> bool:
    """Whether there are too many jobs for their rows to go to every task."""
    return jobs.count() > FEW_JOBS


def run_details(tasks: DataFrame, runs: DataFrame, jobs: DataFrame,
                tag_keys: Sequence[str] = VIEW_TAG_KEYS, ntz: bool = False, many_jobs: bool = False) -> DataFrame:
    """Task runs ⋈ runs (``task_job_run_id = job_run_id``) ⋈ jobs (``job_id``),
    both inner: runs without tasks and runs of unknown jobs drop out; jobs
    flagged deleted stay.

    Inputs may lack columns of the full table schemas; those come out NULL.
    Plan: the task-run join is the big one and shuffles both sides on the
    run id (AQE splits a run with very many tasks); the job side holds one
    row per job and is broadcast by AQE when its measured size allows. Only
    the view's columns are read from the scans.

    ``many_jobs``: too many for a broadcast. Task runs would then be shuffled
    once more, with all columns, on the job id. Instead only the runs' two ids
    are; the job columns come from there to the task runs on the run id, by
    which these lie already.
    """
    keys = list(tag_keys)
    t = conform(tasks, schemas.TASK_SCHEMA)
    r = conform(runs, schemas.RUN_SCHEMA)
    j = conform(jobs, schemas.job_schema(sorted(set(keys) | set(schemas.REQUIRED_TAG_KEYS))))
    joined = t.join(r, t["task_job_run_id"] == r["job_run_id"])
    if many_jobs:
        ids = r.select(F.col("job_run_id").alias("_run"), F.col("job_id").alias("_job")).distinct()
        of_run = ids.join(j.withColumnRenamed("job_id", "_id").hint("merge"), F.col("_job") == F.col("_id"))
        # an equality would be a second key, and task runs would be shuffled on both
        same_job = (F.col("job_id") >= F.col("_job")) & (F.col("job_id") <= F.col("_job"))
        joined = joined.join(of_run.hint("merge"), (F.col("job_run_id") == F.col("_run")) & same_job)
    else:
        joined = joined.join(j, "job_id")
    return joined.select(*detail_columns(keys, ntz))


def view_sql(tasks: str, runs: str, jobs: str, tag_keys: Sequence[str] = VIEW_TAG_KEYS, many_jobs: bool = False) -> str:
    """The select of ``run_details`` over three catalog tables with all their
    columns, as text. ``many_jobs``: a job table whose files are small enough for
    a broadcast, but not its rows, meets the runs by a merge join, which can spill."""
    def elapsed(cols: Sequence[str]) -> str:
        return " + ".join(cols)

    parts = elapsed(("job_setup_duration", "job_execution_duration", "job_cleanup_duration"))
    job_ms = f"if(coalesce(job_run_duration, 0) = 0, {parts}, job_run_duration)"
    task_ms = elapsed(("task_setup_duration", "task_execution_duration", "task_cleanup_duration"))
    cols = ["task_run_id", "job_run_id", "r.job_id", "job__name", "job_run_page_url"]
    cols += [f"timestamp_millis(nullif({c}, 0)) as {c}" for c in TIME_COLUMNS]
    cols += [f"floor(({job_ms}) / 1000) as job_elapsed_time_sec", f"floor(({task_ms}) / 1000) as task_elapsed_time_sec"]
    cols += [f"floor({c} / 1000) as {c}_sec" for c in SECOND_COLUMNS]
    cols += [*PASSTHROUGH, *[schemas.tag_column(k) for k in tag_keys]]
    hint = "/*+ merge(j) */ " if many_jobs else ""
    return (f"select {hint}{', '.join(cols)} from {tasks} t join {runs} r on t.task_job_run_id = r.job_run_id "
            f"join {jobs} j on j.job_id = r.job_id")


def create_catalog_view(spark, name: str, tasks: str, runs: str, jobs: str,
                        tag_keys: Sequence[str] = VIEW_TAG_KEYS) -> str:
    """Create or replace the run-detail view in the catalog: other sessions
    see it, and it reads the tables as they are when it is read. How it joins
    the jobs follows from their number when it is created."""
    if "." in name:
        spark.sql(f"create schema if not exists {name.rsplit('.', 1)[0]}")
    spark.sql(f"create or replace view {name} as {view_sql(tasks, runs, jobs, tag_keys, has_many(spark.table(jobs)))}")
    return name


def scalar_view(df: DataFrame) -> DataFrame:
    """Map and array columns as JSON text, for comparisons and exports."""
    simple = ("string", "bigint", "int", "double", "boolean", "timestamp", "timestamp_ntz", "date")
    return df.select(*[F.col(c) if t in simple or t.startswith("decimal") else F.to_json(F.col(c)).alias(c)
                       for c, t in df.dtypes])


def create_view(df: DataFrame, name: str = "run_details") -> None:
    """Register (or replace) the run-detail table as a temp view."""
    df.createOrReplaceTempView(name)
