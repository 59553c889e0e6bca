"""Reports over the job, run and run-detail tables.

Each report is one lazy plan of grouped aggregates (partial aggregation
before every shuffle, so a hot job or a hot error message is cut down on
the map side), joins against per-job tables, and windows ranked with a
limit (``WindowGroupLimit`` before the shuffle). "Now" is an argument; by
default the newest run start in the data, as a scalar subquery.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from runlens import schemas
from runlens.functions import millis_to_ts, ms_of
from runlens.plans.details import job_elapsed_ms
from runlens.schemas import DELETED_YES, IN_FLIGHT_STATES, TERMINAL_STATES

DAY_MS = 86_400_000
DIMENSIONS = ("Team", "Domain", "Project", "Priority")


def _live(jobs: DataFrame) -> DataFrame:
    """Jobs not flagged deleted; a NULL flag counts as live."""
    return jobs.where(~F.coalesce(F.col("is_job_deleted") == DELETED_YES, F.lit(False)))


def inventory(jobs: DataFrame) -> DataFrame:
    """R1: live jobs per (team, domain, priority, project) with the number
    of distinct owners."""
    t = schemas.tag_column
    return (_live(jobs)
            .groupBy(F.col(t("Team")).alias("team"), F.col(t("Domain")).alias("domain"),
                     F.col(t("Priority")).alias("priority"), F.col(t("Project")).alias("project"))
            .agg(F.count("*").alias("n_jobs"), F.countDistinct(t("Owner")).alias("n_owners")))


def top_failed_jobs(runs: DataFrame, jobs: DataFrame, start, end, k: int = 10,
                    dims: Sequence[str] = DIMENSIONS, failed: Sequence[str] = ("FAILED",)) -> DataFrame:
    """R2: per dimension (Team, Domain, …) and value, the jobs with most
    failed runs started in [start, end), ranked (ties share a rank; ranks up
    to ``k`` are kept, the limit is the report's purpose).

    Failures are counted per job first (partial aggregation), so what is
    joined and ranked has one row per job. The job side is one row per job.
    """
    in_window = ((F.col("job_start_time") >= ms_of(start)) & (F.col("job_start_time") < ms_of(end))
                 & F.col("job_state__result_state").isin(list(failed)))
    counts = runs.where(in_window).groupBy("job_id").agg(F.count("*").alias("failures"))
    return _ranked(counts, jobs, k, dims)


def _ranked(counts: DataFrame, jobs: DataFrame, k: int, dims: Sequence[str]) -> DataFrame:
    """(job_id, failures) ranked within each dimension's values."""
    pairs = F.array(*[F.struct(F.lit(d).alias("dimension"), F.col(schemas.tag_column(d)).alias("value"))
                      for d in dims])
    per_dim = (counts.join(jobs.select("job_id", *[schemas.tag_column(d) for d in dims]), "job_id")
               .select("job_id", "failures", F.inline(pairs))
               .where(F.col("value").isNotNull()))
    w = Window.partitionBy("dimension", "value").orderBy(F.col("failures").desc())
    return per_dim.withColumn("rnk", F.rank().over(w)).where(F.col("rnk") <= k)


def failure_trend(runs: DataFrame, failed: Sequence[str] = ("FAILED",), ntz: bool = False) -> DataFrame:
    """R3: per start day, runs, failed runs and the failure rate."""
    day = F.to_date(millis_to_ts("job_start_time", ntz)).alias("day")
    is_failed = F.col("job_state__result_state").isin(list(failed))
    return (runs.groupBy(day)
            .agg(F.count("*").alias("runs"), F.count_if(is_failed).alias("failures"))
            .withColumn("failure_rate", F.col("failures") / F.col("runs")))


def recurring_errors(details: DataFrame, min_count: int = 2) -> DataFrame:
    """R4: per error message of failed tasks: occurrences, distinct jobs,
    first and last task start; messages seen fewer than ``min_count`` times
    are left out. ``details`` is the run-detail table (task_error, job_id,
    task_start_time). One message may hold most rows: counts are partial
    aggregates, and the distinct-job count is a two-level aggregate on
    (message, job) first."""
    errs = details.where(F.col("task_error").isNotNull())
    return (errs.groupBy(F.col("task_error").alias("error"))
            .agg(F.count("*").alias("occurrences"),
                 F.countDistinct("job_id").alias("n_jobs"),
                 F.min("task_start_time").alias("first_seen"),
                 F.max("task_start_time").alias("last_seen"))
            .where(F.col("occurrences") >= min_count))


def _now(runs: DataFrame, now) -> Column:
    if now is None:
        return runs.select(F.max("job_start_time")).scalar()
    return ms_of(now)


def long_running(runs: DataFrame, now=None, days: int = 30, factor: float = 2.0,
                 elapsed: str = "now", in_flight: Sequence[str] = IN_FLIGHT_STATES,
                 finished: Sequence[str] = TERMINAL_STATES, ntz: bool = False) -> DataFrame:
    """R5: runs in flight with their elapsed time and the job's average
    duration of finished runs started in the ``days`` before ``now``;
    ``is_long`` when elapsed > ``factor`` × that average.

    ``elapsed='now'`` measures now − start; ``elapsed='duration'`` takes the
    duration the scheduler reports for the running run. The averages are
    one row per job (partial aggregation), joined to the running runs.
    """
    now_ms = _now(runs, now)
    state = F.col("job_state__life_cycle_state")
    recent = (F.col("job_start_time") >= now_ms - F.lit(days * DAY_MS)) & (F.col("job_start_time") < now_ms)
    avg = (runs.where(state.isin(list(finished)) & recent)
           .groupBy("job_id").agg(F.avg(job_elapsed_ms()).alias("avg_duration_ms")))
    el = (now_ms - F.col("job_start_time")) if elapsed == "now" else F.col("job_run_duration")
    running = runs.where(state.isin(list(in_flight))).select(
        "job_run_id", "job_id", millis_to_ts("job_start_time", ntz).alias("start_time"),
        el.cast("long").alias("elapsed_ms"))
    out = running.join(avg, "job_id", "left")
    is_long = F.coalesce(F.col("elapsed_ms") > F.lit(factor) * F.col("avg_duration_ms"), F.lit(False))
    return out.withColumn("is_long", is_long)


# ---------------------------------------------------- from daily counts
#
# ``run_counts`` (a row a job and day) and ``error_counts`` (a row a message,
# job and day) are kept by the load for the days it rewrites (``plans.daily``).
# The reports below read them instead of runs and tasks.

def run_counts(runs: DataFrame, failed: Sequence[str] = ("FAILED",), finished: Sequence[str] = TERMINAL_STATES) -> DataFrame:
    """Per job and start day: runs, failures, finished runs with a duration
    and the sum of these, and the newest start."""
    took = F.when(F.col("job_state__life_cycle_state").isin(list(finished)), job_elapsed_ms())
    return (runs.groupBy("job_id", F.to_date(millis_to_ts("job_start_time", True)).alias("day"))
            .agg(F.count("*").alias("runs"), F.count_if(F.col("job_state__result_state").isin(list(failed))).alias("failures"),
                 F.count(took).alias("timed"), F.sum(took).alias("took_ms"), F.max("job_start_time").alias("newest")))


def error_counts(tasks: DataFrame, runs: DataFrame) -> DataFrame:
    """Per message, job and day of the run's start: occurrences, first and
    last task start (a start of 0 is none)."""
    errs = tasks.where(F.col("task_error").isNotNull()).select("task_error", "task_start_time", "task_job_run_id")
    at = F.nullif(F.col("task_start_time"), F.lit(0))
    return (errs.join(runs.select("job_run_id", "job_id", "job_start_time"), F.col("task_job_run_id") == F.col("job_run_id"))
            .groupBy("task_error", "job_id", F.to_date(millis_to_ts("job_start_time", True)).alias("day"))
            .agg(F.count("*").alias("occurrences"), F.min(at).alias("first_ms"), F.max(at).alias("last_ms")))


def top_failed_jobs_daily(counts: DataFrame, jobs: DataFrame, start, end, k: int = 10,
                          dims: Sequence[str] = DIMENSIONS) -> DataFrame:
    """``top_failed_jobs`` for whole days, [start, end)."""
    inside = (F.col("day") >= F.lit(str(start)).cast("date")) & (F.col("day") < F.lit(str(end)).cast("date"))
    per_job = counts.where(inside & (F.col("failures") > 0)).groupBy("job_id").agg(F.sum("failures").alias("failures"))
    return _ranked(per_job, jobs, k, dims)


def failure_trend_daily(counts: DataFrame) -> DataFrame:
    """``failure_trend`` from the counts."""
    return (counts.groupBy("day").agg(F.sum("runs").alias("runs"), F.sum("failures").alias("failures"))
            .withColumn("failure_rate", F.col("failures") / F.col("runs")))


def recurring_errors_daily(errors: DataFrame, jobs: DataFrame, min_count: int = 2, ntz: bool = False) -> DataFrame:
    """``recurring_errors`` of the runs of known jobs, from the counts. A job
    counts once for a message, however many days it has it."""
    known = errors.join(jobs.select("job_id").distinct(), "job_id", "left_semi")
    per_job = known.groupBy("task_error", "job_id").agg(F.sum("occurrences").alias("n"), F.min("first_ms").alias("first_ms"),
                                                        F.max("last_ms").alias("last_ms"))
    return (per_job.groupBy(F.col("task_error").alias("error"))
            .agg(F.sum("n").alias("occurrences"), F.count("*").alias("n_jobs"),
                 millis_to_ts(F.min("first_ms"), ntz).alias("first_seen"), millis_to_ts(F.max("last_ms"), ntz).alias("last_seen"))
            .where(F.col("occurrences") >= min_count))


def long_running_daily(in_flight: DataFrame, counts: DataFrame, edge_runs: DataFrame, now_ms: int, days: int = 30,
                       factor: float = 2.0, ntz: bool = False) -> DataFrame:
    """``long_running`` at ``now_ms`` from the runs in flight and the counts:
    whole days of the window come from the counts, its first and last day from
    ``edge_runs`` (the runs of those two days)."""
    since = now_ms - days * DAY_MS
    first, last = -(-since // DAY_MS), now_ms // DAY_MS          # whole days: first .. last - 1
    number = F.datediff("day", F.lit("1970-01-01").cast("date"))
    whole = counts.where((number >= first) & (number < last)).select("job_id", "timed", "took_ms")
    start, at = F.col("job_start_time"), F.floor(F.col("job_start_time") / DAY_MS)
    edge = run_counts(edge_runs.where((start >= since) & (start < now_ms) & ((at < first) | (at >= last)))).select("job_id", "timed", "took_ms")
    avg = (whole.unionByName(edge).groupBy("job_id").agg(F.sum("timed").alias("n"), F.sum("took_ms").alias("ms"))
           .select("job_id", (F.col("ms") / F.col("n")).alias("avg_duration_ms")))
    running = in_flight.select("job_run_id", "job_id", millis_to_ts("job_start_time", ntz).alias("start_time"),
                               (F.lit(now_ms) - F.col("job_start_time")).cast("long").alias("elapsed_ms"))
    out = running.join(avg, "job_id", "left")
    is_long = F.coalesce(F.col("elapsed_ms") > F.lit(factor) * F.col("avg_duration_ms"), F.lit(False))
    return out.withColumn("is_long", is_long)


def latest_status(runs: DataFrame, ntz: bool = False) -> DataFrame:
    """R6: per job, the run with the greatest (start, run id) and its state.

    Three hash aggregates of fixed-width values, each with partial
    aggregation, and no sort: a job's newest start, the greatest id among runs
    with it, then that run by its key. The side joined to the runs has one row a
    job, which AQE broadcasts where its measured size allows."""
    newest = runs.groupBy("job_id").agg(F.max("job_start_time").alias("_start")).withColumnRenamed("job_id", "_job")
    tied = runs.join(newest, F.col("job_id").eqNullSafe(F.col("_job")) & F.col("job_start_time").eqNullSafe(F.col("_start")))
    last = tied.groupBy("_job").agg(F.max("job_run_id").alias("_run"))
    out = runs.join(last, F.col("job_id").eqNullSafe(F.col("_job")) & (F.col("job_run_id") == F.col("_run")))
    return out.select("job_id", "job_run_id", millis_to_ts("job_start_time", ntz).alias("start_time"),
                      F.col("job_state__life_cycle_state").alias("life_cycle_state"),
                      F.col("job_state__result_state").alias("result_state"))


def standards_flags(jobs: DataFrame) -> DataFrame:
    """R7: per job, whether it is scheduled from git (a git url and a cron
    schedule), runs as a service principal (run-as is not an e-mail
    address) and has a failure alert (a non-empty on-failure list)."""
    git = (F.col("job__git_source__git_url").isNotNull()
           & F.col("job__schedule__quartz_cron_expression").isNotNull())
    sp = F.coalesce(~F.col("run_as_user_name").contains("@"), F.lit(False))
    emails = F.col("job__email_notifications__on_failure")
    alert = F.when(emails.isNull(), F.lit(False)).otherwise(F.size(emails) > 0)
    return jobs.select("job_id", git.alias("scheduled_via_git"), sp.alias("runs_as_service_principal"),
                       alert.alias("has_failure_alert"), (git & sp & alert).alias("meets_standards"))


def standards_summary(jobs: DataFrame) -> DataFrame:
    """R7 totals: jobs meeting each standard (one row)."""
    f = standards_flags(jobs)
    return f.agg(F.count("*").alias("jobs"),
                 *[F.count_if(c).alias(c) for c in
                   ("scheduled_via_git", "runs_as_service_principal", "has_failure_alert", "meets_standards")])


def sanity_counts(spark: SparkSession, jobs: DataFrame, runs: DataFrame, tasks: DataFrame) -> DataFrame:
    """R8: one row of table checks: row counts, jobs lacking Team or Type,
    tasks whose run is unknown and runs without a task. Each figure is a
    scalar subquery of its own aggregate, so no table is joined to another
    except for the two orphan checks (anti joins on the run id)."""
    t = schemas.tag_column
    lacking = jobs.where(F.col(t("Team")).isNull() | F.col(t("Type")).isNull())
    orphans = tasks.join(runs.select(F.col("job_run_id").alias("task_job_run_id")), "task_job_run_id", "left_anti")
    empty = runs.join(tasks.select(F.col("task_job_run_id").alias("job_run_id")), "job_run_id", "left_anti")

    def n(df: DataFrame) -> Column:
        return df.select(F.count("*")).scalar()

    return spark.range(1).select(
        n(jobs).alias("jobs"), n(runs).alias("runs"), n(tasks).alias("tasks"),
        n(lacking).alias("jobs_missing_team_or_type"),
        n(orphans).alias("tasks_without_run"), n(empty).alias("runs_without_tasks"))
