"""Incremental run/task load: which jobs to read, from which start time,
which landed runs are new, failure output, and original-attempt backfill.

Every step is a lazy DataFrame; nothing is collected to the driver. Per-job
values (watermarks, start bounds) are joined, not inlined as literal lists,
so the plan does not grow with the number of jobs.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from runlens import schemas
from runlens.operators.outputs import FIELDS, best_outputs, flat_outputs
from runlens.schemas import BACKFILL_RESULTS, DELETED_NO, IN_FLIGHT_STATES, OUTPUT_RESULTS, TERMINAL_STATES


def monitored_jobs(jobs: DataFrame, runs: DataFrame | None = None,
                   in_flight: Sequence[str] = IN_FLIGHT_STATES) -> DataFrame:
    """Job ids to read: live jobs, plus jobs with a run still in flight (a
    job deleted while running still gets its run closed). Without a run
    table (first load) only live jobs."""
    ids = jobs.where(F.col("is_job_deleted") == DELETED_NO).select("job_id")
    if runs is not None:
        busy = runs.where(F.col("job_state__life_cycle_state").isin(list(in_flight))).select("job_id")
        ids = ids.union(busy)
    return ids.distinct()


def watermarks(runs: DataFrame, terminal: Sequence[str] = TERMINAL_STATES) -> DataFrame:
    """Per job: newest start among finished runs (0 when NULL). One grouped
    aggregate with partial aggregation before the shuffle, so a job owning
    most runs is cut down on the map side."""
    return (runs.where(F.col("job_state__life_cycle_state").isin(list(terminal)))
            .groupBy("job_id")
            .agg(F.coalesce(F.max("job_start_time"), F.lit(0).cast("long")).alias("watermark")))


def fetch_from(runs: DataFrame | None, monitored: DataFrame,
               terminal: Sequence[str] = TERMINAL_STATES,
               in_flight: Sequence[str] = IN_FLIGHT_STATES,
               include_in_flight: bool = True) -> DataFrame:
    """Per monitored job: the start time to read from.

    ``watermark`` is the newest start among finished runs (0 when none). A
    run still in flight that started before a later finished run lies below
    that watermark and would never be read again; with
    ``include_in_flight`` the bound is lowered to the oldest in-flight start.
    Output: job_id, watermark, fetch_from.
    """
    if runs is None:
        return monitored.select("job_id", F.lit(0).cast("long").alias("watermark"),
                                F.lit(0).cast("long").alias("fetch_from"))
    state = F.col("job_state__life_cycle_state")
    per_job = runs.groupBy("job_id").agg(
        F.max(F.when(state.isin(list(terminal)), F.col("job_start_time"))).alias("_wm"),
        F.min(F.when(state.isin(list(in_flight)), F.col("job_start_time"))).alias("_busy"),
    )
    out = monitored.join(per_job, "job_id", "left")
    wm = F.coalesce(F.col("_wm"), F.lit(0).cast("long"))
    start = F.least(wm, F.col("_busy")) if include_in_flight else wm
    return out.select("job_id", wm.alias("watermark"), start.alias("fetch_from"))


class LoadState(NamedTuple):
    """What the next batch needs from the run table, kept small: per job the
    newest start among finished runs (it only ever grows), and the runs
    still in flight. Reading it costs O(jobs + runs in flight) instead of a
    scan of the whole run table."""
    watermarks: DataFrame   # job_id, watermark
    in_flight: DataFrame    # job_id, job_run_id, job_start_time


def load_state(runs: DataFrame, terminal: Sequence[str] = TERMINAL_STATES,
               in_flight: Sequence[str] = IN_FLIGHT_STATES) -> LoadState:
    """The state of a run table (one scan, e.g. once at start-up)."""
    state = F.col("job_state__life_cycle_state")
    return LoadState(watermarks(runs, terminal),
                     runs.where(state.isin(list(in_flight))).select("job_id", "job_run_id", "job_start_time"))


def advance_state(prev: LoadState, new_runs: DataFrame, terminal: Sequence[str] = TERMINAL_STATES,
                  in_flight: Sequence[str] = IN_FLIGHT_STATES) -> LoadState:
    """The state after a batch: watermarks raised by the batch's finished
    runs; in-flight runs the batch saw replaced by their new state."""
    state = F.col("job_state__life_cycle_state")
    wm = (prev.watermarks.unionByName(watermarks(new_runs, terminal))
          .groupBy("job_id").agg(F.max("watermark").alias("watermark")))
    still = prev.in_flight.join(new_runs.select("job_run_id"), "job_run_id", "left_anti")
    busy = (still.select("job_id", "job_run_id", "job_start_time")
            .unionByName(new_runs.where(state.isin(list(in_flight)))
                         .select("job_id", "job_run_id", "job_start_time")))
    return LoadState(wm, busy)


def monitored_from_state(jobs: DataFrame, state: LoadState) -> DataFrame:
    """``monitored_jobs`` from the state instead of the run table."""
    live = jobs.where(F.col("is_job_deleted") == DELETED_NO).select("job_id")
    return live.union(state.in_flight.select("job_id")).distinct()


def fetch_from_state(state: LoadState, monitored: DataFrame, include_in_flight: bool = True) -> DataFrame:
    """``fetch_from`` from the state: the same bounds, no run-table scan."""
    busy = state.in_flight.groupBy("job_id").agg(F.min("job_start_time").alias("_busy"))
    out = monitored.join(state.watermarks, "job_id", "left").join(busy, "job_id", "left")
    wm = F.coalesce(F.col("watermark"), F.lit(0).cast("long"))
    start = F.least(wm, F.col("_busy")) if include_in_flight else wm
    return out.select("job_id", wm.alias("watermark"), start.alias("fetch_from"))


def recent(payloads: DataFrame, starts: DataFrame, start_col: str = "start_time") -> DataFrame:
    """Payloads with ``start >= min(fetch_from)`` (a scalar subquery, run once).
    The per-job bound is a join condition, which no scan can use; this one
    reaches the parquet scan as a pushed filter and skips files older than
    every bound."""
    return payloads.where(F.col(start_col) >= starts.select(F.min("fetch_from")).scalar())


def select_new(payloads: DataFrame, starts: DataFrame, start_col: str = "start_time",
               key: str = "job_id", many: bool = False) -> DataFrame:
    """Landed run payloads of monitored jobs with start >= that job's
    ``fetch_from`` (inclusive: the upsert by run id makes a re-read
    harmless), looked for among the ``recent`` ones.

    ``many``: too many bounds for a broadcast. Payloads then meet them in a
    shuffled hash join (a partition's bounds are one row per job), so whole
    documents are never sorted, which would spill them.
    """
    bounds = starts.select(key, "fetch_from")
    joined = recent(payloads, starts, start_col).join(bounds.hint("shuffle_hash") if many else bounds, key)
    return joined.where(F.col(start_col) >= F.col("fetch_from")).select(*payloads.columns)


def enrich_failures(tasks: DataFrame, outputs: DataFrame,
                    results: Sequence[str] = OUTPUT_RESULTS) -> DataFrame:
    """Attach failure output to failed tasks.

    For a task whose result is in ``results`` the output's notebook output,
    error, trace and original attempt id replace the task's own, where the
    output has them (a failed fetch has its error text in all three); every
    other task keeps its own values (an output that is missing never blanks
    them). Outputs come flat or as documents; a task's several outputs are cut
    to one (``outputs.best_outputs``), so tasks cannot multiply. Only failed
    tasks are joined, by their unique run id; all others pass by.
    """
    found = best_outputs(flat_outputs(outputs)).select(F.col("task_run_id").alias("_rid"), F.col("output").alias("_o"))
    failed = F.coalesce(F.col("task_state__result_state").isin(list(results)), F.lit(False))
    hit = tasks.where(failed).join(found, F.col("task_run_id") == F.col("_rid"), "left")
    fields = {f"task_{f}": f for f in FIELDS}
    hit = hit.select(*[F.coalesce(F.col(f"_o.{fields[c]}"), F.col(c)).alias(c) if c in fields else F.col(c)
                       for c in tasks.columns])
    return hit.unionByName(tasks.where(~failed))


def backfill_candidates(tasks: DataFrame, batch: DataFrame,
                        results: Sequence[str] = BACKFILL_RESULTS) -> DataFrame:
    """Task run ids that need an original attempt id.

    From the oldest non-zero task start of ``batch`` on, runs with a task
    whose result is in ``results``; then every task of those runs whose
    original attempt id is NULL. A batch with no non-zero start gives no
    rows. The oldest start is a scalar subquery (no collect); the run set
    is a semi join.
    """
    oldest = batch.where(F.col("task_start_time") != 0).select(F.min("task_start_time")).scalar()
    runs_hit = (tasks.where((F.col("task_start_time") >= oldest)
                            & F.col("task_state__result_state").isin(list(results)))
                .select("task_job_run_id").distinct())
    return (tasks.where(F.col("task_original_attempt_run_id").isNull())
            .join(runs_hit, "task_job_run_id", "left_semi")
            .select("task_run_id"))


def attempt_fills(tasks: DataFrame, batch: DataFrame, outputs: DataFrame,
                  results: Sequence[str] = BACKFILL_RESULTS) -> DataFrame:
    """(task_run_id, ``_a``): original attempt ids from the output documents
    for the backfill candidates that have one. Small: failed runs only."""
    cand = backfill_candidates(tasks, batch, results)
    return (flat_outputs(outputs).select("task_run_id", F.col("output.original_attempt_run_id").alias("_a"))
            .where(F.col("_a").isNotNull())
            .join(cand, "task_run_id", "left_semi")
            .groupBy("task_run_id").agg(F.max("_a").alias("_a")))


def fill_attempt_ids(tasks: DataFrame, batch: DataFrame, outputs: DataFrame,
                     results: Sequence[str] = BACKFILL_RESULTS) -> DataFrame:
    """Set ``task_original_attempt_run_id`` of the backfill candidates from
    the output documents, only where it is NULL."""
    from runlens.operators.upsert import fill_missing

    fills = attempt_fills(tasks, batch, outputs, results)
    return fill_missing(tasks, fills, "task_run_id", "task_original_attempt_run_id", source_column="_a")


def snapshot_order(kind: str, terminal: Sequence[str] = TERMINAL_STATES) -> list:
    """Newest first among snapshots of one run (``kind`` "job") or task
    ("task"), by their own fields: finished ones, then the latest end, then
    the longest durations. It does not depend on when a snapshot arrived."""
    timed = (["job_end_time", "job_run_duration"] if kind == "job" else ["task_end_time"])
    timed += [f"{kind}_execution_duration", f"{kind}_setup_duration", f"{kind}_cleanup_duration", f"{kind}_start_time"]
    done = F.col(f"{kind}_state__life_cycle_state").isin(list(terminal))
    return [F.coalesce(done, F.lit(False)).desc(), *[F.col(c).desc_nulls_last() for c in timed],
            F.col(f"{kind}_state__life_cycle_state").desc_nulls_last(),
            F.col(f"{kind}_state__result_state").desc_nulls_last()]


def conform(df: DataFrame, schema, beside: Sequence[str] = ()) -> DataFrame:
    """Columns of ``schema`` in its order, cast to its types; a column the
    input lacks is a typed NULL. Columns named in ``beside`` follow as they are."""
    have = set(df.columns)
    return df.select(*[(F.col(f.name) if f.name in have else F.lit(None)).cast(f.dataType).alias(f.name)
                       for f in schema.fields], *beside)


def known(df: DataFrame, schema, needed: Sequence[str] = ()) -> DataFrame:
    """Of the columns of ``schema`` those that the input has and those ``needed``.
    A shuffle before ``conform`` then carries no columns that are all NULL."""
    have = {*df.columns, *needed}
    return conform(df, T.StructType([f for f in schema.fields if f.name in have]))


def conform_runs(df: DataFrame) -> DataFrame:
    return conform(df, schemas.RUN_SCHEMA)


def conform_tasks(df: DataFrame) -> DataFrame:
    return conform(df, schemas.TASK_SCHEMA)
