"""Whole loads: the job table from discovery + job payloads, and one
incremental batch of runs and tasks.

``load_batch`` is one lazy plan per output table. ``publish`` is where the
actions happen: both tables are checked (unique keys) and written as new
version folders below the shared checkpoint folder; only then are the new
paths returned. A failure before that leaves the previous versions as they
were, so there is nothing to roll back.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from runlens import schemas
from runlens.operators import discover as D
from runlens.operators import flatten as FL
from runlens.operators import incremental as I
from runlens.operators import upsert as U
from runlens.operators.common import ids_frame
from runlens.session import checkpoint_dir, scratch_path
from runlens.sources import payloads as PL
from runlens.sources import tables as TB


class JobLoad(NamedTuple):
    jobs: DataFrame        # the new job table
    bad: DataFrame         # job payloads that did not parse


class Batch:
    """One incremental batch's results.

    ``runs``: the new run table; ``changed_runs``: its rows that differ from
    the old table (the batch's runs); ``bad``: run payloads that did not
    parse. The task side is built on first use, once: ``new_tasks`` (this
    batch's tasks, enriched and staged), ``tasks`` (the new task table) and
    ``changed_tasks`` (the batch's tasks and old tasks given an attempt id),
    so a caller that needs only runs never pays for tasks.
    """

    def __init__(self, runs: DataFrame, changed_runs: DataFrame, bad: DataFrame,
                 tasks: DataFrame | None = None, new_tasks: DataFrame | None = None,
                 changed_tasks: DataFrame | None = None, task_side=None):
        self.runs, self.changed_runs, self.bad = runs, changed_runs, bad
        self.state = None           # the next batch's LoadState, when the batch was given one
        self._task_side = task_side
        self._tasks = None if task_side is not None else (tasks, new_tasks, changed_tasks)

    def _side(self):
        if self._tasks is None:
            self._tasks = self._task_side()
        return self._tasks

    @property
    def tasks(self) -> DataFrame:
        return self._side()[0]

    @property
    def new_tasks(self) -> DataFrame:
        return self._side()[1]

    @property
    def changed_tasks(self) -> DataFrame:
        return self._side()[2]


class StagingEmpty(RuntimeError):
    pass


#: Jobs of a batch whose start bounds go to every task; of more jobs they meet the payloads in a shuffle.
FEW_JOBS = 10_000
#: Rows of a staged table that may go to every task; more meet others by a merge join.
FEW_KEYS = 100_000


def _parsed(payloads: DataFrame, schema, column: str) -> tuple[DataFrame, DataFrame]:
    """(good, bad) payload rows: JSON text in ``column`` is parsed; already
    parsed documents are split on their corrupt-record column if any."""
    if column and column in payloads.columns:
        extra = [c for c in payloads.columns if c != column and c not in schema.fieldNames()]
        return PL.split_bad(PL.parse_json(payloads, column, schema, keep=extra))
    if PL.CORRUPT in payloads.columns:
        return PL.split_bad(payloads)
    return payloads, payloads.limit(0)


def load_jobs(versions: DataFrame, job_payloads: DataFrame, pairs, current: DataFrame | None = None,
              excluded: Sequence = (), tag_keys: Sequence[str] | None = None, host: str | None = None,
              workspace_id: str | None = None, tie_break: str | None = None,
              payload_column: str = "payload", check_staged: bool = True,
              staged_ids: bool = True, dedupe_order: Sequence | None = None) -> JobLoad:
    """Discover jobs, flatten their payloads, normalise tags, upsert into
    ``current`` and flag jobs no longer discovered as deleted.

    Only payloads of discovered jobs are staged (semi join). Excluded jobs
    are left as they are in ``current``. With ``check_staged`` an empty
    staging raises ``StagingEmpty`` before anything is built on it, so a
    mis-configured pair list cannot flag every job deleted. A landing with
    several payloads of a job needs ``dedupe_order`` (columns of the payloads,
    e.g. ``[F.col("landed_at").desc()]``): the first one counts. Without it a
    repeated job raises ``DuplicateKeyError``.
    """
    found = D.discover(versions, pairs, excluded, workspace_id=workspace_id, tie_break=tie_break)
    if staged_ids:
        # one row per discovered job, written once: the window over the whole
        # version history then runs once, not for the guard, the upsert and
        # the soft delete each
        found = stage(found.select("job_id").distinct(), "jobs")
    good, bad = _parsed(job_payloads, schemas.JOB_PAYLOAD, payload_column)
    good = good.join(found.select("job_id").distinct(), "job_id", "left_semi")
    if dedupe_order is not None:
        good = U.latest_per_key(good, ["job_id"], list(dedupe_order))
    staged = FL.normalise_tags(FL.flatten_jobs(good, tag_keys, host), keys=tag_keys)
    if dedupe_order is None:
        U.check_unique(staged, ["job_id"])
    if check_staged and staged.isEmpty():
        raise StagingEmpty("no job matched the configured Team/Type pairs")
    if current is None:
        return JobLoad(staged, bad)
    merged = U.upsert(current, staged, ["job_id"])
    keep = None
    if excluded:
        keep = ids_frame(merged.sparkSession, excluded)
    return JobLoad(U.mark_missing(merged, found, keep=keep), bad)


def stage(df: DataFrame, name: str = "stage", paths: list[str] | None = None) -> DataFrame:
    """Write ``df`` as parquet below the shared checkpoint folder and continue
    from the files: one job (a reliable RDD checkpoint would run the plan
    twice), later uses read the files instead of re-running the plan, a lost
    executor re-reads files rather than the lineage, and the planner sees
    the real size (runtime broadcast decisions). The folder is added to
    ``paths``, for a caller that removes it (``unstage``)."""
    import uuid

    spark = df.sparkSession
    path = scratch_path(spark, "runlens-stage", f"{name}-{uuid.uuid4().hex}")
    df.write.option("compression", "zstd").parquet(path)
    if paths is not None:
        paths.append(path)
    return spark.read.parquet(path)


def by_rows(staged: DataFrame) -> DataFrame:
    """A staged table that is joined by its number of rows: the planner sees the
    size of its compressed files, by which it would broadcast millions of
    keys from the driver."""
    return staged.hint("merge") if staged.count() > FEW_KEYS else staged


def unstage(spark, paths: Sequence[str]) -> None:
    """Remove staged folders that nothing reads any more. A remote session
    cannot: there they are left to the cluster's clean-up."""
    try:
        conf = spark._jsc.hadoopConfiguration()
    except (AttributeError, PySparkException):
        return
    for path in paths:
        target = spark._jvm.org.apache.hadoop.fs.Path(path)
        target.getFileSystem(conf).delete(target, True)


def load_batch(jobs: DataFrame, runs: DataFrame | None, tasks: DataFrame | None,
               run_payloads: DataFrame, outputs: DataFrame, payload_column: str = "payload",
               include_in_flight: bool = True, staged: bool = True,
               dedupe_order: Sequence | None = None, state: I.LoadState | None = None,
               every_payload: bool = False) -> Batch:
    """One incremental batch.

    1. jobs to read: live jobs and jobs with runs in flight;
    2. per job, the start to read from (watermark, lowered to the oldest
       in-flight start);
    3. landed run payloads at or after that start;
    4. flatten runs and tasks; attach failure output to failed tasks;
    5. upsert runs by run id and tasks by task run id;
    6. fill original attempt ids of tasks in runs with a failed, timed-out
       or cancelled task since the batch's oldest task start.
    ``runs``/``tasks`` None is the first load.

    With ``staged`` three small results are written once (``stage``): the per-job
    start bounds (one row per job, read by both the global pruning bound
    and the join), the selected payloads and the enriched batch tasks (the
    JSON is parsed once although the batch feeds both upserts, the backfill
    bound and the candidate search). The old tables stay plain scans. When
    nothing is new the old tables are returned as they are. With more than
    ``FEW_JOBS`` jobs the payloads are staged before they are selected: the
    join with the bounds then shuffles, per use, the columns that it reads,
    where it would shuffle and sort whole documents.

    A landing that keeps several snapshots of one run needs
    ``dedupe_order`` (e.g. ``[F.col("landed_at").desc()]``): the first
    snapshot per run id wins. Otherwise run ids must be unique per batch
    (``publish`` checks).

    ``state`` (``incremental.load_state`` once, then ``Batch.state`` of the
    previous batch) gives the jobs to read and their start bounds without
    scanning the run table; the result is the same.

    ``every_payload`` is for sources that hand out each payload once (a file
    stream): all payloads of the jobs in ``jobs`` are loaded whatever their
    start, and per run and task id the newest snapshot among the batch's and
    the table's own is kept (``I.snapshot_order``; a finished one is
    never replaced by one in flight), so the tables do not depend on how
    payloads are dealt into batches.
    """
    good, bad = _parsed(run_payloads, schemas.RUN_PAYLOAD, payload_column)
    starts, late = None, False          # late: selected from staged payloads at each use
    if every_payload:
        new = good.join(jobs.select("job_id").distinct(), "job_id", "left_semi").select(*good.columns)
    elif state is not None:
        monitored = I.monitored_from_state(jobs, state)
        starts = I.fetch_from_state(state, monitored, include_in_flight=include_in_flight)
    else:
        monitored = I.monitored_jobs(jobs, runs)
        starts = I.fetch_from(runs, monitored, include_in_flight=include_in_flight)
    if starts is not None:
        if staged:
            starts = stage(starts, "starts")
        many = staged and starts.count() > FEW_JOBS
        late = many and dedupe_order is None
        if late:
            good = stage(I.recent(good, starts), "payloads")
        new = I.select_new(good, starts, many=many)
    if dedupe_order is not None:
        new = U.latest_per_key(new, ["run_id"], list(dedupe_order))
    if staged:
        new = new if late else stage(new, "runs")
        if new.isEmpty():
            no_runs = FL.flatten_runs(new)
            no_tasks = I.enrich_failures(FL.flatten_tasks(new), outputs)
            done = Batch(runs if runs is not None else no_runs, no_runs, bad,
                         tasks if tasks is not None else no_tasks, no_tasks, no_tasks)
            done.state = state
            return done
    new_runs = FL.flatten_runs(new)
    if every_payload:
        new_runs = U.newest(runs, new_runs, ["job_run_id"], I.snapshot_order("job"))
        if staged:
            new_runs = stage(new_runs, "newest-runs")
    runs_out = U.upsert(runs, new_runs, ["job_run_id"])

    def task_side():
        flat = FL.flatten_tasks(new)
        if every_payload:
            flat = U.newest(tasks, flat, ["task_run_id"], I.snapshot_order("task"))
        new_tasks = I.enrich_failures(flat, outputs)
        if staged:
            new_tasks = stage(new_tasks, "tasks")
        tasks_up = U.upsert(tasks, new_tasks, ["task_run_id"])
        fills = I.attempt_fills(tasks_up, new_tasks, outputs)
        tasks_out = U.fill_missing(tasks_up, fills, "task_run_id", "task_original_attempt_run_id",
                                   source_column="_a")
        # changed rows: the batch's tasks plus the old tasks that get an
        # attempt id (fills are small), without going through the whole table
        new_keys = new_tasks.select("task_run_id")
        old_filled = (tasks.join(fills.select("task_run_id"), "task_run_id", "left_semi")
                      .join(new_keys, "task_run_id", "left_anti").select(*tasks.columns)
                      if tasks is not None else None)
        touched = new_tasks if old_filled is None else old_filled.unionByName(new_tasks,
                                                                               allowMissingColumns=True)
        changed = U.fill_missing(touched, fills, "task_run_id", "task_original_attempt_run_id",
                                 source_column="_a")
        return tasks_out, new_tasks, changed

    out = Batch(runs_out, new_runs, bad, task_side=task_side)
    out.state = I.advance_state(state, new_runs) if state is not None else None
    return out


class Published(NamedTuple):
    paths: dict            # table -> new version folder
    rows: dict             # table -> rows written


def publish(batch: Batch, version: str | int, base: str | None = None,
            partition_runs: Sequence[str] | None = None) -> Published:
    """Check and write both tables of a batch as new versions.

    Keys are checked unique before anything is written. Each table goes to
    its own new version folder; a failure part way leaves every earlier
    version whole, and the caller switches to the new paths only after this
    returns. Row counts are observed during the writes (no extra job).
    """
    from pyspark.sql import Observation

    spark = batch.runs.sparkSession
    base = base or TB.version_path(checkpoint_dir(spark), "tables", "")
    U.check_unique(batch.runs, ["job_run_id"])
    U.check_unique(batch.tasks, ["task_run_id"])
    seen = {name: Observation(name) for name in ("job_run_details", "task_run_details")}
    runs = batch.runs.observe(seen["job_run_details"], F.count(F.lit(1)).alias("rows"))
    tasks = batch.tasks.observe(seen["task_run_details"], F.count(F.lit(1)).alias("rows"))
    paths = {"job_run_details": TB.write_version(runs, base, "job_run_details", version, partition_runs),
             "task_run_details": TB.write_version(tasks, base, "task_run_details", version)}
    return Published(paths, {k: o.get["rows"] for k, o in seen.items()})


#: Column that each fact table is bucketed by: a run's id in both.
BUCKETS = {"task_run_details": "task_job_run_id", "job_run_details": "job_run_id"}


def publish_catalog(batch: Batch, settings, buckets: int | None = None) -> Published:
    """Check and write both tables of a batch as the catalog tables that
    ``settings`` (``config.Settings``) names for its environment. The new
    contents are staged before either table is replaced, so the batch may read
    the tables it replaces; tasks come first, the run table (which carries the
    watermark) last. With ``buckets`` both are bucketed by run id: the
    run-detail join then shuffles neither."""
    from pyspark.sql import Observation

    U.check_unique(batch.changed_runs, ["job_run_id"])
    U.check_unique(batch.changed_tasks, ["task_run_id"])
    seen = {name: Observation(name) for name in BUCKETS}
    staged = {name: stage(df.observe(seen[name], F.count(F.lit(1)).alias("rows")), name)
              for name, df in (("task_run_details", batch.tasks), ("job_run_details", batch.runs))}
    paths = {name: TB.save_table(df, settings.table(name), bucket_by=(buckets, BUCKETS[name]) if buckets else None)
             for name, df in staged.items()}
    return Published(paths, {name: o.get["rows"] for name, o in seen.items()})


def _existing(spark, path: str) -> DataFrame | None:
    """The table at ``path``, None if there is none. A table that is there but
    cannot be read raises."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    if not target.getFileSystem(spark._jsc.hadoopConfiguration()).exists(target):
        return None
    return spark.read.parquet(path)
