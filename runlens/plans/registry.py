"""Registered queries: each runs the library on telemetry tables derived
from the shared tables (``sources.fixtures``) and has the same result
written as DuckDB SQL over the raw tables, for the oracle check.

Every query reads whole tables. Registered outputs carry scalar columns
only and zone-free timestamps (``ntz=True``), so values compare exactly.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from runlens import schemas
from runlens.functions import millis_to_ts, ms_of
from runlens.operators import discover as D
from runlens.operators import flatten as FL
from runlens.operators import incremental as I
from runlens.operators import tags as TG
from runlens.operators import upsert as U
from runlens.plans import daily as DY
from runlens.plans import details as DT
from runlens.plans import load as LD
from runlens.plans import reports as R
from runlens.sources import fixtures as FX
from runlens.sources import payloads as PL

# Parameters of the registered queries.
PAIRS = [("building", "prod"), ("BUILDING ", "PROD"), ("machinery", " dev "), ("AUTOMOBILE", "prod")]
EXCLUDED = [7, 14, 21]
FIND_NAME = "customer#000000013"
HOST = "jobs.example.com"
JOB_CUT = "1999-01-01"          # job versions before / after an earlier load
RUN_CUT = "2000-01-01"          # the earlier run load
RUN_BAND = "1999-07-01"         # runs from here to RUN_CUT were still running then
TASK_CUT = "1998-01-01"         # two task batches
FAIL_FROM, FAIL_TO = "1998-01-01", "1998-07-01"
TOP_K = 3
DESIRED_TAGS = {"Team": "BUILDING", "Project": "Proj3", "Owner": "  ", "CostCenter": "x"}


def _L(spark, sf) -> FX.Landed:
    return FX.landed(spark, sf)


def _jobs_norm(spark, sf):
    return FL.normalise_tags(_L(spark, sf).jobs)


def _versions(spark, sf):
    return _L(spark, sf).versions


def _version_cols(df: DataFrame) -> DataFrame:
    return df.select("workspace_id", "job_id", "name", F.col("tags")["Team"].alias("tag_team"),
                     F.col("tags")["Type"].alias("tag_type"), "change_time", "version_id")


def q_latest_versions(spark, sf):
    latest = D.latest_versions(_versions(spark, sf), tie_break="version_id")
    return _version_cols(D.live(latest))


def q_match_pairs(spark, sf):
    return D.discover(_versions(spark, sf), PAIRS, EXCLUDED, tie_break="version_id").select("workspace_id", "job_id")


def q_find_by_name(spark, sf):
    return D.find_by_name(_versions(spark, sf), FIND_NAME, tie_break="version_id")


def q_normalised_tags(spark, sf):
    return _jobs_norm(spark, sf).select("job_id", *[schemas.tag_column(k) for k in schemas.tag_keys()])


def q_flatten_jobs(spark, sf):
    good, _bad = PL.split_bad(_L(spark, sf).job_payloads)
    return DT.scalar_view(FL.flatten_jobs(good, host=HOST))


def _parsed_runs(spark, sf):
    good, _bad = PL.split_bad(_L(spark, sf).run_payloads)
    return good


def q_flatten_runs(spark, sf):
    return DT.scalar_view(FL.flatten_runs(_parsed_runs(spark, sf)))


def q_flatten_tasks(spark, sf):
    return DT.scalar_view(FL.flatten_tasks(_parsed_runs(spark, sf)))


def q_json_props(spark, sf):
    events = spark.read.parquet(f"{sf}/events.parquet").select("event_id", "props")
    good, _bad = PL.split_bad(PL.parse_json(events, "props", schemas.struct_of(("k", schemas.L)), keep=["event_id"]))
    return good.select("event_id", "k")


def q_monitored_jobs(spark, sf):
    L = _L(spark, sf)
    return I.monitored_jobs(L.jobs, L.runs)


def q_watermarks(spark, sf):
    return I.watermarks(_L(spark, sf).runs)


def q_fetch_from(spark, sf):
    L = _L(spark, sf)
    return I.fetch_from(L.runs, I.monitored_jobs(L.jobs, L.runs))


def _snapshot(spark, sf):
    return FX.runs_snapshot(_L(spark, sf).runs, RUN_CUT, RUN_BAND)


def q_select_new(spark, sf):
    jobs, old = _L(spark, sf).jobs, _snapshot(spark, sf)
    starts = I.fetch_from(old, I.monitored_jobs(jobs, old))
    new = I.select_new(_parsed_runs(spark, sf), starts)
    return new.select("run_id", "job_id", "start_time")


def _told(spark, sf):
    """Landed tasks with their outputs; the columns of a task row that they lack are left to ``conform_tasks``."""
    L = _L(spark, sf)
    texts = {f"task_{f}": F.lit(None).cast("string") for f in ("notebook_output", "error", "error_trace")}
    return I.enrich_failures(L.tasks.withColumns(texts), L.outputs)


def _enriched(spark, sf):
    return I.conform_tasks(_told(spark, sf))


def q_enrich_failures(spark, sf):
    return _enriched(spark, sf).select(
        "task_run_id", "task_state__result_state", "task_notebook_output", "task_error", "task_error_trace",
        "task_original_attempt_run_id")


def _task_batch(tasks: DataFrame) -> DataFrame:
    return tasks.where(F.col("task_start_time") >= ms_of(RUN_CUT))


def q_backfill_candidates(spark, sf):
    tasks = _L(spark, sf).tasks
    return I.backfill_candidates(tasks, _task_batch(tasks))


def q_fill_attempt_ids(spark, sf):
    L = _L(spark, sf)
    out = I.fill_attempt_ids(L.tasks, _task_batch(L.tasks), L.outputs)
    return out.select("task_run_id", "task_original_attempt_run_id")


def q_upsert_jobs(spark, sf):
    v = _versions(spark, sf)
    before = F.col("change_time") < F.lit(JOB_CUT).cast("timestamp_ntz")
    keys = ["workspace_id", "job_id"]
    old = D.latest_versions(v.where(before), keys, tie_break="version_id")
    new = D.latest_versions(v.where(~before), keys, tie_break="version_id")
    out = U.upsert(old, new, keys)
    return out.select("workspace_id", "job_id", "name", "change_time", "version_id",
                      F.col("delete_time").isNotNull().alias("deleted"))


def _run_cols(df: DataFrame) -> DataFrame:
    return df.select("job_run_id", "job_id", "job_start_time", "job_end_time", "job_run_duration",
                     "job_cleanup_duration", "job_state__life_cycle_state", "job_state__result_state")


def q_upsert_runs(spark, sf):
    runs = _L(spark, sf).runs
    batch = runs.where(F.col("job_start_time") >= ms_of(RUN_BAND))
    return _run_cols(U.upsert(_snapshot(spark, sf), batch, ["job_run_id"]))


def q_upsert_tasks(spark, sf):
    raw = FX.tasks_raw(spark, sf)
    order = [F.col(c).desc() for c in FX.TASK_ORDER]
    early = F.col("task_start_time") < ms_of(TASK_CUT)
    t1 = U.upsert(None, raw.where(early), ["task_run_id"], order)
    t2 = U.upsert(t1, raw.where(~early), ["task_run_id"], order)
    return t2.select("task_run_id", "task_job_run_id", "task_key", "task_start_time", "task_end_time",
                     "task_execution_duration", "task_cleanup_duration", "task_original_attempt_run_id",
                     "task_state__result_state")


def q_mark_missing(spark, sf):
    seen = D.discover(_versions(spark, sf), PAIRS, EXCLUDED, tie_break="version_id")
    keep = spark.createDataFrame([(i,) for i in EXCLUDED], "job_id long")
    out = U.mark_missing(_jobs_norm(spark, sf), seen, keep=keep)
    return out.select("job_id", "is_job_deleted")


def _details(spark, sf) -> DataFrame:
    """All columns of the run-detail table, from the landed payloads."""
    L = _L(spark, sf)
    payloads = _parsed_runs(spark, sf)
    jobs = FL.normalise_tags(FL.flatten_jobs(PL.split_bad(L.job_payloads)[0], host=HOST))
    tasks = I.enrich_failures(FL.flatten_tasks(payloads), L.outputs)
    return DT.run_details(tasks, FL.flatten_runs(payloads), jobs, ntz=True, many_jobs=DT.has_many(L.jobs))


def q_run_details(spark, sf):
    return DT.scalar_view(_details(spark, sf))


BUCKET_COUNT = 8


def q_details_view(spark, sf):
    """The run-detail view of the catalog, over fact tables bucketed by run id."""
    import os
    import uuid

    from runlens.sources import tables as TB

    L = _L(spark, sf)
    payloads = _parsed_runs(spark, sf)
    tag, root = uuid.uuid4().hex[:12], _store(spark)
    frames = {"task_run_details": I.enrich_failures(FL.flatten_tasks(payloads), L.outputs),
              "job_run_details": FL.flatten_runs(payloads),
              "job_details": FL.normalise_tags(FL.flatten_jobs(PL.split_bad(L.job_payloads)[0], host=HOST))}
    names = {n: TB.save_table(df, f"runlens_{tag}.{n}", path=os.path.join(root, n),
                              bucket_by=(BUCKET_COUNT, LD.BUCKETS[n]) if n in LD.BUCKETS else None) for n, df in frames.items()}
    view = DT.create_catalog_view(spark, f"runlens_{tag}.run_details", *(names[n] for n in frames))
    zoned = spark.table(view)
    return DT.scalar_view(zoned.withColumns({c: millis_to_ts(F.unix_millis(c), ntz=True) for c in DT.TIME_COLUMNS}))


_STORES: dict[tuple[str, str], str] = {}


def _counted_store(spark, sf):
    """A day store of all runs and enriched tasks, once a session and folder."""
    from runlens.session import app_id

    key = (app_id(spark), sf)
    if key not in _STORES:
        L = _L(spark, sf)
        base = _store(spark)
        DY.seed(DY.open_store(spark, base), L.runs, _told(spark, sf), unit="month")
        _STORES[key] = base
    return DY.open_store(spark, _STORES[key])


def q_top_failed_daily(spark, sf):
    return R.top_failed_jobs_daily(_counted_store(spark, sf).read("run_counts"), _jobs_norm(spark, sf), FAIL_FROM, FAIL_TO, k=TOP_K)


def q_failure_trend_daily(spark, sf):
    return R.failure_trend_daily(_counted_store(spark, sf).read("run_counts"))


def q_recurring_errors_daily(spark, sf):
    return R.recurring_errors_daily(_counted_store(spark, sf).read("error_counts"), _jobs_norm(spark, sf), ntz=True)


def q_long_running_daily(spark, sf):
    return DY.long_running(_counted_store(spark, sf), ntz=True)


def q_inventory(spark, sf):
    return R.inventory(_jobs_norm(spark, sf))


def q_top_failed_jobs(spark, sf):
    return R.top_failed_jobs(_L(spark, sf).runs, _jobs_norm(spark, sf), FAIL_FROM, FAIL_TO, k=TOP_K)


def q_failure_trend(spark, sf):
    return R.failure_trend(_L(spark, sf).event_runs, ntz=True)


def q_recurring_errors(spark, sf):
    d = DT.run_details(_enriched(spark, sf), _L(spark, sf).runs, _jobs_norm(spark, sf), ntz=True)
    return R.recurring_errors(d, min_count=2)


def q_long_running(spark, sf):
    return R.long_running(I.conform_runs(_L(spark, sf).event_runs), elapsed="duration", ntz=True)


def q_long_running_now(spark, sf):
    """The report's default form: elapsed time is now (the newest start) - start."""
    return R.long_running(I.conform_runs(_L(spark, sf).event_runs), ntz=True)


def q_latest_status(spark, sf):
    return R.latest_status(_L(spark, sf).event_runs, ntz=True)


def q_standards_flags(spark, sf):
    return R.standards_flags(_L(spark, sf).jobs)


def q_standards_summary(spark, sf):
    return R.standards_summary(_L(spark, sf).jobs)


def q_sanity_counts(spark, sf):
    L = _L(spark, sf)
    return R.sanity_counts(spark, _jobs_norm(spark, sf), L.runs, L.tasks)


def _plan(spark, sf):
    return TG.plan_tags(FX.job_tags(_L(spark, sf).jobs), DESIRED_TAGS, overwrite=True, dry_run=True)


def q_plan_tags(spark, sf):
    return TG.plan_rows(_plan(spark, sf))


def q_apply_tags(spark, sf):
    t = TG.apply_tags(_plan(spark, sf))
    return t.select("job_id", *[F.col("tags")[k].alias(k.lower()) for k in schemas.REQUIRED_TAG_KEYS])


def q_tag_summary(spark, sf):
    return TG.tag_summary(_plan(spark, sf))


TAG_IDS_FROM = -5               # ids of no job, down from 0 to here


def _plan_untagged(spark, sf):
    """Every eleventh job without tags, ids that no job has, new keys only."""
    jobs = _L(spark, sf).jobs
    tagged = FX.job_tags(jobs).withColumn("tags", F.when(F.col("job_id") % 11 != 0, F.col("tags")))
    ids = tagged.select("job_id").union(spark.range(TAG_IDS_FROM, 0).select(F.col("id").alias("job_id")))
    return TG.plan_tags(tagged, DESIRED_TAGS, overwrite=False, dry_run=False, job_ids=ids)


def q_plan_tags_untagged(spark, sf):
    plan = _plan_untagged(spark, sf)
    return plan.select("job_id", "status", F.explode_outer("changes").alias("c")).select(
        "job_id", "status", F.col("c.key").alias("key"), F.col("c.old").alias("old_value"),
        F.col("c.new").alias("new_value"))


def q_apply_tags_untagged(spark, sf):
    t = TG.apply_tags(_plan_untagged(spark, sf))
    return t.select("job_id", *[F.col("tags")[k].alias(k.lower()) for k in schemas.REQUIRED_TAG_KEYS])


def q_tag_summary_untagged(spark, sf):
    return TG.tag_summary(_plan_untagged(spark, sf))


def q_load_jobs_repeated(spark, sf):
    """Every job landed twice: an older payload with another name first."""
    L = _L(spark, sf)
    old = L.job_payloads.withColumn("settings", F.col("settings").withField("name", F.lit("before")))
    landed = old.withColumn("landed", F.lit(1)).unionByName(L.job_payloads.withColumn("landed", F.lit(2)))
    out = LD.load_jobs(L.versions, landed, PAIRS, current=FL.normalise_tags(L.jobs), excluded=EXCLUDED, host=HOST,
                       tie_break="version_id", payload_column="", dedupe_order=[F.col("landed").desc()])
    return out.jobs.select("job_id", "is_job_deleted", "job__name", "job__tags__Team", "job__tags__Type",
                           "job__tags__Priority", "job__schedule__timezone_id", "Job_link")


def q_load_jobs(spark, sf):
    L = _L(spark, sf)
    current = FL.normalise_tags(L.jobs)          # the job table as an earlier load left it
    out = LD.load_jobs(L.versions, L.job_payloads, PAIRS, current=current, excluded=EXCLUDED, host=HOST,
                       tie_break="version_id", payload_column="")
    return out.jobs.select("job_id", "is_job_deleted", "job__name", "job__tags__Team", "job__tags__Type",
                           "job__tags__Priority", "job__schedule__timezone_id", "Job_link")


def _batch(spark, sf):
    L = _L(spark, sf)
    old_runs = _snapshot(spark, sf)
    old_tasks = L.tasks.join(old_runs.select(F.col("job_run_id").alias("task_job_run_id")), "task_job_run_id",
                             "left_semi")
    return LD.load_batch(L.jobs, I.conform_runs(old_runs), I.conform_tasks(old_tasks), L.run_payloads, L.outputs)


def q_incremental_runs(spark, sf):
    return _run_cols(_batch(spark, sf).runs)


def q_incremental_tasks(spark, sf):
    return _batch(spark, sf).tasks.select(
        "task_run_id", "task_job_run_id", "task_start_time", "task_state__result_state", "task_error",
        "task_original_attempt_run_id")


def _store(spark) -> str:
    import uuid

    from runlens.session import scratch_path

    return scratch_path(spark, "runlens-store", uuid.uuid4().hex)


TASK_RESULT = ["task_run_id", "task_job_run_id", "task_start_time", "task_state__result_state", "task_notebook_output",
               "task_error", "task_error_trace", "task_original_attempt_run_id"]


def q_incremental_in_place(spark, sf):
    """The earlier load seeded as tables by day, then the payloads it may lack
    and all outputs: days touched are rewritten, and outputs also reach the
    failed tasks of the earlier load."""
    L = _L(spark, sf)
    old_runs = _snapshot(spark, sf)
    old_tasks = L.tasks.join(old_runs.select(F.col("job_run_id").alias("task_job_run_id")), "task_job_run_id", "left_semi")
    store = DY.open_store(spark, _store(spark))
    # six years of runs, a few thousand rows a day at most here: months
    DY.seed(store, old_runs, old_tasks, unit="month")
    new = DY.select_payloads(store, L.jobs, PL.split_bad(L.run_payloads)[0])
    DY.apply_batch(store, L.jobs, new, L.outputs, unit="month")
    return DY.tasks_of(store).select(*TASK_RESULT)


def _streamed(spark, sf):
    from runlens.streaming import run_store_stream

    runs, outputs, group = FX.land_stream(spark, sf)
    base = _store(spark)
    run_store_stream(spark, runs, outputs, _L(spark, sf).jobs, base, max_files_per_trigger=group, unit="month")
    return DY.open_store(spark, base)


def q_stream_load(spark, sf):
    """All run payloads and outputs by file streams, a file (or group of files)
    of each at a time: every failed task ends with its output, whichever came first."""
    return DY.tasks_of(_streamed(spark, sf)).select(*TASK_RESULT)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "latest_versions": q_latest_versions,
    "match_pairs": q_match_pairs,
    "find_by_name": q_find_by_name,
    "normalised_tags": q_normalised_tags,
    "flatten_jobs": q_flatten_jobs,
    "flatten_runs": q_flatten_runs,
    "flatten_tasks": q_flatten_tasks,
    "json_props": q_json_props,
    "monitored_jobs": q_monitored_jobs,
    "watermarks": q_watermarks,
    "fetch_from": q_fetch_from,
    "select_new": q_select_new,
    "enrich_failures": q_enrich_failures,
    "backfill_candidates": q_backfill_candidates,
    "fill_attempt_ids": q_fill_attempt_ids,
    "upsert_jobs": q_upsert_jobs,
    "upsert_runs": q_upsert_runs,
    "upsert_tasks": q_upsert_tasks,
    "mark_missing": q_mark_missing,
    "run_details": q_run_details,
    "details_view": q_details_view,
    "inventory": q_inventory,
    "top_failed_jobs": q_top_failed_jobs,
    "failure_trend": q_failure_trend,
    "recurring_errors": q_recurring_errors,
    "top_failed_daily": q_top_failed_daily,
    "failure_trend_daily": q_failure_trend_daily,
    "recurring_errors_daily": q_recurring_errors_daily,
    "long_running_daily": q_long_running_daily,
    "long_running": q_long_running,
    "long_running_now": q_long_running_now,
    "latest_status": q_latest_status,
    "standards_flags": q_standards_flags,
    "standards_summary": q_standards_summary,
    "sanity_counts": q_sanity_counts,
    "plan_tags": q_plan_tags,
    "apply_tags": q_apply_tags,
    "tag_summary": q_tag_summary,
    "load_jobs": q_load_jobs,
    "load_jobs_repeated": q_load_jobs_repeated,
    "plan_tags_untagged": q_plan_tags_untagged,
    "apply_tags_untagged": q_apply_tags_untagged,
    "tag_summary_untagged": q_tag_summary_untagged,
    "incremental_runs": q_incremental_runs,
    "incremental_tasks": q_incremental_tasks,
    "incremental_in_place": q_incremental_in_place,
    "stream_load": q_stream_load,
}
