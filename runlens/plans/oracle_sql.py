"""The registered queries written as DuckDB SQL over the raw shared tables
(views ``customer``, ``orders``, ``lineitem``, ``events``). Used only by
the correctness check; the library never runs these.

``MS(x)`` in the fixture text is epoch milliseconds of a zone-free
timestamp, truncated like Spark's ``timestamp_diff``.
"""

from __future__ import annotations

from runlens.plans import registry as Q

_MS = "(epoch_us({}) // 1000)"


def _ms_lit(day: str) -> str:
    return _MS.format(f"TIMESTAMP '{day} 00:00:00'")


FIXTURES = """
job_versions AS (
  select cast(c_nationkey as varchar) workspace_id, o_custkey job_id, c_name name,
    c_mktsegment tag_team, case when c_nationkey % 2 = 0 then 'PROD' else ' dev ' end tag_type,
    o_orderdate change_time, o_orderkey version_id,
    case when o_orderstatus = 'F' then o_orderdate end delete_time
  from orders join customer on o_custkey = c_custkey),
jobs AS (
  select c_custkey job_id, cast(c_custkey % 10 as bigint) * 86400000 created_time,
    'user' || cast(c_nationkey as varchar) || '@example.com' creator_user_name,
    case when c_custkey % 4 = 0 then 'sp-' || cast(c_nationkey as varchar)
         else 'user' || cast(c_nationkey as varchar) || '@example.com' end run_as_user_name,
    case when c_custkey % 17 = 0 then 'yes' else 'no' end is_job_deleted,
    c_name job__name,
    case when c_custkey % 5 <> 0 then '0 0 * * * ?' end job__schedule__quartz_cron_expression,
    case when c_custkey % 3 <> 0 then 'https://git.example.com/r' end job__git_source__git_url,
    case when c_custkey % 7 <> 0 then 'oncall@example.com' end on_failure_email,
    c_mktsegment job__tags__Team,
    case when c_nationkey % 2 = 0 then 'PROD' else ' dev ' end job__tags__Type,
    'Owner' || cast(c_nationkey as varchar) job__tags__Owner,
    'Domain' || cast(c_nationkey % 5 as varchar) job__tags__Domain,
    ' p' || cast(c_custkey % 4 + 1 as varchar) job__tags__Priority,
    case when c_custkey % 6 <> 0 then 'Proj' || cast(c_custkey % 9 as varchar) end job__tags__Project
  from customer),
jobs_norm AS (
  select * replace (trim(lower(job__tags__Team)) as job__tags__Team, trim(lower(job__tags__Type)) as job__tags__Type,
    trim(lower(job__tags__Owner)) as job__tags__Owner, trim(lower(job__tags__Domain)) as job__tags__Domain,
    trim(upper(job__tags__Priority)) as job__tags__Priority, trim(lower(job__tags__Project)) as job__tags__Project)
  from jobs),
runs AS (
  select o_orderkey job_run_id, o_custkey job_id, MS(o_orderdate) job_start_time,
    case when o_orderstatus = 'P' then cast(0 as bigint)
         else MS(o_orderdate) + cast(round(o_totalprice * 10) as bigint) end job_end_time,
    case when o_orderkey % 3 = 0 then cast(0 as bigint) else cast(round(o_totalprice * 10) as bigint) end job_run_duration,
    cast(o_orderkey % 5000 as bigint) job_setup_duration,
    cast(round(o_totalprice * 10) as bigint) job_execution_duration,
    case when o_orderkey % 11 = 0 then null else cast(700 as bigint) end job_cleanup_duration,
    case when o_orderstatus = 'P' then 'RUNNING' else 'TERMINATED' end job_state__life_cycle_state,
    case o_orderstatus when 'F' then 'FAILED' when 'O' then 'SUCCESS' end job_state__result_state
  from orders),
tasks_raw AS (
  select l_orderkey task_job_run_id, l_orderkey * 10 + l_linenumber task_run_id,
    MS(l_shipdate) task_start_time, MS(l_shipdate) + cast(l_quantity * 1000 as bigint) task_end_time,
    cast(l_linenumber * 100 as bigint) task_setup_duration,
    cast(l_quantity * 1000 as bigint) task_execution_duration,
    cast(l_suppkey % 50 as bigint) task_cleanup_duration,
    'task' || cast(l_linenumber as varchar) task_key,
    case when l_partkey % 3 = 0 then l_orderkey * 10 + l_linenumber end task_original_attempt_run_id,
    case l_returnflag when 'R' then 'FAILED' when 'A' then 'SUCCESS' else 'CANCELED' end task_state__result_state,
    l_partkey, l_suppkey, l_extendedprice
  from lineitem),
tasks AS (
  select * exclude (rn, l_partkey, l_suppkey, l_extendedprice) from (
    select *, row_number() over (partition by task_run_id
      order by task_start_time desc, l_partkey desc, l_suppkey desc, l_extendedprice desc) rn
    from tasks_raw) q
  where rn = 1),
run_outputs AS (
  select cast(task_run_id as varchar) run_id,
    'error ' || cast(task_run_id % 7 as varchar) error,
    'trace ' || cast(task_run_id % 5 as varchar) error_trace,
    case when task_run_id % 2 = 0 then cast(task_run_id - 1 as varchar) end original_attempt_run_id
  from tasks where task_state__result_state = 'FAILED' and task_key <> 'task7'),
event_runs AS (
  select event_id job_run_id, user_id job_id, MS(ts) job_start_time,
    cast(round(value * 1000) as bigint) job_run_duration,
    case when event_type = 'signup' then 'RUNNING' else 'TERMINATED' end job_state__life_cycle_state,
    case when event_type = 'error' then 'FAILED' when event_type <> 'signup' then 'SUCCESS' end job_state__result_state
  from events),
latest AS (
  select * from job_versions
  qualify row_number() over (partition by workspace_id, job_id order by change_time desc, version_id desc) = 1),
pairs AS (
  select * from (values ('BUILDING', 'PROD'), ('MACHINERY', 'DEV'), ('AUTOMOBILE', 'PROD')) p(team, type)),
discovered AS (
  select l.* from latest l
  where l.delete_time is null and l.job_id not in (7, 14, 21)
    and exists (select 1 from pairs p where p.team = upper(trim(l.tag_team)) and p.type = upper(trim(l.tag_type)))),
snapshot AS (
  select job_run_id, job_id, job_start_time,
    case when job_start_time >= {band} then cast(0 as bigint) else job_end_time end job_end_time,
    job_run_duration, job_setup_duration, job_execution_duration, job_cleanup_duration,
    case when job_start_time >= {band} then 'RUNNING' else job_state__life_cycle_state end job_state__life_cycle_state,
    case when job_start_time >= {band} then null else job_state__result_state end job_state__result_state
  from runs where job_start_time < {cut}),
snap_monitored AS (
  select job_id from jobs where is_job_deleted = 'no'
  union
  select job_id from snapshot where job_state__life_cycle_state in ('PENDING', 'RUNNING', 'TERMINATING')),
snap_starts AS (
  select m.job_id, least(coalesce(a.wm, 0), a.busy) fetch_from
  from snap_monitored m left join (
    select job_id,
      max(case when job_state__life_cycle_state in ('TERMINATED', 'INTERNAL_ERROR') then job_start_time end) wm,
      min(case when job_state__life_cycle_state in ('PENDING', 'RUNNING', 'TERMINATING') then job_start_time end) busy
    from snapshot group by job_id) a on a.job_id = m.job_id),
enriched AS (
  select t.task_run_id, t.task_job_run_id, t.task_key, t.task_start_time, t.task_end_time,
    t.task_setup_duration, t.task_execution_duration, t.task_cleanup_duration, t.task_state__result_state,
    case when t.task_state__result_state = 'FAILED' then o.error end task_error,
    case when t.task_state__result_state = 'FAILED' then o.error_trace end task_error_trace,
    cast(null as varchar) task_notebook_output,
    case when t.task_state__result_state = 'FAILED'
         then coalesce(cast(o.original_attempt_run_id as bigint), t.task_original_attempt_run_id)
         else t.task_original_attempt_run_id end task_original_attempt_run_id
  from tasks t left join run_outputs o on t.task_run_id = cast(o.run_id as bigint))
""".replace("MS(o_orderdate)", _MS.format("o_orderdate")).replace(
    "MS(l_shipdate)", _MS.format("l_shipdate")).replace("MS(ts)", _MS.format("ts")).replace(
    "{band}", _ms_lit(Q.RUN_BAND)).replace("{cut}", _ms_lit(Q.RUN_CUT))


def _with(body: str) -> str:
    return "WITH " + FIXTURES.strip() + "\n" + body.strip()


TAG_COLS = ["job__tags__Domain", "job__tags__Owner", "job__tags__Priority", "job__tags__Project",
            "job__tags__Team", "job__tags__Type"]


def _backfill(tasks: str, batch: str) -> str:
    """Candidates: tasks of runs with a failed/timed-out/cancelled task since
    the oldest non-zero start of the batch, whose attempt id is NULL."""
    return f"""
    select t.task_run_id from {tasks} t
    where t.task_original_attempt_run_id is null and t.task_job_run_id in (
      select distinct task_job_run_id from {tasks}
      where task_start_time >= (select min(task_start_time) from {batch} where task_start_time <> 0)
        and task_state__result_state in ('FAILED', 'TIMEDOUT', 'CANCELED'))"""


# All columns of flattened runs, tasks and jobs; maps and arrays as JSON text.
RUN_SQL = {
    **{c: f"r.{c}" for c in (
        "job_cleanup_duration", "job_end_time", "job_execution_duration", "job_id", "job_run_duration", "job_run_id",
        "job_setup_duration", "job_start_time", "job_state__life_cycle_state", "job_state__result_state")},
    "job_creator_user_name": "'user' || (r.job_run_id % 7)",
    "job_job_clusters": """'[{"job_cluster_key":"c' || (r.job_run_id % 3) || '"}]'""",
    "job_job_parameters": """case when r.job_run_id % 4 <> 0 then '[{"name":"p","value":"' || (r.job_run_id % 5) || '"}]' end""",
    "job_number_in_job": "r.job_run_id % 100",
    "job_original_attempt_run_id": "r.job_run_id",
    "job_overriding_parameters":
        """case when r.job_run_id % 5 = 0 then '{"notebook_params":{"k":"' || (r.job_run_id % 9) || '"}}' end""",
    "job_run_name": "'run ' || (r.job_run_id % 13)",
    "job_run_page_url": "'https://jobs.example.com/run/' || r.job_run_id",
    "job_run_type": "case when r.job_run_id % 2 = 0 then 'JOB_RUN' else 'SUBMIT_RUN' end",
    "job_schedule":
        """case when r.job_run_id % 3 = 0 then '{"quartz_cron_expression":"0 0 * * * ?","timezone_id":"UTC"}' end""",
    "job_state__state_message": "'message ' || (r.job_run_id % 4)",
    "job_state__user_cancelled_or_timedout": "case when r.job_run_id % 8 = 0 then 'true' else 'false' end",
    "job_tasks": "coalesce(k.job_tasks, '[]')",
    "job_trigger": "case when r.job_run_id % 3 = 0 then 'PERIODIC' else 'ONE_TIME' end",
    "job_trigger_info": """case when r.job_run_id % 6 = 0 then '{"run_id":' || r.job_run_id || '}' end""",
}
RUN_TASKS = """(
  select task_job_run_id, '[' || string_agg('{"cleanup_duration":' || task_cleanup_duration || ',"end_time":' || task_end_time
    || ',"execution_duration":' || task_execution_duration || ',"run_id":' || task_run_id || ',"setup_duration":'
    || task_setup_duration || ',"start_time":' || task_start_time || '}', ',' order by task_run_id) || ']' job_tasks
  from tasks group by 1)"""
TASK_SQL = {
    **{c: f"t.{c}" for c in (
        "task_cleanup_duration", "task_end_time", "task_execution_duration", "task_job_run_id", "task_run_id",
        "task_setup_duration", "task_start_time", "task_key", "task_state__result_state", "task_original_attempt_run_id")},
    **{c: "cast(null as varchar)" for c in ("task_notebook_output", "task_error", "task_error_trace", "task_run_job_task")},
    "task_attempt_number": "t.task_run_id % 3",
    "task_cluster_instance":
        """'{"cluster_id":"cl-' || (t.task_run_id % 6) || '","spark_context_id":"' || (t.task_run_id % 11) || '"}'""",
    "task_git_source": """case when t.task_run_id % 3 = 0 then '{"git_url":"https://git.example.com/r","git_branch":"main"}' end""",
    "task_notebook_task": """'{"notebook_path":"/w/nb"}'""",
    "task_run_if": "case when t.task_run_id % 2 = 0 then 'ALL_SUCCESS' else 'ALL_DONE' end",
    "task_existing_cluster_id": "case when t.task_run_id % 4 = 0 then 'cl-' || (t.task_run_id % 6) end",
    "task_depends_on": """case when t.task_key <> 'task1' then '[{"task_key":"task1"}]' end""",
    "task_libraries": r"""case when t.task_run_id % 6 = 0 then '[{"pypi":"{\"package\":\"lib' || (t.task_run_id % 4) || '\"}"}]' end""",
    "task_description": "case when t.task_run_id % 5 <> 0 then 'step ' || (t.task_run_id % 5) end",
    "task_state__life_cycle_state": "'TERMINATED'",
    "task_state__user_cancelled_or_timedout": "case when t.task_run_id % 8 = 0 then 'true' else 'false' end",
    "task_state__state_message": "'message ' || (t.task_run_id % 4)",
    "task_sql_task": """case when t.task_run_id % 7 = 0 then '{"warehouse_id":"w' || (t.task_run_id % 4) || '"}' end""",
    "task_condition_task": """case when t.task_run_id % 10 = 0 then '{"op":"EQUAL_TO","left":"' || (t.task_run_id % 2) || '"}' end""",
    "task_queue_duration": "t.task_run_id % 1000",
    "task_pipeline_task": """case when t.task_run_id % 9 = 0 then '{"pipeline_id":"p' || (t.task_run_id % 4) || '"}' end""",
}
JOB_SQL = {
    **{c: f"j.{c}" for c in (
        "job_id", "created_time", "creator_user_name", "run_as_user_name", "job__name",
        "job__schedule__quartz_cron_expression", "job__git_source__git_url", *TAG_COLS)},
    "is_job_deleted": "'no'",
    "job__schedule__pause_status": "case when j.job__schedule__quartz_cron_expression is not null then 'UNPAUSED' end",
    "job__schedule__timezone_id": "case when j.job__schedule__quartz_cron_expression is not null then 'UTC' end",
    "job__timeout_seconds": "cast(3600 as bigint)",
    "job__git_source__git_branch": "case when j.job__git_source__git_url is not null then 'main' end",
    "job__git_source__git_provider": "case when j.job__git_source__git_url is not null then 'gitHub' end",
    "job__email_notifications__on_failure": """'["' || j.on_failure_email || '"]'""",
    "job__email_notifications__on_success": """case when j.job_id % 8 = 0 then '["ok@example.com"]' end""",
    "job__job_clusters": """case when j.job_id % 9 = 0 then '[{"job_cluster_key":"main"}]' end""",
    "Job_link": f"'https://{Q.HOST}/jobs/' || j.job_id",
}


def _columns(exprs: dict[str, str]) -> str:
    return ",\n  ".join(f"{e} {c}" for c, e in exprs.items())


def _details_sql() -> str:
    """The run-detail table: 72 columns."""
    from runlens.plans.details import PASSTHROUGH, SECOND_COLUMNS, TIME_COLUMNS, VIEW_TAG_KEYS

    failed = {f"task_{c}": f"case when t.task_state__result_state = 'FAILED' then o.{c} end" for c in ("error", "error_trace")}
    failed["task_original_attempt_run_id"] = (
        "case when t.task_state__result_state = 'FAILED' then coalesce(cast(o.original_attempt_run_id as bigint), "
        "t.task_original_attempt_run_id) else t.task_original_attempt_run_id end")
    every = JOB_SQL | RUN_SQL | TASK_SQL | failed
    cols = {c: every[c] for c in ("task_run_id", "job_run_id", "job_id", "job__name", "job_run_page_url")}
    cols |= {c: f"make_timestamp_ms(nullif({every[c]}, 0))" for c in TIME_COLUMNS}
    cols["job_elapsed_time_sec"] = (
        "cast(floor((case when coalesce(r.job_run_duration, 0) = 0 then r.job_setup_duration + r.job_execution_duration "
        "+ r.job_cleanup_duration else r.job_run_duration end) / 1000) as bigint)")
    cols["task_elapsed_time_sec"] = (
        "cast(floor((t.task_setup_duration + t.task_execution_duration + t.task_cleanup_duration) / 1000) as bigint)")
    cols |= {f"{c}_sec": f"cast(floor({every[c]} / 1000) as bigint)" for c in SECOND_COLUMNS}
    cols |= {c: every[c] for c in PASSTHROUGH}
    cols |= {f"job__tags__{k}": f"j.job__tags__{k}" for k in VIEW_TAG_KEYS}
    return f"""select {_columns(cols)}
from tasks t join runs r on t.task_job_run_id = r.job_run_id join jobs_norm j on j.job_id = r.job_id
  left join {RUN_TASKS} k on k.task_job_run_id = r.job_run_id
  left join run_outputs o on cast(o.run_id as bigint) = t.task_run_id"""


SQL: dict[str, str] = {
    "latest_versions": """
select workspace_id, job_id, name, tag_team, tag_type, change_time, version_id
from latest where delete_time is null""",
    "match_pairs": "select workspace_id, job_id from discovered",
    "find_by_name": f"""
select job_id from latest where delete_time is null and lower(name) = lower('{Q.FIND_NAME}')
order by job_id limit 1""",
    "normalised_tags": f"select job_id, {', '.join(TAG_COLS)} from jobs_norm",
    "flatten_jobs": f"select {_columns(JOB_SQL)} from jobs j",
    "flatten_runs": f"""
select {_columns(RUN_SQL)}
from runs r left join {RUN_TASKS} k on k.task_job_run_id = r.job_run_id""",
    "flatten_tasks": f"select {_columns(TASK_SQL)} from tasks t",
    "json_props": "select event_id, cast(json_extract_string(props, '$.k') as bigint) k from events",
    "monitored_jobs": """
select job_id from jobs where is_job_deleted = 'no'
union
select job_id from runs where job_state__life_cycle_state in ('PENDING', 'RUNNING', 'TERMINATING')""",
    "watermarks": """
select job_id, coalesce(max(job_start_time), 0) watermark from runs
where job_state__life_cycle_state in ('TERMINATED', 'INTERNAL_ERROR') group by job_id""",
    "fetch_from": """
with m as (
  select job_id from jobs where is_job_deleted = 'no'
  union
  select job_id from runs where job_state__life_cycle_state in ('PENDING', 'RUNNING', 'TERMINATING')),
a as (
  select job_id,
    max(case when job_state__life_cycle_state in ('TERMINATED', 'INTERNAL_ERROR') then job_start_time end) wm,
    min(case when job_state__life_cycle_state in ('PENDING', 'RUNNING', 'TERMINATING') then job_start_time end) busy
  from runs group by job_id)
select m.job_id, coalesce(a.wm, 0) watermark, least(coalesce(a.wm, 0), a.busy) fetch_from
from m left join a on a.job_id = m.job_id""",
    "select_new": """
select r.job_run_id run_id, r.job_id, r.job_start_time start_time
from runs r join snap_starts s on s.job_id = r.job_id
where r.job_start_time >= s.fetch_from""",
    "enrich_failures": """
select task_run_id, task_state__result_state, task_notebook_output, task_error, task_error_trace,
  task_original_attempt_run_id
from enriched""",
    "backfill_candidates": _backfill("tasks", f"(select * from tasks where task_start_time >= {_ms_lit(Q.RUN_CUT)})"),
    "fill_attempt_ids": f"""
with cand as ({_backfill("tasks", f"(select * from tasks where task_start_time >= {_ms_lit(Q.RUN_CUT)})")}),
src as (
  select cast(run_id as bigint) task_run_id, max(cast(original_attempt_run_id as bigint)) a
  from run_outputs where original_attempt_run_id is not null
    and cast(run_id as bigint) in (select task_run_id from cand)
  group by 1)
select t.task_run_id, coalesce(t.task_original_attempt_run_id, s.a) task_original_attempt_run_id
from tasks t left join src s on s.task_run_id = t.task_run_id""",
    "upsert_jobs": """
select workspace_id, job_id, name, change_time, version_id, delete_time is not null deleted from latest""",
    "upsert_runs": """
select job_run_id, job_id, job_start_time, job_end_time, job_run_duration, job_cleanup_duration,
  job_state__life_cycle_state, job_state__result_state
from runs""",
    "upsert_tasks": """
select task_run_id, task_job_run_id, task_key, task_start_time, task_end_time, task_execution_duration,
  task_cleanup_duration, task_original_attempt_run_id, task_state__result_state
from tasks""",
    "mark_missing": """
select job_id,
  case when job_id in (select job_id from discovered) or job_id in (7, 14, 21) then is_job_deleted
       else 'yes' end is_job_deleted
from jobs_norm""",
    "run_details": _details_sql(),
    "inventory": """
select job__tags__Team team, job__tags__Domain domain, job__tags__Priority priority, job__tags__Project project,
  count(*) n_jobs, count(distinct job__tags__Owner) n_owners
from jobs_norm where coalesce(is_job_deleted = 'yes', false) = false
group by all""",
    "top_failed_jobs": f"""
with c as (
  select job_id, count(*) failures from runs
  where job_start_time >= {_ms_lit(Q.FAIL_FROM)} and job_start_time < {_ms_lit(Q.FAIL_TO)}
    and job_state__result_state = 'FAILED'
  group by job_id),
d as (
  select c.job_id, c.failures, x.dimension, x.value
  from c join jobs_norm j on j.job_id = c.job_id,
  (values ('Team', j.job__tags__Team), ('Domain', j.job__tags__Domain),
          ('Project', j.job__tags__Project), ('Priority', j.job__tags__Priority)) x(dimension, value)
  where x.value is not null)
select * from (
  select job_id, failures, dimension, value,
    cast(rank() over (partition by dimension, value order by failures desc) as integer) rnk
  from d) q
where rnk <= {Q.TOP_K}""",
    "failure_trend": """
select cast(make_timestamp_ms(job_start_time) as date) "day", count(*) runs,
  count(*) filter (where job_state__result_state = 'FAILED') failures,
  count(*) filter (where job_state__result_state = 'FAILED') / count(*) failure_rate
from event_runs group by 1""",
    "recurring_errors": """
select e.task_error error, count(*) occurrences, count(distinct r.job_id) n_jobs,
  min(make_timestamp_ms(nullif(e.task_start_time, 0))) first_seen,
  max(make_timestamp_ms(nullif(e.task_start_time, 0))) last_seen
from enriched e join runs r on e.task_job_run_id = r.job_run_id join jobs_norm j on j.job_id = r.job_id
where e.task_error is not null
group by 1 having count(*) >= 2""",
    "long_running": """
with n as (select max(job_start_time) now from event_runs),
a as (
  select job_id, avg(case when coalesce(job_run_duration, 0) = 0 then null else job_run_duration end) avg_duration_ms
  from event_runs, n
  where job_state__life_cycle_state in ('TERMINATED', 'INTERNAL_ERROR')
    and job_start_time >= n.now - cast(30 as bigint) * 86400000 and job_start_time < n.now
  group by job_id)
select r.job_id, r.job_run_id, make_timestamp_ms(r.job_start_time) start_time, r.job_run_duration elapsed_ms,
  a.avg_duration_ms, coalesce(r.job_run_duration > 2.0 * a.avg_duration_ms, false) is_long
from event_runs r left join a on a.job_id = r.job_id
where r.job_state__life_cycle_state in ('PENDING', 'RUNNING', 'TERMINATING')""",
    "latest_status": """
select job_id, job_run_id, make_timestamp_ms(job_start_time) start_time,
  job_state__life_cycle_state life_cycle_state, job_state__result_state result_state
from event_runs
qualify row_number() over (partition by job_id order by job_start_time desc, job_run_id desc) = 1""",
    "standards_flags": """
select job_id,
  job__git_source__git_url is not null and job__schedule__quartz_cron_expression is not null scheduled_via_git,
  coalesce(not contains(run_as_user_name, '@'), false) runs_as_service_principal,
  on_failure_email is not null has_failure_alert,
  job__git_source__git_url is not null and job__schedule__quartz_cron_expression is not null
    and coalesce(not contains(run_as_user_name, '@'), false) and on_failure_email is not null meets_standards
from jobs""",
    "standards_summary": """
select count(*) jobs,
  count(*) filter (where job__git_source__git_url is not null and job__schedule__quartz_cron_expression is not null)
    scheduled_via_git,
  count(*) filter (where not contains(run_as_user_name, '@')) runs_as_service_principal,
  count(*) filter (where on_failure_email is not null) has_failure_alert,
  count(*) filter (where job__git_source__git_url is not null and job__schedule__quartz_cron_expression is not null
    and not contains(run_as_user_name, '@') and on_failure_email is not null) meets_standards
from jobs""",
    "sanity_counts": """
select (select count(*) from jobs) jobs, (select count(*) from runs) runs, (select count(*) from tasks) tasks,
  (select count(*) from jobs where job__tags__Team is null or job__tags__Type is null) jobs_missing_team_or_type,
  (select count(*) from tasks where task_job_run_id not in (select job_run_id from runs)) tasks_without_run,
  (select count(*) from runs where job_run_id not in (select task_job_run_id from tasks)) runs_without_tasks""",
    "plan_tags": """
select job_id, 'dry_run' status, key, old_value, new_value from (
  select job_id, 'Team' key, job__tags__Team old_value, 'BUILDING' new_value from jobs
  where job__tags__Team is distinct from 'BUILDING'
  union all
  select job_id, 'Project', job__tags__Project, 'Proj3' from jobs
  where job__tags__Project is distinct from 'Proj3') q""",
    "apply_tags": """
select job_id, 'BUILDING' team, job__tags__Type type, job__tags__Owner owner, job__tags__Domain domain,
  job__tags__Priority priority, 'Proj3' project
from jobs""",
    "tag_summary": """
select cast(0 as bigint) updated,
  count(*) filter (where job__tags__Team is distinct from 'BUILDING' or job__tags__Project is distinct from 'Proj3')
    dry_run,
  count(*) filter (where not (job__tags__Team is distinct from 'BUILDING'
    or job__tags__Project is distinct from 'Proj3')) no_change,
  cast(0 as bigint) errors
from jobs""",
    "load_jobs": f"""
select j.job_id,
  case when d.job_id is not null then 'no' when j.job_id in (7, 14, 21) then j.is_job_deleted else 'yes' end
    is_job_deleted,
  j.job__name, j.job__tags__Team, j.job__tags__Type, j.job__tags__Priority,
  case when d.job_id is not null and j.job__schedule__quartz_cron_expression is not null then 'UTC' end
    job__schedule__timezone_id,
  case when d.job_id is not null then 'https://{Q.HOST}/jobs/' || cast(j.job_id as varchar) end Job_link
from jobs_norm j left join (select distinct job_id from discovered) d on d.job_id = j.job_id""",
}

SQL["long_running_now"] = (
    SQL["long_running"].replace("r.job_run_duration elapsed_ms", "n.now - r.job_start_time elapsed_ms")
    .replace("r.job_run_duration > 2.0", "n.now - r.job_start_time > 2.0")
    .replace("from event_runs r left join a on", "from event_runs r cross join n left join a on"))

_NEW_RUNS = """
new_runs AS MATERIALIZED (
  select r.* from runs r join snap_starts s on s.job_id = r.job_id where r.job_start_time >= s.fetch_from),
snap AS MATERIALIZED (select * from snapshot),
runs_out AS (
  select s.* from snap s anti join new_runs n on n.job_run_id = s.job_run_id
  union all
  select job_run_id, job_id, job_start_time, job_end_time, job_run_duration, job_setup_duration,
    job_execution_duration, job_cleanup_duration, job_state__life_cycle_state, job_state__result_state
  from new_runs)
"""

SQL["incremental_runs"] = _NEW_RUNS.strip() + """
select job_run_id, job_id, job_start_time, job_end_time, job_run_duration, job_cleanup_duration,
  job_state__life_cycle_state, job_state__result_state
from runs_out"""
SQL["incremental_tasks"] = """
new_ids AS (
  select r.job_run_id from runs r join snap_starts s on s.job_id = r.job_id where r.job_start_time >= s.fetch_from),
oldest AS (
  select min(task_start_time) start from tasks
  where task_start_time <> 0 and task_job_run_id in (select job_run_id from new_ids)),
hit AS (
  select distinct task_job_run_id from tasks, oldest
  where task_start_time >= oldest.start and task_state__result_state in ('FAILED', 'TIMEDOUT', 'CANCELED'))
select t.task_run_id, t.task_job_run_id, t.task_start_time, t.task_state__result_state,
  case when n.job_run_id is not null and t.task_state__result_state = 'FAILED' then o.error end task_error,
  case when n.job_run_id is not null and t.task_state__result_state = 'FAILED'
      then coalesce(cast(o.original_attempt_run_id as bigint), t.task_original_attempt_run_id)
    when h.task_job_run_id is not null then coalesce(t.task_original_attempt_run_id, cast(o.original_attempt_run_id as bigint))
    else t.task_original_attempt_run_id end task_original_attempt_run_id
from tasks t left join new_ids n on n.job_run_id = t.task_job_run_id
  left join hit h on h.task_job_run_id = t.task_job_run_id
  left join run_outputs o on cast(o.run_id as bigint) = t.task_run_id
where n.job_run_id is not null or t.task_job_run_id in (select job_run_id from snapshot)"""

# every task with the output of its own, and the attempt ids of failed runs
_TOLD = """
select t.task_run_id, t.task_job_run_id, t.task_start_time, t.task_state__result_state,
  case when t.task_state__result_state = 'FAILED' then o.lost end task_notebook_output,
  case when t.task_state__result_state = 'FAILED' then coalesce(o.lost, o.error) end task_error,
  case when t.task_state__result_state = 'FAILED' then coalesce(o.lost, o.error_trace) end task_error_trace,
  case when t.task_state__result_state = 'FAILED' then coalesce(o.attempt, t.task_original_attempt_run_id)
    else t.task_original_attempt_run_id end task_original_attempt_run_id
from tasks t left join ({outputs}) o on o.task_run_id = t.task_run_id
where t.task_job_run_id in ({runs})"""
_FETCHED = ("select cast(run_id as bigint) task_run_id, error, error_trace, cast(original_attempt_run_id as bigint) attempt, "
            "cast(null as varchar) lost from run_outputs")
_LOST = ("select task_run_id, null, null, null, 'fetch failed ' || cast(task_run_id % 3 as varchar) from tasks "
         "where task_state__result_state = 'FAILED' and task_key = 'task7'")
SQL["incremental_in_place"] = _TOLD.format(outputs=_FETCHED, runs="""
  select job_run_id from snapshot union
  select r.job_run_id from runs r join (
    select job_id, coalesce(max(case when job_state__life_cycle_state in ('TERMINATED', 'INTERNAL_ERROR') then job_start_time end), 0) wm
    from snapshot group by job_id) w on w.job_id = r.job_id
  where r.job_start_time >= w.wm and r.job_id in (select job_id from snap_monitored) union
  select r.job_run_id from runs r
  where r.job_id in (select job_id from snap_monitored) and r.job_id not in (select job_id from snapshot)""")
SQL["stream_load"] = _TOLD.format(outputs=_FETCHED + " union all " + _LOST, runs="select job_run_id from runs")

SQL["top_failed_daily"] = SQL["top_failed_jobs"]
SQL["failure_trend_daily"] = SQL["failure_trend"].replace("event_runs", "runs")
SQL["recurring_errors_daily"] = SQL["recurring_errors"]
_TOOK = ("case when coalesce(job_run_duration, 0) = 0 then job_setup_duration + job_execution_duration + job_cleanup_duration "
         "else job_run_duration end")
SQL["long_running_daily"] = (SQL["long_running_now"].replace("event_runs", "runs")
                             .replace("case when coalesce(job_run_duration, 0) = 0 then null else job_run_duration end", _TOOK))
SQL["details_view"] = SQL["run_details"]
SQL["load_jobs_repeated"] = SQL["load_jobs"]

# every eleventh job without tags, ids -5 to -1 of no job; only absent keys are set
_UNTAGGED = """
untagged AS (
  select job_id, true as found, job_id % 11 = 0 as bare, case when job_id % 11 <> 0 then job__tags__Team end team,
    case when job_id % 11 <> 0 then job__tags__Type end type, case when job_id % 11 <> 0 then job__tags__Owner end owner,
    case when job_id % 11 <> 0 then job__tags__Domain end as domain, case when job_id % 11 <> 0 then job__tags__Priority end priority,
    case when job_id % 11 <> 0 then job__tags__Project end project
  from jobs
  union all
  select cast(i as bigint), false, false, null, null, null, null, null, null from range(-5, 0) r(i)),
planned AS (
  select *, found and team is null as set_team, found and project is null as set_project from untagged),
statused AS (
  select *, case when not found then 'error: job not found' when set_team or set_project then 'updated' else 'no_change' end
    status from planned)
"""
SQL["plan_tags_untagged"] = _UNTAGGED.strip() + """
select job_id, status, 'Team' as key, cast(null as varchar) old_value, 'BUILDING' new_value from statused where set_team
union all
select job_id, status, 'Project', null, 'Proj3' from statused where set_project
union all
select job_id, status, null, null, null from statused where not set_team and not set_project"""
SQL["apply_tags_untagged"] = _UNTAGGED.strip() + """
select job_id, case when set_team then 'BUILDING' else team end team, type, owner, "domain", priority,
  case when set_project then 'Proj3' else project end project
from statused where found"""
SQL["tag_summary_untagged"] = _UNTAGGED.strip() + """
select count(*) filter (where status = 'updated') updated, cast(0 as bigint) dry_run,
  count(*) filter (where status = 'no_change') no_change, count(*) filter (where starts_with(status, 'error')) errors
from statused"""

ORACLE: dict[str, str] = {}
for _k, _body in SQL.items():
    _b = _body.strip()
    if _b.startswith(("new_runs AS", "untagged AS", "new_ids AS")):
        ORACLE[_k] = "WITH " + FIXTURES.strip() + ",\n" + _b
    elif _b.lower().startswith("with "):
        ORACLE[_k] = "WITH " + FIXTURES.strip() + ",\n" + _b[5:]
    else:
        ORACLE[_k] = _with(_b)
