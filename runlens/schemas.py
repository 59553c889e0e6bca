"""Payload and table schemas, plus the fixed value sets of the data model.

Payloads are the nested documents a job scheduler returns for a job, a run
(with its tasks) and the output of a failed task. Tables are the flat forms
kept by this library: ``job_details`` (one row per job), ``job_run_details``
(one row per run) and ``task_run_details`` (one row per task run). A ``__`` in
a column name marks one level of nesting in the payload
(``job_state__result_state`` = ``state.result_state``).

Times and durations are epoch milliseconds (``long``) in all tables.
"""

from __future__ import annotations

from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# Fixed values. These must stay as they are for results to match.
#   life-cycle states of a run still in flight: PENDING, RUNNING, TERMINATING
#   life-cycle states of a finished run: TERMINATED, INTERNAL_ERROR
#   task results that need failure output: FAILED
#   task results whose runs get original attempt ids: FAILED, TIMEDOUT, CANCELED
#   tag keys every job carries: Team, Type, Owner, Domain, Priority, Project
#   tag key kept upper case (all others lower case): Priority
#   job deleted flag values: yes, no
# ---------------------------------------------------------------------------
IN_FLIGHT_STATES = ("PENDING", "RUNNING", "TERMINATING")
TERMINAL_STATES = ("TERMINATED", "INTERNAL_ERROR")
OUTPUT_RESULTS = ("FAILED",)
BACKFILL_RESULTS = ("FAILED", "TIMEDOUT", "CANCELED")
REQUIRED_TAG_KEYS = ("Team", "Type", "Owner", "Domain", "Priority", "Project")
UPPER_TAG_KEYS = ("Priority",)
DELETED_YES = "yes"
DELETED_NO = "no"

S = T.StringType()
L = T.LongType()
STR_MAP = T.MapType(S, S)
LONG_MAP = T.MapType(S, L)
STR_MAP_LIST = T.ArrayType(STR_MAP)


def struct_of(*fields: tuple[str, T.DataType]) -> T.StructType:
    """A StructType of nullable fields from (name, type) pairs."""
    return T.StructType([T.StructField(n, t, True) for n, t in fields])



STATE = struct_of(
    ("life_cycle_state", S),
    ("result_state", S),
    ("state_message", S),
    ("user_cancelled_or_timedout", S),
)

# Values that are nested objects in a payload but typed as string maps here
# (sql_task, pipeline_task, notebook_task, cluster_instance) arrive as JSON
# text, so one odd value never nulls the whole field.
TASK_PAYLOAD = struct_of(
    ("run_id", L),
    ("task_key", S),
    ("attempt_number", L),
    ("run_if", S),
    ("start_time", L),
    ("end_time", L),
    ("setup_duration", L),
    ("execution_duration", L),
    ("cleanup_duration", L),
    ("queue_duration", L),
    ("original_attempt_run_id", L),
    ("description", S),
    ("existing_cluster_id", S),
    ("notebook_output", S),
    ("error", S),
    ("error_trace", S),
    ("state", STATE),
    ("cluster_instance", STR_MAP),
    ("git_source", STR_MAP),
    ("notebook_task", STR_MAP),
    ("condition_task", STR_MAP),
    ("sql_task", STR_MAP),
    ("pipeline_task", STR_MAP),
    ("depends_on", STR_MAP_LIST),
    ("libraries", STR_MAP_LIST),
)

RUN_PAYLOAD = struct_of(
    ("job_id", L),
    ("run_id", L),
    ("run_name", S),
    ("run_page_url", S),
    ("run_type", S),
    ("number_in_job", L),
    ("original_attempt_run_id", L),
    ("creator_user_name", S),
    ("start_time", L),
    ("end_time", L),
    ("setup_duration", L),
    ("execution_duration", L),
    ("cleanup_duration", L),
    ("run_duration", L),
    ("trigger", S),
    ("trigger_info", S),                 # JSON text: its form varies; see flatten.flatten_runs
    ("schedule", STR_MAP),
    ("job_clusters", STR_MAP_LIST),
    ("job_parameters", STR_MAP_LIST),
    ("overriding_parameters", S),        # JSON text
    ("state", STATE),
    ("tasks", T.ArrayType(TASK_PAYLOAD)),
)

JOB_PAYLOAD = struct_of(
    ("job_id", L),
    ("created_time", L),
    ("creator_user_name", S),
    ("run_as_user_name", S),
    (
        "settings",
        struct_of(
            ("name", S),
            ("timeout_seconds", L),
            ("tags", STR_MAP),
            (
                "schedule",
                struct_of(("pause_status", S), ("quartz_cron_expression", S), ("timezone_id", S)),
            ),
            ("git_source", struct_of(("git_branch", S), ("git_provider", S), ("git_url", S))),
            (
                "email_notifications",
                struct_of(("on_failure", T.ArrayType(S)), ("on_success", T.ArrayType(S))),
            ),
            ("job_clusters", STR_MAP_LIST),
        ),
    ),
)

OUTPUT_PAYLOAD = struct_of(
    ("metadata", struct_of(("run_id", S), ("original_attempt_run_id", S))),
    ("notebook_output", S),
    ("error", S),
    ("error_trace", S),
    ("fetch_error", S),                  # landed in place of an output that could not be fetched
)

# The six keys of a task kept inside a run row (``job_tasks``).
RUN_TASK_KEYS = (
    "cleanup_duration",
    "end_time",
    "execution_duration",
    "run_id",
    "setup_duration",
    "start_time",
)

# Column order of the run table: (column, payload path, type).
RUN_COLUMNS: tuple[tuple[str, str, T.DataType], ...] = (
    ("job_cleanup_duration", "cleanup_duration", L),
    ("job_creator_user_name", "creator_user_name", S),
    ("job_end_time", "end_time", L),
    ("job_execution_duration", "execution_duration", L),
    ("job_id", "job_id", L),
    ("job_job_clusters", "job_clusters", STR_MAP_LIST),
    ("job_job_parameters", "job_parameters", STR_MAP_LIST),
    ("job_number_in_job", "number_in_job", L),
    ("job_original_attempt_run_id", "original_attempt_run_id", L),
    ("job_overriding_parameters", "overriding_parameters", T.MapType(S, STR_MAP)),
    ("job_run_duration", "run_duration", L),
    ("job_run_id", "run_id", L),
    ("job_run_name", "run_name", S),
    ("job_run_page_url", "run_page_url", S),
    ("job_run_type", "run_type", S),
    ("job_schedule", "schedule", STR_MAP),
    ("job_setup_duration", "setup_duration", L),
    ("job_start_time", "start_time", L),
    ("job_state__life_cycle_state", "state.life_cycle_state", S),
    ("job_state__result_state", "state.result_state", S),
    ("job_state__state_message", "state.state_message", S),
    ("job_state__user_cancelled_or_timedout", "state.user_cancelled_or_timedout", S),
    ("job_tasks", "tasks", T.ArrayType(LONG_MAP)),
    ("job_trigger", "trigger", S),
    ("job_trigger_info", "trigger_info", LONG_MAP),
)

# Column order of the task table: (column, payload path, type). The path
# ``job_run_id`` is the enclosing run's id; ``run_job_task`` is always NULL.
TASK_COLUMNS: tuple[tuple[str, str | None, T.DataType], ...] = (
    ("task_attempt_number", "attempt_number", L),
    ("task_cleanup_duration", "cleanup_duration", L),
    ("task_cluster_instance", "cluster_instance", STR_MAP),
    ("task_end_time", "end_time", L),
    ("task_execution_duration", "execution_duration", L),
    ("task_git_source", "git_source", STR_MAP),
    ("task_job_run_id", "job_run_id", L),
    ("task_notebook_task", "notebook_task", STR_MAP),
    ("task_run_id", "run_id", L),
    ("task_run_if", "run_if", S),
    ("task_setup_duration", "setup_duration", L),
    ("task_start_time", "start_time", L),
    ("task_key", "task_key", S),
    ("task_existing_cluster_id", "existing_cluster_id", S),
    ("task_depends_on", "depends_on", STR_MAP_LIST),
    ("task_libraries", "libraries", STR_MAP_LIST),
    ("task_description", "description", S),
    ("task_state__life_cycle_state", "state.life_cycle_state", S),
    ("task_state__user_cancelled_or_timedout", "state.user_cancelled_or_timedout", S),
    ("task_state__result_state", "state.result_state", S),
    ("task_state__state_message", "state.state_message", S),
    ("task_notebook_output", "notebook_output", S),
    ("task_error", "error", S),
    ("task_error_trace", "error_trace", S),
    ("task_sql_task", "sql_task", STR_MAP),
    ("task_original_attempt_run_id", "original_attempt_run_id", L),
    ("task_condition_task", "condition_task", STR_MAP),
    ("task_run_job_task", None, LONG_MAP),
    ("task_queue_duration", "queue_duration", L),
    ("task_pipeline_task", "pipeline_task", STR_MAP),
)


def tag_keys(additional: tuple[str, ...] | list[str] = ()) -> list[str]:
    """Allowed tag keys: the required six plus any additional, sorted."""
    return sorted(set(REQUIRED_TAG_KEYS) | set(additional))


def tag_column(key: str) -> str:
    return f"job__tags__{key}"


def job_columns(keys: list[str] | None = None) -> list[tuple[str, str | None, T.DataType]]:
    """Column order of the job table: (column, payload path, type).

    One ``job__tags__{Key}`` string column per allowed key, in sorted order,
    sits between the schedule and the timeout columns. ``is_job_deleted`` and
    ``Job_link`` have no payload path; they are computed.
    """
    keys = tag_keys() if keys is None else sorted(keys)
    head = [
        ("job_id", "job_id", L),
        ("created_time", "created_time", L),
        ("creator_user_name", "creator_user_name", S),
        ("run_as_user_name", "run_as_user_name", S),
        ("is_job_deleted", None, S),
        ("job__name", "settings.name", S),
        ("job__schedule__pause_status", "settings.schedule.pause_status", S),
        ("job__schedule__quartz_cron_expression", "settings.schedule.quartz_cron_expression", S),
        ("job__schedule__timezone_id", "settings.schedule.timezone_id", S),
    ]
    tags = [(tag_column(k), f"settings.tags.{k}", S) for k in keys]
    tail = [
        ("job__timeout_seconds", "settings.timeout_seconds", L),
        ("job__git_source__git_branch", "settings.git_source.git_branch", S),
        ("job__git_source__git_provider", "settings.git_source.git_provider", S),
        ("job__git_source__git_url", "settings.git_source.git_url", S),
        ("job__email_notifications__on_failure", "settings.email_notifications.on_failure", T.ArrayType(S)),
        ("job__email_notifications__on_success", "settings.email_notifications.on_success", T.ArrayType(S)),
        ("job__job_clusters", "settings.job_clusters", STR_MAP_LIST),
        ("Job_link", None, S),
    ]
    return head + tags + tail


def table_schema(columns) -> T.StructType:
    return T.StructType([T.StructField(c, t, True) for c, _, t in columns])


RUN_SCHEMA = table_schema(RUN_COLUMNS)
TASK_SCHEMA = table_schema(TASK_COLUMNS)


def job_schema(keys: list[str] | None = None) -> T.StructType:
    return table_schema(job_columns(keys))
