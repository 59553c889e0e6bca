"""Telemetry tables derived from the shared TPC-H-like tables.

The mapping (``FIXTURES.md`` §2) turns customers into jobs, orders into job
versions and runs, line items into task runs and events into a dense 30-day
run history. Every function reads whole tables; the payload builders nest the
flat rows back into scheduler documents so parsing runs at full size.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from runlens import schemas
from runlens.functions import epoch_ms


def _read(spark: SparkSession, sf_dir: str, name: str, *cols: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet").select(*cols)


def _type_tag() -> Column:
    return F.when(F.col("c_nationkey") % 2 == 0, F.lit("PROD")).otherwise(F.lit(" dev "))


def _price_ms() -> Column:
    return F.round(F.col("o_totalprice") * 10).cast("long")


def job_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Version history: one row per order, as a change of the customer's job.
    ``tags`` is a map like the scheduler's; a finished order deletes the job
    at that version."""
    orders = _read(spark, sf_dir, "orders", "o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate")
    cust = _read(spark, sf_dir, "customer", "c_custkey", "c_name", "c_nationkey", "c_mktsegment")
    return orders.join(cust, orders.o_custkey == cust.c_custkey).select(
        F.col("c_nationkey").cast("string").alias("workspace_id"),
        F.col("o_custkey").alias("job_id"),
        F.col("c_name").alias("name"),
        F.create_map(F.lit("Team"), F.col("c_mktsegment"), F.lit("Type"), _type_tag()).alias("tags"),
        F.col("o_orderdate").alias("change_time"),
        F.col("o_orderkey").alias("version_id"),
        F.when(F.col("o_orderstatus") == "F", F.col("o_orderdate")).alias("delete_time"),
    )


def jobs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flat job rows (the ``job_details`` shape, tags not yet normalised)."""
    c = _read(spark, sf_dir, "customer", "c_custkey", "c_name", "c_nationkey", "c_mktsegment")
    key, nat = F.col("c_custkey"), F.col("c_nationkey")
    user = F.concat(F.lit("user"), nat.cast("string"), F.lit("@example.com"))
    return c.select(
        key.alias("job_id"),
        ((key % 10).cast("long") * 86400000).alias("created_time"),
        user.alias("creator_user_name"),
        F.when(key % 4 == 0, F.concat(F.lit("sp-"), nat.cast("string"))).otherwise(user).alias("run_as_user_name"),
        F.when(key % 17 == 0, F.lit("yes")).otherwise(F.lit("no")).alias("is_job_deleted"),
        F.col("c_name").alias("job__name"),
        F.when(key % 5 != 0, F.lit("0 0 * * * ?")).alias("job__schedule__quartz_cron_expression"),
        F.when(key % 3 != 0, F.lit("https://git.example.com/r")).alias("job__git_source__git_url"),
        F.when(key % 7 != 0, F.array(F.lit("oncall@example.com"))).alias("job__email_notifications__on_failure"),
        F.col("c_mktsegment").alias("job__tags__Team"),
        _type_tag().alias("job__tags__Type"),
        F.concat(F.lit("Owner"), nat.cast("string")).alias("job__tags__Owner"),
        F.concat(F.lit("Domain"), (nat % 5).cast("string")).alias("job__tags__Domain"),
        F.concat(F.lit(" p"), (key % 4 + 1).cast("string")).alias("job__tags__Priority"),
        F.when(key % 6 != 0, F.concat(F.lit("Proj"), (key % 9).cast("string"))).alias("job__tags__Project"),
    )


def tags_map(keys=schemas.REQUIRED_TAG_KEYS) -> Column:
    """The ``job__tags__*`` columns of a flat job row as one map; a NULL tag
    is an absent key."""
    entries = F.array(*[F.struct(F.lit(k).alias("key"), F.col(schemas.tag_column(k)).alias("value"))
                        for k in keys])
    return F.map_from_entries(F.filter(entries, lambda e: e["value"].isNotNull()))


def job_tags(jobs_df: DataFrame, keys=schemas.REQUIRED_TAG_KEYS) -> DataFrame:
    """(job_id, tags map) from flat jobs."""
    return jobs_df.select("job_id", tags_map(keys).alias("tags"))


def runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flat run rows (the subset of ``job_run_details`` the tables carry)."""
    o = _read(spark, sf_dir, "orders", "o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate")
    start = epoch_ms("o_orderdate")
    pending = F.col("o_orderstatus") == "P"
    return o.select(
        F.col("o_orderkey").alias("job_run_id"),
        F.col("o_custkey").alias("job_id"),
        start.alias("job_start_time"),
        F.when(pending, F.lit(0).cast("long")).otherwise(start + _price_ms()).alias("job_end_time"),
        F.when(F.col("o_orderkey") % 3 == 0, F.lit(0).cast("long")).otherwise(_price_ms()).alias("job_run_duration"),
        (F.col("o_orderkey") % 5000).cast("long").alias("job_setup_duration"),
        _price_ms().alias("job_execution_duration"),
        F.when(F.col("o_orderkey") % 11 == 0, F.lit(None).cast("long"))
         .otherwise(F.lit(700).cast("long")).alias("job_cleanup_duration"),
        F.when(pending, F.lit("RUNNING")).otherwise(F.lit("TERMINATED")).alias("job_state__life_cycle_state"),
        F.when(F.col("o_orderstatus") == "F", F.lit("FAILED"))
         .when(F.col("o_orderstatus") == "O", F.lit("SUCCESS")).alias("job_state__result_state"),
    )


TASK_ORDER = ("task_start_time", "l_partkey", "l_suppkey", "l_extendedprice")


LINE_COLUMNS = ("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_returnflag",
                "l_shipdate")


def _task_run_id() -> Column:
    return F.col("l_orderkey") * 10 + F.col("l_linenumber")


def _task_columns(start: Column | None = None) -> list[Column]:
    """Flat task columns of a line item (``start``: its start where that is made already)."""
    start = epoch_ms("l_shipdate") if start is None else start
    run_id = _task_run_id()
    qty_ms = (F.col("l_quantity") * 1000).cast("long")
    return [
        F.col("l_orderkey").alias("task_job_run_id"),
        run_id.alias("task_run_id"),
        start.alias("task_start_time"),
        (start + qty_ms).alias("task_end_time"),
        (F.col("l_linenumber") * 100).cast("long").alias("task_setup_duration"),
        qty_ms.alias("task_execution_duration"),
        (F.col("l_suppkey") % 50).cast("long").alias("task_cleanup_duration"),
        F.concat(F.lit("task"), F.col("l_linenumber").cast("string")).alias("task_key"),
        F.when(F.col("l_partkey") % 3 == 0, run_id).alias("task_original_attempt_run_id"),
        F.when(F.col("l_returnflag") == "R", F.lit("FAILED"))
         .when(F.col("l_returnflag") == "A", F.lit("SUCCESS"))
         .otherwise(F.lit("CANCELED")).alias("task_state__result_state"),
    ]


def tasks_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Task rows with repeats: one per line item, so a (order, line) key may
    come several times. The ``l_*`` columns break ties when the newest row
    per key is kept (``TASK_ORDER``, all descending)."""
    return _read(spark, sf_dir, "lineitem", *LINE_COLUMNS).select(*_task_columns(), "l_partkey", "l_suppkey", "l_extendedprice")


def tasks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per task run: the newest line item per key. Line items go
    through the shuffle as they are; the task columns are made after it."""
    from runlens.operators.upsert import latest_per_key

    lines = _read(spark, sf_dir, "lineitem", *LINE_COLUMNS).withColumns(
        {"task_run_id": _task_run_id(), "task_start_time": epoch_ms("l_shipdate")})
    newest = latest_per_key(lines, ["task_run_id"], [F.col(c).desc() for c in TASK_ORDER])
    return newest.select(*_task_columns(F.col("task_start_time")))


def run_outputs(tasks_df: DataFrame) -> DataFrame:
    """Outputs of failed tasks as the scheduler returns them (ids as text).
    Tasks with key ``task7`` have no output (a fetch that failed)."""
    rid = F.col("task_run_id")
    return tasks_df.where((F.col("task_state__result_state") == "FAILED") & (F.col("task_key") != "task7")).select(
        rid.cast("string").alias("run_id"),
        F.concat(F.lit("error "), (rid % 7).cast("string")).alias("error"),
        F.concat(F.lit("trace "), (rid % 5).cast("string")).alias("error_trace"),
        F.when(rid % 2 == 0, (rid - 1).cast("string")).alias("original_attempt_run_id"),
    )


def output_documents(tasks_df: DataFrame) -> DataFrame:
    """The same as documents (``OUTPUT_PAYLOAD``); where the fetch failed its
    error text lands instead."""
    rid = F.col("task_run_id")
    good = run_outputs(tasks_df).select(
        F.struct("run_id", "original_attempt_run_id").alias("metadata"), "error", "error_trace")
    lost = tasks_df.where((F.col("task_state__result_state") == "FAILED") & (F.col("task_key") == "task7")).select(
        F.struct(rid.cast("string").alias("run_id")).alias("metadata"),
        F.concat(F.lit("fetch failed "), (rid % 3).cast("string")).alias("fetch_error"))
    return good.select(F.to_json(F.struct("metadata", "error", "error_trace")).alias("value")).unionByName(
        lost.select(F.to_json(F.struct("metadata", "fetch_error")).alias("value")))


def land_stream(spark: SparkSession, sf_dir: str) -> tuple[str, str, int]:
    """Folders of run payloads (three groups of files) and output documents
    (two) as a scheduler would land them, and the files in a group (one, as
    long as it holds no more than ``FILE_ROWS`` documents or so); an output
    may come files before or after its run."""
    import os

    runs = land(spark, sf_dir, "run_payloads")
    base = os.path.dirname(runs)
    to_runs, to_outs = os.path.join(base, "stream_runs"), os.path.join(base, "stream_outputs")
    with _LAND_LOCK:
        if base not in _STREAMS:
            L = Landed(spark, sf_dir)
            group = 1 + L.runs.count() // (3 * FILE_ROWS)
            (spark.read.text(runs).repartition(3 * group, F.get_json_object("value", "$.run_id"))
             .write.mode("overwrite").option("compression", "gzip").text(to_runs))
            (output_documents(L.tasks).repartition(2 * group, F.get_json_object("value", "$.metadata.run_id"))
             .write.mode("overwrite").option("compression", "gzip").text(to_outs))
            _STREAMS[base] = group
        return to_runs, to_outs, _STREAMS[base]


def event_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dense 30-day run history in the run-table shape: one run per event.
    Sign-ups are runs still going (their duration is the time so far),
    errors failed, the rest succeeded."""
    e = _read(spark, sf_dir, "events", "event_id", "user_id", "ts", "event_type", "value")
    running = F.col("event_type") == "signup"
    return e.select(
        F.col("event_id").alias("job_run_id"),
        F.col("user_id").alias("job_id"),
        epoch_ms("ts").alias("job_start_time"),
        F.round(F.col("value") * 1000).cast("long").alias("job_run_duration"),
        F.when(running, F.lit("RUNNING")).otherwise(F.lit("TERMINATED")).alias("job_state__life_cycle_state"),
        F.when(F.col("event_type") == "error", F.lit("FAILED"))
         .when(~running, F.lit("SUCCESS")).alias("job_state__result_state"),
    )


def runs_snapshot(runs_df: DataFrame, cut, band) -> DataFrame:
    """The run table as an earlier load left it: runs started before
    ``cut``; those started from ``band`` on were still running then."""
    from runlens.functions import ms_of

    start = F.col("job_start_time")
    busy = start >= ms_of(band)
    cols = []
    for c in runs_df.columns:
        if c == "job_state__life_cycle_state":
            cols.append(F.when(busy, F.lit("RUNNING")).otherwise(F.col(c)).alias(c))
        elif c == "job_state__result_state":
            cols.append(F.when(busy, F.lit(None).cast("string")).otherwise(F.col(c)).alias(c))
        elif c == "job_end_time":
            cols.append(F.when(busy, F.lit(0).cast("long")).otherwise(F.col(c)).alias(c))
        else:
            cols.append(F.col(c))
    return runs_df.where(start < ms_of(cut)).select(*cols)


# --- payload builders: flat rows back to nested scheduler documents ---------

# Payload fields that the flat tables lack, from the ids they have. Objects
# within string maps (a library's package) land as JSON text.
RUN_FIELDS = {
    "run_name": "concat('run ', job_run_id % 13)",
    "run_page_url": "concat('https://jobs.example.com/run/', job_run_id)",
    "run_type": "if(job_run_id % 2 = 0, 'JOB_RUN', 'SUBMIT_RUN')",
    "number_in_job": "job_run_id % 100",
    "original_attempt_run_id": "job_run_id",
    "creator_user_name": "concat('user', job_run_id % 7)",
    "trigger": "if(job_run_id % 3 = 0, 'PERIODIC', 'ONE_TIME')",
    "trigger_info": "if(job_run_id % 6 = 0, named_struct('run_id', job_run_id), null)",
    "schedule": "if(job_run_id % 3 = 0, map('quartz_cron_expression', '0 0 * * * ?', 'timezone_id', 'UTC'), null)",
    "job_clusters": "array(map('job_cluster_key', concat('c', job_run_id % 3)))",
    "job_parameters": "if(job_run_id % 4 <> 0, array(map('name', 'p', 'value', string(job_run_id % 5))), null)",
    "overriding_parameters": "if(job_run_id % 5 = 0, named_struct('notebook_params', named_struct('k', string(job_run_id % 9))), null)",
}
STATE_FIELDS = {
    "state_message": "concat('message ', {id} % 4)",
    "user_cancelled_or_timedout": "if({id} % 8 = 0, 'true', 'false')",
}
# of a task: the flat row is ``t``
TASK_FIELDS = {
    "attempt_number": "t.task_run_id % 3",
    "run_if": "if(t.task_run_id % 2 = 0, 'ALL_SUCCESS', 'ALL_DONE')",
    "queue_duration": "t.task_run_id % 1000",
    "description": "if(t.task_run_id % 5 <> 0, concat('step ', t.task_run_id % 5), null)",
    "existing_cluster_id": "if(t.task_run_id % 4 = 0, concat('cl-', t.task_run_id % 6), null)",
    "cluster_instance": "map('cluster_id', concat('cl-', t.task_run_id % 6), 'spark_context_id', string(t.task_run_id % 11))",
    "git_source": "if(t.task_run_id % 3 = 0, map('git_url', 'https://git.example.com/r', 'git_branch', 'main'), null)",
    "sql_task": "if(t.task_run_id % 7 = 0, map('warehouse_id', concat('w', t.task_run_id % 4)), null)",
    "pipeline_task": "if(t.task_run_id % 9 = 0, map('pipeline_id', concat('p', t.task_run_id % 4)), null)",
    "condition_task": "if(t.task_run_id % 10 = 0, map('op', 'EQUAL_TO', 'left', string(t.task_run_id % 2)), null)",
    "depends_on": "if(t.task_key <> 'task1', array(map('task_key', 'task1')), null)",
    "libraries": "if(t.task_run_id % 6 = 0, array(named_struct('pypi', named_struct('package', concat('lib', t.task_run_id % 4)))), null)",
}


def _fields(exprs: dict[str, str]) -> list[Column]:
    return [F.expr(e).alias(c) for c, e in exprs.items()]


def _state(life: Column, result: Column, id_col: str) -> Column:
    extra = {c: e.format(id=id_col) for c, e in STATE_FIELDS.items()}
    return F.struct(life.alias("life_cycle_state"), result.alias("result_state"), *_fields(extra)).alias("state")


def job_payloads(jobs_df: DataFrame) -> DataFrame:
    """One JSON document per job (column ``payload``). Tags carry two keys
    that are not kept (``CostCenter`` and lower-case ``team``)."""
    tags = F.map_concat(
        tags_map(),
        F.create_map(F.lit("CostCenter"), F.lit("cc-1"), F.lit("team"), F.lit("x")),
    )
    settings = F.struct(
        F.col("job__name").alias("name"),
        F.lit(3600).cast("long").alias("timeout_seconds"),
        tags.alias("tags"),
        F.when(F.col("job__schedule__quartz_cron_expression").isNotNull(), F.struct(
            F.lit("UNPAUSED").alias("pause_status"),
            F.col("job__schedule__quartz_cron_expression").alias("quartz_cron_expression"),
            F.lit("UTC").alias("timezone_id"),
        )).alias("schedule"),
        F.when(F.col("job__git_source__git_url").isNotNull(), F.struct(
            F.lit("main").alias("git_branch"),
            F.lit("gitHub").alias("git_provider"),
            F.col("job__git_source__git_url").alias("git_url"),
        )).alias("git_source"),
        F.struct(F.col("job__email_notifications__on_failure").alias("on_failure"),
                 F.expr("if(job_id % 8 = 0, array('ok@example.com'), null)").alias("on_success")).alias("email_notifications"),
        F.expr("if(job_id % 9 = 0, array(map('job_cluster_key', 'main')), null)").alias("job_clusters"),
    )
    doc = F.struct(
        "job_id", "created_time", "creator_user_name", "run_as_user_name", settings.alias("settings"),
    )
    return jobs_df.select("job_id", F.to_json(doc).alias("payload"))


#: What a task document needs of a flat task row: names by payload field.
TASK_SOURCE = {"run_id": "task_run_id", "task_key": "task_key", "start_time": "task_start_time", "end_time": "task_end_time",
               "setup_duration": "task_setup_duration", "execution_duration": "task_execution_duration",
               "cleanup_duration": "task_cleanup_duration", "original_attempt_run_id": "task_original_attempt_run_id"}


def task_documents(tasks: str) -> Column:
    """Task documents (payload field names) from an array of flat task rows."""
    def struct(fields: dict[str, str]) -> str:
        return "named_struct(" + ", ".join(f"'{name}', {e}" for name, e in fields.items()) + ")"

    state = struct({"life_cycle_state": "'TERMINATED'", "result_state": "t.task_state__result_state",
                    **{c: e.format(id="t.task_run_id") for c, e in STATE_FIELDS.items()}})
    doc = struct({**{name: f"t.{c}" for name, c in TASK_SOURCE.items()}, "state": state, **TASK_FIELDS,
                  "notebook_task": "map('notebook_path', '/w/nb', 'base_parameters', '{}')"})
    return F.expr(f"transform({tasks}, t -> {doc})")


def run_payloads(runs_df: DataFrame, tasks_df: DataFrame) -> DataFrame:
    """One JSON document per run (column ``payload``) with its tasks.

    Tasks are grouped per run; a run's task list is bounded by the
    scheduler's limit on tasks per job (here at most seven), so the list is
    small whatever the table size. Runs without tasks have no ``tasks`` key.
    Flat rows go through the shuffle; documents are made of them after it,
    and so are the lists: before it nearly every run of a task's input is
    another one, and lists of all of them would be sorted and spilled.
    """
    flat = F.struct(*TASK_SOURCE.values(), "task_state__result_state")
    per_run = (tasks_df.withColumnRenamed("task_job_run_id", "job_run_id").repartition("job_run_id").groupBy("job_run_id")
               .agg(F.array_sort(F.collect_list(flat)).alias("_tasks")))
    r = runs_df.join(per_run, "job_run_id", "left")
    doc = F.struct(
        F.col("job_id"),
        F.col("job_run_id").alias("run_id"),
        F.col("job_start_time").alias("start_time"),
        F.col("job_end_time").alias("end_time"),
        F.col("job_setup_duration").alias("setup_duration"),
        F.col("job_execution_duration").alias("execution_duration"),
        F.col("job_cleanup_duration").alias("cleanup_duration"),
        F.col("job_run_duration").alias("run_duration"),
        _state(F.col("job_state__life_cycle_state"), F.col("job_state__result_state"), "job_run_id"),
        *_fields(RUN_FIELDS),
        task_documents("_tasks").alias("tasks"),
    )
    return r.select("job_run_id", "job_id", F.to_json(doc).alias("payload"))


# --- landed tables: the derived telemetry written once per session ----------

_TABLES = ("versions", "jobs", "runs", "tasks", "outputs", "event_runs")     # parquet
_DOCUMENTS = {"job_payloads": schemas.JOB_PAYLOAD, "run_payloads": schemas.RUN_PAYLOAD}     # JSON lines, compressed
LANDED = (*_TABLES, *_DOCUMENTS)
#: Documents of a file, at most (of the stream's: about). A compressed file is read by one task.
FILE_ROWS = 100_000

_LANDED: dict[tuple[str, str, str], str] = {}
_STREAMS: dict[str, int] = {}
_LAND_LOCK = __import__("threading").RLock()


class Landed:
    """The landed telemetry of ``sf_dir``, by attribute; each table is written
    on its first use:

    ``versions`` (job version history), ``jobs`` (flat, tags as given), ``runs``
    (flat), ``tasks`` (flat, one per key), ``outputs`` (of failed tasks),
    ``event_runs`` (dense run history), ``job_payloads`` and ``run_payloads``
    (documents read from JSON-lines files).
    """

    def __init__(self, spark: SparkSession, sf_dir: str):
        self._spark, self._sf_dir = spark, sf_dir

    def __getattr__(self, name: str) -> DataFrame:
        from runlens.sources.payloads import read_json_payloads

        if name in _DOCUMENTS:
            return read_json_payloads(self._spark, land(self._spark, self._sf_dir, name), _DOCUMENTS[name])
        if name in _TABLES:
            return self._spark.read.parquet(land(self._spark, self._sf_dir, name))
        raise AttributeError(name)


def land(spark: SparkSession, sf_dir: str, name: str) -> str:
    """Write a derived table of ``sf_dir`` below the shared checkpoint folder
    (once per session and input folder) and return its folder."""
    import os

    from runlens.session import app_id

    key = (app_id(spark), os.path.abspath(sf_dir), name)
    with _LAND_LOCK:                     # queries of one session may start together
        if key not in _LANDED:
            _LANDED[key] = _land(spark, sf_dir, key)
        return _LANDED[key]


def _land(spark: SparkSession, sf_dir: str, key: tuple[str, str, str]) -> str:
    import hashlib
    import os

    from runlens.session import checkpoint_dir

    tag = hashlib.sha1(key[1].encode()).hexdigest()[:10]
    path = os.path.join(checkpoint_dir(spark), "runlens-landed", key[0], tag, key[2])
    made = {"versions": job_versions, "jobs": jobs, "runs": runs, "tasks": tasks, "event_runs": event_runs}
    L = Landed(spark, sf_dir)
    if key[2] in _DOCUMENTS:
        docs = job_payloads(L.jobs) if key[2] == "job_payloads" else run_payloads(L.runs, L.tasks)
        (docs.select("payload").write.mode("overwrite").option("compression", "gzip").option("maxRecordsPerFile", FILE_ROWS)
         .text(path))
    else:
        df = run_outputs(L.tasks) if key[2] == "outputs" else made[key[2]](spark, sf_dir)
        df.write.mode("overwrite").option("compression", "zstd").parquet(path)
    return path


def landed(spark: SparkSession, sf_dir: str) -> Landed:
    """The landed telemetry of ``sf_dir`` (each table written on first use)."""
    return Landed(spark, sf_dir)
