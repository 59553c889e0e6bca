import json

from conftest import rows
from runlens import schemas
from runlens.operators import flatten as FL
from runlens.sources import payloads as PL


def parse(spark, docs, schema):
    df = spark.createDataFrame([(json.dumps(d) if isinstance(d, dict) else d,) for d in docs], "payload string")
    return PL.split_bad(PL.parse_json(df, "payload", schema))


JOB_FULL = {
    "job_id": 11, "created_time": 1000, "creator_user_name": "a@x.com", "run_as_user_name": "sp-1",
    "settings": {
        "name": "nightly", "timeout_seconds": 60,
        "tags": {"Team": "Data", "Type": "PROD", "CostCenter": "c1", "team": "lower"},
        "schedule": {"pause_status": "UNPAUSED", "quartz_cron_expression": "0 0 * * * ?", "timezone_id": "UTC"},
        "git_source": {"git_branch": "main", "git_provider": "gitHub", "git_url": "https://g/r"},
        "email_notifications": {"on_failure": ["a@x.com"], "on_success": []},
        "job_clusters": [{"job_cluster_key": "c", "new_cluster": {"num_workers": 2}}],
    },
}
JOB_BARE = {"job_id": 12, "settings": {"name": "bare"}}


def test_flatten_jobs_paths_tags_and_missing_parts(spark):
    good, bad = parse(spark, [JOB_FULL, JOB_BARE, "{not json"], schemas.JOB_PAYLOAD)
    assert bad.count() == 1
    out = FL.flatten_jobs(good, host="h.example")
    cols = out.columns
    tag_cols = [c for c in cols if c.startswith("job__tags__")]
    assert tag_cols == [f"job__tags__{k}" for k in sorted(schemas.REQUIRED_TAG_KEYS)]
    assert cols[:9] == ["job_id", "created_time", "creator_user_name", "run_as_user_name", "is_job_deleted",
                        "job__name", "job__schedule__pause_status", "job__schedule__quartz_cron_expression",
                        "job__schedule__timezone_id"]
    assert cols[-1] == "Job_link"
    r = {x["job_id"]: x for x in out.collect()}
    assert r[11]["job__tags__Team"] == "Data" and r[11]["job__tags__Owner"] is None
    assert r[11]["job__schedule__timezone_id"] == "UTC"
    assert r[11]["job__email_notifications__on_failure"] == ["a@x.com"]
    assert r[11]["job__job_clusters"][0]["new_cluster"] == '{"num_workers":2}'   # nested value as JSON text
    assert r[11]["Job_link"] == "https://h.example/jobs/11"
    assert r[11]["is_job_deleted"] == "no"
    assert r[12]["job__schedule__quartz_cron_expression"] is None
    assert r[12]["job__git_source__git_url"] is None and r[12]["job__tags__Team"] is None


def test_flatten_jobs_without_host_and_extra_keys(spark):
    good, _ = parse(spark, [JOB_FULL], schemas.JOB_PAYLOAD)
    out = FL.flatten_jobs(good, tag_keys=["Team", "CostCenter", "Type", "Owner", "Domain", "Priority", "Project"])
    r = out.collect()[0]
    assert r["Job_link"] is None
    assert r["job__tags__CostCenter"] == "c1"


def test_normalise_tags(spark):
    df = spark.createDataFrame([(1, " Data ", " p1", None)], "job_id long, job__tags__Team string, "
                               "job__tags__Priority string, job__tags__Project string")
    out = FL.normalise_tags(df, keys=["Team", "Priority", "Project"])
    assert rows(out) == [(1, "data", "P1", None)]


RUN_A = {
    "job_id": 1, "run_id": 100, "run_name": "r", "start_time": 5000, "end_time": 9000, "run_duration": 0,
    "setup_duration": 1, "execution_duration": 2, "trigger": "PERIODIC", "trigger_info": {"run_id": 7},
    "overriding_parameters": {"notebook_params": {"a": "b"}},
    "state": {"life_cycle_state": "TERMINATED", "result_state": "FAILED", "user_cancelled_or_timedout": False},
    "tasks": [
        {"run_id": 1001, "task_key": "t1", "start_time": 5000, "end_time": 6000, "setup_duration": 10,
         "execution_duration": 20, "cleanup_duration": 30, "attempt_number": 0,
         "state": {"life_cycle_state": "TERMINATED", "result_state": "FAILED", "user_cancelled_or_timedout": True},
         "notebook_task": {"notebook_path": "/x", "base_parameters": {"p": "1"}},
         "sql_task": {"warehouse_id": "w1", "query": {"query_id": "q"}},
         "pipeline_task": {"pipeline_id": "p1", "full_refresh": False},
         "new_cluster": {"num_workers": 8},
         "run_job_task": {"job_id": 3},
         "depends_on": [{"task_key": "t0"}]},
        {"run_id": 1002, "task_key": "t2", "start_time": 0,
         "state": {"life_cycle_state": "TERMINATED", "result_state": "SUCCESS"}},
    ],
}
RUN_NO_TASKS = {"job_id": 2, "run_id": 200, "start_time": 7000,
                "state": {"life_cycle_state": "RUNNING"}}


def test_flatten_runs(spark):
    good, _ = parse(spark, [RUN_A, RUN_NO_TASKS], schemas.RUN_PAYLOAD)
    out = FL.flatten_runs(good)
    assert out.columns == [c for c, _, _ in schemas.RUN_COLUMNS]
    r = {x["job_run_id"]: x for x in out.collect()}
    a = r[100]
    assert a["job_state__result_state"] == "FAILED"
    assert a["job_state__user_cancelled_or_timedout"] == "false"
    assert a["job_trigger_info"] == {"run_id": 7}
    assert a["job_overriding_parameters"] == {"notebook_params": {"a": "b"}}
    assert len(a["job_tasks"]) == 2
    # absent keys are left out, a run without tasks has an empty list
    assert set(a["job_tasks"][0].keys()) <= set(schemas.RUN_TASK_KEYS)
    assert None not in a["job_tasks"][0].values() and "execution_duration" not in a["job_tasks"][1]
    assert a["job_tasks"][0]["execution_duration"] == 20
    assert r[200]["job_tasks"] == [] and r[200]["job_state__life_cycle_state"] == "RUNNING"


def test_odd_typed_fields_do_not_cost_the_run(spark):
    odd = [{"job_id": 1, "run_id": 1, "overriding_parameters": {"python_params": ["a", "b"], "notebook_params": {"x": "y"}},
            "trigger_info": {"run_id": "not a number", "n": 3}},
           {"job_id": 1, "run_id": 2, "overriding_parameters": "text", "trigger_info": "text"},
           {"job_id": 1, "run_id": 3, "overriding_parameters": [1], "trigger_info": None}]
    good, bad = parse(spark, odd, schemas.RUN_PAYLOAD)
    assert bad.collect() == []
    r = {x["job_run_id"]: x for x in FL.flatten_runs(good).collect()}
    assert r[1]["job_overriding_parameters"] == {"python_params": {"json": '["a","b"]'}, "notebook_params": {"x": "y"}}
    assert r[1]["job_trigger_info"] == {"run_id": None, "n": 3}
    assert r[2]["job_overriding_parameters"] is None and r[2]["job_trigger_info"] is None
    assert r[3]["job_overriding_parameters"] is None


def test_flatten_tasks(spark):
    good, _ = parse(spark, [RUN_A, RUN_NO_TASKS], schemas.RUN_PAYLOAD)
    out = FL.flatten_tasks(good)
    assert out.columns == [c for c, _, _ in schemas.TASK_COLUMNS]
    r = {x["task_run_id"]: x for x in out.collect()}
    assert set(r) == {1001, 1002}                       # the run without tasks gives no rows
    t1 = r[1001]
    assert t1["task_job_run_id"] == 100 and t1["task_key"] == "t1"
    assert t1["task_notebook_task"] == {"notebook_path": "/x"}   # base_parameters dropped
    assert t1["task_run_job_task"] is None
    assert t1["task_sql_task"]["warehouse_id"] == "w1"
    assert t1["task_sql_task"]["query"] == '{"query_id":"q"}'
    assert t1["task_pipeline_task"] == {"pipeline_id": "p1", "full_refresh": "false"}
    assert t1["task_state__user_cancelled_or_timedout"] == "true"
    assert t1["task_depends_on"] == [{"task_key": "t0"}]
    assert r[1002]["task_start_time"] == 0 and r[1002]["task_cleanup_duration"] is None
