import json

from pyspark.sql import functions as F

from conftest import rows
from runlens.operators import incremental as I
from runlens.plans import load as LD

RUNS = ("job_run_id long, job_id long, job_start_time long, job_state__life_cycle_state string, "
        "job_state__result_state string")
JOBS = "job_id long, is_job_deleted string"


def test_monitored_jobs(spark):
    jobs = spark.createDataFrame([(1, "no"), (2, "yes"), (3, "yes")], JOBS)
    runs = spark.createDataFrame([(10, 2, 5, "RUNNING", None), (11, 3, 5, "TERMINATED", "SUCCESS")], RUNS)
    assert rows(I.monitored_jobs(jobs, runs)) == [(1,), (2,)]
    assert rows(I.monitored_jobs(jobs)) == [(1,)]


def test_watermarks_and_fetch_from(spark):
    runs = spark.createDataFrame([
        (1, 1, 100, "TERMINATED", "SUCCESS"),
        (2, 1, 300, "INTERNAL_ERROR", None),
        (3, 1, 200, "RUNNING", None),          # late in-flight run below the watermark
        (4, 2, 50, "SKIPPED", None),           # neither finished nor in flight
    ], RUNS)
    assert rows(I.watermarks(runs)) == [(1, 300)]
    mon = spark.createDataFrame([(1,), (2,), (3,)], "job_id long")
    assert rows(I.fetch_from(runs, mon)) == [(1, 300, 200), (2, 0, 0), (3, 0, 0)]
    assert rows(I.fetch_from(runs, mon, include_in_flight=False)) == [(1, 300, 300), (2, 0, 0), (3, 0, 0)]
    assert rows(I.fetch_from(None, mon)) == [(1, 0, 0), (2, 0, 0), (3, 0, 0)]


def test_select_new_is_inclusive_per_job(spark):
    payloads = spark.createDataFrame([(1, 10, 99), (1, 11, 100), (2, 12, 1), (3, 13, 500)],
                                     "job_id long, run_id long, start_time long")
    starts = spark.createDataFrame([(1, 100), (2, 0)], "job_id long, fetch_from long")
    assert rows(I.select_new(payloads, starts), "run_id") == [(11,), (12,)]


TASKS = ("task_run_id long, task_job_run_id long, task_start_time long, task_state__result_state string, "
         "task_error string, task_error_trace string, task_notebook_output string, task_original_attempt_run_id long")
OUT = "run_id string, notebook_output string, error string, error_trace string, original_attempt_run_id string"


def test_enrich_failures_keeps_values_of_good_tasks(spark):
    tasks = spark.createDataFrame([
        (1, 10, 5, "FAILED", None, None, None, None),
        (2, 10, 5, "SUCCESS", "own err", "own trace", "own out", 7),   # good task in the same batch
        (3, 10, 5, "FAILED", "own", None, None, 8),                    # failed, no output fetched
    ], TASKS)
    outputs = spark.createDataFrame([("1", "nb", "boom", "tb", "0"), ("2", "x", "x", "x", "9")], OUT)
    out = I.enrich_failures(tasks, outputs)
    assert out.columns == tasks.columns
    assert rows(out, "task_run_id", "task_error", "task_error_trace", "task_notebook_output",
                "task_original_attempt_run_id") == [
        (1, "boom", "tb", "nb", 0), (2, "own err", "own trace", "own out", 7), (3, "own", None, None, 8)]


def test_backfill_candidates(spark):
    tasks = spark.createDataFrame([
        (1, 10, 100, "SUCCESS", None, None, None, None),
        (2, 10, 150, "TIMEDOUT", None, None, None, None),
        (3, 10, 160, "FAILED", None, None, None, 5),       # has an id already
        (4, 20, 50, "FAILED", None, None, None, None),     # before the batch start
        (5, 30, 200, "SUCCESS", None, None, None, None),
    ], TASKS)
    batch = tasks.where(F.col("task_run_id").isin(2, 3))
    assert rows(I.backfill_candidates(tasks, batch)) == [(1,), (2,)]
    zero = tasks.where("task_run_id = 1").withColumn("task_start_time", F.lit(0).cast("long"))
    assert rows(I.backfill_candidates(tasks, zero)) == []       # no non-zero start: nothing
    outputs = spark.createDataFrame([("1", None, None, None, "77"), ("4", None, None, None, "44")], OUT)
    filled = I.fill_attempt_ids(tasks, batch, outputs)
    assert rows(filled, "task_run_id", "task_original_attempt_run_id") == [
        (1, 77), (2, None), (3, 5), (4, None), (5, None)]


def run_doc(run_id, job_id, start, life, result, tasks):
    return {"job_id": job_id, "run_id": run_id, "start_time": start,
            "state": {"life_cycle_state": life, "result_state": result},
            "tasks": [{"run_id": run_id * 10 + i, "task_key": f"t{i}", "start_time": start + i,
                       "state": {"life_cycle_state": life, "result_state": r}} for i, r in enumerate(tasks)]}


def payload_df(spark, docs):
    return spark.createDataFrame([(json.dumps(d),) for d in docs], "payload string")


def test_load_batch_two_parts_equal_one(spark):
    jobs = spark.createDataFrame([(1, "no"), (2, "no")], JOBS)
    docs = [run_doc(1, 1, 100, "TERMINATED", "SUCCESS", ["SUCCESS"]),
            run_doc(2, 1, 200, "TERMINATED", "FAILED", ["FAILED", "SUCCESS"]),
            run_doc(3, 2, 150, "TERMINATED", "SUCCESS", ["SUCCESS"]),
            run_doc(4, 2, 400, "TERMINATED", "SUCCESS", [])]
    outputs = spark.createDataFrame([("20", "nb", "err", "tr", "19")], OUT)
    one = LD.load_batch(jobs, None, None, payload_df(spark, docs), outputs)
    a = LD.load_batch(jobs, None, None, payload_df(spark, docs[:2]), outputs)
    b = LD.load_batch(jobs, a.runs, a.tasks, payload_df(spark, docs), outputs)
    assert rows(one.runs) == rows(b.runs)
    assert rows(one.tasks) == rows(b.tasks)
    t = {r["task_run_id"]: r for r in one.tasks.collect()}
    assert t[20]["task_error"] == "err" and t[20]["task_original_attempt_run_id"] == 19
    assert t[21]["task_error"] is None
    assert rows(one.runs, "job_run_id") == [(1,), (2,), (3,), (4,)]


def test_load_batch_rereads_late_in_flight_run(spark):
    jobs = spark.createDataFrame([(1, "no")], JOBS)
    first = [run_doc(1, 1, 100, "RUNNING", None, ["SUCCESS"]), run_doc(2, 1, 200, "TERMINATED", "SUCCESS", [])]
    a = LD.load_batch(jobs, None, None, payload_df(spark, first), spark.createDataFrame([], OUT))
    later = [run_doc(1, 1, 100, "TERMINATED", "SUCCESS", ["SUCCESS"]), run_doc(2, 1, 200, "TERMINATED", "SUCCESS", [])]
    b = LD.load_batch(jobs, a.runs, a.tasks, payload_df(spark, later), spark.createDataFrame([], OUT))
    assert rows(b.runs, "job_run_id", "job_state__life_cycle_state") == [(1, "TERMINATED"), (2, "TERMINATED")]
    c = LD.load_batch(jobs, a.runs, a.tasks, payload_df(spark, later), spark.createDataFrame([], OUT),
                      include_in_flight=False)
    assert rows(c.runs, "job_run_id", "job_state__life_cycle_state") == [(1, "RUNNING"), (2, "TERMINATED")]


def test_load_batch_keeps_bad_payloads_apart(spark):
    jobs = spark.createDataFrame([(1, "no")], JOBS)
    p = spark.createDataFrame([(json.dumps(run_doc(1, 1, 100, "TERMINATED", "SUCCESS", [])),), ("{oops",)],
                              "payload string")
    out = LD.load_batch(jobs, None, None, p, spark.createDataFrame([], OUT))
    assert out.runs.count() == 1 and out.bad.count() == 1


def test_publish_writes_versions(spark):
    jobs = spark.createDataFrame([(1, "no")], JOBS)
    docs = [run_doc(1, 1, 100, "TERMINATED", "SUCCESS", ["SUCCESS"])]
    b = LD.load_batch(jobs, None, None, payload_df(spark, docs), spark.createDataFrame([], OUT))
    import uuid

    out = LD.publish(b, version=uuid.uuid4().hex)
    assert spark.read.parquet(out.paths["job_run_details"]).count() == 1
    assert spark.read.parquet(out.paths["task_run_details"]).count() == 1
    assert out.rows == {"job_run_details": 1, "task_run_details": 1}


def test_load_batch_nothing_new(spark):
    jobs = spark.createDataFrame([(1, "no")], JOBS)
    docs = [run_doc(1, 1, 100, "TERMINATED", "SUCCESS", ["SUCCESS"])]
    a = LD.load_batch(jobs, None, None, payload_df(spark, docs), spark.createDataFrame([], OUT))
    nobody = spark.createDataFrame([(1, "yes")], JOBS)
    b = LD.load_batch(nobody, a.runs, a.tasks, payload_df(spark, docs), spark.createDataFrame([], OUT))
    assert rows(b.runs) == rows(a.runs) and rows(b.tasks) == rows(a.tasks)
    assert b.new_tasks.count() == 0



def test_no_documents_are_shuffled_for_the_runs_of_many_jobs(spark, monkeypatch):
    """More bounds than a broadcast takes: payloads are staged as they come, and the
    run table is the same as with few jobs."""
    jobs = spark.createDataFrame([(1, "no"), (2, "no"), (None, "no"), (3, "yes")], JOBS)
    old = [run_doc(1, 1, 100, "RUNNING", None, ["SUCCESS"]), run_doc(2, 2, 300, "TERMINATED", "SUCCESS", ["SUCCESS"]),
           run_doc(9, 1, 50, "TERMINATED", "SUCCESS", [])]
    docs = [run_doc(1, 1, 100, "TERMINATED", "FAILED", ["FAILED"]), run_doc(3, 2, 200, "TERMINATED", "SUCCESS", ["SUCCESS"]),
            run_doc(4, 2, 400, "TERMINATED", "SUCCESS", ["CANCELED"]), run_doc(5, 3, 400, "TERMINATED", "SUCCESS", ["SUCCESS"]),
            run_doc(6, None, 400, "TERMINATED", "SUCCESS", []), run_doc(7, 1, None, "RUNNING", None, [])]
    outputs = spark.createDataFrame([("10", "nb", "err", "tr", "5")], OUT)
    a = LD.load_batch(jobs, None, None, payload_df(spark, old), spark.createDataFrame([], OUT))
    payloads = spark.read.parquet(_written(payload_df(spark, docs)))
    few = LD.load_batch(jobs, a.runs, a.tasks, payloads, outputs)

    plans, stage = {}, LD.stage

    def seen(df, name="stage", paths=None):
        plans[name] = df._jdf.queryExecution().optimizedPlan().toString()
        return stage(df, name, paths)

    monkeypatch.setattr(LD, "stage", seen)
    monkeypatch.setattr(LD, "FEW_JOBS", 0, raising=False)
    many = LD.load_batch(jobs, a.runs, a.tasks, payloads, outputs)
    assert not [name for name, plan in plans.items() if name != "starts" and "tasks" in plan and "Join" in plan]
    narrow = many.runs.select("job_run_id", "job_state__life_cycle_state")._jdf.queryExecution()
    assert "notebook_task" not in narrow.optimizedPlan().toString()
    assert "ShuffledHashJoin" in narrow.executedPlan().toString()
    assert rows(many.runs) == rows(few.runs) and rows(many.tasks) == rows(few.tasks)
    assert rows(many.runs, "job_run_id", "job_state__life_cycle_state") == [
        (1, "TERMINATED"), (2, "TERMINATED"), (4, "TERMINATED"), (9, "TERMINATED")]


def _written(df) -> str:
    import tempfile

    path = tempfile.mkdtemp(prefix="runlens-payloads-") + "/p"
    df.write.parquet(path)
    return path


def test_load_batch_dedupes_snapshots_of_one_run(spark):
    from pyspark.sql import functions as F

    jobs = spark.createDataFrame([(1, "no")], JOBS)
    docs = [dict(run_doc(1, 1, 100, "RUNNING", None, ["SUCCESS"]), landed=1),
            dict(run_doc(1, 1, 100, "TERMINATED", "SUCCESS", ["SUCCESS"]), landed=2)]
    p = spark.createDataFrame([(json.dumps(d), d["landed"]) for d in docs], "payload string, landed long")
    out = LD.load_batch(jobs, None, None, p, spark.createDataFrame([], OUT), dedupe_order=[F.col("landed").desc()])
    assert rows(out.runs, "job_run_id", "job_state__life_cycle_state") == [(1, "TERMINATED")]


def test_state_path_equals_run_table_path(spark):
    jobs = spark.createDataFrame([(1, "no"), (2, "no"), (3, "yes")], JOBS)
    b1 = [run_doc(1, 1, 100, "RUNNING", None, ["SUCCESS"]), run_doc(2, 1, 200, "TERMINATED", "SUCCESS", []),
          run_doc(3, 2, 150, "TERMINATED", "FAILED", ["FAILED"]), run_doc(5, 3, 120, "RUNNING", None, [])]
    b2 = [run_doc(1, 1, 100, "TERMINATED", "SUCCESS", ["SUCCESS"]), run_doc(4, 2, 400, "PENDING", None, []),
          run_doc(5, 3, 120, "TERMINATED", "SUCCESS", [])]
    b3 = [run_doc(4, 2, 400, "TERMINATED", "SUCCESS", []), run_doc(6, 1, 50, "TERMINATED", "SUCCESS", [])]
    none = spark.createDataFrame([], OUT)
    a = LD.load_batch(jobs, None, None, payload_df(spark, b1), none)
    s = LD.load_batch(jobs, None, None, payload_df(spark, b1), none, state=I.load_state(a.runs.limit(0)))
    for docs in (b2, b3):
        a_next = LD.load_batch(jobs, a.runs, a.tasks, payload_df(spark, docs), none)
        s_next = LD.load_batch(jobs, s.runs, s.tasks, payload_df(spark, docs), none, state=s.state)
        assert rows(I.fetch_from_state(s.state, I.monitored_from_state(jobs, s.state))) == \
            rows(I.fetch_from(a.runs, I.monitored_jobs(jobs, a.runs)))
        assert rows(a_next.runs) == rows(s_next.runs)
        a, s = a_next, s_next
    assert rows(s.state.in_flight) == []
    # job 3 is deleted with nothing in flight in the table: never read, in either path
    assert rows(s.state.watermarks) == [(1, 200), (2, 400)]
