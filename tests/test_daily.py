"""The load into tables by day: order of landing, late outputs and starts,
days touched, and a stop before the switch."""

import datetime as dt
import json
import os
import uuid

import pytest
from pyspark.sql import functions as F

from conftest import rows
from runlens import schemas
from runlens.operators import incremental as I
from runlens.operators import outputs as O
from runlens.plans import daily as DY
from runlens.plans import load as LD
from runlens.session import checkpoint_dir
from runlens.sources import payloads as PL
from test_incremental import JOBS, payload_df, run_doc

DAY = 86_400_000
RUN_COLS = ("job_run_id", "job_start_time", "job_end_time", "job_state__life_cycle_state", "job_state__result_state", "start_day")
TASK_COLS = ("task_run_id", "task_job_run_id", "task_start_time", "task_state__result_state", "task_notebook_output", "task_error",
             "task_error_trace", "task_original_attempt_run_id", "start_day")


def base(spark):
    return os.path.join(checkpoint_dir(spark), "test-daily", uuid.uuid4().hex)


def docs(spark, items):
    return PL.split_bad(PL.parse_json(payload_df(spark, items), "payload", schemas.RUN_PAYLOAD))[0]


def out_docs(spark, items):
    df = spark.createDataFrame([(json.dumps(d),) for d in items], "payload string")
    return PL.split_bad(PL.parse_json(df, "payload", schemas.OUTPUT_PAYLOAD))[0]


def output(task, error="boom", attempt=None, fetch_error=None):
    if fetch_error:
        return {"metadata": {"run_id": str(task)}, "fetch_error": fetch_error}
    return {"metadata": {"run_id": str(task), "original_attempt_run_id": attempt and str(attempt)},
            "notebook_output": {"result": f"out {task}"}, "error": error, "error_trace": f"trace {task}"}


def tables(store):
    return rows(DY.runs_of(store), *RUN_COLS), rows(DY.tasks_of(store), *TASK_COLS)


def apply(spark, path, jobs, runs, outs, **kw):
    return DY.apply_batch(DY.open_store(spark, path), jobs, docs(spark, runs), out_docs(spark, outs), **kw)


PENDING = run_doc(1, 1, 3 * DAY, "RUNNING", None, [None, "SUCCESS"])
PENDING["tasks"][0]["start_time"] = 0                    # not begun yet
FAILED = run_doc(1, 1, 3 * DAY, "TERMINATED", "FAILED", ["FAILED", "SUCCESS"])
PIECES = [
    ("run", PENDING), ("run", FAILED),
    ("run", run_doc(2, 1, DAY, "TERMINATED", "SUCCESS", ["SUCCESS"])),
    ("run", run_doc(3, 2, 5 * DAY, "TERMINATED", "FAILED", ["FAILED", "CANCELED"])),
    ("out", output(10, attempt=7)), ("out", output(10, fetch_error="no route")), ("out", output(11, attempt=8)),
    ("out", output(30, fetch_error="gone")), ("out", output(31, attempt=9)), ("out", output(20, attempt=99)),
]


def load(spark, order, cuts):
    path, jobs = base(spark), spark.createDataFrame([(1, "no"), (2, "no")], JOBS)
    bounds = [0, *cuts, len(order)]
    for a, b in zip(bounds, bounds[1:]):
        part = [PIECES[i] for i in order[a:b]]
        apply(spark, path, jobs, [d for k, d in part if k == "run"], [d for k, d in part if k == "out"])
    return DY.open_store(spark, path)


def test_tables_do_not_depend_on_order_or_cuts(spark):
    n = len(PIECES)
    want = tables(load(spark, list(range(n)), []))
    runs, tasks = want
    assert [r[0] for r in runs] == [1, 2, 3] and {r[-1] for r in runs} == {dt.date(1970, 1, 4), dt.date(1970, 1, 2), dt.date(1970, 1, 6)}
    by = {t[0]: t for t in tasks}
    text = '{"result":"out 10"}'
    assert by[10][4:8] == (text, "boom", "trace 10", 7)               # a fetched output beats a failed fetch
    assert by[30][4:8] == ("gone", "gone", "gone", None)               # a failed fetch is told in all three texts
    assert by[11][4:8] == (None, None, None, 8) and by[31][7] == 9    # other tasks of failed runs: attempt ids only
    assert by[20][4:8] == (None, None, None, None)                    # no run failed here
    assert by[10][2] == 3 * DAY and by[10][-1] == dt.date(1970, 1, 4)  # begun later, in its run's day all the time
    # outputs first, the newer snapshot before the older one
    for order, cuts in (((9, 5, 3, 8, 6, 1, 4, 0, 2, 7), (3, 7)),):
        store = load(spark, order, cuts)
        assert tables(store) == want, (order, cuts)
        assert rows(store.read("open"), "task_run_id") == [(30,)]
        # left over: what came for a good task, or after the output that counts
        assert set(rows(store.read("waiting"), "task_run_id")) <= {(10,), (20,)}


def test_equals_one_whole_batch(spark):
    path, jobs = base(spark), spark.createDataFrame([(1, "no"), (2, "no")], JOBS)
    runs = [d for k, d in PIECES if k == "run"][1:]
    outs = [d for k, d in PIECES if k == "out"]
    apply(spark, path, jobs, runs[:2], outs[3:])
    apply(spark, path, jobs, runs[2:], outs[:4])
    one = LD.load_batch(jobs, None, None, payload_df(spark, runs), out_docs(spark, outs))
    store = DY.open_store(spark, path)
    assert rows(DY.runs_of(store).select(*one.runs.columns)) == rows(one.runs)
    assert rows(DY.tasks_of(store).select(*one.tasks.columns)) == rows(one.tasks)


def test_batch_touches_its_days_only(spark):
    path, jobs = base(spark), spark.createDataFrame([(1, "no")], JOBS)
    first = apply(spark, path, jobs, [run_doc(i, 1, i * DAY, "TERMINATED", "FAILED", ["FAILED"]) for i in range(1, 6)], [])
    store = DY.open_store(spark, path)
    then = {r["day"]: r["path"] for r in store.listed(first.version) if r["name"] == DY.TASKS}
    got = apply(spark, path, jobs, [run_doc(9, 1, 9 * DAY, "TERMINATED", "SUCCESS", ["SUCCESS"])], [output(20)])
    assert got.days == {DY.RUNS: [dt.date(1970, 1, 10)], DY.TASKS: [dt.date(1970, 1, 3), dt.date(1970, 1, 10)]}
    assert (got.before[DY.TASKS], got.after[DY.TASKS], got.before[DY.RUNS], got.after[DY.RUNS]) == (5, 6, 5, 6)
    now = {r["day"]: r["path"] for r in store.listed(got.version) if r["name"] == DY.TASKS}
    assert {d for d in then if now[d] == then[d]} == set(then) - {dt.date(1970, 1, 3)}
    assert len(DY.tasks_of(store, [dt.date(1970, 1, 3)]).inputFiles()) == 1
    assert rows(DY.tasks_of(store, [dt.date(1970, 1, 3)]), "task_run_id", "task_error") == [(20, "boom")]


@pytest.mark.parametrize("stop", [1, 7])
def test_stop_before_the_switch_leaves_both_tables(spark, monkeypatch, stop):
    """Whichever write is the last, readers see the old state of all tables;
    the batch run again gives the new one."""
    path, jobs = base(spark), spark.createDataFrame([(1, "no")], JOBS)
    apply(spark, path, jobs, [run_doc(1, 1, DAY, "RUNNING", None, ["SUCCESS"])], [])
    store = DY.open_store(spark, path)
    before = tables(store)
    batch = ([run_doc(1, 1, DAY, "TERMINATED", "FAILED", ["FAILED"]), run_doc(2, 1, 2 * DAY, "TERMINATED", "SUCCESS", [])], [output(10)])
    done = []

    def stopped(real):
        def call(self, *a, **k):
            if len(done) >= stop:
                raise RuntimeError("stopped")
            done.append(1)
            return real(self, *a, **k)
        return call

    with monkeypatch.context() as m:
        for name in ("put_days", "put_whole", "commit"):
            m.setattr(DY.DayStore, name, stopped(getattr(DY.DayStore, name)))
        with pytest.raises(RuntimeError):
            apply(spark, path, jobs, *batch)
        assert tables(store) == before and store.version() == 0
    apply(spark, path, jobs, *batch, version=1)
    assert [r[3] for r in tables(store)[0]] == ["TERMINATED"] * 2
    if stop == 7:                                                   # a committed batch that runs again
        again = tables(store)
        apply(spark, path, jobs, *batch, version=1)
        store = DY.open_store(spark, path)
        assert tables(store) == again and store.version() == 1


def test_unknown_jobs_and_runs_without_start_wait(spark):
    path = base(spark)
    one, both = (spark.createDataFrame([(j, "no") for j in ids], JOBS) for ids in ((1,), (1, 9)))
    late = run_doc(4, 1, 0, "PENDING", None, [None])
    apply(spark, path, one, [run_doc(3, 9, DAY, "TERMINATED", "SUCCESS", ["SUCCESS"]), late], [])
    store = DY.open_store(spark, path)
    assert rows(store.read("pending"), "run_id") == [(3,), (4,)] and rows(DY.runs_of(store)) == []
    apply(spark, path, both, [run_doc(4, 1, 2 * DAY, "RUNNING", None, [None])], [])
    assert rows(DY.runs_of(store), "job_run_id", "start_day") == [(3, dt.date(1970, 1, 2)), (4, dt.date(1970, 1, 3))]
    assert not [r for r in rows(DY.tasks_of(store), "start_day") if r[0] == dt.date(1970, 1, 1)]


def test_run_in_flight_that_moves_to_another_day(spark):
    """A start that is corrected while the run is in flight: one row, and no
    day is left with the old one."""
    path, jobs = base(spark), spark.createDataFrame([(1, "no")], JOBS)
    apply(spark, path, jobs, [run_doc(1, 1, DAY, "PENDING", None, ["SUCCESS"])], [])
    apply(spark, path, jobs, [run_doc(1, 1, 3 * DAY, "TERMINATED", "SUCCESS", ["SUCCESS"])], [])
    store = DY.open_store(spark, path)
    assert rows(DY.runs_of(store), "job_run_id", "start_day") == [(1, dt.date(1970, 1, 4))]
    assert rows(DY.tasks_of(store), "task_run_id", "start_day") == [(10, dt.date(1970, 1, 4))]


def test_closing_old_open_tasks(spark):
    path, jobs = base(spark), spark.createDataFrame([(1, "no")], JOBS)
    apply(spark, path, jobs, [run_doc(i, 1, i * 10 * DAY, "TERMINATED", "FAILED", ["FAILED"]) for i in (1, 2, 3)], [], keep_open_days=15)
    assert rows(DY.open_store(spark, path).read("open"), "task_run_id") == [(20,), (30,)]


def test_seed_and_selection(spark):
    path, jobs = base(spark), spark.createDataFrame([(1, "no"), (2, "no"), (3, "no")], JOBS)
    runs = [run_doc(1, 1, DAY, "RUNNING", None, ["FAILED"]), run_doc(2, 1, 5 * DAY, "TERMINATED", "SUCCESS", ["SUCCESS"]),
            run_doc(3, 2, 2 * DAY, "TERMINATED", "FAILED", ["FAILED"])]
    old = LD.load_batch(jobs, None, None, payload_df(spark, runs), spark.createDataFrame([], "run_id string"))
    store = DY.open_store(spark, path)
    DY.seed(store, old.runs, old.tasks)
    assert rows(store.read("open"), "task_run_id") == [(10,), (30,)]
    landed = docs(spark, [run_doc(1, 1, DAY, "TERMINATED", "FAILED", ["FAILED"]), run_doc(2, 1, 5 * DAY, "TERMINATED", "SUCCESS", ["SUCCESS"]),
                          run_doc(4, 1, 3 * DAY, "TERMINATED", "SUCCESS", []), run_doc(5, 3, 4 * DAY, "TERMINATED", "SUCCESS", [])])
    # a run in flight does not bring back what lies between it and the job's bound (run 4)
    assert rows(DY.select_payloads(store, jobs, landed), "run_id") == [(1,), (2,), (5,)]
    DY.apply_batch(store, jobs, DY.select_payloads(store, jobs, landed), out_docs(spark, [output(30)]))
    assert rows(DY.tasks_of(store), "task_run_id", "task_error") == [(10, None), (20, None), (30, "boom")]
    lost = I.conform_tasks(old.tasks).withColumn("task_job_run_id", F.lit(77).cast("long"))
    with pytest.raises(Exception, match="run is missing"):
        DY.seed(DY.open_store(spark, base(spark)), old.runs, lost)


def test_seed_shuffles_only_columns_that_the_tables_have(spark, monkeypatch):
    """Columns that a table lacks, and what later outputs need, are added after the
    shuffle by day; the store is the one that whole rows give."""
    runs = spark.createDataFrame([(1, 1, DAY, "TERMINATED"), (2, 1, 5 * DAY, "RUNNING")],
                                 "job_run_id long, job_id long, job_start_time long, job_state__life_cycle_state string")
    tasks = spark.createDataFrame([(1, 10, DAY, "FAILED", "boom", 7), (1, 11, DAY, "SUCCESS", None, None), (2, 20, 0, "FAILED", None, None)],
                                  "task_job_run_id long, task_run_id long, task_start_time long, task_state__result_state string, task_error string, task_original_attempt_run_id long")
    dealt, real = {}, DY.DayStore.put_days

    def noted(self, version, name, content, **kw):
        dealt.setdefault(name, set(content.columns))
        return real(self, version, name, content, **kw)

    with monkeypatch.context() as m:
        m.setattr(DY.DayStore, "put_days", noted)
        narrow = DY.open_store(spark, base(spark))
        DY.seed(narrow, runs, tasks)
    assert dealt[DY.RUNS] == {*runs.columns, "start_day"}
    assert dealt[DY.TASKS] == {*tasks.columns, "start_day", "run_failed"}
    whole = DY.open_store(spark, base(spark))
    DY.seed(whole, I.conform_runs(runs), I.conform_tasks(tasks))
    for name in narrow.schemas:
        assert narrow.read(name).columns == whole.read(name).columns
        assert rows(narrow.read(name)) == rows(whole.read(name))
    assert rows(narrow.read("open"), "task_run_id") == [(10,), (11,)]
    assert rows(narrow.read(DY.TASKS), "task_run_id", "task_description", "own", "output") == [
        (10, None, (None, "boom", None, 7), None), (11, None, (None,) * 4, None), (20, None, (None,) * 4, None)]


def test_flat_and_document_outputs(spark):
    flat = spark.createDataFrame([("1", "nb", "e", "t", "5"), (None, "x", "x", "x", "1")],
                                 "run_id string, notebook_output string, error string, error_trace string, original_attempt_run_id string")
    a = O.flat_outputs(flat).select("task_run_id", "output.*")
    assert rows(a) == [(1, "nb", "e", "t", 5, True)]
    b = O.flat_outputs(out_docs(spark, [output(1, "e", 5), output(2, fetch_error="f")])).select("task_run_id", "output.*")
    assert rows(b) == [(1, '{"result":"out 1"}', "e", "trace 1", 5, True), (2, "f", "f", "f", None, False)]
    twice = O.best_outputs(O.flat_outputs(out_docs(spark, [output(2, fetch_error="z"), output(2, "a"), output(2, "b")])))
    assert rows(twice.select("task_run_id", "output.error")) == [(2, "b")]


def test_daily_counts_give_the_same_reports(spark):
    """Kept by the load, through several batches that rewrite days: equal to
    the reports over whole tables."""
    from runlens.plans import reports as R

    jobs = spark.createDataFrame([(1, "no", "a"), (2, "no", "b"), (3, "no", None)], JOBS + ", job__tags__Team string")
    path = base(spark)

    def doc(i, day, result, life="TERMINATED"):
        d = run_doc(i, i % 3 + 1, day * DAY + i * 1000, life, result, [result or "SUCCESS", "FAILED"] if life == "TERMINATED" else [None])
        return d | {"run_duration": 1000 * i if i % 2 else 0, "setup_duration": 5, "execution_duration": 10 * i, "cleanup_duration": 1}

    first = [doc(i, i, "FAILED" if i % 2 else "SUCCESS") for i in range(1, 12)] + [doc(40, 40, None, "RUNNING"), doc(41, 39, None, "RUNNING")]
    later = [doc(41, 39, "FAILED"), doc(12, 5, "FAILED"), doc(42, 41, None, "RUNNING"), doc(43, 10, "SUCCESS"), doc(44, 11, "FAILED")]
    apply(spark, path, jobs, first, [output(10 * i + 1, f"e{i % 2}") for i in range(1, 12)])
    apply(spark, path, jobs, later, [output(10 * i, f"e{i % 3}") for i in (1, 3, 41, 44)])
    store = DY.open_store(spark, path)
    runs, tasks, counts = DY.runs_of(store), DY.tasks_of(store), store.read("run_counts")
    day = ("1970-01-03", "1970-01-12")
    assert rows(R.top_failed_jobs_daily(counts, jobs, *day, dims=["Team"])) == rows(R.top_failed_jobs(runs, jobs, *day, dims=["Team"]))
    assert rows(R.failure_trend_daily(counts)) == rows(R.failure_trend(runs, ntz=True))
    details = DY.tasks_of(store).join(runs.drop("start_day"), F.col("task_job_run_id") == F.col("job_run_id")).join(jobs, "job_id")
    details = details.withColumn("task_start_time", F.timestamp_millis(F.nullif("task_start_time", F.lit(0))))
    got = R.recurring_errors_daily(store.read("error_counts"), jobs, 1)
    assert rows(got) == rows(R.recurring_errors(details, 1)) and got.count() == 3
    for now in (None, 41 * DAY + 7, 41 * DAY):
        assert rows(DY.long_running(store, now)) == rows(R.long_running(runs, now))
