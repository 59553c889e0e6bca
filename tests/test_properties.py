"""Properties of the keyed operators over generated rows."""

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from conftest import rows
from runlens.operators import upsert as U
from runlens.plans import details as DT

SETTINGS = settings(max_examples=15, deadline=None, suppress_health_check=list(HealthCheck))
DDL = "k long, v string, day string"

keyed = st.lists(st.tuples(st.integers(0, 20), st.sampled_from("abc"), st.sampled_from(["d1", "d2", "d3", "d4"])),
                 max_size=25, unique_by=lambda r: r[0])


@SETTINGS
@given(target=keyed, source=keyed)
def test_upsert_twice_is_once(spark, target, source):
    t, s = spark.createDataFrame(target, DDL), spark.createDataFrame(source, DDL)
    once = U.upsert(t, s, ["k"])
    assert rows(U.upsert(once, s, ["k"])) == rows(once)
    expect = {k: (k, v, d) for k, v, d in target}
    expect.update({k: (k, v, d) for k, v, d in source})
    assert rows(once) == sorted(expect.values(), key=repr)


@SETTINGS
@given(jobs=st.lists(st.integers(0, 5), unique=True, max_size=6),
       runs=st.lists(st.tuples(st.integers(0, 30), st.integers(0, 7)), unique_by=lambda r: r[0], max_size=20),
       tasks=st.lists(st.tuples(st.integers(0, 200), st.integers(0, 35)), unique_by=lambda r: r[0], max_size=40))
def test_view_rows_are_tasks_with_known_run_and_job(spark, jobs, runs, tasks):
    j = spark.createDataFrame([(x, "no") for x in jobs], "job_id long, is_job_deleted string")
    r = spark.createDataFrame(runs, "job_run_id long, job_id long")
    t = spark.createDataFrame(tasks, "task_run_id long, task_job_run_id long")
    run_job = dict(runs)
    expect = sum(1 for _, rid in tasks if rid in run_job and run_job[rid] in set(jobs))
    assert DT.run_details(t, r, j).count() == expect


@SETTINGS
@given(flags=st.lists(st.sampled_from(["yes", "no", None]), min_size=1, max_size=8),
       seen=st.lists(st.booleans(), min_size=8, max_size=8))
def test_soft_delete_then_return_is_live(spark, flags, seen):
    table = spark.createDataFrame([(i, f) for i, f in enumerate(flags)], "job_id long, is_job_deleted string")
    ids = spark.createDataFrame([(i,) for i in range(len(flags)) if seen[i]], "job_id long")
    marked = U.mark_missing(table, ids)
    got = dict(rows(marked))
    for i, f in enumerate(flags):
        assert got[i] == (f if seen[i] else "yes")
    back = spark.createDataFrame([(i, "no") for i in range(len(flags))], "job_id long, is_job_deleted string")
    again = U.mark_missing(U.upsert(marked, back, ["job_id"]), back)
    assert set(dict(rows(again)).values()) == {"no"}
