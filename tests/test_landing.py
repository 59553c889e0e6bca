"""The derived landing: a query writes the tables it reads only, documents are
compressed and keep their fields."""

import datetime as dt
import os
import tempfile

from conftest import rows
from runlens.operators import flatten as FL
from runlens.plans import registry as RG
from runlens.sources import fixtures as FX
from runlens.sources import payloads as PL


def tables(spark):
    """Two orders (one without lines) and a customer; line 2 of order 1 comes twice."""
    sf, day = tempfile.mkdtemp(prefix="runlens-sf-"), dt.datetime(1999, 1, 2)
    spark.createDataFrame([(1, "c1", 2, "BUILDING")], "c_custkey long, c_name string, c_nationkey int, c_mktsegment string").write.parquet(f"{sf}/customer.parquet")
    spark.createDataFrame([(1, 1, "F", 10.0, day), (2, 1, "O", 20.0, day)],
                          "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, o_orderdate timestamp_ntz").write.parquet(f"{sf}/orders.parquet")
    lines = [(1, 3, 1, 2, 1.0, 5.0, "R", day), (1, 4, 1, 2, 2.0, 6.0, "A", day), (1, 3, 9, 1, 3.0, 7.0, "R", day), (1, 3, 9, None, 3.0, 7.0, "R", day)]
    spark.createDataFrame(lines, "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_extendedprice double, l_returnflag string, l_shipdate timestamp_ntz").write.parquet(f"{sf}/lineitem.parquet")
    return sf


def test_a_query_lands_only_what_it_reads(spark):
    sf = tables(spark)
    assert RG.q_apply_tags(spark, sf).count() == 1
    folder = os.path.dirname(FX.land(spark, sf, "jobs"))
    assert os.listdir(folder) == ["jobs"]
    assert RG.q_backfill_candidates(spark, sf).columns == ["task_run_id"]
    assert sorted(os.listdir(folder)) == ["jobs", "tasks"]


def test_run_documents_are_compressed_and_whole(spark):
    sf = tables(spark)
    path = FX.land(spark, sf, "run_payloads")
    assert all(f.endswith(".gz") for f in os.listdir(path) if f.startswith("part-"))
    good = PL.split_bad(FX.landed(spark, sf).run_payloads)[0]
    flat = FL.flatten_tasks(good)
    assert rows(flat, "task_run_id", "task_job_run_id", "task_key", "task_execution_duration", "task_state__result_state",
                "task_state__user_cancelled_or_timedout", "task_attempt_number", "task_depends_on") == sorted([
        (11, 1, "task1", 3000, "FAILED", "false", 2, None),
        (12, 1, "task2", 2000, "SUCCESS", "false", 0, [{"task_key": "task1"}]),
        (None, 1, None, 3000, "FAILED", "false", None, None)], key=repr)
    assert rows(flat.where("task_run_id = 12"), "task_libraries", "task_git_source", "task_notebook_task") == [
        ([{"pypi": '{"package":"lib0"}'}], {"git_url": "https://git.example.com/r", "git_branch": "main"}, {"notebook_path": "/w/nb"})]
    runs = FL.flatten_runs(good)
    assert rows(runs, "job_run_id", "job_run_type", "job_trigger_info") == [(1, "SUBMIT_RUN", None), (2, "JOB_RUN", None)]
    assert [len(r[0]) for r in runs.orderBy("job_run_id").select("job_tasks").collect()] == [3, 0]


def test_tasks_pass_the_shuffle_flat(spark):
    """Documents are built after the grouping, so the shuffle and its sort hold flat rows."""
    sf = tables(spark)
    L = FX.landed(spark, sf)
    plan = FX.run_payloads(L.runs, L.tasks)._jdf.queryExecution().optimizedPlan().toString()
    grouped = plan[plan.index("collect_list"):]
    assert "https://git.example.com" not in grouped and "notebook_path" not in grouped


def test_tasks_are_grouped_after_the_shuffle(spark):
    """Lists of tasks are made of a partition's whole runs: none before it, where they would be sorted and spilled."""
    L = FX.landed(spark, tables(spark))
    plan = FX.run_payloads(L.runs, L.tasks)._jdf.queryExecution().executedPlan().toString()
    first = plan.index("partial_collect_list")
    assert "Exchange hashpartitioning" in plan[first:]
    assert "Exchange" not in plan[plan.index("collect_list"):first]


def test_a_line_passes_the_shuffle_with_one_start(spark):
    """The start made for the order of lines is the task's; the ship date stays behind."""
    sf = tables(spark)
    plan = FX.tasks(spark, sf)._jdf.queryExecution().optimizedPlan().toString()
    assert "l_shipdate" not in plan[:plan.index("WindowGroupLimit")]
    assert rows(FX.tasks(spark, sf), "task_run_id", "task_start_time", "task_end_time") == sorted([
        (11, 915235200000, 915235203000), (12, 915235200000, 915235202000), (None, 915235200000, 915235203000)], key=repr)
