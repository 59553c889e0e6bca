import pytest
from pyspark.sql import functions as F

from conftest import rows
from runlens.operators import upsert as U

DDL = "job_run_id long, state string, start long"


def test_upsert_replaces_and_inserts(spark):
    target = spark.createDataFrame([(1, "RUNNING", 10), (2, "TERMINATED", 20)], DDL)
    source = spark.createDataFrame([(1, "TERMINATED", 10), (3, "RUNNING", 30)], DDL)
    out = U.upsert(target, source, ["job_run_id"])
    assert rows(out) == [(1, "TERMINATED", 10), (2, "TERMINATED", 20), (3, "RUNNING", 30)]


def test_upsert_is_idempotent(spark):
    target = spark.createDataFrame([(1, "RUNNING", 10), (2, "TERMINATED", 20)], DDL)
    source = spark.createDataFrame([(1, "TERMINATED", 10), (3, "RUNNING", 30)], DDL)
    once = U.upsert(target, source, ["job_run_id"])
    twice = U.upsert(once, source, ["job_run_id"])
    assert rows(once) == rows(twice)


def test_upsert_first_load_and_new_columns(spark):
    source = spark.createDataFrame([(1, "RUNNING", 10)], DDL)
    assert rows(U.upsert(None, source, ["job_run_id"])) == [(1, "RUNNING", 10)]
    target = spark.createDataFrame([(2, "TERMINATED", 20)], DDL)
    wider = source.withColumn("extra", F.lit("x"))
    out = U.upsert(target, wider, ["job_run_id"])
    assert rows(out, "job_run_id", "extra") == [(1, "x"), (2, None)]


def test_upsert_order_keeps_newest_per_key(spark):
    source = spark.createDataFrame([(1, "RUNNING", 10), (1, "TERMINATED", 12), (2, "RUNNING", 5)], DDL)
    out = U.upsert(None, source, ["job_run_id"], order=[F.col("start").desc()])
    assert rows(out) == [(1, "TERMINATED", 12), (2, "RUNNING", 5)]


def test_check_unique(spark):
    ok = spark.createDataFrame([(1, "a", 1), (2, "b", 2)], DDL)
    U.check_unique(ok, ["job_run_id"])
    dup = spark.createDataFrame([(1, "a", 1), (1, "b", 2)], DDL)
    with pytest.raises(U.DuplicateKeyError):
        U.check_unique(dup, ["job_run_id"])


JOBS = "job_id long, is_job_deleted string, name string"


def test_mark_missing(spark):
    target = spark.createDataFrame(
        [(1, "no", "a"), (2, "no", "b"), (3, None, "c"), (4, "yes", "d"), (5, "no", "e")], JOBS)
    seen = spark.createDataFrame([(1,), (None,)], "job_id long")
    keep = spark.createDataFrame([(5,)], "job_id long")
    out = U.mark_missing(target, seen, keep=keep)
    assert out.columns == target.columns
    assert rows(out, "job_id", "is_job_deleted") == [(1, "no"), (2, "yes"), (3, "yes"), (4, "yes"), (5, "no")]


def test_deleted_job_comes_back(spark):
    target = spark.createDataFrame([(1, "yes", "a")], JOBS)
    staged = spark.createDataFrame([(1, "no", "a2")], JOBS)
    merged = U.upsert(target, staged, ["job_id"])
    out = U.mark_missing(merged, staged)
    assert rows(out) == [(1, "no", "a2")]


def test_fill_missing_only_nulls_and_no_fan_out(spark):
    target = spark.createDataFrame([(1, None), (2, 20), (3, None)], "task_run_id long, a long")
    source = spark.createDataFrame([("1", "11"), ("1", "12"), ("2", "99"), ("9", "90")], "run_id string, x string")
    out = U.fill_missing(target, source, "task_run_id", "a", source_key="run_id", source_column="x")
    assert rows(out) == [(1, 12), (2, 20), (3, None)]
