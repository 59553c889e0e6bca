import datetime as dt
import json

import pytest

from conftest import rows
from runlens.plans import load as LD

DDL = ("workspace_id string, job_id bigint, name string, tags map<string,string>, "
       "change_time timestamp_ntz, delete_time timestamp_ntz")


def versions(spark, data):
    return spark.createDataFrame(data, DDL)


def payloads(spark, ids):
    docs = [{"job_id": i, "settings": {"name": f"job{i}", "tags": {"Team": " Data ", "Type": "PROD",
                                                                    "Priority": "p1", "Other": "x"}}}
            for i in ids]
    return spark.createDataFrame([(json.dumps(d),) for d in docs], "payload string")


def t(d):
    return dt.datetime(2024, 1, d)


def test_load_jobs_first_then_soft_delete_and_return(spark):
    tags = {"Team": "data", "Type": "prod"}
    v1 = versions(spark, [("w", 1, "a", tags, t(1), None), ("w", 2, "b", tags, t(1), None),
                          ("w", 3, "c", tags, t(1), None)])
    first = LD.load_jobs(v1, payloads(spark, [1, 2, 3]), [("DATA", "PROD")], host="h").jobs
    got = {r["job_id"]: r for r in first.collect()}
    assert set(got) == {1, 2, 3}
    assert got[1]["job__tags__Team"] == "data" and got[1]["job__tags__Priority"] == "P1"
    assert got[1]["Job_link"] == "https://h/jobs/1" and got[1]["is_job_deleted"] == "no"
    assert "job__tags__Other" not in first.columns
    # job 2 deleted, job 3 excluded from discovery (left as is), job 4 new
    v2 = versions(spark, [("w", 1, "a", tags, t(1), None), ("w", 2, "b", tags, t(2), t(2)),
                          ("w", 3, "c", tags, t(1), None), ("w", 4, "d", tags, t(2), None)])
    second = LD.load_jobs(v2, payloads(spark, [1, 2, 3, 4]), [("data", "prod")], current=first,
                          excluded=[3], host="h").jobs
    assert rows(second, "job_id", "is_job_deleted") == [(1, "no"), (2, "yes"), (3, "no"), (4, "no")]
    # job 2 comes back
    v3 = versions(spark, [("w", 2, "b", tags, t(3), None)])
    third = LD.load_jobs(v3, payloads(spark, [2]), [("data", "prod")], current=second, host="h").jobs
    assert rows(third, "job_id", "is_job_deleted") == [(1, "yes"), (2, "no"), (3, "yes"), (4, "yes")]


def test_load_jobs_refuses_empty_staging(spark):
    v = versions(spark, [("w", 1, "a", {"Team": "web", "Type": "dev"}, t(1), None)])
    with pytest.raises(LD.StagingEmpty):
        LD.load_jobs(v, payloads(spark, [1]), [("data", "prod")])


def test_load_jobs_with_repeated_payloads(spark):
    from pyspark.sql import functions as F

    from runlens.operators.upsert import DuplicateKeyError

    v = versions(spark, [("w", 1, "a", {"Team": "data", "Type": "prod"}, t(1), None)])
    landed = payloads(spark, [1]).withColumn("at", F.lit(1)).unionByName(
        payloads(spark, [1]).withColumn("payload", F.replace("payload", F.lit("job1"), F.lit("renamed"))).withColumn("at", F.lit(2)))
    with pytest.raises(DuplicateKeyError):
        LD.load_jobs(v, landed, [("data", "prod")])
    jobs = LD.load_jobs(v, landed, [("data", "prod")], dedupe_order=[F.col("at").desc()]).jobs
    assert rows(jobs, "job_id", "job__name") == [(1, "renamed")]


def test_excluded_ids_that_are_no_numbers_are_skipped(spark):
    v = versions(spark, [("w", 1, "a", {"Team": "data", "Type": "prod"}, t(1), None)])
    first = LD.load_jobs(v, payloads(spark, [1]), [("data", "prod")]).jobs
    again = LD.load_jobs(v, payloads(spark, [1]), [("data", "prod")], current=first, excluded=["abc", " 7 "]).jobs
    assert rows(again, "job_id", "is_job_deleted") == [(1, "no")]
