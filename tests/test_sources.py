import json
import os
import uuid

from conftest import rows
from runlens import schemas
from runlens.session import checkpoint_dir
from runlens.sources import payloads as PL
from runlens.sources import tables as TB


def folder(spark, name):
    path = os.path.join(checkpoint_dir(spark).replace("file:", ""), "test-sources", uuid.uuid4().hex, name)
    os.makedirs(path)
    return path


def test_read_run_payload_files_keeps_bad_lines_apart(spark):
    path = folder(spark, "runs")
    with open(os.path.join(path, "a.json"), "w") as f:
        f.write(json.dumps({"job_id": 1, "run_id": 10, "start_time": 5, "extra": {"x": 1}}) + "\n")
        f.write("{broken\n")
    df = PL.read_run_payloads(spark, path)
    good, bad = PL.split_bad(df)
    assert rows(good, "run_id", "job_id", "start_time") == [(10, 1, 5)]
    assert len(bad.collect()) == 1       # all columns: Spark refuses raw-file queries on the corrupt column alone
    assert "extra" not in good.columns


def test_outputs_from_payloads(spark):
    docs = [{"metadata": {"run_id": "7", "original_attempt_run_id": "6"}, "error": "e", "error_trace": "t",
             "notebook_output": {"result": "r"}}]
    df = spark.createDataFrame([(json.dumps(d),) for d in docs], "payload string")
    good, _ = PL.split_bad(PL.parse_json(df, "payload", schemas.OUTPUT_PAYLOAD))
    out = PL.outputs_from_payloads(good)
    assert out.columns == ["run_id", "notebook_output", "error", "error_trace", "original_attempt_run_id"]
    assert rows(out, "run_id", "error", "original_attempt_run_id") == [("7", "e", "6")]


def test_tables(spark):
    TB.ensure_schema(spark, "runlens_t")
    assert spark.catalog.databaseExists("runlens_t")
    assert not TB.table_exists(spark, "runlens_t.jobs")
    df = spark.createDataFrame([(1,), (2,)], "job_id long")
    df.write.saveAsTable("runlens_t.jobs")
    assert TB.table_exists(spark, "runlens_t.jobs")
    assert rows(TB.read_table(spark, "runlens_t.jobs")) == [(1,), (2,)]
    assert TB.has_rows(df) and not TB.has_rows(df.limit(0))
    assert len(TB.preview(df, 1)) == 1
    base = folder(spark, "versions")
    path = TB.write_version(df, base, "jobs", 3)
    assert path.endswith(os.path.join("jobs", "v=3"))
    assert rows(TB.read_table(spark, path)) == [(1,), (2,)]
