import pytest

from runlens.config import ConfigError, Settings


def test_target_and_pairs():
    s = Settings(pairs=[(" data ", "prod"), ("DATA", "PROD"), ("", "")],
                 targets={"prod": ("main", "ops"), "dev": ("dev", "ops_dev")})
    assert s.clean_pairs() == [("DATA", "PROD")]
    assert s.target() == "main.ops" and s.table("job_details") == "main.ops.job_details"
    assert Settings(pairs=[("a", "b")], targets={"dev": ("d", "s")}, env=" QA ").target() == "d.s"
    assert s.tag_keys() == ["Domain", "Owner", "Priority", "Project", "Team", "Type"]


def test_errors():
    with pytest.raises(ConfigError):
        Settings(pairs=[("", "")]).clean_pairs()
    with pytest.raises(ConfigError):
        Settings(pairs=[("a", "b")], targets={"prod": ("", "x")}).target()


def test_batch_into_the_tables_that_settings_name(spark):
    from conftest import rows
    from runlens.config import Settings
    from runlens.plans import load as LD
    from runlens.sources import tables as TB
    from test_incremental import JOBS, OUT, payload_df, run_doc

    settings = Settings(env="dev", pairs=(("a", "b"),), targets={"dev": ("spark_catalog", "runlens_dev"), "prod": ("c", "s")})
    jobs, outputs = spark.createDataFrame([(1, "no")], JOBS), spark.createDataFrame([], OUT)
    first = LD.load_batch(jobs, None, None, payload_df(spark, [run_doc(1, 1, 100, "RUNNING", None, ["SUCCESS"])]), outputs)
    done = LD.publish_catalog(first, settings)
    assert done.paths["job_run_details"] == "spark_catalog.runlens_dev.job_run_details" and done.rows["task_run_details"] == 1
    runs, tasks = (TB.read_table(spark, settings.table(t)) for t in ("job_run_details", "task_run_details"))
    again = LD.load_batch(jobs, runs, tasks, payload_df(spark, [run_doc(1, 1, 100, "TERMINATED", "SUCCESS", ["SUCCESS"]),
                                                               run_doc(2, 1, 200, "TERMINATED", "SUCCESS", [])]), outputs)
    LD.publish_catalog(again, settings)
    now = TB.read_table(spark, settings.table("job_run_details"))
    assert rows(now, "job_run_id", "job_state__life_cycle_state") == [(1, "TERMINATED"), (2, "TERMINATED")]
