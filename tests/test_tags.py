from conftest import rows
from runlens.operators import tags as TG


def job_tags(spark):
    return spark.createDataFrame([
        (1, {"Team": "data", "Type": "PROD"}),
        (2, {"Team": "web"}),
        (3, {"Team": "ops", "Project": "p"}),
    ], "job_id long, tags map<string,string>")


DESIRED = {"Team": "ops", "Project": " p ", "Owner": "", "Colour": "red", "Domain": None}


def test_clean_desired():
    assert TG.clean_desired(DESIRED) == {"Team": "ops", "Project": "p"}


def test_plan_overwrite(spark):
    plan = TG.plan_tags(job_tags(spark), DESIRED, overwrite=True, dry_run=True)
    assert rows(plan, "job_id", "status") == [(1, "dry_run"), (2, "dry_run"), (3, "no_change")]
    assert rows(TG.plan_rows(plan), "job_id", "key", "old_value", "new_value") == [
        (1, "Project", None, "p"), (1, "Team", "data", "ops"), (2, "Project", None, "p"), (2, "Team", "web", "ops")]


def test_plan_keep_existing(spark):
    plan = TG.plan_tags(job_tags(spark), DESIRED, overwrite=False, dry_run=False)
    assert rows(TG.plan_rows(plan), "job_id", "status", "key") == [(1, "updated", "Project"),
                                                                    (2, "updated", "Project")]
    assert rows(plan.where("job_id = 3"), "status") == [("no_change",)]


def test_plan_unknown_ids_and_summary(spark):
    plan = TG.plan_tags(job_tags(spark), DESIRED, job_ids=[1, "3", "x", 42])
    assert rows(plan, "job_id", "status") == [(1, "dry_run"), (3, "no_change"), (42, "error: job not found")]
    s = TG.tag_summary(plan).collect()[0].asDict()
    assert s == {"updated": 0, "dry_run": 1, "no_change": 1, "errors": 1}


def test_jobs_without_tags_are_found(spark):
    jobs = spark.createDataFrame([(1, None), (2, {"Team": "ops", "Project": "p"}), (3, {})], "job_id long, tags map<string,string>")
    plan = TG.plan_tags(jobs, DESIRED, overwrite=False, dry_run=False, job_ids=[1, 2, 3, 9])
    assert rows(plan, "job_id", "status") == [
        (1, "updated"), (2, "no_change"), (3, "updated"), (9, "error: job not found")]
    got = {r["job_id"]: r["tags"] for r in TG.apply_tags(plan).collect()}
    assert got == {1: {"Team": "ops", "Project": "p"}, 2: {"Team": "ops", "Project": "p"}, 3: {"Team": "ops", "Project": "p"}}
    assert TG.tag_summary(plan).collect()[0].asDict() == {"updated": 2, "dry_run": 0, "no_change": 1, "errors": 1}


def test_apply_tags(spark):
    out = TG.apply_tags(TG.plan_tags(job_tags(spark), DESIRED, overwrite=True))
    got = {r["job_id"]: r["tags"] for r in out.collect()}
    assert got[1] == {"Team": "ops", "Type": "PROD", "Project": "p"}
    assert got[3] == {"Team": "ops", "Project": "p"}


def test_no_desired_tags(spark):
    plan = TG.plan_tags(job_tags(spark), {"Owner": " "})
    assert rows(plan, "status") == [("no_change",)] * 3
