import datetime as dt

from pyspark.sql import functions as F

from conftest import rows
from runlens.operators import discover as D

DDL = ("workspace_id string, job_id bigint, name string, tags map<string,string>, "
       "change_time timestamp_ntz, delete_time timestamp_ntz, version_id bigint")


def t(day):
    return dt.datetime(2024, 1, day)


def versions(spark):
    data = [
        ("w1", 1, "Alpha", {"Team": "data", "Type": "prod"}, t(1), None, 1),
        ("w1", 1, "Alpha", {"Team": "data", "Type": "dev"}, t(2), None, 2),     # newest: dev
        ("w1", 2, "Beta", {"Team": " Data ", "Type": "PROD"}, t(1), None, 3),  # spaces, case
        ("w1", 3, "Gamma", {"team": "data", "Type": "prod"}, t(1), None, 4),   # lower-case key
        ("w1", 4, "Delta", {"Team": "data", "Type": "prod"}, t(1), None, 5),
        ("w1", 4, "Delta", {"Team": "data", "Type": "prod"}, t(3), t(3), 6),   # deleted now
        ("w1", 5, "Eps", {"Team": "data", "Type": "prod"}, t(5), None, 7),
        ("w1", 5, "eps2", {"Team": "data", "Type": "prod"}, t(5), None, 8),    # tie on time
        ("w2", 1, "Other", {"Team": "data", "Type": "prod"}, t(9), None, 9),   # other workspace
    ]
    return spark.createDataFrame(data, DDL)


def test_latest_versions_newest_with_tie_break(spark):
    out = D.latest_versions(versions(spark), tie_break="version_id")
    got = rows(out, "workspace_id", "job_id", "version_id")
    assert got == [("w1", 1, 2), ("w1", 2, 3), ("w1", 3, 4), ("w1", 4, 6), ("w1", 5, 8), ("w2", 1, 9)]


def test_latest_versions_plan_limits_before_shuffle(spark):
    out = D.latest_versions(versions(spark), tie_break="version_id")
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan


def test_workspace_filter(spark):
    out = D.latest_versions(versions(spark), where=F.col("workspace_id") == "w2")
    assert rows(out, "job_id", "version_id") == [(1, 9)]


def test_match_pairs_trim_case_and_duplicate_pairs(spark):
    latest = D.live(D.latest_versions(versions(spark), tie_break="version_id"))
    pairs = [("DATA", "prod"), ("data ", " PROD"), ("data", "Prod")]  # one pair three times
    out = D.match_pairs(latest, pairs)
    # job 1 is dev now, job 3 has no 'Team' key (keys are case-sensitive), job 4 deleted
    assert rows(out, "workspace_id", "job_id") == [("w1", 2), ("w1", 5), ("w2", 1)]


def test_exclude_skips_bad_ids(spark):
    df = spark.createDataFrame([(1,), (2,), (3,)], "job_id bigint")
    assert rows(D.exclude(df, ["2", "x", None, 3])) == [(1,)]
    assert rows(D.exclude(df, [])) == [(1,), (2,), (3,)]


def test_discover(spark):
    out = D.discover(versions(spark), [("data", "prod")], excluded=[5], workspace_id="w1",
                     tie_break="version_id")
    assert rows(out, "job_id") == [(2,)]


def test_find_by_name(spark):
    v = versions(spark)
    assert rows(D.find_by_name(v, "BETA")) == [(2,)]
    assert rows(D.find_by_name(v, "delta")) == []          # latest version deleted
    assert rows(D.find_by_name(v, "alpha", workspace_id="w1")) == [(1,)]
    assert rows(D.find_by_name(v, "Alpha", workspace_id="w9")) == []
    # Eps was renamed at the same time; the tie-break picks version 8 ("eps2")
    assert rows(D.find_by_name(v, "eps", tie_break="version_id")) == []
    assert rows(D.find_by_name(v, "EPS2", tie_break="version_id")) == [(5,)]
