"""Job discovery over the job version history.

The history has one row per change of a job. The operators pick the newest
version per job, keep the live ones whose Team/Type tags match configured
pairs, drop excluded ids, and look a job up by name.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from runlens.functions import trim_upper
from runlens.operators.common import frame_of, ids_frame


def latest_versions(versions: DataFrame, keys: Sequence[str] = ("workspace_id", "job_id"),
                    order_col: str = "change_time", tie_break: str | None = None,
                    where: Column | None = None) -> DataFrame:
    """The newest row per key by ``order_col`` (then ``tie_break``), both
    descending.

    ``row_number() = 1`` over a key window: Catalyst turns the filter into a
    partial ``WindowGroupLimit`` before the shuffle, so each map task sends at
    most one row per key; a job with a third of all versions costs no more
    shuffle than any other. ``where`` (e.g. the workspace filter) is applied
    first and is pushed to the scan.
    """
    if where is not None:
        versions = versions.where(where)
    order = [F.col(order_col).desc()]
    if tie_break:
        order.append(F.col(tie_break).desc())
    w = Window.partitionBy(*keys).orderBy(*order)
    return versions.withColumn("_rn", F.row_number().over(w)).where("_rn = 1").drop("_rn")


def live(versions: DataFrame) -> DataFrame:
    """Versions that are not deleted (``delete_time IS NULL``)."""
    return versions.where(F.col("delete_time").isNull())


def match_pairs(versions: DataFrame, pairs: Sequence[tuple[str, str]] | DataFrame,
                team: Column | str = "tags.Team", type_: Column | str = "tags.Type") -> DataFrame:
    """Versions whose (Team, Type) tags equal a configured pair, compared
    after trim + upper case on both sides.

    A left-semi join against the distinct pairs: a pair given twice (say in
    two cases) cannot duplicate a job. The pairs list is config sized and
    broadcast behind its length check.
    """
    spark = versions.sparkSession
    if isinstance(pairs, DataFrame):
        p = pairs.select(trim_upper(pairs.columns[0]).alias("_team"),
                         trim_upper(pairs.columns[1]).alias("_type")).distinct()
    else:
        rows = sorted({(str(a).strip().upper(), str(b).strip().upper()) for a, b in pairs})
        p = frame_of(spark, rows, "_team string, _type string")
    team_c = F.col(team) if isinstance(team, str) else team
    type_c = F.col(type_) if isinstance(type_, str) else type_
    keyed = versions.withColumn("_team", trim_upper(team_c)).withColumn("_type", trim_upper(type_c))
    return keyed.join(p, ["_team", "_type"], "left_semi").select(*versions.columns)


def exclude(df: DataFrame, ids, key: str = "job_id") -> DataFrame:
    """Rows whose key is not in ``ids`` (list or DataFrame). A NULL among the
    ids excludes nothing else (unlike SQL ``NOT IN``)."""
    if not isinstance(ids, DataFrame) and len(list(ids)) == 0:
        return df
    return df.join(ids_frame(df.sparkSession, ids, key), key, "left_anti").select(*df.columns)


def discover(versions: DataFrame, pairs, excluded=(), workspace_id: str | None = None,
             tie_break: str | None = None) -> DataFrame:
    """Jobs to watch: newest version per (workspace, job), live, matching a
    pair, not excluded. One row per (workspace_id, job_id).

    The exclusion is on a window key, so it is applied to the history
    before the window and excluded jobs never reach the shuffle.
    """
    where = F.col("workspace_id") == F.lit(workspace_id) if workspace_id else None
    latest = latest_versions(exclude(versions, excluded), tie_break=tie_break, where=where)
    return match_pairs(live(latest), pairs)


def find_by_name(versions: DataFrame, name: str, workspace_id: str | None = None,
                 tie_break: str | None = None) -> DataFrame:
    """The id of a live job named ``name`` (case-insensitive), at most one
    row; among several matches the smallest id is taken.

    Only jobs that ever carried the name can match, so those ids are found
    first (a filter at the scan) and the newest-version window runs over
    their history alone, not over the whole table.
    """
    if workspace_id:
        versions = versions.where(F.col("workspace_id") == F.lit(workspace_id))
    named = F.lower(F.col("name")) == F.lower(F.lit(name))
    keys = ["workspace_id", "job_id"]
    candidates = versions.where(named).select(*keys).distinct()
    history = versions.join(candidates, keys, "left_semi").select(*versions.columns)
    latest = live(latest_versions(history, tie_break=tie_break))
    return latest.where(named).select("job_id").orderBy("job_id").limit(1)
