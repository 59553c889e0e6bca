"""Bulk tag changes: plan, apply and summarise.

The plan is computed per job row from the job's tag map and the desired
tags (a handful of keys held as a literal array in the expression), so no
join fans jobs out against tags and nothing leaves the executors. Writing
the new tags back to the scheduler is outside Spark; ``apply_tags`` returns
the new map.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from runlens.operators.common import ids_frame
from runlens.schemas import REQUIRED_TAG_KEYS

NO_CHANGE = "no_change"
DRY_RUN = "dry_run"
UPDATED = "updated"
NOT_FOUND = "error: job not found"


def clean_desired(desired: Mapping[str, str | None], allowed: Sequence[str] = REQUIRED_TAG_KEYS) -> dict:
    """Allowed keys only, values trimmed, empty values dropped."""
    return {k: (v or "").strip() for k, v in desired.items() if k in allowed and (v or "").strip()}


def plan_tags(job_tags: DataFrame, desired: Mapping[str, str | None], overwrite: bool = True,
              dry_run: bool = True, job_ids=None, allowed: Sequence[str] = REQUIRED_TAG_KEYS) -> DataFrame:
    """Per job: the tag changes and a status.

    ``job_tags`` has job_id and ``tags`` (map). For each desired key (in
    ``allowed`` order): skip it when the job has the key and ``overwrite`` is
    off; a change when the old value (NULL if absent) differs from the new.
    Status: ``no_change`` without changes, else ``dry_run`` or ``updated``;
    an id in ``job_ids`` with no job row gets ``error: job not found``.
    Output: job_id, status, changes array<struct<key, old, new>>, tags (the
    job's current map, empty for a job without tags; NULL for unknown jobs). ``apply_tags`` gives the new
    map.
    """
    want = clean_desired(desired, allowed)
    ordered = [(k, want[k]) for k in allowed if k in want]
    # a job without tags (NULL map) is found and has an empty map
    empty = F.create_map().cast("map<string,string>")
    jt = job_tags.select("job_id", F.coalesce("tags", empty).alias("tags"), F.lit(True).alias("_found"))
    if job_ids is not None:
        ids = ids_frame(job_tags.sparkSession, job_ids).distinct()
        jt = ids.join(jt, "job_id", "left").withColumn("_found", F.coalesce("_found", F.lit(False)))
    tags = F.coalesce(F.col("tags"), empty)
    if ordered:
        wanted = F.array(*[F.struct(F.lit(k).alias("key"), F.lit(v).alias("new")) for k, v in ordered])
        proposed = F.transform(wanted, lambda d: F.struct(
            d["key"].alias("key"), tags[d["key"]].alias("old"), d["new"].alias("new")))
        keep = (lambda c: (F.lit(True) if overwrite else ~F.map_contains_key(tags, c["key"]))
                & ~c["old"].eqNullSafe(c["new"]))
        changes = F.filter(proposed, keep)
    else:
        changes = F.array().cast("array<struct<key:string,old:string,new:string>>")
    status = (F.when(~F.col("_found"), F.lit(NOT_FOUND))
              .when(F.size("changes") == 0, F.lit(NO_CHANGE))
              .otherwise(F.lit(DRY_RUN if dry_run else UPDATED)))
    return (jt.withColumn("changes", F.when(F.col("_found"), changes))
            .withColumn("status", status)
            .select("job_id", "status", "changes", "tags"))


def apply_tags(plan: DataFrame) -> DataFrame:
    """job_id and the new tag map: old entries not changed, plus changed
    keys with their new values (no duplicate keys, so no dedup policy is
    involved)."""
    changed = F.transform("changes", lambda c: c["key"])
    kept = F.map_filter("tags", lambda k, v: ~F.array_contains(changed, k))
    new = F.map_from_entries(F.transform("changes", lambda c: F.struct(c["key"], c["new"])))
    merged = F.when(F.size("changes") > 0, F.map_concat(kept, new)).otherwise(F.col("tags"))
    return plan.where(F.col("tags").isNotNull()).select("job_id", merged.alias("tags"))


def plan_rows(plan: DataFrame) -> DataFrame:
    """The plan as one row per change: job_id, status, key, old_value,
    new_value."""
    return plan.select("job_id", "status", F.explode("changes").alias("c")).select(
        "job_id", "status", F.col("c.key").alias("key"), F.col("c.old").alias("old_value"),
        F.col("c.new").alias("new_value"))


def tag_summary(plan: DataFrame) -> DataFrame:
    """Counts per status kind: updated, dry run, no change, errors (one
    row)."""
    s = F.col("status")
    return plan.agg(F.count_if(s == UPDATED).alias("updated"), F.count_if(s == DRY_RUN).alias("dry_run"),
                    F.count_if(s == NO_CHANGE).alias("no_change"),
                    F.count_if(s.startswith("error")).alias("errors"))
