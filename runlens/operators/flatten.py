"""Nested payloads to flat table rows.

All flattening is struct/map access and ``explode`` inside one ``select``:
no Python per row. A missing nested part gives NULL (struct field access
on a NULL struct is NULL, a missing map key is NULL). Payload fields not in
the schema are never read.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from runlens import schemas
from runlens.functions import trim_lower, trim_upper
from runlens.schemas import DELETED_NO


def _path(p: str) -> Column:
    """Nested access by a dotted path; ``settings.tags.Team`` reads a map key."""
    return F.col(p)


def filter_tags(tags: Column, keys: Sequence[str]) -> Column:
    """Keep only allowed tag keys (exact, case-sensitive) in a tag map."""
    allowed = F.array(*[F.lit(k) for k in keys])
    return F.map_filter(tags, lambda k, v: F.array_contains(allowed, k))


def flatten_jobs(payloads: DataFrame, tag_keys: Sequence[str] | None = None,
                 host: str | None = None, deleted_flag: str = DELETED_NO) -> DataFrame:
    """Job documents (top-level columns of ``JOB_PAYLOAD``) to job rows.

    One ``job__tags__{Key}`` column per allowed key in sorted order; tags of
    other keys are dropped. ``Job_link`` is ``https://{host}/jobs/{id}``,
    NULL without a host or an id. Every staged job is live
    (``is_job_deleted = deleted_flag``).
    """
    keys = schemas.tag_keys() if tag_keys is None else sorted(tag_keys)
    tags = filter_tags(F.col("settings.tags"), keys)
    cols = []
    for name, path, dtype in schemas.job_columns(keys):
        if name == "is_job_deleted":
            c = F.lit(deleted_flag)
        elif name == "Job_link":
            c = (F.concat(F.lit(f"https://{host}/jobs/"), F.col("job_id").cast("string"))
                 if host else F.lit(None))
        elif name.startswith("job__tags__"):
            c = tags.getItem(name[len("job__tags__"):])
        else:
            c = _path(path)
        cols.append(c.cast(dtype).alias(name))
    return payloads.select(*cols)


def normalise_tags(df: DataFrame, keys: Sequence[str] | None = None,
                   upper_keys: Sequence[str] = schemas.UPPER_TAG_KEYS) -> DataFrame:
    """Trim and lower-case every tag column, except ``upper_keys``
    (Priority) which are trimmed and upper-cased. NULL stays NULL. One
    projection, no shuffle."""
    keys = schemas.tag_keys() if keys is None else list(keys)
    targets = {schemas.tag_column(k): (trim_upper if k in upper_keys else trim_lower) for k in keys}
    return df.select(*[targets[c](F.col(c)).alias(c) if c in targets else F.col(c) for c in df.columns])


def run_tasks_summary(tasks: Column) -> Column:
    """The run row's ``job_tasks``: per task a map of those of six long fields
    that it has; no tasks: an empty list."""
    maps = F.transform(tasks, lambda t: F.map_filter(
        F.create_map(*[x for k in schemas.RUN_TASK_KEYS for x in (F.lit(k), t[k])]), lambda k, v: v.isNotNull()))
    return F.coalesce(maps, F.array().cast("array<map<string,bigint>>"))


def _text_map(text: Column) -> Column:
    """A JSON object as map<string,string>: nested values stay JSON text; NULL
    for anything else."""
    return F.from_json(text, "map<string,string>")


def trigger_numbers(text: Column) -> Column:
    """``trigger_info``: its numbers; a value that is none is NULL."""
    return F.transform_values(_text_map(text), lambda k, v: v.try_cast("bigint"))


def parameter_maps(text: Column) -> Column:
    """``overriding_parameters``: a map per kind; a kind that holds something
    else (a list) keeps it as JSON text under the key ``json``."""
    return F.transform_values(_text_map(text), lambda k, v: F.coalesce(_text_map(v), F.create_map(F.lit("json"), v)))


def flatten_runs(payloads: DataFrame) -> DataFrame:
    """Run documents (top-level columns of ``RUN_PAYLOAD``) to run rows, in
    the table's column order. Fields of varying form come as JSON text and
    never cost the document; typed columns are taken as they are."""
    varying = {"trigger_info": trigger_numbers, "overriding_parameters": parameter_maps}
    types = dict(payloads.dtypes)
    cols = []
    for name, path, dtype in schemas.RUN_COLUMNS:
        c = run_tasks_summary(F.col("tasks")) if name == "job_tasks" else _path(path)
        if path in varying and types.get(path) == "string":
            c = varying[path](F.col(path))
        cols.append(c.cast(dtype).alias(name))
    return payloads.select(*cols)


def flatten_tasks(payloads: DataFrame) -> DataFrame:
    """Run documents to task rows: one row per element of ``tasks``, with
    the run's id as ``task_job_run_id``.

    A run without tasks (or without the key) yields no task row and no
    error. ``notebook_task.base_parameters`` is dropped, ``run_job_task`` is
    NULL, ``new_cluster`` is never read.
    """
    t = payloads.select(F.col("run_id").alias("job_run_id"), F.explode("tasks").alias("t"))
    cols = []
    for name, path, dtype in schemas.TASK_COLUMNS:
        if path is None:
            c = F.lit(None)
        elif path == "job_run_id":
            c = F.col("job_run_id")
        elif path == "notebook_task":
            c = F.map_filter(F.col("t.notebook_task"), lambda k, v: k != F.lit("base_parameters"))
        else:
            c = F.col(f"t.{path}")
        cols.append(c.cast(dtype).alias(name))
    return t.select(*cols)
