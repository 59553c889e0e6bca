"""Helpers shared by the operators."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def frame_of(spark: SparkSession, rows: Sequence[tuple], ddl: str) -> DataFrame:
    """A DataFrame from driver rows (pairs, id lists, tag sets). The planner
    knows a local relation's size and picks the join by it."""
    return spark.createDataFrame(list(rows), ddl)


def ids_frame(spark: SparkSession, ids, name: str = "job_id") -> DataFrame:
    """Job ids given as a list (ints or digit strings; others are skipped)
    or as a DataFrame with an id column."""
    if isinstance(ids, DataFrame):
        return ids.select(F.col(name).cast("long").alias(name)).where(F.col(name).isNotNull())
    clean = []
    for i in ids:
        try:
            clean.append((int(str(i).strip()),))
        except ValueError:
            continue
    return frame_of(spark, clean, f"{name} long")
