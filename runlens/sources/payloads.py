"""Landed payload sources: JSON text (one document per row or line) or
nested parquet, parsed with an explicit schema.

A payload that does not parse is kept apart instead of failing the batch:
``parse_json`` adds the raw text of bad rows in ``_corrupt_record`` and
``split_bad`` returns (good, bad), so one bad document for one job leaves
the other jobs' rows untouched.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from runlens import schemas

CORRUPT = "_corrupt_record"


def _with_corrupt(schema: T.StructType) -> T.StructType:
    if CORRUPT in schema.fieldNames():
        return schema
    return T.StructType(schema.fields + [T.StructField(CORRUPT, T.StringType(), True)])


def parse_json(df: DataFrame, column: str, schema: T.StructType,
               keep: list[str] | None = None) -> DataFrame:
    """Parse a JSON text column into top-level columns of ``schema``.

    PERMISSIVE mode: a malformed document gives NULL fields and its text in
    ``_corrupt_record``. ``keep`` lists input columns carried along.
    """
    parsed = F.from_json(
        F.col(column), _with_corrupt(schema),
        {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT},
    ).alias("_p")
    return df.select(*(keep or []), parsed).select(*(keep or []), "_p.*")


def split_bad(parsed: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rows that parsed, rows that did not); drops the corrupt column from
    the good side. For raw JSON files Spark refuses a query that reads only
    the corrupt column (e.g. ``bad.count()``); save or show the bad side
    (all columns) instead."""
    bad = parsed.where(F.col(CORRUPT).isNotNull())
    good = parsed.where(F.col(CORRUPT).isNull()).drop(CORRUPT)
    return good, bad


def read_json_payloads(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """JSON-lines files of payloads; the explicit schema prunes at parse."""
    return (spark.read.schema(_with_corrupt(schema))
            .option("mode", "PERMISSIVE")
            .option("columnNameOfCorruptRecord", CORRUPT)
            .json(path))


def read_run_payloads(spark: SparkSession, path: str, fmt: str = "json") -> DataFrame:
    if fmt == "json":
        return read_json_payloads(spark, path, schemas.RUN_PAYLOAD)
    return spark.read.format(fmt).load(path)


def read_job_payloads(spark: SparkSession, path: str, fmt: str = "json") -> DataFrame:
    if fmt == "json":
        return read_json_payloads(spark, path, schemas.JOB_PAYLOAD)
    return spark.read.format(fmt).load(path)


def outputs_from_payloads(payloads: DataFrame) -> DataFrame:
    """Failed-task output documents (``metadata.run_id`` …) to the flat
    ``run_outputs`` shape: run_id, notebook_output, error, error_trace,
    original_attempt_run_id (ids stay text as the documents carry them)."""
    return payloads.select(
        F.col("metadata.run_id").alias("run_id"),
        F.col("notebook_output").cast("string").alias("notebook_output"),
        "error",
        "error_trace",
        F.col("metadata.original_attempt_run_id").alias("original_attempt_run_id"),
    )
