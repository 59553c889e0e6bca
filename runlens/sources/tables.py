"""Table access: scans, existence tests and versioned writes.

Tables are plain Spark tables or parquet folders. A load never overwrites
the folder it reads: each batch writes a new version folder and returns its
path, so an executor lost half way leaves the old version whole, and the
caller switches to the new version only when every table of the batch is
written (see ``plans.load.publish``).
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession


def read_table(spark: SparkSession, name_or_path: str, fmt: str = "parquet") -> DataFrame:
    """A catalog table by name, or a folder of files by path."""
    if "/" in name_or_path or name_or_path.startswith(("file:", "s3", "abfs", "gs:", "hdfs:")):
        return spark.read.format(fmt).load(name_or_path)
    return spark.table(name_or_path)


def table_exists(spark: SparkSession, name: str) -> bool:
    return spark.catalog.tableExists(name)


def ensure_schema(spark: SparkSession, schema: str) -> None:
    """``CREATE SCHEMA IF NOT EXISTS``; catalogs are left to the platform."""
    if not spark.catalog.databaseExists(schema):
        spark.sql(f"CREATE SCHEMA IF NOT EXISTS {schema}")


def has_rows(df: DataFrame) -> bool:
    """Source probe / emptiness test: reads at most one row."""
    return not df.isEmpty()


def preview(df: DataFrame, n: int = 10) -> list:
    """Up to ``n`` rows for a log line (reads only what it returns)."""
    return df.limit(n).collect()


def version_path(base: str, table: str, version: str | int) -> str:
    return os.path.join(base, table, f"v={version}")


def write_version(df: DataFrame, base: str, table: str, version: str | int,
                  partition_by: list[str] | None = None) -> str:
    """Write ``df`` as a new version folder of ``table`` and return its path.

    Mode ``overwrite`` only touches this version's own folder, so a retried
    batch (same version id) replaces its own partial output and nothing else.
    """
    path = version_path(base, table, version)
    writer = df.write.mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    return path


def save_table(df: DataFrame, name: str, partition_by: list[str] | None = None,
               bucket_by: tuple[int, str] | None = None, path: str | None = None) -> str:
    """Write a catalog table (created on the first run, replaced later). The
    rows must not come from the table itself: stage them first. With
    ``bucket_by`` (number, column) rows are dealt by that column into sorted
    buckets, so joins and groups on it need no shuffle; ``path`` keeps the files
    in a folder of the caller's."""
    spark = df.sparkSession
    if "." in name:
        spark.sql(f"create schema if not exists {name.rsplit('.', 1)[0]}")
    writer = df.write.mode("overwrite").format("parquet")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if bucket_by:
        # one file a bucket, not one a task and bucket
        writer = df.repartition(bucket_by[0], bucket_by[1]).write.mode("overwrite").format("parquet")
        writer = writer.bucketBy(bucket_by[0], bucket_by[1]).sortBy(bucket_by[1])
    if path:
        writer = writer.option("path", path)
    writer = writer.option("compression", "zstd")
    writer.saveAsTable(name)
    return name
