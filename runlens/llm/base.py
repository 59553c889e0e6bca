"""Reading shared tables and landing intermediate ones in the shared folder."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def session_of(df: DataFrame) -> SparkSession:
    return df.sparkSession


class Landing:
    """Intermediate tables of one operator call, written as parquet below the
    folder in ``spark.checkpoint.dir``: executors that are lost later cost a
    read, not a recomputation. ``drop`` removes tables that later ones
    replaced; the others are left to the cluster's clean-up."""

    def __init__(self, spark: SparkSession, label: str):
        self.spark = spark
        self.root = scratch_path(spark, "llm", f"{label}-{uuid.uuid4().hex[:12]}")
        self.paths: dict[str, str] = {}

    def put(self, df: DataFrame, name: str) -> DataFrame:
        path = f"{self.root}/{name}-{len(self.paths)}"
        df.write.mode("overwrite").parquet(path)
        self.paths[name] = path
        return self.spark.read.schema(df.schema).parquet(path)

    def drop(self, *names: str) -> None:
        jvm = self.spark._jvm
        conf = self.spark._jsc.hadoopConfiguration()
        for name in names:
            path = self.paths.get(name)
            if path:
                p = jvm.org.apache.hadoop.fs.Path(path)
                p.getFileSystem(conf).delete(p, True)


BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"


def batches(spark: SparkSession, mb: int | None) -> None:
    """Bound the Arrow batches that Python tasks are given from now on by
    bytes, whatever the length of texts (None: by Spark's number of rows only).
    A bound that the session was given by others stays."""
    now, own = spark.conf.get(BATCH_BYTES, None), spark.conf.get("runlens.llm.batches", None)
    if now is not None and now != own:
        return
    if mb is None:
        spark.conf.unset(BATCH_BYTES)
        spark.conf.unset("runlens.llm.batches")
    else:
        spark.conf.set(BATCH_BYTES, str(mb << 20))
        spark.conf.set("runlens.llm.batches", str(mb << 20))


def shuffle_width(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def texts_of(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Only the id and the whole text (null: empty), under internal names."""
    return docs.select(F.col(id_col).alias("doc_id"),
                       F.coalesce(F.col(text_col), F.lit("")).alias("text"))
