"""Keyed upsert family, as DataFrame-in / DataFrame-out operators.

``upsert`` replaces matched rows and inserts new ones (update-all /
insert-all). ``mark_missing`` flags rows whose key was not seen (soft
delete). ``fill_missing`` sets a column only where it is NULL. They return
the new table; the caller writes it as a new version (``sources.tables``).
On a catalog with row-level writes the same step is ``df.mergeInto``
(``merge_into`` below).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from runlens.schemas import DELETED_YES


def latest_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """One row per key: the first by ``order``. The ``= 1`` filter becomes a
    partial ``WindowGroupLimit`` before the shuffle, so a hot key sends at
    most one row per map task."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).where("_rn = 1").drop("_rn")


class DuplicateKeyError(ValueError):
    pass


def check_unique(df: DataFrame, keys: Sequence[str]) -> None:
    """Raise ``DuplicateKeyError`` if a key occurs twice. One aggregation
    (partial counts before the shuffle); reads at most one offending key."""
    dup = df.groupBy(*keys).count().where("count > 1").limit(1).collect()
    if dup:
        raise DuplicateKeyError(f"duplicate key {dict(dup[0].asDict())} in {list(keys)}")


def upsert(target: DataFrame | None, source: DataFrame, keys: Sequence[str],
           order: Sequence[Column] | None = None) -> DataFrame:
    """New table = target rows whose key is not in source, plus all source
    rows. Columns are matched by name; a column only one side has is NULL on
    the other.

    With ``order`` the source is first cut to its newest row per key (a batch
    that saw the same run twice); without it the source must be unique (see
    ``check_unique``). ``target=None`` is the first load.

    Plan: a left-anti join on the key. Run and task ids are unique, so there
    is no hot key; a small batch is broadcast by AQE from its measured size,
    a large one goes sort-merge.
    """
    keys = list(keys)
    if order is not None:
        source = latest_per_key(source, keys, order)
    if target is None:
        return source
    kept = target.join(source.select(*keys), keys, "left_anti").select(*target.columns)
    return kept.unionByName(source, allowMissingColumns=True)


def newest(target: DataFrame | None, source: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """The row to keep per key of ``source``: the first by ``order`` among the
    source's rows and the target's row. With an order that does not depend on
    arrival, any sequence of batches leads to the same table."""
    if target is not None:
        old = target.join(source.select(*keys).distinct(), list(keys), "left_semi")
        source = source.unionByName(old, allowMissingColumns=True)
    return latest_per_key(source, keys, order)


def mark_missing(target: DataFrame, seen, key: str = "job_id", flag: str = "is_job_deleted",
                 keep=None) -> DataFrame:
    """Set ``flag`` to 'yes' for rows whose key is not in ``seen``.

    ``seen`` holds the ids found this time (DataFrame with ``key``). ``keep``
    (optional DataFrame of ids) are left as they are, for jobs deliberately
    excluded from discovery. A NULL flag counts as live. NULL ids in
    ``seen`` mark nothing (no ``NOT IN`` trap).
    """
    seen_ids = seen.select(key).where(F.col(key).isNotNull()).distinct().withColumn("_seen", F.lit(True))
    out = target.join(seen_ids, key, "left")
    missing = F.col("_seen").isNull()
    if keep is not None:
        keep_ids = keep.select(key).where(F.col(key).isNotNull()).distinct().withColumn("_keep", F.lit(True))
        out = out.join(keep_ids, key, "left")
        missing = missing & F.col("_keep").isNull()
    new_flag = F.when(missing, F.lit(DELETED_YES)).otherwise(F.col(flag))
    cols = [new_flag.alias(flag) if c == flag else F.col(c) for c in target.columns]
    return out.select(*cols)


def fill_missing(target: DataFrame, source: DataFrame, key: str, column: str,
                 source_key: str | None = None, source_column: str | None = None) -> DataFrame:
    """Set ``column`` from ``source`` where the target value is NULL; other
    rows and columns are untouched. The source is cut to one value per key
    (the largest) so a repeated key cannot multiply target rows."""
    source_key = source_key or key
    source_column = source_column or column
    dtype = dict(target.dtypes)[column]
    src = (source.select(F.col(source_key).cast(dict(target.dtypes)[key]).alias(key),
                         F.col(source_column).cast(dtype).alias("_fill"))
           .where(F.col(key).isNotNull() & F.col("_fill").isNotNull())
           .groupBy(key).agg(F.max("_fill").alias("_fill")))
    out = target.join(src, key, "left")
    cols = [F.coalesce(F.col(c), F.col("_fill")).alias(c) if c == column else F.col(c)
            for c in target.columns]
    return out.select(*cols)


def merge_into(table: str, source: DataFrame, keys: Sequence[str]) -> None:
    """Row-level upsert into a catalog table that supports it (``MERGE``),
    through the DataFrame API. Parquet tables do not; use ``upsert``."""
    name = table.split(".")[-1]
    cond = F.lit(True)
    for k in keys:
        cond = cond & (F.col(f"{name}.{k}") == F.col(f"s.{k}"))
    (source.alias("s").mergeInto(table, cond)
     .whenMatched().updateAll()
     .whenNotMatched().insertAll()
     .merge())
