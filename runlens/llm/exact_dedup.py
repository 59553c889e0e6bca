"""Exact duplicates by an extendible-hash index on shared files.

Texts are keyed by a 64-bit hash. The index is a directory of key prefixes and
bucket files. A bucket starts as the whole key range; while one holds more
bytes of distinct keys than it may, the directory doubles and the bucket splits
by the next bit of its keys. Buckets are ranges of keys, dealt in order to
owner tasks; each owner takes the texts of its range, compares their bytes, and
writes one entry for each different text. Different texts under one key form a
chain. A document finds its entry by key where the chain has one link, and by
key and bytes where it has more.

Spark expressions only. What is large moves once: a text goes to its owner in
one shuffle. Keys that a thousandth of all rows or more have (at most a
thousand, so their list is broadcast) are reduced by a partial aggregation
before the shuffle, and their documents find their entries by a broadcast join;
other documents are joined by key on 16-byte rows.

The directory holds at most twice ``per_owner`` splits an owner task, in
proportion to ``spark.sql.shuffle.partitions`` and not to the data; it is
worked out from key counts at one depth and deepened only for the slots of it
that are overfull and hold more than one key.

Defined cases: a null text is empty; every row is returned, rows that repeat an
id too; of rows that have the kept id and the same text, one is kept; a null id
is smaller than any other (a group of null ids only keeps one of its rows,
``keep_id`` null); an empty table gives an empty one. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Callable
from math import ceil, log2
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import base

HOT_SHARE = 1000        # a key with a thousandth of all rows is hot
PER_OWNER = 8           # buckets an owner task takes, about
KEY_BITS = 64


class Index(NamedTuple):
    directory: DataFrame    # prefix, depth, first, bucket, owner, n_keys, bytes
    entries: DataFrame      # bucket, key, link, text, keep_id, group_size, links
    hot: DataFrame          # keys that a thousandth of all rows have


def key_of(text: Column) -> Column:
    return F.xxhash64(text)


def prefix_of(key: Column, depth: int) -> Column:
    """The first ``depth`` bits of a key, counted from its smallest value up."""
    if depth == 0:
        return F.lit(0).cast("long")
    ordered = key.bitwiseXOR(F.lit(-(1 << 63)))
    return F.shiftrightunsigned(ordered, KEY_BITS - depth)


def directory_of(keys: DataFrame, land: base.Landing, bucket_bytes: int, owners: int, start_depth: int) -> DataFrame:
    """Buckets as (prefix, depth), none of more than ``bucket_bytes`` unless it
    holds one key. ``keys`` has one row a key, with its ``bytes``.

    A prefix of any depth is overfull or not by itself, so one pass over the
    slots of ``start_depth`` settles all doublings up to it; slots that are
    overfull there go on by eight bits, with their own keys only."""
    done, rest, low = None, keys, 0
    depth = start_depth
    while True:
        slots = land.put(rest.groupBy(prefix_of(F.col("key"), depth).alias("slot")).agg(
            F.count("*").alias("n_keys"), F.sum("bytes").alias("bytes")), f"slots{depth}")
        levels = slots.select("slot", "n_keys", "bytes", F.explode(F.sequence(F.lit(low), F.lit(depth))).alias("depth"))
        levels = (levels.withColumn("prefix", F.expr(f"shiftrightunsigned(slot, {depth} - depth)"))
                  .groupBy("depth", "prefix").agg(F.sum("n_keys").alias("n_keys"), F.sum("bytes").alias("bytes")))
        levels = land.put(levels.withColumn("full", (F.col("bytes") > bucket_bytes) & (F.col("n_keys") > 1)),
                          f"levels{depth}")
        # a bucket: not overfull itself, but the half-as-deep one it came from was
        above = levels.where("full").select((F.col("depth") + 1).alias("depth"), F.col("prefix").alias("up"))
        fit = levels.where("not full").withColumn("up", F.expr("shiftrightunsigned(prefix, 1)"))
        split = fit.join(above, ["depth", "up"], "left_semi").unionByName(fit.where(F.col("depth") == low))
        buckets = split.select("prefix", "depth", "n_keys", "bytes")
        done = buckets if done is None else done.unionByName(buckets)
        over = levels.where(F.col("full") & (F.col("depth") == depth)).select(F.col("prefix").alias("slot"))
        if depth >= KEY_BITS or over.isEmpty():
            break
        rest = land.put(rest.withColumn("slot", prefix_of(F.col("key"), depth)).join(over, "slot", "left_semi")
                        .drop("slot"), f"rest{depth}")
        low, depth = depth + 1, min(KEY_BITS, depth + 8)
    # in key order, so that an owner's buckets are one range of keys; a few rows an owner
    first = F.expr(f"if(depth = 0, 0L, shiftleft(prefix, {KEY_BITS} - depth))").bitwiseXOR(F.lit(-(1 << 63)))
    order = Window.orderBy("first")
    before = F.coalesce(F.sum("bytes").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    total = F.sum("bytes").over(order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    return (done.withColumn("first", first)
            .withColumn("bucket", F.row_number().over(order) - 1)
            .withColumn("owner", F.least(F.lit(owners - 1), F.floor(before * owners / F.greatest(total, F.lit(1)))).cast("int"))
            .select("prefix", "depth", "first", "bucket", "owner", "n_keys", "bytes"))


def build(docs: DataFrame, key: Callable[[Column], Column] = key_of, bucket_bytes: int | None = None,
          land: base.Landing | None = None) -> tuple[Index, DataFrame]:
    """The index of ``docs`` (``doc_id``, ``text``) and its documents' rows
    (``row``, ``doc_id``, ``key``, ``bytes``, ``text_sha256``)."""
    spark = base.session_of(docs)
    land = land or base.Landing(spark, "exact-dedup")
    owners = base.shuffle_width(spark)
    texts = base.texts_of(docs)
    rows = land.put(texts.select(F.monotonically_increasing_id().alias("row"), "doc_id", key(F.col("text")).alias("key"),
                                 F.octet_length("text").cast("long").alias("bytes"),
                                 F.sha2(F.col("text").cast("binary"), 256).alias("text_sha256")), "rows")
    keys = land.put(rows.groupBy("key").agg(F.count("*").alias("n"), F.max("bytes").alias("bytes")), "keys")
    total = keys.agg(F.sum("n").alias("n"), F.sum("bytes").alias("bytes")).first()
    n_rows, n_bytes = total["n"] or 0, total["bytes"] or 0
    hot = land.put(keys.where(F.col("n") * HOT_SHARE >= max(n_rows, HOT_SHARE * 2)).select("key").coalesce(1), "hot")

    room = bucket_bytes or max(1, n_bytes // (owners * PER_OWNER))
    depth = min(KEY_BITS - 8, max(1, ceil(log2(max(2, n_bytes / room))) + 1))
    directory = land.put(directory_of(keys, land, room, owners, depth), "directory")

    keyed = texts.withColumn("key", key(F.col("text")))
    cold = in_buckets(keyed.join(F.broadcast(hot), "key", "left_anti"), directory, depth)
    # owner tasks: ranges of keys come together, equal bytes become one entry
    cold = (cold.repartitionById(owners, F.col("owner"))
            .groupBy("owner", "bucket", "key", "text").agg(F.max("doc_id").alias("keep_id"), F.count("*").alias("group_size")))
    # hot keys: reduced where they are read, then brought to their buckets
    warm = (keyed.join(F.broadcast(hot), "key", "left_semi").groupBy("key", "text")
            .agg(F.max("doc_id").alias("keep_id"), F.count("*").alias("group_size")))
    warm = in_buckets(warm, directory, depth)

    def chained(entries: DataFrame) -> DataFrame:
        chain = Window.partitionBy("owner", "bucket", "key")
        return (entries.withColumn("link", F.row_number().over(chain.orderBy("keep_id", "text")))
                .withColumn("links", F.count("*").over(chain))
                .select("bucket", "key", "link", "links", "text", "keep_id", "group_size"))

    entries = land.put(chained(cold).unionByName(chained(warm)), "buckets")
    return Index(directory, entries, hot), rows


def in_buckets(keyed: DataFrame, directory: DataFrame, depth: int) -> DataFrame:
    """Rows with a ``key``, given their ``bucket`` and ``owner``. A slot of the
    directory's global ``depth`` points to its bucket, or to the few buckets
    that it was split into further down, in key order."""
    shallow = directory.where(F.col("depth") <= depth).select(
        F.explode(F.expr(f"sequence(shiftleft(prefix, {depth} - depth), shiftleft(prefix + 1, {depth} - depth) - 1)"))
        .alias("slot"), "first", "bucket", "owner")
    deep = directory.where(F.col("depth") > depth).select(
        F.expr(f"shiftrightunsigned(prefix, depth - {depth})").alias("slot"), "first", "bucket", "owner")
    slots = (shallow.unionByName(deep).groupBy("slot")
             .agg(F.sort_array(F.collect_list(F.struct("first", "bucket", "owner"))).alias("at")))
    at = F.element_at(F.filter("at", lambda b: b["first"] <= F.col("key")), -1)
    found = keyed.withColumn("slot", prefix_of(F.col("key"), depth)).join(F.broadcast(slots), "slot")
    return found.withColumn("at", at).withColumn("bucket", F.col("at.bucket")).withColumn("owner", F.col("at.owner")).drop("at", "slot")


def matched(docs: DataFrame, key: Callable[[Column], Column] = key_of, bucket_bytes: int | None = None) -> DataFrame:
    """Every document with the one that stays of its group: ``doc_id``,
    ``keep_id``, ``group_size``, ``kept``, ``text_sha256``."""
    land = base.Landing(base.session_of(docs), "exact-dedup")
    index, rows = build(docs, key, bucket_bytes, land)
    entries, hot = index.entries.drop("text"), F.broadcast(index.hot)
    # by key: what copies have one entry for, and which keys have a chain
    one = entries.where((F.col("links") == 1) & (F.col("group_size") > 1)).select("key", "link", "links", "keep_id", "group_size")
    many = entries.where((F.col("links") > 1) & (F.col("link") == 1)).select(
        "key", "link", "links", F.lit(None).cast("long").alias("keep_id"), F.lit(None).cast("long").alias("group_size"))
    probe = one.unionByName(many)
    by_hot = rows.join(hot, "key", "left_semi").join(F.broadcast(probe.join(hot, "key", "left_semi")), "key")
    by_key = rows.join(hot, "key", "left_anti").join(probe, "key", "left")
    columns = ["row", "doc_id", "text_sha256", "key", "link", "keep_id", "group_size"]
    alone = F.col("links").isNull()
    plain = (by_hot.unionByName(by_key, allowMissingColumns=True).where(alone | (F.col("links") == 1))
             .withColumn("keep_id", F.when(alone, F.col("doc_id")).otherwise(F.col("keep_id")))
             .withColumn("group_size", F.coalesce("group_size", F.lit(1))).select(*columns))
    # chains: the bytes decide which link a document is (texts move for that
    # only where there are chains at all)
    chains = index.entries.where("links > 1")
    if not chains.isEmpty():
        keyed = base.texts_of(docs).withColumn("key", key(F.col("text")))
        chained = (keyed.join(chains.select("key").distinct(), "key", "left_semi")
                   .withColumn("row", -1 - F.monotonically_increasing_id())
                   .withColumn("text_sha256", F.sha2(F.col("text").cast("binary"), 256))
                   .join(chains.select("key", "text", "link", "keep_id", "group_size"), ["key", "text"]).select(*columns))
        plain = plain.unionByName(chained)
    found = land.put(plain, "found")
    # rows that share the id that stays and the text: the first stays
    best = F.col("doc_id").eqNullSafe(F.col("keep_id"))
    tied = found.where(best & (F.col("group_size") > 1))
    ties = tied.groupBy("key", "link").agg(F.count("*").alias("n"), F.min("row").alias("stays")).where("n > 1")
    goes = tied.join(ties, ["key", "link"]).where("row <> stays").select("row", F.lit(True).alias("goes"))
    return (found.join(goes, "row", "left")
            .select("doc_id", "keep_id", F.col("group_size").cast("long").alias("group_size"),
                    (best & F.col("goes").isNull()).alias("kept"), "text_sha256"))


SQL = """
select doc_id, max(doc_id) over same as keep_id, count(*) over same as group_size,
  row_number() over (partition by coalesce(text, '') order by doc_id desc nulls last) = 1 as kept,
  sha256(coalesce(text, '')) as text_sha256
from documents window same as (partition by coalesce(text, ''))
"""
