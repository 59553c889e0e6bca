"""Exact top-k search by inner product with a vector-approximation file.

Every vector is kept twice: as whole numbers, and as the grid cells its
components fall into (a byte each). The cells alone bound a vector's score
from both sides. First the cells are scanned: the k best lower bounds of a
query, over all chunks, give a score that its k-th result reaches at least.
Then, with that bound, each chunk reads the exact vectors in order of their
upper bounds until its own k-th result is above all upper bounds that are
left. Both steps go over blocks of queries and chunks of vectors; only k rows
a query and chunk come out of either. Chunks stay in their part; a block is
copied to every part that has chunks of its length. Blocks and chunks meet by a
merge join at any size: the planner sees the blocks' files, not the copies, and
would broadcast all of these.

Defined cases: vectors that are null or hold a null or non-finite component,
and rows with a null id, take no part; an empty vector scores 0 with empty
ones; vectors are only compared with those of their own length; a query does
not find rows of its own id; equal scores go to the smaller id; fewer than k
candidates: all of them. An id with several vectors is one query, and finds a
row with the best score over them; every row is a candidate of its own, rows
that repeat an id too. Scores are exact; a table whose components are so large
that a score might not fit 64 bits raises an error.
"""

from __future__ import annotations

import numpy as np
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import base

CHUNK = 4096
BLOCK = 1024
LEVELS = 256
PACKED = "part int, dim int, first long, ids binary, cells binary, exact binary"


def whole_numbers(vec: Column, scale: int = 256) -> Column:
    return F.transform(vec, lambda x: F.floor(F.lit(float(scale)) * x.cast("double")))


def usable(vec: Column) -> Column:
    return vec.isNotNull() & F.forall(vec, lambda x: x.isNotNull() & ~F.isnan(x)
                                      & (F.abs(x.cast("double")) < float("inf")))


def matrix(batch, name: str, dim: int) -> np.ndarray:
    return batch.column(name).flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(-1, dim)


def pack(rows: DataFrame, size: int, parts: int, low: int, width: int) -> DataFrame:
    """Rows (vec_id, v, dim) as chunks of at most ``size`` vectors."""

    def run(batches):
        import pyarrow as pa

        n = TaskContext.get().partitionId() << 40          # rows are told apart by number
        for batch in batches:
            dims = batch.column("dim").to_numpy()
            for dim in np.unique(dims):
                own = batch.filter(pa.array(dims == dim))
                for i in range(0, own.num_rows, size):
                    cut = own.slice(i, size)
                    v = matrix(cut, "v", int(dim)) if dim else np.zeros((cut.num_rows, 0), np.int64)
                    ids = cut.column("vec_id").to_numpy()
                    part = int(ids[0]) * 0x9E3779B97F4A7C15 % 2 ** 64 // 2 ** 33 % parts
                    cells = ((v - low) // width).astype(np.uint8)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([part], pa.int32()), pa.array([dim], pa.int32()), pa.array([n], pa.int64()),
                         pa.array([ids.tobytes()]), pa.array([cells.tobytes()]), pa.array([v.tobytes()])],
                        names=["part", "dim", "first", "ids", "cells", "exact"])
                    n += cut.num_rows

    return rows.mapInArrow(run, PACKED)


def product(a: np.ndarray, b: np.ndarray, exact_floats: bool) -> np.ndarray:
    """a @ b.T; in doubles where all partial sums are whole numbers they hold."""
    if exact_floats:
        return (a.astype(np.float64) @ b.astype(np.float64).T).astype(np.int64)
    return a @ b.T


def bounds(q: np.ndarray, cells: np.ndarray, low: int, width: int, floats: bool, upper: bool) -> np.ndarray:
    """Upper or lower bounds of every query's score with every vector."""
    lo = cells.astype(np.int64) * width + low
    hi = lo + (width - 1)
    up, down = np.maximum(q, 0), np.minimum(q, 0)
    if upper:
        return product(up, hi, floats) + product(down, lo, floats)
    return product(up, lo, floats) + product(down, hi, floats)


def dealt(blocks: DataFrame, chunks: DataFrame) -> DataFrame:
    """A copy of each block for every part with chunks of its length. Only the
    list of parts by length is broadcast."""
    parts = chunks.groupBy("dim").agg(F.collect_set("part").alias("parts"))
    return (blocks.join(F.broadcast(parts), "dim").withColumn("part", F.explode("parts")).drop("parts")
            .hint("merge"))


def fits(vecs: DataFrame, width: int, dims: int) -> bool:
    """Whether the two longest vectors' product, cells and all, fits 64 bits."""
    length = F.sqrt(F.aggregate("v", F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double")))
    longest = [r["length"] for r in vecs.select(length.alias("length")).orderBy(F.col("length").desc()).limit(2).collect()]
    return len(longest) < 2 or longest[0] * (longest[1] + width * dims ** 0.5) < 2.0 ** 63


def search(rows: DataFrame, queries: Column, k: int = 5, scale: int = 256, id_col: str = "vec_id",
           vector_col: str = "embedding") -> DataFrame:
    """``query_id``, ``rank`` (from 1), ``vec_id``, ``score`` for every row
    with ``queries`` true, against all rows."""
    spark = base.session_of(rows)
    land = base.Landing(spark, "topk")
    parts = base.shuffle_width(spark)
    vecs = (rows.where(F.col(id_col).isNotNull() & usable(F.col(vector_col)))
            .select(F.col(id_col).cast("long").alias("vec_id"), whole_numbers(F.col(vector_col), scale).alias("v"),
                    F.coalesce(queries, F.lit(False)).alias("query"))
            .withColumn("dim", F.size("v")))
    span = vecs.where("dim > 0").agg(F.min(F.array_min("v")).alias("low"), F.max(F.array_max("v")).alias("high"),
                                     F.max("dim").alias("dim")).first()
    low, high, dims = int(span["low"] or 0), int(span["high"] or 0), int(span["dim"] or 1)
    width = (high - low) // LEVELS + 1
    most = max(abs(low), abs(high)) + width
    if most * most * dims >= 2 ** 63 and not fits(vecs, width, dims):
        raise ValueError("components too large: a score might not fit 64 bits")
    floats = most * most * dims < 2 ** 52
    chunks = land.put(pack(vecs.select("vec_id", "v", "dim"), CHUNK, parts, low, width), "chunks")
    asked = vecs.where("query").select("vec_id", "v", "dim").dropDuplicates(["vec_id", "v"])
    blocks = pack(asked, BLOCK, parts, low, width).select(
        "dim", F.col("ids").alias("q_ids"), F.col("exact").alias("q"))
    blocks = land.put(blocks.withColumn("block", F.xxhash64("q_ids", "dim")), "blocks")

    def table(raw: bytes, dim: int, kind=np.int64) -> np.ndarray:
        return np.frombuffer(raw, kind).reshape(-1, dim) if dim else None

    def first(batches):
        import pyarrow as pa

        for batch in batches:
            for r in batch.to_pylist():
                ids, qids, dim = np.frombuffer(r["ids"], np.int64), np.frombuffer(r["q_ids"], np.int64), r["dim"]
                if dim:
                    lower = bounds(table(r["q"], dim), table(r["cells"], dim, np.uint8), low, width, floats, False)
                else:
                    lower = np.zeros((len(qids), len(ids)), np.int64)
                own = qids[:, None] == ids[None, :]
                lower = np.where(own, np.iinfo(np.int64).min, lower)
                best = -np.sort(-lower, axis=1)[:, :k] if lower.shape[1] <= k else \
                    -np.sort(-np.partition(lower, lower.shape[1] - k, axis=1)[:, -k:], axis=1)
                flat = best.reshape(-1)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(flat), r["block"])), pa.array(np.repeat(np.arange(len(qids)), best.shape[1]), pa.int32()),
                     pa.array(flat)], names=["block", "q_at", "lower"])

    scan = chunks.select("part", "dim", "ids", "cells").join(dealt(blocks, chunks), ["part", "dim"])
    rank = F.row_number().over(Window.partitionBy("block", "q_at").orderBy(F.col("lower").desc()))
    kth = (scan.mapInArrow(first, "block long, q_at int, lower long").withColumn("rank", rank)
           .where(F.col("rank") <= k).groupBy("block", "q_at")
           .agg(F.min("lower").alias("least"), F.count("*").alias("n"))
           .select("block", "q_at", F.when(F.col("n") < k, F.lit(-2 ** 63)).otherwise(F.col("least")).alias("least")))
    least = kth.groupBy("block").agg(F.transform(F.sort_array(F.collect_list(F.struct("q_at", "least"))),
                                                 lambda x: x["least"]).alias("least"))
    known = land.put(blocks.join(least, "block"), "known")

    def second(batches):
        import pyarrow as pa

        for batch in batches:
            for r in batch.to_pylist():
                ids, qids, dim = np.frombuffer(r["ids"], np.int64), np.frombuffer(r["q_ids"], np.int64), r["dim"]
                need = np.array(r["least"], np.int64)
                if dim:
                    q, exact = table(r["q"], dim), table(r["exact"], dim)
                    upper = bounds(q, table(r["cells"], dim, np.uint8), low, width, floats, True)
                else:
                    q, exact = np.zeros((len(qids), 0), np.int64), np.zeros((len(ids), 0), np.int64)
                    upper = np.zeros((len(qids), len(ids)), np.int64)
                out_q, out_v, out_s, out_r = [], [], [], []
                for i in range(len(qids)):
                    at = np.flatnonzero((upper[i] >= need[i]) & (ids != qids[i]))
                    if not len(at):
                        continue
                    at = at[np.argsort(-upper[i, at], kind="stable")]
                    seen = np.zeros(0, np.int64)
                    step, done = 64, 0
                    while done < len(at):
                        if len(seen) >= k and np.partition(seen, len(seen) - k)[len(seen) - k] > upper[i, at[done]]:
                            break
                        more = at[done: done + step]
                        seen = np.concatenate([seen, product(exact[more], q[i: i + 1], floats)[:, 0]])
                        done += len(more)
                        step *= 2
                    read = at[:done]
                    top = np.lexsort((ids[read], -seen))[:k]
                    out_q.append(np.full(len(top), qids[i]))
                    out_v.append(ids[read][top])
                    out_s.append(seen[top])
                    out_r.append(read[top] + r["first"])
                if out_q:
                    yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in (out_q, out_v, out_s, out_r)],
                                                     names=["query_id", "vec_id", "score", "row"])

    final = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    pairs = chunks.join(dealt(known, chunks), ["part", "dim"])
    return (pairs.mapInArrow(second, "query_id long, vec_id long, score long, row long")
            .groupBy("query_id", "vec_id", "row").agg(F.max("score").alias("score"))
            .withColumn("rank", F.row_number().over(final)).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))
