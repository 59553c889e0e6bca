"""Quality classifier: ordinal cumulative-link regression on hashed text.

A grade g among 0..G has P(g <= k) = sigmoid(cut_k - w.x), with one weight
vector for all grades and increasing cuts. x are hashed features of the whole
text: its words (lower case) and their first six bytes, the shapes of its words
(letters, digits, each other character; repeats once) and bands of its length and of its share of
distinct words, each weighted by log(1 + 1000 * its share of all words). The
weights and cuts are learned from every graded text but those that calibrate:
features are written once, each step sums the slopes over all of them on Spark
and the driver moves the weights (at most 2**18). Scoring covers every whole
text. The result is the expected grade and the probability of the highest
grade; the threshold on that probability is the exact quantile over all graded
texts not used for the weights, so that no more than ``loss`` of the best ones
fall below it.

Defined cases: a null or empty text has the length band alone; no grades, or
one only: expected grade 0, probability 1, all kept; null grades are not
learned from; repeated rows score alike. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
from pyspark import RDD, StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import base
from . import words as W

BITS = 18
PREFIX = 6


@dataclass
class Model:
    weights: np.ndarray
    cuts: np.ndarray
    threshold: float = 0.5


def _classes() -> tuple[np.ndarray, np.ndarray]:
    lower = np.arange(256, dtype=np.uint8)
    lower[65:91] += 32
    shape = np.arange(256, dtype=np.uint8)
    shape[65:91] = shape[97:123] = shape[128:256] = 97
    shape[48:58] = 48
    return lower, shape


def text_features(buf: np.ndarray, offsets: np.ndarray, bits: int = BITS):
    """(text, feature, value), sorted by text and feature."""
    n = len(offsets) - 1
    lower, shape = _classes()
    size = np.uint64(1 << bits)
    low = lower[buf]
    w = W.scan(low, offsets)
    count = np.diff(w.bounds)
    docs, feats = [w.doc], [w.hash % size]
    long = np.flatnonzero(w.end - w.start > PREFIX)
    docs.append(w.doc[long])
    feats.append(W.mix(W.spans(low, w.start[long], w.start[long] + PREFIX) + np.uint64(55)) % size)
    cls = shape[buf]
    keep = np.ones(len(cls), bool)
    if len(cls):
        keep[1:] = cls[1:] != cls[:-1]
        keep[offsets[:-1][offsets[:-1] < len(cls)]] = True
    at = np.concatenate([[0], np.cumsum(keep)])
    s = W.scan(cls[keep], at[offsets])
    docs.append(s.doc)
    feats.append(W.mix(s.hash + np.uint64(77)) % size)
    doc, feat = np.concatenate(docs), np.concatenate(feats).astype(np.int64)
    key, c = np.unique(doc * (1 << bits) + feat, return_counts=True)
    doc, feat = key >> bits, key & ((1 << bits) - 1)
    value = np.log1p(1000.0 * c / np.maximum(count, 1)[doc])
    # distinct words, as far as hashing tells them apart
    distinct = np.bincount(np.unique(w.doc.astype(np.int64) * (1 << bits) + (w.hash % size).astype(np.int64)) >> bits,
                           minlength=n)
    bands = [np.log2(count + 1).astype(np.uint64) + np.uint64(1000),
             (8 * distinct // np.maximum(count, 1)).astype(np.uint64) + np.uint64(2000)]
    for b in bands:
        doc = np.concatenate([doc, np.arange(n)])
        feat = np.concatenate([feat, (W.mix(b) % size).astype(np.int64)])
        value = np.concatenate([value, np.full(n, 3.0)])
    order = np.lexsort((feat, doc))
    return doc[order], feat[order], value[order]


def sigmoid(x):
    return 0.5 * (1 + np.tanh(0.5 * x))


def at_most(model: Model, score: np.ndarray) -> np.ndarray:
    """[texts, cuts] P(grade <= k)."""
    return sigmoid(model.cuts[None, :] - score[:, None])


def slopes(size, col, value, grade, w, cuts) -> tuple[np.ndarray, np.ndarray]:
    """Of the log loss summed over some texts: slopes by weight and by cut.
    ``size``: the number of features of each text, which follow one another in
    ``col`` and ``value``."""
    n, top = len(grade), len(cuts)
    s, full = np.zeros(n), size > 0
    if full.any():
        s[full] = np.add.reduceat(w[col] * value, (np.cumsum(size) - size)[full])
    p = np.concatenate([np.zeros((n, 1)), sigmoid(cuts[None, :] - s[:, None]), np.ones((n, 1))], axis=1)
    d = p * (1 - p)                                    # slope of each cumulative probability
    i = np.arange(n)
    mass = np.maximum(p[i, grade + 1] - p[i, grade], 1e-9)
    hi, lo = d[i, grade + 1] / mass, d[i, grade] / mass
    gc = np.zeros(top + 2)
    np.add.at(gc, grade + 1, -hi)
    np.add.at(gc, grade, lo)
    return np.bincount(col, weights=np.repeat(hi - lo, size) * value, minlength=len(w)), gc[1: top + 1]


def descend(summed: Callable, used: np.ndarray, by_grade: np.ndarray, bits: int = BITS, rounds: int = 200,
            decay: float = 2e-3, rate: float = 0.05) -> Model:
    """Adam on the mean log loss of all texts. ``summed(w, cuts)`` gives the
    slopes over all of them, by weight of the features ``used`` and by cut;
    ``by_grade`` how many texts have each grade."""
    n, k = by_grade.sum(), len(used)
    share = (np.cumsum(by_grade)[:-1] / n).clip(1e-3, 1 - 1e-3)
    cuts = np.log(share / (1 - share))
    cuts = np.maximum.accumulate(cuts + 1e-3 * np.arange(len(cuts)))
    raw = np.concatenate([cuts[:1], np.log(np.maximum(np.diff(cuts), 1e-3))])
    theta = np.concatenate([np.zeros(k), raw])
    m, v = np.zeros_like(theta), np.zeros_like(theta)
    for step in range(1, rounds + 1):
        w, raw = theta[:k], theta[k:]
        gw, gc = summed(w, np.cumsum(np.concatenate([raw[:1], np.exp(raw[1:])])))
        tail = np.cumsum(gc[::-1])[::-1] / n           # a raw step moves its cut and all later ones
        g = np.concatenate([gw / n + decay * w, tail[:1], tail[1:] * np.exp(raw[1:])])
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        theta = theta - rate * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.999 ** step)) + 1e-8)
    w, raw = theta[:k], theta[k:]
    weights = np.zeros(1 << bits, np.float32)
    weights[used] = w
    return Model(weights, np.cumsum(np.concatenate([raw[:1], np.exp(raw[1:])])))


def train(doc, feat, value, grade, bits: int = BITS, rounds: int = 200, least_docs: int = 8, decay: float = 2e-3,
          rate: float = 0.05) -> Model:
    """``descend`` on texts held in arrays; features in fewer than
    ``least_docs`` texts keep weight 0."""
    df = np.bincount(feat, minlength=1 << bits)
    ok = df[feat] >= least_docs
    used, col = np.unique(feat[ok], return_inverse=True)
    order = np.argsort(doc[ok], kind="stable")
    size, col, value = np.bincount(doc[ok], minlength=len(grade)), col[order], value[ok][order]
    return descend(lambda w, cuts: slopes(size, col, value, grade, w, cuts), used, np.bincount(grade), bits, rounds, decay, rate)


FEATURES = "grade int, rest boolean, feats binary, vals binary"


def _numbers(column, kind) -> tuple[np.ndarray, np.ndarray]:
    """The numbers of an Arrow binary column, and where each row's begin."""
    import pyarrow as pa

    _, off, data = column.buffers()
    off = np.frombuffer(off, np.int64 if pa.types.is_large_binary(column.type) else np.int32)
    off = off[column.offset: column.offset + len(column) + 1].astype(np.int64)
    data = np.frombuffer(data, np.uint8)[off[0]: off[-1]] if data is not None else np.zeros(0, np.uint8)
    return data.view(kind), (off - off[0]) // np.dtype(kind).itemsize


def features_of(rows: DataFrame) -> DataFrame:
    """(grade, rest, feats, vals) of (text, grade, rest): a text's features and
    their values as little-endian 32-bit numbers."""

    def run(batches):
        import pyarrow as pa

        def packed(numbers, cut):
            at = pa.py_buffer((4 * cut).astype(np.int32).tobytes())
            return pa.Array.from_buffers(pa.binary(), len(cut) - 1, [None, at, pa.py_buffer(numbers.tobytes())])

        for batch in batches:
            for i, j, buf, offsets in W.slices(batch.column("text")):
                doc, feat, value = text_features(buf, offsets)
                cut = np.searchsorted(doc, np.arange(j - i + 1))
                yield pa.RecordBatch.from_arrays(
                    [batch.column("grade").slice(i, j - i), batch.column("rest").slice(i, j - i),
                     packed(feat.astype("<i4"), cut), packed(value.astype("<f4"), cut)],
                    names=["grade", "rest", "feats", "vals"])

    return rows.select("text", "grade", "rest").mapInArrow(run, FEATURES)


def frequent(features: DataFrame, least_docs: int = 8, bits: int = BITS) -> np.ndarray:
    """Features in at least ``least_docs`` texts (2**bits at most), those of
    most texts first: the weights that a pass asks for most lie together."""

    def run(batches):
        import pyarrow as pa

        n = np.zeros(1 << bits, np.int64)
        for batch in batches:
            n += np.bincount(_numbers(batch.column("feats"), "<i4")[0], minlength=1 << bits)
        at = np.flatnonzero(n)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int64()), pa.array(n[at], pa.int64())], names=["feat", "n"])

    counts = features.select("feats").mapInArrow(run, "feat long, n long").groupBy("feat").agg(F.sum("n").alias("n"))
    found = counts.where(F.col("n") >= least_docs).toArrow()
    feat, n = found["feat"].to_numpy(), found["n"].to_numpy()
    return feat[np.lexsort((feat, -n))]


def summed_over(features: DataFrame, used: np.ndarray, bits: int = BITS) -> tuple[RDD, Callable]:
    """The texts as blocks of arrays, kept on the executors' disks, and the
    function that sums their slopes: a pass over all blocks, a task a core, whose
    sums (a number a feature and cut) the driver adds up; those of more than 64
    tasks are added up on Spark before."""
    sc = base.session_of(features).sparkContext
    place = np.full(1 << bits, -1, np.int32)
    place[used] = np.arange(len(used))
    place = sc.broadcast(place)
    kind = np.min_scalar_type(max(1, len(used)))

    def block(batches):
        import pyarrow as pa

        for batch in batches:
            feat, cut = _numbers(batch.column("feats"), "<i4")
            value, _ = _numbers(batch.column("vals"), "<f4")
            col = place.value[feat]
            ok = col >= 0
            cut = np.concatenate([[0], np.cumsum(ok)])[cut]
            yield pa.RecordBatch.from_arrays(
                [pa.array([x.tobytes()], pa.binary()) for x in (
                    batch.column("grade").to_numpy().astype("<i4"), np.diff(cut).astype("<i4"), col[ok].astype(kind), value[ok])],
                names=["grade", "n", "col", "value"])

    def arrays(r):
        return (np.frombuffer(r.grade, "<i4"), np.frombuffer(r.n, "<i4"), np.frombuffer(r.col, kind),
                np.frombuffer(r.value, "<f4"))

    blocks = (features.select("grade", "feats", "vals").mapInArrow(block, "grade binary, n binary, col binary, value binary")
              .coalesce(sc.defaultParallelism).rdd.map(arrays).persist(StorageLevel.DISK_ONLY))

    def summed(w, cuts):
        now = sc.broadcast((w, cuts))

        def part(rows):
            w, cuts = now.value
            out = np.zeros(len(w) + len(cuts))
            for grade, n, col, value in rows:
                gw, gc = slopes(n, col, value, grade, w, cuts)
                out[: len(w)] += gw
                out[len(w):] += gc
            return [out]

        got = blocks.mapPartitions(part).treeReduce(np.add, depth=1 if blocks.getNumPartitions() <= 64 else 2)
        now.destroy()
        return got[: len(w)], got[len(w):]

    return blocks, summed


def quantile(scores: DataFrame, share: float) -> float | None:
    """The exact quantile of column ``x`` (between neighbours: linear), found
    by narrowing bounds with counts of 257 bins; None without rows."""
    n, least, most = scores.agg(F.count("x"), F.min("x"), F.max("x")).first()
    if not n:
        return None

    def at(rank: int) -> float:
        lo, hi = least, most
        while lo < hi:
            inside = scores.where(F.col("x").between(lo, hi))
            bins = (inside.groupBy(F.floor((F.col("x") - lo) / F.lit(hi - lo) * 256).alias("bin"))
                    .agg(F.count("x").alias("n"), F.min("x").alias("lo"), F.max("x").alias("hi")).collect())
            for b in sorted(bins, key=lambda b: b["bin"]):
                if rank < b["n"]:
                    lo, hi = b["lo"], b["hi"]
                    break
                rank -= b["n"]
        return lo

    place = (n - 1) * share
    a = at(int(place))
    return a + (at(min(int(place) + 1, n - 1)) - a) * (place - int(place))


def fit(docs: DataFrame, grades: DataFrame, loss: float = 0.004, id_col: str = "doc_id",
        text_col: str = "text") -> Model | None:
    """``grades``: (doc_id, grade from 0). Weights and cuts are learned from
    all graded texts but a quarter of them (by a hash of their id), which
    calibrates the threshold."""
    spark = base.session_of(docs)
    base.batches(spark, 4)
    known = (grades.where(F.col("grade").isNotNull() & F.col("doc_id").isNotNull())
             .groupBy("doc_id").agg(F.min("grade").cast("int").alias("grade")))
    rest = F.pmod(F.shiftright(F.xxhash64("doc_id", F.lit(5)), 9), F.lit(4)) == 0
    land = base.Landing(spark, "ordinal")
    # the grades grow with the texts: never broadcast
    texts = base.texts_of(docs, id_col, text_col).join(known.hint("merge"), "doc_id")
    features = land.put(features_of(texts.withColumn("rest", rest)), "features")
    # a row a grade
    counts = {(r["rest"], r["grade"]): r["n"] for r in
              features.groupBy("rest", "grade").agg(F.count("*").alias("n")).collect()}
    top = max((g for _, g in counts), default=0)
    if top < 1 or len({g for _, g in counts}) < 2:
        land.drop("features")
        return None
    learned = [g for r, g in counts if not r]
    split = sum(n for (r, _), n in counts.items() if not r) >= 2 and len(learned) >= 2 and max(learned) == top
    own, held = (features.where("not rest"), features.where("rest")) if split else (features, features)
    if split and not any(r for r, _ in counts):
        held = own
    by_grade = np.array([sum(n for (r, h), n in counts.items() if h == g and not (split and r)) for g in range(top + 1)])
    used = frequent(own)
    blocks, summed = summed_over(own, used)
    model = descend(summed, used, by_grade)
    blocks.unpersist()
    threshold = quantile(land.put(scored(held.where(F.col("grade") == top), model), "scores"), loss)
    model.threshold = 0.5 if threshold is None else threshold
    land.drop("features", "scores")
    return model


def scored(features: DataFrame, model: Model) -> DataFrame:
    """``x``: the probability of the highest grade."""
    shared = base.session_of(features).sparkContext.broadcast(vars(model))

    def run(batches):
        import pyarrow as pa

        m = Model(**shared.value)
        for batch in batches:
            feat, cut = _numbers(batch.column("feats"), "<i4")
            value = _numbers(batch.column("vals"), "<f4")[0].astype(float)
            doc = np.repeat(np.arange(batch.num_rows), np.diff(cut))
            score = np.bincount(doc, weights=value * m.weights[feat], minlength=batch.num_rows)
            yield pa.RecordBatch.from_arrays([pa.array(1 - at_most(m, score)[:, -1])], names=["x"])

    return features.select("feats", "vals").mapInArrow(run, "x double")


GRADED = "doc_id long, expected_grade double, top_probability double, kept boolean"


def graded(docs: DataFrame, model: Model | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id``, ``expected_grade``, ``top_probability``, ``kept``."""
    texts = base.texts_of(docs, id_col, text_col)
    if model is None:
        return texts.select("doc_id", F.lit(0.0).alias("expected_grade"), F.lit(1.0).alias("top_probability"),
                            F.lit(True).alias("kept"))
    shared = base.session_of(docs).sparkContext.broadcast(vars(model))

    def run(batches):
        import pyarrow as pa

        m = Model(**shared.value)
        for batch in batches:
            for i, j, buf, offsets in W.slices(batch.column("text")):
                doc, feat, value = text_features(buf, offsets)
                score = np.bincount(doc, weights=value * m.weights[feat], minlength=j - i)
                p = at_most(m, score)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").slice(i, j - i), pa.array((1 - p).sum(1)), pa.array(1 - p[:, -1]),
                     pa.array(1 - p[:, -1] >= m.threshold)],
                    names=["doc_id", "expected_grade", "top_probability", "kept"])

    return texts.mapInArrow(run, GRADED)


def grade_of(quality: Column, toxic: Column) -> Column:
    """Grades of the two labels: 0 poor and toxic, 1 poor or toxic, 2 neither."""
    return (quality + (1 - toxic)).cast("int")
