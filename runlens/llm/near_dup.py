"""Near duplicates by weighted MinHash (BagMinHash), banding and exact overlap.

A document is the multiset of its runs of five words (fewer words: one run of
all of them). Signatures follow hierarchical Poisson processes over the
discretised weights: the weight axis is cut into dyadic intervals [0,1],
[1,2], [2,4], [4,8], ..., each with a process of its own whose rate is the
interval's length times the number of registers. A point has a time, a
register and a place in its interval, found by halving it; points above the
element's weight are passed over. A register keeps its earliest point, so two
documents agree in a register with the probability of their weighted Jaccard
similarity. Points are drawn up to a time by which all registers are expected
to be filled; documents with a free register are drawn again to twice the
time, so the signature is exact.

Signatures are cut into bands; documents that share a band are candidates and
links are verified on the multisets themselves (similarity >= 0.8). Documents
with equal multisets are one node. Two bounds keep large groups of near copies
from costing their square, and neither loses a link:

* Two nodes of different components share no more than either's runs that
  other components hold at all (at first every node is a component), counted
  apart for runs of few and of many holders. Nodes and pairs whose bound is
  below what a link of their weights needs are not compared.
* Classes are connected components of links. In each band the node with the
  greatest share of such runs is compared with all others first; after that only
  pairs that are still in different components are compared.

Defined cases: a null or empty text is in a class of its own; a null id takes
no part and stays; rows that repeat an id are one document (texts differing,
their classes are joined). Other columns are neither read nor changed.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import base
from . import words as W
from .components import components

SHINGLE = 5
ROWS = 6
BANDS = 42
THRESHOLD = 0.8


def shingles(w: W.Words, k: int = SHINGLE):
    """(text, hash, count) of the distinct runs of k words of each text."""
    at, h = W.runs(w, k)
    doc = w.doc[at]
    size = np.diff(w.bounds)
    for i in np.flatnonzero((size > 0) & (size < k)):
        own = w.hash[w.bounds[i]: w.bounds[i + 1]]
        acc = np.uint64(len(own))
        for x in own:
            acc = W.mix(np.array([acc ^ x], np.uint64))[0]
        doc, h = np.append(doc, i), np.append(h, acc)
    key = h ^ W.mix(doc.astype(np.uint64) + np.uint64(1))
    _, first, count = np.unique(key, return_index=True, return_counts=True)
    return doc[first], h[first], count


def signatures(doc: np.ndarray, h: np.ndarray, weight: np.ndarray, docs: int, m: int) -> np.ndarray:
    """[docs, m] earliest times; infinite where a text has no element."""
    total = np.bincount(doc, weights=weight, minlength=docs)
    sig = np.full((docs, m), np.inf)
    until = np.where(total > 0, (np.log(m) + 3) / np.maximum(total, 1), 0.0)
    # a process for every interval that begins below the weight
    parts, k, low = [(np.arange(len(doc)), 0, 1)], 1, 1
    while True:
        has = np.flatnonzero(weight > low)
        if not len(has):
            break
        parts.append((has, low, low))
        low, k = low * 2, k + 1
    elem = np.concatenate([p[0] for p in parts])
    begin = np.concatenate([np.full(len(p[0]), p[1]) for p in parts])
    length = np.concatenate([np.full(len(p[0]), p[2]) for p in parts])
    seed = W.mix(h[elem] + W.mix((begin + 3 * length).astype(np.uint64)))
    open_docs = total > 0
    while True:
        run = np.flatnonzero(open_docs[doc[elem]])
        if not len(run):
            return sig
        flat = sig.reshape(-1)
        time = np.zeros(len(run))
        step, block = 0, 1
        while len(run):
            j = np.arange(step, step + block, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
            r = W.mix(seed[run][:, None] + j[None, :])
            gap = -np.log(((r >> np.uint64(11)).astype(np.float64) + 1) / 2.0 ** 53)
            gap /= (m * length[run])[:, None]
            gap[:, 0] += time
            at = np.cumsum(gap, axis=1)
            e = elem[run]
            ok = at <= until[doc[e]][:, None]
            i, c = np.nonzero(ok)
            r2 = W.mix(r[i, c] ^ np.uint64(0xD6E8FEB86659FD93))
            span = length[run][i]
            place = begin[run][i] + ((r2 >> np.uint64(40)) & (span - 1).astype(np.uint64)).astype(np.int64)
            ok2 = place < weight[e][i]
            reg = ((r2 & np.uint64(0xFFFFFFFF)) % np.uint64(m)).astype(np.int64)
            np.minimum.at(flat, doc[e][i[ok2]] * m + reg[ok2], at[i[ok2], c[ok2]])
            alive = ok[:, -1]
            time = at[alive, -1]
            run = run[alive]
            step += block
            block = min(256, block if step == 1 else block * 2)
        open_docs = open_docs & np.isinf(sig).any(1)
        sig[open_docs] = np.inf
        until = np.where(open_docs, until * 2, until)


def band_keys(sig: np.ndarray, rows: int = ROWS) -> np.ndarray:
    """[docs, bands] signed 64-bit keys."""
    n, m = sig.shape
    bits = sig.view(np.uint64).reshape(n, m // rows, rows)
    key = np.broadcast_to(W.mix(np.arange(1, m // rows + 1, dtype=np.uint64)), (n, m // rows)).copy()
    for r in range(rows):
        key = W.mix(key * np.uint64(W.BASE) + bits[:, :, r])
    return key.view(np.int64)


PROFILE = "doc_id long, fp1 long, fp2 long, weight long, bands array<long>"


def profiles(docs: DataFrame, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """(doc_id, fingerprint of the multiset, weight, band keys) a document with words."""

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            ids = batch.column("doc_id")
            for i, j, buf, offsets in W.slices(batch.column("text")):
                w = W.scan(buf, offsets)
                doc, h, count = shingles(w)
                n = j - i
                c = count.astype(np.uint64)
                fp = []
                for salt in (0xA0761D6478BD642F, 0xE7037ED1A0B428DB):
                    term = W.mix(h ^ np.uint64(salt)) * (c * np.uint64(2) + np.uint64(1))
                    acc = np.zeros(n, np.uint64)
                    np.add.at(acc, doc, W.mix(term))
                    fp.append(acc.view(np.int64))
                total = np.bincount(doc, weights=count, minlength=n).astype(np.int64)
                has = np.flatnonzero(total > 0)
                keys = np.zeros((0, bands), np.int64)
                if len(has):
                    keys = band_keys(signatures(doc, h, count, n, bands * rows)[has], rows)
                lists = pa.ListArray.from_arrays(
                    pa.array(np.arange(0, len(has) * bands + 1, bands), pa.int32()), pa.array(keys.reshape(-1)))
                yield pa.RecordBatch.from_arrays(
                    [ids.slice(i, n).take(pa.array(has)), pa.array(fp[0][has]), pa.array(fp[1][has]),
                     pa.array(total[has]), lists], names=["doc_id", "fp1", "fp2", "weight", "bands"])

    return docs.mapInArrow(run, PROFILE)


def overlap(w: W.Words, v: W.Words, n: int) -> np.ndarray:
    """Weighted Jaccard similarity of text i of ``w`` and text i of ``v``."""
    d1, h1, c1 = shingles(w)
    d2, h2, c2 = shingles(v)
    k1 = h1 ^ W.mix(d1.astype(np.uint64) + np.uint64(1))
    k2 = h2 ^ W.mix(d2.astype(np.uint64) + np.uint64(1))
    _, a, b = np.intersect1d(k1, k2, assume_unique=True, return_indices=True)
    both = np.bincount(d1[a], weights=np.minimum(c1[a], c2[b]), minlength=n)
    every = np.bincount(d1, weights=c1, minlength=n) + np.bincount(d2, weights=c2, minlength=n) - both
    return both / np.maximum(every, 1)


def verified(pairs: DataFrame, texts: DataFrame, threshold: float) -> DataFrame:
    """The pairs (a, b) whose multisets overlap enough (of an id with several
    texts, any)."""

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            ta, tb = batch.column("text_a"), batch.column("text_b")
            i = 0
            while i < batch.num_rows:
                size = 0
                j = i
                while j < batch.num_rows and (j == i or size < W.SLICE_BYTES):
                    size += len(ta[j].as_buffer()) + len(tb[j].as_buffer())
                    j += 1
                # one slice of each side
                (_, _, ba, oa), = W.slices(ta.slice(i, j - i), 1 << 62)
                (_, _, bb, ob), = W.slices(tb.slice(i, j - i), 1 << 62)
                s = overlap(W.scan(ba, oa), W.scan(bb, ob), j - i)
                good = pa.array(np.flatnonzero(s >= threshold) + i)
                yield pa.RecordBatch.from_arrays([batch.column("a").take(good), batch.column("b").take(good)],
                                                 names=["a", "b"])
                i = j

    with_a = pairs.join(texts.select(F.col("doc_id").alias("a"), F.col("text").alias("text_a")), "a")
    both = with_a.join(texts.select(F.col("doc_id").alias("b"), F.col("text").alias("text_b")), "b")
    return both.select("a", "b", "text_a", "text_b").mapInArrow(run, "a long, b long")


def runs_of(texts: DataFrame) -> DataFrame:
    """(run, node, c): the multiset of every text, one row a distinct run."""

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            ids = batch.column("doc_id").to_numpy()
            for i, j, buf, offsets in W.slices(batch.column("text")):
                doc, h, count = shingles(W.scan(buf, offsets))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(h.view(np.int64)), pa.array(ids[i:j][doc]), pa.array(count.astype(np.int64))],
                    names=["run", "node", "c"])

    return texts.mapInArrow(run, "run long, node long, c long")


def shared_weight(runs: DataFrame, few: int = 16) -> DataFrame:
    """(node, wide, rare): the weight of a node's runs that a node of another
    component holds, from (run, node, c, comp), parted by whether ``few`` nodes
    or more hold the run. No row: none."""
    apart = (runs.groupBy("run").agg(F.min("comp").alias("c1"), F.max("comp").alias("c2"), F.count("*").alias("n"))
             .where("c1 <> c2").select("run", (F.col("n") >= few).alias("many")))
    return (runs.join(apart, "run").groupBy("node")
            .agg(F.sum(F.when(F.col("many"), F.col("c")).otherwise(0)).alias("wide"),
                 F.sum(F.when(F.col("many"), 0).otherwise(F.col("c"))).alias("rare")))


def classes(docs: DataFrame, threshold: float = THRESHOLD, bands: int = BANDS, rows: int = ROWS,
            star_rounds: int = 2, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row a document: ``doc_id``, ``class_id`` (the smallest id of its class)."""
    spark = base.session_of(docs)
    base.batches(spark, 4)
    land = base.Landing(spark, "near-dup")
    texts = base.texts_of(docs, id_col, text_col).where(F.col("doc_id").isNotNull())
    prof = land.put(profiles(texts, bands, rows), "profiles")

    # equal multisets: one node, named by the smallest id
    nodes = land.put(prof.groupBy("fp1", "fp2").agg(F.min("doc_id").alias("rep"), F.max("doc_id").alias("top")), "nodes")
    several = nodes.where("rep <> top").select("fp1", "fp2", "rep")
    member = land.put(prof.select("doc_id", "fp1", "fp2").join(several, ["fp1", "fp2"])
                      .select("doc_id", "rep").distinct(), "member")
    # an id with several texts joins their nodes
    rep_of = (prof.select("doc_id").join(member, "doc_id", "left")
              .select("doc_id", F.coalesce("rep", "doc_id").alias("rep")))
    twice = (rep_of.groupBy("doc_id").agg(F.min("rep").alias("a"), F.max("rep").alias("b"))
             .where("a <> b").select("a", "b"))

    reps = prof.join(nodes.select(F.col("rep").alias("doc_id"), "fp1", "fp2"), ["doc_id", "fp1", "fp2"], "left_semi")
    in_band = reps.select(F.col("doc_id").alias("node"), "weight", F.explode("bands").alias("band"))
    shared = in_band.groupBy("band").agg(F.min("node").alias("low"), F.max("node").alias("high")).where("low <> high")
    cand = land.put(in_band.join(shared.select("band"), "band", "left_semi"), "candidates")
    land.drop("nodes")

    # whole texts only of documents that share a band
    wanted = cand.select(F.col("node").alias("doc_id")).distinct()
    body = land.put(texts.join(wanted, "doc_id", "left_semi").dropDuplicates(["doc_id", "text"]), "texts")

    # a link of weights a, b needs an overlap of t / (1 + t) * (a + b), and b >= t * a
    runs = land.put(runs_of(body), "runs")
    common = land.put(shared_weight(runs.withColumn("comp", F.col("node"))), "common")
    lightest = (cand.join(cand.groupBy("band").agg(F.min("weight").alias("least")), "band")
                .groupBy("node", "weight").agg(F.min("least").alias("least")))
    share = threshold / (1 + threshold)
    partner = F.greatest(F.col("least").cast("double"), threshold * F.col("weight"))
    able = (lightest.join(common, "node")
            .where(F.col("wide") + F.col("rare") >= share * (F.col("weight") + partner) - 1e-6)
            .select("node", "weight", "wide", "rare", (1 - (F.col("wide") + F.col("rare")) / F.col("weight")).alias("odd")))
    cand = cand.select("band", "node", "weight").join(able, ["node", "weight"])
    pairable = (cand.groupBy("band").agg(F.min("node").alias("low"), F.max("node").alias("high"))
                .where("low <> high").select("band"))
    cand = cand.join(pairable, "band", "left_semi")
    every = cand.groupBy("node").agg(F.collect_set("band").alias("bands"))        # a node's bands are few
    cand = land.put(cand.join(every, "node"), "members")
    runs = land.put(runs.join(able.select("node"), "node", "left_semi"), "member-runs")
    land.drop("candidates", "runs")

    most = F.least("wide_a", "wide_b") + F.least("rare_a", "rare_b")
    close = most >= share * (F.col("wa") + F.col("wb")) - 1e-6
    edges = land.put(twice, "edges-ids")
    labels = None
    tried = None
    for turn in range(star_rounds + 1):
        if labels is None:
            state = asked = cand.withColumn("comp", F.col("node"))
        else:
            state = (cand.join(labels, "node", "left")
                     .withColumn("comp", F.coalesce("label", "node")).drop("label"))
            held = (runs.join(labels, "node", "left").withColumn("comp", F.coalesce("label", "node")))
            now = land.put(shared_weight(held), f"common-{turn}")
            state = state.drop("wide", "rare").join(now, "node")
            mixed = (state.groupBy("band").agg(F.min("comp").alias("c1"), F.max("comp").alias("c2"))
                     .where("c1 <> c2").select("band"))
            state = land.put(state.join(mixed, "band", "left_semi"), f"state-{turn}")
            if state.isEmpty():
                break
            # those outside their band's largest component ask
            sizes = state.groupBy("band", "comp").agg(F.count("*").alias("n"))
            main = sizes.groupBy("band").agg(F.max(F.struct("n", "comp")).alias("m")).select("band", F.col("m.comp").alias("main"))
            asked = state.join(main, "band").where("comp <> main").drop("main")
        if turn < star_rounds:
            first = asked.groupBy("band").agg(F.min(F.struct("odd", "node", "weight", "wide", "rare", "comp")).alias("p"))
            asked = first.select("band", "p.node", "p.weight", "p.wide", "p.rare", "p.comp")
        # a node asks another once, in the least of the bands in which they meet
        in_bands = asked.groupBy("node").agg(F.collect_set("band").alias("asks"))
        asked = asked.join(in_bands, "node")
        once = F.array_min(F.array_intersect("asks", "bands")) == F.col("band")
        centre, other = (t.select("band", lists, F.col("node").alias(x), F.col("weight").alias(f"w{x}"),
                                  F.col("wide").alias(f"wide_{x}"), F.col("rare").alias(f"rare_{x}"), F.col("comp").alias(f"c{x}"))
                         for t, x, lists in ((asked, "a", "asks"), (state, "b", "bands")))
        pairs = (centre.join(other, "band").where((F.col("ca") != F.col("cb")) & close & once)
                 .select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct())
        if tried is not None:
            pairs = pairs.join(tried, ["a", "b"], "left_anti")
        pairs = land.put(pairs, f"pairs-{turn}")
        tried = pairs if tried is None else tried.unionByName(pairs)
        edges = edges.unionByName(land.put(verified(pairs, body, threshold), f"edges-{turn}"))
        labels = components(edges, land, f"round-{turn}")
    land.drop("texts", "members", "member-runs", *(f"state-{t}" for t in range(star_rounds + 2)))

    ids = texts.select("doc_id").distinct()
    found = (ids.join(member, "doc_id", "left").withColumn("node", F.coalesce("rep", "doc_id"))
             .select("doc_id", "node"))
    found = found.groupBy("doc_id").agg(F.min("node").alias("node"))
    return (found.join(labels, "node", "left")
            .select("doc_id", F.coalesce("label", "node").alias("class_id")))


def keep_one(docs: DataFrame, **options) -> DataFrame:
    """One document of each class stays: the smallest id; of rows that repeat
    an id, one row. All columns as they are."""
    spark = base.session_of(docs)
    land = base.Landing(spark, "near-dup-keep")
    id_col = options.get("id_col", "doc_id")
    found = classes(docs, **options)
    gone = land.put(found.where("doc_id <> class_id").select(F.col("doc_id").alias(id_col)), "gone")
    left = docs.join(gone, id_col, "left_anti").select(*docs.columns)
    again = docs.groupBy(id_col).agg(F.count("*").alias("n")).where("n > 1").select(id_col)
    again = land.put(again.where(F.col(id_col).isNotNull()), "again")
    if again.isEmpty():
        return left
    once = left.join(again, id_col, "left_semi").dropDuplicates([id_col]).select(*docs.columns)
    return left.join(again, id_col, "left_anti").select(*docs.columns).unionByName(once)
