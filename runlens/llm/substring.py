"""Removal of repeated passages with prefix-partitioned suffix trees.

Text is a sequence of words; a suffix begins at a word. A word goes if a run
of ``min_words`` consecutive words that covers it also begins in a document
with a smaller id. Three steps, each over whole texts:

1. Anchors. Of the five-word runs within each window the one with the least
   hash is the window's anchor, so equal windows have equal anchors, and a
   sixth of all positions is enough to tell which windows can repeat at all.
   Anchors found in one document only rule their windows out.
2. Suffix groups. The suffixes of the windows that are left are divided by
   prefixes of variable length: one word where that is rare, more words below
   frequent ones (counted over all texts), so that no group exceeds what a task
   holds. In a group suffixes are brought together by a hash of their first
   ``min_words`` words: those that agree are the leaves below one node of the
   group's subtree at that depth, that is a repeat. Its smallest document keeps
   it. The subtree itself, with its order and deeper nodes, is not built: one
   depth is all that the cut needs.
3. The covered words are cut from each text. Nodes along a document that
   follow each other cover its maximal repeats.

Within a map task a node is sent once, with its smallest document; its other
documents there are settled at once. So a passage that a third of all
documents share reaches its group once a task, not once a document.

Windows are judged on the input, by 64-bit hashes of their words within a
prefix group.

Defined cases: null and empty texts have no words; rows with a null id take no
part and stay as they are; rows that repeat an id are one document, so none of
them is earlier than the other.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import base
from . import words as W

MIN_WORDS = 13
ANCHOR = 5
GROUP_ROWS = 400_000
PACKED = "bucket int, settled boolean, n int, data binary"


# ------------------------------------------------------------ packed records

def _planes(x: np.ndarray) -> bytes:
    return x.view(np.uint8).reshape(len(x), 8).T.tobytes()


def pack(h: np.ndarray, doc: np.ndarray, flag: np.ndarray) -> bytes:
    """Hashes, document ids (as differences, bytes by place) and flags."""
    import pyarrow as pa

    d = np.diff(doc, prepend=np.int64(0))
    raw = h.tobytes() + _planes(d) + flag.astype(np.uint8).tobytes()
    return pa.compress(raw, codec="zstd", asbytes=True)


def unpack(n: int, data: bytes):
    import pyarrow as pa

    raw = pa.decompress(data, decompressed_size=17 * n, codec="zstd", asbytes=True)
    h = np.frombuffer(raw, np.uint64, n)
    d = np.frombuffer(raw, np.uint8, 8 * n, 8 * n).reshape(8, n).T.copy().view(np.int64).reshape(n)
    return h, np.cumsum(d), np.frombuffer(raw, np.uint8, n, 16 * n).astype(bool)


def local_nodes(h: np.ndarray, doc: np.ndarray, route: np.ndarray):
    """Of (hash, document) occurrences of one task: distinct pairs sorted by
    hash and document; whether a pair is its hash's first; whether its hash
    has several documents here."""
    order = np.lexsort((doc, h))
    h, doc, route = h[order], doc[order], route[order]
    fresh = np.ones(len(h), bool)
    fresh[1:] = (h[1:] != h[:-1]) | (doc[1:] != doc[:-1])
    h, doc, route = h[fresh], doc[fresh], route[fresh]
    first = np.ones(len(h), bool)
    first[1:] = h[1:] != h[:-1]
    group = np.cumsum(first) - 1
    many = np.bincount(group, minlength=1)[group] > 1 if len(h) else np.zeros(0, bool)
    return h, doc, route, first, many


def send(h, doc, route, groups: int, both: bool):
    """Packed rows: the first document of each hash to the hash's group, the
    rest settled (spread over all groups by their document). ``both``: the
    first document of a hash with several is settled as well."""
    import pyarrow as pa

    h, doc, route, first, many = local_nodes(h, doc, route)
    out = []
    settled = many & (~first | both)
    spread = (W.mix(doc.view(np.uint64)) % np.uint64(groups)).astype(np.int64)
    for keep, to, done in ((first, route, False), (settled, spread, True)):
        hh, dd, ff, tt = h[keep], doc[keep], many[keep], to[keep]
        order = np.lexsort((dd, tt))
        hh, dd, ff, tt = hh[order], dd[order], ff[order], tt[order]
        cut = np.flatnonzero(np.diff(tt, prepend=-1))
        for a, b in zip(cut, np.append(cut[1:], len(tt))):
            out.append((int(tt[a]), done, int(b - a), pack(hh[a:b], dd[a:b], ff[a:b])))
    cols = list(zip(*out)) if out else [[], [], [], []]
    return pa.RecordBatch.from_arrays(
        [pa.array(cols[0], pa.int32()), pa.array(cols[1], pa.bool_()), pa.array(cols[2], pa.int32()),
         pa.array(cols[3], pa.binary())], names=["bucket", "settled", "n", "data"])


def found(h, doc):
    import pyarrow as pa

    return pa.RecordBatch.from_arrays([pa.array(doc, pa.int64()), pa.array(h.view(np.int64), pa.int64())],
                                      names=["doc_id", "hash"])


def group_nodes(rows: DataFrame, later_only: bool) -> DataFrame:
    """Per group: the (document, hash) pairs of hashes with several documents;
    ``later_only``: without the smallest document of each."""

    def run(table):
        import pyarrow as pa

        parts, done = [], []
        for n, data, settled in zip(table.column("n").to_pylist(), table.column("data").to_pylist(),
                                    table.column("settled").to_pylist()):
            (done if settled else parts).append(unpack(n, data))
        out = [found(h, d) for h, d, _ in done]
        if parts:
            h, d, f = (np.concatenate(x) for x in zip(*parts))
            order = np.lexsort((d, h))
            h, d, f = h[order], d[order], f[order]
            first = np.ones(len(h), bool)
            first[1:] = h[1:] != h[:-1]
            group = np.cumsum(first) - 1
            low = d[first][group]
            if later_only:
                hit = d > low
            else:
                high = np.maximum.reduceat(d, np.flatnonzero(first))[group]
                flagged = np.maximum.reduceat(f, np.flatnonzero(first))[group]
                hit = (high > low) | flagged
                hit &= ~f                      # those that are flagged were settled before
            out.append(found(h[hit], d[hit]))
        return pa.Table.from_batches(out, schema=pa.schema([("doc_id", pa.int64()), ("hash", pa.int64())]))

    return rows.groupBy("bucket").applyInArrow(run, "doc_id long, hash long")


# ------------------------------------------------------------ windows

def sliding(x: np.ndarray, width: int, of) -> np.ndarray:
    """Least or greatest of each ``width`` neighbours, by doubling."""
    have, out = 1, x
    while have * 2 <= width:
        out = of(out[: len(out) - have], out[have:])
        have *= 2
    rest = width - have
    return of(out[: len(out) - rest], out[rest:]) if rest else out


def windows(w: W.Words, size: int, anchor: int):
    """Anchor-run hashes r, per window start its least one (0: no window),
    and the starts of windows."""
    n = len(w.hash)
    if n < size:
        return None
    r = np.zeros(n, np.uint64)
    at, h = W.runs(w, anchor)
    r[at] = h | np.uint64(1)
    least = sliding(r[: n - anchor + 1], size - anchor + 1, np.minimum)
    start = np.flatnonzero(w.doc[: n - size + 1] == w.doc[size - 1:])
    inside = np.zeros(len(least), bool)
    inside[start] = True
    return r, np.where(inside, least, np.uint64(0)), start


def anchors(w: W.Words, size: int, anchor: int):
    """Positions whose run is the least of some window, and their hashes."""
    got = windows(w, size, anchor)
    if got is None or not len(got[2]):
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    r, least, _ = got
    reach = size - anchor
    padded = np.concatenate([np.zeros(reach, np.uint64), least, np.zeros(reach, np.uint64)])
    best = sliding(padded, reach + 1, np.maximum)
    p = np.flatnonzero((best == r[: len(best)]) & (best > 0))
    return p, r[p]


def prefix_route(w: W.Words, start: np.ndarray, heavy: list[np.ndarray], groups: int) -> np.ndarray:
    """Group of each suffix: by its shortest prefix that is not heavy."""
    at, h = W.runs(w, 1)
    key = h[start]
    for level, frequent in enumerate(heavy):
        if not len(frequent):
            break
        i = np.minimum(np.searchsorted(frequent, key), len(frequent) - 1)
        more = np.flatnonzero(frequent[i] == key)
        if not len(more):
            break
        at, h = W.runs(w, level + 2)
        full = np.zeros(len(w.hash), np.uint64)
        full[at] = h
        key = key.copy()
        key[more] = full[start[more]]
    return (W.mix(key) % np.uint64(groups)).astype(np.int64)


def heavy_prefixes(texts: DataFrame, groups: int, levels: int, land: base.Landing) -> list[np.ndarray]:
    """Prefixes too frequent for a group of their own, by length, counted over
    all texts: one more word only below those that are heavy themselves, and no
    further pass once none is. They only decide the grouping."""
    heavy: list[np.ndarray] = []
    total = 0

    def counting(level: int, above: np.ndarray | None):
        def run(batches):
            import pyarrow as pa

            for batch in batches:
                found = []
                for _, _, buf, offsets in W.slices(batch.column("text")):
                    w = W.scan(buf, offsets)
                    at, h = W.runs(w, level)
                    if above is not None:
                        under = np.zeros(len(w.hash), np.uint64)
                        shorter, g = W.runs(w, level - 1)
                        under[shorter] = g
                        i = np.minimum(np.searchsorted(above, under[at]), len(above) - 1)
                        h = h[above[i] == under[at]]
                    found.append(h)
                u, c = np.unique(np.concatenate(found), return_counts=True) if found else (np.zeros(0, np.uint64), np.zeros(0, np.int64))
                yield pa.RecordBatch.from_arrays([pa.array(u.view(np.int64)), pa.array(c, pa.int64())], names=["prefix", "n"])
        return run

    for level in range(1, levels + 1):
        counts = (texts.select("text").mapInArrow(counting(level, heavy[-1] if heavy else None), "prefix long, n long")
                  .groupBy("prefix").agg(F.sum("n").alias("n")))
        # fewer than 4 * groups prefixes of a length can have such a share
        if level == 1:
            counts = land.put(counts, "words")
            total = counts.agg(F.sum("n")).first()[0] or 0
        got = counts.where(F.col("n") * F.lit(4 * groups) > F.lit(total)).select("prefix").collect()
        if not got:
            break
        heavy.append(np.sort(np.array([r["prefix"] for r in got], np.int64).view(np.uint64)))
    return heavy


# ------------------------------------------------------------ the operator

def repeats(texts: DataFrame, size: int = MIN_WORDS, anchor: int = ANCHOR, group_rows: int = GROUP_ROWS,
            levels: int = 6) -> DataFrame:
    """(doc_id, hashes of the windows that a document with a smaller id holds)."""
    spark = base.session_of(texts)
    base.batches(spark, None)       # a node is sent once a batch: larger ones send less
    chars = texts.agg(F.sum(F.length("text"))).first()[0] or 0
    groups = max(base.shuffle_width(spark), int(chars / 6 * 0.2 / group_rows) + 1)

    def first_pass(batches):
        for batch in batches:
            ids = batch.column("doc_id").to_numpy()
            hs, ds = [], []
            for i, j, buf, offsets in W.slices(batch.column("text")):
                w = W.scan(buf, offsets)
                p, h = anchors(w, size, anchor)
                hs.append(h)
                ds.append(ids[i:j][w.doc[p]])
            if hs:
                h, d = np.concatenate(hs), np.concatenate(ds)
                yield send(h, d, (W.mix(h) % np.uint64(groups)).astype(np.int64), groups, both=True)

    shared = group_nodes(texts.mapInArrow(first_pass, PACKED).repartition(groups, "bucket"), later_only=False)
    land = base.Landing(spark, "substring")
    shared = land.put(shared.groupBy("doc_id").agg(F.collect_set("hash").alias("anchors")), "anchors")
    heavy = heavy_prefixes(texts, groups, levels, land)
    land.drop("words")

    def second_pass(batches):
        for batch in batches:
            ids = batch.column("doc_id").to_numpy()
            lists = batch.column("anchors")
            hs, ds, rs = [], [], []
            for i, j, buf, offsets in W.slices(batch.column("text")):
                w = W.scan(buf, offsets)
                got = windows(w, size, anchor)
                if got is None or not len(got[2]):
                    continue
                r, least, start = got
                known = lists.slice(i, j - i)
                mine = np.sort(known.flatten().to_numpy().view(np.uint64)
                               ^ W.mix(np.repeat(np.arange(j - i, dtype=np.uint64), known.value_lengths().to_numpy())))
                key = least[start] ^ W.mix(w.doc[start].astype(np.uint64))
                at = np.minimum(np.searchsorted(mine, key), len(mine) - 1)
                start = start[mine[at] == key]
                _, h13 = W.runs(w, size)
                full = np.zeros(len(w.hash), np.uint64)
                full[got[2]] = h13
                hs.append(full[start])
                ds.append(ids[i:j][w.doc[start]])
                rs.append(prefix_route(w, start, heavy, groups))
            if hs:
                yield send(np.concatenate(hs), np.concatenate(ds), np.concatenate(rs), groups, both=False)

    left = texts.join(shared, "doc_id").select("doc_id", "text", "anchors")
    nodes = group_nodes(left.mapInArrow(second_pass, PACKED).repartition(groups, "bucket"), later_only=True)
    return nodes.groupBy("doc_id").agg(F.collect_set("hash").alias("repeats"))


CUT = "n_words long, n_removed long, kept string"


def cut_batch(text, repeats_col, size: int):
    """n_words, n_removed and the kept words of each text; ``repeats_col``:
    the window hashes to remove (null: none)."""
    n = len(text)
    words, removed, kept = np.zeros(n, np.int64), np.zeros(n, np.int64), [""] * n
    for i, j, buf, offsets in W.slices(text):
        w = W.scan(buf, offsets)
        words[i:j] = np.diff(w.bounds)
        drop = np.zeros(len(w.hash) + 1, np.int64)
        known = repeats_col.slice(i, j - i)
        if known.null_count < len(known):
            have = known.fill_null([]) if known.null_count else known
            mine = np.sort(have.flatten().to_numpy().view(np.uint64)
                           ^ W.mix(np.repeat(np.arange(j - i, dtype=np.uint64), have.value_lengths().to_numpy())))
            start, h = W.runs(w, size)
            key = h ^ W.mix(w.doc[start].astype(np.uint64))
            at = np.minimum(np.searchsorted(mine, key), max(0, len(mine) - 1))
            hit = start[mine[at] == key] if len(mine) else start[:0]
            np.add.at(drop, hit, 1)
            np.add.at(drop, hit + size, -1)
        gone = np.cumsum(drop)[:-1] > 0
        removed[i:j] = np.bincount(w.doc, weights=gone, minlength=j - i).astype(np.int64)
        # the kept words of the slice joined by one space, gathered as bytes
        keep = np.flatnonzero(~gone)
        length = w.end[keep] - w.start[keep] + 1
        total = int(length.sum())
        at_word = np.cumsum(length) - length
        src = np.ones(total, np.int64)
        if total:
            src[at_word[0]] = w.start[keep[0]]
            src[at_word[1:]] = w.start[keep[1:]] - (w.start[keep[:-1]] + length[:-1] - 1)
            src = np.minimum(np.cumsum(src), len(buf) - 1)
        joined = buf[src] if total else buf[:0]
        if total:
            joined = joined.copy()
            joined[at_word + length - 1] = 32
        raw = joined.tobytes()
        ends = np.concatenate([[0], np.cumsum(length)])
        cut = np.searchsorted(keep, w.bounds)
        for k in range(j - i):
            a, b = ends[cut[k]], ends[cut[k + 1]]
            kept[i + k] = raw[a: b - 1] if b > a else b""
    return words, removed, kept


def deduplicated(docs: DataFrame, size: int = MIN_WORDS, id_col: str = "doc_id", text_col: str = "text",
                 **options) -> DataFrame:
    """``doc_id``, ``n_words``, ``n_removed``, ``kept`` (the words that stay,
    joined by one space), one row a document."""
    every = base.texts_of(docs, id_col, text_col)
    texts = every.where(F.col("doc_id").isNotNull())
    marks = repeats(texts, size, **options)

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            words, removed, kept = cut_batch(batch.column("text"), batch.column("repeats"), size)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(words), pa.array(removed),
                 pa.array(kept, pa.binary()).cast(pa.string())], names=["doc_id", "n_words", "n_removed", "kept"])

    joined = texts.join(marks, "doc_id", "left").select("doc_id", "text", "repeats")
    nameless = every.where(F.col("doc_id").isNull()).withColumn("repeats", F.lit(None).cast("array<long>"))
    return joined.unionByName(nameless).mapInArrow(run, f"doc_id {docs.schema[id_col].dataType.simpleString()}, {CUT}")


def cut_texts(docs: DataFrame, size: int = MIN_WORDS, id_col: str = "doc_id", text_col: str = "text",
              length_col: str | None = "n_chars", **options) -> DataFrame:
    """The documents with repeated passages cut from their texts; a text that
    loses nothing stays as it is. All columns of ``docs``; ``length_col``, if
    present, follows a text that changed."""
    texts = base.texts_of(docs, id_col, text_col).where(F.col("doc_id").isNotNull())
    marks = repeats(texts, size, **options)
    mark = "__repeats"
    joined = docs.join(marks.select(F.col("doc_id").alias(id_col), F.col("repeats").alias(mark)), id_col, "left") \
        .select(*docs.columns, mark)
    t = docs.columns.index(text_col)
    c = docs.columns.index(length_col) if length_col in docs.columns else None

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            text = batch.column(t)
            _, removed, kept = cut_batch(text, batch.column(batch.num_columns - 1), size)
            was, change = text.to_pylist(), removed > 0
            new = [k.decode("utf-8") if x else o for k, x, o in zip(kept, change.tolist(), was)]
            cols = [batch.column(i) for i in range(batch.num_columns - 1)]
            cols[t] = pa.array(new, text.type)
            if c is not None:
                old = cols[c].to_pylist()
                cols[c] = pa.array([len(x) if y else o for x, y, o in zip(new, change.tolist(), old)], cols[c].type)
            yield pa.RecordBatch.from_arrays(cols, names=batch.schema.names[:-1])

    return joined.mapInArrow(run, docs.schema)
