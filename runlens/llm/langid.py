"""Language identification by interpolated Kneser-Ney character models.

One model per language over the letters of words (lower case, a word padded
by one boundary on each side; contexts never leave the word). All n-grams of
all languages are kept in one sorted array of 64-bit hashes beside a matrix
of log probabilities and one of log back-off weights, a column a language. A
text's language is the one with the lowest cross-entropy per predicted
character. Texts whose best cross-entropy lies beyond a threshold calibrated
on rows not used for the counts are rejected.

Training rows are bounded: at most ``fit_docs`` + ``calibration_docs``
labelled texts a language, the first by a hash of their id. The model's size
follows that bound, so it may be broadcast.

Defined cases: a null text, or one without a letter, is ``und`` with score 0
and counts as rejected; rows with a null id or repeated rows are scored like
any other; equal cross-entropies go to the language first by name; with no
training rows every text is ``und``. Other columns, whatever their names, are
neither read nor changed.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from itertools import repeat

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import base
from . import words as W

ORDER = 5
EDGE = 32
UNKNOWN = "und"


@dataclass
class Model:
    langs: list[str]
    order: int
    keys: np.ndarray            # sorted uint64 hashes of n-grams
    prob: np.ndarray            # [keys, langs] log p(last char | the others)
    back: np.ndarray            # [keys, langs] log weight of the shorter context
    floor: np.ndarray           # [langs] log probability of an unseen character
    spread: float               # cross-entropy of guessing among all characters
    limit: dict[str, float] = field(default_factory=dict)
    scale: float = 1.0


# ------------------------------------------------------------ n-grams

def gram_hashes(cp: np.ndarray, n: int, base: int = 0xA24BAED4963EE407 | 1) -> np.ndarray:
    """Hash of the n characters that end at each position (n - 1 and later)."""
    total = np.zeros(len(cp) - n + 1, np.uint64)
    for j in range(n):
        total = total * np.uint64(base) + cp[j: len(cp) - n + 1 + j]
    return W.mix(total + np.uint64((n * 0x9E3779B97F4A7C15) % (1 << 64)))


def letters(word: str, codes: bool = False) -> str:
    """Lower case; whatever is no letter parts words. Words with a digit
    (keys, numbers, codes) say nothing of a language, unless ``codes``."""
    word = word.lower()
    if word.isalpha():
        return word
    if not codes and any(c.isdigit() for c in word):
        return ""
    return "".join(c if c.isalpha() else " " for c in word)


def padded(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Code points of all words between edges, the distance to the last edge
    at each position, and the index of the word each position belongs to."""
    joined = " " + " ".join(texts) + " "
    cp = np.frombuffer(joined.encode("utf-32-le", "replace"), np.uint32).astype(np.uint64)
    edge = cp == EDGE
    at = np.where(edge, np.arange(len(cp)), 0)
    before = np.maximum.accumulate(at)
    depth = np.arange(len(cp)) - np.concatenate([[0], before[:-1]])
    # depth: characters since the last edge strictly before the position
    size = np.array([len(t) + 1 for t in texts])
    owner = np.concatenate([[0], np.repeat(np.arange(len(texts)), size)])
    return cp, depth, owner


def usable(cp: np.ndarray, depth: np.ndarray) -> np.ndarray:
    """Positions that are predicted: letters, and edges that end a word."""
    ok = (cp != EDGE) | (depth > 1)
    ok[0] = False
    return ok


def count_grams(texts: list[str], weights: np.ndarray, order: int):
    """Per order: hash, hash of the context, hash without the first character,
    whether it begins at an edge, count."""
    cp, depth, owner = padded(texts)
    ok = usable(cp, depth)
    weight = np.asarray(weights, np.int64)[owner]
    out = []
    hashes = {n: gram_hashes(cp, n) for n in range(1, order + 1) if len(cp) >= n}
    for n, h in hashes.items():
        pos = np.flatnonzero(ok & (depth >= n - 1))
        pos = pos[pos >= n - 1]
        if not len(pos):
            continue
        g = h[pos - n + 1]
        ctx = hashes[n - 1][pos - n + 1] if n > 1 else np.zeros(len(pos), np.uint64)
        suf = hashes[n - 1][pos - n + 2] if n > 1 else np.zeros(len(pos), np.uint64)
        bos = depth[pos] == n - 1
        u, first, inv = np.unique(g, return_index=True, return_inverse=True)
        cnt = np.bincount(inv, weights=weight[pos]).astype(np.int64)
        out.append((np.full(len(u), n), u, ctx[first], suf[first], bos[first], cnt))
    return [np.concatenate(x) for x in zip(*out)] if out else None


GRAMS = "lang string, n int, gram long, ctx long, suf long, bos boolean, cnt long"


def grams_of(rows: DataFrame, order: int) -> DataFrame:
    """n-gram counts per language: counted a partition, then summed."""

    def count(batches):
        import pyarrow as pa

        for batch in batches:
            langs = np.array(batch.column("lang").to_pylist(), dtype=object)
            texts = batch.column("text").to_pylist()
            for lang in sorted(set(langs.tolist())):
                words: dict[str, int] = {}
                for i in np.flatnonzero(langs == lang):
                    for w in texts[i].split():
                        words[w] = words.get(w, 0) + 1
                pure: dict[str, int] = {}
                for w, c in words.items():
                    for part in letters(w).split():
                        pure[part] = pure.get(part, 0) + c
                if not pure:
                    continue
                n, g, ctx, suf, bos, cnt = count_grams(list(pure), np.array(list(pure.values())), order)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * len(n), pa.string()), pa.array(n, pa.int32()),
                     *(pa.array(x.view(np.int64)) for x in (g, ctx, suf)), pa.array(bos), pa.array(cnt)],
                    names=["lang", "n", "gram", "ctx", "suf", "bos", "cnt"])

    return (rows.mapInArrow(count, GRAMS)
            .groupBy("lang", "n", "gram")
            .agg(F.first("ctx").alias("ctx"), F.first("suf").alias("suf"),
                 F.first("bos").alias("bos"), F.sum("cnt").alias("cnt")))


def train(table, langs: list[str], order: int) -> Model:
    """Interpolated Kneser-Ney from the (bounded) n-gram counts: orders below
    the highest use the number of distinct left neighbours, except n-grams
    that begin at an edge, which have none."""
    lang = np.asarray(table["lang"])
    n, bos, cnt = (np.asarray(table[c]) for c in ("n", "bos", "cnt"))
    gram, ctx, suf = (np.asarray(table[c]).astype(np.int64).view(np.uint64) for c in ("gram", "ctx", "suf"))
    keys = np.unique(gram)
    size = {k: None for k in range(1, order + 1)}
    prob = np.full((len(keys), len(langs)), np.nan)
    back = np.zeros((len(keys), len(langs)))
    sel1 = n == 1
    alphabet = len(np.unique(gram[sel1])) + 1
    floor = np.full(len(langs), -np.log(alphabet))
    # one row per distinct n-gram of any language
    _, first = np.unique(gram, return_index=True)
    key_n, key_ctx, key_suf = n[first], ctx[first], suf[first]
    ctx_at = np.clip(np.searchsorted(keys, key_ctx), 0, max(0, len(keys) - 1))
    suf_at = np.clip(np.searchsorted(keys, key_suf), 0, max(0, len(keys) - 1))
    for li, name in enumerate(langs):
        mine = lang == name
        raw = np.zeros(len(keys))
        raw[np.searchsorted(keys, gram[mine])] = cnt[mine]
        starts = np.zeros(len(keys), bool)
        starts[np.searchsorted(keys, gram[mine])] = bos[mine]
        left = np.zeros(len(keys))
        longer = mine & (n > 1)
        np.add.at(left, np.searchsorted(keys, suf[longer]), 1)
        adj = np.where((key_n == order) | starts, raw, np.where(raw > 0, np.maximum(left, 1), 0))
        for k in range(1, order + 1):
            of = np.flatnonzero(key_n == k)
            size[k] = len(of)
            if not len(of):
                continue
            c = adj[of]
            n1, n2 = (c == 1).sum(), (c == 2).sum()
            d = n1 / (n1 + 2 * n2) if n1 else 0.5
            d = min(max(d, 0.1), 0.95)
            if k == 1:
                total, kinds = c.sum(), (c > 0).sum()
                lam = d * kinds / total if total else 1.0
                p = np.maximum(c - d, 0) / max(total, 1) + lam / alphabet
                prob[of, li] = np.log(p)
                floor[li] = np.log(max(lam, 1e-6) / alphabet)
                continue
            where = ctx_at[of]
            total = np.bincount(where, weights=c, minlength=len(keys))
            kinds = np.bincount(where, weights=c > 0, minlength=len(keys))
            lam = np.where(total > 0, d * kinds / np.maximum(total, 1), 1.0)
            # contexts of length 1 that are an edge are no n-grams themselves
            back[:, li] = np.where((key_n == k - 1) & (total > 0), np.log(lam), back[:, li])
            if k == 2:
                edge_ctx = ~np.isin(key_ctx[of], keys)
                tot_e, kind_e = c[edge_ctx].sum(), (c[edge_ctx] > 0).sum()
                lam_e = d * kind_e / tot_e if tot_e else 1.0
                t = np.where(edge_ctx, tot_e, total[where])
                lw = np.where(edge_ctx, lam_e, lam[where])
            else:
                t, lw = total[where], lam[where]
            lower = np.exp(prob[suf_at[of], li])
            p = np.where(t > 0, np.maximum(c - d, 0) / np.maximum(t, 1) + lw * lower, lower)
            prob[of, li] = np.log(p)
    return Model(list(langs), order, keys, prob.astype(np.float32), back.astype(np.float32), floor,
                 float(np.log(alphabet)))


def word_scores(model: Model, words: list[str], codes: bool = False) -> np.ndarray:
    """[words, langs + 1]: negative log probability per language, and the
    number of predicted characters."""
    texts = [letters(w, codes) for w in words]
    cp, depth, owner = padded(texts)
    pos = np.flatnonzero(usable(cp, depth))
    width = len(model.langs)
    out = np.zeros((len(words), width + 1))
    if not len(pos) or not len(model.keys):
        return out
    value = np.zeros((len(pos), width))
    todo = np.arange(len(pos))
    hashes = {k: gram_hashes(cp, k) for k in range(1, model.order + 1) if len(cp) >= k}
    last = len(model.keys) - 1
    for k in range(model.order, 0, -1):
        if k not in hashes or not len(todo):
            continue
        p = pos[todo]
        fit = (depth[p] >= k - 1) & (p >= k - 1)
        act = todo[fit]
        p = pos[act]
        h = hashes[k][p - k + 1]
        at = np.minimum(np.searchsorted(model.keys, h), last)
        hit = model.keys[at] == h
        value[act[hit]] += model.prob[at[hit]]
        miss = act[~hit]
        if k > 1 and len(miss):
            q = pos[miss]
            hc = hashes[k - 1][q - k + 1]
            ac = np.minimum(np.searchsorted(model.keys, hc), last)
            ok = model.keys[ac] == hc
            value[miss[ok]] += model.back[ac[ok]]
        elif k == 1:
            value[miss] += model.floor
        todo = np.setdiff1d(todo, act[hit], assume_unique=True)
    who = owner[pos]
    for li in range(width):
        out[:, li] = -np.bincount(who, weights=value[:, li], minlength=len(words))
    out[:, width] = np.bincount(who, minlength=len(words))
    return out


# ------------------------------------------------------------ scoring texts

class Scorer:
    """Scores whole texts; the scores of words seen before are kept, up to
    ``keep`` words."""

    def __init__(self, model: Model, keep: int = 400_000):
        self.model, self.keep = model, keep
        self.reset()

    def reset(self):
        self.row: dict[int, int] = {}
        self.table = np.zeros((1024, len(self.model.langs) + 1))

    def texts(self, column) -> np.ndarray:
        """[texts, langs + 1] sums for an Arrow string column."""
        width = len(self.model.langs) + 1
        parts = [np.zeros((0, width))]
        for i, j, buf, offsets in W.slices(column):
            w = W.scan(buf, offsets)
            uniq, first, inv = np.unique(w.hash, return_index=True, return_inverse=True)
            if len(self.row) + len(uniq) > self.keep:
                self.reset()
            rows = np.fromiter(map(self.row.get, uniq.tolist(), repeat(-1)), np.int64, len(uniq))
            new = np.flatnonzero(rows < 0)
            if len(new):
                raw = buf.tobytes()
                at = first[new]
                got = word_scores(self.model, [raw[s:e].decode("utf-8", "replace") for s, e in
                                               zip(w.start[at].tolist(), w.end[at].tolist())])
                base = len(self.row)
                while base + len(new) > len(self.table):
                    self.table = np.concatenate([self.table, np.zeros_like(self.table)])
                self.table[base: base + len(new)] = got
                rows[new] = np.arange(base, base + len(new))
                self.row.update(zip(uniq[new].tolist(), rows[new].tolist()))
            of = rows[inv]
            sums = np.zeros((j - i, width))
            for c in range(width):
                sums[:, c] = np.bincount(w.doc, weights=self.table[of, c], minlength=j - i)
            parts.append(sums)
        return np.concatenate(parts)

    def decide(self, column):
        """(language or und, score 0 to 1, cross-entropy, rejected) a text."""
        m = self.model
        sums = self.texts(column)
        for i in np.flatnonzero(sums[:, -1] == 0) if m.langs else ():
            text = column[int(i)].as_py() or ""
            if any(c.isalpha() for c in text):      # letters in words with digits only
                sums[i] = word_scores(m, text.split(), codes=True).sum(0)
        n = sums[:, -1]
        none = n == 0
        if not m.langs:
            none[:] = True
            return np.full(len(n), UNKNOWN, object), np.zeros(len(n)), np.full(len(n), np.nan), none
        h = sums[:, :-1] / np.maximum(n, 1)[:, None]
        best = h.argmin(1)
        top = h[np.arange(len(n)), best]
        z = -(h - top[:, None]) * np.minimum(n, 400)[:, None] * m.scale
        score = np.where(none, 0.0, 1 / np.exp(z).sum(1))
        lang = np.array(m.langs, object)[best]
        limit = np.array([m.limit.get(x, np.inf) for x in m.langs])[best]
        lang[none] = UNKNOWN
        return lang, score, np.where(none, np.nan, top), none | (top > limit)


# ------------------------------------------------------------ the operator

def held_out(doc_id, folds: int = 5):
    """Fold 0 of crc32(id as text) is kept for testing."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % folds == 0, F.lit(False))


def fit(docs: DataFrame, fit_docs: int = 400, calibration_docs: int = 150, order: int = ORDER,
        id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", margin: float = 0.5) -> Model:
    """Learn from rows outside the test fold with a text and a language: at
    most ``fit_docs`` ids a language for the counts and ``calibration_docs``
    more for the rejection threshold and the scale of the score. Whole texts
    are read; an id that repeats counts once, by its smallest text. This is the
    bounded sample of labelled rows that a classifier may be fitted on."""
    base.batches(docs.sparkSession, 4)
    d = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"), F.col(lang_col).alias("lang"))
    usable_rows = d.where(F.col("lang").isNotNull() & F.col("text").isNotNull() & F.col("doc_id").isNotNull()
                          & ~held_out(F.col("doc_id")))
    # the first ids by a hash: of each language only those below a bound that
    # holds about four times as many are ranked at all. Ids are counted once,
    # however many rows they have; of an id's texts the smallest is read
    most = fit_docs + calibration_docs
    known = (usable_rows.select("doc_id", "lang").distinct()
             .withColumn("h", F.pmod(F.xxhash64("doc_id", F.lit(17)), F.lit(1 << 31))))
    sizes = known.groupBy("lang").agg(F.count("*").alias("n"))                  # a row a label
    order_by = Window.partitionBy("lang").orderBy("h", "doc_id")
    ids = (known.join(F.broadcast(sizes), "lang")
           .where(F.col("h") / float(1 << 31) * F.col("n") <= 4 * most + 40)
           .withColumn("rank", F.row_number().over(order_by)).where(F.col("rank") <= most)
           .select("doc_id", "lang", "rank"))
    # at most (fit_docs + calibration_docs) ids a language; dealt to all tasks,
    # as such a small table would else come together in one
    sample = (usable_rows.join(F.broadcast(ids), ["doc_id", "lang"])
              .groupBy("doc_id", "lang", "rank").agg(F.min("text").alias("text"))
              .repartition(base.shuffle_width(docs.sparkSession), "doc_id"))
    grams = grams_of(sample.where(F.col("rank") <= fit_docs), order).toPandas()
    langs = sorted(grams["lang"].unique().tolist())
    if not langs:
        return Model([], order, np.zeros(0, np.uint64), np.zeros((0, 0)), np.zeros((0, 0)), np.zeros(0), 0.0)
    model = train(grams, langs, order)

    def entropy(batches):
        import pyarrow as pa

        scorer = Scorer(model)
        for batch in batches:
            sums = scorer.texts(batch.column("text"))
            yield pa.RecordBatch.from_arrays([batch.column("lang"), pa.array(sums.tolist(), pa.list_(pa.float64()))],
                                             names=["lang", "sums"])

    rows = (sample.where((F.col("rank") > fit_docs) | (F.col("rank") % 8 == 0)).select("lang", "text")
            .mapInArrow(entropy, "lang string, sums array<double>").collect())
    calibrate(model, [(r["lang"], r["sums"]) for r in rows], margin)
    return model


def calibrate(model: Model, rows: list[tuple[str, list[float]]], margin: float) -> None:
    """Reject beyond the highest calibrated cross-entropy plus ``margin`` of
    the way up to that of unseen characters; scale the score to the least log
    loss on the same rows."""
    true, sums = [r[0] for r in rows if r[1][-1]], np.array([r[1] for r in rows if r[1][-1]])
    worst = model.spread
    if not len(true):
        model.limit = {x: worst for x in model.langs}
        return
    n = sums[:, -1]
    h = sums[:, :-1] / n[:, None]
    for li, name in enumerate(model.langs):
        own = h[[t == name for t in true], li]
        high = float(np.quantile(own, 0.999)) if len(own) else worst
        model.limit[name] = high + margin * max(0.0, worst - high) if high < worst else high * 1.25
    want = np.array([model.langs.index(t) for t in true])
    losses = []
    grid = (0.02, 0.05, 0.1, 0.2, 0.35, 0.5, 0.75, 1.0)
    for s in grid:
        z = -(h - h.min(1)[:, None]) * np.minimum(n, 400)[:, None] * s
        lp = z - np.log(np.exp(z).sum(1))[:, None]
        losses.append(-lp[np.arange(len(want)), want].mean())
    model.scale = grid[int(np.argmin(losses))]


DETECTED = "doc_id long, lang_pred string, score double, cross_entropy double, rejected boolean"


def detect(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row a document: ``lang_pred``, ``score``, ``cross_entropy``, ``rejected``."""
    base.batches(docs.sparkSession, 4)
    kept = docs.sparkSession.sparkContext.broadcast(vars(model))

    def run(batches):
        import pyarrow as pa

        scorer = Scorer(Model(**kept.value))
        for batch in batches:
            lang, score, h, rejected = scorer.decide(batch.column("text"))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(lang, pa.string()), pa.array(score),
                 pa.array(h, pa.float64(), mask=np.isnan(h)), pa.array(rejected)],
                names=["doc_id", "lang_pred", "score", "cross_entropy", "rejected"])

    return (docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
            .mapInArrow(run, DETECTED))


def keep_known(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """The documents that are not rejected, with all their columns as they are."""
    base.batches(docs.sparkSession, 4)
    kept = docs.sparkSession.sparkContext.broadcast(vars(model))
    at = docs.columns.index(text_col)

    def run(batches):
        import pyarrow as pa

        scorer = Scorer(Model(**kept.value))
        for batch in batches:
            rejected = scorer.decide(batch.column(at))[3]
            yield batch.filter(pa.array(~rejected))

    return docs.mapInArrow(run, docs.schema)
