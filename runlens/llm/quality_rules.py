"""Quality rules: an ordered list of learned threshold conjunctions.

Statistics of every whole text are gathered first. From those of a bounded
sample of labelled documents sequential covering learns rules for the low
class: a rule grows by the condition with the greatest information gain until
it covers no good document of the growing part, is pruned from its end on the
other part, and what it covers is taken away before the next one; it ends when
a rule no longer holds on the pruning part. The rules are ``feature > x`` or
``feature <= x`` conjunctions and become one ordered conditional expression.

Defined cases: a null or empty text has no words and fails the base rules; no
labels, or labels of one class: no learned rule, and the base rules alone
decide; equal gains go to the feature first by name and the lower threshold;
repeated rows are judged alike. Other columns are not read.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import base
from . import words as W

SYMBOLS = b"#*$%&|<>"
STATS = ("doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long")


def _per_text(flags: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    sums = np.concatenate([[0], np.cumsum(flags)])
    return np.diff(sums[offsets]).astype(np.int64)


def measure(buf: np.ndarray, offsets: np.ndarray) -> list[np.ndarray]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words of the
    texts ``buf[offsets[i]:offsets[i+1]]``."""
    w = W.scan(buf, offsets)
    n = len(offsets) - 1
    if not len(buf):
        return [np.zeros(n, np.int64)] * 5
    gap = np.zeros(256, bool)
    gap[[9, 10, 11, 12, 13, 32]] = True
    symbol = np.zeros(256, bool)
    symbol[list(SYMBOLS)] = True
    in_word = ~gap[buf]
    chars = _per_text(in_word & ((buf & 0xC0) != 0x80), offsets)
    symbols = _per_text(symbol[buf], offsets)

    # lines: runs between line breaks and text ends
    brk = np.flatnonzero(buf == 10)
    start = np.unique(np.concatenate([offsets[:-1], brk + 1]))
    start = start[start < len(buf)]
    doc = np.searchsorted(offsets, start, "right") - 1
    end = np.minimum(np.append(brk, len(buf))[np.searchsorted(brk, start)], offsets[doc + 1])
    words_to = np.concatenate([[0], np.cumsum(in_word)])
    worded = words_to[end] > words_to[start]
    start, end, doc = start[worded], end[worded], doc[worded]
    line = W.spans(buf, start, end)
    _, first = np.unique(line ^ W.mix(doc.astype(np.uint64) + np.uint64(1)), return_index=True)
    dup = np.bincount(doc, minlength=n) - np.bincount(doc[first], minlength=n)

    at, h = W.runs(w, 3)
    d = w.doc[at]
    _, inv, count = np.unique(h ^ W.mix(d.astype(np.uint64) + np.uint64(1)), return_inverse=True, return_counts=True)
    cover = np.zeros(len(w.hash) + 3, np.int64)
    many = at[count[inv] > 1] if len(at) else at
    for j in range(3):
        cover[many + j] = 1
    repeat = np.bincount(w.doc, weights=cover[: len(w.hash)], minlength=n).astype(np.int64)
    return [np.diff(w.bounds).astype(np.int64), chars, symbols, dup.astype(np.int64), repeat]


def statistics(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    def run(batches):
        import pyarrow as pa

        for batch in batches:
            parts = [measure(buf, off) for _, _, buf, off in W.slices(batch.column("text"))]
            if parts:
                cols = [np.concatenate(x) for x in zip(*parts)]
                yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *map(pa.array, cols)],
                                                 names=["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines",
                                                        "n_repeat_words"])

    return base.texts_of(docs, id_col, text_col).mapInArrow(run, STATS)


# ------------------------------------------------------------ features and base rules

def base_failed() -> Column:
    return (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


def features() -> dict[str, Column]:
    n = F.greatest(F.col("n_words"), F.lit(1)).cast("double")
    return {
        "dup_lines_per_word": F.col("n_dup_lines") / n,
        "repeat_share": F.col("n_repeat_words") / n,
        "symbols_per_word": F.col("n_symbols") / n,
        "word_length": F.col("word_chars") / n,
        "words": F.col("n_words").cast("double"),
    }


# ------------------------------------------------------------ learning

@dataclass(frozen=True)
class Condition:
    feature: str
    above: bool
    at: float

    def holds(self, table: dict[str, np.ndarray]) -> np.ndarray:
        x = table[self.feature]
        return x > self.at if self.above else x <= self.at

    def column(self) -> Column:
        f = features()[self.feature]
        return f > self.at if self.above else f <= self.at

    def __str__(self) -> str:
        return f"{self.feature} {'>' if self.above else '<='} {self.at:.6g}"


def covered(rule, table, n) -> np.ndarray:
    out = np.ones(n, bool)
    for c in rule:
        out &= c.holds(table)
    return out


def grow(table, low: np.ndarray, most: int = 4) -> list[Condition]:
    rule: list[Condition] = []
    here = np.ones(len(low), bool)
    while len(rule) < most:
        p0, n0 = (here & low).sum(), (here & ~low).sum()
        if not n0 or not p0:
            break
        best = None
        info0 = np.log2(p0 / (p0 + n0))
        for name in sorted(table):
            x = table[name][here]
            y = low[here]
            order = np.argsort(x, kind="stable")
            xs, ys = x[order], y[order]
            edge = np.flatnonzero(xs[1:] > xs[:-1])
            if not len(edge):
                continue
            p = np.cumsum(ys)[edge]
            n = edge + 1 - p
            cut = (xs[edge] + xs[edge + 1]) / 2        # half way to the next value
            for above, pp, nn in ((False, p, n), (True, p0 - p, n0 - n)):
                with np.errstate(divide="ignore", invalid="ignore"):
                    gain = np.where(pp > 0, pp * (np.log2(pp / (pp + nn)) - info0), -1.0)
                i = int(np.argmax(gain))
                if gain[i] > 0 and (best is None or gain[i] > best[0] + 1e-12):
                    best = (gain[i], Condition(name, above, float(cut[i])))
        if best is None:
            break
        rule.append(best[1])
        here = here & best[1].holds(table)
    return rule


def prune(rule, table, low) -> list[Condition]:
    def value(r) -> float:
        c = covered(r, table, len(low))
        p, n = (c & low).sum(), (c & ~low).sum()
        return (p - n) / (p + n) if p + n else -1.0

    best = list(rule)
    for size in range(len(rule) - 1, 0, -1):
        if value(rule[:size]) >= value(best):
            best = list(rule[:size])
    return best


def learn(table: dict[str, np.ndarray], low: np.ndarray, part: np.ndarray, precision: float = 0.97,
          most_rules: int = 12) -> list[list[Condition]]:
    """Sequential covering; ``part``: true for growing, false for pruning."""
    rules, left = [], np.ones(len(low), bool)
    while len(rules) < most_rules:
        g, v = left & part, left & ~part
        if not (g & low).any():
            break
        rule = grow({k: x[g] for k, x in table.items()}, low[g])
        if not rule:
            break
        tv = {k: x[v] for k, x in table.items()}
        rule = prune(rule, tv, low[v])
        c = covered(rule, tv, int(v.sum()))
        p, n = (c & low[v]).sum(), (c & ~low[v]).sum()
        every = covered(rule, table, len(low)) & left
        good = (every & ~low).sum()
        if p + n == 0 or p / (p + n) < precision or good > (1 - precision) * every.sum():
            break
        rules.append(rule)
        left &= ~every
    return rules


def decision(rules: list[list[Condition]]) -> Column:
    """The number (from 1) of the first rule that holds; 0: none."""
    if not rules:
        return F.lit(0)
    out = None
    for i, rule in enumerate(rules, 1):
        cond = rule[0].column()
        for c in rule[1:]:
            cond = cond & c.column()
        out = F.when(cond, i) if out is None else out.when(cond, i)
    return out.otherwise(0)


def fit(stats: DataFrame, labels: DataFrame, sample: int = 20_000, label_col: str = "quality") -> list[list[Condition]]:
    """Rules from at most ``sample`` labelled documents that pass the base
    rules, the first by a hash of their id."""
    feats = features()
    known = (stats.where(~base_failed()).select("doc_id", *[c.alias(k) for k, c in feats.items()])
             .join(labels.where(F.col(label_col).isNotNull()).groupBy("doc_id")
                   .agg(F.min(label_col).alias("label")), "doc_id")
             .withColumn("order", F.xxhash64("doc_id", F.lit(3))).orderBy("order", "doc_id").limit(sample))
    rows = known.collect()
    if not rows:
        return []
    table = {k: np.array([r[k] for r in rows], float) for k in feats}
    low = np.array([r["label"] == 0 for r in rows])
    if low.all() or not low.any():
        return []
    part = np.array([(r["order"] >> 7) % 3 != 0 for r in rows])
    return learn(table, low, part)


def judged(docs: DataFrame, labels: DataFrame, sample: int = 20_000) -> tuple[DataFrame, list[list[Condition]]]:
    """(statistics with ``base_failed``, ``rule`` and ``kept``, the rules)."""
    land = base.Landing(base.session_of(docs), "quality-rules")
    stats = land.put(statistics(docs), "statistics")
    rules = fit(stats, labels, sample)
    out = stats.withColumn("base_failed", base_failed()).withColumn("rule", decision(rules))
    return out.withColumn("kept", ~F.col("base_failed") & (F.col("rule") == 0)), rules
