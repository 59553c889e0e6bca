"""Near duplicates and repeated passages against brute force."""

import collections
import hashlib
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from runlens.llm import components, near_dup, substring
from runlens.llm import base
from runlens.llm import words as W

WORD = re.compile("[^\x20\x09-\x0D]+")
DOC = "doc_id long, text string, lang string, source string, n_chars long"


def make(spark, rows):
    return spark.createDataFrame([(i, t, "en", "s", 7) for i, t in rows], DOC)


def runs(text):
    w = WORD.findall(text or "")
    if 0 < len(w) < 5:
        return collections.Counter([tuple(w)])
    return collections.Counter(tuple(w[i:i + 5]) for i in range(len(w) - 4))


def brute_classes(rows, t=0.8):
    ids = sorted({i for i, _ in rows if i is not None})
    up = {i: i for i in ids}

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    sets = [(i, runs(x)) for i, x in rows if i is not None]
    for a, (i, x) in enumerate(sets):
        for j, y in sets[:a]:
            both, either = sum((x & y).values()), sum((x | y).values())
            if either and both >= t * either:
                p, q = find(i), find(j)
                up[max(p, q)] = min(p, q)
    return {i: find(i) for i in ids}


def mutate(words, k, rnd):
    words = list(words)
    for _ in range(k):
        words[rnd.randrange(len(words))] = f"m{rnd.randrange(10 ** 6)}"
    return words


def corpus(seed):
    rnd = random.Random(seed)
    vocab = [f"w{i}" for i in range(400)]
    docs = []
    for _ in range(25):
        base_words = [rnd.choice(vocab) for _ in range(rnd.choice([3, 20, 60, 120]))]
        docs.append(base_words)
        docs += [mutate(base_words, rnd.randint(0, 6), rnd) for _ in range(rnd.randint(0, 5))]
    hub = [rnd.choice(vocab) for _ in range(100)]
    docs += [mutate(hub, rnd.choice([0, 1, 1, 2, 2, 3, 4, 6, 9]), rnd) for _ in range(70)]       # a large group
    chain = hub[:]
    for _ in range(12):                                                                        # copies of copies
        chain = mutate(chain, 2, rnd)
        docs.append(chain)
    docs += [["la"] * 50, ["la"] * 53, ["la"] * 90]                                              # weights matter
    rnd.shuffle(docs)
    rows = [(i, " ".join(d)) for i, d in enumerate(docs)]
    return rows + [(1000, None), (1001, ""), (1002, " \n"), (None, rows[0][1]), (4, rows[4][1]), (5, rows[9][1]),
                   (1003, "one two"), (1004, "one  two"), (1005, "x " * 40_000 + "y"), (1006, "x " * 40_000 + "z")]


@pytest.mark.parametrize("seed", [1, 2])
def test_classes_equal_brute_force(spark, seed):
    rows = corpus(seed)
    docs = make(spark, rows).withColumn("class_id", F.lit("clash")).withColumn("node", F.lit(1))
    found = near_dup.classes(docs)
    got = [(r.doc_id, r.class_id) for r in found.collect()]
    assert len(got) == len(dict(got)) and dict(got) == brute_classes(rows)


def test_one_of_each_class_stays(spark):
    rows = corpus(1)
    docs = make(spark, rows)
    out = near_dup.keep_one(docs)
    assert out.columns == docs.columns
    got = sorted((r.doc_id is None, r.doc_id or 0) for r in out.collect())
    want = sorted([(False, i) for i, c in brute_classes(rows).items() if i == c] + [(True, 0)])
    assert got == want
    assert near_dup.keep_one(docs.limit(0)).collect() == []


def test_signature_estimates_weighted_similarity():
    rng = np.random.default_rng(5)
    h = rng.integers(0, 2 ** 63, 200, dtype=np.uint64)
    a = rng.integers(1, 9, 200)
    b = np.maximum(1, a + rng.integers(-2, 3, 200))
    m = 4096
    sig = near_dup.signatures(np.repeat([0, 1], 200), np.concatenate([h, h]), np.concatenate([a, b]), 2, m)
    want = np.minimum(a, b).sum() / np.maximum(a, b).sum()
    assert abs((sig[0] == sig[1]).mean() - want) < 4 * (want * (1 - want) / m) ** 0.5
    # the same whatever else is in the batch
    alone = near_dup.signatures(np.zeros(200, int), h, a, 1, m)
    assert (alone[0] == sig[0]).all()


def test_components_on_long_chains(spark):
    rnd = random.Random(0)
    ids = list(range(300))
    rnd.shuffle(ids)
    edges = list(zip(ids, ids[1:]))[:200] + [(ids[250], ids[251]), (7, 7)]
    df = spark.createDataFrame(edges, "a long, b long")
    got = {r.node: r.label for r in components.components(df, base.Landing(spark, "test"), "c").collect()}
    chain = ids[:201]
    pair = ids[250:252]
    want = {i: min(chain) for i in chain} | {i: min(pair) for i in pair}
    assert got == want


def brute_cut(rows, size=13):
    low = {}
    for i, t in rows:
        if i is not None:
            w = WORD.findall(t or "")
            for k in range(len(w) - size + 1):
                key = tuple(w[k:k + size])
                low[key] = min(low.get(key, i), i)
    out = []
    for i, t in rows:
        w = WORD.findall(t or "")
        gone = [False] * len(w)
        for k in range(len(w) - size + 1):
            if i is not None and low[tuple(w[k:k + size])] < i:
                gone[k:k + size] = [True] * size
        out.append((i, len(w), sum(gone), " ".join(x for x, g in zip(w, gone) if not g)))
    return sorted(out, key=repr)


def passages(seed):
    rnd = random.Random(seed)
    vocab = [f"v{i}é" for i in range(30)]
    shared = [[rnd.choice(vocab) for _ in range(rnd.choice([12, 13, 14, 40]))] for _ in range(6)]
    rows = []
    for i in range(60):
        w = []
        for _ in range(rnd.randint(0, 4)):
            w += rnd.choice(shared) if rnd.random() < 0.6 else [f"u{rnd.randrange(10 ** 6)}" for _ in range(rnd.randint(1, 20))]
        rows.append((i * 3 - 20, rnd.choice([" ", "\n", " \t "]).join(w)))
    rows += [(500, "la " * 300), (501, "la " * 12), (502, "la " * 13), (503, None), (504, ""), (None, rows[5][1]), (None, None),
             (505, " ".join(shared[5])), (505, " ".join(shared[5])), (506, "z " * 100_000)]
    return rows


@pytest.mark.parametrize("seed", [1, 2])
def test_cut_words_equal_brute_force(spark, seed):
    rows = passages(seed)
    docs = make(spark, rows).withColumn("repeats", F.lit("clash")).withColumn("hash", F.lit(1))
    got = sorted(((r.doc_id, r.n_words, r.n_removed, r.kept) for r in substring.deduplicated(docs).collect()), key=repr)
    assert got == brute_cut(rows)


def test_cut_texts_keep_columns(spark):
    rows = passages(3)
    docs = make(spark, rows)
    want = collections.defaultdict(list)
    for i, _, removed, kept in brute_cut(rows):
        want[i].append((removed, kept))
    out = substring.cut_texts(docs)
    assert out.columns == docs.columns
    got = out.collect()
    assert len(got) == len(rows)
    texts = collections.defaultdict(list)
    for i, t in rows:
        texts[i].append(t)
    for r in got:
        removed, kept = want[r.doc_id][0]
        if removed:
            assert r.text == kept and r.n_chars == len(kept)
        else:
            assert r.text in texts[r.doc_id] and r.n_chars == 7
    assert substring.deduplicated(docs.limit(0)).collect() == []
    assert substring.cut_texts(docs.limit(0)).collect() == []


def test_heavy_prefixes_only_change_the_grouping(spark):
    rows = passages(9)
    docs = make(spark, rows)
    texts = base.texts_of(docs).where("doc_id is not null")
    # counts over all texts, one word more below heavy ones only
    heavy = substring.heavy_prefixes(texts, 2, 6, base.Landing(spark, "test-heavy"))
    assert 0 < len(heavy[0]) < 8
    words = collections.Counter(x for _, t in rows if t for x in t.split())
    total = sum(words.values())
    assert len(heavy[0]) == sum(8 * n > total for n in words.values())
    a = {r.doc_id: sorted(r.repeats) for r in substring.repeats(texts).collect()}
    b = {r.doc_id: sorted(r.repeats) for r in substring.repeats(texts, group_rows=10).collect()}
    assert a == b


def test_anchors_are_the_same_in_equal_windows():
    text = ("p q r s t u v w x y z a b c d e f g").encode()
    buf = np.frombuffer(text + b"11 22 " + text, np.uint8)
    one = W.scan(np.frombuffer(text, np.uint8), np.array([0, len(text)]))
    p, h = substring.anchors(one, 13, 5)
    two = W.scan(buf, np.array([0, len(text), len(buf)]))
    q, g = substring.anchors(two, 13, 5)
    assert set(h.tolist()) <= set(g.tolist()) and hashlib.md5(one.hash.tobytes()).digest() == \
        hashlib.md5(two.hash[: len(one.hash)].tobytes()).digest()
