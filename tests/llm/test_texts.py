"""Operators on text statistics and classes: words, quality, language, licences."""

import collections
import random
import re
import textwrap

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from runlens.llm import langid, licenses, quality_ordinal, quality_rules
from runlens.llm import words as W

WORD = re.compile("[^\x20\x09-\x0D]+")
DOC = "doc_id long, text string, lang string, source string, n_chars long"


def make(spark, texts, lang="en"):
    return spark.createDataFrame([(i, t, lang, "s", 0) for i, t in enumerate(texts)], DOC)


texts_st = st.lists(st.text(alphabet="ab \n\té\x0b#$|　", max_size=40), min_size=1, max_size=8)


@settings(max_examples=60, deadline=None)
@given(texts_st)
def test_words_are_found_on_bytes(texts):
    col = pa.array(texts, pa.string())
    got = [[] for _ in texts]
    for i, j, buf, off in W.slices(col, limit=16):
        w = W.scan(buf, off)
        for d, s, e in zip(w.doc, w.start, w.end):
            got[i + d].append(buf[s:e].tobytes().decode())
        assert len({(bytes(buf[s:e]), int(h)) for s, e, h in zip(w.start, w.end, w.hash)}) == \
            len({bytes(buf[s:e]) for s, e in zip(w.start, w.end)})
    assert got == [WORD.findall(t) for t in texts]


def stats_of(t):
    t = t or ""
    w = WORD.findall(t)
    seen, dup = set(), 0
    for line in t.split("\n"):
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    n = len(w)
    count = collections.Counter(tuple(w[i:i + 3]) for i in range(n - 2))
    cover = {j for i in range(n - 2) if count[tuple(w[i:i + 3])] > 1 for j in (i, i + 1, i + 2)}
    return n, sum(map(len, w)), sum(c in "#*$%&|<>" for c in t), dup, len(cover)


@settings(max_examples=80, deadline=None)
@given(texts_st)
def test_quality_statistics(texts):
    col = pa.array(texts, pa.string())
    parts = [quality_rules.measure(buf, off) for _, _, buf, off in W.slices(col, limit=25)]
    got = list(zip(*[np.concatenate(x).tolist() for x in zip(*parts)]))
    assert got == [stats_of(t) for t in texts]


def test_rules_learn_and_cover_edge_cases(spark):
    random.seed(1)
    good = [" ".join(random.choice("abcdefgh") * random.randint(2, 8) + str(i) for i in range(random.randint(60, 90)))
            for _ in range(120)]
    bad = [t.replace(" ", "$$$ ") for t in good[:60]]
    texts = good + bad + [None, "", "short", "x " * 100, "w" * 200_000]
    docs = make(spark, texts).withColumn("kept", F.lit("clash")).withColumn("rule", F.lit(1))
    labels = spark.createDataFrame([(i, 1) for i in range(120)] + [(i, 0) for i in range(120, 180)] + [(120, 0), (5, None)],
                                   "doc_id long, quality int")
    out, rules = quality_rules.judged(docs, labels)
    rows = {r.doc_id: r for r in out.collect()}
    assert len(rows) == len(texts) and rules
    assert all(rows[i].kept for i in range(120)) and not any(rows[i].kept for i in range(120, 180))
    assert rows[180].n_words == 0 and rows[180].base_failed and rows[182].base_failed and rows[183].base_failed
    for i, t in enumerate(texts):
        r = rows[i]
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == stats_of(t)
    # no labels: base rules alone; an empty table: no rows
    none, rules = quality_rules.judged(docs, labels.limit(0))
    assert rules == [] and none.where("kept = base_failed").isEmpty()
    assert quality_rules.judged(docs.limit(0), labels)[0].collect() == []


def test_ordinal_regression(spark):
    random.seed(2)
    vocab = ["tree", "house", "river", "cloud", "stone", "field", "light", "paper"]
    texts, grades = [], []
    for i in range(300):
        w = [random.choice(vocab) for _ in range(40)]
        g = i % 3
        if g < 2:
            w[::5] = ["awful"] * len(w[::5])
        if g < 1:
            w = [x + "%%%" for x in w]
        texts.append(" ".join(w))
        grades.append((i, g))
    texts += [None, "", "tree " * 50_000]
    docs = make(spark, texts).withColumn("kept", F.lit(0))
    table = spark.createDataFrame(grades + [(3, None), (None, 1)], "doc_id long, grade int")
    model = quality_ordinal.fit(docs, table)
    assert model.cuts[0] < model.cuts[1]
    rows = {r.doc_id: r for r in quality_ordinal.graded(docs, model).collect()}
    assert len(rows) == len(texts)
    mean = [np.mean([rows[i].expected_grade for i, g in grades if g == k]) for k in range(3)]
    assert mean[0] < 0.5 < mean[1] < 1.5 < mean[2]
    right = np.mean([rows[i].kept == (g == 2) for i, g in grades])
    assert right > 0.97
    assert all(0 <= r.expected_grade <= 2 and 0 <= r.top_probability <= 1 for r in rows.values())
    # no grades, one grade, an empty table
    assert quality_ordinal.fit(docs, table.limit(0)) is None
    assert quality_ordinal.fit(docs, table.where("grade = 1")) is None
    assert quality_ordinal.graded(docs, None).where("kept").count() == len(texts)
    assert quality_ordinal.graded(docs.limit(0), model).collect() == []


def test_ordinal_gradient_by_differences():
    rng = np.random.default_rng(0)
    n, bits = 60, 6
    doc = np.repeat(np.arange(n), 5)
    feat = rng.integers(0, 1 << bits, len(doc))
    value = rng.random(len(doc))
    grade = rng.integers(0, 3, n)
    a = quality_ordinal.train(doc, feat, value, grade, bits=bits, rounds=400, least_docs=1, decay=0.0)

    def loss(w, cuts):
        s = np.bincount(doc, weights=value * w[feat], minlength=n)
        p = np.concatenate([np.zeros((n, 1)), quality_ordinal.sigmoid(cuts[None] - s[:, None]), np.ones((n, 1))], 1)
        return -np.log(np.maximum(p[np.arange(n), grade + 1] - p[np.arange(n), grade], 1e-12)).mean()

    w = a.weights.astype(float)
    here = loss(w, a.cuts)
    base = loss(np.zeros(1 << bits), np.log(np.array([(grade <= k).mean() / (1 - (grade <= k).mean()) for k in (0, 1)])))
    assert here < base
    assert loss(w, a.cuts + np.array([0.3, 0.3])) > here and loss(w, a.cuts - np.array([0.3, 0.3])) > here


LANGS = {"en": "the quick brown fox jumps over the lazy dog and then the other foxes think of something else",
         "de": "der schnelle braune fuchs springt über den faulen hund und dann denken die anderen füchse nach",
         "xx": "зелёный лес шумит над рекой пока люди собирают ягоды и грибы до самого вечера"}


def lang_docs(spark, n=60):
    random.seed(4)
    rows = []
    for i in range(n):
        lang = sorted(LANGS)[i % 3]
        w = LANGS[lang].split()
        random.shuffle(w)
        rows.append((i, " ".join(w * 2).capitalize() + ".", lang, "s", 0))
    extra = [(1000, None, "en", "s", 0), (1001, "", None, "s", 0), (1002, "123 456 !!", "de", "s", 0), (1003, "a1b2", "en", "s", 0),
             (None, rows[0][1], "de", "s", 0), (5, rows[5][1], rows[5][2], "s", 0), (1004, "fox " * 60_000, None, "s", 0)]
    return spark.createDataFrame(rows + extra, DOC), rows


def test_language_models(spark):
    docs, rows = lang_docs(spark)
    docs = docs.withColumn("lang_pred", F.lit("clash")).withColumn("score", F.lit(1))
    model = langid.fit(docs)
    assert model.langs == sorted(LANGS)
    assert (np.diff(model.keys.astype(object)) > 0).all()
    got = [r for r in langid.detect(docs, model).collect()]
    assert len(got) == 67
    by = collections.defaultdict(list)
    for r in got:
        by[r.doc_id].append(r)
    assert all(by[i][0].lang_pred == lang and not by[i][0].rejected for i, _, lang, _, _ in rows)
    assert len(by[5]) == 2 and by[5][0] == by[5][1] and by[None][0].lang_pred == by[0][0].lang_pred
    for i in (1000, 1001, 1002):
        assert by[i][0].lang_pred == "und" and by[i][0].score == 0 and by[i][0].rejected
    assert by[1003][0].lang_pred in LANGS and by[1004][0].lang_pred == "en"
    assert all(0 <= r.score <= 1 for r in got)
    kept = langid.keep_known(docs, model)
    assert kept.columns == docs.columns
    ids = {r.doc_id for r in kept.collect()}
    assert not ids & {1000, 1001, 1002} and set(range(60)) <= ids
    # nothing to learn from
    empty = langid.fit(docs.limit(0))
    assert {r.lang_pred for r in langid.detect(docs, empty).collect()} == {"und"}
    assert langid.detect(docs.limit(0), model).collect() == []


def test_language_of_many_rows_under_few_ids(spark):
    """20,000 rows over 8 ids are eight labelled texts, and are learned."""
    _, rows = lang_docs(spark)
    de = [(1000 + i, r[1], "de") for i, r in enumerate(r for r in rows if r[2] == "de")]
    en = [r[1] for r in rows if r[2] == "en"]
    few = spark.createDataFrame([(i, t) for i, t in enumerate(en[:8] or en)], "k long, text string")
    many = spark.range(20_000).withColumn("k", F.col("id") % 8).join(few, "k").select(
        (F.col("k") + 1).alias("doc_id"), "text", F.lit("en").alias("lang"))
    docs = many.unionByName(spark.createDataFrame(de, "doc_id long, text string, lang string"))
    model = langid.fit(docs)
    assert model.langs == ["de", "en"]


def test_kneser_ney_sums_to_one():
    texts = ["abra", "cadabra", "abc", "bad"]
    n, g, ctx, suf, bos, cnt = langid.count_grams(texts, np.array([3, 1, 2, 1]), 3)
    table = {"lang": np.array(["x"] * len(n), object), "n": n, "gram": g.view(np.int64), "ctx": ctx.view(np.int64),
             "suf": suf.view(np.int64), "bos": bos, "cnt": cnt}
    model = langid.train(table, ["x"], 3)
    letters = "abcdr"
    for word in ("a", "ab", "abr", "zz"):         # an empty word does not end: it has no such prediction
        total = 0.0
        for nxt in letters:
            total += np.exp(-(langid.word_scores(model, [word + nxt])[0, 0] - prefix(model, word + nxt)))
        end = np.exp(-(langid.word_scores(model, [word])[0, 0] - start(model, word))) if word else 0.0
        unseen = np.exp(-(langid.word_scores(model, [word + "q"])[0, 0] - prefix(model, word + "q")))
        assert total + end + unseen == pytest.approx(1.0, abs=0.02), word


def ends(model, word):
    """Minus log p(end | word): by the model's own arrays."""
    cp, depth, _ = langid.padded([word])
    pos = np.array([len(cp) - 1])
    return lookup(model, cp, depth, pos[0])


def lookup(model, cp, depth, p):
    value = 0.0
    for k in range(model.order, 0, -1):
        if depth[p] < k - 1 or p < k - 1:
            continue
        h = langid.gram_hashes(cp, k)[p - k + 1]
        i = np.searchsorted(model.keys, h)
        if i < len(model.keys) and model.keys[i] == h:
            return -(value + model.prob[i, 0])
        if k == 1:
            return -(value + model.floor[0])
        c = langid.gram_hashes(cp, k - 1)[p - k + 1]
        i = np.searchsorted(model.keys, c)
        if i < len(model.keys) and model.keys[i] == c:
            value += model.back[i, 0]
    return -value


def prefix(model, word):
    """Everything of a word's score but its last letter."""
    cp, depth, _ = langid.padded([word])
    total = langid.word_scores(model, [word])[0, 0]
    return total - lookup(model, cp, depth, len(cp) - 2)


def start(model, word):
    return langid.word_scores(model, [word])[0, 0] - ends(model, word)


def test_licence_paragraphs(spark):
    filler = ["the rain fell on the quiet town all night", "nothing of the sort was ever said by them",
              "she may use this file as she likes"] * 20
    lic = {f: ts[0] for f, ts in licenses.TEMPLATES.items()}
    texts = [f"{a}\n{t}" for a, t in zip(filler, lic.values())] + filler + [
        None, "", "licensed", "Note: " + lic["MIT"], "word " * 100_000 + "\n" + lic["GPL-3.0"], "the licence of the town fool"]
    docs = make(spark, texts).withColumn("family", F.lit(0)).withColumn("line", F.lit("x"))
    docs = docs.union(docs.where("doc_id = 0"))
    model = licenses.fit(docs)
    rows = [r for r in licenses.scanned(docs, model).collect()]
    got = {(r.doc_id, r.paragraph): r for r in rows}
    assert len(got) == len(rows)
    for i, f in enumerate(lic):
        r = got[(i, 1)]
        assert r.family == f and r.confirmed, (f, r)
    assert got[(0, 1)].copies == 2
    n = len(lic) + len(filler)
    assert got[(n + 3, 0)].family == "MIT" and got[(n + 4, 1)].family == "GPL-3.0"
    assert not any(r.confirmed for (d, p), r in got.items() if len(lic) <= d < n)
    # brute force: the score of every paragraph, without any search for anchors
    want = {}
    for i, t in enumerate(texts):
        for p, line in enumerate((t or "").split("\n")):
            ps = licenses.pairs_of(line)
            best = max(((licenses.score(model, ps, f), f) for f in model.families), key=lambda x: (x[0], -ord(x[1][0])))
            if best[0] >= model.likely:
                want[(i, p)] = round(best[0], 6)
    assert {k: round(r.probability, 6) for k, r in got.items()} == want
    assert licenses.scanned(docs.limit(0), model).collect() == []
    assert licenses.fit(docs.limit(0)).families == sorted(licenses.TEMPLATES)


def test_licence_notices_wrapped_over_lines(spark):
    filler = ["the rain fell on the quiet town all night", "nothing of the sort was ever said by them"]
    long = [(f, t) for f, ts in licenses.TEMPLATES.items() for t in ts if len(t) > 80]
    assert {f for f, _ in long} >= {"MIT", "BSD-3-Clause", "GPL-3.0", "Apache-2.0"}
    texts, want = [], []
    for f, t in long:
        for width in (20, 70, 75, 80):
            for lead in ("", "# ", " * "):
                cut = [lead + x for x in textwrap.wrap(t, width, break_long_words=False)]
                texts.append("\n".join([filler[0], "", "by the author:", *cut, filler[1]]))
                want.append((f, 3, 3 + len(cut)))
    for tail in ("", "\n\n" + texts[0]):          # two copies in one block; then a third in another
        cut = textwrap.wrap(long[-1][1], 72)
        texts.append("\n".join([*cut, *cut]) + tail)
    apart = [line for line in textwrap.wrap(long[-1][1], 72)]
    texts.append("\n\n".join(apart))              # no block of several lines
    docs = make(spark, texts + filler * 10)
    model = licenses.fit(docs)
    rows = licenses.scanned(docs.union(docs.where("doc_id = 1")), model).collect()
    got = {}
    for r in rows:
        got.setdefault(r.doc_id, []).append(r)
    for i, (f, a, b) in enumerate(want):
        sure = [r for r in got.get(i, []) if r.confirmed]
        assert sure and {r.family for r in sure} == {f}, (i, f, got.get(i), texts[i])
        assert all(a <= r.paragraph and r.paragraph + r.lines <= b for r in sure), (sure, texts[i])
        assert max(r.template_share for r in sure) >= 0.6
    assert {r.copies for r in got[1]} == {2} and {r.copies for r in got[0]} == {1}
    n = len(want)
    assert len([r for r in got[n] if r.confirmed]) == 2 and len([r for r in got[n + 1] if r.confirmed]) == 3
    assert not any(r.lines > 1 for r in got.get(n + 2, []))
    assert not any(r.confirmed for d, rs in got.items() if d > n + 2 for r in rs)


def test_licence_text_of_many_blocks(spark):
    """A notices file: 16,000 blocks in a text of about a megabyte, and the
    same notice 600 times in one block."""
    import time

    lines = {f: ts[0] for f, ts in licenses.TEMPLATES.items()}
    many = "\n\n".join(f"package number {i}\n{lines['MIT']}" for i in range(16_000))
    cut = textwrap.wrap(next(t for t in licenses.TEMPLATES["MIT"] if len(t) > 80), 72)
    docs = make(spark, [many, "\n".join(cut * 600), "plain words of no matter"])
    model = licenses.fit(make(spark, ["the rain fell on the quiet town all night", "nothing was ever said by them"] * 10))
    began = time.time()
    rows = licenses.scanned(docs, model).collect()
    assert time.time() - began < 120                       # 19,200 lines; not a square of them
    sure = [r for r in rows if r.confirmed]
    assert sorted(r.paragraph for r in sure if r.doc_id == 0) == [3 * i + 1 for i in range(16_000)]
    assert {r.family for r in sure} == {"MIT"}
    held = sorted((r.paragraph, r.paragraph + r.lines) for r in sure if r.doc_id == 1)
    assert len(held) == 600 and all(a <= k * len(cut) + len(cut) // 2 < b for k, (a, b) in enumerate(held))
