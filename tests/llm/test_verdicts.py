"""Verdicts of learned operators: rules applied by plain Python, held-out
accuracy, and rejection of languages that were not learned."""

import pytest
from pyspark.sql import functions as F

from runlens.llm import base, langid, quality_rules
from runlens.llm import queries as q
from test_texts import stats_of

SMALL, MEDIUM, LARGE = (f"/root/testdata/sf{x}" for x in ("0.001", "0.01", "0.1"))


def test_rule_verdicts_by_plain_python(spark):
    """Base rules, then the learned list from its first rule on."""
    docs = base.table(spark, MEDIUM, "documents")
    _, rules = quality_rules.judged(docs, base.table(spark, MEDIUM, "labels"))
    got = {r.doc_id: r for r in q.op3_quality_rules(spark, MEDIUM).collect()}
    rows = docs.select("doc_id", "text").collect()
    assert len(got) == len(rows) and rules
    for doc, text in rows:
        words, chars, symbols, dup, repeat = stats_of(text)
        n = float(max(words, 1))
        feature = {"dup_lines_per_word": dup / n, "repeat_share": repeat / n, "symbols_per_word": symbols / n, "word_length": chars / n,
                   "words": float(words)}
        hit = 0
        for i, rule in enumerate(rules, 1):
            if all((feature[c.feature] > c.at) == c.above for c in rule):
                hit = i
                break
        failed = words < 50 or 100 * repeat > 50 * words
        r = got[doc]
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == (words, chars, symbols, dup, repeat)
        assert (r.base_failed, r.rule, r.kept) == (failed, hit, not failed and not hit)


def test_grades_of_held_out_documents(spark):
    """The classifier learns outside the fold it is measured on."""
    got = q.op5_quality_classifier(spark, LARGE)
    held = base.table(spark, LARGE, "labels").where(langid.held_out(F.col("doc_id")))
    share = {(r.quality, r.toxic): (r.n, r.kept / r.n) for r in got.join(held, "doc_id").groupBy("quality", "toxic").agg(
        F.count("*").alias("n"), F.sum(F.col("kept").cast("int")).alias("kept")).collect()}
    assert share[(1, 0)][0] > 300 and share[(1, 0)][1] > 0.98
    assert share[(0, 0)][1] < 0.02


def test_language_of_held_out_documents(spark):
    docs = base.table(spark, MEDIUM, "documents")
    got = q.op10_language_id(spark, MEDIUM).where("held_out and lang_pred <> 'und'")
    right, n = got.join(docs.select("doc_id", "lang"), "doc_id").where("lang is not null").agg(
        F.avg((F.col("lang") == F.col("lang_pred")).cast("double")), F.count("*")).first()
    assert n > 150 and right > 0.98


@pytest.mark.parametrize("left_out", ["de", "es"])
def test_unlearned_language_is_rejected(spark, left_out):
    """Long texts of a language without a model go, those with one stay."""
    docs = base.table(spark, MEDIUM, "documents").where("lang is not null and length(text) > 400")
    model = langid.fit(docs.where(F.col("lang") != left_out))
    assert left_out not in model.langs
    found = langid.detect(docs, model).join(docs.select("doc_id", "lang"), "doc_id")
    share = {r.own: r.share for r in found.groupBy((F.col("lang") == left_out).alias("own")).agg(
        F.avg(F.col("rejected").cast("double")).alias("share")).collect()}
    assert share[True] > 0.95 and share[False] < 0.02
