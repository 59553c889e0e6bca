"""Licence scans: a trained classifier of paragraphs, confirmed by templates.

Paragraphs are lines with text. Their word pairs (lower case, without
punctuation at the ends of words) are the features of one sparse logistic
regression for each licence family, with the family's template paragraphs,
whole and in part, as its examples, and the other families' and a bounded
sample of the table's own paragraphs against it. A paragraph whose best
probability reaches the family's threshold gets that family, one that only
reaches the lower threshold of licence-like text is ``unknown``; both
thresholds are calibrated on examples not used for the weights. A prediction
is confirmed when enough of a template of its family is found in the
paragraph.

Notices wrapped over lines are a second unit: neighbouring lines of a block
(lines with words, up to one without) that together hold enough of a template
none of them holds alone. They are searched in windows of twice the template's
pairs, without overlap; windows of one family that share a
line are one notice. Its lines are scored as one paragraph; if its family is
sure, it gives one confirmed row, which stands for its lines, other than lines
confirmed for another family.

DataFrame functions only. Features are the pairs that hold an anchor word: a
few words, rare in the table, of which every template has several. A paragraph
without any anchor has the constant score of no licence, so texts and then
paragraphs are first searched for anchors as plain substrings, before words
are parted and before any shuffle; the result is the same as without that
step. Only paragraphs with features are joined with the weights and templates
(a few hundred constant rows).

Defined cases: null and empty texts have no paragraphs; a paragraph of one
word has no pair; equal probabilities go to the family first by name; rows
that repeat a document give its paragraphs once more (they are counted by
``copies``); an empty table gives an empty result. Other columns are not read.
"""

from __future__ import annotations

import json
import math
import zlib
from collections import defaultdict
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import base

UNKNOWN = "unknown"

# Usual notices of each family, one paragraph each.
TEMPLATES = {
    "Apache-2.0": [
        "Licensed under the Apache License, Version 2.0.",
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in "
        "compliance with the License.",
        "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
    ],
    "BSD-3-Clause": [
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided "
        "that the following conditions are met:",
        "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file.",
        "Released under the BSD 3-Clause License.",
    ],
    "CC-BY-4.0": [
        "This work is licensed under a Creative Commons Attribution 4.0 International License.",
        "Licensed under CC BY 4.0.",
    ],
    "CC-BY-NC-4.0": [
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
        "Licensed under CC BY-NC 4.0.",
    ],
    "GPL-3.0": [
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
        "Public License as published by the Free Software Foundation, either version 3 of the License, or (at your "
        "option) any later version.",
        "You should have received a copy of the GNU General Public License along with this program.",
    ],
    "MIT": [
        "Released under the MIT License.",
        "Licensed under the MIT License.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        "documentation files (the \"Software\"), to deal in the Software without restriction.",
    ],
}


def words_of(text: str) -> list[str]:
    out = []
    for w in text.lower().split():
        while w and not w[0].isalnum():
            w = w[1:]
        while w and not w[-1].isalnum():
            w = w[:-1]
        if w:
            out.append(w)
    return out


def pairs_of(text: str) -> list[str]:
    """Distinct word pairs, the paragraph's ends included."""
    words = ["^", *words_of(text), "$"]
    return sorted({f"{a} {b}" for a, b in zip(words, words[1:])} if len(words) > 2 else ())


def words_column(line: Column) -> Column:
    trimmed = F.transform(F.split(F.lower(line), r"[\s]+"), lambda w: F.regexp_replace(
        w, r"^[^\p{L}\p{N}]+|[^\p{L}\p{N}]+$", ""))
    return F.filter(trimmed, lambda w: w != "")


def pairs_column(line: Column) -> Column:
    """The same as an expression."""
    return pairs_between(words_column(line))


def pairs_between(words: Column) -> Column:
    framed = F.concat(F.array(F.lit("^")), words, F.array(F.lit("$")))
    both = F.zip_with(framed, F.slice(framed, F.lit(2), F.size(framed)),
                      lambda a, b: F.when(b.isNotNull(), F.concat(a, F.lit(" "), b)))
    return F.array_distinct(F.filter(both, lambda p: p.isNotNull()))


@dataclass
class Model:
    families: list[str]
    bias: dict[str, float]
    weight: dict[str, dict[str, float]]      # pair: family: weight
    sure: dict[str, float]                   # per family
    likely: float
    templates: dict[str, list[list[str]]]
    anchors: list[str]


def sigmoid(x: float) -> float:
    return 1 / (1 + math.exp(-max(-40.0, min(40.0, x))))


def examples() -> list[tuple[str, str]]:
    """(family, paragraph): templates whole, in part and with words before or
    after them."""
    out = []
    for family, texts in sorted(TEMPLATES.items()):
        for text in texts:
            words = text.split()
            out += [(family, text)] * 3
            out += [(family, f"{lead} {text}") for lead in ("Note:", "This software is", "Copyright 2020 the authors.")]
            out += [(family, f"{text} {tail}") for tail in ("All rights reserved.", "See the file for details.")]
            if len(words) > 8:
                out += [(family, " ".join(words[: len(words) * 3 // 4])), (family, " ".join(words[len(words) // 4:]))]
    return out


def train(sample: list[str], rounds: int = 60, rate: float = 0.3, shrink: float = 2e-4, cut: float = 0.05) -> Model:
    """One regression for each family by stochastic gradient steps with
    soft-thresholding, plain and in a fixed order; ``sample``: paragraphs of
    the table itself, as texts without a licence."""
    families = sorted(TEMPLATES)
    anchors = anchor_words(sample)
    rows = [(f, [p for p in pairs_of(t) if not set(p.split(" ")).isdisjoint(anchors)]) for f, t in examples()]
    vocab = {p for _, ps in rows for p in ps}
    seen = defaultdict(int)
    for text in sample:
        hits = tuple(p for p in pairs_of(text) if p in vocab)
        if not any(w.startswith(("licen", "copyright")) for w in words_of(text)):
            seen[hits] += 1
    rows += [("", list(h)) for h, _ in sorted(seen.items())]
    # a quarter is kept for the thresholds
    part = [zlib.crc32(f"{i}|{f}".encode()) % 4 != 0 for i, (f, _) in enumerate(rows)]
    weight = {f: defaultdict(float) for f in families}
    bias = dict.fromkeys(families, -2.0)
    for turn in range(rounds):
        step = rate / (1 + turn / 20)
        for (own, ps), use in zip(rows, part):
            if not use:
                continue
            scale = 1 / math.sqrt(max(1, len(ps)))
            for f in families:
                w = weight[f]
                z = bias[f] + scale * sum(w[p] for p in ps if p in w)
                g = sigmoid(z) - (f == own)
                if abs(g) < 1e-3:
                    continue
                bias[f] -= 0.1 * step * g
                for p in ps:
                    x = w[p] - step * g * scale
                    w[p] = math.copysign(max(0.0, abs(x) - shrink * step), x)
    kept: dict[str, dict[str, float]] = {}
    for f in families:
        for p, x in weight[f].items():
            if abs(x) >= cut:
                kept.setdefault(p, {})[f] = x
    model = Model(families, bias, kept, {}, 0.5, templates(), anchors)
    scores = [(own, max((score(model, ps, f), f) for f in families)) for (own, ps), use in zip(rows, part) if not use]
    none = max([s for own, (s, _) in scores if not own], default=0.0)
    for f in families:
        wrong = max([s for own, (s, g) in scores if own != f and g == f], default=0.0)
        right = sorted(s for own, (s, g) in scores if own == f and g == f)
        low = right[0] if right else 1.0
        model.sure[f] = min(0.9, max(0.5, (max(wrong, none) + low) / 2))
    model.likely = min(0.45, max(0.2, none + 0.05, *(sigmoid(b) + 0.01 for b in bias.values())))
    return model


def anchor_words(sample: list[str], each: int = 3) -> list[str]:
    """Words such that every template holds ``each`` of them (or all of its
    own, if fewer): by turns the word that serves the most templates for its
    share of the sample's paragraphs."""
    texts = [set(words_of(t)) for ts in TEMPLATES.values() for t in ts]
    low = [t.lower() for t in sample]
    words = sorted({w for t in texts for w in t if len(w) > 1})
    cost = {w: 0.01 + sum(w in t for t in low) / max(1, len(low)) for w in words}
    need = [min(each, sum(w in cost for w in t)) for t in texts]
    out: list[str] = []
    while any(need):
        best = max((w for w in words if w not in out),
                   key=lambda w: sum(n > 0 and w in t for t, n in zip(texts, need)) / cost[w])
        out.append(best)
        need = [n - (n > 0 and best in t) for t, n in zip(texts, need)]
    return sorted(out)


def score(model: Model, pairs: list[str], family: str) -> float:
    own = [p for p in pairs if p in model.weight]
    scale = 1 / math.sqrt(max(1, len(own)))
    return sigmoid(model.bias[family] + scale * sum(model.weight[p].get(family, 0.0) for p in own))


def small_table(spark: SparkSession, rows: list[tuple], schema: str) -> DataFrame:
    """A few constant rows, as one literal."""
    names = [part.split(" ")[0] for part in schema.split(", ")]
    text = json.dumps([dict(zip(names, r)) for r in rows])
    return (spark.range(1).select(F.explode(F.from_json(F.lit(text), f"array<struct<{schema.replace(' ', ':')}>>"
                                                        .replace(",:", ","))).alias("r")).select("r.*"))


def paragraphs(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    lines = F.split(F.coalesce(F.col(text_col), F.lit("")), "\n")
    return docs.select(F.col(id_col).alias("doc_id"), F.posexplode(lines).alias("paragraph", "line"))


def fit(docs: DataFrame, sample: int = 3000, text_col: str = "text", id_col: str = "doc_id",
        enough: float = 0.6, line_chars: int = 2000) -> Model:
    """Weights from the templates and the paragraphs of at most ``sample / 10``
    documents (at most ``sample`` whole paragraphs, none longer than
    ``line_chars``), the first by a hash of their id. Sampled lines with a word
    that begins with licen or copyright are no negatives: they may be notices."""
    few = (docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
           .withColumn("order", F.xxhash64("doc_id", F.lit(11))))
    ids = few.select("order").orderBy("order").limit(max(1, sample // 10)).agg(F.max("order").alias("last"))
    last = ids.first()["last"]
    if last is None:
        return train([])
    few = base.texts_of(few.where(F.col("order") <= last))
    rows = (paragraphs(few, "doc_id", "text").where(F.length("line") <= line_chars)
            .orderBy(F.xxhash64("line"), "line").limit(sample).collect())
    # lines of wrapped notices are no texts without a licence
    anchors = anchor_words([r["line"] for r in rows])
    land = base.Landing(base.session_of(docs), "licenses-fit")
    found = wrapped(few.where(anchored(F.col("text"), anchors)), templates(), anchors, enough, land)
    own = {(r["doc_id"], r["first"] + i) for r in found.select("doc_id", "first", "l1", "l2").collect()
           for i in range(r["l1"], r["l2"] + 1)}
    land.drop(*land.paths)
    return train([r["line"] for r in rows if (r["doc_id"], r["paragraph"]) not in own])


def templates() -> dict[str, list[list[str]]]:
    return {f: [pairs_of(t) for t in ts] for f, ts in sorted(TEMPLATES.items())}


def anchored(text: Column, anchors: list[str]) -> Column:
    def any_of(t: Column) -> Column:
        out = F.lit(False)
        for a in anchors:
            out = out | t.contains(a)
        return out

    return F.exists(F.array(F.lower(text)), any_of)      # lower case once a text


# A word goes on in the next line after a hyphen.
HYPHEN = r"([\p{L}\p{N}]-)\n([^\p{L}\p{N}\n]*)(\S+)"


def blocks(docs: DataFrame, anchors: list[str]) -> DataFrame:
    """Blocks of several lines with words, up to one without, that hold an
    anchor: ``doc_id``, ``first`` (line number), ``block``. A text's lines are
    parted once and each is copied into one block at most."""
    lines = once(docs, "lines", F.split("text", "\n")).drop("text")
    empty = F.array_compact(F.transform("lines", lambda x, i: F.when(~x.rlike(r"[\p{L}\p{N}]"), i)))
    bounds = once(lines, "bounds", F.concat(F.array(F.lit(-1)), empty, F.array(F.size("lines"))))
    runs = F.zip_with("bounds", F.slice("bounds", F.lit(2), F.size("bounds")),
                      lambda a, b: F.struct((a + 1).alias("first"), (b - a - 1).alias("n")))
    several = F.transform(F.filter(runs, lambda r: r["n"] > 1), lambda r: F.struct(
        r["first"].alias("first"), F.array_join(F.slice("lines", r["first"] + 1, r["n"]), "\n").alias("block")))
    found = bounds.select("doc_id", F.explode(several).alias("b")).select("doc_id", "b.first", "b.block")
    return found.where(anchored(F.col("block"), anchors))


def rejoined(block: Column) -> Column:
    """Words parted after a hyphen as a whole in their first line."""
    return F.regexp_replace(block, HYPHEN, "$1$3\n$2")


def once(df: DataFrame, name: str, value: Column) -> DataFrame:
    """With a column that is computed once a row, however often it is used."""
    return df.select("*", F.explode(F.array(value)).alias(name))


def with_hits(df: DataFrame, enough: float) -> DataFrame:
    """With ``hits``: the pairs of template ``t`` in a block's ``words`` by
    line, in order. A line that alone holds enough of the template counts as a
    gap that no window reaches over, unless the template goes on from or to a
    neighbouring line."""
    t, lines = F.col("t"), F.col("words")

    def joined(a: Column, b: Column) -> Column:
        return F.coalesce(F.array_contains(t["inner"], F.concat(
            F.try_element_at(a, F.lit(-1)), F.lit(" "), F.try_element_at(b, F.lit(1)))), F.lit(False))

    def words(x: Column, i: Column) -> Column:
        line = x["line"]
        alone = F.size(F.array_intersect(t["pairs"], pairs_between(line))) >= enough * t["size"]
        gap = alone & ~joined(x["before"], line) & ~joined(line, x["after"])
        own = F.when(gap, F.array_repeat(F.lit(""), 2 * t["size"])).otherwise(line)
        return F.transform(own, lambda w, j: F.struct(w.alias("w"), i.alias("line"), (j == 0).alias("head")))

    none = F.array(F.array().cast("array<string>"))
    near = F.zip_with(lines, F.concat(F.slice(lines, F.lit(2), F.size(lines)), none),
                      lambda a, b: F.struct(a.alias("line"), b.alias("after")))
    near = F.zip_with(near, F.slice(F.concat(none, lines), F.lit(1), F.size(lines)), lambda x, a: F.struct(
        a.alias("before"), x["line"].alias("line"), x["after"].alias("after")))
    end = F.array(F.struct(F.lit("").alias("w"), F.lit(-1).alias("line"), F.lit(True).alias("head")))
    df = once(df, "placed", F.concat(F.flatten(F.transform(near, words)), end))

    def pair(a: Column, b: Column) -> Column:
        return F.when(b.isNotNull(), F.struct(
            F.concat(a["w"], F.lit(" "), b["w"]).alias("pair"), a["line"].alias("l1"), b["line"].alias("l2"),
            (a["head"] & F.array_contains(t["pairs"], F.concat(F.lit("^ "), a["w"]))).cast("int").alias("head"),
            a["w"].alias("w")))

    placed, both = F.col("placed"), F.col("both")
    df = once(df, "both", F.zip_with(placed, F.slice(placed, F.lit(2), F.size(placed)), pair))
    # the pair after a pair tells whether the line ends there
    then = F.zip_with(both, F.slice(both, F.lit(2), F.size(both)), lambda x, y: F.struct(
        x["pair"].alias("pair"), x["l1"].alias("l1"), x["l2"].alias("l2"), x["head"].alias("head"),
        F.coalesce(((y["l2"] != x["l2"]) & F.array_contains(t["pairs"], F.concat(y["w"], F.lit(" $")))).cast("int"),
                   F.lit(0)).alias("tail")))
    at = F.transform(then, lambda x, p: F.struct(p.alias("pos"), x["pair"].alias("pair"), x["l1"].alias("l1"),
                                                 x["l2"].alias("l2"), x["head"].alias("head"), x["tail"].alias("tail")))
    return once(df, "hits", F.filter(at, lambda h: F.array_contains(t["inner"], h["pair"]))).drop("placed", "both")


def windows_column(hits: Column, size: Column, enough: float) -> Column:
    """Windows with enough of the template, none overlapping; of two that
    overlap the one with more of it, then the shorter."""
    span = 2 * size

    def window(h: Column, i: Column) -> Column:
        near = F.filter(F.slice(hits, i + 1, span), lambda g: g["pos"] < h["pos"] + span)

        def add(s: Column, g: Column) -> Column:          # up to the last pair not seen before
            new = ~F.array_contains(s["seen"], g["pair"])
            return F.struct(F.when(new, F.concat(s["seen"], F.array(g["pair"]))).otherwise(s["seen"]).alias("seen"),
                            *[F.when(new, g[c]).otherwise(s[c]).alias(c) for c in ("pos", "l2", "tail")])

        zero = F.struct(F.array().cast("array<string>").alias("seen"), *[F.lit(0).alias(c) for c in ("pos", "l2", "tail")])
        return F.aggregate(near, zero, add, lambda s: F.struct(
            (-(F.size(s["seen"]) + h["head"] + s["tail"])).alias("minus"), (s["pos"] - h["pos"]).alias("length"),
            h["pos"].alias("start"), s["pos"].alias("stop"), h["l1"].alias("l1"), s["l2"].alias("l2")))

    kind = "struct<minus:int,length:int,start:int,stop:int,l1:int,l2:int>"
    found = F.array_sort(F.transform(F.filter(F.transform(hits, window), lambda w: -w["minus"] >= enough * size), lambda w: F.struct(
        w["start"].alias("start"), w["stop"].alias("stop"), F.struct(w["minus"], w["length"]).alias("worth"), w.alias("w"))))

    # from left to right: a window beats the last one if it overlaps it and is worth more
    def step(state: Column, x: Column) -> Column:
        now = state["now"]
        apart = now.isNull() | (x["start"] > now["stop"])
        better = x["worth"] < F.struct(now["minus"], now["length"])
        return F.struct(F.when(apart & now.isNotNull(), F.concat(state["kept"], F.array(now))).otherwise(state["kept"]).alias("kept"),
                        F.when(apart | better, x["w"].cast(kind)).otherwise(now).alias("now"))

    start = F.struct(F.array().cast(f"array<{kind}>").alias("kept"), F.lit(None).cast(kind).alias("now"))
    return F.aggregate(found, start, step, lambda s: F.when(s["now"].isNull(), s["kept"]).otherwise(F.concat(s["kept"], F.array(s["now"]))))


def wrapped(docs: DataFrame, known: dict[str, list[list[str]]], anchors: list[str], enough: float,
            land: base.Landing) -> DataFrame:
    """Lines that together hold enough of a template: ``doc_id``, ``first``,
    ``block``, ``located`` (family), ``l1`` and ``l2`` (within the block),
    ``located_share``, ``copies``."""
    shapes = [(f, ps, [p for p in ps if not p.startswith("^ ") and not p.endswith(" $")])
              for f in sorted(known) for ps in known[f]]
    constants = F.array(*[F.struct(F.lit(i).alias("template"), F.lit(f).alias("family"), F.lit(len(ps)).alias("size"),
                                   F.lit(ps).alias("pairs"), F.lit(inner).alias("inner"))
                          for i, (f, ps, inner) in enumerate(shapes)])
    every = F.lit(sorted({p for _, _, inner in shapes for p in inner}))

    def likely(t: Column, held: Column) -> Column:      # a window's ends can add two pairs
        return F.size(F.array_intersect(t["inner"], held)) >= F.greatest(F.lit(1.0), enough * t["size"] - 2)

    some = once(blocks(docs, anchors), "words", F.transform(F.split(rejoined(F.col("block")), "\n"), words_column))
    some = once(some, "held", F.array_intersect(pairs_between(F.flatten("words")), every))
    some = some.select("doc_id", "first", "block", "words",
                       F.explode(F.filter(constants, lambda t: likely(t, F.col("held")))).alias("t"))
    t = F.col("t")
    some = with_hits(some, enough).select("doc_id", "first", "block", t["family"].alias("located"),
                                          t["template"].alias("template"), t["size"].alias("size"), "hits", "t")
    some = land.put(some.where(likely(t, F.transform("hits", lambda h: h["pair"]))).drop("t"), "blocks")
    kept = F.filter(windows_column(F.col("hits"), F.col("size"), enough), lambda w: w["l2"] > w["l1"])
    each = (some.withColumn("w", kept).where(F.size("w") > 0)
            .groupBy("doc_id", "first", "block", "located", "template", "size", "w").agg(F.count("*").alias("copies"))
            .select("doc_id", "first", "block", "located", "size", "copies", F.explode("w").alias("w"))
            .select("doc_id", "first", "block", "located", "copies", "w.l1", "w.l2",
                    F.round(-F.col("w.minus") / F.col("size"), 9).alias("located_share")))
    by = Window.partitionBy("doc_id", "first", "block", "located").orderBy("l1", "l2")
    before = F.max("l2").over(by.rowsBetween(Window.unboundedPreceding, -1))
    return (each.withColumn("new", F.coalesce((F.col("l1") > before).cast("int"), F.lit(0)))
            .withColumn("island", F.sum("new").over(by))
            .groupBy("doc_id", "first", "block", "located", "island")
            .agg(F.min("l1").alias("l1"), F.max("l2").alias("l2"), F.max("located_share").alias("located_share"),
                 F.max("copies").alias("copies")).drop("island"))


def scanned(docs: DataFrame, model: Model, enough: float = 0.6, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row a licence paragraph: ``doc_id``, ``paragraph`` (number of its
    first line, from 0), ``lines`` (more than one for a wrapped notice),
    ``family`` (or unknown), ``probability``, ``template_share``,
    ``confirmed``, ``copies``."""
    spark = base.session_of(docs)
    land = base.Landing(spark, "licenses")
    vocab = sorted(model.weight)
    weights = [(p, f, float(x)) for p in vocab for f, x in sorted(model.weight[p].items())]
    in_templates = [(f"{f}#{i}", f, p, len(ps)) for f in model.families
                    for i, ps in enumerate(model.templates[f]) for p in ps]
    biases = [(f, float(model.bias[f]), float(model.sure[f])) for f in model.families]

    docs = base.texts_of(docs, id_col, text_col).where(anchored(F.col("text"), model.anchors))
    lines = paragraphs(docs, "doc_id", "text").where(anchored(F.col("line"), model.anchors))
    hits = lines.select("doc_id", "paragraph", pairs_column(F.col("line")).alias("pairs"))
    scored = F.size(F.filter("pairs", lambda p: p.isin(vocab)))
    hits = hits.withColumn("n", scored).where("n > 0")
    one = (hits.groupBy("doc_id", "paragraph", "pairs", "n").agg(F.count("*").alias("copies"))
           .select("doc_id", "paragraph", F.lit(1).alias("lines"), F.lit(None).cast("string").alias("located"),
                   F.lit(None).cast("double").alias("located_share"), F.lit(None).cast("long").alias("whole"),
                   "pairs", "n", "copies", F.xxhash64("doc_id", "paragraph", "pairs").alias("id"),
                   F.array().cast("array<bigint>").alias("own")))

    def text(block: Column) -> Column:
        return F.slice(F.split(block, "\n"), F.col("l1") + 1, F.col("l2") - F.col("l1") + 1)

    own = F.transform(text(F.col("block")), lambda line, i: F.xxhash64("doc_id", (F.col("first") + F.col("l1") + i).cast("int"),
                                                       pairs_column(line)))
    whole = (wrapped(docs, model.templates, model.anchors, enough, land)
             .select("doc_id", (F.col("first") + F.col("l1")).cast("int").alias("paragraph"),
                     (F.col("l2") - F.col("l1") + 1).alias("lines"), "located", "located_share",
                     F.xxhash64("first", "block").alias("whole"), pairs_column(F.array_join(text(rejoined(F.col("block"))), " ")).alias("pairs"),
                     "copies", own.alias("own"))
             .withColumn("n", scored).where("n > 0")
             .withColumn("id", F.xxhash64("doc_id", "paragraph", "lines", "located", "whole")))
    one = land.put(one.unionByName(whole), "hits")
    each = one.select("id", "n", F.explode("pairs").alias("pair"))

    # the constant tables are the model's: a few hundred rows
    sums = (each.join(F.broadcast(small_table(spark, weights, "pair string, family string, weight double")), "pair")
            .groupBy("id", "family").agg(F.round(F.sum("weight") / F.sqrt(F.max("n")), 9).alias("z")))
    prob = (sums.join(F.broadcast(small_table(spark, biases, "family string, bias double, sure double")), "family")
            .select("id", "family", "sure", F.round(1 / (1 + F.exp(-(F.col("z") + F.col("bias")))), 9).alias("p")))
    best = (prob.groupBy("id").agg(F.min(F.struct((-F.col("p")).alias("minus"), "family", "p", "sure")).alias("b"))
            .select("id", "b.family", "b.p", "b.sure"))
    found = best.where(F.col("p") >= model.likely)
    common = (each.join(F.broadcast(small_table(spark, in_templates, "template string, family string, pair string, size int")), "pair")
              .groupBy("id", "family", "template", "size").agg(F.count("*").alias("shared"))
              .groupBy("id", "family").agg(F.max(F.col("shared") / F.col("size")).alias("template_share")))
    out = one.drop("pairs", "n").join(found, "id").join(common, ["id", "family"], "left")
    share = F.coalesce(F.col("located_share"), F.col("template_share"), F.lit(0.0))
    sure = F.col("p") >= F.col("sure")
    out = land.put(out.select(
        "id", "doc_id", F.col("paragraph").cast("int").alias("paragraph"), "lines", "located", "whole", "own",
        F.when(sure, F.col("family")).otherwise(UNKNOWN).alias("family"), F.col("p").alias("probability"),
        F.round(share, 9).alias("template_share"), (sure & (share >= enough)).alias("confirmed"), "copies"), "scored")

    single = out.where("located is null")
    notices = out.where("confirmed and family = located")
    within = notices.select("whole", F.col("family").alias("of"), F.col("copies").alias("held"), F.explode("own").alias("id"))
    within = (within.join(single.select("id", "family", "confirmed"), "id").where(~F.col("confirmed") | (F.col("family") == F.col("of")))
              .groupBy("id", "whole").agg(F.max("held").alias("held")).groupBy("id").agg(F.sum("held").alias("held")))
    alone = (single.join(within, "id", "left").withColumn("copies", F.col("copies") - F.coalesce("held", F.lit(0)))
             .where("copies > 0"))
    names = ["doc_id", "paragraph", "lines", "family", "probability", "template_share", "confirmed", "copies"]
    return alone.select(names).unionByName(notices.select(names))
