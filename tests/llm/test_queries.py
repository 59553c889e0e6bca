"""Registered queries against their SQL, and the pipeline against a
brute-force version of its stages, on the smallest shared tables."""

import os
import re
import sys
import zlib

import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))), "tools"))

import __spark_entry__ as E
import corpus_pipeline
from oracle_check import digest, duck
from pyspark.sql import functions as F
from runlens.llm import langid, queries
from test_duplicates import brute_classes, brute_cut
from test_packing_mixing import plain_mix

SF = "/root/testdata/sf0.001"


def test_every_operator_is_registered():
    names = set(E.queries())
    for n in range(1, 14):
        assert sum(x.startswith(f"op{n}_") for x in names) == 1
    assert "pipeline" in names and [x for x, _ in corpus_pipeline.STAGES] == [
        "language", "near_duplicates", "passages", "mixture", "sequences"]


@pytest.mark.parametrize("name", sorted(queries.ORACLE))
def test_query_matches_sql(spark, name):
    df = queries.QUERIES[name](spark, SF)
    got = [tuple(r) for r in df.collect()]
    cur = duck(SF).execute(queries.ORACLE[name])
    cols, want = [d[0] for d in cur.description], None
    want = cur.fetchall()
    assert sorted(df.columns) == sorted(cols)
    assert digest(df.columns, got)[0] == digest(cols, want)[0]


def test_language_on_held_out_documents(spark):
    out = queries.op10_language_id(spark, SF)
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "lang")
    rows = out.join(docs, "doc_id").collect()
    assert len(rows) == docs.count()
    for r in rows:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0)
    tested = [r for r in rows if r.held_out]
    assert sum(r.lang == r.lang_pred for r in tested) >= 0.95 * len(tested)


def test_pipeline_stage_by_stage(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns = docs.columns
    step = {}
    for name, stage in corpus_pipeline.STAGES:
        path = str(tmp_path / name)
        stage(spark, docs, SF).write.parquet(path)
        step[name] = (docs, docs := spark.read.parquet(path))
    text = lambda df: sorted((r.doc_id, r.text) for r in df.collect())

    before, after = step["language"]
    assert after.columns == columns
    found = langid.detect(before, langid.fit(before)).where(~F.col("rejected"))
    assert sorted(r.doc_id for r in after.collect()) == sorted(r.doc_id for r in found.collect())

    before, after = step["near_duplicates"]
    want = {i for i, c in brute_classes(text(before)).items() if i == c}
    assert after.columns == columns and text(after) == [x for x in text(before) if x[0] in want]

    before, after = step["passages"]
    was = dict(text(before))
    cut = [(i, kept if removed else was[i]) for i, _, removed, kept in brute_cut(text(before))]
    assert after.columns == columns and text(after) == sorted(cut)
    assert all(r.n_chars == len(r.text) for r in after.collect() if r.text != was[r.doc_id])

    before, after = step["mixture"]
    rows = [(r.doc_id, (r.k0, r.lang or "", r.source or ""), len(re.findall("[^\x20\x09-\x0D]+", r.text or "")))
            for r in before.withColumn("k0", F.expr(queries.DOMAIN)).collect()]
    chosen = plain_mix(rows, queries.MIX_WEIGHTS, (9, 10), 1, queries.MIX_SEED)
    assert after.columns == columns and set(chosen.values()) == {1}
    assert sorted(r.doc_id for r in after.collect()) == sorted(i for i, _ in chosen)

    before, after = step["sequences"]
    from tokenizers import Tokenizer

    whole = Tokenizer.from_file(queries.tokenizer_file())
    want = []
    for r in before.collect():
        ids = whole.encode(r.text or "", add_special_tokens=False).ids + [0]
        for k in range(0, len(ids), 2048):
            part = ids[k: k + 2048]
            want.append((r.doc_id, k // 2048, k, len(part), zlib.crc32(b"".join(i.to_bytes(4, "little") for i in part))))
    got = after.collect()
    assert sorted((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got) == sorted(want)
    seqs = {}
    for r in got:
        seqs.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for spans in seqs.values():
        spans.sort()
        assert spans[0][0] == 0 and sum(n for _, n in spans) <= 2048
        assert all(a + n == b for (a, n), (b, _) in zip(spans, spans[1:]))
    assert len(seqs) <= -(-sum(r.length for r in got) // 2048) * 1.02 + 1


def test_pipeline_run_ends_in_sequences(spark):
    out = E.queries()["pipeline"](spark, SF)
    assert {"doc_id", "piece", "sequence_id", "offset"} <= set(out.columns) and not out.isEmpty()
    assert corpus_pipeline.ORACLE_SQL is None and "pipeline" not in E.oracle_sql()
