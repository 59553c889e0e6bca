"""The extendible-hash index against grouping by text in Python, with and
without keys that collide."""

import hashlib
from collections import defaultdict

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from runlens.llm import exact_dedup as X
from runlens.llm import queries as q

SCHEMA = "doc_id long, text string"


def expected(data):
    groups = defaultdict(list)
    for doc, text in data:
        groups[text or ""].append(doc)
    out = []
    for text, ids in groups.items():
        keep = max((i for i in ids if i is not None), default=None)
        sha = hashlib.sha256(text.encode()).hexdigest()
        stays = False
        for i in ids:
            kept = i == keep and not stays
            stays = stays or kept
            out.append((i, keep, len(ids), kept, sha))
    return sorted(out, key=repr)


def got(df):
    return sorted((tuple(r[c] for c in ("doc_id", "keep_id", "group_size", "kept", "text_sha256")) for r in df.collect()), key=repr)


CASES = [
    [],
    [(1, None), (2, ""), (3, " "), (3, " "), (None, "x"), (None, "x"), (5, "x")],
    [(None, None), (None, "")],
    [(i, "copy" if i % 3 == 0 else f"text {i}") for i in range(400)],
    [(i, "x" * 200_000 + str(i % 2)) for i in range(4)],
]


@pytest.mark.parametrize("data", CASES)
def test_equal_texts(spark, data):
    df = spark.createDataFrame(data, SCHEMA)
    assert got(X.matched(df)) == expected(data)


@pytest.mark.parametrize("key", [
    lambda t: F.lit(5).cast("long"),                                   # one key for all: one chain
    lambda t: F.pmod(F.xxhash64(t), F.lit(7)),                         # prefixes equal to the 61st bit
    lambda t: F.shiftleft(F.pmod(F.xxhash64(t), F.lit(64)), 58),       # first bits only
])
def test_colliding_keys_change_nothing(spark, key):
    data = [(i, f"t{i % 37}") for i in range(150)] + [(None, "t1"), (900, None), (901, "")]
    df = spark.createDataFrame(data, SCHEMA)
    assert got(X.matched(df, key=key, bucket_bytes=8)) == expected(data)


def test_extra_columns_with_clashing_names(spark):
    df = spark.createDataFrame([(1, "a", 9, 9, "k"), (2, "a", 9, 9, "k")], SCHEMA + ", row long, bucket int, key string")
    assert got(X.matched(df)) == expected([(1, "a"), (2, "a")])


@settings(max_examples=3, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.one_of(st.none(), st.integers(0, 6)), st.sampled_from([None, "", "a", "b", "ab", "ä"])), max_size=25))
def test_any_rows(spark, data):
    assert got(X.matched(spark.createDataFrame(data, SCHEMA))) == expected(data)


def test_directory_splits_overfull_buckets(spark):
    """Buckets cover the key range without overlap, in owner order, and only a
    bucket of one key may be overfull."""
    data = [(i, "%d" % i * (50 if i == 7 else 1)) for i in range(500)]
    docs = spark.createDataFrame(data, SCHEMA)
    index, rows = X.build(docs, bucket_bytes=60)
    directory = sorted(index.directory.collect(), key=lambda r: r["first"])
    assert sum(2.0 ** -r["depth"] for r in directory) <= 1.0
    assert sum(r["n_keys"] for r in directory) == 500
    assert all(r["bytes"] <= 60 or r["n_keys"] == 1 for r in directory)
    assert [r["owner"] for r in directory] == sorted(r["owner"] for r in directory)
    of = {r["bucket"]: r for r in directory}
    for e in index.entries.collect():
        b = of[e["bucket"]]
        assert ((e["key"] + (1 << 63)) >> (64 - b["depth"]) if b["depth"] else 0) == b["prefix"]


SF = "/root/testdata/sf0.001"


def test_query_by_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    assert got(q.op12_exact_dedup(spark, SF)) == expected([tuple(r) for r in docs.collect()])
