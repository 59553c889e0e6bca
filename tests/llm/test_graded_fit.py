"""The ordinal classifier learns from every graded text, by sums over Spark."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from runlens.llm import quality_ordinal as QO
from test_texts import make


def test_all_graded_texts_are_learned_from(spark):
    """A word of the 40 texts that come last by the hash of their id, after
    6,000 others, is learned."""
    n = 6_400
    last = {r.id for r in spark.range(n).orderBy(F.xxhash64("id", F.lit(5)).desc()).limit(300).collect()}
    texts = ["river stone light" + (" late" if i in last else " field" if i % 2 else " awful") for i in range(n)]
    grades = spark.createDataFrame([(i, 0 if i in last else i % 2) for i in range(n)], "doc_id long, grade int")
    docs = make(spark, texts)
    got = QO.graded(docs, QO.fit(docs, grades)).groupBy(F.col("doc_id").isin(list(last)).alias("late")).agg(
        F.max("expected_grade").alias("most")).where("late").first()
    assert got.most < 0.3


def test_sums_over_spark_are_those_of_arrays(spark):
    texts = [" ".join(["tree", "house", "cloud"][i % 3:] + ["awful"] * (i % 2) + ["x%"] * (i % 5)) for i in range(90)]
    rows = make(spark, texts).withColumns({"grade": F.col("doc_id").cast("int") % 3, "rest": F.lit(False)})
    features = QO.features_of(rows.repartition(3))
    buf = "".join(texts).encode()
    offsets = np.concatenate([[0], np.cumsum([len(t) for t in texts])])
    doc, feat, value = QO.text_features(np.frombuffer(buf, np.uint8), offsets)
    used = QO.frequent(features)
    df = np.bincount(feat, minlength=1 << QO.BITS)
    assert sorted(used.tolist()) == np.flatnonzero(df >= 8).tolist() and len(used) < (df > 0).sum()
    blocks, summed = QO.summed_over(features, used)
    grade = np.arange(90) % 3
    one = QO.descend(summed, used, np.bincount(grade), rounds=5)
    two = QO.train(doc, feat, value.astype("f4").astype(float), grade, rounds=5)
    blocks.unpersist()
    assert np.allclose(one.weights, two.weights, atol=1e-6) and np.allclose(one.cuts, two.cuts, atol=1e-9)


@pytest.mark.parametrize("values", [[], [0.5], [0.25] * 9, [0.1, 0.7], [i * i % 97 / 97 for i in range(400)], [0.0] * 50 + [1.0] * 3])
@pytest.mark.parametrize("share", [0.0, 0.004, 0.5, 1.0])
def test_quantile(spark, values, share):
    got = QO.quantile(spark.createDataFrame([(v,) for v in values], "x double"), share)
    assert got is None if not values else got == pytest.approx(np.quantile(values, share), abs=1e-12)
