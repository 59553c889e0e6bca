"""From raw documents to packed training sequences, in five stages.

Each stage takes the documents that its predecessor kept, as a table that was
written and read again. All but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from runlens.llm import base, langid, mixing, near_dup, packing, substring
from runlens.llm.queries import MIX_PATH, MIX_SEED, MIX_WEIGHTS, tokenizer_file


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a known language; texts without a letter, or unlike every
    language learned, go."""
    return langid.keep_known(docs, langid.fit(docs))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near copies."""
    return near_dup.keep_one(docs)


def passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the passages of 13 words and more that an earlier
    document holds."""
    return substring.cut_texts(docs)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Nine tenths of all tokens, by domain, language and source, each
    document at most once."""
    return mixing.mixed(docs, [F.expr(p) for p in MIX_PATH], MIX_WEIGHTS, share=(9, 10), epochs=1, seed=MIX_SEED)


def sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The place of every piece in sequences of 2048 tokens."""
    cut, places = packing.packed(docs, tokenizer_file())
    digest = cut.select("row", "piece", "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"))
    return (digest.join(places, ["row", "piece"])
            .select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"))


STAGES = [
    ("language", language),
    ("near_duplicates", near_duplicates),
    ("passages", passages),
    ("mixture", mixture),
    ("sequences", sequences),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = base.table(spark, sf_dir, "documents")
    land = base.Landing(spark, "pipeline")
    for name, stage in STAGES:
        docs = land.put(stage(spark, docs, sf_dir), name)
    return docs


#: Language models, verified similarity and tokenizers are beyond SQL; the
#: pipeline is tested against a brute-force version instead.
ORACLE_SQL = None
