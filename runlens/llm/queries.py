"""The registered queries of this package, and SQL for those it can express.

Each query applies its operator to its whole table with production
parameters."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import align, base, chat, exact_dedup, langid, licenses, mixing, near_dup, packing, quality_ordinal, quality_rules, substring, topk, zfast


def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document, learned from the rows outside the test fold."""
    docs = base.table(spark, sf_dir, "documents")
    found = langid.detect(docs, langid.fit(docs))
    return found.select("doc_id", langid.held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score",
                        "cross_entropy", "rejected")


CONTROL_TEXT = "</s>[INST] ok [/INST]"


def op1_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every conversation formatted, and one of control strings only; turns
    and loss text are read back from the formatted text."""
    rows = base.table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    control = spark.range(2).select(
        F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(CONTROL_TEXT).alias("text"))
    out = chat.formatted(rows.unionByName(control))
    back = out.select("conv_id", chat.read_back(F.col("formatted")).alias("turns"),
                      chat.under_loss(F.col("formatted"), F.col("loss")).alias("loss_text"),
                      F.length("formatted").cast("long").alias("formatted_chars"))
    said = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return back.select("conv_id", F.size("turns").cast("long").alias("n_turns"),
                       F.sha2(said.cast("binary"), 256).alias("turns_sha256"),
                       F.length("loss_text").cast("long").alias("loss_chars"),
                       F.sha2(F.col("loss_text").cast("binary"), 256).alias("loss_sha256"), "formatted_chars")


def op4_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five best of all vectors for every fiftieth, by inner product."""
    return topk.search(base.table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Statistics of every document, the base rules' and the learned verdict."""
    out, _ = quality_rules.judged(base.table(spark, sf_dir, "documents"), base.table(spark, sf_dir, "labels"))
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
                      "kept", "rule")


def op5_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Expected grade of every document, learned from graded ones outside the
    test fold."""
    docs, labels = base.table(spark, sf_dir, "documents"), base.table(spark, sf_dir, "labels")
    grades = labels.where(~langid.held_out(F.col("doc_id"))).select(
        "doc_id", quality_ordinal.grade_of(F.col("quality"), F.col("toxic")).alias("grade"))
    return quality_ordinal.graded(docs, quality_ordinal.fit(docs, grades))


def op6_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is left of every document without the passages of earlier ones."""
    left = substring.deduplicated(base.table(spark, sf_dir, "documents"))
    return left.select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))


def op7_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licence paragraphs of all documents."""
    docs = base.table(spark, sf_dir, "documents")
    return licenses.scanned(docs, licenses.fit(docs))


# The tree of the mixture: domain (from the source's number), language, source.
DOMAIN = "case when source = 'src0' then 'crawl' when length(source) = 4 then 'curated' else 'forum' end"
MIX_WEIGHTS = [{"crawl": 3, "curated": 4, "forum": 3}, {"en": 5, "de": 2, "fr": 2, "es": 1}, {"src1": 2, "src10": 2}]
MIX_PATH = [DOMAIN, "lang", "source"]
MIX_SEED = 7


def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents chosen for a budget of nine tenths of all tokens, up to two
    epochs a source."""
    docs = base.table(spark, sf_dir, "documents")
    sized = docs.select("doc_id", *[F.coalesce(F.expr(p), F.lit("")).alias(f"k{i}") for i, p in enumerate(MIX_PATH)],
                        mixing.word_count(F.col("text")).alias("tokens"))
    return mixing.mixed(sized, [F.col(f"k{i}") for i in range(3)], MIX_WEIGHTS, share=(9, 10), epochs=2,
                        seed=MIX_SEED, tokens=F.col("tokens"), with_epoch="epoch")


def tokenizer_file(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op2_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The place of every piece of every document in sequences of 2048 tokens."""
    cut, places = packing.packed(base.table(spark, sf_dir, "documents"), tokenizer_file())
    digest = cut.select("row", "piece", "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"))
    return (digest.join(places, ["row", "piece"])
            .select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"))


def op9_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The class of near copies of every document, and whether it stays."""
    found = near_dup.classes(base.table(spark, sf_dir, "documents"))
    return found.withColumn("kept", F.col("doc_id") == F.col("class_id"))


def op11_cross_tokenizer_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How two tokenizers' tokens of every document line up."""
    docs = base.table(spark, sf_dir, "documents")
    return align.scored(docs, tokenizer_file("byte_bpe_50k.json"), tokenizer_file("piece_bpe_32k.model"))


def op12_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The document that stays of every group of equal texts."""
    return exact_dedup.matched(base.table(spark, sf_dir, "documents"))


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All nodes of the prefix trie of the rebuilt conversations."""
    turns = zfast.ordered(base.table(spark, sf_dir, "conversations"))
    turns = base.Landing(spark, "prefix-trie").put(turns, "turns")
    return zfast.trie(zfast.rebuilt(turns))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages of ``corpus_pipeline.py``, one after the other."""
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


QUERIES = {
    "pipeline": pipeline,
    "op1_chat_formatting": op1_chat_formatting,
    "op3_quality_rules": op3_quality_rules,
    "op4_top_k": op4_top_k,
    "op5_quality_classifier": op5_quality_classifier,
    "op2_best_fit_packing": op2_best_fit_packing,
    "op7_license_scan": op7_license_scan,
    "op8_mixing": op8_mixing,
    "op6_substring_dedup": op6_substring_dedup,
    "op9_near_duplicates": op9_near_duplicates,
    "op10_language_id": op10_language_id,
    "op11_cross_tokenizer_alignment": op11_cross_tokenizer_alignment,
    "op12_exact_dedup": op12_exact_dedup,
    "op13_prefix_trie": op13_prefix_trie,
}

CHAT_SQL = r"""
with rows_ as (
  select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
  union all values (-7, 0, 'user', '</s>[INST] ok [/INST]'), (-7, 1, 'assistant', '</s>[INST] ok [/INST]')),
marked as (
  select *, length(regexp_replace(regexp_replace(replace(text, '\', '\\'), '<(/?s>|/?SYS>>|\|)', '\\l\1', 'g'),
      '\[(/?INST\])', '\\b\1', 'g')) as n,
    coalesce(role = lag(role) over w, false) as merged
  from rows_ window w as (partition by conv_id order by turn, role, text))
select conv_id, count(*) as n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' order by turn, role, text)) as turns_sha256,
  cast(coalesce(sum(length(text)) filter (role = 'assistant'), 0) as bigint) as loss_chars,
  sha256(coalesce(string_agg(text, '' order by turn, role, text) filter (role = 'assistant'), '')) as loss_sha256,
  cast(sum(n + case when merged then length('<|im_sep|>')
    else length('<|im_start|>') + length(role) + 1 + length('<|im_end|>') + 1 end) as bigint) as formatted_chars
from marked group by conv_id
"""

TOP_K_SQL = """
with v as (
  select vec_id, list_transform(embedding, lambda x: cast(floor(256 * cast(x as double)) as bigint)) as v from embeddings
  where embedding is not null and not list_contains(list_transform(embedding, lambda x: coalesce(isfinite(x), false)), false)),
s as (
  select q.vec_id as query_id, c.vec_id, cast(list_sum(list_transform(list_zip(q.v, c.v), lambda p: p[1] * p[2])) as bigint) as score
  from v q join v c on q.vec_id % 50 = 0 and c.vec_id <> q.vec_id)
select query_id, cast(row_number() over (partition by query_id order by score desc, vec_id) as int) as rank, vec_id, score
from s qualify rank <= 5
"""

ORACLE: dict[str, str] = {
    "op1_chat_formatting": CHAT_SQL,
    "op4_top_k": TOP_K_SQL,
    "op12_exact_dedup": exact_dedup.SQL,
    "op13_prefix_trie": zfast.SQL,
    "op8_mixing": mixing.sql(MIX_WEIGHTS, (9, 10), 2, MIX_SEED, MIX_PATH),
}
