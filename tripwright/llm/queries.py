"""One query per operator, over its whole table with production parameters."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripwright.llm import (
    compact_windows,
    dice_licenses,
    entropy_secrets,
    min_slack,
    mtree_topk,
    pfair_mix,
    prefix_bitmaps,
    set_relations,
    site_bayes,
    suffix_tree,
    token_records,
    trie_frontier,
    winnowing,
)
from tripwright.llm.common import table
from tripwright.session import work_dir


def byte_tokenizer() -> str:
    """Place of the public byte-level vocabulary."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def word_tokenizer() -> str:
    """Place of the public vocabulary with word ends."""
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def op1_pfair_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    chars = F.greatest(F.coalesce(F.length("text"), F.lit(0)), F.lit(1)).cast("long")
    unnamed = F.when(F.col("doc_id").isNull(), F.col("text")).alias("text")
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", chars.alias("n"), unnamed)
    mixed, names = pfair_mix.mix(docs, size="n")
    return mixed.select("doc_id", *[F.col(name).alias(label) for label, name in names.items()])


def op2_compact_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return compact_windows.report(table(spark, sf_dir, "documents"))


def op3_token_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = work_dir(spark, "token-records")
    token_records.write_records(table(spark, sf_dir, "documents"), path, byte_tokenizer())
    return token_records.read_index(spark, path).select("doc_id", "start", "n_tokens", "ids_crc32")


def op4_winnowing(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = winnowing.hits(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        "n_items",
        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"),
        winnowing.contaminated().alias("contaminated"),
    )


def op5_suffix_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_tree.score(table(spark, sf_dir, "documents"))


def op6_entropy_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return entropy_secrets.report(table(spark, sf_dir, "documents"))


def op7_site_bayes(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    judged, names = site_bayes.judge(docs, table(spark, sf_dir, "labels"))
    return judged.select("doc_id", *[F.col(name).alias(label) for label, name in names.items()])


def op8_set_relations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return set_relations.classes(table(spark, sf_dir, "documents"))


def op9_dice_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dice_licenses.scan(table(spark, sf_dir, "documents"))


def op10_mtree_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = mtree_topk.whole_vectors(table(spark, sf_dir, "embeddings"))
    return mtree_topk.top_k(vectors, vectors.where("vec_id % 50 = 0"))


def op11_trie_frontier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trie_frontier.variants(table(spark, sf_dir, "documents"))


def op12_min_slack(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = min_slack.pack(table(spark, sf_dir, "documents"), word_tokenizer())
    return pieces.select(
        "doc_id",
        "start",
        "length",
        F.crc32("ids").alias("ids_crc32"),
        "doc_tokens",
        "sequence_id",
        "offset",
    )


def op13_prefix_bitmaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_bitmaps.trie(table(spark, sf_dir, "conversations"))


QUERIES = {
    f.__name__: f
    for f in (
        op1_pfair_mix,
        op2_compact_windows,
        op3_token_records,
        op4_winnowing,
        op5_suffix_tree,
        op6_entropy_secrets,
        op7_site_bayes,
        op8_set_relations,
        op9_dice_licenses,
        op10_mtree_topk,
        op11_trie_frontier,
        op12_min_slack,
        op13_prefix_bitmaps,
    )
}
