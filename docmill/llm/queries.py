"""One query per operator, each over its whole table with the parameters meant for production."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docmill.llm import byte_bpe, conversation_repair, lm_scoring, mixing, ngram_join, packing, pii, product_quantisation, quality_classifier, quality_rules, resharding, vector_codes, warc
from docmill.llm.shared import table

RANKS = "byte_bpe_multi_50k.tiktoken"
TOKENIZER = "byte_bpe_50k.json"
SHARDS = 16
OLD_SHARDS = 12


def op1_lm_scoring(spark: SparkSession, folder: str) -> DataFrame:
    return lm_scoring.score_texts(table(spark, folder, "documents"))


def op2_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    columns = ("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")
    return quality_rules.apply_rules(table(spark, folder, "documents").select("doc_id", "source", "text")).select(*columns, "n_removed_words")


def op3_resharding(spark: SparkSession, folder: str) -> DataFrame:
    """Documents lie in shards by source, which are of very different size; they move to even ones."""
    docs = table(spark, folder, "documents").select("doc_id", "source", "text")
    old = F.pmod(F.crc32(F.coalesce("source", F.lit("")).cast("binary")), F.lit(OLD_SHARDS))
    moved = resharding.reshard(docs, old, SHARDS)
    return moved.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"), "old_shard")


def op4_mixing(spark: SparkSession, folder: str) -> DataFrame:
    mixed = mixing.mix(table(spark, folder, "documents").select("doc_id", "source", "text"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


def op5_embedding_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return product_quantisation.near_duplicates(table(spark, folder, "embeddings"))


def op6_byte_bpe(spark: SparkSession, folder: str) -> DataFrame:
    return byte_bpe.digests(table(spark, folder, "documents"), public_tokenizers.path(RANKS), public_tokenizers.PATTERN)


def op7_warc(spark: SparkSession, folder: str) -> DataFrame:
    return warc.captures(warc.read_records(spark, warc.write_archives(table(spark, folder, "pages"))))


def op10_pii(spark: SparkSession, folder: str) -> DataFrame:
    return pii.find(table(spark, folder, "documents"))


def op8_ngram_join(spark: SparkSession, folder: str) -> DataFrame:
    return ngram_join.join(table(spark, folder, "documents"))


def op9_quality_classifier(spark: SparkSession, folder: str) -> DataFrame:
    return quality_classifier.classify(table(spark, folder, "documents"), table(spark, folder, "labels"))


def op11_vector_codes(spark: SparkSession, folder: str) -> DataFrame:
    return vector_codes.compress(table(spark, folder, "embeddings"))


def op12_conversation_repair(spark: SparkSession, folder: str) -> DataFrame:
    conversations = table(spark, folder, "conversations")
    return conversation_repair.repair_report(conversation_repair.damaged(conversations), conversations)


def op13_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packing.pack_documents(table(spark, folder, "documents"), public_tokenizers.path(TOKENIZER), public_tokenizers.PATTERN)


QUERIES = {f.__name__: f for f in (op1_lm_scoring, op2_quality_rules, op3_resharding, op4_mixing, op5_embedding_dedup, op6_byte_bpe, op7_warc, op8_ngram_join, op9_quality_classifier, op10_pii, op11_vector_codes, op12_conversation_repair, op13_packing)}
