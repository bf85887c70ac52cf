"""From raw documents to token ids: filter, deduplicate, redact, mix, encode.

Each stage takes ``(spark, docs, sf_dir)``; what it returns is written as Parquet and read again
as the ``docs`` of the next one.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docmill.llm import byte_bpe, mixing, ngram_join, pii, quality_rules
from docmill.llm.shared import kept, table

RANKS = "byte_bpe_multi_50k.tiktoken"
COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def documents_of(df: DataFrame, text: str = "text") -> DataFrame:
    """The columns of documents, with a text that a stage may have changed."""
    return df.select("doc_id", F.col(text).alias("text"), "lang", "source", F.length(text).cast("long").alias("n_chars"))


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents the rules keep, without the lines above the limits of their hosts."""
    return documents_of(quality_rules.apply_rules(docs.select(*COLUMNS)).where("kept"), "cleaned")


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of similar ones."""
    return ngram_join.one_of_each(docs.select(*COLUMNS), ngram_join.Options(words=5, percent=80)).select(*COLUMNS)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts with personal data replaced by its kind."""
    return documents_of(pii.redacted(docs.select(*COLUMNS)))


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them."""
    return mixing.repeated(mixing.mix(docs.select(*COLUMNS))).select(*COLUMNS)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every text, and digests that show what they decode to."""
    return byte_bpe.digests(docs, public_tokenizers.path(RANKS), public_tokenizers.PATTERN, with_ids=True)


STAGES = [
    ("quality rules", quality),
    ("n-gram Jaccard join", near_duplicates),
    ("personal data", personal_data),
    ("mixing", mixture),
    ("byte-level BPE", tokens),
]
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = kept(stage(spark, docs, sf_dir), name.lower().replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
