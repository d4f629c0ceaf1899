"""Corpus pipeline: five stages over ``documents``, each written and read again.

Each stage takes (spark, docs, sf_dir) and works on all rows that the stage before
has kept. All but the last return the columns of ``documents``; the last one
returns the token ids of every document that is left.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clicklens.llm import decontam, langid_kn, sentencepiece_sa, simhash_bk, suffix_pfp
from clicklens.llm.common import materialize, table

TOKENIZER = "piece_bpe_32k.model"


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without a letter, and texts unlike every learned language, go."""
    return langid_kn.keep_identified(docs)


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays."""
    return simhash_bk.drop_near_duplicates(docs)


def suffix_array_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeated strings of 100 bytes are cut from all texts but the first."""
    return suffix_pfp.without_repeats(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark passage go."""
    return decontam.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def sentencepiece(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids of every text, and the text that they decode to."""
    vocabulary = sentencepiece_sa.load(public_tokenizers.path(TOKENIZER))
    rows = sentencepiece_sa.with_ids_and_text(docs, vocabulary)
    return rows.select("doc_id", "lang", "source", F.size("ids").alias("n_tokens"), "ids", "decoded")


STAGES = [
    ("language_id", language_id),
    ("simhash_near_dedup", simhash_near_dedup),
    ("suffix_array_dedup", suffix_array_dedup),
    ("decontamination", decontamination),
    ("sentencepiece", sentencepiece),
]

# Fingerprints, language models and tokenizers have no SQL form; tests use brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return docs
