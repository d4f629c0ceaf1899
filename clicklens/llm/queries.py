"""The registered queries of this subpackage and their SQL."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from clicklens.llm import (
    ball_tree,
    decontam,
    embed_pca,
    langid_kn,
    pack_ga,
    quality_fm,
    runs_recompression,
    sentencepiece_sa,
    simhash_bk,
    suffix_pfp,
    token_index,
    url_rules,
    warc_cas,
)
from clicklens.llm.common import table

PIECES, WORD_BPE = "piece_bpe_32k.model", "word_bpe_49k.json"


def op1_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_fm.query(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op2_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sentencepiece_sa.query(table(spark, sf_dir, "documents"), public_tokenizers.path(PIECES))


def op3_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc_cas.query(table(spark, sf_dir, "pages"))


def op4_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embed_pca.near_duplicates(table(spark, sf_dir, "embeddings"))


def op5_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_rules.query(table(spark, sf_dir, "pages"))


def op6_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.query(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op7_token_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_index.query(table(spark, sf_dir, "documents"), public_tokenizers.path(WORD_BPE))


def op8_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_bk.query(table(spark, sf_dir, "documents"))


def op9_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_pfp.query(table(spark, sf_dir, "documents"))


def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid_kn.query(table(spark, sf_dir, "documents"))


def op11_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ball_tree.query(table(spark, sf_dir, "benchmark"), table(spark, sf_dir, "documents"))


def op12_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_ga.query(table(spark, sf_dir, "documents"), public_tokenizers.path(WORD_BPE))


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return runs_recompression.query(table(spark, sf_dir, "documents"))


_ALL = (op1_quality_classifier, op2_sentencepiece, op3_warc, op4_embedding_near_dedup, op5_url_filter, op6_decontamination,
        op7_token_index, op8_simhash_near_dedup, op9_suffix_array_dedup, op10_language_id, op11_ranked_search,
        op12_best_fit_packing, op13_periodic_runs)
QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {f.__name__: f for f in _ALL}

ORACLE: dict[str, str] = {"op3_warc": warc_cas.ORACLE, "op4_embedding_near_dedup": embed_pca.ORACLE,
                          "op6_decontamination": decontam.ORACLE, "op11_ranked_search": ball_tree.ORACLE}
