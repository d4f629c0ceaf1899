"""Callers' columns that have the name of a working column come back as they were."""

import public_tokenizers
import pytest
from conftest import SF_SMALL
from pyspark.sql import functions as F

from clicklens.llm import langid_kn, quality_fm, sentencepiece_sa, suffix_pfp, url_rules


def _scored(spark, docs):
    marks = spark.read.parquet(f"{SF_SMALL}/labels.parquet").select(F.col("doc_id").alias("label_id"), F.col("quality").alias("label"))
    labelled = docs.join(marks, F.col("doc_id") == F.col("label_id")).select("doc_id", "text", "n_chars", "label")
    return quality_fm.with_score(docs, quality_fm.train(labelled))


def _pieces(spark, docs):
    return sentencepiece_sa.with_ids_and_text(docs, sentencepiece_sa.load(public_tokenizers.path("piece_bpe_32k.model")))


CASES = {
    "quality": (quality_fm.WORKING, _scored),
    "language": (["langid", "LangId_"], lambda spark, docs: langid_kn.keep_identified(docs)),
    "suffix": (["repeats", suffix_pfp.K, suffix_pfp.SEQ, "_pfp_spans"], lambda spark, docs: suffix_pfp.without_repeats(docs)),
    "pieces": (["_pieces"], _pieces),
}


@pytest.mark.parametrize("name", sorted(CASES))
def test_columns_of_documents(spark, name):
    clashing, run = CASES[name]
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    own = docs.withColumns({c: F.concat(F.lit(f"{c} of "), F.col("doc_id")) for c in clashing})
    got = run(spark, own)
    assert got.columns[:len(own.columns)] == own.columns
    rows = got.select("doc_id", *clashing).collect()
    assert rows and all(tuple(r)[1:] == tuple(f"{c} of {r.doc_id}" for c in clashing) for r in rows)
    plain = run(spark, docs)
    same = [c for c, t in plain.dtypes if t in ("string", "bigint", "double", "int")]
    assert sorted(map(str, got.select(same).collect())) == sorted(map(str, plain.select(same).collect()))


def test_columns_of_urls(spark):
    clashing = ["_fixed", "_tokens", "_set", "_learned"]
    pages = spark.read.parquet(f"{SF_SMALL}/pages.parquet").select("page_id", "url")
    got = url_rules.judge(pages.withColumns({c: F.concat(F.lit(f"{c} of "), F.col("page_id")) for c in clashing}))
    rows = got.collect()
    assert len(rows) == pages.count() and all(r[c] == f"{c} of {r.page_id}" for r in rows for c in clashing)
    assert sorted(map(str, got.drop(*clashing).collect())) == sorted(map(str, url_rules.judge(pages).collect()))
