"""Quality classifier: identity, held-out accuracy and edge cases."""

import zlib

import numpy as np
import pytest
from conftest import SF_CHECK

from clicklens.llm import quality_fm as Q


def test_linear_time_score_is_the_pairwise_sum():
    rng = np.random.default_rng(0)
    model = Q.Model(0.3, rng.normal(size=40), rng.normal(size=(40, 5)))
    index = [np.sort(rng.choice(40, n, replace=False)) for n in (0, 1, 2, 17, 0, 40)]
    value = [rng.normal(size=len(i)) for i in index]
    want = [0.3 + model.linear[i] @ x + sum(model.factors[i[a]] @ model.factors[i[b]] * x[a] * x[b] for a in range(len(i)) for b in range(a))
            for i, x in zip(index, value, strict=True)]
    assert model.raw(index, value) == pytest.approx(want)


def test_held_out_accuracy_and_spark_score(spark):
    docs, labels = (spark.read.parquet(f"{SF_CHECK}/{t}.parquet") for t in ("documents", "labels"))
    got = {r.doc_id: r for r in Q.query(docs, labels).collect()}
    assert len(got) == docs.count()
    marks = {r.doc_id: r.quality for r in labels.collect()}
    for i, r in got.items():
        assert r.held_out == (zlib.crc32(str(i).encode()) % 5 == 0) and 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3)
    held = [(r.score, marks[i]) for i, r in got.items() if r.held_out and i in marks]
    good, bad = ([s for s, q in held if q == k] for k in (1, 0))
    assert np.mean([g > b for g in good for b in bad]) > 0.95
    assert np.mean([s >= 0.3 for s in good]) > 0.95


def test_edges(spark):
    rows = [(1, "Good text here. It reads well.", 30, 1), (2, "!!! ### !!!", None, 0), (3, None, None, None), (4, "", 0, 1), (None, "word", 4, 0),
            (2, "!!! ### !!!", None, 0), (5, "word " * 40_000, 200_000, 1)]
    docs = spark.createDataFrame([r[:3] + ("x", 1.0) for r in rows], "doc_id long, text string, n_chars long, features string, raw double")
    labels = spark.createDataFrame([(r[0], r[3]) for r in rows], "doc_id long, quality int")
    got = Q.query(docs, labels).collect()
    assert len(got) == len(rows) and all(0 <= r.score <= 1 for r in got)
    one = Q.with_score(docs, Q.train(docs.selectExpr("text", "n_chars", "1 AS label")))
    assert {r.score for r in one.collect()} == {1.0}
    assert {r.score for r in Q.query(docs, labels.where("false")).collect()} == {0.5}
    assert Q.query(docs.where("false"), labels).count() == 0


@pytest.mark.parametrize("share", [0.9 / (1 << 20), 1.9 / (1 << 20), 0.01])
def test_small_shares_are_drawn_whole(spark, share):
    n = 1 << 26
    want = share * n
    assert abs(Q.draw(spark.range(n).withColumnRenamed("id", "doc_id"), share).count() - want) < 4 * np.sqrt(want)
