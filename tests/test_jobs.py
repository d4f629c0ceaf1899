"""Model jobs: fits without scoring, grids, names of hashed slots, scratch scopes, bad lines, order keys."""

import datetime
import os
import random

import numpy as np
import pytest
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from clicklens import fixtures as fx
from clicklens import session
from clicklens.operators import features as fe
from clicklens.operators import metrics, models, ordered, vocab
from clicklens.plans import jobs
from clicklens.sources import io
from conftest import SF_SMALL

NUMS, CATS = list(fx.IMPRESSIONS.numeric), list(fx.IMPRESSIONS.categorical)


def test_a_fit_scores_nothing(spark, monkeypatch):
    monkeypatch.setattr(models, "score", lambda *a, **k: pytest.fail("scored"))
    fit = jobs.onehot_fit(fx.signal_impressions(spark, SF_SMALL), "id", "y", ["cat3", "n2"], 5, fx.IMPRESSION_SENTINELS, max_iter=3)
    assert models.training_curve(fit.model, spark).count() >= 2
    assert models.coefficient_table(fit.model, fit.train_x).count() == fit.model.numFeatures


def test_names_come_from_labels_or_metadata(spark):
    fit = jobs.onehot_fit(fx.signal_impressions(spark, SF_SMALL), "id", "y", ["cat3", "n2"], 5, fx.IMPRESSION_SENTINELS, max_iter=2)
    by_metadata = models.coefficient_table(fit.model, fit.train_x).collect()
    by_labels = models.coefficient_table(fit.model, fit.train_x, catalog=fit.encoder.catalog()).collect()
    assert sorted(by_metadata) == sorted(by_labels)
    wide = fit.encoder.wide_vectors(fit.train, ["id"])
    again = models.train_lr(wide, max_iter=2)
    assert np.allclose(again.coefficients.toArray(), fit.model.coefficients.toArray(), atol=1e-8)


def test_grid_rows_follow_their_candidates(spark):
    rng = random.Random(2)
    rows = [(float(i % 2), i % 2 + rng.gauss(0, 0.5), rng.gauss(0, 1)) for i in range(400)]
    df = VectorAssembler(inputCols=["a", "b"], outputCol="features").transform(spark.createDataFrame(rows, "label double, a double, b double"))
    grid = [({"reg": r, "net": e}, LogisticRegression(regParam=r, elasticNetParam=e)) for r, e in ((0.0, 0.0), (100.0, 1.0))]
    got = [tuple(r) for r in models.fit_grid(df, df, grid).collect()]
    assert [g[:2] for g in got] == [(0.0, 0.0), (100.0, 1.0)] and got[0][2] > 0.9 and got[1][2] == 0.5
    assert spark.sparkContext._jsc.getPersistentRDDs().size() == 0


@pytest.mark.parametrize("width", [4, 64, 1 << 18])
def test_slot_dictionary_is_the_hashers(spark, width):
    df = spark.createDataFrame([(1, "a", 2.5, True), (2, None, None, False), (3, "it's=x", 1.0, None), (None, "", 2.5, True)],
                               "i int, s string, d double, b boolean")
    cols = ["i", "s", "d", "b"]
    got = {(r.col_name, r.value): r.slot for r in fe.slot_dictionary(df, cols, width, categorical_cols=["d"]).collect()}
    assert set(got) == {("i", None), ("s", "a"), ("s", "it's=x"), ("s", ""), ("d", "2.5"), ("d", "1.0"), ("b", "true"), ("b", "false")}
    for row in df.collect():
        x = fe.hash_features(df.where(F.col("i").eqNullSafe(F.lit(row.i))), cols, width, categorical_cols=["d"]).first().features
        named = {got["s", row.s]} if row.s is not None else set()
        named |= {got["i", None]} if row.i is not None else set()
        named |= {got["d", str(row.d)]} if row.d is not None else set()
        named |= {got["b", str(row.b).lower()]} if row.b is not None else set()
        assert set(x.indices.tolist()) == named
    per = fe.slot_collisions(fe.slot_dictionary(df, cols, width, categorical_cols=["d"])).collect()
    assert sum(r.features for r in per) == sum(n for n in np.bincount(list(got.values())) if n > 1)


def test_hashed_weights_name_all_features_of_a_slot(spark):
    df = spark.createDataFrame([(v,) for v in "abcdefgh"], "s string")
    names = fe.slot_dictionary(df, ["s"], 4)
    rows = fe.hashed_weights([(i, float(i)) for i in range(4)], names).where("feature is not null").collect()
    assert sorted(r.feature for r in rows) == [f"s={v}" for v in "abcdefgh"]
    assert all(r.features == sum(1 for q in rows if q.slot == r.slot) for r in rows)


def test_scope_deletes_its_scratch_tables(spark):
    base = session.ensure_checkpoint_dir(spark).removeprefix("file:")
    with session.scratch_scope(spark) as path:
        df = spark.createDataFrame([("a",)] * 5 + [("b",)], "c string")
        vocab.stash_rare(df, ["c"], 2).collect()
        with session.scratch_scope(spark) as inner:
            io.written(df, "x").count()
            assert inner != path and os.listdir(inner.removeprefix("file:"))
        assert not os.path.exists(inner.removeprefix("file:")) and os.listdir(path.removeprefix("file:"))
    assert not os.path.exists(path.removeprefix("file:"))
    with pytest.raises(RuntimeError), session.scratch_scope(spark) as path:
        io.written(df, "x")
        raise RuntimeError
    assert not os.path.exists(path.removeprefix("file:")) and os.path.isdir(base)


def test_bad_lines_are_kept_apart(spark, tmp_path):
    lines = ["1\t2\ta", "x\t2\ta", "3\t4", "5\t6\tb\tc", "\t\t", "7\t8\t\\N", "9\t10\té", ""]
    (tmp_path / "t.txt").write_text("\n".join(lines) + "\n", encoding="utf-8")
    schema = spark.createDataFrame([], "a int, b int, c string").schema
    good, bad = io.read_tsv_quarantined(spark, str(tmp_path / "t.txt"), schema, null_value="\\N")
    assert sorted(r.line for r in bad.collect()) == sorted(["x\t2\ta", "3\t4", "5\t6\tb\tc", ""])
    assert {tuple(r) for r in good.collect()} == {(1, 2, "a"), (7, 8, None), (9, 10, "é"), (None, None, None)}
    assert good.columns == ["a", "b", "c"]


@pytest.mark.parametrize("buckets", [1, 4, 64])
@pytest.mark.parametrize("kind", ["date", "text", "pair"])
def test_order_keys_of_any_type(spark, buckets, kind):
    rng = random.Random(5)
    days = [datetime.date(2024, 1, 1) + datetime.timedelta(i) for i in range(120)]
    rows = [(d, f"t{d:%j}", rng.choice("ab"), i, float(i) if rng.random() < 0.2 else None) for i, d in enumerate(days)] + [(None, None, "a", -1, 7.0)]
    df = spark.createDataFrame(rows, "d date, t string, g string, i int, v double").repartition(6)
    keys = {"date": "d", "text": "t", "pair": ["g", "t", "i"]}[kind]
    last, want = None, {}
    for r in sorted(rows, key=lambda r: (r[2], r[1] or "", r[3]) if kind == "pair" else (r[1] or "",)):
        last = r[4] if r[4] is not None else last
        want[r[3]] = last
    got = ordered.forward_fill(df, "v", keys, out_col="f", n_buckets=buckets).collect()
    assert {r.i: r.f for r in got} == want
    before = ordered.with_previous(df, "i", keys, "p", n_buckets=buckets).collect()
    order = list(want)
    assert {r.i: r.p for r in before} == dict(zip(order, [None, *order[:-1]]))
    assert metrics.durbin_watson(df.select("d", "t", "g", "i", F.lit(1).alias("label"), (F.col("i") / 200).alias("prob")), keys, n_buckets=buckets).first().rows == 121
