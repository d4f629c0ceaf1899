"""Model properties."""

from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from clicklens import fixtures as fx
from clicklens.operators import features as fe
from clicklens.operators import models
from clicklens.plans import jobs
from conftest import SF_CHECK


def test_lr_beats_baseline_and_probability_is_sigmoid(spark):
    sig = fx.signal_impressions(spark, SF_CHECK)
    res = jobs.hashed_lr(sig, "id", "y", fx.IMPRESSIONS.features, list(fx.IMPRESSIONS.categorical), width=1 << 12)
    m = {r["metric"]: r["value"] for r in res.metrics.collect()}
    assert m["log_loss"] < m["baseline_log_loss"]
    hist = res.model.summary.objectiveHistory
    assert all(b <= a + 1e-9 for a, b in zip(hist, hist[1:]))
    chk = res.scored.select(
        F.abs(F.col("prob") - 1 / (1 + F.exp(-vector_to_array("rawPrediction")[1]))).alias("d")).agg(F.max("d"))
    assert chk.first()[0] < 1e-9


def test_rf_beats_baseline(spark):
    sig = fx.signal_impressions(spark, SF_CHECK)
    res = jobs.random_forest(sig, "id", "y", list(fx.IMPRESSIONS.numeric), list(fx.IMPRESSIONS.categorical),
                             10, num_trees=10, max_depth=5)
    m = {r["metric"]: r["value"] for r in res.metrics.collect()}
    assert m["log_loss"] < m["baseline_log_loss"]
    assert m["auroc"] > 0.8


def test_save_load_scores_equal(spark, tmp_path):
    lab = fx.labelled(fx.signal_impressions(spark, SF_CHECK)).withColumn("label", F.col("y"))
    enc = fe.StashEncoder(["cat4", "n4"], 10, {"n4": 1000004}).fit(lab)
    x = enc.transform(lab)
    lr = models.train_lr(x)
    path = str(tmp_path / "m")
    lr.write().overwrite().save(path)
    again = type(lr).load(path)
    a = models.score(lr, x).select("id", F.col("prob").alias("a"))
    b = models.score(again, x).select("id", F.col("prob").alias("b"))
    assert a.join(b, "id").agg(F.max(F.abs(F.col("a") - F.col("b")))).first()[0] == 0.0
