"""A saved hashed pipeline scores a stream exactly as it scores a batch."""

from pyspark.ml import PipelineModel
from pyspark.sql import functions as F

from clicklens import fixtures as fx
from clicklens.operators import features as fe
from clicklens.operators import models
from clicklens.session import scratch_path
from clicklens.streaming import scoring
from conftest import SF_SMALL


def test_stream_scores_equal_batch_scores(spark):
    imp = fx.labelled(fx.signal_impressions(spark, SF_SMALL)).withColumn("label", F.col("y"))
    cols = fx.IMPRESSIONS.features
    hasher = fe.FeatureHasher(inputCols=cols, outputCol="features", numFeatures=1 << 10,
                              categoricalCols=list(fx.IMPRESSIONS.categorical))
    lr = models.train_lr(hasher.transform(imp))
    pipe = PipelineModel(stages=[hasher, lr])
    model_path = scratch_path(spark, "stream-model")
    pipe.write().overwrite().save(model_path)

    src = scratch_path(spark, "stream-src")
    imp.drop("label").write.parquet(src)
    stream = scoring.read_impression_stream(spark, src, imp.drop("label").schema, max_files_per_trigger=1)
    out = scratch_path(spark, "stream-out")
    q = scoring.write_scores(scoring.score_stream(stream, model_path, keep=["id"]), out,
                             scratch_path(spark, "stream-ckpt"))
    q.awaitTermination(300)
    got = {r["id"]: r["prob"] for r in spark.read.parquet(out).collect()}
    want = {r["id"]: r["prob"] for r in models.score(pipe, imp).select("id", "prob").collect()}
    assert got.keys() == want.keys()
    assert max(abs(got[k] - want[k]) for k in want) < 1e-12
