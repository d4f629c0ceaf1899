"""Metrics, ordered windows and splits against brute force."""

import math

import pandas as pd
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.sql import functions as F

from clicklens import fixtures as fx
from clicklens.operators import metrics, ordered, split
from conftest import SF_SMALL


def test_auroc_tied_example(spark):
    df = spark.createDataFrame([(1, 0.8), (0, 0.8), (1, 0.6), (0, 0.2)], "label int, prob double")
    assert metrics.auroc(df).first()["auroc"] == 0.625  # (0.5 + 1 + 0 + 1) / 4
    df2 = spark.createDataFrame([(1, 0.5), (0, 0.5), (1, 0.9), (0, 0.1)], "label int, prob double")
    ev = BinaryClassificationEvaluator(rawPredictionCol="prob", labelCol="label", numBins=0)
    ours = metrics.auroc(df2).first()["auroc"]
    assert abs(ours - ev.evaluate(df2.withColumn("label", F.col("label").cast("double")))) < 1e-9


def test_auroc_bucket_count_invariant(spark):
    sc = fx.scored(spark, SF_SMALL)
    vals = {metrics.auroc(sc, n_buckets=b).first()["auroc"] for b in (1, 3, 17)}
    assert len(vals) == 1


def test_durbin_watson_brute_force(spark):
    sc = fx.scored(spark, SF_SMALL)
    pdf = sc.select("id", "label", "prob").toPandas().sort_values("id")
    e = pdf["label"] - pdf["prob"]
    expected = ((e.diff().dropna() ** 2).sum()) / (e ** 2).sum()
    for b in (1, 4, 13):
        assert abs(metrics.durbin_watson(sc, "id", n_buckets=b).first()["dw"] - round(expected, 6)) < 1e-6


def test_forward_fill_brute_force(spark):
    imp = fx.impressions(spark, SF_SMALL).select("id", "cat1")
    pdf = imp.toPandas().sort_values("id")
    expected = dict(zip(pdf["id"], pdf["cat1"].ffill()))
    for b in (2, 9):
        got = {r["id"]: r["f"] for r in ordered.forward_fill(imp, "cat1", "id", "f", n_buckets=b).collect()}
        assert all((got[k] == v) or (pd.isna(v) and got[k] is None) for k, v in expected.items())


def test_precision_null_without_predicted_positives(spark):
    df = spark.createDataFrame([(1, 0), (0, 0)], "label int, prediction int")
    r = metrics.confusion_counts(df).first()
    assert r["precision_pct"] is None and r["recall_pct"] == 0.0


def test_baseline_equals_entropy(spark):
    df = spark.createDataFrame([(1,)] * 25 + [(0,)] * 75, "label int")
    p = 0.25
    ent = -(p * math.log(p) + (1 - p) * math.log(1 - p))
    assert abs(metrics.baseline_log_loss(df).first()["baseline_log_loss"] - round(ent, 6)) < 1e-6


def test_clipping_keeps_loss_finite(spark):
    df = spark.createDataFrame([(1, 0.0), (0, 1.0)], "label int, prob double")
    assert math.isfinite(metrics.mean_log_loss(df).first()["log_loss"])


def test_hash_split_independent_of_partitioning(spark):
    imp = fx.impressions(spark, SF_SMALL)
    a = {r["id"]: r["split"] for r in split.hash_split(imp, "id").collect()}
    b = {r["id"]: r["split"] for r in split.hash_split(imp.repartition(5, "cat2"), "id").collect()}
    assert a == b
    assert sum(v == "train" for v in a.values()) == 793


def test_oversample_counts(spark):
    lab = fx.labelled(fx.impressions(spark, SF_SMALL))
    pos = lab.filter("y = 1").count()
    neg = lab.filter("y = 0").count()
    assert split.oversample(lab, "y", 1, 2).count() == neg + 3 * pos


def test_forward_fill_across_all_null_ranges(spark):
    rows = [(i, "a" if i == 0 else None) for i in range(40)] + [(40, "b"), (41, None)]
    df = spark.createDataFrame(rows, "id long, c string")
    got = {r["id"]: r["f"] for r in ordered.forward_fill(df, "c", "id", "f", n_buckets=8).collect()}
    assert all(got[i] == "a" for i in range(40)) and got[40] == "b" and got[41] == "b"


def test_exact_median_matches_spark_median(spark):
    from clicklens.operators import profile

    imp = fx.impressions(spark, "/root/testdata/sf0.01")
    cols = list(fx.IMPRESSIONS.numeric)
    a = {(r["label"], r["col_name"]): r["median"] for r in profile.median_by_label(imp, "y", cols).collect()}
    b = {(r["label"], r["col_name"]): r["median"]
         for r in profile.median_by_label(imp.repartition(3), "y", cols, method="map").collect()}
    assert a == b


def test_auroc_invariant_under_monotone_transform(spark):
    sc = fx.scored(spark, SF_SMALL)
    a = metrics.auroc(sc).first()["auroc"]
    b = metrics.auroc(sc.withColumn("prob", F.exp(F.col("prob") * 3.0) - 7.0)).first()["auroc"]
    assert a == b


def test_single_class_and_single_row(spark):
    one_class = spark.createDataFrame([(1, 0.3), (1, 0.9)], "label int, prob double")
    r = metrics.auroc(one_class).first()
    assert r["negatives"] == 0 and r["auroc"] is None
    one_row = spark.createDataFrame([(1, 0.7, 1)], "label int, prob double, prediction int")
    s = metrics.scored_summary(one_row).first()
    assert (s["rows"], s["tp"], s["precision_pct"]) == (1, 1, 100.0)
    assert metrics.durbin_watson(one_row.withColumn("id", F.lit(1)), "id").first()["rows"] == 1


def test_all_null_label(spark):
    from clicklens.operators import profile

    df = spark.createDataFrame([(None, 1), (None, 2)], "y int, n int")
    bal = profile.class_balance(df, "y").collect()
    assert len(bal) == 1 and bal[0]["label"] is None and bal[0]["share"] == 1.0
    assert profile.mean_by_label(df, "y", ["n"]).count() == 0
    assert profile.median_by_label(df, "y", ["n"]).count() == 0


def test_partitioned_forward_fill_with_hot_key(spark):
    imp = fx.impressions(spark, SF_SMALL).select("id", "cat1", (F.col("n5") % 3).alias("k"))
    # one key holds most rows
    imp = imp.withColumn("k", F.when(F.col("k") < 2, F.lit(0)).otherwise(F.col("k")))
    pdf = imp.toPandas().sort_values("id")
    pdf["f"] = pdf.groupby("k")["cat1"].ffill()
    expected = dict(zip(pdf["id"], pdf["f"]))
    for b in (1, 6):
        got = {r["id"]: r["f"] for r in ordered.forward_fill(imp, "cat1", "id", "f", ["k"], n_buckets=b).collect()}
        assert all((got[k] == v) or (pd.isna(v) and got[k] is None) for k, v in expected.items())


def test_three_way_hash_split(spark):
    imp = fx.impressions(spark, "/root/testdata/sf0.01")
    tagged = split.hash_split(imp, "id", (0.6, 0.2, 0.2), ("train", "valid", "test"))
    counts = {r["split"]: r["count"] for r in tagged.groupBy("split").count().collect()}
    assert sum(counts.values()) == 10000
    assert abs(counts["train"] - 6000) < 300 and abs(counts["valid"] - 2000) < 200
    parts = split.split_frames(imp, "id", (0.6, 0.2, 0.2))
    assert sum(p.count() for p in parts) == 10000


def test_sample_lines_seeded_and_hashed(spark, tmp_path):
    from clicklens.sources import io

    path = str(tmp_path / "lines")
    io.write_tsv(fx.impressions(spark, SF_SMALL), path)
    total = spark.read.text(path).count()
    seeded = io.sample_lines(spark, path, 0.5, seed=3).count()
    hashed_a = io.sample_lines(spark, path, 0.5).collect()
    hashed_b = io.sample_lines(spark, path, 0.5).collect()
    assert 0 < seeded < total and sorted(hashed_a) == sorted(hashed_b) and 0 < len(hashed_a) < total
