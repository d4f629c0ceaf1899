"""The derived impressions reproduce the profile FIXTURES.md states (sf0.01)."""

from pyspark.sql import functions as F

from clicklens import fixtures as fx
from clicklens.operators import split, vocab
from conftest import SF_CHECK


def test_impressions_profile(spark):
    imp = fx.impressions(spark, SF_CHECK)
    r = imp.agg(F.count(F.lit(1)).alias("rows"), F.count("y").alias("labelled"),
                F.round(F.avg("y"), 6).alias("rate")).first()
    assert (r["rows"], r["labelled"], r["rate"]) == (10000, 7986, 0.25119)


def test_threshold_table(spark):
    imp = fx.impressions(spark, SF_CHECK)
    cols = ["cat1", "cat3", "cat4", "n1"]
    v = vocab.vocabulary(imp, cols, fx.FIXTURE_THRESHOLDS)
    got = {r["col_name"]: (r["kept"], r["groups"], r["rows_kept"]) for r in v.groupBy("col_name").agg(
        F.count_if("kept").alias("kept"), F.count(F.lit(1)).alias("groups"),
        F.sum(F.when(F.col("kept"), F.col("n"))).alias("rows_kept")).collect()}
    assert got == {"cat1": (29, 151, 1428), "cat3": (10, 24, 4379),
                   "cat4": (47, 100, 5089), "n1": (35, 293, 5052)}


def test_hash_split_train_rows(spark):
    imp = fx.impressions(spark, SF_CHECK)
    assert split.hash_split(imp, "id").filter("split = 'train'").count() == 7973
