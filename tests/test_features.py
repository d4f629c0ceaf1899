"""Encoding: toy parity, ML vector against long form, hashing properties."""

from pyspark.ml import Pipeline
from pyspark.ml.feature import OneHotEncoder, StringIndexer, VectorAssembler
from pyspark.sql import functions as F

from clicklens import fixtures as fx
from clicklens.operators import features as fe
from conftest import SF_SMALL


def _toy(spark, test=False):
    rows = []
    for i in range(20):
        y = 0 if i < 10 else 1
        o1 = [1, 2, 3, 4][i // 5]
        if test and o1 == 1:
            o1 = 100
        cat2 = None if (i % 5 == 0 and not test) else "abcd"[i % 4]
        cat3 = "xy"[i % 2]
        rows.append((i, y, o1, cat2, cat3))
    return spark.createDataFrame(rows, "id long, y int, o1 int, cat2 string, cat3 string")


def test_toy_width_and_active_slots(spark):
    """Width 10; a missing category has no active slot (reference toy)."""
    train = _toy(spark)
    model = fe.StashEncoder(["o1", "cat2", "cat3"], -1, {"o1": 1000001}, null_to_stash=False).fit(train)
    out = model.transform(train).orderBy("id").collect()
    assert out[0]["features"].size == 10
    assert [(r["features"].size, r["features"].numNonzeros()) for r in out[:3]] == [(10, 2), (10, 3), (10, 3)]
    # unseen test value 100 -> stash label unseen in train -> no slot
    test = model.transform(_toy(spark, test=True)).orderBy("id").collect()
    assert test[0]["features"].numNonzeros() == 2


def test_toy_matches_plain_spark_ml(spark):
    train = _toy(spark)
    cols = ["o1", "cat2", "cat3"]
    pipe = Pipeline(stages=[StringIndexer(inputCols=cols, outputCols=[c + "_i" for c in cols], handleInvalid="keep"),
                            OneHotEncoder(inputCols=[c + "_i" for c in cols], outputCols=[c + "_v" for c in cols]),
                            VectorAssembler(inputCols=[c + "_v" for c in cols], outputCol="features")])
    ref = {r["id"]: r["features"] for r in pipe.fit(train).transform(train).collect()}
    ours = fe.StashEncoder(cols, -1, {"o1": 1000001}, null_to_stash=False).fit(train)
    got = {r["id"]: r["features"] for r in ours.transform(train).collect()}
    assert ref == got


def test_vector_equals_long_form(spark):
    imp = fx.impressions(spark, SF_SMALL)
    model = fe.StashEncoder(fx.IMPRESSIONS.features, 5, fx.IMPRESSION_SENTINELS).fit(imp)
    long = model.long_form(model.stash(imp), "id").select("id", "slot", "value")
    vec = fe.vector_entries(model.transform(imp), "id")
    assert sorted(long.collect()) == sorted(vec.collect())


def test_feature_catalog_matches_label_slots(spark):
    imp = fx.impressions(spark, SF_SMALL)
    model = fe.StashEncoder(fx.IMPRESSIONS.features, 5, fx.IMPRESSION_SENTINELS).fit(imp)
    cat = {(r["idx"], r["name"]) for r in fe.feature_catalog(model.transform(imp)).collect()}
    labels = {(r["slot"], r["feature"]) for r in model.labels.collect()}
    assert cat == labels


def test_hashing_properties(spark):
    imp = fx.impressions(spark, SF_SMALL)
    cols = fx.IMPRESSIONS.features
    a = fe.hash_features(imp, cols, 64, categorical_cols=list(fx.IMPRESSIONS.categorical))
    rows = a.select("id", "features").collect()
    assert all(r["features"].size == 64 for r in rows)
    assert all(r["features"].numNonzeros() <= len(cols) for r in rows)
    b = fe.hash_features(imp.repartition(3), cols, 64, categorical_cols=list(fx.IMPRESSIONS.categorical))
    assert dict((r["id"], r["features"]) for r in rows) == {r["id"]: r["features"] for r in b.collect()}


def test_impute_and_dummies(spark):
    df = spark.createDataFrame([(1, None, "a"), (2, 5, None)], "id long, n int, c string")
    out = {r["id"]: r for r in fe.impute_numeric(df, ["n"], sentinel=-1).collect()}
    assert (out[1]["n"], out[1]["n_missing"], out[2]["n"], out[2]["n_missing"]) == (-1, 1, 5, 0)
    d = {r["id"]: (r["c_a"], r["c_b"]) for r in fe.dummy_columns(df, "c", ["a", "b"]).collect()}
    assert d == {1: (1, 0), 2: (0, 0)}
    med = fe.impute_numeric(df, ["n"], strategy="median").filter(F.col("id") == 1).first()["n_imp"]
    assert med == 5.0


def test_label_index_alphabetical(spark):
    df = spark.createDataFrame([(1,), (1,), (1,), (0,)], "y int")
    out = [r["label"] for r in fe.label_index(df, "y").collect()]
    assert sorted(out) == [0.0, 1.0, 1.0, 1.0]
