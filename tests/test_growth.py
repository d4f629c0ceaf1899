"""Shapes that keep queries linear: sparse vectors stay sparse, forests read bounded parts, one column is joined once."""

from pyspark.ml.linalg import Vectors, VectorUDT
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clicklens.functions import scalar
from clicklens.operators import models, vocab, wide


def test_elements_of_sparse_vectors(spark):
    rows = [(Vectors.sparse(2_000_000_000, [0, 7], [1.5, 2.5]),), (Vectors.sparse(5, [], []),), (Vectors.dense([3.0, 4.0]),), (None,)]
    df = spark.createDataFrame(rows, T.StructType([T.StructField("v", VectorUDT())]))
    got = df.select(*[scalar.vector_element("v", i).alias(f"e{i}".replace("-", "m")) for i in (0, 1, 7, -1)]).collect()
    assert [tuple(r) for r in got] == [(1.5, 0.0, 2.5, None), (0.0, 0.0, None, None), (3.0, 4.0, None, None), (None, None, None, None)]


def test_parts_of_a_forest(spark, monkeypatch):
    rows = [(Vectors.sparse(100, [i % 100], [1.0]), float(i % 100 > 50)) for i in range(1000)]
    df = spark.createDataFrame(rows, T.StructType([T.StructField("features", VectorUDT()), T.StructField("label", T.DoubleType())])).coalesce(1)
    assert models.spread_for_trees(df, "features", 10) is df
    monkeypatch.setattr(models, "TREE_BYTES", 10_000)
    spread = models.spread_for_trees(df, "features", 10)
    assert spread.rdd.getNumPartitions() == 44 and spread.count() == 1000
    seen = []
    whole = models._training_frame
    monkeypatch.setattr(models, "_training_frame", lambda data, *a: seen.append(data.rdd.getNumPartitions()) or whole(data, *a))
    assert models.train_rf(df, num_trees=10).getNumTrees == 10 and seen == [44]
    assert models.spread_for_trees(df.where("false"), "features", 10).count() == 0


def test_one_long_list_is_one_join(spark, monkeypatch):
    """A single column with a long list: no written copy of the frame; nulls and hot values keep apart."""
    def refused(*_):
        raise AssertionError("the frame was written")

    monkeypatch.setattr(wide, "numbered", refused)
    values = [None] * 50 + ["hot"] * 60 + ["", "x"] * 3 + [f"v{i // 3}" for i in range(90)] + ["once"]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string").repartition(5)
    kept, sizes = vocab.fit_vocabulary(df, ["v"], 2, with_sizes=True)
    for null_to_stash in (True, False):
        plain, joined = (vocab.apply_stash(df, kept, ["v"], {"v": "stash_v"}, sizes=sizes, null_to_stash=null_to_stash, drop_input=False, **caps)
                         for caps in ({}, {"inset_cap": 0, "broadcast_cap": 0}))
        assert joined.columns == plain.columns == ["i", "v", "v_t"]
        assert sorted(joined.collect(), key=lambda r: r.i) == sorted(plain.collect(), key=lambda r: r.i) and joined.count() == len(values)
    hot = wide.hot_pairs(kept.where(F.col("col_name") == "v"))
    assert hot == {"v": ["hot"]}
