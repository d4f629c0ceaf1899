"""No cache outlives a query, shared folders are demanded off local mode, odd rows survive."""

import pytest
from pyspark.sql import functions as F

from clicklens import session
from clicklens.operators import ordered, split, vocab
from clicklens.plans import catalog
from clicklens.sources import io
from conftest import SF_SMALL


@pytest.mark.parametrize("name", ["stash_ctr", "stash_labels", "auroc", "lr_category_rate", "lr_onehot_metrics"])
def test_no_cached_frame_stays(spark, name):
    spark.catalog.clearCache()
    catalog.QUERIES[name](spark, SF_SMALL).collect()
    assert spark.sparkContext._jsc.getPersistentRDDs().size() == 0


class _Context:
    def __init__(self, master):
        self.master = master

    def getCheckpointDir(self):
        return None


@pytest.mark.parametrize("master", ["spark://host:7077", "yarn", "local-cluster[2,1,1024]"])
def test_cluster_needs_a_shared_folder(master):
    class Session:
        sparkContext = _Context(master)

        class conf:
            @staticmethod
            def get(name, default=None):
                return default

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.ensure_checkpoint_dir(Session)


def test_string_stash_may_not_occur_in_the_data(spark):
    df = spark.createDataFrame([("stash_c",), ("a",)], "c string")
    with pytest.raises(ValueError, match="stash value"):
        vocab.fit_vocabulary(df, ["c"], 1)


def test_double_stash_label_reads_as_in_the_data(spark):
    df = spark.createDataFrame([(float(i % 3),) for i in range(9)] + [(77.0,)], "d double")
    v = vocab.fit_vocabulary(df, ["d"], 2, {"d": 1000001})
    stashed = vocab.apply_stash(df, v, ["d"], {"d": 1000001})
    labels = vocab.stash_labels(v, ["d"], {"d": 1000001}, types={"d": df.schema["d"].dataType})
    assert {r.label for r in labels.collect()} == {r[0] for r in stashed.select(F.col("d_t").cast("string")).distinct().collect()}


@pytest.mark.parametrize("buckets", [1, 4, 64])
def test_fill_with_null_keys_and_null_order(spark, buckets):
    rows = [(k, i if i else None, i if i % 3 == 0 else None) for k in ("a", None) for i in range(20)]
    df = spark.createDataFrame(rows, "k string, o long, v long")
    got = ordered.forward_fill(df, "v", "o", "f", ["k"], buckets).collect()
    want = {(k, o): max((v for kk, oo, v in rows if kk == k and v is not None and (oo or 0) <= (o or 0)), default=None) for k, o, _ in rows}
    assert len(got) == 40 and all(r.f == want[r.k, r.o] for r in got)


def test_null_split_keys_are_spread(spark):
    df = spark.createDataFrame([(None, i) for i in range(2000)], "k long, x int")
    n = {r.split: r["count"] for r in split.hash_split(df, "k").groupBy("split").count().collect()}
    assert 1500 < n["train"] < 1700


def test_round_trip_check_sees_moved_and_changed_values(spark):
    schema = "a string, b int"
    a = spark.createDataFrame([("ab", 1), ("cd", 2)], schema)
    for other in ([("zz", 7), ("cd", 2)], [("ab", 2), ("cd", 1)]):
        assert not all(r.equal for r in io.round_trip_check(a, spark.createDataFrame(other, schema)).collect())
    assert all(r.equal for r in io.round_trip_check(a, a.orderBy("b", ascending=False)).collect())


def test_shuffle_form_is_a_shuffle_join(spark):
    df = spark.createDataFrame([(str(i % 50),) for i in range(500)], "c string")
    v = vocab.fit_vocabulary(df, ["c"], 3)
    out = vocab.apply_stash(df, v, ["c"], {"c": "stash_c"}, inset_cap=0, broadcast_cap=0)
    assert "SortMergeJoin" in out._jdf.queryExecution().executedPlan().toString()
