"""Wide columns: bounded vocabularies, one shuffle for all of them, vectors without driver labels."""

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from clicklens import fixtures as fx
from clicklens.operators import features as fe
from clicklens.operators import heavy, vocab, wide
from conftest import SF_SMALL


def _skewed(n=6000, seed=1):
    """Nulls, a hot value, middling and many rare values."""
    rng = random.Random(seed)
    kinds = [lambda: None, lambda: "hot", lambda: f"m{rng.randrange(40)}", lambda: f"r{rng.randrange(100_000)}", lambda: "", lambda: "it's ${x}"]
    return [tuple(rng.choices(kinds, [3, 6, 4, 6, 1, 1])[0]() for _ in range(3)) for _ in range(n)]


@pytest.fixture(scope="module")
def skewed(spark):
    rows = _skewed()
    return rows, spark.createDataFrame(rows, "a string, b string, c string").repartition(7)


@pytest.mark.parametrize("share", [0.2, 0.01, 0.002])
def test_sketch_misses_no_heavy_value(skewed, share):
    rows, df = skewed
    found = {(r.col_name, r.value) for r in heavy.heavy_candidates(df, ["a", "b", "c"], share).collect()}
    for i, c in enumerate("abc"):
        counts = Counter(r[i] for r in rows if r[i] is not None)
        assert {(c, v) for v, n in counts.items() if n > share * len(rows)} <= found
        assert sum(1 for x in found if x[0] == c) <= heavy.sketch_items(share)


def test_share_vocabulary_equals_counts(skewed):
    rows, df = skewed
    got = vocab.fit_vocabulary(df, ["a", "b", "c"], None, share=0.01)
    limit = int(len(rows) * 0.01)
    for i, c in enumerate("abc"):
        counts = Counter(r[i] for r in rows)
        own = {r.value: (r.n, r.kept) for r in got.where(F.col("col_name") == c).collect()}
        kept = {v: (n, True) for v, n in counts.items() if v is not None and n > limit}
        rare = sum(n for v, n in counts.items() if v is not None and n <= limit)
        assert own == kept | {None: (counts[None], False), heavy.RARE: (rare, False)}


def test_written_vocabulary_holds_no_rare_value(skewed):
    _, df = skewed
    for v in (vocab.fit_vocabulary(df, ["a", "b"], 50), vocab.fit_vocabulary(df, ["a", "b"], None, share=0.01)):
        assert {r.value for r in v.where(~F.col("kept")).collect()} <= {None, heavy.RARE}
        assert all(f.startswith("file:") for f in v.inputFiles())  # a written table


def test_stash_value_among_rare_ones_is_refused(spark):
    df = spark.createDataFrame([("x",)] * 50 + [("stash_c",)], "c string")
    with pytest.raises(ValueError, match="stash value"):
        vocab.fit_vocabulary(df, ["c"], None, share=0.1)


def test_small_shares_are_counted(spark):
    df = spark.createDataFrame([("x",), ("y",)], "c string")
    assert heavy.sketch_items(1e-7) is None
    assert {r.value for r in vocab.fit_vocabulary(df, ["c"], None, share=1e-7).where("kept").collect()} == {"x", "y"}
    with pytest.raises(ValueError):
        heavy.sketch_items(1.5)


def _plain_stash(rows, limit):
    counts = [Counter(r[i] for r in rows) for i in range(3)]
    return sorted(tuple(v if v is not None and counts[i][v] > limit else f"stash_{'abc'[i]}" for i, v in enumerate(r)) for r in rows)


@pytest.mark.parametrize("cols", [["a", "b", "c"], ["b"]])
def test_wide_stash_equals_plain(skewed, cols):
    rows, df = skewed
    st = vocab.stash_rare(df, ["a", "b", "c"], 20, broadcast_cap=10**6)
    assert sorted(tuple(r) for r in st.collect()) == _plain_stash(rows, 20)
    v, sizes = vocab.fit_vocabulary(df, ["a", "b", "c"], 20, with_sizes=True)
    got = vocab.apply_stash(df, v, cols, {c: f"stash_{c}" for c in cols}, sizes=sizes, broadcast_cap=0, inset_cap=0, drop_input=False)
    want = vocab.apply_stash(df, v, cols, {c: f"stash_{c}" for c in cols}, sizes=sizes, drop_input=False)
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))


def test_wide_stash_exchanges_the_table_once(skewed):
    _, df = skewed
    v, sizes = vocab.fit_vocabulary(df, ["a", "b", "c"], 20, with_sizes=True)
    got = vocab.apply_stash(df, v, ["a", "b", "c"], {c: f"stash_{c}" for c in "abc"}, sizes=sizes, broadcast_cap=0, inset_cap=0)
    plan = got._jdf.queryExecution().executedPlan().toString()
    whole = [line for line in plan.splitlines() if "Exchange" in line and "hashpartitioning(__row" in line]
    assert len(whole) == 1 and plan.count("SortMergeJoin") == 2  # narrow rows with the list, the table with its matches
    assert "Python" not in plan


def test_bitmap_lets_listed_pairs_pass(spark):
    listed = spark.range(500).select(F.lit("a").alias("col_name"), F.concat(F.lit("v"), F.col("id")).alias("value"))
    words, bits = wide.bitmap(listed, 500)
    assert listed.where(wide.in_bitmap(words, bits)).count() == 500
    others = spark.range(20_000).select(F.lit("a").alias("col_name"), F.concat(F.lit("w"), F.col("id")).alias("value"))
    assert others.where(wide.in_bitmap(words, bits)).count() < 20_000 // 8


def test_hot_values_are_spread(skewed):
    _, df = skewed
    v = vocab.fit_vocabulary(df, ["a"], 20)
    assert "hot" in wide.hot_pairs(v)["a"]
    found = wide.matches(wide.numbered(df), [wide.ROW], ["a"], v.where("kept").select("col_name", "value"), 50, wide.hot_pairs(v))
    assert found.count() == df.where(F.col("a").isin([r.value for r in v.where("kept").collect()])).count()


@pytest.mark.parametrize("null_to_stash", [True, False])
def test_wide_vectors_equal_ml_vectors(spark, null_to_stash):
    imp = fx.impressions(spark, SF_SMALL).select("id", "n1", "n2", "cat1", "cat4")
    enc = fe.StashEncoder(["n1", "cat1", "cat4"], 5, {"n1": -1000}, null_to_stash=null_to_stash).fit(imp)
    by_ml = {r.id: r.features for r in enc.transform(imp, extra_inputs=["n2"]).select("id", "features").collect()}
    for keys in (["id"], None):
        got = enc.wide_vectors(imp, keys, extra_inputs=["n2"])
        assert got.columns == [*imp.columns, "features"]
        for r in got.collect():
            assert r.features.size == by_ml[r.id].size and (r.features.toArray() == by_ml[r.id].toArray()).all()


def test_wide_encoders_keep_labels_off_the_driver(spark, monkeypatch):
    monkeypatch.setattr(fe, "NARROW_LABELS", 0)
    monkeypatch.setattr(fe.StashEncoderModel, "label_arrays", lambda self: pytest.fail("labels on the driver"))
    imp = fx.impressions(spark, SF_SMALL).select("id", "cat4")
    x = fe.StashEncoder(["cat4"], 5).fit(imp).transform(imp)
    assert x.columns == ["id", "features"] and x.count() == imp.count()


@pytest.mark.parametrize("labels,ok", [(["1", "1"], True), (["0"], True), (["0", "1.0", "TRUE", "false"], True), (["1", "2"], False), ([None], False)])
def test_label_index_is_a_fixed_mapping(spark, labels, ok):
    df = spark.createDataFrame([(x,) for x in labels], "y string")
    if not ok:
        with pytest.raises(Exception, match="no class for the label"):
            fe.label_index(df, "y").collect()
        return
    want = [1.0 if x.lower() in ("1", "1.0", "true") else 0.0 for x in labels]
    assert [r.label for r in fe.label_index(df, "y").collect()] == want
