"""Embedding near-dedup against all pairs."""

import numpy as np
import pytest

from clicklens.llm import embed_pca as E


def plain(ids, x, t=0.95):
    u = x / np.sqrt((x * x).sum(axis=1, keepdims=True))
    near = u @ u.T >= t
    np.fill_diagonal(near, False)
    label = np.array(ids)
    while True:
        now = np.array([min([label[i], *label[near[i]]]) for i in range(len(ids))])
        if (now == label).all():
            return near.sum(axis=1).tolist(), label.tolist()
        label = now


def planted(n=700, dim=24, seed=3):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, dim))
    for i in range(0, 300):  # one large loose group, chains and copies
        x[i] = x[400] + 0.18 * rng.normal(size=dim)
    for i in range(300, 350):
        x[i] = x[i - 1] + 0.2 * rng.normal(size=dim)
    x[350:390] = x[500]
    return x.astype(np.float32)


@pytest.mark.parametrize("tile,step", [(2048, 16), (64, 5)])
def test_all_links(spark, monkeypatch, tile, step):
    monkeypatch.setattr(E, "TILE", tile)
    monkeypatch.setattr(E, "STEP", step)
    x = planted()
    order = np.random.default_rng(1).permutation(len(x))
    df = spark.createDataFrame([(int(i), x[i].tolist(), 0) for i in order], "vec_id long, embedding array<float>, tile int").repartition(4)
    got = sorted(E.near_duplicates(df).collect())
    n, label = plain(range(len(x)), x.astype(np.float64))
    assert [r.n_links for r in got] == n and [r.component_id for r in got] == label
    assert [r.kept for r in got] == [i == c for i, c in enumerate(label)]
    assert max(n) > 200


def test_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, [1.0, 0.0]), (2, [2.0, 0.0]), (3, None), (4, []), (5, [0.0, -0.0]), (6, [nan, 1.0]), (7, [None, 1.0]), (8, [1.0, 0.0, 0.0]),
            (9, [1.0, 0.0]), (9, [1.0, 0.0]), (None, [1.0, 0.01]), (10, [1e300, 0.0]), (11, [inf, 0.0]), (12, [-1.0, 0.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = sorted((r.vec_id or 0, r.n_links, r.component_id, r.kept) for r in E.near_duplicates(df).collect())
    alone = [(i, 0, i, True) for i in (3, 4, 5, 6, 7, 8, 11, 12)]
    assert got == sorted([(0, 5, 1, False), (1, 5, 1, True), (2, 5, 1, False), (9, 5, 1, False), (9, 5, 1, False), (10, 5, 1, False), *alone])
    assert E.near_duplicates(df.where("false")).count() == 0 and E.near_duplicates(df.where("vec_id = 3")).count() == 1


def test_given_up_pairs_are_below_the_threshold():
    x = planted(seed=8)
    u = E.unit(x)
    rotation = np.linalg.eigh(u.T @ u)[1][:, ::-1]
    i, j = E.links(x[:300], x[200:], rotation, 0.9)
    want = np.nonzero(u[:300] @ u[200:].T >= 0.9)
    assert set(zip(i.tolist(), j.tolist(), strict=True)) == set(zip(*[w.tolist() for w in want], strict=True))
