"""Ranked search: equals scoring of every document, and bounds that hold."""

import math
import re
from collections import Counter

import duckdb
import numpy as np
import pytest
from conftest import SF_SMALL
from hypothesis import given, settings
from hypothesis import strategies as st

from clicklens.llm import ball_tree as B

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def plain_terms(text):
    return TERM.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def plain(items, docs, k=20):
    held = [(i, Counter(plain_terms(t))) for i, t in docs]
    n_docs, total = sum(bool(c) for _, c in held), sum(sum(c.values()) for _, c in held)
    df = Counter(t for _, c in held for t in c)
    out = []
    for item, text in items:
        scores = []
        for doc, c in held:
            m = 75 + 25 * sum(c.values()) * n_docs // max(1, total)
            scores.append((sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 12 * m))
                               for t in plain_terms(text) if t in c), doc))
        scores.sort(key=lambda s: (-s[0], s[1] is None, s[1] or 0))
        out += [(item, r + 1, d, s) for r, (s, d) in enumerate(scores[:k]) if s > 0]
    return sorted(out, key=str)


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


@settings(max_examples=100, deadline=None)
@given(st.text(st.sampled_from("aZé0 _-{\x7f\x80\n'日"), max_size=30))
def test_terms(text):
    assert [t.decode() for t in B.terms(text)] == plain_terms(text)


@pytest.mark.parametrize("seed", range(6))
def test_bounds_hold_and_searches_are_exact(seed, monkeypatch):
    rng = np.random.default_rng(seed)
    monkeypatch.setattr(B, "LEAF", 4)
    sizes = rng.integers(1, 12, 200)
    ids = np.concatenate([rng.choice(60, s, replace=False) for s in sizes])
    values = rng.integers(0, 10**int(rng.integers(1, 11)), len(ids))
    tree = B.BallTree(sizes, ids, values)
    begin, doc_ids, opened = np.cumsum(sizes) - sizes, rng.permutation(200), 0
    for _ in range(20):
        item = np.sort(rng.choice(70, 6, replace=False)), rng.integers(1, 4, 6)
        count = dict(zip(*(x.tolist() for x in item), strict=True))
        scores = np.array([sum(count.get(t, 0) * v for t, v in zip(ids[b:b + s].tolist(), values[b:b + s].tolist(), strict=True)) for b, s in zip(begin, sizes, strict=True)])
        at = np.minimum(np.searchsorted(tree.terms, item[0]), len(tree.terms) - 1)
        known = tree.terms[at] == item[0]
        bound = tree.bounds(at[known], item[1][known].astype(float), float(np.sqrt(np.square(item[1]).sum())))
        for level, edges in enumerate(tree.edges):
            for i in range(1 << level):
                own = scores[tree.order[edges[i]:edges[i + 1]]]
                assert not len(own) or own.max() <= bound[(1 << level) - 1 + i]
        best = B.Best(5, 0)
        opened += tree.search(item, best, doc_ids)
        assert sorted(((-s, -d) for s, d in best.heap)) == sorted((-s, d) for s, d in zip(scores.tolist(), doc_ids.tolist(), strict=True) if s > 0)[:5]
    assert 0 < opened < 20 * (1 << tree.depth)


def test_search_leaves_subtrees_out():
    """Items that a few documents hold whole: most leaves stay closed."""
    rng = np.random.default_rng(0)
    ids = [np.unique(np.concatenate([[i // 16 * 5 + j for j in range(5)], rng.integers(2000, 2010, 3)])) for i in range(1024)]
    sizes = np.array([len(x) for x in ids])
    flat = np.concatenate(ids)
    tree = B.BallTree(sizes, flat, np.where(flat < 2000, 10**6, 10**4))
    opened = 0
    for i in range(64):
        best = B.Best(16, 0)
        opened += tree.search((np.arange(5 * i, 5 * i + 5), np.ones(5, np.int64)), best, np.arange(1024))
        assert sorted(-d for _, d in best.heap) == list(range(16 * i, 16 * i + 16))
    assert opened < 0.2 * 64 * (1 << tree.depth)


def test_query_equals_plain_scores_and_sql(spark, monkeypatch):
    items, docs = (spark.read.parquet(f"{SF_SMALL}/{t}.parquet") for t in ("benchmark", "documents"))
    want = plain([tuple(r) for r in items.select("item_id", "text").collect()], [tuple(r) for r in docs.select("doc_id", "text").collect()])
    assert rows(B.query(items, docs)) == want
    con = duckdb.connect()
    for t in ("benchmark", "documents"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF_SMALL}/{t}.parquet'")
    assert sorted(con.execute(B.ORACLE).fetchall(), key=str) == want
    # several blocks, small trees and a draw change nothing
    for name, value in (("BLOCK", 1500), ("CHUNK", 40), ("LEAF", 4), ("DRAW", 60)):
        monkeypatch.setattr(B, name, value)
    assert rows(B.query(items.repartition(3), docs.repartition(5))) == want


def test_odd_rows(spark):
    docs = [(1, None), (2, ""), (3, "?! --"), (4, "alpha beta"), (4, "alpha beta"), (None, "alpha beta"), (9, "ALPHA été"), (5, "gamma " * 50_000),
            (6, "beta"), (-7, "alpha beta")] + [(100 + i, "alpha beta") for i in range(25)]
    items = [(1, "Alpha alpha beta"), (1, "gamma"), (2, None), (3, ""), (None, "beta?"), (4, "unknown"), (5, "été")]
    d = spark.createDataFrame([(*r, 1, "x") for r in docs], "doc_id long, text string, n int, item string").repartition(3)
    i = spark.createDataFrame([(*r, 1, 2) for r in items], "item_id long, text string, rank int, score int")
    assert rows(B.query(i, d)) == plain(items, docs)
    assert B.query(i.where("false"), d).count() == 0 and B.query(i, d.where("false")).count() == 0
    assert [c for c, _ in B.query(i.where("false"), d).dtypes] == ["item_id", "rank", "doc_id", "score"]
