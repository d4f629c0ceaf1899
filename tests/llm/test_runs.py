"""Periodic runs: every run equals a plain search over all starts and periods."""

import hashlib
import re
import zlib

import numpy as np
import pytest
from conftest import SF_SMALL
from hypothesis import given, settings
from hypothesis import strategies as st

from clicklens.llm import runs_recompression as R


def plain_runs(w):
    """(start, length, period) by definition: stretches that a period can't be extended over, with no shorter period."""
    out, n = [], len(w)
    for q in range(1, n // 4 + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and w[j] == w[j + q]:
                j += 1
            length = j - i + q
            if length >= max(6, 4 * q) and not any(all(w[k] == w[k + d] for k in range(i, i + length - d)) for d in range(1, q)):
                out.append((i, length, q))
            i = max(j, i + 1) if j > i else i + 1
    return sorted(out, key=lambda r: (r[0], r[2]))


def plain(doc_id, text, loops=True):
    w = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    n = len(w)
    if loops and doc_id is not None and n:
        h = zlib.crc32(str(doc_id).encode())
        if h % 10 == 0:
            g = h // 10
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            w = [w[a + (i - a) % p] if i >= a else w[i] for i in range(n)]
    runs = plain_runs(w)
    gone = {i for s, le, q in runs for i in range(s + q, s + le)}
    best = max(runs, key=lambda r: (r[1] * 10**12 // r[2], -r[0], -r[2]), default=None)
    lines = "".join(f"{s},{le},{q}\n" for s, le, q in runs)
    kept = " ".join(x for i, x in enumerate(w) if i not in gone)
    return (doc_id, len(runs), *(best or (None,) * 3), best and 1000 * best[1] // best[2],
            hashlib.sha256(lines.encode()).hexdigest(), hashlib.sha256(kept.encode()).hexdigest())


def found(texts):
    n = np.array([len(t) for t in texts], np.int64)
    words = np.array([x for t in texts for x in t], np.int64)
    out = [[] for _ in texts]
    for t, *r in zip(*(c.tolist() for c in R.runs(words, n)), strict=True):
        out[t].append(tuple(r))
    return out


repeated = st.builds(lambda u, k, v, m: u * k + v * m, *[st.lists(st.integers(0, 2), max_size=5), st.integers(0, 9)] * 2)


@settings(max_examples=400, deadline=None)
@given(st.lists(st.lists(st.one_of(st.lists(st.integers(0, 1), max_size=30), repeated), max_size=3).map(lambda p: sum(p, [])), max_size=4))
def test_runs_equal_a_plain_search(texts):
    assert found(texts) == [plain_runs(t) for t in texts]


@pytest.mark.parametrize("text", [[0] * 3000, [0, 1] * 999, ([0] * 50 + [1]) * 40, ([0, 1, 0] * 30 + [2]) * 12,
                                  [int(c) for c in "".join(bin(i)[2:] for i in range(60))] * 5, list(range(400)) * 4])
def test_highly_repetitive_texts(text):
    assert found([text, text[::-1], []]) == [plain_runs(text), plain_runs(text[::-1]), []]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.lists(st.integers(0, 1), min_size=1, max_size=40), min_size=1, max_size=3), st.data())
def test_extensions_are_exact(texts, data):
    m = len(texts)
    flat = [x for i, t in enumerate(texts) for x in [i, *(v + m + 1 for v in t)]] + [m]
    places = [i for i, x in enumerate(flat) if x > m]
    x, y = data.draw(st.sampled_from(places)), data.draw(st.sampled_from(places))
    if x == y:
        return
    grammar = R.Grammar(np.array(flat), m + 1)
    for way in (1, -1):
        k = 0
        while flat[x + way * k] == flat[y + way * k]:
            k += 1
        assert grammar.extend(np.array([x]), np.array([y]), way).tolist() == [k]


def test_query_over_a_table(spark):
    df = spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text")
    want = sorted(plain(*r) for r in df.collect())
    assert sorted(tuple(r) for r in R.query(df.repartition(3)).collect()) == want
    assert sum(r[1] > 0 for r in want) > 10


def test_odd_rows(spark):
    ids = [i for i in range(500) if zlib.crc32(str(i).encode()) % 10 == 0][:4]
    rows = [(None, "a b " * 9), (1, None), (1, ""), (2, " \x0b\t\n "), (3, "x\x1cy\x85z é x " * 8), (3, "x\x1cy\x85z é x " * 8),
            (4, "long " * 30_000 + "end"), (ids[0], "a b c d e f g"), (ids[1], "one"), (ids[2], ""), (ids[3], "x y z " * 30), (-5, "A a " * 5)]
    df = spark.createDataFrame([(*r, "f", 1, [1]) for r in rows], "doc_id long, text string, key string, best int, runs array<int>")
    got = sorted((tuple(r) for r in R.query(df.coalesce(1)).collect()), key=str)
    assert [r for r in got if r[0] != 4] == sorted((plain(*r) for r in rows if r[0] != 4), key=str)
    long = plain(4, "long " * 30 + "end")
    assert [r for r in got if r[0] == 4] == [(4, 1, 0, 30_000, 1, 30_000_000, hashlib.sha256(b"0,30000,1\n").hexdigest(), long[-1])]
    assert sorted((tuple(r) for r in R.query(df.repartition(5)).collect()), key=str) == got
    assert R.query(df.where("false")).count() == 0
