"""Packing: pieces equal the library's ids, places are gapless, numbers of sequences near the least possible."""

import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from conftest import SF_SMALL
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from clicklens.llm import pack_ga as P

PATH = public_tokenizers.path("word_bpe_49k.json")
LIBRARY = Tokenizer.from_file(PATH)


def plain_pieces(docs, capacity, end_id=1):
    out = []
    for doc_id, text in docs:
        ids = np.array([*LIBRARY.encode(text or "", add_special_tokens=False).ids, end_id], "<u4")
        out += [(doc_id, i, at, len(own := ids[at:at + capacity]), zlib.crc32(own.tobytes())) for i, at in enumerate(range(0, len(ids), capacity))]
    return sorted(out, key=str)


def sequences_of(rows, capacity):
    """Checks that places are gapless, and returns the number of sequences."""
    held = defaultdict(list)
    for *_, length, _, sequence, offset in rows:
        held[sequence].append((offset, length))
    for places in held.values():
        ends = np.cumsum([n for _, n in sorted(places)])
        assert [o for o, _ in sorted(places)] == [0, *ends[:-1].tolist()] and ends[-1] <= capacity
    return len(held)


def least(sizes, capacity):
    """Fewest bins of a few pieces, by trying all."""
    best = [len(sizes)]

    def go(i, bins):
        if len(bins) >= best[0]:
            return
        if i == len(sizes):
            best[0] = len(bins)
            return
        for b in range(len(bins)):
            if bins[b] + sizes[i] <= capacity and bins[b] not in bins[:b]:
                go(i + 1, [*bins[:b], bins[b] + sizes[i], *bins[b + 1:]])
        go(i + 1, [*bins, sizes[i]])

    go(0, [])
    return best[0]


@settings(max_examples=150, deadline=None)
@given(st.lists(st.integers(1, 30), min_size=1, max_size=11))
def test_small_groups_reach_the_least(sizes):
    sizes = np.sort(np.array(sizes))[::-1]
    packs = []
    for seed in range(4):
        packs = P.evolve(sizes, packs, None, seed, 30)
    fill = np.bincount(packs[0], sizes)
    assert fill.max() <= 30 and len(fill) == least(sizes.tolist(), 30)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 99), min_size=2, max_size=80), st.integers(0, 1000))
def test_children_hold_each_piece_once(sizes, seed):
    sizes = np.sort(np.array(sizes))[::-1]
    rng = np.random.default_rng(seed)
    a, b = P._first(sizes, 0.5, rng, 100), P._first(sizes, 1.0, rng, 100)
    child = P._child(sizes, a, b, rng, 100)
    assert len(child) == len(sizes) and np.bincount(child, sizes).max() <= 100 and set(child) == set(range(child.max() + 1))


def test_evolution_beats_best_fit_decreasing():
    rng = np.random.default_rng(3)
    # triplets that fill a bin, hard for best fit
    a, b = rng.integers(300, 400, 60), rng.integers(250, 350, 60)
    sizes = np.sort(np.concatenate([a, b, 1000 - a - b]))[::-1]
    first = P._first(sizes, 0.0, rng, 1000)
    packs, guest = [], None
    for epoch in range(30):
        packs = P.evolve(sizes, packs, guest, epoch, 1000)
    assert P.fitness(sizes, packs[0], 1000) > P.fitness(sizes, first, 1000)


@pytest.mark.parametrize("group", [2048, 40])
def test_query_over_a_table(spark, monkeypatch, group):
    monkeypatch.setattr(P, "GROUP", group)
    df = spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text")
    rows = [tuple(r) for r in P.query(df.repartition(5), PATH, capacity=512).collect()]
    want = plain_pieces([tuple(r) for r in df.collect()], 512)
    assert sorted((r[:5] for r in rows), key=str) == want
    bound = -(-sum(r[3] for r in want) // 512)
    assert sequences_of(rows, 512) <= bound + 2 + bound // 50


def test_odd_rows(spark):
    docs = [(None, None), (None, "a b"), (1, ""), (1, ""), (2, "word " * 7), (3, "word " * 8), (4, "word " * 30_000), (5, "é 日本 <|endoftext|> x")]
    docs += [(7, "same text here") for _ in range(60)]
    df = spark.createDataFrame([(*d, 1, "x") for d in docs], "doc_id long, text string, task int, ids string").repartition(4)
    rows = [tuple(r) for r in P.query(df, PATH, capacity=8).collect()]
    want = plain_pieces(docs, 8)
    assert sorted((r[:5] for r in rows), key=str) == want
    assert sequences_of(rows, 8) <= -(-sum(r[3] for r in want) // 8) + 1
    assert P.query(df.where("false"), PATH).count() == 0


def test_many_short_pieces_end(spark, monkeypatch):
    monkeypatch.setattr(P, "GROUP", 16)
    items = spark.range(700).selectExpr("cast(id % 3 as int) task", "id row", "1 length")
    placed = P.pack(items, 100).collect()
    assert sequences_of([(r.task, r.row, 0, 1, 0, r.sequence_id, r.offset) for r in placed], 100) == 7 and len(placed) == 700


def test_sequences_hold_the_ids(spark):
    docs = [(i, f"text number {i} " * (i % 9)) for i in range(40)] + [(None, None)]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    with open(PATH, encoding="utf-8") as f:
        own = P.materialize(P.pieces(df, f.read(), 1, 32), "test-pieces")
    placed = P.place(own, 32)
    built = {r.sequence_id: (r.length, bytes(r.ids), r.doc_ids) for r in P.sequences(placed).collect()}
    for r in placed.collect():
        length, ids, doc_ids = built[r.sequence_id]
        assert ids[4 * r.offset:4 * (r.offset + r.length)] == bytes(r.ids) and len(ids) == 4 * length and r.doc_id in doc_ids
    assert sum(n for n, _, _ in built.values()) == sum(r.length for r in placed.collect())
