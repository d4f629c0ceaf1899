"""Suffix-array dedup against a set of all 100-byte strings in corpus order."""

import hashlib
import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from clicklens.llm import suffix_pfp as P

SCHEMA = "doc_id long, text string"


def plain(docs):
    seen, out = set(), []
    for i, t in docs:
        b = (t or "").encode()
        gone = bytearray(len(b))
        for p in range(len(b) - 99):
            if b[p:p + 100] in seen:
                gone[p:p + 100] = b"\1" * 100
            seen.add(b[p:p + 100])
        kept = bytes(c for c, g in zip(b, gone, strict=True) if not g)
        spans = sum(g and (j == 0 or not gone[j - 1]) for j, g in enumerate(gone))
        out.append((i, len(b), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return out


def corpus(seed, n=60):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdé") for _ in range(rng.randint(1, 6)))
    passages = [" ".join(word() for _ in range(rng.randint(10, 60))) for _ in range(5)]
    docs = []
    for i in range(n):
        parts = [rng.choice(passages) if rng.random() < 0.5 else " ".join(word() for _ in range(rng.randint(1, 40))) for _ in range(rng.randint(0, 5))]
        docs.append((i, rng.choice(["", "|"]).join(parts)))
    docs += [(n, "z" * 700), (n + 1, "ab" * 400), (n + 2, docs[3][1]), (n + 3, None), (n + 4, "\0" * 300), (n + 5, ("q" * 99 + "r") * 5), (n + 6, "é" * 150)]
    return docs


@pytest.mark.parametrize("hot,array,piece,block", [(2000, 1 << 20, 1 << 21, 1 << 24), (0, 300, 333, 2000), (3, 1 << 12, 500, 1 << 24)])
def test_query(spark, monkeypatch, hot, array, piece, block):
    for name, value in (("HOT", hot), ("ARRAY", array), ("PIECE", piece), ("BLOCK", block)):
        monkeypatch.setattr(P, name, value)
    docs = corpus(hot)
    rows = docs[:]
    random.Random(1).shuffle(rows)
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    assert sorted(tuple(r) for r in P.query(df).collect()) == plain(docs)


def test_repeated_ids_nulls_and_other_columns(spark):
    text = " ".join(str(i * 7919) for i in range(60))
    rows = [(2, text, 1, "p"), (2, text, 2, "q"), (None, text, 3, "r"), (1, "short", 4, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, pos int, kind string")
    got = sorted((r.doc_id or -1, r.n_removed) for r in P.query(df).collect())
    n = len(text)
    assert got == [(-1, 0), (1, 0), (2, n), (2, n)]  # the null id comes first
    out = P.without_repeats(df.withColumn("n_chars", df.pos.cast("long")))
    assert out.columns == ["doc_id", "text", "pos", "kind", "n_chars"]
    assert sorted((r.pos, r.n_chars, r.text) for r in out.collect()) == [(1, 0, ""), (2, 0, ""), (3, n, text), (4, 5, "short")]
    assert P.query(df.where("false")).count() == 0


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text("ab", max_size=260), max_size=4))
def test_array_marks_every_later_window(texts):
    bodies = [t.encode() for t in texts]
    marks = set(zip(*[x.tolist() for x in P.repeated_windows(bodies)], strict=True)) if any(len(b) >= 100 for b in bodies) else set()
    seen, want = set(), set()
    for i, b in enumerate(bodies):
        for p in range(len(b) - 99):
            if b[p:p + 100] in seen:
                want.add((i, p))
            seen.add(b[p:p + 100])
    assert marks == want


@settings(max_examples=40, deadline=None)
@given(st.lists(st.binary(max_size=400), min_size=1, max_size=4))
def test_each_window_lies_in_one_phrase(segments):
    seg, start, length, _, _ = P.parse(segments)
    own = [(s, p) for s, a, n in zip(seg.tolist(), start.tolist(), length.tolist(), strict=True) for p in range(a, a + n - 99)]
    assert own == [(i, p) for i, b in enumerate(segments) for p in range(len(b) - 99)]
