"""Decontamination against a plain scan of all alignments, and its plan."""

import itertools
import math
import random
import re
from collections import Counter, defaultdict

import duckdb
import pyarrow as pa
import pytest

from clicklens.llm import decontam as D


def plain(docs, items):
    words = lambda t: re.findall(r"[^\W_]+", (t or "").lower())
    out = {}
    for d, t in docs:
        w = words(t)
        where = defaultdict(list)
        for p, x in enumerate(w):
            where[x].append(p)
        for i, u in items:
            a = words(u)
            if i is None or not a:
                continue
            width = min(13, len(a))
            for g, n in Counter(p - j for j, x in enumerate(a) for p in where[x]).items():
                if n < 0.8 * width:
                    continue
                same = [0 <= g + j < len(w) and w[g + j] == x for j, x in enumerate(a)]
                best = max(sum(same[s:s + width]) for s in range(len(a) - width + 1))
                if best >= 0.8 * width:
                    out[d, i] = max(out.get((d, i), (0,)), (best / width, sum(same), -g))
    return sorted((d if d is not None else -1, i, -g, n, s) for (d, i), (s, n, g) in out.items())


def cases():
    rng = random.Random(2)
    w = lambda n: [rng.choice("the of and a tree house green river stone cloud paper light".split()) + rng.choice(["", "s", "ly"]) for _ in range(n)]
    items = [(i, " ".join(w(n))) for i, n in enumerate([5, 6, 9, 10, 13, 14, 20, 40])] + [(90, None), (91, ""), (92, "one two three"), (None, "q " * 20)]
    docs = []
    for i, (_, t) in enumerate(items[:8]):
        a = t.split()
        for k in range(3):
            b = a[:]
            for p in rng.sample(range(len(b)), min(len(b), k * len(b) // 5)):
                b[p] = "changed"
            docs.append((100 + 10 * i + k, " ".join(w(7) + b + w(5)).replace(" the", ", THE")))
    docs += [(1, " ".join(w(300))), (2, None), (3, ""), (4, items[7][1][10:]), (5, " ".join(items[7][1].split()[20:])), (1, items[6][1]), (None, items[6][1])]
    return docs, items


@pytest.mark.parametrize("limit", [0, 1_000_000])
def test_overlaps(spark, limit):
    docs, items = cases()
    d = spark.createDataFrame([(*r, 1, "x") for r in docs], "doc_id long, text string, item_id int, w string")
    b = spark.createDataFrame([(*r, 2) for r in items], "item_id long, text string, doc_id int")
    got = D.overlaps(d, b, broadcast_seeds=limit)
    assert sorted((r.doc_id if r.doc_id is not None else -1, r.item_id, r.word_pos, r.n_same, r.similarity) for r in got.collect()) == plain(docs, items)


@pytest.mark.parametrize("n", range(1, 15))
def test_every_pattern_of_changes_is_found(spark, n):
    """All ways to change words of an item of n words that leave 0.8 of them: each is proposed by a seed."""
    most = n - math.ceil(0.8 * n)
    a = [f"w{i}" for i in range(n)]
    texts = [["x" if i in gone else x for i, x in enumerate(a)] for k in range(most + 2) for gone in itertools.combinations(range(n), min(k, n))]
    docs = [(i, "begin " + " ".join(t) + " end") for i, t in enumerate(texts)]
    got = D.overlaps(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame([(1, " ".join(a))], "item_id long, text string"))
    want = plain(docs, [(1, " ".join(a))])
    assert sorted((r.doc_id, r.item_id, r.word_pos, r.n_same, r.similarity) for r in got.collect()) == want
    assert len(want) >= sum(math.comb(n, k) for k in range(most + 1))


def test_very_long_text_and_sql(spark):
    docs = [(1, "filler " * 60_000 + "Four words, in all! " + "filler " * 60_000), (2, "four words in Paris"), (3, "a b c d x"), (4, "one")]
    items = [(1, "four words in all"), (2, "a b c d e"), (3, "one"), (4, "!"), (5, "k l m n X o p q r s")]
    docs.append((5, "k l m n Y Z p q r s"))
    d, b = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    con = duckdb.connect()
    for name, rows in (("documents", docs), ("benchmark", items)):
        con.register(name, pa.table({("doc_id" if name == "documents" else "item_id"): [r[0] for r in rows], "text": [r[1] for r in rows]}))
    got = sorted(tuple(r) for r in D.query(d, b).collect())
    assert got == sorted(con.execute(D.ORACLE).fetchall())
    assert [r[:2] for r in got] == [(1, 1), (3, 2), (4, 3), (5, 5)]


def test_filter(spark):
    docs, items = cases()
    d = spark.createDataFrame([(*r, "x") for r in docs], "doc_id long, text string, bad_id string")
    b = spark.createDataFrame(items, "item_id long, text string")
    bad = {x[0] for x in plain(docs, items)}
    kept = D.drop_contaminated(d, b)
    assert kept.columns == d.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted(x for x, _ in docs if x not in bad and x is not None)
    assert D.overlaps(d.where("false"), b).count() == D.overlaps(d, b.where("false")).count() == 0
    assert D.drop_contaminated(d, b.where("false")).count() == len(docs)


def test_plan_is_native(spark):
    docs, items = cases()
    plan = D.overlaps(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"))
    text = plan._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow", text.split("== Physical Plan ==")[1])
