"""SimHash near-dedup against a plain version over all pairs."""

import random

import numpy as np
import pytest
import xxhash

from clicklens.llm import simhash_bk as S
from clicklens.llm.components import connected_components

SCHEMA = "doc_id long, text string"


def plain_fingerprint(text, k=3):
    import re
    words = re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    grams = [" ".join(words[i:i + k]) for i in range(len(words) - k + 1)] or ([" ".join(words)] if words else [])
    h = [xxhash.xxh64(g.encode(), seed=42).intdigest() for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def plain_components(ids, values, radius):
    label = list(ids)
    changed = True
    while changed:
        changed = False
        for i, a in enumerate(values):
            for j, b in enumerate(values):
                if (a ^ b).bit_count() <= radius and label[j] < label[i]:
                    label[i], changed = label[j], True
    return label


def near_values(n, seed=5):
    rng = random.Random(seed)
    base = [rng.getrandbits(64) for _ in range(6)]
    out = []
    for _ in range(n):
        v = rng.choice(base) if rng.random() < 0.7 else rng.getrandbits(64)
        for _ in range(rng.randint(0, 5)):
            v ^= 1 << rng.randrange(64)
        out.append(v)
    return out


TEXTS = ["The cat sat on a mat", "the CAT sat on\ta mat", "", None, "one", "one two", " \n ", "É É É é", "x " * 9000, "a b c d"]


@pytest.mark.parametrize("text", TEXTS)
def test_fingerprint(text):
    assert S.fingerprint_of(text) == plain_fingerprint(text)


@pytest.mark.parametrize(("tile", "shard"), [(7, 2048), (8192, 2048), (8192, 20), (5, 2)])
def test_links_reach_all_pairs(spark, tile, shard):
    values = sorted(set(near_values(300)))
    signed = [v - ((v >> 63) << 64) for v in values]
    links = S.fingerprint_links(spark.createDataFrame([(v,) for v in signed], "fingerprint long"), 2, tile, shard)
    for a, b in [(r.src, r.dst) for r in links.collect()]:
        assert ((a ^ b) & ((1 << 64) - 1)).bit_count() <= 2
    found = {r.node: r.component for r in connected_components(links).collect()}
    want = plain_components(signed, values, 2)
    assert [found.get(v, v) for v in signed] == want


def plain_visits(values, query, radius):
    """Found values and visited nodes of a tree of dictionaries, built by inserting one by one."""
    root = [values[0], {}]
    for v in values[1:]:
        node = root
        while (d := (node[0] ^ v).bit_count()) in node[1]:
            node = node[1][d]
        node[1][d] = [v, {}]
    todo, found, visited = [root], [], 0
    while todo:
        at, children = todo.pop()
        visited += 1
        d = (at ^ query).bit_count()
        found += [at] if d <= radius else []
        todo += [c for k, c in children.items() if abs(k - d) <= radius]
    return sorted(found), visited


@pytest.mark.parametrize("radius", [0, 2, 5])
def test_bk_tree_follows_only_near_edges(radius):
    values = list(dict.fromkeys(near_values(400, 9)))
    tree = S.BKTree(np.array(values, np.uint64))
    for q in values[:40] + [0, (1 << 64) - 1]:
        _, nodes, visited = tree.within(np.array([q], np.uint64), radius)
        found, want = plain_visits(values, q, radius)
        assert sorted(tree.values[nodes].tolist()) == found == sorted(v for v in values if (v ^ q).bit_count() <= radius)
        assert visited == want <= len(values)
    at, nodes, _ = tree.within(np.array(values, np.uint64), radius)
    assert len(at) == sum((a ^ b).bit_count() <= radius for a in values for b in values)
    assert len(S.BKTree(np.array([], np.uint64)).within(np.array(values, np.uint64), 2)[0]) == 0


def test_shards_hold_whole_trees():
    assert [S.shard_bits(n, 2, 2048) for n in (0, 1, 2048, 2049, 4096, 4097, 10**6, 10**12)] == [0, 0, 0, 1, 1, 2, 9, 21]


def test_query_and_filter(spark):
    rows = [(9, "a b c d"), (4, "A b C d"), (7, None), (8, ""), (11, "  "), (4, "A b C d"), (20, "quite another text here"), (None, "a b c d")]
    docs = spark.createDataFrame([(*r, "x", 1) for r in rows], SCHEMA + ", fingerprint string, node int")
    got = sorted((r.doc_id or -1, r.fingerprint, r.component_id) for r in S.query(docs).collect())
    fp = lambda t: f"{plain_fingerprint(t):016x}"
    abcd, other, zero = fp("a b c d"), fp("quite another text here"), "0" * 16
    assert got == [(-1, abcd, 4), (4, abcd, 4), (4, abcd, 4), (7, zero, 7), (8, zero, 7), (9, abcd, 4), (11, zero, 7), (20, other, 20)]
    kept = S.drop_near_duplicates(docs)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id or -1 for r in kept.collect()) == [-1, 4, 7, 20]
    assert S.query(docs.where("false")).count() == S.drop_near_duplicates(docs.where("false")).count() == 0


def test_components_of_chains_and_stars(spark):
    edges = [(i, i + 1) for i in range(60)] + [(1000, i) for i in range(1001, 1100)] + [(5, 5), (None, 3), (2000, None)]
    found = {r.node: r.component for r in connected_components(spark.createDataFrame(edges, "src long, dst long")).collect()}
    assert found == {**{i: 0 for i in range(61)}, **{i: 1000 for i in range(1000, 1100)}}
    assert connected_components(spark.createDataFrame([], "src long, dst long")).count() == 0
