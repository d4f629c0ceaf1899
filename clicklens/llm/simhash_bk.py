"""SimHash near-duplicates, searched with BK-trees.

A fingerprint is the bitwise majority of the XXH64 of all word shingles. Only
distinct fingerprints are searched. They are dealt to shards of about ``SHARD``
fingerprints: r+1 groups of b bits each are set apart, b being the number of bits
that brings n fingerprints down to that size (none for a small table, which is one
tree). Two fingerprints that differ in at most r bits agree in one group at least,
so every pair within the radius meets in a shard, at every size. A shard is one
BK-tree (children keyed by their integer Hamming distance to the parent), and each
of its fingerprints walks it along the edges whose key lies within the radius of its
distance to the node. Trees are arrays and all queries of a block walk in step.

Fingerprints grow with the input, so no tree is sent through the driver: a shard
above ``TILE`` fingerprints is cut into trees and query blocks, and each tree is sent
to every block of that shard by the shuffle, so a hot shard is spread over tasks and
no tree exceeds its bound. A tile gives a spanning forest of its links (at most one
link for each fingerprint), never all pairs.

Defined results: null text, empty text and white space have no words and the
fingerprint zero, linked like any other. Repeated ids are rows of their own.
Null ids get a component like other rows but never name one. Extra columns pass
through ``with_fingerprint``. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clicklens.llm.common import materialize, small_batches
from clicklens.llm.components import connected_components

SEED = 42
# Fingerprints that a shard should hold, and above which it is cut into tiles; results depend on neither.
SHARD, TILE = 4096, 16384
_QUERIES = 256
_CHUNK = 1 << 16


def fingerprint_of(text: str | None, shingle: int = 3) -> int:
    """Unsigned 64-bit fingerprint of a text."""
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    k = min(shingle, len(words))
    n = len(words) - k + 1
    starts, ends = starts[:n].tolist(), ends[k - 1:].tolist()
    ones = np.zeros(64, np.int64)
    digest = xxhash.xxh64_intdigest
    for at in range(0, n, _CHUNK):
        h = np.array([digest(joined[a:b], SEED) for a, b in
                      zip(starts[at:at + _CHUNK], ends[at:at + _CHUNK], strict=True)], "<u8")
        bits = np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > n, bitorder="little").tobytes(), "little")


def with_fingerprint(docs: DataFrame, shingle: int = 3, text: str = "text") -> DataFrame:
    """Adds ``fingerprint``: the 64 bits as a signed long."""
    @F.pandas_udf("long")
    def simhash(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for s in batches:
            bits = np.array([fingerprint_of(t, shingle) for t in s], np.uint64)
            yield pd.Series(bits.view(np.int64))

    return small_batches(docs).withColumn("fingerprint", simhash(F.col(text)))


class BKTree:
    """Distinct 64-bit values as a tree of arrays: ``child[i, d]`` is the child of node i at distance d, or -1.

    Node i holds ``values[i]``. The tree is the one that inserting the values in their
    order gives: of the values that arrive at a free place together, the first takes it.
    """

    def __init__(self, values: np.ndarray) -> None:
        self.values = np.asarray(values, np.uint64)
        self.child = np.full((len(self.values), 65), -1, np.int32)
        waiting = np.arange(1, len(self.values))
        at = np.zeros(len(waiting), np.int64)
        while len(waiting):
            place = at * 65 + np.bitwise_count(self.values[at] ^ self.values[waiting])
            places, first = np.unique(place, return_index=True)
            self.child.reshape(-1)[places] = waiting[first]
            left = np.ones(len(waiting), bool)
            left[first] = False
            at, waiting = self.child.reshape(-1)[place[left]].astype(np.int64), waiting[left]

    def within(self, queries: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray, int]:
        """(query, node) numbers of all pairs within the radius, and how many nodes were visited."""
        queries = np.asarray(queries, np.uint64)
        found_q, found_n, visited = [], [], 0
        steps = np.arange(-radius, radius + 1)
        for begin in range(0, len(queries) if len(self.values) else 0, _QUERIES):
            q = np.arange(begin, min(begin + _QUERIES, len(queries)))
            node = np.zeros(len(q), np.int64)
            while len(q):
                visited += len(q)
                d = np.bitwise_count(queries[q] ^ self.values[node]).astype(np.int64)
                hit = d <= radius
                found_q.append(q[hit])
                found_n.append(node[hit])
                keys = d[:, None] + steps
                after = self.child[node[:, None], np.clip(keys, 0, 64)]
                row, col = np.nonzero((after >= 0) & (keys > 0) & (keys <= 64))
                q, node = q[row], after[row, col].astype(np.int64)
        if not found_q:
            return np.empty(0, np.int64), np.empty(0, np.int64), visited
        return np.concatenate(found_q), np.concatenate(found_n), visited


def tile_links(tree_values: np.ndarray, queries: np.ndarray, radius: int) -> list[tuple[int, int]]:
    """A spanning forest of the links between queries and tree values."""
    tree = BKTree(tree_values)
    at, node, _ = tree.within(queries, radius)
    a, b = np.asarray(queries, np.uint64)[at], tree.values[node]
    other = a != b
    parent: dict[int, int] = {}

    def root(x: int) -> int:
        while (p := parent.get(x, x)) != x:
            parent[x] = parent.get(p, p)
            x = p
        return x

    out = []
    for q, v in zip(a[other].tolist(), b[other].tolist(), strict=True):
        x, y = root(q), root(v)
        if x != y:
            parent[max(x, y)] = min(x, y)
            out.append((q, v))
    return out


def shard_bits(n: int, radius: int, shard: int = SHARD) -> int:
    """Bits of a group so that n fingerprints make shards of at most about ``shard``."""
    return min(max(0, (max(n - 1, 0) // shard).bit_length()), 64 // (radius + 1))


def _shard_keys(fp: Column, radius: int, bits: int) -> Column:
    """One (group, its bits) entry for each group; with no bits all share one shard."""
    if not bits:
        return F.array(F.struct(F.lit(0).alias("c"), F.lit(0).cast("long").alias("key")))
    width = 64 // (radius + 1)
    return F.array(*(F.struct(F.lit(g).alias("c"), F.shiftrightunsigned(fp, g * width).bitwiseAND(F.lit((1 << bits) - 1).cast("long")).alias("key"))
                     for g in range(radius + 1)))


def fingerprint_links(fps: DataFrame, radius: int = 2, tile: int = TILE, shard: int = SHARD) -> DataFrame:
    """Distinct ``fingerprint`` rows -> (src, dst) links whose components are those of all links."""
    bits = shard_bits(fps.count(), radius, shard)
    dealt = (fps.select("fingerprint", F.explode(_shard_keys(F.col("fingerprint"), radius, bits)).alias("b"))
             .select("b.c", "b.key", "fingerprint"))
    sizes = (dealt.groupBy("c", "key").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
             .select("c", "key", F.ceil(F.col("n") / tile).cast("int").alias("k")))
    dealt = dealt.join(sizes, ["c", "key"])
    own = F.pmod(F.xxhash64("fingerprint"), F.col("k")).cast("int")
    upto = F.sequence(F.lit(0), F.col("k") - 1)
    # role 0: in the tree of shard i, sent to every block j; role 1: a query of block j
    in_tree = dealt.select("c", "key", own.alias("i"), F.explode(upto).alias("j"), F.lit(0).alias("role"), "fingerprint")
    as_query = dealt.where("k > 1").select("c", "key", F.explode(upto).alias("i"), own.alias("j"),
                                           F.lit(1).alias("role"), "fingerprint")
    tiles = in_tree.union(as_query)
    keys = ["c", "key", "i", "j"]

    def search(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        def links(part: pd.DataFrame) -> pd.DataFrame:
            cols = [part[k].to_numpy() for k in keys]
            new = np.ones(len(part), bool)
            new[1:] = np.logical_or.reduce([c[1:] != c[:-1] for c in cols])
            cuts = [*np.flatnonzero(new).tolist(), len(part)]
            fp, role = part["fingerprint"].to_numpy().view(np.uint64), part["role"].to_numpy()
            found: list[tuple[int, int]] = []
            for a, b in zip(cuts[:-1], cuts[1:], strict=True):
                mid = a + int((role[a:b] == 0).sum())
                found += tile_links(fp[a:mid], fp[mid:b] if mid < b else fp[a:mid], radius)
            pairs = np.array(found, np.uint64).reshape(-1, 2).view(np.int64)
            return pd.DataFrame({"src": pairs[:, 0], "dst": pairs[:, 1]})

        rest = None
        for part in batches:
            part = part if rest is None else pd.concat([rest, part], ignore_index=True)
            if not len(part):
                continue
            last = np.logical_and.reduce([part[k].to_numpy() == part[k].iloc[-1] for k in keys])
            cut = int(np.argmax(last))  # rows are sorted: the last tile may go on in the next batch
            rest = part.iloc[cut:]
            if cut:
                yield links(part.iloc[:cut].reset_index(drop=True))
        if rest is not None:
            yield links(rest.reset_index(drop=True))

    return (tiles.repartition(*keys).sortWithinPartitions(*keys, "role", "fingerprint")
            .mapInPandas(search, "src long, dst long"))


def simhash_components(docs: DataFrame, shingle: int = 3, radius: int = 2) -> DataFrame:
    """(doc_id, fingerprint long, component_id): the smallest doc_id reachable over links."""
    rows = materialize(with_fingerprint(docs.select("doc_id", "text"), shingle).select("doc_id", "fingerprint"), "simhash")
    distinct = materialize(rows.groupBy("fingerprint").agg(F.min("doc_id").alias("first_id")), "simhash-distinct")
    comps = connected_components(fingerprint_links(distinct, radius))
    roots = (distinct.join(comps, distinct.fingerprint == comps.node, "left")
             .select("fingerprint", "first_id", F.coalesce("component", "fingerprint").alias("root")))
    # only roots with several fingerprints need the smallest id of the others
    named = roots.groupBy("root").agg(F.min("first_id").alias("component_id"))
    names = roots.join(named, "root").select("fingerprint", "component_id")
    return rows.join(names, "fingerprint").select("doc_id", "fingerprint", "component_id")


def query(docs: DataFrame, shingle: int = 3, radius: int = 2) -> DataFrame:
    return simhash_components(docs, shingle, radius).select(
        "doc_id", F.lower(F.lpad(F.hex("fingerprint"), 16, "0")).alias("fingerprint"), "component_id")


def drop_near_duplicates(docs: DataFrame, shingle: int = 3, radius: int = 2) -> DataFrame:
    """Keeps, of each component, the row of the smallest doc_id; of rows that
    repeat that id, one. Rows without an id can't be named as a copy and stay."""
    comps = simhash_components(docs, shingle, radius)
    kept = comps.where("doc_id = component_id").select(F.col("doc_id").alias("_kept_id")).distinct()
    named = docs.join(kept, F.col("doc_id") == F.col("_kept_id"), "left_semi").dropDuplicates(["doc_id"])
    return named.unionByName(docs.where("doc_id IS NULL"))
