"""Ranked search by exact inner products, over ball trees of sparse document vectors.

A document's vector has one whole number for each term, weight times saturated
count; an item's vector counts its terms, so the inner product is the score.
A block of items is searched at a time, and vectors keep the block's terms only:
others never change a score of the block.

Every task puts its documents into trees of ``CHUNK``: a node is the ball of its
documents' centroid and radius. For an item the nodes are opened best first by
``item . centroid + |item| * radius``, rounded up by more than the error of doubles; a
node below the worst score still wanted is left out with all that it holds. Leaves
are scored in 64-bit integers. What is wanted starts with the best of a small draw of
documents, whose scores can only be too low, and rises as a task goes on.

Defined results: an item or document without a term (null, empty, punctuation) is in no
result. Rows of items that share an id are items of their own. Rows of documents that
share an id are ranked each for itself; a null id comes last among equal scores. Other
columns aren't read. Empty tables give no rows.
"""

from __future__ import annotations

import heapq
import math
from collections import Counter
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from clicklens.llm.common import materialize, small_batches

TOP = 20
# Bytes of item texts searched for in one pass; documents of a tree, of a leaf at most, and of the draw.
BLOCK, CHUNK, LEAF, DRAW = 1 << 18, 2048, 32, 20_000
# Dimensions in which documents are dealt to balls; the shape of a tree changes no result.
SKETCH, SALTS = 32, 64
NO_ID = 1 << 63
SCALE = 10**9

# ASCII letters are lowered; ASCII that is no letter or digit stands between terms.
_FOLD = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256))


def terms(text: str | None) -> list[bytes]:
    return text.encode().translate(_FOLD).split() if text else []


# -- vectors ----------------------------------------------------------------

def term_counts(docs: DataFrame, vocabulary: dict[bytes, int]) -> DataFrame:
    """(doc_id, text) -> doc_id, n (all terms with repeats), ids and counts of the vocabulary's terms."""
    schema = pa.schema([("doc_id", pa.int64()), ("n", pa.int64()), ("ids", pa.list_(pa.int32())), ("counts", pa.list_(pa.int32()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        get = vocabulary.get
        for part in batches:
            n, ids, counts = [], [], []
            for text in part.column(1).to_pylist():
                words = terms(text)
                held = Counter(map(get, words))
                held.pop(None, None)
                n.append(len(words))
                ids.append(list(held.keys()))
                counts.append(list(held.values()))
            yield pa.RecordBatch.from_arrays([part.column(0), *(pa.array(c, f.type) for c, f in zip((n, ids, counts), list(schema)[1:], strict=True))],
                                             schema=schema)

    return small_batches(docs).select(F.col("doc_id").cast("long"), "text").mapInArrow(
        run, "doc_id long, n long, ids array<int>, counts array<int>")


def weight(n_docs: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))


# -- trees ------------------------------------------------------------------

class BallTree:
    """Rows (ids, values) of one chunk as a balanced binary tree; node i has the children 2i+1 and 2i+2."""

    def __init__(self, sizes: np.ndarray, ids: np.ndarray, values: np.ndarray) -> None:
        self.n, self.depth = len(sizes), max(0, math.ceil(math.log2(max(1, len(sizes)) / LEAF)))
        self.terms, ids = np.unique(ids, return_inverse=True)
        sketch = self._sketch(sizes, ids, values)
        self.order, self.edges = np.arange(self.n), [np.array([0, self.n])]
        for _ in range(self.depth):
            self._split(sketch)
        begin = np.cumsum(sizes) - sizes
        size = sizes[self.order]
        at = np.repeat(begin[self.order] - (np.cumsum(size) - size), size) + np.arange(len(ids))
        self.ids, self.values = ids[at], values[at]
        self.row = np.append(np.cumsum(size) - size, len(ids))
        self._balls(size)

    def _sketch(self, sizes: np.ndarray, ids: np.ndarray, values: np.ndarray) -> np.ndarray:
        mixed = self.terms[ids].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(40)
        sign = np.where(mixed & np.uint64(1), 1.0, -1.0)
        at = np.repeat(np.arange(len(sizes)), sizes) * SKETCH + ((mixed >> np.uint64(1)) % np.uint64(SKETCH)).astype(np.int64)
        return np.bincount(at, sign * values, len(sizes) * SKETCH).reshape(-1, SKETCH)

    def _split(self, sketch: np.ndarray) -> None:
        """Each node's documents go to the nearer of two that are far apart; the cut is the widest gap near the middle."""
        edges = [0]
        for a, b in zip(self.edges[-1][:-1], self.edges[-1][1:], strict=True):
            own, cut = self.order[a:b], a + (b - a) // 2
            if len(own) > 1:
                points = sketch[own]
                one = points[np.argmax(np.square(points - points.mean(0)).sum(1))]
                from_one = np.square(points - one).sum(1)
                from_two = np.square(points - points[np.argmax(from_one)]).sum(1)
                nearer = from_one - from_two
                by = np.argsort(nearer, kind="stable")
                self.order[a:b] = own[by]
                low = (b - a) * 3 // 8
                gaps = np.diff(nearer[by])[low:max(low + 1, (b - a) * 5 // 8)]
                cut = a + low + 1 + int(np.argmax(gaps))
            edges += [cut, b]
        self.edges.append(np.array(edges))

    def _balls(self, size: np.ndarray) -> None:
        doc = np.repeat(np.arange(self.n), size)
        leaf = np.repeat(np.arange(1 << self.depth), np.diff(self.edges[-1]))
        width, values = len(self.terms), self.values.astype(np.float64)
        sums = [np.bincount(leaf[doc] * width + self.ids, values, (1 << self.depth) * width).reshape(-1, width)]
        while len(sums[0]) > 1:
            sums.insert(0, sums[0][::2] + sums[0][1::2])
        norm = np.bincount(doc, np.square(values), self.n)
        centroids, radii = [], []
        for level, total in enumerate(sums):
            count = np.diff(self.edges[level])
            centroid = total / np.maximum(count, 1)[:, None]
            node = np.repeat(np.arange(len(count)), count)
            dot = np.bincount(doc, values * centroid[node[doc], self.ids], self.n)
            own = np.square(centroid).sum(1)[node]
            # up to the rounding of sums of squares
            far = np.maximum(norm - 2 * dot + own, 0) + 1e-11 * (norm + own)
            radius = np.zeros(len(count))
            np.maximum.at(radius, node, np.sqrt(far))
            centroids.append(centroid)
            radii.append(radius)
        self.centroid, self.radius = np.concatenate(centroids), np.concatenate(radii)

    def bounds(self, at: np.ndarray, counts: np.ndarray, norm: float) -> np.ndarray:
        """No inner product in a node is above its bound."""
        return (self.centroid[:, at] @ counts + norm * self.radius) * (1 + 1e-9) + 1

    def search(self, item: tuple[np.ndarray, np.ndarray], best: Best, doc_ids: np.ndarray) -> int:
        """Offers ``best`` all documents that it may want; returns the leaves opened."""
        ids, counts = item
        at = np.minimum(np.searchsorted(self.terms, ids), len(self.terms) - 1)
        known = self.terms[at] == ids
        if not known.any():
            return 0
        bound = self.bounds(at[known], counts[known].astype(np.float64), float(np.sqrt(np.square(counts.astype(np.float64)).sum()))).tolist()
        dense = np.zeros(len(self.terms), np.int64)
        dense[at[known]] = counts[known]
        first, opened, queue = (1 << self.depth) - 1, 0, [(-bound[0], 0)]
        while queue:
            upper, node = heapq.heappop(queue)
            if -upper < best.least():
                break
            if node < first:
                for child in (2 * node + 1, 2 * node + 2):
                    if bound[child] >= best.least():
                        heapq.heappush(queue, (max(upper, -bound[child]), child))
                continue
            a, b = self.edges[-1][node - first], self.edges[-1][node - first + 1]
            if a == b:
                continue
            opened += 1
            lo, hi = self.row[a], self.row[b]
            scores = np.add.reduceat(dense[self.ids[lo:hi]] * self.values[lo:hi], self.row[a:b] - lo)
            hits = np.flatnonzero(scores >= best.least())
            best.offer(scores[hits].tolist(), doc_ids[self.order[a:b][hits]].tolist())
        return opened


class Best:
    """The ``k`` best (score, lesser id first) so far; nothing below ``floor``."""

    def __init__(self, k: int, floor: int) -> None:
        self.k, self.floor, self.heap = k, max(1, floor), []

    def least(self) -> int:
        """The least score that could still be kept."""
        return max(self.floor, self.heap[0][0]) if len(self.heap) == self.k else self.floor

    def offer(self, scores: list[int], ids: list[int]) -> None:
        for entry in zip(scores, (-i for i in ids), strict=True):
            if len(self.heap) < self.k:
                heapq.heappush(self.heap, entry)
            elif entry > self.heap[0]:
                heapq.heapreplace(self.heap, entry)


def best_documents(vectors: DataFrame, items: list[tuple[np.ndarray, np.ndarray]], weights: np.ndarray, n_docs: int, total: int,
                   floors: list[int], k: int) -> DataFrame:
    """Every task's k best documents for each item -> item (its place), doc_id, score."""
    def chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
        held: list[pa.RecordBatch] = []
        for part in batches:
            held.append(part)
            if sum(p.num_rows for p in held) >= CHUNK:
                yield pa.Table.from_batches(held).combine_chunks()
                held = []
        if held:
            yield pa.Table.from_batches(held).combine_chunks()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = [Best(k, f) for f in floors]
        for part in chunks(batches):
            if not part.num_rows:
                continue
            n, ids, counts = (part.column(c).combine_chunks() for c in ("n", "ids", "counts"))
            doc_ids = np.array([NO_ID if i is None else i for i in part.column("doc_id").to_pylist()], object)
            sizes = np.diff(ids.offsets.to_numpy().astype(np.int64))
            # 100 is a document of average length
            m = np.repeat(100 - 25 + 25 * n.to_numpy() * n_docs // total, sizes)
            flat, tf = ids.flatten().to_numpy(), counts.flatten().to_numpy().astype(np.int64)
            tree = BallTree(sizes, flat, weights[flat] * (SCALE * tf // (1000 * tf + 12 * m)))
            for item, wanted in zip(items, best, strict=True):
                tree.search(item, wanted, doc_ids)
        rows = [(i, None if d == -NO_ID else -d, s) for i, b in enumerate(best) for s, d in b.heap]
        columns = zip(*rows, strict=True) if rows else [[]] * 3
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.int32(), pa.int64(), pa.int64()), strict=True)], ["item", "doc_id", "score"])

    return small_batches(vectors).select("doc_id", "n", "ids", "counts").mapInArrow(run, "item int, doc_id long, score long")


# -- search -----------------------------------------------------------------

def _ranked(found: DataFrame, k: int) -> DataFrame:
    """The k best of each item; first within salts, so that no task ranks what all tasks found."""
    order = [F.desc("score"), F.asc_nulls_last("doc_id")]
    salted = found.withColumn("salt", F.pmod(F.xxhash64("doc_id"), F.lit(SALTS)))
    some = salted.withColumn("rank", F.row_number().over(Window.partitionBy("item", "salt").orderBy(*order))).where(F.col("rank") <= k)
    return some.withColumn("rank", F.row_number().over(Window.partitionBy("item").orderBy(*order))).where(F.col("rank") <= k).drop("salt")


def _search_block(docs: DataFrame, texts: list[str], k: int) -> DataFrame:
    """The k best documents of each text -> item (its place), rank, doc_id, score."""
    held = [Counter(terms(t)) for t in texts]
    vocabulary = {t: i for i, t in enumerate(sorted(set().union(*held)))}
    items = [tuple(np.array(sorted((vocabulary[t], c) for t, c in h.items()), np.int64).reshape(-1, 2).T) for h in held]
    counts = materialize(term_counts(docs, vocabulary), "ball-counts")
    n_docs, total, with_terms = counts.agg(F.count_if(F.col("n") > 0), F.coalesce(F.sum("n"), F.lit(0)), F.count_if(F.size("ids") > 0)).first()
    df = np.zeros(len(vocabulary), np.int64)
    for row in counts.select(F.explode("ids").alias("id")).groupBy("id").count().collect():  # at most the block's terms
        df[row.id] = row["count"]
    weights = np.array([weight(n_docs, int(d)) for d in df], np.int64)
    vectors, floors, total = counts.where(F.size("ids") > 0), [0] * len(texts), max(1, total)
    share = DRAW / max(1, with_terms)
    if share < 1:
        drawn = vectors.where(F.pmod(F.xxhash64("doc_id", "n"), F.lit(1 << 30)) < int(share * (1 << 30)) + 1)
        low = _ranked(best_documents(drawn, items, weights, n_docs, total, floors, k), k).where(F.col("rank") == k)
        for row in low.collect():  # a row an item
            floors[row.item] = row.score
    return _ranked(best_documents(vectors, items, weights, n_docs, total, floors, k), k)


def search(items: DataFrame, docs: DataFrame, k: int = TOP) -> DataFrame:
    """(item_id, text) and (doc_id, text) -> item_id, rank, doc_id, score."""
    spark = docs.sparkSession
    rows = items.select("item_id", "text").where("text is not null")
    texts = materialize(rows.select("text").distinct(), "ball-items")
    size = texts.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    blocks, found = -(-size // BLOCK), []
    for block in range(blocks):
        own = [r.text for r in texts.where(F.pmod(F.xxhash64("text"), F.lit(blocks)) == block).collect() if terms(r.text)]
        if own:
            names = spark.createDataFrame(list(enumerate(own)), "item int, text string")
            found.append(materialize(_search_block(docs, own, k).join(F.broadcast(names), "item").select("text", "rank", "doc_id", "score"), "ball-found"))
    if not found:
        return spark.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    return rows.join(reduce(DataFrame.union, found), "text").select("item_id", "rank", "doc_id", "score")


def query(items: DataFrame, docs: DataFrame) -> DataFrame:
    return search(items, docs)


_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_TERMS = rf"regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_UPPER.lower()}'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"

ORACLE = f"""
WITH d AS (SELECT row_number() OVER () AS d, doc_id, {_TERMS} AS ts FROM documents),
     i AS (SELECT row_number() OVER () AS i, item_id, {_TERMS} AS ts FROM benchmark),
     q AS (SELECT i, item_id, t, count(*) AS c FROM (SELECT i, item_id, unnest(ts) AS t FROM i) GROUP BY ALL),
     tot AS (SELECT count(*) FILTER (len(ts) > 0) AS n_docs, sum(len(ts))::BIGINT AS total FROM d),
     tf AS (SELECT d, doc_id, n, t, count(*) AS tf
            FROM (SELECT d, doc_id, len(ts) AS n, unnest(ts) AS t FROM d) WHERE t IN (SELECT t FROM q) GROUP BY ALL),
     w AS (SELECT t, floor(1000 * ln((2 * n_docs + 2)::DOUBLE / (2 * count(*) + 1)))::BIGINT AS w FROM tf, tot GROUP BY t, n_docs),
     v AS (SELECT d, doc_id, t, w * ((1000000000 * tf) // (1000 * tf + 12 * (100 - 25 + (25 * n * n_docs) // total))) AS v
           FROM tf JOIN w USING (t), tot),
     s AS (SELECT i, item_id, d, doc_id, sum(c * v)::BIGINT AS score FROM q JOIN v USING (t) GROUP BY ALL)
SELECT item_id, rank, doc_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY i ORDER BY score DESC, doc_id NULLS LAST)::INT AS rank FROM s WHERE score > 0)
WHERE rank <= 20
"""
