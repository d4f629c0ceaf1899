"""Benchmark decontamination with spaced seeds; DataFrame functions only.

Words are lower-cased runs of letters and digits. A seed is a mask of some word
positions; the others are ignored. Training texts and benchmark items are hashed
under every mask; equal hashes propose an alignment (item, offset in the text), which
is verified word by word. An alignment is an overlap if some ``SPAN`` consecutive words
of the item (all of a shorter item) agree with the text at ``SIMILARITY`` of their
positions or more.

No overlap is lost, whatever the item's length. Of ``SPAN`` words at most 2 differ, so
the other 11 stand in at most three runs; two neighbouring runs hold five words, which
one of the masks of five fits. Of five to twelve words at most 2 differ (1 below ten):
two neighbouring runs hold four words, or one run does, which a mask of four fits. Of
one to four words none may differ, and the whole item is its seed. Each item is hashed
under the masks of its length, and texts only under masks that some item has.

Plan: the text scan, the split, the position and mask generators, the hash and
the probe of the seed table are one code-generated stage; only verified candidates
are shuffled. The seed table is broadcast if it has at most ``BROADCAST_SEEDS`` rows;
a larger one is joined by shuffling (id, offset, hash), never the texts' words.

Defined results: null or empty texts overlap with nothing; neither do null items and
items without a word. Rows that share a doc_id are reported under that id once. A null
doc_id is reported as null. Repeated words, ties and very long texts need no special
case. Other columns are ignored by the search and pass through the filter.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SPAN = 13
# (fewest and most words of an item, its masks)
MASKS = (
    (SPAN, 1 << 31, ((0, 1, 2, 3, 4), (0, 2, 3, 4, 5), (0, 1, 3, 4, 5), (0, 1, 2, 4, 5), (0, 1, 2, 3, 5))),
    (5, SPAN - 1, ((0, 1, 2, 3), (0, 2, 3, 4), (0, 1, 3, 4), (0, 1, 2, 4))),
    (4, 4, ((0, 1, 2, 3),)),
    (3, 3, ((0, 1, 2),)),
    (2, 2, ((0, 1),)),
    (1, 1, ((0,),)),
)
SIMILARITY = 0.8
# Three numbers a row: 64 MB at most.
BROADCAST_SEEDS = 1_000_000


def words(text: str) -> Column:
    return F.array_remove(F.split(F.lower(F.col(text)), r"[^\p{L}\p{N}]+"), "")


def _seeds(at: Column, masks: list[tuple[int, ...]]) -> Column:
    """Hashes of all masks at a 0-based position; null where a mask runs over the end."""
    w = F.col("w")
    out = [F.when(at + offsets[-1] < F.size(w), F.xxhash64(F.lit(str(offsets)), *[F.get(w, at + o) for o in offsets])) for offsets in masks]
    return F.array(*out)


def _positions(rows: DataFrame, keep: list[str], masks: list[tuple[int, ...]]) -> DataFrame:
    """One row for each position and mask: ``keep``, p, h."""
    # the outer form: the plain one adds a filter that would split every text once more
    at = rows.select(*keep, "w", F.posexplode_outer("w").alias("p", "_word"))
    return at.select(*keep, "w", "p", F.explode(_seeds(F.col("p"), masks)).alias("h")).where("h IS NOT NULL")


def _item_seeds(items: DataFrame) -> tuple[DataFrame, list[tuple[int, ...]]]:
    """(item_id, q, n, h) of all items, and the masks that they use."""
    n = F.size("w")
    counts = items.agg(*[F.count_if(n.between(low, high)).alias(f"n{low}") for low, high, _ in MASKS]).first()
    used = [(low, high, masks) for (low, high, masks), count in zip(MASKS, counts, strict=True) if count]
    parts = [_positions(items.where(n.between(low, high)), ["item_id"], list(masks)) for low, high, masks in used or MASKS[:1]]
    seeds = reduce(DataFrame.union, [p.select("item_id", F.col("p").alias("q"), n.alias("n"), "h") for p in parts])
    return seeds.distinct(), sorted({m for _, _, masks in used or MASKS[:1] for m in masks})


def candidates(docs: DataFrame, items: DataFrame, broadcast_seeds: int = BROADCAST_SEEDS) -> DataFrame:
    """(doc_id, item_id, diag, part): the aligned words of the text, from word max(diag, 0) on."""
    texts = docs.where("text IS NOT NULL").select("doc_id", words("text").alias("w"))
    seeds, masks = _item_seeds(items)
    part = F.slice("w", F.greatest(F.col("diag"), F.lit(0)) + 1,
                   F.greatest(F.col("n") + F.least(F.col("diag"), F.lit(0)), F.lit(0)))
    keys = ["doc_id", "item_id", "diag"]
    if seeds.count() <= broadcast_seeds:
        hits = _positions(texts, ["doc_id"], masks).join(F.broadcast(seeds), "h")
        return (hits.withColumn("diag", F.col("p") - F.col("q"))
                .select(*keys, part.alias("part")).distinct())
    hits = (_positions(texts, ["doc_id"], masks).select("doc_id", "p", "h").join(seeds, "h")
            .select("doc_id", "item_id", (F.col("p") - F.col("q")).alias("diag"), "n").distinct())
    found = hits.withColumnRenamed("doc_id", "hit_id")
    return (texts.join(found, F.col("doc_id").eqNullSafe(F.col("hit_id")))
            .select(*keys, part.alias("part")).distinct())


def overlaps(docs: DataFrame, benchmark: DataFrame, span: int = SPAN, similarity: float = SIMILARITY,
             broadcast_seeds: int = BROADCAST_SEEDS) -> DataFrame:
    """One row for each document and item that overlap: the best alignment.

    ``word_pos``: word of the text where the item's first word falls (negative if
    the text begins inside the item); ``n_same``: item words that agree there;
    ``similarity``: share that agrees in the best ``span`` words.
    """
    items = benchmark.where("text IS NOT NULL").select("item_id", words("text").alias("w")).where(F.size("w") > 0)
    found = candidates(docs, items, broadcast_seeds)
    shift = F.greatest(-F.col("diag"), F.lit(0))
    same = F.transform("w", lambda x, j: F.coalesce(F.get("part", F.when(j >= shift, j - shift).otherwise(-1)) == x, F.lit(False)).cast("int"))
    checked = (found.join(items, "item_id").withColumn("same", same)
               .withColumn("width", F.least(F.size("w"), F.lit(span)))
               .withColumn("best", F.array_max(F.transform(
                   F.sequence(F.lit(1), F.size("w") - F.col("width") + 1),
                   lambda s: F.aggregate(F.slice("same", s, F.col("width")), F.lit(0), lambda a, b: a + b))))
               .where(F.col("best") >= F.lit(similarity) * F.col("width")))
    total = F.aggregate("same", F.lit(0), lambda a, b: a + b)
    top = checked.groupBy("doc_id", "item_id").agg(F.max(F.struct(
        (F.col("best") / F.col("width")).alias("similarity"), total.alias("n_same"), (-F.col("diag")).alias("before"),
        F.size("w").alias("n_words"))).alias("t"))
    return top.select("doc_id", "item_id", (-F.col("t.before")).alias("word_pos"), "t.n_words", "t.n_same", "t.similarity")


def query(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    return overlaps(docs, benchmark)


def drop_contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows whose id has no overlap with any item."""
    bad = overlaps(docs, benchmark).select(F.col("doc_id").alias("_overlap_id")).distinct()
    return docs.join(bad, F.col("doc_id").eqNullSafe(F.col("_overlap_id")), "left_anti")


def _sql() -> str:
    # every alignment with an equal word, if enough words agree for any window to
    hits = (f"SELECT d.doc_id, i.item_id, d.p - i.p AS diag FROM dw d JOIN iw i USING (word) JOIN size USING (item_id) "
            f"GROUP BY d.doc_id, i.item_id, d.p - i.p, size.width HAVING count(*) >= {SIMILARITY} * size.width")
    split = ("SELECT {0}, unnest(w) AS word, generate_subscripts(w, 1) AS p FROM (SELECT {0}, list_filter(regexp_split_to_array("
             "lower(text), '[^\\p{{L}}\\p{{N}}]+'), lambda x: x <> '') AS w FROM {1} WHERE text IS NOT NULL)")
    return f"""
WITH dw AS ({split.format("doc_id", "documents")}), iw AS ({split.format("item_id", "benchmark")}),
size AS (SELECT item_id, count(*) AS n_words, least(count(*), {SPAN}) AS width FROM iw GROUP BY item_id),
hits AS ({hits}),
same AS (SELECT h.doc_id, h.item_id, h.diag, i.p, CASE WHEN d.word = i.word THEN 1 ELSE 0 END AS same
  FROM hits h JOIN iw i ON i.item_id = h.item_id LEFT JOIN dw d ON d.doc_id = h.doc_id AND d.p = h.diag + i.p),
frames AS (SELECT s.*, sum(same) OVER (PARTITION BY doc_id, item_id, diag ORDER BY p ROWS BETWEEN {SPAN - 1} PRECEDING AND CURRENT ROW) AS best FROM same s),
aligned AS (SELECT doc_id, item_id, diag, n_words, sum(same) AS n_same, max(best) / any_value(width)::DOUBLE AS similarity,
  max(best) AS best, any_value(width) AS width FROM frames JOIN size USING (item_id) GROUP BY ALL),
ranked AS (SELECT *, row_number() OVER (PARTITION BY doc_id, item_id ORDER BY similarity DESC, n_same DESC, diag) AS rank
  FROM aligned WHERE best >= {SIMILARITY} * width)
SELECT doc_id, item_id, diag::INTEGER AS word_pos, n_words::INTEGER AS n_words, n_same::INTEGER AS n_same, similarity FROM ranked WHERE rank = 1
"""


ORACLE = _sql()
