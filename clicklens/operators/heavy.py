"""Vocabularies of bounded size (A3, F1): heavy hitters first, then exact counts.

A threshold that is a share of the rows leaves fewer than 1 / share values of a
column, however many there are. A mergeable frequent-items sketch of each column
(built per task, merged in two steps) names all values above the share, and a
bounded number of others; only those are then counted exactly, and all rows
beside them go into one total per column. Rare values are never shuffled by
value, and never written.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clicklens.sources.io import written

# Value of the row that holds the total of a column's rare values (never kept).
RARE = "\u0000rare"
# A sketch of m items is off by at most 3.5 / m of the rows and lists every item
# above twice that, so 8 / share items list all values above the share.
ITEMS_PER_SHARE = 8
# Items that one sketch may hold; smaller shares are counted without a sketch.
MAX_ITEMS = 1_000_000
# Sketches of tasks are merged in so many groups a column before the last merge.
MERGE_GROUPS = 64
# Candidates up to this number are broadcast to the exact count.
CANDIDATES_BROADCAST = 2_000_000


def sketch_items(share: float) -> int | None:
    """Items of a sketch that misses no value above ``share``; None if none is large enough."""
    if not 0 < share < 1:
        raise ValueError("the share must be between 0 and 1")
    items = math.ceil(ITEMS_PER_SHARE / share)
    return items if items <= MAX_ITEMS else None


def _as_rows(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    return df.select([F.col(c).cast("string").alias(c) for c in cols]).unpivot([], list(cols), "col_name", "value")


def heavy_candidates(df: DataFrame, cols: Sequence[str], share: float) -> DataFrame:
    """``col_name, value``: every value above ``share`` of the rows, and fewer than 8 / share others a column."""
    items = sketch_items(share)
    if items is None:
        raise ValueError(f"a share of {share} needs more than {MAX_ITEMS} items")
    rows = _as_rows(df, cols).where("value is not null").withColumn("part", F.pmod(F.spark_partition_id(), F.lit(MERGE_GROUPS)))
    parts = rows.groupBy("col_name", "part").agg(F.expr(f"approx_top_k_accumulate(value, {items})").alias("sketch"))
    whole = parts.groupBy("col_name").agg(F.expr(f"approx_top_k_combine(sketch, {items})").alias("sketch"))
    found = whole.select("col_name", F.explode(F.expr(f"approx_top_k_estimate(sketch, {items})")).alias("found"))
    return found.select("col_name", F.col("found.item").alias("value"))


def compacted(counts: DataFrame, stash: Column) -> DataFrame:
    """Counts with a ``kept`` flag, the values that aren't kept as one total a column.

    Nulls stay apart, and so does a value that equals its column's stash value (``stash``, by
    ``col_name``), so that it can be refused. Output: ``col_name, value, n, kept``.
    """
    own = F.col("kept") | F.coalesce(F.col("value") == stash, F.lit(False))
    shown = F.when(own, F.col("value")).when(F.col("value").isNotNull(), F.lit(RARE))
    return counts.groupBy("col_name", shown.alias("value"), "kept").agg(F.sum("n").alias("n")).select("col_name", "value", "n", "kept")


def heavy_vocabulary(df: DataFrame, cols: Sequence[str], share: float, stashes: Mapping[str, Column]) -> DataFrame:
    """Values above ``share`` of the rows with exact counts, the other rows as totals (see :func:`compacted`).

    The candidates are written, so that their number is known before they are broadcast.
    """
    cols = list(cols)
    stash = F.lit(None).cast("string")
    for c, text in stashes.items():
        stash = F.when(F.col("col_name") == c, text).otherwise(stash)
    candidates = written(heavy_candidates(df, cols, share).withColumn("candidate", F.lit(True)), "candidates")
    small = candidates.count() <= CANDIDATES_BROADCAST
    rows = _as_rows(df, cols).join(F.broadcast(candidates) if small else candidates, ["col_name", "value"], "left")
    named = F.coalesce(F.col("candidate"), F.col("value") == stash, F.lit(False))
    counts = rows.groupBy("col_name", F.when(named, F.col("value")).when(F.col("value").isNotNull(), F.lit(RARE)).alias("value"),
                          F.coalesce("candidate", F.lit(False)).alias("candidate")).agg(F.count(F.lit(1)).alias("n"))
    limit = int(df.count() * share)
    return compacted(counts.withColumn("kept", F.col("candidate") & (F.col("n") > limit)), stash)
