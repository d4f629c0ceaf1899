"""Packing documents into token sequences by a grouping genetic algorithm.

Documents become pieces of at most ``capacity`` tokens. Pieces are dealt at random
to groups of about ``GROUP``; a group is evolved on ``ISLANDS`` islands, each a task's
row of its own with its own population. A child takes over whole well-filled bins
of one parent, loses the other parent's bins that hold the same pieces, and what
was displaced goes in by best fit, longest first. After each epoch the best packing
of an island migrates to the group's next island. A level ends with each group's
best packing: its full and well-filled bins are final, and the pieces of the worst
ones move on to a level with fewer groups, until one group is left. So the space
that single groups waste is used up by others, and no task holds more than a group.

Only numbers of pieces travel in this: ids stay where they were written.

Defined results: a null or empty text has the end id only. A piece of exactly
``capacity`` tokens is a sequence of its own. Rows that share a doc_id, and null
doc_ids, are documents of their own. Other columns aren't read. No documents: no rows.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clicklens.llm.common import materialize, small_batches
from clicklens.llm.word_ids import WordEncoder

GROUP, ISLANDS, POPULATION, GENERATIONS, EPOCHS = 2048, 2, 4, 4, 2
# The share of a group's pieces, one bin at least, that moves on to the next level; parents' bins that may be taken over.
RELEASED, WELL_FILLED = 1 / 16, 1 / 2
# Rows of an evolving table to a task, and tasks at most.
ROWS, TASKS = 8, 20_000
# Pieces' bytes sent back at a time.
HELD = 1 << 22
_BINS = 1 << 20


# -- pieces -----------------------------------------------------------------

def pieces(docs: DataFrame, tokenizer_json: str, end_id: int, capacity: int) -> DataFrame:
    """(doc_id, text) -> task, row, doc_id, piece, start, length, ids (little-endian unsigned 32-bit)."""
    schema = pa.schema([("task", pa.int32()), ("row", pa.int64()), ("doc_id", pa.int64()), ("piece", pa.int32()),
                        ("start", pa.int64()), ("length", pa.int32()), ("ids", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, task, row = WordEncoder(tokenizer_json), TaskContext.get().partitionId(), 0
        end, out, held = np.array([end_id], "<u4").tobytes(), [], 0

        def batch() -> pa.RecordBatch:
            columns = zip(*out, strict=True) if out else [[]] * len(schema)
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)

        for part in batches:
            for doc_id, raw in zip(part.column(0).to_pylist(), encode(part.column(1)), strict=True):
                ids = np.frombuffer(raw, encode.kind).astype("<u4").tobytes() + end
                for piece, at in enumerate(range(0, len(ids), 4 * capacity)):
                    own = ids[at:at + 4 * capacity]
                    out.append((task, row, doc_id, piece, at // 4, len(own) // 4, own))
                    row, held = row + 1, held + len(own)
                if held > HELD:
                    yield batch()
                    out, held = [], 0
        yield batch()

    return small_batches(docs).select(F.col("doc_id").cast("long"), "text").mapInArrow(
        run, "task int, row long, doc_id long, piece int, start long, length int, ids binary")


# -- one island -------------------------------------------------------------

def _best_fit(sizes: list[int], which: list[int], at: np.ndarray, space: np.ndarray, capacity: int) -> np.ndarray:
    """Puts the pieces ``which``, in that order, where least space stays; opens bins if none has room. Bins are numbered anew."""
    spaces = sorted((space[space > 0] * _BINS + np.flatnonzero(space > 0)).tolist())
    bins = len(space)
    for p in which:
        i = bisect_left(spaces, sizes[p] * _BINS)
        if i < len(spaces):
            left, b = divmod(spaces.pop(i), _BINS)
        else:
            left, b, bins = capacity, bins, bins + 1
        at[p] = b
        if left > sizes[p]:
            insort(spaces, (left - sizes[p]) * _BINS + b)
    return np.unique(at, return_inverse=True)[1].astype(np.int32)


def fitness(sizes: np.ndarray, at: np.ndarray, capacity: int) -> tuple[int, float]:
    """Fewer bins are better; among equal numbers, space in few bins is better than space in many."""
    fill = np.bincount(at, sizes)
    return -len(fill), float(np.square(fill / capacity).sum())


def _first(sizes: np.ndarray, noise: float, rng: np.random.Generator, capacity: int) -> np.ndarray:
    order = np.argsort(-sizes * (1 + noise * rng.random(len(sizes))), kind="stable")
    return _best_fit(sizes.tolist(), order.tolist(), np.zeros(len(sizes), np.int32), np.empty(0, np.int64), capacity)


def _child(sizes: np.ndarray, a: np.ndarray, b: np.ndarray, rng: np.random.Generator, capacity: int) -> np.ndarray:
    fill = np.bincount(b, sizes)
    well = np.argsort(-fill, kind="stable")[:max(1, int(WELL_FILLED * len(fill)))]
    taken = np.zeros(len(fill), bool)
    taken[well[rng.random(len(well)) < rng.random()]] = True
    injected = taken[b]
    # bins of the other parent that hold an injected piece go, and some that waste most
    space = capacity - np.bincount(a, sizes)
    gone = space > np.quantile(space, 1 - 0.1 * rng.random())
    gone[a[injected]] = True
    displaced = gone[a] & ~injected
    at = np.where(injected, b, a + len(fill)).astype(np.int32)
    at[displaced] = -1
    keep = ~displaced
    numbers, at[keep] = np.unique(at[keep], return_inverse=True)
    left = (capacity - np.bincount(at[keep], sizes[keep], len(numbers))).astype(np.int64)
    # sizes descend, so the displaced come longest first
    return _best_fit(sizes.tolist(), np.flatnonzero(displaced).tolist(), at, left, capacity)


def evolve(sizes: np.ndarray, packs: list[np.ndarray], guest: np.ndarray | None, seed: int, capacity: int) -> list[np.ndarray]:
    """One epoch of an island: its population, best first. ``sizes`` descend."""
    rng = np.random.default_rng(seed)
    if not packs:
        packs = [_first(sizes, 0.0 if i == 0 else 0.2 * i, rng, capacity) for i in range(POPULATION)]
    ranked = [(fitness(sizes, p, capacity), p) for p in [*packs, *([guest] if guest is not None else [])]]
    # no packing beats one whose bins are all full but the last
    total = int(sizes.sum())
    ideal = (-(-total // capacity), total // capacity + (total % capacity / capacity) ** 2)
    for _ in range(GENERATIONS):
        ranked.sort(key=lambda x: x[0], reverse=True)
        ranked = ranked[:POPULATION]
        if -ranked[0][0][0] == ideal[0] and ranked[0][0][1] >= ideal[1] - 1e-9:
            break
        for _ in range(POPULATION):
            # the better of two, with any other
            i, j = int(rng.integers(len(ranked), size=2).min()), int(rng.integers(len(ranked)))
            child = _child(sizes, ranked[i][1], ranked[j][1], rng, capacity)
            ranked.append((fitness(sizes, child, capacity), child))
    ranked.sort(key=lambda x: x[0], reverse=True)
    return [p for _, p in ranked[:POPULATION]]


# -- levels -----------------------------------------------------------------

def _spread(df: DataFrame, rows: int, *keys: str) -> DataFrame:
    """Rows cost time, not bytes, so their tasks are counted here."""
    return df.repartition(max(1, min(TASKS, -(-rows // ROWS))), *keys)


def _epoch(state: DataFrame, level: int, epoch: int, capacity: int) -> DataFrame:
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in batches:
            out = []
            for grp, island, sizes, packs, guest in part.itertuples(index=False):
                sizes = np.asarray(sizes, np.int64)
                packs = [] if packs is None else [np.asarray(p, np.int32) for p in packs]
                seed = zlib.crc32(f"{level} {epoch} {grp} {island}".encode())
                packs = evolve(sizes, packs, None if guest is None else np.asarray(guest, np.int32), seed, capacity)
                bins, score = fitness(sizes, packs[0], capacity)
                out.append((grp, island, sizes.astype(np.int32), packs, -bins, -(-int(sizes.sum()) // capacity), score))
            yield pd.DataFrame(out, columns=["grp", "island", "sizes", "packs", "bins", "bound", "score"])

    return small_batches(state).select("grp", "island", "sizes", "packs", "guest").mapInPandas(
        run, "grp long, island int, sizes array<int>, packs array<array<int>>, bins int, bound int, score double")


def _settle(best: DataFrame, level: int, last: bool, capacity: int) -> DataFrame:
    """(grp, items, pack) -> task, row, length, sequence_id (null: moves on), offset."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in batches:
            for grp, sizes, task, row, pack in part.itertuples(index=False):
                sizes, at = np.asarray(sizes, np.int64), np.asarray(pack, np.int64)
                order = np.argsort(at, kind="stable")
                begin = np.concatenate([[0], np.cumsum(sizes[order])[:-1]])
                new = np.concatenate([[True], np.diff(at[order]) > 0])
                offset = np.empty(len(at), np.int64)
                offset[order] = begin - begin[new][np.cumsum(new) - 1]
                space, held = capacity - np.bincount(at, sizes), np.bincount(at)
                worst = np.argsort(-space, kind="stable")
                before = np.concatenate([[0], np.cumsum(held[worst])[:-1]])
                moves = np.zeros(len(space), bool)
                moves[worst] = (before <= RELEASED * len(at)) & (space[worst] > 0) & (not last)
                sequence = pd.array((level << 56) + (grp << 16) + at, "Int64")
                sequence[moves[at]] = pd.NA
                yield pd.DataFrame({"task": task, "row": row, "length": sizes, "sequence_id": sequence, "offset": offset})

    rows = best.select("grp", *(F.col(f"items.{c}").alias(c) for c in ("length", "task", "row")), "pack")
    return small_batches(rows).mapInPandas(run, "task int, row long, length int, sequence_id long, offset long")


def pack(items: DataFrame, capacity: int) -> DataFrame:
    """(task, row, length), the pair unique, length of 1 to capacity - 1 -> task, row, sequence_id, offset.

    Sequences are numbered by level, group and bin; offsets run from 0 without gaps.
    """
    placed, left, level, groups = [], items.select("task", "row", "length"), 0, None
    while n := left.count():
        groups = min(-(-n // GROUP), -(-groups // 2) if groups else n)
        dealt = left.withColumn("grp", F.pmod(F.xxhash64("task", "row", F.lit(level)), F.lit(groups)))
        dealt = dealt.groupBy("grp").agg(F.sort_array(F.collect_list(F.struct("length", "task", "row")), asc=False).alias("items"))
        dealt = materialize(dealt, "pack-groups")
        islands = F.explode(F.sequence(F.lit(0), F.lit(ISLANDS - 1)))
        state = dealt.select("grp", islands.alias("island"), F.col("items.length").alias("sizes"),
                             F.lit(None).cast("array<array<int>>").alias("packs"), F.lit(None).cast("array<int>").alias("guest"))
        for epoch in range(EPOCHS):
            state = materialize(_epoch(_spread(state, groups * ISLANDS, "grp", "island"), level, epoch, capacity), "pack-islands")
            elite = state.select("grp", ((F.col("island") + 1) % ISLANDS).alias("island"), F.col("packs")[0].alias("guest"))
            if epoch + 1 < EPOCHS:
                state = state.join(elite, ["grp", "island"])
        best = state.groupBy("grp").agg(F.max_by(F.col("packs")[0], F.struct(-F.col("bins"), "score", -F.col("island"))).alias("pack"))
        done = materialize(_settle(_spread(dealt.join(best, "grp"), groups, "grp"), level, groups == 1, capacity), "pack-level")
        placed.append(done.where("sequence_id is not null").select("task", "row", "sequence_id", "offset"))
        left, level = done.where("sequence_id is null"), level + 1
    if not placed:
        return items.select("task", "row", F.lit(0).cast("long").alias("sequence_id"), F.lit(0).cast("long").alias("offset")).where("false")
    return reduce(DataFrame.union, placed)


def place(own: DataFrame, capacity: int) -> DataFrame:
    """Written pieces with sequence_id and offset; full ones are sequences of their own, with negative numbers."""
    alone = own.where(F.col("length") == capacity).select("*", (-1 - F.col("task").cast("long") * (1 << 40) - F.col("row")).alias("sequence_id"),
                                                          F.lit(0).cast("long").alias("offset"))
    rest = own.where(F.col("length") < capacity)
    return rest.join(pack(rest, capacity), ["task", "row"]).unionByName(alone)


def sequences(placed: DataFrame) -> DataFrame:
    """Pieces with ids, sequence_id and offset -> sequence_id, length, ids, doc_ids: the packed sequences themselves."""
    held = F.array_sort(F.collect_list(F.struct("offset", "doc_id", "ids")))
    rows = placed.groupBy("sequence_id").agg(held.alias("held"), F.sum("length").alias("length"))
    ids = F.aggregate("held", F.lit(b""), lambda acc, x: F.concat(acc, x["ids"]))
    return rows.select("sequence_id", "length", ids.alias("ids"), F.col("held.doc_id").alias("doc_ids"))


def query(docs: DataFrame, tokenizer_path: str, capacity: int = 4096, end_id: int = 1) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id, offset of every piece."""
    with open(tokenizer_path, encoding="utf-8") as f:
        rows = pieces(docs, f.read(), end_id, capacity)
    own = materialize(rows.withColumn("ids_crc32", F.crc32("ids")).drop("ids"), "pack-pieces")
    return place(own, capacity).select("doc_id", "piece", F.col("start"), F.col("length").cast("long").alias("length"),
                                       "ids_crc32", "sequence_id", "offset")
