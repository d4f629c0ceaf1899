"""Periodic runs of words, by recompression.

The texts of a batch are put behind each other, a separator of its own before
each, and compressed: blocks of one letter become a letter, then pairs of letters
from two halves of the alphabet do, in turn, until each text is a letter or two.
Equal letters stand for equal words, so two places are compared by walking up the
levels while whole letters agree and down where they differ: a longest common
extension takes a few steps a level, to either side, and is exact.

Candidates come from a harmonic grid: a run of at least four periods ``q`` repeats a
word at distance ``q`` at three neighbouring multiples of ``q``. Places where that
holds are extended to both sides; places inside a stretch found already are left out.
A stretch with a shorter period that divides ``q`` is that period's run.

Each text is worked on whole, by one task, in memory linear in its length; nothing is
shuffled.

Defined results: null and empty texts have no words, no runs and an empty collapsed
text. Rows that share an id, and null ids, are texts of their own. Only the named
columns are read; other columns of any name don't matter. No rows: no rows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clicklens.llm.common import small_batches

# A run has at least so many words, and so many periods.
LEAST, PERIODS = 6, 4

Reorder = Callable[[np.ndarray, np.ndarray], tuple[np.ndarray, np.ndarray]]


# -- grammar ----------------------------------------------------------------

class Grammar:
    """Run-length grammar of letters 0, 1, ...; letters below ``n_fixed`` (separators) are never combined.

    ``levels[k]`` holds the letters of level k; ``parent[k]`` and ``first[k]`` lead from a
    place of level k to its place on level k + 1 and back to that one's first place.
    """

    def __init__(self, letters: np.ndarray, n_fixed: int) -> None:
        self.levels, self.parent, self.first, self.blocks = [letters], [], [], []
        names, round_ = int(letters.max(initial=0)) + 1, 0
        while self._longest(n_fixed) > 2:
            names = self._blocks(names, n_fixed) if round_ % 2 == 0 else self._pairs(names, n_fixed, round_)
            round_ += 1

    def _longest(self, n_fixed: int) -> int:
        """Letters of the longest text."""
        fixed = np.flatnonzero(self.levels[-1] < n_fixed)
        return int(np.diff(fixed).max(initial=1)) - 1

    def _add(self, new: np.ndarray, letters: np.ndarray, block: bool) -> None:
        """A level whose letters begin at the places ``new`` of the last one."""
        self.parent.append(np.cumsum(new) - 1)
        self.first.append(np.append(np.flatnonzero(new), len(new)))
        self.levels.append(letters)
        self.blocks.append(block)

    def _blocks(self, names: int, n_fixed: int) -> int:
        s = self.levels[-1]
        new = np.concatenate([[True], s[1:] != s[:-1]])
        if new.all():
            return names
        first = np.flatnonzero(new)
        size, letters = np.diff(np.append(first, len(s))), s[first].copy()
        many = size > 1
        code, kinds = pd.factorize(letters[many] * (len(s) + 1) + size[many])
        letters[many] = names + code
        self._add(new, letters, True)
        return names + len(kinds)

    def _pairs(self, names: int, n_fixed: int, round_: int) -> int:
        s = self.levels[-1]
        half = s.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(round_ * 0x632BE59BD9B4E019 % (1 << 64))
        half ^= half >> np.uint64(32)
        left = ((half * np.uint64(0xD6E8FEB86659FD93)) >> np.uint64(63)).astype(bool)
        free = s >= n_fixed
        joined = np.flatnonzero((left & free)[:-1] & (~left & free)[1:])
        if not len(joined):
            return names
        new, letters = np.ones(len(s), bool), s.copy()
        new[joined + 1] = False
        code, kinds = pd.factorize(s[joined] * names + s[joined + 1])
        letters[joined] = names + code
        self._add(new, letters[new], False)
        return names + len(kinds)

    def extend(self, x: np.ndarray, y: np.ndarray, way: int) -> np.ndarray:
        """How many letters agree from x and y on (``way`` 1) or back (-1); texts end at separators, which agree with nothing."""
        begin, x, y = x, x.copy(), y.copy()
        level, top = np.zeros(len(x), np.int64), len(self.parent)
        rising = np.arange(len(x))
        for k in range(top + 1):
            at, up = rising, []
            while len(at):
                if k < top:
                    edge_x, edge_y = self._at_edge(k, x[at], way), self._at_edge(k, y[at], way)
                    up.append(at[edge_x & edge_y])
                    at = at[~(edge_x & edge_y)]
                at = at[self.levels[k][x[at]] == self.levels[k][y[at]]]
                self._advance(k, x, y, at, way)
            rising = np.concatenate(up) if up else at
            if not len(rising):
                break
            x[rising], y[rising] = self.parent[k][x[rising]], self.parent[k][y[rising]]
            level[rising] = k + 1
        for k in range(int(level.max(initial=0)), 0, -1):
            down = np.flatnonzero(level == k)
            level[down] = k - 1
            for z in (x, y):
                z[down] = self.first[k - 1][z[down]] if way > 0 else self.first[k - 1][z[down] + 1] - 1
            at = down
            while len(at):
                at = at[self.levels[k - 1][x[at]] == self.levels[k - 1][y[at]]]
                self._advance(k - 1, x, y, at, way)
        return np.abs(x - begin)

    def _at_edge(self, k: int, x: np.ndarray, way: int) -> np.ndarray:
        up = self.parent[k][x]
        return self.first[k][up] == x if way > 0 else self.first[k][up + 1] - 1 == x

    def _advance(self, k: int, x: np.ndarray, y: np.ndarray, at: np.ndarray, way: int) -> None:
        step: np.ndarray | int = 1
        if k < len(self.blocks) and self.blocks[k]:
            # equal letters: as many as the shorter rest of their blocks
            step = np.minimum(*(self.first[k][self.parent[k][z[at]] + 1] - z[at] if way > 0
                                else z[at] - self.first[k][self.parent[k][z[at]]] + 1 for z in (x, y)))
        x[at] += way * step
        y[at] += way * step


# -- runs -------------------------------------------------------------------

def _candidates(letters: np.ndarray, n: np.ndarray, begin: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(place, period) where a word comes back at three neighbouring multiples of the period. ``n`` descends."""
    places, periods, q = [], [], 1
    longest = int(n.max(initial=0))
    while max(LEAST, PERIODS * q) <= longest:
        texts = int(np.searchsorted(-n, -max(LEAST, PERIODS * q), "right"))
        grid = letters[:int(begin[texts - 1] + n[texts - 1]):q]
        same = grid[1:] == grid[:-1]
        hit = np.flatnonzero(same[2:] & same[1:-1] & same[:-2])
        if len(hit):
            places.append(hit * q)
            periods.append(np.full(len(hit), q))
        q += 1
    if not places:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    return np.concatenate(places), np.concatenate(periods)


def runs(words: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(text, start, length, period) of all runs, by text, start and period.

    ``words`` holds the word numbers of all texts behind each other, ``n`` the words of each.
    """
    order, m = np.argsort(-n, kind="stable"), len(n)
    size = n[order]
    begin = np.cumsum(size + 1) - size  # of each text, behind its separator
    letters, inside = np.empty(len(words) + m + 1, np.int64), np.ones(len(words) + m + 1, bool)
    inside[begin - 1], inside[-1] = False, False
    letters[~inside] = np.arange(m + 1)
    letters[inside] = words[np.flatnonzero(inside) + np.repeat((np.cumsum(n) - n)[order] - begin, size)] + m + 1
    place, period = _candidates(letters, size, begin)
    text = np.maximum(np.searchsorted(begin, place, "right") - 1, 0)
    # all four places in one text
    ok = (place >= begin[text]) & (place + 3 * period < begin[text] + size[text])
    place, period, text = place[ok], period[ok], text[ok]
    found: list[tuple[np.ndarray, ...]] = []
    if len(place):
        grammar = Grammar(letters, m + 1)
        # neighbouring places of the grid: the first is extended, those within its stretch are done
        chain = np.cumsum(np.concatenate([[True], (np.diff(period) != 0) | (np.diff(place) != period[1:])])) - 1
        while len(place):
            lead = np.flatnonzero(np.concatenate([[True], np.diff(chain) > 0]))
            x, q = place[lead], period[lead]
            after, before = grammar.extend(x, x + q, 1), grammar.extend(x - 1, x + q - 1, -1)
            length = after + before + q
            good = length >= np.maximum(LEAST, PERIODS * q)
            found.append((text[lead][good], (x - before)[good], length[good], q[good]))
            reached = np.repeat(x + after, np.diff(np.append(lead, len(place))))
            left = place >= reached
            left[lead] = False
            place, period, text, chain = place[left], period[left], text[left], chain[left]
    if not found:
        return (np.empty(0, np.int64),) * 4
    t, start, length, q = (np.concatenate(c) for c in zip(*found, strict=True))
    # one stretch: the shortest period is its own
    by = np.lexsort((q, length, start))
    t, start, length, q = t[by], start[by], length[by], q[by]
    own = np.ones(len(t), bool)
    own[1:] = (np.diff(start) != 0) | (np.diff(length) != 0)
    t, start, length, q = order[t[own]], start[own] - begin[t[own]], length[own], q[own]
    by = np.lexsort((q, start, t))
    return t[by], start[by], length[by], q[by]


def _dropped(n: np.ndarray, text: np.ndarray, start: np.ndarray, length: np.ndarray, period: np.ndarray) -> np.ndarray:
    """Words that some run holds behind its first period."""
    base, marks = np.cumsum(n) - n, np.zeros(int(n.sum()) + 1, np.int64)
    np.add.at(marks, base[text] + start + period, 1)
    np.add.at(marks, base[text] + start + length, -1)
    return np.cumsum(marks)[:-1] > 0


def with_runs(docs: DataFrame, key: Column, doc_id: str = "doc_id", text: str = "text", reorder: Reorder | None = None) -> DataFrame:
    """doc_id, runs (start, length, period; by start, then period), collapsed (the kept words, joined by one space).

    ``reorder(n, key)`` may give (a, p) for each text of n words: word i >= a is then the
    text's word a + (i - a) % p. ``key`` (a long, may be null) is passed on to it only.
    """
    spans = pa.list_(pa.struct([(c, pa.int64()) for c in ("start", "length", "period")]))
    schema = pa.schema([("doc_id", pa.int64()), ("runs", spans), ("collapsed", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in batches:
            if not part.num_rows:
                continue
            trimmed = pc.ascii_trim_whitespace(pc.fill_null(part.column(1).cast(pa.large_string()), ""))
            split = pc.ascii_split_whitespace(trimmed)
            # an empty text splits into one empty word
            empty = pc.binary_length(trimmed).to_numpy(zero_copy_only=False) == 0
            words, n = split.values, np.diff(split.offsets.to_numpy().astype(np.int64))
            at, n = np.flatnonzero(np.repeat(~empty, n)), np.where(empty, 0, n)
            base = np.cumsum(n) - n
            if reorder is not None:
                a, p = reorder(n, pc.fill_null(part.column(2), -1).to_numpy(zero_copy_only=False))
                i = np.arange(len(at)) - np.repeat(base, n)
                a, p = np.repeat(a, n), np.repeat(p, n)
                at = at[np.repeat(base, n) + np.where(i >= a, a + (i - a) % p, i)]
            codes = words.dictionary_encode().indices.to_numpy(zero_copy_only=False).astype(np.int64)
            t, start, length, period = runs(codes[at], n)
            kept = ~_dropped(n, t, start, length, period)
            ends = np.concatenate([[0], np.cumsum(np.bincount(np.repeat(np.arange(len(n)), n)[kept], minlength=len(n)))])
            texts = pc.binary_join(pa.ListArray.from_arrays(pa.array(ends, pa.int32()), words.take(pa.array(at[kept]))), pa.scalar(" ", pa.large_string()))
            of = np.concatenate([[0], np.cumsum(np.bincount(t, minlength=len(n)))])
            items = pa.StructArray.from_arrays([pa.array(c, pa.int64()) for c in (start, length, period)], ["start", "length", "period"])
            yield pa.RecordBatch.from_arrays([part.column(0), pa.ListArray.from_arrays(pa.array(of, pa.int32()), items), texts.cast(pa.string())],
                                             schema=schema)

    rows = small_batches(docs).select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"), key.cast("long").alias("key"))
    return rows.mapInArrow(run, "doc_id long, runs array<struct<start:long,length:long,period:long>>, collapsed string")


def looped(n: np.ndarray, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Texts whose key divides by ten repeat a stretch from a word on; the others (and null keys) stay as they are."""
    g = h // 10
    a = np.where((h >= 0) & (h % 10 == 0), g % np.maximum(n, 1), n)
    return a, 1 + (n - a) // (3 + g % 8)


def query(docs: DataFrame) -> DataFrame:
    rows = with_runs(docs, F.crc32(F.col("doc_id").cast("string").cast("binary")), reorder=looped)
    # exponents are compared as fractions; of equal ones the first stays
    best = F.aggregate("runs", F.col("runs")[0], lambda best, r: F.when(r["length"] * best["period"] > best["length"] * r["period"], r).otherwise(best))
    line = F.transform("runs", lambda r: F.concat(F.concat_ws(",", *(r[c].cast("string") for c in ("start", "length", "period"))), F.lit("\n")))
    return (rows.withColumn("best", F.when(F.size("runs") > 0, best))
            .select("doc_id", F.size("runs").cast("long").alias("n_runs"), *(F.col(f"best.{c}").alias(c) for c in ("start", "length", "period")),
                    F.expr("1000 * best.length div best.period").alias("exponent_milli"),
                    F.sha2(F.array_join(line, ""), 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256")))
