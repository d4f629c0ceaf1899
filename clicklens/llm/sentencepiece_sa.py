"""SentencePiece (BPE with byte fallback) encoding and decoding by suffix arrays.

Text becomes words as the model sees them: blanks are written as U+2581, one is put
in front, and no piece reaches over the start of a run of them, so words can be
encoded on their own. For the distinct new words of a batch:

1. their concatenated text is indexed by a suffix array;
2. every piece is binary-searched for its range of occurrences;
3. the occurrences become edges (position, length, piece, score), sorted by position;
4. the words' symbols are relaxed over the edges: the adjacent pair whose joint edge
   scores highest merges first, the leftmost of equals, until no pair has an edge.
   Words of many symbols use a heap, the others are relaxed together in rounds.

Symbols that are no piece become byte pieces. Encoded words are kept in a bounded
cache of the task. Decoding joins the pieces' bytes and drops the leading blank.

Defined results: null text has null ids and decodes to null; empty text has no ids.
U+2581 in a text counts as a blank, as it does for the model. Very long texts and
words are encoded whole. Repeated rows and extra columns pass through.
"""

from __future__ import annotations

import heapq
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clicklens.llm.common import shielded, slices, small_batches

SPACE = "▁"
# Characters of text handled at a time, and of new words that are indexed at a time; words kept in a task's cache;
# symbols above which a word uses the heap.
BATCH, INDEXED, CACHE, LONG = 1 << 20, 1 << 17, 600_000, 48
_EDGE = 64  # more than the longest piece's bytes


class Vocabulary:
    """Pieces, scores and byte pieces of a model, as plain values that travel with the task."""

    def __init__(self, pieces: list[str], scores: list[float], kinds: list[str]) -> None:
        """``kinds``: normal, byte, control or unknown, by piece."""
        self.bytes_of = [
            bytes([int(p[3:5], 16)]) if k == "byte" else b"" if k == "control"
            else " ⁇ ".encode() if k == "unknown" else p.replace(SPACE, " ").encode()
            for p, k in zip(pieces, kinds, strict=True)]
        own = [i for i, k in enumerate(kinds) if k == "normal"]
        self.ids = np.array(own, np.int32)
        self.pieces = np.array([pieces[i].encode() for i in own])
        self.scores = np.array([scores[i] for i in own])
        if self.pieces.dtype.itemsize >= _EDGE:
            raise ValueError(f"a piece of more than {_EDGE - 1} bytes")
        if any(SPACE in pieces[i].lstrip(SPACE) for i in own):
            raise ValueError("pieces over several words can't be split at blanks")
        self.byte_ids = [0] * 256
        for i, k in enumerate(kinds):
            if k == "byte":
                self.byte_ids[self.bytes_of[i][0]] = i
        self.unknown = next((i for i, k in enumerate(kinds) if k == "unknown"), 0)
        self.has_bytes = "byte" in kinds
        cut = "" if any("\n" in pieces[i] for i in own) else "\n"  # no piece holds a line end: it stands alone
        self.split = f"{cut}|{SPACE}*[^{SPACE}{cut}]+|{SPACE}+" if cut else f"{SPACE}*[^{SPACE}]+|{SPACE}+"


@lru_cache(2)
def load(path: str) -> Vocabulary:
    """Reads a model file (on the driver)."""
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=path)
    n = range(sp.vocab_size())
    kinds = ["byte" if sp.is_byte(i) else "control" if sp.is_control(i) else "unknown" if sp.is_unknown(i) else "normal" for i in n]
    return Vocabulary([sp.id_to_piece(i) for i in n], [sp.get_score(i) for i in n], kinds)


def suffix_order(words: np.ndarray, suffixes: np.ndarray) -> np.ndarray:
    """Lexicographic order: by the first 8 bytes as one number, then whole where those tie."""
    head = np.ascontiguousarray(words[:, :8]).view(">u8").ravel().astype(np.uint64)
    order = np.argsort(head)
    same = head[order[1:]] == head[order[:-1]]
    tied = np.flatnonzero(np.concatenate([same, [False]]) | np.concatenate([[False], same]))
    order[tied] = order[tied][np.argsort(suffixes[order[tied]])]
    return order


def edges_of(raw: bytes, vocabulary: Vocabulary) -> tuple[np.ndarray, np.ndarray]:
    """(key, piece number) of every occurrence of a piece, sorted; key = position * 64 + length."""
    width = vocabulary.pieces.dtype.itemsize
    buf = np.frombuffer(raw, np.uint8)
    starts = np.flatnonzero((buf & 0xC0) != 0x80)  # first bytes of characters
    padded = np.concatenate([buf, np.zeros(width, np.uint8)])
    words = np.lib.stride_tricks.sliding_window_view(padded, width)[starts]
    words = np.ascontiguousarray(words)
    suffixes = words.view(f"S{width}").ravel()
    order = suffix_order(words, suffixes)
    suffixes, starts = suffixes[order], starts[order]
    pieces = vocabulary.pieces
    size = np.char.str_len(pieces)
    low = np.searchsorted(suffixes, pieces)
    # beyond every suffix that begins with the piece: no UTF-8 text holds the byte 255
    last = np.full((len(pieces), width + 1), 255, np.uint8)
    last[:, :width] = np.where(np.arange(width) < size[:, None], pieces.view(np.uint8).reshape(-1, width), 255)
    high = np.searchsorted(suffixes, last.view(f"S{width + 1}").ravel())
    n = high - low
    piece = np.repeat(np.arange(len(pieces)), n)
    at = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(low, n)
    packed = (starts[at] * _EDGE + size[piece]) * len(pieces) + piece
    packed.sort()
    return packed // len(pieces), packed % len(pieces)


def _relax_long(begin: int, cuts: np.ndarray, edge: dict[int, float]) -> list[int]:
    """Boundaries of one word's symbols after all merges, by a heap of candidate pairs."""
    cuts = [int(c) for c in cuts]
    after = dict(zip(cuts[:-1], cuts[1:], strict=True))
    before = dict(zip(cuts[1:], cuts[:-1], strict=True))
    heap: list[tuple[float, int, int, int]] = []

    def offer(a: int, b: int) -> None:
        c = after.get(b)
        if c is not None and c - a < _EDGE and (s := edge.get(a * _EDGE + c - a)) is not None:
            heapq.heappush(heap, (-s, a, b, c))

    for a, b in zip(cuts[:-1], cuts[1:], strict=True):
        offer(a, b)
    while heap:
        _, a, b, c = heapq.heappop(heap)
        if after.get(a) != b or after.get(b) != c:
            continue
        after[a], before[c] = c, a
        del after[b]
        offer(a, c)
        if a != begin:
            offer(before[a], a)
    return sorted(after)


def _relax_short(left: np.ndarray, own: np.ndarray, word_end: np.ndarray, key: np.ndarray, score: np.ndarray) -> np.ndarray:
    """First bytes of the symbols of all words (``own``) after all merges: in a round, each word merges its best pair."""
    done = []

    def joint(i: np.ndarray) -> np.ndarray:
        """Score of the edge over symbols i and i+1; -inf where there is none."""
        out = np.full(len(i), -np.inf)
        ok = np.flatnonzero(i + 1 < len(left))
        ok = ok[own[i[ok]] == own[i[ok] + 1]]
        a = i[ok]
        last = np.minimum(a + 2, len(left) - 1)
        end = np.where((a + 2 < len(left)) & (own[last] == own[a]), left[last], word_end[own[a]])
        wanted = left[a] * _EDGE + np.minimum(end - left[a], 0 if not len(key) else _EDGE - 1)
        at = np.minimum(np.searchsorted(key, wanted), len(key) - 1)
        hit = (key[at] == wanted) & (end - left[a] < _EDGE) if len(key) else np.zeros(len(a), bool)
        out[ok[hit]] = score[at[hit]]
        return out

    pair = joint(np.arange(len(left)))
    while len(left):
        heads = np.flatnonzero(np.concatenate([[True], own[1:] != own[:-1]]))
        sizes = np.diff(np.append(heads, len(own)))
        best = np.maximum.reduceat(pair, heads)
        more = np.repeat(best > -np.inf, sizes)
        if not more.all():  # words without a pair are done
            done.append(left[~more])
            left, own, pair, best, sizes = left[more], own[more], pair[more], best[best > -np.inf], sizes[best > -np.inf]
            if not len(left):
                break
        top = np.flatnonzero(pair == np.repeat(best, sizes))
        top = top[np.concatenate([[True], own[top[1:]] != own[top[:-1]]])]  # the leftmost of equals
        keep = np.ones(len(left), bool)
        keep[top + 1] = False
        left, own, pair = left[keep], own[keep], pair[keep]
        now = top - np.arange(len(top))  # each word lost one symbol
        changed = np.concatenate([now, now[now > 0] - 1])
        pair[changed] = joint(changed)
    return np.concatenate(done) if done else left


def encode_words(words: list[str], vocabulary: Vocabulary) -> list[bytes]:
    """Ids (little-endian int32 bytes) of each word."""
    encoded = [w.encode() for w in words]
    raw = b"".join(encoded)
    key, piece = edges_of(raw, vocabulary)
    score = vocabulary.scores[piece]
    starts = np.flatnonzero((np.frombuffer(raw, np.uint8) & 0xC0) != 0x80)
    word_end = np.cumsum([len(b) for b in encoded])
    word = np.searchsorted(word_end, starts, side="right")
    symbols = np.bincount(word, minlength=len(words))
    done: list[np.ndarray] = []
    for w in np.flatnonzero(symbols > LONG):
        begin, end = int(word_end[w]) - len(encoded[w]), int(word_end[w])
        a, b = np.searchsorted(key, [begin * _EDGE, end * _EDGE])
        edge = dict(zip(key[a:b].tolist(), score[a:b].tolist(), strict=True))
        done.append(np.array(_relax_long(begin, np.append(starts[word == w], end), edge), np.int64))
    short = symbols[word] <= LONG
    done.append(_relax_short(starts[short], word[short], word_end, key, score))
    heads = np.sort(np.concatenate(done))
    own = np.searchsorted(word_end, heads, side="right")
    tail = np.minimum(np.append(heads[1:], len(raw)), word_end[own])
    wanted = heads * _EDGE + np.minimum(tail - heads, _EDGE - 1)
    at = np.searchsorted(key, wanted)
    at[at == len(key)] = 0
    known = key[at] == wanted if len(key) else np.zeros(len(heads), bool)
    ids = np.where(known, vocabulary.ids[piece[at]] if len(key) else 0, vocabulary.unknown).astype("<i4")
    cuts = np.concatenate([[0], np.searchsorted(own, np.arange(len(words)), side="right")])
    missing = set(own[~known].tolist())
    flat = ids.tobytes()
    out = []
    for w in range(len(words)):
        a, b = int(cuts[w]), int(cuts[w + 1])
        if w not in missing or not vocabulary.has_bytes:
            out.append(flat[4 * a:4 * b])
            continue
        parts: list[int] = []
        for i in range(a, b):
            parts += [int(ids[i])] if known[i] else [vocabulary.byte_ids[x] for x in raw[heads[i]:tail[i]]]
        out.append(np.array(parts, "<i4").tobytes())
    return out


def encode(texts: list[str | None], vocabulary: Vocabulary, cache: dict[str, bytes]) -> list[np.ndarray | None]:
    """Ids of each text. ``cache`` holds words that were encoded before."""
    words_of = re.compile(vocabulary.split).findall
    out: list[np.ndarray | None] = []
    for a, b in slices(texts, BATCH):
        words = [words_of(SPACE + t.replace(" ", SPACE)) if t else [] for t in texts[a:b]]
        if len(cache) > CACHE:
            cache.clear()
        new = list(set().union(*words).difference(cache))
        for c, d in slices(new, INDEXED):
            cache.update(zip(new[c:d], encode_words(new[c:d], vocabulary), strict=True))
        out += [None if t is None else np.frombuffer(b"".join(map(cache.__getitem__, ws)), "<i4")
                for t, ws in zip(texts[a:b], words, strict=True)]
    return out


def decode(ids: np.ndarray | None, vocabulary: Vocabulary) -> str | None:
    if ids is None:
        return None
    text = b"".join(map(vocabulary.bytes_of.__getitem__, ids.tolist())).decode("utf-8", "replace")
    return text[1:] if text.startswith(" ") else text


def with_ids(docs: DataFrame, vocabulary: Vocabulary, text: str = "text", ids: str = "ids") -> DataFrame:
    @F.pandas_udf("array<int>")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        cache: dict[str, bytes] = {}
        for s in batches:
            yield pd.Series(encode([None if t is None else t for t in s], vocabulary, cache), dtype=object)

    return small_batches(docs).withColumn(ids, run(F.col(text)))


def with_ids_and_text(docs: DataFrame, vocabulary: Vocabulary, text: str = "text", ids: str = "ids", decoded: str = "decoded") -> DataFrame:
    """Both ways in one pass over the texts, with one Python worker a task."""
    @F.pandas_udf("ids array<int>, decoded string")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        cache: dict[str, bytes] = {}
        for s in batches:
            found = encode([None if t is None else t for t in s], vocabulary, cache)
            yield pd.DataFrame({"ids": pd.Series(found, dtype=object), "decoded": pd.Series([decode(x, vocabulary) for x in found], dtype=object)})

    rows, back = shielded(small_batches(docs), ["_pieces"])
    both = rows.withColumn("_pieces", run(F.col(text)))
    return both.withColumns({ids: F.col("_pieces.ids"), decoded: F.col("_pieces.decoded")}).drop("_pieces").withColumnsRenamed(back)


def with_text(rows: DataFrame, vocabulary: Vocabulary, ids: str = "ids", text: str = "decoded") -> DataFrame:
    @F.pandas_udf("string")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for s in batches:
            yield pd.Series([decode(x, vocabulary) for x in s], dtype=object)

    return small_batches(rows).withColumn(text, run(F.col(ids)))


def query(docs: DataFrame, model_path: str) -> DataFrame:
    """Per document: its ids, how many, and whether decoding gives the text back (U+2581 as a blank)."""
    vocabulary = load(model_path)
    rows = with_ids_and_text(docs.select("doc_id", "text"), vocabulary)
    return rows.select("doc_id", "ids", F.size("ids").alias("n_tokens"),
                       (F.col("decoded") == F.translate("text", SPACE, " ")).alias("round_trip"))
