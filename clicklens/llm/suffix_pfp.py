"""Exact removal of repeated 100-byte strings by prefix-free parsing.

Every byte covered by a ``LENGTH``-byte string that also starts earlier in the
corpus (smaller doc_id, or same document and earlier start) is removed.

1. Parse. A rolling hash over ``GRAM`` bytes picks the triggers: each window of
   ``LENGTH`` bytes belongs to the leftmost smallest rolling hash inside it, so
   equal windows have equal triggers at equal offsets. The consecutive windows of
   one trigger are a phrase; phrases overlap by LENGTH-1 bytes, so each window
   lies in exactly one. A task resolves copies within its block of texts at once
   (all but the first are removed) and passes on one row for each phrase.
2. Dictionary. Phrases are grouped by trigger. All but the corpus-first
   occurrence of a phrase are removed whole. A trigger with one phrase is settled
   by that; where several phrases share a trigger, the bytes of each phrase's
   first occurrence join the dictionary.
3. Suffix arrays. A task lays its dictionary phrases out in corpus order (the
   parse) and sorts their windows stably: equal windows stand together, in corpus
   order, and all but the first of a run are removed. Triggers never straddle
   tasks. Where more than ``HOT`` phrases share a trigger, their windows are dealt
   by 128-bit window hash instead, so that they spread over all tasks; that is as
   exact.
4. The removed runs go back to their documents.

Phrases are compared by two 64-bit hashes (of the trigger, and of the bytes).

Defined results: null and empty texts have no bytes. Rows that share a doc_id are
documents of their own, ordered by text after that id (of identical rows all but one lose their
repeated strings); null ids come first. Very long texts are parsed in pieces that
overlap, whole. Ties and periodic texts need nothing special. Other columns pass
through, and working columns have names of their own.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clicklens.llm.common import materialize, shielded, small_batches

LENGTH = 100
GRAM = 32  # a power of two
# Texts of one task are resolved in blocks of this many bytes, and hashed in pieces.
BLOCK, PIECE = 1 << 24, 1 << 21
# Bytes of dictionary phrases that one suffix array covers.
ARRAY = 1 << 20
# Above this many phrases of a trigger, windows are dealt by their own hash.
HOT = 2000
# Most hot triggers (nine bytes each) that are broadcast.
BROADCAST_TRIGGERS = 1_000_000

K, SEQ = "_pfp_doc", "_pfp_seq"
_ROW = f"kind int, trig long, dig long, {K} long, {SEQ} int, pos long, len int"
_LOW = np.uint64((1 << 24) - 1)
_rng = np.random.default_rng(20)
_BYTE = _rng.integers(0, 1 << 64, 256, np.uint64)
_STEP = _rng.integers(0, 1 << 64, 8, np.uint64) | np.uint64(1)


def rolling(buf: np.ndarray) -> np.ndarray:
    """Hash of each run of ``GRAM`` bytes, by doubling."""
    h, m, i = _BYTE[buf], 1, 0
    while m < GRAM:
        h = h[:-m] * _STEP[i] + h[m:]
        m, i = 2 * m, i + 1
    h ^= h >> np.uint64(31)
    h *= np.uint64(0x9E3779B97F4A7C15)
    h ^= h >> np.uint64(29)
    return h


def _window_min(x: np.ndarray, width: int) -> np.ndarray:
    m = 1
    while 2 * m <= width:
        x = np.minimum(x[:-m], x[m:])
        m *= 2
    return np.minimum(x[:len(x) - (width - m)], x[width - m:]) if width > m else x


def parse(segments: list[bytes]) -> tuple[np.ndarray, ...]:
    """Phrases of some byte strings: (segment, start, length, trigger hash, phrase hash)."""
    raw = b"".join(segments)
    size = np.array([len(s) for s in segments], np.int64)
    n = len(raw) - LENGTH + 1
    if n <= 0:
        return tuple(np.empty(0, np.int64) for _ in range(5))
    h = rolling(np.frombuffer(raw, np.uint8))
    key = (h & ~_LOW) | np.arange(len(h), dtype=np.uint64)
    owner = (_window_min(key, LENGTH - GRAM + 1) & _LOW).astype(np.int64)
    end = np.cumsum(size)
    seg = np.repeat(np.arange(len(size)), size)[:n]
    p = np.flatnonzero(np.arange(n) <= end[seg] - LENGTH)
    if not len(p):
        return tuple(np.empty(0, np.int64) for _ in range(5))
    o, s = owner[p], seg[p]
    first = np.concatenate([[0], np.flatnonzero((o[1:] != o[:-1]) | (s[1:] != s[:-1])) + 1])
    last = np.concatenate([first[1:] - 1, [len(p) - 1]])
    a, length = p[first], p[last] - p[first] + LENGTH
    digest = xxhash.xxh3_64_intdigest
    dig = np.array([digest(raw[x:y]) for x, y in zip(a.tolist(), (a + length).tolist(), strict=True)], np.uint64)
    return s[first], a - (end - size)[s[first]], length, h[o[first]].view(np.int64), dig.view(np.int64)


def spans_union(doc: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, ...]:
    """Maximal runs (doc, start, end) of spans that touch or overlap."""
    order = np.lexsort((start, doc))
    doc, start, end = doc[order], start[order], end[order]
    if not len(doc):
        return doc, start, end
    shift = (doc - doc[0]) * (int(end.max()) + 2)  # runs of different documents can't meet
    top = np.maximum.accumulate(end + shift)
    new = np.concatenate([[True], start[1:] + shift[1:] > top[:-1]])
    at = np.flatnonzero(new)
    stop = np.concatenate([at[1:] - 1, [len(doc) - 1]])
    return doc[at], start[at], top[stop] - shift[at]


def _block_rows(block: pd.DataFrame) -> pd.DataFrame:
    """Rows of one block of texts: phrases (kind 1, the block's first of each) and removed spans (kind 0)."""
    block = block.sort_values([K, SEQ])
    k, seq = block[K].to_numpy(), block[SEQ].to_numpy()
    found, segs, doc, base, held = [], [], [], [], 0

    def flush() -> None:
        s, a, n, trig, dig = parse(segs)
        found.append((np.array(doc, np.int64)[s], a + np.array(base, np.int64)[s], n, trig, dig))

    for i, t in enumerate(block["text"]):
        b = t.encode() if t else b""
        for at in range(0, max(0, len(b) - LENGTH + 1), PIECE):
            segs.append(b[at:at + PIECE + LENGTH - 1])
            doc.append(i)
            base.append(at)
            held += len(segs[-1])
            if held >= PIECE:
                flush()
                segs, doc, base, held = [], [], [], 0
    if segs:
        flush()
    if not found:
        return pd.DataFrame({c.split()[0]: [] for c in _ROW.split(", ")})
    d, pos, n, trig, dig = (np.concatenate(x) for x in zip(*found, strict=True))
    # phrases stand in corpus order; a stable sort keeps the first of each in front
    both = trig.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + dig.view(np.uint64)
    order = np.argsort(both, kind="stable")
    again = np.zeros(len(order), bool)
    again[order[1:]] = both[order[1:]] == both[order[:-1]]
    one = ~again
    md, ms, me = spans_union(d[again], pos[again], pos[again] + n[again])
    return pd.DataFrame({
        "kind": np.repeat(np.int32([1, 0]), [one.sum(), len(md)]),
        "trig": np.concatenate([trig[one], (md * np.int64(0x9E3779B1) + ms) ^ k[md]]), "dig": np.concatenate([dig[one], ms]),
        K: k[np.concatenate([d[one], md])], SEQ: seq[np.concatenate([d[one], md])],
        "pos": np.concatenate([pos[one], ms]), "len": np.concatenate([n[one], me - ms]).astype(np.int32)})


def _parse_rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    held, size = [], 0
    for part in batches:
        part = part[part["text"].str.len() > 0]
        sizes = part["text"].str.len().to_numpy()
        at = 0
        for i, n in enumerate(sizes.tolist()):
            size += n
            if size >= BLOCK:
                yield _block_rows(pd.concat([*held, part.iloc[at:i + 1]]))
                held, size, at = [], 0, i + 1
        held.append(part.iloc[at:])
    if held:
        yield _block_rows(pd.concat(held))


_PHRASE = f"hot int, trig long, dig long, {K} long, {SEQ} int, pos long, body binary"


def _dictionary_rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Bytes of the asked phrases; of hot triggers, the hashes of their windows."""
    for part in batches:
        out = []
        for k, seq, text, asks in zip(part[K], part[SEQ], part["text"], part["asks"], strict=True):
            b = text.encode()
            for ask in asks:
                trig, pos, n, hot = ask["trig"], ask["pos"], ask["len"], ask["hot"]
                if not hot:
                    out.append((0, trig, 0, k, seq, pos, b[pos:pos + n]))
                    continue
                for p in range(pos, pos + n - LENGTH + 1):
                    h = xxhash.xxh3_128_intdigest(b[p:p + LENGTH])
                    hi, lo = h >> 64, h & ((1 << 64) - 1)
                    out.append((1, hi - ((hi >> 63) << 64), lo - ((lo >> 63) << 64), k, seq, p, None))
            if len(out) > 50_000:
                yield pd.DataFrame(out, columns=[c.split()[0] for c in _PHRASE.split(", ")])
                out = []
        yield pd.DataFrame(out, columns=[c.split()[0] for c in _PHRASE.split(", ")])


def repeated_windows(bodies: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(body, offset) of every window that also starts earlier in the bodies' order."""
    size = np.array([len(b) for b in bodies], np.int64)
    end = np.cumsum(size)
    body = np.repeat(np.arange(len(size)), size)
    raw = np.frombuffer(b"".join(bodies), np.uint8)
    p = np.flatnonzero(np.arange(len(raw)) <= end[body] - LENGTH)
    windows = np.lib.stride_tricks.sliding_window_view(raw, LENGTH)[p]
    words = np.ascontiguousarray(windows).view(f"S{LENGTH}").ravel()
    suffixes = np.argsort(words, kind="stable")
    ordered = words[suffixes]
    again = suffixes[1:][ordered[1:] == ordered[:-1]]
    return body[p[again]], p[again] - (end - size)[body[p[again]]]


def _array_marks(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Rows sorted by (hot, trig, dig, corpus order) -> removed spans."""
    def marks(part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values([K, SEQ, "pos"])
        b, off = repeated_windows(part["body"].tolist())
        b, s, e = spans_union(b, off, off + LENGTH)
        return pd.DataFrame({K: part[K].to_numpy()[b], SEQ: part[SEQ].to_numpy()[b],
                             "pos": part["pos"].to_numpy()[b] + s, "len": (e - s).astype(np.int32)})

    held, size, seen = [], 0, None
    for part in batches:
        hot = part[part["hot"] == 1]
        if len(hot):
            t, d = hot["trig"].to_numpy(), hot["dig"].to_numpy()
            again = np.concatenate([[seen == (t[0], d[0])], (t[1:] == t[:-1]) & (d[1:] == d[:-1])])
            seen = (t[-1], d[-1])
            yield hot.loc[again, [K, SEQ, "pos"]].assign(len=np.int32(LENGTH))
        part = part[part["hot"] == 0].reset_index(drop=True)
        if not len(part):
            continue
        t = part["trig"].to_numpy()
        heads = np.concatenate([[0], np.flatnonzero(t[1:] != t[:-1]) + 1, [len(t)]]).tolist()
        sizes = np.concatenate([[0], np.cumsum(part["body"].str.len().to_numpy())])
        for a, z in zip(heads[:-1], heads[1:], strict=True):
            if held and size >= ARRAY and held[-1]["trig"].iloc[-1] != t[a]:
                yield marks(pd.concat(held))
                held, size = [], 0
            held.append(part.iloc[a:z])
            size += int(sizes[z] - sizes[a])
    if held:
        yield marks(pd.concat(held))


def _keyed(docs: DataFrame) -> DataFrame:
    """Adds the row key: the id (null: the least), and a number among rows of one id."""
    key = F.coalesce(F.col("doc_id").cast("long"), F.lit(-(1 << 63)))
    out = docs.withColumn(K, key)
    if out.groupBy(K).count().where("count > 1").isEmpty():
        return out.withColumn(SEQ, F.lit(0))
    return out.withColumn(SEQ, F.row_number().over(Window.partitionBy(K).orderBy(F.col("doc_id").isNotNull(), "text")))


def repeat_spans(keyed: DataFrame) -> DataFrame:
    """Removed spans (key columns, pos, len) of keyed texts; they may overlap."""
    texts = small_batches(keyed).select(K, SEQ, "text").where("text IS NOT NULL")
    rows = texts.mapInPandas(_parse_rows, _ROW)
    group = Window.partitionBy("kind", "trig")
    before = F.lag("dig").over(group.orderBy("dig", K, SEQ, "pos"))
    tagged = materialize(
        rows.withColumns({"again": F.coalesce(before == F.col("dig"), F.lit(False)),
                          "shared": F.min("dig").over(group) != F.max("dig").over(group)})
        .where("kind = 0 OR again OR shared")
        .select(F.when(F.expr("kind = 0 OR again"), 0).otherwise(1).alias("kind"), "trig", K, SEQ, "pos", "len"), "pfp-parse")
    asked = tagged.where("kind = 1")
    hot = materialize(asked.groupBy("trig").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > HOT)
                      .select("trig", F.lit(True).alias("hot")), "pfp-hot")
    # asking phrases stay where they are if the hot triggers are few; else both sides are shuffled
    asks = (asked.join(F.broadcast(hot) if hot.count() <= BROADCAST_TRIGGERS else hot, "trig", "left")
            .groupBy(K, SEQ).agg(F.collect_list(F.struct("trig", "pos", "len", F.coalesce("hot", F.lit(False)).alias("hot"))).alias("asks")))
    bodies = texts.join(asks, [K, SEQ]).mapInPandas(_dictionary_rows, _PHRASE)
    marks = materialize(
        bodies.repartition("trig").sortWithinPartitions("hot", "trig", "dig", K, SEQ, "pos")
        .mapInPandas(_array_marks, f"{K} long, {SEQ} int, pos long, len int"), "pfp-marks")
    return tagged.where("kind = 0").select(K, SEQ, "pos", "len").unionByName(marks)


_CUT = T.StructType([T.StructField("kept", T.BinaryType()), *[T.StructField(c, T.LongType()) for c in ("n_bytes", "n_removed", "n_spans")]])


@F.pandas_udf(_CUT)
def _cut(text: pd.Series, pos: pd.Series, length: pd.Series) -> pd.DataFrame:
    out = []
    for t, p, n in zip(text, pos, length, strict=True):
        b = t.encode() if t else b""
        if p is None or not len(p):
            out.append((b, len(b), 0, 0))
            continue
        p = np.asarray(p, np.int64)
        _, a, z = spans_union(np.zeros(len(p), np.int64), p, p + np.asarray(n, np.int64))
        edges = [0, *np.stack([a, z], 1).ravel().tolist(), len(b)]
        out.append((b"".join(b[x:y] for x, y in zip(edges[::2], edges[1::2], strict=True)), len(b), int((z - a).sum()), len(a)))
    return pd.DataFrame(out, columns=["kept", "n_bytes", "n_removed", "n_spans"])


def remove_repeats(docs: DataFrame) -> DataFrame:
    """Adds the struct ``repeats`` (kept bytes, n_bytes, n_removed, n_spans) to each row."""
    keyed = _keyed(docs)
    spans = repeat_spans(keyed).groupBy(K, SEQ).agg(F.collect_list(F.struct("pos", "len")).alias("_pfp_spans"))
    at = F.col("_pfp_spans")
    return (keyed.join(spans, [K, SEQ], "left")
            .withColumn("repeats", _cut("text", F.transform(at, lambda s: s["pos"]), F.transform(at, lambda s: s["len"])))
            .select(*docs.columns, "repeats"))


def query(docs: DataFrame) -> DataFrame:
    return remove_repeats(docs.select("doc_id", "text")).select(
        "doc_id", "repeats.n_bytes", "repeats.n_removed", "repeats.n_spans",
        F.sha2("repeats.kept", 256).alias("kept_sha256"))


def without_repeats(docs: DataFrame) -> DataFrame:
    """The rows with repeated strings cut from their texts; n_chars follows. Bytes of a
    character cut in two go with it. A null text stays null; a text removed whole is empty."""
    rows, back = shielded(docs, ["repeats", K, SEQ, "_pfp_spans"])
    out = remove_repeats(rows)
    text = F.when(F.col("text").isNotNull(), _decode("repeats.kept"))
    out = out.withColumn("text", text)
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return out.select(*rows.columns).withColumnsRenamed(back)


@F.pandas_udf(T.StringType())
def _decode(kept: pd.Series) -> pd.Series:
    return pd.Series([b.decode("utf-8", "ignore") for b in kept], dtype=object)
