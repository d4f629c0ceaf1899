"""Language identification with interpolated Kneser-Ney character models.

Letters are lower-cased; white space and all that is no letter is symbol 0, marks are
left out, and every other letter is its code point (those above 65,535 share 8,448
symbols that no letter has), so a 4-gram is a 64-bit key and any alphabet keeps its
letters apart. Counts come from every training text in one pass: each task counts its
texts' 4-grams, and Spark sums them by language and 4-gram, each 4-gram by itself.
Lower orders use continuation counts, which follow from the 4-gram types alone.

A language's model is a set of arrays of its own: for each order hashed keys, sorted by
hash, beside log probabilities, and contexts with their back-off weights. Tasks build
them, each from a group of languages or from a part of a large one, and write them to
the shared folder. The 4-grams of a part share their middle two symbols' hash, so it
holds all that orders 3 and 4 need; a large language's bigrams are in each of its parts.
Tasks score the distinct 4-grams of a batch part by part and language by language, with
a running minimum, so memory follows neither the number of languages nor the size of
one; files are kept in a cache of bounded size. A text goes to the language of the
lowest cross-entropy per symbol.

Rejection is calibrated on texts as if they were new: a second pass over all
training texts gives the mean H and variance V of the code length of a symbol in
each language, where a 4-gram that no other text holds is coded as unseen. Copies
and most near copies share a sketch (the least hash of their runs of 16 symbols);
texts of one sketch count as one text, by their average, as the model knows a text
that comes often by heart. A text of n symbols is rejected where its cross-entropy
exceeds slack * H + z * sqrt(rho * V / n), where rho allows for neighbouring
symbols that depend on each other.

Defined results: null text, or text without a letter: ``und``, score 0, not
accepted. If nothing was learned, every text is ``und``. Very long texts are
scored whole, in pieces. Ties go to the language that sorts first. Repeated rows
count as often as they occur in the language models, and once in the calibration.
Extra columns pass through.
"""

from __future__ import annotations

import io
import unicodedata
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clicklens.llm.common import id_crc, materialize, shielded, slices, small_batches
from clicklens.llm.files import make_folder, read_file, write_file
from clicklens.session import scratch_path

ORDER = 4
BITS = 16
UNKNOWN = "und"
# 4-gram types that a task builds models from; a language of more has several parts.
GROUP_TYPES = 1 << 20
# Bytes of models that a task keeps; beyond, they are read again.
CACHE_BYTES = 1 << 28
# Calibration of the rejection.
SLACK, Z, RHO = 1.5, 4.0, 8.0
_SPREAD = np.uint64(0x9E3779B97F4A7C15)
_DEAL = 1_640_531_527  # times 32 bits, it stays below 2**63
_DROP = 0xFFFF
_PIECE = 1 << 20


def _symbol(cp: int) -> int:
    ch = chr(cp)
    if unicodedata.category(ch).startswith("M"):
        return _DROP
    if not ch.isalpha():
        return 0
    low = ord(ch.lower()[0])
    return low if low < 1 << BITS else 0xD800 + low % 8448  # surrogates and private use hold no letters


_FOLD: list[np.ndarray] = []


def _fold_table() -> np.ndarray:
    """Symbols of all code points below 65,536, made once for each process."""
    if not _FOLD:
        _FOLD.append(np.array([0 if 0xD800 <= c <= 0xDFFF else _symbol(c) for c in range(1 << 16)], np.uint16))
    return _FOLD[0]


def _folded(text: str) -> np.ndarray:
    cps = np.frombuffer(text.encode("utf-32-le", "replace"), np.uint32)
    out = _fold_table()[np.minimum(cps, 0xFFFF)]
    high = cps > 0xFFFF
    if high.any():
        kinds, which = np.unique(cps[high], return_inverse=True)
        out[high] = np.array([_symbol(int(c)) for c in kinds], np.uint16)[which]
    return out[out != _DROP]


def symbols(text: str) -> np.ndarray:
    """Symbols of a text: runs of symbol 0 are one, none at either end."""
    out = np.concatenate([_folded(text[a:a + _PIECE]) for a in range(0, len(text), _PIECE)]) if text else np.empty(0, np.uint16)
    keep = out != 0
    keep[1:] |= out[:-1] != 0
    out = out[keep]
    if len(out) and out[0] == 0:
        out = out[1:]
    return out[:-1] if len(out) and out[-1] == 0 else out


def _windows(s: np.ndarray) -> np.ndarray:
    """Keys of all 4-grams of a row of symbols."""
    n = len(s) - ORDER + 1
    keys = np.zeros(n, np.uint64)
    for i in range(ORDER):
        keys <<= np.uint64(BITS)
        keys |= s[i:i + n]
    return keys


_LEAD, _END = np.zeros(ORDER - 1, np.uint16), np.zeros(1, np.uint16)


def _grams(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """4-gram keys of all texts in turn, and how many keys each text has.

    Each text stands between blanks; one without letters has no keys."""
    parts, sizes = [], []
    for t in texts:
        s = symbols(t)
        sizes.append(len(s) + 1 if len(s) else 0)
        if len(s):
            parts += [_LEAD, s, _END]
    sizes = np.array(sizes, np.int64)
    if not parts:
        return np.empty(0, np.uint64), sizes
    keys = _windows(np.concatenate(parts))
    full = sizes[sizes > 0]
    # a text's keys are followed by ORDER-1 windows that reach into the next one
    inside = np.ones(len(keys), bool)
    ends = np.cumsum(full + ORDER - 1)[:-1]
    for i in range(1, ORDER):
        inside[ends - i] = False
    return keys[inside], sizes


def _sketches(keys: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The least hash of 16 symbols of each text that has keys: one number for copies and most near copies."""
    last = np.repeat(np.cumsum(sizes) - 1, sizes)
    at, h = np.arange(len(keys)), keys
    for _ in range(3):
        at = np.minimum(at + ORDER, last)
        h = (h ^ h >> np.uint64(31)) * _SPREAD + keys[at]
    h = (h ^ h >> np.uint64(32)) * _SPREAD
    return np.minimum.reduceat(h ^ h >> np.uint64(29), np.cumsum(sizes) - sizes)


def _chunks(texts: list[str | None], sketched: bool = True) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray | None]]:
    """(text numbers, keys, sizes, sketches) of about ``_PIECE`` keys at a time; texts without keys are left out.

    A longer text comes in pieces, under one sketch."""
    def sketches(keys: np.ndarray, sizes: np.ndarray) -> np.ndarray | None:
        return _sketches(keys, sizes) if sketched else None

    texts = [t or "" for t in texts]
    for a, b in slices(texts, _PIECE):
        if b - a == 1 and len(texts[a]) > _PIECE:
            s = symbols(texts[a])
            if len(s):
                s = np.concatenate([_LEAD, s, _END])
                cuts = range(0, len(s) - ORDER + 1, _PIECE)
                whole = min(_sketches(k, np.array([len(k)])) for k in (_windows(s[c:c + _PIECE + ORDER - 1]) for c in cuts)) if sketched else None
                for c in cuts:
                    keys = _windows(s[c:c + _PIECE + ORDER - 1])
                    yield np.array([a]), keys, np.array([len(keys)]), whole
            continue
        keys, sizes = _grams(texts[a:b])
        if len(keys):
            own = np.flatnonzero(sizes)
            yield a + own, keys, sizes[own], sketches(keys, sizes[own])


def _trained(rows: DataFrame) -> DataFrame:
    return small_batches(rows).where("text IS NOT NULL AND lang IS NOT NULL").select("text", "lang")


def count_grams(rows: DataFrame, slots: int | None = None) -> DataFrame:
    """(text, lang) -> (lang, gram, n, alone) over all rows with both values; ``alone``: all its texts share a sketch.

    Every 4-gram of a language is a row. Only a caller that gives ``slots`` gets at most so
    many rows a language, where 4-grams that share a slot are one row; no model is built so."""
    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in batches:
            for lang, texts in part.groupby("lang")["text"]:
                for _, keys, sizes, sketches in _chunks(texts.tolist()):
                    code, kinds = pd.factorize(keys)
                    sketch = np.repeat(sketches.view(np.int64), sizes)
                    low, high = np.full(len(kinds), np.iinfo(np.int64).max), np.full(len(kinds), np.iinfo(np.int64).min)
                    np.minimum.at(low, code, sketch)
                    np.maximum.at(high, code, sketch)
                    yield pd.DataFrame({"lang": lang, "gram": kinds.view(np.int64), "n": np.bincount(code), "low": low, "high": high})

    return (_trained(rows).mapInPandas(count, "lang string, gram long, n long, low long, high long")
            .groupBy("lang", (F.col("gram") if slots is None else F.pmod(F.xxhash64("gram"), F.lit(slots))).alias("slot"))
            .agg(F.min("gram").alias("gram"), F.sum("n").alias("n"), (F.min("low") == F.max("high")).alias("alone")).drop("slot"))


def _hashed(keys: np.ndarray) -> np.ndarray:
    return keys.astype(np.uint64) * _SPREAD  # odd factor: no two keys share a hash


def _find(sorted_hashes: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    h = _hashed(keys)
    if not len(sorted_hashes):
        return np.zeros(len(keys), np.int64), np.zeros(len(keys), bool)
    at = np.searchsorted(sorted_hashes, h)
    at[at == len(sorted_hashes)] = 0
    return at, sorted_hashes[at] == h


def _tail(keys: np.ndarray, order: int) -> np.ndarray:
    """The last ``order`` symbols of keys."""
    return keys & np.uint64((1 << BITS * order) - 1)


def _part(keys: np.ndarray, parts: int) -> np.ndarray:
    """The part of a model that each key is in, by its middle two symbols."""
    middle = keys.astype(np.uint64) >> np.uint64(BITS) & np.uint64((1 << 2 * BITS) - 1)
    return (middle * np.uint64(_DEAL) >> np.uint64(20)) % np.uint64(parts)


def _part_column(parts: Column) -> Column:
    """:func:`_part` of the column ``gram``."""
    middle = F.shiftright("gram", BITS).bitwiseAND(F.lit((1 << 2 * BITS) - 1).cast("long"))
    return F.pmod(F.shiftright(middle * F.lit(_DEAL).cast("long"), 20), parts).cast("int")


def _discount(once: float, twice: float) -> float:
    return min(0.95, max(0.05, once / (once + 2 * twice))) if once else 0.5


class KneserNey:
    """Sorted hash arrays of one language; ``levels[n]`` and ``contexts[n]`` are for order n.

    ``alphabet``: how many symbols an unseen one is taken from. If the 4-grams are only a part
    of the language's, ``bigrams`` (keys and continuation counts) and ``discounts`` (by order) of
    the whole language are given."""

    def __init__(self, keys: np.ndarray, n: np.ndarray, alone: np.ndarray, alphabet: int,
                 bigrams: tuple[np.ndarray, np.ndarray] | None = None, discounts: dict[int, float] | None = None) -> None:
        order = np.argsort(keys)
        keys, n = np.asarray(keys, np.uint64)[order], np.asarray(n, np.float64)[order]
        self.base, self.alone = np.float32(-np.log(alphabet)), keys[np.asarray(alone, bool)[order]]
        raw = {ORDER: (keys, n)}
        for m in range(ORDER - 1, 0, -1):  # how many symbols come before: types of one order more
            below, kinds = np.unique(_tail(raw[m + 1][0], m), return_counts=True)
            raw[m] = (below, kinds.astype(np.float64)) if m != 2 or bigrams is None else bigrams
        self.levels: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        self.contexts: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        for m in range(1, ORDER + 1):
            types, count = raw[m]
            d = (discounts or {}).get(m) or _discount(float((count == 1).sum()), float((count == 2).sum()))
            ctx, at = np.unique(types >> np.uint64(BITS), return_inverse=True)
            total, kinds = np.bincount(at, count), np.bincount(at)
            weight = d * kinds / total
            p = (count - d) / total[at] + weight[at] * np.exp(self.log(_tail(types, m - 1), m - 1))
            for store, own, values in ((self.contexts, ctx, weight), (self.levels, types, p)):
                h = _hashed(own)
                order = np.argsort(h)
                store[m] = (h[order], np.log(values[order]).astype(np.float32))
        # code length of a training symbol, from the counts alone until ``calibrate``
        cost = -self.log(keys, ORDER).astype(np.float64)
        once = n == 1  # without its own text such a 4-gram is unseen, as it would be in a new text
        cost[once] = -self.backed_off(keys[once], ORDER)
        self.mean = float(np.average(cost, weights=n)) if len(n) else 0.0
        self.var = float(np.average((cost - self.mean) ** 2, weights=n)) if len(n) else 0.0

    def log(self, keys: np.ndarray, order: int = ORDER) -> np.ndarray:
        """Log probability of each key's last symbol given those before."""
        out = np.full(len(keys), self.base, np.float32)
        if not order:
            return out
        hashes, logs = self.levels[order]
        at, hit = _find(hashes, keys)
        out[hit] = logs[at[hit]]
        if not hit.all():
            out[~hit] = self.backed_off(keys[~hit], order)
        return out

    def backed_off(self, keys: np.ndarray, order: int = ORDER) -> np.ndarray:
        """The same for keys taken as unseen: the next lower order, by the weight of their context."""
        below = self.log(_tail(keys, order - 1), order - 1)
        hashes, logs = self.contexts[order]
        at, known = _find(hashes, keys >> np.uint64(BITS))
        below[known] += logs[at[known]]
        return below

    def as_new(self, keys: np.ndarray) -> np.ndarray:
        """Log probabilities for a training text: 4-grams that no other text holds are unseen."""
        out = self.log(keys)
        if len(self.alone):
            new = self.alone[np.minimum(np.searchsorted(self.alone, keys), len(self.alone) - 1)] == keys
            out[new] = self.backed_off(keys[new])
        return out

    def size(self) -> int:
        return self.alone.nbytes + sum(a.nbytes for store in (self.levels, self.contexts) for pair in store.values() for a in pair)

    def to_bytes(self) -> bytes:
        out = io.BytesIO()
        arrays = {f"{name}{m}{i}": a for name, store in (("l", self.levels), ("c", self.contexts)) for m, pair in store.items() for i, a in enumerate(pair)}
        np.savez(out, alone=self.alone, base=self.base, **arrays)
        return out.getvalue()

    @classmethod
    def from_bytes(cls, data: bytes) -> KneserNey:
        own, held = cls.__new__(cls), np.load(io.BytesIO(data))
        own.alone, own.base = held["alone"], np.float32(held["base"])
        own.levels, own.contexts = ({m: (held[f"{name}{m}0"], held[f"{name}{m}1"]) for m in range(1, ORDER + 1)} for name in "lc")
        return own


class Models:
    """The languages' models by file, in sorted order, with the calibration of each."""

    def __init__(self, folder: str | None = None) -> None:
        self.folder, self.langs, self.parts, self.mean, self.var = folder, [], [], [], []
        self._cache: dict[tuple[int, int], KneserNey] = {}

    def add(self, lang: str, model: KneserNey | None = None, parts: int = 1) -> None:
        """Adds the next language; they come in sorted order. Without ``model`` its parts are in files."""
        if model is not None:
            self._cache[len(self.langs), 0] = model
        self.langs.append(lang)
        self.parts.append(parts)
        self.mean.append(model.mean if model is not None else 0.0)
        self.var.append(model.var if model is not None else 0.0)

    def path(self, j: int, part: int) -> str:
        return f"{self.folder}/{j}-{part}.npz"

    def __getstate__(self) -> dict:
        return {**self.__dict__, "_cache": {} if self.folder else self._cache}

    def model(self, j: int, part: int = 0) -> KneserNey:
        if (j, part) not in self._cache:
            new = KneserNey.from_bytes(read_file(self.path(j, part)))
            if new.size() + sum(m.size() for m in self._cache.values()) > CACHE_BYTES:
                self._cache.clear()
            self._cache[j, part] = new
        return self._cache[j, part]

    def logs(self, j: int, keys: list[np.ndarray], as_new: bool = False) -> list[np.ndarray]:
        """Log probabilities in language j of the keys of each array, by one part of its model at a time."""
        out = [np.empty(len(k), np.float32) for k in keys]
        where = [_part(k, self.parts[j]) for k in keys] if self.parts[j] > 1 else []
        for part in range(self.parts[j]):
            own = [np.flatnonzero(w == part) for w in where] or [slice(None)] * len(keys)
            if where and not any(len(at) for at in own):
                continue
            model = self.model(j, part)
            for held, k, at in zip(out, keys, own, strict=True):
                held[at] = model.as_new(k[at]) if as_new else model.log(k[at])
        return out

    def code_lengths(self, texts: list[str], lang: str) -> pd.DataFrame:
        """sketch, n, cost and squares (sums over the symbols) of the texts of ``lang`` that have symbols."""
        j = self.langs.index(lang)
        sums, sketch = np.zeros((len(texts), 3)), np.zeros(len(texts), np.int64)
        for own, keys, sizes, sketches in _chunks(texts):
            code, kinds = pd.factorize(keys)
            cost, begins = -self.logs(j, [kinds], as_new=True)[0].astype(np.float64), np.cumsum(sizes) - sizes
            sums[own] += np.stack([sizes, np.add.reduceat(cost[code], begins), np.add.reduceat((cost * cost)[code], begins)], axis=1)
            sketch[own] = sketches.view(np.int64)
        some = sums[:, 0] > 0
        return pd.DataFrame({"sketch": sketch[some], "n": sums[some, 0].astype(np.int64), "cost": sums[some, 1], "squares": sums[some, 2]})

    def decide(self, texts: list[str | None]) -> pd.DataFrame:
        """lang_pred, score, cross_entropy and accepted of each text."""
        count = len(texts)
        size, low, best, odds = np.zeros(count, np.int64), np.full(count, np.inf), np.zeros(count, np.int64), np.zeros(count)
        parts = []
        for own, keys, sizes, _ in _chunks(texts, sketched=False) if self.langs else ():
            size[own] += sizes
            code, kinds = pd.factorize(keys)
            parts.append((own, code.astype(np.int32), kinds, np.cumsum(sizes) - sizes))
        some = size > 0
        n = np.maximum(size, 1)
        temper = 4 * np.sqrt(n)  # the text's evidence counts by the root of its length
        for j in range(len(self.langs)):
            total = np.zeros(count)
            for (own, code, _, begins), logs in zip(parts, self.logs(j, [kinds for _, _, kinds, _ in parts]), strict=True):
                total[own] -= np.add.reduceat(logs.astype(np.float64)[code], begins)
            h = total / n
            with np.errstate(invalid="ignore", over="ignore"):
                less = h < low
                odds = np.where(less, odds * np.exp(-(low - h) * temper) + 1 if j else 1.0, odds + np.exp(-(h - low) * temper))
            best[less], low = j, np.minimum(low, h)
        mean, var = (np.array(v)[best] if self.langs else np.zeros(count) for v in (self.mean, self.var))
        limit = SLACK * mean + Z * np.sqrt(RHO * var / n)
        names = np.array([*self.langs, UNKNOWN], object)
        return pd.DataFrame({"lang_pred": names[np.where(some, best, len(self.langs))], "score": np.where(some, 1 / np.maximum(odds, 1), 0.0),
                             "cross_entropy": np.where(some, low, 0.0), "accepted": some & (low <= limit)})


def _groups(sizes: Iterable[tuple[str, int]], limit: int) -> Iterator[list[str]]:
    """Languages in sorted order, dealt to groups of at most ``limit`` types, one language at least."""
    own, held = [], 0
    for lang, n in sorted(sizes):
        if own and held + n > limit:
            yield own
            own, held = [], 0
        own.append(lang)
        held += n
    if own:
        yield own


def _continued(grams: DataFrame, order: int) -> DataFrame:
    """(lang, gram, n): the types of an order, from those of one order more."""
    return grams.groupBy("lang", F.col("gram").bitwiseAND(F.lit((1 << BITS * order) - 1).cast("long")).alias("gram")).agg(F.count(F.lit(1)).alias("n"))


def _whole_counts(counts: DataFrame, large: list[str]) -> tuple[DataFrame, dict[str, int], dict[str, dict[int, float]]]:
    """Bigrams of the languages ``large`` with continuation counts, how many each has, and the discounts of orders 3 and 4."""
    fours = counts.where(F.col("lang").isin(large))
    threes = _continued(fours, 3)
    twos = materialize(_continued(threes, 2), "langid-bigrams")
    seen = {m: {r["lang"]: _discount(r["once"], r["twice"]) for r in rows.groupBy("lang").agg(
        F.count_if(F.col("n") == 1).alias("once"), F.count_if(F.col("n") == 2).alias("twice")).collect()} for m, rows in ((3, threes), (4, fours))}
    sizes = {r["lang"]: r["n"] for r in twos.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}
    return twos, sizes, {lang: {m: seen[m][lang] for m in seen} for lang in large}


def train(rows: DataFrame) -> Models:
    """Fits on all rows (text, lang) that have both. A task builds the arrays of a group of small languages,
    or of a part of a large one, from about ``GROUP_TYPES`` 4-gram types; the driver sees one row a language."""
    spark = rows.sparkSession
    counts = materialize(count_grams(rows), "langid-counts")
    sizes = {r["lang"]: r["n"] for r in counts.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}
    alphabet = counts.select(F.col("gram").bitwiseAND(F.lit((1 << BITS) - 1).cast("long"))).distinct().count() + 1
    models = Models(scratch_path(spark, "langid-models"))
    make_folder(models.folder)
    large = sorted(lang for lang, n in sizes.items() if n > GROUP_TYPES)
    twos, bigrams, discounts = _whole_counts(counts, large) if large else (None, {}, {})
    dealt, groups = [], 0
    for group in _groups(sizes.items(), GROUP_TYPES):
        # never more copies of bigrams than 4-grams
        parts = -(-sizes[group[0]] // max(GROUP_TYPES, bigrams[group[0]])) if group[0] in bigrams else 1
        for lang in group:
            dealt.append((lang, len(models.langs), groups, parts))
            models.add(lang, parts=parts)
        groups += parts

    def build(own: pd.DataFrame) -> pd.DataFrame:
        done = []
        for (j, part), types in own.groupby(["j", "part"]):
            four, two = types[types["four"]], types[~types["four"]]
            whole = (two["gram"].to_numpy().view(np.uint64), two["n"].to_numpy(np.float64)) if models.parts[j] > 1 else None
            model = KneserNey(four["gram"].to_numpy().view(np.uint64), four["n"].to_numpy(), four["alone"].to_numpy(bool), alphabet,
                              whole, discounts.get(models.langs[j]))
            write_file(models.path(j, part), model.to_bytes())
            done.append((j, part))
        return pd.DataFrame(done, columns=["j", "part"])

    if dealt:
        deal = F.broadcast(spark.createDataFrame(dealt, "lang string, j int, first int, parts int"))
        types = counts.join(deal, "lang").select("j", "first", _part_column(F.col("parts")).alias("part"), "gram", "n", "alone", F.lit(True).alias("four"))
        if large:
            types = types.unionByName(twos.join(deal, "lang").select(
                "j", "first", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"), "gram", "n", F.lit(False).alias("alone"), F.lit(False).alias("four")))
        types.groupBy((F.col("first") + F.col("part")).alias("group")).applyInPandas(build, "j int, part int").write.format("noop").mode("overwrite").save()
    calibrate(rows, models)
    return models


def calibrate(rows: DataFrame, models: Models) -> None:
    """Sets the models' mean and variance from all training rows; texts that share a sketch count as one."""
    if not models.langs:
        return

    def lengths(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known = set(models.langs)  # a language whose texts hold no letter has no model
        for part in batches:
            for lang, texts in part.groupby("lang")["text"]:
                if lang in known:
                    yield models.code_lengths(texts.tolist(), lang).assign(lang=lang)

    total = F.sum("n")
    groups = (_trained(rows).mapInPandas(lengths, "sketch long, n long, cost double, squares double, lang string")
              .groupBy("lang", "sketch").agg(F.avg("n").alias("size"), (F.sum("cost") / total).alias("cost"), (F.sum("squares") / total).alias("squares")))
    size = F.sum("size")
    found = groups.groupBy("lang").agg((F.sum(F.col("size") * F.col("cost")) / size).alias("mean"),
                                       (F.sum(F.col("size") * F.col("squares")) / size).alias("squares"))
    place = {lang: j for j, lang in enumerate(models.langs)}
    for r in found.collect():
        j = place[r["lang"]]
        models.mean[j], models.var[j] = r["mean"], max(r["squares"] - r["mean"] ** 2, 0.0)


def identify(docs: DataFrame, model: Models, text: str = "text") -> DataFrame:
    """Adds the struct ``langid`` (lang_pred, score, cross_entropy, accepted)."""
    @F.pandas_udf("lang_pred string, score double, cross_entropy double, accepted boolean")
    def decide(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for s in batches:
            yield model.decide(s.tolist())

    return small_batches(docs).withColumn("langid", decide(F.col(text)))


def held_out() -> Column:
    return F.pmod(id_crc(), F.lit(4)) == 2


def query(docs: DataFrame) -> DataFrame:
    model = train(docs.where(~held_out()))
    return (identify(docs.select("doc_id", "text"), model)
            .select("doc_id", held_out().alias("held_out"), "langid.lang_pred", "langid.score",
                    "langid.cross_entropy", "langid.accepted"))


def keep_identified(docs: DataFrame) -> DataFrame:
    """The rows whose language is known; rejected texts go."""
    model = train(docs.where(~held_out()))
    rows, back = shielded(docs, ["langid"])
    return identify(rows, model).where("langid.accepted").select(*rows.columns).withColumnsRenamed(back)
