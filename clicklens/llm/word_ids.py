"""Token ids of whole texts, a batch at a time, by the tokenizers library.

Arrow splits a batch at ASCII blanks and numbers its distinct words; Python sees
each distinct word of a batch once, and the library each one of a task once. The
texts' ids are then one ``take`` over the words' ids, with no work for each word
in Python.
"""

from __future__ import annotations

import os
import sys
import types
import unicodedata
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

# Bytes of text encoded at a time, and words kept in a worker's cache.
BATCH, CACHE = 1 << 23, 700_000
# A control character that stands between words encoded together, and how many are.
MARK, JOINED = "\x01", 300
SPECIAL, STOPS = "<|", b".,;:!?"


def id_type(vocab_size: int) -> str:
    return "<u2" if vocab_size <= 1 << 16 else "<u4"


def _kept(name: str) -> dict[bytes, bytes]:
    """A dictionary that this process keeps from task to task; globals of functions sent by value aren't."""
    home = sys.modules.setdefault("clicklens_worker_state", types.ModuleType("clicklens_worker_state"))
    return vars(home).setdefault(name, {})


def _byte_letters() -> dict[int, int]:
    """The letter that stands for each byte: printable Latin-1 ones for themselves, the rest from 256 on."""
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(own)]
    return {b: b for b in own} | {b: 256 + i for i, b in enumerate(rest)}


def _chunks(texts: pa.Array) -> Iterator[pa.Array]:
    """Runs of rows with about ``BATCH`` bytes, one row at least."""
    ends = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False), dtype=np.int64)
    at = 0
    while at < len(texts):
        held = int(ends[at - 1]) if at else 0
        end = max(at + 1, int(np.searchsorted(ends, held + BATCH, "right")))
        yield texts.slice(at, end - at)
        at = end


class WordEncoder:
    """The tokenizers library, asked once for each distinct word.

    The pre-tokenizer drops white space and never reaches over it, and the
    normalizer composes no character with a blank, so a text's ids are those of
    its blank-separated words in turn. Only ASCII blanks are used for that.
    """

    def __init__(self, tokenizer_json: str) -> None:
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        self.tokenizer = Tokenizer.from_str(tokenizer_json)
        self.kind = id_type(self.tokenizer.get_vocab_size())
        self.mark = self.tokenizer.encode(MARK, add_special_tokens=False).ids
        self.cache = _kept(f"word_ids_{len(tokenizer_json)}_{zlib.crc32(tokenizer_json.encode())}")
        self.letters = _byte_letters()

    def __call__(self, texts: pa.Array) -> list[bytes]:
        """Ids of each text (null: none) as little-endian unsigned integers of type ``kind``."""
        out: list[bytes] = []
        for part in _chunks(texts.cast(pa.large_string())):
            words = pc.ascii_split_whitespace(pc.ascii_trim_whitespace(pc.fill_null(part, "")))
            coded = words.flatten().dictionary_encode()
            distinct = coded.dictionary
            # ASCII letters are folded here; the normalizer folds them too, but looks for special tokens before that
            if not pc.any(pc.match_substring(distinct, SPECIAL)).as_py():
                distinct = pc.ascii_lower(distinct)
            found = self._ids(distinct.cast(pa.large_binary()).to_numpy(zero_copy_only=False).tolist())
            ids = pa.array(found, pa.large_binary()).take(coded.indices)
            ends = np.frombuffer(ids.buffers()[1], np.int64, len(ids) + 1, 8 * ids.offset)
            flat, edges = memoryview(ids.buffers()[2] or b""), ends[words.offsets.to_numpy()].tolist()
            out += [bytes(flat[a:b]) for a, b in zip(edges[:-1], edges[1:], strict=True)]
        return out

    def _ids(self, words: list[bytes]) -> list[bytes]:
        found = list(map(self.cache.get, words))
        new = {w for w, ids in zip(words, found, strict=True) if ids is None}
        if not new:
            return found
        if len(self.cache) + len(new) > CACHE:
            self.cache.clear()
            new = set(words)
        self._learn(new)
        return list(map(self.cache.__getitem__, words))

    def _learn(self, words: set[bytes]) -> None:
        # a word and the stops behind it are apart for the pre-tokenizer
        core = {w: c for w in words if (c := w.rstrip(STOPS)) != w and c[-1:].isalnum()}
        left = words.difference(core).union(w[len(c):] for w, c in core.items()).union(core.values()).difference(self.cache)
        plain = [w for w in left if self._one_token_run(w.decode())]
        tokens, flat, ends = self.tokenizer.model.tokenize, [], [0]
        for w in plain:
            flat += [t.id for t in tokens(w.decode("latin-1").translate(self.letters))]
            ends.append(len(flat))
        self._keep(plain, np.array(flat, self.kind), ends[:-1], ends[1:])
        self._learn_marked(left.difference(plain))
        self.cache.update((w, self.cache[c] + self.cache[w[len(c):]]) for w, c in core.items())

    def _keep(self, words: list[bytes], ids: np.ndarray, begins: list[int], ends: list[int]) -> None:
        flat, n = ids.tobytes(), ids.itemsize
        self.cache.update((w, flat[n * a:n * z]) for w, a, z in zip(words, begins, ends, strict=True))

    @staticmethod
    def _one_token_run(word: str) -> bool:
        """Letters that the normalizer leaves alone and the pre-tokenizer keeps together."""
        return word.isalpha() and (word.isascii() or word == word.lower() and unicodedata.is_normalized("NFC", word))

    def _learn_marked(self, words: set[bytes]) -> None:
        """Many words in one call: a mark between them, a word of its own with one id, shows where each ends."""
        words = list(words)
        plain = [w for w in words if MARK.encode() not in w] if len(self.mark) == 1 else []
        parts = [plain[at:at + JOINED] for at in range(0, len(plain), JOINED)]
        texts = [f" {MARK} ".encode().join(p).decode() for p in parts]
        for part, found in zip(parts, self.tokenizer.encode_batch_fast(texts, add_special_tokens=False), strict=True):
            ids = np.array(found.ids, self.kind)
            cuts = np.flatnonzero(ids == self.mark[0])
            if len(cuts) != len(part) - 1:
                raise ValueError("the tokenizer doesn't keep words apart")
            self._keep(part, ids, [0, *(cuts + 1).tolist()], [*cuts.tolist(), len(ids)])
        for w in words:
            if w not in self.cache:
                self.cache[w] = np.array(self.tokenizer.encode(w.decode(), add_special_tokens=False).ids, self.kind).tobytes()
