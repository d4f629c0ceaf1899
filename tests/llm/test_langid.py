"""Language models: counts, Kneser-Ney sums, held-out accuracy, rejection and edge cases."""

import zlib
from collections import Counter

import numpy as np
import pytest
from conftest import SF_CHECK

from clicklens.llm import langid_kn as L


def grams(text):
    s = L.symbols(text).tolist()
    s = [0, 0, 0, *s, 0] if s else []
    return [(s[i] << 48) | (s[i + 1] << 32) | (s[i + 2] << 16) | s[i + 3] for i in range(len(s) - 3)]


TEXTS = ["Hello, World", "", "é́ÀΩ中\U00010330 123", "a", " -- ", "ab" * 500]


def test_keys_of_texts():
    keys, sizes = L._grams(TEXTS)
    assert keys.tolist() == [k for t in TEXTS for k in grams(t)]
    assert sizes.tolist() == [len(grams(t)) for t in TEXTS]


def test_symbols():
    assert L.symbols(" Ab--c\u0301 \u4e2d\U00010330\U00010331 1").tolist() == [97, 98, 0, 99, 0, 0x4e2d, 0xD800 + 0x10330 % 8448, 0xD800 + 0x10331 % 8448]


def test_chunks_of_long_texts(monkeypatch):
    monkeypatch.setattr(L, "_PIECE", 10)
    texts = [*TEXTS, None, "abc " * 30, "\u0301" * 25, "x"]
    found, sketch = {}, {}
    for own, keys, sizes, sketches in L._chunks(texts):
        at = 0
        for i, n, h in zip(own.tolist(), sizes.tolist(), sketches.tolist(), strict=True):
            found.setdefault(i, []).extend(keys[at:at + n].tolist())
            assert sketch.setdefault(i, h) == h
            at += n
    assert found == {i: grams(t) for i, t in enumerate(texts) if t and grams(t)}


def test_counts(spark, monkeypatch):
    monkeypatch.setattr(L, "_PIECE", 10)
    rows = [(t, lang) for i, t in enumerate(TEXTS) for lang in ("x", "y") if i % 2 or lang == "x"] + [(None, "x"), ("abc", None)]
    df = spark.createDataFrame(rows, "text string, lang string")
    got = {(r.lang, r.gram % (1 << 64)): r.n for r in L.count_grams(df).collect()}
    want = Counter((lang, k) for t, lang in rows if t and lang for k in grams(t))
    assert got == want
    few = L.count_grams(df, 3).collect()
    assert len(few) <= 6 and sum(r.n for r in few) == sum(want.values())


def test_every_gram_is_a_row(spark):
    """So many 4-grams that some would share one of 2**24 slots: none takes another's count."""
    letters = np.random.default_rng(6).integers(0x4E00, 0x9F00, (1000, 200))
    rows = [("".join(map(chr, row)), "zh") for row in letters.tolist()]
    want = Counter(k for t, _ in rows for k in grams(t))
    got = {r.gram % (1 << 64): r.n for r in L.count_grams(spark.createDataFrame(rows, "text string, lang string")).collect()}
    assert len(want) > 190_000 and got == want


def test_large_languages_in_parts(spark, monkeypatch):
    """Models of several parts give the log probabilities of a whole one."""
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").where("lang IN ('en', 'de')")
    whole = L.train(docs)
    monkeypatch.setattr(L, "GROUP_TYPES", 500)
    dealt = L.train(docs)
    assert whole.langs == dealt.langs == ["de", "en"] and whole.parts == [1, 1] and min(dealt.parts) > 2
    rng = np.random.default_rng(5)
    keys = np.concatenate([L._grams([r.text for r in docs.collect()])[0][:20_000], *[
        np.array(rng.choice([0, 97, 101, 110, 0x4E2D], (400, 4)), np.uint64) @ np.array([1 << 48, 1 << 32, 1 << 16, 1], np.uint64)]])
    for j in range(2):
        for as_new in (False, True):
            assert np.allclose(whole.logs(j, [keys, keys[:0]], as_new)[0], dealt.logs(j, [keys, keys[:0]], as_new)[0], atol=1e-5)
    assert np.allclose(whole.mean, dealt.mean) and np.allclose(whole.var, dealt.var)


ALPHABET = 30
AA, BB = "abca abcb aabb cab " * 3, "xyzx yyzx zzyx " * 4


def fitted(text):
    keys, n = np.unique(np.array(grams(text), np.uint64), return_counts=True)
    return L.KneserNey(keys, n, n == 1, ALPHABET)


def models():
    out = L.Models()
    out.add("aa", fitted(AA))
    out.add("bb", fitted(BB))
    return out


def plain_probability(counts, key):
    """Interpolated Kneser-Ney of one language from its 4-gram counts."""
    tables = {4: counts}
    for m in (3, 2, 1):
        tables[m] = Counter(k & ((1 << 16 * m) - 1) for k in tables[m + 1])

    def p(k, m):
        if not m:
            return 1 / ALPHABET
        t = tables[m]
        n1, n2 = (sum(v == c for v in t.values()) for c in (1, 2))
        d = min(0.95, max(0.05, n1 / (n1 + 2 * n2))) if n1 else 0.5
        own = [v for x, v in t.items() if x >> 16 == k >> 16]
        lower = p(k & ((1 << 16 * (m - 1)) - 1), m - 1)
        return lower if not own else max(t.get(k, 0) - d, 0) / sum(own) + d * len(own) / sum(own) * lower

    return p(key, 4)


def test_probabilities():
    rng = np.random.default_rng(1)
    some = rng.choice([0, 97, 98, 99, 120, 121, 122, 0x4e2d], (50, 4)).tolist()
    keys = np.array([(a << 48) | (b << 32) | (c << 16) | d for a, b, c, d in some] + grams("abcxyz cab zzyx q"), np.uint64)
    for text in (AA, BB):
        model = fitted(text)
        counts = Counter(grams(text))
        assert np.allclose(np.exp(model.log(keys)), [plain_probability(counts, int(k)) for k in keys], rtol=1e-4)
        again = L.KneserNey.from_bytes(model.to_bytes())
        assert np.array_equal(again.log(keys), model.log(keys)) and np.array_equal(again.as_new(keys), model.as_new(keys))
    # all seen symbols, and the unseen ones of the alphabet, add up to 1
    context, seen = grams("abc")[2] >> 16 << 16, sorted({k & 0xFFFF for k in grams(AA)})
    each = np.exp(fitted(AA).log(np.array([context + c for c in [*seen, 0x4e2d]], np.uint64)))
    assert abs(each[:-1].sum() + (ALPHABET - len(seen)) * each[-1] - 1) < 1e-4


def test_decisions_and_pieces(monkeypatch):
    m = models()
    texts = ["abc cab", None, "", "12 !?", "zyx", "abc " * 2000]
    whole = m.decide(texts)
    assert whole["lang_pred"].tolist() == ["aa", "und", "und", "und", "bb", "aa"]
    assert (whole["score"].between(0, 1)).all() and whole["accepted"].tolist()[:5] == [True, False, False, False, True]
    for text, score, low in zip(texts, whole["score"], whole["cross_entropy"], strict=True):
        if grams(text or "") and score:
            h = np.array([-np.mean([np.log(plain_probability(Counter(grams(t)), k)) for k in grams(text[:40])]) for t in (AA, BB)])
            if len(text) <= 40:
                assert np.isclose(low, h.min(), rtol=1e-4)
                assert np.isclose(score, 1 / np.exp(-(h - h.min()) * 4 * np.sqrt(len(grams(text)))).sum(), rtol=1e-3)
    monkeypatch.setattr(L, "_PIECE", 40)
    assert np.allclose(m.decide(texts)["cross_entropy"], whole["cross_entropy"])


def test_ties_go_to_the_first_language():
    m = L.Models()
    for lang in ("k", "l", "m"):
        m.add(lang, fitted(AA))
    got = m.decide(["abc cab"])
    assert got["lang_pred"][0] == "k" and np.isclose(got["score"][0], 1 / 3)


def made_up(rng, letters, count):
    """Texts over an alphabet, each letter followed by one of five."""
    after = {c: rng.choice(letters, 5) for c in letters}
    out = []
    for _ in range(count):
        text, c = [], rng.choice(letters)
        for _ in range(120):
            text.append(" " if rng.random() < 0.15 else c)
            c = rng.choice(after[c])
        out.append("".join(text))
    return out


def test_disjoint_alphabets(spark):
    """Georgian and Armenian letters, and two halves of the Chinese block: nothing in common but blanks."""
    rng = np.random.default_rng(8)
    scripts = {"ka": range(0x10D0, 0x10F5), "hy": range(0x561, 0x585), "c1": range(0x4E00, 0x5600), "c2": range(0x5600, 0x5E00)}
    texts = [(t, lang) for lang, codes in scripts.items() for t in made_up(rng, [chr(c) for c in codes], 200)]
    rows = [(i, t, lang) for i, (t, lang) in enumerate(texts)]
    want = {i: lang for i, _, lang in rows}
    got = [r for r in L.query(spark.createDataFrame(rows, "doc_id long, text string, lang string")).collect() if r.held_out]
    assert len(got) > 150 and np.mean([r.lang_pred == want[r.doc_id] for r in got]) >= 0.98


def test_five_hundred_languages(spark, monkeypatch):
    """Models are built in groups and read again where the cache holds few of them."""
    monkeypatch.setattr(L, "GROUP_TYPES", 2000)
    monkeypatch.setattr(L, "CACHE_BYTES", 200_000)
    rows = [(i, " ".join(chr(0x4E00 + 20 * (i % 500) + (i // 500 + k * k) % 20) * 2 for k in range(12)), f"l{i % 500:03}") for i in range(2000)]
    got = [r for r in L.query(spark.createDataFrame(rows, "doc_id long, text string, lang string")).collect() if r.held_out]
    assert len(got) > 400 and np.mean([r.lang_pred == f"l{r.doc_id % 500:03}" for r in got]) >= 0.98
    assert list(L._groups([("b", 3), ("a", 9), ("c", 1), ("d", 1)], 5)) == [["a"], ["b", "c", "d"]]


def test_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{SF_CHECK}/documents.parquet")
    lang = {r.doc_id: r.lang for r in docs.select("doc_id", "lang").collect()}
    got = L.query(docs).collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in got)
    held = [r for r in got if r.held_out]
    assert len(got) == len(lang) and np.mean([r.lang_pred == lang[r.doc_id] for r in held]) > 0.98
    assert np.mean([r.accepted for r in got]) > 0.999
    model = L.train(docs.where(~L.held_out()))
    foreign = ["Съешь же ещё этих мягких французских булок, да выпей чаю. " * 9, "これは日本語の文章です。" * 30, "xqzj wvkq jzxq qqkw zzxv " * 20]
    assert not model.decide(foreign)["accepted"].any()


def test_edges(spark):
    rows = [(1, "the cat", "en"), (2, None, "en"), (3, "", None), (None, "der Hund", "de"), (1, "the cat", "en"), (4, "12", "de")]
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], "doc_id long, text string, lang string, langid string, score int")
    got = L.query(df).collect()
    assert sorted((r.doc_id or 0, r.lang_pred) for r in got) == [(0, "de"), (1, "en"), (1, "en"), (2, "und"), (3, "und"), (4, "und")]
    assert L.keep_identified(df).columns == df.columns
    assert {r.lang_pred for r in L.query(df.selectExpr("doc_id", "text", "cast(null AS string) lang")).collect()} == {"und"}
    assert L.query(df.where("false")).count() == 0


@pytest.mark.parametrize("near", [False, True])
def test_copies_reject_no_clean_text(spark, near):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet").select("doc_id", "text", "lang")
    rows = [tuple(r) for r in docs.where("lang = 'es'").collect()]
    text = next(t for _, t, _ in sorted(rows) if len(t) >= 1500)[:1500]
    words = text.split()
    rng = np.random.default_rng(3)

    def copy():  # a near copy has one word in forty replaced
        if not near:
            return text
        own = words[:]
        for at in rng.choice(len(own), max(1, len(own) // 40), replace=False):
            own[at] = words[rng.integers(len(words))]
        return " ".join(own)

    copies = [(10**9 + i, copy(), "es") for i in range(docs.count() // 2)]  # a third of all rows of the table
    got = L.query(spark.createDataFrame(rows + copies, docs.schema)).where("held_out AND doc_id < 1000000000").collect()
    assert len(got) > 200 and all(r.accepted for r in got)
