"""SentencePiece ids equal the library's, and decode back."""

import random

import public_tokenizers
import pytest
import sentencepiece
from conftest import SF_SMALL

from clicklens.llm import sentencepiece_sa as S

PATH = public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=PATH)


def texts():
    rng = random.Random(4)
    letters = "ab  ▁\n\t<s>é中文字日本한국\U0001f600\x00\x01()==--__the ing "
    out = ["".join(rng.choice(letters) for _ in range(rng.randint(0, 60))) for _ in range(400)]
    return out + ["", " ", "a" * 3000, "中文" * 900, " " * 300, "=" * 500, "<s></s><unk><0x0A>", "the" * 100, "\n" * 50]


def test_ids_and_text(library):
    vocabulary = S.load(PATH)
    every = texts()
    for t, ids in zip(every, S.encode(every, vocabulary, {}), strict=True):
        assert ids.tolist() == library.encode(t)
        assert S.decode(ids, vocabulary) == library.decode(ids.tolist()) == t.replace("▁", " ")


@pytest.mark.parametrize("long,batch,cache", [(1, 50, 3), (10_000, 1 << 20, 10)])
def test_limits_change_nothing(library, monkeypatch, long, batch, cache):
    for name, value in (("LONG", long), ("BATCH", batch), ("CACHE", cache)):
        monkeypatch.setattr(S, name, value)
    every = [t for t in texts() if len(t) < 200]
    assert [x.tolist() for x in S.encode(every, S.load(PATH), {})] == library.encode(every)


def test_new_words_are_indexed_in_slices(library, monkeypatch):
    """The first batch of a task, all of whose words are new, takes no more memory than a slice."""
    sizes, whole = [], S.encode_words
    monkeypatch.setattr(S, "INDEXED", 500)
    monkeypatch.setattr(S, "encode_words", lambda words, v: sizes.append(sum(map(len, words))) or whole(words, v))
    every = [" ".join(f"w{i}x{j}" for j in range(40)) for i in range(200)]
    assert [x.tolist() for x in S.encode(every, S.load(PATH), {})] == library.encode(every)
    assert len(sizes) > 50 and max(sizes) <= 500


def test_query(spark, library):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text")
    odd = spark.createDataFrame([(-1, None), (-2, ""), (None, "x"), (-1, None)], "doc_id long, text string")
    df = docs.union(odd)
    want = {r.doc_id: r.text for r in df.collect()}
    rows = S.query(df, PATH).collect()
    assert len(rows) == docs.count() + 4
    for r in rows:
        t = want[r.doc_id]
        assert (r.ids is None, r.round_trip) == (True, None) if t is None else (r.ids == library.encode(t) and r.round_trip)
    clash = odd.selectExpr("doc_id", "text", "1 AS ids", "'k' AS decoded")
    assert S.with_ids(clash, S.load(PATH), ids="pieces").columns == ["doc_id", "text", "ids", "decoded", "pieces"]
    assert S.query(df.where("false"), PATH).count() == 0
