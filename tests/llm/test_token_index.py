"""Token index: ids equal the library's, files and perfect hash round trip."""

import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
from conftest import SF_SMALL
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from clicklens.llm import token_index as T

PATH = public_tokenizers.path("word_bpe_49k.json")
LIBRARY = Tokenizer.from_file(PATH)
with open(PATH, encoding="utf-8") as f:
    ENCODER = T.WordEncoder(f.read())


def plain(rows):
    out, start = [], 0
    for i, t in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or "")):
        ids = np.array([*LIBRARY.encode(t or "", add_special_tokens=False).ids, 2], "<u4")
        out.append((i, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    return sorted(out, key=str)


@settings(max_examples=200, deadline=None)
@given(st.text(st.sampled_from("aB é́́ \n\t\x1c\x85\xa0 　'stre日1٣!<|endof>ΣİK"), max_size=40))
def test_words_encode_like_whole_texts(text):
    assert np.frombuffer(ENCODER(pa.array([text]))[0], ENCODER.kind).tolist() == LIBRARY.encode(text, add_special_tokens=False).ids


@settings(max_examples=50, deadline=None)
@given(st.sets(st.integers(-(1 << 63), (1 << 63) - 1), max_size=300))
def test_perfect_hash(keys):
    keys = np.array(sorted(keys), np.int64)
    assert sorted(T.PerfectHash.build(keys).slots(keys).tolist()) == list(range(len(keys)))


def test_query_over_a_table(spark):
    df = spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text")
    rows = [tuple(r) for r in df.collect()]
    got = [tuple(r) for r in T.query(df.repartition(7), PATH).collect()]
    assert sorted(got, key=str) == plain(rows)


def test_nulls_repeats_and_small_parts(spark, monkeypatch):
    monkeypatch.setattr(T, "PART", 3)
    rows = [(None, "a b"), (5, None), (5, "x y"), (7, ""), (7, ""), (-3, "<|endoftext|> c"), (1 << 40, "w " * 5000), (None, "a")]
    df = spark.createDataFrame([(*r, 1, "f") for r in rows], "doc_id long, text string, row int, file string").repartition(3)
    assert sorted((tuple(r) for r in T.query(df, PATH).collect()), key=str) == plain(rows)
    with open(PATH, encoding="utf-8") as f:
        store = T.write_store(df, f.read(), 2)
    asked = spark.createDataFrame([(i,) for i in (*range(2000), -3, 5)], "key long")
    assert sorted(r.key for r in T.lookup(asked, store).collect()) == [-3, 5, 5, 7]
    assert T.query(df.where("false"), PATH).count() == 0
