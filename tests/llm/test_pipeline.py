"""Pipeline against plain versions of its stages, and the subpackage's place in the library."""

import re
from pathlib import Path

import corpus_pipeline as C
import public_tokenizers
import sentencepiece
from conftest import ROOT, SF_SMALL

from test_decontam import plain as plain_overlaps
from test_simhash import plain_components, plain_fingerprint
from test_suffix import plain as plain_repeats


def cut(docs):
    """The texts that are left of the suffix dedup, in order."""
    seen, out = set(), []
    for i, t in docs:
        b = t.encode()
        gone = bytearray(len(b))
        for p in range(len(b) - 99):
            if b[p:p + 100] in seen:
                gone[p:p + 100] = b"\1" * 100
            seen.add(b[p:p + 100])
        out.append((i, bytes(c for c, g in zip(b, gone, strict=True) if not g).decode("utf-8", "ignore")))
    return out


def test_run(spark):
    assert 4 <= len(C.STAGES) <= 5
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").orderBy("doc_id").collect()]
    items = [tuple(r) for r in spark.read.parquet(f"{SF_SMALL}/benchmark.parquet").select("item_id", "text").collect()]
    got = {r.doc_id: r for r in C.run(spark, SF_SMALL).collect()}
    docs = [(i, t) for i, t in docs if re.search(r"[^\W\d_]", t)]
    values = [plain_fingerprint(t) for _, t in docs]
    label = plain_components([i for i, _ in docs], values, 2)
    docs = [d for d, c in zip(docs, label, strict=True) if d[0] == c]
    docs = cut(docs)
    bad = {x[0] for x in plain_overlaps(docs, items)}
    library = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path(C.TOKENIZER))
    want = {i: library.encode(t) for i, t in docs if i not in bad}
    assert {i: r.ids for i, r in got.items()} == want
    assert plain_repeats(docs) and all(r.n_tokens == len(r.ids) for r in got.values())


def test_stages_keep_columns_on_odd_rows(spark):
    rows = [(1, "plain words in a row here", "en", "s", 25, "t"), (1, "plain words in a row here", "en", "s", 25, "t"), (None, None, None, None, None, None),
            (3, "", "en", "s", 0, "t"), (4, "Andere Worte stehen hier in dieser Zeile", "de", None, 40, None)]
    for docs in (spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, ids string"),
                 spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long, ids string")):
        for name, stage in C.STAGES[:-1]:
            out = stage(spark, docs, SF_SMALL)
            assert out.columns == docs.columns, name
            docs = C.materialize(out, name)
        assert C.STAGES[-1][1](spark, docs, SF_SMALL).count() == docs.count() == (2 if rows else 0)
        rows = []


def test_nothing_else_imports_the_subpackage():
    for p in Path(ROOT, "clicklens").rglob("*.py"):
        if "llm" not in p.parts:
            assert "llm" not in p.read_text(), p
