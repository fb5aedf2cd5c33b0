"""Chunks of sub-word tokens against the tokenizer itself."""

import hashlib

import pytest
from hypothesis import given, strategies as st
from tokenizers import Tokenizer

from askloom.operators import subwords
from askloom.operators.subwords import chunk_subwords, token_spans
from askloom.workload.chunks import tokenizer_file

TEXTS = ["Hello  wörld, 中文😀 tab\tnew\n\nline x", "a", "", None, " ", "<|endoftext|> is text", "word " * 3000, "été" * 40]


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
@pytest.mark.parametrize("size, overlap", [(4, 0), (5, 2), (300, 100)])
def test_chunks(spark, name, size, overlap):
    docs = spark.createDataFrame(list(enumerate(TEXTS)), "id int, start string").withColumnRenamed("start", "text")
    got = {}
    for r in chunk_subwords(docs, "text", tokenizer_file(name), size=size, overlap=overlap).collect():
        got.setdefault(r.id, []).append(r)
    tokenizer = Tokenizer.from_file(tokenizer_file(name))
    tokenizer.encode_special_tokens = True
    for i, text in enumerate(TEXTS):
        offsets = tokenizer.encode(text or "", add_special_tokens=False).offsets
        chunks = sorted(got.get(i, []), key=lambda r: r.chunk_no)
        step = size - overlap
        starts = [s for s in range(0, len(offsets), step) if s == 0 or s + overlap < len(offsets)]
        assert [(r.start, r.n_tokens) for r in chunks] == [(offsets[s][0], len(offsets[s: s + size])) for s in starts]
        assert all(r.chunk == text[r.start: r.end] and r.chunk_id == hashlib.md5(r.chunk.encode()).hexdigest() for r in chunks)
        assert [r.chunk_no for r in chunks] == list(range(len(chunks)))
        if chunks and name == "byte_bpe_50k.json":
            # Nothing of the text is lost.
            assert chunks[0].start == 0 and chunks[-1].end == len(text)
            assert all(b.start <= a.end for a, b in zip(chunks, chunks[1:]))


@given(st.integers(0, 60), st.integers(1, 9), st.integers(0, 8))
def test_windows_cover_all_tokens(n, size, overlap):
    if overlap >= size:
        return
    offsets = [(2 * i, 2 * i + 1) for i in range(n)]
    spans = token_spans(offsets, size, overlap)
    assert {t for a, b, _ in spans for t in offsets if a <= t[0] and t[1] <= b} == set(offsets)
    assert all(k == size for _, _, k in spans[:-1]) and all(0 < k <= size for _, _, k in spans)
    assert all(b[0] > a[0] and b[1] > a[1] for a, b in zip(spans, spans[1:]))


def test_columns_plan_and_arguments(spark):
    docs = spark.createDataFrame([(1, "one two", [1.0])], "id int, text string, extra array<double>")
    df = chunk_subwords(docs, "text", tokenizer_file())
    assert df.columns == ["id", "text", "extra", "chunk_no", "chunk", "chunk_id", "start", "end", "n_tokens"]
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ArrowEvalPython [") == 1 and "Exchange" not in plan
    with pytest.raises(ValueError):
        chunk_subwords(docs, "text", tokenizer_file(), size=3, overlap=3)


def test_a_worker_reads_the_file_once(monkeypatch):
    reads = []
    monkeypatch.setattr(Tokenizer, "from_file", staticmethod(lambda path, real=Tokenizer.from_file: reads.append(path) or real(path)))
    subwords.load_tokenizer.cache_clear()
    assert subwords.load_tokenizer(tokenizer_file()) is subwords.load_tokenizer(tokenizer_file())
    assert len(reads) == 1
