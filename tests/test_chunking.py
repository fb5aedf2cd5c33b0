import re

from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from askloom.operators.chunking import chunk_separator, chunk_tokens, pack_pieces


def windows(tokens, size, overlap):
    """Plain restatement of the rule: windows until the last token is covered."""
    out, start = [], 0
    while True:
        out.append(" ".join(tokens[start:start + size]))
        if start + size >= len(tokens):
            return out
        start += size - overlap


def test_windows_of_all_lengths(spark):
    texts = [" ".join(f"w{i}" for i in range(n)) for n in range(1, 60)]
    docs = spark.createDataFrame(list(enumerate(texts)), "id int, text string")
    for size, overlap in [(10, 3), (10, 0), (7, 6), (1, 0), (100, 20)]:
        rows = chunk_tokens(docs, "text", size=size, overlap=overlap).collect()
        got = {}
        for r in sorted(rows, key=lambda r: (r.id, r.chunk_no)):
            got.setdefault(r.id, []).append(r.chunk)
        assert got == {i: windows(t.split(" "), size, overlap) for i, t in enumerate(texts)}


def test_chunks_without_overlap_give_the_text_back(spark):
    text = "a  b\nc\td e f g  h"
    docs = spark.createDataFrame([(1, text)], "id int, text string")
    rows = chunk_tokens(docs, "text", size=3, overlap=0).orderBy("chunk_no").collect()
    assert " ".join(r.chunk for r in rows) == " ".join(re.split(r"\s+", text))


def test_empty_and_null_texts_give_no_chunk(spark):
    docs = spark.createDataFrame([(1, ""), (2, None), (3, "x")], "id int, text string")
    assert [r.id for r in chunk_tokens(docs, "text").collect()] == [3]
    assert [r.id for r in chunk_separator(docs, "text").collect()] == [3]


def test_id_is_the_md5_of_the_chunk(spark):
    docs = spark.createDataFrame([(1, "x y")], "id int, text string")
    row = chunk_tokens(docs, "text").first()
    assert row.chunk_id == spark.range(1).select(F.md5(F.lit("x y"))).first()[0]
    assert chunk_tokens(docs, "text").columns == ["id", "text", "chunk_no", "chunk", "chunk_id"]


def test_own_tokenizer(spark):
    docs = spark.createDataFrame([(1, "abcdefg"), (2, "")], "id int, text string")
    rows = chunk_tokens(docs, "text", size=4, overlap=1, tokenizer=lambda: list, joiner="")
    assert sorted(r.chunk for r in rows.collect()) == ["abcd", "defg"]


def slow_pack(lengths, size, overlap):
    """Greedy packing with a running list of pieces."""
    out, current, first = [], [], 0
    for i, n in enumerate(lengths):
        if current and sum(current) + n > size:
            out.append((first, i))
            while current and (sum(current) > overlap or sum(current) + n > size):
                current.pop(0)
                first += 1
        if not current:
            first = i
        current.append(n)
    if current:
        out.append((first, len(lengths)))
    return out


def covers(ranges, n):
    return sorted({i for a, b in ranges for i in range(a, b)}) == list(range(n))


@settings(max_examples=500, deadline=None)
@given(
    st.lists(st.integers(1, 12), max_size=30),
    st.integers(1, 20).flatmap(lambda s: st.tuples(st.just(s), st.integers(0, s - 1))),
)
def test_packing(lengths, limits):
    size, overlap = limits
    ranges = pack_pieces(lengths, size, overlap)
    assert covers(ranges, len(lengths))
    for a, b in ranges:
        assert sum(lengths[a:b]) <= size or b - a == 1
    assert all(x[0] < y[0] and x[1] < y[1] for x, y in zip(ranges, ranges[1:]))
    assert ranges == slow_pack(lengths, size, overlap)


def test_packing_takes_the_last_piece():
    assert pack_pieces([3, 3, 3], 6, 3) == [(0, 2), (1, 3)]
    assert pack_pieces([9, 1], 5, 2) == [(0, 1), (1, 2)]
    assert pack_pieces([], 5, 2) == []


def test_separator_cuts_only_there(spark):
    text = "one two\nthree\n\nfour five six seven\neight"
    docs = spark.createDataFrame([(1, text)], "id int, text string")
    rows = chunk_separator(docs, "text", size=4, overlap=1).orderBy("chunk_no").collect()
    assert [r.chunk for r in rows] == ["one two\nthree", "four five six seven", "eight"]
