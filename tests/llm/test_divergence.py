"""Source divergence against plain loops over all terms, with nulls, copies, hot groups and nothing."""

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from askloom.llm import divergence
from askloom.llm.divergence import source_divergence

SCHEMA = "doc_id long, text string, lang string, source string, value string, rank string, Term string"


def frame(spark, rows):
    data = [(None if i % 5 == 0 else i, t, la, s, "x", "y", "z") for i, (t, la, s) in enumerate(rows)]
    return spark.createDataFrame(data, SCHEMA).repartition(3)


def terms_of(text):
    return re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def expected(rows, min_docs=3, top=200):
    docs, counts, groups = defaultdict(Counter), defaultdict(Counter), defaultdict(set)
    for text, lang, source in rows:
        lang, source = lang or "", source or ""
        groups[lang].add(source)
        counts[lang, source].update(terms_of(text))
        docs[lang].update(set(terms_of(text)))
    out = set()
    for lang, sources in groups.items():
        kept = [t for t, n in docs[lang].items() if n >= min_docs]
        count = {s: {t: counts[lang, s][t] for t in kept} for s in sources}
        total = {t: sum(count[s][t] for s in sources) for t in kept}

        def share(c):
            size = sum(c.values()) + len(kept)
            return {t: 1 + 10**9 * (n + 1) // size for t, n in c.items()}

        p = {s: share(count[s]) for s in sources}
        q = share(total)
        gap = lambda a, b: (a - b) ** 2 // b
        for s in sources:
            pairs = [(-sum(gap(p[s][t], p[o][t]) for t in kept), o) for o in sources if o != s]
            parts = {"pair": pairs, "term": [(-gap(p[s][t], q[t]), t) for t in kept if count[s][t] and p[s][t] > q[t]]}
            for part, found in parts.items():
                for rank, (value, item) in enumerate(sorted(found, key=lambda x: (x[0], x[1].encode())), 1):
                    if part == "pair" or rank <= top:
                        out.add((lang, s, part, item, -value, rank))
    return out


def some_rows(seed=0, n=120):
    draw = random.Random(seed)
    words = [f"{a}{b}" for a in ("lo", "É", "ñu", "Ma", "x") for b in ("ra", "Ti", "ß", "中文")]
    rows = [
        (" ".join(draw.choices(words, k=draw.randint(1, 30))), draw.choice(["en", "de", None]),
         draw.choice(["a", "a", "a", "b", "c", "é", None]))
        for _ in range(n)
    ]
    rows += [(None, "en", "a"), ("", "en", "empty"), ("12 !", "fr", "x"), ("only here", "fr", "y"), ("lora " * 4000, "en", "b")]
    return rows + rows[:10]


def as_set(df):
    return {(r["lang"], r["source"], r["part"], r["item"], r["value"], r["rank"]) for r in df.collect()}


@pytest.mark.parametrize("slice_postings", [divergence.SLICE_POSTINGS, (5, 7)])
def test_against_loops(spark, slice_postings):
    rows = some_rows()
    got = source_divergence(frame(spark, rows), slice_postings=slice_postings)
    assert as_set(got) == expected(rows) and got.count() == len(expected(rows))


def test_top_and_ties(spark):
    rows = [("aa bb cc dd", "en", "a"), ("aa bb cc dd", "en", "a"), ("dd cc bb aa zz zz", "en", "b"), ("zz zz", "en", "b"), ("zz", "en", "c")]
    got = as_set(source_divergence(frame(spark, rows), top=2))
    assert got == expected(rows, top=2)


def test_nothing_kept_and_no_rows(spark):
    rows = [("a b", "en", "a"), ("c d", "en", "b"), (None, None, None)]
    docs = frame(spark, rows)
    assert as_set(source_divergence(docs)) == {("en", "a", "pair", "b", 0, 1), ("en", "b", "pair", "a", 0, 1)}
    assert source_divergence(docs.limit(0)).collect() == []


def test_tasks_that_flush_and_cut_texts(spark, monkeypatch):
    data = ("Wort " * 50 + "Étude,x1y ").encode() * 3
    whole = Counter(data.translate(divergence.TO_TERMS).split())
    monkeypatch.setattr(divergence, "PIECE_BYTES", 7)
    assert sum((Counter(p) for p in divergence.pieces(data)), Counter()) == whole
    assert list(divergence.pieces(b"")) == []


def test_shares_of_large_counts_are_exact():
    counts = np.array([0, 5, 10**15])
    assert divergence.shares(counts, 10**15 + 7).tolist() == [1 + 10**9 * (int(c) + 1) // (10**15 + 7) for c in counts]


def test_accumulator_in_small_gathers(monkeypatch):
    draw = np.random.RandomState(0)
    lengths = draw.randint(1, 5, 40)
    peer = np.concatenate([draw.permutation(5)[:n] for n in lengths])
    n = draw.randint(1, 50, len(peer))
    sizes = np.bincount(peer, n, 5).astype(np.int64)
    part = divergence.Slice(sizes, 40, lengths, peer, n)
    whole = [part.row(g).tolist() for g in range(5)]
    monkeypatch.setattr(divergence, "GATHER", 3)
    assert [part.row(g).tolist() for g in range(5)] == whole
    dense = np.zeros((5, 40), dtype=np.int64)
    dense[peer, np.repeat(np.arange(40), lengths)] = n
    p = np.stack([divergence.shares(dense[g], sizes[g] + 40) for g in range(5)])
    assert whole == [[int(divergence.gap(p[g], p[h]).sum()) for h in range(5)] for g in range(5)]
    assert pa.array(whole[0]).null_count == 0
