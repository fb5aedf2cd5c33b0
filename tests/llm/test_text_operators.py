"""Operators on texts against brute force on small tables with nulls, blanks, copies and long texts."""

import hashlib
import re
import zlib

import numpy as np
import pytest

from askloom.llm import decontamination, lm_scoring, near_dedup, packing, pii, quality_classifier, quality_rules
from askloom.llm import sharding
from askloom.llm.queries import tokenizer_file

WORDS = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma tau".split()
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, kept string"


def prose(seed: int, n: int) -> list[str]:
    draw = np.random.RandomState(seed)
    return [WORDS[i] + str(draw.randint(40)) for i in draw.randint(len(WORDS), size=n)]


def texts() -> list[str | None]:
    base = prose(1, 120)
    near = base[:60] + ["changed"] + base[61:]
    out = [None, "", " \n\t", "one", "one two", "one two", " ".join(base), " ".join(base), " ".join(near).upper()]
    out += [" ".join(prose(s, 80)) for s in range(2, 12)] + ["long " + " ".join(prose(20, 5000))]
    # A group larger than a small bucket, of copies with one change each.
    group = prose(30, 150)
    out += [" ".join([*group[:i], "x" + str(i), *group[i + 1:]]) for i in range(0, 150, 5)]
    return out


def table(spark, rows=None):
    rows = texts() if rows is None else rows
    data = [(i, t, None if i % 7 == 0 else "en", f"s{i % 2}", 0, "x") for i, t in enumerate(rows)]
    return spark.createDataFrame(data, SCHEMA).repartition(3)


def words_of(t):
    return re.findall(r"[^\x20\x09-\x0D]+", t or "")


def shingles(t, k):
    w = words_of(re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
    k = min(k, len(w))
    return {tuple(w[i: i + k]) for i in range(len(w) - k + 1)} if w else set()


@pytest.mark.parametrize("k", [4, 5])
def test_near_duplicates(spark, k):
    rows = texts()
    sets = [shingles(t, k) for t in rows]
    label = list(range(len(rows)))
    for _ in rows:
        for i, a in enumerate(sets):
            for j, b in enumerate(sets):
                if a and b and 100 * len(a & b) >= 80 * len(a | b):
                    label[i] = label[j] = min(label[i], label[j])
    got = near_dedup.near_duplicates(table(spark), words=k).collect()
    assert {(r["doc_id"], r["n_shingles"], r["component_id"], r["kept"]) for r in got} == {
        (i, len(s), label[i], label[i] == i) for i, s in enumerate(sets)
    }
    assert len(got) == len(rows)


def test_near_duplicates_of_repeated_rows_null_ids_and_nothing(spark):
    rows = spark.createDataFrame([(1, "a b c d e f"), (1, "a b c d e f"), (None, "a b c d e f"), (2, "z")], "doc_id long, text string")
    got = sorted(map(tuple, near_dedup.near_duplicates(rows).collect()), key=str)
    assert got == sorted([(1, 2, 1, True), (1, 2, 1, True), (None, 2, None, True), (2, 1, 2, True)], key=str)
    assert near_dedup.near_duplicates(rows.limit(0)).collect() == []


def test_signature_is_a_minimum_over_shifts():
    s = np.unique(near_dedup.shingle_set(b"a b c d e f g h", 3))
    sigma, shifted = near_dedup.permutations()
    places = sigma[(s >> np.uint64(64 - near_dedup.PLACES_BITS)).astype(int)]
    pi = shifted[:, 0]
    want = [min(pi[(p + k) % len(pi)] for p in places) for k in range(near_dedup.COORDINATES)]
    assert near_dedup.signature(s).tolist() == want


def test_text_stats():
    for t in [*texts(), "a b c a b c\nx\nx\n\n x\nß# $ é e a b c"]:
        w = words_of(t)
        windows = [tuple(w[i: i + 3]) for i in range(len(w) - 2)]
        again = {j for i, x in enumerate(windows) if windows.count(x) > 1 for j in range(i, i + 3)} if len(w) < 400 else None
        lines = [x for x in (t or "").split("\n") if words_of(x)]
        got = quality_rules.text_stats((t or "").encode())
        assert got[:4] == (len(w), sum(map(len, w)), sum(len(re.findall(r"[#*$%&|<>]", x)) for x in w), len(lines) - len(set(lines)))
        assert again is None or got[4] == len(again)


def test_quality_rules(spark):
    draw = np.random.RandomState(0)
    clean = [" ".join(w + ("." if draw.rand() < 0.1 else "") for w in prose(s, 100)) for s in range(300)]
    junk = [" | ".join(prose(s, 100)) for s in range(300, 310)]
    rows = [*clean, *junk, None, "", "short text", " ".join(["a b c"] * 40)]
    got = {r["doc_id"]: r for r in quality_rules.quality_rules(table(spark, rows)).collect()}
    assert len(got) == len(rows)
    assert all(got[i]["kept"] for i in range(300))
    assert not any(got[i]["kept"] for i in range(300, len(rows)))
    assert [got[i]["base_failed"] for i in (300, 310, 311, 312, 313)] == [False, True, True, True, True]
    assert quality_rules.quality_rules(table(spark, rows).limit(0)).collect() == []


def test_quality_rules_reject_duplicate_lines_and_repetition(spark):
    lined = lambda w, k: "\n".join(" ".join(w[i: i + k]) for i in range(0, len(w), k))
    clean = [lined(prose(s, 100), 10) for s in range(300)]
    # Lines of two words: duplicates of lines without repeated windows of three words.
    short = [["a" + str(s), "b"] for s in range(10)]
    copied = []
    for s, pair in enumerate(short):
        w = prose(400 + s, 60)
        copied.append("\n".join(x for i in range(60) for x in (" ".join(pair), w[i] + " y" + str(i))))
    repeated = [lined([*prose(500 + s, 75), *prose(500 + s, 75)[:25]], 10) for s in range(10)]
    rows = clean + copied + repeated
    got = {r["doc_id"]: r for r in quality_rules.quality_rules(table(spark, rows)).collect()}
    assert all(got[i]["kept"] for i in range(300))
    assert not any(got[i]["base_failed"] for i in range(len(rows)))
    assert not any(got[i]["kept"] for i in range(300, len(rows)))


def test_chi_square():
    assert abs(quality_rules.chi2_quantile(0.95, 6) - 12.5916) < 1e-3
    assert abs(quality_rules.chi2_cdf(12.5916, 6) - 0.95) < 1e-5


@pytest.mark.parametrize("max_windows", [200_000, 7])
def test_decontamination(spark, max_windows):
    rows = texts()
    passage = rows[6].split()
    items = [" ".join(passage[10:30]), "one, TWO", None, "..", rows[9]]
    docs = [*rows, "Say: " + ", ".join(passage[5:40]) + "! é end"]
    bench = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    norm = lambda t: re.findall(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub(rb"[A-Z]", lambda m: m[0].lower(), (t or "").encode()))
    want = {}
    for i, t in enumerate(docs):
        w, hit, found = norm(t), set(), set()
        for item, b in enumerate(map(norm, items)):
            k = min(10, len(b))
            windows = {tuple(b[p: p + k]) for p in range(len(b) - k + 1)} if b else set()
            for p in range(len(w) - k + 1) if b else ():
                if tuple(w[p: p + k]) in windows:
                    hit |= set(range(p, p + k))
                    found.add(str(item))
        want[i] = (len(w), len(hit), sorted(found))
    got = decontamination.find_overlaps(table(spark, docs), bench, max_windows=max_windows).collect()
    assert {r["doc_id"]: (r["n_words"], r["n_hit"], r["items"]) for r in got} == want
    cleaned = decontamination.decontaminate(table(spark, docs), bench, max_windows=max_windows)
    assert cleaned.columns == table(spark).columns
    left = {r["doc_id"]: r["text"] for r in cleaned.collect()}
    for i, (n, hit, _) in want.items():
        assert (i in left) == (not hit or hit < n / 2)
        if i in left and not hit:
            assert left[i] == docs[i]
        elif i in left:
            assert len(norm(left[i])) == n - hit


def test_packing(spark):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(tokenizer_file())
    rows = [*texts(), "Don't <|endoftext|> it'LL x́ İstanbul 日本 ÀÉß ×÷ 12a\x1cb", " ".join(prose(5, 9000))]
    got = packing.pack(table(spark, rows), tokenizer_file(), length=512).collect()
    places = {}
    for r in got:
        ids = np.frombuffer(r["ids"], "<u4").tolist()
        assert zlib.crc32(r["ids"]) == r["ids_crc32"] and len(ids) == r["length"]
        places.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for i, text in enumerate(rows):
        want = t.encode(text or "", add_special_tokens=False).ids + [2]
        pieces = sorted((r["start"], r["ids"]) for r in got if r["doc_id"] == i)
        assert np.frombuffer(b"".join(p for _, p in pieces), "<u4").tolist() == want
    for sequence, parts in places.items():
        ends = [0, *np.cumsum([n for _, n in sorted(parts)])]
        assert [o for o, _ in sorted(parts)] == ends[:-1]
        assert ends[-1] == 512 or sequence == max(places)
    assert packing.pack(table(spark).limit(0), tokenizer_file()).collect() == []


def test_sharding(spark):
    rows = texts()
    got = sharding.shard_documents(table(spark, rows), shards=7).collect()
    sizes = [sum(r["shard"] == s for r in got) for s in range(7)]
    assert len(got) == len(rows) and max(sizes) - min(sizes) <= 1
    for r in got:
        data = (rows[r["doc_id"]] or "").encode()
        assert (r["size"], r["text_crc32"]) == (len(data) + 16, zlib.crc32(data))
    for s in range(7):
        assert sorted(r["slot"] for r in got if r["shard"] == s) == list(range(sizes[s]))
    assert sharding.shard_documents(table(spark, rows).limit(0)).collect() == []


def test_hilbert_keys_walk_the_grid(spark):
    from askloom.llm.hilbert import hilbert_column, hilbert_keys
    from pyspark.sql import functions as F

    grid = np.array([(x, y, z) for x in range(8) for y in range(8) for z in range(8)])
    keys = hilbert_keys(grid, 3)
    path = grid[np.argsort(keys)]
    assert sorted(keys) == list(range(512)) and (np.abs(np.diff(path, axis=0)).sum(axis=1) == 1).all()
    df = spark.createDataFrame([tuple(map(int, g)) for g in grid], "x int, y int, z int")
    got = {(r[0], r[1], r[2]): r[3] for r in df.select("*", hilbert_column([F.col(c) for c in "xyz"], 3)).collect()}
    assert all(got[tuple(map(int, g))] == k for g, k in zip(grid, keys))


def test_pii_patterns():
    cases = {
        "mail a.b@x.y.com, a@b c@d.e@f.gg": [("email", 5, 16), ("email", 22, 27)],
        "1.2.3.4 300.1.1.1 01.002.3.255 1.2.3": [("ip", 0, 7), ("ip", 18, 30)],
        "4539 1488 0343 6467 and 4539148803436468": [("card", 0, 19)],
        "+1 (803) 555-5351. +12": [("phone", 0, 17)],
    }
    for text, want in cases.items():
        assert [s for s in pii.base_spans(text)] == want
    long = "9" * 200_000 + " " + "a" * 200_000 + "@"
    assert pii.base_spans(long) == []


def test_pii(spark):
    draw = np.random.RandomState(1)
    phone = lambda: f"{draw.randint(100, 999)} 555-{draw.randint(1000, 9999)}"
    rows = [f"call +1 ({phone()[:3]}) 555-{draw.randint(1000, 9999)} or {i} now" for i in range(80)]
    rows += [f"from u.n{i}@mail{i % 9}.example.com, seen" for i in range(80)] + [None, "", "nothing 12 here", "tel (803) 555-5351 ok"]
    docs = table(spark, rows)
    field = pii.train(docs)
    got = {r["doc_id"]: r for r in pii.find_pii(docs, field=field).collect()}
    for i, t in enumerate(rows):
        base = [tuple(s) for s in got[i]["base"]]
        assert sorted(base) == sorted(pii.base_spans(t or "")) and set(base) <= {tuple(s) for s in got[i]["spans"]}
    assert [tuple(s) for s in got[163]["spans"]] == [("phone", 4, 18)] and got[162]["spans"] == []
    clean = {r["doc_id"]: r["text"] for r in pii.redact(docs, field=field).collect()}
    assert clean[163] == "tel [PHONE] ok" and clean[160] is None and "@" not in clean[100]
    assert pii.redact(docs.limit(0)).collect() == []


def test_span_field_decodes_the_best_segmentation():
    field = pii.SpanField()
    text = "1111 2222 3333"
    run = pii.runs_of(text)[0]
    field.weights = {f"shape {pii.shape('1111 2222')}": [0, 0, 2.0, 0], f"shape {pii.shape('1111')}": [0, 1.5, 0, 0]}
    assert field.decode(text, run) == [("ip", 0, 4), ("ip", 5, 9), ("ip", 10, 14)]
    field.weights[f"shape {pii.shape(text)}"] = [0, 0, 0, 5.0]
    assert field.decode(text, run) == [("phone", 0, 14)]


def test_classifier(spark):
    good = [" ".join(prose(s, 60)) + "." for s in range(300)]
    bad = [" | ".join(prose(s, 60)) for s in range(300, 400)]
    docs = table(spark, [*good, *bad, None, ""])
    labels = spark.createDataFrame([(i, int(i < 300)) for i in range(400)] + [(400, None)], "doc_id long, quality int")
    got = {r["doc_id"]: r for r in quality_classifier.quality_scores(docs, labels).collect()}
    assert len(got) == 402
    held = [i for i in range(400) if quality_classifier.crc_fold(i) == 0]
    assert all(got[i]["held_out"] == (quality_classifier.crc_fold(i) == 0) for i in range(402))
    assert np.mean([got[i]["predicted"] == int(i < 300) for i in held]) > 0.98
    none = quality_classifier.quality_scores(docs, labels.limit(0)).select("score").distinct().collect()
    assert [r[0] for r in none] == [0.5]


def test_lm_scores(spark):
    from collections import Counter
    from math import log

    rows = texts()
    docs = [words_of(t) for t in rows]
    uni, bi = Counter(), Counter()
    for w in docs:
        uni.update(w)
        bi.update(zip(w, w[1:]))
    n = sum(uni.values())
    got = {r["doc_id"]: r for r in lm_scoring.backoff_scores(table(spark, rows), chunk_bytes=3000, part_bytes=5000).collect()}
    for i, w in enumerate(docs):
        own, own2 = Counter(w), Counter(zip(w, w[1:]))
        total = 0.0
        for j, x in enumerate(w):
            pair = (w[j - 1], x) if j else None
            if pair and bi[pair] > own2[pair]:
                total += log((bi[pair] - own2[pair]) / (uni[pair[0]] - own[pair[0]]))
            else:
                total += log((0.4 if j else 1) * max(uni[x] - own[x], 1) / max(n - len(w), 1))
        assert got[i]["n_words"] == len(w)
        assert got[i]["score"] is None if not w else abs(got[i]["log_score"] - total) < 1e-6
    assert lm_scoring.backoff_scores(table(spark).limit(0)).collect() == []


def test_items_digest():
    assert decontamination.items_digest(["1", "12"]) == hashlib.sha256(b"1,12").hexdigest()


def test_pairs_in_large_mixed_buckets(spark):
    # Pairs just above 0.8 among texts that all are at 0.76, so that no band keeps them apart.
    passage = prose(900, 250)
    rows = []
    for k in range(350):
        own = prose(1000 + k, 36)
        rows += [" ".join(passage + own), " ".join([*passage, *own[:8], *prose(5000 + k, 28)])]
    sets = [near_dedup.shingle_set(t.encode(), 4) for t in rows]
    values, places = np.unique(np.concatenate(sets), return_inverse=True)
    held = np.zeros((len(sets), len(values)), dtype=np.float32)
    held[np.repeat(np.arange(len(sets)), list(map(len, sets))), places] = 1
    common, sizes = held @ held.T, held.sum(axis=1)
    linked = 180 * common >= 80 * (sizes[:, None] + sizes[None, :])
    assert {(i, j) for i, j in np.argwhere(linked).tolist()} == {(i, j) for i in range(700) for j in (i, i ^ 1)}
    got = {r["doc_id"]: r["component_id"] for r in near_dedup.near_duplicates(table(spark, rows), words=4).collect()}
    assert got == {i: i - i % 2 for i in range(700)}


def test_prefixes_give_every_pair(spark, monkeypatch):
    # One bucket for all: whatever the bands say, the prefix filter alone finds the links.
    monkeypatch.setattr(near_dedup, "BLOCK", 3)
    passage = prose(900, 60)
    rows = [" ".join([*passage, *prose(s // 3, 60)[: 60 - 4 * (s % 3)]]) for s in range(30, 120)]
    sets = [near_dedup.shingle_set(t.encode(), 4) for t in rows]
    linker = near_dedup._Linker(None, 80)
    data = [(i, bytearray(s.tobytes())) for i, s in enumerate(sets)]
    linker.sets = spark.createDataFrame(data, "id long, shingles binary")
    linker.labels = spark.createDataFrame([], "node long, component long")
    got = {tuple(r) for r in linker.pairs_by_prefix(linker.sets.select("id")).collect()}
    common = lambda i, j: len(np.intersect1d(sets[i], sets[j]))
    want = {
        (i, j) for i in range(len(sets)) for j in range(i + 1, len(sets))
        if 180 * common(i, j) >= 80 * (len(sets[i]) + len(sets[j]))
    }
    assert len(want) > 60 and want <= got


def test_texts_that_only_share_a_rare_passage_are_no_pairs(spark):
    # Their rarest shingles are the same, and half of the text is not.
    rows = [" ".join(prose(2000 + g, 60) + prose(3000 + (5 * g + k) % 12, 60)) for g in range(20) for k in range(5)]
    linker = near_dedup._Linker(None, 80)
    data = [(i, bytearray(near_dedup.shingle_set(t.encode(), 4).tobytes())) for i, t in enumerate(rows)]
    linker.sets = spark.createDataFrame(data, "id long, shingles binary")
    linker.labels = spark.createDataFrame([], "node long, component long")
    assert linker.pairs_by_prefix(linker.sets.select("id")).collect() == []


def test_members_meet_each_hub_once(spark):
    # Thirty buckets of the same hundred members, as a group of near copies has.
    rows = [(i, 50, i, key, 100) for i in range(100) for key in range(30)]
    members = spark.createDataFrame(rows, "id long, n int, component long, key long, c long")
    got = [tuple(r) for r in near_dedup._Linker(None, 80).pairs_with_hubs(members).collect()]
    hubs = near_dedup.HUBS + 1
    assert all(a < b for a, b in got) and len(got) <= 100 * hubs
    # Every member with every hub.
    assert {i for pair in got for i in pair} == set(range(100)) and len(set(got)) >= 99


def test_sketches_differ_in_half_of_what_the_sets_do():
    words = [str(i).encode() for i in range(1200)]
    one, two = (near_dedup.shingle_set(b" ".join(w), 4) for w in (words[:1000], words[100:1100]))
    jaccard = len(np.intersect1d(one, two)) / len(np.union1d(one, two))
    bits = sum(int(x ^ y).bit_count() for x, y in zip(*(near_dedup.sketch(s).view(np.uint64).tolist() for s in (one, two))))
    assert abs(bits / near_dedup.SKETCH_BITS - (1 - jaccard) / 2) < 0.04
    assert bits <= near_dedup._most_differing(80)


def test_token_ids_of_plain_texts_are_those_of_the_tokenizer():
    t = packing.TextTokenizer(tokenizer_file(), cache=8)
    odd = ["", "  ", " a  b\n\tc ", "it's 'sad ''s DON'T we'll 12a3 --x-- ...end", "Ünï ÿß ÀÞ À'S", "x" * 99 + " 's", "<|endoftext|> x", "日本",
           "x\x0by", "\xa0a", "'", "''", "'ll'll're", "x-'s'- 5''s"]
    want = [t._packed(t.tokenizer.encode(x, add_special_tokens=False).ids) for x in odd * 2]
    assert list(t.encode_all(odd * 2)) == want and len(t.pieces) + len(t.older) < 200


def test_packing_shuffles_ids_once_and_sorts_none(spark):
    """The sort and what is written in its order hold keys and lengths only; ids meet their places by a hash join."""
    plan = packing.pack(table(spark, texts()), tokenizer_file())._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Join Inner") == 1 and "shuffle_hash" in plan and "Sort" not in plan


def test_quality_rules_load_no_pandas_in_workers():
    assert not hasattr(quality_rules, "pd") and "mapInPandas" not in open(quality_rules.__file__).read()


def test_near_duplicates_load_no_pandas_in_workers():
    source = open(near_dedup.__file__).read()
    assert not hasattr(near_dedup, "pd") and "pandas_udf" not in source and "arrow_udf" not in source
