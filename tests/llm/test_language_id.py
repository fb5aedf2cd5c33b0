"""Language identification: held-out accuracy, counts by brute force, the learner, and odd rows."""

import re
import zlib
from collections import Counter

import numpy as np
import pytest

from askloom.llm import language_id
from askloom.llm.language_id import Ftrl, fit_languages, fit_temperature, identify_languages, predict_languages, softmax
from askloom.llm.registry import table

SF = "/root/testdata/sf0.01"
SCHEMA = "doc_id long, text string, lang string, source string, label string, h string, held_out string"


@pytest.fixture(scope="module")
def fitted(spark):
    return fit_languages(table(spark, SF, "documents"))


def frame(spark, rows):
    return spark.createDataFrame([(i, t, la, "s", "x", "y", "z") for i, t, la in rows], SCHEMA).repartition(2)


def test_held_out_accuracy(spark, fitted):
    docs = table(spark, SF, "documents")
    truth = {r["doc_id"]: r["lang"] for r in docs.collect()}
    got = predict_languages(docs, fitted).collect()
    assert sorted(r["doc_id"] for r in got) == sorted(truth)
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1) for r in got)
    held = [r for r in got if r["held_out"]]
    right = np.mean([r["lang_pred"] == truth[r["doc_id"]] for r in held])
    assert right >= 0.99 and abs(np.mean([r["score"] for r in held]) - right) < 0.02
    # Sparse by the L1 penalty.
    assert 0 < (fitted.weights != 0).mean() < 0.2


def test_predictions_read_the_text_only(spark, fitted):
    docs = table(spark, SF, "documents").limit(50)
    changed = docs.selectExpr("doc_id + 100000 AS doc_id", "text", "'xx' AS lang", "'other' AS source")
    pick = lambda d: sorted((r["lang_pred"], r["score"]) for r in predict_languages(d, fitted).collect())
    assert pick(docs) == pick(changed)


def test_odd_rows(spark, fitted):
    long = "the and with from " * 100_000
    rows = [(None, None, "en"), (1, "", "en"), (2, "123 !? \n", None), (3, "é", "fr"), (4, long, "en"), (4, long, "en"), (5, "中文", None),
            (6, "😀", None)]
    got = sorted(predict_languages(frame(spark, rows), fitted).collect(), key=lambda r: (r["doc_id"] is not None, r["doc_id"] or 0))
    assert [r["lang_pred"] for r in got[:3]] == ["und"] * 3 and [r["score"] for r in got[:3]] == [0.0] * 3
    assert got[0]["held_out"] is False
    assert got[4] == got[5] and got[4]["lang_pred"] == "en"
    assert all(0 <= r["score"] <= 1 for r in got) and got[-1]["lang_pred"] == "und"
    assert got[-2]["lang_pred"] in fitted.languages


def test_few_languages_and_no_rows(spark):
    rows = [(i, f"some words {i} here", "en") for i in range(12)]
    one = identify_languages(frame(spark, rows)).collect()
    assert {r["lang_pred"] for r in one} == {"en"} and all(r["score"] == 1.0 for r in one) and len(one) == 12
    unknown = identify_languages(frame(spark, [(i, t, None) for i, t, _ in rows])).collect()
    assert {(r["lang_pred"], r["score"]) for r in unknown} == {("und", 0.0)}
    assert identify_languages(frame(spark, rows).limit(0)).collect() == []
    ids = identify_languages(frame(spark, rows), id_col="h").collect()
    assert len(ids) == 12 and {r["h"] for r in ids} == {"y"}


def test_sample_is_bounded_and_even(spark):
    rows = [(i, f"text {i}", "a" if i % 10 else "b") for i in range(2000)] + [(5000, "c text", "c")]
    docs = frame(spark, rows).selectExpr("lang", "text", "xxhash64(doc_id, text) AS h")
    chosen, languages = language_id.sampled(docs, 300)
    n = Counter(r["lang"] for r in chosen.collect())
    assert languages == ["a", "b", "c"] and n == {"a": 100, "b": 100, "c": 1}


def grams(text, order=3):
    """The n-grams of a text, spelled out."""
    plain = re.sub(" +", " ", " " + "".join(c if c.isalpha() or ord(c) > 0xFFFF else " " for c in text.lower()) + " ")
    return Counter(plain[i: i + n] for n in range(1, order + 1) for i in range(len(plain) - n + 1) if plain[i: i + n] != " ")


@pytest.mark.parametrize("piece", [1 << 20, 1, 2, 5])
def test_counts_are_those_of_the_grams(monkeypatch, piece):
    monkeypatch.setattr(language_id, "PIECE", piece)
    count = language_id.Counter(bits=24)
    for text in ["Ab c", "a", " -Ünï 12 cöde!  x", "aaaa aaaa 中文", "x😀y  z" * 9]:
        at, n = count(text)
        assert sorted(n) == sorted(grams(text).values()) and sum(n) == sum(grams(text).values())
    assert count("12 3") is None and count(None) is None and count("") is None


def test_frequencies_cover_every_row(spark):
    rows = [(i, t, "en") for i, t in enumerate(["ab", "ab ab", "b", None, "7"])]
    df, n = language_id.document_frequencies(frame(spark, rows).select("text"), 16, 3)
    count = language_id.Counter()
    want = np.zeros(1 << 16)
    for t in ("ab", "ab ab", "b"):
        want[count(t)[0]] += 1
    assert n == 3 and (df == want).all()


def test_ftrl_step_by_hand():
    state = Ftrl(np.zeros((2, 4)), np.zeros((2, 4)), alpha=0.5, beta=1.0, l1=0.1, l2=0.3)
    state.learn(np.array([1]), np.array([2.0]), 0)
    # At zero weights both classes have probability 1/2: gradients -1 and 1 at x = 2.
    assert state.z[:, 1].tolist() == [-1.0, 1.0] and state.n[:, 1].tolist() == [1.0, 1.0] and not state.z[:, [0, 2]].any()
    w = (1 - 0.1) / ((1 + 1) / 0.5 + 0.3)
    assert np.allclose(state.weights()[:, 1], [w, -w])
    before = state.n[:, 1].copy(), state.z[:, 1].copy(), state.weights()[:, [1, 3]]
    p = softmax(before[2] @ np.array([2.0, 1.0]))
    g = (p - [1, 0]) * 2.0
    state.learn(np.array([1]), np.array([2.0]), 0)
    sigma = (np.sqrt(before[0] + g * g) - np.sqrt(before[0])) / 0.5
    assert np.allclose(state.z[:, 1], before[1] + g - sigma * before[2][:, 0])
    # A penalty above every |z| leaves no weight but the constant.
    assert not Ftrl(state.z, state.n, l1=100.0).weights()[:, :-1].any()


def test_temperature():
    draw = np.random.RandomState(0)
    margins = draw.normal(size=(4000, 3)) * 2
    labels = np.array([draw.choice(3, p=softmax(m / 2.5)) for m in margins])
    assert abs(fit_temperature(margins, labels) - 2.5) < 0.3
    assert fit_temperature(np.zeros((0, 3)), np.zeros(0, dtype=int)) == 1.0
