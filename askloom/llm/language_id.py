"""Language identification: sparse multinomial logistic regression on character n-grams.

A text is lower-cased, everything but letters becomes a blank, and its 1- to ``ORDER``-grams of characters
are counted in hashed buckets. Counts become ``(1 + ln count) * idf``, scaled to length one. The model is
one weight vector per language, trained with FTRL-proximal (McMahan et al., Ad Click Prediction, 2013) under
an elastic net: the L1 part leaves most weights at exactly zero. A temperature, fitted on rows that
training did not see, turns the margins into calibrated probabilities.

* Document frequencies come from all rows to learn from, summed per task and bucket.
* Training reads a bounded sample of them (``SAMPLE`` rows, the same number for every language as far as
  there are, by hash). It is dealt into ``SHARDS`` and trained by iterative parameter mixing: in each round every
  shard goes on from the mixed state, and the changes of state are averaged. Its rows are kept as sparse
  vectors of at most ``2 ** BITS`` entries.
* Every row is scored, whole. Only the text is read for it.

Defined cases: a null text and a text without a letter are ``und`` with score 0; null languages are not
learned from; a null id is neither learned from nor held out; repeated rows count as often as they occur; with one
language every text with a letter gets it, with score 1; with none all are ``und``. Empty tables give no rows.
Columns beyond those named are not read.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from askloom.llm.common import staged

UNKNOWN = "und"
FOLDS, HELD_OUT = 3, 1
BITS = 16
ORDER = 3
#: Rows that training and calibration see at most, over all languages (one per language at least).
SAMPLE = 8_000
SHARDS = 6
ROUNDS = 4
#: Step size and its smoothing, and the two penalties.
ALPHA, BETA, L1, L2 = 1.0, 1.0, 0.005, 0.05
#: One in this many sampled rows is kept for the temperature.
CALIBRATE = 5
#: Characters handled at once; a longer text is counted piece by piece.
PIECE = 1 << 20
BLANK = 0x20


# --- features --------------------------------------------------------------------------

def _letters_table() -> np.ndarray:
    """For code points below 0x10000 their own number if they are letters, else a blank."""
    keep = np.fromiter((chr(c).isalpha() for c in range(0x10000)), dtype=bool, count=0x10000)
    return np.where(keep, np.arange(0x10000), BLANK).astype(np.uint32)


class Counter:
    """Counts the hashed n-grams of texts; made once per task."""

    def __init__(self, bits: int = BITS, order: int = ORDER):
        self.bits, self.order, self.letters = bits, order, _letters_table()

    def codes(self, text: str, before: np.ndarray) -> np.ndarray:
        """``before`` and the code points of ``text``, each run of other characters than letters one blank."""
        c = np.frombuffer(text.lower().encode("utf-32-le", "replace"), dtype=np.uint32)
        # Beyond the first plane everything counts as itself.
        c = np.where(c < 0x10000, self.letters[np.minimum(c, 0xFFFF)], c)
        c = np.concatenate([before, c])
        blank = c == BLANK
        return c[~(blank & np.concatenate([[False], blank[:-1]]))]

    def buckets(self, codes: np.ndarray, known: int) -> np.ndarray:
        """One bucket per n-gram that ends after the first ``known`` codes; a blank alone is no gram."""
        out = []
        h = np.zeros(len(codes), dtype=np.uint32)
        for n in range(1, self.order + 1):
            # The hash of an n-gram from that of its first n - 1 characters.
            h = (h[: max(0, len(codes) - n + 1)] ^ codes[n - 1:]) * np.uint32(0x9E3779B1)
            h ^= h >> np.uint32(15)
            grams = ((h + np.uint32(n)) * np.uint32(0x85EBCA77)) >> np.uint32(32 - self.bits)
            new = slice(max(0, known - n + 1), None)
            out.append(grams[new][codes[new] != BLANK] if n == 1 else grams[new])
        return np.concatenate(out)

    def __call__(self, text: str | None) -> tuple[np.ndarray, np.ndarray] | None:
        """(buckets, counts) of a text; None for a text without a letter."""
        if not text or not any(map(str.isalpha, text)):
            return None
        total = np.zeros(1 << self.bits, dtype=np.int64)
        tail = np.array([BLANK], dtype=np.uint32)
        for at in range(0, len(text), PIECE):
            piece = text[at: at + PIECE] + (" " if at + PIECE >= len(text) else "")
            codes = self.codes(piece, tail)
            total += np.bincount(self.buckets(codes, len(tail)), minlength=len(total))
            tail = codes[max(0, len(codes) - self.order + 1):]
        found = np.flatnonzero(total)
        return found, total[found]


def weighted(counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    x = (1 + np.log(counts)) * idf
    return x / np.linalg.norm(x)


# --- model -----------------------------------------------------------------------------

class Ftrl:
    """The state of the learner: ``z`` and ``n`` per class and bucket, the last bucket being the constant."""

    def __init__(self, z: np.ndarray, n: np.ndarray, alpha: float = ALPHA, beta: float = BETA, l1: float = L1, l2: float = L2):
        self.z, self.n = z, n
        self.alpha, self.beta, self.l2 = alpha, beta, l2
        self.l1 = np.full(z.shape[1], l1)
        self.l1[-1] = 0.0

    def weights(self, at: np.ndarray | slice = slice(None)) -> np.ndarray:
        z, n = self.z[:, at], self.n[:, at]
        shrunk = np.sign(z) * np.maximum(np.abs(z) - self.l1[at], 0)
        return -shrunk / ((self.beta + np.sqrt(n)) / self.alpha + self.l2)

    def learn(self, at: np.ndarray, x: np.ndarray, label: int) -> None:
        at, x = np.append(at, self.z.shape[1] - 1), np.append(x, 1.0)
        w = self.weights(at)
        slope = softmax(w @ x)
        slope[label] -= 1
        g = slope[:, None] * x
        n = self.n[:, at]
        sigma = (np.sqrt(n + g * g) - np.sqrt(n)) / self.alpha
        self.z[:, at] += g - sigma * w
        self.n[:, at] = n + g * g


def softmax(margins: np.ndarray) -> np.ndarray:
    e = np.exp(margins - margins.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


def fit_temperature(margins: np.ndarray, labels: np.ndarray) -> float:
    """The divisor of the margins with the smallest log loss (golden section over its logarithm)."""
    if not len(labels):
        return 1.0

    def loss(log_t: float) -> float:
        p = softmax(margins / np.exp(log_t))[np.arange(len(labels)), labels]
        return -float(np.log(np.maximum(p, 1e-300)).mean())

    a, b, golden = np.log(0.05), np.log(20.0), (np.sqrt(5) - 1) / 2
    for _ in range(60):
        c, d = b - golden * (b - a), a + golden * (b - a)
        a, b = (a, d) if loss(c) <= loss(d) else (c, b)
    return float(np.exp((a + b) / 2))


class LanguageModel(NamedTuple):
    """All that scoring needs; of the size of languages times buckets."""

    languages: list[str]
    idf: np.ndarray
    weights: np.ndarray
    temperature: float
    bits: int
    order: int

    def scorer(self) -> Callable[[str | None], tuple[str, float]]:
        """A function from a text to its language and probability."""
        count = Counter(self.bits, self.order)
        # Row by row as the buckets of a text are picked.
        by_bucket = np.ascontiguousarray(self.weights[:, :-1].T)

        def score(text: str | None) -> tuple[str, float]:
            counted = count(text) if self.languages else None
            if counted is None:
                return UNKNOWN, 0.0
            at, n = counted
            p = softmax((weighted(n, self.idf[at]) @ by_bucket[at] + self.weights[:, -1]) / self.temperature)
            best = int(np.argmax(p))
            return self.languages[best], float(p[best])

        return score


# --- jobs ------------------------------------------------------------------------------

def fold(id_col: str, folds: int = FOLDS) -> Column:
    return F.crc32(F.col(id_col).cast("string")) % folds


def document_frequencies(texts: DataFrame, bits: int, order: int) -> tuple[np.ndarray, int]:
    """Texts per bucket, and texts, over all rows of the single column ``texts``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count, total, n = Counter(bits, order), np.zeros(1 << bits, dtype=np.int64), 0
        for batch in batches:
            for text in batch.column(0):
                if (counted := count(text.as_py())) is not None:
                    total[counted[0]] += 1
                    n += 1
        found = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.append(found, -1), pa.int32()), pa.array(np.append(total[found], n))], names=["bucket", "n"]
        )

    # One row per bucket: bounded by 2 ** bits.
    got = texts.mapInArrow(run, "bucket int, n bigint").groupBy("bucket").agg(F.sum("n").alias("n")).toPandas()
    total, known = np.zeros(1 << bits), got["bucket"].to_numpy() >= 0
    total[got["bucket"].to_numpy()[known]] = got["n"].to_numpy()[known]
    return total, int(got["n"].to_numpy()[~known].sum())


def sampled(rows: DataFrame, sample: int) -> tuple[DataFrame, list[str]]:
    """``lang, text, h``: at most ``sample`` rows, evenly over the languages, by hash of id and text."""
    per_lang = rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).orderBy("lang").collect()
    languages = [r["lang"] for r in per_lang]
    quota = max(1, sample // max(1, len(languages)))
    # About twice the quota is let through by hash, so that only few texts are ordered.
    share = F.create_map(*[F.lit(x) for r in per_lang for x in (r["lang"], min(1.0, (2 * quota + 50) / r["n"]))])
    some = rows.where(F.pmod("h", F.lit(1 << 30)) < F.try_element_at(share, F.col("lang")) * (1 << 30)) if per_lang else rows
    first = Window.partitionBy("lang").orderBy("h", "text")
    return some.withColumn("_k", F.row_number().over(first)).where(F.col("_k") <= quota).drop("_k"), languages


def counted(sample: DataFrame, languages: list[str], bits: int, order: int) -> DataFrame:
    """``label, part, at, n``: the sparse counts of the sampled texts; part ``SHARDS`` is for the temperature."""
    label_of = {lang: i for i, lang in enumerate(languages)}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = Counter(bits, order)
        for batch in batches:
            found = [(label_of[row[0].as_py()], row[2].as_py(), count(row[1].as_py())) for row in zip(*batch.columns)]
            found = [(label, h, *c) for label, h, c in found if c is not None]
            labels, h, at, n = zip(*found) if found else [()] * 4
            yield pa.RecordBatch.from_arrays([
                pa.array(labels, pa.int32()), pa.array(h, pa.int64()),
                pa.array(at, pa.list_(pa.int32())), pa.array(n, pa.list_(pa.int64())),
            ], names=["label", "h", "at", "n"])

    rows = sample.select("lang", "text", "h").mapInArrow(run, "label int, h bigint, at array<int>, n array<bigint>")
    spread = F.pmod(F.xxhash64("h", F.lit(1)), F.lit(CALIBRATE * SHARDS))
    part = F.when(spread < SHARDS, F.lit(SHARDS)).otherwise(spread % SHARDS).cast("int")
    return rows.withColumn("part", part)


def train(rows: DataFrame, idf: np.ndarray, n_classes: int, rounds: int, settings: dict[str, float]) -> tuple[np.ndarray, float]:
    """Weights and temperature from the rows of :func:`counted`."""
    size = len(idf) + 1
    z, n = np.zeros((n_classes, size)), np.zeros((n_classes, size))

    def vectors(table: pa.Table) -> Iterator[tuple[np.ndarray, np.ndarray, int]]:
        for row in table.sort_by("h").to_batches():
            for label, at, counts in zip(row["label"], row["at"], row["n"]):
                at = at.values.to_numpy()
                yield at, weighted(counts.values.to_numpy(), idf[at]), label.as_py()

    def from_state(z: np.ndarray, n: np.ndarray) -> Callable[[pa.Table], pa.Table]:
        def learn(table: pa.Table) -> pa.Table:
            state = Ftrl(z.copy(), n.copy(), **settings)
            for at, x, label in vectors(table):
                state.learn(at, x, label)
            dz, dn = state.z - z, state.n - n
            label, bucket = np.nonzero(dn)
            return pa.table({"label": label.astype(np.int32), "bucket": bucket.astype(np.int32),
                             "dz": dz[label, bucket], "dn": dn[label, bucket]})

        return learn

    for _ in range(rounds):
        changes = rows.where(F.col("part") < SHARDS).groupBy("part").applyInArrow(
            from_state(z, n), "label int, bucket int, dz double, dn double"
        )
        # One row per class, bucket and shard at most, summed in a fixed order.
        got = changes.groupBy("label", "bucket").agg(
            F.sum(F.col("dz").cast("decimal(28,12)")).cast("double").alias("dz"),
            F.sum(F.col("dn").cast("decimal(28,12)")).cast("double").alias("dn"),
        ).toPandas()
        at = got["label"].to_numpy(), got["bucket"].to_numpy()
        z, n = z.copy(), n.copy()
        z[at] += got["dz"].to_numpy() / SHARDS
        n[at] += got["dn"].to_numpy() / SHARDS
    weights = Ftrl(z, n, **settings).weights()

    def margins(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [(label, weights[:, at] @ x + weights[:, -1]) for at, x, label in vectors(pa.Table.from_batches([batch]))]
            labels, values = zip(*found) if found else [()] * 2
            yield pa.RecordBatch.from_arrays(
                [pa.array(labels, pa.int32()), pa.array(values, pa.list_(pa.float64()))], names=["label", "m"]
            )

    kept = rows.where(F.col("part") == SHARDS).mapInArrow(margins, "label int, m array<double>").toPandas()
    held = np.array(kept["m"].tolist(), dtype=float).reshape(len(kept), n_classes)
    return weights, fit_temperature(held, kept["label"].to_numpy(dtype=int))


def fit_languages(
    docs: DataFrame, *, id_col: str = "doc_id", text: str = "text", lang: str = "lang", folds: int = FOLDS,
    held_out: int = HELD_OUT, sample: int = SAMPLE, rounds: int = ROUNDS, bits: int = BITS, order: int = ORDER,
    **settings: float,
) -> LanguageModel:
    """The model of all rows with a language whose fold is not ``held_out``."""
    known = docs.where((fold(id_col, folds) != held_out) & F.col(lang).isNotNull() & F.col(text).isNotNull()).select(
        F.col(lang).cast("string").alias("lang"), F.col(text).alias("text"), F.xxhash64(id_col, text).alias("h")
    )
    chosen, languages = sampled(known, sample)
    if not languages:
        return LanguageModel([], np.zeros(1 << bits), np.zeros((0, (1 << bits) + 1)), 1.0, bits, order)
    df, n = document_frequencies(known.select("text"), bits, order)
    idf = np.log((1 + n) / (1 + df)) + 1
    rows = staged(counted(chosen, languages, bits, order), "language-sample")
    return LanguageModel(languages, idf, *train(rows, idf, len(languages), rounds, settings), bits, order)


def predict_languages(
    docs: DataFrame, model: LanguageModel, *, id_col: str = "doc_id", text: str = "text", folds: int = FOLDS,
    held_out: int = HELD_OUT,
) -> DataFrame:
    """``doc_id, held_out, lang_pred, score`` for every row; the prediction reads the text only."""
    kind = dict(docs.dtypes)[id_col]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        score = model.scorer()
        for batch in batches:
            found = [score(v.as_py()) for v in batch.column(1)]
            languages, scores = zip(*found) if found else [()] * 2
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(languages, pa.string()), pa.array(scores, pa.float64())],
                names=[id_col, "lang_pred", "score"],
            )

    found = docs.select(id_col, text).mapInArrow(run, f"`{id_col}` {kind}, lang_pred string, score double")
    out = F.coalesce(fold(id_col, folds) == held_out, F.lit(False)).alias("held_out")
    return found.select(id_col, out, "lang_pred", "score")


def identify_languages(
    docs: DataFrame, *, id_col: str = "doc_id", text: str = "text", lang: str = "lang", **options,
) -> DataFrame:
    """Fit on the rows to learn from and predict every row."""
    model = fit_languages(docs, id_col=id_col, text=text, lang=lang, **options)
    return predict_languages(docs, model, id_col=id_col, text=text)
