"""Quality classifier: a generalised additive model with pairwise interactions.

The score is a sum of lookup tables, one per binned feature and one per pair of features, found by
cyclic gradient boosting: in turn every feature gets a shallow tree (three cuts) fitted to the
residuals of its bins, shrunk and added to its table; then the pairs with the largest gain get
trees of one cut in each feature. Scoring adds table entries by bin, a batch at a time.

Features are shares and lengths of the whole text; labels, language, source and ids are no input.
The fit reads a bounded sample of the labelled rows (``SAMPLE``, by hash of the id; about all of them
below that size) of the folds that are not held out. Everything else covers every row.

Defined cases: null and empty texts have all features 0 and a score like any other; without
labelled rows, or with one class only, the score is the smoothed share of label 1 (0.5 for none);
repeated documents and labels count as often as they occur; null labels are not learned from.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from askloom.llm.common import staged, utf8
from askloom.llm.quality_rules import DIGITS, PUNCT, SYMBOLS, UPPER, repeated_words

FEATURES = [
    "log_words", "word_chars", "symbols", "upper", "punct", "digits", "dup_lines", "repeat", "distinct",
    "shouted", "bars", "short_words", "line_words", "exclaim", "stops",
]
#: Rows that the fit sees at most: 20,000 rows of 15 doubles are 2.4 MB.
SAMPLE = 20_000
FOLDS = 5
THRESHOLD = 0.3
MAX_BINS = 32
ROUNDS = 60
PAIR_ROUNDS = 20
PAIRS = 5
RATE = 0.25
CUTS = 3


def features(data: bytes) -> list[float]:
    words = data.split()
    n = len(words)
    if not n:
        return [0.0] * len(FEATURES)
    solid = b"".join(words)
    size = len(solid)
    share = lambda chars: (size - len(solid.translate(None, chars))) / size
    lines = [x for x in data.split(b"\n") if x and not x.isspace()]
    return [
        float(np.log1p(n)), size / n, share(SYMBOLS), share(UPPER), share(PUNCT), share(DIGITS),
        1 - len(set(lines)) / len(lines), repeated_words(words) / n, len(set(words)) / n,
        sum(map(bytes.isupper, words)) / n, words.count(b"|") / n, sum(len(w) < 4 for w in words) / n,
        float(np.log1p(n / len(lines))), share(b"!"), share(b".,"),
    ]


class AdditiveModel:
    """Bin edges, tables per feature, tables per pair, and the intercept (log odds)."""

    def __init__(self, edges: list[np.ndarray], tables: list[np.ndarray], pairs: dict, base: float):
        self.edges, self.tables, self.pairs, self.base = edges, tables, pairs, base

    def bins(self, x: np.ndarray) -> np.ndarray:
        return np.stack([np.searchsorted(e, x[:, j], side="right") for j, e in enumerate(self.edges)], axis=1)

    def margin(self, bins: np.ndarray) -> np.ndarray:
        total = np.full(len(bins), self.base)
        for j, t in enumerate(self.tables):
            total += t[bins[:, j]]
        for (i, j), t in self.pairs.items():
            total += t[bins[:, i], bins[:, j]]
        return total

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-self.margin(self.bins(x)))) if len(x) else np.zeros(0)


def _gain(g: np.ndarray, h: np.ndarray) -> np.ndarray:
    return g * g / (h + 1.0)


def _tree(g: np.ndarray, h: np.ndarray, cuts: int) -> np.ndarray:
    """Greedy splits of a row of bins; the step of each leaf, per bin."""
    parts, out = [(0, len(g))], np.zeros(len(g))
    for _ in range(cuts):
        best = (1e-9, None)
        for k, (a, b) in enumerate(parts):
            cg, ch = np.cumsum(g[a:b]), np.cumsum(h[a:b])
            if b - a < 2:
                continue
            gain = _gain(cg[:-1], ch[:-1]) + _gain(cg[-1] - cg[:-1], ch[-1] - ch[:-1]) - _gain(cg[-1], ch[-1])
            at = int(np.argmax(gain))
            if gain[at] > best[0]:
                best = (gain[at], (k, a + at + 1))
        if best[1] is None:
            break
        k, cut = best[1]
        a, b = parts[k]
        parts[k: k + 1] = [(a, cut), (cut, b)]
    for a, b in parts:
        out[a:b] = g[a:b].sum() / (h[a:b].sum() + 1.0)
    return out


def _cross_tree(g: np.ndarray, h: np.ndarray) -> tuple[float, np.ndarray]:
    """One cut in each of two features: four leaves, and the gain over none."""
    cg, ch = g.cumsum(0).cumsum(1), h.cumsum(0).cumsum(1)
    ends = lambda c: [c[:-1, :-1], c[:-1, -1:] - c[:-1, :-1], c[-1:, :-1] - c[:-1, :-1],
                      c[-1, -1] - c[:-1, -1:] - c[-1:, :-1] + c[:-1, :-1]]
    gain = sum(_gain(a, b) for a, b in zip(ends(cg), ends(ch)))
    i, j = np.unravel_index(int(np.argmax(gain)), gain.shape)
    out = np.zeros_like(g)
    for rows in (slice(None, i + 1), slice(i + 1, None)):
        for cols in (slice(None, j + 1), slice(j + 1, None)):
            out[rows, cols] = g[rows, cols].sum() / (h[rows, cols].sum() + 1.0)
    return float(gain[i, j] - _gain(cg[-1, -1], ch[-1, -1])), out


def fit(x: np.ndarray, y: np.ndarray) -> AdditiveModel:
    n, p = x.shape
    edges = []
    for j in range(p):
        cuts = np.unique(np.quantile(x[:, j], np.linspace(0, 1, MAX_BINS + 1)[1:-1])) if n else np.zeros(0)
        edges.append(cuts)
    rate = (y.sum() + 1) / (n + 2)
    model = AdditiveModel(edges, [np.zeros(len(e) + 1) for e in edges], {}, float(np.log(rate / (1 - rate))))
    if n == 0 or y.min() == y.max():
        return model
    bins = model.bins(x)
    margin = model.margin(bins)

    def slopes():
        q = 1 / (1 + np.exp(-margin))
        return y - q, q * (1 - q)

    for _ in range(ROUNDS):
        for j in range(p):
            g, h = slopes()
            size = len(model.tables[j])
            step = RATE * _tree(np.bincount(bins[:, j], g, size), np.bincount(bins[:, j], h, size), CUTS)
            model.tables[j] += step
            margin += step[bins[:, j]]

    def grid(i, j, values):
        shape = len(model.tables[i]), len(model.tables[j])
        return np.bincount(bins[:, i] * shape[1] + bins[:, j], values, shape[0] * shape[1]).reshape(shape)

    g, h = slopes()
    usable = [j for j in range(p) if len(edges[j])]
    gains = {(i, j): _cross_tree(grid(i, j, g), grid(i, j, h))[0] for i in usable for j in usable if i < j}
    for pair in sorted(gains, key=lambda k: (-gains[k], k))[:PAIRS]:
        model.pairs[pair] = np.zeros([len(model.tables[k]) for k in pair])
    for _ in range(PAIR_ROUNDS):
        for (i, j), t in model.pairs.items():
            g, h = slopes()
            step = RATE * _cross_tree(grid(i, j, g), grid(i, j, h))[1]
            t += step
            margin += step[bins[:, i], bins[:, j]]
    return model


def featured(docs: DataFrame, id_col: str, text: str) -> DataFrame:
    """``doc_id, x``: the feature vector of every row."""
    kind = dict(docs.dtypes)[id_col]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [features(v.as_py()) for v in batch.column(1)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(rows, pa.list_(pa.float64()))], names=[id_col, "x"]
            )

    return docs.select(id_col, utf8(text)).mapInArrow(run, f"`{id_col}` {kind}, x array<double>")


def fold(id_col: str, folds: int = FOLDS):
    return F.crc32(F.col(id_col).cast("string")) % folds


def train(
    rows: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", label: str = "quality",
    sample: int = SAMPLE, folds: int = FOLDS,
) -> AdditiveModel:
    """Fit on at most ``sample`` labelled rows of ``rows`` (with ``x``) outside fold 0."""
    known = labels.where(F.col(label).isNotNull() & (fold(id_col, folds) != 0)).select(
        id_col, F.col(label).cast("double").alias("_y"), F.xxhash64(id_col).alias("_h")
    )
    # The sample is the labels with the smallest hashes, so it is the same in every run.
    chosen = known.orderBy("_h", id_col, "_y").limit(sample)
    got = rows.join(chosen, id_col).select("_h", id_col, "_y", "x").orderBy("_h", id_col, "_y").limit(sample).toPandas()
    x = np.array(got["x"].tolist(), dtype=float).reshape(len(got), len(FEATURES))
    return fit(x, got["_y"].to_numpy(dtype=float))


def quality_scores(
    docs: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", text: str = "text",
    label: str = "quality", threshold: float = THRESHOLD, sample: int = SAMPLE, folds: int = FOLDS,
) -> DataFrame:
    """``doc_id, held_out, score, predicted`` for every row of ``docs``."""
    kind = dict(docs.dtypes)[id_col]
    rows = staged(featured(docs, id_col, text), "features")
    model = train(rows, labels, id_col=id_col, label=label, sample=sample, folds=folds)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = np.asarray(batch.column(1).flatten()).reshape(-1, len(FEATURES))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(model.score(x), pa.float64())], names=[id_col, "score"]
            )

    return rows.mapInArrow(run, f"`{id_col}` {kind}, score double").select(
        id_col, F.coalesce(fold(id_col, folds) == 0, F.lit(False)).alias("held_out"), "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"),
    )


def crc_fold(doc_id: int, folds: int = FOLDS) -> int:
    """The same rule for one id, for tests."""
    return zlib.crc32(str(doc_id).encode()) % folds
