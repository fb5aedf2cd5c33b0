r"""Quality rules: word statistics, and robust outliers by minimum covariance determinant.

Every document is measured in one narrow pass. Documents that pass the plain rules (enough
words, little repetition) are compared with their language and source: the minimum covariance
determinant estimate of location and scatter of transformed statistics, and a Mahalanobis
distance above a chi-square quantile rejects.

The estimate is fitted on all documents of a group by concentration steps, each one an
aggregation: distances under the current estimate fall into fine logarithmic bins, every
(group, bin) sums counts, first and second moments, and the nearest bins that reach the share
``core`` make the next estimate. No group is ever gathered; a source with a third of all rows
sends one row per bin and task. A group with fewer than ``min_group`` documents is judged by the
estimate over all documents.

Defined cases: a null text is empty; empty and short texts fail the plain rules; repeated rows
are measured each for itself; null language or source is a group of its own; an empty table gives
an empty result. Extra columns of the input are not touched.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from askloom.llm.common import SPACE, map_rows, staged, utf8

SYMBOLS = b"#*$%&|<>"
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
#: The transformed statistics and the smallest standard deviation each is credited with: shares
#: are square roots, so that a few odd characters in a clean text stay near the middle. The root of a
#: share of n units has a noise of 1 / (2 sqrt(n)): 25 lines, and the 50 words of the shortest text. Each
#: must stay well below 1 / sqrt(limit) = 0.18, or its statistic alone could never reject.
FEATURES = {
    "log_word_chars": 0.08,
    "root_symbols": 0.04,
    "root_upper": 0.06,
    "root_punct": 0.06,
    "root_digits": 0.06,
    "root_dup_lines": 0.1,
    "root_repeat": 0.07,
}
CORE = 0.75
STEPS = 6
MIN_GROUP = 100
#: Share of clean documents that a normal model would keep: one in 10,000 is lost, and a text of four
#: lines with one of them twice stays.
KEEP_QUANTILE = 0.9999
BINS_PER_OCTAVE = 8

STATS = (
    "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
    "n_lines long, n_upper long, n_punct long, n_digits long"
)
UPPER = bytes(range(65, 91))
DIGITS = bytes(range(48, 58))
PUNCT = bytes(b for b in range(33, 127) if not chr(b).isalnum())


def repeated_words(words: list[bytes], window: int = 3) -> int:
    """Words inside windows of ``window`` words that occur at least twice in the text."""
    n = len(words) - window + 1
    if n < 2:
        return 0
    ids: dict[bytes, int] = {}
    seq = np.fromiter((ids.setdefault(w, len(ids)) for w in words), np.int64, len(words))
    code = seq[:n]
    for i in range(1, window):
        if len(ids) > 1 << 20:  # keep the pair code below 64 bits
            code = np.unique(code, return_inverse=True)[1]
        code = code * len(ids) + seq[i: i + n]
    _, inverse, counts = np.unique(code, return_inverse=True, return_counts=True)
    again = counts[inverse] > 1
    hit = np.zeros(len(words), dtype=bool)
    for i in range(window):
        hit[i: i + n] |= again
    return int(hit.sum())


def text_stats(data: bytes) -> tuple[int, ...]:
    words = data.split()
    solid = data.translate(None, SPACE)
    without = lambda chars: len(solid) - len(solid.translate(None, chars))
    lines = [line for line in data.split(b"\n") if line and not line.isspace()]
    return (
        len(words), len(solid.decode("utf-8", "replace")), without(SYMBOLS),
        len(lines) - len(set(lines)), repeated_words(words), len(lines),
        without(UPPER), without(PUNCT), without(DIGITS),
    )


def measure(docs: DataFrame, keep: list[str], text: str = "text") -> DataFrame:
    """``keep`` columns and the statistics of every whole text."""
    kinds = dict(docs.dtypes)
    schema = ", ".join([*(f"`{c}` {kinds[c]}" for c in keep), STATS])
    source = docs.select(*keep, utf8(text).alias("_bytes"))
    return map_rows(source, lambda: lambda *row: (*row[:-1], *text_stats(row[-1])), schema)


def base_failed() -> Column:
    few = F.col("n_words") < MIN_WORDS
    return few | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))


def vector() -> list[Column]:
    share = lambda a, b: F.sqrt(F.col(a) / F.greatest(F.col(b), F.lit(1)))
    columns = {
        "log_word_chars": F.log(F.col("word_chars") / F.greatest(F.col("n_words"), F.lit(1))),
        "root_symbols": share("n_symbols", "word_chars"),
        "root_upper": share("n_upper", "word_chars"),
        "root_punct": share("n_punct", "word_chars"),
        "root_digits": share("n_digits", "word_chars"),
        "root_dup_lines": share("n_dup_lines", "n_lines"),
        "root_repeat": share("n_repeat_words", "n_words"),
    }
    return [columns[name].alias(name) for name in FEATURES]


def chi2_cdf(x: float, k: float) -> float:
    """Chi-square distribution by the series of the incomplete gamma function."""
    if x <= 0:
        return 0.0
    a, z = k / 2, x / 2
    term = total = 1 / a
    n = 0
    while term > total * 1e-17:
        n += 1
        term *= z / (a + n)
        total += term
    return min(1.0, total * math.exp(a * math.log(z) - z - math.lgamma(a)))


def chi2_quantile(q: float, k: float) -> float:
    low, high = 0.0, 10.0 * k + 200
    for _ in range(200):
        mid = (low + high) / 2
        low, high = (mid, high) if chi2_cdf(mid, k) < q else (low, mid)
    return high


P = len(FEATURES)
PAIRS = [(i, j) for i in range(P) for j in range(i + 1)]
MODEL = ", ".join(["_g string", *(f"m{i} double" for i in range(P)),
                   *(f"w{i}_{j} double" for i, j in PAIRS)])


def _model_row(group: str, mean: np.ndarray, cov: np.ndarray) -> list:
    """Location and the lower-triangular whitening matrix; variances have the stated floors."""
    cov = cov + np.diag(np.square(list(FEATURES.values())))
    white = np.linalg.inv(np.linalg.cholesky(cov))
    return [group, *mean, *(white[i, j] for i, j in PAIRS)]


def _fitted(groups: DataFrame, fit: Callable[[dict], list]) -> DataFrame:
    """One row of ``MODEL`` per row of ``groups``, in Arrow: workers need not load pandas."""
    names = [c.split()[0] for c in MODEL.split(", ")]
    types = [pa.string(), *[pa.float64()] * (len(names) - 1)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [fit(r) for r in batch.to_pylist()]
            columns = zip(*rows) if rows else [()] * len(names)
            yield pa.RecordBatch.from_arrays([pa.array(list(c), type=t) for c, t in zip(columns, types)], names=names)

    return groups.mapInArrow(run, MODEL)


def _models(moments: DataFrame, scale: float) -> DataFrame:
    """One small matrix inversion per row of ``moments`` (one row per group)."""

    def fit(r: dict) -> list:
        mean = np.array([r[f"s{i}"] for i in range(P)]) / r["n"]
        cov = np.zeros((P, P))
        for i, j in PAIRS:
            cov[i, j] = cov[j, i] = r[f"q{i}_{j}"] / r["n"] - mean[i] * mean[j]
        return _model_row(r["_g"], mean, cov * scale)

    return _fitted(moments, fit)


def distance() -> Column:
    names = list(FEATURES)
    total = F.lit(0.0)
    for i in range(P):
        z = F.lit(0.0)
        for j in range(i + 1):
            z = z + F.col(f"w{i}_{j}") * (F.col(names[j]) - F.col(f"m{j}"))
        total = total + z * z
    return total


def _sums() -> list[Column]:
    names = list(FEATURES)
    return [
        F.count(F.lit(1)).alias("n"),
        *(F.sum(names[i]).alias(f"s{i}") for i in range(P)),
        *(F.sum(F.col(names[i]) * F.col(names[j])).alias(f"q{i}_{j}") for i, j in PAIRS),
    ]


def fit_mcd(
    points: DataFrame, *, core: float = CORE, steps: int = STEPS, min_group: int = MIN_GROUP
) -> DataFrame:
    """The robust model per group of ``points`` (``_g`` and the features), and one named null over all.

    Starts from medians and quartiles, then concentration steps. A bin of distances is taken
    whole or not at all, so ties never depend on the order of rows.
    """
    both = points.unionByName(points.withColumn("_g", F.lit(None).cast("string")))
    names = list(FEATURES)
    quarters = both.groupBy("_g").agg(
        F.count(F.lit(1)).alias("n"),
        *(F.percentile_approx(c, [0.25, 0.5, 0.75], 2000).alias(c) for c in names),
    ).where(F.col("_g").isNull() | (F.col("n") >= min_group))

    def start(r: dict) -> list:
        low, mid, high = np.array([r[c] for c in names]).T
        return _model_row(r["_g"], mid, np.diag(np.square((high - low) / 1.349)))

    model = staged(_fitted(quarters, start), "mcd")
    # A normal core of this share has a smaller scatter than the whole: undo that.
    scale = core / chi2_cdf(chi2_quantile(core, P), P + 2)
    sums = _sums()
    before = Window.partitionBy("_g").orderBy("_bin")
    for _ in range(steps):
        binned = both.join(model, both["_g"].eqNullSafe(model["_g"])).drop(model["_g"]).withColumn(
            "_bin", F.floor(F.log2(distance() + 1e-6) * BINS_PER_OCTAVE)
        ).groupBy("_g", "_bin").agg(*sums)
        kept = (
            binned.withColumn("_all", F.sum("n").over(Window.partitionBy("_g")))
            .withColumn("_before", F.sum("n").over(before) - F.col("n"))
            .where(F.col("_before") < core * F.col("_all"))
        )
        columns = ["n", *(f"s{i}" for i in range(P)), *(f"q{i}_{j}" for i, j in PAIRS)]
        moments = kept.groupBy("_g").agg(*(F.sum(c).alias(c) for c in columns))
        model = staged(_models(moments, scale), "mcd")
    return model


def quality_rules(
    docs: DataFrame,
    *,
    id_col: str = "doc_id",
    keep_quantile: float = KEEP_QUANTILE,
    core: float = CORE,
    steps: int = STEPS,
    min_group: int = MIN_GROUP,
) -> DataFrame:
    """Statistics, ``base_failed``, ``distance`` (squared; null if base_failed) and ``kept``.

    One row per row of ``docs`` (columns ``text``, ``lang``, ``source`` and the id).
    """
    stats = measure(docs, [id_col, "lang", "source"])
    group = F.to_json(F.struct("lang", "source"))
    points = staged(
        stats.select("*", group.alias("_g"), base_failed().alias("base_failed"), *vector()), "stats"
    )
    model = fit_mcd(
        points.where(~F.col("base_failed")).select("_g", *FEATURES),
        core=core, steps=steps, min_group=min_group,
    )
    parts = [c.split()[0] for c in MODEL.split(", ")][1:]
    # The one row over all documents, for groups too small to be fitted.
    whole = model.where(F.col("_g").isNull()).first() or dict.fromkeys(parts)
    own = model.where(F.col("_g").isNotNull())
    used = points.select("_g").distinct().join(own, "_g", "left").select(
        "_g", *(F.coalesce(F.col(c), F.lit(whole[c]).cast("double")).alias(c) for c in parts)
    )
    limit = chi2_quantile(keep_quantile, P)
    judged = points.join(used, "_g", "left").withColumn(
        "distance", F.when(~F.col("base_failed"), distance())
    )
    return judged.select(
        id_col, "lang", "source", *[c.split()[0] for c in STATS.split(", ")],
        *FEATURES, "base_failed", "distance",
        F.coalesce(~F.col("base_failed") & (F.col("distance") <= limit), F.lit(False)).alias("kept"),
    )
