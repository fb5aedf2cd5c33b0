"""Retrieval and response metrics.

Relevance is binary. precision@k = hits in the first k / k; recall@k = hits / expected (null
when nothing is expected); nDCG@k discounts rank r by log2(r + 1) and divides by the ideal
ranking. A retrieved id counts once, at its best rank.
"""

from __future__ import annotations

from collections.abc import Sequence
from math import log2

from pyspark.sql import Column, DataFrame, functions as F

from askloom.fixed_values import METRIC_KS
from askloom.functions.text import token_count
from askloom.operators.keys import skew_join


def _discounts(k: int) -> list[float]:
    return [1.0 / log2(rank + 1) for rank in range(1, k + 1)]


def _ideal(n_expected: Column, k: int) -> Column:
    """Best possible discounted sum with ``n_expected`` relevant ids; null without any."""
    totals, total = [], 0.0
    for d in _discounts(k):
        total += d
        totals.append(total)
    at = F.least(n_expected.cast("int"), F.lit(k))
    return F.when(at > 0, F.element_at(F.array(*[F.lit(t) for t in totals]), at))


def _sum(values: Column) -> Column:
    return F.aggregate(values, F.lit(0.0), lambda total, x: total + x)


def retrieval_metrics(
    answers: DataFrame,
    *,
    expected: str = "expected_retrieval_context",
    retrieved: str = "retrieval_context",
    ks: Sequence[int] = METRIC_KS,
) -> DataFrame:
    """``answers`` plus ``ground_truth_{precision,recall,ndcg}_at_k`` from two chunk arrays.

    The arrays lie in the row, so everything is a projection. For relevance that is not
    listed per row use :func:`ranked_metrics`.
    """
    def ids(name: str) -> Column:
        chunks = F.coalesce(F.col(name), F.array())
        return F.array_distinct(F.filter(F.transform(chunks, lambda c: c["chunk_id"]),
                                         lambda x: x.isNotNull()))

    top = max(ks)
    kept = [F.col(c) for c in answers.columns]
    marked = answers.select(
        *kept, F.slice(ids(retrieved), 1, top).alias("_got"), ids(expected).alias("_want")
    ).select(
        *kept,
        F.size("_want").alias("_n"),
        F.transform(
            "_got", lambda x: F.array_contains(F.col("_want"), x).cast("double")
        ).alias("_hit"),
    )
    columns = []
    for k in ks:
        first = F.slice("_hit", 1, k)
        weights = F.array(*[F.lit(d) for d in _discounts(k)])
        gain = _sum(F.zip_with(first, weights, lambda h, w: F.coalesce(h, F.lit(0.0)) * w))
        columns += [
            (_sum(first) / k).alias(f"ground_truth_precision_at_{k}"),
            F.try_divide(_sum(first), F.col("_n")).alias(f"ground_truth_recall_at_{k}"),
            F.try_divide(gain, _ideal(F.col("_n"), k)).alias(f"ground_truth_ndcg_at_{k}"),
        ]
    return marked.select(*kept, *columns)


def ranked_metrics(
    hits: DataFrame,
    queries: DataFrame | None = None,
    *,
    by: str = "query_key",
    rank: str = "rank",
    relevant: str = "relevant",
    n_expected: str = "n_expected",
    ks: Sequence[int] = METRIC_KS,
) -> DataFrame:
    """The same metrics from one row per hit, with the number of relevant ids alongside.

    Nothing but the k hits of a query meets in a group, however many ids are relevant. A query
    without hits has no row here unless it stands in ``queries`` (one row per ``by``, with
    ``n_expected``): then its precision is 0, and its recall 0, or null where nothing is expected.
    """
    hit = F.col(relevant)
    aggregates = []
    for k in ks:
        near = hit & (F.col(rank) <= k)
        aggregates += [
            F.count_if(near).alias(f"_h{k}"),
            F.sum(F.when(near, F.lit(1.0) / F.log2(F.col(rank) + 1)).otherwise(0.0)).alias(f"_g{k}"),
        ]
    grouped = hits.groupBy(by).agg(F.max(n_expected).alias("_n"), *aggregates)
    if queries is not None:
        found = [c for k in ks for c in (f"_h{k}", f"_g{k}")]
        grouped = queries.select(by, F.col(n_expected).alias("_n")).join(
            grouped.drop("_n"), by, "left"
        ).na.fill(0, found)
    columns = []
    for k in ks:
        columns += [
            (F.col(f"_h{k}") / k).alias(f"ground_truth_precision_at_{k}"),
            F.try_divide(f"_h{k}", "_n").alias(f"ground_truth_recall_at_{k}"),
            F.try_divide(F.col(f"_g{k}"), _ideal(F.col("_n"), k)).alias(f"ground_truth_ndcg_at_{k}"),
        ]
    return grouped.select(by, *columns)


def expected_by_category(
    queries: DataFrame, chunks: DataFrame, *, asked: str = "query_category",
    category: str = "category",
) -> DataFrame:
    """``queries`` plus ``n_expected``: all chunks of the question's category are expected.

    They enter as a count per category. Listing them per question would square the largest
    category; whether a hit is relevant shows from its own category (:func:`mark_relevant`).
    """
    totals = chunks.groupBy(F.col(category).alias(asked)).agg(F.count(F.lit(1)).alias("n_expected"))
    return skew_join(queries, totals, [asked], "left").withColumn(
        "n_expected", F.coalesce("n_expected", F.lit(0))
    )


def mark_relevant(
    hits: DataFrame, *, asked: str = "query_category", category: str = "category"
) -> DataFrame:
    return hits.withColumn("relevant", F.col(asked).eqNullSafe(F.col(category)))


def judged_precision(
    df: DataFrame, *, ratings: str = "positional_ratings", ks: Sequence[int] = METRIC_KS
) -> DataFrame:
    """``df`` plus ``llm_judged_precision_at_k`` from an array of booleans in rank order.

    Null where a rating among the first k is missing, or the whole array is; fewer than k hits count
    as they are, out of k.
    """
    flags = F.transform(ratings, lambda r: r.cast("double"))
    return df.select(
        "*", *[(_sum(F.slice(flags, 1, k)) / k).alias(f"llm_judged_precision_at_{k}") for k in ks]
    )


def response_metrics(
    df: DataFrame, *, response: str = "response", expected: str = "expected_response"
) -> DataFrame:
    """``df`` plus the words of the response and whether it equals the expected one, blanks at either end aside.

    The match is null where nothing is expected, and false where the response is missing.
    """
    same = F.trim(F.col(response)).eqNullSafe(F.trim(F.col(expected)))
    return df.select(
        "*",
        token_count(F.col(response)).alias("token_count"),
        F.when(F.col(expected).isNotNull(), same).alias("exact_match"),
    )
