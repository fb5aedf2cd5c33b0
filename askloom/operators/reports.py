"""Summaries and reports over evaluation tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from askloom.fixed_values import METRICS
from askloom.session import cut


def avg_metrics_by_run(
    metrics: DataFrame,
    *,
    run_col: str = "run_url",
    run: str | None = None,
    names: Sequence[str] = METRICS,
) -> DataFrame:
    """Mean of every metric per run, each cast to float first; ``run`` picks a single one."""
    short = [name.split(".")[-1] for name in names]
    if len(set(short)) != len(short):
        raise ValueError("metric names must differ after their prefix is dropped")
    if run is not None:
        metrics = metrics.where(F.col(run_col) == F.lit(run))
    means = [F.avg(F.col(n).cast("float")).alias(s) for n, s in zip(names, short)]
    return metrics.groupBy(run_col).agg(*means)


def metrics_long(summary: DataFrame, *, run_col: str = "run_url") -> DataFrame:
    """One row (run, metric, value) per averaged metric; metrics without a value are left out."""
    values = [c for c in summary.columns if c != run_col]
    return summary.unpivot([run_col], values, "metric", "value").where("value IS NOT NULL")


JUDGED = [
    "harmful", "faithful_to_context", "relevant_to_question_and_context",
    "relevant_to_question", "answer_good",
]


def eval_report(
    metrics: DataFrame, assessments: DataFrame, *, run_col: str = "run_url", run: str | None = None
) -> DataFrame:
    """Evaluation rows with the judge's ratings next to them; rows without ratings stay."""
    if run is not None:
        metrics = metrics.where(F.col(run_col) == F.lit(run))
    keys = ["request_id", "app_version"]
    left = metrics.select(
        *keys, "request", "expected_response", "response",
        "expected_retrieval_context", "retrieval_context",
    )
    ratings = F.col("response_assessment")["ratings"]
    right = assessments.select(
        *keys,
        *[ratings[name].alias(f"judge_{name}") for name in JUDGED],
        F.col("retrieval_assessment")["positional_ratings"]
        .alias("judge_context_relevant_to_question"),
    )
    return left.join(right, keys, "left")


def _text(df: DataFrame, name: str) -> Column:
    nested = df.schema[name].dataType.typeName() in ("array", "struct", "map")
    value = F.to_json(name) if nested else F.col(name).cast("string")
    return F.coalesce(value, F.lit("null")).alias(name)


def report_rows(report: DataFrame) -> DataFrame:
    """Every column as text, nested ones as JSON, missing ones as ``null``."""
    return report.select(*[_text(report, c) for c in report.columns])


def json_rows(df: DataFrame, *, keep_nulls: bool = False, out: str = "json") -> DataFrame:
    """Each row as one JSON text; null fields are left out unless asked for."""
    options = {"ignoreNullFields": "false" if keep_nulls else "true"}
    return df.select(F.to_json(F.struct(*df.columns), options).alias(out))


def mean_score(scores: DataFrame, *, system: str = "system", score: str = "score") -> DataFrame:
    return scores.groupBy(system).agg(F.avg(score).alias("mean_score"))


def compare_systems(means: DataFrame, best: str, *, system: str = "system") -> DataFrame:
    """Improvement of ``best`` over every other system, in percent of the other's mean."""
    # A mean per system is written once; the target is a single number.
    means = cut(means.select(F.col(system).alias("against"), "mean_score"))
    row = means.where(F.col("against") == best).select("mean_score").first()
    target = F.lit(None if row is None else row["mean_score"]).cast("double")
    gain = F.try_divide(100 * (target - F.col("mean_score")), F.col("mean_score"))
    return means.where(F.col("against") != best).select("against", gain.alias("improvement_pct"))


def compare_pairs(
    scores: DataFrame, best: str, *, id_col: str = "request_id", system: str = "system", score: str = "score"
) -> DataFrame:
    """``best`` against every other system, request by request.

    Counts only requests that both systems have a score for (``pairs``); ``unpaired`` are the other system's rest.
    ``improvement_pct`` compares the means over the pairs, ``mean_gain`` and ``gain_error`` (its standard error)
    their differences. One join by request: ``best`` has one row of a request at most, and so has each system.
    """
    target = scores.where(F.col(system) == best).select(id_col, F.col(score).alias("_best"))
    both = scores.where(F.col(system) != best).join(target, id_col, "left")
    gain, mine, own = F.col("_best") - F.col(score), F.col("_best"), F.col(score)
    paired = gain.isNotNull()
    sums = both.groupBy(F.col(system).alias("against")).agg(
        F.count_if(paired).alias("pairs"), F.count_if(~paired).alias("unpaired"),
        F.count_if(gain > 0).alias("wins"), F.count_if(gain < 0).alias("losses"), F.count_if(gain == 0).alias("ties"),
        F.avg(F.when(paired, mine)).alias("_mine"), F.avg(F.when(paired, own)).alias("_own"),
        F.avg(gain).alias("mean_gain"), F.stddev_samp(gain).alias("_spread"),
    )
    return sums.select(
        "against", "pairs", "unpaired", "wins", "losses", "ties",
        F.try_divide(100 * (F.col("_mine") - F.col("_own")), F.col("_own")).alias("improvement_pct"), "mean_gain",
        F.try_divide("_spread", F.sqrt("pairs")).alias("gain_error"),
    )


def best_candidate(scores: DataFrame, *, candidate: str = "candidate") -> DataFrame:
    """The candidate with the highest mean score; the smaller id wins a tie."""
    means = scores.groupBy(candidate).agg(F.avg("score").alias("mean_score"))
    order = F.struct("mean_score", -F.col(candidate))
    return means.agg(
        F.max_by(candidate, order).alias(candidate), F.max("mean_score").alias("mean_score")
    )
