"""Per-run summaries and reports as tables."""

from __future__ import annotations

from pyspark.sql import DataFrame

from askloom.operators.reports import avg_metrics_by_run, eval_report, metrics_long, report_rows


def summarise_run(metrics: DataFrame, run: str | None = None, **options) -> DataFrame:
    """(run, metric, value) rows: the mean of every metric of one run, or of all runs."""
    return metrics_long(avg_metrics_by_run(metrics, run=run, **options))


def report_run(metrics: DataFrame, assessments: DataFrame, run: str | None = None) -> DataFrame:
    """All evaluation rows of a run with their ratings, as text columns."""
    return report_rows(eval_report(metrics, assessments, run=run))
