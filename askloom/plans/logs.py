"""Write the request log, the assessment log and the rejects of a payload table."""

from __future__ import annotations

from pyspark.sql import DataFrame

from askloom.operators.payloads import dedup_assessments, unpack_payloads
from askloom.session import scratch_path
from askloom.sources.tables import write_merged


def write_logs(
    payloads: DataFrame,
    request_table: str,
    assessment_table: str,
    reject_table: str | None = None,
    *,
    granularity: str | None = "hour",
    vendor: str = "",
) -> None:
    """Replace the tables, keeping columns they have and the payloads lack.

    The payloads are parsed once, into a stage that is laid down by kind. The assessments are
    de-duplicated: the review app logs every change of its widgets. Without ``reject_table`` payloads that are
    neither requests nor assessments are left out.
    """
    logs = unpack_payloads(payloads, vendor, stage=scratch_path(payloads.sparkSession, "payloads"))
    write_merged(logs.request_log, request_table)
    write_merged(dedup_assessments(logs.assessment_log, granularity), assessment_table)
    if reject_table is not None:
        write_merged(logs.rejects, reject_table)
