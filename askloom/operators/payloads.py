"""Unpack logged request/response payloads into a request log and an assessment log."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame, functions as F

from askloom import schemas
from askloom.functions.messages import last_message
from askloom.operators.keys import dedup_latest


class Payloads(NamedTuple):
    request_log: DataFrame
    assessment_log: DataFrame
    rejects: DataFrame


REQUEST, ASSESSMENT, REJECT = "request", "assessment", "reject"


def _path(*names: str) -> str:
    return "$" + "".join(f'["{n}"]' for n in names)


def parse_payloads(payloads: DataFrame, vendor: str = "") -> DataFrame:
    """Successful payloads with a ``kind`` and the needed parts of both JSON texts as typed columns.

    Both texts are parsed to variants and every part is taken from these. A payload is a request if its response
    has choices, an assessment if its request holds any, else a reject; a text that is no
    JSON has no parts, nor has a part of another type than expected. ``vendor`` is the prefix that
    the serving product puts before its own names: ``{vendor}request_id``, ``{vendor}options`` and
    ``{vendor}output``.

    A filter on ``kind`` takes Spark through the texts once more; :func:`stage_payloads` avoids that.
    """
    part = F.try_variant_get
    variants = payloads.where(F.col("status_code") == "200").select(
        F.col(f"{vendor}request_id").alias("request_id"), F.timestamp_millis("timestamp_ms").alias("timestamp"),
        "request", "response", F.try_parse_json("request").alias("_req"), F.try_parse_json("response").alias("_res"),
    )
    choices = part("_res", _path("choices"), "variant")
    parts = variants.select(
        "request_id", "timestamp", "request", "response",
        (choices.isNotNull() & ~F.is_variant_null(choices)).alias("_chosen"),
        part("_res", _path("choices"), schemas.CHOICES).alias("choices"),
        part("_res", _path(f"{vendor}output", "trace"), schemas.TRACE).alias("trace"),
        part("_req", _path("messages"), schemas.MESSAGES).alias("messages"),
        part("_req", _path(f"{vendor}options", "conversation_id"), "string").alias("conversation_id"),
        part("_req", _path("dataframe_records"), schemas.WIRE_RECORDS).alias("records"),
    )
    sent = lambda r: F.coalesce(F.array_size(r["text_assessments"]), F.lit(0)) + F.coalesce(
        F.array_size(r["retrieval_assessments"]), F.lit(0)
    )
    kind = F.when(F.col("_chosen"), REQUEST).when(F.exists("records", lambda r: sent(r) > 0), ASSESSMENT).otherwise(REJECT)
    return parts.withColumn("kind", kind).drop("_chosen")


def stage_payloads(payloads: DataFrame, path: str, vendor: str = "") -> DataFrame:
    """:func:`parse_payloads`, written by kind: each text is parsed once, whatever is then read of it.

    Only rejects keep their texts.
    """
    parsed = parse_payloads(payloads, vendor)
    kept = {c: F.when(F.col("kind") == REJECT, F.col(c)) for c in ("request", "response")}
    parsed.withColumns(kept).write.partitionBy("kind").parquet(path)
    return payloads.sparkSession.read.schema(parsed.schema).parquet(path)


def request_log(parsed: DataFrame) -> DataFrame:
    """Payloads whose response has choices, in the layout of the request log."""
    return parsed.where(F.col("kind") == REQUEST).select(
        F.struct(
            "request_id", "conversation_id", "timestamp", "messages",
            last_message(F.col("messages")).alias("last_input"),
        ).alias("request"),
        "trace",
        F.struct("choices").alias("output"),
    )


def _stored(ratings: Column) -> Column:
    """Wire ratings in table form; numeric ratings are never sent."""
    return F.transform_values(
        ratings,
        lambda _, r: F.struct(
            r["value"].alias("bool_value"),
            F.lit(None).cast("double").alias("double_value"),
            r["rationale"].alias("rationale"),
        ),
    )


def _entries(record: Column) -> Column:
    """All assessments of a record as one array of (text, retrieval), one of them null."""
    no_text = F.lit(None).cast(schemas.TEXT_ASSESSMENT)
    no_retrieval = F.lit(None).cast(schemas.RETRIEVAL_ASSESSMENT)

    def text_entry(a: Column) -> Column:
        return F.struct(
            F.struct(
                a["step_id"].alias("step_id"),
                _stored(a["ratings"]).alias("ratings"),
                a["free_text_comment"].alias("free_text_comment"),
                a["suggested_output"].alias("suggested_output"),
            ).alias("text_assessment"),
            no_retrieval.alias("retrieval_assessment"),
        )

    def retrieval_entry(a: Column) -> Column:
        return F.struct(
            no_text.alias("text_assessment"),
            F.struct(
                a["position"].alias("position"),
                a["step_id"].alias("step_id"),
                _stored(a["ratings"]).alias("ratings"),
                a["free_text_comment"].alias("free_text_comment"),
            ).alias("retrieval_assessment"),
        )

    empty = F.array()
    return F.concat(
        F.coalesce(F.transform(record["text_assessments"], text_entry), empty),
        F.coalesce(F.transform(record["retrieval_assessments"], retrieval_entry), empty),
    )


def assessment_log(parsed: DataFrame) -> DataFrame:
    """One row per assessment sent by the review app, in the layout of the assessment log."""
    records = parsed.where(F.col("kind") == ASSESSMENT).select("timestamp", F.explode("records").alias("r"))
    entries = records.select(
        "r.request_id", "r.source", "timestamp", F.explode(_entries(F.col("r"))).alias("e")
    )
    return entries.select(
        "request_id",
        F.coalesce("e.text_assessment.step_id", "e.retrieval_assessment.step_id").alias("step_id"),
        "source",
        "timestamp",
        "e.text_assessment",
        "e.retrieval_assessment",
    )


def rejects(parsed: DataFrame) -> DataFrame:
    """Payloads that are neither a request nor hold any assessment, as they came."""
    return parsed.where(F.col("kind") == REJECT).select("request_id", "timestamp", "request", "response")


def unpack_payloads(payloads: DataFrame, vendor: str = "", *, stage: str | None = None) -> Payloads:
    """Request log, assessment log and rejects; works on batch and streaming frames alike.

    Only filters, projections and explodes: no shuffle and no state. With ``stage``, a path, the parsed payloads
    are written there first, by kind, and each of the three reads its own part.
    """
    parsed = parse_payloads(payloads, vendor) if stage is None else stage_payloads(payloads, stage, vendor)
    return Payloads(request_log(parsed), assessment_log(parsed), rejects(parsed))


def dedup_assessments(
    assessments: DataFrame, granularity: str | None = None, *, strict: bool = True
) -> DataFrame:
    """The newest assessment of each request, step, reviewer and chunk position.

    ``strict`` (default) keeps text and retrieval assessments apart when the latter have no
    position, and breaks timestamp ties by content; without it only the four keys count.
    """
    keys = [
        F.col("request_id"), F.col("step_id"), F.col("source.id"),
        F.col("retrieval_assessment.position"),
    ]
    tie = []
    if strict:
        keys.append(F.col("text_assessment").isNull())
        tie = [F.to_json(F.struct("text_assessment", "retrieval_assessment"))]
    return dedup_latest(assessments, keys, granularity=granularity, tie=tie)


def pending_reviews(request_ids: DataFrame, log: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Request ids already in the request log, and those still waited for."""
    ids = request_ids.select("request_id").distinct()
    logged = log.select(F.col("request.request_id").alias("request_id"))
    return ids.join(logged, "request_id", "left_semi"), ids.join(logged, "request_id", "left_anti")
