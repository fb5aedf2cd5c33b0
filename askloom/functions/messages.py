"""Expressions over chat message arrays and traces."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def last_message(messages: Column) -> Column:
    """Content of the newest message; null for an empty list."""
    return F.try_element_at(messages, F.lit(-1))["content"]


def chat_history(messages: Column) -> Column:
    """All messages but the newest."""
    return F.slice(messages, F.lit(1), F.greatest(F.size(messages) - 1, F.lit(0)))


def trace_bounds(steps: Column) -> Column:
    """Start of the first step and end of the last one; nulls when there are none."""
    return F.struct(
        F.try_element_at(steps, F.lit(1))["start_timestamp"].alias("start_timestamp"),
        F.try_element_at(steps, F.lit(-1))["end_timestamp"].alias("end_timestamp"),
    )
