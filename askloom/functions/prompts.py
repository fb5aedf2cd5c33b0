"""Prompt templates as column expressions.

A template is read once on the driver; text of the rows is only ever concatenated,
so braces inside it are never taken for placeholders.
"""

from __future__ import annotations

from string import Formatter

from pyspark.sql import Column, functions as F

from askloom.fixed_values import CHUNK_TEMPLATE


def render(template: str, variables: dict[str, Column]) -> Column:
    """Fill ``{name}`` placeholders with columns; ``{{`` and ``}}`` are literal braces."""
    parts: list[Column] = []
    for literal, name, _, _ in Formatter().parse(template):
        if literal:
            parts.append(F.lit(literal))
        if name is not None:
            if name not in variables:
                raise KeyError(f"template needs a column for {{{name}}}")
            parts.append(F.coalesce(variables[name].cast("string"), F.lit("")))
    return F.concat(*parts) if parts else F.lit("")


def join_chunks(texts: Column, template: str = CHUNK_TEMPLATE) -> Column:
    """Each text put into the chunk template, joined without a separator."""
    return F.array_join(F.transform(texts, lambda t: render(template, {"chunk_text": t})), "")
