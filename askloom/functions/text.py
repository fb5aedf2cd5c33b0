"""Text expressions: tokens, windows over tokens, cleaning and ids."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from askloom.fixed_values import FORBIDDEN_QUESTION_WORD


def whitespace_tokens(text: Column) -> Column:
    """Tokens between runs of white space; the text is not trimmed first."""
    return F.split(text, r"\s+")


def token_count(text: Column) -> Column:
    """Number of white-space separated words, 0 for blank text, null for null."""
    words = F.filter(F.split(text, r"\s+"), lambda w: w != "")
    return F.when(text.isNotNull(), F.size(words))


def token_windows(tokens: Column, size: int, overlap: int, joiner: str = " ") -> Column:
    """Overlapping windows over a token array, each joined back to text.

    Windows start every ``size - overlap`` tokens; the last one may be short but
    always holds at least one token that no earlier window has.
    """
    if not 0 <= overlap < size:
        raise ValueError(f"overlap must be in [0, size), got size={size} overlap={overlap}")
    step = size - overlap
    last = F.floor((F.greatest(F.size(tokens) - overlap, F.lit(1)) - 1) / step).cast("int")
    starts = F.transform(F.sequence(F.lit(0), last), lambda i: i * step + 1)
    return F.transform(starts, lambda s: F.array_join(F.slice(tokens, s, F.lit(size)), joiner))


def letters_only(text: Column) -> Column:
    """Drop everything but ASCII letters and white space."""
    return F.regexp_replace(text, r"[^a-zA-Z\s]", "")


def short_id(*parts: Column) -> Column:
    """Seven hex characters that depend on ``parts`` only."""
    return F.substring(F.md5(F.concat_ws("#", *parts)), 1, 7)


def random_id(seed: int | None = None) -> Column:
    """Seven random hex characters."""
    return F.substring(F.md5(F.rand(seed).cast("string")), 1, 7)


def stable_number(*parts: Column) -> Column:
    """A non-negative 32-bit number derived from ``parts``; the same on every engine."""
    return F.conv(F.substring(F.md5(F.concat_ws("#", *parts)), 1, 8), 16, 10).cast("bigint")


def says_yes(answer: Column) -> Column:
    """True when a verdict holds 'yes' in any case; null when there is no verdict."""
    return F.lower(answer).contains("yes")


def is_clean_question(question: Column) -> Column:
    return ~question.contains(FORBIDDEN_QUESTION_WORD)
