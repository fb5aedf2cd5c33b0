"""Hilbert curve order: a state table made by rule, and its use in SQL and in numpy.

A cell of the curve is entered at a corner ``e`` and runs along an axis ``d``; the pair is the
state (Hamilton and Rau-Chaplin, Compact Hilbert indices). For each state and each choice of one
bit per dimension the table gives the digit of the key and the state inside that sub-cell.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
from pyspark.sql import Column, functions as F


def _gray(i: int) -> int:
    return i ^ (i >> 1)


@lru_cache
def tables(dims: int) -> tuple[np.ndarray, np.ndarray]:
    """(digit, next state), both indexed by ``state << dims | bits``; the first state is 0."""
    n, full = dims, (1 << dims) - 1
    turn = lambda x, k: ((x << (k % n)) | (x >> (n - k % n))) & full if k % n else x
    ungray = {_gray(i): i for i in range(1 << n)}

    def trailing_ones(i: int) -> int:
        return 0 if not i & 1 else 1 + trailing_ones(i >> 1)

    def corner(i: int) -> int:
        return 0 if i == 0 else _gray(2 * ((i - 1) // 2))

    def axis(i: int) -> int:
        if i == 0:
            return 0
        return trailing_ones(i if i & 1 else i - 1) % n

    digit = np.zeros((n << n) << n, dtype=np.int64)
    after = np.zeros_like(digit)
    for e in range(1 << n):
        for d in range(n):
            for bits in range(1 << n):
                w = ungray[turn(bits ^ e, n - (d + 1) % n)]
                at = (e * n + d) << n | bits
                digit[at] = w
                after[at] = (e ^ turn(corner(w), d + 1)) * n + (d + axis(w) + 1) % n
    return digit, after


def hilbert_column(coords: list[Column], bits: int) -> Column:
    """The key of integer coordinates below ``2 ** bits``, as a SQL expression (one fold over the bits)."""
    n = len(coords)
    digit, after = (F.array(*map(F.lit, t.tolist())) for t in tables(n))

    def step(acc: Column, level: Column) -> Column:
        cell = F.lit(0).cast("bigint")
        for i, c in enumerate(coords):
            bit = F.call_function("shiftright", c.cast("bigint"), level).bitwiseAND(F.lit(1).cast("bigint"))
            cell = cell + bit * (1 << i)
        at = (acc["state"] * (1 << n) + cell + 1).cast("int")
        return F.struct(
            F.element_at(after, at).cast("bigint").alias("state"),
            (acc["key"] * (1 << n) + F.element_at(digit, at)).cast("bigint").alias("key"),
        )

    zero = F.struct(F.lit(0).cast("bigint").alias("state"), F.lit(0).cast("bigint").alias("key"))
    return F.aggregate(F.sequence(F.lit(bits - 1), F.lit(0)), zero, step, lambda acc: acc["key"])


def hilbert_keys(coords: np.ndarray, bits: int) -> np.ndarray:
    """The same for an array of shape (rows, dims)."""
    n = coords.shape[1]
    digit, after = tables(n)
    key = np.zeros(len(coords), dtype=np.int64)
    state = np.zeros(len(coords), dtype=np.int64)
    for level in range(bits - 1, -1, -1):
        cell = (((coords >> level) & 1) << np.arange(n)).sum(axis=1)
        at = (state << n) | cell
        key = (key << n) | digit[at]
        state = after[at]
    return key
