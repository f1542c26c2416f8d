"""Repeatable draws from a row's own id.

``rand(seed)`` depends on how rows fall into partitions, so a retried task or a
different cluster gives other data. These draws depend on the id alone: an affine
step followed by x^5 over a prime field, which permutes the field and breaks the
regular pattern of consecutive ids. An id beyond the prime has a high part; each stream
weighs it differently, so two ids below the prime squared (4.6e18) never agree in two streams.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

PRIME = 2147483647  # 2^31 - 1; x -> x^5 is a permutation modulo this prime
MULTIPLIER = 48271
HIGH_MULTIPLIER = 69621


def draw(row_id: Column, stream: int) -> Column:
    """An integer in [0, PRIME), independent-looking per ``stream``."""
    start = F.lit(1013904223 + 97531 * stream)
    whole, prime = row_id.cast("bigint"), F.lit(PRIME).cast("bigint")
    low = F.pmod(whole, prime)
    high = F.pmod(F.call_function("div", whole - low, prime), prime) * F.lit(HIGH_MULTIPLIER + stream)
    step = F.pmod(low * F.lit(MULTIPLIER) + high + start, prime)
    square = F.pmod(step * step, F.lit(PRIME))
    return F.pmod(F.pmod(square * square, F.lit(PRIME)) * step, F.lit(PRIME))


def draw_below(row_id: Column, stream: int, n: int | Column) -> Column:
    """A whole number in [0, n)."""
    bound = F.lit(n) if isinstance(n, int) else n
    return F.floor(draw(row_id, stream) * bound / F.lit(PRIME)).cast("int")


def pick(row_id: Column, stream: int, values: Sequence) -> Column:
    """One of ``values``, each equally likely; repeat a value to weight it."""
    return F.element_at(
        F.array(*[F.lit(v) for v in values]), draw_below(row_id, stream, len(values)) + 1
    )


def pick_weighted(row_id: Column, stream: int, percent: dict[str, int]) -> Column:
    """One of the keys, by whole-percent weights."""
    if sum(percent.values()) != 100:
        raise ValueError("weights must add up to 100")
    roll = draw_below(row_id, stream, 100)
    names = list(percent)
    chain, upper = None, 0
    for name in names[:-1]:
        upper += percent[name]
        chain = (F if chain is None else chain).when(roll < upper, F.lit(name))
    return F.lit(names[0]) if chain is None else chain.otherwise(F.lit(names[-1]))
