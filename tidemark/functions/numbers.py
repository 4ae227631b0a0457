"""Arithmetic that survives bad input: ratios, floors, guarded integers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemark.functions import as_column


def cubed(c: str | Column, wide: bool = False) -> Column:
    """n·n·n as an integer (``pow`` would give a double).

    BIGINT holds cubes up to 2,097,151³ and fails loudly beyond; ``wide`` uses
    DECIMAL for larger numbers.
    """
    n = as_column(c).cast("decimal(12,0)" if wide else "bigint")
    return n * n * n


def scaled(c: str | Column, factor: float = 2) -> Column:
    return as_column(c) * F.lit(factor)


def multiple_above(c: str | Column, divisor: int, bound: int) -> Column:
    """True for multiples of ``divisor`` that are larger than ``bound``."""
    n = as_column(c)
    return (n % F.lit(divisor) == 0) & (n > F.lit(bound))


def ratio(top: str | Column, bottom: str | Column) -> Column:
    """Double quotient, null where the divisor is zero."""
    return F.try_divide(as_column(top).cast("double"), as_column(bottom).cast("double"))


def floor_to(c: str | Column, decimals: int = 2) -> Column:
    step = F.lit(float(10 ** decimals))
    return F.floor(as_column(c) * step).cast("double") / step


def int_or_zero(c: str | Column) -> Column:
    """Whole number from text or number, fractions cut; null and anything unreadable become 0."""
    n = as_column(c)
    return F.coalesce(n.try_cast("bigint"), n.try_cast("double").try_cast("bigint"),
                      F.lit(0).cast("bigint"))
