"""Pseudo-random numbers from integer arithmetic on positions: the same in any engine, and independent of partitions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: A prime below 2 ** 31, and one below 2 ** 16; products of what is reduced by them fit 64 bits.
PRIME, SMALL = 2147483647, 65521


def mixed(position: Column, a: Column | int, b: int) -> Column:
    """A number below PRIME for a position (below 2 ** 32), a round ``a`` (such as the epoch) and a stream ``b``.

    A linear step alone would keep neighbours in order, so the second step multiplies by a part of the number itself.
    """
    a = F.lit(a) if isinstance(a, int) else a
    x = F.pmod((position + 1) * 1103515245 + (a + 1) * 12345 + F.lit(b * 69621), F.lit(PRIME))
    return F.pmod(x * (F.pmod(x, F.lit(SMALL)) + (a + 1) * 7 + F.lit(b * 31 + 1)), F.lit(PRIME))


def mixed_sql(position: str, a: int, b: int) -> str:
    """The same in SQL."""
    x = f"((({position}) + 1) * 1103515245 + {(a + 1) * 12345 + b * 69621}) % {PRIME}"
    return f"(({x}) * (({x}) % {SMALL} + {(a + 1) * 7 + b * 31 + 1}) % {PRIME})"
