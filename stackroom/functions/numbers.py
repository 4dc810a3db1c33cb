"""Decimal rounding of doubles by their exact binary value, ties to even.

``round`` works on the shortest decimal form and rounds ties up, which moves values such as 0.0078125
(six digits) or 1.0005 (three digits) to the other neighbour.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

SPLIT = float((1 << 27) + 1)


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with the value computed once, however often the body mentions it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def round_exact(value: Column, digits: int) -> Column:
    """Nearest multiple of ``10**-digits``, ties to even; keeps the sign of zero."""
    scale = float(10**digits)

    def rounded(x: Column, below: Column) -> Column:
        size, middle = F.abs(x), (below + 0.5) / scale
        # Sign of (middle * 2 * scale - (2 * below + 1)), with the product split so that no bit is lost.
        spread = middle * SPLIT
        high = spread - (spread - middle)
        excess = (high * (2 * scale) - (2 * below + 1)) + (middle - high) * (2 * scale)
        up = (size > middle) | (
            (size == middle) & ((excess > 0) | ((excess == 0) & (F.pmod(below, F.lit(2.0)) == 1)))
        )
        nearest = F.when(up, below + 1).otherwise(below) / scale
        return F.when(x < 0, -nearest).when(x.isNotNull(), nearest)

    return let(
        value.cast("double"),
        lambda x: let(F.floor(F.abs(x) * scale).cast("double"), lambda below: rounded(x, below)),
    )


def steady_sum(value: Column, digits: int = 12) -> Column:
    """Sum of doubles that does not depend on the order of the rows: added up as decimals.

    Values that are no finite number of this size (NaN, infinities, 1e16 and more) are left out, as nulls are.
    """
    return F.sum(value.try_cast(f"decimal(28,{digits})")).cast("double")


def fixed(value: Column, digits: int) -> Column:
    """Text with exactly ``digits`` decimals of :func:`round_exact`."""
    return F.format_string(f"%.{digits}f", round_exact(value, digits))
