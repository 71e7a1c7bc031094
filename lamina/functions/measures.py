"""Aggregate and ratio expressions of the marts.

Means and ratios are rounded half-up on decimals, never on binary doubles, so that
the printed digits do not depend on the order in which a sum was built.

No value stops a mart: what a decimal can't hold (beyond 31 digits before the point, NaN,
infinity) has no rounded value and gives null.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

EXACT = "decimal(20,6)"
WIDE = "decimal(38,6)"
COUNT = "decimal(20,0)"


def round_exact(c: Column, digits: int) -> Column:
    """Half-up; means of up to 31 digits before the point keep their value."""
    return F.round(c.try_cast(WIDE), digits)


def avg_round(c: Column, digits: int = 1) -> Column:
    return round_exact(F.avg(c), digits)


def rate(part: Column, whole: Column, digits: int = 2) -> Column:
    """Percentage of two counts or sums of counts; null when ``whole`` is 0."""
    safe = F.nullif(whole.cast(COUNT), F.lit(0).cast(COUNT))
    return F.round(part.cast(COUNT) * F.lit(100).cast("decimal(3,0)") / safe, digits)


def ratio(a: Column, b: Column, digits: int = 1) -> Column:
    """Quotient of two measures that are already rounded; null when ``b`` is 0."""
    safe = F.nullif(b.try_cast(EXACT), F.lit(0).cast(EXACT))
    return F.round(a.try_cast(EXACT) / safe, digits)


def product_round(a: Column, b: Column, digits: int = 0) -> Column:
    """Rounded product, null if either side is null."""
    return F.round((a * b).try_cast(WIDE), digits)
