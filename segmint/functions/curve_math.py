"""Scalar maths on curve points."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def slope(k1, s1, k2, s2) -> Column:
    """Δs/Δk, 0 when Δk is 0."""
    dk = (_c(k2) - _c(k1)).cast("double")
    return F.when(dk == 0, F.lit(0.0)).otherwise((_c(s2) - _c(s1)) / dk)


def midpoint(x1, y1, x2, y2) -> tuple[Column, Column]:
    """(x1 + |x2−x1|/2, y1 + |y2−y1|/2).

    This is the reference's formula: it is not the midpoint when y falls
    from the first to the last point. Kept on purpose.
    """
    mx = _c(x1) + F.abs(_c(x2) - _c(x1)) / 2.0
    my = _c(y1) + F.abs(_c(y2) - _c(y1)) / 2.0
    return mx, my
