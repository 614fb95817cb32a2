"""Numeric helpers shared by facts and checks."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def round2(c: Column, scale: int = 2) -> Column:
    """Round half-up to ``scale`` decimals through an exact decimal.

    Rounding the double directly depends on its binary expansion (2.675 is stored as
    2.67499...); going through DECIMAL(38,10) first gives the decimal reading, which is
    what a person expects and what other engines agree on.
    """
    return F.round(c.try_cast("decimal(38,10)"), scale).cast("double")


def pct(part: Column, whole: Column) -> Column:
    """``part / whole * 100`` rounded to 2 decimals; NULL when ``whole`` is 0 or NULL."""
    return round2(F.try_divide(part.cast("double"), whole.cast("double")) * F.lit(100.0))
