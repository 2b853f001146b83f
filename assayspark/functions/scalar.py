"""Scalar numeric functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def log2p1(c: Column) -> Column:
    """log2(x + 1)."""
    return F.log2(c + 1)


def clip(c: Column, lo: float, hi: float) -> Column:
    """clip to [lo, hi]; NaN stays NaN only if both bounds pass it (Spark: greatest(1, NaN) = NaN)."""
    return F.greatest(F.lit(lo), F.least(F.lit(hi), c))


def safe_reciprocal(c: Column) -> Column:
    """1 / max(n, 1)."""
    return F.lit(1.0) / F.greatest(c, F.lit(1))
