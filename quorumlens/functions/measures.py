"""Ratios used by the statistics."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import constants as K


def jaccard(shared: Column, left: Column, right: Column) -> Column:
    """Shared over union from three counts, four decimals; 0 for an empty union."""
    union = left + right - shared
    return F.when(union > 0, F.round(shared / union, 4)).otherwise(F.lit(0.0))


def per_million(total: Column, announced: Column) -> Column:
    """Rate per million announced addresses, one decimal; NULL below a /24."""
    return F.when(
        announced >= K.MIN_ANNOUNCED, F.round(total / (announced / F.lit(1_000_000.0)), 1)
    )


def log_shade(count: Column, peak: Column) -> Column:
    """0.07 for empty, else 0.2..1.0 on a logarithmic scale."""
    return F.when(count == 0, F.lit(0.07)).otherwise(
        F.lit(0.2) + F.lit(0.8) * F.log1p(count) / F.log1p(F.greatest(peak, F.lit(1)))
    )


def share(part: Column, whole: Column, digits: int = 0) -> Column:
    """Percentage, NULL-free: 0 when the whole is 0."""
    return F.when(whole > 0, F.round(part * F.lit(100.0) / whole, digits)).otherwise(F.lit(0.0))
