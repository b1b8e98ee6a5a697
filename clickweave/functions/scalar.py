"""Scalar expressions of scoring and profiling."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The probability nudge, the margin bound and the largest bucket.
LOG_LOSS_EPSILON = 1e-11
MARGIN_BOUND = 20.0
LARGEST_BUCKET = 1024
OVERFLOW_BUCKET = -1


def log_loss(p: Column, label: Column) -> Column:
    """Loss of predicting ``p``; only an exact 0 or 1 is nudged, nothing else is clipped."""
    eps = F.lit(LOG_LOSS_EPSILON)
    inside = F.when(p == 0, p + eps).when(p == 1, p - eps).otherwise(p)
    return -F.ln(F.when(label == 1, inside).otherwise(F.lit(1.0) - inside))


def sigmoid(margin: Column) -> Column:
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-margin))


def probability(margin: Column) -> Column:
    """Logistic of the margin, bounded to [-20, 20] first."""
    bound = F.lit(MARGIN_BOUND)
    return sigmoid(F.least(F.greatest(margin, -bound), bound))


def pow2_bucket(n: Column) -> Column:
    """Smallest power of two >= n, up to 1024; -1 beyond."""
    ladder = F.when(n <= 1, 1)
    size = 2
    while size <= LARGEST_BUCKET:
        ladder = ladder.when(n <= size, size)
        size *= 2
    return ladder.otherwise(OVERFLOW_BUCKET)


def fixed_text(number: Column, digits: int = 3) -> Column:
    """A metric for display with so many decimals, halves away from zero; NULL stays NULL."""
    return F.when(number.isNotNull(), F.format_string(f"%.{int(digits)}f", number.cast("double")))


def scientific_text(number: Column, digits: int = 7) -> Column:
    """A metric for display as d.ddde-dd with so many decimals; NULL stays NULL."""
    return F.when(number.isNotNull(), F.format_string(f"%.{int(digits)}e", number.cast("double")))
