"""Exact decimal aggregates: sum and count are kept apart until one final rounding."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from kwarta.functions.clock import micros_between


def total(column: str, dtype: str) -> Column:
    return F.sum(column).cast(dtype)


def mean_millis(micros: Column, n: Column, dtype: str = "decimal(18,2)") -> Column:
    """Average in milliseconds from a sum of microseconds and a count."""
    return F.try_divide(
        micros.cast("decimal(24,0)"), (n * 1000).cast("decimal(18,0)")
    ).cast(dtype)


def mean_delay_millis(start: str, end: str) -> Column:
    """Average time from one instant to another, in milliseconds."""
    delay = micros_between(start, end).cast("decimal(19,0)")
    return mean_millis(F.sum(delay), F.count(delay))


def mean(amount_sum: Column, n: Column, dtype: str = "decimal(12,2)") -> Column:
    """Average from a sum and a count. ``avg`` would round to six places first, this does not."""
    return F.try_divide(amount_sum.cast("decimal(24,2)"), n.cast("decimal(18,0)")).cast(dtype)


def percent(part: Column, whole: Column, dtype: str = "decimal(5,2)") -> Column:
    """``part`` of ``whole`` in per cent, rounded once; null where ``whole`` is zero."""
    scaled = part.cast("decimal(18,0)") * F.lit(100).cast("decimal(3,0)")
    return F.try_divide(scaled, whole.cast("decimal(18,0)")).cast(dtype)
