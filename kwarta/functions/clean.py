"""Typing and masking of payload text. Bad text becomes null, it never fails the job."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def timestamp_of(text: str) -> Column:
    return F.try_to_timestamp(F.col(text))


def amount_of(text: str) -> Column:
    return F.col(text).try_cast("decimal(14,2)")


def fingerprint(column: str) -> Column:
    """SHA-256 of personal data, as hex; null stays null."""
    return F.sha2(F.col(column), 256)
