"""Rows near the newest one, and top-k reports."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def last_hours(df: DataFrame, step: str = "step", hours: int = 24 * 30) -> DataFrame:
    """Rows whose step lies in [newest - hours, newest], both ends included.

    The newest step is a scalar subquery: computed once, then an ordinary filter on the scan side.
    """
    newest = df.agg(F.max(step)).scalar()
    return df.where(F.col(step).between(newest - hours, newest))


def top(df: DataFrame, n: int, *order: Column | str, ties: Sequence[str]) -> DataFrame:
    """First n rows by `order`, then by `ties`, so that the choice is always the same."""
    return df.orderBy(*order, *ties).limit(n)
