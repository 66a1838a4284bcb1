"""The twenty reports and the dashboard datasets.

Every report takes a ``ClaimsModel`` and returns a DataFrame. ``limit=None``
returns all rows of a top-k report. Every ordering ends in a unique column, so
a report has one answer.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame


def top(df: DataFrame, order: list[Column], limit: int | None) -> DataFrame:
    """Sorted rows, cut to ``limit`` without sorting the rest."""
    ordered = df.orderBy(*order)
    return ordered if limit is None else ordered.limit(limit)
