"""Exact ratios, means and labels."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(value: str | Column) -> Column:
    return F.col(value) if isinstance(value, str) else value


def ratio(num: str | Column, den: str | Column, scale: int = 2, times: int = 100) -> Column:
    """``num * times / den`` rounded half away from zero, NULL for a zero ``den``.

    Both sides are whole numbers; the rounding is done on integers, so neither
    the order of summation nor binary fractions can move the last digit.
    """
    n = _col(num).cast("decimal(19,0)")
    d = F.nullif(_col(den).cast("decimal(19,0)"), F.lit(0).cast("decimal(19,0)"))
    step = F.lit(2 * times * 10**scale).cast("decimal(12,0)")
    units = F.call_function("div", F.abs(n) * step + d, d * F.lit(2).cast("decimal(1,0)"))
    return F.when(n < 0, -units).otherwise(units) / F.lit(10.0**scale)


def mean(total: str | Column, count: str | Column, scale: int | None = None) -> Column:
    """Average from a sum and a count; rounded exactly when ``scale`` is given."""
    if scale is None:
        return _col(total) / F.nullif(_col(count), F.lit(0))
    return ratio(total, count, scale, times=1)


def quarter_label(date: str | Column) -> Column:
    """Text like ``2021-Q3``."""
    day = _col(date)
    return F.concat(F.year(day).cast("string"), F.lit("-Q"), F.quarter(day).cast("string"))


def banded(value: Column, bands: list[tuple[float, str]], otherwise: str | int) -> Column:
    """Label of the first band whose lower bound ``value`` exceeds."""
    out = None
    for bound, label in bands:
        out = F.when(value > bound, label) if out is None else out.when(value > bound, label)
    return out.otherwise(otherwise)
