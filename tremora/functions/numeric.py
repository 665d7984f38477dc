"""Rounding, finiteness and blankness as columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def half_up(x: Column, places: int = 0) -> Column:
    """floor(x * 10^places + 0.5) / 10^places: halves go up for negative numbers too, unlike round()."""
    return F.floor(x * float(10**places) + 0.5) / float(10**places)


def bin_of(x: Column, width: float) -> Column:
    """The histogram bin nearest to x, halves up, free of the noise of binary fractions to three places."""
    per = 1.0 / width
    return half_up(F.floor(x * per + 0.5) / per, 3)


def finite(x: Column) -> Column:
    """Neither null, NaN nor infinite; never null itself."""
    return F.coalesce(~F.isnan(x) & (F.abs(x) != float("inf")), F.lit(False))


def blank(x: Column) -> Column:
    return F.coalesce(F.length(F.trim(x)) == 0, F.lit(True))
