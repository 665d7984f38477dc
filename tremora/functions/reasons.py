"""Reason codes: which of several conditions hold, all of them or the first."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def _holds(condition: Column) -> Column:
    return F.coalesce(condition, F.lit(False))


def all_reasons(conditions: Mapping[str, Column]) -> Column:
    """The codes whose condition is true, in order, as an array without nulls."""
    return F.array_compact(F.array(*(F.when(_holds(c), code) for code, c in conditions.items())))


def reasons_of(bits: Column, codes: Sequence[str]) -> Column:
    """The codes whose bit is set, the first code's lowest, as all_reasons has them; in code that Spark compiles."""
    none = F.array().cast("array<string>")
    one = [F.when(bits.bitwiseAND(1 << i) != 0, F.array(F.lit(code))).otherwise(none) for i, code in enumerate(codes)]
    return F.when(bits == 0, none).otherwise(F.flatten(F.array(*one)))


def first_reason(conditions: Mapping[str, Column]) -> Column:
    """The first code whose condition is true, else null."""
    return F.coalesce(*(F.when(_holds(c), code) for code, c in conditions.items()), F.lit(None).cast("string"))
