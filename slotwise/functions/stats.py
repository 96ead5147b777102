"""Column expressions for cell checks and scores."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from slotwise.functions.time import quoted


def number_or_null(metric: str) -> Column:
    """The metric as a double, with NaN treated as a missing cell."""
    number = f"cast({quoted(metric)} as double)"
    return F.expr(f"if(isnan({number}), null, {number})")


def zscore(metric: str) -> Column:
    """Distance from the carried mean in carried standard deviations.

    NULL when the deviation is unknown (fewer than two observations) or zero,
    so such cells are neither inside nor outside a threshold.
    """
    value, mean, deviation = (quoted(metric + end) for end in ("", "_mean", "_stddev"))
    return F.expr(f"abs(try_divide({value} - {mean}, {deviation}))")
