"""Numeric expressions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Fixed value: slack added to a band's upper edge before the comparison.
BAND_SLACK = 0.0001


def equal_width_band(value: Column, low: Column, high: Column, bands: int) -> Column:
    """Number (1..bands) of the first equal-width band of [low, high] reaching ``value``.

    0 if none does. A CASE chain over the few bands stays inside codegen.
    """
    reached = [
        F.when((high - low) * F.lit(i) / F.lit(bands) + low + F.lit(BAND_SLACK) >= value, F.lit(i))
        for i in range(1, bands + 1)
    ]
    return F.coalesce(*reached, F.lit(0))


def packed_pair(text: Column, index: int) -> Column:
    """One number out of a packed ``w1,w2`` field."""
    return F.split(text, ",").getItem(index).cast("double")
