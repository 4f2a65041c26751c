"""Gripper opening and width."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: width of the fully open gripper when only the opening is known.
DEFAULT_MAX_WIDTH_M = 0.08


def _finite(x: Column) -> Column:
    inf = float("inf")
    return x.isNotNull() & ~F.isnan(x) & (x > -inf) & (x < inf)


def clamp(x: Column, low: float = 0.0, high: float = 1.0) -> Column:
    return F.greatest(F.lit(low), F.least(F.lit(high), x))


def opening_unit(raw: Column, scale: str = "auto") -> Column:
    """Opening as 0..1. ``auto`` reads values above 1 as percent."""
    if scale not in ("auto", "unit", "percent"):
        raise ValueError(f"unknown gripper scale: {scale}")
    value = {
        "unit": raw,
        "percent": raw / 100.0,
        "auto": F.when(raw > 1.0, raw / 100.0).otherwise(raw),
    }[scale]
    return F.when(_finite(raw), clamp(value)).otherwise(F.lit(0.0))


def opening_binary(raw: Column, scale: str = "auto", threshold: float = 0.5) -> Column:
    """1.0 when open at or above the threshold, else 0.0."""
    return F.when(opening_unit(raw, scale) >= threshold, F.lit(1.0)).otherwise(F.lit(0.0))


def width_m(
    explicit: list[Column],
    unit: Column,
    low: float = 0.0,
    high: float = DEFAULT_MAX_WIDTH_M,
) -> Column:
    """First explicit width that is finite and not negative, else linear in the opening."""
    low, high = min(low, high), max(low, high)
    known = [F.when(_finite(w) & (w >= 0), w) for w in explicit]
    return F.coalesce(*known, F.lit(low) + clamp(unit) * F.lit(high - low))


def marker_width(left_x: Column, right_x: Column) -> Column:
    """Width from two marker positions, or twice the only one's distance from the axis."""
    return (
        F.when(left_x.isNotNull() & right_x.isNotNull(), right_x - left_x)
        .when(left_x.isNotNull(), F.abs(left_x) * 2.0)
        .when(right_x.isNotNull(), F.abs(right_x) * 2.0)
    )
