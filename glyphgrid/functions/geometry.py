"""Rectangles as column expressions over prefixes: (prefix)x0, y0, x1, y1."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def side(prefix: str) -> tuple[Column, Column, Column, Column]:
    return tuple(F.col(f"{prefix}{c}") for c in ("x0", "y0", "x1", "y1"))


def area(prefix: str = "") -> Column:
    x0, y0, x1, y1 = side(prefix)
    return (x1 - x0) * (y1 - y0)


def intersection(a: str, b: str) -> Column:
    ax0, ay0, ax1, ay1 = side(a)
    bx0, by0, bx1, by1 = side(b)
    zero = F.lit(0.0)
    return F.greatest(zero, F.least(ax1, bx1) - F.greatest(ax0, bx0)) * F.greatest(zero, F.least(ay1, by1) - F.greatest(ay0, by0))


def overlap_ratio(a: str, b: str) -> Column:
    """Intersection over the smaller area; 0 where that isn't positive."""
    small = F.least(area(a), area(b))
    return F.when(small > 0, intersection(a, b) / small).otherwise(0.0)


def gap_distance(a: str, b: str) -> Column:
    """0 if rectangles touch, else the Euclidean gap."""
    ax0, ay0, ax1, ay1 = side(a)
    bx0, by0, bx1, by1 = side(b)
    zero = F.lit(0.0)
    dx = F.greatest(zero, bx0 - ax1, ax0 - bx1)
    dy = F.greatest(zero, by0 - ay1, ay0 - by1)
    return F.sqrt(dx * dx + dy * dy)
