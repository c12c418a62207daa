"""Pairs of boxes on a page that overlap or lie near, by a grid: boxes meet in the cells that they share.

A pair is kept in one cell only, that of the corner where the two boxes (one grown by the reach) begin to overlap.
Boxes over more than ``MANY`` cells are few on a page; they meet all boxes of it, so no box is put in many cells.
Boxes with a null coordinate have no pair, ones with swapped corners are none either.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

CELL, MANY = 128.0, 64


def _cell(value: Column, size: float) -> Column:
    return F.floor(value / size)


def _span(low: Column, high: Column, size: float) -> Column:
    return F.sequence(_cell(low, size), _cell(high, size))


def _placed(boxes: DataFrame, prefix: str, page: list[str], grow: float, size: float) -> DataFrame:
    """Boxes with prefixed columns, the bounds that are dealt to cells, and whether those are many."""
    named = boxes.select(*page, *[F.col(c).alias(prefix + c) for c in boxes.columns if c not in page])
    x0, y0, x1, y1 = (F.col(prefix + c) for c in ("x0", "y0", "x1", "y1"))
    rows = named.where((x0 <= x1) & (y0 <= y1))
    bounds = F.struct((x0 - grow).alias("l"), (y0 - grow).alias("t"), (x1 + grow).alias("r"), (y1 + grow).alias("b"))
    rows = rows.withColumn(f"{prefix}at", bounds)
    at = F.col(f"{prefix}at")
    count = (_cell(at["r"], size) - _cell(at["l"], size) + 1) * (_cell(at["b"], size) - _cell(at["t"], size) + 1)
    return rows.withColumn(f"{prefix}many", count > MANY)


def _dealt(rows: DataFrame, prefix: str, size: float) -> DataFrame:
    at = F.col(f"{prefix}at")
    across = rows.where(~F.col(f"{prefix}many")).withColumn("cx", F.explode(_span(at["l"], at["r"], size)))
    return across.withColumn("cy", F.explode(_span(at["t"], at["b"], size)))


def near_pairs(left: DataFrame, right: DataFrame, page: list[str], reach: float = 0.0, size: float = CELL) -> DataFrame:
    """Pairs (page, a_ and b_ columns) of boxes whose sides, ``reach`` added, overlap or touch; each pair once."""
    a, b = _placed(left, "a_", page, reach, size), _placed(right, "b_", page, 0.0, size)
    p, q = F.col("a_at"), F.col("b_at")
    meets = (p["l"] <= q["r"]) & (q["l"] <= p["r"]) & (p["t"] <= q["b"]) & (q["t"] <= p["b"])
    first = (_cell(F.greatest(p["l"], q["l"]), size) == F.col("cx")) & (_cell(F.greatest(p["t"], q["t"]), size) == F.col("cy"))
    celled = _dealt(a, "a_", size).join(_dealt(b, "b_", size), [*page, "cx", "cy"]).where(meets & first).drop("cx", "cy")
    wide = a.where("a_many").join(b, page).where(meets)
    wide = wide.unionByName(a.where("not a_many").join(b.where("b_many"), page).where(meets))
    return celled.unionByName(wide).drop("a_at", "b_at", "a_many", "b_many")
