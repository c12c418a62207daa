"""Pairs by a grid against all pairs of a page, and how many rows that takes on a crowded page."""

import random

import pytest
from pyspark.sql import functions as F

from glyphgrid.operators import folds, layout, spatial

BOXES = "doc_id long, page_no long, id long, x0 double, y0 double, x1 double, y1 double"


def boxes(n: int, seed: int, wide: float = 60.0, pages: int = 3, size: float = 900.0) -> list[tuple]:
    draw = random.Random(seed)
    out = []
    for i in range(n):
        x, y = draw.uniform(-200, size), draw.uniform(-200, size)
        big = draw.random() < 0.03
        w, h = (draw.uniform(0, size * 3) if big else draw.uniform(0, wide) for _ in range(2))
        out.append((1, i % pages, i, x, y, x + w, y + h))
    return out


def gap(a, b) -> float:
    dx, dy = max(0.0, b[3] - a[5], a[3] - b[5]), max(0.0, b[4] - a[6], a[4] - b[6])
    return (dx * dx + dy * dy) ** 0.5


@pytest.mark.parametrize("reach", [0.0, 37.5])
@pytest.mark.parametrize("size", [8.0, 128.0])
def test_near_pairs(spark, reach, size):
    left, right = boxes(150, 1), [*boxes(150, 2), (1, 0, 900, None, 0.0, 1.0, 1.0), (1, 0, 901, 5.0, 5.0, 1.0, 9.0), (1, 0, 902, 128.0, 128.0, 256.0, 256.0)]
    found = spatial.near_pairs(spark.createDataFrame(left, BOXES), spark.createDataFrame(right, BOXES), ["doc_id", "page_no"], reach, size)
    got = sorted((r.a_id, r.b_id) for r in found.collect())
    grown = [(*a[:3], a[3] - reach, a[4] - reach, a[5] + reach, a[6] + reach) for a in left]
    want = sorted((a[2], b[2]) for a in grown for b in right if a[1] == b[1] and b[2] not in (900, 901) and a[3] <= b[5] and b[3] <= a[5] and a[4] <= b[6] and b[4] <= a[6])
    assert got == want and len(want) > 50


def test_near_boxes(spark):
    rows = boxes(200, 5)
    got = {(r.a_id, r.b_id): r.distance for r in layout.near_boxes(spark.createDataFrame(rows, BOXES), 40.0).collect()}
    want = {(a[2], b[2]): gap(a, b) for a in rows for b in rows if a[1] == b[1] and a[2] < b[2] and gap(a, b) < 40}
    assert got.keys() == want.keys() and all(abs(got[k] - want[k]) < 1e-9 for k in want)


def test_a_crowded_page(spark):
    """100,000 drawings of one page: cells hold a few each, so candidates grow with the drawings, not their square."""
    rows = spark.range(100_000).select(F.lit(1).cast("long").alias("doc_id"), F.lit(1).cast("long").alias("page_no"), "id", (F.col("id") % 400 * 150).cast("double").alias("x0"), (F.floor(F.col("id") / 400) * 150).cast("double").alias("y0"))
    rows = rows.withColumn("x1", F.col("x0") + 160).withColumn("y1", F.col("y0") + 20)
    a = spatial._placed(rows, "a_", ["doc_id", "page_no"], 0.0, spatial.CELL)
    assert spatial._dealt(a, "a_", spatial.CELL).count() < 500_000
    assert layout.overlap_pairs(rows, rows).where("a_id < b_id").count() == 399 * 250


def plain_clusters(page: list, reach: float, least: int) -> list:
    free, found = sorted(page, key=lambda r: r[2]), []
    while free:
        near = [r for r in free if gap(free[0], r) < reach]
        if len(near) >= least:
            found.append((free[0][2], len(near)))
        free = [r for r in free if r not in near]
    return found


def test_clusters(spark):
    rows = boxes(300, 9, wide=90.0, pages=2, size=2500.0)
    frame = spark.createDataFrame(rows, BOXES).withColumn("draw_no", F.col("id").cast("int"))
    got = sorted((r.page_no, r.seed_no, r.n) for r in folds.drawing_clusters(frame, reach=100.0, least=3).collect())
    assert got == sorted((p, *c) for p in (0, 1) for c in plain_clusters([r for r in rows if r[1] == p], 100.0, 3)) and len(got) > 5
