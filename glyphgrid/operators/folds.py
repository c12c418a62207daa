"""Order-dependent page folds over Arrow batches.

Rows are grouped and sorted by page, which deals them only if they aren't dealt by
page yet, and a worker reads them as a stream: it holds one page at a time, and a
page costs no call of its own.
"""

from __future__ import annotations

from collections.abc import Callable
from itertools import chain, groupby

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from glyphgrid.operators.layout import PAGE


def by_page(rows: DataFrame, order: list[str], fold: Callable[[list], list], schema: str) -> DataFrame:
    """Rows of each page through ``fold``, in the given order."""
    names = rows.columns

    def run(batches):
        stream = chain.from_iterable(b.itertuples(index=False, name="Row") for b in batches)
        out: list = []
        for _, page in groupby(stream, key=lambda r: (r.doc_id, r.page_no)):
            out += fold(list(page))
            if len(out) >= 10_000:
                yield pd.DataFrame(out)
                out = []
        if out:
            yield pd.DataFrame(out)

    held = F.struct(*order, *[c for c in names if c not in (*PAGE, *order)])
    dealt = rows.groupBy(*PAGE).agg(F.array_sort(F.collect_list(held)).alias("held")).select(*PAGE, F.explode("held").alias("held"))
    return dealt.select(*PAGE, "held.*").select(*names).mapInPandas(_named(run, schema), schema)


def _named(run, schema: str):
    names = [part.split()[0] for part in schema.split(", ")]

    def renamed(batches):
        for frame in run(batches):
            frame.columns = names
            yield frame

    return renamed


def _overlap(a, b) -> float:
    small = min((a[2] - a[0]) * (a[3] - a[1]), (b[2] - b[0]) * (b[3] - b[1]))
    if small <= 0:
        return 0.0
    return max(0.0, min(a[2], b[2]) - max(a[0], b[0])) * max(0.0, min(a[3], b[3]) - max(a[1], b[1])) / small


def area(box) -> float:
    return max(0.0, box.x1 - box.x0) * max(0.0, box.y1 - box.y0)


def keeps_first(first, second) -> bool:
    """Whether a segment wins over an embedded image that overlaps it: by caption, size, variance, drawings and score."""
    own = 3 * bool(first.captioned) + 2 * ((first.n_drawings or 0) > 10)
    other = 2 * ((second.grey_var or 0) > 1000) + (second.score > 0.7)
    if area(first) > 1.2 * area(second):
        own += 2
    elif area(second) > 1.2 * area(first):
        other += 1
    return own > other


def conflict_fold(candidates: DataFrame, *more: str) -> DataFrame:
    """Segments that stay when embedded images (pass 2) come one after another upon caption regions (pass 1).

    An image meets the first segment kept so far that it overlaps by more than 0.4;
    if the image wins, that segment goes and the image comes last. ``place`` counts from 1.
    ``more`` columns of the candidates are carried along.
    """
    types = candidates.schema

    def fold(page: list) -> list:
        kept: list = []
        for row in page:
            at = next((i for i, k in enumerate(kept) if _overlap((k.x0, k.y0, k.x1, k.y1), (row.x0, row.y0, row.x1, row.y1)) > 0.4), None) if row.pass_no > 1 else None
            if at is not None and keeps_first(kept[at], row):
                continue
            if at is not None:
                kept.pop(at)
            kept.append(row)
        return [(r.doc_id, r.page_no, r.pass_no, r.idx, i + 1, r.x0, r.y0, r.x1, r.y1, *[getattr(r, c) for c in more]) for i, r in enumerate(kept)]

    names = list(dict.fromkeys([*PAGE, "pass_no", "idx", "x0", "y0", "x1", "y1", "captioned", "grey_var", "score", "n_drawings", *more]))
    schema = "doc_id long, page_no long, pass_no int, idx int, place int, x0 double, y0 double, x1 double, y1 double"
    return by_page(candidates.select(*names), ["pass_no", "idx"], fold, ", ".join([schema, *[f"{c} {types[c].dataType.simpleString()}" for c in more]]))


def new_regions(candidates: DataFrame) -> DataFrame:
    """Drawing regions (pass 2) that no earlier region covers by over half and that hold no caption; all caption regions (pass 1).

    A caption (``c_x0``, ``c_y0``) is held if it starts within the region's width and within 50 of its lower edge.
    """

    def fold(page: list) -> list:
        kept: list = []
        captions = [r for r in page if r.pass_no == 1]
        for row in page:
            if row.pass_no > 1:
                shared = (max(0.0, min(row.x1, k.x1) - max(row.x0, k.x0)) * max(0.0, min(row.y1, k.y1) - max(row.y0, k.y0)) for k in kept)
                if any(x > area(row) * 0.5 for x in shared) or any(row.x0 <= c.c_x0 <= row.x1 and row.y1 - 50 <= c.c_y0 <= row.y1 + 50 for c in captions):
                    continue
            kept.append(row)
        return [(r.doc_id, r.page_no, r.pass_no, r.idx, i + 1, r.x0, r.y0, r.x1, r.y1) for i, r in enumerate(kept)]

    names = [*PAGE, "pass_no", "idx", "x0", "y0", "x1", "y1", "c_x0", "c_y0"]
    return by_page(candidates.select(*names), ["pass_no", "idx"], fold, "doc_id long, page_no long, pass_no int, idx int, place int, x0 double, y0 double, x1 double, y1 double")


def drawing_clusters(drawings: DataFrame, reach: float = 100.0, least: int = 3) -> DataFrame:
    """Seeded groups of drawings (page, draw_no, box): members lie closer than ``reach`` to the seed; small groups go."""

    def gap(a, b) -> float:
        dx, dy = max(0.0, b[0] - a[2], a[0] - b[2]), max(0.0, b[1] - a[3], a[1] - b[3])
        return (dx * dx + dy * dy) ** 0.5

    def cluster(page: list) -> list:
        # places of drawings by the squares that they cover; the long ones are looked at by every seed
        squares: dict[tuple[int, int], set[int]] = {}
        places: list[list[tuple[int, int]]] = []
        long: list[int] = []
        for k, r in enumerate(page):
            own = [(x, y) for x in range(int(r.x0 // reach), int(r.x1 // reach) + 1) for y in range(int(r.y0 // reach), int(r.y1 // reach) + 1)] if (r.x1 - r.x0) * (r.y1 - r.y0) <= 100 * reach * reach and max(r.x1 - r.x0, r.y1 - r.y0) <= 100 * reach else None
            if own is None:
                long.append(k)
            places.append(own or [])
            for square in places[k]:
                squares.setdefault(square, set()).add(k)
        free, found = [True] * len(page), []
        for k, seed in enumerate(page):
            if not free[k]:
                continue
            box = (seed.x0, seed.y0, seed.x1, seed.y1)
            if k in long:
                around = range(len(page))
            else:
                around = sorted({*long, *(j for x in range(int(seed.x0 // reach) - 1, int(seed.x1 // reach) + 2) for y in range(int(seed.y0 // reach) - 1, int(seed.y1 // reach) + 2) for j in squares.get((x, y), ()))})
            taken = [j for j in around if free[j] and gap(box, (page[j].x0, page[j].y0, page[j].x1, page[j].y1)) < reach]
            near = [page[j] for j in taken]
            for j in taken:
                free[j] = False
                for square in places[j]:  # a drawing taken is met by no later seed
                    squares[square].remove(j)
            if len(near) >= least:
                found.append((seed.doc_id, seed.page_no, seed.draw_no, len(near), min(r.x0 for r in near), min(r.y0 for r in near), max(r.x1 for r in near), max(r.y1 for r in near)))
        return found

    rows = drawings.select(*PAGE, "draw_no", "x0", "y0", "x1", "y1")
    return by_page(rows, ["draw_no"], cluster, "doc_id long, page_no long, seed_no int, n int, x0 double, y0 double, x1 double, y1 double")


def drawing_regions(clusters: DataFrame, page_width: float, page_height: float, pad: float = 10.0) -> DataFrame:
    """Padded bounds of clusters, cut to the page, that are neither tiny nor nearly the page."""
    boxes = clusters.selectExpr(*PAGE, "seed_no", f"greatest(0D, x0 - {pad}) as x0", f"greatest(0D, y0 - {pad}) as y0", f"least({page_width}D, x1 + {pad}) as x1", f"least({page_height}D, y1 + {pad}) as y1")
    return boxes.where(f"(x1 - x0) * (y1 - y0) > 5000 and (x1 - x0) * (y1 - y0) < {0.8 * page_width * page_height}")
