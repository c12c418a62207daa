"""Page-layout operators: captions, neighbourhoods, boundaries of figures, image validation.

Inputs are flat tables keyed by ``PAGE``, a document id and a page number, as page
numbers repeat from document to document: a page's rows meet in range joins on
its key, so tables dealt by page need one exchange in all. What is found of a
region is grouped with the region's own columns (``met``), as a join on the page
and the region would deal all rows once more.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from glyphgrid.functions import geometry as G
from glyphgrid.functions import text as T
from glyphgrid.operators import spatial

BOX = ("x0", "y0", "x1", "y1")
PAGE = ["doc_id", "page_no"]


def prefixed(df: DataFrame, prefix: str, keep: tuple[str, ...] = tuple(PAGE)) -> DataFrame:
    return df.select(*[F.col(c) if c in keep else F.col(c).alias(prefix + c) for c in df.columns])


def met(rows: DataFrame, items: DataFrame, prefix: str, near: Column, *found: Column) -> DataFrame:
    """Rows (page, ..) with aggregates over the page's items (prefixed) that satisfy ``near``; rows without one stay."""
    other = items.select(*[F.col(c).alias(prefix + c) for c in items.columns])
    same = [F.col(c) == F.col(prefix + c) for c in PAGE]
    return rows.join(other, (same[0] & same[1]) & near, "left").groupBy(*rows.columns).agg(*found)


def text_blocks(spans: DataFrame) -> DataFrame:
    """Spans (page, block_no, line_no, span_no, text) joined in reading order, a space after each."""
    ordered = F.array_sort(F.collect_list(F.struct("line_no", "span_no", "text")))
    return spans.groupBy(*PAGE, "block_no").agg(F.trim(F.array_join(F.transform(ordered, lambda s: s["text"]), " ")).alias("text"))


def caption_blocks(blocks: DataFrame) -> DataFrame:
    """Blocks that open with a caption pattern, are no reference and are short."""
    rows = blocks.where(T.is_caption(F.col("text")))
    return rows.withColumn("figure_number", T.caption_number(F.col("text")))


def reference_keys(number: Column) -> Column:
    return F.array(F.concat(F.lit("Figure "), number), F.concat(F.lit("Fig. "), number), F.concat(F.lit("Fig "), number))


def near_text(regions: DataFrame, blocks: DataFrame, near: Column) -> DataFrame:
    """(region_id, text): texts of a page's blocks that satisfy ``near``, in reading order."""
    pairs = regions.join(prefixed(blocks, "b_"), PAGE).where(near)
    ordered = F.array_sort(F.collect_list(F.struct("b_block_no", "b_text")))
    return pairs.groupBy(*PAGE, "region_id").agg(F.array_join(F.transform(ordered, lambda s: s["b_text"]), " ").alias("text"))


def detect_caption(regions: DataFrame, blocks: DataFrame) -> DataFrame:
    """Caption number and text around a region; without a pattern, the first 200 characters."""
    near = (F.abs(F.col("b_y0") - F.col("y1")) < 50) | (F.abs(F.col("y0") - F.col("b_y1")) < 50)
    found = near_text(regions, blocks, near)
    number = T.caption_number(F.col("text"))
    return found.select(*PAGE, "region_id", number.alias("figure_number"), F.when(number.isNotNull(), F.trim(T.caption_body(F.col("text")))).otherwise(F.substring("text", 1, 200)).alias("caption"))


def is_below() -> Column:
    """Whether a block (b_) lies within 60 below a region, overlaps it in x and holds a caption pattern."""
    gap = F.col("b_y0") - F.col("y1")
    across = F.least("x1", "b_x1") - F.greatest("x0", "b_x0")
    return (gap >= 0) & (gap <= 60) & (across > 0) & T.caption_number(F.col("b_text")).isNotNull()


def caption_below(regions: DataFrame, blocks: DataFrame) -> DataFrame:
    """First block within 60 below a region that overlaps it in x and holds a caption pattern."""
    pairs = regions.join(prefixed(blocks, "b_"), PAGE).where(is_below())
    return pairs.groupBy(*PAGE, "region_id").agg(F.min_by("b_text", "b_block_no").alias("caption"))


def expand_to_caption(regions: DataFrame, captions: DataFrame, blocks: DataFrame) -> DataFrame:
    """Regions grown to the first block that holds the caption's first 30 characters; the top stays."""
    return grown(regions.join(captions, [*PAGE, "region_id"], "left"), blocks).drop("caption")


def grown(regions: DataFrame, blocks: DataFrame) -> DataFrame:
    """Regions (page, box, caption, ..) grown to the first block that holds the caption's first 30 characters."""
    holds = F.contains("b_text", F.substring("caption", 1, 30))
    rows = met(regions, blocks.select(*PAGE, "block_no", *BOX, "text"), "b_", holds, F.min_by(F.struct("b_x0", "b_x1", "b_y1"), "b_block_no").alias("b"))
    box = {"x0": F.least("x0", "b.b_x0"), "x1": F.greatest("x1", "b.b_x1"), "y1": F.greatest("y1", "b.b_y1")}
    return rows.select(*[box[c].alias(c) if c in box else F.col(c) for c in regions.columns])


def heading_path(regions: DataFrame, blocks: DataFrame) -> DataFrame:
    """Last three large-type blocks above a region, in reading order."""
    pairs = regions.join(prefixed(blocks, "b_"), PAGE).where((F.col("b_y1") < F.col("y0")) & (F.col("b_font_size") > 12) & (F.length(F.trim("b_text")) > 3))
    ordered = F.transform(F.array_sort(F.collect_list(F.struct("b_block_no", F.trim("b_text").alias("t")))), lambda s: s["t"])
    found = pairs.groupBy(*PAGE, "region_id").agg(ordered.alias("all"))
    return found.select(*PAGE, "region_id", F.array_join(F.slice("all", F.greatest(F.size("all") - 2, F.lit(1)), 3), " > ").alias("heading_path"))


def nearby_text(regions: DataFrame, blocks: DataFrame) -> DataFrame:
    near = F.least(F.abs(F.col("b_y0") - F.col("y1")), F.abs(F.col("y0") - F.col("b_y1"))) < 100
    return near_text(regions, blocks, near).select(*PAGE, "region_id", F.substring("text", 1, 500).alias("nearby_text"))


def overlap_pairs(left: DataFrame, right: DataFrame, least: float = 0.0) -> DataFrame:
    """Overlapping pairs of two tables (page, id, box) with their ratio, and whether they conflict (over 0.4)."""
    pairs = spatial.near_pairs(left, right, PAGE)
    ratio = G.overlap_ratio("a_", "b_")
    return pairs.withColumn("ratio", ratio).where(F.col("ratio") > least).select(*PAGE, "a_id", "b_id", "ratio", (F.col("ratio") > 0.4).alias("conflict"))


def near_boxes(boxes: DataFrame, reach: float) -> DataFrame:
    """(page, a_id, b_id, distance) of boxes (page, id, box) closer than ``reach``, each pair once."""
    pairs = spatial.near_pairs(boxes, boxes, PAGE, reach).where("a_id < b_id").withColumn("distance", G.gap_distance("a_", "b_"))
    return pairs.where(F.col("distance") < reach).select(*PAGE, "a_id", "b_id", "distance")


def in_window(prefix: str) -> Column:
    """Whether an item's top lies up to 500 above the caption (c_ box)."""
    return (F.col(f"{prefix}y0") >= F.greatest(F.lit(0.0), F.col("c_y0") - 500)) & (F.col(f"{prefix}y0") < F.col("c_y0"))


def windowed(captions: DataFrame, items: DataFrame, prefix: str) -> DataFrame:
    """Captions (region_id, c_ box) joined to a page's items whose top lies up to 500 above the caption."""
    return captions.join(prefixed(items, prefix), PAGE).where(in_window(prefix))


def _bounds(name: str) -> list[Column]:
    """Bounds of items (i_), as columns named after them."""
    return [F.min("i_x0").alias(f"{name}_x0"), F.min("i_y0").alias(f"{name}_y0"), F.max("i_x1").alias(f"{name}_x1"), F.max("i_y1").alias(f"{name}_y1")]


def window_bounds(captions: DataFrame, items: DataFrame, name: str) -> DataFrame:
    return windowed(captions, items, "i_").groupBy(*PAGE, "region_id").agg(*_bounds(name))


def _listed() -> Column:
    """The window's blocks (b_) by their lower edges and numbers."""
    return F.array_sort(F.collect_list(F.when(F.col("b_y0").isNotNull(), F.struct("b_y1", "b_block_no", "b_y0"))))


def _gap_end(listed: Column) -> Column:
    """5 below the block before the largest gap over 30, the first of equal gaps; else null."""
    before = F.slice(listed, F.lit(1), F.greatest(F.size(listed) - 1, F.lit(0)))
    gaps = F.transform(before, lambda b, i: F.struct((F.get(listed, i + 1)["b_y0"] - b["b_y1"]).alias("gap"), (-i).alias("place"), b["b_y1"].alias("y1")))
    best = F.array_max(F.filter(gaps, lambda g: g["gap"] > 30))
    return F.when(best["y1"] != 0, best["y1"] + 5)


def whitespace_boundary(captions: DataFrame, blocks: DataFrame) -> DataFrame:
    """(region_id, ws_y): 5 below the block before the largest gap over 30 in the window; the first of equal gaps."""
    found = windowed(captions, blocks, "b_").groupBy(*PAGE, "region_id").agg(_listed().alias("listed"))
    return found.select(*PAGE, "region_id", _gap_end(F.col("listed")).alias("ws_y")).where("ws_y is not null")


def _paragraphs() -> list[Column]:
    """Lower edge of the lowest body paragraph of blocks (b_), and the x range of the others."""
    body = (F.col("b_x1") - F.col("b_x0") > F.col("b_page_width") * 0.65) & (F.length("b_text") > 120) & (F.col("b_y1") - F.col("b_y0") > 35) & (F.col("b_x0") < F.col("b_page_width") * 0.15)
    return [F.max(F.when(body, F.col("b_y1"))).alias("bottom"), F.min(F.when(~body, F.col("b_x0"))).alias("tx_x0"), F.max(F.when(~body, F.col("b_x1"))).alias("tx_x1")]


def text_boundary(captions: DataFrame, blocks: DataFrame) -> DataFrame:
    """(region_id, tx_y, tx_x0, tx_x1): 20 below the lowest body paragraph; x range of the other blocks."""
    found = windowed(captions, blocks, "b_").groupBy(*PAGE, "region_id").agg(*_paragraphs())
    return found.where("bottom is not null").select(*PAGE, "region_id", (F.col("bottom") + 20).alias("tx_y"), "tx_x0", "tx_x1")


def captions_of(blocks: DataFrame, *more: str) -> DataFrame:
    """Caption blocks as regions' anchors: (page, region_id, c_ box, page_width), and ``more`` of the block's columns."""
    return caption_blocks(blocks).select(*PAGE, F.col("block_no").alias("region_id"), *[F.col(c).alias(f"c_{c}") for c in (*BOX, "page_width", *more)])


def combine_boundaries(captions: DataFrame, blocks: DataFrame, drawings: DataFrame, images: DataFrame) -> DataFrame:
    """A figure's box by the first signal that gives one large enough: drawings, images, white space, text, a default."""
    rows = met(captions, drawings.select(*PAGE, *BOX), "i_", in_window("i_"), *_bounds("dr"))
    rows = met(rows, images.select(*PAGE, *BOX), "i_", in_window("i_"), *_bounds("im"))
    rows = met(rows, blocks.select(*PAGE, "block_no", *BOX, "page_width", "text"), "b_", in_window("b_"), _listed().alias("listed"), *_paragraphs())
    rows = rows.withColumn("ws_y", _gap_end(F.col("listed"))).withColumn("tx_y", F.col("bottom") + 20)
    start = F.greatest(F.lit(0.0), F.col("c_y0") - 500)
    width = F.col("c_page_width")

    def box(x0: Column, y0: Column, x1: Column, y1: Column, fits, present: Column, name: str) -> Column:
        return F.when(present & fits(x1 - x0, y1 - y0), F.struct(x0.alias("x0"), y0.alias("y0"), x1.alias("x1"), y1.alias("y1"), F.lit(name).alias("signal")))

    def bounds(p: str, pad: float) -> Column:
        top = F.greatest(F.col(f"{p}_y0"), F.coalesce("ws_y", F.col(f"{p}_y0")))
        return box(F.greatest(F.lit(0.0), F.col(f"{p}_x0") - pad), F.greatest(start, top - pad), F.least(width, F.col(f"{p}_x1") + pad), F.least(F.col("c_y0") - 5, F.col(f"{p}_y1") + pad), lambda w, h: (w > 50) & (h > 50), F.col(f"{p}_y0").isNotNull(), {"dr": "drawing", "im": "image"}[p])

    left, right = F.greatest(F.lit(0.0), F.col("c_x0") - 30), F.least(width, F.col("c_x1") + 30)
    wide = lambda w, h: (w > 80) & (h > 60)
    found = F.coalesce(
        bounds("dr", 10.0),
        bounds("im", 5.0),
        box(left, F.col("ws_y"), right, F.col("c_y0") - 10, wide, F.col("ws_y").isNotNull(), "whitespace"),
        box(F.coalesce("tx_x0", left), F.col("tx_y"), F.coalesce("tx_x1", right), F.col("c_y0") - 10, wide, F.col("tx_y").isNotNull(), "text"),
        box(F.greatest(F.lit(0.0), F.col("c_x0") - 20), F.greatest(start, F.col("c_y0") - 250), F.least(width, F.col("c_x1") + 20), F.col("c_y0") - 10, lambda w, h: (w > 100) & (h > 80) & (h < 500), F.lit(True), "fallback"),
    )
    return rows.select(*captions.columns, found.alias("box")).where("box is not null")


def extend_to_caption(found: DataFrame, *more: str) -> DataFrame:
    """Combined boxes extended over their captions, and ``more`` of their columns."""
    return found.select(*PAGE, "region_id", F.least("box.x0", "c_x0").alias("x0"), F.col("box.y0").alias("y0"), F.greatest("box.x1", "c_x1").alias("x1"), (F.col("c_y1") + 5).alias("y1"), F.col("box.signal").alias("signal"), *more)


def validate_images(images: DataFrame, blocks: DataFrame, page_height: float = 1260.0) -> DataFrame:
    """Scores of embedded images (page, img_no, box, px_w, px_h, grey_var) with notes; over 1 counts as 1, there is no floor.

    A page's height is its ``page_height`` column where images have one.
    """
    regions = images.withColumnRenamed("img_no", "region_id")
    rows = met(regions, blocks.select(*PAGE, "block_no", *BOX, "text"), "b_", is_below(), F.min_by("b_text", "b_block_no").alias("caption"))
    height = F.col("page_height") if "page_height" in images.columns else F.lit(page_height)
    size, aspect, place = G.area(), F.when(F.col("px_h") > 0, F.col("px_w") / F.col("px_h")).otherwise(1.0), F.col("y0") / height
    score = (
        F.when(size > 10000, 0.3).otherwise(0.1)
        + F.when((F.col("px_w") > 200) & (F.col("px_h") > 200), 0.2).otherwise(0.0)
        + F.when((aspect > 0.2) & (aspect < 5), 0.2).otherwise(-0.1)
        + F.when((place < 0.1) | (place > 0.9), -0.2).otherwise(0.1)
        + F.when(F.col("caption").isNotNull(), 0.4).otherwise(0.0)
        + F.when(F.col("grey_var") < 10, -0.3).when(F.col("grey_var") > 100, 0.2).otherwise(0.0)
    )
    rejected = (size < 3000) | (F.col("px_w") < 50) | (F.col("px_h") < 50)
    value = F.when(rejected, 0.0).otherwise(F.least(F.lit(1.0), F.round(score, 6)))
    found = [
        F.when(size > 10000, "good_size").otherwise("moderate_size"), F.when((F.col("px_w") > 200) & (F.col("px_h") > 200), "substantial_dimensions"),
        F.when((aspect > 0.2) & (aspect < 5), "good_aspect_ratio").otherwise("unusual_aspect_ratio"), F.when((place < 0.1) | (place > 0.9), "likely_header_footer").otherwise("good_position"),
        F.when(F.col("caption").isNotNull(), "has_caption"), F.when(F.col("grey_var") < 10, "low_variance").when(F.col("grey_var") > 100, "good_content_variance"),
    ]
    notes = F.when(size < 3000, "too_small").when(rejected, "tiny_dimensions").otherwise(F.concat_ws(", ", *found))
    return rows.select(*PAGE, F.col("region_id").alias("img_no"), value.alias("score"), (value >= 0.5).alias("kept"), notes.alias("notes"), "caption", *BOX, "grey_var")


def in_region() -> Column:
    """Whether a drawing's (d_) corner lies in a region."""
    return F.expr("d_x0 between x0 and x1 and d_y0 between y0 and y1")


def drawings_inside(regions: DataFrame, drawings: DataFrame, key: str) -> DataFrame:
    """(page, key, n_drawings): drawings whose corner lies in a region."""
    inside = regions.select(*PAGE, key, *BOX).join(prefixed(drawings, "d_"), PAGE).where(in_region())
    return inside.groupBy(*PAGE, key).agg(F.count(F.lit(1)).alias("n_drawings"))


def conflict_scores(regions: DataFrame, images: DataFrame, drawings: DataFrame) -> DataFrame:
    """Scores of caption regions against embedded images that conflict with them, and the winner (ties: the image)."""
    a = regions.select(*PAGE, F.col("region_id").alias("id"), *BOX)
    b = images.select(*PAGE, F.col("img_no").alias("id"), *BOX)
    pairs = overlap_pairs(a, b, 0.4)
    inside = prefixed(a, "a_").join(prefixed(drawings, "d_"), PAGE).where("d_x0 >= a_x0 and d_x0 <= a_x1 and d_y0 >= a_y0 and d_y0 <= a_y1")
    counts = inside.groupBy(*PAGE, "a_id").agg(F.count(F.lit(1)).alias("n_drawings"))
    rows = pairs.join(prefixed(a, "a_"), [*PAGE, "a_id"]).join(images.select(*PAGE, F.col("img_no").alias("b_id"), *[F.col(c).alias(f"b_{c}") for c in BOX], "score", "grey_var"), [*PAGE, "b_id"]).join(counts, [*PAGE, "a_id"], "left")
    first, second = G.area("a_"), G.area("b_")
    mine = F.lit(3) + F.when(first > 1.2 * second, 2).otherwise(0) + F.when(F.coalesce("n_drawings", F.lit(0)) > 10, 2).otherwise(0)
    other = F.when((first <= 1.2 * second) & (second > 1.2 * first), 1).otherwise(0) + F.when(F.col("grey_var") > 1000, 2).otherwise(0) + F.when(F.col("score") > 0.7, 1).otherwise(0)
    return rows.select(*PAGE, "a_id", "b_id", mine.alias("caption_score"), other.alias("embedded_score"), F.when(mine > other, "keep_caption").otherwise("keep_embedded").alias("decision"))
