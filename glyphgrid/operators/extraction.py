"""Two-pass extraction: caption regions, then embedded images that compete with them; and regions by captions and drawings."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from glyphgrid.operators import folds, layout
from glyphgrid.operators.layout import BOX, PAGE


def caption_regions(blocks: DataFrame, drawings: DataFrame, images: DataFrame) -> DataFrame:
    """(page, idx, box, caption, c_x0, c_y0): regions above caption blocks, extended over them."""
    found = layout.combine_boundaries(layout.captions_of(blocks, "text"), blocks, drawings, images)
    return layout.extend_to_caption(found, "c_text", "c_x0", "c_y0").withColumnRenamed("c_text", "caption").withColumnRenamed("region_id", "idx")


def embedded_candidates(images: DataFrame, blocks: DataFrame) -> DataFrame:
    """(page, idx, box, caption, score, notes, grey_var): images that validation keeps, grown over a caption near them."""
    kept = layout.validate_images(images, blocks).where("kept").withColumnRenamed("img_no", "idx")
    return layout.grown(kept, blocks)


def two_pass(blocks: DataFrame, drawings: DataFrame, images: DataFrame) -> DataFrame:
    """(page, place, idx, box, method, caption, figure_number, confidence, notes): the segments of each page, in order.

    A page is dealt once: what is found of its regions is grouped in place, and the fold carries it along.
    """
    first = caption_regions(blocks, drawings, images).select(*PAGE, F.lit(1).alias("pass_no"), "idx", *BOX, "caption", F.lit(None).cast("double").alias("grey_var"), F.lit(0.9).alias("score"), F.lit("").alias("notes"))
    second = embedded_candidates(images, blocks).select(*PAGE, F.lit(2).alias("pass_no"), "idx", *BOX, "caption", "grey_var", "score", "notes")
    corners = drawings.select(*PAGE, "x0", "y0")
    counted = [layout.met(rows, corners, "d_", layout.in_region(), F.count("d_x0").alias("n_drawings")) for rows in (first, second)]
    rows = counted[0].union(counted[1]).withColumn("captioned", F.coalesce(F.col("caption") != "", F.lit(False)))
    kept = folds.conflict_fold(rows, "caption", "score", "notes")
    method = F.when(F.col("pass_no") == 1, "caption_based").otherwise("embedded_image")
    number = F.when(F.col("pass_no") == 1, layout.T.caption_number(F.col("caption")))
    return kept.select(*PAGE, "place", "idx", *BOX, method.alias("method"), "caption", number.alias("figure_number"), F.col("score").alias("confidence"), "notes")


def visual_regions(blocks: DataFrame, drawings: DataFrame, images: DataFrame, page_width: float, page_height: float, reach: float = 100.0) -> DataFrame:
    """(page, pass_no, idx, place, box): caption regions, then drawing clusters that are new."""
    none = F.lit(None).cast("double")
    first = caption_regions(blocks, drawings, images).select(*PAGE, F.lit(1).alias("pass_no"), "idx", *BOX, "c_x0", "c_y0")
    drawn = folds.drawing_regions(folds.drawing_clusters(drawings, reach), page_width, page_height)
    drawn = drawn.repartition(*PAGE)  # few rows are dealt again, so that those of the captions stay where they are
    second = drawn.select(*PAGE, F.lit(2).alias("pass_no"), F.col("seed_no").alias("idx"), *BOX, none.alias("c_x0"), none.alias("c_y0"))
    return folds.new_regions(first.union(second))
