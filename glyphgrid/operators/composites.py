"""Type-specific features of segments: what their text tells, joined with what their pixels tell.

Blocks are (segment_id, idx, text, box); rasters (image_id, width, height, rgb) or drawings have a segment's id as
``image_id``. Joins are shuffled, as estimates of what is traced are too low for a broadcast to be left to them. A segment without pixels has what its text gives, and empty or false findings.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from glyphgrid.operators import ocr, pixels


def _seen(rasters: DataFrame | pixels.Drawings, *parts: str, features: Callable[[DataFrame], DataFrame]) -> DataFrame:
    return pixels.traced(rasters, *parts, features=features).withColumnRenamed("image_id", "segment_id")


def _grid() -> Column:
    h, v = pixels.opened_pixels(F.col("runs"), "h", F.col("width"), F.lit(pixels.GRID)), pixels.opened_pixels(F.col("runs"), "v", F.col("height"), F.lit(pixels.GRID))
    return (h > 300) & (v > 300)


def _with(rows: DataFrame, seen: DataFrame) -> DataFrame:
    return rows.join(seen.hint("merge"), "segment_id", "left")


def _or(value: Column, default) -> Column:
    return F.coalesce(value, F.lit(default))


def charts(blocks: DataFrame, rasters: DataFrame | pixels.Drawings) -> DataFrame:
    """Subtype, labels, ticks, range, legend and series, grid, colours and data points of charts."""
    features = lambda rows: pixels.chart_scores(rows).select("image_id", "visual", _grid().alias("grid"), pixels.colour_names(F.col("colours")).alias("colours"), pixels.data_points(F.col("blobs"), F.col("edge_pixels")).alias("points"))
    seen = _seen(rasters, *pixels.CHART_PARTS, "colours", "blobs", "edge_pixels", features=features)
    worded = ocr.raw_text(blocks).select("segment_id", F.col("text").alias("raw"))
    rows = _with(ocr.chart_features(blocks).drop("subtype").join(worded, "segment_id"), seen)
    kind = pixels.chart_type(ocr.chart_words(F.col("raw")), F.col("visual"))
    none = F.array().cast("array<string>")
    return rows.withColumns({"subtype": kind, "grid": _or(F.col("grid"), False), "colours": F.coalesce("colours", none), "points": _or(F.col("points"), 0)}).drop("raw", "visual")


def diagrams(blocks: DataFrame, rasters: DataFrame | pixels.Drawings) -> DataFrame:
    """Subtype, nodes, layout, hierarchy and decision points, connections, shapes and arrows of diagrams."""
    features = lambda rows: rows.select("image_id", F.size(pixels.connections(F.col("lines"))).alias("connections"), pixels.shapes(F.col("polygons")).alias("shapes"), pixels.arrows(F.col("lines")).alias("arrows"))
    seen = _seen(rasters, "lines", "polygons", features=features)
    none = F.struct(*[F.lit(0).alias(n) for n in ("rectangles", "circles", "diamonds")])
    rows = _with(ocr.diagram_features(blocks), seen)
    return rows.withColumns({"connections": _or(F.col("connections"), 0), "shapes": F.coalesce("shapes", none), "arrows": _or(F.col("arrows"), 0)})


def pictures(blocks: DataFrame, rasters: DataFrame | pixels.Drawings) -> DataFrame:
    """Subtype, text density, tables and content, and colours of images."""
    features = lambda rows: rows.select("image_id", F.col("variance").alias("grey_var"), pixels.colour_names(F.col("colours")).alias("colours"))
    seen = _seen(rasters, "variance", "colours", features=features)
    rows = _with(ocr.raw_text(blocks), seen)
    rows = rows.withColumns({"grey_var": _or(F.col("grey_var"), 0.0), "colours": F.coalesce("colours", F.array().cast("array<string>"))})
    return ocr.image_features(rows, "colours")


def figures(blocks: DataFrame, rasters: DataFrame | pixels.Drawings) -> DataFrame:
    """Sub-figures, and whether a figure holds a grid, a diagram or a picture."""
    features = lambda rows: rows.select("image_id", F.col("variance").alias("grey_var"), pixels.arrows(F.col("lines")).alias("arrows"), _grid().alias("contains_chart"))
    seen = _seen(rasters, "variance", "lines", "runs", features=features)
    rows = _with(ocr.raw_text(blocks), seen)
    return ocr.figure_features(rows.withColumn("contains_chart", _or(F.col("contains_chart"), False)), "contains_chart")
