"""Pixel features of rasters (image_id, width, height, rgb): kernels give tables, expressions the features.

``traced`` runs the kernels asked for over each image, one at a time, and gives their
findings as arrays of structs; what is counted, compared and scored from them are column
expressions, so features of an image need no exchange. Drawings are painted and traced in
one call, so no pixels pass between tasks. Null or ill-sized pixels give
empty findings; an image has to fit a worker's memory some twenty times, for colours up to
forty times where all its pixels differ.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StructType

from glyphgrid.plans.durable import BROADCAST_BYTES, Stored
from glyphgrid.vision import areas, edges, palette, raster, strokes

#: Bounds of edges; votes, least length and gap of lines; lengths of the grid's and bars' openings.
EDGE_BOUNDS = (50, 150)
LINE = {"votes": 50, "least": 30, "gap": 10}
LONG_GAP, GRID, BAR_LEAST = 20, 25, 20
#: Thresholds, size and distance of blobs, and how many thresholds must show one.
BLOB_LEVELS, BLOB_AREA, BLOB_APART, BLOB_TIMES = range(50, 220, 10), (10, 150), 10.0, 2
_INT, _LINES = pa.int32(), pa.list_(pa.struct([(n, pa.int32()) for n in ("x0", "y0", "x1", "y1")]))
#: What can be asked for, with its type.
PARTS = {
    "variance": ("double", pa.float64()),
    "edge_pixels": ("int", _INT),
    "runs": ("array<struct<axis: string, line: int, start: int, length: int>>", pa.list_(pa.struct([("axis", pa.string()), ("line", _INT), ("start", _INT), ("length", _INT)]))),
    "lines": ("array<struct<x0: int, y0: int, x1: int, y1: int>>", _LINES),
    "long_lines": ("array<struct<x0: int, y0: int, x1: int, y1: int>>", _LINES),
    "areas": ("array<struct<pixels: int, x0: int, y0: int, x1: int, y1: int>>", pa.list_(pa.struct([(n, _INT) for n in ("pixels", "x0", "y0", "x1", "y1")]))),
    "bars": ("array<int>", pa.list_(_INT)),
    "polygons": ("array<struct<points: int, length: double>>", pa.list_(pa.struct([("points", _INT), ("length", pa.float64())]))),
    "blobs": ("int", _INT),
    "colours": ("array<struct<colour: string, pixels: int>>", pa.list_(pa.struct([("colour", pa.string()), ("pixels", _INT)]))),
    "circles": ("array<struct<x: int, y: int, radius: int, support: int, density: double>>", pa.list_(pa.struct([("x", _INT), ("y", _INT), ("radius", _INT), ("support", _INT), ("density", pa.float64())]))),
}


class Image:
    """One image's pixels, grey values and edges, made when first asked for."""

    def __init__(self, rgb: np.ndarray):
        self.rgb = rgb
        self._grey = self._edges = None

    @property
    def grey(self) -> np.ndarray:
        if self._grey is None:
            self._grey = raster.grey(self.rgb)
        return self._grey

    @property
    def edges(self) -> np.ndarray:
        if self._edges is None:
            self._edges = edges.edge_map(self.grey, *EDGE_BOUNDS)
        return self._edges

    def variance(self):
        return float(self.grey.var()) if self.grey.size else None

    def edge_pixels(self):
        return int(self.edges.sum())

    def runs(self):
        out = []
        for axis, mask in (("h", self.edges), ("v", self.edges.T)):
            line, start, stop = areas.scan_runs(mask)
            out += [{"axis": axis, "line": a, "start": b, "length": c - b} for a, b, c in zip(line.tolist(), start.tolist(), stop.tolist(), strict=True)]
        return out

    def lines(self):
        return [dict(zip(("x0", "y0", "x1", "y1"), s, strict=True)) for s in strokes.segments(self.edges, **LINE)]

    def long_lines(self):
        return [dict(zip(("x0", "y0", "x1", "y1"), s, strict=True)) for s in strokes.segments(self.edges, LINE["votes"], self.edges.shape[1] // 4, LONG_GAP)]

    def areas(self):
        found = areas.components(self.edges)
        return [dict(zip(("pixels", "x0", "y0", "x1", "y1"), map(int, row), strict=True)) for row in zip(found.pixels, *found.bounds(), strict=True)]

    def bars(self):
        """Heights of the areas that a vertical opening leaves."""
        reach, after = _reach(max(BAR_LEAST, self.edges.shape[0] // 20))
        kept = np.zeros_like(self.edges)
        height = self.edges.shape[0]
        for x, start, stop in zip(*areas.scan_runs(self.edges.T), strict=True):
            low, high = _opened(int(start), int(stop), height, reach, after)
            kept[low:high, x] = True
        found = areas.components(kept)
        _, top, _, bottom = found.bounds()
        return (bottom - top + 1).tolist()

    def polygons(self):
        out = []
        for border in areas.borders(self.edges):
            around = areas.length(border)
            out.append({"points": len(areas.simplified(border, 0.04 * around)), "length": around})
        return out

    def blobs(self):
        """Dark spots of a middling size that stand out at two thresholds or more."""
        held: list[list] = []  # [x, y, times]
        below, before, centres = np.cumsum(np.bincount(self.grey.ravel(), minlength=256)).tolist(), -1, []
        for level in BLOB_LEVELS:
            if below[level] != before:  # no pixel lies between two levels: the same areas again
                before = below[level]
                found = areas.components(self.grey <= level)
                centres = found.centres()[(found.pixels >= BLOB_AREA[0]) & (found.pixels < BLOB_AREA[1])].tolist()
            for x, y in centres:
                known = next((b for b in held if np.hypot(b[0] - x, b[1] - y) < BLOB_APART), None)
                if known:
                    known[2] += 1
                else:
                    held.append([x, y, 1])
        return sum(times >= BLOB_TIMES for *_, times in held)

    def colours(self):
        return [{"colour": c, "pixels": n} for c, n in palette.palette(self.rgb, sample=None)]

    def circles(self):
        height, width = self.edges.shape
        small = min(width, height)
        found = strokes.circles(self.edges, *edges.gradients(self.grey), int(small * 0.2), int(small * 0.45), 50, small * 0.3)
        y, x = np.mgrid[0:height, 0:width]
        out = []
        for cx, cy, radius, support in found:
            inside = (x - cx) ** 2 + (y - cy) ** 2 <= radius * radius
            out.append({"x": cx, "y": cy, "radius": radius, "support": support, "density": float((self.edges & inside).sum() / (np.pi * radius * radius)) if radius else 0.0})
        return out


_EMPTY = {"edge_pixels": 0, "blobs": 0, "variance": None}


def _image(width: int | None, height: int | None, rgb: bytes | None) -> Image | None:
    if not width or not height or rgb is None or len(rgb) != width * height * 3:
        return None
    return Image(np.frombuffer(rgb, dtype=np.uint8).reshape(height, width, 3))


#: Images that a call takes from a batch at once, so that their pixels stay few beside the batch.
IMAGES = 256


def _sliced(batches):
    for batch in batches:
        for start in range(0, batch.num_rows, IMAGES):
            yield batch.slice(start, IMAGES)


def _found(images: list[Image | None], parts: tuple[str, ...]) -> list[pa.Array]:
    """A column a part."""
    columns = {n: [] for n in parts}
    for image in images:
        for name in parts:
            columns[name].append(getattr(image, name)() if image is not None else _EMPTY.get(name, []))
    return [pa.array(columns[n], PARTS[n][1]) for n in parts]


class Drawings:
    """Pictures of regions (image_id, x0, y0, x1, y1) with their shapes (image_id, z, form, x0, y0, x1, y1, color), page units at ``dpi``.

    A region without shapes is white. Shapes of a region are painted by one task; drawings number hundreds a region.
    """

    def __init__(self, shapes: DataFrame, regions: DataFrame, dpi: float = 72.0):
        self.shapes, self.regions, self.scale = shapes, regions, dpi / 72.0
        # shapes are few bytes but much work: as many tasks as asked for, which no later step joins together
        self.tasks = max(int(regions.sparkSession.conf.get("spark.sql.shuffle.partitions")), regions.sparkSession.sparkContext.defaultParallelism)

    def laid(self) -> DataFrame:
        """(image_id, w, h, shapes): sizes in page units, and the shapes in order, placed from the region's corner.

        Both sides are dealt once; estimates of exploded shapes are far too low for a broadcast to be left to them.
        """
        shape = F.struct("z", "form", *[F.col(c).cast("double").alias(c) for c in ("x0", "y0", "x1", "y1")], F.col("color").cast("int").alias("color"))
        listed = self.shapes.select("image_id", shape.alias("s")).repartition(self.tasks, "image_id").groupBy("image_id").agg(F.array_sort(F.collect_list("s")).alias("shapes"))
        boxes = self.regions.select("image_id", *[F.col(c).cast("double").alias(f"r_{c}") for c in ("x0", "y0", "x1", "y1")]).repartition(self.tasks, "image_id")
        left, top = F.col("r_x0"), F.col("r_y0")
        # a disc's x1 is its radius, not a place
        placed = lambda s: F.struct(s["form"].alias("form"), (s["x0"] - left).alias("x0"), (s["y0"] - top).alias("y0"), F.when(s["form"] == "disc", s["x1"]).otherwise(s["x1"] - left).alias("x1"), (s["y1"] - top).alias("y1"), s["color"].alias("color"))
        return boxes.join(listed.hint("merge"), "image_id", "left").select("image_id", (F.col("r_x1") - left).alias("w"), (F.col("r_y1") - top).alias("h"), F.transform("shapes", placed).alias("shapes"))


class _Painter:
    """Pixels of a batch's drawings (.., w, h, shapes)."""

    def __init__(self, scale: float):
        self.scale = scale

    def __call__(self, batch: pa.RecordBatch) -> list[np.ndarray]:
        out = []
        for w, h, held in zip(*(batch.column(k).to_pylist() for k in (1, 2, 3)), strict=True):
            shapes = [tuple(s[c] for c in ("form", "x0", "y0", "x1", "y1", "color")) for s in held or ()]
            out.append(raster.paint(shapes, round(w * self.scale), round(h * self.scale), scale=self.scale))
        return out


def traced(rasters: DataFrame | Drawings, *parts: str, features: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """(image_id, width, height) and the parts asked for, of each raster or drawing, or the features (image_id, ..) of these rows.

    Pixels of drawings stay in the task that paints them, and drawings with equal shapes are painted and traced once.
    ``features`` are narrow: they are taken of each distinct drawing, so only they, and no lists of what was found, meet the images.
    """
    unknown = set(parts) - set(PARTS)
    if unknown:
        raise ValueError(f"no such parts: {sorted(unknown)}")
    extra = "".join(f", {n} {PARTS[n][0]}" for n in parts)
    if isinstance(rasters, Drawings):
        return _traced_once(rasters, parts, extra, features)

    def run(batches):
        for batch in _sliced(batches):
            images = [_image(*row) for row in zip(*(batch.column(k).to_pylist() for k in (1, 2, 3)), strict=True)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], *_found(images, parts)], ["image_id", "width", "height", *parts])

    kind = rasters.schema["image_id"].dataType.simpleString()
    rows = rasters.selectExpr("image_id", "cast(width as int) as width", "cast(height as int) as height", "rgb").mapInArrow(run, f"image_id {kind}, width int, height int{extra}")
    return features(rows) if features else rows


def _traced_once(drawings: Drawings, parts: tuple[str, ...], extra: str, features: Callable[[DataFrame], DataFrame] | None) -> DataFrame:
    def run(batches):
        for batch in _sliced(batches):
            rgb = painted(batch)
            size = [pa.array([i.shape[k] for i in rgb], _INT) for k in (1, 0)]
            yield pa.RecordBatch.from_arrays([batch.column(0), *size, *_found([Image(i) if i.size else None for i in rgb], parts)], ["image_id", "width", "height", *parts])

    painted = _Painter(drawings.scale)
    laid = drawings.laid().withColumn("drawing", F.sha2(F.to_json(F.struct("w", "h", "shapes")), 256))
    once = laid.select("drawing", "w", "h", "shapes").dropDuplicates(["drawing"]).repartition(drawings.tasks, "drawing")
    # written, so that its true size tells whether it is broadcast
    rows = once.mapInArrow(run, f"image_id string, width int, height int{extra}")
    found = Stored((features(rows) if features else rows).withColumnRenamed("image_id", "drawing"))
    # lists take many times their files' bytes in memory, so they are never broadcast
    flat = not any(isinstance(f.dataType, (ArrayType, StructType)) for f in found.table.schema)
    side = found.side() if flat and found.bytes <= BROADCAST_BYTES else found.table.hint("merge")
    return laid.select("image_id", "drawing").join(side, "drawing").drop("drawing")


def render(shapes: DataFrame, regions: DataFrame, dpi: float = 72.0) -> DataFrame:
    """Rasters (image_id, width, height, rgb) of ``Drawings``."""
    drawings = Drawings(shapes, regions, dpi)
    painted = _Painter(drawings.scale)

    def run(batches):
        for batch in _sliced(batches):
            rgb = painted(batch)
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array([i.shape[k] for i in rgb], _INT) for k in (1, 0)), pa.array([i.tobytes() for i in rgb], pa.binary())], ["image_id", "width", "height", "rgb"])

    kind = regions.schema["image_id"].dataType.simpleString()
    return drawings.laid().mapInArrow(run, f"image_id {kind}, width int, height int, rgb binary")


def decode(files: DataFrame) -> DataFrame:
    """Rasters of PNG files (image_id, png); a file that can't be read gives null pixels and its error."""

    def run(batches):
        for batch in _sliced(batches):
            out = []
            for data in batch.column(1).to_pylist():
                try:
                    rgb = raster.read_png(data or b"")
                    out.append((rgb.shape[1], rgb.shape[0], rgb.tobytes(), None))
                except Exception as failure:  # noqa: BLE001  (any broken file is a row, not a failed job)
                    out.append((None, None, None, f"{type(failure).__name__}: {failure}"))
            columns = list(zip(*out, strict=True)) if out else [()] * 4
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(columns[0], _INT), pa.array(columns[1], _INT), pa.array(columns[2], pa.binary()), pa.array(columns[3], pa.string())], ["image_id", "width", "height", "rgb", "error"])

    kind = files.schema["image_id"].dataType.simpleString()
    return files.select("image_id", "png").mapInArrow(run, f"image_id {kind}, width int, height int, rgb binary, error string")


def encode(rasters: DataFrame) -> DataFrame:
    """(image_id, png) of rasters; null pixels give null."""

    def run(batches):
        for batch in _sliced(batches):
            images = (_image(*row) for row in zip(*(batch.column(k).to_pylist() for k in (1, 2, 3)), strict=True))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([raster.write_png(i.rgb) if i is not None else None for i in images], pa.binary())], ["image_id", "png"])

    kind = rasters.schema["image_id"].dataType.simpleString()
    return rasters.select("image_id", "width", "height", "rgb").mapInArrow(run, f"image_id {kind}, png binary")


# ---- expressions over what was traced ----
def _reach(length: int) -> tuple[int, int]:
    """Pixels before and after its anchor that an opening by ``length``, done twice, looks at."""
    before = 2 * (length // 2)
    return before, 2 * (length - 1) - before


def _opened(start: int, stop: int, size: int, before: int, after: int) -> tuple[int, int]:
    """What an opening leaves of a run in a line of ``size`` pixels; outside the line nothing is eroded."""
    low, high = 0 if start == 0 else start + before, size - 1 if stop == size else stop - 1 - after
    return (max(low - after, 0), min(high + before, size - 1) + 1) if low <= high else (0, 0)


def opened_pixels(runs: Column, axis: str, size: Column, length: Column) -> Column:
    """Pixels that an opening by ``length`` along an axis, done twice, leaves of the runs; ``size`` is the line's."""
    before = 2 * F.floor(length / 2)
    after = 2 * (length - 1) - before

    def left(run):
        stop = run["start"] + run["length"]
        low = F.when(run["start"] == 0, 0).otherwise(run["start"] + before)
        high = F.when(stop == size, size - 1).otherwise(stop - 1 - after)
        kept = F.least(high + before, size - 1) - F.greatest(low - after, F.lit(0)) + 1
        return F.when((run["axis"] == axis) & (low <= high), kept).otherwise(0).cast("long")

    return F.aggregate(runs, F.lit(0).cast("long"), lambda total, run: total + left(run))


def grid(traced_rows: DataFrame) -> DataFrame:
    """(image_id, h_pixels, v_pixels, grid): over 300 pixels left in both directions by openings of 25."""
    h, v = opened_pixels(F.col("runs"), "h", F.col("width"), F.lit(GRID)), opened_pixels(F.col("runs"), "v", F.col("height"), F.lit(GRID))
    return traced_rows.select("image_id", h.alias("h_pixels"), v.alias("v_pixels")).withColumn("grid", (F.col("h_pixels") > 300) & (F.col("v_pixels") > 300))


def arrows(lines: Column) -> Column:
    """A third of the slanted lines, 20 at most."""
    angle = lambda s: F.abs(F.degrees(F.atan2(s["y1"] - s["y0"], s["x1"] - s["x0"])))
    slanted = F.filter(lines, lambda s: ((angle(s) > 20) & (angle(s) < 70)) | ((angle(s) > 110) & (angle(s) < 160)))
    return F.least(F.floor(F.size(slanted) / 3).cast("int"), F.lit(20))


def connections(lines: Column) -> Column:
    """One arrow a line, the first 20."""
    n = F.least(F.size(lines), F.lit(20))
    return F.when(n > 0, F.transform(F.sequence(F.lit(0), n - 1), lambda i: F.struct(F.concat(F.lit("conn_"), i).alias("id"), F.lit("arrow").alias("type")))).otherwise(F.array().cast("array<struct<id: string, type: string>>"))


def shapes(polygons: Column) -> Column:
    """Counts of borders with four vertices and with over eight; a rectangle is never taken for a diamond."""
    return F.struct(F.size(F.filter(polygons, lambda p: p["points"] == 4)).alias("rectangles"), F.size(F.filter(polygons, lambda p: p["points"] > 8)).alias("circles"), F.lit(0).alias("diamonds"))


def data_points(blobs: Column, edge_pixels: Column) -> Column:
    """Blobs, if there are over five; else a share of the edge, 500 at most."""
    return F.when(blobs > 5, blobs).otherwise(F.least(F.floor(edge_pixels / 150).cast("int"), F.lit(500)))


def colour_names(colours: Column) -> Column:
    return F.transform(colours, lambda c: c["colour"])


#: Kernels that the type of a chart needs.
CHART_PARTS = ("runs", "bars", "long_lines", "circles")
#: Kinds whose words are looked for, in order; ties go to the kind scored first.
CHART_KINDS = ["pie", "scatter", "candlestick", "bar", "line"]


def chart_scores(rows: DataFrame) -> DataFrame:
    """Rows of a chart's traced parts with ``visual``: (kind, score) of the visual signals, in the order they are scored."""
    h = opened_pixels(F.col("runs"), "h", F.col("width"), F.greatest(F.lit(20), F.floor(F.col("width") / 20)))
    v = opened_pixels(F.col("runs"), "v", F.col("height"), F.greatest(F.lit(20), F.floor(F.col("height") / 20)))
    rows = rows.withColumn("h_open", h).withColumn("v_open", v)
    is_line = (F.col("h_open") > F.col("height") * 8) & (F.col("h_open") > F.col("v_open") * 1.5)
    long = F.exists("long_lines", lambda s: (F.abs(s["y1"] - s["y0"]) < 10) & (F.abs(s["x1"] - s["x0"]) > F.col("width") * 0.2))
    tall = F.size(F.filter("bars", lambda b: b > F.col("height") * 0.2))
    small = F.least("width", "height")
    large = F.filter("circles", lambda c: c["radius"] > small * 0.2)
    is_bar = ~is_line & (F.col("v_open") > F.col("width") * 10)
    is_pie = ~is_line & ~is_bar & (F.size(large) == 1) & F.exists(large, lambda c: c["density"] > 0.015)
    scored = F.when(is_line, F.struct(F.lit("line").alias("kind"), F.when(long, 4.0).otherwise(2.5).alias("score")))
    scored = scored.when(is_bar, F.struct(F.lit("bar").alias("kind"), F.when(tall >= 3, 3.5).otherwise(2.0).alias("score")))
    return rows.withColumn("visual", scored.when(is_pie, F.struct(F.lit("pie").alias("kind"), F.lit(2.5).alias("score"))))


def chart_type(worded: dict[str, Column], visual: Column) -> Column:
    """The kind of the highest score (3 for words, and the visual one) of 2 or more; of equals the one scored first.

    ``worded`` says for each of CHART_KINDS whether its words are there. A line or bar that words alone speak for
    doesn't keep a circle from counting for a pie unless its own score is 2 or more, which words always give.
    """
    no = F.lit(False)
    words = [(k, F.coalesce(worded[k], no)) for k in CHART_KINDS]
    strong = F.coalesce(worded["line"], no) | F.coalesce(worded["bar"], no)
    counted = F.when((visual["kind"] == "pie") & strong, F.lit(None)).otherwise(visual)
    rows = []
    for place, (kind, said) in enumerate(words):
        seen = F.when(counted["kind"] == kind, counted["score"]).otherwise(0.0)
        total = F.when(said, 3.0).otherwise(0.0) + F.coalesce(seen, F.lit(0.0))
        # kinds that no word spoke for are scored after those with words
        rows.append(F.struct(total.alias("score"), F.when(said, -place).otherwise(-10).alias("order"), F.lit(kind).alias("kind")))
    best = F.array_max(F.array(*rows))
    return F.when(best["score"] >= 2.0, best["kind"]).otherwise("unknown")
