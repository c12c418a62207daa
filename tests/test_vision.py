"""Raster kernels against plain definitions, on planted and random images."""

import math
import struct
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from glyphgrid.operators import pixels
from glyphgrid.vision import areas, edges, palette, raster, strokes

draw = np.random.default_rng(3)


def plain_edges(grey: np.ndarray, low: int = 50, high: int = 150) -> np.ndarray:
    """Pixel by pixel: Sobel sums, thinning by the gradient's direction, and a flood from strong pixels."""
    h, w = grey.shape
    g = lambda y, x: int(grey[min(max(y, 0), h - 1), min(max(x, 0), w - 1)])
    gx, gy = np.zeros((h, w), dtype=int), np.zeros((h, w), dtype=int)
    for y in range(h):
        for x in range(w):
            gx[y, x] = sum(k * (g(y + d, x + 1) - g(y + d, x - 1)) for d, k in ((-1, 1), (0, 2), (1, 1)))
            gy[y, x] = sum(k * (g(y + 1, x + d) - g(y - 1, x + d)) for d, k in ((-1, 1), (0, 2), (1, 1)))
    size = abs(gx) + abs(gy)
    m = lambda y, x: size[y, x] if 0 <= y < h and 0 <= x < w else 0
    weak = np.zeros((h, w), dtype=bool)
    for y in range(h):
        for x in range(w):
            here, a, b = size[y, x], abs(int(gx[y, x])) * 13573, abs(int(gy[y, x])) << 15
            if here <= low:
                continue
            if b < a:
                weak[y, x] = here > m(y, x - 1) and here >= m(y, x + 1)
            elif b > a + (abs(int(gx[y, x])) << 16):
                weak[y, x] = here > m(y - 1, x) and here >= m(y + 1, x)
            else:
                s = -1 if (gx[y, x] < 0) != (gy[y, x] < 0) else 1
                weak[y, x] = here > m(y - 1, x - s) and here > m(y + 1, x + s)
    found = weak & (size > high)
    todo = list(zip(*np.nonzero(found), strict=True))
    while todo:
        y, x = todo.pop()
        for b in range(max(y - 1, 0), min(y + 2, h)):
            for a in range(max(x - 1, 0), min(x + 2, w)):
                if weak[b, a] and not found[b, a]:
                    found[b, a] = True
                    todo.append((b, a))
    return found


def plain_areas(mask: np.ndarray, corners: bool) -> set:
    h, w = mask.shape
    left, out = {(y, x) for y, x in zip(*np.nonzero(mask), strict=True)}, set()
    while left:
        todo, own = [left.pop()], set()
        while todo:
            y, x = todo.pop()
            own.add((int(y), int(x)))
            for dy, dx in ((0, 1), (1, 0), (0, -1), (-1, 0)) + (((1, 1), (1, -1), (-1, 1), (-1, -1)) if corners else ()):
                if (y + dy, x + dx) in left:
                    left.remove((y + dy, x + dx))
                    todo.append((y + dy, x + dx))
        out.add(frozenset(own))
    return out


def opened(mask: np.ndarray, length: int) -> np.ndarray:
    """Erosion by a horizontal bar twice, then dilation twice; outside the image nothing is eroded."""
    before = length // 2
    w = mask.shape[1]
    for fold, other in ((all, None), (all, None), (any, None), (any, None)):
        mask = np.array([[fold(row[k] for k in range(max(x - before, 0), min(x + length - before, w))) for x in range(w)] for row in mask])
    return mask


def images() -> list[np.ndarray]:
    out = [draw.integers(0, 256, size=(17, 23)), np.zeros((5, 5)), np.full((1, 9), 200), draw.integers(0, 2, size=(30, 31)) * 255]
    soft = draw.integers(0, 256, size=(40, 40)).astype(float)
    for _ in range(6):
        soft = (soft + np.roll(soft, 1, 0) + np.roll(soft, 1, 1)) / 3
    y, x = np.mgrid[0:50, 0:60]
    return [i.astype(np.uint8) for i in [*out, soft, (np.hypot(y - 25, x - 30) < 18) * 200 + 20, (x + y > 55) * 90 + 60, x * 4]]


def test_edges():
    for grey in images():
        assert (edges.edge_map(grey) == plain_edges(grey)).all()
    noise = images()[0]
    assert (edges.edge_map(noise, 400, 700) == plain_edges(noise, 400, 700)).all() and edges.edge_map(noise, 400, 700).any()


@pytest.mark.parametrize("corners", [True, False])
def test_areas(corners):
    for share in (0.0, 0.3, 0.5, 0.6, 0.8, 1.0):
        mask = draw.random((25, 33)) < share
        found = areas.components(mask, corners)
        labels = found.image(mask.shape)
        got = {frozenset((int(y), int(x)) for y, x in zip(*np.nonzero(labels == k), strict=True)) for k in range(found.count)}
        assert got == plain_areas(mask, corners) and (labels >= 0).tolist() == mask.tolist()
        for k, (x0, y0, x1, y1, n, centre) in enumerate(zip(*found.bounds(), found.pixels, found.centres(), strict=True)):
            ys, xs = np.nonzero(labels == k)
            assert (x0, y0, x1, y1, n) == (xs.min(), ys.min(), xs.max(), ys.max(), len(xs)) and np.allclose(centre, (xs.mean(), ys.mean()))


def test_borders():
    mask = np.zeros((30, 40), dtype=bool)
    mask[3:20, 4:30] = True
    mask[7:12, 9:20] = False
    mask[25, 2] = True
    found = areas.borders(mask)
    assert len(found) == 3  # the block, its hole, and a lone pixel
    for border in found:
        for (a, b), (c, d) in zip(border, [*border[1:], border[0]], strict=True):
            assert mask[a, b] and max(abs(a - c), abs(b - d)) <= 1
    assert len(areas.simplified(found[0], 0.04 * areas.length(found[0]))) == 4
    assert areas.length(found[0]) == 2 * (16 + 25)
    for share in (0.2, 0.5, 0.7):
        mask = draw.random((20, 20)) < share
        # an outer border for each area, one for each hole that the outside doesn't reach
        holes = [h for h in plain_areas(np.pad(~mask, 1, constant_values=True), False) if (0, 0) not in h]
        assert len(areas.borders(mask)) == len(plain_areas(mask, True)) + len(holes)


def test_polygons_of_shapes():
    y, x = np.mgrid[0:90, 0:90]
    ring = abs(np.hypot(y - 45, x - 45) - 35) < 0.7
    rim = max(areas.borders(ring), key=len)
    assert len(areas.simplified(rim, 0.01 * areas.length(rim))) > 8
    slanted = (abs(y - 45) + abs(x - 45)) <= 30
    diamond = areas.borders(slanted)[0]
    assert len(areas.simplified(diamond, 0.04 * areas.length(diamond))) == 4


def test_segments():
    mask = np.zeros((120, 150), dtype=bool)
    planted = [(10, 10, 140, 10), (20, 30, 20, 110), (40, 30, 100, 90), (45, 110, 130, 25)]
    for x0, y0, x1, y1 in planted:
        n = max(abs(x1 - x0), abs(y1 - y0))
        for k in range(n + 1):
            mask[round(y0 + (y1 - y0) * k / n), round(x0 + (x1 - x0) * k / n)] = True
    mask[100:103, 60:63] = True  # too few pixels for a line
    found = strokes.segments(mask)
    assert found == strokes.segments(mask)
    for a in planted:
        ends = lambda s: sorted([s[:2], s[2:]])
        assert any(all(math.dist(p, q) <= 12 for p, q in zip(ends(a), ends(b), strict=True)) for b in found), (a, found)
    assert len(found) <= len(planted) + 2
    mask[10, 60:65] = False  # a hole is passed over, a wide one is not
    assert any(abs(x1 - x0) > 120 and y0 < 15 for x0, y0, x1, _ in strokes.segments(mask))
    mask[10, 50:80] = False
    assert not any(abs(x1 - x0) > 120 and y0 < 15 for x0, y0, x1, _ in strokes.segments(mask))
    assert strokes.segments(np.zeros((0, 0), dtype=bool)) == strokes.segments(np.zeros((9, 9), dtype=bool)) == []


def test_circles():
    y, x = np.mgrid[0:120, 0:140]
    grey = np.where(np.hypot(y - 55, x - 70) <= 40, 60, 250).astype(np.uint8)
    found = strokes.circles(edges.edge_map(grey), *edges.gradients(grey), 24, 54, 50, 36)
    assert len(found) == 1 and abs(found[0][0] - 70) <= 1 and abs(found[0][1] - 55) <= 1 and abs(found[0][2] - 40) <= 1


def test_palette():
    rgb = np.full((40, 40, 3), 255, dtype=np.uint8)
    assert palette.palette(rgb) == []
    rgb[:20, :20], rgb[:20, 20:30], rgb[30:, 5:] = (200, 60, 40), (40, 160, 60), (30, 30, 35)
    assert palette.palette(rgb) == [("#c83c28", 400), ("#28a03c", 200)]
    noisy = np.clip(rgb.astype(int) + draw.integers(-4, 5, size=rgb.shape), 0, 255).astype(np.uint8)
    found = palette.palette(noisy, 2)
    assert found == palette.palette(noisy, 2) and sum(n for _, n in found) == 600
    near = lambda a, b: max(abs(int(a[i : i + 2], 16) - int(b[i : i + 2], 16)) for i in (1, 3, 5))
    assert near(found[0][0], "#c83c28") <= 3 and near(found[1][0], "#28a03c") <= 3
    big = np.tile(noisy, (6, 6, 1))
    assert sum(n for _, n in palette.palette(big)) == palette.SAMPLE


def test_colours_count_every_pixel(spark):
    planted = {0xC83C28: 9000, 0x28A03C: 7001, 0x2850C8: 5500, 0xC8A01E: 40, 0x8C28A0: 1}
    flat = np.full(150 * 200, 0xFFFFFF)
    flat[draw.permutation(flat.size)[: sum(planted.values())]] = np.repeat(list(planted), list(planted.values()))
    rgb = np.stack([flat >> 16, flat >> 8 & 255, flat & 255], axis=-1).astype(np.uint8)
    rows = spark.createDataFrame([(1, 200, 150, bytearray(rgb.tobytes()))], "image_id long, width int, height int, rgb binary")
    found = pixels.traced(rows, "colours").collect()[0].colours
    assert [(c.colour, c.pixels) for c in found] == [(f"#{c:06x}", n) for c, n in planted.items()]


def test_whole_palette_equals_plain_k_means():
    planted = np.array([(200, 60, 40), (40, 160, 60), (40, 80, 200), (200, 160, 30)])
    which = np.arange(90 * 120) % 7 % 4
    rgb = np.clip(planted[which] + draw.integers(-30, 31, size=(len(which), 3)), 0, 255).astype(np.uint8).reshape(90, 120, 3)
    flat = palette.coloured(rgb).astype(float)
    assert len(flat) > palette.SAMPLE
    centres = planted.astype(float)
    for _ in range(200):
        owner = ((flat[:, None] - centres[None]) ** 2).sum(axis=2).argmin(axis=1)
        centres = np.stack([flat[owner == k].mean(axis=0) for k in range(4)])
    plain = [("#%02x%02x%02x" % tuple(c.astype(int).tolist()), int(n)) for c, n in zip(centres, np.bincount(owner), strict=True)]
    assert palette.palette(rgb, 4, turns=200, sample=None) == sorted(plain, key=lambda r: (-r[1], r[0]))


def test_png():
    for pixels_ in (draw.integers(0, 256, size=(13, 7, 3)), draw.integers(0, 256, size=(4, 9))):
        own = pixels_.astype(np.uint8)
        back = raster.read_png(raster.write_png(own))
        assert (back == (own if own.ndim == 3 else own[..., None])).all()
    # all five row filters, with an alpha channel
    own = draw.integers(0, 256, size=(10, 6, 4)).astype(np.uint8)
    lines, above = b"", np.zeros(24, dtype=int)
    for k, row in enumerate(own.reshape(10, 24).astype(int)):
        left, corner = np.concatenate([np.zeros(4, dtype=int), row[:-4]]), np.concatenate([np.zeros(4, dtype=int), above[:-4]])
        paeth = [min((a, b, c), key=lambda v: abs(a + b - c - v)) for a, b, c in zip(left, above, corner, strict=True)]
        guess = [0, left, above, (left + above) // 2, np.array(paeth)][k % 5]
        lines += bytes([k % 5]) + ((row - guess) % 256).astype(np.uint8).tobytes()
        above = row
    chunk = lambda kind, data: struct.pack(">I", len(data)) + kind + data + struct.pack(">I", zlib.crc32(kind + data))
    file = b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", struct.pack(">IIBBBBB", 6, 10, 8, 6, 0, 0, 0)) + chunk(b"IDAT", zlib.compress(lines)) + chunk(b"IEND", b"")
    assert (raster.read_png(file) == own[..., :3]).all()
    for broken in (b"", file[:-20], file.replace(b"IDAT", b"IDAX", 1)):
        with pytest.raises(Exception):  # noqa: B017
            raster.read_png(broken)


@pytest.fixture(scope="module")
def rasters(spark):
    rows = []
    for i in range(12):
        rgb = np.full((160, 200, 3), 255, dtype=np.uint8)
        for at in (30, 100) if i % 3 else (30,):
            rgb[at : at + 3, (0 if i % 2 else 6) : 190] = 0
        for at in (40, 120):
            rgb[4:158, at : at + 3] = (200, 40, 40) if i % 4 else 0
        rows.append((i, 200, 160, rgb.tobytes()))
    rows += [(100, None, None, None), (101, 4, 4, b"short"), (None, 1, 1, b"abc"), (5, 200, 160, rows[5][3])]
    return spark.createDataFrame(rows, "image_id long, width int, height int, rgb binary").withColumn("runs", F.lit("clash"))


def test_traced(rasters):
    rows = pixels.traced(rasters, *pixels.PARTS).collect()
    assert len(rows) == 16
    for r in rows:
        if r.image_id in (100, 101):
            assert r.variance is None and r.edge_pixels == 0 and r.runs == [] == r.lines == r.polygons
    flags = {r.image_id: r for r in pixels.grid(pixels.traced(rasters, "runs")).collect()}
    for r in rasters.where("length(rgb) > 100").collect():
        mask = edges.edge_map(raster.grey(np.frombuffer(r.rgb, dtype=np.uint8).reshape(160, 200, 3)))
        h, v = opened(mask, 25).sum(), opened(mask.T, 25).sum()
        assert (flags[r.image_id].h_pixels, flags[r.image_id].v_pixels, flags[r.image_id].grid) == (h, v, bool(h > 300 and v > 300))
    assert any(f.grid for f in flags.values()), flags
    assert not all(f.grid for f in flags.values())
    with pytest.raises(ValueError):
        pixels.traced(rasters, "nothing")
    assert pixels.traced(rasters.where("false"), "runs", "lines").count() == 0


def test_openings(spark):
    mask = draw.random((40, 70)) < 0.93
    mask[3], mask[4, :10], mask[5, -9:] = True, False, False
    line, start, stop = areas.scan_runs(mask)
    for length in (2, 3, 5, 8):
        runs = [("h", int(a), int(b), int(c - b)) for a, b, c in zip(line, start, stop, strict=True)]
        frame = spark.createDataFrame([(runs, 70)], "runs array<struct<axis: string, line: int, start: int, length: int>>, width int")
        got = frame.select(pixels.opened_pixels(F.col("runs"), "h", F.col("width"), F.lit(length))).first()[0]
        assert got == opened(mask, length).sum()


def test_line_features_against_sql(rasters, spark):
    """The database counts arrows and connections over the lines that the kernel emits."""
    duckdb = pytest.importorskip("duckdb")
    slanted = []
    for i in range(8):
        rgb = raster.paint([("line", 5, 60 + 14 * k, 75, 4 + 14 * k, 0) for k in range(i)], 110, 180)
        slanted.append((i + 200, 110, 180, rgb.tobytes()))
    frame = rasters.drop("runs").where("image_id < 50").dropDuplicates(["image_id"]).union(spark.createDataFrame(slanted, "image_id long, width int, height int, rgb binary"))
    rows = pixels.traced(frame, "lines")
    lines = rows.select("image_id", F.explode("lines").alias("s")).select("image_id", "s.*").toPandas()
    con = duckdb.connect()
    con.register("lines", lines)
    want = dict((i, (a, c)) for i, a, c in con.execute("""select image_id, least(count(*) filter (where abs(degrees(atan2(y1 - y0, x1 - x0))) between 20.0000001 and 69.9999999 or abs(degrees(atan2(y1 - y0, x1 - x0))) between 110.0000001 and 159.9999999) // 3, 20),
        least(count(*), 20) from lines group by all""").fetchall())
    got = {r.image_id: (r.a, len(r.c)) for r in rows.select("image_id", pixels.arrows(F.col("lines")).alias("a"), pixels.connections(F.col("lines")).alias("c")).collect()}
    assert {k: v for k, v in got.items() if v != (0, 0)} == {k: v for k, v in want.items() if v != (0, 0)} and max(a for a, _ in got.values()) > 0


def test_chart_type(spark):
    words = ["pie", "scatter", "candlestick", "bar", "line"]
    cases = [({}, None, "unknown"), ({"scatter"}, None, "scatter"), ({"pie", "line"}, None, "pie"), ({"line"}, ("line", 2.5), "line"), ({"scatter"}, ("line", 4.0), "line"), ({"scatter"}, ("bar", 2.0), "scatter"), ({"scatter"}, ("bar", 3.5), "bar"),
             (set(), ("bar", 2.0), "bar"), (set(), ("pie", 2.5), "pie"), ({"bar"}, ("pie", 2.5), "bar"), ({"pie"}, ("pie", 2.5), "pie"), ({"line", "bar"}, ("line", 2.5), "line")]
    frame = spark.createDataFrame([(i, *[w in said for w in words], seen) for i, (said, seen, _) in enumerate(cases)], "i int, " + ", ".join(f"{w} boolean" for w in words) + ", visual struct<kind: string, score: double>")
    got = {r.i: r.t for r in frame.select("i", pixels.chart_type({w: F.col(w) for w in words}, F.col("visual")).alias("t")).collect()}
    assert got == {i: want for i, (_, _, want) in enumerate(cases)}


def test_chart_scores(spark):
    """Planted rules, bars and a pie are told apart."""

    def picture(kind: str) -> bytes:
        rgb = np.full((120, 160, 3), 255, dtype=np.uint8)
        if kind == "line":
            for k in range(5):
                rgb[15 + 20 * k : 18 + 20 * k, 5:155] = 0
        if kind == "bar":
            for k in range(20):
                rgb[8 : 115, 4 + 8 * k : 7 + 8 * k] = 0
        y, x = np.mgrid[0:120, 0:160]
        if kind == "pie":
            rgb[np.hypot(y - 60, x - 80) <= 40] = (200, 60, 40)
            rgb[(abs(y - 60) < 2) & (abs(x - 80) < 39)] = 0
        return rgb.tobytes()

    kinds = ["line", "bar", "pie", "nothing"]
    frame = spark.createDataFrame([(i, 160, 120, picture(k)) for i, k in enumerate(kinds)], "image_id long, width int, height int, rgb binary")
    rows = pixels.chart_scores(pixels.traced(frame, *pixels.CHART_PARTS)).select("image_id", pixels.chart_type({k: F.lit(False) for k in pixels.CHART_KINDS}, F.col("visual")).alias("kind"), "visual.score")
    assert {r.image_id: (r.kind, r.score) for r in rows.collect()} == {0: ("line", 4.0), 1: ("bar", 3.5), 2: ("pie", 2.5), 3: ("unknown", None)}


def test_render_and_files(spark):
    shapes = spark.createDataFrame([(1, 1, "rect", 12.0, 22.0, 14.0, 23.0, 0xFF0000), (1, 0, "rect", 10.0, 20.0, 19.0, 29.0, 0x0000FF), (2, 0, "disc", 5.0, 5.0, 3.0, 0.0, 0x00FF00)], "image_id long, z int, form string, x0 double, y0 double, x1 double, y1 double, color int")
    regions = spark.createDataFrame([(1, 10.0, 20.0, 20.0, 30.0), (2, 0.0, 0.0, 11.0, 11.0), (3, 0.0, 0.0, 4.0, 2.0)], "image_id long, x0 double, y0 double, x1 double, y1 double")
    made = pixels.render(shapes, regions, dpi=144.0)
    got = {r.image_id: np.frombuffer(r.rgb, dtype=np.uint8).reshape(r.height, r.width, 3) for r in made.collect()}
    assert got[1].shape == (20, 20, 3) and got[3].shape == (4, 8, 3) and (got[3] == 255).all()
    assert got[1][4, 4].tolist() == [255, 0, 0] and got[1][0, 0].tolist() == [0, 0, 255] and got[1][7, 9].tolist() == [0, 0, 255]
    back = pixels.decode(pixels.encode(made).union(spark.createDataFrame([(9, b"no picture"), (8, None)], "image_id long, png binary")))
    rows = {r.image_id: r for r in back.collect()}
    assert all((np.frombuffer(rows[k].rgb, dtype=np.uint8).reshape(got[k].shape) == got[k]).all() for k in got)
    assert rows[9].rgb is None and "PNG" in rows[9].error and rows[8].error


def test_drawings_are_traced_as_their_rasters(spark):
    shapes = spark.createDataFrame([(i, z, form, 3.0 * z + i % 2, 4.0, 30.0 + z, 5.0 * z + 9, c) for i in range(6) for z, form, c in ((0, "rect", 0x141414), (1, "line", 0xC83C28), (2, "disc", 0x2850C8))], "image_id long, z int, form string, x0 double, y0 double, x1 double, y1 double, color int")
    # places count from a region's corner, a disc's radius doesn't; region 9 has no shapes and 10 no pixels
    regions = spark.createDataFrame([(i, float(i % 2), 0.0, 60.0 + i % 2, 50.0) for i in range(6)] + [(9, 0.0, 0.0, 20.0, 10.0), (10, 0.0, 0.0, 0.0, 10.0)], "image_id long, x0 double, y0 double, x1 double, y1 double")
    plain = pixels.render(shapes, regions)
    assert "Broadcast" not in plain._jdf.queryExecution().executedPlan().toString()  # estimates of shapes are too low
    drawings = pixels.Drawings(shapes, regions)
    ours, theirs = (pixels.traced(source, *pixels.PARTS).orderBy("image_id").collect() for source in (drawings, plain))
    assert ours == theirs and len(ours) == 8


def test_batches_are_taken_in_pieces():
    batch = pa.RecordBatch.from_pydict({"image_id": list(range(1000))})
    pieces = list(pixels._sliced([batch]))
    assert max(p.num_rows for p in pieces) <= 256 and [v for p in pieces for v in p.column(0).to_pylist()] == list(range(1000))


def test_votes_rims_and_blobs_against_plain_ones(monkeypatch):
    draw = np.random.default_rng(5)
    mask = draw.random((40, 50)) < 0.05
    mask[10, 5:45] = mask[5:38, 20] = True
    ys, xs = np.nonzero(mask)
    cos, sin = strokes._angles()
    count: dict = {}
    for y, x in zip(ys.tolist(), xs.tolist(), strict=True):
        for k, away in enumerate(np.rint(x * cos + y * sin).astype(int).tolist()):
            count[k, away] = count.get((k, away), 0) + 1
    assert bool(strokes.segments(mask, votes=max(count.values()), least=5)) and not strokes.segments(mask, votes=max(count.values()) + 1, least=5)
    for centre, (support, radius) in zip([(20, 10), (3, 30)], strokes._rims(xs, ys, [(20, 10), (3, 30)], 4, 12), strict=True):
        away = np.rint(np.hypot(xs - centre[0], ys - centre[1]))
        held = {r: int((abs(away - r) <= 1).sum()) for r in range(5, 12)}
        assert support >= max(held.values()) and 3 <= radius <= 12
    # two levels between which no pixel lies are looked at once
    grey = np.full((30, 30), 200, dtype=np.uint8)
    grey[5:10, 5:10] = grey[20:25, 20:25] = 100
    calls, plain = [], areas.components
    monkeypatch.setattr(areas, "components", lambda *a: calls.append(1) or plain(*a))
    image = pixels.Image(np.repeat(grey[..., None], 3, axis=2))
    assert image.blobs() == 2 and len(calls) == 3


def test_features_are_taken_of_distinct_drawings(spark):
    """Only an image's features meet the images: lists of runs are neither joined nor broadcast."""
    shapes = spark.createDataFrame([(i, z, "rect", 5.0, 8.0 * z + 3, 90.0, 8.0 * z + 5, 0x141414) for i in range(40) for z in range(1 + i % 2)], "image_id long, z int, form string, x0 double, y0 double, x1 double, y1 double, color int")
    regions = spark.createDataFrame([(i, 0.0, 0.0, 96.0, 60.0) for i in range(40)], "image_id long, x0 double, y0 double, x1 double, y1 double")
    drawings = pixels.Drawings(shapes, regions)
    flags = pixels.traced(drawings, "runs", features=pixels.grid)
    whole = pixels.traced(drawings, "runs")
    assert flags.orderBy("image_id").collect() == pixels.grid(whole).orderBy("image_id").collect() and flags.count() == 40
    assert pixels.traced(pixels.render(shapes, regions), "runs", features=pixels.grid).orderBy("image_id").collect() == flags.orderBy("image_id").collect()
    plan = flags._jdf.queryExecution().optimizedPlan().toString()
    assert "runs" not in plan and "rightHint=(strategy=broadcast)" in plan
    assert "strategy=broadcast" not in whole._jdf.queryExecution().optimizedPlan().toString()
