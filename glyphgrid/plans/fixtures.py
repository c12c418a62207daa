"""Layout, segment and taxonomy inputs derived from the driver's tables, and the same views as DuckDB CTEs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _numbered(spark: SparkSession, sf_dir: str, by: tuple[str, ...] = ("doc_id", "page_no")) -> DataFrame:
    """Line items numbered within their order, which is a page: dealt by the page's key, as all that follows is, or by ``okey``.

    Only what numbering needs is dealt, and the same for all views of a plan, so that one exchange serves them.
    """
    ints = {"pk": "l_partkey", "sk": "l_suppkey", "q": "l_quantity", "ln": "l_linenumber"}
    rows = table(spark, sf_dir, "lineitem").select(F.expr("l_orderkey div 8").alias("doc_id"), F.expr("l_orderkey % 8").alias("page_no"), F.col("l_orderkey").alias("okey"), *ints.values(), "l_extendedprice", "l_shipdate")
    order = Window.partitionBy(*by).orderBy("l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_shipdate")
    rows = rows.withColumn("block_no", F.row_number().over(order))
    return rows.select("doc_id", "page_no", "okey", "block_no", *[F.col(c).cast("int").alias(n) for n, c in ints.items()])


def _double(sql: str, name: str):
    return F.expr(f"cast({sql} as double)").alias(name)


def blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.expr("""case when pk % 7 = 0 then concat('Figure ', cast(ln as string), '.', cast(sk as string), ': widget ', cast(pk as string), ' trend')
        when pk % 7 = 1 then concat('Results improve, as shown in Figure ', cast(ln as string), ' below')
        when pk % 7 = 2 then concat('Exhibit ', cast(ln as string), ' - price of part ', cast(pk as string))
        when q % 3 = 0 then trim(repeat('body text about the spread ', 8)) else concat('label ', cast(pk as string)) end""").alias("text")
    return _numbered(spark, sf_dir).select(
        "doc_id", "page_no", "block_no", _double("9 + ln", "font_size"), _double("40 + (pk % 5) * 10", "x0"), _double("30 + 90 * (block_no - 1) + sk % 50", "y0"),
        _double("40 + (pk % 5) * 10 + case when q % 3 = 0 then 450 else 120 + (pk % 20) * 10 end", "x1"),
        _double("30 + 90 * (block_no - 1) + sk % 50 + 12 + (q % 7) * 8", "y1"), F.lit(612.0).alias("page_width"), F.lit(1260.0).alias("page_height"), text,
    )


def drawings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _numbered(spark, sf_dir).where("sk % 3 = 0").select(
        "doc_id", "page_no", F.col("block_no").alias("draw_no"), _double("60 + (pk % 30) * 5", "x0"), _double("30 + 90 * (block_no - 1) - 20 + q % 20", "y0"),
        _double("60 + (pk % 30) * 5 + 20 + q", "x1"), _double("30 + 90 * (block_no - 1) + q % 20 + pk % 40", "y1"),
    )


def images(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _numbered(spark, sf_dir).where("pk % 5 = 0").select(
        "doc_id", "page_no", F.col("block_no").alias("img_no"), _double("50 + pk % 100", "x0"), _double("30 + 90 * (block_no - 1) - 10", "y0"),
        _double("50 + pk % 100 + 40 + q * 6", "x1"), _double("30 + 90 * (block_no - 1) + 30 + q * 2", "y1"),
        F.expr("40 + q * 8").alias("px_w"), F.expr("40 + sk * 5").alias("px_h"), _double("pk % 1200", "grey_var"),
    )


def ocr_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.expr("""case when pk % 6 = 0 then concat('$', cast(q as string), '.5M') when pk % 6 = 1 then concat(cast(sk as string), '%') when pk % 6 = 2 then 'Year'
        when pk % 6 = 3 then 'Price (USD)' when pk % 6 = 4 then concat('Series ', cast(ln as string)) else 'decision node' end""").alias("text")
    return _numbered(spark, sf_dir, ("okey",)).select(
        F.col("okey").alias("segment_id"), F.col("block_no").alias("idx"), text, _double("pk % 500", "x0"), _double("(sk * 7) % 380", "y0"),
        _double("pk % 500 + 40", "x1"), _double("(sk * 7) % 380 + 12", "y1"), _double("80 + q % 20", "confidence"),
    )


def segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    cuts = {"caption": (1, 80), "summary": (81, 400), "nearby": (481, 500), "ocr": (981, 1 << 30)}  # the whole text is in a channel
    return table(spark, sf_dir, "documents").select(F.col("doc_id").alias("segment_id"), *[F.substring("text", a, n).alias(name) for name, (a, n) in cuts.items()])


def taxonomy(spark: SparkSession, sf_dir: str) -> DataFrame:
    third = F.regexp_extract("text", r"^[\p{L}]+ [\p{L}]+ ([\p{L}]+)", 1).alias("w3")
    named = table(spark, sf_dir, "benchmark").select(F.col("item_id").cast("int").alias("item_id"), "text", F.regexp_extract("text", r"^([\p{L}]+ [\p{L}]+)", 1).alias("base"), third).where("base <> ''")
    rows = named.withColumn("dup", F.explode(F.array(F.lit(0), F.lit(1))))
    # plain names, and names with parentheses, acronyms and hyphens
    shaped = F.expr("""case when item_id % 14 = 6 then concat(base, ' (T-bills)') when item_id % 10 = 4 then concat('LIBOR (', base, ')') when item_id % 5 = 1 then concat(base, ' (', upper(w3), ')')
        when item_id % 5 = 2 then replace(base, ' ', '-') when item_id % 5 = 3 then concat(split_part(base, ' ', 1), ' (', split_part(base, ' ', 2), ')') else base end""").alias("concept")
    return rows.select(F.expr("item_id * 2 + dup").alias("idx"), F.expr("(item_id + dup * 2) % 6 + 1").alias("level"), shaped, F.expr("substring(text, length(base) + 2, 40)").alias("tags"), F.col("item_id").cast("string").alias("pages"))


def gate_taxonomy(spark: SparkSession, sf_dir: str) -> DataFrame:
    word = F.split_part(F.regexp_extract("text", r"^([\p{L}]+ [\p{L}]+)", 1), F.lit(" "), F.lit(1))
    rows = table(spark, sf_dir, "benchmark").select(F.col("item_id").cast("int").alias("item_id"), word.alias("concept"))
    return rows.where("length(concept) >= 3").select(F.expr("1000 + item_id").alias("idx"), F.lit(1).alias("level"), "concept", F.lit("").alias("tags"), F.col("item_id").cast("string").alias("pages"))


#: Size of the raster fixtures, and their colours: five strong ones, a grey and a near black.
RASTER_WIDTH, RASTER_HEIGHT = 96, 60
PAINTS = [0xC83C28, 0x28A03C, 0x2850C8, 0xC8A01E, 0x8C28A0, 0x787878, 0x141414]
_PAINT = lambda n: "case " + n + " " + " ".join(f"when {i} then {c}" for i, c in enumerate(PAINTS)) + " end"
#: Shapes of image k (a part, of size s), numbered i: by k % 6 bars, rules or a grid, a diagram, a scatter, a pie, patches.
_SHAPE = {
    "form": "case when k % 6 = 4 and i = 0 then 'disc' when k % 6 = 4 or k % 6 = 2 and i > 3 then 'line' else 'rect' end",
    "x0": "case k % 6 when 0 then 4 + i * 6 when 1 then case when k % 12 = 1 then 4 when i < 3 then 4 + i * 8 else 30 end when 2 then case i when 0 then 4 when 1 then 6 when 2 then 44 when 3 then 46 when 4 then 26 else 6 end when 3 then 4 + ((k + i * 17) * 7) % 60 when 4 then 36 else (k * (i + 1) * 11) % 50 end",
    "y0": "case k % 6 when 0 then 56 - (40 + (k * (i + 3) + s * i) % 12) when 1 then case when k % 12 = 1 then 5 + i * 9 when i < 3 then 3 else 8 + (i - 3) * 18 end when 2 then case i when 0 then 4 when 1 then 6 when 2 then 36 when 3 then 38 when 4 then 20 else 54 end when 3 then 4 + ((k * 3 + i * 29) * 5) % 48 when 4 then 30 else (s * (i + 2) * 7) % 40 end",
    "x1": "case k % 6 when 0 then 6 + i * 6 when 1 then case when k % 12 = 1 then 90 when i < 3 then 6 + i * 8 else 93 end when 2 then case i when 0 then 26 when 1 then 24 when 2 then 68 when 3 then 66 when 4 then 44 else 26 + s % 20 end when 3 then 7 + ((k + i * 17) * 7) % 60 when 4 then case i when 0 then 18 + k % 8 else 12 + i * 12 end else (k * (i + 1) * 11) % 50 + 8 + (k + i) % 14 end",
    "y1": "case k % 6 when 0 then 56 when 1 then case when k % 12 = 1 then 7 + i * 9 when i < 3 then 56 else 10 + (i - 3) * 18 end when 2 then case i when 0 then 20 when 1 then 18 when 2 then 55 when 3 then 53 when 4 then 36 + k % 3 else 34 - k % 14 end when 3 then 7 + ((k * 3 + i * 29) * 5) % 48 when 4 then 16 + k % 5 else (s * (i + 2) * 7) % 40 + 6 + (s + i) % 14 end",
    "color": f"case when k % 6 = 2 and i in (1, 3) then 16777215 when k % 6 = 0 or k % 6 = 4 and i = 0 then {_PAINT('(k + i) % 5')} when k % 6 = 5 then {_PAINT('(k * i + s) % 6')} else {PAINTS[6]} end",
}
_SHAPES_HELD = "i < case k % 6 when 0 then 11 when 1 then 6 when 2 then 6 when 3 then 12 when 4 then 4 else 7 end"


def shapes(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("k"), F.col("p_size").alias("s"), F.explode(F.sequence(F.lit(0), F.lit(11))).alias("i")).where(_SHAPES_HELD)
    return rows.select(F.col("k").alias("image_id"), F.col("i").alias("z"), *[F.expr(v).alias(n) for n, v in _SHAPE.items()])


def drawn(spark: SparkSession, sf_dir: str):
    """One small image a part, drawn by its shapes."""
    from glyphgrid.operators import pixels

    boxes = table(spark, sf_dir, "part").selectExpr("p_partkey as image_id", "0 as x0", "0 as y0", f"{RASTER_WIDTH} as x1", f"{RASTER_HEIGHT} as y1")
    return pixels.Drawings(shapes(spark, sf_dir), boxes)


def rasters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The drawn images' pixels."""
    from glyphgrid.operators import pixels

    held = drawn(spark, sf_dir)
    return pixels.render(held.shapes, held.regions)


_O = """o as (select l_orderkey // 8 as doc_id, l_orderkey % 8 as page_no, l_orderkey as okey, cast(row_number() over (partition by l_orderkey order by l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_shipdate) as int) as block_no,
 cast(l_partkey as int) as pk, cast(l_suppkey as int) as sk, cast(l_quantity as int) as q, cast(l_linenumber as int) as ln from lineitem)"""

#: CTEs of the views in DuckDB's SQL; {o} stands for the numbered line items.
VIEWS = {
    "fx_shapes": "fx_shapes as (select k as image_id, i as z, " + ", ".join(f"{v} as {n}" for n, v in _SHAPE.items()) + f" from (select p_partkey as k, p_size as s, cast(unnest(range(12)) as int) as i from part) where {_SHAPES_HELD})",
    # colours by pixel i (line by line) and grey values
    "fx_pixels": f"""fx_area as (select *, case form when 'disc' then x0 - x1 else least(x0, x1) end as l, case form when 'disc' then x0 + x1 else greatest(x0, x1) end as r, case form when 'disc' then y0 - x1 else least(y0, y1) end as t, case form when 'disc' then y0 + x1 else greatest(y0, y1) end as b from fx_shapes),
fx_lines as (select *, unnest(range(greatest(t, 0), least(b, {RASTER_HEIGHT - 1}) + 1)) as y from fx_area), fx_dots as (select *, unnest(range(greatest(l, 0), least(r, {RASTER_WIDTH - 1}) + 1)) as x from fx_lines),
fx_top as (select image_id, y * {RASTER_WIDTH} + x as i, arg_max(color, z) as color from fx_dots where case form when 'rect' then true when 'disc' then (x - x0) ** 2 + (y - y0) ** 2 <= x1 ** 2 else abs((y - y0) * (x1 - x0) - (x - x0) * (y1 - y0)) <= greatest(abs(x1 - x0), abs(y1 - y0)) end group by all),
fx_blank as (select p_partkey as image_id, unnest(range({RASTER_WIDTH * RASTER_HEIGHT})) as i from part),
fx_pixels as (select image_id, i, i % {RASTER_WIDTH} as x, i // {RASTER_WIDTH} as y, coalesce(color, 16777215) as color, ((coalesce(color, 16777215) >> 16) * 19595 + ((coalesce(color, 16777215) >> 8) & 255) * 38470 + (coalesce(color, 16777215) & 255) * 7471 + 32768) >> 16 as v from fx_blank left join fx_top using (image_id, i))""",
    "o": _O,
    "fx_blocks": """fx_blocks as (select doc_id, page_no, block_no, cast(9 + ln as double) as font_size, cast(40 + (pk % 5) * 10 as double) as x0,
 cast(30 + 90 * (block_no - 1) + sk % 50 as double) as y0, cast(40 + (pk % 5) * 10 + case when q % 3 = 0 then 450 else 120 + (pk % 20) * 10 end as double) as x1,
 cast(30 + 90 * (block_no - 1) + sk % 50 + 12 + (q % 7) * 8 as double) as y1, cast(612 as double) as page_width, cast(1260 as double) as page_height,
 case when pk % 7 = 0 then concat('Figure ', cast(ln as string), '.', cast(sk as string), ': widget ', cast(pk as string), ' trend')
 when pk % 7 = 1 then concat('Results improve, as shown in Figure ', cast(ln as string), ' below')
 when pk % 7 = 2 then concat('Exhibit ', cast(ln as string), ' - price of part ', cast(pk as string))
 when q % 3 = 0 then trim(repeat('body text about the spread ', 8)) else concat('label ', cast(pk as string)) end as text from o)""",
    "fx_drawings": """fx_drawings as (select doc_id, page_no, block_no as draw_no, cast(60 + (pk % 30) * 5 as double) as x0, cast(30 + 90 * (block_no - 1) - 20 + q % 20 as double) as y0,
 cast(60 + (pk % 30) * 5 + 20 + q as double) as x1, cast(30 + 90 * (block_no - 1) + q % 20 + pk % 40 as double) as y1 from o where sk % 3 = 0)""",
    "fx_images": """fx_images as (select doc_id, page_no, block_no as img_no, cast(50 + pk % 100 as double) as x0, cast(30 + 90 * (block_no - 1) - 10 as double) as y0,
 cast(50 + pk % 100 + 40 + q * 6 as double) as x1, cast(30 + 90 * (block_no - 1) + 30 + q * 2 as double) as y1, 40 + q * 8 as px_w, 40 + sk * 5 as px_h, cast(pk % 1200 as double) as grey_var from o where pk % 5 = 0)""",
    "fx_ocr": """fx_ocr as (select okey as segment_id, block_no as idx, case when pk % 6 = 0 then concat('$', cast(q as string), '.5M') when pk % 6 = 1 then concat(cast(sk as string), '%') when pk % 6 = 2 then 'Year'
 when pk % 6 = 3 then 'Price (USD)' when pk % 6 = 4 then concat('Series ', cast(ln as string)) else 'decision node' end as text, cast(pk % 500 as double) as x0, cast((sk * 7) % 380 as double) as y0,
 cast(pk % 500 + 40 as double) as x1, cast((sk * 7) % 380 + 12 as double) as y1, cast(80 + q % 20 as double) as confidence from o)""",
    "fx_segments": "fx_segments as (select doc_id as segment_id, substring(text, 1, 80) as caption, substring(text, 81, 400) as summary, substring(text, 481, 500) as nearby, substring(text, 981) as ocr from documents)",
    "fx_taxonomy": r"""fx_taxonomy as (with b as (select cast(item_id as int) as item_id, text, regexp_extract(text, '^([\p{L}]+ [\p{L}]+)', 1) as base, regexp_extract(text, '^[\p{L}]+ [\p{L}]+ ([\p{L}]+)', 1) as w3 from benchmark), d as (select 0 as dup union all select 1)
 select item_id * 2 + dup as idx, (item_id + dup * 2) % 6 + 1 as level, case when item_id % 14 = 6 then concat(base, ' (T-bills)') when item_id % 10 = 4 then concat('LIBOR (', base, ')') when item_id % 5 = 1 then concat(base, ' (', upper(w3), ')')
 when item_id % 5 = 2 then replace(base, ' ', '-') when item_id % 5 = 3 then concat(split_part(base, ' ', 1), ' (', split_part(base, ' ', 2), ')') else base end as concept, substring(text, length(base) + 2, 40) as tags, cast(item_id as string) as pages from b cross join d where base <> ''
 union all by name select 1000 + item_id as idx, 1 as level, split_part(base, ' ', 1) as concept, '' as tags, cast(item_id as string) as pages from b where length(split_part(base, ' ', 1)) >= 3)""",
}


def _near(column: str, dy: int, dx: int, clamp: bool) -> str:
    """A neighbour's value in a list by pixel: the border's repeated, or 0 outside."""
    h, w = RASTER_HEIGHT, RASTER_WIDTH
    if clamp:
        return f"{column}[1 + greatest(0, least({h - 1}, y + {dy})) * {w} + greatest(0, least({w - 1}, x + {dx}))]"
    return f"case when y + {dy} between 0 and {h - 1} and x + {dx} between 0 and {w - 1} then {column}[1 + (y + {dy}) * {w} + x + {dx}] else 0 end"


def _sobel(across: bool) -> str:
    parts = []
    for a in (-1, 0, 1):
        for side in (-1, 1):
            dy, dx = (a, side) if across else (side, a)
            parts.append(f"{'+' if side > 0 else '-'} {2 if a == 0 else 1} * {_near('g', dy, dx, True)}")
    return " ".join(parts)


#: Edges (image_id, x, y): gradients, thinning by their direction, and weak edges reached from strong ones.
VIEWS["fx_edges"] = f"""fx_grey as (select image_id, list(v order by i) as g from fx_pixels group by image_id),
fx_cells as (select i, i % {RASTER_WIDTH} as x, i // {RASTER_WIDTH} as y from range({RASTER_WIDTH * RASTER_HEIGHT}) as t(i)),
fx_grad as (select image_id, i, 0 {_sobel(True)} as gx, 0 {_sobel(False)} as gy from fx_grey cross join fx_cells),
fx_strength as (select image_id, list(abs(gx) + abs(gy) order by i) as m, list(gx order by i) as gxs, list(gy order by i) as gys from fx_grad group by image_id),
fx_around as (select image_id, x, y, m[1 + i] as m, gxs[1 + i] as gx, gys[1 + i] as gy, {", ".join(f"{_near('m', dy, dx, False)} as {name}" for name, dy, dx in (("w", 0, -1), ("e", 0, 1), ("n", -1, 0), ("s", 1, 0), ("nw", -1, -1), ("ne", -1, 1), ("sw", 1, -1), ("se", 1, 1)))} from fx_strength cross join fx_cells),
fx_weak as materialized (select image_id, x, y, m from fx_around where m > 50 and case when abs(gy) << 15 < abs(gx) * 13573 then m > w and m >= e when abs(gy) << 15 > abs(gx) * 13573 + (abs(gx) << 16) then m > n and m >= s when xor(gx, gy) < 0 then m > ne and m > sw else m > nw and m > se end),
fx_edges as (select image_id, x, y from fx_weak where m > 150 union select k.image_id, k.x, k.y from fx_edges d join fx_weak k on k.image_id = d.image_id and k.y between d.y - 1 and d.y + 1 and k.x between d.x - 1 and d.x + 1)"""
VIEWS["fx_runs"] = """fx_runs as (select image_id, axis, line, min(pos) as start, count(*) as length from (select *, pos - row_number() over (partition by image_id, axis, line order by pos) as island from (select image_id, 'h' as axis, y as line, x as pos from fx_edges union all select image_id, 'v', x, y from fx_edges)) group by image_id, axis, line, island)"""


def ctes(*names: str) -> str:
    """``with`` clause of the named views, in order, the numbered line items first."""
    needs = ["o"] if any(n in ("fx_blocks", "fx_drawings", "fx_images", "fx_ocr") for n in names) else []
    return ("with recursive " if "fx_edges" in names else "with ") + ",\n".join(VIEWS[n] for n in [*needs, *names])
