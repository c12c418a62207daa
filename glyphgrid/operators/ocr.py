"""Features of OCR blocks (segment_id, idx, text, box): one aggregation by segment each."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from glyphgrid.functions import text as T

def own():
    return Window.partitionBy("segment_id")



def mid(a: str, b: str) -> Column:
    return (F.col(a) + F.col(b)) / 2


def raw_text(blocks: DataFrame) -> DataFrame:
    """(segment_id, text): blocks in order, one a line."""
    ordered = F.transform(F.array_sort(F.collect_list(F.struct("idx", "text"))), lambda s: s["text"])
    return blocks.groupBy("segment_id").agg(F.array_join(ordered, "\n").alias("text"))


def ocr_confidence(blocks: DataFrame) -> DataFrame:
    return blocks.groupBy("segment_id").agg((F.avg("confidence") / 100).alias("confidence"), F.count(F.lit(1)).alias("n_blocks"))


def legend_clusters(blocks: DataFrame) -> DataFrame:
    """Texts on the right that stand within 50 of each other: the largest run, the first of equals; a lone one as it is."""
    wide = blocks.withColumn("width", F.max("x1").over(own()))
    text = F.trim("text")
    rows = wide.where(F.length(text).between(3, 30) & ~text.rlike(T.NUMERIC_MONEY) & (mid("x0", "x1") > 0.6 * F.col("width"))).select("segment_id", "idx", text.alias("text"), mid("y0", "y1").alias("y"))
    order = own().orderBy("y", "idx")
    rows = rows.withColumn("fresh", F.when(F.col("y") - F.lag("y").over(order) < 50, 0).otherwise(1)).withColumn("run", F.sum("fresh").over(order)).withColumn("n", F.count(F.lit(1)).over(own()))
    runs = rows.groupBy("segment_id", "run", "n").agg(F.count(F.lit(1)).alias("size"), F.array_sort(F.collect_list(F.struct("y", "idx", "text"))).alias("items"))
    best = runs.where("size >= 2 or n < 2").withColumn("place", F.row_number().over(own().orderBy(F.desc("size"), "run"))).where("place = 1")
    return best.select("segment_id", F.array_join(F.transform("items", lambda s: s["text"]), "|").alias("legend"))


def axes_zones(blocks: DataFrame) -> DataFrame:
    """Longest text without numbers in the bottom and the left zone; the first of equals."""
    rows = blocks.withColumn("max_x", F.max("x1").over(own())).withColumn("max_y", F.max("y1").over(own())).withColumn("t", F.trim("text"))
    good = (F.length("t") > 3) & ~F.col("t").rlike(T.NUMERIC_MONEY)
    rank = F.struct(F.length("t"), -F.col("idx"))
    bottom, left = good & (mid("y0", "y1") > 0.85 * F.col("max_y")), good & (mid("x0", "x1") < 0.15 * F.col("max_x"))
    return rows.groupBy("segment_id").agg(F.max_by("t", F.when(bottom, rank)).alias("x_label"), F.max_by("t", F.when(left, rank)).alias("y_label"))


def value_ranges(blocks: DataFrame) -> DataFrame:
    """Least, greatest and count of numbers with currency signs and K, M, B; commas are dropped."""
    found = blocks.select("segment_id", F.explode(F.regexp_extract_all("text", F.lit(r"([€£¥$]?\s*-?\d+(?:[.,]\d+)?(?:[KMBkmb])?)\s*(%|€|£|¥|\$)?"), 1)).alias("raw"))
    clean = F.trim(F.regexp_replace("raw", "[,$€£¥]", ""))
    unit = F.upper(F.regexp_extract(clean, r"([KMBkmb])\z", 1))
    factor = F.when(unit == "K", 1e3).when(unit == "M", 1e6).when(unit == "B", 1e9).otherwise(1.0)
    numbers = found.select("segment_id", (F.regexp_replace(clean, r"[KMBkmb]\z", "").try_cast("double") * factor).alias("value")).where("value is not null")
    return numbers.groupBy("segment_id").agg(F.min("value").alias("lo"), F.max("value").alias("hi"), F.count(F.lit(1)).alias("n"))


def tick_labels(blocks: DataFrame) -> DataFrame:
    """Texts of the bottom zone, and numeric ones of the outer columns."""
    rows = blocks.withColumn("max_x", F.max("x1").over(own())).withColumn("max_y", F.max("y1").over(own())).withColumn("t", F.trim("text")).where("t <> '' and length(t) <= 20")
    fx, fy = mid("x0", "x1") / F.col("max_x"), mid("y0", "y1") / F.col("max_y")
    is_x = (mid("y0", "y1") > 0.8 * F.col("max_y")) & (fx > 0.1) & (fx < 0.9)
    is_y = ~is_x & ((mid("x0", "x1") < 0.15 * F.col("max_x")) | (mid("x0", "x1") > 0.85 * F.col("max_x"))) & (fy > 0.1) & (fy < 0.9) & F.col("t").rlike(r"^[0-9\-/.,\s%$€£¥KMB]+$")
    marked = rows.withColumn("axis", F.when(is_x, "x").when(is_y, "y")).where("axis is not null")
    ordered = F.transform(F.array_sort(F.collect_list(F.struct("idx", "t"))), lambda s: s["t"])
    return marked.groupBy("segment_id", "axis").agg(F.array_join(ordered, "|").alias("ticks"), F.count(F.lit(1)).alias("n"))


def nodes(blocks: DataFrame, most: int = 50) -> DataFrame:
    """Texts of 4 to 99 characters; a node's number is its place before the filter."""
    rows = blocks.withColumn("t", F.trim("text")).withColumn("place", F.row_number().over(own().orderBy("idx")) - 1).where("length(t) between 4 and 99")
    return rows.withColumn("rank", F.row_number().over(own().orderBy("idx"))).where(F.col("rank") <= most).select("segment_id", F.concat(F.lit("node_"), "place").alias("node_id"), F.col("t").alias("text"), "x0", "y0", "x1", "y1")


def layout(found: DataFrame) -> DataFrame:
    """Hierarchy (3 nodes over 100 in height) and layout by population variances (2 nodes at least)."""
    spread = found.groupBy("segment_id").agg(F.count(F.lit(1)).alias("n"), F.var_pop("x0").alias("vx"), F.var_pop("y0").alias("vy"), (F.max("y0") - F.min("y0")).alias("height"))
    kind = F.when(F.col("n") < 2, F.lit(None).cast("string")).when(F.col("vy") > 2 * F.col("vx"), "hierarchical_vertical").when(F.col("vx") > 2 * F.col("vy"), "hierarchical_horizontal").otherwise("free_form")
    return spread.select("segment_id", "n", kind.alias("layout"), ((F.col("n") >= 3) & (F.col("height") > 100)).alias("hierarchy"))


def has_table(text: Column) -> Column:
    found = F.size(F.filter(T.lines(text), lambda x: x.rlike(r"\d")))
    return (text != "") & (found > F.size(T.lines(text)) * 0.5) & (F.size(T.lines(text)) > 3)


def image_subtype(text: Column, grey_variance: Column) -> Column:
    n = F.length(text)
    return F.when(n > 500, "scanned_page").when(n > 100, "screenshot").when(grey_variance > 1500, "photo").otherwise("illustration")


def content_type(text: Column) -> Column:
    return F.when(F.lower(text).rlike("window|button|menu"), "interface").when(F.length(text) > 300, "document").otherwise("mixed")


def text_density(text: Column) -> Column:
    n = F.length(text)
    return F.when(n > 500, "dense").when(n > 100, "moderate").when(n > 0, "sparse").otherwise("none")


def subfigures(text: Column) -> Column:
    """Count of (a) or b) marks; fewer than two count as none."""
    n = F.regexp_count(F.lower(text), F.lit(r"\([a-z]\)|\b[a-z]\)"))
    return F.when(n >= 2, n).otherwise(0)


def decision_points(text: Column) -> Column:
    return F.lower(text).rlike("if|yes|no|decision|choose|select")


def chart_words(text: Column) -> dict[str, Column]:
    """Whether the words of each kind of chart are in a text."""
    low = F.lower(F.coalesce(text, F.lit("")))
    return {
        "pie": low.rlike(r"\bpie\b") & low.contains("chart"),
        "scatter": low.contains("scatter") | low.contains("correlation"),
        "candlestick": low.contains("candlestick") | (low.contains("open") & low.contains("close")),
        "bar": low.rlike(r"\bbar\b.*\b(chart|graph)\b"),
        "line": low.rlike(r"\bline\b.*\b(chart|graph)\b"),
    }


def chart_subtype(text: Column) -> Column:
    """The text part of chart typing: the first family whose words are there (each would score 3, over the limit of 2)."""
    return F.coalesce(*[F.when(found, name) for name, found in chart_words(text).items()], F.lit("unknown"))


def node_texts(blocks: DataFrame) -> DataFrame:
    """(segment_id, idx, text): texts of 4 to 49 characters, which could be nodes."""
    return blocks.select("segment_id", "idx", F.trim("text").alias("text")).where("length(text) between 4 and 49")


def chart_features(blocks: DataFrame) -> DataFrame:
    """One row a segment: subtype, labels, range, legend, series and ticks of a chart."""
    text = raw_text(blocks).select("segment_id", chart_subtype(F.col("text")).alias("subtype"))
    ticks = tick_labels(blocks).groupBy("segment_id").agg(*[F.max(F.when(F.col("axis") == a, F.col("ticks"))).alias(f"{a}_ticks") for a in "xy"])
    rows = text
    for part in (axes_zones(blocks), value_ranges(blocks), legend_clusters(blocks), ticks):
        rows = rows.join(part, "segment_id", "left")
    return rows.withColumn("series_count", F.coalesce(F.size(F.split("legend", r"\|")), F.lit(1)))


def diagram_features(blocks: DataFrame) -> DataFrame:
    """One row a segment: subtype, nodes, hierarchy, layout and decision points of a diagram."""
    text = raw_text(blocks).select("segment_id", T.diagram_subtype(F.col("text")).alias("subtype"), decision_points(F.col("text")).alias("decision_points"))
    rows = text.join(layout(nodes(blocks)), "segment_id", "left")
    return rows.select("segment_id", "subtype", F.coalesce("n", F.lit(0)).alias("node_count"), F.coalesce("hierarchy", F.lit(False)).alias("hierarchy"), "layout", "decision_points")


def image_features(rows: DataFrame, *kept: str) -> DataFrame:
    """Features of images (segment_id, text, grey_var), and the columns kept."""
    text = F.coalesce("text", F.lit(""))
    return rows.select("segment_id", image_subtype(text, F.col("grey_var")).alias("subtype"), (F.length(F.trim(text)) > 10).alias("contains_text"), text_density(text).alias("density"), has_table(text).alias("has_table"), content_type(text).alias("content"), *kept)


def figure_features(rows: DataFrame, *kept: str) -> DataFrame:
    """Composite structure of figures (segment_id, text, grey_var, arrows), and the columns kept."""
    marks = subfigures(F.coalesce("text", F.lit("")))
    return rows.select("segment_id", (marks >= 2).alias("is_composite"), marks.alias("sub_figures"), (F.coalesce("arrows", F.lit(0)) > 3).alias("contains_diagram"), F.coalesce(F.col("grey_var") > 1000, F.lit(False)).alias("contains_image"), *kept)
