"""The public entry points: layout tables and a taxonomy in, segments and links out."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from glyphgrid.operators import calls, extraction, layout, linking, models, ocr
from glyphgrid.operators.layout import PAGE
from glyphgrid.plans.durable import cut

#: The current profile scores parsed names over 0.5 and keeps one link a name; the legacy one plain names over 0.3.
PROFILES = ("current", "legacy")


def captions(regions: DataFrame, blocks: DataFrame) -> DataFrame:
    """(page, region_id, figure_number, caption) around each region."""
    return layout.detect_caption(regions, blocks)


def ocr_features(blocks: DataFrame) -> DataFrame:
    """One row a segment: text, confidence, and what charts and diagrams are told by."""
    rows = ocr.raw_text(blocks).join(ocr.ocr_confidence(blocks), "segment_id")
    chart, diagram = (F.struct(*[c for c in part.columns if c != "segment_id"]) for part in (ocr.chart_features(blocks), ocr.diagram_features(blocks)))
    rows = rows.join(ocr.chart_features(blocks).select("segment_id", chart.alias("chart")), "segment_id", "left")
    return rows.join(ocr.diagram_features(blocks).select("segment_id", diagram.alias("diagram")), "segment_id", "left")


def link(segments: DataFrame, taxonomy: DataFrame, profile: str = "current") -> DataFrame:
    """Ranked concept links of segments (segment_id, caption, summary, ocr, nearby)."""
    if profile not in PROFILES:
        raise ValueError(f"no such profile: {profile}")
    if profile == "current":
        return linking.ranked_links(linking.scores(segments, linking.concepts(taxonomy), least=0.5))
    found = linking.legacy_scores(segments, linking.concepts(taxonomy, parsed=False))
    order = Window.partitionBy("segment_id").orderBy(F.desc(F.round("score", 6)), "idx")
    return found.select("segment_id", "idx", "concept_id", "concept", "level", "score", F.row_number().over(order).alias("rank"))


def segments(blocks: DataFrame, drawings: DataFrame, images: DataFrame, taxonomy: DataFrame | None = None, render: Callable[[DataFrame], DataFrame] | None = None, read: Callable[[DataFrame], DataFrame] | None = None, analyzer: Callable[[], models.Analyzer] | None = None, policy: calls.Policy = calls.Policy(), profile: str = "current") -> DataFrame:
    """One row a visual segment, with what the adapters add, and its links.

    ``render`` gives (segment_id, image) of segments, ``read`` gives OCR text (segment_id,
    ocr) of those, ``analyzer`` makes a model; without them types and summaries are the
    offline fallback's. Calls follow ``policy``; a failed one leaves its text in ``error``.
    """
    found = extraction.two_pass(blocks, drawings, images)
    key = F.concat_ws("_", F.col("doc_id"), F.format_string("p%03d", "page_no"), "method", "idx")
    rows = found.withColumn("segment_id", key)
    near = layout.nearby_text(rows.withColumnRenamed("segment_id", "region_id"), blocks).withColumnRenamed("region_id", "segment_id")
    path = layout.heading_path(rows.withColumnRenamed("segment_id", "region_id"), blocks).withColumnRenamed("region_id", "segment_id")
    rows = rows.join(near.withColumnRenamed("nearby_text", "nearby"), [*PAGE, "segment_id"], "left").join(path, [*PAGE, "segment_id"], "left")
    rows = cut(rows)  # the extraction feeds all that follows, and is run once
    rows = rows.join(render(rows), "segment_id", "left") if render else rows.withColumn("image", F.lit(None).cast("binary"))
    rows = cut(rows.join(read(rows), "segment_id", "left")) if read else rows.withColumn("ocr", F.lit(""))
    none = F.lit(None).cast("string")
    answers = cut(models.analyze(rows, analyzer, policy)) if analyzer else rows.select("segment_id", none.alias("response_json"), none.alias("error"))
    told = models.parse_responses(answers, "error").withColumnRenamed("confidence", "classification_confidence").withColumnRenamed("method", "classified_by")
    rows = rows.join(told, "segment_id")
    if taxonomy is None:
        return rows.withColumn("links", F.array().cast("array<string>"))
    linked = link(rows, taxonomy, profile).groupBy("segment_id").agg(F.array_sort(F.collect_list(F.struct("rank", "concept_id", "concept", "score"))).alias("links"))
    return rows.join(linked, "segment_id", "left")


def legacy_analysis(rows: DataFrame, make: Callable[[], calls.Model], policy: calls.Policy = calls.Policy()) -> DataFrame:
    """Segments (segment_id, image, ocr, caption, figure_number, heading_path) by the earlier profile's two calls.

    The first names a type, the second summarises by type, with a Mermaid drawing of diagrams and flowcharts asked for
    between. A call that fails leaves the fallback's type or summary.
    """
    names = ["segment_type", "confidence", "method", "mermaid", "summary", "summary_confidence"]
    rows = rows.drop(*names)
    types = cut(calls.classified(calls.called(calls.classification_requests(rows), make, policy)))
    rows = rows.join(types, "segment_id")
    drawn = calls.called(calls.mermaid_requests(rows), make, policy).select("segment_id", F.col("response").alias("drawing"))
    rows = cut(rows.join(drawn, "segment_id").withColumn("mermaid", models.mermaid(F.col("drawing"), F.col("segment_type"))["code"]).drop("drawing"))
    told = calls.called(calls.summary_requests(rows), make, policy).select("segment_id", "response")
    none = F.lit(None).cast("string")
    summary = calls.summarised(F.col("response"), models.fallback_summary(F.col("segment_type"), none, none, F.col("caption")))
    rows = rows.join(told, "segment_id").withColumn("told", summary)
    return rows.withColumns({"summary": F.col("told.text"), "summary_confidence": F.col("told.confidence")}).drop("response", "told")
