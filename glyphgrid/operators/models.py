"""Model-backed steps behind adapters: parsing of responses, offline fallbacks, merging."""

from __future__ import annotations

from collections.abc import Callable
from typing import Protocol

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from glyphgrid.operators import calls

#: Tokens at most and temperature of the one call that tells all.
ANALYSE = (1500, 0.2)
TYPES = ["figure", "chart", "diagram", "flowchart", "image"]
RESPONSE = "classification struct<category:string,confidence:double>, summary struct<text:string,confidence:double>, metadata string"


class Analyzer(Protocol):
    """An injected model: image bytes and OCR text in, JSON text out; credentials are the caller's."""

    def __call__(self, image: bytes, ocr_text: str) -> str: ...


def analyze(segments: DataFrame, make: Callable[[], Analyzer], policy: calls.Policy = calls.Policy()) -> DataFrame:
    """(segment_id, response_json, error); one analyzer a task, called under a policy; a failed call is a row with its error and no response."""

    def model() -> calls.Model:
        analyzer = make()
        return lambda image, prompt, max_tokens, temperature: analyzer(image, prompt)

    asked = calls.requests(segments, F.substring(F.coalesce("ocr", F.lit("")), 1, 500), *ANALYSE)
    return calls.called(asked, model, policy).select("segment_id", F.col("response").alias("response_json"), "error")


def json_body(response: Column) -> Column:
    """The JSON inside a fenced block, or all of the response."""
    fenced = F.regexp_extract(response, r"(?s)```(?:json)?\s*(\{.*?\})\s*```", 1)
    return F.when(fenced != "", fenced).otherwise(F.trim(F.regexp_replace(response, "```(?:json)?", "")))


def parse_responses(responses: DataFrame, *kept: str) -> DataFrame:
    """Type, confidence and summary of responses, with columns ``kept``; unreadable ones get the fallback."""
    rows = responses.withColumn("r", F.from_json(json_body(F.col("response_json")), RESPONSE, {"mode": "PERMISSIVE"}))
    category = F.lower("r.classification.category")
    known = F.col("r.classification").isNotNull()
    return rows.select(
        "segment_id",
        *kept,
        F.when(known & category.isin(TYPES), category).otherwise("figure").alias("segment_type"),
        F.when(known, F.least(F.lit(0.95), F.coalesce("r.classification.confidence", F.lit(0.7)))).otherwise(0.3).alias("confidence"),
        F.when(known, "comprehensive").otherwise("fallback_heuristic").alias("method"),
        F.when(known, F.col("r.summary.text")).alias("summary"),
        F.when(known, F.coalesce("r.summary.confidence", F.lit(0.8))).otherwise(0.3).alias("summary_confidence"),
    )


METADATA = """chart_subtype string, x_axis_label string, y_axis_label string, legend_items array<string>, data_series_count int, has_grid boolean, value_range struct<min:double,max:double>,
 diagram_subtype string, node_count int, decision_points int, has_hierarchy boolean, layout_type string,
 image_subtype string, contains_text boolean, text_density string, is_embedded_table boolean, is_composite boolean, sub_figure_count int, contains_chart boolean, contains_diagram boolean, contains_image boolean"""
LISTS = ["definitions", "formulas", "variables", "tables", "input_variables", "output_values"]


def listed(body: Column, name: str) -> Column:
    """A list of a JSON object, each item as JSON text; anything else gives an empty list."""
    return F.coalesce(F.from_json(F.get_json_object(body, f"$.{name}"), "array<string>"), F.array().cast("array<string>"))


def typed_metadata(rows: DataFrame) -> DataFrame:
    """Rows (segment_id, segment_type, metadata) with chart, diagram, image and figure structs, null but for the type's own."""
    m = rows.withColumn("m", F.coalesce(F.from_json("metadata", METADATA), F.from_json(F.lit("{}"), METADATA)))
    kind = F.col("segment_type")
    ranged = F.col("m.value_range").isNotNull()
    chart = F.struct(
        F.col("m.chart_subtype").alias("subtype"), F.col("m.x_axis_label").alias("x_label"), F.col("m.y_axis_label").alias("y_label"), F.coalesce("m.legend_items", F.array().cast("array<string>")).alias("legend"),
        F.coalesce("m.data_series_count", F.lit(0)).alias("series_count"), F.coalesce("m.has_grid", F.lit(False)).alias("grid"), F.when(ranged, F.col("m.value_range.min")).alias("lo"), F.when(ranged, F.col("m.value_range.max")).alias("hi"),
    )
    diagram = F.struct(
        F.when(kind == "flowchart", "flowchart").otherwise(F.col("m.diagram_subtype")).alias("subtype"), F.coalesce("m.node_count", F.lit(0)).alias("node_count"),
        (F.coalesce("m.decision_points", F.lit(0)) > 0).alias("decision_points"), F.coalesce("m.has_hierarchy", F.lit(False)).alias("hierarchy"), F.col("m.layout_type").alias("layout"),
    )
    image = F.struct(
        F.col("m.image_subtype").alias("subtype"), F.coalesce("m.contains_text", F.lit(False)).alias("contains_text"), F.coalesce("m.text_density", F.lit("none")).alias("density"), F.coalesce("m.is_embedded_table", F.lit(False)).alias("has_table"),
        *[listed(F.col("metadata"), name).alias(name) for name in LISTS], F.get_json_object("metadata", "$.calculation_verification").alias("verification"),
    )
    figure = F.struct(*[F.coalesce(f"m.{c}", F.lit(False)).alias(c) for c in ("is_composite", "contains_chart", "contains_diagram", "contains_image")], F.coalesce("m.sub_figure_count", F.lit(0)).alias("sub_figures"))
    parts = {"chart": (["chart"], chart), "diagram": (["flowchart", "diagram"], diagram), "image": (["image"], image), "figure": (["figure"], figure)}
    return m.select("segment_id", "segment_type", *[F.when(kind.isin(types), value).alias(name) for name, (types, value) in parts.items()])


def mermaid(response: Column, segment_type: Column) -> Column:
    """Struct (code, type, confidence) of a fenced diagram, for diagrams and flowcharts only."""
    code = F.trim(F.regexp_extract(response, r"(?s)```mermaid\s*(.*?)\s*```", 1))
    head = F.substring(code, 1, 50)
    kind = F.when(head.contains("flowchart"), "flowchart").when(head.contains("sequenceDiagram"), "sequence").otherwise("graph")
    found = segment_type.isin("diagram", "flowchart") & F.regexp_like(response, F.lit(r"(?s)```mermaid\s*(.*?)\s*```"))
    return F.when(found, F.struct(code.alias("code"), kind.alias("type"), F.lit(0.75).alias("confidence")))


def calculations(response: Column) -> dict[str, Column]:
    """Inputs, outputs and verification of the widest braces in a response."""
    body = F.regexp_extract(response, r"(?s)\{.*\}", 0)
    return {"inputs": listed(body, "input_variables"), "outputs": listed(body, "output_values"), "verification": F.get_json_object(body, "$.verification")}


def merge_calculations(base: Column, extra: Column) -> Column:
    """Found lists override the ones already there."""
    return F.when(F.size(extra) > 0, extra).otherwise(base)


#: The sentences of a summary without a model.
def fallback_summary(segment_type: Column, x_label: Column, y_label: Column, caption: Column) -> Column:
    start = F.when(segment_type == "chart", "This chart displays").when(segment_type == "diagram", "This diagram illustrates a system or process").when(segment_type == "flowchart", "This flowchart shows a sequential process").otherwise(F.concat(F.lit("This "), segment_type))
    axes = F.when((segment_type == "chart") & x_label.isNotNull() & y_label.isNotNull(), F.concat(y_label, F.lit(" versus "), x_label))
    return F.concat_ws(". ", start, axes, F.when(F.coalesce(caption, F.lit("")) != "", F.concat(F.lit("Caption: "), F.substring(caption, 1, 100))))


def segment_id(book: Column, page: Column, image: Column) -> Column:
    """Book, 0-based page and the first eight hex digits of the image's md5."""
    return F.format_string("%s_p%03d_%s", book, page, F.substring(F.md5(image), 1, 8))
