"""Sinks: nested JSON of a book, and the nine-column summary CSV."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Columns of the summary file, in order.
SUMMARY = ["segment_id", "page", "type", "confidence", "figure_number", "caption", "ocr_text", "linked_concepts", "summary"]


def summary_rows(segments: DataFrame) -> DataFrame:
    """Segments as summary rows; texts are cut to 100 characters, confidence has two decimals."""
    short = {c: F.substring(F.coalesce(c, F.lit("")), 1, 100) for c in ("caption", "ocr_text", "summary")}
    return segments.withColumns(short | {"figure_number": F.coalesce("figure_number", F.lit("")), "confidence": F.format_string("%.2f", "confidence")}).select(*SUMMARY)


def write_summary(segments: DataFrame, path: str) -> None:
    summary_rows(segments).write.mode("overwrite").option("header", True).option("quote", '"').option("escape", '"').csv(path)


def read_summary(spark, path: str) -> DataFrame:
    return spark.read.option("header", True).option("multiLine", True).option("quote", '"').option("escape", '"').csv(path)


def book_json(segments: DataFrame, book_id: Column) -> DataFrame:
    """One line a segment inside its book's folder: a book is never gathered into one value."""
    return segments.select(book_id.alias("book_id"), F.to_json(F.struct(*segments.columns)).alias("segment"))


def book_envelopes(segments: DataFrame, book: str = "book_id", path: str = "pdf_path", order: str = "place") -> DataFrame:
    """(book_id, json): a book's file, with its path, the count and the segments in order; a book has hundreds of them at most."""
    names = [c for c in segments.columns if c not in (path, order)]
    items = F.transform(F.array_sort(F.collect_list(F.struct(order, F.struct(*names).alias("segment")))), lambda s: s["segment"])
    rows = segments.groupBy(book).agg(F.first(path).alias(path), items.alias("segments"))
    return rows.select(book, F.to_json(F.struct(book, path, F.size("segments").alias("total_segments"), "segments")).alias("json"))


def write_envelopes(envelopes: DataFrame, path: str, book: str = "book_id") -> None:
    """One text file a book below ``path``/book_id=..."""
    envelopes.write.mode("overwrite").partitionBy(book).text(path)


def image_base64(image: Column) -> Column:
    return F.base64(image)
