"""Text in pictures: a table function around an injected reader, and rasters or files for it."""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import DataFrame
from pyspark.sql.functions import udtf
from pyspark.sql.types import DoubleType, IntegerType, StringType, StructType
from pyspark.sql.udtf import AnalyzeArgument, AnalyzeResult

#: What a reader finds in a picture: corner points, text, and a score up to 1.
Found = Iterable[tuple[list[tuple[float, float]], str, float]]


def ocr_table(make: Callable[[], Callable[[bytes], Found]]):
    """A table function picture -> (idx, text, x0, y0, x1, y1, confidence): one reader a worker, made at its first picture.

    A polygon becomes the box around it, a score percent. A picture that is null or that the reader fails on has no
    rows, nor has a finding without points or with blank text; the others keep the reader's order.
    """
    held: list = []

    class Reading:
        @staticmethod
        def analyze(picture: AnalyzeArgument) -> AnalyzeResult:
            if picture.dataType.typeName() not in ("binary", "void"):
                raise Exception(f"a picture is binary, not {picture.dataType.simpleString()}")
            schema = StructType().add("idx", IntegerType()).add("text", StringType())
            for name in ("x0", "y0", "x1", "y1", "confidence"):
                schema = schema.add(name, DoubleType())
            return AnalyzeResult(schema)

        def eval(self, picture):
            if picture is None:
                return
            try:
                if not held:
                    held.append(make())
                found = list(held[0](bytes(picture)))
            except Exception:  # noqa: BLE001  (a picture that can't be read has no text)
                return
            idx = 0
            for points, text, score in found:
                if not len(points) or not (text or "").strip():
                    continue
                xs, ys = zip(*points, strict=True)
                yield idx, text, float(min(xs)), float(min(ys)), float(max(xs)), float(max(ys)), float(score) * 100
                idx += 1

    return udtf(Reading)


def read_text(pictures: DataFrame, make: Callable[[], Callable[[bytes], Found]]) -> DataFrame:
    """(segment_id, idx, text, x0, y0, x1, y1, confidence) of pictures (segment_id, image)."""
    spark = pictures.sparkSession
    spark.udtf.register("read_picture", ocr_table(make))
    return spark.sql("select p.segment_id, t.* from {pictures} p, lateral read_picture(p.image) t", pictures=pictures.select("segment_id", "image"))
