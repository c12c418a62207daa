"""Layout readers: flat Parquet tables, and Python data sources that parse documents by page ranges, in batches or as a stream.

A parser is an object with ``pages(path)``, the number of a document's pages, and ``rows(path, kind, first, last)``, the
rows of one table from page ``first`` up to ``last``. ``JsonPages`` reads documents stored as one JSON object a page;
other formats bring a parser of their own.
"""

from __future__ import annotations

import json
import sys
from collections.abc import Iterator
from dataclasses import dataclass
from typing import Protocol

from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition

from glyphgrid.sources.png_sink import file_system

SCHEMAS = {
    "spans": "doc_id string, page_no long, block_no int, line_no int, span_no int, text string, size double, x0 double, y0 double, x1 double, y1 double",
    "drawings": "doc_id string, page_no long, draw_no int, x0 double, y0 double, x1 double, y1 double",
    "images": "doc_id string, page_no long, img_no int, rect_no int, x0 double, y0 double, x1 double, y1 double, px_w int, px_h int, data binary",
    "taxonomy": "idx int, level int, concept string, tags string, pages string",
}


def read_table(spark: SparkSession, path: str, kind: str) -> DataFrame:
    """A layout table from Parquet, or a taxonomy from CSV, with the fixed schema."""
    reader = spark.read.schema(SCHEMAS[kind])
    return reader.option("header", True).option("multiLine", True).option("escape", '"').csv(path) if path.endswith(".csv") else reader.parquet(path)


class Parser(Protocol):
    def pages(self, path: str) -> int: ...

    def rows(self, path: str, kind: str, first: int, last: int) -> Iterator[tuple]: ...


class JsonPages:
    """Documents of one JSON object a line and page: {"blocks": [[[span, ...] lines] blocks], "drawings": [box], "images": [{"rects": [box], ...}]}.

    A span is {"text", "size", "box"}, a box [x0, y0, x1, y1]; an image has "width", "height" and "data" (hexadecimal).
    The document's id is its file's name without the suffix. A page that is no JSON object has no rows.
    """

    suffix = ".jsonl"

    def _lines(self, path: str) -> Iterator[tuple[int, dict]]:
        system, inner = file_system(path)
        with system.open_input_stream(inner) as file:
            page, rest = 0, b""
            while chunk := file.read(1 << 20):
                *whole, rest = (rest + chunk).split(b"\n")
                for line in whole:
                    yield page, line
                    page += 1
            if rest:
                yield page, rest

    def pages(self, path: str) -> int:
        return sum(1 for _ in self._lines(path))

    def rows(self, path: str, kind: str, first: int, last: int) -> Iterator[tuple]:
        doc = path.rsplit("/", 1)[-1].removesuffix(self.suffix)
        for page, line in self._lines(path):
            if page >= last:
                return
            if page < first:
                continue
            try:
                held = json.loads(line)
            except ValueError:
                continue
            if isinstance(held, dict):
                yield from getattr(self, f"_{kind}")(doc, page, held)

    def _spans(self, doc, page, held):
        for b, block in enumerate(held.get("blocks", [])):
            for n, line in enumerate(block):
                for s, span in enumerate(line):
                    yield (doc, page, b, n, s, span["text"], float(span.get("size", 0)), *map(float, span["box"]))

    def _drawings(self, doc, page, held):
        for n, box in enumerate(held.get("drawings", [])):
            yield (doc, page, n, *map(float, box))

    def _images(self, doc, page, held):
        for n, image in enumerate(held.get("images", [])):
            data = bytes.fromhex(image.get("data", ""))
            for r, box in enumerate(image.get("rects", [])):  # a picture can stand in several places
                yield (doc, page, n, r, *map(float, box), image.get("width"), image.get("height"), data)


@dataclass
class PageRange(InputPartition):
    path: str
    first: int
    last: int


def documents(folder: str, suffix: str) -> list[str]:
    """Paths of a folder's documents, by name."""
    system, inner = file_system(folder)
    prefix = folder.rstrip("/")
    return sorted(f"{prefix}/{i.base_name}" for i in system.get_file_info(fs.FileSelector(inner)) if i.type == fs.FileType.File and i.base_name.endswith(suffix))


def layout_source(parser: Parser, kind: str, source_name: str | None = None) -> type[DataSource]:
    """A registrable source of one table, for ``load(folder)`` or the option ``paths``.

    A partition is a document, or ``pages`` pages of one where that option is given; only then are documents opened
    to count their pages before they are read, which suits few long ones.

    As a stream it reads documents as they come: an offset is the name of the last one read, in the order of names, so
    new documents need names after those before (a date, a running number). ``per_batch`` bounds a batch's documents.
    """

    def ranges(paths: list[str], size: int) -> list[PageRange]:
        if not size:
            return [PageRange(p, 0, sys.maxsize) for p in paths]
        return [PageRange(p, a, min(a + size, n)) for p in paths for n in [parser.pages(p)] for a in range(0, n, size)]

    class Reader(DataSourceReader):
        def __init__(self, paths: list[str], size: int):
            self.paths, self.size = paths, size

        def partitions(self):
            return ranges(self.paths, self.size) or [PageRange("", 0, 0)]

        def read(self, partition):
            if partition.path:
                yield from parser.rows(partition.path, kind, partition.first, partition.last)

    class StreamReader(DataSourceStreamReader):
        def __init__(self, folder: str, size: int, most: int):
            self.folder, self.size, self.most = folder, size, most
            self.last = ""

        def initialOffset(self) -> dict:
            return {"after": ""}

        def latestOffset(self) -> dict:
            fresh = [p for p in documents(self.folder, parser.suffix) if p > self.last]
            return {"after": fresh[: self.most][-1] if fresh else self.last}

        def partitions(self, start: dict, end: dict):
            self.last = end["after"]
            return ranges([p for p in documents(self.folder, parser.suffix) if start["after"] < p <= end["after"]], self.size) or [PageRange("", 0, 0)]

        def read(self, partition):
            if partition.path:
                yield from parser.rows(partition.path, kind, partition.first, partition.last)

        def commit(self, end: dict) -> None:
            self.last = max(self.last, end["after"])

    class Source(DataSource):
        @classmethod
        def name(cls) -> str:
            return source_name or f"layout_{kind}"

        def schema(self) -> str:
            return SCHEMAS[kind]

        def _size(self) -> int:
            return int(self.options.get("pages", 0))

        def reader(self, schema):
            listed = [p for p in self.options.get("paths", "").split(",") if p]
            return Reader(listed or documents(self.options["path"], parser.suffix), self._size())

        def streamReader(self, schema):
            return StreamReader(self.options["path"], self._size(), int(self.options.get("per_batch", 1000)))

    return Source
