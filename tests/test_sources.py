"""Readers, the image sink and the reading table function, with failing tasks, restarts and broken input."""

import json
import os
import sys

import pytest
from pyspark import cloudpickle
from pyspark.sql import functions as F

from glyphgrid.operators import reading
from glyphgrid.sources import layout_source, png_sink

cloudpickle.register_pickle_by_value(sys.modules[__name__])  # workers don't import tests


def page(doc: int, no: int) -> dict:
    return {
        "blocks": [[[{"text": f"d{doc}p{no}", "size": 9, "box": [0, 1, 2, 3]}, {"text": "é", "box": [2, 1, 3, 3]}], []], [[{"text": "second", "size": 12.5, "box": [0, 5, 1, 6]}]]],
        "drawings": [[1, 2, 3, 4]] * (no % 3),
        "images": [{"width": 4, "height": 2, "data": "00ff", "rects": [[0, 0, 1, 1], [5, 5, 6, 6]]}] if no % 2 else [],
    }


def write(folder, doc: int, pages: int) -> None:
    lines = [json.dumps(page(doc, n), ensure_ascii=False) for n in range(pages)]
    if pages > 2:
        lines[2] = "{broken"
    (folder / f"doc{doc:03d}.jsonl").write_text("\n".join(lines) + ("\n" if doc % 2 and lines else ""), encoding="utf-8")


@pytest.fixture
def folder(tmp_path):
    for doc, pages in ((1, 7), (2, 1), (3, 0)):
        write(tmp_path, doc, pages)
    (tmp_path / "other.txt").write_text("no document")
    return tmp_path


def test_reader_splits_documents(spark, folder):
    for kind in ("spans", "drawings", "images"):
        spark.dataSource.register(layout_source.layout_source(layout_source.JsonPages(), kind))
    read = lambda kind: spark.read.format(f"layout_{kind}").option("pages", 2).load(str(folder))
    spans = read("spans")
    assert spans.rdd.getNumPartitions() == 5  # four of seven pages by twos, one of one page
    want = [(f"doc{d:03d}", p) for d, n in ((1, 7), (2, 1)) for p in range(n) if p != 2]
    assert sorted((r.doc_id, r.page_no) for r in spans.where("block_no = 1").collect()) == want
    assert {r.text for r in spans.where("span_no = 0 and block_no = 0").collect()} == {f"d{d[-1]}p{p}" for d, p in want}
    assert read("drawings").count() == sum(p % 3 for _, p in want)
    images = read("images").collect()
    assert sorted((r.page_no, r.rect_no) for r in images) == [(p, r) for p in (1, 3, 5) for r in (0, 1)] and {bytes(r.data) for r in images} == {b"\x00\xff"}
    chosen = spark.read.format("layout_spans").option("paths", str(folder / "doc002.jsonl")).load()
    assert {r.doc_id for r in chosen.collect()} == {"doc002"}


def test_streaming_reader_goes_on_after_a_restart(spark, folder, tmp_path_factory):
    spark.dataSource.register(layout_source.layout_source(layout_source.JsonPages(), "spans", "paged_spans"))
    out, state = (str(tmp_path_factory.mktemp(n)) for n in ("out", "state"))

    def run() -> int:
        rows = spark.readStream.format("paged_spans").option("per_batch", 1).load(str(folder))
        query = rows.writeStream.format("parquet").option("checkpointLocation", state).trigger(processingTime="0 seconds").start(out)
        query.processAllAvailable()
        query.stop()
        return spark.read.parquet(out).where("block_no = 1").count()

    assert run() == 7
    write(folder, 4, 2)
    write(folder, 5, 1)
    assert run() == 10 and run() == 10
    rows = spark.read.parquet(out).groupBy("doc_id", "page_no", "block_no", "span_no").count()
    assert rows.where("count > 1").count() == 0


def pngs(spark, n: int, fail: int | None = None):
    rows = spark.range(n).repartition(4).select(F.concat(F.lit("seg/"), F.col("id")).alias("segment_id"), F.col("id").cast("string").cast("binary").alias("png"), F.lit(1).alias("more"))
    if fail is not None:
        rows = rows.withColumn("png", F.when(F.col("segment_id") == f"seg/{fail}", F.raise_error(F.lit("this task fails")).cast("binary")).otherwise(F.col("png")))
    return rows


def files(folder) -> dict:
    return {os.path.relpath(os.path.join(at, f), folder): open(os.path.join(at, f), "rb").read() for at, _, names in os.walk(folder) for f in names}


def test_png_sink(spark, tmp_path):
    spark.dataSource.register(png_sink.PngSink)
    target = str(tmp_path / "images")
    save = lambda df, mode="append": df.write.format("segment_png").mode(mode).save(target)
    save(pngs(spark, 20))
    want = {f"seg%002f{i}.png": str(i).encode() for i in range(20)}
    assert files(target) == want
    with pytest.raises(Exception, match="this task fails"):
        save(pngs(spark, 40, fail=33))
    assert files(target) == want and not os.path.exists(f"{target}/_staging")
    save(spark.createDataFrame([("a", None), (None, b"x"), ("..", b"y")], "segment_id string, png binary"))
    assert files(target) == want | {"...png": b"y"}
    save(pngs(spark, 3), "overwrite")
    assert files(target) == {k: want[k] for k in list(want)[:3]}
    with pytest.raises(Exception, match="columns are missing"):
        save(spark.range(1))


class Reader:
    made = 0

    def __call__(self, picture: bytes):
        if picture == b"broken":
            raise ValueError("no picture")
        return [([(3, 4), (1, 9), (5, 2)], "text", 0.5), ([], "no place", 0.9), ([(0, 0)], "  ", 0.9), ([(0, 0)], "dot", 1)] * (1 + len(picture))


def test_reading(spark):
    frame = spark.createDataFrame([(1, b""), (2, b"x"), (3, b"broken"), (4, None)], "segment_id long, image binary")
    got = sorted(tuple(r) for r in reading.read_text(frame, Reader).collect())
    line = lambda s, i: [(s, 2 * i, "text", 1.0, 2.0, 5.0, 9.0, 50.0), (s, 2 * i + 1, "dot", 0.0, 0.0, 0.0, 0.0, 100.0)]
    assert got == line(1, 0) + line(2, 0) + line(2, 1)
    with pytest.raises(Exception, match="a picture is binary"):
        reading.read_text(frame.withColumn("image", F.lit("text")), Reader).collect()


def test_a_reader_that_cannot_be_made_reads_nothing(spark):
    def make():
        raise OSError("no weights")

    assert reading.read_text(spark.createDataFrame([(1, b"x")], "segment_id long, image binary"), make).count() == 0
