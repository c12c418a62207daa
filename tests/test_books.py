"""Keyed state of books: repeated and late rows, a restart, expired ids, and the same ids as by looking them up."""

import pytest
from pyspark.sql import functions as F

from glyphgrid.streaming import append, books

SCHEMA = "book_id string, segment_id string, page long"
pytest.importorskip("pyspark.sql.streaming.stateful_processor")


def test_books(spark, tmp_path):
    source, target, looked, state = (str(tmp_path / n) for n in ("in", "out", "looked", "state"))
    batches = [
        [("a", "s1", 1), ("a", "s2", 2), ("b", "s1", 1), ("a", "s1", 1), (None, "s9", 1), ("a", None, 1)],
        [("a", "s2", 2), ("a", "s3", None), ("b", "s4", 9)],
        [("b", "s1", 1), ("c", "s1", 3)],
    ]
    for batch in batches:
        spark.createDataFrame(batch, SCHEMA).coalesce(1).write.mode("append").parquet(source)
        query = books.stream_books(spark, source, SCHEMA, target, state)  # each batch is a restart
        query.awaitTermination(120)
        assert not query.isActive
    rows = spark.read.parquet(target).collect()
    assert sorted((r.book_id, r.place) for r in rows) == [("a", 1), ("a", 2), ("a", 3), ("b", 1), ("b", 2), ("c", 1)]
    assert {(r.book_id, r.segment_id, r.page) for r in rows} == {("a", "s1", 1), ("a", "s2", 2), ("a", "s3", None), ("b", "s1", 1), ("b", "s4", 9), ("c", "s1", 3)}
    key = F.concat_ws("/", "book_id", "segment_id")
    for batch in batches:
        held = spark.createDataFrame(batch, SCHEMA).where("book_id is not null and segment_id is not null").withColumn("key", key)
        append.append_new(held, looked, "key")
    assert {r.key for r in spark.read.parquet(looked).collect()} == {f"{r.book_id}/{r.segment_id}" for r in rows}


def test_ids_expire(spark, tmp_path):
    source, target, state = (str(tmp_path / n) for n in ("in", "out", "state"))
    for _ in range(2):
        spark.createDataFrame([("a", "s1", 1)], SCHEMA).coalesce(1).write.mode("append").parquet(source)
        books.stream_books(spark, source, SCHEMA, target, state, keep_ms=1).awaitTermination(120)
    assert sorted(r.place for r in spark.read.parquet(target).collect()) == [1, 2]
