"""Segments of a stream kept once each, with running envelopes of their books, in keyed state.

A book's state holds its count of segments and the ids seen. Ids expire ``keep`` after they were seen last, by
processing time, so state does not grow with the stream; a row that comes back later than that counts again, where
``append.append_new`` looks ids up in the target for ever.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
OUT = "book_id string, segment_id string, page long, place long"


class Books(StatefulProcessor):
    """Passes each new segment on with its place in its book, from 1 in the order of arrival."""

    def __init__(self, keep_ms: int):
        self.keep_ms = keep_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.count = handle.getValueState("count", "n long")
        self.seen = handle.getMapState("seen", "segment_id string", "page long", self.keep_ms)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        n = self.count.get()[0] if self.count.exists() else 0
        out = []
        for batch in rows:
            for segment, page in zip(batch["segment_id"], batch["page"], strict=True):
                if segment is None or pd.isna(segment):
                    continue
                page = None if pd.isna(page) else int(page)
                fresh = not self.seen.containsKey((segment,))
                self.seen.updateValue((segment,), (page if page is not None else -1,))  # seen again: kept longer
                if fresh:
                    n += 1
                    out.append((key[0], segment, page, n))
        self.count.update((n,))
        if out:
            yield pd.DataFrame(out, columns=["book_id", "segment_id", "page", "place"]).astype({"page": "Int64"})

    def close(self) -> None:
        pass


def numbered(segments: DataFrame, keep_ms: int = 7 * 24 * 3600 * 1000) -> DataFrame:
    """(book_id, segment_id, page, place) of a stream's segments (book_id, segment_id, page), each id of a book once.

    Rows with a null id or book are left out. Needs the state store ``ROCKS``.
    """
    rows = segments.selectExpr("book_id", "segment_id", "cast(page as long) as page").where("book_id is not null and segment_id is not null")
    return rows.groupBy("book_id").transformWithStateInPandas(Books(keep_ms), OUT, "Append", "ProcessingTime")


def stream_books(spark: SparkSession, source: str, schema: str, target: str, checkpoint: str, keep_ms: int = 7 * 24 * 3600 * 1000) -> StreamingQuery:
    """Start a query that appends numbered segments of Parquet files under ``source`` to ``target``, and ends when all is read."""
    # expiring state asks for batches without rows again and again, so the query would never end
    own = {"spark.sql.streaming.stateStore.providerClass": ROCKS, "spark.sql.streaming.noDataMicroBatches.enabled": "false"}
    before = {name: spark.conf.get(name, None) for name in own}
    for name, value in own.items():
        spark.conf.set(name, value)
    try:
        rows = spark.readStream.schema(schema).parquet(source)
        return numbered(rows, keep_ms).writeStream.format("parquet").option("checkpointLocation", checkpoint).trigger(availableNow=True).start(target)
    finally:  # a query keeps the settings it started with
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)
