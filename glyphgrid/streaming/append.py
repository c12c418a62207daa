"""Incremental append of segments: each segment_id is written once, whatever is read again."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery


def append_new(batch: DataFrame, target: str, id_column: str = "segment_id") -> None:
    """Append the rows whose id the target doesn't hold yet, one for each id; only the ids of the target are read."""
    spark = batch.sparkSession
    fresh = batch.dropDuplicates([id_column])
    folder = spark._jvm.org.apache.hadoop.fs.Path(target)
    if folder.getFileSystem(spark._jsc.hadoopConfiguration()).exists(folder):
        fresh = fresh.join(spark.read.schema(batch.schema).parquet(target).select(id_column), id_column, "left_anti").select(*batch.columns)
    fresh.write.mode("append").parquet(target)


def stream_segments(spark: SparkSession, source: str, schema: str, target: str, checkpoint: str, id_column: str = "segment_id") -> StreamingQuery:
    """Start a query that appends new rows of Parquet files under ``source`` to ``target``, and ends when all is read.

    What was seen is looked up in the target, so the query keeps no state of its own
    and a new checkpoint, or a batch that runs again, writes nothing twice.
    """
    rows = spark.readStream.schema(schema).parquet(source)
    return rows.writeStream.foreachBatch(lambda batch, _: append_new(batch, target, id_column)).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def windowed_counts(events: DataFrame, late: str = "10 minutes", width: str = "1 hour") -> DataFrame:
    """Events by type and hour, with late rows up to ``late``; the same on a stream and on a table."""
    return events.withWatermark("ts", late).groupBy(F.window("ts", width), "event_type").agg(F.count(F.lit(1)).alias("n"), F.sum("value").alias("total"))
