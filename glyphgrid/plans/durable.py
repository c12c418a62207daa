"""Cutting lineage: reliable checkpoints, and tables written to the folder that all executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Bytes of Parquet files up to which a stored table is broadcast.
BROADCAST_BYTES = 16 << 20


def shared_folder(spark: SparkSession) -> str:
    """The folder of ``spark.checkpoint.dir``; where that is unset, a temporary one in local mode only."""
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        folder = spark.conf.get("spark.checkpoint.dir", None)
        if not folder and not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        context.setCheckpointDir(folder or tempfile.mkdtemp(prefix="checkpoints"))
    return spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()


def cut(df: DataFrame) -> DataFrame:
    """A checkpoint in the shared folder."""
    shared_folder(df.sparkSession)
    return df.checkpoint(eager=True)


class Stored:
    """A table written once to the shared folder, with its size, so that many parts of a plan can read it.

    ``side`` is the table for a join: broadcast while its files take ``BROADCAST_BYTES`` at most, else shuffled.
    """

    def __init__(self, df: DataFrame):
        spark = df.sparkSession
        self.path = f"{shared_folder(spark)}/stored-{uuid.uuid4().hex}"
        df.write.parquet(self.path)
        self.table = spark.read.schema(df.schema).parquet(self.path)
        path = spark._jvm.org.apache.hadoop.fs.Path(self.path)
        self.bytes = path.getFileSystem(spark._jsc.hadoopConfiguration()).getContentSummary(path).getLength()

    def side(self, *columns: str) -> DataFrame:
        table = self.table.select(*columns) if columns else self.table
        return F.broadcast(table) if self.bytes <= BROADCAST_BYTES else table
