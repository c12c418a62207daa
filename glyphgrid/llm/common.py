"""Shared helpers: table access, durable cuts of lineage, Arrow text batches."""

from __future__ import annotations

import os
import tempfile
import uuid
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: UTF-8 bytes of text that one Arrow slice holds; a single longer text is a slice of its own.
SLICE_BYTES = 8 << 20


def workers_find_package(spark: SparkSession) -> None:
    """Let Python workers import this package where it is on the driver's path only by its folder."""
    root = str(Path(__file__).resolve().parents[2])
    environment = spark.sparkContext.environment
    known = environment.get("PYTHONPATH", "")
    if root not in known.split(os.pathsep):
        environment["PYTHONPATH"] = os.pathsep.join(filter(None, [root, known]))


_held: dict = {}


def held(make, *options):
    """What a worker holds from task to task, made by ``make(*options)``: one thing at a time.

    Workers serve all stages of a session, so memos of different operators would add up in each of them.
    """
    key = (make, *options)
    if key not in _held:
        _held.clear()
        pa.default_memory_pool().release_unused()
        _held[key] = make(*options)
    return _held[key]


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    workers_find_package(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def crc_mod(column: str, modulus: int) -> Column:
    """crc32 of a key written as text, modulo ``modulus``: the split rule of the contracts."""
    return F.crc32(F.col(column).cast("string").cast("binary")) % F.lit(modulus)


def shared_folder(spark: SparkSession) -> str:
    """The cluster's shared folder: ``spark.checkpoint.dir``, or a temporary one where it is unset in local mode, as in tests."""
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        folder = spark.conf.get("spark.checkpoint.dir", None)
        if not folder and not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        context.setCheckpointDir(folder or tempfile.mkdtemp(prefix="checkpoints"))
    return spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()


def cut(df: DataFrame) -> DataFrame:
    """Cut lineage with a reliable checkpoint in the shared folder."""
    shared_folder(df.sparkSession)
    return df.checkpoint(eager=True)


class Scratch:
    """Tables written below the shared folder to cut lineage, deleted when they are no longer needed.

    ``close`` (or the end of a ``with``) deletes all but those marked ``keep``, which a lazy result still reads.
    """

    def __init__(self, spark: SparkSession):
        self.spark, self.folder = spark, f"{shared_folder(spark)}/scratch-{uuid.uuid4().hex}"
        self.made: list[str] = []

    def table(self, df: DataFrame, keep: bool = False) -> DataFrame:
        path = f"{self.folder}/{uuid.uuid4().hex}"
        df.write.parquet(path)
        if not keep:
            self.made.append(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def _delete(self, path: str) -> None:
        target = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        target.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(target, True)
        self.made.remove(path)

    def drop(self, df: DataFrame) -> None:
        """Delete the tables that ``df`` reads directly."""
        read = {f.split("/scratch-", 1)[-1] for f in df.inputFiles()}
        for path in list(self.made):
            if any(f.startswith(path.split("/scratch-", 1)[-1] + "/") for f in read):
                self._delete(path)

    def close(self) -> None:
        for path in list(self.made):
            self._delete(path)

    def __enter__(self) -> Scratch:
        return self

    def __exit__(self, *_) -> None:
        self.close()


def plain_names(df: DataFrame, *names: str) -> DataFrame:
    """Only the named columns: extra ones can't clash with an operator's own."""
    return df.select(*[F.col(f"`{n}`") for n in names])


def text_slices(batches, text_column: str = "text", limit: int = SLICE_BYTES, most: int = 1 << 30):
    """Arrow batches cut so that each holds about ``limit`` bytes of text and ``most`` rows at most, whole rows only."""
    for batch in batches:
        if not batch.num_rows:
            continue
        column = batch.column(batch.schema.get_field_index(text_column))
        sizes = pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False)
        share = np.cumsum(sizes) // limit
        starts = np.flatnonzero(np.diff(share, prepend=-1) | (np.arange(batch.num_rows) % most == 0))
        for a, b in zip(starts, [*starts[1:], batch.num_rows], strict=True):
            yield batch.slice(a, b - a)


def column(batch: pa.RecordBatch, name: str) -> pa.Array:
    return batch.column(batch.schema.get_field_index(name))


def list_parts(lists) -> tuple[pa.Array, np.ndarray]:
    """Flat values of a list array and each row's offsets into them."""
    offsets = lists.offsets.to_numpy(zero_copy_only=False).astype(np.int64)
    return lists.flatten(), offsets - offsets[0]


def segment_sums(values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Sums of values[offsets[i]:offsets[i+1]]; empty segments give 0."""
    total = np.zeros((len(values) + 1, *values.shape[1:]), dtype=np.int64 if values.dtype.kind in "iu" else np.float64)
    np.cumsum(values, axis=0, out=total[1:])
    return total[offsets[1:]] - total[offsets[:-1]]


def mix64(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser over uint64 arrays: xor-shifts and odd multipliers."""
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0x9E3779B97F4A7C15)
    x = x ^ (x >> np.uint64(29))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))
