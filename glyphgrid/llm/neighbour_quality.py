"""Quality scores by nearest-neighbour voting over latent-semantic vectors.

A text becomes hashed counts of its words' letters, of the shapes of its
white-space pieces ("Aa", "a,", "A!!") and of coarse text-level marks (length,
share of distinct words, of the commonest word, of words equal to the one before,
and of repeated lines). Counts are
damped, weighted by inverse document frequency over the labelled sample, and
projected on its leading singular directions. The labelled vectors are
broadcast; every text's cosine with each of them comes from exact blocked
products, and its ``neighbours`` nearest vote with weight cosine ** ``power``.

At most ``sample_rows`` labelled texts are taken, picked by a hash of the id:
that documented bound fixes the broadcast (sample_rows x rank floats).

Defined results: null and empty texts are the zero vector and get the sample's
share of label 1, as does any text without a positive cosine; ties in nearness
go to the sample's order by id; several labels of one id count once each; with
no labelled row every score is 0.5; repeated rows each get their own row; very long
texts are slices of their own; an empty table gives no row; only the columns named
are read, so others can't clash.
"""

from __future__ import annotations

import functools
import re
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common

BUCKETS = 2048
SAMPLE_RANGE = 1 << 20
#: Rows of a slice: each takes a row of BUCKETS counts.
ROWS = 500
MEMO = 100_000
_RUNS = re.compile(r"(.)\1+")


@functools.lru_cache(maxsize=1)
def shape_table() -> dict[int, str]:
    """Characters to shape classes; those not listed are looked up as letters or others."""

    class Table(dict):
        def __missing__(self, point: int) -> str:
            c = chr(point)
            self[point] = kind = "A" if c.isupper() else "a" if c.isalpha() else "0" if c.isdigit() else c if point < 128 else "?"
            return kind

    return Table()


def piece_buckets(piece: str) -> tuple[int, int]:
    """Buckets of a piece's shape and of its letters."""
    shape = _RUNS.sub(r"\1", piece[:64].translate(shape_table()))
    word = "".join(filter(str.isalpha, piece.lower()))
    return zlib.crc32(shape.encode()) % 512, 512 + zlib.crc32(word.encode()) % (BUCKETS - 640)


class Features:
    """Feature rows of Arrow text slices; buckets of pieces stay in a bounded memo."""

    def __init__(self):
        self.memo: dict[str, tuple[int, int]] = {}

    def rows(self, texts: pa.Array) -> np.ndarray:
        values, offsets = common.list_parts(pc.utf8_split_whitespace(texts))
        coded = values.dictionary_encode()
        pieces = coded.dictionary.to_pylist()
        if len(self.memo) > MEMO:
            self.memo.clear()
        found = list(map(self.memo.get, pieces))
        for i, pair in enumerate(found):
            if pair is None:
                found[i] = self.memo[pieces[i]] = piece_buckets(pieces[i])
        buckets = np.array(found, dtype=np.int64).reshape(-1, 2)
        codes = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        n = len(texts)
        sizes = np.diff(offsets)
        owner = np.repeat(np.arange(n), sizes)
        out = np.zeros((n, BUCKETS), dtype=np.float32)
        for column in (0, 1):
            out += np.bincount(owner * BUCKETS + buckets[codes, column], minlength=n * BUCKETS).reshape(n, BUCKETS)
        out = np.log1p(out)
        # text-level marks, each a bucket of its own with a fixed count
        pairs, times = np.unique(owner * max(len(pieces), 1) + codes, return_counts=True)
        holder = pairs // max(len(pieces), 1)
        distinct = np.bincount(holder, minlength=n)
        most = np.zeros(n)
        np.maximum.at(most, holder, times)
        safe = np.maximum(sizes, 1)
        marks = [np.minimum(np.log2(safe), 15).astype(int), 16 + (distinct * 15 // safe), 32 + (most * 15 // safe).astype(int), 48 + self._line_marks(texts), 64 + (np.bincount(owner[1:][(codes[1:] == codes[:-1]) & (owner[1:] == owner[:-1])], minlength=n) * 15 // safe)]
        for mark in marks:
            out[np.arange(n), BUCKETS - 128 + mark] += 2.0
        out[pc.equal(pc.utf8_trim_whitespace(texts), "").to_numpy(zero_copy_only=False)] = 0
        return out

    @staticmethod
    def _line_marks(texts: pa.Array) -> np.ndarray:
        """Sixteenths of a text's lines that equal an earlier one."""
        lines, offsets = common.list_parts(pc.split_pattern(texts, "\n"))
        codes = lines.dictionary_encode().indices.to_numpy(zero_copy_only=False).astype(np.int64)
        sizes = np.diff(offsets)
        owner = np.repeat(np.arange(len(texts)), sizes)
        distinct = np.bincount(np.unique(owner * (len(codes) + 1) + codes) // (len(codes) + 1), minlength=len(texts))
        return (sizes - distinct) * 15 // np.maximum(sizes, 1)


def worker_features() -> Features:
    return common.held(Features)


class Voters:
    """Labelled latent-semantic vectors and the projection of others to their space."""

    def __init__(self, counts: np.ndarray, labels: np.ndarray, rank: int, neighbours: int, power: float, ids: list | None = None):
        self.neighbours, self.power = neighbours, power
        self.places: dict = {}
        for i, key in enumerate(ids or ()):
            self.places.setdefault(key, []).append(i)
        self.base = float(labels.mean())
        self.labels = labels.astype(np.float32)
        n = len(counts)
        self.idf = (np.log((1 + n) / (1 + (counts > 0).sum(axis=0))) + 1).astype(np.float32)
        weighted = self._unit(counts * self.idf)
        rng = np.random.default_rng(7)
        probe = weighted @ rng.standard_normal((BUCKETS, rank + 16)).astype(np.float32)
        for _ in range(4):  # power iterations of the randomised range finder
            probe, _ = np.linalg.qr(weighted @ (weighted.T @ probe))
        _, _, directions = np.linalg.svd(probe.T @ weighted, full_matrices=False)
        self.directions = directions[:rank].T.astype(np.float32)
        self.vectors = self._unit(weighted @ self.directions)

    @staticmethod
    def _unit(rows: np.ndarray) -> np.ndarray:
        norms = np.linalg.norm(rows, axis=1, keepdims=True)
        return rows / np.where(norms > 0, norms, 1)

    def scores(self, counts: np.ndarray, ids: list | None = None) -> np.ndarray:
        """Scores of feature rows; rows whose ids are given get no vote of their own labels."""
        out = np.empty(len(counts))
        k = min(self.neighbours, len(self.labels))
        for low in range(0, len(counts), 512):
            rows = self._unit(self._unit(counts[low : low + 512] * self.idf) @ self.directions)
            cosines = rows @ self.vectors.T
            for i, key in enumerate(ids[low : low + 512] if ids else ()):
                cosines[i, self.places.get(key, ())] = -1
            near = np.argpartition(-cosines, k - 1, axis=1)[:, :k]
            least = np.take_along_axis(cosines, near, axis=1).min(axis=1, keepdims=True)
            # where more are as near as the last one than there are places, those first in the sample stay
            for i in np.flatnonzero((cosines >= least).sum(axis=1) > k):
                over, ties = np.flatnonzero(cosines[i] > least[i]), np.flatnonzero(cosines[i] == least[i])
                near[i] = np.concatenate([over, ties[: k - len(over)]])
            weight = np.maximum(np.take_along_axis(cosines, near, axis=1), 0).astype(np.float64) ** self.power
            total = weight.sum(axis=1)
            out[low : low + 512] = np.where(total > 0, (weight * self.labels[near]).sum(axis=1) / np.where(total > 0, total, 1), self.base)
        return np.clip(out, 0.0, 1.0)


def fit(documents: DataFrame, labels: DataFrame, sample_rows: int = 6000, rank: int = 64, neighbours: int = 25, power: float = 4.0, id_column: str = "doc_id", label_column: str = "quality"):
    """Broadcast voters from labelled texts, or None where there are none."""
    texts = common.plain_names(documents, id_column, "text").toDF("id", "text")
    marked = common.plain_names(labels, id_column, label_column).toDF("id", "label").where("id is not null and label is not null").distinct()
    total = marked.count()
    if not total:
        return None
    draw = F.pmod(F.xxhash64(F.col("id"), F.lit("voters")), F.lit(SAMPLE_RANGE))
    chosen = marked.where(draw < int(min(1.0, sample_rows / total) * SAMPLE_RANGE))

    def features(batches):
        maker = worker_features()
        for batch in common.text_slices(batches, most=ROWS):
            rows = maker.rows(pc.fill_null(common.column(batch, "text"), ""))
            own, bucket = np.nonzero(rows)
            offsets = pa.array(np.searchsorted(own, np.arange(len(rows) + 1)).astype(np.int32))
            lists = [pa.ListArray.from_arrays(offsets, pa.array(v)) for v in (bucket.astype(np.int32), rows[own, bucket])]
            yield pa.RecordBatch.from_arrays([common.column(batch, "id"), common.column(batch, "label"), *lists], ["id", "label", "buckets", "counts"])

    kinds = dict(chosen.dtypes)
    rows = texts.join(F.broadcast(chosen), "id").select("id", "label", "text").mapInArrow(features, f"id {kinds['id']}, label {kinds['label']}, buckets array<int>, counts array<float>")
    seen = sorted(rows.collect(), key=lambda r: r.id)  # bounded by sample_rows
    if not seen:
        return None
    counts = np.zeros((len(seen), BUCKETS), dtype=np.float32)
    for i, r in enumerate(seen):
        counts[i, r.buckets] = r.counts
    return documents.sparkSession.sparkContext.broadcast(Voters(counts, np.array([float(r.label) for r in seen]), rank, neighbours, power, [r.id for r in seen]))


def score(documents: DataFrame, voters, threshold: float = 0.3, id_column: str = "doc_id") -> DataFrame:
    """(id, score, predicted) of every whole text; a narrow plan."""
    rows = common.plain_names(documents, id_column, "text").toDF("id", "text")
    if voters is None:
        return rows.select(F.col("id").alias(id_column), F.lit(0.5).alias("score"), F.lit(int(0.5 >= threshold)).alias("predicted"))

    def scored(batches):
        maker = worker_features()
        for batch in common.text_slices(batches, limit=2 << 20, most=ROWS):
            values = voters.value.scores(maker.rows(pc.fill_null(common.column(batch, "text"), "")))
            yield pa.RecordBatch.from_arrays([common.column(batch, "id"), pa.array(values), pa.array((values >= threshold).astype(np.int32))], ["id", "score", "predicted"])

    kind = rows.schema["id"].dataType.simpleString()
    return rows.mapInArrow(scored, f"id {kind}, score double, predicted int").withColumnRenamed("id", id_column)


def keep(documents: DataFrame, voters, threshold: float = 0.3, id_column: str = "doc_id") -> DataFrame:
    """Rows with a score of at least ``threshold``, all columns as they were; a labelled row has no vote on itself."""
    if voters is None:
        return documents.where(F.lit(0.5 >= threshold))

    def kept(batches):
        maker = worker_features()
        for batch in common.text_slices(batches, limit=2 << 20, most=ROWS):
            counts = maker.rows(pc.fill_null(common.column(batch, "text"), ""))
            yield batch.filter(pa.array(voters.value.scores(counts, common.column(batch, id_column).to_pylist()) >= threshold))

    return documents.mapInArrow(kept, documents.schema)
