"""Nearest neighbours by additive quantisation.

A vector is approximated by a sum of one codeword from each of several
full-dimensional codebooks. Codebooks are learned on residuals of a bounded
sample, then refitted jointly by least squares; beam search encodes every vector,
and what its approximation's norm lacks of its own is stored with the code. A query
scores codes by adding entries of its lookup tables (inner products with all
codewords) times that share, as approximations are short, and the best of each block
are reranked by exact double-precision inner products.

Queries and candidates are dealt into blocks of bounded size, and each pair of a
query block and a candidate block meets in one task, which keeps the exact best
of its block; a last aggregation merges blocks. Nothing is broadcast but the
codebooks, whose size is fixed by parameters.

Defined results: vectors that are null, zero, of another size than most of the
sample, or hold null or non-finite components take no part; a query's own row is
no candidate; with fewer candidates than ``k`` all are returned; equal scores go
to the smaller id; repeated ids are rows of their own; an empty table gives no row;
only the id and vector columns are read, so other columns can't clash.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import common

SAMPLE_RANGE = 1 << 20


class Codebooks:
    """Additive codebooks (books x words x dimensions)."""

    def __init__(self, sample: np.ndarray, books: int, words: int, beam: int, rounds: int = 2):
        rng = np.random.default_rng(11)
        self.beam = beam
        residual = sample.astype(np.float32).copy()
        self.books = np.zeros((books, words, sample.shape[1]), dtype=np.float32)
        for m in range(books):
            self.books[m] = self._means(residual, words, rng)
            residual -= self.books[m][self._nearest(residual, self.books[m])]
        for _ in range(rounds):
            codes = self.encode(sample)
            self._refit(sample, codes)

    @staticmethod
    def _nearest(rows: np.ndarray, words: np.ndarray) -> np.ndarray:
        return (rows @ words.T - (words**2).sum(axis=1) / 2).argmax(axis=1)

    def _means(self, rows: np.ndarray, words: int, rng) -> np.ndarray:
        means = rows[rng.choice(len(rows), words, replace=len(rows) < words)].copy()
        for _ in range(8):
            near = self._nearest(rows, means)
            sums = np.zeros_like(means)
            np.add.at(sums, near, rows)
            sizes = np.bincount(near, minlength=words)
            means[sizes > 0] = sums[sizes > 0] / sizes[sizes > 0, None]
        return means

    def _refit(self, rows: np.ndarray, codes: np.ndarray) -> None:
        """Least squares over all codewords at once, for the codes as they are."""
        books, words, size = self.books.shape
        flat = codes + np.arange(books) * words
        chosen = np.zeros((len(rows), books * words), dtype=np.float32)
        chosen[np.arange(len(rows))[:, None], flat] = 1
        gram = chosen.T @ chosen + 0.05 * np.eye(books * words, dtype=np.float32)
        self.books = np.linalg.solve(gram, chosen.T @ rows + 0.05 * self.books.reshape(-1, size)).reshape(books, words, size).astype(np.float32)

    def encode(self, rows: np.ndarray) -> np.ndarray:
        """Codes (rows x books) of the least error that beam search finds."""
        out = np.empty((len(rows), len(self.books)), dtype=np.int64)
        for low in range(0, len(rows), 512):
            out[low : low + 512] = self._beam(rows[low : low + 512].astype(np.float32))
        return out

    def _beam(self, rows: np.ndarray) -> np.ndarray:
        n, size = rows.shape
        residual = rows[:, None, :]
        codes = np.zeros((n, 1, 0), dtype=np.int64)
        own = np.arange(n)[:, None]
        for book in self.books:
            error = (residual**2).sum(axis=2)[:, :, None] - 2 * (residual @ book.T) + (book**2).sum(axis=1)
            flat = error.reshape(n, -1)
            width = min(self.beam, flat.shape[1])
            best = np.argpartition(flat, width - 1, axis=1)[:, :width]
            parent, word = best // len(book), best % len(book)
            codes = np.concatenate([codes[own, parent], word[:, :, None]], axis=2)
            residual = residual[own, parent] - book[word]
        return codes[np.arange(n), (residual**2).sum(axis=2).argmin(axis=1)]

    def decode(self, codes: np.ndarray) -> np.ndarray:
        return self.books[np.arange(len(self.books)), codes].sum(axis=1)

    def tables(self, queries: np.ndarray) -> np.ndarray:
        """Inner products of queries with all codewords (queries x books x words)."""
        return np.einsum("qd,mwd->qmw", queries, self.books, optimize=True)


def score_codes(tables: np.ndarray, codes: np.ndarray) -> np.ndarray:
    """Sums of table entries: approximate inner products (queries x candidates)."""
    out = tables[:, 0, :][:, codes[:, 0]].copy()
    for m in range(1, tables.shape[1]):
        out += tables[:, m, :][:, codes[:, m]]
    return out


def valid(vector: Column, size: int) -> Column:
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return vector.isNotNull() & (F.size(vector) == size) & ~bad & F.exists(vector, lambda x: x != 0)


def matrix(column: pa.Array, size: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, size)


def block_best(q_ids: np.ndarray, queries: np.ndarray, ids: np.ndarray, vectors: np.ndarray, codes: np.ndarray, norms: np.ndarray, books: Codebooks, k: int, rerank: int):
    """(query, id, score) of the k best candidates of a block for each query, ids ascending in the block."""
    found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    keep = min(rerank, len(ids))
    for low in range(0, len(q_ids), 256):
        part = queries[low : low + 256]
        approximate = score_codes(books.tables(part.astype(np.float32)), codes) * norms
        approximate[q_ids[low : low + 256, None] == ids[None, :]] = -np.inf
        cut = np.partition(approximate, len(ids) - keep, axis=1)[:, len(ids) - keep]
        for row, (q, least) in enumerate(zip(q_ids[low : low + 256], cut, strict=True)):
            over = np.flatnonzero(approximate[row] > least)
            ties = np.flatnonzero(approximate[row] == least)[: keep - len(over)]  # smaller ids first
            at = np.concatenate([over, ties])
            at = at[ids[at] != q]
            exact = vectors[at].astype(np.float64) @ part[row].astype(np.float64)
            first = np.lexsort((ids[at], -exact))[:k]
            found.append((np.full(len(first), q), ids[at][first], exact[first]))
    return [np.concatenate(x) if found else np.zeros(0) for x in zip(*found, strict=True)] if found else [np.zeros(0, dtype=np.int64)] * 2 + [np.zeros(0)]


def search(vectors: DataFrame, queries: Column, k: int = 20, rerank: int = 300, books: int = 8, words: int = 128, beam: int = 8, sample_rows: int = 8192, block_rows: int = 8192, query_rows: int = 1024, id_column: str = "vec_id", vector_column: str = "embedding") -> DataFrame:
    """(query_id, rank, id, score): the k nearest of each query row among all other rows."""
    spark = vectors.sparkSession
    rows = common.plain_names(vectors, id_column, vector_column).withColumn("is_query", F.coalesce(queries, F.lit(False))).toDF("id", "vector", "is_query").where("id is not null")
    total, asked = rows.agg(F.count(F.lit(1)), F.count_if("is_query")).first()
    draw = F.pmod(F.xxhash64(F.col("id"), F.lit("codebooks")), F.lit(SAMPLE_RANGE))
    chosen = rows.where(draw <= int(min(1.0, sample_rows / max(total, 1)) * SAMPLE_RANGE)).where("vector is not null")
    sample = [r.vector for r in chosen.select("vector").collect()]  # bounded by sample_rows
    schema = f"query_id {rows.schema['id'].dataType.simpleString()}, rank int, id {rows.schema['id'].dataType.simpleString()}, score double"
    sizes = [len(v) for v in sample if v]
    size = max(set(sizes), key=sizes.count) if sizes else 0
    good = np.array([v for v in sample if len(v) == size and None not in v], dtype=np.float64).reshape(-1, max(size, 1))
    good = good[np.isfinite(good).all(axis=1) & (good != 0).any(axis=1)]
    if not len(good):
        return spark.createDataFrame([], schema).withColumnRenamed("id", id_column)
    shared = spark.sparkContext.broadcast(Codebooks(good.astype(np.float32), books, min(words, len(good)), beam))
    rows = rows.where(valid(F.col("vector"), size))
    blocks, query_blocks = -(-total // block_rows), max(1, -(-asked // query_rows))

    def encoded(batches):
        for batch in batches:
            codes = shared.value.encode(matrix(common.column(batch, "vector"), size))
            own = matrix(common.column(batch, "vector"), size).astype(np.float64)
            short = np.sqrt((shared.value.decode(codes).astype(np.float64) ** 2).sum(axis=1))
            norms = np.where(short > 0, np.sqrt((own**2).sum(axis=1)) / np.where(short > 0, short, 1), 1.0).astype(np.float32)
            flat = pa.array(codes.ravel().astype(np.int16))
            lists = pa.ListArray.from_arrays(pa.array((np.arange(len(codes) + 1) * codes.shape[1]).astype(np.int32)), flat)
            yield pa.RecordBatch.from_arrays([common.column(batch, "id"), common.column(batch, "vector"), lists, pa.array(norms)], ["id", "vector", "codes", "norm"])

    fields = {f.name: f.dataType.simpleString() for f in rows.schema}
    index = rows.select("id", "vector").mapInArrow(encoded, f"id {fields['id']}, vector {fields['vector']}, codes array<smallint>, norm float")
    left = rows.where("is_query").select("id", "vector", F.pmod(F.hash("id"), F.lit(query_blocks)).alias("qb"), F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("cb"))
    right = index.select("id", "vector", "codes", "norm", F.pmod(F.hash("id"), F.lit(blocks)).alias("cb"), F.explode(F.sequence(F.lit(0), F.lit(query_blocks - 1))).alias("qb"))

    def matched(asked_rows: pa.Table, candidates: pa.Table) -> pa.Table:
        kind = pa.int64()
        if not asked_rows.num_rows or not candidates.num_rows:
            columns = [np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64), np.zeros(0)]
        else:
            candidates = candidates.sort_by("id").combine_chunks()
            asked_rows = asked_rows.combine_chunks()
            ids, q_ids = (t["id"].to_numpy().astype(np.int64) for t in (candidates, asked_rows))
            codes = matrix(candidates["codes"].combine_chunks(), len(shared.value.books)).astype(np.int64)
            columns = block_best(q_ids, matrix(asked_rows["vector"].combine_chunks(), size), ids, matrix(candidates["vector"].combine_chunks(), size), codes, candidates["norm"].to_numpy(), shared.value, k, rerank)
        return pa.table({"query_id": pa.array(columns[0], kind), "id": pa.array(columns[1], kind), "score": pa.array(columns[2], pa.float64())})

    near = left.groupBy("qb", "cb").cogroup(right.groupBy("qb", "cb")).applyInArrow(matched, "query_id long, id long, score double")
    # each block sends k rows a query; a query's rows are few (k x blocks) and are merged by its id
    merged = near.groupBy("query_id").agg(F.slice(F.array_sort(F.collect_list(F.struct((-F.col("score")).alias("less"), "id", "score"))), 1, k).alias("best"))
    out = merged.select("query_id", F.posexplode("best").alias("place", "hit"))
    return out.select("query_id", (F.col("place") + 1).cast("int").alias("rank"), F.col("hit.id").alias(id_column), F.col("hit.score").alias("score"))
