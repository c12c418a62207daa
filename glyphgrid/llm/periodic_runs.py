"""Runs (maximal periodic stretches) of words, and texts with repetitions collapsed.

Each text's words become integers. A stack scanned from right to left keeps, for
every word, the next smaller suffix, which ends the longest Lyndon word there; it
runs under the order of the integers and under its reverse. Every run has such a
Lyndon word as its root under one of the orders, so each word gives one candidate
period an order. Comparisons look at words first and go on by rolling-hash binary
search once eight words agree; agreeing stretches are verified word by word, once
for each distance. Candidates that agree with too few neighbours go in whole-array
steps; the rest is extended to both sides by rolling-hash binary search over all
candidates of a slice, and each run found is verified directly. A hash collision
fails that check and the extension is then done word by word, so results are exact.

Defined results: null and empty texts and those of fewer than ``least`` words have
no run, and a collapsed text of their words with one space between; a null id is
kept; repeated rows give the same row each; ties between runs go by start, then
period; one text is held by one task, at some 100 bytes a word; an empty table gives
no row; only the id and text columns are read, so other columns can't clash.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from . import common
from .fill_middle import _IS_SPACE

#: Odd base of the rolling hash modulo 2^64.
BASE = 0x9E3779B97F4A7C15
_MASK = (1 << 64) - 1
#: Words compared one by one before a hash search.
DIRECT = 8


class Words:
    """Words of a slice's texts as integers, flat; ``offsets`` has each text's part."""

    def __init__(self, texts: pa.Array):
        held = pa.concat_arrays([texts.cast(pa.large_binary())])
        offsets = np.frombuffer(held.buffers()[1], dtype=np.int64, count=len(held) + 1 + held.offset)[held.offset :]
        whole = held.buffers()[2]
        data = np.frombuffer(whole, dtype=np.uint8)[offsets[0] : offsets[-1]] if whole is not None else np.zeros(0, dtype=np.uint8)
        offsets = offsets - offsets[0]
        inside = ~_IS_SPACE[data]
        starts = inside.copy()
        starts[1:] &= ~inside[:-1]
        ends = inside.copy()
        ends[:-1] &= ~inside[1:]
        filled = offsets[:-1][np.diff(offsets) > 0]
        starts[filled] |= inside[filled]
        ends[filled[1:] - 1] |= inside[filled[1:] - 1]
        starts, ends = np.flatnonzero(starts), np.flatnonzero(ends) + 1
        self.sizes = ends - starts
        self.letters = data[inside]
        self.bounds = np.concatenate([[0], np.cumsum(self.sizes)])
        self.offsets = np.searchsorted(starts, offsets)
        words = pa.Array.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(self.bounds.astype(np.int64)), pa.py_buffer(np.ascontiguousarray(self.letters))])
        self.ids = words.dictionary_encode().indices.to_numpy(zero_copy_only=False).astype(np.int64)

    def joined(self, kept: np.ndarray) -> pa.Array:
        """Each text's kept words with one space between."""
        running = np.concatenate([[0], np.cumsum(kept)])
        counts = np.diff(running[self.offsets])
        sizes = self.sizes[kept]
        # a space goes before every kept word but a text's first
        first = np.zeros(len(sizes) + 1, dtype=bool)
        first[running[self.offsets[:-1]][counts > 0]] = True
        spaces = np.cumsum(~first[:-1])
        out = np.full(int(sizes.sum()) + (int(spaces[-1]) if len(spaces) else 0), 0x20, dtype=np.uint8)
        if len(sizes):
            places = np.arange(int(sizes.sum())) + np.repeat(spaces, sizes)
            out[places] = self.letters[np.repeat(kept, self.sizes)]
        lengths = common.segment_sums(np.where(kept, self.sizes, 0), self.offsets) + np.maximum(counts - 1, 0)
        offsets = np.concatenate([[0], np.cumsum(lengths)]).astype(np.int64)
        return pa.Array.from_buffers(pa.large_string(), len(counts), [None, pa.py_buffer(offsets), pa.py_buffer(out)]).cast(pa.string())


class Lce:
    """Longest common extensions to the right of one text's words, for one scan."""

    def __init__(self, ids: list[int], n: int):
        self.ids, self.n = ids, n
        self.hashes: list[int] | None = None
        self.seen: dict[int, tuple[int, int]] = {}

    def agree(self, i: int, j: int, size: int) -> bool:
        h = self.hashes
        return ((h[i + size] - h[i]) * self.powers[j - i] - (h[j + size] - h[j])) & _MASK == 0

    def end(self, i: int, j: int) -> int:
        """First place x >= i with another word than at x + j - i (or where the text ends there)."""
        distance = j - i
        low, high = self.seen.get(distance, (self.n, -1))
        if low <= i <= high:
            return high
        if self.hashes is None:
            self.hashes, self.powers = prefix_hashes(np.array(self.ids[: self.n]))
        a, b = 0, self.n - j
        while a < b:
            mid = (a + b + 1) // 2
            if self.agree(i, j, mid):
                a = mid
            else:
                b = mid - 1
        stop = i + a
        # verified word by word, but for what is known of this distance
        upto = low if i < low <= stop <= high else stop
        ids = self.ids
        if ids[i:upto] != ids[i + distance : upto + distance]:  # a collision
            stop = i
            while stop + distance < self.n and ids[stop] == ids[stop + distance]:
                stop += 1
        self.seen[distance] = (i, stop)
        return stop


def prefix_hashes(ids: np.ndarray) -> tuple[list[int], list[int]]:
    """Hashes of all prefixes (sums of mixed words times powers of BASE), and the powers."""
    powers = np.full(len(ids) + 1, BASE, dtype=np.uint64)
    powers[0] = 1
    powers = np.cumprod(powers)
    sums = np.zeros(len(ids) + 1, dtype=np.uint64)
    np.cumsum(common.mix64(ids.astype(np.uint64) + np.uint64(1)) * powers[:-1], out=sums[1:])
    return sums.tolist(), powers.tolist()


def next_smaller(ids: list[int], n: int) -> list[int]:
    """For each suffix the next one that is smaller (n: none); ``ids[n]`` is below all words."""
    out = [0] * n
    stack = [n]
    lce = Lce(ids, n)
    for i in range(n - 1, -1, -1):
        word = ids[i]
        j = stack[-1]
        while True:
            while ids[j] > word:
                stack.pop()
                j = stack[-1]
            if ids[j] < word:
                break
            x, y = i + 1, j + 1
            stop = x + DIRECT
            while x < stop and ids[x] == ids[y]:
                x += 1
                y += 1
            if x == stop:
                x = lce.end(x, y) if y <= n else x
                y = x + j - i
            if ids[y] < ids[x]:
                break
            stack.pop()
            j = stack[-1]
        out[i] = j
        stack.append(i)
    return out


def _matched(flat: np.ndarray, i: np.ndarray, j: np.ndarray, step: int, most: int) -> np.ndarray:
    """Words that agree from i and j on (step 1) or before them (step -1), up to ``most``."""
    found = np.zeros(len(i), dtype=np.int64)
    live = np.arange(len(i))
    for k in range(most):
        off = k if step > 0 else -k - 1
        live = live[flat[i[live] + off] == flat[j[live] + off]]
        if not len(live):
            break
        found[live] += 1
    return found


def _extended(flat: np.ndarray, i: np.ndarray, j: np.ndarray, room: np.ndarray, sums: np.ndarray, powers: np.ndarray, step: int) -> np.ndarray:
    """Longest agreement by binary search over hashes, at most ``room`` words."""
    low, high = np.zeros(len(i), dtype=np.int64), room.copy()
    while (low < high).any():
        mid = (low + high + 1) // 2
        a, b = (i, j) if step > 0 else (i - mid, j - mid)
        same = (sums[a + mid] - sums[a]) * powers[j - i] == sums[b + mid] - sums[b]
        low, high = np.where(same, mid, low), np.where(same, high, mid - 1)
    return low


def slice_runs(ids: np.ndarray, offsets: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(text, start, length, period) of all runs of ``least`` words or more, by text, start and period."""
    counts = np.diff(offsets)
    docs = np.flatnonzero(counts >= least)
    if not len(docs):
        return (np.zeros(0, dtype=np.int64),) * 4
    # texts one after another, each followed by an end mark that equals no word; a mark of its own before the first
    flat, firsts, smaller = [np.array([-2])], [], []
    at = 1
    for d in docs.tolist():
        own, n = ids[offsets[d] : offsets[d + 1]], int(counts[d])
        firsts.append(at)
        for order in (own, -own):
            smaller.append(np.array(next_smaller([*order.tolist(), -(1 << 62)], n)) + at)
        flat += [own, np.array([-1])]
        at += n + 1
    flat = np.concatenate(flat)
    firsts = np.array(firsts)
    sizes = counts[docs]
    text = np.repeat(np.arange(len(docs)), sizes)
    places = np.arange(int(sizes.sum())) - np.repeat(np.cumsum(sizes) - sizes, sizes) + firsts[text]
    i = np.concatenate([places, places])
    j = np.concatenate([np.concatenate(smaller[0::2]), np.concatenate(smaller[1::2])])
    text = np.concatenate([text, text])
    # a run agrees with itself, a period on, in max(period, least - period) words
    capped = (least + 1) // 2
    near = np.flatnonzero((flat[i] == flat[j]) | (flat[i - 1] == flat[j - 1]))
    ahead = _matched(flat, i[near], j[near], 1, capped)
    behind = _matched(flat, i[near], j[near], -1, capped)
    near = near[ahead + behind >= capped]
    i, j, text = i[near], j[near], text[near]
    powers = np.full(len(flat) + 1, BASE, dtype=np.uint64)
    powers[0] = 1
    powers = np.cumprod(powers)
    sums = np.zeros(len(flat) + 1, dtype=np.uint64)
    np.cumsum(common.mix64((flat + 3).astype(np.uint64)) * powers[:-1], out=sums[1:])
    begin, end = firsts[text], firsts[text] + sizes[text]
    right = _extended(flat, i, j, end - j, sums, powers, 1)
    left = _extended(flat, i, j, i - begin, sums, powers, -1)
    period = j - i
    found = np.flatnonzero(left + right + period >= np.maximum(least, 2 * period))
    table = np.unique(np.stack([text[found], i[found] - left[found], left[found] + right[found] + period[found], period[found]], axis=1), axis=0)
    for k, (t, start, length, p) in enumerate(table.tolist()):
        if not np.array_equal(flat[start : start + length - p], flat[start + p : start + length]):
            table[k] = -1  # a collision: its candidates are extended word by word below
    if len(table) and (table[:, 1] < 0).any():
        table = table[table[:, 1] >= 0]
        own = [_by_words(flat, a, b, s, e, t) for a, b, s, e, t in zip(i.tolist(), j.tolist(), begin.tolist(), end.tolist(), text.tolist(), strict=True)]
        own = [r for r in own if r[2] >= max(least, 2 * r[3])]
        table = np.unique(np.concatenate([table, np.array(own, dtype=np.int64).reshape(-1, 4)]), axis=0)
    t, start, length, p = table.T
    return docs[t], start - firsts[t], length, p


def _by_words(flat: np.ndarray, i: int, j: int, begin: int, end: int, text: int) -> tuple[int, int, int, int]:
    a, b = i, j
    while b < end and flat[a] == flat[b]:
        a, b = a + 1, b + 1
    start, other = i, j
    while start > begin and flat[start - 1] == flat[other - 1]:
        start, other = start - 1, other - 1
    return text, start, b - start, j - i


def runs(documents: DataFrame, least: int = 12, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(id, n_words, runs of (start, length, period) in order, collapsed text) of every text; a narrow plan.

    A word is dropped from the collapsed text where any run holds it after that run's first period.
    """
    if least < 2:
        raise ValueError("a run has two words at least")

    def found(batches):
        for batch in common.text_slices(batches, "text"):
            words = Words(pc.fill_null(common.column(batch, "text"), ""))
            doc, start, length, period = slice_runs(words.ids, words.offsets, least)
            edges = np.zeros(len(words.ids) + 1, dtype=np.int64)
            np.add.at(edges, words.offsets[doc] + start + period, 1)
            np.add.at(edges, words.offsets[doc] + start + length, -1)
            kept = np.cumsum(edges[:-1]) == 0
            spans = pa.StructArray.from_arrays([pa.array(x, pa.int64()) for x in (start, length, period)], ["start", "length", "period"])
            lists = pa.ListArray.from_arrays(pa.array(np.searchsorted(doc, np.arange(batch.num_rows + 1)), pa.int32()), spans)
            yield pa.RecordBatch.from_arrays([common.column(batch, "id"), pa.array(np.diff(words.offsets)), lists, words.joined(kept)], ["id", "n_words", "runs", "collapsed"])

    kind = documents.schema[id_column].dataType.simpleString()
    rows = common.plain_names(documents, id_column, text_column).toDF("id", "text")
    return rows.mapInArrow(found, f"id {kind}, n_words long, runs array<struct<start: bigint, length: bigint, period: bigint>>, collapsed string").withColumnRenamed("id", id_column)
