"""Removal of every byte that lies in a string of ``width`` bytes found twice in the corpus.

A text's cuts are places after eight bytes that a hash picks, and every byte where
no such place is near; whether a place is a cut depends on the bytes around it
only. All windows of ``width`` bytes with the same least hash among the cuts inside
are a piece, and equal windows have equal hashes, so they meet under one key.

1. Equal texts count once, by a 128-bit digest; pieces of equal bytes count once too,
   by a 64-bit digest within their key's.
2. A piece found twice is removed as a whole. Keys that hold several different pieces
   send one of each to a task, where words between cuts (ranked by their bytes; none
   is the start of another) become the symbols of one suffix array over all pieces
   of a batch. Windows are equal if the bytes before their first cut are, and if the
   suffixes from there are neighbours with enough bytes in common: bytes are compared
   themselves.
3. A key of more than ``crowd`` different pieces is cut into finer ones, keyed by all
   that lies between a window's first and last cut, and again into single windows,
   keyed by their own digest, which need counting only. So no key fills a task.

Defined results: a null text is an empty one; a null id is kept; rows of equal texts
all lose what occurs in the other (all bytes, if ``width`` or more); matches may
overlap and be in one text, but never cross texts; texts shorter than ``width`` keep
all bytes; a very long text gives pieces like any other; an empty table gives no row;
only the id and text columns are read, so other columns can't clash.
"""

from __future__ import annotations

import functools

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import common
from .pieces import gather
from .suffix_array import suffix_array

#: Bytes of text that one array step holds, and of pieces in one suffix array (some 100 bytes of arrays a byte of text).
SLICE, BATCH = 1 << 19, 1 << 19
#: Longer tables of powers are made anew each time: a worker would hold them to its end.
HELD_POWERS = 1 << 20
#: Bytes that decide a cut; one place in ``DENSITY`` is one; ``REACH`` bytes without one make every byte a cut.
TRIGGER, DENSITY, REACH = 8, 24, 128
#: Bytes after a cut that its hash covers: texts that share less than these meet under no key.
COVER = 128
#: Different pieces of a key that go to one task at most.
CROWD = 4096
_ODD = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))


@functools.lru_cache(maxsize=1)
def _held_powers() -> tuple[np.ndarray, np.ndarray]:
    return _made_powers(HELD_POWERS)


def _powers(size: int) -> tuple[np.ndarray, np.ndarray]:
    return _held_powers() if size <= HELD_POWERS else _made_powers(size)


def _made_powers(size: int) -> tuple[np.ndarray, np.ndarray]:
    both = []
    for base in (_ODD, _INVERSE):
        powers = np.full(size, base, dtype=np.uint64)
        powers[0] = 1
        both.append(np.cumprod(powers))
    return both[0], both[1]


class Bytes:
    """Bytes of several texts in a row, their cuts, and digests of any stretch of eight bytes or more."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, cuts: bool = True):
        self.data, self.offsets = data, offsets
        padded = np.concatenate([data, np.zeros(16, dtype=np.uint8)])
        #: the eight bytes from each place on
        self.eight = np.ndarray((len(data) + 8,), dtype="<u8", buffer=padded, strides=(1,))
        self.mixed = common.mix64(self.eight[: len(data)].astype(np.uint64))
        self._sums: np.ndarray | None = None
        if cuts:
            self._find_cuts()

    def _find_cuts(self) -> None:
        ends = np.flatnonzero((self.mixed >> np.uint64(40)) < np.uint64((1 << 24) // DENSITY)) + TRIGGER
        text = np.searchsorted(self.offsets, ends - TRIGGER, side="right") - 1
        inside = ends <= self.offsets[text + 1]
        self.triggers, owner = ends[inside], text[inside]
        # stretches without a trigger, from one (or the first place a window looks at) to the next (or the end)
        firsts, lasts = self.offsets[:-1] + TRIGGER, self.offsets[1:]
        places = np.concatenate([self.triggers, firsts - 1])
        owners = np.concatenate([owner, np.arange(len(firsts))])
        order = np.lexsort((places, owners))
        before, owners = places[order], owners[order]
        after = np.append(before[1:], 0)
        last = np.append(owners[1:] != owners[:-1], True) if len(owners) else np.zeros(0, dtype=bool)
        after[last] = lasts[owners[last]]
        room = np.maximum(after - REACH - before, 0)
        steps = gather(before + 1, room)
        self.cuts = np.unique(np.concatenate([self.triggers, steps]))
        self.cut_text = np.searchsorted(self.offsets, self.cuts, side="right") - 1
        # no cut is at a text's first place: one there ends the text before, and starts no word
        keep = self.cuts != self.offsets[self.cut_text]
        self.cuts, self.cut_text = self.cuts[keep], self.cut_text[keep]

    def digest(self, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
        """64-bit digests of the bytes start to stop; stretches of less than eight bytes are no input."""
        if self._sums is None:
            powers, self._inverse = _powers(len(self.data) + 1)
            self._sums = np.zeros(len(self.data) + 1, dtype=np.uint64)
            np.cumsum(self.mixed * powers[: len(self.data)], out=self._sums[1:])
        own = (self._sums[stop - TRIGGER + 1] - self._sums[start]) * self._inverse[start]
        return common.mix64(own ^ (stop - start).astype(np.uint64))

    def pieces(self, width: int, level: int) -> tuple[np.ndarray, ...]:
        """(text, first window, windows, key, digest) of all pieces; windows are places of ``width`` bytes."""
        starts, counts = self.offsets[:-1], np.maximum(np.diff(self.offsets) - width + 1, 0)
        texts = np.flatnonzero(counts)
        if level == 2:
            first = gather(starts[texts], counts[texts])
            text, n = np.repeat(texts, counts[texts]), np.ones(len(first), dtype=np.int64)
            key = self.digest(first, first + width)
            return text, first, n, key, key
        reach = width - REACH
        # places where a cut leaves or enters the windows' view
        moves = [self.cuts - TRIGGER + 1, self.cuts - reach]
        owner = np.concatenate([self.cut_text, self.cut_text, texts])
        moves = np.concatenate([*moves, starts[texts]])
        low, high = starts[owner], starts[owner] + counts[owner]
        moves = np.unique(moves[(moves >= low) & (moves < high)])
        text = np.searchsorted(self.offsets, moves, side="right") - 1
        a = np.searchsorted(self.cuts, moves + TRIGGER)
        b = np.searchsorted(self.cuts, moves + reach, side="right")
        if level == 1:
            key = self.digest(self.cuts[a], self.cuts[b - 1] + COVER)
            same = np.zeros(len(moves), dtype=bool)
        else:
            least = self._least(a, b)
            key = self._hashes[least]
            same = np.append(False, (least[1:] == least[:-1]) & (text[1:] == text[:-1])) if len(moves) else np.zeros(0, dtype=bool)
        fresh = np.flatnonzero(~same)
        first, text, key = moves[fresh], text[fresh], key[fresh]
        ends = np.minimum(np.append(first[1:], np.iinfo(np.int64).max), starts[text] + counts[text])
        return text, first, ends - first, key, self.digest(first, ends - 1 + width) ^ key

    def _least(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """The first cut of the least hash among cuts a to b, by a table of doubling spans."""
        # cuts too near the end of all texts are in no window's view
        hashes = np.zeros(len(self.cuts), dtype=np.uint64)
        seen = np.flatnonzero(self.cuts + COVER <= len(self.data))
        hashes[seen] = self.digest(self.cuts[seen], self.cuts[seen] + COVER)
        self._hashes = hashes
        table = [np.arange(len(self.cuts))]
        span = 1
        while 2 * span <= int((b - a).max(initial=1)):
            left = table[-1][: len(self.cuts) - 2 * span + 1]
            right = table[-1][span : len(self.cuts) - span + 1]
            table.append(np.where(hashes[right] < hashes[left], right, left))
            span *= 2
        level = np.frexp(np.maximum(b - a, 1).astype(np.float64))[1] - 1
        out = np.zeros(len(a), dtype=np.int64)
        for k, own in enumerate(table):
            at = np.flatnonzero(level == k)
            left, right = own[a[at]], own[b[at] - (1 << k)]
            out[at] = np.where(hashes[right] < hashes[left], right, left)
        return out


def common_bytes(eight: np.ndarray, a: np.ndarray, b: np.ndarray, limit: np.ndarray) -> np.ndarray:
    """Equal bytes from a and b on, up to ``limit``: eight at a time."""
    found = np.zeros(len(a), dtype=np.int64)
    live = np.flatnonzero(limit > 0)
    while len(live):
        apart = eight[a[live] + found[live]] ^ eight[b[live] + found[live]]
        same = apart == 0
        odd = apart[~same]
        found[live[~same]] += (np.log2((odd & (~odd + np.uint64(1))).astype(np.float64)).astype(np.int64)) // 8
        found[live[same]] += 8
        live = live[same]
        live = live[found[live] < limit[live]]
    return np.minimum(found, limit)


def repeated_windows(parts: list[bytes], width: int) -> np.ndarray:
    """For each window of the parts, flat, whether an equal one starts elsewhere in them.

    A window whose digest is the only one can't repeat: what is left of the parts around the others is compared by one suffix array.
    """
    offsets = np.concatenate([[0], np.cumsum([len(p) for p in parts])]).astype(np.int64)
    counts = np.maximum(np.diff(offsets) - width + 1, 0)
    windows = gather(offsets[:-1], counts)
    repeated = np.zeros(len(windows), dtype=bool)
    whole = b"".join(parts)
    digests = Bytes(np.frombuffer(whole, dtype=np.uint8), offsets, cuts=False).digest(windows, windows + width) if len(windows) else np.zeros(0, dtype=np.uint64)
    order = np.argsort(digests, kind="stable")
    same = digests[order[1:]] == digests[order[:-1]]
    likely = np.zeros(len(windows), dtype=bool)
    likely[order[1:][same]] = likely[order[:-1][same]] = True
    likely = np.flatnonzero(likely)
    if not len(likely):
        return repeated
    part = np.searchsorted(offsets, windows[likely], side="right") - 1
    fresh = np.flatnonzero(np.diff(part, prepend=-1))
    first, last = windows[likely[fresh]], windows[likely[np.append(fresh[1:], len(likely)) - 1]]
    kept = [whole[a : b + width] for a, b in zip(first.tolist(), last.tolist(), strict=True)]
    starts = np.concatenate([[0], np.cumsum([len(k) for k in kept])]).astype(np.int64)
    moved = windows[likely] - np.repeat(first - starts[:-1], np.diff(fresh, append=len(likely)))
    repeated[likely] = _equal_windows(b"".join(kept), starts, moved, width)
    return repeated


def _equal_windows(whole: bytes, offsets: np.ndarray, windows: np.ndarray, width: int) -> np.ndarray:
    """For each window of the parts from ``offsets`` on, whether an equal one of those starts elsewhere: by one suffix array."""
    held = Bytes(np.frombuffer(whole, dtype=np.uint8), offsets)
    repeated = np.zeros(len(windows), dtype=bool)
    parts = len(offsets) - 1
    cuts, owner = held.cuts, held.cut_text
    # words: up to the next trigger, REACH bytes or the part's end; the rank of a word's bytes is its symbol
    ends = offsets[owner + 1]
    after = np.searchsorted(held.triggers, cuts, side="right")
    after = np.where(after < len(held.triggers), np.append(held.triggers, 0)[np.minimum(after, len(held.triggers))], ends)
    stops = np.minimum(np.minimum(after, cuts + REACH), ends)
    words = [whole[a:b] for a, b in zip(cuts.tolist(), stops.tolist(), strict=True)]
    rank = {w: k for k, w in enumerate(sorted(set(words)), 2)}
    # the parts' symbols, each part followed by 1, and 0 at the end
    places = np.arange(len(cuts)) + owner
    text = np.ones(len(cuts) + parts + 1, dtype=np.int64)
    text[places] = np.fromiter(map(rank.__getitem__, words), dtype=np.int64, count=len(words))
    text[-1] = 0
    cut_at = np.full(len(text), -1, dtype=np.int64)
    cut_at[places] = np.arange(len(cuts))
    sorted_cuts = cut_at[np.array(suffix_array(text))]
    sorted_cuts = sorted_cuts[sorted_cuts >= 0]
    ranks = np.empty(len(cuts), dtype=np.int64)
    ranks[sorted_cuts] = np.arange(len(cuts))
    at, stop = cuts[sorted_cuts], ends[sorted_cuts]
    shared = np.zeros(len(cuts) + 1, dtype=np.int64)  # bytes shared with the suffix before
    shared[1:-1] = common_bytes(held.eight, at[:-1], at[1:], np.minimum(np.minimum(stop[:-1] - at[:-1], stop[1:] - at[1:]), width))
    first = np.searchsorted(cuts, windows + TRIGGER)
    before = cuts[first] - windows
    r = ranks[first]
    near = np.flatnonzero(np.maximum(shared[r], shared[r + 1]) >= width - before)
    if not len(near):
        return repeated
    windows, before, r = windows[near], before[near], r[near]
    # the bytes before the first cut, as numbers of distinct strings
    lead = held.data[gather(windows, before)]
    bounds = np.concatenate([[0], np.cumsum(before)]).astype(np.int64)
    strings = pa.Array.from_buffers(pa.large_binary(), len(windows), [None, pa.py_buffer(bounds), pa.py_buffer(np.ascontiguousarray(lead))])
    leads = strings.dictionary_encode().indices.to_numpy(zero_copy_only=False).astype(np.int64)
    classes = np.empty(len(windows), dtype=np.int64)
    order = np.argsort(before, kind="stable")
    for own in np.split(order, np.flatnonzero(np.diff(before[order])) + 1):
        # neighbours that share what is left of the width are one class
        classes[own] = np.cumsum(shared[:-1] < width - before[own[0]])[r[own]]
    _, inverse, times = np.unique(leads * (len(cuts) + 1) + classes, return_inverse=True, return_counts=True)
    repeated[near] = times[inverse] > 1
    return repeated


def _spans(flags: np.ndarray) -> list[tuple[int, int]]:
    """(first, count) of runs of true flags."""
    edges = np.flatnonzero(np.diff(np.concatenate([[0], flags.astype(np.int8), [0]])))
    return list(zip(edges[::2].tolist(), (edges[1::2] - edges[::2]).tolist(), strict=True))


_PIECE = "key bigint, piece bigint, at int, n int"
_MARKS = "array<struct<at: int, n: int>>"


def _signed(x: np.ndarray) -> pa.Array:
    return pa.array(x.view(np.int64))


def text_pieces(texts: DataFrame, width: int) -> DataFrame:
    """Texts (d1, d2, text) as (d1, d2, n_bytes, pieces)."""

    def found(batches):
        for batch in common.text_slices(batches, "text", SLICE):
            column = pc.fill_null(common.column(batch, "text"), "").cast(pa.large_binary())
            held = pa.concat_arrays([column])
            offsets = np.frombuffer(held.buffers()[1], dtype=np.int64, count=len(held) + held.offset + 1)[held.offset :]
            data = np.frombuffer(held.buffers()[2], dtype=np.uint8)[offsets[0] : offsets[-1]] if held.buffers()[2] is not None else np.zeros(0, dtype=np.uint8)
            offsets = offsets - offsets[0]
            text, first, n, key, piece = Bytes(data, offsets).pieces(width, 0)
            rows = pa.StructArray.from_arrays([_signed(key), _signed(piece), pa.array((first - offsets[text]).astype(np.int32)), pa.array(n.astype(np.int32))], ["key", "piece", "at", "n"])
            lists = pa.ListArray.from_arrays(pa.array(np.searchsorted(text, np.arange(len(offsets))), pa.int32()), rows)
            yield pa.RecordBatch.from_arrays([common.column(batch, "d1"), common.column(batch, "d2"), pa.array(np.diff(offsets)), lists], ["d1", "d2", "n_bytes", "pieces"])

    return texts.mapInArrow(found, "d1 bigint, d2 bigint, n_bytes bigint, pieces array<struct<key: bigint, piece: bigint, at: int, n: int>>")


def finer_pieces(parts: DataFrame, width: int, level: int) -> DataFrame:
    """Parts (key, piece, times, bytes) cut up: (key, piece, times, at, n) of each finer piece and (of_key, of_piece) of its part."""

    def found(batches):
        for batch in common.text_slices(batches, "bytes", SLICE):
            values = common.column(batch, "bytes").to_pylist()
            offsets = np.concatenate([[0], np.cumsum([len(v) for v in values])]).astype(np.int64)
            text, first, n, key, piece = Bytes(np.frombuffer(b"".join(values), dtype=np.uint8), offsets).pieces(width, level)
            owner = pa.array(text)
            columns = [_signed(key), _signed(piece), common.column(batch, "times").take(owner), pa.array((first - offsets[text]).astype(np.int32)), pa.array(n.astype(np.int32)), common.column(batch, "key").take(owner), common.column(batch, "piece").take(owner)]
            out = pa.RecordBatch.from_arrays(columns, ["key", "piece", "times", "at", "n", "of_key", "of_piece"])
            for a in range(0, out.num_rows, 50_000):
                yield out.slice(a, 50_000)

    return parts.mapInArrow(found, "key bigint, piece bigint, times bigint, at int, n int, of_key bigint, of_piece bigint")


def marked_parts(parts: DataFrame, width: int) -> DataFrame:
    """(key, piece, marks) of parts (key, piece, times, bytes) met once in which windows repeat; keys stay whole in a task."""

    def marks(rows: list[tuple]):
        flags = repeated_windows([r[3] for r in rows], width)
        ends = np.cumsum([max(len(r[3]) - width + 1, 0) for r in rows])
        out = [(r[0], r[1], _spans(own)) for r, own in zip(rows, np.split(flags, ends[:-1]), strict=True) if r[2] == 1 and own.any()]
        key, piece, spans = zip(*out, strict=True) if out else ((), (), ())
        listed = [[{"at": a, "n": n} for a, n in own] for own in spans]
        return pa.RecordBatch.from_arrays([pa.array(key, pa.int64()), pa.array(piece, pa.int64()), pa.array(listed, pa.list_(pa.struct([("at", pa.int32()), ("n", pa.int32())])))], ["key", "piece", "marks"])

    def found(batches):
        held: list[tuple] = []
        size = 0
        for batch in batches:
            for row in zip(*(common.column(batch, name).to_pylist() for name in ("key", "piece", "times", "bytes")), strict=True):
                if held and size >= BATCH and row[0] != held[-1][0]:
                    yield marks(held)
                    held, size = [], 0
                held.append(row)
                size += len(row[3])
        if held:
            yield marks(held)

    dealt = parts.select("key", "piece", "times", "bytes").repartition("key").sortWithinPartitions("key")
    return dealt.mapInArrow(found, f"key bigint, piece bigint, marks {_MARKS}")


def _whole(n: Column) -> Column:
    return F.array(F.struct(F.lit(0).alias("at"), n.alias("n")))


def _known(members: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(key, piece, marks) of members met twice, and keys (key, different) where others may repeat in part."""
    twice = members.where("times > 1").select("key", "piece", _whole(F.col("n")).alias("marks"))
    keys = members.groupBy("key").agg(F.count(F.lit(1)).alias("different"), F.min("times").alias("least"))
    return twice, keys.where("different > 1 and least = 1").select("key", "different")


def _resolve(parts: DataFrame, width: int, crowd: int, level: int, scratch: common.Scratch) -> DataFrame:
    """(key, piece, marks) of parts (key, piece, times, different, bytes): by suffix arrays, or cut finer where a key is crowded."""
    few = marked_parts(parts.where(F.col("different") <= crowd), width)
    crowded = parts.where(F.col("different") > crowd)
    if not crowded.head(1):
        return few
    finer = scratch.table(finer_pieces(crowded.select("key", "piece", "times", "bytes"), width, level + 1))
    members = scratch.table(finer.groupBy("key", "piece").agg(F.sum("times").alias("times"), *[F.first(c).alias(c) for c in ("n", "at", "of_key", "of_piece")]))
    marks, keys = _known(members)
    if level == 0:  # single windows under their own digest need no comparison
        own = members.join(keys.hint("merge"), "key").select("key", "piece", "times", "different", "n", "at", "of_key", "of_piece")
        source = crowded.select(F.col("key").alias("of_key"), F.col("piece").alias("of_piece"), "bytes")
        cut = F.substr("bytes", F.col("at") + 1, F.col("n") + F.lit(width - 1)).alias("bytes")
        again = scratch.table(own.join(source.hint("merge"), ["of_key", "of_piece"]).select("key", "piece", "times", "different", cut))
        marks = marks.unionByName(_resolve(again, width, crowd, 1, scratch))
    back = finer.join(marks.hint("merge"), ["key", "piece"]).select(F.col("of_key").alias("key"), F.col("of_piece").alias("piece"), F.transform("marks", lambda m: F.struct((m["at"] + F.col("at")).alias("at"), m["n"].alias("n"))).alias("marks"))
    return few.unionByName(back.groupBy("key", "piece").agg(F.flatten(F.collect_list("marks")).alias("marks")))


def _digests(text: Column) -> list[Column]:
    return [F.xxhash64(text).alias("d1"), F.xxhash64(F.lit(7), text).alias("d2")]


def repeated_spans(documents: DataFrame, scratch: common.Scratch, width: int, crowd: int = CROWD) -> DataFrame:
    """(d1, d2, spans of (start, stop)) of texts (d1, d2, text) with repeated bytes; spans may overlap, in no order."""
    long = documents.where(F.octet_length("text") >= width).select("d1", "d2", "text")
    found = text_pieces(long, width)
    texts = scratch.table(found.groupBy("d1", "d2").agg(F.count(F.lit(1)).alias("copies"), F.first("n_bytes").alias("n_bytes"), F.first("pieces").alias("pieces")))
    flat = texts.select("d1", "d2", "copies", F.explode("pieces").alias("p")).select("d1", "d2", "copies", "p.*")
    members = scratch.table(flat.groupBy("key", "piece").agg(F.count(F.lit(1)).alias("times"), *[F.first(c).alias(c) for c in ("d1", "d2", "at", "n")]))
    marks, keys = _known(members)
    wanted = members.join(keys.hint("merge"), "key").groupBy("d1", "d2").agg(F.collect_list(F.struct("key", "piece", "times", "different", "at", "n")).alias("wanted"))
    # one row of each text, dealt by its digest, meets the pieces wanted from it
    single = long.groupBy("d1", "d2").agg(F.first("text").alias("text"))
    fetched = single.join(wanted.hint("merge"), ["d1", "d2"]).select(F.col("text").cast("binary").alias("text"), F.explode("wanted").alias("w"))
    cut = F.substr("text", F.col("w.at") + 1, F.col("w.n") + F.lit(width - 1)).alias("bytes")
    parts = scratch.table(fetched.select("w.key", "w.piece", "w.times", "w.different", cut))
    marks = scratch.table(marks.unionByName(_resolve(parts, width, crowd, 0, scratch)))
    spans = F.transform("marks", lambda m: F.struct((m["at"] + F.col("at")).cast("bigint").alias("start"), (m["at"] + m["n"] + F.col("at") + F.lit(width - 1)).cast("bigint").alias("stop")))
    partly = flat.where("copies = 1").join(marks.hint("merge"), ["key", "piece"]).select("d1", "d2", spans.alias("spans")).groupBy("d1", "d2").agg(F.flatten(F.collect_list("spans")).alias("spans"))
    wholly = texts.where("copies > 1").select("d1", "d2", F.array(F.struct(F.lit(0).cast("bigint").alias("start"), F.col("n_bytes").alias("stop"))).alias("spans"))
    return partly.unionByName(wholly)


def remove_repeats(documents: DataFrame, width: int = 400, crowd: int = CROWD, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(id, n_bytes, spans of (start, stop) that go, kept bytes) of every row."""
    if width < 2 * REACH + TRIGGER:
        raise ValueError(f"strings have {2 * REACH + TRIGGER} bytes at least")
    rows = common.plain_names(documents, id_column, text_column).toDF("id", "text")
    rows = rows.select("id", F.coalesce("text", F.lit("")).alias("text")).select("id", "text", *_digests(F.col("text")))
    common.workers_find_package(documents.sparkSession)
    with common.Scratch(documents.sparkSession) as scratch:
        spans = scratch.table(repeated_spans(rows, scratch, width, crowd), keep=True)

    def cut(batches):
        for batch in common.text_slices(batches, "text", SLICE):
            texts = common.column(batch, "text").cast(pa.binary()).to_pylist()
            merged, kept = [], []
            for text, spans in zip(texts, common.column(batch, "spans").to_pylist(), strict=True):
                own: list[list[int]] = []
                for span in sorted((s["start"], s["stop"]) for s in spans or ()):
                    if own and span[0] <= own[-1][1]:
                        own[-1][1] = max(own[-1][1], span[1])
                    else:
                        own.append(list(span))
                merged.append([{"start": a, "stop": b} for a, b in own])
                ends = [0, *(b for _, b in own)]
                kept.append(b"".join(text[a:b] for a, b in zip(ends, [*(a for a, _ in own), len(text)], strict=True)))
            kind = pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())]))
            yield pa.RecordBatch.from_arrays([common.column(batch, "id"), pa.array(map(len, texts), pa.int64()), pa.array(merged, kind), pa.array(kept, pa.binary())], ["id", "n_bytes", "spans", "kept"])

    joined = rows.join(spans.hint("shuffle_hash"), ["d1", "d2"], "left").select("id", "text", "spans")
    kind = documents.schema[id_column].dataType.simpleString()
    return joined.mapInArrow(cut, f"id {kind}, n_bytes long, spans array<struct<start: bigint, stop: bigint>>, kept binary").withColumnRenamed("id", id_column)
