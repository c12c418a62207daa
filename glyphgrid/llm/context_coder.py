"""Token ids in compressed blocks: adaptive context mixing drives a range coder.

A block codes up to ``BLOCK`` ids below 2 ** 28 and starts from a fresh model.
For each id the order-2 and order-1 contexts (hashes of the ids before) predict the
id that came after them last, each with a confidence; order 0 has a distribution by
``BUCKETS`` ranges of ids, even within a range. The id's probability is the mixture
of the three; an adaptive table gives the shares of the orders by both confidences
and whether the two agree. A block's head tells the distribution of order 0: half a
byte a range, of those ids that the higher orders don't foretell. The range coder
takes the order that holds and the range in one step, and the place in the range in
another. It has 64-bit low and range and gives 32-bit words.

A block is a header (magic, ids, their crc32, levels of the ranges) and the coder's
words, so any block is decoded and checked alone. All blocks of a chunk are coded
side by side, one a lane of the arrays, which is what makes the steps whole-array
ones. The model has integers only, so blocks decode alike on any machine. A chunk
codes its ids as ranks by frequency, so that the ranges follow its distribution.

Files are a Parquet folder of chunks (part, chunk, offset, n_ids, doc_ids, counts,
by_rank, blocks): whole documents in order, the ids that each has, the id of each
rank, and the blocks. Parts hold ascending ranges of doc_id and about ``PART_BYTES``
of text; ``offset`` counts a part's ids before the chunk.

Defined results: null is an empty text (the end id alone); a null doc_id comes
first; rows of one doc_id follow each other in the order of a hash of their texts,
and may be dealt to several parts; an empty table writes no rows; ids of a very long
text run over several blocks; only the id and text columns are read, so other columns
can't clash; a block whose magic, count or crc32 is wrong, a rank that no id has, or
a block's id of 2 ** 28 or more raises ValueError.
"""

from __future__ import annotations

import functools
import itertools
import json
import os
import re
import struct
import uuid
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import common
from .rank_bpe import vocabulary_path
from .token_counts import drops_spaces

BLOCK = 1024
#: Ids after which a chunk ends with the document, and blocks that are coded side by side at most.
CHUNK_IDS, LANES = 6 << 20, 4096
#: A lane's state is kept small (2 KB, and 2 KB of order 0 in decoding), for a core's cache.
SLOT_BITS = 8
ID_BITS = 28
MAGIC = b"CMX4"
HEAD = struct.Struct("<4sII")
PART_BYTES = 10 << 20
#: Distinct units whose ids a worker holds before it starts anew.
MEMO = 1_500_000
#: Ranges of ids that order 0 tells apart, and what their sizes sum up to.
BUCKETS, ORDER0 = 64, 512
#: A pre-token pattern; plain words, of the characters ! to ~ and letters that every Unicode version lowers and composes alike;
#: what the pattern matches in them in small letters; and words that one text joins for the library.
PARTS = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
PLAIN = r"^[!-~À-ÖØ-öø-ÿА-я]+$"
PLAIN_PARTS = r"('s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ÿа-я]+|[0-9]|[^a-z0-9ß-öø-ÿа-я]+)"
OTHERS = r"([^a-zß-öø-ÿа-я]+)"
JOINED = 64
#: The step after the pattern.
BYTES = {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False}
#: Stands between other words that one call joins; words that hold it are encoded alone.
MARK = "\x01"
#: A bucket's level tells its ids in the block roughly: the least count of each level from 1 on, and the weight of each from 0 on.
LEVEL_FLOORS = np.array([1, 2, 3, 5, 7, 10, 14, 20, 28, 40, 57, 80, 113, 160, 226])
LEVEL_WEIGHTS = np.array([0, 2, 4, 8, 12, 17, 24, 34, 48, 68, 97, 137, 193, 273, 386, 560])
#: Steps of the coder: 2 ** 12 (orders) times ORDER0 leave 2 ** 11 of a range of 2 ** 32 at least; a place takes 2 ** 27 at most.
CLASS_BITS = 12
#: Shares are of 2 ** 16 and move by a part of 2 ** RATE; STEP keeps the two orders' sum below the whole.
RATE, RATE_MASK, STEP = np.uint32(5), np.uint32(0x07FF07FF), np.uint32(2040)
ONE, TWO, THREE, FOUR = np.uint32(1), np.uint32(2), np.uint32(3), np.uint32(4)
#: What a confidence of 0 to 3 moves by where its offer is wrong, and where it is right.
MOVES = np.array([0, -1, -1, -2, 1, 1, 1, 0]).astype(np.uint32)
U32 = np.uint64(32)
LEAST = np.uint64(1 << 32)
#: Shares of the orders 2 and 1 that a block begins with, in 1/64, by the confidence of order 2, that of order 1, and whether they offer the same.
_FIRST = [(1, 2), (2, 1), (1, 15), (28, 1), (1, 35), (46, 1), (1, 51), (56, 1), (14, 2), (29, 1), (9, 13), (43, 1), (14, 33), (54, 1), (4, 46), (58, 1)]
_FIRST += [(41, 1), (41, 1), (18, 8), (42, 1), (26, 2), (55, 1), (15, 35), (58, 1), (50, 1), (40, 1), (14, 9), (45, 1), (23, 34), (45, 1), (9, 17), (58, 1)]
PRIORS = np.array([(two << 16 | one) << 10 for two, one in _FIRST], dtype=np.uint32)


@functools.lru_cache(maxsize=1)
def bucket_tables() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First id of each bucket (and of what follows them), the bits of a place in it, and the bucket of each id below 2 ** 16.

    Ids below 16 are alone; there are 4 buckets an octave below 2 ** 12 and one above.
    """
    bits = np.array([0] * 16 + [k - 2 for k in range(4, 12) for _ in range(4)] + list(range(12, 28)))
    firsts = np.append(0, np.cumsum(np.int64(1) << bits))
    return firsts, bits, (np.searchsorted(firsts, np.arange(1 << 16), side="right") - 1).astype(np.uint8)


class Writer:
    """Range coder lanes that take parts (start, width) of their ranges."""

    def __init__(self, lanes: int, room: int):
        self.low, self.range = np.zeros(lanes, dtype=np.uint64), np.full(lanes, 0xFFFFFFFFFFFFFFFF, dtype=np.uint64)
        self.out, self.size = np.zeros((lanes, room), dtype=np.uint32), np.zeros(lanes, dtype=np.int64)

    def _carry(self, lanes: np.ndarray) -> None:
        at = self.size[lanes] - 1
        while len(lanes):
            self.out[lanes, at] += np.uint32(1)
            over = self.out[lanes, at] == 0
            lanes, at = lanes[over], at[over] - 1

    def put(self, m: int, start: np.ndarray, width: np.ndarray) -> None:
        """Narrow the first ``m`` lanes to the ``width`` from ``start`` on."""
        low = self.low[:m]
        np.add(low, start, out=low)
        over = low < start
        if over.any():
            self._carry(np.flatnonzero(over))
        lanes = np.flatnonzero(width < LEAST)
        if len(lanes):
            words = low[lanes]
            self.out[lanes, self.size[lanes]] = words >> U32
            self.size[lanes] += 1
            low[lanes] = words << U32
            width[lanes] <<= U32
        self.range[:m] = width

    def finish(self) -> list[bytes]:
        last = self.low + np.uint64(0xFFFFFFFF)
        over = last < self.low
        if over.any():
            self._carry(np.flatnonzero(over))
        self.out[np.arange(len(last)), self.size] = last >> U32
        self.size += 1
        return [row[:n].astype("<u4").tobytes() for row, n in zip(self.out, self.size, strict=True)]


class Reader:
    """Range coder lanes that give back what was put; zeros follow a payload's end."""

    def __init__(self, payloads: list[bytes]):
        lanes = len(payloads)
        self.data = np.zeros((lanes, max(len(p) // 4 for p in payloads) + 4), dtype=np.uint64)
        for row, p in zip(self.data, payloads, strict=True):
            row[: len(p) // 4] = np.frombuffer(p, dtype="<u4", count=len(p) // 4)
        self.ahead = self.data[:, 0] << U32 | self.data[:, 1]  # the code's distance from low
        self.range, self.next = np.full(lanes, 0xFFFFFFFFFFFFFFFF, dtype=np.uint64), np.full(lanes, 2, dtype=np.int64)

    def take(self, m: int, ahead: np.ndarray, width: np.ndarray) -> None:
        """Go on from ``ahead`` in a range of ``width``."""
        lanes = np.flatnonzero(width < LEAST)
        if len(lanes):
            at = self.next[lanes]
            ahead[lanes] = ahead[lanes] << U32 | self.data[lanes, np.minimum(at, self.data.shape[1] - 1)]
            self.next[lanes] = at + 1
            width[lanes] <<= U32
        self.ahead[:m], self.range[:m] = ahead, width


class Model:
    """Adaptive state of ``lanes`` blocks."""

    def __init__(self, lanes: int):
        lane = np.arange(lanes)
        self.slot_base, self.state_base = lane << SLOT_BITS, lane * len(PRIORS)
        self.offers = [np.zeros(lanes << SLOT_BITS, dtype=np.uint32) for _ in range(2)]  # id << 2 | confidence
        self.shares = np.tile(PRIORS, lanes)  # share of order 2 << 16 | share of order 1, by both confidences and their agreement
        self.before, self.earlier = np.zeros(lanes, dtype=np.uint32), np.zeros(lanes, dtype=np.uint32)

    def look(self, m: int) -> None:
        """What the contexts of the next id offer, and the shares of both in CLASS_BITS."""
        mixed = self.before[:m] * np.uint32(0x9E3779B1)
        hashes = ((mixed ^ self.earlier[:m] * np.uint32(0x85EBCA6B)) * np.uint32(0xC2B2AE35), mixed)
        self.slots = [(h >> np.uint32(32 - SLOT_BITS)) + self.slot_base[:m] for h in hashes]
        self.packed = [table.take(at) for table, at in zip(self.offers, self.slots, strict=True)]
        self.sure = [p & THREE for p in self.packed]
        self.two, self.one = (p >> TWO for p in self.packed)
        state = self.sure[0] << THREE | self.sure[1] << ONE | (self.two == self.one)
        self.rows = state + self.state_base[:m]
        self.held = self.shares.take(self.rows)
        self.size2 = (self.held >> np.uint32(32 - CLASS_BITS)) + ONE
        self.below0 = self.size2 + ((self.held & np.uint32(0xFFFF)) >> np.uint32(16 - CLASS_BITS)) + ONE

    def learn(self, m: int, found: np.ndarray, by2: np.ndarray, by1: np.ndarray) -> None:
        """Shares move towards the order that held; offers that were right gain confidence, others lose half of it or make room."""
        self.shares[self.rows] = self.held - (self.held >> RATE & RATE_MASK) + (by2 * (STEP << np.uint32(16)) + by1 * STEP)
        fresh = found << TWO
        for table, at, old, sure, offer in zip(self.offers, self.slots, self.packed, self.sure, (self.two, self.one), strict=True):
            right = offer == found
            new = old + MOVES.take(sure | right * FOUR)
            np.copyto(new, fresh, where=~right & (sure == 0))
            table[at] = new
        self.earlier[:m] = self.before[:m]
        self.before[:m] = found


def order0_sizes(levels: np.ndarray) -> np.ndarray:
    """Sizes of the buckets (blocks x BUCKETS) in ORDER0 by their levels; the largest takes what rounding leaves."""
    weights = LEVEL_WEIGHTS[levels]
    weights[weights.sum(axis=1) == 0, 0] = 1
    used = weights > 0
    sizes = used + weights * (ORDER0 - used.sum(axis=1))[:, None] // weights.sum(axis=1)[:, None]
    sizes[np.arange(len(sizes)), weights.argmax(axis=1)] += ORDER0 - sizes.sum(axis=1)
    return sizes


def order0_entries(levels: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start, size, bits and number of each bucket in one item (blocks x BUCKETS), and the sizes."""
    sizes = order0_sizes(levels)
    _, bits, _ = bucket_tables()
    starts = np.cumsum(sizes, axis=1) - sizes
    return (starts | sizes << 9 | bits[:BUCKETS] << 19 | np.arange(BUCKETS) << 24).astype(np.uint32), sizes


def fields(entry: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    return entry & np.uint32(511), entry >> np.uint32(9) & np.uint32(1023), entry >> np.uint32(19) & np.uint32(31)


#: What an order that isn't 0 does in the steps of order 0: it takes the whole range, and has no place.
WHOLE = np.uint32(ORDER0 << 9 | BUCKETS << 24)


def write_lanes(sizes: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, list[bytes]]:
    """Levels of the buckets and coded words of lanes of ``sizes`` ids (longest lane first; ids: steps x lanes)."""
    steps, n = ids.shape
    live = np.searchsorted(-sizes, -np.arange(steps), side="left").tolist()
    model = Model(n)
    size2, below0 = np.zeros((steps, n), dtype=np.uint16), np.zeros((steps, n), dtype=np.uint16)
    order = np.zeros((steps, n), dtype=np.uint8)
    for t, m in enumerate(live):
        model.look(m)
        found = ids[t, :m]
        by2 = model.two == found
        by1 = (model.one == found) & ~by2
        size2[t, :m], below0[t, :m] = model.size2, model.below0
        order[t, :m] = 2 - (by2 * np.uint8(2) + by1)
        model.learn(m, found, by2, by1)
    firsts, _, small = bucket_tables()
    bucket = small.take(ids) if not ids.size or ids.max() < len(small) else (np.searchsorted(firsts, ids, side="right") - 1).astype(np.uint8)
    # columns of ``table``: a lane's buckets, and one for what order 0 doesn't code
    bucket[order < 2] = BUCKETS
    base = np.arange(n) * (BUCKETS + 1)
    counts = np.zeros(n * (BUCKETS + 1), dtype=np.int64)
    for t, m in enumerate(live):
        counts[base[:m] + bucket[t, :m]] += 1
    levels = np.searchsorted(LEVEL_FLOORS, counts.reshape(n, -1)[:, :BUCKETS], side="right")
    table = np.column_stack([order0_entries(levels)[0], np.full(n, WHOLE)]).ravel()
    writer = Writer(n, 2 * steps + 4)
    zero = np.uint64(0)
    for t, m in enumerate(live):
        whole, kind = writer.range[:m], order[t, :m]
        unit = whole >> np.uint64(CLASS_BITS)
        first, second = unit * size2[t, :m], unit * below0[t, :m]
        start = np.where(kind == 0, zero, np.where(kind == 1, first, second))
        width = np.where(kind == 0, first, np.where(kind == 1, second, whole)) - start
        low, size, bits = fields(table.take(base[:m] + bucket[t, :m]))
        unit = width >> np.uint64(9)
        start += unit * low
        writer.put(m, start, unit * size)
        unit = writer.range[:m] >> bits
        writer.put(m, unit * (ids[t, :m] & (ONE << bits) - ONE), unit)
    return levels, writer.finish()


def read_lanes(sizes: np.ndarray, levels: np.ndarray, payloads: list[bytes]) -> np.ndarray:
    """Ids (steps x lanes) of lanes of ``sizes`` ids, longest lane first."""
    n, steps = len(sizes), int(sizes[0])
    live = np.searchsorted(-sizes, -np.arange(steps), side="left").tolist()
    entries, widths = order0_entries(levels)
    table = np.append(np.repeat(entries.ravel(), widths.ravel()), WHOLE)
    base = np.arange(n) * ORDER0
    firsts = bucket_tables()[0].astype(np.uint32)
    firsts[BUCKETS] = 0
    out = np.zeros((steps, n), dtype=np.uint32)
    model, reader = Model(n), Reader(payloads)
    zero = np.uint64(0)
    for t, m in enumerate(live):
        model.look(m)
        whole, ahead = reader.range[:m], reader.ahead[:m]
        unit = whole >> np.uint64(CLASS_BITS)
        first, second = unit * model.size2, unit * model.below0
        by2, under = ahead < first, ahead < second
        start = np.where(by2, zero, np.where(under, first, second))
        width = np.where(by2, first, np.where(under, second, whole)) - start
        ahead = ahead - start
        unit = width >> np.uint64(9)
        value = np.minimum(ahead // unit, np.uint64(ORDER0 - 1)).astype(np.int64)
        entry = table.take(np.where(under, len(table) - 1, base[:m] + value))
        low, size, bits = fields(entry)
        reader.take(m, ahead - unit * low, unit * size)
        unit = reader.range[:m] >> bits
        place = np.minimum(reader.ahead[:m] // unit, (ONE << bits) - ONE)
        reader.take(m, reader.ahead[:m] - unit * place, unit)
        found = np.where(by2, model.two, np.where(under, model.one, firsts.take(entry >> np.uint32(24)) + place.astype(np.uint32)))
        out[t, :m] = found
        model.learn(m, found, by2, under & ~by2)
    return out


def encode_blocks(blocks: list[np.ndarray]) -> list[bytes]:
    """Payloads of blocks of ids, up to BLOCK each."""
    if not blocks:
        return []
    sizes = np.array([len(b) for b in blocks])
    order = np.argsort(-sizes, kind="stable")
    if sizes.max() > BLOCK or any(len(b) and (b.min() < 0 or int(b.max()) >> ID_BITS) for b in blocks):
        raise ValueError("a block is too long, or an id out of range")
    ids = np.zeros((len(blocks), int(sizes.max())), dtype=np.uint32)
    for lane, i in enumerate(order):
        ids[lane, : sizes[i]] = blocks[i]
    levels, words = write_lanes(sizes[order], np.ascontiguousarray(ids.T))
    nibbles = (levels[:, ::2] << 4 | levels[:, 1::2]).astype(np.uint8)
    out: list[bytes] = [b""] * len(blocks)
    for i, own, body in zip(order, nibbles, words, strict=True):
        out[i] = HEAD.pack(MAGIC, sizes[i], zlib.crc32(np.ascontiguousarray(blocks[i], dtype="<u4"))) + own.tobytes() + body
    return out


def decode_blocks(payloads: list[bytes]) -> list[np.ndarray]:
    """Blocks of ids (uint32); a wrong checksum raises ValueError."""
    if not payloads:
        return []
    body = HEAD.size + BUCKETS // 2
    heads = [HEAD.unpack(p[: HEAD.size]) if len(p) >= body else (b"", 0, 0) for p in payloads]
    if any(magic != MAGIC or n > BLOCK for magic, n, _ in heads):
        raise ValueError("not a block of token ids")
    sizes = np.array([n for _, n, _ in heads])
    order = np.argsort(-sizes, kind="stable")
    nibbles = np.array([np.frombuffer(payloads[i], dtype=np.uint8, count=BUCKETS // 2, offset=HEAD.size) for i in order])
    levels = np.stack([nibbles >> 4, nibbles & 15], axis=2).reshape(len(order), BUCKETS)
    ids = read_lanes(sizes[order], levels, [payloads[i][body:] for i in order])
    columns = np.ascontiguousarray(ids.T)
    out: list[np.ndarray] = [np.zeros(0, dtype=np.uint32)] * len(payloads)
    for lane, i in enumerate(order):
        out[i] = columns[lane, : sizes[i]]
        if zlib.crc32(out[i].astype("<u4", copy=False)) != heads[i][2]:
            raise ValueError("a block's checksum is wrong")
    return out


def blocks_of(ids: np.ndarray) -> list[bytes]:
    """Payloads of a run of ids, LANES blocks at a time at most, in equal parts."""
    blocks = [ids[i : i + BLOCK] for i in range(0, len(ids), BLOCK)]
    return [p for part in _even(blocks) for p in encode_blocks(part)]


def ids_of(payloads: list[bytes]) -> np.ndarray:
    found = [b for part in _even(payloads) for b in decode_blocks(part)]
    return np.concatenate(found) if found else np.zeros(0, dtype=np.uint32)


def by_frequency(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Ids as their ranks by frequency, and the id of each rank."""
    if len(ids) and ids.max() >= 1 << 20:
        known, places, counts = np.unique(ids, return_inverse=True, return_counts=True)
    else:
        counts = np.bincount(ids, minlength=1)
        known, places = np.arange(len(counts)), ids
    order = np.argsort(-counts, kind="stable")[: np.count_nonzero(counts)]
    ranks = np.zeros(len(counts), dtype=np.uint32)
    ranks[order] = np.arange(len(order))
    return ranks.take(places), known[order].astype(np.uint32)


def of_ranks(ranks: np.ndarray, known: np.ndarray) -> np.ndarray:
    if len(ranks) and ranks.max() >= len(known):
        raise ValueError("a block holds a rank that no id has")
    return known.take(ranks)


def _even(items: list) -> list[list]:
    """Lists of LANES items at most that differ by one item at most: a step costs nearly as much for few lanes as for many."""
    parts = -(-len(items) // LANES)
    bounds = [len(items) * k // parts for k in range(parts + 1)] if parts else [0]
    return [items[a:b] for a, b in zip(bounds, bounds[1:], strict=False)]


class Runs:
    """Strings and the run of ids of each; place 0 is that of an id alone, which has no string."""

    def __init__(self):
        self.strings = [pa.array([None], pa.string())]
        self.count = 1
        self.starts, self.sizes = np.zeros(1 << 18, dtype=np.int64), np.zeros(1 << 18, dtype=np.int32)
        self.sizes[0] = 1
        self.pool, self.used = np.zeros(1 << 20, dtype=np.uint32), 1

    def __len__(self) -> int:
        return self.count

    def find(self, strings: pa.Array) -> np.ndarray:
        """Places of strings, -1 for unknown ones."""
        self.strings = [pa.concat_arrays(self.strings)]
        return pc.fill_null(pc.index_in(strings, self.strings[0]), -1).to_numpy(zero_copy_only=False).astype(np.int64)

    def add(self, strings: pa.Array, ids: np.ndarray, sizes: np.ndarray) -> None:
        total, n = len(ids), self.count
        while self.used + total > len(self.pool):
            self.pool = np.concatenate([self.pool, np.zeros_like(self.pool)])
        self.pool[self.used : self.used + total] = ids
        while n + len(strings) > len(self.starts):
            self.starts, self.sizes = (np.concatenate([x, np.zeros_like(x)]) for x in (self.starts, self.sizes))
        self.starts[n : n + len(strings)] = self.used + np.cumsum(sizes) - sizes
        self.sizes[n : n + len(strings)] = sizes
        self.strings.append(strings)
        self.count += len(strings)
        self.used += total

    def joined(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the places ``at`` one after another, and where each run ends; some places at a time."""
        ends = np.cumsum(self.sizes.take(at), dtype=np.int64)
        out = np.empty(ends[-1] if len(ends) else 0, dtype=np.uint32)
        done = 0
        for low in range(0, len(at), 1 << 17):
            some, upto = at[low : low + (1 << 17)], ends[low : low + (1 << 17)]
            sizes = self.sizes.take(some)
            places = np.repeat(self.starts.take(some) - (upto - sizes), sizes)
            places += np.arange(done, upto[-1])
            self.pool.take(places, out=out[done : upto[-1]], mode="clip")
            done = upto[-1]
        return out, ends


class PieceEncoder:
    """Ids by the library; distinct words or their pre-tokens are encoded once where the file drops white space, else texts as a whole."""

    def __init__(self, name: str):
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.tokenizer = Tokenizer.from_file(vocabulary_path(name))
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        with open(vocabulary_path(name), encoding="utf-8") as file:
            spec = json.load(file)
        self.by_words = drops_spaces(spec) and not any(any(map(str.isspace, t["content"])) for t in spec.get("added_tokens", []))
        self.specials = [t["content"] for t in spec.get("added_tokens", [])]
        steps = (spec.get("normalizer") or {}).get("normalizers", [])
        first = ((spec.get("pre_tokenizer") or {}).get("pretokenizers") or [{}])[0]
        self.joins = self.by_words and {n["type"] for n in steps} <= {"NFC", "Replace", "Lowercase"} and all(n.get("pattern") == {"Regex": r"\s+"} for n in steps if n["type"] == "Replace") and first.get("pattern") == {"Regex": PARTS} and spec["model"].get("end_of_word_suffix") == "</w>"
        marked = self.tokenizer.encode(MARK, add_special_tokens=False).ids
        self.mark = marked[0] if len(marked) == 1 else -1
        # the same model for texts that are pre-tokens in small letters with spaces between
        bare = spec | {"normalizer": None, "added_tokens": [], "pre_tokenizer": {"type": "Sequence", "pretokenizers": [{"type": "WhitespaceSplit"}, BYTES]}}
        self.joins &= self.mark >= 0 and first.get("behavior") == "Removed" and spec["pre_tokenizer"]["pretokenizers"][1:] == [BYTES]
        self.bare = Tokenizer.from_str(json.dumps(bare)) if self.joins else self.tokenizer
        vocabulary = self.tokenizer.get_vocab()
        #: tokens that end a pre-token
        self.ending = np.zeros(max(vocabulary.values(), default=0) + 1, dtype=bool)
        self.ending[[i for t, i in vocabulary.items() if t.endswith("</w>")]] = True
        self.memo = Runs()

    def _special(self, words: pa.Array) -> np.ndarray:
        if not self.specials:
            return np.zeros(len(words), dtype=bool)
        return pc.match_substring_regex(words, "(?i)" + "|".join(map(re.escape, self.specials))).to_numpy(zero_copy_only=False)

    def _units(self, words: pa.Array) -> pa.Array:
        """Lists of what each word is encoded from: plain words' pre-tokens in small letters, other words themselves."""
        plain = pa.array(pc.match_substring_regex(words, PLAIN).to_numpy(zero_copy_only=False) & ~self._special(words)) if self.joins else pa.array(np.zeros(len(words), dtype=bool))
        small = pc.utf8_lower(words.filter(plain))
        # digits are alone and an apostrophe may begin a part; else what is no letter stands between letters
        mixed = pc.match_substring_regex(small, "['0-9]")
        spaced = pc.replace_substring_regex(pc.if_else(mixed, "", small), OTHERS, r" \1 ")
        spaced = pc.replace_with_mask(spaced, mixed, pc.replace_substring_regex(small.filter(mixed), PLAIN_PARTS, r"\1 "))
        return pc.ascii_split_whitespace(pc.ascii_trim_whitespace(pc.replace_with_mask(words, plain, spaced)))

    def _learn(self, units: pa.Array) -> np.ndarray:
        """Learn new units; returns their places."""
        special = self._special(units)
        plain = pc.match_substring_regex(units, PLAIN).to_numpy(zero_copy_only=False) & ~special & self.joins
        alone = ~plain & (special | pc.match_substring(units, MARK).to_numpy(zero_copy_only=False) | (not self.joins))
        own = [np.flatnonzero(x) for x in (plain, ~plain & ~alone, alone)]
        for learn, at in zip((self._learn_parts, self._learn_marked, self._learn_alone), own, strict=True):
            learn(units.take(pa.array(at)))
        places = np.empty(len(units), dtype=np.int64)
        places[np.concatenate(own)] = np.arange(len(self.memo) - len(units), len(self.memo))
        return places

    def _encoded(self, texts: list[str], bare: bool = False) -> list[list[int]]:
        return [e.ids for e in (self.bare if bare else self.tokenizer).encode_batch_fast(texts, add_special_tokens=False)]

    def _learn_alone(self, words: pa.Array) -> None:
        runs = self._encoded(words.to_pylist())
        sizes = np.fromiter(map(len, runs), dtype=np.int64, count=len(runs))
        self.memo.add(words, np.fromiter(itertools.chain.from_iterable(runs), dtype=np.uint32, count=int(sizes.sum())), sizes)

    def _learn_parts(self, parts: pa.Array) -> None:
        """Single pre-tokens, many in a text: what ends a pre-token ends its ids."""
        for low in range(0, len(parts), 1 << 14):
            part = parts.slice(low, 1 << 14)
            ids = np.fromiter(itertools.chain.from_iterable(self._encoded(joined(part, " "), bare=True)), dtype=np.uint32)
            ends = np.flatnonzero(self.ending.take(ids)) + 1
            if len(ends) != len(part) or ends[-1] != len(ids):  # pragma: no cover  (a file that drops characters)
                self._learn_alone(part)
            else:
                self.memo.add(part, ids, np.diff(ends, prepend=0))

    def _learn_marked(self, words: pa.Array) -> None:
        """Words without MARK, many in a text with MARK after each, which no other text has the id of."""
        for low in range(0, len(words), 1 << 14):
            part = words.slice(low, 1 << 14)
            ids = np.fromiter(itertools.chain.from_iterable(self._encoded([f"{t} {MARK}" for t in joined(part, f" {MARK} ")])), dtype=np.uint32)
            marks = ids == self.mark
            if marks.sum() != len(part):  # pragma: no cover  (a file that drops the mark)
                self._learn_alone(part)
            else:
                self.memo.add(part, ids[~marks], np.diff(np.flatnonzero(marks), prepend=-1) - 1)

    def slice_ids(self, texts: pa.Array, end: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, each followed by ``end``, and the number of each."""
        if not self.by_words:
            runs = [[*ids, end] for ids in self._encoded(texts.to_pylist())]
            sizes = np.fromiter(map(len, runs), dtype=np.int64, count=len(runs))
            return np.fromiter(itertools.chain.from_iterable(runs), dtype=np.uint32, count=int(sizes.sum())), sizes
        values, offsets = common.list_parts(pc.ascii_split_whitespace(texts))
        coded = values.dictionary_encode()
        units, bounds = common.list_parts(self._units(coded.dictionary))
        parts = units.dictionary_encode()
        if len(self.memo) > MEMO:
            self.memo = Runs()
        at = self.memo.find(parts.dictionary)
        fresh = np.flatnonzero(at < 0)
        if len(fresh):
            at[fresh] = self._learn(parts.dictionary.take(pa.array(fresh)))
        ids, ends = self.memo.joined(at.take(parts.indices.to_numpy(zero_copy_only=False)))
        words = Runs()
        words.pool[0] = end
        words.add(coded.dictionary, ids, np.diff(np.append(0, ends).take(bounds)))
        at = np.insert(coded.indices.to_numpy(zero_copy_only=False).astype(np.int64) + 1, offsets[1:], 0)
        ids, ends = words.joined(at)
        return ids, np.diff(ends.take(offsets[1:] + np.arange(len(texts))), prepend=0)


def joined(words: pa.Array, between: str) -> list[str]:
    """Texts of JOINED words each."""
    bounds = np.append(np.arange(0, len(words), JOINED), len(words)).astype(np.int32)
    return pc.binary_join(pa.ListArray.from_arrays(pa.array(bounds), words), between).to_pylist()


def worker_encoder(name: str) -> PieceEncoder:
    return common.held(PieceEncoder, name)


def write_ids(documents: DataFrame, folder: str, tokenizer: str = "word_bpe_49k.json", end_id: int = 2, id_column: str = "doc_id") -> None:
    """Write all documents' ids, with the end id after each, in ascending order of their ids."""
    rows = common.plain_names(documents, id_column, "text").toDF("id", "text")
    kind = rows.schema["id"].dataType.simpleString()
    total = rows.agg(F.sum(F.coalesce(F.octet_length("text"), F.lit(0)) + 16)).first()[0] or 0
    parts = max(1, -(-total // PART_BYTES))

    def encoded(batches):
        from pyspark import TaskContext

        part, chunk, done = TaskContext.get().partitionId(), 0, 0
        encoder = worker_encoder(tokenizer)
        ids, counts, runs = [], [], []
        names = ["part", "chunk", "offset", "n_ids", "doc_ids", "counts", "by_rank", "blocks"]

        def close():
            nonlocal chunk, done, ids, counts, runs
            flat = np.concatenate(runs)
            ranks, known = by_frequency(flat)
            columns = [[part], [chunk], [done], [len(flat)], [pa.concat_arrays(ids)], [np.concatenate(counts)], [known.astype(np.int32)], [blocks_of(ranks)]]
            kinds = [pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.list_(ids[0].type), pa.list_(pa.int64()), pa.list_(pa.int32()), pa.list_(pa.binary())]
            chunk, done, ids, counts, runs = chunk + 1, done + len(flat), [], [], []
            return pa.RecordBatch.from_arrays([pa.array([c.to_pylist() if isinstance(c, pa.Array) else c for c in col], k) for col, k in zip(columns, kinds, strict=True)], names)

        held = 0
        for batch in common.text_slices(batches, limit=8 << 20):
            found, sizes = encoder.slice_ids(pc.fill_null(common.column(batch, "text"), ""), end_id)
            ids.append(common.column(batch, "id"))
            counts.append(sizes)
            runs.append(found)
            held += len(found)
            if held >= CHUNK_IDS:
                yield close()
                held = 0
        if held:
            yield close()

    # rows of one id are told apart by a hash and their place, so that no id is bound to one part
    keyed = rows.withColumn("hash", F.xxhash64("text")).withColumn("row", F.monotonically_increasing_id())
    dealt = keyed.repartitionByRange(parts, "id", "hash", "row").sortWithinPartitions("id", "hash", "row").select("id", "text")
    dealt.mapInArrow(encoded, f"part int, chunk int, offset long, n_ids long, doc_ids array<{kind}>, counts array<long>, by_rank array<int>, blocks array<binary>").write.parquet(folder)


def starts_of(chunks: DataFrame) -> DataFrame:
    """(part, base): ids of all parts before; sums run in groups of 1024 parts and over the groups' totals."""
    totals = chunks.groupBy("part").agg(F.sum("n_ids").alias("own")).withColumn("group", F.shiftright("part", 10))
    groups = totals.groupBy("group").agg(F.sum("own").alias("own"))
    groups = groups.select("group", (F.sum("own").over(Window.orderBy("group")) - F.col("own")).alias("before"))
    within = F.sum("own").over(Window.partitionBy("group").orderBy("part")) - F.col("own")
    return totals.select("part", "group", within.alias("within")).join(groups, "group").select("part", (F.col("within") + F.col("before")).alias("base"))


def read_digests(spark: SparkSession, folder: str, id_column: str = "doc_id") -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) from the files alone."""
    chunks = spark.read.parquet(folder)
    kind = chunks.schema["doc_ids"].dataType.elementType.simpleString()

    def decoded(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                part, offset, blocks, counts = (common.column(batch, c)[i].as_py() for c in ("part", "offset", "blocks", "counts"))
                known = common.column(batch, "by_rank")[i].values.to_numpy(zero_copy_only=False).astype(np.uint32)
                raw = of_ranks(ids_of(blocks), known).astype("<u4", copy=False)
                ends = np.cumsum(counts)
                if ends[-1] != len(raw):
                    raise ValueError("a chunk's blocks don't hold its documents")
                view, starts = memoryview(raw).cast("B"), ends - counts
                sums = [zlib.crc32(view[4 * a : 4 * b]) for a, b in zip(starts.tolist(), ends.tolist(), strict=True)]
                n = len(counts)
                columns = [pa.array([part] * n, pa.int32()), common.column(batch, "doc_ids")[i].values, pa.array(starts + offset), pa.array(counts, pa.int64()), pa.array(sums, pa.int64())]
                yield pa.RecordBatch.from_arrays(columns, ["part", "id", "offset", "n_tokens", "ids_crc32"])

    found = chunks.select("part", "offset", "doc_ids", "counts", "by_rank", "blocks").mapInArrow(decoded, f"part int, id {kind}, offset long, n_tokens long, ids_crc32 long")
    return found.join(starts_of(chunks), "part").select(F.col("id").alias(id_column), (F.col("base") + F.col("offset")).alias("start"), "n_tokens", "ids_crc32")


def written_digests(documents: DataFrame, tokenizer: str = "word_bpe_49k.json", end_id: int = 2, id_column: str = "doc_id") -> DataFrame:
    """Write the ids below the shared folder, and digests of what is read back."""
    spark = documents.sparkSession
    folder = f"{common.shared_folder(spark)}/token-ids-{uuid.uuid4().hex}"
    write_ids(documents, folder, tokenizer, end_id, id_column)
    return read_digests(spark, folder, id_column)
