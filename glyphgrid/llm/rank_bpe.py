"""Byte-level BPE encoding and decoding with contiguous rank arrays.

A short word is a row of parts with the merge rank of each adjacent pair beside
them. The encoder scans the ranks for the minimum, deletes that boundary and
refreshes the two neighbouring ranks, until no pair can merge. The rows of many
distinct words stand in one matrix, so each scan, deletion and refresh is a
whole-array step over all of them. Words over ``SHORT`` bytes take the same
merges in the same order from a heap, as repeated scans are quadratic there.
Ids of words stay in a bounded pool per worker.

Defined results: null encodes as empty text (no ids); repeated rows each get
their own row; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import heapq
import itertools
import json
import os
import re
from hashlib import sha256

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from . import common, pieces

SHORT = 64
NONE = 1 << 30
#: Distinct words held by one worker before its pool is emptied.
POOL_WORDS = 400_000


def vocabulary_path(name: str) -> str:
    """A path as given, or the place of a public tokenizer file by its name."""
    if os.path.sep in name:
        return name
    import public_tokenizers

    return public_tokenizers.path(name)


def printable_bytes() -> dict[str, int]:
    """The alphabet of byte-level vocabularies: printable Latin-1 bytes stand for themselves, others follow from U+0100."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


class RankArrayBPE:
    """Encoder and decoder over a ``tokenizers`` byte-level BPE file."""

    def __init__(self, name: str = "byte_bpe_50k.json", pool_words: int = POOL_WORDS):
        with open(vocabulary_path(name), encoding="utf-8") as file:
            spec = json.load(file)
        alphabet = printable_bytes()
        vocab = spec["model"]["vocab"]
        self.specials = {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
        self.special_split = re.compile("(" + "|".join(map(re.escape, sorted(self.specials, key=len, reverse=True))) + ")") if self.specials else None
        self.bytes_of: dict[int, bytes] = {i: bytes(alphabet[c] for c in token) for token, i in vocab.items()} | {i: content.encode() for content, i in self.specials.items()}
        self.byte_ids = np.zeros(256, dtype=np.int64)
        for char, b in alphabet.items():
            self.byte_ids[b] = vocab[char]
        pairs: dict[int, tuple[int, int]] = {}
        for rank, merge in enumerate(spec["model"]["merges"]):
            left, right = merge if isinstance(merge, list) else merge.split(" ")
            pairs.setdefault(vocab[left] << 32 | vocab[right], (rank, vocab[left + right]))
        self.keys = np.array(sorted(pairs), dtype=np.int64)
        self.ranks = np.array([pairs[k][0] for k in self.keys.tolist()] + [NONE], dtype=np.int64)
        #: Id after the merge of a rank.
        self.merged = np.full(max(r for r, _ in pairs.values()) + 1, -1, dtype=np.int64)
        for rank, new in pairs.values():
            self.merged[rank] = new
        self.rank_of = {k: r for k, (r, _) in pairs.items()}
        self.limit = pool_words
        self._empty_pool()

    def _empty_pool(self) -> None:
        self.index: dict[str, int] = {}
        self.starts = self.sizes = np.zeros(0, dtype=np.int64)
        self.pool = np.zeros(0, dtype=np.uint32)

    def pair_ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Merge ranks of adjacent parts; NONE where no merge exists or a part is missing (-1)."""
        key = left << 32 | right
        at = np.searchsorted(self.keys, key)
        at[at == len(self.keys)] = 0
        return np.where((self.keys[at] == key) & (right >= 0), self.ranks[at], NONE)

    def merge_rows(self, raw: list[bytes]) -> np.ndarray:
        """Ids of words of at most SHORT bytes, one row each, -1 after a row's end."""
        sizes = np.fromiter(map(len, raw), dtype=np.int64, count=len(raw))
        width = int(sizes.max())
        live = np.arange(width) < sizes[:, None]
        ids = np.full((len(raw), width + 1), -1, dtype=np.int64)
        ids[:, :width][live] = self.byte_ids[np.frombuffer(b"".join(raw), dtype=np.uint8)]
        out = np.full((len(raw), width), -1, dtype=np.int64)
        ranks = self.pair_ranks(ids[:, :-1], ids[:, 1:])
        rows = np.arange(len(raw))
        while len(rows):
            at = ranks.argmin(axis=1)
            own = np.arange(len(rows))
            low = ranks[own, at]
            done = low == NONE
            if done.any():
                out[rows[done], : ids.shape[1] - 1] = ids[done, :-1]
                rows, ids, ranks, at, low = rows[~done], ids[~done], ranks[~done], at[~done], low[~done]
                if not len(rows):
                    break
                own = np.arange(len(rows))
            columns = np.arange(ids.shape[1] - 1)
            ids[own, at] = self.merged[low]
            ids = np.take_along_axis(ids, columns + (columns > at[:, None]), axis=1)
            ranks = np.take_along_axis(ranks, columns[:-1] + (columns[:-1] >= at[:, None]), axis=1)
            if not ranks.shape[1]:
                out[rows, :1] = ids[:, :1]
                break
            before = np.maximum(at - 1, 0)
            ranks[own, before] = np.where(at > 0, self.pair_ranks(ids[own, before], ids[own, before + 1]), ranks[own, before])
            after = np.minimum(at, ranks.shape[1] - 1)
            ranks[own, after] = np.where(at == after, self.pair_ranks(ids[own, after], ids[own, after + 1]), ranks[own, after])
        return out

    def merge_long(self, raw: bytes) -> list[int]:
        ids = self.byte_ids[np.frombuffer(raw, dtype=np.uint8)].tolist()
        n = len(ids)
        after, before, alive = list(range(1, n + 1)), list(range(-1, n - 1)), bytearray(b"\1") * n
        heap = [(self.rank_of[k], i, k) for i in range(n - 1) if (k := ids[i] << 32 | ids[i + 1]) in self.rank_of]
        heapq.heapify(heap)
        while heap:
            rank, i, key = heapq.heappop(heap)
            j = after[i]
            if not alive[i] or j >= n or ids[i] << 32 | ids[j] != key:
                continue
            ids[i], alive[j], after[i] = int(self.merged[rank]), 0, after[j]
            if after[j] < n:
                before[after[j]] = i
            for a, b in ((before[i], i), (i, after[i])):
                if a >= 0 and b < n and (k := ids[a] << 32 | ids[b]) in self.rank_of:
                    heapq.heappush(heap, (self.rank_of[k], a, k))
        return [x for x, kept in zip(ids, alive, strict=True) if kept]

    def _learn(self, words: list[str]) -> None:
        """Put the ids of new distinct words in the pool."""
        raw = [w.encode() for w in words]
        sizes = np.fromiter(map(len, raw), dtype=np.int64, count=len(raw))
        order = np.argsort(sizes, kind="stable")
        blocks, counts = [], []
        cut = int(np.searchsorted(sizes[order], SHORT, side="right"))
        for low in range(0, cut, 8192):  # words of like length share a matrix
            rows = self.merge_rows([raw[i] for i in order[low : min(low + 8192, cut)]])
            kept = rows >= 0
            blocks.append(rows[kept])
            counts.append(kept.sum(axis=1))
        for i in order[cut:]:
            ids = self.merge_long(raw[i])
            blocks.append(np.array(ids))
            counts.append(np.array([len(ids)]))
        sizes = np.concatenate(counts)
        starts = len(self.pool) + np.cumsum(sizes) - sizes
        n = len(self.starts)
        self.index.update((words[i], n + k) for k, i in enumerate(order))
        self.starts, self.sizes = np.concatenate([self.starts, starts]), np.concatenate([self.sizes, sizes])
        self.pool = np.concatenate([self.pool, *(b.astype(np.uint32) for b in blocks)])

    def lookup(self, words: list[str]) -> np.ndarray:
        """Places of words in the pool, new ones encoded first."""
        if len(self.index) > self.limit:
            self._empty_pool()
        get = self.index.get
        found = np.fromiter(map(get, words, itertools.repeat(-1)), dtype=np.int64, count=len(words))
        missing = np.flatnonzero(found < 0)
        if len(missing):
            self._learn(list(dict.fromkeys(words[i] for i in missing)))
            found[missing] = [self.index[words[i]] for i in missing]
        return found

    def encode_slice(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, flat (uint32), and each text's offsets into them."""
        parts = pieces.Slice(texts, list(self.specials))
        at = self.lookup(parts.words)
        word_sizes = self.sizes[at]
        ends = np.concatenate([[0], np.cumsum(parts.sizes)])
        piece_sizes = common.segment_sums(word_sizes, ends)
        local = self.pool[pieces.gather(self.starts[at], word_sizes)]  # ids of the slice's distinct pieces
        piece_starts = np.cumsum(piece_sizes) - piece_sizes
        sizes = piece_sizes[parts.codes]
        flat = local[pieces.gather(piece_starts[parts.codes], sizes)]
        offsets = np.concatenate([[0], np.cumsum(sizes)])[parts.offsets]
        if not len(parts.whole):
            return flat, offsets
        runs = [flat[a:b] for a, b in zip(offsets, offsets[1:], strict=False)]
        for i in parts.whole:
            runs[i] = self.encode(texts[int(i)].as_py())
        return np.concatenate(runs), np.cumsum([0, *map(len, runs)])

    def encode(self, text: str) -> np.ndarray:
        """Ids of one text, split as a whole."""
        runs = []
        for part in self.special_split.split(text) if self.special_split else [text]:
            if part in self.specials:
                runs.append(np.array([self.specials[part]], dtype=np.uint32))
            elif part:
                at = self.lookup(pieces.find_words(part))
                runs.append(self.pool[pieces.gather(self.starts[at], self.sizes[at])])
        return np.concatenate(runs) if runs else np.zeros(0, dtype=np.uint32)

    def decode(self, ids) -> str:
        """Text of ids; bytes that aren't UTF-8 become U+FFFD."""
        return b"".join(map(self.bytes_of.__getitem__, ids)).decode("utf-8", "replace")


def worker_coder(name: str) -> RankArrayBPE:
    """One coder a worker, so that its memo outlives a task."""
    return common.held(RankArrayBPE, name)


def id_lists(flat: np.ndarray, offsets: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(flat.astype(np.int32)))


def encode_documents(documents: DataFrame, tokenizer: str = "byte_bpe_50k.json", id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(id, ids array<int>) of every whole text."""

    def encoded(batches):
        coder = worker_coder(tokenizer)
        for batch in common.text_slices(batches, "text"):
            flat, offsets = coder.encode_slice(pc.fill_null(common.column(batch, "text"), ""))
            yield pa.RecordBatch.from_arrays([common.column(batch, "id"), id_lists(flat, offsets)], ["id", "ids"])

    kind = documents.schema[id_column].dataType.simpleString()
    rows = common.plain_names(documents, id_column, text_column).toDF("id", "text")
    return rows.mapInArrow(encoded, f"id {kind}, ids array<int>").withColumnRenamed("id", id_column)


def decode_documents(encoded: DataFrame, tokenizer: str = "byte_bpe_50k.json", id_column: str = "doc_id", ids_column: str = "ids") -> DataFrame:
    """(id, text) of ids; null ids give empty text."""

    def decoded(batches):
        coder = worker_coder(tokenizer)
        for batch in batches:
            texts = [coder.decode(ids or ()) for ids in common.column(batch, "ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([common.column(batch, "id"), pa.array(texts, pa.string())], ["id", "text"])

    kind = encoded.schema[id_column].dataType.simpleString()
    rows = common.plain_names(encoded, id_column, ids_column).toDF("id", "ids")
    return rows.mapInArrow(decoded, f"id {kind}, text string").withColumnRenamed("id", id_column)


def round_trip_digests(documents: DataFrame, tokenizer: str = "byte_bpe_50k.json", id_column: str = "doc_id", text_column: str = "text", keep_ids: bool = False) -> DataFrame:
    """Encode, then decode the ids, in one pass: (id, n_tokens, ids_sha256, decoded_sha256[, ids])."""

    def digests(batches):
        coder = worker_coder(tokenizer)
        for batch in common.text_slices(batches, "text", limit=4 << 20):
            flat, offsets = coder.encode_slice(pc.fill_null(common.column(batch, "text"), ""))
            runs = [flat[a:b] for a, b in zip(offsets, offsets[1:], strict=False)]
            left = [sha256(r.astype("<u4").tobytes()).hexdigest() for r in runs]
            right = [sha256(coder.decode(r.tolist()).encode()).hexdigest() for r in runs]
            columns = [common.column(batch, "id"), pa.array(np.diff(offsets)), pa.array(left, pa.string()), pa.array(right, pa.string())]
            yield pa.RecordBatch.from_arrays([*columns, id_lists(flat, offsets)][: len(names)], names)

    names = ["id", "n_tokens", "ids_sha256", "decoded_sha256", *["ids"] * keep_ids]
    kind = documents.schema[id_column].dataType.simpleString()
    rows = common.plain_names(documents, id_column, text_column).toDF("id", "text")
    return rows.mapInArrow(digests, f"id {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string{', ids array<int>' * keep_ids}").withColumnRenamed("id", id_column)
