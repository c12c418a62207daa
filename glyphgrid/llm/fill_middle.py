"""Fill-in-the-middle transformation of whole texts over ropes.

A text is a rope: a balanced tree whose leaves are ranges of the slice's UTF-8
bytes and whose nodes cache counts of units (a word with the white space before
it, or white space at the end), code points and bytes. Two splits by unit rank
give prefix, middle and suffix; the subtrees are joined with sentinel leaves in
the order of the form. The inverse splits the output's rope by code-point rank
around the sentinels and joins the parts again.

Defined results: a null text is an empty one, which stays plain; a null id draws
as the empty string does; repeated rows give the same row each; a text that holds
a sentinel stays plain, so sentinels of an output are unique; very long texts are
cut into leaves of ``LEAF`` bytes, a longer unit is one leaf; an empty table gives
no row; only the id and text columns are read, so other columns can't clash.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from . import common

#: Marks of the three parts in an output.
SENTINELS = {"prefix": "<P>", "suffix": "<S>", "middle": "<M>"}
#: Bytes of a rope's leaf, at unit ends.
LEAF = 4096
#: ASCII white space that parts words.
SPACES = [0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]
_IS_SPACE = np.isin(np.arange(256), SPACES)


class Source:
    """Bytes that leaves refer to, with the ends of their units and a running count of code points."""

    def __init__(self, data: np.ndarray, ends: np.ndarray):
        self.bytes = data.tobytes()
        self.ends = ends
        self.chars = np.zeros(len(data) + 1, dtype=np.int32)
        np.cumsum((data & 0xC0) != 0x80, out=self.chars[1:], dtype=np.int32)


class Leaf:
    """Bytes a to b of a source, which holds its units u to v."""

    __slots__ = ("source", "a", "b", "u", "v", "units", "chars", "size")

    def __init__(self, source: Source, a: int, b: int, u: int, v: int):
        self.source, self.a, self.b, self.u, self.v = source, a, b, u, v
        self.units, self.size = v - u, b - a
        self.chars = int(source.chars[b]) - int(source.chars[a])

    def cut(self, rank: int, by: str):
        if by == "units":
            at, u = int(self.source.ends[self.u + rank - 1]), self.u + rank
        else:  # a cut inside a unit leaves that unit on the right
            at = int(np.searchsorted(self.source.chars[self.a : self.b + 1], self.source.chars[self.a] + rank, side="right")) - 1 + self.a
            u = int(np.searchsorted(self.source.ends[self.u : self.v], at, side="right")) + self.u
        return Leaf(self.source, self.a, at, self.u, u), Leaf(self.source, at, self.b, u, self.v)


class Branch:
    __slots__ = ("left", "right", "units", "chars", "size")

    def __init__(self, left, right):
        self.left, self.right = left, right
        self.units, self.chars, self.size = left.units + right.units, left.chars + right.chars, left.size + right.size


def join(left, right):
    """One rope of two; None stands for the empty rope."""
    return left if right is None else right if left is None else Branch(left, right)


def split(rope, rank: int, by: str = "units"):
    """The rope's first ``rank`` units (or code points, by ``chars``) and the rest."""
    if rope is None or rank <= 0:
        return None, rope
    if rank >= getattr(rope, by):
        return rope, None
    if isinstance(rope, Leaf):
        return rope.cut(rank, by)
    within = getattr(rope.left, by)
    if rank <= within:
        a, b = split(rope.left, rank, by)
        return a, join(b, rope.right)
    a, b = split(rope.right, rank - within, by)
    return join(rope.left, a), b


def balanced(leaves: list):
    """A rope of log depth over leaves."""
    if not leaves:
        return None
    while len(leaves) > 1:
        leaves = [Branch(*leaves[i : i + 2]) if i + 1 < len(leaves) else leaves[i] for i in range(0, len(leaves), 2)]
    return leaves[0]


def flat(rope) -> bytes:
    """The rope's bytes, in order."""
    out, stack = [], [rope] if rope is not None else []
    while stack:
        node = stack.pop()
        if isinstance(node, Leaf):
            out.append(node.source.bytes[node.a : node.b])
        else:
            stack += (node.right, node.left)
    return b"".join(out)


class Texts:
    """Ropes over the texts of one Arrow slice."""

    def __init__(self, texts: pa.Array):
        held = pa.concat_arrays([texts.cast(pa.large_binary())])
        offsets = np.frombuffer(held.buffers()[1], dtype=np.int64, count=len(held) + 1 + held.offset)[held.offset :]
        whole = held.buffers()[2]
        data = np.frombuffer(whole, dtype=np.uint8)[offsets[0] : offsets[-1]] if whole is not None else np.zeros(0, dtype=np.uint8)
        self.offsets = offsets - offsets[0]
        space = _IS_SPACE[data]
        is_end = ~space  # a unit ends after a word's last byte, and at the end of a text
        is_end[:-1] &= space[1:]
        last = self.offsets[1:][np.diff(self.offsets) > 0] - 1
        is_end[last] = True
        # a word's end must not run over into the next text
        self.source = Source(data, np.flatnonzero(is_end) + 1)
        self.firsts = np.searchsorted(self.source.ends, self.offsets, side="right")

    def rope(self, i: int):
        a, b = int(self.offsets[i]), int(self.offsets[i + 1])
        u, v = int(self.firsts[i]), int(self.firsts[i + 1])
        if b - a <= LEAF:
            return Leaf(self.source, a, b, u, v) if b > a else None
        ends = self.source.ends[u:v]
        picks = np.unique(np.minimum(np.searchsorted(ends, np.arange(a + LEAF, b, LEAF)), len(ends) - 1))
        picks = np.unique(np.append(picks, len(ends) - 1))
        leaves, at, first = [], a, u
        for pick in picks.tolist():
            leaves.append(Leaf(self.source, at, int(ends[pick]), first, u + pick + 1))
            at, first = int(ends[pick]), u + pick + 1
        return balanced(leaves)


def _mark(text: str) -> Leaf:
    data = np.frombuffer(text.encode(), dtype=np.uint8)
    return Leaf(Source(data, np.array([len(data)])), 0, len(data), 0, 1)


def draws(seed: int, key) -> list[int]:
    """Four unsigned 32-bit draws of a document."""
    digest = hashlib.sha256(f"{seed}:{'' if key is None else key}".encode()).hexdigest()
    return [int(digest[k : k + 8], 16) for k in range(0, 32, 8)]


def rearranged(rope, key, holds_mark: bool, marks: dict[str, Leaf], seed: int, rate: int, spm: int):
    """(output rope, form, code points of prefix and middle) of one text."""
    n = rope.units if rope is not None else 0
    first, second, chance, order = draws(seed, key)
    if rope is None or holds_mark or chance % 100 >= rate:
        return rope, "plain", None, None
    low, high = sorted((first % (n + 1), second % (n + 1)))
    head, suffix = split(rope, high)
    prefix, middle = split(head, low)
    form = "spm" if order % 100 < spm else "psm"
    parts = {"prefix": prefix, "suffix": suffix, "middle": middle}
    out = None
    for name in ("suffix", "prefix", "middle") if form == "spm" else ("prefix", "suffix", "middle"):
        out = join(join(out, marks[name]), parts[name])
    return out, form, prefix.chars if prefix is not None else 0, middle.chars if middle is not None else 0


def restored(rope, text: bytes, form: str):
    """The rope from before: parts around the sentinels of an output, split out by code-point rank."""
    if form == "plain" or rope is None:
        return rope
    names = ("suffix", "prefix", "middle") if form == "spm" else ("prefix", "suffix", "middle")
    parts, rest = {}, rope
    # from the last sentinel to the first: what follows it is its part
    for name in reversed(names):
        mark = SENTINELS[name]
        at = text.rfind(mark.encode(), 0, rest.size)
        before = len(text[:at].decode())
        rest, tail = split(rest, before, "chars")
        _, parts[name] = split(tail, len(mark), "chars")
    return join(join(parts["prefix"], parts["middle"]), parts["suffix"])


def _binary(values: list[bytes]) -> pa.Array:
    return pa.array(values, pa.binary()).cast(pa.string())


def transform(documents: DataFrame, seed: int = 42, rate: int = 50, spm: int = 80, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(id, n units, form, prefix_chars, middle_chars, output) of every text; a narrow plan.

    ``rate`` of 100 texts are rearranged, ``spm`` of 100 of these with the suffix first.
    """

    def made(batches):
        marks = {name: _mark(text) for name, text in SENTINELS.items()}
        for batch in common.text_slices(batches, "text"):
            texts = pc.fill_null(common.column(batch, "text"), "")
            holds = np.zeros(len(texts), dtype=bool)
            for mark in SENTINELS.values():
                holds |= pc.match_substring(texts, mark).to_numpy(zero_copy_only=False)
            ropes = Texts(texts)
            rows = []
            for i, (key, held) in enumerate(zip(common.column(batch, "id").to_pylist(), holds.tolist(), strict=True)):
                rope = ropes.rope(i)
                out, *about = rearranged(rope, key, held, marks, seed, rate, spm)
                rows.append((rope.units if rope is not None else 0, *about, flat(out)))
            n, form, prefix, middle, output = zip(*rows, strict=True)
            yield pa.RecordBatch.from_arrays([common.column(batch, "id"), pa.array(n, pa.int64()), pa.array(form, pa.string()), pa.array(prefix, pa.int64()), pa.array(middle, pa.int64()), _binary(list(output))], ["id", "n", "form", "prefix_chars", "middle_chars", "output"])

    kind = documents.schema[id_column].dataType.simpleString()
    rows = common.plain_names(documents, id_column, text_column).toDF("id", "text")
    return rows.mapInArrow(made, f"id {kind}, n long, form string, prefix_chars long, middle_chars long, output string").withColumnRenamed("id", id_column)


def restore(made: DataFrame) -> DataFrame:
    """Rows of ``transform`` with the text rebuilt from output and form alone, as ``restored``."""

    def rebuilt(batches):
        for batch in common.text_slices(batches, "output"):
            outputs = common.column(batch, "output")
            ropes = Texts(outputs)
            back = []
            for i, form in enumerate(common.column(batch, "form").to_pylist()):
                whole = ropes.source.bytes[int(ropes.offsets[i]) : int(ropes.offsets[i + 1])]
                back.append(flat(restored(ropes.rope(i), whole, form)))
            yield pa.RecordBatch.from_arrays([*batch.columns, _binary(back)], [*batch.schema.names, "restored"])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in made.schema)
    return made.mapInArrow(rebuilt, f"{schema}, restored string")
