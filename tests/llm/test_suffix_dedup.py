"""Removal of repeated strings against a plain count of all windows; suffix arrays against sorting."""

import tracemalloc
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from glyphgrid.llm import suffix_dedup
from glyphgrid.llm.suffix_array import suffix_array

WIDTH = 400


def plain(texts: list) -> list[tuple[int, list, bytes]]:
    """(bytes, removed spans, kept bytes) of each text."""
    data = [(t or "").encode() for t in texts]
    counts = Counter(d[i : i + WIDTH] for d in data for i in range(len(d) - WIDTH + 1))
    out = []
    for d in data:
        gone = np.zeros(len(d) + 2, dtype=int)
        for i in range(len(d) - WIDTH + 1):
            if counts[d[i : i + WIDTH]] > 1:
                gone[i + 1] += 1
                gone[i + WIDTH + 1] -= 1
        flags = np.cumsum(gone)[:-1] > 0
        edges = np.flatnonzero(np.diff(np.append(flags, False).astype(int)))
        spans = [tuple(e) for e in edges.reshape(-1, 2).tolist()]
        out.append((len(d), spans, bytes(b for b, f in zip(d, flags[1:], strict=True) if not f)))
    return out


def corpus() -> list:
    draw = np.random.default_rng(8)
    words = ["".join(draw.choice(list("abcdefghé中"), size=draw.integers(1, 9))) for _ in range(400)]

    def prose(n: int) -> str:
        return " ".join(draw.choice(words, size=n))

    base = [prose(500) for _ in range(4)]
    out = [None, "", "short", "x" * 399, "x" * 400, "x" * 401, "y" * 2000, "ab" * 900, base[0], base[0], base[1], base[0][:399] + "!", base[1][7:420], "z" * 200 + base[2][:700]]
    for k in range(90):  # near copies and passages inside other texts
        text = base[k % 4]
        a = int(draw.integers(0, 800))
        text = prose(int(draw.integers(0, 40))) + text[a : a + int(draw.integers(380, 1800))] + prose(int(draw.integers(0, 40)))
        for _ in range(k % 3):
            at = int(draw.integers(0, len(text)))
            text = text[:at] + "~" + text[at:]
        out.append(text)
    twice = prose(80)
    return [*out, prose(30) + twice + prose(50) + twice, prose(4000), *[prose(200) for _ in range(10)]]


TEXTS = corpus()
WANT = plain(TEXTS)


@pytest.mark.parametrize("crowd", [suffix_dedup.CROWD, 8, 1])
def test_repeats(spark, crowd):
    """Also where nearly all keys are crowded and cut into finer pieces and single windows."""
    rows = [(i if i % 13 else None, t, i, "c") for i, t in enumerate(TEXTS)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, key int, spans string").repartition(5)
    got = suffix_dedup.remove_repeats(frame, WIDTH, crowd).collect()
    shown = lambda rows: sorted((-1 if i is None else i, n, spans, kept) for i, n, spans, kept in rows)
    assert shown((r.doc_id, r.n_bytes, [tuple(s) for s in r.spans], bytes(r.kept)) for r in got) == shown((i if i % 13 else None, *w) for i, w in enumerate(WANT))


def test_plain_and_empty_tables(spark):
    frame = spark.createDataFrame(list(enumerate(TEXTS)), "doc_id long, text string")
    got = {r.doc_id: [tuple(s) for s in r.spans] for r in suffix_dedup.remove_repeats(frame).collect()}
    assert got == {i: w[1] for i, w in enumerate(WANT)}
    assert suffix_dedup.remove_repeats(frame.where(F.lit(False))).count() == 0
    assert [len(r.spans) for r in suffix_dedup.remove_repeats(frame.where("doc_id < 3")).collect()] == [0, 0, 0]


def test_suffix_array():
    draw = np.random.default_rng(1)
    for _ in range(400):
        text = [*draw.integers(1, int(draw.integers(2, 6)), size=int(draw.integers(0, 80))).tolist(), 0]
        assert suffix_array(np.array(text)) == sorted(range(len(text)), key=lambda i: text[i:])
    word, before = [1, 2], [1]
    while len(word) < 900:
        word, before = word + before, word
    for text in ([1] * 2000, word, list(range(1, 2000)), list(range(2000, 0, -1)), [*word, 1, *word, 1, *word]):
        assert suffix_array(np.array([*text, 0])) == sorted(range(len(text) + 1), key=lambda i: [*text, 0][i:])


def test_windows_by_suffix_array():
    parts = [t.encode() for t in TEXTS if t and len(t.encode()) >= WIDTH]
    counts = Counter(p[i : i + WIDTH] for p in parts for i in range(len(p) - WIDTH + 1))
    want = [counts[p[i : i + WIDTH]] > 1 for p in parts for i in range(len(p) - WIDTH + 1)]
    assert suffix_dedup.repeated_windows(parts, WIDTH).tolist() == want


def test_a_worker_holds_little_beside_its_batch():
    class Rows:
        mapInArrow = staticmethod(lambda function, schema: function)

    draw = np.random.default_rng(4)
    texts = ["".join(map(chr, draw.integers(97, 123, 2000))) for _ in range(2000)]
    batch = pa.RecordBatch.from_arrays([pa.array(range(2000)), pa.array(range(2000)), pa.array(texts)], ["d1", "d2", "text"])
    find = suffix_dedup.text_pieces(Rows, WIDTH)
    tracemalloc.start()
    rows = sum(b.num_rows for b in find([batch]))
    suffix_dedup.repeated_windows([t.encode() for t in texts[:600]], WIDTH)
    held, peak = tracemalloc.get_traced_memory()
    tracemalloc.stop()
    assert rows == 2000
    assert held < 24 << 20  # tables of powers: up to 128 MB a worker before
    assert peak < 160 << 20
