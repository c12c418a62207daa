"""Periodic runs against all periods of each text; fill-in-the-middle against plain slicing."""

import hashlib
import re

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from glyphgrid.llm import fill_middle, periodic_runs, queries

WORD = re.compile(r"[^\x20\x09-\x0D]+")
UNIT = re.compile(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+")


def plain_runs(words: list, least: int = 12) -> list[tuple[int, int, int]]:
    """(start, length, smallest period) of all runs, by trying every period."""
    found: dict = {}
    for q in range(1, len(words) // 2 + 1):
        at = 0
        while at + q < len(words):
            stop = at
            while stop + q < len(words) and words[stop] == words[stop + q]:
                stop += 1
            length = stop + q - at
            if stop > at and length >= max(least, 2 * q):
                found.setdefault((at, length), q)
            at = stop + 1
    return sorted((s, n, q) for (s, n), q in found.items())


def collapsed(words: list, runs: list) -> str:
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


def texts() -> list:
    draw = np.random.default_rng(11)
    out = [None, "", " ", "a", "a " * 11, "a " * 12, "\n a" * 500, "x" * 5000, "ab " * 7 + "ab", "é 中 " * 20 + "é", "a\x0bb\x0cc\x1fd e f " * 9, "a b c d e f a b c d e f g"]
    for k in range(120):
        words = draw.choice(list("abc"[: 1 + k % 3]) + ["dd"] * (k % 2), size=int(draw.integers(5, 90))).tolist()
        block = draw.choice(list("abcdefgh"), size=int(draw.integers(1, 30))).tolist()
        words[len(words) // 2 : len(words) // 2] = block * int(draw.integers(1, 6))
        out.append(" ".join(words))
    fib = ["a", "b"]
    while len(fib) < 400:
        fib = fib + fib[: len(fib) * 2 // 3]
    a, b = ["a"], ["a", "b"]
    while len(b) < 500:
        a, b = b, b + a
    thue = [str(bin(i).count("1") % 2) for i in range(700)]
    return [*out, " ".join(fib), " ".join(b), " ".join(thue), " ".join(thue * 3)]


TEXTS = texts()


@pytest.fixture(scope="module")
def frame(spark):
    rows = [(i if i % 17 else None, t, 1, "z") for i, t in enumerate(TEXTS)] + [(3, "a " * 40, 1, "z")] * 2
    return spark.createDataFrame(rows, "doc_id long, text string, runs int, id string")


def test_runs(frame):
    want = sorted((r.doc_id or -1, plain_runs(w := WORD.findall(r.text or "")), collapsed(w, plain_runs(w)), len(w)) for r in frame.collect())
    got = sorted((r.doc_id or -1, [tuple(x) for x in r.runs], r.collapsed, r.n_words) for r in periodic_runs.runs(frame).collect())
    assert got == want
    assert periodic_runs.runs(frame.where("false")).count() == 0


def test_least(frame):
    got = {(r.doc_id, r.collapsed): [tuple(x) for x in r.runs] for r in periodic_runs.runs(frame.where("doc_id <> 3"), least=5).collect()}
    for i, t in enumerate(TEXTS):
        if i % 17 and i != 3:
            words = WORD.findall(t or "")
            assert got[i, collapsed(words, plain_runs(words, 5))] == plain_runs(words, 5)


def test_colliding_hashes(monkeypatch):
    """With every hash alike, the direct checks alone must give the same runs."""
    monkeypatch.setattr(periodic_runs.common, "mix64", lambda x: np.zeros_like(x))
    words = periodic_runs.Words(pa.array([t or "" for t in TEXTS]))
    doc, start, length, period = periodic_runs.slice_runs(words.ids, words.offsets, 12)
    got = sorted(zip(doc.tolist(), start.tolist(), length.tolist(), period.tolist(), strict=True))
    assert got == sorted((i, *r) for i, t in enumerate(TEXTS) for r in plain_runs(WORD.findall(t or "")))


def test_long_text():
    words = ["w"] * 60_000 + ["v"] + (["a", "b", "c"] * 20_000)
    found = periodic_runs.Words(pa.array([" ".join(words)]))
    _, start, length, period = periodic_runs.slice_runs(found.ids, found.offsets, 12)
    assert list(zip(start, length, period, strict=True)) == [(0, 60_000, 1), (60_001, 60_000, 3)]


def test_planting(spark):
    import zlib

    rows = [(i, " ".join(f"w{k}" for k in range(i % 50)) if i % 9 else None) for i in range(300)]
    got = {r.doc_id: r.text for r in queries.planted_repeats(spark.createDataFrame([*rows, (None, "a b")], "doc_id long, text string")).collect()}
    assert got.pop(None) == "a b"
    for i, text in rows:
        words = WORD.findall(text or "")
        h, n = zlib.crc32(str(i).encode()), len(words)
        g = h // 10
        if h % 10 == 0 and n:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [words[a + (k - a) % p] if k >= a else words[k] for k in range(n)]
        assert WORD.findall(got[i] or "") == words


def middle_rows(key, text) -> tuple:
    text = text or ""
    units = UNIT.findall(text)
    digest = hashlib.sha256(f"42:{'' if key is None else key}".encode()).hexdigest()
    h = [int(digest[k : k + 8], 16) for k in range(0, 32, 8)]
    a, b = sorted((h[0] % (len(units) + 1), h[1] % (len(units) + 1)))
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 50:
        return len(units), "plain", None, None, text, text
    p, m, s = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    form = "spm" if h[3] % 100 < 80 else "psm"
    return len(units), form, len(p), len(m), f"<S>{s}<P>{p}<M>{m}" if form == "spm" else f"<P>{p}<S>{s}<M>{m}", text


def test_fill_middle(spark):
    draw = np.random.default_rng(4)
    own = [None, "", " ", "\n", "a", " a ", "no <P> here", "<S>", "<", "<P", "é" * 9000, "中文 字 " * 3000, "👍 \x0b\x0c x\x1f y z  ", "<P <S <M < " * 30]
    own += ["".join(draw.choice(list("ab é中\n\t <PS>M"), size=int(draw.integers(0, 400)))) for _ in range(150)]
    own += [" ".join(draw.choice(["naïve", "plain", "中", "\n"], size=20_000))] * 8
    rows = [(i if i != 20 else None, t, 7, "c") for i, t in enumerate(own)] + [(2, " a b c", 7, "c")] * 2
    frame = spark.createDataFrame(rows, "doc_id long, text string, n int, output string")
    got = fill_middle.restore(fill_middle.transform(frame)).collect()
    key = lambda r: (r[0] is not None, r[0] or 0, r[5])
    assert sorted([tuple(r) for r in got], key=key) == sorted([(i, *middle_rows(i, t)) for i, t, *_ in rows], key=key)
    assert {"plain", "spm", "psm"} == {r.form for r in got}
    assert fill_middle.restore(fill_middle.transform(frame.where(F.lit(False)))).count() == 0


def test_rope_splits():
    text = "".join(f" w{i}é\n" for i in range(5000))
    texts = fill_middle.Texts(pa.array([text, "other", ""]))
    rope = texts.rope(0)
    units = UNIT.findall(text)
    assert rope.units == len(units) and rope.chars == len(text) and texts.rope(2) is None
    for rank in (0, 1, 17, 2500, 4999, len(units)):
        a, b = fill_middle.split(rope, rank)
        assert fill_middle.flat(a).decode() == "".join(units[:rank]) and fill_middle.flat(b).decode() == "".join(units[rank:])
        again = fill_middle.split(fill_middle.join(a, b), rank * 3, "chars")
        assert fill_middle.flat(again[0]).decode() == text[: rank * 3] and fill_middle.flat(again[1]).decode() == text[rank * 3 :]
