"""String similarity by matching blocks, over distinct pairs that an upper bound lets through."""

from __future__ import annotations

from collections.abc import Callable
from difflib import SequenceMatcher

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType

from glyphgrid.functions import text as T
from glyphgrid.plans.durable import Stored

LEAST, LEAST_PHRASE = 0.88, 0.8
#: Fixed value: a token of the fuzzy signal.
TOKEN = "[a-z0-9]+(?:-[a-z0-9]+)?"


@F.pandas_udf(DoubleType())
def block_ratio(left: pd.Series, right: pd.Series) -> pd.Series:
    """Twice the matched characters over both lengths; the order of the arguments counts."""
    return pd.Series([SequenceMatcher(None, a, b).ratio() for a, b in zip(left, right, strict=True)], dtype="float64")


def _letters(words: list[str]) -> np.ndarray:
    """How often each word holds each of 32 classes of characters, by the low bits of their codes."""
    codes = np.frombuffer(" ".join(words).encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    sizes = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
    owner = np.repeat(np.arange(len(words)), sizes + 1)[:-1]  # a blank goes with the word before it
    held = np.bincount(owner * 32 + (codes & 31), minlength=32 * len(words)).reshape(-1, 32).astype(np.int32)
    held[:-1, 0] -= 1
    return held


def _common(phrase: str) -> Callable[[str], int]:
    """A function that gives the length of the longest common subsequence with ``phrase``, one addition a character."""
    places: dict[str, int] = {}
    for k, char in enumerate(phrase):
        places[char] = places.get(char, 0) | 1 << k
    full = (1 << len(phrase)) - 1

    def length(run: str) -> int:
        free = full
        for char in run:
            met = free & places.get(char, 0)
            free = (free + met | free - met) & full
        return len(phrase) - free.bit_count()

    return length


def best_ratios(text: str, phrases: list[str]) -> list[float]:
    """For each phrase the best ratio with the text's runs of as many words, 0 below LEAST_PHRASE.

    Both are taken in lower case, phrases without white space around. Matched characters are a common subsequence,
    and of each letter no more than either string has; runs whose bounds can't reach the best so far are left out.
    """
    words = text.lower().split()
    by_word = _letters(words) if words else np.zeros((0, 32), dtype=np.int32)
    lengths = np.cumsum([0, *map(len, words)])
    runs: dict[int, tuple[np.ndarray, np.ndarray]] = {}
    known: dict[str, float] = {}

    def best(phrase: str) -> float:
        n, size = len(phrase.split()), len(phrase)
        if n > len(words) or not n:
            return 1.0 if not n and not phrase else 0.0
        if n not in runs:
            counts = by_word[: len(words) - n + 1].copy()
            for k in range(1, n):
                counts += by_word[k : len(words) - n + 1 + k]
            counts[:, 0] += n - 1
            runs[n] = counts, lengths[n:] - lengths[:-n] + n - 1
        counts, sizes = runs[n]
        letters = np.bincount(np.frombuffer(phrase.encode("utf-32-le", "surrogatepass"), dtype=np.uint32) & 31, minlength=32).astype(np.int32)
        bound = 2 * np.minimum(counts, letters).sum(axis=1) / (sizes + size)
        able = np.flatnonzero(bound >= LEAST_PHRASE - 1e-9)
        found, common = 0.0, _common(phrase)
        seen = set()
        for i in able[np.argsort(-bound[able], kind="stable")].tolist():
            if bound[i] < found:
                break
            run = " ".join(words[i : i + n])
            if run == phrase:
                return 1.0
            if run not in seen:
                seen.add(run)
                if 2 * common(run) / (size + len(run)) >= max(found, LEAST_PHRASE) - 1e-9:
                    found = max(found, SequenceMatcher(None, phrase, run).ratio())
        return found if found >= LEAST_PHRASE else 0.0

    for phrase in {p.lower().strip() for p in phrases}:
        known[phrase] = best(phrase)
    return [known[p.lower().strip()] for p in phrases]


@F.pandas_udf(ArrayType(DoubleType()))
def phrase_ratios(text: pd.Series, names: pd.Series) -> pd.Series:
    """``best_ratios`` of each text and its names."""
    return pd.Series([best_ratios(t, list(n)) for t, n in zip(text.fillna(""), names, strict=True)])


def _unmatched(la: Column, lb: Column, least: float) -> Column:
    """Characters of both strings that a ratio of ``least`` may leave unmatched: as odd or even as both lengths together."""
    most = F.floor(F.lit(1 - least) * (la + lb) + F.lit(1e-9)).cast("int")
    return most - (la + lb - most) % 2


def _segment(length: Column, parts: Column, number: Column) -> tuple[Column, Column]:
    """Start (from 0) and size of one of the nearly equal parts of a string; the longer ones come last."""
    size = F.floor(length / parts).cast("int")
    late = F.greatest(F.lit(0), number - (parts - length % parts))
    return number * size + late, size + F.when(number >= parts - length % parts, 1).otherwise(0)


def _partners(length: Column, least: float) -> Column:
    """Lengths of strings that can reach ``least`` with one of a length."""
    bound = least / (2 - least)
    return F.sequence(F.ceil(length * bound - 1e-9).cast("int"), F.floor(length / bound + 1e-9).cast("int"))


def candidate_pairs(left: DataFrame, right: DataFrame, least: float = LEAST) -> DataFrame:
    """(a, b) of distinct terms a and tokens b that may have a ratio of ``least``: a superset by shared parts.

    With k characters of both unmatched at most, one of k + 1 parts of a stands unbroken in b, at most k places
    off; terms give their parts, tokens the pieces at such places, and both meet by an equi-join on lengths, the
    part's number and its text.
    """
    a = left.select("a").where("a <> ''").distinct().withColumn("la", F.length("a")).withColumn("lb", F.explode(_partners(F.col("la"), least)))
    a = a.withColumn("k", _unmatched(F.col("la"), F.col("lb"), least)).where("k >= 0").select("a", "la", "lb", "k", F.explode(F.sequence(F.lit(0), F.col("k"))).alias("i"))
    start, size = _segment(F.col("la"), F.col("k") + 1, F.col("i"))
    a = a.select("a", "la", "lb", "i", F.substr("a", start + 1, size).alias("piece"))
    b = right.select("b").where("b <> ''").distinct().withColumn("lb", F.length("b")).withColumn("la", F.explode(_partners(F.col("lb"), least)))
    b = b.withColumn("k", _unmatched(F.col("la"), F.col("lb"), least)).where("k >= 0").select("b", "la", "lb", "k", F.explode(F.sequence(F.lit(0), F.col("k"))).alias("i"))
    start, size = _segment(F.col("la"), F.col("k") + 1, F.col("i"))
    first, last = F.greatest(F.lit(0), start - F.col("k")), F.least(F.col("lb") - size, start + F.col("k"))
    b = b.withColumn("size", size).withColumn("first", first).withColumn("last", last).where("first <= last")
    b = b.select("b", "la", "lb", "i", F.explode(F.transform(F.sequence("first", "last"), lambda at: F.substr("b", at + 1, F.col("size")))).alias("piece"))
    return a.join(b, ["la", "lb", "i", "piece"]).select("a", "b").distinct()


def similar_terms(left: DataFrame, right: DataFrame, least: float = LEAST) -> DataFrame:
    """(a, b, ratio) of distinct terms a and tokens b with ratio >= ``least``.

    Letters of either that the other lacks stay unmatched, which bounds the ratio of a candidate before the function runs.
    """
    letters = lambda c: F.array_distinct(F.split(c, ""))
    lacking = F.size(F.array_except(letters(F.col("a")), letters(F.col("b")))) + F.size(F.array_except(letters(F.col("b")), letters(F.col("a"))))
    pairs = candidate_pairs(left, right, least).where(lacking <= F.lit(1 - least) * (F.length("a") + F.length("b")) + F.lit(1e-9))
    same = pairs.where("a = b").select("a", "b", F.lit(1.0).alias("ratio"))
    return same.union(pairs.where("a <> b").select("a", "b", block_ratio("a", "b").alias("ratio")).where(F.col("ratio") >= least - 1e-12))


def tokens(segments: DataFrame, text: Column) -> DataFrame:
    """(segment_id, w): distinct tokens of a normalised text."""
    return segments.select("segment_id", F.explode(F.array_distinct(F.regexp_extract_all(text, F.lit(f"({TOKEN})"), 1))).alias("w"))


def fuzzy_scores(found: DataFrame, index: DataFrame, generic: DataFrame) -> DataFrame:
    """(segment_id, idx, fuzzy) of pairs over 0.8, from ``found`` (segment_id, w).

    An acronym's best similar token gives its ratio, two primary terms of several
    that are met by similar tokens 0.9, a single one 0.82; a single generic term none.
    """
    bare = lambda c: F.replace(F.col(c), F.lit("-"), F.lit(""))
    vocabulary = Stored(found.select("w").distinct()).table
    primary = index.select("idx", F.size("primary").alias("size"), F.explode("primary").alias("term")).withColumn("a", F.replace(T.normalized(F.col("term")), F.lit("-"), F.lit("")))
    near = similar_terms(primary.select("a"), vocabulary.select(bare("w").alias("b"))).select("a", "b")
    # few tokens are near a term: written, the pairs are mostly broadcast, and the texts' tokens are not shuffled
    met = found.select("segment_id", bare("w").alias("b")).join(Stored(near).side(), "b").select("segment_id", "a").distinct().join(primary, "a")
    hits = met.groupBy("segment_id", "idx").agg(F.max("size").alias("size"), F.count_distinct("term").alias("met"))
    terms = hits.select("segment_id", "idx", F.when((F.col("size") >= 2) & (F.col("met") >= 2), 0.9).when((F.col("size") == 1) & (F.col("met") == 1), 0.82).alias("fuzzy")).where("fuzzy is not null")
    acronyms = index.select("idx", F.explode("acronyms").alias("a"))
    close = Stored(similar_terms(acronyms, vocabulary.select(F.col("w").alias("b")))).side()
    short = found.withColumnRenamed("w", "b").join(close, "b").join(acronyms, "a").groupBy("segment_id", "idx").agg(F.max("ratio").alias("fuzzy"))
    best = terms.union(short).groupBy("segment_id", "idx").agg(F.max("fuzzy").alias("fuzzy"))
    barred = index.where(F.size("primary") == 1).select("idx", F.col("primary")[0].alias("term")).join(generic.where("generic").select("term"), "term").select("idx")
    return best.join(barred, "idx", "left_anti").select("segment_id", "idx", "fuzzy")
