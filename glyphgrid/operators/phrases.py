"""Phrases in texts: one pass of an automaton over each text, whatever the number of phrases.

Up to ``PHRASE_BYTES`` of phrases go to every task. Beyond that they are dealt to buckets
by their first word, and a text goes to the buckets of its own words, so that each call
holds one bucket's automaton and a bounded share of the texts.
"""

from __future__ import annotations

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

PHRASE_BYTES = 32 << 20
#: Text bytes of a bucket that one call takes.
SHARE_BYTES = 64 << 20
_WORD = r"[\p{L}\p{N}_]+"


def _folded(text: str) -> str:
    return text.replace("-", " ")


def _inside_word(char: str) -> bool:
    return char.isalnum() or char == "_"


class Finder:
    """An automaton over phrases; ``whole`` ones stand between non-word characters, and their hyphens match white space too."""

    def __init__(self, phrases: list[str], whole: bool):
        self.whole = whole
        self.automaton = ahocorasick.Automaton()
        by_form: dict[str, list[str]] = {}
        for phrase in phrases:
            if phrase:
                by_form.setdefault(_folded(phrase) if whole else phrase, []).append(phrase)
        for form, own in by_form.items():
            self.automaton.add_word(form, (len(form), own))
        self.empty = not by_form
        if by_form:
            self.automaton.make_automaton()

    def found(self, text: str) -> set[str]:
        """Phrases that occur in a text."""
        if self.empty or not text:
            return set()
        if not self.whole:
            return {p for _, (_, own) in self.automaton.iter(text) for p in own}
        out: set[str] = set()
        for end, (size, own) in self.automaton.iter(_folded(text)):
            start, stop = end - size + 1, end + 1
            if start and _inside_word(text[start - 1]) or stop < len(text) and _inside_word(text[stop]):
                continue
            here = text[start:stop]
            # a phrase's blank is no hyphen of the text
            out |= {p for p in own if p not in out and (p == here or all(a == b or a == "-" for a, b in zip(p, here, strict=True)))}
        return out


def _hits(batch_ids: pa.Array, texts: list, finder: Finder) -> pa.RecordBatch:
    at, phrases = [], []
    for i, text in enumerate(texts):
        own = sorted(finder.found(text or ""))
        at += [i] * len(own)
        phrases += own
    return pa.RecordBatch.from_arrays([batch_ids.take(pa.array(at, pa.int64())), pa.array(phrases, pa.string())], ["segment_id", "phrase"])


def phrase_hits(texts: DataFrame, phrases: DataFrame, whole: bool = True) -> DataFrame:
    """(segment_id, phrase) of distinct phrases (phrase) in texts (segment_id, text), each once a text.

    Texts are lower case with single spaces for ``whole`` phrases. Null and empty ones hold and are nothing.
    """
    held = phrases.where("phrase <> ''").select("phrase").distinct()
    size = held.agg(F.sum(F.octet_length("phrase") + 16)).first()[0] or 0
    kind = texts.schema["segment_id"].dataType.simpleString()
    schema = f"segment_id {kind}, phrase string"
    rows = texts.select("segment_id", "text")
    if size <= PHRASE_BYTES:
        listed = texts.sparkSession.sparkContext.broadcast([r.phrase for r in held.collect()])

        def run(batches):
            finder = Finder(listed.value, whole)
            for batch in batches:
                yield _hits(batch.column(0), batch.column(1).to_pylist(), finder)

        return rows.mapInArrow(run, schema)
    buckets = size // PHRASE_BYTES + 1
    total = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    shares = total // SHARE_BYTES + 1
    bucket = lambda word: F.pmod(F.xxhash64(word), F.lit(buckets))
    number = lambda word: F.when(word == "", F.lit(0)).otherwise(bucket(word))
    # phrases without a word are in the first bucket, which takes all texts; parts of words can be anywhere
    dealt = held.select("phrase", number(F.regexp_extract("phrase", _WORD, 0)).alias("bucket"), F.explode(F.sequence(F.lit(0), F.lit(shares - 1))).alias("share"))
    words = F.array_distinct(F.regexp_extract_all("text", F.lit(_WORD), F.lit(0)))
    own = F.array_union(F.array(F.lit(0).cast("bigint")), F.transform(words, bucket)) if whole else F.sequence(F.lit(0).cast("bigint"), F.lit(buckets - 1).cast("bigint"))
    spread = rows.where("text <> ''").select("segment_id", "text", F.explode(F.array_distinct(own)).alias("bucket"), F.pmod(F.xxhash64("segment_id"), F.lit(shares)).alias("share"))

    def matched(left: pa.Table, right: pa.Table) -> pa.Table:
        finder = Finder(right.column("phrase").to_pylist(), whole)
        return pa.Table.from_batches([_hits(left.column("segment_id").combine_chunks(), left.column("text").to_pylist(), finder)])

    return spread.groupBy("bucket", "share").cogroup(dealt.groupBy("bucket", "share")).applyInArrow(matched, schema)
