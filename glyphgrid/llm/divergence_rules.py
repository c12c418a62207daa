"""Quality rules by distribution divergence, in DataFrame functions only.

A document's histogram of character classes and of common words is compared with
those of each language by Jensen-Shannon distance. References come from all
documents with a language: sums of character classes, and the commonest words.
A document whose least mean distance over languages exceeds ``limit`` is not
kept; one of fewer than ``min_words`` words is too short to be judged this way.
Base counts (symbols, repeated lines, words in repeated windows) go with it.

Everything but the references' two small aggregations is one narrow projection.
The references are a few numbers and words for each language.

Defined results: null counts as a text without words (base_failed); without any
reference only the base rules decide; ties at a limit keep a document; repeated
rows each get their own row; very long texts are judged whole; an empty table
gives an empty result; only the id, text and lang columns are read, so other
columns can't clash.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import common

SPACES = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"
#: Classes in the order they are taken from a text; what is left is the last class.
CLASSES = ("abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", ".,;:'\"!?-()", SYMBOLS, "0123456789")
WINDOW = 8


def words_of(text: Column) -> Column:
    return F.array_remove(F.split(text, "[ \\t-\\r]+"), "")


def class_counts(text: Column) -> list[Column]:
    """Counts of white space, of each class, and of other characters."""
    sizes, left = [F.length(text)], text
    for members in (SPACES, *CLASSES):
        left = F.translate(left, members, "")
        sizes.append(F.length(left))
    return [a - b for a, b in zip(sizes, sizes[1:], strict=False)] + [sizes[-1]]


#: A slice length beyond any array's.
ALL = 1 << 30


def with_window_hashes(rows: DataFrame) -> DataFrame:
    """``windows``: one hash for each run of WINDOW words, by doublings; null for texts with one window or none.

    Each doubling is a column of its own: an expression that is used twice is then evaluated once.
    """
    rows = rows.withColumn("windows", F.when(F.col("n_words") > WINDOW, F.transform("words", lambda w: F.xxhash64(w))))
    step = 1
    while step < WINDOW:
        rows = rows.withColumn("windows", F.zip_with("windows", F.slice("windows", step + 1, ALL), lambda a, b: F.xxhash64(a, b)))
        step *= 2
    return rows.withColumn("windows", F.slice("windows", 1, F.greatest(F.lit(0), F.col("n_words") - (WINDOW - 1))))


def with_covered_words(rows: DataFrame) -> DataFrame:
    """``n_repeat_words``: words inside windows whose hash occurs at least twice."""
    several = F.size(F.array_distinct("windows")) < F.size("windows")
    rows = rows.withColumn("ordered", F.when(several, F.array_sort(F.transform("windows", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))))
    rows = rows.withColumn("after", F.zip_with("ordered", F.slice("ordered", 2, ALL), lambda a, b: F.struct(a["h"].alias("h"), a["i"].alias("i"), b["h"].alias("next"))))
    both = F.zip_with("after", F.array_prepend(F.transform("ordered", lambda a: a["h"]), F.lit(None).cast("long")), lambda a, before: F.struct(a["h"].alias("h"), a["i"].alias("i"), a["next"].alias("next"), before.alias("before")))
    repeated = F.filter(both, lambda a: a["h"].isNotNull() & (a["h"].eqNullSafe(a["next"]) | a["h"].eqNullSafe(a["before"])))
    rows = rows.withColumn("places", F.array_sort(F.transform(repeated, lambda a: a["i"])))
    gaps = F.zip_with("places", F.slice("places", 2, ALL), lambda a, b: F.least(F.lit(WINDOW), F.coalesce(b - a, F.lit(WINDOW))))
    return rows.withColumn("n_repeat_words", F.coalesce(F.aggregate(gaps, F.lit(0), lambda total, gap: total + gap), F.lit(0)).cast("long"))


def base_counts(documents: DataFrame, id_column: str = "doc_id") -> DataFrame:
    """(id, text, words, classes, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words)."""
    rows = common.plain_names(documents, id_column, "text").toDF("id", "text").withColumn("text", F.coalesce("text", F.lit("")))
    lines = F.filter(F.split("text", "\n"), lambda line: line.rlike("[^ \\t-\\r]"))
    rows = rows.select("id", words_of(F.col("text")).alias("words"), F.array(*class_counts(F.col("text"))).alias("classes"), (F.length("text")).alias("n_chars"), lines.alias("lines"))
    rows = rows.select("*", F.size("words").alias("n_words"), (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"))
    rows = with_covered_words(with_window_hashes(rows))
    return rows.select("id", "words", "classes", F.col("n_words").cast("long").alias("n_words"), (F.col("n_chars") - F.col("classes")[0]).cast("long").alias("word_chars"), F.col("classes")[1 + CLASSES.index(SYMBOLS)].cast("long").alias("n_symbols"), "n_dup_lines", "n_repeat_words")


def references(documents: DataFrame, common_words: int = 10) -> list[dict]:
    """Each language's class shares and commonest words with shares, over all documents with a language."""
    rows = common.plain_names(documents, "text", "lang").where("text is not null and lang is not null")
    sums = [F.sum(c).alias(f"c{i}") for i, c in enumerate(class_counts(F.col("text")))]
    classes = {r.lang: [float(x or 0) for x in r[1:]] for r in rows.groupBy("lang").agg(*sums).collect()}  # a row for each language
    counted = rows.select("lang", F.explode(words_of(F.col("text"))).alias("word")).groupBy("lang", "word").count()
    best = _commonest(counted, common_words)
    out = []
    for r in best.collect():  # a row for each language
        total = sum(classes[r.lang]) or 1.0
        out.append({"classes": [x / total for x in classes[r.lang]], "words": [w.word for w in r.top], "shares": [w["count"] / r.total for w in r.top]})
    return out


def _commonest(counted: DataFrame, most: int) -> DataFrame:
    """Totals and the ``most`` commonest words of each language; map-side partial aggregates keep only that many."""
    ranked = counted.withColumn("part", F.pmod(F.xxhash64("word"), F.lit(64)))
    order = [F.desc("count"), "word"]
    first = ranked.withColumn("place", F.row_number().over(Window.partitionBy("lang", "part").orderBy(*order)))
    sums = first.groupBy("lang", "part").agg(F.sum("count").alias("total"), F.collect_list(F.when(F.col("place") <= most, F.struct("count", "word"))).alias("top"))
    merged = sums.groupBy("lang").agg(F.sum("total").alias("total"), F.flatten(F.collect_list("top")).alias("top"))
    ordered = F.array_sort("top", lambda a, b: F.when(a["count"] != b["count"], (b["count"] - a["count"]).cast("int")).when(a["word"] < b["word"], -1).when(a["word"] > b["word"], 1).otherwise(0))
    return merged.select("lang", "total", F.slice(ordered, 1, most).alias("top"))


def divergence(left: Column, right: Column) -> Column:
    """Jensen-Shannon distance (0 to 1) of two arrays of shares of one length."""

    def part(p: Column, q: Column) -> Column:
        return F.when(p > 0, p * F.ln(2 * p / (p + q))).otherwise(F.lit(0.0))

    terms = F.zip_with(left, right, lambda p, q: part(p, q) + part(q, p))
    total = F.aggregate(terms, F.lit(0.0), lambda acc, x: acc + x)
    return F.sqrt(F.greatest(F.lit(0.0), total / 2) / F.ln(F.lit(2.0)))


def judge(documents: DataFrame, fitted: list[dict] | None = None, limit: float = 0.27, min_words: int = 50, id_column: str = "doc_id") -> DataFrame:
    """(id, base counts, base_failed, divergence, kept); divergence is null where it isn't taken."""
    refs = references(documents) if fitted is None else fitted
    rows = base_counts(documents, id_column)
    n, repeated = F.col("n_words"), F.col("n_repeat_words")
    rows = rows.withColumn("base_failed", (n < 20) | (100 * repeated > 30 * n))
    least = F.lit(None).cast("double")
    if refs:
        rows = rows.withColumn("class_shares", F.transform("classes", lambda c: c / F.greatest(F.lit(1), F.col("word_chars") + F.col("classes")[0])))
        distances = []
        listed = sorted({w for ref in refs for w in ref["words"]})
        rows = rows.withColumn("listed", F.when(n >= min_words, F.filter("words", lambda w: w.isin(listed))))
        for i, ref in enumerate(refs):
            words = F.array(*map(F.lit, ref["words"]))
            rows = rows.withColumn(f"seen{i}", F.when(n >= min_words, F.transform(words, lambda w: (F.size("listed") - F.size(F.array_remove("listed", w))) / n)))
            seen = F.concat(f"seen{i}", F.array(F.lit(1.0) - F.aggregate(f"seen{i}", F.lit(0.0), lambda a, b: a + b)))
            known = F.array(*map(F.lit, [*ref["shares"], max(0.0, 1 - sum(ref["shares"]))]))
            distances.append((divergence(F.col("class_shares"), F.array(*map(F.lit, ref["classes"]))) + divergence(seen, known)) / 2)
        least = F.when(n >= min_words, F.least(*distances) if len(distances) > 1 else distances[0])
    rows = rows.withColumn("divergence", least)
    kept = ~F.col("base_failed") & (F.col("divergence").isNull() | (F.col("divergence") <= limit))
    return rows.select(F.col("id").alias(id_column), "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "divergence", kept.alias("kept"))


def keep(documents: DataFrame, limit: float = 0.27, min_words: int = 50) -> DataFrame:
    """Rows that the rules keep, all columns as they were, in one narrow pass after the references."""
    names = [F.col(f"`{c}`") for c in documents.columns]
    rows = documents.select(F.struct(*names).alias("__row"), "text")
    judged = judge(rows, references(documents), limit, min_words, id_column="__row")
    # the place keeps the filter from being pushed into the rules' expressions, which would evaluate them many times over
    placed = judged.select("__row", "kept", F.monotonically_increasing_id().alias("__place")).where("kept and __place >= 0")
    return placed.select(*[F.col("__row")[c].alias(c) for c in documents.columns])
