"""Soft-membership mixing to target weights, in DataFrame functions only.

A classifier held as a table (word, log-likelihood under each domain) is counted
from labelled documents and gives each document posteriors over domains. Document
rates r >= 0 then solve a least-squares problem by projected gradient: the
expected domain token totals, sum of rate * tokens * posterior, shall match
``targets`` times ``budget`` times all tokens, with a small pull of rates to 1.
A rate is a function of a document's posteriors, kept to three decimals, and the
few residuals of past turns; so a turn is one aggregation of a number per domain
over the tokens of each distinct posterior. No table of rates is rewritten and no
document leaves Spark.

About ``sample_rows`` labelled documents train the classifier, picked by a hash of
the id. Its table holds the ``table_words`` words whose document counts depart
most from independence of the domain (chi-square); words of few documents would
add noise only. So the table is a constant of the plan, posteriors need neither
join nor shuffle, and each document is read by itself. Tokens are white-space
words other than bare punctuation.

Defined results: null and empty texts have no tokens, prior posteriors and a rate
that moves no total; a target domain without labelled rows can't be reached and
its residual stays; without labelled rows all rates are 1; words are counted once
a document; ids repeated in the labels count once for each distinct domain, and all
rows of a labelled id count; rows that share an id keep a row each, with posteriors
of their own text; equal chi-squares go by the word; very long texts are counted
whole; an empty table gives no row; only the id and text columns are read, so other
columns can't clash.
"""

from __future__ import annotations

import json
import math
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import common

SAMPLE_RANGE = 1 << 20
#: Weight of the words that a document lacks, as they are not independent: 1 would be a Bernoulli model.
ABSENCE = 0.25
#: Decimals of a posterior: documents of equal posteriors are one row in the turns, so these cost alike for any corpus.
DECIMALS = 3


class Classifier(NamedTuple):
    """What each table word adds to the log-likelihood of each domain, and the log-likelihoods of a document without any."""

    gains: dict[str, list[float]]
    priors: list[float]


class Mixture(NamedTuple):
    """A fitted classifier and the scaled residuals of the turns, which give every document's rate."""

    classifier: Classifier
    history: list[list[float]]
    pull: float
    step: float


def words_of(text: Column) -> Column:
    """Lower-cased words without punctuation at their ends; none for null."""
    pieces = F.split(F.lower(F.concat(F.coalesce(text, F.lit("")), F.lit("\n"))), "[.,;:]*[ \\t-\\r]+")
    return F.array_remove(pieces, "")


def with_words(documents: DataFrame, *kept: str) -> DataFrame:
    return documents.select(*[F.col(f"`{c}`") for c in kept], words_of(F.col("text")).alias("__words"))


def fit(documents: DataFrame, labels: DataFrame, domains: list[str], sample_rows: int = 20_000, table_words: int = 512, least_documents: int = 10, id_column: str = "doc_id") -> Classifier | None:
    """The classifier from labels (id, domain); None without labelled rows."""
    marked = common.plain_names(labels, id_column, "domain").toDF("id", "domain").where(F.col("domain").isin(domains) & F.col("id").isNotNull()).distinct()
    total = marked.count()
    if not total:
        return None
    draw = F.pmod(F.xxhash64(F.col("id"), F.lit("mixing")), F.lit(SAMPLE_RANGE))
    chosen = marked.where(draw < int(min(1.0, sample_rows / total) * SAMPLE_RANGE))
    # the sample is bounded by sample_rows, whatever the tables hold
    texts = common.plain_names(documents, id_column, "text").toDF("id", "text").join(F.broadcast(chosen), "id")
    counted = {r.domain: r["count"] for r in texts.groupBy("domain").count().collect()}  # rows: an id may have several texts, or none
    sizes = [counted.get(d, 0) for d in domains]
    if not sum(sizes):
        return None
    seen = with_words(texts, "domain").select("domain", F.explode(F.array_distinct("__words")).alias("word"))
    counts = seen.groupBy("word").agg(F.count(F.lit(1)).alias("n"), *[F.count_if(F.col("domain") == d).alias(f"n{i}") for i, d in enumerate(domains)])
    shares = [s / max(sum(sizes), 1) for s in sizes]
    chi = sum(((F.col(f"n{i}") - F.col("n") * s) ** 2 / (F.col("n") * s) for i, s in enumerate(shares) if s), F.lit(0.0))
    best = counts.where(F.col("n") >= least_documents).orderBy(chi.desc(), "word").limit(table_words).collect()
    priors = [math.log((s + 0.5) / (sum(sizes) + 0.5 * len(sizes))) for s in sizes]
    gains = {}
    for row in sorted(best, key=lambda r: -r.n):  # lookups try the words in this order
        shares = [(row[f"n{i}"] + 0.5) / (size + 1) for i, size in enumerate(sizes)]
        gains[row.word] = [math.log(q) - ABSENCE * math.log1p(-q) for q in shares]
        priors = [p + ABSENCE * math.log1p(-q) for p, q in zip(priors, shares, strict=True)]  # a word that is not there tells, too
    return Classifier(gains, priors)


def posteriors(documents: DataFrame, fitted: Classifier, *kept: str) -> DataFrame:
    """Columns ``kept``, __tokens and __p over domains, a row for each row of ``documents``; nothing is joined or shuffled."""
    priors = F.array(*map(F.lit, fitted.priors))
    rows = with_words(documents, *kept)
    names = [F.col(f"`{c}`") for c in kept]
    if not fitted.gains:
        scores = priors
        rows = rows.withColumn("__hits", F.array())
    else:
        table = F.from_json(F.lit(json.dumps(fitted.gains)), "map<string,array<double>>")
        rows = rows.withColumn("__hits", F.array_intersect(F.map_keys(table), "__words"))
        scores = F.aggregate("__hits", priors, lambda total, word: F.zip_with(total, F.element_at(table, word), lambda a, b: a + b))
    rows = rows.select(*names, F.size("__words").alias("__tokens"), scores.alias("__scores"))
    rows = rows.withColumn("__top", F.array_max("__scores"))
    rows = rows.select(*names, "__tokens", F.transform("__scores", lambda s: F.exp(s - F.col("__top"))).alias("__weights"))
    rows = rows.withColumn("__all", F.aggregate("__weights", F.lit(0.0), lambda a, b: a + b))
    return rows.select(*names, "__tokens", F.transform("__weights", lambda w: F.round(w / F.col("__all"), DECIMALS)).alias("__p"))


def rates(p: str, history: list[list[float]], pull: float, step: float) -> Column:
    """A document's rate after the turns whose scaled residuals are given, and the point beyond it where the next turn starts."""
    start = F.array(F.lit(1.0), F.lit(1.0))
    if not history:
        return start
    # the momentum of accelerated gradients: k / (k + 3) of the last move goes on
    turns = F.array(*[F.array(*map(F.lit, [*h, k / (k + 3.0)])) for k, h in enumerate(history)])

    def turn(at: Column, residuals: Column) -> Column:
        gradient = F.aggregate(F.zip_with(p, residuals, lambda a, e: a * e), F.lit(0.0), lambda a, b: a + F.coalesce(b, F.lit(0.0)))
        moved = F.greatest(F.lit(0.0), at[1] - step * (gradient + pull * (at[1] - 1)))
        return F.aggregate(F.array(moved), at, lambda old, new: F.array(new, new + F.element_at(residuals, -1) * (new - old[0])))

    return F.aggregate(turns, start, turn)


def solve(table: DataFrame, targets: dict[str, float], budget: float, turns: int, pull: float, step: float, tolerance: float) -> list[list[float]]:
    """Scaled residuals of each turn over the table (__tokens, __p)."""
    wanted = [t / sum(targets.values()) * budget for t in targets.values()]
    history: list[list[float]] = []
    shares: list[float] | None = None
    last: list[float] = []
    cells = table.groupBy("__p").agg(F.sum("__tokens").alias("__tokens"))
    grid = common.cut(cells.coalesce(1) if len(wanted) <= 3 else cells)  # three domains have at most half a million cells
    for _ in range(turns):
        rows = grid.select("__tokens", "__p", (rates("__p", history, pull, step)[1] * F.col("__tokens")).alias("moved"))
        sums = rows.agg(F.sum("__tokens"), *[F.sum(F.col("moved") * F.col("__p")[i]) for i in range(len(wanted))]).first()
        total = float(sums[0] or 0)
        if not total:
            break
        reached = [float(x or 0) / total for x in sums[1:]]
        shares = shares or [max(s, 1e-6) for s in reached]
        if max(abs(r - w) for r, w in zip(reached, wanted, strict=True)) < tolerance:
            break
        if last and max(abs(r - l) for r, l in zip(reached, last, strict=True)) < tolerance / 10:
            break  # targets out of reach: nothing moves any more
        last = reached
        history.append([(r - w) / s for r, w, s in zip(reached, wanted, shares, strict=True)])
    return history


def fit_mixture(documents: DataFrame, labels: DataFrame, targets: dict[str, float], budget: float = 1.0, turns: int = 40, pull: float = 1e-3, step: float = 1.0, tolerance: float = 1e-4, id_column: str = "doc_id") -> tuple[Mixture, DataFrame | None]:
    """The mixture, and the table (id, __tokens, __p) that it was solved on; None if nothing is labelled."""
    classifier = fit(documents, labels, list(targets), id_column=id_column)
    if classifier is None:
        even = [math.log(1 / len(targets))] * len(targets)
        return Mixture(Classifier({}, even), [], pull, step), None
    table = common.cut(posteriors(documents, classifier, id_column))
    return Mixture(classifier, solve(table, targets, budget, turns, pull, step, tolerance), pull, step), table


def mix(documents: DataFrame, labels: DataFrame, targets: dict[str, float], budget: float = 1.0, turns: int = 40, pull: float = 1e-3, step: float = 1.0, tolerance: float = 1e-4, id_column: str = "doc_id") -> DataFrame:
    """(id, tokens, p, rate) of every document, p in the order of ``targets``."""
    mixture, table = fit_mixture(documents, labels, targets, budget, turns, pull, step, tolerance, id_column)
    if table is None:
        table = posteriors(documents, mixture.classifier, id_column)
    return table.select(F.col(f"`{id_column}`"), F.col("__tokens").alias("tokens"), F.col("__p").alias("p"), rates("__p", mixture.history, pull, step)[0].alias("rate"))


def label_domains(labels: DataFrame, id_column: str = "doc_id") -> DataFrame:
    """(id, domain) of the labels table: toxic, low (quality 0) or clean."""
    return labels.select(id_column, F.when(F.col("toxic") == 1, "toxic").when(F.col("quality") == 0, "low").when(F.col("quality") == 1, "clean").alias("domain"))


#: Token shares that the mixture shall have.
TARGETS = {"clean": 0.93, "low": 0.05, "toxic": 0.02}


def take(documents: DataFrame, mixture: Mixture, id_column: str = "doc_id") -> DataFrame:
    """Rows as often as their rates say: the whole part, and one more with the rest's probability by a hash of id and text."""
    names = [F.col(f"`{c}`") for c in documents.columns]
    rows = documents.select(F.struct(*names).alias("__row"), F.col(f"`{id_column}`").alias("__id"), "text")  # a struct can't clash with columns of our own
    rated = posteriors(rows, mixture.classifier, "__row", "__id", "text")
    draw = F.pmod(F.xxhash64("__id", "text", F.lit("take")), F.lit(SAMPLE_RANGE)) / SAMPLE_RANGE
    copies = F.floor(rates("__p", mixture.history, mixture.pull, mixture.step)[0] + draw).cast("int")
    # the place keeps the filter from being pushed into the posteriors' expressions, which would evaluate them many times over
    counted = rated.select("__row", copies.alias("__copies"), F.monotonically_increasing_id().alias("__place")).where("__copies > 0 and __place >= 0")
    repeated = counted.select("__row", F.explode(F.array_repeat(F.lit(0), F.col("__copies"))))
    return repeated.select(*[F.col("__row")[c].alias(c) for c in documents.columns])
