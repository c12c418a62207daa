"""Concept linking: a term-indexed taxonomy joined to segments by shared terms.

The taxonomy's index and its terms are written once and read by every part of a plan.
Every score but the legacy profile's comes from equi-joins on terms: a pair without
a shared term can't pass the threshold (exact, fuzzy and context give 45 of 100 at
most), so no segment meets a concept that it shares no term with. Segments are dealt
by their id once, which serves all that is computed of a segment. A stored side is
broadcast while its files are small (``durable.Stored``), so frequent terms are not
dealt to one task; beyond that the join is a shuffle that AQE splits. Phrases are
found by one automaton pass over each text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from glyphgrid.functions import text as T
from glyphgrid.operators import similarity
from glyphgrid.operators.phrases import phrase_hits
from glyphgrid.plans.durable import BROADCAST_BYTES, Stored

#: Weights of a segment's channels, and of the five signals in percent, in order of precedence.
CHANNELS = {"caption": 1.0, "summary": 0.9, "ocr": 0.7, "nearby": 0.5}
SIGNALS = {"exact": 30.0, "cosine": 30.0, "overlap": 25.0, "fuzzy": 10.0, "context": 5.0}


def concepts(taxonomy: DataFrame, parsed: bool = True) -> DataFrame:
    """One row a concept: id, name, main part, acronyms, aliases, terms and phrases; null or empty names are left out.

    Without ``parsed`` (the legacy profile) names are taken whole and hyphens don't split terms.
    """
    named = taxonomy.where("concept is not null and concept <> ''")
    name = F.col("concept")
    none = F.array().cast("array<string>")
    parts = T.concept_parts(name) if parsed else {"main": name, "acronyms": none, "aliases": none}
    rows = named.select("idx", "level", "concept", T.concept_id(name, F.col("idx")).alias("concept_id"), F.lower("concept").alias("name"), T.terms(F.col("tags"), parsed).alias("context"), *[v.alias(k) for k, v in parts.items()])
    rows = rows.withColumn("primary", T.terms(F.col("main"), parsed))
    others = F.array_union("acronyms", F.flatten(F.transform("aliases", lambda a: T.terms(a, parsed))))
    phrases = F.transform(F.concat(F.array("concept", "main"), "aliases", "acronyms"), T.normalized)
    rows = rows.withColumn("normalized", F.array_union(F.array_union("primary", others), "context"))
    return rows.withColumn("phrases", F.array_sort(F.array_distinct(F.filter(phrases, lambda p: p != ""))))


def concept_terms(index: DataFrame) -> DataFrame:
    """(idx, term, is_primary, is_context)."""
    return index.select("idx", "primary", "context", F.explode("normalized").alias("term")).select("idx", "term", F.array_contains("primary", F.col("term")).alias("is_primary"), F.array_contains("context", F.col("term")).alias("is_context"))


def document_frequency(terms: DataFrame) -> DataFrame:
    return terms.groupBy("term").agg(F.count(F.lit(1)).alias("df"))


def idf(df: Column, n: Column) -> Column:
    return F.ln((n + 1) / (F.coalesce(df, F.lit(1)) + 1)) + 1


def term_idf(index: DataFrame) -> DataFrame:
    """(term, df, idf); one aggregation of a number feeds the count of concepts."""
    total = index.agg(F.count(F.lit(1)).alias("n"))
    return document_frequency(concept_terms(index)).join(F.broadcast(total)).select("term", "df", idf(F.col("df"), F.col("n")).alias("idf"))


def segment_terms(segments: DataFrame, channels: tuple[str, ...] = tuple(CHANNELS), hyphen_parts: bool = True) -> DataFrame:
    """(segment_id, term, weight): weights of the channels that hold a term.

    Words become rows before they are trimmed and filtered, and a channel's weight counts once a term; segments
    are dealt by id first, which serves this grouping and all that follow.
    """
    words = [F.struct(F.lit(k).alias("channel"), T.raw_words(F.col(c)).alias("words")) for k, c in enumerate(channels)]
    rows = segments.select("segment_id", *channels).repartition("segment_id").select("segment_id", F.explode(F.array(*words)).alias("c"))
    rows = rows.select("segment_id", "c.channel", F.explode("c.words").alias("word"))
    rows = rows.select("segment_id", "channel", F.btrim("word", F.lit("-_")).alias("term"))
    if hyphen_parts:
        parts = F.when(F.contains("term", F.lit("-")), F.concat(F.array("term"), F.split("term", "-"))).otherwise(F.array("term"))
        rows = rows.select("segment_id", "channel", F.explode(parts).alias("term")).select("segment_id", "channel", F.btrim("term", F.lit("-_")).alias("term"))
    held = [F.coalesce(F.max(F.when(F.col("channel") == k, F.lit(CHANNELS[c]))), F.lit(0.0)) for k, c in enumerate(channels)]
    return rows.where(T.is_term(F.col("term"))).groupBy("segment_id", "term").agg(sum(held[1:], held[0]).alias("weight"))


def search_vectors(segments: DataFrame, index: DataFrame, **options) -> DataFrame:
    """(segment_id, term, value): channel weights as shares of the segment's total, times idf; unseen terms count as df 1."""
    known = Stored(document_frequency(concept_terms(index)))
    total = F.lit(index.count())
    terms = segment_terms(segments, **options)
    share = F.col("weight") / F.sum("weight").over(Window.partitionBy("segment_id"))
    return terms.withColumn("share", share).join(known.side(), "term", "left").select("segment_id", "term", (F.col("share") * idf(F.col("df"), total)).alias("value"))


def concept_vectors(index: DataFrame) -> DataFrame:
    """(idx, term, value): 2 for primary and 1 for context terms, as shares, times idf."""
    weight = F.when(F.col("is_primary"), 2.0).otherwise(0.0) + F.when(F.col("is_context"), 1.0).otherwise(0.0)
    terms = concept_terms(index).withColumn("weight", weight).where("weight > 0")
    share = F.col("weight") / F.sum("weight").over(Window.partitionBy("idx"))
    return terms.withColumn("share", share).join(term_idf(index), "term").select("idx", "term", (F.col("share") * F.col("idf")).alias("value"))


def term_table(index: DataFrame) -> DataFrame:
    """(term, idx, is_primary, idf, value, norm, all): a concept's terms with what cosine and overlap need of it."""
    by_concept = Window.partitionBy("idx")
    rows = concept_terms(index).join(term_idf(index), "term").join(concept_vectors(index), ["idx", "term"], "left").na.fill(0.0, ["value"])
    rows = rows.withColumn("norm", F.sqrt(F.sum(F.col("value") * F.col("value")).over(by_concept))).withColumn("all", F.sum(F.when(F.col("is_primary"), F.col("idf")).otherwise(0.0)).over(by_concept))
    return rows.select("term", "idx", "is_primary", "idf", "value", "norm", "all")


def term_signals(segments: DataFrame, index: DataFrame, **options) -> DataFrame:
    """(segment_id, idx, cosine, overlap) of pairs with a shared term, from one join on terms.

    Cosine: of the two vectors, 0 to 1. Overlap: idf of primary hits, and half that of others, against all
    primary terms. Of terms that no concept has only the squares count, so they go before the join.
    """
    table = Stored(term_table(index))
    unseen = idf(F.lit(None).cast("bigint"), F.lit(index.count()))
    seen = Stored(table.table.select("term", "idf").distinct())
    terms = segment_terms(segments, **options).join(seen.side(), "term", "left")
    weighed = F.col("weight") * F.coalesce(F.col("idf"), unseen)
    known = F.collect_list(F.when(F.col("idf").isNotNull(), F.struct("term", "weight")))
    per = terms.groupBy("segment_id").agg(F.sum("weight").alias("total"), F.sqrt(F.sum(weighed * weighed)).alias("length"), known.alias("known"))
    left = per.select("segment_id", (F.col("length") / F.col("total")).alias("ns"), "total", F.explode("known").alias("t")).select("segment_id", "ns", "t.term", (F.col("t.weight") / F.col("total")).alias("share"))
    got = F.sum(F.when(F.col("is_primary"), F.col("idf")).otherwise(0.5 * F.col("idf")))
    sums = left.join(table.side(), "term").groupBy("segment_id", "idx").agg(F.sum(F.col("share") * F.col("idf") * F.col("value")).alias("dot"), F.max("ns").alias("ns"), F.max("norm").alias("nc"), got.alias("got"), F.max("all").alias("all"))
    cosine = F.when(F.col("ns") * F.col("nc") > 0, F.least(F.lit(1.0), F.greatest(F.lit(0.0), F.col("dot") / (F.col("ns") * F.col("nc"))))).otherwise(0.0)
    overlap = F.when(F.col("all") > 0, F.least(F.lit(1.0), F.col("got") / F.col("all"))).otherwise(0.0)
    return sums.select("segment_id", "idx", cosine.alias("cosine"), overlap.alias("overlap"))


def search_text(channels: tuple[str, ...] = tuple(CHANNELS)) -> Column:
    """The channels' texts that aren't empty, joined."""
    return F.concat_ws(" ", *[F.nullif(F.col(c), F.lit("")) for c in channels])


def phrase_score(phrase: Column) -> Column:
    """What a phrase found counts: names of several words and short ones 1, others 0.7."""
    shaped = phrase.contains(" ") | phrase.rlike(r"^[a-z]{2,10}(-[a-z]{1,10})?s?\z")
    return F.when(shaped, 1.0).otherwise(0.7)


def exact_scores(texts: DataFrame, index: DataFrame) -> DataFrame:
    """(segment_id, idx, exact, named) of concepts with a phrase in a text (segment_id, text).

    ``exact`` is the best phrase's score; ``named`` says whether one is there besides the concept's only term.
    """
    owners = Stored(index.select("idx", F.when(F.size("primary") == 1, F.col("primary")[0]).alias("only"), F.explode("phrases").alias("phrase")))
    hits = phrase_hits(texts, owners.table.select("phrase")).join(owners.side(), "phrase")
    named = F.max(F.col("only").isNotNull() & (F.col("phrase") != F.col("only")))
    return hits.groupBy("segment_id", "idx").agg(F.max(phrase_score(F.col("phrase"))).alias("exact"), named.alias("named"))


def context_score(name: Column, caption: Column, summary: Column, nearby: Column | None = None) -> Column:
    total = F.when(F.contains(F.lower(caption), name), 0.5).otherwise(0.0) + F.when(F.contains(F.lower(summary), name), 0.3).otherwise(0.0)
    if nearby is not None:
        total = total + F.when(F.contains(F.lower(nearby), name), 0.2).otherwise(0.0)
    return F.least(F.lit(1.0), total)


def generic_terms(index: DataFrame) -> DataFrame:
    """(term, df, in_multi, generic) of primary terms: in a concept of several terms and df >= 2, or df >= 3 and df / N >= 0.08."""
    total = index.agg(F.count(F.lit(1)).alias("n"))
    terms = concept_terms(index).join(index.select("idx", (F.size("primary") >= 2).alias("several")), "idx")
    per = terms.groupBy("term").agg(F.count(F.lit(1)).alias("df"), F.count_if(F.col("several") & F.col("is_primary")).alias("in_multi"), F.count_if("is_primary").alias("primary"))
    return per.where("primary > 0").join(F.broadcast(total)).select("term", "df", "in_multi", ((F.col("in_multi") >= 1) & (F.col("df") >= 2) | (F.col("df") >= 3) & (F.col("df") / F.col("n") >= 0.08)).alias("generic"))


def opens(only: Column, caption: Column) -> Column:
    """Whether a single-term concept opens a short caption."""
    title = T.normalized(F.coalesce(caption, F.lit("")))
    after = F.substr(title, F.length(only) + 1, F.lit(1))
    return (title != "") & (F.length(title) <= 80) & F.startswith(title, only) & ~after.rlike(r"^[\p{L}\p{N}_]")


def gated(only: Column, caption: Column, named: Column) -> Column:
    """Whether a generic single-term concept is shut out: unless it opens a short caption, or another name of it is in the text."""
    return ~opens(only, caption) & ~named


def scores(segments: DataFrame, index: DataFrame, fuzzy: bool = True, gate: bool = True, least: float | None = None) -> DataFrame:
    """(segment_id, idx, signals, score) of all pairs with a shared term; with ``least``, of those that can pass it."""
    held = Stored(index)
    index = held.table
    pairs = term_signals(segments, index)
    if least is not None:  # texts are fetched for pairs only that the other signals could lift over the threshold
        pairs = Stored(pairs.where(30 * F.col("cosine") + 25 * F.col("overlap") + 45 > 100 * least - 1e-3)).table
        segments = segments.join(pairs.select("segment_id").distinct(), "segment_id", "left_semi")
    texts = segments.select("segment_id", T.normalized(search_text()).alias("text"))
    only = F.when(F.size("primary") == 1, F.col("primary")[0])
    # of the texts a pair needs two figures; rows stay small from there on, and names come last
    near = held.table.select("idx", "name", only.alias("only"))
    rows = pairs.join(segments.select("segment_id", "caption", "summary", "nearby"), "segment_id").join(F.broadcast(near) if held.bytes <= BROADCAST_BYTES else near, "idx")
    context = context_score(F.col("name"), F.col("caption"), F.col("summary"), F.col("nearby"))
    rows = rows.select("segment_id", "idx", "cosine", "overlap", "only", context.alias("context"), opens(F.col("only"), F.col("caption")).alias("opens"))
    rows = rows.join(exact_scores(texts, index), ["segment_id", "idx"], "left")
    rows = rows.withColumn("exact", F.coalesce("exact", F.lit(0.0))).withColumn("named", F.coalesce("named", F.lit(False)))
    generic = Stored(generic_terms(index))
    if fuzzy:
        near = similarity.fuzzy_scores(similarity.tokens(texts, F.col("text")), index, generic.table)
        rows = rows.join(near, ["segment_id", "idx"], "left").withColumn("fuzzy", F.coalesce("fuzzy", F.lit(0.0)))
    else:
        rows = rows.withColumn("fuzzy", F.lit(0.0))
    rows = rows.withColumn("score", F.least(F.lit(1.0), weighed()))
    if gate:
        known = generic.side().where("generic").select(F.col("term").alias("only"), F.lit(True).alias("generic"))
        shut = F.col("generic").isNotNull() & ~F.col("opens") & ~F.col("named")
        rows = rows.join(known, "only", "left").withColumn("score", F.when(shut, 0.0).otherwise(F.col("score")))
    return rows.join(held.side("idx", "level", "concept", "concept_id"), "idx")


def weighed() -> Column:
    return sum((F.lit(w) * F.col(c) for c, w in SIGNALS.items()), F.lit(0.0)) / 100


def ranked_links(scored: DataFrame, threshold: float = 0.5) -> DataFrame:
    """Links above the threshold, one for each name (lowest level, then best), ranked by score."""
    over = scored.where(F.round("score", 6) > threshold)
    best = Window.partitionBy("segment_id", "concept").orderBy(F.col("level").asc_nulls_last(), F.desc("score"), "idx")
    kept = over.withColumn("place", F.row_number().over(best)).where("place = 1")
    order = Window.partitionBy("segment_id").orderBy(F.desc(F.round("score", 6)), "idx")
    signals = {n: F.col(n) * w for n, w in SIGNALS.items()}
    top = F.round(F.greatest(*signals.values()), 6)
    method = F.coalesce(*[F.when(F.round(v, 6) == top, n) for n, v in signals.items()])
    return kept.select("segment_id", "idx", "concept_id", "concept", "level", "score", method.alias("match_method"), F.row_number().over(order).alias("rank"))


def legacy_scores(segments: DataFrame, index: DataFrame, least: float = 0.3) -> DataFrame:
    """Pairs of the earlier profile over ``least``: plain substrings, n-gram similarity, no gate.

    A segment's concepts meet its text at once, so that a text is dealt and cut into words once, not with each of them.
    """
    held = Stored(index)
    index = held.table
    texts = segments.select("segment_id", F.lower(search_text()).alias("text"))
    names = held.side("idx", F.col("name").alias("phrase"))
    exact = phrase_hits(texts, names, whole=False).join(names, "phrase").select("segment_id", "idx", F.lit(1.0).alias("exact"))
    signals = term_signals(segments, index, hyphen_parts=False).join(exact, ["segment_id", "idx"], "full").na.fill(0.0, ["cosine", "overlap", "exact"])
    # similarity (10) and context (5) alone can't pass, so a pair has a term or its name in the text
    signals = signals.where(30 * F.col("exact") + 30 * F.col("cosine") + 25 * F.col("overlap") + 15 > 100 * least - 1e-3)
    named = signals.join(held.side("idx", "name"), "idx").groupBy("segment_id").agg(F.collect_list(F.struct("idx", "name", "exact", "cosine", "overlap")).alias("found"))
    rows = named.join(segments.select("segment_id", *CHANNELS), "segment_id")
    rows = rows.withColumn("fuzzy", similarity.phrase_ratios(F.lower(search_text()), F.col("found.name")))
    rows = rows.select("segment_id", "caption", "summary", "nearby", F.explode(F.arrays_zip("found", "fuzzy")).alias("pair"))
    rows = rows.select("segment_id", "caption", "summary", "nearby", "pair.found.*", "pair.fuzzy")
    rows = rows.withColumn("context", context_score(F.col("name"), F.col("caption"), F.col("summary"), F.col("nearby")))
    rows = rows.withColumn("score", F.least(F.lit(1.0), weighed())).where(F.round("score", 6) > least).drop("caption", "summary", "nearby", "name")
    return rows.join(held.side("idx", "concept", "level", "concept_id", "name"), "idx")
