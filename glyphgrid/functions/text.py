"""Text primitives as column expressions: terms, captions, line features, concept names."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: The linker's stop words.
STOP_WORDS = [
    "the", "and", "for", "with", "from", "this", "that",
    "are", "was", "were", "been", "have", "has", "had",
    "will", "would", "could", "should", "may", "might",
    "can", "about", "into", "through", "over", "under",
]
#: Caption openers, in order of precedence.
CAPTION_OPENERS = [r"Figure\s+", r"Fig\.\s+", r"Exhibit\s+", r"Chart\s+", r"Diagram\s+"]
#: Phrases that mark a reference to a figure, not its caption.
REFERENCE_PHRASES = ["as shown in", "see figure", "in figure", "refer to", "according to", "as illustrated in", "as depicted in"]
#: Only digits, signs, separators and units.
NUMERIC = r"^[0-9\-/.,\s%$]+$"
NUMERIC_MONEY = r"^[0-9\-/.,\s%$€£¥]+$"
_NUMBER = r"(\d+(?:\.\d+)?)"


def raw_words(text: Column) -> Column:
    """Lower-case words of letters, digits, underscores and hyphens, as they stand."""
    return F.split(F.regexp_replace(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}_\s-]", " "), r"\s+")


def is_term(word: Column) -> Column:
    return (F.length(word) >= 3) & ~word.isin(STOP_WORDS)


def terms(text: Column, hyphen_parts: bool = True) -> Column:
    """Distinct lower-case terms of three letters or more that aren't stop words; parts of hyphenated words too."""
    # equal words are trimmed once; parts are made only where there is a hyphen
    stripped = F.transform(F.array_distinct(F.filter(raw_words(text), lambda w: F.length(w) >= 3)), lambda w: F.btrim(w, F.lit("-_")))
    if hyphen_parts:
        joined = F.filter(stripped, lambda w: F.contains(w, F.lit("-")))
        parts = F.flatten(F.transform(joined, lambda w: F.transform(F.split(w, "-"), lambda p: F.btrim(p, F.lit("-_")))))
        stripped = F.when(F.size(joined) > 0, F.concat(stripped, parts)).otherwise(stripped)
    return F.array_distinct(F.filter(stripped, is_term))


def normalized(text: Column) -> Column:
    """Lower case, dashes as hyphens, single spaces."""
    return F.regexp_replace(F.trim(F.regexp_replace(F.lower(text), "[–—]", "-")), r"\s+", " ")


def concept_id(name: Column, index: Column) -> Column:
    slug = F.regexp_replace(F.regexp_replace(F.trim(F.lower(name)), r"[^\p{L}\p{N}_\s-]", ""), r"[-\s]+", "_")
    return F.format_string("concept_%s_%03d", F.substring(slug, 1, 50), index)


def caption_number(text: Column) -> Column:
    """Number of the first opener in order that occurs anywhere; null if none does."""
    found = [F.nullif(F.regexp_extract(text, f"(?i){opener}{_NUMBER}", 1), F.lit("")) for opener in CAPTION_OPENERS]
    return F.coalesce(*found)


def caption_body(text: Column) -> Column:
    """Text after the number, up to a blank line."""
    found = [F.when(text.rlike(f"(?i){o}{_NUMBER}"), F.regexp_extract(text, rf"(?is){o}{_NUMBER}\s*[:\-]?\s*(.*?)(?=\n\n|\z)", 2)) for o in CAPTION_OPENERS]
    return F.coalesce(*found)


def caption_start(text: Column) -> Column:
    """0-based start of the first opener in order that matches."""
    starts = [F.when(text.rlike(f"(?i){o}{_NUMBER}"), F.regexp_instr(text, F.lit(f"(?i){o}{_NUMBER}")) - 1) for o in CAPTION_OPENERS]
    return F.coalesce(*starts)


def is_caption(text: Column) -> Column:
    reference = F.lower(text).rlike(r"\b(?:" + "|".join(REFERENCE_PHRASES) + r")\b")
    return F.coalesce(caption_start(text) < 20, F.lit(False)) & ~reference & (F.length(text) < 400)


def lines(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n")


def structured_lines(text: Column) -> dict[str, Column]:
    """Lines with a digit are values; other short ones labels; the rest annotations."""
    kept = F.filter(F.transform(lines(text), lambda x: F.trim(x)), lambda x: x != "")
    return {
        "labels": F.filter(kept, lambda x: ~x.rlike(r"\d") & (F.length(x) < 30)),
        "values": F.filter(kept, lambda x: x.rlike(r"\d")),
        "annotations": F.filter(kept, lambda x: ~x.rlike(r"\d") & (F.length(x) >= 30)),
    }


def axis_labels(text: Column) -> dict[str, Column]:
    """Last line that names a time axis, and last other line that names a value axis."""
    is_x = lambda x: F.lower(x).rlike("year|time|date")
    is_y = lambda x: ~is_x(x) & F.lower(x).rlike("value|price|amount|%")
    return {k: F.try_element_at(F.filter(lines(text), f), F.lit(-1)) for k, f in (("x", is_x), ("y", is_y))}


def legend_items(text: Column) -> Column:
    clean = F.filter(F.transform(lines(text), lambda x: F.trim(x)), lambda x: (F.length(x) > 3) & (F.length(x) < 40) & ~x.rlike(NUMERIC))
    return F.slice(clean, 1, 10)


def diagram_subtype(text: Column) -> Column:
    """First matching family, in the order of the arms."""
    low = F.lower(F.coalesce(text, F.lit("")))
    families = [("process|flow", "process_flow"), ("decision", "decision_tree"), ("hierarchy|organization", "hierarchy"), ("cycle|circular", "cycle"), ("cause|effect", "causal"), ("system", "system")]
    out = F.lit("unknown")
    for pattern, name in reversed(families):
        out = F.when(low.rlike(pattern), name).otherwise(out)
    return out


#: The shape of an acronym, and what names of two kinds are called besides.
ACRONYM = r"^[A-Za-z][A-Za-z0-9\-]{1,15}s?\z"
BILL_ALIASES = ["treasury bill", "treasury bills", "treasury-bill", "treasury-bills", "t bill", "t bills"]
BILL_ACRONYMS = ["t-bill", "t-bills"]
LIBOR_ALIASES = ["london interbank offer rate", "london interbank offered rate"]


def concept_parts(name: Column) -> dict[str, Column]:
    """Main name, acronyms and aliases of a concept name with parentheses, the latter two sorted."""
    text = F.trim(name)
    inside = F.filter(F.transform(F.regexp_extract_all(text, F.lit(r"\(([^)]+)\)"), 1), lambda x: F.trim(x)), lambda x: x != "")
    main = F.trim(F.regexp_replace(text, r"\s*\([^)]*\)\s*", " "))
    names = F.concat(inside, F.filter(F.array(main), lambda x: x != ""))
    aliases = F.concat(names, F.flatten(F.transform(names, lambda x: F.array(F.replace(x, F.lit("-"), F.lit(" ")), F.regexp_replace(x, r"\s+", " ")))))
    low = F.lower(F.array_join(F.concat(F.array(main), aliases), " "))

    def added(holds: str, values: list[str]) -> Column:
        return F.when(F.contains(low, F.lit(holds)), F.array(*map(F.lit, values))).otherwise(F.array().cast("array<string>"))

    acronyms = F.concat(F.filter(names, lambda x: x.rlike(ACRONYM)), added("t-bill", BILL_ACRONYMS), added("libor", ["libor"]))
    aliases = F.concat(aliases, added("t-bill", BILL_ALIASES), added("libor", LIBOR_ALIASES))
    return {"main": main, "acronyms": F.array_sort(F.array_distinct(F.transform(acronyms, normalized))), "aliases": F.array_sort(F.array_distinct(aliases))}
