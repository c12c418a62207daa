"""URL filter rules and link-graph propagation over hosts, in DataFrame functions only.

Rules (host and path prefix, longest wins) decide the urls they fit. For the rest
a host's verdict comes from two personalised PageRanks over weighted host edges
found in the pages: trust flows along edges from hosts with allowed urls,
distrust flows against them from hosts with blocked urls. A host is blocked if
distrust makes up more than ``threshold`` of its two scores. Edges and scores
stay in Spark tables, cut once a turn; only a turn's total change is fetched.

Edges are absolute urls anywhere in a page and hosts named in its text (of two
labels where they have a page of their own, as other words look alike), without a
host's links to itself; an edge weighs as often as it occurs. Mass of hosts without
edges goes back to the seeds. Turns go on until the scores left to come add up to less
than ``tolerance``: a turn's change shrinks by the damping each time.

Defined results: a null url, or one without "://", has empty host and path and no
rule; a host that no score reaches is allowed, and so is one whose scores tie at the
threshold; without seeds of a kind that score is 0; null html has no edges; repeated
rows each get their own row, and their links weigh each time; an empty table gives no
row; only the id, url and html columns are read, so other columns can't clash.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import common

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: An absolute url anywhere, or one without a scheme in an attribute.
LINK = r"""(?i)(?:\bhttps?://|(?:href|src|action|content)\s*=\s*["']?//)([^/"'?#\s<>]+)"""
#: A host of two labels or more that stands alone.
NAMED = r"(?<![A-Za-z0-9._@/:-])((?:[A-Za-z0-9-]+\.)+[A-Za-z]{2,})(?![A-Za-z0-9_-])"


def host_and_path(url: Column) -> tuple[Column, Column]:
    rest = F.when(F.contains(url, F.lit("://")), F.substr(url, F.locate("://", url) + 3)).otherwise("")
    host = F.regexp_extract(rest, "^[^/?#]*", 0)
    return F.translate(host, UPPER, LOWER), F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1)


def rule_of(host: Column, path: Column, rules: list[tuple[str, str]]) -> tuple[Column, Column]:
    """The longest fitting rule and its action; null where none fits."""
    name, action = F.lit(None).cast("string"), F.lit(None).cast("string")
    for kind, rule in sorted(rules, key=lambda r: len(r[1])):
        domain, slash, prefix = rule.partition("/")
        fits = ((host == domain) | host.endswith("." + domain)) & path.startswith(slash + prefix)
        name, action = F.when(fits, rule).otherwise(name), F.when(fits, kind).otherwise(action)
    return name, action


def host_edges(pages: DataFrame) -> DataFrame:
    """(src, dst, n) from pages (host, html)."""
    held = pages.where("host <> '' and html is not null").select(F.col("host").alias("src"), "html")
    linked = held.select("src", F.explode(F.regexp_extract_all("html", F.lit(LINK), 1)).alias("dst"))
    named = held.select("src", F.explode(F.regexp_extract_all("html", F.lit(NAMED), 1)).alias("dst"))
    lower = F.translate("dst", UPPER, LOWER).alias("dst")
    short = ~F.contains(F.substring_index("dst", ".", -2), F.lit(".")) | (F.substring_index("dst", ".", -2) == F.col("dst"))
    # counted before they are looked up: short names are few kinds of words
    named = named.select("src", lower).groupBy("src", "dst").agg(F.count(F.lit(1)).alias("n"))
    known = named.where(short).join(pages.select(F.col("host").alias("dst")).distinct(), "dst", "left_semi").select("src", "dst", "n")
    rows = linked.select("src", lower).groupBy("src", "dst").agg(F.count(F.lit(1)).alias("n")).union(named.where(~short)).union(known)
    return rows.where("src <> dst").groupBy("src", "dst").agg(F.sum("n").alias("n"))


def propagate(edges: DataFrame, seeds: DataFrame, damping: float = 0.85, tolerance: float = 1e-6) -> DataFrame:
    """(kind, host, score): personalised PageRank of each kind of seeds (kind, host, mass) over edges (kind, src, dst, n).

    All that later turns add is at most a turn's change times damping / (1 - damping), so that ends the turns.
    """
    sums = edges.groupBy("kind", "src").agg(F.sum("n").alias("all"))
    edges = common.cut(edges.join(sums, ["kind", "src"]).select("kind", F.col("src").alias("host"), "dst", (F.col("n") / F.col("all")).alias("share")))
    total = seeds.groupBy("kind").agg(F.sum("mass").alias("total"))
    seeds = common.cut(seeds.join(total, "kind").select("kind", "host", (F.col("mass") / F.col("total")).alias("seed")))
    scores = seeds.select("kind", "host", F.col("seed").alias("score"))
    while True:
        flow = scores.join(edges, ["kind", "host"]).select("kind", F.col("dst").alias("host"), (damping * F.col("score") * F.col("share")).alias("part"))
        flowed = flow.groupBy("kind", "host").agg(F.sum("part").alias("part"))
        kept = flowed.groupBy("kind").agg(F.sum("part").alias("kept"))
        base = seeds.join(kept, "kind", "left").select("kind", "host", (F.col("seed") * (1 - F.coalesce("kept", F.lit(0.0)))).alias("part"))
        stepped = base.unionByName(flowed).groupBy("kind", "host").agg(F.sum("part").alias("score"))
        before = scores.select("kind", "host", F.col("score").alias("before"))
        scores = common.cut(stepped.join(before, ["kind", "host"], "full").select("kind", "host", F.coalesce("score", F.lit(0.0)).alias("score"), F.coalesce("before", F.lit(0.0)).alias("before")))
        change = scores.agg(F.sum(F.abs(F.col("score") - F.col("before")))).first()[0]
        scores = scores.select("kind", "host", "score")
        if (change or 0.0) * damping / (1 - damping) < tolerance:
            return scores


def judge(pages: DataFrame, rules: list[tuple[str, str]], threshold: float = 0.5, id_column: str = "page_id") -> DataFrame:
    """(id, host, path, rule, verdict, trust, distrust) of every page."""
    rows = common.plain_names(pages, id_column, "url", "html").toDF("id", "url", "html")
    host, path = host_and_path(F.col("url"))
    rows = rows.select("id", "html", F.coalesce(host, F.lit("")).alias("host"), F.coalesce(path, F.lit("")).alias("path"))
    name, action = rule_of(F.col("host"), F.col("path"), rules)
    judged = rows.select("id", "host", "path", name.alias("rule"), action.alias("action"))
    forward = common.cut(host_edges(rows))
    edges = forward.select(F.lit("allow").alias("kind"), "src", "dst", "n").union(forward.select(F.lit("block"), "dst", "src", "n"))
    seeds = judged.where("action is not null and host <> ''").groupBy(F.col("action").alias("kind"), "host").agg(F.count(F.lit(1)).alias("mass"))
    scores = propagate(edges, seeds)
    # a row for each host; pages outnumber hosts, and the join's small side is broadcast only below Spark's size limit
    by_host = scores.groupBy("host").agg(F.sum(F.when(F.col("kind") == "allow", F.col("score")).otherwise(0.0)).alias("trust"), F.sum(F.when(F.col("kind") == "block", F.col("score")).otherwise(0.0)).alias("distrust"))
    out = judged.join(by_host, "host", "left").withColumns({c: F.coalesce(c, F.lit(0.0)) for c in ("trust", "distrust")})
    found = F.when(F.col("distrust") > threshold * (F.col("trust") + F.col("distrust")), "block").otherwise("allow")
    return out.select(F.col("id").alias(id_column), "host", "path", "rule", F.coalesce("action", found).alias("verdict"), "trust", "distrust")
