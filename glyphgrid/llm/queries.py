"""The contract queries of this package: thin digests of each operator's output."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import additive_ann, common, context_coder, divergence_rules, fill_middle, language_id, neighbour_quality, order_minhash, periodic_runs, rank_bpe, soft_mixing, suffix_dedup, token_counts, url_trust


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = common.read(spark, sf_dir, "documents")
    held_out = common.crc_mod("doc_id", 4) == 2
    fitted = language_id.fit(documents.where(~held_out))
    found = language_id.identify(documents, fitted)
    return found.select("doc_id", (common.crc_mod("doc_id", 4) == 2).alias("held_out"), "lang_pred", "score", "accepted")


def op2_additive_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    return additive_ann.search(common.read(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0, k=20)


#: Rules of the contract.
URL_RULES = [("block", "com/en/"), ("allow", "example.com/en/7"), ("allow", "net/de/"), ("block", "example.net/de/8"), ("block", "org/es/")]


def op3_url_trust(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_trust.judge(common.read(spark, sf_dir, "pages"), URL_RULES)


def op4_order_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return order_minhash.classes(common.read(spark, sf_dir, "documents"), 0.8)


def op5_neighbour_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents, labels = (common.read(spark, sf_dir, t) for t in ("documents", "labels"))
    voters = neighbour_quality.fit(documents, labels.where(common.crc_mod("doc_id", 5) != 0))
    scored = neighbour_quality.score(documents, voters, 0.3)
    return scored.select("doc_id", (common.crc_mod("doc_id", 5) == 0).alias("held_out"), "score", "predicted")


def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_counts(common.read(spark, sf_dir, "documents"), "byte_bpe_50k.json", 1024)


def op7_soft_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = soft_mixing.label_domains(common.read(spark, sf_dir, "labels"))
    mixed = soft_mixing.mix(common.read(spark, sf_dir, "documents"), labels, soft_mixing.TARGETS, budget=1.02)
    shares = [F.col("p")[i].alias(f"p_{domain}") for i, domain in enumerate(soft_mixing.TARGETS)]
    return mixed.select("doc_id", "tokens", *shares, "rate")


def op8_divergence_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence_rules.judge(common.read(spark, sf_dir, "documents"))


def op9_context_coder(spark: SparkSession, sf_dir: str) -> DataFrame:
    return context_coder.written_digests(common.read(spark, sf_dir, "documents"), "word_bpe_49k.json", 2)


def op10_rank_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rank_bpe.round_trip_digests(common.read(spark, sf_dir, "documents"), "byte_bpe_50k.json")


def op11_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    cleaned = suffix_dedup.remove_repeats(common.read(spark, sf_dir, "documents"), width=400)
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda total, s: total + s["stop"] - s["start"])
    return cleaned.select("doc_id", "n_bytes", removed.alias("n_removed"), F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


def planted_repeats(documents: DataFrame) -> DataFrame:
    """(doc_id, text): in a tenth of the documents, by the contract's draw, the words from some place on repeat a block."""
    draw = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    g = F.floor(draw / 10)

    def repeated(words):
        n = F.size(words)
        at = g % n
        period = (1 + F.floor((n - at) / (3 + g % 8))).cast("int")
        times = F.ceil((n - at) / period).cast("int")
        block = F.slice(words, (at + 1).cast("int"), period)
        return F.array_join(F.concat(F.slice(words, F.lit(1), at.cast("int")), F.slice(F.flatten(F.array_repeat(block, times)), F.lit(1), (n - at).cast("int"))), " ")

    words = F.array(F.regexp_extract_all("text", F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0)))
    # the array of one makes a name for the words, so that they are split once
    changed = F.transform(words, lambda w: F.when(F.size(w) > 0, repeated(w)))[0]
    return documents.select("doc_id", F.when(draw % 10 == 0, F.coalesce(changed, F.col("text"))).otherwise(F.col("text")).alias("text"))


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = periodic_runs.runs(planted_repeats(common.read(spark, sf_dir, "documents")), least=12)
    best = F.array_max(F.transform("runs", lambda r: F.struct(r["length"].alias("length"), (-r["start"]).alias("start"), (-r["period"]).alias("period"))))
    lines = F.array_join(F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"])), "\n")
    listed = F.when(F.size("runs") > 0, F.concat(lines, F.lit("\n"))).otherwise("")
    rows = found.select("doc_id", F.size("runs").cast("long").alias("n_runs"), best.alias("best"), listed.alias("listed"), "collapsed")
    length, period = F.col("best.length"), -F.col("best.period")
    return rows.select("doc_id", "n_runs", (-F.col("best.start")).alias("start"), length.alias("length"), period.alias("period"), F.floor(1000 * length / period).alias("exponent_milli"), F.sha2("listed", 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))


def op13_fill_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    back = fill_middle.restore(fill_middle.transform(common.read(spark, sf_dir, "documents"), seed=42, rate=50, spm=80))
    return back.select("doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2("output", 256).alias("output_sha256"), F.sha2("restored", 256).alias("restored_sha256"))


QUERIES = {f.__name__: f for f in (op1_language_id, op2_additive_ann, op3_url_trust, op4_order_minhash, op5_neighbour_quality, op6_token_counts, op7_soft_mixing, op8_divergence_rules, op9_context_coder, op10_rank_bpe, op11_suffix_dedup, op12_periodic_runs, op13_fill_middle)}
#: Sums of the crc32 of a decimal id, bit by bit over its digits, as the database has no function for it.
_CRC = "(4294967295 - list_reduce(list_prepend(4294967295::hugeint, list_transform(range(0, 8 * length(t)), lambda i: case when i % 8 = 0 then ascii(substring(t, (i // 8 + 1)::int, 1))::hugeint else 0 end)), lambda c, b: case when xor(c::ubigint, b::ubigint) % 2 = 1 then xor((xor(c::ubigint, b::ubigint) // 2)::ubigint, 3988292384::ubigint)::hugeint else (xor(c::ubigint, b::ubigint) // 2)::hugeint end))::bigint"
_BLANK = r"[\x20\x09-\x0D]"
_WORD = r"[^\x20\x09-\x0D]+"
ORACLES: dict[str, str] = {
    # bytes as pairs of hexadecimal digits
    "op11_suffix_dedup": """
with texts as (select row_number() over () as rid, doc_id, lower(hex(encode(coalesce(text, '')))) as x from documents),
starts as (select rid, x, unnest(range(length(x) // 2 - 399)) as i from texts where length(x) >= 800),
prints as (select rid, i, md5_number(substring(x, 2 * i + 1, 800)) as h from starts),
twice as (select h from prints group by h having count(*) > 1),
found as (select rid, i from prints semi join twice using (h)),
fresh as (select rid, i, case when i - lag(i) over (partition by rid order by i) <= 400 then 0 else 1 end as fresh from found),
numbered as (select rid, i, sum(fresh) over (partition by rid order by i) as run from fresh),
spans as (select rid, run, min(i) as a, max(i) + 400 as b from numbered group by rid, run),
gaps as (select rid, run, lag(b, 1, 0) over (partition by rid order by a) as a, a as b from spans),
kept as (select g.rid, string_agg(substring(t.x, 2 * g.a + 1, 2 * (g.b - g.a)), '' order by g.run) as x from gaps g join texts t using (rid) group by g.rid),
sums as (select rid, sum(b - a) as n_removed, count(*) as n_spans, max(b) as b from spans group by rid)
select t.doc_id, length(t.x) // 2 as n_bytes, coalesce(n_removed, 0)::bigint as n_removed, coalesce(n_spans, 0) as n_spans,
 sha256(unhex(coalesce(k.x, '') || substring(t.x, 2 * coalesce(s.b, 0) + 1))) as kept_sha256
from texts t left join sums s using (rid) left join kept k using (rid)""",
    "op12_periodic_runs": rf"""
with ids as (select row_number() over () as rid, doc_id, cast(doc_id as varchar) as t, regexp_extract_all(coalesce(text, ''), '{_WORD}') as w from documents),
drawn as (select rid, doc_id, w, len(w) as n, {_CRC} as h from ids),
cutoff as (select *, h // 10 as g from drawn),
placed as (select *, case when h % 10 = 0 and n > 0 then g % n end as a, case when h % 10 = 0 and n > 0 then 1 + (n - g % n) // (3 + g % 8) end as p from cutoff),
words as (select rid, unnest(range(n)) as i, a, p, w from placed),
word as (select rid, i, w[1 + case when a is not null and i >= a then a + (i - a) % p else i end] as word from words),
grams as (select rid, i, count(*) over s as size, hash(string_agg(word, ' ') over s) as gram, word from word window s as (partition by rid order by i rows between current row and 5 following)),
matched as (select x.rid, x.i, y.i - x.i as q from grams x join grams y on x.rid = y.rid and x.gram = y.gram and x.i < y.i where x.size = 6 and y.size = 6),
islands as (select rid, q, i, i - row_number() over (partition by rid, q order by i) as island from matched),
stretches as (select rid, q, min(i) as start, count(*) + 5 + q as length from islands group by rid, q, island),
runs as (select rid, start, length, min(q) as period from stretches where length >= 12 and length >= 2 * q group by rid, start, length),
dropped as (select distinct rid, unnest(range(start + period, start + length)) as i from runs),
kept as (select w.rid, string_agg(w.word, ' ' order by w.i) as collapsed from word w anti join dropped d on w.rid = d.rid and w.i = d.i group by w.rid),
summed as (select rid, count(*) as n_runs, string_agg(start || ',' || length || ',' || period || chr(10), '' order by start, period) as listed, first(struct_pack(s := start, l := length, p := period) order by length desc, start, period) as best from runs group by rid)
select d.doc_id, coalesce(n_runs, 0) as n_runs, best.s as start, best.l as length, best.p as period, 1000 * best.l // best.p as exponent_milli, sha256(coalesce(listed, '')) as runs_sha256, sha256(coalesce(collapsed, '')) as collapsed_sha256
from drawn d left join summed using (rid) left join kept using (rid)""",
    "op13_fill_middle": rf"""
with cut as (select doc_id, coalesce(text, '') as text, regexp_extract_all(coalesce(text, ''), '{_BLANK}*{_WORD}|{_BLANK}+') as u, sha256('42:' || coalesce(cast(doc_id as varchar), '')) as d from documents),
drawn as (select doc_id, text, u, len(u) as n, cast('0x' || substring(d, 1, 8) as bigint) as h1, cast('0x' || substring(d, 9, 8) as bigint) as h2, cast('0x' || substring(d, 17, 8) as bigint) as h3, cast('0x' || substring(d, 25, 8) as bigint) as h4 from cut),
ranked as (select *, least(h1 % (n + 1), h2 % (n + 1)) as a, greatest(h1 % (n + 1), h2 % (n + 1)) as b, case when text = '' or contains(text, '<P>') or contains(text, '<S>') or contains(text, '<M>') or h3 % 100 >= 50 then 'plain' when h4 % 100 < 80 then 'spm' else 'psm' end as form from drawn),
parts as (select *, array_to_string(u[1:a], '') as prefix, array_to_string(u[a + 1:b], '') as middle, array_to_string(u[b + 1:n], '') as suffix from ranked)
select doc_id, n, form, case when form <> 'plain' then length(prefix) end as prefix_chars, case when form <> 'plain' then length(middle) end as middle_chars,
 sha256(case form when 'plain' then text when 'psm' then '<P>' || prefix || '<S>' || suffix || '<M>' || middle else '<S>' || suffix || '<P>' || prefix || '<M>' || middle end) as output_sha256, sha256(text) as restored_sha256
from parts""",
}
