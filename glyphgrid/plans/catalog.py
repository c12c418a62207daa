"""Named queries over the fixture views, each with the DuckDB SQL that gives the same rows where SQL can."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from glyphgrid.functions import geometry as G
from glyphgrid.functions import text as T
from glyphgrid.operators import calls, composites, extraction, folds, layout, linking, models, ocr, pixels, reading, similarity
from glyphgrid.plans import fixtures as X
from glyphgrid.plans.durable import Stored
from glyphgrid.sources import sinks

QUERIES: dict = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    def register(f):
        QUERIES[f.__name__] = f
        if sql is not None:
            ORACLES[f.__name__] = sql
        return f

    return register


def six(df: DataFrame, *names: str) -> DataFrame:
    return df.withColumns({n: F.round(n, 6) for n in names})


def index_of(spark: SparkSession, sf_dir: str, parsed: bool = True) -> DataFrame:
    """The fixture's concept index, written once a call."""
    return Stored(linking.concepts(X.taxonomy(spark, sf_dir).unionByName(X.gate_taxonomy(spark, sf_dir)), parsed)).table


_STOP = "[" + ", ".join(f"'{w}'" for w in T.STOP_WORDS) + "]"


def sql_terms(column: str, hyphen_parts: bool = True) -> str:
    words = rf"list_transform(string_split_regex(regexp_replace(lower(coalesce({column}, '')), '[^\p{{L}}\p{{N}}_\s-]', ' ', 'g'), '\s+'), lambda w: trim(w, '-_'))"
    if hyphen_parts:
        words = f"flatten(list_transform({words}, lambda w: list_concat([w], list_transform(string_split(w, '-'), lambda p: trim(p, '-_')))))"
    return f"list_distinct(list_filter({words}, lambda x: length(x) >= 3 and not list_contains({_STOP}, x)))"


def sql_norm(column: str) -> str:
    return rf"regexp_replace(trim(regexp_replace(lower({column}), '[–—]', '-', 'g')), '\s+', ' ', 'g')"


def sql_list(values: list[str]) -> str:
    return "[" + ", ".join(f"'{v}'" for v in values) + "]"


#: Longest block of two strings, the first in each where several are as long: [length, -place, -place].
_BLOCK = """list_max(flatten(list_transform(range(1, length(sa) + 1), lambda i: list_transform(list_filter(range(1, length(sa) - i + 2), lambda k: contains(sb, substring(sa, i, k))), lambda k: [k, -i, -instr(sb, substring(sa, i, k))])))) as blk"""


def sql_similar(least: float) -> str:
    """CTE ``sims`` (a, b, ratio): ratios by matching blocks of the pairs in ``cand`` that lengths and letters let through."""
    times = "length({0}) - length(replace({0}, x, ''))".format
    return f"""close as (select a, b from cand where a <> '' and length(b) >= length(a) * {least / (2 - least)} - 1e-9 and length(b) <= length(a) / {least / (2 - least)} + 1e-9
 and 2 * list_sum(list_transform(list_distinct(string_split(a, '')), lambda x: least({times("a")}, {times("b")}))) >= {least} * (length(a) + length(b)) - 1e-9),
mb as (select a, b, a as sa, b as sb from close where a <> b union all
 select a, b, case side when 0 then substring(sa, 1, -blk[2] - 1) else substring(sa, blk[1] - blk[2]) end, case side when 0 then substring(sb, 1, -blk[3] - 1) else substring(sb, blk[1] - blk[3]) end
 from (select *, {_BLOCK} from mb where sa <> '' and sb <> '') cross join (values (0), (1)) as s(side) where blk is not null),
sims as (select a, b, 2.0 * sum(coalesce(blk[1], 0)) / (length(a) + length(b)) as ratio from (select *, {_BLOCK} from mb) group by a, b having 2.0 * sum(coalesce(blk[1], 0)) / (length(a) + length(b)) >= {least} - 1e-12 union all select a, b, 1.0 from close where a = b)"""


PARTS = rf"""p0 as (select *, list_filter(list_transform(regexp_extract_all(trim(concept), '\(([^)]+)\)', 1), lambda x: trim(x)), lambda x: x <> '') as inside, trim(regexp_replace(trim(concept), '\s*\([^)]*\)\s*', ' ', 'g')) as main from fx_taxonomy where concept <> ''),
p1 as (select *, inside || list_filter([main], lambda x: x <> '') as names from p0),
p2 as (select *, names || list_transform(names, lambda x: replace(x, '-', ' ')) || list_transform(names, lambda x: regexp_replace(x, '\s+', ' ', 'g')) as al from p1),
p3 as (select *, lower(main || ' ' || array_to_string(al, ' ')) as low from p2),
parts as (select *, list_sort(list_distinct(list_transform(list_filter(names, lambda x: regexp_matches(x, '^[A-Za-z][A-Za-z0-9\-]{{1,15}}s?$')) || case when contains(low, 't-bill') then {sql_list(T.BILL_ACRONYMS)} else [] end || case when contains(low, 'libor') then ['libor'] else [] end, lambda x: {sql_norm("x")}))) as acronyms,
 list_sort(list_distinct(al || case when contains(low, 't-bill') then {sql_list(T.BILL_ALIASES)} else [] end || case when contains(low, 'libor') then {sql_list(T.LIBOR_ALIASES)} else [] end)) as aliases from p3)"""
_WORD = r"[^\p{L}\p{N}_]"
_HELD = rf"contains(text, regexp_extract(p, '^[^-]*', 0)) and regexp_matches(text, '(^|{_WORD})' || regexp_replace(regexp_replace(p, '([\\.\[\]{{}}()*+?^$|])', '\\\1', 'g'), '-', '[-\\s]', 'g') || '($|{_WORD})')"


def sql_link(parsed: bool = True) -> str:
    """CTEs up to the term signals of pairs with a shared term; the index of whole names if not ``parsed``."""
    if parsed:
        index = f"""{PARTS},
idx1 as (select *, {sql_terms("main")} as prim, {sql_terms("tags")} as ctx, acronyms || flatten(list_transform(aliases, lambda y: {sql_terms("y")})) as others from parts),
idx0 as (select idx, level, concept, lower(concept) as name, acronyms, prim, ctx, list_distinct(prim || others || ctx) as norms, list_distinct(list_filter(list_transform([concept, main] || aliases || acronyms, lambda x: {sql_norm("x")}), lambda x: x <> '')) as phrases from idx1)"""
        text = sql_norm("concat_ws(' ', nullif(caption, ''), nullif(summary, ''), nullif(ocr, ''), nullif(nearby, ''))")
    else:
        index = f"""idx1 as (select idx, level, concept, lower(concept) as name, {sql_terms("concept", False)} as prim, {sql_terms("tags", False)} as ctx from fx_taxonomy where concept <> ''), idx0 as (select *, list_distinct(prim || ctx) as norms from idx1)"""
        text = "lower(concat_ws(' ', nullif(caption, ''), nullif(summary, ''), nullif(ocr, ''), nullif(nearby, '')))"
    channels = " union all ".join(f"select segment_id, unnest({sql_terms(c, parsed)}) as term, {w}::double as w from fx_segments" for c, w in linking.CHANNELS.items())
    return f"""{X.ctes("fx_segments", "fx_taxonomy").replace("with ", "with recursive ", 1)},
{index},
ct as (select idx, term, list_contains(prim, term) as p, list_contains(ctx, term) as c, len(prim) as size from (select idx, prim, ctx, unnest(norms) as term from idx0)),
n as (select count(*) as n from idx0),
df as (select term, count(*) as df from ct group by term),
idf as (select term, df, ln((n + 1) / (df + 1)) + 1 as idf from df, n),
st as (select segment_id, term, sum(w) as weight from ({channels}) group by all),
sv as (select segment_id, term, weight / sum(weight) over (partition by segment_id) * (ln((n + 1) / (coalesce(df, 1) + 1)) + 1) as value from st left join df using (term), n),
cv as (select idx, term, w / sum(w) over (partition by idx) * idf as value from (select idx, term, (case when p then 2.0 else 0.0 end + case when c then 1.0 else 0.0 end)::double as w from ct where p or c) join idf using (term)),
sn as (select *, sqrt(sum(value * value) over (partition by segment_id)) as norm from sv),
cn as (select *, sqrt(sum(value * value) over (partition by idx)) as norm from cv),
cosine as (select segment_id, idx, least(1.0, greatest(0.0, sum(sn.value * cn.value) / (any_value(sn.norm) * any_value(cn.norm)))) as cosine from sn join cn using (term) group by all),
pt as (select ct.*, idf, sum(case when p then idf else 0 end) over (partition by idx) as alls from ct join idf using (term)),
overlap as (select segment_id, idx, case when any_value(alls) > 0 then least(1.0, sum(case when p then idf else 0.5 * idf end) / any_value(alls)) else 0.0 end as overlap from st join pt using (term) group by all),
pairs as (select segment_id, idx, coalesce(cosine, 0.0) as cosine, overlap from overlap left join cosine using (segment_id, idx)),
gen as (select term, df, in_multi, (in_multi >= 1 and df >= 2) or (df >= 3 and df / n >= 0.08) as generic from (select term, count(*) as df, count(*) filter (where p and size >= 2) as in_multi, count(*) filter (where p) as prims from ct group by term), n where prims > 0),
txt as (select segment_id, coalesce(caption, '') as caption, coalesce(summary, '') as summary, coalesce(nearby, '') as nearby, {text} as text from fx_segments)"""  # noqa: E501


_CONTEXT = "case when contains(lower(caption), name) then 0.5 else 0 end + case when contains(lower(summary), name) then 0.3 else 0 end + case when contains(lower(nearby), name) then 0.2 else 0 end"
LINK = sql_link()
EXACT = rf"""{LINK},
sig as (select segment_id, idx, level, concept, name, prim, phrases, caption, text, cosine, overlap, {_CONTEXT} as context,
 coalesce(list_max(list_transform(phrases, lambda p: case when {_HELD} then case when contains(p, ' ') or regexp_matches(p, '^[a-z]{{2,10}}(-[a-z]{{1,10}})?s?$') then 1.0 else 0.7 end else 0.0 end)), 0.0) as exact
 from pairs join txt using (segment_id) join idx0 using (idx))"""
FUZZY = rf"""{EXACT},
tok as (select segment_id, unnest(list_distinct(regexp_extract_all(text, '[a-z0-9]+(?:-[a-z0-9]+)?'))) as w from txt), voc as (select distinct w, replace(w, '-', '') as bare from tok),
prims as (select idx, size, term, replace(term, '-', '') as a from ct where p), acs as (select idx, unnest(acronyms) as a from idx0),
cand as (select distinct a, b from (select a, bare as b from (select distinct a from prims) join (select distinct bare from voc) on length(bare) between length(a) * 0.78 and length(a) * 1.28 union all select a, w from (select distinct a from acs) join voc on length(w) between length(a) * 0.78 and length(a) * 1.28)),
{sql_similar(0.88)},
met as (select segment_id, idx, any_value(size) as size, count(distinct term) as met from (select distinct segment_id, a from tok join sims on replace(w, '-', '') = b) join prims using (a) group by all having true),
fz as (select segment_id, idx, max(f) as fuzzy from (select segment_id, idx, case when size >= 2 and met >= 2 then 0.9 when size = 1 and met = 1 then 0.82 end::double as f from met union all select segment_id, idx, ratio from tok join sims on w = b join acs using (a))
 where f is not null and idx not in (select idx from idx0 where len(prim) = 1 and prim[1] in (select term from gen where generic)) group by all),
scored as (select sig.*, coalesce(fuzzy, 0.0) as fuzzy, case when len(prim) = 1 and prim[1] in (select term from gen where generic) and not (length({sql_norm("caption")}) <= 80 and starts_with({sql_norm("caption")}, prim[1]) and not regexp_matches(substring({sql_norm("caption")}, length(prim[1]) + 1, 1), '^[\p{{L}}\p{{N}}_]'))
 and len(list_filter(phrases, lambda p: p <> prim[1] and {_HELD})) = 0 then 0.0 else least(1.0, (30 * exact + 30 * cosine + 25 * overlap + 10 * coalesce(fuzzy, 0.0) + 5 * context) / 100) end as score from sig left join fz using (segment_id, idx))"""
BLOCKS = X.ctes("fx_blocks")
LAYOUT = X.ctes("fx_blocks", "fx_drawings", "fx_images")
OCR = X.ctes("fx_ocr")
RAW = OCR + ",\nraw as (select segment_id, string_agg(text, chr(10) order by idx) as text from fx_ocr group by segment_id)"
_NUM = r"([0-9]+(?:\.[0-9]+)?)"
_OPEN = [r"figure\s+", r"fig\.\s+", r"exhibit\s+", r"chart\s+", r"diagram\s+"]


def sql_number(column: str) -> str:
    return "coalesce(" + ", ".join(f"nullif(regexp_extract({column}, '(?i){o}{_NUM}', 1), '')" for o in _OPEN) + ")"


_CAPS = rf""", caps as (select *, {sql_number("text")} as figure_number from fx_blocks where coalesce({", ".join(f"case when regexp_matches(text, '(?i){o}{_NUM}') then length(regexp_extract(text, '(?is)^(.*?){o}{_NUM}', 1)) end" for o in _OPEN)}) < 20
 and not regexp_matches(lower(text), '\b(as shown in|see figure|in figure|refer to|according to|as illustrated in|as depicted in)\b') and length(text) < 400),
anchor as (select doc_id, page_no, block_no as region_id, x0 as c_x0, y0 as c_y0, x1 as c_x1, y1 as c_y1, page_width as pw, greatest(0.0, y0 - 500) as start from caps)"""
_CAPS_KEYS = f"{BLOCKS}{_CAPS} select doc_id, page_no, block_no, 'Figure ' || figure_number || '|Fig. ' || figure_number || '|Fig ' || figure_number as keys from caps"
_BOUNDS = f"""{LAYOUT}{_CAPS},
dr as (select a.doc_id, a.page_no, region_id, min(x0) as dx0, min(y0) as dy0, max(x1) as dx1, max(y1) as dy1 from anchor a join fx_drawings d on a.doc_id = d.doc_id and a.page_no = d.page_no and y0 >= start and y0 < c_y0 group by all),
im as (select a.doc_id, a.page_no, region_id, min(x0) as ix0, min(y0) as iy0, max(x1) as ix1, max(y1) as iy1 from anchor a join fx_images d on a.doc_id = d.doc_id and a.page_no = d.page_no and y0 >= start and y0 < c_y0 group by all),
wb as (select a.doc_id, a.page_no, region_id, block_no, x0, x1, y0, y1, text, page_width from anchor a join fx_blocks b on a.doc_id = b.doc_id and a.page_no = b.page_no and y0 >= start and y0 < c_y0),
gaps as (select doc_id, page_no, region_id, y1, row_number() over w as place, lead(y0) over w - y1 as gap from wb window w as (partition by doc_id, page_no, region_id order by y1, block_no)),
ws as (select doc_id, page_no, region_id, y1 + 5 as ws_y from (select *, row_number() over (partition by doc_id, page_no, region_id order by gap desc, place) as r from gaps where gap > 20) where r = 1 and gap > 30 and y1 <> 0),
tx as (select doc_id, page_no, region_id, max(y1) filter (where body) + 20 as tx_y, min(x0) filter (where not body) as tx_x0, max(x1) filter (where not body) as tx_x1
 from (select *, (x1 - x0 > page_width * 0.65 and length(text) > 120 and y1 - y0 > 35 and x0 < page_width * 0.15) as body from wb) group by all having max(y1) filter (where body) is not null)"""
# regions of the neighbourhood operators: embedded images
_REGION = f"{LAYOUT}, region as (select doc_id, page_no, img_no as region_id, x0, y0, x1, y1 from fx_images)"


def regions(spark, d) -> DataFrame:
    return X.images(spark, d).select("doc_id", "page_no", F.col("img_no").alias("region_id"), *layout.BOX)


# ---- linking ----
@query(f"select doc_id as segment_id, unnest({sql_terms('text')}) as term from documents")
def extract_terms(spark, d):
    return X.table(spark, d, "documents").select(F.col("doc_id").alias("segment_id"), F.explode(T.terms(F.col("text"))).alias("term"))


@query(f"{LINK} select term, df from df")
def term_df(spark, d):
    return linking.document_frequency(linking.concept_terms(index_of(spark, d)))


@query(f"{LINK} select term, df, round(idf, 6) as idf from idf")
def term_idf(spark, d):
    return six(linking.term_idf(index_of(spark, d)), "idf")


@query(f"{X.ctes('fx_taxonomy')} select idx, 'concept_' || substring(regexp_replace(regexp_replace(trim(lower(concept)), '[^\\p{{L}}\\p{{N}}_\\s-]', '', 'g'), '[-\\s]+', '_', 'g'), 1, 50) || '_' || printf('%03d', idx) as concept_id from fx_taxonomy")
def concept_ids(spark, d):
    return index_of(spark, d).select("idx", "concept_id")


@query(f"{X.ctes('fx_taxonomy')}, {PARTS} select idx, main, array_to_string(acronyms, '|') as acronyms, array_to_string(aliases, '|') as aliases from parts")
def concept_parse(spark, d):
    return index_of(spark, d).select("idx", "main", *[F.array_join(c, "|").alias(c) for c in ("acronyms", "aliases")])


@query(f"{LINK} select idx, array_to_string(list_sort(norms), '|') as terms, array_to_string(list_sort(phrases), '|') as phrases from idx0")
def concept_index(spark, d):
    return index_of(spark, d).select("idx", F.array_join(F.array_sort("normalized"), "|").alias("terms"), F.array_join("phrases", "|").alias("phrases"))


@query(f"select doc_id, {sql_norm('text')} as text from documents")
def normalized_text(spark, d):
    return X.table(spark, d, "documents").select("doc_id", T.normalized(F.col("text")).alias("text"))


@query(f"{LINK} select term, df, in_multi, generic from gen")
def generic_terms(spark, d):
    return linking.generic_terms(index_of(spark, d))


@query(f"{LINK} select segment_id, term, round(value, 6) as value from sv")
def search_tfidf(spark, d):
    return six(linking.search_vectors(X.segments(spark, d), index_of(spark, d)), "value")


@query(f"{LINK} select idx, term, round(value, 6) as value from cv")
def concept_tfidf(spark, d):
    return six(linking.concept_vectors(index_of(spark, d)), "value")


def pair_signals(spark, d) -> DataFrame:
    return linking.term_signals(X.segments(spark, d), index_of(spark, d))


def scored(spark, d, **options) -> DataFrame:
    return linking.scores(X.segments(spark, d), index_of(spark, d), **options)


@query(f"{LINK} select segment_id, idx, round(cosine, 6) as cosine from pairs where round(cosine, 6) > 0")
def link_cosine(spark, d):
    return six(pair_signals(spark, d).select("segment_id", "idx", "cosine"), "cosine").where("cosine > 0")


@query(f"{LINK} select segment_id, idx, round(overlap, 6) as overlap from pairs")
def link_overlap(spark, d):
    return six(pair_signals(spark, d).select("segment_id", "idx", "overlap"), "overlap")


@query(f"{EXACT} select segment_id, idx, exact::double as exact from sig where exact > 0")
def link_exact(spark, d):
    return scored(spark, d, fuzzy=False, gate=False).where("exact > 0").select("segment_id", "idx", "exact")


@query(f"{EXACT} select segment_id, idx, round(context, 6)::double as context from sig where context > 0")
def link_context(spark, d):
    return six(scored(spark, d, fuzzy=False, gate=False).where("context > 0").select("segment_id", "idx", "context"), "context")


@query(f"{FUZZY} select segment_id, idx, round(fuzzy, 6) as fuzzy from fz")
def link_fuzzy(spark, d):
    segments, index = X.segments(spark, d), index_of(spark, d)
    found = similarity.tokens(segments, T.normalized(linking.search_text()))
    return six(similarity.fuzzy_scores(found, index, linking.generic_terms(index)), "fuzzy")


@query(f"{FUZZY} select a, b, round(ratio, 6) as ratio from sims")
def string_similarity(spark, d):
    segments, index = X.segments(spark, d), index_of(spark, d)
    words = similarity.tokens(segments, T.normalized(linking.search_text())).select("w").distinct()
    bare = lambda c: F.replace(F.col(c), F.lit("-"), F.lit(""))
    terms = index.select(F.explode("primary").alias("t")).select(bare("t").alias("a"))
    near = similarity.similar_terms(terms, words.select(bare("w").alias("b")))
    return six(near.union(similarity.similar_terms(index.select(F.explode("acronyms").alias("a")), words.select(F.col("w").alias("b")))).distinct(), "ratio")


@query(f"{FUZZY} select segment_id, idx, round(score, 6)::double as score from scored")
def link_score(spark, d):
    return six(scored(spark, d).select("segment_id", "idx", "score"), "score")


@query(f"""{FUZZY}, kept as (select * from (select *, row_number() over (partition by segment_id, concept order by level, score desc, idx) as place from scored where round(score, 6) > 0.5) where place = 1),
best as (select *, greatest(30 * exact, 30 * cosine, 25 * overlap, 10 * fuzzy, 5 * context) as top from kept)
select segment_id, idx, concept, level, round(score, 6)::double as score, case round(top, 6) when round(30 * exact, 6) then 'exact' when round(30 * cosine, 6) then 'cosine' when round(25 * overlap, 6) then 'overlap' when round(10 * fuzzy, 6) then 'fuzzy' else 'context' end as match_method, row_number() over (partition by segment_id order by round(score, 6) desc, idx) as rank from best""")
def link_ranked_dedup(spark, d):
    return six(linking.ranked_links(scored(spark, d, least=0.5)).select("segment_id", "idx", "concept", "level", "score", "match_method", "rank"), "score")


@query(f"""{sql_link(False)}, hit as (select segment_id, idx, 1.0 as exact from txt join idx0 on contains(text, name)),
alls as (select segment_id, idx, coalesce(exact, 0) as exact, coalesce(cosine, 0) as cosine, coalesce(overlap, 0) as overlap from pairs full join hit using (segment_id, idx)),
able as (select * from alls join txt using (segment_id) join idx0 using (idx) where 30 * exact + 30 * cosine + 25 * overlap + 15 > 30 - 1e-3),
grams as (select segment_id, idx, name as a, unnest(list_distinct(list_transform(range(1, len(ws) - k + 2), lambda i: array_to_string(ws[i:i + k - 1], ' ')))) as b from (select *, regexp_extract_all(text, '\\S+') as ws, len(regexp_extract_all(name, '\\S+')) as k from able)),
cand as (select distinct a, b from grams),
{sql_similar(0.8)},
best as (select segment_id, idx, max(ratio) as fuzzy from grams join sims using (a, b) group by all),
leg as (select segment_id, idx, least(1.0, (30 * exact + 30 * cosine + 25 * overlap + 10 * coalesce(fuzzy, 0) + 5 * ({_CONTEXT})) / 100) as score from able left join best using (segment_id, idx))
select segment_id, idx, round(score, 6)::double as score from leg where round(score, 6) > 0.3""")
def link_legacy(spark, d):
    return six(linking.legacy_scores(X.segments(spark, d), index_of(spark, d, False)).select("segment_id", "idx", "score"), "score")


# ---- layout ----
@query(f"{BLOCKS} select doc_id, page_no, block_no, text from fx_blocks")
def text_blocks(spark, d):
    spans = X.blocks(spark, d).select("doc_id", "page_no", "block_no", F.posexplode(F.split("text", " ")).alias("span_no", "text")).withColumn("line_no", F.expr("cast(span_no / 5 as int)"))
    return layout.text_blocks(spans)


@query(f"{BLOCKS}{_CAPS} select doc_id, page_no, block_no, figure_number, text from caps")
def caption_blocks(spark, d):
    return layout.caption_blocks(X.blocks(spark, d)).select("doc_id", "page_no", "block_no", "figure_number", "text")


@query(f"""{_REGION}, near as (select doc_id, page_no, region_id, string_agg(b.text, ' ' order by block_no) as text from region r join fx_blocks b using (doc_id, page_no) where abs(b.y0 - r.y1) < 50 or abs(r.y0 - b.y1) < 50 group by all)
select doc_id, page_no, region_id, {sql_number("text")} as figure_number, coalesce({", ".join(f"case when regexp_matches(text, '(?i){o}{_NUM}') then trim(regexp_extract(text, '(?is){o}{_NUM}{chr(92)}s*[:{chr(92)}-]?{chr(92)}s*(.*)', 2)) end" for o in _OPEN)}, substring(text, 1, 200)) as caption from near""")
def detect_caption(spark, d):
    return layout.detect_caption(regions(spark, d), X.blocks(spark, d)).select("doc_id", "page_no", "region_id", "figure_number", "caption")


@query(f"""{_REGION} select doc_id, page_no, region_id, arg_min(b.text, block_no) as caption from region r join fx_blocks b using (doc_id, page_no) where b.y0 - r.y1 between 0 and 60 and least(r.x1, b.x1) - greatest(r.x0, b.x0) > 0 and {sql_number("b.text")} is not null group by all""")
def caption_near(spark, d):
    return layout.caption_below(regions(spark, d), X.blocks(spark, d))


@query(f"""{_REGION}, h as (select doc_id, page_no, region_id, list(trim(b.text) order by block_no) as l from region r join fx_blocks b using (doc_id, page_no) where b.y1 < r.y0 and font_size > 12 and length(trim(b.text)) > 3 group by all)
select doc_id, page_no, region_id, array_to_string(l[greatest(len(l) - 2, 1):], ' > ') as heading_path from h""")
def heading_path(spark, d):
    return layout.heading_path(regions(spark, d), X.blocks(spark, d))


@query(f"""{_REGION} select doc_id, page_no, region_id, substring(string_agg(b.text, ' ' order by block_no), 1, 500) as nearby_text from region r join fx_blocks b using (doc_id, page_no) where least(abs(b.y0 - r.y1), abs(r.y0 - b.y1)) < 100 group by all""")
def nearby_text(spark, d):
    return layout.nearby_text(regions(spark, d), X.blocks(spark, d))


_RATIO = "case when least((a.x1-a.x0)*(a.y1-a.y0), (b.x1-b.x0)*(b.y1-b.y0)) > 0 then greatest(0.0, least(a.x1,b.x1)-greatest(a.x0,b.x0)) * greatest(0.0, least(a.y1,b.y1)-greatest(a.y0,b.y0)) / least((a.x1-a.x0)*(a.y1-a.y0), (b.x1-b.x0)*(b.y1-b.y0)) else 0.0 end"


@query(f"{LAYOUT}, p as (select a.doc_id, a.page_no, a.draw_no as a_id, b.img_no as b_id, {_RATIO} as ratio from fx_drawings a join fx_images b using (doc_id, page_no)) select doc_id, page_no, a_id, b_id, round(ratio, 6) as ratio, ratio > 0.4 as conflict from p where ratio > 0")
def overlap_pairs(spark, d):
    a = X.drawings(spark, d).withColumnRenamed("draw_no", "id")
    b = X.images(spark, d).select("doc_id", "page_no", F.col("img_no").alias("id"), *layout.BOX)
    return six(layout.overlap_pairs(a, b), "ratio")


@query(f"{_BOUNDS} select doc_id, page_no, region_id, dx0 as dr_x0, dy0 as dr_y0, dx1 as dr_x1, dy1 as dr_y1 from dr")
def drawing_bounds(spark, d):
    return layout.window_bounds(layout.captions_of(X.blocks(spark, d)), X.drawings(spark, d), "dr")


@query(f"{_BOUNDS} select doc_id, page_no, region_id, ws_y from ws")
def whitespace_boundary(spark, d):
    b = X.blocks(spark, d)
    return layout.whitespace_boundary(layout.captions_of(b), b)


@query(f"{_BOUNDS} select doc_id, page_no, region_id, tx_y, tx_x0, tx_x1 from tx")
def text_boundary(spark, d):
    b = X.blocks(spark, d)
    return layout.text_boundary(layout.captions_of(b), b)


_COMBINED = f"""{_BOUNDS}, j as (select * from anchor left join dr using (doc_id, page_no, region_id) left join im using (doc_id, page_no, region_id) left join ws using (doc_id, page_no, region_id) left join tx using (doc_id, page_no, region_id)),
k as (select *, greatest(0.0, dx0-10) as ax0, greatest(start, greatest(dy0, coalesce(ws_y, dy0))-10) as ay0, least(pw, dx1+10) as ax1, least(c_y0-5, dy1+10) as ay1,
 greatest(0.0, ix0-5) as bx0, greatest(start, greatest(iy0, coalesce(ws_y, iy0))-5) as by0, least(pw, ix1+5) as bx1, least(c_y0-5, iy1+5) as by1,
 greatest(0.0, c_x0-30) as l, least(pw, c_x1+30) as r, greatest(0.0, c_x0-20) as fx0, least(pw, c_x1+20) as fx1, greatest(start, c_y0-250) as fy0, c_y0-10 as e from j),
s as (select *, case when dy0 is not null and ax1-ax0>50 and ay1-ay0>50 then 'drawing' when iy0 is not null and bx1-bx0>50 and by1-by0>50 then 'image' when ws_y is not null and r-l>80 and e-ws_y>60 then 'whitespace'
 when tx_y is not null and coalesce(tx_x1, r)-coalesce(tx_x0, l)>80 and e-tx_y>60 then 'text' when fx1-fx0>100 and e-fy0>80 and e-fy0<500 then 'fallback' end as signal from k),
comb as (select doc_id, page_no, region_id, signal, least(c_x0, case signal when 'drawing' then ax0 when 'image' then bx0 when 'whitespace' then l when 'text' then coalesce(tx_x0, l) else fx0 end) as x0,
 case signal when 'drawing' then ay0 when 'image' then by0 when 'whitespace' then ws_y when 'text' then tx_y else fy0 end as y0,
 greatest(c_x1, case signal when 'drawing' then ax1 when 'image' then bx1 when 'whitespace' then r when 'text' then coalesce(tx_x1, r) else fx1 end) as x1, c_y1 + 5 as y1 from s where signal is not null)"""


@query(f"{_COMBINED} select * from comb")
def combined_region(spark, d):
    b = X.blocks(spark, d)
    return layout.extend_to_caption(layout.combine_boundaries(layout.captions_of(b), b, X.drawings(spark, d), X.images(spark, d)))


_VALID = f"""{_REGION}, cap as (select doc_id, page_no, region_id, arg_min(b.text, block_no) as caption from region r join fx_blocks b using (doc_id, page_no) where b.y0 - r.y1 between 0 and 60 and least(r.x1, b.x1) - greatest(r.x0, b.x0) > 0 and {sql_number("b.text")} is not null group by all),
v as (select i.*, cap.caption, case when (x1-x0)*(y1-y0) < 3000 or px_w < 50 or px_h < 50 then 0.0 else least(1.0, round(case when (x1-x0)*(y1-y0) > 10000 then 0.3 else 0.1 end + case when px_w > 200 and px_h > 200 then 0.2 else 0 end + case when px_w / px_h > 0.2 and px_w / px_h < 5 then 0.2 else -0.1 end
 + case when y0/1260 < 0.1 or y0/1260 > 0.9 then -0.2 else 0.1 end + case when caption is not null then 0.4 else 0 end + case when grey_var < 10 then -0.3 when grey_var > 100 then 0.2 else 0 end, 6)) end::double as score from fx_images i left join cap on i.doc_id = cap.doc_id and i.page_no = cap.page_no and i.img_no = cap.region_id)"""


_NOTES = """case when (x1-x0)*(y1-y0) < 3000 then 'too_small' when px_w < 50 or px_h < 50 then 'tiny_dimensions' else concat_ws(', ', case when (x1-x0)*(y1-y0) > 10000 then 'good_size' else 'moderate_size' end, case when px_w > 200 and px_h > 200 then 'substantial_dimensions' end,
 case when px_w / px_h > 0.2 and px_w / px_h < 5 then 'good_aspect_ratio' else 'unusual_aspect_ratio' end, case when y0/1260 < 0.1 or y0/1260 > 0.9 then 'likely_header_footer' else 'good_position' end, case when caption is not null then 'has_caption' end, case when grey_var < 10 then 'low_variance' when grey_var > 100 then 'good_content_variance' end) end"""


@query(f"{_VALID} select doc_id, page_no, img_no, score, score >= 0.5 as kept, {_NOTES} as notes from v")
def embedded_validation(spark, d):
    return layout.validate_images(X.images(spark, d), X.blocks(spark, d)).select("doc_id", "page_no", "img_no", "score", "kept", "notes")


_EMBEDDED = """, grown as (select v.doc_id, v.page_no, img_no, arg_min({'x0': b.x0, 'x1': b.x1, 'y1': b.y1}, block_no) as b from v join fx_blocks b on v.doc_id = b.doc_id and v.page_no = b.page_no and contains(b.text, substring(v.caption, 1, 30)) where v.caption is not null group by all),
emb as (select doc_id, page_no, img_no, least(x0, coalesce(b.x0, x0)) as x0, y0, greatest(x1, coalesce(b.x1, x1)) as x1, greatest(y1, coalesce(b.y1, y1)) as y1, caption, score, grey_var from v left join grown using (doc_id, page_no, img_no) where score >= 0.5)"""


@query(_VALID + _EMBEDDED + " select doc_id, page_no, img_no as idx, x0, y0, x1, y1, caption, score from emb")
def embedded_candidates(spark, d):
    return extraction.embedded_candidates(X.images(spark, d), X.blocks(spark, d)).select("doc_id", "page_no", "idx", *layout.BOX, "caption", "score")


_AREA = "(greatest(0.0, {0}.x1 - {0}.x0) * greatest(0.0, {0}.y1 - {0}.y0))".format
_FOLD = f""", both_ as (select doc_id, page_no, 1 as pass_no, region_id as idx, x0, y0, x1, y1, true as captioned, null::double as grey_var, 0.9 as score from comb
 union all select doc_id, page_no, 2, img_no, x0, y0, x1, y1, coalesce(caption <> '', false), grey_var, score from emb),
inside as (select a.doc_id, a.page_no, a.pass_no, a.idx, count(*) as n from both_ a join fx_drawings d on a.doc_id = d.doc_id and a.page_no = d.page_no and d.x0 between a.x0 and a.x1 and d.y0 between a.y0 and a.y1 group by all),
item as (select doc_id, page_no, pass_no, {{'pass_no': pass_no, 'idx': idx, 'x0': x0, 'y0': y0, 'x1': x1, 'y1': y1, 'captioned': captioned, 'grey_var': coalesce(grey_var, 0.0), 'score': score, 'n': coalesce(n, 0)}} as c from both_ left join inside using (doc_id, page_no, pass_no, idx)),
page as (select doc_id, page_no, coalesce(list(c order by c.idx) filter (where pass_no = 1), []) as segs, coalesce(list(c order by c.idx) filter (where pass_no = 2), []) as rest from item group by all),
fold as (select doc_id, page_no, 1 as step, segs, rest from page union all
 select doc_id, page_no, step + 1, case when hit is null then segs || [c] when 3 * (segs[hit].captioned)::int + 2 * (segs[hit].n > 10)::int + 2 * ({_AREA("segs[hit]")} > 1.2 * {_AREA("c")})::int
  > 2 * (c.grey_var > 1000)::int + (c.score > 0.7)::int + ({_AREA("segs[hit]")} <= 1.2 * {_AREA("c")} and {_AREA("c")} > 1.2 * {_AREA("segs[hit]")})::int then segs else list_filter(segs, lambda s, i: i <> hit) || [c] end, rest
 from (select *, rest[step] as c, nullif(list_position(list_transform(segs, lambda s: case when least({_AREA("s")}, {_AREA("rest[step]")}) > 0 then greatest(0.0, least(s.x1, rest[step].x1) - greatest(s.x0, rest[step].x0)) * greatest(0.0, least(s.y1, rest[step].y1) - greatest(s.y0, rest[step].y0)) / least({_AREA("s")}, {_AREA("rest[step]")}) > 0.4 else false end), true), 0) as hit from fold where step <= len(rest)))"""
_TWO_PASS = _COMBINED.replace("with ", "with recursive ", 1) + _VALID[len(LAYOUT) :] + _EMBEDDED + _FOLD


@query(f"{_TWO_PASS} select doc_id, page_no, place, s.idx as idx, s.x0 as x0, s.y0 as y0, s.x1 as x1, s.y1 as y1, case s.pass_no when 1 then 'caption_based' else 'embedded_image' end as method from (select doc_id, page_no, unnest(segs) as s, generate_subscripts(segs, 1) as place from fold where step = len(rest) + 1)")
def two_pass_segments(spark, d):
    found = extraction.two_pass(X.blocks(spark, d), X.drawings(spark, d), X.images(spark, d))
    return found.select("doc_id", "page_no", "place", "idx", *layout.BOX, "method")


@query(f"{_CAPS_KEYS}")
def reference_keys(spark, d):
    return layout.caption_blocks(X.blocks(spark, d)).select("doc_id", "page_no", "block_no", F.array_join(layout.reference_keys(F.col("figure_number")), "|").alias("keys"))


@query(f"""{_VALID}, reg as (select doc_id, page_no, draw_no, x0, y0, x1 + 60 as x1, y1 + 60 as y1 from fx_drawings),
p as (select a.doc_id, a.page_no, a.draw_no as a_id, b.img_no as b_id, {_RATIO} as ratio, (a.x1-a.x0)*(a.y1-a.y0) as s1, (b.x1-b.x0)*(b.y1-b.y0) as s2, b.score, b.grey_var from reg a join v b using (doc_id, page_no)),
c as (select a.doc_id, a.page_no, a.draw_no as a_id, count(*) as n from reg a join fx_drawings d on a.doc_id = d.doc_id and a.page_no = d.page_no and d.x0 between a.x0 and a.x1 and d.y0 between a.y0 and a.y1 group by all),
s as (select doc_id, page_no, a_id, b_id, 3 + case when s1 > 1.2 * s2 then 2 else 0 end + case when coalesce(n, 0) > 10 then 2 else 0 end as caption_score, case when s1 <= 1.2 * s2 and s2 > 1.2 * s1 then 1 else 0 end + case when grey_var > 1000 then 2 else 0 end + case when score > 0.7 then 1 else 0 end as embedded_score from p left join c using (doc_id, page_no, a_id) where ratio > 0.4)
select *, case when caption_score > embedded_score then 'keep_caption' else 'keep_embedded' end as decision from s""")
def conflict_scores(spark, d):
    area = X.drawings(spark, d).select("doc_id", "page_no", F.col("draw_no").alias("region_id"), "x0", "y0", (F.col("x1") + 60).alias("x1"), (F.col("y1") + 60).alias("y1"))
    images = layout.validate_images(X.images(spark, d), X.blocks(spark, d))
    return layout.conflict_scores(area, images, X.drawings(spark, d))


_GAP = "sqrt(power(greatest(0.0, r.x0 - s.x1, s.x0 - r.x1), 2) + power(greatest(0.0, r.y0 - s.y1, s.y0 - r.y1), 2))"
#: Seeds take what is near from the free drawings of their page, one after another.
_CLUSTERS = f"""{LAYOUT.replace("with ", "with recursive ", 1)}, free as (select doc_id, page_no, list({{'n': draw_no, 'x0': x0, 'y0': y0, 'x1': x1, 'y1': y1}} order by draw_no) as free from fx_drawings group by all),
turn as (select doc_id, page_no, free, null::int as seed_no, free[:0] as near from free union all
 select doc_id, page_no, list_filter(free, lambda r: {_GAP.replace("s.", "free[1].")} >= 200), free[1].n, list_filter(free, lambda r: {_GAP.replace("s.", "free[1].")} < 200) from turn where len(free) > 0),
clusters as (select doc_id, page_no, seed_no, len(near) as n, list_min(list_transform(near, lambda r: r.x0)) as x0, list_min(list_transform(near, lambda r: r.y0)) as y0, list_max(list_transform(near, lambda r: r.x1)) as x1, list_max(list_transform(near, lambda r: r.y1)) as y1 from turn where len(near) >= 3),
drawn as (select * from (select doc_id, page_no, seed_no, greatest(0.0, x0 - 10) as x0, greatest(0.0, y0 - 10) as y0, least(612.0, x1 + 10) as x1, least(1260.0, y1 + 10) as y1 from clusters) where (x1 - x0) * (y1 - y0) > 5000 and (x1 - x0) * (y1 - y0) < 0.8 * 612 * 1260)"""


@query(f"{_CLUSTERS} select * from clusters")
def drawing_clusters(spark, d):
    return folds.drawing_clusters(X.drawings(spark, d), reach=200.0)


@query(f"{_CLUSTERS} select * from drawn")
def drawing_regions(spark, d):
    return folds.drawing_regions(folds.drawing_clusters(X.drawings(spark, d), reach=200.0), 612.0, 1260.0)


#: Caption regions of a page, then its drawn ones one after another, unless covered by half or holding a caption.
_VISUAL = f"""{_COMBINED.replace("with ", "with recursive ", 1)}{_CLUSTERS[len(LAYOUT) + len("recursive ") :]},
capped as (select doc_id, page_no, region_id as idx, c.x0, c.y0, c.x1, c.y1, a.c_x0, a.c_y0 from comb c join anchor a using (doc_id, page_no, region_id)),
held as (select doc_id, page_no, list({{'pass_no': 1, 'idx': idx, 'x0': x0, 'y0': y0, 'x1': x1, 'y1': y1}} order by idx) as segs, list({{'x': c_x0, 'y': c_y0}}) as caps from capped group by all),
coming as (select doc_id, page_no, list({{'pass_no': 2, 'idx': seed_no, 'x0': x0, 'y0': y0, 'x1': x1, 'y1': y1}} order by seed_no) as rest from drawn group by all),
laid as (select doc_id, page_no, 1 as step, coalesce(segs, rest[:0]) as segs, coalesce(caps, [{{'x': -1e9, 'y': -1e9}}]) as caps, coalesce(rest, segs[:0]) as rest from held full join coming using (doc_id, page_no) union all
 select doc_id, page_no, step + 1, case when len(list_filter(segs, lambda k: greatest(0.0, least(rest[step].x1, k.x1) - greatest(rest[step].x0, k.x0)) * greatest(0.0, least(rest[step].y1, k.y1) - greatest(rest[step].y0, k.y0)) > {_AREA("rest[step]")} * 0.5)) > 0
  or len(list_filter(caps, lambda c: c.x between rest[step].x0 and rest[step].x1 and c.y between rest[step].y1 - 50 and rest[step].y1 + 50)) > 0 then segs else segs || [rest[step]] end, caps, rest from laid where step <= len(rest))"""


@query(f"{_VISUAL} select doc_id, page_no, s.pass_no as pass_no, s.idx as idx, place, s.x0 as x0, s.y0 as y0, s.x1 as x1, s.y1 as y1 from (select doc_id, page_no, unnest(segs) as s, generate_subscripts(segs, 1) as place from laid where step = len(rest) + 1)")
def visual_regions(spark, d):
    return extraction.visual_regions(X.blocks(spark, d), X.drawings(spark, d), X.images(spark, d), 612.0, 1260.0, reach=200.0)


# ---- OCR features ----
def raw(spark, d) -> DataFrame:
    return ocr.raw_text(X.ocr_blocks(spark, d))


@query(f"{OCR} select segment_id, round(avg(confidence) / 100, 6) as confidence, count(*) as n_blocks from fx_ocr group by all")
def ocr_confidence(spark, d):
    return six(ocr.ocr_confidence(X.ocr_blocks(spark, d)), "confidence")


@query(rf"""{RAW}, l as (select segment_id, list_filter(list_transform(string_split(text, chr(10)), lambda x: trim(x)), lambda x: x <> '') as l from raw)
select segment_id, array_to_string(list_filter(l, lambda x: not regexp_matches(x, '[0-9]') and length(x) < 30), '|') as labels, array_to_string(list_filter(l, lambda x: regexp_matches(x, '[0-9]')), '|') as values, array_to_string(list_filter(l, lambda x: not regexp_matches(x, '[0-9]') and length(x) >= 30), '|') as annotations from l""")
def structured_text(spark, d):
    return raw(spark, d).select("segment_id", *[F.array_join(v, "|").alias(k) for k, v in T.structured_lines(F.col("text")).items()])


@query(rf"""{RAW}, l as (select segment_id, string_split(text, chr(10)) as l from raw) select segment_id, list_filter(l, lambda x: regexp_matches(lower(x), 'year|time|date'))[-1] as x, list_filter(l, lambda x: not regexp_matches(lower(x), 'year|time|date') and regexp_matches(lower(x), 'value|price|amount|%'))[-1] as y from l""")
def axis_labels(spark, d):
    return raw(spark, d).select("segment_id", *[v.alias(k) for k, v in T.axis_labels(F.col("text")).items()])


@query(rf"""{RAW} select segment_id, array_to_string(list_filter(list_transform(string_split(text, chr(10)), lambda x: trim(x)), lambda x: length(x) > 3 and length(x) < 40 and not regexp_matches(x, '^[0-9\-/.,\s%$]+$'))[1:10], '|') as legend from raw""")
def legend_simple(spark, d):
    return raw(spark, d).select("segment_id", F.array_join(T.legend_items(F.col("text")), "|").alias("legend"))


@query(rf"""{OCR}, w as (select *, max(x1) over (partition by segment_id) as width from fx_ocr), c as (select segment_id, idx, trim(text) as text, (y0 + y1) / 2 as y from w where length(trim(text)) between 3 and 30 and not regexp_matches(trim(text), '^[0-9\-/.,\s%$€£¥]+$') and (x0 + x1) / 2 > 0.6 * width),
f as (select *, case when y - lag(y) over (partition by segment_id order by y, idx) < 50 then 0 else 1 end as fresh, count(*) over (partition by segment_id) as n from c), r as (select *, sum(fresh) over (partition by segment_id order by y, idx) as run from f),
g as (select segment_id, run, n, count(*) as size, string_agg(text, '|' order by y, idx, text) as legend from r group by all), b as (select *, row_number() over (partition by segment_id order by size desc, run) as place from g where size >= 2 or n < 2) select segment_id, legend from b where place = 1""")
def legend_clusters(spark, d):
    return ocr.legend_clusters(X.ocr_blocks(spark, d))


@query(rf"""{OCR}, w as (select *, trim(text) as t, max(x1) over (partition by segment_id) as mx, max(y1) over (partition by segment_id) as my from fx_ocr), g as (select *, length(t) > 3 and not regexp_matches(t, '^[0-9\-/.,\s%$€£¥]+$') as good from w)
select segment_id, first(t order by length(t) desc, idx) filter (where good and (y0+y1)/2 > 0.85 * my) as x_label, first(t order by length(t) desc, idx) filter (where good and (x0+x1)/2 < 0.15 * mx) as y_label from g group by all""")
def axes_zones(spark, d):
    return ocr.axes_zones(X.ocr_blocks(spark, d))


@query(rf"""{OCR}, r as (select segment_id, unnest(regexp_extract_all(text, '([€£¥$]?\s*-?[0-9]+(?:[.,][0-9]+)?(?:[KMBkmb])?)\s*(%|€|£|¥|\$)?', 1)) as raw from fx_ocr), c as (select segment_id, trim(regexp_replace(raw, '[,$€£¥]', '', 'g')) as t from r),
v as (select segment_id, try_cast(regexp_replace(t, '[KMBkmb]$', '') as double) * case upper(regexp_extract(t, '([KMBkmb])$', 1)) when 'K' then 1e3 when 'M' then 1e6 when 'B' then 1e9 else 1.0 end as value from c) select segment_id, min(value) as lo, max(value) as hi, count(*) as n from v where value is not null group by all""")
def value_ranges(spark, d):
    return ocr.value_ranges(X.ocr_blocks(spark, d))


@query(rf"""{OCR}, w as (select *, trim(text) as t, max(x1) over (partition by segment_id) as mx, max(y1) over (partition by segment_id) as my from fx_ocr), m as (select *, (x0+x1)/2 as xm, (y0+y1)/2 as ym from w where trim(text) <> '' and length(trim(text)) <= 20),
a as (select *, case when ym > 0.8 * my and xm / mx > 0.1 and xm / mx < 0.9 then 'x' when (xm < 0.15 * mx or xm > 0.85 * mx) and ym / my > 0.1 and ym / my < 0.9 and regexp_matches(t, '^[0-9\-/.,\s%$€£¥KMB]+$') then 'y' end as axis from m) select segment_id, axis, string_agg(t, '|' order by idx) as ticks, count(*) as n from a where axis is not null group by all""")
def tick_labels(spark, d):
    return ocr.tick_labels(X.ocr_blocks(spark, d))


_DIAGRAM = "case when regexp_matches(lower(text), 'process|flow') then 'process_flow' when contains(lower(text), 'decision') then 'decision_tree' when regexp_matches(lower(text), 'hierarchy|organization') then 'hierarchy' when regexp_matches(lower(text), 'cycle|circular') then 'cycle' when regexp_matches(lower(text), 'cause|effect') then 'causal' when contains(lower(text), 'system') then 'system' else 'unknown' end"


@query(f"""{RAW} select segment_id, {_DIAGRAM} as subtype, regexp_matches(lower(text), 'if|yes|no|decision|choose|select') as decision_points from raw""")
def diagram_subtype(spark, d):
    return raw(spark, d).select("segment_id", T.diagram_subtype(F.col("text")).alias("subtype"), ocr.decision_points(F.col("text")).alias("decision_points"))


_NODES = f"{OCR}, nd as (select segment_id, idx, trim(text) as text, row_number() over (partition by segment_id order by idx) - 1 as place, x0, y0 from fx_ocr), nodes as (select *, row_number() over (partition by segment_id order by idx) as rank from nd where length(text) between 4 and 99)"


@query(f"{_NODES} select segment_id, 'node_' || place as node_id, text from nodes where rank <= 50")
def diagram_nodes(spark, d):
    return ocr.nodes(X.ocr_blocks(spark, d)).select("segment_id", "node_id", "text")


_SPREAD = "(select segment_id, count(*) as n, var_pop(x0) as vx, var_pop(y0) as vy, max(y0) - min(y0) as h from nodes where rank <= 50 group by all)"


@query(f"{_NODES} select segment_id, n, case when n < 2 then null when vy > 2 * vx then 'hierarchical_vertical' when vx > 2 * vy then 'hierarchical_horizontal' else 'free_form' end as layout from {_SPREAD}")
def layout_type(spark, d):
    return ocr.layout(ocr.nodes(X.ocr_blocks(spark, d))).select("segment_id", "n", "layout")


@query(f"{_NODES} select segment_id, n >= 3 and h > 100 as hierarchy from {_SPREAD}")
def hierarchy(spark, d):
    return ocr.layout(ocr.nodes(X.ocr_blocks(spark, d))).select("segment_id", "hierarchy")


@query(rf"{RAW}, l as (select segment_id, text, string_split(text, chr(10)) as l from raw) select segment_id, text <> '' and len(list_filter(l, lambda x: regexp_matches(x, '[0-9]'))) > len(l) * 0.5 and len(l) > 3 as has_table from l")
def embedded_table(spark, d):
    return raw(spark, d).select("segment_id", ocr.has_table(F.col("text")).alias("has_table"))


@query("select doc_id as segment_id, case when length(text) > 500 then 'scanned_page' when length(text) > 100 then 'screenshot' when doc_id % 3000 > 1500 then 'photo' else 'illustration' end as subtype, case when regexp_matches(lower(text), 'window|button|menu') then 'interface' when length(text) > 300 then 'document' else 'mixed' end as content, case when length(text) > 500 then 'dense' when length(text) > 100 then 'moderate' when length(text) > 0 then 'sparse' else 'none' end as density from documents")
def image_subtype_text(spark, d):
    t = F.col("text")
    return X.table(spark, d, "documents").select(F.col("doc_id").alias("segment_id"), ocr.image_subtype(t, F.col("doc_id") % 3000).alias("subtype"), ocr.content_type(t).alias("content"), ocr.text_density(t).alias("density"))


@query(r"select p_partkey, case when len(regexp_extract_all(lower(p_name || ' (a) b) ' || p_type || ' (c)'), '\([a-z]\)|\b[a-z]\)')) >= 2 then len(regexp_extract_all(lower(p_name || ' (a) b) ' || p_type || ' (c)'), '\([a-z]\)|\b[a-z]\)')) else 0 end as sub_figures from part")
def subfigures(spark, d):
    text = F.concat("p_name", F.lit(" (a) b) "), "p_type", F.lit(" (c)"))
    return X.table(spark, d, "part").select("p_partkey", ocr.subfigures(text).cast("long").alias("sub_figures"))


_CHART = r"""case when regexp_matches(t, '\bpie\b') and contains(t, 'chart') then 'pie' when contains(t, 'scatter') or contains(t, 'correlation') then 'scatter' when contains(t, 'candlestick') or (contains(t, 'open') and contains(t, 'close')) then 'candlestick'
 when regexp_matches(t, '\bbar\b.*\b(chart|graph)\b') then 'bar' when regexp_matches(t, '\bline\b.*\b(chart|graph)\b') then 'line' else 'unknown' end"""
_WORDS = "case p_partkey % 8 when 0 then ' pie chart' when 1 then ' barrel of oil' when 2 then ' open and close' when 3 then ' Bar of the graph' when 4 then ' line on a chart' when 5 then ' scatter' when 6 then ' distribution' else ' piece chart' end"


@query(f"select p_partkey, {_CHART} as subtype from (select p_partkey, lower(p_name || {_WORDS}) as t from part)")
def chart_subtype(spark, d):
    return X.table(spark, d, "part").select("p_partkey", ocr.chart_subtype(F.concat("p_name", F.expr(_WORDS))).alias("subtype"))


@query(f"{OCR} select segment_id, idx, trim(text) as text from fx_ocr where length(trim(text)) between 4 and 49")
def node_texts(spark, d):
    return ocr.node_texts(X.ocr_blocks(spark, d))


@query(f"{RAW}, nd as (select segment_id, trim(text) as text, row_number() over (partition by segment_id order by idx) as place, idx, y0, x0 from fx_ocr), nodes as (select *, row_number() over (partition by segment_id order by idx) as rank from nd where length(text) between 4 and 99), f as {_SPREAD} select segment_id, {_DIAGRAM} as subtype, coalesce(n, 0) as node_count, coalesce(n >= 3 and h > 100, false) as hierarchy, case when n < 2 then null when vy > 2 * vx then 'hierarchical_vertical' when vx > 2 * vy then 'hierarchical_horizontal' when n is not null then 'free_form' end as layout, regexp_matches(lower(text), 'if|yes|no|decision|choose|select') as decision_points from raw left join f using (segment_id)")
def diagram_features(spark, d):
    return ocr.diagram_features(X.ocr_blocks(spark, d))


def sql_charts() -> str:
    """Every part of the features has its own query; here they are put together."""
    axes, ranges, legend, ticks = (ORACLES[n] for n in ("axes_zones", "value_ranges", "legend_clusters", "tick_labels"))
    return f"""select t.segment_id, subtype, x_label, y_label, lo, hi, n, legend, x_ticks, y_ticks, coalesce(len(string_split(legend, '|')), 1) as series_count
from (select segment_id, {_CHART} as subtype from (select segment_id, lower(text) as t from ({RAW} select * from raw))) t left join ({axes}) using (segment_id) left join ({ranges}) using (segment_id) left join ({legend}) using (segment_id)
left join (select segment_id, max(ticks) filter (where axis = 'x') as x_ticks, max(ticks) filter (where axis = 'y') as y_ticks from ({ticks}) group by segment_id) using (segment_id)"""


@query(sql_charts())
def chart_features(spark, d):
    return ocr.chart_features(X.ocr_blocks(spark, d))


_RAWS = "select doc_id as segment_id, text, (doc_id % 3000)::double as grey_var, doc_id % 7 as arrows from documents"


def picture_rows(spark, d) -> DataFrame:
    return X.table(spark, d, "documents").select(F.col("doc_id").alias("segment_id"), "text", (F.col("doc_id") % 3000).cast("double").alias("grey_var"), (F.col("doc_id") % 7).alias("arrows"))


@query(rf"""select segment_id, case when length(text) > 500 then 'scanned_page' when length(text) > 100 then 'screenshot' when grey_var > 1500 then 'photo' else 'illustration' end as subtype, length(trim(text)) > 10 as contains_text, case when length(text) > 500 then 'dense' when length(text) > 100 then 'moderate' when length(text) > 0 then 'sparse' else 'none' end as density,
 text <> '' and len(list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[0-9]'))) > len(string_split(text, chr(10))) * 0.5 and len(string_split(text, chr(10))) > 3 as has_table, case when regexp_matches(lower(text), 'window|button|menu') then 'interface' when length(text) > 300 then 'document' else 'mixed' end as content from ({_RAWS})""")
def image_features(spark, d):
    return ocr.image_features(picture_rows(spark, d))


@query(rf"""select segment_id, n >= 2 as is_composite, case when n >= 2 then n else 0 end as sub_figures, arrows > 3 as contains_diagram, grey_var > 1000 as contains_image from (select *, len(regexp_extract_all(lower(text), '\([a-z]\)|\b[a-z]\)')) as n from ({_RAWS}))""")
def figure_features(spark, d):
    return ocr.figure_features(picture_rows(spark, d))


# ---- output rows, adapters, reports ----
_TYPE = "case doc_id % 4 when 0 then 'chart' when 1 then 'diagram' when 2 then 'flowchart' else 'image' end"


@query(f"""{X.ctes('fx_segments')}, t as (select segment_id, caption, {_TYPE.replace('doc_id', 'segment_id')} as ty from fx_segments) select segment_id, concat_ws('. ', case ty when 'chart' then 'This chart displays' when 'diagram' then 'This diagram illustrates a system or process' when 'flowchart' then 'This flowchart shows a sequential process' else 'This ' || ty end, case when ty = 'chart' and segment_id % 8 = 0 then 'Price versus Year' end, case when coalesce(caption, '') <> '' then 'Caption: ' || substring(caption, 1, 100) end) as summary from t""")
def fallback_summary(spark, d):
    rows = X.segments(spark, d).withColumn("ty", F.expr(_TYPE.replace("doc_id", "segment_id")))
    axes = [F.when(F.col("segment_id") % 8 == 0, v) for v in ("Year", "Price")]
    return rows.select("segment_id", models.fallback_summary(F.col("ty"), axes[0], axes[1], F.col("caption")).alias("summary"))


@query("select doc_id, 'book_p' || printf('%03d', doc_id) || '_' || substring(md5(text), 1, 8) as segment_id from documents")
def segment_ids(spark, d):
    return X.table(spark, d, "documents").select("doc_id", models.segment_id(F.lit("book"), F.col("doc_id"), F.col("text").cast("binary")).alias("segment_id"))


@query(f"{X.ctes('fx_segments')} select segment_id, 1 as page, {_TYPE.replace('doc_id', 'segment_id')} as type, printf('%.2f', segment_id % 100 / 100) as confidence, case when segment_id % 3 = 0 then '2.' || segment_id else '' end as figure_number, coalesce(substring(caption, 1, 100), '') as caption, coalesce(substring(ocr, 1, 100), '') as ocr_text, coalesce(substring(summary, 1, 100), '') as summary, cast(segment_id % 7 as int) as linked_concepts from fx_segments")
def summary_csv(spark, d):
    rows = X.segments(spark, d).withColumns({"page": F.lit(1), "type": F.expr(_TYPE.replace("doc_id", "segment_id")), "confidence": F.col("segment_id") % 100 / 100, "figure_number": F.when(F.col("segment_id") % 3 == 0, F.concat(F.lit("2."), "segment_id")), "ocr_text": F.col("ocr"), "linked_concepts": (F.col("segment_id") % 7).cast("int")})
    return sinks.summary_rows(rows)


@query("""select doc_id as segment_id, case when doc_id % 5 = 4 then 'figure' when doc_id % 5 = 3 then 'figure' else case doc_id % 3 when 0 then 'chart' when 1 then 'diagram' else 'image' end end as segment_type,
 case when doc_id % 5 = 4 then 0.3 else least(0.95, (doc_id % 10) / 10) end::double as confidence, case when doc_id % 5 = 4 then 'fallback_heuristic' else 'comprehensive' end as method, case when doc_id % 5 = 4 then 0.3 else 0.8 end::double as summary_confidence, case when doc_id % 5 <> 4 then 's' || doc_id end as summary from documents""")
def response_parse(spark, d):
    kind = F.when(F.col("doc_id") % 5 == 3, "OTHER").otherwise(F.expr("case doc_id % 3 when 0 then 'CHART' when 1 then 'Diagram' else 'image' end"))
    body = F.to_json(F.struct(F.struct(kind.alias("category"), ((F.col("doc_id") % 10) / 10).alias("confidence")).alias("classification"), F.struct(F.concat(F.lit("s"), "doc_id").alias("text")).alias("summary")))
    response = F.when(F.col("doc_id") % 5 == 4, "no json").when(F.col("doc_id") % 2 == 0, F.concat(F.lit("```json\n"), body, F.lit("\n```"))).otherwise(body)
    return models.parse_responses(X.table(spark, d, "documents").select(F.col("doc_id").alias("segment_id"), response.alias("response_json")))


_META = """concat('{"chart_subtype":"bar","x_axis_label":"Year","data_series_count":', cast(doc_id % 4 as string), ',"has_grid":', case when doc_id % 2 = 0 then 'true' else 'false' end, case when doc_id % 3 = 0 then ',"value_range":{"min":1.5,"max":9}' else '' end,
 ',"diagram_subtype":"cycle","node_count":', cast(doc_id % 6 as string), ',"decision_points":', cast(doc_id % 2 as string), ',"image_subtype":"photo","formulas":', case when doc_id % 2 = 0 then '["a","b"]' else 'null' end, ',"sub_figure_count":', cast(doc_id % 5 as string), '}')"""
_KIND = "case doc_id % 5 when 0 then 'chart' when 1 then 'diagram' when 2 then 'flowchart' when 3 then 'image' else 'figure' end"


@query(f"""select doc_id as segment_id, case when ty = 'chart' then 'bar' else '' end as chart_subtype, case when ty = 'chart' then doc_id % 4 else -1 end as series_count, case when ty = 'chart' then cast(doc_id % 2 = 0 as int) else -1 end as grid, case when ty = 'chart' and doc_id % 3 = 0 then 9.0 else -1.0 end::double as hi,
 case ty when 'flowchart' then 'flowchart' when 'diagram' then 'cycle' else '' end as diagram_subtype, case when ty in ('flowchart', 'diagram') then doc_id % 6 else -1 end as node_count, case when ty in ('flowchart', 'diagram') then doc_id % 2 else -1 end as decision_points,
 case when ty = 'image' then case when doc_id % 2 = 0 then 2 else 0 end else -1 end as n_formulas, case when ty = 'image' then 0 else -1 end as n_tables, case when ty = 'figure' then doc_id % 5 else -1 end as sub_figures from (select doc_id, {_KIND} as ty from documents)""")
def typed_metadata(spark, d):
    rows = X.table(spark, d, "documents").select(F.col("doc_id").alias("segment_id"), F.expr(_KIND).alias("segment_type"), F.expr(_META).alias("metadata"))
    found = models.typed_metadata(rows)
    numbers = {"series_count": "chart.series_count", "grid": "cast(chart.grid as int)", "hi": "chart.hi", "node_count": "diagram.node_count", "decision_points": "cast(diagram.decision_points as int)", "n_formulas": "size(image.formulas)", "n_tables": "size(image.tables)", "sub_figures": "figure.sub_figures"}
    texts = {"chart_subtype": "chart.subtype", "diagram_subtype": "diagram.subtype"}
    return found.select("segment_id", *[F.expr(f"coalesce({v}, -1)").alias(k) for k, v in numbers.items()], *[F.expr(f"coalesce({v}, '')").alias(k) for k, v in texts.items()])


_DRAWN = "case doc_id % 4 when 0 then concat('Here: ```mermaid ', chr(10), 'flowchart TD', chr(10), ' A --> B', chr(10), '```') when 1 then concat('```mermaid', chr(10), 'graph LR; A-->B', chr(10), '```') when 2 then concat('```mermaid', chr(10), 'sequenceDiagram', chr(10), 'A->>B: x', chr(10), '```') else 'none' end"


@query(f"select doc_id as segment_id, case doc_id % 4 when 0 then concat('flowchart TD', chr(10), ' A --> B') when 1 then 'graph LR; A-->B' when 2 then concat('sequenceDiagram', chr(10), 'A->>B: x') end as code, case doc_id % 4 when 0 then 'flowchart' when 1 then 'graph' when 2 then 'sequence' end as type, 0.75::double as confidence from documents where doc_id % 4 < 3 and {_KIND} in ('diagram', 'flowchart')")
def mermaid(spark, d):
    rows = X.table(spark, d, "documents").select(F.col("doc_id").alias("segment_id"), models.mermaid(F.expr(_DRAWN), F.expr(_KIND)).alias("m")).where("m is not null")
    return rows.select("segment_id", "m.code", "m.type", "m.confidence")


_CALC = """concat('text {"input_variables":', case when doc_id % 2 = 0 then '[{"variable":"S","value":"100"}]' else '[]' end, ',"output_values":[{"output_name":"C"},{"output_name":"P"}],"verification":{"verified":', case when doc_id % 3 = 0 then 'true' else 'false' end, '}} end')"""


@query("""select doc_id as segment_id, case when doc_id % 2 = 0 then '{"variable":"S","value":"100"}' else 'a|b|c' end as inputs, '{"output_name":"C"}|{"output_name":"P"}' as outputs, case when doc_id % 3 = 0 then 'true' else 'false' end as verified from documents""")
def calculation_merge(spark, d):
    found = models.calculations(F.expr(_CALC))
    rows = X.table(spark, d, "documents").select(F.col("doc_id").alias("segment_id"), *[v.alias(k) for k, v in found.items()])
    held = F.array(*map(F.lit, ["a", "b", "c"]))
    return rows.select("segment_id", F.array_join(models.merge_calculations(held, F.col("inputs")), "|").alias("inputs"), F.array_join(models.merge_calculations(held, F.col("outputs")), "|").alias("outputs"), F.get_json_object("verification", "$.verified").alias("verified"))


@query(f"{X.ctes('fx_segments')} select cast(segment_id % 50 as string) as book_id, count(*) as total_segments, string_agg(cast(segment_id as string), '|' order by segment_id) as ids from fx_segments group by all")
def book_envelopes(spark, d):
    rows = X.segments(spark, d).select("segment_id", "caption", (F.col("segment_id") % 50).cast("string").alias("book_id"), F.lit("a.pdf").alias("pdf_path"), F.col("segment_id").alias("place"))
    read = F.from_json("json", "total_segments long, segments array<struct<segment_id:long>>")
    return sinks.book_envelopes(rows).select("book_id", read.alias("j")).select("book_id", "j.total_segments", F.array_join("j.segments.segment_id", "|").alias("ids"))


@query("select a.vec_id as a, b.vec_id as b, round(list_dot_product(a.embedding::double[], b.embedding::double[]) / (sqrt(list_dot_product(a.embedding::double[], a.embedding::double[])) * sqrt(list_dot_product(b.embedding::double[], b.embedding::double[]))), 6) as cosine from embeddings a join embeddings b on b.vec_id = a.vec_id + 1")
def dense_cosine(spark, d):
    rows = X.table(spark, d, "embeddings").select("vec_id", F.transform("embedding", lambda x: x.cast("double")).alias("e"))
    dot = lambda a, b: F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x)
    pairs = rows.select(F.col("vec_id").alias("a"), F.col("e").alias("ea"), (F.col("vec_id") + 1).alias("b")).join(rows.select(F.col("vec_id").alias("b"), F.col("e").alias("eb")), "b")
    return pairs.select("a", "b", F.round(dot("ea", "eb") / (F.sqrt(dot("ea", "ea")) * F.sqrt(dot("eb", "eb"))), 6).alias("cosine"))


@query(f"select source, {_TYPE} as segment_type, count(*) as n, cast(sum(n_chars) as bigint) as chars from documents group by rollup (source, {_TYPE})")
def type_rollup(spark, d):
    rows = X.table(spark, d, "documents").select("source", F.expr(_TYPE).alias("segment_type"), "n_chars")
    return rows.rollup("source", "segment_type").agg(F.count(F.lit(1)).alias("n"), F.sum("n_chars").alias("chars"))


@query("select date_trunc('hour', ts) as hour, event_type, count(*) as n, round(sum(value), 4) as total from events group by all")
def event_windows(spark, d):
    from glyphgrid.streaming.append import windowed_counts

    return windowed_counts(X.table(spark, d, "events")).select(F.col("window.start").alias("hour"), "event_type", "n", F.round("total", 4).alias("total"))


@query(f"{LAYOUT} select doc_id, page_no, img_no, (x1 - x0) * (y1 - y0) as area from fx_images")
def box_area(spark, d):
    return X.images(spark, d).select("doc_id", "page_no", "img_no", G.area().alias("area"))


@query(f"""{LAYOUT} select a.doc_id, a.page_no, a.draw_no as a_no, b.draw_no as b_no, round(sqrt(power(greatest(0.0, b.x0 - a.x1, a.x0 - b.x1), 2) + power(greatest(0.0, b.y0 - a.y1, a.y0 - b.y1), 2)), 6) as distance from fx_drawings a join fx_drawings b on a.doc_id = b.doc_id and a.page_no = b.page_no and a.draw_no < b.draw_no""")
def drawing_distance(spark, d):
    rows = X.drawings(spark, d)
    pairs = layout.prefixed(rows, "a_").join(layout.prefixed(rows, "b_"), layout.PAGE).where("a_draw_no < b_draw_no")
    return pairs.select("doc_id", "page_no", F.col("a_draw_no").alias("a_no"), F.col("b_draw_no").alias("b_no"), F.round(G.gap_distance("a_", "b_"), 6).alias("distance"))


@query(f"""{LAYOUT} select * from (select a.doc_id, a.page_no, a.draw_no as a_id, b.draw_no as b_id, round(sqrt(power(greatest(0.0, b.x0 - a.x1, a.x0 - b.x1), 2) + power(greatest(0.0, b.y0 - a.y1, a.y0 - b.y1), 2)), 6) as distance
 from fx_drawings a join fx_drawings b on a.doc_id = b.doc_id and a.page_no = b.page_no and a.draw_no < b.draw_no where a.x0 <= a.x1 and a.y0 <= a.y1 and b.x0 <= b.x1 and b.y0 <= b.y1) where distance < 100""")
def near_drawings(spark, d):
    return six(layout.near_boxes(X.drawings(spark, d).withColumnRenamed("draw_no", "id"), 100.0), "distance")


# ---- rasters ----
_SIZE = f"{X.RASTER_WIDTH} as width, {X.RASTER_HEIGHT} as height"
PIXELS = X.ctes("fx_shapes", "fx_pixels")
EDGES = X.ctes("fx_shapes", "fx_pixels", "fx_edges")
RUNS = X.ctes("fx_shapes", "fx_pixels", "fx_edges", "fx_runs")


def traced(spark, d, *parts: str, features=None) -> DataFrame:
    return pixels.traced(X.drawn(spark, d), *parts, features=features)


@query(f"{PIXELS} select image_id, {_SIZE}, sha256(unhex(string_agg(printf('%06x', color), '' order by i))) as rgb_sha256 from fx_pixels group by image_id")
def render_regions(spark, d):
    return X.rasters(spark, d).select("image_id", "width", "height", F.sha2("rgb", 256).alias("rgb_sha256"))


@query(f"{PIXELS} select image_id, round(var_pop(v), 4) as variance from fx_pixels group by image_id")
def pixel_variance(spark, d):
    return traced(spark, d, "variance").select("image_id", F.round("variance", 4).alias("variance"))


@query(f"{EDGES} select p_partkey as image_id, count(x) as edge_pixels from part left join fx_edges on image_id = p_partkey group by p_partkey")
def edge_pixels(spark, d):
    return traced(spark, d, "edge_pixels").select("image_id", F.col("edge_pixels").cast("long").alias("edge_pixels"))


@query(f"{RUNS} select image_id, axis, line, start, length from fx_runs where length >= 20")
def edge_runs(spark, d):
    long = lambda rows: rows.select("image_id", F.explode("runs").alias("r")).select("image_id", "r.*").where("length >= 20")
    return traced(spark, d, "runs", features=long)


def sql_opened(axis: str, size: int, length: int) -> str:
    before = 2 * (length // 2)
    after = 2 * (length - 1) - before
    low, high = f"case when start = 0 then 0 else start + {before} end", f"case when start + length = {size} then {size - 1} else start + length - 1 - {after} end"
    return f"coalesce(sum(case when axis = '{axis}' and {low} <= {high} then least({high} + {before}, {size - 1}) - greatest({low} - {after}, 0) + 1 else 0 end), 0)::bigint"


@query(f"{RUNS} select *, h_pixels > 300 and v_pixels > 300 as grid from (select p_partkey as image_id, {sql_opened('h', X.RASTER_WIDTH, pixels.GRID)} as h_pixels, {sql_opened('v', X.RASTER_HEIGHT, pixels.GRID)} as v_pixels from part left join fx_runs on image_id = p_partkey group by p_partkey)")
def grid_flags(spark, d):
    return traced(spark, d, "runs", features=pixels.grid)


@query(f"""{EDGES}, hue as (select image_id, color, greatest(color >> 16, (color >> 8) & 255, color & 255) as hi, least(color >> 16, (color >> 8) & 255, color & 255) as lo from fx_pixels),
strong as (select image_id, color, count(*) as n from hue where round((hi - lo) * 255.0 / greatest(hi, 1)) > 30 and hi > 40 and hi < 240 group by all)
select image_id, '#' || printf('%06x', color) as colour, n as pixels from (select *, sum(n) over (partition by image_id) as total from strong) where total >= 100""".replace(EDGES, PIXELS))
def image_palette(spark, d):
    """The fixture's images have five strong colours at most, which are their own centres."""
    named = lambda rows: rows.select("image_id", F.explode("colours").alias("c")).select("image_id", "c.colour", F.col("c.pixels").cast("long").alias("pixels"))
    return traced(spark, d, "colours", features=named)


@query()
def edge_lines(spark, d):
    listed = lambda rows: rows.select("image_id", F.posexplode("lines").alias("line_no", "s")).select("image_id", "line_no", "s.*")
    return traced(spark, d, "lines", features=listed)


@query()
def line_features(spark, d):
    counted = lambda rows: rows.select("image_id", F.size("lines").alias("n_lines"), pixels.arrows(F.col("lines")).alias("arrows"), F.size(pixels.connections(F.col("lines"))).alias("connections"))
    return traced(spark, d, "lines", features=counted)


@query()
def shape_counts(spark, d):
    return traced(spark, d, "polygons", features=lambda rows: rows.select("image_id", pixels.shapes(F.col("polygons")).alias("s")).select("image_id", "s.*"))


@query()
def data_points(spark, d):
    return traced(spark, d, "blobs", "edge_pixels", features=lambda rows: rows.select("image_id", pixels.data_points(F.col("blobs"), F.col("edge_pixels")).alias("data_points")))


# ---- composites: text and pixels of the segments that have an image ----
def drawn_blocks(spark, d) -> DataFrame:
    return X.ocr_blocks(spark, d).join(X.table(spark, d, "part").select(F.col("p_partkey").alias("segment_id")).hint("merge"), "segment_id", "left_semi")


@query()
def chart_composite(spark, d):
    rows = composites.charts(drawn_blocks(spark, d), X.drawn(spark, d))
    return rows.withColumn("colours", F.array_join("colours", "|"))


@query()
def diagram_composite(spark, d):
    return composites.diagrams(drawn_blocks(spark, d), X.drawn(spark, d)).select("*", "shapes.*").drop("shapes")


_HUES = """hue as (select image_id, color, greatest(color >> 16, (color >> 8) & 255, color & 255) as hi, least(color >> 16, (color >> 8) & 255, color & 255) as lo from fx_pixels),
strong as (select image_id, color, count(*) as n from hue where round((hi - lo) * 255.0 / greatest(hi, 1)) > 30 and hi > 40 and hi < 240 group by all),
named as (select image_id, string_agg('#' || printf('%06x', color), '|' order by n desc, printf('%06x', color)) as colours from strong group by image_id having sum(n) >= 100),
greys as (select image_id, var_pop(v) as grey_var from fx_pixels group by image_id)"""


@query(rf"""{X.ctes("fx_ocr", "fx_shapes", "fx_pixels")}, raw as (select segment_id, string_agg(text, chr(10) order by idx) as text from fx_ocr semi join part on segment_id = p_partkey group by segment_id), {_HUES}
select segment_id, case when length(text) > 500 then 'scanned_page' when length(text) > 100 then 'screenshot' when grey_var > 1500 then 'photo' else 'illustration' end as subtype, length(trim(text)) > 10 as contains_text, case when length(text) > 500 then 'dense' when length(text) > 100 then 'moderate' when length(text) > 0 then 'sparse' else 'none' end as density,
 text <> '' and len(list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[0-9]'))) > len(string_split(text, chr(10))) * 0.5 and len(string_split(text, chr(10))) > 3 as has_table, case when regexp_matches(lower(text), 'window|button|menu') then 'interface' when length(text) > 300 then 'document' else 'mixed' end as content, coalesce(colours, '') as colours
from raw join greys on segment_id = image_id left join named using (image_id)""")
def image_composite(spark, d):
    return composites.pictures(drawn_blocks(spark, d), X.drawn(spark, d)).withColumn("colours", F.array_join("colours", "|"))


@query()
def figure_composite(spark, d):
    return composites.figures(drawn_blocks(spark, d), X.drawn(spark, d))


# ---- the legacy profile's model steps: what is asked, and what is made of answers ----
_LEGACY = "case segment_id % 6 when 0 then 'chart' when 1 then 'diagram' when 2 then 'flowchart' when 3 then 'image' when 4 then 'figure' else 'table' end"
_KNOWN = f"""{X.ctes('fx_segments')}, seg as (select *, {_LEGACY} as ty, case when segment_id % 3 = 0 then '2.' || segment_id end as num, case when segment_id % 4 = 0 then 'Rates > Yield' end as path, case when segment_id % 6 = 1 then 'graph TD' end as mer from fx_segments)"""
_COVER = " ".join(f"when '{k}' then '{v}'" for k, v in calls.COVER.items())


def legacy_segments(spark, d) -> DataFrame:
    key = F.col("segment_id")
    return X.segments(spark, d).withColumns({
        "segment_type": F.expr(_LEGACY), "figure_number": F.when(key % 3 == 0, F.concat(F.lit("2."), key)), "heading_path": F.when(key % 4 == 0, "Rates > Yield"), "mermaid": F.when(key % 6 == 1, "graph TD"), "image": F.lit(None).cast("binary"),
    })


@query(f"""{_KNOWN}, c as (select *, concat_ws(chr(10), case when caption <> '' then 'Caption: ' || caption end, 'Figure number: ' || num, 'Type: ' || ty, case when ocr <> '' then 'Text in the picture: ' || substring(ocr, 1, 400) end, 'Section: ' || path, 'Mermaid:' || chr(10) || '```mermaid' || chr(10) || mer || chr(10) || '```') as context from seg)
select segment_id, 'Summarise this ' || case when ty = 'table' then 'visual' else ty end || ' for a student who can''t see it, in three or four factual sentences: ' || case ty {_COVER} else 'what can be seen, what it may stand for, and what a reader could learn' end || '.' || chr(10) || context as prompt from c""")
def summary_prompts(spark, d):
    return calls.summary_requests(legacy_segments(spark, d)).select("segment_id", "prompt")


_ANSWER = """case segment_id % 7 when 0 then '```json{n}{"category": "Chart", "confidence": 0.99}{n}```' when 1 then '```{n}{"category": "DIAGRAM", "confidence": "0.5"}{n}```' when 2 then '{"category": "photo"}' when 3 then 'not json' when 4 then '{"category": "image", "confidence": "high"}' when 5 then null else 'So: ```json {"category": "flowchart", "confidence": 0.25} ``` done' end"""


@query(f"""{X.ctes('fx_segments')} select segment_id, case segment_id % 7 when 0 then 'chart' when 1 then 'diagram' when 6 then 'flowchart' else 'figure' end as segment_type, case segment_id % 7 when 0 then 0.95 when 1 then 0.5 when 2 then 0.7 when 6 then 0.25 else 0.3 end::double as confidence,
 case when segment_id % 7 in (0, 1, 2, 6) then 'vision_model' else 'fallback_heuristic' end as method from fx_segments""")
def legacy_classification(spark, d):
    return calls.classified(X.segments(spark, d).select("segment_id", F.expr(_ANSWER.replace("{n}", "\n")).alias("response")))


_FALLBACK = f"case {_LEGACY} when 'chart' then 'This chart displays' when 'diagram' then 'This diagram illustrates a system or process' when 'flowchart' then 'This flowchart shows a sequential process' else 'This ' || {_LEGACY} end"


@query(rf"""{X.ctes('fx_segments')}, told as (select segment_id, trim(regexp_replace(case segment_id % 3 when 1 then '**Summary:** ' || trim(substring(summary, 1, 60)) || ' **Note** end' when 2 then trim(substring(summary, 1, 60)) || ' end' else '' end, '\*\*.*?\*\*:?\s*', '', 'g')) as t from fx_segments)
select segment_id, case when t <> '' then t else {_FALLBACK} end as summary, case when t <> '' then 0.85 else 0.5 end::double as confidence from told""")
def legacy_summary(spark, d):
    none = F.lit(None).cast("string")
    key, answer = F.col("segment_id"), F.concat(F.lit("**Summary:** "), F.trim(F.substring("summary", 1, 60)), F.lit(" **Note** end"))
    told = calls.summarised(F.when(key % 3 == 1, answer).when(key % 3 == 2, F.concat(F.trim(F.substring("summary", 1, 60)), F.lit(" end"))), models.fallback_summary(F.expr(_LEGACY), none, none, none))
    return X.segments(spark, d).select("segment_id", told.alias("t")).select("segment_id", F.col("t.text").alias("summary"), "t.confidence")


# ---- adapters: reading text in pictures ----
def picture_reader():
    """Stands for a model: the fixture's pictures hold what is to be found in them."""

    def read(picture: bytes):
        return [([tuple(p) for p in points], text, score) for points, text, score in json.loads(picture)]

    return read


@query(f"{OCR} select segment_id, (row_number() over (partition by segment_id order by idx) - 1)::int as idx, text, x0, y0, x1, y1, round(confidence, 6) as confidence from fx_ocr where segment_id % 10 <> 3")
def ocr_read(spark, d):
    """Every tenth picture is broken and has no text."""
    corners = F.array(*[F.array(F.col(x), F.col(y)) for x, y in (("x0", "y0"), ("x1", "y0"), ("x1", "y1"), ("x0", "y1"))])
    # lists of mixed kinds are put together as text
    item = F.concat(F.lit("["), F.to_json(corners), F.lit(","), F.to_json(F.struct("text")).substr(F.lit(9), F.length(F.to_json(F.struct("text"))) - 9), F.lit(","), (F.col("confidence") / 100).cast("string"), F.lit("]"))
    listed = F.transform(F.array_sort(F.collect_list(F.struct("idx", item.alias("item")))), lambda s: s["item"])
    whole = F.concat(F.lit("["), F.array_join(listed, ","), F.lit("]"))
    pictures = X.ocr_blocks(spark, d).groupBy("segment_id").agg(F.when(F.col("segment_id") % 10 == 3, F.lit("broken")).otherwise(whole).cast("binary").alias("image"))
    return six(reading.read_text(pictures, picture_reader), "confidence")
