"""Hand-derived cases of the layout, linking and OCR operators."""

import json
import os
import random
import re
from difflib import SequenceMatcher

import pytest
from pyspark.sql import functions as F

from glyphgrid.functions import geometry as G
from glyphgrid.functions import text as T
from glyphgrid import engine
from glyphgrid.operators import folds, layout, linking, models, ocr, phrases, similarity
from glyphgrid.sources import sinks
from glyphgrid.streaming import append


def one(spark, expression, **values):
    return spark.createDataFrame([tuple(values.values())], list(values)).select(expression.alias("v")).first().v


def test_terms(spark):
    text = "T-bill rates and LIBOR (London)"
    assert set(one(spark, T.terms(F.col("t")), t=text)) == {"t-bill", "bill", "rates", "libor", "london"}
    assert set(one(spark, T.terms(F.col("t"), False), t=text)) == {"t-bill", "rates", "libor", "london"}


def test_concept_names(spark):
    assert one(spark, T.concept_id(F.col("n"), F.lit(42)), n="Return on Equity") == "concept_return_on_equity_042"
    parts = T.concept_parts(F.col("n"))
    assert one(spark, parts["main"], n="Treasury Bills (T-bills)") == "Treasury Bills"
    assert one(spark, parts["acronyms"], n="Treasury Bills (T-bills)") == ["t-bill", "t-bills"]
    assert one(spark, parts["aliases"], n="Treasury Bill") == ["Treasury Bill"]
    assert one(spark, parts["acronyms"], n="Funds (ETFs)") == ["etfs", "funds"]
    assert one(spark, parts["aliases"], n="LIBOR") == ["LIBOR", "london interbank offer rate", "london interbank offered rate"]


def test_captions(spark):
    assert one(spark, T.caption_number(F.col("t")), t="Figure 3.2: ROE over time") == "3.2"
    assert one(spark, F.trim(T.caption_body(F.col("t"))), t="Figure 3.2: ROE over time") == "ROE over time"
    assert not one(spark, T.is_caption(F.col("t")), t="Results improve, as shown in Figure 2 below")
    assert one(spark, T.is_caption(F.col("t")), t="Exhibit 2 - prices")


def test_overlap_and_distance(spark):
    names = [f"{p}{c}" for p in "ab" for c in ("x0", "y0", "x1", "y1")]
    row = lambda *v: dict(zip(names, map(float, v), strict=True))
    assert one(spark, G.overlap_ratio("a", "b"), **row(0, 0, 10, 10, 5, 5, 25, 25)) == 0.25
    assert one(spark, G.overlap_ratio("a", "b"), **row(0, 0, 10, 10, 0, 6, 10, 26)) == 0.4
    assert one(spark, G.gap_distance("a", "b"), **row(0, 0, 1, 1, 4, 5, 6, 6)) == 5.0


PHRASES = ["libor", "t-bill", "t bill", "ted spread", "spread", "(t-bills)", "c++", "a.b", "été", "x-y z", "-", "io"]
TEXTS = ["the libor rate", "a t bill", "a t-bills", "t-bill", "ted  spread", "ted spread, spread", "spreads and (t-bills) here", "c++ or a.b", "axb a.b.", "un été", "étés", "x y z", "x-y-z", "x y-z", "", None, "ratio io_ io", "a - b", "libor" * 3]


def held(text: str, phrase: str, whole: bool) -> bool:
    """By a pattern for each phrase: between non-word characters, hyphens matching white space."""
    if not whole:
        return phrase in text
    return re.search(r"(?<![\w])" + re.escape(phrase).replace(r"\-", r"[-\s]") + r"(?![\w])", text) is not None


@pytest.mark.parametrize("budget", [1 << 20, 60])
@pytest.mark.parametrize("whole", [True, False])
def test_phrases(spark, monkeypatch, whole, budget):
    """One automaton, and one for each bucket of phrases where they are over the budget."""
    monkeypatch.setattr(phrases, "PHRASE_BYTES", budget)
    monkeypatch.setattr(phrases, "SHARE_BYTES", 100)
    texts = spark.createDataFrame(list(enumerate(TEXTS)), "segment_id long, text string")
    names = spark.createDataFrame([(p,) for p in [*PHRASES, "", PHRASES[0]]], "phrase string")
    got = sorted((r.segment_id, r.phrase) for r in phrases.phrase_hits(texts, names, whole).collect())
    assert got == sorted((i, p) for i, t in enumerate(TEXTS) if t for p in PHRASES if held(t, p, whole))


def test_similar_terms(spark):
    """All pairs over the ratio, from far fewer candidates than pairs of fitting lengths."""
    draw = random.Random(5)
    words = ["".join(draw.choice("abcde") for _ in range(draw.randint(1, 24))) for _ in range(250)]
    for w in words[:150]:
        edited = list(w)
        for _ in range(draw.randint(1, 3)):
            at = draw.randrange(len(edited) + 1)
            edited[at : at + draw.randint(0, 1)] = draw.choice(["", "a", "z"])
        words.append("".join(edited))
    words = [w for w in dict.fromkeys(words) if w]
    left, right = words[::2], [*words[1::2], words[0]]
    want = {(a, b) for a in left for b in right if SequenceMatcher(None, a, b).ratio() >= similarity.LEAST - 1e-12}
    a, b = spark.createDataFrame([(w,) for w in left], "a string"), spark.createDataFrame([(w,) for w in right], "b string")
    assert {(r.a, r.b) for r in similarity.similar_terms(a, b).collect()} == want and len(want) > 30
    candidates = similarity.candidate_pairs(a, b).count()
    by_length = sum(len(x) * 0.785 <= len(y) <= len(x) / 0.785 for x in left for y in right)
    assert candidates < by_length / 5
    real = spark.createDataFrame([("dividend",), ("dividends",), ("yield",), ("portfolio",)], "a string")
    tokens = spark.createDataFrame([(w,) for w in ("dividend", "dividends", "dividents", "yields", "yeld", "portfolios", "")], "b string")
    assert {(r.a, r.b) for r in similarity.similar_terms(real, tokens).collect()} == {(x.a, y.b) for x in real.collect() for y in tokens.collect() if SequenceMatcher(None, x.a, y.b).ratio() >= 0.88}


def test_whitespace_boundary(spark):
    blocks = spark.createDataFrame([(1, 1, i, "x", a, b) for i, (a, b) in enumerate([(0.0, 20.0), (60.0, 80.0), (90.0, 100.0)])], "doc_id long, page_no long, block_no int, text string, y0 double, y1 double")
    blocks = blocks.withColumn("x0", F.lit(0.0)).withColumn("x1", F.lit(9.0))
    anchor = spark.createDataFrame([(1, 1, 9, 200.0), (2, 1, 9, 200.0)], "doc_id long, page_no long, region_id int, c_y0 double")
    assert [(r.doc_id, r.ws_y) for r in layout.whitespace_boundary(anchor, blocks).collect()] == [(1, 25.0)]


def test_pages_of_two_documents(spark):
    blocks = spark.createDataFrame([(d, 1, 0, f"text of {d}", 0.0, 0.0, 10.0, 10.0) for d in (1, 2)], "doc_id long, page_no long, block_no int, text string, x0 double, y0 double, x1 double, y1 double")
    regions = blocks.select("doc_id", "page_no", F.lit(5).alias("region_id"), "x0", "y0", "x1", "y1")
    assert {r.doc_id: r.nearby_text for r in layout.nearby_text(regions, blocks).collect()} == {1: "text of 1", 2: "text of 2"}


def test_gate(spark):
    def shut(caption, named=False):
        row = spark.createDataFrame([("spread", caption, named)], "o string, c string, n boolean")
        return row.select(linking.gated(F.col("o"), F.col("c"), F.col("n")).alias("v")).first().v

    assert not shut("Spread: a definition") and not shut("Spread")
    assert shut("Spreadsheet view") and shut("") and shut(None) and shut("Spread " + "x" * 90)
    assert not shut("", named=True)


def test_exact_scores(spark):
    index = spark.createDataFrame([(0, ["spread"], ["spread", "ted spread"]), (1, ["repo", "rate"], ["reverse-repo!"])], "idx int, primary array<string>, phrases array<string>")
    texts = spark.createDataFrame([(1, "the spread"), (2, "a ted spread"), (3, "reverse repo! of"), (4, "spreads")], "segment_id long, text string")
    got = {(r.segment_id, r.idx): (r.exact, r.named) for r in linking.exact_scores(texts, index).collect()}
    assert got == {(1, 0): (1.0, False), (2, 0): (1.0, True), (3, 1): (0.7, False)}


def test_links_with_near_misses(spark):
    taxonomy = spark.createDataFrame([(0, 1, "Dividend Yield", "income", ""), (1, 1, "LIBOR (London Interbank Offer Rate)", "", "")], "idx int, level int, concept string, tags string, pages string")
    segments = spark.createDataFrame([(1, "Dividends and yields", "", "", ""), (2, "the libor fixing", "libor", "", "libor")], "segment_id long, caption string, summary string, ocr string, nearby string")
    index = linking.concepts(taxonomy)
    found = similarity.tokens(segments, T.normalized(linking.search_text()))
    got = {(r.segment_id, r.idx): r.fuzzy for r in similarity.fuzzy_scores(found, index, linking.generic_terms(index)).collect()}
    assert got == {(1, 0): 0.9, (2, 1): 1.0}
    assert {(r.segment_id, r.idx) for r in linking.ranked_links(linking.scores(segments, index, least=0.5)).collect()} == {(2, 1)}
    # pairs carry no texts or phrases on to later joins
    assert not {"caption", "summary", "nearby", "phrases"} & set(linking.scores(segments, index).columns)


def test_value_ranges_and_layout(spark):
    texts = ["$1.5M", "23%", "-45.2K", "2015-2023", "1,5", "1,234.56"]
    blocks = spark.createDataFrame([(1, i, t, 0.0, float(100 * i), 1.0, 1.0) for i, t in enumerate(texts)], "segment_id long, idx int, text string, x0 double, y0 double, x1 double, y1 double")
    got = ocr.value_ranges(blocks).first()
    assert (got.lo, got.hi, got.n) == (-45200.0, 1500000.0, 8)
    assert ocr.layout(blocks).first().layout == "hierarchical_vertical"
    assert one(spark, ocr.subfigures(F.col("t")), t="(a) b) (c)") == 3


def test_responses(spark):
    rows = spark.createDataFrame([(1, '```json\n{"classification": {"category": "chart", "confidence": 0.99}}\n```'), (2, None)], "segment_id long, response_json string")
    got = {r.segment_id: r for r in models.parse_responses(rows).collect()}
    assert (got[1].segment_type, got[1].confidence) == ("chart", 0.95)
    assert (got[2].segment_type, got[2].confidence, got[2].method) == ("figure", 0.3, "fallback_heuristic")


CANDIDATE = "doc_id long, page_no long, pass_no int, idx int, x0 double, y0 double, x1 double, y1 double, captioned boolean, grey_var double, score double, n_drawings long"


def test_conflict_fold(spark):
    box = (0.0, 0.0, 10.0, 10.0)
    rows = [
        (1, 1, 1, 1, *box, True, None, 0.9, 0), (1, 1, 2, 1, *box, False, 5000.0, 0.9, 0), (1, 1, 2, 2, 50.0, 50.0, 60.0, 60.0, False, 1.0, 0.5, 0),
        (2, 1, 1, 1, *box, False, None, 0.9, 0), (2, 1, 2, 1, *box, False, 1.0, 0.5, 0), (2, 1, 2, 2, *box, False, 5000.0, 0.9, 0),
        (3, 1, 1, 1, *box, True, None, 0.9, 0), (3, 1, 2, 1, 0.0, 0.0, 40.0, 40.0, False, 5000.0, 0.9, 0),
    ]
    kept = {}
    for r in folds.conflict_fold(spark.createDataFrame(rows, CANDIDATE)).orderBy("doc_id", "place").collect():
        kept.setdefault(r.doc_id, []).append((r.pass_no, r.idx))
    # a caption counts as much as variance and score, and ties go to the image, as does a lone region without a caption
    assert kept == {1: [(2, 1), (2, 2)], 2: [(2, 2)], 3: [(2, 1)]}


def test_regions_of_captions_and_drawings(spark):
    drawings = spark.createDataFrame([(1, 1, i, float(80 * i), 0.0, 80.0 * i + 5, 5.0) for i in range(5)], "doc_id long, page_no long, draw_no int, x0 double, y0 double, x1 double, y1 double")
    assert [(r.seed_no, r.n) for r in folds.drawing_clusters(drawings, 160.0, 3).collect()] == [(0, 3)]
    assert folds.drawing_regions(folds.drawing_clusters(drawings, 160.0), 612.0, 792.0).count() == 0
    columns = "doc_id long, page_no long, pass_no int, idx int, x0 double, y0 double, x1 double, y1 double, c_x0 double, c_y0 double"
    rows = [(1, 1, 1, 1, 0.0, 0.0, 100.0, 100.0, 10.0, 95.0), (1, 1, 2, 1, 10.0, 10.0, 50.0, 50.0, None, None), (1, 1, 2, 2, 0.0, 0.0, 300.0, 300.0, None, None), (1, 1, 2, 3, 5.0, 105.0, 90.0, 130.0, None, None)]
    assert [(r.pass_no, r.idx, r.place) for r in folds.new_regions(spark.createDataFrame(rows, columns)).collect()] == [(1, 1, 1), (2, 2, 2)]


def test_append_writes_an_id_once(spark, tmp_path):
    source, target = str(tmp_path / "in"), str(tmp_path / "out")
    schema = "segment_id long, v string"
    for turn, ids in enumerate([(1, 2, 2), (2, 3)]):
        spark.createDataFrame([(i, f"turn {turn}") for i in ids], schema).write.mode("append").parquet(source)
        append.stream_segments(spark, source, schema, target, str(tmp_path / f"checkpoint{turn}")).awaitTermination()  # a new checkpoint reads all again
    assert sorted((r.segment_id, r.v) for r in spark.read.parquet(target).collect()) == [(1, "turn 0"), (2, "turn 0"), (3, "turn 1")]


def test_summary_and_envelopes(spark, tmp_path):
    rows = spark.createDataFrame([("a", 1, "chart", 0.955, None, 'He said "x",\ny', "o" * 150, 2, None, "b", "f.pdf", 2), ("c", 1, "image", 0.5, "3.1", None, "", 0, "s", "b", "f.pdf", 1)], "segment_id string, page int, type string, confidence double, figure_number string, caption string, ocr_text string, linked_concepts int, summary string, book_id string, pdf_path string, place int")
    sinks.write_summary(rows.drop("book_id", "pdf_path", "place"), str(tmp_path / "csv"))
    got = {r.segment_id: r for r in sinks.read_summary(spark, str(tmp_path / "csv")).collect()}
    assert got["a"].caption == 'He said "x",\ny' and len(got["a"].ocr_text) == 100 and got["c"].confidence == "0.50"
    envelope = json.loads(sinks.book_envelopes(rows).first().json)
    assert (envelope["book_id"], envelope["total_segments"], [x["segment_id"] for x in envelope["segments"]]) == ("b", 2, ["c", "a"])


def test_segments_end_to_end(spark):
    blocks = spark.createDataFrame([(d, 1, 0, 10.0, 50.0, 300.0, 400.0, 312.0, 612.0, 792.0, "Figure 1.2: the dividend yield over time") for d in (1, 2)], "doc_id long, page_no long, block_no int, font_size double, x0 double, y0 double, x1 double, y1 double, page_width double, page_height double, text string")
    drawings = spark.createDataFrame([(1, 1, i, 60.0 + 40 * i, 150.0, 90.0 + 40 * i, 280.0) for i in range(3)], "doc_id long, page_no long, draw_no int, x0 double, y0 double, x1 double, y1 double")
    images = spark.createDataFrame([(2, 1, 0, 60.0, 100.0, 300.0, 290.0, 300, 300, 2000.0)], "doc_id long, page_no long, img_no int, x0 double, y0 double, x1 double, y1 double, px_w int, px_h int, grey_var double")
    taxonomy = spark.createDataFrame([(0, 1, "Dividend Yield", "", ""), (1, 2, "Spread", "", "")], "idx int, level int, concept string, tags string, pages string")

    class Fails:
        def __call__(self, image, text):
            raise RuntimeError("no model")

    rows = {r.doc_id: r for r in engine.segments(blocks, drawings, images, taxonomy, analyzer=Fails).collect()}
    assert {d: (r.method, r.error) for d, r in rows.items()} == {1: ("caption_based", "RuntimeError: no model"), 2: ("embedded_image", "RuntimeError: no model")}
    assert rows[1].figure_number == "1.2" and [x.concept for x in rows[1].links] == ["Dividend Yield"] and rows[1].segment_type == "figure"
    assert engine.segments(blocks, drawings, images, taxonomy, profile="legacy").where("size(links) = 1").count() == 2


def test_similar_terms(spark):
    a, b = spark.createDataFrame([("dividend",)], "a string"), spark.createDataFrame([("dividends",), ("spread",)], "b string")
    assert [r.b for r in similarity.similar_terms(a, b).collect()] == ["dividends"]


def test_best_ratios_of_a_text(monkeypatch):
    """Equal to all runs compared, also for long and odd texts, with few runs compared in full."""
    rng = random.Random(5)
    parts = ["mar", "ket", "ris", "k", "ß", "é", "-", "7", "\U0001f600", "bond", "İ"]
    words = ["".join(rng.choices(parts, k=rng.randint(1, 4))) for _ in range(60)]
    compared = []

    class Counted(SequenceMatcher):
        def __init__(self, *args):
            compared.append(args)
            super().__init__(*args)

    monkeypatch.setattr(similarity, "SequenceMatcher", Counted)
    total = 0
    for size in (0, 1, 2, 40, 3000):
        text = rng.choice([" ", "\n"]).join(rng.choices(words, k=size)) + " "
        names = [" ".join(rng.choices(words, k=rng.randint(1, 3))) for _ in range(12)] + ["", " Market  Risk", "a" * 300]
        own = text.lower().split()

        def plain(name, own=own):
            name = name.lower().strip()
            n = len(name.split())
            best = max((SequenceMatcher(None, name, " ".join(own[i : i + n])).ratio() for i in range(len(own) - n + 1)), default=0.0)
            return best if best >= 0.8 else 0.0

        assert similarity.best_ratios(text, names) == [plain(n) for n in names]
        total += size * len(names)
    assert len(compared) < total / 50


def test_a_text_meets_its_legacy_concepts_at_once(spark):
    """One row a segment goes to Python, however many concepts share a term with it."""
    taxonomy = spark.createDataFrame([(i, 1, f"bond yield {i}", "", "") for i in range(20)], "idx int, level int, concept string, tags string, pages string")
    segments = spark.createDataFrame([(1, "bond yield", "bond yields rise", "", ""), (2, None, "", None, "no such")], "segment_id long, caption string, summary string, ocr string, nearby string")
    found = linking.legacy_scores(segments, linking.concepts(taxonomy, parsed=False))
    assert found.count() == 20 and found.select("segment_id").distinct().count() == 1
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("ArrowEvalPython") > plan.index("Generate explode(arrays_zip")


def dealt_again(spark, name):
    """Exchanges of a layout query that deal something else than line items, with joins that broadcast nothing."""
    from glyphgrid.plans import catalog

    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = catalog.QUERIES[name](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString().split("\n")
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    return [below for line, below in zip(plan, plan[1:]) if "Exchange " in line and "Project [(l_orderkey" not in below]


@pytest.mark.skipif(not os.path.isdir("/root/testdata/sf0.001"), reason="no test tables")
def test_two_pass_deals_pages_once(spark):
    """Line items are dealt by page, and nothing that is found of them again."""
    assert dealt_again(spark, "two_pass_segments") == []
    assert dealt_again(spark, "combined_region") == []
    assert dealt_again(spark, "embedded_candidates") == []


@pytest.mark.skipif(not os.path.isdir("/root/testdata/sf0.001"), reason="no test tables")
def test_visual_regions_deal_drawn_regions_only(spark):
    """Besides line items only the regions that clusters give are dealt to their pages."""
    again = dealt_again(spark, "visual_regions")
    assert len(again) == 1 and "seed_no" in again[0]
