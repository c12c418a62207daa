"""Host scores against a plain PageRank, neighbour votes against a plain vote, recall of the quantised search."""

from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from glyphgrid.llm import additive_ann, neighbour_quality, token_counts, url_trust

PAGES = [
    (1, "http://a.com/good/1", '<a href="https://b.org/x">b</a> see https://B.org/y and <img src="//c.net/i.png"> or www.d.example.com.'),
    (2, "http://b.org/", 'plain text of http://c.net/z, and e.io too, unlike this.That or file.txt <a href="/own">own</a> <a href="http://b.org/self">'),
    (3, "https://c.net/bad", '<a href="http://a.com">back</a> <meta content="//e.io/x">'),
    (4, "https://e.io/", "user@b.org is mail; https://f.dev/q?u=1"),
    (5, "https://F.dev/x", None),
    (6, "https://g.com/bad", 'buy at http://f.dev http://f.dev and http://c.net'),
    (7, None, "http://a.com"),
    (8, "no scheme", "http://a.com"),
    (9, "https://h.com/", "nothing"),
    (1, "http://a.com/good/1", '<a href="https://b.org/x">again</a>'),
]
EDGES = {("a.com", "b.org"): 3, ("a.com", "c.net"): 1, ("a.com", "www.d.example.com"): 1, ("b.org", "c.net"): 1, ("b.org", "e.io"): 1, ("c.net", "a.com"): 1, ("c.net", "e.io"): 1, ("e.io", "f.dev"): 1, ("g.com", "f.dev"): 2, ("g.com", "c.net"): 1}
RULES = [("allow", "a.com/good"), ("block", "net/bad"), ("block", "g.com/")]


def plain_rank(edges: dict, seeds: dict, damping: float = 0.85) -> dict:
    total = sum(seeds.values())
    seeds = {h: m / total for h, m in seeds.items()}
    out = defaultdict(float)
    for (a, _), n in edges.items():
        out[a] += n
    score = dict(seeds)
    for _ in range(400):
        flow = defaultdict(float)
        for (a, b), n in edges.items():
            flow[b] += damping * score.get(a, 0.0) * n / out[a]
        left = 1 - sum(flow.values())
        score = {h: flow.get(h, 0.0) + left * seeds.get(h, 0.0) for h in {*flow, *seeds}}
    return score


def test_url_trust(spark):
    frame = spark.createDataFrame([(*p, "x") for p in PAGES], "page_id long, url string, html string, trust string")
    edges = {(r.src, r.dst): r.n for r in url_trust.host_edges(frame.select(url_trust.host_and_path(F.col("url"))[0].alias("host"), "html")).collect()}
    assert edges == EDGES
    trust, distrust = plain_rank(EDGES, {"a.com": 2}), plain_rank({(b, a): n for (a, b), n in EDGES.items()}, {"c.net": 1, "g.com": 1})
    rows = url_trust.judge(frame, RULES).collect()
    assert sorted(r.page_id for r in rows) == sorted(p[0] for p in PAGES)
    for r in rows:
        t, d = trust.get(r.host, 0.0), distrust.get(r.host, 0.0)
        assert abs(r.trust - t) < 2e-6 and abs(r.distrust - d) < 2e-6
        assert r.verdict == {"a.com/good": "allow", "net/bad": "block", "g.com/": "block"}.get(r.rule, "block" if d > t else "allow")
    assert {r.page_id: r.host for r in rows if r.host == ""} == {7: "", 8: ""}
    assert url_trust.judge(frame.where("false"), RULES).count() == 0


def test_votes_against_a_plain_vote(spark, monkeypatch):
    draw = np.random.default_rng(4)
    counts = (draw.random((300, neighbour_quality.BUCKETS)) < 0.01).astype(np.float32) * draw.integers(1, 5, size=(300, 1)).astype(np.float32)
    counts[100:160] = counts[100]  # ties: more equal texts than neighbours
    labels = draw.integers(0, 2, size=300)
    labels[100:160] = np.arange(60) % 3 == 0
    voters = neighbour_quality.Voters(counts, labels, 32, 25, 4.0, list(range(300)))
    asked = np.concatenate([counts[::7], counts[100:101], np.zeros((1, neighbour_quality.BUCKETS), dtype=np.float32), (draw.random((20, neighbour_quality.BUCKETS)) < 0.01).astype(np.float32)])
    unit = lambda x: x / max(np.linalg.norm(x), 1e-30)
    for row, got in zip(asked, voters.scores(asked), strict=True):
        cosines = voters.vectors @ unit(unit(row * voters.idf) @ voters.directions)
        near = sorted(range(300), key=lambda i: (-round(float(cosines[i]), 5), i))[:25]
        weights = [max(float(cosines[i]), 0.0) ** 4 for i in near]
        want = sum(w * labels[i] for w, i in zip(weights, near, strict=True)) / sum(weights) if sum(weights) else labels.mean()
        assert abs(got - want) < 2e-3
    empty = spark.createDataFrame([], "doc_id long, text string, score string")
    assert neighbour_quality.score(empty, spark.sparkContext.broadcast(voters)).count() == 0
    tiny = spark.createDataFrame([(i % 50, "a b") for i in range(5000)], "doc_id long, text string").coalesce(1)
    assert neighbour_quality.score(tiny, spark.sparkContext.broadcast(voters)).select(F.round("score", 4)).distinct().count() == 1


def test_recall_and_norms():
    """At the query's own settings, and better with the stored norms than without."""
    draw = np.random.default_rng(6)
    centres = draw.normal(size=(40, 32))
    rows = centres[draw.integers(0, 40, size=6000)] + 0.6 * draw.normal(size=(6000, 32))
    books = additive_ann.Codebooks(rows.astype(np.float32), 8, 128, 8)
    codes = books.encode(rows)
    norms = (np.linalg.norm(rows, axis=1) / np.linalg.norm(books.decode(codes).astype(float), axis=1)).astype(np.float32)
    ids, asked = np.arange(6000), np.arange(0, 6000, 60)
    recall = {}
    for name, own in (("norms", norms), ("plain", np.ones_like(norms))):
        found = additive_ann.block_best(asked, rows[asked], ids, rows, codes, own, books, 20, 300)
        hits = 0
        for q in asked:
            exact = rows @ rows[q]
            exact[q] = -np.inf
            hits += len(set(found[1][found[0] == q]) & set(np.argsort(-exact, kind="stable")[:20]))
        recall[name] = hits / 20 / len(asked)
    assert recall["norms"] >= max(0.9, recall["plain"] - 0.005)


@pytest.mark.parametrize("operator", [lambda f: additive_ann.search(f.select(F.col("doc_id").alias("vec_id"), F.array(F.lit(1.0)).alias("embedding")), F.lit(True)), token_counts.token_counts])
def test_empty_tables(spark, operator):
    assert operator(spark.createDataFrame([], "doc_id long, text string, n_tokens string")).count() == 0


@pytest.mark.parametrize("name", ["word_bpe_49k.json", "byte_bpe_50k.json"])
def test_ids_of_both_kinds_of_files(name):
    """Words are encoded one by one only where the file drops white space."""
    import pyarrow as pa

    from glyphgrid.llm import context_coder

    public = pytest.importorskip("public_tokenizers")
    tokenizers = pytest.importorskip("tokenizers")
    tokenizer = tokenizers.Tokenizer.from_file(public.path(name))
    texts = ["two  words\n and more words", "", " ", "naïve 中文 <|endoftext|> end", "a b a b"]
    encoder = context_coder.PieceEncoder(name)
    assert encoder.by_words == name.startswith("word")
    ids, counts = encoder.slice_ids(pa.array(texts), 2)
    want = [[*tokenizer.encode(t, add_special_tokens=False).ids, 2] for t in texts]
    assert ids.tolist() == [i for w in want for i in w] and counts.tolist() == [len(w) for w in want]


def test_tables_without_rows_and_clashing_columns(spark):
    """Operators 7 to 10 on empty tables, and on rows with columns named like their own."""
    from glyphgrid.llm import context_coder, divergence_rules, rank_bpe, soft_mixing

    schema = "doc_id long, text string, lang string, n_tokens string, node string, key string, id string, kept string, rate string"
    rows = [(i, t, lang, "a", "b", "c", "d", "e", "f") for i, (t, lang) in enumerate([("some words here " * 30, "aa"), (None, "aa"), ("", None), ("word " * 40_000, "zz")])]
    full, empty = spark.createDataFrame(rows, schema), spark.createDataFrame([], schema)
    labels = spark.createDataFrame([(0, "clean"), (3, "clean")], "doc_id long, domain string")
    operators = [
        divergence_rules.judge,
        lambda f: context_coder.written_digests(f, "word_bpe_49k.json", 2),
        lambda f: rank_bpe.round_trip_digests(f, "byte_bpe_50k.json"),
        lambda f: soft_mixing.mix(f, labels, {"clean": 1.0}, budget=1.0),
    ]
    for operator in operators:
        assert operator(empty).count() == 0
        assert sorted(r.doc_id for r in operator(full).select("doc_id").collect()) == [0, 1, 2, 3]
