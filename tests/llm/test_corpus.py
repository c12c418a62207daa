"""Corpus operators against brute force, on texts with nulls, empties, repeats and clashing columns."""

import hashlib
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from glyphgrid.llm import additive_ann, context_coder, divergence_rules, language_id, neighbour_quality, order_minhash, rank_bpe, soft_mixing, token_counts, url_trust

public = pytest.importorskip("public_tokenizers")
rng = np.random.default_rng(3)
WORDS = {lang: ["".join(rng.choice(list(letters), size=rng.integers(2, 8))) for _ in range(400)] for lang, letters in (("aa", "abcdefgh"), ("zz", "stuvwxyz"))}


def prose(lang: str, n: int, seed: int) -> str:
    return " ".join(np.random.default_rng(seed).choice(WORDS[lang], size=n)) + "."


TEXTS = [None, "", " ", "a", "  two  spaces \n \n", "x" * 3000, "end<|endoftext|>mid \t y", "naïve — 中文 👍", *[prose("aa" if i % 2 else "zz", 60 + i, i) for i in range(40)]]


@pytest.fixture(scope="module")
def documents(spark):
    rows = [(i, t, None if t is None else "aa" if i % 2 else "zz", 0, "c") for i, t in enumerate(TEXTS)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, id int, score string")


def library(name):
    from tokenizers import Tokenizer

    return Tokenizer.from_file(public.path(name))


def test_token_counts(documents):
    tokenizer = library("byte_bpe_50k.json")
    for r in token_counts.token_counts(documents).collect():
        text = TEXTS[r.doc_id] or ""
        assert (r.n_bytes, r.n_tokens) == (len(text.encode()), len(tokenizer.encode(text, add_special_tokens=False).ids))


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_long_texts_are_split_safely(name):
    tokenizer = library(name)
    letters = np.random.default_rng(5)
    words = [*WORDS["aa"], *WORDS["zz"], "it's", "  ", "\n", "naïve", "12", "x.", "<|endoftext|>", "中文", "\t "]
    texts = [" ".join(letters.choice(words, size=30_000)), "ab" * 80_000, "中文" * 40_000, "", "a b"]
    counter = token_counts.BatchCounter(name)
    assert counter.splits and len(token_counts.parts_of(texts[0])) > 1 and "".join(token_counts.parts_of(texts[0])) == texts[0]
    assert counter.count(pa.array(texts)).tolist() == [len(tokenizer.encode(t, add_special_tokens=False).ids) for t in texts]


def test_rank_bpe(documents):
    tokenizer = library("byte_bpe_50k.json")
    for r in rank_bpe.round_trip_digests(documents, keep_ids=True).collect():
        ids = tokenizer.encode(TEXTS[r.doc_id] or "", add_special_tokens=False).ids
        assert r.ids == ids
        assert r.ids_sha256 == hashlib.sha256(np.array(ids, dtype="<u4").tobytes()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(tokenizer.decode(ids, skip_special_tokens=False).encode()).hexdigest()


def test_language(documents):
    fitted = language_id.fit(documents.where("doc_id % 3 <> 0"))
    got = {r.doc_id: r for r in language_id.identify(documents, fitted).collect()}
    assert got[0].lang_pred == got[1].lang_pred == "und" and got[0].score == 0
    assert all(got[i].lang_pred == ("aa" if (i - 8) % 2 else "zz") for i in range(8, len(TEXTS)))
    assert language_id.identify(documents, language_id.fit(documents.where("false"))).where("lang_pred <> 'und'").count() == 0


def test_quality(spark):
    rows = [(i, (prose("aa", 80, i) if i % 2 else " ".join(w + "!!" for w in prose("aa", 80, i).upper().split())), i % 2) for i in range(60)] + [(60, None, 1), (61, "", 0)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, quality int")
    voters = neighbour_quality.fit(frame.select("doc_id", "text"), frame.where("doc_id < 40").select("doc_id", "quality"))
    got = {r.doc_id: r for r in neighbour_quality.score(frame, voters).collect()}
    assert all(got[i].predicted == i % 2 for i in range(40, 60)) and 0 <= got[60].score == got[61].score <= 1
    assert neighbour_quality.score(frame, neighbour_quality.fit(frame, frame.where("false"))).where("score <> 0.5").count() == 0


def test_rules_base_counts(spark):
    repeated = " ".join(f"w{i}" for i in range(12))
    texts = [None, "", " \t\n", "a # b\na # b\nc", f"{repeated} x {repeated}", "one " * 30, prose("aa", 100, 1)]
    frame = spark.createDataFrame([(i, t, "aa") for i, t in enumerate(texts)], "doc_id long, text string, lang string")
    for r in divergence_rules.judge(frame).collect():
        text = texts[r.doc_id] or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", text)
        lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
        grams = [tuple(words[i : i + 8]) for i in range(len(words) - 7)]
        many = Counter(grams)
        covered = {j for i, g in enumerate(grams) if many[g] > 1 for j in range(i, i + 8)}
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered))
        assert r.base_failed == (len(words) < 20 or 100 * len(covered) > 30 * len(words)) and (not r.base_failed or not r.kept)


def test_near_duplicates(spark):
    base = prose("aa", 200, 1).split()
    near = [*base[:100], "changed", *base[101:]]
    other = prose("zz", 200, 2)
    rows = [(5, " ".join(base)), (7, " ".join(near)), (9, other), (11, other), (1, None), (2, None), (3, ""), (4, "")]
    frame = spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, id string")
    got = {r.doc_id: r.class_id for r in order_minhash.classes(frame).collect()}
    assert got == {5: 5, 7: 5, 9: 9, 11: 9, 1: 1, 2: 2, 3: 3, 4: 3}
    assert order_minhash.classes(frame.where("false")).count() == 0


def test_neighbours(spark):
    vectors = rng.standard_normal((300, 8)).astype(np.float32)
    rows = [(i, v.tolist()) for i, v in enumerate(vectors)] + [(300, None), (301, [0.0] * 8), (302, [float("nan")] * 8), (303, vectors[3].tolist())]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    got = additive_ann.search(frame, F.col("vec_id") % 20 == 0, 5, rerank=60, block_rows=128).collect()
    exact = vectors.astype(np.float64)
    exact = np.vstack([exact, np.full((3, 8), -1e9), exact[3]])
    hits = 0
    for q in range(0, 300, 20):
        scores = exact @ exact[q]
        scores[[q, 300, 301, 302]] = -np.inf
        hits += len(set(np.lexsort((np.arange(304), -scores))[:5]) & {r.vec_id for r in got if r.query_id == q})
    assert hits >= 0.9 * 75 and len(got) == 75


def test_urls(spark):
    rules = [("block", "com/en/"), ("allow", "example.com/en/7"), ("allow", "net/de/")]
    pages = [(1, "https://A.Example.com/en/71?x", '<a href="https://bad.example.org/x">'), (2, "http://m.example.com/en/8", None), (3, None, None), (4, "https://good.net/de/1", '<a href="https://fine.example.org/">'), (5, "https://fine.example.org/q", ""), (6, "https://from.example.org/", '<a href="http://m.example.com/en/8">')]
    got = {r.page_id: r for r in url_trust.judge(spark.createDataFrame(pages, "page_id long, url string, html string"), rules).collect()}
    assert (got[1].host, got[1].path, got[1].rule, got[1].verdict) == ("a.example.com", "/en/71", "example.com/en/7", "allow")
    assert got[2].verdict == "block" and (got[3].host, got[3].path, got[3].verdict) == ("", "", "allow")
    assert got[4].verdict == got[5].verdict == "allow" and got[5].trust > 0
    assert got[6].verdict == "block"  # it links to a host of blocked urls


def test_mixing(spark):
    rows = [(i, prose("aa", 50, i) if i % 2 else prose("zz", 50, i)) for i in range(120)] + [(120, None)]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    labels = frame.where("doc_id < 80").select("doc_id", F.when(F.col("doc_id") % 2 == 1, "aa").otherwise("zz").alias("domain"))
    got = soft_mixing.mix(frame, labels, {"aa": 0.8, "zz": 0.2}).collect()
    total = sum(r.tokens for r in got)
    assert abs(sum(r.rate * r.tokens * r.p[0] for r in got) / total - 0.8) < 0.01 and min(r.rate for r in got) >= 0


def test_mixing_keeps_rows_and_fits(spark):
    texts = [(i % 50, prose("aa" if i % 3 else "zz", 40 + i, i)) for i in range(150)] + [(None, None), (None, ""), (7, None)]
    frame = spark.createDataFrame(texts, "doc_id long, text string").withColumn("__p", F.lit(1)).withColumn("rate", F.lit("x"))
    labels = spark.createDataFrame([(i, "aa" if i % 2 else "zz") for i in range(40)] + [(None, "aa")], "doc_id long, domain string")
    targets = {"aa": 0.7, "zz": 0.3}
    mixture, table = soft_mixing.fit_mixture(frame, labels, targets, turns=200)
    got = soft_mixing.mix(frame, labels, targets, turns=200).collect()
    assert len(got) == len(texts) and {r.tokens for r in got if r.doc_id is None} == {0}
    # the same least squares by plain projected gradients over documents
    p = np.array([r.p for r in got])
    tokens = np.array([r.tokens for r in got], dtype=float)
    total, wanted = tokens.sum(), np.array([0.7, 0.3])
    scale = np.maximum((tokens[:, None] * p).sum(axis=0) / total, 1e-6)
    rates = np.ones(len(got))
    for _ in range(4000):
        residual = ((rates * tokens) @ p / total - wanted) / scale
        rates = np.maximum(0, rates - (p @ residual + 1e-3 * (rates - 1)))
    mine = np.array([r.rate for r in got])
    loss = lambda r: ((((r * tokens) @ p / total - wanted) ** 2) / scale).sum() + 1e-3 * (tokens * (r - 1) ** 2).sum() / total
    assert loss(mine) <= loss(rates) + 1e-4 and mine.min() >= 0
    taken = soft_mixing.take(frame, mixture)
    assert taken.columns == frame.columns and abs(taken.count() - mine.sum()) < 3 * len(got) ** 0.5
    none = soft_mixing.mix(frame, labels.where("false"), targets).collect()
    assert len(none) == len(texts) and {r.rate for r in none} == {1.0}
    assert soft_mixing.mix(frame.where("false"), labels, targets).count() == 0


def test_range_coder():
    draws = np.random.default_rng(9)
    blocks = [draws.zipf(1.4, size=n).clip(0, 49407) for n in (0, 1, 300, 299, 1024)]
    blocks += [draws.integers(0, 1 << 28, 200), np.full(500, 7), np.tile([5, 70_000, 3], 100), np.arange(1000)]
    payloads = context_coder.encode_blocks(blocks)
    assert all((a == b).all() for a, b in zip(blocks, context_coder.decode_blocks(payloads), strict=True))
    assert len(payloads[6]) < 100 and all((context_coder.decode_blocks([p])[0] == b).all() for p, b in zip(payloads, blocks, strict=True))
    broken = payloads[2][:40] + bytes([payloads[2][40] ^ 1]) + payloads[2][41:]
    for bad in (broken, payloads[2][:5], b"CMX0" + payloads[2][4:]):
        with pytest.raises(ValueError):
            context_coder.decode_blocks([bad])
    for wrong in (np.array([1 << 28]), np.array([-1]), np.zeros(1025, dtype=np.int64)):
        with pytest.raises(ValueError):
            context_coder.encode_blocks([wrong])


def test_written_ids(spark):
    tokenizer = library("word_bpe_49k.json")
    rows = [(i * 7 % 48, t) for i, t in enumerate(TEXTS)] + [(None, "no id"), (None, None), (3, "again"), (3, "again"), (900, prose("aa", 6000, 1))]
    frame = spark.createDataFrame(rows, "doc_id long, text string").withColumn("part", F.lit("x")).repartition(5)
    got = context_coder.written_digests(frame).orderBy("start").collect()
    assert len(got) == len(rows) and [r.doc_id for r in got[:2]] == [None, None]
    ids = [r.doc_id for r in got[2:]]
    assert ids == sorted(ids)
    known = Counter()
    for doc, text in rows:
        run = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 2]
        known[doc, len(run), zlib.crc32(np.array(run, dtype="<u4").tobytes())] += 1
    assert Counter((r.doc_id, r.n_tokens, r.ids_crc32) for r in got) == known
    assert [r.start for r in got] == np.cumsum([0, *[r.n_tokens for r in got]])[:-1].tolist()
    assert context_coder.written_digests(frame.where("false")).count() == 0


def test_word_ids():
    tokenizer = library("word_bpe_49k.json")
    texts = [t or "" for t in TEXTS]
    ids, counts = context_coder.PieceEncoder("word_bpe_49k.json").slice_ids(pa.array(texts), 2)
    at = 0
    for text, n in zip(texts, counts, strict=True):
        assert ids[at : at + n].tolist() == [*tokenizer.encode(text, add_special_tokens=False).ids, 2]
        at += n


def planted_classes(texts: dict[int, str], threshold: float = 0.8) -> dict[int, int]:
    """Least id of each class, from the alignment of all pairs by plain dynamic programming."""
    grams = {}
    for i, text in texts.items():
        words = ["".join(filter(str.isalnum, w.lower())) for w in text.split()]
        grams[i] = [tuple(words[k : k + 5]) for k in range(len(words) - 4)]
    label = {i: i for i in texts}
    for i in sorted(texts):
        for j in sorted(texts):
            if i < j and label[i] != label[j]:
                row = [0] * (len(grams[j]) + 1)
                for g in grams[i]:
                    before = 0
                    for k, h in enumerate(grams[j], 1):
                        before, row[k] = row[k], before + 1 if g == h else max(row[k], row[k - 1])
                if row[-1] >= threshold * (len(grams[i]) + len(grams[j]) - row[-1]) - 1e-9:
                    low, high = sorted((label[i], label[j]))
                    label = {k: low if v == high else v for k, v in label.items()}
    return label


def test_near_duplicate_chains(spark):
    """A chain L - A - B in whose buckets A leaves with the leader L, to which B is not linked."""
    texts = {}
    for chain in range(40):
        words = [f"c{chain}w{i}" for i in range(204)]
        for k, changed in enumerate(([], [199], [199, *range(20, 20 + 9 * 4, 9)])):
            texts[chain * 3 + k] = " ".join("new" + w if i in changed else w for i, w in enumerate(words))
    want = planted_classes({i: t for i, t in texts.items() if i < 3})
    assert want == {0: 0, 1: 0, 2: 0}
    frame = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    assert {r.doc_id: r.class_id for r in order_minhash.classes(frame).collect()} == {i: i // 3 * 3 for i in texts}


def template_pairs(pairs: int) -> dict[int, str]:
    """Texts of one template (0.74 similar) in pairs that share some of their own words too (0.81)."""
    texts = {}
    for i in range(2 * pairs):
        own = [f"p{i // 2}w{k}" if k < 9 else f"t{i}w{k}" for k in range(30)]
        texts[i] = " ".join([f"template{k}" for k in range(174)] + own)
    return texts


def test_near_duplicates_in_a_template(spark):
    """All texts meet in every bucket, where only pairs are linked."""
    texts = template_pairs(150)
    assert planted_classes({i: texts[i] for i in range(4)}) == {0: 0, 1: 0, 2: 2, 3: 2}
    frame = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    assert {r.doc_id: r.class_id for r in order_minhash.classes(frame).collect()} == {i: i // 2 * 2 for i in texts}


def alignment_classes(rows: list[tuple], threshold: float = 0.8) -> dict:
    """Class of each (id, text) by all pairs of distinct texts."""
    texts = sorted({t for _, t in rows if t is not None})
    keys, offsets = order_minhash.kmers(*order_minhash.WordHasher().flat(pa.array(texts)))
    own = [keys[a:b] for a, b in zip(offsets, offsets[1:], strict=False)]
    label = list(range(len(texts)))
    for i in range(len(texts)):
        for j in range(i):
            if label[i] != label[j] and len(own[i]) and len(own[j]) and order_minhash.matches(own[i], own[j], threshold) >= order_minhash.least_matches(len(own[i]), len(own[j]), threshold):
                label = [label[i] if x == label[j] else x for x in label]
    at = {t: label[i] for i, t in enumerate(texts)}
    least: dict = {}
    for i, t in rows:
        if t is not None and i is not None:
            least[at[t]] = min(i, least.get(at[t], i))
    return {(i, t): least.get(at[t]) if t is not None else i for i, t in rows}


def test_crowded_family_and_chains(spark):
    draw = np.random.default_rng(21)
    vocabulary = [f"w{i}" for i in range(3000)]
    base = list(draw.choice(vocabulary, size=150))
    rows = []
    for i in range(120):  # copies with one to twenty words changed: links, chains and near misses of one template
        words = list(base)
        for at in draw.choice(150, size=int(draw.integers(0, 8)), replace=False):
            words[at] = f"x{draw.integers(10**9)}"
        rows.append((i, " ".join(words)))
    chain = list(draw.choice(vocabulary, size=100))
    for i in range(12):  # each is like the one before, and less and less like the first
        chain[8 * i] = f"y{i}"
        rows.append((200 + i, " ".join(chain)))
    passage = " ".join(draw.choice(vocabulary, size=60))
    rows += [(300 + i, passage + " " + " ".join(draw.choice(vocabulary, size=40))) for i in range(60)]
    rows += [(5, "an id again"), (5, "an id again"), (400, rows[0][1]), (None, "of no id"), (401, None), (402, ""), (403, ""), (404, "?!")]
    frame = spark.createDataFrame(rows, "doc_id long, text string").withColumn("node", F.lit(1)).withColumn("class_id", F.lit("z"))
    want = alignment_classes(rows)
    got = order_minhash.classes(frame).collect()
    assert Counter((r.doc_id, r.class_id) for r in got) == Counter((i, want[i, t]) for i, t in rows)
    kept = order_minhash.keep_one(frame)
    assert kept.columns == frame.columns
    assert Counter(r.doc_id for r in kept.collect()) == Counter(i for i, t in dict.fromkeys(rows) if i == want[i, t] and (t is None or t != rows[0][1] or i != 400))
    assert order_minhash.classes(frame.where("false")).count() == 0


def test_filters_of_the_pipeline(spark, tmp_path):
    corpus_pipeline = pytest.importorskip("corpus_pipeline")
    rows = [(i, prose("aa" if i % 2 else "zz", 80 + i, i), "aa" if i % 2 else "zz", "s", 0) for i in range(60)] + [(None, None, None, None, None), (3, "", "aa", "s", 0), (70, "# " * 300, "aa", "s", 0)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    labels = spark.createDataFrame([(i, int(i % 10 != 0), 0) for i in range(60)], "doc_id long, quality int, toxic int")
    frame.write.parquet(str(tmp_path / "documents.parquet"))
    labels.write.parquet(str(tmp_path / "labels.parquet"))
    docs = spark.read.parquet(str(tmp_path / "documents.parquet"))
    voters = neighbour_quality.fit(docs, labels)
    plain = {r.doc_id: r.score for r in neighbour_quality.score(docs.where("doc_id >= 60"), voters).collect()}
    kept = neighbour_quality.keep(docs, voters, 0.3)
    assert kept.schema == docs.schema and {r.doc_id for r in kept.where("doc_id >= 60").collect()} == {i for i, s in plain.items() if s >= 0.3}
    judged = {(r.doc_id, r.n_words) for r in divergence_rules.judge(docs).where("kept").collect()}
    ruled = divergence_rules.keep(docs)
    assert ruled.columns == docs.columns and {(r.doc_id, len(r.text.split())) for r in ruled.collect()} == judged
    out = corpus_pipeline.run(spark, str(tmp_path))
    assert {"doc_id", "n_tokens", "ids"} <= set(out.columns) and out.where("doc_id is null or doc_id = 70").count() == 0 and out.count() > 20


def test_a_worker_holds_one_memo_at_a_time():
    """Workers that serve several stages don't add up the memos of all of them."""
    import gc
    import weakref

    from glyphgrid.llm import neighbour_quality, order_minhash, rank_bpe

    features = weakref.ref(neighbour_quality.worker_features())
    assert neighbour_quality.worker_features() is features()  # kept from task to task
    coder = rank_bpe.worker_coder("byte_bpe_50k.json")
    assert rank_bpe.worker_coder("byte_bpe_50k.json") is coder
    gc.collect()
    assert features() is None
    coder = weakref.ref(coder)
    order_minhash.worker_hasher()
    gc.collect()
    assert coder() is None


def test_words_joined_in_library_calls():
    encoder = context_coder.PieceEncoder("word_bpe_49k.json")
    library_of, sent = encoder.tokenizer, []

    class Counted:
        encode = library_of.encode

        def encode_batch_fast(self, texts, **options):
            sent.extend(texts)
            return library_of.encode_batch_fast(texts, **options)

    encoder.tokenizer = Counted()
    odd = "can't CAN'T it'SS 'tis ''s a\x01b \x01 \x01\x01 <|endoftext|> x<|endoftext|>y <|ENDOFTEXT|> é ́x   a　b İ H̱ ẖ 12a3 --- ...a <|x a\x1cb \x7f 中文 \U0001f600</w> </w> über,Ärger's Straße's7 don't7a,b1é à'LL ж'D ß--ÿ ÿ×÷ª Привет,Мир'ёЁ"
    texts = [odd, " ".join(f"w{i:x}q'll" for i in range(5000)), "", " ".join(f"é{i:x}ж" for i in range(3000)), odd.upper()]
    ids, counts = encoder.slice_ids(pa.array(texts), 2)
    runs = np.split(ids, np.cumsum(counts)[:-1])
    assert [r.tolist() for r in runs] == [[*library_of.encode(t, add_special_tokens=False).ids, 2] for t in texts]
    assert len(sent) < 300  # one for each of some 8,000 words before


def test_chunks_code_ranks():
    draws = np.random.default_rng(3)
    ids = draws.permutation(49_000)[draws.zipf(1.3, size=40_000).clip(0, 3000)].astype(np.uint32)
    ranks, known = context_coder.by_frequency(ids)
    assert (context_coder.of_ranks(ranks, known) == ids).all()
    high = ids + np.uint32(1 << 27)
    assert (context_coder.of_ranks(*context_coder.by_frequency(high)) == high).all()
    size = sum(map(len, context_coder.blocks_of(ranks)))
    assert size < 0.8 * sum(map(len, context_coder.blocks_of(ids)))
    with pytest.raises(ValueError):
        context_coder.of_ranks(np.array([5], dtype=np.uint32), np.arange(5, dtype=np.uint32))
