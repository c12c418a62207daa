"""Language models against a plain Kneser-Ney, and languages of very few rows."""

import math
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from glyphgrid.llm import language_id

draw = np.random.default_rng(2)
VOCABULARY = {"aa": "abcdefg", "mm": "ghijklm", "zz": "stuvwxé"}


def prose(lang: str, n: int) -> str:
    return " ".join("".join(draw.choice(list(VOCABULARY[lang]), size=draw.integers(1, 7))) for _ in range(n))


class Plain:
    """Interpolated Kneser-Ney over tuples: the current character, then those before it."""

    def __init__(self, words: Counter, alphabet: int, order: int = 4):
        self.alphabet, self.order = alphabet, order
        top: Counter = Counter()
        for word, n in words.items():
            for gram in self.grams(word):
                top[gram] += n
        self.counts = {order: top}
        for k in range(order - 1, 0, -1):
            wider = {g[: k + 1] for g in top}
            self.counts[k] = Counter(g[:k] for g in wider)
        self.sums, self.discount = {}, {}
        for k, counts in self.counts.items():
            ones, twos = (sum(c == n for c in counts.values()) for n in (1, 2))
            self.discount[k] = min(0.95, max(0.05, ones / (ones + 2 * twos))) if ones else 0.5
            by = defaultdict(lambda: [0, 0])
            for g, c in counts.items():
                by[g[1:]][0] += c
                by[g[1:]][1] += 1
            self.sums[k] = by

    def grams(self, word: str):
        padded = " " * self.order + word + " "
        for end in range(self.order, len(padded)):
            yield tuple(padded[end - k] for k in range(self.order))

    def probability(self, gram: tuple) -> float:
        k = len(gram)
        if not k:
            return 1 / self.alphabet
        lower = self.probability(gram[:-1])
        if gram[1:] not in self.sums[k]:
            return lower
        total, kinds = self.sums[k][gram[1:]]
        own = max(self.counts[k].get(gram, 0) - self.discount[k], 0.0)
        return own / total + self.discount[k] * kinds / total * lower


def test_model_against_plain():
    words = {lang: Counter(prose(lang, 400).split()) for lang in VOCABULARY}
    alphabet = len({c for counts in words.values() for w in counts for c in w} | {" "})
    model = language_id.KneserNey({lang: dict(c) for lang, c in words.items()})
    model.freeze()
    plain = {lang: Plain(c, alphabet) for lang, c in words.items()}
    for piece in ["abc", "gggg", "zzzz", "stu", "qqq", "é", "abcdefgabcdefg", *draw.choice(list(words["mm"]), size=30)]:
        got = model.piece_scores([str(piece)])[0]
        want = [sum(math.log(plain[lang].probability(g)) for g in plain[lang].grams(str(piece))) for lang in model.languages]
        assert np.allclose(got[:-1], want) and got[-1] == len(piece) + 1


@pytest.mark.parametrize("rows", [1, 2, 5, 60])
def test_few_rows(spark, rows):
    """No language is lost, however its rows are drawn, also where all rows are equal."""
    for repeat in (False, True):
        texts = [(lang, prose(lang, 80)) for lang in VOCABULARY for _ in range(1 if repeat else rows)]
        texts = texts * rows if repeat else texts
        frame = spark.createDataFrame([(None if repeat else i, t, lang, "x") for i, (lang, t) in enumerate(texts)], "doc_id long, text string, lang string, score string")
        fitted = language_id.fit(frame)
        tests = [(i, prose(lang, 60), lang) for i, lang in enumerate(list(VOCABULARY) * 5)]
        got = {r.doc_id: r for r in language_id.identify(spark.createDataFrame(tests, "doc_id long, text string, lang string"), fitted).collect()}
        assert all(got[i].lang_pred == lang for i, _, lang in tests)


def test_nothing_to_learn(spark):
    frame = spark.createDataFrame([(1, "", "aa"), (2, "  ", "zz"), (3, None, "aa"), (4, "text", None)], "doc_id long, text string, lang string")
    assert language_id.fit(frame) is None
    assert {r.lang_pred for r in language_id.identify(frame, None).collect()} == {"und"}
    assert language_id.fit(spark.createDataFrame([(1, "123 456", "aa")], "doc_id long, text string, lang string")) is None
    fitted = language_id.fit(spark.createDataFrame([(1, "some words", "aa"), (2, "99", "zz")], "doc_id long, text string, lang string"))
    assert {(r.doc_id, r.lang_pred) for r in language_id.identify(frame, fitted).collect()} == {(1, "und"), (2, "und"), (3, "und"), (4, "aa")}
    assert language_id.identify(frame.where(F.lit(False)), fitted).count() == 0
