"""Language identification by interpolated Kneser-Ney character models.

One model per language over letters inside words (a word's start and end are
marked by a space; other characters separate words). Probabilities of seen
n-grams, fully interpolated, stand in sorted hash arrays beside the back-off
weights of seen contexts, one column per language, so one search gives a letter's
probability under all languages. A text goes to the language of the lowest
cross-entropy per letter. Its score is a posterior whose temperature is fitted
on calibration rows; ``accepted`` is false where the cross-entropy lies beyond
what calibration rows of that language show.

Learning takes about ``train_rows`` + ``calibration_rows`` whole texts per language
at most, picked by a hash of id and text: a documented bound on a classifier's
labelled sample. Equal rows are drawn alike, so they count together as their words
do, but are calibrated on once. A language of ``FEW`` rows or fewer learns from all
of them, and any language from one at least; where no row is left to calibrate on,
everything plausible is accepted. Every text is scored whole.

Defined results: a null text, or one without a letter, is ``und`` with score 0;
ties go to the language first in code-point order; without any labelled row with a
word all texts are ``und``; repeated rows each get their own row; very long texts
are scored in slices of their own; an empty table gives no row; only the id, text
and lang columns are read, so other columns can't clash.
"""

from __future__ import annotations

import functools
import itertools
import unicodedata
import uuid

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import common

ORDER = 4
MEMO = 300_000
SAMPLE_RANGE = 1 << 20
#: Rows up to which a language keeps none back for calibration.
FEW = 50


@functools.lru_cache(maxsize=1)
def letter_table() -> np.ndarray:
    """Whether each code point is a letter."""
    return np.fromiter((unicodedata.category(chr(i))[0] == "L" for i in range(0x110000)), dtype=bool, count=0x110000)


def gram_keys(window: list[np.ndarray]) -> np.ndarray:
    """One hash for each n-gram; window[0] is its last character, window[1] the one before, and so on."""
    key = np.zeros(len(window[0]), dtype=np.uint64)
    for chars in window:
        key = common.mix64(key * np.uint64(0x100000001B3) + chars + np.uint64(1))
    return key


def windows(pieces: list[str]) -> tuple[list[np.ndarray], np.ndarray]:
    """The last ORDER characters at each letter or word end, and the piece each belongs to."""
    sizes = np.fromiter(map(len, pieces), dtype=np.int64, count=len(pieces))
    points = np.frombuffer(" ".join(pieces).lower().encode("utf-32-le"), dtype=np.uint32)
    if len(points) != sizes.sum() + max(len(pieces) - 1, 0):  # a character whose lower case is longer
        lowered = [p.lower() for p in pieces]
        sizes = np.fromiter(map(len, lowered), dtype=np.int64, count=len(pieces))
        points = np.frombuffer(" ".join(lowered).encode("utf-32-le"), dtype=np.uint32)
    owner = np.repeat(np.arange(len(pieces)), sizes + 1)[: len(points) + 1]
    letters = letter_table()[points]
    chars = np.concatenate([np.full(ORDER, 32), np.where(letters, points, 32), [32]]).astype(np.uint64)
    n = len(points) + 1
    window = [chars[ORDER - k : ORDER - k + n] for k in range(ORDER)]
    kept = (window[0] != 32) | (window[1] != 32)
    window = [w[kept] for w in window]
    for k in range(2, ORDER):  # nothing before a word's start counts
        window[k] = np.where(window[k - 1] == 32, np.uint64(32), window[k])
    return window, owner[kept]


class KneserNey:
    """Sorted hash arrays of all languages' models."""

    def __init__(self, counts: dict[str, dict[str, int]], order: int = ORDER):
        self.languages = sorted(counts)
        self.order = order
        self.token = uuid.uuid4().hex
        self.tables: list[tuple[np.ndarray, np.ndarray]] = []
        self.backoff: list[tuple[np.ndarray, np.ndarray]] = []
        tops = []
        for language in self.languages:
            words = list(counts[language])
            window, owner = windows(words)
            weight = np.fromiter(counts[language].values(), dtype=np.float64, count=len(words))[owner]
            tops.append((window, weight))
        self.alphabet = max(2, len({int(c) for window, _ in tops for c in np.unique(window[0])}))
        lower: np.ndarray | None = None
        for k in range(1, order + 1):
            self._add_order(k, tops, lower)
            lower = self.tables[-1][1]

    def _grams(self, k: int, window: list[np.ndarray], weight: np.ndarray):
        """Distinct k-grams of one language with contexts, suffixes and counts; below the top order, counts of distinct left extensions."""
        keys = gram_keys(window[:k])
        if k < self.order:
            _, first = np.unique(gram_keys(window[: k + 1]), return_index=True)
            keys, window, weight = keys[first], [w[first] for w in window], np.ones(len(first))
        unique, first, inverse = np.unique(keys, return_index=True, return_inverse=True)
        total = np.bincount(inverse, weights=weight)
        context = gram_keys([w[first] for w in window[1:k]]) if k > 1 else np.zeros(len(first), dtype=np.uint64)
        suffix = gram_keys([w[first] for w in window[: k - 1]]) if k > 1 else np.zeros(len(first), dtype=np.uint64)
        return unique, context, suffix, total

    def _add_order(self, k: int, tops, lower) -> None:
        grams = [self._grams(k, *top) for top in tops]
        keys, first = np.unique(np.concatenate([g[0] for g in grams]), return_index=True)
        context = np.concatenate([g[1] for g in grams])[first]
        suffix = np.concatenate([g[2] for g in grams])[first]
        contexts = np.unique(context)
        width = len(self.languages)
        probability = np.zeros((len(keys), width))
        weights = np.ones((len(contexts), width))
        for column, (own, own_context, _, total) in enumerate(grams):
            ones, twos = (total == 1).sum(), (total == 2).sum()
            discount = min(0.95, max(0.05, ones / (ones + 2 * twos))) if ones else 0.5
            at = np.searchsorted(contexts, own_context)
            sums = np.bincount(at, weights=total, minlength=len(contexts))
            kinds = np.bincount(at, minlength=len(contexts))
            seen = sums > 0
            weights[seen, column] = discount * kinds[seen] / sums[seen]
            probability[np.searchsorted(keys, own), column] = (total - discount) / sums[at]
        below = 1 / self.alphabet if lower is None else lower[np.searchsorted(self.tables[-1][0], suffix)]
        probability += weights[np.searchsorted(contexts, context)] * below
        self.tables.append((keys, probability))
        self.backoff.append((contexts, np.log(weights)))

    def freeze(self) -> None:
        """Logarithms instead of probabilities, once all orders are there."""
        self.tables = [(keys, np.log(p)) for keys, p in self.tables]

    def letter_scores(self, window: list[np.ndarray]) -> np.ndarray:
        """Log-probability of each position under each language."""
        n = len(window[0])
        out = np.zeros((n, len(self.languages)))
        left = np.arange(n)
        for k in range(self.order, 0, -1):
            if not len(left):
                return out
            keys, values = self.tables[k - 1]
            own = gram_keys([w[left] for w in window[:k]])
            at = np.minimum(np.searchsorted(keys, own), len(keys) - 1)
            hit = keys[at] == own
            out[left[hit]] += values[at[hit]]
            left = left[~hit]
            contexts, weights = self.backoff[k - 1]
            context = gram_keys([w[left] for w in window[1:k]]) if k > 1 else np.zeros(len(left), dtype=np.uint64)
            at = np.minimum(np.searchsorted(contexts, context), len(contexts) - 1)
            hit = contexts[at] == context
            out[left[hit]] += weights[at[hit]]
        out[left] -= np.log(self.alphabet)
        return out

    def piece_scores(self, pieces: list[str]) -> np.ndarray:
        """For each piece: log-probability under each language, then the letters and word ends counted."""
        window, owner = windows(pieces)
        scores = np.concatenate([self.letter_scores(window), np.ones((len(owner), 1))], axis=1)
        out = np.empty((len(pieces), scores.shape[1]))
        for column in range(scores.shape[1]):
            out[:, column] = np.bincount(owner, weights=scores[:, column], minlength=len(pieces))
        return out


class Scorer:
    """Scores of texts; those of distinct pieces stay in a bounded memo."""

    def __init__(self, model: KneserNey):
        self.model = model
        self._clear()

    def _clear(self) -> None:
        self.memo: dict[str, int] = {}
        self.rows = np.zeros((0, len(self.model.languages) + 1), dtype=np.float32)

    def texts(self, texts: pa.Array) -> np.ndarray:
        values, offsets = common.list_parts(pc.utf8_split_whitespace(texts))
        coded = values.dictionary_encode()
        pieces = coded.dictionary.to_pylist()
        if len(self.memo) > MEMO:
            self._clear()
        at = np.fromiter(map(self.memo.get, pieces, itertools.repeat(-1)), dtype=np.int64, count=len(pieces))
        missing = np.flatnonzero(at < 0)
        if len(missing):
            new = [pieces[i] for i in missing]
            at[missing] = len(self.rows) + np.arange(len(new))
            self.memo.update(zip(new, at[missing].tolist(), strict=True))
            self.rows = np.concatenate([self.rows, self.model.piece_scores(new).astype(np.float32)])
        codes = coded.indices.to_numpy(zero_copy_only=False)
        return common.segment_sums(self.rows[at][codes], offsets)


_scorers: dict[str, Scorer] = {}


def worker_scorer(broadcast) -> Scorer:
    """One scorer a worker and model, so that its memo outlives a task."""
    key = broadcast.value.token
    if key not in _scorers:
        _scorers.clear()
        _scorers[key] = Scorer(broadcast.value)
    return _scorers[key]


def fit(labelled: DataFrame, train_rows: int = 1000, calibration_rows: int = 300, id_column: str = "doc_id"):
    """(models, temperature, limits) from rows (id, text, lang); null texts and languages are left out."""
    spark = labelled.sparkSession
    rows = common.plain_names(labelled, id_column, "text", "lang").toDF("id", "text", "lang").where("lang is not null and text is not null")
    draw = F.pmod(F.xxhash64(F.col("id"), F.col("text"), F.lit("language")), F.lit(SAMPLE_RANGE))
    totals = {r.lang: r for r in rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n"), F.min(draw).alias("first")).collect()}  # a row for each language
    if not totals:
        return None

    def bound(count: int, part: float) -> Column:
        share: Column = F.lit(0)
        for language, total in totals.items():
            upto = SAMPLE_RANGE if total.n <= FEW else max(int(min(part, count / total.n) * SAMPLE_RANGE), total.first + 1)
            share = F.when(F.col("lang") == language, F.lit(upto)).otherwise(share)
        return share

    def words(batches):
        for batch in common.text_slices(batches):
            lists = pc.utf8_split_whitespace(common.column(batch, "text"))
            values, offsets = common.list_parts(lists)
            owner = np.repeat(np.arange(len(lists)), np.diff(offsets))
            table = pa.table({"lang": common.column(batch, "lang").take(pa.array(owner)), "word": values, "n": pa.array(np.ones(len(values), dtype=np.int64))})
            yield from table.group_by(["lang", "word"]).aggregate([("n", "sum")]).rename_columns(["lang", "word", "n"]).to_batches()

    train = rows.where(draw < bound(train_rows, 0.8)).select("lang", "text").mapInArrow(words, "lang string, word string, n long")
    counts: dict[str, dict[str, int]] = {}
    for r in train.groupBy("lang", "word").agg(F.sum("n").alias("n")).collect():  # words of the bounded sample
        if any(map(str.isalpha, r.word)):
            counts.setdefault(r.lang, {})[r.word] = r.n
    if not counts:
        return None
    model = KneserNey(counts)
    model.freeze()
    shared = spark.sparkContext.broadcast(model)
    check = rows.where((draw >= bound(train_rows, 0.8)) & (draw < bound(train_rows + calibration_rows, 1.0))).dropDuplicates()
    seen = [r for r in _scores(check, shared, ["lang"]).collect() if r.n > 0]  # bounded like the sample
    temperature, limits = _calibrate(model, seen)
    return shared, temperature, limits


def _calibrate(model: KneserNey, seen) -> tuple[float, np.ndarray]:
    """Temperature of the least log-loss, and the highest plausible cross-entropy of each language."""
    limits = np.full(len(model.languages), np.inf)
    seen = [r for r in seen if r.lang in model.languages]
    if not seen:
        return 1.0, limits
    entropy = np.array([r.entropy for r in seen])
    letters = np.array([r.n for r in seen])
    truth = np.array([model.languages.index(r.lang) for r in seen])
    losses = {t: -np.log(np.maximum(1e-12, posterior(entropy, letters, t)[np.arange(len(truth)), truth])).mean() for t in (0.25, 0.5, 1, 2, 4, 8, 16, 32, 64)}
    for k in range(len(limits)):
        own = entropy[truth == k, k]
        if len(own):
            limits[k] = np.quantile(own, 0.99) * 1.25
    return min(losses, key=losses.get), limits


def posterior(entropy: np.ndarray, letters: np.ndarray, temperature: float) -> np.ndarray:
    """Language posteriors from cross-entropies; evidence stops growing after 200 letters."""
    evidence = -entropy * np.minimum(letters, 200)[:, None] / temperature
    evidence -= evidence.max(axis=1, keepdims=True)
    weight = np.exp(evidence)
    return weight / weight.sum(axis=1, keepdims=True)


def _scores(rows: DataFrame, shared, keep: list[str]) -> DataFrame:
    def scored(batches):
        scorer = worker_scorer(shared)
        for batch in common.text_slices(batches):
            sums = scorer.texts(pc.fill_null(common.column(batch, "text"), ""))
            n = sums[:, -1]
            entropy = -sums[:, :-1] / np.maximum(n, 1)[:, None]
            yield pa.RecordBatch.from_arrays([*(common.column(batch, k) for k in keep), pa.array(entropy.tolist(), pa.list_(pa.float64())), pa.array(n)], [*keep, "entropy", "n"])

    fields = ", ".join(f"{k} {rows.schema[k].dataType.simpleString()}" for k in keep)
    return rows.select(*keep, "text").mapInArrow(scored, f"{fields}, entropy array<double>, n double")


def identify(documents: DataFrame, fitted, id_column: str = "doc_id") -> DataFrame:
    """(id, lang_pred, score, accepted) of every whole text."""
    rows = common.plain_names(documents, id_column, "text").toDF("id", "text")
    if fitted is None:
        return rows.select(F.col("id").alias(id_column), F.lit("und").alias("lang_pred"), F.lit(0.0).alias("score"), F.lit(False).alias("accepted"))
    shared, temperature, limits = fitted

    def predicted(batches):
        scorer = worker_scorer(shared)
        names = np.array([*scorer.model.languages, "und"])
        for batch in common.text_slices(batches):
            sums = scorer.texts(pc.fill_null(common.column(batch, "text"), ""))
            n = sums[:, -1]
            entropy = -sums[:, :-1] / np.maximum(n, 1)[:, None]
            best = entropy.argmin(axis=1)
            own = np.arange(len(best))
            score = np.where(n > 0, posterior(entropy, n, temperature)[own, best], 0.0)
            accepted = (n > 0) & (entropy[own, best] <= limits[best])
            label = names[np.where(n > 0, best, len(names) - 1)]
            yield pa.RecordBatch.from_arrays([common.column(batch, "id"), pa.array(label.tolist(), pa.string()), pa.array(score), pa.array(accepted)], ["id", "lang_pred", "score", "accepted"])

    kind = rows.schema["id"].dataType.simpleString()
    return rows.mapInArrow(predicted, f"id {kind}, lang_pred string, score double, accepted boolean").withColumnRenamed("id", id_column)
