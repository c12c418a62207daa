"""Calls to an injected model: a few at a time in each task, with time limits, retries and a shared rate.

Requests are rows (segment_id, image, prompt, ...); answers come back in the rows' order. A call that fails or
hangs is tried again after a growing pause; one that never succeeds is a row with its error, never a failed job.
A call that hangs is left behind in a thread that ends with its worker; no more than ``Policy.hung`` are left behind
in a task, after which its other requests fail at once.
"""

from __future__ import annotations

import queue
import random
import threading
import time
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from typing import Protocol

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


class Model(Protocol):
    """An injected model: image bytes, prompt, tokens at most and temperature in, text out; credentials are the caller's."""

    def __call__(self, image: bytes | None, prompt: str, max_tokens: int, temperature: float) -> str: ...


class Final(Exception):
    """Raised by a model where another try can't help: a refused key, a bad request."""


@dataclass(frozen=True)
class Policy:
    """How a task calls: ``workers`` at once, each try up to ``timeout`` seconds, ``tries`` in all.

    The pause before try n is ``pause`` * 2 ** (n - 1), up to ``longest``, half of it drawn, so that tasks don't
    try together. ``rate`` is calls a second over all tasks; each has an equal share of it.
    """

    workers: int = 4
    timeout: float = 45.0
    tries: int = 3
    pause: float = 0.5
    longest: float = 30.0
    rate: float | None = None
    hung: int = 16


class Pacer:
    """Lets one caller through every ``gap`` seconds."""

    def __init__(self, gap: float):
        self.gap, self.next, self.lock = gap, 0.0, threading.Lock()

    def wait(self) -> None:
        if not self.gap:
            return
        with self.lock:
            now = time.monotonic()
            turn = max(now, self.next)
            self.next = turn + self.gap
        time.sleep(max(0.0, turn - now))


class Caller:
    """Runs calls of one task under a policy."""

    def __init__(self, call: Callable[..., str], policy: Policy, gap: float = 0.0):
        self.call, self.policy, self.pacer = call, policy, Pacer(gap)
        self.hung = 0
        self.lock = threading.Lock()

    def _once(self, args: tuple) -> tuple[str | None, Exception | None]:
        box: list = [None, None]

        def run() -> None:
            try:
                box[0] = self.call(*args)
            except Exception as failure:  # noqa: BLE001  (any failure of the model is an answer)
                box[1] = failure

        if self.hung >= self.policy.hung:
            return None, Final("too many calls hang in this task")
        thread = threading.Thread(target=run, daemon=True)
        thread.start()
        thread.join(self.policy.timeout)
        if thread.is_alive():
            with self.lock:
                self.hung += 1
            return None, TimeoutError(f"no answer in {self.policy.timeout:g} s")
        return box[0], box[1]

    def answer(self, args: tuple) -> tuple[str | None, int, str | None]:
        """(text, tries, error) of one request."""
        failure: Exception | None = None
        for n in range(1, self.policy.tries + 1):
            self.pacer.wait()
            text, failure = self._once(args)
            if failure is None:
                return text, n, None
            if isinstance(failure, Final) or n == self.policy.tries:
                break
            pause = min(self.policy.longest, self.policy.pause * 2 ** (n - 1))
            time.sleep(pause * (0.5 + random.random() / 2))
        return None, n, f"{type(failure).__name__}: {failure}"

    def answers(self, requests: list[tuple]) -> list[tuple[str | None, int, str | None]]:
        """Answers in the order of the requests, ``workers`` at a time."""
        out: list = [None] * len(requests)
        todo: queue.SimpleQueue = queue.SimpleQueue()
        for place in range(len(requests)):
            todo.put(place)

        def work() -> None:
            while True:
                try:
                    place = todo.get_nowait()
                except queue.Empty:
                    return
                out[place] = self.answer(requests[place])

        threads = [threading.Thread(target=work, daemon=True) for _ in range(min(self.policy.workers, len(requests)))]
        for thread in threads:
            thread.start()
        for thread in threads:
            thread.join()
        return out


def called(requests: DataFrame, make: Callable[[], Model], policy: Policy = Policy(), batch: int = 64) -> DataFrame:
    """(segment_id, response, tries, error) of requests (segment_id, image, prompt, max_tokens, temperature).

    ``make`` is run once a task. Requests with a null prompt are not sent and have no response. A task holds
    ``batch`` requests at a time. With a rate, as many tasks as there are cores share it.
    """
    kind = requests.schema["segment_id"].dataType.simpleString()
    rows = requests.select("segment_id", "image", "prompt", F.col("max_tokens").cast("int").alias("max_tokens"), F.col("temperature").cast("double").alias("temperature"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = make()
        gap = cores / policy.rate if policy.rate else 0.0
        caller = Caller(model, policy, gap)
        for whole in batches:
            for low in range(0, whole.num_rows, batch):
                part = whole.slice(low, batch)
                asked = list(zip(*(part.column(k).to_pylist() for k in range(1, 5)), strict=True))
                sent = [k for k, row in enumerate(asked) if row[1] is not None]
                found = dict(zip(sent, caller.answers([asked[k] for k in sent]), strict=True))
                text, tries, error = zip(*(found.get(k, (None, 0, None)) for k in range(len(asked))), strict=True)
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(text, pa.string()), pa.array(tries, pa.int32()), pa.array(error, pa.string())], ["segment_id", "response", "tries", "error"])

    cores = requests.sparkSession.sparkContext.defaultParallelism
    return rows.mapInArrow(run, f"segment_id {kind}, response string, tries int, error string")


# ---- what is asked, by expressions ----
#: What a summary should cover, by type; wording of our own.
COVER = {
    "chart": "the kind of chart, what its axes and series stand for, the main trend, the range of values, and any outlier or crossing",
    "diagram": "what it explains, its parts, how they are connected, how it is organised, and the main insight",
    "flowchart": "the process it describes, its steps in order, its decisions with their branches, and where it can end",
    "image": "the subject, its labels, every definition, formula, variable and table that can be read, and what a reader should learn",
    "figure": "what it is made of, what each part shows, and the idea they serve together",
}
CLASSES = ["CHART", "FLOWCHART", "DIAGRAM", "IMAGE", "FIGURE"]


def classification_prompt(ocr: Column) -> Column:
    """A request to name one class, the most specific that fits; with the first 300 characters of the text read."""
    seen = F.when(F.coalesce(ocr, F.lit("")) != "", F.concat(F.lit("\nText read in the picture:\n"), F.substring(ocr, 1, 300))).otherwise("")
    ask = (
        "Name the class of this picture. Take the most specific one: CHART has axes or slices with data, FLOWCHART has steps and decisions in order, "
        "DIAGRAM has parts and links, IMAGE is a photograph, screenshot or scan, FIGURE is for mixed or unclear content only.\n"
        'Answer with JSON only: {"category": "' + "|".join(CLASSES) + '", "confidence": 0 to 1}'
    )
    return F.concat(F.lit(ask), seen)


def context_lines(caption: Column, number: Column, kind: Column, ocr: Column, headings: Column, mermaid: Column) -> Column:
    """What is known of a segment, a line each, in this order; a sentence where nothing is."""
    held = lambda value: F.coalesce(value, F.lit("")) != ""
    lines = [
        F.when(held(caption), F.concat(F.lit("Caption: "), caption)),
        F.when(held(number), F.concat(F.lit("Figure number: "), number)),
        F.when(held(kind), F.concat(F.lit("Type: "), kind)),
        F.when(held(ocr), F.concat(F.lit("Text in the picture: "), F.substring(ocr, 1, 400))),
        F.when(held(headings), F.concat(F.lit("Section: "), headings)),
        F.when(held(mermaid), F.concat(F.lit("Mermaid:\n```mermaid\n"), mermaid, F.lit("\n```"))),
    ]
    whole = F.concat_ws("\n", *lines)
    return F.when(whole == "", "Nothing else is known.").otherwise(whole)


def summary_prompt(kind: Column, context: Column) -> Column:
    """A request for a summary by type; segments of another type are described in general."""
    cover = F.coalesce(*[F.when(kind == name, text) for name, text in COVER.items()], F.lit("what can be seen, what it may stand for, and what a reader could learn"))
    name = F.when(kind.isin(list(COVER)), kind).otherwise("visual")
    return F.concat(F.lit("Summarise this "), name, F.lit(" for a student who can't see it, in three or four factual sentences: "), cover, F.lit(".\n"), context)


def requests(segments: DataFrame, prompt: Column, max_tokens: int, temperature: float, where: Column | None = None) -> DataFrame:
    """Rows for ``called``; segments that ``where`` leaves out have no prompt."""
    asked = prompt if where is None else F.when(where, prompt)
    return segments.select("segment_id", "image", asked.alias("prompt"), F.lit(max_tokens).alias("max_tokens"), F.lit(temperature).alias("temperature"))


#: Tokens at most and temperature of each step.
CLASSIFY, SUMMARISE, MERMAID, CALCULATE = (300, 0.1), (500, 0.3), (800, 0.2), (2000, 0.1)


def classification_requests(segments: DataFrame) -> DataFrame:
    return requests(segments, classification_prompt(F.col("ocr")), *CLASSIFY)


def mermaid_requests(segments: DataFrame) -> DataFrame:
    """Only diagrams and flowcharts are asked for."""
    ask = F.lit("Draw this as one Mermaid diagram in a fenced block, with the labels that can be read, and nothing else.")
    return requests(segments, ask, *MERMAID, F.col("segment_type").isin("diagram", "flowchart"))


def calculation_requests(segments: DataFrame) -> DataFrame:
    """Only images are asked for."""
    ask = F.concat(F.lit('List as JSON {"input_variables": [], "output_values": [], "formulas": [], "verification": {"verified": false, "matches": false, "differences": []}} what this picture calculates, and check the results.\n'), F.coalesce(F.substring("ocr", 1, 500), F.lit("")))
    return requests(segments, ask, *CALCULATE, F.col("segment_type") == "image")


def summary_requests(segments: DataFrame) -> DataFrame:
    context = context_lines(*[F.col(c) for c in ("caption", "figure_number", "segment_type", "ocr", "heading_path", "mermaid")])
    return requests(segments, summary_prompt(F.col("segment_type"), context), *SUMMARISE)


# ---- what was answered ----
def plain_json(response: Column) -> Column:
    """The JSON of a block fenced as such, else the response without fences."""
    fenced = F.regexp_extract(response, r"(?s)```json\s*(\{.*?\})\s*```", 1)
    bare = F.when(F.contains(response, F.lit("```")), F.trim(F.regexp_replace(response, r"```\w*\s*", ""))).otherwise(response)
    return F.when(fenced != "", fenced).otherwise(bare)


def classified(responses: DataFrame, method: str = "vision_model") -> DataFrame:
    """(segment_id, segment_type, confidence, method) of answers (segment_id, response); a figure of 0.3 where none can be read."""
    body = plain_json(F.col("response"))
    told = F.from_json(body, "category string, confidence string")
    rows = responses.select("segment_id", told.alias("t"), (F.get_json_object(body, "$") .isNotNull() & F.ltrim(body).startswith("{")).alias("read"))
    score = F.coalesce(F.col("t.confidence").try_cast("double"), F.when(F.col("t.confidence").isNull(), 0.7))
    good = F.coalesce(F.col("read"), F.lit(False)) & score.isNotNull()
    kind = F.when(F.upper("t.category").isin(CLASSES), F.lower("t.category")).otherwise("figure")
    return rows.select("segment_id", F.when(good, kind).otherwise("figure").alias("segment_type"), F.when(good, F.least(score, F.lit(0.95))).otherwise(0.3).alias("confidence"), F.when(good, method).otherwise("fallback_heuristic").alias("method"))


def summarised(response: Column, fallback: Column) -> Column:
    """Struct (text, confidence): the answer without bold headings, 0.85; else the fallback, 0.5."""
    text = F.trim(F.regexp_replace(response, r"\*\*.*?\*\*:?\s*", ""))
    told = F.coalesce(text, F.lit("")) != ""
    return F.struct(F.when(told, text).otherwise(fallback).alias("text"), F.when(told, 0.85).otherwise(0.5).alias("confidence"))
