"""Model calls that fail, hang and recover; prompts and answers."""

import sys
import threading
import time

import pytest
from pyspark import cloudpickle
from pyspark.sql import functions as F

from glyphgrid import engine
from glyphgrid.operators import calls, models
from glyphgrid.operators.calls import Caller, Final, Policy

cloudpickle.register_pickle_by_value(sys.modules[__name__])  # workers don't import tests
FAST = Policy(workers=4, timeout=0.4, tries=3, pause=0.01, longest=0.05)


class Stub:
    """Answers by the prompt: fails twice, always, for good, hangs, or tells its arguments."""

    def __init__(self):
        self.seen, self.lock, self.now, self.most = {}, threading.Lock(), 0, 0

    def __call__(self, image, prompt, max_tokens, temperature):
        with self.lock:
            n = self.seen[prompt] = self.seen.get(prompt, 0) + 1
            self.now += 1
            self.most = max(self.most, self.now)
        try:
            if prompt.startswith("flaky") and n < 3:
                raise ConnectionError("again")
            if prompt.startswith("dead"):
                raise ConnectionError("never")
            if prompt.startswith("refused"):
                raise Final("no such key")
            if prompt.startswith("hangs") or prompt.startswith("slow") and n == 1:
                time.sleep(3)
            time.sleep(0.01)
            return f"{prompt}|{len(image or b'')}|{max_tokens}|{temperature}"
        finally:
            with self.lock:
                self.now -= 1


def test_tries_and_limits():
    stub = Stub()
    caller = Caller(stub, FAST)
    asked = ["fine", "flaky", "dead", "refused", "hangs", "slow", "fine"]
    got = caller.answers([(b"xy", p, 9, 0.5) for p in asked])
    assert [g[0] for g in got] == ["fine|2|9|0.5", "flaky|2|9|0.5", None, None, None, "slow|2|9|0.5", "fine|2|9|0.5"]
    assert [g[1] for g in got] == [1, 3, 3, 1, 3, 2, 1]
    assert got[2][2] == "ConnectionError: never" and got[3][2] == "Final: no such key" and got[4][2].startswith("TimeoutError")
    assert stub.seen["refused"] == 1 and caller.hung == 4


def test_no_more_than_workers_at_once():
    stub = Stub()
    got = Caller(stub, FAST).answers([(None, f"p{i}", 1, 0.0) for i in range(40)])
    assert stub.most <= 4 and [g[0].split("|")[0] for g in got] == [f"p{i}" for i in range(40)]
    assert Caller(stub, FAST).answers([]) == []


def test_hung_calls_are_bounded():
    stub = Stub()
    caller = Caller(stub, Policy(workers=2, timeout=0.05, tries=1, hung=3))
    got = caller.answers([(None, f"hangs{i}", 1, 0.0) for i in range(12)])
    assert all(g[0] is None for g in got) and caller.hung <= 4 and sum("too many" in g[2] for g in got) >= 8


def test_rate():
    start = time.monotonic()
    Caller(Stub(), Policy(workers=8), gap=0.05).answers([(None, f"p{i}", 1, 0.0) for i in range(10)])
    assert time.monotonic() - start >= 0.45


@pytest.fixture(scope="module")
def segments(spark):
    rows = [(i, bytes(i), ["fine", "flaky", "dead", None][i % 4], "chart" if i % 2 else "image", None) for i in range(41)]
    return spark.createDataFrame(rows, "segment_id long, image binary, ocr string, segment_type string, response string").repartition(3)


def test_called(segments):
    asked = calls.requests(segments, F.concat_ws("", "ocr", F.lit(" "), "segment_id"), 7, 0.25, F.col("ocr").isNotNull())
    rows = {r.segment_id: r for r in calls.called(asked, Stub, FAST, batch=5).collect()}
    assert len(rows) == 41
    for i, r in rows.items():
        kind = i % 4
        assert r.tries == {0: 1, 1: 3, 2: 3, 3: 0}[kind]
        assert r.response == (f"{['fine', 'flaky'][kind]} {i}|{i}|7|0.25" if kind < 2 else None)
        assert r.error == ("ConnectionError: never" if kind == 2 else None)
    assert calls.called(asked.where("false"), Stub, FAST).count() == 0


def test_analyze(segments):
    def make():
        return lambda image, text: (_ for _ in ()).throw(ValueError("bad")) if text == "dead" else f'{{"n": {len(image)}}}'

    rows = {r.segment_id: r for r in models.analyze(segments, make, FAST).collect()}
    assert rows[2].error == "ValueError: bad" and rows[2].response_json is None and rows[4].response_json == '{"n": 4}' and rows[3].response_json


def test_requests_by_type(spark):
    rows = [(1, None, "text", "diagram", None, None, None, None), (2, b"x", None, "image", "cap", "2.1", "A > B", "graph TD"), (3, b"x", "", None, "", "", "", "")]
    frame = spark.createDataFrame(rows, "segment_id long, image binary, ocr string, segment_type string, caption string, figure_number string, heading_path string, mermaid string")
    prompts = lambda f: {r.segment_id: r.prompt for r in f.collect()}
    drawn, sums = prompts(calls.mermaid_requests(frame)), prompts(calls.calculation_requests(frame))
    assert drawn[1] and drawn[2] is None and drawn[3] is None and sums[1] is None and sums[2] and sums[3] is None
    asked = prompts(calls.summary_requests(frame))
    assert asked[2].endswith("Caption: cap\nFigure number: 2.1\nType: image\nSection: A > B\nMermaid:\n```mermaid\ngraph TD\n```") and asked[3].endswith("Nothing else is known.") and "Text in the picture: text" in asked[1]
    named = prompts(calls.classification_requests(frame))
    assert named[1].endswith("Text read in the picture:\ntext") and named[2] == named[3]


def legacy_model():
    def answer(image, prompt, max_tokens, temperature):
        if prompt.startswith("Name the class"):
            if image == b"lost":
                raise ConnectionError("down")
            return '```json\n{"category": "%s", "confidence": 0.99}\n```' % {b"c": "CHART", b"d": "DIAGRAM"}.get(image, "PHOTO")
        if prompt.startswith("Draw this"):
            return "```mermaid\ngraph TD; a-->b\n```"
        return "" if image == b"lost" else f"**Summary:** of {max_tokens} tokens, " + ("drawn" if "graph TD; a-->b" in prompt else "not drawn")

    return answer


def test_legacy_analysis(spark):
    rows = [(i, image, "text", "a caption", None, None, 1) for i, image in enumerate((b"c", b"d", b"x", b"lost", None))]
    frame = spark.createDataFrame(rows, "segment_id long, image binary, ocr string, caption string, figure_number string, heading_path string, summary int")
    got = {r.segment_id: (r.segment_type, r.confidence, r.method, r.mermaid, r.summary, r.summary_confidence) for r in engine.legacy_analysis(frame, legacy_model, FAST).collect()}
    assert got[0] == ("chart", 0.95, "vision_model", None, "of 500 tokens, not drawn", 0.85)
    assert got[1] == ("diagram", 0.95, "vision_model", "graph TD; a-->b", "of 500 tokens, drawn", 0.85)
    assert got[2][:3] == got[4][:3] == ("figure", 0.95, "vision_model")
    assert got[3] == ("figure", 0.3, "fallback_heuristic", None, "This figure. Caption: a caption", 0.5)
