"""Token counts: batch encoding inside Arrow functions, returning lengths only.

Texts go to the library in batches balanced by bytes. A text of more than ``LONG``
characters is split first, before single spaces that stand between two ASCII
letters or digits: such a space starts a new pre-token under every pre-tokenizer
that ``splits_at_spaces`` accepts, read from the tokenizer's own file, so the parts'
lengths add up to the whole text's. Other files, and long texts without such a
space, are encoded whole. Ids never leave the library.

Defined results: null counts as empty text (0 bytes, 0 tokens); repeated rows
each get their own row; an empty table gives an empty result; columns other
than the two used are ignored.
"""

from __future__ import annotations

import json
import os
import re

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from . import common
from .rank_bpe import vocabulary_path

#: Characters of a part, and bytes of a batch.
LONG, BATCH_BYTES = 1 << 16, 1 << 20
BOUNDARY = re.compile("(?<=[A-Za-z0-9]) (?=[A-Za-z0-9])")


def _first_step(spec: dict) -> dict:
    first = spec.get("pre_tokenizer") or {}
    while first.get("type") == "Sequence":
        first = first["pretokenizers"][0]
    return first


def drops_spaces(spec: dict) -> bool:
    """Whether a ``tokenizers`` file splits at all white space and drops it, so that words can be encoded one by one."""
    first = _first_step(spec)
    words_only = first.get("type") == "Split" and first.get("behavior") == "Removed" and first.get("invert") and " " not in (first.get("pattern") or {}).get("Regex", " ")
    return bool(words_only or first.get("type") in ("Whitespace", "WhitespaceSplit", "BertPreTokenizer"))


def splits_at_spaces(spec: dict) -> bool:
    """Whether a ``tokenizers`` file never joins a token over a space between letters, by its first pre-tokenizer."""
    first = _first_step(spec)
    by_pattern = first.get("type") == "ByteLevel" and first.get("use_regex", True) and not first.get("add_prefix_space", True)
    return all(" " not in t["content"] for t in spec.get("added_tokens", [])) and (bool(by_pattern) or drops_spaces(spec))


def parts_of(text: str) -> list[str]:
    """Parts of about LONG characters, cut at safe boundaries."""
    out, start = [], 0
    while len(text) - start > LONG:
        found = BOUNDARY.search(text, start + LONG)
        if found is None:
            break
        out.append(text[start : found.start()])
        start = found.start()
    return [*out, text[start:]]


class BatchCounter:
    """Lengths of texts by a ``tokenizers`` .json or a ``sentencepiece`` .model file."""

    def __init__(self, name: str):
        path = vocabulary_path(name)
        if path.endswith(".model"):
            import sentencepiece

            model = sentencepiece.SentencePieceProcessor(model_file=path)
            self.splits = False
            self.lengths = lambda texts: [len(ids) for ids in model.encode(texts, add_bos=False, add_eos=False, num_threads=1)]
        else:
            from tokenizers import Tokenizer

            os.environ["TOKENIZERS_PARALLELISM"] = "false"
            tokenizer = Tokenizer.from_file(path)
            tokenizer.no_truncation()
            tokenizer.no_padding()
            with open(path, encoding="utf-8") as file:
                self.splits = splits_at_spaces(json.load(file))
            self.lengths = lambda texts: list(map(len, tokenizer.encode_batch_fast(texts, add_special_tokens=False)))

    def count(self, texts: pa.Array) -> np.ndarray:
        """Tokens of each text."""
        out = np.zeros(len(texts), dtype=np.int64)
        owners: list[int] = []
        batch: list[str] = []
        size = 0

        def flush() -> None:
            np.add.at(out, owners, self.lengths(batch))

        for i, text in enumerate(texts.to_pylist()):
            for part in parts_of(text) if self.splits and len(text) > LONG else [text]:
                owners.append(i)
                batch.append(part)
                size += len(part) if part.isascii() else len(part.encode())
                if size >= BATCH_BYTES:
                    flush()
                    owners, batch, size = [], [], 0
        if batch:
            flush()
        return out


def worker_counter(name: str) -> BatchCounter:
    """One counter a worker: files are read once."""
    return common.held(BatchCounter, name)


def token_counts(documents: DataFrame, tokenizer: str = "byte_bpe_50k.json", limit: int = 1024, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(id, n_bytes, n_tokens, over_limit) of every whole text; a narrow plan with no exchange."""

    def counted(batches):
        counter = worker_counter(tokenizer)
        for batch in common.text_slices(batches, "text"):
            texts = pc.fill_null(common.column(batch, "text"), "")
            tokens = counter.count(texts)
            yield pa.RecordBatch.from_arrays([common.column(batch, "id"), pc.binary_length(texts).cast(pa.int64()), pa.array(tokens), pa.array(tokens > limit)], ["id", "n_bytes", "n_tokens", "over_limit"])

    kind = documents.schema[id_column].dataType.simpleString()
    rows = common.plain_names(documents, id_column, text_column).toDF("id", "text")
    return rows.mapInArrow(counted, f"id {kind}, n_bytes long, n_tokens long, over_limit boolean").withColumnRenamed("id", id_column)
