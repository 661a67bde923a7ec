"""Operator 3: token counts by a whole-token shortcut.

The vocabulary is read offline: no piece holds a word mark after another character, so merging
never crosses a word's first mark and a text may be cut there (``WordCounter`` checks this and
counts whole texts where it doesn't hold).  Every vocabulary string that starts with the mark is
encoded once; those that come back as exactly one token are proven and counted as 1 without
merging.  All other pre-tokens are merged by the library, each distinct one once per task.

Defined results: a null or empty text has 0 bytes and 0 tokens; special strings inside a text
are ordinary text; every input row gives one result row, repeated or with a null id alike.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from .common import runs, table, utf8

MARK = "▁"
LIMIT = 4096
# merged pre-tokens are remembered up to this many, and up to this length each
REMEMBERED, REMEMBERED_CHARS = 400_000, 48


def model_path(name: str = "piece_bpe_32k.model") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


class WordCounter(dict):
    """Pre-token (without its first mark) -> number of tokens."""

    def __init__(self, path: str):
        import sentencepiece

        super().__init__()
        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        model = self.model
        pieces = [(i, model.id_to_piece(i)) for i in range(model.vocab_size())
                  if not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i) or model.is_unused(i))]
        self.cuttable = not any(MARK in p.lstrip(MARK) for _, p in pieces)
        whole = [(i, p[1:]) for i, p in pieces if p.startswith(MARK) and MARK not in p[1:] and len(p) > 1]
        encoded = model.encode([w for _, w in whole], num_threads=1)
        self.proven = {w: 1 for (i, w), ids in zip(whole, encoded, strict=True) if ids == [i]}
        self.update(self.proven)

    def __missing__(self, word: str) -> int:
        n = len(self.model.encode(word, num_threads=1)) if word else 0
        if len(word) <= REMEMBERED_CHARS:
            if len(self) >= REMEMBERED + len(self.proven):
                self.clear()
                self.update(self.proven)
            self[word] = n
        return n

    _marks = re.compile(" {2,}|^ | $")
    _pretoken = re.compile("(?: |^)( *[^ ]*)")

    def count(self, text: str | None) -> int:
        if not text:
            return 0
        if not self.cuttable:
            return len(self.model.encode(text, num_threads=1))
        text = text.replace(MARK, " ")
        if self._marks.search(text) is None:
            return sum(map(self.__getitem__, text.split(" ")))
        # a run of spaces belongs to the word behind it: its first space is that word's mark
        words = re.findall(" +[^ ]*", " " + text)
        return sum(self[w[1:]] if len(w) > 1 else self._lone() for w in words)

    def _lone(self) -> int:
        return 1 if MARK in self._vocabulary() else len(MARK.encode())

    def _vocabulary(self) -> set[str]:
        if not hasattr(self, "_all"):
            self._all = {self.model.id_to_piece(i) for i in range(self.model.vocab_size())}
        return self._all


def token_counts(docs: DataFrame, model: str | None = None, limit: int = LIMIT) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit for every row of ``docs`` (doc_id, text)."""
    path = model or model_path()

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = None
        for run in runs(batches):
            counter = counter or WordCounter(path)
            tokens = np.array([counter.count(t) for t in run.column("text").to_pylist()], np.int64)
            yield pa.RecordBatch.from_arrays(
                [run.column("doc_id"), pa.array(np.diff(utf8(run.column("text"))[1])), pa.array(tokens), pa.array(tokens > limit)],
                names=["doc_id", "n_bytes", "n_tokens", "over_limit"])

    return docs.select("doc_id", "text").mapInArrow(count, "doc_id long, n_bytes long, n_tokens long, over_limit boolean")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts(table(spark, sf_dir, "documents"))
