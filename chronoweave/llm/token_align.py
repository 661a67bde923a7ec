"""Operator 13: token alignment of two tokenizers, by windows between whitespace anchors.

Each text is tokenised whole by both tokenizers: A encodes space + text (byte-level BPE; the file's
vocabulary and merge order run in the faster of the two libraries, tests hold its ids against the
other), B encodes the text and adds the space itself.  Every token stands for bytes, so both token lists are lists of
byte ranges over space + text.  An anchor is a byte offset before a space-marked token of A and
before a space-marked token of B, verified by both lists having an end there; the text's end is one
too.  Anchors split a document into windows, a window is aligned by walking the ends of its two id
tuples, and the alignment is remembered by those tuples, so words that come again cost one look-up.

An alignment is a list of groups, cut wherever an A and a B token end together, and of links, the
pairs of tokens that end there.  A linked pair's one string ends the other's, so the number of
different pairs is bounded by the two vocabularies (``pair_bound``, some 10^5): the table of counts
over the whole corpus is combined in the tasks, checked against that bound and broadcast.

Defined results: a text that is null or empty, or whose tokens' joined bytes are not space + text
(a text that holds the mark U+2581 is one), has no tokens: all numbers 0, groups ''.  Special
strings inside a text are plain text.  Every input row gives one result row, repeated, with a null
id or with further columns of any name alike; every row's links count.
"""

from __future__ import annotations

import json
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chronoweave.session import materialized

from .common import packed, runs, schema_of, table
from .token_counts import MARK, model_path

# windows remembered per worker; a window's ids and its alignment take some 0.3 KB
REMEMBERED = 100_000
# text bytes tokenised together; a run's arrays take some hundred times as much
TOKEN_RUN = 512 << 10
# added to B's ids in a window's key; A's are below it
SET_APART = 1 << 24
# fixed: the byte-level vocabulary's cut of a text into words
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


def _byte_symbols() -> dict[str, int]:
    """The printable characters that byte-level vocabularies write bytes as: a printable byte is
    itself, the others are numbered from 256 on."""
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in set(printable)]
    return {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(others)}


def byte_level_ranks(path: str) -> dict[bytes, int]:
    """Token bytes -> id of a byte-level vocabulary, without its added tokens.  Ids are in the order
    of merges, so they are the ranks by which pairs merge."""
    with open(path, encoding="utf-8") as f:
        model = json.load(f)
    symbol, added = _byte_symbols(), {t["content"] for t in model.get("added_tokens", [])}
    return {bytes(symbol[c] for c in t): i for t, i in model["model"]["vocab"].items() if t not in added}


def byte_level_tokens(path: str) -> list[bytes]:
    """The bytes of each id."""
    out = {i: t for t, i in byte_level_ranks(path).items()}
    return [out.get(i, b"") for i in range(max(out) + 1)]


def piece_tokens(path: str) -> list[bytes]:
    """The bytes of each id of a piece model."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    return [bytes([int(model.id_to_piece(i)[3:5], 16)]) if model.is_byte(i) else model.id_to_piece(i).replace(MARK, " ").encode()
            for i in range(model.vocab_size())]


def pair_bound(a: list[bytes], b: list[bytes]) -> int:
    """How many (A id, B id) can end together at all: the shorter string ends the longer one."""
    of_a, of_b = Counter(a), Counter(b)
    longer_a = sum(n * of_b.get(t[i:], 0) for t, n in of_a.items() for i in range(len(t)))
    longer_b = sum(n * of_a.get(t[i:], 0) for t, n in of_b.items() for i in range(1, len(t)))
    return longer_a + longer_b


@dataclass
class Aligned:
    """Of each text of a run: numbers of tokens, the groups as one text, the links' codes."""

    n_a: np.ndarray
    n_b: np.ndarray
    groups: np.ndarray  # bytes of all texts' groups
    groups_at: np.ndarray
    links: np.ndarray
    links_at: np.ndarray

    def text(self) -> pa.Array:
        return pa.Array.from_buffers(pa.large_string(), len(self.groups_at) - 1, [None, pa.py_buffer(self.groups_at.tobytes()), pa.py_buffer(self.groups.tobytes())]).cast(pa.string())


def _spread(start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """start[0], start[0] + 1, ... for size[0] numbers, then start[1], ..."""
    before = np.cumsum(size) - size
    return np.arange(int(size.sum())) + np.repeat(start - before, size)


def _starts(size: np.ndarray) -> np.ndarray:
    out = np.zeros(len(size) + 1, np.int64)
    np.cumsum(size, out=out[1:])
    return out


def _decimal(n: int) -> tuple[np.ndarray, np.ndarray]:
    """(digits, their number) of the numbers below ``n``."""
    say = [str(i).encode() for i in range(n)]
    size = np.array([len(x) for x in say])
    return np.array([list(x.ljust(size.max(), b"0")) for x in say], np.uint8), size


class Aligner:
    def __init__(self, path_a: str, path_b: str):
        import sentencepiece
        import tiktoken

        self.b = sentencepiece.SentencePieceProcessor(model_file=path_b)
        self.bytes_a, self.bytes_b = byte_level_tokens(path_a), piece_tokens(path_b)
        # no added token: their strings in a text are plain text, so they are no ranks
        self.a = tiktoken.Encoding("a", pat_str=PATTERN, mergeable_ranks=byte_level_ranks(path_a), special_tokens={})
        self.size_a, self.size_b = (np.array([len(t) for t in x], np.int64) for x in (self.bytes_a, self.bytes_b))
        self.spaced_a, self.spaced_b = (np.array([t[:1] == b" " for t in x]) for x in (self.bytes_a, self.bytes_b))
        self.digits, self.n_digits = _decimal(max(len(self.bytes_a), len(self.bytes_b)))
        self._forget()

    def _forget(self) -> None:
        # a window's key -> its number; its groups and links by number
        self.window: dict[bytes, int] = {}
        self.text, self.text_at = np.empty(0, np.uint8), np.zeros(1, np.int64)
        self.pairs, self.pairs_at = np.empty(0, np.int32), np.zeros(1, np.int64)

    def code(self, a, b):
        """One number for a pair of ids."""
        return a * len(self.bytes_b) + b

    def _align(self, a: np.ndarray, n_a: np.ndarray, b: np.ndarray, n_b: np.ndarray) -> None:
        """Remember the alignments of new windows: their tokens one after the other, and how many
        each has.  Both lists of a window have the same bytes, so ends may be matched in one go."""
        end_a, end_b = np.cumsum(self.size_a[a]), np.cumsum(self.size_b[b])
        at = np.searchsorted(end_b, end_a)
        last_a = np.flatnonzero(end_b[at] == end_a)
        last_b = at[last_a]
        stop_a, stop_b = last_a + 1, last_b + 1
        own_a, own_b = np.diff(stop_a, prepend=0), np.diff(stop_b, prepend=0)  # tokens of each group
        order_a = np.arange(len(a)) + np.repeat(stop_b - own_b, own_a)
        order_b = np.arange(len(b)) + np.repeat(stop_a, own_b)
        token, mark = np.empty(len(a) + len(b), np.int64), np.full(len(a) + len(b), ord(","), np.uint8)
        token[order_a], token[order_b] = a, b
        mark[order_a[last_a]], mark[order_b[last_b]] = ord("|"), ord(";")
        size = self.n_digits[token] + 1
        where = _starts(size)
        text = np.empty(where[-1], np.uint8)
        for d in range(self.digits.shape[1]):
            some = size > d + 1
            text[where[:-1][some] + d] = self.digits[token[some], d]
        text[where[1:] - 1] = mark
        ends = np.cumsum(n_a)
        self.text_at = np.concatenate([self.text_at, self.text_at[-1] + where[ends + np.cumsum(n_b)]])
        self.text = np.concatenate([self.text, text])
        self.pairs_at = np.concatenate([self.pairs_at, self.pairs_at[-1] + np.searchsorted(stop_a, ends, side="right")])
        self.pairs = np.concatenate([self.pairs, self.code(a[last_a].astype(np.int64), b[last_b]).astype(np.int32)])

    def _tokens(self, texts: list[str]) -> tuple[list[np.ndarray], list[list[int]]]:
        """Ids of both tokenizers; empty where their bytes are not the text's."""
        none = np.empty(0, np.uint32)
        out_a: list[np.ndarray] = [none] * len(texts)
        out_b: list[list[int]] = [[]] * len(texts)
        full = [i for i, t in enumerate(texts) if t]
        for i, b in zip(full, self.b.encode([texts[i] for i in full], num_threads=1) if full else [], strict=True):
            spaced = " " + texts[i]
            a = self.a.encode_to_numpy(spaced, disallowed_special=())
            wanted = spaced.encode()  # A's tokens are cut from these very bytes
            if b"".join(map(self.bytes_b.__getitem__, b)) == wanted and self.size_a[a].sum() == len(wanted):
                out_a[i], out_b[i] = a, b
        return out_a, out_b

    def of(self, texts: list[str]) -> Aligned:
        if len(self.window) > REMEMBERED:
            self._forget()
        ids_a, ids_b = self._tokens(texts)
        n_a, n_b = np.array([len(x) for x in ids_a], np.int64), np.array([len(x) for x in ids_b], np.int64)
        a = np.concatenate([*ids_a, np.empty(0, np.uint32)]).astype("<i4")
        b = np.array(list(chain.from_iterable(ids_b)), "<i4")
        end_a, end_b = np.cumsum(self.size_a[a]), np.cumsum(self.size_b[b])
        # ends before a space-marked token, and those of texts, in either list; anchors are ends in both
        last_a, last_b = np.cumsum(n_a)[n_a > 0] - 1, np.cumsum(n_b)[n_b > 0] - 1
        before_a, before_b = np.zeros(len(a), bool), np.zeros(len(b), bool)
        before_a[:-1], before_b[:-1] = self.spaced_a[a[1:]], self.spaced_b[b[1:]]
        before_a[last_a] = before_b[last_b] = True
        in_a, in_b = np.flatnonzero(before_a), np.flatnonzero(before_b)
        at = np.searchsorted(end_b[in_b], end_a[in_a])
        shared = np.zeros(len(in_a), bool)
        inside = at < len(in_b)
        shared[inside] = end_b[in_b[at[inside]]] == end_a[in_a[inside]]
        begin_a = np.concatenate([[0], in_a[shared] + 1])
        begin_b = np.concatenate([[0], in_b[at[shared]] + 1])
        # one list of windows' ids, A's then B's (B's set apart), so that a slice is a window's key
        both = np.empty(len(a) + len(b), "<i4")
        both[np.arange(len(a)) + np.repeat(begin_b[:-1], np.diff(begin_a))] = a
        both[np.arange(len(b)) + np.repeat(begin_a[1:], np.diff(begin_b))] = b + SET_APART
        data, to = both.tobytes(), (4 * (begin_a + begin_b)).tolist()
        keys = [data[i:j] for i, j in zip(to, to[1:], strict=False)]
        number = [*map(self.window.get, keys)]
        new: dict[bytes, int] = {}
        for k, w in enumerate(number):
            if w is None:
                new.setdefault(keys[k], k)
        if new:
            k = np.array([*new.values()])
            size_a, size_b = begin_a[k + 1] - begin_a[k], begin_b[k + 1] - begin_b[k]
            first = len(self.text_at) - 1
            self._align(a[_spread(begin_a[k], size_a)], size_a, b[_spread(begin_b[k], size_b)], size_b)
            self.window.update(zip(new, range(first, first + len(new)), strict=True))
            number = [*map(self.window.__getitem__, keys)]
        w = np.array(number, np.int64)
        stop = np.searchsorted(begin_a[1:], np.cumsum(n_a), side="right")  # windows up to each text's end
        links_at = np.concatenate([[0], np.cumsum(self.pairs_at[w + 1] - self.pairs_at[w])])[np.concatenate([[0], stop])]
        links = self.pairs[_spread(self.pairs_at[w], self.pairs_at[w + 1] - self.pairs_at[w])]
        size = self.text_at[w + 1] - self.text_at[w]
        size[stop[n_a > 0] - 1] -= 1  # no mark behind a text's last group
        groups = self.text[_spread(self.text_at[w], size)]
        return Aligned(n_a, n_b, groups, _starts(size)[np.concatenate([[0], stop])], links, links_at)


@lru_cache(maxsize=2)
def _aligner(path_a: str, path_b: str) -> Aligner:
    """One for all tasks of a worker."""
    return Aligner(path_a, path_b)


def alignments(docs: DataFrame, path_a: str | None = None, path_b: str | None = None) -> DataFrame:
    """(row, n_a, n_b, n_groups, groups, links) of every row of ``docs``: groups as text
    ``a1,a2|b1;a3|b2,b3``, links as codes ``a * size of B + b``; row holds the other columns."""
    path_a, path_b = path_a or model_path("byte_bpe_50k.json"), path_b or model_path()

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for run in runs(batches, limit=TOKEN_RUN):
            got = _aligner(path_a, path_b).of(run.column("text").fill_null("").to_pylist())
            yield pa.RecordBatch.from_arrays(
                [run.column("row"), pa.array(got.n_a), pa.array(got.n_b), pa.array(np.diff(got.links_at)), got.text(),
                 pa.ListArray.from_arrays(pa.array(got.links_at.astype(np.int32)), pa.array(got.links))],
                names=["row", "n_a", "n_b", "n_groups", "groups", "links"])

    return docs.select(packed(docs), "text").mapInArrow(
        work, schema_of(docs, "n_a long, n_b long, n_groups long, groups string, links array<int>"))


def pair_counts(linked: DataFrame) -> DataFrame:
    """(pair, n) over all rows of ``linked`` (links): counted in each task, then summed."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair, n = np.empty(0, np.int32), np.empty(0, np.int64)
        for batch in batches:
            own, times = np.unique(np.asarray(batch.column("links").flatten()), return_counts=True)
            pair, where = np.unique(np.concatenate([pair, own]), return_inverse=True)
            n = np.bincount(where, weights=np.concatenate([n, times]), minlength=len(pair)).astype(np.int64)
        if len(pair):
            yield pa.RecordBatch.from_arrays([pa.array(pair, pa.int32()), pa.array(n)], names=["pair", "n"])

    return linked.select("links").mapInArrow(count, "pair int, n long").groupBy("pair").agg(F.sum("n").alias("n"))


@dataclass
class PairTable:
    pair: np.ndarray
    n: np.ndarray
    best: np.ndarray

    @staticmethod
    def of(counts: DataFrame, bound: int, size_b: int) -> PairTable:
        """The corpus's table in memory, once its size is within what the vocabularies allow."""
        rows = counts.toArrow()
        if rows.num_rows > bound:
            raise ValueError(f"{rows.num_rows} pairs of ids, where the vocabularies allow {bound}")
        pair, n = rows.column("pair").to_numpy(), rows.column("n").to_numpy()
        order = np.argsort(pair)
        pair, n = pair[order], n[order]
        highest = np.zeros(size_b, np.int64)
        np.maximum.at(highest, pair % size_b, n)
        return PairTable(pair, n, n == highest[pair % size_b])


def scored(linked: DataFrame, pairs: PairTable) -> DataFrame:
    """``linked`` without its links, with n_best and count_sum of each row."""
    shared = linked.sparkSession.sparkContext.broadcast(pairs)  # bounded by ``PairTable.of``
    kept = [c for c in linked.columns if c != "links"]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t = shared.value
        for batch in batches:
            links = batch.column("links")
            at = np.searchsorted(t.pair, np.asarray(links.flatten()))
            ends = np.concatenate([[0], np.cumsum(pc.list_value_length(links).to_numpy(zero_copy_only=False))]).astype(np.int64)
            total, best = np.zeros(len(at) + 1, np.int64), np.zeros(len(at) + 1, np.int64)
            np.cumsum(t.n[at], out=total[1:])
            np.cumsum(t.best[at], out=best[1:])
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in kept), pa.array(best[ends[1:]] - best[ends[:-1]]), pa.array(total[ends[1:]] - total[ends[:-1]])],
                names=[*kept, "n_best", "count_sum"])

    schema = linked.select(*kept).schema.add("n_best", "long").add("count_sum", "long")
    return linked.mapInArrow(work, schema)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    path_a, path_b = model_path("byte_bpe_50k.json"), model_path()
    aligned = alignments(table(spark, sf_dir, "documents").select("doc_id", "text"), path_a, path_b)
    sha = F.when(F.col("n_a") > 0, F.sha2(F.col("groups").cast("binary"), 256)).otherwise("")
    linked = materialized(aligned.select("row.doc_id", "n_a", "n_b", "n_groups", F.size("links").cast("long").alias("n_links"),
                                         sha.alias("groups_sha256"), "links"), "links")
    bytes_b = piece_tokens(path_b)
    pairs = PairTable.of(pair_counts(linked), pair_bound(byte_level_tokens(path_a), bytes_b), len(bytes_b))
    return scored(linked, pairs)
