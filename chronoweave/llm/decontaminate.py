"""Operator 10: benchmark decontamination with an FM-index per training shard.

A shard is a run of whole documents (about 4 MB).  Words of benchmark windows become symbols;
document words outside that vocabulary can't be part of an occurrence, so a shard's indexed text
is its maximal runs of vocabulary words that are as long as the shortest window (an exact filter,
nothing that could match is left out).  Over that text stand a suffix array, its
Burrows-Wheeler transform in a wavelet matrix, and sampled suffix positions.  All windows are
searched backward at once by wavelet ranks, their occurrences located by walking to the sampled
positions, and the hit words merged into removal spans.

A window: 10 consecutive words of an item; an item of 1 to 9 words is one window; an item without
words has none.  Items are dealt to blocks of bounded size in a written table, items longer than a
block in pieces that share nine words, so that each window is whole in one; there is one pass over
the documents per block, and what is broadcast has a bound.

Defined results: null and empty texts have no words and no hits; a null item text has no window;
a null item_id is written as ``null``; repeated items count once by id; every document row
gives one result row.  Without benchmark rows nothing is hit.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from chronoweave.session import materialized

from .common import cut, packed, prefix_hash, range_hash, runs, schema_of, table, unpacked, utf8, word_spans

WINDOW = 10
# benchmark text bytes searched for in one pass over the documents
BLOCK_BYTES = 8 << 20
# every how many text positions a suffix position is kept
SAMPLE = 8

_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[65:91] += 32
_IS_WORD = np.zeros(256, bool)
_IS_WORD[48:58] = _IS_WORD[97:123] = _IS_WORD[128:] = True


def hashed_words(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Words of each row: (hash, row, start byte in the row, end byte in the row)."""
    data, offsets = utf8(column)
    data = _FOLD[data]
    start, end, row = word_spans(_IS_WORD[data], offsets)
    return range_hash(prefix_hash(data), start, end, data), row, start - offsets[row], end - offsets[row]


@dataclass
class Windows:
    """Distinct windows of one length, as rows of symbols, and the items that hold each."""

    symbols: np.ndarray
    first_owner: np.ndarray  # by window, into owners; one more at the end
    owners: np.ndarray  # item numbers

    def owners_of(self, window: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(position in ``window``, item number) of every owner of every window asked for."""
        count = self.first_owner[window + 1] - self.first_owner[window]
        at = np.repeat(self.first_owner[window] - (np.cumsum(count) - count), count) + np.arange(int(count.sum()))
        return np.repeat(np.arange(len(window)), count), self.owners[at]


@dataclass
class Patterns:
    """The windows of a block of items, as symbols of the alphabet of their words."""

    vocabulary: np.ndarray  # sorted word hashes; symbol = position + 1
    windows: list[Windows]  # by length
    items: list[str]
    shortest: int

    @staticmethod
    def of(rows: list[tuple[str, str | None]], window: int = WINDOW) -> Patterns:
        hashes, row, _, _ = hashed_words(pa.array([t for _, t in rows], pa.string()))
        vocabulary = np.unique(hashes)
        symbol = (np.searchsorted(vocabulary, hashes) + 1).astype(np.int32)
        first = np.searchsorted(row, np.arange(len(rows) + 1))
        size = np.diff(first)
        found = []
        for length in np.unique(np.minimum(size, window)).tolist():
            if not length:
                continue
            # the windows of the items that have windows of this length
            item = np.flatnonzero(size >= window if length == window else size == length)
            count = size[item] - length + 1
            begin = np.repeat(first[item] - (np.cumsum(count) - count), count) + np.arange(int(count.sum()))
            owner = np.repeat(item, count)
            symbols, which = np.unique(symbol[begin[:, None] + np.arange(length)], axis=0, return_inverse=True)
            pairs = np.unique(np.stack([which.ravel(), owner], axis=1), axis=0)
            found.append(Windows(symbols.astype(np.int64), np.searchsorted(pairs[:, 0], np.arange(len(symbols) + 1)), pairs[:, 1]))
        return Patterns(vocabulary, found, [i for i, _ in rows], min((w.symbols.shape[1] for w in found), default=0))


class WaveletMatrix:
    """Rank of any symbol before any position, by one prefix count per bit."""

    def __init__(self, symbols: np.ndarray, bits: int):
        self.bits = bits
        self.zeros, self.ones_before = [], []
        for level in range(bits - 1, -1, -1):
            bit = (symbols >> level) & 1
            ones = np.zeros(len(symbols) + 1, np.int32)
            np.cumsum(bit, out=ones[1:])
            self.ones_before.append(ones)
            self.zeros.append(len(symbols) - int(ones[-1]))
            symbols = np.concatenate([symbols[bit == 0], symbols[bit == 1]])

    def rank(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        """How often each symbol stands before each position."""
        low, high = np.zeros_like(at), at
        for i, level in enumerate(range(self.bits - 1, -1, -1)):
            ones, one = self.ones_before[i], ((symbol >> level) & 1).astype(bool)
            low = np.where(one, self.zeros[i] + ones[low], low - ones[low])
            high = np.where(one, self.zeros[i] + ones[high], high - ones[high])
        return high - low


def suffix_array(text: np.ndarray) -> np.ndarray:
    """Suffix array by prefix doubling; symbol 0 ends a suffix (each 0 is smaller than all
    symbols and unlike every other 0)."""
    n = len(text)
    stops = np.flatnonzero(text == 0)
    rank = text + len(stops)
    rank[stops] = np.arange(len(stops))
    step = 1
    while True:
        behind = np.zeros(n, np.int64)
        behind[:n - step] = rank[step:] + 1
        key = rank * (n + int(rank.max()) + 2) + behind
        order = np.argsort(key, kind="stable")
        key = key[order]
        fresh = np.zeros(n, np.int64)
        np.cumsum(key[1:] != key[:-1], out=fresh[1:])
        rank = np.empty(n, np.int64)
        rank[order] = fresh
        if fresh[-1] == n - 1:
            return order
        step *= 2


class FMIndex:
    def __init__(self, text: np.ndarray, symbols: int, sample: int = SAMPLE):
        """``text`` holds symbols 1..symbols and starts and ends with 0."""
        n = len(text)
        order = suffix_array(text)
        self.bwt = text[order - 1]
        self.before = np.zeros(symbols + 2, np.int64)
        np.cumsum(np.bincount(text, minlength=symbols + 1), out=self.before[1:])
        self.tree = WaveletMatrix(self.bwt, max(1, int(symbols).bit_length()))
        # kept positions: every sample-th, and each that follows a 0, where a walk must end
        kept = (order % sample == 0) | (self.bwt == 0)
        self.position = np.where(kept, order, -1)
        self.size = n

    def search(self, windows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Suffix-array ranges of all windows (rows of one length), by backward search."""
        low, high = np.zeros(len(windows), np.int64), np.full(len(windows), self.size, np.int64)
        for j in range(windows.shape[1] - 1, -1, -1):
            s = windows[:, j]
            low, high = self.before[s] + self.tree.rank(s, low), self.before[s] + self.tree.rank(s, high)
        return low, np.maximum(low, high)

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Text positions of suffix-array rows, by walking back to a kept position."""
        out, steps, todo, at = np.full(len(rows), -1, np.int64), 0, np.arange(len(rows)), rows
        while len(todo):
            known = self.position[at] >= 0
            out[todo[known]] = self.position[at[known]] + steps
            todo, at = todo[~known], at[~known]
            s = self.bwt[at]
            at = self.before[s] + self.tree.rank(s, at)
            steps += 1
        return out


def find(column: pa.Array, patterns: Patterns) -> tuple[np.ndarray, list[list[tuple[int, int]]], list[set[str]]]:
    """Of one shard: words per row, hit word spans as byte ranges per row, items per row."""
    hashes, row, start, end = hashed_words(column)
    rows = len(column)
    n_words = np.bincount(row, minlength=rows)
    spans: list[list[tuple[int, int]]] = [[] for _ in range(rows)]
    items: list[set[str]] = [set() for _ in range(rows)]
    if not patterns.windows or not len(hashes):
        return n_words, spans, items
    symbol = np.searchsorted(patterns.vocabulary, hashes)
    symbol[symbol == len(patterns.vocabulary)] = 0
    known = patterns.vocabulary[symbol] == hashes
    # maximal runs of known words inside a document, as long as the shortest window
    fresh = np.ones(len(hashes), bool)
    fresh[1:] = ~known[:-1] | (row[1:] != row[:-1])
    first = np.flatnonzero(known & fresh)
    over = np.ones(len(hashes), bool)
    over[:-1] = ~known[1:] | (row[1:] != row[:-1])
    length = np.flatnonzero(known & over) + 1 - first
    first, length = first[length >= patterns.shortest], length[length >= patterns.shortest]
    if not len(first):
        return n_words, spans, items
    # indexed text: 0 run 0 run ... 0, and where each of its positions stands among the words
    at = np.cumsum(length + 1) - length
    word = np.full(int(at[-1] + length[-1]) + 1, -1, np.int64)
    inside = np.repeat(at - (np.cumsum(length) - length), length) + np.arange(int(length.sum()))
    word[inside] = np.repeat(first - (np.cumsum(length) - length), length) + np.arange(int(length.sum()))
    text = np.where(word >= 0, symbol[word] + 1, 0)
    index = FMIndex(text, len(patterns.vocabulary))
    edge = np.zeros(len(hashes) + 1, np.int64)
    for windows in patterns.windows:
        low, high = index.search(windows.symbols)
        count = high - low
        if not count.sum():
            continue
        which = np.repeat(np.arange(len(count)), count)
        ranks = np.repeat(low - (np.cumsum(count) - count), count) + np.arange(int(count.sum()))
        begin = word[index.locate(ranks)]
        np.add.at(edge, begin, 1)
        np.add.at(edge, begin + windows.symbols.shape[1], -1)
        pairs = np.unique(np.stack([row[begin], which], axis=1), axis=0)
        at, owner = windows.owners_of(pairs[:, 1])
        for r, item in np.unique(np.stack([pairs[at, 0], owner], axis=1), axis=0).tolist():
            items[r].add(patterns.items[item])
    hit = np.flatnonzero(np.cumsum(edge[:-1]) > 0)
    for w in hit.tolist():
        spans[row[w]].append((int(start[w]), int(end[w])))
    return n_words, spans, items


def merged(data: bytes, spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Removal spans: sorted word spans, joined where no other word stands between them."""
    out: list[tuple[int, int]] = []
    for start, end in spans:
        if out and not _IS_WORD[_FOLD[np.frombuffer(data[out[-1][1]:start], np.uint8)]].any():
            out[-1] = (out[-1][0], end)
        else:
            out.append((start, end))
    return out


def in_pieces(item: str, text: str, window: int, limit: int) -> Iterator[tuple[str, str, int]]:
    """(item, text, bytes) of an item's pieces: the windows that begin within ``limit`` bytes, each whole."""
    data = text.encode()
    if len(data) <= limit:
        yield item, text, len(data)
        return
    raw = np.frombuffer(data, np.uint8)
    start, end, _ = word_spans(_IS_WORD[_FOLD[raw]], np.array([0, len(raw)]))
    first = start[:max(1, len(start) - window + 1)]  # where windows begin
    for k in np.flatnonzero(np.diff(first // limit, prepend=-1)).tolist() if len(first) else []:
        last = int(np.searchsorted(first // limit, first[k] // limit, side="right")) - 1
        piece = data[start[k]:end[min(last + window, len(start)) - 1]]
        yield item, piece.decode(), len(piece)


def dealt(benchmark: DataFrame, window: int, limit: int) -> DataFrame:
    """(item, text, block) of the benchmark's distinct items, dealt in order to blocks of about ``limit`` bytes."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for run in runs(batches):
            for item, text in zip(run.column("item").to_pylist(), run.column("text").to_pylist(), strict=True):
                for piece in in_pieces(item, text, window, limit):
                    yield pa.RecordBatch.from_arrays([pa.array([v]) for v in piece], names=["item", "text", "size"])

    rows = benchmark.select(F.coalesce(F.col("item_id").cast("string"), F.lit("null")).alias("item"), "text").where("text is not null").distinct()
    rows = materialized(rows.mapInArrow(work, "item string, text string, size long").withColumn("at", F.monotonically_increasing_id()), "benchmark-pieces")
    # bytes before each piece: those of earlier partitions (one row each), and those before it in its own
    rows = rows.withColumn("part", F.shiftright("at", 33))
    sizes = rows.groupBy("part").agg(F.sum("size").alias("bytes"))
    earlier = sizes.select("part", (F.sum("bytes").over(Window.orderBy("part")) - F.col("bytes")).alias("earlier"))
    own = F.sum("size").over(Window.partitionBy("part").orderBy("at")) - F.col("size")
    rows = rows.withColumn("own", own).join(earlier, "part")
    return materialized(rows.select("item", "text", F.expr(f"(earlier + own) div {limit}").alias("block")), "benchmark-blocks")


def blocks(benchmark: DataFrame, window: int = WINDOW, limit: int = BLOCK_BYTES) -> Iterator[list[tuple[str, str]]]:
    """The benchmark's distinct items in blocks of at most about twice ``limit`` text bytes, one at a time."""
    rows = dealt(benchmark, window, limit)
    for r in rows.select("block").distinct().orderBy("block").collect():
        yield [(i, t) for i, t in rows.where(F.col("block") == r["block"]).select("item", "text").collect()]


HITS = "n_words long, hits array<struct<start:long,end:long>>, items array<string>"
_SPANS = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))


def search(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, limit: int = BLOCK_BYTES) -> DataFrame:
    """(row, text, n_words, hits, items) of ``docs``: row holds its other columns, hits the byte
    spans of the hit words, items the ids of the items with an occurring window."""
    spark = docs.sparkSession
    out = docs.select(packed(docs), "text", F.lit(0).cast("long").alias("n_words"),
                      F.expr("cast(array() as array<struct<start:long,end:long>>)").alias("hits"),
                      F.expr("cast(array() as array<string>)").alias("items"))
    schema = schema_of(docs, "text string, " + HITS)

    def one_pass(df: DataFrame, rows: list[tuple[str, str | None]]) -> DataFrame:
        shared = spark.sparkContext.broadcast(rows)

        def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            patterns = None
            for run in runs(batches):
                patterns = patterns or Patterns.of(shared.value, window)
                n_words, spans, items = find(run.column("text"), patterns)
                hits = [[{"start": a, "end": b} for a, b in sorted({*((h["start"], h["end"]) for h in old), *new})]
                        for old, new in zip(run.column("hits").to_pylist(), spans, strict=True)]
                ids = [sorted(new.union(old)) for old, new in zip(run.column("items").to_pylist(), items, strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [run.column("row"), run.column("text"), pa.array(n_words, pa.int64()), pa.array(hits, _SPANS),
                     pa.array(ids, pa.list_(pa.string()))], names=["row", "text", "n_words", "hits", "items"])

        return df.mapInArrow(work, schema)

    passes = 0
    for rows in blocks(benchmark, window, limit):
        if passes:
            out = materialized(out, "decontaminate")
        out = one_pass(out, rows)
        passes += 1
    return out if passes else one_pass(out, [])


def report(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, limit: int = BLOCK_BYTES) -> DataFrame:
    found = search(docs.select("doc_id", "text"), benchmark, window, limit)
    return found.select(
        "row.doc_id", "n_words", F.size("hits").cast("long").alias("n_hit"), F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"), (F.size("hits") > 0).alias("contaminated"))


def remove(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, limit: int = BLOCK_BYTES) -> DataFrame:
    """The rows of ``docs``, all columns, with the merged removal spans cut out of ``text``
    (``n_chars``, where there is one, follows); rows without a hit stay as they are."""
    found = search(docs, benchmark, window, limit)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for run in runs(batches):
            texts = [cut(t, merged(t.encode(), [(h["start"], h["end"]) for h in hits])) if hits else t
                     for t, hits in zip(run.column("text").to_pylist(), run.column("hits").to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([run.column("row"), pa.array(texts, pa.string()), pa.array([bool(h) for h in run.column("hits").to_pylist()])],
                                             names=["row", "text", "changed"])

    cuts = found.select("row", "text", "hits").mapInArrow(work, schema_of(docs, "text string, changed boolean"))
    return unpacked(cuts, docs, F.col("changed"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
