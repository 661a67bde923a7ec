"""Operator 1: repeated passages by a logarithmic family of suffix arrays.

Every byte covered by a string of ``LENGTH`` bytes that also starts anywhere else (another text, or
another place of the same text) is removed; strings are judged on the input.

*Which suffixes matter.*  Each window of ``LENGTH`` bytes names its anchor, the leftmost of its
``GRAM``-byte strings with the least hash.  Equal windows have equal anchors at equal offsets, so
only windows around one anchor need comparing, and about one position in 70 is an anchor.  The
windows in a row with one anchor form a context.

1. One pass counts the anchors: their number and the least and greatest hash of their contexts,
   which combines before the shuffle.  An anchor seen once repeats nothing; one with a single
   context seen twice or more makes all of that context's windows repeated.
2. A second pass counts the contexts of anchors that have several.  A third sends on only anchors seen
   more than once (a Bloom filter of fixed size lets few others through, and those find no partner),
   with the bytes of contexts whose anchor has several.
3. Those contexts are dealt to tasks by anchor.  A task takes them in batches: a batch gets its
   suffix array (prefix doubling to depth ``LENGTH``), is merge-scanned against the arrays of the
   levels held so far, both sides' matches are marked, and levels of equal order merge, so a task
   holds a logarithmic number of them and touches each suffix a logarithmic number of times.
4. Anchors with more than ``HOT`` contexts would make one task's share grow with the corpus;
   their windows are counted by hash instead, as rows that combine before the shuffle.
5. Repeated windows become byte spans by text, and each text is cut.  Neighbouring contexts that
   are there twice or more travel as one stretch, so a passage that many texts share brings few rows
   to each of them.

Defined results: null and empty texts have 0 bytes and nothing removed; every row is a document
of its own, so a text of ``LENGTH`` bytes or more that is there twice is removed from both rows;
shorter texts repeat nothing.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chronoweave.session import materialized

from .bloom import BloomFilter
from .common import cut, give_back, mix64, packed, prefix_hash, range_hash, runs, schema_of, slid_hash, table, unpacked, utf8

LENGTH = 200
GRAM = 64
# context bytes per batch of a task's index
BATCH_BYTES = 1 << 20
# text bytes looked at together for anchors: what stays in a processor's cache
ANCHOR_RUN = 256 << 10
# contexts of one anchor above which its windows are counted by hash
HOT = 4096


def anchors(data: np.ndarray, offsets: np.ndarray, length: int = LENGTH, gram: int = GRAM) -> tuple[np.ndarray, ...]:
    """Contexts of the rows' windows: (row, start, windows, offset of the anchor, anchor hash,
    context hash)."""
    n = len(data)
    if n < length:
        e = np.empty(0, np.int64)
        return e, e, e, e, e.astype(np.uint64), e.astype(np.uint64)
    prefix = prefix_hash(data)
    # order by hash, then by position; in place, on slices: this runs over every byte
    order = slid_hash(prefix, gram)
    order &= np.uint64(0xFFFFFFFF00000000)
    order |= np.arange(len(order), dtype=np.uint64)
    grams, span = length - gram + 1, 1
    while span * 2 <= grams:
        order = np.minimum(order[:-span], order[span:])
        span *= 2
    if span < grams:
        order = np.minimum(order[:n - length + 1], order[grams - span:grams - span + n - length + 1])
    anchor = (order & np.uint64(0xFFFFFFFF)).astype(np.int64)
    inside = np.ones(len(anchor), bool)  # windows that don't reach into the next row
    for end in offsets[1:-1].tolist():
        inside[max(0, end - length + 1):end] = False
    fresh = inside.copy()
    fresh[1:] &= (anchor[1:] != anchor[:-1]) | ~inside[:-1]
    begin = np.flatnonzero(fresh)
    anchor = anchor[begin]
    row = np.searchsorted(offsets, begin, side="right") - 1
    windows = np.minimum(np.append(begin[1:], n), offsets[row + 1] - length + 1) - begin
    offset = anchor - begin
    context = mix64(range_hash(prefix, begin, begin + windows + length - 1) + offset.astype(np.uint64))
    return row, begin - offsets[row], windows, offset, range_hash(prefix, anchor, anchor + gram), context


def word(text: np.ndarray) -> np.ndarray:
    """The eight bytes from each position on, as a number that sorts as they do."""
    return np.ndarray((max(len(text) - 7, 0),), ">u8", buffer=text, strides=(1,))


@dataclass
class Level:
    """Suffix array of the windows of some contexts."""

    order: int
    text: np.ndarray
    window: np.ndarray  # text position by window number
    sorted: np.ndarray  # window numbers in the order of their LENGTH bytes
    marked: np.ndarray  # by window number: repeated
    context: list[tuple[int, int, int]]  # (anchor, context hash, windows) in window order

    @staticmethod
    def of(contexts: list[tuple[int, int, int, bytes]], length: int) -> Level:
        """Prefix doubling: ranks by 8 bytes, then by twice as many as before, to ``length``."""
        text = np.frombuffer(b"".join(c[3] for c in contexts), np.uint8)
        size = np.array([len(c[3]) for c in contexts], np.int64)
        count = np.array([c[2] for c in contexts], np.int64)
        window = np.repeat(np.cumsum(size) - size - (np.cumsum(count) - count), count) + np.arange(int(count.sum()))
        rank = np.unique(word(text).astype(np.uint64), return_inverse=True)[1].astype(np.int64)
        depth = 8
        while depth * 2 <= length:
            rank = np.unique(rank[:-depth] * len(text) + rank[depth:], return_inverse=True)[1].astype(np.int64)
            depth *= 2
        key = rank[window] * len(text) + rank[window + length - depth]
        order = np.argsort(key, kind="stable")
        same = np.zeros(len(key) + 1, bool)
        same[1:-1] = key[order][1:] == key[order][:-1]
        marked = np.empty(len(key), bool)
        marked[order] = same[1:] | same[:-1]
        return Level(0, text, window, order, marked, [(c[0], c[1], c[2]) for c in contexts])


def scan(new: Level, old: Level, length: int) -> np.ndarray:
    """Merge-scan: mark the windows that both hold, and return where each of new's windows, in
    sorted order, goes in old's order.  Word by word the range of old's suffixes that agree
    so far narrows; most ranges end at once or agree as a whole."""
    mine, theirs = word(new.text), word(old.text)
    at, other = new.window[new.sorted], old.window[old.sorted]
    key = mine[at].astype(np.uint64)
    keys = theirs[other].astype(np.uint64)
    low, high = np.searchsorted(keys, key, "left"), np.searchsorted(keys, key, "right")
    alive = np.flatnonzero(low < high)
    for depth in range(8, length, 8):
        depth = min(depth, length - 8)
        if not len(alive):
            break
        want, lo, hi = mine[at[alive] + depth].astype(np.uint64), low[alive], high[alive]
        whole = (theirs[other[lo] + depth] == want) & (theirs[other[hi - 1] + depth] == want)
        part = np.flatnonzero(~whole)
        for bound, right in ((lo, False), (hi, True)):
            a, b, w = lo[part].copy(), hi[part].copy(), want[part]
            if right:
                a = np.maximum(a, 0)
            while True:
                open_ = np.flatnonzero(a < b)
                if not len(open_):
                    break
                mid = (a[open_] + b[open_]) // 2
                value = theirs[other[mid] + depth].astype(np.uint64)
                below = value <= w[open_] if right else value < w[open_]
                a[open_] = np.where(below, mid + 1, a[open_])
                b[open_] = np.where(below, b[open_], mid)
            if right:
                high[alive[part]] = a
            else:
                low[alive[part]] = a
        alive = alive[low[alive] < high[alive]]
    new.marked[new.sorted[alive]] = True
    hit = np.zeros(len(other) + 1, np.int64)
    np.add.at(hit, low[alive], 1)
    np.add.at(hit, high[alive], -1)
    old.marked[old.sorted[np.cumsum(hit[:-1]) > 0]] = True
    return low


def merge(old: Level, new: Level, place: np.ndarray) -> Level:
    shift = len(old.window)
    return Level(
        max(old.order, new.order) + 1, np.concatenate([old.text, new.text]), np.concatenate([old.window, new.window + len(old.text)]),
        np.insert(old.sorted, place, new.sorted + shift), np.concatenate([old.marked, new.marked]), old.context + new.context)


class Family:
    """Levels of geometrically growing size; a batch is scanned against each as it comes."""

    def __init__(self, length: int = LENGTH):
        self.length = length
        self.levels: list[Level] = []

    def add(self, contexts: list[tuple[int, int, int, bytes]]) -> None:
        new = Level.of(contexts, self.length)
        for level in self.levels[:-1]:
            scan(new, level, self.length)
        place = scan(new, self.levels[-1], self.length) if self.levels else None
        self.levels.append(new)
        while len(self.levels) > 1 and self.levels[-1].order == self.levels[-2].order:
            new, old = self.levels.pop(), self.levels.pop()
            self.levels.append(merge(old, new, scan(new, old, self.length) if place is None else place))
            place = None

    def repeats(self) -> Iterator[tuple[int, int, list[dict[str, int]]]]:
        """(anchor, context hash, runs of repeated windows) of each context that has some."""
        for level in self.levels:
            count = np.array([c[2] for c in level.context], np.int64)
            first = np.cumsum(count) - count
            owner = np.repeat(np.arange(len(count)), count)
            begin = level.marked.copy()
            begin[1:] &= ~level.marked[:-1] | (owner[1:] != owner[:-1])
            over = level.marked.copy()
            over[:-1] &= ~level.marked[1:] | (owner[1:] != owner[:-1])
            found: dict[int, list[dict[str, int]]] = {}
            for a, b in zip(np.flatnonzero(begin).tolist(), np.flatnonzero(over).tolist(), strict=True):
                i = int(owner[a])
                found.setdefault(i, []).append({"first": a - int(first[i]), "last": b - int(first[i])})
            for i, spans in found.items():
                yield level.context[i][0], level.context[i][1], spans


_PARTS = pa.list_(pa.struct([("h", pa.int64()), ("x", pa.int64()), ("at", pa.int32()), ("windows", pa.int32()), ("several", pa.bool_())]))
# contexts in one stretch, at most; a stretch also ends behind one anchor in this many
STRETCH, STRETCH_END = 256, 16


def stretches(chosen: np.ndarray, at: np.ndarray, row: np.ndarray, h: np.ndarray) -> np.ndarray:
    """Where runs of neighbouring contexts begin among the ``chosen`` ones (``at``: their numbers among
    all contexts).  Runs end at fixed anchors, so equal passages give equal runs."""
    fresh = np.ones(len(chosen), bool)
    before, now = chosen[:-1], chosen[1:]
    fresh[1:] = (at[now] != at[before] + 1) | (row[now] != row[before]) | ((h[before] >> np.uint64(17)) % np.uint64(STRETCH_END) == 0)
    begin = np.flatnonzero(fresh)
    since = np.arange(len(chosen)) - np.repeat(begin, np.diff(np.append(begin, len(chosen))))
    return np.flatnonzero(since % STRETCH == 0)


_RUNS = pa.list_(pa.struct([("first", pa.int32()), ("last", pa.int32())]))
_REPEATS = "h long, x long, found array<struct<first:int,last:int>>"


def indexed_repeats(contexts: DataFrame, length: int, batch_bytes: int) -> DataFrame:
    """Runs of windows of each context (h, x, windows, bytes) that another context has too."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        family, held, size = Family(length), [], 0
        for batch in batches:
            for c in zip(*(batch.column(n).to_pylist() for n in ("h", "x", "windows", "bytes")), strict=True):
                held.append(c)
                size += len(c[3])
                if size >= batch_bytes:
                    family.add(held)
                    held, size = [], 0
        if held:
            family.add(held)
        rows = list(family.repeats())
        for i in range(0, len(rows), 10_000):
            h, x, found = zip(*rows[i:i + 10_000], strict=True)
            yield pa.RecordBatch.from_arrays([pa.array(h, pa.int64()), pa.array(x, pa.int64()), pa.array(found, _RUNS)], names=["h", "x", "found"])
        del family, rows
        give_back()

    return contexts.select("h", "x", "windows", "bytes").repartition("h").mapInArrow(work, _REPEATS)


def counted_repeats(contexts: DataFrame, length: int) -> DataFrame:
    """The same by counting window hashes; for anchors with very many contexts."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(0, batch.num_rows, 2048):
                part = batch.slice(i, 2048)
                count = np.asarray(part.column("windows")).astype(np.int64)
                raw = part.column("bytes").to_pylist()
                text = np.frombuffer(b"".join(raw), np.uint8)
                size = np.array([len(r) for r in raw], np.int64)
                owner = np.repeat(np.arange(len(raw)), count)
                within = np.arange(int(count.sum())) - np.repeat(np.cumsum(count) - count, count)
                at = (np.cumsum(size) - size)[owner] + within
                key = range_hash(prefix_hash(text), at, at + length)
                yield pa.RecordBatch.from_arrays(
                    [part.column("h").take(pa.array(owner)), part.column("x").take(pa.array(owner)), pa.array(key.view(np.int64)), pa.array(within.astype(np.int32))],
                    names=["h", "x", "w", "s"])

    windows = contexts.select("h", "x", "windows", "bytes").mapInArrow(work, "h long, x long, w long, s int")
    twice = windows.groupBy("h", "w").agg(F.count("*").alias("n")).where("n > 1").select("h", "w")
    return (windows.join(twice, ["h", "w"]).groupBy("h", "x")
            .agg(F.collect_list(F.struct(F.col("s").alias("first"), F.col("s").alias("last"))).alias("found")))


def text_key(column: str = "text") -> F.Column:
    return F.unhex(F.md5(F.coalesce(F.col(column), F.lit("")).cast("binary")))


def spans(docs: DataFrame, length: int = LENGTH, gram: int = GRAM, batch_bytes: int = BATCH_BYTES, hot: int = HOT) -> DataFrame:
    """(key, spans): for each text with repeated bytes the md5 of the text and byte spans that
    cover just those bytes (they may overlap)."""
    spark, texts = docs.sparkSession, docs.select("text")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for run in runs(batches, limit=ANCHOR_RUN):
            *_, h, x = anchors(*utf8(run.column("text")), length, gram)
            yield pa.RecordBatch.from_arrays([pa.array(h.view(np.int64)), pa.array(x.view(np.int64))], names=["h", "x"])

    seen = texts.mapInArrow(count, "h long, x long").groupBy("h").agg(F.count("*").alias("n"), F.min("x").alias("lo"), F.max("x").alias("hi"))
    seen = materialized(seen.where("n > 1").select("h", (F.col("lo") != F.col("hi")).alias("several")), "anchors")
    any_filter = spark.sparkContext.broadcast(BloomFilter.of(seen))
    several_filter = spark.sparkContext.broadcast(BloomFilter.of(seen.where("several")))

    def crowd(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for run in runs(batches, limit=ANCHOR_RUN):
            *_, h, x = anchors(*utf8(run.column("text")), length, gram)
            yield pa.RecordBatch.from_arrays([pa.array(x[several_filter.value.holds(h)].view(np.int64))], names=["h"])

    # of anchors with several contexts, the contexts that are there twice or more
    twice = materialized(texts.mapInArrow(crowd, "h long").groupBy("h").agg(F.count("*").alias("n")).where("n > 1").select("h"), "copied-contexts")
    copied_filter = spark.sparkContext.broadcast(BloomFilter.of(twice))

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for run in runs(batches, limit=ANCHOR_RUN):
            data, offsets = utf8(run.column("text"))
            row, start, windows, _, h, x = anchors(data, offsets, length, gram)
            at = np.flatnonzero(any_filter.value.holds(h))
            row, start, windows, h, x = row[at], start[at], windows[at], h[at], x[at]
            several = several_filter.value.holds(h)
            raw, begin = data.tobytes(), offsets[row] + start
            keys: dict[int, bytes] = {}
            for r in np.unique(row).tolist():
                keys[r] = hashlib.md5(raw[offsets[r]:offsets[r + 1]]).digest()
            copied = ~several
            copied[several] = copied_filter.value.holds(x[several])
            one = np.flatnonzero(~copied)
            yield pa.RecordBatch.from_arrays(
                [pa.array([keys[r] for r in row[one].tolist()], pa.binary()), pa.array(start[one].astype(np.int32)), pa.array(windows[one].astype(np.int32)),
                 pa.array(h[one].view(np.int64)), pa.array(x[one].view(np.int64)),
                 pa.array([raw[b:b + n + length - 1] for b, n in zip(begin[one].tolist(), windows[one].tolist(), strict=True)], pa.binary()),
                 pa.nulls(len(one), pa.binary()), pa.nulls(len(one), _PARTS)], names=names)
            many = np.flatnonzero(copied)
            if not len(many):
                continue
            cuts = stretches(many, at, row, h)
            to = np.append(cuts[1:], len(many))
            first = np.repeat(start[many[cuts]], to - cuts)
            own = np.stack([h[many], x[many]], axis=1)
            names_of = [hashlib.blake2b(own[i:j].tobytes(), digest_size=16).digest() for i, j in zip(cuts.tolist(), to.tolist(), strict=True)]
            parts = pa.StructArray.from_arrays([pa.array(h[many].view(np.int64)), pa.array(x[many].view(np.int64)), pa.array((start[many] - first).astype(np.int32)),
                                                pa.array(windows[many].astype(np.int32)), pa.array(several[many])], fields=list(_PARTS.value_type))
            nothing = [pa.nulls(len(cuts), t) for t in (pa.int32(), pa.int64(), pa.int64())]
            # the bytes of a stretch are the index's, where one of its anchors has other contexts
            asked = np.logical_or.reduceat(several[many], cuts).tolist()
            over = begin[many[to - 1]] + windows[many[to - 1]] + length - 1
            held = [raw[a:b] if s else None for a, b, s in zip(begin[many[cuts]].tolist(), over.tolist(), asked, strict=True)]
            yield pa.RecordBatch.from_arrays(
                [pa.array([keys[r] for r in row[many[cuts]].tolist()], pa.binary()), pa.array(start[many[cuts]].astype(np.int32)), *nothing,
                 pa.array(held, pa.binary()), pa.array(names_of, pa.binary()), pa.ListArray.from_arrays(pa.array(np.append(cuts, len(many)).astype(np.int32)), parts)], names=names)

    names = ["key", "start", "windows", "h", "x", "bytes", "stretch", "parts"]
    sent = materialized(texts.mapInArrow(send, "key binary, start int, windows int, h long, x long, bytes binary, stretch binary, "
                                               "parts array<struct<h:long,x:long,at:int,windows:int,several:boolean>>"), "contexts")
    singles, runs_of = sent.where("stretch IS NULL"), sent.where("stretch IS NOT NULL")
    stretch = materialized(runs_of.groupBy("stretch").agg(F.count("*").alias("n"), F.first("parts").alias("parts"), F.first("bytes").alias("bytes")), "stretches")
    inside = stretch.select("stretch", "n", "bytes", F.inline("parts"))
    own = F.when(F.col("several"), F.expr(f"substring(bytes, at + 1, windows + {int(length) - 1})"))
    contexts = singles.select("h", "x", F.lit(1).cast("long").alias("n"), "windows", "bytes").union(inside.select("h", "x", "n", "windows", own))
    contexts = contexts.groupBy("h", "x").agg(F.sum("n").alias("n"), F.max("windows").alias("windows"), F.max("bytes").alias("bytes"))
    contexts = materialized(contexts.where("n > 1 OR bytes IS NOT NULL"), "distinct-contexts")
    # a context that is there twice repeats all its windows; what else repeats the index finds
    mixed = contexts.where("bytes IS NOT NULL").select("h", "x", "n", "windows", "bytes")
    copies = contexts.where("n > 1").select("h", "x", F.array(F.struct(F.lit(0).alias("first"), (F.col("windows") - 1).alias("last"))).alias("found"))
    crowded = mixed.groupBy("h").agg(F.count("*").alias("m")).where(F.col("m") > hot).select("h")
    calm, busy = mixed.join(crowded, "h", "left_anti"), mixed.join(crowded, "h", "left_semi")
    found = materialized(copies.union(indexed_repeats(calm, length, batch_bytes)).union(counted_repeats(busy, length).select("h", "x", "found")), "repeats")
    # copies of a text have equal rows, which combine before the shuffle
    parts = singles.select("key", "start", "h", "x").distinct().join(found, ["h", "x"])
    parts = parts.select("key", F.expr(f"transform(found, f -> struct(start + f.first AS start, start + f.last + {int(length)} AS end))").alias("spans"))
    # a stretch that is there twice is repeated as a whole; of the others the contexts that are elsewhere too
    last = F.element_at("parts", -1)
    whole = stretch.where("n > 1").select("stretch", F.array(F.struct(F.lit(0).alias("start"), (last["at"] + last["windows"] + (length - 1)).alias("end"))).alias("spans"))
    partly = inside.where("n = 1").select("stretch", "h", "x", "at").join(found, ["h", "x"]).groupBy("stretch").agg(
        F.flatten(F.collect_list(F.expr(f"transform(found, f -> struct(at + f.first AS start, at + f.last + {int(length)} AS end))"))).alias("spans"))
    spread = runs_of.select("key", "start", "stretch").distinct().join(whole.union(partly), "stretch")
    spread = spread.select("key", F.expr("transform(spans, p -> struct(start + p.start AS start, start + p.end AS end))").alias("spans"))
    return parts.union(spread).groupBy("key").agg(F.flatten(F.collect_list("spans")).alias("spans"))


def maximal(pieces: list[dict[str, int]]) -> list[tuple[int, int]]:
    """Maximal runs of the bytes that the spans cover."""
    out: list[tuple[int, int]] = []
    for start, end in sorted((p["start"], p["end"]) for p in pieces):
        if out and start <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], end))
        else:
            out.append((start, end))
    return out


def with_spans(docs: DataFrame, found: DataFrame) -> DataFrame:
    return docs.withColumn("_key", text_key()).join(found.withColumnRenamed("key", "_key"), "_key", "left")


def report(docs: DataFrame, length: int = LENGTH, gram: int = GRAM, batch_bytes: int = BATCH_BYTES, hot: int = HOT) -> DataFrame:
    docs = docs.select("doc_id", "text")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for run in runs(batches):
            rows = []
            data, offsets = utf8(run.column("text"))
            raw = data.tobytes()
            for i, pieces in enumerate(run.column("spans").to_pylist()):
                text, cuts = raw[offsets[i]:offsets[i + 1]], maximal(pieces or [])
                kept, at = hashlib.sha256(), 0
                for start, end in cuts:
                    kept.update(text[at:start])
                    at = end
                kept.update(text[at:])
                rows.append((len(text), sum(e - s for s, e in cuts), len(cuts), kept.hexdigest()))
            cols = list(zip(*rows, strict=True))
            yield pa.RecordBatch.from_arrays([run.column("doc_id"), *(pa.array(c, pa.int64()) for c in cols[:3]), pa.array(cols[3], pa.string())],
                                             names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"])

    rows = with_spans(docs, spans(docs, length, gram, batch_bytes, hot)).select("doc_id", "text", "spans")
    return rows.mapInArrow(work, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string")


def remove(docs: DataFrame, length: int = LENGTH, gram: int = GRAM, batch_bytes: int = BATCH_BYTES, hot: int = HOT) -> DataFrame:
    """Pipeline stage: the rows of ``docs``, all columns, without the repeated bytes (a character
    goes when all its bytes do); n_chars, where there is one, follows."""
    rows = docs.select(packed(docs), "text")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for run in runs(batches):
            pieces = run.column("spans").to_pylist()
            texts = [cut(t, maximal(s)) if s else t for t, s in zip(run.column("text").to_pylist(), pieces, strict=True)]
            yield pa.RecordBatch.from_arrays([run.column("row"), pa.array(texts, pa.string()), pa.array([bool(s) for s in pieces])],
                                             names=["row", "text", "changed"])

    rows = with_spans(rows, spans(docs, length, gram, batch_bytes, hot)).select("row", "text", "spans")
    return unpacked(rows.mapInArrow(work, schema_of(docs, "text string, changed boolean")), docs, F.col("changed"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return report(table(spark, sf_dir, "documents"))
