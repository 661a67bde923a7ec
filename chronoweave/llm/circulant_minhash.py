"""Operator 6: near-duplicate groups by circulant MinHash.

A document is its set of distinct shingles (``words`` consecutive words, A-Z in lower case; with
fewer words the whole sequence as one).  Signatures use two permutations of 32-bit numbers: the
first scatters the shingles, the second, circularly shifted by 0, 1, 2, ..., gives one coordinate
a shift.  128 coordinates make 32 bands of 4: a pair at similarity 0.85 shares no band with
probability 5e-11 (0.80: 5e-8).  Every link is confirmed on full sets.

Equal sets are one class from the start, so copies cost one row each.  Over the classes:

1. Each band bucket names a centre, the class with most company over all its buckets; each class
   is compared with the centre that it meets in most bands, one exact comparison a class.  The
   links found make the first components.
2. Buckets whose members are then still in different components leave pairs to decide.  The buckets
   of one centre make a group; its pairs are decided inside tasks, on blocks of at most about
   2 x ``BLOCK`` sets, and only links that join components leave.

Nothing is capped: large groups are cut in blocks and every pair of blocks is compared.

Defined results: null and empty texts, and texts without words, have n_shingles 0, their own
doc_id as component and are linked with nothing; a null doc_id is linked with nothing and is kept;
each row is judged by its own text, so rows that repeat a doc_id with an equal text get equal results.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chronoweave.session import materialized

from .common import mix64, prefix_hash, quoted, range_hash, runs, table, utf8, word_spans
from .components import components
from .textstats import IS_WORD

COORDINATES, ROWS = 128, 4
# sets per block when a group's pairs are compared inside a task
BLOCK = 512

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def shingles(column: pa.Array, words: int) -> tuple[np.ndarray, np.ndarray]:
    """The distinct shingles of each row, sorted: (hash, row)."""
    data, offsets = utf8(column)
    rows = len(offsets) - 1
    data = _LOWER[data]
    start, end, row = word_spans(IS_WORD[data], offsets)
    if not len(row):
        return np.empty(0, np.uint64), row
    h = range_hash(prefix_hash(data), start, end, data)
    count = np.bincount(row, minlength=rows)
    at = np.arange(len(h))
    take = np.minimum(count, words)[row]
    begins = at - (np.cumsum(count) - count)[row] + take <= count[row]
    key = np.zeros(len(h), np.uint64)
    for j in range(words):
        key = np.where(j < take, mix64(key + h[np.minimum(at + j, len(h) - 1)]), key)
    key, row = key[begins], row[begins]
    order = np.lexsort((key, row))
    key, row = key[order], row[order]
    new = np.ones(len(key), bool)
    new[1:] = (key[1:] != key[:-1]) | (row[1:] != row[:-1])
    return key[new], row[new]


def permute(x: np.ndarray) -> np.ndarray:
    """A fixed permutation of the 32-bit numbers."""
    x = x ^ (x >> np.uint32(16))
    x = x * np.uint32(0x7FEB352D)
    x = x ^ (x >> np.uint32(15))
    x = x * np.uint32(0x846CA68B)
    return x ^ (x >> np.uint32(16))


def signatures(key: np.ndarray, begin: np.ndarray, coordinates: int = COORDINATES) -> np.ndarray:
    """(rows with shingles, coordinates); ``begin``: where each row's shingles begin."""
    out = np.empty((len(begin), coordinates), np.uint32)
    scattered = permute((key >> np.uint64(32)).astype(np.uint32) ^ np.uint32(0x5BD1E995))
    for shift in range(coordinates):
        out[:, shift] = np.minimum.reduceat(permute(scattered + np.uint32(shift)), begin)
    return out


def bands(signature: np.ndarray, rows: int = ROWS) -> np.ndarray:
    """(rows, bands) of 64-bit bucket keys; a key belongs to one band."""
    parts = signature.reshape(len(signature), -1, rows).astype(np.uint64)
    key = np.zeros(parts.shape[:2], np.uint64) + np.arange(parts.shape[1], dtype=np.uint64)
    for j in range(rows):
        key = mix64(key + parts[:, :, j])
    return key


def _digest(sets: list[np.ndarray]) -> list[bytes]:
    return [hashlib.blake2b(s.tobytes(), digest_size=16).digest() for s in sets]


def _split(key: np.ndarray, row: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    present, begin = np.unique(row, return_index=True)
    return present, begin, np.split(key, begin[1:]) if len(begin) else []


def signed(docs: DataFrame, words: int) -> DataFrame:
    """doc_id, n_shingles, class (digest of the set, null without one), bands and MD5 of the text of
    every row."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for run in runs(batches):
            n = run.num_rows
            data, at = utf8(run.column("text"))
            raw = memoryview(data.tobytes())
            texts = [hashlib.md5(raw[a:b]).digest() for a, b in zip(at.tolist(), at[1:].tolist(), strict=False)]
            key, row = shingles(run.column("text"), words)
            present, begin, sets = _split(key, row)
            classes: list[bytes | None] = [None] * n
            keys: list[np.ndarray | None] = [None] * n
            if len(present):
                found = bands(signatures(key, begin)).view(np.int64)
                for i, digest, b in zip(present.tolist(), _digest(sets), found, strict=True):
                    classes[i], keys[i] = digest, b
            yield pa.RecordBatch.from_arrays(
                [run.column("doc_id"), pa.array(np.bincount(row, minlength=n).astype(np.int64)), pa.array(classes, pa.binary()),
                 pa.array(keys, pa.list_(pa.int64())), pa.array(texts, pa.binary())], names=["doc_id", "n_shingles", "class", "bands", "text_key"])

    return docs.select("doc_id", "text").mapInArrow(work, "doc_id long, n_shingles long, class binary, bands array<long>, text_key binary")


def sets_of(docs: DataFrame, wanted: DataFrame, words: int) -> DataFrame:
    """(class, shingles) of the wanted classes (class, doc_id of a document that has the set)."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for run in runs(batches):
            key, row = shingles(run.column("text"), words)
            present, _, sets = _split(key, row)
            digests = _digest(sets)
            asked = run.column("class").to_pylist()
            own = [j for j, i in enumerate(present.tolist()) if asked[i] == digests[j]]
            yield pa.RecordBatch.from_arrays([pa.array([digests[j] for j in own], pa.binary()),
                                              pa.array([sets[j].view(np.int64) for j in own], pa.list_(pa.int64()))], names=["class", "shingles"])

    return docs.select("doc_id", "text").join(wanted, "doc_id").mapInArrow(work, "class binary, shingles array<long>")


def _linked(a: str, b: str, percent: int) -> F.Column:
    both = F.size(F.array_intersect(a, b))
    return 100 * both >= percent * (F.size(a) + F.size(b) - both)


def verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Those of ``pairs`` (a, b) whose full sets are similar enough."""
    left = sets.select(F.col("class").alias("a"), F.col("shingles").alias("sa"))
    right = sets.select(F.col("class").alias("b"), F.col("shingles").alias("sb"))
    return pairs.join(left, "a").join(right, "b").where(_linked("sa", "sb", percent)).select("a", "b")


def links_in_block(comps: list[bytes], keys: list[np.ndarray], sets: list[np.ndarray], percent: int) -> list[tuple[int, int]]:
    """Links between rows that share a band, as many as join all components that any link joins.

    Common shingles are counted through an inverted list.  Rows of one component, by what was
    known before or by links found here, need no comparison; the largest component's rows are only
    compared with others."""
    comp = np.unique(np.array(comps, object), return_inverse=True)[1]
    size = np.array([len(s) for s in sets])
    flat = np.concatenate(sets)
    owner = np.repeat(np.arange(len(sets)), size)
    order = np.argsort(flat, kind="stable")
    tokens, begin = np.unique(flat[order], return_index=True)
    end = np.append(begin[1:], len(flat))
    owner = owner[order]
    band = np.stack(keys)
    usual = comp == np.bincount(comp).argmax()
    out = []
    for u in np.flatnonzero(~usual).tolist():
        at = np.searchsorted(tokens, sets[u])
        count = end[at] - begin[at]
        where = np.repeat(begin[at] - (np.cumsum(count) - count), count) + np.arange(int(count.sum()))
        common = np.bincount(owner[where], minlength=len(sets))
        near = (100 * common >= percent * (size + size[u] - common)) & (comp != comp[u])
        near &= usual | (np.arange(len(sets)) > u)
        near &= (band == band[u]).any(axis=1)
        while near.any():
            v = int(near.argmax())
            out.append((u, v))
            comp[comp == comp[v]] = comp[u]
            near &= comp != comp[u]
    return out


def _lists(column: pa.ChunkedArray) -> list[np.ndarray]:
    """A list column as numpy arrays, without Python numbers between."""
    out: list[np.ndarray] = []
    for chunk in column.chunks:
        at = chunk.offsets.to_numpy()
        out += np.split(chunk.values.to_numpy()[at[0]:at[-1]], at[1:-1] - at[0])
    return out


def _block_links(percent: int):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t = pa.Table.from_batches(batches)
        sets, keys = _lists(t.column("shingles")), _lists(t.column("bands"))
        classes = t.column("class").to_pylist()
        found = links_in_block(t.column("component").to_pylist(), keys, sets, percent)
        yield pa.RecordBatch.from_arrays([pa.array([classes[u] for u, _ in found], pa.binary()),
                                          pa.array([classes[v] for _, v in found], pa.binary())], names=["a", "b"])

    return work


def class_links(docs: DataFrame, classes: DataFrame, words: int, percent: int, block: int = BLOCK) -> DataFrame:
    """Links (a, b) between classes that connect all that are linked; ``classes``: class,
    n_shingles, doc_id, bands."""
    buckets = classes.select(F.explode("bands").alias("key"), "class")
    full = buckets.groupBy("key").agg(F.count("*").alias("n")).where("n > 1")
    buckets = materialized(buckets.join(full, "key"), "buckets")
    company = buckets.groupBy("class").agg(F.sum(F.col("n") - 1).alias("company"))
    centre = (buckets.join(company, "class").groupBy("key").agg(F.max(F.struct("company", "class")).alias("c"))
              .select("key", F.col("c.class").alias("centre"), "c.company"))
    centre = materialized(centre, "centres")
    met = (buckets.join(centre, "key").where("class <> centre").groupBy("class", "centre")
           .agg(F.count("*").alias("times"), F.max("company").alias("company")))
    first = met.groupBy("class").agg(F.max(F.struct("times", "company", "centre")).alias("best")).select(F.col("class").alias("a"), F.col("best.centre").alias("b"))
    first = materialized(first, "first-pairs")
    # the sets of all classes that share a bucket with another
    wanted = classes.select("class", "doc_id").join(buckets.select("class").distinct(), "class", "left_semi")
    sets = materialized(sets_of(docs, wanted, words), "sets")
    links = materialized(verified(first, sets, percent), "first-links")
    comps = components(links).select(F.col("node").alias("class"), "component")
    place = buckets.select("class").distinct().join(comps, "class", "left").select("class", F.coalesce("component", "class").alias("component"))
    members = buckets.join(materialized(place, "place"), "class").select("key", "class", "component")
    open_keys = members.groupBy("key").agg(F.min("component").alias("x"), F.max("component").alias("y")).where("x <> y").select("key")
    # buckets of one centre are decided together: a pair in them is compared once, where it shares a band
    members = members.join(open_keys, "key").join(centre.select("key", F.col("centre").alias("grp")), "key").select("class", "component", "grp").distinct()
    members = materialized(members, "open")
    spread = members.groupBy("grp").agg(F.count("*").alias("m")).select("grp", F.ceil(F.col("m") / block).cast("int").alias("k"))
    members = members.join(spread, "grp").withColumn("own", F.pmod(F.xxhash64("class"), F.col("k")).cast("int"))
    members = members.select("class", "component", "grp", "own", F.explode(F.sequence(F.lit(0), F.col("k") - 1)).alias("other"))
    members = members.select("class", "component", "grp", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"))
    members = members.join(sets, "class").join(classes.select("class", "bands"), "class")
    return links.union(members.groupBy("grp", "i", "j").applyInArrow(_block_links(percent), "a binary, b binary"))


def _judged(docs: DataFrame, words: int, percent: int, block: int) -> DataFrame:
    """doc_id, n_shingles, class, text_key, component_id and kept of every row of ``docs``."""
    rows = materialized(signed(docs, words), "signed")
    usable = rows.where("class is not null and doc_id is not null")
    classes = (usable.groupBy("class").agg(F.min(F.struct("doc_id", "n_shingles", "bands")).alias("r"))
               .select("class", "r.*"))
    classes = materialized(classes, "classes")
    comps = components(class_links(docs, classes, words, percent, block)).select(F.col("node").alias("class"), "component")
    named = classes.select("class", "doc_id").join(comps, "class", "left").withColumn("component", F.coalesce("component", "class"))
    least = named.groupBy("component").agg(F.min("doc_id").alias("component_id"))
    named = named.join(least, "component").select("class", "component_id")
    out = rows.join(named, "class", "left")
    own = F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id"))
    return out.select("doc_id", "n_shingles", "class", "text_key", own.alias("component_id"), F.coalesce(F.col("doc_id") == own, F.lit(True)).alias("kept"))


def groups(docs: DataFrame, words: int = 5, percent: int = 80, block: int = BLOCK) -> DataFrame:
    """doc_id, n_shingles, component_id and kept of every row of ``docs`` (doc_id, text)."""
    return _judged(docs, words, percent, block).select("doc_id", "n_shingles", "component_id", "kept")


def representatives(docs: DataFrame, words: int = 5, percent: int = 80) -> DataFrame:
    """Pipeline stage: of each group one document, all columns: that with the smallest doc_id, and of
    several texts that share this doc_id and group the one with the least MD5.  Texts without words
    stay; of rows that repeat a doc_id and text one stays.  Rows without a doc_id are in no group:
    of equal texts one stays, and none where a row with a doc_id has the text."""
    rows = _judged(docs, words, percent, BLOCK)
    kept = rows.where("kept and doc_id is not null")
    one = kept.where("class is not null").groupBy("doc_id").agg(F.min("text_key").alias("text_key"))
    kept = one.union(kept.where("class is null").select("doc_id", "text_key").distinct())
    keyed = docs.withColumn("_text_key", F.unhex(F.md5(F.coalesce("text", F.lit("")).cast("binary"))))
    kept = kept.select(F.col("doc_id").alias("_doc_id"), F.col("text_key").alias("_key"))
    named = (keyed.join(kept, (F.col("doc_id") == F.col("_doc_id")) & (F.col("_text_key") == F.col("_key")), "left_semi")
             .dropDuplicates(["doc_id", "_text_key"]))
    known = rows.where("doc_id is not null").select(F.col("text_key").alias("_key"))
    nameless = keyed.where("doc_id is null").dropDuplicates(["_text_key"]).join(known, F.col("_text_key") == F.col("_key"), "left_anti")
    return named.unionByName(nameless).select(*[F.col(quoted(c)) for c in docs.columns])


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return groups(table(spark, sf_dir, "documents"), words=3, percent=85)
