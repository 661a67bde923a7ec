"""Operator 2: document quality by a factorisation machine.

Features of a document: its hashed lower-case words (counts divided by their Euclidean norm), bins
of structure statistics of the whole text, and a bin of the metadata column n_chars.  The score is
the logistic of  w0 + sum w x + 1/2 sum_f ((sum v_f x)^2 - sum (v_f x)^2),  so pairs are scored in
time linear in the features.  labels, lang, source and doc_id are never features.

The model learns from labelled rows outside the held-out fold, at most ``SAMPLE`` of them: those
whose doc_id hashes smallest, which is the same set however the table is laid out.

Defined results: a null text is an empty one, scored from its structure bins; a null doc_id is
never held out (and never learned from); a label that is null is skipped, differing labels of one
document count by their mean.  Without usable labels every score is 0.5.  Every input row gives
one result row; without n_chars its bin is that of null.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import packed, runs, schema_of, table, unpacked
from .textstats import SYMBOLS, Words, row_sums

WORD_BITS = 15
BINS = 16
STATS = 16
SIZE = (1 << WORD_BITS) + STATS * BINS
RANK = 8
# labelled rows learned from, at most
SAMPLE = 6_000
EPOCHS, BATCH, RATE, DECAY = 6, 64, 0.02, 1e-5

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def held_out() -> F.Column:
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 1, F.lit(False))


def _share_bin(part: np.ndarray, whole: np.ndarray) -> np.ndarray:
    """Bins of a share, fine near 0: one for 0, then by halving from 1."""
    share = part / np.maximum(whole, 1)
    return np.where(share <= 0, 0, np.clip(np.floor(np.log2(np.maximum(share, 1e-9))) + BINS - 1, 1, BINS - 1)).astype(np.int64)


def _size_bin(n: np.ndarray) -> np.ndarray:
    return np.clip(np.floor(np.log2(np.maximum(n, 0) + 1)), 0, BINS - 2).astype(np.int64)


def features(column: pa.Array, n_chars: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sparse features, sorted by row: (row, feature, value)."""
    words = Words.of(column)
    rows, data, off = words.rows, words.data, words.offsets
    lower = Words.of(pa.Array.from_buffers(pa.large_string(), rows, [None, pa.py_buffer(off.tobytes()), pa.py_buffer(_LOWER[data].tobytes())]))
    bucket = (lower.hash >> np.uint64(64 - WORD_BITS)).astype(np.int64)
    key, count = np.unique((lower.row << WORD_BITS) | bucket, return_counts=True)
    row = key >> WORD_BITS
    norm = np.sqrt(np.bincount(row, weights=count.astype(float) ** 2, minlength=rows))
    n_words, n_bytes = words.n_words(), np.diff(off)
    distinct = np.bincount(row, minlength=rows)
    full, dup = words.lines()
    upper = row_sums((data >= 65) & (data <= 90), off)
    letters = upper + row_sums(((data >= 97) & (data <= 122)) | (data >= 0xC0), off)
    same = np.zeros(len(words.row), bool)
    same[1:] = (words.hash[1:] == words.hash[:-1]) & (words.row[1:] == words.row[:-1])
    chars = words.word_chars()
    bins = [
        _size_bin(n_words), _size_bin(n_bytes), np.clip((2 * chars) // np.maximum(n_words, 1), 0, BINS - 1), _share_bin(upper, letters),
        _share_bin(words.count_of(SYMBOLS), chars), _share_bin(words.count_of(b"!?"), chars), _share_bin(words.count_of(b"0123456789"), chars),
        _share_bin(words.count_of(b".,;:"), chars), _share_bin(np.bincount(words.row[same], minlength=rows), n_words),
        np.clip((BINS * distinct) // np.maximum(n_words, 1), 0, BINS - 1), _share_bin(dup, full), _share_bin(words.repeat_words(), n_words),
        _share_bin(row_sums(data >= 0x80, off), n_bytes), _share_bin(row_sums(data == 10, off), n_words),
        _share_bin(words.count_of(b"@/\\_={}[]()"), chars),
    ]
    meta = np.array([np.nan if v is None else v for v in n_chars.to_pylist()], float)
    bins.append(np.where(np.isnan(meta), BINS - 1, _size_bin(np.nan_to_num(meta))))
    dense = np.stack(bins, axis=1) + (1 << WORD_BITS) + BINS * np.arange(STATS)
    all_rows = np.concatenate([row, np.repeat(np.arange(rows), STATS)])
    feature = np.concatenate([key & ((1 << WORD_BITS) - 1), dense.ravel()])
    value = np.concatenate([count / norm[row], np.full(rows * STATS, 0.25)])
    order = np.argsort(all_rows, kind="stable")
    return all_rows[order], feature[order], value[order]


@dataclass
class Machine:
    bias: float
    linear: np.ndarray
    factors: np.ndarray  # (SIZE, RANK)

    def parts(self, row: np.ndarray, feature: np.ndarray, value: np.ndarray, rows: int) -> tuple[np.ndarray, np.ndarray]:
        """Raw scores, and the sums of v x per row and factor."""
        out = self.bias + np.bincount(row, weights=self.linear[feature] * value, minlength=rows)
        weighted = self.factors[feature] * value[:, None]
        begin = np.searchsorted(row, np.arange(rows))  # every row has its structure features
        sums = np.add.reduceat(weighted, begin, axis=0) if len(row) else np.zeros((rows, RANK))
        squares = np.add.reduceat(weighted * weighted, begin, axis=0) if len(row) else np.zeros((rows, RANK))
        return out + 0.5 * (sums * sums - squares).sum(axis=1), sums

    def score(self, row: np.ndarray, feature: np.ndarray, value: np.ndarray, rows: int) -> np.ndarray:
        return 1.0 / (1.0 + np.exp(-np.clip(self.parts(row, feature, value, rows)[0], -30, 30)))


def learn(examples: list[tuple[np.ndarray, np.ndarray, float]], seed: int = 7) -> Machine:
    """Logistic loss, Adam over the weights of the features seen; the same every time."""
    rng = np.random.default_rng(seed)
    m = Machine(0.0, np.zeros(SIZE), rng.normal(0, 0.02, (SIZE, RANK)))
    if not examples:
        m.factors[:] = 0
        return m
    params = np.concatenate([m.linear[:, None], m.factors], axis=1)
    first, second, step = np.zeros_like(params), np.zeros_like(params), 0
    for _ in range(EPOCHS):
        order = rng.permutation(len(examples))
        for i in range(0, len(order), BATCH):
            part = [examples[j] for j in order[i:i + BATCH]]
            row = np.repeat(np.arange(len(part)), [len(f) for f, _, _ in part])
            feature, value = np.concatenate([f for f, _, _ in part]), np.concatenate([v for _, v, _ in part])
            m.linear, m.factors = params[:, 0], params[:, 1:]
            raw, sums = m.parts(row, feature, value, len(part))
            err = 1.0 / (1.0 + np.exp(-np.clip(raw, -30, 30))) - np.array([y for _, _, y in part])
            err /= len(part)
            m.bias -= RATE * 5 * err.sum()
            seen, inverse = np.unique(feature, return_inverse=True)
            gain = (err[row] * value)[:, None]
            grad = np.concatenate([gain, gain * (sums[row] - m.factors[feature] * value[:, None])], axis=1)
            order_in = np.argsort(inverse, kind="stable")
            grad = np.add.reduceat(grad[order_in], np.searchsorted(inverse[order_in], np.arange(len(seen))), axis=0) + DECAY * params[seen]
            step += 1
            first[seen] = 0.9 * first[seen] + 0.1 * grad
            second[seen] = 0.99 * second[seen] + 0.01 * grad * grad
            params[seen] -= RATE * first[seen] / (np.sqrt(second[seen]) + 1e-6)
    m.linear, m.factors = params[:, 0].copy(), params[:, 1:].copy()
    return m


def _inputs(docs: DataFrame) -> DataFrame:
    n_chars = F.col("n_chars").cast("double") if "n_chars" in docs.columns else F.lit(None).cast("double")
    return docs.select("doc_id", "text", n_chars.alias("n_chars"))


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Machine:
    label = (labels.where("quality is not null and doc_id is not null").where(~held_out())
             .groupBy("doc_id").agg((F.avg("quality") >= 0.5).cast("int").alias("label")))
    label = label.join(docs.select("doc_id").where("doc_id is not null").distinct(), "doc_id", "left_semi")
    picked = label.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)
    # at most ``sample`` small rows are broadcast
    rows = _inputs(docs).join(F.broadcast(picked), "doc_id").select("doc_id", "text", "n_chars", "label")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for run in runs(batches):
            row, feature, value = features(run.column("text"), run.column("n_chars"))
            bounds = np.searchsorted(row, np.arange(run.num_rows + 1))
            yield pa.RecordBatch.from_arrays(
                [run.column("doc_id"), pa.array([feature[a:b].astype("<i4").tobytes() for a, b in zip(bounds, bounds[1:], strict=False)], pa.binary()),
                 pa.array([value[a:b].astype("<f4").tobytes() for a, b in zip(bounds, bounds[1:], strict=False)], pa.binary()), run.column("label")],
                names=["doc_id", "feature", "value", "label"])

    got = rows.mapInArrow(work, "doc_id long, feature binary, value binary, label int").toPandas()
    got = got.sort_values(["doc_id", "feature", "value"], kind="stable").drop_duplicates("doc_id")
    return learn([(np.frombuffer(f, "<i4").astype(np.int64), np.frombuffer(v, "<f4").astype(float), float(y))
                  for f, v, y in zip(got["feature"], got["value"], got["label"], strict=True)])


def scores(docs: DataFrame, machine: Machine, texts: bool = False) -> DataFrame:
    """(row, score) of every row of ``docs``, and text if asked for; row holds the other columns."""
    shared = docs.sparkSession.sparkContext.broadcast(machine)
    n_chars = F.col("n_chars").cast("double") if "n_chars" in docs.columns else F.lit(None).cast("double")
    rows = docs.select(packed(docs), "text", n_chars.alias("n_chars"))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for run in runs(batches):
            row, feature, value = features(run.column("text"), run.column("n_chars"))
            score = pa.array(shared.value.score(row, feature, value, run.num_rows), pa.float64())
            out = {"row": run.column("row"), "score": score} | ({"text": run.column("text")} if texts else {})
            yield pa.RecordBatch.from_arrays(list(out.values()), names=list(out))

    return rows.mapInArrow(work, schema_of(docs, "score double" + ", text string" * texts))


def accepted(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Pipeline stage: the rows of ``docs``, all columns, that the classifier accepts."""
    return unpacked(scores(docs, train(docs, labels), texts=True).where("score >= 0.5"), docs)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    docs = docs.select(*[c for c in ("doc_id", "text", "n_chars") if c in docs.columns])
    out = scores(docs, train(docs, table(spark, sf_dir, "labels")))
    return (out.select("row.doc_id", "score").select("doc_id", held_out().alias("held_out"), "score",
                                                     (F.col("score") >= 0.5).cast("int").alias("predicted")))
