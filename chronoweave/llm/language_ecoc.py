"""Operator 7: language identification by error-correcting output codes.

Every language gets a codeword of bits; one binary classifier per bit learns, from the byte
n-grams of a text, which half of the languages it belongs to.  Decoding adds up, for each
codeword, the logistic losses of all classifiers against its bits and takes the least: a few wrong
bits are outvoted.  ``score`` is the softmax of the negated losses at the chosen language, and
``ambiguous`` says that the runner-up's loss is within ``MARGIN`` per bit.

A text's features are its case-folded byte 1-, 2- and 3-grams inside and around words, hashed,
as the square roots of their shares.  lang, source and doc_id are never features.

The classifiers learn from rows with a language outside the held-out fold, at most ``PER_LANG`` of
each language and ``LEARNED`` altogether: those whose doc_id hashes smallest.  With more than
``LEARNED`` languages the most frequent ones are learned.

Defined results: ``und`` with score 0 for a null text, a text without a letter, and where no
language could be learned; a null doc_id is never held out (and never learned from); every input
row gives one result row.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from chronoweave.session import materialized

from .common import runs, table, utf8

BITS = 12
SIZE = 256 + 2 * (1 << BITS)
# rows of each language learned from, at most
PER_LANG = 400
# rows learned from altogether, at most: about 100 MB of features on the driver
LEARNED = 6000
EPOCHS, BATCH, RATE = 12, 64, 0.05
MARGIN = 0.05

# letters in lower case, bytes of other characters as they are, all else one space
_FOLD = np.full(256, 32, np.uint8)
_FOLD[97:123] = np.arange(97, 123)
_FOLD[65:91] = np.arange(97, 123)
_FOLD[128:] = np.arange(128, 256)


def held_out() -> F.Column:
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 1, F.lit(False))


def codewords(n: int, seed: int = 11) -> np.ndarray:
    """(n, bits) of +1/-1.  Up to six languages: every split of them into two halves; more: the
    random code of 10 log2 n bits (15 at least) whose nearest two rows are farthest apart."""
    if n <= 1:
        return np.ones((n, 1))
    if n <= 6:
        splits = np.arange(1, 1 << (n - 1))
        return np.where((splits[None, :] >> np.arange(n)[:, None]) & 1, 1.0, -1.0)
    rng, best, gap = np.random.default_rng(seed), None, -1.0
    bits = max(15, int(np.ceil(10 * np.log2(n))))
    for _ in range(64):
        code = np.where(rng.random((n, bits)) < 0.5, 1.0, -1.0)
        code[0, np.abs(code.sum(axis=0)) == n] *= -1  # a bit must tell some languages apart
        apart = bits - code @ code.T
        apart[np.arange(n), np.arange(n)] = np.inf
        if apart.min() > gap:
            best, gap = code, apart.min()
    return best


def features(column: pa.Array) -> np.ndarray:
    """(rows, SIZE) of float32."""
    data, offsets = utf8(column)
    rows = len(offsets) - 1
    folded = _FOLD[data].astype(np.int64)
    row = np.repeat(np.arange(rows), np.diff(offsets))
    out = np.bincount(row * SIZE + folded, minlength=rows * SIZE).astype(np.float32)
    for n in (2, 3):
        if len(folded) < n:
            break
        gram = np.zeros(len(folded) - n + 1, np.int64)
        for j in range(n):
            gram = gram * 257 + folded[j:len(folded) - n + 1 + j]
        inside = (row[:len(gram)] == row[n - 1:]) & (gram != 32 * sum(257**j for j in range(n)))
        at = ((gram * 2654435761) >> 11) & ((1 << BITS) - 1)
        out += np.bincount((row[:len(gram)] * SIZE + 256 + (n - 2) * (1 << BITS) + at)[inside], minlength=rows * SIZE)
    out = out.reshape(rows, SIZE)
    out[:, 32] = 0
    return np.sqrt(out / np.maximum(out.sum(axis=1, keepdims=True), 1))


def has_letter(column: pa.Array) -> np.ndarray:
    data, offsets = utf8(column)
    ascii_letter = np.zeros(len(data) + 1, np.int64)
    np.cumsum(_FOLD[data] != 32, out=ascii_letter[1:])
    maybe = ascii_letter[offsets[1:]] > ascii_letter[offsets[:-1]]
    plain = np.zeros(len(data) + 1, np.int64)
    np.cumsum((_FOLD[data] != 32) & (data < 128), out=plain[1:])
    sure = plain[offsets[1:]] > plain[offsets[:-1]]
    for i in np.flatnonzero(maybe & ~sure).tolist():
        sure[i] = any(c.isalpha() for c in column[i].as_py())
    return sure


@dataclass
class Codes:
    languages: list[str]
    code: np.ndarray  # (languages, bits)
    weights: np.ndarray  # (SIZE, bits)
    bias: np.ndarray

    def losses(self, x: np.ndarray) -> np.ndarray:
        """Mean logistic loss of each row against each codeword."""
        margin = x @ self.weights + self.bias
        return np.stack([np.logaddexp(0, -margin * word).mean(axis=1) for word in self.code], axis=1)


def learn(x: np.ndarray, y: np.ndarray, languages: list[str], seed: int = 5) -> Codes:
    """All bits at once: logistic regression with Adam; the same every time.  ``x`` may be of half
    precision: a batch at a time is widened."""
    code = codewords(len(languages))
    rng, w, b = np.random.default_rng(seed), np.zeros((SIZE, code.shape[1]), np.float32), np.zeros(code.shape[1], np.float32)
    first, second = np.zeros_like(w), np.zeros_like(w)
    target = code[y].astype(np.float32)
    for _ in range(EPOCHS if len(languages) > 1 else 0):
        order = rng.permutation(len(y))
        for i in range(0, len(order), BATCH):
            part = order[i:i + BATCH]
            wide = x[part].astype(np.float32)
            pull = -target[part] / (1 + np.exp(np.clip(target[part] * (wide @ w + b), -30, 30))) / len(part)
            grad = wide.T @ pull + 1e-6 * w
            first, second = 0.9 * first + 0.1 * grad, 0.99 * second + 0.01 * grad * grad
            w -= RATE * 4 * first / (np.sqrt(second) + 1e-6)
            b -= RATE * pull.sum(axis=0)
    return Codes(languages, code, w, b)


def train(docs: DataFrame, per_lang: int = PER_LANG, learned: int = LEARNED) -> Codes:
    rows = docs.where("lang is not null and text is not null and doc_id is not null").where(~held_out())
    keys = rows.select("doc_id", "lang", (F.xxhash64("doc_id").bitwiseAND(F.lit((1 << 30) - 1)) / F.lit(float(1 << 30))).alias("at"))
    counts = materialized(keys.groupBy("lang").count(), "languages")
    n = counts.count()
    if n > learned:
        counts = counts.orderBy(F.col("count").desc(), "lang").limit(learned)
    per_lang = max(1, min(per_lang, learned // max(n, 1)))
    # at most ``learned`` rows; a share of each language that holds per_lang rows with ample room, then exactly that many
    near = keys.join(F.broadcast(counts) if n <= learned else counts, "lang").where(F.col("at") * F.col("count") <= 4.0 * per_lang + 64)
    picked = (near.withColumn("n", F.row_number().over(Window.partitionBy("lang").orderBy("at", "doc_id")))
              .where(F.col("n") <= per_lang).select("doc_id", "lang").distinct())
    # of rows that repeat a doc_id and language one text
    sample = rows.select("doc_id", "lang", "text").join(F.broadcast(picked), ["doc_id", "lang"]).groupBy("doc_id", "lang").agg(F.min("text").alias("text"))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for run in runs(batches):
            x = features(run.column("text")).astype("<f2")
            yield pa.RecordBatch.from_arrays([run.column("doc_id"), run.column("lang"), pa.array([v.tobytes() for v in x], pa.binary())],
                                             names=["doc_id", "lang", "x"])

    got = sample.mapInArrow(work, "doc_id long, lang string, x binary").toPandas().sort_values(["doc_id", "lang", "x"], kind="stable")
    languages, y = np.unique(got["lang"].to_numpy(str), return_inverse=True)
    x = np.frombuffer(b"".join(got.pop("x")), "<f2").reshape(len(got), SIZE)
    return learn(x, y.astype(np.int64), languages.tolist())


def identify(docs: DataFrame, codes: Codes, margin: float = MARGIN) -> DataFrame:
    """doc_id, lang_pred, score, ambiguous of every row of ``docs`` (doc_id, text)."""
    shared = docs.sparkSession.sparkContext.broadcast(codes)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes = shared.value
        for run in runs(batches):
            n = run.num_rows
            if codes.languages:
                part = [codes.losses(features(run.column("text").slice(i, 256))) for i in range(0, n, 256)]
                loss = np.concatenate(part)
                chosen = loss.argmin(axis=1)
                least = loss[np.arange(n), chosen]
                weight = np.exp(-(loss - least[:, None]) * codes.code.shape[1])
                score = 1.0 / weight.sum(axis=1)
                second = np.partition(loss, 1, axis=1)[:, 1] if loss.shape[1] > 1 else np.full(n, np.inf)
                sure = has_letter(run.column("text"))
                pred = [codes.languages[c] if s else "und" for c, s in zip(chosen.tolist(), sure.tolist(), strict=True)]
                score, close = np.where(sure, score, 0.0), (second - least < margin) & sure
            else:
                pred, score, close = ["und"] * n, np.zeros(n), np.zeros(n, bool)
            yield pa.RecordBatch.from_arrays([run.column("doc_id"), pa.array(pred, pa.string()), pa.array(score), pa.array(close)],
                                             names=["doc_id", "lang_pred", "score", "ambiguous"])

    return docs.select("doc_id", "text").mapInArrow(work, "doc_id long, lang_pred string, score double, ambiguous boolean")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return identify(docs, train(docs)).select("doc_id", held_out().alias("held_out"), "lang_pred", "score", "ambiguous")
