"""Operator 5: quality rules from tokeniser fertility.

Each document's words go through two public vocabularies: one of pieces with byte fallback, and a
byte-level one for many languages (words behind a space).
Measured are the characters per token and the entropy of the document's token distribution in bits
under both, and the share of byte-fallback tokens.  A document outside the band of its main script
is rejected, and so is one that fails the base rules (under 50 words, or more than half of its words in repeated 3-word
windows).

A second band comes from the corpus: of each language (column ``lang``, where there is one) and
script, the quartiles of each measure over all documents that pass the base rules.  A document
is rejected where it lies more than ``FAR`` times the distance of the quartiles beyond the one next
to it: characters per token of the byte-level vocabulary or entropy below, byte share above.
The band of a text under ``TYPICAL_WORDS`` words is wider, as a mean over n words strays by
1 / sqrt(n).  The quartiles come from a histogram with ``STEPS`` bins per unit, which is the same
whatever the partitions; what the measures can be is bounded by the vocabularies, so is its size.

Each distinct word is encoded once per task and its ids kept in a bounded table.

Defined results: null and empty texts have no words, no tokens and fail the base rules; text
without letters of a listed script uses the band ``other``; a null ``lang`` is a language of its own;
every input row gives one result row, repeated or with a null id.
"""

from __future__ import annotations

import base64
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from chronoweave.session import materialized

from .common import runs, table
from .textstats import SYMBOLS, Words
from .token_counts import model_path

MIN_WORDS = 50
# tokens of distinct words remembered per task
REMEMBERED_TOKENS = 8_000_000

# a measure this many quartile distances beyond a quartile is far out; texts of fewer words may stray more
FAR, TYPICAL_WORDS = 3.0, 256
# bins per unit of a measure's histogram
STEPS = 256
# measure: which side is rejected, and the least distance of the quartiles (copies may make it 0)
FENCED = {"chars_per_token_multi": ("below", 0.05), "byte_share": ("above", 0.02), "token_entropy": ("below", 0.25)}
# languages and scripts up to which their limits are broadcast
BROADCAST_GROUPS = 50_000

SCRIPTS = ["other", "latin", "greek", "cyrillic", "hebrew", "arabic", "indic", "cjk", "hangul"]
# script by the first byte of a UTF-8 character
_SCRIPT = np.zeros(256, np.int64)
_SCRIPT[65:91] = _SCRIPT[97:123] = 1
_SCRIPT[0xC3:0xCB] = 1
_SCRIPT[0xCE:0xD0] = 2
_SCRIPT[0xD0:0xD5] = 3
_SCRIPT[0xD6:0xD8] = 4
_SCRIPT[0xD8:0xDC] = 5
_SCRIPT[0xE0] = 6
_SCRIPT[0xE3:0xEA] = 7
_SCRIPT[0xEA:0xEE] = 8


@dataclass(frozen=True)
class Band:
    """Rejected: characters per token under ``least`` and, in the byte-level vocabulary, under
    ``least_multi`` too (a language that one vocabulary covers stays), or above ``most``; byte share
    above; entropy below, in either vocabulary."""

    least: float
    most: float
    byte_share: float
    entropy: float
    least_multi: float = math.inf
    entropy_multi: float = 0.0


#: The lower bounds stand between noise and prose.  Noise reaches at most so many characters per
#: token (pieces, byte-level) in 30 texts of 200 words of 3 to 9 random letters of the script:
#: latin 1.60, 1.49 (base64 1.23, 1.22; hex 1.08, 1.44), greek 0.86, 1.07, cyrillic 1.14, 1.19,
#: hebrew 0.86, 1.08, arabic 0.78, 0.93, cjk 0.33, 0.46, hangul 0.32, 0.44.  Each bound lets some
#: language of its script pass by one vocabulary only: Czech by pieces (1.82, 1.60), Vietnamese
#: (1.15, 2.24), Greek (0.84, 1.68) and Persian (0.83, 1.24) by bytes.  Latin entropy: 0.85 of the
#: least of good prose of 50 words or more in sf0.01 (5.64 bits).  ``indic`` holds many scripts that
#: neither vocabulary covers and has no bound above noise.
BANDS = {
    "latin": Band(1.7, 8.0, 0.10, 4.8, 1.75, 4.8),
    "greek": Band(0.95, 6.0, 0.30, 3.5, 1.3, 3.5),
    "cyrillic": Band(1.3, 7.0, 0.20, 3.5, 1.4, 3.5),
    "hebrew": Band(0.95, 6.0, 0.40, 3.5, 1.3, 3.5),
    "arabic": Band(0.9, 6.0, 0.40, 3.5, 1.1, 3.5),
    "indic": Band(0.3, 6.0, 0.80, 3.5),
    "cjk": Band(0.4, 4.0, 0.80, 3.5, 0.55, 3.5),
    "hangul": Band(0.4, 4.0, 0.80, 3.5, 0.6, 3.5),
    "other": Band(0.2, 8.0, 0.90, 3.0),
}


class WordTokens:
    """Token ids of words, found by word hash."""

    def __init__(self, path: str):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.size = self.model.vocab_size()
        self.is_byte = np.array([self.model.is_byte(i) for i in range(self.size)])
        self.clear()

    def encode(self, words: list[str]) -> list[list[int]]:
        return self.model.encode(words, num_threads=1)

    def clear(self) -> None:
        self.hashes = np.empty(0, np.uint64)
        self.slot = np.empty(0, np.int64)
        self.begin = np.zeros(1, np.int64)
        self.tokens = np.empty(0, np.int32)

    def of(self, words: Words) -> tuple[np.ndarray, np.ndarray]:
        """(row, token) of every token of every word."""
        hashes, first, inverse = np.unique(words.hash, return_index=True, return_inverse=True)
        if len(self.tokens) > REMEMBERED_TOKENS:
            self.clear()
        at = np.searchsorted(self.hashes, hashes)
        known = np.zeros(len(hashes), bool)
        inside = at < len(self.hashes)
        known[inside] = self.hashes[at[inside]] == hashes[inside]
        new = np.flatnonzero(~known)
        if len(new):
            encoded = self.encode([words.bytes_of(i).decode("utf-8", "replace") for i in first[new].tolist()])
            sizes = np.array([len(e) for e in encoded], np.int64)
            slots = np.arange(len(new)) + len(self.begin) - 1
            self.begin = np.concatenate([self.begin, self.begin[-1] + np.cumsum(sizes)])
            self.tokens = np.concatenate([self.tokens, np.fromiter((t for e in encoded for t in e), np.int32, int(sizes.sum()))])
            self.slot = np.insert(self.slot, at[new], slots)
            self.hashes = np.insert(self.hashes, at[new], hashes[new])
        slot = self.slot[np.searchsorted(self.hashes, hashes)][inverse]
        size = self.begin[slot + 1] - self.begin[slot]
        flat = np.repeat(self.begin[slot] - (np.cumsum(size) - size), size) + np.arange(int(size.sum()))
        return np.repeat(words.row, size), self.tokens[flat]


class ByteWordTokens(WordTokens):
    """The same under a byte-level vocabulary of ranks."""

    def __init__(self, path: str):
        import public_tokenizers
        import tiktoken

        with open(path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self.model = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.size = max(ranks.values()) + 1
        self.clear()

    def encode(self, words: list[str]) -> list[list[int]]:
        one = self.model.encode_ordinary
        return [one(" " + w) for w in words]


def counted(words: Words, tokens: WordTokens) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(row, token) of every token, and each row's number of tokens and entropy."""
    row, token = tokens.of(words)
    n_tokens = np.bincount(row, minlength=words.rows)
    key, count = np.unique(row * tokens.size + token, return_counts=True)
    share = count / n_tokens[key // tokens.size]
    entropy = np.bincount(key // tokens.size, weights=-share * np.log2(share), minlength=words.rows)
    return row, token, n_tokens.astype(np.int64), np.abs(np.round(entropy, 9))


def measure(words: Words, tokens: WordTokens, multi: ByteWordTokens) -> dict[str, np.ndarray]:
    rows = words.rows
    n_words, chars = words.n_words(), words.word_chars()
    row, token, n_tokens, entropy = counted(words, tokens)
    n_bytes = np.bincount(row[tokens.is_byte[token]], minlength=rows)
    _, _, n_multi, entropy_multi = counted(words, multi)
    script = np.zeros((rows, len(SCRIPTS)), np.int64)
    kind = _SCRIPT[words.data]
    of_row = np.repeat(np.arange(rows), np.diff(words.offsets))
    np.add(script, np.bincount(of_row * len(SCRIPTS) + kind, minlength=script.size).reshape(script.shape), out=script)
    script[:, 0] = 0  # only letters decide
    return {
        "n_words": n_words, "word_chars": chars, "n_symbols": words.count_of(SYMBOLS), "n_dup_lines": words.lines()[1],
        "n_repeat_words": words.repeat_words(), "n_tokens": n_tokens,
        "chars_per_token": chars / np.maximum(n_tokens, 1), "byte_share": n_bytes / np.maximum(n_tokens, 1),
        "token_entropy": entropy, "n_tokens_multi": n_multi, "chars_per_token_multi": chars / np.maximum(n_multi, 1),
        "token_entropy_multi": entropy_multi, "script": script.argmax(axis=1),
    }


COLUMNS = ("n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean, "
           "kept boolean, script string, n_tokens long, chars_per_token double, byte_share double, token_entropy double, "
           "n_tokens_multi long, chars_per_token_multi double, token_entropy_multi double, lang string")


def limits(measured: DataFrame) -> DataFrame:
    """(lang, script, quartile and quartile distance of each of ``FENCED``) of all rows that pass the base rules."""
    bins = (measured.where("not base_failed")
            .select("lang", "script", F.explode(F.array(*[F.struct(F.lit(m).alias("measure"), F.floor(F.col(m) * STEPS).alias("bin")) for m in FENCED])).alias("x"))
            .groupBy("lang", "script", "x.measure", "x.bin").agg(F.count("*").alias("n")))
    group = ("lang", "script", "measure")
    upto = F.sum("n").over(Window.partitionBy(*group).orderBy("bin"))
    bins = bins.select(*group, "bin", upto.alias("upto"), F.sum("n").over(Window.partitionBy(*group)).alias("total"))
    quartile = lambda q: F.min(F.when(F.col("upto") * 4 >= F.col("total") * q, F.col("bin"))) / STEPS
    quartiles = bins.groupBy(*group).agg(quartile(1).alias("q1"), quartile(3).alias("q3"))
    columns = []
    for m, (side, least) in FENCED.items():
        own = lambda c, m=m: F.max(F.when(F.col("measure") == m, c))
        columns += [own(F.col("q1" if side == "below" else "q3")).alias(f"{m}_at"), own(F.greatest(F.col("q3") - F.col("q1"), F.lit(least))).alias(f"{m}_width")]
    return quartiles.groupBy("lang", "script").agg(*columns)


def judged(measured: DataFrame) -> DataFrame:
    """``measured`` with ``outlier``, and ``kept`` without the outliers."""
    bounds = materialized(limits(measured), "limits")
    if bounds.count() <= BROADCAST_GROUPS:
        bounds = F.broadcast(bounds)
    bounds = bounds.withColumnsRenamed({"lang": "_lang", "script": "_script"})
    stray = F.lit(FAR) * F.greatest(F.lit(1.0), F.sqrt(F.lit(TYPICAL_WORDS) / F.greatest("n_words", F.lit(1))))
    outlier = F.lit(False)
    for m, (side, _) in FENCED.items():
        reach = stray * F.col(f"{m}_width")
        outlier |= F.col(m) < F.col(f"{m}_at") - reach if side == "below" else F.col(m) > F.col(f"{m}_at") + reach
    outlier = ~F.col("base_failed") & F.coalesce(outlier, F.lit(False))
    rows = measured.join(bounds, F.col("lang").eqNullSafe(F.col("_lang")) & (F.col("script") == F.col("_script")), "left")
    return rows.select(*[(F.col("kept") & ~outlier).alias("kept") if c == "kept" else F.col(c) for c in measured.columns if c != "lang"], outlier.alias("outlier"))


def rules(docs: DataFrame, model: str | None = None, bands: dict[str, Band] | None = None, min_words: int = MIN_WORDS,
          multi_model: str | None = None) -> DataFrame:
    """The measures and the verdict of every row of ``docs`` (doc_id, text, and lang where there is one)."""
    path, multi_path = model or model_path(), multi_model or model_path("byte_bpe_multi_50k.tiktoken")
    own = [(bands or BANDS)[s] for s in SCRIPTS]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = multi = None
        least, most, byte_share, entropy, least_multi, entropy_multi = (
            np.array([getattr(b, f) for b in own]) for f in ("least", "most", "byte_share", "entropy", "least_multi", "entropy_multi"))
        for run in runs(batches):
            tokens = tokens or WordTokens(path)
            multi = multi or ByteWordTokens(multi_path)
            m = measure(Words.of(run.column("text")), tokens, multi)
            s = m["script"]
            failed = (m["n_words"] < min_words) | (100 * m["n_repeat_words"] > 50 * m["n_words"])
            inside = (((m["chars_per_token"] >= least[s]) | (m["chars_per_token_multi"] >= least_multi[s])) & (m["chars_per_token"] <= most[s])
                      & (m["byte_share"] <= byte_share[s]) & (m["token_entropy"] >= entropy[s])
                      & (m["token_entropy_multi"] >= entropy_multi[s]))
            cols = {"doc_id": run.column("doc_id"), **{k: pa.array(m[k]) for k in list(m)[:5]}, "base_failed": pa.array(failed),
                    "kept": pa.array(~failed & inside), "script": pa.array([SCRIPTS[i] for i in s.tolist()], pa.string()),
                    **{k: pa.array(m[k]) for k in ("n_tokens", "chars_per_token", "byte_share", "token_entropy",
                                                     "n_tokens_multi", "chars_per_token_multi", "token_entropy_multi")},
                    "lang": run.column("lang")}
            yield pa.RecordBatch.from_arrays(list(cols.values()), names=list(cols))

    lang = F.col("lang").cast("string") if "lang" in docs.columns else F.lit(None).cast("string")
    measured = docs.select("doc_id", "text", lang.alias("lang")).mapInArrow(work, "doc_id long, " + COLUMNS)
    return judged(materialized(measured, "fertility"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rules(table(spark, sf_dir, "documents"))
