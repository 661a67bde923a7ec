"""Operator 12: toxicity by a lexicon that is matched with misspellings and read in context.

The lexicon is learned: words of toxic training texts that stand in many different contexts there
(so copies of one text count once) and hardly in clean ones.  Its terms make a trie.  Every word of a
text runs through Levenshtein automata (0 errors for terms of up to 4 characters, 1 up to 7, 2 beyond)
intersected with that trie: a walk over the trie carries, for all words of one length at once, the band
of edit distances that is the automaton's state, and leaves every branch where no word is within its
terms' errors.  Near words that stand in clean training texts are ordinary words, not misspellings, and a term whose
near words keep turning up in single clean texts is matched exactly only.

Each hit gets a context-window score: quotation marks around it and reporting words near it speak for
quotation, context words weigh as the training texts' hits show.  A document's score is a logistic
regression over its strongest and its summed hits, exact and misspelled, and over quotation; where the
labels say nothing, stated priors hold.  labels, lang, source and doc_id are never inputs of a score.

Learned from at most ``TOXIC`` and ``CLEAN`` labelled rows outside the held-out fold, those whose doc_id
hashes smallest; lexicon, ordinary words and weights are bounded by that sample.

A word is a run of letters and digits (other characters from U+0080 on count as letters but for
punctuation and spaces), with the marks ``@$*!+`` between two of them; A-Z, Latin-1, Greek and Cyrillic
capitals are lowered.  Defined results: a null text is an empty one, and a text without hits has the
least score that the model gives; a null doc_id is never held out nor learned from; a null label is
skipped, differing labels of one document count by their mean, of a doc_id on several texts the least
text is learned.  Without labels of both kinds every score is 0.5.  Every input row gives one result
row; columns of other names are ignored.
"""

from __future__ import annotations

import math
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chronoweave.session import materialized

from .common import packed, runs, schema_of, table, utf8, word_spans

# labelled rows learned from, at most
TOXIC, CLEAN = 3_000, 4_000
# terms of the lexicon, at most; a term's least contexts, share of the toxic texts, ratio of the two
# kinds' rates of contexts, and share of toxic ones among its texts
TERMS, CONTEXTS, SHARE, RATIO, PRECISE = 400, 8, 0.01, 8.0, 0.85
ERRORS = 2
# near words that one clean text alone holds, from which on a term is matched exactly only
RARE = 2
# words on each side of a hit that are its context, and the buckets they are counted in
WINDOW, BUCKETS = 5, 4096
THRESHOLD = 0.7
# log-odds of abuse: of a hit as such, in quotation marks, beside a reporting word
AS_SUCH, QUOTED, REPORTED = 2.0, -3.0, -2.0
# prior means of the document model: bias, strongest exact hit, more of them, strongest near hit, more
# of them, quotation, mean context
PRIOR = np.array([-3.0, 6.0, 0.5, 2.5, 2.0, 0.0, 1.0])
PRECISION = np.array([0.01, 1.0, 1.0, 1.0, 1.0, 1.0, 1.0])
# fixed: words that report or mention what others say, in four languages
REPORTING = frozenset("""
say says said call calls called calling word words term terms phrase quote quotes quoted quoting write writes wrote written insult
insults slur slurs means meaning definition defined
sagt sagte sagen nennt nannte genannt wort worte begriff zitat zitiert schrieb beleidigung bedeutet
dit disait appelle appelait mot mots terme citation cite écrit insulte signifie
dice dijo decir llama llamó palabra palabras término cita escribió insulto significa
""".split())
MARKS = "@$*!+"
_OPEN, _CLOSE = (0x201C, 0x201E, 0xAB, 0x2039, 0x300C), (0x201D, 0xBB, 0x203A, 0x300D)


def _tables() -> tuple[np.ndarray, np.ndarray]:
    """(kind, lower case) of the first 65,536 code points; kind 1: in words, 2: a mark."""
    kind = np.zeros(1 << 16, np.uint8)
    for a, b in ((48, 58), (65, 91), (97, 123), (0xC0, 1 << 16)):
        kind[a:b] = 1
    kind[[0xAA, 0xB5, 0xBA]] = 1
    for a, b in ((0xD7, 0xD8), (0xF7, 0xF8), (0x2000, 0x2070), (0x2E00, 0x2E80), (0x3000, 0x3040), (0xFE10, 0xFE20), (0xFE30, 0xFE50), (0xFF00, 0xFF10)):
        kind[a:b] = 0
    kind[[ord(c) for c in MARKS]] = 2
    lower = np.arange(1 << 16, dtype=np.uint32)
    for a, b, step in ((65, 91, 32), (0xC0, 0xDF, 32), (0x391, 0x3AA, 32), (0x410, 0x430, 32), (0x400, 0x410, 80)):
        lower[a:b] += np.uint32(step)
    lower[0xD7] = 0xD7
    return kind, lower


_KIND, _LOWER = _tables()


@dataclass
class Words:
    """The words of a run of texts: code points (lowered), where words start and end, their rows."""

    points: np.ndarray
    raw: np.ndarray
    offsets: np.ndarray
    start: np.ndarray
    end: np.ndarray
    row: np.ndarray

    @staticmethod
    def of(column: pa.Array) -> Words:
        data, at = utf8(column)
        raw = np.frombuffer(data.tobytes().decode().encode("utf-32-le"), np.uint32)
        before = np.zeros(len(data) + 1, np.int64)
        np.cumsum((data & 0xC0) != 0x80, out=before[1:])
        offsets = before[at]
        small = np.minimum(raw, 0xFFFF)
        kind = _KIND[small]
        points = np.where(raw < 0x10000, _LOWER[small], raw)
        inside = kind == 1
        joined = inside.copy()
        joined[1:-1] |= (kind[1:-1] == 2) & inside[:-2] & inside[2:]
        start, end, row = word_spans(joined, offsets)
        return Words(points, raw, offsets, start, end, row)

    def text(self, i: int) -> str:
        return self.points[self.start[i]:self.end[i]].tobytes().decode("utf-32-le")


def errors_of(term: str) -> int:
    return 0 if len(term) <= 4 else 1 if len(term) <= 7 else ERRORS


@dataclass
class _Node:
    next: dict[int, _Node] = field(default_factory=dict)
    term: int = -1
    errors: int = 0  # most errors of the terms below


class Lexicon:
    """A trie of terms and its intersection with the words' Levenshtein automata; terms in ``exact``
    are matched without errors."""

    def __init__(self, terms: list[str], exact: frozenset[str] = frozenset()):
        self.terms = list(terms)
        self.errors = [0 if t in exact else errors_of(t) for t in terms]
        self.root = _Node()
        self.most = max(self.errors, default=0)
        for i, (t, errors) in enumerate(zip(terms, self.errors, strict=True)):
            node = self.root
            node.errors = max(node.errors, errors)
            for c in map(ord, t):
                node = node.next.setdefault(c, _Node())
                node.errors = max(node.errors, errors)
            node.term = i
        self.sizes = (min([len(t) - e for t, e in zip(terms, self.errors, strict=True)], default=1),
                      max([len(t) + e for t, e in zip(terms, self.errors, strict=True)], default=0))

    def hits(self, words: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(word, term, errors) of the words within a term's errors, each with its nearest term."""
        size = words.end - words.start
        found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        for n in range(max(1, self.sizes[0]), self.sizes[1] + 1):
            own = np.flatnonzero(size == n)
            if len(own):
                columns = [words.points[words.start[own] + j] for j in range(n)]
                self._walk(own, columns, n, found)
        if not found:
            none = np.empty(0, np.int64)
            return none, none, none
        word, term, errors = (np.concatenate(x) for x in zip(*found, strict=True))
        order = np.lexsort((term, errors, word))
        first = np.ones(len(order), bool)
        first[1:] = word[order][1:] != word[order][:-1]
        return word[order][first], term[order][first], errors[order][first]

    def _walk(self, own: np.ndarray, columns: list[np.ndarray], n: int, found: list) -> None:
        """Words of ``n`` characters through the trie.  The state at depth i holds, for j from
        i - most to i + most, the errors between the node's prefix and a word's first j characters."""
        most = self.most
        band, dead = 2 * most + 1, most + 1
        begin = [np.full(len(own), b - most if 0 <= b - most <= n else dead, np.uint8) for b in range(band)]
        stack = [(self.root, 0, begin, np.arange(len(own)))]
        while stack:
            node, depth, state, alive = stack.pop()
            near = {j: columns[j][alive] for j in range(max(0, depth - most), min(n, depth + most + 1))}
            nothing = np.full(len(alive), dead, np.uint8)
            for c, child in node.next.items():
                new: list[np.ndarray] = []
                for b in range(band):
                    j = depth + 1 - most + b
                    if j < 0 or j > n:
                        new.append(nothing)
                        continue
                    best = state[b + 1] + np.uint8(1) if b + 1 < band else nothing
                    if j:
                        best = np.minimum(best, state[b] + (near[j - 1] != c))
                    if b:
                        best = np.minimum(best, new[b - 1] + np.uint8(1))
                    new.append(np.minimum(best, np.uint8(dead)))
                at = n - depth - 1 + most
                if child.term >= 0 and 0 <= at < band:
                    hit = np.flatnonzero(new[at] <= self.errors[child.term])
                    if len(hit):
                        found.append((own[alive[hit]], np.full(len(hit), child.term), new[at][hit].astype(np.int64)))
                if child.next:
                    stay = np.flatnonzero(np.minimum.reduce(new) <= child.errors)
                    if len(stay):
                        stack.append((child, depth + 1, [x[stay] for x in new], alive[stay]))


@dataclass
class Hit:
    term: str
    word: str
    errors: int
    start: int  # in characters of the text
    end: int
    quoted: bool
    reported: bool
    context: list[int]  # buckets of the words around it


def hits_of(column: pa.Array, lexicon: Lexicon, ordinary: frozenset[str] = frozenset()) -> dict[int, list[Hit]]:
    """The hits of each row that has some."""
    words = Words.of(column)
    word, term, errors = lexicon.hits(words)
    if not len(word):
        return {}
    raw = words.raw
    place = np.arange(len(raw))
    line = np.zeros(len(raw), np.int64)  # where the line of each character starts
    line[1:] = np.where(raw[:-1] == 10, place[1:], 0)
    line[words.offsets[:-1][words.offsets[:-1] < len(raw)]] = words.offsets[:-1][words.offsets[:-1] < len(raw)]
    line = np.maximum.accumulate(line)
    marks = np.zeros(len(raw) + 1, np.int64)
    np.cumsum(raw == 0x22, out=marks[1:])
    opened = np.maximum.accumulate(np.where(np.isin(raw, _OPEN), place, -1))
    closed = np.maximum.accumulate(np.where(np.isin(raw, _CLOSE), place, -1))
    stop = np.append(np.flatnonzero((line[1:] != line[:-1])) + 1, len(raw))  # line ends
    at = words.start[word]
    ends = stop[np.searchsorted(stop, at, side="right")]
    odd = ((marks[at] - marks[line[at]]) % 2 == 1) & (marks[ends] > marks[at])
    quoted = odd | ((opened[at] >= line[at]) & (opened[at] > closed[at]))
    out: dict[int, list[Hit]] = {}
    for w, t, e, q in zip(word.tolist(), term.tolist(), errors.tolist(), quoted.tolist(), strict=True):
        text = words.text(w)
        if e and text in ordinary:
            continue
        row = int(words.row[w])
        low, high = (int(np.searchsorted(words.row, row, side=s)) for s in ("left", "right"))
        around = [words.text(i) for i in range(max(low, w - WINDOW), min(high, w + WINDOW + 1)) if i != w]
        base = int(words.offsets[row])
        out.setdefault(row, []).append(Hit(lexicon.terms[t], text, e, int(words.start[w]) - base, int(words.end[w]) - base, q,
                                           not REPORTING.isdisjoint(around), [zlib.crc32(x.encode()) % BUCKETS for x in around]))
    return out


@dataclass
class Model:
    terms: list[str]
    exact: frozenset[str]  # terms without near words
    ordinary: frozenset[str]
    context: np.ndarray  # log-odds of abuse by bucket
    weights: np.ndarray | None  # of the features; None: nothing learned

    def abuse(self, hit: Hit) -> tuple[float, float]:
        """(probability that a hit is abuse and not quotation, its learned context score)."""
        around = float(self.context[hit.context].mean()) * 2 if hit.context else 0.0
        x = AS_SUCH + QUOTED * hit.quoted + REPORTED * hit.reported + around
        return 1.0 / (1.0 + math.exp(-x)), around

    def features(self, hits: list[Hit]) -> np.ndarray:
        out = np.zeros(len(PRIOR))
        out[0] = 1.0
        if hits:
            scored = [(h.errors > 0, *self.abuse(h)) for h in hits]
            for near in (False, True):
                own = [a for n, a, _ in scored if n == near]
                if own:
                    out[1 + 2 * near], out[2 + 2 * near] = max(own), math.log1p(sum(own) - max(own))
            out[5] = max(1 - a for _, a, _ in scored)
            out[6] = sum(c for _, _, c in scored) / len(scored)
        return out

    def score(self, hits: list[Hit]) -> float:
        if self.weights is None:
            return 0.5
        return float(1.0 / (1.0 + np.exp(-np.clip(self.features(hits) @ self.weights, -30, 30))))


def held_out() -> F.Column:
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 1, F.lit(False))


def sample_of(docs: DataFrame, labels: DataFrame, toxic: int = TOXIC, clean: int = CLEAN) -> DataFrame:
    """(doc_id, label, text) of the training rows, written."""
    label = (labels.where("toxic is not null and doc_id is not null").where(~held_out())
             .groupBy("doc_id").agg((F.avg("toxic") >= 0.5).cast("int").alias("label")))
    label = label.join(docs.select("doc_id").where("doc_id is not null").distinct(), "doc_id", "left_semi")
    order = [F.xxhash64("doc_id"), F.col("doc_id")]
    picked = label.where("label = 1").orderBy(*order).limit(toxic).union(label.where("label = 0").orderBy(*order).limit(clean))
    # at most ``toxic + clean`` small rows are broadcast
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).join(F.broadcast(picked), "doc_id")
    return materialized(rows.groupBy("doc_id", "label").agg(F.min("text").alias("text")), "toxicity-sample")


def learn_terms(sample: DataFrame) -> list[str]:
    """The lexicon, most telling terms first."""

    def contexts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for run in runs(batches):
            words = Words.of(run.column("text"))
            text = [words.text(i) for i in range(len(words.row))]
            doc, label = (run.column(c).to_pylist() for c in ("doc_id", "label"))
            seen = set()
            for i, (w, row) in enumerate(zip(text, words.row.tolist(), strict=True)):
                before = text[i - 1] if i and words.row[i - 1] == row else ""
                after = text[i + 1] if i + 1 < len(text) and words.row[i + 1] == row else ""
                seen.add((w, zlib.crc32(f"{before} {after}".encode()), doc[row], label[row]))
            if seen:
                yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(zip(*seen, strict=True), (pa.string(), pa.int64(), pa.int64(), pa.int32()), strict=True)],
                                                 names=["word", "context", "doc", "label"])

    rows = sample.mapInArrow(contexts, "word string, context long, doc long, label int")
    toxic, clean = F.col("label") == 1, F.col("label") == 0
    by = rows.groupBy("word").agg(F.count_distinct(F.when(toxic, F.col("context"))).alias("t"), F.count_distinct(F.when(clean, F.col("context"))).alias("c"),
                                  F.count_distinct(F.when(toxic, F.col("doc"))).alias("texts"), F.count_distinct(F.when(clean, F.col("doc"))).alias("others"))
    sizes = {r["label"]: r["count"] for r in sample.groupBy("label").count().collect()}
    if len(sizes) < 2:
        return []
    by = by.where(F.col("texts") >= PRECISE * (F.col("texts") + F.col("others")))
    by = by.where((F.col("t") >= CONTEXTS) & (F.col("texts") >= max(5, math.ceil(SHARE * sizes[1]))) & (F.length("word") >= 3))
    ratio = (F.col("t") / F.lit(sizes[1])) / ((F.col("c") + 1) / F.lit(sizes[0]))
    best = by.where(ratio >= RATIO).orderBy(ratio.desc(), "word").limit(TERMS).select("word").collect()
    return [r["word"] for r in best]


def train(docs: DataFrame, labels: DataFrame) -> Model:
    sample = sample_of(docs, labels)
    terms = learn_terms(sample)
    plain = np.zeros(BUCKETS)
    lexicon = Lexicon(terms)

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for run in runs(batches):
            label, doc = (run.column(c).to_pylist() for c in ("label", "doc_id"))
            out = [(label[row], doc[row], h.term, h.word if h.errors else None, h.context) for row, hits in hits_of(run.column("text"), lexicon).items() for h in hits]
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(zip(*out, strict=True), (pa.int32(), pa.int64(), pa.string(), pa.string(), pa.list_(pa.int32())), strict=True)],
                                                 names=["label", "doc", "term", "near", "context"])

    hits = sample.mapInArrow(found, "label int, doc long, term string, near string, context array<int>")
    toxic, clean = F.sum(F.col("label")), F.sum(1 - F.col("label"))
    sizes = {r["label"]: r["count"] for r in sample.groupBy("label").count().collect()}
    if len(sizes) < 2:
        return Model([], frozenset(), frozenset(), plain, None)
    rate = sizes[1] / sizes[0]
    # near words of clean texts, unless they are far commoner in toxic ones; bounded by the sample's words
    near = (hits.where("near is not null").groupBy("term", "near").agg(
        F.count_distinct(F.when(F.col("label") == 1, F.col("doc"))).alias("t"), F.count_distinct(F.when(F.col("label") == 0, F.col("doc"))).alias("c"))
        .where((F.col("c") > 0) & (F.col("t") < RATIO * rate * F.col("c"))).collect())
    ordinary = frozenset(r["near"] for r in near)
    # words that one text alone holds foretell further ones that no text of the sample holds
    rare = Counter(r["term"] for r in near if r["c"] == 1)
    exact = frozenset(t for t, n in rare.items() if n >= RARE)
    lexicon = Lexicon(terms, exact)
    around = hits.select("label", "term", "near", F.explode("context").alias("bucket"))
    for out, among in ((ordinary, "near"), (exact, "term")):
        if out:
            around = around.where(F.col("near").isNull() | ~F.col(among).isin(*out))
    counts = around.groupBy("bucket").agg(toxic.alias("t"), clean.alias("c")).collect()  # a row a bucket
    context = plain.copy()
    all_t, all_c = sum(r["t"] for r in counts), sum(r["c"] for r in counts)
    if min(all_t, all_c) >= 20 * WINDOW:
        for r in counts:
            context[r["bucket"]] = np.clip(math.log((r["t"] + 2) / (r["c"] * all_t / all_c + 2)), -1.5, 1.5)
    model = Model(terms, exact, ordinary, context, None)

    def described(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for run in runs(batches):
            hits = hits_of(run.column("text"), lexicon, model.ordinary)
            rows = [model.features(hits.get(i, [])).tolist() for i in range(run.num_rows)]
            yield pa.RecordBatch.from_arrays([run.column("doc_id"), run.column("label"), pa.array(rows, pa.list_(pa.float64()))], names=["doc_id", "label", "x"])

    got = sample.mapInArrow(described, "doc_id long, label int, x array<double>").toPandas().sort_values("doc_id")
    model.weights = fit(np.stack(got["x"].to_list()), got["label"].to_numpy(float))
    return model


def fit(x: np.ndarray, y: np.ndarray, steps: int = 40) -> np.ndarray:
    """Logistic regression by Newton's method around the priors, its step halved where it overshoots."""
    def loss(w: np.ndarray) -> float:
        z = x @ w
        return float((np.logaddexp(0, z) - y * z).sum() + 0.5 * (PRECISION * (w - PRIOR) ** 2).sum())

    w = PRIOR.copy()
    for _ in range(steps):
        p = 1.0 / (1.0 + np.exp(-np.clip(x @ w, -30, 30)))
        slope = x.T @ (p - y) + PRECISION * (w - PRIOR)
        bend = (x * (p * (1 - p))[:, None]).T @ x + np.diag(PRECISION)
        step, now = np.linalg.solve(bend, slope), loss(w)
        while loss(w - step) > now + 1e-12 and np.abs(step).max() > 1e-9:
            step = step / 2
        w = w - step
        if np.abs(step).max() < 1e-9:
            break
    return w


HITS = "hits array<struct<term: string, word: string, errors: int, start: int, end: int, abuse: double>>"


def scores(docs: DataFrame, model: Model, hits: bool = False) -> DataFrame:
    """(row, score) of every row of ``docs``, with the text's hits if asked for; row holds the other
    columns."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # lexicon and weights, bounded by the sample

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lexicon = None
        for run in runs(batches):
            m = shared.value
            lexicon = lexicon or Lexicon(m.terms, m.exact)
            found = hits_of(run.column("text"), lexicon, m.ordinary)
            none = m.score([])
            score = np.full(run.num_rows, none)
            for row, own in found.items():
                score[row] = m.score(own)
            out = {"row": run.column("row"), "score": pa.array(score)}
            if hits:
                out["hits"] = pa.array([[{"term": h.term, "word": h.word, "errors": h.errors, "start": h.start, "end": h.end, "abuse": m.abuse(h)[0]} for h in found.get(i, [])]
                                        for i in range(run.num_rows)], _HITS)
            yield pa.RecordBatch.from_arrays(list(out.values()), names=list(out))

    return docs.select(packed(docs), "text").mapInArrow(work, schema_of(docs, "score double" + f", {HITS}" * hits))


_HITS = pa.list_(pa.struct([("term", pa.string()), ("word", pa.string()), ("errors", pa.int32()), ("start", pa.int32()), ("end", pa.int32()), ("abuse", pa.float64())]))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    out = scores(docs, train(docs, table(spark, sf_dir, "labels")))
    return out.select("row.doc_id", "score").select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
