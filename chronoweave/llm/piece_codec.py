"""Operator 9: piece encoding and decoding in numpy, all distinct words of equal length together.

The model file gives pieces and scores.  A text becomes ``mark + text`` with spaces as marks and
is cut into words before each run of marks and around line feeds (no piece crosses such a place;
checked when the model is read).  Distinct words of equal length advance together; the hashes of
their substrings probe the sorted piece keys.  A character without a piece becomes its UTF-8 byte
pieces.  Decoding gathers the pieces' bytes and drops the first mark.

Three rules choose the pieces.  ``links`` (the default) is a Viterbi that gives the library's ids,
though the model file's scores are ranks of merges and no sums.  A piece scores 0 behind the last
piece at its start if the two are linked (joined and merged, they come out as just these two) and
minus infinity otherwise; each end position keeps the piece with score 0 as its backpointer.  There
is always exactly one: merges inside a prefix never see what follows it, so the encoding of a prefix
without its last piece is the encoding of the shorter prefix; and where all neighbours are linked, the
first merge over one of their borders would have happened to those two alone.  Links are decided once
a pair and remembered in a table by pair.  ``merges`` merges whole words, in each round every word its
neighbours of best rank (the first of equals).  ``scores`` is the Viterbi for models whose scores do
add up: the segmentation of greatest sum, at equal sums the longer last piece wins.

Defined results: null and empty texts have no pieces and decode to the empty text; a text that
itself holds the mark decodes with a space there (``roundtrip`` false), as in the library.
"""

from __future__ import annotations

import heapq
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import mix64, prefix_hash, range_hash, runs, table, utf8
from .token_counts import MARK, model_path

# ids of distinct words remembered per task
REMEMBERED = 6_000_000
# places for pairs of pieces whose links are remembered per task, a power of two
PAIRS = 1 << 22
# pairs below which they are merged one by one
FEW = 16
# the shift that leaves the place in the filter before the piece keys
THERE = np.uint64(64 - 21)
# cells (words x positions) that advance together
CELLS = 1_000_000
# characters above which a word is walked through alone
LONG = 256
_MULT = np.uint64(0x2545F4914F6CDD1D)
# the rank of neighbours that make no piece
NONE = np.iinfo(np.int32).max
RULES = ("scores", "merges", "links")
_MARK_BYTES = MARK.encode()


def ranges(begin: np.ndarray, size: np.ndarray) -> np.ndarray:
    """begin[0], begin[0]+1, ... (size[0] numbers), begin[1], ..."""
    return np.repeat(begin - (np.cumsum(size) - size), size) + np.arange(int(size.sum()))


class PieceCodec:
    def __init__(self, path: str, rule: str = "scores"):
        import sentencepiece

        if rule not in RULES:
            raise ValueError(f"rule must be one of {RULES}")
        self.words, self.lone_word = {"scores": (self.viterbi, self.viterbi_long), "merges": (self.merge, self.merge_long),
                                      "links": (self.linked, self.linked_long)}[rule]
        model = sentencepiece.SentencePieceProcessor(model_file=path)
        n = model.vocab_size()
        text = [model.id_to_piece(i) for i in range(n)]
        self.byte_id = np.full(256, -1, np.int32)
        out: list[bytes] = [t.replace(MARK, " ").encode() for t in text]
        ids = []
        for i in range(n):
            if model.is_byte(i):
                value = int(text[i][3:5], 16)
                self.byte_id[value] = i
                out[i] = bytes([value])
            elif model.is_control(i) or model.is_unknown(i) or model.is_unused(i):
                out[i] = b""
            else:
                ids.append(i)
        if any(MARK in text[i].lstrip(MARK) or "\n" in text[i] for i in ids):
            raise ValueError("a piece crosses a place where words are cut")
        self.is_byte = np.isin(np.arange(n), self.byte_id)
        self.out = np.frombuffer(b"".join(out), np.uint8)
        self.out_size = np.array([len(b) for b in out], np.int64)
        self.out_begin = np.cumsum(self.out_size) - self.out_size
        self.longest = max(len(text[i]) for i in ids)
        unmixed = np.array([self._sum([ord(c) for c in text[i]]) for i in ids], np.uint64)
        keys = mix64(unmixed)
        self.there = np.zeros(1 << 21, bool)
        self.there[(unmixed * _MULT) >> THERE] = True
        order = np.argsort(keys)
        self.keys, self.ids = keys[order], np.array(ids, np.int32)[order]
        if (self.keys[1:] == self.keys[:-1]).any():
            raise ValueError("two pieces share a key")
        # the pieces' characters, to confirm each probe
        self.chars = np.zeros((len(ids), self.longest), np.uint32)
        for row, i in enumerate(self.ids.tolist()):
            self.chars[row, :len(text[i])] = [ord(c) for c in text[i]]
        self.scores = np.array([model.get_score(int(i)) for i in self.ids], np.float64)
        self.unknown = self.scores.min() - 10.0
        # equal scores have equal ranks
        self.rank = np.unique(-self.scores, return_inverse=True)[1].astype(np.int32)
        self.ranks = self.rank.tolist()
        self.row = {text[i]: row for row, i in enumerate(self.ids.tolist())}
        # symbols: rows of the piece table, then characters without a piece, then what stands before a word
        self.size = (self.chars > 0).sum(axis=1)
        self.lone, self.front = len(self.keys), len(self.keys) + 0x110000
        self.forget_links()
        self.power = np.cumprod(np.concatenate([[np.uint64(1)], np.full(self.longest, _MULT)]))
        self.clear()

    @staticmethod
    def _sum(chars: list[int]) -> int:
        h = 0
        for c in chars:
            h = (h * int(_MULT) + c + 1) & 0xFFFFFFFFFFFFFFFF
        return (h + len(chars)) & 0xFFFFFFFFFFFFFFFF

    def clear(self) -> None:
        self.hashes = np.empty(0, np.uint64)  # of known words, sorted
        self.slot = np.empty(0, np.int64)
        self.begin = np.zeros(1, np.int64)  # by slot, into pieces
        self.pieces = np.empty(0, np.int32)

    def forget_links(self) -> None:
        self.pairs = np.full(PAIRS, -1, np.int64)  # by place: the pair, and in the last bit whether it is linked
        self.pair_shift = np.uint64(64 - PAIRS.bit_length() + 1)
        self.lone_pairs: dict[tuple[int, int], bool] = {}

    def viterbi(self, chars: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Words of one length (rows of characters): (ids one word after another, ids a word)."""
        n, length = chars.shape
        wide = chars.astype(np.uint64) + np.uint64(1)
        best = np.full((length + 1, n), -np.inf)
        best[0] = 0.0
        back = np.zeros((length + 1, n), np.int8 if self.longest < 128 else np.int32)  # length of the last piece
        piece = np.full((length + 1, n), -1, np.int32)  # its row in the piece table, -1 unknown
        recent: list[np.ndarray] = []  # hashes of the substrings that end here, by length
        for end in range(1, length + 1):
            last = wide[:, end - 1]
            recent = [last.copy()] + [h * _MULT + last for h in recent[: self.longest - 1]]
            for size in range(len(recent), 0, -1):
                begin = end - size
                key = mix64(recent[size - 1] + np.uint64(size))
                at = np.searchsorted(self.keys, key)
                at[at == len(self.keys)] = 0
                hit = self.keys[at] == key
                if hit.any():
                    hit[hit] = (self.chars[at[hit], :size] == chars[hit, begin:end]).all(axis=1)
                if size > 1:
                    hit = np.flatnonzero(hit)
                    score = best[begin, hit] + self.scores[at[hit]]
                    better = score > best[end, hit]
                    hit, score = hit[better], score[better]
                    best[end, hit], back[end, hit], piece[end, hit] = score, size, at[hit]
                else:
                    score = best[begin] + np.where(hit, self.scores[at], self.unknown)
                    better = score > best[end]
                    best[end] = np.where(better, score, best[end])
                    back[end, better] = 1
                    piece[end, better] = np.where(hit, at, -1)[better]
        # all words walk back together; an unknown character gives its bytes, last first
        at, word, steps = np.full(n, length), np.arange(n), []
        while len(word):
            size, row = back[at, word].astype(np.int64), piece[at, word]
            ids = np.where(row >= 0, self.ids[row], -1)
            code = chars[word, at - 1]
            ids[row < 0] = self.byte_id[np.minimum(code[row < 0], 255)]
            wide_code = np.flatnonzero((row < 0) & (code >= 128))
            if len(wide_code):
                for j in wide_code.tolist():
                    raw = chr(int(code[j])).encode()
                    for b in raw[:0:-1]:
                        steps.append((word[j:j + 1], self.byte_id[b:b + 1].copy()))
                    ids[j] = self.byte_id[raw[0]]
            steps.append((word, ids))
            at = at - size
            word, at = word[at > 0], at[at > 0]
        who, ids = np.concatenate([w for w, _ in steps])[::-1], np.concatenate([i for _, i in steps])[::-1]
        order = np.argsort(who, kind="stable")
        return ids[order], np.bincount(who, minlength=n)

    def viterbi_long(self, chars: np.ndarray) -> list[int]:
        """One long word: each piece length probes all positions at once, then one walk."""
        length, found = len(chars), self.substrings(chars)
        best, back = [0.0] + [-np.inf] * length, [(0, 0)] * (length + 1)
        scores = self.scores.tolist()
        for end in range(1, length + 1):
            lone = True
            for size, row in reversed(found[end]):
                lone &= size > 1
                score = best[end - size] + scores[row]
                if score > best[end]:
                    best[end], back[end] = score, (size, row)
            if lone and best[end - 1] + self.unknown > best[end]:
                best[end], back[end] = best[end - 1] + self.unknown, (1, -1)
        out, end = [], length
        while end > 0:
            size, row = back[end]
            out.extend([int(self.ids[row])] if row >= 0 else [int(self.byte_id[b]) for b in reversed(chr(int(chars[end - 1])).encode())])
            end -= size
        return out[::-1]

    def substrings(self, chars: np.ndarray) -> list[list[tuple[int, int]]]:
        """By end position: (length, row of the piece table) of each piece that ends there, shortest first."""
        length = len(chars)
        found: list[list[tuple[int, int]]] = [[] for _ in range(length + 1)]
        running = np.zeros(length + 1, np.uint64)
        for size in range(1, min(self.longest, length) + 1):
            running = running[:length - size + 1] * _MULT + chars[size - 1:].astype(np.uint64) + np.uint64(1)
            key = mix64(running + np.uint64(size))
            at = np.searchsorted(self.keys, key)
            at[at == len(self.keys)] = 0
            hit = np.flatnonzero(self.keys[at] == key)
            same = (self.chars[at[hit], :size] == chars[hit[:, None] + np.arange(size)]).all(axis=1)
            for begin, row in zip(hit[same].tolist(), at[hit[same]].tolist(), strict=True):
                found[begin + size].append((size, row))
        return found

    def probe(self, chars: np.ndarray, prefix: np.ndarray, word: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
        """The piece table's row of each substring, -1 for none."""
        row = np.full(len(word), -1)
        fits = np.flatnonzero(end - begin <= self.longest)
        word, begin, size = word[fits], begin[fits], (end - begin)[fits]
        key = mix64(prefix[word, begin + size] - prefix[word, begin] * self.power[size] + size.astype(np.uint64))
        at = np.searchsorted(self.keys, key)
        at[at == len(self.keys)] = 0
        hit = np.flatnonzero(self.keys[at] == key)
        # confirmed character by character; a piece ends at its first 0
        at, word, begin, size = at[hit], word[hit], begin[hit], size[hit]
        same = np.ones(len(hit), bool)
        for i in range(int(size.max(initial=0))):
            inside = np.flatnonzero(size > i)
            same[inside] &= self.chars[at[inside], i] == chars[word[inside], begin[inside] + i]
        row[fits[hit[same]]] = at[same]
        return row

    def merged(self, chars: np.ndarray) -> np.ndarray:
        """Where the piece that begins at each position ends (0: none begins there), by merges: a round
        merges the best neighbours of every word."""
        n, length = chars.shape
        prefix = self.prefixes(chars)
        place = np.arange(length)
        after = np.tile(place + 1, (n, 1))  # where the symbol that begins here ends, 0 for none
        before = np.tile(place - 1, (n, 1))  # where the symbol before it begins
        rank = np.full((n, length), NONE, np.int32)  # of the symbol and the next one

        def ranked(word: np.ndarray, begin: np.ndarray, end: np.ndarray) -> None:
            row = self.probe(chars, prefix, word, begin, end)
            rank[word, begin] = np.where(row >= 0, self.rank[row], NONE)

        if length > 1:
            ranked(np.repeat(np.arange(n), length - 1), np.tile(place[:-1], n), np.tile(place[:-1] + 2, n))
        word = np.arange(n)
        while len(word):
            begin = rank[word].argmin(axis=1)
            found = rank[word, begin] != NONE
            word, begin = word[found], begin[found]
            gone = after[word, begin]
            end = after[word, gone]
            after[word, begin], after[word, gone], rank[word, gone], rank[word, begin] = end, 0, NONE, NONE
            more = end < length
            before[word[more], end[more]] = begin[more]
            ranked(word[more], begin[more], after[word[more], end[more]])
            more = begin > 0
            ranked(word[more], before[word[more], begin[more]], end[more])
        return after

    def merge(self, chars: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """As ``viterbi``, by merges."""
        after = self.merged(chars)
        word, begin = np.nonzero(after)
        return self.ids_of(chars, word, begin, self.probe(chars, self.prefixes(chars), word, begin, after[word, begin]))

    def ids_of(self, chars: np.ndarray, word: np.ndarray, begin: np.ndarray, row: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the pieces that begin at the given places, and ids a word; a character without a row
        gives its bytes."""
        ids, count = self.ids[row], np.ones(len(row), np.int64)
        lone = np.flatnonzero(row < 0)  # single characters
        if len(lone):
            code = chars[word[lone], begin[lone]]
            raw = [chr(c).encode() for c in code.tolist()]
            count[lone] = [len(r) for r in raw]
            ids = np.repeat(ids, count)
            first = (np.cumsum(count) - count)[lone]
            ids[ranges(first, count[lone])] = self.byte_id[np.frombuffer(b"".join(raw), np.uint8)]
        return ids, np.bincount(word, weights=count, minlength=len(chars)).astype(np.int64)

    def prefixes(self, chars: np.ndarray) -> np.ndarray:
        n, length = chars.shape
        prefix = np.zeros((n, length + 1), np.uint64)
        for i in range(length):
            prefix[:, i + 1] = prefix[:, i] * _MULT + chars[:, i].astype(np.uint64) + np.uint64(1)
        return prefix

    def text_of(self, symbol: int) -> str:
        if symbol >= self.lone:
            return chr(symbol - self.lone) if symbol < self.front else ""
        return self.chars[symbol, :self.size[symbol]].tobytes().decode("utf-32-le")

    def decide(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Which pairs of symbols are linked, by merging their joined texts."""
        if len(left) < FEW:
            texts = [(self.text_of(a), self.text_of(b)) for a, b in zip(left.tolist(), right.tolist(), strict=True)]
            return np.array([self.heap_merged(a + b) == ([len(a), len(a + b)] if a else [len(b)]) for a, b in texts], bool)
        (a, border), (b, behind) = self.texts_of(left), self.texts_of(right)
        size = border + behind
        linked = np.zeros(len(left), bool)
        # shorter texts are filled up with 0, which no piece holds
        length = int(size.max(initial=1))
        step = max(1, CELLS // length)
        for i in range(0, len(left), step):
            first, total, place = border[i:i + step, None], size[i:i + step, None], np.arange(length)
            part = np.arange(i, i + len(first))[:, None]
            chars = np.where(place < first, a[part, np.minimum(place, self.longest - 1)], b[part, np.clip(place - first, 0, self.longest - 1)])
            after = self.merged(np.where(place < total, chars, 0).astype(np.uint32))
            first, total = first[:, 0], total[:, 0]
            linked[i:i + step] = (after[np.arange(len(first)), first] == total) & ((first == 0) | (after[:, 0] == first))
        return linked

    def texts_of(self, symbols: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(characters, as in the piece table; their number) of each symbol."""
        piece = symbols < self.lone
        row = np.where(piece, symbols, 0)
        chars, size = self.chars[row], np.where(piece, self.size[row], symbols < self.front)
        chars[~piece, 0] = symbols[~piece] - self.lone
        return chars, size

    def are_linked(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Which pairs of symbols stay as they are when they stand side by side."""
        keys = (left.astype(np.int64) << 21) | right
        place = (mix64(keys.view(np.uint64)) >> self.pair_shift).astype(np.int64)
        held = self.pairs[place]
        out, new = (held & 1).astype(bool), np.flatnonzero(held >> 1 != keys)
        if len(new):
            fresh, first, inverse = np.unique(keys[new], return_index=True, return_inverse=True)
            linked = self.decide(fresh >> 21, fresh & ((1 << 21) - 1))
            out[new] = linked[inverse]
            # a pair takes the place of another that was there
            self.pairs[place[new[first]]] = fresh << 1 | linked
        return out

    def hits(self, recent: np.ndarray, chars: np.ndarray, end: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(word, length, row of the piece table) of the pieces that end at ``end``; ``recent``: unmixed
        hashes of the substrings that end there, by length."""
        place = recent * _MULT
        place >>= THERE
        size, word = np.nonzero(self.there[place])
        key = mix64(recent[size, word])
        at = np.searchsorted(self.keys, key)
        at[at == len(self.keys)] = 0
        same = self.keys[at] == key
        size, word, at = size[same] + 1, word[same], at[same]
        # confirmed character by character, the last first
        same = np.ones(len(word), bool)
        for i in range(int(size.max(initial=0))):
            inside = np.flatnonzero(size > i)
            same[inside] &= self.chars[at[inside], size[inside] - 1 - i] == chars[word[inside], end - 1 - i]
        return word[same], size[same], at[same]

    def linked(self, chars: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """As ``viterbi``, by links."""
        n, length = chars.shape
        wide = chars.astype(np.uint64) + np.uint64(1)
        back = np.zeros((length + 1, n), np.int8 if self.longest < 128 else np.int32)  # length of the last piece
        last = np.full((length + 1, n), self.front, np.int32)  # its symbol
        lengths = np.arange(1, self.longest + 1, dtype=np.uint64)[:, None]
        recent = np.zeros((self.longest, n), np.uint64)  # hashes of the substrings that end here, by length
        for end in range(1, length + 1):
            recent[1:] = recent[:-1] * _MULT
            recent[0] = 0
            recent += wide[:, end - 1]
            have = min(end, self.longest)
            word, size, symbol = self.hits(recent[:have] + lengths[:have], chars, end)
            # a character without a piece stands for itself
            alone = np.ones(n, bool)
            alone[word[size == 1]] = False
            alone = np.flatnonzero(alone)
            word, size = np.concatenate([word, alone]), np.concatenate([size, np.ones(len(alone), np.int64)])
            symbol = np.concatenate([symbol, self.lone + chars[alone, end - 1].astype(np.int64)])
            best = np.flatnonzero(self.are_linked(last[end - size, word], symbol))
            word = word[best]
            if (np.bincount(word, minlength=n) != 1).any():
                raise RuntimeError("a prefix of a word has not just one last piece")
            back[end, word], last[end, word] = size[best], symbol[best]
        # all words walk back together
        at, word, steps = np.full(n, length), np.arange(n), []
        while len(word):
            begin = at - back[at, word]
            steps.append((word, begin, last[at, word]))
            word, at = word[begin > 0], begin[begin > 0]
        word, begin, row = (np.concatenate(c) for c in zip(*steps, strict=True))
        order = np.lexsort((begin, word))
        return self.ids_of(chars, word[order], begin[order], np.where(row < self.lone, row, -1)[order])

    def linked_long(self, chars: np.ndarray) -> list[int]:
        """One long word by links: as ``viterbi_long``, pairs one by one."""
        length, found = len(chars), self.substrings(chars)
        back, last = [0] * (length + 1), [self.front] * (length + 1)
        if len(self.lone_pairs) > PAIRS:
            self.lone_pairs = {}
        known = self.lone_pairs
        for end in range(1, length + 1):
            ends = found[end]
            if not ends or ends[0][0] > 1:
                ends = [(1, self.lone + int(chars[end - 1])), *ends]
            for size, symbol in ends:
                pair = (last[end - size], symbol)
                linked = known.get(pair)
                if linked is None:
                    a, b = self.text_of(pair[0]), self.text_of(symbol)
                    linked = known[pair] = self.heap_merged(a + b) == ([len(a), len(a + b)] if a else [len(b)])
                if linked:
                    back[end], last[end] = size, symbol
                    break
            else:
                raise RuntimeError("a prefix of a word has no last piece")
        out, end = [], length
        while end > 0:
            row = last[end]
            out.extend([int(self.ids[row])] if row < self.lone else [int(self.byte_id[b]) for b in reversed(chr(row - self.lone).encode())])
            end -= back[end]
        return out[::-1]

    def merge_long(self, chars: np.ndarray) -> list[int]:
        """One long word by merges."""
        text, out, at = chars.tobytes().decode("utf-32-le"), [], 0
        for end in self.heap_merged(text):
            row = self.row.get(text[at:end])
            out.extend([int(self.ids[row])] if row is not None else [int(self.byte_id[b]) for b in text[at].encode()])
            at = end
        return out

    def heap_merged(self, text: str) -> list[int]:
        """Where the pieces of a text end, by merges: a heap of neighbours by rank and place."""
        length, rank = len(text), self.ranks
        after, before, heap = list(range(1, length + 1)), list(range(-1, length - 1)), []

        def push(begin: int, end: int) -> None:
            row = self.row.get(text[begin:end]) if end - begin <= self.longest else None
            if row is not None:
                heapq.heappush(heap, (rank[row], begin, end))

        for i in range(length - 1):
            push(i, i + 2)
        while heap:
            _, begin, end = heapq.heappop(heap)
            gone = after[begin]
            # merged away meanwhile, or grown
            if not gone or gone >= end or after[gone] != end:
                continue
            after[begin], after[gone] = end, 0
            if end < length:
                before[end] = begin
                push(begin, after[end])
            if begin > 0:
                push(before[begin], end)
        out, at = [], 0
        while at < length:
            at = after[at]
            out.append(at)
        return out

    def _learn(self, hashes: np.ndarray, words: list[str]) -> None:
        size = np.array([len(w) for w in words])
        counts, ids = np.zeros(len(words), np.int64), {}
        for j in np.flatnonzero(size > LONG).tolist():
            ids[j] = np.array(self.lone_word(np.frombuffer(words[j].replace(" ", MARK).encode("utf-32-le"), np.uint32)), np.int32)
            counts[j] = len(ids[j])
        for length in np.unique(size[size <= LONG]).tolist():
            group = np.flatnonzero(size == length)
            step = max(1, CELLS // (length + 1))
            for i in range(0, len(group), step):
                part = group[i:i + step]
                chars = np.frombuffer("".join([words[j] for j in part.tolist()]).replace(" ", MARK).encode("utf-32-le"), np.uint32)
                flat, count = self.words(chars.reshape(len(part), length))
                counts[part] = count
                ids.update(zip(part.tolist(), np.split(flat, np.cumsum(count)[:-1]), strict=True))
        slots = np.arange(len(words)) + len(self.begin) - 1
        self.begin = np.concatenate([self.begin, self.begin[-1] + np.cumsum(counts)])
        self.pieces = np.concatenate([self.pieces, *(ids[j] for j in range(len(words)))])
        at = np.searchsorted(self.hashes, hashes)
        self.slot, self.hashes = np.insert(self.slot, at, slots), np.insert(self.hashes, at, hashes)

    def encode(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all rows one after another, ids a row)."""
        data, offsets = utf8(column)
        rows = len(offsets) - 1
        if _MARK_BYTES in data.tobytes():
            data, offsets = utf8(pa.array([(t or "").replace(MARK, " ") for t in column.to_pylist()], pa.large_string()))
        full = np.flatnonzero(np.diff(offsets))
        if not len(full):
            return np.empty(0, np.int32), np.zeros(rows, np.int64)
        start = offsets[:-1][full]
        data = np.insert(data, start, 32)  # each text's first mark
        start = start + np.arange(len(full))
        # a word begins at a text's start, before a run of spaces, and before and behind a line feed
        space, feed = data == 32, data == 10
        cut = feed.copy()
        cut[1:] |= (space[1:] & ~space[:-1]) | feed[:-1]
        cut[start] = True
        # behind a line feed the run of spaces is one word with what follows, as everywhere
        begin = np.flatnonzero(cut)
        end = np.append(begin[1:], len(data))
        row = full[np.searchsorted(start, begin, side="right") - 1]
        hashes, first, inverse = np.unique(range_hash(prefix_hash(data), begin, end, data), return_index=True, return_inverse=True)
        if len(self.pieces) > REMEMBERED:
            self.clear()
        at = np.searchsorted(self.hashes, hashes)
        new = np.ones(len(hashes), bool)
        inside = at < len(self.hashes)
        new[inside] = self.hashes[at[inside]] != hashes[inside]
        if new.any():
            raw = data.tobytes()
            self._learn(hashes[new], [raw[begin[i]:end[i]].decode() for i in first[new].tolist()])
        slot = self.slot[np.searchsorted(self.hashes, hashes)][inverse]
        size = self.begin[slot + 1] - self.begin[slot]
        return self.pieces[ranges(self.begin[slot], size)], np.bincount(row, weights=size, minlength=rows).astype(np.int64)

    def decode(self, ids: np.ndarray, per_row: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(bytes of all rows one after another, row offsets), each without its first mark."""
        size = self.out_size[ids]
        data = self.out[ranges(self.out_begin[ids], size)]
        ends = np.concatenate([[0], np.cumsum(size)])[np.cumsum(per_row)]
        offsets = np.concatenate([[0], ends])
        full = np.diff(offsets) > 0
        data = np.delete(data, offsets[:-1][full])
        return data, offsets - np.concatenate([[0], np.cumsum(full)])


def same_rows(column: pa.Array, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Which rows of ``column`` hold just these bytes."""
    own, at = utf8(column)
    same = np.diff(at) == np.diff(offsets)
    if same.all():
        differs = np.zeros(len(own) + 1, np.int64)
        np.cumsum(own != data, out=differs[1:])
        return differs[at[1:]] == differs[at[:-1]]
    return np.array([s and np.array_equal(own[at[i]:at[i + 1]], data[offsets[i]:offsets[i + 1]]) for i, s in enumerate(same.tolist())])


def _arrays(ids: np.ndarray, per_row: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(per_row)]).astype(np.int32)), pa.array(ids, pa.int32()))


def encode(docs: DataFrame, model: str | None = None, rule: str = "links") -> DataFrame:
    """doc_id, text, piece_ids and roundtrip (decoding gives the text back) of every row."""
    path = model or model_path()

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = None
        for run in runs(batches):
            codec = codec or PieceCodec(path, rule)
            ids, per_row = codec.encode(run.column("text"))
            same = same_rows(run.column("text"), *codec.decode(ids, per_row))
            yield pa.RecordBatch.from_arrays([run.column("doc_id"), run.column("text"), _arrays(ids, per_row), pa.array(same, pa.bool_())],
                                             names=["doc_id", "text", "piece_ids", "roundtrip"])

    return docs.select("doc_id", "text").mapInArrow(work, "doc_id long, text string, piece_ids array<int>, roundtrip boolean")


def decode(encoded: DataFrame, model: str | None = None) -> DataFrame:
    """doc_id and text from doc_id and piece_ids; null ids decode to the empty text."""
    path = model or model_path()

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = None
        for batch in batches:
            codec = codec or PieceCodec(path)
            rows = [i or [] for i in batch.column("piece_ids").to_pylist()]
            per_row = np.array([len(r) for r in rows], np.int64)
            data, offsets = codec.decode(np.array([i for r in rows for i in r], np.int64), per_row)
            texts = [data[a:b].tobytes().decode("utf-8", "replace") for a, b in zip(offsets, offsets[1:], strict=False)]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(texts, pa.string())], names=["doc_id", "text"])

    return encoded.select("doc_id", "piece_ids").mapInArrow(work, "doc_id long, text string")


def summary(docs: DataFrame, model: str | None = None, rule: str = "links") -> DataFrame:
    """doc_id, n_bytes, n_pieces, n_byte_pieces, ids_crc32 (of the ids as little-endian 32-bit
    numbers) and roundtrip of every row, without moving the ids out of the workers."""
    path = model or model_path()

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = None
        for run in runs(batches):
            codec = codec or PieceCodec(path, rule)
            ids, per_row = codec.encode(run.column("text"))
            same = same_rows(run.column("text"), *codec.decode(ids, per_row))
            row = np.repeat(np.arange(run.num_rows), per_row)
            raw, ends = ids.astype("<i4").tobytes(), 4 * np.cumsum(per_row)
            crc = [zlib.crc32(raw[a:b]) for a, b in zip([0, *ends.tolist()], ends.tolist(), strict=False)]
            yield pa.RecordBatch.from_arrays(
                [run.column("doc_id"), pa.array(np.diff(utf8(run.column("text"))[1])), pa.array(per_row),
                 pa.array(np.bincount(row[codec.is_byte[ids]], minlength=run.num_rows).astype(np.int64)), pa.array(crc, pa.int64()), pa.array(same, pa.bool_())],
                names=["doc_id", "n_bytes", "n_pieces", "n_byte_pieces", "ids_crc32", "roundtrip"])

    return docs.select("doc_id", "text").mapInArrow(
        work, "doc_id long, n_bytes long, n_pieces long, n_byte_pieces long, ids_crc32 long, roundtrip boolean")


def stage(docs: DataFrame) -> DataFrame:
    """Last pipeline stage: the documents as token ids, the library's, checked by decoding."""
    return encode(docs).select("doc_id", "piece_ids", F.size("piece_ids").cast("long").alias("n_pieces"), "roundtrip")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return summary(table(spark, sf_dir, "documents"))
