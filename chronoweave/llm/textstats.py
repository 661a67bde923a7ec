"""Words, lines and repeats of whole texts, for many rows at once in numpy.

A word is a run of bytes other than space and the control bytes 9 to 13, which is the same as a
run of such characters.  Words, lines and windows are compared by 64-bit hashes.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa

from .common import mix64, prefix_hash, range_hash, utf8, word_spans

IS_WORD = np.ones(256, bool)
IS_WORD[[9, 10, 11, 12, 13, 32]] = False
# fixed: the characters that count as symbols
SYMBOLS = b"#*$%&|<>"


def per_row(row: np.ndarray, rows: int) -> np.ndarray:
    return np.bincount(row, minlength=rows).astype(np.int64)


def row_sums(mask: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """How many of each row's bytes are marked."""
    total = np.zeros(len(mask) + 1, np.int64)
    np.cumsum(mask, out=total[1:])
    return total[offsets[1:]] - total[offsets[:-1]]


def repeated(key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(is this key there twice or more, is this not its first occurrence)."""
    order = np.argsort(key, kind="stable")
    same = np.zeros(len(key) + 1, bool)
    same[1:-1] = key[order][1:] == key[order][:-1]
    twice, later = np.empty(len(key), bool), np.empty(len(key), bool)
    twice[order] = same[1:] | same[:-1]
    later[order] = same[:-1]
    return twice, later


@dataclass
class Words:
    data: np.ndarray
    offsets: np.ndarray
    prefix: np.ndarray
    start: np.ndarray
    end: np.ndarray
    row: np.ndarray
    hash: np.ndarray

    @staticmethod
    def of(column: pa.Array) -> Words:
        data, offsets = utf8(column)
        start, end, row = word_spans(IS_WORD[data], offsets)
        prefix = prefix_hash(data)
        return Words(data, offsets, prefix, start, end, row, range_hash(prefix, start, end, data))

    @property
    def rows(self) -> int:
        return len(self.offsets) - 1

    def bytes_of(self, i: int) -> bytes:
        return self.data[self.start[i]:self.end[i]].tobytes()

    def own(self, key: np.ndarray, row: np.ndarray) -> np.ndarray:
        """Keys that are equal only inside one row."""
        return mix64(key ^ mix64(row.astype(np.uint64) + np.uint64(1)))

    def n_words(self) -> np.ndarray:
        return per_row(self.row, self.rows)

    def word_chars(self) -> np.ndarray:
        """Code points in words: word bytes that don't continue a character."""
        return row_sums(IS_WORD[self.data] & ((self.data & 0xC0) != 0x80), self.offsets)

    def count_of(self, characters: bytes) -> np.ndarray:
        wanted = np.zeros(256, bool)
        wanted[list(characters)] = True
        return row_sums(wanted[self.data], self.offsets)

    def repeat_words(self, window: int = 3) -> np.ndarray:
        """Words inside windows that their row holds twice or more."""
        n = len(self.row)
        if n < window:
            return np.zeros(self.rows, np.int64)
        key = np.zeros(n - window + 1, np.uint64)
        for j in range(window):
            key = mix64(key + self.hash[j:n - window + 1 + j])
        inside = np.flatnonzero(self.row[:n - window + 1] == self.row[window - 1:])
        twice, _ = repeated(self.own(key[inside], self.row[inside]))
        edge = np.zeros(n + 1, np.int64)
        np.add.at(edge, inside[twice], 1)
        np.add.at(edge, inside[twice] + window, -1)
        return per_row(self.row[np.cumsum(edge[:-1]) > 0], self.rows)

    def lines(self) -> tuple[np.ndarray, np.ndarray]:
        """Lines with a word, and those of them equal to an earlier line of the row."""
        breaks = np.flatnonzero(self.data == 10)
        row = np.searchsorted(self.offsets, breaks, side="right") - 1
        start = np.concatenate([self.offsets[:-1], breaks + 1])
        end = np.concatenate([self.offsets[1:], breaks])
        line_row = np.concatenate([np.arange(self.rows), row])
        order = np.argsort(start, kind="stable")
        # a row's first line starts at its offset, each next one behind a break
        start, line_row = np.sort(start, kind="stable"), line_row[order]
        by_row = np.lexsort((start, line_row))
        start, line_row = start[by_row], line_row[by_row]
        end = np.concatenate([start[1:] - 1, [0]])
        last = np.ones(len(start), bool)
        last[:-1] = line_row[1:] != line_row[:-1]
        end[last] = self.offsets[1:][line_row[last]]
        words = np.zeros(len(self.data) + 1, np.int64)
        np.cumsum(IS_WORD[self.data], out=words[1:])
        full = words[end] > words[start]
        key = self.own(range_hash(self.prefix, start[full], end[full], self.data), line_row[full])
        _, later = repeated(key)
        return per_row(line_row[full], self.rows), per_row(line_row[full][later], self.rows)
