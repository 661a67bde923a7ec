"""A Bloom filter of fixed size over 64-bit keys, built where the keys are and small enough to
broadcast whatever their number.  It lets a pass over large rows leave out most of those that a join
would drop anyway; the join still decides."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .common import mix64

# size of a filter, and the part of it that holds all bits of a key
FILTER_BYTES, FILTER_PART = 8 << 20, 64 << 10


class BloomFilter:
    """A set of 64-bit keys in a fixed number of bits; may hold more, never less."""

    def __init__(self, bits: np.ndarray):
        self.bits = bits

    @staticmethod
    def slots(keys: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
        """(byte, bit mask) of a key's three bits, all in one part of the filter."""
        part = (mix64(keys) % np.uint64(size // FILTER_PART)).astype(np.int64) * FILTER_PART
        byte, mask = np.empty((3, len(keys)), np.int64), np.zeros((3, len(keys)), np.uint8)
        for i in range(3):
            bit = mix64(keys + np.uint64(i + 1)) % np.uint64(FILTER_PART * 8)
            byte[i] = part + (bit >> np.uint64(3)).astype(np.int64)
            mask[i] = np.uint8(1) << (bit & np.uint64(7)).astype(np.uint8)
        return byte, mask

    def holds(self, keys: np.ndarray) -> np.ndarray:
        byte, mask = self.slots(keys, len(self.bits))
        return ((self.bits[byte] & mask) != 0).all(axis=0)

    @staticmethod
    def of(keys: DataFrame, size: int = FILTER_BYTES) -> BloomFilter:
        """Of the column ``h``; each part is built where its keys are dealt, only bits return."""

        def part_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                h = np.asarray(batch.column("h")).view(np.uint64)
                part = (mix64(h) % np.uint64(size // FILTER_PART)).astype(np.int64)
                yield pa.RecordBatch.from_arrays([batch.column("h"), pa.array(part)], names=["h", "part"])

        def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            held: dict[int, np.ndarray] = {}
            for batch in batches:
                byte, mask = BloomFilter.slots(np.asarray(batch.column("h")).view(np.uint64), size)
                for part in np.unique(byte // FILTER_PART).tolist():
                    inside = byte // FILTER_PART == part
                    bits = held.setdefault(part, np.zeros(FILTER_PART, np.uint8))
                    np.bitwise_or.at(bits, byte[inside] - part * FILTER_PART, mask[inside])
            if held:
                yield pa.RecordBatch.from_arrays([pa.array(list(held), pa.int64()), pa.array([b.tobytes() for b in held.values()], pa.binary())],
                                                 names=["part", "bits"])

        dealt = keys.select("h").mapInArrow(part_of, "h long, part long").repartition("part").select("h")
        bits = np.zeros(size, np.uint8)
        for r in dealt.mapInArrow(build, "part long, bits binary").collect():  # ``size`` bytes in all
            bits[r["part"] * FILTER_PART:(r["part"] + 1) * FILTER_PART] |= np.frombuffer(r["bits"], np.uint8)
        return BloomFilter(bits)
