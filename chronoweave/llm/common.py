"""Helpers shared by the operators: table access and whole Arrow text columns as numpy bytes."""

from __future__ import annotations

import ctypes
import hashlib
import tempfile
import zipfile
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

# texts are worked on in runs of about this many bytes (a longer single text is a run of its own)
RUN_BYTES = 1 << 20

_U64 = np.uint64
_RADIX = _U64(0x9E3779B97F4A7C15 | 1)
_RADIX_INV = _U64(pow(int(_RADIX), -1, 1 << 64))
_powers: list[np.ndarray] = [np.ones(1, _U64), np.ones(1, _U64)]


_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Give the Python workers this package, as an archive that Spark hands out, once a session;
    where it is installed on the workers anyway, this changes nothing."""
    app = spark.sparkContext.applicationId
    if app in _shipped:
        return
    package = Path(__file__).resolve().parent.parent
    path = Path(tempfile.mkdtemp(prefix="ship-")) / f"{package.name}.zip"
    with zipfile.ZipFile(path, "w") as z:
        for p in sorted(package.rglob("*.py")):
            z.write(p, p.relative_to(package.parent))
    spark.sparkContext.addPyFile(str(path))
    _shipped.add(app)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def runs(batches: Iterator[pa.RecordBatch], text: str = "text", limit: int = RUN_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut Arrow batches into row ranges of at most ``limit`` text bytes (one row at least); when
    they are through, free memory goes back to the system."""
    try:
        for batch in batches:
            size = np.diff(utf8(batch.column(text))[1])
            start, held = 0, 0
            for i, n in enumerate(size.tolist()):
                if held and held + n > limit:
                    yield batch.slice(start, i - start)
                    start, held = i, 0
                held += n
            if start < batch.num_rows:
                yield batch.slice(start)
    finally:
        give_back()


def give_back() -> None:
    """Return free memory: a worker lives on after its task, and allocators keep what they had."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):  # another C library
        pass


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """A string column as (its bytes, the row offsets into them); null rows are empty."""
    if column.null_count:
        column = column.fill_null("")
    n = len(column)
    kind = np.int64 if pa.types.is_large_string(column.type) else np.int32
    if n == 0:
        return np.empty(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = column.buffers()
    off = np.frombuffer(offsets, kind, count=column.offset + n + 1)[column.offset:].astype(np.int64)
    data = np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)
    return data[off[0]:off[-1]], off - off[0]


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every input bit over the result."""
    x = x ^ (x >> _U64(32))
    x = x * _U64(0xD6E8FEB86659FD93)
    x = x ^ (x >> _U64(32))
    x = x * _U64(0xD6E8FEB86659FD93)
    return x ^ (x >> _U64(32))


def _upto(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_powers[0]) < n:
        size = max(n, 1 << 20)
        for i, base in enumerate((_RADIX, _RADIX_INV)):
            p = np.full(size, base, _U64)
            p[0] = 1
            _powers[i] = np.cumprod(p)
    return _powers[0][:n], _powers[1][:n]


def prefix_hash(data: np.ndarray) -> np.ndarray:
    """Prefix sums from which ``range_hash`` gives the hash of any byte range."""
    power, _ = _upto(len(data))
    out = np.zeros(len(data) + 1, _U64)
    np.cumsum((data.astype(_U64) + _U64(1)) * power, out=out[1:])
    return out


# bytes of a range above which its hash is a keyed digest
LONG_RANGE = 256
_KEY = b"chronoweave range"


def range_hash(prefix: np.ndarray, start: np.ndarray, end: np.ndarray, data: np.ndarray | None = None) -> np.ndarray:
    """64-bit hash of the bytes of each range, the same wherever the bytes stand.

    It is a sum of powers modulo 2^64.  Texts with much inner symmetry (the Thue-Morse word and its
    complement) have equal sums from 1,024 bytes on; with ``data``, ranges above ``LONG_RANGE`` bytes
    take a keyed digest instead."""
    _, inverse = _upto(len(prefix))
    out = mix64((prefix[end] - prefix[start]) * inverse[start] + (end - start).astype(_U64))
    if data is not None:
        for i in np.flatnonzero(end - start > LONG_RANGE).tolist():
            out[i] = int.from_bytes(hashlib.blake2b(data[start[i]:end[i]], digest_size=8, key=_KEY).digest(), "little")
    return out


def slid_hash(prefix: np.ndarray, size: int) -> np.ndarray:
    """A hash of the ``size`` bytes from each position on; good in its upper half only."""
    n = len(prefix) - size
    out = prefix[size:] - prefix[:n]
    out *= _upto(n)[1]
    out ^= out >> _U64(32)
    out *= _U64(0xD6E8FEB86659FD93)
    return out


def word_spans(is_word: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Maximal runs of word bytes inside each row: (start, end, row)."""
    n = len(is_word)
    if n == 0:
        e = np.empty(0, np.int64)
        return e, e, e
    before = np.empty(n, bool)
    before[0] = False
    before[1:] = is_word[:-1]
    inner = offsets[(offsets > 0) & (offsets < n)]
    before[inner] = False
    start = np.flatnonzero(is_word & ~before)
    after = np.empty(n, bool)
    after[-1] = False
    after[:-1] = is_word[1:]
    after[inner - 1] = False
    end = np.flatnonzero(is_word & ~after) + 1
    return start, end, np.searchsorted(offsets, start, side="right") - 1


def cut(text: str, spans: list[tuple[int, int]]) -> str:
    """The text without the given UTF-8 byte spans; a character goes if all its bytes do."""
    data = text.encode("utf-8")
    keep, at = [], 0
    for start, end in spans:
        while start < end and (data[start] & 0xC0) == 0x80:  # inside a character: it stays whole
            start += 1
        while start < end < len(data) and (data[end] & 0xC0) == 0x80:
            end -= 1
        if end > start:
            keep.append(data[at:start])
            at = end
    keep.append(data[at:])
    return b"".join(keep).decode("utf-8")


def quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def packed(docs: DataFrame) -> F.Column:
    """All columns of ``docs`` but the text as one column, out of the way of an operator's own."""
    return F.struct(*[F.col(quoted(c)).alias(c) for c in docs.columns if c != "text"]).alias("row")


def schema_of(docs: DataFrame, ddl: str) -> StructType:
    """``row`` as ``packed`` makes it, then the fields of ``ddl``."""
    row = StructType([f for f in docs.schema.fields if f.name != "text"])
    return StructType([StructField("row", row), *StructType.fromDDL(ddl).fields])


def unpacked(rows: DataFrame, docs: DataFrame, changed: F.Column | None = None) -> DataFrame:
    """(row, text) back as the columns of ``docs``; n_chars follows a changed text."""
    column = {"text": F.col("text")}
    if changed is not None and "n_chars" in docs.columns:
        column["n_chars"] = F.when(changed, F.length("text")).otherwise(F.col("row.n_chars")).cast(docs.schema["n_chars"].dataType)
    return rows.select(*[column.get(c, F.col("row." + quoted(c))).alias(c) for c in docs.columns])
