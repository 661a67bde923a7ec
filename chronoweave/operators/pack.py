"""Packed storage layout: ``(timestamp BIGINT, data STRING)`` with the tag cells joined by
commas in catalog order, or ``(data STRING)`` for tables without a timestamp.

Cells are ``plain`` (numbers, dates: their text as it is) or ``escaped``, where the separator, line
ends and the escape mark inside text are written as ``%2C`` and so on and a missing text is a mark of
its own, so texts come back as they were.  The catalog names a version's codec; rows without one are
plain."""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructType

from chronoweave.functions.text import SEPARATOR, escape_cell, pack_values, unescape_cell
from chronoweave.operators._util import c

TS = "timestamp"
PLAIN, ESCAPED = "plain", "escaped"


def cells_for(schema: StructType) -> str:
    """The codec that a schema's cells need."""
    return ESCAPED if any(isinstance(f.dataType, StringType) for f in schema.fields) else PLAIN


def pack(df: DataFrame, ts: str = TS, cells: str | None = PLAIN) -> DataFrame:
    """Missing cells become 0.0 (missing texts under ``escaped`` stay missing).  If the first column
    is ``timestamp`` it stays a column, otherwise every column goes into ``data``."""
    text = {f.name for f in df.schema.fields if isinstance(f.dataType, StringType)} if cells == ESCAPED else set()

    def cell(name: str) -> Column:
        return escape_cell(c(name)) if name in text else c(name)

    cols = df.columns
    if cols and cols[0] == ts:
        return df.select(c(ts).cast("bigint").alias(TS), pack_values([cell(x) for x in cols[1:]]).alias("data"))
    return df.select(pack_values([cell(x) for x in cols]).alias("data"))


def pack_rdbms(df: DataFrame, ts_column: str, tags: Sequence[str]) -> DataFrame:
    """Database flavour: the time column cast to BIGINT, missing cells as empty text."""
    return df.select(c(ts_column).cast("bigint").alias(TS), pack_values([c(t) for t in tags], fill="").alias("data"))


def unpack(packed: DataFrame, entries: Sequence[tuple[str, str]], cells: str | None = PLAIN, *more: Column) -> DataFrame:
    """Inverse of ``pack`` from catalog entries ``[(colname, type name), ...]`` in order, and
    ``more`` columns.

    If the first entry is ``timestamp`` the layout has a timestamp column; otherwise all
    columns come from ``data``.  The text is split once per row; cells are cast leniently
    (a missing or malformed cell is NULL)."""
    from chronoweave.operators.catalog import spark_type

    names = [e[0] for e in entries]
    has_ts = bool(names) and names[0] == TS and TS in packed.columns
    tags = entries[1:] if has_ts else entries
    parts = packed.withColumn("_parts", F.split(F.col("data"), SEPARATOR))
    out = [F.col(TS).cast("bigint").alias(TS)] if has_ts else []
    for i, (n, t) in enumerate(tags):
        cell, kind = F.get(F.col("_parts"), i), spark_type(t)
        cell = unescape_cell(cell) if cells == ESCAPED and isinstance(kind, StringType) else cell
        out.append(cell.try_cast(kind).alias(n))
    return parts.select(*out, *more)
