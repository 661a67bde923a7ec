"""Time expressions: text -> epoch seconds, timestamps -> epoch seconds, bounds as literals."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the tag files' time text format.  One-letter fields also accept the padded
# two-digit form, so "2020/01/02 03:04:05" and "2020/1/2 3:4:5" both parse.
TIME_TEXT_FORMAT = "yyyy/M/d H:m:s"

_EPOCH_NTZ = "TIMESTAMP_NTZ'1970-01-01 00:00:00'"


def parse_time_text(c: Column, fmt: str = TIME_TEXT_FORMAT, tz: str | None = None) -> Column:
    """Time text -> epoch seconds; NULL for text that does not parse.  The text is read in
    the session time zone, or in ``tz`` (a zone id such as "UTC") when given."""
    if tz is None:
        return F.unix_timestamp(F.try_to_timestamp(c, F.lit(fmt)))
    return F.unix_timestamp(F.try_to_timestamp(F.concat(c, F.lit(" " + tz)), F.lit(fmt + " VV")))


def epoch_to_text(epoch_s: Column, fmt: str = "yyyy/MM/dd HH:mm:ss") -> Column:
    """Epoch seconds -> UTC wall-clock text (through TIMESTAMP_NTZ: no session time zone)."""
    return F.date_format(F.timestamp_add("SECOND", epoch_s, F.expr(_EPOCH_NTZ)), fmt)


def epoch_seconds(c: Column, ntz: bool = True) -> Column:
    """TIMESTAMP_NTZ (or, with ``ntz=False``, TIMESTAMP) -> whole epoch seconds."""
    if ntz:
        return F.timestamp_diff("SECOND", F.expr(_EPOCH_NTZ), c)
    return F.unix_seconds(c)


def ntz_literal(epoch_s: int) -> Column:
    """A TIMESTAMP_NTZ literal for an epoch second, so range filters on a raw timestamp
    column stay comparable and are pushed into the Parquet scan."""
    text = datetime.fromtimestamp(int(epoch_s), tz=timezone.utc).strftime("%Y-%m-%d %H:%M:%S")
    return F.expr(f"TIMESTAMP_NTZ'{text}'")
