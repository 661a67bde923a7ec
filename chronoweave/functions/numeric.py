"""Numeric expressions: tolerant double parsing, bucket floor."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c: Column | str | int) -> Column:
    if isinstance(c, Column):
        return c
    if isinstance(c, int):
        return F.lit(c)
    return F.col(c)


def to_double(c: Column) -> Column:
    """Text or number -> DOUBLE; NULL where the text is not a number (never raises)."""
    return c.try_cast("double")


def floor_to(ts: Column | str, interval: Column | int) -> Column:
    """Start of the ``interval``-wide bucket holding ``ts`` (correct for negative ts too)."""
    t = _col(ts)
    return t - F.pmod(t, _col(interval))
