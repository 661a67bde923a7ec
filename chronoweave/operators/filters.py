"""Row filters and tag projections."""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chronoweave.functions.time import ntz_literal
from chronoweave.operators._util import c
from chronoweave.specs import TagSpec


def time_range_filter(df: DataFrame, start_s: int | None = None, finish_s: int | None = None,
                      ts: str = "timestamp", keep_null: bool = False) -> DataFrame:
    """Inclusive ``start_s <= ts <= finish_s`` on an epoch-seconds column; each bound optional.
    With ``keep_null`` rows without a time stay (to be rejected where that is logged)."""
    cond = _range(c(ts), start_s, finish_s)
    if cond is None:
        return df
    return df.where(cond | c(ts).isNull() if keep_null else cond)


def raw_time_range_filter(df: DataFrame, column: str, start_s: int | None = None,
                          finish_s: int | None = None, ntz: bool = True) -> DataFrame:
    """The same inclusive range on a raw TIMESTAMP_NTZ (or, with ``ntz=False``, TIMESTAMP)
    column, written as comparisons with constants so that the Parquet scan receives it as a
    pushed filter: floor(epoch(t)) <= f  <=>  t < f + 1."""
    lit = ntz_literal if ntz else (lambda s: F.timestamp_seconds(F.lit(int(s))))
    cond = None
    if start_s is not None:
        cond = c(column) >= lit(start_s)
    if finish_s is not None:
        upper = c(column) < lit(int(finish_s) + 1)
        cond = upper if cond is None else cond & upper
    return df if cond is None else df.where(cond)


def _range(col: Column, start_s: int | None, finish_s: int | None) -> Column | None:
    cond = None
    if start_s is not None:
        cond = col >= F.lit(int(start_s))
    if finish_s is not None:
        upper = col <= F.lit(int(finish_s))
        cond = upper if cond is None else cond & upper
    return cond


def modulo_sample(df: DataFrame, every: int = 30, ts: str = "timestamp") -> DataFrame:
    """Keep rows whose epoch second is a multiple of ``every`` (a column predicate, so it stays
    inside codegen, unlike a typed lambda)."""
    return df.where(F.pmod(c(ts), F.lit(int(every))) == 0)


def select_tags(df: DataFrame, tags: Sequence[TagSpec], ts: Column, ts_name: str = "timestamp") -> DataFrame:
    """Project the time expression and the listed tags, renamed from source id to output name."""
    return df.select(ts.alias(ts_name), *[c(t.id).alias(t.name) for t in tags])
