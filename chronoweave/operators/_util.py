"""Small shared helpers for operators."""

from __future__ import annotations

import functools
from typing import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chronoweave.functions.text import quote


@functools.lru_cache(maxsize=4096)
def c(name: str) -> Column:
    """Column by exact name (dots and spaces allowed).  Memoized: a by-name reference is
    immutable, and reusing it avoids a JVM round trip per use while plans are built."""
    return F.col(quote(name))


def as_col(x: Column | str | int) -> Column:
    if isinstance(x, Column):
        return x
    if isinstance(x, int):
        return F.lit(x).cast("bigint")
    return c(x)


def idiv(a: Column, b: Column) -> Column:
    """Exact floor division of longs (b > 0)."""
    return F.call_function("div", a - F.pmod(a, b), b)


def value_columns(df: DataFrame, exclude: Iterable[str]) -> list[str]:
    skip = set(exclude)
    return [n for n in df.columns if n not in skip]


def sql_floor_div(a: str, b: str) -> str:
    """SQL text for exact floor division of longs (b > 0)."""
    return f"((({a}) - pmod(({a}), ({b}))) div ({b}))"


def explode_range(df: DataFrame, lo: Column | str, hi: Column | str, step: Column | int | str, name: str,
                  block: int = 4096) -> DataFrame:
    """One row per value lo, lo+step, ... <= hi (none if hi < lo), in arrays of at most
    ``block`` elements, so a long outage never builds one huge array.  Bounds may be Columns
    or SQL expression text."""
    keep = [quote(x) for x in df.columns]

    def col(x: Column | int | str) -> Column:
        return F.expr(x) if isinstance(x, str) else as_col(x)

    out = df.select(*[c(x) for x in df.columns], col(lo).cast("bigint").alias("_xr_lo"),
                    col(hi).cast("bigint").alias("_xr_hi"), col(step).cast("bigint").alias("_xr_st"))
    # an empty range explodes an empty array (no filter: a filter here would be pushed into
    # the inputs and copied into every expression the bounds come from)
    out = out.selectExpr(
        *keep, "_xr_lo", "_xr_hi", "_xr_st",
        f"explode(CASE WHEN _xr_hi >= _xr_lo THEN sequence(0L, ((_xr_hi - _xr_lo) div _xr_st) div {block}L) "
        "ELSE array() END) AS _xr_blk")
    start = f"_xr_lo + _xr_blk * {block}L * _xr_st"
    return out.selectExpr(
        *keep, f"explode(sequence({start}, least(_xr_hi, {start} + {block - 1}L * _xr_st), _xr_st)) AS {quote(name)}")
