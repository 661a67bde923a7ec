"""Parquet (or any file-format) tag tables: a time column plus tag columns."""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chronoweave.functions.time import epoch_seconds, parse_time_text
from chronoweave.operators._util import c
from chronoweave.operators.filters import raw_time_range_filter, select_tags, time_range_filter
from chronoweave.specs import TagSpec


def read_tag_table(spark: SparkSession, path: str, time_column: str, tags: Sequence[TagSpec],
                   start_s: int | None = None, finish_s: int | None = None, time_kind: str = "auto",
                   fmt: str = "parquet", ts: str = "timestamp", keep_bad_times: bool = False) -> DataFrame:
    """Table -> ``(timestamp BIGINT, tags ...)``.  For a TIMESTAMP_NTZ time column the range is
    applied to the raw column so it is pushed into the scan; only the listed columns are read."""
    raw = spark.read.format(fmt).load(path)
    return prepare_tag_frame(raw, time_column, tags, start_s, finish_s, time_kind, ts, keep_bad_times)


def time_kind_of(df: DataFrame, column: str) -> str:
    """"timestamp" (either timestamp type), "epoch" (numbers) or "text", from the column type."""
    t = dict(df.dtypes)[column]
    if t.startswith("timestamp"):
        return "timestamp"
    if t in ("string",):
        return "text"
    return "epoch"


def prepare_tag_frame(raw: DataFrame, time_column: str, tags: Sequence[TagSpec], start_s: int | None = None,
                      finish_s: int | None = None, time_kind: str = "auto", ts: str = "timestamp",
                      keep_bad_times: bool = False) -> DataFrame:
    """A table with a time column -> ``(timestamp BIGINT, tags ...)`` inside the range.  The
    time column's kind is taken from its type unless given.  ``keep_bad_times`` keeps rows whose
    time text does not parse, with the text in ``_bad_time``."""
    if time_kind == "auto":
        time_kind = time_kind_of(raw, time_column)
    if time_kind == "timestamp":
        ntz = dict(raw.dtypes)[time_column] == "timestamp_ntz"
        raw = raw_time_range_filter(raw, time_column, start_s, finish_s, ntz=ntz)
        return select_tags(raw, tags, epoch_seconds(c(time_column), ntz=ntz), ts)
    if time_kind == "epoch":
        out = select_tags(raw, tags, c(time_column).cast("bigint"), ts)
    elif time_kind == "text":
        when = parse_time_text(c(time_column))
        extra = [F.when(when.isNull(), F.coalesce(c(time_column), F.lit(""))).alias("_bad_time")] if keep_bad_times else []
        out = raw.select(when.alias(ts), *[c(t.id).alias(t.name) for t in tags], *extra)
        return time_range_filter(out, start_s, finish_s, ts, keep_bad_times)
    else:
        raise ValueError(f"unknown time kind {time_kind!r}")
    return time_range_filter(out, start_s, finish_s, ts)
