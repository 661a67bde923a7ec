"""Source kind -> reader.  Every reader returns ``(timestamp BIGINT, tag ...)``."""

from __future__ import annotations

from typing import Callable

from pyspark.sql import DataFrame, SparkSession

from chronoweave.specs import SourceSpec


def _csv(spark: SparkSession, s: SourceSpec, start: int | None, finish: int | None, bad_times: bool) -> DataFrame:
    from chronoweave.sources.csv import read_tag_csv

    return read_tag_csv(spark, s.options["path"], s.tags, start, finish, tz=s.options.get("tz"),
                        columns=s.options.get("columns"), keep_bad_times=bad_times)


def _table(spark: SparkSession, s: SourceSpec, start: int | None, finish: int | None, bad_times: bool) -> DataFrame:
    from chronoweave.sources.tables import read_tag_table

    if not s.time_column:
        raise ValueError("a table source needs time_column")
    return read_tag_table(spark, s.options["path"], s.time_column, s.tags, start, finish, s.time_kind,
                          fmt=s.options.get("format", "parquet"), keep_bad_times=bad_times)


def _jdbc(spark: SparkSession, s: SourceSpec, start: int | None, finish: int | None, bad_times: bool) -> DataFrame:
    from chronoweave.sources.jdbc import Connection, read_range
    from chronoweave.operators.filters import select_tags
    from chronoweave.operators._util import c

    conn = s.options["connection"]
    if not isinstance(conn, Connection):
        conn = Connection(**conn)
    if not s.time_column:
        raise ValueError("a JDBC source needs time_column")
    cols = [t.id.split(".")[-1] for t in s.tags]
    raw = read_range(spark, conn, s.options["table"], s.time_column, cols, start, finish,
                     int(s.options.get("num_partitions", 1)))
    renamed = [type(t)(t.order, t.id.split(".")[-1], t.name, t.type) for t in s.tags]
    return select_tags(raw, renamed, c(s.time_column).cast("bigint"))


READERS: dict[str, Callable[[SparkSession, SourceSpec, int | None, int | None, bool], DataFrame]] = {
    "CSV": _csv,
    "PARQUET": _table,
    "TABLE": _table,
    "JDBC": _jdbc,
}


def read_source(spark: SparkSession, spec: SourceSpec, start_s: int | None = None,
                finish_s: int | None = None, keep_bad_times: bool = False) -> DataFrame:
    """Dispatch on the source kind; unknown kinds raise.  With ``keep_bad_times`` sources whose
    times are text keep the rows whose time does not parse (NULL, its text in ``_bad_time``)."""
    try:
        reader = READERS[spec.kind.upper()]
    except KeyError:
        raise ValueError(f"unknown source kind {spec.kind!r}; known: {sorted(READERS)}") from None
    return reader(spark, spec, start_s, finish_s, keep_bad_times)
