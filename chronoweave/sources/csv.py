"""CSV tag files: scan with header (all text), inferred scan with null rules, CSV sink."""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType, StringType, StructField, StructType

from chronoweave.functions.text import null_text_to_zero
from chronoweave.functions.time import TIME_TEXT_FORMAT, epoch_to_text, parse_time_text
from chronoweave.operators._util import c
from chronoweave.operators.filters import time_range_filter
from chronoweave.operators.quality import LEVELS, column_level
from chronoweave.session import materialized, qualified_path
from chronoweave.specs import TagSpec


def read_tag_csv(spark: SparkSession, path: str | Sequence[str], tags: Sequence[TagSpec], start_s: int | None = None,
                 finish_s: int | None = None, time_format: str = TIME_TEXT_FORMAT,
                 ts: str = "timestamp", tz: str | None = None,
                 columns: Sequence[str] | None = None, with_file: bool = False,
                 keep_bad_times: bool = False) -> DataFrame:
    """Tag files -> ``(timestamp BIGINT, tag STRING ...)``.

    The header names the columns; every cell is read as text.  When the spec lists the
    file's ``columns`` they are declared as the schema (all text), no job is spent reading
    the header, and a file whose header differs fails the read.  Folders of one layout can be
    read together (``path`` a list).  The first column is the time text, turned into epoch seconds
    (NULL if it does not parse).  Only the listed tags are kept (CSV column pruning), renamed to
    their output names, and the inclusive time range applied.  ``with_file`` adds ``_file``, the
    base name of the file each row came from (without ``.csv``); ``keep_bad_times`` keeps rows
    whose time does not parse, with its text in ``_bad_time``."""
    reader = spark.read.option("header", True)
    if columns:
        reader = reader.schema(StructType([StructField(x, StringType()) for x in columns])).option("enforceSchema", False)
    raw = reader.csv(path if isinstance(path, str) else list(path))
    time_col = raw.columns[0]
    when = parse_time_text(c(time_col), time_format, tz)
    extra = [F.regexp_replace(F.col("_metadata.file_name"), r"(?i)\.csv$", "").alias("_file")] if with_file else []
    if keep_bad_times:
        extra.append(F.when(when.isNull(), F.coalesce(c(time_col), F.lit(""))).alias("_bad_time"))
    out = raw.select(when.alias(ts), *[c(t.id).alias(t.name) for t in tags], *extra)
    return time_range_filter(out, start_s, finish_s, ts, keep_bad_times)


def _plain_path(path) -> "Column":
    """A file's or folder's address with one slash behind its scheme, as it may be written in two ways."""
    return F.regexp_replace(path, "^([A-Za-z][A-Za-z0-9+.-]*):/+", "$1:/")


def read_tag_folders(spark: SparkSession, folders: dict[str, str], columns: Sequence[str], start_s: int | None = None,
                     finish_s: int | None = None, tz: str | None = None, ts: str = "timestamp") -> DataFrame:
    """Tag files of one header in many folders (folder -> source) in one scan: ``(_source, timestamp,
    text columns, _bad_time)``.  Each row's source is looked up by the folder of its file; a file
    outside the listed folders fails the read."""
    schema = StructType([StructField(x, StringType()) for x in columns])
    raw = spark.read.option("header", True).schema(schema).option("enforceSchema", False).csv(list(folders))
    known = F.create_map(*[x for path, source in folders.items()
                           for x in (_plain_path(F.lit(qualified_path(spark, path).rstrip("/"))), F.lit(source))])
    folder = _plain_path(F.regexp_extract(F.col("_metadata.file_path"), "^(.*)/[^/]*$", 1))
    source = F.coalesce(F.element_at(known, folder), F.raise_error(F.concat(F.lit("no source for files in "), folder)).cast("string"))
    time_col = columns[0]
    when = parse_time_text(c(time_col), TIME_TEXT_FORMAT, tz)
    out = raw.select(source.alias("_source"), when.alias(ts), *[c(x) for x in columns[1:]],
                     F.when(when.isNull(), F.coalesce(c(time_col), F.lit(""))).alias("_bad_time"))
    return time_range_filter(out, start_s, finish_s, ts, True)


def read_csv_null_to_zero(spark: SparkSession, path: str, ts: str = "timestamp",
                          time_format: str = TIME_TEXT_FORMAT, sampling_ratio: float = 1.0,
                          tz: str | None = None, schema: StructType | str | None = None) -> DataFrame:
    """Header CSV with inferred types, or with the given ``schema``.  Inferring reads the files once:
    their text is written as a table, and on the way an aggregate of each column (``column_level``)
    finds its narrowest type; with ``sampling_ratio`` below 1 Spark infers from a sample.  The first column becomes ``timestamp``: used as is
    when it is named ``date`` or is already numeric (epoch seconds), parsed as time text
    otherwise.  In other columns a missing cell or the text ``null`` becomes 0 (text columns
    keep text: "0")."""
    reader = spark.read.option("header", True)
    if schema is not None:
        raw = reader.schema(schema).option("enforceSchema", False).csv(path)
    elif sampling_ratio < 1:
        raw = reader.option("inferSchema", True).option("samplingRatio", sampling_ratio).csv(path)
    else:
        raw = typed_once(reader.csv(path))
    first = raw.schema.fields[0]
    if first.name == "date" and isinstance(first.dataType, StringType):
        day = c(first.name)
        tcol = F.coalesce(day.try_cast("bigint"), F.unix_timestamp(day.try_cast("timestamp")))
    elif first.name == "date" or isinstance(first.dataType, NumericType):
        tcol = c(first.name).cast("bigint")
    else:
        tcol = parse_time_text(c(first.name).cast("string"), time_format, tz)
    cells = []
    for f in raw.schema.fields[1:]:
        if isinstance(f.dataType, NumericType):
            cells.append(F.coalesce(c(f.name), F.lit(0).cast(f.dataType)).alias(f.name))
        else:
            cells.append(null_text_to_zero(c(f.name).cast("string")).alias(f.name))
    return raw.select(tcol.alias(ts), *cells)


def typed_once(text: DataFrame) -> DataFrame:
    """A frame of text columns with each column cast to the narrowest type that holds all its cells.
    The rows are computed once, written, and their types observed meanwhile."""
    names = text.columns
    seen = Observation()
    rows = text.toDF(*[f"_c{i}" for i in range(len(names))])
    rows = materialized(rows.observe(seen, *[F.max(column_level(F.col(x))).alias(x) for x in rows.columns]), "csv-text")
    levels = seen.get  # one number a column
    return rows.select(*[c(f"_c{i}").cast(LEVELS[levels.get(f"_c{i}") or 0]).alias(x) for i, x in enumerate(names)])


def read_csv_text(spark: SparkSession, path: str, header: bool = True) -> DataFrame:
    """Every column as text (for type checks before casting)."""
    return spark.read.option("header", header).csv(path)


def write_csv(df: DataFrame, path: str, mode: str = "error", header: bool = False) -> None:
    """CSV sink (no header by default)."""
    df.write.mode(mode).option("header", header).csv(path)


def write_tag_csv(df: DataFrame, path: str, ts: str = "timestamp", mode: str = "error",
                  time_format: str = "yyyy/MM/dd HH:mm:ss", partition_by: Sequence[str] = ()) -> None:
    """Write a frame with an epoch-seconds column as tag files: header, UTC time text first;
    with ``partition_by`` one folder per source (``<column>=<value>``) in a single job."""
    cols = [x for x in df.columns if x != ts]
    out = df.select(epoch_to_text(c(ts), time_format).alias("time"), *[c(x) for x in cols])
    writer = out.write.mode(mode).option("header", True)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.csv(path)
