"""Database import: dataset id -> source connection and labels (metadata joins) -> labelled
columns of the source table(s) inside the time range -> packed rows + catalog row."""

from __future__ import annotations

from typing import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType

from chronoweave.functions.time import epoch_seconds
from chronoweave.operators._util import c
from chronoweave.operators.catalog import catalog_from_labels
from chronoweave.operators.filters import raw_time_range_filter, time_range_filter
from chronoweave.operators.metadata import multi_table_select, resolve_source
from chronoweave.operators.pack import pack_rdbms
from chronoweave.sources.jdbc import URL_TEMPLATES, Connection, read_table
from chronoweave.sources.store import DatasetStore
from chronoweave.sources.tables import time_kind_of
from chronoweave.specs import ImportRule

TableReader = Callable[[str, "str | None"], DataFrame]


def table_reader(spark: SparkSession, source_row: dict, rule: ImportRule, num_partitions: int = 8) -> TableReader:
    """Reader (table, its time column if it holds that) for one source connection: JDBC for
    database kinds, files for ``PARQUET`` (the connection's ``dsexample`` is then the folder of
    ``<table>.parquet``).  The JDBC scan of the table with the time column is split into
    ``num_partitions`` range queries when the rule has both bounds."""
    kind = str(source_row["dstype"])
    if kind in URL_TEMPLATES:
        conn = Connection.from_row(source_row)
        return lambda table, time: read_table(spark, conn, table, time, rule.start_s, rule.finish_s, num_partitions)
    if kind == "PARQUET":
        root = str(source_row["dsexample"]).rstrip("/")
        return lambda table, time: spark.read.parquet(f"{root}/{table}.parquet")
    raise ValueError(f"unknown source kind {kind!r}")


def rdbms_import(spark: SparkSession, dataset_id: str, rule: ImportRule, datasets: DataFrame,
                 sources: DataFrame, labels: DataFrame, store: DatasetStore | None = None,
                 join_on: Sequence[tuple[str, str, str, str]] = (),
                 reader: TableReader | None = None, num_partitions: int = 8) -> tuple[DataFrame, DataFrame]:
    """Returns ``(packed, catalog_row)``; with a store both are written, and ``store.load`` gives
    back ``timestamp`` and the labelled columns as doubles.  Labels of columns that are not numbers
    are refused: a dataset's tags are numbers.

    ``labels`` rows: dsabelid, tablename, labelid (dotted), timestampif (1 = time column).
    The metadata for one dataset is a handful of rows (one per column), so it is collected
    to build the source projection."""
    mine = labels.where(F.col("dsabelid") == dataset_id)
    resolved = resolve_source(datasets.where(F.col("dsabelid") == dataset_id), sources)
    src_rows = resolved.limit(2).collect()
    if len(src_rows) != 1:
        raise ValueError(f"dataset {dataset_id!r} must resolve to exactly one source, got {len(src_rows)}")
    label_rows = mine.orderBy("labelid").collect()
    time_labels = [r for r in label_rows if int(r["timestampif"] or 0) == 1]
    if len(time_labels) != 1:
        raise ValueError("exactly one label must be the time column")
    read = reader or table_reader(spark, src_rows[0].asDict(), rule, num_partitions)
    tables = sorted({r["tablename"] for r in label_rows})
    cols = [(r["tablename"], r["labelid"].split(".")[-1]) for r in label_rows]
    ts_table, ts_col = time_labels[0]["tablename"], time_labels[0]["labelid"].split(".")[-1]
    frames = []
    for t in tables:
        df = read(t, ts_col if t == ts_table else None)
        text = [x for tt, x in cols if tt == t and (t, x) != (ts_table, ts_col) and not isinstance(df.schema[x].dataType, NumericType)]
        if text:
            raise ValueError(f"labels of table {t!r} that are not numbers: {text}")
        if t == ts_table and time_kind_of(df, ts_col) == "timestamp":
            ntz = dict(df.dtypes)[ts_col] == "timestamp_ntz"
            df = raw_time_range_filter(df, ts_col, rule.start_s, rule.finish_s, ntz=ntz)
            df = df.withColumn(ts_col, epoch_seconds(c(ts_col), ntz=ntz))
        elif t == ts_table:
            df = time_range_filter(df, rule.start_s, rule.finish_s, ts_col)
        frames.append((t, df))
    selected = multi_table_select(frames, cols, join_on)
    names = [x for _, x in cols]
    named = [x if names.count(x) == 1 else f"{t}.{x}" for t, x in cols]
    tag_cols = [x for x, r in zip(named, label_rows) if int(r["timestampif"] or 0) != 1]
    packed = pack_rdbms(selected, named[cols.index((ts_table, ts_col))], tag_cols)
    catalog = catalog_from_labels(mine, dataset="dsabelid", label="labelid", order="labelid", is_time="timestampif")
    if store is not None:
        version = store.claim_version(dataset_id)
        store.write_packed(packed, dataset_id, version, "overwrite")
        store.add_catalog_rows(catalog.withColumn("version", F.lit(version).cast("bigint")))
    return packed, catalog
