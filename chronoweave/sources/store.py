"""Dataset store: packed datasets, their schema catalog, an append manifest and an exception log,
as tables under one root folder (Parquet by default; any Spark file format works).

Every overwrite writes a new version folder ``data/<name>/v<version>`` and then appends the
catalog row that names it: the catalog row is the commit.  A writer first claims its version
number by creating a file that only one can create, so two writers never share a folder.  A job
that dies while writing leaves the previous version readable and untouched; readers always see
complete versions.

Every append writes a folder of its own, ``appended/<name>/v<version>/<id>``, and then a manifest row
with that folder and its files: the manifest row is the commit, and readers take listed folders only,
so an append that died is invisible.  Columns are bound by name and type (``operators.catalog.bind_append``).  Streams write folders of
their own beside both (``streamed/<name>/v<version>``), and readers take all three.

A sorted save cuts a dataset by time into files that don't overlap, and its manifest row holds each
file's first and last timestamp and number of rows: ``load(start, finish)`` opens only the files that
it needs, and ``ranked`` numbers the rows without a shuffle."""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from chronoweave.operators.catalog import (
    CATALOG_SCHEMA, MANIFEST_SCHEMA, PACKED_SCHEMA, bind_append, catalog_record, check_storable, explode_entries, latest,
)
from chronoweave.operators.filters import time_range_filter
from chronoweave.operators.pack import TS, cells_for, pack, unpack
from chronoweave.session import create_exclusively, list_names, path_exists
from chronoweave.sources.metalog import MetaLog

OVERWRITE, APPEND = "overwrite", "append"


@dataclass
class DatasetStore:
    spark: SparkSession
    root: str
    fmt: str = "parquet"

    def _data(self, name: str, version: int) -> str:
        return f"{self.root}/data/{name}/v{int(version)}"

    def streamed(self, name: str, version: int) -> str:
        return f"{self.root}/streamed/{name}/v{int(version)}"

    @property
    def _catalog(self) -> MetaLog:
        return MetaLog(self.spark, self.root, "catalog", CATALOG_SCHEMA, self.fmt)

    @property
    def _manifest(self) -> MetaLog:
        # files are listed in arrays, which text formats can't hold
        return MetaLog(self.spark, self.root, "manifest", MANIFEST_SCHEMA, "json" if self.fmt == "csv" else self.fmt)

    @property
    def _errors(self) -> str:
        return f"{self.root}/errors"

    # packed data ------------------------------------------------------------------------
    def write_packed(self, packed: DataFrame, name: str, version: int, mode: str = OVERWRITE) -> str:
        """Packed rows into the version's folder, or for an append into a new folder that the
        manifest then lists; returns the folder."""
        if mode == OVERWRITE:
            folder = self._data(name, version)
            packed.write.mode(OVERWRITE).format(self.fmt).save(folder)
            return folder
        folder = f"{self.root}/appended/{name}/v{int(version)}/{uuid.uuid4().hex}"
        packed.write.format(self.fmt).save(folder)
        self._commit(name, version, folder)
        return folder

    def _commit(self, name: str, version: int, folder: str, ranges: bool = False) -> None:
        """The manifest row of a written folder, with its files (and their time ranges)."""
        if ranges:
            at = F.col("_metadata.file_name")
            found = self.spark.read.schema(PACKED_SCHEMA).format(self.fmt).load(folder).groupBy(at.alias("name")).agg(
                F.min(TS).alias("first"), F.max(TS).alias("last"), F.count("*").alias("rows")).collect()  # a row a file
            files = sorted((tuple(r) for r in found), key=lambda r: (r[1], r[0]))
        else:
            files = [(x, None, None, None) for x in sorted(list_names(self.spark, folder)) if not x.startswith(("_", "."))]
        self._manifest.append(self.spark.createDataFrame([(name, int(version), folder, files)], MANIFEST_SCHEMA), compact=name)

    def manifest(self, name: str, version: int) -> list[tuple[str, list]]:
        """(folder, files) of each listed folder of a version; one row a commit."""
        if not any(path_exists(self.spark, p) for p in (self._manifest.tail(name), self._manifest.snapshots(name))):
            return []
        rows = self._manifest.read(name).where((F.col("tablename") == name) & (F.col("version") == int(version)))
        return sorted((r["folder"], r["files"]) for r in rows.collect())

    def read_packed(self, name: str, version: int | None = None, start: int | None = None, finish: int | None = None) -> DataFrame:
        """Packed rows (latest version by default): saved, appended and streamed ones, with the
        fixed schema of their layout.  With bounds, of sorted folders only the files that may hold
        rows inside them."""
        latest_version, entries, _ = self.described(name)
        v = latest_version if version is None else version
        schema = PACKED_SCHEMA if entries and entries[0][0] == TS else StructType([PACKED_SCHEMA["data"]])
        listed = self.manifest(name, v)
        paths, sorted_folders = [], set()
        for folder, files in listed:
            if files and files[0]["first"] is not None:
                sorted_folders.add(folder)
                if start is not None or finish is not None:
                    paths += [f"{folder}/{f['name']}" for f in files if (finish is None or f["first"] <= finish) and (start is None or f["last"] >= start)]
                    continue
            paths.append(folder)
        others = [f for f in (self._data(name, v), self.streamed(name, v)) if f not in sorted_folders and path_exists(self.spark, f)]
        if not paths and not others:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).option("recursiveFileLookup", True).format(self.fmt).load(others + paths)

    # catalog ----------------------------------------------------------------------------
    def catalog(self, name: str | None = None) -> DataFrame:
        """All catalog rows, or those of one dataset (reads only its folder)."""
        return self._catalog.read(name)

    def add_catalog_rows(self, rows: DataFrame, compact: str | None = None) -> None:
        self._catalog.append(rows, compact)

    def compact_metadata(self, name: str) -> int:
        """A dataset's catalog and manifest rows into one file each; returns the files replaced."""
        return self._catalog.compact(name) + self._manifest.compact(name)

    def claim_version(self, name: str) -> int:
        """A version number above all catalogued ones that no other writer has."""
        got = self.catalog(name).where(F.col("tablename") == name).agg(F.max("version")).first()
        version = 1 if got is None or got[0] is None else int(got[0]) + 1
        while not create_exclusively(self.spark, f"{self.root}/claims/{name}/v{version}"):
            version += 1
        return version

    def described(self, name: str) -> tuple[int, list[tuple[str, str]], str | None]:
        """Latest version of a dataset, its columns ``[(colname, type name), ...]`` and its cell
        codec.  One catalog row is read (a dataset's column list)."""
        cat = latest(self.catalog(name).where(F.col("tablename") == name))
        rows = explode_entries(cat).select("version", "orderby", "colname", "datatype", "cells").collect()
        if not rows:
            raise KeyError(f"dataset {name!r} is not in the catalog")
        rows = sorted(rows, key=lambda r: r["orderby"])
        return int(rows[0]["version"]), [(r["colname"], r["datatype"]) for r in rows], rows[0]["cells"]

    def latest(self, name: str) -> tuple[int, list[tuple[str, str]]]:
        """Latest version of a dataset and its columns."""
        return self.described(name)[:2]

    def entries(self, name: str) -> list[tuple[str, str]]:
        """Latest catalog entry of a dataset as ``[(colname, type name), ...]`` by position."""
        return self.latest(name)[1]

    # whole datasets ---------------------------------------------------------------------
    def save(self, df: DataFrame, name: str, mode: str = OVERWRITE, by_time: bool = False) -> None:
        """Overwrite: pack, write, add a catalog version.  Append: bind columns to the stored layout
        by name and type, pack, write, add a manifest row.  Other modes raise, and so do column types
        that the catalog can't name.  ``by_time`` cuts and sorts the rows by timestamp."""
        if mode not in (OVERWRITE, APPEND):
            raise ValueError(f"save mode {mode!r} is neither {OVERWRITE} nor {APPEND}")
        check_storable(df.schema)
        if mode == OVERWRITE:
            version, cells = self.claim_version(name), cells_for(df.schema)
        else:
            version, entries, cells = self.described(name)
            df = bind_append(entries, df)
        by_time = by_time and df.columns[:1] == [TS]
        if by_time:
            df = df.repartitionByRange(TS).sortWithinPartitions(TS)
        folder = self.write_packed(pack(df, cells=cells), name, version, mode)
        if mode == OVERWRITE:
            if by_time:
                self._commit(name, version, folder, ranges=True)
            rec = catalog_record(df.schema, name, version, cells)
            self.add_catalog_rows(self.spark.createDataFrame([rec], CATALOG_SCHEMA), compact=name)

    def load(self, name: str, start: int | None = None, finish: int | None = None) -> DataFrame:
        """Stored dataset (latest version) with its columns and types restored from the catalog;
        with bounds, its rows inside that inclusive time range."""
        _, entries, cells = self.described(name)
        out = unpack(self.read_packed(name, None, start, finish), entries, cells)
        return time_range_filter(out, start, finish, TS) if TS in out.columns else out

    def ranked(self, name: str, rank: str = "rank") -> DataFrame:
        """A dataset saved ``by_time`` with each row's place in time order, from 1: the number of
        rows in the files before its own, plus its row number there.  Rows that share a timestamp
        take any order."""
        version, entries, cells = self.described(name)
        listed = dict(self.manifest(name, version))
        files = listed.get(self._data(name, version))
        if len(listed) != 1 or not files or self.fmt != "parquet" or path_exists(self.spark, self.streamed(name, version)):
            raise ValueError(f"dataset {name!r} is not one sorted save")
        rows = self.spark.read.schema(PACKED_SCHEMA).parquet(self._data(name, version)).withColumns(
            {"_file": F.col("_metadata.file_name"), "_row": F.col("_metadata.row_index")})
        before, starts = 0, []
        for f in files:
            starts.append((f["name"], before))
            before += f["rows"]
        offsets = F.broadcast(self.spark.createDataFrame(starts, "_file string, _before long"))  # a row a file
        return unpack(rows.join(offsets, "_file"), entries, cells, (F.col("_before") + F.col("_row") + 1).alias(rank))

    def register(self, name: str, view: str | None = None) -> DataFrame:
        """Make the stored dataset queryable from Spark SQL as a temporary view."""
        df = self.load(name)
        df.createOrReplaceTempView(view or name)
        return df

    # exception log ----------------------------------------------------------------------
    def log_errors(self, messages: DataFrame) -> None:
        """Append ``(app, message)`` rows."""
        messages.select(F.col("app").cast("string"), F.col("message").cast("string")) \
            .write.mode(APPEND).format(self.fmt).save(self._errors)

    def errors(self) -> DataFrame:
        """The exception log ``(app, message)`` (empty before anything was logged)."""
        if not path_exists(self.spark, self._errors):
            return self.spark.createDataFrame([], "app string, message string")
        return self.spark.read.schema("app string, message string").format(self.fmt).load(self._errors)
