"""Append-only metadata tables (the catalog, the append manifest) that stay few files.

Rows are facts that never change, one small file per commit under ``<root>/<kind>/tablename=<name>``.
Compaction copies a dataset's rows into one snapshot file under a claimed number and only then
deletes the files it has copied.  Readers take the tail and all snapshots and keep each row once, so
whatever a compaction has done so far, they see the same rows.  A reader that listed files just before
they went fails and may simply read again.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from chronoweave.session import create_exclusively, delete_path, list_names, path_exists

# small files of one dataset above which an append compacts them
COMPACT_AFTER = 64


@dataclass
class MetaLog:
    spark: SparkSession
    root: str
    kind: str
    schema: StructType
    fmt: str = "parquet"

    def _escaped(self, name: str) -> str:
        """A dataset's name as Spark writes it in a partition folder."""
        return self.spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.escapePathName(name)

    def tail(self, name: str | None = None) -> str:
        return f"{self.root}/{self.kind}" + (f"/tablename={self._escaped(name)}" if name is not None else "")

    def snapshots(self, name: str | None = None) -> str:
        return f"{self.root}/{self.kind}_snapshots" + (f"/{self._escaped(name)}" if name is not None else "")

    def append(self, rows: DataFrame, compact: str | None = None) -> None:
        """Commit ``rows`` (missing columns NULL); with a dataset's name, compact it where it has
        become many files."""
        typed = [(F.col(f.name) if f.name in rows.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in self.schema.fields]
        rows.select(*typed).write.mode("append").partitionBy("tablename").format(self.fmt).save(self.tail())
        if compact is not None and len(self._tail_files(compact)) > COMPACT_AFTER:
            self.compact(compact)

    def read(self, name: str | None = None) -> DataFrame:
        """The rows of all datasets, or of one (only its folders are listed and read)."""
        parts = []
        if path_exists(self.spark, self.tail(name)):
            reader = self.spark.read.schema(self.schema).format(self.fmt).option("basePath", self.tail())
            parts.append(reader.load(self.tail(name)).select(*self.schema.names))
        if path_exists(self.spark, self.snapshots(name)):
            parts.append(self._snapshot_rows([self.snapshots(name)]))
        if not parts:
            return self.spark.createDataFrame([], self.schema)
        return parts[0] if len(parts) == 1 and path_exists(self.spark, self.tail(name)) else self._once(parts)

    def _snapshot_rows(self, folders: list[str]) -> DataFrame:
        return self.spark.read.schema(self.schema).option("recursiveFileLookup", True).format(self.fmt).load(folders)

    @staticmethod
    def _once(parts: list[DataFrame]) -> DataFrame:
        out = parts[0]
        for p in parts[1:]:
            out = out.unionByName(p)
        return out.distinct()

    def _tail_files(self, name: str) -> list[str]:
        return [x for x in list_names(self.spark, self.tail(name)) if not x.startswith(("_", "."))]

    def compact(self, name: str) -> int:
        """One dataset's rows into one snapshot; returns how many files and snapshots it replaced."""
        files = self._tail_files(name)
        done = [x for x in list_names(self.spark, self.snapshots(name)) if "_SUCCESS" in list_names(self.spark, f"{self.snapshots(name)}/{x}")]
        if len(files) + len(done) <= 1:
            return 0
        number = 1
        while not create_exclusively(self.spark, f"{self.root}/claims/{self.kind}_snapshots/{self._escaped(name)}/s{number}"):
            number += 1
        parts = []
        if files:
            own = StructType([f for f in self.schema.fields if f.name != "tablename"])
            rows = self.spark.read.schema(own).format(self.fmt).load([f"{self.tail(name)}/{x}" for x in files])
            parts.append(rows.select(*[F.lit(name).alias("tablename") if f == "tablename" else F.col(f) for f in self.schema.names]))
        if done:
            parts.append(self._snapshot_rows([f"{self.snapshots(name)}/{x}" for x in done]))
        self._once(parts).coalesce(1).write.format(self.fmt).save(f"{self.snapshots(name)}/s{number}")
        for path in [*(f"{self.tail(name)}/{x}" for x in files), *(f"{self.snapshots(name)}/{x}" for x in done)]:
            delete_path(self.spark, path)
        return len(files) + len(done)
