"""Schema catalog: one row per stored dataset version,
``(tablename, columns JSON, tagNames, version)`` with ``columns`` an array of
``{colname, datatype, orderby}``."""

from __future__ import annotations

import json
from typing import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (
    ArrayType, DataType, DateType, DoubleType, IntegerType, LongType, StringType, StructField, StructType,
    TimestampType,
)

from chronoweave.functions.text import last_component
from chronoweave.operators._util import c

# Type names of the catalog and the Spark type each stands for.
TYPE_NAMES: dict[str, DataType] = {
    "Double": DoubleType(),
    "DoubleType": DoubleType(),
    "IntegerType": IntegerType(),
    "String": StringType(),
    "StringType": StringType(),
    "Date": DateType(),
    "TimestampType": TimestampType(),
    "Long": LongType(),
    "LongType": LongType(),
}

CATALOG_SCHEMA = StructType([
    StructField("tablename", StringType()),
    StructField("columns", StringType()),
    StructField("tagNames", StringType()),
    StructField("version", LongType()),
    StructField("cells", StringType()),
])
#: One row per committed append or sorted save; first, last and rows are NULL where not sorted.
MANIFEST_SCHEMA = StructType([
    StructField("tablename", StringType()),
    StructField("version", LongType()),
    StructField("folder", StringType()),
    StructField("files", ArrayType(StructType([
        StructField("name", StringType()), StructField("first", LongType()), StructField("last", LongType()), StructField("rows", LongType())]))),
])
PACKED_SCHEMA = StructType([StructField("timestamp", LongType()), StructField("data", StringType())])
ENTRY_TYPE = "array<struct<colname:string,datatype:string,orderby:int>>"


def spark_type(name: str) -> DataType:
    """Type name -> Spark type; unknown names raise."""
    try:
        return TYPE_NAMES[name]
    except KeyError:
        raise ValueError(f"unknown type name {name!r}; accepted: {sorted(TYPE_NAMES)}") from None


def type_name(dt: DataType) -> str:
    """Spark type -> catalog type name (its class name, e.g. ``DoubleType``)."""
    return type(dt).__name__


def schema_from_names(pairs: Sequence[tuple[str, str]]) -> StructType:
    """``[(name, type name), ...]`` -> StructType."""
    return StructType([StructField(n, spark_type(t)) for n, t in pairs])


def check_storable(schema: StructType) -> None:
    """A schema can be catalogued only with types that can be read back by name."""
    bad = [f"{f.name} ({type_name(f.dataType)})" for f in schema.fields if type_name(f.dataType) not in TYPE_NAMES]
    if bad:
        raise ValueError(f"columns of types that a catalog can't name: {', '.join(bad)}; accepted: {sorted(TYPE_NAMES)}")


def schema_pairs(schema: StructType) -> list[tuple[str, str]]:
    """StructType -> ``[(name, type name), ...]``."""
    return [(f.name, type_name(f.dataType)) for f in schema.fields]


def catalog_record(schema: StructType, tablename: str, version: int, cells: str | None = None) -> tuple[str, str, str, int, str | None]:
    """Catalog row for a dataset's schema (a schema is metadata: built on the driver) and the codec
    of its packed cells."""
    cols = [{"colname": f.name, "datatype": type_name(f.dataType), "orderby": i}
            for i, f in enumerate(schema.fields)]
    tag_names = ",".join(f.name.split(".")[-1] for f in schema.fields)
    return (tablename, json.dumps(cols, separators=(",", ":")), tag_names, int(version), cells)


def catalog_from_labels(labels: DataFrame, dataset: str = "dataset", label: str = "labelid",
                        order: str = "order", is_time: str | None = None,
                        datatype: str = "DoubleType") -> DataFrame:
    """Catalog rows for every dataset described by a label table, in one job.

    Columns are ordered by ``order``.  The label that ``is_time`` marks is the dataset's
    ``timestamp`` column: entry 0, of LongType, since packed data holds it apart and first.
    ``tagNames`` lists the last dotted component of each label.  A dataset's label list is
    bounded by its column count, so collecting it per dataset is safe."""
    timed = F.coalesce(c(is_time) == 1, F.lit(False)) if is_time else F.lit(False)
    name = c(label).cast("string")
    item = F.struct(F.when(timed, 0).otherwise(1).alias("k0"), c(order).alias("k1"),
                    F.when(timed, F.lit("timestamp")).otherwise(name).alias("colname"),
                    F.when(timed, F.lit("LongType")).otherwise(F.lit(datatype)).alias("datatype"))
    grouped = labels.groupBy(c(dataset).cast("string").alias("tablename")).agg(
        F.sort_array(F.collect_list(item)).alias("_items"))
    cols = F.transform(F.col("_items"), lambda x, i: F.struct(
        x["colname"].alias("colname"), x["datatype"].alias("datatype"), i.alias("orderby")))
    names = F.array_join(F.transform(F.col("_items"), lambda x: last_component(x["colname"])), ",")
    return grouped.select("tablename", F.to_json(cols).alias("columns"), names.alias("tagNames"))


def latest(catalog: DataFrame) -> DataFrame:
    """Latest version of each dataset's catalog row (combines before the shuffle, however many
    versions a dataset has)."""
    cells = F.col("cells") if "cells" in catalog.columns else F.lit(None).cast("string").alias("cells")
    row = F.max_by(F.struct("columns", "tagNames", "version", cells), F.col("version"))
    return catalog.groupBy("tablename").agg(row.alias("_b")).select("tablename", "_b.columns", "_b.tagNames", "_b.version", "_b.cells")


def explode_entries(catalog: DataFrame) -> DataFrame:
    """Catalog rows -> one row per column ``(tablename, colname, datatype, orderby)`` (plus
    ``version`` and ``cells`` when the rows carry them)."""
    extra = [x for x in ("version", "cells") if x in catalog.columns]
    parsed = catalog.select("tablename", *extra, F.explode(F.from_json("columns", ENTRY_TYPE)).alias("e"))
    return parsed.select("tablename", *extra, "e.colname", "e.datatype", "e.orderby")


#: Types that hold every value of another type.
_WIDER = {("IntegerType", "LongType"), ("IntegerType", "DoubleType")}


def check_append(old: Sequence[tuple[str, str]], new_schema: StructType) -> None:
    """An append must have the stored columns, each of the stored type or one that fits in it; both or
    neither layout starts with ``timestamp``.  Columns are bound by name, in any order; only where no
    name but ``timestamp`` is a stored one, they are bound by position."""
    _bound(old, new_schema)


def _bound(old: Sequence[tuple[str, str]], new_schema: StructType) -> list[tuple[str, str, str]]:
    """(stored name, stored type, new name) of each stored column."""
    new = new_schema.fields
    if len(old) != len(new):
        raise ValueError(f"cannot append: stored dataset has {len(old)} columns, new data has {len(new)}")
    a, b = old[0][0] if old else None, new[0].name if new else None
    if (a == "timestamp") != (b == "timestamp"):
        raise ValueError("cannot append: one layout starts with timestamp and the other does not")
    names, given = [n for n, _ in old], [f.name for f in new]
    if sorted(names) == sorted(given) and len(set(names)) == len(names):
        pairs = [(n, t, n) for n, t in old]
    elif not (set(names) - {"timestamp"}) & (set(given) - {"timestamp"}):
        pairs = [(n, t, g) for (n, t), g in zip(old, given)]
    else:
        raise ValueError(f"cannot append: stored columns are {names}, new ones {given}")
    types = {f.name: type_name(f.dataType) for f in new}
    bad = [f"{g} ({types[g]}, stored as {t})" for _, t, g in pairs
           if types[g] != type_name(spark_type(t)) and (types[g], type_name(spark_type(t))) not in _WIDER]
    if bad:
        raise ValueError(f"cannot append columns of other types: {', '.join(bad)}")
    return pairs


def bind_append(old: Sequence[tuple[str, str]], df: DataFrame) -> DataFrame:
    """``df`` with the stored columns, in their order and of their types; raises as ``check_append``."""
    return df.select(*[c(g).cast(spark_type(t)).alias(n) for n, t, g in _bound(old, df.schema)])
