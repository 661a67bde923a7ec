"""Append mode as a stream: new tag files of one source, as they land in a folder, are turned
into epoch seconds, range-filtered, validated under the drop/fail policy, packed and appended
to a stored dataset.

Each micro-batch goes to a folder of its own, named after the stream (its checkpoint) and the
batch, beside the dataset's batch data: a retried batch overwrites its folder, so it is never there
twice, and no sink log ever hides rows that others wrote.  A batch goes to the version that is the
latest when it is written: after an overwrite the stream follows to the new version, if the layout
still fits, and otherwise stops with an error.  The stream's progress lives in ``checkpoint``.  The
catalog row is written (or checked for compatibility, as a batch append would be) before the
stream starts.

The files' header is declared in the source's ``columns`` option, or else read from the files that
are there when the stream starts; columns are then bound by name, and a file whose header differs
fails its batch.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StringType, StructField, StructType

from chronoweave.functions.time import parse_time_text
from chronoweave.operators._util import c
from chronoweave.operators.catalog import CATALOG_SCHEMA, bind_append, catalog_record, check_append
from chronoweave.operators.filters import select_tags, time_range_filter
from chronoweave.operators.pack import pack
from chronoweave.operators.quality import validate
from chronoweave.sources.store import DatasetStore
from chronoweave.specs import ImportRule, SourceSpec, tags_in_order


def header_of(spark: SparkSession, source: SourceSpec) -> list[str]:
    """The declared header of a CSV source, or that of the files in its folder."""
    declared = source.options.get("columns")
    if declared:
        return list(declared)
    found = spark.read.option("header", True).option("recursiveFileLookup", True).csv(source.options["path"]).columns
    if not found:
        raise ValueError("no file to read the header from; declare it in the source's columns option")
    return found


def start_append_stream(spark: SparkSession, source: SourceSpec, time_column: str, rule: ImportRule,
                        store: DatasetStore, checkpoint: str, available_now: bool = False,
                        processing_time: str | None = None) -> StreamingQuery:
    """Start the stream; ``available_now`` processes what is there and stops."""
    tags = tags_in_order([source])
    header = header_of(spark, source)
    missing = [x for x in (time_column, *(t.id for t in tags)) if x not in header]
    if missing:
        raise ValueError(f"columns {missing} are not in the header {header}")
    schema = StructType([StructField(x, StringType()) for x in header])
    raw = (spark.readStream.option("header", True).option("enforceSchema", False).option("recursiveFileLookup", True)
           .schema(schema).csv(source.options["path"]))
    prepared = select_tags(raw, tags, parse_time_text(c(time_column), tz=source.options.get("tz")))
    prepared = time_range_filter(prepared, rule.start_s, rule.finish_s, keep_null=rule.on_error == "fail")
    ds = validate(prepared, [t.name for t in tags], rule.on_error, key_flag=None)
    name, layout = rule.dataset_id, ds.schema
    try:
        check_append(store.latest(name)[1], layout)
    except KeyError:
        rec = catalog_record(layout, name, store.claim_version(name))
        store.add_catalog_rows(spark.createDataFrame([rec], CATALOG_SCHEMA))
    stream = hashlib.md5(checkpoint.rstrip("/").encode()).hexdigest()

    def write(batch: DataFrame, number: int) -> None:
        version, entries, cells = store.described(name)
        batch = pack(bind_append(entries, batch), cells=cells)
        batch.write.mode("overwrite").format(store.fmt).save(f"{store.streamed(name, version)}/{stream}/{number}")

    writer = ds.writeStream.outputMode("append").option("checkpointLocation", checkpoint).foreachBatch(write)
    if available_now:
        writer = writer.trigger(availableNow=True)
    elif processing_time:
        writer = writer.trigger(processingTime=processing_time)
    return writer.start()
