"""Operator 8: shards along a Hilbert curve [native: DataFrame and SQL functions only].

Three metadata dimensions are quantised to 64 cells each: language and source by the first bits of
their CRC-32, size by half powers of two (64 of them reach beyond the longest text that a row can hold).  The cell's index on the Hilbert curve, then the text's
CRC-32 and the doc_id order all rows, and the order is cut into runs of equal length: law ``rows``
(shard sizes differ by one row at most).  Neighbours on the curve are neighbours in every dimension,
so a filter on any of them touches few shards.

The order comes from one range shuffle of slim rows (no texts) and a written table: each row's
place is the number of rows in earlier partitions plus its place in its own.  A hot cell or a large
group of equal texts spreads over partitions by CRC-32 and doc_id; there is no window over a group.
Equal texts stand side by side only where language and source are equal too: copies under another
source lie elsewhere on the curve, so a group of copies may be in several shards.

Defined results: a null text counts as empty (size 8, CRC-32 0); null lang or source has cell 0;
null doc_ids come first among their equals; repeated rows are ordered arbitrarily among themselves,
which no result column shows; an empty table gives no rows.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from chronoweave.session import scratch_path

from .common import table

SHARDS = 24
BITS = 6
# slim rows per partition of the ordering shuffle
ROWS_PER_PARTITION = 1_000_000


def category_cell(column: str, bits: int = BITS) -> F.Column:
    """The first bits of the CRC-32: equal values share a cell, null has cell 0."""
    return F.coalesce(F.shiftright(F.crc32(F.col(column).cast("binary")), 32 - bits), F.lit(0)).cast("int")


def size_cell(size: F.Column, bits: int = BITS) -> F.Column:
    """Half powers of two of the size."""
    return F.least(F.floor(F.log2(size.cast("double")) * 2), F.lit((1 << bits) - 1)).cast("int")


def hilbert_index(x: str, y: str, z: str, bits: int = BITS) -> F.Column:
    """Index of a cell (three int columns, ``bits`` bits each) on the 3-dimensional Hilbert curve.

    The coordinates are turned and mirrored from the highest bit down until the curve's order is
    plain Gray code, whose bits then are read off one after another.
    """
    turn = f"""aggregate(
        transform(sequence({bits - 1}, 1), b -> shiftleft(1, b)),
        named_struct('x', {x}, 'y', {y}, 'z', {z}),
        (a, q) -> aggregate(array(0, 1, 2), a, (s, i) ->
            CASE WHEN ((CASE i WHEN 0 THEN s.x WHEN 1 THEN s.y ELSE s.z END) & q) <> 0
                 THEN named_struct('x', s.x ^ (q - 1), 'y', s.y, 'z', s.z)
                 WHEN i = 1 THEN named_struct('x', s.x ^ ((s.x ^ s.y) & (q - 1)), 'y', s.y ^ ((s.x ^ s.y) & (q - 1)), 'z', s.z)
                 WHEN i = 2 THEN named_struct('x', s.x ^ ((s.x ^ s.z) & (q - 1)), 'y', s.y, 'z', s.z ^ ((s.x ^ s.z) & (q - 1)))
                 ELSE s END),
        s -> named_struct('x', s.x, 'y', s.x ^ s.y, 'z', s.x ^ s.y ^ s.z))"""
    return F.expr(f"""aggregate(array({turn}), 0, (acc, g) ->
        aggregate(sequence({bits - 1}, 0), 0, (h, b) ->
            h * 8 + (shiftright(g.x ^ mask, b) & 1) * 4 + (shiftright(g.y ^ mask, b) & 1) * 2 + (shiftright(g.z ^ mask, b) & 1)))"""
                  .replace("mask", f"aggregate(transform(sequence({bits - 1}, 1), b -> shiftleft(1, b)), 0, "
                                   "(t, q) -> CASE WHEN (g.z & q) <> 0 THEN t ^ (q - 1) ELSE t END)"))


def ordered(docs: DataFrame, rows_per_partition: int = ROWS_PER_PARTITION) -> tuple[DataFrame, int]:
    """doc_id, size, text_crc32, hilbert and ``place``, the row's place in curve order from 0;
    and the number of rows."""
    spark = docs.sparkSession
    text = F.coalesce(F.col("text").cast("binary"), F.lit(b""))
    slim = docs.select("doc_id", (F.length(text) + 8).cast("long").alias("size"), F.crc32(text).alias("text_crc32"),
                       category_cell("lang").alias("cx"), category_cell("source").alias("cy"))
    slim = slim.withColumn("cz", size_cell(F.col("size")))
    slim = slim.select("doc_id", "size", "text_crc32", hilbert_index("cx", "cy", "cz").cast("int").alias("hilbert"))
    written = scratch_path(spark, "hilbert-slim")
    slim.write.parquet(written)
    slim = spark.read.parquet(written)
    total = slim.count()
    parts = max(spark.sparkContext.defaultParallelism, math.ceil(total / rows_per_partition))
    # partition number and place in it, as the shuffled and sorted task sees them
    order = slim.repartitionByRange(parts, "hilbert", "text_crc32", "doc_id").sortWithinPartitions("hilbert", "text_crc32", "doc_id")
    placed = scratch_path(spark, "hilbert-order")
    order.withColumn("at", F.monotonically_increasing_id()).write.parquet(placed)
    rows = spark.read.parquet(placed).withColumn("part", F.shiftright("at", 33)).withColumn("within", F.col("at").bitwiseAND((1 << 33) - 1))
    # one row per partition of the shuffle
    sizes = rows.groupBy("part").agg(F.count("*").alias("n"))
    before = sizes.select("part", (F.sum("n").over(Window.orderBy("part")) - F.col("n")).alias("before"))
    rows = rows.join(F.broadcast(before), "part")
    return rows.select("doc_id", "size", "text_crc32", "hilbert", (F.col("before") + F.col("within")).alias("place")), total


def shards(docs: DataFrame, shard_count: int = SHARDS, rows_per_partition: int = ROWS_PER_PARTITION) -> DataFrame:
    rows, total = ordered(docs, rows_per_partition)
    rows = rows.withColumn("shard", F.expr(f"place * {shard_count} div {max(total, 1)}"))
    first = F.expr(f"(shard * {total} + {shard_count - 1}) div {shard_count}")
    return rows.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), F.col("shard").cast("int"),
                       (F.col("place") - first).alias("slot"), F.lit(None).cast("int").alias("grown_shard"), "hilbert")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shards(table(spark, sf_dir, "documents"))
