"""Gap to the next timestamp of a series, and the series' own sampling interval.

The plain formulation, ``lead(ts) OVER (ORDER BY ts)``, sends a whole series through one
task.  Here the only window over rows runs on *distinct* timestamps inside fixed time chunks: a
chunk of ``chunk`` seconds holds at most ``chunk`` of them however many rows share them, so every
window partition is bounded.  Duplicate timestamps are collapsed by a partial (map-side)
aggregate before any shuffle.  What crosses chunks comes from a table of one row per (series,
chunk): its first and last timestamp and smallest gap, and by a window over those rows the first
timestamp of the next non-empty chunk and the series' interval.  It goes back to the rows by
(series, chunk), so a long series stays spread over its chunks.

Series keys may be NULL: keys are compared as structs, in which NULL equals NULL.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, LongType, StructField, StructType

from chronoweave.functions.text import quote
from chronoweave.operators._util import c
from chronoweave.session import materialized

DAY = 86400


def in_chunks(df: DataFrame, ts: str = "timestamp", by: Sequence[str] = (), chunk: int = DAY,
              aggs: Sequence[Column] = ()) -> DataFrame:
    """One row per distinct (series, ts) with its ``_chunk``, ``_n`` rows, ``aggs`` over the tied
    rows, and ``_next``, the next distinct ts of the same chunk (NULL for the chunk's last)."""
    t, n = quote(ts), int(chunk)
    base = (df.where(c(ts).isNotNull())
              .groupBy(*[c(x) for x in by], F.expr(f"{t} - pmod({t}, {n}L)").alias("_chunk"), c(ts))
              .agg(F.count(F.lit(1)).alias("_n"), *aggs))
    keys = ", ".join([*(quote(x) for x in by), "_chunk"])
    return base.selectExpr("*", f"lead({t}) OVER (PARTITION BY {keys} ORDER BY {t}) AS _next")


def chunk_edges(rows: DataFrame, ts: str = "timestamp", by: Sequence[str] = ()) -> DataFrame:
    """One row per (series, chunk) of ``in_chunks`` rows: ``_first`` and ``_last`` ts, ``_rows``,
    ``_distinct``, ``_following`` (first ts of the series' next chunk) and ``_interval`` (smallest
    positive gap of the whole series).  The windows see one row per chunk."""
    t = quote(ts)
    edges = rows.groupBy(*[c(x) for x in by], "_chunk").agg(
        F.expr(f"min({t}) AS _first"), F.expr(f"max({t}) AS _last"), F.expr(f"min(_next - {t}) AS _least"),
        F.expr("sum(_n) AS _rows"), F.expr("count(*) AS _distinct"))
    series = f"PARTITION BY {', '.join(quote(x) for x in by)}" if by else ""
    edges = edges.selectExpr("*", f"lead(_first) OVER ({series} ORDER BY _chunk) AS _following")
    return edges.selectExpr("*", f"min(least(_least, _following - _last)) OVER ({series}) AS _interval")


def at_chunk(by: Sequence[str]) -> Column:
    """(series, chunk) as one key; a struct, so that NULL series match."""
    return F.struct(*[c(x) for x in by], c("_chunk")).alias("_at")


def distinct_next(df: DataFrame, ts: str = "timestamp", by: Sequence[str] = (),
                  chunk: int = DAY, aggs: Sequence[Column] = ()) -> DataFrame:
    """One row per distinct (series, ts) with ``_n`` rows, ``_next`` = next distinct ts of the
    series (ts itself for the last one), plus ``aggs`` over the tied rows.

    The chunked rows are written once to the shared folder (``df`` is read once and the lineage
    is cut); only each chunk's last row takes part in the join with the chunk table."""
    rows = materialized(in_chunks(df, ts, by, chunk, aggs), "gaps")
    edges = chunk_edges(rows, ts, by).select(at_chunk(by), "_following")
    last = rows.where("_next IS NULL").withColumn("_at", at_chunk(by)).join(edges, "_at", "left")
    cols = [x for x in rows.columns if x != "_chunk"]
    last = last.selectExpr(*[f"coalesce(_following, {quote(ts)}) AS _next" if x == "_next" else quote(x) for x in cols])
    return rows.where("_next IS NOT NULL").selectExpr(*[quote(x) for x in cols]).unionByName(last)


def _lead_in_runs(by: list[int], ts: int):
    """For sorted runs: each row's gap to the next row of its series, the run's last row left open."""

    def work(batches):
        import pyarrow as pa
        import pyarrow.compute as pc

        def marked(rows, gap, is_open, first):
            n = rows.num_rows
            head = pa.array([first] + [False] * (n - 1))
            out = rows.append_column("gap", gap).append_column("open", pa.array([is_open] * n)).append_column("head", head)
            return out.combine_chunks().to_batches()

        held, first = None, True
        for batch in batches:
            rows = pa.Table.from_batches([batch])
            if not rows.num_rows:
                continue
            rows = rows if held is None else pa.concat_tables([held, rows]).combine_chunks()
            n = rows.num_rows
            if n > 1:
                now, then = rows.slice(0, n - 1), rows.slice(1)
                same = pa.chunked_array([pa.array([True] * (n - 1))])
                for i in by:
                    x, y = now.column(i), then.column(i)
                    same = pc.and_(same, pc.or_(pc.fill_null(pc.equal(x, y), False), pc.and_(pc.is_null(x), pc.is_null(y))))
                gap = pc.if_else(same, pc.subtract(then.column(ts), now.column(ts)), pa.scalar(0, pa.int64()))
                gap = pc.if_else(pc.is_null(now.column(ts)), pa.scalar(None, pa.int64()), gap)
                yield from marked(now, gap, False, first)
                first = False
            held = rows.slice(n - 1)
        if held is not None:
            yield from marked(held, pa.nulls(1, pa.int64()), True, first)

    return work


def next_gap(df: DataFrame, ts: str = "timestamp", by: Sequence[str] = (), tiebreak: str | None = None,
             out: str = "t", chunk: int = DAY) -> DataFrame:
    """Each row plus ``out`` = next timestamp of its series minus its own; 0 for the last row.

    Among rows sharing a timestamp exactly one gets the gap and the others 0, the same multiset
    as ``lead(ts, 1, ts) OVER (PARTITION BY by ORDER BY ts) - ts``: the one with the largest
    ``tiebreak`` (NULL is smallest, and rows equal in it are told apart by their row number).

    One shuffle: rows are cut into sorted runs by range over (series, ts, tiebreak, row), so neither
    a long series nor a hot timestamp is one task's, whatever ``chunk`` is.  Gaps inside a run need the
    next row only; the runs are written once, and each run's last row is stitched to the first row of
    the next one, a row a run."""
    k, names = list(by), df.columns
    rows = df.select(*[(c(x).cast("bigint") if x == ts else c(x)).alias(f"_c{i}") for i, x in enumerate(names)], F.monotonically_increasing_id().alias("_row"))
    at = {x: f"_c{i}" for i, x in enumerate(names)}
    order = [F.col(at[x]).asc_nulls_first() for x in [*k, ts, *([tiebreak] if tiebreak else [])]] + [F.col("_row")]
    sorted_runs = rows.repartitionByRange(*order).sortWithinPartitions(*order).drop("_row").withColumn("_run", F.spark_partition_id())
    schema = StructType([*sorted_runs.schema.fields, StructField("gap", LongType()), StructField("open", BooleanType()), StructField("head", BooleanType())])
    runs = materialized(sorted_runs.mapInArrow(_lead_in_runs([names.index(x) for x in k], names.index(ts)), schema), "gap-runs")
    # the first row of the next run that has rows: a window over one row a run
    heads = runs.where("head").select("_run", F.struct(*[F.col(at[x]) for x in [*k, ts]]).alias("_h"))
    heads = heads.select("_run", F.lead("_h").over(Window.orderBy("_run")).alias("_n"))
    t = at[ts]
    same = F.col("_n").isNotNull()
    for x in k:
        same = same & F.col(at[x]).eqNullSafe(F.col("_n").getField(at[x]))
    gap = F.when(F.col(t).isNotNull(), F.when(same, F.col("_n").getField(t) - F.col(t)).otherwise(F.lit(0).cast("bigint")))
    last = runs.where("open").drop("gap").join(heads, "_run", "left").withColumn("gap", gap)
    cols = [*(F.col(at[x]).cast(df.schema[x].dataType).alias(x) for x in names), F.col("gap").alias(out)]
    return runs.where("NOT open").select(*cols).unionByName(last.select(*cols))


def infer_interval(df: DataFrame, ts: str = "timestamp", by: Sequence[str] = (),
                   chunk: int = DAY, out: str = "interval", literal: bool = False) -> DataFrame:
    """Per series, the smallest positive gap between consecutive distinct timestamps (NULL
    when the series has fewer than two distinct timestamps).

    ``literal=True`` gives the second smallest of all row gaps instead (the last row's gap is
    0), which is 0 as soon as the series has a duplicate timestamp and NULL for a single row."""
    edges = chunk_edges(in_chunks(df, ts, by, chunk), ts, by)
    rows, smallest = F.sum("_rows"), F.min("_interval")
    if literal:
        smallest = (F.when(F.coalesce(rows, F.lit(0)) < 2, F.lit(None).cast("bigint"))
                     .when(rows > F.sum("_distinct"), F.lit(0).cast("bigint")).otherwise(smallest))
    return edges.groupBy(*[c(x) for x in by]).agg(smallest.alias(out))
