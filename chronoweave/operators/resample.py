"""Resampling: forward-fill to a finer step (upsample), bucket average (downsample), and the
per-series chooser that combines them.

Branch rule, per series, with ``old`` its own interval and ``new`` the target:
  old == new -> forward-fill at ``new``;
  old <  new -> forward-fill at ``old``, then average into ``new`` buckets;
  old >  new -> forward-fill at gcd(old, new), then average into ``new`` buckets.
The branch is decided inside the plan (from a table of one row per series and chunk), not on
the driver.

When a forward-fill feeds an average, the filled copies are never materialised one by one:
each source row emits one row per target bucket it reaches, weighted by how many fill steps
fall in that bucket, and the average is ``sum(v * w) / sum(w)``.  A long outage therefore
costs one row per bucket instead of one row per step.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chronoweave.functions.numeric import floor_to
from chronoweave.functions.text import quote
from chronoweave.operators._util import as_col, c, explode_range, idiv, sql_floor_div, value_columns
from chronoweave.operators.gaps import DAY, at_chunk, chunk_edges, distinct_next, in_chunks, infer_interval
from chronoweave.session import materialized

EQUAL, SLOWER, FASTER, SINGLE = "equal", "slower", "faster", "single"
KEEP, AVG = "keep", "avg"
# fills of one gap that its own task makes
FILL_BLOCK = 65536
# Column that flags rows holding text that is not a number.
BAD_FLAG = "_bad"


def _real_row(values: Sequence[str]) -> Column:
    """The values of one of the rows tied on a timestamp: of the largest, compared tag by tag."""
    return F.max(F.struct(*[c(v).alias(v) for v in values])).alias("_rep")


def upsample(df: DataFrame, step: int | Column, ts: str = "timestamp", by: Sequence[str] = (),
             values: Sequence[str] | None = None, chunk: int = DAY, block: int = FILL_BLOCK) -> DataFrame:
    """Forward-fill: every row is kept, and a row whose gap to the next timestamp is ``g``
    is copied to ``ts + i*step`` for ``1 <= i < g div step`` (values copied as they are,
    NULLs included).  Rows tied on a timestamp fill once, from one of them (the largest).  An outage of
    more than ``block`` fills is cut into blocks that are dealt to all tasks; other rows stay put."""
    k = list(by)
    vals = list(values) if values is not None else value_columns(df, [*k, ts])
    d = distinct_next(df, ts, k, chunk, aggs=[_real_row(vals)]).select("*", as_col(step).alias("_step"))
    d = d.where(F.col("_step") > 0).withColumn("_fills", idiv(F.col("_next") - c(ts), F.col("_step")) - 1)
    extra = explode_range(d.where(F.col("_fills") <= block), F.lit(1), F.col("_fills"), 1, "_i")
    # an outage of many blocks: a row a block, dealt to all tasks, then the block's fills
    long = explode_range(d.where(F.col("_fills") > block), F.lit(0), idiv(F.col("_fills") - 1, F.lit(block).cast("bigint")), 1, "_blk")
    # by number: few and small as they are, they are not to be put together again
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    long = long.repartition(parts, *[c(x) for x in k], c(ts), F.col("_blk"))
    first = F.col("_blk") * F.lit(block).cast("bigint") + 1
    long = explode_range(long, first, F.least(F.col("_fills"), first + (block - 1)), 1, "_i").drop("_blk")
    extra = extra.unionByName(long).select(*[c(x) for x in k], (c(ts) + F.col("_i") * F.col("_step")).alias(ts),
                         *[F.col("_rep").getField(v).alias(v) for v in vals])
    return df.select(*[c(x) for x in k], c(ts), *[c(v) for v in vals]).unionByName(extra)


def downsample(df: DataFrame, interval: int | Column, ts: str = "timestamp", by: Sequence[str] = (),
               values: Sequence[str] | None = None, label: str = "min") -> DataFrame:
    """Average every value per ``interval`` bucket (``ts - pmod(ts, interval)``).  The row is
    labelled with the smallest timestamp in the bucket (``label="min"``) or the bucket start
    (``label="bucket"``).  Text cells are parsed leniently; unparsable text is ignored."""
    k = list(by)
    vals = list(values) if values is not None else value_columns(df, [*k, ts])
    t = quote(ts)
    bucket = floor_to(c(ts), as_col(interval)) if isinstance(interval, Column) \
        else F.expr(f"{t} - pmod({t}, {int(interval)}L)")
    res = (df.groupBy(*[c(x) for x in k], bucket.alias("_bucket"))
             .agg(F.expr(f"min({t}) AS _min_ts"),
                  *[F.expr(f"avg(try_cast({quote(v)} AS DOUBLE)) AS {quote(v)}") for v in vals]))
    lab = "_min_ts" if label == "min" else "_bucket"
    return res.selectExpr(*[quote(x) for x in k], f"{lab} AS {t}", *[quote(v) for v in vals])


def _gcd_sql(a: str, b: str) -> str:
    """Euclid folded by ``aggregate`` over a fixed 92-step sequence (covers all longs)."""
    return (f"aggregate(sequence(1, 92), named_struct('x', CAST({a} AS BIGINT), 'y', CAST({b} AS BIGINT)), "
            "(acc, i) -> IF(acc.y = 0, acc, named_struct('x', acc.y, 'y', acc.x % acc.y)), acc -> acc.x)")


def _branch_sql(interval: str, new: int) -> tuple[str, str]:
    """(step, branch) of a series with its own ``interval``, as SQL."""
    o, nw = interval, f"{int(new)}L"
    step = (f"CASE WHEN {o} IS NULL THEN CAST(NULL AS BIGINT) WHEN {o} = {nw} THEN {nw} "
            f"WHEN {o} < {nw} THEN {o} ELSE {_gcd_sql(o, nw)} END")
    branch = (f"CASE WHEN {o} IS NULL THEN '{SINGLE}' WHEN {o} = {nw} THEN '{EQUAL}' "
              f"WHEN {o} < {nw} THEN '{SLOWER}' ELSE '{FASTER}' END")
    return step, branch


def resample_plan(df: DataFrame, interval: int, ts: str = "timestamp", by: Sequence[str] = (),
                  chunk: int = DAY) -> DataFrame:
    """Per series: (old_interval, new_interval, step, branch)."""
    step, branch = _branch_sql("old_interval", interval)
    return infer_interval(df, ts, by, chunk, "old_interval").selectExpr(
        *[quote(x) for x in by], "old_interval", f"{int(interval)}L AS new_interval", f"{step} AS step", f"{branch} AS branch")


def numeric(df: DataFrame, values: Sequence[str], flag: str = BAD_FLAG) -> DataFrame:
    """Text values -> DOUBLE; rows whose text does not parse get ``flag``."""
    types = dict(df.dtypes)
    text = [v for v in values if types.get(v) == "string"]
    if not text:
        return df
    bad = " OR ".join(f"({quote(v)} IS NOT NULL AND try_cast({quote(v)} AS DOUBLE) IS NULL)" for v in text)
    if flag in df.columns:
        bad = f"{bad} OR coalesce({flag}, false)"
    return df.selectExpr(*[f"try_cast({quote(x)} AS DOUBLE) AS {quote(x)}" if x in text else quote(x) for x in df.columns if x != flag],
                         f"({bad}) AS {flag}")


def resample(df: DataFrame, interval: int, ts: str = "timestamp", by: Sequence[str] = (),
             values: Sequence[str] | None = None, chunk: int = DAY, ties: str = KEEP) -> DataFrame:
    """``resample_with_bounds`` without the bounds."""
    return resample_with_bounds(df, interval, ts, by, values, chunk, ties)[0]


def resample_with_bounds(df: DataFrame, interval: int, ts: str = "timestamp", by: Sequence[str] = (),
                         values: Sequence[str] | None = None, chunk: int = DAY,
                         ties: str = KEEP) -> tuple[DataFrame, DataFrame]:
    """Resample every series of ``df`` to ``interval`` seconds (see module doc).

    One pass reads ``df``: the distinct timestamps with the tied rows' sums and counts and their
    gaps inside time chunks are written to the shared folder.  A table of one row per (series,
    chunk) then holds what crosses chunks, the series' interval and its branch, and meets the rows
    by (series, chunk).  Each row is exploded once: equal-branch series into their fill positions,
    the others into the target buckets they reach (weighted by fill steps), and one hash
    aggregate yields both kinds of output row.

    Output values are DOUBLE.  A ``_bad`` column, for text inputs or where ``df`` has one, flags
    rows whose forward-filled text does not parse, so the validator can drop or fail them; averages
    ignore such text.

    Rows tied on one timestamp all count in averages.  Fills come from one of them (the largest)
    and in the equal branch each of them stays (``ties="keep"``, which reads ``df`` once more for
    them), or they are averaged to one row (``ties="avg"``).

    Also returns the first and last timestamp of ``df`` (one row, ``start`` and ``finish``),
    taken from the written table."""
    if ties not in (KEEP, AVG):
        raise ValueError(f"ties must be {KEEP!r} or {AVG!r}, got {ties!r}")
    new = int(interval)
    k = list(by)
    keys = [c(x) for x in k]
    qk = [quote(x) for x in k]
    t = quote(ts)
    vals = list(values) if values is not None else value_columns(df, [*k, ts, BAD_FLAG])
    df = numeric(df, vals)
    text = BAD_FLAG in df.columns
    doubles = df.selectExpr(*qk, t, *[f"CAST({quote(v)} AS DOUBLE) AS _x{i}" for i, v in enumerate(vals)],
                            *([f"coalesce({BAD_FLAG}, false) AS {BAD_FLAG}"] if text else []))
    width = range(len(vals))
    aggs = [F.expr(f"sum(_x{i}) AS _s{i}") for i in width] + [F.expr(f"count(_x{i}) AS _c{i}") for i in width]
    if ties == KEEP and len(vals) > 1:
        aggs.append(F.max(F.struct(*[c(f"_x{i}") for i in width])).alias("_rep"))
        rep = [f"_rep._x{i} AS _r{i}" for i in width]
    elif ties == KEEP:
        aggs += [F.expr(f"max(_x{i}) AS _r{i}") for i in width]
        rep = [f"_r{i}" for i in width]
    else:
        rep = [f"_s{i} / CASE WHEN _c{i} > 0 THEN _c{i} END AS _r{i}" for i in width]
    if text:
        aggs.append(F.expr(f"max({BAD_FLAG}) AS _bad_rep"))
    rows = materialized(in_chunks(doubles, ts, k, chunk, aggs), "resample-gaps")
    bounds = rows.agg(F.min(c(ts)).alias("start"), F.max(c(ts)).alias("finish"))
    step, branch = _branch_sql("_interval", new)
    heads = chunk_edges(rows, ts, k).select(at_chunk(k), "_following", F.expr(f"{step} AS step"), F.expr(f"{branch} AS branch"))
    dd = rows.withColumn("_at", at_chunk(k)).join(heads, "_at").selectExpr(
        *qk, t, f"coalesce(_next, _following, {t}) AS _next", "step", "branch", *rep, *[f"_s{i}" for i in width],
        *[f"_c{i}" for i in width], *(["_bad_rep"] if text else []))

    # Each row of d explodes once: equal-branch series into fill positions 0 .. n-1, the
    # others into the target buckets their own timestamp and fill steps reach.
    nw = f"{new}L"
    eq = f"(branch = '{EQUAL}')"
    st = f"coalesce(step, {nw})"                              # a single-timestamp series never steps
    n = f"greatest(coalesce((_next - {t}) div step, 1L), 1L)"
    lo = f"CASE WHEN {eq} THEN {0 if ties == AVG else 1}L ELSE {t} - pmod({t}, {nw}) END"
    last = f"{t} + (_steps - 1) * {st}"
    hi = f"CASE WHEN {eq} THEN _steps - 1 ELSE {last} - pmod({last}, {nw}) END"
    inc = f"CASE WHEN {eq} THEN 1L ELSE {nw} END"
    x = explode_range(dd.selectExpr("*", f"{n} AS _steps"), lo, hi, inc, "_x")
    # equal branch: _x is the fill position; other branches: _x is a target bucket
    i_lo = f"CASE WHEN {eq} THEN _x ELSE greatest(0L, -{sql_floor_div(f'{t} - _x', st)}) END"
    i_hi = f"CASE WHEN {eq} THEN _x ELSE least(_steps - 1, {sql_floor_div(f'_x + {nw} - 1 - {t}', st)}) END"
    x = x.selectExpr(*qk, t, "_x", "_steps", "step", "branch", *[f"_r{i}" for i in range(len(vals))],
                     *[f"_s{i}" for i in range(len(vals))], *[f"_c{i}" for i in range(len(vals))],
                     *(["_bad_rep"] if text else []), f"{i_lo} AS _ilo", f"{i_hi} AS _ihi", f"{eq} AS _eq")
    own = "(_ilo = 0 AND NOT _eq)"                           # bucket holding the row's own timestamp
    fills = "CASE WHEN _eq THEN 1L ELSE _ihi - greatest(_ilo, 1L) + 1 END"
    cols = [*qk, f"CASE WHEN _eq THEN {t} + _x * {st} ELSE _x END AS _g", "_eq", f"{t} + _ilo * {st} AS _label"]
    for i in range(len(vals)):
        own_sum = f"CASE WHEN {own} THEN _s{i} END"
        fill_sum = f"CASE WHEN {fills} > 0 THEN _r{i} * {fills} END"
        cols.append(f"coalesce({own_sum} + {fill_sum}, {own_sum}, {fill_sum}) AS _v{i}")
        cols.append(f"(CASE WHEN {own} THEN _c{i} ELSE 0L END) + "
                    f"(CASE WHEN _r{i} IS NOT NULL AND {fills} > 0 THEN {fills} ELSE 0L END) AS _w{i}")
    if text:
        cols.append("(_eq AND _bad_rep) AS _bad")
    parts = x.where("_ilo <= _ihi").selectExpr(*cols)
    out_aggs = [F.expr(f"min(_label) AS {t}")]
    out_aggs += [F.expr(f"sum(_v{i}) / sum(CASE WHEN _w{i} > 0 THEN _w{i} END) AS {quote(v)}")
                 for i, v in enumerate(vals)]
    if text:
        out_aggs.append(F.expr("max(_bad) AS _bad"))
    out = parts.groupBy(*keys, "_g", "_eq").agg(*out_aggs)
    out = out.select(*keys, c(ts), *[c(v) for v in vals], *([c("_bad")] if text else []))
    if ties == AVG:
        return out, bounds
    # the rows of equal-branch series themselves, tied or not
    own = doubles.where(c(ts).isNotNull()).withColumn("_chunk", F.expr(f"{t} - pmod({t}, {int(chunk)}L)"))
    own = own.withColumn("_at", at_chunk(k)).join(heads.where(f"branch = '{EQUAL}'").select("_at"), "_at")
    own = own.selectExpr(*qk, t, *[f"_x{i} AS {quote(v)}" for i, v in enumerate(vals)], *([BAD_FLAG] if text else []))
    return out.unionByName(own), bounds
