"""Metadata look-ups for database imports: dataset -> source connection, dataset -> labels,
and the multi-table tag select."""

from __future__ import annotations

import functools
from typing import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chronoweave.operators._util import c


def resolve_source(datasets: DataFrame, sources: DataFrame, labels: DataFrame | None = None,
                   dataset_id: str = "dsabelid", source_ref: str = "datasourcesid",
                   source_id: str = "id") -> DataFrame:
    """Dataset -> source connection row, and (optionally) -> each of its labels.

    Plain equi-joins: metadata tables are small, and Spark broadcasts whichever side its
    size estimate (and, with AQE, the measured size) puts under the broadcast threshold."""
    ds = datasets.select(c(dataset_id), c(source_ref))
    out = ds.join(sources, ds[source_ref] == sources[source_id], "inner").drop(sources[source_id])
    if labels is not None:
        out = out.join(labels, [dataset_id], "inner")
    return out


def multi_table_select(tables: Sequence[tuple[str, DataFrame]], columns: Sequence[tuple[str, str]],
                       join_on: Sequence[tuple[str, str, str, str]]) -> DataFrame:
    """Select labelled columns from several tables.  Tables must be connected by explicit
    equi-join keys ``(left table, left col, right table, right col)``: a select over several
    tables without keys would be a cartesian product and is refused.

    All keys between a new table and the tables joined so far make one (composite) join
    condition, so every key takes effect.  A column name selected from two tables is given as
    ``table.column`` in the result."""
    frames = dict(tables)
    if len(frames) != len(tables):
        raise ValueError("a table is named twice")
    ends = [((lt, lc), (rt, rc)) for lt, lc, rt, rc in join_on]
    if any(t not in frames for pair in ends for t, _ in pair) or any(a[0] == b[0] for a, b in ends):
        raise ValueError("a join key must name columns of two of the tables")
    wanted = {t: {col for n, col in columns if n == t} for t in frames}
    for pair in ends:
        for t, col in pair:
            wanted[t].add(col)

    # every column under a name of its own
    own = {key: f"_c{i}" for i, key in enumerate((t, col) for t in frames for col in sorted(wanted[t]))}

    def side(t: str) -> DataFrame:
        return frames[t].select(*[c(col).alias(own[t, col]) for col in sorted(wanted[t])])

    def column(t: str, col: str):
        return c(own[t, col])

    first = tables[0][0]
    out, joined = side(first), {first}
    while len(joined) < len(frames):
        for t in frames:
            keys = [(a, b) if b[0] == t else (b, a) for a, b in ends
                    if t not in joined and ((b[0] == t and a[0] in joined) or (a[0] == t and b[0] in joined))]
            if keys:
                break
        else:
            raise ValueError("tables must be connected by join keys; a cartesian product is refused")
        condition = functools.reduce(lambda x, y: x & y, [column(*a) == column(*b) for a, b in keys])
        out = out.join(side(t), condition, "inner")
        joined.add(t)
    names = [col for _, col in columns]
    return out.select(*[column(t, col).alias(col if names.count(col) == 1 else f"{t}.{col}") for t, col in columns])
