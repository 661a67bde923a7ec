"""Metadata look-ups: keyed multi-table selects only, one source per dataset."""

import pytest

from chronoweave.operators.metadata import multi_table_select
from chronoweave.plans.rdbms_import import rdbms_import
from chronoweave.specs import ImportRule


def test_multi_table_select_needs_keys(spark):
    a = spark.createDataFrame([(1, "x")], "k int, a string")
    b = spark.createDataFrame([(1, "y")], "k2 int, b string")
    with pytest.raises(ValueError, match="cartesian"):
        multi_table_select([("a", a), ("b", b)], [("a", "a"), ("b", "b")], [])
    got = multi_table_select([("a", a), ("b", b)], [("a", "a"), ("b", "b")], [("a", "k", "b", "k2")]).collect()
    assert [tuple(r) for r in got] == [("x", "y")]


def test_rdbms_import_needs_one_source(spark):
    datasets = spark.createDataFrame([("d", "s1"), ("d", "s2")], "dsabelid string, datasourcesid string")
    sources = spark.createDataFrame([("s1", "PARQUET", "/nowhere"), ("s2", "PARQUET", "/nowhere")],
                                    "id string, dstype string, dsexample string")
    labels = spark.createDataFrame([("d", "t", "db.t.ts", 1)], "dsabelid string, tablename string, labelid string, timestampif int")
    with pytest.raises(ValueError, match="exactly one source"):
        rdbms_import(spark, "d", ImportRule("d"), datasets, sources, labels)


def test_one_sided_ranges(spark):
    from pyspark.sql import functions as F

    from chronoweave.operators.filters import raw_time_range_filter, time_range_filter

    df = spark.createDataFrame([(t,) for t in (10, 20, 30)], "timestamp long")
    assert [r[0] for r in time_range_filter(df, start_s=20).collect()] == [20, 30]
    assert [r[0] for r in time_range_filter(df, finish_s=20).collect()] == [10, 20]
    assert time_range_filter(df).count() == 3
    raw = df.select(F.expr("timestampadd(SECOND, timestamp, TIMESTAMP_NTZ'1970-01-01 00:00:00')").alias("t"))
    assert raw_time_range_filter(raw, "t", finish_s=20).count() == 2
    assert raw_time_range_filter(raw, "t", start_s=21).count() == 1
