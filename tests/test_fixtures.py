"""Golden micro cases (FIXTURES.md section 3)."""

import pytest
from pyspark.sql import functions as F

from chronoweave.functions.time import parse_time_text
from chronoweave.operators.align import align, time_grid
from chronoweave.operators.gaps import infer_interval, next_gap
from chronoweave.operators.pack import pack, pack_rdbms, unpack
from chronoweave.operators.quality import DROP, FAIL, validate
from chronoweave.operators.resample import resample

SERIES = [(0, 1.0), (300, 2.0), (900, 4.0)]


def rows(df, *cols):
    return sorted(tuple(r[c] for c in cols) for r in df.collect())


@pytest.fixture()
def series(spark):
    return spark.createDataFrame(SERIES, "timestamp long, v double")


def test_gaps_and_interval(series):
    assert rows(next_gap(series), "timestamp", "t") == [(0, 300), (300, 600), (900, 0)]
    assert infer_interval(series).first()["interval"] == 300


@pytest.mark.parametrize("target,expected", [
    (300, [(0, 1.0), (300, 2.0), (600, 2.0), (900, 4.0)]),
    (600, [(0, 1.5), (600, 3.0)]),
    (200, [(0, 1.0), (200, 1.5), (400, 2.0), (600, 2.0), (800, 3.0)]),
    (450, [(0, 1.5), (600, 2.0), (900, 4.0)]),
])
def test_resample_branches(series, target, expected):
    assert rows(resample(series, target), "timestamp", "v") == expected


def test_grid_and_align(spark, series):
    grid = time_grid(spark, 0, 1800, 600)
    assert rows(grid, "timestamp") == [(0,), (600,), (1200,), (1800,)]
    res = resample(series, 600)
    out = validate(align(res, ["v"], grid), ["v"], DROP)
    assert rows(out, "timestamp", "v") == [(0, 1.5), (600, 3.0), (1200, 0.0), (1800, 0.0)]


def test_grid_range_not_multiple(spark):
    # (finish - start) div iv = 1 -> one grid step plus finish
    assert rows(time_grid(spark, 0, 1000, 600), "timestamp") == [(0,), (1000,)]
    # interval larger than the range -> start and finish
    assert rows(time_grid(spark, 0, 100, 600), "timestamp") == [(0,), (100,)]
    assert rows(time_grid(spark, 5, 5, 600), "timestamp") == [(5,)]


def test_pack_and_unpack(spark):
    df = spark.createDataFrame([(7, 1.5, None, 2.0)], "timestamp long, a double, b double, c double")
    assert pack(df).first()["data"] == "1.5,0.0,2.0"
    packed = pack_rdbms(df, "timestamp", ["a", "b", "c"])
    assert packed.first()["data"] == "1.5,,2.0"
    entries = [("timestamp", "LongType"), ("a", "DoubleType"), ("b", "DoubleType"), ("c", "DoubleType")]
    assert unpack(packed, entries).first().asDict() == {"timestamp": 7, "a": 1.5, "b": None, "c": 2.0}


def test_pack_without_timestamp(spark):
    df = spark.createDataFrame([(1.0, None)], "x double, y double")
    assert pack(df).columns == ["data"]
    assert pack(df).first()["data"] == "1.0,0.0"
    assert unpack(pack(df), [("x", "DoubleType"), ("y", "DoubleType")]).first().asDict() == {"x": 1.0, "y": 0.0}


def test_validate_policies(spark):
    ok = spark.createDataFrame([(1, "1.5", None)], "timestamp long, a string, b string")
    assert rows(validate(ok, ["a", "b"], DROP), "timestamp", "a", "b") == [(1, 1.5, 0.0)]
    bad = spark.createDataFrame([(1, "1.5", None), (2, "x", "2")], "timestamp long, a string, b string")
    assert rows(validate(bad, ["a", "b"], DROP), "timestamp", "a", "b") == [(1, 1.5, 0.0)]
    with pytest.raises(Exception, match="rejected row at timestamp 2"):
        validate(bad, ["a", "b"], FAIL).collect()


def test_time_text(spark):
    df = spark.createDataFrame([("2020/01/02 03:04:05",), ("2020/1/2 3:4:5",), ("2020/13/01 00:00:00",),
                                ("bad",), (None,)], "s string")
    got = [r[0] for r in df.select(parse_time_text(F.col("s"))).collect()]
    assert got == [1577934245, 1577934245, None, None, None]
    got_utc = [r[0] for r in df.select(parse_time_text(F.col("s"), tz="UTC")).collect()]
    assert got_utc == got
