"""Range generation in bounded blocks: block edges, empty ranges, long outages."""

import pytest
from pyspark.sql import functions as F

from chronoweave.operators._util import explode_range
from chronoweave.operators.align import time_grid_from_bounds
from chronoweave.operators.resample import resample, upsample

import brute


@pytest.mark.parametrize("lo,hi,step,block", [(0, 10, 1, 3), (5, 5, 1, 3), (7, 6, 1, 3), (0, 100, 7, 4),
                                             (-20, 20, 5, 2), (0, 9, 3, 1)])
def test_explode_range_blocks(spark, lo, hi, step, block):
    df = spark.createDataFrame([(1,)], "k int")
    got = sorted(r["v"] for r in explode_range(df, F.lit(lo), F.lit(hi), step, "v", block=block).collect())
    assert got == list(range(lo, hi + 1, step))


def test_long_outage_upsample_crosses_blocks(spark):
    data = [(0, 1.0), (5000 * 60, 2.0)]               # 5000 fill steps: two blocks of 4096
    df = spark.createDataFrame(data, "timestamp long, v double")
    got = sorted((r[0], r[1]) for r in upsample(df, 60).collect())
    assert got == sorted(brute.upsample(data, 60))
    got = sorted((r[0], r[1]) for r in resample(df, 60).collect())
    assert len(got) == 5001 and got[-1] == (300000, 2.0) and got[4999] == (299940, 1.0)


def test_grid_from_bounds_many_blocks(spark):
    bounds = spark.createDataFrame([(0, 1_000_000)], "start long, finish long")
    got = sorted(r[0] for r in time_grid_from_bounds(bounds, 7, block=1000).collect())
    assert got == sorted(set(range(0, (1_000_000 // 7) * 7, 7)) | {1_000_000})
