"""A third of all rows on one timestamp: results stay exact."""

from chronoweave.operators.gaps import infer_interval, next_gap
from chronoweave.operators.resample import resample

import brute


def test_hot_timestamp(spark):
    regular = [(t * 60, float(t % 7)) for t in range(200)]
    hot = [(600, float(i % 5)) for i in range(100)]      # a third of the rows at one timestamp
    rows = [(i, t, v) for i, (t, v) in enumerate(regular + hot)]
    df = spark.createDataFrame(rows, "id long, timestamp long, v double")
    got = sorted((r["timestamp"], r["t"]) for r in next_gap(df, tiebreak="id", chunk=300).collect())
    assert got == sorted(brute.gaps([t for _, t, _ in rows]))
    assert infer_interval(df.select("timestamp", "v")).first()["interval"] == 60
    # averaged branch: every tied row counts in its bucket's average
    out = {r["timestamp"]: r["v"] for r in resample(df.select("timestamp", "v"), 300).collect()}
    bucket = [v for t, v in regular + hot if 600 <= t < 900]
    assert abs(out[600] - sum(bucket) / len(bucket)) < 1e-9
    assert len(out) == 40
