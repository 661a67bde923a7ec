"""Spark operators against the literal row-by-row rules on random small series."""

import math

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from chronoweave.operators.align import time_grid
from chronoweave.operators.gaps import infer_interval, next_gap
from chronoweave.operators.pack import pack, unpack
from chronoweave.operators.resample import downsample, resample, upsample

import brute

SETTINGS = settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))

ts_lists = st.lists(st.integers(min_value=0, max_value=5000), min_size=1, max_size=25)


def close(a, b):
    if a is None or b is None:
        return a is None and b is None
    return math.isclose(a, b, rel_tol=1e-9, abs_tol=1e-9)


@SETTINGS
@given(ts=ts_lists, chunk=st.sampled_from([7, 60, 1000, 86400]))
def test_next_gap_matches_lead(spark, ts, chunk):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(ts)], "id long, timestamp long")
    got = sorted((r["timestamp"], r["t"]) for r in next_gap(df, tiebreak="id", chunk=chunk).collect())
    assert got == sorted(brute.gaps(ts))
    iv = infer_interval(df, chunk=chunk).first()["interval"]
    assert iv == brute.interval(ts)


@SETTINGS
@given(ts=st.sets(st.integers(0, 4000), min_size=1, max_size=20), step=st.integers(1, 700))
def test_upsample_counts_and_values(spark, ts, step):
    data = [(t, float(t % 17)) for t in sorted(ts)]
    df = spark.createDataFrame(data, "timestamp long, v double")
    got = sorted((r["timestamp"], r["v"]) for r in upsample(df, step).collect())
    assert got == sorted(brute.upsample(data, step))


@SETTINGS
@given(ts=st.sets(st.integers(0, 4000), min_size=1, max_size=20), iv=st.integers(1, 900))
def test_downsample_labels_inside_bucket(spark, ts, iv):
    data = [(t, float(t % 13)) for t in sorted(ts)]
    df = spark.createDataFrame(data, "timestamp long, v double")
    got = sorted((r["timestamp"], r["v"]) for r in downsample(df, iv).collect())
    exp = sorted(brute.downsample(data, iv))
    assert [g[0] for g in got] == [e[0] for e in exp]
    assert all(close(a[1], b[1]) for a, b in zip(got, exp))


@SETTINGS
@given(ts=st.sets(st.integers(0, 3000), min_size=1, max_size=15),
       old_unit=st.sampled_from([60, 90, 300]), new=st.sampled_from([60, 120, 180, 200, 450, 600]),
       nulls=st.booleans())
def test_resample_matches_literal(spark, ts, old_unit, new, nulls):
    data = [(t * old_unit, None if nulls and t % 4 == 1 else float((t * 7) % 11)) for t in sorted(ts)]
    df = spark.createDataFrame(data, "timestamp long, v double")
    got = sorted((r["timestamp"], r["v"]) for r in resample(df, new).collect())
    exp = sorted(brute.resample(data, new))
    assert [g[0] for g in got] == [e[0] for e in exp]
    assert all(close(a[1], b[1]) for a, b in zip(got, exp))


def test_resample_many_series_one_plan(spark):
    a = [(t * 300, float(t)) for t in range(10)]
    b = [(t * 900, float(2 * t)) for t in range(4)]
    rows = [("a", t, v) for t, v in a] + [("b", t, v) for t, v in b]
    df = spark.createDataFrame(rows, "s string, timestamp long, v double")
    got = {(r["s"], r["timestamp"]): r["v"] for r in resample(df, 600, by=["s"]).collect()}
    exp = {("a", t): v for t, v in brute.resample(a, 600)}
    exp.update({("b", t): v for t, v in brute.resample(b, 600)})
    assert got.keys() == exp.keys()
    assert all(close(got[k], exp[k]) for k in exp)


def test_equal_resample_of_gap_free_series_is_identity(spark):
    data = [(t * 60, float(t)) for t in range(30)]
    df = spark.createDataFrame(data, "timestamp long, v double")
    assert sorted((r[0], r[1]) for r in resample(df, 60).collect()) == data


def test_long_outage_fill(spark):
    # a 10-day outage filled at the gcd step and averaged hourly: one row per hour bucket
    data = [(0, 1.0), (864000, 3.0), (867600, 5.0)]
    df = spark.createDataFrame(data, "timestamp long, v double")
    got = sorted((r[0], r[1]) for r in resample(df, 3000).collect())
    exp = sorted(brute.resample(data, 3000))
    assert len(got) == len(exp) and all(a[0] == b[0] and close(a[1], b[1]) for a, b in zip(got, exp))


@SETTINGS
@given(vals=st.lists(st.one_of(st.none(), st.floats(min_value=-1e6, max_value=1e6, allow_nan=False)),
                     min_size=1, max_size=4))
def test_unpack_of_pack_is_coalesce(spark, vals):
    cols = [f"c{i}" for i in range(len(vals))]
    df = spark.createDataFrame([tuple([1] + vals)], "timestamp long, " + ", ".join(f"{c} double" for c in cols))
    back = unpack(pack(df), [("timestamp", "LongType")] + [(c, "DoubleType") for c in cols]).first()
    assert [back[c] for c in cols] == [0.0 if v is None else v for v in vals]


@SETTINGS
@given(start=st.integers(0, 10000), span=st.integers(0, 20000), iv=st.integers(1, 5000))
def test_grid_has_no_duplicates(spark, start, span, iv):
    got = [r[0] for r in time_grid(spark, start, start + span, iv).collect()]
    assert len(got) == len(set(got))
    n = max(span // iv, 1)
    assert sorted(got) == sorted({start + i * iv for i in range(n)} | {start + span})


@pytest.mark.parametrize("target", [300, 600, 200])
def test_null_series_is_a_series(spark, target):
    rows = ([(None, t * 300, float(t % 5)) for t in range(20)] + [("a", t * 300, float(t % 5)) for t in range(20)]
            + [("b", t * 900, float(t)) for t in range(6)] + [("c", 100, 1.0)])
    df = spark.createDataFrame(rows, "s string, timestamp long, v double")
    got = [tuple(r) for r in resample(df, target, by=["s"]).collect()]
    assert sorted(r[1:] for r in got if r[0] is None) == sorted(r[1:] for r in got if r[0] == "a")
    single = df.where("s = 'a'").drop("s")
    assert sorted(tuple(r) for r in resample(single, target).collect()) == sorted(r[1:] for r in got if r[0] == "a")
    gaps = [tuple(r) for r in next_gap(df, by=["s"], chunk=700).select("s", "timestamp", "t").collect()]
    assert sorted(r[1:] for r in gaps if r[0] is None) == sorted(brute.gaps([t * 300 for t in range(20)]))


def test_ties_stay_or_are_averaged(spark):
    # rows tied at 0 and at 120; 60 is the series' interval, so the branch is "equal"
    data = [(0, 1.0, 9.0), (0, 5.0, 2.0), (60, 3.0, 3.0), (180, 7.0, None), (180, 1.0, 4.0)]
    df = spark.createDataFrame(data, "timestamp long, a double, b double")
    kept = sorted(tuple(r) for r in resample(df, 60, values=["a", "b"]).collect())
    # the gap from 60 to 180 fills once
    assert kept == sorted([*data, (120, 3.0, 3.0)], key=lambda r: (r[0], r[1]))
    mean = sorted(tuple(r) for r in resample(df, 60, values=["a", "b"], ties="avg").collect())
    assert mean == [(0, 3.0, 5.5), (60, 3.0, 3.0), (120, 3.0, 3.0), (180, 4.0, 4.0)]
    # fills come from a row that exists
    late = spark.createDataFrame([(0, 1.0, 9.0), (0, 5.0, 2.0), (120, 0.0, 0.0), (180, 0.0, 0.0)], "timestamp long, a double, b double")
    assert (60, 5.0, 2.0) in {tuple(r) for r in resample(late, 60, values=["a", "b"]).collect()}
    assert (60, 5.0, 2.0) in {tuple(r) for r in upsample(late, 60).collect()}


def test_tiebreak_null_or_equal(spark):
    rows = [(0, 1), (0, 1), (10, None), (10, None), (10, 5), (30, 2)]
    df = spark.createDataFrame(rows, "timestamp long, id int")
    got = sorted((r.timestamp, r.t) for r in next_gap(df, tiebreak="id").collect())
    assert got == sorted(brute.gaps([t for t, _ in rows]))


@SETTINGS
@given(ts=ts_lists)
def test_literal_interval_is_second_smallest_row_gap(spark, ts):
    df = spark.createDataFrame([(t,) for t in ts], "timestamp long")
    gaps = sorted(g for _, g in brute.gaps(ts))
    expected = gaps[1] if len(gaps) > 1 else None
    assert infer_interval(df, literal=True).first()["interval"] == expected
