"""Append stream: files arriving in two waves are appended once each."""

from chronoweave.sources.store import DatasetStore
from chronoweave.specs import ImportRule, SourceSpec, TagSpec
from chronoweave.streaming import start_append_stream


def write_text(spark, path, lines):
    spark.createDataFrame([(x,) for x in lines], "value string").coalesce(1).write.text(path)


def test_append_stream_two_waves(spark, scratch):
    inbox, store_root, ckpt = scratch("inbox"), scratch("store"), scratch("ckpt")
    store = DatasetStore(spark, store_root)
    src = SourceSpec("CSV", {"path": inbox, "tz": "UTC"}, (TagSpec(1, "p.v", "v"), TagSpec(2, "p.w", "w")))
    rule = ImportRule("live", on_error="drop")
    write_text(spark, inbox + "/wave1", ["time,p.v,p.w", "1970/01/01 00:00:10,1.5,", "1970/01/01 00:00:20,x,2"])
    start_append_stream(spark, src, "time", rule, store, ckpt, available_now=True).awaitTermination(120)
    write_text(spark, inbox + "/wave2", ["time,p.v,p.w", "1970/01/01 00:00:30,3,4"])
    start_append_stream(spark, src, "time", rule, store, ckpt, available_now=True).awaitTermination(120)
    # a restart with nothing new appends nothing
    start_append_stream(spark, src, "time", rule, store, ckpt, available_now=True).awaitTermination(120)
    got = sorted(tuple(r) for r in store.load("live").collect())
    assert got == [(10, 1.5, 0.0), (30, 3.0, 4.0)]
    assert store.entries("live") == [("timestamp", "LongType"), ("v", "DoubleType"), ("w", "DoubleType")]


def test_append_stream_fail_policy_stops(spark, scratch):
    import pytest

    inbox, store_root, ckpt = scratch("inbox_f"), scratch("store_f"), scratch("ckpt_f")
    store = DatasetStore(spark, store_root)
    src = SourceSpec("CSV", {"path": inbox, "tz": "UTC"}, (TagSpec(1, "p.v", "v"),))
    write_text(spark, inbox + "/w1", ["time,p.v", "1970/01/01 00:00:10,1.5", "1970/01/01 00:00:20,oops"])
    q = start_append_stream(spark, src, "time", ImportRule("strict", on_error="fail"), store, ckpt, available_now=True)
    with pytest.raises(Exception, match="rejected row at timestamp 20"):
        q.awaitTermination(120)
    assert store.load("strict").count() == 0
