"""Appends as commits, texts in packed cells, time-sorted saves, metadata that stays few files."""

import pytest
from pyspark.sql import functions as F

from chronoweave.operators.align import SOURCE, align_multiplied
from chronoweave.operators.gaps import next_gap
from chronoweave.operators.resample import upsample
from chronoweave.session import list_names
from chronoweave.sources import metalog
from chronoweave.sources.store import DatasetStore

import brute


@pytest.fixture()
def uncoalesced(spark):
    """Small shuffles keep their partitions, as large ones do."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_append_binds_columns_by_name(spark, scratch):
    store = DatasetStore(spark, scratch("bind"))
    store.save(spark.createDataFrame([(1, 1.0, 2.0)], "timestamp long, a double, b double"), "d")
    store.save(spark.createDataFrame([(2, 20.0, 10.0)], "timestamp long, b double, a double"), "d", mode="append")
    store.save(spark.createDataFrame([(3, 5, 6.0)], "timestamp int, a int, b double"), "d", mode="append")
    assert rows_of(store.load("d")) == [(1, 1.0, 2.0), (2, 10.0, 20.0), (3, 5.0, 6.0)]
    for layout, row in (("timestamp long, a double, c double", (4, 1.0, 1.0)), ("timestamp long, a string, b double", (4, "x", 1.0)),
                        ("timestamp long, a double", (4, 1.0)), ("a double, timestamp long, b double", (1.0, 4, 1.0))):
        with pytest.raises(ValueError, match="cannot append"):
            store.save(spark.createDataFrame([row], layout), "d", mode="append")


def test_a_killed_append_is_invisible(spark, scratch, monkeypatch):
    store, layout = DatasetStore(spark, scratch("killed")), "timestamp long, a double"
    store.save(spark.createDataFrame([(1, 1.0)], layout), "d")
    with monkeypatch.context() as m:
        m.setattr(DatasetStore, "_commit", lambda *a, **k: (_ for _ in ()).throw(RuntimeError("killed")))
        with pytest.raises(RuntimeError):
            store.save(spark.createDataFrame([(2, 2.0)], layout), "d", mode="append")
    assert len(list_names(spark, f"{store.root}/appended/d/v1")) == 1  # written, not committed
    assert rows_of(store.load("d")) == [(1, 1.0)]
    store.save(spark.createDataFrame([(3, 3.0)], layout), "d", mode="append")
    assert rows_of(store.load("d")) == [(1, 1.0), (3, 3.0)]
    assert [len(f) for _, f in store.manifest("d", 1)] == [len(list_names(spark, store.manifest("d", 1)[0][0])) - sum(x.startswith(("_", ".")) for x in list_names(spark, store.manifest("d", 1)[0][0]))]
    # an overwrite starts without the old version's appends
    store.save(spark.createDataFrame([(9, 9.0)], layout), "d")
    assert rows_of(store.load("d")) == [(9, 9.0)]


@pytest.mark.parametrize("fmt", ["parquet", "csv"])
def test_texts_come_back(spark, scratch, fmt):
    texts = ["a,b", 'say "x", y', "two\nlines\r\n", "", None, "%2C % %25 %-", "0.0", "ñ 日本", " padded "]
    df = spark.createDataFrame([(i, t, float(i), t) for i, t in enumerate(texts)], "timestamp long, t string, n double, `dotted.u` string")
    store = DatasetStore(spark, scratch(f"texts_{fmt}"), fmt)
    store.save(df, "d")
    store.save(df.select("timestamp", F.col("`dotted.u`"), "n", "t"), "d", mode="append")
    want = sorted([tuple(r) for r in df.collect()] * 2, key=str)
    assert rows_of(store.load("d")) == want
    only = df.select("t", "n")
    store.save(only, "no_time")
    assert rows_of(store.load("no_time")) == rows_of(only)


def test_rows_without_a_codec_stay_readable(spark, scratch):
    store = DatasetStore(spark, scratch("old"))
    spark.createDataFrame([(1, "x%2Cy,2.5")], "timestamp long, data string").write.parquet(f"{store.root}/data/d/v1")
    spark.createDataFrame([("d", '[{"colname":"timestamp","datatype":"LongType","orderby":0},{"colname":"s","datatype":"StringType","orderby":1},'
                                 '{"colname":"v","datatype":"DoubleType","orderby":2}]', "timestamp,s,v", 1)],
                          "tablename string, columns string, tagNames string, version long").write.partitionBy("tablename").parquet(f"{store.root}/catalog")
    assert rows_of(store.load("d")) == [(1, "x%2Cy", 2.5)]


def test_sorted_save_opens_few_files(spark, scratch, uncoalesced):
    store = DatasetStore(spark, scratch("sorted"))
    df = spark.range(20_000).select((F.col("id") * 37 % 20_000 * 10).alias("timestamp"), F.col("id").cast("double").alias("v")).repartition(7)
    store.save(df, "d", by_time=True)
    (_, files), = store.manifest("d", 1)
    assert len(files) > 2 and all(a["last"] < b["first"] for a, b in zip(files, files[1:])) and sum(f["rows"] for f in files) == 20_000
    part = store.load("d", 1000, 2000)
    assert sorted(r.timestamp for r in part.collect()) == list(range(1000, 2001, 10))
    assert len(part.inputFiles()) < len(store.load("d").inputFiles())
    ranked = store.ranked("d")
    assert [(r["rank"], r.timestamp) for r in ranked.orderBy("rank").collect()] == [(i + 1, 10 * i) for i in range(20_000)]
    store.save(df.limit(5), "d", mode="append")
    assert store.load("d").count() == 20_005 and store.load("d", 1000, 2000).count() >= 101
    with pytest.raises(ValueError, match="not one sorted save"):
        store.ranked("d")


def test_metadata_is_compacted(spark, scratch, monkeypatch):
    store, layout = DatasetStore(spark, scratch("compact")), "timestamp long, a double"
    monkeypatch.setattr(metalog, "COMPACT_AFTER", 3)
    for i in range(6):
        store.save(spark.createDataFrame([(i, float(i))], layout), "d")
    store.save(spark.createDataFrame([(0, 0.0)], layout), "other name=x")
    for i in range(5):
        store.save(spark.createDataFrame([(10 + i, 1.0)], layout), "d", mode="append")
    assert store.latest("d")[0] == 6 and store.latest("other name=x")[0] == 1
    assert rows_of(store.catalog().groupBy("tablename").count()) == [("d", 6), ("other name=x", 1)]
    assert sorted(r.timestamp for r in store.load("d").collect()) == [5, 10, 11, 12, 13, 14]
    files = lambda log: len(log._tail_files("d")) + len([x for x in list_names(spark, log.snapshots("d"))])
    assert files(store._catalog) <= 5 and files(store._manifest) <= 5
    # a compaction that died before it deleted what it had copied changes nothing
    with monkeypatch.context() as m:
        m.setattr(metalog, "delete_path", lambda *a: (_ for _ in ()).throw(RuntimeError("died")))
        with pytest.raises(RuntimeError):
            store.compact_metadata("d")
    assert store.latest("d")[0] == 6 and store.catalog("d").count() == 6
    assert store.compact_metadata("d") > 0 and store.compact_metadata("d") == 0
    assert store.catalog("d").count() == 6 and len(store.manifest("d", 6)) == 5


def test_hot_timestamp_is_cut_into_runs(spark, uncoalesced):
    rows = [("a", 100, i) for i in range(4000)] + [("a", t, 0) for t in (50, 130, 170)] + [(None, 100, i) for i in range(30)] + [("b", None, 1), ("b", 7, 1)]
    df = spark.createDataFrame(rows, "s string, timestamp long, `i.d` int").repartition(5)
    got = next_gap(df, by=["s"], tiebreak="i.d", out="gap")
    assert got.columns == ["s", "timestamp", "i.d", "gap"]
    out = rows_of(got.select("s", "timestamp", "gap"))
    want = [(s, t, g) for s in ("a", None, "b") for t, g in brute.gaps([r[1] for r in rows if r[0] == s and r[1] is not None])] + [("b", None, None)]
    assert out == sorted(want, key=str)
    assert [r["i.d"] for r in got.where("s = 'a' and gap = 30").collect()] == [3999]
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Window") == 1 and "hashpartitioning(_c" not in plan


def test_long_outage_is_dealt_in_blocks(spark):
    df = spark.createDataFrame([(0, 1.0), (100_000, 2.0), (100_010, 3.0)], "timestamp long, v double")
    got = upsample(df, 1, block=1000)
    assert rows_of(got) == sorted(brute.upsample([tuple(r) for r in df.collect()], 1), key=str)
    spread = got.groupBy(F.spark_partition_id()).count().collect()
    assert len([r for r in spread if r["count"] > 1000]) > 2


@pytest.mark.parametrize("hot", [1, 10_000])
def test_hot_source_rows_multiply_over_salts(spark, hot):
    long = spark.createDataFrame([("x", 10, float(i), None) for i in range(300)] + [("x", 20, 1.0, None), ("y", 10, 5.0, None), ("y", 30, 6.0, None), ("y", 99, 7.0, None)],
                                 f"{SOURCE} string, timestamp long, _v0 double, _v1 double")
    keys = spark.createDataFrame([(10,), (20,), (30,), (40,)], "timestamp long")
    out = align_multiplied(long, ["a", "b"], {"a": ("x", "_v0"), "b": ("y", "_v0")}, keys, hot_rows=hot)
    want = [(10, float(i), 5.0, True) for i in range(300)] + [(20, 1.0, None, True), (30, None, 6.0, True), (40, None, None, True), (99, None, 7.0, False)]
    assert rows_of(out) == sorted(want, key=str)
    p = out._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(_sx" in p
