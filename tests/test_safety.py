"""Nothing is lost, shifted or kept silently: policies, duplicates, store, stream, keys, paths."""

import types

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType, LongType, StringType, TimestampType

from chronoweave import session
from chronoweave.operators._util import idiv
from chronoweave.operators.align import align_by_joins, time_grid_from_bounds
from chronoweave.operators.metadata import multi_table_select
from chronoweave.operators.quality import FAIL, validate
from chronoweave.plans.dataset_import import build_dataset, import_dataset
from chronoweave.plans.rdbms_import import rdbms_import
from chronoweave.sources.csv import read_csv_null_to_zero, read_csv_text, read_tag_csv
from chronoweave.sources.jdbc import quoted_table, range_options
from chronoweave.sources.store import DatasetStore
from chronoweave.specs import ImportRule, SourceSpec, TagSpec
from chronoweave.streaming import start_append_stream


def write_text(spark, path, lines):
    spark.createDataFrame([(x,) for x in lines], "value string").coalesce(1).write.text(path)


# ---- policies -----------------------------------------------------------------------------
def test_fail_policy_checks_every_column(spark):
    df = spark.createDataFrame([(1, "1.5", "2"), (2, "1", "oops")], "timestamp long, a string, b string")
    out = validate(df, ["a", "b"], FAIL)
    for name in out.columns:
        with pytest.raises(Exception, match="rejected row at timestamp 2: bad value oops"):
            out.select(name).collect()


def test_bad_times_fail_or_are_logged(spark, scratch):
    path = scratch("times")
    write_text(spark, path, ["time,v", "1970/01/01 00:00:00,1", "soon,2", "1970/01/01 00:20:00,x", "1970/01/01 00:05:00,3"])
    src = [SourceSpec("CSV", {"path": path, "tz": "UTC"}, (TagSpec(1, "v", "v"),))]
    for bounds in ({}, {"start_ms": 0, "finish_ms": 3_600_000}):
        with pytest.raises(Exception, match="rejected row at timestamp NULL: bad time soon|rejected row at timestamp 1200: bad value x"):
            import_dataset(spark, src, ImportRule("d", **bounds)).collect()
        store = DatasetStore(spark, scratch("times_store"))
        import_dataset(spark, src, ImportRule("d", on_error="drop", **bounds), store, log_rejects=True)
        assert sorted(r.message for r in store.errors().collect()) == ["1200: bad value x", "NULL: bad time soon"]
        assert sorted(tuple(r) for r in store.load("d").collect()) == [(0, 1.0), (300, 3.0)]


def test_off_grid_rows_are_logged(spark, scratch):
    path = scratch("late")
    write_text(spark, path, ["time,v", "1970/01/01 00:05:00,1", "1970/01/01 00:15:00,2"])
    src = [SourceSpec("CSV", {"path": path, "tz": "UTC"}, (TagSpec(1, "v", "v"),))]
    store = DatasetStore(spark, scratch("late_store"))
    rule = ImportRule("d", start_ms=0, finish_ms=1_200_000, interval_s=600, on_error="drop")
    import_dataset(spark, src, rule, store, log_rejects=True)
    assert sorted(r.message for r in store.errors().collect()) == ["300: off the key timeline", "900: off the key timeline"]


@pytest.mark.parametrize("interval", [0, 60])
def test_rows_of_a_source_at_one_time(spark, interval):
    a = spark.createDataFrame([(0, 1.0, 9.0), (0, 5.0, 2.0), (60, 7.0, 7.0)], "timestamp long, a double, b double")
    c = spark.createDataFrame([(0, 3.0), (60, 4.0), (60, 6.0)], "timestamp long, c double")

    def rows(dedupe, on_error="drop"):
        rule = ImportRule("d", start_ms=0, finish_ms=60_000, interval_s=interval, on_error=on_error, dedupe=dedupe)
        return sorted(tuple(r) for r in build_dataset(spark, [("x", a), ("y", c)], ["a", "b", "c"], rule).collect())

    assert rows("multiply") == [(0, 1.0, 9.0, 3.0), (0, 5.0, 2.0, 3.0), (60, 7.0, 7.0, 4.0), (60, 7.0, 7.0, 6.0)]
    assert rows("avg") == [(0, 3.0, 5.5, 3.0), (60, 7.0, 7.0, 5.0)]
    assert rows("fail") == []
    with pytest.raises(Exception, match="several rows of one source"):
        rows("fail", "fail")
    with pytest.raises(ValueError, match="dedupe"):
        rows("max")


# ---- store and stream ---------------------------------------------------------------------
def test_stream_on_a_stored_dataset(spark, scratch):
    store, inbox, ckpt = DatasetStore(spark, scratch("live_store")), scratch("live_inbox"), scratch("live_ckpt")
    layout = "timestamp long, v double"
    store.save(spark.createDataFrame([(1, 1.0), (2, 2.0)], layout), "live")
    src = SourceSpec("CSV", {"path": inbox, "tz": "UTC"}, (TagSpec(1, "p.v", "v"),))
    # the tag is not the file's second column
    write_text(spark, inbox + "/w1", ["time,other,p.v", "1970/01/01 00:00:10,777,1.5"])

    def run():
        start_append_stream(spark, src, "time", ImportRule("live", on_error="drop"), store, ckpt, available_now=True).awaitTermination(120)

    run()
    store.save(spark.createDataFrame([(3, 3.0)], layout), "live", mode="append")
    assert sorted(tuple(r) for r in store.load("live").collect()) == [(1, 1.0), (2, 2.0), (3, 3.0), (10, 1.5)]
    # after an overwrite the stream follows to the new version
    store.save(spark.createDataFrame([(5, 5.0)], layout), "live")
    write_text(spark, inbox + "/w2", ["time,other,p.v", "1970/01/01 00:00:20,1,2.5"])
    run()
    assert sorted(tuple(r) for r in store.load("live").collect()) == [(5, 5.0), (20, 2.5)]
    # and stops when the layout no longer fits
    store.save(spark.createDataFrame([(5, 5.0, 6.0)], layout + ", w double"), "live")
    with pytest.raises(ValueError, match="cannot append"):
        run()


def test_stream_refuses_another_header(spark, scratch):
    store, inbox = DatasetStore(spark, scratch("hdr_store")), scratch("hdr_inbox")
    src = SourceSpec("CSV", {"path": inbox, "tz": "UTC", "columns": ["time", "p.v", "p.w"]}, (TagSpec(1, "p.v", "v"), TagSpec(2, "p.w", "w")))
    write_text(spark, inbox + "/w1", ["time,p.w,p.v", "1970/01/01 00:00:10,1,2"])
    q = start_append_stream(spark, src, "time", ImportRule("hdr", on_error="drop"), store, scratch("hdr_ckpt"), available_now=True)
    with pytest.raises(Exception):
        q.awaitTermination(120)
    assert store.load("hdr").count() == 0
    with pytest.raises(Exception):
        read_tag_csv(spark, inbox + "/w1", list(src.tags), columns=["time", "p.v", "p.w"]).collect()


def test_store_saves_only_what_it_can_load(spark, scratch):
    store = DatasetStore(spark, scratch("types"))
    df = spark.createDataFrame([(1, 1.0)], "timestamp long, x double")
    with pytest.raises(ValueError, match="FloatType"):
        store.save(df.select("timestamp", F.col("x").cast(FloatType())), "d")
    text = DatasetStore(spark, scratch("csv_store"), "csv")
    text.save(spark.createDataFrame([(1.5, 2.0), (None, 3.0)], "a double, b double"), "plain")
    assert sorted(tuple(r) for r in text.load("plain").collect()) == [(0.0, 3.0), (1.5, 2.0)]
    text.save(df, "timed")
    assert [tuple(r) for r in text.load("timed").collect()] == [(1, 1.0)]


def test_versions_are_claimed_once(spark, scratch):
    store = DatasetStore(spark, scratch("claims"))
    assert [store.claim_version("d") for _ in range(3)] == [1, 2, 3]
    store.save(spark.createDataFrame([(1, 1.0)], "timestamp long, x double"), "d")
    assert store.latest("d")[0] == 4 and store.claim_version("other") == 1


# ---- database-style import ----------------------------------------------------------------
def test_imported_dataset_loads(spark, scratch):
    folder = scratch("db")
    spark.createDataFrame([(1000, 5.0, 7), (2000, None, 8)], "ts long, a double, b int").write.parquet(f"{folder}/t.parquet")
    spark.createDataFrame([(1000, 1, "x")], "k long, a int, name string").write.parquet(f"{folder}/u.parquet")
    datasets = spark.createDataFrame([("d", "s")], "dsabelid string, datasourcesid string")
    sources = spark.createDataFrame([("s", "PARQUET", folder)], "id string, dstype string, dsexample string")

    def labels(*rows):
        return spark.createDataFrame([("d", *r) for r in rows], "dsabelid string, tablename string, labelid string, timestampif int")

    store = DatasetStore(spark, scratch("db_store"))
    one = labels(("t", "db.t.ts", 1), ("t", "db.t.a", 0), ("t", "db.t.b", 0))
    rdbms_import(spark, "d", ImportRule("d"), datasets, sources, one, store)
    loaded = store.load("d")
    assert loaded.columns == ["timestamp", "db.t.a", "db.t.b"]
    assert sorted((tuple(r) for r in loaded.collect()), key=str) == [(1000, 5.0, 7.0), (2000, None, 8.0)]
    two = labels(("t", "db.t.ts", 1), ("t", "db.t.a", 0), ("u", "db.u.a", 0))
    rdbms_import(spark, "d", ImportRule("d"), datasets, sources, two, store, [("t", "ts", "u", "k")])
    assert [tuple(r) for r in store.load("d").collect()] == [(1000, 5.0, 1.0)]
    with pytest.raises(ValueError, match="not numbers"):
        rdbms_import(spark, "d", ImportRule("d"), datasets, sources, labels(("t", "db.t.ts", 1), ("u", "db.u.name", 0)), store, [("t", "ts", "u", "k")])


def test_all_join_keys_count(spark):
    a = spark.createDataFrame([(1, 1, "x"), (1, 2, "y")], "k int, m int, v string")
    b = spark.createDataFrame([(1, 1, "p"), (1, 3, "q")], "k int, m int, v string")
    c = spark.createDataFrame([("p", 1, 10), ("p", 9, 20)], "v string, k int, n int")
    keys = [("a", "k", "b", "k"), ("b", "m", "a", "m")]
    out = multi_table_select([("a", a), ("b", b)], [("a", "v"), ("b", "v")], keys)
    assert out.columns == ["a.v", "b.v"] and [tuple(r) for r in out.collect()] == [("x", "p")]
    keys += [("b", "v", "c", "v"), ("c", "k", "a", "k")]
    out = multi_table_select([("a", a), ("b", b), ("c", c)], [("a", "m"), ("c", "n")], keys)
    assert [tuple(r) for r in out.collect()] == [(1, 10)]


def test_jdbc_scan_options():
    assert quoted_table("ORACLE", "s.my table") == '"s"."my table"' and quoted_table("MYSQL", "a`b") == "`a``b`"
    assert quoted_table("SQLSERVER", "dbo.t") == "[dbo].[t]" and quoted_table("DERBY", "t") == "t"
    assert range_options("ts", LongType(), 0, 99, 4) == {"partitionColumn": "ts", "lowerBound": "0", "upperBound": "100", "numPartitions": "4"}
    assert range_options("ts", TimestampType(), 0, 59, 2)["upperBound"] == "1970-01-01 00:01:00"
    assert range_options("ts", StringType(), 0, 99, 4) == {} == range_options("ts", DoubleType(), None, 99, 4) == range_options("ts", LongType(), 0, 99, 1)


# ---- alignment, arithmetic, reading ---------------------------------------------------------
def test_off_timeline_rows_do_not_meet_in_one_partition(spark):
    keys = spark.range(0, 10_000, 100).select(F.col("id").alias("timestamp"))
    sides = [spark.range(10_000).select(F.col("id").alias("timestamp"), F.lit(float(i)).alias(f"v{i}")) for i in range(3)]
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "50")
    try:
        out = align_by_joins(keys, sides, ["v0", "v1", "v2"])
        sizes = [r["count"] for r in out.groupBy(F.spark_partition_id()).count().collect()]
    finally:
        for k in ("autoBroadcastJoinThreshold", "adaptive.enabled"):
            spark.conf.unset(f"spark.sql.{k}")
        spark.conf.set("spark.sql.shuffle.partitions", "8")
    assert sum(sizes) == 100 + 3 * 9_900 and max(sizes) < 3 * sum(sizes) / len(sizes)


def test_exact_division_and_empty_timeline(spark):
    big = 2**60 + 7
    df = spark.createDataFrame([(big, 3), (-big, 3), (-1, 4)], "a long, b long")
    assert [r[0] for r in df.select(idiv(F.col("a"), F.col("b"))).collect()] == [big // 3, -big // 3, -1]
    none = spark.createDataFrame([(None, None)], "start long, finish long")
    assert time_grid_from_bounds(none, 60).collect() == []


def test_declared_schema_and_text_scan(spark, scratch):
    path = scratch("declared")
    write_text(spark, path, ["date,a,b", "100,1.0,null", "200,,x"])
    df = read_csv_null_to_zero(spark, path, schema="date long, a double, b string")
    assert sorted(tuple(r) for r in df.collect()) == [(100, 1.0, "0"), (200, 0.0, "x")]
    assert read_csv_text(spark, path).dtypes == [("date", "string"), ("a", "string"), ("b", "string")]


def test_many_folders_in_one_scan(spark, scratch):
    a, b = scratch("one"), scratch("two")
    for p, v in ((a, 1), (b, 2)):
        write_text(spark, p, ["time,v", f"1970/01/01 00:00:0{v},{v}"])
    df = read_tag_csv(spark, [a, b], [TagSpec(1, "v", "v")], tz="UTC")
    assert sorted(tuple(r) for r in df.collect()) == [(1, "1"), (2, "2")]


# ---- shared paths -----------------------------------------------------------------------------
def fake(master, configured=None):
    state = {}
    conf = types.SimpleNamespace(get=lambda k, d=None: configured or d)
    sc = types.SimpleNamespace(master=master, getCheckpointDir=lambda: state.get("dir"), getConf=lambda: conf,
                               setCheckpointDir=lambda d: state.update(dir=d))
    return types.SimpleNamespace(sparkContext=sc)


def test_shared_folder_must_be_named_on_a_cluster():
    for master in ("yarn", "spark://h:7077", "local-cluster[2,1,1024]", "k8s://h"):
        with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
            session.shared_dir(fake(master))
        assert session.shared_dir(fake(master, "hdfs://nn/shared")) == "hdfs://nn/shared"
    assert "chronoweave-ckpt-" in session.shared_dir(fake("local[4]"))


def test_paths_without_scheme_belong_to_the_default_file_system(spark, scratch, tmp_path):
    assert session.path_exists(spark, str(tmp_path)) and not session.path_exists(spark, str(tmp_path / "none"))
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    before = conf.get("fs.defaultFS")
    conf.set("fs.viewfs.mounttable.test.link./in", f"file://{tmp_path}")
    conf.set("fs.defaultFS", "viewfs://test")
    try:
        (tmp_path / "there").mkdir()
        assert session.path_exists(spark, "/in/there") and not session.path_exists(spark, "/in/elsewhere")
    finally:
        conf.set("fs.defaultFS", before)


def test_scratch_is_released(spark):
    path = session.scratch_path(spark, "gone")
    spark.range(3).write.parquet(path)
    others = session._scratch[spark.sparkContext.applicationId]
    session._scratch[spark.sparkContext.applicationId] = [path]
    assert session.release_scratch(spark) == 1 and not session.path_exists(spark, path)
    session._scratch[spark.sparkContext.applicationId] = [p for p in others if p != path]
