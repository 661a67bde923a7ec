"""Sources and sinks: CSV tag files, inferred CSV, Parquet tag tables, the dataset store and
its catalog, JDBC options."""

import pytest
from pyspark.sql import functions as F

from chronoweave.operators.catalog import (
    catalog_from_labels, check_append, explode_entries, schema_from_names, schema_pairs, spark_type,
)
from chronoweave.operators.quality import type_error_counts
from chronoweave.sources.csv import read_csv_null_to_zero, read_tag_csv, write_tag_csv
from chronoweave.sources.jdbc import Connection
from chronoweave.sources.registry import read_source
from chronoweave.sources.store import DatasetStore
from chronoweave.sources.tables import read_tag_table
from chronoweave.specs import ImportRule, SourceSpec, TagSpec, tags_in_order


def write_text(spark, path, lines):
    spark.createDataFrame([(x,) for x in lines], "value string").coalesce(1).write.text(path)


def test_tag_csv_dotted_names_range_and_null_text(spark, scratch):
    path = scratch("tags")
    write_text(spark, path, [
        "time,plant.a.temp,plant.a.flow,other",
        "2020/01/02 00:00:00,1.5,null,x",
        "2020/1/2 0:10:0,2.5,,y",
        "2020/01/02 00:20:00, 3 ,4,z",
        "bad time,9,9,9",
    ])
    tags = [TagSpec(2, "plant.a.temp", "temp"), TagSpec(1, "plant.a.flow", "flow")]
    df = read_tag_csv(spark, path, tags, start_s=1577923200, finish_s=1577923800)
    assert df.columns == ["timestamp", "temp", "flow"]
    got = sorted(tuple(r) for r in df.collect())
    assert got == [(1577923200, "1.5", "null"), (1577923800, "2.5", None)]


def test_inferred_csv_null_rules(spark, scratch):
    path = scratch("inferred")
    write_text(spark, path, ["time,a,b", "2020/01/02 00:00:00,1.5,null", "2020/01/02 00:10:00,,x"])
    df = read_csv_null_to_zero(spark, path)
    got = sorted(tuple(r) for r in df.collect())
    assert got == [(1577923200, 1.5, "0"), (1577923800, 0.0, "x")]


def test_epoch_first_column_used_as_is(spark, scratch):
    path = scratch("epoch")
    write_text(spark, path, ["date,a", "100,1.0", "200,"])
    assert sorted(tuple(r) for r in read_csv_null_to_zero(spark, path).collect()) == [(100, 1.0), (200, 0.0)]


def test_type_error_counts(spark):
    df = spark.createDataFrame([("1", "2.5", "x"), ("t", "3", None), ("3", "y", "4")], "t string, a string, b string")
    got = {r["column"]: r["n_bad"] for r in type_error_counts(df).collect()}
    assert got == {"t": 1, "a": 1, "b": 1}


def test_tag_csv_round_trip(spark, scratch):
    path = scratch("rt")
    df = spark.createDataFrame([(1577923200, 1.25), (1577923260, None)], "timestamp long, `x.y` double")
    write_tag_csv(df, path)
    back = read_tag_csv(spark, path, [TagSpec(1, "x.y", "xy")], tz="UTC")
    assert sorted(tuple(r) for r in back.collect()) == [(1577923200, "1.25"), (1577923260, None)]


def test_parquet_tag_table_pushes_range(spark, scratch):
    path = scratch("table")
    spark.createDataFrame([("2020-01-02 00:00:00", 1.0), ("2020-01-03 00:00:00", 2.0)], "t string, v double") \
        .select(F.col("t").cast("timestamp_ntz").alias("t"), "v").write.parquet(path)
    df = read_tag_table(spark, path, "t", [TagSpec(1, "v", "val")], start_s=1577923200, finish_s=1577923200 + 3600)
    assert [tuple(r) for r in df.collect()] == [(1577923200, 1.0)]
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters" in plan and "GreaterThanOrEqual(t," in plan


def test_store_overwrite_append_versions(spark, scratch):
    store = DatasetStore(spark, scratch("store"))
    a = spark.createDataFrame([(1, 1.0, None)], "timestamp long, x double, y double")
    store.save(a, "ds")
    store.save(a.select("timestamp", "x"), "ds")          # second version: fewer columns
    assert store.entries("ds") == [("timestamp", "LongType"), ("x", "DoubleType")]
    store.save(spark.createDataFrame([(2, 2.0)], "timestamp long, x double"), "ds", mode="append")
    assert sorted(tuple(r) for r in store.load("ds").collect()) == [(1, 1.0), (2, 2.0)]
    with pytest.raises(ValueError, match="columns"):
        store.save(a, "ds", mode="append")
    with pytest.raises(ValueError, match="save mode"):
        store.save(a, "ds", mode="ignore")
    versions = sorted(r["version"] for r in store.catalog().collect())
    assert versions == [1, 2]


def test_append_layout_check():
    from pyspark.sql.types import DoubleType, StructField, StructType

    with pytest.raises(ValueError, match="timestamp"):
        check_append([("timestamp", "LongType"), ("a", "DoubleType")],
                     StructType([StructField("a", DoubleType()), StructField("b", DoubleType())]))
    check_append([("a", "DoubleType")], StructType([StructField("b", DoubleType())]))


def test_store_dataset_without_timestamp(spark, scratch):
    store = DatasetStore(spark, scratch("store2"))
    store.save(spark.createDataFrame([(1.0, 2.0)], "a double, b double"), "plain")
    assert store.load("plain").first().asDict() == {"a": 1.0, "b": 2.0}


def test_catalog_from_labels_orders_time_first(spark):
    labels = spark.createDataFrame([("d1", "db.t.b", 2, 0), ("d1", "db.t.ts", 9, 1), ("d1", "db.t.a", 1, 0),
                                    ("d2", "db.u.z", 1, 0)], "ds string, label string, o int, is_t int")
    cat = catalog_from_labels(labels, "ds", "label", "o", "is_t")
    names = {r["tablename"]: r["tagNames"] for r in cat.collect()}
    assert names == {"d1": "timestamp,a,b", "d2": "z"}
    ent = sorted((r["tablename"], r["orderby"], r["colname"], r["datatype"]) for r in explode_entries(cat).collect())
    assert ent == [("d1", 0, "timestamp", "LongType"), ("d1", 1, "db.t.a", "DoubleType"), ("d1", 2, "db.t.b", "DoubleType"),
                   ("d2", 0, "db.u.z", "DoubleType")]


def test_type_names():
    pairs = [("a", "Double"), ("b", "LongType"), ("c", "String"), ("d", "Date"), ("e", "IntegerType")]
    assert schema_pairs(schema_from_names(pairs)) == [
        ("a", "DoubleType"), ("b", "LongType"), ("c", "StringType"), ("d", "DateType"), ("e", "IntegerType")]
    with pytest.raises(ValueError):
        spark_type("Decimal")


def test_specs():
    with pytest.raises(ValueError):
        TagSpec(1, "a", "a", "StringType")
    s1 = SourceSpec("CSV", {"path": "x"}, (TagSpec(2, "a", "A"),))
    s2 = SourceSpec("CSV", {"path": "y"}, (TagSpec(1, "b", "B"),))
    assert [t.name for t in tags_in_order([s1, s2])] == ["B", "A"]
    with pytest.raises(ValueError):
        tags_in_order([s1, SourceSpec("CSV", {}, (TagSpec(2, "c", "C"),))])
    r = ImportRule.from_json_fields({"newDatasetID": "n", "startTime": "1000", "finishTime": "",
                                     "timeInterval": "0", "typesOfException": None})
    assert (r.start_s, r.finish_s, r.interval_s, r.on_error) == (1, None, 0, "fail")
    assert ImportRule.from_json_fields({"typesOfException": "0"}).on_error == "drop"
    assert ImportRule.from_json_fields({"typesOfException": "1"}).on_error == "fail"


def test_unknown_source_kind(spark):
    with pytest.raises(ValueError, match="unknown source kind"):
        read_source(spark, SourceSpec("mysql-ish", {}, ()))


def test_jdbc_connection_options():
    c = Connection.from_row({"dstype": "MYSQL", "dsip": "h", "dsport": "3306", "dsexample": "db",
                             "dsloginid": "u", "dspwd": "p"})
    opts = c.options()
    assert opts["url"] == "jdbc:mysql://h:3306/db" and opts["user"] == "u" and "driver" in opts
    assert Connection("ORACLE", "h", "1521", "svc").jdbc_url() == "jdbc:oracle:thin:@//h:1521/svc"
    assert Connection("SQLSERVER", "h", "1433", "db").jdbc_url() == "jdbc:sqlserver://h:1433;DatabaseName=db"
    with pytest.raises(ValueError):
        Connection("OTHER").jdbc_url()


def test_failed_overwrite_keeps_previous_version(spark, scratch):
    from chronoweave.operators.quality import FAIL, validate

    store = DatasetStore(spark, scratch("atomic"))
    good = spark.createDataFrame([(1, 1.0)], "timestamp long, x double")
    store.save(good, "ds")
    bad = validate(spark.createDataFrame([(2, "oops")], "timestamp long, x string"), ["x"], FAIL)
    with pytest.raises(Exception, match="rejected row"):
        store.save(bad, "ds")
    assert [tuple(r) for r in store.load("ds").collect()] == [(1, 1.0)]
    assert store.latest("ds")[0] == 1


def test_tag_csv_declared_columns(spark, scratch):
    path = scratch("declared")
    write_text(spark, path, ["t,a.b,c", "2020/01/02 00:00:00,1,2", "2020/01/02 00:01:00,3,"])
    df = read_tag_csv(spark, path, [TagSpec(1, "a.b", "ab")], columns=["t", "a.b", "c"])
    assert sorted(tuple(r) for r in df.collect()) == [(1577923200, "1"), (1577923260, "3")]


def test_next_gap_without_tiebreak(spark):
    from chronoweave.operators.gaps import next_gap
    import brute

    ts = [5, 5, 5, 9, 20, 20, 31]
    df = spark.createDataFrame([(t,) for t in ts], "timestamp long")
    got = sorted((r["timestamp"], r["t"]) for r in next_gap(df, chunk=10).collect())
    assert got == sorted(brute.gaps(ts))


@pytest.mark.parametrize("kind", ["timestamp_ntz", "timestamp", "epoch", "text"])
def test_table_time_kinds(spark, scratch, kind):
    path = scratch("kinds")
    base = spark.createDataFrame([(1577923200, 1.0), (1577923260, 2.0), (1577930000, 3.0)], "e long, v double")
    t = {"timestamp_ntz": "timestampadd(SECOND, e, TIMESTAMP_NTZ'1970-01-01 00:00:00')",
         "timestamp": "timestamp_seconds(e)", "epoch": "e",
         "text": "date_format(timestampadd(SECOND, e, TIMESTAMP_NTZ'1970-01-01 00:00:00'), 'yyyy/MM/dd HH:mm:ss')"}[kind]
    base.selectExpr(f"{t} AS t", "v").write.parquet(path)
    src = SourceSpec("PARQUET", {"path": path}, (TagSpec(1, "v", "val"),), time_column="t")
    got = sorted(tuple(r) for r in read_source(spark, src, 1577923200, 1577923260).collect())
    assert got == [(1577923200, 1.0), (1577923260, 2.0)]


def test_register_view(spark, scratch):
    store = DatasetStore(spark, scratch("view"))
    store.save(spark.createDataFrame([(1, 2.0)], "timestamp long, x double"), "ds")
    store.register("ds", "ds_view")
    assert spark.sql("SELECT sum(x) AS s FROM ds_view").first()["s"] == 2.0


@pytest.mark.parametrize("fmt", ["orc", "json"])
def test_store_other_formats(spark, scratch, fmt):
    store = DatasetStore(spark, scratch("fmt"), fmt)
    store.save(spark.createDataFrame([(1, 1.5, None)], "timestamp long, a double, b double"), "ds")
    store.save(spark.createDataFrame([(2, 2.5, 3.0)], "timestamp long, a double, b double"), "ds", mode="append")
    assert sorted(tuple(r) for r in store.load("ds").collect()) == [(1, 1.5, 0.0), (2, 2.5, 3.0)]


def test_error_log_empty_then_appended(spark, scratch):
    store = DatasetStore(spark, scratch("errs"))
    assert store.errors().count() == 0
    store.log_errors(spark.createDataFrame([("app", "m1")], "app string, message string"))
    store.log_errors(spark.createDataFrame([("app", "m2")], "app string, message string"))
    assert sorted(r["message"] for r in store.errors().collect()) == ["m1", "m2"]


def test_tag_csv_file_name(spark, scratch):
    path = scratch("named")
    write_text(spark, path, ["t,v", "2020/01/02 00:00:00,1"])
    df = read_tag_csv(spark, path, [TagSpec(1, "v", "v")], with_file=True)
    (row,) = df.collect()
    assert row["timestamp"] == 1577923200 and row["v"] == "1"
    assert row["_file"].startswith("part-") and not row["_file"].endswith(".csv")


def test_append_to_missing_dataset_raises(spark, scratch):
    store = DatasetStore(spark, scratch("missing"))
    with pytest.raises(KeyError, match="not in the catalog"):
        store.save(spark.createDataFrame([(1, 1.0)], "timestamp long, x double"), "nope", mode="append")
