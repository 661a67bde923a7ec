"""Plan shape: filters and columns reach the scan, no cartesian or nested-loop joins, no
window that puts all rows of a series into one task."""

import re

from __spark_entry__ import queries

SF = "/root/testdata/sf0.001"


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_range_filter_is_pushed_and_columns_pruned(spark):
    p = plan_of(queries()["time_range_filter"](spark, SF))
    assert "PushedFilters: [IsNotNull(ts), GreaterThanOrEqual(ts,2024-01-02T00:00)" in p
    assert "ReadSchema: struct<event_id:bigint,ts:timestamp_ntz,event_type:string,value:double>" in p


def test_flagship_plan_has_no_cartesian_join(spark):
    p = plan_of(queries()["align_multi_source"](spark, SF))
    for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython"):
        assert bad not in p
    assert "props" not in p.split("ReadSchema")[1].split("\n")[0]


def events(spark):
    from pyspark.sql import functions as F

    from chronoweave.functions.time import epoch_seconds

    return spark.read.parquet(f"{SF}/events.parquet").select(epoch_seconds(F.col("ts")).alias("timestamp"), "event_type", "value")


def test_row_window_is_inside_chunks(spark):
    from chronoweave.operators.gaps import chunk_edges, in_chunks

    rows = in_chunks(events(spark), by=["event_type"])
    p = plan_of(rows)
    assert p.count("Window [lead(") == 1 and "SinglePartition" not in p
    line = next(x for x in p.split("\n") if "Window [lead(" in x)
    assert "windowspecdefinition(event_type" in line and "_chunk" in line
    # without a series key the windows over chunk rows are on one partition, those over rows are not
    single = plan_of(chunk_edges(in_chunks(events(spark))))
    lines = single.split("\n")
    at = [i for i, x in enumerate(lines) if "Exchange SinglePartition" in x]
    assert len(at) == 1 and "HashAggregate(keys=[_chunk" in lines[at[0] + 1]


def test_infer_interval_reads_its_input_once(spark):
    p = plan_of(queries()["infer_interval"](spark, SF))
    assert p.count("FileScan") == 1 and "SinglePartition" not in p


def test_flagship_runs_on_the_written_gap_table(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        p = plan_of(queries()["align_multi_source"](spark, SF))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    # events were read when the gap table was written; no row is shuffled by its series alone
    assert p.count("FileScan") == 2 and "event_type" not in p
    rows_path, chunk_table = p.split("SortMergeJoin", 1)
    assert not re.search(r"hashpartitioning\(_source#\d+, \d+\)", rows_path)
    assert "_interval" in chunk_table
    joins = [x for x in p.split("\n") if "SortMergeJoin" in x]
    assert len(joins) == 1 and "_at" in joins[0]


def test_gaps_are_stitched_between_written_runs(spark):
    p = plan_of(queries()["next_gap"](spark, SF))
    # rows come from the written runs; the only window is over one row a run, and no row is shuffled
    assert "ts#" not in p.replace("timestamp", "") and p.count("Window [lead(") == 1
    assert all("_run" in x or "SinglePartition" in x for x in p.split("\n") if "Exchange" in x and "Broadcast" not in x)


def test_csv_folders_are_one_scan(spark, scratch):
    from chronoweave.plans.dataset_import import read_sources
    from chronoweave.specs import ImportRule, SourceSpec, TagSpec

    paths = [scratch(f"folder {i}=x") for i in range(3)]
    for i, path in enumerate(paths):
        spark.createDataFrame([(f"1970/01/01 00:0{i}:00", str(i), "7"), ("late", "1", "1"), ("1970/01/01 00:09:00", "x", None)], "time string, a string, b string").write.option("header", True).csv(path)
    option = lambda p: {"path": p, "tz": "UTC", "columns": ["time", "a", "b"]}
    tags = [(TagSpec(1, "a", "p"),), (TagSpec(2, "b", "q"), TagSpec(3, "a", "r")), (TagSpec(4, "b", "s"),)]
    sources = [SourceSpec("CSV", option(p), t, name=f"s{i}") for i, (p, t) in enumerate(zip(paths, tags))]
    long, layout = read_sources(spark, sources, ImportRule("d"))
    assert plan_of(long).count("FileScan") == 1
    assert layout == {"p": ("s0", "_v0"), "q": ("s1", "_v0"), "r": ("s1", "_v1"), "s": ("s2", "_v0")}
    apart = [read_sources(spark, [s], ImportRule("d"))[0] for s in sources]
    cols = ["_source", "timestamp", "_v0", "_v1", "_bad", "_bad_text", "_bad_time"]
    rows = [tuple(r[x] if x in f.columns else None for x in cols) for f in apart for r in f.collect()]
    assert sorted((tuple(r[x] for x in cols) for r in long.collect()), key=str) == sorted(rows, key=str)


def test_csv_types_are_found_in_one_scan(spark, scratch):
    from chronoweave.sources.csv import read_csv_null_to_zero

    path = scratch("types")
    rows = [("2020/01/02 03:04:05", "1", "1.5", "7000000000", "null", None), (None, "", "2", "-1", "x", None)]
    spark.createDataFrame(rows, "time string, i string, d string, l string, s string, n string").write.option("header", True).csv(path)
    df = read_csv_null_to_zero(spark, path, tz="UTC")
    assert [t for _, t in df.dtypes] == ["bigint", "int", "double", "bigint", "string", "string"]
    assert sorted((tuple(r) for r in df.collect()), key=str) == sorted([(1577934245, 1, 1.5, 7000000000, "0", "0"), (None, 0, 2.0, -1, "x", "0")], key=str)
    assert "FileScan csv" not in plan_of(df)
