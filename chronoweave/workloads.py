"""Registered queries on the driver's tables, one per operator of the coverage list, each with
a DuckDB twin in ``ORACLE_SQL`` that computes the same rows from the same Parquet tables.

Conventions shared with the SQL twins:
  * event time in epoch seconds: ``epoch_us(ts) // 1000000`` (DuckDB), ``epoch_seconds`` here;
  * a "regular source" is one event type's values averaged per fixed bucket (bucket start);
  * averages are rounded to 6 digits, money sums to 2 (float sums are not bit-stable across
    shuffles).
"""

from __future__ import annotations

from typing import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chronoweave.functions.numeric import to_double
from chronoweave.functions.text import last_component
from chronoweave.functions.time import epoch_seconds, epoch_to_text
from chronoweave.operators.align import align_by_joins, time_grid, time_grid_from_bounds, union_keys
from chronoweave.operators.catalog import (
    catalog_from_labels, explode_entries, latest, schema_from_names, schema_pairs,
)
from chronoweave.operators.filters import modulo_sample, raw_time_range_filter
from chronoweave.operators.gaps import infer_interval, next_gap
from chronoweave.operators.metadata import multi_table_select, resolve_source
from chronoweave.operators.pack import pack, pack_rdbms, unpack
from chronoweave.operators.quality import (
    DROP, bad_field_names, column_profile, flag_type_errors, rejects_report, type_error_counts, validate, validation_counts,
)
from chronoweave.operators.resample import downsample, resample, resample_plan, upsample
from chronoweave.plans.dataset_import import build_dataset, build_from_long, import_dataset
from chronoweave.plans.rdbms_import import rdbms_import
from chronoweave.session import scratch_path
from chronoweave.sources.csv import read_csv_null_to_zero, read_csv_text, read_tag_csv, write_csv, write_tag_csv
from chronoweave.sources.store import DatasetStore
from chronoweave.specs import ImportRule, SourceSpec, TagSpec

Query = Callable[[SparkSession, str], DataFrame]

# Fixed parameters of the registered queries (the SQL twins below use the same numbers).
JAN_START = 1704067200            # 2024-01-01 00:00:00 UTC
JAN_FINISH = JAN_START + 30 * 86400 - 1
RANGE_START, RANGE_FINISH = 1704153600, 1704499199   # 2024-01-02 .. 2024-01-05 23:59:59
DAY = 86400
WEEK = 7 * DAY
ORDERS_START = 788918400          # 1995-01-01
ORDERS_FINISH = 1001894400        # 2001-10-01
YEARS_START, YEARS_FINISH = 820454400, 946684799     # 1996-01-01 .. 1999-12-31 23:59:59
SOURCE_BUCKETS = {"view": 3600, "click": 900, "purchase": 5400, "signup": 1800, "error": 7200}
OTHER_BUCKET = 3600               # of event types that are not listed
CSV_BUCKETS = {"view": 1200, "click": 3600, "purchase": 5400, "signup": 2400, "error": 7200}


def _t(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{name}.parquet")


def _events(spark: SparkSession, d: str) -> DataFrame:
    ev = _t(spark, d, "events")
    return ev.select("event_id", epoch_seconds(F.col("ts")).alias("timestamp"), "event_type", "value", "props")


def _regular_sources(spark: SparkSession, d: str, buckets: dict[str, int], start_s: int | None = None,
                     finish_s: int | None = None) -> DataFrame:
    """Values of every event type averaged per that type's bucket (``OTHER_BUCKET`` where it is not
    listed): ``(event_type, timestamp, value)``.  One scan and one aggregation for all types."""
    raw = raw_time_range_filter(_t(spark, d, "events"), "ts", start_s, finish_s)
    ev = raw.select(epoch_seconds(F.col("ts")).alias("timestamp"), "event_type", "value")
    width = F.lit(OTHER_BUCKET).cast("bigint")
    for k, v in buckets.items():
        width = F.when(F.col("event_type") == k, F.lit(v).cast("bigint")).otherwise(width)
    ev = ev.withColumn("_w", width)
    return downsample(ev.select("event_type", "timestamp", "value", "_w"), F.col("_w"), by=["event_type"],
                      values=["value"], label="bucket")


def _daily(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    orders = _t(spark, d, "orders").groupBy(epoch_seconds(F.col("o_orderdate")).alias("timestamp")).agg(
        F.sum("o_totalprice").alias("order_total"))
    ship = _t(spark, d, "lineitem").groupBy(epoch_seconds(F.col("l_shipdate")).alias("timestamp")).agg(
        F.sum("l_quantity").alias("ship_qty"))
    return orders, ship


def _orders_daily(spark: SparkSession, d: str) -> DataFrame:
    return _t(spark, d, "orders").groupBy(epoch_seconds(F.col("o_orderdate")).alias("timestamp")).agg(
        F.sum("o_totalprice").alias("order_total"), F.count(F.lit(1)).cast("double").alias("order_count"))


def _r(df: DataFrame, cols: list[str], digits: int = 6) -> DataFrame:
    """Round for comparison: snap float noise at 9 digits first, so a value whose exact result
    is a rounding half lands on the same side whichever order the engine summed in."""
    return df.select(*[F.round(F.round(F.col(x), 9), digits).alias(x) if x in cols else F.col(x)
                       for x in df.columns])


def _store(spark: SparkSession, name: str) -> DatasetStore:
    return DatasetStore(spark, scratch_path(spark, name))


def _cell_frame(spark: SparkSession, d: str) -> DataFrame:
    ev = _events(spark, d)
    cell = F.when(F.col("event_type") == "error", F.col("event_type")).otherwise(
        F.regexp_extract("props", "([0-9]+)", 1))
    return ev.select("event_id", "timestamp", "event_type", "value", cell.alias("cell"))


# ------------------------------------------------------------------------------------------
# scans, filters, gaps
# ------------------------------------------------------------------------------------------
def q_time_range_filter(spark: SparkSession, d: str) -> DataFrame:
    """Events inside an inclusive range given in epoch ms, pushed into the scan."""
    rule = ImportRule("range", start_ms=RANGE_START * 1000, finish_ms=RANGE_FINISH * 1000 + 999)
    ev = raw_time_range_filter(_t(spark, d, "events"), "ts", rule.start_s, rule.finish_s)
    return ev.select("event_id", epoch_seconds(F.col("ts")).alias("timestamp"), "event_type", "value")


def q_modulo_sample(spark: SparkSession, d: str) -> DataFrame:
    """Events whose epoch second is a multiple of 30."""
    return modulo_sample(_events(spark, d), 30).select("event_id", "timestamp", "event_type", "value")


def q_next_gap(spark: SparkSession, d: str) -> DataFrame:
    """Gap to the next event of the same type (ties broken by event id)."""
    g = next_gap(_events(spark, d).select("event_id", "event_type", "timestamp"), by=["event_type"],
                 tiebreak="event_id", out="gap")
    return g.select("event_type", "timestamp", "gap")


def q_next_gap_chunked(spark: SparkSession, d: str) -> DataFrame:
    """Gap to the next event over all events as one series, hour chunks stitched."""
    g = next_gap(_events(spark, d).select("event_id", "timestamp"), tiebreak="event_id", out="gap", chunk=3600)
    return g.select("timestamp", "gap")


def q_next_gap_users(spark: SparkSession, d: str) -> DataFrame:
    """E1 for a nullable series without a tiebreak: events by user (users divisible by 7 as
    NULL), times cut to hours so that many tie."""
    ev = _t(spark, d, "events")
    t = epoch_seconds(F.col("ts"))
    rows = ev.select(F.when(F.col("user_id") % 7 != 0, F.col("user_id")).alias("user_id"), (t - F.pmod(t, F.lit(3600))).alias("timestamp"))
    return next_gap(rows, by=["user_id"], out="gap")


def q_infer_interval(spark: SparkSession, d: str) -> DataFrame:
    """AG3: each event type's own interval (smallest positive gap)."""
    return infer_interval(_events(spark, d).select("event_type", "timestamp"), by=["event_type"])


# ------------------------------------------------------------------------------------------
# resampling
# ------------------------------------------------------------------------------------------
def q_upsample_ffill(spark: SparkSession, d: str) -> DataFrame:
    """G1: hourly averages of every event type forward-filled at 1800 s."""
    ev = _events(spark, d).select("event_type", "timestamp", "value")
    src = downsample(ev, 3600, by=["event_type"], values=["value"], label="bucket")
    return _r(upsample(src, 1800, by=["event_type"], values=["value"]), ["value"])


def q_upsample_events(spark: SparkSession, d: str) -> DataFrame:
    """G1 on raw rows: all events by type, forward-filled every minute."""
    return upsample(_events(spark, d).select("event_type", "timestamp", "value"), 60, by=["event_type"], values=["value"])


def q_downsample_avg(spark: SparkSession, d: str) -> DataFrame:
    """AG1: hourly averages per event type, labelled with the bucket's first second."""
    ev = _events(spark, d).select("event_type", "timestamp", "value")
    return _r(downsample(ev, 3600, by=["event_type"], values=["value"]), ["value"])


def _resample_all(bucket: int) -> Query:
    """Every event type averaged per ``bucket`` seconds, resampled to an hour."""
    def q(spark: SparkSession, d: str) -> DataFrame:
        ev = _events(spark, d).select("event_type", "timestamp", "value")
        src = downsample(ev, bucket, by=["event_type"], values=["value"], label="bucket")
        # bucket averages: one row per type and timestamp
        return _r(resample(src, 3600, by=["event_type"], values=["value"], ties="avg"), ["value"])
    return q


def q_resample_plan(spark: SparkSession, d: str) -> DataFrame:
    """Per-series old interval, step and branch for the five regular sources."""
    src = _regular_sources(spark, d, SOURCE_BUCKETS)
    return resample_plan(src, 3600, by=["event_type"]).withColumnRenamed("event_type", "series")


def q_resample_events(spark: SparkSession, d: str) -> DataFrame:
    """P1 on raw rows: all events of all types, filled at each type's own interval and averaged
    hourly; events that share a second all count."""
    ev = _events(spark, d).select("event_type", "timestamp", "value")
    return _r(resample(ev, 3600, by=["event_type"], values=["value"]), ["value"])


def q_resample_users(spark: SparkSession, d: str) -> DataFrame:
    """P1 on many series, one of them NULL: all events by user (users divisible by 7 as NULL), times
    cut to hours, averaged daily."""
    ev = _t(spark, d, "events")
    user = F.when(F.col("user_id") % 7 != 0, F.col("user_id"))
    hour = epoch_seconds(F.col("ts"))
    rows = ev.select(user.alias("user_id"), (hour - F.pmod(hour, F.lit(3600))).alias("timestamp"), "value")
    return _r(resample(rows, DAY, by=["user_id"], values=["value"]), ["value"])


def q_resample_equal_ties(spark: SparkSession, d: str) -> DataFrame:
    """P1, equal branch, with tied rows: all events by type, times cut to hours, resampled hourly."""
    ev = _events(spark, d).select("event_type", (F.col("timestamp") - F.pmod("timestamp", F.lit(3600))).alias("timestamp"), "value")
    return _r(resample(ev, 3600, by=["event_type"], values=["value"]), ["value"])


# ------------------------------------------------------------------------------------------
# timelines and alignment
# ------------------------------------------------------------------------------------------
def q_time_grid(spark: SparkSession, d: str) -> DataFrame:
    """Weekly key timeline between the first and last order date."""
    o = _t(spark, d, "orders").select(epoch_seconds(F.col("o_orderdate")).alias("t"))
    bounds = o.agg(F.min("t").alias("start"), F.max("t").alias("finish"))
    return time_grid_from_bounds(bounds, WEEK)


def q_union_keys(spark: SparkSession, d: str) -> DataFrame:
    """U1/AG2: distinct days of orders and of shipments."""
    o = _t(spark, d, "orders").select(epoch_seconds(F.col("o_orderdate")).alias("timestamp"))
    li = _t(spark, d, "lineitem").select(epoch_seconds(F.col("l_shipdate")).alias("timestamp"))
    return union_keys([o, li])


def q_align_union_keys(spark: SparkSession, d: str) -> DataFrame:
    """C1 without resampling: daily order totals and shipped quantities on the union of their days."""
    orders, ship = _daily(spark, d)
    rule = ImportRule("daily", interval_s=0, on_error=DROP)
    ds = build_dataset(spark, [("orders", orders), ("lineitem", ship)], ["order_total", "ship_qty"], rule)
    return _r(ds, ["order_total", "ship_qty"], 2)


def q_full_outer_offgrid(spark: SparkSession, d: str) -> DataFrame:
    """C1 literal: key timeline full-joined with each source; off-timeline rows keep a NULL key."""
    orders, ship = _daily(spark, d)
    keys = time_grid(spark, ORDERS_START, ORDERS_FINISH, WEEK)
    out = align_by_joins(keys, [orders, ship], ["order_total", "ship_qty"])
    return _r(out, ["order_total", "ship_qty"], 2)


def _all_types(spark: SparkSession, d: str, seconds: int) -> list[tuple[str, DataFrame]]:
    """The five event types as sources, times cut to ``seconds``: rows of a source share timestamps."""
    ev = _events(spark, d)
    cut = (F.col("timestamp") - F.pmod("timestamp", F.lit(seconds))).alias("timestamp")
    return [(k, ev.where(F.col("event_type") == k).select(cut, F.col("value").alias(k))) for k in SOURCE_BUCKETS]


def q_align_multiply(spark: SparkSession, d: str) -> DataFrame:
    """D24 literal: rows of the five sources that share a minute multiply."""
    rule = ImportRule("pairs", interval_s=0, on_error=DROP, dedupe="multiply")
    # values are rounded before they multiply: once a row of a source, not once a row of the result
    return build_dataset(spark, [(k, _r(f, [k])) for k, f in _all_types(spark, d, 60)], list(SOURCE_BUCKETS), rule)


def q_align_average(spark: SparkSession, d: str) -> DataFrame:
    """D24, averaged: rows of a source that share a timestamp become one."""
    rule = ImportRule("means", interval_s=0, on_error=DROP, dedupe="avg")
    return _r(build_dataset(spark, _all_types(spark, d, 3600), list(SOURCE_BUCKETS), rule), list(SOURCE_BUCKETS))


def q_align_unique(spark: SparkSession, d: str) -> DataFrame:
    """D24, refused: seconds at which a source has several rows are rejected (here dropped)."""
    rule = ImportRule("single", interval_s=0, on_error=DROP, dedupe="fail")
    return _r(build_dataset(spark, _all_types(spark, d, 1), list(SOURCE_BUCKETS), rule), list(SOURCE_BUCKETS))


def flagship(spark: SparkSession, d: str) -> DataFrame:
    """The five named event types as regular sources (hourly, 15-min, 90-min, 30-min, 2-hourly) resampled to hourly and
    aligned on the January timeline; off-timeline rows dropped, gaps filled with 0.0."""
    src = _regular_sources(spark, d, SOURCE_BUCKETS, JAN_START, JAN_FINISH)
    long = src.select(F.col("event_type").alias("_source"), "timestamp", F.col("value").alias("_v0"))
    rule = ImportRule("events_hourly", start_ms=JAN_START * 1000, finish_ms=JAN_FINISH * 1000,
                      interval_s=3600, on_error=DROP, dedupe="avg")
    ds = build_from_long(spark, long, {k: (k, "_v0") for k in SOURCE_BUCKETS}, list(SOURCE_BUCKETS), rule)
    return _r(ds, list(SOURCE_BUCKETS))


# ------------------------------------------------------------------------------------------
# quality
# ------------------------------------------------------------------------------------------
def q_validate_drop(spark: SparkSession, d: str) -> DataFrame:
    """B9 drop policy: rows whose text cell is not a number are removed, NULL becomes 0.0."""
    f = _cell_frame(spark, d)
    return validate(f, ["value", "cell"], DROP, keep=["event_id"])


def q_validate_fail_count(spark: SparkSession, d: str) -> DataFrame:
    """B9 fail policy, counted: valid and rejected rows per event type."""
    return validation_counts(_cell_frame(spark, d), ["value", "cell"], by=["event_type"])


def _text_file(spark: SparkSession, d: str) -> str:
    """Events as a CSV file with wrongly typed times (signup) and cells (error)."""
    f = _cell_frame(spark, d)
    time_text = F.when(F.col("event_type") == "signup", F.concat(F.lit("t"), F.col("timestamp").cast("string"))) \
        .otherwise(F.col("timestamp").cast("string"))
    path = scratch_path(spark, "typed_csv")
    write_csv(f.select(time_text.alias("time"), F.col("value").cast("string").alias("value"), "cell"), path, header=True)
    return path


def q_detect_type_errors(spark: SparkSession, d: str) -> DataFrame:
    """A3: wrongly typed cells per column of a CSV file."""
    return type_error_counts(read_csv_text(spark, _text_file(spark, d)))


def q_flag_type_errors(spark: SparkSession, d: str) -> DataFrame:
    """A3: the rows of a CSV file that hold a wrongly typed cell."""
    flagged = flag_type_errors(read_csv_text(spark, _text_file(spark, d)))
    return flagged.where("_type_error").select("time", "cell")


def q_rejects_report(spark: SparkSession, d: str) -> DataFrame:
    """Exception-log rows for rejected rows."""
    f = _cell_frame(spark, d).select("timestamp", "value", "cell")
    return rejects_report(f, ["value", "cell"], "events_import")


# ------------------------------------------------------------------------------------------
# packed storage, catalog, CSV
# ------------------------------------------------------------------------------------------
def _lineitem_wide(spark: SparkSession, d: str) -> DataFrame:
    li = _t(spark, d, "lineitem")
    return li.select(epoch_seconds(F.col("l_shipdate")).alias("timestamp"), "l_quantity", "l_extendedprice",
                     "l_discount")


def q_pack_dataset(spark: SparkSession, d: str) -> DataFrame:
    """Lineitem quantities, prices and discounts packed behind the ship date."""
    return pack(_lineitem_wide(spark, d))


def q_pack_no_timestamp(spark: SparkSession, d: str) -> DataFrame:
    """P4 without a timestamp column."""
    return pack(_t(spark, d, "lineitem").select("l_quantity", "l_extendedprice", "l_discount", "l_tax"))


def q_pack_dataset_rdbms(spark: SparkSession, d: str) -> DataFrame:
    """P5: database flavour, missing cells as empty text."""
    o = _t(spark, d, "orders").select(epoch_seconds(F.col("o_orderdate")).alias("t"), "o_totalprice",
                                      "o_custkey", "o_orderpriority")
    return pack_rdbms(o, "t", ["o_totalprice", "o_custkey", "o_orderpriority"])


def q_unpack_dataset(spark: SparkSession, d: str) -> DataFrame:
    """Pack then unpack by catalog entries."""
    wide = _lineitem_wide(spark, d)
    return unpack(pack(wide), schema_pairs(wide.schema))


def q_save_roundtrip(spark: SparkSession, d: str) -> DataFrame:
    """Save (packed data + catalog row) and load back."""
    store = _store(spark, "save_roundtrip")
    store.save(_orders_daily(spark, d), "orders_daily")
    return _r(store.load("orders_daily"), ["order_total"], 2)


def q_append_dataset(spark: SparkSession, d: str) -> DataFrame:
    """Save the first years, append the rest, load back."""
    store = _store(spark, "append_dataset")
    daily = _orders_daily(spark, d)
    mid = 915148800  # 1999-01-01
    store.save(daily.where(F.col("timestamp") < mid), "orders_daily")
    store.save(daily.where(F.col("timestamp") >= mid), "orders_daily", mode="append")
    return _r(store.load("orders_daily"), ["order_total"], 2)


def q_append_manifest(spark: SparkSession, d: str) -> DataFrame:
    """Three appends, one of them with its columns in another order and one that died before its
    commit, load back."""
    store = _store(spark, "append_manifest")
    daily = _orders_daily(spark, d)
    year = F.year(F.timestamp_seconds("timestamp"))
    store.save(daily.where(year < 1997), "orders_daily")
    store.save(daily.where(year == 1997), "orders_daily", mode="append")
    pack(daily).write.parquet(f"{store.root}/appended/orders_daily/v1/dead")  # never listed
    store.save(daily.where(year > 1997).select("timestamp", "order_count", "order_total"), "orders_daily", mode="append")
    return _r(store.load("orders_daily"), ["order_total"], 2)


def q_text_roundtrip(spark: SparkSession, d: str) -> DataFrame:
    """Names and comments with separators, quotes, line ends, escapes, outer spaces, empty and
    missing, saved and loaded."""
    k, name, note = F.col("c_custkey"), F.col("c_name"), F.col("c_mktsegment")
    text = (F.when(k % 7 == 0, F.lit(None)).when(k % 7 == 1, "").when(k % 7 == 2, F.concat(name, F.lit(", \""), note, F.lit("\"")))
             .when(k % 7 == 3, F.concat(name, F.lit("\n"), note, F.lit("\r\n"))).when(k % 7 == 4, F.concat(F.lit(" %2C%"), name, F.lit(" "))).otherwise(note))
    rows = _t(spark, d, "customer").select(k.cast("bigint").alias("c_custkey"), name, text.alias("note"), F.col("c_acctbal").cast("double").alias("c_acctbal"))
    store = _store(spark, "text_roundtrip")
    store.save(rows, "customers")
    return store.load("customers")


def q_sorted_rank(spark: SparkSession, d: str) -> DataFrame:
    """a dataset saved in time order, with each row's rank."""
    store = _store(spark, "sorted_rank")
    store.save(_orders_daily(spark, d), "orders_daily", by_time=True)
    return _r(store.ranked("orders_daily"), ["order_total"], 2)


def q_sorted_range(spark: SparkSession, d: str) -> DataFrame:
    """Of a dataset saved in time order, the files and rows of four years."""
    store = _store(spark, "sorted_range")
    store.save(_orders_daily(spark, d), "orders_daily", by_time=True)
    return _r(store.load("orders_daily", YEARS_START, YEARS_FINISH), ["order_total"], 2)


def q_csv_roundtrip(spark: SparkSession, d: str) -> DataFrame:
    """CSV sink without header and read back with the schema."""
    o = _t(spark, d, "orders").select("o_orderkey", "o_custkey", "o_totalprice",
                                      epoch_seconds(F.col("o_orderdate")).alias("timestamp"))
    path = scratch_path(spark, "csv_roundtrip")
    write_csv(o, path)
    return spark.read.schema(o.schema).csv(path)


def q_csv_tag_scan(spark: SparkSession, d: str) -> DataFrame:
    """A tag file with dotted names read by spec inside a range."""
    daily = _orders_daily(spark, d).select(
        "timestamp", F.col("order_total").alias("plant.order_total"), F.col("order_count").alias("plant.order_count"))
    path = scratch_path(spark, "tag_csv")
    write_tag_csv(daily, path)
    tags = [TagSpec(1, "plant.order_total", "order_total"), TagSpec(2, "plant.order_count", "order_count")]
    scanned = read_tag_csv(spark, path, tags, YEARS_START, YEARS_FINISH, tz="UTC")
    out = scanned.select("timestamp", to_double(F.col("order_total")).alias("order_total"),
                         to_double(F.col("order_count")).alias("order_count"))
    return _r(out, ["order_total"], 2)


def q_csv_null_to_zero(spark: SparkSession, d: str) -> DataFrame:
    """Inferred CSV with 'null' text and empty cells turned into zero."""
    o = _t(spark, d, "orders")
    text = o.select(
        F.date_format(F.col("o_orderdate"), "yyyy/MM/dd HH:mm:ss").alias("time"),
        F.when(F.col("o_orderstatus") == "P", F.lit("null")).otherwise(F.col("o_totalprice").cast("string")).alias("price"),
        F.when(F.col("o_orderstatus") == "O", F.lit(None)).otherwise(F.col("o_custkey")).alias("cust"),
        F.col("o_orderkey").alias("okey"))
    path = scratch_path(spark, "null_csv")
    text.write.option("header", True).csv(path)
    got = read_csv_null_to_zero(spark, path, tz="UTC")
    return got.select("timestamp", to_double(F.col("price")).alias("price"), F.col("cust").cast("bigint").alias("cust"),
                      F.col("okey").cast("bigint").alias("okey"))


def q_catalog_build(spark: SparkSession, d: str) -> DataFrame:
    """Catalog row of a saved dataset with one column per order priority found."""
    o = _t(spark, d, "orders").select(epoch_seconds(F.col("o_orderdate")).alias("timestamp"), "o_orderpriority", "o_totalprice")
    wide = o.groupBy("timestamp").pivot("o_orderpriority").agg(F.sum("o_totalprice"))
    store = _store(spark, "catalog_build")
    store.save(wide, "by_priority")
    cat = latest(store.catalog())
    return explode_entries(cat).join(cat.select("tablename", "tagNames"), "tablename") \
        .select("tablename", "colname", "datatype", F.col("orderby").cast("bigint").alias("orderby"), "tagNames")


def _region_labels(spark: SparkSession, d: str) -> DataFrame:
    n, r = _t(spark, d, "nation"), _t(spark, d, "region")
    tags = n.join(r, n.n_regionkey == r.r_regionkey).select(
        F.col("r_name").alias("dsabelid"), F.concat_ws(".", F.lit("erp"), "r_name", "n_name").alias("labelid"),
        F.col("n_nationkey").cast("bigint").alias("ord"), F.lit(0).alias("timestampif"))
    times = r.select(F.col("r_name").alias("dsabelid"), F.concat_ws(".", F.lit("erp"), "r_name", F.lit("ts")).alias("labelid"),
                     F.lit(-1).cast("bigint").alias("ord"), F.lit(1).alias("timestampif"))
    return tags.unionByName(times)


def q_catalog_from_labels(spark: SparkSession, d: str) -> DataFrame:
    """Catalogs of all region datasets from nation labels, exploded."""
    cat = catalog_from_labels(_region_labels(spark, d), dataset="dsabelid", label="labelid", order="ord",
                              is_time="timestampif")
    return explode_entries(cat).join(cat.select("tablename", "tagNames"), "tablename") \
        .select("tablename", "colname", "datatype", F.col("orderby").cast("bigint").alias("orderby"), "tagNames")


def q_catalog_from_labels_customers(spark: SparkSession, d: str) -> DataFrame:
    """One dataset per customer (datasets grow with the table), three labels each."""
    cust, nation = _t(spark, d, "customer"), _t(spark, d, "nation")
    base = cust.join(nation, cust.c_nationkey == nation.n_nationkey).select(
        F.concat(F.lit("cust_"), F.col("c_custkey").cast("string")).alias("dsabelid"), "n_name", "c_mktsegment")
    labels = base.select("dsabelid", F.explode(F.array(
        F.struct(F.concat_ws(".", F.lit("erp"), "n_name", "c_mktsegment").alias("labelid"), F.lit(2).alias("ord"),
                 F.lit(0).alias("timestampif")),
        F.struct(F.concat_ws(".", F.lit("erp"), "n_name", F.lit("balance")).alias("labelid"), F.lit(1).alias("ord"),
                 F.lit(0).alias("timestampif")),
        F.struct(F.concat_ws(".", F.lit("erp"), "n_name", F.lit("ts")).alias("labelid"), F.lit(9).alias("ord"),
                 F.lit(1).alias("timestampif")))).alias("l")).select("dsabelid", "l.*")
    cat = catalog_from_labels(labels, dataset="dsabelid", label="labelid", order="ord", is_time="timestampif")
    return explode_entries(cat).join(cat.select("tablename", "tagNames"), "tablename") \
        .select("tablename", "colname", "datatype", F.col("orderby").cast("bigint").alias("orderby"), "tagNames")


def q_catalog_lookup(spark: SparkSession, d: str) -> DataFrame:
    """Latest of many catalog versions: one dataset per nation, one version per customer
    (by key), whose only column is named after the customer."""
    cust, nation = _t(spark, d, "customer"), _t(spark, d, "nation")
    rows = cust.join(nation, cust.c_nationkey == nation.n_nationkey).select(
        F.col("n_name").alias("tablename"), F.col("c_custkey").cast("bigint").alias("version"), "c_name")
    entry = F.to_json(F.array(F.struct(F.col("c_name").alias("colname"), F.lit("DoubleType").alias("datatype"), F.lit(0).alias("orderby"))))
    store = _store(spark, "catalog_lookup")
    store.add_catalog_rows(rows.select("tablename", entry.alias("columns"), F.col("c_name").alias("tagNames"), "version"))
    return explode_entries(latest(store.catalog())).select("tablename", "version", "colname", "datatype", F.col("orderby").cast("bigint").alias("orderby"))


def q_catalog_compacted(spark: SparkSession, d: str) -> DataFrame:
    """The look-up after every nation's catalog was compacted between two batches of versions."""
    cust, nation = _t(spark, d, "customer"), _t(spark, d, "nation")
    entry = F.to_json(F.array(F.struct(F.col("c_name").alias("colname"), F.lit("DoubleType").alias("datatype"), F.lit(0).alias("orderby"))))
    rows = cust.join(nation, cust.c_nationkey == nation.n_nationkey).select(
        F.col("n_name").alias("tablename"), entry.alias("columns"), F.col("c_name").alias("tagNames"), F.col("c_custkey").cast("bigint").alias("version"))
    store = _store(spark, "catalog_compacted")
    store.add_catalog_rows(rows.where("version % 2 = 0"))
    store.add_catalog_rows(rows.where("version % 2 = 1 and tablename >= 'M'"))
    for r in nation.where("n_regionkey = 1").select("n_name").collect():  # one region's datasets
        store.compact_metadata(r["n_name"])
    store.add_catalog_rows(rows.where("version % 2 = 1 and tablename < 'M'"))
    return explode_entries(latest(store.catalog())).select("tablename", "version", "colname", "datatype", F.col("orderby").cast("bigint").alias("orderby"))


def q_column_profile(spark: SparkSession, d: str) -> DataFrame:
    """A2/A3: of each column of a CSV file its narrowest type, how many cells are no number, the least of
    them and how many are missing."""
    return column_profile(read_csv_text(spark, _text_file(spark, d)))


def q_cast_by_catalog(spark: SparkSession, d: str) -> DataFrame:
    """Text columns cast by catalog type names."""
    p = _t(spark, d, "part")
    names = [("p_partkey", "LongType"), ("p_name", "StringType"), ("p_size", "IntegerType"),
             ("p_retailprice", "DoubleType")]
    text = p.select(*[F.col(n).cast("string").alias(n) for n, _ in names])
    schema = schema_from_names(names)
    return text.select(*[F.col(f.name).try_cast(f.dataType).alias(f.name) for f in schema.fields])


def q_bad_field_names(spark: SparkSession, d: str) -> DataFrame:
    """Label names that are not plain identifiers."""
    p = _t(spark, d, "part")
    labels = p.select(F.col("p_brand").alias("tablename"),
                      F.concat_ws(".", F.lit("erp"), "p_type", "p_name").alias("labelid"))
    named = labels.withColumn("colname", last_component(F.col("labelid")))
    return bad_field_names(named).select("tablename", "colname")


# ------------------------------------------------------------------------------------------
# metadata and database-style import
# ------------------------------------------------------------------------------------------
def q_resolve_source(spark: SparkSession, d: str) -> DataFrame:
    """Dataset -> source -> region look-ups."""
    cust, nation, region = _t(spark, d, "customer"), _t(spark, d, "nation"), _t(spark, d, "region")
    datasets = cust.select(F.col("c_custkey").alias("dsabelid"), F.col("c_nationkey").alias("datasourcesid"))
    sources = nation.select(F.col("n_nationkey").alias("id"), F.col("n_name").alias("dsname"),
                            F.col("n_regionkey").alias("dsregion"))
    out = resolve_source(datasets, sources)
    out = out.join(region, out.dsregion == region.r_regionkey).select(
        F.col("dsabelid").cast("bigint").alias("dsabelid"), F.col("datasourcesid").cast("bigint").alias("datasourcesid"),
        "dsname", "r_name")
    return out


def q_multi_table_select(spark: SparkSession, d: str) -> DataFrame:
    """Labelled columns of orders, customer and nation joined on keys, inside a range."""
    orders = raw_time_range_filter(_t(spark, d, "orders"), "o_orderdate", YEARS_START, YEARS_FINISH)
    tables = [("orders", orders), ("customer", _t(spark, d, "customer")), ("nation", _t(spark, d, "nation"))]
    cols = [("orders", "o_orderkey"), ("orders", "o_totalprice"), ("customer", "c_name"), ("nation", "n_name")]
    keys = [("orders", "o_custkey", "customer", "c_custkey"), ("customer", "c_nationkey", "nation", "n_nationkey")]
    return multi_table_select(tables, cols, keys)


def q_composite_keys(spark: SparkSession, d: str) -> DataFrame:
    """C2 with a two-column key and equal column names: lineitem joined to itself by order and
    line number."""
    li = _t(spark, d, "lineitem")
    keys = [("a", "l_orderkey", "b", "l_orderkey"), ("a", "l_linenumber", "b", "l_linenumber")]
    cols = [("a", "l_orderkey"), ("a", "l_linenumber"), ("a", "l_quantity"), ("b", "l_quantity")]
    out = multi_table_select([("a", li), ("b", li)], cols, keys)
    return out.select("l_orderkey", "l_linenumber", F.col("`a.l_quantity`").alias("qa"), F.col("`b.l_quantity`").alias("qb"))


def q_rdbms_import(spark: SparkSession, d: str) -> DataFrame:
    """The database-style import on the orders table, stored and loaded back."""
    datasets = spark.createDataFrame([("ds1", "src1")], "dsabelid string, datasourcesid string")
    sources = spark.createDataFrame([("src1", "warehouse", "PARQUET", "", "", d, None, None)],
                                    "id string, dsname string, dstype string, dsip string, dsport string, "
                                    "dsexample string, dsloginid string, dspwd string")
    labels = spark.createDataFrame([
        ("ds1", "orders", "erp.orders.o_orderdate", 1),
        ("ds1", "orders", "erp.orders.o_totalprice", 0),
        ("ds1", "orders", "erp.orders.o_custkey", 0),
    ], "dsabelid string, tablename string, labelid string, timestampif int")
    rule = ImportRule("ds1", start_ms=YEARS_START * 1000, finish_ms=YEARS_FINISH * 1000)
    store = _store(spark, "rdbms_import")
    rdbms_import(spark, "ds1", rule, datasets, sources, labels, store)
    loaded = store.load("ds1")
    return loaded.select("timestamp", *[F.col(f"`{x}`").alias(x.split(".")[-1]) for x in loaded.columns[1:]])


def q_reject_log(spark: SparkSession, d: str) -> DataFrame:
    """The exception log of an import of click events and all others (``view``) under the drop policy: unparsable times (every fifth
    hour's count), unparsable cells (every seventh) and rows off the key timeline (a source that
    runs a quarter of an hour late)."""
    root = scratch_path(spark, "reject_log")
    ev = _events(spark, d)
    hour = (F.col("timestamp") - F.pmod("timestamp", F.lit(3600))).alias("timestamp")
    kind = F.when(F.col("event_type") == "click", "click").otherwise("view").alias("event_type")
    hourly = ev.groupBy(kind, hour).agg(F.count("*").alias("n"))
    click = hourly.where("event_type = 'click'").select(
        F.when(F.col("n") % 5 == 0, F.concat(F.lit("t"), F.col("timestamp").cast("string"))).otherwise(epoch_to_text(F.col("timestamp"))).alias("time"),
        F.when(F.col("n") % 7 == 0, F.concat(F.lit("x"), F.col("n").cast("string"))).otherwise(F.col("n").cast("string")).alias("n"))
    view = hourly.where("event_type = 'view'").select(epoch_to_text(F.col("timestamp") + 900).alias("time"), "n")
    write_csv(click, f"{root}/click", header=True)
    write_csv(view, f"{root}/view", header=True)
    option = lambda kind: {"path": f"{root}/{kind}", "tz": "UTC", "columns": ["time", "n"]}
    sources = [SourceSpec("CSV", option(k), (TagSpec(i + 1, "n", k),), name=k) for i, k in enumerate(("click", "view"))]
    rule = ImportRule("hourly", start_ms=JAN_START * 1000, finish_ms=(JAN_FINISH + 86401) * 1000, interval_s=3600, on_error=DROP, dedupe="avg")
    store = DatasetStore(spark, f"{root}/store")
    import_dataset(spark, sources, rule, store, log_rejects=True)
    return store.errors()


def q_csv_import(spark: SparkSession, d: str) -> DataFrame:
    """The whole CSV import: a tag file per event type written from events, the five named ones imported
    by spec."""
    root = scratch_path(spark, "csv_import")
    width = F.lit(OTHER_BUCKET).cast("bigint")
    for k, v in CSV_BUCKETS.items():
        width = F.when(F.col("event_type") == k, F.lit(v).cast("bigint")).otherwise(width)
    agg = (_events(spark, d).withColumn("_w", width)
             .groupBy("event_type", (F.col("timestamp") - F.pmod("timestamp", "_w")).alias("timestamp"))
             .agg(F.avg("value").alias("site.avg"), F.count(F.lit(1)).alias("site.n")))
    # one job writes every source's tag files: <root>/files/event_type=<kind>/
    write_tag_csv(agg, f"{root}/files", partition_by=["event_type"])
    folder = lambda kind: {"path": f"{root}/files/event_type={kind}", "tz": "UTC",
                           "columns": ["time", "site.avg", "site.n"]}
    sources = [
        SourceSpec("CSV", folder("view"), (TagSpec(3, "site.avg", "view_avg"), TagSpec(1, "site.n", "view_n")),
                   name="view"),
        SourceSpec("CSV", folder("click"), (TagSpec(2, "site.avg", "click"),), name="click"),
        SourceSpec("CSV", folder("purchase"), (TagSpec(4, "site.avg", "purchase"),), name="purchase"),
        SourceSpec("CSV", folder("signup"), (TagSpec(5, "site.avg", "signup"),), name="signup"),
        SourceSpec("CSV", folder("error"), (TagSpec(6, "site.avg", "error"),), name="error"),
    ]
    rule = ImportRule.from_json_fields({"newDatasetID": "events_2400", "startTime": str(JAN_START * 1000),
                                        "finishTime": str(JAN_FINISH * 1000), "timeInterval": "2400",
                                        "typesOfException": "0", "dedupe": "avg"})
    store = DatasetStore(spark, f"{root}/store")
    import_dataset(spark, sources, rule, store)
    return _r(store.load("events_2400"), ["view_n", "click", "view_avg", "purchase", "signup", "error"])


QUERIES: dict[str, Query] = {
    "time_range_filter": q_time_range_filter,
    "modulo_sample": q_modulo_sample,
    "next_gap": q_next_gap,
    "next_gap_chunked": q_next_gap_chunked,
    "next_gap_users": q_next_gap_users,
    "infer_interval": q_infer_interval,
    "upsample_ffill": q_upsample_ffill,
    "upsample_events": q_upsample_events,
    "downsample_avg": q_downsample_avg,
    "resample_equal": _resample_all(3600),
    "resample_slower": _resample_all(900),
    "resample_faster": _resample_all(5400),
    "resample_plan": q_resample_plan,
    "resample_events": q_resample_events,
    "resample_users": q_resample_users,
    "resample_equal_ties": q_resample_equal_ties,
    "time_grid": q_time_grid,
    "union_keys": q_union_keys,
    "align_union_keys": q_align_union_keys,
    "full_outer_offgrid": q_full_outer_offgrid,
    "align_multi_source": flagship,
    "align_multiply": q_align_multiply,
    "align_average": q_align_average,
    "align_unique": q_align_unique,
    "validate_drop": q_validate_drop,
    "validate_fail_count": q_validate_fail_count,
    "detect_type_errors": q_detect_type_errors,
    "flag_type_errors": q_flag_type_errors,
    "rejects_report": q_rejects_report,
    "reject_log": q_reject_log,
    "pack_dataset": q_pack_dataset,
    "pack_no_timestamp": q_pack_no_timestamp,
    "pack_dataset_rdbms": q_pack_dataset_rdbms,
    "unpack_dataset": q_unpack_dataset,
    "save_roundtrip": q_save_roundtrip,
    "append_dataset": q_append_dataset,
    "append_manifest": q_append_manifest,
    "text_roundtrip": q_text_roundtrip,
    "sorted_rank": q_sorted_rank,
    "sorted_range": q_sorted_range,
    "csv_roundtrip": q_csv_roundtrip,
    "csv_tag_scan": q_csv_tag_scan,
    "csv_null_to_zero": q_csv_null_to_zero,
    "catalog_build": q_catalog_build,
    "catalog_from_labels": q_catalog_from_labels,
    "catalog_from_labels_customers": q_catalog_from_labels_customers,
    "catalog_lookup": q_catalog_lookup,
    "catalog_compacted": q_catalog_compacted,
    "column_profile": q_column_profile,
    "cast_by_catalog": q_cast_by_catalog,
    "bad_field_names": q_bad_field_names,
    "resolve_source": q_resolve_source,
    "multi_table_select": q_multi_table_select,
    "composite_keys": q_composite_keys,
    "rdbms_import": q_rdbms_import,
    "csv_import": q_csv_import,
}
