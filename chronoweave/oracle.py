"""DuckDB twins of the registered queries (``workloads.QUERIES``), written as plain SQL over
the Parquet tables.  They follow the literal rules: ``lead`` over whole series, forward-fill
by ``unnest(range(...))`` one row per step, then plain ``avg``."""

from __future__ import annotations

from chronoweave.workloads import (
    CSV_BUCKETS, JAN_FINISH, JAN_START, ORDERS_FINISH, ORDERS_START, OTHER_BUCKET, RANGE_FINISH, RANGE_START,
    SOURCE_BUCKETS, WEEK, YEARS_FINISH, YEARS_START,
)

E = "epoch_us(ts) // 1000000"


def _bucket_case(buckets: dict[str, int], col: str = "series") -> str:
    whens = " ".join(f"WHEN '{k}' THEN {v}" for k, v in buckets.items())
    return f"CASE {col} {whens} ELSE {OTHER_BUCKET} END"


def _resample_ctes(values: list[str], new: int, tie: str = "") -> str:
    """CTEs ``g, p, pl, u, r, res`` over a CTE ``src(series, ts, values...)``; of rows that share
    a timestamp the last by ``tie`` fills the gap."""
    order = f"ts, {tie} NULLS FIRST" if tie else "ts"
    vals = ", ".join(values)
    avgs = ", ".join(f"avg({v}) AS {v}" for v in values)
    return f"""
g AS (SELECT series, ts, {vals}, lead(ts, 1, ts) OVER (PARTITION BY series ORDER BY {order}) - ts AS gap FROM src),
p AS (SELECT series, min(gap) FILTER (WHERE gap > 0) AS old FROM g GROUP BY series),
pl AS (SELECT series,
         CASE WHEN old IS NULL THEN NULL WHEN old = {new} THEN {new} WHEN old < {new} THEN old ELSE gcd(old, {new}) END AS step,
         CASE WHEN old IS NULL THEN 'single' WHEN old = {new} THEN 'equal' ELSE 'avg' END AS branch
       FROM p),
u AS (SELECT g.series, ts, {vals}, step, branch,
         unnest(range(0, CASE WHEN step IS NULL THEN 1 ELSE greatest(gap // step, 1) END)) AS i
      FROM g JOIN pl ON g.series IS NOT DISTINCT FROM pl.series),
r AS (SELECT series, ts + i * coalesce(step, 0) AS ts, {vals}, branch FROM u),
res AS (SELECT series, ts, {vals} FROM r WHERE branch = 'equal'
        UNION ALL
        SELECT series, min(ts) AS ts, {avgs} FROM r WHERE branch <> 'equal' GROUP BY series, ts - ts % {new})"""


def _grid(start: int, finish: int, iv: int) -> str:
    n = max((finish - start) // iv, 1)
    tail = f" UNION ALL SELECT CAST({finish} AS BIGINT)" if finish != start else ""
    return f"SELECT range AS ts FROM range({start}, {start + n * iv}, {iv}){tail}"


def _events_typed(buckets: dict[str, int], start: int | None = None, finish: int | None = None) -> str:
    names = ", ".join(f"'{k}'" for k in buckets)
    rng = f" AND {E} BETWEEN {start} AND {finish}" if start is not None else ""
    return f"SELECT event_type AS series, {E} AS t, value FROM events WHERE event_type IN ({names}){rng}"


def _regular_src(buckets: dict[str, int], start: int | None = None, finish: int | None = None) -> str:
    rng = f" WHERE {E} BETWEEN {start} AND {finish}" if start is not None else ""
    return (f"e AS (SELECT event_type AS series, {E} AS t, value FROM events{rng}),\n"
            f"src AS (SELECT series, t - t % {_bucket_case(buckets)} AS ts, avg(value) AS v FROM e GROUP BY 1, 2)")


def _resample_all(bucket: int) -> str:
    return f"""WITH e AS (SELECT event_type AS series, {E} AS t, value FROM events),
src AS (SELECT series, t - t % {bucket} AS ts, avg(value) AS v FROM e GROUP BY 1, 2),
{_resample_ctes(['v'], 3600)}
SELECT series AS event_type, ts AS timestamp, round(v, 6) AS value FROM res"""


def _flagship() -> str:
    b = SOURCE_BUCKETS
    joins = " ".join(f"LEFT JOIN res {k}_s ON {k}_s.series = '{k}' AND {k}_s.ts = grid.ts" for k in b)
    cols = ", ".join(f"round(coalesce({k}_s.v, 0.0), 6) AS {k}" for k in b)
    return f"""WITH {_regular_src(b, JAN_START, JAN_FINISH)},
{_resample_ctes(['v'], 3600)},
grid AS ({_grid(JAN_START, JAN_FINISH, 3600)})
SELECT grid.ts AS timestamp, {cols} FROM grid {joins}"""


def _csv_import() -> str:
    b, new = CSV_BUCKETS, 2400
    single = [k for k in b if k != "view"]
    own = ", ".join(f"CASE WHEN series = '{k}' THEN a END AS {k}" for k in single)
    cols = ", ".join(f"round(coalesce({k}_s.{k}, 0.0), 6) AS {k}" for k in single)
    joins = "\n".join(f"LEFT JOIN res {k}_s ON {k}_s.series = '{k}' AND {k}_s.ts = grid.ts" for k in b)
    return f"""WITH e AS ({_events_typed(b)}),
agg AS (SELECT series, t - t % {_bucket_case(b)} AS ts, avg(value) AS a, CAST(count(*) AS DOUBLE) AS n FROM e GROUP BY 1, 2),
src AS (SELECT series, ts, CASE WHEN series = 'view' THEN a END AS view_avg, CASE WHEN series = 'view' THEN n END AS view_n, {own}
        FROM agg WHERE ts BETWEEN {JAN_START} AND {JAN_FINISH}),
{_resample_ctes(['view_avg', 'view_n', *single], new)},
grid AS ({_grid(JAN_START, JAN_FINISH, new)})
SELECT grid.ts AS timestamp, round(coalesce(view_s.view_n, 0.0), 6) AS view_n, round(coalesce(view_s.view_avg, 0.0), 6) AS view_avg, {cols}
FROM grid
{joins}"""


_CELL = (f"SELECT event_id, {E} AS t, event_type, value, "
         "CASE WHEN event_type = 'error' THEN event_type ELSE regexp_extract(props, '([0-9]+)', 1) END AS cell "
         "FROM events")
_BAD = "(t IS NULL OR (cell IS NOT NULL AND TRY_CAST(cell AS DOUBLE) IS NULL))"

_DAILY = f"""o AS (SELECT epoch_us(o_orderdate) // 1000000 AS t, sum(o_totalprice) AS v FROM orders GROUP BY 1),
l AS (SELECT epoch_us(l_shipdate) // 1000000 AS t, sum(l_quantity) AS v FROM lineitem GROUP BY 1)"""

def _all_types(seconds: int, select: str, of: str, where: str = "") -> str:
    """The five types as sources with times cut to ``seconds``, each as ``of`` on the union of their times."""
    own = ",\n".join(f"{k}_s AS ({of.format(rows=f'(SELECT t, v FROM x WHERE event_type = {chr(39)}{k}{chr(39)})')})" for k in SOURCE_BUCKETS)
    joins = " ".join(f"LEFT JOIN {k}_s ON {k}_s.t = k.t" for k in SOURCE_BUCKETS)
    cols = ", ".join(select.format(k=k) for k in SOURCE_BUCKETS)
    tail = " AND ".join(where.format(k=k) for k in SOURCE_BUCKETS) if where else "true"
    names = ", ".join(f"'{k}'" for k in SOURCE_BUCKETS)
    return f"""WITH x AS (SELECT event_type, ({E}) - ({E}) % {seconds} AS t, value AS v FROM events WHERE event_type IN ({names})),
        {own},
        k AS (SELECT DISTINCT t FROM x)
        SELECT k.t AS timestamp, {cols} FROM k {joins} WHERE {tail}"""


_ORDERS_DAILY = ("SELECT epoch_us(o_orderdate) // 1000000 AS timestamp, round(sum(o_totalprice), 2) AS order_total, "
                 "CAST(count(*) AS DOUBLE) AS order_count FROM orders GROUP BY 1")


def snap_rounds(sql: str) -> str:
    """Rewrite every ``round(x, d)`` as ``round(round(x, 9), d)`` (see ``workloads._r``)."""
    out, i = [], 0
    while True:
        j = sql.find("round(", i)
        if j < 0:
            out.append(sql[i:])
            return "".join(out)
        depth, k, comma = 0, j + len("round("), -1
        while True:
            ch = sql[k]
            if ch == "(":
                depth += 1
            elif ch == ")":
                if depth == 0:
                    break
                depth -= 1
            elif ch == "," and depth == 0:
                comma = k
            k += 1
        inner, digits = sql[j + 6:comma], sql[comma + 1:k].strip()
        out.append(sql[i:j] + f"round(round({snap_rounds(inner)}, 9), {digits})")
        i = k + 1


ORACLE_SQL: dict[str, str] = {
    "time_range_filter": f"""SELECT event_id, {E} AS timestamp, event_type, value FROM events
        WHERE {E} BETWEEN {RANGE_START} AND {RANGE_FINISH}""",
    "modulo_sample": f"SELECT event_id, {E} AS timestamp, event_type, value FROM events WHERE ({E}) % 30 = 0",
    "next_gap": f"""WITH e AS (SELECT event_type, {E} AS t FROM events)
        SELECT event_type, t AS timestamp, lead(t, 1, t) OVER (PARTITION BY event_type ORDER BY t) - t AS gap FROM e""",
    "next_gap_chunked": f"""WITH e AS (SELECT {E} AS t FROM events)
        SELECT t AS timestamp, lead(t, 1, t) OVER (ORDER BY t) - t AS gap FROM e""",
    "infer_interval": f"""WITH e AS (SELECT event_type, {E} AS t FROM events),
        g AS (SELECT event_type, lead(t, 1, t) OVER (PARTITION BY event_type ORDER BY t) - t AS gap FROM e)
        SELECT event_type, min(gap) FILTER (WHERE gap > 0) AS "interval" FROM g GROUP BY event_type""",
    "upsample_ffill": f"""WITH e AS (SELECT event_type AS series, {E} AS t, value FROM events),
        src AS (SELECT series, t - t % 3600 AS ts, avg(value) AS v FROM e GROUP BY 1, 2),
        g AS (SELECT series, ts, v, lead(ts, 1, ts) OVER (PARTITION BY series ORDER BY ts) - ts AS gap FROM src),
        u AS (SELECT series, ts, v, unnest(range(0, greatest(gap // 1800, 1))) AS i FROM g)
        SELECT series AS event_type, ts + i * 1800 AS timestamp, round(v, 6) AS value FROM u""",
    "downsample_avg": f"""WITH e AS (SELECT event_type, {E} AS t, value FROM events)
        SELECT event_type, min(t) AS timestamp, round(avg(value), 6) AS value FROM e GROUP BY event_type, t - t % 3600""",
    "resample_equal": _resample_all(3600),
    "resample_slower": _resample_all(900),
    "resample_faster": _resample_all(5400),
    "resample_plan": f"""WITH {_regular_src(SOURCE_BUCKETS)},
        g AS (SELECT series, ts, lead(ts, 1, ts) OVER (PARTITION BY series ORDER BY ts) - ts AS gap FROM src),
        p AS (SELECT series, min(gap) FILTER (WHERE gap > 0) AS old FROM g GROUP BY series)
        SELECT series, old AS old_interval, CAST(3600 AS BIGINT) AS new_interval,
          CASE WHEN old IS NULL THEN NULL WHEN old = 3600 THEN 3600 WHEN old < 3600 THEN old ELSE gcd(old, 3600) END AS step,
          CASE WHEN old IS NULL THEN 'single' WHEN old = 3600 THEN 'equal' WHEN old < 3600 THEN 'slower' ELSE 'faster' END AS branch
        FROM p""",
    "time_grid": f"""WITH b AS (SELECT min(epoch_us(o_orderdate) // 1000000) AS s, max(epoch_us(o_orderdate) // 1000000) AS f FROM orders),
        i AS (SELECT s, unnest(range(0, greatest((f - s) // {WEEK}, 1))) AS i FROM b)
        SELECT s + i * {WEEK} AS timestamp FROM i
        UNION ALL SELECT f AS timestamp FROM b WHERE f <> s""",
    "union_keys": """SELECT epoch_us(o_orderdate) // 1000000 AS timestamp FROM orders
        UNION SELECT epoch_us(l_shipdate) // 1000000 AS timestamp FROM lineitem""",
    "align_union_keys": f"""WITH {_DAILY},
        k AS (SELECT t FROM o UNION SELECT t FROM l)
        SELECT k.t AS timestamp, round(coalesce(o.v, 0.0), 2) AS order_total, round(coalesce(l.v, 0.0), 2) AS ship_qty
        FROM k LEFT JOIN o ON o.t = k.t LEFT JOIN l ON l.t = k.t""",
    "full_outer_offgrid": f"""WITH {_DAILY},
        k AS ({_grid(ORDERS_START, ORDERS_FINISH, WEEK)})
        SELECT k.ts AS timestamp, round(o.v, 2) AS order_total, round(l.v, 2) AS ship_qty
        FROM k FULL JOIN o ON k.ts = o.t FULL JOIN l ON k.ts = l.t""",
    "align_multi_source": _flagship(),
    "validate_drop": f"""WITH f AS ({_CELL})
        SELECT t AS timestamp, event_id, value, coalesce(TRY_CAST(cell AS DOUBLE), 0.0) AS cell FROM f WHERE NOT {_BAD}""",
    "validate_fail_count": f"""WITH f AS ({_CELL})
        SELECT event_type, CAST(sum(CASE WHEN {_BAD} THEN 0 ELSE 1 END) AS BIGINT) AS n_valid,
               CAST(sum(CASE WHEN {_BAD} THEN 1 ELSE 0 END) AS BIGINT) AS n_rejected
        FROM f GROUP BY event_type""",
    "detect_type_errors": f"""WITH f AS ({_CELL}),
        x AS (SELECT CASE WHEN event_type = 'signup' THEN 't' || CAST(t AS VARCHAR) ELSE CAST(t AS VARCHAR) END AS time_text,
                     CAST(value AS VARCHAR) AS value_text, cell FROM f)
        SELECT 'time' AS "column", CAST(count(*) FILTER (WHERE time_text IS NOT NULL AND TRY_CAST(time_text AS BIGINT) IS NULL) AS BIGINT) AS n_bad FROM x
        UNION ALL SELECT 'value', CAST(count(*) FILTER (WHERE value_text IS NOT NULL AND TRY_CAST(value_text AS DOUBLE) IS NULL) AS BIGINT) FROM x
        UNION ALL SELECT 'cell', CAST(count(*) FILTER (WHERE cell IS NOT NULL AND TRY_CAST(cell AS DOUBLE) IS NULL) AS BIGINT) FROM x""",
    "rejects_report": f"""WITH f AS ({_CELL})
        SELECT 'events_import' AS app, CAST(t AS VARCHAR) || ': bad value ' || cell AS message FROM f WHERE {_BAD}""",
    "pack_dataset": """SELECT epoch_us(l_shipdate) // 1000000 AS timestamp,
        CAST(coalesce(l_quantity, 0.0) AS VARCHAR) || ',' || CAST(coalesce(l_extendedprice, 0.0) AS VARCHAR) || ','
        || CAST(coalesce(l_discount, 0.0) AS VARCHAR) AS data FROM lineitem""",
    "pack_no_timestamp": """SELECT CAST(coalesce(l_quantity, 0.0) AS VARCHAR) || ',' || CAST(coalesce(l_extendedprice, 0.0) AS VARCHAR)
        || ',' || CAST(coalesce(l_discount, 0.0) AS VARCHAR) || ',' || CAST(coalesce(l_tax, 0.0) AS VARCHAR) AS data FROM lineitem""",
    "pack_dataset_rdbms": """SELECT epoch_us(o_orderdate) // 1000000 AS timestamp,
        coalesce(CAST(o_totalprice AS VARCHAR), '') || ',' || coalesce(CAST(o_custkey AS VARCHAR), '') || ','
        || coalesce(o_orderpriority, '') AS data FROM orders""",
    "unpack_dataset": """SELECT epoch_us(l_shipdate) // 1000000 AS timestamp, coalesce(l_quantity, 0.0) AS l_quantity,
        coalesce(l_extendedprice, 0.0) AS l_extendedprice, coalesce(l_discount, 0.0) AS l_discount FROM lineitem""",
    "save_roundtrip": _ORDERS_DAILY,
    "append_dataset": _ORDERS_DAILY,
    "append_manifest": _ORDERS_DAILY,
    "sorted_rank": f"SELECT *, row_number() OVER (ORDER BY timestamp) AS rank FROM ({_ORDERS_DAILY})",
    "sorted_range": f"SELECT * FROM ({_ORDERS_DAILY}) WHERE timestamp BETWEEN {YEARS_START} AND {YEARS_FINISH}",
    "text_roundtrip": """SELECT CAST(c_custkey AS BIGINT) AS c_custkey, c_name, CASE c_custkey % 7 WHEN 0 THEN NULL WHEN 1 THEN ''
          WHEN 2 THEN c_name || ', "' || c_mktsegment || '"' WHEN 3 THEN c_name || chr(10) || c_mktsegment || chr(13) || chr(10)
          WHEN 4 THEN ' %2C%' || c_name || ' ' ELSE c_mktsegment END AS note, c_acctbal FROM customer""",
    "upsample_events": f"""WITH e AS (SELECT event_type, {E} AS t, value FROM events),
        g AS (SELECT *, lead(t, 1, t) OVER (PARTITION BY event_type ORDER BY t, value NULLS FIRST) - t AS gap FROM e)
        SELECT event_type, t + 60 * unnest(range(0, greatest(gap // 60, 1))) AS timestamp, value FROM g""",
    "catalog_compacted": """SELECT n_name AS tablename, CAST(max(c_custkey) AS BIGINT) AS version, arg_max(c_name, c_custkey) AS colname,
        'DoubleType' AS datatype, CAST(0 AS BIGINT) AS orderby FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY n_name""",
    "column_profile": f"""WITH f AS ({_CELL}),
        x AS (SELECT unnest([{{'c': 'time', 'v': CASE WHEN event_type = 'signup' THEN 't' || CAST(t AS VARCHAR) ELSE CAST(t AS VARCHAR) END}},
                             {{'c': 'value', 'v': CAST(value AS VARCHAR)}}, {{'c': 'cell', 'v': nullif(cell, '')}}]) AS r FROM f),
        l AS (SELECT r.c AS c, r.v AS v, CASE WHEN r.v IS NULL THEN 0 WHEN TRY_CAST(r.v AS INTEGER) IS NOT NULL AND NOT contains(r.v, '.') THEN 1
                WHEN TRY_CAST(r.v AS BIGINT) IS NOT NULL AND NOT contains(r.v, '.') THEN 2 WHEN TRY_CAST(r.v AS DOUBLE) IS NOT NULL THEN 3 ELSE 4 END AS n FROM x)
        SELECT c AS "column", list_extract(['string', 'int', 'bigint', 'double', 'string'], max(n) + 1) AS "type",
          CAST(count(*) FILTER (n = 4) AS BIGINT) AS n_text, min(v) FILTER (n = 4) AS example, CAST(count(*) FILTER (v IS NULL) AS BIGINT) AS n_missing
        FROM l GROUP BY c""",
    "csv_roundtrip": "SELECT o_orderkey, o_custkey, o_totalprice, epoch_us(o_orderdate) // 1000000 AS timestamp FROM orders",
    "csv_tag_scan": f"""SELECT t AS timestamp, round(sum(o_totalprice), 2) AS order_total, CAST(count(*) AS DOUBLE) AS order_count
        FROM (SELECT epoch_us(o_orderdate) // 1000000 AS t, o_totalprice FROM orders)
        WHERE t BETWEEN {YEARS_START} AND {YEARS_FINISH} GROUP BY t""",
    "csv_null_to_zero": """SELECT epoch_us(o_orderdate) // 1000000 AS timestamp,
        CASE WHEN o_orderstatus = 'P' THEN 0.0 ELSE o_totalprice END AS price,
        CAST(CASE WHEN o_orderstatus = 'O' THEN 0 ELSE o_custkey END AS BIGINT) AS cust,
        CAST(o_orderkey AS BIGINT) AS okey FROM orders""",
    "catalog_build": """WITH p AS (SELECT DISTINCT o_orderpriority AS p FROM orders WHERE o_orderpriority IS NOT NULL),
        e AS (SELECT 'timestamp' AS colname, 'LongType' AS datatype, CAST(0 AS BIGINT) AS orderby
              UNION ALL SELECT p, 'DoubleType', row_number() OVER (ORDER BY p) FROM p)
        SELECT 'by_priority' AS tablename, colname, datatype, orderby,
               (SELECT string_agg(colname, ',' ORDER BY orderby) FROM e) AS tagNames FROM e""",
    "catalog_from_labels": """WITH labels AS (
          SELECT r_name AS dsabelid, 'erp.' || r_name || '.' || n_name AS labelid, CAST(n_nationkey AS BIGINT) AS ord, 0 AS timestampif
          FROM nation JOIN region ON n_regionkey = r_regionkey
          UNION ALL SELECT r_name, 'erp.' || r_name || '.ts', CAST(-1 AS BIGINT), 1 FROM region),
        o AS (SELECT dsabelid, labelid, timestampif, row_number() OVER (PARTITION BY dsabelid
                ORDER BY CASE WHEN timestampif = 1 THEN 0 ELSE 1 END, ord, labelid) - 1 AS orderby FROM labels),
        t AS (SELECT dsabelid, orderby, CASE WHEN timestampif = 1 THEN 'timestamp' ELSE labelid END AS labelid,
                CASE WHEN timestampif = 1 THEN 'LongType' ELSE 'DoubleType' END AS datatype FROM o),
        n AS (SELECT dsabelid, string_agg(regexp_extract(labelid, '([^.]*)$', 1), ',' ORDER BY orderby) AS tagNames
              FROM t GROUP BY dsabelid)
        SELECT t.dsabelid AS tablename, t.labelid AS colname, datatype, CAST(t.orderby AS BIGINT) AS orderby,
               n.tagNames FROM t JOIN n USING (dsabelid)""",
    "catalog_from_labels_customers": """WITH base AS (
          SELECT 'cust_' || CAST(c_custkey AS VARCHAR) AS dsabelid, n_name, c_mktsegment
          FROM customer JOIN nation ON c_nationkey = n_nationkey),
        labels AS (
          SELECT dsabelid, 'erp.' || n_name || '.' || c_mktsegment AS labelid, 2 AS ord, 0 AS timestampif FROM base
          UNION ALL SELECT dsabelid, 'erp.' || n_name || '.balance', 1, 0 FROM base
          UNION ALL SELECT dsabelid, 'erp.' || n_name || '.ts', 9, 1 FROM base),
        o AS (SELECT dsabelid, labelid, timestampif, row_number() OVER (PARTITION BY dsabelid
                ORDER BY CASE WHEN timestampif = 1 THEN 0 ELSE 1 END, ord, labelid) - 1 AS orderby FROM labels),
        t AS (SELECT dsabelid, orderby, CASE WHEN timestampif = 1 THEN 'timestamp' ELSE labelid END AS labelid,
                CASE WHEN timestampif = 1 THEN 'LongType' ELSE 'DoubleType' END AS datatype FROM o),
        n AS (SELECT dsabelid, string_agg(regexp_extract(labelid, '([^.]*)$', 1), ',' ORDER BY orderby) AS tagNames
              FROM t GROUP BY dsabelid)
        SELECT t.dsabelid AS tablename, t.labelid AS colname, datatype, CAST(t.orderby AS BIGINT) AS orderby,
               n.tagNames FROM t JOIN n USING (dsabelid)""",
    "catalog_lookup": """SELECT n_name AS tablename, CAST(max(c_custkey) AS BIGINT) AS version, arg_max(c_name, c_custkey) AS colname,
        'DoubleType' AS datatype, CAST(0 AS BIGINT) AS orderby FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY n_name""",
    "cast_by_catalog": "SELECT p_partkey, p_name, p_size, p_retailprice FROM part",
    "bad_field_names": """SELECT p_brand AS tablename, regexp_extract('erp.' || p_type || '.' || p_name, '([^.]*)$', 1) AS colname
        FROM part WHERE NOT regexp_matches(regexp_extract('erp.' || p_type || '.' || p_name, '([^.]*)$', 1),
                                           '^[A-Za-z_][A-Za-z0-9_]*$')""",
    "resolve_source": """SELECT CAST(c_custkey AS BIGINT) AS dsabelid, CAST(c_nationkey AS BIGINT) AS datasourcesid,
        n_name AS dsname, r_name FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey""",
    "multi_table_select": f"""SELECT o_orderkey, o_totalprice, c_name, n_name
        FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
        WHERE epoch_us(o_orderdate) // 1000000 BETWEEN {YEARS_START} AND {YEARS_FINISH}""",
    "composite_keys": """SELECT a.l_orderkey, a.l_linenumber, a.l_quantity AS qa, b.l_quantity AS qb FROM lineitem a
        JOIN lineitem b ON a.l_orderkey = b.l_orderkey AND a.l_linenumber = b.l_linenumber""",
    "rdbms_import": f"""SELECT epoch_us(o_orderdate) // 1000000 AS timestamp, CAST(o_custkey AS DOUBLE) AS o_custkey, o_totalprice
        FROM orders WHERE epoch_us(o_orderdate) // 1000000 BETWEEN {YEARS_START} AND {YEARS_FINISH}""",
    "next_gap_users": f"""WITH e AS (SELECT CASE WHEN user_id % 7 <> 0 THEN user_id END AS user_id, {E} AS t FROM events),
        h AS (SELECT user_id, t - t % 3600 AS t FROM e)
        SELECT user_id, t AS timestamp, lead(t, 1, t) OVER (PARTITION BY user_id ORDER BY t) - t AS gap FROM h""",
    "resample_events": f"""WITH src AS (SELECT event_type AS series, {E} AS ts, value AS v FROM events),
{_resample_ctes(['v'], 3600, 'v')}
        SELECT series AS event_type, ts AS timestamp, round(v, 6) AS value FROM res""",
    "resample_users": f"""WITH e AS (SELECT CASE WHEN user_id % 7 <> 0 THEN user_id END AS series, {E} AS t, value AS v FROM events),
src AS (SELECT series, t - t % 3600 AS ts, v FROM e),
{_resample_ctes(['v'], 86400, 'v')}
        SELECT series AS user_id, ts AS timestamp, round(v, 6) AS value FROM res""",
    "resample_equal_ties": f"""WITH e AS (SELECT event_type AS series, {E} AS t, value AS v FROM events),
src AS (SELECT series, t - t % 3600 AS ts, v FROM e),
{_resample_ctes(['v'], 3600, 'v')}
        SELECT series AS event_type, ts AS timestamp, round(v, 6) AS value FROM res""",
    "align_multiply": _all_types(60, "round(coalesce({k}_s.v, 0.0), 6) AS {k}", "SELECT t, v FROM {rows}"),
    "align_average": _all_types(3600, "round(coalesce({k}_s.v, 0.0), 6) AS {k}", "SELECT t, avg(v) AS v FROM {rows} GROUP BY t"),
    "align_unique": _all_types(1, "round(coalesce({k}_s.v, 0.0), 6) AS {k}", "SELECT t, avg(v) AS v, count(*) AS n FROM {rows} GROUP BY t",
                               "coalesce({k}_s.n, 0) <= 1"),
    "flag_type_errors": f"""WITH f AS ({_CELL})
        SELECT CASE WHEN event_type = 'signup' THEN 't' || CAST(t AS VARCHAR) ELSE CAST(t AS VARCHAR) END AS time, cell FROM f
        WHERE event_type = 'signup' OR (cell IS NOT NULL AND TRY_CAST(cell AS DOUBLE) IS NULL)""",
    "reject_log": f"""WITH e AS (SELECT CASE WHEN event_type = 'click' THEN 'click' ELSE 'view' END AS event_type, {E} AS t FROM events),
        h AS (SELECT event_type, t - t % 3600 AS t, count(*) AS n FROM e GROUP BY 1, 2),
        src AS (SELECT 'view' AS series, t + 900 AS ts, CAST(n AS DOUBLE) AS v FROM h
                WHERE event_type = 'view' AND t + 900 BETWEEN {JAN_START} AND {JAN_FINISH + 86401}),
{_resample_ctes(['v'], 3600)},
        m AS (SELECT 'NULL: bad time t' || CAST(t AS VARCHAR) AS message FROM h WHERE event_type = 'click' AND n % 5 = 0
              UNION ALL SELECT CAST(t AS VARCHAR) || ': bad value x' || CAST(n AS VARCHAR) FROM h
                WHERE event_type = 'click' AND n % 7 = 0 AND n % 5 <> 0 AND t BETWEEN {JAN_START} AND {JAN_FINISH + 86401}
              UNION ALL SELECT CAST(ts AS VARCHAR) || ': off the key timeline' FROM res)
        SELECT 'hourly' AS app, message FROM m""",
    "csv_import": _csv_import(),
}
ORACLE_SQL = {k: snap_rounds(v) for k, v in ORACLE_SQL.items()}
