"""Registered queries: each library operator run over the driver's whole tables.

``QUERIES[name](spark, sf_dir)`` returns a lazy DataFrame; ``ORACLE_SQL[name]`` is the same
question in plain SQL over the same tables, used as the correctness oracle. Column names
are equal on both sides. In every query ``o_orderpriority`` (or another natural grouping
column) plays the series id and a date or timestamp column plays the series date, so each
operator works on many series at once, as it would on the stored market tables.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.columns import apply_types, clean_column_names, split_datetime, to_numeric
from tidemark.operators.align import Source, align_features
from tidemark.operators.checks import check_unique, column_test_report, count_not_null_failures
from tidemark.operators.dates import date_bounds, date_gaps, duplicate_dates, missing_dates
from tidemark.operators.fill import fill_daily
from tidemark.operators.incremental import (
    after_high_water_mark,
    apply_backfill,
    backfill_plan,
    backfill_ranges,
    gate_by_weekday,
    ingest_plan,
)
from tidemark.operators.rows import dedupe_rows, duplicate_row_count, profile_series
from tidemark.sources.catalog import schedule
from tidemark.sources.footers import footer_bounds
from tidemark.sources.landing import (
    classify_payloads,
    dump_values,
    explode_json_object,
    melt_values,
    parse_bars,
    parse_indicator,
    parse_keyed_series,
    parse_table_dump,
    shape_bars,
)

QueryFn = Callable[[SparkSession, str], DataFrame]

# Cut-off that splits orders into "already stored" and "landed later" in the load queries.
STORED_BEFORE = "TIMESTAMP_NTZ '2000-01-01 00:00:00'"
RUN_DATE = dt.date(2001, 8, 2)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


QUERIES: dict[str, QueryFn] = {}
ORACLE_SQL: dict[str, str] = {}


def register(name: str, sql: str | None):
    def wrap(fn: QueryFn) -> QueryFn:
        QUERIES[name] = fn
        if sql is not None:
            ORACLE_SQL[name] = sql.strip()
        return fn

    return wrap


# --- calendar checks (A7-A9, J2) -----------------------------------------------------------

_MISSING_ORDERS_SQL = """
WITH obs AS (
  SELECT DISTINCT o_orderpriority, CAST(o_orderdate AS DATE) AS d
  FROM orders WHERE o_orderdate IS NOT NULL),
b AS (SELECT o_orderpriority, min(d) AS lo, max(d) AS hi FROM obs GROUP BY o_orderpriority),
cal AS (
  SELECT o_orderpriority,
         unnest(generate_series(CAST(lo AS TIMESTAMP), CAST(hi AS TIMESTAMP), INTERVAL 1 DAY)) AS ts
  FROM b),
missing AS (
  SELECT o_orderpriority, CAST(ts AS DATE) AS missing_date FROM cal
  WHERE NOT EXISTS (
    SELECT 1 FROM obs
    WHERE obs.o_orderpriority IS NOT DISTINCT FROM cal.o_orderpriority
      AND obs.d = CAST(cal.ts AS DATE)))
"""


@register("missing_dates", _MISSING_ORDERS_SQL + "SELECT o_orderpriority, missing_date FROM missing")
def q_missing_dates(spark, sf_dir):
    return missing_dates(table(spark, sf_dir, "orders"), "o_orderdate", ["o_orderpriority"])


@register("missing_dates_calendar", _MISSING_ORDERS_SQL + "SELECT o_orderpriority, missing_date FROM missing")
def q_missing_dates_calendar(spark, sf_dir):
    # The same question answered as calendar minus observed days (left anti join, J2).
    return missing_dates(table(spark, sf_dir, "orders"), "o_orderdate", ["o_orderpriority"], method="calendar")


@register(
    "missing_ship_dates",
    """
WITH obs AS (
  SELECT DISTINCT l_returnflag, l_linestatus, CAST(l_shipdate AS DATE) AS d
  FROM lineitem WHERE l_shipdate IS NOT NULL),
b AS (SELECT l_returnflag, l_linestatus, min(d) AS lo, max(d) AS hi FROM obs GROUP BY ALL),
cal AS (
  SELECT l_returnflag, l_linestatus,
         unnest(generate_series(CAST(lo AS TIMESTAMP), CAST(hi AS TIMESTAMP), INTERVAL 1 DAY)) AS ts
  FROM b)
SELECT l_returnflag, l_linestatus, CAST(ts AS DATE) AS missing_date FROM cal
WHERE NOT EXISTS (
  SELECT 1 FROM obs
  WHERE obs.l_returnflag IS NOT DISTINCT FROM cal.l_returnflag
    AND obs.l_linestatus IS NOT DISTINCT FROM cal.l_linestatus
    AND obs.d = CAST(cal.ts AS DATE))
""",
)
def q_missing_ship_dates(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem")
    return missing_dates(li, "l_shipdate", ["l_returnflag", "l_linestatus"])


@register(
    "duplicate_dates",
    """
SELECT o_orderpriority, CAST(o_orderdate AS DATE) AS date, count(*) AS n_rows
FROM orders WHERE o_orderdate IS NOT NULL
GROUP BY o_orderpriority, CAST(o_orderdate AS DATE)
HAVING count(*) > 1
""",
)
def q_duplicate_dates(spark, sf_dir):
    return duplicate_dates(table(spark, sf_dir, "orders"), "o_orderdate", ["o_orderpriority"])


# --- reconciliation and copies (A1-A6, U2, U3) ---------------------------------------------


@register(
    "profile_series",
    """
WITH u AS (
  SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority,
         count(*) AS copies
  FROM orders GROUP BY ALL),
p AS (
  SELECT o_orderpriority,
         min(CAST(o_orderdate AS DATE)) AS min_date,
         max(CAST(o_orderdate AS DATE)) AS max_date,
         CAST(sum(copies) AS BIGINT) AS n_rows,
         CAST(count(*) AS BIGINT) AS n_unique_rows
  FROM u GROUP BY o_orderpriority)
SELECT o_orderpriority, min_date, max_date, n_rows, n_unique_rows,
       CAST(date_diff('day', min_date, max_date) + 1 AS BIGINT) AS calendar_days,
       CAST(date_diff('day', min_date, max_date) + 2 AS BIGINT) AS span_ref,
       CAST(0 AS BIGINT) AS known_missing,
       CAST(date_diff('day', min_date, max_date) + 2 AS BIGINT) AS expected_rows,
       CAST(date_diff('day', min_date, max_date) + 2 - n_unique_rows AS BIGINT) AS row_count_error,
       CAST(max_date + INTERVAL 1 DAY AS DATE) AS next_start
FROM p
""",
)
def q_profile_series(spark, sf_dir):
    return profile_series(table(spark, sf_dir, "orders"), "o_orderdate", ["o_orderpriority"])


@register("dedupe_rows", "SELECT DISTINCT lang, source, text FROM documents")
def q_dedupe_rows(spark, sf_dir):
    return dedupe_rows(table(spark, sf_dir, "documents").select("lang", "source", "text"))


@register(
    "duplicate_row_count",
    """
WITH u AS (SELECT lang, source, text, count(*) AS c FROM documents GROUP BY ALL)
SELECT lang, CAST(sum(c) AS BIGINT) AS n_rows, CAST(count(*) AS BIGINT) AS n_unique_rows,
       CAST(sum(c) - count(*) AS BIGINT) AS n_duplicate_rows
FROM u GROUP BY lang
""",
)
def q_duplicate_row_count(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("lang", "source", "text")
    return duplicate_row_count(docs, ["lang"])


# --- incremental load (F1, A4, F5, F6, J1, S9) ---------------------------------------------


@register(
    "after_high_water_mark",
    """
WITH m AS (
  SELECT o_orderpriority AS k, max(o_orderdate) AS hwm FROM orders
  WHERE o_orderdate < TIMESTAMP '2000-01-01 00:00:00' GROUP BY o_orderpriority)
SELECT o.* FROM orders o LEFT JOIN m ON o.o_orderpriority IS NOT DISTINCT FROM m.k
WHERE m.hwm IS NULL OR o.o_orderdate > m.hwm
""",
)
def q_after_high_water_mark(spark, sf_dir):
    # Orders before 2000 play the stored table, all orders the landed increment.
    orders = table(spark, sf_dir, "orders")
    stored = orders.where(F.col("o_orderdate") < F.expr(STORED_BEFORE))
    return after_high_water_mark(orders, stored, "o_orderdate", ["o_orderpriority"])


@register(
    "ingest_plan",
    """
SELECT o_orderpriority, CAST(max(o_orderdate) AS DATE) AS last_date,
       CAST(CAST(max(o_orderdate) AS DATE) + INTERVAL 1 DAY AS DATE) AS next_start,
       DATE '2001-08-02' AS end_date,
       coalesce(CAST(CAST(max(o_orderdate) AS DATE) + INTERVAL 1 DAY AS DATE) < DATE '2001-08-02', false) AS due
FROM orders GROUP BY o_orderpriority
""",
)
def q_ingest_plan(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    return ingest_plan(orders, "o_orderdate", ["o_orderpriority"], RUN_DATE)


@register(
    "backfill_plan",
    _MISSING_ORDERS_SQL
    + """
SELECT o_orderpriority, strftime(missing_date, '%Y-%m-%d') AS start_date,
       strftime(missing_date, '%Y-%m-%d') AS end_date
FROM missing
""",
)
def q_backfill_plan(spark, sf_dir):
    missing = q_missing_dates(spark, sf_dir)
    return backfill_plan(missing, ["o_orderpriority"])


@register(
    "apply_backfill",
    """
SELECT l.* FROM orders l
WHERE l.o_orderstatus <> 'F'
  AND NOT EXISTS (
    SELECT 1 FROM orders t
    WHERE t.o_orderstatus = 'F'
      AND t.o_orderpriority IS NOT DISTINCT FROM l.o_orderpriority
      AND CAST(t.o_orderdate AS DATE) = CAST(l.o_orderdate AS DATE))
""",
)
def q_apply_backfill(spark, sf_dir):
    # Finished orders play the stored table; the other orders are the re-fetched days, kept
    # only where the stored table has no row for their (series, day).
    orders = table(spark, sf_dir, "orders")
    stored = orders.where(F.col("o_orderstatus") == "F")
    landed = orders.where(F.col("o_orderstatus") != "F")
    return apply_backfill(stored, landed, "o_orderdate", ["o_orderpriority"])


@register(
    "due_sources",
    """
WITH o AS (
  SELECT o_orderkey, o_orderdate,
         CASE o_orderstatus WHEN 'F' THEN 'A' WHEN 'O' THEN 'B' END AS grp
  FROM orders),
s AS (SELECT * FROM (VALUES ('A', [0, 2, 4, 6]), ('B', [1, 3, 5])) AS t(sgrp, dow))
SELECT o.o_orderkey, o.o_orderdate, o.grp,
       CAST(isodow(o.o_orderdate) - 1 AS INTEGER) AS weekday,
       CASE WHEN o.grp IS NULL THEN true
            ELSE coalesce(list_contains(s.dow, CAST(isodow(o.o_orderdate) - 1 AS INTEGER)), false) END AS due
FROM o LEFT JOIN s ON o.grp = s.sgrp
""",
)
def q_due_sources(spark, sf_dir):
    # Every order is a fetch request on its order day; its status gives the schedule group
    # (F -> A, O -> B, P -> no group, due every day).
    orders = table(spark, sf_dir, "orders")
    grouped = orders.select(
        "o_orderkey",
        "o_orderdate",
        F.when(F.col("o_orderstatus") == "F", "A").when(F.col("o_orderstatus") == "O", "B").alias("grp"),
    )
    return gate_by_weekday(grouped, "o_orderdate", "grp", schedule(spark))


# --- shaping (P1-P8) -----------------------------------------------------------------------


@register(
    "split_datetime",
    """
SELECT event_id,
       strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') || '0Z' AS ts_text,
       CAST(ts AS DATE) AS event_date,
       CASE WHEN strftime(ts, '%f') = '000000' THEN strftime(ts, '%H:%M:%S')
            ELSE strftime(ts, '%H:%M:%S.%f') END AS event_time
FROM events
""",
)
def q_split_datetime(spark, sf_dir):
    ev = table(spark, sf_dir, "events")
    text = ev.select(
        "event_id",
        F.concat(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"), F.lit("0Z")).alias("ts_text"),
    )
    return split_datetime(text, {"ts_text": ("event_date", "event_time")}, parse_text=True).select(
        "event_id", "ts_text", "event_date", "event_time"
    )


_NUM = r"^\s*[+-]?((\d+\.?\d*|\.\d+)([eE][+-]?\d+)?|[iI][nN][fF]([iI][nN][iI][tT][yY])?)\s*$"


def _sql_to_numeric(expr: str) -> str:
    return (
        f"CASE WHEN regexp_matches({expr}, '{_NUM}') "
        f"THEN TRY_CAST(regexp_replace({expr}, '^\\s+|\\s+$', '', 'g') AS DOUBLE) END"
    )


_MIXED_SQL = (
    "props->>'$.k' || CASE event_type WHEN 'error' THEN 'd' WHEN 'click' THEN 'e2' "
    "WHEN 'purchase' THEN ' ' WHEN 'signup' THEN '.5' ELSE '' END"
)


@register(
    "to_numeric",
    f"""
SELECT event_id,
       {_sql_to_numeric("props->>'$.k'")} AS k_num,
       {_sql_to_numeric("CAST(value AS VARCHAR)")} AS value_num,
       {_sql_to_numeric(_MIXED_SQL)} AS mixed_num,
       {_sql_to_numeric("props")} AS props_num
FROM events
""",
)
def q_to_numeric(spark, sf_dir):
    ev = table(spark, sf_dir, "events")
    k = F.get_json_object("props", "$.k")
    suffix = (
        F.when(F.col("event_type") == "error", "d")
        .when(F.col("event_type") == "click", "e2")
        .when(F.col("event_type") == "purchase", " ")
        .when(F.col("event_type") == "signup", ".5")
        .otherwise("")
    )
    return ev.select(
        "event_id",
        to_numeric(k).alias("k_num"),
        to_numeric(F.col("value").cast("string")).alias("value_num"),
        to_numeric(F.concat(k, suffix)).alias("mixed_num"),
        to_numeric("props").alias("props_num"),
    )


@register(
    "apply_types",
    """
SELECT l_orderkey, l_partkey, l_suppkey,
       TRY_CAST(l_linenumber AS DOUBLE) AS l_linenumber,
       TRY_CAST(l_quantity AS BIGINT) AS l_quantity,
       l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus,
       TRY_CAST(l_shipdate AS DATE) AS l_shipdate
FROM lineitem
""",
)
def q_apply_types(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem")
    return apply_types(li, {"l_quantity": "bigint", "l_linenumber": "double", "l_shipdate": "date"})


@register(
    "apply_types_bad",
    """
SELECT p_partkey, TRY_CAST(p_name AS DATE) AS p_name, TRY_CAST(p_brand AS BIGINT) AS p_brand,
       p_type, p_size, p_retailprice
FROM part
""",
)
def q_apply_types_bad(spark, sf_dir):
    return apply_types(table(spark, sf_dir, "part"), {"p_name": "date", "p_brand": "bigint"})


@register(
    "clean_column_names",
    """
SELECT p_partkey, p_retailprice AS p_retailprice__USD_, p_name AS name_brand_1_,
       p_size AS "size___cm___"
FROM part
""",
)
def q_clean_column_names(spark, sf_dir):
    part = table(spark, sf_dir, "part").select(
        F.col("p_partkey"),
        F.col("p_retailprice").alias("p_retailprice (USD)"),
        F.col("p_name").alias("name/brand:1?"),
        F.col("p_size").alias("size, (cm)#!"),
    )
    return clean_column_names(part)


# --- payloads (S2, S5) ---------------------------------------------------------------------


@register(
    "read_keyed_series",
    """
SELECT event_id, k AS key, json_extract_string(props, '$."' || k || '"') AS value
FROM (SELECT event_id, props, unnest(json_keys(props)) AS k FROM events)
""",
)
def q_read_keyed_series(spark, sf_dir):
    ev = table(spark, sf_dir, "events").select("event_id", "props")
    return explode_json_object(ev, "props")


_PAYLOADS_SQL = """
WITH p AS (
  SELECT 'event-' || CAST(event_id AS VARCHAR) AS payload_id,
         CASE event_type
           WHEN 'error' THEN '{"Error Message": "call ' || CAST(event_id AS VARCHAR) || ' failed"}'
           WHEN 'signup' THEN '{"Information": "limit reached at ' || CAST(event_id AS VARCHAR) || '"}'
           ELSE props END AS payload
  FROM events
  UNION ALL
  SELECT 'page-' || CAST(page_id AS VARCHAR), html FROM pages)
SELECT payload_id,
       CASE WHEN NOT coalesce(json_valid(payload), false) THEN 'corrupt'
            WHEN json_type(payload) = 'ARRAY' THEN 'ok'
            WHEN json_type(payload) <> 'OBJECT' THEN 'corrupt'
            WHEN len(json_keys(payload)) = 0 THEN 'corrupt'
            WHEN list_contains(list_transform(json_keys(payload), lambda k: lower(k)), 'error message') THEN 'error'
            WHEN list_contains(list_transform(json_keys(payload), lambda k: lower(k)), 'information') THEN 'quota'
            ELSE 'ok' END AS payload_class,
       CASE WHEN json_valid(payload) AND json_type(payload) = 'OBJECT'
                 AND list_contains(list_transform(json_keys(payload), lambda k: lower(k)), 'error message')
              THEN json_extract_string(payload, '$."Error Message"')
            WHEN json_valid(payload) AND json_type(payload) = 'OBJECT'
                 AND list_contains(list_transform(json_keys(payload), lambda k: lower(k)), 'information')
              THEN json_extract_string(payload, '$.Information') END AS message
FROM p
"""


@register("classify_payloads", _PAYLOADS_SQL)
def q_classify_payloads(spark, sf_dir):
    # Event properties are the landed payloads, with error and quota answers put in place
    # of two event types; web pages are payloads that are not JSON at all.
    ev = table(spark, sf_dir, "events")
    eid = F.col("event_id").cast("string")
    payload = (
        F.when(F.col("event_type") == "error", F.concat(F.lit('{"Error Message": "call '), eid, F.lit(' failed"}')))
        .when(F.col("event_type") == "signup", F.concat(F.lit('{"Information": "limit reached at '), eid, F.lit('"}')))
        .otherwise(F.col("props"))
    )
    events = ev.select(F.concat(F.lit("event-"), eid).alias("payload_id"), payload.alias("payload"))
    pages = table(spark, sf_dir, "pages").select(
        F.concat(F.lit("page-"), F.col("page_id").cast("string")).alias("payload_id"),
        F.col("html").alias("payload"),
    )
    return classify_payloads(events.unionByName(pages)).drop("payload")


# --- model column tests and top-k (A10, A11, T3) -------------------------------------------


@register(
    "check_unique",
    """
SELECT o_custkey, count(*) AS n_rows FROM orders
WHERE o_custkey IS NOT NULL GROUP BY o_custkey HAVING count(*) > 1
""",
)
def q_check_unique(spark, sf_dir):
    return check_unique(table(spark, sf_dir, "orders"), "o_custkey")


@register(
    "check_not_null",
    """
SELECT CAST(count(*) FILTER (WHERE l.quality IS NULL) AS BIGINT) AS n_failing
FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id
""",
)
def q_check_not_null(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id")
    labels = table(spark, sf_dir, "labels")
    return count_not_null_failures(docs.join(labels, "doc_id", "left"), "quality")


@register(
    "column_tests",
    """
WITH t AS (
  SELECT 'orders' AS model, 'o_orderkey' AS column_name, 'unique' AS test,
         (SELECT count(*) FROM (SELECT o_orderkey FROM orders WHERE o_orderkey IS NOT NULL
                                GROUP BY o_orderkey HAVING count(*) > 1)) AS n_failing
  UNION ALL
  SELECT 'orders', 'o_orderkey', 'not_null', (SELECT count(*) FROM orders WHERE o_orderkey IS NULL)
  UNION ALL
  SELECT 'orders', 'o_custkey', 'unique',
         (SELECT count(*) FROM (SELECT o_custkey FROM orders WHERE o_custkey IS NOT NULL
                                GROUP BY o_custkey HAVING count(*) > 1))
  UNION ALL
  SELECT 'orders', 'o_orderdate', 'not_null', (SELECT count(*) FROM orders WHERE o_orderdate IS NULL))
SELECT model, column_name, test, CAST(n_failing AS BIGINT) AS n_failing, n_failing = 0 AS passed FROM t
""",
)
def q_column_tests(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    tests = [
        ("o_orderkey", "unique"),
        ("o_orderkey", "not_null"),
        ("o_custkey", "unique"),
        ("o_orderdate", "not_null"),
    ]
    return column_test_report(orders, tests, model="orders")


@register(
    "top_n",
    "SELECT * FROM orders ORDER BY o_orderdate, o_orderkey LIMIT 100",
)
def q_top_n(spark, sf_dir):
    # The feature is a 100-row sample of the table; a total order makes it deterministic.
    return table(spark, sf_dir, "orders").orderBy("o_orderdate", "o_orderkey").limit(100)


# --- more calendar forms (A7, A9 weekday calendar, F1 single series) ----------------------


@register(
    "date_bounds",
    """
SELECT o_orderpriority, min(CAST(o_orderdate AS DATE)) AS earliest, max(CAST(o_orderdate AS DATE)) AS latest
FROM orders GROUP BY o_orderpriority
""",
)
def q_date_bounds(spark, sf_dir):
    return date_bounds(table(spark, sf_dir, "orders"), "o_orderdate", ["o_orderpriority"])


@register(
    "missing_weekdays",
    _MISSING_ORDERS_SQL.replace(
        "WHERE NOT EXISTS (", "WHERE isodow(CAST(ts AS DATE)) < 6 AND NOT EXISTS ("
    )
    + "SELECT o_orderpriority, missing_date FROM missing",
)
def q_missing_weekdays(spark, sf_dir):
    return missing_dates(table(spark, sf_dir, "orders"), "o_orderdate", ["o_orderpriority"], weekdays_only=True)


@register(
    "after_high_water_mark_single",
    """
WITH m AS (SELECT max(o_orderdate) AS hwm FROM orders WHERE o_orderdate < TIMESTAMP '2000-01-01 00:00:00')
SELECT orders.* FROM orders, m
WHERE m.hwm IS NULL OR orders.o_orderdate > m.hwm
""",
)
def q_after_high_water_mark_single(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    stored = orders.where(F.col("o_orderdate") < F.expr(STORED_BEFORE))
    return after_high_water_mark(orders, stored, "o_orderdate")


# --- daily grid with filled values (I2) ---------------------------------------------------


@register(
    "fill_daily",
    """
WITH daily AS (
  SELECT o_orderpriority, CAST(o_orderdate AS DATE) AS d, CAST(count(o_orderkey) AS DOUBLE) AS v
  FROM orders WHERE o_orderdate IS NOT NULL GROUP BY 1, 2),
b AS (SELECT o_orderpriority, min(d) AS lo, max(d) AS hi FROM daily GROUP BY 1),
cal AS (
  SELECT o_orderpriority,
         CAST(unnest(generate_series(CAST(lo AS TIMESTAMP), CAST(hi AS TIMESTAMP), INTERVAL 1 DAY)) AS DATE) AS d
  FROM b),
g AS (
  SELECT c.o_orderpriority, c.d, daily.v,
         CASE WHEN daily.v IS NOT NULL THEN c.d END AS seen
  FROM cal c LEFT JOIN daily ON c.o_orderpriority = daily.o_orderpriority AND c.d = daily.d),
w AS (
  SELECT o_orderpriority, d, v,
    last_value(v IGNORE NULLS) OVER (PARTITION BY o_orderpriority ORDER BY d
      ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS pv,
    last_value(seen IGNORE NULLS) OVER (PARTITION BY o_orderpriority ORDER BY d
      ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS pd,
    first_value(v IGNORE NULLS) OVER (PARTITION BY o_orderpriority ORDER BY d
      ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS nv,
    first_value(seen IGNORE NULLS) OVER (PARTITION BY o_orderpriority ORDER BY d
      ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS nd
  FROM g)
SELECT o_orderpriority, d AS date, v AS value, pv AS value_ffill,
  CASE WHEN v IS NOT NULL THEN v
       WHEN pv IS NOT NULL AND nv IS NOT NULL AND date_diff('day', pd, nd) > 0
         THEN pv + (nv - pv) * CAST(date_diff('day', pd, d) AS DOUBLE) / CAST(date_diff('day', pd, nd) AS DOUBLE)
  END AS value_linear
FROM w
""",
)
def q_fill_daily(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    return fill_daily(orders, "o_orderdate", "o_orderkey", ["o_orderpriority"], agg="count")


# --- payload readers over payloads derived from the tables (S1, S2, S3, S4) ---------------

_ISO = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'"


def _events_time_text(col):
    return F.date_format(col, _ISO)


@register(
    "parse_bars",
    """
SELECT event_type AS series_id,
       CAST(ts AS DATE) AS date_period_start,
       CASE WHEN strftime(ts, '%f') = '000000' THEN strftime(ts, '%H:%M:%S') ELSE strftime(ts, '%H:%M:%S.%f') END AS time_period_start,
       CAST(ts + INTERVAL 1 DAY AS DATE) AS date_period_end,
       CASE WHEN strftime(ts, '%f') = '000000' THEN strftime(ts, '%H:%M:%S') ELSE strftime(ts, '%H:%M:%S.%f') END AS time_period_end,
       CAST(ts AS DATE) AS date_open,
       CASE WHEN strftime(ts, '%f') = '000000' THEN strftime(ts, '%H:%M:%S') ELSE strftime(ts, '%H:%M:%S.%f') END AS time_open,
       CAST(ts AS DATE) AS date_close,
       '23:59:59' AS time_close,
       value AS price_open, value AS price_close, value + 1 AS price_high, value - 1 AS price_low,
       CAST(props->>'$.k' AS DOUBLE) AS volume_traded, user_id AS trades_count
FROM events
""",
)
def q_parse_bars(spark, sf_dir):
    # One bar payload per event, written by Spark from the event's columns, read back.
    ev = table(spark, sf_dir, "events")
    bar = F.struct(
        _events_time_text("ts").alias("time_period_start"),
        _events_time_text(F.col("ts") + F.expr("INTERVAL 1 DAY")).alias("time_period_end"),
        _events_time_text("ts").alias("time_open"),
        F.concat(F.date_format("ts", "yyyy-MM-dd"), F.lit("T23:59:59.0000000Z")).alias("time_close"),
        F.col("value").alias("price_open"),
        (F.col("value") + 1).alias("price_high"),
        (F.col("value") - 1).alias("price_low"),
        F.col("value").alias("price_close"),
        F.get_json_object("props", "$.k").cast("double").alias("volume_traded"),
        F.col("user_id").alias("trades_count"),
    )
    landed = ev.select(F.col("event_type").alias("series_id"), F.to_json(F.array(bar)).alias("payload"))
    return shape_bars(parse_bars(classify_payloads(landed, expect="array")))


@register(
    "parse_keyed_series",
    """
SELECT event_id, strftime(ts, '%Y-%m-%d') AS date,
       CAST(value AS VARCHAR) AS "1__open", CAST(value + 1 AS VARCHAR) AS "2__high",
       CAST(value - 1 AS VARCHAR) AS "3__low", CAST(value AS VARCHAR) AS "4__close",
       props->>'$.k' AS "5__volume"
FROM events
""",
)
def q_parse_keyed_series(spark, sf_dir):
    # One date-keyed daily payload per event, written by Spark from the event, read back.
    ev = table(spark, sf_dir, "events")
    bar = F.create_map(
        F.lit("1. open"), F.col("value").cast("string"),
        F.lit("2. high"), (F.col("value") + 1).cast("string"),
        F.lit("3. low"), (F.col("value") - 1).cast("string"),
        F.lit("4. close"), F.col("value").cast("string"),
        F.lit("5. volume"), F.get_json_object("props", "$.k"),
    )
    payload = F.to_json(
        F.create_map(F.lit("Time Series (Daily)"), F.create_map(F.date_format("ts", "yyyy-MM-dd"), bar))
    )
    landed = ev.select("event_id", payload.alias("payload"))
    return parse_keyed_series(landed)


@register(
    "parse_indicator",
    """
SELECT event_id, event_type AS name, 'daily' AS "interval", 'count' AS unit,
       CAST(CAST(ts AS DATE) AS TIMESTAMP) AS date, CAST(props->>'$.k' AS DOUBLE) AS value
FROM events
UNION ALL
SELECT event_id, event_type, 'daily', 'count',
       CAST(CAST(ts AS DATE) + INTERVAL 1 DAY AS TIMESTAMP), CAST(NULL AS DOUBLE)
FROM events
""",
)
def q_parse_indicator(spark, sf_dir):
    # One indicator payload per event with two records (one value, one "." for missing).
    ev = table(spark, sf_dir, "events")
    day = F.to_date("ts")
    payload = F.to_json(
        F.struct(
            F.col("event_type").alias("name"),
            F.lit("daily").alias("interval"),
            F.lit("count").alias("unit"),
            F.array(
                F.struct(F.date_format(day, "yyyy-MM-dd").alias("date"), F.get_json_object("props", "$.k").alias("value")),
                F.struct(F.date_format(F.date_add(day, 1), "yyyy-MM-dd").alias("date"), F.lit(".").alias("value")),
            ).alias("data"),
        )
    )
    return parse_indicator(ev.select("event_id", payload.alias("payload")))


@register(
    "table_dump_long",
    """
SELECT l_orderkey, l_linenumber, field, value FROM (
  SELECT l_orderkey, l_linenumber, 'l_quantity' AS field, l_quantity AS value FROM lineitem
  UNION ALL SELECT l_orderkey, l_linenumber, 'l_extendedprice', l_extendedprice FROM lineitem
  UNION ALL SELECT l_orderkey, l_linenumber, 'l_discount', l_discount FROM lineitem
  UNION ALL SELECT l_orderkey, l_linenumber, 'l_tax', l_tax FROM lineitem)
""",
)
def q_table_dump_long(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem")
    return melt_values(li, ["l_orderkey", "l_linenumber"], ["l_quantity", "l_extendedprice", "l_discount", "l_tax"])


@register(
    "parse_table_dump",
    """
SELECT l_orderkey, l_linenumber, CAST(l_shipdate AS DATE) AS date, field, value FROM (
  SELECT l_orderkey, l_linenumber, l_shipdate, 'Disc__' AS field, l_discount AS value FROM lineitem
  UNION ALL SELECT l_orderkey, l_linenumber, l_shipdate, 'Price__', l_extendedprice FROM lineitem
  UNION ALL SELECT l_orderkey, l_linenumber, l_shipdate, 'Qty__units_', l_quantity FROM lineitem)
""",
)
def q_parse_table_dump(spark, sf_dir):
    # One CSV dump per line item (header with characters to clean, one data line).
    li = table(spark, sf_dir, "lineitem")
    line = F.concat_ws(
        ",",
        F.date_format("l_shipdate", "yyyy-MM-dd"),
        F.col("l_quantity").cast("string"),
        F.col("l_extendedprice").cast("string"),
        F.col("l_discount").cast("string"),
    )
    payload = F.concat(F.lit("Date,Qty (units),Price $,Disc %\n"), line, F.lit("\n"))
    landed = li.select("l_orderkey", "l_linenumber", payload.alias("payload"))
    return dump_values(parse_table_dump(classify_payloads(landed, expect="csv"), quoted=False))


# --- one report per series: profile, missing and duplicated days (A1-A9 together) ---------


@register(
    "series_report",
    _MISSING_ORDERS_SQL
    + """,
u AS (
  SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority,
         count(*) AS copies
  FROM orders GROUP BY ALL),
p AS (
  SELECT o_orderpriority,
         min(CAST(o_orderdate AS DATE)) AS min_date,
         max(CAST(o_orderdate AS DATE)) AS max_date,
         CAST(sum(copies) AS BIGINT) AS n_rows,
         CAST(count(*) AS BIGINT) AS n_unique_rows
  FROM u GROUP BY o_orderpriority),
mc AS (SELECT o_orderpriority, count(*) AS n FROM missing GROUP BY 1),
dc AS (
  SELECT o_orderpriority, count(*) AS n FROM (
    SELECT o_orderpriority, CAST(o_orderdate AS DATE) AS d FROM orders
    WHERE o_orderdate IS NOT NULL GROUP BY 1, 2 HAVING count(*) > 1) GROUP BY 1)
SELECT p.o_orderpriority, min_date, max_date, n_rows, n_unique_rows,
       CAST(date_diff('day', min_date, max_date) + 1 AS BIGINT) AS calendar_days,
       CAST(date_diff('day', min_date, max_date) + 2 AS BIGINT) AS span_ref,
       CAST(0 AS BIGINT) AS known_missing,
       CAST(date_diff('day', min_date, max_date) + 2 AS BIGINT) AS expected_rows,
       CAST(date_diff('day', min_date, max_date) + 2 - n_unique_rows AS BIGINT) AS row_count_error,
       CAST(max_date + INTERVAL 1 DAY AS DATE) AS next_start,
       CAST(coalesce(mc.n, 0) AS BIGINT) AS n_missing_days,
       CAST(coalesce(dc.n, 0) AS BIGINT) AS n_duplicate_dates
FROM p
LEFT JOIN mc ON p.o_orderpriority IS NOT DISTINCT FROM mc.o_orderpriority
LEFT JOIN dc ON p.o_orderpriority IS NOT DISTINCT FROM dc.o_orderpriority
""",
)
def q_series_report(spark, sf_dir):
    from tidemark.plans.run import series_report

    return series_report(table(spark, sf_dir, "orders"), "o_orderdate", ["o_orderpriority"])


# --- readers over payloads of many records, good and bad (S1, S4, S3, P5, S5) --------------


@register(
    "parse_bars_orders",
    """
SELECT l_orderkey, CAST(count(*) AS BIGINT) AS n_good, CAST(2 AS BIGINT) AS n_rejected,
       CAST(sum(l_linenumber) AS BIGINT) AS trades, sum(l_quantity) AS opens
FROM lineitem GROUP BY l_orderkey
""",
)
def q_parse_bars_orders(spark, sf_dir):
    # One bar array per order with a record per line: numbers as text, counts with a point,
    # and two bad elements (a number, an object without times).
    li = table(spark, sf_dir, "lineitem")
    record = F.struct(
        F.concat(F.date_format("l_shipdate", "yyyy-MM-dd"), F.lit("T00:00:00Z")).alias("time_period_start"),
        F.col("l_quantity").cast("string").alias("price_open"),
        F.col("l_linenumber").cast("double").alias("trades_count"),
    )
    arrays = li.groupBy("l_orderkey").agg(F.array_join(F.collect_list(F.to_json(record)), ",").alias("records"))
    payload = F.concat(F.lit('[7,{"price_open":1},'), F.col("records"), F.lit("]"))
    classified = classify_payloads(arrays.select("l_orderkey", payload.alias("payload")), expect="array")
    bars = shape_bars(parse_bars(classified, rejects=True), keep=["l_orderkey"])
    good = F.col("date_period_start").isNotNull()
    return bars.groupBy("l_orderkey").agg(
        F.count_if(good).alias("n_good"),
        F.count_if(~good).alias("n_rejected"),
        F.sum(F.when(good, F.col("trades_count"))).alias("trades"),
        F.sum(F.when(good, F.col("price_open"))).alias("opens"),
    )


@register(
    "rejected_records",
    """
SELECT l_orderkey, CAST(0 AS INTEGER) AS record_no, '7' AS record_text FROM lineitem GROUP BY l_orderkey
UNION ALL
SELECT l_orderkey, CAST(count(*) + 1 AS INTEGER), '{"price_open":' || sum(l_linenumber) || '}'
FROM lineitem GROUP BY l_orderkey
""",
)
def q_rejected_records(spark, sf_dir):
    # The bad elements of an array of bars per order: a number before its lines, an object
    # without times after them; with their places and texts.
    li = table(spark, sf_dir, "lineitem")
    record = F.struct(F.date_format("l_shipdate", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("time_period_start"))
    arrays = li.groupBy("l_orderkey").agg(
        F.array_join(F.collect_list(F.to_json(record)), ",").alias("records"), F.sum("l_linenumber").alias("lines")
    )
    untimed = F.concat(F.lit('{"price_open":'), F.col("lines").cast("string"), F.lit("}"))
    payload = F.concat(F.lit("[7,"), F.col("records"), F.lit(","), untimed, F.lit("]"))
    classified = classify_payloads(arrays.select("l_orderkey", payload.alias("payload")), expect="array")
    bars = parse_bars(classified, rejects=True)
    bad = F.coalesce("time_period_start", "time_open").isNull() & F.col("record_no").isNotNull()
    return bars.where(bad).select("l_orderkey", "record_no", "record_text")


@register(
    "parse_quoted_dump",
    """
SELECT l_orderkey, CAST(l_shipdate AS DATE) AS date, 'Line' AS field, CAST(l_linenumber AS VARCHAR) AS value
FROM lineitem
UNION ALL
SELECT l_orderkey, CAST(l_shipdate AS DATE), 'Qty__units', CAST(l_linenumber AS VARCHAR) || ',' || l_returnflag || '"'
FROM lineitem
""",
)
def q_parse_quoted_dump(spark, sf_dir):
    # One dump per order with a line per item: names and values with commas and quotes in
    # quotes, and a line with a field too many, which is left out.
    li = table(spark, sf_dir, "lineitem")
    line = F.concat_ws(
        ",",
        F.date_format("l_shipdate", "yyyy-MM-dd"),
        F.concat(F.lit('"'), F.col("l_linenumber").cast("string"), F.lit(","), F.col("l_returnflag"), F.lit('"""')),
        F.col("l_linenumber").cast("string"),
    )
    lines = li.groupBy("l_orderkey").agg(F.array_join(F.collect_list(line), "\n").alias("lines"))
    payload = F.concat(F.lit('Date,"Qty, units",Line\n'), F.col("lines"), F.lit("\n2000-01-01,1,2,3\n"))
    dumps = classify_payloads(lines.select("l_orderkey", payload.alias("payload")), expect="csv")
    return parse_table_dump(dumps).select("l_orderkey", "date", F.inline_outer("vals"))


@register(
    "parse_indicator_whole",
    """
SELECT event_id, CAST(CAST(ts AS DATE) AS TIMESTAMP) AS date, CAST(user_id AS DOUBLE) AS value FROM events
UNION ALL
SELECT event_id, CAST(CAST(ts AS DATE) + INTERVAL 1 DAY AS TIMESTAMP), CAST(NULL AS DOUBLE) FROM events
""",
)
def q_parse_indicator_whole(spark, sf_dir):
    # One payload per event without a data array: the object itself holds its columns.
    ev = table(spark, sf_dir, "events")
    days = F.array(F.date_format("ts", "yyyy-MM-dd"), F.date_format(F.date_add(F.to_date("ts"), 1), "yyyy-MM-dd"))
    payload = F.to_json(
        F.struct(days.alias("date"), F.array(F.col("user_id").cast("string"), F.lit(".")).alias("value"))
    )
    rows = parse_indicator(classify_payloads(ev.select("event_id", payload.alias("payload"))))
    return rows.select("event_id", "date", "value")


# --- other forms of the checks: text dates, known missing days, one series ------------------


@register(
    "date_bounds_text",
    """
SELECT o_orderpriority, min(CAST(o_orderdate AS DATE)) AS earliest, max(CAST(o_orderdate AS DATE)) AS latest
FROM orders GROUP BY o_orderpriority
""",
)
def q_date_bounds_text(spark, sf_dir):
    return date_bounds(_text_dates(spark, sf_dir), "day", ["o_orderpriority"])


def _text_dates(spark, sf_dir):
    """Orders with their date as text, and a second row of each with text that is no date."""
    orders = table(spark, sf_dir, "orders").select("o_orderpriority", "o_orderdate")
    days = F.array(F.date_format("o_orderdate", "yyyy-MM-dd"), F.lit("no date"))
    return orders.select("o_orderpriority", F.explode(days).alias("day"))


@register("missing_dates_text", _MISSING_ORDERS_SQL + "SELECT o_orderpriority, missing_date FROM missing")
def q_missing_dates_text(spark, sf_dir):
    return missing_dates(_text_dates(spark, sf_dir), "day", ["o_orderpriority"])


@register(
    "missing_dates_single",
    """
WITH obs AS (SELECT DISTINCT CAST(c_date AS DATE) AS d FROM (
  SELECT o_orderdate AS c_date FROM orders WHERE o_orderdate IS NOT NULL)),
cal AS (SELECT CAST(unnest(generate_series(CAST((SELECT min(d) FROM obs) AS TIMESTAMP),
  CAST((SELECT max(d) FROM obs) AS TIMESTAMP), INTERVAL 1 DAY)) AS DATE) AS d)
SELECT d AS missing_date FROM cal WHERE d NOT IN (SELECT d FROM obs)
""",
)
def q_missing_dates_single(spark, sf_dir):
    # Days without an order, all orders being one series (no keys).
    return missing_dates(table(spark, sf_dir, "orders"), "o_orderdate")


@register(
    "profile_series_known",
    ORACLE_SQL["profile_series"]
    .replace("CAST(0 AS BIGINT) AS known_missing", "k AS known_missing")
    .replace("max_date) + 2 AS BIGINT) AS expected_rows", "max_date) + 2 - k AS BIGINT) AS expected_rows")
    .replace("+ 2 - n_unique_rows AS", "+ 2 - k - n_unique_rows AS")
    .replace(
        "FROM p",
        """FROM (SELECT p.*, CAST(coalesce(x.k, 0) AS BIGINT) AS k FROM p LEFT JOIN (
  SELECT o_orderpriority, count(DISTINCT o_orderstatus) AS k FROM orders
  WHERE o_orderpriority < '3' GROUP BY 1) x ON x.o_orderpriority = p.o_orderpriority)""",
    ),
)
def q_profile_series_known(spark, sf_dir):
    # The known missing days of some series come as a table.
    orders = table(spark, sf_dir, "orders")
    known = orders.where("o_orderpriority < '3'").groupBy("o_orderpriority")
    known = known.agg(F.count_distinct("o_orderstatus").alias("known_missing"))
    return profile_series(orders, "o_orderdate", ["o_orderpriority"], known_missing=known)


@register(
    "ingest_plan_series",
    """
WITH l AS (SELECT o_custkey, CAST(max(o_orderdate) AS DATE) AS last_date FROM orders GROUP BY 1),
n AS (
  SELECT c_custkey AS o_custkey, last_date,
         CAST(coalesce(last_date + INTERVAL 1 DAY, DATE '1995-01-01' + CAST(c_nationkey AS INTEGER)) AS DATE) AS next_start,
         DATE '2001-08-02' AS end_date
  FROM customer LEFT JOIN l ON l.o_custkey = c_custkey)
SELECT *, coalesce(next_start < end_date, last_date IS NULL) AS due FROM n
""",
)
def q_ingest_plan_series(spark, sf_dir):
    # Customers are the series: those without a stored order start at a date of their own.
    orders = table(spark, sf_dir, "orders")
    first = F.date_add(F.lit(dt.date(1995, 1, 1)), F.col("c_nationkey").cast("int")).alias("first_day")
    series = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("o_custkey"), first)
    return ingest_plan(orders, "o_orderdate", ["o_custkey"], RUN_DATE, series=series, start_date="first_day")


# --- gaps as intervals, requests in ranges (J2, A9, S9) ---------------------------------------

_GAPS_SQL = """
WITH obs AS (
  SELECT DISTINCT o_custkey, CAST(o_orderdate AS DATE) AS d FROM orders WHERE o_orderdate IS NOT NULL),
n AS (SELECT o_custkey, d, lead(d) OVER (PARTITION BY o_custkey ORDER BY d) AS nd FROM obs),
gaps AS (
  SELECT o_custkey, CAST(d + INTERVAL 1 DAY AS DATE) AS gap_start, CAST(nd - INTERVAL 1 DAY AS DATE) AS gap_end,
         CAST(date_diff('day', d, nd) - 1 AS INTEGER) AS n_days
  FROM n WHERE date_diff('day', d, nd) > 1)
"""


@register("date_gaps", _GAPS_SQL + "SELECT o_custkey, gap_start, gap_end, n_days FROM gaps")
def q_date_gaps(spark, sf_dir):
    # Customers are the series: the stretches of days between their orders.
    return date_gaps(table(spark, sf_dir, "orders"), "o_orderdate", ["o_custkey"])


@register(
    "backfill_ranges",
    _GAPS_SQL
    + """,
parts AS (
  SELECT o_custkey, gap_end, CAST(gap_start + INTERVAL 100 DAY * k AS DATE) AS s
  FROM (SELECT *, unnest(range(0, CAST((n_days + 99) // 100 AS BIGINT))) AS k FROM gaps))
SELECT o_custkey, strftime(s, '%Y-%m-%d') AS start_date,
       strftime(least(CAST(s + INTERVAL 99 DAY AS DATE), gap_end), '%Y-%m-%d') AS end_date,
       CAST(date_diff('day', s, least(CAST(s + INTERVAL 99 DAY AS DATE), gap_end)) + 1 AS INTEGER) AS n_days
FROM parts
""",
)
def q_backfill_ranges(spark, sf_dir):
    # The requests that fetch these stretches, at most a hundred days each.
    gaps = date_gaps(table(spark, sf_dir, "orders"), "o_orderdate", ["o_custkey"])
    return backfill_ranges(gaps, ["o_custkey"])


# --- bounds from file footers (A1, A2, A7) ----------------------------------------------------


@register(
    "footer_bounds",
    """
SELECT 'orders' AS series, min(o_orderdate) AS earliest, max(o_orderdate) AS latest,
       count(*) AS n_rows, count(o_orderdate) AS n_dated FROM orders
UNION ALL
SELECT 'lineitem', min(l_shipdate), max(l_shipdate), count(*), count(l_shipdate) FROM lineitem
""",
)
def q_footer_bounds(spark, sf_dir):
    # Answered by the files' footers: no row is read.
    root = sf_dir.rstrip("/")
    parts = [
        footer_bounds(spark, f"{root}/{name}.parquet", day).select(F.lit(name).alias("series"), "*")
        for name, day in (("orders", "o_orderdate"), ("lineitem", "l_shipdate"))
    ]
    return parts[0].unionByName(parts[1])


# --- aligned features (I3) --------------------------------------------------------------------


@register(
    "align_features",
    """
WITH t AS (
  SELECT o_orderpriority, CAST(o_orderdate AS DATE) AS date, max(o_totalprice) AS target,
         CAST(count(o_totalprice) AS DOUBLE) AS n
  FROM orders WHERE o_orderdate IS NOT NULL GROUP BY ALL),
own AS (SELECT * FROM t WHERE target IS NOT NULL),
li AS (
  SELECT CAST(l_shipdate AS DATE) AS date, max(l_extendedprice) AS price, min(l_discount) AS discount
  FROM lineitem WHERE l_shipdate IS NOT NULL GROUP BY ALL)
SELECT a.o_orderpriority, a.date, a.target, p1.target AS price_lag1, p7.target AS price_lag7,
       c1.n AS orders_lag1, s1.price AS shipped_lag1, s30.price AS shipped_lag30, d2.discount AS discount_lag2
FROM own a
ASOF LEFT JOIN own p1 ON a.o_orderpriority IS NOT DISTINCT FROM p1.o_orderpriority AND a.date - 1 >= p1.date
ASOF LEFT JOIN own p7 ON a.o_orderpriority IS NOT DISTINCT FROM p7.o_orderpriority AND a.date - 7 >= p7.date
ASOF LEFT JOIN t c1 ON a.o_orderpriority IS NOT DISTINCT FROM c1.o_orderpriority AND a.date - 1 >= c1.date
ASOF LEFT JOIN li s1 ON a.date - 1 >= s1.date
ASOF LEFT JOIN li s30 ON a.date - 30 >= s30.date
ASOF LEFT JOIN li d2 ON a.date - 2 >= d2.date
""",
)
def q_align_features(spark, sf_dir):
    # A day's largest order per priority, with what was known before: the priority's own past
    # and the largest line shipped, a series of another table and grain for all priorities.
    orders, lines = table(spark, sf_dir, "orders"), table(spark, sf_dir, "lineitem")
    return align_features(
        Source(orders, "o_orderdate", "o_totalprice", "max"),
        {
            "price": Source(orders, "o_orderdate", "o_totalprice", "max", (1, 7)),
            "orders": Source(orders, "o_orderdate", "o_totalprice", "count"),
        },
        ["o_orderpriority"],
        shared={
            "shipped": Source(lines, "l_shipdate", "l_extendedprice", "max", (1, 30)),
            "discount": Source(lines, "l_shipdate", "l_discount", "min", (2,)),
        },
    )
