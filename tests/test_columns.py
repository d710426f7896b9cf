import datetime as dt

import pytest
from pyspark.sql import functions as F

from tidemark.functions.columns import (
    apply_types,
    clean_column_names,
    clean_name,
    join_nonempty,
    split_datetime,
    time_of_day,
    to_numeric,
    to_utc_ntz,
)

# Expected results of a coercing text-to-number parse (FIXTURES.md §4); None = missing.
NUMERIC_CASES = [
    ("1.5", 1.5),
    (".", None),
    ("", None),
    (" 2 ", 2.0),
    ("1e3", 1000.0),
    ("1,000", None),
    (None, None),
    ("0x1F", None),
    ("inf", float("inf")),
    ("-Infinity", float("-inf")),
    ("nan", None),
    ("1_000", None),
    ("+4", 4.0),
    ("4d", None),
    ("3f", None),
    ("0x1p3", None),
    ("1.", 1.0),
    (".5", 0.5),
    ("1e", None),
    ("\t3\t", 3.0),
]


def test_to_numeric_matches_coercing_parser(spark):
    df = spark.createDataFrame([(i, v) for i, (v, _) in enumerate(NUMERIC_CASES)], "i int, v string")
    got = {r.i: r.n for r in df.select("i", to_numeric("v").alias("n")).collect()}
    for i, (text, want) in enumerate(NUMERIC_CASES):
        assert got[i] == want, (text, got[i], want)


def test_split_datetime_bar_times(spark):
    df = spark.createDataFrame(
        [("2020-11-01T00:00:01.2500000Z", "2020-11-01T23:59:59.0000000Z", "2020-11-01T00:00:00.0000000Z")],
        "time_open string, time_close string, time_period_start string",
    )
    out = split_datetime(
        df,
        {
            "time_open": ("date_open", "time_open"),
            "time_close": ("date_close", "time_close"),
            "time_period_start": ("date_period_start", "time_period_start"),
        },
    ).first()
    assert out.time_open == "00:00:01.250000"
    assert out.time_close == "23:59:59"
    assert out.time_period_start == "00:00:00"
    assert out.date_open == dt.date(2020, 11, 1)


def test_utc_parse_ignores_session_zone(spark):
    df = spark.createDataFrame([("2020-11-01T23:30:00Z",), ("2020-11-01T23:30:00+02:00",), ("bad",), (None,)], "s string")
    before = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")
        rows = df.select(to_utc_ntz("s").alias("t")).collect()
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    assert rows[0].t == dt.datetime(2020, 11, 1, 23, 30)
    assert rows[1].t == dt.datetime(2020, 11, 1, 21, 30)
    assert rows[2].t is None and rows[3].t is None


def test_time_of_day_null(spark):
    df = spark.createDataFrame([(None,)], "t timestamp_ntz")
    assert df.select(time_of_day("t").alias("x")).first().x is None


def test_clean_column_names(spark):
    assert clean_name("1. open") == "1__open"
    assert clean_name("US$ (AM)") == "US___AM_"
    df = spark.createDataFrame([(1, 2)], "`1. open` int, `US$ (AM)` int")
    assert clean_column_names(df).columns == ["1__open", "US___AM_"]


def test_clean_column_names_collision_raises(spark):
    df = spark.createDataFrame([(1, 2)], "`a b` int, `a.b` int")
    with pytest.raises(ValueError):
        clean_column_names(df)


def test_apply_types_one_projection(spark):
    df = spark.createDataFrame(
        [("2020-11-01", "1.5", "7", "x"), ("bad", "4d", "x", "y")],
        "d string, p string, n string, keep string",
    )
    out = apply_types(df, {"d": "date", "p": "double", "n": "bigint"})
    assert out.columns == ["d", "p", "n", "keep"]
    rows = out.collect()
    assert rows[0] == (dt.date(2020, 11, 1), 1.5, 7, "x")
    assert rows[1] == (None, None, None, "y")
    with pytest.raises(ValueError):
        apply_types(df, {"nope": "date"})


def test_join_nonempty(spark):
    df = spark.createDataFrame([("n", "u"), ("", "u"), ("n", ""), ("", "")], "a string, b string")
    got = [r.c for r in df.select(join_nonempty(" - URL: ", "a", "b").alias("c")).collect()]
    assert got == ["n - URL: u", "u", "n", ""]


def test_no_python_udf_in_plans(spark):
    df = spark.createDataFrame([("1",)], "v string").select(to_numeric("v"), to_utc_ntz(F.col("v")))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PythonUDF" not in plan and "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan


def test_cluster_conf_sizes_shuffles():
    from tidemark.session import cluster_conf

    conf = cluster_conf(100 * (1 << 40))  # 100 TiB
    assert conf["spark.sql.shuffle.partitions"] == str(100 * (1 << 40) // (128 << 20))
    assert conf["spark.sql.adaptive.enabled"] == "true"
    assert cluster_conf(1 << 30)["spark.sql.shuffle.partitions"] == "200"


def test_zone_less_text_is_wall_clock(spark):
    df = spark.createDataFrame([("2024-01-02",), ("2024-01-02 10:00:00",), ("2024-01-02T10:00:00-05:00",)], "s string")
    before = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")
        got = [r.t for r in df.select(to_utc_ntz("s").alias("t")).collect()]
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    assert got == [dt.datetime(2024, 1, 2), dt.datetime(2024, 1, 2, 10), dt.datetime(2024, 1, 2, 15)]
