"""Aligned features, the price model, gaps as intervals, range requests, footer bounds."""

import datetime as dt
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.operators.align import Source, align_features
from tidemark.operators.dates import date_gaps, missing_dates
from tidemark.operators.incremental import backfill_ranges
from tidemark.plans.price_model import fit_price_model, time_split
from tidemark.plans.tables import append_table, create_table
from tidemark.sources.footers import footer_bounds, table_bounds, table_location

D = dt.date
DAY = dt.timedelta(days=1)


def as_of(rows, day, lag):
    """The value of the last (date, value) at least ``lag`` days before ``day``."""
    known = [(d, v) for d, v in rows if d <= day - lag * DAY and v is not None]
    return max(known)[1] if known else None


def test_features_are_the_last_values_before_the_day(spark):
    rng = random.Random(4)
    start = D(2021, 1, 1)
    target = [(s, start + i * DAY, float(rng.randrange(1000))) for s in ("a", "b", None) for i in range(60) if rng.random() < 0.7]
    own = [(s, start + i * DAY, float(rng.randrange(1000)) if rng.random() < 0.8 else None) for s in ("a", None) for i in range(-20, 60, 9)]
    macro = [(start + i * DAY, float(i)) for i in range(-40, 60, 30)]
    frame = lambda rows, cols: spark.createDataFrame(rows, cols)
    got = align_features(
        Source(frame(target, "s string, d date, v double"), "d", "v"),
        {"own": Source(frame(own, "s string, day date, x double"), "day", "x", "max", (1, 10)),
         "past": Source(frame(target, "s string, d date, v double"), "d", "v", lags=(2,))},
        ["s"],
        shared={"macro": Source(frame(macro, "m date, v double"), "m", "v", lags=(1, 31))},
    )
    assert got.columns == ["s", "date", "target", "own_lag1", "own_lag10", "past_lag2", "macro_lag1", "macro_lag31"]
    series = lambda rows, s: [(d, v) for k, d, v in rows if k == s]
    want = {
        (s, d): (v, as_of(series(own, s), d, 1), as_of(series(own, s), d, 10), as_of(series(target, s), d, 2),
                 as_of(macro, d, 1), as_of(macro, d, 31))
        for s, d, v in target
    }
    assert {(r["s"], r["date"]): tuple(r)[2:] for r in got.collect()} == want


def test_features_without_keys_without_rows_and_refusals(spark):
    rows = spark.createDataFrame([(D(2021, 1, 1), 1.0), (D(2021, 1, 4), 2.0), (None, 9.0), (D(2021, 1, 5), None)], "d date, v double")
    past = Source(rows, "d", "v", lags=(1, 3))
    got = align_features(Source(rows, "d", "v"), {"p": past}).orderBy("date").collect()
    assert [tuple(r) for r in got] == [(D(2021, 1, 1), 1.0, None, None), (D(2021, 1, 4), 2.0, 1.0, 1.0)]
    assert align_features(Source(rows.limit(0), "d", "v"), {"p": past}, shared={"q": past}).collect() == []
    assert [r["date"] for r in align_features(Source(rows, "d", "v"), {}).orderBy("date").collect()] == [D(2021, 1, 1), D(2021, 1, 4)]
    with pytest.raises(ValueError, match="lags"):
        align_features(Source(rows, "d", "v"), {"p": Source(rows, "d", "v", lags=(0,))})
    with pytest.raises(ValueError, match="clash"):
        align_features(Source(rows, "d", "v"), {"p": past}, shared={"p": past})
    with pytest.raises(ValueError, match="no column"):
        align_features(Source(rows, "d", "v"), {"p": Source(rows, "d", "nope")})


def test_split_keeps_days_whole_and_in_time(spark):
    rows = spark.createDataFrame([(D(2021, 1, 1) + (i % 10) * DAY, i) for i in range(100)] + [(None, 7)], "date date, i int")
    earlier, later = time_split(rows, held_out=0.3)
    assert {r["date"].day for r in earlier.collect()} == set(range(1, 8))
    assert {r["date"].day for r in later.collect()} == {8, 9, 10}
    assert earlier.count() + later.count() == 100
    with pytest.raises(ValueError):
        time_split(rows, held_out=1)


def test_price_model_is_least_squares_on_the_earlier_days(spark):
    rng = np.random.default_rng(1)
    x = rng.standard_normal((200, 2))
    y = 3 * x[:, 0] - 2 * x[:, 1] + 5 + rng.standard_normal(200) * 0.1
    rows = [(D(2021, 1, 1) + i * DAY, float(y[i]), float(x[i, 0]), float(x[i, 1])) for i in range(200)]
    rows.append((D(2021, 3, 1), 1e9, None, 0.0))  # incomplete
    frame = spark.createDataFrame(rows, "date date, target double, u double, w double").repartition(5)
    model = fit_price_model(frame, ["u", "w"], naive="u")
    cut = 160
    a = np.column_stack([x, np.ones(200)])
    want = np.linalg.lstsq(a[:cut], y[:cut], rcond=None)[0]
    assert [model.coefficients["u"], model.coefficients["w"], model.intercept] == pytest.approx(want, rel=1e-6)
    gap = y[cut:] - a[cut:] @ want
    assert model.metrics["n"] == 40
    assert model.metrics["rmse"] == pytest.approx(np.sqrt((gap**2).mean()), rel=1e-6)
    assert model.metrics["mae"] == pytest.approx(np.abs(gap).mean(), rel=1e-6)
    assert model.metrics["r2"] == pytest.approx(1 - (gap**2).mean() / y[cut:].var(), rel=1e-6)
    assert model.metrics["naive_rmse"] == pytest.approx(np.sqrt(((y[cut:] - x[cut:, 0]) ** 2).mean()), rel=1e-9)
    predicted = {r["date"]: r["prediction"] for r in model.predict(frame).collect()}
    assert len(predicted) == 200 and predicted[D(2021, 1, 1)] == pytest.approx(a[0] @ want)
    with pytest.raises(ValueError, match="no complete rows"):
        fit_price_model(frame.limit(0), ["u", "w"])


def test_model_of_given_orders_beats_no_information(spark):
    orders = spark.read.parquet("/root/testdata/sf0.01/orders.parquet")
    lines = spark.read.parquet("/root/testdata/sf0.01/lineitem.parquet")
    rows = align_features(
        Source(orders, "o_orderdate", "o_totalprice", "avg"),
        {"past": Source(orders, "o_orderdate", "o_totalprice", "avg", (1, 7))},
        shared={"shipped": Source(lines, "l_shipdate", "l_extendedprice", "avg")},
    )
    model = fit_price_model(rows, ["past_lag1", "past_lag7", "shipped_lag1"], naive="past_lag1")
    assert model.metrics["n"] > 400 and model.metrics["rmse"] < model.metrics["naive_rmse"]


def test_gaps_are_the_missing_days(spark):
    rng = random.Random(2)
    rows = [(s, D(2020, 1, 1) + rng.randrange(900) * DAY) for s in ("a", "b", None) for _ in range(40)] + [("c", None), ("d", D(2020, 1, 1))]
    frame = spark.createDataFrame(rows, "s string, d date")
    gaps = [tuple(r) for r in date_gaps(frame, "d", ["s"]).collect()]
    assert all((e - b).days + 1 == n for _, b, e, n in gaps)
    listed = sorted(((s, b + i * DAY) for s, b, _, n in gaps for i in range(n)), key=repr)
    assert listed == sorted((tuple(r) for r in missing_dates(frame, "d", ["s"]).collect()), key=repr)
    whole = [tuple(r) for r in date_gaps(frame, "d").collect()]
    assert sum(n for _, _, n in whole) == missing_dates(frame, "d").count()
    assert date_gaps(frame.limit(0), "d", ["s"]).collect() == []


@pytest.mark.parametrize("most", [1, 7, 100])
def test_every_missing_day_is_in_one_range(spark, most):
    gaps = [("a", D(2020, 1, 1), D(2020, 1, 1)), ("a", D(2020, 2, 1), D(2020, 2, 7)), (None, D(2020, 1, 1), D(2021, 1, 8)), ("b", D(2020, 3, 2), D(2020, 3, 1))]
    got = backfill_ranges(spark.createDataFrame(gaps, "s string, gap_start date, gap_end date"), ["s"], most).collect()
    days = []
    for r in got:
        start, end = D.fromisoformat(r["start_date"]), D.fromisoformat(r["end_date"])
        assert 1 <= r["n_days"] <= most and (end - start).days + 1 == r["n_days"]
        days += [(r["s"], start + i * DAY) for i in range(r["n_days"])]
    want = [(s, b + i * DAY) for s, b, e in gaps for i in range((e - b).days + 1)]
    assert sorted(days, key=repr) == sorted(want, key=repr)
    assert len(got) == sum(-(-((e - b).days + 1) // most) for _, b, e in gaps[:3])


def test_backfill_ranges_refusals(spark):
    with pytest.raises(ValueError, match="max_days"):
        backfill_ranges(spark.createDataFrame([], "gap_start date, gap_end date"), max_days=0)
    with pytest.raises(ValueError, match="no column"):
        backfill_ranges(spark.createDataFrame([], "gap_start date"))


def test_footers_answer_without_reading_rows(spark, fresh_db):
    rows = [("a", D(2020, 1, 1), 1.5), ("a", D(2020, 3, 1), None), ("b", D(1969, 5, 5), 2.0), ("b", None, 2.0), ("b", D(1960, 1, 1), 2.0), ("c", D(2021, 1, 1), 1.0)]
    create_table(spark.createDataFrame(rows[:3], "series_id string, d date, v double").coalesce(1), "t", partition_by=["series_id"])
    append_table(spark.createDataFrame(rows[3:], "series_id string, d date, v double").coalesce(1), "t")
    got = table_bounds(spark, "t", "d")
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "PushedAggregation: [MIN(d), MAX(d), COUNT(*), COUNT(d)]" in plan and "PushedGroupBy: [series_id]" in plan
    assert {tuple(r) for r in got.collect()} == {
        ("a", D(2020, 1, 1), D(2020, 3, 1), 2, 2), ("b", D(1960, 1, 1), D(1969, 5, 5), 3, 2), ("c", D(2021, 1, 1), D(2021, 1, 1), 1, 1),
    }
    path = table_location(spark, "t")
    assert footer_bounds(spark, path, "v").first()["latest"] == 2.0
    with pytest.raises(ValueError, match="string"):
        footer_bounds(spark, "/root/testdata/sf0.001/orders.parquet", "o_orderpriority")


@pytest.mark.parametrize("zone", ["UTC", "America/New_York"])
def test_footer_bounds_of_timestamps(spark, tmp_dir, zone):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        stamps = ["2020-01-01 00:00:00.000001", "1950-06-01 12:30:00.25", "2024-02-29 23:59:59.999999"]
        frame = spark.createDataFrame([(i, s) for i, s in enumerate(stamps)], "i int, s string")
        frame = frame.select("i", F.col("s").cast("timestamp_ntz").alias("n"))
        frame.write.parquet(tmp_dir + "/p")
        want = spark.read.parquet(tmp_dir + "/p").agg(F.min("n"), F.max("n")).first()
        assert tuple(footer_bounds(spark, tmp_dir + "/p", "n").first()) == (*want, 3, 3)
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
