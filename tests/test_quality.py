import datetime as dt
import random

import pytest

from fixtures import bars_frame
from tidemark.operators.checks import check_not_null, check_unique, column_test_report
from tidemark.operators.dates import (
    DateCheckError,
    analyze_dates,
    date_bounds,
    duplicate_dates,
    missing_dates,
)
from tidemark.operators.rows import dedupe_rows, duplicate_row_count, profile_series

D = dt.date


def test_profile_series_fixture(spark):
    df = bars_frame(spark)
    p = profile_series(df, "date_period_start", ["series_id"]).first()
    assert (p.min_date, p.max_date) == (D(2020, 11, 1), D(2020, 11, 5))
    assert (p.n_rows, p.n_unique_rows) == (5, 4)
    assert (p.span_ref, p.calendar_days) == (6, 5)
    assert p.next_start == D(2020, 11, 6)
    assert (p.expected_rows, p.row_count_error) == (6, 2)
    p10 = profile_series(df, "date_period_start", ["series_id"], known_missing=10).first()
    assert (p10.expected_rows, p10.row_count_error) == (-4, -8)


def test_profile_series_known_missing_table(spark):
    df = bars_frame(spark, "a").unionByName(bars_frame(spark, "b"))
    km = spark.createDataFrame([("a", 10)], "series_id string, known_missing int")
    got = {r.series_id: r.row_count_error for r in profile_series(df, "date_period_start", ["series_id"], km).collect()}
    assert got == {"a": -8, "b": 2}


def test_copies_and_dedupe(spark):
    df = bars_frame(spark)
    c = duplicate_row_count(df).first()
    assert (c.n_rows, c.n_unique_rows, c.n_duplicate_rows) == (5, 4, 1)
    assert dedupe_rows(df).count() == 4


def test_null_and_nan_rows_collapse(spark):
    df = spark.createDataFrame([(None, float("nan")), (None, float("nan")), (1, 1.0)], "a int, b double")
    assert dedupe_rows(df).count() == 2
    assert duplicate_row_count(df).first().n_duplicate_rows == 1


def test_dates_fixture(spark):
    df = bars_frame(spark)
    missing = [r.missing_date for r in missing_dates(df, "date_period_start", ["series_id"]).orderBy("missing_date").collect()]
    assert missing == [D(2020, 11, 3), D(2020, 11, 4)]
    dup = [r.date for r in duplicate_dates(df, "date_period_start", ["series_id"]).orderBy("date").collect()]
    assert dup == [D(2020, 11, 2), D(2020, 11, 5)]
    dup_after = [r.date for r in duplicate_dates(dedupe_rows(df), "date_period_start", ["series_id"]).collect()]
    assert dup_after == [D(2020, 11, 5)]
    b = date_bounds(df, "date_period_start", ["series_id"]).first()
    assert (b.earliest, b.latest) == (D(2020, 11, 1), D(2020, 11, 5))


def test_analyze_dates_ordered(spark):
    days = [("b", "2024-01-05"), ("b", "2024-01-01"), ("a", "2024-01-03"), ("a", "2024-01-01"), ("b", "2024-01-01"), ("a", "2024-01-03")]
    df = spark.createDataFrame(days, "s string, d string").repartition(4, "d")
    rep = analyze_dates(df, "d", ["s"], ordered=True)
    assert [r.s for r in rep.bounds.collect()] == ["a", "b"]
    assert [(r.s, r.missing_date.day) for r in rep.missing.collect()] == [("a", 2), ("b", 2), ("b", 3), ("b", 4)]
    assert [(r.s, r.date.day, r.n_rows) for r in rep.duplicated.collect()] == [("a", 3, 2), ("b", 1, 2)]
    with pytest.raises(ValueError):
        analyze_dates(df, "d", ["s"], on_violation="raise", ordered=True)


def test_analyze_dates_empty_and_raise(spark):
    empty = spark.createDataFrame([], "series_id string, d date")
    rep = analyze_dates(empty, "d", ["series_id"], on_violation="raise")
    assert rep.missing.count() == 0 and rep.duplicated.count() == 0
    with pytest.raises(DateCheckError):
        analyze_dates(bars_frame(spark), "date_period_start", ["series_id"], on_violation="raise")


@pytest.mark.parametrize("method", ["gaps", "calendar"])
def test_missing_dates_null_series_and_text_dates(spark, method):
    df = spark.createDataFrame(
        [(None, "2020-01-01"), (None, "2020-01-03"), ("x", "2020-01-01"), ("x", "junk")],
        "k string, d string",
    )
    got = sorted((r.k, r.missing_date) for r in missing_dates(df, "d", ["k"], method=method).collect())
    assert got == [(None, D(2020, 1, 2))]


@pytest.mark.parametrize("method", ["gaps", "calendar"])
def test_weekday_calendar(spark, method):
    df = spark.createDataFrame([(D(2024, 1, 5),), (D(2024, 1, 10),)], "d date")  # Fri .. Wed
    got = [r.missing_date for r in missing_dates(df, "d", weekdays_only=True, method=method).orderBy("missing_date").collect()]
    assert got == [D(2024, 1, 8), D(2024, 1, 9)]


@pytest.mark.parametrize("method", ["gaps", "calendar"])
def test_long_range_calendar_spread(spark, method):
    # More than one calendar chunk and a single row per end: 400 days, 398 missing.
    df = spark.createDataFrame([("s", D(2020, 1, 1)), ("s", D(2021, 2, 4))], "k string, d date")
    assert missing_dates(df, "d", ["k"], method=method).count() == (D(2021, 2, 4) - D(2020, 1, 1)).days - 1


@pytest.mark.parametrize("method", ["gaps", "calendar"])
def test_random_dates_against_plain_python(spark, method):
    rng = random.Random(7)
    rows = []
    for s in ["a", "b", "c"]:
        start = D(2021, 1, 1) + dt.timedelta(days=rng.randrange(30))
        for _ in range(rng.randrange(5, 60)):
            rows.append((s, start + dt.timedelta(days=rng.randrange(120))))
    df = spark.createDataFrame(rows, "k string, d date")
    want_missing, want_dup = set(), set()
    for s in {r[0] for r in rows}:
        ds = [r[1] for r in rows if r[0] == s]
        lo, hi = min(ds), max(ds)
        cal = {lo + dt.timedelta(days=i) for i in range((hi - lo).days + 1)}
        want_missing |= {(s, d) for d in cal - set(ds)}
        want_dup |= {(s, d) for d in set(ds) if ds.count(d) > 1}
    got_missing = {(r.k, r.missing_date) for r in missing_dates(df, "d", ["k"], method=method).collect()}
    got_dup = {(r.k, r.date) for r in duplicate_dates(df, "d", ["k"]).collect()}
    assert got_missing == want_missing
    assert got_dup == want_dup


def test_column_tests_reference_models(spark):
    first = spark.sql("select 1 as id union all select null as id")
    second = first.where("id = 1")
    assert check_unique(first, "id").count() == 0
    assert check_not_null(first, "id").count() == 1
    assert check_unique(second, "id").count() == 0
    assert check_not_null(second, "id").count() == 0
    rep = {(r.test, r.n_failing, r.passed) for r in column_test_report(first, [("id", "unique"), ("id", "not_null")]).collect()}
    assert rep == {("unique", 0, True), ("not_null", 1, False)}


def test_missing_dates_plan_is_anti_join_on_series_and_date(spark):
    df = bars_frame(spark)
    plan = missing_dates(df, "date_period_start", ["series_id"], method="calendar")._jdf.queryExecution().executedPlan().toString()
    assert "LeftAnti" in plan
    assert "PythonUDF" not in plan


def test_duplicate_dates_partial_aggregate(spark):
    df = bars_frame(spark)
    plan = duplicate_dates(df, "date_period_start", ["series_id"])._jdf.queryExecution().executedPlan().toString()
    assert "partial_count" in plan


def test_missing_column_is_named(spark):
    df = bars_frame(spark)
    with pytest.raises(ValueError, match="date"):
        missing_dates(df, "date", ["series_id"])
    with pytest.raises(ValueError, match="nope"):
        profile_series(df, "date_period_start", ["nope"])


def test_fill_daily_linear_and_ffill(spark):
    from tidemark.operators.fill import fill_daily

    df = spark.createDataFrame(
        [("m", D(2024, 1, 1), 1.0), ("m", D(2024, 1, 5), 5.0), ("m", D(2024, 1, 5), 5.0), ("q", D(2024, 1, 1), 2.0)],
        "k string, d date, v double",
    )
    rows = fill_daily(df, "d", "v", ["k"]).orderBy("k", "date").collect()
    m = [(r.date.day, r.value, r.value_ffill, r.value_linear) for r in rows if r.k == "m"]
    assert m == [(1, 1.0, 1.0, 1.0), (2, None, 1.0, 2.0), (3, None, 1.0, 3.0), (4, None, 1.0, 4.0), (5, 5.0, 5.0, 5.0)]
    assert [(r.date.day, r.value_linear) for r in rows if r.k == "q"] == [(1, 2.0)]


def test_profile_against_plain_python_random(spark):
    rng = random.Random(11)
    rows = []
    for s in ["a", "b", None]:
        for _ in range(rng.randrange(3, 40)):
            day = D(2022, 3, 1) + dt.timedelta(days=rng.randrange(50))
            row = (s, day, float(rng.randrange(3)), rng.choice([None, "x", "y"]))
            rows.append(row)
            if rng.random() < 0.3:
                rows.append(row)  # whole-row copy
    df = spark.createDataFrame(rows, "k string, d date, v double, t string")
    got = {r.k: r for r in profile_series(df, "d", ["k"], known_missing=3).collect()}
    copies = {r.k: r for r in duplicate_row_count(df, ["k"]).collect()}
    for s in {r[0] for r in rows}:
        mine = [r for r in rows if r[0] == s]
        lo, hi = min(r[1] for r in mine), max(r[1] for r in mine)
        unique = len(set(mine))
        p = got[s]
        assert (p.min_date, p.max_date, p.n_rows, p.n_unique_rows) == (lo, hi, len(mine), unique)
        assert p.span_ref == (hi - lo).days + 2 and p.calendar_days == (hi - lo).days + 1
        assert p.row_count_error == (hi - lo).days + 2 - 3 - unique
        assert p.next_start == hi + dt.timedelta(days=1)
        assert copies[s].n_duplicate_rows == len(mine) - unique


def test_series_report_counts_gaps_and_duplicates(spark):
    from tidemark.plans.run import series_report

    df = spark.createDataFrame(
        [("s", D(2024, 1, 1), 1), ("s", D(2024, 1, 1), 2), ("s", D(2024, 1, 4), 3), ("s", None, 4), ("s", None, 5),
         ("t", D(2024, 1, 1), 1), ("t", D(2024, 1, 1), 1)],
        "k string, d date, v int",
    )
    got = {r.k: (r.n_rows, r.n_unique_rows, r.n_missing_days, r.n_duplicate_dates) for r in series_report(df, "d", ["k"]).collect()}
    assert got == {"s": (5, 5, 2, 1), "t": (2, 1, 0, 1)}  # copies on one day make it duplicated
    one = series_report(df.where("k = 's'"), "d", []).first()
    assert (one.n_missing_days, one.n_duplicate_dates) == (2, 1)


def test_hot_series_results_and_plan(spark):
    """One series holds most rows (with many copies); results match plain Python and the
    first shuffle of the calendar checks is keyed by series and day together."""
    from tidemark.plans.run import series_report

    rng = random.Random(3)
    rows = [("hot", D(2024, 1, 1) + dt.timedelta(days=rng.randrange(40)), rng.randrange(3)) for _ in range(6000)]
    rows += [("cold", D(2024, 1, 1) + dt.timedelta(days=d), 0) for d in (0, 2, 2, 9)]
    df = spark.createDataFrame(rows, "k string, d date, v int").repartition(8)
    want = {}
    for s in ("hot", "cold"):
        ds = [r[1] for r in rows if r[0] == s]
        lo, hi = min(ds), max(ds)
        missing = {lo + dt.timedelta(days=i) for i in range((hi - lo).days + 1)} - set(ds)
        dups = {d for d in set(ds) if ds.count(d) > 1}
        uniq = len({r for r in rows if r[0] == s})
        want[s] = (len(ds), uniq, len(missing), len(dups))
    got = {r.k: (r.n_rows, r.n_unique_rows, r.n_missing_days, r.n_duplicate_dates) for r in series_report(df, "d", ["k"]).collect()}
    assert got == want
    plan = duplicate_dates(df, "d", ["k"])._jdf.queryExecution().executedPlan().toString()
    first = [line for line in plan.splitlines() if "Exchange hashpartitioning(" in line][-1]
    keys = first.split("hashpartitioning(")[1].split(")")[0].split(", ")[:-1]
    assert len(keys) == 2 and keys[0].startswith("k#"), first  # (series, day), not series alone
