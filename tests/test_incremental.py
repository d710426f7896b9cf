import datetime as dt

from fixtures import bars_frame
from tidemark.operators.dates import missing_dates
from tidemark.operators.incremental import (
    after_high_water_mark,
    apply_backfill,
    backfill_plan,
    due_sources,
    gate_by_weekday,
    ingest_plan,
)
from tidemark.sources.catalog import schedule, source_catalog, with_comments

D = dt.date


def test_ingest_plan_fixture(spark):
    df = bars_frame(spark)
    p = ingest_plan(df, "date_period_start", ["series_id"], "2020-11-06").first()
    assert p.next_start == D(2020, 11, 6) and p.due is False
    p = ingest_plan(df, "date_period_start", ["series_id"], D(2020, 11, 9)).first()
    assert (p.next_start, p.end_date, p.due) == (D(2020, 11, 6), D(2020, 11, 9), True)


def test_ingest_plan_first_load_uses_start_date(spark):
    df = bars_frame(spark)
    series = spark.createDataFrame([("btc_usd_daily_price",), ("eth_usd_daily_price",)], "series_id string")
    got = {r.series_id: (r.next_start, r.due) for r in ingest_plan(df, "date_period_start", ["series_id"], "2020-11-09", series=series).collect()}
    assert got["eth_usd_daily_price"] == (D(2020, 11, 1), True)
    assert got["btc_usd_daily_price"] == (D(2020, 11, 6), True)


def test_after_high_water_mark(spark):
    df = bars_frame(spark)
    stored = df.where("date_period_start <= date'2020-11-02'")
    out = after_high_water_mark(df, stored, "date_period_start", ["series_id"])
    assert sorted(r.trades_count for r in out.collect()) == [7, 8]
    # idempotent, and a series not stored keeps everything
    assert after_high_water_mark(out, stored, "date_period_start", ["series_id"]).count() == 2
    other = bars_frame(spark, "eth")
    assert after_high_water_mark(other, stored, "date_period_start", ["series_id"]).count() == 5
    # single series: scalar mark; an empty table lets everything through
    assert after_high_water_mark(df, stored, "date_period_start").count() == 2
    assert after_high_water_mark(df, stored.limit(0), "date_period_start").count() == 5


def test_due_sources_schedule(spark):
    cat = source_catalog(spark)
    assert cat.count() == 36
    monday = due_sources(cat, schedule(spark), D(2024, 1, 1))
    tuesday = due_sources(cat, schedule(spark), D(2024, 1, 2))
    rows_mon = {r.series_id: r.grp for r in monday.collect()}
    rows_tue = {r.series_id: r.grp for r in tuesday.collect()}
    assert set(rows_mon.values()) <= {"A", None} and "corn" in rows_mon and "coffee" not in rows_mon
    assert set(rows_tue.values()) <= {"B", None} and "coffee" in rows_tue
    # ungrouped series (bars, table dumps) are due every day
    assert "btc_usd_daily_price" in rows_mon and "lbma_gold" in rows_tue
    assert len(rows_mon) + len(rows_tue) == 24 + 2 * 12


def test_gate_by_weekday_unknown_group(spark):
    df = spark.createDataFrame([(D(2024, 1, 1), "Z"), (D(2024, 1, 1), None)], "d date, g string")
    got = [(r.weekday, r.due) for r in gate_by_weekday(df, "d", "g", schedule(spark)).orderBy("g").collect()]
    assert sorted(got, key=str) == sorted([(0, False), (0, True)], key=str)


def test_catalog_comments(spark):
    rows = {r.series_id: r.comment for r in with_comments(source_catalog(spark)).collect()}
    assert rows["fred_gdp"] == ""
    assert rows["lbma_gold"].endswith(" - URL: https://data.nasdaq.com/data/LBMA/documentation")
    assert rows["spy"] == "Alpha Vantage - SPDR S&P 500 ETF Trust"


def test_backfill(spark):
    df = bars_frame(spark)
    plan = backfill_plan(missing_dates(df, "date_period_start", ["series_id"]), ["series_id"])
    assert sorted((r.start_date, r.end_date) for r in plan.collect()) == [
        ("2020-11-03", "2020-11-03"),
        ("2020-11-04", "2020-11-04"),
    ]
    landed = spark.createDataFrame(
        [("btc_usd_daily_price", D(2020, 11, 3), 1.0, 1), ("btc_usd_daily_price", D(2020, 11, 5), 1.0, 1)],
        df.schema,
    )
    kept = apply_backfill(df, landed, "date_period_start", ["series_id"]).collect()
    assert [r.date_period_start for r in kept] == [D(2020, 11, 3)]


def test_interval_violations_only_cpi(spark):
    from tidemark.sources.catalog import interval_violations

    bad = interval_violations(source_catalog(spark)).collect()
    assert [(r.series_id, r.interval, sorted(r.allowed_intervals)) for r in bad] == [
        ("cpi", "daily", ["monthly", "semiannual"])
    ]


def test_ingest_plan_over_catalogue_start_dates(spark):
    stored = bars_frame(spark)  # only btc is stored
    cat = source_catalog(spark).select("series_id", "start_date")
    plan = {r.series_id: (r.next_start, r.due) for r in ingest_plan(
        stored, "date_period_start", ["series_id"], "2020-11-09", series=cat, start_date="start_date"
    ).collect()}
    assert len(plan) == 36
    assert plan["btc_usd_daily_price"] == (D(2020, 11, 6), True)
    assert plan["eth_usd_daily_price"] == (D(2020, 11, 1), True)  # configured first date
    assert plan["corn"] == (None, True)  # full history on the first load
    assert plan["lbma_gold"] == (D(2020, 11, 1), True)


def test_symbol_id_matches_catalogue(spark):
    from pyspark.sql import functions as F

    from tidemark.sources.catalog import symbol_id

    df = spark.createDataFrame([("COINBASE", "BTC", "USD")], "ex string, asset string, cur string")
    got = df.select(symbol_id(F.col("ex"), F.col("asset"), F.col("cur")).alias("s")).first().s
    cat = {r.series_id: r.symbol for r in source_catalog(spark).collect()}
    assert got == cat["btc_usd_daily_price"] == "COINBASE_SPOT_BTC_USD"
