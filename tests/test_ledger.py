"""The ledger beside a table: marks, gaps, loads written once, duplicate checks, backfill leg."""

import datetime as dt
import os
import random

import pytest
from pyspark.sql import functions as F

import tidemark.plans.load as load_module
from fixtures import bar_records, write_json
from tidemark.operators.dates import date_gaps, missing_dates
from tidemark.operators.rows import profile_series
from tidemark.plans.ledger import Ledger
from tidemark.plans.load import dedupe_table, load_increment, load_landed, new_rows, suspects
from tidemark.plans.run import backfill_requests, daily_run
from tidemark.plans.tables import append_table, create_table, table_exists
from tidemark.streaming.landing_stream import start_landing_stream

SCHEMA = "series_id string, date date, v int"
START = dt.date(2024, 1, 1)
DAY = dt.timedelta(days=1)


def frame(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def stored(spark, table="t"):
    spark.catalog.refreshTable(table)
    return sorted((tuple(r) for r in spark.table(table).select("series_id", "date", "v").collect()), key=repr)


def assert_ledger_is_true(spark, table="t"):
    """Marks and gaps of the ledger are those of the whole table."""
    ledger = Ledger(spark, table, "date")
    spark.catalog.refreshTable(table)
    rows = spark.table(table)
    want = profile_series(rows, "date", ["series_id"]).select("series_id", "min_date", "max_date", "n_rows")
    got = ledger.marks().select("series_id", "min_date", "max_date", "n_rows")
    key = lambda f: sorted((tuple(r) for r in f.collect()), key=repr)
    assert key(got) == key(want)
    assert key(ledger.gaps()) == key(date_gaps(rows, "date", ["series_id"]))


def batch(rng, top):
    rows = []
    for s in rng.sample(["a", "b", "c", None], rng.randrange(1, 4)):
        for _ in range(rng.randrange(1, 6)):
            rows.append((s, START + rng.randrange(top) * DAY, rng.randrange(3)))
    return rows + rows[:1]


def expected_after(held, rows, mode):
    """What a load makes of the stored rows, in plain Python."""
    marks, days = {}, set()
    for s, d, _ in held:
        marks[s] = max(marks.get(s, d), d)
        days.add((s, d))
    fits = (lambda s, d: s not in marks or d > marks[s]) if mode == "increment" else (lambda s, d: (s, d) not in days)
    return sorted(held + list({r for r in rows if fits(r[0], r[1])}), key=repr)


class Crash(RuntimeError):
    pass


CRASHES = ["append_table", "_days_entries", "_close"]


def crash_once(monkeypatch, where):
    """Let the next load stop before it appends, after it appended, or before it is closed."""
    def stop(*_, **__):
        raise Crash(where)

    if where == "append_table":
        monkeypatch.setattr(load_module, "append_table", stop)
    else:
        monkeypatch.setattr(Ledger, where, stop)


def test_ledger_equals_the_table_after_random_loads_and_crashes(spark, fresh_db, monkeypatch):
    rng = random.Random(11)
    held = []
    for turn in range(20):
        rows, mode = batch(rng, 4 + 3 * turn), "backfill" if turn % 4 == 3 else "increment"
        if turn in (5, 7, 14):
            rows.append(("a", START + (4 + 3 * turn) * DAY, 0))  # something to write
            with monkeypatch.context() as m:
                crash_once(m, CRASHES[(5, 7, 14).index(turn)])
                with pytest.raises(Crash):
                    load_increment(frame(spark, rows), "t", "date", mode=mode)
            held = expected_after(held, rows, mode)  # the next load finishes it
            continue
        metrics = load_increment(frame(spark, rows), "t", "date", mode=mode)
        after = expected_after(held, rows, mode)
        assert metrics["rows"] == len(after) - len(held)
        held = after
        if turn % 5 == 0:
            assert stored(spark) == held
    assert stored(spark) == held
    assert_ledger_is_true(spark)


def test_a_load_reads_no_row_of_the_table(spark, fresh_db):
    load_increment(frame(spark, [("a", START, 1), ("b", START, 2)]), "t", "date")
    place = [r.data_type for r in spark.sql("DESCRIBE EXTENDED t").where("col_name = 'Location'").collect()][0]
    for mode in ("increment", "backfill"):
        new = new_rows(frame(spark, [("a", START + DAY, 1)]), Ledger(spark, "t", "date"), mode)
        files = [f.rstrip("/") for f in new.inputFiles()]
        assert files and not any(f.startswith(place.rstrip("/") + "/") for f in files)
        assert new.count() == 1


@pytest.mark.parametrize("where", CRASHES)
def test_an_interrupted_batch_is_written_once(spark, fresh_db, monkeypatch, where):
    load_increment(frame(spark, [("a", START, 1)]), "t", "date", load_id="q/0")
    rows = [("a", START + DAY, 1), ("a", START + 2 * DAY, 2), ("b", START, 3), (None, START, 4)]
    with monkeypatch.context() as m:
        crash_once(m, where)
        with pytest.raises(Crash):
            load_increment(frame(spark, rows), "t", "date", load_id="q/1")
    metrics = load_increment(frame(spark, rows), "t", "date", load_id="q/1")  # the batch is replayed
    assert metrics == {"action": "appended", "rows": 4, "min_date": START, "max_date": START + 2 * DAY}
    assert load_increment(frame(spark, rows), "t", "date", load_id="q/1") == metrics
    assert stored(spark) == sorted([("a", START, 1), *rows], key=repr)
    closed = Ledger(spark, "t", "date").rows().where("kind = 'close' and load_id = 'q/1'")
    assert closed.count() == 1
    assert_ledger_is_true(spark)


def test_an_append_that_stopped_half_way_is_completed(spark, fresh_db, monkeypatch):
    """Some files of the job were there already, with days after days that were not."""
    load_increment(frame(spark, [("a", START, 1)]), "t", "date")
    rows = [("a", START + i * DAY, i) for i in range(1, 6)]

    def half(part, table):
        append_table(part.where("v in (2, 5)"), table)
        raise Crash

    with monkeypatch.context() as m:
        m.setattr(load_module, "append_table", half)
        with pytest.raises(Crash):
            load_increment(frame(spark, rows), "t", "date")
    assert load_increment(frame(spark, []), "t", "date")["rows"] == 0
    assert stored(spark) == [("a", START, 1), *rows]
    assert_ledger_is_true(spark)


def test_first_load_that_stopped_is_repeated(spark, fresh_db, monkeypatch):
    rows = [("a", START, 1)]
    with monkeypatch.context() as m:
        m.setattr(load_module, "create_table", lambda *_, **__: (_ for _ in ()).throw(Crash()))
        with pytest.raises(Crash):
            load_increment(frame(spark, rows), "t", "date", load_id="q/0")
    assert load_increment(frame(spark, rows), "t", "date", load_id="q/0")["action"] == "created"
    assert stored(spark) == rows
    assert_ledger_is_true(spark)


def test_tables_made_elsewhere_dropped_and_empty(spark, fresh_db):
    create_table(frame(spark, [("a", START, 1), (None, START + 9 * DAY, 1)]), "t", partition_by=["series_id"])
    assert load_increment(frame(spark, [("a", START, 9), ("a", START + 5 * DAY, 9)]), "t", "date")["rows"] == 1
    assert_ledger_is_true(spark)
    append_table(frame(spark, [("a", START + 7 * DAY, 1)]), "t")  # past the loads
    Ledger(spark, "t", "date").rebuild()
    assert_ledger_is_true(spark)
    spark.sql("DROP TABLE t")
    assert load_increment(frame(spark, []), "t", "date") == {"action": "created", "rows": 0, "min_date": None, "max_date": None}
    assert table_exists(spark, "t") and Ledger(spark, "t", "date").marks().isEmpty()
    assert load_increment(frame(spark, [("a", START, 1)]), "t", "date")["rows"] == 1
    assert_ledger_is_true(spark)


def test_marks_keep_the_time_of_day(spark, fresh_db):
    rows = lambda *hours: spark.createDataFrame([("a", dt.datetime(2024, 1, 1, h), h) for h in hours], "series_id string, date timestamp_ntz, v int")
    load_increment(rows(3, 8), "t", "date")
    assert load_increment(rows(5, 8, 9), "t", "date")["rows"] == 1
    assert Ledger(spark, "t", "date").marks().first()["last_at"] == dt.datetime(2024, 1, 1, 9)


def test_compaction_changes_nothing(spark, fresh_db):
    rng = random.Random(3)
    for turn in range(4):
        load_increment(frame(spark, batch(rng, 8 * (turn + 1))), "t", "date", load_id=f"q/{turn}")
    assert dedupe_table(spark, "t") == 0
    load_increment(frame(spark, [("b", START + 900 * DAY, 1)]), "t", "date", load_id="q/9")
    ledger = Ledger(spark, "t", "date")
    before = ledger.closed_load("q/2")
    ledger.compact()
    assert_ledger_is_true(spark)
    assert ledger.closed_load("q/2") == before and not ledger.interrupted()
    assert [r[0] for r in ledger.written_since_clean().collect()] == ["b"]
    load_increment(frame(spark, [("a", START + 901 * DAY, 1)]), "t", "date")
    assert_ledger_is_true(spark)


def test_duplicate_check_reads_partitions_written_since(spark, fresh_db):
    load_increment(frame(spark, [("a", START, 1), ("b", START, 1), (None, START, 1)]), "t", "date", dedupe=False)
    assert dedupe_table(spark, "t") == 0
    assert suspects(spark, "t") is None  # nothing written since: nothing to read
    load_increment(frame(spark, [("b", START + DAY, 2)] * 3), "t", "date", dedupe=False)
    part = suspects(spark, "t")
    assert "dynamicpruning" in part._jdf.queryExecution().executedPlan().toString()
    assert {r["series_id"] for r in part.collect()} == {"b"}
    assert dedupe_table(spark, "t") == 2 and dedupe_table(spark, "t") == 0
    assert_ledger_is_true(spark)
    load_increment(frame(spark, [(None, START + DAY, 2)] * 2), "t", "date", dedupe=False)
    assert dedupe_table(spark, "t") == 1
    assert stored(spark) == sorted([("a", START, 1), ("b", START, 1), ("b", START + DAY, 2), (None, START, 1), (None, START + DAY, 2)], key=repr)
    assert_ledger_is_true(spark)


def test_interrupted_rewrite_is_counted_anew(spark, fresh_db, monkeypatch):
    load_increment(frame(spark, [("a", START, 1)] * 2 + [("b", START, 1)]), "t", "date", dedupe=False)
    with monkeypatch.context() as m:
        m.setattr(Ledger, "end_rewrite", lambda *_: (_ for _ in ()).throw(Crash()))
        with pytest.raises(Crash):
            dedupe_table(spark, "t")
    assert dedupe_table(spark, "t") == 0
    assert_ledger_is_true(spark)


def test_stream_epochs_are_kept_apart_by_query(spark, fresh_db, tmp_dir):
    records = bar_records()
    path = f"{tmp_dir}/bars/*/*.json"
    for turn, part in enumerate((records[:2], records)):
        write_json(f"{tmp_dir}/bars/btc_usd_daily_price/{turn}.json", part)
        seen = []
        start_landing_stream(spark, path, "bars", f"{tmp_dir}/ckpt{turn}", on_load=seen.append).awaitTermination(120)
        assert len(seen) == 1  # each a first epoch, of another query
    spark.catalog.refreshTable("crypto_bars")
    assert spark.table("crypto_bars").count() == 4
    ids = [r[0] for r in Ledger(spark, "crypto_bars", "date_period_start").rows().where("kind = 'close' and load_id is not null").select("load_id").collect()]
    assert len(ids) == 2 and len({i.split("/")[0] for i in ids}) == 2 and {i.split("/")[1] for i in ids} == {"0"}


def test_gap_to_request_to_file_to_no_gap(spark, fresh_db, tmp_dir):
    root = f"{tmp_dir}/landing"
    records = bar_records()
    write_json(f"{root}/bars/btc_usd_daily_price/first.json", records)
    monthly = {"data": [{"date": "2024-01-01", "value": "1"}, {"date": "2024-03-01", "value": "2"}]}
    write_json(f"{root}/indicator/corn/first.json", monthly)
    first = daily_run(spark, root, "2024-01-01")
    gaps = missing_dates(spark.table("crypto_bars"), "date_period_start", ["series_id"]).collect()
    assert gaps
    requests = [r for r in first.backfill.collect()]
    assert {r["series_id"] for r in requests} == {"btc_usd_daily_price"}  # monthly by nature: corn
    assert sum(r["n_days"] for r in requests) == len(gaps)
    for r in requests:
        days = [dt.date.fromisoformat(r["start_date"]) + i * DAY for i in range(r["n_days"])]
        fetched = [dict(records[0], **{k: f"{d}T00:00:00.0000000Z" for k in ("time_period_start", "time_period_end", "time_open", "time_close")}) for d in days]
        write_json(f"{root}/backfill/{r['family']}/{r['series_id']}/{r['start_date']}.json", fetched)
    second = daily_run(spark, root, "2024-01-02")
    assert second.loads["bars"]["rows"] == len(gaps)
    assert second.backfill.isEmpty() and backfill_requests(spark, "bars").isEmpty()
    spark.catalog.refreshTable("crypto_bars")
    assert missing_dates(spark.table("crypto_bars"), "date_period_start", ["series_id"]).isEmpty()
    assert daily_run(spark, root, "2024-01-03").loads["bars"]["rows"] == 0


def test_gaps_after_loads_and_backfills_in_any_order(spark, fresh_db, tmp_dir):
    days = [1, 2, 5, 6, 9, 20]
    orders = [([9, 20], [1, 2], [5, 6]), ([1, 9], [2, 20], [6, 5])]
    for k, parts in enumerate(orders):
        for i, part in enumerate(parts):
            path = f"{tmp_dir}/{k}/{i}/indicator/s{k}/f.json"
            write_json(path, {"data": [{"date": f"2024-01-{d:02}", "value": "1"} for d in part]})
            load_landed(spark, os.path.dirname(path), "indicator", mode="backfill" if i else "increment")
        gaps = Ledger(spark, "indicators", "date").gaps().where(F.col("series_id") == f"s{k}")
        got = sorted((r["gap_start"].day, r["gap_end"].day) for r in gaps.collect())
        assert got == [(3, 4), (7, 8), (10, 19)]
        assert spark.table("indicators").where(F.col("series_id") == f"s{k}").count() == len(days)
