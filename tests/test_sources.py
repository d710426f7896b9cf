import datetime as dt
import os

from fixtures import INDICATOR_PAYLOAD, KEYED_PAYLOAD, bar_records, write_json
from tidemark import schemas
from tidemark.sources.landing import (
    classify_payloads,
    melt_values,
    parse_bars,
    parse_indicator,
    parse_keyed_series,
    read_bars,
    read_landed,
    read_table_dump,
    shape_bars,
    split_quarantine,
)


def _land(root):
    write_json(f"{root}/bars/btc_usd_daily_price/2020-11-06.json", bar_records())
    write_json(f"{root}/bars/eth_usd_daily_price/2020-11-06.json", {"error": "Invalid API key"})
    write_json(f"{root}/macro/spy/2024-01-04.json", KEYED_PAYLOAD)
    write_json(f"{root}/macro/corn/2024-03-01.json", INDICATOR_PAYLOAD)
    write_json(f"{root}/macro/coffee/2024-03-01.json", {"Information": "Thank you for using the API. Rate limit reached."})
    write_json(f"{root}/macro/qqq/2024-03-01.json", {"Error Message": "Invalid API call."})
    os.makedirs(f"{root}/macro/dia", exist_ok=True)
    with open(f"{root}/macro/dia/2024-03-01.json", "w") as f:
        f.write("<html>gateway timeout</html>")


def test_read_landed_and_classify(spark, tmp_dir):
    _land(tmp_dir)
    landed = read_landed(spark, f"{tmp_dir}/macro/*/*.json")
    got = {r.series_id: (r.payload_class, r.message) for r in classify_payloads(landed).collect()}
    assert got["spy"][0] == "ok"
    assert got["corn"][0] == "ok"
    assert got["coffee"] == ("quota", "Thank you for using the API. Rate limit reached.")
    assert got["qqq"] == ("error", "Invalid API call.")
    assert got["dia"][0] == "corrupt"
    fetch = {r.series_id: r.fetch_name for r in landed.collect()}
    assert fetch["spy"] == "2024-01-04"


def test_classify_http_status(spark):
    df = spark.createDataFrame([('{"a": 1}', 500), ('{"a": 1}', 200), ("[]", None)], "payload string, status int")
    got = [r.payload_class for r in classify_payloads(df, status_col="status").collect()]
    assert got == ["error", "ok", "ok"]


def test_bars_read_and_shape(spark, tmp_dir):
    _land(tmp_dir)
    landed = read_landed(spark, f"{tmp_dir}/bars/*/*.json")
    good, bad = split_quarantine(classify_payloads(landed, expect="array"))
    raw = parse_bars(good)
    assert raw.count() == 5
    assert [(r.series_id, r.payload_class, r.message) for r in bad.collect()] == [
        ("eth_usd_daily_price", "error", "Invalid API key")
    ]
    shaped = shape_bars(raw)
    assert shaped.columns == ["series_id", *schemas.BAR_COLUMNS]
    r = shaped.orderBy("date_period_start", "trades_count").first()
    assert r.time_open == "00:00:01.250000" and r.time_close == "23:59:59"
    assert r.time_period_start == "00:00:00" and r.date_period_end == dt.date(2020, 11, 2)
    assert (r.price_open, r.price_high, r.price_low, r.price_close, r.trades_count) == (100.0, 102.0, 99.0, 101.0, 5)
    assert dict(shaped.dtypes)["trades_count"] == "bigint"
    assert read_bars(spark, f"{tmp_dir}/bars/*/*.json").count() == 5


def test_keyed_series(spark, tmp_dir):
    _land(tmp_dir)
    landed = read_landed(spark, f"{tmp_dir}/macro/spy/*.json")
    rows = parse_keyed_series(landed)
    assert set(rows.columns) >= {"date", "1__open", "5__volume"}
    got = {r.date: r["1__open"] for r in rows.collect()}
    assert got == {"2024-01-03": "470.1", "2024-01-02": "472.2"}
    kv = parse_keyed_series(landed, labels=None).orderBy("date").first()
    assert [e["key"] for e in kv.vals] == ["1. open", "2. high", "3. low", "4. close", "5. volume"]
    # a payload without the root key gives no rows
    other = read_landed(spark, f"{tmp_dir}/macro/corn/*.json")
    assert parse_keyed_series(other).count() == 0


def test_indicator(spark, tmp_dir):
    _land(tmp_dir)
    rows = parse_indicator(read_landed(spark, f"{tmp_dir}/macro/corn/*.json")).orderBy("date").collect()
    assert [(r.date, r.value) for r in rows] == [(dt.datetime(2024, 1, 1), None), (dt.datetime(2024, 2, 1), 190.5)]
    assert rows[0].interval == "monthly" and rows[0].series_id == "corn"
    arr = spark.createDataFrame([('[{"date": "2024-01-01", "value": "2"}]',)], "payload string")
    assert parse_indicator(arr).first().value == 2.0


def test_table_dump_long_forms(spark, tmp_dir):
    path = f"{tmp_dir}/dump.csv"
    with open(path, "w") as f:
        f.write("Date,USD (AM),USD (PM)\n2024-01-02,2050.5,2060\n2024-01-03,,2070\n")
    df = read_table_dump(spark, path, "`Date` date, `USD (AM)` double, `USD (PM)` double")
    assert df.columns == ["Date", "USD__AM_", "USD__PM_"]
    long = melt_values(df, ["Date"], ["USD__AM_", "USD__PM_"])
    assert long.count() == 4 and long.where("value IS NULL").count() == 1


DUMP_CSV = "Date,USD (AM),USD (PM),GBP (AM)\n2024-01-03,2050.5,,1610\r\n2024-01-02,2040,2045.25,x\n\n"


def test_parse_table_dump(spark):
    from tidemark.sources.landing import dump_values, parse_table_dump

    df = spark.createDataFrame([("lbma_gold", DUMP_CSV)], "series_id string, payload string")
    classified = classify_payloads(df, expect="csv")
    assert classified.first().payload_class == "ok"
    parsed = parse_table_dump(classified)
    rows = parsed.orderBy("date").collect()
    assert [r.date for r in rows] == [dt.date(2024, 1, 2), dt.date(2024, 1, 3)]
    assert [(e.field, e.value) for e in rows[0].vals] == [("GBP__AM_", "x"), ("USD__AM_", "2040"), ("USD__PM_", "2045.25")]
    assert [(e.field, e.value) for e in rows[1].vals] == [("GBP__AM_", "1610"), ("USD__AM_", "2050.5"), ("USD__PM_", "")]
    typed = {(r.date.day, r.field): r.value for r in dump_values(parsed).collect()}
    assert typed == {
        (2, "GBP__AM_"): None, (2, "USD__AM_"): 2040.0, (2, "USD__PM_"): 2045.25,
        (3, "GBP__AM_"): 1610.0, (3, "USD__AM_"): 2050.5, (3, "USD__PM_"): None,
    }
    plan = parsed._jdf.queryExecution().executedPlan().toString()
    assert "lambdafunction" not in plan
    err = spark.createDataFrame([("x", '{"provider_error": {"code": "QELx04"}}'), ("y", "nothing here")], "series_id string, payload string")
    got = {r.series_id: r.payload_class for r in classify_payloads(err, expect="csv").collect()}
    assert got == {"x": "error", "y": "corrupt"}
    assert parse_table_dump(classify_payloads(err, expect="csv")).count() == 0


def test_classify_leading_whitespace_and_case(spark):
    df = spark.createDataFrame(
        [("\n\t [1, 2]",), ("﻿{\"ERROR MESSAGE\": \"Bad\"}",), ("\r\n{\"information\": \"slow down\"}",), ("{}",)],
        "payload string",
    )
    got = [(r.payload_class, r.message) for r in classify_payloads(df).collect()]
    assert got == [("ok", None), ("error", "Bad"), ("quota", "slow down"), ("corrupt", None)]
    plan = classify_payloads(df)._jdf.queryExecution().executedPlan().toString()
    assert "lambdafunction" not in plan


def test_parse_table_dump_crlf_and_blank_lines(spark):
    from tidemark.sources.landing import dump_values, parse_table_dump

    text = "Date , Value (x)\r\n2024-01-02, 5\r\n\r\n   \n2024-01-03,6\r\n"
    df = spark.createDataFrame([("s", text)], "series_id string, payload string")
    rows = {(r.date.day, r.field, r.value) for r in dump_values(parse_table_dump(df)).collect()}
    assert rows == {(2, "Value__x_", 5.0), (3, "Value__x_", 6.0)}


def test_table_dump_quotes_collisions_and_ragged_lines(spark):
    from tidemark.sources.landing import parse_table_dump

    texts = {
        "quoted": 'Date,"a, b",c\n2024-01-02,"1,234.5",x\n2024-01-03,"say ""hi""",\n',
        "same": "Date,a b,a.b\n2024-01-02,1,2\n",
        "ragged": "Date,a\n2024-01-02,1,2\n2024-01-03,5\nsoon,6\n",
        "bare": "Date,a\n",
    }
    df = spark.createDataFrame(list(texts.items()), "series_id string, payload string")
    classified = classify_payloads(df, expect="csv")
    rows = parse_table_dump(classified, rejects=True).collect()
    good = {(r.series_id, r.date.day): [(e.field, e.value) for e in r.vals] for r in rows if r.date}
    assert good == {
        ("quoted", 2): [("a__b", "1,234.5"), ("c", "x")],
        ("quoted", 3): [("a__b", 'say "hi"'), ("c", "")],
        ("ragged", 3): [("a", "5")],
    }
    assert sorted(r.series_id for r in rows if r.date is None) == ["bare", "ragged", "ragged", "same"]


def test_table_dump_line_breaks_in_quotes(spark):
    from tidemark.sources.landing import parse_table_dump

    long = "x,\n" * 20_000
    texts = {
        "breaks": 'Date,"a\nb",c\r\n2024-01-02,"one\ntwo, ""three""\n",x\r\n\n2024-01-03, "p\r\nq" ,"y"\n',
        "stray": 'Date,a\n2024-01-02,"open\n2024-01-03,"shut"\n2024-01-04,5" pipe\n2024-01-05,6" pipe\n',
        "long": f'Date,a\n2024-01-02,"{long}"\n2024-01-03,"""{long}"""',
    }
    df = spark.createDataFrame(list(texts.items()), "series_id string, payload string")
    rows = parse_table_dump(classify_payloads(df, expect="csv"), rejects=True).collect()
    good = {(r.series_id, r.date.day): [e.value for e in r.vals] for r in rows if r.date}
    assert good == {
        ("breaks", 2): ['one\ntwo, "three"\n', "x"],
        ("breaks", 3): ["p\r\nq", "y"],
        ("stray", 3): ["shut"],
        ("long", 2): [long],
        ("long", 3): [f'"{long}"'],
    }
    assert sorted(r.series_id for r in rows if r.date is None) == ["stray"] * 3


def test_bars_typing_and_bad_elements(spark):
    text = (
        '[{"time_period_start": "2024-01-02T00:00:00Z", "price_open": "3.25", "trades_count": 12.0}, 7, null,'
        ' {"price_open": 1}, {"time_open": "2024-01-03T00:00:00Z", "price_open": 1e2, "trades_count": "5"}]'
    )
    df = spark.createDataFrame([("s", text)], "series_id string, payload string")
    rows = shape_bars(parse_bars(classify_payloads(df, expect="array"))).collect()
    assert [(r.date_period_start, r.price_open, r.trades_count) for r in rows] == [
        (dt.date(2024, 1, 2), 3.25, 12), (None, 100.0, 5)
    ]
    assert parse_bars(classify_payloads(df, expect="array"), rejects=True).count() == 5


def test_indicator_without_data_array(spark):
    texts = [
        '{"name": "n", "date": "2024-01-01", "value": "1.5"}',
        '{"date": ["2024-01-01", "2024-01-02"], "value": ["2", "."]}',
        '{"name": "nothing else"}',
    ]
    df = spark.createDataFrame([(str(i), t) for i, t in enumerate(texts)], "series_id string, payload string")
    rows = parse_indicator(classify_payloads(df), rejects=True).collect()
    assert sorted((r.series_id, str(r.date)[:10], r.value) for r in rows) == [
        ("0", "2024-01-01", 1.5), ("1", "2024-01-01", 2.0), ("1", "2024-01-02", None), ("2", "None", None)
    ]


def test_series_id_is_decoded_from_the_path(spark, tmp_dir):
    write_json(f"{tmp_dir}/bars/a+b c%d/f.json", [])
    assert [r.series_id for r in read_landed(spark, f"{tmp_dir}/bars/*/*").collect()] == ["a+b c%d"]


def test_table_dump_of_many_fields_and_great_values(spark):
    from tidemark.sources.landing import parse_table_dump

    n = 5000  # fields
    great = ('x""y,\n' * 200_000)[: 1 << 20] + "z"
    texts = {
        "wide": ",".join(["Date", *[f'"c{i}"' for i in range(n)]]) + "\n2024-01-02," + ",".join(f'"{i},"' for i in range(n)),
        "great": f'Date,a\n2024-01-02,"{great}"\n2024-01-03,5\n',
        "doubled": 'Date,a\n2024-01-02,"' + '"",' * n + '"\n',
        "pairs": "Date,a\n2024-01-02," + '"' * 10_000 + "\n",
        "broken": 'Date,a\n2024-01-02,"' + '"x' * 9_999 + "\n2024-01-03,7\n",
        "other": "Date,a,b\n2024-01-02,1,2\n2024-01-03,,\n",
    }
    df = spark.createDataFrame(list(texts.items()), "series_id string, payload string")
    rows = parse_table_dump(classify_payloads(df, expect="csv"), rejects=True)
    assert set(rows.columns) == {"series_id", "date", "vals", "record_no", "record_text"}
    got = {}
    for r in rows.collect():
        got.setdefault(r.series_id, {})[r.record_no] = (r.date and r.date.day, [e.value for e in r.vals or []])
    assert {e for e in got["wide"][1][1]} == {f"{i}," for i in range(n)} and got["wide"][1][0] == 2
    assert got["great"] == {1: (2, [great.replace('""', '"')]), 2: (3, ["5"])}
    assert got["doubled"] == {1: (2, ['",' * n])}
    assert got["pairs"] == {1: (2, ['"' * 4_999])}
    assert got["broken"][max(got["broken"])] == (3, ["7"])
    assert got["other"] == {1: (2, ["1", "2"]), 2: (3, ["", ""])}
    nothing = classify_payloads(df.limit(0), expect="csv")
    assert parse_table_dump(nothing).collect() == [] == parse_table_dump(nothing, rejects=True).collect()
