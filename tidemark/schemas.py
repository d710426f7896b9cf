"""Explicit schemas for landed payloads and stored tables.

Readers never infer: a batch with no rows still has its schema.
"""

from __future__ import annotations

from pyspark.sql import types as T

S = T.StringType()
D = T.DoubleType()
L = T.LongType()
DT = T.DateType()

# Fields of one daily bar as the provider lands it. All are read as text: a number may come
# as text or with a point, and a field typed at parse time would lose it.
RAW_BAR = T.StructType(
    [
        T.StructField(name, S)
        for name in (
            "time_period_start",
            "time_period_end",
            "time_open",
            "time_close",
            "price_open",
            "price_high",
            "price_low",
            "price_close",
            "volume_traded",
            "trades_count",
        )
    ]
)
BAR_FIELDS = RAW_BAR.fieldNames()

# Stored crypto table: 14 columns in this order (fixed values).
BAR_COLUMNS = [
    "date_period_start",
    "time_period_start",
    "date_period_end",
    "time_period_end",
    "date_open",
    "time_open",
    "date_close",
    "time_close",
    "price_open",
    "price_close",
    "price_high",
    "price_low",
    "volume_traded",
    "trades_count",
]
BAR_TYPES = {
    "date_period_start": "date",
    "date_period_end": "date",
    "date_open": "date",
    "date_close": "date",
    "price_open": "double",
    "price_close": "double",
    "price_high": "double",
    "price_low": "double",
    "volume_traded": "double",
    "trades_count": "bigint",
}
# Source timestamp text -> (date column, time-of-day column).
BAR_SPLITS = {
    "time_period_start": ("date_period_start", "time_period_start"),
    "time_period_end": ("date_period_end", "time_period_end"),
    "time_open": ("date_open", "time_open"),
    "time_close": ("date_close", "time_close"),
}
BAR_TABLE = T.StructType(
    [
        T.StructField("series_id", S),
        T.StructField("date_period_start", DT),
        T.StructField("time_period_start", S),
        T.StructField("date_period_end", DT),
        T.StructField("time_period_end", S),
        T.StructField("date_open", DT),
        T.StructField("time_open", S),
        T.StructField("date_close", DT),
        T.StructField("time_close", S),
        T.StructField("price_open", D),
        T.StructField("price_close", D),
        T.StructField("price_high", D),
        T.StructField("price_low", D),
        T.StructField("volume_traded", D),
        T.StructField("trades_count", L),
    ]
)

# Daily OHLCV payload: {"Time Series (Daily)": {"<date>": {"<label>": "<text>", ...}}}.
KEYED_ROOT = "Time Series (Daily)"
# Inner labels of a daily bar (assumed provider labels; they sanitise to 1__open etc.).
OHLCV_LABELS = ["1. open", "2. high", "3. low", "4. close", "5. volume"]

# Indicator payload: metadata fields and a "data" array of {date, value} records.
INDICATOR_RECORD = T.StructType([T.StructField("date", S), T.StructField("value", S)])
INDICATOR_PAYLOAD = T.StructType(
    [
        T.StructField("name", S),
        T.StructField("interval", S),
        T.StructField("unit", S),
        T.StructField("data", T.ArrayType(INDICATOR_RECORD)),
        T.StructField("date", S),
        T.StructField("value", S),
    ]
)

CATALOG = T.StructType(
    [
        T.StructField("series_id", S, False),
        T.StructField("family", S, False),
        T.StructField("symbol", S, False),
        T.StructField("grp", S),
        T.StructField("interval", S),
        T.StructField("notes", S),
        T.StructField("source_url", S),
        T.StructField("known_missing", T.IntegerType(), False),
        T.StructField("start_date", DT),
    ]
)
SCHEDULE = T.StructType(
    [T.StructField("grp", S, False), T.StructField("dow", T.ArrayType(T.IntegerType()), False)]
)
