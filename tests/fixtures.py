"""Hand-made inputs with results worked out by hand (FIXTURES.md §4)."""

import datetime as dt
import json
import os

# day, price_open, trades_count (row 3 is a whole-row copy of row 2)
BAR_DAYS = [
    ("2020-11-01", 100.0, 5),
    ("2020-11-02", 101.0, 6),
    ("2020-11-02", 101.0, 6),
    ("2020-11-05", 104.0, 7),
    ("2020-11-05", 104.0, 8),
]


def bar_records():
    out = []
    for day, price, trades in BAR_DAYS:
        nxt = (dt.date.fromisoformat(day) + dt.timedelta(days=1)).isoformat()
        out.append(
            {
                "time_period_start": f"{day}T00:00:00.0000000Z",
                "time_period_end": f"{nxt}T00:00:00.0000000Z",
                "time_open": f"{day}T00:00:01.2500000Z",
                "time_close": f"{day}T23:59:59.0000000Z",
                "price_open": price,
                "price_high": price + 2,
                "price_low": price - 1,
                "price_close": price + 1,
                "volume_traded": 10.5,
                "trades_count": trades,
            }
        )
    return out


def write_json(path, obj):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as f:
        json.dump(obj, f, indent=2)


def bars_frame(spark, series_id="btc_usd_daily_price"):
    """The fixture as a stored bar table (dates typed), one series."""
    rows = [
        (series_id, dt.date.fromisoformat(d), p, t) for d, p, t in BAR_DAYS
    ]
    return spark.createDataFrame(rows, "series_id string, date_period_start date, price_open double, trades_count bigint")


KEYED_PAYLOAD = {
    "Meta Data": {"1. Information": "Daily Prices", "2. Symbol": "SPY"},
    "Time Series (Daily)": {
        "2024-01-03": {"1. open": "470.1", "2. high": "471.0", "3. low": "468.2", "4. close": "468.8", "5. volume": "1000"},
        "2024-01-02": {"1. open": "472.2", "2. high": "473.6", "3. low": "470.5", "4. close": "472.6", "5. volume": "2000"},
    },
}

INDICATOR_PAYLOAD = {
    "name": "Global Price of Corn",
    "interval": "monthly",
    "unit": "dollar per metric ton",
    "data": [
        {"date": "2024-02-01", "value": "190.5"},
        {"date": "2024-01-01", "value": "."},
    ],
}
