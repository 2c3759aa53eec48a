"""Schemas of landed feeds and stored tables; none is inferred."""

from __future__ import annotations

OHLC = ("open", "high", "low", "close")
KEY = ("symbol", "ivl", "bar_ts")

# Feed fields as vendors name them.
EOD = "date string, open double, high double, low double, close double, adjusted_close double, volume long"
INTRADAY = "timestamp long, open double, high double, low double, close double, volume long, gmtoffset int"
BULK_EOD = "code string, date string, open string, high string, low string, close string, adjusted_close string, volume string"
BULK_DIVIDENDS = "code string, date string, ex_date string, exDate string, value string, dividend string, currency string, paymentDate string, recordDate string, declarationDate string, period string"
BULK_SPLITS = "code string, date string, split_date string, split string"
DIVIDENDS = "date string, value double, currency string, paymentDate string, recordDate string, declarationDate string, period string"
SPLITS = "date string, split string"
LISTING = "Code string, Name string, Exchange string, Sector string, Industry string, Currency string"

BARS = "symbol string, ivl string, bar_ts timestamp, open double, high double, low double, close double, adjusted_close double, volume long, gmtoffset int, source string, created_at timestamp"
ACTIONS = (
    "symbol string, action_type string, action_date date, dividend_amount double, dividend_currency string, payment_date date, record_date date, declaration_date date, dividend_type string, "
    "split_ratio string, split_from int, split_to int, created_at timestamp"
)
INSTRUMENTS = "symbol string, exchange string, name string, sector string, industry string, currency string, is_active boolean, created_at timestamp"
COVERAGE = "symbol string, ivl string, last_updated timestamp, total_records long, data_start timestamp, data_end timestamp"
