"""Normalisation of landed records into typed rows. Bad dates drop a row, bad numbers become null."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scalar import has_null_price, not_empty, qualified, safe_date, safe_double, safe_int, suffixed
from ..sources.schemas import OHLC


def stamp(as_of: str) -> Column:
    return F.lit(as_of).cast("timestamp")


def bar_columns(symbol: Column, ivl: Column, ts: Column, adjusted: Column, gmtoffset: Column, source: str, as_of: str) -> list[Column]:
    return [
        symbol.alias("symbol"), ivl.alias("ivl"), ts.alias("bar_ts"), *[safe_double(c).alias(c) for c in OHLC], adjusted.alias("adjusted_close"),
        safe_int("volume").alias("volume"), gmtoffset.cast("int").alias("gmtoffset"), F.lit(source).alias("source"), stamp(as_of).alias("created_at"),
    ]


def eod(feed: DataFrame, as_of: str) -> DataFrame:
    """symbol, period, date, prices, volume: rows with a date and all four prices."""
    rows = feed.select(*bar_columns(F.col("symbol"), F.col("period"), safe_date("date").cast("timestamp"), safe_double("adjusted_close"), F.lit(None), "eod", as_of))
    return rows.where(F.col("bar_ts").isNotNull()).na.drop(subset=list(OHLC))


def intraday_raw(feed: DataFrame, as_of: str) -> DataFrame:
    """Epoch seconds to UTC; no filter of null prices."""
    rows = feed.select(*bar_columns(F.col("symbol"), F.col("period"), F.timestamp_seconds("timestamp"), F.lit(None).cast("double"), F.col("gmtoffset"), "intraday", as_of))
    return rows.where(F.col("bar_ts").isNotNull())


def market_hours(ts: str, start: int, end: int, zone: str) -> Column:
    return F.hour(F.from_utc_timestamp(F.col(ts), zone)).between(start, end - 1)


def keep_null_in_hours(bars: DataFrame, start: int = 9, end: int = 16, zone: str = "UTC", zero_is_null: bool = False) -> DataFrame:
    """Rows with all prices, and rows without only where the hour is in [start, end)."""
    missing = has_null_price()
    if zero_is_null:
        for c in OHLC:
            missing = missing | (F.col(c) == 0)
    return bars.where(~missing | market_hours("bar_ts", start, end, zone))


def intraday(feed: DataFrame, as_of: str) -> DataFrame:
    return keep_null_in_hours(intraday_raw(feed, as_of))


def intraday_backfill(feed: DataFrame, as_of: str) -> DataFrame:
    """As intraday, but a price of zero counts as missing."""
    return keep_null_in_hours(intraday_raw(feed, as_of), zero_is_null=True)


def bulk_eod(feed: DataFrame, as_of: str, exchange: str = "JK") -> DataFrame:
    """Rows with a code and a date, null prices included."""
    own = feed.where(not_empty("code").isNotNull() & not_empty("date").isNotNull())
    rows = own.select(*bar_columns(qualified("code", exchange), F.lit("d"), safe_date("date").cast("timestamp"), safe_double("adjusted_close"), F.lit(None), "eod_bulk", as_of))
    return rows.where(F.col("bar_ts").isNotNull())


def action(symbol: Column, kind: str, day: Column, as_of: str, **fields: Column) -> list[Column]:
    types = {
        "dividend_amount": "double", "dividend_currency": "string", "payment_date": "date", "record_date": "date", "declaration_date": "date", "dividend_type": "string",
        "split_ratio": "string", "split_from": "int", "split_to": "int",
    }
    return [symbol.alias("symbol"), F.lit(kind).alias("action_type"), day.alias("action_date"), *[fields.get(n, F.lit(None)).cast(t).alias(n) for n, t in types.items()], stamp(as_of).alias("created_at")]


def dividends(feed: DataFrame, as_of: str) -> DataFrame:
    """A symbol's dividends; a date that cannot be parsed leaves a row without action_date, to be rejected by the caller."""
    own = feed.where(not_empty("date").isNotNull())
    return own.select(
        *action(
            F.col("symbol"), "dividend", safe_date("date"), as_of, dividend_amount=safe_double("value"), dividend_currency=F.coalesce("currency", F.lit("IDR")),
            payment_date=safe_date("paymentDate"), record_date=safe_date("recordDate"), declaration_date=safe_date("declarationDate"), dividend_type=F.col("period"),
        )
    )


def dividends_bulk(feed: DataFrame, as_of: str, exchange: str = "JK") -> DataFrame:
    """The first date that is not empty counts; a bad one drops the row."""
    day = safe_date(F.coalesce(not_empty("date"), not_empty("ex_date"), not_empty("exDate")))
    own = feed.where(not_empty("code").isNotNull()).select(
        *action(
            qualified("code", exchange), "dividend", day, as_of, dividend_amount=safe_double(F.coalesce("value", "dividend")), dividend_currency=F.coalesce("currency", F.lit("IDR")),
            payment_date=safe_date("paymentDate"), record_date=safe_date("recordDate"), declaration_date=safe_date("declarationDate"), dividend_type=F.col("period"),
        )
    )
    return own.where(F.col("action_date").isNotNull())


def ratio(split: Column, through_double: bool) -> tuple[Column, Column]:
    """Both sides of 'a/b' as integers, left first: where the left side fails, so does the right."""
    number = (lambda x: x.try_cast("double").try_cast("int")) if through_double else (lambda x: x.try_cast("int"))
    parts = F.split(split, "/")
    two = F.when(split.contains("/"), parts)
    left = number(F.trim(F.try_element_at(two, F.lit(1))))
    return left, F.when(left.isNotNull(), number(F.trim(F.try_element_at(two, F.lit(2)))))


def splits(feed: DataFrame, as_of: str) -> DataFrame:
    left, right = ratio(F.col("split"), False)
    own = feed.where(not_empty("date").isNotNull())
    return own.select(*action(F.col("symbol"), "split", safe_date("date"), as_of, split_ratio=F.col("split"), split_from=left, split_to=right))


def splits_bulk(feed: DataFrame, as_of: str, exchange: str = "JK") -> DataFrame:
    left, right = ratio(F.col("split"), True)
    day = safe_date(F.coalesce(not_empty("date"), not_empty("split_date")))
    own = feed.where(not_empty("code").isNotNull()).select(*action(qualified("code", exchange), "split", day, as_of, split_ratio=F.col("split"), split_from=left, split_to=right))
    return own.where(F.col("action_date").isNotNull())


def listing(records: DataFrame, as_of: str, exchange: str = "JK") -> DataFrame:
    """Instrument rows with defaults."""
    return records.where(not_empty("Code").isNotNull()).select(
        F.concat(F.col("Code"), F.lit(f".{exchange}")).alias("symbol"), F.lit(exchange).alias("exchange"), F.coalesce("Name", F.lit("")).alias("name"), F.coalesce("Sector", F.lit("")).alias("sector"),
        F.coalesce("Industry", F.lit("")).alias("industry"), F.coalesce("Currency", F.lit("IDR")).alias("currency"), F.lit(True).alias("is_active"), stamp(as_of).alias("created_at"),
    )


def qualify_codes(codes: DataFrame, exchange: str = "JK") -> DataFrame:
    return codes.select("code", qualified("code", exchange).alias("symbol"))


def suffix_codes(codes: DataFrame, suffix: str = ".JK") -> DataFrame:
    return codes.select("code", suffixed("code", suffix).alias("symbol"))
