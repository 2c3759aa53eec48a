"""Scalar expressions; each is a Column built from built-in functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..sources.schemas import OHLC


def col(x: Column | str) -> Column:
    return F.col(x) if isinstance(x, str) else x


def safe_int(x: Column | str) -> Column:
    """Through double, so '2.0' counts; null on failure."""
    return col(x).try_cast("double").try_cast("long")


def safe_double(x: Column | str) -> Column:
    return col(x).try_cast("double")


def rounded(x: Column | str, places: int) -> Column:
    """Half up after moving the point, as SQL engines round doubles: 20 to 420.89 is 2004.45 percent and gives 2004.5, though the double is just below it."""
    scale = F.lit(10.0**places)
    return F.round(col(x) * scale) / scale


def safe_date(x: Column | str) -> Column:
    """Year-month-day with or without leading zeros; null on failure.

    The usual form is cast, and text without a dash is no date, so few values go through the formatter, which is slow and
    slowest where it fails.
    """
    c = col(x)
    usual = c.rlike(r"\A(?!0000)[0-9]{4}-[0-9]{2}-[0-9]{2}\z")
    return F.when(usual, c.try_cast("date")).when(c.contains("-"), F.try_to_date(c, "yyyy-M-d"))


def not_empty(x: Column | str) -> Column:
    return F.nullif(col(x), F.lit(""))


def suffixed(x: Column | str, suffix: str = ".JK") -> Column:
    """Adds the suffix unless the symbol ends with it."""
    return F.when(col(x).endswith(suffix), col(x)).otherwise(F.concat(col(x), F.lit(suffix)))


def qualified(x: Column | str, exchange: str = "JK") -> Column:
    """Adds the exchange only to a code without a dot."""
    return F.when(col(x).contains("."), col(x)).otherwise(F.concat(col(x), F.lit(f".{exchange}")))


def interval_family(ivl: Column | str) -> Column:
    """The feed that an interval comes from; eod where it is unknown."""
    return F.when(col(ivl).isin("5m", "15m", "30m", "1h"), "intraday").otherwise("eod")


def last_trading_day(day: Column | str) -> Column:
    """Saturday and Sunday go back to Friday; there is no calendar of holidays."""
    return F.date_sub(col(day), F.greatest(F.weekday(col(day)) - 4, F.lit(0)))


def has_null_price() -> Column:
    out = F.lit(False)
    for c in OHLC:
        out = out | F.col(c).isNull()
    return out


def ohlc_valid() -> Column:
    """False where a price is null or outside what high and low allow."""
    o, h, low, c = map(F.col, OHLC)
    return F.coalesce((h >= low) & (h >= o) & (h >= c) & (low <= o) & (low <= c), F.lit(False))


def local_time(ts: Column | str, zone: str = "Asia/Jakarta") -> Column:
    return F.from_utc_timestamp(col(ts), zone)


def day_lag(newer: Column, older: Column) -> Column:
    """Whole days between two timestamps, rounded down."""
    return F.floor((F.unix_micros(newer) - F.unix_micros(older)) / F.lit(86_400_000_000)).cast("int")
