"""Row filters and the rules of OHLC quality."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scalar import has_null_price, ohlc_valid
from ..sources.schemas import OHLC


def without_nulls(bars: DataFrame) -> DataFrame:
    return bars.na.drop(subset=list(OHLC))


def null_report(bars: DataFrame) -> DataFrame:
    """One row: rows, rows dropped for a null price, and their percentage."""
    n = bars.agg(F.count("*").alias("total"), F.count_if(has_null_price()).alias("dropped"))
    return n.withColumn("dropped_pct", F.round(F.when(F.col("total") > 0, 100.0 * F.col("dropped") / F.col("total")).otherwise(0.0), 2))


def with_validity(bars: DataFrame) -> DataFrame:
    return bars.withColumn("valid", ohlc_valid())


def valid_only(bars: DataFrame, skip_validation: bool = False) -> DataFrame:
    return without_nulls(bars) if skip_validation else bars.where(ohlc_valid())


def inverted() -> Column:
    return F.col("high") < F.col("low")


def out_of_range() -> Column:
    off = (F.col("open") > F.col("high")) | (F.col("open") < F.col("low")) | (F.col("close") > F.col("high")) | (F.col("close") < F.col("low"))
    return off & (F.col("high") > 0) & (F.col("low") > 0)


def nonpositive() -> Column:
    return (F.col("open") <= 0) | (F.col("high") <= 0) | (F.col("low") <= 0) | (F.col("close") <= 0)


def issues(bars: DataFrame, rule: Column, ivl: str, since: str, cap: int | None = 200) -> DataFrame:
    """Rows that break a rule, newest first; the cap is part of the report, None for all."""
    hit = bars.where((F.col("ivl") == ivl) & (F.col("bar_ts") >= F.lit(since).cast("timestamp")) & rule)
    return hit if cap is None else hit.orderBy(F.desc("bar_ts"), "symbol", "open", "volume").limit(cap)


def zero_volume(bars: DataFrame, ivl: str, since: str) -> DataFrame:
    return bars.where((F.col("ivl") == ivl) & (F.col("bar_ts") >= F.lit(since).cast("timestamp"))).agg(F.count_if(F.col("volume") == 0).alias("zero_volume"))


def in_windows(bars: DataFrame, windows: DataFrame, cell_seconds: int = 86_400) -> DataFrame:
    """Bars inside labelled repair windows (label, start_ts, end_ts, both inclusive): a row for each bar and window that holds it.

    Windows are cut into time cells and joined to the bars of the same cell, so the work is about that of the rows found,
    however many windows there are and however they overlap. A window that ends before it starts holds nothing.
    """
    at = lambda c: F.floor(F.unix_micros(c) / F.lit(1_000_000 * cell_seconds))
    cut = windows.where(F.col("start_ts") <= F.col("end_ts")).withColumn("__cell", F.explode(F.sequence(at("start_ts"), at("end_ts"))))
    hit = bars.withColumn("__cell", at("bar_ts")).join(cut, "__cell")
    return hit.where(F.col("bar_ts").between(F.col("start_ts"), F.col("end_ts"))).drop("start_ts", "end_ts", "__cell")
