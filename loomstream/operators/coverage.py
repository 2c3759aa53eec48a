"""Coverage per symbol and interval, freshness, and plans of what to fetch."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scalar import interval_family


def coverage(bars: DataFrame) -> DataFrame:
    return bars.groupBy("symbol", "ivl").agg(F.min("bar_ts").alias("data_start"), F.max("bar_ts").alias("data_end"), F.count("*").alias("total_records"))


def rollup(history: DataFrame, ivl: str) -> DataFrame:
    """The largest end, start and number of records that any coverage row of a symbol has."""
    return history.where(F.col("ivl") == ivl).groupBy("symbol").agg(F.max("data_end").alias("data_end"), F.max("total_records").alias("total_records"), F.max("data_start").alias("data_start"))


def latest(history: DataFrame) -> DataFrame:
    """The newest coverage row of each symbol and interval."""
    newest = Window.partitionBy("symbol", "ivl").orderBy(F.desc("last_updated"))
    return history.withColumn("__n", F.row_number().over(newest)).where("__n = 1").drop("__n")


def max_timestamp(history: DataFrame) -> DataFrame:
    """``data_end`` of the newest row, which need not be the largest."""
    return latest(history).select("symbol", "ivl", "data_end")


def cleanup(history: DataFrame, as_of: str) -> DataFrame:
    """The newest row of each key, with created_at where it was missing."""
    stamped = history if "created_at" in history.columns else history.withColumn("created_at", F.lit(None).cast("timestamp"))
    return latest(stamped).withColumn("created_at", F.coalesce("created_at", F.lit(as_of).cast("timestamp")))


def freshness(symbols: DataFrame, history: DataFrame, as_of: str, max_age_minutes: int = 60, ivl: str = "d") -> DataFrame:
    """Each symbol: fresh, stale (its data end before the cutoff), or unknown."""
    own = latest(history.where(F.col("ivl") == ivl)).select("symbol", "data_end")
    cutoff = F.lit(as_of).cast("timestamp") - F.expr(f"interval {max_age_minutes} minutes")
    status = F.when(F.col("data_end").isNull(), "unknown").when(F.col("data_end") < cutoff, "stale").otherwise("fresh")
    return symbols.select("symbol").distinct().join(own, "symbol", "left").withColumn("status", status)


def update_plan(symbols: DataFrame, history: DataFrame, intervals: Sequence[str], as_of: str, max_age_days: int = 1) -> DataFrame:
    """The intervals of each symbol that were never collected or are older than the age."""
    wanted = symbols.select("symbol").distinct().withColumn("ivl", F.explode(F.array(*map(F.lit, intervals))))
    cutoff = F.lit(as_of).cast("timestamp") - F.expr(f"interval {max_age_days} days")
    due = wanted.join(latest(history).select("symbol", "ivl", "last_updated"), ["symbol", "ivl"], "left").where(F.col("last_updated").isNull() | (F.col("last_updated") < cutoff))
    return due.groupBy("symbol").agg(F.array_sort(F.collect_list("ivl")).alias("intervals"))


def refresh_plan(symbols: DataFrame, history: DataFrame, intervals: Sequence[str], as_of: str, max_age_minutes: int = 60, update_window: int = 7, force: bool = False) -> DataFrame:
    """Work list: symbols stale or unknown by the first interval (or all), and where each fetch begins."""
    state = freshness(symbols, history, as_of, max_age_minutes, intervals[0])
    todo = state if force else state.where(F.col("status") != "fresh")
    return todo.select("symbol", "status", F.date_sub(F.to_date("data_end"), update_window).alias("fetch_from"), interval_family(F.lit(intervals[0])).alias("family"))


def stale_vs_trading_day(history: DataFrame, expected: str, max_gap_days: int) -> DataFrame:
    """Status of each symbol with a coverage row against the expected trading day."""
    limit = F.date_sub(F.lit(expected).cast("date"), max_gap_days)
    day = F.to_date("data_end")
    status = F.when(day.isNull(), "no_metadata").when(day < limit, "stale").otherwise("up_to_date")
    return latest(history).select("symbol", "ivl", day.alias("last_day"), status.alias("status"))


def upserted(stored: DataFrame, batch: DataFrame) -> DataFrame:
    """One row for each symbol, interval and calendar day: a batch of the same day replaces the figures and keeps last_updated."""
    day = F.to_date("last_updated")
    s = stored.select("symbol", "ivl", day.alias("day"), F.col("last_updated").alias("s_updated"), F.col("total_records").alias("s_total"), F.col("data_start").alias("s_start"), F.col("data_end").alias("s_end"))
    b = batch.select("symbol", "ivl", day.alias("day"), "last_updated", "total_records", "data_start", "data_end")
    both = s.join(b, ["symbol", "ivl", "day"], "full_outer")
    new = F.col("total_records").isNotNull()
    pick = lambda n, o: F.when(new, F.col(n)).otherwise(F.col(o)).alias(n)
    return both.select("symbol", "ivl", F.coalesce("s_updated", "last_updated").alias("last_updated"), pick("total_records", "s_total"), pick("data_start", "s_start"), pick("data_end", "s_end"))


def symbol_coverage(exchange: DataFrame, tracked: DataFrame, stored: DataFrame) -> DataFrame:
    """Differences among the exchange's list, the tracked list and the stored symbols, each tagged."""
    e, t, s = (x.select("symbol").distinct() for x in (exchange, tracked, stored))
    less = lambda a, b, tag: a.join(b, "symbol", "left_anti").select(F.lit(tag).alias("gap"), "symbol")
    return less(e, t, "not_tracked").unionByName(less(t, s, "not_stored")).unionByName(less(e, s, "exchange_not_stored"))


def interval_gaps(pairs: DataFrame, intervals: Sequence[str]) -> DataFrame:
    """Symbols that some interval has and another lacks; no rows unless every interval has data."""
    own = pairs.select("symbol", "ivl").where(F.col("ivl").isin(list(intervals))).distinct()
    full = own.agg(F.countDistinct("ivl").alias("n")).where(F.col("n") == len(intervals))  # one row or none
    wanted = own.select("symbol").distinct().withColumn("ivl", F.explode(F.array(*map(F.lit, intervals))))
    return wanted.join(own, ["symbol", "ivl"], "left_anti").crossJoin(F.broadcast(full)).select("symbol", "ivl")
