"""Audits over whole tables: duplicates, gaps, staleness, completeness, issues, spikes, and their report."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scalar import day_lag, rounded
from . import filters


def at(x: str) -> Column:
    return F.lit(x).cast("timestamp")


def duplicates(bars: DataFrame, *keys: str, days: int, data_end: str) -> DataFrame:
    """Keys that occur more than once within so many days before ``data_end``."""
    own = bars.where(F.col("bar_ts").between(at(data_end) - F.expr(f"interval {days} days"), at(data_end)))
    return own.groupBy(*keys).agg(F.count("*").alias("cnt")).where("cnt > 1")


def duplicate_summary(dups: DataFrame, *by: str) -> DataFrame:
    return dups.groupBy(*by).agg(F.count("*").alias("pairs"), F.sum(F.col("cnt") - 1).alias("extra_rows"))


def metadata_duplicates(history: DataFrame) -> DataFrame:
    n = history.agg(F.count("*").alias("total"), F.countDistinct("symbol", "ivl").alias("unique_keys"))
    return n.withColumn("duplicates", F.col("total") - F.col("unique_keys"))


def row_distribution(rows: DataFrame) -> DataFrame:
    """Largest, smallest, mean and (lower) median of the positive row counts."""
    own = rows.where("total_records > 0")
    # percentile_disc takes the lower of two middles, as the middle of a falling list does
    return own.agg(
        F.max("total_records").alias("max_rows"), F.min("total_records").alias("min_rows"), F.round(F.avg("total_records"), 6).alias("avg_rows"),
        F.expr("cast(percentile_disc(0.5) within group (order by total_records) as long)").alias("median_rows"),
    )


def row_gaps(rows: DataFrame, share: float = 0.8) -> DataFrame:
    """Symbols with fewer rows than a share of the leader's."""
    top = rows.agg(F.max("total_records").alias("leader"))  # one row
    gap = F.round((1 - F.col("total_records") / F.col("leader")) * 100, 1)
    return rows.crossJoin(F.broadcast(top)).where(F.col("total_records") < share * F.col("leader")).select("symbol", "total_records", gap.alias("gap_pct"))


def upper_median(ts: str) -> Column:
    """The later of two middles."""
    return F.expr(f"timestamp_micros(cast(percentile_disc(0.5) within group (order by unix_micros({ts}) desc) as long))")


def staleness(rows: DataFrame, days: int = 7) -> DataFrame:
    """Each symbol's floor-day lag behind the median last date, whether it is stale, and the percentage of all symbols that are not."""
    median = rows.agg(upper_median("data_end").alias("median_end"))
    lag = day_lag(F.col("median_end"), F.col("data_end"))
    own = rows.crossJoin(F.broadcast(median)).select("symbol", "data_end", lag.alias("lag_days"), (lag > days).alias("stale"))
    fresh = own.agg(F.round(100.0 * F.count_if(~F.col("stale")) / F.count("*"), 1).alias("fresh_pct"))  # one row
    return own.crossJoin(F.broadcast(fresh))


def interval_staleness(rows: DataFrame, as_of: str, hours: int = 24, days: int = 7) -> DataFrame:
    """Per interval: symbols, latest and median end, how many lag by more than the hours, days since the latest, status."""
    mid = rows.groupBy("ivl").agg(F.count("*").alias("symbols"), F.max("data_end").alias("latest"), upper_median("data_end").alias("median_end"))
    late = (F.unix_micros("latest") - F.unix_micros("data_end")) > hours * 3_600_000_000
    joined = rows.join(F.broadcast(mid), "ivl")  # a row for each interval
    out = joined.groupBy("ivl", "symbols", "latest", "median_end").agg(F.count_if(late).alias("stale"))
    since = day_lag(at(as_of), F.col("latest"))
    return out.withColumns({"days_since": since, "status": F.when((F.col("stale") == 0) & (since < days), "OK").otherwise("WARN")})


def bars_per_day(bars: DataFrame, as_of: str, days: int = 30) -> DataFrame:
    own = bars.where((F.col("bar_ts") >= at(as_of) - F.expr(f"interval {days} days")) & (F.col("bar_ts") <= at(as_of)))
    return own.groupBy("symbol", "ivl", F.to_date("bar_ts").alias("day")).agg(F.count("*").alias("bars"))


def without_partial_days(per_day: DataFrame) -> DataFrame:
    """Drops the first and last day of a symbol with more than two. The ends are aggregates, so no task sorts a whole series."""
    ends = per_day.groupBy("symbol", "ivl").agg(F.min("day").alias("__first"), F.max("day").alias("__last"), F.count("*").alias("__n"))
    own = per_day.join(ends.withColumnsRenamed({"symbol": "__symbol", "ivl": "__ivl"}), (F.col("symbol").eqNullSafe(F.col("__symbol"))) & (F.col("ivl").eqNullSafe(F.col("__ivl"))))
    return own.where((F.col("__n") <= 2) | ((F.col("day") > F.col("__first")) & (F.col("day") < F.col("__last")))).select(*per_day.columns)


#: Bars that a full day has.
EXPECTED = {"5m": 59, "15m": 20, "30m": 10, "1h": 6}


def session_completeness(bars: DataFrame, as_of: str, days: int = 30, share: float = 0.7, top: int = 5) -> DataFrame:
    """Mean bars a day of the symbols with most rows in each interval, and whether that is too few."""
    expected = F.create_map(*[F.lit(x) for kv in EXPECTED.items() for x in kv])
    own = bars.where(F.col("ivl").isin(list(EXPECTED)))
    best = top_by_rows(own.groupBy("symbol", "ivl").agg(F.count("*").alias("rows")), top).select("symbol", "ivl")
    mean = without_partial_days(bars_per_day(own.join(best, ["symbol", "ivl"], "left_semi"), as_of, days)).groupBy("symbol", "ivl").agg(F.avg("bars").alias("avg_bars"))
    return mean.select("symbol", "ivl", F.round("avg_bars", 6).alias("avg_bars"), expected[F.col("ivl")].alias("expected"), (F.col("avg_bars") < share * expected[F.col("ivl")]).alias("low"))


def top_by_rows(rows: DataFrame, n: int) -> DataFrame:
    """The n symbols with most rows in each interval; ties by symbol."""
    order = Window.partitionBy("ivl").orderBy(F.desc("rows"), "symbol")
    return rows.withColumn("__n", F.row_number().over(order)).where(F.col("__n") <= n).drop("__n")


def with_previous(bars: DataFrame, value: str, name: str, piece: str = "month") -> DataFrame:
    """Adds the value of a symbol's row before, in time order.

    Series are cut by time: within a piece a window gives the row before, and the first row of a piece takes the last one
    of the piece before, found among one row for each piece. So a task sorts a piece, never a whole series.
    """
    own = bars.withColumn("__piece", F.date_trunc(piece, "bar_ts"))
    within = Window.partitionBy("symbol", "__piece").orderBy("bar_ts")
    rows = own.withColumns({"__prev": F.lag(value).over(within), "__n": F.row_number().over(within)})
    # a piece's last value, at the piece that follows it: a row for each piece, not for each bar
    lasts = own.groupBy("symbol", "__piece").agg(F.max_by(F.struct(value), "bar_ts").alias("__last"))
    before = lasts.withColumn("__before", F.lag("__last").over(Window.partitionBy("symbol").orderBy("__piece"))).select("symbol", "__piece", "__before")
    carried = rows.join(before, ["symbol", "__piece"], "left")
    return carried.withColumn(name, F.when(F.col("__n") == 1, F.col(f"__before.{value}")).otherwise(F.col("__prev"))).select(*bars.columns, name)


def spikes(bars: DataFrame, ivl: str, since: str, threshold: float = 0.5) -> DataFrame:
    """Closes that move by more than the threshold from the one before, within the window of rows with a positive close."""
    own = bars.where((F.col("ivl") == ivl) & (F.col("bar_ts") >= at(since)) & (F.col("close") > 0)).select("symbol", "bar_ts", "close")
    moved = with_previous(own, "close", "prev").where(F.abs(F.col("close") - F.col("prev")) / F.col("prev") > threshold)
    return moved.select("symbol", "bar_ts", rounded("prev", 2).alias("prev_close"), rounded("close", 2).alias("close"), rounded(F.abs(F.col("close") - F.col("prev")) / F.col("prev") * 100, 1).alias("pct"))


def issue_summary(bars: DataFrame, ivl: str, since: str, threshold: float = 0.5, cap: int | None = None) -> DataFrame:
    """Counts under each rule in one pass, and spikes; zero volume is reported but not in the total."""
    own = bars.where((F.col("ivl") == ivl) & (F.col("bar_ts") >= at(since)))
    held = lambda c: F.least(c, F.lit(cap)) if cap is not None else c
    n = own.agg(
        held(F.count_if(filters.inverted())).alias("inverted"), held(F.count_if(filters.out_of_range())).alias("out_of_range"), held(F.count_if(filters.nonpositive())).alias("nonpositive"),
        F.count_if(F.col("volume") == 0).alias("zero_volume"),
    )
    both = n.crossJoin(F.broadcast(spikes(bars, ivl, since, threshold).agg(F.count("*").alias("spikes"))))  # one row each
    total = F.col("inverted") + F.col("out_of_range") + F.col("nonpositive") + F.col("spikes")
    return both.withColumns({"total_issues": total, "status": F.when(total == 0, "ok").otherwise("issues_found")})


def partition_profile(bars: DataFrame, as_of: str) -> DataFrame:
    """Rows of each date partition, and which half-year before ``as_of`` it is in."""
    today = F.lit(as_of).cast("date")
    age = F.when(F.col("day") >= F.add_months(today, -6), "recent").when(F.col("day") >= F.add_months(today, -12), "prior").otherwise("older")
    return bars.groupBy(F.to_date("bar_ts").alias("day")).agg(F.count("*").alias("rows")).withColumn("age", age)


def file_profile(df: DataFrame, warn_bytes: int) -> DataFrame:
    """Files behind a table with their bytes, and whether they are over the limit."""
    files = df.select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_size").alias("bytes")).distinct()
    return files.withColumn("large", F.col("bytes") > warn_bytes)


def action_stats(actions: DataFrame) -> DataFrame:
    div, spl = F.count_if(F.col("action_type") == "dividend"), F.count_if(F.col("action_type") == "split")
    return actions.groupBy("symbol").agg(div.alias("dividends"), spl.alias("splits"), F.count("*").alias("total"), (div > 0).alias("has_dividends"), (spl > 0).alias("has_splits"))


def run_summary(ledger: DataFrame, actions: DataFrame) -> DataFrame:
    """Outcomes and records of a run, and how many dividends and splits it brought."""
    totals = actions.agg(F.count_if(F.col("action_type") == "dividend").alias("dividends"), F.count_if(F.col("action_type") == "split").alias("splits"))  # one row
    return ledger.agg(F.count_if("success").alias("successes"), F.count_if(~F.col("success")).alias("failures"), F.sum("rows").alias("records")).crossJoin(F.broadcast(totals))


def stage(df: DataFrame, name: str, passed: Column) -> DataFrame:
    """One row of the report from a one-row result."""
    return df.select(F.lit(name).alias("stage"), passed.alias("passed"))


def report(*stages: DataFrame) -> DataFrame:
    """The stages and a last row for all of them."""
    rows = stages[0]
    for s in stages[1:]:
        rows = rows.unionByName(s)
    return rows.unionByName(rows.agg(F.lit("overall").alias("stage"), F.bool_and("passed").alias("passed")))


def last_write(bars: DataFrame, *order: str) -> DataFrame:
    """The last written row of each bar key."""
    newest = Window.partitionBy("symbol", "ivl", "bar_ts").orderBy(*[F.desc_nulls_last(c) for c in order])
    return bars.withColumn("__n", F.row_number().over(newest)).where("__n = 1").drop("__n")


def distinct_actions(actions: DataFrame) -> DataFrame:
    """One row of each symbol, type and date: the last created, then the largest amounts."""
    order = [F.desc_nulls_last(c) for c in ("created_at", "dividend_amount", "split_ratio")]
    newest = Window.partitionBy("symbol", "action_type", "action_date").orderBy(*order)
    return actions.withColumn("__n", F.row_number().over(newest)).where("__n = 1").drop("__n")
