"""Exchange sessions and bars made of finer bars."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scalar import local_time

# The hours must be these for the same bars as other tools make.
#: Session name: UTC hours that belong to it, and the hour its bar starts at.
SESSIONS = {"AM": ((2, 3, 4), 2), "PM": ((6, 7, 8, 9), 6)}


def session_of(ts: str, sessions: dict = SESSIONS) -> tuple[Column, Column]:
    """Name and start of the session that a bar belongs to; null outside all."""
    name, start = None, None
    for label, (hours, first) in sessions.items():
        inside, anchor = F.hour(ts).isin(*hours), F.date_trunc("day", ts) + F.expr(f"interval {first} hours")
        name = F.when(inside, label) if name is None else name.when(inside, label)
        start = F.when(inside, anchor) if start is None else start.when(inside, anchor)
    return name, start


def with_session(bars: DataFrame) -> DataFrame:
    name, start = session_of("bar_ts")
    return bars.withColumns({"session": name, "session_ts": start})


def with_local_time(bars: DataFrame, zone: str = "Asia/Jakarta") -> DataFrame:
    local = local_time("bar_ts", zone)
    return bars.withColumns({"local_ts": local, "half": F.when(F.hour(local) < 12, "AM").otherwise("PM")})


def in_session(bars: DataFrame, since: str | None = None, symbols: Sequence[str] | None = None) -> DataFrame:
    """1h bars with an open price in a session's hours."""
    hours = [h for hs, _ in SESSIONS.values() for h in hs]
    own = bars.where((F.col("ivl") == "1h") & F.hour("bar_ts").isin(*hours) & F.col("open").isNotNull())
    if since is not None:
        own = own.where(F.col("bar_ts") >= F.lit(since).cast("timestamp"))
    return own if symbols is None else own.where(F.col("symbol").isin(list(symbols)))


def rolled(bars: DataFrame, start: Column, *keys: str) -> DataFrame:
    """One bar for each key and start: first open, extremes, last close, summed volume. All of it combines before the shuffle.

    A bar that stands twice counts twice: of a feed with repeated keys, take ``audit.last_write`` first.
    """
    adjusted = [F.max_by("adjusted_close", "bar_ts").alias("adjusted_close")] if "adjusted_close" in bars.columns else []
    return bars.groupBy("symbol", *keys, start.alias("start")).agg(
        F.min_by("open", "bar_ts").alias("open"), F.max("high").alias("high"), F.min("low").alias("low"), F.max_by("close", "bar_ts").alias("close"), *adjusted, F.sum("volume").alias("volume")
    ).withColumnRenamed("start", "bar_ts")


def session_bars(bars: DataFrame, since: str | None = None, symbols: Sequence[str] | None = None) -> DataFrame:
    """4h bars: one for each exchange session, not for each four hours."""
    out = rolled(in_session(bars, since, symbols), session_of("bar_ts")[1])
    return out.select("symbol", F.lit("4h").alias("ivl"), *[c for c in out.columns if c != "symbol"], F.lit(0).alias("gmtoffset"), F.lit("aggregated").alias("source"))


def incremental_since(as_of: str, update_window: int = 7) -> Column:
    """Re-aggregation starts three days before the correction window, that being seven days at least."""
    return F.lit(as_of).cast("timestamp") - F.expr(f"interval {max(update_window, 7) + 3} days")


def session_bars_incremental(bars: DataFrame, as_of: str, update_window: int = 7) -> DataFrame:
    return session_bars(bars.where(F.col("bar_ts") >= incremental_since(as_of, update_window)))


def preview(four: DataFrame, n: int = 10) -> DataFrame:
    """The first n session bars, each with the number of all bars and symbols."""
    totals = four.agg(F.count("*").alias("candles"), F.countDistinct("symbol").alias("symbols"))
    return four.orderBy("symbol", "bar_ts").limit(n).crossJoin(F.broadcast(totals))  # one row


def resample(bars: DataFrame, ivl: str) -> DataFrame:
    """Bars of a longer interval: w and m by the calendar, minutes and hours by windows from midnight UTC."""
    if ivl in ("w", "m"):
        start = F.date_trunc({"w": "week", "m": "month"}[ivl], "bar_ts")
    else:
        start = F.window("bar_ts", {"15m": "15 minutes", "30m": "30 minutes", "1h": "1 hour"}[ivl])["start"]
    out = rolled(bars, start)
    return out.select("symbol", F.lit(ivl).alias("ivl"), *[c for c in out.columns if c != "symbol"])


def compared_session_bars(bars: DataFrame, stored: DataFrame) -> DataFrame:
    """Session bars made again next to the stored ones, with the number of 1h bars behind each."""
    counts = in_session(bars).groupBy("symbol", session_of("bar_ts")[1].alias("bar_ts")).agg(F.count("*").alias("hours"))
    made = session_bars(bars).select("symbol", "bar_ts", F.col("close").alias("made_close"), F.col("volume").alias("made_volume")).join(counts, ["symbol", "bar_ts"])
    kept = stored.select("symbol", "bar_ts", F.col("close").alias("stored_close"), F.col("volume").alias("stored_volume"))
    both = made.join(kept, ["symbol", "bar_ts"], "full_outer")
    return both.withColumn("same", F.col("made_close").eqNullSafe(F.col("stored_close")) & F.col("made_volume").eqNullSafe(F.col("stored_volume")))


def minute_start(minutes: int) -> Column:
    at = F.unix_micros("bar_ts")
    return F.timestamp_micros(at - F.pmod(at, F.lit(minutes * 60_000_000)))


#: Levels of the cascade, each with the start of its bars; ``4h`` stands for the exchange's sessions.
LEVELS = {
    "5m": lambda: minute_start(5), "15m": lambda: minute_start(15), "30m": lambda: minute_start(30),
    "1h": lambda: F.date_trunc("hour", "bar_ts"), "4h": lambda: session_of("bar_ts")[1], "d": lambda: F.date_trunc("day", "bar_ts"), "w": lambda: F.date_trunc("week", "bar_ts"), "m": lambda: F.date_trunc("month", "bar_ts"),
}


def cascade(bars: DataFrame, levels: Sequence[str] = tuple(LEVELS)) -> DataFrame:
    """Bars of all levels from one scan of minute bars.

    The bars are rolled up to the finest level first. Each of these then goes to its bar of every further level, and they
    are combined before they are shuffled. Bars merge: the first open and last close of a level are those of the
    earliest and latest finer bars, so every level is what it would be if it were made of the minute bars. Minutes
    without an open price do not count.
    """
    finest, *rest = sorted(levels, key=list(LEVELS).index)
    first = rolled(bars.where(F.col("open").isNotNull()), LEVELS[finest]())
    starts = F.array(*[F.struct(F.lit(n).alias("ivl"), LEVELS[n]().alias("start")) for n in [finest, *rest]])
    each = first.withColumn("__level", F.explode(starts)).where(F.col("__level.start").isNotNull()).select("*", F.col("__level.ivl").alias("ivl"), F.col("__level.start").alias("__start"))
    out = rolled(each.drop("__level"), F.col("__start"), "ivl")
    return out.select("symbol", "ivl", *[c for c in out.columns if c not in ("symbol", "ivl")])
