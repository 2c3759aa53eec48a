"""Comparing and merging bar sets by key."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.schemas import KEY, OHLC


def new_bars(batch: DataFrame, stored: DataFrame) -> DataFrame:
    """Bars of the batch whose key is not stored."""
    return batch.join(stored.select(*KEY), list(KEY), "left_anti")


def new_bars_window(batch: DataFrame, stored: DataFrame, start: str, end: str) -> DataFrame:
    """As new_bars, against the stored bars of [start, end)."""
    near = stored.select(*KEY).where((F.col("bar_ts") >= F.lit(start).cast("timestamp")) & (F.col("bar_ts") < F.lit(end).cast("timestamp")))
    return batch.join(near, list(KEY), "left_anti")


def digests(bars: DataFrame, unit: str, group: str) -> DataFrame:
    """For each symbol and stretch of time an order-free digest of its rows as ``reconcile`` compares them: their number and two sums of 64-bit hashes."""
    at = F.date_trunc(unit, "bar_ts")
    row = [F.col("symbol"), F.unix_micros(at), *[F.coalesce(F.col(c).cast("double"), F.lit(0.0)) for c in OHLC], F.coalesce("volume", F.lit(0)).cast("long")]
    total = lambda h: F.sum(h.cast("decimal(20, 0)"))  # noqa: E731  does not wrap
    return bars.groupBy("symbol", F.date_trunc(group, at).alias("__group")).agg(F.count("*").alias("n"), total(F.xxhash64(*row)).alias("a"), total(F.xxhash64(F.lit("again"), *reversed(row))).alias("b"))


def reconcile_by_digest(vendor: DataFrame, stored: DataFrame, unit: str = "day", tolerance: float = 0.01, group: str = "month") -> DataFrame:
    """As ``reconcile``; rows are joined only for symbols and months whose digests differ, so equal months are not shuffled by row.

    Months count as equal if both sides have as many rows and both sums of their hashes agree. Symbols that are null are
    compared by row, as no key is equal to a null one.
    """
    v, s = digests(vendor, unit, group), digests(stored, unit, group)
    both = v.join(s.withColumnsRenamed({c: f"s_{c}" for c in ("n", "a", "b")}), ["symbol", "__group"], "full_outer")
    same = (F.col("n") == F.col("s_n")) & (F.col("a") == F.col("s_a")) & (F.col("b") == F.col("s_b"))
    unequal = both.where(~F.coalesce(same, F.lit(False)) & F.col("symbol").isNotNull()).select("symbol", "__group")

    def left(bars: DataFrame) -> DataFrame:
        own = bars.withColumn("__group", F.date_trunc(group, F.date_trunc(unit, "bar_ts")))
        return own.where("symbol is not null").join(unequal, ["symbol", "__group"], "left_semi").unionByName(own.where("symbol is null")).drop("__group")

    return reconcile(left(vendor), left(stored), unit, tolerance)


def common_rows(a: DataFrame, b: DataFrame) -> DataFrame:
    """Rows that both have, as often as both have them: ``intersectAll`` with one count less, and rows repeated without leaving generated code."""
    n, m = F.sum("__a"), F.count("*") - F.sum("__a")
    both = a.withColumn("__a", F.lit(1)).unionByName(b.withColumn("__a", F.lit(0))).groupBy(*a.columns).agg(F.least(n, m).cast("int").alias("__n"))
    return both.where("__n > 0").withColumn("__i", F.explode(F.sequence(F.lit(1), F.col("__n")))).select(*a.columns)


def reconcile(vendor: DataFrame, stored: DataFrame, unit: str = "day", tolerance: float = 0.01) -> DataFrame:
    """Differences by symbol and truncated time: only_vendor, only_store (informational), mismatch with its fields.

    A null counts as 0; prices may differ by the tolerance, volumes not at all.
    """
    fields = [*OHLC, "volume"]
    key = F.date_trunc(unit, "bar_ts").alias("at_ts")
    v = vendor.select("symbol", key, *[F.coalesce(c, F.lit(0)).alias(f"v_{c}") for c in fields])
    s = stored.select("symbol", key, *[F.coalesce(c, F.lit(0)).alias(f"s_{c}") for c in fields])
    both = v.join(s, ["symbol", "at_ts"], "full_outer")
    off = [F.when(F.abs(F.col(f"v_{c}") - F.col(f"s_{c}")) > tolerance, c) for c in OHLC] + [F.when(F.col("v_volume") != F.col("s_volume"), "volume")]
    kind = F.when(F.col("s_volume").isNull(), "only_vendor").when(F.col("v_volume").isNull(), "only_store").otherwise("mismatch")
    named = both.select("symbol", "at_ts", kind.alias("kind"), F.concat_ws(",", *off).alias("fields"))
    return named.where((F.col("kind") != "mismatch") | (F.col("fields") != ""))
