"""Views of bars, coverage, listings and actions derived from the given tables, the same in Spark and in SQL."""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

AS_OF = "2024-01-31 00:00:00"
SNAPSHOTS = ("2024-01-08", "2024-01-15", "2024-01-22", "2024-01-29")


class Views:
    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.dir = spark, sf_dir

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.dir}/{name}.parquet")

    def ticks(self, symbol) -> DataFrame:
        return self.table("events").select(symbol.alias("symbol"), F.col("ts").cast("timestamp").alias("ts"), "event_id", F.col("value").alias("price"), (1 + F.col("event_id") % 1000).alias("qty"))

    @cached_property
    def ticks_dense(self) -> DataFrame:
        return self.ticks(F.concat(F.upper("event_type"), F.lit(".JK")))

    @cached_property
    def ticks_user(self) -> DataFrame:
        return self.ticks(F.concat(F.lit("U"), F.col("user_id").cast("string"), F.lit(".JK")))

    @staticmethod
    def bars(ticks: DataFrame, unit: str, ivl: str) -> DataFrame:
        when = F.struct("ts", "event_id")
        out = ticks.groupBy("symbol", F.date_trunc(unit, "ts").alias("bar_ts")).agg(
            F.min_by("price", when).alias("open"), F.max("price").alias("high"), F.min("price").alias("low"), F.max_by("price", when).alias("close"), F.sum("qty").alias("volume")
        )
        return out.select("symbol", F.lit(ivl).alias("ivl"), "bar_ts", "open", "high", "low", "close", "volume")

    @cached_property
    def bars_1h(self) -> DataFrame:
        return self.bars(self.ticks_dense, "hour", "1h")

    @cached_property
    def bars_d(self) -> DataFrame:
        return self.bars(self.ticks_user, "day", "d")

    @cached_property
    def bars_dirty(self) -> DataFrame:
        v = F.col("volume")
        gone, swapped = v % 11 == 0, v % 13 == 0
        price = lambda c: F.when(~gone, F.col(c))
        out = self.bars_1h.select(
            "symbol", "ivl", "bar_ts", price("open").alias("open"), F.when(swapped, price("low")).otherwise(price("high")).alias("high"), F.when(swapped, price("high")).otherwise(price("low")).alias("low"),
            F.when((v % 23 == 0) & ~gone, F.lit(0.0)).otherwise(price("close")).alias("close"), F.when(v % 17 == 0, F.lit(0)).otherwise(v).cast("long").alias("volume"), (v % 19 == 0).alias("twice"),
        )
        return out.drop("twice").unionByName(out.where("twice").drop("twice"))

    @cached_property
    def store_eod(self) -> DataFrame:
        return self.bars_d.where("volume % 10 <> 0")

    @cached_property
    def vendor_eod(self) -> DataFrame:
        v = F.col("volume")
        return self.bars_d.where("volume % 7 <> 0").select(
            "symbol", "ivl", "bar_ts", F.when(v % 2 == 0, F.col("open") + 0.005).otherwise(F.col("open")).alias("open"), "high", "low",
            F.when(v % 5 == 0, F.col("close") + 0.02).otherwise(F.col("close")).alias("close"), F.when(v % 3 == 0, v + 1).otherwise(v).alias("volume"),
        )

    @cached_property
    def coverage_hist(self) -> DataFrame:
        snaps = F.explode(F.array(*[F.lit(f"{d} 00:00:00").cast("timestamp") for d in SNAPSHOTS])).alias("last_updated")
        seen = self.bars_d.select("symbol", "ivl", "bar_ts", snaps).where("bar_ts <= last_updated")
        return seen.groupBy("symbol", "ivl", "last_updated").agg(F.count("*").alias("total_records"), F.min("bar_ts").alias("data_start"), F.max("bar_ts").alias("data_end"))

    @cached_property
    def listing_raw(self) -> DataFrame:
        own = self.table("customer").where("c_mktsegment <> 'BUILDING'")
        none = F.lit(None).cast("string")
        return own.select(
            F.concat(F.lit("U"), F.col("c_custkey").cast("string")).alias("Code"), F.col("c_name").alias("Name"), F.lit("JK").alias("Exchange"), none.alias("Sector"), none.alias("Industry"),
            F.when(F.col("c_custkey") % 4 != 0, "IDR").alias("Currency"),
        )

    @cached_property
    def tracked(self) -> DataFrame:
        return self.table("customer").where("c_acctbal >= 0").select(F.concat(F.lit("U"), F.col("c_custkey").cast("string"), F.lit(".JK")).alias("symbol"))

    @cached_property
    def actions_raw(self) -> DataFrame:
        n = F.col("l_linenumber")
        return self.table("lineitem").select(
            F.concat(F.lit("S"), F.col("l_suppkey").cast("string"), F.when(n % 2 == 1, ".JK").otherwise("")).alias("code"),
            F.when(n == 7, "").when(n == 6, "bad").otherwise(F.to_date("l_shipdate").cast("string")).alias("date"), F.round(F.col("l_discount") * 100).cast("int").cast("string").alias("value"),
            F.concat(F.col("l_quantity").cast("int").cast("string"), F.when(F.col("l_returnflag") == "A", ".0").otherwise(""), F.when(F.col("l_returnflag") == "R", ":").otherwise("/"), n.cast("string")).alias("split"),
        )

    @cached_property
    def stored_1h(self) -> DataFrame:
        return self.bars_1h.where("volume % 10 <> 0")


SQL = f"""
WITH ticks_dense AS (SELECT concat(upper(event_type), '.JK') AS symbol, ts, event_id, value AS price, 1 + event_id % 1000 AS qty FROM events),
ticks_user AS (SELECT concat('U', user_id, '.JK') AS symbol, ts, event_id, value AS price, 1 + event_id % 1000 AS qty FROM events),
bars_1h AS (
  SELECT symbol, '1h' AS ivl, CAST(date_trunc('hour', ts) AS TIMESTAMP) AS bar_ts, first(price ORDER BY ts, event_id) AS open, max(price) AS high, min(price) AS low, last(price ORDER BY ts, event_id) AS close,
    CAST(sum(qty) AS BIGINT) AS volume FROM ticks_dense GROUP BY 1, 2, 3),
bars_d AS (
  SELECT symbol, 'd' AS ivl, CAST(date_trunc('day', ts) AS TIMESTAMP) AS bar_ts, first(price ORDER BY ts, event_id) AS open, max(price) AS high, min(price) AS low, last(price ORDER BY ts, event_id) AS close,
    CAST(sum(qty) AS BIGINT) AS volume FROM ticks_user GROUP BY 1, 2, 3),
spoilt AS (
  SELECT symbol, ivl, bar_ts, CASE WHEN volume % 11 <> 0 THEN open END AS open, CASE WHEN volume % 11 <> 0 THEN CASE WHEN volume % 13 = 0 THEN low ELSE high END END AS high,
    CASE WHEN volume % 11 <> 0 THEN CASE WHEN volume % 13 = 0 THEN high ELSE low END END AS low, CASE WHEN volume % 11 <> 0 THEN CASE WHEN volume % 23 = 0 THEN 0.0 ELSE close END END AS close,
    CASE WHEN volume % 17 = 0 THEN 0 ELSE volume END AS volume, volume % 19 = 0 AS twice FROM bars_1h),
bars_dirty AS (SELECT * EXCLUDE (twice) FROM spoilt UNION ALL SELECT * EXCLUDE (twice) FROM spoilt WHERE twice),
store_eod AS (SELECT * FROM bars_d WHERE volume % 10 <> 0),
stored_1h AS (SELECT * FROM bars_1h WHERE volume % 10 <> 0),
vendor_eod AS (
  SELECT symbol, ivl, bar_ts, CASE WHEN volume % 2 = 0 THEN open + 0.005 ELSE open END AS open, high, low, CASE WHEN volume % 5 = 0 THEN close + 0.02 ELSE close END AS close,
    CASE WHEN volume % 3 = 0 THEN volume + 1 ELSE volume END AS volume FROM bars_d WHERE volume % 7 <> 0),
snapshots AS (SELECT CAST(unnest({list(SNAPSHOTS)}) AS TIMESTAMP) AS last_updated),
coverage_hist AS (
  SELECT symbol, ivl, last_updated, count(*) AS total_records, min(bar_ts) AS data_start, max(bar_ts) AS data_end FROM bars_d JOIN snapshots ON bar_ts <= last_updated GROUP BY 1, 2, 3),
latest AS (SELECT * FROM coverage_hist QUALIFY row_number() OVER (PARTITION BY symbol, ivl ORDER BY last_updated DESC) = 1),
listing_raw AS (
  SELECT concat('U', c_custkey) AS Code, c_name AS Name, 'JK' AS Exchange, CAST(NULL AS VARCHAR) AS Sector, CAST(NULL AS VARCHAR) AS Industry, CASE WHEN c_custkey % 4 <> 0 THEN 'IDR' END AS Currency
  FROM customer WHERE c_mktsegment <> 'BUILDING'),
tracked AS (SELECT concat('U', c_custkey, '.JK') AS symbol FROM customer WHERE c_acctbal >= 0),
actions_raw AS (
  SELECT concat('S', l_suppkey, CASE WHEN l_linenumber % 2 = 1 THEN '.JK' ELSE '' END) AS code, CASE l_linenumber WHEN 7 THEN '' WHEN 6 THEN 'bad' ELSE strftime(l_shipdate, '%Y-%m-%d') END AS date,
    CAST(CAST(round(l_discount * 100) AS INTEGER) AS VARCHAR) AS value,
    concat(CAST(l_quantity AS INTEGER), CASE WHEN l_returnflag = 'A' THEN '.0' ELSE '' END, CASE WHEN l_returnflag = 'R' THEN ':' ELSE '/' END, l_linenumber) AS split FROM lineitem),
qualified AS (SELECT *, CASE WHEN contains(code, '.') THEN code ELSE concat(code, '.JK') END AS symbol, TRY_CAST(nullif(date, '') AS DATE) AS day FROM actions_raw),
four AS (
  SELECT symbol, '4h' AS ivl, start AS bar_ts, first(open ORDER BY bar_ts) AS open, max(high) AS high, min(low) AS low, last(close ORDER BY bar_ts) AS close, CAST(sum(volume) AS BIGINT) AS volume, 0 AS gmtoffset, 'aggregated' AS source
  FROM (SELECT *, date_trunc('day', bar_ts) + CASE WHEN hour(bar_ts) IN (2, 3, 4) THEN INTERVAL 2 HOUR ELSE INTERVAL 6 HOUR END AS start FROM bars_1h WHERE hour(bar_ts) IN (2, 3, 4, 6, 7, 8, 9) AND open IS NOT NULL)
  GROUP BY symbol, start)
"""
