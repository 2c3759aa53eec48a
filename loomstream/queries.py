"""Queries: each operator applied to whole tables or views of them, and its SQL.

Timestamps and dates leave as text, so both engines show them alike.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .functions import scalar
from .operators import audit, coverage, filters, joins, normalize, sessions
from .plans import store as st
from .plans.rollup import CoverageRollup
from .sources import feeds
from .sources.fixtures import AS_OF, SQL, Views
from .streaming import ingest

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}
SINCE = "2024-01-10 00:00:00"


def edge(df: DataFrame) -> DataFrame:
    kinds = {"timestamp": lambda c: F.date_format(c, "yyyy-MM-dd HH:mm:ss"), "date": lambda c: F.col(c).cast("string")}
    return df.select(*[kinds[t](c).alias(c) if t in kinds else F.col(c) for c, t in df.dtypes])


def query(name: str, sql: str | None = None, times: str = ""):
    """Registers a query of views; ``times``: columns of the SQL that are timestamps or dates."""

    def keep(make: Callable[[Views], DataFrame]):
        QUERIES[name] = lambda spark, sf_dir: edge(make(Views(spark, sf_dir)))
        if sql is not None:
            shown = f" REPLACE ({', '.join(f'CAST({c} AS VARCHAR) AS {c}' for c in times.split())})" if times else ""
            ORACLES[name] = f"{SQL} SELECT *{shown} FROM ({sql})"
        return make

    return keep


def simple(name: str, make: Callable[[Views], DataFrame], sql: str | None = None, times: str = "") -> None:
    query(name, sql, times)(make)


# --- sources ---------------------------------------------------------------------------------------------------------


def landed(df: DataFrame, *partitions: str) -> str:
    """Writes the rows as a landed JSON feed."""
    path = st.scratch_dir(df.sparkSession)
    df.write.partitionBy(*partitions).json(path) if partitions else df.write.json(path)
    return path


def eod_feed(v: Views) -> DataFrame:
    return v.vendor_eod.select("symbol", F.col("ivl").alias("period"), F.date_format("bar_ts", "yyyy-MM-dd").alias("date"), "open", "high", "low", "close", F.col("close").alias("adjusted_close"), "volume")


def intraday_feed(v: Views) -> DataFrame:
    return v.bars_dirty.select("symbol", F.col("ivl").alias("period"), F.unix_timestamp("bar_ts").alias("timestamp"), "open", "high", "low", "close", "volume", F.lit(25200).alias("gmtoffset"))


def bulk_feed(v: Views) -> DataFrame:
    return eod_feed(v).select(F.regexp_replace("symbol", r"\.JK$", "").alias("code"), "date", *[F.col(c).cast("string").alias(c) for c in ("open", "high", "low", "close", "adjusted_close", "volume")])


def dividend_feed(v: Views) -> DataFrame:
    none = F.lit(None).cast("string")
    own = v.actions_raw
    later = F.when(F.col("date") == "", "2024-2-5").otherwise(none)
    return own.select("code", "date", later.alias("ex_date"), none.alias("exDate"), "value", none.alias("dividend"), none.alias("currency"), F.col("date").alias("paymentDate"), none.alias("recordDate"), none.alias("declarationDate"), none.alias("period"))


def per_symbol(v: Views) -> DataFrame:
    return dividend_feed(v).withColumn("symbol", scalar.qualified("code")).drop("code")


read = {
    "src_eod_json": lambda v: feeds.read_feed(v.spark, landed(eod_feed(v), "period"), feeds.schemas.EOD + ", symbol string", "period string"),
    "src_intraday_json": lambda v: feeds.read_feed(v.spark, landed(intraday_feed(v), "period"), feeds.schemas.INTRADAY + ", symbol string", "period string"),
    "src_bulk_json": lambda v: feeds.read_bulk(v.spark, landed(bulk_feed(v))),
    "src_dividends_json": lambda v: feeds.read_bulk(v.spark, landed(dividend_feed(v)), "dividends").select("code", "date", "ex_date", "value", "paymentDate"),
    "src_splits_json": lambda v: feeds.read_bulk(v.spark, landed(v.actions_raw.select("code", "date", "split")), "splits").select("code", "date", "split"),
    "src_listing_json": lambda v: feeds.read_listing(v.spark, landed(v.listing_raw)).select("Code", "Name", "Exchange", "Currency"),
}
EOD_SQL = "SELECT symbol, ivl AS period, strftime(bar_ts, '%Y-%m-%d') AS date, open, high, low, close, close AS adjusted_close, volume FROM vendor_eod"
simple("src_eod_json", read["src_eod_json"], EOD_SQL)
simple("src_intraday_json", read["src_intraday_json"], "SELECT symbol, ivl AS period, CAST(epoch(bar_ts) AS BIGINT) AS timestamp, open, high, low, close, volume, 25200 AS gmtoffset FROM bars_dirty")
simple("src_bulk_json", lambda v: read["src_bulk_json"](v).select("code", "date", F.col("open").cast("double").alias("open"), F.col("volume").cast("long").alias("volume")), f"SELECT replace(symbol, '.JK', '') AS code, date, open, volume FROM ({EOD_SQL})")
simple("src_dividends_json", read["src_dividends_json"], "SELECT code, date, CASE WHEN date = '' THEN '2024-2-5' END AS ex_date, value, date AS paymentDate FROM actions_raw")
simple("src_splits_json", read["src_splits_json"], "SELECT code, date, split FROM actions_raw")
simple("src_listing_json", read["src_listing_json"], "SELECT Code, Name, Exchange, Currency FROM listing_raw")
simple(
    "src_listing_first_hit", lambda v: feeds.first_hit(read["src_listing_json"](v).unionByName(read["src_listing_json"](v).withColumn("Name", F.concat(F.lit("A "), "Name"))), "Code", "Name").select("Code", "Name"),
    "SELECT Code, min(Name) AS Name FROM (SELECT Code, Name FROM listing_raw UNION ALL SELECT Code, concat('A ', Name) FROM listing_raw) GROUP BY 1",
)
symbol_dividends = lambda v: per_symbol(v).select("symbol", "date", F.col("value").cast("double").alias("value"), "currency", "paymentDate", "recordDate", "declarationDate", "period")
QUALIFIED_CODE = "CASE WHEN contains(code, '.') THEN code ELSE concat(code, '.JK') END AS symbol"
simple("src_dividends_symbol_json", lambda v: feeds.read_dividends(v.spark, landed(symbol_dividends(v))).select("symbol", "date", "value", "paymentDate"), f"SELECT {QUALIFIED_CODE}, date, CAST(value AS DOUBLE) AS value, date AS paymentDate FROM actions_raw")
simple("src_splits_symbol_json", lambda v: feeds.read_splits(v.spark, landed(v.actions_raw.select(scalar.qualified("code").alias("symbol"), "date", "split"))).select("symbol", "date", "split"), f"SELECT {QUALIFIED_CODE}, date, split FROM actions_raw")


@query("src_symbol_list", "SELECT concat('U', c_custkey, '.JK') AS symbol FROM customer WHERE c_custkey % 5 <> 0 AND c_custkey % 7 <> 0")
def _(v: Views) -> DataFrame:
    key, name = F.col("c_custkey"), F.concat(F.lit("U"), F.col("c_custkey").cast("string"))
    lines = v.table("customer").select(F.when(key % 5 == 0, F.concat(F.lit("# "), name)).when(key % 7 == 0, "  ").when(key % 2 == 0, F.concat(F.lit(" "), name, F.lit(".JK "))).otherwise(name).alias("value"))
    path = st.scratch_dir(v.spark)
    lines.write.text(path)
    return feeds.symbol_list(v.spark.read.text(path))


BAR = "symbol, ivl, bar_ts, open, high, low, close, volume"


def shown_bars(bars: DataFrame) -> DataFrame:
    return bars.select(*BAR.split(", "))


def stored(v: Views, bars: DataFrame) -> st.BarStore:
    store = st.BarStore(v.spark, st.scratch_dir(v.spark), file_rows=100_000)
    store.upsert(bars)
    return store


simple("src_bars_range", lambda v: shown_bars(feeds.bars_range(stored(v, v.bars_1h), "CLICK.JK", "1h", SINCE, "2024-01-20 12:00:00")), f"SELECT {BAR} FROM bars_1h WHERE symbol = 'CLICK.JK' AND bar_ts BETWEEN '{SINCE}' AND '2024-01-20 12:00:00' ORDER BY bar_ts LIMIT 500", "bar_ts")
simple("src_bars_recent", lambda v: shown_bars(feeds.bars_recent(stored(v, v.bars_d), 1000)), f"SELECT {BAR} FROM bars_d ORDER BY bar_ts DESC, symbol LIMIT 1000", "bar_ts")
simple("src_bars_lookback", lambda v: shown_bars(feeds.bars_lookback(stored(v, v.bars_1h), ["CLICK.JK", "VIEW.JK"], AS_OF, days=7)), f"SELECT {BAR} FROM bars_1h WHERE symbol IN ('CLICK.JK', 'VIEW.JK') AND bar_ts > TIMESTAMP '{AS_OF}' - INTERVAL 7 DAY", "bar_ts")

# --- normalisation ---------------------------------------------------------------------------------------------------

TYPED = f"symbol, ivl, bar_ts, open, high, low, close, adjusted_close, volume, gmtoffset, source, TIMESTAMP '{AS_OF}' AS created_at"
simple("norm_eod", lambda v: normalize.eod(eod_feed(v), AS_OF), f"SELECT {TYPED} FROM (SELECT *, close AS adjusted_close, CAST(NULL AS INTEGER) AS gmtoffset, 'eod' AS source FROM vendor_eod)", "bar_ts created_at")
RAW = f"SELECT {TYPED} FROM (SELECT *, CAST(NULL AS DOUBLE) AS adjusted_close, 25200 AS gmtoffset, 'intraday' AS source FROM bars_dirty)"
simple("norm_intraday_raw", lambda v: normalize.intraday_raw(intraday_feed(v), AS_OF), RAW, "bar_ts created_at")
simple("norm_intraday", lambda v: normalize.intraday(intraday_feed(v), AS_OF), f"SELECT * FROM ({RAW}) WHERE open IS NOT NULL OR hour(bar_ts) BETWEEN 9 AND 15", "bar_ts created_at")
simple("norm_intraday_backfill", lambda v: normalize.intraday_backfill(intraday_feed(v), AS_OF), f"SELECT * FROM ({RAW}) WHERE (coalesce(open, 0) <> 0 AND coalesce(high, 0) <> 0 AND coalesce(low, 0) <> 0 AND coalesce(close, 0) <> 0) OR hour(bar_ts) BETWEEN 9 AND 15", "bar_ts created_at")
simple("norm_bulk_eod", lambda v: normalize.bulk_eod(bulk_feed(v), AS_OF), f"SELECT {TYPED} FROM (SELECT *, close AS adjusted_close, CAST(NULL AS INTEGER) AS gmtoffset, 'eod_bulk' AS source FROM vendor_eod)", "bar_ts created_at")


def action_sql(source: str, kind: str, amount: str = "NULL", currency: str = "NULL", paid: str = "NULL", ratio: str = "NULL", left: str = "NULL", right: str = "NULL") -> str:
    return (
        f"SELECT symbol, '{kind}' AS action_type, day AS action_date, CAST({amount} AS DOUBLE) AS dividend_amount, CAST({currency} AS VARCHAR) AS dividend_currency, CAST({paid} AS DATE) AS payment_date, CAST(NULL AS DATE) AS record_date, "
        f"CAST(NULL AS DATE) AS declaration_date, CAST(NULL AS VARCHAR) AS dividend_type, CAST({ratio} AS VARCHAR) AS split_ratio, CAST({left} AS INTEGER) AS split_from, CAST({right} AS INTEGER) AS split_to, TIMESTAMP '{AS_OF}' AS created_at FROM {source}"
    )


ACTION_TIMES = "action_date payment_date record_date declaration_date created_at"
DIV_SQL = action_sql("(SELECT * FROM qualified WHERE date <> '')", "dividend", "value", "'IDR'", "TRY_CAST(date AS DATE)")
DIV_BULK_SQL = action_sql("(SELECT * REPLACE (coalesce(day, CASE WHEN date = '' THEN DATE '2024-02-05' END) AS day) FROM qualified WHERE date = '' OR day IS NOT NULL)", "dividend", "value", "'IDR'", "TRY_CAST(date AS DATE)")
LEFT_INT = "CASE WHEN contains(split, '/') AND NOT contains(split, '.') THEN TRY_CAST(split_part(split, '/', 1) AS INTEGER) END"
RIGHT_INT = "CASE WHEN contains(split, '/') AND NOT contains(split, '.') THEN TRY_CAST(split_part(split, '/', 2) AS INTEGER) END"
LEFT_ANY = "CASE WHEN contains(split, '/') THEN CAST(TRY_CAST(split_part(split, '/', 1) AS DOUBLE) AS INTEGER) END"
RIGHT_ANY = "CASE WHEN contains(split, '/') THEN CAST(TRY_CAST(split_part(split, '/', 2) AS DOUBLE) AS INTEGER) END"
SPLIT_SQL = action_sql("(SELECT * FROM qualified WHERE date <> '')", "split", ratio="split", left=LEFT_INT, right=RIGHT_INT)
SPLIT_BULK_SQL = action_sql("(SELECT * FROM qualified WHERE day IS NOT NULL)", "split", ratio="split", left=LEFT_ANY, right=RIGHT_ANY)
split_feed = lambda v: v.actions_raw.select("code", "date", F.lit(None).cast("string").alias("split_date"), "split", scalar.qualified("code").alias("symbol"))
simple("norm_dividend", lambda v: normalize.dividends(per_symbol(v), AS_OF), DIV_SQL, ACTION_TIMES)
simple("norm_dividend_bulk", lambda v: normalize.dividends_bulk(dividend_feed(v), AS_OF), DIV_BULK_SQL, ACTION_TIMES)
simple("norm_split", lambda v: normalize.splits(split_feed(v), AS_OF), SPLIT_SQL, ACTION_TIMES)
simple("norm_split_bulk", lambda v: normalize.splits_bulk(split_feed(v), AS_OF), SPLIT_BULK_SQL, ACTION_TIMES)
simple("norm_symbol_qualify", lambda v: normalize.qualify_codes(v.actions_raw), "SELECT code, symbol FROM qualified")
simple("norm_symbol_suffix", lambda v: normalize.suffix_codes(v.actions_raw), "SELECT code, CASE WHEN ends_with(code, '.JK') THEN code ELSE concat(code, '.JK') END AS symbol FROM actions_raw")
LISTING_SQL = f"SELECT concat(Code, '.JK') AS symbol, 'JK' AS exchange, coalesce(Name, '') AS name, '' AS sector, '' AS industry, coalesce(Currency, 'IDR') AS currency, true AS is_active, TIMESTAMP '{AS_OF}' AS created_at FROM listing_raw"
simple("norm_listing", lambda v: normalize.listing(v.listing_raw, AS_OF), LISTING_SQL, "created_at")
simple("src_instruments", lambda v: feeds.instruments(normalize.listing(v.listing_raw, AS_OF)), f"SELECT * EXCLUDE (created_at) FROM ({LISTING_SQL})")
simple("src_actions_recent", lambda v: feeds.actions_recent(normalize.splits_bulk(split_feed(v), AS_OF)).select("symbol", "action_type", "action_date", "split_ratio"), "SELECT symbol, 'split' AS action_type, day AS action_date, split AS split_ratio FROM qualified WHERE day IS NOT NULL", "action_date")
simple(
    "fn_safe_cast",
    lambda v: v.actions_raw.select("code", "date", "split", scalar.safe_date("date").alias("as_date"), scalar.safe_double(F.split("split", "/")[0]).alias("as_double"), scalar.safe_int("value").alias("as_int")),
    "SELECT code, date, split, day AS as_date, TRY_CAST(split_part(split, '/', 1) AS DOUBLE) AS as_double, TRY_CAST(value AS BIGINT) AS as_int FROM qualified", "as_date",
)
SESSION_SQL = "CASE WHEN hour(bar_ts) IN (2, 3, 4) THEN 'AM' WHEN hour(bar_ts) IN (6, 7, 8, 9) THEN 'PM' END"
START_SQL = "CASE WHEN hour(bar_ts) IN (2, 3, 4) THEN date_trunc('day', bar_ts) + INTERVAL 2 HOUR WHEN hour(bar_ts) IN (6, 7, 8, 9) THEN date_trunc('day', bar_ts) + INTERVAL 6 HOUR END"
simple("proj_session_4h", lambda v: sessions.with_session(v.bars_1h), f"SELECT {BAR}, {SESSION_SQL} AS session, {START_SQL} AS session_ts FROM bars_1h", "bar_ts session_ts")
simple("proj_local_time", lambda v: sessions.with_local_time(v.bars_1h), f"SELECT {BAR}, bar_ts + INTERVAL 7 HOUR AS local_ts, CASE WHEN hour(bar_ts + INTERVAL 7 HOUR) < 12 THEN 'AM' ELSE 'PM' END AS half FROM bars_1h", "bar_ts local_ts")
simple("fn_interval_family", lambda v: v.bars_d.select("ivl").union(v.bars_1h.select("ivl")).groupBy(scalar.interval_family("ivl").alias("family")).agg(F.count("*").alias("n")), "SELECT CASE ivl WHEN '1h' THEN 'intraday' ELSE 'eod' END AS family, count(*) AS n FROM (SELECT ivl FROM bars_d UNION ALL SELECT ivl FROM bars_1h) GROUP BY 1")
simple("fn_last_trading_day", lambda v: v.bars_d.select(F.to_date("bar_ts").alias("day")).distinct().select("day", scalar.last_trading_day("day").alias("trading_day")), "SELECT DISTINCT CAST(bar_ts AS DATE) AS day, CAST(bar_ts AS DATE) - CAST(greatest(isodow(bar_ts) - 5, 0) AS INTEGER) AS trading_day FROM bars_d", "day trading_day")

# --- filters ---------------------------------------------------------------------------------------------------------

VALID = "coalesce(high >= low AND high >= open AND high >= close AND low <= open AND low <= close, false)"
simple("filt_null_ohlc", lambda v: filters.null_report(v.bars_dirty), "SELECT count(*) AS total, count(*) FILTER (WHERE open IS NULL) AS dropped, round(100.0 * count(*) FILTER (WHERE open IS NULL) / count(*), 2) AS dropped_pct FROM bars_dirty")
simple("pred_ohlc_valid", lambda v: filters.with_validity(v.bars_dirty), f"SELECT {BAR}, {VALID} AS valid FROM bars_dirty", "bar_ts")
simple("filt_valid_ohlc", lambda v: filters.valid_only(v.bars_dirty), f"SELECT {BAR} FROM bars_dirty WHERE {VALID}", "bar_ts")
simple("filt_null_market_hours", lambda v: normalize.keep_null_in_hours(v.bars_dirty), f"SELECT {BAR} FROM bars_dirty WHERE open IS NOT NULL OR hour(bar_ts) BETWEEN 9 AND 15", "bar_ts")
simple("filt_session_hours", lambda v: sessions.in_session(v.bars_dirty, SINCE), f"SELECT {BAR} FROM bars_dirty WHERE hour(bar_ts) IN (2, 3, 4, 6, 7, 8, 9) AND open IS NOT NULL AND bar_ts >= '{SINCE}'", "bar_ts")
for rule, make, cond in (("inverted", filters.inverted, "high < low"), ("range", filters.out_of_range, "(open > high OR open < low OR close > high OR close < low) AND high > 0 AND low > 0"), ("nonpositive", filters.nonpositive, "open <= 0 OR high <= 0 OR low <= 0 OR close <= 0")):
    simple(f"filt_issue_{rule}", lambda v, make=make: filters.issues(v.bars_dirty, make(), "1h", SINCE), f"SELECT {BAR} FROM bars_dirty WHERE bar_ts >= '{SINCE}' AND ({cond}) ORDER BY bar_ts DESC, symbol, open, volume LIMIT 200", "bar_ts")
simple("filt_issue_zero_volume", lambda v: filters.zero_volume(v.bars_dirty, "1h", SINCE), f"SELECT count(*) FILTER (WHERE volume = 0) AS zero_volume FROM bars_dirty WHERE bar_ts >= '{SINCE}'")
WINDOWS = [("gap_a", "2024-01-03 00:00:00", "2024-01-05 00:00:00"), ("gap_b", "2024-01-20 00:00:00", "2024-01-20 00:00:00")]
simple(
    "filt_backfill_window",
    lambda v: filters.in_windows(v.bars_d, v.spark.createDataFrame(WINDOWS, "label string, a string, b string").select("label", F.col("a").cast("timestamp").alias("start_ts"), F.col("b").cast("timestamp").alias("end_ts"))),
    f"SELECT {BAR}, label FROM bars_d JOIN (VALUES {', '.join(map(str, WINDOWS))}) w(label, a, b) ON bar_ts BETWEEN CAST(a AS TIMESTAMP) AND CAST(b AS TIMESTAMP)", "bar_ts",
)
MANY = "(SELECT concat('w', o_orderkey) AS label, TIMESTAMP '2024-01-01' + to_minutes(CAST(o_orderkey * 37 % 43200 AS INTEGER)) AS a, TIMESTAMP '2024-01-01' + to_minutes(CAST(o_orderkey * 37 % 43200 + o_orderkey % 7 * 60 AS INTEGER)) AS b FROM orders)"


@query("filt_backfill_many_windows", f"SELECT label, count(*) AS bars, min(bar_ts) AS first_ts, CAST(sum(volume) AS BIGINT) AS volume FROM bars_1h JOIN {MANY} ON bar_ts BETWEEN a AND b GROUP BY 1", "first_ts")
def _(v: Views) -> DataFrame:
    """Overlapping windows, as many as there are orders."""
    at = lambda minutes: F.lit("2024-01-01").cast("timestamp") + F.make_dt_interval(mins=minutes.cast("int"))
    key = F.col("o_orderkey")
    windows = v.table("orders").select(F.concat(F.lit("w"), key.cast("string")).alias("label"), at(key * 37 % 43200).alias("start_ts"), at(key * 37 % 43200 + key % 7 * 60).alias("end_ts"))
    return filters.in_windows(v.bars_1h, windows).groupBy("label").agg(F.count("*").alias("bars"), F.min("bar_ts").alias("first_ts"), F.sum("volume").alias("volume"))


# --- joins -----------------------------------------------------------------------------------------------------------

ANTI = "NOT EXISTS (SELECT 1 FROM store_eod s WHERE s.symbol = b.symbol AND s.ivl = b.ivl AND s.bar_ts = b.bar_ts{})"
simple("join_new_bars", lambda v: joins.new_bars(v.vendor_eod, v.store_eod), f"SELECT * FROM vendor_eod b WHERE {ANTI.format('')}", "bar_ts")
simple("join_new_bars_window", lambda v: joins.new_bars_window(v.vendor_eod, v.store_eod, "2024-01-08", "2024-01-20"), f"SELECT * FROM vendor_eod b WHERE {ANTI.format(" AND s.bar_ts >= '2024-01-08' AND s.bar_ts < '2024-01-20'")}", "bar_ts")


def reconcile_sql(v: str, s: str, unit: str) -> str:
    off = ", ".join([f"CASE WHEN abs(v.{c} - s.{c}) > 0.01 THEN '{c}' END" for c in ("open", "high", "low", "close")] + ["CASE WHEN v.volume <> s.volume THEN 'volume' END"])
    own = "SELECT symbol, date_trunc('{}', bar_ts) AS at_ts, coalesce(open, 0) AS open, coalesce(high, 0) AS high, coalesce(low, 0) AS low, coalesce(close, 0) AS close, coalesce(volume, 0) AS volume FROM {}"
    return f"""SELECT * FROM (SELECT coalesce(v.symbol, s.symbol) AS symbol, CAST(coalesce(v.at_ts, s.at_ts) AS TIMESTAMP) AS at_ts, CASE WHEN s.symbol IS NULL THEN 'only_vendor' WHEN v.symbol IS NULL THEN 'only_store' ELSE 'mismatch' END AS kind,
      concat_ws(',', {off}) AS fields FROM ({own.format(unit, v)}) v FULL JOIN ({own.format(unit, s)}) s ON v.symbol = s.symbol AND v.at_ts = s.at_ts) WHERE kind <> 'mismatch' OR fields <> ''"""


simple("join_reconcile_eod", lambda v: joins.reconcile(v.vendor_eod, v.store_eod), reconcile_sql("vendor_eod", "store_eod", "day"), "at_ts")
RECENT = "(SELECT * FROM {} WHERE bar_ts >= TIMESTAMP '" + AS_OF + "' - INTERVAL 5 DAY)"
recent = lambda df: df.where(F.col("bar_ts") >= F.expr(f"timestamp '{AS_OF}' - interval 5 days"))
simple("join_reconcile_intraday", lambda v: joins.reconcile(recent(v.bars_dirty.distinct()), recent(v.stored_1h), "minute"), reconcile_sql(RECENT.format("(SELECT DISTINCT * FROM bars_dirty)"), RECENT.format("stored_1h"), "minute"), "at_ts")
simple("join_reconcile_eod_digest", lambda v: joins.reconcile_by_digest(v.vendor_eod, v.store_eod), reconcile_sql("vendor_eod", "store_eod", "day"), "at_ts")
# at the store most days are as the vendor has them
NEARLY = "(SELECT * REPLACE (CASE WHEN date_trunc('day', bar_ts) = TIMESTAMP '2024-01-17' AND volume % 3 = 0 THEN volume + 1 ELSE volume END AS volume) FROM stored_1h WHERE bar_ts <> TIMESTAMP '2024-01-05 03:00:00')"
nearly = lambda v: v.stored_1h.where("bar_ts <> timestamp '2024-01-05 03:00:00'").withColumn("volume", F.when((F.to_date("bar_ts") == F.lit("2024-01-17").cast("date")) & (F.col("volume") % 3 == 0), F.col("volume") + 1).otherwise(F.col("volume")))
simple("join_reconcile_intraday_digest", lambda v: joins.reconcile_by_digest(v.stored_1h, nearly(v), "minute", group="day"), reconcile_sql("stored_1h", NEARLY, "minute"), "at_ts")
AGE = 3 * 24 * 60
FRESH_SQL = f"""SELECT t.symbol, data_end, CASE WHEN data_end IS NULL THEN 'unknown' WHEN data_end < TIMESTAMP '{AS_OF}' - INTERVAL {AGE} MINUTE THEN 'stale' ELSE 'fresh' END AS status FROM (SELECT DISTINCT symbol FROM tracked) t LEFT JOIN latest USING (symbol)"""
simple("join_freshness", lambda v: coverage.freshness(v.tracked, v.coverage_hist, AS_OF, AGE), FRESH_SQL, "data_end")
simple(
    "join_update_plan",
    lambda v: coverage.update_plan(v.tracked, v.coverage_hist, ["d", "w"], "2024-01-29 12:00:00").select("symbol", F.array_join("intervals", ",").alias("intervals")),
    "SELECT t.symbol, string_agg(i.ivl, ',' ORDER BY i.ivl) AS intervals FROM (SELECT DISTINCT symbol FROM tracked) t CROSS JOIN (VALUES ('d'), ('w')) i(ivl) LEFT JOIN latest l ON l.symbol = t.symbol AND l.ivl = i.ivl WHERE last_updated IS NULL OR last_updated < TIMESTAMP '2024-01-28 12:00:00' GROUP BY 1",
)
simple(
    "join_refresh_plan", lambda v: coverage.refresh_plan(v.tracked, v.coverage_hist, ["d", "w", "m"], AS_OF, AGE),
    f"SELECT symbol, status, CAST(data_end AS DATE) - 7 AS fetch_from, 'eod' AS family FROM ({FRESH_SQL}) WHERE status <> 'fresh'", "fetch_from",
)
EXCHANGE = "(SELECT concat(Code, '.JK') AS symbol FROM listing_raw)"
STORED = "(SELECT DISTINCT symbol FROM store_eod)"
SYMBOLS_SQL = f"""SELECT 'not_tracked' AS gap, symbol FROM (SELECT symbol FROM {EXCHANGE} EXCEPT SELECT symbol FROM tracked) UNION ALL SELECT 'not_stored', symbol FROM (SELECT symbol FROM tracked EXCEPT SELECT symbol FROM {STORED})
UNION ALL SELECT 'exchange_not_stored', symbol FROM (SELECT symbol FROM {EXCHANGE} EXCEPT SELECT symbol FROM {STORED})"""
simple("join_symbol_coverage", lambda v: coverage.symbol_coverage(normalize.listing(v.listing_raw, AS_OF), v.tracked, v.store_eod), SYMBOLS_SQL)
pairs = lambda v: v.bars_1h.select("symbol", F.when(F.col("volume") % 3 == 0, "5m").when(F.col("high") > 90, "15m").otherwise("1h").alias("ivl")).where("ivl <> '5m' or symbol < 'R'")
PAIRS = "(SELECT symbol, CASE WHEN volume % 3 = 0 THEN '5m' WHEN high > 90 THEN '15m' ELSE '1h' END AS ivl FROM bars_1h) WHERE ivl <> '5m' OR symbol < 'R'"
simple(
    "join_interval_gaps", lambda v: coverage.interval_gaps(pairs(v), ["5m", "15m", "1h"]),
    f"SELECT s.symbol, i.ivl FROM (SELECT DISTINCT symbol FROM {PAIRS}) s CROSS JOIN (SELECT DISTINCT ivl FROM {PAIRS}) i WHERE (SELECT count(DISTINCT ivl) FROM {PAIRS}) = 3 AND (s.symbol, i.ivl) NOT IN (SELECT (symbol, ivl) FROM {PAIRS})",
)
stored_four = lambda v: sessions.session_bars(v.bars_1h).where("volume % 10 <> 0").withColumn("volume", F.when(F.col("volume") % 7 == 0, F.col("volume") + 1).otherwise(F.col("volume")))
simple(
    "join_validate_4h", lambda v: sessions.compared_session_bars(v.bars_1h, stored_four(v)),
    f"""SELECT f.symbol, f.bar_ts, f.close AS made_close, f.volume AS made_volume, h.hours, s.close AS stored_close, s.volume AS stored_volume, f.close IS NOT DISTINCT FROM s.close AND f.volume IS NOT DISTINCT FROM s.volume AS same
    FROM four f JOIN (SELECT symbol, {START_SQL} AS bar_ts, count(*) AS hours FROM bars_1h WHERE hour(bar_ts) IN (2, 3, 4, 6, 7, 8, 9) GROUP BY ALL) h USING (symbol, bar_ts)
    LEFT JOIN (SELECT symbol, bar_ts, close, CASE WHEN volume % 7 = 0 THEN volume + 1 ELSE volume END AS volume FROM four WHERE volume % 10 <> 0) s USING (symbol, bar_ts)""", "bar_ts",
)

# --- aggregations ----------------------------------------------------------------------------------------------------

simple("agg_4h", lambda v: sessions.session_bars(v.bars_1h), "SELECT * FROM four", "bar_ts")
simple("agg_4h_incremental", lambda v: sessions.session_bars_incremental(v.bars_1h, AS_OF), f"SELECT * FROM four WHERE bar_ts >= TIMESTAMP '{AS_OF}' - INTERVAL 10 DAY", "bar_ts")
simple("agg_4h_preview", lambda v: sessions.preview(sessions.session_bars(v.bars_1h)), "SELECT f.*, t.* FROM (SELECT * FROM four ORDER BY symbol, bar_ts LIMIT 10) f, (SELECT count(*) AS candles, count(DISTINCT symbol) AS symbols FROM four) t", "bar_ts")
ROLL = "first(open ORDER BY bar_ts) AS open, max(high) AS high, min(low) AS low, last(close ORDER BY bar_ts) AS close, CAST(sum(volume) AS BIGINT) AS volume"
simple(
    "agg_resample", lambda v: sessions.resample(v.bars_d, "w").unionByName(sessions.resample(v.bars_d, "m")).unionByName(sessions.resample(Views.bars(v.ticks_dense, "minute", "1m"), "30m")),
    f"""SELECT symbol, 'w' AS ivl, CAST(date_trunc('week', bar_ts) AS TIMESTAMP) AS start, {ROLL} FROM bars_d GROUP BY 1, 2, 3 UNION ALL SELECT symbol, 'm', CAST(date_trunc('month', bar_ts) AS TIMESTAMP), {ROLL} FROM bars_d GROUP BY 1, 2, 3
    UNION ALL SELECT symbol, '30m', time_bucket(INTERVAL 30 MINUTE, bar_ts), {ROLL} FROM (SELECT symbol, date_trunc('minute', ts) AS bar_ts, first(price ORDER BY ts, event_id) AS open, max(price) AS high, min(price) AS low, last(price ORDER BY ts, event_id) AS close, sum(qty) AS volume FROM ticks_dense GROUP BY 1, 2) GROUP BY 1, 2, 3""",
    "start",
)
ORACLES["agg_resample"] = ORACLES["agg_resample"].replace("SELECT * REPLACE (CAST(start AS VARCHAR) AS start)", "SELECT symbol, ivl, CAST(start AS VARCHAR) AS bar_ts, open, high, low, close, volume")
BUCKETS = {"5m": "time_bucket(INTERVAL 5 MINUTE, bar_ts)", "15m": "time_bucket(INTERVAL 15 MINUTE, bar_ts)", "30m": "time_bucket(INTERVAL 30 MINUTE, bar_ts)", "1h": "date_trunc('hour', bar_ts)", "d": "date_trunc('day', bar_ts)", "w": "date_trunc('week', bar_ts)", "m": "date_trunc('month', bar_ts)"}
BUCKETS["4h"] = f"CASE WHEN hour(bar_ts) IN (2, 3, 4, 6, 7, 8, 9) THEN {START_SQL} END"
MINUTES = "(SELECT symbol, date_trunc('minute', ts) AS bar_ts, first(price ORDER BY ts, event_id) AS open, max(price) AS high, min(price) AS low, last(price ORDER BY ts, event_id) AS close, sum(qty) AS volume FROM ticks_dense GROUP BY 1, 2)"
LEVELS_SQL = " UNION ALL ".join(f"SELECT symbol, '{ivl}' AS ivl, CAST(CAST({start} AS TIMESTAMP) AS VARCHAR) AS bar_ts, {ROLL} FROM {MINUTES} GROUP BY 1, 2, 3" for ivl, start in BUCKETS.items())
simple("agg_resample_cascade", lambda v: sessions.cascade(Views.bars(v.ticks_dense, "minute", "1m")), f"SELECT * FROM ({LEVELS_SQL}) WHERE bar_ts IS NOT NULL")
simple("agg_coverage", lambda v: coverage.coverage(v.bars_d.unionByName(v.bars_1h)), "SELECT symbol, ivl, min(bar_ts) AS data_start, max(bar_ts) AS data_end, count(*) AS total_records FROM (SELECT * FROM bars_d UNION ALL SELECT * FROM bars_1h) GROUP BY 1, 2", "data_start data_end")
ROLLUP_SQL = "SELECT symbol, max(data_end) AS data_end, max(total_records) AS total_records, max(data_start) AS data_start FROM coverage_hist WHERE ivl = 'd' GROUP BY 1"
rollup = lambda v: coverage.rollup(v.coverage_hist, "d")
simple("agg_coverage_rollup", rollup, ROLLUP_SQL, "data_end data_start")
simple("agg_distinct_symbols", lambda v: v.bars_d.select("symbol").distinct(), "SELECT DISTINCT symbol FROM bars_d")
simple("agg_distinct_timestamps", lambda v: v.bars_dirty.select("symbol", "ivl", "bar_ts").distinct(), "SELECT DISTINCT symbol, ivl, bar_ts FROM bars_dirty", "bar_ts")
twice = lambda v: v.bars_d.unionByName(v.bars_d.where("volume % 19 = 0")).unionByName(v.bars_d.where("volume % 38 = 0"))
TWICE = "(SELECT * FROM bars_d UNION ALL SELECT * FROM bars_d WHERE volume % 19 = 0 UNION ALL SELECT * FROM bars_d WHERE volume % 38 = 0)"
DUP_SQL = "SELECT {0}, count(*) AS pairs, CAST(sum(cnt - 1) AS BIGINT) AS extra_rows FROM (SELECT {1}, count(*) AS cnt FROM {2} WHERE bar_ts BETWEEN TIMESTAMP '" + AS_OF + "' - INTERVAL {3} DAY AND TIMESTAMP '" + AS_OF + "' GROUP BY {1} HAVING count(*) > 1) GROUP BY {0}"
simple("agg_dup_eod", lambda v: audit.duplicate_summary(audit.duplicates(twice(v), "symbol", "bar_ts", days=365, data_end=AS_OF), "symbol"), DUP_SQL.format("symbol", "symbol, bar_ts", TWICE, 365))
simple("agg_dup_intraday", lambda v: audit.duplicate_summary(audit.duplicates(v.bars_dirty, "symbol", "ivl", "bar_ts", days=30, data_end=AS_OF), "symbol", "ivl"), DUP_SQL.format("symbol, ivl", "symbol, ivl, bar_ts", "bars_dirty", 30))
simple("agg_dup_metadata", lambda v: audit.metadata_duplicates(v.coverage_hist), "SELECT count(*) AS total, count(DISTINCT (symbol, ivl)) AS unique_keys, count(*) - count(DISTINCT (symbol, ivl)) AS duplicates FROM coverage_hist")
simple(
    "agg_row_distribution", lambda v: audit.row_distribution(rollup(v)),
    f"SELECT max(total_records) AS max_rows, min(total_records) AS min_rows, round(avg(total_records), 6) AS avg_rows, max(CASE WHEN i = n // 2 + 1 THEN total_records END) AS median_rows FROM (SELECT *, row_number() OVER (ORDER BY total_records DESC) AS i, count(*) OVER () AS n FROM ({ROLLUP_SQL}) WHERE total_records > 0)",
)
simple("agg_row_gaps", lambda v: audit.row_gaps(rollup(v)), f"SELECT symbol, total_records, round((1 - total_records / (SELECT max(total_records) FROM ({ROLLUP_SQL}))) * 100, 1) AS gap_pct FROM ({ROLLUP_SQL}) WHERE total_records < 0.8 * (SELECT max(total_records) FROM ({ROLLUP_SQL}))")
uneven = lambda v: rollup(v).withColumn("data_end", F.col("data_end") - F.expr("make_dt_interval(cast(total_records % 13 as int), 0, 0, 0)"))
UNEVEN = f"(SELECT symbol, data_end - to_days(CAST(total_records % 13 AS INTEGER)) AS data_end, total_records FROM ({ROLLUP_SQL}))"
MEDIAN = "(SELECT data_end FROM (SELECT data_end, row_number() OVER (ORDER BY data_end) AS i, count(*) OVER () AS n FROM {0}) WHERE i = n // 2 + 1)"
STALE_SQL = f"SELECT symbol, data_end, CAST(floor(epoch({MEDIAN.format(UNEVEN)} - data_end) / 86400) AS INTEGER) AS lag_days, floor(epoch({MEDIAN.format(UNEVEN)} - data_end) / 86400) > 7 AS stale FROM {UNEVEN}"
STALE_SQL = f"SELECT *, round(100.0 * count(*) FILTER (WHERE NOT stale) OVER () / count(*) OVER (), 1) AS fresh_pct FROM ({STALE_SQL})"
simple("agg_staleness_eod", lambda v: audit.staleness(uneven(v)), STALE_SQL, "data_end")
ends = lambda v: coverage.coverage(v.bars_1h.unionByName(v.bars_d.where("volume % 4 = 0")))
ENDS = "(SELECT symbol, ivl, max(bar_ts) AS data_end FROM (SELECT * FROM bars_1h UNION ALL SELECT * FROM bars_d WHERE volume % 4 = 0) GROUP BY 1, 2)"
simple(
    "agg_staleness_interval", lambda v: audit.interval_staleness(ends(v), AS_OF),
    f"""SELECT ivl, symbols, latest, median_end, stale, CAST(floor(epoch(TIMESTAMP '{AS_OF}' - latest) / 86400) AS INTEGER) AS days_since, CASE WHEN stale = 0 AND floor(epoch(TIMESTAMP '{AS_OF}' - latest) / 86400) < 7 THEN 'OK' ELSE 'WARN' END AS status FROM (
      SELECT e.ivl, count(*) AS symbols, max(e.data_end) AS latest, max(CASE WHEN i = n // 2 + 1 THEN e.data_end END) AS median_end, count(*) FILTER (WHERE epoch(top - e.data_end) > 86400) AS stale
      FROM (SELECT *, row_number() OVER (PARTITION BY ivl ORDER BY data_end) AS i, count(*) OVER (PARTITION BY ivl) AS n, max(data_end) OVER (PARTITION BY ivl) AS top FROM {ENDS}) e GROUP BY e.ivl)""", "latest median_end",
)
PER_DAY = f"SELECT symbol, ivl, CAST(bar_ts AS DATE) AS day, count(*) AS bars FROM bars_1h WHERE bar_ts BETWEEN TIMESTAMP '{AS_OF}' - INTERVAL 30 DAY AND TIMESTAMP '{AS_OF}' GROUP BY 1, 2, 3"
TRIMMED = f"SELECT symbol, ivl, day, bars FROM (SELECT *, row_number() OVER (PARTITION BY symbol, ivl ORDER BY day) AS i, count(*) OVER (PARTITION BY symbol, ivl) AS n FROM ({PER_DAY})) WHERE n <= 2 OR (i > 1 AND i < n)"
simple("agg_bars_per_day", lambda v: audit.bars_per_day(v.bars_1h, AS_OF), PER_DAY, "day")
simple("win_trim_partial_days", lambda v: audit.without_partial_days(audit.bars_per_day(v.bars_1h, AS_OF)), TRIMMED, "day")
simple(
    "agg_session_completeness", lambda v: audit.session_completeness(v.bars_1h, AS_OF),
    f"SELECT symbol, ivl, round(avg(bars), 6) AS avg_bars, 6 AS expected, avg(bars) < 0.7 * 6 AS low FROM ({TRIMMED}) WHERE symbol IN (SELECT symbol FROM bars_1h GROUP BY 1 ORDER BY count(*) DESC, symbol LIMIT 5) GROUP BY 1, 2",
)
simple("agg_stale_vs_trading_day", lambda v: coverage.stale_vs_trading_day(v.coverage_hist, "2024-01-30", 2), "SELECT symbol, ivl, CAST(data_end AS DATE) AS last_day, CASE WHEN data_end IS NULL THEN 'no_metadata' WHEN CAST(data_end AS DATE) < DATE '2024-01-28' THEN 'stale' ELSE 'up_to_date' END AS status FROM latest", "last_day")
SPIKES = "SELECT symbol, bar_ts, round(prev, 2) AS prev_close, round(close, 2) AS close, round(abs(close - prev) / prev * 100, 1) AS pct FROM (SELECT *, lag(close) OVER (PARTITION BY symbol ORDER BY bar_ts) AS prev FROM {} WHERE bar_ts >= '" + SINCE + "' AND close > 0) WHERE abs(close - prev) / prev > 0.5"
simple("win_price_spikes", lambda v: audit.spikes(v.bars_d, "d", SINCE), SPIKES.format("bars_d"), "bar_ts")
simple(
    "agg_issue_summary", lambda v: audit.issue_summary(v.bars_dirty.distinct(), "1h", SINCE),
    f"""SELECT *, inverted + out_of_range + nonpositive + spikes AS total_issues, CASE WHEN inverted + out_of_range + nonpositive + spikes = 0 THEN 'ok' ELSE 'issues_found' END AS status FROM (SELECT count(*) FILTER (WHERE high < low) AS inverted,
    count(*) FILTER (WHERE (open > high OR open < low OR close > high OR close < low) AND high > 0 AND low > 0) AS out_of_range, count(*) FILTER (WHERE open <= 0 OR high <= 0 OR low <= 0 OR close <= 0) AS nonpositive, count(*) FILTER (WHERE volume = 0) AS zero_volume,
    (SELECT count(*) FROM ({SPIKES.format('(SELECT DISTINCT * FROM bars_dirty)')})) AS spikes FROM (SELECT DISTINCT * FROM bars_dirty) WHERE bar_ts >= '{SINCE}')""",
)
PROFILE = "SELECT CAST(bar_ts AS DATE) AS day, count(*) AS rows, CASE WHEN CAST(bar_ts AS DATE) >= DATE '2023-07-31' THEN 'recent' WHEN CAST(bar_ts AS DATE) >= DATE '2023-01-31' THEN 'prior' ELSE 'older' END AS age FROM bars_d GROUP BY 1, 3"
simple("agg_partition_profile", lambda v: audit.partition_profile(v.bars_d, AS_OF), PROFILE, "day")
both_actions = lambda v: normalize.dividends_bulk(dividend_feed(v), AS_OF).unionByName(normalize.splits_bulk(split_feed(v), AS_OF))
BOTH = f"({DIV_BULK_SQL} UNION ALL {SPLIT_BULK_SQL})"
simple("agg_action_stats", lambda v: audit.action_stats(both_actions(v)), f"SELECT symbol, count(*) FILTER (WHERE action_type = 'dividend') AS dividends, count(*) FILTER (WHERE action_type = 'split') AS splits, count(*) AS total, count(*) FILTER (WHERE action_type = 'dividend') > 0 AS has_dividends, count(*) FILTER (WHERE action_type = 'split') > 0 AS has_splits FROM {BOTH} GROUP BY 1")


AUDITS = {
    "duplicates": DUP_SQL.format("symbol, ivl", "symbol, ivl, bar_ts", "bars_dirty", 30), "freshness": f"SELECT 1 FROM ({STALE_SQL}) WHERE stale", "rows": f"SELECT 1 FROM ({ROLLUP_SQL}) WHERE total_records < 0.8 * (SELECT max(total_records) FROM ({ROLLUP_SQL}))",
    "ohlc": "SELECT 1 FROM bars_1h WHERE high < low", "reconciliation": reconcile_sql("vendor_eod", "store_eod", "day"),
    "completeness": f"SELECT 1 FROM ({TRIMMED}) WHERE symbol IN (SELECT symbol FROM bars_1h GROUP BY 1 ORDER BY count(*) DESC, symbol LIMIT 5) GROUP BY symbol, ivl HAVING avg(bars) < 0.7 * 6",
    "gaps": f"SELECT 1 FROM (SELECT DISTINCT symbol FROM {PAIRS}) s CROSS JOIN (SELECT DISTINCT ivl FROM {PAIRS}) i WHERE (SELECT count(DISTINCT ivl) FROM {PAIRS}) = 3 AND (s.symbol, i.ivl) NOT IN (SELECT (symbol, ivl) FROM {PAIRS})",
}
AUDIT_SQL = " UNION ALL ".join(f"SELECT '{name}' AS stage, count(*) = 0 AS passed FROM ({sql})" for name, sql in AUDITS.items())


@query("agg_audit_report", f"SELECT * FROM ({AUDIT_SQL}) UNION ALL SELECT 'overall', bool_and(passed) FROM ({AUDIT_SQL})")
def _(v: Views) -> DataFrame:
    found = {
        "duplicates": audit.duplicates(v.bars_dirty, "symbol", "ivl", "bar_ts", days=30, data_end=AS_OF), "freshness": audit.staleness(uneven(v)).where("stale"), "rows": audit.row_gaps(rollup(v)), "ohlc": v.bars_1h.where(filters.inverted()),
        "reconciliation": joins.reconcile(v.vendor_eod, v.store_eod), "completeness": audit.session_completeness(v.bars_1h, AS_OF).where("low"), "gaps": coverage.interval_gaps(pairs(v), ["5m", "15m", "1h"]),
    }
    return audit.report(*[audit.stage(df.agg(F.count("*").alias("n")), name, F.col("n") == 0) for name, df in found.items()])


# --- windows, order and sets -----------------------------------------------------------------------------------------

COVER = "symbol, ivl, last_updated, total_records, data_start, data_end"
simple("win_latest_coverage", lambda v: coverage.latest(v.coverage_hist), f"SELECT {COVER} FROM latest", "last_updated data_start data_end")
simple("win_max_timestamp", lambda v: coverage.max_timestamp(v.coverage_hist), "SELECT symbol, ivl, data_end FROM latest", "data_end")
simple("win_metadata_cleanup", lambda v: coverage.cleanup(v.coverage_hist, AS_OF), f"SELECT {COVER}, TIMESTAMP '{AS_OF}' AS created_at FROM latest", "last_updated data_start data_end created_at")
sequenced = lambda v: v.store_eod.withColumn("seq", F.lit(0)).unionByName(v.vendor_eod.withColumn("seq", F.lit(1)))
SEQUENCED = "(SELECT *, 0 AS seq FROM store_eod UNION ALL SELECT *, 1 AS seq FROM vendor_eod)"
LAST = f"SELECT * FROM {SEQUENCED} QUALIFY row_number() OVER (PARTITION BY symbol, ivl, bar_ts ORDER BY seq DESC) = 1"
simple("win_last_write", lambda v: audit.last_write(sequenced(v), "seq"), LAST, "bar_ts")
simple("win_actions_distinct", lambda v: audit.distinct_actions(both_actions(v)).select("symbol", "action_type", "action_date", "dividend_amount", "split_ratio"), f"SELECT symbol, action_type, action_date, dividend_amount, split_ratio FROM {BOTH} QUALIFY row_number() OVER (PARTITION BY symbol, action_type, action_date ORDER BY created_at DESC, dividend_amount DESC NULLS LAST, split_ratio DESC NULLS LAST) = 1", "action_date")
simple("topk_symbols_by_rows", lambda v: audit.top_by_rows(v.bars_d.unionByName(v.bars_1h).groupBy("symbol", "ivl").agg(F.count("*").alias("rows")), 5), "SELECT symbol, ivl, count(*) AS rows FROM (SELECT * FROM bars_d UNION ALL SELECT * FROM bars_1h) GROUP BY 1, 2 QUALIFY row_number() OVER (PARTITION BY ivl ORDER BY count(*) DESC, symbol) <= 5")
simple("topk_recent_symbols", lambda v: rollup(v).orderBy(F.desc("data_end"), "symbol").limit(100), f"SELECT * FROM ({ROLLUP_SQL}) ORDER BY data_end DESC, symbol LIMIT 100", "data_end data_start")


@query("topk_duplicates", f"SELECT symbol, bar_ts, count(*) AS cnt FROM {TWICE} WHERE bar_ts BETWEEN TIMESTAMP '{AS_OF}' - INTERVAL 365 DAY AND TIMESTAMP '{AS_OF}' GROUP BY 1, 2 HAVING count(*) > 1 QUALIFY row_number() OVER (PARTITION BY symbol ORDER BY count(*) DESC, bar_ts) <= 10", "bar_ts")
def _(v: Views) -> DataFrame:
    from pyspark.sql import Window

    order = Window.partitionBy("symbol").orderBy(F.desc("cnt"), "bar_ts")
    return audit.duplicates(twice(v), "symbol", "bar_ts", days=365, data_end=AS_OF).withColumn("n", F.row_number().over(order)).where("n <= 10").drop("n")


simple("topk_stale", lambda v: audit.staleness(uneven(v)).orderBy(F.desc("lag_days"), "symbol").limit(15), f"SELECT * FROM ({STALE_SQL}) ORDER BY lag_days DESC, symbol LIMIT 15", "data_end")
simple("topk_partitions", lambda v: audit.partition_profile(v.bars_d, AS_OF).orderBy(F.desc("rows"), "day").limit(5), f"SELECT * FROM ({PROFILE}) ORDER BY rows DESC, day LIMIT 5", "day")


def listed_file(v: Views) -> str:
    """A symbol list, one code on each line, that is not in the order of the names."""
    path = st.scratch_dir(v.spark)
    v.table("customer").where("c_mktsegment <> 'BUILDING'").orderBy(F.desc("c_custkey")).select(F.concat(F.lit("U"), F.col("c_custkey").cast("string")).alias("value")).coalesce(1).write.text(path)
    return path


simple("limit_symbols", lambda v: feeds.first_symbols(v.spark, listed_file(v), 50), "SELECT concat('U', c_custkey, '.JK') AS symbol FROM customer WHERE c_mktsegment <> 'BUILDING' ORDER BY c_custkey DESC LIMIT 50")
simple("sample_symbols", lambda v: v.bars_d.select("symbol").distinct().orderBy(F.md5(F.concat(F.lit("7"), "symbol")), "symbol").limit(10), "SELECT DISTINCT symbol FROM (SELECT symbol FROM (SELECT DISTINCT symbol FROM bars_d) ORDER BY md5(concat('7', symbol)), symbol LIMIT 10)")
simple("set_difference", lambda v: v.tracked.select("symbol").subtract(v.store_eod.select("symbol")), f"SELECT symbol FROM tracked EXCEPT SELECT symbol FROM {STORED}")
simple("set_union_keys", lambda v: v.vendor_eod.select("symbol", "bar_ts").union(v.store_eod.select("symbol", "bar_ts")).distinct(), "SELECT symbol, bar_ts FROM vendor_eod UNION SELECT symbol, bar_ts FROM store_eod", "bar_ts")


@query("set_union_plan", f"SELECT symbol, status FROM ({FRESH_SQL}) WHERE status = 'stale' UNION ALL SELECT symbol, status FROM ({FRESH_SQL}) WHERE status = 'unknown'")
def _(v: Views) -> DataFrame:
    state = coverage.freshness(v.tracked, v.coverage_hist, AS_OF, AGE).select("symbol", "status")
    return state.where("status = 'stale'").unionByName(state.where("status = 'unknown'"))


# --- sinks and streams -----------------------------------------------------------------------------------------------


@query("sink_bars_upsert", f"SELECT {BAR} FROM ({LAST})", "bar_ts")
def _(v: Views) -> DataFrame:
    store = stored(v, v.store_eod)
    store.upsert(v.vendor_eod)
    return shown_bars(store.bars())


@query("sink_bars_insert_new", f"SELECT {BAR} FROM {SEQUENCED} QUALIFY row_number() OVER (PARTITION BY symbol, ivl, bar_ts ORDER BY seq) = 1", "bar_ts")
def _(v: Views) -> DataFrame:
    store = stored(v, v.store_eod)
    store.insert_new(v.vendor_eod)
    return shown_bars(store.bars())


APPENDED = " UNION ALL ".join(f"SELECT symbol, action_type, action_date, dividend_amount, split_ratio FROM ({q})" for q in (SPLIT_BULK_SQL, DIV_BULK_SQL, SPLIT_BULK_SQL))


@query("sink_actions_append", APPENDED, "action_date")
def _(v: Views) -> DataFrame:
    """Splits, dividends, and the splits once more: there is no key."""
    path, splits = st.scratch_dir(v.spark), normalize.splits_bulk(split_feed(v), AS_OF)
    for rows in (splits, normalize.dividends_bulk(dividend_feed(v), AS_OF), splits):
        st.append(rows, path)
    return v.spark.read.schema(feeds.schemas.ACTIONS).parquet(path).select("symbol", "action_type", "action_date", "dividend_amount", "split_ratio")


@query("sink_instruments_append", f"SELECT symbol, name, currency, is_active FROM ({LISTING_SQL})")
def _(v: Views) -> DataFrame:
    path = st.scratch_dir(v.spark)
    st.append(normalize.listing(v.listing_raw, AS_OF), path)
    return v.spark.read.schema(feeds.schemas.INSTRUMENTS).parquet(path).select("symbol", "name", "currency", "is_active")


UPDATED = "(SELECT * REPLACE (total_records + 5 AS total_records, last_updated + INTERVAL 6 HOUR AS last_updated) FROM coverage_hist WHERE last_updated = TIMESTAMP '2024-01-29' AND total_records % 2 = 0)"


@query("sink_coverage_upsert", f"SELECT h.symbol, h.ivl, h.last_updated, coalesce(u.total_records, h.total_records) AS total_records, h.data_start, h.data_end FROM coverage_hist h LEFT JOIN {UPDATED} u ON u.symbol = h.symbol AND u.ivl = h.ivl AND CAST(u.last_updated AS DATE) = CAST(h.last_updated AS DATE)", "last_updated data_start data_end")
def _(v: Views) -> DataFrame:
    batch = v.coverage_hist.where("last_updated = timestamp '2024-01-29' and total_records % 2 = 0").withColumns({"total_records": F.col("total_records") + 5, "last_updated": F.col("last_updated") + F.expr("interval 6 hours")})
    table = st.VersionedTable(v.spark, st.scratch_dir(v.spark), feeds.schemas.COVERAGE)
    table.replace(v.coverage_hist)
    st.upsert_coverage(table, batch)
    return table.read()


@query("agg_coverage_incremental", f"SELECT symbol, ivl, min(bar_ts) AS data_start, max(bar_ts) AS data_end, count(*) AS total_records FROM (SELECT symbol, ivl, bar_ts FROM ({LAST}) UNION ALL SELECT symbol, ivl, bar_ts FROM bars_1h) GROUP BY 1, 2", "data_start data_end")
def _(v: Views) -> DataFrame:
    """Kept along with two writes; the second one touches months of daily bars only."""
    store = stored(v, v.store_eod.unionByName(v.bars_1h))
    rollup = CoverageRollup(v.spark, st.scratch_dir(v.spark), store)
    rollup.refresh()
    store.upsert(v.vendor_eod)
    rollup.refresh()
    return rollup.coverage()


@query("agg_file_profile", "SELECT ivl, strftime(bar_ts, '%Y-%m-%d') AS dt, count(*) AS rows, true AS has_bytes FROM bars_1h GROUP BY 1, 2")
def _(v: Views) -> DataFrame:
    """Rows and bytes by partition of a store whose small files were packed after four writes."""
    store = stored(v, v.bars_1h.where("volume % 4 = 0"))
    for i in (1, 2, 3):
        store.insert_new(v.bars_1h.where(f"volume % 4 = {i}"))
    store.pack()
    return store.profile().groupBy("ivl", "dt").agg(F.sum("rows").alias("rows"), (F.sum("bytes") > 0).alias("has_bytes"))


@query("sink_metadata_cleanup", "SELECT count(*) AS before, count(DISTINCT (symbol, ivl)) AS after, count(*) - count(DISTINCT (symbol, ivl)) AS removed FROM coverage_hist")
def _(v: Views) -> DataFrame:
    table = st.VersionedTable(v.spark, st.scratch_dir(v.spark), feeds.schemas.COVERAGE)
    table.replace(v.coverage_hist)
    return st.cleanup_coverage(table, AS_OF)


def exported(df: DataFrame, blank: bool = False) -> DataFrame:
    """What both exports of the rows have in common, as often as they have it; ``blank``: what CSV has nothing for is an empty text."""
    path = st.scratch_dir(df.sparkSession)
    st.export(df, path)
    csv = df.sparkSession.read.schema(df.schema).option("header", True).csv(f"{path}/csv")
    return df.sparkSession.read.schema(df.schema).parquet(f"{path}/parquet").transform(joins.common_rows, csv.na.fill("") if blank else csv)


simple("sink_export", lambda v: exported(v.bars_d), f"SELECT {BAR} FROM bars_d", "bar_ts")
simple("sink_export_actions", lambda v: exported(both_actions(v)), f"SELECT * FROM {BOTH}", ACTION_TIMES)
simple("sink_export_instruments", lambda v: exported(normalize.listing(v.listing_raw, AS_OF), blank=True), LISTING_SQL, "created_at")
LEDGER_SQL = "SELECT symbol, count(v.symbol) AS rows, count(v.symbol) > 0 AS success, CASE WHEN count(v.symbol) = 0 THEN 'no data' END AS error FROM (SELECT symbol FROM tracked UNION SELECT symbol FROM vendor_eod) w(symbol) LEFT JOIN (SELECT symbol FROM vendor_eod) v USING (symbol) GROUP BY 1"


def run_ledger(v: Views) -> DataFrame:
    path = st.scratch_dir(v.spark)
    st.ledger(v.tracked, v.vendor_eod, "run-1", path)
    return v.spark.read.schema(st.LEDGER).json(path)


simple("sink_run_ledger", lambda v: run_ledger(v).select("symbol", "rows", "success", "error"), LEDGER_SQL)
simple("agg_run_summary", lambda v: audit.run_summary(run_ledger(v), both_actions(v)), f"SELECT *, (SELECT count(*) FROM {BOTH} WHERE action_type = 'dividend') AS dividends, (SELECT count(*) FROM {BOTH} WHERE action_type = 'split') AS splits FROM (SELECT count(*) FILTER (WHERE success) AS successes, count(*) FILTER (WHERE NOT success) AS failures, CAST(sum(rows) AS BIGINT) AS records FROM ({LEDGER_SQL}))")


def landed_in_parts(df: DataFrame, parts: int) -> tuple[str, int]:
    """A landed JSON feed for so many micro-batches at most, each with rows of all kinds, and the files of a batch.

    Each task that makes rows deals them to that many files by their hash. So files get more with the input, not longer by
    it, and no task reads a whole part.
    """
    path = st.scratch_dir(df.sparkSession)
    df.withColumn("part", F.pmod(F.xxhash64(*df.columns), F.lit(parts)).cast("int")).write.partitionBy("period", "part").json(path)
    files = len(df.sparkSession.read.schema(df.schema).json(path).inputFiles())
    return path, max(1, -(-files // parts))


@query("stream_ingest_bars", f"SELECT {BAR} FROM ({LAST})", "bar_ts")
def _(v: Views) -> DataFrame:
    store = stored(v, v.store_eod)
    landing, files = landed_in_parts(eod_feed(v), 3)
    ingest.ingest_bars(ingest.stream_feed(v.spark, landing, files_per_batch=files), lambda df: normalize.eod(df, AS_OF), store, st.scratch_dir(v.spark))
    return shown_bars(store.bars())


@query("stream_ingest_new_bars", f"SELECT {BAR} FROM {SEQUENCED} QUALIFY row_number() OVER (PARTITION BY symbol, ivl, bar_ts ORDER BY seq) = 1", "bar_ts")
def _(v: Views) -> DataFrame:
    store, checkpoint = stored(v, v.store_eod), st.scratch_dir(v.spark)
    landing, files = landed_in_parts(eod_feed(v), 2)
    for _ in range(2):  # the second run finds nothing new
        ingest.ingest_bars(ingest.stream_feed(v.spark, landing, files_per_batch=files), lambda df: normalize.eod(df, AS_OF), store, checkpoint, insert_only=True)
    return shown_bars(store.bars())


@query("stream_ingest_actions", f"SELECT 'stored' AS kind, symbol, CAST(action_date AS VARCHAR) AS date, dividend_amount FROM ({DIV_SQL}) WHERE action_date IS NOT NULL UNION ALL SELECT 'rejected', {QUALIFIED_CODE}, date, CAST(value AS DOUBLE) FROM actions_raw WHERE date = 'bad'")
def _(v: Views) -> DataFrame:
    path, quarantine = st.scratch_dir(v.spark), st.scratch_dir(v.spark)
    landing, files = landed_in_parts(symbol_dividends(v).drop("period").withColumn("period", F.lit("d")), 2)
    feed = v.spark.readStream.schema(f"{feeds.schemas.DIVIDENDS}, symbol string").option("maxFilesPerTrigger", files).json(landing)
    ingest.ingest_actions(feed, lambda df: normalize.dividends(df, AS_OF), path, st.scratch_dir(v.spark), quarantine)
    kept = v.spark.read.parquet(path).select(F.lit("stored").alias("kind"), "symbol", F.col("action_date").cast("string").alias("date"), "dividend_amount")
    return kept.unionByName(v.spark.read.parquet(quarantine).select(F.lit("rejected").alias("kind"), "symbol", "date", F.col("value").alias("dividend_amount")))


@query("stream_session_4h", f"SELECT {BAR} FROM four", "bar_ts")
def _(v: Views) -> DataFrame:
    """Three micro-batches: two of bars of all times, some wrong, and one that corrects those."""
    landing = st.scratch_dir(v.spark)
    wrong = F.col("volume") % 5 == 0
    first = v.bars_1h.withColumn("close", F.when(wrong, F.col("close") + 1).otherwise(F.col("close"))).withColumn("volume", F.when(wrong, F.col("volume") + 7).otherwise(F.col("volume")))
    first.withColumn("sent", F.lit(1)).repartition(2, "bar_ts").write.parquet(landing)
    v.bars_1h.where(wrong).withColumn("sent", F.lit(2)).coalesce(1).write.mode("append").parquet(landing)
    source, target = (st.BarStore(v.spark, st.scratch_dir(v.spark)) for _ in range(2))
    feed = v.spark.readStream.schema(first.withColumn("sent", F.lit(1)).schema).option("maxFilesPerTrigger", 1).parquet(landing)
    ingest.keep_session_bars(feed, source, target, st.scratch_dir(v.spark), AS_OF, ["sent"], "5 days", 8)
    return shown_bars(target.bars())
