"""Scans: landed JSON feeds, symbol lists, and range reads of a bar store, whose commits name the files that can hold the rows.

A feed is a folder of JSON files whose lines are each an array of flat objects, as
vendors answer, or one object; ``multi_line`` is for answers spread over lines. The
symbol and period of per-symbol feeds may be partition folders (``symbol=.../period=...``).
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import TYPE_CHECKING

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.scalar import suffixed
from . import schemas

if TYPE_CHECKING:
    from ..plans.store import BarStore


def read_feed(spark: SparkSession, path: str, schema: str, partitions: str = "symbol string, period string", multi_line: bool = False) -> DataFrame:
    """A landed feed with its explicit schema; fields that a file lacks are null."""
    full = f"{schema}, {partitions}" if partitions else schema
    return spark.read.schema(full).option("multiLine", multi_line).json(path)


def read_eod(spark: SparkSession, path: str) -> DataFrame:
    return read_feed(spark, path, schemas.EOD)


def read_intraday(spark: SparkSession, path: str) -> DataFrame:
    return read_feed(spark, path, schemas.INTRADAY)


def read_bulk(spark: SparkSession, path: str, kind: str = "") -> DataFrame:
    """Whole-exchange snapshot; kind is '', 'dividends' or 'splits'."""
    return read_feed(spark, path, {"": schemas.BULK_EOD, "dividends": schemas.BULK_DIVIDENDS, "splits": schemas.BULK_SPLITS}[kind], "")


def read_dividends(spark: SparkSession, path: str) -> DataFrame:
    return read_feed(spark, path, schemas.DIVIDENDS, "symbol string")


def read_splits(spark: SparkSession, path: str) -> DataFrame:
    return read_feed(spark, path, schemas.SPLITS, "symbol string")


def read_listing(spark: SparkSession, path: str) -> DataFrame:
    return read_feed(spark, path, schemas.LISTING, "")


def symbol_list(lines: DataFrame, suffix: str = ".JK") -> DataFrame:
    """Symbols of a text file's lines (column ``value``): trimmed, without blank and # lines, with the suffix."""
    line = F.trim("value")
    return lines.where((line != "") & ~line.startswith("#")).select(suffixed(line, suffix).alias("symbol"))


def first_symbols(spark: SparkSession, path: str, n: int, suffix: str = ".JK") -> DataFrame:
    """The first n symbols of a list in the order of its lines."""
    at = ["file", "block", "row"]
    lines = spark.read.text(path).select("value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block")).withColumn("row", F.monotonically_increasing_id())
    line = F.trim("value")
    return lines.where((line != "") & ~line.startswith("#")).select(suffixed(line, suffix).alias("symbol"), *at).orderBy(*at).limit(n).select("symbol")


def bars_range(store: BarStore, symbol: str, ivl: str, start: str, end: str, limit: int = 500) -> DataFrame:
    """Stored bars of one symbol and interval within [start, end], oldest first."""
    return store.scan(ivl, [symbol], start, end).orderBy("bar_ts").limit(limit)


def bars_recent(store: BarStore, limit: int, symbol: str | None = None, ivl: str = "d") -> DataFrame:
    """Newest stored bars first; ties by symbol."""
    own = store.newest(limit, ivl) if symbol is None else store.scan(ivl, [symbol])
    return own.orderBy(F.desc("bar_ts"), "symbol").limit(limit)


def bars_lookback(store: BarStore, symbols: Sequence[str], as_of: str, months: int = 0, days: int = 0, ivl: str | None = None) -> DataFrame:
    """Stored bars of the symbols newer than so many months and days before ``as_of``."""
    since = store.spark.sql(f"SELECT timestamp '{as_of}' - interval '{months}' month - interval '{days}' day AS t").head().t
    return store.scan(ivl, symbols, str(since)).where(F.col("bar_ts") > F.lit(since))


def actions_recent(actions: DataFrame, limit: int | None = None) -> DataFrame:
    newest = actions.orderBy(F.desc("action_date"), "symbol", "action_type")
    return newest if limit is None else newest.limit(limit)


def instruments(listing: DataFrame) -> DataFrame:
    return listing.select("symbol", "exchange", "name", "sector", "industry", "currency", "is_active")


def first_hit(records: DataFrame, key: str, *order: str) -> DataFrame:
    """The first landed record of each key."""
    return records.groupBy(key).agg(F.min_by(F.struct(*[c for c in records.columns if c != key]), F.struct(*order)).alias("r")).select(key, "r.*")
