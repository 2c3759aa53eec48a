"""Ways of working that hold at scale, each against the plain way on rows made for it."""

from __future__ import annotations

import bisect
import random

import pytest
from pyspark.sql import functions as F

from loomstream.functions import scalar
from loomstream.operators import audit, filters, joins, sessions
from loomstream.plans import store as st
from loomstream.queries import exported, landed_in_parts
from loomstream.sources.fixtures import Views
from tests.conftest import SF

START = "timestamp '2024-01-01'"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def long_series(spark):
    """One symbol with nine tenths of all rows, over two years; every tenth symbol row is missing, some closes are not positive."""
    path = st.scratch_dir(spark)
    rows = spark.range(20_000).selectExpr(
        "CASE WHEN id % 10 < 9 THEN 'HOT' ELSE concat('S', id % 70) END AS symbol", "'1h' AS ivl", f"{START} + make_interval(0, 0, 0, 0, CAST(id AS INT)) AS bar_ts", "CAST(pmod(hash(id), 97) AS DOUBLE) AS close", "id AS volume"
    )
    rows.write.parquet(path)
    return spark.read.parquet(path)


def test_pieces_of_a_long_series(spark, long_series):
    own = long_series.where("close > 0")
    got = audit.with_previous(own, "close", "prev")
    last, want = {}, {}
    for r in own.orderBy("symbol", "bar_ts").collect():
        want[r.symbol, r.bar_ts] = last.get(r.symbol)
        last[r.symbol] = r.close
    assert {(r.symbol, r.bar_ts): r.prev for r in got.collect()} == want
    # no window takes a whole series: its keys are the symbol and the piece, or it has a row for each piece
    text = plan(got)
    assert "__piece" in text and all("__piece" in line for line in text.split("\n") if "Window [" in line)
    pieces = own.withColumn("p", F.date_trunc("month", "bar_ts")).groupBy("symbol", "p").count().agg(F.max("count")).head()[0]
    assert pieces < 0.05 * own.count() < 0.9 * own.count() * 0.9


def test_a_piece_that_is_missing(spark):
    """The row before a month's first is found beyond months without rows; a null value before is null, not the one before it."""
    rows = [("A", "2024-01-31 23:00:00", 1.0), ("A", "2024-04-01 00:00:00", 2.0), ("A", "2024-04-01 01:00:00", None), ("A", "2024-06-01 00:00:00", 4.0), ("B", "2024-06-01 00:00:00", 5.0), ("A", "2024-07-01 00:00:00", None), ("A", "2024-08-01 00:00:00", 6.0)]
    df = spark.createDataFrame(rows, "symbol string, t string, close double").select("symbol", F.col("t").cast("timestamp").alias("bar_ts"), "close")
    got = {(r.symbol, r.bar_ts.month, r.bar_ts.hour): r.prev for r in audit.with_previous(df, "close", "prev").collect()}
    assert got == {("A", 1, 23): None, ("A", 4, 0): 1.0, ("A", 4, 1): 2.0, ("A", 6, 0): None, ("B", 6, 0): None, ("A", 7, 0): 4.0, ("A", 8, 0): None}


def test_ends_of_a_long_series(spark, long_series):
    per_day = long_series.groupBy("symbol", "ivl", F.to_date("bar_ts").alias("day")).agg(F.count("*").alias("bars"))
    got = audit.without_partial_days(per_day)
    assert "Window" not in plan(got) and got.columns == per_day.columns
    days = {}
    for r in per_day.collect():
        days.setdefault(r.symbol, []).append(r.day)
    want = {(s, d) for s, own in days.items() for d in own if len(own) <= 2 or min(own) < d < max(own)}
    assert {(r.symbol, r.day) for r in got.collect()} == want


def test_many_windows(spark):
    """100,000 overlapping windows, some empty, some of weeks, against a sorted list."""
    rng = random.Random(7)
    minute = 60
    times = sorted(rng.randrange(30 * 1440) for _ in range(3000))
    windows = [(f"w{i}", a := rng.randrange(30 * 1440), a + rng.choice([-5, 0, 1, 30, 60, 120] + [20_000] * (i % 100 == 0))) for i in range(100_000)]
    at = lambda c: F.timestamp_seconds(F.lit(1_704_067_200) + F.col(c) * minute)
    bars = spark.createDataFrame([(t,) for t in times], "t long").select(at("t").alias("bar_ts"), "t")
    spans = spark.createDataFrame(windows, "label string, a long, b long").select("label", at("a").alias("start_ts"), at("b").alias("end_ts"))
    got = filters.in_windows(bars, spans, 6 * 3600)
    assert "NestedLoop" not in plan(got) and "Cartesian" not in plan(got)
    want = {label: n for label, a, b in windows if (n := bisect.bisect_right(times, b) - bisect.bisect_left(times, a)) > 0}
    assert {r.label: r["count"] for r in got.groupBy("label").count().collect()} == want
    exact = got.where("label in ('w0', 'w100', 'w7')").select("label", "t").collect()
    assert sorted(tuple(r) for r in exact) == sorted((label, t) for label, a, b in windows if label in ("w0", "w100", "w7") for t in times if a <= t <= b)


def test_windows_before_the_epoch_and_at_edges(spark):
    rows = [("1969-12-31 23:59:59.999999",), ("1970-01-01 00:00:00",), ("1970-01-02 00:00:00",), (None,)]
    bars = spark.createDataFrame(rows, "t string").select(F.col("t").cast("timestamp").alias("bar_ts"))
    spans = spark.createDataFrame([("a", "1969-12-31 23:59:59.999999", "1970-01-02 00:00:00"), ("b", "1970-01-01 00:00:00", "1970-01-01 00:00:00"), ("c", "1970-01-02 00:00:00", "1970-01-01 00:00:00"), ("d", None, "1970-01-01 00:00:00")], "label string, s string, e string")
    got = filters.in_windows(bars, spans.select("label", F.col("s").cast("timestamp").alias("start_ts"), F.col("e").cast("timestamp").alias("end_ts")))
    assert {r.label: r["count"] for r in got.groupBy("label").count().collect()} == {"a": 3, "b": 1}


LEVEL = ["symbol", "ivl", "bar_ts", "open", "high", "low", "close", "volume"]


def test_cascade_of_levels(spark):
    """Each level is what it is when made of the minutes alone; all of them come from one scan."""
    minutes = Views.bars(Views(spark, SF).ticks_dense, "minute", "1m")
    path = st.scratch_dir(spark)
    minutes.withColumn("open", F.when(F.col("volume") % 50 != 0, F.col("open"))).write.parquet(path)
    own = spark.read.parquet(path)
    got = sessions.cascade(own)
    assert plan(got).count("FileScan") == 1
    shown = lambda df: sorted(map(str, df.select(*LEVEL).collect()))
    for level in sessions.LEVELS:
        start = sessions.LEVELS[level]()
        direct = sessions.rolled(own.where("open is not null").withColumn("__start", start).where("__start is not null"), F.col("__start")).withColumn("ivl", F.lit(level))
        assert shown(got.where(F.col("ivl") == level)) == shown(direct) != []
    assert {r.ivl for r in sessions.cascade(own, ["d", "m"]).select("ivl").distinct().collect()} == {"d", "m"}


def shuffled_rows(spark, df):
    """Rows that the query's exchanges write in all."""
    df.write.format("noop").mode("overwrite").save()
    spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty(10_000)
    store = spark._jsparkSession.sharedState().statusStore()
    last = store.executionsList().last()
    total = 0
    values = store.executionMetrics(last.executionId())
    for m in iterate(last.metrics()):
        if m.name() == "shuffle records written" and values.contains(m.accumulatorId()):
            total += int(values.apply(m.accumulatorId()).replace(",", "").split("\n")[-1].split(" ")[0])
    return total


def iterate(seq):
    it = seq.iterator()
    while it.hasNext():
        yield it.next()


def test_digests_first(spark):
    """Sides that are equal but for a few rows: the same differences, and few rows shuffled."""
    path = st.scratch_dir(spark)
    spark.range(40_000).selectExpr(
        "concat('S', id % 40) AS symbol", "'d' AS ivl", f"{START} + make_interval(0, 0, 0, CAST(id DIV 40 AS INT)) AS bar_ts", "1.0 AS open", "CAST(3 + id % 7 AS DOUBLE) AS high", "1.0 AS low", "CASE WHEN id % 11 <> 0 THEN 2.0 END AS close", "id AS volume"
    ).write.parquet(path)
    vendor = spark.read.parquet(path)
    broken = F.col("volume").isin(777, 20_011, 39_999)
    stored = vendor.withColumn("close", F.when(broken, F.lit(9.0)).otherwise(F.coalesce("close", F.lit(0.0)))).where("volume <> 31000").withColumn("open", F.when(F.col("volume") == 12_345, F.lit(1.001)).otherwise(F.col("open")))
    got, want = joins.reconcile_by_digest(vendor, stored), joins.reconcile(vendor, stored)
    shown = lambda df: sorted(map(str, df.collect()))
    assert shown(got) == shown(want) and want.count() == 4
    few, all_ = shuffled_rows(spark, got), shuffled_rows(spark, want)
    assert all_ >= 79_000 and few < all_ / 4, (few, all_)
    nobody = vendor.withColumn("symbol", F.when(F.col("volume") != 5, F.col("symbol")))
    assert shown(joins.reconcile_by_digest(nobody, vendor)) == shown(joins.reconcile(nobody, vendor))
    assert joins.reconcile_by_digest(vendor.limit(0), vendor).count() == 40_000 and joins.reconcile_by_digest(vendor, vendor).count() == 0


def test_landed_parts_grow_with_the_input(spark):
    """Files for two batches, but no task gets a whole part: each task that makes rows writes its own files."""
    seen = []
    for tasks in (1, 6):
        rows = spark.range(0, 3_000 * tasks, 1, tasks).selectExpr("concat('S', id % 7) AS symbol", "id AS volume", "'d' AS period")
        path, files = landed_in_parts(rows, 2)
        df = spark.read.schema(rows.schema).json(path)
        sizes = [r["count"] for r in df.groupBy(F.input_file_name()).count().collect()]
        assert sorted(map(tuple, df.select(*rows.columns).collect())) == sorted(map(tuple, rows.collect()))
        assert len(sizes) == 2 * tasks and files == tasks and max(sizes) < 2_000
        seen.append(sorted({r.symbol for r in df.where("part = 1").select("symbol").distinct().collect()}))
    assert seen[0] == seen[1] == [f"S{i}" for i in range(7)]


def test_exports_are_made_once(spark):
    """Rows that come out otherwise when they are made again are the same in both exports."""
    rows = spark.range(50).withColumn("u", F.expr("reflect('java.util.UUID', 'randomUUID')"))
    assert exported(rows).count() == 50


def test_common_rows(spark):
    schema = "a string, b double, c date"
    make = lambda *rows: spark.createDataFrame(rows, schema)
    left = make(*[("x", 1.0, None)] * 3, ("x", None, None), (None, None, None), (None, None, None), ("y", -0.0, None), ("z", float("nan"), None), ("only", 1.0, None))
    right = make(*[("x", 1.0, None)] * 2, ("x", None, None), (None, None, None), ("y", 0.0, None), ("z", float("nan"), None), ("other", 1.0, None))
    shown = lambda df: sorted(map(str, df.collect()))
    assert shown(joins.common_rows(left, right)) == shown(left.intersectAll(right)) and left.intersectAll(right).count() == 6


def test_dates_are_read_as_the_formatter_reads_them(spark):
    texts = ["2024-01-05", "2024-1-5", "2024-02-30", "2023-02-29", "2024-02-29", "0000-01-01", "0001-01-01", "9999-12-31", "12024-01-05", "2024-01-05 ", " 2024-01-05", "2024-01-05\n", "2024-01-1 ", "2024-01", "2024", "20240105", "bad", "", "-", "2024-13-01", "2024-01-05T00:00", "+2024-01-05", "-2024-01-05", "\u0662\u0660\u0662\u0664-01-05", None]
    df = spark.createDataFrame([(x,) for x in texts], "x string").select("x", scalar.safe_date("x").cast("string").alias("got"), F.try_to_date("x", "yyyy-M-d").cast("string").alias("want"))
    assert [tuple(r) for r in df.collect() if r.got != r.want] == []
