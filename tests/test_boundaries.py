"""Hand-made rows at the edges of each rule."""

from __future__ import annotations

import duckdb
import pytest
from pyspark.sql import functions as F

from loomstream.functions import scalar
from loomstream.operators import audit, coverage, filters, joins, normalize, sessions
from loomstream.plans import store as st
from loomstream.queries import SINCE, SPIKES
from loomstream.sources import feeds
from loomstream.sources.fixtures import AS_OF

BAR = "symbol string, ivl string, bar_ts timestamp, open double, high double, low double, close double, volume long"


@pytest.fixture
def bars(spark):
    def make(*rows):
        full = [(s, i, t, *p, v) for s, i, t, p, v in rows]
        text = spark.createDataFrame([(s, i, t, *map(lambda x: None if x is None else float(x), p), v) for s, i, t, *p, v in full], BAR.replace("bar_ts timestamp", "bar_ts string"))
        return text.withColumn("bar_ts", F.col("bar_ts").cast("timestamp"))

    return make


P = (1, 3, 1, 2)


def stamps(df, column="bar_ts"):
    return sorted(r[0] for r in df.select(F.date_format(column, "yyyy-MM-dd HH:mm")).collect())


def test_session_hours(bars):
    df = bars(*[("A", "1h", f"2024-01-02 {h:02d}:00:00", (h, h + 5, h - 1, h + 1), 10) for h in (1, 2, 4, 5, 6, 9, 10)], ("B", "1h", "2024-01-02 03:00:00", (None, 2, 1, 1), 5), ("B", "1h", "2024-01-02 04:00:00", (1, 2, 1, None), 5), ("A", "5m", "2024-01-02 03:00:00", P, 1))
    got = {(r.symbol, r.bar_ts.hour): r for r in sessions.session_bars(df).collect()}
    assert set(got) == {("A", 2), ("A", 6), ("B", 2)}
    am, pm = got["A", 2], got["A", 6]
    assert (am.open, am.high, am.low, am.close, am.volume, am.ivl, am.gmtoffset, am.source) == (2, 9, 1, 5, 20, "4h", 0, "aggregated")
    assert (pm.open, pm.high, pm.close, pm.volume) == (6, 14, 10, 20) and got["B", 2].close is None and got["B", 2].volume == 5


def test_null_near_hours_and_zero_price(bars):
    none = (None, None, None, None)
    df = bars(*[("A", "5m", f"2024-01-02 {t}:00", none, 1) for t in ("08:59", "09:00", "15:59", "16:00")], ("Z", "5m", "2024-01-02 03:00:00", (0, 1, 0, 1), 1))
    assert stamps(normalize.keep_null_in_hours(df)) == ["2024-01-02 03:00", "2024-01-02 09:00", "2024-01-02 15:59"]
    assert stamps(normalize.keep_null_in_hours(df, zero_is_null=True)) == ["2024-01-02 09:00", "2024-01-02 15:59"]


def test_corrections_in_both_modes(spark, bars):
    old, new = bars(("A", "d", "2024-01-02 00:00:00", P, 1)), bars(("A", "d", "2024-01-02 00:00:00", (1, 3, 1, 9), 2), ("A", "d", "2024-02-02 00:00:00", P, 3))
    for mode, close in (("upsert", 9), ("insert_new", 2)):
        store = st.BarStore(spark, st.scratch_dir(spark))
        store.upsert(old)
        for _ in range(2):  # twice is once
            getattr(store, mode)(new)
        assert sorted((r.bar_ts.month, r.close) for r in store.bars().collect()) == [(1, close), (2, 2)]


def test_spikes_round_as_their_sql(spark, bars):
    """Percentages in the middle between two tenths whose doubles are just below it, and closes with three places."""
    closes = [20.0, 420.89, 100.0, 326.65, 20.0, 32.19, 80.0, 488.28, 1.005, 2.675, 1.25, 0.015, 0.5, 16.0, 41.0]
    df = bars(*[("A", "d", f"2024-01-{10 + i} 00:00:00", (c, c, c, c), 1) for i, c in enumerate(closes)])
    got = sorted(tuple(r) for r in audit.spikes(df, "d", SINCE).select(F.date_format("bar_ts", "yyyy-MM-dd HH:mm:ss"), "prev_close", "close", "pct").collect())
    values = ", ".join(f"('A', TIMESTAMP '2024-01-{10 + i} 00:00:00', CAST({c} AS DOUBLE))" for i, c in enumerate(closes))
    want = duckdb.sql(f"SELECT CAST(bar_ts AS VARCHAR), prev_close, close, pct FROM ({SPIKES.format(f'(VALUES {values}) b(symbol, bar_ts, close)')})").fetchall()
    assert got == sorted(want) and {r[3] for r in got} >= {2004.5, 226.7, 61.0, 510.4}


def test_coverage_of_one_day(spark):
    def cov(when, n):
        return spark.createDataFrame([("A", "d", when, n, when, when)], "symbol string, ivl string, u string, total_records long, s string, e string").select("symbol", "ivl", F.col("u").cast("timestamp").alias("last_updated"), "total_records", F.col("s").cast("timestamp").alias("data_start"), F.col("e").cast("timestamp").alias("data_end"))

    table = coverage.upserted(coverage.upserted(cov("2024-01-02 08:00:00", 5), cov("2024-01-02 20:00:00", 7)), cov("2024-01-03 01:00:00", 9))
    assert sorted((r.last_updated.day, r.last_updated.hour, r.total_records) for r in table.collect()) == [(2, 8, 7), (3, 1, 9)]


def ends(spark, rows):
    return spark.createDataFrame(rows, "symbol string, e string, total_records long").select("symbol", F.col("e").cast("timestamp").alias("data_end"), "total_records")


def test_medians_and_floor_lag(spark):
    df = ends(spark, [(f"S{i}", f"2024-01-0{i} 00:00:00", i) for i in (1, 2, 3, 4)])
    assert audit.row_distribution(df).head().median_rows == 2
    assert df.agg(audit.upper_median("data_end").alias("m")).head().m.day == 3
    lags = ends(spark, [("M1", "2024-01-20 00:00:00", 1), ("M2", "2024-01-20 00:00:00", 1), ("M3", "2024-01-20 00:00:00", 1), ("A", "2024-01-12 01:00:00", 1), ("B", "2024-01-12 00:00:00", 1)])
    assert {r.symbol: (r.lag_days, r.stale) for r in audit.staleness(lags).collect() if r.symbol in "AB"} == {"A": (7, False), "B": (8, True)}


def test_freshness_edge(spark):
    rows = [("EQ", "2024-01-30 23:00:00"), ("OLD", "2024-01-30 22:59:59.999999"), ("NUL", None)]
    hist = spark.createDataFrame([(s, "d", AS_OF, e) for s, e in rows], "symbol string, ivl string, u string, e string").select("symbol", "ivl", F.col("u").cast("timestamp").alias("last_updated"), F.col("e").cast("timestamp").alias("data_end"))
    symbols = spark.createDataFrame([(s,) for s in ("EQ", "OLD", "NUL", "NEW")], "symbol string")
    assert {r.symbol: r.status for r in coverage.freshness(symbols, hist, AS_OF).collect()} == {"EQ": "fresh", "OLD": "stale", "NUL": "unknown", "NEW": "unknown"}


def test_ohlc_predicate(bars):
    df = bars(*[(str(i), "d", "2024-01-02 00:00:00", p, 1) for i, p in enumerate([(1, 1, 1, 1), (1, 1, 2, 1), (4, 3, 1, 2), (2, 3, 1.5, 1), (1, None, 1, 1)])])
    assert [r.valid for r in filters.with_validity(df).orderBy("symbol").collect()] == [True, False, False, False, False]


def test_split_text(spark):
    df = spark.createDataFrame([(x, "2024-01-02", x) for x in ("2/1", "2.0/1", "2/x", "x/2", "3:1", "")], "code string, date string, split string").withColumn("split_date", F.lit(None).cast("string")).withColumn("symbol", F.col("code"))
    one = {r.split_ratio: (r.split_from, r.split_to) for r in normalize.splits(df, AS_OF).collect()}
    assert one == {"2/1": (2, 1), "2.0/1": (None, None), "2/x": (2, None), "x/2": (None, None), "3:1": (None, None), "": (None, None)}
    bulk = {r.split_ratio: (r.split_from, r.split_to) for r in normalize.splits_bulk(df, AS_OF).collect()}
    assert bulk["2.0/1"] == (2, 1) and bulk["2/x"] == (2, None) and bulk["x/2"] == (None, None)


def test_dividend_dates(spark):
    schema = "code string, date string, ex_date string, exDate string, value string, dividend string, currency string, paymentDate string, recordDate string, declarationDate string, period string"
    rest = (None,) * 5
    df = spark.createDataFrame([("A", "", "2024-1-5", None, "1", "2", *rest), ("B", None, None, "2024-01-06", None, "2", *rest), ("C", None, None, None, "1", None, *rest), ("D", "bad", "2024-01-05", None, "1", None, *rest)], schema)
    assert sorted((r.symbol, r.action_date.day, r.dividend_amount) for r in normalize.dividends_bulk(df, AS_OF).collect()) == [("A.JK", 5, 1.0), ("B.JK", 6, 2.0)]


def test_symbols_and_trading_days(spark):
    df = spark.createDataFrame([("ABC",), ("ABC.JK",), ("A.B",)], "code string")
    assert [r.symbol for r in normalize.qualify_codes(df).collect()] == ["ABC.JK", "ABC.JK", "A.B"]
    assert [r.symbol for r in normalize.suffix_codes(df).collect()] == ["ABC.JK", "ABC.JK", "A.B.JK"]
    days = spark.createDataFrame([(f"2024-01-{d:02d}",) for d in range(1, 8)], "d string").select(scalar.last_trading_day(F.col("d").cast("date")).alias("t"))
    assert [r.t.day for r in days.collect()] == [1, 2, 3, 4, 5, 5, 5]
    lines = spark.createDataFrame([(x,) for x in ("# note", "", " ABC ", "X.JK")], "value string")
    assert [r.symbol for r in feeds.symbol_list(lines).collect()] == ["ABC.JK", "X.JK"]


def test_partial_days(bars):
    df = bars(*[(s, "1h", f"2024-01-{d:02d} 03:00:00", P, 1) for s, n in (("A", 1), ("B", 2), ("C", 3)) for d in range(2, 2 + n)])
    got = audit.without_partial_days(audit.bars_per_day(df, AS_OF)).groupBy("symbol").count().collect()
    assert {r.symbol: r["count"] for r in got} == {"A": 1, "B": 2, "C": 1}


def test_tolerance(bars):
    day = "2024-01-02 00:00:00"
    vendor = bars(("A", "d", day, (1.009, 3, 1, 2), 1), ("B", "d", day, (1.011, 3, 1, 2), 1), ("C", "d", day, P, 2), ("D", "d", day, (None, 3, 1, 2), 1), ("V", "d", day, P, 1))
    stored = bars(("A", "d", day, P, 1), ("B", "d", day, P, 1), ("C", "d", day, P, 1), ("D", "d", day, (0, 3, 1, 2), 1), ("S", "d", day, P, 1))
    assert sorted((r.symbol, r.kind, r.fields) for r in joins.reconcile(vendor, stored).where("kind = 'mismatch' or symbol in ('V', 'S')").select("symbol", "kind", "fields").collect()) == [("B", "mismatch", "open"), ("C", "mismatch", "volume"), ("S", "only_store", ""), ("V", "only_vendor", "")]


def test_volume_is_kept_and_limits_hold(spark):
    from loomstream.sources.fixtures import Views

    v = Views(spark, "/root/testdata/sf0.001")
    four = sessions.session_bars(v.bars_1h)
    assert four.agg(F.sum("volume")).head()[0] == sessions.in_session(v.bars_1h).agg(F.sum("volume")).head()[0]
    assert four.where("low > open or low > close or high < open or high < close").isEmpty()


def test_entry(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() > 0


def test_multi_line_arrays(spark, tmp_path):
    (tmp_path / "symbol=A" / "period=d").mkdir(parents=True)
    (tmp_path / "symbol=A" / "period=d" / "x.json").write_text('[\n {"date": "2024-01-02", "open": 1, "high": 2, "low": 1, "close": 1.5, "volume": 7},\n {"date": "bad", "open": 1}\n]')
    df = feeds.read_feed(spark, str(tmp_path), feeds.schemas.EOD, multi_line=True)
    assert df.count() == 2 and [(r.symbol, r.ivl, r.volume) for r in normalize.eod(df, AS_OF).collect()] == [("A", "d", 7)]


def test_first_symbols_follow_the_lines(spark):
    path = st.scratch_dir(spark)
    spark.createDataFrame([(x,) for x in ("# list", "ZZZ", "", "BBB.JK", " AAA ", "CCC")], "value string").coalesce(1).write.text(path)
    assert [r.symbol for r in feeds.first_symbols(spark, path, 3).collect()] == ["ZZZ.JK", "BBB.JK", "AAA.JK"]


def test_versioned_table(spark):
    table = st.VersionedTable(spark, st.scratch_dir(spark), "symbol string, ivl string, last_updated timestamp, total_records long, data_start timestamp, data_end timestamp")
    assert table.read().count() == 0
    rows = spark.sql("select symbol, 'd' ivl, timestamp '2024-01-02 03:00:00' + make_interval(0, 0, 0, d) last_updated, cast(n as long) total_records, timestamp '2024-01-01' data_start, timestamp '2024-01-02' data_end from values ('A', 0, 1), ('A', 1, 2), ('B', 0, 3) t(symbol, d, n)")
    table.replace(rows)
    st.upsert_coverage(table, rows.where("symbol = 'A' and total_records = 2").withColumn("total_records", F.lit(5).cast("long")))
    assert sorted((r.symbol, r.total_records) for r in table.read().collect()) == [("A", 1), ("A", 5), ("B", 3)]
    assert tuple(st.cleanup_coverage(table, AS_OF).head()) == (3, 2, 1)
    assert sorted((r.symbol, r.total_records) for r in table.read().collect()) == [("A", 5), ("B", 3)]
