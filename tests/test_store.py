"""The bar store and what stands on it: commits of several writers, pruning, replayed and late batches, packing, coverage."""

from __future__ import annotations

import threading

import pytest
from pyspark.sql import functions as F

from loomstream.operators import coverage, normalize, sessions
from loomstream.plans import log
from loomstream.plans import store as st
from loomstream.plans.rollup import CoverageRollup
from loomstream.sources import feeds
from loomstream.sources.fixtures import AS_OF, Views
from loomstream.streaming import ingest
from tests.conftest import SF
from tests.test_boundaries import P, bars  # noqa: F401

DAY = "2024-01-02 00:00:00"


def closes(store):
    return sorted(r.close for r in store.bars().collect())


@pytest.fixture
def store(spark):
    return st.BarStore(spark, st.scratch_dir(spark))


@pytest.fixture(scope="module")
def hours(spark):
    """1h bars of the smallest tables as a table."""
    path = st.scratch_dir(spark)
    Views(spark, SF).bars_1h.write.parquet(path)
    return spark.read.parquet(path)


def test_a_name_is_taken_once(spark):
    target = f"{st.scratch_dir(spark)}/log/000000000001.json"
    won, start = [], threading.Barrier(8)

    def publish(i):
        start.wait()
        won.append((log.published(spark, str(i), target), i))

    threads = [threading.Thread(target=publish, args=(i,)) for i in range(8)]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    (winner,) = [i for ok, i in won if ok]
    assert log.read_text(spark, target) == str(winner) and [n for n, _ in log.listed(spark, target.rsplit("/", 1)[0])] == ["000000000001.json"]


def test_whole_writes(spark, bars, store):  # noqa: F811
    """Within a batch the later row wins; a reader's rows stay while others write; what a failed writer leaves is not read."""
    store.upsert(bars(("A", "d", DAY, (1, 3, 1, 2), 1), ("A", "d", DAY, (1, 3, 1, 9), 1)).coalesce(1))
    old = store.bars()
    assert [r.close for r in old.collect()] == [9]
    store.upsert(bars(("A", "d", DAY, (1, 3, 1, 5), 1), ("A", "d", "2024-02-02 00:00:00", P, 1)))
    assert [r.close for r in old.collect()] == [9] and closes(store) == [2, 5]
    store.insert_new(bars(("A", "d", DAY, (1, 3, 1, 8), 1), ("A", "d", "2024-01-03 00:00:00", (1, 3, 1, 6), 1)))
    assert closes(store) == [2, 5, 6]
    store.log.commit = lambda *a: (_ for _ in ()).throw(OSError("lost"))
    with pytest.raises(OSError):
        store.upsert(bars(("A", "d", DAY, (1, 3, 1, 7), 1)))
    again = st.BarStore(spark, store.path)
    assert closes(again) == [2, 5, 6]
    assert again.vacuum(0) >= 1 and closes(again) == [2, 5, 6]


def test_rows_without_keys(spark, bars, store):  # noqa: F811
    rows = bars(("A", "d", DAY, P, 1), ("C", "d", DAY, P, 2)).unionByName(bars(("X", "d", DAY, P, 3)).withColumn("symbol", F.lit(None).cast("string")))
    for _ in range(2):
        store.upsert(rows)
    assert sorted(r.volume for r in store.bars().collect()) == [1, 2, 3]
    store.upsert(bars(("X", "d", DAY, P, 4)).withColumn("symbol", F.lit(None).cast("string")))
    assert sorted(r.volume for r in store.bars().collect()) == [1, 2, 4]
    assert store.upsert(rows.limit(0)) and store.log.snapshot().number == 3


@pytest.mark.parametrize("mode", ["upsert", "insert_new"])
def test_writers_at_the_same_time(spark, bars, mode):  # noqa: F811
    """Writers of other partitions pass each other; of one partition, the later works again from what the first left. No row is lost or doubled."""
    path = st.scratch_dir(spark)
    st.BarStore(spark, path).upsert(bars(("A", "d", DAY, P, 1)))
    batches = [bars((s, "d", f"2024-0{m}-02 00:00:00", (1, 3, 1, 2 + i), 1)) for i, (s, m) in enumerate([("A", 2), ("B", 2), ("C", 3), ("B", 1), ("B", 2)])]
    start, errors = threading.Barrier(len(batches)), []

    def write(batch):
        try:
            start.wait()
            getattr(st.BarStore(spark, path), mode)(batch)
        except Exception as e:
            errors.append(e)

    threads = [threading.Thread(target=write, args=(b,)) for b in batches]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    got = sorted((r.symbol, r.bar_ts.month) for r in st.BarStore(spark, path).bars().collect())
    assert not errors and got == [("A", 1), ("A", 2), ("B", 1), ("B", 2), ("C", 3)]


def test_conflicts_are_raised_in_the_end(spark, bars, store):  # noqa: F811
    store.upsert(bars(("A", "d", DAY, P, 1)))
    other, commit = st.BarStore(spark, store.path), store.log.commit

    def late(*args):
        other.upsert(bars(("A", "d", DAY, (1, 3, 1, 7), 1)))
        return commit(*args)

    store.log.commit, store.attempts = late, 2
    with pytest.raises(log.Conflict):
        store.upsert(bars(("A", "d", DAY, (1, 3, 1, 8), 1)))
    assert closes(other) == [7]
    other.vacuum(0)
    assert closes(other) == [7]


def test_a_hundred_upserts_stay_few_files(spark):
    """Commits and data that nobody needs go with a vacuum; what is read does not grow with the number of writes."""
    table = st.VersionedTable(spark, st.scratch_dir(spark), "n long")
    for i in range(100):
        table.log.commit(table.log.snapshot(), [{"path": f"v{i}"}], [f"v{i - 1}"], ["all"])
    commits, wholes = table.log.numbers()
    assert (len(commits), len(wholes)) == (100, 10)
    assert list(table.log.snapshot().files) == ["v99"] and table.log.snapshot(57).files.keys() == {"v56"}
    assert table.log.forget(10**15).number == 100
    commits, wholes = table.log.numbers()
    assert (commits, wholes) == ([], [100]) and list(table.log.snapshot().files) == ["v99"]


def test_versions_of_a_store_are_bounded(spark, bars, store):  # noqa: F811
    for i in range(12):
        store.upsert(bars(("A", "d", DAY, (1, 3, 1, i), 1)))
        store.vacuum(0)
    assert len([n for n, _ in log.listed(spark, f"{store.path}/data") if n.startswith("version=")]) <= store.log.EVERY + 1
    assert closes(store) == [11]


def test_reads_name_their_files(spark, hours):
    """One symbol and week: of the files only those that can hold rows of them are read, and of all columns those that are asked for."""
    store = st.BarStore(spark, st.scratch_dir(spark), file_rows=8)
    store.upsert(hours)
    all_ = len(store.files())
    own = feeds.bars_range(store, "CLICK.JK", "1h", "2024-01-10 00:00:00", "2024-01-16 23:59:59")
    week = {(d, f"2024-01-{d:02d}") for d in range(10, 17)}
    read = own.inputFiles()
    assert all_ > 60 and 0 < len(read) < all_ / 6 and all(any(f"dt={d}" in f for _, d in week) for f in read)
    want = hours.where("symbol = 'CLICK.JK' and bar_ts between '2024-01-10' and '2024-01-16 23:59:59'")
    assert own.count() == want.count() > 10
    newest = store.newest(20, "1h")
    assert len(newest.inputFiles()) < all_ / 4
    top = lambda df: [tuple(r) for r in df.orderBy(F.desc("bar_ts"), "symbol").limit(20).select("symbol", "bar_ts", "close").collect()]
    assert top(newest) == top(hours)
    assert len(feeds.bars_lookback(store, ["VIEW.JK"], AS_OF, days=3).inputFiles()) < all_ / 6
    assert store.scan("1h", ["NONE"]).count() == 0


def test_packing(spark, hours):
    store = st.BarStore(spark, st.scratch_dir(spark))
    for i in range(3):
        store.insert_new(hours.where(f"volume % 3 = {i}"))
    before, rows = store.files(), sorted(map(str, store.bars().collect()))
    gone = store.pack()
    after = store.files()
    assert gone > len(before) / 2 and len(after) < len(before) / 2 and sum(f["rows"] for f in after) == sum(f["rows"] for f in before) == len(rows)
    assert sorted(map(str, store.bars().collect())) == rows and all(f["bytes"] > 0 for f in after)
    profile = store.profile().groupBy("dt").agg(F.sum("rows").alias("n")).collect()
    assert {r.dt: r.n for r in profile} == {r.d: r["count"] for r in hours.groupBy(F.date_format("bar_ts", "yyyy-MM-dd").alias("d")).count().collect()}


def test_coverage_is_kept_along(spark, bars, hours, store):  # noqa: F811
    """Equal to the full aggregate after each write, and after one that takes a maximum away."""
    rollup = CoverageRollup(spark, st.scratch_dir(spark), store)
    assert rollup.refresh() == 0 and rollup.coverage().count() == 0
    same = lambda: sorted(map(str, rollup.coverage().select("symbol", "ivl", "data_start", "data_end", "total_records").collect())) == sorted(map(str, coverage.coverage(store.bars()).collect()))
    store.upsert(hours)
    assert rollup.refresh() == len({f["dt"] for f in store.files()}) and same()
    store.upsert(bars(("CLICK.JK", "1h", "2024-01-05 03:00:00", P, 1), ("NEW", "d", DAY, P, 1)))
    assert rollup.refresh() == 2 and same() and rollup.refresh() == 0
    last = store.log.snapshot()
    top = max(last.files.values(), key=lambda f: f["until"])
    store.log.commit(last, [], [top["path"]], [f"{top['ivl']}/{top['dt']}"])  # a file goes, and with it the largest time
    assert rollup.refresh() == 1 and same()


def test_replayed_batches_change_nothing(spark, bars, store):  # noqa: F811
    """A batch that was committed before its stream died is run again."""
    batch = bars(("A", "d", DAY, P, 1))
    assert store.insert_new(batch, "feed", 0) and not store.insert_new(batch.withColumn("symbol", F.lit("B")), "feed", 0)
    store.upsert(bars(("A", "d", DAY, (1, 3, 1, 9), 1)))
    assert not store.upsert(batch, "feed", 0) and closes(store) == [9]  # the later correction stays
    assert store.insert_new(batch, "feed", 1) and closes(store) == [9] and store.insert_new(batch, "other", 0)


def test_killed_after_the_write(spark, tmp_path):
    """The stream dies between the commit of the store and its own: the batch runs again and adds nothing; bad rows are kept once."""
    landing, checkpoint, quarantine = str(tmp_path / "in"), st.scratch_dir(spark), st.scratch_dir(spark)
    schema = f"{feeds.schemas.EOD}, symbol string, period string"
    rows = [("2024-01-02", 1.0, 3.0, 1.0, 2.0, 2.0, 5, "A", "d"), ("2024-1-3", 1.0, 3.0, 1.0, 2.0, 2.0, 6, "A", "d"), ("33.1.2024", 1.0, 3.0, 1.0, 2.0, 2.0, 7, "B", "d")]
    spark.createDataFrame(rows, schema).coalesce(1).write.json(landing)
    store = st.BarStore(spark, st.scratch_dir(spark))
    real = store.insert_new

    def dies(*args):
        real(*args)
        raise RuntimeError("killed")

    go = lambda: ingest.ingest_bars(spark.readStream.schema(schema).json(landing), lambda b: normalize.eod(b, AS_OF), store, checkpoint, True, lambda b: b.where(ingest.undated("date")), quarantine)
    store.insert_new = dies
    with pytest.raises(Exception, match="killed"):
        go()
    assert store.bars().count() == 2
    store.insert_new = real
    go()
    assert sorted(r.volume for r in store.bars().collect()) == [5, 6] and [r.symbol for r in spark.read.parquet(quarantine).collect()] == ["B"]


def run_sessions(spark, batches, horizon):
    landing, checkpoint = st.scratch_dir(spark), st.scratch_dir(spark)
    source, target = (st.BarStore(spark, st.scratch_dir(spark)) for _ in range(2))
    late = 0
    for i, df in enumerate(batches):
        own = df.withColumn("sent", F.lit(i))
        own.coalesce(1).write.mode("append").parquet(landing)
        late += ingest.keep_session_bars(spark.readStream.schema(own.schema).option("maxFilesPerTrigger", 1).parquet(landing), source, target, checkpoint, AS_OF, ["sent"], horizon)
    return source, target, late


def shown(df):
    return sorted(map(str, df.select("symbol", "bar_ts", "open", "high", "low", "close", "volume").collect()))


def test_sessions_over_several_runs(spark, bars):  # noqa: F811
    """The last batch corrects the first day: its session is made again, others stay; an open price that goes takes its hour along."""
    days = [bars(("A", "1h", "2024-01-02 02:00:00", (1, 9, 1, 2), 10), ("A", "1h", "2024-01-02 03:00:00", (1, 8, 1, 4), 1)), bars(("A", "1h", "2024-01-03 02:00:00", (1, 9, 1, 3), 10)), bars(("A", "1h", "2024-01-02 02:00:00", (5, 7, 1, 7), 20), ("A", "1h", "2024-01-02 03:00:00", (None, 8, 1, 4), 1))]
    source, target, late = run_sessions(spark, days, "10 days")
    assert late == 0 and shown(target.bars()) == shown(sessions.session_bars(source.bars()))
    assert sorted((r.bar_ts.day, r.open, r.close, r.volume) for r in target.bars().collect()) == [(2, 5, 7, 20), (3, 1, 3, 10)]


def test_late_and_odd_bars(spark, bars):  # noqa: F811
    """Corrections beyond the horizon have no state any more, and a bar off the hour has no place in it: both come from the store."""
    batches = [
        bars(("A", "1h", "2024-01-02 02:00:00", (1, 9, 1, 2), 10), ("B", "1h", "2024-01-02 06:00:00", P, 3)), bars(("A", "1h", "2024-01-20 02:00:00", P, 1), ("A", "1h", "2024-01-20 02:30:00", (1, 9, 1, 5), 2)),
        bars(("A", "1h", "2024-01-21 02:00:00", P, 1)), bars(("A", "1h", "2024-01-02 02:00:00", (1, 9, 1, 8), 11)),
    ]
    source, target, late = run_sessions(spark, batches, "3 days")
    assert late == 1 and shown(target.bars()) == shown(sessions.session_bars(source.bars()))
    assert {(r.bar_ts.day, r.symbol): (r.close, r.volume) for r in target.bars().collect()} == {(2, "A"): (8, 11), (2, "B"): (2, 3), (20, "A"): (5, 3), (21, "A"): (2, 1)}
