"""Incremental ingest with Structured Streaming: landed feeds into the store, rejected rows beside it, and 4h bars kept current."""

from __future__ import annotations

import hashlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators import sessions
from ..plans.store import BarStore, scratch_dir
from ..sources.schemas import EOD


def stream_feed(spark: SparkSession, path: str, schema: str = EOD, files_per_batch: int = 64) -> DataFrame:
    return spark.readStream.schema(f"{schema}, symbol string, period string").option("maxFilesPerTrigger", files_per_batch).json(path)


def stream_name(checkpoint: str) -> str:
    """A stream is known by its checkpoint, which numbers its batches."""
    return hashlib.sha256(checkpoint.encode()).hexdigest()[:16]


def run(stream: DataFrame, step: Callable[[DataFrame, int], None], checkpoint: str, mode: str = "append", partitions: int | None = None) -> StreamingQuery:
    """Works off what has landed since the last run. ``partitions``: of the state, from the first run on; those of the session by default."""
    conf, key = stream.sparkSession.conf, "spark.sql.shuffle.partitions"
    before = conf.get(key)
    try:
        conf.set(key, str(partitions or before))  # a stream takes the settings along that hold when it starts
        query = stream.writeStream.foreachBatch(step).outputMode(mode).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    finally:
        conf.set(key, before)
    query.awaitTermination()
    return query


def put_batch(rows: DataFrame, path: str, checkpoint: str, number: int) -> None:
    """Rows of a batch in a folder of its own: a batch that is run again takes its own place."""
    rows.write.mode("overwrite").parquet(f"{path}/stream={stream_name(checkpoint)}/batch={number}")


def ingest_bars(
    feed: DataFrame, normalise: Callable[[DataFrame], DataFrame], store: BarStore, checkpoint: str, insert_only: bool = False, rejected: Callable[[DataFrame], DataFrame] | None = None, quarantine: str | None = None
) -> None:
    """Writes what has landed since the last run, once: each commit of the store names the stream and its batch, so a batch that runs again changes nothing.

    Corrections of any age replace stored bars, or with ``insert_only`` none do; nothing is dropped as late. Rows that
    ``rejected`` picks go to the quarantine folder before the batch is committed.
    """
    write = store.insert_new if insert_only else store.upsert

    def step(batch: DataFrame, number: int) -> None:
        if rejected is not None and quarantine is not None:
            put_batch(rejected(batch), quarantine, checkpoint, number)
        write(normalise(batch), stream_name(checkpoint), number)

    run(feed, step, checkpoint)


def ingest_actions(feed: DataFrame, normalise: Callable[[DataFrame], DataFrame], path: str, checkpoint: str, quarantine: str) -> None:
    """Appends actions that have a date; what their feed has without one goes to the quarantine folder. Both once for each batch."""

    def step(batch: DataFrame, number: int) -> None:
        put_batch(batch.where(undated("date")).withColumn("reason", F.lit("date cannot be read")), quarantine, checkpoint, number)
        put_batch(normalise(batch).where(F.col("action_date").isNotNull()), path, checkpoint, number)

    run(feed, step, checkpoint)


def undated(column: str):
    """Whether a row has a date that cannot be read. A missing one is no record at all for the per-symbol feeds."""
    return (F.col(column) != "") & F.try_to_date(F.col(column), "yyyy-M-d").isNull()


#: Hours of the longest session.
SLOTS = max(len(hours) for hours, _ in sessions.SESSIONS.values())
PRICES = ("open", "high", "low", "close", "adjusted_close", "volume")


def session_states(bars: DataFrame, order: list[str], horizon: str) -> DataFrame:
    """A row for each session that a batch touches, from its state: for each of its hours, the bar that was written last.

    The state is the aggregate's own: some hours of each symbol and session, kept until sessions begin that are
    later by the horizon. ``odd``: the session has had a bar that does not begin at a full hour, so the hours are not enough.
    """
    start = sessions.session_of("bar_ts")[1]
    own = bars.where((F.col("ivl") == "1h") & start.isNotNull()).withColumn("session_ts", start).withWatermark("session_ts", horizon)
    slot = F.hour("bar_ts") - F.hour("session_ts")
    bar, written = F.struct(*[c for c in PRICES if c in bars.columns]), F.struct(*order)
    odd = F.bool_or(F.date_trunc("hour", "bar_ts") != F.col("bar_ts")).alias("odd")
    return own.groupBy("symbol", "session_ts").agg(*[F.max_by(bar, F.when(slot == i, written)).alias(f"h{i}") for i in range(SLOTS)], odd)


def session_rows(states: DataFrame, as_of: str) -> DataFrame:
    """Session bars of states, as ``sessions.session_bars`` makes them; hours without an open price do not count."""
    hours = F.filter(F.array(*[f"h{i}" for i in range(SLOTS)]), lambda h: h["open"].isNotNull())
    own = states.withColumn("hours", hours).where(F.size("hours") > 0)
    fields = states.schema["h0"].dataType.names
    each = lambda c: F.transform("hours", lambda h: h[c])
    known = lambda c: F.filter(each(c), lambda x: x.isNotNull())
    total = F.when(F.size(known("volume")) > 0, F.aggregate(known("volume"), F.lit(0).cast("long"), lambda a, x: a + x))
    last = [F.element_at(each("adjusted_close"), -1).alias("adjusted_close")] if "adjusted_close" in fields else []
    return own.select(
        "symbol", F.lit("4h").alias("ivl"), F.col("session_ts").alias("bar_ts"), F.element_at(each("open"), 1).alias("open"), F.array_max(each("high")).alias("high"), F.array_min(each("low")).alias("low"),
        F.element_at(each("close"), -1).alias("close"), *last, total.alias("volume"), F.lit(0).alias("gmtoffset"), F.lit("aggregated").alias("source"), F.lit(as_of).cast("timestamp").alias("created_at"),
    )


def remade(source: BarStore, parts: set[str], touched: DataFrame | None, as_of: str) -> DataFrame:
    """Session bars made again from stored bars of some partitions; ``touched``: of these symbols and sessions only."""
    near = source.rows_of(source.files(lambda f: f"{f['ivl']}/{f['dt']}" in parts)).drop("dt")
    made = sessions.session_bars(near).withColumn("created_at", F.lit(as_of).cast("timestamp"))
    return made if touched is None else made.join(touched.select("symbol", F.col("session_ts").alias("bar_ts")).distinct(), ["symbol", "bar_ts"], "left_semi")


def keep_session_bars(bars: DataFrame, source: BarStore, target: BarStore, checkpoint: str, as_of: str, order: list[str], horizon: str = "10 days", state_partitions: int | None = None) -> int:
    """Stores 1h bars as they arrive and keeps the bars of their sessions; returns the rows that came too late for the state.

    The first stream stores the bars. The second keeps a state for each session and writes a session's bar whenever a
    batch changes it: while it is open, once it is closed, and again on a correction, without reading the store.
    ``order`` names the columns by which a bar counts as written later; ``state_partitions`` is for few symbols or many. Corrections older than the horizon meet no state
    any more, and sessions with bars off the full hour do not fit into it: both are made again from the stored bars of
    the partitions that this run has written, so no correction is lost. A session whose bars all lose their open price
    keeps its last bar.
    """
    before = source.log.snapshot().number
    plain = bars.drop(*[c for c in order if c not in PRICES and c != "created_at"])
    ingest_bars(plain, lambda b: b, source, f"{checkpoint}/bars")
    written = {p for p, n in source.log.snapshot().touched.items() if n > before}

    def step(states: DataFrame, number: int) -> None:
        path = scratch_dir(source.spark)
        states.write.parquet(path)  # the state is read and advanced once
        own = source.spark.read.schema(states.schema).parquet(path)
        rows, odd = session_rows(own.where(~F.col("odd")), as_of), own.where("odd")
        if not odd.isEmpty():
            every = {f"{f['ivl']}/{f['dt']}" for f in source.files(lambda f: f["ivl"] == "1h")}
            rows = rows.unionByName(remade(source, every, odd, as_of), allowMissingColumns=True)
        target.upsert(rows, stream_name(f"{checkpoint}/sessions"), number)

    query = run(session_states(bars, order, horizon), step, f"{checkpoint}/sessions", "update", state_partitions)
    late = sum(int(s.numRowsDroppedByWatermark) for p in query.recentProgress for s in p.stateOperators)
    if late:
        target.upsert(remade(source, written, None, as_of))
    return late
