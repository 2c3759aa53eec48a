"""The keyed bar store and the other sinks: Parquet, partitioned by interval and date."""

from __future__ import annotations

import json
import tempfile
import time
import uuid
from collections.abc import Callable, Sequence
from datetime import datetime, timezone
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.audit import last_write
from ..operators.coverage import cleanup, upserted
from ..operators.joins import new_bars
from ..sources import schemas
from .log import CommitLog, Conflict, Snapshot, listed, read_text, removed


def scratch_dir(spark: SparkSession) -> str:
    """A new folder in the shared folder of ``spark.checkpoint.dir``; where that is unset, a temporary one in local mode, and an error on a cluster."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        base = tempfile.mkdtemp(prefix="spark-", dir="/tmp")
        spark.conf.set("spark.checkpoint.dir", base)
    return f"{base.rstrip('/')}/{uuid.uuid4().hex}"


def partition_date() -> Column:
    """Months for d, w and m bars, days for shorter ones."""
    return F.when(F.col("ivl").isin("d", "w", "m"), F.date_format("bar_ts", "yyyy-MM")).otherwise(F.date_format("bar_ts", "yyyy-MM-dd"))


def micros(at: str) -> int:
    """Microseconds of a UTC time, date with or without time of day."""
    return round(datetime.fromisoformat(at).replace(tzinfo=timezone.utc).timestamp() * 1_000_000)


#: Rows of a file, about: what is read for one symbol and week is a few of them.
FILE_ROWS = 2_000_000

#: What a commit knows of each file: ranges of its symbols and times, rows and bytes.
RANGES = ("first", "last", "since", "until")


def ranges() -> list[Column]:
    """First and last symbol and time of a group; null, that is not known, where one of its rows has none."""
    ts = F.unix_micros("bar_ts")
    known = lambda c, x: F.when(F.count(c) == F.count("*"), x)
    return [known("symbol", F.min("symbol")).alias("first"), known("symbol", F.max("symbol")).alias("last"), known("bar_ts", F.min(ts)).alias("since"), known("bar_ts", F.max(ts)).alias("until")]


def overlaps(f: dict, first: str | None, last: str | None, since: int | None, until: int | None) -> bool:
    """Whether a file can hold rows of these ranges; a range that is not known holds all."""
    apart = lambda lo, hi, a, b: None not in (lo, hi) and ((a is not None and hi < a) or (b is not None and lo > b))
    return not apart(f["first"], f["last"], first, last) and not apart(f["since"], f["until"], since, until)


class BarStore:
    """Bars under a path. Files lie under ``data/version=/ivl=/dt=``, clustered by symbol and time; a file counts once a commit names it.

    Each write reads and replaces only the files whose ranges its batch meets, writes its own, and commits both lists
    under the next free number. Of two writers at a time, one passes the other's commit if the partitions are different,
    and works again from the new rows if not; so no write is lost, and readers see all of it or nothing. Files that a
    reader has open stay until a vacuum. A stream names itself and its batch: a batch that is committed already changes
    nothing. The list of files goes through the driver, as that of any table that Spark scans.
    """

    attempts = 5

    def __init__(self, spark: SparkSession, path: str, file_rows: int = FILE_ROWS):
        self.spark, self.path, self.file_rows = spark, path.rstrip("/"), file_rows
        self.log = CommitLog(spark, f"{self.path}/log")

    # --- reading ---

    def files(self, part: Callable[[dict], bool] | None = None) -> list[dict]:
        live = self.log.snapshot().files.values()
        return [f for f in live if part is None or part(f)]

    def rows_of(self, files: list[dict]) -> DataFrame:
        """The rows of these files and their partition date."""
        names = [c.split()[0] for c in schemas.BARS.split(", ")]
        if not files:
            return self.spark.createDataFrame([], schemas.BARS + ", dt string")
        rows = self.spark.read.schema(schemas.BARS + ", version string, dt string").option("basePath", f"{self.path}/data")
        return rows.parquet(*(f"{self.path}/data/{f['path']}" for f in files)).select(*names, "dt")

    def read(self) -> DataFrame:
        return self.rows_of(self.files())

    def bars(self) -> DataFrame:
        return self.read().drop("dt")

    def scan(self, ivl: str | None = None, symbols: Sequence[str] | None = None, since: str | None = None, until: str | None = None) -> DataFrame:
        """Bars of the interval, symbols and times (both ends included), from those files only whose ranges allow for them."""
        lo, hi = (None if x is None else micros(x) for x in (since, until))
        wanted = [(None, None)] if symbols is None else [(s, s) for s in symbols]
        near = self.files(lambda f: (ivl is None or f["ivl"] == ivl) and any(overlaps(f, a, b, lo, hi) for a, b in wanted))
        rows = self.rows_of(near).drop("dt")
        if ivl is not None:
            rows = rows.where(F.col("ivl") == ivl)
        if symbols is not None:
            rows = rows.where(F.col("symbol").isin(list(symbols)))
        if since is not None:
            rows = rows.where(F.col("bar_ts") >= F.lit(since).cast("timestamp"))
        return rows if until is None else rows.where(F.col("bar_ts") <= F.lit(until).cast("timestamp"))

    def newest(self, limit: int, ivl: str) -> DataFrame:
        """A part of the interval's bars that holds the newest ``limit`` of them: files that end before enough later rows begin are not read."""
        own = self.files(lambda f: f["ivl"] == ivl)
        if any(f["since"] is None for f in own):
            return self.scan(ivl)
        rows, floor = 0, None
        for f in sorted(own, key=lambda f: -f["since"]):
            if rows >= limit:
                break
            rows, floor = rows + f["rows"], f["since"]
        # rows of the files gone through are at ``floor`` or later, and enough
        return self.rows_of([f for f in own if rows < limit or f["until"] >= floor]).drop("dt")

    # --- writing ---

    def conform(self, batch: DataFrame) -> DataFrame:
        """The batch with all columns of the store, and its partition date."""
        types = {c.split()[0]: c.split()[1] for c in schemas.BARS.split(", ")}
        own = [F.col(n).cast(t).alias(n) if n in batch.columns else F.lit(None).cast(t).alias(n) for n, t in types.items()]
        return batch.select(*own).withColumn("dt", partition_date())

    def stored_once(self, batch: DataFrame) -> DataFrame:
        """The batch as a table of the shared folder: what is computed twice from it comes out alike. ``__row`` is its order."""
        path = scratch_dir(self.spark)
        rows = self.conform(batch).withColumn("__row", F.monotonically_increasing_id())
        rows.write.parquet(path)
        return self.spark.read.schema(rows.schema).parquet(path)

    def _write(self, rows: DataFrame, file_rows: int | None = None) -> list[dict]:
        """Writes files in which symbols and times come together, and lists them with their ranges."""
        version, keys = uuid.uuid4().hex, ["ivl", "dt", "symbol", "bar_ts"]
        folder = f"{self.path}/data/version={version}"
        rows.repartitionByRange(*keys).sortWithinPartitions(*keys).write.option("maxRecordsPerFile", file_rows or self.file_rows).partitionBy("ivl", "dt").parquet(folder)
        back = self.spark.read.schema(schemas.BARS + ", dt string").parquet(folder)
        at = F.col("_metadata.file_path").alias("uri"), F.col("_metadata.file_size").alias("bytes"), "ivl", "dt"
        out = [r.asDict() for r in back.groupBy(*at).agg(F.count("*").alias("rows"), *ranges()).collect()]
        for f in out:
            f["path"] = f"version={version}/" + unquote(f.pop("uri")).rsplit(f"/version={version}/", 1)[1]
        return out

    def _changed(self, new: DataFrame, make: Callable[[DataFrame], DataFrame], replace: bool, stream: str, batch: int) -> bool:
        """Writes what ``make`` gives for the stored rows that the batch can meet; True unless the stream has committed the batch before."""
        span = {(r.ivl, r.dt): r for r in new.groupBy("ivl", "dt").agg(*ranges()).collect()}  # a row for each partition, of which each becomes a file at least
        if not span and not stream:
            return True
        meets = lambda f: (r := span.get((f["ivl"], f["dt"]))) is not None and overlaps(f, *(r[c] for c in RANGES))
        for attempt in range(self.attempts):
            base = self.log.snapshot()
            if stream and base.batches.get(stream, -1) >= batch:
                return False
            near = [f for f in base.files.values() if meets(f)]
            add = self._write(make(self.rows_of(near))) if span else []
            try:
                self.log.commit(base, add, [f["path"] for f in near] if replace else [], [f"{i}/{d}" for i, d in span], stream, batch)
            except Conflict:
                for version in {f["path"].split("/")[0] for f in add}:
                    removed(self.spark, f"{self.path}/data/{version}")
                if attempt == self.attempts - 1:
                    raise
                continue
            return True
        raise AssertionError

    def upsert(self, batch: DataFrame, stream: str = "", number: int = -1) -> bool:
        """The last write wins on (symbol, ivl, bar_ts); in a batch, the last created, then the later row."""
        new = self.stored_once(batch)

        def merged(old: DataFrame) -> DataFrame:
            both = old.withColumns({"__seq": F.lit(0), "__row": F.lit(0).cast("long")}).unionByName(new.withColumn("__seq", F.lit(1)))
            return last_write(both, "__seq", "created_at", "__row").drop("__seq", "__row")

        return self._changed(new, merged, True, stream, number)

    def insert_new(self, batch: DataFrame, stream: str = "", number: int = -1) -> bool:
        """Adds rows whose key is not stored; a correction of a stored bar is not applied. A key that the batch repeats is added as often."""
        new = self.stored_once(batch)
        return self._changed(new, lambda old: new_bars(new.drop("__row"), old), False, stream, number)

    # --- upkeep ---

    def profile(self) -> DataFrame:
        """A row for each live file: its partition, rows and bytes."""
        rows = [(f["ivl"], f["dt"], f["path"], f["rows"], f["bytes"]) for f in self.files()]
        return self.spark.createDataFrame(rows, "ivl string, dt string, path string, rows long, bytes long")

    def pack(self, target_bytes: int = 128 << 20) -> int:
        """Merges the small files of each partition, in the order of their keys, into files of about the target size, under one commit; how many went.

        A file of half the target or more stays, and so does one that is the only small one of its partition.
        """
        base, small = self.log.snapshot(), {}
        for f in base.files.values():
            if 2 * f["bytes"] < target_bytes:
                small.setdefault((f["ivl"], f["dt"]), []).append(f)
        gone = [f for files in small.values() if len(files) > 1 for f in files]
        if gone:
            rows = max(1, int(target_bytes * sum(f["rows"] for f in gone) / sum(f["bytes"] for f in gone)))
            self.log.commit(base, self._write(self.rows_of(gone), rows), [f["path"] for f in gone], sorted({f"{f['ivl']}/{f['dt']}" for f in gone}))
        return len(gone)

    def vacuum(self, keep_seconds: float = 7 * 86400) -> int:
        """Deletes versions of data that no snapshot of the last so many seconds needs, with those of lost writers; how many. Readers and writers of that age must be done."""
        before = int(1000 * (time.time() - keep_seconds))
        oldest = self.log.forget(before)
        commits, _ = self.log.numbers()
        needed = {p.split("/")[0] for p in oldest.files}
        for n in commits:
            if n > oldest.number:
                needed |= {f["path"].split("/")[0] for f in json.loads(read_text(self.spark, self.log.commit_file(n)))["add"]}
        old = [n for n, when in listed(self.spark, f"{self.path}/data") if n.startswith("version=") and n not in needed and when < before]
        for n in old:
            removed(self.spark, f"{self.path}/data/{n}")
        return len(old)


class VersionedTable:
    """A table that is replaced as a whole: the log names the folder of each version."""

    attempts = 5

    def __init__(self, spark: SparkSession, path: str, schema: str):
        self.spark, self.path, self.schema = spark, path.rstrip("/"), schema
        self.log = CommitLog(spark, f"{self.path}/log")

    def at(self, state: Snapshot) -> DataFrame:
        if not state.files:
            return self.spark.createDataFrame([], self.schema)
        (folder,) = state.files
        return self.spark.read.schema(self.schema).parquet(f"{self.path}/data/{folder}")

    def read(self) -> DataFrame:
        return self.at(self.log.snapshot())

    def update(self, make: Callable[[DataFrame], DataFrame], stream: str = "", batch: int = -1) -> tuple[DataFrame, DataFrame]:
        """Replaces the rows by what ``make`` gives for them, again if another writer was first; the rows before and after."""
        for attempt in range(self.attempts):
            base, folder = self.log.snapshot(), uuid.uuid4().hex
            before = self.at(base)
            if stream and base.batches.get(stream, -1) >= batch:
                return before, before
            make(before).select(*[c.split()[0] for c in self.schema.split(", ")]).write.parquet(f"{self.path}/data/{folder}")
            try:
                self.log.commit(base, [{"path": folder}], list(base.files), ["all"], stream, batch)
            except Conflict:
                removed(self.spark, f"{self.path}/data/{folder}")
                if attempt == self.attempts - 1:
                    raise
                continue
            return before, self.spark.read.schema(self.schema).parquet(f"{self.path}/data/{folder}")
        raise AssertionError

    def replace(self, rows: DataFrame) -> None:
        self.update(lambda _: rows)

    def vacuum(self, keep_seconds: float = 7 * 86400) -> int:
        before = int(1000 * (time.time() - keep_seconds))
        oldest = self.log.forget(before)
        commits, _ = self.log.numbers()
        needed = set(oldest.files).union(*({f["path"] for f in json.loads(read_text(self.spark, self.log.commit_file(n)))["add"]} for n in commits if n > oldest.number))
        old = [n for n, when in listed(self.spark, f"{self.path}/data") if n not in needed and when < before]
        for n in old:
            removed(self.spark, f"{self.path}/data/{n}")
        return len(old)


def upsert_coverage(table: VersionedTable, batch: DataFrame) -> None:
    """Writes a batch of coverage rows: one row for each symbol, interval and calendar day stays."""
    table.update(lambda stored: upserted(stored, batch))


def cleanup_coverage(table: VersionedTable, as_of: str) -> DataFrame:
    """Rewrites the table with the newest row of each key; the rows before and after, and how many went."""
    before, after = table.update(lambda stored: cleanup(stored, as_of))
    n = before.agg(F.count("*").alias("before")).crossJoin(after.agg(F.count("*").alias("after")))  # one row each
    return n.withColumn("removed", F.col("before") - F.col("after"))


def append(df: DataFrame, path: str) -> None:
    """Appends events or instrument rows; there is no key."""
    df.write.mode("append").parquet(path)


def export(df: DataFrame, path: str) -> None:
    """The same rows as Parquet and as CSV with a header. They are made once: the CSV is written from the Parquet."""
    df.write.mode("overwrite").parquet(f"{path}/parquet")
    df.sparkSession.read.schema(df.schema).parquet(f"{path}/parquet").write.mode("overwrite").option("header", True).csv(f"{path}/csv")


def ledger(wanted: DataFrame, batch: DataFrame, run_id: str, path: str) -> None:
    """One outcome row for each symbol that a run wanted or wrote: its rows, or the error that it had none."""
    written = batch.groupBy("symbol").agg(F.count("*").alias("rows"))
    rows = wanted.select("symbol").distinct().join(written, "symbol", "full_outer").withColumn("rows", F.coalesce("rows", F.lit(0).cast("long")))
    good = F.col("rows") > 0
    rows.select(F.lit(run_id).alias("run_id"), "symbol", "rows", good.alias("success"), F.when(~good, "no data").alias("error")).write.mode("append").json(path)


LEDGER = "run_id string, symbol string, rows long, success boolean, error string"
