"""Coverage that is kept along with the bar store: partial aggregates of each partition, made again only where bars were written."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .log import CommitLog, Conflict, removed
from .store import BarStore

PARTIAL = "symbol string, ivl string, data_start timestamp, data_end timestamp, total_records long"


class CoverageRollup:
    """Start, end and number of each symbol's bars, as partial aggregates under a folder, one file group for each refresh.

    A refresh reads the partitions of the store that were touched after the commit that it last saw, and replaces their
    partial aggregates; a maximum that was removed is thus found again within its partition. The merge adds partials up.
    """

    attempts = 5

    def __init__(self, spark: SparkSession, path: str, store: BarStore):
        self.spark, self.path, self.store = spark, path.rstrip("/"), store
        self.log = CommitLog(spark, f"{self.path}/log")

    def refresh(self) -> int:
        """Brings the partials up to the store's last commit; how many partitions were read."""
        for attempt in range(self.attempts):
            source, own = self.store.log.snapshot(), self.log.snapshot()
            seen = own.batches.get("store", 0)
            parts = {p for p, n in source.touched.items() if n > seen}
            if not parts:
                return 0
            name = lambda f: f"{f['ivl']}/{f['dt']}"
            files = [f for f in source.files.values() if name(f) in parts]
            folder = uuid.uuid4().hex
            rows = self.store.rows_of(files).groupBy("symbol", "ivl", "dt").agg(F.min("bar_ts").alias("data_start"), F.max("bar_ts").alias("data_end"), F.count("*").alias("total_records"))
            rows.withColumn("part", F.concat_ws("/", F.coalesce("ivl", F.lit("None")), F.coalesce("dt", F.lit("None")))).drop("dt").write.parquet(f"{self.path}/data/{folder}")
            gone = [path for path, f in own.files.items() if f["part"] in parts]
            add = [{"path": f"{folder}|{p}", "part": p} for p in sorted({name(f) for f in files})]
            try:
                self.log.commit(own, add, gone, sorted(parts), "store", source.number)
            except Conflict:
                removed(self.spark, f"{self.path}/data/{folder}")
                if attempt == self.attempts - 1:
                    raise
                continue
            return len(parts)
        raise AssertionError

    def partials(self) -> DataFrame:
        live = self.log.snapshot().files
        if not live:
            return self.spark.createDataFrame([], PARTIAL)
        pairs = self.spark.createDataFrame([tuple(p.split("|", 1)) for p in live], "folder string, part string")
        rows = self.spark.read.schema(PARTIAL + ", part string").parquet(*sorted({f"{self.path}/data/{p.split('|', 1)[0]}" for p in live}))
        own = rows.withColumn("folder", F.element_at(F.split(F.col("_metadata.file_path"), "/"), -2))
        return own.join(pairs, ["folder", "part"], "left_semi").drop("folder", "part")

    def coverage(self) -> DataFrame:
        """As ``coverage.coverage`` of all stored bars."""
        return self.partials().groupBy("symbol", "ivl").agg(F.min("data_start").alias("data_start"), F.max("data_end").alias("data_end"), F.sum("total_records").alias("total_records"))
