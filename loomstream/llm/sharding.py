"""Sharding: size-tiered compaction under an atomically committed, versioned manifest.

A store is a folder of immutable Parquet files and of manifests ``v00000001.json``,
``v00000002.json`` and so on. Each manifest names the live files with their rows
and bytes. An arrival is appended as small files and a new manifest. Compaction
puts files into tiers by size (each tier ``Params.fanout`` times the one before);
all files of a tier that has at least ``fanout`` of them, and is below the target
size, are merged into files of about the target size, without a shuffle, and one
manifest swaps them. A manifest is written under another name and renamed without
overwriting, so a reader sees all of a version or none, and of two writers one
fails with ``CommitConflict`` and starts over from the newer version, and deletes
what it has merged in vain. Manifests stay for ``keep_seconds`` after their successor
was committed, so that open readers finish; later ``vacuum`` deletes them, and the
data files of that age that no manifest names: merged ones, and those of writers
that were lost. A single write must take less time than that.

Defined results: an empty arrival commits a version without new files; an empty
store reads as no rows of its schema; nulls, repeated rows and any further
columns are stored as they come.
"""

from __future__ import annotations

import json
import math
import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from .common import scratch_dir


class CommitConflict(RuntimeError):
    """Another writer has committed this version."""


@dataclass(frozen=True)
class Params:
    target: int = 128 << 20  # bytes of a merged file
    smallest: int = 1 << 20  # bytes up to which a file is in tier 0
    fanout: int = 4
    keep_seconds: int = 3600


@dataclass(frozen=True)
class Shard:
    file: str  # below the store's folder
    rows: int
    bytes: int


def tier_of(size: int, params: Params) -> int:
    return max(0, math.ceil(math.log(max(size, 1) / params.smallest, params.fanout) - 1e-9))


def plan(shards: list[Shard], params: Params) -> list[list[Shard]]:
    """The runs to merge: the files of each tier that has enough of them, below the target size."""
    tiers: dict[int, list[Shard]] = {}
    for s in shards:
        if s.bytes < params.target // 2:
            tiers.setdefault(tier_of(s.bytes, params), []).append(s)
    return [run for _, run in sorted(tiers.items()) if len(run) >= params.fanout]


class ShardStore:
    def __init__(self, spark: SparkSession, root: str, params: Params = Params()):
        self.spark, self.root, self.params = spark, root.rstrip("/"), params
        self.hadoop = spark._jvm.org.apache.hadoop.fs
        self.fs = self.hadoop.Path(self.root).getFileSystem(spark._jsc.hadoopConfiguration())

    def versions(self) -> list[int]:
        folder = self.hadoop.Path(f"{self.root}/manifest")
        if not self.fs.exists(folder):
            return []
        names = [s.getPath().getName() for s in self.fs.listStatus(folder)]
        return sorted(int(n[1:-5]) for n in names if n.startswith("v") and n.endswith(".json"))

    def manifest(self, version: int | None = None) -> tuple[int, list[Shard], StructType | None]:
        """Number, live files and schema of a version, the newest by default; version 0 is the empty store."""
        known = self.versions()
        version = (known[-1] if known else 0) if version is None else version
        if not version:
            return 0, [], None
        text = self.spark.read.text(f"{self.root}/manifest/v{version:08d}.json", wholetext=True).head()[0]
        spec = json.loads(text)
        return version, [Shard(**s) for s in spec["shards"]], StructType.fromJson(spec["schema"])

    def commit(self, version: int, shards: list[Shard], schema: StructType) -> int:
        """Makes these the files of ``version``; raises CommitConflict if there is such a version."""
        text = json.dumps({"version": version, "schema": schema.jsonValue(), "shards": [vars(s) for s in shards]})
        draft = self.hadoop.Path(f"{self.root}/manifest/.draft-{uuid.uuid4().hex}")
        final = self.hadoop.Path(f"{self.root}/manifest/v{version:08d}.json")
        out = self.fs.create(draft, False)
        out.write(bytearray(text.encode()))
        out.close()
        kinds = getattr(self.hadoop, "Options$Rename")
        options = self.spark._sc._gateway.new_array(kinds, 1)
        options[0] = kinds.NONE  # never over a file that is there
        context = self.hadoop.FileContext.getFileContext(final.toUri(), self.spark._jsc.hadoopConfiguration())
        try:
            context.rename(draft, final, options)
        except Exception as error:
            self.fs.delete(draft, False)
            if self.fs.exists(final):
                raise CommitConflict(f"version {version} exists") from error
            raise
        return version

    def write(self, df: DataFrame) -> list[Shard]:
        """Writes the rows as new files of a folder of their own; they count only once a manifest names them."""
        folder = f"data/{uuid.uuid4().hex}"
        try:
            df.write.option("compression", "zstd").parquet(f"{self.root}/{folder}")
        except Exception:
            self.fs.delete(self.hadoop.Path(f"{self.root}/{folder}"), True)
            raise
        files = self.spark.read.schema(df.schema).parquet(f"{self.root}/{folder}").groupBy(F.col("_metadata.file_name").alias("file"), F.col("_metadata.file_size").alias("bytes")).count()
        return sorted((Shard(f"{folder}/{r['file']}", r["count"], r["bytes"]) for r in files.collect()), key=lambda s: s.file)

    def append(self, df: DataFrame, attempts: int = 5) -> int:
        """Appends an arrival as small files; a version that another writer took first is tried again after it."""
        new = self.write(df)
        for attempt in range(attempts):
            version, shards, schema = self.manifest()
            try:
                return self.commit(version + 1, [*shards, *new], schema or df.schema)
            except CommitConflict:
                if attempt == attempts - 1:
                    raise
        raise AssertionError

    def compact(self, attempts: int = 5) -> int:
        """Merges runs of like-sized files until no tier has enough of them; returns the version."""
        for _ in range(attempts * 8):
            version, shards, schema = self.manifest()
            runs = plan(shards, self.params)
            if not runs:
                return version
            merged: list[Shard] = []
            for run in runs:
                paths = [f"{self.root}/{s.file}" for s in run]
                files = max(1, round(sum(s.bytes for s in run) / self.params.target))
                merged += self.write(self.spark.read.schema(schema).parquet(*paths).coalesce(files))
            gone = {s.file for run in runs for s in run}
            try:
                self.commit(version + 1, [s for s in shards if s.file not in gone] + merged, schema)
            except CommitConflict:
                for folder in {s.file.rsplit("/", 1)[0] for s in merged}:
                    self.fs.delete(self.hadoop.Path(f"{self.root}/{folder}"), True)
                continue
            self.vacuum()
            if len(merged) >= len(gone):
                return version + 1
        raise CommitConflict("other writers were faster each time")

    def vacuum(self) -> None:
        """Deletes manifests replaced longer than ``keep_seconds`` ago, and data files of that age that no other manifest names.

        The newest manifest's time stands for now, so only the file system's clock counts.
        """
        known = self.versions()
        if not known:
            return
        written = [self.fs.getFileStatus(self.hadoop.Path(f"{self.root}/manifest/v{v:08d}.json")).getModificationTime() for v in known]
        before = written[-1] - 1000 * self.params.keep_seconds
        old = {v for v, replaced in zip(known, written[1:]) if replaced <= before}
        live = {s.file for v in known if v not in old for s in self.manifest(v)[1]}
        for v in sorted(old):
            self.fs.delete(self.hadoop.Path(f"{self.root}/manifest/v{v:08d}.json"), False)
        data = self.hadoop.Path(f"{self.root}/data")
        for folder in self.fs.listStatus(data) if self.fs.exists(data) else []:
            name, files = folder.getPath().getName(), list(self.fs.listStatus(folder.getPath()))
            dead = [f for f in files if f"data/{name}/{f.getPath().getName()}" not in live and f.getModificationTime() <= before]
            if len(dead) < len(files):
                for f in dead:
                    self.fs.delete(f.getPath(), True)
            elif folder.getModificationTime() <= before:
                self.fs.delete(folder.getPath(), True)

    def read(self, version: int | None = None) -> DataFrame:
        """The rows of a version, with ``_shard`` (the file's number in the manifest), ``_tier`` and ``_version``."""
        version, shards, schema = self.manifest(version)
        if not shards:
            empty = self.spark.createDataFrame([], schema or StructType())
            return empty.select("*", F.lit(0).alias("_shard"), F.lit(0).alias("_tier"), F.lit(version).alias("_version"))
        # a row for each file: files are at least of the smallest tier or few, so this is a small part of what they hold
        numbers = self.spark.createDataFrame([(s.file.rsplit("/", 1)[1], i, tier_of(s.bytes, self.params)) for i, s in enumerate(shards)], "__file string, _shard int, _tier int")
        rows = self.spark.read.schema(schema).parquet(*[f"{self.root}/{s.file}" for s in shards]).select("*", F.col("_metadata.file_name").alias("__file"))
        return rows.join(F.broadcast(numbers) if len(shards) <= 100_000 else numbers, "__file").drop("__file").withColumn("_version", F.lit(version))


def sharded(docs: DataFrame, arrivals: int = 2, params: Params = Params()) -> DataFrame:
    """Appends the documents in so many arrivals, compacts after each, and reads the newest version."""
    spark = docs.sparkSession
    store = ShardStore(spark, scratch_dir(spark), params)
    for i in range(arrivals):
        store.append(docs.where(F.pmod(F.xxhash64("doc_id"), F.lit(arrivals)) == i))
        store.compact()
    return store.read()


def placements(docs: DataFrame, params: Params = Params()) -> DataFrame:
    """``doc_id``, length and digest of the text of every document as read from its shard, and that shard's place."""
    own = docs.select("doc_id", "text")
    text = F.coalesce("text", F.lit(""))
    return sharded(own, params=params).select("doc_id", F.length(text).cast("long").alias("n_chars"), F.sha2(text, 256).alias("text_sha256"), F.col("_shard").alias("shard"), F.col("_tier").alias("tier"), F.col("_version").alias("version"))
