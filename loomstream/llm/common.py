"""Helpers that several operators share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rows of an Arrow batch handed to Python; bounds a worker's memory when texts are long.
BATCH_ROWS = 1024


def prepare(spark: SparkSession, rows: int = BATCH_ROWS) -> SparkSession:
    """Sets the size of Arrow batches, in rows and in bytes."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(32 << 20))
    return spark


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def scratch_dir(spark: SparkSession) -> str:
    """A new folder in the cluster's shared checkpoint folder.

    The folder is ``spark.checkpoint.dir`` of the session. Where that is unset, a
    temporary folder takes its place in local mode, as in tests; a cluster has no
    folder to fall back on, so there it is an error.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        base = tempfile.mkdtemp(prefix="spark-", dir="/tmp")
        spark.conf.set("spark.checkpoint.dir", base)
    return f"{base.rstrip('/')}/{uuid.uuid4().hex}"


def saved(df: DataFrame) -> DataFrame:
    """Writes the rows to the shared folder and reads them again: cuts lineage, survives lost executors."""
    path = scratch_dir(df.sparkSession)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def texts(docs: DataFrame, *columns: str) -> DataFrame:
    """``doc_id``, ``text`` (null: empty) and the named columns, and nothing else."""
    return docs.select(F.col("doc_id"), F.coalesce(F.col("text"), F.lit("")).alias("text"), *columns)


def crc_mod(column: str, n: int) -> Column:
    """crc32 of the column as text, modulo n; null where the column is null."""
    return F.crc32(F.col(column).cast("string")) % F.lit(n)


def bounded_broadcast(df: DataFrame, rows: int) -> tuple[DataFrame, int]:
    """The frame with a broadcast hint if it has no more than ``rows`` rows, else as it is; and its count, up to rows + 1."""
    n = df.limit(rows + 1).count()
    return (F.broadcast(df) if n <= rows else df), n


#: Rows of a key up to which a task takes them all, and the most tasks that heavy keys are named for.
FEW_ROWS, MOST_HEAVY = 512, 100_000


def heavy_keys(rows: DataFrame, key: str) -> DataFrame:
    """``key`` and ``parts``: the keys with so many rows that they are dealt to several tasks.

    A key is heavy from a 100,000th of all rows on, so there are fewer than 100,000 of them, however large the table is.
    """
    most = max(FEW_ROWS, rows.count() // MOST_HEAVY)
    n = rows.where(F.col(key).isNotNull()).groupBy(key).agg(F.count("*").alias("n")).where(F.col("n") > most)
    return n.select(key, F.ceil(F.col("n") / most).cast("int").alias("parts"))


def spread_join(rows: DataFrame, one: DataFrame, key: str, by: list[str], heavy: DataFrame | None = None) -> DataFrame:
    """Inner join with ``one``, which has one row for each key, in which the rows of a heavy key are dealt by the columns ``by``."""
    heavy = F.broadcast(heavy_keys(rows, key) if heavy is None else heavy)
    parts = F.coalesce("parts", F.lit(1))
    dealt = rows.join(heavy, key, "left").withColumn("__part", F.pmod(F.xxhash64(*by), parts).cast("int")).drop("parts")
    copied = one.join(heavy, key, "left").withColumn("__part", F.explode(F.sequence(F.lit(0), parts - 1))).drop("parts")
    return dealt.join(copied, [key, "__part"]).drop("__part")
