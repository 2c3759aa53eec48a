"""Benchmark decontamination: size-partitioned MinHash containment search.

Which short test items stand inside which documents? Items and documents are sets
of shingles of five words. Items are partitioned by the size of their set. From
each item of a partition the search keeps its ``m`` smallest shingle hashes (a
bottom-m MinHash sketch). A document that holds the share ``t`` of an item lacks
at most ``q - ceil(t * q)`` of its ``q`` shingles, so with
``m = u - ceil(t * u) + 1`` for the partition's largest size ``u`` at least one
sketched hash is in it: no item is missed. Documents are probed with the hashes up
to the largest in any sketch, and only where they have enough shingles for the
partition. Candidates are verified by the exact containment of the shingles
themselves.

All of it is DataFrame functions. Words are runs of letters and digits in lower
case. Defined results: null or empty texts and texts of fewer than five words have
no shingles and match nothing; documents and items that repeat are all reported;
a null id is reported as null. Extra columns are dropped by ``contaminated`` and
kept by ``decontaminated``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import bounded_broadcast, saved, texts

WORDS, THRESHOLD = 5, 0.8

#: Rows up to which sketches, candidates or items go to every executor; beyond, they are joined by shuffles.
BROADCAST_ROWS = 500_000


def words_of(text: Column) -> Column:
    return F.array_remove(F.split(F.lower(text), r"[^\p{L}\p{N}]+"), "")


def windows(words: str, make) -> Column:
    """``make`` of five neighbours for each place in the array column ``words``; empty where there are fewer."""
    places = F.sequence(F.lit(0), F.greatest(F.size(words) - WORDS, F.lit(0)))
    made = F.transform(places, lambda i: make([F.get(F.col(words), i + k) for k in range(WORDS)]))
    return F.when(F.size(words) >= WORDS, made).otherwise(F.slice(made, 1, 0))


def hashes(words: str) -> Column:
    return F.array_distinct(windows(words, lambda w: F.xxhash64(*w)))


def shingles(words: str) -> Column:
    return F.array_distinct(windows(words, lambda w: F.concat_ws(" ", *w)))


def with_words(df: DataFrame) -> DataFrame:
    return df.withColumn("words", words_of(F.col("text")))


def at_least(size: Column, threshold: float) -> Column:
    """ceil(threshold * size), safe from the error of the product."""
    return F.ceil(size * threshold - 1e-9).cast("int")


def item_table(benchmark: DataFrame) -> DataFrame:
    """``item_id``, a number of the item's own, its shingles and their number, for items that have any."""
    items = benchmark.select("item_id", F.coalesce("text", F.lit("")).alias("text"))
    items = with_words(items).select("item_id", shingles("words").alias("shingles"), hashes("words").alias("hashes"))
    # stored before it is filtered: a filter that moves below a lambda would cut the text anew for each word
    items = saved(items.select("*", F.size("shingles").alias("q"), F.xxhash64("item_id", "shingles").alias("item_key")))
    return items.where("q > 0")


def sketches(items: DataFrame, threshold: float) -> DataFrame:
    """``h``, ``item_key`` and ``needed`` shingles of a document: the sketch of each item, sized by its partition."""
    part = F.floor(F.log2("q")).alias("part")
    sizes = items.groupBy(part).agg(F.max("q").alias("u"), F.min("q").alias("l"))
    m = (F.col("u") - at_least(F.col("u"), threshold) + 1).alias("m")
    bounds = sizes.select("part", m, at_least(F.col("l"), threshold).alias("needed"))  # a row for each doubling of the size
    sized = items.select("item_key", "hashes", part).join(F.broadcast(bounds), "part")
    return sized.select("item_key", "needed", F.explode(F.slice(F.array_sort("hashes"), F.lit(1), F.col("m"))).alias("h")).distinct()


def text_keys() -> list[Column]:
    return [F.xxhash64("text").alias("k1"), F.xxhash64("text", F.lit(1)).alias("k2")]


def probes(docs: DataFrame) -> DataFrame:
    """``k1``, ``k2``, the text's number of shingles and the hash ``h`` of each of them, as rows made by generated code."""
    shifted = F.arrays_zip(F.col("words").alias("w0"), *[F.slice("words", F.lit(1 + k), F.greatest(F.size("words"), F.lit(1))).alias(f"w{k}") for k in range(1, WORDS)])
    rows = with_words(docs).select(*text_keys(), (F.size("words") - (WORDS - 1)).alias("n"), F.inline_outer(shifted))
    names = [f"w{k}" for k in range(WORDS)]
    return rows.where(F.col(names[-1]).isNotNull()).select("k1", "k2", "n", F.xxhash64(*names).alias("h"))


def candidates(docs: DataFrame, items: DataFrame, threshold: float) -> DataFrame:
    """``k1``, ``k2`` (keys of a text) and ``items``: the items that may stand in it."""
    sketch = saved(sketches(items, threshold))
    small, _ = bounded_broadcast(sketch, BROADCAST_ROWS)
    top = sketch.agg(F.max("h")).head()[0]  # the hashes above it are in no sketch
    hit = probes(docs).where(F.col("h") <= F.lit(top)).join(small, "h").where("n >= needed")
    return hit.groupBy("k1", "k2").agg(F.collect_set("item_key").alias("items"))


def contaminated(docs: DataFrame, benchmark: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """``doc_id``, ``item_id``, ``n_item`` and ``n_shared`` shingles and ``containment`` of each item found in a document."""
    own = texts(docs)
    items = item_table(benchmark)
    found, _ = bounded_broadcast(saved(candidates(own, items, threshold)), BROADCAST_ROWS)
    details, _ = bounded_broadcast(items.select("item_id", "item_key", "q", F.col("shingles").alias("wanted")), BROADCAST_ROWS)
    hit = with_words(own.select("*", *text_keys()).join(found, ["k1", "k2"])).select("doc_id", "items", shingles("words").alias("shingles"))
    pairs = hit.select("doc_id", "shingles", F.explode("items").alias("item_key")).join(details, "item_key")
    shared = pairs.select("doc_id", "item_id", F.col("q").alias("n_item"), F.size(F.array_intersect("wanted", "shingles")).alias("n_shared"))
    return shared.where(F.col("n_shared") >= at_least(F.col("n_item"), threshold)).select("*", (F.col("n_shared") / F.col("n_item")).alias("containment"))


def decontaminated(docs: DataFrame, benchmark: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The documents in which no item of the benchmark stands, with the columns they came with."""
    marked = docs.withColumn("text", F.coalesce("text", F.lit("")))
    hit = contaminated(marked.select(F.xxhash64("text").alias("doc_id"), "text"), benchmark, threshold).select(F.col("doc_id").alias("__bad")).distinct()
    bad, _ = bounded_broadcast(saved(hit), BROADCAST_ROWS)
    return marked.join(bad, F.xxhash64(marked["text"]) == F.col("__bad"), "left_anti").select(*docs.columns)


ORACLE_SQL = f"""
WITH s AS (
  SELECT id, kind, list_distinct([array_to_string(ws[i:i + {WORDS - 1}], ' ') for i in range(1, len(ws) - {WORDS - 2})]) AS sh
  FROM (
    SELECT id, kind, [x for x in regexp_split_to_array(lower(coalesce(text, '')), '[^\\p{{L}}\\p{{N}}]+') if x <> ''] AS ws
    FROM (SELECT doc_id AS id, 0 AS kind, text FROM documents UNION ALL SELECT item_id, 1, text FROM benchmark)
  )
),
d AS (SELECT id AS doc_id, unnest(sh) AS x FROM s WHERE kind = 0),
b AS (SELECT id AS item_id, CAST(len(sh) AS INTEGER) AS n_item, unnest(sh) AS x FROM s WHERE kind = 1)
SELECT doc_id, item_id, n_item, CAST(count(*) AS INTEGER) AS n_shared, count(*) / CAST(n_item AS DOUBLE) AS containment
FROM d JOIN b USING (x) GROUP BY doc_id, item_id, n_item HAVING count(*) >= ceil({THRESHOLD} * n_item - 1e-9)
"""
