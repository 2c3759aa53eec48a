"""MinHash near-dedup: Order MinHash over shingles of five words, verified by banded alignment.

1. Every text is reduced to its words (lower case, cut at white space); texts of
   equal words are one class from the start, and go on as their smallest doc_id.
2. Order MinHash: each shingle of five words is labelled with its occurrence; for
   each of ``Params.sketches`` hash functions the ``Params.picks`` smallest labelled
   shingles are kept in text order. Two texts meet where such a sequence is equal,
   which happens with about J ** picks for texts whose shingles have the Jaccard
   similarity J in the same order: at 0.8, all of 24 sketches of 4 fail with a
   chance of 3e-6.
   Texts of few shingles also meet by their smallest shingles, as many as any
   similar text must share one of (a prefix filter), so none of those is missed.
3. Texts that meet are first linked in stars: each with the smallest text of its
   bucket, then with another centre, chosen by a hash that differs by bucket. Then
   every pair of different classes that still shares a bucket is compared, in tiles of
   two blocks of a bucket: by size, by histograms of the shingles, whose distance never
   exceeds the number of shingles that only one text has, and if that leaves a chance,
   by alignment, the nearest first. Pairs that links of the tile have joined by then
   need no link, so a tile gives fewer links than it has texts.
4. A link holds if a banded alignment of the two sequences of labelled shingles
   (their longest common subsequence within the band that the threshold allows)
   matches M shingles with M / (n1 + n2 - M) >= 0.8. The multisets are compared
   first, as they bound M.
5. Classes are the connected components of the links, by repeated minimum over
   neighbours in Spark.

Defined results: null and empty texts are equal texts (no words), one class;
texts of fewer than five words are one shingle of all their words; a row without
doc_id belongs to its text's class, whose id is null only if every member's is;
texts that share a doc_id stay apart; rows repeat as often as they come in. Extra
columns are dropped by ``classes`` and kept by ``first_of_each``.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from .common import bounded_broadcast, heavy_keys, prepare, saved, spread_join, texts

WORDS, THRESHOLD = 5, 0.8


@dataclass(frozen=True)
class Params:
    sketches: int = 24
    picks: int = 4
    threshold: float = THRESHOLD
    rounds: int = 2  # of stars, before the rest is compared pair by pair
    short: int = 12  # shingles up to which a prefix filter joins the sketches
    block: int = 2048  # texts of a bucket that a task holds from each side
    block_bytes: int = 32 << 20  # of their shingles, on the average of the bucket's blocks


def words_of(text: str) -> list[str]:
    return text.lower().split()


def text_key(words: list[str]) -> str:
    return hashlib.blake2b("\n".join(words).encode("utf-8", "replace"), digest_size=16).hexdigest()


def word_hashes(words: list[str], known: dict[str, int]) -> np.ndarray:
    if len(known) > 300_000:
        known.clear()
    out = np.empty(len(words), np.uint64)
    for i, w in enumerate(words):
        h = known.get(w)
        if h is None:
            h = known[w] = int.from_bytes(hashlib.blake2b(w.encode("utf-8", "replace"), digest_size=8).digest(), "little")
        out[i] = h
    return out


M1, M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * M1
    x = (x ^ (x >> np.uint64(27))) * M2
    return x ^ (x >> np.uint64(31))


def labelled_shingles(words: list[str], known: dict[str, int]) -> np.ndarray:
    """The hash of each shingle with its occurrence number, in text order."""
    h = word_hashes(words, known)
    n = max(1, len(h) - WORDS + 1)
    s = np.zeros(n, np.uint64)
    for k in range(min(WORDS, len(h))):
        s = mix(s + h[k : k + n] + np.uint64(k + 1))
    order = np.argsort(s, kind="stable")
    t = s[order]
    new = np.concatenate([[True], t[1:] != t[:-1]])
    if not new.all():
        first = np.maximum.accumulate(np.where(new, np.arange(n), 0))
        occurrence = np.empty(n, np.uint64)
        occurrence[order] = (np.arange(n) - first).astype(np.uint64)
        s = np.where(occurrence > 0, mix(s + occurrence * M1), s)
    return s


def seeds(n: int) -> np.ndarray:
    return mix(np.arange(1, n + 1, dtype=np.uint64) * M2)


def sketch(s: np.ndarray, params: Params) -> np.ndarray:
    """A hash for each sketch: of its smallest labelled shingles, in text order."""
    k = min(params.picks, len(s))
    out = np.empty(params.sketches, np.uint64)
    step = max(1, (1 << 21) // max(1, len(s)))
    salt = seeds(params.sketches)
    for i in range(0, params.sketches, step):
        # multiplying by an odd number permutes the hashes; it costs little and is mixed enough, as s is
        h = s[None, :] * (salt[i : i + step, None] | np.uint64(1))
        h ^= h >> np.uint64(32)
        at = np.argpartition(h, k - 1, axis=1)[:, :k] if k < len(s) else np.broadcast_to(np.arange(len(s)), h.shape)
        at = np.sort(at, axis=1)
        total = np.zeros(len(h), np.uint64)
        for j in range(k):
            total = mix(total + s[at[:, j]] + np.uint64(j + 1))
        out[i : i + step] = mix(total + salt[i : i + step])
    return out


def prefix(s: np.ndarray, params: Params) -> np.ndarray:
    """The smallest shingles of a short text: one of them is shared by any text at the threshold."""
    if len(s) > params.short:
        return s[:0]
    return np.sort(s)[: len(s) - int(np.ceil(params.threshold * len(s) - 1e-9)) + 1]


BINS = 256


def histogram(s: np.ndarray) -> bytes:
    """Counts of the shingles in bins of their hash, capped: capping only lessens the distance of two."""
    return np.minimum(np.bincount((s >> np.uint64(40)).astype(np.int64) % BINS, minlength=BINS), 65535).astype("<u2").tobytes()


def aligned(a: np.ndarray, b: np.ndarray, threshold: float) -> float:
    """M / (n1 + n2 - M) of a banded alignment, 0 where it can't reach the threshold."""
    if len(a) > len(b):
        a, b = b, a
    total = len(a) + len(b)
    least = int(np.ceil(threshold * total / (1 + threshold) - 1e-9))
    if len(a) < least or len(np.intersect1d(a, b, assume_unique=True)) < least:
        return 0.0
    start = 0  # equal ends need no table
    m = len(a)
    head = np.flatnonzero(a != b[:m])
    start = int(head[0]) if len(head) else m
    tail = np.flatnonzero(a[start:][::-1] != b[len(b) - (m - start) :][::-1])
    end = int(tail[0]) if len(tail) else m - start
    x, y = a[start : m - end], b[start : len(b) - end]
    matched = start + end
    if len(x) and len(y):
        band = total - 2 * least + 1  # further from the diagonal, too many are left out
        where: dict[int, int] = {v: i for i, v in enumerate(x.tolist())}
        full = (1 << len(x)) - 1
        v = full
        for j, c in enumerate(y.tolist()):
            i = where.get(c, -1)
            if i < 0 or abs(i - j) > band:
                continue
            u = v & (1 << i)
            v = ((v + u) | (v - u)) & full
        matched += len(x) - v.bit_count()
    return matched / (total - matched) if matched >= least else 0.0


def sketched(docs: DataFrame, params: Params) -> DataFrame:
    """``doc_id``, ``key`` of the words, the sketches, the number of shingles, and ``row`` (a place in the batch), for every document."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known: dict[str, int] = {}
        for b in batches:
            keys, out, sizes = [], [], []
            for text in b["text"]:
                words = words_of(text)
                keys.append(text_key(words))
                s = labelled_shingles(words, known)
                out.append(np.concatenate([sketch(s, params), prefix(s, params)]).view(np.int64))
                sizes.append(len(s))
            yield pd.DataFrame({"doc_id": b["doc_id"], "key": keys, "sketches": out, "size": sizes, "row": np.arange(len(b), dtype=np.int32)})

    return texts(docs).mapInPandas(run, "doc_id long, key string, sketches array<long>, size int, row int")


def classed(rows: DataFrame, found: DataFrame | None) -> DataFrame:
    """The rows with the ``class`` of their id, which is the id itself as long as it has no link."""
    if found is None:
        return rows.withColumn("class", F.col("id"))
    return rows.join(found, "id", "left").withColumn("class", F.coalesce("class", "id"))


def stars(buckets: DataFrame, heavy: DataFrame, found: DataFrame | None, turn: int) -> DataFrame:
    """Links (a, b) from each text of a bucket to the bucket's centre of another class; a < b.

    ``buckets``: bucket, id; ``heavy``: those of many texts; ``found``: id, class of the texts that have one so far.
    The centre is one smallest value, so a bucket of any size is only counted, not gathered.
    """
    own = classed(buckets, found)
    rank = F.col("id") if turn == 0 else F.xxhash64("id", "bucket", F.lit(turn))
    centre = own.groupBy("bucket").agg(F.min(F.struct(rank.alias("r"), "id", "class")).alias("c"), F.min("class").alias("lo"), F.max("class").alias("hi")).where("lo < hi")
    centre = centre.select("bucket", F.col("c.id").alias("other"), F.col("c.class").alias("other_class"))
    pairs = spread_join(own, centre, "bucket", ["id"], heavy).where(F.col("class") != F.col("other_class"))
    return pairs.select(F.least("id", "other").alias("a"), F.greatest("id", "other").alias("b")).distinct()


def remaining(buckets: DataFrame, found: DataFrame | None, docs: DataFrame, params: Params) -> DataFrame:
    """Links (a, b) among the pairs of different classes that share a bucket: enough of them to join all that are near; a < b.

    A bucket's texts are dealt to blocks of bounded number and size, and each pair of blocks is a tile, so that a task holds two blocks. In a tile,
    pairs that its links have already joined are left out, so that it has fewer links than texts, and a pair that shares
    several buckets is compared in the first of them only. Buckets of two texts are left out: the first star is their only pair.
    """
    own = classed(buckets, found)
    several = own.groupBy("bucket").agg(
        F.count("*").alias("n"), F.min("class").alias("lo"), F.max("class").alias("hi"), F.sum("size").alias("shingles"), F.bit_xor(F.xxhash64("id")).alias("x"), F.bit_xor(F.xxhash64(F.lit(1), "id")).alias("y")
    ).where("lo < hi and n > 2")
    blocks = F.ceil(F.greatest(F.col("n") / params.block, F.col("shingles") * 8 / params.block_bytes)).cast("int")
    once = several.groupBy("n", "x", "y").agg(F.min("bucket").alias("bucket"), F.min(blocks).alias("blocks"))  # of buckets of the same texts, the first
    open_rows = saved(own.drop("size").join(once.select("bucket", "blocks"), "bucket"))

    def measure(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known: dict[str, int] = {}
        for b in batches:
            yield pd.DataFrame({"id": b["id"], "seq": [labelled_shingles(words_of(t), known).tobytes() for t in b["text"]]})

    # a text is in few buckets, as it has few sketches
    places = buckets.join(open_rows.select("id").distinct(), "id", "left_semi").groupBy("id").agg(F.collect_set("bucket").alias("all"))
    measured = saved(docs.join(places, "id").select("id", "text").mapInPandas(measure, "id long, seq binary").join(places, "id"))
    dealt = open_rows.withColumn("p", F.pmod(F.xxhash64("id", "bucket"), F.col("blocks")).cast("int"))
    tiles = dealt.withColumn("q", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).select("bucket", F.least("p", "q").alias("i"), F.greatest("p", "q").alias("j"), "p", "id", "class")
    tiles = tiles.join(measured, "id").select("bucket", "i", "j", "p", "id", "class", "seq", "all").repartition("bucket", "i", "j").sortWithinPartitions("bucket", "i", "j", "id")
    share = (1 - params.threshold) / (1 + params.threshold)  # of both sizes, that may be in one text only

    def compare(tile: pd.DataFrame) -> list[tuple[int, int]]:
        bucket, i, j, p = int(tile["bucket"].iloc[0]), int(tile["i"].iloc[0]), int(tile["j"].iloc[0]), tile["p"].to_numpy()
        ids, seqs, all_of = tile["id"].tolist(), [np.frombuffer(x, np.uint64) for x in tile["seq"]], [set(x) for x in tile["all"]]
        size = np.array([len(x) for x in seqs])
        bins = np.stack([np.frombuffer(histogram(x), "<u2") for x in seqs]).astype(np.int32)
        root = np.unique(tile["class"].to_numpy(), return_inverse=True)[1]  # of each text, the number of its class so far
        right = np.flatnonzero(p == j)
        links = []
        for k, left in enumerate(np.flatnonzero(p == i).tolist()):
            others = right[k + 1 :] if i == j else right
            others = others[(root[others] != root[left]) & (np.abs(size[others] - size[left]) <= share * (size[others] + size[left]) + 1e-6)]
            if not len(others):
                continue
            apart = np.abs(bins[others] - bins[left]).sum(axis=1) / (size[others] + size[left])
            near = apart <= share + 1e-9
            for o in others[near][np.argsort(apart[near], kind="stable")].tolist():
                if root[o] != root[left] and min(all_of[o] & all_of[left]) == bucket and aligned(seqs[left], seqs[o], params.threshold) >= params.threshold:
                    links.append((min(ids[left], ids[o]), max(ids[left], ids[o])))
                    root[root == root[o]] = root[left]
        return links

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        def tiles_of(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            parts: list[pd.DataFrame] = []
            last = None
            for b in batches:
                if not len(b):
                    continue
                at = b[["bucket", "i", "j"]].to_numpy()
                cuts = [0, *(np.flatnonzero((at[1:] != at[:-1]).any(axis=1)) + 1).tolist(), len(b)]
                for lo, hi in zip(cuts[:-1], cuts[1:], strict=True):
                    key = tuple(at[lo])
                    if key != last and parts:
                        yield pd.concat(parts) if len(parts) > 1 else parts[0]
                        parts = []
                    last = key
                    parts.append(b.iloc[lo:hi])
            if parts:
                yield pd.concat(parts) if len(parts) > 1 else parts[0]

        for tile in tiles_of(batches):
            links = compare(tile)
            if links:
                yield pd.DataFrame(links, columns=["a", "b"])

    return tiles.mapInPandas(run, "a long, b long").distinct()


#: Texts up to which those that take part in a link are picked by a broadcast; beyond, by a shuffle.
BROADCAST_ROWS = 300_000


def verified(links: DataFrame, docs: DataFrame, params: Params) -> DataFrame:
    """The links whose texts align. ``docs``: id, text of the texts that take part in any. A text of many links is sent to several tasks."""
    pairs = spread_join(links, docs.select(F.col("id").alias("a"), F.col("text").alias("ta")), "a", ["b"], heavy_keys(links, "a"))
    pairs = spread_join(pairs, docs.select(F.col("id").alias("b"), F.col("text").alias("tb")), "b", ["a"], heavy_keys(links, "b"))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known: dict[str, int] = {}
        last: dict[int, np.ndarray] = {}

        def seq(i: int, text: str) -> np.ndarray:
            if i not in last:
                if len(last) > 64:
                    last.clear()
                last[i] = labelled_shingles(words_of(text), known)
            return last[i]

        for rows in batches:
            keep = [aligned(seq(a, ta), seq(b, tb), params.threshold) >= params.threshold for a, ta, b, tb in zip(rows["a"], rows["ta"], rows["b"], rows["tb"], strict=True)]
            yield rows.loc[keep, ["a", "b"]]

    return pairs.select("a", "ta", "b", "tb").mapInPandas(run, "a long, b long")


def components(links: DataFrame) -> DataFrame:
    """``id``, ``class``: the smallest id of each connected component, for the ids that have a link."""
    edges = saved(links.select(F.col("a").alias("id"), F.col("b").alias("to")).union(links.select(F.col("b"), F.col("a"))))
    hubs = saved(heavy_keys(edges, "to"))
    label = edges.groupBy("id").agg(F.least("id", F.min("to")).alias("class"))
    while True:
        near = spread_join(edges, label.select(F.col("id").alias("to"), "class"), "to", ["id"], hubs).groupBy("id").agg(F.min("class").alias("near"))
        step = label.join(near, "id").select("id", F.least("class", "near").alias("class"), F.col("class").alias("old"))
        root = label.select(F.col("id").alias("class"), F.col("class").alias("root"))
        step = saved(step.join(root, "class", "left").select("id", F.least("class", F.coalesce("root", "class")).alias("class"), "old"))
        label = step.select("id", "class")
        if step.where("class < old").isEmpty():
            return label


@F.pandas_udf(StringType())
def keyed(text: pd.Series) -> pd.Series:
    return text.map(lambda t: text_key(words_of(t)))


def texts_of(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """``id`` and one text for each row of ``wanted`` (id, key, smallest)."""
    few, _ = bounded_broadcast(wanted, BROADCAST_ROWS)
    own = texts(docs)
    named = own.join(few.where("smallest is not null").select(F.col("smallest").alias("doc_id")).distinct(), "doc_id", "left_semi")
    found = named.unionByName(own.where("doc_id is null")).withColumn("key", keyed("text"))
    return found.join(few.select("id", "key"), "key").dropDuplicates(["id"]).select("id", "text")


def classes(docs: DataFrame, params: Params = Params()) -> DataFrame:
    """``doc_id``, ``key`` of its words, ``class_id`` (the class's smallest doc_id), and whether the row is that document's."""
    prepare(docs.sparkSession)
    every = saved(sketched(docs, params))
    # a text's id is a hash of its key, so texts that share a doc_id, or have none, stay apart
    same = every.groupBy("key").agg(F.min("doc_id").alias("smallest"), F.first("sketches").alias("sketches"), F.first("size").alias("size"))
    same = saved(same.select("key", "smallest", F.xxhash64("key").alias("id"), "sketches", "size"))
    # what follows the sketches is the prefix, in which places don't count
    rows = same.select("id", "size", F.posexplode("sketches").alias("i", "h")).select("id", "size", F.xxhash64(F.least("i", F.lit(params.sketches)), "h").alias("bucket"))
    shared = rows.groupBy("bucket").count().where("count > 1").select("bucket")
    buckets = saved(rows.join(shared, "bucket"))
    taking_part = saved(texts_of(docs, saved(same.drop("sketches").join(buckets.select("id").distinct(), "id", "left_semi"))))
    heavy = saved(heavy_keys(buckets, "bucket"))
    links = tried = found = None
    for turn in range(params.rounds):
        new = stars(buckets, heavy, found, turn)
        if tried is not None:
            new = new.join(tried, ["a", "b"], "left_anti")
        new = saved(new)
        if new.isEmpty():
            break
        tried = new if tried is None else tried.unionByName(new)
        good = saved(verified(new, taking_part, params))
        links = good if links is None else links.unionByName(good)
        found = components(links)
    if tried is not None:
        more = saved(remaining(buckets, found, taking_part, params))
        if not more.isEmpty():
            links = links.unionByName(more)
            found = components(links)
    final = same.select("key", "smallest", "id", F.col("id").alias("class"))
    if found is not None:
        final = final.drop("class").join(found, "id", "left").withColumn("class", F.coalesce("class", "id"))
    named = final.groupBy("class").agg(F.min("smallest").alias("class_id"))
    of_key = saved(final.join(named, "class").select("key", "class_id", F.col("smallest").eqNullSafe(F.col("class_id")).alias("own")))
    return spread_join(every.select("doc_id", "key", "row"), of_key, "key", ["doc_id", "row"]).select("doc_id", "key", "class_id", (F.col("own") & F.col("doc_id").eqNullSafe(F.col("class_id"))).alias("first"))


def first_of_each(docs: DataFrame, params: Params = Params()) -> DataFrame:
    """One document of each class, that of the smallest doc_id, with the columns it came with.

    Rows that repeat both doc_id and words are one document and stay together; so do rows of a class without any doc_id.
    """
    gone = saved(classes(docs, params).where(~F.col("first")).select(F.col("doc_id").alias("__id"), F.col("key").alias("__key")).distinct())
    few, _ = bounded_broadcast(gone, BROADCAST_ROWS)
    marked = docs.withColumn("__k", keyed(F.coalesce("text", F.lit(""))))
    return marked.join(few, marked["doc_id"].eqNullSafe(F.col("__id")) & (F.col("__k") == F.col("__key")), "left_anti").select(*docs.columns)
