"""Phrase collocations: exact counts of phrases in HAT-tries, spilled as sorted runs and merged per prefix partition.

Phrases are counted level by level: words, then phrases of two words, and so on. A task holds a HAT-trie for each
language: one hash container of whole phrases, which bursts when it has grown: each first word with many phrases gets a
container of their rests. When a trie is full, whole subtrees leave it, the largest first, each as one run in the order of
its phrases. Spark deals the runs by prefix (language and first two words, so that one frequent first word is not one
task) and adds equal phrases up.

A phrase can be frequent only where all its parts are. So from the second level on, a task leaves out phrases with a part
of one word less that was not frequent. It looks parts up in a bitmap of their hashes that has a fixed size: a part that
is not there is surely not frequent, and one that is there by chance costs a count but changes none. No other part of the
counts reaches the driver, and nothing is cut off.

A candidate is a phrase of 2 to ``max_words`` words with ``least`` occurrences or more. Each cut into two parts scores
``floor(10^6 a^2 / (l r))`` in decimals of 38 digits (counts up to 10^13 are safe); the lowest counts. A candidate goes
where a longer one holds it and has at least half its occurrences.

Defined results: a null or empty text has no words; a null language is ``und``; rows of one document that stands twice
count twice; a language without candidates has no rows; equal scores are ranked by count, then by phrase in byte order.
Only ``text`` and ``lang`` are read, so a null ``doc_id`` or further columns do not matter. The ranking of a language is
cut twice, first in ``PARTS`` parts by the phrase's hash, so no task gets more than ``PARTS * top`` rows of it.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import prepare, saved

# What ends a piece, and what stands between words.
BREAKS, SPACES = b".,;:!?\n\x0b\x0c\r", b" \t"
#: A byte that UTF-8 does not have stands for a break.
BREAK = b"\xff"
TABLE = bytes(BREAK[0] if b in BREAKS else 32 if b in SPACES else b + 32 if 65 <= b <= 90 else b for b in range(256))
UNKNOWN_LANG = "und"


@dataclass(frozen=True)
class Params:
    max_words: int = 3
    least: int = 10
    top: int = 2000
    held_pct: int = 50
    trie_entries: int = 2_000_000  # phrases that a task's tries hold before one spills
    burst: int = 200_000  # entries of a trie's first container that bursts
    task_words: int = 400_000  # distinct words that a task numbers before all leaves the trie
    filter_bits: int = 1 << 26  # of the bitmap of frequent parts


def split(texts: list[bytes]) -> tuple[pa.DictionaryArray, np.ndarray]:
    """All words of the texts, lower-cased, as numbers of distinct words; and the piece that each stands in."""
    data = np.frombuffer(BREAK.join(texts).translate(TABLE), np.uint8)
    breaks = data == BREAK[0]
    gap = breaks | (data == 32)
    inside = np.concatenate([[False], ~gap, [False]]).astype(np.int8)
    step = np.diff(inside)
    start, stop = np.flatnonzero(step == 1), np.flatnonzero(step == -1)
    offsets = np.concatenate([[0], np.cumsum(stop - start)]).astype(np.int32)
    words = pa.BinaryArray.from_buffers(pa.binary(), len(start), [None, pa.py_buffer(offsets), pa.py_buffer(data[~gap])])
    return words.dictionary_encode(), np.cumsum(breaks)[start]


def values(words: pa.BinaryArray) -> list[bytes]:
    """The words as bytes."""
    _, offsets, data = words.buffers()
    at = np.frombuffer(offsets, np.int32)[words.offset : words.offset + len(words) + 1].tolist() if len(words) else [0]
    raw = data.to_pybytes() if data else b""
    return [raw[a:b] for a, b in zip(at[:-1], at[1:], strict=True)]


class Words(dict):
    """Numbers of words in the order in which they are first seen."""

    def __missing__(self, word: bytes) -> int:
        n = self[word] = len(self)
        return n


SHIFT = np.int64(31)
LOW = np.int64((1 << 31) - 1)


class HatTrie:
    """Counts of phrases of one size of 1 to 3 words, given by numbers: the first word, and the others packed into one.

    The trie begins as one hash container of whole phrases. When that has ``burst`` entries, and twice those that the last
    time left, each first word with a ``SHARE``-th of ``burst`` or more gets a container of its own, of the rests of its phrases.
    """

    SHARE = 64

    def __init__(self, size: int, burst: int):
        self.counts = np.zeros(0, np.int64) if size == 1 else None  # of single words, by number
        self.pairs, self.limit, self.next = size > 2, burst, burst  # of three words, a key is a pair; of fewer, one number
        self.root: Counter[tuple[int, int] | int] = Counter()
        self.nodes: dict[int, Counter[int]] = {}
        self.burst = np.zeros(1, bool)  # by first word

    def add(self, first: np.ndarray, rest: np.ndarray) -> None:
        """Adds one occurrence of each."""
        if self.counts is not None:
            own = np.bincount(first, minlength=len(self.counts))
            own[: len(self.counts)] += self.counts
            self.counts = own
            return
        if len(first) and first.max() >= len(self.burst):
            self.burst = np.append(self.burst, np.zeros(int(first.max()) + 1, bool))
        own = self.burst[first]
        a, t = first[~own], rest[~own]
        self.root.update(zip(a.tolist(), t.tolist(), strict=True) if self.pairs else ((a << SHIFT) | t).tolist())
        a, t = first[own], rest[own]
        order = np.argsort(a, kind="stable")
        a, t = a[order], t[order]
        cut = np.flatnonzero(np.diff(a)) + 1
        for i, j in zip([0, *cut.tolist()], [*cut.tolist(), len(a)], strict=True):
            if i < j:
                self.nodes[int(a[i])].update(t[i:j].tolist())
        if len(self.root) > self.next:
            self.split_root()

    def root_arrays(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        keys = list(self.root)
        count = np.fromiter(self.root.values(), np.int64, len(keys))
        if self.pairs:
            pair = np.array(keys, np.int64).reshape(-1, 2)
            return pair[:, 0], pair[:, 1], count
        key = np.array(keys, np.int64)
        return key >> SHIFT, key & LOW, count

    def split_root(self) -> None:
        """First words with many phrases get containers of their own."""
        first, rest, count = self.root_arrays()
        heads, n = np.unique(first, return_counts=True)
        heads = heads[n >= max(2, self.limit // self.SHARE)]
        own = np.isin(first, heads)
        a, t, c = first[own], rest[own], count[own]
        order = np.argsort(a, kind="stable")
        a, t, c = a[order], t[order], c[order]
        cut = np.flatnonzero(np.diff(a)) + 1
        for i, j in zip([0, *cut.tolist()], [*cut.tolist(), len(a)], strict=True):
            if i < j:
                self.nodes[int(a[i])] = Counter(dict(zip(t[i:j].tolist(), c[i:j].tolist(), strict=True)))
        self.burst[heads] = True
        for key in zip(a.tolist(), t.tolist(), strict=True) if self.pairs else ((a << SHIFT) | t).tolist():
            del self.root[key]
        self.next = max(self.limit, 2 * len(self.root))

    def entries(self) -> int:
        if self.counts is not None:
            return int(np.count_nonzero(self.counts))
        return len(self.root) + sum(map(len, self.nodes.values()))

    def take(self, share: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Takes whole subtrees out, the largest first, until so much of all entries is gone: first words, rests and counts."""
        if self.counts is not None:
            head = np.flatnonzero(self.counts)
            count, self.counts = self.counts[head], np.zeros(0, np.int64)
            return head, np.zeros(len(head), np.int64), count
        want, out = share * self.entries(), []
        for n, head in sorted([(len(self.root), -1), *((len(c), h) for h, c in self.nodes.items())], reverse=True):
            if want <= 0:
                break
            want -= n
            if head < 0:
                out.append(self.root_arrays())
                self.root, self.next = Counter(), self.limit
            else:
                box = self.nodes.pop(head)
                self.burst[head] = False
                out.append((np.full(n, head, np.int64), np.fromiter(box.keys(), np.int64, n), np.fromiter(box.values(), np.int64, n)))
        none = np.zeros(0, np.int64)
        return tuple(np.concatenate([none, *c]) for c in zip(*out, strict=True)) if out else (none, none, none)


def ngrams(ids: np.ndarray, piece: np.ndarray, size: int, bad: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First numbers and packed rests of all windows within a piece, in which no ``bad`` part of one word less begins."""
    n = max(0, len(ids) - size + 1)
    ok = piece[:n] == piece[size - 1 :]
    for j in range(2 if size > 1 else 0):
        ok &= ~bad[j : j + n]
    at = np.flatnonzero(ok)
    rest = ids[at + 1] if size > 1 else np.zeros(len(at), np.int64)
    if size > 2:
        rest = (rest << SHIFT) | ids[at + 2]
    return ids[at], rest


RUNS = "lang string, phrase string, n long"


class Task:
    """One task's trie for one language."""

    def __init__(self, lang: str, size: int, params: Params, bitmap: np.ndarray | None):
        self.lang, self.size, self.params, self.bitmap = lang, size, params, bitmap
        self.words, self.trie = Words(), HatTrie(size, params.burst)

    def hashes(self, parts: list[bytes]) -> np.ndarray:
        """Places in the bitmap: Spark's xxhash64 of language and part."""
        seed = xxhash.xxh64_intdigest(self.lang.encode(), 42)
        return np.fromiter((xxhash.xxh64_intdigest(p, seed) for p in parts), np.uint64, len(parts)) & np.uint64(self.params.filter_bits - 1)

    def bad_parts(self, local: np.ndarray, names: list[bytes], piece: np.ndarray) -> np.ndarray:
        """For each place, whether the part of one word less that begins there is surely not frequent."""
        if self.bitmap is None or not len(local):
            return np.zeros(len(local), bool)
        if self.size == 2:
            parts, back = names, local
        else:
            both = np.flatnonzero(piece[:-1] == piece[1:])
            own, inverse = np.unique((local[both] << SHIFT) | local[both + 1], return_inverse=True)
            parts = [names[i >> 31] + b" " + names[i & 2147483647] for i in own.tolist()]
            back = np.full(len(local), len(parts), np.int64)
            back[both] = inverse
        at = self.hashes(parts)
        there = (self.bitmap[(at >> np.uint64(6)).astype(np.int64)] >> (at & np.uint64(63))) & np.uint64(1)
        return np.append(there == 0, True)[back]

    def add(self, texts: list[bytes]) -> None:
        encoded, piece = split(texts)
        local, names = encoded.indices.to_numpy().astype(np.int64), values(encoded.dictionary)
        bad = self.bad_parts(local, names, piece)
        numbers = np.fromiter(map(self.words.__getitem__, names), np.int64, len(names))
        self.trie.add(*ngrams(numbers[local], piece, self.size, bad))

    def full(self) -> bool:
        return self.trie.entries() > self.params.trie_entries or len(self.words) > self.params.task_words

    def spill(self, all_: bool = False) -> Iterator[pa.RecordBatch]:
        """Sorted runs of the largest subtrees, or of all."""
        all_ = all_ or len(self.words) > self.params.task_words
        first, rest, count = self.trie.take(1 if all_ else 0.5)
        names = pa.array(list(self.words), pa.binary())
        rank = np.empty(len(names), np.int64)
        rank[pc.sort_indices(names).to_numpy()] = np.arange(len(names))
        columns = [first] if self.size == 1 else [first, rest] if self.size == 2 else [first, rest >> SHIFT, rest & LOW]
        order = np.argsort((rank[first] << SHIFT) | (rank[rest] if self.size == 2 else 0)) if self.size < 3 else np.lexsort([rank[c] for c in reversed(columns)])
        for a in range(0, len(order), 50_000):
            at = order[a : a + 50_000]
            parts = [names.take(pa.array(c[at])) for c in columns]
            phrase = parts[0] if self.size == 1 else pc.binary_join_element_wise(*parts, b" ")
            yield pa.RecordBatch.from_arrays([pa.array([self.lang] * len(at), pa.string()), phrase.cast(pa.string()), pa.array(count[at], pa.int64())], ["lang", "phrase", "n"])
        if all_:
            self.words.clear()
            self.trie = HatTrie(self.size, self.params.burst)


def runs(docs: DataFrame, size: int, params: Params, bitmap: Broadcast | None) -> DataFrame:
    """``lang``, ``phrase``, ``n``: the sorted runs of all tasks for phrases of one size."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own: dict[str, Task] = {}
        bits = None if bitmap is None else np.frombuffer(bitmap.value, np.uint64)
        for b in batches:
            langs, texts = np.array(b.column("lang").to_pylist(), object), b.column("text").to_pylist()
            for lang in sorted(set(langs)):
                c = own.get(lang)
                if c is None:
                    c = own[lang] = Task(lang, size, params, bits)
                c.add([texts[i] for i in np.flatnonzero(langs == lang)])
                if c.full():
                    yield from c.spill()
            while sum(c.trie.entries() for c in own.values()) > params.trie_entries or sum(len(c.words) for c in own.values()) > 2 * params.task_words:
                c = max(own.values(), key=lambda c: c.trie.entries() + len(c.words))
                yield from c.spill(True)
                del own[c.lang]  # however many languages there are, few stay
        for c in own.values():
            yield from c.spill(True)

    own = docs.select(F.coalesce(F.col("lang"), F.lit(UNKNOWN_LANG)).alias("lang"), F.col("text").cast("binary").alias("text")).where(F.length("text") > 0)
    return own.mapInArrow(count, RUNS)


def part_hash(bits: int) -> Column:
    return F.xxhash64("lang", "phrase").bitwiseAND(F.lit(bits - 1))


def frequent_bitmap(counts: DataFrame, params: Params) -> Broadcast:
    """A bit for each frequent phrase, set in Spark; of fixed size, whatever the number of phrases."""
    bits = params.filter_bits
    own = counts.where(F.col("n") >= params.least).select(part_hash(bits).alias("at"))
    set_ = own.groupBy(F.shiftright("at", 6).alias("word")).agg(F.expr("bit_or(shiftleft(1L, cast(at & 63 as int)))").alias("bits"))
    table = set_.toArrow()  # bits / 64 rows at most
    out = np.zeros(bits // 64, np.uint64)
    out[table.column("word").to_numpy()] = table.column("bits").to_numpy().view(np.uint64)
    return counts.sparkSession.sparkContext.broadcast(out.tobytes())


def merged(parts: DataFrame) -> DataFrame:
    """The runs of each prefix partition, with equal phrases added up."""
    prefix = F.substring_index("phrase", " ", 2).alias("prefix")
    return parts.select("lang", prefix, "phrase", "n").repartition("lang", "prefix").groupBy("lang", "prefix", "phrase").agg(F.sum("n").alias("n")).drop("prefix")


def phrase_counts(docs: DataFrame, params: Params = Params()) -> list[DataFrame]:
    """``lang``, ``phrase``, ``n`` of all words, and of the phrases of each further size with ``least`` occurrences or more."""
    if not 2 <= params.max_words <= 3:
        raise ValueError("phrases have two or three words at most")
    prepare(docs.sparkSession)
    levels = [saved(merged(runs(docs, 1, params, None)))]
    for size in range(2, params.max_words + 1):
        bitmap = frequent_bitmap(levels[-1], params)
        levels.append(saved(merged(runs(docs, size, params, bitmap)).where(F.col("n") >= params.least)))
    return levels


def score(a: str, left: str, right: str) -> Column:
    """floor(10^6 a^2 / (l r)), exact."""
    wide = lambda c: f"cast({c} as decimal(38, 0))"
    return F.expr(f"(1000000 * ({wide(a)} * {wide(a)})) div ({wide(left)} * {wide(right)})")


def scored(levels: list[DataFrame], params: Params) -> DataFrame:
    """Candidates with the counts and the score of their lowest cut."""
    out = []
    for size, own in enumerate(levels[1:], 2):
        words = F.split("phrase", " ")
        rows = own.where(F.col("n") >= params.least).withColumnRenamed("n", "a")
        for k in range(1, size):
            for side, part, level in (("l", F.slice(words, 1, k), k), ("r", F.slice(words, k + 1, size - k), size - k)):
                known = levels[level - 1].where(F.col("n") >= params.least).select("lang", F.col("phrase").alias(f"{side}_part"), F.col("n").alias(f"{side}{k}"))
                rows = rows.withColumn(f"{side}_part", F.array_join(part, " ")).join(known, ["lang", f"{side}_part"]).drop(f"{side}_part")
        cuts = [F.struct(score("a", f"l{k}", f"r{k}").alias("score"), F.lit(k).alias("k"), F.col(f"l{k}").alias("l"), F.col(f"r{k}").alias("r")) for k in range(1, size)]
        lowest = cuts[0] if size == 2 else F.least(*cuts)  # by score, then k
        out.append(rows.select("lang", "phrase", F.lit(size).alias("size"), "a", lowest.alias("cut")).select("lang", "phrase", "size", "a", "cut.l", "cut.r", "cut.score"))
    return reduce(DataFrame.unionByName, out)


def held_by_longer(candidates: DataFrame, params: Params) -> DataFrame:
    """``lang``, ``phrase`` and the largest count of a longer candidate that holds the phrase's words in a row."""
    words = F.split("phrase", " ")
    inner = F.flatten(F.transform(F.sequence(F.lit(2), F.col("size") - 1), lambda n: F.transform(F.sequence(F.lit(1), F.col("size") - n + 1), lambda s: F.array_join(F.slice(words, s, n), " "))))
    return candidates.where("size > 2").select("lang", F.explode(inner).alias("phrase"), "a").groupBy("lang", "phrase").agg(F.max("a").alias("longer"))


#: Parts of a language's phrases that are ranked by themselves first.
PARTS = 16


def ranked(rows: DataFrame, top: int) -> DataFrame:
    """The first rows of each language with their rank: the first of each part, then of these."""
    order = [F.desc("score"), F.desc("a"), "phrase"]
    part = F.pmod(F.xxhash64("phrase"), F.lit(PARTS))
    first = rows.withColumn("part", part).withColumn("rank", F.row_number().over(Window.partitionBy("lang", "part").orderBy(*order))).where(F.col("rank") <= top).drop("part", "rank")
    return first.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long")).where(F.col("rank") <= top)


def collocations(docs: DataFrame, params: Params = Params()) -> DataFrame:
    """``lang``, ``rank``, ``phrase``, ``a``, ``l``, ``r``, ``n``, ``score``: the first phrases of each language."""
    levels = phrase_counts(docs, params)
    total = levels[0].groupBy("lang").agg(F.sum("n").alias("n"))
    candidates = saved(scored(levels, params))
    longer = held_by_longer(candidates, params)
    kept = candidates.join(longer, ["lang", "phrase"], "left").where(F.col("longer").isNull() | (100 * F.col("longer") < params.held_pct * F.col("a")))
    top = ranked(kept.select("lang", "phrase", "a", "l", "r", "score"), params.top)
    return top.join(total, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


SPLIT = re.sub(r"[\x0a-\x0d]", lambda m: f"\\x{ord(m[0]):02x}", BREAKS.decode())
ORACLE_SQL = rf"""
WITH pieces AS (
  SELECT row_number() OVER () AS piece, lang, regexp_extract_all(p, '[^\x20\x09]+') AS w
  FROM (SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[{SPLIT}]')) AS p FROM documents WHERE text IS NOT NULL)),
places AS (SELECT piece, lang, unnest(w) AS x, generate_subscripts(w, 1) AS i FROM pieces WHERE len(w) > 0),
near AS (SELECT lang, x, lead(x) OVER (PARTITION BY piece ORDER BY i) AS y, lead(x, 2) OVER (PARTITION BY piece ORDER BY i) AS z FROM places),
f AS (
  SELECT lang, size, phrase, count(*) AS n FROM (
    SELECT lang, 1 AS size, x AS phrase FROM near UNION ALL SELECT lang, 2, concat_ws(' ', x, y) FROM near WHERE y IS NOT NULL UNION ALL SELECT lang, 3, concat_ws(' ', x, y, z) FROM near WHERE z IS NOT NULL) GROUP BY ALL),
c AS (SELECT *, string_split(phrase, ' ') AS w FROM f WHERE size > 1 AND n >= 10),
cuts AS (
  SELECT c.lang, c.size, c.phrase, c.n AS a, k, x.n AS l, y.n AS r, CAST((1000000::HUGEINT * c.n * c.n) // (x.n::HUGEINT * y.n) AS BIGINT) AS score
  FROM (SELECT *, unnest(range(1, size)) AS k FROM c) c
  JOIN f x ON x.lang = c.lang AND x.phrase = array_to_string(c.w[1:k], ' ') JOIN f y ON y.lang = c.lang AND y.phrase = array_to_string(c.w[k + 1:], ' ')),
lowest AS (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
inner_parts AS (SELECT lang, n, unnest([array_to_string(w[1:2], ' '), array_to_string(w[2:3], ' ')]) AS phrase FROM c WHERE size = 3),
held AS (SELECT lang, phrase, max(n) AS longer FROM inner_parts GROUP BY ALL),
kept AS (SELECT l.* FROM lowest l LEFT JOIN held h USING (lang, phrase) WHERE h.longer IS NULL OR 100 * h.longer < 50 * l.a),
top AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM kept QUALIFY rank <= 2000)
SELECT lang, rank, phrase, a, l, r, n, score FROM top JOIN (SELECT lang, CAST(sum(n) AS BIGINT) AS n FROM f WHERE size = 1 GROUP BY lang) USING (lang)
"""
