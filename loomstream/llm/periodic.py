"""Periodic run detection: a suffix automaton whose link tree is a link-cut tree.

A run is a stretch of words with a smallest period q and a length of at least ``max(least, 2 q)`` that no neighbouring
word extends. Words of a text are appended one by one. The new prefix's node is accessed in the tree of suffix links: the
access walks the preferred paths from the node to the root, and each path has one colour, the place where its strings
ended last. A piece of a path that ended last at j, whose longest string has L words, says that the prefixes that end at i
and j have a longest common suffix of L words. Where the distance i - j is at most L, and more than the length of the
strings above the piece, ``text[i-d-L+1 .. i]`` is a square and more of primitive period d = i - j, which cannot be
extended to the left; the last i at which it is seen ends the run. The access then recolours the whole path with i. A
text of n words changes O(n log n) pieces in all.

Before that, what cannot be in a run is left out, exactly: every word of a run of at least 2 q >= 2 and 12 words lies in
a window of six words that occurs twice in its text, and in the same stretch of such windows. So the automaton reads only
those stretches, each by itself; in ordinary prose there are few.

Defined results: a null or empty text, or one of white space, has no words and no runs; a null ``doc_id`` is kept as it
is; repeated rows come out as often as they come in. A text is the unit of work, in one task, however long: the automaton
takes about a kilobyte for each word of the longest stretch. Columns other than ``doc_id`` and ``text`` are neither read
nor returned. There is no shuffle: each task reads, marks and returns its own rows, so a hot key cannot matter.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import prepare
from .words import covered, hashes, raw_texts, repeated_windows, words_of

#: Words that a run has at least, and the width of windows that mark where runs can be: 2 * WINDOW - 1 <= LEAST.
LEAST, WINDOW = 12, 6


class Squares:
    """The suffix automaton of the words appended so far, and its link tree as preferred paths in splay trees.

    Nodes are numbers from 1, the root; 0 stands for none. ``up`` is a parent within a splay tree, or the parent of a
    path's top. A splay tree holds one preferred path in order of length, and its root holds the path's colour.
    """

    def __init__(self):
        self.length, self.link, self.moves = [0, 0], [0, 0], [{}, {}]
        self.left, self.right, self.up, self.colour = [0, 0], [0, 0], [0, 0], [-1, -1]
        self.last, self.n = 1, 0
        self.found: dict[tuple[int, int], int] = {}  # (start, period): last word

    def node(self, length: int) -> int:
        self.length.append(length)
        self.link.append(0)
        self.moves.append({})
        self.left.append(0)
        self.right.append(0)
        self.up.append(0)
        self.colour.append(-1)
        return len(self.length) - 1

    def rotate(self, x: int) -> None:
        left, right, up = self.left, self.right, self.up
        p = up[x]
        g = up[p]
        if left[p] == x:
            b = right[x]
            left[p], right[x] = b, p
        else:
            b = left[x]
            right[p], left[x] = b, p
        if b:
            up[b] = p
        up[p], up[x] = x, g
        if g:
            if left[g] == p:
                left[g] = x
            elif right[g] == p:
                right[g] = x

    def splay(self, x: int) -> None:
        """Makes x the root of its splay tree; the colour goes along."""
        left, right, up = self.left, self.right, self.up
        top = x
        while (p := up[x]) and (left[p] == x or right[p] == x):
            g = up[p]
            if g and (left[g] == p or right[g] == p):
                self.rotate(p if (left[g] == p) == (left[p] == x) else x)
                top = g
            else:
                top = p
            self.rotate(x)
        self.colour[x] = self.colour[top]

    def insert_above(self, new: int, below: int) -> None:
        """Cuts ``below`` from its parent and links it to ``new``, which takes its place: both end where ``below`` ended last, so they share its path."""
        self.splay(below)
        above = self.left[below]
        self.left[new] = above
        if above:
            self.up[above] = new
        self.left[below], self.up[new] = new, below

    def access(self, x: int, end: int) -> None:
        """Makes the path from the root to x preferred, with the colour ``end``; notes a square for each piece that says so."""
        left, right, up, colour, length = self.left, self.right, self.up, self.colour, self.length
        node, below = x, 0
        while node:
            if up[node]:
                self.splay(node)
            if rest := right[node]:
                colour[rest] = colour[node]
            right[node] = below
            above = up[node]
            gap, longest = end - colour[node], length[node]
            if colour[node] >= 0 and length[above] < gap <= longest:
                self.found[end - gap - longest + 1, gap] = end
            node, below = above, node
        self.splay(x)
        colour[x] = end

    def append(self, word: int) -> None:
        length, link, moves, up = self.length, self.link, self.moves, self.up
        end, p = self.n, self.last
        new = self.node(length[p] + 1)
        while p and word not in moves[p]:
            moves[p][word] = new
            p = link[p]
        if not p:
            link[new] = up[new] = 1
        else:
            q = moves[p][word]
            if length[p] + 1 != length[q]:
                copy = self.node(length[p] + 1)
                moves[copy] = dict(moves[q])
                while p and moves[p].get(word) == q:
                    moves[p][word] = copy
                    p = link[p]
                self.insert_above(copy, q)
                link[copy], link[q] = link[q], copy
                q = copy
            link[new] = up[new] = q
        self.last, self.n = new, end + 1
        self.access(new, end)


def runs_in(words: list, least: int = LEAST) -> list[tuple[int, int, int]]:
    """(start, length, period) of every run of a list of words, by start, then period."""
    squares, ids = Squares(), {}
    for w in words:
        squares.append(ids.setdefault(w, len(ids)))
    return sorted((s, e - s + 1, q) for (s, q), e in squares.found.items() if e - s + 1 >= max(least, 2 * q))


def pieces(inside: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and last place, exclusive, of each stretch of marked places of one owner."""
    edge = np.flatnonzero(np.diff(owner)) + 1
    step = np.diff(np.concatenate([[0], inside.astype(np.int8), [0]]))
    cut = edge[inside[edge] & inside[edge - 1]]  # a stretch that goes on into the next text
    return np.sort(np.concatenate([np.flatnonzero(step == 1), cut])), np.sort(np.concatenate([np.flatnonzero(step == -1), cut]))


def candidate_stretches(words: list[list[bytes]]) -> list[tuple[int, int, int]]:
    """(text, first, last exclusive) of the stretches in which all runs of the texts lie."""
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    h, owner = hashes(words, int(sizes.sum())), np.repeat(np.arange(len(words)), sizes)
    if not len(h):
        return []
    text_of, begin = owner, np.cumsum(sizes) - sizes
    for _ in range(2):  # the second time a window must occur twice in the same stretch
        first, last = pieces(covered(repeated_windows(h, owner, WINDOW), WINDOW, len(h)), text_of)
        long = last - first >= LEAST
        first, last = first[long], last[long]
        step = np.zeros(len(h) + 1, np.int64)
        step[first] += 1
        owner = np.cumsum(step[:-1])  # words between stretches go with the one before, where their windows occur once
        outside = np.ones(len(h), bool)
        for a, b in zip(first.tolist(), last.tolist(), strict=True):
            outside[a:b] = False
        owner = np.where(outside, len(h) + np.arange(len(h)), owner)
    t = text_of[first]
    return list(zip(t.tolist(), (first - begin[t]).tolist(), (last - begin[t]).tolist(), strict=True))


def runs_of_texts(words: list[list[bytes]]) -> list[list[tuple[int, int, int]]]:
    """The runs of each text."""
    out: list[list[tuple[int, int, int]]] = [[] for _ in words]
    for text, a, b in candidate_stretches(words):
        out[text] += [(a + s, n, q) for s, n, q in runs_in(words[text][a:b])]
    return out


def kept_words(words: list[bytes], runs: list[tuple[int, int, int]]) -> list[bytes]:
    """The words that no run contains after its first period."""
    if not runs:
        return words
    keep = np.ones(len(words), bool)
    for s, n, q in runs:
        keep[s + q : s + n] = False
    return [words[i] for i in np.flatnonzero(keep).tolist()]


RUNS = "doc_id long, n_words long, runs array<struct<start: long, length: long, period: long>>, collapsed string"
RUN = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))


def document_runs(docs: DataFrame, change: Callable[[int | None, list[bytes]], list[bytes]] | None = None) -> DataFrame:
    """``doc_id``, ``n_words``, ``runs`` (by start, then period) and ``collapsed``: the words that are no repetition, joined by one space.

    ``change`` may give other words for those of a document before runs are sought.
    """
    prepare(docs.sparkSession)

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids, words = b.column("doc_id").to_pylist(), list(map(words_of, b.column("text").to_pylist()))
            if change is not None:
                words = list(map(change, ids, words))
            runs = runs_of_texts(words)
            named = [[{"start": s, "length": n, "period": q} for s, n, q in r] for r in runs]
            kept = [b" ".join(kept_words(w, r)) for w, r in zip(words, runs, strict=True)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.array(map(len, words), pa.int64(), size=len(words)), pa.array(named, RUN), pa.array(kept, pa.binary()).cast(pa.string())], ["doc_id", "n_words", "runs", "collapsed"]
            )

    return raw_texts(docs).withColumn("doc_id", F.col("doc_id").cast("long")).mapInArrow(apply, RUNS)


def with_planted_period(doc_id: int | None, words: list[bytes]) -> list[bytes]:
    """The words of every tenth document (by the checksum of its id) repeat with some period from some word on; without an id nothing changes."""
    if doc_id is None or not words:
        return words
    h = zlib.crc32(str(doc_id).encode())
    if h % 10:
        return words
    n, g = len(words), h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    unit = words[a : a + p]
    return words[:a] + (unit * ((n - a) // p + 1))[: n - a]


def run_report(docs: DataFrame) -> DataFrame:
    """For each document, with periods planted in every tenth: its number of runs, the longest run (ties: smallest start, then period), digests of all runs and of the collapsed text."""
    best = F.array_max(F.transform("runs", lambda r: F.struct(r["length"].alias("length"), (-r["start"]).alias("start"), (-r["period"]).alias("period"))))
    lines = F.array_join(F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"].cast("string"), r["length"].cast("string"), r["period"].cast("string")), F.lit("\n"))), "")
    found = document_runs(docs, with_planted_period).withColumn("best", best)
    return found.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), (-F.col("best.start")).alias("start"), F.col("best.length").alias("length"), (-F.col("best.period")).alias("period"),
        F.expr("1000 * best.length div -best.period").alias("exponent_milli"), F.sha2(lines, 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"), "n_words",
    )
