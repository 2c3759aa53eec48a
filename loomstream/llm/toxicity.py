"""Toxicity: nearest labelled examples by exact TF-IDF cosine over a block-max inverted index.

Examples are a bounded sample of labelled rows (``Params.examples``). Terms are all
their words, and beginnings of words that lean to toxic rows. A term's weight in a
text is log(1 + occurrences) x inverse document frequency (counted over all documents)
x a relevance factor, from ``Params.background`` for ordinary terms to 1 for those
whose share among the toxic rows of a larger sample (``Params.max_rows``) is
significantly larger. No term is left out; words that no example has are orthogonal
to all of them, and cosines are taken in the space of the examples' terms.
Examples with equal vectors become one, with its number of labels.

The index keeps for each block of examples the weights of the most frequent terms as
a table, the postings of all others, and each term's largest weight; a query visits every block whose
upper bound reaches its k-th best cosine so far, so the neighbours are exact. They vote with weights
that fall with their distance, and a logistic curve fitted to the leave-one-out votes
of the examples makes the votes probabilities. The neighbours are the evidence.

Defined results: null and empty texts, and texts without a known term, get the score
of a vote at the share of label 1, and no evidence. Without labels of both classes
the score is that share, or 0 without any label. A ``doc_id`` with several label rows
counts once, with its largest label and the first of its texts. Ties between
neighbours go to the smaller example. Rows repeat as often as they come in; a null
``doc_id`` is scored and not held out; extra columns are neither read nor returned.
"""

from __future__ import annotations

import re
from array import array
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import chain

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import crc_mod, prepare, saved, texts
from .quality import labelled_sample

FOLDS, HELD_OUT, THRESHOLD = 3, 1, 0.7
WORD = re.compile(r"\w+")
BEGINNINGS = (5, 7)
#: Of the characters that Latin-1 has, a space for those that no word has.
SPACED = "".join(c if WORD.match(c) else " " for c in map(chr, range(256))).encode("latin-1")


@dataclass(frozen=True)
class Params:
    max_rows: int = 20_000  # labelled rows that terms are rated by, those with the smallest hash of doc_id
    examples: int = 4_000  # of them, rows that are indexed as neighbours
    least_rows: int = 5  # toxic rows that a relevant term occurs in
    significance: tuple[float, float] = (2.0, 6.0)  # roots of the likelihood ratio between which the relevance rises
    background: float = 0.1  # relevance of all other terms
    k: int = 15
    block: int = 256


def words_of(text: str) -> list[str]:
    """The words of a text in lower case."""
    low = text.lower()
    try:
        return low.encode("latin-1").translate(SPACED).decode("latin-1").split()
    except UnicodeEncodeError:
        return WORD.findall(low)


def terms_of(text: str) -> Counter:
    """How often each word, and each beginning of a longer word (marked by a caret), occurs."""
    words = Counter(words_of(text))
    out = Counter(words)
    for w, n in words.items():
        for size in BEGINNINGS:
            if len(w) > size:
                out["^" + w[:size]] += n
    return out


def joined_ranges(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """All integers of the ranges, one range after another."""
    return np.arange(lengths.sum()) + np.repeat(starts - np.cumsum(lengths) + lengths, lengths)


class Finder(dict):
    """Finds given terms in texts without counting any others; numbers the words that it meets."""

    def __init__(self, place: dict[str, int]):
        super().__init__()
        self.place = place
        tables = [(k, {t[1:]: i for t, i in place.items() if t[0] == "^" and len(t) == k + 1}) for k in BEGINNINGS]
        self.beginnings = [(k, t) for k, t in tables if t]
        self.forget()

    def forget(self) -> None:
        self.clear()
        self.starts, self.flat = array("q", [0, 0]), array("q")  # places of words, one word after another; word 0 stands for those without any

    def __missing__(self, w: str) -> int:
        own = [self.place[w]] if w in self.place else []
        for k, t in self.beginnings:
            if len(w) > k and w[:k] in t:
                own.append(t[w[:k]])
        if not own:
            return 0  # not remembered, as most such words come once
        number = self[w] = len(self.starts) - 1
        self.flat.extend(own)
        self.starts.append(len(self.flat))
        return number

    def found(self, given: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Each text with each term that it has, by its place (rising in a text), and how often."""
        if len(self) > 300_000:
            self.forget()
        words = [words_of(t) for t in given]
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        met = np.fromiter(map(self.__getitem__, chain.from_iterable(words)), np.int64, lengths.sum())
        starts, flat = np.array(self.starts), np.array(self.flat)
        many = starts[met + 1] - starts[met]
        owner = np.repeat(np.repeat(np.arange(len(words)), lengths), many)
        key = np.sort((owner << 32) | flat[joined_ranges(starts[met], many)])
        first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])) if len(key) else np.zeros(0, np.int64)
        return key[first] >> 32, key[first] & (2**32 - 1), np.diff(np.append(first, len(key)))


#: Texts whose terms are found at once.
TOGETHER = 128


def relevance(sample: DataFrame, params: Params) -> dict[str, float]:
    """The terms whose relevance is above the background, as they occur significantly more in toxic rows."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seen = (Counter(), Counter())
        rows = [0, 0]
        for b in batches:
            for text, label in zip(b["text"], b["label"], strict=True):
                rows[int(label)] += 1
                seen[int(label)].update(terms_of(text).keys())
        names = list(set(seen[0]) | set(seen[1]))
        yield pd.DataFrame({"term": [*names, None], "neg": [seen[0][t] for t in names] + [rows[0]], "pos": [seen[1][t] for t in names] + [rows[1]]}).astype({"term": object})

    counts = saved(sample.mapInPandas(count, "term string, neg long, pos long").groupBy("term").agg(F.sum("neg").alias("neg"), F.sum("pos").alias("pos")))
    total = counts.where("term is null").select("neg", "pos").head()
    if total is None or not total["neg"] or not total["pos"]:
        return {}
    odds = F.log((F.col("pos") + 0.5) / total["pos"]) - F.log((F.col("neg") + 0.5) / total["neg"])
    share = total["pos"] / (total["pos"] + total["neg"])
    part = lambda k, p: F.when(k > 0, k * F.log(k / ((F.col("pos") + F.col("neg")) * p))).otherwise(F.lit(0.0))
    z = F.sqrt(F.greatest(F.lit(0.0), 2 * (part(F.col("pos"), share) + part(F.col("neg"), 1 - share))))  # root of the likelihood ratio
    low, high = params.significance
    leaning = counts.where(F.col("term").isNotNull() & (F.col("pos") >= params.least_rows) & (z > low) & (odds >= 0.7))
    rise = F.least(F.lit(1.0), (z - low) / (high - low))
    return {r.term: r.f for r in leaning.select("term", (params.background + (1 - params.background) * rise).alias("f")).collect()}


def document_frequencies(docs: DataFrame, place: dict[str, int]) -> np.ndarray:
    """In how many documents each term occurs, and the number of documents last."""
    shared = docs.sparkSession.sparkContext.broadcast(place)

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        find = Finder(shared.value)
        n = np.zeros(len(find.place) + 1, np.int64)
        for b in batches:
            for first in range(0, len(b), TOGETHER):
                _, dims, _ = find.found(b["text"].iloc[first : first + TOGETHER].tolist())
                n[:-1] += np.bincount(dims, minlength=len(find.place))
            n[-1] += len(b)
        at = np.flatnonzero(n)
        yield pd.DataFrame({"i": at, "n": n[at]})

    rows = texts(docs).select("text").mapInPandas(count, "i int, n long").groupBy("i").agg(F.sum("n").alias("n")).toPandas()
    out = np.zeros(len(place) + 1)
    out[rows["i"]] = rows["n"]
    return out


@dataclass
class Block:
    """A block of examples: weights of the frequent terms, and of the others their postings.

    ``terms`` are those with postings, ``starts`` where each one's begin, ``tops`` the largest weights.
    """

    first: int
    size: int
    frequent: np.ndarray
    terms: np.ndarray
    starts: np.ndarray
    members: np.ndarray
    weights: np.ndarray
    tops: np.ndarray


@dataclass
class Index:
    """Block-max inverted index of unit vectors."""

    place: dict[str, int] = field(default_factory=dict)
    scale: np.ndarray = field(default_factory=lambda: np.zeros(0))  # idf x relevance of each term
    ids: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))  # an example's smallest doc_id
    n: np.ndarray = field(default_factory=lambda: np.zeros(0))
    pos: np.ndarray = field(default_factory=lambda: np.zeros(0))
    block: int = 256
    k: int = 15
    prior: float = 0.0
    curve: tuple[float, float] = (0.0, 1.0)
    frequent: int = 256  # terms of the first places, which many examples have, so that postings would save little
    together: int = 32  # queries that are compared at once; with more, their shared postings take hundreds of megabytes
    blocks: list[Block] = field(default_factory=list)
    find: Finder | None = None
    tops: np.ndarray | None = None  # term x block
    spots: np.ndarray | None = None  # block x term: the term's place among those with postings there, or -1

    def vectors(self, given: list[str]) -> list[tuple[np.ndarray, np.ndarray]]:
        """Dimensions (rising) and weights of the unit vector of each text."""
        if self.find is None:
            self.find = Finder(self.place)
        owner, dims, n = self.find.found(given)
        w = np.log1p(n) * self.scale[dims]
        w = (w / np.sqrt(np.bincount(owner, w * w, len(given)))[owner]).round(6)
        bounds = np.searchsorted(owner, np.arange(len(given) + 1)).tolist()
        return [(dims[i:j], w[i:j]) for i, j in zip(bounds, bounds[1:])]

    def build(self, vectors: list[tuple[np.ndarray, np.ndarray]]) -> None:
        self.blocks = []
        for first in range(0, len(vectors), self.block):
            own = vectors[first : first + self.block]
            dims = np.concatenate([d for d, _ in own])
            weights = np.concatenate([w for _, w in own])
            members = np.repeat(np.arange(len(own)), [len(d) for d, _ in own])
            head = dims < self.frequent
            frequent = np.zeros((len(own), self.frequent))
            frequent[members[head], dims[head]] = weights[head]
            dims, weights, members = dims[~head], weights[~head], members[~head]
            order = np.argsort(dims, kind="stable")
            dims, weights, members = dims[order], weights[order], members[order]
            terms, starts = np.unique(dims, return_index=True)
            tops = np.maximum.reduceat(weights, starts) if len(terms) else np.zeros(0)
            self.blocks.append(Block(first, len(own), frequent, terms, np.append(starts, len(dims)), members, weights, tops))
        self.tops = self.spots = None

    def bounds(self, dims: np.ndarray, weights: np.ndarray) -> np.ndarray:
        """The largest cosine that an example of each block can have."""
        if self.tops is None:
            self.tops = np.zeros((max(len(self.place), self.frequent), len(self.blocks)), np.float32)
            for i, b in enumerate(self.blocks):
                self.tops[: self.frequent, i] = b.frequent.max(axis=0)
                self.tops[b.terms, i] = b.tops
        return weights @ self.tops[dims] * (1 + 1e-6)  # the table is rounded

    def places(self, i: int, dims: np.ndarray) -> np.ndarray:
        """Of terms, their places among those with postings in a block, or -1."""
        if self.spots is None:
            self.spots = np.full((len(self.blocks), max(len(self.place), self.frequent)), -1, np.int32)
            for own, b in zip(self.spots, self.blocks, strict=True):
                own[b.terms] = np.arange(len(b.terms))
        return self.spots[i, dims]

    def cosines(self, i: int, head: np.ndarray, owner: np.ndarray, dims: np.ndarray, weights: np.ndarray) -> np.ndarray:
        """Queries x examples of a block: cosines in millionths.

        ``head``: a row of weights of the frequent terms for each query; ``owner``, ``dims``, ``weights``: the queries' other terms.
        """
        b = self.blocks[i]
        own = head @ b.frequent.T
        if len(b.terms) and len(dims):
            at = self.places(i, dims)
            shared = np.flatnonzero(at >= 0)
            at, w, q = at[shared], weights[shared], owner[shared]
            starts = b.starts[at]
            lengths = b.starts[at + 1] - starts
            where = joined_ranges(starts, lengths)
            own += np.bincount(np.repeat(q * b.size, lengths) + b.members[where], b.weights[where] * np.repeat(w, lengths), own.size).reshape(own.shape)
        return np.rint(own * 1e6).astype(np.int64)

    def nearest(self, queries: list[tuple[np.ndarray, np.ndarray]], k: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """For each query the k examples of the largest cosine, exactly, and their cosines; examples without a common term are none."""
        for first in range(0, len(queries), self.together):
            yield from self.nearest_together(queries[first : first + self.together], k)

    def nearest_together(self, queries: list[tuple[np.ndarray, np.ndarray]], k: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """The same for a few queries, each of which visits the blocks that can hold one of its k; those that promise most come first."""
        bounds = np.stack([self.bounds(*q) for q in queries])
        dims, weights = (np.concatenate([q[i] for q in queries]) for i in range(2))
        owner = np.repeat(np.arange(len(queries)), [len(d) for d, _ in queries])
        often = dims < self.frequent
        head = np.zeros((len(queries), self.frequent))
        head[owner[often], dims[often]] = weights[often]
        dims, weights, owner = dims[~often], weights[~often], owner[~often]
        # one number for a cosine and an example: larger for the larger cosine, then for the smaller example; 0 for none
        best = np.zeros((len(queries), k), np.int64)
        for i in np.argsort(-bounds.sum(axis=0), kind="stable").tolist():
            first = self.blocks[i].first
            own = np.flatnonzero((bounds[:, i] > 0) & (bounds[:, i] * 1e6 >= (best[:, 0] >> 32) - 1))
            if not len(own):
                continue
            if len(own) == len(queries):
                cos = self.cosines(i, head, owner, dims, weights)
            else:
                row = np.full(len(queries), -1)
                row[own] = np.arange(len(own))
                kept = np.flatnonzero(row[owner] >= 0)
                cos = self.cosines(i, head[own], row[owner[kept]], dims[kept], weights[kept])
            found = np.where(cos > 0, (cos << 32) + (2**32 - 1 - first - np.arange(cos.shape[1])), 0)
            both = np.concatenate([best[own], found], axis=1)
            best[own] = np.partition(both, both.shape[1] - k, axis=1)[:, -k:]  # the smallest of the k in front
        best.sort(axis=1)
        for own in best[:, ::-1]:
            own = own[own > 0]
            yield 2**32 - 1 - (own & (2**32 - 1)), (own >> 32) / 1e6

    def vote(self, who: np.ndarray, cos: np.ndarray, less: int = -1, label: float = 0) -> float:
        """Weighted share of label 1 among neighbours; ``less``: an example that one row of this label is left out of."""
        own = (who == less).astype(float)
        n = self.n[who] - own
        share = np.divide(self.pos[who] - own * label, n, out=np.zeros(len(who)), where=n > 0)
        w = np.minimum(n, self.k) / (0.02 + 1 - cos)
        return float((w @ share + 0.5 * self.prior) / (w.sum() + 0.5))

    def probability(self, vote: float) -> float:
        a, b = self.curve
        v = min(max(vote, 1e-4), 1 - 1e-4)
        return float(1 / (1 + np.exp(-(a + b * np.log(v / (1 - v))))))

    def scores(self, given: list[str]) -> list[tuple[float, np.ndarray, np.ndarray]]:
        """Score, and ids and cosines of the nearest examples, of each text."""
        if not len(self.ids):
            return [(self.prior, np.zeros(0, np.int64), np.zeros(0)) for _ in given]
        out = []
        for first in range(0, len(given), TOGETHER):
            found = self.nearest(self.vectors(given[first : first + TOGETHER]), self.k)
            out += [(self.probability(self.vote(who, cos)), self.ids[who], cos) for who, cos in found]
        return out


def fit_curve(votes: np.ndarray, labels: np.ndarray, weights: np.ndarray) -> tuple[float, float]:
    """Logistic regression of labels on the votes' log odds, with a weak pull towards the identity."""
    v = np.clip(votes, 1e-4, 1 - 1e-4)
    x = np.stack([np.ones(len(v)), np.log(v / (1 - v))], 1)
    beta = np.array([0.0, 1.0])
    for _ in range(30):
        p = 1 / (1 + np.exp(-(x @ beta)))
        grad = x.T @ (weights * (p - labels)) + 0.5 * (beta - [0, 1])
        step = np.linalg.solve((x * (weights * p * (1 - p))[:, None]).T @ x + 0.5 * np.eye(2), grad)
        beta = beta - np.clip(step, -2, 2)
    return float(beta[0]), float(np.clip(beta[1], 0.3, 3.0))


def fit(docs: DataFrame, labels: DataFrame, params: Params = Params()) -> Index:
    usable = crc_mod("doc_id", FOLDS) != HELD_OUT
    leaning = relevance(labelled_sample(docs, labels, "toxic", usable, params.max_rows), params)
    rows = labelled_sample(docs, labels, "toxic", usable, params.examples).toPandas().sort_values("doc_id")
    rows["label"] = rows["label"].astype(float).clip(0, 1)
    index = Index(block=params.block, k=params.k, prior=float(rows["label"].mean()) if len(rows) else 0.0)
    if not len(rows) or index.prior in (0.0, 1.0):
        return index
    words: Counter = Counter()
    for text in rows["text"]:
        words.update(set(words_of(text)))
    # frequent terms come first, so that examples in the order of their dimensions lie beside others of their kind
    terms = sorted(words, key=lambda w: (-words[w], w)) + sorted(t for t in leaning if t[0] == "^")
    index.place = {t: i for i, t in enumerate(terms)}
    df = document_frequencies(docs, index.place)
    factor = np.array([leaning.get(t, params.background) for t in terms])
    index.scale = (np.log((df[-1] + 1) / (df[:-1] + 1)) + 1) * factor
    merged: dict[tuple, list] = {}
    del words, terms
    given = rows["text"].tolist()
    vectors = chain.from_iterable(index.vectors(given[i : i + TOGETHER]) for i in range(0, len(given), TOGETHER))
    for doc_id, (dims, weights), label in zip(rows["doc_id"], vectors, rows["label"], strict=True):
        # bytes of big-endian numbers of 0 or more stand in the order of the numbers, and take a tenth of their tuples' memory
        own = merged.setdefault((dims.astype(">i4").tobytes(), weights.astype(">f8").tobytes()), [doc_id, 0.0, 0.0])
        own[1] += 1
        own[2] += label
    keys = sorted(merged)
    index.ids, index.n, index.pos = (np.array([merged[k][i] for k in keys]) for i in range(3))
    vectors = [(np.frombuffer(d, ">i4").astype(np.int64), np.frombuffer(w, ">f8").astype(float)) for d, w in keys]
    del rows, given, merged, keys  # the driver is small
    index.build(vectors)
    votes, ys, ws = [], [], []
    for e, (who, cos) in enumerate(index.nearest(vectors, params.k)):
        for label, count in ((1.0, index.pos[e]), (0.0, index.n[e] - index.pos[e])):
            if count:
                votes.append(index.vote(who, cos, e, label))
                ys.append(label)
                ws.append(count)
    index.curve = fit_curve(np.array(votes), np.array(ys), np.array(ws))
    index.find = index.tops = index.spots = None  # made again where they are needed, not sent
    return index


def toxicity_scores(docs: DataFrame, labels: DataFrame, params: Params = Params()) -> DataFrame:
    """``doc_id``, ``held_out``, ``score``, ``predicted``, and as evidence the ids and cosines of the nearest examples."""
    spark = prepare(docs.sparkSession)
    shared = spark.sparkContext.broadcast(fit(docs, labels, params))

    def apply(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        index = shared.value
        for b in batches:
            found = index.scores(b["text"].tolist())
            yield pd.DataFrame({"doc_id": b["doc_id"], "held_out": b["held_out"], "score": [s for s, _, _ in found], "evidence": [e for _, e, _ in found], "cosines": [c for _, _, c in found]})

    held_out = F.coalesce(crc_mod("doc_id", FOLDS) == HELD_OUT, F.lit(False)).alias("held_out")
    scored = texts(docs).select("doc_id", held_out, "text").mapInPandas(apply, "doc_id long, held_out boolean, score double, evidence array<long>, cosines array<double>")
    return scored.withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))
