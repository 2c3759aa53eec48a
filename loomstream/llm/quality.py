"""Quality classifier: histogram gradient-boosted trees over document statistics.

The statistics come from one Arrow pass over whole texts. The trees are grown
with numpy on a bounded sample of labelled rows (``Params.max_rows``), stored as
flat arrays (feature, threshold and leaf value of a complete binary tree per
round) and walked for a whole batch at once: a level is one gather.

Defined results: a null or empty text has all-zero statistics and is scored as
such; without labels of both classes the score is the share of label 1 among
those there are, or 0.5 without any; a ``doc_id`` with several label rows counts
once, with its largest label; null labels are ignored; a null ``doc_id`` is
scored and is not held out. Rows repeat as often as they come in. Extra columns
of the inputs are neither read nor returned.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import crc_mod, prepare, texts

FOLDS = 5
THRESHOLD = 0.3


@dataclass(frozen=True)
class Params:
    max_rows: int = 20_000  # labelled rows to learn from, those with the smallest hash of doc_id
    rounds: int = 80
    depth: int = 4
    bins: int = 64
    rate: float = 0.15
    l2: float = 1.0
    min_hessian: float = 2.0


def _byte_classes() -> np.ndarray:
    kinds = np.zeros((256, 8), np.float64)
    for b in range(256):
        c = chr(b)
        kinds[b] = (
            c.isascii() and c.islower(), c.isascii() and c.isupper(), c.isascii() and c.isdigit(), c in " \t\n\r",
            c in ".,;:?'\"()-", c in "!", c in "#$%&*@^~<>{}[]\\/=+_`|", b >= 128,
        )
    return kinds


CLASSES = _byte_classes()
N_FEATURES = 20


def statistics(batch: list[str]) -> np.ndarray:
    """A row of document statistics for each text."""
    out = np.zeros((len(batch), N_FEATURES))
    for i, text in enumerate(batch):
        if not text:
            continue
        raw = np.bincount(np.frombuffer(text.encode("utf-8", "replace"), np.uint8), minlength=256)
        size = raw.sum()
        share = raw @ CLASSES / size
        p = raw[raw > 0] / size
        words = text.split()
        n = max(1, len(words))
        lines = text.split("\n")
        out[i, :8] = share
        out[i, 8:] = (
            np.log1p(size), np.log1p(len(words)), len(text) / n, len(set(words)) / n, np.log1p(len(lines)), len(set(lines)) / len(lines), len(words) / len(lines),
            -(p * np.log2(p)).sum(), raw[124] / n, raw[10] / size, share[1] / max(1e-9, share[0] + share[1]), max(map(len, words), default=0),
        )
    return out


@dataclass
class Trees:
    """Complete binary trees of one depth: node i has the children 2i+1 and 2i+2."""

    prior: float
    depth: int
    feature: np.ndarray  # trees x inner nodes
    threshold: np.ndarray
    value: np.ndarray  # trees x leaves

    def margin(self, x: np.ndarray) -> np.ndarray:
        total = np.full(len(x), self.prior)
        rows = np.arange(len(x))
        for f, t, v in zip(self.feature, self.threshold, self.value, strict=True):
            node = np.zeros(len(x), np.int64)
            for _ in range(self.depth):
                node = 2 * node + 1 + (x[rows, f[node]] > t[node])
            total += v[node - len(f)]
        return total

    def probability(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-self.margin(x)))


def grow(x: np.ndarray, y: np.ndarray, params: Params) -> Trees:
    """Boosts trees for the log loss; each split is searched over histograms of gradients and hessians."""
    inner = 2**params.depth - 1
    if len(y) == 0 or y.min() == y.max():
        share = float(np.clip(y.mean(), 1e-3, 1 - 1e-3)) if len(y) else 0.5
        return Trees(np.log(share / (1 - share)), params.depth, np.zeros((0, inner), np.int64), np.zeros((0, inner)), np.zeros((0, inner + 1)))
    edges = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, params.bins + 1)[1:-1])) for j in range(x.shape[1])]
    binned = np.stack([np.searchsorted(e, x[:, j], side="left") for j, e in enumerate(edges)], 1)  # bin <= k: x <= edges[k]
    n, width = binned.shape
    mean = y.mean()
    prior = float(np.log(mean / (1 - mean)))
    margin = np.full(n, prior)
    features, thresholds, values = [], [], []
    for _ in range(params.rounds):
        p = 1 / (1 + np.exp(-margin))
        g, h = p - y, p * (1 - p)
        feature, threshold = np.zeros(inner, np.int64), np.full(inner, np.inf)
        cut = np.full(inner, params.bins)
        node = np.zeros(n, np.int64)
        for level in range(params.depth):
            first, count = 2**level - 1, 2**level
            at = node - first
            best, where = np.zeros(count), np.full((count, 2), -1)
            for j in range(width):
                key = at * params.bins + binned[:, j]
                gs = np.cumsum(np.bincount(key, g, count * params.bins).reshape(count, -1), 1)
                hs = np.cumsum(np.bincount(key, h, count * params.bins).reshape(count, -1), 1)
                gt, ht = gs[:, -1:], hs[:, -1:]
                gain = gs**2 / (hs + params.l2) + (gt - gs) ** 2 / (ht - hs + params.l2) - gt**2 / (ht + params.l2)
                gain[(hs < params.min_hessian) | (ht - hs < params.min_hessian)] = 0
                gain[:, len(edges[j]) :] = 0
                k = gain.argmax(1)
                top = gain[np.arange(count), k]
                better = top > best + 1e-9
                best[better] = top[better]
                where[better] = np.stack([np.full(count, j), k], 1)[better]
            for c in range(count):
                j, k = where[c]
                if j >= 0:
                    feature[first + c], threshold[first + c], cut[first + c] = j, edges[j][k], k
            node = 2 * node + 1 + (binned[np.arange(n), feature[node]] > cut[node])
        leaf = node - inner
        value = -params.rate * np.bincount(leaf, g, inner + 1) / (np.bincount(leaf, h, inner + 1) + params.l2)
        margin = margin + value[leaf]
        features.append(feature)
        thresholds.append(threshold)
        values.append(value)
    return Trees(prior, params.depth, np.array(features), np.array(thresholds), np.array(values))


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, usable, max_rows: int) -> DataFrame:
    """``doc_id``, ``text`` and ``label`` of at most ``max_rows`` labelled documents, those with the smallest hash of doc_id.

    One row for each doc_id: its largest label, and where several documents share it, the first of their texts in order.
    """
    own = labels.where(F.col(label).isNotNull() & F.col("doc_id").isNotNull() & usable).groupBy("doc_id").agg(F.max(label).alias("label"))
    own = own.join(docs.select("doc_id"), "doc_id", "left_semi")
    n, space = own.count(), 1 << 40
    place = F.pmod(F.xxhash64("doc_id"), F.lit(space))
    # a little more than enough by the hash alone, so that few rows are left to sort, whatever the number of partitions
    enough = (max_rows + 6 * max_rows**0.5 + 50) / max(n, 1)
    if enough < 1:
        own = own.where(place < int(enough * space))
    return texts(docs).join(F.broadcast(own.orderBy(place, "doc_id").limit(max_rows)), "doc_id").groupBy("doc_id").agg(F.min("text").alias("text"), F.first("label").alias("label"))


def fit(docs: DataFrame, labels: DataFrame, params: Params = Params()) -> Trees:
    sample = labelled_sample(docs, labels, "quality", crc_mod("doc_id", FOLDS) != 0, params.max_rows)

    def measure(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            yield pd.DataFrame({"doc_id": b["doc_id"], "label": b["label"].astype(float), "x": list(statistics(b["text"].tolist()))})

    rows = sample.mapInPandas(measure, "doc_id long, label double, x array<double>").toPandas().sort_values("doc_id")
    return grow(np.array(rows["x"].tolist()).reshape(-1, N_FEATURES), rows["label"].to_numpy(float), params)


def score(docs: DataFrame, trees: Trees) -> DataFrame:
    """``doc_id``, ``held_out``, ``score`` (0 to 1, higher: better) and ``predicted`` of every document."""
    model = docs.sparkSession.sparkContext.broadcast(trees)

    def apply(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            yield pd.DataFrame({"doc_id": b["doc_id"], "held_out": b["held_out"], "score": model.value.probability(statistics(b["text"].tolist()))})

    held_out = F.coalesce(crc_mod("doc_id", FOLDS) == 0, F.lit(False)).alias("held_out")
    scored = texts(docs).select("doc_id", held_out, "text").mapInPandas(apply, "doc_id long, held_out boolean, score double")
    return scored.withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))


def quality_scores(docs: DataFrame, labels: DataFrame, params: Params = Params()) -> DataFrame:
    """Fits on the labelled rows outside the held-out fold and scores every document."""
    prepare(docs.sparkSession)
    return score(docs, fit(docs, labels, params))


def keep_good(docs: DataFrame, labels: DataFrame, params: Params = Params()) -> DataFrame:
    """The documents that the classifier accepts, with the columns they came with."""
    prepare(docs.sparkSession)
    trees = docs.sparkSession.sparkContext.broadcast(fit(docs, labels, params))

    @F.pandas_udf("double")
    def accepted(text: pd.Series) -> pd.Series:
        return pd.Series(trees.value.probability(statistics(text.tolist())))

    return docs.where(accepted(F.coalesce("text", F.lit(""))) >= THRESHOLD)
