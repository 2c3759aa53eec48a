"""Quality rules: a linear-chain conditional random field marks each line as content or boilerplate; the content share decides.

A text's lines that hold a word are a chain. The field has weights of a line's features for each of two states, and of
pairs of neighbouring states; Viterbi decoding gives the most likely states of the whole chain. A text is kept if the
share of its words that stand in content lines is at least ``Params.share``, unless one of two plain rules fails it first:
fewer than 50 words, or more than half of its words in windows of three words that occur twice or more.

There are no labelled lines, so the field learns from a bounded sample of documents whose quality is labelled (those with
the smallest hash of doc_id, outside the fold that op7 holds out). At first all lines of a good document are content, but
those with a phrase of licences and site notices, and all lines of a bad one are boilerplate. After a first fit the lines
of bad documents take the states that Viterbi gives them, so that clean lines between junk count as content; one that has
none left as boilerplate keeps all. Then the field is fitted again. The gradient of the log-likelihood is exact
(forward and backward sums over all chains together), the fit has no random part.

Defined results: a null or empty text has no words and fails; without labels of both kinds nothing is learnt, and every
line that is no notice is content; a null ``doc_id`` is judged like any other; equal rows get equal results; columns other
than ``doc_id`` and ``text`` are neither read nor returned. One pass over the texts, without a shuffle: a text is the unit
of work, so no key can be hot; lines of very long texts are decoded along with those of others, step by step.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import crc_mod, prepare, texts
from .quality import FOLDS, labelled_sample
from .words import covered, hashes, raw_texts, repeated_windows, words_of

# Fixed values.
BLANKS = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"
MIN_WORDS, MAX_REPEAT_PCT, WINDOW = 50, 50, 3
#: Phrases of licences and site notices, in lower case.
NOTICE = re.compile(
    r"all rights reserved|licensed? under|copyright|\(c\) \d{4}|terms of (?:use|service)|privacy policy|cookie|subscribe|sign up|log in|click here|read more|follow us|newsletter|"
    r"alle rechte vorbehalten|datenschutz|tous droits réservés|politique de confidentialité|todos los derechos reservados|política de privacidad"
)


@dataclass(frozen=True)
class Params:
    max_rows: int = 3000  # labelled documents to learn from, those with the smallest hash of doc_id
    share: float = 0.5  # of the words, in content lines
    steps: int = 200
    rate: float = 0.3
    l2: float = 1e-4


# --- counts ----------------------------------------------------------------------------------------------------------


def repeat_counts(words: list[list[bytes]]) -> list[int]:
    """For each text, how many of its words stand in a window of three words that occurs more than once in it. Exact: hashes only choose what is compared."""
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    total = int(sizes.sum())
    owner = np.repeat(np.arange(len(words)), sizes)
    at = repeated_windows(hashes(words, total), owner, WINDOW)
    if not len(at):
        return [0] * len(words)
    place = np.unique(np.concatenate([at + j for j in range(WINDOW)]))
    begin, ids = np.cumsum(sizes) - sizes, {}
    number = np.zeros(total, np.int64)
    number[place] = [ids.setdefault(words[t][i], len(ids)) for t, i in zip(owner[place].tolist(), (place - begin[owner[place]]).tolist(), strict=True)]
    key = np.stack([owner[at], *(number[at + j] for j in range(WINDOW))])
    order = np.lexsort(key)
    key = key[:, order]
    same = (key[:, 1:] == key[:, :-1]).all(0)
    twice = np.zeros(len(at), bool)
    twice[1:] |= same
    twice[:-1] |= same
    inside = covered(at[order[twice]], WINDOW, total)
    return np.bincount(owner[inside], minlength=len(words)).tolist()


def lines_of(text: str) -> list[str]:
    """The lines of a text that have a word."""
    return [x for x in text.split("\n") if x.strip(BLANKS)]


def plain_counts(text: str, lines: list[str]) -> tuple[int, int, int]:
    """Characters in words, symbols, and lines that are equal to an earlier one."""
    return len(text) - sum(map(text.count, BLANKS)), sum(map(text.count, SYMBOLS)), len(lines) - len(set(lines))


# --- features of lines -----------------------------------------------------------------------------------------------

NAMES = (
    "bias", "symbols none", "symbols few", "symbols many", "upper some", "upper most", "digits many", "marks !", "distinct low", "distinct mid", "one word", "few words", "many words",
    "no end mark", "end symbol", "long words", "short words", "notice", "seen before", "first", "last", "bars", "repeats before", "plain",
)


def line_features(lines: list[str]) -> np.ndarray:
    """A row of features, each 0 or 1, for each line of a text."""
    out = np.zeros((len(lines), len(NAMES)), np.float32)
    seen: set[str] = set()
    for i, line in enumerate(lines):
        words = line.split()
        n = len(words)
        if not n:  # only characters that Unicode calls spaces
            words, n = [line], 1
        size = len(line) - line.count(" ")
        symbols = sum(map(line.count, SYMBOLS)) / max(1, size)
        lower = line.lower()
        upper = sum(map(str.isupper, words)) / n
        digits = sum(map(line.count, "0123456789")) / max(1, size)
        distinct = len(set(words)) / n
        end = line.rstrip()[-1:]
        notice = NOTICE.search(lower) is not None
        plain = not notice and symbols == 0 and upper <= 0.2 and line.count("!") <= 0.2 * n and (n < 6 or distinct >= 0.6)
        out[i] = (
            1, symbols == 0, 0 < symbols <= 0.05, symbols > 0.05, 0.2 < upper <= 0.6, upper > 0.6, digits > 0.2, line.count("!") > 0.2 * n, n > 5 and distinct < 0.3, n > 5 and 0.3 <= distinct < 0.6, n == 1, 1 < n < 5,
            n > 40, end not in ".?!\"'):;,", end in SYMBOLS, size > 12 * n, size < 2.5 * n, notice, line in seen, i == 0, i == len(lines) - 1, line.count("|") > 0.2 * n, n > 1 and words[0] == words[1], plain,
        )
        seen.add(line)
    return out


# --- the field -------------------------------------------------------------------------------------------------------

CONTENT, BOILERPLATE = 0, 1


@dataclass
class Field:
    """Weights of features for each state, and of a state after another."""

    emit: np.ndarray  # features x 2
    move: np.ndarray  # 2 x 2, from and to


class Chains:
    """Chains of lines, of all texts, in steps: step t has the t-th line of every chain that is so long, longest chains first."""

    def __init__(self, sizes: np.ndarray):
        self.order = np.argsort(-sizes, kind="stable")
        begin = (np.cumsum(sizes) - sizes)[self.order]
        sizes = sizes[self.order]
        self.steps = [begin[: np.searchsorted(-sizes, -t, "left")] + t for t in range(int(sizes.max(initial=0)))]


def viterbi(scores: np.ndarray, move: np.ndarray, chains: Chains) -> np.ndarray:
    """The most likely state of every line; of equal paths, the one with content."""
    states = np.zeros(len(scores), np.int64)
    if not chains.steps:
        return states
    best = scores[chains.steps[0]]
    tops, back = [best], []
    for at in chains.steps[1:]:
        via = best[: len(at), :, None] + move[None]
        back.append(via.argmax(1))
        best = via.max(1) + scores[at]
        tops.append(best)
    last = np.zeros(len(chains.steps[0]), np.int64)
    for t in range(len(chains.steps) - 1, -1, -1):
        at = chains.steps[t]
        more = len(chains.steps[t + 1]) if t + 1 < len(chains.steps) else 0
        if more:
            last[:more] = back[t][np.arange(more), last[:more]]
        last[more : len(at)] = tops[t][more:].argmax(1)
        states[at] = last[: len(at)]
    return states


def log_sum(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis, keepdims=True)
    return np.squeeze(top, axis) + np.log(np.exp(x - top).sum(axis))


def marginals(scores: np.ndarray, move: np.ndarray, chains: Chains) -> tuple[float, np.ndarray, np.ndarray]:
    """The sum of the chains' log partition functions, each line's state probabilities, and expected numbers of state pairs."""
    ahead, total, pairs = np.zeros(scores.shape), 0.0, np.zeros((2, 2))
    behind = np.zeros(scores.shape)
    steps = chains.steps
    for t, at in enumerate(steps):
        ahead[at] = scores[at] if t == 0 else scores[at] + log_sum(ahead[steps[t - 1][: len(at)]][:, :, None] + move[None], 1)
    z = np.zeros(len(steps[0]))
    for t in range(len(steps) - 1, -1, -1):
        at, more = steps[t], len(steps[t + 1]) if t + 1 < len(steps) else 0
        z[more : len(at)] = log_sum(ahead[at[more:]], 1)
        if more:
            after = steps[t + 1]
            onward = move[None] + (scores[after] + behind[after])[:, None, :]
            behind[at[:more]] = log_sum(onward, 2)
            pairs += np.exp(ahead[at[:more]][:, :, None] + onward - z[:more, None, None]).sum(0)
    total = float(z.sum())
    own = ahead + behind
    own = np.exp(own - own.max(1, keepdims=True))
    return total, own / own.sum(1, keepdims=True), pairs


def likelihood(field: Field, x: np.ndarray, states: np.ndarray, chains: Chains) -> tuple[float, np.ndarray, np.ndarray]:
    """The log-likelihood of the states, and its gradient by both kinds of weights."""
    scores = x @ field.emit
    z, p, pairs = marginals(scores, field.move, chains)
    seen = np.zeros((2, 2))
    for a, b in zip(chains.steps[:-1], chains.steps[1:], strict=True):
        np.add.at(seen, (states[a[: len(b)]], states[b]), 1)
    fit = scores[np.arange(len(x)), states].sum() + (seen * field.move).sum() - z
    own = np.eye(2)[states]
    return float(fit), x.T @ (own - p), seen - pairs


def fit_field(x: np.ndarray, sizes: np.ndarray, states: np.ndarray, params: Params) -> Field:
    """Gradient ascent with steps scaled by each weight's own history; the same rows give the same field."""
    field, chains = Field(np.zeros((x.shape[1], 2)), np.zeros((2, 2))), Chains(sizes)
    if not len(x):
        return field
    moments = [[np.zeros(w.shape), np.zeros(w.shape)] for w in (field.emit, field.move)]
    for step in range(1, params.steps + 1):
        _, by_emit, by_move = likelihood(field, x, states, chains)
        for weights, gradient, (m, v) in zip((field.emit, field.move), (by_emit, by_move), moments, strict=True):
            g = gradient / len(x) - params.l2 * weights
            m += 0.1 * (g - m)
            v += 0.01 * (g * g - v)
            weights += params.rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
    return field


def learnt(features: list[np.ndarray], labels: np.ndarray, params: Params) -> Field:
    """The field of the sample: fitted to the first guess, and again to what it makes of bad documents."""
    notice = NAMES.index("notice")
    kept = [i for i, f in enumerate(features) if len(f)]
    features, labels = [features[i] for i in kept], labels[kept]
    if not len(labels) or labels.min() == labels.max():
        field = Field(np.zeros((len(NAMES), 2)), np.zeros((2, 2)))
        field.emit[notice, BOILERPLATE] = 1
        return field
    sizes = np.array([len(f) for f in features])
    x = np.concatenate(features).astype(np.float64)
    bad = np.repeat(labels == 0, sizes)
    guess = np.where(bad | (x[:, notice] > 0), BOILERPLATE, CONTENT)
    field = fit_field(x, sizes, guess, params)
    seen = viterbi(x @ field.emit, field.move, Chains(sizes))
    owner = np.repeat(np.arange(len(sizes)), sizes)
    some = np.bincount(owner, seen == BOILERPLATE, len(sizes)) > 0
    again = np.where(bad & some[owner], seen, guess)
    return fit_field(x, sizes, again, params)


def fit(docs: DataFrame, labels: DataFrame, params: Params = Params()) -> Field:
    sample = labelled_sample(docs, labels, "quality", crc_mod("doc_id", FOLDS) != 0, params.max_rows)

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = [line_features(lines_of(t)).astype(np.uint8).tobytes() for t in b.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column("doc_id").cast(pa.int64()), b.column("label").cast(pa.int32()), pa.array(x, pa.binary())], ["doc_id", "label", "x"])

    rows = sample.mapInArrow(measure, "doc_id long, label int, x binary").toPandas().sort_values("doc_id")
    return learnt([np.frombuffer(b, np.uint8).reshape(-1, len(NAMES)) for b in rows["x"]], rows["label"].to_numpy(), params)


# --- documents -------------------------------------------------------------------------------------------------------

COLUMNS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_content_lines", "content_words")
RESULT = "doc_id long, " + ", ".join(f"{c} long" for c in COLUMNS)


def judged(docs: DataFrame, field: Field) -> DataFrame:
    """``doc_id``, the counts of every text, and how many of its lines and words are content."""
    prepare(docs.sparkSession)
    model = docs.sparkSession.sparkContext.broadcast(field)

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            raw = b.column("text").to_pylist()
            words = list(map(words_of, raw))
            batch = [t.decode("utf-8", "replace") for t in raw]
            lines = list(map(lines_of, batch))
            sizes = np.fromiter(map(len, lines), np.int64, len(lines))
            x = np.concatenate([np.zeros((0, len(NAMES)), np.float32), *map(line_features, lines)])
            content = viterbi(x @ model.value.emit, model.value.move, Chains(sizes)) == CONTENT
            owner = np.repeat(np.arange(len(lines)), sizes)
            n = np.fromiter((len(words_of(line.encode("utf-8", "replace"))) for line in chain.from_iterable(lines)), np.int64, int(sizes.sum()))
            by_text = lambda v: np.bincount(owner, v, len(lines)).astype(np.int64)
            plain = np.array([plain_counts(t, own) for t, own in zip(batch, lines, strict=True)], np.int64).reshape(-1, 3).T
            columns = [list(map(len, words)), *plain, repeat_counts(words), sizes, by_text(content), by_text(n * content)]
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), *(pa.array(c, pa.int64()) for c in columns)], ["doc_id", *COLUMNS])

    return raw_texts(docs).withColumn("doc_id", F.col("doc_id").cast("long")).mapInArrow(apply, RESULT)


def with_verdict(counts: DataFrame, params: Params = Params()) -> DataFrame:
    """Adds ``base_failed``, ``content_share`` and ``kept``."""
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PCT * F.col("n_words"))
    share = F.when(F.col("n_words") > 0, F.col("content_words") / F.col("n_words")).otherwise(0.0)
    return counts.withColumns({"base_failed": failed, "content_share": share}).withColumn("kept", ~F.col("base_failed") & (F.col("content_share") >= params.share))


def line_quality(docs: DataFrame, labels: DataFrame, params: Params = Params()) -> DataFrame:
    """Learns the field from the labelled sample and judges every document."""
    return with_verdict(judged(docs, fit(docs, labels, params)), params)


def marked_lines(docs: DataFrame, field: Field) -> DataFrame:
    """``doc_id``, ``line`` (number among the lines that have a word, from 0), ``text`` and ``content``: the states of all lines."""
    prepare(docs.sparkSession)
    model = docs.sparkSession.sparkContext.broadcast(field)

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            lines = list(map(lines_of, b.column("text").to_pylist()))
            sizes = np.fromiter(map(len, lines), np.int64, len(lines))
            x = np.concatenate([np.zeros((0, len(NAMES)), np.float32), *map(line_features, lines)])
            content = viterbi(x @ model.value.emit, model.value.move, Chains(sizes)) == CONTENT
            ids = b.column("doc_id").take(pa.array(np.repeat(np.arange(len(lines)), sizes)))
            number = np.arange(len(x)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
            yield pa.RecordBatch.from_arrays([ids, pa.array(number, pa.int64()), pa.array(list(chain.from_iterable(lines)), pa.string()), pa.array(content)], ["doc_id", "line", "text", "content"])

    return texts(docs).withColumn("doc_id", F.col("doc_id").cast("long")).mapInArrow(apply, "doc_id long, line long, text string, content boolean")
