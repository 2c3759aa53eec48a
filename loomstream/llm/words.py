"""Words of whole texts as bytes, and windows of words that may occur again in their text."""

from __future__ import annotations

from itertools import chain

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MIX = np.uint64(0x9E3779B97F4A7C15)


def raw_texts(docs: DataFrame, *columns) -> DataFrame:
    """``doc_id``, ``text`` as UTF-8 (null: empty) and the named columns."""
    return docs.select("doc_id", F.coalesce(F.col("text"), F.lit("")).cast("binary").alias("text"), *columns)


def words_of(text: bytes) -> list[bytes]:
    """The words between white space of ASCII; what else Unicode calls a space is a part of a word."""
    return text.split()


def hashes(words: list[list[bytes]], total: int) -> np.ndarray:
    """One 64-bit hash for each word, good within a process."""
    return np.fromiter(map(hash, chain.from_iterable(words)), np.int64, total).view(np.uint64)


def repeated_windows(words: np.ndarray, owner: np.ndarray, width: int) -> np.ndarray:
    """Starts of the windows of ``width`` words whose hash occurs more than once for their owner.

    ``owner`` (ascending) says which text a word belongs to; a window lies within one. None that occurs twice is left out;
    by a collision of hashes one more may come in.
    """
    if len(words) < width:
        return np.zeros(0, np.int64)
    n = len(words) - width + 1
    key = words[:n].copy()
    for j in range(1, width):
        key *= MIX
        key += words[j : j + n]
    key ^= (owner[:n].astype(np.uint64) + np.uint64(1)) * MIX
    at = np.flatnonzero(owner[:n] == owner[width - 1 :])
    key = key[at]
    order = np.sort(key)
    twice = order[1:][order[1:] == order[:-1]]
    if not len(twice):
        return np.zeros(0, np.int64)
    place = np.searchsorted(twice, key)
    place[place == len(twice)] = 0
    return at[twice[place] == key]


def covered(starts: np.ndarray, width: int, n: int) -> np.ndarray:
    """Which of n places lie in a window that begins at one of the starts."""
    step = np.zeros(n + 1, np.int64)
    np.add.at(step, starts, 1)
    np.add.at(step, starts + width, -1)
    return np.cumsum(step[:-1]) > 0
