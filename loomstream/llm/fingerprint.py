"""Document fingerprints: a homomorphic multiset hash of paragraphs.

A paragraph (a line, empty ones included) is hashed to a wide vector in two
parts; a document's fingerprint is the sum of its paragraphs' vectors, lane by
lane, so it does not depend on their order, and a paragraph is inserted or
deleted by adding or subtracting its vector.

* Exact lanes: 16 lanes of 64 bits from SHAKE-128 of the paragraph, summed modulo
  2**64. Equal sums stand for equal multisets of paragraphs.
* Likeness lanes: 128 lanes of 32 bits, summed modulo 2**32. Each run of six
  bytes of the paragraph (padded in front) adds +1 or -1 to one lane, so the
  cosine of two sums estimates how much of the texts is shared.

Defined results: a null or empty text is the empty multiset, with an all-zero
fingerprint; two empty fingerprints are alike (1), an empty and another are not
(0). Rows that repeat a ``doc_id`` are ordered by their text; a null ``doc_id``
comes last. The last document is followed by the first, a lone document by
itself. Extra columns are neither read nor returned.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import prepare, texts

EXACT, LIKE, GRAM = 16, 128, 6
MIX = np.uint64(0x9E3779B97F4A7C15)
PAD = b"\x00" * (GRAM - 1)
BREAK = b"\n" + PAD


def exact_lanes(paragraph: bytes) -> np.ndarray:
    return np.frombuffer(hashlib.shake_128(paragraph).digest(EXACT * 8), "<u8")


def exact_sum(text: bytes) -> np.ndarray:
    """Sum of the exact lanes of a text's paragraphs, modulo 2**64."""
    if not text:
        return np.zeros(EXACT, "<u8")
    data = b"".join(hashlib.shake_128(p).digest(EXACT * 8) for p in text.split(b"\n"))
    return np.frombuffer(data, "<u8").reshape(-1, EXACT).sum(0, dtype=np.uint64)


def like_sums(batch: list[bytes]) -> np.ndarray:
    """Sum of the likeness lanes of each text's paragraphs, modulo 2**32."""
    out = np.zeros((len(batch), LIKE), np.int64)
    padded = [PAD + t.replace(b"\n", BREAK) for t in batch]
    i = 0
    while i < len(padded):  # some texts together, so that arrays stay small
        j, size = i, 0
        while j < len(padded) and (j == i or size + len(padded[j]) < 1 << 18):
            size += len(padded[j])
            j += 1
        data = np.frombuffer(b"".join(padded[i:j]), np.uint8)
        owner = np.repeat(np.arange(j - i), [len(p) for p in padded[i:j]])
        gram = data.astype(np.uint64)
        for k in range(1, GRAM):
            gram[k:] |= data[:-k].astype(np.uint64) << np.uint64(8 * k)
        ends = (data != 0) & (data != 10)  # a run ends at a byte of the text itself
        h = gram[ends] * MIX
        h ^= h >> np.uint64(29)
        h *= MIX
        lane = (h >> np.uint64(57)).astype(np.int64)  # 7 bits: 128 lanes
        sign = 1 - 2 * ((h >> np.uint64(56)) & np.uint64(1)).astype(np.int64)
        at = (owner[ends] * LIKE + lane) * 2 + (sign > 0)
        n = np.bincount(at, minlength=(j - i) * LIKE * 2).reshape(-1, LIKE, 2)
        out[i:j] = n[:, :, 1] - n[:, :, 0]
        i = j
    return out.astype(np.int32)


def combine(a: str, b: str, sign: int = 1) -> str:
    """The fingerprint of a with the paragraphs of b inserted (sign 1) or deleted (-1)."""
    (ea, la), (eb, lb) = parse(a), parse(b)
    if sign < 0:
        return render(ea - eb, la - lb)
    return render(ea + eb, la + lb)


def render(exact: np.ndarray, like: np.ndarray) -> str:
    return exact.astype("<u8").tobytes().hex() + like.astype("<i4").tobytes().hex()


def parse(fingerprint: str) -> tuple[np.ndarray, np.ndarray]:
    raw = bytes.fromhex(fingerprint)
    return np.frombuffer(raw[: EXACT * 8], "<u8"), np.frombuffer(raw[EXACT * 8 :], "<i4")


def fingerprint(text: str | None) -> str:
    raw = (text or "").encode("utf-8", "replace")
    return render(exact_sum(raw), like_sums([raw])[0])


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """Cosine of the likeness lanes, 0 at least; 1 for two empty texts."""
    x, y = a.astype(np.float64), b.astype(np.float64)
    size = np.sqrt((x @ x) * (y @ y))
    if size == 0:
        return float(not x.any() and not y.any())
    return float(min(1.0, max(0.0, (x @ y) / size)))


def edited(text: str, following: str) -> str:
    """The text with its last half replaced by as many code points of the following text, or all that it has."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


SCHEMA = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"


def _compare(rows: list[tuple]) -> pd.DataFrame:
    """rows: (doc_id, text, following text, its own place among the texts, that of the following)."""
    raw: dict[str, int] = {}
    place = lambda t: raw.setdefault(t, len(raw))
    plan = [(d, t, place(t), place(edited(t, u)), place(u)) for d, t, u in rows]
    data = [t.encode("utf-8", "replace") for t in raw]
    like = like_sums(data)
    shown: dict[int, str] = {}

    def show(k: int) -> str:
        if k not in shown:
            shown[k] = render(exact_sum(data[k]), like[k])
        return shown[k]

    out = [(d, len(t), hashlib.sha256(data[e]).hexdigest(), show(a), show(e), likeness(like[a], like[e]), likeness(like[a], like[n])) for d, t, a, e, n in plan]
    return pd.DataFrame(out, columns=[c.split()[0] for c in SCHEMA.split(", ")])


def document_fingerprints(docs: DataFrame) -> DataFrame:
    """Fingerprints of every document and of its edited text, whose end comes from the next document by falling doc_id.

    Documents are dealt by ranges of doc_id into many small buckets; the first
    document of a bucket also goes, as a guest, to the bucket before it. So each
    document meets its follower without a global window, and a task holds one
    Arrow batch and one row at a time.
    """
    spark = prepare(docs.sparkSession)
    own = texts(docs)
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    buckets = min(20_000, 24 * parts)
    bounds = own.agg(F.percentile_approx("doc_id", [i / buckets for i in range(buckets)], 8 * buckets).alias("b"), F.max("doc_id").alias("top")).head()
    starts = np.unique(np.array([*(bounds["b"] or []), *([bounds["top"]] if bounds["top"] is not None else [])], np.int64))[::-1]  # the first doc_id of each bucket, falling
    last = max(0, len(starts) - 1)

    @F.pandas_udf("array<int>")
    def places(doc_id: pd.Series) -> pd.Series:
        missing = doc_id.isna().to_numpy()
        ids = doc_id.fillna(0).to_numpy(np.int64)
        at = np.where(missing, last, np.searchsorted(-starts, -ids, side="right") - 1)
        first = ~missing & (starts[at] == ids) if len(starts) else np.zeros(len(ids), bool)
        return pd.Series([[int(b), int(b) - 1 if b else last] if f else [int(b)] for b, f in zip(at, first, strict=True)])

    # a guest at the end of the falling order stands after the bucket's own rows
    dealt = own.select("doc_id", "text", F.posexplode(places("doc_id")).alias("guest", "bucket"))
    dealt = dealt.repartition(parts, "bucket").sortWithinPartitions("bucket", "guest", F.desc_nulls_last("doc_id"), "text")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        now, first, held = None, "", None  # the bucket, its first text, and doc_id and text of the row that waits for its follower
        for b in batches:
            rows = []
            for bucket, guest, doc_id, text in zip(b["bucket"], b["guest"], b["doc_id"], b["text"], strict=True):
                if bucket != now:
                    if held is not None:
                        rows.append((*held, first))
                    now, first, held = bucket, text, None
                if held is not None:
                    rows.append((*held, text))
                held = None if guest else (doc_id, text)
            if rows:
                yield _compare(rows)
        if held is not None:  # no doc_id at all: the first row follows the last
            yield _compare([(*held, first)])

    return dealt.mapInPandas(run, SCHEMA)
