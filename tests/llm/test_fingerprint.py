from __future__ import annotations

import hashlib

import numpy as np
import pytest

from loomstream.llm import fingerprint as fp

DOCS = "doc_id long, text string, fingerprint string"


def brute(rows):
    order = sorted(((d, t or "") for d, t in rows), key=lambda r: (r[0] is None, -(r[0] or 0), r[1]))
    out = []
    for (d, t), (_, u) in zip(order, order[1:] + order[:1], strict=True):
        e = t[: len(t) - len(t) // 2] + u[: len(t) // 2]
        out.append((d, len(t), hashlib.sha256(e.encode()).hexdigest(), fp.fingerprint(t), fp.fingerprint(e)))
    return sorted(out, key=str)


CASES = {
    "plain": [(i * 7 % 61, f"line {i}\nword " * (i % 5) + "é😀") for i in range(61)],
    "nulls": [(1, None), (None, "a b"), (None, ""), (2, "x"), (2, "y"), (2, "x"), (3, "w" * 100_000)],
    "only nulls": [(None, "a"), (None, "bb"), (None, "cc")],
    "one": [(5, "alone here")],
    "empty": [],
}


@pytest.mark.parametrize("case", CASES)
def test_edited_texts_and_fingerprints(spark, case):
    rows = CASES[case]
    df = spark.createDataFrame([(*r, "clash") for r in rows], DOCS)  # an extra column with a clashing name
    got = fp.document_fingerprints(df).collect()
    assert sorted(((r.doc_id, r.n_chars, r.edited_sha256, r.fingerprint, r.edited_fingerprint) for r in got), key=str) == brute(rows)


def test_multiset_of_paragraphs():
    a, b, c = "one two\nthree", "three\none two", "one two\nthree\nthree"
    assert fp.fingerprint(a) == fp.fingerprint(b) != fp.fingerprint(c)
    assert fp.combine(fp.fingerprint("one two"), fp.fingerprint("three")) == fp.fingerprint(a)
    assert fp.combine(fp.fingerprint(c), fp.fingerprint("three"), -1) == fp.fingerprint(a)


def test_likeness_follows_shared_text(spark, sf_dir):
    from loomstream.llm.queries import op1_fingerprint

    rows = op1_fingerprint(spark, sf_dir).toPandas()
    big = rows[rows.n_chars > 400]
    assert abs(big.near_edited.mean() - 0.5) < 0.15 and big.near_next.mean() < 0.25
    assert np.mean(big.near_edited > big.near_next) > 0.95
