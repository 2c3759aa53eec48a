"""Runs against a search of every period, on random words and on documents."""

from __future__ import annotations

import hashlib
import random
import re
import zlib

from hypothesis import given, settings
from hypothesis import strategies as st

from loomstream.llm import periodic
from loomstream.llm.queries import op11_periodic_runs


def plain_runs(w, least=12):
    """Every maximal stretch in which words q apart are the same, for each q, unless a smaller q does for it too."""
    out = []
    for q in range(1, len(w) // 2 + 1):
        i = 0
        while i + q < len(w):
            s = i
            while i + q < len(w) and w[i] == w[i + q]:
                i += 1
            n = i - s + q
            if i > s and n >= max(least, 2 * q) and not any(all(w[k] == w[k + p] for k in range(s, s + n - p)) for p in range(1, q)):
                out.append((s, n, q))
            i += 1
    return sorted(out)


def plain_row(doc_id, text):
    w = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    h = zlib.crc32(str(doc_id).encode())
    if h % 10 == 0 and w:
        g = h // 10
        a = g % len(w)
        p = 1 + (len(w) - a) // (3 + g % 8)
        w = [w[i] if i < a else w[a + (i - a) % p] for i in range(len(w))]
    runs = plain_runs(w)
    sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
    best = max(runs, key=lambda r: (r[1], -r[0], -r[2]), default=None)
    dropped = {i for s, n, q in runs for i in range(s + q, s + n)}
    top = (None,) * 4 if best is None else (*best, 1000 * best[1] // best[2])
    return len(runs), *top, sha("".join(f"{s},{n},{q}\n" for s, n, q in runs)), sha(" ".join(x for i, x in enumerate(w) if i not in dropped))


COLUMNS = "n_runs start length period exponent_milli runs_sha256 collapsed_sha256".split()

blocks = st.lists(st.tuples(st.lists(st.sampled_from("abc"), min_size=1, max_size=9), st.integers(1, 5)), max_size=8)


@settings(max_examples=300, deadline=None)
@given(blocks)
def test_runs_of_repeated_blocks(parts):
    w = [x for block, times in parts for x in block * times]
    assert periodic.runs_in(w) == plain_runs(w)


def test_texts_of_a_batch_do_not_meet():
    rng = random.Random(3)
    batch = [[str(rng.randrange(4)).encode() for _ in range(rng.randrange(60))] * rng.randrange(1, 4) for _ in range(60)] + [[b"x"] * 11, [b"x"], [b"x"] * 12, []]
    assert periodic.runs_of_texts(batch) == [plain_runs(w) for w in batch]


def test_windows_find_what_they_must():
    """A bare square of six words, and twelve words of a period of five, are the least that windows of six words show."""
    for w in (list("abcdef" * 2), list("abcdeabcdeab"), list("zz") + list("ghijkl" * 2) + list("yy")):
        raw = [x.encode() for x in w]
        assert periodic.runs_of_texts([raw]) == [plain_runs(w)] and plain_runs(w)


def test_fibonacci_word():
    a, b = "a", "ab"
    while len(b) < 600:
        a, b = b, b + a
    assert periodic.runs_in(list(b)) == plain_runs(list(b))


def test_query_of_documents(spark, sf_dir):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    got = op11_periodic_runs(spark, sf_dir).collect()
    assert len(got) == len(docs)
    want = {d: plain_row(d, t) for d, t in docs.items() if len(t or "") < 4000}
    assert len(want) > 100 and sum(w[0] > 0 for w in want.values()) > 10
    for r in got:
        if r.doc_id in want:
            assert tuple(r[c] for c in COLUMNS) == want[r.doc_id], r.doc_id


def test_edges(spark):
    rows = [(None, "a b " * 9), (7, None), (7, ""), (7, " \t\n"), (8, "é x " * 12), (8, "é x " * 12), (1, " ".join(["w"] * 30_000))]
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("doc_id", "text", "1 AS n_runs", "'x' AS runs", "2 AS length")
    got = periodic.run_report(df).collect()
    assert len(got) == 7
    by = {(r.doc_id, r.n_words): r for r in got}
    assert (by[None, 18].n_runs, by[None, 18].start, by[None, 18].length, by[None, 18].period, by[None, 18].exponent_milli) == (1, 0, 18, 2, 9000)
    assert all(tuple(r[c] for c in COLUMNS) == plain_row(7, "") for r in got if r.doc_id == 7)
    assert sum(tuple(r[c] for c in COLUMNS) == plain_row(8, "é x " * 12) for r in got if r.doc_id == 8) == 2
    assert by[1, 30_000].length == 30_000 and by[1, 30_000].period == 1
    assert periodic.run_report(df.limit(0)).count() == 0
    assert {f.name: f.dataType.typeName() for f in periodic.run_report(df).schema}["exponent_milli"] == "long"


def test_operator_returns_runs_and_text(spark):
    df = spark.createDataFrame([(10, "p q " + "x y z " * 5 + "end")], "doc_id long, text string")
    r = periodic.document_runs(df).head()
    assert [tuple(x) for x in r.runs] == [(2, 15, 3)] and r.collapsed == "p q x y z end" and r.n_words == 18
